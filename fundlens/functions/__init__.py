"""Column-level scalar functions and calendars."""
