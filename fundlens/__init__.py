"""fundlens: fund-operations analytics expressed as Spark DataFrame plans.

Every operator takes DataFrames plus column names and returns a DataFrame
(or a Column expression); nothing is materialised on the driver except
bounded scalars (a max date, a quantile, a few bucket boundaries).
"""

__all__ = ["session"]
