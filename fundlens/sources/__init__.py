"""Readers, writers and the bindings that adapt the driver tables."""
