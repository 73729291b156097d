"""Relational and window operators over DataFrames, parameterised by column names."""
