"""Joins and key-set logic (inner dimension joins, semi/anti joins, key-set equality)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def with_dimension(fact: DataFrame, dim: DataFrame, key: str | Sequence[str] = "fund_id",
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Inner equi join of a fact (or an aggregate of it) with dimension columns.

    No broadcast hint: the session's byte thresholds decide, and AQE again on the measured size.
    """
    keys = _keys(key)
    d = dim if columns is None else dim.select(*keys, *[c for c in columns if c not in keys])
    return fact.join(d, on=keys, how="inner")


def present_in(df: DataFrame, other: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key exists in ``other`` (left semi join on its distinct keys)."""
    keys = _keys(key)
    return df.join(other.select(*keys).distinct(), on=keys, how="left_semi")


def orphans(fact: DataFrame, dim: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Fact rows without a dimension row (foreign-key violations)."""
    keys = _keys(key)
    return fact.join(dim.select(*keys), on=keys, how="left_anti")


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Orphan keys with their fact row counts.

    The fact is reduced to one row per key (map-side combined) before the anti
    join, so a key holding a third of the fact is one row in the shuffle.
    """
    keys = _keys(key)
    per_key = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.join(dim.select(*keys).distinct(), on=keys, how="left_anti")


def key_set_diff(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: distinct keys of ``a`` missing from ``b`` and the reverse."""
    keys = _keys(key)
    ka, kb = a.select(*keys).distinct(), b.select(*keys).distinct()
    only_a = ka.join(kb, keys, "left_anti").agg(F.count(F.lit(1)).alias("only_left"))
    only_b = kb.join(ka, keys, "left_anti").agg(F.count(F.lit(1)).alias("only_right"))
    return only_a.select(
        "only_left", only_b.select("only_right").scalar().alias("only_right"),
        ((F.col("only_left") == 0) & (only_b.select("only_right").scalar() == 0)).alias("equal"))
