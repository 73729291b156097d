"""Data-quality expectations and relational constraint checks.

``expect(df, checks)`` evaluates any number of checks in ONE aggregate pass
over ``df`` and returns one row per check: (check, passed, failing_rows,
observed).  Only the aggregate row reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any, Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = "check string, passed boolean, failing_rows long, observed double"


@dataclass
class Check:
    name: str
    aggs: list[Column]                      # aggregate expressions, aliased by position
    verdict: Callable[[list[Any]], tuple[bool, int | None, float | None]]
    schema_only: bool = field(default=False)


def _bad(pred: Column) -> Column:
    """Rows where ``pred`` is not true (false or unknown)."""
    return F.count_if(~F.coalesce(pred, F.lit(False)))


def row_count(equals: int | None = None, at_least: int | None = None) -> Check:
    def v(a):
        n = a[0]
        ok = (equals is None or n == equals) and (at_least is None or n >= at_least)
        return ok, 0 if ok else 1, float(n)
    return Check(f"row_count(eq={equals},min={at_least})", [F.count(F.lit(1))], v)


def unique(cols: Sequence[str]) -> Check:
    cols = list(cols)
    def v(a):
        dup = a[0] - a[1]
        return dup == 0, dup, float(a[1])
    key = F.struct(*[F.col(c) for c in cols])
    return Check(f"unique({','.join(cols)})", [F.count(F.lit(1)), F.count_distinct(key)], v)


def in_set(col: str, allowed: Sequence) -> Check:
    def v(a):
        return a[0] == 0, a[0], float(a[0])
    return Check(f"in_set({col})", [_bad(F.col(col).isin(list(allowed)))], v)


def in_range(col: str, lo=None, hi=None, lo_strict: bool = False, hi_strict: bool = False) -> Check:
    c = F.col(col)
    pred = F.lit(True)
    if lo is not None:
        pred = pred & ((c > lo) if lo_strict else (c >= lo))
    if hi is not None:
        pred = pred & ((c < hi) if hi_strict else (c <= hi))
    def v(a):
        return a[0] == 0, a[0], float(a[0])
    return Check(f"in_range({col},{lo},{hi})", [_bad(pred)], v)


def rate_between(name: str, pred: Column, lo: float, hi: float) -> Check:
    def v(a):
        rate = (a[0] / a[1]) if a[1] else 0.0
        return lo <= rate <= hi, None, rate
    return Check(f"rate_between({name},{lo},{hi})",
                 [F.count_if(F.coalesce(pred, F.lit(False))), F.count(F.lit(1))], v)


def share_above(name: str, pred: Column, min_share: float) -> Check:
    def v(a):
        rate = (a[0] / a[1]) if a[1] else 0.0
        return rate > min_share, a[1] - a[0], rate
    return Check(f"share_above({name},{min_share})",
                 [F.count_if(F.coalesce(pred, F.lit(False))), F.count(F.lit(1))], v)


def distinct_count(col: str, equals: int | None = None) -> Check:
    def v(a):
        return (equals is None or a[0] == equals), 0, float(a[0])
    return Check(f"distinct_count({col},{equals})", [F.count_distinct(F.col(col))], v)


def not_null(cols: Sequence[str]) -> Check:
    cols = list(cols)
    def v(a):
        return a[0] == 0, a[0], float(a[0])
    anynull = F.lit(False)
    for c in cols:
        anynull = anynull | F.col(c).isNull()
    return Check(f"not_null({','.join(cols)})", [F.count_if(anynull)], v)


def ordered(lo: str, mid: str, hi: str) -> Check:
    def v(a):
        return a[0] == 0, a[0], float(a[0])
    return Check(f"ordered({lo}<={mid}<={hi})",
                 [_bad((F.col(lo) <= F.col(mid)) & (F.col(mid) <= F.col(hi)))], v)


def implies(name: str, where: Column, must: Column) -> Check:
    def v(a):
        return a[0] == 0, a[0], float(a[0])
    return Check(f"implies({name})", [F.count_if(F.coalesce(where, F.lit(False))
                                                 & ~F.coalesce(must, F.lit(False)))], v)


def date_range(col: str, lo: str, hi: str) -> Check:
    def v(a):
        ok = a[0] is not None and str(a[0]) >= lo and str(a[1]) <= hi
        return ok, a[2], float(a[2])
    c = F.col(col)
    return Check(f"date_range({col},{lo},{hi})",
                 [F.min(c), F.max(c), F.count_if((c < F.lit(lo).cast("date")) | (c > F.lit(hi).cast("date")))], v)


def relative_change(order: str, value: str, max_change: float) -> Check:
    def v(a):
        first, last = a[0], a[1]
        ch = abs(float(last) - float(first)) / float(first) if first else float("inf")
        return ch < max_change, None, ch
    return Check(f"relative_change({value},<{max_change})",
                 [F.min_by(value, order), F.max_by(value, order)], v)


def mean_below(name: str, where: Column, col: str, bound: float) -> Check:
    """Mean of ``col`` over rows meeting ``where`` is below ``bound`` (passes when none)."""
    def v(a):
        return (a[0] is None or a[0] < bound), a[1], None if a[0] is None else float(a[0])
    sel = F.coalesce(where, F.lit(False))
    # the mean of doubles is shown to 10 places: its last bits depend on summation order
    mean = F.round(F.avg(F.when(sel, F.col(col))).cast("decimal(38,10)"), 10).cast("double")
    return Check(f"mean_below({name},{bound})", [mean, F.count_if(sel)], v)


def columns_exist(df_columns: Sequence[str], required: Sequence[str]) -> Check:
    missing = [c for c in required if c not in set(df_columns)]
    return Check(f"columns_exist({','.join(required)})", [],
                 lambda a: (not missing, len(missing), float(len(missing))), schema_only=True)


def output_exists(spark, path: str, fmt: str = "parquet") -> bool:
    """True when ``path`` holds a readable table (the schema is read, no rows)."""
    try:
        spark.read.format(fmt).load(path).limit(0).collect()
        return True
    except Exception:  # noqa: BLE001 - missing path or unreadable files
        return False


def expect(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate ``checks`` in one aggregate pass; one result row per check."""
    exprs, spans = [], []
    for ck in checks:
        spans.append((len(exprs), len(ck.aggs)))
        exprs.extend(e.alias(f"_a{len(exprs) + i}") for i, e in enumerate(ck.aggs))
    row = list(df.agg(*exprs).first()) if exprs else []
    out = []
    for ck, (s, n) in zip(checks, spans):
        ok, failing, observed = ck.verdict(row[s:s + n])
        out.append((ck.name, bool(ok), None if failing is None else int(failing),
                    None if observed is None else float(observed)))
    return df.sparkSession.createDataFrame(out, RESULT_SCHEMA)


# --- relational constraints -------------------------------------------------

def duplicate_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their multiplicity (PK / UNIQUE)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: nulls per column (NOT NULL)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def with_defaults(df: DataFrame, defaults: dict[str, Any]) -> DataFrame:
    """Apply column defaults to nulls (DEFAULT clauses)."""
    return df.fillna({k: v for k, v in defaults.items() if not isinstance(v, Column)}).select(
        *[F.coalesce(F.col(c), defaults[c]).alias(c) if isinstance(defaults.get(c), Column)
          else F.col(c) for c in df.columns])


def schema_violations(df: DataFrame, schema: T.StructType,
                      max_length: dict[str, int] | None = None) -> DataFrame:
    """One row: per declared column, values that do not fit the declared type or length.

    A declared column that the table lacks raises.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"declared columns missing: {missing}")
    aggs = []
    for f in schema.fields:
        c = F.col(f.name)
        bad = None
        if isinstance(f.dataType, (T.DecimalType, T.IntegerType, T.LongType, T.DateType)):
            bad = c.isNotNull() & c.try_cast(f.dataType).isNull()
        if max_length and f.name in max_length:
            too_long = F.length(c.cast("string")) > max_length[f.name]
            bad = too_long if bad is None else bad | too_long
        if bad is not None:          # only columns with a declared rule are reported
            aggs.append(F.count_if(bad).alias(f.name))
    return df.agg(*aggs)
