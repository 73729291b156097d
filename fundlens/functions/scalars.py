"""Scalar Column functions (rounding, scaling, predicates, dates, ids)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

TRADING_DAYS = 252


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fround(col, places: int) -> Column:
    """Round a double half away from zero on its shortest decimal form.

    The value is first cast to DECIMAL(38,10) so that the rounding acts on
    decimal digits, not on the binary approximation (0.285 rounds to 0.29).
    NaN, infinities and magnitudes beyond the decimal range pass unchanged.
    """
    x = _c(col)
    return F.coalesce(F.round(x.try_cast("decimal(38,10)"), places).cast("double"), x)


def mean_of(col) -> Column:
    """Mean computed as exact sum / count, as a double (order independent)."""
    return F.sum(_c(col)).cast("double") / F.count(_c(col))


def annualised_vol(daily_std, periods: int = TRADING_DAYS) -> Column:
    return _c(daily_std) * F.sqrt(F.lit(float(periods)))


def period_flag(col, lo, hi) -> Column:
    """1 when lo <= col <= hi (both ends inclusive), else 0."""
    return _c(col).between(F.lit(lo), F.lit(hi)).cast("int")


def threshold(col, t, strict: bool = False) -> Column:
    c = _c(col)
    return (c > t if strict else c >= t).cast("int")


def floor_at(col, floor) -> Column:
    return F.greatest(_c(col), F.lit(floor))


def month_bucket(col) -> Column:
    return F.date_format(_c(col), "yyyy-MM")


def padded_id(prefix: str, col, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(_c(col).cast("string"), width, "0"))


def fee_accrual(fee_pct, aum) -> Column:
    """Monthly management fee: fee% / 100 / 12 x AUM (exact decimal, 2 places)."""
    return F.round(_c(fee_pct).cast("decimal(10,4)") * _c(aum).cast("decimal(20,2)")
                   / F.lit(1200), 2)


def notional(price, qty) -> Column:
    return F.round(_c(price).cast("decimal(18,4)") * _c(qty).cast("decimal(12,0)"), 2)


# Market-regime factors by (year, month, asset class); first matching rule
# wins.  Fixed values of the regime table:
#   2020 March-April: -0.0025, or 0.0001 for Money Market
#   2020-2021 after April: 0.0008
#   2022: -0.0004 for Equity and Fixed Income, else 0.0002
#   2023-2024: 0.0005
#   otherwise: 0.0003
def market_regime(date_col, class_col) -> Column:
    d, cls = _c(date_col), _c(class_col)
    y, m = F.year(d), F.month(d)
    return (F.when((y == 2020) & m.isin(3, 4),
                   F.when(cls != "Money Market", F.lit(Decimal("-0.0025")))
                   .otherwise(F.lit(Decimal("0.0001"))))
            .when(y.isin(2020, 2021) & (m > 4), F.lit(Decimal("0.0008")))
            .when(y == 2022, F.when(cls.isin("Equity", "Fixed Income"), F.lit(Decimal("-0.0004")))
                  .otherwise(F.lit(Decimal("0.0002"))))
            .when(y.isin(2023, 2024), F.lit(Decimal("0.0005")))
            .otherwise(F.lit(Decimal("0.0003")))).cast("decimal(6,4)")


def to_decimal(col, precision: int, places: int) -> Column:
    """Round (as ``fround``) into DECIMAL(precision, places)."""
    return F.round(_c(col).cast("decimal(38,10)"), places).cast(f"decimal({precision},{places})")
