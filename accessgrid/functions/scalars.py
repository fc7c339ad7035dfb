"""Column expressions for keys, text, dates, flags and bands."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from accessgrid.functions.constants import INCOME_BANDS, UNKNOWN_LABEL


ZIP_PLUS_FOUR = r"^\d{5}-\d{4}$"


def _left_padded(text: Column, width: int) -> Column:
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def padded_key(col: Column, width: int = 5) -> Column:
    """Key as text, zero-padded on the left; longer keys stay whole, only ZIP+4 loses its last part."""
    text = col.cast("string")
    return _left_padded(F.when(text.rlike(ZIP_PLUS_FOUR), F.left(text, F.lit(5))).otherwise(text), width)


def numeric_key(col: Column, width: int = 5) -> Column:
    """Key read as a number, then zero-padded; text that is no number gives NULL, long keys stay whole."""
    return _left_padded(col.try_cast("bigint").cast("string"), width)


def upper_text(col: Column) -> Column:
    return F.upper(F.trim(col))


def title_text(col: Column) -> Column:
    return F.initcap(F.trim(col))


def parsed_date(col: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Date, or NULL where the text is no date."""
    return F.try_to_date(col, fmt)


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def month_label(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or NULL."""
    return F.when(condition, 1).otherwise(0)


def flag_or_null(condition: Column) -> Column:
    """1 / 0, NULL where the condition is NULL."""
    return F.when(condition, 1).when(~condition, 0)


def safe_ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom)


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def total(*cols: str) -> Column:
    expr = F.col(cols[0])
    for c in cols[1:]:
        expr = expr + F.col(c)
    return expr


def first_positive(choices: list[tuple[str, str]], otherwise: str) -> Column:
    """Label of the first count column above zero."""
    expr = None
    for column, label in choices:
        test = F.col(column) > 0
        expr = F.when(test, label) if expr is None else expr.when(test, label)
    return expr.otherwise(otherwise)


def income_band(col: Column) -> Column:
    """Band label; upper ends belong to the band, below zero and NULL are unknown."""
    expr = F.when(col.isNull() | F.isnan(col) | (col < 0), UNKNOWN_LABEL)
    for label, top in INCOME_BANDS:
        expr = expr.otherwise(label) if top is None else expr.when(col <= top, label)
    return expr


def finite(col: Column) -> Column:
    return col.isNotNull() & ~F.isnan(col) & (F.abs(col) < float("inf"))


def not_nan(col: Column) -> Column:
    """NaN as NULL, so that averages and maxima are not taken over by it."""
    return F.when(~F.isnan(col), col)


def clip(col: Column, low: Column | None = None, high: Column | None = None) -> Column:
    """Bounded value; NULL stays NULL."""
    out = col
    if low is not None:
        out = F.greatest(out, low)
    if high is not None:
        out = F.least(out, high)
    return F.when(col.isNotNull(), out)


def count_label(col: Column) -> Column:
    return F.format_number(col, 0)


def decimals(col: Column, places: int = 3) -> Column:
    return F.coalesce(F.format_number(col, places), F.lit("NA"))


def weighted_sum(weights: dict[str, float]) -> Column:
    """Sum of column * weight in the given order."""
    terms = [F.lit(w) * F.col(c) for c, w in weights.items()]
    expr = terms[0]
    for t in terms[1:]:
        expr = expr + t
    return expr


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once, however often `use` names it.

    Columns of an inner select are no help: the optimizer writes them out wherever they are named,
    inside of functions over arrays for each element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
