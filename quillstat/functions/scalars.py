"""Column expressions: text clean-up, coercion, flags, scaling and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
NEAR_ZERO = 1e-8
VIF_STRONG = 10.0
VIF_WARNING = 5.0
PERFECT_FIT_GAP = 1e-12
CLOSE_RTOL = 1e-5
CLOSE_ATOL = 1e-8

_EDGE_BLANKS = r"^\s+|\s+$"
_JAVA_NUMBER_SUFFIX = r"[0-9.]\s*[dDfF]\s*$"


def clean_text(c: Column) -> Column:
    """Cast to text and strip blanks at both ends; a missing value stays missing."""
    return F.regexp_replace(c.cast("string"), _EDGE_BLANKS, "")


def to_number(c: Column) -> Column:
    """Coerce text to double; text that is not a number becomes missing."""
    number = c.cast("string").try_cast("double")
    bad = F.isnan(number) | c.cast("string").rlike(_JAVA_NUMBER_SUFFIX)
    return F.when(~bad, number)


def label_map(c: Column, mapping: Mapping[object, str], keep_unmapped: bool = True) -> Column:
    """Code to display label; unmapped codes stay as text or become missing."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in (str(pair[0]), pair[1])])
    text = c.cast("string")
    mapped = F.try_element_at(table, text)
    return F.coalesce(mapped, text) if keep_unmapped else mapped


def is_nonzero(c: Column, tol: float = NEAR_ZERO) -> Column:
    return F.abs(c) > F.lit(tol)


def is_finite(c: Column) -> Column:
    """True for a present, finite number; never null."""
    return F.coalesce(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), F.lit(False))


def finite_or(c: Column, default: float | None) -> Column:
    """Replace missing, NaN and infinite values by ``default`` (None = missing)."""
    return F.when(is_finite(c), c).otherwise(F.lit(default).cast("double"))


def clamp(c: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def vif_from_r2(r2: Column) -> Column:
    gap = F.lit(1.0) - r2
    return F.when(gap <= PERFECT_FIT_GAP, F.lit(float("inf"))).otherwise(F.lit(1.0) / gap)


def vif_flag(vif: Column) -> Column:
    return (
        F.when(vif >= VIF_STRONG, "strong").when(vif >= VIF_WARNING, "warning").otherwise("ok")
    )


def partial_r2(vif: Column) -> Column:
    return F.when(is_finite(vif) & (vif != 0), F.lit(1.0) - F.lit(1.0) / vif).otherwise(F.lit(1.0))


def unit_range(c: Column, lo: Column, hi: Column) -> Column:
    """Min-max scaling; a column that is constant up to rounding becomes 1."""
    close = F.abs(hi - lo) <= F.lit(CLOSE_ATOL) + F.lit(CLOSE_RTOL) * F.abs(lo)
    return F.when(close, F.lit(1.0)).otherwise((c - lo) / (hi - lo))


def correlation(a: str, b: str, complete: bool = False) -> Column:
    """Aggregate: Pearson correlation over rows with both values; missing when a
    column is constant (the built-in one raises an error there).

    ``complete`` columns have no missing values, so pairs share their deviations.
    """
    if complete:
        return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    x = F.when(F.col(b).isNotNull(), F.col(a))
    y = F.when(F.col(a).isNotNull(), F.col(b))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(x) * F.stddev_pop(y))


def selection_status(in_a: Column, in_b: Column, a: str, b: str) -> Column:
    return (
        F.when(in_a & in_b, "shared")
        .when(in_a, f"{a}_only")
        .when(in_b, f"{b}_only")
        .otherwise("inactive_in_both")
    )


def joined_label(parts: Sequence[Column], sep: str = " | ") -> Column:
    return F.concat_ws(sep, *parts)


def first_names(names: Column, n: int = 5) -> Column:
    """The first ``n`` entries of a name list as one text."""
    return F.array_join(F.slice(names, 1, n), "|")


def with_size_guides(df: DataFrame, n: str, p: str) -> DataFrame:
    """Reference sizes for screening and rank bounds from counts ``n`` and ``p``."""
    nn, pp = F.col(n).cast("double"), F.col(p)
    return df.select(
        "*",
        F.try_divide(nn, F.log(nn)).alias("n_over_log_n"),
        (F.col(n) - 1).alias("n_minus_1"),
        F.least(F.col(n), pp).alias("max_possible_rank"),
        (pp - F.least(F.col(n), pp)).alias("rank_deficiency"),
        (pp > F.col(n)).alias("p_greater_than_n"),
    )
