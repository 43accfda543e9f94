"""Imputation, standardisation, second-degree expansion and column filters.

Every ``fit_*`` reads the training rows once or a few times and returns one number
per feature; ``apply_*`` puts these in as literals, so applying is a narrow
projection that Catalyst folds into the scan stage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.functions.ordering import exact_quantiles
from quillstat.functions.scalars import to_number
from quillstat.operators.quality import is_missing

CHUNK = 200  # expressions per aggregate, to stay within one generated method


def to_long(df: DataFrame, ids: Sequence[str], features: Sequence[str]) -> DataFrame:
    """(ids, feature, value) rows; missing values are kept."""
    doubles = df.select(*ids, *[F.col(f"`{f}`").cast("double").alias(f) for f in features])
    return doubles.unpivot(list(ids), list(features), "feature", "value")


def coerce_numeric(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({f: to_number(F.col(f)) for f in features})


# --- imputation ----------------------------------------------------------------------

def fit_medians(train: DataFrame, features: Sequence[str], order_rows: int = 1_000_000) -> dict[str, float | None]:
    """Exact medians, the middle two values averaged for an even count."""
    return exact_quantiles(to_long(train, [], features), 0.5, order_rows=order_rows)


def apply_imputation(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    return df.withColumns({
        f: F.coalesce(F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")), F.lit(m).cast("double"))
        for f, m in medians.items()
    })


def imputation_report(df: DataFrame, split: str, medians: dict[str, float | None]) -> DataFrame:
    """Value used per feature with the missing counts of both splits before filling."""
    spark = df.sparkSession
    features = list(medians)
    gaps = [
        F.count(F.when((F.col(split) == s) & is_missing(f, df.schema[f].dataType), 1)).alias(f"{s}:{f}")
        for s in ("train", "test") for f in features
    ]
    row = df.agg(*gaps).first()
    return spark.createDataFrame(
        [(f, "median", medians[f], row[f"train:{f}"], row[f"test:{f}"]) for f in features],
        "feature string, imputation_strategy string, imputation_value_fitted_on_train double, "
        "train_missing_count_before long, test_missing_count_before long",
    )


# --- standardisation -----------------------------------------------------------------

@dataclass(frozen=True)
class Scaling:
    mean: dict[str, float]
    std: dict[str, float]


def fit_scaling(train: DataFrame, features: Sequence[str]) -> Scaling:
    """Train mean and population standard deviation; a zero deviation divides by 1."""
    mean: dict[str, float] = {}
    std: dict[str, float] = {}
    for i in range(0, len(features), CHUNK):
        part = features[i : i + CHUNK]
        row = train.agg(
            *[F.avg(f).alias(f"m:{f}") for f in part], *[F.stddev_pop(f).alias(f"s:{f}") for f in part]
        ).first()
        for f in part:
            mean[f] = row[f"m:{f}"]
            std[f] = row[f"s:{f}"]
    return Scaling(mean, std)


def apply_scaling(df: DataFrame, scaling: Scaling) -> DataFrame:
    return df.withColumns({
        f: (F.col(f"`{f}`") - F.lit(m)) / F.lit(scaling.std[f] or 1.0) for f, m in scaling.mean.items()
    })


def scaling_report(spark, scaling: Scaling) -> DataFrame:
    return spark.createDataFrame(
        [(f, m, scaling.std[f]) for f, m in scaling.mean.items()],
        "feature string, train_mean_used_for_scaling double, train_std_used_for_scaling double",
    )


# --- second-degree expansion ---------------------------------------------------------

def expansion(features: Sequence[str]) -> dict[str, Column]:
    """Name and expression of every term: originals, squares, then products."""
    terms = {f: F.col(f) for f in features}
    terms |= {f"{f}_sq": F.col(f) * F.col(f) for f in features}
    terms |= {
        f"{a}_x_{b}": F.col(a) * F.col(b) for i, a in enumerate(features) for b in features[i + 1 :]
    }
    return terms


def expand_columns(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Expanded table with one column per term, for a few dozen features."""
    return df.select(*keep, *[e.alias(n) for n, e in expansion(features).items()])


def expanded_names(features: Sequence[str]) -> list[str]:
    products = [f"{a}_x_{b}" for i, a in enumerate(features) for b in features[i + 1 :]]
    return [*features, *[f"{f}_sq" for f in features], *products]


def expand_array(values: Column) -> Column:
    """The same terms, in the same order, of an array of values as one array."""
    squares = F.transform(values, lambda v: v * v)
    products = F.flatten(
        F.transform(
            values,
            lambda v, i: F.transform(F.slice(values, i + 2, F.size(values)), lambda w: v * w),
        )
    )
    return F.concat(values, squares, products)


# --- filters named in the reference's description ------------------------------------

def sparse_columns(df: DataFrame, features: Sequence[str], most: float) -> list[str]:
    """Features whose share of missing values exceeds ``most``."""
    gaps = [F.count(F.when(is_missing(f, df.schema[f].dataType), 1)).alias(f) for f in features]
    row = df.agg(F.count(F.lit(1)).alias("_n"), *gaps).first()
    n = row["_n"] or 1
    return [f for f in features if row[f] / n > most]


def drop_sparse_rows(df: DataFrame, features: Sequence[str], most: float) -> DataFrame:
    gaps = sum((is_missing(f, df.schema[f].dataType).cast("int") for f in features), F.lit(0))
    return df.filter(gaps <= F.lit(most * len(features)))


def skewness_table(df: DataFrame, features: Sequence[str]) -> DataFrame:
    row = df.agg(*[F.skewness(f).alias(f) for f in features], *[F.min(f).alias(f"lo:{f}") for f in features])
    cells = [F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").alias("skewness"),
                      F.col(f"`lo:{f}`").cast("double").alias("smallest")) for f in features]
    return row.select(F.inline(F.array(*cells)))


def skewed_features(df: DataFrame, features: Sequence[str], limit: float = 1.0) -> list[str]:
    """Right-skewed features without negative values, which a log can straighten."""
    hit = skewness_table(df, features).filter((F.col("skewness") > limit) & (F.col("smallest") >= 0))
    return [r["feature"] for r in hit.collect()]


def log_transform(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({f: F.log1p(F.col(f)) for f in features})
