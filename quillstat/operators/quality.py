"""Schema checks and data-quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstat.functions.scalars import clean_text, first_names
from quillstat.functions.skew import excess_rows
from quillstat.operators.moments import feature_moments

EXPECTED_BASE_WIDTH = 65
EXPECTED_EXPANDED_WIDTH = 2210


# --- schema only, no job -------------------------------------------------------------

def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")


def feature_columns(df: DataFrame, ids: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(ids)]


def check_width(features: Sequence[str], expected: int = EXPECTED_BASE_WIDTH, strict: bool = False) -> bool:
    """True when the width is as expected; otherwise False, or an error if strict."""
    if len(features) == expected:
        return True
    if strict:
        raise ValueError(f"expected {expected} features, found {len(features)}")
    return False


def non_numeric_features(df: DataFrame, features: Sequence[str]) -> list[str]:
    return [f for f in features if not isinstance(df.schema[f].dataType, T.NumericType)]


def require_numeric(df: DataFrame, features: Sequence[str]) -> None:
    bad = non_numeric_features(df, features)
    if bad:
        raise ValueError(f"features are not numeric: {bad}")


def require_features(train: DataFrame, test: DataFrame, names: Sequence[str]) -> None:
    lost = {
        side: sorted(set(names) - set(df.columns))
        for side, df in (("train", train), ("test", test))
        if set(names) - set(df.columns)
    }
    if lost:
        raise ValueError(f"selected features are missing: {lost}")


def alignment_report(
    spark: SparkSession, train: Sequence[str], test: Sequence[str], names: Sequence[str], strict: bool = True
) -> DataFrame:
    """Ordered equality of train columns, test columns and the saved list."""
    pairs = [
        ("train_columns_match_feature_names", train, names),
        ("test_columns_match_feature_names", test, names),
        ("train_test_columns_match", train, test),
    ]
    rows = []
    for check, left, right in pairs:
        same = list(left) == list(right)
        only_left, only_right = sorted(set(left) - set(right)), sorted(set(right) - set(left))
        rows.append((check, same, "same names, same order" if same else f"extra {only_left}, lacking {only_right}"))
    failed = [r for r in rows if not r[1]]
    if failed and strict:
        raise ValueError(f"features are not aligned: {failed}")
    return spark.createDataFrame(rows, "check string, passed boolean, details string")


def matrix_report(train: DataFrame, test: DataFrame, names: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Width, order, metadata and type checks with the values seen on both sides."""
    left, right = feature_columns(train, ids), feature_columns(test, ids)
    texts_left, texts_right = non_numeric_features(train, left), non_numeric_features(test, right)
    rules = train.sparkSession.createDataFrame([
        ("same_number_of_features", len(left) == len(right), left, right, False),
        ("same_feature_order", left == right, left, right, True),
        ("same_as_metadata", left == list(names), left, list(names), False),
        ("train_all_numeric", not texts_left, texts_left, None, False),
        ("test_all_numeric", not texts_right, None, texts_right, False),
    ], "check string, passed boolean, a array<string>, b array<string>, by_name boolean")

    def shown(side: str, name: str) -> Column:
        cut = F.when(F.size(side) > 5, "...").otherwise("")
        value = F.when(F.col("by_name"), F.concat(first_names(F.col(side)), cut)).otherwise(F.size(side).cast("string"))
        return F.when(F.col(side).isNull(), "").otherwise(value).alias(name)

    return rules.select("check", "passed", shown("a", "train_value"), shown("b", "test_value"))


# --- labels --------------------------------------------------------------------------

def cleaned_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: clean_text(F.col(c)) for c in columns})


def with_valid_labels(df: DataFrame, y: str, valid: Sequence[str]) -> DataFrame:
    return df.filter(F.col(y).isin(list(valid)))


def label_validity(df: DataFrame, y: str, valid: Sequence[str]) -> DataFrame:
    """Rows kept and rows with an unknown or missing label."""
    ok = F.coalesce(F.col(y).isin(list(valid)), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count(F.when(ok, 1)).alias("rows_valid"),
        F.count(F.when(~ok, 1)).alias("rows_invalid"),
    )


def require_valid_labels(df: DataFrame, y: str, valid: Sequence[str]) -> None:
    bad = label_validity(df, y, valid).first()["rows_invalid"]
    if bad:
        raise ValueError(f"{bad} rows carry a label outside {list(valid)}")


def smallest_class(df: DataFrame, y: str) -> DataFrame:
    return df.groupBy(y).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n").alias("smallest_class"))


def require_class_size(df: DataFrame, y: str, least: int = 2) -> None:
    n = smallest_class(df, y).first()["smallest_class"]
    if n is None or n < least:
        raise ValueError(f"the smallest class has {n} rows, at least {least} are needed")


def class_presence(df: DataFrame, y: str, split: str, classes: Sequence[str], splits: Sequence[str]) -> DataFrame:
    """Rows per (split, class) over the full grid of both; absent pairs count 0."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(s, c) for s in splits for c in classes], f"{split} string, {y} string")
    counts = df.groupBy(split, y).agg(F.count(F.lit(1)).alias("n"))
    return (
        F.broadcast(grid).join(counts, [split, y], "left")
        .select(split, y, F.coalesce("n", F.lit(0)).alias("n"), F.col("n").isNotNull().alias("present"))
    )


def require_classes(df: DataFrame, y: str, split: str, classes: Sequence[str], splits: Sequence[str]) -> None:
    gone = class_presence(df, y, split, classes, splits).filter(~F.col("present")).collect()
    if gone:
        raise ValueError(f"classes without rows: {[(r[split], r[y]) for r in gone]}")


# --- missing values ------------------------------------------------------------------

def is_missing(c: str, dtype: T.DataType) -> Column:
    col = F.col(f"`{c}`")
    return col.isNull() | F.isnan(col) if isinstance(dtype, (T.DoubleType, T.FloatType)) else col.isNull()


def _missing(df: DataFrame, c: str) -> Column:
    return is_missing(c, df.schema[c].dataType)


def any_missing(df: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [_missing(df, c) for c in columns])


def missing_cells(df: DataFrame, columns: Sequence[str]) -> Column:
    """Aggregate: missing cells over all the columns."""
    per_row = reduce(lambda a, b: a + b, [_missing(df, c).cast("long") for c in columns])
    return F.coalesce(F.sum(per_row), F.lit(0))


def missing_by_feature(df: DataFrame, features: Sequence[str], split: str | None = None) -> DataFrame:
    """Missing count and percent per feature, and per split if one is named.

    One pass over wide rows; only the one-row-per-split result is unpivoted.
    """
    keys = [split] if split else []
    n = F.count(F.lit(1)).alias("_n")
    counted = df.groupBy(*keys).agg(n, *[F.count(F.when(_missing(df, f), 1)).alias(f) for f in features])
    long = counted.unpivot([*keys, "_n"], list(features), "feature", "missing_count")
    return long.select(
        *keys, "feature", "missing_count", F.try_divide(F.lit(100.0) * F.col("missing_count"), F.col("_n")).alias("missing_percent")
    )


def missing_by_stage(slices: Mapping[tuple[str, str], DataFrame], features: Sequence[str]) -> DataFrame:
    """The missing report over (split, stage) slices as one table."""
    parts = [
        missing_by_feature(df, features).select(F.lit(s).alias("split"), F.lit(stage).alias("stage"), "*")
        for (s, stage), df in slices.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def missing_columns(df: DataFrame, features: Sequence[str], split: str) -> DataFrame:
    """Only columns with missing values, as (split, column, n_missing, missing_rate)."""
    return (
        missing_by_feature(df, features, split)
        .filter(F.col("missing_count") > 0)
        .select(split, F.col("feature").alias("column"), F.col("missing_count").alias("n_missing"),
                (F.col("missing_percent") / 100.0).alias("missing_rate"))
    )


def row_completeness(df: DataFrame, features: Sequence[str]) -> DataFrame:
    gap = any_missing(df, features)
    return df.agg(
        F.count(F.when(gap, 1)).alias("rows_with_missing"),
        F.count(F.when(~gap, 1)).alias("complete_rows"),
        missing_cells(df, features).alias("missing_cells"),
    )


# --- shapes --------------------------------------------------------------------------

def shape_summary(
    df: DataFrame, split: str, ids: Sequence[str], features: Sequence[str], key: str, word: str
) -> DataFrame:
    """Sizes, missing cells and repeats per split and over all rows ("total").

    Each kind of repeat is its own narrow aggregation, so only the exact-duplicate
    count reads whole rows.
    """
    columns = [*ids, *features]
    base = df.rollup(F.col(split).alias("split")).agg(
        F.count(F.lit(1)).alias("n_observations"), missing_cells(df, columns).alias("n_missing_cells")
    ).withColumn("split", F.coalesce("split", F.lit("total")))
    repeats = [
        excess_rows(df, columns, split, "n_exact_duplicate_rows"),
        excess_rows(df, [key], split, "n_duplicated_ids"),
        excess_rows(df, [word], split, "n_duplicated_words"),
    ]
    out = reduce(lambda a, b: a.join(b, "split"), repeats, base)
    return out.select(
        "split", "n_observations",
        F.lit(len(columns)).alias("n_total_columns"), F.lit(len(ids)).alias("n_identifier_columns"),
        F.lit(len(features)).alias("n_features"), "n_missing_cells", "n_exact_duplicate_rows",
        "n_duplicated_ids", "n_duplicated_words",
    )


def class_shape_wide(
    df: DataFrame, split: str, y: str, features: Sequence[str], classes: Sequence[str]
) -> DataFrame:
    """One wide row per split and "combined": n, p, missing cells, class sizes and shares."""
    n = F.count(F.lit(1))
    cells = []
    for c in classes:
        hits = F.count(F.when(F.col(y) == c, 1))
        cells += [hits.alias(f"n_{c}"), F.try_divide(hits, n).alias(f"pct_{c}")]
    return df.rollup(F.col(split).alias("split")).agg(
        n.alias("n_observations"), F.lit(len(features)).alias("n_features"),
        missing_cells(df, features).alias("n_missing_values"), *cells,
    ).withColumn("split", F.coalesce("split", F.lit("combined")))


def dataset_facts(df: DataFrame, split: str, y: str, n_features: int, n_selected: int) -> DataFrame:
    """Sizes and class counts as (metric, value) rows."""
    by_split = df.groupBy(F.col(split).alias("s")).agg(F.count(F.lit(1)).alias("value"))
    by_class = df.groupBy(F.col(split).alias("s"), F.col(y).alias("c")).agg(F.count(F.lit(1)).alias("value"))
    width = df.groupBy().agg(F.lit(n_features).cast("long").alias("n_features"),
                             F.lit(n_selected).cast("long").alias("n_selected_features"))
    return (
        by_split.select(F.concat(F.lit("n_"), "s").alias("metric"), "value")
        .unionByName(by_class.select(F.concat(F.lit("n_"), "s", F.lit("_"), "c").alias("metric"), "value"))
        .unionByName(width.unpivot([], ["n_features", "n_selected_features"], "metric", "value"))
    )


def standardisation_report(df: DataFrame, split: str, features: Sequence[str], zero: float = 1e-12) -> DataFrame:
    """How close each split is to mean 0 and population std 1."""
    m, s = F.col("mean"), F.col("s")
    per = feature_moments(df, [split], features).withColumn("s", F.sqrt(F.try_divide("m2", "n")))
    return per.groupBy(split).agg(
        F.max(F.abs(m)).alias("max_abs_feature_mean"), F.avg(F.abs(m)).alias("mean_abs_feature_mean"),
        F.min(s).alias("min_feature_std"), F.max(s).alias("max_feature_std"),
        F.avg(s).alias("mean_feature_std"),
        F.count(F.when(F.abs(s) <= zero, 1)).alias("n_zero_variance_features"),
    )
