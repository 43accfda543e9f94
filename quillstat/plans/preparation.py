"""From an entry table to clean, split, imputed and standardised features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.functions.scalars import label_map
from quillstat.operators import duplicates, prep, quality, sampling, summaries
from quillstat.plans.tables import Tables
from quillstat.session import keep


@dataclass
class Prepared:
    data: DataFrame  # ids, target, split, standardised features
    features: list[str]
    classes: list[str]
    tables: Tables


def prepare(
    df: DataFrame, key: str, word: str, y: str, display: Mapping[str, str], share: float = sampling.TEST_SHARE,
    seed: int = sampling.SEED, expand: bool = False, max_missing: float | None = None, log_skewed: bool = False,
) -> Prepared:
    """Clean labels, drop exact duplicates, split, impute, expand on request, standardise.

    Repeated words are reported and kept. Everything fitted is fitted on training
    rows: the split comes first, so sparse columns and skewed features are chosen on
    training rows too. Expansion works on imputed raw values, before standardising. The
    two filters by missing share and skew are off by default; the features they touch
    are listed in the tables.
    """
    ids = [key, word, y]
    classes = list(display)
    quality.require_columns(df, ids)
    features = quality.feature_columns(df, ids)
    typed = prep.coerce_numeric(quality.cleaned_labels(df, [word, y]), features)
    valid = quality.with_valid_labels(typed, y, classes)
    clean = duplicates.without_duplicates(valid)
    quality.require_class_size(clean, y)
    split = keep(sampling.with_split(keep(clean), y, [key], share, seed))
    gone: list[str] = []
    logged: list[str] = []
    if max_missing is not None:
        gone = prep.sparse_columns(split.filter("split = 'train'"), features, max_missing)
        features = [f for f in features if f not in gone]
        split = prep.drop_sparse_rows(split.drop(*gone), features, max_missing)
    if log_skewed:
        logged = prep.skewed_features(split.filter("split = 'train'"), features)
        split = prep.log_transform(split, logged)
    train = split.filter("split = 'train'")
    medians = prep.fit_medians(train, features)
    filled = prep.apply_imputation(split, medians)
    if expand:
        names = prep.expanded_names(features)
        filled = prep.expand_columns(filled, features, [*ids, "split"])
    else:
        names = features
    scaling = prep.fit_scaling(filled.filter("split = 'train'"), names)
    scaled = keep(prep.apply_scaling(filled, scaling))
    quality.require_classes(scaled, y, "split", classes, ["train", "test"])
    named = split.withColumn("target_display", label_map(F.col(y), display))
    tables = {
        "label_validity": quality.label_validity(typed, y, classes),
        "duplicate_count": duplicates.duplicate_count(valid),
        "repeated_words": duplicates.repeated_keys(named, [word], ["split", *ids, "target_display"]),
        "class_distribution": summaries.class_distribution_full(split, y, "split", display),
        "missing_before": quality.missing_by_feature(split, features, "split"),
        "missing_columns": quality.missing_columns(split, features, "split"),
        "shape_summary": quality.shape_summary(split, "split", ids, features, key, word),
        "imputation_values": prep.imputation_report(split, "split", medians),
        "scaling_parameters": prep.scaling_report(df.sparkSession, scaling),
        "standardisation_check": quality.standardisation_report(scaled, "split", names),
        "column_filters": df.sparkSession.createDataFrame(
            [*[(f, "left_out_as_sparse") for f in gone], *[(f, "log_transformed") for f in logged]], "feature string, change string"),
        "prepared": scaled,
    }
    return Prepared(scaled, names, classes, tables)
