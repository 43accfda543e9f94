"""Sources and sinks: tables, name lists, summaries, split data sets, models."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstat.functions.scalars import finite_or

PIECE_BYTES = 1024 * 1024


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Headed CSV. Give a schema for large files: inferring one costs an extra pass."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_table(
    spark: SparkSession, folder: str, name: str, columns: Sequence[str] | None = None, spread: bool = False
) -> DataFrame:
    """A parquet table; ``spread`` deals a table of few pieces out over all slots."""
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    df = df.select(*columns) if columns else df
    return spread_out(df) if spread else df


def spread_out(df: DataFrame) -> DataFrame:
    """Deal out a scan of few files that would leave slots idle in the work that follows.

    A parquet file is read by at most one task per row group. Only a table in fewer
    files than slots is shuffled, once, into pieces worth a task; a large table is
    left as it is.
    """
    spark = df.sparkSession
    slots, files = spark.sparkContext.defaultParallelism, df.inputFiles()
    if not files or len(files) >= slots:
        return df
    size = spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0]
    pieces = min(slots, math.ceil(size / PIECE_BYTES))
    return df.repartition(pieces) if pieces > len(files) else df


def read_labelled_matrix(spark: SparkSession, path: str, label: str = "class") -> DataFrame:
    """Wide coefficient CSV whose first, unnamed column is the class, as long rows."""
    wide = read_csv(spark, path)
    first, features = wide.columns[0], wide.columns[1:]
    cells = wide.select(F.col(f"`{first}`").alias(label), *[F.col(f"`{f}`").cast("double").alias(f) for f in features])
    return cells.unpivot([label], features, "feature", "coefficient")


def read_name_list(spark: SparkSession, path: str) -> DataFrame:
    """JSON array of names as (feature, position); anything but an array is refused."""
    whole = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", "array<string>")
    refuse = F.raise_error(F.lit(f"{path} does not hold a JSON list"))
    checked = F.when(F.trim(F.regexp_replace("value", r"\s+", " ")).startswith("["), parsed).otherwise(refuse)
    return whole.select(F.posexplode(checked).alias("position", "feature")).select("feature", "position")


def keep_existing(names: DataFrame, schema_names: DataFrame) -> DataFrame:
    """Listed features that exist in the table, in list order columns."""
    return names.join(schema_names.select("feature"), "feature", "left_semi")


def resolve_features(listed: Sequence[str] | None, available: Sequence[str], strict: bool = False) -> list[str]:
    """A saved feature list cut to what exists; all features when there is no list.

    A list with no existing feature falls back too, unless ``strict``.
    """
    if listed is None:
        return list(available)
    have = set(available)
    kept = [f for f in listed if f in have]
    if not kept and strict:
        raise ValueError("none of the listed features exists in the table")
    return kept or list(available)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_summary(df: DataFrame, path: str, name: str = "summary") -> None:
    """One nested record; infinities are written as null."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    clean = df.withColumns({c: finite_or(F.col(c), None) for c in doubles})
    body = F.struct(F.struct(*df.columns).alias(name))
    clean.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def write_split_tables(df: DataFrame, path: str, split: str = "split") -> None:
    """One table folder per split; X and y are column projections of it."""
    write_table(df, path, [split])


def read_split(spark: SparkSession, path: str, value: str, split: str = "split") -> DataFrame:
    return spark.read.parquet(path).filter(F.col(split) == value)


def save_model(model: Transformer, path: str) -> None:
    wrapped = model if isinstance(model, PipelineModel) else PipelineModel([model])
    wrapped.write().overwrite().save(path)


def load_models(paths: dict[str, str]) -> dict[str, PipelineModel]:
    """Saved models that can be found; a missing one is left out."""
    from pyspark.errors import AnalysisException
    from py4j.protocol import Py4JJavaError

    found = {}
    for name, path in paths.items():
        try:
            found[name] = PipelineModel.load(path)
        except (AnalysisException, Py4JJavaError, OSError) as err:
            if "not exist" not in str(err) and "PATH_NOT_FOUND" not in str(err):
                raise
    return found
