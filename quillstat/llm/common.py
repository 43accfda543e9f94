"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import zlib
from collections.abc import Callable, Hashable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstat.session import cut_lineage, ensure_checkpoint_dir

#: Rows of one Arrow batch. Documents may be long, so a batch must stay small.
BATCH_ROWS = 500
BITS_PER_KEY = 16


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named parquet table, or only its ``columns``."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once in the shared folder and read back."""
    return cut_lineage(df)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch in this session; a smaller bound stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def frames(schema_columns: Sequence[str], rows: Iterable[tuple], size: int = 2000) -> Iterator[pd.DataFrame]:
    """Rows as pandas frames of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pd.DataFrame(held, columns=list(schema_columns))
            held = []
    if held:
        yield pd.DataFrame(held, columns=list(schema_columns))


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as decimal text, modulo ``divisor``."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def bounded_rows(df: DataFrame, key: str, rows: int, seed: int = 17) -> DataFrame:
    """At most ``rows`` rows chosen by a hash of ``key``; the same ones for any partitioning.

    The share is set from a count, so a task hands on only about its part of the sample;
    the limit then orders by the same hash.
    """
    total = df.count()
    if total == 0:
        return df
    mark = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30))
    share = min(1.0, 1.2 * rows / total + 100 / total)
    return df.filter(mark < F.lit(int(share * (1 << 30)))).orderBy(mark, F.col(key)).limit(rows)


def labelled_sample(documents: DataFrame, labels: DataFrame, learn: Column, label: str, key: str, text: str, rows: int,
                    characters: int) -> DataFrame:
    """_id, _y, _text of labelled rows to learn from: at most ``rows`` of them, chosen by a hash
    of their id, and in that order no more than ``characters`` characters together.

    Null ids and null labels are left out; an id that repeats counts once, with its least label
    and least text.
    """
    known = labels.filter(learn & F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(
        F.col(key).alias("_id")).agg(F.min(F.col(label).cast("int")).alias("_y"))
    chosen = cut(bounded_rows(known, "_id", rows))
    texts = documents.select(F.col(key).alias("_id"), text_or_empty(text).alias("_text"))
    sizes = texts.select("_id", F.length("_text").alias("_n")).join(F.broadcast(chosen), "_id").groupBy("_id").agg(
        F.max("_n").alias("_n"), F.xxhash64(F.lit(17), F.col("_id")).alias("_mark")).orderBy("_mark", "_id").collect()
    total, ids = 0, []
    for row in sizes:
        total += row["_n"]
        if total > characters and ids:
            break
        ids.append(row["_id"])
    wanted = documents.sparkSession.createDataFrame([(i,) for i in ids], "_id long")
    taken = F.broadcast(chosen.join(F.broadcast(wanted), "_id"))
    return texts.join(taken, "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text"))


def split_by_keys(df: DataFrame, keys: DataFrame, *names: str) -> tuple[DataFrame, DataFrame]:
    """(maybe, rest): rows of ``df`` whose ``names`` may be among those of ``keys`` (a written table), and rows whose surely are not.

    The keys are hashed into 64-bit words, ``BITS_PER_KEY`` bits a key: a broadcast table of about 3 to 6 bytes a key. It also
    takes about 6 % of the other rows for ``maybe``, so that is what a join of long rows with few keys has to shuffle.
    """
    words = 1 + keys.count() * BITS_PER_KEY // 64
    slot = lambda rows: rows.withColumn("_mark", F.xxhash64(*names)).withColumns({
        "_word": F.expr(f"pmod(_mark, {words}L)"), "_bit": F.expr(f"shiftleft(1L, cast(pmod(_mark div {words}L, 64L) as int))")})
    table = cut(slot(keys).groupBy("_word").agg(F.bit_or("_bit").alias("_bits")))
    marked = slot(df).join(F.broadcast(table), "_word", "left")
    hit = F.coalesce(F.col("_bits").bitwiseAND(F.col("_bit")) != 0, F.lit(False))
    return marked.filter(hit).select(*df.columns), marked.filter(~hit).select(*df.columns)


_HELD: dict[tuple, object] = {}


def held(make: Callable, *args: Hashable):
    """``make(*args)``, made once in a Python worker and kept there until it holds something else.

    A worker outlives the stages of a pipeline, so what each operator kept for good would add up. Readers and their
    memos refer to each other, so the last one goes with a collection.
    """
    key = (make, *args)
    if key not in _HELD:
        _HELD.clear()
        gc.collect()
        _HELD[key] = make(*args)
    return _HELD[key]


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


class Memo(dict):
    """Values made on first use, kept for at most twice ``size`` short keys.

    Two generations: when the young one is full it becomes the old one, so frequent keys
    stay and memory is bounded. ``memo[key]`` is always right, whether kept or made anew.
    """

    def __init__(self, make, size: int, longest: int = 64):
        super().__init__()
        self.make, self.size, self.longest, self.old = make, size, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
