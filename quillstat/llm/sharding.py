"""Proportional stratified interleaving of rows over shards, with DataFrame functions only.

Rows of a stratum (source) are put in a seeded hash order. The row at place r of n gets the
fractional rank (2r-1)/(2n). Sorting all rows by that number interleaves the strata in
proportion, so each of ``shards`` even cuts has the mixture of the whole and sizes differ by
one row at most (law ``rows``).

No window ever holds a whole stratum: places are counted per (stratum, hash bucket) and per
slice of the fractional rank, about sqrt(rows) of each, and only the rows of one bucket or
slice are ordered together.

Defined cases: null source is a stratum of its own; null text has size 16; rows with the same
id are ordered by size, then checksum; rows equal in all of these are interchangeable; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstat.llm.common import cut, text_or_empty

SHARDS = 40
SEED = "interleave-1"
ROW_OVERHEAD = 16


def interleaved(df: DataFrame, shards: int = SHARDS, seed: str = SEED, key: str = "doc_id", text: str = "text",
                stratum: str = "source") -> DataFrame:
    """key, size, text_crc32, shard, slot for every row of ``df``."""
    body = text_or_empty(text).cast("binary")
    keyed = cut(df.select(
        F.col(key).alias("_id"),
        F.coalesce(F.concat(F.lit("s"), F.col(stratum)), F.lit("n")).alias("_stratum"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary")).alias("_hash"),
        (F.octet_length(body) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32")))
    total = keyed.count()
    parts = max(1, math.isqrt(total))
    start = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long")
    keyed = keyed.withColumn("_bucket", F.shiftright(start * F.lit(parts), 32))

    in_order = Window.partitionBy("_stratum").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = cut(
        keyed.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(in_order), F.lit(0)))
        .withColumn("_of", F.sum("_n").over(Window.partitionBy("_stratum"))).drop("_n"))
    ties = ["_hash", "_id", "size", "text_crc32"]
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_stratum", "_bucket").orderBy(*ties))
    ranked = keyed.join(buckets, ["_stratum", "_bucket"]).withColumn(
        "_fraction", (2 * place - 1).cast("double") / (2 * F.col("_of")).cast("double"))
    ranked = cut(ranked.withColumn("_slice", F.least(F.floor(F.col("_fraction") * parts), F.lit(parts - 1)))
                 .drop("_before", "_of", "_bucket"))

    slices = cut(
        ranked.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(
            Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n"))
    position = F.col("_before") + F.row_number().over(
        Window.partitionBy("_slice").orderBy("_fraction", "_stratum", *ties)) - 1
    placed = ranked.join(slices, "_slice").withColumn("_at", position.cast("long"))
    rows = F.lit(max(total, 1)).cast("long")
    shard = F.floor(F.col("_at") * shards / rows) if total == 0 else F.expr(f"(_at * {shards}L) div {total}L")
    return placed.withColumn("_shard", shard.cast("long")).select(
        F.col("_id").alias(key), "size", "text_crc32", F.col("_shard").cast("int").alias("shard"),
        (F.col("_at") - F.expr(f"(_shard * {total}L + {shards - 1}L) div {shards}L")).cast("long").alias("slot"))


def shard_rows(df: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    return interleaved(df, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


#: crc32 bit by bit: the table of 256 remainders, then one step for each byte of the text.
SQL = f"""
WITH t AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(CAST(n AS BIGINT), CAST(range(8) AS BIGINT[])),
  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step),
d AS (SELECT doc_id, coalesce('s' || source, 'n') AS stratum, md5('{SEED}:' || doc_id) AS h, encode(coalesce(text, '')) AS body FROM documents),
c AS (SELECT doc_id, stratum, h, CAST(octet_length(body) + {ROW_OVERHEAD} AS BIGINT) AS size,
  xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(body), '..'), lambda x: CAST('0x' || x AS BIGINT))),
    lambda a, b: xor(a >> 8, step[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32 FROM d, t),
r AS (SELECT *, CAST(2 * row_number() OVER (PARTITION BY stratum ORDER BY h, doc_id, size, text_crc32) - 1 AS DOUBLE)
  / CAST(2 * count(*) OVER (PARTITION BY stratum) AS DOUBLE) AS f FROM c),
g AS (SELECT *, row_number() OVER (ORDER BY f, stratum, h, doc_id, size, text_crc32) - 1 AS pos, count(*) OVER () AS n FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST((pos * {SHARDS}) // n AS INTEGER) AS shard,
  CAST(pos - (((pos * {SHARDS}) // n) * n + {SHARDS - 1}) // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM g"""
