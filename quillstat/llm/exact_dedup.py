"""Exact duplicates: group by a 128-bit content hash, then compare the bytes of each group.

Only DataFrame functions. Texts are equal when identical after every run of ASCII white
space becomes one space; null counts as empty.

* Fingerprints (id and hashes, no text) are written once; grouping them combines before the
  shuffle, so a group that holds a third of the rows costs one row per task.
* The bytes of a group are compared by the least and the greatest text of each group that
  has more than one row: they are the same exactly when all texts of the group are the
  same. Groups that fail are regrouped by their whole text.
* Joins run against tables read from storage, so adaptive execution may split hot keys. Whole
  rows are joined only where a small bit table of the repeated hashes says they may be repeated.

Defined cases: a null id sorts after all others; rows repeated with the same id and equal
text are one document, of which one row stays; an empty table gives an empty result; columns
other than id and text play no part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.llm.common import cut, split_by_keys, text_or_empty

WHITE_SPACE = r"[\x20\x09-\x0D]+"
Digest = Callable[[Column], Column]


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(text_or_empty(text), WHITE_SPACE, " ")


def md5_digest(body: Column) -> Column:
    return F.unhex(F.md5(body.cast("binary")))


def duplicate_groups(df: DataFrame, key: str, text: str, digest: Digest = md5_digest) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, repeated, clashing).

    rows: _digest, text_sha256, _id, _copies, one row per hash and id;
    repeated: _digest, keep_id, group_size of groups with more than one row;
    clashing: _digest of groups whose texts differ.
    """
    body = normalised(text)
    prints = df.select(digest(body).alias("_digest"), F.sha2(body.cast("binary"), 256).alias("text_sha256"),
                       F.col(key).alias("_id"))
    rows = cut(prints.groupBy("_digest", "text_sha256", "_id").agg(F.count(F.lit(1)).alias("_copies")))
    repeated = cut(
        rows.groupBy("_digest").agg(F.min("_id").alias("keep_id"), F.sum("_copies").alias("group_size"))
        .filter(F.col("group_size") > 1)
    )
    bodies, _ = split_by_keys(df.select(digest(body).alias("_digest"), body.alias("_body")), repeated, "_digest")
    bodies = bodies.join(repeated.select("_digest"), "_digest", "left_semi")
    clashing = cut(
        bodies.groupBy("_digest").agg(F.min("_body").alias("_low"), F.max("_body").alias("_high"))
        .filter(F.col("_low") != F.col("_high")).select("_digest")
    )
    return rows, repeated, clashing


def _by_whole_text(df: DataFrame, key: str, text: str, digest: Digest, clashing: DataFrame) -> DataFrame:
    """Rows of clashing hashes, grouped by their bytes."""
    body = normalised(text)
    rows = df.select(digest(body).alias("_digest"), body.alias("_body"), F.col(key).alias("_id")).join(
        clashing, "_digest", "left_semi")
    per = cut(rows.groupBy("_body", "_id").agg(F.count(F.lit(1)).alias("_copies")))
    groups = cut(per.groupBy("_body").agg(F.min("_id").alias("keep_id"), F.sum("_copies").alias("group_size")))
    return per.join(groups, "_body")


def exact_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", digest: Digest = md5_digest) -> DataFrame:
    """One row per row of ``df``: key, keep_id, group_size, kept, text_sha256."""
    rows, repeated, clashing = duplicate_groups(df, key, text, digest)
    columns = ["_id", "_copies", "keep_id", "group_size", "text_sha256"]
    plain, clash = rows, not clashing.isEmpty()
    if clash:
        plain = rows.join(clashing, "_digest", "left_anti")
    marked = plain.join(repeated, "_digest", "left").select(
        "_id", "_copies",
        F.when(F.col("group_size").isNull(), F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "text_sha256")
    if clash:
        whole = _by_whole_text(df, key, text, digest, clashing).withColumn(
            "text_sha256", F.sha2(F.col("_body").cast("binary"), 256))
        marked = marked.unionByName(whole.select(*columns))
    copies = F.posexplode(F.array_repeat(F.lit(True), F.col("_copies").cast("int"))).alias("_copy", "_one")
    return marked.select("*", copies).select(
        F.col("_id").alias(key), "keep_id", "group_size",
        (F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 0)).alias("kept"), "text_sha256")


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text", digest: Digest = md5_digest) -> DataFrame:
    """The rows of ``df``, all its columns, without later copies of an equal text."""
    names = df.columns
    rows, repeated, clashing = duplicate_groups(df, key, text, digest)
    body = normalised(text)
    mine = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(key).alias("_id"),
                     digest(body).alias("_digest"))
    if not clashing.isEmpty():
        groups = _by_whole_text(df, key, text, digest, clashing).groupBy("_body").agg(
            F.min("_id").alias("_first"))
        held = mine.join(clashing, "_digest", "left_semi").withColumn("_body", normalised(F.col(f"_row.`{text}`")))
        exact = held.join(cut(groups), "_body").filter(F.col("_id").eqNullSafe(F.col("_first"))).dropDuplicates(
            ["_body"]).select("_row")
        mine = mine.join(clashing, "_digest", "left_anti")
    else:
        exact = None
    mine, alone = split_by_keys(mine, repeated, "_digest")
    marked = mine.join(repeated, "_digest", "left").filter(
        F.col("group_size").isNull() | F.col("_id").eqNullSafe(F.col("keep_id")))
    twice = cut(rows.filter(F.col("_copies") > 1).select("_digest", "_id"))
    if not twice.isEmpty():
        same = (marked["_digest"] == twice["_digest"]) & marked["_id"].eqNullSafe(twice["_id"])
        marked = marked.join(twice, same, "left_anti").select("_row").unionByName(
            marked.join(twice, same, "left_semi").dropDuplicates(["_digest"]).select("_row"))
    else:
        marked = marked.select("_row")
    marked = marked.unionByName(alone.select("_row"))
    if exact is not None:
        marked = marked.unionByName(exact)
    return marked.select(*[F.col("_row").getField(c).alias(c) for c in names])


SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.body) AS text_sha256
FROM d JOIN g USING (body)"""
