"""Prefix trie of conversations, its subtree totals by time-forward processing.

A rebuilt conversation is the beginning of its family's first conversation, then its own rest
(``rebuilt_turns``). A node is a distinct sequence of first turns, known by its depth and the
XOR of a 128-bit hash of every (depth, role, text) on the way, so a node's parent's key is its
own key XOR its last turn's hash, and prefixes of a conversation of any length are running
XORs over blocks of BLOCK turns.

Shards: a node is a shard root if its subtree, counted in member turns, is no larger than
``shard_turns`` while its parent's is; subtrees below shard roots are dealt to tasks whole and
handled in reverse level order (``time_forward``). What the shard roots bring is summed by
parent, and the same procedure runs over the few larger nodes above them, at most
(turns / shard_turns) at each depth.

No step needs the turns of a conversation, the members of a node or the children of a node in
one task, but for one: SHA-256 over all ids that end at a node is sequential by its nature. The
ids are sorted and joined to text in slices by many tasks, and one task only feeds the slices
to the hash, keeping none.

Defined cases: rows without conv_id belong to no conversation and are left out; null role or
text is empty; turns of a conversation are ordered by turn, null first, equal turns by the
MD5 of role and text, and repeated rows stay as turns of their own; conv_id - conv_id % 5
follows SQL's remainder (negative ids: toward zero); an empty table has no nodes, not even
a root.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstat.llm.common import cut, text_or_empty
from quillstat.llm.time_forward import DONE_SCHEMA, NODE, QUEUE_MESSAGES, totals_in_batches

FAMILY = 5
LENGTHS = 9
BLOCK = 1_024
SHARD_TURNS = 20_000
MOST_SHARDS = 10_000
IDS_IN_SLICE = 4_096
KEY = ["depth", "p1", "p2"]


def _turn_digest() -> F.Column:
    role, text = text_or_empty("role"), text_or_empty("text")
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def placed_turns(df: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest, bytes of every turn.

    Rows are sorted by range over all tasks, numbered in each, and the one conversation that goes on from an
    earlier range gets the turns counted there added.
    """
    turns = df.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", _turn_digest().alias("digest"),
        F.octet_length(text_or_empty("text")).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("_row"))
    order = ["conv_id", F.asc_nulls_first("turn"), "digest", "_row"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at = None, 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            new = np.append(True, ids[1:] != ids[:-1])
            new[0] = last is None or ids[0] != last
            place = np.arange(1, len(ids) + 1)
            begun = np.maximum.accumulate(np.where(new, place, 0))
            place = np.where(begun > 0, place - begun + 1, place + at)
            last, at = ids[-1], int(place[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], [*batch.schema.names, "_at"])

    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "digest", "bytes", F.spark_partition_id().alias("_part"))
    local = cut(ordered.mapInArrow(number, "conv_id long, digest binary, bytes long, _part int, _at long"))
    earlier = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = local.groupBy("conv_id", "_part").agg(F.max("_at").alias("_n")).select(
        "conv_id", "_part", F.sum("_n").over(earlier).alias("_before")).filter("_before IS NOT NULL")
    return local.join(F.broadcast(before), ["conv_id", "_part"], "left").select(  # one row for each task at most
        "conv_id", (F.col("_at") + F.coalesce("_before", F.lit(0))).alias("pos"), "digest", "bytes")


def rebuilt_turns(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, length, digest, bytes) and lengths (conv_id, length) of the rebuilt conversations."""
    turns = cut(placed_turns(df))
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    families = sizes.select("n", "conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
                            (F.crc32(F.col("conv_id").cast("string").cast("binary")) % LENGTHS).alias("h"))
    first = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    lengths = cut(families.join(first, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))).select(
        "conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    own = turns.join(lengths, "conv_id").filter("pos > h").withColumn("depth", F.col("pos") - F.col("h") + F.col("taken"))
    shared = turns.filter(F.col("pos") < LENGTHS).withColumnRenamed("conv_id", "base").join(lengths, "base").filter(
        "pos <= taken").withColumn("depth", F.col("pos"))
    columns = ["conv_id", "depth", "length", "digest", "bytes"]
    return own.select(columns).unionByName(shared.select(columns)), lengths.select("conv_id", "length")


def paths(rebuilt: DataFrame) -> DataFrame:
    """``rebuilt`` with e1, e2 (hash of depth and turn) and p1, p2 (the XOR of these from the first turn on)."""
    turns = cut(rebuilt.withColumn("e1", F.xxhash64(F.lit(11), "depth", "digest")).withColumn(
        "e2", F.xxhash64(F.lit(23), "depth", "digest")).withColumn("_block", F.expr(f"(depth - 1) div {BLOCK}")))
    so_far = Window.partitionBy("conv_id", "_block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = turns.filter(F.col("length") > BLOCK).groupBy("conv_id", "_block").agg(
        F.bit_xor("e1").alias("b1"), F.bit_xor("e2").alias("b2"))
    blocks = blocks.select("conv_id", "_block", *[F.bit_xor(b).over(earlier).alias(b) for b in ("b1", "b2")]).filter("b1 IS NOT NULL")
    out = turns.withColumns({f"p{i}": F.bit_xor(f"e{i}").over(so_far) for i in (1, 2)}).join(blocks, ["conv_id", "_block"], "left")
    return out.withColumns({f"p{i}": F.col(f"p{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0).cast("long"))) for i in (1, 2)}).drop(
        "_block", "b1", "b2")


def end_hashes(ends: DataFrame) -> DataFrame:
    """KEY, ends_sha256 of the ids in (KEY, conv_id): decimal, ascending, joined by commas."""
    order = [*KEY, "conv_id"]

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)])
            ids = batch.column(3).to_pylist()
            part = batch.column(4)[0].as_py()
            begin = np.append(0, 1 + np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)))
            cuts = sorted({*begin.tolist(), *range(0, len(ids), IDS_IN_SLICE)})
            text = [",".join(map(str, ids[a:b])).encode() for a, b in zip(cuts, [*cuts[1:], len(ids)])]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(keys[i, cuts]) for i in range(3)), pa.array([part] * len(cuts), pa.int32()),
                 pa.array(range(at, at + len(cuts)), pa.int64()), pa.array(text, pa.binary())], [*KEY, "_part", "_no", "ids"])
            at += len(cuts)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for *now, ids in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 5)]):
                if now != key:
                    done += [(*key, state.hexdigest())] if key else []
                    key, state = now, hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], [*KEY, "ends_sha256"])
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, state.hexdigest())], [*KEY, "ends_sha256"])

    cuts = ends.repartitionByRange(*order).sortWithinPartitions(*order).select(
        *order, F.spark_partition_id().alias("_part")).mapInArrow(
        slices, "depth long, p1 long, p2 long, _part int, _no long, ids binary")
    return cuts.repartition(*KEY).sortWithinPartitions(*KEY, "_part", "_no").mapInArrow(
        hashes, "depth long, p1 long, p2 long, ends_sha256 string")


def _forward(nodes: DataFrame, one_task: bool, queue_messages: int) -> DataFrame:
    """Subtree totals of nodes whose tree is named by s1, s2."""
    order = ["level", "p1", "p2"]
    dealt = nodes.coalesce(1) if one_task else nodes.repartition("s1", "s2")
    return dealt.sortWithinPartitions(*order).select(*NODE).mapInArrow(
        partial(totals_in_batches, limit=queue_messages), DONE_SCHEMA)


def prefix_trie(df: DataFrame, shard_turns: int = SHARD_TURNS, queue_messages: int = QUEUE_MESSAGES) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, turn_md5 (role and
    text of the last turn; null at the root) of every node."""
    rebuilt, lengths = rebuilt_turns(df)
    walked = cut(paths(rebuilt))
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")).first()
    turns = walked.count()
    bound = max(shard_turns, turns // MOST_SHARDS)
    nodes = cut(walked.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"), F.max("digest").alias("digest"),
        F.max("e1").alias("e1"), F.max("e2").alias("e2")))
    spark = df.sparkSession
    bare = spark.createDataFrame([(0, 0, 0, root["conv_id"], root["n"])] if root["n"] else [],
                                 "depth long, p1 long, p2 long, conv_id long, n_convs long")

    def as_nodes(rows: DataFrame, **known) -> DataFrame:
        return rows.withColumns({
            "level": -F.col("depth"), "q1": F.col("p1").bitwiseXOR(F.col("e1")), "q2": F.col("p2").bitwiseXOR(F.col("e2")),
            "own": (F.col("n_convs") - 1) * F.col("bytes")} | known)

    zero = F.lit(0).cast("long")
    # The depth down to which a conversation runs through large nodes, and the shard root below it.
    large = cut(nodes.filter(F.col("weight") > bound))
    deepest = walked.join(large.select(*KEY), KEY, "left_semi").groupBy("conv_id").agg(F.max("depth").alias("_above"))
    roots = walked.select("conv_id", "depth", "p1", "p2").join(deepest, "conv_id", "left").filter(
        F.col("depth") == F.coalesce("_above", zero) + 1).select(
        "conv_id", F.col("depth").alias("_top"), F.col("p1").alias("s1"), F.col("p2").alias("s2"))
    small = as_nodes(nodes.filter(F.col("weight") <= bound)).join(roots, "conv_id").withColumns({
        "top": (F.col("depth") == F.col("_top")).cast("long"), "n_children": zero, "n_leaves": zero, "saved": F.col("own")})
    below = cut(_forward(small, False, queue_messages))

    arriving = below.filter("parent IS NULL").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"),
                                                       F.col("q2").alias("p2")).agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("_saved"))
    upper = as_nodes(large.select(*KEY, "conv_id", "n_convs", "bytes", "e1", "e2").unionByName(
        bare.withColumns({"bytes": zero, "e1": zero, "e2": zero}))).join(arriving, KEY, "left").withColumns({
            "top": (F.col("depth") == 0).cast("long"), "n_children": F.coalesce("n_children", zero),
            "n_leaves": F.coalesce("n_leaves", zero), "saved": F.col("own") + F.coalesce("_saved", zero)})
    above = cut(_forward(upper, True, queue_messages))

    hanging = below.filter("parent IS NULL").drop("parent")
    parents = large.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), (F.col("depth") + 1).alias("depth"),
                           F.col("conv_id").alias("parent"))
    everything = below.filter("parent IS NOT NULL").unionByName(above).unionByName(
        hanging.filter("depth > 1").join(parents, ["depth", "q1", "q2"])).unionByName(
        hanging.filter("depth = 1").withColumn("parent", F.lit(root["conv_id"]).cast("long")))
    at_end = walked.filter("depth = length").select(*KEY, "conv_id").unionByName(
        lengths.filter("length = 0").select(zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), "conv_id"))
    about = nodes.select(*KEY, F.hex("digest").alias("turn_md5"))
    return everything.join(end_hashes(at_end), KEY, "left").join(about, KEY, "left").select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), F.lower("turn_md5").alias("turn_md5"))


def with_last_turn(trie: DataFrame, df: DataFrame) -> DataFrame:
    """The trie's rows with role and text of their last turn; null at the root."""
    known = df.filter(F.col("conv_id").isNotNull()).select(
        F.lower(F.hex(_turn_digest())).alias("turn_md5"), text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))
    return trie.join(known.dropDuplicates(["turn_md5"]), "turn_md5", "left")


#: crc32 of the decimal id bit by bit; a prefix is the list of its turns' MD5, a subtree the nodes that its members reach.
SQL = f"""
WITH k AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(CAST(n AS BIGINT), CAST(range(8) AS BIGINT[])),
  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step),
o AS (SELECT conv_id, turn, coalesce(text, '') AS text, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS m
  FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, m) AS pos FROM o),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % {FAMILY} AS base, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(regexp_extract_all(hex(encode(CAST(conv_id AS VARCHAR))), '..'), lambda x: CAST('0x' || x AS BIGINT))),
    lambda a, b: xor(a >> 8, step[(xor(a, b) & 255) + 1])), 4294967295) % {LENGTHS} AS h FROM t, k GROUP BY conv_id, step),
l AS (SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(f.n, 0)) AS taken, least(c.h, coalesce(f.n, 0)) + greatest(c.n - c.h, 0) AS length
  FROM c LEFT JOIN c f ON f.conv_id = c.base),
r AS (SELECT l.conv_id, pos - h + taken AS depth, length, m, text FROM t JOIN l USING (conv_id) WHERE pos > h
  UNION ALL SELECT l.conv_id, pos, length, m, text FROM t JOIN l ON t.conv_id = l.base WHERE pos <= taken),
p AS (SELECT conv_id, depth, length, octet_length(encode(text)) AS bytes, md5(string_agg(m, ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM r
  UNION ALL SELECT conv_id, 0, length, 0, '' FROM l),
n AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS own, max(length) = depth AS leaf,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends FROM p GROUP BY depth, key),
e AS (SELECT DISTINCT a.key AS upper, a.depth AS upper_depth, b.key, b.depth FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
s AS (SELECT e.upper AS key, e.upper_depth AS depth, sum(n.own) AS saved, count(*) FILTER (n.leaf) AS leaves,
  count(*) FILTER (e.depth = e.upper_depth + 1) AS kids FROM e JOIN n ON n.key = e.key AND n.depth = e.depth GROUP BY 1, 2)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, s.kids AS n_children, s.leaves AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN s ON n.key = s.key AND n.depth = s.depth
LEFT JOIN (SELECT DISTINCT upper, upper_depth, key, depth FROM e WHERE depth = upper_depth + 1) g ON g.key = n.key AND g.depth = n.depth
LEFT JOIN n u ON u.key = g.upper AND u.depth = g.upper_depth"""
