"""Near duplicates by Order MinHash, verified by banded alignment.

Texts are compared as words (runs of letters, digits and underscores, lower case). Their
shingles of ``SHINGLE`` words are numbered by occurrence, so a text has no shingle twice. Each
of ``SKETCHES`` hash functions picks the ``PICKED`` shingles with the least hashes and keeps
them in text order; the hash of that list is one key of the text. Two texts with similarity s
share a key with a chance of about s to the power of ``PICKED``, and only if the shared
passages come in the same order.

Similarity is the longest common ordered run of shingles over all shingles of both texts,
found by aligning equal shingles inside the band that the least similarity leaves open.
A link is a pair of different texts with a similarity of ``SIMILAR`` or more.

* Texts with equal words are one class; a group of copies counts once from there on.
* Every member of a key's bucket is compared with the bucket's hub, the member that shares
  the largest buckets (variants of one text all share most keys with it).
* Hubs only save work. For the texts in buckets that still hold several components an exact
  prefix filter (``_prefixes``) names the rare shingles of which two similar texts must share
  one; the texts that have such a shingle are compared with one of them, then, where a shingle
  is still in several components, all of different components with each other. So the
  components are those of all similar pairs of these texts, and a passage or line that very
  many documents have makes no pairs. Nor does a rare shingle that many different texts share,
  where the rest of two texts can no longer be similar enough.
* Tables that a hot key is joined with are read from storage, so adaptive execution may
  split it; nothing is collected but counts.

Defined cases: null text is empty; texts without words are one class; a text of fewer words
than a shingle is one shingle; rows with the same id and text are one document and share one
mark; null ids sort last; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstat.llm.common import Memo, cut, held, small_batches, split_by_keys, text_or_empty
from quillstat.llm.components import components

SHINGLE = 5
SIMILAR = 0.8
SKETCHES = 20
PICKED = 4
WORDS_KEPT = 250_000
TEXTS_KEPT = 64
CELLS = 1 << 20  # hashes held at once for one text
WORD = re.compile(r"\w+")
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SEEDS = _mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)


def _word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _hashes() -> Memo:
    return held(Memo, _word_hash, WORDS_KEPT)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def shingles(words: list[str]) -> np.ndarray:
    """Hashes of the shingles in text order, numbered by occurrence so that all differ."""
    if not words:
        return np.zeros(0, np.uint64)
    known = _hashes()
    codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    count = max(1, len(codes) - SHINGLE + 1)
    out = np.zeros(count, np.uint64)
    for k in range(min(SHINGLE, len(codes))):
        out = _mixed(out ^ codes[k:k + count])
    order = np.argsort(out, kind="stable")
    ranked = out[order]
    fresh = np.append(True, ranked[1:] != ranked[:-1])
    if not fresh.all():
        at = np.arange(count)
        nth = np.empty(count, np.uint64)
        nth[order] = (at - np.maximum.accumulate(np.where(fresh, at, 0))).astype(np.uint64)
        out = np.where(nth > 0, _mixed(out + nth * _U(0x9E3779B97F4A7C15)), out)
    return out


def sketch(kmers: np.ndarray) -> np.ndarray:
    """One key per hash function: the picked shingles in text order, hashed together."""
    picked = min(PICKED, len(kmers))
    keys = _SEEDS.copy()
    at_once = max(1, CELLS // max(1, len(kmers)))
    for first in range(0, SKETCHES, at_once):
        part = slice(first, first + at_once)
        hashes = _mixed(kmers[None, :] * _SEEDS[part, None])
        if picked < len(kmers):
            at = np.sort(np.argpartition(hashes, picked - 1, axis=1)[:, :picked], axis=1)
        else:
            at = np.broadcast_to(np.arange(picked), hashes.shape)
        for k in range(picked):
            keys[part] = _mixed(keys[part] ^ kmers[at[:, k]])
    return keys.view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILAR) -> float:
    """Ordered similarity of two shingle lists; 0 where it is surely below ``least``."""
    n, m = len(a), len(b)
    if not n or not m:
        return float(n == m)
    needed = int(np.ceil(least / (1 + least) * (n + m) - 1e-9))
    if min(n, m) < needed:
        return 0.0
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(at_a) < needed:
        return 0.0
    order = np.argsort(at_a)
    at_a, at_b = at_a[order], at_b[order]
    band = max(n, m) - needed
    at_b = at_b[np.abs(at_a - at_b) <= band]
    if len(at_b) < needed:
        return 0.0
    if len(at_b) > 1 and not (np.diff(at_b) > 0).all():
        tails: list[int] = []
        for x in at_b.tolist():
            k = bisect_left(tails, x)
            if k == len(tails):
                tails.append(x)
            else:
                tails[k] = x
        run = len(tails)
    else:
        run = len(at_b)
    return run / (n + m - run)


def _sketches(df: DataFrame, key: str, text: str) -> DataFrame:
    """_id, _print (hash of the text itself), node (hash of its words), keys: one row per row of ``df``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes, keys, counts = [], [], []
            for body in batch["_text"]:
                words = words_of(body)
                nodes.append(hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).hexdigest())
                keys.append(sketch(shingles(words)) if words else np.zeros(0, np.int64))
                counts.append(max(1, len(words) - SHINGLE + 1) if words else 0)
            yield pd.DataFrame({"_id": batch["_id"].astype("Int64"), "_print": batch["_print"], "node": nodes, "keys": keys,
                                "shingles": counts})

    rows = df.select(F.col(key).cast("long").alias("_id"), F.xxhash64(text_or_empty(text)).alias("_print"),
                     text_or_empty(text).alias("_text"))
    return rows.mapInPandas(run, "_id long, _print long, node string, keys array<long>, shingles long")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """centre, member of the pairs whose texts are similar."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        recent: dict[str, np.ndarray] = {}

        def of(node: str, body: str) -> np.ndarray:
            if node not in recent:
                if len(recent) >= TEXTS_KEPT:
                    recent.pop(next(iter(recent)))
                recent[node] = shingles(words_of(body))
            return recent[node]

        for batch in batches:
            kept = [similarity(of(c, x), shingles(words_of(y))) >= SIMILAR
                    for c, x, y in zip(batch["centre"], batch["_ctext"], batch["_mtext"])]
            yield batch.loc[kept, ["centre", "member"]]

    joined = pairs.join(texts.select(F.col("node").alias("member"), F.col("_text").alias("_mtext")), "member").join(
        texts.select(F.col("node").alias("centre"), F.col("_text").alias("_ctext")), "centre")
    return joined.select("centre", "member", "_ctext", "_mtext").mapInPandas(run, "centre string, member string")


def _with_links(groups: DataFrame, links: DataFrame) -> DataFrame:
    """node, root after more links: only the components that the links touch are joined anew."""
    root_of = lambda end: groups.select(F.col("node").alias(end), F.col("root").alias(f"_{end}"))
    between = links.join(root_of("centre"), "centre", "left").join(root_of("member"), "member", "left").select(
        F.coalesce("_centre", "centre").alias("a"), F.coalesce("_member", "member").alias("b"))
    joined = components(between, "a", "b")
    moved = groups.join(joined.select(F.col("node").alias("root"), F.col("root").alias("_to")), "root", "left")
    moved = moved.select("node", F.coalesce("_to", "root").alias("root"))
    alone = joined.join(groups.select("node"), "node", "left_anti")
    return cut(moved.unionByName(alone))


def near_groups(df: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, groups): rows have _id, _print, node; groups have node, root for classes that have a link."""
    small_batches(df.sparkSession)
    rows = cut(_sketches(df, key, text))
    classes = rows.groupBy("node").agg(F.min(F.struct("_id", "_print")).alias("_first"), F.any_value("keys").alias("keys"),
                                          F.any_value("shingles").alias("shingles"))
    classes = cut(classes.select("node", "_first", "keys", "shingles"))
    entries = classes.select("node", F.explode("keys").alias("bucket"))
    full = cut(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"))
    members = cut(entries.join(full, "bucket"))
    hubs = cut(members.groupBy("node").agg(F.sum("size").alias("hub")))
    members = cut(members.drop("size").join(hubs, "node"))

    wanted = cut(hubs.select("node").join(classes.select("node", "_first._id", "_first._print"), "node"))
    source = df.select(F.col(key).cast("long").alias("_id"), F.xxhash64(text_or_empty(text)).alias("_print"),
                       text_or_empty(text).alias("_text"))
    source, _ = split_by_keys(source, wanted, "_id", "_print")
    source = source.select(F.col("_id").alias("_key"), F.col("_print").alias("_hash"), "_text")
    same = F.col("_hash").eqNullSafe(F.col("_print")) & F.col("_key").eqNullSafe(F.col("_id"))
    texts = cut(source.join(wanted, same).groupBy("node").agg(F.any_value("_text").alias("_text")))

    centres = cut(members.groupBy("bucket").agg(F.max(F.struct("hub", "node")).alias("_c")).select(
        "bucket", F.col("_c.node").alias("centre")))
    links = cut(_verified(cut(members.join(centres, "bucket").filter("node != centre").select(
        "centre", F.col("node").alias("member")).distinct()), texts))
    groups = components(links, "centre", "member")
    labelled = members.select("bucket", "node").join(groups.withColumnRenamed("root", "label"), "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    labelled = cut(labelled)
    split = labelled.groupBy("bucket").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).filter("_a != _b").select("bucket")
    left = cut(labelled.join(split, "bucket", "left_semi").select("node", "label").distinct())
    first = cut(_prefixes(left, texts))
    # Another hub for every shingle, so a text meets as many texts of other components as it has shingles here.
    hub = F.min(F.struct(F.xxhash64("node", "shingle"), "node", "label", "count", "at", "place")).alias("_h")
    tried = cut(_pairs_of(first, first.groupBy("shingle").agg(hub).select("shingle", "_h.*")))
    found = cut(_verified(tried, texts))
    if not found.isEmpty():
        groups = _with_links(groups, found)
        first = first.drop("label").join(groups.withColumnRenamed("root", "label"), "node", "left").withColumn(
            "label", F.coalesce("label", "node"))
        mixed = first.groupBy("shingle").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).filter("_a != _b").select("shingle")
        first = cut(first.join(mixed, "shingle", "left_semi"))
    pairs = cut(_pairs_of(first, first, "node > _node").join(tried, ["centre", "member"], "left_anti"))
    found = cut(_verified(pairs, texts))
    if not found.isEmpty():
        groups = _with_links(groups, found)
    return rows.drop("keys", "shingles"), groups


def _shingles_of(left: DataFrame, texts: DataFrame) -> DataFrame:
    """node, label, count and the shingle hashes of the texts in ``left``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingles(words_of(body)).view(np.int64) for body in batch["_text"]]
            yield pd.DataFrame({"node": batch["node"], "label": batch["label"], "count": [len(f) for f in found], "shingles": found})

    return left.join(texts, "node").select("node", "label", "_text").mapInPandas(
        run, "node string, label string, count int, shingles array<long>")


def _prefixes(left: DataFrame, texts: DataFrame) -> DataFrame:
    """shingle, node, label, count, at, place: shingles of which two similar texts in ``left`` (node, label) surely share
    one, where they stand in texts of different components; ``at`` in the text, ``place`` by frequency.

    Similar texts of n and m shingles share at least ``SIMILAR`` * max(n, m) of them, so in any common order they share one
    of the first n - ceil(SIMILAR * n) + 1 of each (an exact prefix filter). The order is by frequency, rarest first, so
    a passage that many documents have leads to no pair. Shingles all of whose texts are in one component lead to none.
    """
    each = cut(_shingles_of(left, texts).select("node", "label", "count", F.posexplode("shingles").alias("at", "shingle")))
    common = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("_n"), F.min("label").alias("_a"), F.max("label").alias("_b")).filter("_n > 1")
    shared = cut(each.join(common, "shingle"))
    # Shingles of one text alone are the rarest and come first; they lead to no pair, so only their number counts.
    alone = F.col("count") - F.count(F.lit(1)).over(Window.partitionBy("node"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("_n", "shingle")) + alone
    prefix = F.col("count") - F.ceil(F.col("count") * F.lit(SIMILAR) - 1e-9) + 1
    return shared.withColumn("place", place.cast("int")).filter((F.col("place") <= prefix) & (F.col("_a") != F.col("_b"))).select(
        "shingle", "node", "label", "count", "at", "place")


def _pairs_of(left: DataFrame, right: DataFrame, order: str = "true") -> DataFrame:
    """centre, member (the lesser node) of the rows of two tables of prefixes that share a shingle, are in different
    components and can be similar.

    Similar texts of n and m shingles have a common run of ``needed`` = SIMILAR / (1 + SIMILAR) * (n + m) or more. Its rarest
    shingle has a place of n - needed + 1 at most in one text and m - needed + 1 in the other, and stands no further apart
    in the texts than the band of the alignment, so two texts without such a shingle are not similar. Places count
    the shingles of one text alone, so variants of a text with too many words of their own make no pairs.
    """
    other = right.select("shingle", *[F.col(c).alias(f"_{c}") for c in ("node", "label", "count", "at", "place")])
    near = F.least("count", "_count") >= F.greatest("count", "_count") * SIMILAR - 1e-9
    needed = F.ceil((F.col("count") + F.col("_count")) * (SIMILAR / (1 + SIMILAR)) - 1e-9)
    early = (F.col("place") + needed <= F.col("count") + 1) & (F.col("_place") + needed <= F.col("_count") + 1)
    in_band = F.abs(F.col("at") - F.col("_at")) + needed <= F.greatest("count", "_count")
    return left.join(other, "shingle").filter(
        (F.col("label") != F.col("_label")) & near & early & in_band & F.expr(order)).select(
        F.greatest("node", "_node").alias("centre"), F.least("node", "_node").alias("member")).distinct()


def _marked(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """_id, _print, node, root, _keep (id and text hash of the document that stays), group_size for every row."""
    sizes = rows.groupBy("node").agg(F.min(_order("_id", "_print")).alias("_first"), F.count(F.lit(1)).alias("_n"))
    sizes = sizes.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = cut(sizes)
    whole = cut(sizes.groupBy("root").agg(F.min("_first").alias("_keep"), F.sum("_n").alias("group_size")))
    per_node = cut(sizes.select("node", "root", F.col("_first._id").alias("class_id")).join(whole, "root"))
    return rows.join(per_node, "node")


def _order(key: str, mark: str):
    """Sorts null ids last."""
    return F.struct(F.col(key).isNull().alias("_none"), F.col(key), F.col(mark))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, class_id (least id with the same words), group_id (least id of all linked texts),
    group_size, kept, for every row of ``df``."""
    marked = _marked(*near_groups(df, key, text))
    return marked.select(
        F.col("_id").alias(key), "class_id", F.col(f"_keep._id").alias("group_id"), "group_size",
        (F.col("_id").eqNullSafe(F.col("_keep._id")) & (F.col("_print") == F.col("_keep._print"))).alias("kept"))


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df``, all its columns, with one document of each group of near duplicates."""
    names = df.columns
    marked = _marked(*near_groups(df, key, text))
    stays = F.col("_id").eqNullSafe(F.col("_keep._id")) & (F.col("_print") == F.col("_keep._print"))
    marks = cut(marked.filter(F.col("group_size") > 1).groupBy("_id", "_print").agg(
        F.max(stays).alias("_stays"), F.count(F.lit(1)).alias("_times")))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(key).cast("long").alias("_id"),
                     F.xxhash64(text_or_empty(text)).alias("_print"))
    rows, alone = split_by_keys(rows, marks, "_id", "_print")
    rows = rows.withColumnsRenamed({"_id": "_key", "_print": "_hash"})
    same = F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_print"))
    joined = rows.join(marks, same, "left").filter(F.col("_stays").isNull() | F.col("_stays"))
    kept = joined.select("_row")
    if not marks.filter(F.col("_stays") & (F.col("_times") > 1)).isEmpty():
        once = F.coalesce("_times", F.lit(1)) == 1
        kept = joined.filter(once).select("_row").unionByName(
            joined.filter(~once).dropDuplicates(["_key", "_hash"]).select("_row"))
    kept = kept.unionByName(alone.select("_row"))
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in names])
