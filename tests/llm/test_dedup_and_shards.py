import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from quillstat.llm import exact_dedup, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, _digest int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "x", 1) for i, t, s in rows], SCHEMA)


ROWS = [(5, "a  b", "s0"), (3, "a\tb", "s0"), (9, None, "s1"), (7, "", None), (8, "\n", "s1"), (1, "long " * 5000, "s0"),
        (3, "a b", "s0"), (3, "a b", "s0"), (None, "a b", "s2"), (None, "only", "s2"), (11, "A b", "s1"), (12, "é", "s1")]


def plain(rows):
    def body(t):
        return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")

    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[body(t)].append(i)
    out, done = Counter(), set()
    for i, t, _ in rows:
        ids = groups[body(t)]
        keep = min((x for x in ids if x is not None), default=None)
        kept = i == keep and body(t) not in done
        if kept:
            done.add(body(t))
        out[(i, keep, len(ids), kept, hashlib.sha256(body(t).encode()).hexdigest())] += 1
    return out


def test_exact_duplicates_match_brute_force_even_if_hashes_clash(spark):
    df = frame(spark, ROWS)
    want = plain(ROWS)
    weak = lambda body: F.unhex(F.md5((F.length(body) % 2).cast("string").cast("binary")))
    for digest in (exact_dedup.md5_digest, weak):
        got = exact_dedup.exact_duplicates(df, digest=digest)
        assert Counter(tuple(r) for r in got.collect()) == want
        stay = exact_dedup.keep_first(df, digest=digest)
        assert stay.columns == df.columns
        kept = Counter((k[0], k[4]) for k, n in want.items() if k[3] for _ in range(n))
        found = Counter((r.doc_id, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "").encode()).hexdigest())
                        for r in stay.collect())
        assert found == kept


def test_exact_duplicates_of_nothing(spark):
    assert exact_dedup.exact_duplicates(frame(spark, [])).count() == 0
    assert exact_dedup.keep_first(frame(spark, [])).count() == 0


def test_shards_hold_the_law_and_the_mixture(spark):
    rng = random.Random(3)
    rows = [(i, f"t{i % 50}" * rng.randint(0, 5), rng.choice(["s0"] * 6 + ["s1", "s2", "s3", None])) for i in range(1500)]
    df = frame(spark, rows + ROWS)
    all_rows = rows + ROWS
    got = sharding.shard_rows(df, 7).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in all_rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    sizes = [len(v) for v in by.values()]
    assert len(by) == 7 and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    source = dict((i, s) for i, _, s in rows)
    share = sum(s == "s0" for s in source.values()) / len(rows)
    for shard in range(7):
        mine = [source[r.doc_id] for r in got if r.shard == shard and r.doc_id in source]
        assert abs(sum(s == "s0" for s in mine) / len(mine) - share) < 0.03
    again = sharding.shard_rows(df.repartition(5), 7).collect()
    place = lambda rs: Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in rs)
    assert place(again) == place(got)


def test_shards_of_little(spark):
    assert sharding.shard_rows(frame(spark, [])).count() == 0
    assert {(r.shard, r.slot) for r in sharding.shard_rows(frame(spark, ROWS[:3]), 40).collect()} == {(0, 0), (13, 0), (26, 0)}
