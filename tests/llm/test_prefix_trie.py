import hashlib
import random
import zlib
from collections import defaultdict

import duckdb

from quillstat.llm import prefix_trie, time_forward

SCHEMA = "conv_id long, turn long, role string, text string, depth int, p1 string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def brute(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            mark = hashlib.md5((f"{len(r.encode())}:" + r + x).encode()).digest()
            own[c].append(((t is not None, t or 0), mark, r, x))
    own = {c: [turn[2:] for turn in sorted(v)] for c, v in own.items()}
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        turns = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                kids[turns[:d - 1]].add(turns[:d])
        ends[turns].append(c)
    total, out = {}, set()
    for k in sorted(members, key=len, reverse=True):
        below = [total[c] for c in kids.get(k, ())]
        own_bytes = (len(members[k]) - 1) * (len(k[-1][1].encode()) if k else 0)
        total[k] = (sum(b[0] for b in below) or 1, sum(b[1] for b in below) + own_bytes)
        ids = ",".join(map(str, sorted(ends.get(k, []))))
        out.add((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(kids.get(k, ())), *total[k],
                 hashlib.sha256(ids.encode()).hexdigest()))
    return out


def found(df, *args):
    rows = [tuple(r)[:8] for r in prefix_trie.prefix_trie(df, *args).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def conversations(seed=4):
    rng = random.Random(seed)
    say = ["", "yes", "é" * 40, "tell me", "no", None]
    rows = []
    for c in range(-6, 160):
        if c % 11:
            rows += [(c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(say[:2] if t < 3 else say))
                     for t in range(rng.choice([0, 1, 2, 5, 9, 14]))]
    rows += [(7, 3, "user", "tie"), (7, 3, "user", "tie"), (7, 3, "user", "other"), (None, 1, "user", "no conversation")]
    rows += [(500 + i, t, "user", f"copy {t}") for i in range(120) for t in range(4)]  # a large group of copies
    return rows


def test_trie_matches_brute_force_in_one_and_many_shards(spark):
    rows = conversations()
    want = brute(rows)
    df = frame(spark, rows)
    assert found(df) == want
    assert found(df.repartition(5), 12, 3) == want  # small shards, spilling queues


def test_a_conversation_longer_than_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)
    rows = [(c, t, "user", f"t{t if t < 150 else (c, t)}") for c in (10, 11) for t in range(200)] + [(12, 0, "user", "t0")]
    assert found(frame(spark, rows), 40, 5) == brute(rows)


def test_empty_and_turnless(spark):
    assert prefix_trie.prefix_trie(frame(spark, [])).count() == 0
    assert prefix_trie.prefix_trie(frame(spark, [(None, 1, "u", "x")])).count() == 0
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in range(1, 1000)}
    lone = next(c for c in h if c % 5 and h[c] > 1)  # one turn of its own, no family: nothing is left
    rows = [(lone, 0, "user", "x")]
    assert found(frame(spark, rows)) == brute(rows) == {(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())}


def test_last_turns_are_given_back(spark):
    rows = [(10, 0, "user", "a"), (10, 1, None, "b"), (20, 0, "user", "a")]
    df = frame(spark, rows)
    shown = {(r.conv_id, r.depth): (r.role, r.text) for r in prefix_trie.with_last_turn(prefix_trie.prefix_trie(df), df).collect()}
    assert shown[10, 0] == (None, None) and shown[10, 1] == ("user", "a") and shown[10, 2] == ("", "b")


def test_sql_agrees(spark):
    rows = conversations(9)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert set(con.execute(prefix_trie.SQL).fetchall()) == brute(rows)


def test_queue_spills_and_keeps_order():
    rng = random.Random(2)
    queue, plain, taken, wanted = time_forward.SpillingQueue(10), [], [], []
    for _ in range(3000):
        if plain and rng.random() < 0.45:
            plain.sort()
            wanted.append(plain.pop(0))
            assert queue.least() == wanted[-1]
            taken.append(queue.pop())
        else:
            message = (rng.randint(-50, 50), rng.randint(-2 ** 62, 2 ** 62))
            plain.append(message)
            queue.push(message)
    assert taken == wanted
    assert [queue.pop() for _ in range(len(plain))] == sorted(plain) and queue.least() is None
