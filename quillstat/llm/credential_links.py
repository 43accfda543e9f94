"""Secret scan by linking the parts of a credential.

Three patterns are reported wherever they match (BASE_KINDS). Further parts are too weak alone:
identifiers (account and client names, e-mail addresses), random-looking tokens, and endpoints
(URLs, hosts, IPv4 addresses). A weak part is reported only if what completes it stands in its
scope, that is in the same block of lines (no blank line between) and at most REACH code
points away: a strong part of another role (an access key is a strong identifier, an
assignment a strong secret), or else parts of both other roles. Unassigned hexadecimal runs
are base spans and count as weak secrets here.

Matching is per document; the interval join runs in Spark over the parts alone: each part
meets the nearest end before it and the nearest start after it of every role, by running
maxima over the parts of its block in either direction, so no pair within a block is made.

Defined cases: null text is empty; every row gives one row, with its id as it is (null and
repeated ids too) and equal rows equal results; a document without spans has the hash of the
empty string and empty ``spans``; texts are matched whole, whatever their length, and no
pattern takes more than linear time; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstat.llm.common import cut, small_batches, text_or_empty

REACH = 300
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "identifier", "secret", "endpoint")
ROLES = ("identifier", "secret", "endpoint")
LEAST_VALUE, LEAST_TOKEN = 6, 16
LEAST_ENTROPY = 3.0  # bits a character

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
#: A run matches as a whole or not at all, so the least length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMED = re.compile(r"""(?:access_?key_?id|client_?id|account(?:_?id)?|tenant(?:_?id)?|user(?:_?name|_?id)?|login)"""
                   r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]{3,})""", re.I | re.A)
NAMED_WORDS = ("access", "client", "account", "tenant", "user", "login")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
BEFORE_AT = re.compile(r"[A-Za-z0-9._%+-]+\Z")
AFTER_SCHEME = re.compile(r"""://[^\s"'<>|]+""")
SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*\Z")
HOST = re.compile(r"""(?:host(?:_?name)?|endpoint|server)["']?\x20*[:=]\x20*["']?([A-Za-z0-9.-]{4,}(?::\d+)?)""", re.I | re.A)
HOST_WORDS = ("host", "endpoint", "server")
ADDRESS = re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?::\d{2,5})?(?!\.?\d)", re.A)
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
BLANK = re.compile(r"\n[ \t\r]*\n")
LONGEST_HEAD = 64  # of a mail address before @, and of a scheme


@dataclass(frozen=True)
class Part:
    """kind is a place in KINDS, role one in ROLES."""

    start: int
    end: int
    kind: int
    role: int
    strong: bool = False


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches."""
    lower = text.lower()
    out = []
    if any(w in lower for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _with_head(text: str, tail: re.Pattern, head: re.Pattern) -> Iterator[tuple[int, int]]:
    """Spans of ``tail`` with the longest ``head`` that ends where they begin."""
    for m in tail.finditer(text):
        before = head.search(text[max(0, m.start() - LONGEST_HEAD):m.start()])
        if before:
            yield m.start() - len(before[0]), m.end()


def _identifiers(text: str, lower: str) -> list[tuple[int, int]]:
    found = list(_with_head(text, DOMAIN, BEFORE_AT)) if "@" in text else []
    if any(w in lower for w in NAMED_WORDS):
        found += [m.span(1) for m in NAMED.finditer(text)]
    return found


def _endpoints(text: str, lower: str) -> list[tuple[int, int]]:
    found = list(_with_head(text, AFTER_SCHEME, SCHEME)) if "://" in text else []
    if any(w in lower for w in HOST_WORDS):
        found += [m.span(1) for m in HOST.finditer(text)]
    return found + [m.span() for m in ADDRESS.finditer(text)]


def looks_random(token: str) -> bool:
    """Digits and letters mixed, and characters spread evenly."""
    if not (any(c.isdigit() for c in token) and any(c.isalpha() for c in token)):
        return False
    n = len(token)
    return -sum(k / n * math.log2(k / n) for k in Counter(token).values()) >= LEAST_ENTROPY


def parts_of(text: str, base: list[tuple[int, int, int]]) -> list[Part]:
    """All parts of a text in which a weak one may be linked, free of overlaps among weak ones and with base spans."""
    strong = any(kind < 2 for _, kind, _ in base)
    lower = text.lower()
    names = _identifiers(text, lower)
    if not strong and not names:
        return []
    ends = _endpoints(text, lower)
    if not strong and not ends:
        return []
    tokens = [m.span() for m in TOKEN.finditer(text) if looks_random(m[0])]
    out = [Part(start, end, kind, 0 if kind == 1 else 1, kind < 2) for start, kind, end in base]
    taken = [(start, end) for start, _, end in base]
    for role, spans in ((2, ends), (0, names), (1, tokens)):
        free = []
        at, reached = 0, -1
        order = sorted(taken)
        for start, end in sorted(spans):
            while at < len(order) and order[at][0] < end:
                reached = max(reached, order[at][1])
                at += 1
            if reached <= start:
                free.append((start, end))
                reached = end
        out += [Part(start, end, KINDS.index(ROLES[role]), role) for start, end in free]
        taken += free
    return sorted(out, key=lambda p: (p.start, p.kind))


SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
PART = pa.struct([("block", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("role", pa.int32()),
                  ("strong", pa.bool_())])


def scanned(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """_row, key, base (array of start, kind, end) and parts (block, start, end, kind, role, strong) of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, parts = [], []
            for body in batch.column(1).to_pylist():
                base = base_spans(body)
                spans.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                found = parts_of(body, base)
                blanks = [m.start() for m in BLANK.finditer(body)] if found else []
                parts.append([{"block": bisect_right(blanks, p.start), "start": p.start, "end": p.end, "kind": p.kind,
                               "role": p.role, "strong": p.strong} for p in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, pa.list_(SPAN)), pa.array(parts, pa.list_(PART))], ["_key", "base", "parts"])

    small_batches(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("_key"), text_or_empty(text).alias("_text")).mapInArrow(
        scan, f"_key {kind}, base array<struct<start int, kind int, end int>>, "
              "parts array<struct<block int, start int, end int, kind int, role int, strong boolean>>")
    return cut(rows.withColumn("_row", F.monotonically_increasing_id()))


def linked_parts(rows: DataFrame, reach: int = REACH) -> DataFrame:
    """_row, start, kind, end of the weak parts that what completes them stands near."""
    parts = rows.select("_row", F.explode("parts").alias("p")).select("_row", "p.*")
    block = Window.partitionBy("_row", "block")
    before = block.orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = block.orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    near: dict[tuple[int, bool], Column] = {}
    columns = {}
    for role in range(len(ROLES)):
        for strong in (False, True):
            of = (F.col("role") == role) & (F.col("strong") if strong else F.lit(True))
            name = f"{ROLES[role]}_{'strong' if strong else 'any'}"
            columns[f"{name}_before"] = F.max(F.when(of, F.col("end"))).over(before)
            columns[f"{name}_after"] = F.min(F.when(of, F.col("start"))).over(after)
            near[role, strong] = F.coalesce(F.col(f"{name}_before") >= F.col("start") - reach, F.lit(False)) | F.coalesce(
                F.col(f"{name}_after") <= F.col("end") + reach, F.lit(False))
    complete = F.lit(False)
    for role in range(len(ROLES)):
        others = [r for r in range(len(ROLES)) if r != role]
        found = near[others[0], True] | near[others[1], True] | (near[others[0], False] & near[others[1], False])
        complete = complete | ((F.col("role") == role) & found)
    return parts.withColumns(columns).filter((F.col("kind") >= len(BASE_KINDS)) & complete).select("_row", "start", "kind", "end")


def secrets(df: DataFrame, reach: int = REACH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, found (array of start, kind, end; kind a place in KINDS) and base (the same of BASE_KINDS alone) of every row."""
    rows = scanned(df, key, text)
    added = linked_parts(rows, reach).groupBy("_row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("_added"))
    none = F.array().cast("array<struct<start int, kind int, end int>>")
    return rows.join(added, "_row", "left").select(
        F.col("_key").alias(key), F.array_sort(F.concat("base", F.coalesce("_added", none))).alias("found"), "base")


def secret_report(df: DataFrame, reach: int = REACH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_assign, n_access, n_hex, base_sha256, spans: one row per row of ``df``."""
    names = F.array(*[F.lit(k) for k in KINDS])
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.size(F.expr(f"filter(base, s -> s.kind = {i})")).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)]
    return secrets(df, reach, key, text).select(
        key, *counts, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))
