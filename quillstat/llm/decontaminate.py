"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Texts become words (runs of letters and digits, lower case). Numbers, names (capitals inside a
sentence) and units after a number become typed placeholders, so a question with other numbers
or names has the same template. Windows of ``WINDOW`` template words of the benchmark are
joined with those of all documents by hash.

Capitals show no names in a copy of other letter case, and a name may follow a line break. So
every window is also searched by its plain words (one letter case, no marks), and windows with
placeholders by the template that the text has with normal white space. A pair that the marked
form alone accepts reports that form's figures; any other pair reports those of all forms.

A window with more placeholders than words would match any table of numbers, so it is searched
by its literal words. An item shorter than the window is searched as one window of its length;
items under ``LEAST_WORDS`` words cannot be told from ordinary prose and are not searched.

For matched windows that hold placeholders, the values behind them are compared: along one
alignment each value of the item must always stand for the same value in the document. A pair
counts as contaminated when at least ``COVERAGE`` of the item's windows occur literally, or
occur as templates whose slots are consistent. It also counts with a literal run of ``RUN``
words, or of the whole item if that is shorter, so a passage of a long item is found; and with
all words but one (replaced, left out or added) of an item of ``WINDOW`` to twice that many
words, where one word is in most windows. Such items have anchors of half their words, and the
text around a matched anchor is compared word by word.

The benchmark's windows are broadcast if a count shows at most ``BROADCAST_WINDOWS`` of them,
and joined by a shuffle beyond that; a window that is very common in documents costs one row
for each occurrence.

Defined cases: null texts are empty and match nothing; rows with the same doc_id (null is one
of its values) are read as parts of one document; repeated items are separate items only by
item_id; empty tables give an empty result; other columns play no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstat.llm.common import cut, text_or_empty

WINDOW = 8
LEAST_WORDS = 4
COVERAGE = 0.5
CONSISTENT = 0.8
RUN = 13
#: One word is in up to WINDOW windows; of longer items more than half stay.
EDITED_WORDS = 3 * WINDOW - 2
#: Words kept on either side of rare words: an item with an anchor lies within.
AROUND = EDITED_WORDS + WINDOW
BROADCAST_WINDOWS = 50_000

# Units of measure, currency and time that follow a number.
UNITS = (
    "mm cm m km in inch inches ft feet yd yards mile miles mg g kg t lb lbs oz ml cl l liter liters litre litres "
    "s sec seconds min minutes h hr hours day days week weeks month months year years "
    "usd eur gbp dollar dollars euro euros pound pounds cent cents percent degrees kmh mph hz khz mhz ghz kb mb gb tb w kw v kv"
).split()

NAME, UNIT, NUMBER = "¤", "§", "#"
#: A line break counts as a space; a blank line ends the sentence.
SPACES = ((r"\n[\s\p{Z}]*\n", " . "), (r"[\s\p{Z}]+", " "))
#: Texts in which a capital after other white space than one space may begin a name.
SPACED = r"[\p{L}\p{N},;](?: [\s\p{Z}]|[\t\n\x0B\f\r\p{Z}&&[^ ]])[\s\p{Z}]*\p{Lu}"
#: (pattern, replacement) steps from a text to its marked words; group references are $1 here and \1 in SQL.
MARKED = (
    (r"[¤§#]+", ""),
    (r"(\p{N})[.,:](\p{N})", "$1$2"),
    (r"([\p{L}\p{N},;] )(\p{Lu})", "$1¤$2"),
    (r"[^\p{L}\p{N}¤]+", " "),
)
UNIT_STEP = (rf"(\p{{N}} )({'|'.join(UNITS)})( |$)", "$1§$2$3")
#: From marked words to the template.
TEMPLATE = (
    (r"([¤§])[\p{L}\p{N}]*", "$1"),
    (r"(^| )\p{L}*\p{N}[\p{L}\p{N}]*", "$1#"),
)


def _steps(column: Column, steps) -> Column:
    return reduce(lambda c, s: F.regexp_replace(c, s[0], s[1]), steps, column)


def marked_text(text: Column) -> Column:
    """Words joined by one space; names and units carry their mark in front."""
    return _steps(F.trim(F.lower(_steps(text, MARKED))), [UNIT_STEP])


def plain_text(marked: Column) -> Column:
    """The same words without marks."""
    return F.translate(marked, NAME + UNIT, "")


def _words(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))


def _windows(hashes: Column, length: int, kind: str) -> Column:
    """Hash of each run of ``length`` words."""
    at = F.sequence(F.lit(1), F.size(hashes) - (length - 1))
    return F.when(F.size(hashes) >= length, F.transform(
        at, lambda i: F.xxhash64(F.lit(f"{kind}{length}"), F.slice(hashes, i, length)))).otherwise(
        F.array().cast("array<bigint>"))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """_item, _at, _length, _kind, _key, _slots (places of placeholders), _values, _of (windows of the item)."""
    marked = marked_text(text_or_empty(text))
    spaced = marked_text(_steps(text_or_empty(text), SPACES))
    items = benchmark.select(F.col(item).alias("_item"), _words(marked).alias("_raw"), _words(plain_text(marked)).alias("_plain"),
                             _words(_steps(marked, TEMPLATE)).alias("_template"), _words(_steps(spaced, TEMPLATE)).alias("_spaced"))
    length = F.least(F.size("_raw"), F.lit(WINDOW))
    rows = items.filter(F.size("_raw") >= LEAST_WORDS).withColumn("_length", length).select(
        "*", F.explode(F.sequence(F.lit(1), F.size("_raw") - F.col("_length") + 1)).alias("_at"),
        (F.size("_raw") - F.col("_length") + 1).alias("_of"))
    part = lambda words: F.slice(words, F.col("_at"), F.col("_length"))
    slots = lambda cut_: F.filter(F.sequence(F.lit(0), F.col("_length") - 1),
                                  lambda k: F.get(F.col(cut_), k).isin(NAME, UNIT, NUMBER))
    rows = rows.select("_item", "_at", "_length", "_of", part("_raw").alias("_values"), part("_plain").alias("_words"),
                       part("_template").alias("_cut"), part("_spaced").alias("_cut2")).select(
        "*", slots("_cut").alias("_slots"), slots("_cut2").alias("_slots2"))
    none = F.array().cast("array<int>")
    many = F.size("_slots") * 2 > F.col("_length")
    forms = [rows.filter(many).withColumns({"_kind": F.lit("literal"), "_body": F.col("_values"), "_slots": none}),
             rows.filter(~many).withColumns({"_kind": F.lit("template"), "_body": F.col("_cut")}),
             rows.withColumns({"_kind": F.lit("plain"), "_body": F.col("_words"), "_slots": none}),
             rows.filter((F.size("_slots2") > 0) & (F.size("_slots2") * 2 <= F.col("_length"))).withColumns(
                 {"_kind": F.lit("spaced"), "_body": F.col("_cut2"), "_slots": F.col("_slots2")})]
    rows = reduce(DataFrame.unionByName, [*(f.select(*_FORM) for f in forms), _anchors(items)]).withColumn(
        "_key", F.xxhash64(F.concat("_kind", F.col("_length").cast("string")), _hashes(F.col("_body"))))
    return _with_rare_words(rows, items).select(
        "_item", "_at", "_length", "_kind", "_key", "_slots", "_values", "_of", "_rare", "_offset", "_alone")


def _with_rare_words(rows: DataFrame, items: DataFrame) -> DataFrame:
    """``rows`` with the hash _rare of two neighbouring words of the window, those whose counts in the benchmark have the
    least product (of several the longest, then the first), and their place _offset. Marks stand for values, so they are
    no such words; a window without two such neighbours has a single word, with _alone."""
    known = items.select(F.explode("_plain").alias("_word")).groupBy("_word").agg(F.count(F.lit(1)).alias("_n"))
    each = rows.select("_kind", "_key", "_body").dropDuplicates(["_kind", "_key"]).select(
        "_kind", "_key", F.posexplode("_body").alias("_offset", "_raw")).filter(~F.col("_raw").isin(NAME, UNIT, NUMBER)).select(
        "_kind", "_key", "_offset", plain_text(F.col("_raw")).alias("_word")).join(known, "_word")
    ahead = Window.partitionBy("_kind", "_key").orderBy("_offset")  # one window of words
    after = lambda c: F.when(F.lead("_offset").over(ahead) == F.col("_offset") + 1, F.lead(c).over(ahead))
    pairs = each.withColumns({"_next": after("_word"), "_m": after("_n")})
    alone = F.col("_next").isNull()
    rare = pairs.select("_kind", "_key", F.struct(
        alone.alias("alone"), (F.col("_n") * F.coalesce("_m", F.lit(1))).alias("n"), (-F.length("_word")).alias("size"),
        F.col("_offset").alias("offset"), F.when(alone, F.xxhash64("_word")).otherwise(F.xxhash64("_word", "_next")).alias("hash")).alias("_r"))
    rare = rare.groupBy("_kind", "_key").agg(F.min("_r").alias("_r")).select(
        "_kind", "_key", F.col("_r.hash").alias("_rare"), F.col("_r.offset").alias("_offset"), F.col("_r.alone").alias("_alone"))
    return rows.join(rare, ["_kind", "_key"])


_FORMS = ("_raw", "_plain", "_template", "_spaced")
_FORM = ["_item", "_at", "_length", "_of", "_kind", "_body", "_slots", "_values"]


def _anchors(items: DataFrame) -> DataFrame:
    """Runs of half the words of items in which one word may be in most windows."""
    short = items.filter(F.size("_plain").between(WINDOW, EDITED_WORDS)).withColumn("_length", F.floor(F.size("_plain") / 2).cast("int"))
    return short.select(
        "_item", F.explode(F.sequence(F.lit(1), F.size("_plain") - F.col("_length") + 1)).alias("_at"), "_length",
        (F.size("_plain") - WINDOW + 1).alias("_of"), F.lit("part").alias("_kind"), "_plain").select(
        "*", F.slice("_plain", F.col("_at"), F.col("_length")).alias("_body"), F.array().cast("array<int>").alias("_slots")).select(
        *_FORM[:-1], F.col("_body").alias("_values"))


def _runs(found: DataFrame) -> DataFrame:
    """_id, _item of pairs with a literal run of ``RUN`` words or of the whole item."""
    rows = found.filter("_kind = 'plain'").select("_id", "_item", "_of", "_length", "_at", (F.col("_place") - F.col("_at")).alias("_line")).distinct()
    nth = F.row_number().over(Window.partitionBy("_id", "_item", "_line").orderBy("_at"))
    rows = rows.withColumn("_run", F.col("_at") - nth).groupBy("_id", "_item", "_line", "_run").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_of").alias("_of"), F.max("_length").alias("_length"))
    return rows.filter(F.col("_n") >= F.least(F.lit(RUN) - F.col("_length") + 1, F.col("_of"))).select("_id", "_item").distinct()


def _edited(found: DataFrame, items: DataFrame) -> DataFrame:
    """_id, _item, _of, _first, _last of pairs whose document has all words of the item but one, in order."""
    rows = found.filter("_kind = 'part'").select(
        "_id", "_item", "_of", (F.col("_place") - F.col("_at") + 1).alias("_line"), "_near").distinct()
    rows = rows.join(items.withColumnRenamed("_item", "_of_item"), F.col("_item").eqNullSafe(F.col("_of_item")))
    size, begun = F.size("_plain"), F.greatest(F.col("_line") - 1, F.lit(0))

    def agreeing(step: int, backwards: bool) -> Column:
        """Words from one end of the item on that the document has, ``step`` words from the anchor's line."""
        same = F.transform(F.sequence(F.lit(0), size - 1), lambda k: F.coalesce(
            F.get(F.col("_near"), (F.col("_line") + k + step - begun).cast("int")) == F.get(F.col("_plain"), k), F.lit(False)))
        first = F.array_position(F.reverse(same) if backwards else same, False)
        return F.when(first == 0, size).otherwise((first - 1).cast("int"))

    both = [agreeing(a, False) + agreeing(b, True) for a, b in ((0, 0), (0, 1), (0, -1), (1, 0), (-1, 0))]
    rows = rows.filter(F.greatest(*both) >= size - 1)
    return rows.groupBy("_id", "_item").agg(F.max("_of").cast("long").alias("_windows"), F.min(F.greatest("_line", F.lit(0))).cast("long").alias("_first"),
                                            F.max(F.col("_line") + size - 1).cast("long").alias("_last"))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns, each computed once a row: later steps cannot repeat the expression of a generated row."""
    return df.select("*", F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))).alias("_x")).select(
        *df.columns, "_x.*")


def matched_windows(documents: DataFrame, windows: DataFrame, key: str, text: str) -> DataFrame:
    """_id, _place, and the columns of ``windows``, for every window of a document that the benchmark has; _raw: the
    document's marked words there where the window has slots; _near: its plain words around the item for an anchor.

    A window is looked up only where its rare words stand. All forms have the same words at the same places, but for
    marks, so the plain words lead to all of them in one pass; with more than ``BROADCAST_WINDOWS`` windows the pass is
    made for one part of them after another.
    """
    marks = _once(documents.select(F.col(key).alias("_id"), text_or_empty(text).alias("_t")), _m=marked_text(F.col("_t")))
    spaced = F.when(F.col("_t").rlike(SPACED), _steps(marked_text(_steps(F.col("_t"), SPACES)), TEMPLATE)).otherwise(F.lit(""))
    forms = {"_raw": _words(F.col("_m")), "_plain": _words(plain_text(F.col("_m"))), "_template": _words(_steps(F.col("_m"), TEMPLATE)),
             "_spaced": _words(spaced)}
    parts = max(1, -(-windows.count() // BROADCAST_WINDOWS))
    found = []
    for n in range(parts):
        part = windows.filter(F.pmod("_key", F.lit(parts)) == n)
        shapes = part.select("_rare", "_kind", "_length", "_offset").distinct()
        rare = {True: [], False: []}
        for r in part.select("_alone", "_rare").distinct().collect():  # no more than windows in the part
            rare[r["_alone"]].append(f"{r['_rare']}L")
        where = [f"filter(transform(_plain, (w, i) -> named_struct('i', i, 'h', {hash_})), x -> x.h IN ({', '.join(rare[alone])}))"
                 for alone, hash_ in ((False, "xxhash64(w, get(_plain, i + 1))"), (True, "xxhash64(w)")) if rare[alone]]
        places = F.expr(f"concat({', '.join(where)})" if where else "CAST(array() AS array<struct<i: int, h: bigint>>)")
        # Only the words around a place go on, not the whole text.
        begin = lambda x: F.greatest(x["i"] - AROUND, F.lit(0))
        near = lambda c, x: F.slice(c, begin(x) + 1, F.lit(2 * AROUND)).alias(c)
        placed = marks.withColumn("_plain", forms["_plain"]).select("_id", "_t", "_m", F.explode(F.array(places)).alias("_places"))
        stretches = _once(placed.filter(F.size("_places") > 0), **forms).select(
            "_id", F.size("_plain").alias("_size"), F.explode(F.transform("_places", lambda x: F.struct(
                x["h"].alias("_rare"), x["i"].alias("_pos"), begin(x).alias("_from"), *[near(c, x) for c in _FORMS]))).alias("_x")).select(
            "_id", "_size", "_x.*")
        size = F.col("_length")
        hits = stretches.join(F.broadcast(shapes), "_rare").withColumn("_place", F.col("_pos") - F.col("_offset")).filter(
            (F.col("_place") >= 0) & (F.col("_place") + size <= F.col("_size")))
        here = lambda c: F.slice(c, F.greatest(F.col("_place") - F.col("_from"), F.lit(0)) + 1, size)
        body = F.when(F.col("_kind") == "template", here("_template")).when(F.col("_kind") == "spaced", here("_spaced")).when(
            F.col("_kind") == "literal", here("_raw")).otherwise(here("_plain"))
        keyed = hits.withColumn("_key", F.xxhash64(F.concat("_kind", size.cast("string")), _hashes(body)))
        line = F.greatest(F.col("_place") - F.col("_at"), F.lit(0))  # the word before the item's first
        found.append(keyed.join(F.broadcast(part), ["_key", "_rare", "_kind", "_length", "_offset"]).select(
            "_id", "_place", *[c for c in windows.columns if c not in ("_key", "_rare", "_offset", "_alone")],
            F.when(F.size("_slots") > 0, here("_raw")).alias("_raw"),
            F.when(F.col("_kind") == "part", F.slice("_plain", F.greatest(line - F.col("_from"), F.lit(0)) + 1, F.col("_of") + (WINDOW + 1))).alias("_near")))
    return reduce(DataFrame.unionByName, found)


def contaminated(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                 item_text: str = "text", coverage: float = COVERAGE, consistent: float = CONSISTENT) -> DataFrame:
    """key, item, windows, matched, coverage, literal_coverage, slot_consistency, first_word, last_word of
    each contaminated pair of document and item."""
    windows = cut(benchmark_windows(benchmark, item, item_text))
    found = cut(matched_windows(documents, windows, key, text))
    anchored, found = found, found.filter("_kind != 'part'")
    slotted = found.filter(F.size("_slots") > 0)
    pairs = slotted.select(
        "_id", "_item", "_at", "_kind", "_place", (F.col("_place") - F.col("_at")).alias("_line"),
        F.transform("_slots", lambda k: F.struct(
            F.get(F.col("_values"), k).alias("own"), F.get(F.col("_raw"), k).alias("other"))).alias("_pairs"))
    pairs = cut(pairs.withColumn("_same", F.forall("_pairs", lambda p: p["own"].eqNullSafe(p["other"]))))

    def on(left: DataFrame, right: DataFrame):
        r = right.withColumnsRenamed({"_id": "_rid", "_item": "_ritem"})
        return r, F.col("_id").eqNullSafe(F.col("_rid")) & F.col("_item").eqNullSafe(F.col("_ritem"))

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(*on(left, right), "left").drop("_rid", "_ritem")

    def figures(found: DataFrame, pairs: DataFrame) -> DataFrame:
        """Figures of the pairs of document and item that have a window in common."""
        values = pairs.select("_id", "_item", "_line", F.explode("_pairs").alias("_p")).groupBy(
            "_id", "_item", "_line", "_p.own").agg(F.count_distinct("_p.other").alias("_kinds"))
        lines = values.groupBy("_id", "_item", "_line").agg(F.avg((F.col("_kinds") == 1).cast("double")).alias("_share"))
        agree = lines.groupBy("_id", "_item").agg(F.avg("_share").alias("_share"))
        literal = found.filter(F.size("_slots") == 0).select("_id", "_item", "_at").unionByName(
            pairs.filter("_same").select("_id", "_item", "_at")).groupBy("_id", "_item").agg(
            F.count_distinct("_at").alias("_literal"))
        counts = found.groupBy("_id", "_item").agg(
            F.count_distinct("_at").alias("matched"), F.max("_of").cast("long").alias("windows"),
            F.min("_place").cast("long").alias("first_word"), (F.max(F.col("_place") + F.col("_length")) - 1).cast("long").alias("last_word"))
        return beside(beside(counts, literal), agree).select(
            "_id", "_item", "windows", "matched", (F.col("matched") / F.col("windows")).alias("coverage"),
            (F.coalesce("_literal", F.lit(0)) / F.col("windows")).alias("literal_coverage"),
            F.coalesce("_share", F.lit(1.0)).alias("slot_consistency"), "first_word", "last_word")

    accepted = (F.col("literal_coverage") >= coverage) | (
        (F.col("coverage") >= coverage) & (F.col("slot_consistency") >= consistent))

    marked_form = F.col("_kind").isin("literal", "template")
    strict = cut(figures(found.filter(marked_form), pairs.filter(marked_form)).filter(accepted))
    unmarked = pairs.withColumn("_pairs", F.transform("_pairs", lambda p: F.struct(
        plain_text(p["own"]).alias("own"), plain_text(p["other"]).alias("other"))))
    wide = cut(figures(found, unmarked))
    plain = items_words(benchmark, item, item_text)
    edited = cut(_edited(anchored, plain))
    partial = _runs(found).unionByName(edited.select("_id", "_item")).distinct()
    some = wide.filter(accepted).unionByName(wide.join(*on(wide.filter(~accepted), partial), "left_semi")).distinct()
    bare = edited.join(*on(edited, wide.select("_id", "_item")), "left_anti").select(
        "_id", "_item", F.col("_windows").alias("windows"), F.lit(0).cast("long").alias("matched"), F.lit(0.0).alias("coverage"),
        F.lit(0.0).alias("literal_coverage"), F.lit(1.0).alias("slot_consistency"), F.col("_first").alias("first_word"), F.col("_last").alias("last_word"))
    others = some.unionByName(bare)
    others = others.join(*on(others, strict.select("_id", "_item")), "left_anti")
    return strict.unionByName(others).withColumnsRenamed({"_id": key, "_item": item})


def items_words(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """_item, _plain (words) of the items that have anchors."""
    words = _words(plain_text(marked_text(text_or_empty(text))))
    return benchmark.select(F.col(item).alias("_item"), words.alias("_plain")).filter(F.size("_plain").between(WINDOW, EDITED_WORDS))


def without_contaminated(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``documents``, all their columns, whose document holds no benchmark item."""
    names = documents.columns
    bad = cut(contaminated(documents, benchmark, key, text).select(F.col(key).alias("_bad")).distinct())
    return documents.join(bad, F.col(f"`{key}`").eqNullSafe(F.col("_bad")), "left_anti").select(
        *[F.col(f"`{c}`") for c in names])


def _sql_steps(expression: str, steps) -> str:
    for pattern, into in steps:
        into = "".join("\\" + c if k and into[k - 1] == "$" else c for k, c in enumerate(into) if c != "$")
        expression = f"regexp_replace({expression}, '{pattern}', '{into}', 'g')"
    return expression


def _sql_words(table: str, key: str) -> str:
    marked = _sql_steps(f"trim(lower({_sql_steps("coalesce(text, '')", MARKED)}))", [UNIT_STEP])
    return (f"SELECT {key}, CASE WHEN m = '' THEN [] ELSE string_split(m, ' ') END AS raw, "
            f"CASE WHEN m = '' THEN [] ELSE string_split({_sql_steps('m', TEMPLATE)}, ' ') END AS tpl "
            f"FROM (SELECT {key}, {marked} AS m FROM {table})")


#: Windows as lists of words. Items of the given tables are longer than a window, so one length is enough here.
SQL = f"""
WITH b AS ({_sql_words("benchmark", "item_id")}), d AS ({_sql_words("documents", "doc_id")}),
bi AS (SELECT item_id, unnest(range(1, len(raw) - {WINDOW - 2})) AS pos, raw, tpl, len(raw) - {WINDOW - 1} AS n FROM b WHERE len(raw) >= {WINDOW}),
bw AS (SELECT item_id, pos, n, raw[pos:pos + {WINDOW - 1}] AS vals, tpl[pos:pos + {WINDOW - 1}] AS w FROM bi),
bk AS (SELECT *, list_filter(range(1, {WINDOW + 1}), lambda k: w[k] IN ('{NAME}', '{UNIT}', '{NUMBER}')) AS slots FROM bw),
bx AS (SELECT item_id, pos, n, vals, len(slots) * 2 > {WINDOW} AS lit, CASE WHEN len(slots) * 2 > {WINDOW} THEN [] ELSE slots END AS slots,
  CASE WHEN len(slots) * 2 > {WINDOW} THEN vals ELSE w END AS w FROM bk),
di AS (SELECT doc_id, unnest(range(1, len(raw) - {WINDOW - 2})) AS place, raw, tpl FROM d WHERE len(raw) >= {WINDOW}),
dw AS (SELECT doc_id, place - 1 AS place, raw[place:place + {WINDOW - 1}] AS vals, tpl[place:place + {WINDOW - 1}] AS w FROM di),
f AS (SELECT doc_id, item_id, pos, place, n, slots, bx.vals AS own, dw.vals AS other FROM dw JOIN bx ON NOT lit AND dw.w = bx.w
  UNION ALL SELECT doc_id, item_id, pos, place, n, slots, bx.vals, dw.vals FROM dw JOIN bx ON lit AND dw.vals = bx.w),
v AS (SELECT doc_id, item_id, place - pos AS line, own[k] AS own, count(DISTINCT other[k]) AS kinds
  FROM (SELECT *, unnest(slots) AS k FROM f) GROUP BY ALL),
l AS (SELECT doc_id, item_id, line, avg(CASE WHEN kinds = 1 THEN 1.0::DOUBLE ELSE 0.0 END) AS share FROM v GROUP BY ALL),
s AS (SELECT doc_id, item_id, avg(share) AS share FROM l GROUP BY ALL),
c AS (SELECT doc_id, item_id, max(n) AS windows, count(DISTINCT pos) AS matched, min(place) AS first_word, max(place) + {WINDOW - 1} AS last_word,
  count(DISTINCT CASE WHEN len(list_filter(slots, lambda k: own[k] <> other[k])) = 0 THEN pos END) AS literal FROM f GROUP BY 1, 2),
o AS (SELECT doc_id, item_id, windows, matched, matched / windows AS coverage, literal / windows AS literal_coverage,
  coalesce(share, 1.0) AS slot_consistency, first_word, last_word FROM c LEFT JOIN s USING (doc_id, item_id))
SELECT * FROM o WHERE literal_coverage >= {COVERAGE} OR (coverage >= {COVERAGE} AND slot_consistency >= {CONSISTENT})"""
