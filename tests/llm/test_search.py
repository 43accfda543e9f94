import difflib
import random
import re
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest

from quillstat.llm import components, decontaminate, license_scan, order_minhash

DOCS = "doc_id long, text string, item_id string, node string, hub int"
ITEMS = "item_id long, text string, doc_id string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOCS)


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], ITEMS)


QUESTION = ("Yesterday the farmer Anna Berg sold 120 apples for 45 dollars at the market and later "
            "she bought 30 pears for 12 dollars from her neighbour before the market closed.")
OTHER = QUESTION.replace("Anna Berg", "Peter Holm").replace("120", "77").replace("45", "19").replace("30", "8").replace("12 ", "5 ")
PROSE = "it was a calm morning and nobody in the village had any idea of what would follow in the days after that one"


def found(spark, documents, benchmark):
    rows = decontaminate.contaminated(docs(spark, documents), items(spark, benchmark)).collect()
    return {(r.doc_id, r.item_id): r for r in rows}


def test_copies_and_other_parameters_are_found_and_prose_is_not(spark):
    twisted = OTHER.replace("at the market and", "at the market with Anna Berg and Anna Olsen and")
    rows = [(1, f"{PROSE}. {QUESTION} {PROSE}"), (2, f"{PROSE}\n{OTHER}\n{PROSE}"), (3, PROSE), (4, None), (5, ""),
            (6, QUESTION[:60]), (7, QUESTION.upper()), (1, PROSE), (None, QUESTION), (8, (QUESTION + " ") * 50), (9, twisted)]
    got = found(spark, rows, [(10, QUESTION), (11, None), (12, "two words"), (13, "What is seven plus nine?")])
    assert {k for k in got if k[0] != 9} - {(7, 10)} == {(1, 10), (2, 10), (None, 10), (8, 10)}
    assert got[1, 10].literal_coverage == 1.0 and got[1, 10].coverage == 1.0
    assert got[2, 10].literal_coverage < 0.5 and got[2, 10].slot_consistency == 1.0 and got[2, 10].coverage > 0.9


def test_copies_in_other_letter_case_or_line_breaks_are_found(spark):
    wrapped = OTHER.replace(" ", "\n")
    rows = [(7, QUESTION.upper()), (8, f"{PROSE} {QUESTION.title()}"), (9, QUESTION.lower()), (10, QUESTION.replace(" ", "\n")), (11, wrapped), (12, PROSE)]
    got = found(spark, rows, [(10, QUESTION)])
    assert set(got) == {(7, 10), (8, 10), (9, 10), (10, 10), (11, 10)}
    assert got[7, 10].literal_coverage == 1.0 and got[11, 10].literal_coverage < 0.5


def test_passages_and_items_with_one_edited_word_are_found(spark):
    rng = random.Random(12)
    long = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(59)]
    short = long[:15]
    part, few = " ".join(long[20:45]), " ".join(long[30:42])
    edits = [short[:7] + ["changed"] + short[8:], short[:7] + short[8:], short[:7] + ["added"] + short[7:], short[:3] + ["two"] + short[4:9] + ["two"] + short[10:]]
    rows = [(1, f"{PROSE} {part} {PROSE}"), (2, f"{PROSE} {few} {PROSE}")] + [(k + 3, f"{PROSE} {' '.join(e)} {PROSE}") for k, e in enumerate(edits)]
    got = found(spark, rows, [(1, " ".join(long)), (2, " ".join(short[:15]).upper())])
    assert {k for k in got if k[1] == 1} == {(1, 1)} and {k for k in got if k[1] == 2} == {(3, 2), (4, 2), (5, 2)}


def test_inconsistent_slots_are_refused(spark):
    item = "if 5 boys meet 5 girls and 5 dogs then 5 boys and 5 girls and 5 dogs walk home with 5 more of all"
    values = iter("1 2 3 4 6 7 8".split())
    mixed = re.sub("5", lambda _: next(values), item)
    same = item.replace("5", "9")
    assert set(found(spark, [(1, mixed), (2, same), (3, item)], [(1, item)])) == {(2, 1), (3, 1)}


def test_short_items_and_number_tables(spark):
    rows = [(1, f"{PROSE} what is seven plus nine {PROSE}"), (2, "1 2 3 4 5 6 7 8 9 10 11 12"), (3, "9 8 7 6 5 4 3 2 1 0 9 8"), (4, PROSE)]
    got = found(spark, rows, [(1, "What is seven plus nine?"), (2, "1 2 3 4 5 6 7 8 9 10 11 12")])
    assert set(got) == {(1, 1), (2, 2)}


def test_decontaminated_rows_keep_their_columns_and_empty_tables_pass(spark):
    df = docs(spark, [(1, f"{PROSE}. {QUESTION}"), (2, PROSE), (2, PROSE), (None, PROSE)])
    kept = decontaminate.without_contaminated(df, items(spark, [(1, QUESTION)]))
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "2", "None"]
    assert decontaminate.contaminated(df, items(spark, [])).count() == 0
    assert decontaminate.contaminated(docs(spark, []), items(spark, [(1, QUESTION)])).count() == 0
    assert decontaminate.without_contaminated(df, items(spark, [])).count() == 4


def longest_common(a, b):
    @lru_cache(maxsize=None)
    def run(i, j):
        if i == len(a) or j == len(b):
            return 0
        return run(i + 1, j + 1) + 1 if a[i] == b[j] else max(run(i + 1, j), run(i, j + 1))

    return run(0, 0)


def test_similarity_is_that_of_the_longest_common_run():
    rng = random.Random(5)
    for _ in range(200):
        base = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 60))]
        other = [w for w in base if rng.random() > 0.03]
        if rng.random() < 0.3:
            other = other[len(other) // 2:] + other[: len(other) // 2]
        a, b = order_minhash.shingles(base), order_minhash.shingles(other)
        if not len(a) or not len(b):
            continue
        assert len(set(a.tolist())) == len(a)
        run = longest_common(tuple(a.tolist()), tuple(b.tolist()))
        want = run / (len(a) + len(b) - run)
        got = order_minhash.similarity(a, b)
        assert got == pytest.approx(want) if want >= order_minhash.SIMILAR else got == 0 or got == pytest.approx(want)


def variants(seed, groups=12, size=14):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(4000)]
    rows, i = [], 0
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 220))]
        for _ in range(size):
            rate = rng.choice([0.003, 0.01, 0.02, 0.05])
            words = [rng.choice(vocabulary) if rng.random() < rate else w for w in base]
            rows.append((i, " ".join(words)))
            i += 1
    rng.shuffle(rows)
    return rows


def brute_groups(rows):
    parts = {k: order_minhash.shingles(order_minhash.words_of(t or "")) for k, (_, t) in enumerate(rows)}
    root = {k: k for k in parts}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    links = 0
    for a in parts:
        for b in parts:
            if a < b:
                same = order_minhash.words_of(rows[a][1] or "") == order_minhash.words_of(rows[b][1] or "")
                if same or (len(parts[a]) and len(parts[b]) and order_minhash.similarity(parts[a], parts[b]) >= order_minhash.SIMILAR):
                    links += 1
                    root[top(a)] = top(b)
    groups = defaultdict(list)
    for k in parts:
        groups[top(k)].append(rows[k][0])
    return {tuple(sorted(v)) for v in groups.values()}, links


def test_near_duplicates_match_all_pairs(spark):
    rows = variants(1) + [(5000, "Short text."), (5001, "short  TEXT"), (5002, None), (5003, ""), (5004, "one"), (5005, "word " * 3000)]
    want, links = brute_groups(rows)
    got = order_minhash.near_duplicates(docs(spark, rows).repartition(5)).collect()
    groups = defaultdict(list)
    for r in got:
        groups[r.group_id].append(r.doc_id)
        assert r.group_id <= r.class_id <= r.doc_id and r.kept == (r.doc_id == r.group_id)
    assert links > 300
    assert {tuple(sorted(v)) for v in groups.values()} == want
    assert all(r.group_size == len(groups[r.group_id]) for r in got)


def test_links_inside_large_buckets_are_all_found(spark):
    rng = random.Random(21)
    fresh = lambda n: [f"u{rng.randrange(10 ** 9)}" for _ in range(n)]
    passage, rows = fresh(88), []
    for _ in range(60):
        tail = fresh(12)
        rows += [(len(rows), " ".join(passage + tail)), (len(rows) + 1, " ".join(passage + tail[:2] + fresh(10)))]
    want, links = brute_groups(rows)
    groups = defaultdict(list)
    for r in order_minhash.near_duplicates(docs(spark, rows)).collect():
        groups[r.group_id].append(r.doc_id)
    assert links == 60 and {tuple(sorted(v)) for v in groups.values()} == want


def test_variants_with_too_many_edits_make_no_pairs(spark):
    """Variants of one text, all pairs just below the limit: none is compared; pairs of which one edit more is shared still are."""
    rng = random.Random(4)
    base, rows = [f"b{k}" for k in range(150)], []
    for i in range(120):
        words = list(base)
        for at in rng.sample(range(5, 145, 10), 4):
            words[at] = f"n{i}x{at}"
        rows.append((f"t{i:03}", " ".join(words)))
    near = list(base)
    for at in (20, 60):
        near[at] = f"m{at}"
    rows += [("u0", " ".join(near)), ("u1", " ".join(near[:100] + ["other"] + near[101:]))]
    texts = spark.createDataFrame(rows, "node string, _text string")
    first = order_minhash._prefixes(texts.withColumn("label", texts.node).select("node", "label"), texts).cache()
    pairs = {(r.centre, r.member) for r in order_minhash._pairs_of(first, first, "node > _node").collect()}
    shingled = {n: order_minhash.shingles(t.split()) for n, t in rows}
    similar = {(a, b) for a in shingled for b in shingled if a > b and order_minhash.similarity(shingled[a], shingled[b]) >= order_minhash.SIMILAR}
    assert ("u1", "u0") in similar and similar <= pairs and len(pairs) < 200


def test_reordered_text_is_not_near(spark):
    rng = random.Random(8)
    words = [f"v{rng.randrange(3000)}" for _ in range(200)]
    rows = [(1, " ".join(words)), (2, " ".join(words[100:] + words[:100]))]
    assert {r.group_id for r in order_minhash.near_duplicates(docs(spark, rows)).collect()} == {1, 2}


def test_keep_one_of_each_group(spark):
    rows = [(4, "a b c d e f g"), (2, "A b c d e f g!"), (2, "A b c d e f g!"), (9, "other words altogether here"), (None, "a b c d e f g"), (None, "x")]
    df = docs(spark, rows)
    kept = order_minhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("2", rows[1][1]), ("9", rows[3][1]), ("None", "x")]
    assert order_minhash.keep_one(docs(spark, [])).count() == 0
    assert order_minhash.near_duplicates(docs(spark, [])).count() == 0


def test_components_of_a_chain_a_star_and_repeats(spark):
    links = [(f"c{k:03}", f"c{k + 1:03}") for k in range(40)] + [("s000", f"s{k:03}") for k in range(1, 30)] + [("c001", "c000"), ("z", "z")]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a string, b string"), "a", "b").collect()}
    assert {v for k, v in got.items() if k[0] == "c"} == {"c000"} and {v for k, v in got.items() if k[0] == "s"} == {"s000"}
    assert "z" not in got


NOTICE = "Licensed under the Apache License, Version 2.0."


def test_notices_are_found_with_their_wording(spark):
    mit = license_scan.TEMPLATES["MIT"]
    wrapped = "\n".join(mit[k:k + 70] for k in range(0, len(mit), 70))
    rows = [(1, f"prose before\n{NOTICE}\nprose after"), (2, f"x\nCopyright (c) 2021 Jane Roe. All rights reserved.\n\n{mit}\ny"), (3, None), (4, ""),
            (5, "He got a driving licence and permission to leave."), (6, f"{NOTICE}\nReleased under the MIT License."), (6, "nothing"),
            (7, "Licensed under CC BY 4.0."), (8, "Licensed under CC BY-NC 4.0."), (None, NOTICE), (9, ("word " * 20000) + NOTICE),
            (10, mit.replace("free of charge", "for a fee")), (11, "Licensed under the Apache License, Version 3.0.")]
    got = license_scan.license_notices(docs(spark, rows)).collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    text = dict(reversed(rows))
    assert [r.license for r in by[1]] == ["Apache-2.0-notice"] and text[1][by[1][0].start:by[1][0].end] == NOTICE[:-1]
    assert {r.license for r in by[2] if r.confirmed} == {"Copyright-line", "MIT"}
    assert [r.license for r in by[6] if r.confirmed] == ["Apache-2.0-notice", "MIT-notice"]
    assert by[7][0].license == "CC-BY-4.0-notice" and by[8][0].license == "CC-BY-NC-4.0-notice"
    assert by[None][0].confirmed and by[9][0].confirmed and by[9][0].start == 100000
    assert by[10][0].license == "MIT" and by[10][0].confirmed and "charge" in by[10][0].missing and "fee" in by[10][0].extra
    assert not any(r.confirmed for r in by[11]) and not any(r.confirmed for r in by[5])
    assert not by[3] and not by[4]
    scan = license_scan.Scanner()
    assert [f[2] for f in scan(wrapped)] == ["MIT"]
    assert license_scan.license_notices(docs(spark, [])).count() == 0


def test_short_notices_in_long_lines_of_varied_prose_are_found():
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    scan = license_scan.Scanner()
    for name in ("MIT-notice", "All-rights-reserved", "Apache-2.0-notice", "Apache-2.0", "MIT"):
        for around in (40, 150, 1500):
            text = f"{prose(around)}. {license_scan.TEMPLATES[name]} {prose(around // 4)}"
            got = [f for f in scan(text) if f[-1]]
            assert [f[2] for f in got] == [name]
            assert license_scan.words(text[got[0][0]:got[0][1]]) == license_scan.words(license_scan.TEMPLATES[name])
    many = " ".join(f"{prose(30)}. {license_scan.TEMPLATES['MIT-notice']}" for _ in range(1200))
    assert [f[2] for f in scan(many)] == ["MIT-notice"] * 1200
    assert [f[2:3] + f[-1:] for f in scan(f"{prose(900)} Licensed under the Apache License, Version 3.0. {prose(900)}")] == [("Apache-2.0-notice", False)]
    assert not scan(f"{prose(300)} he got a driving licence and permission to leave {prose(300)}")


def test_reductions_rank_like_plain_compression():
    scan = license_scan.Scanner()
    for name, text in license_scan.TEMPLATES.items():
        if "<" not in text:
            assert scan.reductions(text)[0][0] >= scan.reductions(text)[1][0]
            assert name in [n for _, n in scan.reductions(text)[:2]]
    assert difflib.SequenceMatcher(None, ["a"], ["a"]).ratio() == 1 and np.isfinite(scan.reductions("x")[0][0])


def test_every_template_is_told_from_its_neighbours():
    """A text of one licence is found once, as that licence: alone, between lines and inside a long line."""
    rng = np.random.default_rng(8)
    vocabulary = "river stone walked under morning light garden seven windows paper cloud yellow market teacher".split()
    prose = lambda n: " ".join(rng.choice(vocabulary, n))
    scan = license_scan.Scanner()
    assert len(license_scan.TEMPLATES) > 45
    for name, template in license_scan.TEMPLATES.items():
        body = template.replace("<year>", "2021").replace("<holder>", "Some Company")
        for text in (body, f"{prose(40)}\n{body}\n{prose(40)}", f"{prose(60)}. {body} {prose(60)}"):
            assert [(f[2], f[-1]) for f in scan(text)] == [(name, True)]
