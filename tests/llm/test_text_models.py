import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstat.llm import quality_model, toxic_crf

DOCS = "doc_id long, text string, score string, quality int, _id int"
LABELS = "doc_id long, quality int, toxic int"
PLAIN = "the river runs past old stone houses while people walk slowly along its quiet banks in summer evenings".split()
JUNK = "buy$$$ now!!! cheap%%% click### free&&& offer*** win$$$".split()
INSULTS = "idiot loser stupid".split()


def corpus(n, seed, toxic):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        words = [rng.choice(PLAIN) + rng.choice(["", "s", "ing"]) for _ in range(rng.randint(5, 60))]
        if bad and toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        elif bad:
            words = [rng.choice(JUNK) if rng.random() < 0.5 else w for w in words]
        docs.append((i, " ".join(words), "x", 9, 1))
        labels.append((i, None if i % 17 == 0 else int(not bad), None if i % 17 == 0 else int(bad)))
    return docs, labels


ODD = [(9001, None, "x", 1, 1), (9002, "", "x", 1, 1), (9003, "?!", "x", 1, 1), (9004, "word " * 4000, "x", 1, 1),
       (9005, "same text", "x", 1, 1), (9005, "same text", "x", 1, 1), (None, "no id", "x", 1, 1)]


def remainder(i, d):
    return zlib.crc32(("" if i is None else str(i)).encode()) % d


def test_quality_learns_and_holds_out(spark):
    docs, labels = corpus(400, 1, False)
    truth = {i: q for i, q, _ in labels}
    rows = quality_model.score_quality(spark.createDataFrame(docs + ODD, DOCS), spark.createDataFrame(labels, LABELS),
                                       quality_model.held_out_rows()).collect()
    assert len(rows) == len(docs) + len(ODD) and rows[0].__fields__ == ["doc_id", "held_out", "score", "predicted"]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == (remainder(r.doc_id, 3) == 1) for r in rows)
    held = [r for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    # Labels of held-out rows play no part.
    turned = [(i, None if q is None else 1 - q, t) if remainder(i, 3) == 1 else (i, q, t) for i, q, t in labels]
    again = quality_model.score_quality(spark.createDataFrame(docs, DOCS), spark.createDataFrame(turned, LABELS),
                                        quality_model.held_out_rows()).collect()
    first = {r.doc_id: r.score for r in rows}
    assert all(first[r.doc_id] == r.score for r in again)


def test_quality_repeats_and_features():
    buckets, counts = quality_model.document_features("aa aa aa bb")
    assert counts.sum() == 3 * len(quality_model.word_features("aa")) + len(quality_model.word_features("bb")) + 3
    assert counts[list(buckets).index(quality_model.SAME_PAIR)] == 2
    model = quality_model.SubwordModel(np.arange(quality_model.BUCKETS) / quality_model.BUCKETS, 0.25)
    text = "one two two three " * 30
    buckets, counts = quality_model.document_features(text)
    want = 1 / (1 + np.exp(-(0.25 + (model.values[buckets] * counts).sum() / counts.sum())))
    assert abs(model.scorer()(text) - want) < 1e-5


@pytest.mark.parametrize("module,label", [(quality_model, "quality"), (toxic_crf, "toxic")])
def test_labels_of_one_class_and_no_rows(spark, module, label):
    score = module.score_quality if label == "quality" else module.score_toxicity
    docs = spark.createDataFrame(ODD, DOCS)
    one = spark.createDataFrame([(9002, 1, 0), (9005, 1, 0)], LABELS)
    none = spark.createDataFrame([], LABELS)
    for labels in (one, none):
        assert len({r.score for r in score(docs, labels, F.lit(False)).collect()}) == 1
    assert score(spark.createDataFrame([], DOCS), none, module.held_out_rows()).count() == 0


def brute(chain, emission):
    """Marginals of one document from all paths."""
    n = len(emission)
    weight = np.zeros((n, 2))
    for path in itertools.product((0, 1), repeat=n):
        w = chain.start[path[0]]
        for a, b in zip(path, path[1:]):
            w *= chain.moves[a, b]
        w *= np.exp(sum(e for e, s in zip(emission, path) if s))
        for t, s in enumerate(path):
            weight[t, s] += w
    return weight[:, 1] / weight.sum(axis=1)


def test_marginals_match_all_paths_across_documents_and_blocks(monkeypatch):
    monkeypatch.setattr(toxic_crf, "BLOCK", 4)
    rng = np.random.default_rng(2)
    chain = toxic_crf.Chain(rng.normal(size=2), rng.normal(size=(2, 2)))
    lengths = np.array([3, 0, 7, 1, 5, 0])
    emission = rng.normal(size=lengths.sum()) * 2
    got = chain.marginals(emission, toxic_crf.starts_of(lengths))
    want, at = [], 0
    for n in lengths:
        if n:
            want.append(brute(chain, emission[at:at + n]))
        at += n
    assert np.allclose(got, np.concatenate(want), atol=1e-9)
    top, total = toxic_crf.document_sums(got, lengths)
    assert top[1] == 0 and np.isclose(top[0], got[:3].max())


def test_toxicity_learns_holds_out_and_marks_spans(spark):
    docs, labels = corpus(500, 4, True)
    truth = {i: t for i, _, t in labels}
    frame, known = spark.createDataFrame(docs + ODD, DOCS), spark.createDataFrame(labels, LABELS)
    rows = toxic_crf.score_toxicity(frame, known, toxic_crf.held_out_rows()).collect()
    assert len(rows) == len(docs) + len(ODD)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (remainder(r.doc_id, 4) == 2) for r in rows)
    held = [r for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    texts = {i: t for i, t, *_ in docs}
    words = {texts[r.doc_id][s.start:s.end] for r in rows if r.doc_id in texts for s in r.spans}
    assert words and all(set(w.split()) <= set(INSULTS) for w in words)
    model = toxic_crf.train_toxicity(frame, known, ~toxic_crf.held_out_rows())
    kept = toxic_crf.keep_harmless(frame, model)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if not r.predicted)
