"""Quality classifier: averaged subword embeddings with a softmax, trained by numpy SGD.

A document is the mean of the vectors of its features: each white-space word, each pair of
neighbouring words and each run of 3 to 4 characters of a word (with marks at its ends), all
hashed into one table. Two neighbours that are the same word share one feature whatever the
word is, since a hashed pair of a word never seen says nothing. Two weight vectors and a
softmax follow. Only the text is read.

Training uses at most ``TRAIN_ROWS`` labelled rows and ``TRAIN_CHARACTERS`` characters of
them (a documented bound, chosen by a hash of the id; the rest of the labels are not needed for a table of this size). Scoring is a map
over whole texts: with the trained table fixed, each feature adds one number, so a text's
score is the mean of numbers; the numbers of a word are kept for reuse, within a bound.

Defined cases: a null or empty text has no features and gets the score of the mean vector
zero, i.e. that of the trained biases; null labels are not learned from; with no labelled rows of one of
the classes every score is the share of label 1 (0.5 without any); rows that repeat give
repeated rows; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.llm.common import Memo, labelled_sample, remainder, small_batches, text_or_empty

TRAIN_ROWS = 4000
TRAIN_CHARACTERS = 16_000_000
BUCKETS = 1 << 17
WIDTH = 12
EPOCHS = 12
BATCH = 32
RATE = 0.5
SEED = 5
GRAM_LENGTHS = (3, 4)
WORDS_KEPT = 250_000
SAME_PAIR = 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_features(word: str) -> np.ndarray:
    """Buckets of a word and its character runs; the first entry is the word's own."""
    marked = f"<{word}>"
    grams = [marked, *(marked[i:i + n] for n in GRAM_LENGTHS for i in range(len(marked) - n + 1))]
    return np.array([zlib.crc32(g.encode("utf-8", "surrogatepass")) for g in grams], dtype=np.int64) % BUCKETS


def pair_features(codes: np.ndarray) -> np.ndarray:
    """Buckets of neighbouring words, from the words' 32-bit codes."""
    left, right = codes[:-1].astype(np.uint64), codes[1:].astype(np.uint64)
    mixed = ((left * _MIX) ^ right) * _MIX
    return np.where(left == right, SAME_PAIR, (mixed >> np.uint64(40)).astype(np.int64) % BUCKETS)


def word_code(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of a whole text."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    kinds, which, counts = np.unique(np.array(words, dtype=object), return_inverse=True, return_counts=True)
    parts = [word_features(w) for w in kinds]
    weights = np.repeat(counts, [len(p) for p in parts])
    pairs = pair_features(np.array([word_code(w) for w in kinds])[which])
    buckets, at = np.unique(np.concatenate([*parts, pairs]), return_inverse=True)
    return buckets, np.bincount(at, np.concatenate([weights, np.ones(len(pairs))])).astype(np.float32)


class SubwordModel:
    """The trained table as one number per bucket, and a bias."""

    def __init__(self, values: np.ndarray, bias: float):
        self.values, self.bias = values.astype(np.float32), float(bias)

    @staticmethod
    def train(documents: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> "SubwordModel":
        share = float(labels.mean()) if len(labels) else 0.5
        if not 0 < share < 1:
            edge = min(max(share, 1e-6), 1 - 1e-6)
            return SubwordModel(np.zeros(BUCKETS), np.log(edge / (1 - edge)))
        rng = np.random.default_rng(SEED)
        table = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
        heads, biases = np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32)
        seen = np.zeros(BUCKETS, np.float32)
        for buckets, _ in documents:
            seen[buckets] += 1
        order = np.arange(len(documents))
        steps, step = EPOCHS * -(-len(order) // BATCH), 0
        for _ in range(EPOCHS):
            rng.shuffle(order)
            for first in range(0, len(order), BATCH):
                rate = RATE * (1 - step / steps)
                step += 1
                chosen = [i for i in order[first:first + BATCH] if len(documents[i][0])]
                if not chosen:
                    continue
                buckets = np.concatenate([documents[i][0] for i in chosen])
                lengths = np.array([len(documents[i][0]) for i in chosen])
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                share_of = np.concatenate([documents[i][1] / documents[i][1].sum() for i in chosen])[:, None]
                mean = np.add.reduceat(table[buckets] * share_of, starts, axis=0)
                logits = mean @ heads + biases
                odds = np.exp(logits - logits.max(axis=1, keepdims=True))
                error = odds / odds.sum(axis=1, keepdims=True)
                error[np.arange(len(chosen)), labels[chosen].astype(int)] -= 1
                back = (error @ heads.T).repeat(lengths, axis=0) * share_of
                kinds, at = np.unique(buckets, return_inverse=True)
                for d in range(WIDTH):
                    # Without the share of a feature in the batch, rare features would hardly move.
                    table[kinds, d] -= rate * 40 * np.bincount(at, back[:, d], len(kinds)).astype(np.float32)
                heads -= rate * (mean.T @ error) / len(chosen) * 4
                biases -= rate * error.mean(axis=0)
        values = table @ (heads[:, 1] - heads[:, 0])
        # A bucket that no training text has would add the noise of its start value.
        values[seen == 0] = 0.0
        return SubwordModel(values, biases[1] - biases[0])

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """Scores whole texts; the numbers of frequent words are kept."""

    def __init__(self, model: SubwordModel):
        self.model = model
        self.words = Memo(self._word, WORDS_KEPT)

    def _word(self, word: str) -> tuple[float, int, int]:
        buckets = word_features(word)
        return float(self.model.values[buckets].sum()), len(buckets), word_code(word)

    def __call__(self, text: str) -> float:
        words = text.split()
        total, features = 0.0, 0
        if words:
            sums, counts, codes = zip(*map(self.words.__getitem__, words))
            total, features = sum(sums), sum(counts)
            if len(words) > 1:
                pairs = pair_features(np.array(codes, dtype=np.uint64))
                total += float(self.model.values[pairs].sum(dtype=np.float64))
                features += len(pairs)
        logit = self.model.bias + (total / features if features else 0.0)
        return float(1 / (1 + np.exp(-np.clip(logit, -50, 50))))


def train_quality(documents: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", key: str = "doc_id",
                  text: str = "text", rows: int = TRAIN_ROWS) -> SubwordModel:
    """Train on at most ``rows`` rows of ``labels`` for which ``learn`` holds. The bounded sample
    is fitted in one task, which hands on the table of numbers; texts do not pass the driver."""
    small_batches(documents.sparkSession)
    texts = labelled_sample(documents, labels, learn, label, key, text, rows, TRAIN_CHARACTERS)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = []
        for batch in batches:
            for i, y, body in zip(batch["_id"], batch["_y"], batch["_text"]):
                buckets, counts = document_features(body)
                known.append((i, y, buckets.astype(np.int32), counts))
        known.sort(key=lambda r: r[0])
        model = SubwordModel.train([r[2:] for r in known], np.array([r[1] for r in known]))
        yield pd.DataFrame({"bias": [model.bias], "values": [model.values]})

    # Partitions without rows give no model; coalescing leaves one partition, or none at all.
    got = texts.coalesce(1).mapInPandas(fit, "bias double, values array<float>").first()
    if got is None:
        return SubwordModel.train([], np.zeros(0))
    return SubwordModel(np.array(got["values"], dtype=np.float32), got["bias"])


def score_column(model: SubwordModel, text: Column) -> Column:
    """Score of a text column, 0 to 1; higher means label 1 is likelier."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = model.scorer()
        for batch in batches:
            yield pd.Series([run(x) for x in batch], dtype="float64")

    return score(text_or_empty(text))


def score_quality(documents: DataFrame, labels: DataFrame, held_out: Column, cut_at: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``documents``; ``held_out`` rows are never learned from."""
    small_batches(documents.sparkSession)
    model = train_quality(documents, labels, ~held_out)
    scored = documents.select("doc_id", held_out.alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= cut_at).cast("int"))


def held_out_rows(divisor: int = 3, kept: int = 1) -> Column:
    return remainder(F.col("doc_id"), divisor) == kept
