"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Tokens are runs of letters, in lower case. Documents are labelled, tokens are not, so token
labels are derived first: a word or word beginning is a mark of toxicity when it occurs in
toxic documents more often than chance allows (a binomial bound over all features tested);
tokens of toxic documents that carry such a mark are labelled 1, all others 0.

A two-state chain is trained on those tokens by gradient steps on its log-likelihood. Its
features are the word, its beginnings and its ending (hashed), and the transitions. Forward
and backward passes run over all tokens of a batch at once: the recursion is a product of 2x2
matrices, taken in blocks, and the matrix of a document's first token forgets what came
before, so documents need no padding and long texts are read whole.

The score of a document is a logistic function, fitted on the training documents, of the
largest marginal and of the expected number of toxic tokens. Offsets are the character ranges
of neighbouring tokens whose marginal is at least one half.

Training uses at most ``TRAIN_ROWS`` labelled rows and ``TRAIN_CHARACTERS`` characters of
them, chosen by a hash of the id (a documented bound).

Defined cases: null and empty texts, and texts without letters, have no tokens and score as a
document whose marginals are all zero; null labels are not learned from; with labels of one
class only the score is the share of label 1 for every text; repeated rows give repeated
rows; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.llm.common import Memo, held, labelled_sample, remainder, small_batches, text_or_empty

TRAIN_ROWS = 4000
TRAIN_CHARACTERS = 16_000_000
BUCKETS = 1 << 18
PREFIXES = (4, 5, 6, 7)
LEAST_SHARE = 0.5
ROUNDS = 40
RATE = 0.25
RIDGE = 1e-4
BLOCK = 256
TOKENS_AT_ONCE = 200_000  # of whole documents in one forward-backward pass of the fit
FLOOR = 1e-6
WORDS_KEPT = 250_000
TOKEN = re.compile(r"[^\W\d_]+")


def tokens(text: str) -> list[str]:
    return [w.lower() for w in TOKEN.findall(text)]


def features(word: str) -> list[str]:
    """The word, its beginnings where they are shorter than it, and its ending."""
    return ["w" + word, *("p" + word[:n] for n in PREFIXES if len(word) > n), "s" + word[-3:]]


def buckets(word: str) -> np.ndarray:
    return np.array([zlib.crc32(f.encode("utf-8", "surrogatepass")) % BUCKETS for f in features(word)], dtype=np.int64)


def toxic_marks(documents: list[np.ndarray], kinds: list[str], labels: np.ndarray) -> set[str]:
    """Features found in toxic documents so often that chance would give about one such feature; documents hold places in ``kinds``."""
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for codes, y in zip(documents, labels):
        seen[int(y)].update({f for k in np.unique(codes) for f in features(kinds[k]) if f[0] != "s"})
    base = float(labels.mean())
    tested = len(seen[1])
    marks = set()
    for feature, hits in seen[1].items():
        n = hits + seen[0][feature]
        share = hits / n
        if hits < 3 or share < LEAST_SHARE or share <= base:
            continue
        surprise = hits * np.log(share / base) + ((n - hits) * np.log((1 - share) / (1 - base)) if hits < n else 0)
        if surprise > np.log(tested):
            marks.add(feature)
    return marks


class Chain:
    """Marginals of a two-state chain over concatenated documents."""

    def __init__(self, start: np.ndarray, moves: np.ndarray):
        self.start, self.moves = np.exp(start), np.exp(moves)

    def _matrices(self, emission: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Entries (to, from) of each token's matrix, in blocks: arrays of shape (BLOCK, blocks)."""
        n = len(emission)
        blocks = -(-n // BLOCK)
        x = np.ones(blocks * BLOCK)
        x[:n] = np.exp(np.clip(emission, -30, 30))
        f = np.ones(blocks * BLOCK, dtype=bool)
        f[:n] = first
        x, f = x.reshape(blocks, BLOCK).T, f.reshape(blocks, BLOCK).T
        t, s = self.moves, self.start
        pick = lambda a, b: np.where(f, a, b)
        return pick(s[0], t[0, 0]), pick(s[0], t[1, 0]), x * pick(s[1], t[0, 1]), x * pick(s[1], t[1, 1])

    def _pass(self, m: tuple[np.ndarray, ...], order: range) -> tuple[np.ndarray, np.ndarray]:
        """Normalised vectors after each token, taking tokens of a block in ``order``."""
        m00, m01, m10, m11 = m
        blocks = m00.shape[1]
        p00, p01, p10, p11 = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)
        for k in order:
            a, b, c, d = m00[k], m01[k], m10[k], m11[k]
            q00, q01 = a * p00 + b * p10, a * p01 + b * p11
            q10, q11 = c * p00 + d * p10, c * p01 + d * p11
            scale = 1 / (q00 + q01 + q10 + q11)
            p00, p01, p10, p11 = q00 * scale, q01 * scale, q10 * scale, q11 * scale
        v0, v1 = np.empty(blocks), np.empty(blocks)
        x, y = 0.5, 0.5
        todo = range(blocks) if order.step > 0 else range(blocks - 1, -1, -1)
        a, b, c, d = p00.tolist(), p01.tolist(), p10.tolist(), p11.tolist()
        for k in todo:
            v0[k], v1[k] = x, y
            x, y = a[k] * x + b[k] * y, c[k] * x + d[k] * y
            x, y = x / (x + y), y / (x + y)
        out0, out1 = np.empty_like(m00), np.empty_like(m00)
        for k in order:
            w0, w1 = m00[k] * v0 + m01[k] * v1, m10[k] * v0 + m11[k] * v1
            scale = 1 / (w0 + w1)
            v0, v1 = w0 * scale, w1 * scale
            out0[k], out1[k] = v0, v1
        return out0, out1

    def vectors(self, emission: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """alpha0, alpha1, beta0, beta1 of every token, each pair scaled on its own."""
        n = len(emission)
        m00, m01, m10, m11 = self._matrices(emission, first)
        a0, a1 = self._pass((m00, m01, m10, m11), range(BLOCK))
        # Backward: beta of a token is the transposed matrix of the next token times its beta.
        b0, b1 = self._pass((m00, m10, m01, m11), range(BLOCK - 1, -1, -1))
        flat = lambda m: m.T.ravel()
        after0, after1 = flat(b0), flat(b1)
        beta0, beta1 = np.append(after0[1:], 0.5)[:n], np.append(after1[1:], 0.5)[:n]
        return flat(a0)[:n], flat(a1)[:n], beta0, beta1

    def expected(self, emission: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all tokens, and the expected number of moves between states (from, to)."""
        if not len(emission):
            return np.zeros(0), np.zeros((2, 2))
        a0, a1, b0, b1 = self.vectors(emission, first)
        x, later, t = np.exp(np.clip(emission[1:], -30, 30)), ~first[1:], self.moves
        pairs = [a0[:-1] * t[0, 0] * b0[1:], a0[:-1] * t[0, 1] * x * b1[1:], a1[:-1] * t[1, 0] * b0[1:], a1[:-1] * t[1, 1] * x * b1[1:]]
        whole = pairs[0] + pairs[1] + pairs[2] + pairs[3]
        return a1 * b1 / (a0 * b0 + a1 * b1), np.array([np.sum((q / whole)[later]) for q in pairs]).reshape(2, 2)

    def marginals(self, emission: np.ndarray, first: np.ndarray) -> np.ndarray:
        if not len(emission):
            return np.zeros(0)
        a0, a1, b0, b1 = self.vectors(emission, first)
        return a1 * b1 / (a0 * b0 + a1 * b1)


def _spans(lengths: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Runs of whole documents of about ``TOKENS_AT_ONCE`` tokens: their tokens and their lengths."""
    ends = np.cumsum(lengths)
    group = (ends - lengths) // TOKENS_AT_ONCE
    cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(lengths) else np.zeros(0, int)
    for a, b in zip(cuts, np.append(cuts[1:], len(lengths))):
        yield slice(int(ends[a] - lengths[a]), int(ends[b - 1])), lengths[a:b]


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Marks of the first token of each non-empty document."""
    first = np.zeros(int(lengths.sum()), dtype=bool)
    at = np.cumsum(lengths) - lengths
    first[at[lengths > 0]] = True
    return first


def document_sums(p: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest marginal and sum of marginals per document; 0 without tokens."""
    top, total = np.zeros(len(lengths)), np.zeros(len(lengths))
    full = lengths > 0
    if full.any():
        at = (np.cumsum(lengths) - lengths)[full]
        top[full] = np.maximum.reduceat(p, at)
        total[full] = np.add.reduceat(np.where(p > 0.01, p, 0.0), at)
    return top, total


def _evidence(top: np.ndarray, total: np.ndarray) -> np.ndarray:
    top = np.clip(top, FLOOR, 1 - FLOOR)
    return np.stack([np.ones(len(top)), np.log(top / (1 - top)), np.log1p(total)], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class ToxicModel:
    """Emission weights, chain parameters and the score function."""

    def __init__(self, weights, bias, start, moves, curve):
        self.weights, self.bias, self.start, self.moves, self.curve = weights, bias, start, moves, curve

    @staticmethod
    def train(texts: list[str], labels: np.ndarray) -> "ToxicModel":
        share = float(labels.mean()) if len(labels) else 0.0
        if not 0 < share < 1:
            edge = min(max(share, 1e-6), 1 - 1e-6)
            return ToxicModel(np.zeros(BUCKETS, np.float32), -8.0, np.zeros(2), np.zeros((2, 2)),
                              np.array([np.log(edge / (1 - edge)), 0.0, 0.0]))
        kinds: dict[str, int] = {}
        documents = [np.fromiter((kinds.setdefault(w, len(kinds)) for w in tokens(t)), np.int32) for t in texts]
        marks = toxic_marks(documents, list(kinds), labels)
        lengths = np.array([len(d) for d in documents])
        which = np.concatenate(documents)
        del documents
        marked = np.array([any(f in marks for f in features(w)) for w in kinds], dtype=bool)
        truth = marked[which] & np.repeat(labels.astype(bool), lengths)
        parts = [buckets(w) for w in kinds]
        sizes = np.array([len(p) for p in parts])
        flat, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), sizes)
        first = starts_of(lengths)
        weights, bias = np.zeros(BUCKETS), -4.0
        start, moves = np.zeros(2), np.zeros((2, 2))
        positive = np.bincount(which[truth], minlength=len(kinds)).astype(float)
        later = ~first
        pairs = (2 * truth[:-1] + truth[1:])[later[1:]]
        moved = np.bincount(pairs, minlength=4).astype(float).reshape(2, 2)
        began = np.array([np.sum(~truth[first]), np.sum(truth[first])], float)
        steps: dict[str, list] = {}

        def adam(name: str, slope, round_: int):
            held = steps.setdefault(name, [0.0, 0.0])
            held[0] = 0.8 * held[0] + 0.2 * slope
            held[1] = 0.98 * held[1] + 0.02 * slope * slope
            return RATE * (held[0] / (1 - 0.8 ** round_)) / (np.sqrt(held[1] / (1 - 0.98 ** round_)) + 1e-6)

        scale = 1 / max(1.0, positive.sum())
        for round_ in range(1, ROUNDS + 1):
            words = bias + np.bincount(owner, weights[flat], len(kinds))
            chain = Chain(start, moves)
            guessed, expected, opened = np.zeros(len(kinds)), np.zeros((2, 2)), np.zeros(2)
            for part, _ in _spans(lengths):
                p, moving = chain.expected(words[which[part]], first[part])
                guessed += np.bincount(which[part], p, len(kinds))
                expected += moving
                opened += [np.sum(1 - p[first[part]]), np.sum(p[first[part]])]
            error = positive - guessed
            slope = np.bincount(flat, error[owner], BUCKETS) * scale - RIDGE * weights
            weights += adam("weights", slope, round_)
            bias += adam("bias", error.sum() * scale, round_)
            moves = moves + adam("moves", (moved - expected) * scale - RIDGE * moves, round_)
            start = start + adam("start", (began - opened) * scale - RIDGE * start, round_)
        model = ToxicModel(weights.astype(np.float32), float(bias), start, moves, np.zeros(3))
        words, chain = bias + np.bincount(owner, weights[flat], len(kinds)), Chain(start, moves)
        sums = [document_sums(chain.marginals(words[which[part]], first[part]), sizes_) for part, sizes_ in _spans(lengths)]
        evidence, y = _evidence(*(np.concatenate(c) for c in zip(*sums))), labels.astype(float)
        curve = np.zeros(3)
        for _ in range(25):
            guess = _sigmoid(evidence @ curve)
            slope = evidence.T @ (y - guess) - 0.05 * curve
            bend = (evidence * (guess * (1 - guess))[:, None]).T @ evidence + 0.05 * np.eye(3)
            curve = curve + np.linalg.solve(bend, slope)
        model.curve = curve
        return model

    def reader(self) -> "Reader":
        return held(Reader, self)


class Reader:
    """Scores batches of whole texts."""

    def __init__(self, model: ToxicModel):
        self.model, self.chain = model, Chain(model.start, model.moves)
        self.words = Memo(self._word, WORDS_KEPT)

    def _word(self, word: str) -> float:
        return self.model.bias + float(self.model.weights[buckets(word.lower())].sum())

    def marginals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(marginals of all tokens, tokens per text)."""
        found = [TOKEN.findall(t) for t in texts]
        lengths = np.array([len(f) for f in found], dtype=np.int64)
        emission = np.fromiter((self.words[w] for f in found for w in f), float, int(lengths.sum()))
        return self.chain.marginals(emission, starts_of(lengths)), lengths

    def scores(self, texts: list[str]) -> np.ndarray:
        return _sigmoid(_evidence(*document_sums(*self.marginals(texts))) @ self.model.curve)

    def spans(self, text: str, p: np.ndarray) -> list[tuple[int, int]]:
        """Character ranges of neighbouring tokens with a marginal of at least one half."""
        out: list[tuple[int, int]] = []
        near = False
        for place, toxic in zip(TOKEN.finditer(text), p >= 0.5):
            if toxic:
                out.append((out.pop()[0] if near else place.start(), place.end()))
            near = bool(toxic)
        return out


def train_toxicity(documents: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", key: str = "doc_id",
                   text: str = "text", rows: int = TRAIN_ROWS) -> ToxicModel:
    """Train on at most ``rows`` rows of ``labels`` for which ``learn`` holds. The bounded sample
    is fitted in one task, which hands on the parameters; texts do not pass the driver."""
    small_batches(documents.sparkSession)
    sample = labelled_sample(documents, labels, learn, label, key, text, rows, TRAIN_CHARACTERS)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = sorted((i, y, body) for batch in batches for i, y, body in zip(batch["_id"], batch["_y"], batch["_text"]))
        labels = np.array([r[1] for r in known])
        model = ToxicModel.train([r[2] for r in known], labels)
        yield pd.DataFrame({"weights": [model.weights], "bias": [model.bias], "start": [model.start],
                            "moves": [model.moves.ravel()], "curve": [model.curve]})

    schema = "weights array<float>, bias double, start array<double>, moves array<double>, curve array<double>"
    got = sample.coalesce(1).mapInPandas(fit, schema).first()
    if got is None:
        return ToxicModel.train([], np.zeros(0))
    return ToxicModel(np.array(got["weights"], dtype=np.float32), got["bias"], np.array(got["start"]),
                      np.array(got["moves"]).reshape(2, 2), np.array(got["curve"]))


def score_column(model: ToxicModel, text: Column) -> Column:
    """Score of a text column, 0 to 1; higher means label 1 is likelier."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = model.reader()
        for batch in batches:
            yield pd.Series(run.scores(batch.tolist()), dtype="float64")

    return score(text_or_empty(text))


def toxic_spans(documents: DataFrame, model: ToxicModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score, spans (start, end) of every row."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = model.reader()
        for batch in batches:
            texts = batch[text].tolist()
            p, lengths = reader.marginals(texts)
            top, total = document_sums(p, lengths)
            ends = np.cumsum(lengths)
            spans = [[{"start": a, "end": b} for a, b in reader.spans(t, p[e - n:e])] if hot >= 0.5 else []
                     for t, n, e, hot in zip(texts, lengths, ends, top)]
            yield pd.DataFrame({key: batch[key].astype("Int64"), "score": _sigmoid(_evidence(top, total) @ model.curve),
                                "spans": spans})

    rows = documents.select(F.col(key).cast("long").alias(key), text_or_empty(text).alias(text))
    return rows.mapInPandas(run, f"`{key}` long, score double, spans array<struct<start:int,end:int>>")


def held_out_rows(divisor: int = 4, kept: int = 2) -> Column:
    return remainder(F.col("doc_id"), divisor) == kept


def score_toxicity(documents: DataFrame, labels: DataFrame, held_out: Column, cut_at: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted, spans for every row; ``held_out`` rows are never learned from."""
    model = train_toxicity(documents, labels, ~held_out)
    return toxic_spans(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= cut_at).cast("int").alias("predicted"), "spans")


def keep_harmless(documents: DataFrame, model: ToxicModel, cut_at: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``documents``, all their columns, whose score is below ``cut_at``."""
    small_batches(documents.sparkSession)
    names = documents.columns
    return documents.filter(score_column(model, F.col(text)) < cut_at).select(*[F.col(f"`{c}`") for c in names])
