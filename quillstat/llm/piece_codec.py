"""SentencePiece encoding and decoding by a streaming Viterbi search.

The vocabulary is a byte-pair model, so the score of a path is 0 if every adjacent pair of
pieces stands under the model's merges, and minus infinity otherwise. Exactly one path with
score 0 ends at each boundary of a text, so the survivor of a boundary is one piece and its
start, and the ids are those of the ``sentencepiece`` library.

``StreamingViterbi`` keeps the survivors of the last ``longest piece`` boundaries only.
New pieces can attach to those alone; as soon as all of their paths pass through one
boundary, the ids before it are final and leave the window. Text may come in any portions.

A boundary that no piece spans (before a run of word marks, and around characters outside
the vocabulary, which become bytes) makes all paths converge, so the ids of a word do not
depend on its neighbours and are kept for reuse, within a bound.

Defined cases: null text is empty and has no ids; columns other than id and text play no
part; rows that repeat give repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.llm.common import Memo, crc32, held, small_batches, text_or_empty

MARK = "▁"
WORDS_KEPT = 600_000
PORTION = 256
PAIRS_KEPT = 500_000


#: A stretch that ends in marks; its parts are encoded apart if no piece spans the place between them.
CLOSED = re.compile(r"^(.*[^\W\d_])([^\w\s]+)\Z", re.S)


class Pieces:
    """The pieces of a byte-pair SentencePiece model, and which pairs of them may stand together."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
                   for i in range(count)]
        self.text = [model.id_to_piece(i) for i in range(count)]
        self.id_of = {self.text[i]: i for i in range(count) if not special[i]}
        # A better score merges first; ids of one score do not occur in byte-pair models.
        self.rank = {p: -model.get_score(i) for p, i in self.id_of.items()}
        self.bytes = {int(self.text[i][3:5], 16): i for i in range(count) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.silent = {i for i in range(count) if model.is_control(i)}
        self.unknown = model.unk_id()
        self.longest = max(map(len, self.id_of))
        #: Every beginning of a piece; True where it is a piece itself.
        self.beginnings: dict[str, bool] = {}
        for piece in self.id_of:
            for k in range(1, len(piece)):
                self.beginnings.setdefault(piece[:k], False)
            self.beginnings[piece] = True
        #: Neighbouring characters inside a piece; between any others no piece stands.
        self.inside = {p[k:k + 2] for p in self.id_of for k in range(len(p) - 1)}
        if any(MARK in p.lstrip(MARK) for p in self.id_of):
            raise ValueError("pieces must hold word marks at their start only")
        self.alone = Memo(lambda p: self.merged(p) == [p], PAIRS_KEPT)
        self.pair = Memo(self._pair, PAIRS_KEPT)

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by the model's merges: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                rank = self.rank.get(parts[k] + parts[k + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _pair(self, both: tuple[str, str]) -> bool:
        return self.merged(both[0] + both[1]) == [both[0], both[1]]


class StreamingViterbi:
    """Ids of a stretch of known characters that comes in portions."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.text = ""
        #: Survivor of each boundary in the window: the piece that ends there. Boundary 0 is final.
        self.last: list[str | None] = [None]
        #: The final piece before boundary 0.
        self.left: str | None = None

    def push(self, portion: str) -> list[int]:
        """Take more text; the ids that have become final."""
        out: list[int] = []
        for start in range(0, len(portion), PORTION):
            self._advance(portion[start:start + PORTION])
            if len(self.text) > self.pieces.longest:
                out += self._settle(self._meeting())
        return out

    def finish(self) -> list[int]:
        """The ids still in the window; the search is ready for another stretch."""
        out = self._settle(len(self.last) - 1)
        self.text, self.last, self.left = "", [None], None
        return out

    def _advance(self, portion: str) -> None:
        """Survivors of the boundaries that the portion adds."""
        beginnings, alone, pair = self.pieces.beginnings, self.pieces.alone, self.pieces.pair
        old = len(self.text)
        self.text += portion
        text, last = self.text, self.last
        size = len(text)
        # Pieces by the boundary they end at, in the order of their starts.
        ending: list[list[tuple[int, str]]] = [[] for _ in range(size - old)]
        for start in range(max(0, old - self.pieces.longest + 1), size):
            if start > old:
                last.append(self._survivor(ending[start - old - 1], alone, pair))
            for end in range(start + 1, size + 1):
                piece = text[start:end]
                whole = beginnings.get(piece)
                if whole is None:
                    break
                if whole and end > old:
                    ending[end - old - 1].append((start, piece))
        if size > old:
            last.append(self._survivor(ending[-1], alone, pair))

    def _survivor(self, candidates: list[tuple[int, str]], alone: Memo, pair: Memo) -> str:
        for start, piece in candidates:
            if len(piece) == 1 or alone[piece]:
                before = self.last[start] if start else self.left
                if before is None or pair[before, piece]:
                    return piece
        raise ValueError("no path reaches a boundary of the text")

    def _meeting(self) -> int:
        """The last boundary that the paths of all boundaries still in reach have in common."""
        last, longest = self.last, self.pieces.longest
        end = len(last) - 1
        fronts = set(range(max(0, end - longest + 1), end + 1))
        while len(fronts) > 1:
            far = max(fronts)
            fronts.remove(far)
            fronts.add(far - len(last[far]))
        return fronts.pop()

    def _settle(self, at: int) -> list[int]:
        path, end = [], at
        while end > 0:
            path.append(self.last[end])
            end -= len(self.last[end])
        if path:
            self.left = path[0]
        self.text, self.last = self.text[at:], [None, *self.last[at + 1:]]
        return [self.pieces.id_of[p] for p in reversed(path)]


class Codec:
    """Encodes and decodes whole texts; ids are little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        known = "".join(sorted(c for c in self.pieces.id_of if len(c) == 1))
        self.outside = re.compile(f"([^{re.escape(known)}]+)")
        self.stretches = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.words = Memo(self._word, WORDS_KEPT)
        self.spoken = Memo(self._spoken, WORDS_KEPT)

    def _word(self, word: str) -> bytes:
        """Ids of a stretch between boundaries that no piece spans."""
        closed = CLOSED.match(word)
        if closed and closed[1][-1] + closed[2][0] not in self.pieces.inside:
            return self.words[closed[1]] + self.words[closed[2]]
        out: list[int] = []
        for k, part in enumerate(self.outside.split(word)):
            if k % 2:
                for c in part:
                    if self.pieces.bytes:
                        out += [self.pieces.bytes[b] for b in c.encode("utf-8", "surrogatepass")]
                    else:
                        out.append(self.pieces.unknown)
            elif part:
                search = StreamingViterbi(self.pieces)
                out += search.push(part)
                out += search.finish()
        return np.asarray(out, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        marked = MARK + text.replace(" ", MARK)
        if MARK + MARK in marked:
            return b"".join(map(self.words.__getitem__, self.stretches.findall(marked)))
        first, *rest = marked[1:].split(MARK)
        return b"".join(map(self.words.__getitem__, [MARK + first, *[MARK + w for w in rest]]))

    def _spoken(self, piece: int) -> bytes:
        if piece in self.pieces.byte_of:
            return bytes([self.pieces.byte_of[piece]])
        if piece in self.pieces.silent:
            return b""
        if piece == self.pieces.unknown:
            return " ⁇ ".encode()
        return self.pieces.text[piece].replace(MARK, " ").encode()

    def decode(self, ids: bytes) -> str:
        spoken = self._table()
        body = b"".join([spoken[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")
        return body[1:] if body.startswith(" ") else body

    def _table(self) -> list[bytes]:
        if not hasattr(self, "table"):
            self.table = [self._spoken(i) for i in range(len(self.pieces.text))]
        return self.table


def codec(path: str) -> Codec:
    return held(Codec, path)


def encode_documents(df: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids: the ids of every whole text."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = codec(model)
        for batch in batches:
            yield pd.DataFrame({key: batch[key].astype("Int64"), "ids": [
                np.frombuffer(use.encode(x), "<u4").astype(np.int32) for x in batch[text]]})

    rows = df.select(F.col(key).cast("long").alias(key), text_or_empty(text).alias(text))
    return rows.mapInPandas(run, f"`{key}` long, ids array<int>")


def decode_documents(df: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, text: the text that the ids spell; null ids are none."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = codec(model)
        for batch in batches:
            yield pd.DataFrame({key: batch[key].astype("Int64"), "text": [
                "" if x is None else use.decode(np.asarray(x, dtype="<u4").tobytes()) for x in batch[ids]]})

    rows = df.select(F.col(key).cast("long").alias(key), F.col(ids).alias(ids))
    return rows.mapInPandas(run, f"`{key}` long, text string")


def round_trips(df: DataFrame, model: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """key, n_ids, ids_crc32, n_chars, round_trip (and ids): what encoding each whole text gives,
    and whether decoding the ids restores the text."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = codec(model)
        for batch in batches:
            ids = [use.encode(x) for x in batch[text]]
            out = pd.DataFrame({
                key: batch[key].astype("Int64"), "n_ids": [len(x) // 4 for x in ids], "ids_crc32": [crc32(x) for x in ids],
                "n_chars": [len(x) for x in batch[text]], "round_trip": [use.decode(x) == t for x, t in zip(ids, batch[text])]})
            if with_ids:
                out["ids"] = [np.frombuffer(x, "<u4").astype(np.int32) for x in ids]
            yield out

    rows = df.select(F.col(key).cast("long").alias(key), text_or_empty(text).alias(text))
    schema = f"`{key}` long, n_ids long, ids_crc32 long, n_chars long, round_trip boolean"
    return rows.mapInPandas(run, schema + ", ids array<int>" if with_ids else schema)
