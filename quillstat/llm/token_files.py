"""Token ids in binary files: one zstandard frame per document, one shared dictionary.

``write_tokens`` encodes whole texts with the ``tokenizers`` library and writes files in
ascending id order; ``read_tokens`` and ``lookup_tokens`` read them back, the latter
unpacking only the frames of the documents asked for.

File format. A file is a run of blocks, each followed by one newline byte. A block is

    HEADER   magic, id width in bytes, dictionary hash (16 bytes), documents, index bytes,
             frame bytes, ids in the block
    INDEX    int64 document ids, uint8 "has an id" marks, uint32 id counts, uint64 frame ends
    FRAMES   one zstandard frame per document over its ids, little-endian, 2 or 4 bytes each

The dictionary is a file of its own beside them; a reader checks its hash against every block.
Spark's own writer puts the blocks into files, so a task that runs again replaces its files.

The dictionary is trained on the ids of at most ``DICTIONARY_DOCUMENTS`` documents, chosen by
a hash of their id, and at most ``DICTIONARY_BYTES`` of them; it affects sizes only, never ids.

Words: the vocabulary's splitter never joins text across white space, nor a letter with
ASCII closing marks, and lower-cases. So each white-space piece is encoded by the library
once and its ids kept, with a bound on how many are kept. Texts with other separators that
Python and the splitter see differently go to the library whole.

Defined cases: null text is empty and has the end id only; null ids come first and read
back as null; rows with the same id keep the order of their texts; extra columns play no
part; an empty table writes no blocks and reads back empty.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstat.llm.common import Memo, crc32, frames, scratch_dir, small_batches, text_or_empty

END_ID = 2
DICTIONARY_DOCUMENTS = 400
DICTIONARY_BYTES = 112_640
LEVEL = 3
BLOCK_BYTES = 1 << 20
BLOCK_DOCUMENTS = 4096
BLOCKS_PER_FILE = 16
WORDS_KEPT = 400_000
STEMS_KEPT = 600_000

HEADER = struct.Struct("<4sB16sIQQQ")
MAGIC = b"QTK1"
#: White space to Python's split but not to the vocabulary's splitter.
ODD_SPACE = re.compile("[\x1c-\x1f]")
CLOSED_WORD = re.compile(r"^(.*[A-Za-z])([.,;:!?]+)\Z", re.S)


class WordEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.stems = Memo(self.whole, STEMS_KEPT)
        self.words = Memo(self._word, WORDS_KEPT)

    def whole(self, text: str) -> bytes:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _stem(self, text: str) -> bytes:
        plain = "<" not in text and (text.isascii() or max(text) < "ɐ")
        return self.stems[text.lower() if plain else text]

    def _word(self, word: str) -> bytes:
        closed = CLOSED_WORD.match(word)
        return self._stem(closed[1]) + self._stem(closed[2]) if closed else self._stem(word)

    def __call__(self, text: str) -> bytes:
        if ODD_SPACE.search(text):
            return self.whole(text)
        return b"".join(map(self.words.__getitem__, text.split()))


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def dictionary_hash(dictionary: bytes) -> bytes:
    return hashlib.blake2b(dictionary, digest_size=16).digest()


def _zstd_dictionary(dictionary: bytes):
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of at most ``size`` bytes, smaller for few samples; empty if they are too few to train on."""
    size = min(size, sum(map(len, samples)) // 10)
    if size < 1024 or len(samples) < 16:
        return b""
    return zstandard.train_dictionary(size, samples).as_bytes()


def pack_block(documents: list[tuple[int | None, int, bytes]], width: int, mark: bytes) -> bytes:
    """One block of (id or None, number of ids, frame)."""
    ids = np.array([0 if d[0] is None else d[0] for d in documents], dtype="<i8")
    has_id = np.array([d[0] is not None for d in documents], dtype="u1")
    counts = np.array([d[1] for d in documents], dtype="<u4")
    ends = np.cumsum([len(d[2]) for d in documents], dtype="<u8")
    index = ids.tobytes() + has_id.tobytes() + counts.tobytes() + ends.tobytes()
    body = b"".join(d[2] for d in documents)
    head = HEADER.pack(MAGIC, width, mark, len(documents), len(index), len(body), int(counts.sum(dtype=np.int64)))
    return head + index + body


def blocks_of(content: bytes) -> Iterator[tuple[int, bytes, int, int, int, int, int]]:
    """(width, dictionary hash, documents, index offset, frame offset, end, ids) of each block of a file."""
    at = 0
    while at < len(content):
        magic, width, mark, n, index, body, ids = HEADER.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        first = at + HEADER.size
        yield width, mark, n, first, first + index, first + index + body, ids
        at = first + index + body + 1


def block_index(content: bytes, n: int, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(content, "<i8", n, first)
    has_id = np.frombuffer(content, "u1", n, first + 8 * n)
    counts = np.frombuffer(content, "<u4", n, first + 9 * n)
    ends = np.frombuffer(content, "<u8", n, first + 13 * n)
    return ids, has_id, counts, ends


def write_tokens(df: DataFrame, path: str, vocabulary: str, key: str = "doc_id", text: str = "text",
                 end_id: int = END_ID) -> None:
    """Write the ids of every row of ``df`` under ``path`` in ascending ``key`` order."""
    spark = df.sparkSession
    small_batches(spark)
    rows = df.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))

    mark = F.xxhash64("doc_id")
    chosen = [r[0] for r in rows.select("doc_id").filter(F.col("doc_id").isNotNull())
              .orderBy(mark, "doc_id").limit(DICTIONARY_DOCUMENTS).collect()]
    picked = rows.filter(F.col("doc_id").isin(chosen)).dropDuplicates(["doc_id"]) if chosen else rows.limit(0)

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run = encoder(vocabulary)
        for batch in batches:
            yield pd.DataFrame({"ids": [_narrow(run(x), run.width)[: DICTIONARY_BYTES] for x in batch["text"]]})

    samples = sorted(bytes(r[0]) for r in picked.mapInPandas(sample, "ids binary").collect())
    dictionary = train_dictionary([s for s in samples if s])
    spark.createDataFrame([(bytearray(dictionary),)], "body binary").coalesce(1).select(
        F.col("body").cast("string")).write.text(f"{path}/dictionary")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run = encoder(vocabulary)
        shrink = zstandard.ZstdCompressor(level=LEVEL, dict_data=_zstd_dictionary(dictionary))
        mark = dictionary_hash(dictionary)
        end = struct.pack("<I", end_id)
        held: list[tuple[int | None, int, bytes]] = []
        size = 0
        for batch in batches:
            for doc_id, missing, body in zip(batch["doc_id"], batch["doc_id"].isna(), batch["text"]):
                ids = run(body) + end
                frame = shrink.compress(_narrow(ids, run.width))
                held.append((None if missing else int(doc_id), len(ids) // 4, frame))
                size += len(frame)
                if size >= BLOCK_BYTES or len(held) >= BLOCK_DOCUMENTS:
                    yield pd.DataFrame({"block": [pack_block(held, run.width, mark)]})
                    held, size = [], 0
        if held:
            yield pd.DataFrame({"block": [pack_block(held, run.width, mark)]})

    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInPandas(pack, "block binary").select(F.col("block").cast("string")).write.option(
        "maxRecordsPerFile", BLOCKS_PER_FILE).text(f"{path}/ids")


def _narrow(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def _read_dictionary(spark: SparkSession, path: str) -> bytes:
    parts = spark.read.format("binaryFile").load(f"{path}/dictionary").select("content").collect()
    return b"".join(bytes(p[0])[:-1] for p in parts)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """path and content of the id files; their names carry the order of the blocks."""
    return spark.read.format("binaryFile").load(f"{path}/ids").select("path", "content")


def _documents(content: bytes, dictionary: bytes, wanted: np.ndarray | None = None):
    """(block, row, id or None, ids as unsigned 32-bit bytes, ids before it in the file) of a file's documents."""
    mark, expand = dictionary_hash(dictionary), zstandard.ZstdDecompressor(dict_data=_zstd_dictionary(dictionary))
    before = 0
    for block, (width, of, n, first, body, _, _) in enumerate(blocks_of(content)):
        if of != mark:
            raise ValueError("the block was written with another dictionary")
        ids, has_id, counts, ends = block_index(content, n, first)
        asked = range(n) if wanted is None else np.flatnonzero(np.isin(ids, wanted) & (has_id == 1))
        sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        for row in asked:
            start = int(ends[row - 1]) if row else 0
            raw = expand.decompress(content[body + start: body + int(ends[row])])
            if width == 2:
                raw = np.frombuffer(raw, "<u2").astype("<u4").tobytes()
            yield block, int(row), int(ids[row]) if has_id[row] else None, raw, before + int(sums[row])
        before += int(sums[-1])


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    small_batches(spark)
    dictionary = _read_dictionary(spark, path)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["path", "doc_id", "_before", "n_tokens", "ids_crc32"]
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                rows = ((name, doc, before, len(raw) // 4, crc32(raw))
                        for _, _, doc, raw, before in _documents(content, dictionary))
                for frame in frames(columns, rows):
                    frame["doc_id"] = frame["doc_id"].astype("Int64")
                    yield frame

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"],
                                "_ids": [sum(b[-1] for b in blocks_of(c)) for c in batch["content"]]})

    files = _files(spark, path)
    name = F.element_at(F.split("path", "/"), -1)
    order = Window.orderBy(F.regexp_extract(name, r"part-(\d+)", 1).cast("long"),
                           F.regexp_extract(name, r"-c(\d+)", 1).cast("long"))
    starts = files.mapInPandas(totals, "path string, _ids long").select(
        "path", (F.sum("_ids").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_ids")).alias("_first"))
    rows = files.mapInPandas(parse, "path string, doc_id long, _before long, n_tokens long, ids_crc32 long")
    return rows.join(starts, "path").select(
        "doc_id", (F.col("_first") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32")


def lookup_tokens(spark: SparkSession, path: str, wanted: list[int]) -> DataFrame:
    """doc_id, ids of the documents in ``wanted``; only their frames are unpacked."""
    small_batches(spark)
    dictionary = _read_dictionary(spark, path)
    asked = np.array(sorted(set(wanted)), dtype=np.int64)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = ((doc, np.frombuffer(raw, "<u4").astype(np.int64).tolist())
                        for _, _, doc, raw, _ in _documents(content, dictionary, asked))
                yield from frames(["doc_id", "ids"], rows)

    return _files(spark, path).mapInPandas(parse, "doc_id long, ids array<long>")


def token_summary(df: DataFrame, vocabulary: str) -> DataFrame:
    """Write all rows of ``df`` to files in the shared folder and summarise what the files hold."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(df, path, vocabulary)
    return read_summary(spark, path)
