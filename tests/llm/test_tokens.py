import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillstat.llm import piece_codec, token_files

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", None, "Hello, world. it's 12,345 x", "ÉCOLE Größe Straße ΣΑΣ İi don't", "a\x1cb \x1d c d e", "<|endoftext|> a<|endoftext|>b <|ENDOFTEXT|>.",
         "  lead  and   trail \n\n\t", "😀 ∑ 漢字かな ́x é", "word " * 3000, "x" * 5000, "▁ under ▁▁ marks", "1 22 333 4.5 $$$ %%% !!", "\r\n\x0b\x0c"]
SCHEMA = "doc_id long, text string, start string, ids int"

alphabet = st.text(st.sampled_from(list("abcdeSTé Σß.,!?'▁ \n\t漢😀12") + ["\x1f", " "]), max_size=60)


@pytest.fixture(scope="module")
def words():
    return token_files.WordEncoder(VOCABULARY)


@pytest.fixture(scope="module")
def codec():
    return piece_codec.Codec(MODEL)


@pytest.fixture(scope="module")
def sentence():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=300, deadline=None)
@given(alphabet)
def test_word_ids_are_the_librarys(words, text):
    assert np.frombuffer(words(text), "<u4").tolist() == words.library.encode(text, add_special_tokens=False).ids


def test_fixed_word_ids_are_the_librarys(words):
    for text in TEXTS:
        assert np.frombuffer(words(text or ""), "<u4").tolist() == words.library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(alphabet)
def test_pieces_are_the_librarys_and_round_trip(codec, sentence, text):
    ids = codec.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == sentence.encode(text)
    assert codec.decode(ids) == sentence.decode(sentence.encode(text))


def test_streaming_in_portions_commits_the_same_ids_early(codec, sentence):
    text = "▁the▁quick▁brown▁fox▁jumps▁over▁the▁lazy▁dog" * 40
    whole = sentence.encode(text.replace("▁", " ")[1:])
    for size in (1, 7, 300):
        search, ids, widest = piece_codec.StreamingViterbi(codec.pieces), [], 0
        for k in range(0, len(text), size):
            ids += search.push(text[k:k + size])
            widest = max(widest, len(search.text))
        assert ids + search.finish() == whole
        assert widest <= 256 + 4 * codec.pieces.longest


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1) for i, t in rows], SCHEMA)


def test_files_give_back_every_id(spark, tmp_path):
    rows = [(100 - 7 * k, t) for k, t in enumerate(TEXTS)] + [(3, "twice"), (3, "twice"), (None, "no id"), (None, None)]
    path = str(tmp_path / "tokens")
    token_files.write_tokens(frame(spark, rows).repartition(4), path, VOCABULARY)
    library = Tokenizer.from_file(VOCABULARY)
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r) for r in token_files.read_summary(spark, path).orderBy("start").collect()]
    assert got == want
    found = {r.doc_id: r.ids for r in token_files.lookup_tokens(spark, path, [100, 86, 4242]).collect()}
    assert found == {100: [2], 86: library.encode(TEXTS[2], add_special_tokens=False).ids + [2]}


def test_dictionary_is_trained_and_checked():
    samples = [np.random.default_rng(k).integers(0, 300, 400, dtype="<u2").tobytes() for k in range(200)]
    dictionary = token_files.train_dictionary(samples)
    assert dictionary and token_files.train_dictionary(samples[:3]) == b""
    block = token_files.pack_block([(1, 0, b"")], 2, token_files.dictionary_hash(b"other")) + b"\n"
    with pytest.raises(ValueError):
        list(token_files._documents(block, dictionary))


def test_no_rows(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_tokens(frame(spark, []), path, VOCABULARY)
    assert token_files.read_summary(spark, path).count() == 0
    assert piece_codec.round_trips(frame(spark, []), MODEL).count() == 0


def test_pieces_as_tables(spark, sentence):
    rows = list(enumerate(TEXTS)) + [(2, TEXTS[2]), (None, "no id")]
    df = frame(spark, rows)
    encoded = piece_codec.encode_documents(df, MODEL)
    assert sorted((r.doc_id is None, r.doc_id or 0, list(r.ids)) for r in encoded.collect()) == sorted(
        (i is None, i or 0, sentence.encode(t or "")) for i, t in rows)
    back = {r.doc_id: r.text for r in piece_codec.decode_documents(encoded, MODEL).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in enumerate(TEXTS))
    trips = {r.doc_id: r for r in piece_codec.round_trips(df, MODEL, with_ids=True).collect()}
    assert all(trips[i].round_trip == ("▁" not in (t or "")) and list(trips[i].ids) == sentence.encode(t or "")
               for i, t in enumerate(TEXTS))
