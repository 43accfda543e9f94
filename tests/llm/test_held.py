"""A Python worker keeps the caches of one operator at a time."""

import weakref

import numpy as np
import public_tokenizers

from quillstat.llm.catalog import PIECE_MODEL
from quillstat.llm.order_minhash import shingles
from quillstat.llm.piece_codec import codec
from quillstat.llm.toxic_crf import ToxicModel


def test_another_operator_drops_the_caches_of_the_last_one():
    path = public_tokenizers.path(PIECE_MODEL)
    pieces = weakref.ref(codec(path))
    ids = codec(path).encode("some words")
    assert codec(path) is pieces()
    shingles(["some", "words"])
    assert pieces() is None
    assert codec(path).encode("some words") == ids


def test_a_worker_that_scores_many_partitions_holds_one_reader():
    readers = []
    for _ in range(3):
        reader = ToxicModel.train([], np.zeros(0)).reader()
        reader.scores(["some words"])
        readers.append(weakref.ref(reader))
        del reader
    assert [r() is None for r in readers] == [True, True, False]
