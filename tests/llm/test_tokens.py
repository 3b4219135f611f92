"""Packing and BPE: exact against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stockcast.llm import bpe, packing
from stockcast.llm.tokenizing import ByteLevel, vocabulary
from tests.llm.conftest import as_rows

TEXTS = st.one_of(st.text(max_size=200), st.text(alphabet="aAéßİ'’ \n\t\x1c\x85\xa0 sSrevl.,!?19²½_-<|>", max_size=200))


@pytest.fixture(scope="module")
def fast():
    return ByteLevel()


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(vocabulary("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def own():
    return bpe.WordBpe()


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_byte_level_ids(fast, byte_library, text):
    assert fast.ids(text).tolist() == byte_library.encode(text, add_special_tokens=False).ids


def wanted(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_word_bpe(own, word_library, text):
    assert own.encode_text(text) == wanted(word_library, text)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(0, 200))
def test_join_of_two_parts(own, text, cut):
    """Wherever a text is cut, the joined parts have the tokens of the whole."""
    text = own.normalise(text)
    left, right = own.node(text[:cut]), own.node(text[cut:])
    got, want = own.join(left, right), own.node(text)
    assert b"".join(got["ids"]) == b"".join(want["ids"]) and got["starts"].tolist() == want["starts"].tolist()


def test_long_words_by_halves(own):
    draw = random.Random(2)
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "ab", "aeinorst", "x"):
        for size in (50, 333, 2000):
            word = "".join(draw.choice(alphabet) for _ in range(size))
            for last in (True, False):
                want = (own.end if last else own.middle).encode(word, add_special_tokens=False).ids
                assert own.unsplit(word, last, limit=16) == want


def test_round_trip_of_documents(spark, documents, word_library):
    got = {r[0]: tuple(r[1:]) for r in bpe.round_trip(documents, segment=700).collect()}
    assert got == {k: wanted(word_library, t or "") for k, t in as_rows(documents)}


def test_round_trip_of_edge_rows(spark, unique, edge, empty, word_library):
    df = spark.createDataFrame(unique, "doc_id long, text string")
    for segment in (40, bpe.SEGMENT):
        got = {r[0]: tuple(r[1:]) for r in bpe.round_trip(df, segment=segment).collect()}
        assert got == {k: wanted(word_library, t or "") for k, t in unique}
    assert bpe.round_trip(edge).count() == edge.count()
    assert bpe.round_trip(empty).count() == 0


def check_packing(rows, result, library, size):
    """Each document's tokens appear once, in pieces as promised, without gaps or overflow."""
    by_doc, places = {}, {}
    for r in result:
        by_doc.setdefault(r["doc_id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert by_doc.keys() == {k for k, _ in rows}
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        parts = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [p["piece"] for p in parts] == list(range(len(parts))) and sum(p["length"] for p in parts) == len(ids)
        assert len(parts) == -(-len(ids) // size) and all(p["length"] == size for p in parts[1:])
        at = 0
        for p in parts:
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    lengths = np.array([r["length"] for r in result])
    return len(places), packing.lower_bound(lengths, size)


def test_packing_of_documents(spark, documents, byte_library):
    rows = as_rows(documents)
    used, least = check_packing(rows, packing.pack(documents, block=40).collect(), byte_library, 2048)
    assert used <= 1.02 * least + 1


def test_packing_edges(spark, unique, edge, empty, byte_library):
    df = spark.createDataFrame(unique, "doc_id long, text string")
    used, least = check_packing(unique, packing.pack(df, size=64, block=100).collect(), byte_library, 64)
    assert used <= least + 2
    got = packing.pack(edge).collect()
    assert len({(r["doc_id"] is None) for r in got}) == 2
    assert packing.pack(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=80), st.integers(0, 5))
def test_genetic_steps_keep_all_pieces(lengths, seed):
    lengths, size, rng = np.array(lengths), 50, np.random.default_rng(seed)
    people = packing.first_packings(lengths, size, 0, rng, 4)
    first = min(packing.fitness(p, lengths) for p in people)
    people = packing.evolve(people, lengths, size, rng, 12, 0)
    least = packing.lower_bound(lengths, size)
    for p in people:
        assert len(p) == len(lengths) and np.bincount(p, weights=lengths).max() <= size
    assert packing.fitness(people[0], lengths) <= first and packing.fitness(people[0], lengths)[0] >= least
