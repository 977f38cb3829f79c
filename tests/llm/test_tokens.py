"""Token files, packing and byte pairs against the tokenizers library."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from landfall.llm import byte_pairs, packing, token_files

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def library_ids(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def expected(edge_rows):
    tokenizer = Tokenizer.from_file(WORDS)
    ids = [(r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in edge_rows]
    return sorted(ids, key=lambda r: r[0])


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_hold_all_documents_in_order(spark, edge, expected, tmp_path):
    token_files.write_token_files(edge, str(tmp_path), WORDS, 2)
    got = token_files.read_token_files(spark, str(tmp_path)).orderBy("start").collect()
    assert [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got] == [(d, len(i), crc(i)) for d, i in expected]
    starts = np.cumsum([0] + [len(i) for _, i in expected])[:-1].tolist()
    assert [r["start"] for r in got] == starts


def test_token_files_of_nothing_and_null_ids(spark, empty, tmp_path):
    token_files.write_token_files(empty, str(tmp_path / "none"), WORDS, 2)
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0
    rows = spark.createDataFrame([(None, "a"), (3, "b"), (None, None)], "doc_id long, text string")
    token_files.write_token_files(rows, str(tmp_path / "some"), WORDS, 2)
    got = token_files.read_token_files(spark, str(tmp_path / "some")).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, None, 3]


def check_pieces(pieces, expected):
    by_id = {}
    for d, ids in expected:
        by_id.setdefault(d, []).append(ids)
    place = 0
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["sequence_id"] * packing.SEQUENCE + p["offset"] == place
        assert p["offset"] + p["length"] <= packing.SEQUENCE
        ids = by_id[p["doc_id"]][0]  # repeated ids have equal texts here
        assert p["doc_tokens"] == len(ids)
        assert p["ids_crc32"] == crc(ids[p["start"] : p["start"] + p["length"]])
        place += p["length"]
    assert place == sum(len(i) for _, i in expected)
    covered = Counter((p["doc_id"], p["start"] + i) for p in pieces for i in range(p["length"]))
    assert covered == Counter((d, i) for d, ids in expected for i in range(len(ids)))


@pytest.mark.parametrize("targets", [None, {"a": 0.6, "hot": 0.1}])
def test_packing_places_each_id_once(edge, expected, targets):
    check_pieces(packing.pack(edge, WORDS, 2, targets=targets, window=2 * packing.SEQUENCE).collect(), expected)


def test_packing_keeps_the_mixture(edge, expected):
    pieces = packing.pack(edge, WORDS, 2, window=packing.SEQUENCE).collect()
    total = sum(len(i) for _, i in expected)
    by_source = Counter()
    for p in pieces:
        by_source[p["source"]] += p["length"]
    full = total // packing.SEQUENCE
    for window in range(1, full + 1):
        for source, tokens in by_source.items():
            sent = sum(p["length"] for p in pieces if p["source"] == source and p["window"] <= window)
            assert abs(sent - window * packing.SEQUENCE * tokens / total) <= 1


def test_packing_of_nothing(empty):
    assert packing.pack(empty, WORDS, 2).count() == 0


def test_byte_pairs_equal_the_library(edge, edge_rows):
    tokenizer = Tokenizer.from_file(BYTES)
    got = Counter(tuple(r) for r in byte_pairs.round_trip_digests(edge, BYTES).collect())
    exp = Counter()
    for d, text, *_ in edge_rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        sums = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded)]
        exp[d, len(ids), *sums] += 1
    assert got == exp


@pytest.mark.parametrize("text", [" a", "a  b", "a   b", " \n x", "a \n \n b", "foo\n ", "\n\n", "a  b", "'s 'S", "ﬁ. ;"])
def test_byte_pairs_of_blanks(text):
    assert byte_pairs.byte_pairs(BYTES).encode(text) == library_ids(BYTES, text)


def test_byte_pairs_round_trip(edge, edge_rows, empty):
    ids = byte_pairs.encode_texts(edge, BYTES)
    texts = Counter((r["doc_id"], r["text"]) for r in byte_pairs.decode_ids(ids, BYTES).collect())
    assert texts == Counter((r[0], r[1] or "") for r in edge_rows)
    assert byte_pairs.encode_texts(empty, BYTES).count() == 0
