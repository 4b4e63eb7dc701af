"""Token files and piece encoding against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_cases import LONG, none, odd, odd_rows, rows_of, words
from opsframe.llm.kept import Kept
from opsframe.llm.piece_encoding import Vocabulary, compare, load_encoder, piece_digests
from opsframe.llm.token_file import (
    Encoder, decode_levels, encode_levels, read_documents, read_segments,
    token_at, tokens_at, write_token_files,
)
from opsframe.session import scratch_path

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = [
    "a", "b", " ", "  ", "\n", "\t", "\xa0", "\x1c", "'s", "'ll", "é", "漢字", "😀",
    "0", "!", ",", "<|endoftext|>", "▁", "\r\n", "the", "\x85", "<s>", "</s>",
    "<0x41>", "\0", "﻿", "<unk>", "Ĉ", "ƽ", "ʰ", "ª",
]


def strange_texts(n=1500):
    rng = random.Random(3)
    return ["".join(rng.choices(SIGNS, k=rng.randint(0, 25))) for _ in range(n)]


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 600), max_size=1500))
@settings(max_examples=60, deadline=None)
def test_levels(tokens):
    levels = encode_levels(np.array(tokens, np.uint32))
    assert decode_levels(levels).tolist() == tokens
    for i in range(0, len(tokens), 7):
        assert token_at(levels, i) == tokens[i]


def test_rank_directory_over_many_blocks():
    tokens = np.random.default_rng(1).integers(0, 70_000, 20_000).astype(np.uint32)
    levels = encode_levels(tokens)
    assert len(levels) == 3
    assert [token_at(levels, i) for i in range(0, 20_000, 11)] == tokens[::11].tolist()


@pytest.mark.parametrize("texts", [strange_texts(), [words(1, 500), LONG], [], [""]])
def test_byte_encoder_is_the_library(texts):
    library = Tokenizer.from_file(BYTES)
    ids, edges = Encoder(BYTES).encode(pa.array(texts, pa.string()))
    wanted = [
        library.encode(t, add_special_tokens=False).ids for t in texts
    ]
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == wanted


def test_known_words_with_marks_are_the_library():
    library = Tokenizer.from_file(BYTES)
    encoder = Encoder(BYTES)
    words_ = ["a", "a!", "a!!", "it's", "x'", "9", "é", "word", "1.", "'", "'s", ""]
    for marks in ("", ".", "!", "!!", ".,", "?!", "'"):
        texts = [f"x {w}{marks}" for w in words_] * 2
        ids, edges = encoder.encode(pa.array(texts, pa.string()))
        for text, a, b in zip(texts, edges, edges[1:]):
            wanted = library.encode(text, add_special_tokens=False).ids
            assert ids[a:b].tolist() == wanted, text


@pytest.mark.parametrize("texts", [strange_texts(), [words(1, 500), LONG], [], [""]])
def test_piece_encoder_is_the_library(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = load_encoder(PIECES).encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in found] == library.encode(texts)


def test_both_agendas_agree():
    words_of = Vocabulary(PIECES)
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choices("abcdefthe▁▁, .nonio", k=rng.randint(1, 40)))
        assert words_of.merge(text) == words_of.merge_long(text)


def test_a_difference_from_the_library_is_an_error():
    with pytest.raises(ValueError):
        compare([[1, 2]], [[1, 3]], ["text"])


def test_kept_results_stay_right_when_room_is_short():
    made = []

    def make(xs):
        made.extend(xs)
        return [len(x).to_bytes(4, "little") for x in xs]

    kept = Kept(make, room=8, longest=5)
    rng = random.Random(1)
    for _ in range(50):
        lists = [
            ["x" * rng.randint(0, 9) for _ in range(rng.randint(0, 6))]
            for _ in range(5)
        ]
        ids, edges = kept.join(pa.array(lists, pa.list_(pa.string())))
        assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [
            [len(x) for x in xs] for xs in lists
        ]


def wanted_documents(docs):
    library = Tokenizer.from_file(BYTES)
    ids = [
        library.encode(t or "", add_special_tokens=False).ids + [2] for _, t in docs
    ]
    starts = np.cumsum([0] + [len(x) for x in ids])
    return [
        (doc, int(start), len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        for (doc, _), start, x in zip(docs, starts, ids)
    ]


@pytest.mark.parametrize("segment_tokens", [1 << 20, 50])
def test_files(spark, segment_tokens):
    docs = [(k, words(k, k % 40)) for k in range(300)] + [(300, None), (301, "")]
    shuffled = docs[:]
    random.Random(1).shuffle(shuffled)
    path = scratch_path(spark, "test-tokens")
    df = spark.createDataFrame(shuffled, "doc_id long, text string").repartition(5)
    write_token_files(df, path, BYTES, 2, 4, segment_tokens)
    found = sorted(map(tuple, read_documents(spark, path).collect()))
    assert found == wanted_documents(docs)
    ids = {r.doc_id: r.ids for r in read_documents(spark, path, True).collect()}
    segments = read_segments(spark, path)
    places = segments.selectExpr("part", "segment", "explode(doc_start) AS at")
    places = places.union(places.selectExpr("part", "segment", "1000000000"))
    at = {(r.part, r.segment, r["at"]): r.token for r in tokens_at(segments, places).collect()}
    for row in segments.collect():
        for doc, start in zip(row.doc_id, row.doc_start):
            assert at[row.part, row.segment, start] == ids[doc][0]
        assert at[row.part, row.segment, 1000000000] is None


def test_files_of_odd_rows(spark):
    path = scratch_path(spark, "test-tokens")
    write_token_files(odd(spark), path, BYTES, 2, 3)
    found = rows_of(read_documents(spark, path))
    library = Tokenizer.from_file(BYTES)
    sizes = sorted(
        len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1
        for r in odd_rows()
    )
    assert sorted(r["n_tokens"] for r in found) == sizes
    found.sort(key=lambda r: r["start"])
    place = 0
    for r in found:
        assert r["start"] == place
        place += r["n_tokens"]
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert keys == sorted(keys)


def test_files_of_nothing(spark):
    path = scratch_path(spark, "test-tokens")
    write_token_files(none(spark), path, BYTES, 2, 3)
    assert read_documents(spark, path).count() == 0


@pytest.mark.parametrize("check", ["runs", "texts"])
def test_piece_digests(spark, check):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = odd(spark)
    found = piece_digests(docs, PIECES, check=check, with_ids=True)
    texts = sorted((r[1] or "") for r in odd_rows())
    rows = sorted(rows_of(found), key=lambda r: r["decoded"])
    wanted = sorted(
        (library.decode(library.encode(t)), library.encode(t)) for t in texts
    )
    for r, (decoded, ids) in zip(rows, wanted):
        assert (r["decoded"], r["ids"], r["n_tokens"]) == (decoded, ids, len(ids))
        assert r["ids_sha256"] == hashlib.sha256(
            ",".join(map(str, ids)).encode()
        ).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert piece_digests(none(spark), PIECES, check=check).count() == 0
