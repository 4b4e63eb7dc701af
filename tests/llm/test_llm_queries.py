"""The registered text queries and the pipeline against plain versions."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from llm_cases import none, odd, odd_rows, rows_of
from opsframe.llm.common import stored
from opsframe.llm.decontaminate import words_of
from opsframe.llm.queries import QUERIES
from test_llm_simhash import plain_components, plain_fingerprint

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    return sorted((r.doc_id, r.text or "") for r in rows)


def result(spark, name):
    rows = rows_of(QUERIES[name](spark, DATA))
    return {r["doc_id"]: r for r in rows}


def test_every_operator_has_a_query():
    names = __spark_entry__.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names


def plain_near_duplicates(docs):
    value = {d: plain_fingerprint(t) for d, t in docs}
    root = plain_components(value.values())
    lowest = {}
    for d in sorted(value):
        lowest.setdefault(root[value[d]], d)
    return {d: (f"{v:016x}", lowest[root[v]]) for d, v in value.items()}


def test_simhash_query(spark, docs):
    found = result(spark, "op2_simhash")
    wanted = plain_near_duplicates(docs)
    assert {d: (r["fingerprint"], r["component_id"]) for d, r in found.items()} == wanted


def test_token_file_query(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found, start = result(spark, "op3_token_file"), 0
    for d, text in docs:
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        r = found[d]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)
    assert len(found) == len(docs)


def test_sharding_query(spark, docs):
    found = result(spark, "op6_sharding")
    assert len(found) == len(docs)
    slots = {}
    for d, text in docs:
        r = found[d]
        assert r["size"] == len(text.encode()) + 16
        assert r["text_crc32"] == zlib.crc32(text.encode())
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 40)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def piece_digests(text, library):
    ids = library.encode(text)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )


def digests_of(r):
    return r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]


def test_piece_query(spark, docs, pieces):
    found = result(spark, "op8_piece_encoding")
    assert {d: digests_of(r) for d, r in found.items()} == {
        d: piece_digests(t, pieces) for d, t in docs
    }


def test_surrogate_query(spark, docs):
    found = result(spark, "op10_surrogates")
    plain = dict(docs)
    mail = re.compile(r"[\w.]+@[\w.]+\w")
    phone = re.compile(r"\+1 \(\d{3}\) \d{3}-\d{4}")
    before = after = 0
    for d, r in found.items():
        for pattern in (mail, phone):
            old, new = pattern.findall(plain[d]), pattern.findall(r["text"])
            assert len(old) == len(new) and not set(old) & set(new)
            before, after = before + len(old), after + len(new)
        if r["n_replaced"] == 0:
            assert r["text"] == plain[d]
    assert before == after > 0


def test_classifier_query(spark):
    found = result(spark, "op1_quality_classifier")
    assert len(found) == 200
    assert all(isinstance(r["kept"], bool) for r in found.values())


def test_licence_query(spark, docs):
    found = result(spark, "op5_licences")
    for d, text in docs:
        assert ("mit" in found[d]["families"]) == ("MIT License" in text)


def contaminated(text, items):
    windows = set()
    for item in items:
        ws = words_of((item or "").encode())
        for i in range(max(1, len(ws) - 9) if ws else 0):
            windows.add(tuple(ws[i : i + 10]))
    ws = words_of(text.encode())
    sizes = {len(w) for w in windows}
    return any(
        tuple(ws[i : i + k]) in windows for k in sizes for i in range(len(ws) - k + 1)
    )


def test_pipeline_stage_by_stage(spark, pieces):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, DATA), "test-stage")
        if name != "piece-encoding":
            assert out.columns == docs.columns
        made[name] = {r["doc_id"]: r for r in rows_of(out)}
        docs = out
    (q, dup, clean, private, last) = made.values()
    wanted = plain_near_duplicates(sorted((d, r["text"]) for d, r in q.items()))
    assert set(dup) == {d for d, (_, low) in wanted.items() if d == low}
    assert all(dup[d] == q[d] for d in dup)
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert set(clean) == {d for d, r in dup.items() if not contaminated(r["text"], items)}
    assert set(private) == set(clean)
    for d, r in private.items():
        if r["text"] != clean[d]["text"]:
            assert r["n_chars"] == len(r["text"])
    assert {d: digests_of(r) for d, r in last.items()} == {
        d: piece_digests(r["text"], pieces) for d, r in private.items()
    }
    run = {r["doc_id"]: digests_of(r) for r in rows_of(corpus_pipeline.run(spark, DATA))}
    assert run == {d: digests_of(r) for d, r in last.items()}


def test_stages_bear_odd_and_empty_tables(spark):
    for rows in (odd(spark), none(spark)):
        docs = stored(rows, "test-odd")
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, DATA), "test-stage")
            if name != "piece-encoding":
                assert docs.columns == rows.columns
        assert docs.count() <= len(odd_rows())
