"""SimHash components against all pairs."""

import random

import numpy as np
import xxhash

from llm_cases import none, odd, odd_rows, rows_of, words
from opsframe.llm.components import components
from opsframe.llm.simhash import (
    fingerprint, linked, list_positions, near_duplicates, one_of_each,
)


def plain_fingerprint(text, width=3):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    shingles = [
        b" ".join(found[i : i + width])
        for i in range(max(1, len(found) - width + 1))
    ]
    value = 0
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    for bit in range(64):
        if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes):
            value |= 1 << bit
    return value


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_components(values, max_bits=3):
    values = sorted(set(values))
    group = {v: v for v in values}

    def root(v):
        while group[v] != v:
            v = group[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= max_bits:
                group[root(b)] = root(a)
    return {v: root(v) for v in values}


def test_fingerprint():
    for text in ("", "One", "one two", "a b c d", words(1, 300), "É é Ö"):
        assert fingerprint(text.encode(), 3) == signed(plain_fingerprint(text))


def test_any_five_positions_have_a_list():
    from itertools import combinations

    for shared in range(1, 9):
        lists = list_positions(shared)
        for chosen in combinations(range(8), shared):
            assert any(set(c) <= set(chosen) for c in lists)


def near_values(seed, n):
    """Random values with clusters and chains of near ones."""
    rng = random.Random(seed)
    values = set()
    while len(values) < n:
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 30)):
            values.add(v)
            for _ in range(rng.randint(1, 4)):
                v ^= 1 << rng.randrange(64)
    return [signed(v) for v in values]


def test_links_are_all_pairs(spark):
    values = near_values(5, 600)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    x = np.array(sorted(values), np.int64).view(np.uint64)
    i, j = np.nonzero(np.triu(np.bitwise_count(x[:, None] ^ x[None, :]) <= 3, 1))
    wanted = {
        tuple(sorted((int(a), int(b))))
        for a, b in zip(x[i].view(np.int64), x[j].view(np.int64))
    }
    for hot_list in (2000, 1):  # with and without finer lists
        rows = linked(fps, 3, hot_list).collect()
        assert {(r.u, r.v) for r in rows} == wanted
    assert len(rows) >= len(wanted) > 300


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100)] + [(200, k) for k in range(201, 400)]
    links += [(7, 7), (3, 2), (500, 501)]
    found = components(spark.createDataFrame(links, "u long, v long")).collect()
    roots = {r.node: r.root for r in found}
    assert len(found) == len(roots)
    assert all(roots[k] == 0 for k in range(101))
    assert all(roots[k] == 200 for k in range(200, 400))
    assert roots[501] == 500
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates(spark):
    base = [words(k, 200) for k in range(12)]
    texts = base + [t + " more" for t in base] + base[:3] * 5
    docs = spark.createDataFrame(
        [(100 - i, t) for i, t in enumerate(texts)], "doc_id long, text string"
    )
    found = {r["doc_id"]: r for r in rows_of(near_duplicates(docs))}
    value = {100 - i: plain_fingerprint(t) for i, t in enumerate(texts)}
    root = plain_components(value.values())
    lowest = {}
    for doc_id in sorted(value):
        lowest.setdefault(root[value[doc_id]], doc_id)
    for doc_id, v in value.items():
        assert found[doc_id]["fingerprint"] == f"{v:016x}"
        assert found[doc_id]["component_id"] == lowest[root[v]]


def test_odd_rows(spark):
    found = near_duplicates(odd(spark))
    assert found.count() == len(odd_rows())
    values = {r[0]: plain_fingerprint(r[1]) for r in odd_rows()[:16]}
    for r in rows_of(found):
        if r["doc_id"] in (0, 1, 2):
            assert (r["fingerprint"], r["component_id"]) == ("0" * 16, 0)
        if r["doc_id"] not in (None, 4):
            assert r["fingerprint"] == f"{values[r['doc_id']]:016x}"
    assert near_duplicates(none(spark)).count() == 0


def test_one_of_each(spark):
    docs = odd(spark)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    ids = [r.doc_id for r in rows]
    assert ids.count(0) == 1 and 1 not in ids and 2 not in ids
    assert sum(r.text == "a b c d e f g h" for r in rows) == 1
    assert {r.doc_id for r in rows if r.text == "two words"} == {4}
    assert one_of_each(none(spark)).count() == 0


def test_equal_texts_are_one_index_entry(spark):
    docs = spark.range(0, 20_000, 1, 8).selectExpr(
        "id AS doc_id", "if(id % 3 = 0, 'the same text again', 'text ' || id) AS text"
    )
    found = near_duplicates(docs)
    assert found.where("doc_id % 3 = 0").select("component_id").distinct().count() == 1
