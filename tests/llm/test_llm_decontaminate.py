"""Decontamination against a plain search."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import none, odd, odd_rows, rows_of, words
from opsframe.llm.decontaminate import (
    as_line, automaton_of, blocks_of, clean_documents, contamination, hits_of,
    spans_of, words_of,
)

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain(text, items, width=10):
    ws = WORD.findall(lowered(text))
    hit, ids = set(), set()
    for item, item_text in items:
        its = WORD.findall(lowered(item_text))
        for i in range(max(1, len(its) - width + 1) if its else 0):
            w = its[i : i + width]
            for p in range(len(ws) - len(w) + 1):
                if ws[p : p + len(w)] == w:
                    hit |= set(range(p, p + len(w)))
                    ids.add(item)
    return len(ws), hit, ids


@given(
    st.lists(st.sampled_from("a b c ab".split()), max_size=40),
    st.lists(st.lists(st.sampled_from("a b c".split()), max_size=8), max_size=4),
)
@settings(max_examples=200, deadline=None)
def test_hits(text, items):
    items = [(str(k), " ".join(x)) for k, x in enumerate(items)]
    machine = automaton_of([(k, x.encode()) for k, x in items], 3)
    ws = [w.encode() for w in text]
    mask, ids = hits_of(ws, as_line(ws), machine)
    n, hit, wanted = plain(" ".join(text), items, 3)
    assert ids == wanted
    assert (set() if mask is None else {i for i, m in enumerate(mask) if m}) == hit


def test_spans_are_offsets_of_the_original():
    text = "Ünder THE é-Apple, tree!"
    ws = words_of(text.encode())
    machine = automaton_of([("1", "the É apple".encode()), ("2", "é apple".encode())], 10)
    mask, ids = hits_of(ws, as_line(ws), machine)
    assert ids == {"2"}
    (span,) = spans_of(text.encode(), mask)
    assert text[span["start"] : span["end"]] == "é-Apple"


def cases(spark):
    items = [(k, words(k, 6 + k)) for k in range(8)]
    items += [(8, None), (9, ""), (10, items[7][1]), (None, words(99, 12))]
    texts = [
        words(50, 30) + " " + words(3, 9).upper() + " " + words(51, 30),
        words(7, 13).replace(" ", "... "), words(99, 12), words(60, 100),
        words(7, 13) + " " + words(4, 10), None, "",
    ]
    docs = list(enumerate(texts)) + [(0, texts[0])]
    return (
        spark.createDataFrame(items, "item_id long, text string"),
        spark.createDataFrame(docs, "doc_id long, text string"),
        items,
        docs,
    )


def test_against_plain_search(spark):
    items_df, docs_df, items, docs = cases(spark)
    for block_bytes in (1 << 20, 40):  # one automaton, or one for each item
        found = rows_of(contamination(docs_df, items_df, block_bytes=block_bytes))
        assert len(found) == len(docs)
        for r in found:
            n, hit, ids = plain(docs[r["doc_id"]][1], items)
            ids = sorted(str(i) for i in ids if i is not None)
            digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
            assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, len(hit), len(ids))
            assert (r["items_sha256"], r["contaminated"]) == (digest, bool(hit))
    assert sum(r["contaminated"] for r in found) == 5


def test_blocks_hold_everything():
    items = [(str(k), b"x" * k) for k in range(20)]
    blocks = blocks_of(items, 30)
    assert [x for b in blocks for x in b] == items
    assert all(len(b) == 1 or sum(len(t) for _, t in b) <= 30 for b in blocks)


def test_size_of_items_is_checked(spark):
    items_df, docs_df, _, _ = cases(spark)
    with pytest.raises(ValueError, match="bytes of items"):
        contamination(docs_df, items_df, item_bytes=50)


def test_odd_and_empty(spark):
    items_df, docs_df, _, docs = cases(spark)
    docs = odd(spark)
    kept = clean_documents(docs, items_df)
    assert kept.columns == docs.columns
    assert kept.count() == len(odd_rows())
    assert clean_documents(none(spark), items_df).count() == 0
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert clean_documents(docs, no_items).count() == len(odd_rows())
    assert clean_documents(docs_df, items_df).count() == 3
