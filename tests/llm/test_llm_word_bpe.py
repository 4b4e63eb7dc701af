"""Word-level BPE against the tokenizers library."""

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_cases import LONG, none, odd, odd_rows, rows_of
from opsframe.llm.word_bpe import MergeAutomaton, WordBpe, bpe_digests, merged

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)
OWN = WordBpe(PATH)
ODD = [
    "Hello World's  test\tΣΑΣ 123 <|endoftext|>x", "ΣΑΣ. ǅx İ ﬃ",
    "\x1c a\x1fb  c d e", "<|startoftext|><|endoftext|>",
    "<|endof<|endoftext|>text|>", "x" * 30_000, "ab" * 20_000, LONG,
    "٣٤ ½ ²", "😀😀 a😀b", "don't WE'LL they'RE", "",
]


def library(text):
    ids = LIB.encode(text or "", add_special_tokens=False).ids
    return ids, LIB.decode(ids, skip_special_tokens=False)


def test_odd_texts():
    for text in ODD + [r[1] for r in odd_rows()]:
        ids = OWN.encode(text)
        assert (ids, OWN.decode(ids)) == library(text)


@given(st.text(alphabet="aAbΣσς. \t\n\x1c\x85İǅ1٣'sLL<|>endoftx😀́é漢-",
               max_size=60))
@settings(max_examples=400, deadline=None)
def test_random_texts(text):
    ids = OWN.encode(text)
    assert (ids, OWN.decode(ids)) == library(text)


def test_merges_take_lowest_rank_leftmost():
    pairs = {(1, 1): (0, 2), (2, 1): (1, 3), (1, 2): (2, 4)}
    assert merged([1, 1, 1], dict(pairs)) == [3]
    assert merged([1, 1, 1, 1, 1], dict(pairs)) == [2, 3]
    assert merged([7], pairs) == [7] and merged([], pairs) == []


def test_automaton_accepts_merged_sequences_only():
    # a=1, b=2; aa=3, aab=4, ba=5, in this order of merges.
    pairs = {(1, 1): (0, 3), (3, 2): (1, 4), (2, 1): (2, 5)}
    machine = MergeAutomaton(pairs)

    def accepts(tokens):
        state = machine.start
        for token in tokens:
            if state is not None:
                state = machine.step(state, token)
        return state is not None

    def lead_to(tokens):
        """Whether the merges, applied one after the other, give them."""
        spell = {1: [1], 2: [2], 3: [1, 1], 4: [1, 1, 2], 5: [2, 1]}
        now = [x for t in tokens for x in spell[t]]
        for (left, right), (_, new) in pairs.items():
            out = []
            while now:
                joins = now[:2] == [left, right]
                out.append(new if joins else now[0])
                now = now[1 + joins:]
            now = out
        return now == list(tokens)

    for n in range(1, 6):
        for tokens in itertools.product(range(1, 6), repeat=n):
            assert accepts(tokens) == lead_to(tokens), tokens


def test_words_are_paths_of_the_automaton():
    for word in ("unbelievable", "aaaaaaa", "x" * 300, "漢字kana", "<|/w>"):
        state = OWN.machine.start
        for token in OWN.encode_word(word):
            state = OWN.machine.step(state, token)
            assert state is not None
    assert OWN.machine.states == 11_613


def digests(text):
    ids, decoded = library(text)
    return (
        len(ids),
        hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(),
        hashlib.sha256(decoded.encode()).hexdigest(),
    )


def test_query_rows_against_library(spark, tables):
    docs = tables("documents")
    want = {r.doc_id: digests(r.text) for r in docs.collect()}
    got = {
        r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
        for r in rows_of(bpe_digests(docs, PATH))
    }
    assert got == want


def test_odd_rows_and_empty(spark):
    found = sorted(
        ((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"],
          r["ids_sha256"], r["decoded_sha256"])
         for r in rows_of(bpe_digests(odd(spark), PATH))),
    )
    want = sorted(
        (i is None, i or 0, *digests(t)) for i, t, *_ in odd_rows()
    )
    assert found == want
    assert bpe_digests(none(spark), PATH).count() == 0
