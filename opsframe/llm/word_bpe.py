"""Encoding and decoding with a word-level BPE vocabulary of the tokenizers
library's JSON format (merges with an end-of-word suffix, byte-level symbols).

Steps of one text, as the library takes them: special tokens are cut out of
the raw text and keep their ids; every other piece is normalised (the
vocabulary's normaliser sequence: NFC, runs of white space to one space, lower
case), split into words by the pre-tokeniser's pattern (what it does not match
is dropped), and every word's UTF-8 bytes become byte-level symbols, the last
one with the end-of-word suffix. Merges then join adjacent symbols.

The named method: a deterministic automaton, compiled from the merges by merge
gadgets (``MergeAutomaton``), accepts a sequence of tokens exactly if the merges
lead to it. A word's ids are the one path of the automaton whose tokens spell
the word; it is searched with the longest token first, and a place from which
no token goes on is tried once only, so the work is linear in the word. The
result is the same as the library's (checked against it on whole tables in the
tests). The automaton is built once per worker; each distinct word is encoded
once per worker and kept in a bounded cache.

Decoding emits the label of every id: as the vocabulary names no decoder, the
library joins the token strings with single spaces.

Runs in Arrow batches in the Python workers; Spark reads the documents,
spreads them over tasks and keeps the digests.

Defined results: a null text is the empty text (no ids, digests of no bytes);
very long texts and words are encoded whole; repeated rows give their own
rows; an empty table gives no rows; other columns are not read, so their names
cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Distinct words whose ids a worker keeps.
CACHE_WORDS = 200_000
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_symbols() -> list[str]:
    """Printable byte-level symbol of every byte: printable Latin-1 bytes stand
    for themselves, the others take code points from 256 on, in byte order."""
    printable = [
        b
        for b in range(256)
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF
    ]
    out, extra = {}, 0
    for b in range(256):
        if b in printable:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        if model.get("type") != "BPE":
            raise ValueError("not a BPE vocabulary")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.labels = {i: t for t, i in self.vocab.items()}
        self.specials = {}
        for added in spec.get("added_tokens", []):
            self.specials[added["content"]] = added["id"]
            self.labels[added["id"]] = added["content"]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[(self.vocab[left], self.vocab[right])] = (
                rank,
                self.vocab[left + right],
            )
        self.cut = (
            regex.compile(
                "(" + "|".join(regex.escape(s) for s in sorted(
                    self.specials, key=len, reverse=True)) + ")"
            )
            if self.specials
            else None
        )
        self.words = regex.compile(_split_pattern(spec["pre_tokenizer"]))
        self.space = regex.compile(r"\p{White_Space}+")
        symbols = byte_symbols()
        # Symbol of every byte inside a word and at its end.
        self.inner = {b: chr(self.vocab[c]) for b, c in enumerate(symbols)}
        self.closing = {
            b: chr(self.vocab[c + self.suffix]) for b, c in enumerate(symbols)
        }
        self.machine = MergeAutomaton(
            self.pairs,
            frozenset(map(ord, self.inner.values())),
            frozenset(map(ord, self.closing.values())) if self.suffix
            else frozenset(),
        )
        self.encode_word = lru_cache(maxsize=CACHE_WORDS)(self._encode_word)

    def normalised(self, piece: str) -> str:
        piece = unicodedata.normalize("NFC", piece)
        # Lower case character by character, as the library does: a capital
        # sigma is always a medial sigma, without the final-sigma rule.
        return self.space.sub(" ", piece).replace("\u03a3", "\u03c3").lower()

    def _encode_word(self, word: str) -> tuple[int, ...]:
        chars = word.encode("utf-8").decode("latin-1")
        symbols = chars[:-1].translate(self.inner) + self.closing[ord(chars[-1])]
        return tuple(self.machine.path(symbols))

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        pieces = self.cut.split(text or "") if self.cut else [text or ""]
        for at, piece in enumerate(pieces):
            if at % 2:
                out.append(self.specials[piece])
                continue
            for word in self.words.findall(self.normalised(piece)):
                out.extend(self.encode_word(word))
        return out

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.labels[i] for i in ids)


class MergeAutomaton:
    """The deterministic automaton of all token sequences that merges lead to.

    ``pairs`` gives ``(left, right) -> (rank, new)``. At first every symbol may
    follow every other: one state, left and entered by all symbols (those of the merges and of
    ``inner``), and a last state that symbols of ``closing`` enter and nothing
    leaves. Every merge, in
    order of rank, applies its gadget:

    - The middle state, the one that ``left`` enters, loses its transition by
      ``right``, as the two are joined from now on. If other tokens enter that
      state as well, ``left`` first gets a copy of its own.
    - ``new`` leaves all states that ``left`` leaves and enters the state that
      ``right`` entered before. Taking the transition away first makes a row of
      equal tokens join from its left.

    A token enters the same state from everywhere, so a transition is one bit:
    ``leaves`` has a row of bits per token, one bit per state. The vocabulary of
    49,000 tokens has 11,613 states, 72 MB.

    Merges must build on symbols and tokens of earlier merges and make each
    token once, as merges learnt from a corpus do.
    """

    def __init__(
        self,
        pairs: dict,
        inner: frozenset[int] = frozenset(),
        closing: frozenset[int] = frozenset(),
    ):
        merges = [(*pair, new) for pair, (_, new) in sorted(
            pairs.items(), key=lambda item: item[1][0])]
        made = {new for _, _, new in merges}
        symbols = {i for left, right, _ in merges for i in (left, right)} - made
        symbols |= inner | closing
        ids = [*sorted(symbols), *(new for _, _, new in merges)]
        if len(ids) != len(set(ids)):
            raise ValueError("two merges make the same token")
        self.row = {token: at for at, token in enumerate(ids)}
        # A token is spelled by its symbols, as one character each.
        self.spelled = {token: chr(token) for token in symbols}
        start, last, states = 0, 1, 2
        self.enters = {t: last if t in closing else start for t in symbols}
        users = [len(symbols) - len(closing) + 1, len(closing) + 1]
        # While states are copied, the bytes of one state lie together; those
        # of states that are never made take no memory.
        leaves = np.zeros((len(ids), len(merges) // 8 + 2), np.uint8, order="F")
        filled = len(symbols)
        leaves[:filled, 0] = 1 << start
        for left, right, new in merges:
            if left not in self.enters or right not in self.enters:
                raise ValueError("a merge of tokens that are not made yet")
            middle, after = self.enters[left], self.enters[right]
            self.enters[new] = after
            met = leaves[self.row[right], middle >> 3] >> (middle & 7) & 1
            if not met or left not in self.spelled:
                # Never side by side: no state has a transition by ``new``.
                filled += 1
                continue
            users[after] += 1
            if users[middle] > 1:
                users[middle] -= 1
                users.append(1)
                bits = leaves[:filled, middle >> 3] >> (middle & 7) & 1
                leaves[:filled, states >> 3] |= bits << (states & 7)
                self.enters[left] = middle = states
                states += 1
            leaves[self.row[right], middle >> 3] &= 255 ^ (1 << (middle & 7))
            used = (states + 7) // 8
            leaves[filled, :used] = leaves[self.row[left], :used]
            self.spelled[new] = self.spelled[left] + self.spelled[right]
            filled += 1
        self.start, self.states = start, states
        width = (states + 7) // 8
        self.width, self.leaves = width, leaves[:, :width].tobytes()
        # Token, place of its row of bits and state entered, by spelling.
        self.tokens = {
            text: (token, self.row[token] * width, self.enters[token])
            for token, text in self.spelled.items()
        }
        if len(self.tokens) != len(self.spelled):
            raise ValueError("two tokens of the same symbols")
        self.longest = max(map(len, self.tokens), default=1)

    def step(self, state: int, token: int) -> int | None:
        """The state that a token leads to, or None."""
        at = self.row[token] * self.width + (state >> 3)
        if self.leaves[at] >> (state & 7) & 1:
            return self.enters[token]
        return None

    def path(self, word: str) -> list[int]:
        """The tokens of the accepted sequence that spells the symbols."""
        n, longest = len(word), self.longest
        tokens, leaves = self.tokens, self.leaves
        found: list[int] = []
        states, starts = [self.start], [0]
        dead: set[int] = set()
        at, end = 0, min(n, longest)
        while at < n:
            state = states[-1]
            byte, bit = state >> 3, state & 7
            while end > at:
                hit = tokens.get(word[at:end])
                if (
                    hit is not None
                    and leaves[hit[1] + byte] >> bit & 1
                    and end not in dead
                ):
                    break
                end -= 1
            if end > at:
                found.append(hit[0])
                states.append(hit[2])
                starts.append(end)
                at, end = end, min(n, end + longest)
            elif found:
                # The tokens of a beginning are unique: this place is no part.
                dead.add(at)
                found.pop()
                states.pop()
                starts.pop()
                at, end = starts[-1], at - 1
            else:
                raise ValueError("a symbol that the vocabulary lacks")
        return found


def merged(ids: list[int], pairs: dict) -> list[int]:
    """Symbols after all merges: the path of the merges' automaton through
    each stretch of symbols that it knows; others stay as they are."""
    machine = MergeAutomaton(pairs)
    out: list[int] = []
    for known, stretch in groupby(ids, key=machine.row.__contains__):
        part = list(stretch)
        if known:
            part = machine.path("".join(map(machine.spelled.get, part)))
        out += part
    return out


def _split_pattern(pre: dict) -> str:
    """The word pattern of the vocabulary's pre-tokeniser, with ``\\s`` as
    Unicode white space, as the library's regular expressions read it."""
    steps = pre["pretokenizers"] if pre["type"] == "Sequence" else [pre]
    for step in steps:
        if step["type"] == "Split":
            if not step.get("invert") or step.get("behavior") != "Removed":
                raise ValueError("only a split that keeps its matches")
            return step["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
    raise ValueError("no split pattern")


_loaded: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    """The encoder of a vocabulary, built once per worker."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def _digests(batches, path: str):
    bpe = loaded(path)
    for batch in batches:
        rows = batch.to_pydict()
        n, ids_digest, text_digest = [], [], []
        for text in rows["text"]:
            ids = bpe.encode(text)
            n.append(len(ids))
            ids_digest.append(
                hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
            )
            text_digest.append(
                hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest()
            )
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(rows["doc_id"], pa.int64()),
                "n_tokens": pa.array(n, pa.int64()),
                "ids_sha256": ids_digest,
                "decoded_sha256": text_digest,
            }
        )


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string")
    ).mapInArrow(lambda it: _digests(it, path), DIGESTS)
