"""SentencePiece encoding and decoding for merge-type vocabularies.

The encoder keeps an agenda of adjacent symbol pairs ordered by the score of
the piece they would make, the leftmost first among equals. It takes the best
pair, merges it and puts the two pairs around the new symbol on the agenda,
until no pair makes a piece. Symbols without a piece fall back to their bytes.

A space becomes the mark ``▁``. Where no piece has the mark behind another
character, merges never cross the border in front of a run of marks, so a text
is encoded run by run and runs met before are looked up. Whether the vocabulary
allows this is found out when it is loaded; if not, texts are encoded whole.

Each Arrow batch is held against the sentencepiece library: by ``check =
"texts"`` every text as a whole, by ``check = "runs"`` every run when it is
first met. A difference is an error, not a silent choice.

Defined results: a null text is empty and has no ids; repeated rows are encoded
one by one; an empty table gives no rows; columns other than ``keep`` and the
text are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.llm.kept import Kept, per_worker

MARK = "▁"
# A run: marks and what follows up to the next mark.
RUN = re.compile(f"{MARK}+[^{MARK}]*")
# Characters up to which an agenda is a plain list.
SHORT = 40
NEVER = float("inf")
# Runs kept per worker, where the caller gives no number (a hundred thousand take
# about 30 MB), and the longest that is kept.
KEPT_RUNS = 150_000
KEPT_CHARS = 40
# Texts decoded and digested at once.
AT_ONCE = 100


class Vocabulary:
    """The pieces a text can be merged to, and the bytes behind the rest."""

    def __init__(self, model_path: str, room: int = KEPT_RUNS // 3):
        import sentencepiece

        self.room = room

        self.library = sentencepiece.SentencePieceProcessor(
            model_file=model_path
        )
        size = self.library.vocab_size()
        pieces = [self.library.id_to_piece(i) for i in range(size)]
        is_byte = [self.library.is_byte(i) for i in range(size)]
        self.bytes = {
            int(p[1:-1], 16): i
            for i, p in enumerate(pieces)
            if is_byte[i]
        }
        self.ids = {
            p: i
            for i, p in enumerate(pieces)
            if not (
                is_byte[i]
                or self.library.is_control(i)
                or self.library.is_unknown(i)
            )
        }
        self.costs = {
            p: -self.library.get_score(i) for p, i in self.ids.items()
        }
        self.pairs = {
            pair for p in self.ids for pair in map(add, p, p[1:])
        }
        self.known: dict[str, list[int]] = {}
        self.unknown = self.library.unk_id()
        self.by_runs = not any(
            re.search(f"[^{MARK}]{MARK}", piece) for piece in self.ids
        )

    def merge(self, text: str) -> list[str]:
        """The symbols that no further merge can join."""
        if len(text) > SHORT:
            return self.merge_long(text)
        # The agenda of a short text is the list of its pairs' costs, looked
        # over for the lowest, which is quicker than keeping it in order.
        symbols = list(text)
        cost_of = self.costs.get
        agenda = [
            cost_of(pair, NEVER) for pair in map(add, symbols, symbols[1:])
        ]
        while agenda and (best := min(agenda)) != NEVER:
            at = agenda.index(best)
            made = symbols[at] = symbols[at] + symbols.pop(at + 1)
            del agenda[at]
            if at < len(agenda):
                agenda[at] = cost_of(made + symbols[at + 1], NEVER)
            if at:
                agenda[at - 1] = cost_of(symbols[at - 1] + made, NEVER)
        return symbols

    def merge_long(self, text: str) -> list[str]:
        """The same with the agenda in a heap, for texts of any length."""
        symbols = list(text)
        n = len(symbols)
        before, behind = list(range(-1, n - 1)), list(range(1, n + 1))
        cost_of = self.costs.get
        agenda = [
            (cost, at, pair)
            for at, pair in enumerate(map(add, symbols, symbols[1:]))
            if (cost := cost_of(pair)) is not None
        ]
        heapify(agenda)
        while agenda:
            _, at, pair = heappop(agenda)
            other = behind[at]
            # The entry is out of date if either symbol has changed since.
            if other == n or not symbols[at]:
                continue
            if symbols[at] + symbols[other] != pair:
                continue
            symbols[at], symbols[other] = pair, ""
            behind[at] = after = behind[other]
            if after < n:
                before[after] = at
                made = pair + symbols[after]
                if (cost := cost_of(made)) is not None:
                    heappush(agenda, (cost, at, made))
            if (last := before[at]) >= 0:
                made = symbols[last] + pair
                if (cost := cost_of(made)) is not None:
                    heappush(agenda, (cost, last, made))
        return [s for s in symbols if s]

    def segments(self, text: str) -> list[str]:
        """The text cut between characters that no piece has side by side,
        where no merge can cross."""
        cuts = [
            at
            for at, pair in enumerate(map(add, text, text[1:]), 1)
            if pair not in self.pairs
        ]
        if not cuts:
            return [text]
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]

    def encode_run(self, text: str) -> list[int]:
        """Ids of a marked text."""
        if not self.bytes:
            return self.numbered(self.merge(text))
        found = []
        for segment in self.segments(text):
            ids = self.known.get(segment)
            if ids is None:
                ids = self.numbered(self.merge(segment))
                if len(segment) <= KEPT_CHARS:
                    if len(self.known) >= self.room:
                        self.known.clear()
                    self.known[segment] = ids
            found += ids
        return found

    def numbered(self, symbols: list[str]) -> list[int]:
        """Ids of symbols, bytes or one unknown id for those without."""
        found: list[int] = []
        for symbol in symbols:
            i = self.ids.get(symbol)
            if i is not None:
                found.append(i)
            elif self.bytes:
                found += [self.bytes[x] for x in symbol.encode()]
            elif not found or found[-1] != self.unknown:
                found.append(self.unknown)
        return found


def compare(ours: list, library: list, texts: list) -> None:
    for mine, other, text in zip(ours, library, texts):
        if mine != other:
            raise ValueError(
                f"ids differ from the library's for {text[:200]!r}"
            )


class Encoder:
    """Ids of whole texts, run by run, with runs held against the library."""

    def __init__(self, words: Vocabulary, kept_runs: int = KEPT_RUNS):
        self.words = words
        self.decimals = list(map(str, range(words.library.vocab_size())))
        self.kept = Kept(self._ids, kept_runs, KEPT_CHARS)

    def _ids(self, runs: list[str]) -> list[bytes]:
        """Encode runs, given without their first mark, and hold them against
        the library.

        The library puts a mark in front of what it is given; for nothing but
        that mark it has no ids.
        """
        found = [self.words.encode_run(MARK + run) for run in runs]
        known = [k for k, run in enumerate(runs) if run]
        plain = [runs[k] for k in known]
        compare(
            [found[k] for k in known],
            self.words.library.encode(plain, num_threads=1),
            plain,
        )
        return [np.array(x, "<u4").tobytes() for x in found]

    def _runs(self, text: str) -> list[str]:
        """Runs of a text with the leading mark the library adds."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        if not self.words.by_runs:
            return [marked[1:]]
        return [run[1:] for run in RUN.findall(marked)]

    def encode(self, texts: pa.StringArray) -> list[np.ndarray]:
        """Ids of each text."""
        plain = texts.to_pylist()
        if not self.words.by_runs or any(
            x[:1] in ("", " ") or x[-1:] == " " or "  " in x or MARK in x
            for x in plain
        ):
            cut = pa.array(map(self._runs, plain), pa.list_(pa.string()))
        else:
            cut = pc.split_pattern(texts, " ")
        ids, edges = self.kept.join(cut)
        return [ids[a:b] for a, b in zip(edges, edges[1:])]


def load_encoder(model_path: str, kept_runs: int = KEPT_RUNS) -> Encoder:
    return Encoder(Vocabulary(model_path, kept_runs // 3), kept_runs)


OUTPUT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def piece_digests(
    docs: DataFrame,
    model_path: str,
    keep: tuple[str, ...] = ("doc_id",),
    check: str = "texts",
    with_ids: bool = False,
    kept_runs: int = KEPT_RUNS,
) -> DataFrame:
    """The ``keep`` columns, the number of ids and the digests of the ids and
    of the text the library decodes from them; with ``with_ids`` the ids and
    the decoded text too. More ``kept_runs`` trade a worker's memory for
    time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(
            "piece encoder", model_path, kept_runs, make=load_encoder
        )
        library = encoder.words.library
        decimal = encoder.decimals.__getitem__
        for docs in batches:
            texts = docs.column(docs.num_columns - 1)
            ids = encoder.encode(texts)
            for start in range(0, len(ids), AT_ONCE):
                some = docs.slice(start, AT_ONCE)
                # Ids as Python numbers take much room, so of few texts.
                lists = [x.tolist() for x in ids[start : start + AT_ONCE]]
                if check == "texts":
                    plain = some.column(some.num_columns - 1).to_pylist()
                    compare(
                        lists, library.encode(plain, num_threads=1), plain
                    )
                yield digests(some, lists, library.decode(lists), decimal)
            del ids, docs, texts
            # The worker lives on; what it no longer needs goes back.
            pa.default_memory_pool().release_unused()

    def digests(docs, ids, decoded, decimal) -> pa.RecordBatch:
        def sha(text: str) -> str:
            return hashlib.sha256(text.encode()).hexdigest()

        columns = [
            *docs.columns[:-1],
            pa.array(map(len, ids), pa.int64()),
            pa.array([sha(",".join(map(decimal, x))) for x in ids], pa.string()),
            pa.array(map(sha, decoded), pa.string()),
        ]
        names = [*docs.schema.names[:-1]]
        names += ["n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            columns.append(pa.array(ids, pa.list_(pa.int32())))
            columns.append(pa.array(decoded, pa.string()))
            names += ["ids", "decoded"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    kept = "".join(
        f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep
    )
    more = ", ids array<int>, decoded string" if with_ids else ""
    return docs.select(
        *(F.col(f"`{c}`") for c in keep),
        F.coalesce("text", F.lit("")).alias("_text"),
    ).mapInArrow(run, f"{kept}{OUTPUT}{more}")
