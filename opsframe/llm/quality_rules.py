"""Quality rules as a short-circuit cascade.

Every rule looks at one page of text and says whether it rejects it. A sample
gives each rule's cost and the share of pages it rejects, and the cascade asks
the rules in the order of rejection per cost, stopping at the first that
rejects. The order decides only how much work is done: the verdict is that all
rules accept, whatever the order.

Defined results: a null or empty text has no words and fails the base rules;
repeated rows are judged one by one; an empty table gives an empty result;
columns other than the key and the text are not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.llm.common import batch, text_bytes

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))
WINDOW = 8
SAMPLE_ROWS = 500


class Page:
    """A text and the counts rules ask for, each made when first needed."""

    def __init__(self, data: bytes):
        self.data = data

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.data.translate(None, SPACES + CONTINUATION))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.data.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words)

    @cached_property
    def n_same_as_last(self) -> int:
        return sum(map(bytes.__eq__, self.words, self.words[1:]))

    @cached_property
    def n_upper(self) -> int:
        upper = bytes(range(ord("A"), ord("Z") + 1))
        return len(self.data) - len(self.data.translate(None, upper))

    @cached_property
    def n_lower(self) -> int:
        lower = bytes(range(ord("a"), ord("z") + 1))
        return len(self.data) - len(self.data.translate(None, lower))

    @cached_property
    def n_no_letter(self) -> int:
        """Words without an ASCII letter or a character beyond ASCII."""
        kept = self.data.translate(None, NO_LETTERS).split()
        return self.n_words - len(kept)


# Without these bytes a word that has no letter leaves nothing behind.
NO_LETTERS = bytes(
    i for i in range(0x80) if i not in SPACES and not chr(i).isalpha()
)


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur more than once.

    Windows are numbered exactly by doubling: equal numbers of two neighbouring
    halves make equal numbers of the whole. ``width`` is a power of two.
    """
    n = len(words)
    if n <= width:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter(
        (seen.setdefault(w, len(seen)) for w in words), np.int64, n
    )
    if len(seen) == n:
        return 0
    step = 1
    while step < width:
        pairs = ids[:-step] * n + ids[step:]
        ids = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        step *= 2
    repeated = np.bincount(ids)[ids] > 1
    if not repeated.any():
        return 0
    ends = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(repeated)
    np.add.at(ends, starts, 1)
    np.add.at(ends, starts + width, -1)
    return int((np.cumsum(ends[:-1]) > 0).sum())


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Page], bool]


def base_failed(page: Page) -> bool:
    """Too short, or mostly repeated passages."""
    return page.n_words < 20 or 100 * page.n_repeat_words > 30 * page.n_words


# All conditions are integer comparisons, so that SQL can say the same.
RULES = (
    Rule("symbols", lambda p: 10 * p.n_symbols > p.n_words),
    Rule(
        "duplicate lines",
        lambda p: p.n_dup_lines > 3 and 10 * p.n_dup_lines > 3 * len(p.lines),
    ),
    Rule(
        "word length",
        lambda p: p.word_chars < 2 * p.n_words
        or p.word_chars > 15 * p.n_words,
    ),
    Rule("letters", lambda p: 10 * p.n_no_letter > 3 * p.n_words),
    Rule("capitals", lambda p: p.n_upper > p.n_lower),
    Rule("exclamation", lambda p: 5 * p.data.count(b"!") > p.n_words),
    Rule("stutter", lambda p: 10 * p.n_same_as_last > 3 * p.n_words),
)


class Measure(NamedTuple):
    rule: str
    seconds: float
    rejected: int


def measure(pages: DataFrame, rules=RULES, rows: int = SAMPLE_ROWS):
    """Seconds and rejections of each rule on at most ``rows`` pages.

    The sample is the first rows a scan delivers, cut in one task; it steers
    the order of the rules only, never a verdict. Each rule starts from a page
    without counts, as it would when asked first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("rule", pa.string()),
                ("seconds", pa.float64()),
                ("rejected", pa.int64()),
            ]
        )
        texts = [x for b in batches for x in b.column(0).to_pylist()]
        for rule in rules:
            start = time.process_time()
            rejected = sum(rule.rejects(Page(x)) for x in texts)
            took = time.process_time() - start
            yield batch(schema, [rule.name], [took], [rejected])

    sample = pages.select(text_bytes().alias("text")).limit(rows)
    found = sample.mapInArrow(
        run, "rule string, seconds double, rejected long"
    ).collect()
    return [Measure(*row) for row in found]


def ordered(rules, measures: list[Measure]) -> list[Rule]:
    """Rules by rejections per second, best first; unmeasured ones last."""
    worth = {m.rule: m.rejected / max(m.seconds, 1e-9) for m in measures}
    return sorted(rules, key=lambda r: -worth.get(r.name, 0.0))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_rules(
    docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed`` and ``kept`` of each page.

    The base counts are part of the result and made for every page; a page
    that fails the base rules is not shown to the cascade.
    """
    chain = ordered(rules, measure(docs, rules, sample_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for rows in batches:
            schema = schema or pa.schema(
                [rows.schema.field(0)]
                + [(c, pa.int64()) for c in COUNTS]
                + [("base_failed", pa.bool_()), ("kept", pa.bool_())]
            )
            counts, failed, kept = [], [], []
            for value in rows.column(1):
                page = Page(value.as_py())
                counts.append([getattr(page, c) for c in COUNTS])
                failed.append(base_failed(page))
                kept.append(
                    not failed[-1] and not any(r.rejects(page) for r in chain)
                )
            columns = list(zip(*counts)) or [[]] * len(COUNTS)
            yield batch(schema, rows.column(0), *columns, failed, kept)

    key = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(
        run, f"doc_id {key}, {counts}, base_failed boolean, kept boolean"
    )
