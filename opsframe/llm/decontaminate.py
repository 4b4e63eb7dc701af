"""Benchmark decontamination with one Aho-Corasick automaton.

Items (test questions and answers) are normalised to words and cut into
windows; all windows go into one automaton, which passes over the normalised
text of a document once. What it finds is mapped back to word numbers and to
character offsets of the original text.

The items are a small table: their size is checked against ``ITEM_BYTES`` and
their texts are brought to the driver and broadcast. Where they exceed
``BLOCK_BYTES`` they are cut into blocks and a batch of documents passes one
automaton after the other, so automata stay bounded. A benchmark beyond
``ITEM_BYTES`` is an error and not cut short: scan its parts one by one, a
document is clean if it is clean of each.

Defined results: a null or empty text has no words and is clean; an item
without words has no window; an item with a null id counts for hits but is not
listed; items with equal ids are one item; repeated documents are judged one by
one; empty tables give an empty result or clean documents; columns other than
key and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.llm.common import batch, text_bytes

# Bytes that are part of words: digits, letters and all beyond ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TO_WORDS = bytes(
    i if WORD.fullmatch(bytes([i])) else 0x20
    for i in range(256)
)
WINDOW = 10
BLOCK_BYTES = 64 << 20
ITEM_BYTES = 1 << 30


def words_of(data: bytes) -> list[bytes]:
    """Lower-cased words of a text."""
    return data.lower().translate(TO_WORDS).split()


def as_line(words: list[bytes]) -> str:
    """Words with one space around each, so that windows match whole words."""
    return f" {b' '.join(words).decode(errors='surrogateescape')} "


def windows_of(words: list[bytes], width: int) -> Iterator[list[bytes]]:
    if words:
        for i in range(max(1, len(words) - width + 1)):
            yield words[i : i + width]


def automaton_of(items: list[tuple[str | None, bytes]], width: int):
    """All windows; each leads to its word count and the ids that have it."""
    found: dict[str, tuple[int, set]] = {}
    for item, data in items:
        for window in windows_of(words_of(data), width):
            found.setdefault(as_line(window), (len(window), set()))[1].add(
                item
            )
    machine = ahocorasick.Automaton()
    for line, value in found.items():
        machine.add_word(line, value)
    if found:
        machine.make_automaton()
    return machine if found else None


def blocks_of(items: list[tuple], limit: int) -> list[list[tuple]]:
    """Items in blocks of at most ``limit`` bytes of text, or of one item."""
    blocks: list[list[tuple]] = []
    size = 0
    for item in items:
        if not blocks or size + len(item[1]) > limit:
            blocks.append([])
            size = 0
        blocks[-1].append(item)
        size += len(item[1])
    return blocks


def hits_of(words: list[bytes], line: str, machine) -> tuple:
    """Which words are hit, as a mask, and the ids found; None if none are."""
    matches = list(machine.iter(line)) if machine else []
    if not matches:
        return None, set()
    spaces = np.flatnonzero(
        np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
        == 0x20
    )
    edges = np.zeros(len(words) + 1, np.int64)
    ids: set = set()
    ends = np.searchsorted(spaces, [end for end, _ in matches])
    for end, (_, (width, items)) in zip(ends, matches):
        edges[end - width] += 1
        edges[end] -= 1
        ids |= items
    return np.cumsum(edges[:-1]) > 0, ids


def spans_of(data: bytes, mask: np.ndarray) -> list[dict]:
    """Runs of hit words as character offsets of the original text."""
    places = [m.span() for m in WORD.finditer(data.lower())]
    starts = np.flatnonzero(mask & ~np.r_[False, mask[:-1]])
    ends = np.flatnonzero(mask & ~np.r_[mask[1:], False])
    heads = np.cumsum(
        (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    )  # characters begun up to each byte
    char = lambda at: int(heads[at - 1]) if at else 0
    return [
        {"start": char(places[a][0]), "end": char(places[b][1])}
        for a, b in zip(starts, ends)
    ]


OUTPUT = {
    "n_words": "long",
    "n_hit": "long",
    "n_items": "long",
    "items_sha256": "string",
    "contaminated": "boolean",
    "items": "array<string>",
    "spans": "array<struct<start: long, end: long>>",
}


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    width: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    item_bytes: int = ITEM_BYTES,
    keep: tuple[str, ...] = ("doc_id",),
    prefix: str = "",
) -> DataFrame:
    """The ``keep`` columns of each document and what it shares with items.

    ``items`` has ``item_id`` and ``text``. ``spans`` holds the hit passages as
    character offsets [start, end) into the original text. ``prefix`` goes in
    front of the names of the columns made here.
    """
    spark = docs.sparkSession
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    if size > item_bytes:
        raise ValueError(f"{size} bytes of items, more than {item_bytes}")
    rows = items.select(
        F.col("item_id").cast("string"), text_bytes()
    ).collect()
    blocks = spark.sparkContext.broadcast(
        blocks_of(sorted(map(tuple, rows), key=repr), block_bytes)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single = len(blocks.value) == 1
        built = automaton_of(blocks.value[0], width) if single else None
        item = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for docs in batches:
            schema = pa.schema(
                list(docs.schema)[:-1]
                + [
                    (prefix + name, kind)
                    for name, kind in zip(
                        OUTPUT,
                        (
                            pa.int64(),
                            pa.int64(),
                            pa.int64(),
                            pa.string(),
                            pa.bool_(),
                            pa.list_(pa.string()),
                            pa.list_(item),
                        ),
                    )
                ]
            )
            texts = docs.column(docs.num_columns - 1)
            masks = [None] * len(texts)
            found = [set() for _ in range(len(texts))]
            counts = [0] * len(texts)
            for block in blocks.value or [[]]:
                machine = built if single else automaton_of(block, width)
                for k, value in enumerate(texts):
                    words = words_of(value.as_py())
                    counts[k] = len(words)
                    mask, ids = hits_of(words, as_line(words), machine)
                    if mask is not None:
                        old = masks[k]
                        masks[k] = mask if old is None else mask | old
                        found[k] |= ids
            listed = [sorted(x for x in f if x is not None) for f in found]
            yield batch(
                schema,
                *docs.columns[:-1],
                counts,
                [0 if m is None else int(m.sum()) for m in masks],
                list(map(len, listed)),
                [
                    hashlib.sha256(",".join(x).encode()).hexdigest()
                    for x in listed
                ],
                [m is not None for m in masks],
                listed,
                [
                    [] if m is None else spans_of(t.as_py(), m)
                    for t, m in zip(texts, masks)
                ],
            )

    kept = ", ".join(
        f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep
    )
    made = ", ".join(f"`{prefix}{c}` {kind}" for c, kind in OUTPUT.items())
    return docs.select(
        *(F.col(f"`{c}`") for c in keep), text_bytes(text).alias("_text")
    ).mapInArrow(run, f"{kept}, {made}")


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any passage of the items."""
    found = contamination(docs, items, keep=tuple(docs.columns), prefix="_")
    return found.where("NOT _contaminated").select(
        *(F.col(f"`{c}`") for c in docs.columns)
    )
