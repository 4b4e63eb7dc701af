"""Token files of directly addressable codes.

A token id is split into chunks of eight bits. Level 0 holds the lowest chunk of
every token; a bitmap beside it says whether more of the token follows, and
level 1 holds the next chunk of just those tokens, and so on. A rank directory
counts the bits in front of every block of the bitmap, so the place of a
token's next chunk is one lookup and a count of at most ``RANK_BITS`` bits: any
token is read without decoding those before it.

A file set is a folder of uncompressed Parquet files. A row is a segment: about
``SEGMENT_TOKENS`` tokens of whole documents, its levels, and the ids and first
tokens of its documents. Spark's writer commits a task's files as a whole, so a
task that is run again leaves no half-written segment.

Documents lie in ascending order of ``doc_id``, nulls first; documents with one
id follow each other in input order. A null or empty text has the end id only.
Repeated rows are written each; an empty table makes an empty file set. Other
columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opsframe.llm.common import batch
from opsframe.llm.kept import Kept, per_worker

SEGMENT_TOKENS = 1 << 20
RANK_BITS = 512
KEPT_STRETCHES = 1_300_000
KEPT_CHARS = 60


# --- directly addressable codes ---------------------------------------------


def encode_levels(tokens: np.ndarray) -> list[dict]:
    """Levels of chunks, continuation bits and rank directory of each."""
    levels, rest = [], tokens.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        starts = np.arange(0, len(rest), RANK_BITS)
        ranks = np.r_[0, np.cumsum(more)][starts]
        levels.append(
            {
                "chunks": (rest & 0xFF).astype(np.uint8).tobytes(),
                "more": bits.tobytes() if more.any() else b"",
                "ranks": ranks.astype("<u4").tobytes() if more.any() else b"",
            }
        )
        if not more.any():
            return levels
        rest = rest[more] >> 8


def decode_levels(levels: list[dict]) -> np.ndarray:
    """All tokens at once."""
    tokens, rest = None, None
    for k, level in enumerate(levels):
        chunks = np.frombuffer(level["chunks"], np.uint8).astype(np.uint32)
        if tokens is None:
            tokens, rest = chunks, np.arange(len(chunks))
        else:
            tokens[rest] |= chunks << np.uint32(8 * k)
        if level["more"]:
            more = np.unpackbits(
                np.frombuffer(level["more"], np.uint8),
                count=len(chunks),
                bitorder="little",
            )
            rest = rest[more.astype(bool)]
    return tokens


def token_at(levels: list[dict], i: int) -> int:
    """One token, by its place in the segment."""
    token = 0
    for k, level in enumerate(levels):
        token |= level["chunks"][i] << (8 * k)
        more = level["more"]
        if not more or not more[i >> 3] >> (i & 7) & 1:
            break
        block = i // RANK_BITS
        rank = int.from_bytes(level["ranks"][4 * block : 4 * block + 4], "little")
        start = block * RANK_BITS // 8
        bits = int.from_bytes(more[start : (i >> 3) + 1], "little")
        i = rank + (bits & ((1 << (i - 8 * start)) - 1)).bit_count()
    return token


# --- encoding ----------------------------------------------------------------


# The tokenizer never joins a character that is no white space to a space
# behind it, so texts can be cut in front of such a space.
CUT = re.compile(r"(?<=\S) ")
# A space at the start of a text or behind other white space, where that rule
# does not cut; the white space of Python's strings, as Arrow's pattern.
NO_CUT = (
    r"^ |[\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}] "
)
# Stands before the first stretch of a text; the others follow a space.
HEAD = "\0"
# Letters below this are letters in every version of Unicode at hand, and these
# marks are pieces of their own behind a letter.
PLAIN_BELOW = "\u0250"
MARKS = ".,;:!?"


def byte_signs() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: a
    visible Latin-1 character for itself, the rest numbered from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(others)) for b in range(256)]


SIGNS = byte_signs()
SPACE_SIGN = SIGNS[0x20]


class Encoder:
    """The tokenizers library, asked once for each stretch of text.

    A byte-level vocabulary is applied to each stretch apart, so joining the
    ids of stretches gives the ids of the text. A text with the string of an
    added token, or with the sign for heads, goes to the library as a whole.
    """

    def __init__(self, tokenizer_path: str):
        # Spark runs a worker per core; threads below it would only contend.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        whole = "|".join(re.escape(t.content) for t in added)
        self.whole = re.compile(f"{HEAD}|{whole}" if whole else HEAD)
        self.special = r"\x00|" + NO_CUT + (f"|{whole}" if whole else "")
        self.model = self.tokenizer.model
        self.marks = {
            mark: array(
                "I", self.tokenizer.encode(mark, add_special_tokens=False).ids
            ).tobytes()
            for mark in MARKS
        }
        self.kept = Kept(self._ids, KEPT_STRETCHES, KEPT_CHARS)

    def _ids(self, stretches: list[str]) -> list[bytes]:
        """Ids of stretches. A plain word, with one mark at most behind it, is
        one or two pieces of text for the model and skips what the library
        does to find them. A mark behind a letter is always a piece of its
        own, so what is in front of it may be known already."""
        found: list = [None] * len(stretches)
        others = []
        for k, stretch in enumerate(stretches):
            mark = self.marks.get(stretch[-1:], b"")
            word = stretch[:-1] if mark else stretch
            known = None
            if mark and word[-1:].isalpha() and word[-1] < PLAIN_BELOW:
                known = self.kept.new.get(word)
            if known is not None:
                found[k] = known + mark
            elif word.isalpha() and max(word) < PLAIN_BELOW:
                if not word.isascii():
                    word = "".join(map(SIGNS.__getitem__, word.encode()))
                pieces = self.model.tokenize(SPACE_SIGN + word)
                found[k] = array("I", [x.id for x in pieces]).tobytes() + mark
            else:
                others.append(k)
        if others:
            more = self.tokenizer.encode_batch_fast(
                [
                    stretches[k][1:]
                    if stretches[k][:1] == HEAD
                    else f" {stretches[k]}"
                    for k in others
                ],
                add_special_tokens=False,
            )
            for k, x in zip(others, more):
                found[k] = array("I", x.ids).tobytes()
        return found

    def _stretches(self, text: str) -> list[str]:
        if self.whole.search(text):
            return [HEAD + text]
        head, *tail = CUT.split(text)
        return [HEAD + head, *tail]

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and where each text begins."""
        if pc.any(pc.match_substring_regex(texts, self.special)).as_py():
            cut = pa.array(
                map(self._stretches, texts.to_pylist()), pa.list_(pa.string())
            )
        else:
            cut = pc.split_pattern(
                pc.binary_join_element_wise(HEAD, texts, ""), " "
            )
        return self.kept.join(cut)


# --- files -------------------------------------------------------------------

LEVEL = "struct<chunks: binary, more: binary, ranks: binary>"
SEGMENT = (
    "part int, segment int, first long, n_tokens long,"
    " doc_id array<{key}>, doc_start array<long>, levels array<" + LEVEL + ">"
)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    parts: int,
    segment_tokens: int = SEGMENT_TOKENS,
) -> None:
    """Encode all texts and write them in ``doc_id`` order to a new folder.

    Texts are dealt by ranges of ``doc_id`` before they are encoded; the
    input position and a hash of it split an id with very many rows.
    """
    key = docs.schema["doc_id"].dataType.simpleString()
    order = [F.asc_nulls_first("doc_id"), F.asc("_at")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker("byte encoder", tokenizer_path, make=Encoder)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        level = pa.struct(
            [(c, pa.binary()) for c in ("chunks", "more", "ranks")]
        )
        state = {"segment": 0, "first": 0}
        ids, starts, held, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            schema = pa.schema(
                [
                    ("part", pa.int32()),
                    ("segment", pa.int32()),
                    ("first", pa.int64()),
                    ("n_tokens", pa.int64()),
                    ("doc_id", pa.list_(kind)),
                    ("doc_start", pa.list_(pa.int64())),
                    ("levels", pa.list_(level)),
                ]
            )
            tokens = np.frombuffer(b"".join(held), "<u4")
            made = batch(
                schema,
                [part],
                [state["segment"]],
                [state["first"]],
                [len(tokens)],
                [list(ids)],
                [list(starts)],
                [encode_levels(tokens)],
            )
            state["segment"] += 1
            state["first"] += len(tokens)
            return made

        for rows in batches:
            kind = rows.schema.field(0).type
            tokens, edges = encoder.encode(rows.column(1))
            docs = rows.column(0).to_pylist()
            for doc, a, b in zip(docs, edges, edges[1:]):
                ids.append(doc)
                starts.append(size)
                held += (tokens[a:b].tobytes(), end)
                size += int(b - a) + 1
                if size >= segment_tokens:
                    yield flush()
                    ids, starts, held, size = [], [], [], 0
        if ids:
            yield flush()

    (
        docs.select(
            "doc_id",
            F.coalesce("text", F.lit("")).alias("text"),
            F.monotonically_increasing_id().alias("_at"),
        )
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(run, SEGMENT.format(key=key))
        .write.option("compression", "uncompressed")
        .parquet(path)
    )


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments with ``start``, the number of tokens in all before them.

    Only the counts of the parts, one row per written file, meet in one task.
    """
    segments = spark.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        segments.groupBy("part")
        .agg(F.sum("n_tokens").alias("n"))
        .select(
            "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
        )
    )
    return segments.join(F.broadcast(parts), "part").withColumn(
        "start", F.col("base") + F.col("first")
    )


def read_documents(
    spark: SparkSession, path: str, with_ids: bool = False
) -> DataFrame:
    """Each document of the files: id, first token, number of tokens and
    checksum of the tokens as little-endian 32-bit integers; with
    ``with_ids`` the tokens too."""
    segments = read_segments(spark, path)
    key = segments.schema["doc_id"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in range(rows.num_rows):
                start, doc_start, levels = (
                    rows.column(k)[row].as_py() for k in (0, 2, 3)
                )
                tokens = decode_levels(levels).astype("<u4")
                edges = [*doc_start, len(tokens)]
                cut = [tokens[a:b] for a, b in zip(edges, edges[1:])]
                columns = [
                    rows.column(1)[row].values,
                    pa.array([start + a for a in doc_start], pa.int64()),
                    pa.array(map(len, cut), pa.int64()),
                    pa.array([zlib.crc32(x.tobytes()) for x in cut], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(cut, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    more = ", ids array<long>" if with_ids else ""
    return segments.select("start", "doc_id", "doc_start", "levels").mapInArrow(
        run, f"doc_id {key}, start long, n_tokens long, ids_crc32 long{more}"
    )


def tokens_at(segments: DataFrame, places: DataFrame) -> DataFrame:
    """Single tokens: ``places`` has ``part``, ``segment`` and ``at``, the
    place in the segment; ``token`` is null beyond its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [
                token_at(levels, at) if 0 <= at < n else None
                for at, n, levels in zip(
                    *(rows.column(k).to_pylist() for k in (2, 3, 4))
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:3], pa.array(found, pa.int64())],
                names=["part", "segment", "at", "token"],
            )

    return (
        places.select("part", "segment", F.col("at").cast("long"))
        .join(segments, ["part", "segment"])
        .select("part", "segment", "at", "n_tokens", "levels")
        .mapInArrow(run, "part int, segment int, at long, token long")
    )
