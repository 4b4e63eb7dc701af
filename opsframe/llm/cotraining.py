"""A quality classifier trained by two views that teach each other.

One view is the content of a page: shapes of its words alone and in pairs,
repetition, and the words themselves. The other is what is known about the page
without its text: source, language and length. Each view has a logistic
regression of its own on hashed features. In each round either classifier labels
the unlabelled pages it is surest of, and the other learns from them; then each
view is calibrated on labelled pages that took no part, and the calibrated
log-odds of both are added up, less the prior they share, to score every page.

Training is bounded: at most ``max_labelled`` labelled and ``max_pool``
unlabelled pages, drawn by a hash of the id over all of them, whose features are
brought to the driver. Scoring covers all rows.

Defined results: a null text is empty; null metadata is a value of its own; of
several labels for an id the lowest counts; ids without a label, and null ids,
are unlabelled; with fewer than ``MIN_LABELLED`` labelled pages of either class
there is no classifier: scores are null and every page is kept. An empty table
gives no rows. Repeated rows are scored one by one. A score column replaces an
input column of its name.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT_BITS = 15
META_BITS = 11
MAX_LABELLED = 3000
MAX_POOL = 3000
MIN_LABELLED = 10
ROUNDS = 3
# Pages each view labels for the other in a round, as a share of the pool, and
# how sure it must be.
SHARE = 0.1
SURE = 0.95
THRESHOLD = 0.5

# --- views -------------------------------------------------------------------

# Letters become one of two signs, digits a third; everything else stays.
SHAPE = bytes(
    ord("A")
    if 0x41 <= b <= 0x5A
    else ord("a")
    if 0x61 <= b <= 0x7A or b >= 0x80
    else ord("0")
    if 0x30 <= b <= 0x39
    else b
    for b in range(256)
)
# Bytes of a word that its shape and its feature are taken from.
LONGEST = 40


def short_shape(shape: bytes) -> bytes:
    """A shape with runs of one sign drawn together to two at most."""
    kept = bytearray()
    for sign in shape[:LONGEST]:
        if kept[-2:] != bytes([sign, sign]):
            kept.append(sign)
    return bytes(kept)


class ShortShapes(dict):
    def __missing__(self, shape: bytes) -> bytes:
        if len(self) > 100_000:
            self.clear()
        found = self[shape] = short_shape(shape)
        return found


def slot(kind: bytes, name: bytes, bits: int) -> int:
    return zlib.crc32(name, zlib.crc32(kind)) & ((1 << bits) - 1)


def scaled(counts: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a vector of length one from dampened counts."""
    slots = np.fromiter(counts, np.int32, len(counts))
    values = np.log1p(
        np.fromiter(counts.values(), np.float32, len(counts))
    )
    return slots, values / max(float(np.sqrt((values**2).sum())), 1e-9)


def text_view(data: bytes, shapes: ShortShapes) -> tuple:
    """Features of a text: word shapes, pairs of them, repeats and words."""
    words = data.split()
    short = [shapes[s] for s in data.translate(SHAPE).split()]
    found: Counter = Counter()
    for shape, n in Counter(short).items():
        found[slot(b"shape", shape, TEXT_BITS)] += n
    for (one, other), n in Counter(zip(short, short[1:])).items():
        found[slot(b"pair", one + b" " + other, TEXT_BITS)] += n
    for word, n in Counter(data.lower().split()).items():
        found[slot(b"word", word[:LONGEST], TEXT_BITS)] += n
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    tenths = 10 * repeats // max(len(words), 1)
    found[slot(b"repeats", str(tenths).encode(), TEXT_BITS)] += 1 + len(words)
    found[slot(b"words", str(len(words).bit_length()).encode(), TEXT_BITS)] += 1
    return scaled(found)


def meta_view(source, lang, n_chars) -> tuple:
    """Features of what is known besides the text."""
    size = "" if n_chars is None else str(int(max(n_chars, 0)).bit_length())
    found: Counter = Counter()
    for kind, name in (
        (b"source", str(source)),
        (b"lang", str(lang)),
        (b"size", size),
        (b"source and lang", f"{source} {lang}"),
        (b"bias", ""),
    ):
        found[slot(kind, name.encode(), META_BITS)] += 1
    return scaled(found)


# --- logistic regression -----------------------------------------------------


class Rows:
    """Sparse rows in one array of slots and one of values."""

    def __init__(self, views: list[tuple], bits: int):
        self.slots = np.concatenate([v[0] for v in views]).astype(np.int32)
        self.values = np.concatenate([v[1] for v in views]).astype(np.float32)
        sizes = [len(v[0]) for v in views]
        self.row = np.repeat(np.arange(len(views), dtype=np.int32), sizes)
        self.shape = (len(views), 1 << bits)

    def times(self, weights: np.ndarray) -> np.ndarray:
        products = self.values * weights[self.slots]
        return np.bincount(self.row, products, self.shape[0])

    def back(self, by_row: np.ndarray) -> np.ndarray:
        products = self.values * by_row[self.row]
        return np.bincount(self.slots, products, self.shape[1])


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: Rows, label, weight, start=None, steps=80, ridge=1e-4):
    """Weights and bias of a ridge logistic regression, by descent with
    running averages of slopes and of their squares (Adam)."""
    weights = np.zeros(rows.shape[1] + 1) if start is None else start.copy()
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    weight = weight / weight.sum()
    for step in range(1, steps + 1):
        off = weight * (logistic(rows.times(weights) + weights[-1]) - label)
        slope = np.r_[rows.back(off), off.sum()]
        slope[:-1] += ridge * weights[:-1]
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        weights -= (
            0.3
            * (mean / (1 - 0.9**step))
            / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        )
    return weights


def balanced(label: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Equal weight for both classes among the rows in use."""
    ones = max((used & (label == 1)).sum(), 1)
    zeros = max((used & (label == 0)).sum(), 1)
    return np.where(label == 1, 0.5 / ones, 0.5 / zeros) * used


class Scale(NamedTuple):
    """Log-odds of a calibrated view: ``slope * margin + shift``."""

    slope: float
    shift: float


def calibrate(margin: np.ndarray, label: np.ndarray) -> Scale:
    """Platt's scaling with his smoothed targets, by Newton's method."""
    ones, zeros = (label == 1).sum(), (label == 0).sum()
    goal = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    found = np.array([0.0, np.log((ones + 1) / (zeros + 1))])
    for _ in range(50):
        p = logistic(x @ found)
        slope = x.T @ (p - goal) + 1e-3 * found * [1, 0]
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        found = found - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return Scale(*map(float, found))


class Model(NamedTuple):
    text: np.ndarray
    meta: np.ndarray
    text_scale: Scale
    meta_scale: Scale
    prior: float


def cotrain(text: Rows, meta: Rows, label: np.ndarray, rounds: int) -> Model:
    """``label`` is 0, 1, or -1 where unknown; every fifth labelled row is held
    back for calibration."""
    known = np.flatnonzero(label >= 0)
    held = np.zeros(len(label), bool)
    for value in (0, 1):
        held[known[label[known] == value][::5]] = True
    views = (text, meta)
    # What each view learns from: the labels, and what the other one tells it.
    lessons = [np.where(held, -1, label) for _ in views]
    weights = [None, None]
    for turn in range(rounds + 1):
        for v, rows in enumerate(views):
            used = lessons[v] >= 0
            goal = np.where(used, lessons[v], 0)
            weights[v] = fit(
                rows, goal, balanced(goal, used), weights[v],
                steps=80 if turn == 0 else 30,
            )
        if turn == rounds:
            break
        told = []
        for v, rows in enumerate(views):
            p = logistic(rows.times(weights[v]) + weights[v][-1])
            free = (label < 0) & (lessons[1 - v] < 0)
            most = int(SHARE * (label < 0).sum())
            best = np.argsort(-np.abs(p - 0.5), kind="stable")
            best = best[free[best]][:most]
            best = best[np.maximum(p[best], 1 - p[best]) >= SURE]
            told.append((best, (p[best] > 0.5).astype(int)))
        for v, (best, value) in enumerate(told):
            lessons[1 - v][best] = value
    scales = [
        calibrate(
            rows.times(weights[v])[held] + weights[v][-1], label[held]
        )
        for v, rows in enumerate(views)
    ]
    ones, zeros = (label[held] == 1).sum(), (label[held] == 0).sum()
    prior = float(np.log((ones + 1) / (zeros + 1)))
    return Model(
        weights[0].astype(np.float32),
        weights[1].astype(np.float32),
        scales[0], scales[1], prior,
    )


# --- tables ------------------------------------------------------------------


def _meta(docs: DataFrame) -> list[Column]:
    """Source, language and length, null where a table has no such column."""
    return [
        (
            F.col(f"`{c}`") if c in docs.columns else F.lit(None)
        ).cast("long" if c == "n_chars" else "string").alias(f"_{c}")
        for c in ("source", "lang", "n_chars")
    ]


def _drawn(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` ids, the same ones whatever the partitions."""
    order = F.xxhash64("doc_id", F.lit("drawn"))
    return ids.orderBy(order, "doc_id").limit(most)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    max_labelled: int = MAX_LABELLED,
    max_pool: int = MAX_POOL,
    rounds: int = ROUNDS,
) -> Model | None:
    """A model for P(label = 1), or None where labels don't suffice."""
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("_label"))
    )
    drawn = _drawn(ids.join(known, "doc_id"), max_labelled).union(
        _drawn(ids.join(known, "doc_id", "left_anti"), max_pool).withColumn(
            "_label", F.lit(-1)
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = ShortShapes()
        for rows in batches:
            columns = [c.to_pylist() for c in rows.columns]
            texts = [text_view(x, shapes) for x in columns[2]]
            metas = [meta_view(*x) for x in zip(*columns[3:])]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    rows.column(1),
                    *(
                        pa.array([v[k] for v in views], pa.list_(kind))
                        for views in (texts, metas)
                        for k, kind in enumerate((pa.int32(), pa.float32()))
                    ),
                ],
                names=["doc_id", "label", "ts", "tv", "ms", "mv"],
            )

    key = docs.schema["doc_id"].dataType.simpleString()
    # The ids are bounded by the two limits, so they may go to every task.
    sample = (
        docs.select(
            "doc_id",
            F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("_text"),
            *_meta(docs),
        )
        .join(F.broadcast(drawn), "doc_id")
        # One row of an id, or an id with very many rows would be the sample.
        .groupBy("doc_id", "_label")
        .agg(F.min(F.struct("_text", "_source", "_lang", "_n_chars")).alias("_r"))
        .select("doc_id", "_label", "_r.*")
        .mapInArrow(
            run,
            f"doc_id {key}, label int, ts array<int>, tv array<float>,"
            " ms array<int>, mv array<float>",
        )
        .toArrow()
        .sort_by("doc_id")
    )
    label_of = sample.column("label").to_numpy().copy()
    if min((label_of == 0).sum(), (label_of == 1).sum()) < MIN_LABELLED:
        return None

    def rows_of(slots: str, values: str, bits: int) -> Rows:
        pairs = [
            [x.values.to_numpy() for x in sample.column(c)]
            for c in (slots, values)
        ]
        return Rows(list(zip(*pairs)), bits)

    text = rows_of("ts", "tv", TEXT_BITS)
    meta = rows_of("ms", "mv", META_BITS)
    # The sample is copied; what held it is free before the fits begin.
    del sample
    pa.default_memory_pool().release_unused()
    return cotrain(text, meta, label_of, rounds)


SCORES = ("p_text", "p_meta", "score", "kept")


def score(
    docs: DataFrame,
    model: Model | None,
    threshold: float = THRESHOLD,
    prefix: str = "",
) -> DataFrame:
    """The columns of ``docs`` with the calibrated probability of each view,
    that of both, and whether the page is kept. ``prefix`` goes in front of the
    names of these columns."""
    made = [prefix + c for c in SCORES]
    plain = [f"`{c}`" for c in docs.columns if c not in made]
    if model is None:
        return docs.select(
            *plain,
            *(F.lit(None).cast("double").alias(c) for c in made[:3]),
            F.lit(True).alias(made[3]),
        )
    # Plain tuples, which a task can read without this package.
    shared = docs.sparkSession.sparkContext.broadcast(
        tuple(tuple(x) if isinstance(x, Scale) else x for x in model)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_weights, meta_weights, text_scale, meta_scale, prior = shared.value
        shapes = ShortShapes()

        def odds(view: tuple, weights: np.ndarray, scale: tuple) -> float:
            margin = float(view[1] @ weights[view[0]]) + float(weights[-1])
            return scale[0] * margin + scale[1]

        for rows in batches:
            columns = [c.to_pylist() for c in rows.columns[-4:]]
            text = np.array(
                [
                    odds(text_view(x, shapes), text_weights, text_scale)
                    for x in columns[0]
                ]
            )
            meta = np.array(
                [
                    odds(meta_view(*x), meta_weights, meta_scale)
                    for x in zip(*columns[1:])
                ]
            )
            both = logistic(text + meta - prior)
            yield pa.RecordBatch.from_arrays(
                [
                    *rows.columns[:-4],
                    pa.array(logistic(text), pa.float64()),
                    pa.array(logistic(meta), pa.float64()),
                    pa.array(both, pa.float64()),
                    pa.array(both >= threshold, pa.bool_()),
                ],
                names=[*rows.schema.names[:-4], *made],
            )

    kept = docs.select(*plain)
    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema
    )
    return docs.select(
        *plain,
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("_text"),
        *_meta(docs),
    ).mapInArrow(
        run,
        f"{schema}, `{made[0]}` double, `{made[1]}` double,"
        f" `{made[2]}` double, `{made[3]}` boolean",
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that a classifier trained on ``labels`` keeps."""
    return (
        score(docs, train(docs, labels), prefix="_")
        .where("_kept")
        .select(*(F.col(f"`{c}`") for c in docs.columns))
    )
