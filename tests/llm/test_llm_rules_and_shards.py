"""Quality rules and sharding against plain versions."""

import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import LONG, none, odd, odd_rows, rows_of
from opsframe.llm import quality_rules as rules
from opsframe.llm.quality_rules import (
    RULES, Measure, Page, Rule, ordered, quality_rules, repeated_words,
)
from opsframe.llm.sharding import shard_rows
from pyspark.sql import functions as F

SPACE = "[\x20\x09-\x0d]"


def plain_repeats(words, width=8):
    grams = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    seen = Counter(grams)
    return len(
        {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(width)}
    )


@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60))
@settings(max_examples=200, deadline=None)
def test_repeated_words(words):
    assert repeated_words(words) == plain_repeats(words)


def test_counts_of_odd_rows(spark):
    found = rows_of(quality_rules(odd(spark)))
    wanted = Counter()
    for doc_id, text, *_ in odd_rows():
        text = text or ""
        words = [w for w in re.split(SPACE, text) if w]
        lines = [x for x in text.split("\n") if re.sub(SPACE, "", x)]
        wanted[
            doc_id, len(words), sum(map(len, words)),
            len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            plain_repeats(words),
        ] += 1
    assert Counter(
        (r["doc_id"], *(r[c] for c in rules.COUNTS)) for r in found
    ) == wanted
    for r in found:
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed
        assert not (failed and r["kept"])


def test_verdict_does_not_depend_on_the_order(spark):
    texts = [
        "plain words of a page that says something in a good many words and"
        " goes on for a while so that it is long enough",
        "WORDS!! " * 30, "word ### " * 30, LONG,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    verdicts = [
        sorted(map(tuple, quality_rules(docs, order).collect()))
        for order in (RULES, RULES[::-1])
    ]
    assert verdicts[0] == verdicts[1]
    assert [v[-1] for v in verdicts[0]] == [True, False, False, False]


def test_order_is_by_rejections_per_cost():
    made = [Rule(n, lambda p: False) for n in ("slow", "never", "fast", "new")]
    order = ordered(
        made,
        [Measure("slow", 1.0, 50), Measure("never", 0.1, 0), Measure("fast", 0.1, 10)],
    )
    assert [r.name for r in order] == ["fast", "slow", "never", "new"]


def test_cascade_stops_at_the_first_rejection():
    asked = []

    def rule(name, verdict):
        return Rule(name, lambda p: asked.append(name) or verdict)

    chain = [rule("a", False), rule("b", True), rule("c", False)]
    assert any(r.rejects(Page(b"x")) for r in chain)
    assert asked == ["a", "b"]


def test_empty_tables(spark):
    assert quality_rules(none(spark)).count() == 0
    assert shard_rows(none(spark), 4).count() == 0


def plain_jump(spark, doc_id, shards):
    """The textbook loop, with the draws of the operator."""
    last, at = -1, 0
    while at < shards:
        last = at
        draw = spark.range(1).select(
            F.shiftrightunsigned(
                F.xxhash64(F.lit(doc_id).cast("long"), F.lit(at).cast("long")), 33
            )
        ).first()[0]
        at = int((at + 1) * (1 << 31) / (draw + 1))
    return last


def test_shards(spark):
    docs = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("é"), F.col("id").cast("int") % 7)
        .alias("text"),
    )
    found = rows_of(shard_rows(docs, 40, parts=16))
    assert len(found) == 5000
    by_shard = {}
    for r in found:
        text = "é" * (r["doc_id"] % 7)
        assert r["size"] == 16 + len(text.encode())
        assert r["text_crc32"] == zlib.crc32(text.encode())
        assert r["grown_shard"] in (r["shard"], 40)
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert set(by_shard) == set(range(40))
    for slots in by_shard.values():
        assert sorted(slots) == list(range(len(slots)))
        assert 80 < len(slots) < 180
    moved = sum(r["grown_shard"] == 40 for r in found)
    assert 80 < moved < 180
    for r in found[:3]:
        assert r["shard"] == plain_jump(spark, r["doc_id"], 40)


def test_copies_of_one_row_have_slots_of_their_own(spark):
    docs = spark.range(0, 4000, 1, 8).select(
        F.lit(3).cast("long").alias("doc_id"), F.lit("same").alias("text")
    )
    found = shard_rows(docs, 40)
    assert sorted(r.slot for r in found.collect()) == list(range(4000))


def test_shards_of_odd_rows(spark):
    found = rows_of(shard_rows(odd(spark), 3))
    assert len(found) == len(odd_rows())
    assert len({r["shard"] for r in found if r["doc_id"] is None}) == 1
    for shard in {r["shard"] for r in found}:
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))
