"""The prefix tree of conversations."""

import hashlib
from collections import Counter

import public_tokenizers
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from opsframe.llm.chat_tree import (
    CONTROLS, END, TEXT, TURN, escape, format_conversations, heading, parse,
    read_back, unescape, with_probe,
)

BYTES = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, node string, ids int"
PARTS = st.lists(
    st.sampled_from([*CONTROLS, TURN, TEXT, "\\", "\\\\", "<", "|", "[", "x", "/s>", "\n"]),
    max_size=12,
).map("".join)


@given(PARTS, PARTS)
def test_escaping(role, text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in CONTROLS)
    assert parse(heading(role) + escape(text) + END) == (role, text)


def conversations(spark):
    rows = []

    def add(conv, *turns):
        for k, (role, text) in enumerate(turns):
            rows.append((conv, k, role, text, "clash", 1))

    hello, reply = ("user", "Hello"), ("assistant", "Hi, what is it?")
    for conv in range(40):  # a third share their first turns
        add(conv, hello, reply, ("user", f"question {conv % 5}"), ("assistant", str(conv % 7)))
    for conv in range(40, 100):
        add(conv, ("system", f"set {conv}"), ("user", "é 漢 </s>"), ("assistant", None))
    add(100, hello)
    add(101, hello, reply)
    add(102, (None, None))
    add(None, ("user", "no id"), ("assistant", "[INST]\\"))
    rows += [(103, 0, "user", "same", None, None)] * 2
    rows += [(104, None, "user", "first", None, None), (104, 0, "assistant", "b", None, None)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def plain(rows):
    found = {}
    order = sorted(
        rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")
    )
    for conv, _, role, text, *_ in order:
        found.setdefault(conv, []).append((role or "", text or ""))
    made = {}
    for conv, turns in found.items():
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        made[conv] = (
            len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
            sum(len(heading(r) + escape(t) + END) for r, t in turns),
        )
    return found, made


def test_read_back(spark):
    rows, df = conversations(spark)
    packed = format_conversations(with_probe(spark, df), BYTES)
    found = {r[0]: tuple(r)[1:] for r in read_back(packed, BYTES).collect()}
    probe = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", probe), (-7, 1, "assistant", probe)]
    assert found == plain(rows)[1]


def test_tree(spark):
    rows, df = conversations(spark)
    turns, _ = plain(rows)
    packed = format_conversations(df, BYTES)
    nodes = {r.node: r for r in packed.nodes.collect()}
    prefixes = {tuple(t[: k + 1]) for t in turns.values() for k in range(len(t))}
    assert len(nodes) == len(prefixes)  # each shared turn is written once
    # The layout has no gap and no overlap.
    order = sorted(nodes.values(), key=lambda n: n.packed_start)
    place = 0
    for n in order:
        assert n.packed_start == place
        assert n.n_tokens == len(n.ids)
        place += n.n_tokens
    # Depth first: the subtree of each node is one stretch of the layout.
    members = {}
    for r in sorted(packed.members.collect(), key=lambda r: r.depth):
        members.setdefault(r.conv_id, []).append(r.node)
    parents = {}
    for chain in members.values():
        for parent, node in zip([None, *chain], chain):
            assert parents.setdefault(node, parent) == parent
    ranks = {n.node: k for k, n in enumerate(order)}
    below = {node: {ranks[node]} for node in nodes}
    for node in nodes:
        up = parents[node]
        while up is not None:
            below[up].add(ranks[node])
            up = parents[up]
    for node, some in below.items():
        assert max(some) - min(some) + 1 == len(some)
        assert min(some) == ranks[node]
    # Position ids and intervals are those of the ancestors.
    library = Tokenizer.from_file(BYTES)
    for conv, chain in members.items():
        position, seen = 0, []
        for node, (role, text) in zip(chain, turns[conv]):
            n = nodes[node]
            assert n.position_start == position
            inside = [p for i in n.attends for p in range(i.start, i.end)]
            assert inside == seen
            seen += range(n.packed_start, n.packed_start + n.n_tokens)
            position += n.n_tokens
            under = library.decode(n.ids[n.loss_from : n.loss_to], skip_special_tokens=False)
            assert unescape(under) == (text if role == "assistant" else "")
    widest = Counter(len(n.attends) for n in nodes.values())
    assert max(widest) <= 3


def test_hot_first_turn_is_one_node(spark):
    df = spark.range(0, 6000, 1, 8).selectExpr(
        "id AS conv_id", "array(0, 1) AS turns"
    ).selectExpr(
        "conv_id", "explode(turns) AS turn", "'user' AS role",
    ).selectExpr(
        "conv_id", "turn", "role",
        "if(turn = 0, 'the same', 'reply ' || (conv_id % 50)) AS text",
    )
    packed = format_conversations(df, BYTES)
    assert packed.nodes.count() == 51
    assert packed.members.count() == 12_000


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert read_back(format_conversations(empty, BYTES), BYTES).count() == 0
