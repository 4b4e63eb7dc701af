"""Chat formatting with a prefix tree of conversations.

Conversations that begin with the same turns share the nodes of those turns. A
node is one turn behind one history and is known by a digest of both, so the
tree is built by equality of digests and no tree, however large, is gathered in
a task. Nodes are laid out depth first: the digests at the branches above a
node, put one behind the other, sort that way, and a range sort over them deals
the layout over all tasks. Long stretches without a branch share one path.

Each node's tokens are written once, with

* ``packed_start``: the place of its first token in the layout,
* ``position_start``: the position id of its first token, which is the number
  of tokens of its ancestors; the others count on from there,
* ``attends``: intervals [start, end) of the layout with the tokens of its
  ancestors; a token sees these and the tokens before it in its own node,
* ``loss_from`` and ``loss_to``: its tokens under the loss mask, those of the
  text of an assistant turn.

A turn is written as ``<|turn|>role<|text|>text</s>``. Control strings inside a
role or text are broken by a backslash behind their first character, and a
backslash is doubled, so texts come back unchanged and never hold a mark.

Defined results: a null role or text is empty; rows of one conversation are
ordered by turn, then role, then text, nulls first, and repeated rows are
repeated turns; a null id is one conversation; an empty table has no nodes;
other columns are not read. The turns of one conversation pass through one task
in order, one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opsframe.llm.common import stored
from opsframe.llm.kept import per_worker
from opsframe.llm.token_file import Encoder

TURN, TEXT, END = "<|turn|>", "<|text|>", "</s>"
# What must not occur inside a text: a mark as this template or other common
# ones write it.
CONTROLS = ("<|", "</s>", "<s>", "[INST]", "[/INST]")
ROOT = b""


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for control in CONTROLS:
        text = text.replace(control, f"{control[0]}\\{control[1:]}")
    return text


def unescape(text: str) -> str:
    head, *rest = text.split("\\\\")
    # Between doubled backslashes every single one is an inserted one.
    return "\\".join(x.replace("\\", "") for x in (head, *rest))


def heading(role: str) -> str:
    return f"{TURN}{escape(role)}{TEXT}"


def parse(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, text = formatted.removeprefix(TURN).split(TEXT)
    return unescape(role), unescape(text.removesuffix(END))


def node_digest(parent: bytes, role: str, text: str) -> bytes:
    name = role.encode()
    made = hashlib.blake2b(parent, digest_size=16)
    made.update(len(name).to_bytes(8, "little") + name + text.encode())
    return made.digest()


def by_conversation(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def streamed(rows: DataFrame, begin, step, schema: str) -> DataFrame:
    """Rows of sorted conversations one by one: ``begin()`` makes the state of
    a conversation, ``step(state, row)`` the columns put behind its id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = object(), None
        for rows in batches:
            found = []
            for conv, *row in zip(*(c.to_pylist() for c in rows.columns)):
                if conv != last:
                    last, state = conv, begin()
                found.append(step(state, row))
            names = [x.split()[0] for x in schema.split(", ")]
            columns = list(zip(*found)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    *(
                        pa.array(c, TYPES[x.split()[1]])
                        for c, x in zip(columns, schema.split(", "))
                    ),
                ],
                names=["conv_id", *names],
            )

    key = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv_id {key}, {schema}")


TYPES = {
    "int": pa.int32(),
    "long": pa.int64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
}


def turns_of(conversations: DataFrame) -> DataFrame:
    """Each turn with its depth, its node and the node before it."""

    def step(state: dict, row: list) -> tuple:
        _, role, text = row
        parent = state["node"]
        state["node"] = node = node_digest(parent, role, text)
        state["depth"] += 1
        return state["depth"], node, parent, role, text

    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return streamed(
        by_conversation(rows, "turn", "role", "text"),
        lambda: {"node": ROOT, "depth": -1},
        step,
        "depth int, node binary, parent binary, role string, text string",
    )


def with_paths(turns: DataFrame) -> DataFrame:
    """Each node once, with the path of branches that leads to it."""
    nodes = turns.select("node", "parent").distinct()
    forks = (
        nodes.groupBy("parent")
        .agg(F.count("*").alias("children"))
        .where((F.col("children") > 1) | (F.length("parent") == 0))
        .select(F.col("parent").alias("fork"))
    )
    branches = nodes.join(
        forks, nodes["parent"] == forks["fork"], "left_semi"
    ).select("node", F.lit(True).alias("branch"))
    marked = (
        turns.select("conv_id", "depth", "node")
        .join(branches, "node", "left")
        .select("conv_id", "depth", "node", "branch")
    )

    def step(state: dict, row: list) -> tuple:
        depth, node, branch = row
        if branch:
            state["path"] += node
        return depth, node, state["path"]

    return (
        streamed(
            by_conversation(marked, "depth"),
            lambda: {"path": b""},
            step,
            "depth int, node binary, path binary",
        )
        .select("node", "path", "depth")
        .distinct()
    )


def laid_out(turns: DataFrame, tokenizer_path: str) -> DataFrame:
    """Nodes in depth-first order with their tokens, numbered per task."""
    paths = with_paths(turns)
    texts = turns.select("node", "role", "text").distinct()
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker("byte encoder", tokenizer_path, make=Encoder)
        part, first = TaskContext.get().partitionId(), 0
        end = encoder.encode(pa.array([END]))[0].tolist()
        for rows in batches:
            roles = rows.column(3).to_pylist()
            heads, head_at = encoder.encode(
                pa.array(map(heading, roles), pa.string())
            )
            bodies, body_at = encoder.encode(
                pa.array(map(escape, rows.column(4).to_pylist()), pa.string())
            )
            ids, firsts, froms, tos = [], [], [], []
            for k, role in enumerate(roles):
                head = heads[head_at[k] : head_at[k + 1]].tolist()
                body = bodies[body_at[k] : body_at[k + 1]].tolist()
                ids.append(head + body + end)
                firsts.append(first)
                first += len(ids[-1])
                froms.append(len(head))
                tos.append(len(head) + len(body) * (role == "assistant"))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(ids), pa.int32()),
                    *(rows.column(k) for k in (0, 2)),
                    pa.array(firsts, pa.int64()),
                    pa.array(map(len, ids), pa.int32()),
                    pa.array(froms, pa.int32()),
                    pa.array(tos, pa.int32()),
                    pa.array(ids, pa.list_(pa.int32())),
                ],
                names=[
                    "part", "node", "depth", "first", "n_tokens",
                    "loss_from", "loss_to", "ids",
                ],
            )

    return (
        paths.join(texts, "node")
        .select("node", "path", "depth", "role", "text")
        .repartitionByRange(parts, "path", "depth")
        .sortWithinPartitions("path", "depth")
        .mapInArrow(
            run,
            "part int, node binary, depth int, first long, n_tokens int,"
            " loss_from int, loss_to int, ids array<int>",
        )
    )


def with_places(nodes: DataFrame) -> DataFrame:
    """``packed_start`` of each node; only one count per task meets others."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        nodes.groupBy("part")
        .agg(F.sum("n_tokens").alias("n"))
        .select(
            "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
        )
    )
    return nodes.join(F.broadcast(bases), "part").withColumn(
        "packed_start", F.col("base") + F.col("first")
    )


def with_attention(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``position_start`` and ``attends`` of each node."""

    def step(state: dict, row: list) -> tuple:
        _, node, start, size = row
        position, edges = state["position"], list(state["edges"])
        state["position"] += size
        if edges and edges[-1] == start:
            state["edges"][-1] = start + size
        else:
            state["edges"] += (start, start + size)
        return node, position, edges

    walked = streamed(
        by_conversation(
            turns.select("conv_id", "depth", "node")
            .join(nodes.select("node", "packed_start", "n_tokens"), "node")
            .select("conv_id", "depth", "node", "packed_start", "n_tokens"),
            "depth",
        ),
        lambda: {"position": 0, "edges": []},
        step,
        "node binary, position_start long, edges array<long>",
    )
    seen = walked.select("node", "position_start", "edges").distinct()
    interval = lambda i: F.struct(
        F.col("edges")[2 * i].alias("start"),
        F.col("edges")[2 * i + 1].alias("end"),
    )
    attends = F.when(
        F.size("edges") > 0,
        F.transform(
            F.sequence(F.lit(0), (F.size("edges") / 2).cast("int") - 1),
            interval,
        ),
    ).otherwise(F.array().cast("array<struct<start: long, end: long>>"))
    return nodes.join(seen, "node").select(
        "node", "depth", "packed_start", "position_start", "n_tokens",
        "loss_from", "loss_to", "ids", attends.alias("attends"),
    )


class Packed(NamedTuple):
    """The output: the nodes of the tree, and the nodes of each conversation
    as ``conv_id``, ``depth``, ``node``."""

    nodes: DataFrame
    members: DataFrame


def format_conversations(
    conversations: DataFrame, tokenizer_path: str
) -> Packed:
    """Write the tree of all conversations to the shared folder."""
    turns = stored(turns_of(conversations), "turns")
    nodes = with_places(stored(laid_out(turns, tokenizer_path), "layout"))
    return Packed(
        stored(with_attention(nodes, turns), "chat-nodes"),
        stored(turns.select("conv_id", "depth", "node"), "chat-members"),
    )


class Decoder:
    def __init__(self, tokenizer_path: str):
        self.tokenizer = Encoder(tokenizer_path).tokenizer

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


READ = (
    "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long"
)


def read_back(packed: Packed, tokenizer_path: str) -> DataFrame:
    """Digests of each conversation, from the tokens of its nodes."""
    rows = by_conversation(
        packed.members.join(
            packed.nodes.select("node", "ids", "loss_from", "loss_to"), "node"
        ).select("conv_id", "depth", "ids", "loss_from", "loss_to"),
        "depth",
    )
    key = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = per_worker("byte decoder", tokenizer_path, make=Decoder)
        last, state, done = object(), None, []

        def flush(kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*done)) or [[]] * 6
            made = pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], kind),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.string()),
                    pa.array(columns[3], pa.int64()),
                    pa.array(columns[4], pa.string()),
                    pa.array(columns[5], pa.int64()),
                ],
                names=["conv_id", *(x.split()[0] for x in READ.split(", "))],
            )
            done.clear()
            return made

        def close() -> None:
            n, turns, chars, loss, formatted = state
            done.append(
                (last, n, turns.hexdigest(), chars, loss.hexdigest(), formatted)
            )

        kind = None
        for rows in batches:
            kind = rows.schema.field(0).type
            ids, froms, tos = (rows.column(k).to_pylist() for k in (2, 3, 4))
            whole = decoder.decode(ids)
            under = decoder.decode(
                [x[a:b] for x, a, b in zip(ids, froms, tos)]
            )
            convs = rows.column(0).to_pylist()
            for conv, formatted, loss in zip(convs, whole, under):
                if conv != last:
                    if state:
                        close()
                    last = conv
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(formatted)
                loss = unescape(loss)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(formatted)
            yield flush(kind)
        if state:
            close()
            yield flush(kind)

    return rows.mapInArrow(run, f"conv_id {key}, {READ}")


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The conversations and one whose texts are made of control strings."""
    text = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)],
        "conv_id long, turn long, role string, text string",
    )
    return conversations.select("conv_id", "turn", "role", "text").union(probe)
