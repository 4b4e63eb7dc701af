import base64
import json

import pytest
from pyspark.sql import functions as F

from opsframe.plans.streams import _files
from opsframe.streaming import (
    decode_trigger_stream,
    decode_triggers,
    encode_triggers,
    envelope,
    job_status,
    job_status_stream,
    log_batches,
    publish,
    publish_stream,
    split_triggers,
)

CONTEXT = "job string, n int"


@pytest.fixture()
def triggers(spark, tmp_path):
    path = str(tmp_path / "triggers")
    for part in range(3):
        encode_triggers(
            spark.createDataFrame(
                [(10 * part + i, f"j{i}", i) for i in range(4)],
                "message_id bigint, job string, n int",
            ),
            ["job", "n"],
            keep=["message_id"],
        ).coalesce(1).write.mode("append").parquet(path)
    return path


def statuses(spark, path):
    df = spark.read.parquet(path).select(
        "batch_id",
        F.col("attributes")["result"].alias("result"),
        F.col("attributes")["service"].alias("service"),
        F.decode("data", "UTF-8").alias("data"),
        "topic",
    )
    return df.collect()


def test_decoding_a_batch(spark, triggers):
    df = decode_triggers(spark.read.parquet(triggers), CONTEXT)
    assert sorted(r.context.n for r in df.collect()) == sorted([0, 1, 2, 3] * 3)


def test_publishing_a_stream_once(spark, triggers, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        contexts = decode_trigger_stream(
            spark, triggers, CONTEXT, files_per_batch=1
        )
        messages = envelope(
            contexts,
            F.to_json("context"),
            "p",
            "t",
            {"id": F.col("message_id"), "kind": "job"},
        )
        publish_stream(messages, out, checkpoint).awaitTermination()

    run()
    run()
    got = spark.read.parquet(out).collect()
    assert len(got) == 12
    assert {r.topic for r in got} == {"projects/p/topics/t"}
    assert {r.attributes["kind"] for r in got} == {"job"}
    assert len({r.attributes["id"] for r in got}) == 12
    assert json.loads(bytes(got[0].data).decode())["job"].startswith("j")


def test_publishing_a_batch(spark, tmp_path):
    df = spark.createDataFrame([("é",)], "data string")
    path = str(tmp_path / "topic")
    for _ in range(2):
        publish(envelope(df, "data", "p", "t", {}), path)
    got = spark.read.parquet(path).collect()
    assert [bytes(r.data).decode() for r in got] == ["é", "é"]
    assert got[0].attributes == {}


def start(spark, triggers, work, tmp_path):
    contexts = decode_trigger_stream(spark, triggers, CONTEXT, files_per_batch=1)
    return job_status_stream(
        contexts,
        work,
        str(tmp_path / "status"),
        str(tmp_path / "cp"),
        "p",
        "s",
        "svc",
    )


def test_status_of_good_batches(spark, triggers, tmp_path):
    seen = []
    start(
        spark, triggers, lambda batch, _: seen.append(batch.count()), tmp_path
    ).awaitTermination()
    assert seen == [4, 4, 4]
    got = statuses(spark, str(tmp_path / "status"))
    results = [r.result for r in got]
    assert results.count("ran") == results.count("succeeded") == 12
    assert {r.service for r in got} == {"svc"}
    assert {r.topic for r in got} == {"projects/p/topics/s"}
    assert {r.batch_id for r in got} == {0, 1, 2}
    assert json.loads(got[0].data)["job"].startswith("j")


def test_contexts_are_read_for_ran_and_work_only(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(n):
        reads.add(1)
        return str(n)

    rows = spark.range(6).select(F.struct(F.udf(seen)("id").alias("job")).alias("context"))
    status = str(tmp_path / "status")
    log_batches(lambda batch, _: None, status, "p", "s", "svc")(rows, 0)
    assert reads.value == 6
    got = statuses(spark, status)
    assert len(got) == 12
    for result in ("ran", "succeeded"):
        assert {json.loads(r.data)["job"] for r in got if r.result == result} == set("012345")


def test_trigger_files_grow_with_the_rows():
    # The files were four for any number of rows.
    assert [_files(n) for n in (0, 1, 800_000)] == [4, 4, 4]
    assert _files(800_001) == 8 and _files(36_000_000) == 180


def test_failed_batch_is_reported_raised_and_run_again(spark, triggers, tmp_path):
    def fail_second(batch, batch_id):
        if batch_id == 1:
            raise RuntimeError("no luck")

    with pytest.raises(Exception, match="no luck"):
        start(spark, triggers, fail_second, tmp_path).awaitTermination()

    def results():
        got = statuses(spark, str(tmp_path / "status"))
        return sorted({(r.batch_id, r.result) for r in got}), len(got)

    assert results() == (
        [(0, "ran"), (0, "succeeded"), (1, "failed"), (1, "ran")],
        16,
    )
    start(spark, triggers, lambda *_: None, tmp_path).awaitTermination()
    found, number = results()
    assert (1, "succeeded") in found and (2, "succeeded") in found
    # The repeated batch overwrote its first "ran" messages.
    assert number == 28


def test_unknown_result(spark):
    with pytest.raises(ValueError):
        job_status(spark.range(1), "id", "done", "p", "t", {})


def test_malformed_messages_are_set_apart(spark):
    def coded(text):
        return base64.b64encode(text).decode()

    rows = [
        (1, coded(b'{"job":"a","n":1}')),
        (2, "%% no base64"),
        (3, coded(b"\xff\xfe")),
        (4, coded(b'{"job":"a"')),
        (5, coded(b"5")),
        (6, coded(b'{"job":"a","n":"many"}')),
        (7, None),
        (8, coded(b'{"job":"b"}')),
    ]
    df = spark.createDataFrame(rows, "message_id int, data string")
    good, rejected = split_triggers(df, CONTEXT)
    assert {r.message_id: tuple(r.context) for r in good.collect()} == {
        1: ("a", 1),
        8: ("b", None),
    }
    assert sorted(map(tuple, rejected.collect())) == [
        r for r in rows if r[0] not in (1, 8)
    ]
