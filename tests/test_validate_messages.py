import json
from urllib.parse import urlencode

import pytest
from pyspark.sql import functions as F

from opsframe.functions import form_field, form_quote, strip
from opsframe.operators import (
    check_page_size,
    contact_rules,
    content_rules,
    content_types_map,
    message_requests,
    person_batch_rules,
    person_rules,
    sparse_record,
    tag_rows,
    validate_rows,
)


def reasons(df, rules):
    return {r.id: r.reasons for r in tag_rows(df, rules).collect()}


def from_json(spark, values, schema):
    rows = [(i, json.dumps(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id int, text string")
    return df.select("id", F.from_json("text", schema).alias("r")).select(
        "id", "r.*"
    )


def test_contacts(spark):
    ok = [{"property": "p", "value": "v"}]
    values = [
        {"vid": "1", "properties": ok},
        {"email": "e", "properties": []},
        {"vid": "", "email": "", "properties": ok},
        {"email": "e"},
        {"email": "e", "properties": [{"value": "v"}, {"property": "p"}]},
    ]
    df = from_json(
        spark,
        values,
        "vid string, email string,"
        " properties array<struct<property:string,value:string>>",
    )
    assert reasons(df, contact_rules(df)) == {
        0: [],
        1: [],
        2: ["email or vid is required"],
        3: ["properties is required"],
        4: ["property is required", "value is required"],
    }
    valid, rejected = validate_rows(df, contact_rules(df))
    assert valid.count() == 2 and rejected.count() == 3
    with pytest.raises(Exception, match="invalid row: .* is required"):
        validate_rows(df, contact_rules(df), mode="raise").collect()


def test_property_value_types(spark):
    df = spark.sql(
        """
        SELECT id, 'v' AS vid, 'e' AS email, array(named_struct(
                 'property', 'p', 'value', parse_json(j))) AS properties
        FROM VALUES (0, '"x"'), (1, 'true'), (2, '7'), (3, '1.5'),
                    (4, '[1]') AS t(id, j)
        """
    )
    broken = {i for i, r in reasons(df, contact_rules(df)).items() if r}
    assert broken == {3, 4}


def test_persons(spark):
    values = [
        {"names": [{"givenName": "A"}]},
        {"names": []},
        {"phoneNumbers": [{"value": "1"}]},
        {"names": [{"givenName": "A"}, {}], "phoneNumbers": [{"value": "1"}, {}]},
        {"names": [{}], "phoneNumbers": [{}]},
    ]
    df = from_json(
        spark,
        values,
        "names array<struct<givenName:string>>,"
        " phoneNumbers array<struct<value:string>>",
    )
    both = ["names.givenName is required", "phoneNumbers.value is required"]
    expected = {0: [], 1: [], 2: ["names is required"], 3: [], 4: both}
    assert reasons(df, person_rules()) == expected
    assert reasons(df, person_rules(every=True)) == {**expected, 3: both}


def test_person_batches(spark):
    values = [
        {"contacts": [{"contactPerson": {"names": [{"givenName": "A"}]}}]},
        {},
        {"contacts": [{}]},
        {"contacts": [{"contactPerson": {}}]},
        {"contacts": [{"contactPerson": {"names": [{}]}}]},
        {"contacts": []},
    ]
    df = from_json(
        spark,
        values,
        "contacts array<struct<contactPerson:"
        "struct<names:array<struct<givenName:string>>>>>",
    )
    got = reasons(df, person_batch_rules())
    assert got == {
        0: [],
        1: ["contacts is required"],
        2: ["contactPerson is required"],
        3: ["contactPerson.names is required"],
        4: ["names.givenName is required"],
        5: [],
    }


CONTENT = (
    "category string, body string, actions array<map<string,string>>,"
    " items array<map<string,string>>, button string"
)


def test_content(spark):
    one = [{"id": "1"}]
    values = [
        {"category": "text", "body": "b"},
        {"category": "poll", "body": "b"},
        {"body": "b"},
        {"category": "card"},
        {"category": "list-picker", "body": "b", "items": one, "button": "x"},
        {"category": "list-picker", "body": "b", "items": [], "button": ""},
        {"category": "quick-reply", "body": "b", "actions": one},
        {"category": "call-to-action", "body": "b", "actions": []},
    ]
    got = reasons(from_json(spark, values, CONTENT), content_rules())
    assert got == {
        0: [],
        1: ["unknown category"],
        2: ["unknown category"],
        3: ["body is required"],
        4: [],
        5: ["list-picker needs items", "list-picker needs button"],
        6: [],
        7: ["reply needs actions"],
    }


def test_page_size():
    assert check_page_size(100) == 100
    with pytest.raises(ValueError):
        check_page_size(101)


def test_content_types(spark):
    one = [{"id": "1", "title": "t"}]
    values = [
        {"category": "text", "body": "old", "actions": one},
        {"category": "text", "body": 'new "x"'},
        {"category": "quick-reply", "body": "q", "actions": one},
        {"category": "list-picker", "body": "l", "items": one, "button": "b"},
    ]
    df = from_json(spark, values, CONTENT).withColumn("request", F.lit("r"))
    row = content_types_map(df, "request", "id").first()
    assert json.loads(row.types) == {
        "twilio/text": {"body": 'new "x"'},
        "twilio/quick-reply": {"body": "q", "actions": one},
        "twilio/list-picker": {"body": "l", "items": one, "button": "b"},
    }
    bad = df.withColumn("category", F.lit("poll"))
    with pytest.raises(Exception, match="unknown category: poll"):
        content_types_map(bad, "request", "id").collect()


TEXTS = ["a b", "*~-._", "é 漢/?&=#%+", "", "line\nbreak", "'\"()!"]


def test_requests_are_encoded_as_python_does(spark):
    rows = [(f"+{i}", "MG", t, "HX", {"1": t}) for i, t in enumerate(TEXTS)]
    rows.append(("+9", "MG", None, None, {}))
    df = spark.createDataFrame(
        rows,
        "recipient_phone string, messaging_service_sid string, body string,"
        " content_sid string, content_variables map<string,string>",
    )
    got = {r.To: r for r in message_requests(df).collect()}
    for i, text in enumerate(TEXTS):
        wanted = {
            "To": f"+{i}",
            "From": "MG",
            "Body": text,
            "ContentSid": "HX",
            "ContentVariables": json.dumps(
                {"1": text}, separators=(",", ":"), ensure_ascii=False
            ),
        }
        assert got[f"+{i}"].form == urlencode(wanted)
    assert got["+9"].form == "To=%2B9&From=MG&Body=&ContentSid="
    assert got["+9"].ContentVariables is None


def test_quoting_and_stripping(spark):
    df = spark.createDataFrame([(chr(i) + "x" + chr(i),) for i in range(1, 0x3100)], "s string")
    for row in df.select("s", strip("s").alias("t")).collect():
        assert row.t == row.s.strip()
    row = spark.range(1).select(form_quote(F.lit("~*")).alias("q")).first()
    assert row.q == "~%2A"


def test_form_fields():
    assert form_field("sid") == "Sid"
    assert form_field("use_inbound_webhook_on_number") == (
        "UseInboundWebhookOnNumber"
    )


def test_sparse_records(spark):
    df = spark.createDataFrame(
        [
            ("s1", "n", False, 0),
            ("s2", "", True, 5),
            ("s3", None, False, None),
        ],
        "sid string, friendly_name string, sticky_sender boolean,"
        " validity_period int",
    )
    kept, rejected = sparse_record(df, "sid", mode="split")
    assert {r.sid: json.loads(r.record) for r in kept.collect()} == {
        "s1": {"Sid": "s1", "FriendlyName": "n"},
        "s2": {"Sid": "s2", "StickySender": True, "ValidityPeriod": 5},
    }
    assert [r.sid for r in rejected.collect()] == ["s3"]
    with pytest.raises(Exception, match="one of these values is required"):
        sparse_record(df, "sid").collect()
    row = sparse_record(df, "sid", drop="null").filter("sid = 's3'").first()
    assert json.loads(row.record) == {"Sid": "s3", "StickySender": False}
