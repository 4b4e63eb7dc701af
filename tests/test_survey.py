import json

import pytest
from pyspark.sql import functions as F

from opsframe.operators import (
    answers_wide,
    column_names,
    question_ids,
    survey_answers,
    survey_questions,
    survey_responses,
    survey_responses_titled,
    survey_responses_wide,
)
from opsframe.operators.survey import QUESTION_ITEMS, RESPONSES

FORM = [
    {"title": "  Name\n", "questionItem": {"question": {"questionId": "q1"}}},
    {"title": "A picture", "imageItem": {}},
    {
        "title": "Rate ",
        "questionGroupItem": {
            "questions": [
                {"questionId": "q2", "rowQuestion": {"title": "speed"}},
                {"questionId": "q3", "rowQuestion": {"title": "price"}},
            ]
        },
    },
    {"title": "Name", "questionItem": {"question": {"questionId": "q4"}}},
]


def answer(question, *values):
    texts = {"answers": [{"value": v} if v else {} for v in values]}
    return {"questionId": question, "textAnswers": texts}


ANSWERS = [
    {
        "responseId": "r1",
        "createTime": "c1",
        "lastSubmittedTime": "l1",
        "answers": {"q1": answer("q1", "Ann", "Eve"), "q2": answer("q2", "5")},
    },
    {
        "responseId": "r2",
        "createTime": "c2",
        "lastSubmittedTime": "l2",
        "answers": {"q3": answer("q3", "1"), "q1": answer("q1", None)},
    },
    {"responseId": "r3", "createTime": "c3", "lastSubmittedTime": "l3"},
]


def from_text(spark, value, schema, name):
    df = spark.createDataFrame([(json.dumps(value),)], "text string")
    return df.select(F.from_json("text", schema).alias(name))


@pytest.fixture(scope="module")
def questions(spark):
    return survey_questions(from_text(spark, FORM, QUESTION_ITEMS, "items"))


@pytest.fixture(scope="module")
def responses(spark):
    return survey_responses(from_text(spark, ANSWERS, RESPONSES, "responses"))


def test_questions(questions):
    assert [tuple(r) for r in questions.collect()] == [
        ("Name", "q1", "none"),
        ("Rate", "q2", "speed"),
        ("Rate", "q3", "price"),
        ("Name", "q4", "none"),
    ]


def test_wide_aligns_answers_by_question(responses):
    ids = sorted(r.id for r in question_ids(responses).collect())
    assert ids == ["q1", "q2", "q3"]
    wide = survey_responses_wide(responses, ids).orderBy("responseId")
    assert wide.columns[:4] == [
        "responseId",
        "createTime",
        "LastSubmittedTime",
        "answer",
    ]
    rows = [(r.responseId, r.q1, r.q2, r.q3) for r in wide.collect()]
    assert rows == [
        ("r1", "Ann", "5", None),
        ("r2", None, None, "1"),
        ("r3", None, None, None),
    ]
    first = json.loads(wide.first().answer)
    assert first["q1"]["textAnswers"]["answers"][1] == {"value": "Eve"}


def test_titles(responses, questions):
    assert column_names(questions) == {
        "q1": "Name-q1",
        "q2": "Rate-speed",
        "q3": "Rate-price",
        "q4": "Name-q4",
    }
    titled = survey_responses_titled(responses, questions)
    row = titled.filter("responseId = 'r1'").first()
    assert row["Name-q1"] == "Ann" and row["Rate-speed"] == "5"
    assert row["Name-q4"] is None


def test_questions_that_left_the_form_keep_their_answers(responses, questions):
    known = questions.filter("question_id = 'q1'")
    titled = survey_responses_titled(responses, known)
    assert titled.columns[4:] == ["Name", "q2", "q3"]
    assert titled.filter("responseId = 'r1'").first()["q2"] == "5"


def test_long_form_holds_any_number_of_questions(spark, responses):
    assert sorted(map(tuple, survey_answers(responses).collect())) == [
        ("r1", "q1", "Ann"),
        ("r1", "q2", "5"),
        ("r2", "q3", "1"),
    ]
    many = spark.range(10_001).select(
        F.concat(F.lit("r"), "id").alias("responseId"),
        F.expr(
            "map('x', named_struct('questionId', 'q' || id, 'textAnswers',"
            " map('answers', array(named_struct('value', 'v')))))"
        ).alias("answers"),
    )
    assert survey_answers(many).select("question_id").distinct().count() == 10_001
    assert question_ids(many).count() == 10_001


def test_wide_needs_no_shuffle(responses, plan_of):
    wide = survey_responses_wide(responses, ["q1", "q2"])
    assert "Exchange" not in plan_of(wide)


def test_answers_in_rows(spark):
    rows = [("r1", "a", None, 0), ("r1", "a", "x", 1), ("r1", "a", "y", 2)]
    rows += [("r2", "b", "z", 0), ("r2", None, "w", 1)]
    df = spark.createDataFrame(rows, "r string, q string, v string, n int")
    wide = answers_wide(df, "r", "q", "v", "n", ["a", "b"]).orderBy("r")
    assert [tuple(r) for r in wide.collect()] == [
        ("r1", "x", None),
        ("r2", None, "z"),
    ]


def test_names_as_a_table_follow_the_column_rule(spark, responses, questions):
    from opsframe.operators import question_names, survey_answers_titled

    table = {r.question_id: r.name for r in question_names(questions).collect()}
    assert table == column_names(questions)
    clash = spark.createDataFrame(
        [("responseId", "q9", "none")],
        "question_title string, question_id string, sub_question string",
    )
    assert question_names(clash).first().name == "responseId-q9"
    known = questions.filter("question_id = 'q1'")
    got = {
        (r.responseId, r.question_id): r.question
        for r in survey_answers_titled(responses, known).collect()
    }
    assert got[("r1", "q1")] == "Name" and got[("r1", "q2")] == "q2"
