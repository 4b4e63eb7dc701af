"""Queries over survey forms. Parts stand in for forms with their questions,
orders for responses with their answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.operators import (
    answers_wide,
    survey_answers,
    survey_answers_titled,
    survey_questions,
    survey_responses,
    survey_responses_titled,
    survey_responses_wide,
)
from opsframe.operators.survey import QUESTION_ITEMS
from opsframe.plans.registry import query, table


@query(
    "survey_questions",
    """
    SELECT p_partkey, trim(p_name) AS question_title,
           'q' || p_partkey AS question_id, 'none' AS sub_question
    FROM part
    UNION ALL
    SELECT p_partkey, p_type, 'g' || p_partkey || s, 'size ' || s
    FROM part, (VALUES ('a'), ('b')) t(s) WHERE p_size > 10
    """,
)
def _survey_questions(spark, sf_dir):
    key = F.col("p_partkey").cast("string")

    def text(*parts):
        return F.concat(
            *[F.lit(p) if isinstance(p, str) else p for p in parts]
        )

    grouped = text(
        ',{"title":"',
        F.col("p_type"),
        '","questionGroupItem":{"questions":[{"questionId":"g',
        key,
        'a","rowQuestion":{"title":"size a"}},{"questionId":"g',
        key,
        'b","rowQuestion":{"title":"size b"}}]}}',
    )
    items = text(
        '[{"title":" ',
        F.col("p_name"),
        '\\t","questionItem":{"question":{"questionId":"q',
        key,
        '"}}},{"title":"A picture","imageItem":{}}',
        F.when(F.col("p_size") > 10, grouped).otherwise(""),
        "]",
    )
    forms = table(spark, sf_dir, "part").select(
        "p_partkey", F.from_json(items, QUESTION_ITEMS).alias("items")
    )
    return survey_questions(forms, keys=["p_partkey"])


def _answer(question, value):
    """A map entry of one answer, absent when the value is NULL."""
    entry = F.struct(
        F.lit(question).alias("key"),
        F.struct(
            F.lit(question).alias("questionId"),
            F.create_map(
                F.lit("answers"),
                F.array(
                    F.struct(value.alias("value")),
                    F.struct(F.lit("second").alias("value")),
                ),
            ).alias("textAnswers"),
        ).alias("value"),
    )
    return F.when(value.isNotNull(), entry)


def _responses(spark, sf_dir):
    status = F.col("o_orderstatus")
    answers = F.array(
        _answer("q1", F.when(status != "P", status)),
        _answer("q2", F.col("o_orderpriority")),
        _answer("q3", F.when(F.col("o_totalprice") > 1e5, F.lit("large"))),
    )
    used = [
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        "o_orderdate",
        "o_totalprice",
    ]
    envelope = table(spark, sf_dir, "orders", used).select(
        F.array(
            F.struct(
                F.concat(F.lit("r"), "o_orderkey").alias("responseId"),
                F.col("o_orderdate").cast("string").alias("createTime"),
                F.col("o_orderdate").cast("string").alias("lastSubmittedTime"),
                F.map_from_entries(
                    F.filter(answers, lambda a: a.isNotNull())
                ).alias("answers"),
            )
        ).alias("responses")
    )
    return survey_responses(envelope)


def _answer_sql(question: str, value: str) -> str:
    """The JSON of one entry of the answers map."""
    return f"""CASE WHEN {value} IS NOT NULL THEN
        '"{question}":{{"questionId":"{question}","textAnswers":{{"answers":'
        || '[{{"value":"' || {value} || '"}},{{"value":"second"}}]}}}}' END"""


STATUS_SQL = "CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END"
SIZE_SQL = "CASE WHEN o_totalprice > 100000 THEN 'large' END"


def _wide_sql(names: tuple[str, str, str]) -> str:
    first, second, third = names
    return f"""
        SELECT 'r' || o_orderkey AS "responseId",
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "createTime",
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                 AS "LastSubmittedTime",
               '{{' || concat_ws(',', {_answer_sql("q1", STATUS_SQL)},
                   {_answer_sql("q2", "o_orderpriority")},
                   {_answer_sql("q3", SIZE_SQL)}) || '}}' AS answer,
               {STATUS_SQL} AS "{first}",
               o_orderpriority AS "{second}",
               {SIZE_SQL} AS "{third}"
        FROM orders
    """


@query("survey_responses_wide", _wide_sql(("q1", "q2", "q3")))
def _survey_responses_wide(spark, sf_dir):
    return survey_responses_wide(
        _responses(spark, sf_dir), ["q1", "q2", "q3"]
    )


@query(
    "survey_answers",
    f"""
    SELECT 'r' || o_orderkey AS "responseId", question_id, value
    FROM (SELECT o_orderkey, 'q1' AS question_id, {STATUS_SQL} AS value
          FROM orders
          UNION ALL SELECT o_orderkey, 'q2', o_orderpriority FROM orders
          UNION ALL SELECT o_orderkey, 'q3', {SIZE_SQL} FROM orders)
    WHERE value IS NOT NULL
    """,
)
def _survey_answers(spark, sf_dir):
    return survey_answers(_responses(spark, sf_dir))


@query(
    "survey_responses_titled",
    _wide_sql(("Status", "Handling-priority", "q3")),
)
def _survey_responses_titled(spark, sf_dir):
    questions = spark.sql(
        """
        SELECT * FROM VALUES ('Status', 'q1', 'none'),
            ('Handling', 'q2', 'priority')
            AS t(question_title, question_id, sub_question)
        """
    )
    # q3 is no longer in the form and keeps its id. The ids are given, so no
    # pass over the responses brings them to the driver.
    return survey_responses_titled(
        _responses(spark, sf_dir), questions, ids=["q1", "q2", "q3"]
    )


@query(
    "survey_answers_titled",
    f"""
    SELECT 'r' || o_orderkey AS "responseId", question_id, question, value
    FROM (SELECT o_orderkey, 'q1' AS question_id, 'Status' AS question,
                 {STATUS_SQL} AS value FROM orders
          UNION ALL SELECT o_orderkey, 'q2', 'Handling-priority',
                 o_orderpriority FROM orders
          UNION ALL SELECT o_orderkey, 'q3', 'q3', {SIZE_SQL} FROM orders)
    WHERE value IS NOT NULL
    """,
)
def _survey_answers_titled(spark, sf_dir):
    questions = spark.sql(
        """
        SELECT * FROM VALUES ('Status', 'q1', 'none'),
            ('Handling', 'q2', 'priority')
            AS t(question_title, question_id, sub_question)
        """
    )
    return survey_answers_titled(_responses(spark, sf_dir), questions)


@query(
    "answers_wide",
    """
    SELECT user_id,
           arg_min(value, event_id) FILTER (WHERE event_type = 'click')
             AS click,
           arg_min(value, event_id) FILTER (WHERE event_type = 'error')
             AS error,
           arg_min(value, event_id) FILTER (WHERE event_type = 'purchase')
             AS purchase,
           arg_min(value, event_id) FILTER (WHERE event_type = 'signup')
             AS signup,
           arg_min(value, event_id) FILTER (WHERE event_type = 'view')
             AS view
    FROM events GROUP BY user_id
    """,
)
def _answers_wide(spark, sf_dir):
    return answers_wide(
        table(spark, sf_dir, "events"),
        "user_id",
        "event_type",
        "value",
        "event_id",
        ["click", "error", "purchase", "signup", "view"],
    )
