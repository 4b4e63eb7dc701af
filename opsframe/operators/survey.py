"""Survey forms: questions, and responses with one column per question.

A form's response holds all its answers in one row, so the wide table is a
projection without a shuffle. Answers that arrive one per row are pivoted with
a partial aggregate.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.functions.json_text import TIME_FORMATS
from opsframe.functions.lists import explode_once
from opsframe.functions.text import strip

NO_SUB_QUESTION = "none"
RESPONSE_COLUMNS = ["responseId", "createTime", "LastSubmittedTime", "answer"]

QUESTION_ITEMS = T.ArrayType(
    T.StructType()
    .add("title", "string")
    .add(
        "questionItem",
        T.StructType().add(
            "question", T.StructType().add("questionId", "string")
        ),
    )
    .add(
        "questionGroupItem",
        T.StructType().add(
            "questions",
            T.ArrayType(
                T.StructType()
                .add("questionId", "string")
                .add("rowQuestion", T.StructType().add("title", "string"))
            ),
        ),
    )
)

RESPONSES = T.ArrayType(
    T.StructType()
    .add("responseId", "string")
    .add("createTime", "string")
    .add("lastSubmittedTime", "string")
    .add(
        "answers",
        T.MapType(
            T.StringType(),
            T.StructType()
            .add("questionId", "string")
            .add(
                "textAnswers",
                T.MapType(
                    T.StringType(),
                    T.ArrayType(T.StructType().add("value", "string")),
                ),
            ),
        ),
    )
)


def survey_questions(
    forms: DataFrame, items: str = "items", keys: list[str] | None = None
) -> DataFrame:
    """Form items -> ``question_title, question_id, sub_question``.

    A grouped question gives one row per sub-question; items of other types
    give none. ``keys`` are carried along.
    """
    kept = list(keys or [])

    def rows(item: Column) -> Column:
        title = strip(item.getField("title"))

        def row(question_id: Column, sub_question: Column) -> Column:
            return F.struct(
                title.alias("question_title"),
                question_id.alias("question_id"),
                sub_question.alias("sub_question"),
            )

        single = item.getField("questionItem")
        group = item.getField("questionGroupItem")
        alone = F.array(
            row(
                single.getField("question").getField("questionId"),
                F.lit(NO_SUB_QUESTION),
            )
        )
        members = F.transform(
            group.getField("questions"),
            lambda q: row(
                q.getField("questionId"),
                q.getField("rowQuestion").getField("title"),
            ),
        )
        return F.when(single.isNotNull(), alone).when(
            group.isNotNull(), members
        )

    listed = explode_once(forms, items, "_item", kept)
    questions = explode_once(listed, rows(F.col("_item")), "_question", kept)
    return questions.select(*kept, "_question.*")


def survey_responses(
    forms: DataFrame, responses: str = "responses"
) -> DataFrame:
    """Response envelopes -> one row per response."""
    return explode_once(forms, responses, "_response").select("_response.*")


def _first_text(answer: Column, dtype: T.StructType) -> Column:
    """The first answer's value, whatever the name it is filed under."""
    texts = answer.getField("textAnswers")
    held = dtype["textAnswers"].dataType
    if isinstance(held, T.MapType):
        lists = F.map_values(texts)
    else:
        lists = F.array(*[texts.getField(f.name) for f in held.fields])
    firsts = F.transform(
        lists, lambda answers: F.get(answers, F.lit(0)).getField("value")
    )
    return F.get(F.filter(firsts, lambda v: v.isNotNull()), F.lit(0))


def _given(responses: DataFrame, answers: str) -> Column:
    """``array<struct<id, text>>`` of the questions a response answers.

    Map keys must be unique, the ids inside the values need not be: the first
    answer to a question counts.
    """
    dtype = responses.schema[answers].dataType.valueType
    pairs = F.transform(
        F.map_values(answers),
        lambda a: F.struct(
            a.getField("questionId").alias("id"),
            _first_text(a, dtype).alias("text"),
        ),
    )
    return F.filter(pairs, lambda p: p.getField("text").isNotNull())


def question_ids(responses: DataFrame, answers: str = "answers") -> DataFrame:
    """The distinct ids of the questions answered, as a table ``id``."""
    found = explode_once(responses, F.map_values(answers), "_answer").select(
        F.col("_answer.questionId").alias("id")
    )
    return found.filter(F.col("id").isNotNull()).distinct()


def survey_answers(responses: DataFrame, answers: str = "answers") -> DataFrame:
    """The long form: one row ``(responseId, question_id, value)`` per question
    answered. It holds any number of questions, which a table with a column
    for each cannot."""
    given = explode_once(
        responses, _given(responses, answers), "_given", ["responseId"], "_pos"
    )
    return (
        given.select(
            "responseId", "_pos", F.col("_given.id").alias("question_id"),
            F.col("_given.text").alias("value"),
        )
        .groupBy("responseId", "question_id")
        .agg(F.min_by("value", "_pos").alias("value"))
    )


def survey_responses_wide(
    responses: DataFrame, ids: list[str], answers: str = "answers"
) -> DataFrame:
    """One row per response with one column for each question of ``ids``.

    The column holds the first text answer; ``answer`` keeps all answers as
    JSON. Ids that are not known beforehand can be taken from
    ``question_ids``; ``survey_answers`` needs none.
    """
    names = F.transform(_given(responses, answers), lambda p: p.getField("id"))
    texts = F.transform(
        _given(responses, answers), lambda p: p.getField("text")
    )
    prepared = responses.select(
        F.col("responseId"),
        F.col("createTime"),
        F.col("lastSubmittedTime").alias("LastSubmittedTime"),
        F.to_json(answers, TIME_FORMATS).alias("answer"),
        names.alias("_ids"),
        texts.alias("_texts"),
    )

    def answer_to(question: str) -> Column:
        place = F.array_position("_ids", F.lit(question))
        # Position 0 means absent; get() is NULL outside the array.
        return F.get(F.col("_texts"), (place - 1).cast("int")).alias(question)

    return prepared.select(*RESPONSE_COLUMNS, *[answer_to(q) for q in ids])


def column_names(questions: DataFrame) -> dict[str, str]:
    """Question id -> ``title`` or ``title-sub``; a name that occurs twice
    gets the id as suffix. These become columns, so they come to the driver."""
    name = F.when(
        F.col("sub_question") == NO_SUB_QUESTION, F.col("question_title")
    ).otherwise(F.concat_ws("-", "question_title", "sub_question"))
    rows = (
        questions.select("question_id", name.alias("name")).distinct().collect()
    )
    names: dict[str, str] = {}
    for row in sorted(rows, key=lambda r: (r.question_id, r.name)):
        names[row.question_id] = row.name
    uses = Counter(names.values())
    return {
        qid: name
        if uses[name] == 1 and name not in RESPONSE_COLUMNS
        else f"{name}-{qid}"
        for qid, name in names.items()
    }


def question_names(questions: DataFrame) -> DataFrame:
    """``(question_id, name)`` by the rule of ``column_names``, as a table:
    ``title`` or ``title-sub``, the largest of an id, and the id as suffix
    where a name belongs to several ids or is a response column. Nothing
    comes to the driver, so it holds any number of questions."""
    name = F.when(
        F.col("sub_question") == NO_SUB_QUESTION, F.col("question_title")
    ).otherwise(F.concat_ws("-", "question_title", "sub_question"))
    named = questions.groupBy("question_id").agg(F.max(name).alias("name"))
    uses = named.groupBy("name").agg(F.count(F.lit(1)).alias("_uses"))
    clash = (F.col("_uses") > 1) | F.col("name").isin(RESPONSE_COLUMNS)
    return named.join(uses, "name").select(
        "question_id",
        F.when(clash, F.concat_ws("-", "name", "question_id"))
        .otherwise(F.col("name"))
        .alias("name"),
    )


def survey_answers_titled(
    responses: DataFrame, questions: DataFrame, answers: str = "answers"
) -> DataFrame:
    """``survey_answers`` with the name of each question: the long form of
    ``survey_responses_titled`` for any number of questions. A question that
    is no longer in the form keeps its id as name."""
    names = question_names(questions)
    return (
        survey_answers(responses, answers)
        .join(names, "question_id", "left")
        .select(
            "responseId",
            "question_id",
            F.coalesce("name", "question_id").alias("question"),
            "value",
        )
    )


def survey_responses_titled(
    responses: DataFrame,
    questions: DataFrame,
    answers: str = "answers",
    ids: list[str] | None = None,
) -> DataFrame:
    """``survey_responses_wide`` with columns named after the questions.

    A question that is no longer in the form keeps its id as name. Without
    ``ids`` one pass over the responses finds those that were answered; they
    become columns and therefore come to the driver. For questions without
    bound, ``survey_answers_titled`` is the long form.
    """
    names = column_names(questions)
    if ids is None:
        ids = sorted(row.id for row in question_ids(responses, answers).collect())
    listed = [*names, *[q for q in ids if q not in names]]
    wide = survey_responses_wide(responses, listed, answers)
    return wide.toDF(*RESPONSE_COLUMNS, *[names.get(q, q) for q in listed])


def answers_wide(
    answers: DataFrame,
    response: str,
    question: str,
    value: str,
    ordinal: str,
    ids: list[str],
) -> DataFrame:
    """Answers held one per row -> one row per response with a column for each
    question of ``ids``, the first answer each.

    The aggregate is partial, so a response with very many answers is reduced
    before the shuffle.
    """
    firsts = [
        F.min_by(
            F.when(F.col(question) == q, F.col(value)),
            F.when(
                (F.col(question) == q) & F.col(value).isNotNull(),
                F.col(ordinal),
            ),
        ).alias(q)
        for q in ids
    ]
    return answers.groupBy(response).agg(*firsts)
