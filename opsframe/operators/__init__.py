"""Transformations from DataFrames to DataFrames."""

from opsframe.operators.batching import batch_ids, index_rows
from opsframe.operators.columns import (
    normalise_columns,
    pascal_columns,
    select_properties,
)
from opsframe.operators.filters import (
    check_filters,
    date_range,
    filter_groups,
    incremental_pull,
    optional_filters,
    since,
)
from opsframe.operators.keyed import (
    add_members,
    associate,
    contact_lists,
    delete_all,
    delete_keys,
    list_members,
    lookup_batch,
    masked_update,
    property_updates,
    unmatched_keys,
    upsert,
)
from opsframe.operators.messages import (
    content_payload,
    content_types_map,
    message_requests,
    sparse_record,
)
from opsframe.operators.nested import find_paths, leaf_paths, node_map, nodes
from opsframe.operators.survey import (
    answers_wide,
    column_names,
    question_ids,
    question_names,
    survey_answers,
    survey_answers_titled,
    survey_questions,
    survey_responses,
    survey_responses_titled,
    survey_responses_wide,
)
from opsframe.operators.validate import (
    Rule,
    check_page_size,
    contact_rules,
    content_rules,
    person_batch_rules,
    person_rules,
    tag_rows,
    validate_rows,
)

__all__ = [
    "Rule",
    "add_members",
    "answers_wide",
    "associate",
    "batch_ids",
    "check_filters",
    "check_page_size",
    "column_names",
    "contact_lists",
    "contact_rules",
    "content_payload",
    "content_rules",
    "content_types_map",
    "date_range",
    "delete_all",
    "delete_keys",
    "filter_groups",
    "find_paths",
    "incremental_pull",
    "index_rows",
    "leaf_paths",
    "list_members",
    "lookup_batch",
    "masked_update",
    "message_requests",
    "node_map",
    "nodes",
    "normalise_columns",
    "optional_filters",
    "pascal_columns",
    "person_batch_rules",
    "person_rules",
    "property_updates",
    "question_ids",
    "select_properties",
    "since",
    "sparse_record",
    "question_names",
    "survey_answers",
    "survey_answers_titled",
    "survey_questions",
    "survey_responses",
    "survey_responses_titled",
    "survey_responses_wide",
    "tag_rows",
    "unmatched_keys",
    "upsert",
    "validate_rows",
]
