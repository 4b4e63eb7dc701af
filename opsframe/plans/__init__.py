"""One registered query per operator, over the star and event tables."""

from opsframe.plans import (  # noqa: F401  (importing registers)
    keyed_tables,
    nested_records,
    predicates,
    scalars,
    sinks,
    sources,
    sql_classes,
    streams,
    surveys,
)
from opsframe.plans.registry import REGISTERED

__all__ = ["REGISTERED"]
