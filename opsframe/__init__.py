"""Operations and marketing data on Spark."""

from opsframe.session import (
    configure,
    get_spark,
    scratch_path,
)

__all__ = ["configure", "get_spark", "scratch_path"]
