"""JSON text: tolerant parsing, numeric conversion and stringifying."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Number syntax of Python's float(): underscores between digits, no suffix.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_FLOAT = (
    rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})"
    rf"(?:[eE][+-]?{_DIGITS})?$"
)
_INFINITE = r"(?i)^[+-]?inf(?:inity)?$"
_NAN = r"(?i)^[+-]?nan$"

# NaN and Infinity standing outside any string: an even number of quotes
# follows. JSON proper has no such literals, many writers emit them.
_BARE_CONSTANT = (
    r"(?<![\w\"])-?(?:NaN|Infinity)(?![\w\"])"
    r"(?=(?:[^\"]++|\"(?:[^\"\\]++|\\.)*+\")*+$)"
)

# Spark writes milliseconds by default, which would cut timestamps short.
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
KEEP_NULLS = {"ignoreNullFields": "false", **TIME_FORMATS}

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONS = (T.FloatType, T.DoubleType)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _one_strict_value(text: Column) -> Column:
    """Whether the text is one JSON value and nothing else.

    The parsers stop at the end of the outermost container, so the text is
    wrapped in two kinds: one that closes the object early is a syntax error
    in the array. The object is parsed strictly; the array is only counted.
    """
    named = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    listed = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    return F.coalesce((listed == 1) & named.isNotNull(), F.lit(False))


def is_json(line: Column | str) -> Column:
    """Whether the text is exactly one JSON value.

    Scalars and ``null`` are values, and the bare constants NaN and Infinity
    are accepted.
    """
    column = _column(line)
    constants = F.regexp_replace(column, _BARE_CONSTANT, '"$0"')
    return (
        F.when(_one_strict_value(column), F.lit(True))
        .when(column.rlike("NaN|Infinity"), _one_strict_value(constants))
        .otherwise(F.lit(False))
    )


def parse_json_line(line: Column | str) -> Column:
    """Text -> VARIANT; NULL where the text is not exactly one JSON value.

    ``try_parse_json`` alone stops after the first value and would accept
    trailing garbage. A bare NaN or Infinity becomes a string.
    """
    column = _column(line)
    constants = F.regexp_replace(column, _BARE_CONSTANT, '"$0"')
    return F.when(
        is_json(column),
        F.coalesce(F.try_parse_json(column), F.try_parse_json(constants)),
    )


def float_or_null(text: Column | str) -> Column:
    """The double that Python's ``float()`` would read from a string, or NULL."""
    from opsframe.functions.text import strip

    bare = strip(text)
    number = F.replace(bare, F.lit("_"), F.lit("")).try_cast("double")
    return (
        F.when(bare.rlike(_FLOAT), number)
        .when(bare.rlike(_INFINITE), bare.try_cast("double"))
        .when(bare.rlike(_NAN), F.lit(float("nan")))
    )


def _numeric_fields(
    name: str, column: Column, dtype: T.DataType
) -> list[Column]:
    """The output columns for one dict entry."""
    if isinstance(
        dtype, (*_INTEGERS, *_FRACTIONS, T.DecimalType, T.BooleanType)
    ):
        return [column.cast("double").alias(name)]
    if isinstance(dtype, T.StringType):
        return [column.alias(name), float_or_null(column).alias(f"{name}_num")]
    if isinstance(dtype, T.MapType) and isinstance(
        dtype.valueType, T.StringType
    ):
        numbers = F.map_filter(
            F.transform_values(column, lambda _, v: float_or_null(v)),
            lambda _, v: v.isNotNull(),
        )
        return [column.alias(name), numbers.alias(f"{name}_num")]
    if isinstance(dtype, T.VariantType):
        number = F.coalesce(
            float_or_null(F.try_variant_get(column, "$", "string")),
            F.try_variant_get(column, "$", "boolean").cast("double"),
        )
        text = F.to_json(column)
        return [text.alias(name), number.alias(f"{name}_num")]
    return [numeric_struct(column, dtype).alias(name)]


def numeric_struct(column: Column, dtype: T.DataType) -> Column:
    """Numeric conversion of every dict nested in ``column``.

    Numbers and booleans held by a dict become doubles; a string field ``s``
    keeps its text and gains ``s_num``. Scalars held by a list stay as they
    are.
    """
    if isinstance(dtype, T.StructType):
        fields = [
            part
            for field in dtype.fields
            for part in _numeric_fields(
                field.name, column.getField(field.name), field.dataType
            )
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.MapType):
        if isinstance(dtype.valueType, T.StringType):
            return column
        return F.transform_values(
            column,
            lambda _, v: _numeric_fields("v", v, dtype.valueType)[0],
        )
    if isinstance(dtype, T.ArrayType) and isinstance(
        dtype.elementType, (T.StructType, T.MapType, T.ArrayType)
    ):
        return F.transform(
            column, lambda item: numeric_struct(item, dtype.elementType)
        )
    return column


def numeric_hook(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One-level numeric conversion of a row's columns.

    Integers, decimals and booleans become doubles. A string column ``s``
    keeps its text and gains ``s_num``. Nested columns stay unchanged.
    """
    chosen = set(df.columns if columns is None else columns)
    out: list[Column] = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        nested = isinstance(
            field.dataType, (T.StructType, T.ArrayType, T.MapType)
        )
        if field.name not in chosen or nested:
            out.append(column)
        else:
            out.extend(_numeric_fields(field.name, column, field.dataType))
    return df.select(*out)


def parse_json_numeric(
    df: DataFrame,
    column: str,
    schema: T.DataType | str | None = None,
    output: str = "parsed",
    drop_bad: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """Parse JSON text with numeric conversion at every nesting level.

    Malformed text gives NULL in ``output``; ``drop_bad`` removes those rows.
    ``observation`` gets their number as ``bad_rows`` when the result is
    computed. Without a schema one extra pass over the column infers it; a
    column without any JSON value gives NULL text.
    """
    if observation is not None:
        bad = F.col(column).isNotNull() & ~is_json(column)
        df = df.observe(observation, F.count_if(bad).alias("bad_rows"))
    if schema is None:
        schema = infer_json_schema(df, column)
    if isinstance(schema, T.NullType):
        parsed = F.lit(None).cast("string")
    else:
        parsed = F.when(is_json(column), F.from_json(column, schema))
    result = df.withColumn(output, parsed)
    dtype = result.schema[output].dataType
    if drop_bad:
        result = result.filter(F.col(output).isNotNull())
    return result.withColumn(output, numeric_struct(F.col(output), dtype))


def infer_json_schema(df: DataFrame, column: str) -> T.DataType:
    """Type of the JSON text in a column, from one pass that merges the
    schemas of all rows. Places that hold mixed types become VARIANT.

    The merged schema comes to the driver, as every schema does; where keys
    are data, such as ids, give the schema (a map) instead.
    """
    merged = df.select(
        F.schema_of_variant_agg(parse_json_line(column))
    ).first()[0]
    return _variant_type(merged)


# A key as the schema text shows it: plain or quoted by backticks.
_KEY = re.compile(r"\s*(?:`((?:[^`]|``)*)`|([^`:<>,]+?))\s*:\s*")


def _variant_type(text: str) -> T.DataType:
    """The type that a schema text of VARIANT values names."""
    dtype, rest = _read_type(text)
    if rest.strip():
        raise ValueError(f"schema not understood: {text}")
    return dtype


def _read_type(text: str, inside: bool = False) -> tuple[T.DataType, str]:
    """The type at the start of a schema text, and the text behind it.

    ``inside`` a value the type of a NULL is text; the type of nothing but
    NULLs is the null type.
    """
    if text.startswith("ARRAY<"):
        element, rest = _read_type(text[len("ARRAY<") :], True)
        return T.ArrayType(element), rest[1:]
    if text.startswith("OBJECT<"):
        fields, rest = [], text[len("OBJECT<") :]
        while not rest.startswith(">"):
            found = _KEY.match(rest)
            quoted, plain = found.groups()
            name = plain if quoted is None else quoted.replace("``", "`")
            dtype, rest = _read_type(rest[found.end() :], True)
            fields.append(T.StructField(name, dtype))
            rest = rest.removeprefix(",")
        return T.StructType(fields), rest[1:]
    end = re.match(r"[A-Za-z_]+(\(\s*\d+\s*(,\s*\d+\s*)?\))?", text).end()
    name, rest = text[:end], text[end:]
    if name.upper() == "VOID":
        return (T.StringType() if inside else T.NullType()), rest
    return T.DataType.fromDDL(name), rest


def as_json_text(column: Column, dtype: T.DataType) -> Column:
    """Any value as JSON text; NULL becomes ``null``."""
    if isinstance(
        dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    ):
        text = F.to_json(column, KEEP_NULLS)
    elif isinstance(
        dtype, (*_INTEGERS, *_FRACTIONS, T.DecimalType, T.BooleanType)
    ):
        text = column.cast("string")
    else:
        listed = F.to_json(F.array(column), TIME_FORMATS)
        text = F.when(
            column.isNotNull(),
            F.substring(listed, F.lit(2), F.length(listed) - 2),
        )
    return F.coalesce(text, F.lit("null"))


def nested_to_string(df: DataFrame) -> DataFrame:
    """Turn every top-level column that is no string, integer or boolean into
    JSON text, so that it fits a flat table."""
    flat = (T.StringType, *_INTEGERS, T.BooleanType)
    return df.select(
        *[
            F.col(f"`{f.name}`")
            if isinstance(f.dataType, flat)
            else as_json_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
            for f in df.schema.fields
        ]
    )


def base64_json(
    text: Column | str, schema: T.DataType | str, strict: bool = True
) -> Column:
    """Decode base64 of UTF-8 JSON. ``strict`` fails the job on bad JSON,
    otherwise bad rows are NULL."""
    decoded = F.decode(F.unbase64(_column(text)), "UTF-8")
    mode = "FAILFAST" if strict else "PERMISSIVE"
    return F.from_json(decoded, schema, {"mode": mode})


def encode_base64(text: Column | str) -> Column:
    """UTF-8 text -> base64 on one line."""
    # base64() breaks long output into lines on some versions.
    return F.regexp_replace(
        F.base64(F.encode(_column(text), "UTF-8")), r"[\r\n]", ""
    )
