"""Column-shape transforms between landed documents and typed tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text replaced in column names, in this order.
NAME_REPLACEMENTS = (
    ("state.score.", ""),
    ("state.", ""),
    (".", "_"),
    ("period", "set"),
    ("data_", ""),
    ("season", "league_season"),
)


def column(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col(f"`{name}`")


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct rows of the columns, for a text max() or max_by() on top.

    Spark drops a plain distinct below such an aggregate, as repeats do not change it, and then
    sorts all rows because text maxima cannot be hashed. The count keeps the hashed step.
    """
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.filter("_rows > 0").select(*columns)


def _leaves(schema: T.StructType, parent: Column | None = None, prefix: str = "") -> list[Column]:
    leaves = []
    for field in schema:
        here = column(field.name) if parent is None else parent.getField(field.name)
        name = prefix + field.name
        if isinstance(field.dataType, T.StructType):
            leaves += _leaves(field.dataType, here, f"{name}.")
        else:
            leaves.append(here.alias(name))
    return leaves


def flatten_structs(df: DataFrame) -> DataFrame:
    """Every struct path becomes a column with a dotted name; lists stay whole."""
    return df.select(*_leaves(df.schema))


def nested_to_text(df: DataFrame) -> DataFrame:
    """Lists, maps and structs become JSON text, with their NULL fields; others are left alone."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[
            F.to_json(column(f.name), {"ignoreNullFields": "false"}).alias(f.name) if isinstance(f.dataType, nested) else column(f.name)
            for f in df.schema
        ]
    )


def json_schema_of(df: DataFrame, name: str) -> T.DataType:
    """Common schema of a JSON text column, merged over all rows by the executors."""
    ddl = df.select(F.schema_of_variant_agg(F.try_parse_json(column(name)))).first()[0]
    return T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", ddl))


def explode_json(df: DataFrame, name: str, schema: T.DataType | None = None) -> DataFrame:
    """Turn a column of JSON lists into one row per element, its fields as columns.

    Null elements, empty lists and missing lists give no row; text that is no such list is an
    error. Without a schema, one over all rows is read off the text first. An element field that has the
    name of a kept column is prefixed with the name of the exploded one.
    """
    source = column(name)
    kept = [c for c in df.columns if c != name]
    if isinstance(df.schema[name].dataType, T.StringType):
        shape = json_schema_of(df, name) if schema is None else schema
        source = F.from_json(source, shape, {"mode": "FAILFAST"})
    rows = (
        df.withColumn(name, source)
        .select(*[column(c) for c in kept], F.explode(column(name)).alias("_element"))
        .filter(F.col("_element").isNotNull())
    )
    fields = []
    for field in flatten_structs(rows.select("_element")).columns:
        path = field.removeprefix("_element.")
        value = F.col("_element")
        for step in _steps(rows.schema["_element"].dataType, path):
            value = value.getField(step)
        fields.append(value.alias(f"{name}_{path}" if path in kept else path))
    return rows.select(*[column(c) for c in kept], *fields)


def _steps(schema: T.DataType, path: str) -> list[str]:
    """Split a dotted path at struct borders, as field names may hold dots themselves."""
    for field in schema:
        if path == field.name:
            return [field.name]
        if isinstance(field.dataType, T.StructType) and path.startswith(f"{field.name}."):
            return [field.name, *_steps(field.dataType, path[len(field.name) + 1 :])]
    raise ValueError(f"no field {path}")


def is_average(name: str) -> bool:
    return any(word in name for word in ("avg", "average", "percent"))


# Number text that is parsed; anything else is NULL. Testing the shape first is far cheaper
# than a failed parse on every row.
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
EXACT_DOUBLE = float(2**53)


def _add_number_texts(df: DataFrame, names: list[str]) -> DataFrame:
    """Add the trimmed text and the double of each column, so that neither is worked out twice."""
    texts = {f"_text_{n}": F.trim(column(n).cast("string")) for n in names}
    doubles = {
        f"_double_{n}": F.when(
            column(f"_text_{n}").rlike(NUMBER_PATTERN), column(f"_text_{n}").cast("double")
        )
        for n in names
    }
    return df.withColumns(texts).withColumns(doubles) if names else df


def _whole_text(name: str) -> Column:
    """Bigint of a number text; `2.0` is 2, fractions and other text are NULL."""
    text, number = column(f"_text_{name}"), column(f"_double_{name}")
    is_whole = number == F.floor(number)
    return (
        F.when(is_whole & (F.abs(number) < EXACT_DOUBLE), number.cast("bigint"))
        # Beyond the whole numbers a double holds, the digits themselves count.
        .when(is_whole & text.rlike(INTEGER_PATTERN), text.try_cast("bigint"))
        .when(is_whole, number.try_cast("bigint"))
    )


def _whole_number(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    number = value.cast("double")
    return F.when(number == F.floor(number), number.try_cast("bigint"))


ZONE_PATTERN = r":[0-9.]+ ?(Z|UTC|[+-][0-9]{2}:?[0-9]{2})$"


def wall_clock(value: Column) -> Column:
    """Date or date-time text as a timestamp without zone; bad text is NULL.

    Text with a zone gives the time in UTC, text without one stands as written.
    """
    text = value.cast("string")
    seconds = F.unix_micros(text.try_cast("timestamp")).cast("decimal(20, 0)") / F.lit(1000000)
    in_utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18, 6)")
    )
    return F.when(text.rlike(ZONE_PATTERN), in_utc).otherwise(text.try_cast("timestamp_ntz"))


def _is_number(name: str) -> bool:
    return not is_average(name) and ("score" in name or "number" in name)


def _typed(name: str, kind: T.DataType) -> Column:
    value = column(name)
    if _is_number(name):
        typed = _whole_text(name) if isinstance(kind, T.StringType) else _whole_number(value, kind)
    elif name.endswith("name") or any(word in name for word in ("type", "category", "id")):
        typed = value.cast("string")
    elif "date" in name:
        typed = wall_clock(value)
    else:
        return value
    return typed.alias(name)


def cast_by_name(df: DataFrame, keep_averages: bool = False) -> DataFrame:
    """Type every column by what its name contains; averages and percentages are dropped."""
    texts = [
        f.name for f in df.schema if _is_number(f.name) and isinstance(f.dataType, T.StringType)
    ]
    return _add_number_texts(df, texts).select(
        *[
            column(f.name) if is_average(f.name) else _typed(f.name, f.dataType)
            for f in df.schema
            if keep_averages or not is_average(f.name)
        ]
    )


def drop_columns(df: DataFrame, names: tuple[str, ...] = ()) -> DataFrame:
    """Drop the named columns, if there, and all columns with `image` in the name."""
    return df.select(
        *[column(name) for name in df.columns if name not in names and "image" not in name]
    )


def renamed(name: str, overrides: dict[str, str]) -> str:
    if name in overrides:
        return overrides[name]
    for old, new in NAME_REPLACEMENTS:
        name = name.replace(old, new)
    return name


def rename_columns(df: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """Rename by the fixed replacements; `overrides` is keyed by the name before renaming."""
    return df.toDF(*[renamed(name, overrides or {}) for name in df.columns])


def split_column(df: DataFrame, name: str, first: str, second: str, separator: str = "-") -> DataFrame:
    """Add the two halves of a text column; a half that is not there is NULL.

    Text with more than two parts has no halves: both are NULL.
    """
    return split_columns(df, {name: (first, second)}, separator)


def split_columns(
    df: DataFrame, halves: dict[str, tuple[str, str]], separator: str = "-"
) -> DataFrame:
    """Split several text columns, each in two, splitting every text once."""
    parts = {f"_parts_{name}": F.split(column(name), re.escape(separator)) for name in halves}
    kept = df.columns
    named = {}
    for name, pair in halves.items():
        for place, half in enumerate(pair):
            split = column(f"_parts_{name}")
            named[half] = F.when(F.size(split) <= 2, F.get(split, F.lit(place)))
    return df.withColumns(parts).select(
        *[column(name) for name in kept if name not in named],
        *[value.alias(half) for half, value in named.items()],
    )
