"""API payloads to rows: row arrays and parallel arrays, parsed by Spark's JSON
reader and expanded with generators (no Python per row). Payloads whose fields are not known
beforehand are read as VARIANT: one aggregate merges the rows' types, a second pass reads them
typed, and pages that can't be read are set aside with their text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast.sources.io import nan_to_null

# A malformed page fails the job instead of silently becoming zero rows.
_JSON_OPTS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", "mode": "FAILFAST"}


def row_array_schema(path: Sequence[str], row: T.StructType) -> T.StructType:
    """Schema of a payload whose rows sit at ``path``, e.g. ("items",) or ("response", "data")."""
    t: T.DataType = T.ArrayType(row)
    for name in reversed(path):
        t = T.StructType([T.StructField(name, t)])
    return t


def explode_rows(df: DataFrame, payload: str, path: Sequence[str], row: T.StructType,
                 keep: Sequence[str] = ()) -> DataFrame:
    """JSON text column holding ``{"items": [{...}, ...]}`` (or a deeper path such as
    ``response.data``) to one row per array element with the element's fields."""
    parsed = F.from_json(F.col(payload), row_array_schema(path, row), _JSON_OPTS)
    arr: Column = parsed
    for name in path:
        arr = arr.getField(name)
    return nan_to_null(df.select(*keep, F.inline(arr)))


def zip_arrays(df: DataFrame, struct_col: str | Column, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Struct of equally long arrays (``{"time": [...], "x": [...]}``) to one row per
    position, columns named after the fields. Arrays of different lengths raise an
    error (``arrays_zip`` alone would pad with NULLs)."""
    s = F.col(struct_col) if isinstance(struct_col, str) else struct_col
    zipped = F.arrays_zip(*[s.getField(f).alias(f) for f in fields])
    sizes = [F.size(s.getField(f)) for f in fields]
    same = F.lit(True)
    for z in sizes[1:]:
        same = same & (z == sizes[0])
    checked = F.when(same, zipped).otherwise(F.raise_error(F.lit("parallel arrays differ in length")))
    return nan_to_null(df.select(*keep, F.inline(checked)))


def parse_parallel(df: DataFrame, payload: str, key: str, fields: dict[str, T.DataType],
                   keep: Sequence[str] = ()) -> DataFrame:
    """JSON text ``{"<key>": {"time": [...], "<f>": [...]}}`` to rows."""
    inner = T.StructType([T.StructField(f, T.ArrayType(t)) for f, t in fields.items()])
    schema = T.StructType([T.StructField(key, inner)])
    parsed = df.select(*keep, F.from_json(F.col(payload), schema, _JSON_OPTS).alias("__p"))
    return zip_arrays(parsed, F.col("__p").getField(key), list(fields), keep)


def _rows_at(payload: str, path: Sequence[str]) -> Column:
    """The rows of a page as an array of VARIANT; NULL where the text is no JSON or holds no array at ``path``."""
    if any("'" in name or "\\" in name for name in path):
        raise ValueError("names on the path to the rows can't hold quotes or backslashes")
    where = "$" + "".join(f"['{name}']" for name in path)
    return F.try_variant_get(F.try_parse_json(F.col(payload)), where, "array<variant>")


_TYPE_WORDS = re.compile(r"`(?:[^`]|``)*`|OBJECT<|DECIMAL\(\d+, *\d+\)|\b(?:VOID|VARIANT)\b(?!:)")
_SPARK_TYPES = {"OBJECT<": "STRUCT<", "VOID": "STRING", "VARIANT": "STRING"}


def _typed(merged: str) -> str:
    """The Spark type for a merged VARIANT type: decimals as doubles, text where no row has a
    value or rows differ in kind; quoted names stay."""
    return _TYPE_WORDS.sub(lambda m: m[0] if m[0].startswith("`") else _SPARK_TYPES.get(m[0], "DOUBLE"), merged)


def infer_row_type(df: DataFrame, payload: str, path: Sequence[str]) -> str | None:
    """The struct type that all rows of all readable pages fit, from one aggregate; fields are in
    the order of their names. None where no page has a row."""
    rows = df.select(F.explode(_rows_at(payload, path)).alias("r"))
    merged = rows.agg(F.schema_of_variant_agg("r")).first()[0]
    if merged == "VOID":
        return None
    if not merged.startswith("OBJECT<"):
        raise ValueError(f"rows are no objects, but {merged}")
    return _typed(merged)


def explode_inferred(df: DataFrame, payload: str, path: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``explode_rows`` without a given row type. Stamps stay text, as JSON has none; a field that
    a row lacks is NULL. Pages that ``malformed_pages`` returns have no rows here. Where no
    page has a field, only the kept columns come back."""
    row_type = infer_row_type(df, payload, path)
    rows = df.select(*keep, F.explode(_rows_at(payload, path)).alias("__row"))
    if row_type in (None, "STRUCT<>"):
        return rows.drop("__row")
    return nan_to_null(rows.withColumn("__row", F.variant_get("__row", "$", row_type)).select(*keep, "__row.*"))


def malformed_pages(df: DataFrame, payload: str, path: Sequence[str]) -> DataFrame:
    """The pages, whole, whose text is no JSON (cut short, a key twice) or holds no array at ``path``."""
    return df.where(F.col(payload).isNotNull() & _rows_at(payload, path).isNull())
