"""Parquet and ORC folders whose files hold a field in different types.

Files are taken in runs of one schema each, every run is read with its own types, and values are turned into the declared
ones. A value that does not fit is null, and its field is named in the column `_wrong_type`, so a contract can tell it from
one that is missing:

* whole numbers take whole numbers in range, in any number type or as text; a fraction does not fit;
* decimals take numbers in range, rounded to their digits, and text that reads as one;
* text takes every simple value as it is written;
* lists and structs fit by their elements and by field name. A wrong value within them is null and not named.
"""

import re
from collections.abc import Callable, Mapping
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import WRONG_TYPE

_CONFLICTS = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")


def _escaped(file: str) -> str:
    """A file as Spark lists it, as a path that stands for that file only."""
    return "".join(f"\\{c}" if c in "[]{}*?\\" else c for c in unquote(file))


def _by_write(file: str) -> tuple[str, str, str]:
    """Order in which the files of one write are neighbours: what follows the part number names the write."""
    folder, _, name = file.rpartition("/")
    return folder, re.sub(r"^part-\d+", "", name), name


def _typed_runs(reader: Callable[[], DataFrameReader], files: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files with the schema they share, by halving until a part's footers, which executors read, merge into one schema.

    Files of one write lie side by side, so a change of types costs about 2 log2(files) jobs. Where types alternate from
    write to write it costs about a job a write.
    """
    try:
        return [(reader().option("mergeSchema", "true").load(files).schema, files)]
    except (PySparkException, Py4JJavaError) as error:  # the classic session passes Spark's own error on as it is
        if len(files) == 1 or not any(f"[{condition}]" in str(error) for condition in _CONFLICTS):
            raise
    half = len(files) // 2
    return _typed_runs(reader, files[:half]) + _typed_runs(reader, files[half:])


def _fitted(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """`value` in the type `want`, null where it does not fit."""
    if have == want:
        return value
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: _fitted(x, have.elementType, want.elementType))
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        types = {f.name: f.dataType for f in have}
        fields = [_field(value[f.name] if f.name in types else None, types.get(f.name), f) for f in want]
        return F.when(value.isNotNull(), F.struct(*fields))
    if any(isinstance(t, (T.ArrayType, T.StructType, T.MapType, T.BinaryType)) for t in (have, want)):
        return F.lit(None).cast(want)
    if isinstance(want, T.NumericType) and not isinstance(have, (T.NumericType, T.StringType)):
        return F.lit(None).cast(want)  # a date or a truth value is no number
    if isinstance(want, T.IntegralType) and isinstance(have, T.NumericType) and not isinstance(have, T.IntegralType):
        return F.when(F.floor(value) == value, value.try_cast(want))
    return value.try_cast(want)


def _field(value: Column | None, have: T.DataType | None, want: T.StructField) -> Column:
    return (F.lit(None).cast(want.dataType) if value is None else _fitted(value, have, want.dataType)).alias(want.name)


def _of_types(df: DataFrame, schema: T.StructType, names: Mapping[str, str]) -> DataFrame:
    """`df`, of one schema, with the declared columns and the names of those whose value did not fit."""
    there = {names[f.name]: f for f in df.schema if f.name in names}
    value = {name: F.col(f"`{f.name}`") for name, f in there.items()}
    columns = [_field(value.get(f.name), there[f.name].dataType if f.name in there else None, f) for f in schema]
    wrong = [
        F.when(value[f.name].isNotNull() & _fitted(value[f.name], there[f.name].dataType, f.dataType).isNull(), f.name)
        for f in schema
        if f.name in there and there[f.name].dataType != f.dataType
    ]
    named = F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<string>")
    return df.select(*columns, named.alias(WRONG_TYPE))


def read_mixed(
    reader: Callable[[], DataFrameReader], path: str, schema: T.StructType, names: Mapping[str, str]
) -> DataFrame:
    """The table at `path` in the types of `schema`; `names` maps names in the files to ours."""
    files = sorted(reader().schema(schema).load(path).inputFiles(), key=_by_write)
    if not files:
        return _of_types(reader().schema(T.StructType([])).load(path), schema, names)
    based = lambda: reader().option("basePath", path)  # keeps the partition columns of single files
    by_schema: dict[str, tuple[T.StructType, list[str]]] = {}
    for found, part in _typed_runs(based, [_escaped(f) for f in files]):
        by_schema.setdefault(found.json(), (found, []))[1].extend(part)
    return reduce(
        DataFrame.unionByName,
        (_of_types(based().schema(found).load(part), schema, names) for found, part in by_schema.values()),
    )
