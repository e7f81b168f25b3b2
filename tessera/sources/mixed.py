"""Part files that disagree in a column's type.

One Parquet scan has one type for a column, so a folder in which a column is a
number in some files and text in others can't be read at once. Here the files
are put in groups that one schema fits: all files are tried first (Spark reads
the footers side by side, in one job); where they don't fit together the list
is halved and each half tried, and groups with the same types are joined again.
Files are listed by folder and write job, as part files of one job agree, so
the number of tries follows the number of changes of type in that order and
not the number of files. Each group is then one scan (columns still pruned,
filters still pushed down to it), cast to the common types and added by name.

The common type of a column: the type itself where all agree; of integers the
widest; ``double`` where a fraction type joins in; ``timestamp_ntz`` of dates and
times; else text, written as Spark writes the value.
"""

from __future__ import annotations

import posixpath
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTION = (T.FloatType, T.DoubleType)
_TIME = (T.DateType, T.TimestampType, T.TimestampNTZType)


def common_type(types: list[T.DataType]) -> T.DataType:
    """The type that values of all ``types`` are cast to."""
    kinds = [t for t in types if not isinstance(t, T.NullType)]
    if not kinds:
        return T.StringType()
    if all(t == kinds[0] for t in kinds):
        return kinds[0]
    if all(isinstance(t, _WHOLE) for t in kinds):
        return max(kinds, key=lambda t: _WHOLE.index(type(t)))
    if all(isinstance(t, (*_WHOLE, *_FRACTION)) for t in kinds):
        return T.DoubleType()
    if all(isinstance(t, _TIME) for t in kinds):
        return T.TimestampNTZType()
    return T.StringType()


def _write_job(path: str) -> tuple[str, str]:
    """Folder, and name without the part's number: files of one job stand together."""
    folder, name = posixpath.split(path)
    return folder, re.sub(r"^part-\d+-", "", name)


def merged_schema(spark: SparkSession, files: list[str]) -> T.StructType | None:
    """The union of the files' columns; None where a column has several types."""
    try:
        return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*files).schema
    except Exception as exc:  # the tasks' error comes through the gateway in several classes
        if "CANNOT_MERGE" in str(exc):
            return None
        raise


def _fits(a: T.StructType, b: T.StructType) -> bool:
    types = {f.name: f.dataType for f in a}
    return all(types.get(f.name, f.dataType) == f.dataType for f in b)


def _joined(a: T.StructType, b: T.StructType) -> T.StructType:
    names = set(a.names)
    return T.StructType([*a.fields, *(f for f in b.fields if f.name not in names)])


def schema_groups(spark: SparkSession, files: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """The files in groups, each with one schema that fits all its files."""
    groups: list[tuple[T.StructType, list[str]]] = []
    todo = [sorted(files, key=_write_job)]
    while todo:
        part = todo.pop()
        schema = merged_schema(spark, part)
        if schema is None:
            half = len(part) // 2
            todo += [part[half:], part[:half]]
            continue
        for i, (known, members) in enumerate(groups):
            if _fits(known, schema):
                groups[i] = (_joined(known, schema), members + part)
                break
        else:
            groups.append((schema, part))
    return groups


def read_mixed_parquet(spark: SparkSession, files: list[str], schema: T.StructType | None = None) -> DataFrame:
    """All files as one table; a column that files give several types has the
    common one (or ``schema``'s, where given)."""
    groups = schema_groups(spark, files)
    if schema is None:
        names = list(dict.fromkeys(name for known, _ in groups for name in known.names))
        schema = T.StructType([T.StructField(name, common_type([known[name].dataType for known, _ in groups if name in known.names])) for name in names])
    frames = []
    for known, members in groups:
        scan = spark.read.schema(known).parquet(*members)
        frames.append(scan.select(*[_cast(f, known).alias(f.name) for f in schema]))
    return reduce(lambda a, b: a.unionByName(b), frames)


def _cast(field: T.StructField, known: T.StructType) -> F.Column:
    if field.name not in known.names:
        return F.lit(None).cast(field.dataType)
    column = F.col(f"`{field.name}`")
    if known[field.name].dataType == field.dataType:
        return column
    if isinstance(field.dataType, T.StringType) and isinstance(known[field.name].dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column)
    return column.cast(field.dataType)
