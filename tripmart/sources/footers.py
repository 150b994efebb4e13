"""Schemas of many Parquet files, read from their footers in tasks, and the schema that holds them all.

Files of one kind drift: a column is ``bigint`` in one month and ``double`` in the next, and no single
declared schema reads both. Grouped by their own schemas they can be read, and cast to the widened one.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    StringType,
    StructField,
    StructType,
)

# Integers by width and the decimal digits that hold them.
_INTEGERS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}


def described(listed: DataFrame) -> DataFrame:
    """The rows with ``schema``, the types Spark reads the file at ``path`` by (JSON).

    A task reads the footers of the files that its part of the listing names.
    """
    names = listed.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_schema_of(path) for path in batch.column(names.index("path")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*names, "schema"])

    return listed.mapInArrow(run, StructType([*listed.schema.fields, StructField("schema", StringType())]))


def _schema_of(path: str) -> str:
    from pyarrow import fs, parquet
    from pyspark.sql.pandas.types import from_arrow_type

    storage, place = fs.FileSystem.from_uri(path)
    meta = parquet.read_metadata(place, filesystem=storage)
    columns = [meta.schema.column(i) for i in range(len(meta.schema))]
    # the type of instants that old writers use tells nothing of zones: Spark reads them as instants
    old = {c.path for c in columns if c.physical_type == "INT96"}
    fields = []
    for column in meta.schema.to_arrow_schema():
        kind = column.type.value_type if pa.types.is_dictionary(column.type) else column.type
        fields.append(StructField(column.name, from_arrow_type(kind, column.name not in old)))
    return StructType(fields).json()


@dataclass
class Alike:
    """What shares a schema: whole months, and single files of months whose files differ among themselves."""

    schema: StructType
    months: list[str] = field(default_factory=list)
    paths: list[str] = field(default_factory=list)


def grouped(rows: DataFrame) -> list[Alike]:
    """Described files by schema. One row per month reaches the driver, however many files it has, unless they differ."""
    found: dict[str, Alike] = {}
    mixed = []

    def of(schema: str) -> Alike:
        return found.setdefault(schema, Alike(StructType.fromJson(json.loads(schema))))

    for row in rows.groupBy("month").agg(F.collect_set("schema").alias("schemas")).collect():
        if len(row.schemas) == 1:
            of(row.schemas[0]).months.append(row.month)
        else:
            mixed.append(row.month)
    if mixed:
        for row in rows.filter(F.col("month").isin(mixed)).select("path", "schema").collect():
            of(row.schema).paths.append(row.path)
    return [found[schema] for schema in sorted(found)]


def widened(schemas: Iterable[StructType]) -> StructType:
    """One schema that holds the columns of all, by name without regard to case, in order of appearance.

    Integers widen to the longest, integers and fractions to ``double``, decimals to one that holds both, dates
    and timestamps without zone to the latter. Two types that no type holds raise ``ValueError``.
    """
    out: dict[str, StructField] = {}
    for schema in schemas:
        for column in schema.fields:
            key = column.name.lower()
            kind = _both(column.name, out[key].dataType, column.dataType) if key in out else column.dataType
            out[key] = StructField(out[key].name if key in out else column.name, kind)
    return StructType(list(out.values()))


def _both(name: str, a: DataType, b: DataType) -> DataType:
    if a == b:
        return a
    texts = {a.simpleString(): a, b.simpleString(): b}
    if all(t in _INTEGERS for t in texts):
        return texts[max(texts, key=_INTEGERS.__getitem__)]
    if all(t in _INTEGERS or isinstance(x, (FloatType, DoubleType, DecimalType)) for t, x in texts.items()):
        if any(isinstance(x, (FloatType, DoubleType)) for x in texts.values()):
            return DoubleType()
        sizes = [(x.precision - x.scale, x.scale) if isinstance(x, DecimalType) else (_INTEGERS[t], 0) for t, x in texts.items()]
        whole, scale = (max(s) for s in zip(*sizes, strict=True))
        if whole + scale <= 38:
            return DecimalType(whole + scale, scale)
    if set(texts) <= {"timestamp_ntz", "date"}:
        return next(x for x in texts.values() if not isinstance(x, DateType))
    raise ValueError(f"column {name} is {a.simpleString()} in one file and {b.simpleString()} in another")
