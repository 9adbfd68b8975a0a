"""Types found in files: a lattice of types, inference in one mergeable aggregate, a ledger of schema versions.

Types found in new files are joined with those known so far: the join of two types is the narrowest one that holds the
values of both. Hints come on top and are never widened. Every change is a new version in the ledger, a log of small
files in a shared folder, so that each stored file can be read under the version it was written with.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import exists, hadoop, names_in, read_small, write_small

Schema = str | T.StructType

BIG = T.DecimalType(38, 0)
_NUMBERS: tuple[T.DataType, ...] = (T.LongType(), BIG, T.DoubleType())
_TIMES: tuple[T.DataType, ...] = (T.DateType(), T.TimestampType())


def as_struct(spark: SparkSession, schema: Schema | None) -> T.StructType:
    if schema is None or schema == "":
        return T.StructType([])
    return schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """Narrowest type for the values of both; text holds everything."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for chain in (_NUMBERS, _TIMES):
        if a in chain and b in chain:
            return max(a, b, key=chain.index)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return join_structs(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(join_types(a.elementType, b.elementType))
    return T.StringType()


def join_structs(a: T.StructType, b: T.StructType) -> T.StructType:
    """Fields of both, those of ``a`` first. A name that differs from a known one in case alone is left out."""
    kinds = {f.name: f.dataType for f in a.fields}
    known = {name.lower() for name in kinds}
    for f in b.fields:
        if f.name in kinds:
            kinds[f.name] = join_types(kinds[f.name], f.dataType)
        elif f.name.lower() not in known:
            kinds[f.name] = f.dataType
            known.add(f.name.lower())
    return T.StructType([T.StructField(n, t) for n, t in kinds.items()])


def with_hints(found: T.StructType, hints: T.StructType) -> T.StructType:
    """Hinted fields with their hinted type, whether found or not."""
    fixed = {f.name.lower(): f for f in hints.fields}
    fields = [fixed.pop(f.name.lower(), f) for f in found.fields]
    return T.StructType([*fields, *fixed.values()])


# --- JSON


def _plain(t: T.DataType) -> T.DataType:
    """A type of the variant kind as one of the lattice."""
    if isinstance(t, T.DecimalType):
        return T.DoubleType() if t.scale > 0 else BIG if t.precision > 18 else T.LongType()
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(t, T.VariantType):
        return T.StringType()
    if isinstance(t, T.StructType):
        plain = T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in t.fields])
        return join_structs(T.StructType([]), plain)
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_plain(t.elementType))
    return t


def infer_json(lines: DataFrame, column: str = "value") -> T.StructType:
    """Types of the fields of JSON objects, one per line, from one aggregate; other lines do not count."""
    spark = lines.sparkSession
    parsed = F.try_parse_json(F.when(F.ltrim(column).startswith("{"), F.col(column)))
    found = lines.agg(F.schema_of_variant_agg(parsed)).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType([])
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m.group() == "OBJECT<" else m.group(), found)
    return _plain(spark.createDataFrame([], f"v {ddl}").schema["v"].dataType)


# --- Delimited text: every column is text to begin with

_INTEGER = r"^(0|-?[1-9][0-9]*)$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_KINDS: tuple[T.DataType, ...] = (T.BooleanType(), T.LongType(), BIG, T.DoubleType(), T.DateType(), T.TimestampType(), T.StringType())


def _kind(text: Column) -> Column:
    """Bit of the narrowest type that a text can be read as without losing anything; whole numbers with leading zeros are text."""
    whole = text.rlike(_INTEGER)
    tests = (
        F.lower(text).isin("true", "false"),
        whole & text.try_cast("bigint").isNotNull(),
        whole & (F.length(text) <= 38),
        text.rlike(_NUMBER) & ~text.rlike("^[+-]?0[0-9]") & ~whole,
        text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & text.try_cast("date").isNotNull(),
        text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:") & text.try_cast("timestamp").isNotNull(),
    )
    bit = F.when(text.isNull(), 0)
    for i, test in enumerate(tests):
        bit = bit.when(test, 1 << i)
    return bit.otherwise(1 << len(tests))


def infer_text(rows: DataFrame) -> T.StructType:
    """Types of text columns, from one aggregate of a bit set per column."""
    if not rows.columns:
        return T.StructType([])
    bits = rows.agg(*[F.bit_or(_kind(F.col(f"`{c}`"))).alias(f"k{i}") for i, c in enumerate(rows.columns)]).first()
    fields = []
    for name, seen in zip(rows.columns, bits, strict=True):
        kinds = [k for i, k in enumerate(_KINDS) if (seen or 0) >> i & 1]
        fields.append(T.StructField(name, reduce(join_types, kinds, T.NullType())))
    return join_structs(T.StructType([]), T.StructType(fields))


# --- Versions


class SchemaLedger:
    """Versions of a schema as files of a folder, one per version; a version is never changed.

    Two writers that find new types at once cannot overwrite each other: creating a version that exists fails, and the
    second one joins its types with what the first wrote.
    """

    def __init__(self, spark: SparkSession, folder: str, hints: Schema | None = None, reserved: Iterable[str] = ()):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.hints = as_struct(spark, hints)
        #: Names that no field may take, as the table has columns of its own that are called so.
        self.reserved = {name.lower() for name in reserved}

    def versions(self) -> list[int]:
        names = names_in(self.spark, self.folder)
        return sorted(int(n[1:-5]) for n in names if re.fullmatch(r"v[0-9]+\.json", n))

    def at(self, version: int) -> T.StructType:
        """Schema of a version; version 0 is empty but for the hints."""
        if not version:
            return with_hints(T.StructType([]), self.hints)
        return T.StructType.fromJson(json.loads(read_small(self.spark, f"{self.folder}/v{version}.json")))

    def latest(self) -> tuple[int, T.StructType]:
        version = max(self.versions(), default=0)
        return version, self.at(version)

    def merge(self, found: T.StructType) -> tuple[int, T.StructType]:
        """Version that holds ``found`` too; a new one if the latest does not."""
        while True:
            version, known = self.latest()
            known = known if version else T.StructType([])
            found = T.StructType([f for f in found.fields if f.name.lower() not in self.reserved])
            schema = with_hints(join_structs(known, found), self.hints)
            if version and schema == known:
                return version, known
            try:
                write_small(self.spark, f"{self.folder}/v{version + 1}.json", schema.json())
                return version + 1, schema
            except Py4JJavaError as e:
                if "AlreadyExists" not in str(e.java_exception.getClass().getName()):
                    raise


# --- Stored rows under several versions


def storable(schema: T.StructType) -> T.StructType:
    """``schema`` with text where a type is not known yet."""

    def fixed(t: T.DataType) -> T.DataType:
        if isinstance(t, T.NullType):
            return T.StringType()
        if isinstance(t, T.ArrayType):
            return T.ArrayType(fixed(t.elementType))
        if isinstance(t, T.StructType):
            return T.StructType([T.StructField(f.name, fixed(f.dataType)) for f in t.fields]) if t.fields else T.StringType()
        return t

    return T.StructType([T.StructField(f.name, fixed(f.dataType)) for f in schema.fields])


def recast(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """A value of an earlier version under a later one. Nested values become JSON text where text is wanted."""
    if old == new:
        return value
    if isinstance(new, T.StringType):
        return F.to_json(value) if isinstance(old, (T.StructType, T.ArrayType)) else value.cast("string")
    if isinstance(old, T.StringType):
        return F.lit(None).cast(new)  # only a type that was not known is ever narrowed, and it has no values
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        had = {f.name: f.dataType for f in old.fields}
        parts = [
            (recast(value[f.name], had[f.name], f.dataType) if f.name in had else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in new.fields
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return F.transform(value, lambda x: recast(x, old.elementType, new.elementType))
    return value.cast(new)


class VersionedTable:
    """Parquet files of a folder, each below the version of the schema it was written with.

    A batch has a folder of its own below its version, so a replayed one takes its own place again.
    """

    def __init__(self, ledger: SchemaLedger, folder: str, extra: Schema | None = None):
        self.ledger, self.folder = ledger, folder.rstrip("/")
        self.spark = ledger.spark
        #: Columns of every version, such as provenance.
        self.extra = as_struct(self.spark, extra)

    def shape(self, version: int) -> T.StructType:
        return T.StructType([*storable(self.ledger.at(version)).fields, *self.extra.fields])

    def write_batch(self, rows: DataFrame, version: int, batch_id: int) -> None:
        fs, path = hadoop(self.spark, self.folder)
        for other in self.ledger.versions():
            if other != version:
                fs.delete(path(f"{self.folder}/v{other}/b{batch_id}"), True)
        rows.select(*[F.col(f"`{f.name}`") for f in self.shape(version).fields]).write.mode("overwrite").parquet(
            f"{self.folder}/v{version}/b{batch_id}"
        )

    def stored_versions(self) -> Iterable[int]:
        return [v for v in self.ledger.versions() if exists(self.spark, f"{self.folder}/v{v}")]

    def of_version(self, version: int) -> DataFrame:
        """Rows written under one version, as they were written."""
        reader = self.spark.read.schema(self.shape(version)).option("recursiveFileLookup", True)
        return reader.parquet(f"{self.folder}/v{version}")

    def read(self) -> DataFrame:
        """All rows under the latest version."""
        version, _ = self.ledger.latest()
        shape = self.shape(version)
        parts = []
        for v in self.stored_versions():
            rows = self.of_version(v)
            had = {f.name: f.dataType for f in rows.schema.fields}
            parts.append(
                rows.select(
                    *[
                        (recast(F.col(f"`{f.name}`"), had[f.name], f.dataType) if f.name in had else F.lit(None).cast(f.dataType)).alias(f.name)
                        for f in shape.fields
                    ]
                )
            )
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], shape)
