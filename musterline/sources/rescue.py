"""JSON lines under a schema, field by field: what does not fit is kept beside the columns.

A line is parsed once, to a variant. The schema is walked over it: a value goes to its column if it has the column's type
without losing anything. Fields that the schema lacks and values of another type are kept, under their path, in one more
column; lines that are no JSON object are kept as they are in another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import storable

RESCUED = "_rescued"
CORRUPT = "_corrupt"

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIME = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _get(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind)


def _field(value: Column, name: str) -> Column:
    """A field of an object; null if it is absent."""
    if "'" in name or "\\" in name:  # no path can name it
        return _get(value, "map<string,variant>")[name]
    return F.try_variant_get(value, f"$['{name}']", "variant")


def _is(value: Column, *kinds: str) -> Column:
    kind = F.schema_of_variant(value)
    found = F.lit(False)
    for k in kinds:
        found = found | (kind.startswith(k) if k in ("DECIMAL", "OBJECT", "ARRAY") else kind == k)
    return F.coalesce(found, F.lit(False))


def fitted(value: Column, kind: T.DataType) -> Column:
    """A variant as a value of ``kind``; null where it is none."""
    name = kind.simpleString()
    if isinstance(kind, T.StructType):
        parts = [fitted(_field(value, f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(_is(value, "OBJECT"), F.struct(*parts))
    if isinstance(kind, T.ArrayType):
        return F.when(fits(value, kind), F.transform(_get(value, "array<variant>"), lambda x: fitted(x, kind.elementType)))
    if isinstance(kind, T.StringType):
        # Text holds everything; values of other kinds as JSON.
        return F.when(_is(value, "STRING"), _get(value, "string")).when(~_is(value, "VOID"), F.to_json(value))
    if isinstance(kind, _WHOLE):
        return F.when(_is(value, "BIGINT"), _get(value, name))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        number = _get(value, name)
        exact = _is(value, "BIGINT") & (number.cast("decimal(38,0)") == _get(value, "decimal(38,0)"))
        return F.when(_is(value, "DOUBLE", "FLOAT", "DECIMAL") | exact, number)
    if isinstance(kind, T.DecimalType):
        number = _get(value, name)
        return F.when(_is(value, "BIGINT", "DECIMAL") & (number.cast("string").cast("double") == _get(value, "double")), number)
    if isinstance(kind, T.BooleanType):
        return F.when(_is(value, "BOOLEAN"), _get(value, "boolean"))
    if isinstance(kind, _TIME):
        return F.when(_is(value, "STRING"), _get(value, "string").try_cast(name))
    return _get(value, name)


def fits(value: Column, kind: T.DataType) -> Column:
    """Whether a variant can be held by ``kind``; JSON's null always can."""
    if isinstance(kind, T.ArrayType):
        whole = F.forall(_get(value, "array<variant>"), lambda x: fits(x, kind.elementType))
        return _is(value, "VOID") | (_is(value, "ARRAY") & F.coalesce(whole, F.lit(False)))
    if isinstance(kind, T.StructType):
        # Within an array an object must fit as a whole; elsewhere its fields are judged one by one.
        known = {f.name: f.dataType for f in kind.fields}
        entries = F.map_entries(_get(value, "map<string,variant>"))

        def fine(e: Column) -> Column:
            held = F.lit(False)
            for name, t in known.items():
                held = held | ((e["key"] == name) & fits(e["value"], t))
            return held

        return _is(value, "VOID") | (_is(value, "OBJECT") & F.coalesce(F.forall(entries, fine), F.lit(False)))
    return _is(value, "VOID") | fitted(value, kind).isNotNull()


def _left_over(value: Column, schema: T.StructType, path: str = "") -> list[Column]:
    """Maps of path to value of what ``schema`` does not hold, one per nesting."""
    kinds = {f.name: f.dataType for f in schema.fields}

    def held(key: Column, x: Column) -> Column:
        out = F.lit(False)
        for name, kind in kinds.items():
            inside = _is(x, "OBJECT", "VOID") if isinstance(kind, T.StructType) else fits(x, kind)
            out = out | ((key == name) & inside)
        return out

    extra = F.map_filter(_get(value, "map<string,variant>"), lambda k, x: ~held(k, x))
    # A name with a dot is quoted, so that no two paths are the same.
    quoted = lambda k: F.when(k.rlike("[.`]"), F.concat(F.lit("`"), F.replace(k, F.lit("`"), F.lit("``")), F.lit("`"))).otherwise(k)
    maps = [F.transform_keys(extra, lambda k, _: F.concat(F.lit(path), quoted(k)))]
    for name, kind in kinds.items():
        if isinstance(kind, T.StructType):
            maps += _left_over(_field(value, name), kind, f"{path}{name}.")
    return maps


def parse_lines(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Columns of ``schema``, then ``_rescued`` (JSON by path, null if all fitted) and ``_corrupt``; other columns are kept.

    Nothing of a line is lost: what is in no column is in one of these two. Names count exactly, so a field that differs
    from a column in case alone is rescued.
    """
    schema = storable(schema)
    kept = [c for c in lines.columns if c != column]
    # A generated column, so that the text is parsed once however often it is used.
    parsed = F.try_parse_json(F.when(F.ltrim(column).startswith("{"), F.col(column)))
    rows = lines.select(*kept, F.col(column).alias("_line"), F.explode(F.array(parsed)).alias("_v"))
    v = F.col("_v")
    nothing = F.create_map().cast("map<string,variant>")
    rest = F.map_concat(*[F.coalesce(m, nothing) for m in _left_over(v, schema)])
    return rows.select(
        *[fitted(_field(v, f.name), f.dataType).alias(f.name) for f in schema.fields],
        F.to_json(F.when(F.size(rest) > 0, rest)).alias(RESCUED),
        F.when(v.isNull(), F.col("_line")).alias(CORRUPT),
        *kept,
    )
