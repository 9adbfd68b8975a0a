"""File and table readers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .schemas import Schema, SchemaLedger, VersionedTable, infer_text, join_structs

# Types of landed trades; a reader with an explicit schema needs no inference pass.
LANDED = (
    "event_type string, event_time bigint, symbol string, trade_id bigint, price double, quantity double, "
    "buyer_order_id bigint, seller_order_id bigint, trade_time bigint, is_buyer_maker boolean, "
    "trade_value double, ingestion_time bigint, producer_id string"
)
RAW = LANDED + ", trade_timestamp timestamp, processing_time timestamp"


def _with_corrupt(schema: Schema, column: str | None) -> str | StructType:
    if column is None:
        return schema
    if isinstance(schema, StructType):
        return StructType(list(schema.fields)).add(column, "string")
    return f"{schema}, {column} string"


def read_csv(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """CSV with a header; without a schema the types are inferred, which reads the files twice."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def load_csv(
    spark: SparkSession,
    path: str,
    schema: Schema | None,
    table_path: str,
    ledger: str,
    hints: Schema | None = None,
    max_files: int = 1000,
) -> DataFrame:
    """Load the files of a folder into a table, each file once however often this runs.

    The stream's checkpoint is the ledger: a later run picks up new files only, and a
    failed run neither loses nor repeats a file. Returns the table loaded so far.

    Without ``schema`` the types are found in the files, in one aggregate per set of new files, and kept with the ledger;
    ``hints`` fix the types of some columns. Files with further columns or wider values go on under the next version of
    the schema, and no file is read for it again.
    """
    from ..sinks.tables import with_provenance

    if schema is None:
        return _load_inferred(spark, path, table_path, ledger, hints, max_files)
    source = spark.readStream.schema(schema).option("header", True).csv(path)
    loaded = with_provenance(source)
    query = (
        loaded.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", ledger)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(loaded.schema).parquet(table_path)


#: What a reader of whole files tells of them.
FOUND = "path string, modificationTime timestamp, length bigint, content binary"
PROVENANCE = "_ingestion_timestamp timestamp, _source_file string"


def _load_inferred(spark: SparkSession, path: str, table_path: str, ledger: str, hints: Schema | None, max_files: int) -> DataFrame:
    versions = SchemaLedger(spark, f"{ledger}/schemas", hints, ("_ingestion_timestamp", "_source_file"))
    table = VersionedTable(versions, table_path, PROVENANCE)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # At most ``max_files`` names. The heads are read first, as files may have different columns.
        alike: dict[tuple[str, ...], list[str]] = {}
        for (name,) in batch.collect():
            head = tuple(spark.read.option("header", True).csv(name).columns)
            if head:
                alike.setdefault(head, []).append(name)
        texts = [_as_text(spark, head, names) for head, names in alike.items()]
        if texts:
            found = reduce(join_structs, [infer_text(t.drop("_ingestion_timestamp", "_source_file")) for t in texts])
            version, _ = versions.merge(found)
            shape = table.shape(version)
            typed = [t.select(*[_typed(t, f.name, f.dataType) for f in shape.fields]) for t in texts]
            table.write_batch(reduce(DataFrame.unionByName, typed), version, batch_id)

    # Names only: what the files hold is read by the loads themselves.
    names = spark.readStream.format("binaryFile").schema(FOUND).option("maxFilesPerTrigger", max_files).load(path).select("path")
    query = names.writeStream.foreachBatch(handle).option("checkpointLocation", f"{ledger}/files").trigger(availableNow=True).start()
    query.awaitTermination()
    return table.read()


def _as_text(spark: SparkSession, head: tuple[str, ...], names: list[str]) -> DataFrame:
    from ..sinks.tables import with_provenance

    text = StructType([StructField(c, StringType()) for c in head])
    return with_provenance(spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(names))


def _typed(rows: DataFrame, name: str, kind) -> Column:
    has = {c.lower() for c in rows.columns}
    value = F.col(f"`{name}`") if name.lower() in has else F.lit(None).cast("string")
    return (value if name in ("_ingestion_timestamp", "_source_file") else value.cast(kind)).alias(name)


def read_ndjson(
    spark: SparkSession, path: str, schema: Schema | None = None, corrupt_col: str | None = None
) -> DataFrame:
    """NDJSON files; lines that do not parse are kept in ``corrupt_col`` when one is named."""
    reader = spark.read.option("mode", "PERMISSIVE")
    if corrupt_col is not None:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return (reader.schema(_with_corrupt(schema, corrupt_col)) if schema else reader).json(path)


def trade_stream(
    spark: SparkSession,
    path: str,
    schema: Schema = LANDED,
    max_files: int | None = None,
    corrupt_col: str | None = None,
) -> DataFrame:
    """New NDJSON files of a folder as a stream."""
    reader = spark.readStream.schema(_with_corrupt(schema, corrupt_col)).option("mode", "PERMISSIVE")
    if corrupt_col is not None:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def line_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of the new files of a folder as a stream, with the file they came from; for ``parse_lines``."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select("value", F.col("_metadata.file_name").alias("_source_file"))


def message_stream(spark: SparkSession, path: str) -> DataFrame:
    """Raw message lines of a folder as a stream, for ``normalise_trades``."""
    return spark.readStream.text(path).withColumnRenamed("value", "message")


def catalog_stream(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table as a stream."""
    return spark.readStream.table(table)


def table_stream(spark: SparkSession, path: str, schema: Schema = RAW, max_files: int | None = None) -> DataFrame:
    """A table folder as a stream; several streams may read one table."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
