"""Table and stream readers. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislecast.contracts import REVIEWS, SALES, TRUTH, require_columns


def read_sales_csv(spark: SparkSession, path: str, schema: T.StructType = SALES) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_reviews_csv(spark: SparkSession, path: str) -> DataFrame:
    """Quoted review text; line breaks inside quotes are part of the text."""
    return (
        spark.read.schema(REVIEWS)
        .options(header=True, quote='"', escape='"', multiLine=True, enforceSchema=False)
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str, contract: T.StructType | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if contract is None else require_columns(df, contract, path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType = TRUTH) -> DataFrame:
    """Files that each hold one JSON array of records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_any(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """Any format the cluster has a reader for, Delta or JDBC included."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def stream_buffer(
    spark: SparkSession,
    folder: str,
    pattern: str,
    schema: T.StructType,
    arrays: bool = True,
    max_files: int | None = None,
    clean: str = "off",
    archive: str | None = None,
) -> DataFrame:
    """Buffer files that match the pattern, as a stream.

    ``arrays`` reads files that hold one JSON array each; without it a file
    has one record per line and can be split. ``clean`` is what happens to
    consumed files: off, delete or archive.
    """
    options = {"multiLine": str(arrays).lower(), "pathGlobFilter": pattern, "cleanSource": clean}
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    if archive:
        options["sourceArchiveDir"] = archive
    with_bad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.readStream.schema(with_bad).options(**options).json(folder)


def kafka_events(
    spark: SparkSession,
    servers: str,
    topics: tuple[str, ...] = ("pos-events", "iot-stock-events"),
    group: str = "aislecast-landing",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Both topics from the earliest offset: (topic, value as text).

    Needs the Kafka connector on the class path.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "groupIdPrefix": group,
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return (
        spark.readStream.format("kafka")
        .options(**options)
        .load()
        .select("topic", F.col("value").cast("string").alias("value"))
    )


def parse_events(raw: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON text -> event columns. Text that does not parse is kept aside."""
    with_bad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return raw.select(F.from_json(F.col(value), with_bad, options).alias("e")).select("e.*")
