"""Record schemas, ingest, and the mapping of recorded events to readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.timeops import HOUR, with_event_time

READING = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("temperature", T.DoubleType()),
    ]
)
SMOKE_LEVEL = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("level", T.StringType()),
    ]
)
SWITCH = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("duration_ms", T.LongType()),
    ]
)
EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# Which recorded events stand for which smoke level, and which
# event switches forwarding on.
SMOKE_HIGH = "error"
SMOKE_LOW = "signup"
SWITCH_ON = "signup"


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """Readings stored as Parquet, with the event time attached."""
    return with_event_time(spark.read.schema(READING).parquet(path))


def stream_readings(spark: SparkSession, path: str, **options) -> DataFrame:
    """Readings arriving as Parquet files (``maxFilesPerTrigger`` and the like)."""
    return with_event_time(spark.readStream.schema(READING).options(**options).parquet(path))


def stream_table(
    spark: SparkSession, folder: str, table: str, schema: T.StructType, **options
) -> DataFrame:
    """A recorded table as a live source, be it one file or a folder of files."""
    live = spark.readStream.schema(schema).options(**options)
    # a pattern, as the file source takes plain paths for folders
    return live.parquet(f"{folder}/{{{table}}}.parquet")


def stream_events(spark: SparkSession, folder: str, table: str = "events", **options) -> DataFrame:
    return stream_table(spark, folder, table, EVENT, **options)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines, one row each, in column ``value``."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """Text lines of files arriving in a folder, stamped once with their arrival."""
    lines = spark.readStream.options(**options).text(path)
    return lines.withColumn("arrival", F.current_timestamp())


def from_values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small stream written out in the program itself."""
    return spark.createDataFrame(rows, schema)


def _epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def _key() -> Column:
    return F.concat(F.lit("sensor_"), F.col("user_id").cast("string"))


def readings_of_events(events: DataFrame) -> DataFrame:
    """Each recorded event as one reading, in arrival order ``seq``."""
    return events.select(
        F.col("event_id").alias("seq"),
        _key().alias("id"),
        _epoch_ms(F.col("ts")).alias("timestamp"),
        F.col("value").alias("temperature"),
    )


def disordered(readings: DataFrame, unit_ms: int = HOUR, most: int = 7) -> DataFrame:
    """Readings whose event times are pushed ahead by up to ``most`` units.

    A fixed rule of the sequence number, so that every engine gets the same
    disorder.
    """
    seq = F.col("seq")
    whole = F.pmod(seq * F.lit(7919), F.lit(most)) * F.lit(unit_ms)
    part = F.pmod(seq * F.lit(104729), F.lit(unit_ms))
    return readings.withColumn("timestamp", F.col("timestamp") + whole + part)


def smoke_levels_of_events(events: DataFrame) -> DataFrame:
    control = events.filter(F.col("event_type").isin(SMOKE_HIGH, SMOKE_LOW))
    return control.select(
        F.col("event_id").alias("seq"),
        _epoch_ms(F.col("ts")).alias("timestamp"),
        F.when(F.col("event_type") == SMOKE_HIGH, "HIGH").otherwise("LOW").alias("level"),
    )


def smoke_readings_of_events(events: DataFrame) -> DataFrame:
    """The events that are readings, not smoke levels."""
    return readings_of_events(events.filter(~F.col("event_type").isin(SMOKE_HIGH, SMOKE_LOW)))


def switches_of_events(events: DataFrame, unit_ms: int = 12 * HOUR) -> DataFrame:
    control = events.filter(F.col("event_type") == SWITCH_ON)
    units = F.pmod(F.col("event_id"), F.lit(3)) + F.lit(1)
    return control.select(
        F.col("event_id").alias("seq"),
        _key().alias("id"),
        _epoch_ms(F.col("ts")).alias("timestamp"),
        (units * F.lit(unit_ms)).alias("duration_ms"),
    )


def switchable_readings_of_events(events: DataFrame) -> DataFrame:
    """The events that are readings, not switches."""
    return readings_of_events(events.filter(F.col("event_type") != SWITCH_ON))


def names_of_events(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_id").alias("seq"), F.col("event_type").alias("value"))


def triples_of_lineitem(lineitem: DataFrame) -> DataFrame:
    """``(f0, f1, f2)`` with an order: line number, then part.

    ``supplier`` breaks the ties the line number and part leave; rows equal in
    all of these and in the sum column are interchangeable.
    """
    return lineitem.select(
        (F.col("l_linenumber").cast("bigint") * F.lit(2**36) + F.col("l_partkey")).alias("seq"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_orderkey").alias("f0"),
        F.col("l_quantity").cast("int").alias("f1"),
        F.col("l_linenumber").alias("f2"),
    )


def lines_of_documents(documents: DataFrame, gap_ms: int = 100) -> DataFrame:
    """Document texts as lines; each document arrives ``gap_ms`` after the last.

    Each line stands between the document's source, with two spaces, and its
    language, with a tab, so that what separates words makes a difference.
    """
    lines = documents.select(
        F.explode(F.split("text", "\n")).alias("line"),
        (F.col("doc_id") * F.lit(gap_ms)).alias("arrival"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("lang", F.lit("")).alias("lang"),
    )
    value = F.concat("source", F.lit("  "), "line", F.lit("\t"), "lang")
    return lines.select(value.alias("value"), "arrival")
