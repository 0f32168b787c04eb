"""Live forms of the stateful operators, and how to run them.

Each takes a streaming DataFrame and returns one with the columns of the batch
operator. Rows per micro-batch are set at the source (``maxFilesPerTrigger``,
``maxOffsetsPerTrigger``), which also bounds what a busy key brings to a task.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidegauge.functions.scalar import reading_text
from tidegauge.functions.timeops import HOUR, MINUTE, SECOND, whole_div
from tidegauge.operators import windows
from tidegauge.operators.transforms import upper_names
from tidegauge.session import ROCKSDB, shared_folder
from tidegauge.streaming import processors as p

Job = Callable[[DataFrame], DataFrame]

READING_COLUMNS = ["seq", "id", "timestamp", "temperature"]


def _stateful(
    df: DataFrame, key: str, processor: StatefulProcessor, time_mode: str = "None"
) -> DataFrame:
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=processor.schema,
        outputMode="Append",
        timeMode=time_mode,
    )


def _watermarked(readings: DataFrame, bound_ms: int) -> DataFrame:
    delay = f"{bound_ms} milliseconds"
    return readings.select(*READING_COLUMNS, "event_time").withWatermark("event_time", delay)


def _all_rows(watermarked: DataFrame) -> DataFrame:
    """Rows without the watermark's column, which moves the watermark all the same.

    A stateful operator withholds rows by that column; without it, it is handed
    every row, however late.
    """
    return watermarked.select(*READING_COLUMNS)


def name_counts(names: DataFrame) -> DataFrame:
    return _stateful(upper_names(names), "value", p.NameCounter())


def rolling_sum(triples: DataFrame, order: list[str] | None = None) -> DataFrame:
    return _stateful(triples, "f0", p.RollingSum(order or ["seq"]))


def rolling_max_record(readings: DataFrame) -> DataFrame:
    return _stateful(readings.select(*READING_COLUMNS), "id", p.RollingMaxRecord())


def change_alerts(readings: DataFrame, threshold: float = 1.7) -> DataFrame:
    return _stateful(readings.select(*READING_COLUMNS), "id", p.ChangeAlert(threshold))


def self_cleaning_alerts(
    readings: DataFrame,
    threshold: float = 1.7,
    ttl_ms: int = HOUR,
    bound_ms: int = 5 * SECOND,
) -> DataFrame:
    rows = _all_rows(_watermarked(readings, bound_ms))
    return _stateful(rows, "id", p.SelfCleaningAlert(threshold, ttl_ms), "EventTime")


def rise_warnings(readings: DataFrame, duration_ms: int = SECOND) -> DataFrame:
    """On the cluster's clock; ``timestamp`` of a warning is when its timer was due."""
    rows = readings.select(*READING_COLUMNS)
    return _stateful(rows, "id", p.RiseMonitor(duration_ms), "ProcessingTime")


def forward_switched(readings: DataFrame, switches: DataFrame) -> DataFrame:
    both = readings.select(
        *READING_COLUMNS, F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("until")
    ).unionByName(
        switches.select(
            "seq",
            "id",
            "timestamp",
            F.lit(None).cast("double").alias("temperature"),
            F.lit(0).alias("kind"),
            (F.col("timestamp") + F.col("duration_ms")).alias("until"),
        )
    )
    return _stateful(both, "id", p.SwitchFilter())


def fire_alerts(
    readings: DataFrame, smoke_levels: DataFrame, above: float = 100, buckets: int = 32
) -> DataFrame:
    """Readings are dealt over ``buckets`` by their number; each gets all levels."""
    text = reading_text(F.col("id"), F.col("timestamp"), F.col("temperature"))
    hot = readings.filter(F.col("temperature") > above).select(
        F.pmod("seq", F.lit(buckets)).cast("int").alias("bucket"),
        "seq", "timestamp", "temperature", text.alias("text"),
        F.lit(None).cast("string").alias("level"),
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    levels = smoke_levels.select(
        every.alias("bucket"), "seq", "timestamp",
        F.lit(None).cast("double").alias("temperature"),
        F.lit(None).cast("string").alias("text"), "level",
    )
    return _stateful(hot.unionByName(levels), "bucket", p.FireAlert(above))


def tag_late(
    readings: DataFrame, bound_ms: int = 5 * SECOND, size_ms: int | None = None
) -> DataFrame:
    """Readings with ``is_late``; with ``size_ms``, late for their window.

    Two filters of the result are the main and the late output. The counts that
    go with the latter are ``updated_window_counts`` without lateness.
    """
    rows = _all_rows(_watermarked(readings, bound_ms))
    return _stateful(rows, "id", p.LateTagger(size_ms), "EventTime")


def tag_late_punctuated(
    readings: DataFrame, marker_id: str = "sensor_1", bound_ms: int = MINUTE
) -> DataFrame:
    """The same against a watermark that only rows of one key raise."""
    marked = readings.select(
        *READING_COLUMNS, F.when(F.col("id") == marker_id, F.col("event_time")).alias("raises")
    ).withWatermark("raises", f"{bound_ms} milliseconds")
    return _stateful(_all_rows(marked), "id", p.LateTagger(inclusive=True), "EventTime")


def updated_window_counts(
    readings: DataFrame,
    size_ms: int = 10 * SECOND,
    lateness_ms: int = 5 * SECOND,
    bound_ms: int = 5 * SECOND,
) -> DataFrame:
    rows = _all_rows(_watermarked(readings, bound_ms))
    return _stateful(rows, "id", p.UpdatingCount(size_ms, lateness_ms), "EventTime")


def early_window_counts(
    readings: DataFrame,
    size_ms: int = 30 * SECOND,
    tick_ms: int = SECOND,
    bound_ms: int = 5 * SECOND,
) -> DataFrame:
    rows = _all_rows(_watermarked(readings, bound_ms))
    return _stateful(rows, "id", p.EarlyCount(size_ms, tick_ms), "EventTime")


def window_max(
    readings: DataFrame, size_ms: int = 10 * SECOND, bound_ms: int = 5 * SECOND
) -> DataFrame:
    """Spark's own windowed aggregate; a window is emitted once it has closed."""
    return windows.window_max(_watermarked(readings, bound_ms), size_ms)


def latest_values(results: DataFrame) -> DataFrame:
    """Keeps the newest result per key in state, where ``read_state`` finds it."""
    return _stateful(results, "id", p.LatestValue())


def read_state(spark: SparkSession, checkpoint: str, variable: str = "value") -> DataFrame:
    """The state of a stopped query: one row per key."""
    state = (
        spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)
    )
    return state.select("key.*", "value.*")


def start(
    results: DataFrame,
    table: str,
    checkpoint: str,
    name: str | None = None,
    every: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Write a live result to a folder of Parquet files.

    With ``every`` (such as "10 seconds") it keeps running and takes a checkpoint
    each time; without, it takes what is there and stops. ``partitions`` is over
    how many tasks state is spread. It is fixed by the first start, and adaptive
    execution does not change it; by default it is the session's shuffle setting.
    """
    writer = results.writeStream.format("parquet").outputMode("append")
    if name:
        writer = writer.queryName(name)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    conf = results.sparkSession.conf
    before = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(partitions or before))
    try:
        # a query keeps the settings it was started with
        return writer.start(table)
    finally:
        conf.set("spark.sql.shuffle.partitions", before)


def show(results: DataFrame, label: str, every: str = "1 second") -> StreamingQuery:
    """Print a live result; the label is the query's name."""
    writer = results.writeStream.format("console").option("truncate", "false")
    return writer.queryName(label).trigger(processingTime=every).start()


def replay(job: DataFrame, name: str) -> DataFrame:
    """Run a live job over all that is there now; returns its output table."""
    spark = job.sparkSession
    folder = shared_folder(spark, name)
    cores = spark.sparkContext.defaultParallelism
    start(job, f"{folder}/out", f"{folder}/checkpoint", partitions=cores).awaitTermination()
    return spark.read.schema(job.schema).parquet(f"{folder}/out")


def replay_in_steps(
    recorded: DataFrame, steps: int, job: Job, name: str, flush_after_ms: int
) -> DataFrame:
    """Replay recorded readings as ``steps`` micro-batches in arrival order.

    The watermark moves between steps. Each step is written to the shared folder
    and the job is taken up again from its checkpoint. A last reading, of a new
    key that is left out of the result, is ``flush_after_ms`` later than all others,
    so that windows still open are closed.
    """
    spark = recorded.sparkSession
    folder = shared_folder(spark, name)
    source, out, checkpoint = (f"{folder}/{part}" for part in ("in", "out", "checkpoint"))
    flush_key = f"flush-{uuid.uuid4().hex}"
    rows = recorded.select(*READING_COLUMNS)
    top = rows.agg(F.max("seq").alias("seq"), F.max("timestamp").alias("timestamp"))
    last = top.first()["seq"]
    flush = top.select(
        (F.col("seq") + 1).alias("seq"),
        F.lit(flush_key).alias("id"),
        (F.col("timestamp") + F.lit(flush_after_ms)).alias("timestamp"),
        F.lit(0.0).alias("temperature"),
    )
    width = (last or 0) // steps + 1
    # the first step takes all lower numbers, too
    step = F.greatest(whole_div(F.col("seq"), width), F.lit(0))
    parts = [rows.filter(step == i) for i in range(steps)]
    result = None
    for part in [*parts, flush]:
        part.write.mode("append").parquet(source)
        live = spark.readStream.schema(rows.schema).parquet(source)
        result = job(live.withColumn("event_time", F.timestamp_millis("timestamp")))
        cores = spark.sparkContext.defaultParallelism
        start(result, out, checkpoint, partitions=cores).awaitTermination()
    ours = F.col("id").eqNullSafe(flush_key)
    return spark.read.schema(result.schema).parquet(out).filter(~ours)
