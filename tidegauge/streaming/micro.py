"""Live operators that take a micro-batch at a time, with state in a table.

A micro-batch is an ordinary DataFrame, so it goes through the same aggregates and
scans as recorded input: inside the JVM, with busy keys cut into slices. What a key
brings along from earlier batches is one row that stands for all its rows so far; it
is put before the new ones, so that no operator tells old from new.

Everything a batch writes lies under its number and is written over if the batch has
to be run again: results, any number of further sinks, the changes of the state and
the watermark. A batch counts once Spark has committed it. So whatever a failure
interrupts, readers see each batch once. State can be read as of any committed batch
while the query runs, and a query can start from state made elsewhere.

The watermark moves between batches: rows of a batch meet the one that earlier batches
have raised.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidegauge.functions.timeops import NO_WATERMARK, whole_div
from tidegauge.session import shared_folder

END_OF_TIME = 9223372036854775807
# The state is written whole once in so many batches, else only what changed.
WHOLE_EVERY = 16

Sink = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Batch:
    """The rows of a micro-batch, and what earlier ones have left.

    ``low`` is the least order number of its rows. ``before`` is the watermark its
    rows meet, ``after`` the one it leaves.
    """

    rows: DataFrame
    state: DataFrame | None
    low: int
    before: int
    after: int


@dataclass(frozen=True)
class Live:
    """A live operator.

    ``step`` makes of a batch its results and the changed rows of the state, which
    have a boolean ``gone``. ``raises`` is what a row raises the watermark to.
    """

    schema: str
    step: Callable[[Batch], tuple[DataFrame, DataFrame | None]]
    keys: tuple[str, ...] = ()
    state_schema: str | None = None
    raises: Column | None = None
    order: str = "seq"


# State and results in the shared folder


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], StructType.fromDDL(schema))


def _write(df: DataFrame, folder: str, batch: int, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(f"{folder}/batch={batch}")


def _read(spark: SparkSession, schema: str, folder: str, batches: Sequence[int]) -> DataFrame:
    paths = [f"{folder}/batch={b}" for b in batches]
    reader = spark.read.schema(StructType.fromDDL(f"{schema}, batch bigint"))
    return reader.option("basePath", folder).parquet(*paths)


def _changes_schema(live: Live) -> str:
    return f"{live.state_schema}, gone boolean"


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each key the row of the latest batch."""
    others = [c for c in rows.columns if c not in keys and c != "batch"]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch").alias("row"))
    return newest.filter(F.col("row").isNotNull()).select(*keys, "row.*")


def state_as_of(spark: SparkSession, live: Live, folder: str, batch: int) -> DataFrame:
    """The state after a batch: one row per key. Batch -1 is what the query started from."""
    whole = (batch + 1) // WHOLE_EVERY * WHOLE_EVERY - 1
    changes = _read(spark, _changes_schema(live), f"{folder}/state", range(whole, batch + 1))
    return _newest(changes, live.keys).filter(~F.col("gone")).drop("gone")


def committed(spark: SparkSession, checkpoint: str) -> int:
    """The number of the last batch that counts; -1 before the first."""
    try:
        log = spark.read.text(f"{checkpoint}/commits")
        number = F.regexp_extract(F.input_file_name(), r"(\d+)$", 1).cast("bigint")
        last = log.select(number.alias("n")).agg(F.max("n")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    return -1 if last is None else last


def read_results(
    spark: SparkSession, schema: str, folder: str, checkpoint: str, sink: str = "out"
) -> DataFrame:
    """The results of all batches that count, with their ``batch``."""
    last = committed(spark, checkpoint)
    whole = StructType.fromDDL(f"{schema}, batch bigint")
    return spark.read.schema(whole).parquet(f"{folder}/{sink}").filter(F.col("batch").between(0, last))


def newest_results(results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last result of each key, where later batches correct earlier ones."""
    return _newest(results, keys)


def table_sink(folder: str, of: Callable[[DataFrame], DataFrame]) -> Sink:
    """A further sink: what ``of`` makes of the results, in a table of its own."""
    return lambda results, batch: _write(of(results), folder, batch)


# Running


def _outcome(live: Live, rows: DataFrame, state: DataFrame | None, mark: int, ends: bool) -> tuple:
    raised = F.lit(None).cast("bigint") if live.raises is None else F.max(live.raises)
    low, top = rows.agg(F.min(live.order), raised).first()
    after = END_OF_TIME if ends else max(mark, NO_WATERMARK if top is None else top)
    batch = Batch(rows, state, (low or 0) - 1, mark, after)
    return *live.step(batch), after


def _run(live: Live, rows: DataFrame, number: int, folder: str, sinks: Sequence[Sink]) -> None:
    spark = rows.sparkSession
    # these are plain batch queries, which may adapt to what they meet
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    rows = rows.persist()
    try:
        state = state_as_of(spark, live, folder, number - 1) if live.state_schema else None
        mark = _read(spark, "mark bigint", f"{folder}/marks", [number - 1]).first()["mark"]
        results, changes, after = _outcome(live, rows, state, mark, False)
        _write(results, f"{folder}/out", number)
        if sinks:
            written = _read(spark, live.schema, f"{folder}/out", [number]).drop("batch")
            for sink in sinks:
                sink(written, number)
        if changes is not None:
            _write(changes.select(*StructType.fromDDL(_changes_schema(live)).names), f"{folder}/state", number)
            if (number + 1) % WHOLE_EVERY == 0:
                _make_whole(spark, live, folder, number)
        _write(spark.createDataFrame([(after,)], "mark bigint"), f"{folder}/marks", number)
    finally:
        rows.unpersist()


def _make_whole(spark: SparkSession, live: Live, folder: str, number: int) -> None:
    """Put the whole state in the place of a batch's changes, by way of another folder."""
    schema = _changes_schema(live)
    since = range(number - WHOLE_EVERY, number + 1)
    changes = _read(spark, schema, f"{folder}/state", since)
    whole = _newest(changes, live.keys).filter(~F.col("gone"))
    _write(whole, f"{folder}/whole", number)
    _write(_read(spark, schema, f"{folder}/whole", [number]).drop("batch"), f"{folder}/state", number)


def start(
    stream: DataFrame,
    live: Live,
    folder: str,
    checkpoint: str,
    name: str | None = None,
    every: str | None = None,
    initial: DataFrame | None = None,
    sinks: Sequence[Sink] = (),
) -> StreamingQuery:
    """Run a live operator over a stream; results, state and watermark go to ``folder``.

    With ``every`` (such as "10 seconds") it keeps running; without, it takes what is
    there and stops. ``initial`` is state to begin with, such as ``state_after`` makes of
    recorded rows; it is ignored where the folder has state already. ``sinks`` are
    called with the results of each batch and its number, again if it is run again.
    """
    spark = stream.sparkSession
    _write(_empty(spark, live.schema), f"{folder}/out", -1, "ignore")
    _write(spark.createDataFrame([(NO_WATERMARK,)], "mark bigint"), f"{folder}/marks", -1, "ignore")
    if live.state_schema:
        names = StructType.fromDDL(live.state_schema).names
        held = _empty(spark, live.state_schema) if initial is None else initial.select(*names)
        _write(held.withColumn("gone", F.lit(False)), f"{folder}/state", -1, "ignore")
    writer = stream.writeStream.foreachBatch(
        lambda rows, number: _run(live, rows, number, folder, sinks)
    ).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def finish(spark: SparkSession, live: Live, folder: str, batch: int) -> DataFrame:
    """What the operator would still give if the stream ended after a batch. Writes nothing."""
    mark = _read(spark, "mark bigint", f"{folder}/marks", [batch]).first()["mark"]
    state = state_as_of(spark, live, folder, batch)
    # an operator that waits for the watermark keeps no more of a row than its state
    rows = _empty(spark, "seq bigint, id string, timestamp bigint, temperature double")
    return _outcome(replace(live, raises=None), rows, state, mark, True)[0]


@dataclass(frozen=True)
class Replayed:
    """A live run over recorded rows, and where it left its tables."""

    spark: SparkSession
    live: Live
    folder: str

    @property
    def checkpoint(self) -> str:
        return f"{self.folder}/checkpoint"

    def results(self) -> DataFrame:
        return read_results(self.spark, self.live.schema, self.folder, self.checkpoint)

    def finished(self) -> DataFrame:
        """The results, and what is left when the stream ends."""
        last = committed(self.spark, self.checkpoint)
        return self.results().drop("batch").unionByName(finish(self.spark, self.live, self.folder, last))

    def state(self, batch: int | None = None) -> DataFrame:
        last = committed(self.spark, self.checkpoint) if batch is None else batch
        return state_as_of(self.spark, self.live, self.folder, last)


def replay(stream: DataFrame, live: Live, name: str, **options) -> Replayed:
    """Run a live operator over all that is there now."""
    run = Replayed(stream.sparkSession, live, shared_folder(stream.sparkSession, name))
    start(stream, live, run.folder, run.checkpoint, **options).awaitTermination()
    return run


def replay_in_steps(recorded: DataFrame, steps: int, live: Live, name: str, **options) -> Replayed:
    """Replay recorded rows as ``steps`` micro-batches in arrival order.

    Each step is written to the shared folder and the query is taken up again from its
    checkpoint. The first step takes all lower numbers, too.
    """
    spark = recorded.sparkSession
    run = Replayed(spark, live, shared_folder(spark, name))
    last = recorded.agg(F.max(live.order)).first()[0]
    step = F.greatest(whole_div(F.col(live.order), (last or 0) // steps + 1), F.lit(0))
    recorded.withColumn("step", step).write.partitionBy("step").parquet(f"{run.folder}/steps")
    source = f"{run.folder}/in"
    for i in range(steps):
        part = spark.read.schema(recorded.schema).parquet(f"{run.folder}/steps/step={i}*")
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(recorded.schema).parquet(source)
        start(stream, live, run.folder, run.checkpoint, **options).awaitTermination()
    return run
