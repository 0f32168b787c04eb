"""

Only wiring: the operators are in ``tidegauge``. Time parameters are the
operators' own with one second scaled to one hour, as the recorded events are
spread over 30 days; a few that need longer state so below.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions import opaque
from tidegauge.functions.scalar import (
    ONE_SPACE,
    WHITESPACE,
    round_half_down,
    round_half_up,
)
from tidegauge.functions.timeops import HOUR, tumbling, window_end
from tidegauge.operators import (
    alerts,
    control,
    early,
    late,
    latest,
    rolling,
    transforms,
    windows,
)
from tidegauge.plans import watermarks
from tidegauge.session import prepare, shared_folder
from tidegauge.sources import kafka
from tidegauge.sources import lines as growing
from tidegauge.sources import readings as src
from tidegauge.streaming import jobs, micro
from tidegauge.streaming import operators as live

try:
    import corpus_pipeline
    from tidegauge.llm import queries as corpus
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tidegauge.llm"):
        raise
    corpus_pipeline = corpus = None

DAY = 24 * HOUR
BOUND = 5 * HOUR
LATENESS = 5 * HOUR
# A step is a micro-batch of a live replay; the SQL cuts the rows in the same steps.
STEPS = 7
FEW_STEPS = 3
# Values that occur, so that a limit that counts and one that doesn't differ.
LIMIT = 6.55
SHOWN = [f"sensor_{i}" for i in range(1, 6)]

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.schema(src.EVENT).parquet(f"{sf_dir}/events.parquet")


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.readings_of_events(_events(spark, sf_dir))


def _disordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.disordered(_readings(spark, sf_dir))


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermarks.bounded_watermark(_disordered(spark, sf_dir), BOUND)


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.latest_per_key(windows.window_max(_readings(spark, sf_dir), 10 * HOUR))


def _on_readings(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_readings(spark, sf_dir))


def _on_disordered(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_disordered(spark, sf_dir))


def _on_marked(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_marked(spark, sf_dir))


def _on_events(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_events(spark, sf_dir))


def _on_lines(operator: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        documents = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
        return operator(src.lines_of_documents(documents))

    return run


def _rounded(averages: DataFrame) -> DataFrame:
    """Means to six places: the order of summing shows beyond that."""
    return averages.withColumn("temperature", F.round("temperature", 6))


def _rolling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = prepare(spark).read.parquet(f"{sf_dir}/lineitem.parquet")
    order = ["seq", "supplier", "f1"]
    return rolling.rolling_sum(src.triples_of_lineitem(lineitem), order)


def _self_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = _marked(spark, sf_dir)
    return alerts.self_cleaning_alerts(marked, 1.7, DAY, base=_readings(spark, sf_dir))


def _fire_alerts(events: DataFrame) -> DataFrame:
    return control.fire_alerts(
        src.smoke_readings_of_events(events), src.smoke_levels_of_events(events)
    )


def _switch_forward(events: DataFrame) -> DataFrame:
    return control.forward_switched(
        src.switchable_readings_of_events(events), src.switches_of_events(events)
    )


def _name_counts(events: DataFrame) -> DataFrame:
    return rolling.name_counts(src.names_of_events(events))


def _kafka_encode(events: DataFrame) -> DataFrame:
    records = kafka.encode_counts(_name_counts(events))
    return records.select(F.hex("key").alias("key_hex"), F.hex("value").alias("value_hex"))


def _kafka_decode(events: DataFrame) -> DataFrame:
    """Encoded counts, laid out over three partitions as a topic would, and read back."""
    counts = _name_counts(events)
    place = [
        F.pmod("seq", F.lit(3)).cast("int").alias("partition"),
        F.call_function("div", F.col("seq"), F.lit(3)).alias("offset"),
    ]
    encoded = kafka.encode_counts(counts)
    records = counts.select(
        F.encode("name", "UTF-8").alias("key"), *place, "count"
    ).withColumn("value", kafka.int_to_bytes(F.col("count")))
    return kafka.decode_counts(records.select(*encoded.columns, "partition", "offset"))


Operator = Callable[[], live.Live]  # made once there is a session


def _live(operator: Operator, of: Callable[[DataFrame], DataFrame]) -> Query:
    """Run a live operator over what ``of`` makes of the event table, to its end."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        stream = of(src.stream_events(prepare(spark), sf_dir))
        return micro.replay(stream, operator(), "live").results().drop("batch")

    return run


def _stream_tumbling_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All at once, for in order no row is late; the last reading closes all windows."""
    return jobs.replay_in_steps(
        _readings(spark, sf_dir),
        1,
        lambda r: jobs.window_max(r, 10 * HOUR, BOUND),
        "tumbling_max",
        10 * DAY,
    )


def _stream_rolling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = prepare(spark).read.parquet(f"{sf_dir}/lineitem.parquet").schema
    triples = src.triples_of_lineitem(src.stream_table(spark, sf_dir, "lineitem", schema))
    operator = live.rolling_sum(["seq", "supplier", "f1"])
    return micro.replay(triples, operator, "rolling_sum").results().drop("batch")


def _stepped(spark: SparkSession, sf_dir: str, operator: live.Live, steps: int) -> micro.Replayed:
    """Run a live operator over the disordered readings, in a few arrival steps."""
    return micro.replay_in_steps(_disordered(spark, sf_dir), steps, operator, "stepped")


def _in_steps(operator: Operator, steps: int = STEPS) -> Query:
    return lambda spark, sf_dir: _stepped(spark, sf_dir, operator(), steps).results().drop("batch")


def _to_the_end(operator: Operator, steps: int = STEPS) -> Query:
    """With what windows still open give when the stream ends."""
    return lambda spark, sf_dir: _stepped(spark, sf_dir, operator(), steps).finished()


def _stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest count of each window, of results that later batches correct."""
    run = _stepped(spark, sf_dir, live.changing_window_counts(10 * HOUR), FEW_STEPS)
    return micro.newest_results(run.results(), ["id", "end_ts"])


def _stream_latest_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A look-up in the state as it was after the second of a few batches."""
    run = _stepped(spark, sf_dir, live.latest_max(10 * HOUR), FEW_STEPS)
    return latest.lookup(run.state(1), SHOWN)


def _stream_resumed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the first half of the names in batch, of the others live from the state that left."""
    names = src.names_of_events(_events(spark, sf_dir))
    half = (names.agg(F.max("seq")).first()[0] or 0) // 2
    recorded, operator = names.filter(F.col("seq") < half), live.name_counts()
    rest = src.names_of_events(src.stream_events(spark, sf_dir)).filter(F.col("seq") >= half)
    run = micro.replay(rest, operator, "resumed", initial=live.state_after(operator, recorded))
    return rolling.name_counts(recorded).unionByName(run.results().drop("batch"))


def _stream_growing_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of lines that are appended to a folder in two goes, each read as it comes."""
    documents = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    recorded = src.lines_of_documents(documents)
    folder = shared_folder(spark, "growing")
    words = None
    for half in (0, 1):
        part = recorded.filter(F.pmod("arrival", F.lit(200)) == 100 * half).select("value")
        part.write.mode("append").text(f"{folder}/in")
        live_lines = growing.stream_growing_lines(spark, f"{folder}/in")
        words = transforms.words(live_lines.select("value"), ONE_SPACE)
        jobs.start(words, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(words.schema).parquet(f"{folder}/out")


def _stream_two_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts in a table to look at, and as Kafka records in another, both from one query."""
    names = src.names_of_events(src.stream_events(prepare(spark), sf_dir))
    folder = shared_folder(spark, "two_sinks")
    operator, checkpoint = live.name_counts(), f"{folder}/checkpoint"
    sinks = [
        micro.table_sink(f"{folder}/shown", lambda r: r.select("name", "count")),
        micro.table_sink(f"{folder}/encoded", kafka.encode_counts),
    ]
    micro.start(names, operator, folder, checkpoint, sinks=sinks).awaitTermination()
    shown = micro.read_results(spark, "name string, count bigint", folder, checkpoint, "shown")
    encoded = micro.read_results(spark, "key binary, value binary", folder, checkpoint, "encoded")
    return shown.select(
        F.lit("shown").alias("sink"), F.col("name").alias("key"), F.col("count").cast("string").alias("value")
    ).unionByName(
        encoded.select(F.lit("encoded").alias("sink"), F.hex("key").alias("key"), F.hex("value").alias("value"))
    )


class MeanOf:
    """A mean as a user would write it: an accumulator with a sum and a count."""

    def create(self) -> tuple[float, int]:
        return 0.0, 0

    def add(self, state: tuple[float, int], value: float | None) -> tuple[float, int]:
        return state if value is None else (state[0] + value, state[1] + 1)

    def merge(self, one: tuple[float, int], other: tuple[float, int]) -> tuple[float, int]:
        return one[0] + other[0], one[1] + other[1]

    def result(self, state: tuple[float, int]) -> tuple[float | None]:
        return (state[0] / state[1] if state[1] else None,)


def _lowest_and_highest(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterable[tuple]:
    """A window's function as a user would write it."""
    found = [pc.min_max(batch.column("temperature")) for batch in batches]
    yield min(f["min"].as_py() for f in found), max(f["max"].as_py() for f in found)


def _words_of(line: str) -> Iterable[tuple]:
    """A splitter as a user would write it: on white space; trailing empty words go."""
    words = re.split(r"[ \t\n\x0b\f\r]+", line)
    while len(words) > 1 and not words[-1]:
        words.pop()
    return [(word, 1) for word in words] if words[0] or len(words) > 1 or not line else []


def _windowed(readings: DataFrame, size_ms: int) -> DataFrame:
    return readings.withColumn("end_ts", window_end(F.col("timestamp"), size_ms))


def _opaque_avg(readings: DataFrame) -> DataFrame:
    placed = _windowed(readings, 15 * HOUR)
    return _rounded(
        opaque.aggregate(placed, ["id", "end_ts"], MeanOf(), ["temperature"], "temperature double")
    )


def _opaque_minmax(readings: DataFrame) -> DataFrame:
    return opaque.apply_windows(
        _windowed(readings, 5 * HOUR),
        ["id", "end_ts"],
        _lowest_and_highest,
        ["temperature"],
        "min double, max double",
    )


def _opaque_words(lines: DataFrame) -> DataFrame:
    made = opaque.flat_map(lines.select("value"), _words_of, ["value"], "word string, count int")
    return made.select("word", "count")


def _opaque_celsius(readings: DataFrame) -> DataFrame:
    converted = opaque.map_values(lambda f: (f - 32.0) * (5.0 / 9.0), "double")
    return readings.withColumn("temperature", converted("temperature"))


def _display(rounding: Callable) -> Callable[[DataFrame], DataFrame]:
    """To one place, where readings of two places have ties."""
    return lambda readings: readings.select(
        "seq", rounding(F.col("temperature"), 1).alias("temperature")
    )


def entry(spark: SparkSession) -> DataFrame:
    """First and updated counts per window, from out-of-order readings."""
    return queries()["late_update_counts"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    found = _own_queries()
    if corpus:
        found |= corpus.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def _own_queries() -> dict[str, Query]:
    return {
        # sources
        "readings": _on_readings(lambda r: r),
        "smoke_levels": _on_events(src.smoke_levels_of_events),
        # transformations
        "filter_gt": _on_readings(lambda r: transforms.filter_by_threshold(r, LIMIT)),
        "filter_ge": _on_readings(lambda r: transforms.filter_by_threshold(r, LIMIT, True)),
        "project_id": _on_readings(transforms.project_id),
        "split_id": _on_readings(lambda r: transforms.split_id(transforms.project_id(r))),
        "filter_project_split": _on_readings(transforms.filter_project_split),
        "split_words_java": _on_lines(lambda t: transforms.words(t.select("value"), ONE_SPACE)),
        "split_words_ws": _on_lines(lambda t: transforms.words(t.select("value"), WHITESPACE)),
        "to_celsius": _on_readings(transforms.celsius),
        "freezing_alarms": _on_readings(lambda r: transforms.monitor_freezing(r)[1]),
        "round_half_up": _on_readings(_display(round_half_up)),
        "round_half_down": _on_readings(_display(round_half_down)),
        # tumbling windows
        "tumbling_min": _on_readings(lambda r: windows.window_min(r, 15 * HOUR)),
        "tumbling_max": _on_readings(lambda r: windows.window_max(r, 10 * HOUR)),
        "tumbling_avg": _on_readings(lambda r: _rounded(windows.window_avg(r, 15 * HOUR))),
        "tumbling_minmax": _on_readings(lambda r: windows.window_minmax(r, 5 * HOUR)),
        "tumbling_count": _on_readings(lambda r: windows.window_count(r, 10 * HOUR)),
        "avg_celsius": _on_readings(lambda r: _rounded(windows.avg_celsius(r, HOUR))),
        "word_count_java": _on_lines(lambda t: windows.word_counts(t, ONE_SPACE)),
        "word_count_ws": _on_lines(lambda t: windows.word_counts(t, WHITESPACE)),
        "custom_window_count": _on_readings(
            lambda r: windows.assigned_aggregate(
                r, tumbling(30 * HOUR), {"cnt": F.count(F.lit(1))}
            )
        ),
        # rolling values
        "rolling_sum": _rolling_sum,
        "rolling_max_record": _on_readings(rolling.rolling_max_record),
        "running_count": _on_events(_name_counts),
        # watermarks and late data
        "watermark_bounded": _on_disordered(
            lambda r: watermarks.bounded_watermark(r, BOUND).select("seq", "wm")
        ),
        "watermark_periodic": _on_disordered(
            lambda r: watermarks.periodic_watermark(r, 60 * HOUR).select("seq", "wm")
        ),
        "watermark_punctuated": _on_disordered(
            lambda r: watermarks.punctuated_watermark(r, "sensor_1", 60 * HOUR).select("seq", "wm")
        ),
        "late_flag": _on_marked(
            lambda m: m.select("seq", "id", "timestamp", late.is_late().alias("is_late"))
        ),
        "late_on_time": _on_marked(lambda m: late.split_late(m)[0]),
        "late_messages": _on_marked(lambda m: transforms.late_messages(late.split_late(m)[1])),
        "late_window_counts": _on_marked(lambda m: late.window_count_with_late(m, 10 * HOUR)[0]),
        "late_window_rows": _on_marked(lambda m: late.window_count_with_late(m, 10 * HOUR)[1]),
        "late_update_counts": _on_marked(
            lambda m: late.updated_window_counts(m, 10 * HOUR, LATENESS)
        ),
        "early_fire_counts": _on_marked(
            lambda m: early.early_window_counts(m, BOUND, 240 * HOUR, DAY)
        ),
        # keyed state, timers and control streams
        "temp_change_alerts": _on_readings(alerts.change_alerts),
        "self_cleaning_alerts": _self_cleaning,
        "rise_warnings": _on_readings(lambda r: alerts.rise_warnings(r, DAY)),
        "fire_alerts": _on_events(_fire_alerts),
        "switch_forward": _on_events(_switch_forward),
        # latest values
        "latest_max_per_key": _latest,
        "latest_lookup": lambda spark, sf_dir: latest.lookup(_latest(spark, sf_dir), SHOWN),
        "dashboard_pivot": lambda spark, sf_dir: latest.dashboard(_latest(spark, sf_dir), SHOWN),
        # user functions in Python
        "opaque_map_celsius": _on_readings(_opaque_celsius),
        "opaque_flat_map_words": _on_lines(_opaque_words),
        "opaque_aggregate_avg": _on_readings(_opaque_avg),
        "opaque_window_minmax": _on_readings(_opaque_minmax),
        # the same operators run live
        "stream_tumbling_max": _stream_tumbling_max,
        "stream_running_count": _live(live.name_counts, src.names_of_events),
        "stream_rolling_max_record": _live(live.rolling_max_record, src.readings_of_events),
        "stream_temp_change_alerts": _live(live.change_alerts, src.readings_of_events),
        "stream_switch_forward": _live(
            live.forward_switched,
            lambda e: live.with_switches(
                src.switchable_readings_of_events(e), src.switches_of_events(e)
            ),
        ),
        "stream_fire_alerts": _live(
            live.fire_alerts,
            lambda e: live.with_levels(
                src.smoke_readings_of_events(e), src.smoke_levels_of_events(e)
            ),
        ),
        "stream_rolling_sum": _stream_rolling_sum,
        "stream_late_update_counts": _to_the_end(
            lambda: live.updated_window_counts(10 * HOUR, LATENESS, 0)
        ),
        "stream_early_fire_counts": _in_steps(lambda: live.early_window_counts(240 * HOUR, DAY, 0)),
        "stream_self_cleaning_alerts": _in_steps(lambda: live.self_cleaning_alerts(1.7, HOUR, 0)),
        "stream_late_flag": _in_steps(lambda: live.tag_late(0), FEW_STEPS),
        "stream_late_window_rows": _in_steps(lambda: live.tag_late(0, 10 * HOUR), FEW_STEPS),
        "stream_late_punctuated": _in_steps(
            lambda: live.tag_late_punctuated("sensor_1", 60 * HOUR), FEW_STEPS
        ),
        "stream_window_counts": _stream_window_counts,
        "stream_latest_lookup": _stream_latest_lookup,
        "stream_resumed_counts": _stream_resumed_counts,
        "stream_two_sinks": _stream_two_sinks,
        "stream_growing_words": _stream_growing_words,
        # Kafka record format
        "kafka_encode_counts": _on_events(_kafka_encode),
        "kafka_decode_counts": _on_events(_kafka_decode),
    }


# The recorded events as readings, as the SQL engine sees them.
_READINGS = """
readings AS (
  SELECT event_id AS seq, 'sensor_' || user_id AS id,
         epoch_us(ts) // 1000 AS "timestamp", value AS temperature
  FROM events)"""

_DISORDERED = _READINGS + """,
disordered AS (
  SELECT seq, id, temperature,
         "timestamp" + (seq * 7919 % 7) * 3600000 + (seq * 104729 % 3600000) AS "timestamp"
  FROM readings)"""


def _sql_watermark(raises_to: str) -> str:
    return f"""
marked AS (
  SELECT seq, id, "timestamp", temperature,
         coalesce(max({raises_to}) OVER (ORDER BY seq
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -9223372036854775807) AS wm,
         max({raises_to}) OVER (ORDER BY seq
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wm_after
  FROM disordered)"""


_MARKED = _DISORDERED + "," + _sql_watermark(f'"timestamp" - {BOUND} - 1')


def _sql_end(size_ms: int) -> str:
    return f'"timestamp" - "timestamp" % {size_ms} + {size_ms}'


def _sql_window(size_ms: int, aggregates: str, source: str = "readings") -> str:
    return f"""WITH {_READINGS}
SELECT id, {_sql_end(size_ms)} AS end_ts, {aggregates} FROM {source} GROUP BY 1, 2"""


_CELSIUS = "(temperature - 32.0::DOUBLE) * (5.0::DOUBLE / 9.0::DOUBLE)"
_JVM_SPACE = r"[ \t\n\x0B\f\r]+"

_LATEST = f"""latest AS (
  SELECT id, max_by(temperature, end_ts) AS temperature FROM (
    SELECT id, {_sql_end(10 * HOUR)} AS end_ts, max(temperature) AS temperature
    FROM readings GROUP BY 1, 2) GROUP BY id)"""

_NAMES = """names AS (
  SELECT event_id AS seq, upper(event_type) AS name,
         count(*) OVER (PARTITION BY upper(event_type) ORDER BY event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS count
  FROM events)"""


def _sql_words(separator: str) -> str:
    return f"""
lines AS (
  SELECT coalesce(source, '') || '  ' || line || chr(9) || coalesce(lang, '') AS value, arrival
  FROM (SELECT unnest(string_split(text, chr(10))) AS line, doc_id * 100 AS arrival, source, lang
        FROM documents)),
words AS (
  SELECT arrival, unnest(string_split_regex(
           regexp_replace(value, '(?:{separator})+$', ''), '{separator}')) AS word
  FROM lines
  WHERE value = '' OR regexp_replace(value, '(?:{separator})+$', '') <> '')"""


def _sql_word_count(separator: str) -> str:
    return f"""WITH {_sql_words(separator)}
SELECT word, (arrival - arrival % 5000 + 5000)::BIGINT AS end_ts, count(*)::BIGINT AS count
FROM words GROUP BY 1, 2"""


def _sql_split_words(separator: str) -> str:
    return f"WITH {_sql_words(separator)} SELECT word, 1::INTEGER AS count FROM words"


def _sql_rounded(rounded: str) -> str:
    return f"""WITH {_READINGS}, shown AS (
  SELECT seq, temperature AS t, temperature::VARCHAR::DECIMAL(30, 15) AS d FROM readings)
SELECT seq, ({rounded})::DOUBLE AS temperature FROM shown"""


_EARLY = f"""WITH {_MARKED},
ticks AS (
  SELECT seq AS j, wm_after AS ev FROM marked
  WHERE wm = -9223372036854775807 OR wm_after // {DAY} > wm // {DAY}),
accepted AS (
  SELECT * FROM (SELECT seq, id, {_sql_end(240 * HOUR)} AS end_ts, wm FROM marked)
  WHERE wm < end_ts - 1),
opened AS (SELECT id, end_ts, min(seq) AS s0 FROM accepted GROUP BY 1, 2),
points AS (
  SELECT id, end_ts, j, ev FROM opened JOIN ticks ON j >= s0 AND ev < end_ts - 1
  UNION ALL
  SELECT id, end_ts, j, ev FROM opened JOIN (
    SELECT end_ts, min(seq) AS j, min(wm_after) AS ev
    FROM (SELECT DISTINCT end_ts FROM opened) JOIN marked ON wm_after >= end_ts - 1
    GROUP BY end_ts) USING (end_ts))
SELECT p.id, p.end_ts, p.ev AS eval_time, count(*) AS cnt
FROM points p JOIN accepted a ON a.id = p.id AND a.end_ts = p.end_ts AND a.seq <= p.j
GROUP BY p.id, p.end_ts, p.j, p.ev"""

def _sql_step(steps: int) -> str:
    return f"""stepped AS (
  SELECT *, seq // ((SELECT max(seq) FROM disordered) // {steps} + 1) AS step FROM disordered)"""


def _sql_stepped(steps: int, raises_to: str = '"timestamp" - 1') -> str:
    """Between steps only: the watermark, without a bound, is what earlier steps raised it to."""
    return _DISORDERED + f""", {_sql_step(steps)},
marked AS (
  SELECT seq, id, "timestamp", temperature,
         coalesce(max({raises_to}) OVER (ORDER BY step
           RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -9223372036854775807) AS wm
  FROM stepped)"""


_STEPPED_EARLY = f"""WITH {_DISORDERED}, {_sql_step(STEPS)},
marks AS (SELECT step, max("timestamp" - 1) AS mark FROM stepped GROUP BY 1),
wms AS (SELECT step, max(mark) OVER (ORDER BY step) AS after,
               coalesce(max(mark) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                        -9223372036854775807) AS before FROM marks),
accepted AS (SELECT * FROM (SELECT id, {_sql_end(240 * HOUR)} AS end_ts, step, before
                            FROM stepped JOIN wms USING (step)) WHERE before < end_ts - 1),
opened AS (SELECT id, end_ts, min(step) AS s0 FROM accepted GROUP BY 1, 2),
points AS (SELECT id, end_ts, step, after FROM opened JOIN wms ON step >= s0 AND before < end_ts - 1
           WHERE after >= end_ts - 1 OR before = -9223372036854775807
             OR (after + 1) // {DAY} > (before + 1) // {DAY})
SELECT p.id, p.end_ts, p.after AS eval_time, count(*) AS cnt
FROM points p JOIN accepted a ON a.id = p.id AND a.end_ts = p.end_ts AND a.step <= p.step
GROUP BY p.id, p.end_ts, p.step, p.after"""


_LATE_UPDATES = """WITH {marked},
accepted AS (
  SELECT id, end_ts, seq, (wm >= end_ts - 1)::INT AS late
  FROM (SELECT seq, id, {end} AS end_ts, wm FROM marked)
  WHERE wm < end_ts - 1 + {lateness}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id, end_ts ORDER BY late, seq) AS n,
         count(*) FILTER (late = 0) OVER (PARTITION BY id, end_ts) AS punctual
  FROM accepted)
SELECT id, end_ts, n AS cnt,
       CASE WHEN late = 0 OR (punctual = 0 AND n = 1) THEN 'first' ELSE 'update' END AS tag
FROM ranked WHERE late = 1 OR n = punctual"""



def _sql_late_updates(marked: str) -> str:
    return _LATE_UPDATES.format(marked=marked, end=_sql_end(10 * HOUR), lateness=LATENESS)


def _sql_self_cleaning(marked: str, ttl_ms: int = DAY) -> str:
    return f"""WITH {marked}
SELECT id, temperature, abs(temperature - p) AS diff FROM (
  SELECT *, lag(temperature) OVER k AS p, lag("timestamp") OVER k AS seen
  FROM marked WINDOW k AS (PARTITION BY id ORDER BY seq))
WHERE wm < seen + {ttl_ms} AND abs(temperature - p) > 1.7::DOUBLE"""


_RISES = f"""WITH RECURSIVE {_READINGS},
ordered AS (
  SELECT id, "timestamp" AS t, temperature AS v,
         row_number() OVER (PARTITION BY id ORDER BY seq) AS n FROM readings),
walk AS (
  SELECT id, n, v, NULL::BIGINT AS timer, NULL::BIGINT AS fired FROM ordered WHERE n = 1
  UNION ALL
  SELECT o.id, o.n, o.v,
         CASE WHEN o.v < w.v THEN NULL
              WHEN w.timer > o.t THEN w.timer
              WHEN o.v > w.v THEN o.t + {DAY} END,
         CASE WHEN w.timer <= o.t THEN w.timer END
  FROM walk w JOIN ordered o ON o.id = w.id AND o.n = w.n + 1),
warned AS (
  SELECT id, fired FROM walk WHERE fired IS NOT NULL
  UNION ALL
  SELECT id, timer FROM (SELECT id, max_by(timer, n) FILTER (true) AS x, max(n) AS n
                         FROM walk GROUP BY id) JOIN walk USING (id, n)
  WHERE timer <= (SELECT max(t) FROM ordered))
SELECT id, fired AS "timestamp",
       'Temperature of sensor ''' || id || ''' monotonically increased for 1 second.' AS message
FROM warned"""


def oracle_sql() -> dict[str, str]:
    sql = _batch_sql()
    for name in (
        "running_count",
        "rolling_max_record",
        "temp_change_alerts",
        "switch_forward",
        "fire_alerts",
    ):
        sql[f"stream_{name}"] = sql[name]
    sql["opaque_map_celsius"] = sql["to_celsius"]
    sql["opaque_flat_map_words"] = sql["split_words_ws"]
    sql["opaque_aggregate_avg"] = sql["tumbling_avg"]
    sql["opaque_window_minmax"] = sql["tumbling_minmax"]
    sql["stream_tumbling_max"] = sql["tumbling_max"]
    sql["stream_rolling_sum"] = sql["rolling_sum"]
    sql["stream_late_update_counts"] = _sql_late_updates(_sql_stepped(STEPS))
    sql["stream_self_cleaning_alerts"] = _sql_self_cleaning(_sql_stepped(STEPS), HOUR)
    tagged = 'SELECT seq, id, "timestamp", temperature, {} AS is_late FROM marked'
    stepped = f"WITH {_sql_stepped(FEW_STEPS)} "
    sql["stream_late_flag"] = stepped + tagged.format('"timestamp" < wm')
    sql["stream_late_window_rows"] = stepped + tagged.format(f"wm >= {_sql_end(10 * HOUR)} - 1")
    markers = f"""CASE WHEN id = 'sensor_1' THEN "timestamp" - {60 * HOUR} END"""
    sql["stream_late_punctuated"] = f"WITH {_sql_stepped(FEW_STEPS, markers)} " + tagged.format(
        '"timestamp" < wm'
    )
    sql["stream_early_fire_counts"] = _STEPPED_EARLY
    sql["stream_window_counts"] = f"""WITH {_DISORDERED}
SELECT id, {_sql_end(10 * HOUR)} AS end_ts, count(*) AS cnt FROM disordered GROUP BY 1, 2"""
    shown = ", ".join(f"'{i}'" for i in SHOWN)
    sql["stream_latest_lookup"] = f"""WITH {_DISORDERED}, {_sql_step(FEW_STEPS)}
SELECT id, max(end_ts) AS end_ts, max_by(temperature, end_ts) AS temperature FROM (
  SELECT id, {_sql_end(10 * HOUR)} AS end_ts, max(temperature) AS temperature
  FROM stepped WHERE step <= 1 AND id IN ({shown}) GROUP BY 1, 2) GROUP BY id"""
    sql["stream_growing_words"] = sql["split_words_java"]
    sql["stream_resumed_counts"] = sql["running_count"]
    sql["stream_two_sinks"] = f"""WITH {_NAMES}
SELECT 'shown' AS sink, name AS key, count::VARCHAR AS value FROM names
UNION ALL SELECT 'encoded', hex(name), right('00000000' || hex(count), 8) FROM names"""
    if corpus:
        sql |= corpus.ORACLE_SQL
    return sql


def _batch_sql() -> dict[str, str]:
    from_readings = f"WITH {_READINGS} "
    from_marked = f"WITH {_MARKED} "
    shown = ", ".join(f"'{i}'" for i in SHOWN)
    cells = ", ".join(
        f"max(CASE WHEN id = '{i}' THEN "
        f"round(temperature::VARCHAR::DECIMAL(30, 15), 3)::DOUBLE END) AS {i}"
        for i in SHOWN
    )
    return {
        "readings": from_readings + 'SELECT seq, id, "timestamp", temperature FROM readings',
        "smoke_levels": """SELECT event_id AS seq, epoch_us(ts) // 1000 AS "timestamp",
            CASE WHEN event_type = 'error' THEN 'HIGH' ELSE 'LOW' END AS level
            FROM events WHERE event_type IN ('error', 'signup')""",
        "filter_gt": from_readings + "SELECT * FROM readings WHERE temperature > 6.55::DOUBLE",
        "filter_ge": from_readings + "SELECT * FROM readings WHERE temperature >= 6.55::DOUBLE",
        "project_id": from_readings + "SELECT id FROM readings",
        "split_id": from_readings
        + "SELECT unnest(string_split(id, '_')) AS part FROM readings",
        "filter_project_split": from_readings
        + "SELECT unnest(string_split(id, '_')) AS part FROM readings WHERE temperature > 25",
        "split_words_java": _sql_split_words(" "),
        "split_words_ws": _sql_split_words(_JVM_SPACE),
        "to_celsius": from_readings
        + f'SELECT seq, id, "timestamp", {_CELSIUS} AS temperature FROM readings',
        "freezing_alarms": from_readings
        + "SELECT 'Freezing Alarm for ' || id AS message FROM readings WHERE temperature < 32.0",
        "round_half_up": _sql_rounded("round(d, 1)"),
        "round_half_down": _sql_rounded(
            "sign(t) * ceil(abs(d) * 10 - 0.5)::DOUBLE / 10.0::DOUBLE"
        ),
        "tumbling_min": _sql_window(15 * HOUR, "min(temperature) AS temperature"),
        "tumbling_max": _sql_window(10 * HOUR, "max(temperature) AS temperature"),
        "tumbling_avg": _sql_window(15 * HOUR, "round(avg(temperature), 6) AS temperature"),
        "tumbling_minmax": _sql_window(
            5 * HOUR, "min(temperature) AS min, max(temperature) AS max"
        ),
        "tumbling_count": _sql_window(10 * HOUR, "count(*) AS cnt"),
        "avg_celsius": from_readings
        + f"""SELECT id, {_sql_end(HOUR)} AS "timestamp",
            round(avg({_CELSIUS}), 6) AS temperature FROM readings GROUP BY 1, 2""",
        "word_count_java": _sql_word_count(" "),
        "word_count_ws": _sql_word_count(_JVM_SPACE),
        "custom_window_count": _sql_window(30 * HOUR, "count(*) AS cnt"),
        "rolling_sum": """SELECT l_orderkey AS f0,
            (sum(l_quantity::INTEGER) OVER w)::BIGINT AS f1,
            first_value(l_linenumber) OVER w AS f2
            FROM lineitem WINDOW w AS (PARTITION BY l_orderkey
              ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity::INTEGER
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        "rolling_max_record": from_readings
        + """SELECT seq, id, best.ts AS "timestamp", best.t AS temperature FROM (
            SELECT seq, id, max({'t': temperature, 's': seq, 'ts': "timestamp"}) OVER (
              PARTITION BY id ORDER BY seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best
            FROM readings)""",
        "running_count": f"WITH {_NAMES} SELECT seq, name, count FROM names",
        "watermark_bounded": from_marked + "SELECT seq, wm FROM marked",
        "watermark_periodic": f"WITH {_DISORDERED}, "
        + _sql_watermark(f'"timestamp" - {60 * HOUR}')
        + " SELECT seq, wm FROM marked",
        "watermark_punctuated": f"WITH {_DISORDERED}, "
        + _sql_watermark(f"""CASE WHEN id = 'sensor_1' THEN "timestamp" - {60 * HOUR} END""")
        + " SELECT seq, wm FROM marked",
        "late_flag": from_marked
        + 'SELECT seq, id, "timestamp", "timestamp" < wm AS is_late FROM marked',
        "late_on_time": from_marked
        + 'SELECT seq, id, temperature, "timestamp" FROM marked WHERE NOT "timestamp" < wm',
        "late_messages": from_marked
        + """SELECT '*** late reading *** ' || id AS message
            FROM marked WHERE "timestamp" < wm""",
        "late_window_counts": from_marked
        + f"""SELECT id, {_sql_end(10 * HOUR)} AS end_ts, count(*) AS cnt FROM marked
            WHERE wm < {_sql_end(10 * HOUR)} - 1 GROUP BY 1, 2""",
        "late_window_rows": from_marked
        + f"""SELECT seq, id, "timestamp", temperature FROM marked
            WHERE wm >= {_sql_end(10 * HOUR)} - 1""",
        "late_update_counts": _sql_late_updates(_MARKED),
        "early_fire_counts": _EARLY,
        "temp_change_alerts": from_readings
        + """SELECT id, temperature, abs(temperature - p) AS diff FROM (
            SELECT *, lag(temperature) OVER (PARTITION BY id ORDER BY seq) AS p FROM readings)
            WHERE abs(temperature - p) > 1.7::DOUBLE""",
        "self_cleaning_alerts": _sql_self_cleaning(_MARKED),
        "rise_warnings": _RISES,
        "fire_alerts": f"""WITH {_READINGS}, smoke AS (
              SELECT "timestamp" AS s, lead("timestamp") OVER (ORDER BY seq) AS e, event_type AS y
              FROM (SELECT event_id AS seq, epoch_us(ts) // 1000 AS "timestamp", event_type
                    FROM events WHERE event_type IN ('error', 'signup')))
            SELECT 'Risk of fire! SensorReading(' || r.id || ', ' || r."timestamp" || ', '
                   || r.temperature || ')' AS message, r."timestamp"
            FROM readings r JOIN events v ON v.event_id = r.seq
              JOIN smoke ON r."timestamp" >= s AND (r."timestamp" < e OR e IS NULL)
            WHERE v.event_type NOT IN ('error', 'signup')
              AND y = 'error' AND r.temperature > 100""",
        "switch_forward": f"""WITH {_READINGS}, switches AS (
              SELECT 'sensor_' || user_id AS id, epoch_us(ts) // 1000 AS s, event_id AS switch_seq,
                     (event_id % 3 + 1) * {12 * HOUR} AS d
              FROM events WHERE event_type = 'signup')
            SELECT seq, id, "timestamp", temperature FROM readings r
            WHERE seq NOT IN (SELECT switch_seq FROM switches) AND EXISTS (SELECT 1 FROM switches x WHERE x.id = r.id
              AND r."timestamp" >= x.s AND r."timestamp" < x.s + x.d)""",
        "latest_max_per_key": f"WITH {_READINGS}, {_LATEST} SELECT id, temperature FROM latest",
        "latest_lookup": f"WITH {_READINGS}, {_LATEST} "
        f"SELECT id, temperature FROM latest WHERE id IN ({shown})",
        "dashboard_pivot": f"WITH {_READINGS}, {_LATEST} SELECT {cells} FROM latest",
        "kafka_encode_counts": f"""WITH {_NAMES} SELECT hex(name) AS key_hex,
            right('00000000' || hex(count), 8) AS value_hex FROM names""",
        "kafka_decode_counts": f"""WITH {_NAMES} SELECT name, count::INTEGER AS count,
            (seq % 3)::INTEGER AS partition, seq // 3 AS "offset" FROM names""",
    }
