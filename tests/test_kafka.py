"""Kafka options and record layout. No broker is needed or started."""

from pyspark.sql import functions as F

from tidegauge.sources import kafka


def test_source_options():
    assert kafka.source_options("broker:9092", "names", group="readers") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "names",
        "startingOffsets": "earliest",
        "kafka.group.id": "readers",
    }
    latest = kafka.source_options("broker:9092", "names", starting="latest")
    assert latest["startingOffsets"] == "latest" and "kafka.group.id" not in latest


def test_sink_options():
    assert kafka.sink_options("broker:9092", "names3") == {
        "kafka.bootstrap.servers": "broker:9092",
        "topic": "names3",
    }


def test_records(spark):
    counts = spark.createDataFrame([("ÅSA", 1), ("BO", 70_000)], "name string, count long")
    records = kafka.encode_counts(counts)
    assert records.dtypes == [("key", "binary"), ("value", "binary")]
    placed = records.select("*", F.lit(0).alias("partition"), F.lit(5).alias("offset"))
    assert [tuple(r) for r in kafka.decode_counts(placed).collect()] == [
        ("ÅSA", 1, 0, 5),
        ("BO", 70_000, 0, 5),
    ]
    text = placed.select("*", F.current_timestamp().alias("timestamp")).drop("value")
    decoded = kafka.decode_text(text.withColumnRenamed("key", "value"))
    assert decoded.columns == ["value", "partition", "offset", "timestamp"]
    assert [r[0] for r in decoded.collect()] == ["ÅSA", "BO"]
