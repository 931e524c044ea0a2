"""The immutable lake of raw messages, and topics as streams: Kafka where its connector is present, else the lake's files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import schemas

#: Topic -> partitions and days of retention.
TOPICS = {
    "weather.forecast.raw.v1": (6, 7), "weather.observation.raw.v1": (6, 7), "weather.dlq.v1": (3, 30), "weather.alert.v1": (3, 14), "weather.briefing.v1": (3, 14),
}


def missing_topics(existing: Iterable[str]) -> list[tuple[str, int, int]]:
    """Topics to create, with partitions and retention in milliseconds; those that exist stay as they are."""
    return [(t, n, days * 86_400_000) for t, (n, days) in TOPICS.items() if t not in set(existing)]


def has_kafka(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001
        return False


def topic_stream(spark: SparkSession, topic: str, *, servers: str | None = None, lake: str | None = None, per_batch: int = 500, from_time: dict | None = None) -> DataFrame:
    """A topic as a stream of ``topic, dt, kafka_partition, kafka_offset, kafka_timestamp_ms, key, value``, from its start or from a time on.

    ``from_time`` is an instant in milliseconds: a new checkpoint then starts at the first message at or after it.
    """
    if servers and has_kafka(spark):
        r = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("maxOffsetsPerTrigger", per_batch)
        r = r.option("startingOffsets", "earliest") if from_time is None else r.option("startingTimestamp", str(from_time)).option("startingOffsetsByTimestampStrategy", "latest")
        k = r.load()
        return k.select(F.col("topic"), F.to_date("timestamp").alias("dt"), F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), F.unix_millis("timestamp").alias("kafka_timestamp_ms"), "key", "value")
    s = spark.readStream.schema(schemas.BRONZE).option("maxFilesPerTrigger", max(1, per_batch // 50)).parquet(f"{lake}")
    s = s.where(F.col("topic") == topic)
    return s if from_time is None else s.where(F.col("kafka_timestamp_ms") >= from_time)


def write_messages(df: DataFrame, topic: str, *, servers: str | None = None, lake: str | None = None) -> None:
    """Send rows with ``key`` and ``value``: to Kafka where present, else appended to the lake, dated and numbered where they are not."""
    if servers and has_kafka(df.sparkSession):
        df.select(F.col("key").cast("binary"), F.col("value").cast("binary")).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    else:
        now = F.current_timestamp()
        lacking = {"dt": F.to_date(now), "kafka_partition": F.lit(0), "kafka_offset": F.monotonically_increasing_id(), "kafka_timestamp_ms": F.unix_millis(now)}
        append_bronze(df.withColumns({"topic": F.lit(topic)} | {c: x for c, x in lacking.items() if c not in df.columns}), lake)


def append_bronze(df: DataFrame, lake: str) -> None:
    df.write.mode("append").partitionBy("topic", "dt").parquet(lake)


def read_bronze(spark: SparkSession, lake: str, topic: str | None = None) -> DataFrame:
    """The lake's messages with ``seq``, a total order of arrival: day, file, partition, offset. Sorting by it is needed only where the last one wins."""
    b = spark.read.schema(schemas.BRONZE).parquet(lake)
    b = b if topic is None else b.where(F.col("topic") == topic)
    return b.withColumn("seq", F.struct(F.col("dt"), F.col("_metadata.file_name").alias("file"), F.col("kafka_partition"), F.col("kafka_offset")))


def find_event(bronze: DataFrame, event_id: str) -> DataFrame:
    """Messages of an event: the bytes are searched before any JSON is parsed."""
    text = F.col("value").cast("string")
    return bronze.where(text.contains(event_id)).where(F.get_json_object(text, "$.event_id") == event_id)


def sample_event_id(bronze: DataFrame) -> str | None:
    """The first event id that parses in the newest file."""
    newest = bronze.agg(F.max(F.struct("seq.dt", "seq.file")).alias("m"))  # names only: no message is read for it
    last = bronze.where(F.struct("seq.dt", "seq.file") == newest.scalar())
    r = last.select("seq", F.get_json_object(F.col("value").cast("string"), "$.event_id").alias("event_id")).where("event_id is not null")
    return r.agg(F.min_by("event_id", F.struct("seq.kafka_partition", "seq.kafka_offset"))).first()[0]


def dead_letters(bad: DataFrame, now) -> DataFrame:
    """Dead letters of unreadable messages: the payload as text (broken bytes replaced), the error, where it came from."""
    return bad.select(
        F.decode(F.coalesce("value", F.lit(b"")), "UTF-8").alias("original_payload"), "error_type", "error_message", F.col("topic").alias("source_topic"),
        F.col("kafka_partition").alias("source_partition"), F.col("kafka_offset").alias("source_offset"), F.lit(now).cast("timestamp").alias("failed_at"),
    )


def offset_targets(bronze: DataFrame, from_ms: int | None = None) -> DataFrame:
    """Per topic and partition the offset to restart from: the earliest, or the first at or after a time, or one past the end."""
    g = bronze.groupBy("topic", "kafka_partition").agg(
        F.min("kafka_offset").alias("low"), (F.max("kafka_offset") + 1).alias("high"), F.min(F.when(F.col("kafka_timestamp_ms") >= F.lit(from_ms), F.col("kafka_offset"))).alias("at")
    )
    return g.select("topic", "kafka_partition", (F.col("low") if from_ms is None else F.coalesce("at", "high")).alias("target"))


def consumer_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Lag per group and topic: sum over partitions of end less committed, never below 0; nothing committed counts from the start.

    ``ends``: topic, partition, low, high; ``committed``: group, topic, partition, offset (NULL: never committed).
    """
    j = committed.join(ends, ["topic", "partition"])
    return j.groupBy("group", "topic").agg(F.sum(F.greatest(F.col("high") - F.coalesce("offset", "low"), F.lit(0))).alias("lag"))
