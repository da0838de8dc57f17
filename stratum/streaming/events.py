"""Event stream -> Bronze, with a quarantine for malformed messages.

Source: newline-delimited JSON files landing in a directory, or a Kafka-format
topic; only :func:`read_messages` differs.  Each message is parsed on the
executors.  A message is an event if it is exactly one JSON object that fits
the schema; everything else -- blank lines, NULL values, text after the object,
several objects, other JSON values, fields of the wrong type -- goes to the
quarantine with its raw text.  Events keep their raw text too, so fields the
schema doesn't name are not lost; without a schema the fields are one VARIANT,
nested and typed as they were sent.

One streaming query reads and parses each message once; per micro-batch,
``foreachBatch`` persists the parsed rows and writes both outputs.  Each
output is partitioned by ingestion date and micro-batch and written with
dynamic partition overwrite, so a micro-batch replayed after a failure
replaces its own files instead of adding a second copy.  Micro-batches are
named by an id kept beside the checkpoint and their number: a new checkpoint
starts numbers again, but under another id, and replaces nothing.  The
ingestion timestamp is the micro-batch timestamp, which the checkpoint also
keeps, so a replay lands in the same partition.  Micro-batches are bounded by
bytes or messages (files) or offsets (Kafka); ``available_now`` drains what is
there, in as many of them as it takes, and stops.  Bounded by messages, a
trigger that finds a backlog writes many micro-batches side by side, each as
its own partition under its own number.
"""

from __future__ import annotations

import contextlib
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import astuple, dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.sources.files import FileTakenError, read_file, write_file
from stratum.streaming.landing import NAME as LANDED_LINES
from stratum.streaming.landing import LandedLines
from stratum.streaming.progress import Parts, batch_records

CORRUPT = "_corrupt_record"
RAW = "_raw"
BATCH = "_lote"
FIELDS = "_campos"
#: Which of a trigger's micro-batches a message belongs to (where it can have several).
PART = "_parte"

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


@dataclass
class StreamConfig:
    landing: str
    bronze: str
    quarantine: str
    checkpoint: str
    # fields of an event; None: any JSON object, its fields as a VARIANT (FIELDS)
    schema: T.StructType | None = field(default_factory=lambda: EVENT_SCHEMA)
    source_tag: str = "streaming"
    # name of the query, and (if given) where a record of each micro-batch goes
    query_name: str = field(default_factory=lambda: f"events-{uuid.uuid4().hex[:12]}")
    batch_metrics: str | None = None
    # called with a micro-batch's number before it is written; if it raises, the
    # micro-batches before that one are written and recorded, the others not
    on_batch: Callable[[int], None] | None = None
    partition: str = "dt_ingestao"
    audit_date: str = "_dt_ingestao"
    audit_source: str = "_fonte"
    # Bounds of a micro-batch of files (one persisted batch must fit the
    # executors), and the trigger interval when running continuously.
    max_bytes_per_trigger: int = 1 << 30
    trigger_interval: str = "60 seconds"
    # With ``max_messages``, landed files are read by the line instead: a
    # micro-batch ends at so many messages, or ``max_seconds`` after its first.
    # Of a backlog a trigger takes up to ``max_batches_per_trigger`` of them.
    max_messages: int | None = None
    max_seconds: float = 60.0
    max_batches_per_trigger: int = 1000
    # file source housekeeping: "archive" (to ``archive_dir``) or "delete"
    # processed files, so listing the landing folder stays cheap over time
    clean_source: str | None = None
    archive_dir: str | None = None
    # Kafka-format source (deployment): set ``kafka_servers`` and ``topic``;
    # a batch closes at 500 messages or after 60 s, whichever comes first, and
    # takes at most ``max_offsets_per_trigger``.  The first run starts at
    # ``starting_offsets``.
    kafka_servers: str | None = None
    topic: str | None = None
    starting_offsets: str = "earliest"
    min_offsets_per_trigger: int = 500
    max_offsets_per_trigger: int = 1_000_000
    max_trigger_delay: str = "60s"


def read_messages(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    """Streaming DataFrame of raw message text (one line = one message).

    With ``kafka_servers`` set, messages come from a Kafka topic instead (the
    connector must be on the classpath); the message value is decoded as
    UTF-8 text and everything downstream is unchanged.
    """
    if cfg.kafka_servers:
        return (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", cfg.kafka_servers)
                .option("subscribe", cfg.topic)
                .option("startingOffsets", cfg.starting_offsets)
                .option("maxOffsetsPerTrigger", cfg.max_offsets_per_trigger)
                .option("minOffsetsPerTrigger", cfg.min_offsets_per_trigger)
                .option("maxTriggerDelay", cfg.max_trigger_delay)
                .load()
                .select(F.col("value").cast("string").alias(RAW)))
    if cfg.max_messages:
        spark.dataSource.register(LandedLines)
        return (spark.readStream.format(LANDED_LINES)
                .option("log", f"{cfg.checkpoint.rstrip('/')}/landed")
                .option("max_messages", cfg.max_messages)
                .option("max_seconds", cfg.max_seconds)
                .option("max_batches", cfg.max_batches_per_trigger)
                .option("max_bytes", cfg.max_bytes_per_trigger)
                .load(cfg.landing).select(F.col("value").alias(RAW), F.col("part").alias(PART)))
    reader = (spark.readStream.format("text")
              .option("maxBytesPerTrigger", cfg.max_bytes_per_trigger)
              .option("recursiveFileLookup", "true"))
    if cfg.clean_source:
        reader = reader.option("cleanSource", cfg.clean_source)
        if cfg.archive_dir:
            reader = reader.option("sourceArchiveDir", cfg.archive_dir)
    return reader.load(cfg.landing).select(F.col("value").alias(RAW))


def _part_of(frame: DataFrame) -> list[str]:
    return [PART] if PART in frame.columns else []


def parse(messages: DataFrame, schema: T.StructType | None) -> DataFrame:
    """Raw text, parsed fields, and ``CORRUPT``: whether it is no event.

    A parser alone takes the first value of a text and ignores the rest; read
    as the only element of an array, text after the value is an error and a
    second value a second element.  What doesn't begin like an object isn't
    parsed, and only single objects are parsed for their fields.  Without a schema that array is parsed once,
    as a VARIANT: the event in it keeps its nesting and the types of its values
    (an object that names a field twice is no event).
    """
    part = _part_of(messages)
    alone = F.concat(F.lit("["), RAW, F.lit("]"))
    is_object = F.col(RAW).rlike(r"^\s*\{")
    if schema is None:
        values = messages.select(RAW, *part, F.when(is_object, F.try_parse_json(alone)).alias("_v"))
        one = F.expr("_v IS NOT NULL AND variant_get(_v, '$[1]', 'variant') IS NULL")
        return (values.withColumn("_one", one)
                .select(RAW, *part, F.when(F.col("_one"), F.expr("variant_get(_v, '$[0]', 'variant')")).alias(FIELDS),
                        (~F.col("_one")).alias(CORRUPT)))
    strict = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
    values = F.when(is_object, F.from_json(alone, T.ArrayType(T.StringType()), strict))
    one = F.coalesce(F.size(values) == 1, F.lit(False))
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(RAW, with_corrupt, {**strict, "columnNameOfCorruptRecord": CORRUPT})
    return (messages.select(RAW, *part, one.alias("_one"))
            .select(RAW, *part, F.when(F.col("_one"), parsed).alias("_m"), "_one")
            .select(RAW, *part, *[F.col(f"_m.`{f.name}`").alias(f.name) for f in schema.fields],
                    (~F.col("_one") | F.col("_m").isNull() | F.col(f"_m.{CORRUPT}").isNotNull()).alias(CORRUPT)))


def fields_found(events: DataFrame) -> str:
    """The type that holds every stored event's fields (``OBJECT<...>``; VARIANT
    where values of a field differ in kind), from one aggregate."""
    return events.agg(F.schema_of_variant_agg(FIELDS)).first()[0]


def field(path: str, kind: str) -> Column:
    """A field of events stored without a schema, by its path (``$.a.b[0]``);
    NULL where there is none or its value is not of that kind."""
    return F.try_variant_get(FIELDS, path, kind)


def _audit(cfg: StreamConfig) -> dict[str, Column]:
    now = F.current_timestamp()
    return {cfg.audit_date: F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"),
            cfg.audit_source: F.lit(cfg.source_tag),
            cfg.partition: F.to_date(now)}


def with_audit(parsed: DataFrame, cfg: StreamConfig) -> DataFrame:
    """Audit columns on the stream itself: ``current_timestamp`` in a
    streaming plan is the micro-batch timestamp."""
    return parsed.withColumns(_audit(cfg))


def _audit_cols(cfg: StreamConfig) -> list[str]:
    return [cfg.audit_date, cfg.audit_source, cfg.partition]


def valid_events(parsed: DataFrame, cfg: StreamConfig) -> DataFrame:
    """Parsed fields and the raw text of the messages that are events."""
    fields = [FIELDS] if cfg.schema is None else [f.name for f in cfg.schema.fields]
    return parsed.filter(~F.col(CORRUPT)).select(*fields, RAW, *_audit_cols(cfg), *_part_of(parsed))


def malformed_events(parsed: DataFrame, cfg: StreamConfig) -> DataFrame:
    return parsed.filter(CORRUPT).select(RAW, *_audit_cols(cfg), *_part_of(parsed))


def writer_id(spark: SparkSession, cfg: StreamConfig) -> str:
    """An id that stays with the checkpoint: made up on the first run and kept
    in a file beside it (on the checkpoint's own file system)."""
    path = f"{cfg.checkpoint.rstrip('/')}/writer-id"
    with contextlib.suppress(FileTakenError):
        if read_file(spark, path) is None:
            write_file(spark, path, uuid.uuid4().hex[:12].encode())
    return read_file(spark, path).decode()


def _write_idempotent(frame: DataFrame, path: str, cfg: StreamConfig, batch: str | Column) -> int:
    obs = Observation(f"rows_{uuid.uuid4().hex}")
    (frame.withColumn(BATCH, F.lit(batch)).drop(PART)
          .observe(obs, F.count(F.lit(1)).alias("rows"))
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy(cfg.partition, BATCH).parquet(path))
    return int(obs.get.get("rows", 0) or 0)


Counts = dict[int, tuple[int, int]]


def _batch_writer(cfg: StreamConfig, writer: str, counts: Counts, parts: Parts | None = None):
    """Writes a trigger's micro-batches, and notes in ``parts`` which they were."""
    def write(batch: DataFrame, batch_id: int) -> None:
        began, many, lost = time.perf_counter(), PART in batch.columns, None
        if cfg.on_batch and not many:
            cfg.on_batch(batch_id)
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        kept, name = batch, f"{writer}-{batch_id}"
        try:
            if many:
                number = F.lit(batch_id) + F.col(PART)
                name = F.concat(F.lit(f"{writer}-"), number.cast("string"))
            if many and (cfg.on_batch or parts is not None):
                rows = {r.number: r["count"] for r in batch.groupBy(number.alias("number")).count().collect()}
                sizes = dict(sorted(rows.items()))  # at most ``max_batches_per_trigger``
                lost = _first_lost(cfg, sizes)
                if lost is not None:
                    sizes = {k: n for k, n in sizes.items() if k < lost[0]}
                    if not sizes:
                        raise lost[1]
                    kept = batch.where(number < lost[0])
            counted = (_write_idempotent(valid_events(kept, cfg), cfg.bronze, cfg, name),
                       _write_idempotent(malformed_events(kept, cfg), cfg.quarantine, cfg, name))
        finally:
            batch.unpersist()
        if many and parts is not None:
            parts[batch_id] = (sizes, time.perf_counter() - began)
        if lost is not None:
            raise lost[1]
        counts[batch_id] = counted
    return write


def _first_lost(cfg: StreamConfig, numbers) -> tuple[int, Exception] | None:
    """The first micro-batch that ``on_batch`` refuses, and its error."""
    for number in numbers if cfg.on_batch else ():
        try:
            cfg.on_batch(number)
        except Exception as err:  # noqa: BLE001 - raised when those before it are written
            return number, err
    return None


#: How often a source that is bounded by messages looks for more.
POLL = "1 second"


def _trigger(writer, available_now: bool, cfg: StreamConfig):
    """Drained by the message, a batch follows the other at once until there is
    none left (:func:`drain` stops the query)."""
    if available_now and not cfg.max_messages:
        return writer.trigger(availableNow=True)
    interval = cfg.trigger_interval if not cfg.max_messages else "0 seconds" if available_now else POLL
    return writer.trigger(processingTime=interval)


def start(spark: SparkSession, cfg: StreamConfig, *, available_now: bool = True, counts: Counts | None = None,
          parts: Parts | None = None):
    """Start the ingest query.  ``counts`` (if given) receives, per trigger,
    the rows written to Bronze and to quarantine; ``parts``, per trigger that
    can hold several micro-batches, the rows of each."""
    if available_now:
        cfg = replace(cfg, max_seconds=0)  # what is there doesn't wait for more
    stream = with_audit(parse(read_messages(spark, cfg), cfg.schema), cfg)
    writer = (stream.writeStream
              .queryName(cfg.query_name)
              .option("checkpointLocation", f"{cfg.checkpoint.rstrip('/')}/events")
              .foreachBatch(_batch_writer(cfg, writer_id(spark, cfg), counts if counts is not None else {}, parts)))
    return _trigger(writer, available_now, cfg).start()


@dataclass
class DrainResult:
    rows_in: int
    bronze_rows: int
    quarantine_rows: int

    @classmethod
    def of(cls, counts: Counts) -> DrainResult:
        """Sums over all micro-batches: each message went to one of the two."""
        bronze, quarantine = (sum(c[i] for c in counts.values()) for i in (0, 1))
        return cls(bronze + quarantine, bronze, quarantine)


def _until_idle(q, timeout_s: float | None) -> None:
    """Wait until a trigger finds no more messages, then stop."""
    late = threading.Event()
    if timeout_s is not None:
        timer = threading.Timer(timeout_s, lambda: (late.set(), q.stop()))
        timer.start()
    try:
        q.processAllAvailable()
    finally:
        if timeout_s is not None:
            timer.cancel()
        q.stop()
    if late.is_set():
        raise TimeoutError(f"stream {q.id} still running after {timeout_s}s")


def drain(spark: SparkSession, cfg: StreamConfig, timeout_s: float | None = None) -> DrainResult:
    """Process everything that has landed, however long it takes, then stop;
    with ``timeout_s``, stop and raise after that time.

    Rows are counted while they are written (one ``Observation`` per output
    and micro-batch), not by re-reading output and not from the query's
    progress, of which only the last updates are kept.
    """
    counts: Counts = {}
    with batch_records(spark, cfg.batch_metrics, cfg.query_name) as parts:
        q = start(spark, cfg, available_now=True, counts=counts, parts=parts)
        try:
            if cfg.max_messages:
                _until_idle(q, timeout_s)
            elif timeout_s is None:
                q.awaitTermination()
            elif not q.awaitTermination(timeout_s):
                raise TimeoutError(f"stream {q.id} still running after {timeout_s}s")
            if q.exception() is not None:
                raise RuntimeError(f"stream failed: {q.exception()}")
        finally:
            if q.isActive:
                q.stop()
    return DrainResult.of(counts)


def run_for(spark: SparkSession, cfg: StreamConfig, seconds: float) -> DrainResult:
    """Continuous ingest on the processing-time trigger for at most
    ``seconds``, then a clean stop (the checkpoint keeps the position; the
    next run resumes from it).  The rows of the micro-batches that ended.
    Messages that were still waiting for more (``max_messages``) are written at
    the end."""
    counts: Counts = {}
    with batch_records(spark, cfg.batch_metrics, cfg.query_name) as parts:
        q = start(spark, cfg, available_now=False, counts=counts, parts=parts)
        try:
            q.awaitTermination(seconds)
        finally:
            q.stop()
    done = DrainResult.of(counts)
    if cfg.max_messages:
        last = drain(spark, cfg)
        done = DrainResult(*(a + b for a, b in zip(astuple(done), astuple(last))))
    return done


def events_as_json(events: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Serialise a batch of event rows to one JSON text line each (the
    producer side, used to replay a table into the landing folder)."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    return events.select(F.to_json(F.struct(*cols)).alias("value"))


def land(df_text: DataFrame, landing: str, batch: str) -> str:
    """Write text lines as a new batch of files under ``landing``."""
    path = f"{landing.rstrip('/')}/{batch}"
    df_text.write.mode("errorifexists").text(path)
    return path
