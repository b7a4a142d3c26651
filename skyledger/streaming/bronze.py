"""Message streams to bronze.

Each micro-batch is split into usable messages and a quarantine. Its output goes to a folder named
after the stream and the batch, so a replayed batch adds nothing twice.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from datetime import datetime, timedelta
from threading import Event

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from skyledger.functions.text import day_of_iso_timestamp, to_day
from skyledger.plans.jobs import append_approaches, append_catalog, land_approaches, recorded
from skyledger.plans.silver_neo import APPROACH_KEY
from skyledger.schemas import (
    BRONZE_SATCAT,
    NEO_MESSAGE,
    SATCAT_MESSAGE,
    STREAM_PROGRESS,
    as_variant,
)
from skyledger.session import COMPRESSION, literal_rows, staged_with
from skyledger.sources.tables import Warehouse

#: The silver job that takes over what a stream lands.
TAKEN_OVER_BY = {
    "neo_stream_to_bronze": "neo_to_silver",
    "satcat_stream_to_bronze": "satcat_to_silver",
}
_CORRUPT = "_corrupt"
_SOURCE_ORDER = ("timestamp", "partition", "offset")


def _parsed(messages: DataFrame, schema: str, reason: Column) -> DataFrame:
    """Messages with their parsed body `v` and the `reason` to quarantine them, if any."""
    text = F.col("value").cast("string")
    body = F.from_json(text, f"{schema}, {_CORRUPT} STRING", {"columnNameOfCorruptRecord": _CORRUPT})
    parsed = messages.withColumns({"value": text, "v": body})
    malformed = F.col("v").isNull() | F.col(f"v.{_CORRUPT}").isNotNull()
    return parsed.withColumn("reason", F.when(malformed, F.lit("malformed")).otherwise(reason))


def parse_approaches(messages: DataFrame) -> DataFrame:
    """Approach messages as bronze rows, each with a `reason` that is NULL for a usable one.

    The feed dates of a message are its approach date.
    """
    day = to_day(F.col("v.close_approach_date"))
    reason = F.when(F.col("v.neo_id").isNull(), F.lit("missing key")).when(
        day.isNull(), F.lit("missing date")
    )
    parsed = _parsed(messages, NEO_MESSAGE, reason)
    carried = [c for c in _SOURCE_ORDER if c in messages.columns]
    return parsed.select(
        *carried,
        "value",
        "reason",
        day.alias("feed_start_date"),
        day.alias("feed_end_date"),
        "v.neo_id",
        "v.neo_reference_id",
        "v.neo_name",
        "v.is_potentially_hazardous_asteroid",
        "v.absolute_magnitude_h",
        "v.estimated_diameter",
        day.alias("close_approach_date"),
        "v.close_approach_date_full",
        "v.epoch_date_close_approach",
        "v.relative_velocity",
        "v.miss_distance",
        "v.orbiting_body",
        "v.raw_neo",
    )


def parse_catalog(messages: DataFrame) -> DataFrame:
    """Catalog messages as bronze rows, each with a `reason` that is NULL for a usable one."""
    day = day_of_iso_timestamp(F.col("v.snapshot_timestamp"))
    reason = F.when(F.col("v.snapshot_group").isNull(), F.lit("missing key")).when(
        day.isNull(), F.lit("missing timestamp")
    )
    record = F.coalesce(F.to_json("v.satcat", {"ignoreNullFields": "false"}), F.lit("{}"))
    return _parsed(messages, SATCAT_MESSAGE, reason).select(
        "value",
        "reason",
        F.col("v.snapshot_group").alias("snapshot_group"),
        day.alias("snapshot_date"),
        record.alias("raw_csv_row"),
        record.alias("parsed_record"),
    )


def usable(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).drop("reason")


def quarantined(parsed: DataFrame, stream: str) -> DataFrame:
    """Rejected messages with the reason; the text is kept whole."""
    key = F.col("neo_id") if "neo_id" in parsed.columns else F.lit(None).cast("string")
    return parsed.filter(F.col("reason").isNotNull()).select(
        F.lit(stream).alias("stream"),
        "reason",
        key.alias("message_key"),
        "value",
        F.current_timestamp().alias("quarantined_at"),
    )


def _start(
    messages: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    stream: str,
    parse: Callable[[DataFrame], DataFrame],
    table: str,
    land: Callable[[DataFrame, str], int],
    trigger: dict,
) -> StreamingQuery:
    """Start a stream whose batches are runs of the ledger.

    A run is named by the query's id, which its checkpoint keeps, and the batch: batch numbers
    restart with a new checkpoint. The rejected messages are counted while `land` reads the batch
    for `table`; a batch is parsed again only where there are some, and never cached.
    """
    started, query = Event(), []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        run = f"{stream}-{query[0].id}-{batch_id}"
        parsed = parse(batch)

        def body(_: str) -> int:
            rejected = quarantined(parsed, stream)
            if warehouse.finished(table, run):  # a replay, whose batch `land` does not read
                landed, some = 0, not rejected.isEmpty()
            else:
                seen = Observation(f"rejected-{run}")
                bad = F.count(F.when(F.col("reason").isNotNull(), F.lit(1)))
                landed = land(usable(parsed.observe(seen, bad.alias("rejected"))), run)
                some = seen.get["rejected"] > 0
            if some:
                warehouse.append(rejected, "bronze.quarantine", run)
            return landed

        recorded(warehouse, stream, body, run_id=run, triggered_by="stream")

    query.append(
        messages.writeStream.outputMode("update")
        .queryName(stream)
        .foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
    started.set()
    return query[0]


def start_approach_stream(
    messages: DataFrame, warehouse: Warehouse, checkpoint: str, **trigger
) -> StreamingQuery:
    """Stream approach messages into bronze; keys already stored are ignored.

    Arrival order is the broker's where the source has one, else the order of the message texts.
    """
    order = [c for c in _SOURCE_ORDER if c in messages.columns] + ["value"]

    def land(rows: DataFrame, run: str) -> int:
        return land_approaches(warehouse, rows, run, order)

    return _start(
        messages, warehouse, checkpoint, "neo_stream_to_bronze", parse_approaches,
        "bronze.neo_event_raw", land,
        trigger or {"processingTime": "30 seconds"},
    )


def start_catalog_stream(
    messages: DataFrame, warehouse: Warehouse, checkpoint: str, **trigger
) -> StreamingQuery:
    """Stream catalog messages into bronze by plain append."""

    def land(rows: DataFrame, run: str) -> int:
        return append_catalog(warehouse, rows, run)

    return _start(
        messages, warehouse, checkpoint, "satcat_stream_to_bronze", parse_catalog,
        "bronze.satcat_raw", land,
        trigger or {"processingTime": "30 seconds"},
    )


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def start_unique_approach_stream(
    messages: DataFrame, warehouse: Warehouse, checkpoint: str, **trigger
) -> list[StreamingQuery]:
    """Stream approach messages into bronze; the keys seen so far are state of the stream.

    The state store (RocksDB, in the checkpoint) drops every key that came before, in this batch, an
    earlier one or before a restart. So a batch costs what it holds, whatever bronze has grown to.
    Keys that came to bronze by other ways are not known here: use one way per table. NULL is an
    ordinary value of a key. The state holds one entry per key for good, on the executors' disks.

    A second query takes the rejected messages to the quarantine.
    """
    trigger = trigger or {"processingTime": "30 seconds"}
    stream, parsed = "neo_stream_to_bronze", parse_approaches(messages)
    fresh = usable(parsed).dropDuplicates(APPROACH_KEY)

    def start(rows: DataFrame, name: str, write: Callable[[DataFrame, str], int]) -> StreamingQuery:
        started, query = Event(), []

        def on_batch(batch: DataFrame, batch_id: int) -> None:
            started.wait()
            run = f"{name}-{query[0].id}-{batch_id}"
            recorded(
                warehouse, name, lambda _: write(batch, run), run_id=run, triggered_by="stream"
            )

        query.append(
            rows.writeStream.outputMode("append")
            .queryName(name)
            .foreachBatch(on_batch)
            .option("checkpointLocation", f"{checkpoint}/{name}")
            .trigger(**trigger)
            .start()
        )
        started.set()
        return query[0]

    def reject(rows: DataFrame, run: str) -> int:
        kept, found = staged_with(rows, rows=F.count(F.lit(1)))
        if found["rows"]:
            warehouse.append(kept, "bronze.quarantine", run)
        return found["rows"]

    spark = messages.sparkSession
    before = spark.conf.get(_STATE_STORE)
    spark.conf.set(_STATE_STORE, ROCKSDB)
    try:
        rows = start(fresh, stream, lambda rows, run: append_approaches(warehouse, rows, run))
    finally:
        spark.conf.set(_STATE_STORE, before)
    return [rows, start(quarantined(parsed, stream), f"{stream}_quarantine", reject)]


def start_catalog_file_stream(
    messages: DataFrame, path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Stream usable catalog messages into Parquet files below `path`, each exactly once.

    The sink's own log says which files belong to finished batches; a restart neither repeats nor
    loses rows. `read_catalog_files` reads by that log. `id` is a hash of the message: equal messages
    have the same one, and it orders the snapshots of a day. Rejected messages are left out; a
    `start_catalog_stream` on the same source quarantines them.
    """
    parsed = parse_catalog(messages)
    rows = parsed.withColumns(
        {
            "id": F.xxhash64("value"),
            "ingestion_timestamp": F.current_timestamp(),
            "record": as_variant("parsed_record"),
        }
    )
    return (
        usable(rows)
        .select(*BRONZE_SATCAT.fieldNames())
        .writeStream.format("parquet")
        .queryName("satcat_stream_to_files")
        .outputMode("append")
        .option("path", path)
        .option("compression", COMPRESSION)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def read_catalog_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the finished batches of a file stream, shaped as `bronze.satcat_raw`."""
    return spark.read.schema(BRONZE_SATCAT).parquet(path)


class ProgressLog(StreamingQueryListener):
    """Notes the finished batches of the streams of a session.

        log = ProgressLog(); spark.streams.addListener(log); ...; log.store(warehouse, "monday")

    Events come asynchronously, on a thread that must not wait; `store` writes what has come so far.
    Batches without input are left out.
    """

    def __init__(self):
        self._seen: deque[tuple] = deque()

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name and p.numInputRows:
            began = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
            took = timedelta(milliseconds=p.durationMs.get("triggerExecution", 0))
            self._seen.append((p.name, str(p.id), p.batchId, began + took, p.numInputRows))

    def store(self, warehouse: Warehouse, run: str) -> int:
        """Append the batches seen since the last call to `meta.stream_progress`."""
        rows = [self._seen.popleft() for _ in range(len(self._seen))]
        if rows:
            frame = literal_rows(warehouse.spark, STREAM_PROGRESS, rows)
            warehouse.append(frame, "meta.stream_progress", run)
        return len(rows)


def silver_lag(
    progress: DataFrame, runs: DataFrame, limit_minutes: int = 30, within_days: int = 2
) -> DataFrame:
    """(stream, batch_id, input_rows, finished_at, silver_run, lag_seconds, is_fresh) of each batch.

    The first successful silver run that began after the batch took it over; the lag ends with it. A
    batch that none took over within about `within_days` has no lag and is not fresh. Batches meet
    the runs of their own and the next days only. A batch reported twice counts once.
    """
    silver = F.create_map(*[F.lit(x) for pair in TAKEN_OVER_BY.items() for x in pair])
    day = F.col("finished_at").cast("date")
    batches = (
        progress.dropDuplicates(["stream", "query_id", "batch_id"])
        .withColumn("pipeline_name", F.try_element_at(silver, F.col("stream")))
        .withColumn("days", F.sequence(day, F.date_add(day, within_days)))
    )
    took = runs.filter("status = 'success'").select(
        "pipeline_name",
        F.col("start_time").cast("date").alias("day"),
        F.struct("start_time", "end_time", "run_id").alias("taken"),
    )
    each = batches.withColumn("day", F.explode("days"))
    later = F.when(F.col("taken.start_time") >= F.col("finished_at"), F.col("taken"))
    first = (
        each.join(took, ["pipeline_name", "day"], "left")
        .groupBy("stream", "query_id", "batch_id", "input_rows", "finished_at")
        .agg(F.min(later).alias("taken"))
    )
    lag = F.timestamp_diff("SECOND", F.col("finished_at"), F.col("taken.end_time"))
    return first.select(
        "stream",
        "batch_id",
        "input_rows",
        "finished_at",
        F.col("taken.run_id").alias("silver_run"),
        lag.alias("lag_seconds"),
        F.coalesce(lag <= limit_minutes * 60, F.lit(False)).alias("is_fresh"),
    )


def quarantine_counts(quarantine: DataFrame) -> DataFrame:
    """Rejected messages per stream and reason."""
    return quarantine.groupBy("stream", "reason").agg(F.count(F.lit(1)).alias("messages"))
