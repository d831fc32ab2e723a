"""Named queries: each takes a session and a table folder, and returns a frame."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from .. import operators as op
from .. import store
from ..functions.keys import document_id, with_message_key
from ..session import JOB_CONF, conf_values, materialise, scratch_dir
from ..sources import decode_kafka, load_json_results, read_events, read_log_files, read_paced_lines
from ..store import paths
from ..streaming import (
    ANALYSES, combined_progress, each_batch, live_spikes as spikes_of_stream, rank_error, read_combined, read_refused_documents, read_rollup, read_summaries, start_all, status, stop, stored_percentiles, stored_top_k,
    to_combined, to_documents, to_files, to_rollups, to_summaries, wait_all,
)
from . import inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STREAM_SLICES = 3
PERCENTS = (0.5, 0.9, 0.99)
SPIKES = "window_start timestamp, request_count bigint, baseline double, threshold double"


def query(fn: Query) -> Query:
    """Register a query; instants leave it as plain UTC times without a zone."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        return df.select(
            *[
                F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else f.name
                for f in df.schema.fields
            ]
        )

    QUERIES[fn.__name__] = run
    return fn


def _parsed(spark: SparkSession, sf_dir: str, combined: bool = False) -> DataFrame:
    return op.parse_clf(inputs.raw_lines(spark, sf_dir, combined), combined=combined)


# Lines and fields


@query
def format_clf(spark, sf_dir):
    requests = inputs.requests(spark, sf_dir)
    return op.format_clf(requests, keep=["event_id"])


@query
def log_files(spark, sf_dir):
    folder = f"{scratch_dir(spark)}/logs"
    # Every seventh line is followed by a blank one, which reading leaves out.
    blank = F.when(F.col("event_id") % 7 == 0, F.concat("raw_log", F.lit("\n \t "))).otherwise(F.col("raw_log"))
    inputs.raw_lines(spark, sf_dir).select(blank.alias("value")).write.text(folder)
    return read_log_files(spark, folder)


@query
def max_lines(spark, sf_dir):
    folder = f"{scratch_dir(spark)}/logs"
    inputs.raw_lines(spark, sf_dir).select("raw_log").write.text(folder)
    capped = read_log_files(spark, folder, max_lines=500)
    return capped.agg(F.count("*").alias("line_count"))


@query
def message_key(spark, sf_dir):
    return with_message_key(inputs.raw_lines(spark, sf_dir))


@query
def parse_clf(spark, sf_dir):
    events = op.parse_clf(decode_kafka(inputs.topic_rows(spark, sf_dir)))
    return events.drop("hour", "minute")


@query
def buckets(spark, sf_dir):
    return _parsed(spark, sf_dir).select("ip", "url", "timestamp", "hour", "minute")


@query
def parse_offsets(spark, sf_dir):
    lines = inputs.raw_lines(spark, sf_dir, offsets=True)
    return op.parse_clf(lines, keep=["event_id"]).select("event_id", "timestamp")


@query
def parse_wall_clock(spark, sf_dir):
    lines = inputs.raw_lines(spark, sf_dir, offsets=True)
    return op.parse_clf(lines, keep_offset=False, keep=["event_id"]).select("event_id", "timestamp")


@query
def parse_null_timestamps(spark, sf_dir):
    lines = inputs.raw_lines(spark, sf_dir)
    events = op.parse_clf(lines, on_bad_ts="null", identity=True, keep=["event_id"])
    return events.select("event_id", "ip", "remote_log_name", "remote_user", "timestamp", "status_code")


@query
def parse_bad_times_as_now(spark, sf_dir):
    events = op.parse_clf(inputs.raw_lines(spark, sf_dir), on_bad_ts="now", keep=["event_id"])
    age = F.unix_seconds(F.current_timestamp()) - F.unix_seconds("timestamp")
    return events.select("event_id", (age.between(-3600, 3600)).alias("stamped_now"))


@query
def parse_combined(spark, sf_dir):
    return _parsed(spark, sf_dir, combined=True).select("ip", "timestamp", "url", "referrer", "agent")


@query
def rejects(spark, sf_dir):
    return op.rejects(inputs.raw_lines(spark, sf_dir)).select("raw_log", "cause")


@query
def reject_counts(spark, sf_dir):
    return op.reject_counts(inputs.raw_lines(spark, sf_dir))


@query
def reject_fields(spark, sf_dir):
    """Lines with one field after the other damaged on purpose, and what is named as broken."""
    raw, which = F.col("raw_log"), F.col("event_id") % 8
    damaged = (
        F.when(which == 1, "").when(which == 2, F.substring_index(raw, " ", 1)).when(which == 3, F.substring_index(raw, " ", 2))
        .when(which == 4, F.replace(raw, F.lit("["), F.lit("("))).when(which == 5, F.replace(raw, F.lit('"'), F.lit("'")))
        .when(which == 6, F.replace(raw, F.lit('" '), F.lit('" x'))).when(which == 7, F.regexp_replace(raw, " [^ ]*$", "")).otherwise(raw)
    )
    lines = inputs.raw_lines(spark, sf_dir).filter("event_id % 97 <> 0").select("event_id", damaged.alias("raw_log"))
    return op.reject_fields(lines, keep=["event_id"]).select("event_id", "cause", "field", "position")


# The four analyses


@query
def error_events(spark, sf_dir):
    return op.error_events(_parsed(spark, sf_dir))


@query
def traffic_minute(spark, sf_dir):
    return op.traffic(_parsed(spark, sf_dir))


@query
def ip_activity(spark, sf_dir):
    return op.ip_activity(_parsed(spark, sf_dir))


@query
def url_activity(spark, sf_dir):
    return op.url_activity(_parsed(spark, sf_dir))


def _slices(spark: SparkSession, sf_dir: str, base: str) -> None:
    """Log files in one folder for each slice of time, below ``staged``: one read of the table."""
    lines = inputs.raw_lines(spark, sf_dir)
    first, last = lines.agg(F.min("timestamp"), F.max("timestamp")).select(
        F.unix_micros("min(timestamp)"), F.unix_micros("max(timestamp)")
    ).first()
    step = (last - first) // STREAM_SLICES + 1
    number = F.floor((F.unix_micros("timestamp") - F.lit(first)) / F.lit(step))
    lines.select("raw_log", number.alias("slice")).write.partitionBy("slice").text(f"{base}/staged")


def _deliver(spark: SparkSession, base: str, numbers: Iterable[int]) -> None:
    """Let slices arrive in the folder that the stream reads."""
    for number in numbers:
        paths.move(spark, f"{base}/staged/slice={number}", f"{base}/logs/slice={number}")


def _run(spark: SparkSession, base: str, analyses: Iterable[str], rejects: bool = False, **source) -> dict:
    """Start the analyses on what has arrived, and wait until they have read it."""
    lines = read_log_files(spark, f"{base}/logs", streaming=True, **source)
    running = start_all(
        op.parse_clf(lines),
        f"{base}/tables",
        f"{base}/checkpoints",
        analyses=analyses,
        available_now=True,
        state_partitions=spark.sparkContext.defaultParallelism,
        lines=lines if rejects else None,
    )
    wait_all(spark, running)
    return running


def _streamed(spark: SparkSession, sf_dir: str, analysis: str) -> DataFrame:
    """Log files that arrive in time order, through the stream into its table.

    The query is stopped and resumed after each delivery. All files of one delivery
    form one batch, so the watermark never passes a line that is still to come.
    """
    base = scratch_dir(spark)
    _slices(spark, sf_dir, base)
    for number in range(STREAM_SLICES):
        _deliver(spark, base, [number])
        _run(spark, base, [analysis])
    return store.read_latest(spark, analysis, f"{base}/tables").drop("processed_at")


@query
def error_stream(spark, sf_dir):
    return _streamed(spark, sf_dir, "error_logs")


@query
def traffic_stream(spark, sf_dir):
    return _streamed(spark, sf_dir, "traffic_by_minute")


@query
def ip_stream(spark, sf_dir):
    return _streamed(spark, sf_dir, "top_ips")


@query
def url_stream(spark, sf_dir):
    return _streamed(spark, sf_dir, "url_analysis")


@query
def rejects_stream(spark, sf_dir):
    base = scratch_dir(spark)
    _slices(spark, sf_dir, base)
    for number in range(STREAM_SLICES):
        _deliver(spark, base, [number])
        _run(spark, base, [], rejects=True)
    return store.read_latest(spark, "rejects", f"{base}/tables").select("raw_log", "cause")


@query
def pipeline_stream(spark, sf_dir):
    """The four analyses and the rejects as one job; rows and requests of each table."""
    base = scratch_dir(spark)
    _slices(spark, sf_dir, base)
    _deliver(spark, base, range(STREAM_SLICES))
    found = None
    for name in _run(spark, base, ANALYSES, rejects=True):
        table = store.read_latest(spark, name, f"{base}/tables")
        requests = F.sum("request_count") if "request_count" in table.columns else F.count("*")
        row = table.agg(F.count("*").alias("row_count"), requests.alias("requests"))
        row = row.select(F.lit(name).alias("analysis"), "row_count", "requests")
        found = row if found is None else found.unionByName(row)
    return found


@query
def late_rows(spark, sf_dir):
    """The first slice of time arrives last: its windows are closed, so its lines are left out."""
    base = scratch_dir(spark)
    _slices(spark, sf_dir, base)
    for numbers in (range(1, STREAM_SLICES), [0]):
        _deliver(spark, base, numbers)
        _run(spark, base, ["traffic_by_minute"])
    return store.read_latest(spark, "traffic_by_minute", f"{base}/tables").drop("processed_at")


def _combined(spark: SparkSession, sf_dir: str, deliveries: Iterable[Iterable[int]]) -> str:
    """The four analyses from one parse, started again for each delivery."""
    base = scratch_dir(spark)
    _slices(spark, sf_dir, base)
    for numbers in deliveries:
        _deliver(spark, base, numbers)
        events = op.parse_clf(read_log_files(spark, f"{base}/logs", streaming=True))
        wait_all(spark, {"combined": to_combined(events, f"{base}/combined", f"{base}/checkpoint", available_now=True)})
    return f"{base}/combined"


@query
def combined_stream(spark, sf_dir):
    """All rows of the four tables after three starts; each line is read and parsed once."""
    root = _combined(spark, sf_dir, [[number] for number in range(STREAM_SLICES)])
    found = None
    for name in ANALYSES:
        table = read_combined(spark, root, name).withColumnsRenamed({"minute": "seen_at", "window_start": "seen_at", "timestamp": "seen_at"})
        key = F.concat_ws(" ", *[c for c in ("ip", "method", "url", "status_code") if c in table.columns])
        requests = F.col("request_count") if "request_count" in table.columns else F.lit(1).cast("bigint")
        rows = table.select(F.lit(name).alias("analysis"), "seen_at", key.alias("key"), "log_type", requests.alias("requests"))
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def late_row_counts(spark, sf_dir):
    """The first slice of time arrives last: every line of it is counted as late, not just its windows."""
    root = _combined(spark, sf_dir, [range(1, STREAM_SLICES), [0]])
    counted = {name: read_combined(spark, root, name).agg(F.sum("request_count")).scalar() for name in ANALYSES if name != "error_logs"}
    kept = F.create_map(*[c for name, total in counted.items() for c in (F.lit(name), total)])
    found = combined_progress(spark, root)
    return found.select("analysis", "total_rows", "total_late_rows", kept[F.col("analysis")].alias("requests"))


@query
def paced_stream(spark, sf_dir):
    """One file per batch gives the rows of one batch."""
    base = scratch_dir(spark)
    _slices(spark, sf_dir, base)
    _deliver(spark, base, range(STREAM_SLICES))
    _run(spark, base, ["error_logs"], max_files_per_trigger=1)
    return store.read_latest(spark, "error_logs", f"{base}/tables").drop("processed_at")


@query
def empty_batches(spark, sf_dir):
    """The second of three batches has no errors: it leaves no folder, and the numbers go on."""
    base = scratch_dir(spark)
    _slices(spark, sf_dir, base)
    for number in range(STREAM_SLICES):
        _deliver(spark, base, [number])
        events = op.parse_clf(read_log_files(spark, f"{base}/logs", streaming=True))
        events = events.filter("status_code < 400") if number == 1 else events
        wait_all(spark, start_all(events, f"{base}/tables", f"{base}/checkpoints", analyses=["error_logs"], available_now=True))
    stored = spark.read.schema("url string, batch_id bigint").parquet(f"{store.table_path(f'{base}/tables', 'error_logs')}/batches")
    last = store.last_batch(spark, f"{base}/tables", "error_logs")
    return stored.groupBy("batch_id").agg(F.count("*").alias("row_count")).withColumn("last_batch", F.lit(last).cast("bigint"))


@query
def paced_lines(spark, sf_dir):
    """A tenth of the lines in each batch, over the ends of files; started again after the first batch."""
    base = scratch_dir(spark)
    inputs.raw_lines(spark, sf_dir).select("raw_log").write.text(f"{base}/logs")
    size = 1 + spark.read.text(f"{base}/logs").count() // 10
    for first in (True, False):
        query = each_batch(
            read_paced_lines(spark, f"{base}/logs", size), lambda batch, n: batch.write.mode("overwrite").parquet(f"{base}/batches/batch_id={n}"),
            f"{base}/checkpoint", "append", trigger="0 seconds", available_now=first,
        )
        if first:
            wait_all(spark, {"paced": query})
        else:
            query.processAllAvailable()
            query.stop()
    stored = spark.read.schema("raw_log string, batch_id bigint").parquet(f"{base}/batches")
    errors = op.error_events(op.parse_clf(stored.select("raw_log"))).agg(F.count("*")).scalar()
    return stored.groupBy("batch_id").agg(F.count("*").alias("line_count")).select("batch_id", "line_count", errors.alias("errors"))


@query
def stream_status(spark, sf_dir):
    """Status of a job that has read everything in one batch; then nothing runs any more."""
    base = scratch_dir(spark)
    _slices(spark, sf_dir, base)
    _deliver(spark, base, range(STREAM_SLICES))
    queries = _run(spark, base, ["error_logs"])
    rows = status(spark, list(queries.values()), f"{base}/tables")
    stopped = stop(queries.values())
    return rows.select("name", "active", "batch_id", "input_rows", "refused_rows", F.lit(stopped).cast("bigint").alias("stopped"))


@query
def stored_events(spark, sf_dir):
    base = scratch_dir(spark)
    inputs.raw_lines(spark, sf_dir).select("raw_log").write.text(f"{base}/logs")
    events = op.parse_clf(read_log_files(spark, f"{base}/logs", streaming=True))
    wait_all(spark, {"events": to_files(events, f"{base}/events", f"{base}/checkpoint", available_now=True)})
    return read_events(spark, f"{base}/events").drop("kafka_timestamp", "hour", "minute")


# Live metrics


def _in_turns(spark: SparkSession, sf_dir: str, start: Callable) -> str:
    """Log files that arrive in time order; ``start(events, folder)`` is started and awaited after each delivery."""
    base = scratch_dir(spark)
    _slices(spark, sf_dir, base)
    provider = JOB_CONF["spark.sql.streaming.stateStore.providerClass"]
    for number in range(STREAM_SLICES):
        _deliver(spark, base, [number])
        events = op.parse_clf(read_log_files(spark, f"{base}/logs", streaming=True))
        with conf_values(spark, spark__sql__streaming__stateStore__providerClass=provider, spark__sql__shuffle__partitions=spark.sparkContext.defaultParallelism):
            wait_all(spark, {"live": start(events, base)})
    return base


@query
def live_spikes(spark, sf_dir):
    """Spikes among the hours that the stream has closed, over three starts."""
    base = _in_turns(spark, sf_dir, lambda events, base: to_files(
        spikes_of_stream(events, z=2.0), f"{base}/spikes", f"{base}/checkpoint", available_now=True))
    return spark.read.schema(SPIKES).parquet(f"{base}/spikes")


@query
def live_spikes_by_url(spark, sf_dir):
    """Spikes of each page among its six-hour windows; windows without a request count as zero."""
    base = _in_turns(spark, sf_dir, lambda events, base: to_files(
        spikes_of_stream(events, "6 hours", 12, 1.5, min_history=8, fill_gaps=True, by=["url"]), f"{base}/spikes", f"{base}/checkpoint", available_now=True))
    return spark.read.schema(f"url string, {SPIKES}").parquet(f"{base}/spikes")


def _summarised(spark: SparkSession, sf_dir: str) -> str:
    return _in_turns(spark, sf_dir, lambda events, base: to_summaries(
        events, f"{base}/summaries", f"{base}/checkpoint", available_now=True, width="1 day", by=["status_code"], top=["ip"], values=["content_size"]))


@query
def live_top_ips(spark, sf_dir):
    """Candidates from the stored sketches of the stream, counted in the events."""
    base = _summarised(spark, sf_dir)
    return stored_top_k(read_summaries(spark, f"{base}/summaries"), _parsed(spark, sf_dir).select("ip"), "ip", 20)


@query
def live_percentiles(spark, sf_dir):
    """Sketched sizes beside the sizes themselves: is each rank within the stated error?"""
    base = _summarised(spark, sf_dir)
    found = stored_percentiles(read_summaries(spark, f"{base}/summaries"), "content_size", PERCENTS, ["status_code"])
    asked = [F.struct(F.lit(p).alias("percent"), F.col(f"p{100 * p:.10g}").alias("answer")) for p in PERCENTS]
    asked = found.select(F.col("status_code").alias("status"), "value_count", F.explode(F.array(*asked)).alias("a")).select("status", "value_count", "a.*")
    sizes = _sizes(spark, sf_dir).filter("content_size IS NOT NULL")
    below = F.sum((F.col("content_size") < F.col("answer")).cast("bigint")) / F.col("value_count")
    upto = F.sum((F.col("content_size") <= F.col("answer")).cast("bigint")) / F.col("value_count")
    # Few answers for each status: no pair of rows that is not wanted.
    met = asked.join(sizes, asked["status"] == sizes["status_code"]).groupBy("status_code", "value_count", "percent").agg(below.alias("below"), upto.alias("upto"))
    near = (F.col("below") <= F.col("percent") + rank_error()) & (F.col("upto") >= F.col("percent") - rank_error())
    return met.select("status_code", "value_count", "percent", near.alias("within_error"))


@query
def rollup_stream(spark, sf_dir):
    """Hours and days of the stream, renewed from changed minutes after each delivery."""
    base = _in_turns(spark, sf_dir, lambda events, base: to_rollups(events, f"{base}/rollups", f"{base}/checkpoint", keys=["status_code"], available_now=True))
    levels = [read_rollup(spark, f"{base}/rollups", level).select(F.lit(level).alias("level"), "window_start", "status_code", "request_count") for level in ("minute", "hour", "day")]
    return levels[0].unionByName(levels[1]).unionByName(levels[2])


# Result tables


@query
def append_errors(spark, sf_dir):
    root = scratch_dir(spark)
    store.ensure_tables(spark, root)
    errors = op.error_events(_parsed(spark, sf_dir))
    store.append_rows(errors.filter("status_code < 500"), "error_logs", root)
    store.append_rows(errors.filter("status_code >= 500"), "error_logs", root)
    return store.read_latest(spark, "error_logs", root).drop("processed_at")


def _misfits(errors: DataFrame) -> DataFrame:
    """Every 403 gets a status that is no number."""
    status_code = F.when(F.col("status_code") == 403, "forbidden").otherwise(F.col("status_code").cast("string"))
    return errors.withColumn("status_code", status_code)


@query
def append_counts(spark, sf_dir):
    """Rows written and refused, as reported and as found; each stored row is stamped."""
    root = scratch_dir(spark)
    result = store.append_rows(_misfits(op.error_events(_parsed(spark, sf_dir))), "error_logs", root)
    found = store.read_latest(spark, "error_logs", root).agg(
        F.count("*").alias("stored"), F.count("processed_at").alias("stamped")
    )
    refused = store.read_refused(spark, "error_logs", root).agg(F.count("*").alias("kept"))
    counts = [F.lit(n).cast("bigint").alias(name) for n, name in zip(result, ("written", "failed"), strict=True)]
    return found.select(*counts, "stored", "stamped", refused.scalar().alias("kept"))


@query
def refused_rows(spark, sf_dir):
    root = scratch_dir(spark)
    store.append_rows(_misfits(op.error_events(_parsed(spark, sf_dir))), "error_logs", root)
    document = F.from_json("document", "ip string, url string, status_code string")
    return store.read_refused(spark, "error_logs", root).select(document.alias("d")).select("d.*")


@query
def refused_causes(spark, sf_dir):
    """Which field of the refused rows does not fit, and what it holds."""
    root = scratch_dir(spark)
    store.append_rows(_misfits(op.error_events(_parsed(spark, sf_dir))), "error_logs", root)
    causes = op.refusal_reasons(store.read_refused(spark, "error_logs", root), "error_logs")
    return causes.groupBy("field", "value", "expected").agg(F.count("*").alias("row_count"))


def _folder_target(folder: str) -> Callable:
    """A stand-in for a search index: a file for each bulk; it does not accept status 403."""

    def send(bulk):
        import json
        import uuid

        from pyarrow import fs

        path = "/" + folder[5:].lstrip("/") if folder.startswith("file:") else folder
        filesystem, base = fs.FileSystem.from_uri(path)
        filesystem.create_dir(base, recursive=True)
        refused = [place for place, (_, document) in enumerate(bulk) if json.loads(document)["status_code"] == 403]
        taken = [{"doc_id": doc_id, "document": document} for place, (doc_id, document) in enumerate(bulk) if place not in set(refused)]
        with filesystem.open_output_stream(f"{base}/{uuid.uuid4().hex}.json") as file:
            file.write("".join(json.dumps(row) + "\n" for row in taken).encode())
        return [(place, "status 403 is not accepted") for place in refused]

    return send


@query
def document_sink(spark, sf_dir):
    """Documents the target took, and those it refused with its reason, over three starts."""
    base = scratch_dir(spark)
    _slices(spark, sf_dir, base)
    target = _folder_target(f"{base}/index")
    for number in range(STREAM_SLICES):
        _deliver(spark, base, [number])
        errors = op.error_events(op.parse_clf(read_log_files(spark, f"{base}/logs", streaming=True)))
        wait_all(spark, {"documents": to_documents(errors, "error_logs", target, f"{base}/sent", f"{base}/checkpoint", available_now=True)})
    refused = read_refused_documents(spark, "error_logs", f"{base}/sent").select("doc_id", "document", "reason")
    taken = spark.read.schema("doc_id string, document string").json(f"{base}/index").withColumn("reason", F.lit("taken"))
    fields = F.from_json("document", "url string, status_code int").alias("d")
    found = refused.unionByName(taken).select("doc_id", "reason", fields).select("doc_id", "reason", "d.*")
    return found.groupBy("reason", "status_code", "url").agg(F.countDistinct("doc_id").alias("documents"))


@query
def drop_table(spark, sf_dir):
    """Rows before the drop, what dropping twice says, and rows after it."""
    root = scratch_dir(spark)
    store.append_rows(op.error_events(_parsed(spark, sf_dir)), "error_logs", root)
    rows = store.read_latest(spark, "error_logs", root).count()
    dropped = [store.drop_table(spark, root, "error_logs") for _ in range(2)]
    after = store.read_latest(spark, "error_logs", root).agg(F.count("*").alias("rows_after"))
    return after.select(
        F.lit(rows).cast("bigint").alias("rows_before"), F.lit(dropped[0]).alias("dropped"), F.lit(dropped[1]).alias("dropped_again"), "rows_after"
    )


@query
def table_compaction(spark, sf_dir):
    root = scratch_dir(spark)
    store.ensure_tables(spark, root)
    events = _parsed(spark, sf_dir)
    store.append_rows(op.traffic(events.filter("status_code < 400")), "traffic_by_minute", root)
    store.compact(spark, "traffic_by_minute", root)
    store.append_rows(op.traffic(events), "traffic_by_minute", root)
    store.compact(spark, "traffic_by_minute", root)
    store.vacuum(spark, "traffic_by_minute", root)
    # A second batch in one day rewrites that day alone; a third stays beside the compacted days.
    for day in ("2024-01-03", "2024-01-04"):
        store.append_rows(op.traffic(events.filter(F.to_date("timestamp") == day)), "traffic_by_minute", root)
        if day == "2024-01-03":
            store.compact(spark, "traffic_by_minute", root)
    return store.read_latest(spark, "traffic_by_minute", root).drop("processed_at")


@query
def table_days(spark, sf_dir):
    """Three days of a compacted table: only their folders are read."""
    root = scratch_dir(spark)
    store.append_rows(op.traffic(_parsed(spark, sf_dir)), "traffic_by_minute", root)
    store.compact(spark, "traffic_by_minute", root)
    return store.read_latest(spark, "traffic_by_minute", root, since="2024-01-05", until="2024-01-07").drop("processed_at")


@query
def json_table(spark, sf_dir):
    root = scratch_dir(spark)
    store.append_rows(op.url_activity(_parsed(spark, sf_dir)), "url_analysis", root, fmt="json")
    return store.read_latest(spark, "url_analysis", root).drop("processed_at")


@query
def json_results(spark, sf_dir):
    root = scratch_dir(spark)
    lines = inputs.raw_lines(spark, sf_dir)
    errors = op.error_events(op.parse_clf(lines))
    # Lines that are no log lines are no JSON documents either.
    unreadable = op.rejects(lines).select(F.col("raw_log").alias("value"))
    documents = errors.select(F.to_json(F.struct("*")).alias("value"))
    documents.unionByName(unreadable).write.text(f"{root}/error_logs")
    return load_json_results(spark, root, pattern="*.txt")["error_logs"]


@query
def document_ids(spark, sf_dir):
    activity = op.ip_activity(_parsed(spark, sf_dir))
    return activity.select("window_start", "ip", document_id(activity, "top_ips").alias("doc_id"))


@query
def upsert_latest(spark, sf_dir):
    events = _parsed(spark, sf_dir).select("ip", "url", "timestamp", "method", "status_code", "content_size")
    current, updates = events.filter("status_code < 400"), events.filter("status_code >= 400")
    return op.upsert(current, updates, ["ip", "url"], order_by="timestamp")


@query
def search(spark, sf_dir):
    errors = op.error_events(_parsed(spark, sf_dir))
    hits = op.search(
        errors,
        (F.col("status_code") == 404) & F.col("url").startswith("/error/1"),
        order_by=[F.desc("timestamp"), F.asc("ip"), F.asc("url")],
        size=100,
    )
    return hits.select("timestamp", "ip", "url", "status_code")


@query
def search_text(spark, sf_dir):
    events = _parsed(spark, sf_dir, combined=True)
    return op.search_text(events, ["url", "agent"], "Firefox purchase").select("ip", "timestamp", "url", "agent")


@query
def search_text_scripts(spark, sf_dir):
    """Words beyond ASCII: a Cyrillic section on every fifth event."""
    events = _parsed(spark, sf_dir)
    section = F.when(F.col("url").endswith("5"), F.concat(F.lit("/Новости/Café"), "url")).otherwise(F.col("url"))
    return op.search_text(events.withColumn("url", section), ["url"], "новости café").select("ip", "timestamp", "url")


@query
def search_ranked(spark, sf_dir):
    events = _parsed(spark, sf_dir, combined=True).select("ip", "timestamp", "url", "agent")
    best = op.search_ranked(events, ["url", "agent"], ["firefox", "purchase 3", "linux"], 200, ["timestamp", "ip", "url", "agent"])
    return best.withColumn("score", F.round("score", 6))


@query
def table_stats(spark, sf_dir):
    return op.table_stats(op.error_events(_parsed(spark, sf_dir)), "timestamp")


@query
def retain(spark, sf_dir):
    events = _parsed(spark, sf_dir).select("ip", "timestamp", "url")
    return op.retain(events, "timestamp", 10, as_of="2024-01-31 12:00:00")


# Reports


@query
def traffic_hour(spark, sf_dir):
    return op.traffic(_parsed(spark, sf_dir), "1 hour", bucket="hour")


@query
def request_rate(spark, sf_dir):
    return op.request_rate(_parsed(spark, sf_dir))


@query
def status_distribution(spark, sf_dir):
    return op.status_distribution(_parsed(spark, sf_dir))


@query
def error_trend(spark, sf_dir):
    return op.error_trend(_parsed(spark, sf_dir))


@query
def top_ips(spark, sf_dir):
    return op.top_k(_parsed(spark, sf_dir), "ip", 20)


@query
def top_urls(spark, sf_dir):
    return op.top_k(_parsed(spark, sf_dir), "url", 20)


@query
def top_urls_daily(spark, sf_dir):
    return op.top_k(_parsed(spark, sf_dir), "url", 5, width="1 day")


@query
def heat_map(spark, sf_dir):
    return op.heat_map(_parsed(spark, sf_dir))


@query
def agent_stats(spark, sf_dir):
    return op.agent_stats(_parsed(spark, sf_dir, combined=True))


@query
def product_stats(spark, sf_dir):
    return op.product_stats(_parsed(spark, sf_dir, combined=True))


@query
def referrer_stats(spark, sf_dir):
    return op.referrer_stats(_parsed(spark, sf_dir, combined=True))


@query
def spikes(spark, sf_dir):
    return op.spikes(_parsed(spark, sf_dir), z=2.0)


@query
def spikes_with_gaps(spark, sf_dir):
    """Minutes without traffic count as zero."""
    return op.spikes(_parsed(spark, sf_dir), width="1 minute", lookback=30, z=3.0, fill_gaps=True)


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("status_code", *[F.round(c, 6).alias(c) for c in df.columns if c != "status_code"])


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of the parsed events, stored."""
    return materialise(_parsed(spark, sf_dir).select("status_code", "content_size"))


@query
def value_percentiles(spark, sf_dir):
    sizes = _parsed(spark, sf_dir).select("status_code", "content_size")
    return _rounded(op.value_percentiles(sizes, "content_size", ["status_code"], PERCENTS))


# Both have always had the same SQL; there is one way now, at any size.
@query
def value_percentiles_by_cell(spark, sf_dir):
    sizes = _parsed(spark, sf_dir).select("status_code", "content_size")
    return _rounded(op.value_percentiles(sizes, "content_size", ["status_code"], PERCENTS))


@query
def locate(spark, sf_dir):
    events = _parsed(spark, sf_dir).select("ip", "timestamp", "url")
    return op.locate(events, inputs.ip_ranges(spark, sf_dir))


@query
def locate_networks(spark, sf_dir):
    """Clients of both families, nested networks."""
    events = inputs.mixed_clients(_parsed(spark, sf_dir).select("ip", "timestamp", "url"))
    return op.locate_networks(events, inputs.networks(spark, sf_dir), "client")
