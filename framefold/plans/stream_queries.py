"""Streaming operators drained over the given tables and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from framefold.plans import views as V
from framefold.plans.registry import query
from framefold.session import scratch_dir
from framefold.sources import catalogues as C
from framefold.sources import id_table as T
from framefold.sources import index_table as I
from framefold.streaming import jobs as S


def _stream(spark, sf, name):
    """The table as a file stream."""
    schema = V.table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}*.parquet")


def _status_stream(spark, sf):
    events = _stream(spark, sf, "events")
    status = (
        F.when(F.col("event_type") == "purchase", "SUCCEEDED")
        .when(F.col("event_type") == "error", "FAILED")
        .otherwise("IN_PROGRESS")
    )
    return events.select(
        F.col("user_id").alias("job_id"), status.alias("status"), F.col("ts").cast("timestamp").alias("ts")
    )


def _order_polls(orders):
    """Job status polls: one per order, the customer is the job."""
    status = (
        F.when(F.col("o_orderstatus") == "F", "FAILED")
        .when(F.col("o_orderstatus") == "O", "SUCCEEDED")
        .otherwise("IN_PROGRESS")
    )
    return orders.select(
        F.col("o_custkey").alias("job_id"), status.alias("status"), F.col("o_orderdate").cast("timestamp").alias("ts")
    )


@query(
    "stream_ingest",
    f"""WITH {V.SQL_CATALOGUE_B} SELECT campaign, response, pos, source_id, title, url, size, duration
        FROM hits_b WHERE url <> ''""",
)
def _(spark, sf):
    """Responses landed as JSON lines, then drained by a file stream into a candidate table."""
    root = scratch_dir(spark, "ingest")
    V.raw_catalogue_b(spark, sf).write.json(f"{root}/landed")
    raw = S.stream_ingest(spark, f"{root}/landed", "campaign string, response bigint")
    out = C.read_catalogue_b(raw).select(
        "campaign", "response", "pos", "source_id", "title", "url", "size", "duration"
    )
    S.drain(out, f"{root}/candidates", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/candidates")


@query(
    "terminal_jobs",
    f"""WITH {V.SQL_STATUS} SELECT job_id, min(ms) AS first_ms, arg_min(status, struct_pack(a := ms, b := status)) AS status
        FROM polls WHERE status IN ('SUCCEEDED', 'FAILED') GROUP BY 1""",
)
def _(spark, sf):
    root = scratch_dir(spark, "terminal")
    done = S.terminal_jobs(_status_stream(spark, sf))
    S.publish_view(done, f"{root}/done", f"{root}/checkpoint", ["job_id"]).awaitTermination()
    return S.read_view(spark, f"{root}/done", ["job_id"]).select(
        "job_id", F.unix_millis("ts").alias("first_ms"), "status"
    )


@query(
    "status_view",
    f"""WITH {V.SQL_STATUS} SELECT job_id, arg_max(status, ts) AS status, max(ms) AS last_ms, count(*) AS polls
        FROM polls GROUP BY 1""",
)
def _(spark, sf):
    root = scratch_dir(spark, "status")
    view = S.status_view(_status_stream(spark, sf))
    S.publish_view(view, f"{root}/view", f"{root}/checkpoint", ["job_id"]).awaitTermination()
    return S.read_view(spark, f"{root}/view", ["job_id"]).select(
        "job_id", "status", F.unix_millis("last_ts").alias("last_ms"), "polls"
    )


@query(
    "stalled_jobs",
    f"""WITH {V.SQL_STATUS}, custom AS (
          SELECT o_custkey AS job_id, CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'SUCCEEDED'
                 ELSE 'IN_PROGRESS' END AS status, o_orderdate AS ts FROM orders)
        SELECT job_id, epoch_ms(min(ts)) AS first_ms, epoch_ms(max(ts)) AS last_ms FROM custom
        GROUP BY 1 HAVING count(*) FILTER (status <> 'IN_PROGRESS') = 0
           AND epoch_ms(TIMESTAMP '2005-01-01') - epoch_ms(min(ts)) > 86400000""",
)
def _(spark, sf):
    polls = _order_polls(V.table(spark, sf, "orders"))
    late = S.stalled_jobs(polls, F.lit("2005-01-01").cast("timestamp"), 86400)
    return late.select(
        "job_id", F.unix_millis("first_ts").alias("first_ms"), F.unix_millis("last_ts").alias("last_ms")
    )


@query(
    "stalled_jobs_stream",
    """WITH custom AS (
          SELECT CAST(o_custkey AS VARCHAR) AS job_id, o_orderstatus IN ('F', 'O') AS done, CAST(o_orderdate AS TIMESTAMP) AS ts
          FROM orders),
        seen AS (SELECT job_id, min(ts) AS first_ts, bool_or(done) AS done FROM custom GROUP BY 1)
        SELECT job_id, epoch_ms(first_ts) AS first_ms FROM seen
        WHERE NOT done AND first_ts + INTERVAL 1 DAY <= (SELECT max(ts) FROM custom) - INTERVAL 1 DAY""",
)
def _(spark, sf):
    """Jobs reported by event-time timers, each once; the last event time decides which."""
    root = scratch_dir(spark, "stalled")
    polls = _order_polls(_stream(spark, sf, "orders"))
    polls = polls.withColumn("job_id", F.col("job_id").cast("string"))
    late = S.stalled_jobs_stream(polls, 86400, "1 day")
    S.drain(late, f"{root}/late", f"{root}/checkpoint").awaitTermination()
    late = spark.read.schema("job_id string, first_ts timestamp").parquet(f"{root}/late")
    return late.select("job_id", F.unix_millis("first_ts").alias("first_ms"))


@query(
    "terminal_jobs_stream",
    """WITH ends AS (
          SELECT CAST(o_custkey AS VARCHAR) AS job_id, CAST(o_orderdate AS TIMESTAMP) AS ts,
                 CASE o_orderstatus WHEN 'F' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status
          FROM orders WHERE o_orderstatus IN ('F', 'O')),
        firsts AS (SELECT job_id, min(ts) AS ts, arg_min(status, struct_pack(a := ts, b := status)) AS status FROM ends GROUP BY 1)
        SELECT job_id, status, epoch_ms(ts) AS first_ms FROM firsts
        WHERE ts <= (SELECT max(CAST(o_orderdate AS TIMESTAMP)) FROM orders) - INTERVAL 1 DAY""",
)
def _(spark, sf):
    """Jobs reported once with their first terminal status, from state that expires."""
    root = scratch_dir(spark, "ends")
    polls = _order_polls(_stream(spark, sf, "orders")).withColumn("job_id", F.col("job_id").cast("string"))
    S.drain(S.terminal_jobs_stream(polls, "1 day"), f"{root}/ends", f"{root}/checkpoint").awaitTermination()
    ends = spark.read.schema("job_id string, status string, ts timestamp").parquet(f"{root}/ends")
    return ends.select("job_id", "status", F.unix_millis("ts").alias("first_ms"))


@query(
    "stream_drop_indexed",
    f"""WITH {V.SQL_CAND}, {V.SQL_INDEX} SELECT campaign, source, source_id, pos FROM cand c
        WHERE NOT EXISTS (SELECT 1 FROM idx i WHERE i.campaign = c.campaign AND i.source = c.source
          AND i.source_id = c.source_id AND c.source_id <> '')""",
)
def _(spark, sf):
    root = scratch_dir(spark, "fresh")
    docs = _stream(spark, sf, "documents").select(
        F.lit("video").alias("media_type"),
        F.col("lang").alias("campaign"),
        "source",
        F.when(F.col("n_chars") % 10 == 0, "").otherwise(F.col("doc_id").cast("string")).alias("source_id"),
        F.col("doc_id").alias("pos"),
    )
    ids = f"stream_ids_{uuid.uuid4().hex}"
    T.create_id_table(spark, ids, f"{root}/ids")
    T.append_ids(V.index_rows(spark, sf), ids)
    S.drain_fresh(docs, ids, f"{root}/fresh", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(docs.schema).parquet(f"{root}/fresh").select("campaign", "source", "source_id", "pos")


@query(
    "stream_upsert",
    f"""WITH {V.SQL_STATUS} SELECT 'j' || job_id AS s3_key, arg_max(status, ts) AS metadata, max(ms) AS last_ms
        FROM polls GROUP BY 1""",
)
def _(spark, sf):
    """Every status poll upserts its job's record; the newest stays."""
    root = scratch_dir(spark, "upsert")
    rows = _status_stream(spark, sf).select(
        F.lit("video").alias("media_type"),
        F.lit("all").alias("campaign"),
        F.concat(F.lit("j"), F.col("job_id").cast("string")).alias("s3_key"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("processed_at"),
        F.unix_millis("ts").alias("ttl"),
        F.col("status").alias("metadata"),
    )
    S.stream_upsert(
        rows, f"{root}/index", f"{root}/checkpoint", I.KEY, ["processed_at"]
    ).awaitTermination()
    return I.read_index(spark, f"{root}/index").select("s3_key", "metadata", F.col("ttl").alias("last_ms"))


@query(
    "stream_stats",
    f"WITH {V.SQL_STATUS} SELECT job_id, status, count(*) AS n FROM polls GROUP BY ALL",
)
def _(spark, sf):
    root = scratch_dir(spark, "stats")
    stats = S.stream_stats(_status_stream(spark, sf), ["job_id", "status"])
    S.publish_view(stats, f"{root}/stats", f"{root}/checkpoint", ["job_id", "status"]).awaitTermination()
    return S.read_view(spark, f"{root}/stats", ["job_id", "status"])
