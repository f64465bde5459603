"""Index, statistics, set, execution and sink queries on the given tables."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from framefold.constants import PREDEFINED_CAMPAIGNS, SOURCES
from framefold.functions.documents import canonical_json, field_or, json_or_empty
from framefold.functions.keys import execution_id, parse_key
from framefold.functions.times import event_time
from framefold.operators import aggregates as A
from framefold.operators import joins as J
from framefold.operators import ranking as R
from framefold.operators.detections import analysis_parts, reduce_pages, summarize_reduced
from framefold.operators.sets import campaign_catalogue
from framefold.plans import views as V
from framefold.plans.batch import run_batch
from framefold.plans.registry import query
from framefold.session import scratch_dir, shuffles_freed
from framefold.sources import executions as E
from framefold.sources import index_table as I
from framefold.sources.detections import gate_flags, gate_succeeded, land_pages, parse_responses, parse_status
from framefold.sources.objects import list_keys, scan_objects, source_flags
from framefold.sources.sinks import notifications, write_analysis, write_assets

_INDEX_COLS = ["s3_key", "campaign", "source", "processed_at", "ttl"]

# --- S6, S11, P14, P19, W5, T8 ---------------------------------------------------


@query(
    "query_index",
    f"""WITH {V.SQL_INDEX} SELECT {', '.join(_INDEX_COLS)} FROM idx WHERE campaign = 'en' AND media_type = 'video'
        ORDER BY processed_at DESC, s3_key LIMIT 100""",
)
def _(spark, sf):
    return I.query_index(V.index_rows(spark, sf), "en", "video", 100).select(*_INDEX_COLS)


def _updates(spark, sf):
    """Every indexed item again: newer for some, older for the rest."""
    newer = F.col("ttl") % 2 == 0
    return V.index_rows(spark, sf).withColumn(
        "processed_at", F.when(newer, "2025-01-01").otherwise("2023-01-01")
    )


_UPSERTED = f"""WITH {V.SQL_INDEX}, both_rows AS (
    SELECT s3_key, campaign, source, processed_at, ttl FROM idx
    UNION ALL
    SELECT s3_key, campaign, source,
           CASE WHEN ttl % 2 = 0 THEN '2025-01-01' ELSE '2023-01-01' END, ttl FROM idx)
  SELECT * FROM both_rows QUALIFY row_number() OVER (PARTITION BY s3_key ORDER BY processed_at DESC) = 1"""


@query("upsert_index", _UPSERTED)
def _(spark, sf):
    merged = I.upsert_index(V.index_rows(spark, sf), _updates(spark, sf))
    return merged.select(*_INDEX_COLS)


@query("index_table", _UPSERTED)
def _(spark, sf):
    """Two appended batches and a compaction, read back from the stored table."""
    path = scratch_dir(spark, "index")
    I.append_index(V.index_rows(spark, sf), f"{path}/log")
    I.append_index(_updates(spark, sf), f"{path}/log")
    I.compact_index(spark, f"{path}/log", f"{path}/compact")
    return I.read_index(spark, f"{path}/compact").select(*_INDEX_COLS)


@query("unexpired", f"WITH {V.SQL_INDEX} SELECT s3_key, ttl FROM idx WHERE ttl > 1700001000")
def _(spark, sf):
    return I.unexpired(V.index_rows(spark, sf), 1700001000).select("s3_key", "ttl")


@query(
    "index_stamp",
    f"""WITH {V.SQL_INDEX} SELECT s3_key, '2024-05-01T10:00:00+00:00' AS processed_at,
        CAST(1714557600 + 365 * 86400 AS BIGINT) AS ttl FROM idx""",
)
def _(spark, sf):
    now = F.lit("2024-05-01 10:00:00").cast("timestamp")
    return I.stamp_index(V.index_rows(spark, sf), now).select("s3_key", "processed_at", "ttl")


@query(
    "metadata_decode",
    """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN -1
         ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""",
)
def _(spark, sf):
    doc = json_or_empty("metadata")
    return V.props_text(spark, sf).select("event_id", field_or(doc, "$.k", "bigint", F.lit(-1)).alias("k"))


@query(
    "canonical_json",
    """SELECT o_orderkey, '{"a":[{"c":' || o_custkey || ',"z":"' || o_orderstatus || '"},{"c":null,"z":"x"}],"b":"'
         || o_orderpriority || '"}' AS body FROM orders""",
)
def _(spark, sf):
    """Keys out of order at both depths, in objects and in objects of a list."""
    inner = F.struct(F.col("o_orderstatus").alias("z"), F.col("o_custkey").alias("c"))
    other = F.struct(F.lit("x").alias("z"), F.lit(None).cast("bigint").alias("c"))
    value = F.struct(F.col("o_orderpriority").alias("b"), F.array(inner, other).alias("a"))
    return V.table(spark, sf, "orders").select("o_orderkey", canonical_json(value).alias("body"))


# --- A2-A9, J7, P20, P21, W13, S4 --------------------------------------------------

_DIM = "(VALUES ('src0'), ('src1'), ('wikimedia')) AS t(source)"


@query(
    "source_counts",
    f"""WITH {V.SQL_CAND} SELECT source, CAST(sum(n) AS BIGINT) AS ingested_count FROM (
          SELECT source, 1 AS n FROM cand UNION ALL SELECT source, 0 FROM {_DIM}) GROUP BY source""",
)
def _(spark, sf):
    return A.source_counts(V.candidates(spark, sf), ["src0", "src1", "wikimedia"])


@query("total_ingested", "SELECT count(*) AS ingested_count FROM documents")
def _(spark, sf):
    return A.total_ingested(A.source_counts(V.candidates(spark, sf), ["src0"]))


@query(
    "metadata_by_source",
    f"""WITH {V.SQL_CAND} SELECT campaign, source, pos // 100 AS chunk, pos, source_id,
          row_number() OVER (PARTITION BY campaign, source, pos // 100 ORDER BY pos) - 1 AS place
        FROM cand""",
)
def _(spark, sf):
    lists = A.metadata_by_source(V.candidates(spark, sf), ["campaign"], "pos", ["pos", "source_id"], 100)
    return lists.select("campaign", "source", "chunk", F.posexplode("items").alias("place", "i")).select(
        "campaign", "source", "chunk", "i.pos", "i.source_id", F.col("place").cast("bigint").alias("place")
    )


@query(
    "batch_result",
    f"""WITH {V.SQL_KEYS} SELECT split_part(key, '/', 4) AS campaign, CAST(10 AS BIGINT) AS batch_size,
          'both (wikimedia + pixabay)' AS video_source, count(*) AS ingested_count,
          count(*) FILTER (split_part(key, '/', 3) = 'wikimedia') AS n_wikimedia,
          count(*) FILTER (split_part(key, '/', 3) = 'pixabay') AS n_pixabay
        FROM keys GROUP BY 1""",
)
def _(spark, sf):
    assets = parse_key(V.object_keys(spark, sf), "key").select(
        F.col("key_campaign").alias("campaign"), F.col("key_source").alias("source")
    )
    return A.batch_result(assets, 10, SOURCES).select(
        "campaign",
        "batch_size",
        "video_source",
        "ingested_count",
        *[F.col("source_counts")[s].alias(f"n_{s}") for s in SOURCES],
    )


@query(
    "batch_documents",
    f"""WITH {V.SQL_CAND} SELECT c.campaign, n AS ingested_count, pos // 1000 AS chunk, source, pos
        FROM cand c JOIN (SELECT campaign, count(*) AS n FROM cand GROUP BY 1) USING (campaign)""",
)
def _(spark, sf):
    cand = V.candidates(spark, sf)
    lists = A.metadata_by_source(cand, ["campaign"], "pos", ["source", "pos"])
    docs = A.batch_documents(A.batch_result(cand, 10, SOURCES), lists)
    return docs.select("campaign", "ingested_count", "chunk", F.explode("metadata").alias("m")).select(
        "campaign", "ingested_count", "chunk", "m.source", "m.pos"
    )


@query(
    "outcome_counts",
    f"""WITH {V.SQL_PAGES} SELECT job_id, count(*) FILTER (status = 'SUCCEEDED') AS processed_count,
          count(*) FILTER (status <> 'SUCCEEDED') AS rejected_count FROM pages_in GROUP BY 1""",
)
def _(spark, sf):
    return A.outcome_counts(gate_flags(parse_status(V.response_pages(spark, sf))), "job_id")


@query(
    "lake_stats",
    f"""WITH {V.SQL_KEYS}, {V.SQL_INDEX}, r AS (
          SELECT count(*) FILTER (starts_with(key, 'media-raw/video/wikimedia/')) AS raw_wikimedia,
                 count(*) FILTER (starts_with(key, 'media-raw/video/pixabay/')) AS raw_pixabay
          FROM keys WHERE NOT ends_with(key, '/')),
        p AS (SELECT count(*) AS processed_total, count(*) FILTER (contains(s3_key, 'wikimedia')) AS processed_wikimedia,
                     count(*) FILTER (contains(s3_key, 'pixabay')) AS processed_pixabay FROM idx)
        SELECT raw_wikimedia + raw_pixabay AS raw_total, * FROM r, p""",
)
def _(spark, sf):
    return A.lake_stats(V.object_keys(spark, sf), V.index_rows(spark, sf), SOURCES)


@query(
    "source_rollup",
    f"""WITH {V.SQL_CAND} SELECT source, count(*) AS n FROM cand GROUP BY source
        UNION ALL SELECT NULL, count(*) FROM cand""",
)
def _(spark, sf):
    return A.source_rollup(V.candidates(spark, sf))


@query(
    "reconcile",
    f"""WITH {V.SQL_KEYS}, {V.SQL_INDEX},
        r AS (SELECT split_part(key, '/', 3) AS source, count(*) AS raw FROM keys WHERE NOT ends_with(key, '/') GROUP BY 1),
        p AS (SELECT source, count(*) AS processed FROM idx GROUP BY 1)
        SELECT source, coalesce(raw, 0) AS raw, coalesce(processed, 0) AS processed FROM r FULL JOIN p USING (source)""",
)
def _(spark, sf):
    raw = parse_key(list_keys(V.object_keys(spark, sf), "key"), "key").select(
        F.col("key_source").alias("source")
    )
    return J.reconcile(raw, V.index_rows(spark, sf))


@query(
    "list_keys",
    f"""WITH {V.SQL_KEYS} SELECT doc_id, key FROM keys
        WHERE starts_with(key, 'media-raw/video/wikimedia/') AND NOT ends_with(key, '/')""",
)
def _(spark, sf):
    return list_keys(V.object_keys(spark, sf), "key", "media-raw/video/wikimedia/")


@query(
    "source_flags",
    f"""WITH {V.SQL_KEYS} SELECT doc_id, contains(key, 'wikimedia') AS is_wikimedia, contains(key, 'pixabay') AS is_pixabay
        FROM keys""",
)
def _(spark, sf):
    return source_flags(V.object_keys(spark, sf), "key", SOURCES).drop("key")


@query(
    "scan_objects",
    """SELECT source, lang AS campaign, CAST(sum(strlen(text) + 1) AS BIGINT) AS length, true AS is_new FROM documents
       GROUP BY ALL""",
)
def _(spark, sf):
    """Objects written below source and campaign, then listed: what each folder holds, and whether it is new."""
    root = scratch_dir(spark, "objects")
    since = datetime.now(timezone.utc) - timedelta(minutes=1)
    docs = V.table(spark, sf, "documents").select("text", "source", F.col("lang").alias("campaign"))
    docs.hint("rebalance", "source", "campaign").write.partitionBy("source", "campaign").text(f"{root}/assets")
    listed = scan_objects(spark, root, "assets/source=").where(F.col("key").endswith(".txt"))
    part = F.split("key", "/")
    return (
        listed.groupBy(
            F.replace(part[1], F.lit("source="), F.lit("")).alias("source"),
            F.replace(part[2], F.lit("campaign="), F.lit("")).alias("campaign"),
        )
        .agg(
            F.sum("length").alias("length"),
            F.bool_and(F.col("modified").between(F.lit(since), F.current_timestamp())).alias("is_new"),
        )
    )


@query(
    "write_assets",
    f"WITH {V.SQL_CAND} SELECT campaign, source, source_id, title, size FROM cand",
)
def _(spark, sf):
    path = scratch_dir(spark, "assets")
    cand = V.candidates(spark, sf).select("campaign", "source", "source_id", "title", "size")
    write_assets(cand, path)
    return spark.read.schema(cand.schema).parquet(path)


@query(
    "write_analysis",
    f"""WITH {V.SQL_PAGES}, p AS (
          SELECT job_id, max(duration) AS duration, bool_or(flagged) AS flagged, count(*) FILTER (flagged) AS moderation
          FROM pages_in WHERE status = 'SUCCEEDED' GROUP BY 1),
        l AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY p1, p2, p3, p4, pos) AS place FROM labels_in),
        c AS (SELECT job_id, count(*) AS total_labels FROM l GROUP BY 1),
        t AS (SELECT job_id, string_agg(name || ' ' || CAST(round(confidence) AS BIGINT), ',' ORDER BY rank) AS top
              FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY confidence DESC, place) AS rank FROM l)
              WHERE rank <= 10 GROUP BY 1)
        SELECT job_id, place, name, confidence, "timestamp", n_instances, coalesce(total_labels, 0) AS total_labels,
               duration, flagged, moderation, coalesce(top, '') AS top
        FROM p LEFT JOIN l USING (job_id) LEFT JOIN c USING (job_id) LEFT JOIN t USING (job_id)""",
)
def _(spark, sf):
    """Analysis documents, one per video and line, written from one parse and read back with all their labels."""
    root = scratch_dir(spark, "analysis")
    path = f"{root}/documents"
    ok, _ = gate_succeeded(parse_responses(V.response_pages(spark, sf)))
    reduced = land_pages(reduce_pages(ok, ["job_id", "page"], texts=True), f"{root}/pages")
    with shuffles_freed(spark):  # those of the summaries before the documents have theirs
        summaries = land_pages(summarize_reduced(reduced, "job_id", "page"), f"{root}/summaries")
        write_analysis(analysis_parts(reduced, summaries, "job_id", "page"), path, compression="gzip")
    back = spark.read.schema(
        "video_s3_key bigint, duration double, moderation_labels array<struct<Name:string>>, "
        "labels array<struct<name:string,confidence:double,timestamp:double,instances:array<struct<Top:int>>>>, "
        "summary struct<total_labels:bigint,top_labels:array<struct<name:string,confidence:double>>,"
        "duration:double,has_moderation_issues:boolean>"
    ).json(path)
    best = F.transform("summary.top_labels", lambda x: F.concat_ws(" ", x["name"], F.round(x["confidence"]).cast("bigint")))
    videos = back.select(
        F.col("video_s3_key").alias("job_id"),
        "summary.total_labels",
        "summary.duration",
        F.col("summary.has_moderation_issues").alias("flagged"),
        F.array_size("moderation_labels").cast("bigint").alias("moderation"),
        F.array_join(best, ",").alias("top"),
        "labels",
    )
    return videos.select("*", F.posexplode_outer("labels").alias("at", "label")).select(
        "job_id",
        (F.col("at") + 1).cast("bigint").alias("place"),
        "label.name",
        "label.confidence",
        "label.timestamp",
        F.array_size("label.instances").alias("n_instances"),
        *("total_labels", "duration", "flagged", "moderation", "top"),
    )


@query(
    "browse",
    f"""WITH {V.SQL_INDEX} SELECT source, s3_key FROM idx
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY processed_at DESC, s3_key) <= 20""",
)
def _(spark, sf):
    rows = V.index_rows(spark, sf)
    return R.browse(rows, "source", [F.col("processed_at").desc(), "s3_key"]).select("source", "s3_key")


# --- U2, U3, A8 ---------------------------------------------------------------------


@query(
    "campaign_catalogue",
    f"""WITH {V.SQL_KEYS} SELECT split_part(key, '/', 4) AS campaign FROM keys
        WHERE starts_with(key, 'media-raw/video/') AND split_part(key, '/', 4) NOT IN ('', 'wikimedia', 'pixabay', 'internetarchive')
        UNION SELECT campaign FROM (VALUES {', '.join(f"('{c}')" for c in PREDEFINED_CAMPAIGNS)}) AS t(campaign)""",
)
def _(spark, sf):
    return campaign_catalogue(V.object_keys(spark, sf))


@query("campaigns_in", f"WITH {V.SQL_INDEX} SELECT DISTINCT campaign FROM idx")
def _(spark, sf):
    return A.campaigns_in(V.index_rows(spark, sf))


# --- S7, S12, P23-P26, W4, A9 ---------------------------------------------------------


@query(
    "flatten_executions",
    f"""WITH {V.SQL_EXEC} SELECT arn, strftime(start, '%Y-%m-%d %H:%M:%S') AS "timestamp",
          coalesce(campaign, 'unknown') AS campaign, coalesce(batch_size, 0) AS batch_size, status,
          coalesce(processed_count, 0) AS files_processed, n_metadata FROM execs""",
)
def _(spark, sf):
    flat = E.flatten_executions(E.scan_executions(V.executions(spark, sf)))
    return flat.select(
        "arn",
        "timestamp",
        "campaign",
        "batch_size",
        "status",
        "files_processed",
        F.array_size("ingested_videos").alias("n_metadata"),
    )


@query(
    "recent_executions",
    f"WITH {V.SQL_EXEC} SELECT arn, status FROM execs ORDER BY start DESC, arn DESC LIMIT 10",
)
def _(spark, sf):
    return R.recent(V.executions(spark, sf), 10).select("arn", "status")


@query("any_running", f"WITH {V.SQL_EXEC} SELECT bool_or(status = 'RUNNING') AS any_running FROM execs")
def _(spark, sf):
    return A.any_running(V.executions(spark, sf))


@query(
    "execution_id",
    "SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS execution_id FROM orders",
)
def _(spark, sf):
    key = execution_id("arn")
    return V.executions(spark, sf).select(key.cast("bigint").alias("o_orderkey"), key.alias("execution_id"))


@query(
    "status_label",
    f"""WITH {V.SQL_EXEC} SELECT arn, CASE WHEN status IN ('SUCCEEDED', 'FAILED', 'RUNNING', 'TIMED_OUT', 'ABORTED')
          THEN status ELSE 'OTHER' END AS display,
          CASE status WHEN 'SUCCEEDED' THEN '[SUCCESS]' WHEN 'FAILED' THEN '[FAILED]'
                      WHEN 'RUNNING' THEN '[RUNNING]' ELSE '[PENDING]' END AS prefix FROM execs""",
)
def _(spark, sf):
    return V.executions(spark, sf).select(
        "arn",
        E.execution_status_label("status").alias("display"),
        E.step_status_label("status").alias("prefix"),
    )


@query(
    "event_time",
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000 ELSE epoch_us(ts) // 1000 // 1000 * 1000 END AS ms
       FROM events""",
)
def _(spark, sf):
    ts = F.col("ts").cast("timestamp")
    number = F.when(F.col("event_id") % 2 == 0, F.unix_millis(ts)).otherwise(F.unix_seconds(ts))
    return V.table(spark, sf, "events").select(
        "event_id", F.unix_millis(event_time(number)).alias("ms")
    )


@query(
    "notifications",
    f"""WITH {V.SQL_EXEC} SELECT 'Media Pipeline VIDEO: ' || status AS subject,
          '{{"pipeline_type":"video","campaign":"' || coalesce(campaign, 'unknown') || '","status":"' || status
          || '","execution_arn":' || CASE WHEN status = 'RUNNING' THEN 'null' ELSE '"' || arn || '"' END
          || CASE WHEN status = 'FAILED' THEN ',"error":"job failed"' ELSE '' END || '}}' AS message FROM execs""",
)
def _(spark, sf):
    flat = E.flatten_executions(E.scan_executions(V.executions(spark, sf)))
    return notifications(
        flat.select(
            F.lit("video").alias("pipeline_type"),
            "campaign",
            "status",
            F.when(F.col("status") != "RUNNING", F.col("arn")).alias("execution_arn"),
            F.when(F.col("status") == "FAILED", "job failed").otherwise("").alias("error"),
        )
    )


# --- E2 -------------------------------------------------------------------------------

BATCH = 200


_BATCH_SQL = f"""WITH {V.SQL_CATALOGUE_A}, {V.SQL_CATALOGUE_B}, {V.SQL_INDEX},
        a AS (SELECT campaign, 'wikimedia' AS source, source_id, source_id AS title, url, mime FROM cat_a
              QUALIFY row_number() OVER (PARTITION BY campaign ORDER BY response, pos) <= {BATCH // 2}),
        b AS (SELECT * FROM hits_b
              QUALIFY row_number() OVER (PARTITION BY campaign ORDER BY response, pos) <= {BATCH // 2}),
        c AS (SELECT * FROM a UNION ALL
              SELECT campaign, 'pixabay', source_id, title, url, 'video/mp4' FROM b WHERE url <> ''),
        known AS (SELECT campaign, CASE WHEN CAST(source_id AS BIGINT) % 2 = 0 THEN 'pixabay' ELSE 'other' END AS source,
                         source_id FROM idx),
        fresh AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.campaign = c.campaign
                    AND k.source = c.source AND k.source_id = c.source_id)),
        named AS (SELECT campaign, source, source_id, 'media-raw/video/' || source || '/' || campaign
                    || '/20240501_100000/' || source || '_' || source_id || '_'
                    || left(regexp_replace(replace(replace(title, 'File:', ''), ' ', '_'),
                                           '[^\\p{{L}}\\p{{N}}_.\\-]', '', 'g'), 100)
                    || '.' || CASE WHEN contains(mime, 'mp4') OR contains(url, 'mp4') THEN 'mp4'
                                   WHEN contains(mime, 'webm') OR contains(url, 'webm') THEN 'webm'
                                   ELSE 'mp4' END AS s3_key
                  FROM fresh)"""


def _batch(spark, sf):
    """Landed responses of both catalogues to all outputs.

    Half of catalogue A's jobs fail, hits of catalogue B whose id begins with 1 get no job, each catalogue
    has a response per campaign that is no JSON, and one per campaign that found nothing.
    """
    root = scratch_dir(spark, "batch")

    def store(name, df):
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    def jobs(assets):
        refused = (F.col("source") == "pixabay") & F.startswith("source_id", F.lit("1"))
        return assets.where(~refused).select("s3_key").distinct().select(
            F.sha2("s3_key", 256).alias("job_id"),
            F.lit("IN_PROGRESS").alias("status"),
            F.col("s3_key").alias("video_s3_key"),
            F.lit("media").alias("video_s3_bucket"),
        )

    index = V.index_rows(spark, sf).withColumn(
        "source", F.when(F.col("source_id").cast("bigint") % 2 == 0, "pixabay").otherwise("other")
    )
    langs = V.table(spark, sf, "documents").select("lang").distinct()
    response = F.lit(-1).cast("bigint").alias("response")
    odd = langs.select(F.col("lang").alias("campaign"), response, F.lit("<html>").alias("body")).union(
        langs.select(F.concat("lang", F.lit("-void")), response, F.lit("{}"))
    )
    inputs = {
        "wikimedia": V.raw_catalogue_a(spark, sf).select("campaign", "response", "body").union(odd),
        "pixabay": V.raw_catalogue_b(spark, sf).select("campaign", "response", "body").union(odd),
    }
    now = F.lit("2024-05-01 10:00:00").cast("timestamp")

    def detections(assets):
        failed = (F.col("source") == "wikimedia") & F.col("source_id").contains("alt")

        def label(name, confidence):
            return F.struct(
                F.struct(name.alias("Name"), F.lit(confidence).alias("Confidence")).alias("Label")
            )

        body = F.struct(
            F.when(failed, "FAILED").otherwise("SUCCEEDED").alias("JobStatus"),
            F.array(label(F.lit("low"), 10.0), label(F.col("campaign"), 90.0)).alias("Labels"),
        )
        return assets.select("s3_key", "source", "source_id", "campaign").distinct().select(
            F.sha2("s3_key", 256).alias("job_id"),
            F.lit(0).cast("bigint").alias("page"),
            F.to_json(body).alias("body"),
        )

    return run_batch(
        inputs, index, jobs, detections, BATCH, now, available={"catalogue_b_key"}, store=store
    )


@query(
    "run_batch",
    f"""{_BATCH_SQL}
        SELECT DISTINCT 'video#' || campaign || '#20240501100000' AS id, campaign, source, source_id, s3_key,
               replace(replace(replace(s3_key, 'media-raw', 'media-processed'), '.mp4', '_labels.json'),
                       '.webm', '_labels.json') AS processed_key,
               2 AS total_labels, campaign AS top_name, '2024-05-01T10:00:00+00:00' AS processed_at,
               CAST(1714557600 + 365 * 86400 AS BIGINT) AS ttl
        FROM named WHERE source = 'wikimedia' AND NOT contains(source_id, 'alt')
                      OR source = 'pixabay' AND NOT starts_with(source_id, '1')""",
)
def _(spark, sf):
    result = _batch(spark, sf)
    doc = json_or_empty("metadata")
    return result.index.select(
        "id",
        "campaign",
        "source",
        "source_id",
        "s3_key",
        "processed_key",
        field_or(doc, "$.total_labels", "int", F.lit(0)).alias("total_labels"),
        field_or(doc, "$.top_labels[0].name", "string", F.lit("")).alias("top_name"),
        "processed_at",
        "ttl",
    )


@query(
    "run_batch_rejects",
    f"""{_BATCH_SQL}
        SELECT DISTINCT 'finalize' AS stage, s3_key AS key, 'Unknown error' AS reason FROM named
        WHERE source = 'wikimedia' AND contains(source_id, 'alt')
        UNION ALL SELECT DISTINCT 'start', s3_key, 'no job' FROM named
        WHERE source = 'pixabay' AND starts_with(source_id, '1')
        UNION ALL SELECT DISTINCT 'ingest', lang || '/' || s || '/-1', 'unreadable response'
        FROM documents, (VALUES ('wikimedia'), ('pixabay')) AS t(s)""",
)
def _(spark, sf):
    """What the batch could not finish, and why."""
    return _batch(spark, sf).rejects


@query(
    "run_batch_envelopes",
    f"""{_BATCH_SQL}, asked AS (SELECT DISTINCT lang AS campaign FROM documents
          UNION ALL SELECT DISTINCT lang || '-void' FROM documents)
        SELECT campaign, CAST({BATCH} AS BIGINT) AS batch_size, count(source) AS ingested_count,
          count(*) FILTER (source = 'wikimedia') AS n_wikimedia, count(*) FILTER (source = 'pixabay') AS n_pixabay
        FROM asked LEFT JOIN named USING (campaign) GROUP BY 1""",
)
def _(spark, sf):
    """One envelope per campaign asked for, also for those that found nothing."""
    return _batch(spark, sf).envelopes.select(
        "campaign",
        "batch_size",
        "ingested_count",
        *[F.coalesce(F.col("source_counts")[s], F.lit(0).cast("bigint")).alias(f"n_{s}") for s in SOURCES],
    )


@query(
    "run_batch_counts",
    f"""{_BATCH_SQL}, jobs AS (SELECT DISTINCT campaign, source, s3_key,
          source = 'wikimedia' AND contains(source_id, 'alt') OR source = 'pixabay' AND starts_with(source_id, '1') AS lost
          FROM named)
        SELECT campaign, count(*) FILTER (NOT lost) AS processed_count, count(*) FILTER (lost) AS rejected_count
        FROM jobs GROUP BY 1""",
)
def _(spark, sf):
    """Processed and rejected storage keys per campaign."""
    return _batch(spark, sf).counts
