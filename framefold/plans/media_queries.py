"""Catalogue, detection, key and join queries on the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from framefold.functions import documents as DOC
from framefold.functions import keys as K
from framefold.functions import text as X
from framefold.functions import times as T
from framefold.operators import detections as D
from framefold.operators import joins as J
from framefold.operators import ranking as R
from framefold.operators.gates import require
from framefold.operators.sets import union_sources
from framefold.plans import views as V
from framefold.plans.batch import to_assets
from framefold.plans.registry import query
from framefold.session import scratch_dir
from framefold.sources import catalogues as C
from framefold.sources import id_table
from framefold.sources.detections import (
    gate_flags,
    gate_succeeded,
    land_pages,
    parse_label_facts,
    parse_responses,
    parse_status,
    scan_detections,
)
from framefold.sources.objects import with_file_size

BATCH_TS = "20240101_120000"

# --- S1, S2, P1-P6, W2, W3, U1, E1 -------------------------------------------

_A_COLS = ["campaign", "response", "pos", "source_id", "url", "size", "mime", "author", "license"]
_B_COLS = ["campaign", "response", "pos", "source_id", "title", "url", "size", "author", "description", "duration"]


@query(
    "scan_catalogue_a",
    """SELECT lang AS campaign, doc_id AS response, k AS pos,
              CASE WHEN k = 0 THEN CAST(doc_id AS VARCHAR) ELSE 'alt' END AS page_id,
              CASE WHEN k = 0 THEN 'File:' || text ELSE 'File:alt ' || doc_id END AS title
       FROM documents, (VALUES (0), (1)) AS t(k)""",
)
def _(spark, sf):
    pages = C.scan_catalogue_a(V.raw_catalogue_a(spark, sf))
    return pages.select("campaign", "response", "pos", "page_id", F.col("page.title").alias("title"))


@query("candidates_a", f"WITH {V.SQL_CATALOGUE_A} SELECT * FROM cat_a")
def _(spark, sf):
    return C.read_catalogue_a(V.raw_catalogue_a(spark, sf)).select(*_A_COLS)


@query(
    "filter_then_limit",
    f"""WITH {V.SQL_CATALOGUE_A} SELECT * FROM cat_a
        QUALIFY row_number() OVER (PARTITION BY campaign ORDER BY response, pos) <= 25""",
)
def _(spark, sf):
    return C.read_catalogue_a(V.raw_catalogue_a(spark, sf), 25).select(*_A_COLS)


@query(
    "scan_catalogue_b",
    f"WITH {V.SQL_CATALOGUE_B} SELECT campaign, response, pos, source_id, duration FROM hits_b",
)
def _(spark, sf):
    hits = C.scan_catalogue_b(V.raw_catalogue_b(spark, sf))
    return hits.select(
        "campaign",
        "response",
        "pos",
        F.col("hit.id").cast("string").alias("source_id"),
        F.coalesce("hit.duration", F.lit(0.0)).alias("duration"),
    )


@query(
    "candidates_b",
    f"WITH {V.SQL_CATALOGUE_B} SELECT {', '.join(_B_COLS)} FROM hits_b WHERE url <> ''",
)
def _(spark, sf):
    return C.read_catalogue_b(V.raw_catalogue_b(spark, sf)).select(*_B_COLS)


@query(
    "limit_then_filter",
    f"""WITH {V.SQL_CATALOGUE_B}, first AS (SELECT * FROM hits_b
        QUALIFY row_number() OVER (PARTITION BY campaign ORDER BY response, pos) <= 25)
        SELECT {', '.join(_B_COLS)} FROM first WHERE url <> ''""",
)
def _(spark, sf):
    return C.read_catalogue_b(V.raw_catalogue_b(spark, sf), 25).select(*_B_COLS)


@query(
    "union_sources",
    f"""WITH {V.SQL_CATALOGUE_A}, {V.SQL_CATALOGUE_B}
        SELECT 'wikimedia' AS source, source_id, source_id AS title, url, size, CAST(NULL AS DOUBLE) AS duration
        FROM cat_a
        UNION ALL
        SELECT 'pixabay', source_id, title, url, size, duration FROM hits_b WHERE url <> ''""",
)
def _(spark, sf):
    raw = {"wikimedia": V.raw_catalogue_a(spark, sf), "pixabay": V.raw_catalogue_b(spark, sf)}
    chosen = C.select_sources("any", {"catalogue_b_key"})
    found = union_sources([s.read(raw[s.name]) for s in chosen])
    return found.select("source", "source_id", "title", "url", "size", "duration")


@query(
    "select_sources",
    f"""WITH {V.SQL_CATALOGUE_A}
        SELECT campaign, 'wikimedia' AS source, count(*) AS n FROM cat_a GROUP BY campaign""",
)
def _(spark, sf):
    raw = {"wikimedia": V.raw_catalogue_a(spark, sf), "pixabay": V.raw_catalogue_b(spark, sf)}
    chosen = C.select_sources(None)  # the second catalogue's requirement is not met
    found = union_sources([s.read(raw[s.name]) for s in chosen])
    return found.groupBy("campaign", "source").agg(F.count(F.lit(1)).alias("n"))


@query(
    "quota_limit",
    f"""WITH {V.SQL_CAND} SELECT campaign, source, pos FROM cand
        QUALIFY row_number() OVER (PARTITION BY campaign, source ORDER BY pos) <= 3""",
)
def _(spark, sf):
    quota = R.per_source_quota(60, 20)
    cand = V.candidates(spark, sf).select("campaign", "source", "pos")
    return R.quota_limit(cand, quota, ["campaign", "source"], ["pos"])


# --- S3, P15-P17, W1, A1, W14 --------------------------------------------------


@query(
    "scan_detections",
    f"""WITH {V.SQL_PAGES} SELECT job_id, p1, p2, p3, p4, pos, name, confidence, "timestamp", n_instances
        FROM labels_in
        UNION ALL
        SELECT job_id, p1, p2, p3, p4, NULL, NULL, NULL, NULL, NULL FROM pages_in WHERE NOT has_labels""",
)
def _(spark, sf):
    det = scan_detections(parse_responses(V.response_pages(spark, sf)), ["job_id", "page"])
    return det.select(
        "job_id",
        F.col("page.l_linenumber").alias("p1"),
        F.col("page.l_partkey").alias("p2"),
        F.col("page.l_suppkey").alias("p3"),
        F.col("page.l_extendedprice").alias("p4"),
        "pos",
        "name",
        "confidence",
        "timestamp",
        F.array_size("instances").alias("n_instances"),
    )


@query(
    "gate_succeeded",
    f"""WITH {V.SQL_PAGES} SELECT job_id, status, CASE WHEN status = 'SUCCEEDED' THEN NULL
            ELSE coalesce(message, 'Unknown error') END AS reason, count(*) AS pages
        FROM pages_in GROUP BY ALL""",
)
def _(spark, sf):
    flagged = gate_flags(parse_status(V.response_pages(spark, sf)))
    return flagged.groupBy("job_id", "status", "reason").agg(F.count(F.lit(1)).alias("pages"))


@query(
    "top_labels",
    f"""WITH {V.SQL_DET}
        SELECT video, name, confidence, rank FROM (
          SELECT *, row_number() OVER (PARTITION BY video ORDER BY confidence DESC, p1, p2, p3, p4) AS rank
          FROM det) WHERE rank <= 3""",
)
def _(spark, sf):
    top = D.top_labels(V.detections(spark, sf), "video", V.DET_ORDER, 3)
    return top.select("video", "name", "confidence", F.col("rank").cast("bigint").alias("rank"))


@query(
    "top_labels_distinct",
    f"""WITH {V.SQL_DET}, best AS (SELECT * FROM det
          QUALIFY row_number() OVER (PARTITION BY video, name ORDER BY confidence DESC, p1, p2, p3, p4) = 1)
        SELECT video, name, confidence,
               row_number() OVER (PARTITION BY video ORDER BY confidence DESC, p1, p2, p3, p4) AS rank
        FROM best QUALIFY rank <= 3""",
)
def _(spark, sf):
    top = D.top_labels(V.detections(spark, sf), "video", V.DET_ORDER, 3, distinct_names=True)
    return top.select("video", "name", "confidence", F.col("rank").cast("bigint").alias("rank"))


_SUMMARY_SQL = f"""WITH {V.SQL_PAGES}, counts AS (
    SELECT job_id, count(*) AS total_labels FROM labels_in GROUP BY 1),
  pages AS (SELECT job_id, max(duration) AS duration, bool_or(flagged) AS has_moderation_issues
            FROM pages_in WHERE status = 'SUCCEEDED' GROUP BY 1),
  top AS (SELECT job_id, name, confidence,
            row_number() OVER (PARTITION BY job_id ORDER BY confidence DESC, p1, p2, p3, p4, pos) AS rank
          FROM labels_in QUALIFY rank <= 10)
  SELECT job_id, coalesce(total_labels, 0) AS total_labels, duration, has_moderation_issues, rank, name, confidence
  FROM pages LEFT JOIN counts USING (job_id) LEFT JOIN top USING (job_id)"""


def _flat_summary(summary):
    return summary.select(
        "job_id",
        "total_labels",
        "duration",
        "has_moderation_issues",
        F.posexplode_outer("top_labels").alias("rank", "label"),
    ).select(
        "job_id",
        "total_labels",
        "duration",
        "has_moderation_issues",
        (F.col("rank") + 1).cast("bigint").alias("rank"),
        "label.name",
        "label.confidence",
    )


def _landed(spark, sf):
    """Raw response pages parsed once into a table."""
    return land_pages(parse_responses(V.response_pages(spark, sf)), scratch_dir(spark, "pages"))


@query("video_summary", _SUMMARY_SQL)
def _(spark, sf):
    """From reduced pages: only counts, best labels, duration and flag of a page are kept."""
    ok, _ = gate_succeeded(parse_label_facts(V.response_pages(spark, sf)))
    reduced = land_pages(D.reduce_pages(ok, ["job_id", "page"]), scratch_dir(spark, "reduced"))
    return _flat_summary(D.summarize_reduced(reduced, "job_id", "page"))


@query("video_summary_long", _SUMMARY_SQL)
def _(spark, sf):
    ok, _ = gate_succeeded(_landed(spark, sf))
    det = scan_detections(ok, ["job_id", "page"])
    return _flat_summary(D.summarize(det, ok, "job_id", ["page", "pos"]))


@query(
    "label_array",
    f"""WITH {V.SQL_PAGES} SELECT job_id, p1, p2, p3, p4, pos AS place, name, confidence FROM labels_in""",
)
def _(spark, sf):
    ok, _ = gate_succeeded(parse_responses(V.response_pages(spark, sf)))
    det = scan_detections(ok, ["job_id", "page"])
    arrays = D.label_array(det, "job_id", "page", ["page", "pos"])
    return arrays.select("job_id", "page.*", F.posexplode("labels").alias("place", "label")).select(
        "job_id",
        F.col("l_linenumber").alias("p1"),
        F.col("l_partkey").alias("p2"),
        F.col("l_suppkey").alias("p3"),
        F.col("l_extendedprice").alias("p4"),
        "place",
        "label.name",
        "label.confidence",
    )


# --- P7-P14, P22, S5 -------------------------------------------------------------

_SAFE = r"left(regexp_replace(replace(replace(title, 'File:', ''), ' ', '_'), '[^\p{L}\p{N}_.\-]', '', 'g'), 100)"
_EXT = (
    "CASE WHEN contains(mime, 'mp4') OR contains(url, 'mp4') THEN 'mp4' "
    "WHEN contains(mime, 'webm') OR contains(url, 'webm') THEN 'webm' ELSE 'mp4' END"
)
_KEY = (
    f"'media-raw/video/' || source || '/' || campaign || '/{BATCH_TS}/' || source || '_' || "
    f"CASE WHEN source_id <> '' THEN source_id || '_' ELSE '' END || {_SAFE} || '.' || {_EXT}"
)


@query("safe_title", f"WITH {V.SQL_CAND} SELECT pos, {_SAFE} AS safe FROM cand")
def _(spark, sf):
    return V.candidates(spark, sf).select("pos", X.safe_title("title").alias("safe"))


@query("infer_ext", f"WITH {V.SQL_CAND} SELECT pos, {_EXT} AS ext FROM cand")
def _(spark, sf):
    return V.candidates(spark, sf).select("pos", X.infer_ext("mime", "url").alias("ext"))


@query("raw_key", f"WITH {V.SQL_CAND} SELECT pos, {_KEY} AS s3_key FROM cand")
def _(spark, sf):
    key = K.raw_key("source", "source_id", "title", "campaign", F.lit(BATCH_TS), "mime", "url")
    return V.candidates(spark, sf).select("pos", key.alias("s3_key"))


@query(
    "to_assets",
    f"""WITH {V.SQL_CAND} SELECT campaign, source, title, url AS file_url, size AS file_size, {_KEY} AS s3_key,
        '{BATCH_TS}' AS ingested_at, source_id, '' AS license FROM cand""",
)
def _(spark, sf):
    nothing = F.lit(None).cast("string")
    cand = V.candidates(spark, sf).withColumns(
        {"license": nothing, "author": nothing, "description": nothing, "duration": nothing.cast("double")}
    )
    return to_assets(cand, F.lit(BATCH_TS)).select(
        "campaign", "source", "title", "file_url", "file_size", "s3_key", "ingested_at", "source_id", "license"
    )


@query(
    "processed_key",
    f"""WITH {V.SQL_KEYS} SELECT doc_id, replace(replace(replace(key, 'media-raw', 'media-processed'),
        '.mp4', '_labels.json'), '.webm', '_labels.json') AS processed_key FROM keys""",
)
def _(spark, sf):
    return V.object_keys(spark, sf).select("doc_id", K.processed_key("key").alias("processed_key"))


@query(
    "parse_key",
    f"""WITH {V.SQL_KEYS} SELECT doc_id, split_part(key, '/', 3) AS key_source, split_part(key, '/', 4) AS key_campaign,
        split_part(key, '/', -2) AS key_ingested_at, split_part(key, '/', -1) AS key_file FROM keys""",
)
def _(spark, sf):
    return K.parse_key(V.object_keys(spark, sf), "key").drop("key")


@query(
    "record_id",
    f"""WITH {V.SQL_INDEX} SELECT s3_key, media_type || '#' || campaign || '#' || replace(ingested_at, '_', '') AS id
        FROM idx""",
)
def _(spark, sf):
    return V.index_rows(spark, sf).select(
        "s3_key", K.record_id("media_type", "campaign", "ingested_at").alias("id")
    )


@query(
    "normalize_campaign",
    """SELECT doc_id, CASE WHEN trim(typed) <> '' THEN lower(trim(typed)) ELSE lang END AS campaign
       FROM (SELECT doc_id, lang, CASE WHEN n_chars % 3 = 0 THEN '  ' ELSE ' ' || upper(source) || '  ' END AS typed
             FROM documents)""",
)
def _(spark, sf):
    typed = F.when(F.col("n_chars") % 3 == 0, "  ").otherwise(
        F.concat(F.lit(" "), F.upper("source"), F.lit("  "))
    )
    docs = V.table(spark, sf, "documents").select("doc_id", "lang", typed.alias("typed"))
    return docs.select("doc_id", X.normalize_campaign("typed", "lang").alias("campaign"))


@query(
    "text_functions",
    r"""SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', -1) AS last_part,
          starts_with(url, 'https') AS secure, ends_with(url, 'top') AS at_top, contains(url, 'page=') AS paged,
          upper(left(url, 1)) || lower(substr(url, 2)) AS capitalised,
          trim(regexp_replace(html, '[<>]', '', 'g'), ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)) AS stripped,
          coalesce(nullif(split_part(split_part(url, '?', 2), '#', 1), ''), 'none') AS args,
          try_cast(split_part(url, '/', -1) AS BIGINT) AS number
       FROM pages""",
)
def _(spark, sf):
    args = X.segment(F.coalesce(X.segment("url", "?", 2), F.lit("")), "#", 1)
    return V.table(spark, sf, "pages").select(
        "page_id",
        X.segment("url", "/", 3).alias("host"),
        X.segment("url", "/", -1).alias("last_part"),
        X.starts("url", "https").alias("secure"),
        X.ends("url", "top").alias("at_top"),
        X.has("url", "page=").alias("paged"),
        X.case_fold("url", "capitalise").alias("capitalised"),
        X.strip_chars("html", "<>").alias("stripped"),
        X.default_if_empty(args, "none").alias("args"),
        X.to_int(X.segment("url", "/", -1)).alias("number"),
    )


@query(
    "time_functions",
    """SELECT event_id, strftime(date_trunc('second', ts), '%Y%m%d_%H%M%S') AS batch_ts,
          strftime(ts, '%Y-%m-%d %H:%M:%S') AS display_ts,
          CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
               ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00' AS iso_ts,
          epoch_us(ts) // 1000000 + 365 * 86400 AS ttl,
          epoch_us(date_trunc('second', ts)) // 1000 AS back_ms,
          CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000 ELSE epoch_us(date_trunc('second', ts)) // 1000 END AS event_ms,
          (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1000000.0::DOUBLE AS elapsed,
          CAST(greatest(least(floor(value), 20), 3) AS BIGINT) AS clamped,
          greatest(1, CAST(floor(value) AS BIGINT) // 2) AS quota
       FROM events""",
)
def _(spark, sf):
    events = V.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    number = F.when(F.col("event_id") % 2 == 0, F.unix_millis("ts")).otherwise(F.unix_seconds("ts"))
    text = T.batch_ts_text("ts")
    return events.select(
        "event_id",
        text.alias("batch_ts"),
        T.display_ts("ts").alias("display_ts"),
        T.iso_ts("ts").alias("iso_ts"),
        T.add_days_epoch("ts", 365).alias("ttl"),
        F.unix_millis(T.batch_ts(text)).alias("back_ms"),
        F.unix_millis(T.event_time(number)).alias("event_ms"),
        T.elapsed(F.lit("2024-01-01").cast("timestamp"), "ts").alias("elapsed"),
        T.clamp(F.floor("value"), 3, 20).cast("bigint").alias("clamped"),
        T.quota(F.floor("value"), 2).alias("quota"),
    )


@query(
    "array_functions",
    """SELECT vec_id, coalesce(list_max(embedding) > 0.25, false) AS has_large,
          CAST(len(embedding) AS BIGINT) AS n, CAST(list_sort(embedding)[1] AS DOUBLE) AS least,
          CAST(embedding[3] AS DOUBLE) AS third, CAST(len(embedding[1:3]) AS BIGINT) AS kept
       FROM embeddings""",
)
def _(spark, sf):
    head = DOC.first_n("embedding", 3)
    return V.table(spark, sf, "embeddings").select(
        "vec_id",
        DOC.any_match("embedding", lambda x: x > 0.25).alias("has_large"),
        DOC.length("embedding").cast("bigint").alias("n"),
        F.array_sort("embedding")[0].cast("double").alias("least"),
        head[2].cast("double").alias("third"),
        DOC.length(head).cast("bigint").alias("kept"),
    )


@query(
    "with_file_size",
    """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN n_chars ELSE strlen(text) END AS file_size FROM documents""",
)
def _(spark, sf):
    docs = V.table(spark, sf, "documents").withColumn(
        "declared", F.when(F.col("doc_id") % 2 == 0, F.col("n_chars"))
    )
    return with_file_size(docs, "declared", F.octet_length("text")).select("doc_id", "file_size")


@query(
    "require_fields",
    f"""WITH {V.SQL_CAND} SELECT pos, CASE WHEN pos % 7 = 0 AND source_id = '' THEN 'missing campaign,source_id'
          WHEN pos % 7 = 0 THEN 'missing campaign' WHEN source_id = '' THEN 'missing source_id' END AS reason FROM cand""",
)
def _(spark, sf):
    """Candidates without an id, without a campaign, or without both."""
    cand = V.candidates(spark, sf).withColumn("campaign", F.when(F.col("pos") % 7 != 0, F.col("campaign")))
    ok, bad = require(cand.select("pos", "campaign", "source_id"), ["campaign", "source_id"])
    return ok.select("pos", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("pos", "reason"))


# --- J1-J4, A12 --------------------------------------------------------------------


@query(
    "drop_indexed",
    f"""WITH {V.SQL_CAND}, {V.SQL_INDEX} SELECT campaign, source, source_id, pos FROM cand c
        WHERE NOT EXISTS (SELECT 1 FROM idx i WHERE i.media_type = c.media_type AND i.campaign = c.campaign
          AND i.source = c.source AND i.source_id = c.source_id AND c.source_id <> '')""",
)
def _(spark, sf):
    left = V.candidates(spark, sf).select("media_type", "campaign", "source", "source_id", "pos")
    return J.drop_indexed(left, V.index_rows(spark, sf)).drop("media_type")


@query(
    "drop_known",
    f"""WITH {V.SQL_CAND}, {V.SQL_INDEX} SELECT campaign, source, source_id, pos FROM cand c
        WHERE NOT EXISTS (SELECT 1 FROM idx i WHERE i.media_type = c.media_type AND i.campaign = c.campaign
          AND i.source = c.source AND i.source_id = c.source_id AND c.source_id <> '')""",
)
def _(spark, sf):
    """The same against a stored id table whose buckets the candidates are shuffled to."""
    name = f"ids_{uuid.uuid4().hex}"
    id_table.create_id_table(spark, name, scratch_dir(spark, "ids"), 16)
    id_table.append_ids(V.index_rows(spark, sf), name, buckets=16)
    left = V.candidates(spark, sf).select("media_type", "campaign", "source", "source_id", "pos")
    return id_table.drop_known(left, id_table.known_keys(spark, name)).drop("media_type")


@query(
    "existing_ids",
    f"WITH {V.SQL_INDEX} SELECT DISTINCT media_type, campaign, source, source_id FROM idx WHERE source_id <> ''",
)
def _(spark, sf):
    return J.existing_ids(V.index_rows(spark, sf))


@query(
    "join_jobs",
    f"""WITH {V.SQL_KEYS}, {V.SQL_INDEX}
        SELECT 'job-' || c.doc_id AS job_id, 'IN_PROGRESS' AS job_status, i.s3_key, 'media' AS video_s3_bucket
        FROM idx i JOIN documents c ON i.source_id = CAST(c.doc_id AS VARCHAR)""",
)
def _(spark, sf):
    doc = F.col("doc_id").cast("string")
    key = F.concat(F.lit("media-raw/video/"), V.storage_source(), F.lit("/"), F.col("lang"), F.lit("/v"), doc)
    jobs = V.table(spark, sf, "documents").select(
        F.concat(F.lit("job-"), doc).alias("job_id"),
        F.lit("IN_PROGRESS").alias("status"),
        key.alias("video_s3_key"),
        F.lit("media").alias("video_s3_bucket"),
    )
    found = J.join_jobs(V.index_rows(spark, sf).select("s3_key"), jobs)
    return found.select("job_id", "job_status", "s3_key", "video_s3_bucket")


@query(
    "join_responses",
    """SELECT o_orderkey AS job_id, CASE WHEN l.l_orderkey IS NULL THEN 'no response' END AS reason, count(*) AS n
       FROM orders LEFT JOIN lineitem l ON o_orderkey = l_orderkey GROUP BY ALL""",
)
def _(spark, sf):
    jobs = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("job_id"))
    pages = V.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("job_id"), "l_linenumber")
    ok, missing = J.join_responses(jobs, pages)
    both = ok.select("job_id", F.lit(None).cast("string").alias("reason")).unionByName(
        missing.select("job_id", "reason")
    )
    return both.groupBy("job_id", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "join_status",
    f"""WITH {V.SQL_STATUS} SELECT c_custkey AS job_id, status, ms FROM customer LEFT JOIN (
          SELECT * FROM polls QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY ts DESC) = 1) p
        ON c_custkey = p.job_id""",
)
def _(spark, sf):
    jobs = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("job_id"))
    joined = J.join_status(jobs, V.status_events(spark, sf))
    return joined.select("job_id", "status", F.unix_millis("ts").alias("ms"))


@query(
    "latest_per_key",
    f"""WITH {V.SQL_STATUS} SELECT job_id, status, ms FROM polls
        QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY ts DESC) = 1""",
)
def _(spark, sf):
    last = R.latest(V.status_events(spark, sf), ["job_id"], ["ts"])
    return last.select("job_id", "status", F.unix_millis("ts").alias("ms"))
