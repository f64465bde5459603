"""Domain inputs derived from the given tables.

Each function reads whole tables and derives rows by narrow projections (and
equi-joins), so the inputs grow with the tables. The ``SQL_*`` texts derive the
same rows for the reference SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framefold.constants import MAP_STATE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns_of(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, name).select(*columns)


def _mod(c: str, n: int) -> Column:
    return F.col(c) % F.lit(n)


# --- detections -------------------------------------------------------------

DET_ORDER = ["p1", "p2", "p3", "p4"]


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detection per order line: the part type seen in the order's video."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return lines.join(parts, "l_partkey").select(
        F.col("l_orderkey").alias("video"),
        F.col("p_type").alias("name"),
        (F.col("l_quantity") * 2).alias("confidence"),
        (F.nullif((F.col("l_linenumber") - 1) * 1000, F.lit(0)) / F.lit(1000.0)).alias("timestamp"),
        F.col("l_linenumber").alias("p1"),
        F.col("l_partkey").alias("p2"),
        F.col("l_suppkey").alias("p3"),
        F.col("l_extendedprice").alias("p4"),
    )


SQL_DET = """det AS (
  SELECT l_orderkey AS video, p_type AS name, l_quantity * 2 AS confidence,
         nullif((l_linenumber - 1) * 1000, 0) / 1000.0::DOUBLE AS "timestamp",
         l_linenumber AS p1, l_partkey AS p2, l_suppkey AS p3, l_extendedprice AS p4
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def response_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw detection responses: one page of two labels, or of none, per order line."""

    def label(ms: Column, name: str, confidence: Column, flagged: Column) -> Column:
        boxes = F.when(flagged, F.array(F.struct(F.lit(1).alias("Top"))))
        return F.struct(
            ms.alias("Timestamp"),
            F.struct(
                F.col(name).alias("Name"),
                confidence.alias("Confidence"),
                boxes.alias("Instances"),
            ).alias("Label"),
        )

    ms = ((F.col("l_linenumber") - 1) * 1000).cast("bigint")
    status = F.when(F.col("l_tax") > 0.06, "FAILED").otherwise("SUCCEEDED")
    failed = F.col("l_tax") > 0.06
    body = F.struct(
        status.alias("JobStatus"),
        F.when(F.col("l_tax") > 0.07, "no media").alias("StatusMessage"),
        F.struct((F.col("l_suppkey") * 10).alias("DurationMillis")).alias("VideoMetadata"),
        F.when(
            ~failed & (F.col("l_tax") > 0),
            F.array(
                label(ms, "l_returnflag", F.col("l_quantity") * 2, F.col("l_quantity") > 25),
                label(ms + 500, "l_linestatus", F.col("l_discount") * 1000, F.lit(False)),
            ),
        ).alias("Labels"),
        F.when(
            F.col("l_returnflag") == "R", F.array(F.struct(F.lit("x").alias("Name")))
        ).alias("ModerationLabels"),
    )
    page = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    lines = columns_of(
        spark,
        sf_dir,
        "lineitem",
        *("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"),
        *("l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"),
    )
    return lines.select(
        F.col("l_orderkey").alias("job_id"), page.alias("page"), F.to_json(body).alias("body")
    )


SQL_PAGES = """pages_in AS (
  SELECT l_orderkey AS job_id, l_linenumber AS p1, l_partkey AS p2, l_suppkey AS p3,
         l_extendedprice AS p4, l_returnflag, l_linestatus, l_quantity, l_discount,
         CASE WHEN l_tax > 0.06 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
         CASE WHEN l_tax > 0.07 THEN 'no media' END AS message,
         nullif(l_suppkey * 10, 0) / 1000.0::DOUBLE AS duration,
         l_returnflag = 'R' AS flagged, l_tax > 0 AND l_tax <= 0.06 AS has_labels,
         CAST((l_linenumber - 1) * 1000 AS BIGINT) AS ms
  FROM lineitem),
labels_in AS (
  SELECT job_id, p1, p2, p3, p4, status, 0 AS pos, l_returnflag AS name,
         l_quantity * 2 AS confidence, nullif(ms, 0) / 1000.0::DOUBLE AS "timestamp",
         CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS n_instances
  FROM pages_in WHERE has_labels
  UNION ALL
  SELECT job_id, p1, p2, p3, p4, status, 1, l_linestatus, l_discount * 1000,
         (ms + 500) / 1000.0::DOUBLE, 0
  FROM pages_in WHERE has_labels)"""


# --- candidates, keys, index ------------------------------------------------


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One candidate per document: language as campaign, the whole text as title."""
    kind = _mod("doc_id", 5)
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.lit("video").alias("media_type"),
        F.col("lang").alias("campaign"),
        "source",
        F.when(_mod("n_chars", 10) == 0, "").otherwise(F.col("doc_id").cast("string")).alias(
            "source_id"
        ),
        F.col("text").alias("title"),
        F.concat(
            F.lit("https://media.example/v"),
            F.col("doc_id").cast("string"),
            F.when(kind == 3, ".webm").otherwise(""),
        ).alias("url"),
        F.when(kind == 0, "video/mp4").when(kind == 1, "video/webm").when(kind == 2, "image/png").otherwise(
            "video/ogg"
        ).alias("mime"),
        F.col("n_chars").alias("size"),
        F.col("doc_id").alias("pos"),
    )


SQL_CAND = """cand AS (
  SELECT 'video' AS media_type, lang AS campaign, source,
         CASE WHEN n_chars % 10 = 0 THEN '' ELSE CAST(doc_id AS VARCHAR) END AS source_id,
         text AS title,
         'https://media.example/v' || doc_id || CASE WHEN doc_id % 5 = 3 THEN '.webm' ELSE '' END AS url,
         CASE doc_id % 5 WHEN 0 THEN 'video/mp4' WHEN 1 THEN 'video/webm'
                         WHEN 2 THEN 'image/png' ELSE 'video/ogg' END AS mime,
         n_chars AS size, doc_id AS pos
  FROM documents)"""


def storage_source() -> Column:
    return F.when(_mod("doc_id", 3) == 0, "wikimedia").when(_mod("doc_id", 3) == 1, "pixabay").otherwise(
        F.col("source")
    )


def object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object key per document, some of them directory markers."""
    doc = F.col("doc_id").cast("string")
    folder = F.concat(
        F.lit("media-raw/video/"), storage_source(), F.lit("/"), F.col("lang"), F.lit("/20240101_"), doc
    )
    ext = F.when(_mod("doc_id", 2) == 0, ".mp4").otherwise(".webm")
    marker = _mod("n_chars", 25) == 0
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(marker, F.concat(folder, F.lit("/")))
        .otherwise(F.concat(folder, F.lit("/v"), doc, ext))
        .alias("key"),
    )


SQL_KEYS = """keys AS (
  SELECT doc_id,
         'media-raw/video/' || CASE doc_id % 3 WHEN 0 THEN 'wikimedia' WHEN 1 THEN 'pixabay' ELSE source END
         || '/' || lang || '/20240101_' || doc_id || '/'
         || CASE WHEN n_chars % 25 = 0 THEN ''
                 ELSE 'v' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '.mp4' ELSE '.webm' END END AS key
  FROM documents)"""


def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexed media: the labelled documents of good quality."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id", "toxic")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    doc = F.col("doc_id").cast("string")
    key = F.concat(F.lit("media-raw/video/"), storage_source(), F.lit("/"), F.col("lang"), F.lit("/v"), doc)
    return docs.join(good, "doc_id").select(
        F.lit("video").alias("media_type"),
        F.col("lang").alias("campaign"),
        "source",
        doc.alias("source_id"),
        key.alias("s3_key"),
        F.concat(key, F.lit("_labels.json")).alias("processed_key"),
        F.concat(F.lit("2024010"), (_mod("doc_id", 9) + 1).cast("string"), F.lit("_120000")).alias(
            "ingested_at"
        ),
        F.concat(F.lit("2024-01-0"), (_mod("doc_id", 9) + 1).cast("string")).alias("processed_at"),
        F.concat(F.lit('{"toxic": '), F.col("toxic").cast("string"), F.lit("}")).alias("metadata"),
        (F.lit(1700000000) + F.col("n_chars")).cast("bigint").alias("ttl"),
    )


SQL_INDEX = """idx AS (
  SELECT 'video' AS media_type, lang AS campaign, source, CAST(doc_id AS VARCHAR) AS source_id,
         'media-raw/video/' || CASE doc_id % 3 WHEN 0 THEN 'wikimedia' WHEN 1 THEN 'pixabay' ELSE source END
           || '/' || lang || '/v' || doc_id AS s3_key,
         'media-raw/video/' || CASE doc_id % 3 WHEN 0 THEN 'wikimedia' WHEN 1 THEN 'pixabay' ELSE source END
           || '/' || lang || '/v' || doc_id || '_labels.json' AS processed_key,
         '2024010' || (doc_id % 9 + 1) || '_120000' AS ingested_at,
         '2024-01-0' || (doc_id % 9 + 1) AS processed_at,
         '{"toxic": ' || toxic || '}' AS metadata,
         CAST(1700000000 + n_chars AS BIGINT) AS ttl
  FROM documents JOIN labels USING (doc_id) WHERE quality = 1)"""


# --- raw catalogue responses --------------------------------------------------


def raw_catalogue_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw response of two pages per document, each page kept or dropped for its own reason."""
    kind = _mod("doc_id", 7)
    doc = F.col("doc_id").cast("string")

    def meta(c: str) -> Column:
        return F.struct(F.col(c).alias("value"))

    def info(ext: str, mime: Column) -> Column:
        return F.struct(
            F.concat(F.lit("https://media.example/a"), doc, F.lit(ext)).alias("url"),
            F.col("n_chars").alias("size"),
            mime.alias("mime"),
            F.create_map(F.lit("Artist"), meta("source"), F.lit("License"), meta("lang")).alias(
                "extmetadata"
            ),
        )

    def cats(title: Column) -> Column:
        return F.array(F.struct(F.lit("Category:Video").alias("title")), F.struct(title.alias("title")))

    none = F.array().cast(
        "array<struct<url:string,size:bigint,mime:string,extmetadata:map<string,struct<value:string>>>>"
    )
    licence = F.when(kind == 3, "Category:Other").otherwise("Category:CC-BY-4.0")
    mime = F.when(kind == 2, "image/png").otherwise("video/mp4")
    first = F.struct(
        F.concat(F.lit("File:"), F.col("text")).alias("title"),
        F.when(kind == 0, F.lit(None)).when(kind == 1, none).otherwise(F.array(info(".mp4", mime))).alias(
            "imageinfo"
        ),
        F.when(kind != 4, cats(licence)).alias("categories"),
    )
    second = F.struct(
        F.concat(F.lit("File:alt "), doc).alias("title"),
        F.array(info(".webm", F.lit("video/webm"))).alias("imageinfo"),
        cats(F.lit("Category:CC0")).alias("categories"),
    )
    body = F.struct(F.struct(F.create_map(doc, first, F.lit("alt"), second).alias("pages")).alias("query"))
    return columns_of(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars").select(
        F.col("lang").alias("campaign"), F.col("doc_id").alias("response"), F.to_json(body).alias("body")
    )


SQL_CATALOGUE_A = """cat_a AS (
  SELECT lang AS campaign, doc_id AS response, 0 AS pos, 'File:' || text AS source_id,
         'https://media.example/a' || doc_id || '.mp4' AS url, n_chars AS size, 'video/mp4' AS mime,
         source AS author, lang AS license
  FROM documents WHERE doc_id % 7 IN (5, 6)
  UNION ALL
  SELECT lang, doc_id, 1, 'File:alt ' || doc_id, 'https://media.example/a' || doc_id || '.webm',
         n_chars, 'video/webm', source, lang
  FROM documents)"""


def raw_catalogue_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw response of two hits per document with differing renditions."""
    kind = _mod("doc_id", 5)
    doc = F.col("doc_id").cast("string")

    def rendition(tag: str, size: Column) -> Column:
        url = F.concat(F.lit(f"https://media.example/{tag}"), doc)
        return F.struct((url if tag else F.lit("")).alias("url"), size.alias("size"))

    def videos(*pairs) -> Column:
        return F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)])

    n = F.col("n_chars")
    one = (
        F.when(kind == 0, videos(("large", rendition("l", n)), ("medium", rendition("m", n + 1))))
        .when(kind == 1, videos(("large", rendition("l", n)), ("small", rendition("s", n + 2))))
        .when(kind == 2, videos(("large", rendition("l", n))))
        .when(kind == 3, videos(("medium", rendition("", n)), ("small", rendition("s", n))))
    )
    first = F.struct(
        F.col("doc_id").alias("id"),
        F.col("text").alias("tags"),
        F.col("source").alias("user"),
        (n % 60).cast("double").alias("duration"),
        one.alias("videos"),
    )
    second = F.struct(
        (F.col("doc_id") + 5000000000).alias("id"),
        F.lit(None).cast("string").alias("tags"),
        F.lit(None).cast("string").alias("user"),
        F.lit(None).cast("double").alias("duration"),
        videos(("small", rendition("z", n))).alias("videos"),
    )
    return columns_of(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars").select(
        F.col("lang").alias("campaign"),
        F.col("doc_id").alias("response"),
        F.to_json(F.struct(F.array(first, second).alias("hits"))).alias("body"),
    )


SQL_CATALOGUE_B = """hits_b AS (
  SELECT lang AS campaign, doc_id AS response, 0 AS pos, CAST(doc_id AS VARCHAR) AS source_id, text AS title,
         CASE doc_id % 5 WHEN 0 THEN 'https://media.example/m' || doc_id
                         WHEN 1 THEN 'https://media.example/s' || doc_id
                         WHEN 2 THEN 'https://media.example/l' || doc_id ELSE '' END AS url,
         CASE doc_id % 5 WHEN 0 THEN n_chars + 1 WHEN 1 THEN n_chars + 2 ELSE n_chars END AS size,
         source AS author, text AS description, CAST(n_chars % 60 AS DOUBLE) AS duration
  FROM documents
  UNION ALL
  SELECT lang, doc_id, 1, CAST(doc_id + 5000000000 AS VARCHAR), lang,
         'https://media.example/z' || doc_id, n_chars, '', '', 0.0
  FROM documents)"""


# --- executions, histories, status events ------------------------------------


def executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One workflow execution per order; input and output are JSON texts."""
    key = F.col("o_orderkey")
    done = F.col("o_orderstatus") == "O"
    given = F.struct(
        F.when(key % 4 != 0, F.col("o_orderpriority")).alias("campaign"),
        F.when(key % 3 != 0, F.col("o_custkey") % 10).alias("batch_size_video"),
    )
    got = F.struct(
        (F.col("o_custkey") % 7).alias("ingested_count"),
        F.array(F.struct(key.alias("id"))).alias("metadata"),
        F.struct((F.col("o_custkey") % 5).alias("processed_count")).alias("finalization"),
    )
    return columns_of(
        spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    ).select(
        F.concat(F.lit("arn:states:execution:media:"), key.cast("string")).alias("arn"),
        F.col("o_orderdate").alias("start"),
        F.when(F.col("o_orderstatus") == "F", "FAILED")
        .when(done, "SUCCEEDED")
        .otherwise("RUNNING")
        .alias("status"),
        F.to_json(given).alias("input"),
        F.when(done, F.to_json(got)).when(F.col("o_orderstatus") == "F", "not json").alias("output"),
    )


SQL_EXEC = """execs AS (
  SELECT 'arn:states:execution:media:' || o_orderkey AS arn, o_orderdate AS start,
         CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'SUCCEEDED' ELSE 'RUNNING' END AS status,
         CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS campaign,
         CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 10 END AS batch_size,
         CASE WHEN o_orderstatus = 'O' THEN o_custkey % 5 END AS processed_count,
         CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS n_metadata
  FROM orders)"""

# event_type and event_id % 4 to the workflow event type
_KINDS = {
    "signup": ["TaskStateEntered", "MapStateEntered", "WaitStateEntered", "TaskStateExited"],
    "click": ["LambdaFunctionScheduled", "TaskScheduled", "MapIterationStarted", "ExecutionStarted"],
    "view": ["LambdaFunctionStarted", "TaskStarted", "TaskStateEntered", "WaitStateExited"],
    "purchase": ["LambdaFunctionSucceeded", "TaskSucceeded", "MapIterationSucceeded", "MapStateSucceeded"],
    "error": ["LambdaFunctionFailed", "TaskFailed", "MapIterationFailed", "ExecutionFailed"],
}
_TASKS = ["IngestVideo", "StartRekognitionJobs", "CheckJobStatus", "FinalizeResults", "Custom"]


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat history events: one per event; the user is the execution."""
    kinds = F.create_map(
        *[F.lit(x) for t, names in _KINDS.items() for i, n in enumerate(names) for x in (f"{t}{i}", n)]
    )
    v = F.floor("value").cast("bigint")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    ms = F.floor(F.timestamp_diff("MICROSECOND", epoch, F.col("ts")) / 1000).cast("bigint")
    base = columns_of(
        spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value"
    ).select(
        F.col("user_id").cast("string").alias("execution_arn"),
        F.col("event_id").alias("id"),
        F.try_element_at(
            kinds, F.concat("event_type", _mod("event_id", 4).cast("string"))
        ).alias("type"),
        F.timestamp_millis(ms).alias("ts"),
        v.alias("v"),
        v.cast("string").alias("text"),
    )
    odd = F.col("v") % 2
    task = F.try_element_at(F.array(*map(F.lit, _TASKS)), (F.col("v") % 5 + 1).cast("int"))
    kind = F.col("type")

    def of(*types: str) -> Column:
        return kind.isin(*types)

    result = (
        F.when(F.col("v") % 4 == 1, F.concat(F.lit('{"n":'), F.col("text"), F.lit("}")))
        .when(F.col("v") % 4 == 2, "broken")
        .otherwise("{}")
    )
    failed = kind.endswith("Failed")
    return base.select(
        "execution_arn",
        "id",
        "type",
        "ts",
        F.when(of("TaskStateEntered", "TaskStateExited"), task)
        .when(of("MapStateEntered"), MAP_STATE)
        .alias("name"),
        F.when(
            of("MapStateEntered"),
            F.concat(
                F.lit('{"rekognition":{"jobs":['), F.repeat(F.lit("1,"), odd.cast("int")), F.lit("1]}}")
            ),
        ).alias("input"),
        F.when(of("WaitStateEntered"), odd * 30).cast("double").alias("seconds"),
        F.when(
            of("LambdaFunctionScheduled"),
            F.when(F.col("v") % 3 == 0, "").otherwise(
                F.concat(F.lit("arn:lambda:f"), (F.col("v") % 4).cast("string"))
            ),
        )
        .when(
            of("TaskScheduled"),
            F.when(odd == 1, F.concat(F.lit("arn:batch:"), F.col("text"))).otherwise(""),
        )
        .alias("resource"),
        F.when(of("LambdaFunctionSucceeded", "TaskSucceeded"), result)
        .when(of("MapStateSucceeded"), F.when(odd == 1, "[1,2]").otherwise("[]"))
        .alias("output"),
        F.when(
            failed,
            F.when(odd == 1, F.concat(F.lit("E"), F.col("text"))).otherwise("Unknown error"),
        ).alias("error"),
        F.when(failed, F.col("text")).alias("cause"),
        F.when(kind.startswith("MapIteration"), F.col("v") % 3)
        .otherwise(F.lit(0))
        .cast("bigint")
        .alias("index"),
    )


def raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as raw event documents: details under a key named after the type."""

    def detail(key: str, types: list[str], *fields: str) -> Column:
        body = F.struct(*fields)
        return F.when(F.col("type").isin(types), body).alias(f"{key}EventDetails")

    failure = ["error", "cause"]
    doc = F.struct(
        "id",
        "type",
        F.unix_millis("ts").alias("timestamp"),
        detail("stateEntered", ["TaskStateEntered", "MapStateEntered"], "name", "input"),
        detail("stateExited", ["TaskStateExited"], "name"),
        detail("waitStateEntered", ["WaitStateEntered"], "seconds"),
        detail("lambdaFunctionScheduled", ["LambdaFunctionScheduled"], "resource"),
        detail("taskScheduled", ["TaskScheduled"], "resource"),
        detail("lambdaFunctionSucceeded", ["LambdaFunctionSucceeded"], "output"),
        detail("taskSucceeded", ["TaskSucceeded"], "output"),
        detail("mapStateSucceeded", ["MapStateSucceeded"], "output"),
        detail("lambdaFunctionFailed", ["LambdaFunctionFailed"], *failure),
        detail("taskFailed", ["TaskFailed"], *failure),
        detail("executionFailed", ["ExecutionFailed"], *failure),
        detail("mapIterationStarted", ["MapIterationStarted"], "index"),
        detail("mapIterationSucceeded", ["MapIterationSucceeded"], "index"),
        detail("mapIterationFailed", ["MapIterationFailed"], "index", *failure),
    )
    return history(spark, sf_dir).select("execution_arn", F.to_json(doc).alias("body"))


def _sql_kind() -> str:
    arms = [
        f"WHEN event_type = '{t}' AND event_id % 4 = {i} THEN '{name}'"
        for t, kinds in _KINDS.items()
        for i, name in enumerate(kinds)
    ]
    return "CASE " + " ".join(arms) + " ELSE '' END"


SQL_HIST = f"""h0 AS (
  SELECT CAST(user_id AS VARCHAR) AS execution_arn, event_id AS id, {_sql_kind()} AS type,
         epoch_us(ts) // 1000 AS ms, CAST(floor(value) AS BIGINT) AS v
  FROM events),
hist AS (
  SELECT execution_arn, id, type, ms, v,
    CASE WHEN type IN ('TaskStateEntered', 'TaskStateExited')
           THEN CASE v % 5 WHEN 0 THEN 'IngestVideo' WHEN 1 THEN 'StartRekognitionJobs'
                           WHEN 2 THEN 'CheckJobStatus' WHEN 3 THEN 'FinalizeResults' ELSE 'Custom' END
         WHEN type = 'MapStateEntered' THEN 'ProcessRekognitionJobs' END AS name,
    CASE WHEN type = 'WaitStateEntered' THEN (v % 2) * 30 END AS seconds,
    CASE WHEN type = 'LambdaFunctionScheduled'
           THEN CASE WHEN v % 3 = 0 THEN '' ELSE 'arn:lambda:f' || (v % 4) END
         WHEN type = 'TaskScheduled' THEN CASE WHEN v % 2 = 1 THEN 'arn:batch:' || v ELSE '' END
    END AS resource,
    CASE WHEN type = 'LambdaFunctionSucceeded'
           THEN CASE v % 4 WHEN 1 THEN '{{"n":' || v || '}}' WHEN 2 THEN '{{"raw_output":"broken"}}' END
         WHEN type = 'TaskSucceeded' THEN CASE v % 4 WHEN 1 THEN '{{"n":' || v || '}}' END
         WHEN type = 'MapStateSucceeded' THEN CASE WHEN v % 2 = 1 THEN '{{"completed_count":2}}' END
    END AS output,
    CASE WHEN type LIKE '%Failed' THEN CASE WHEN v % 2 = 1 THEN 'E' || v ELSE 'Unknown error' END END AS error,
    CASE WHEN type LIKE '%Failed' THEN CAST(v AS VARCHAR) END AS cause,
    CASE WHEN type LIKE 'MapIteration%' THEN v % 3 END AS idx
  FROM h0)"""


def status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job status polls: one per event, the user is the job."""
    status = (
        F.when(F.col("event_type") == "purchase", "SUCCEEDED")
        .when(F.col("event_type") == "error", "FAILED")
        .otherwise("IN_PROGRESS")
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("job_id"), status.alias("status"), F.col("ts").cast("timestamp").alias("ts")
    )


SQL_STATUS = """polls AS (
  SELECT user_id AS job_id, ts, epoch_us(ts) // 1000 AS ms,
         CASE event_type WHEN 'purchase' THEN 'SUCCEEDED' WHEN 'error' THEN 'FAILED'
                         ELSE 'IN_PROGRESS' END AS status
  FROM events)"""


def props_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties as stored metadata, part of them broken."""
    whole = F.col("props")
    broken = F.substr(whole, F.lit(1), F.length(whole) - F.lit(1))
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(_mod("event_id", 7) == 0, broken).otherwise(whole).alias("metadata")
    )
