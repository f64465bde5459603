import json

from pyspark.sql import functions as F

from framefold import schemas
from framefold.plans.batch import run_batch
from framefold.session import scratch_dir
from framefold.sources import index_table as I
from tests.test_catalogues import hit, landed, page


def test_two_batches_second_is_all_duplicates(spark, tmp_path):
    pages = {str(i): page(f"File:Clip {i}.mp4") for i in range(3)}
    inputs = {
        "wikimedia": landed(spark, {"query": {"pages": pages}}),
        "pixabay": landed(spark, {"hits": [hit(1), hit(2), hit(3)]}),
    }
    path = str(tmp_path / "index")
    I.append_index(spark.createDataFrame([], schemas.INDEX), path)

    def jobs(assets):
        return assets.select(
            F.concat(F.lit("job-"), "source_id").alias("job_id"),
            F.lit("IN_PROGRESS").alias("status"),
            F.col("s3_key").alias("video_s3_key"),
            F.lit("bucket").alias("video_s3_bucket"),
        )

    answers = [
        ("job-File:Clip 0.mp4", 0, {"JobStatus": "SUCCEEDED", "Labels": [{"Label": {"Name": "Sky", "Confidence": 9.5}}]}),
        ("job-1", 0, {"JobStatus": "SUCCEEDED"}),
        ("job-2", 0, {"JobStatus": "FAILED", "StatusMessage": "Job failed"}),
    ]
    detections = spark.createDataFrame(
        [(j, p, json.dumps(d)) for j, p, d in answers], "job_id string, page bigint, body string"
    )

    def batch(now, store=None):
        known = I.read_index(spark, path)
        return run_batch(
            inputs, known, jobs, detections, 4, F.lit(now).cast("timestamp"),
            available={"catalogue_b_key"}, store=store,
        )

    first = batch("2024-01-01 12:00:00")
    assert first.assets.count() == 4  # two per source
    assert {r.s3_key for r in first.assets.collect()} >= {
        "media-raw/video/wikimedia/nature/20240101_120000/wikimedia_File:Clip 0.mp4_Clip_0.mp4.mp4",
        "media-raw/video/pixabay/nature/20240101_120000/pixabay_1_tag1.mp4",
    }
    rejected = {(r.stage, r.reason) for r in first.rejects.collect()}
    assert rejected == {("finalize", "Job failed"), ("finalize", "no response")}
    texts = "".join(r.text for r in first.analyses.coalesce(1).collect())
    docs = {d["video_s3_key"]: d for d in map(json.loads, texts.splitlines())}
    assert len(docs) == 2 and all("media-raw" in k for k in docs)
    assert sorted(len(d["labels"]) for d in docs.values()) == [0, 1]
    I.append_index(first.index, path)
    stored = {r.source_id: r for r in I.read_index(spark, path).collect()}
    assert set(stored) == {"File:Clip 0.mp4", "1"}
    sky = stored["File:Clip 0.mp4"]
    assert json.loads(sky.metadata)["top_labels"] == [{"name": "Sky", "confidence": 9.5}]
    assert sky.id == "video#nature#20240101120000" and sky.ttl == 1704110400 + 365 * 86400
    assert json.loads(stored["1"].metadata)["total_labels"] == 0

    root = scratch_dir(spark, "test")

    def store(name, df):
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    # what was indexed is not taken again; what failed is
    second = batch("2024-01-02 12:00:00", store)
    assert sorted(r.source_id for r in second.assets.collect()) == ["2", "File:Clip 1.mp4"]
    assert second.index.count() == 0 and second.rejects.count() == 2


def test_nothing_is_lost(spark):
    """Every asset ends in the index or in the rejects, every broken response in the rejects."""
    pages = {str(i): page(f"File:Clip {i}.mp4") for i in range(4)}
    good = landed(spark, {"query": {"pages": pages}})
    rows = good.union(good.selectExpr("CAST(NULL AS STRING)", "response", "body")).union(
        spark.createDataFrame([("nature", 7, "<html>"), ("empty", 8, "{}")], good.schema)
    )

    def jobs(assets):
        named = assets.where("s3_key IS NOT NULL AND source_id <> 'File:Clip 0.mp4'")
        return named.selectExpr(
            "source_id AS job_id", "'IN_PROGRESS' AS status", "s3_key AS video_s3_key", "'b' AS video_s3_bucket"
        )

    answers = [("File:Clip 1.mp4", "SUCCEEDED"), ("File:Clip 2.mp4", "FAILED")]
    detections = spark.createDataFrame(
        [(j, 0, json.dumps({"JobStatus": s})) for j, s in answers], "job_id string, page bigint, body string"
    )
    index = spark.createDataFrame([], "media_type string, campaign string, source string, source_id string")
    out = run_batch({"wikimedia": rows}, index, jobs, detections, 10, F.lit("2024-01-01 12:00:00").cast("timestamp"))
    rejected = sorted((r.stage, r.reason) for r in out.rejects.collect())
    assert rejected == [
        ("finalize", "Unknown error"), ("finalize", "no response"), ("ingest", "unreadable response"),
        *[("start", "missing s3_key")] * 4, ("start", "no job"),
    ]
    assert out.assets.count() == out.index.count() + sum(s != "ingest" for s, _ in rejected)
    counts = {r.campaign: (r.processed_count, r.rejected_count) for r in out.counts.collect()}
    assert counts == {"nature": (1, 3), None: (0, 4)}
    envelopes = {r.campaign: (r.batch_size, r.ingested_count) for r in out.envelopes.collect()}
    assert envelopes["empty"] == (10, 0) and envelopes["nature"] == (10, 4)


def test_no_source_left(spark):
    assert run_batch({"pixabay": None}, None, None, None, 2, F.lit(None), requested="pixabay") is None
