import os
from pyspark.sql import functions as F

from framefold import schemas
from framefold.operators import aggregates as A
from framefold.operators import joins as J
from framefold.operators.gates import require
from framefold.operators.sets import campaign_catalogue
from framefold.sources import index_table as I
from framefold.sources.objects import list_keys, scan_inventory, scan_objects, source_flags, with_file_size


def record(key, campaign="nature", at="2024-01-01", metadata="{}", ttl=100, source="wikimedia", sid="x", **over):
    row = {
        "id": f"video#{campaign}#1", "media_type": "video", "campaign": campaign, "s3_key": key,
        "processed_key": key + "_labels.json", "ingested_at": "20240101_120000", "processed_at": at,
        "metadata": metadata, "ttl": ttl, "source": source, "source_id": sid,
    }
    row.update(over)
    return tuple(row.values())


def table(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.INDEX)


def test_index_append_read_compact(spark, tmp_path):
    path, new = str(tmp_path / "log"), str(tmp_path / "new")
    I.append_index(table(spark, record("a", metadata='{"duration": 30.0}'), record("b", "tech", metadata="broken")), path)
    I.append_index(table(spark, record("a", at="2024-02-01", metadata='{"duration": 31.0}')), path)
    assert I.read_index(spark, path).count() == 2
    nature = I.read_index(spark, path, campaign="nature")
    row = nature.select("processed_at", F.variant_get("metadata_doc", "$.duration", "double").alias("d")).first()
    assert (row.processed_at, row.d) == ("2024-02-01", 31.0)
    plan = nature._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(campaign" in plan
    broken = I.read_index(spark, path, campaign="tech").select(F.to_json("metadata_doc").alias("m")).first()
    assert broken.m == "{}"
    I.compact_index(spark, path, new)
    assert spark.read.parquet(new).count() == 2
    assert I.read_index(spark, path, media_type="video").count() == 2


def test_upsert_key_choice_query_and_expiry(spark):
    old = table(spark, record("a"), record("b"))
    new = table(spark, record("b", at="2024-03-01"), record("c", at="2023-01-01"))
    merged = I.upsert_index(old, new)
    assert {(r.s3_key, r.processed_at) for r in merged.collect()} == {
        ("a", "2024-01-01"), ("b", "2024-03-01"), ("c", "2023-01-01"),
    }
    assert I.upsert_index(old, new, key=["id"]).count() == 1
    assert [r.s3_key for r in I.query_index(merged, "nature", "video", 2).collect()] == ["b", "a"]
    assert I.query_index(merged, "tech").count() == 0 and I.query_index(merged, None, None, None).count() == 3
    assert I.unexpired(table(spark, record("a", ttl=5), record("b", ttl=6)), 5).count() == 1


def test_drop_indexed_ignores_empty_ids_and_keeps_repeats(spark):
    cand = spark.createDataFrame(
        [("video", "nature", "s", i, n) for n, i in enumerate(["1", "1", "2", "", None, "3"])],
        "media_type string, campaign string, source string, source_id string, n int",
    )
    index = table(spark, record("k", source="s", sid="1"), record("k2", source="s", sid=""), record("k3", "tech", source="s", sid="2"))
    kept = J.drop_indexed(cand, index)
    assert sorted(r.n for r in kept.collect()) == [2, 3, 4, 5]
    assert kept.columns == cand.columns
    # an id that looks like a spread value is still compared as an id
    index = table(spark, *[record("k", source="s", sid=str(i)) for i in range(5)])
    assert sorted(r.n for r in J.drop_indexed(cand, index).collect()) == [3, 4]


def test_jobs_responses_and_gates(spark):
    assets = spark.createDataFrame([("k1",), ("k2",), ("",)], "s3_key string")
    jobs = spark.createDataFrame(
        [("j1", "IN_PROGRESS", "k1", "b"), ("j2", "IN_PROGRESS", "k2", "b"), ("j3", "X", "", "b")],
        "job_id string, status string, video_s3_key string, video_s3_bucket string",
    )
    joined = J.join_jobs(assets, jobs)
    assert sorted(r.job_id for r in joined.collect()) == ["j1", "j2"]
    ok, missing = J.join_responses(joined, spark.createDataFrame([("j1", 0), ("j1", 1)], "job_id string, page int"))
    assert ok.count() == 2 and [r.job_id for r in missing.collect()] == ["j2"]
    good, bad = require(spark.createDataFrame([("a", "b"), ("", None)], "x string, y string"), ["x", "y"])
    assert good.count() == 1 and bad.first().reason == "missing x,y"


def test_stats_and_sets(spark):
    keys = [
        "media-raw/video/wikimedia/nature/20240101_120000/a.mp4",
        "media-raw/video/wikimedia/pixabay-fans/20240101_120000/b.mp4",
        "media-raw/video/pixabay/tech/20240101_120000/",
        "media-raw/video/pixabay/tech/20240101_120000/c.webm",
        "media-raw/video/wikimedia/",
        "media-raw/video/nature/20240102_120000/legacy.mp4",
        "other/video/x/zzz/1",
    ]
    objects = spark.createDataFrame([(k,) for k in keys], "key string")
    index = table(spark, record(keys[0]), record(keys[1]), record("legacy"))
    s = A.lake_stats(objects, index, ["wikimedia", "pixabay"]).first()
    assert (s.raw_total, s.raw_wikimedia, s.raw_pixabay) == (3, 2, 1)
    assert (s.processed_total, s.processed_wikimedia, s.processed_pixabay) == (3, 2, 1)
    exact = A.lake_stats(objects, index, ["wikimedia", "pixabay"], exact=True).first()
    assert (exact.processed_wikimedia, exact.processed_pixabay) == (2, 0)
    flags = source_flags(objects, "key", ["wikimedia", "pixabay"]).collect()[1]
    assert flags.is_wikimedia and flags.is_pixabay
    assert list_keys(objects, "key", "media-raw/video/pixabay/").count() == 1
    got = [r.campaign for r in campaign_catalogue(objects, predefined=["travel"]).collect()]
    assert got == ["20240102_120000", "nature", "pixabay-fans", "tech", "travel"]
    counts = A.source_counts(spark.createDataFrame([("wikimedia",)], "source string"), ["wikimedia", "pixabay"])
    assert {r.source: r.ingested_count for r in counts.collect()} == {"wikimedia": 1, "pixabay": 0}
    assert A.total_ingested(counts).first().ingested_count == 1
    empty = spark.createDataFrame([], "status string")
    assert A.any_running(empty).first().any_running is False


def test_envelope_with_chunks(spark):
    assets = spark.createDataFrame(
        [("nature", "wikimedia" if i % 2 else "pixabay", i, f"t{i}") for i in range(7)],
        "campaign string, source string, pos bigint, title string",
    )
    env = A.batch_result(assets, 10, ["wikimedia", "pixabay"])
    row = env.first()
    assert (row.ingested_count, row.source_counts) == (7, {"wikimedia": 3, "pixabay": 4})
    lists = A.metadata_by_source(assets, ["campaign"], "pos", ["title"], chunk_size=4)
    docs = {r.chunk: r for r in A.batch_documents(env, lists).collect()}
    assert [m.title for m in docs[0].metadata_by_source["pixabay"]] == ["t0", "t2"]
    assert sum(len(d.metadata) for d in docs.values()) == 7


def test_object_scan(spark, tmp_path):
    folder = tmp_path / "media-raw" / "video" / "wikimedia"
    folder.mkdir(parents=True)
    (folder / "a.mp4").write_bytes(b"fake video data")
    (tmp_path / "other.txt").write_text("x")
    rows = scan_objects(spark, str(tmp_path), "media-raw/video/wiki")
    assert [(r.key, r.length) for r in rows.collect()] == [("media-raw/video/wikimedia/a.mp4", 15)]
    assert scan_objects(spark, str(tmp_path)).count() == 2
    sized = with_file_size(rows.withColumn("size", F.lit(None).cast("bigint")), "size", F.col("length"))
    assert sized.first().file_size == 15


def test_listing_by_folders_and_inventory(spark, tmp_path):
    names = ["a.txt", "x/b.txt", "x/y/c.txt", "x/y/z/d.txt", "x/y/z/w/_e.txt", "q/root/f.txt"]
    root = tmp_path / "root"
    for n, name in enumerate(names):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("é" * n)
        os.utime(root / name, (1_700_000_000 + n, 1_700_000_000 + n))
    for depth in (0, 1, 2, 7):
        rows = scan_objects(spark, f"file://{root}", depth=depth).collect()
        assert sorted((r.key, r.length, r.modified.timestamp()) for r in rows) == sorted(
            (name, 2 * n, 1_700_000_000.0 + n) for n, name in enumerate(names)
        )
    assert sorted(r.key for r in scan_objects(spark, str(root), "x/y/").collect()) == sorted(names[2:5])
    assert scan_objects(spark, str(root), "absent/").count() == 0 == scan_objects(spark, str(tmp_path / "no")).count()
    inventory = spark.createDataFrame(
        [("x/b.txt", "2", "2023-11-14T22:13:21Z"), ("x/", "0", None), ("y/c", "5", "1700000002")],
        "key string, size string, last_modified string",
    )
    rows = scan_inventory(inventory, "x/").collect()
    assert [(r.key, r.length, r.modified.timestamp()) for r in rows] == [("x/b.txt", 2, 1_700_000_001.0)]
