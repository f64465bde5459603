import json
import random

from pyspark.sql import functions as F

from framefold.operators.detections import (
    analysis_parts,
    label_array,
    reduce_pages,
    summarize,
    summarize_pages,
    summarize_reduced,
)
from framefold.operators.ranking import top_k
from framefold.sources.detections import gate_succeeded, parse_label_facts, parse_responses, scan_detections
from framefold.sources.sinks import write_analysis


def landed(spark, rows):
    data = [(job, page, json.dumps(doc)) for job, page, doc in rows]
    return spark.createDataFrame(data, "job_id string, page bigint, body string")


def lab(name, conf, ms, instances=None):
    label = {"Name": name, "Confidence": conf}
    if instances is not None:
        label["Instances"] = instances
    return {"Timestamp": ms, "Label": label}


def documents_at(path):
    lines = [line for file in path.glob("part-*") for line in file.read_text().splitlines()]
    return [json.loads(line) for line in lines if line.strip()]


TWO = {
    "JobStatus": "SUCCEEDED",
    "VideoMetadata": {"DurationMillis": 10000},
    "Labels": [lab("Person", 95.5, 5000, [{"Confidence": 1.0}]), lab("Outdoor", 88.2, 3000)],
    "ModerationLabels": [],
}
MANY = {
    "JobStatus": "SUCCEEDED",
    "VideoMetadata": {"DurationMillis": 0},
    "Labels": [lab(f"L{i}", 50.0, i * 10) for i in range(11)] + [{"Timestamp": 7}],
    "ModerationLabels": [{"Name": "x"}],
}


def test_parse_summarize_and_documents(spark, tmp_path):
    raw = landed(
        spark,
        [
            ("two", 0, TWO),
            ("many", 0, MANY),
            ("many", 1, {"JobStatus": "SUCCEEDED", "Labels": [lab("Late", 99.0, 1)]}),
            ("none", 0, {"JobStatus": "SUCCEEDED", "VideoMetadata": {"DurationMillis": 4000}}),
            ("failed", 0, {"JobStatus": "FAILED", "StatusMessage": "Job failed"}),
            ("odd", 0, {"JobStatus": "FAILED"}),
        ],
    )
    ok, bad = gate_succeeded(parse_responses(raw))
    assert {r.job_id: r.reason for r in bad.collect()} == {
        "failed": "Job failed",
        "odd": "Unknown error",
    }
    det = scan_detections(ok, ["job_id", "page"])
    ts = {(r.job_id, r.page, r.pos): r.timestamp for r in det.collect()}
    assert ts[("two", 0, 0)] == 5.0 and ts[("many", 0, 0)] is None and ts[("none", 0, None)] is None
    unnamed = det.where("job_id = 'many' and page = 0 and pos = 11").first()
    assert (unnamed.name, unnamed.confidence, unnamed.timestamp) == ("", 0.0, 0.007)

    long_form = summarize(det, ok, "job_id", ["page", "pos"]).collect()
    by_page = summarize_pages(ok, "job_id", "page").collect()
    assert sorted(map(str, long_form)) == sorted(map(str, by_page))
    got = {r.job_id: r for r in by_page}
    assert (got["two"].total_labels, got["two"].duration) == (2, 10.0)
    assert [t.name for t in got["two"].top_labels] == ["Person", "Outdoor"]
    assert got["two"].has_moderation_issues is False
    assert got["many"].total_labels == 13 and got["many"].duration is None
    assert [t.name for t in got["many"].top_labels] == ["Late"] + [f"L{i}" for i in range(9)]
    assert got["many"].has_moderation_issues is True
    assert (got["none"].total_labels, got["none"].top_labels, got["none"].duration) == (0, [], 4.0)

    facts, _ = gate_succeeded(parse_label_facts(raw))
    light = summarize_reduced(reduce_pages(facts, ["job_id", "page"]), "job_id", "page").collect()
    assert sorted(map(str, light)) == sorted(map(str, by_page))

    reduced = reduce_pages(ok, ["job_id", "page"], texts=True)
    parts = analysis_parts(reduced, summarize_reduced(reduced, "job_id", "page"), "job_id", "page")
    write_analysis(parts, str(tmp_path / "a"))
    back = {d["video_s3_key"]: d for d in documents_at(tmp_path / "a")}
    assert len(back) == 3 == len(documents_at(tmp_path / "a"))
    two, many, none = back["two"], back["many"], back["none"]
    assert set(two) == {"video_s3_key", "duration", "labels", "moderation_labels", "summary"}
    assert two["labels"] == [
        {"name": "Person", "confidence": 95.5, "timestamp": 5.0, "instances": [{"Confidence": 1.0}]},
        {"name": "Outdoor", "confidence": 88.2, "timestamp": 3.0, "instances": []},
    ]
    assert none["labels"] == [] and none["moderation_labels"] == [] and none["duration"] == 4.0
    assert none["summary"]["total_labels"] == 0 and none["summary"]["top_labels"] == []
    assert many["duration"] is None and many["summary"]["duration"] is None
    assert [x["name"] for x in many["labels"]] == [f"L{i}" for i in range(11)] + ["", "Late"]
    assert many["labels"][0]["timestamp"] is None and many["moderation_labels"] == [{"Name": "x"}]
    assert many["summary"]["has_moderation_issues"] is True and many["summary"]["total_labels"] == 13
    lines = {r.video_s3_key for r in spark.read.json(str(tmp_path / "a")).collect()}
    assert lines == {"two", "many", "none"}

    arrays = label_array(det, "job_id", "page", ["page", "pos"])
    names = {(r.job_id, r.page): [x.name for x in r.labels] for r in arrays.collect()}
    assert names[("two", 0)] == ["Person", "Outdoor"] and ("none", 0) not in names


def test_document_of_a_million_labels(spark, tmp_path):
    def label(i):
        return F.struct(
            F.concat(F.lit("L"), i.cast("string")).alias("name"), (i % 97).cast("double").alias("confidence"),
            (i / 2).alias("timestamp"), F.array().cast("array<variant>").alias("instances"),
        )

    pages = spark.range(1000, numPartitions=4).select(
        F.lit("v").alias("video"), F.col("id").alias("page"), F.lit(9.0).alias("duration"),
        F.transform(F.sequence(F.col("id") * 1000, F.col("id") * 1000 + 999), label).alias("labels"),
        F.array().cast("array<variant>").alias("moderation_labels"),
    )
    reduced = reduce_pages(pages, ["video", "page"], texts=True)
    parts = analysis_parts(reduced, summarize_reduced(reduced, "video", "page"), "video", "page")
    longest = parts.agg(F.max(F.length("text"))).first()[0]
    assert longest < 100_000  # a page, not a document
    write_analysis(parts, str(tmp_path / "a"))
    (doc,) = documents_at(tmp_path / "a")
    assert [x["name"] for x in doc["labels"]] == [f"L{i}" for i in range(1_000_000)]
    assert doc["summary"]["total_labels"] == 1_000_000
    assert [x["name"] for x in doc["summary"]["top_labels"]] == [f"L{96 + 97 * i}" for i in range(10)]


def test_top_k_matches_stable_sort(spark):
    rng = random.Random(7)
    rows = [(f"v{rng.randrange(4)}", i, float(rng.randrange(5)), f"n{rng.randrange(3)}") for i in range(400)]
    df = spark.createDataFrame(rows, "video string, pos bigint, confidence double, name string")
    got = {}
    for r in top_k(df, ["video"], "confidence", ["pos"], 10).orderBy("video", "rank").collect():
        got.setdefault(r.video, []).append(r.pos)
    for video in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == video), key=lambda r: r[2], reverse=True)
        assert got[video] == [r[1] for r in mine[:10]]
    distinct = top_k(df, ["video"], "confidence", ["pos"], 10, name="name")
    assert distinct.groupBy("video", "name").count().agg(F.max("count")).first()[0] == 1


def test_texts_of_a_page_keep_all_characters(spark):
    label = '{"Timestamp":1000,"Label":{"Name":"Grüße 🙂","Confidence":1.5,"Instances":[{"é":"中"}]}}'
    body = f'{{"JobStatus":"SUCCEEDED","Labels":[{label}],"ModerationLabels":["🙂"]}}'
    raw = spark.createDataFrame([("j", 0, body), ("k", 0, "{}")], "job_id string, page int, body string")
    rows = {r.job_id: r for r in reduce_pages(parse_responses(raw), ["job_id"], texts=True).collect()}
    assert rows["j"].labels == '{"name":"Grüße 🙂","confidence":1.5,"timestamp":1.0,"instances":[{"é":"中"}]}'
    assert rows["j"].moderation_labels == '"🙂"' and rows["k"].labels == rows["k"].moderation_labels == ""
