import json
import random

from pyspark.sql import functions as F

from framefold.functions import documents as J
from framefold.functions import keys as K
from framefold.functions import text as X
from framefold.functions import times as T
from framefold.sources.sinks import notifications


def test_titles_ext_and_processed_keys_match_plain_python(spark):
    rng = random.Random(5)
    alphabet = list("aZ9 _-.:/éß漢½File:mp4webm\n\t") + ["File:", ".mp4", ".webm", "media-raw"]
    rows = [
        tuple("".join(rng.choice(alphabet) for _ in range(rng.randrange(160))) for _ in range(3))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "title string, mime string, url string")
    got = df.select(
        "title",
        "mime",
        "url",
        X.safe_title("title").alias("safe"),
        X.infer_ext("mime", "url").alias("ext"),
        K.processed_key("title").alias("done"),
    ).collect()
    for r in got:
        t = r.title.replace("File:", "").replace(" ", "_")
        assert r.safe == "".join(c for c in t if c.isalnum() or c in "_-.")[:100]
        ext = "webm" if "webm" in r.mime + "\0" + r.url else "mp4"
        assert r.ext == ("mp4" if "mp4" in r.mime + "\0" + r.url else ext)
        want = r.title.replace("media-raw", "media-processed")
        assert r.done == want.replace(".mp4", "_labels.json").replace(".webm", "_labels.json")


def test_keys(spark):
    row = spark.range(1).select(
        K.raw_key(
            F.lit("wikimedia"), F.lit("id1"), F.lit("File:A b.mp4"), F.lit("nature"),
            F.lit("20240101_120000"), F.lit("video/mp4"), F.lit("u"),
        ).alias("key"),
        K.raw_key(
            F.lit("s"), F.lit(None).cast("string"), F.lit("t"), F.lit("c"), F.lit("ts"), F.lit("x"), F.lit("y.webm")
        ).alias("bare"),
        K.record_id(F.lit("video"), F.lit("nature"), F.lit("20240101_120000")).alias("id"),
        K.execution_id(F.lit("arn:aws:execution:x:run-1")).alias("run"),
    ).first()
    assert row["key"] == "media-raw/video/wikimedia/nature/20240101_120000/wikimedia_id1_A_b.mp4.mp4"
    assert row.bare == "media-raw/video/s/c/ts/s_t.webm"
    assert row.id == "video#nature#20240101120000" and row.run == "run-1"
    keys = spark.createDataFrame(
        [("media-raw/video/wikimedia/nature/20240101_120000/t.mp4",), ("media-raw/video/nature/2024/t.mp4",), ("one",)],
        "k string",
    )
    got = [tuple(r)[1:] for r in K.parse_key(keys, "k").collect()]
    assert got == [
        ("wikimedia", "nature", "20240101_120000", "t.mp4"),
        ("nature", "2024", "2024", "t.mp4"),
        (None, None, "", "one"),
    ]


def test_text_and_time_helpers(spark):
    row = spark.range(1).select(
        X.case_fold(F.lit("hELLO wORLD"), "capitalise").alias("cap"),
        X.normalize_campaign(F.lit("\t NaTure "), F.lit("tech")).alias("typed"),
        X.normalize_campaign(F.lit(" \n"), F.lit("tech")).alias("picked"),
        X.segment(F.lit("a.b.c"), ".", -2).alias("seg"),
        X.segment(F.lit("a.b.c"), ".", 9).alias("none"),
        X.default_if_empty(F.lit(""), "d").alias("dflt"),
        X.to_int(F.lit("x1")).alias("bad"),
        T.iso_ts(F.lit("2024-01-01 12:00:00").cast("timestamp")).alias("whole"),
        T.iso_ts(F.lit("2024-01-01 12:00:00.5").cast("timestamp")).alias("part"),
        T.ms_to_sec(F.lit(0)).alias("zero"),
        T.quota(F.lit(3), 2).alias("q3"),
        T.quota(F.lit(1), 2).alias("q1"),
        T.clamp(F.lit(50), 3, 20).alias("cl"),
        F.unix_millis(T.event_time(F.lit(1700000000.25))).alias("s"),
        F.unix_millis(T.event_time(F.lit(1700000000250))).alias("ms"),
        T.batch_ts(F.lit("2024-01-01")).alias("nobatch"),
    ).first()
    assert row.cap == "Hello world" and row.typed == "nature" and row.picked == "tech"
    assert (row.seg, row.none, row.dflt, row.bad) == ("b", None, "d", None)
    assert row.whole == "2024-01-01T12:00:00+00:00" and row.part == "2024-01-01T12:00:00.500000+00:00"
    assert (row.zero, row.q3, row.q1, row.cl, row.s, row.ms) == (None, 1, 1, 20, 1700000000250, 1700000000250)
    assert row.nobatch is None


def test_documents(spark):
    texts = ['{"a":1}', "{}", "[]", "0", "0.0", "null", '""', "false", "", None, "oops", '"x"', "[0]", "5", '"0"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.orderBy("i").select(J.is_truthy_json("t").alias("b"), F.to_json(J.json_or_empty("t")).alias("v")).collect()

    def truthy(t):
        try:
            return bool(json.loads(t)) if t else False
        except ValueError:
            return True

    assert [r.b for r in got] == [truthy(t) for t in texts]
    assert got[10].v == "{}" and got[9].v == "{}" and got[0].v == '{"a":1}'
    pairs = spark.range(1).select(J.canonical_json(F.create_map(F.lit("b"), F.lit(2), F.lit("a"), F.lit(1))).alias("j"))
    assert pairs.first().j == '{"a":1,"b":2}'


def test_notifications(spark):
    df = spark.createDataFrame(
        [("video", "nature", "SUCCEEDED", "arn:x", None), ("video", "tech", "FAILED", None, "Test error")],
        "pipeline_type string, campaign string, status string, execution_arn string, error string",
    )
    ok, bad = notifications(df).collect()
    assert ok.subject == "Media Pipeline VIDEO: SUCCEEDED"
    assert json.loads(ok.message) == {
        "pipeline_type": "video", "campaign": "nature", "status": "SUCCEEDED", "execution_arn": "arn:x",
    }
    assert json.loads(bad.message)["error"] == "Test error" and json.loads(bad.message)["execution_arn"] is None
