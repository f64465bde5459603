"""Physical plans: what must be pruned, pre-reduced or shuffled once."""

import os
import re

import pytest

from framefold.operators import history as H
from framefold.operators import joins as J
from framefold.operators.detections import analysis_parts, reduce_pages, summarize_reduced, top_labels
from framefold.operators.ranking import latest, quota_limit
from framefold.plans import lake_queries, media_queries  # noqa: F401
from framefold.plans import views as V
from framefold.plans.registry import QUERIES
from framefold.session import START_PARTITIONS, shuffles_freed
from framefold.sources.detections import land_pages, parse_responses
from framefold.sources.executions import land_history

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranking_limits_before_the_shuffle(spark):
    cand = V.candidates(spark, SF).select("campaign", "source", "pos")
    for df in (
        quota_limit(cand, 3, ["campaign"], ["pos"]),
        latest(cand, ["campaign"], ["pos"]),
        top_labels(V.detections(spark, SF), "video", V.DET_ORDER, 3),
    ):
        text = plan(df)
        assert "Partial" in text and text.count("WindowGroupLimit") == 2


def test_no_product_joins_and_pruned_scans(spark):
    kept = J.drop_indexed(
        V.candidates(spark, SF).select("media_type", "campaign", "source", "source_id", "pos"),
        V.index_rows(spark, SF),
    )
    text = plan(kept)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in text
    assert "EqualTo(quality,1)" in text


def test_events_of_a_timeline_are_read_and_shuffled_once(spark, tmp_path):
    events = land_history(V.history(spark, SF), str(tmp_path / "h"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan(H.steps(events)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum("FileScan" in line for line in lines) == 1 and not any("Join" in line for line in lines)
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2  # raw events by segment, then summaries by execution
    assert any("Aggregate" in line for line in lines[exchanges[0] : exchanges[1]])


def test_a_session_with_few_partitions_starts_shuffles_with_many(spark):
    """The rows of one task of a join do not grow with the input at a session's few partitions."""
    few = spark.newSession()
    few.conf.set("spark.sql.shuffle.partitions", "4")
    few.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def partitions():
        text = plan(QUERIES["join_responses"](few, SF))
        return {int(n) for n in re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\)", text)}

    assert partitions() == {START_PARTITIONS}
    few.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "7")  # the session's own number holds
    assert partitions() == {7}


def test_columns_of_a_video_are_made_once_not_for_each_label(spark):
    lines = plan(QUERIES["write_analysis"](spark, SF)).splitlines()
    explode = next(i for i, line in enumerate(lines) if "posexplode" in line)
    assert [i > explode for i, line in enumerate(lines) if "array_join" in line] == [True]


def test_a_page_is_shuffled_once_for_its_document_and_written_packed(spark, tmp_path):
    """Only pages and summaries are shuffled, not the texts made of them; documents are compressed."""
    pages = reduce_pages(parse_responses(V.response_pages(spark, SF)), ["job_id", "page"], texts=True)
    reduced = land_pages(pages, str(tmp_path / "pages"))
    made = summarize_reduced(reduced, "job_id", "page")
    landed = land_pages(made, str(tmp_path / "summaries"))
    for summaries, shuffles in ((made, 1), (landed, 2)):  # made summaries are spread by their video already
        lines = plan(analysis_parts(reduced, summaries, "job_id", "page")).splitlines()
        union = next(i for i, line in enumerate(lines) if "Union" in line)
        explode = next(i for i, line in enumerate(lines) if "Generate inline" in line and "moderation_labels" in line)
        spread = [i for i, line in enumerate(lines) if "REPARTITION_BY_COL" in line]
        assert not any("Exchange" in line for line in lines[:union]) and len(spread) == shuffles and spread[-1] > explode
    documents = QUERIES["write_analysis"](spark, SF).inputFiles()
    assert documents and all(f.endswith(".txt.gz") for f in documents)


def test_shuffles_of_what_is_written_are_freed(spark, tmp_path):
    """Their files go when the write ends; the session's setting is as before."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f for f in map(str, folder.getAllFiles().mkString(",").split(",")) if "shuffle_" in f and f.endswith(".data")}

    old = files()
    with shuffles_freed(spark):
        spark.range(1000).repartition("id").write.parquet(str(tmp_path / "a"))
    assert files() <= old and spark.conf.get(key) == before
