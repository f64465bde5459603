import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from framefold.llm.common import QUERIES
from framefold.llm import queries, simhash_dedup
from tests.llm.data import odd

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_every_operator_has_a_query():
    names = queries.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert names.keys() == QUERIES.keys()


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = corpus_pipeline.documents(spark, SMALL)
    columns = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.land(stage(spark, docs, SMALL), name)
        if name == "packing":
            break
        assert docs.columns == columns
        rows = docs.collect()
        ids = Counter(r.doc_id for r in rows)
        if name == "language_id":
            assert all(before[i] for i in ids) and len(ids) > 0.9 * len(before)
        if name == "simhash_near_dedup":
            texts = Counter(r.text for r in rows)
            assert max(texts.values()) == 1 and max(ids.values()) == 1
        if name == "pii":
            assert not any("@mail" in r.text for r in rows) and any("[EMAIL]" in r.text for r in rows)
            redacted = {r.doc_id: r.text for r in rows}
        if name == "mixing":
            assert set(ids) < set(redacted) or set(ids) == set(redacted)
            whole = sum(r.text == redacted[r.doc_id] for r in rows)
            assert whole > 0.8 * len(rows)
            words = Counter()
            for r in rows:
                words[r.doc_id] += len(WORD.findall(r.text))
            assert all(n <= 2 * len(WORD.findall(redacted[i])) for i, n in words.items())
    places = docs.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert max(r[1] for r in places) <= 2048
    assert docs.where("piece = 0").count() == sum(ids.values())


def test_stages_take_odd_documents(spark):
    docs = odd(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.land(stage(spark, docs, SMALL), name)
    assert docs.count() > 0
    none = odd(spark).select("doc_id", "text", "lang", "source", "n_chars").where("false")
    for name, stage in corpus_pipeline.STAGES:
        none = corpus_pipeline.land(stage(spark, none, SMALL), name)
    assert none.count() == 0


def test_stages_keep_columns_of_clashing_names(spark):
    names = ["_row", "_doc", "_h", "_id", "_hash", "_spans", "_new", "_src", "_size", "_nth", "_copy", "_cut", "_text", "text_key"]
    docs = odd(spark).select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(n).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.land(stage(spark, docs, SMALL), name)
        assert docs.columns[5:] == names
    assert all(r[n] == n for r in docs.collect() for n in names)


def test_near_dedup_stage_does_not_broadcast_visits(spark, monkeypatch):
    """They are some 60 times as many rows as Spark takes them for."""
    plans, connect = [], simhash_dedup.connected_components

    def seen(edges):
        plans.append(edges._jdf.queryExecution().executedPlan().toString())
        return connect(edges)

    monkeypatch.setattr(simhash_dedup, "connected_components", seen)
    corpus_pipeline.drop_near_duplicates(spark, odd(spark), "")
    joins = re.findall(r"(\w+Join) \[anchor#\d+\], \[anchor#\d+\], Inner", plans[0])
    assert joins and set(joins) == {"SortMergeJoin"}
