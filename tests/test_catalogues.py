import json

from framefold.operators.sets import union_sources
from framefold.sources.catalogues import (
    read_catalogue_a,
    read_catalogue_b,
    scan_catalogue_a,
    scan_catalogue_b,
    select_sources,
)


def page(title, mime="video/mp4", size=10, cats=("Category:CC0",), **over):
    info = {
        "url": f"https://example.com/{title}",
        "size": size,
        "mime": mime,
        "extmetadata": {"Artist": {"value": "ann"}, "License": {"value": "CC0"}},
    }
    out = {"title": title, "imageinfo": [info], "categories": [{"title": c} for c in cats]}
    out.update(over)
    return {k: v for k, v in out.items() if v is not None}


def landed(spark, *docs):
    rows = [("nature", i, json.dumps(d) if d is not None else None) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "campaign string, response bigint, body string")


def test_catalogue_a_keeps_licensed_media(spark):
    pages = {
        "12345": page("File:Test_Video.mp4", size=1024000, cats=("Category:CC-BY-4.0",)),
        "67890": page("File:Another_Video.webm", "video/webm", 512000),
        "1": page("png", "image/png"),
        "2": page("noinfo", imageinfo=None),
        "3": page("emptyinfo", imageinfo=[]),
        "4": page("nocats", categories=None),
        "5": page("othercat", cats=("Category:Other",)),
        "6": page("nomime", imageinfo=[{"url": "u"}]),
    }
    raw = landed(spark, {"query": {"pages": pages}}, {"batchcomplete": ""}, {"query": {}}, None)
    assert scan_catalogue_a(raw).count() == 8
    got = read_catalogue_a(raw).orderBy("pos").collect()
    assert [(r.source, r.source_id, r.title, r["size"], r.mime) for r in got] == [
        ("wikimedia", "File:Test_Video.mp4", "File:Test_Video.mp4", 1024000, "video/mp4"),
        ("wikimedia", "File:Another_Video.webm", "File:Another_Video.webm", 512000, "video/webm"),
    ]
    assert (got[0].author, got[0].license, got[0].description, got[0].duration) == (
        "ann",
        "CC0",
        "",
        None,
    )
    assert [r.source_id for r in read_catalogue_a(raw, 1).collect()] == ["File:Test_Video.mp4"]


def hit(i, **over):
    out = {
        "id": i,
        "tags": f"tag{i}",
        "user": "bob",
        "duration": 12,
        "videos": {"medium": {"url": f"m{i}", "size": 5}, "small": {"url": f"s{i}", "size": 3}},
    }
    out.update(over)
    return {k: v for k, v in out.items() if v is not None}


def test_catalogue_b_rendition_and_limit_before_filter(spark):
    hits = [
        hit(1),
        hit(2, videos={"small": {"url": "s2", "size": 3}, "large": {"url": "l2", "size": 9}}),
        hit(3, videos={"large": {"url": "l3", "size": 9}}),
        hit(4, videos={"medium": {"url": "", "size": 5}, "small": {"url": "s4", "size": 3}}),
        hit(5, videos=None),
        hit(6, tags=None, user=None, duration=None, videos={"medium": {"url": "m6"}}),
    ]
    raw = landed(spark, {"hits": hits}, {"total": 0})
    assert scan_catalogue_b(raw).count() == 6
    got = read_catalogue_b(raw).orderBy("pos").collect()
    assert [(r.source_id, r.url, r["size"]) for r in got] == [
        ("1", "m1", 5),
        ("2", "s2", 3),
        ("3", "l3", 9),
        ("6", "m6", 0),
    ]
    assert (got[3].title, got[3].description, got[3].author, got[3].duration) == (
        "nature",
        "",
        "",
        0.0,
    )
    # the limit counts hits that are dropped afterwards
    assert [r.source_id for r in read_catalogue_b(raw, 5).orderBy("pos").collect()] == ["1", "2", "3"]


def test_union_and_source_choice(spark):
    raw_a = landed(spark, {"query": {"pages": {"1": page("a")}}})
    raw_b = landed(spark, {"hits": [hit(1)]})
    both = union_sources([read_catalogue_a(raw_a), read_catalogue_b(raw_b)])
    assert sorted(r.source for r in both.collect()) == ["pixabay", "wikimedia"]

    def names(*args):
        return [s.name for s in select_sources(*args)]

    assert names(None, {"catalogue_b_key"}) == ["wikimedia", "pixabay"]
    assert names("WikiMedia") == ["wikimedia"]
    assert names("nosuch", {"catalogue_b_key"}) == ["wikimedia", "pixabay"]
    assert names(None) == ["wikimedia"]
    assert names("pixabay") == []
