"""Documents with nulls, empty and very long texts, ties, repeated rows and columns of clashing names."""

from __future__ import annotations

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, shard int, slot int, "
    "word string, fp bigint, root bigint, score double, spans string, kind string, base boolean, text_key string, "
    "length int, piece string, taken int, line string, host string, words int, full int, part int"
)

LONG = " ".join(f"word{i % 977} is, number {i}." for i in range(9000))
ROWS = [
    (1, None, "en", "s1"),
    (2, "", "en", "s1"),
    (3, " \n\t ", None, "s2"),
    (4, LONG, "en", "s1"),
    (5, "hello world again", "en", None),
    (5, "hello world again", "en", None),
    (6, "hello world again", "de", "s2"),
    (None, "a text without an id", "en", "s2"),
    (None, None, None, None),
    (7, "12345 !!! 🙂", "en", "s2"),
    (8, "Grüße aus Köln, mail a.b@example.org or +1 (202) 555-0147", "de", "s3"),
]


def odd(spark, rows=ROWS):
    return spark.createDataFrame(
        [(*r, len(r[1] or ""), 1, 2, 3, "w", 4, 5, 0.5, "x", "k", True, "t", 6, "p", 7, "l", "h", 8, 9, 10) for r in rows],
        SCHEMA,
    )


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
