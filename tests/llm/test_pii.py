import re

import pytest

from framefold.llm.pii import KINDS, candidates, find_spans, redact, spans_by_document
from tests.llm.data import ROWS, empty, odd

# The patterns of the base.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base(text):
    spans = []
    for place, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((m.start(), place, kind, m.end()))
    return sorted(spans)


TEXTS = [
    "a@b.c_d@e.f and x@y. and @z.z and q@w..e",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.0003.255 1.2.3 999999999999999999999.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1112 and 4111 1111  1111",
    "+1 (202) 555-0147 +12 +1 2345678 9+49 30 1234567.8 +1((((2",
    "é🙂 Tel: +49 (30) 123-4567 é a@b.de🙂 10.0.0.1",
    "x" * 30000 + "@" + "y" * 30000,
    "7" * 30000,
    "+1" + " (" * 20000,
    "1.1.1.1 " * 700,
    "john (at) example (dot) org",
]


@pytest.fixture(scope="module")
def docs(spark):
    return odd(spark, ROWS + [(100 + i, t, "en", "s") for i, t in enumerate(TEXTS)])


def test_base_spans_are_those_of_the_plain_patterns(docs):
    got = spans_by_document(docs).collect()
    assert len(got) == len(ROWS) + len(TEXTS)
    by_id = {r.doc_id: r.spans for r in got if r.doc_id is not None}
    for doc_id, text in [(r[0], r[1]) for r in ROWS if r[0]] + [(100 + i, t) for i, t in enumerate(TEXTS)]:
        found = [(s.start, KINDS.index(s.kind), s.kind, s.end) for s in by_id[doc_id] if s.base]
        assert sorted(found) == base(text or ""), doc_id
        assert [s.start for s in by_id[doc_id]] == sorted(s.start for s in by_id[doc_id])


def test_generators_propose_more_than_the_base(docs):
    rows = candidates(docs).where("NOT accepted").collect()
    assert any(r.kind == "email" and r.start == 0 and r.end == len(TEXTS[-1]) for r in rows)


def test_redaction(spark):
    rows = [(1, "mail a@b.org or c@d.org!", "en", "s"), (2, "nothing", "en", "s"), (3, None, "en", "s"), (4, "", "en", "s")]
    out = redact(odd(spark, rows))
    assert out.schema == odd(spark).schema
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {1: ("mail [EMAIL] or [EMAIL]!", 24), 2: ("nothing", 7), 3: (None, 0), 4: ("", 0)}
    assert redact(empty(spark)).count() == 0 and find_spans(empty(spark)).count() == 0


def test_trees_add_spans_that_look_like_the_base(spark):
    good = [(i, f"please pay by card 4{i:03d} then {_card(i)} today", "en", "s") for i in range(400)]
    bad = [(1000 + i, f"item no {i:016d} in stock", "en", "s") for i in range(400)]
    typo = _card(7)[:-1] + str((int(_card(7)[-1]) + 1) % 10)
    docs = odd(spark, good + bad + [(5000, f"please pay by card 4007 then {typo} today", "en", "s")])
    spans = {r.doc_id: r.spans for r in spans_by_document(docs).collect()}
    added = [s for s in spans[5000] if not s.base]
    assert [(s.kind, s.end - s.start) for s in added] == [("card", 16)]
    assert not any(s for i in range(400) for s in spans[1000 + i] if not s.base)


def test_national_phones_and_obfuscated_addresses_are_added_in_clear_context(spark):
    rows = [(i, f"please call +49 30 {1234567 + i} today", "en", "s") for i in range(150)]
    rows += [(200 + i, f"contact: user{i}@mail.org today", "en", "s") for i in range(150)]
    rows += [(400 + i, f"item 030 {4567 + i} {1000 + i} in stock", "en", "s") for i in range(150)]
    rows += [(600 + i, f"please call 030 1234 {2000 + i} today", "en", "s") for i in range(150)]
    rows += [(800 + i, f"contact: user{i} (at) mail (dot) org today", "en", "s") for i in range(150)]
    spans = {r.doc_id: {s.kind for s in r.spans if not s.base} for r in spans_by_document(odd(spark, rows)).collect()}
    assert all("phone" in spans[600 + i] and "email" in spans[800 + i] for i in range(150))
    assert not any(spans[400 + i] for i in range(150))


def test_numbers_beside_words_that_only_contain_a_context_word_stay(spark):
    rows = [(i, f"host 10.0.{i}.7 is up", "en", "s") for i in range(150)]
    rows += [(200 + i, f"please call +49 30 {1234567 + i} today", "en", "s") for i in range(150)]
    rows += [(400 + i, f"recipe steps 1 2 3 {i} then stir", "en", "s") for i in range(150)]
    rows += [(600 + i, f"physically discard 030 {4567 + i} {1000 + i} pieces", "en", "s") for i in range(150)]
    rows += [(800 + i, f"item 1 2 3 {i} in stock", "en", "s") for i in range(150)]
    spans = {r.doc_id: r.spans for r in spans_by_document(odd(spark, rows)).collect()}
    assert all(spans[i] for i in range(150)) and not any(spans[400 + i] or spans[600 + i] for i in range(150))


def _card(i):
    body = f"4{i:05d}123456789"[:15]
    return next(body + str(d) for d in range(10) if luhn(body + str(d)))
