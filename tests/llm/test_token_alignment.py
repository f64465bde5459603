import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from framefold.llm import token_alignment
from framefold.llm.packing import _byte_of_symbol
from framefold.llm.token_alignment import align_documents, default_tokenizers, from_planes, op12, planes, tokenizer_pair
from tests.llm.data import ROWS, empty, odd

TRICKY = [
    "a", " ", "  two  spaces ", "x<|endoftext|>y </s><s><unk> <0x0A>", "mark ▁ here", "Grüße 🙂🙂 中文字符 é́", "\x00\x01 \t\n\r",
    "don't I'LL 1 234,5", "tail\n\n\n", " nbsp ​", "ﬁ ½ Ⅷ", "a" * 3000, "🙂" * 500,
]


def plain_tokens():
    byte_level, piece_model = default_tokenizers()
    exact = Tokenizer.from_file(byte_level)
    exact.encode_special_tokens = True
    symbol = _byte_of_symbol()
    pieces = sentencepiece.SentencePieceProcessor(model_file=piece_model)

    def both(text):
        if not text:
            return [], []
        a = exact.encode(" " + text, add_special_tokens=False).ids
        a = [(i, bytes(symbol[c] for c in exact.id_to_token(i))) for i in a]
        b = []
        for i in pieces.encode(text):
            p = pieces.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else ([], [])

    return both


def plain_results(rows):
    """Every shared end of every text by the ends of all tokens, and counts over all texts."""
    both = plain_tokens()
    found, count = [], Counter()
    for doc_id, text, *_ in rows:
        a, b = both(text)
        ends_a, ends_b = np.cumsum([len(x) for _, x in a]).tolist(), np.cumsum([len(x) for _, x in b]).tolist()
        place_a, place_b = ({end: k for k, end in enumerate(ends)} for ends in (ends_a, ends_b))
        groups, links = [], []
        low_a = low_b = 0
        for end in sorted(set(ends_a) & set(ends_b)):
            k, m = place_a[end], place_b[end]
            groups.append(",".join(str(i) for i, _ in a[low_a : k + 1]) + "|" + ",".join(str(i) for i, _ in b[low_b : m + 1]))
            links.append((a[k][0], b[m][0]))
            low_a, low_b = k + 1, m + 1
        count.update(links)
        found.append((doc_id, len(a), len(b), ";".join(groups), links))
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [
        (
            doc_id, n_a, n_b, len(links), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
            hashlib.sha256(groups.encode()).hexdigest() if links else "",
        )
        for doc_id, n_a, n_b, groups, links in found
    ]


def odd_rows():
    rng = random.Random(12)
    letters = "abcdefg   .,-'\n\té🙂1<"
    made = [(100 + i, t, "en", "s") for i, t in enumerate(TRICKY)]
    made += [(200 + i, "".join(rng.choice(letters) for _ in range(rng.randint(1, 200))), "en", "s") for i in range(150)]
    return ROWS + made


@pytest.mark.parametrize("bounds", [(200_000, 20_000, 300_000), (50, 7, 20)])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, bounds):
    """Also with chunks of a few texts, small pieces and a memo that is often emptied."""
    for name, value in zip(("CHUNK_PAIRS", "CHUNK_TEXTS", "MEMO"), bounds):
        monkeypatch.setattr(token_alignment, name, value)
    monkeypatch.setattr(token_alignment, "PIECE_BYTES", 400 if bounds[0] == 50 else 1 << 20)
    rows = odd_rows()
    odd(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in op12(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted(plain_results(rows), key=repr)
    assert sum(r[1] == 0 for r in got) == 4  # two nulls, one empty text, one that holds the space mark


def test_windows_spell_both_token_sequences():
    pair = tokenizer_pair(*default_tokenizers())
    for _, text, *_ in odd_rows():
        (a,), (b,) = pair.encode([text or ""])
        windows = [pair.unpacked(w) for w in pair.windows(np.array(a, np.int64), np.array(b, np.int64)).to_pylist()]
        assert [i for w, _ in windows for i in w] == a and [i for _, w in windows for i in w] == b
        for mine, yours in windows:
            assert b"".join(pair.bytes_a[i] for i in mine) == b"".join(pair.bytes_b[i] for i in yours)
        if a:
            assert all(pair.spaced_a[w[0]] and pair.spaced_b[v[0]] for w, v in windows)


def test_groups_are_returned_as_text(spark):
    rows = {r.doc_id: r for r in align_documents(odd(spark), *default_tokenizers()).where("n_a is not null").collect()}
    assert rows[5].groups.count(";") + 1 == rows[5].n_groups == rows[5].n_links > 0
    assert rows[1].groups == rows[2].groups == "" and rows[1].n_a == rows[1].n_b == 0
    assert align_documents(empty(spark), *default_tokenizers()).count() == 0


def test_planes_round_trip():
    values = np.array([0, 1, 255, 256, 70_000, 2**32 - 1])
    assert from_planes(planes(values)).tolist() == values.tolist() and from_planes(planes(values[:0])).tolist() == []


def test_anchors_of_a_piece_are_found_once(monkeypatch):
    pair, calls = tokenizer_pair(*default_tokenizers()), []
    anchors = pair.anchors
    monkeypatch.setattr(pair, "anchors", lambda a, b: calls.append(1) or anchors(a, b))
    groups, sizes, links = pair.aligned(*pair.encode(["two words", "", "tail"]))
    assert len(groups) == len(sizes) == 3 and sum(sizes) == len(links) > 0 and calls == [1]


def test_windows_of_a_piece_are_aligned_together(monkeypatch):
    """One call for all new windows of a piece, or for as many as ``MEMO`` allows, with the same results."""
    pair, calls = tokenizer_pair(*default_tokenizers()), []
    align = pair.align
    monkeypatch.setattr(pair, "align", lambda *x: calls.append(1) or align(*x))
    encoded = pair.encode(["unlikely words meet words", "", "don't I'LL 1 234,5", "🙂🙂 tail\n"])
    groups, sizes, links = pair.aligned(*encoded)
    assert len(calls) == 1 and [g.as_py().count(";") + bool(g.as_py()) for g in groups] == sizes.tolist()
    monkeypatch.setattr(token_alignment, "MEMO", 3)
    again = pair.aligned(*encoded)
    assert len(calls) > 2 and again[0].equals(groups)
    assert again[1].tolist() == sizes.tolist() and again[2].tolist() == links.tolist()
    assert [len(x) for x in pair.aligned(*pair.encode(["", ""]))] == [2, 2, 0]
