from hypothesis import given, settings
from hypothesis import strategies as st

from framefold.llm.line_quality import frequent_lines, quality_rules, repeated_words, without_lines, word_statistics
from tests.llm.data import ROWS, empty, odd


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=14))
def test_repeated_words_against_brute_force(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    assert repeated_words(words) == len(covered)


def test_word_statistics():
    assert word_statistics(None) == word_statistics("") == (0, 0, 0, 0, 0)
    assert word_statistics("é\u00a0#a b\n \nx\nx\nx") == (5, 8, 1, 2, 0)  # a no-break space ends no word
    assert word_statistics("x y z\tx y z") == (6, 6, 0, 0, 6)


def test_frequent_lines_deplete_documents(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"  # digits would be normalised away
    body = " ".join(f"{a}{b}" for a in letters[:6] for b in letters[:10])
    menu = "Home  | 12 News"
    rows = [(i, f"{menu}\n{letters[i]} {body} own", "en", "s") for i in range(6)]
    rows += [(10 + i, "\n".join([menu] * 30) + f"\nonly {letters[i]}", "en", "s") for i in range(6)]
    rows += [(30 + i, f"copied {body}", "en", "s") for i in range(6)]  # copies make no line frequent
    docs = odd(spark, rows)
    got = {r.doc_id: r for r in quality_rules(docs, documents=5, share=0.0).collect()}
    assert all(got[i].kept and got[i].lost_words == 4 for i in range(6))
    assert all(not got[10 + i].kept for i in range(6))
    assert all(got[30 + i].kept and got[30 + i].lost_words == 0 for i in range(6))
    cleaned = {r.doc_id: r.text for r in without_lines(docs, frequent_lines(docs, documents=5, share=0.0)).collect()}
    assert cleaned[0] == f"a {body} own" and cleaned[11] == "only b" and cleaned[30] == f"copied {body}"


def test_odd_documents(spark):
    rows = quality_rules(odd(spark)).collect()
    assert len(rows) == len(ROWS)
    assert [(r.doc_id, r.n_words) for r in rows if r.n_words > 50] == [(4, 36000)]
    assert not any(r.kept for r in rows)  # the long text repeats nearly all its windows
    assert quality_rules(empty(spark)).count() == 0
