import random
import subprocess
import sys

import numpy as np
import pytest

from framefold.llm import language, toxicity
from framefold.llm.crf import WORD, Model, expectations, train
from tests.llm.data import LONG, ROWS, empty, odd


@pytest.mark.parametrize("labels", [2, 4])
def test_forward_backward_against_plain_recursions(labels):
    rng = np.random.default_rng(labels)
    n = 230
    emit, step, start = rng.normal(size=(n, labels)) * 3, rng.normal(size=(labels, labels)), rng.normal(size=labels)
    first = rng.random(n) < 0.06
    first[0] = True
    posterior, pairs = expectations(emit, step, start, first, pairs=True)
    begins = [*np.flatnonzero(first), n]
    want = np.zeros((labels, labels))
    for s, e in zip(begins, begins[1:]):
        alpha, beta = [start + emit[s]], [np.zeros(labels)]
        for t in range(s + 1, e):
            alpha.append(np.logaddexp.reduce(alpha[-1][:, None] + step, axis=0) + emit[t])
        for t in range(e - 1, s, -1):
            beta.insert(0, np.logaddexp.reduce(step + emit[t] + beta[0], axis=1))
        total = np.logaddexp.reduce(alpha[-1])
        assert np.allclose(posterior[s:e], np.exp(np.array(alpha) + np.array(beta) - total))
        for t in range(s + 1, e):
            want += np.exp(alpha[t - s - 1][:, None] + step + emit[t] + beta[t - s] - total)
    assert np.allclose(pairs, want)
    assert expectations(emit[:0], step, start, first[:0])[0].shape == (0, labels)


def test_training_learns_words_and_transitions():
    words = (["a"] * 5 + ["b"] * 5) * 40
    tags = np.array(([0] * 5 + [1] * 5) * 40)
    first = np.zeros(400, dtype=bool)
    first[::20] = True
    model = train(["x", "y"], words, tags, first, lambda w: ["w" + w], rounds=40)
    scores = model.scores(["a", "b"], lambda w: ["w" + w])
    assert scores.argmax(axis=1).tolist() == [0, 1]
    assert model.transition[0, 0] > model.transition[0, 1] and model.transition[1, 1] > model.transition[1, 0]


def texts(rng, n, bad):
    good = [a + b for a in ("mor", "tal", "ven", "sil") for b in ("a", "en", "ing", "u", "os")]
    out = []
    for i in range(n):
        words = [rng.choice(good) for _ in range(30)]
        if i % 3 == 0:
            words[rng.randrange(30)] = rng.choice(bad)
        out.append((" ".join(words), int(i % 3 == 0)))
    return out


def test_toxic_words_their_affixes_and_offsets(spark):
    rng = random.Random(5)
    model = toxicity.fit(texts(rng, 240, ["Scoundrel", "fiendish", "fiendful", "fiendly"]))
    check = [(f"mora é {w} silu", y) for w, y in (("scoundrel", 1), ("fiendlike", 1), ("venos", 0), ("talu", 0))]
    rows = [(i, t, "en", "s") for i, (t, _) in enumerate(check)]
    got = {r.doc_id: r for r in toxicity.score_documents(odd(spark, rows), model).collect()}
    for i in (0, 2, 3):
        text, label = check[i]
        assert got[i].predicted == label and 0 <= got[i].score <= 1
        assert [text[s.start : s.end] for s in got[i].spans] == ([text.split()[2]] if label else [])
    # An unseen inflection of a toxic stem ranks above clean words; on so few documents it stays below one half.
    assert got[1].score > max(got[2].score, got[3].score)


def test_toxicity_of_odd_documents(spark):
    model = toxicity.fit(texts(random.Random(1), 60, ["scoundrel"]))
    rows = toxicity.score_documents(odd(spark), model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_documents(empty(spark), model).count() == 0
    nothing = toxicity.fit([])
    assert all(0 <= r.score <= 1 for r in toxicity.score_documents(odd(spark), nothing).collect())


def test_toxic_training_rows_leave_the_held_out_fold(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(40)] + [(None, "t")], "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(40)] + [(3, None), (None, 1)], "doc_id bigint, toxic int"
    )
    rows = toxicity.training_rows(docs, labels)
    from framefold.llm.common import id_remainder_of

    assert sorted(rows) == sorted((f"t{i}", i % 2) for i in range(40) if id_remainder_of(i, 5) != 0)
    assert len(toxicity.training_rows(docs, labels, (3, 2))) == 5


SAMPLES = {
    "en": "the house was near the river and nobody thought that they would leave",
    "de": "das haus war nicht weit vom fluss und niemand dachte dass sie gehen würden",
}


def fitted():
    rng = random.Random(2)
    rows = [(" ".join(rng.sample(t.split(), 9)), lang) for _ in range(60) for lang, t in SAMPLES.items()]
    return language.fit(rows)


def test_languages_of_documents_and_words(spark):
    model = fitted()
    rows = [(1, "the river thought nobody", "de", "s"), (2, "niemand würde fluss haus", "en", "s"), (3, "12 !", "en", "s")]
    got = {r.doc_id: r for r in language.identify(odd(spark, rows), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["en", "de", "und"]
    mixed = "the house was near the river das haus war nicht weit vom fluss"
    spans = language.word_spans(mixed, model)
    assert [lang for _, _, lang in spans] == ["en", "de"] and mixed[spans[1][0] :].startswith("das")


def test_language_of_odd_documents(spark):
    model = fitted()
    got = language.identify(odd(spark), model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    wordless = [r for r in got if r.lang_pred == "und"]
    assert {r.doc_id for r in wordless} == {1, 2, 3, None, 7} and all(r.score == 0 for r in wordless)
    kept = language.keep_known(odd(spark), model, 0.0)
    assert kept.schema == odd(spark).schema
    assert kept.count() == sum(bool(r[1] and WORD.search(r[1])) for r in ROWS)
    assert language.identify(empty(spark), model).count() == 0 == language.keep_known(empty(spark), model).count()
    unlearned = language.fit([])
    assert {r.lang_pred for r in language.identify(odd(spark), unlearned).collect()} == {"und"}
    assert language.keep_known(odd(spark), unlearned).count() == kept.count()


def test_very_long_text_is_read_to_its_end():
    model = toxicity.fit(texts(random.Random(1), 60, ["scoundrel"]))
    from framefold.llm.crf import Decoder

    (_, counts, posterior), *_ = Decoder(model, toxicity.features).decode([LONG + " scoundrel"])
    assert counts.tolist() == [len(WORD.findall(LONG)) + 1] and posterior[-1, 1] > 0.5
    assert isinstance(model, Model)


def test_pieces_and_short_chains_change_nothing(monkeypatch):
    from framefold.llm import crf

    model = fitted()
    rng = random.Random(8)
    docs = [" ".join(rng.choice(SAMPLES["en"].split() + SAMPLES["de"].split()) + "x" * rng.randrange(3) for _ in range(40)) for _ in range(9)]
    whole = np.concatenate([p for _, _, p in crf.Decoder(model, language.features).decode(docs)])
    for name, value in (("SCORED_WORDS", 7), ("CHAIN_WORDS", 90), ("KNOWN_LETTERS", 200)):
        monkeypatch.setattr(crf, name, value)
    parts = list(crf.Decoder(model, language.features).decode(docs))
    assert len(parts) > 3 and np.allclose(np.concatenate([p for _, _, p in parts]), whole)


def test_memory_of_many_new_words():
    """Scoring 400,000 different words takes less than 300 MB beside the model."""
    code = (
        "import resource, numpy as np\n"
        "from framefold.llm import crf, language\n"
        "size = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1000\n"
        "model = crf.Model(['a', 'b', 'c', 'd'], np.zeros((crf.BUCKETS, 4), np.float32), np.zeros((4, 4)), np.zeros(4))\n"
        "text = ' '.join('word' + ''.join(chr(97 + int(d)) for d in str(i)) for i in range(400_000))\n"
        "before = size()\n"
        "n = sum(int(c.sum()) for _, c, _ in crf.Decoder(model, language.features).decode(text.split()))\n"
        "print(n, size() - before)\n"
    )
    n, more = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert int(n) == 400_000 and float(more) < 300


def test_every_language_is_learned_and_repeated_ids_count_once(spark):
    rows = [(i, f"text {i}", f"l{i % 70:02d}", "s") for i in range(700)]
    rows += [(2, f"text 2 again {n}", "l02", "s") for n in range(500)]
    found = language.training_rows(odd(spark, rows), sample=4)
    assert {lang for _, lang in found} == {f"l{i:02d}" for i in range(70)}
    assert all(sum(x == lang for _, x in found) <= 4 for lang in ("l02", "l69"))
    labels = spark.createDataFrame([(i, 1) for i in range(700)], "doc_id bigint, toxic int")
    texts_of_2 = [t for t, _ in toxicity.training_rows(odd(spark, rows), labels) if t.startswith("text 2 ") or t == "text 2"]
    assert len(texts_of_2) <= 1


def test_language_features_of_many_words_are_those_of_each_word(monkeypatch):
    from framefold.llm import crf

    rng = random.Random(4)
    letters = "abcdeABCDEßéИσΣİ語語𐐀𠀀ａ"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 12))) for _ in range(3000)]
    words += ["aaaaaaaa", "abababab", "ΑΣ", "x", "語", "", "b" * 300, "".join(rng.choice(letters) for _ in range(120))]
    plain = crf.feature_ids(words, lambda w: language.features(w))
    for together in (1 << 18, 40, 7, 1):
        monkeypatch.setattr(language, "LETTERS_TOGETHER", together)
        for some in (words, words[::-1]):
            want = plain if some is words else crf.feature_ids(some, lambda w: language.features(w))
            got = crf.feature_ids(some, language.features)
            assert np.array_equal(got[0], want[0]) and np.array_equal(got[1], want[1])
    assert [len(x) for x in crf.feature_ids([], language.features)] == [0, 0]
    assert crf.feature_ids(["", ""], language.features)[1].tolist() == [2, 2]


def test_equal_letter_groups_of_many_words_are_hashed_once(monkeypatch):
    from framefold.llm import crf

    rng = random.Random(6)
    words = list(dict.fromkeys("".join(rng.choice("aeinrst") for _ in range(9)) for _ in range(4000)))
    calls = []
    crc32 = crf.zlib.crc32
    monkeypatch.setattr(crf.zlib, "crc32", lambda *given: calls.append(1) or crc32(*given))
    ids, _ = crf.feature_ids(words, language.features)
    assert len(calls) < 2 * len(words) < len(ids) / 5
