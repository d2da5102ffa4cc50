import itertools
import math
import random

import numpy as np
import pytest

from gridpulse.llm import langid, quality
from gridpulse.llm.common import ship

LANGS = {"en": "the of and to in that was with for on".split(), "de": "der die und das ist nicht für mit ein zu".split()}


def make_text(lang, rng, n):
    return " ".join(rng.choice(LANGS[lang]) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def docs(frames):
    rng = random.Random(0)
    rows = [(i, make_text(lang, rng, 30), lang, "s") for i, lang in enumerate(["en", "de"] * 60)]
    return frames.docs(rows, extra=True)


@pytest.fixture(scope="module")
def model(spark, docs):
    ship(spark)
    return langid.fit(docs.select("doc_id", "lang", "text").withColumnRenamed("doc_id", "id"), rounds=2)


def test_forward_sums_all_segmentations():
    pieces = ["a", "ab", "b", "ba", langid.END, "b" + langid.END]
    p = np.array([[0.01], [0.3], [0.2], [0.1], [0.15], [0.05], [0.2]])
    numbers = {x: i + 1 for i, x in enumerate(pieces)}
    for letters in itertools.product("abc", repeat=4):
        word = "".join(letters) + langid.END

        def total(rest):
            if not rest:
                return 1.0
            out = sum(p[numbers[rest[:k]], 0] * total(rest[k:]) for k in range(1, min(2, len(rest)) + 1) if rest[:k] in numbers)
            return out + (p[0, 0] * total(rest[1:]) if rest[0] not in numbers else 0)

        found = langid.Lattice([word], langid.PieceTable(pieces)).likelihood(np.vstack([p, [[0.0]]]))[0, 0]
        assert math.isclose(found, math.log(total(word)), rel_tol=1e-9)


def test_expected_counts_are_those_of_all_segmentations():
    pieces = ["a", "aa", "ab", "b", langid.END]
    numbers = {x: i + 1 for i, x in enumerate(pieces)}
    p = np.array([[0.01], [0.3], [0.2], [0.25], [0.15], [0.1]])
    word = "aabaabaaab" + langid.END
    lattice, full = langid.Lattice([word], langid.PieceTable(pieces)), np.vstack([p, [[0.0]]])
    found = lattice.expected(full, np.array([1.0]))
    for k in range(1, len(pieces) + 1):  # d log L / d log p is the expected count
        up, down = full.copy(), full.copy()
        up[k] *= 1.0001
        down[k] /= 1.0001
        slope = (lattice.likelihood(up) - lattice.likelihood(down))[0, 0] / (2 * math.log(1.0001))
        assert math.isclose(found[k], slope, rel_tol=1e-4)


def test_letters_without_a_piece_tell_languages_apart(spark, frames):
    # Hebrew, Greek and Cyrillic letters: two made-up languages a script, of the same word lengths.
    ship(spark)
    rng, rows, asked, want = random.Random(6), [], [], {}
    for script, letters in {"he": "אבגדהוזחטיכל", "el": "αβγδεζηθικλμ", "ru": "абвгдежзийкл"}.items():
        for half, own in (("1", letters[:6]), ("2", letters[6:])):
            for _ in range(20):
                rows.append((len(rows), " ".join("".join(rng.choices(own, k=4)) for _ in range(20)), script + half, "s"))
            want[len(asked)] = script + half
            asked.append((len(asked), " ".join("".join(rng.choices(own, k=4)) for _ in range(5))))
    model = langid.fit(frames.docs(rows).selectExpr("doc_id AS id", "lang", "text"), rounds=2)
    got = langid.predict(frames.docs(asked), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == want and all(r["score"] > 0.9 for r in got)


def test_every_byte_is_a_piece():
    pieces = langid.read_pieces(langid.public_tokenizers.path(langid.VOCABULARY))
    table, words = langid.PieceTable(pieces), langid.words_of("ß中ΩжŠא" + "𝒳")
    assert len(words) == 1
    for letter in words[0]:
        assert langid.Lattice([letter], table).fits[0][0][2][0] > 0


def test_long_pieces_enter_the_lattice():
    pieces = langid.read_pieces(langid.public_tokenizers.path(langid.VOCABULARY))
    longest = max((x for x in pieces if x.endswith(langid.END)), key=len)
    table = langid.PieceTable(pieces)
    assert len(longest) > 20
    assert (len(longest), pieces.index(longest) + 1) in [(k, found[0]) for k, _, found in langid.Lattice([longest], table).fits[0]]


def test_long_words_do_not_underflow(model):
    scorer = langid.Scorer(*model[1:])
    assert np.isfinite(scorer.score(["ж" * 5000 + " " + "q" * 64, "x" * 63])).all()


def test_languages_of_odd_texts(spark, frames, model, odd_rows):
    rows = [*odd_rows, (20, "12 34 !? ½ ² Ⅷ ①"), (24, "the½of"), (21, "Der und nicht das"), (22, "THE of THAT was"), (23, "the-of,and.to")]
    got = langid.predict(frames.docs(rows, extra=True), model).collect()
    assert len(got) == len(rows)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    for i in (1, 2, 3, 20):
        assert found[i] == ("und", 0.0)
    assert found[21][0] == "de" and found[22][0] == found[23][0] == found[24][0] == "en"
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in ("und", "de", "en") for r in got)


def test_nothing_to_learn_from(spark, frames):
    ship(spark)
    empty = frames.docs([]).selectExpr("doc_id AS id", "lang", "text")
    assert langid.predict(frames.docs([(1, "the")]), langid.fit(empty)).collect()[0]["lang_pred"] == "und"
    assert langid.predict(frames.docs([]), langid.fit(empty)).count() == 0


def test_filter_keeps_rows_whole(frames, model):
    df = frames.docs([(1, "the of and"), (2, "123"), (3, None), (1, "the of and")], extra=True)
    kept = langid.keep_known(df, model)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 1]


def test_filter_keeps_short_texts_and_all_without_a_language(frames):
    texts = [f"{w} la" for w in "ab cd ef".split() * 20]
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate((t, lang) for t in texts for lang in ("es", "fr", "it"))]
    same = langid.fit(frames.docs(rows).selectExpr("doc_id AS id", "lang", "text"), rounds=2)
    df = frames.docs([(1, "la"), (2, "123"), (3, "la " * 40)], extra=True)
    assert sorted(r["doc_id"] for r in langid.keep_known(df, same).collect()) == [1]
    nothing = langid.fit(frames.docs([]).selectExpr("doc_id AS id", "lang", "text"))
    assert langid.keep_known(df, nothing).count() == 3


def quality_rows(n):
    rng = random.Random(1)
    for i in range(n):
        text = make_text("en", rng, 40)
        good = i % 3 != 0
        yield i, text if good else text.replace(" ", "*** ").upper(), int(good)


def test_quality_of_held_out_rows(spark, frames):
    ship(spark)
    rows = list(quality_rows(300))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id BIGINT, quality INT").selectExpr("*", "'x' AS id")
    docs = frames.docs([(i, t) for i, t, _ in rows], extra=True)
    got = {r["doc_id"]: r for r in quality.quality_scores(docs, labels).collect()}
    held = [i for i, _, _ in rows if got[i]["held_out"]]
    assert len(held) > 30 and all(got[i]["predicted"] == y for i, _, y in rows if i in held)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in got if got[i]["predicted"]}


def test_quality_without_labels_and_of_odd_texts(spark, frames, odd_rows):
    ship(spark)
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id BIGINT, quality INT")
    got = quality.quality_scores(frames.docs(odd_rows, extra=True), labels).collect()
    assert len(got) == len(odd_rows) and all(r["score"] == 0.5 and r["predicted"] == 1 for r in got)
    assert quality.quality_scores(frames.docs([]), labels).count() == 0
    one = spark.createDataFrame([(4, 1), (4, 1), (7, 1)], "doc_id BIGINT, quality INT")
    scores = quality.quality_scores(frames.docs(odd_rows), one).collect()
    assert all(0 <= r["score"] <= 1 for r in scores)


def test_isotonic_pools_violations():
    found = quality.isotonic(np.arange(4), np.array([1.0, 1, 2, 1]), np.array([0.0, 1, 1, 1]))
    assert found.tolist() == pytest.approx([0, 2 / 3, 2 / 3, 1])


def test_partition_sums_equal_one_sum(spark):
    ship(spark)
    random_ = np.random.default_rng(0)
    x = random_.normal(size=(50, quality.NAMES))
    rows = spark.createDataFrame([(*map(float, r), float(i % 2)) for i, r in enumerate(x)], [*quality.STATS, "y"])
    model = quality.blank_model(16, 4.0, 1)
    left, right = quality.normal_equations(rows.repartition(7), model)
    f = model.features(x)
    assert np.allclose(left, f.T @ f) and np.allclose(right, f.T @ (np.arange(50) % 2))
