import hashlib
import random

import pytest

from gridpulse.llm import recompression, substrings


def words_of(text):
    return (text or "").encode().split()


def brute(rows, width):
    first = {}
    for i, text in rows:
        w = words_of(text)
        for k in range(len(w) - width + 1) if i is not None else ():
            window = tuple(w[k : k + width])
            first[window] = min(first.get(window, i), i)
    out = []
    for i, text in rows:
        w = words_of(text)
        gone = [False] * len(w)
        for k in range(len(w) - width + 1) if i is not None else ():
            if first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


WANT = ("n_words", "n_removed", "kept_sha256")


def found(df, **settings):
    return sorted(map(tuple, substrings.remove_repeats(df, want=WANT, **settings).collect()), key=str)


def corpus(seed, n, vocabulary, most):
    """Random texts, some of which take over passages of earlier ones, also in part and in runs."""
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        words = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(most))]
        for _ in range(rng.randrange(3)):
            other = rng.choice(texts).split() if texts else []
            if other:
                a = rng.randrange(len(other))
                at = rng.randrange(len(words) + 1)
                words[at:at] = other[a : a + rng.randrange(1, 120)]
        if rng.random() < 0.2:
            words += [rng.choice(["run", "w1"])] * rng.randrange(60)
        texts.append(rng.choice([" ", "\n", "\t\x0b "]).join(words))
    return texts


@pytest.mark.parametrize("vocabulary, width, block", [(2, 13, 1), (5, 13, 3000), (50, 13, 1 << 20), (3000, 13, 500), (4, 5, 2000)])
def test_equals_brute_force(spark, vocabulary, width, block):
    texts = corpus(vocabulary, 60, vocabulary, 150)
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    assert found(df, width=width, block_bytes=block) == brute(rows, width)


def test_long_copies_are_settled_by_stretches(spark):
    rng = random.Random(3)
    text = [f"w{rng.randrange(5000)}" for _ in range(4000)]
    rows = [(i, " ".join([f"own{i}"] * i + text + [f"end{i}"])) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    assert found(df) == brute(rows, 13)
    held = substrings.cut(substrings.blocks(df, "doc_id", "text"))
    told = substrings.verify(held, substrings.reveal(held, 13), 13)
    assert sum(bin(b).count("1") for r in told.where("mask IS NOT NULL").collect() for b in r["mask"]) > 7 * 3900
    assert told.where("mask IS NULL").count() < 200


def test_odd_rows(spark, frames, odd_rows):
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(i, text) for i, text in odd_rows]
    rows += [(20, passage), (21, f"before {passage} behind"), (None, passage), (21, passage), (19, "é" + passage + " ü"), (-5, None)]
    rows += [(30, "a b c d e f g h i j k l m"), (31, "a b c d e f g h i j k l m"), (32, "a b c d e f g h i j k l")]
    rows += [(33, "word " * 30_010), (34, "z\x1cz " * 20_000), (35, "z\x1cz " * 19_000), (36, "x" * 9), (37, "x" * 8)]
    got = found(frames.docs(rows, extra=True))
    assert got == brute(rows, 13)
    assert found(frames.docs([])) == []


def test_chunks_do_not_matter(spark, monkeypatch):
    rows = list(enumerate(corpus(9, 30, 40, 900)))
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").coalesce(1)
    assert found(df) == brute(rows, 13)
    data = " ".join(t for _, t in rows).encode()
    a, b, _, _ = recompression.word_names(data)
    whole = recompression.window_anchors(a, 13)
    monkeypatch.setattr(recompression, "CHUNK", 37)
    assert (recompression.window_anchors(a, 13) == whole).all()


def test_texts_and_ranges(spark):
    passage = [f"p{i}" for i in range(20)]
    rows = [(1, " ".join(passage)), (2, " ".join(["x", *passage, "y", "z"]))]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = {r["doc_id"]: r for r in substrings.remove_repeats(df).collect()}
    assert got[1]["kept"] == rows[0][1] and got[1]["removed"] == []
    assert got[2]["kept"] == "x y z" and got[2]["removed"] == [[1, 21]] and got[2]["n_removed"] == 20


@pytest.mark.parametrize("vocabulary", [1, 2, 7, 400])
def test_equal_windows_have_equal_anchors(vocabulary):
    rng = random.Random(vocabulary)
    words = [b"v%d" % rng.randrange(vocabulary) for _ in range(3000)]
    words[700:900] = words[100:300]
    words[2000:2040] = [b"run"] * 40
    words[2500:2530] = [b"run"] * 30
    data = b" ".join(words)
    a, b, start, end = recompression.word_names(data)
    assert [data[i:j] for i, j in zip(start, end, strict=True)] == words
    anchors = recompression.window_anchors(a, 13)
    names = recompression.windows(a, b, 13)
    by_words, by_name = {}, {}
    for i in range(len(words) - 12):
        window = tuple(words[i : i + 13])
        assert by_words.setdefault(window, (anchors[i], names[0][i], names[1][i])) == (anchors[i], names[0][i], names[1][i])
        assert by_name.setdefault((names[0][i], names[1][i]), window) == window
