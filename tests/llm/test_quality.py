"""Quality rules: counts against plain counting, trees against recursion, held-out labels."""

import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from wordbond.llm import quality, queries

SF = "/root/testdata/sf0.1"
SCHEMA = "doc_id bigint, text string, _id string, _text string, _md5 int, kept string, score int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", 1, "c", 2) for i, t in rows], SCHEMA)


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    again = [i for i, window in enumerate(windows) if windows.count(window) > 1]
    covered = {i + shift for i in again for shift in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    repeated = sum(line in lines[:i] for i, line in enumerate(lines))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed
    )


TEXTS = [
    None, "", " \t\n", "a", "a b c", "a b c a b c", "a a a a", "x y z", "  word　word",
    "line one\nline one\n\n\nline one\n  \n  ", "ümlaut straße 数字 # * $ % & | < >", "\x0b\x0c\x1c\x85 tail",
    "one two three four " * 30, " ".join(f"w{i}" for i in range(200)), "same line\r\nsame line\r\nother",
    " ".join(f"w{i}" for i in range(60)) + " " + " ".join(f"w{i}" for i in range(20)),
]


def test_counts_equal_plain_counting(spark):
    rows = list(enumerate(TEXTS)) + [(3, "a"), (None, "a b c"), (3, "a")]
    judged = quality.judge_quality(table(spark, rows), quality.Forest(2.0))
    assert judged.columns == [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    ]
    got = sorted((str(tuple(row)[:-1]) for row in judged.collect()))
    assert got == sorted(str((i, *plain(text), not plain(text)[-1])) for i, text in rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("a b c d".split()), max_size=40))
def test_repeated_words(words):
    text = " ".join(words)
    assert quality.repeated_words(text.encode().split()) == plain(text)[4]


def test_long_texts_are_counted_whole():
    words = [f"w{i}".encode() for i in range(300_000)]
    assert quality.repeated_words(words) == 0
    assert quality.repeated_words(words + words[:3]) == 6
    assert quality.repeated_words(words, run=9) == 0  # runs whose keys pass 64 bits
    assert quality.repeated_words(words + words[:9], run=9) == 18


# --- trees -------------------------------------------------------------------


def walk(forest, root, row):
    at = root
    while forest.left[at] != at:
        at = forest.left[at] if row[forest.feature[at]] <= forest.bound[at] else forest.right[at]
    return forest.value[at]


def sample(rows=600, seed=0):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(rows, 4))
    good = (x[:, 0] + np.abs(x[:, 1]) - x[:, 2] + 0.3 * draw.normal(size=rows) > 0).astype(float)
    return x, good


def test_flat_trees_equal_recursion():
    x, good = sample()
    forest = quality.grow_forest(x, good, trees=12)
    assert len(forest.roots) == 12 and len(forest.value) > 50
    margins = [forest.base + sum(walk(forest, root, row) for root in forest.roots) for row in x]
    assert forest.margin(x) == pytest.approx(margins, abs=1e-12)


def test_trees_learn():
    x, good = sample()
    forest = quality.grow_forest(x, good)
    unseen, truth = sample(seed=1)
    assert ((forest.score(unseen) >= 0.5) == truth).mean() > 0.87
    assert (quality.grow_forest(x, good).margin(unseen) == forest.margin(unseen)).all()


@pytest.mark.parametrize("sign", [-1, 1])
@pytest.mark.parametrize("feature", [0, 1, 2, 3])
def test_monotonic_features(sign, feature):
    x, good = sample()
    signs = np.zeros(4)
    signs[feature] = sign
    forest = quality.grow_forest(x, good, signs, depth=5, leaf_rows=3)
    grid = np.linspace(-3, 3, 101)
    for row in x[:60]:
        rows = np.tile(row, (len(grid), 1))
        rows[:, feature] = grid
        assert (sign * np.diff(forest.margin(rows)) >= -1e-12).all()
    free = quality.grow_forest(x, good, depth=5, leaf_rows=3)
    if feature == 1:  # the truth goes both ways, so without the constraint the score does
        rows = np.tile(x[0], (len(grid), 1))
        rows[:, 1] = grid
        assert not (sign * np.diff(free.margin(rows)) >= -1e-12).all()


def test_one_kind_of_label_or_none():
    assert quality.grow_forest(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))) == pytest.approx([1, 1])
    assert quality.grow_forest(np.zeros((4, 3)), np.zeros(4)).score(np.zeros((2, 3))) == pytest.approx([0, 0], abs=1e-6)
    assert quality.grow_forest(np.ones((40, 3)), np.array([0.0, 1.0] * 20)).score(np.ones((1, 3))) == pytest.approx([0.5])


# --- on Spark ----------------------------------------------------------------


def corpus(copies=0):
    draw = np.random.default_rng(4)
    words = [f"word{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(400):
        picked = draw.choice(words, 80).tolist()
        good = i % 3 > 0
        rows.append((i, " ".join(picked) if good else " ".join(w + "###" for w in picked)))
        labels.append((i, int(good)))
    for i in range(copies):  # one bad text, many times, under a good label
        rows.append((1000 + i, rows[0][1]))
        labels.append((1000 + i, 1))
    return rows, labels


def fitted(spark, workspace, rows, labels, **choices):
    known = spark.createDataFrame([(i, q, "x") for i, q in labels], "doc_id bigint, quality int, _good string")
    return quality.fit_quality(table(spark, rows), known, workspace, **choices)


def test_copies_weigh_as_one_text(spark, workspace):
    rows, labels = corpus(copies=300)
    forest = fitted(spark, workspace, rows, labels, trees=10)
    kept = {r.doc_id: r.kept for r in quality.judge_quality(table(spark, rows), forest).collect()}
    assert all(kept[i] == (i % 3 > 0) for i in range(400))


def test_the_sample_is_bounded_and_balanced(spark, workspace):
    rows, labels = corpus(copies=50)
    docs = table(spark, rows)
    known = spark.createDataFrame(labels, "doc_id bigint, quality int")
    chosen = quality._sample(docs, known, workspace, 40, "doc_id", "text").collect()
    assert len(chosen) == 40 and sum(row._good for row in chosen) == 20


def test_held_out_labels_teach_nothing(spark, workspace):
    rows, labels = corpus()
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    x = np.random.default_rng(0).random((50, len(quality.FEATURES)))
    first = fitted(spark, workspace, rows, labels, trees=5)
    assert (first.margin(x) == fitted(spark, workspace, rows, flipped, trees=5).margin(x)).all()


def test_no_labels_and_no_rows(spark, workspace):
    rows, _ = corpus()
    forest = fitted(spark, workspace, rows, [(1, None), (99_999, 1)])
    assert not forest.roots
    judged = quality.judge_quality(table(spark, rows[:5]), forest).collect()
    assert all(row.kept for row in judged)
    assert quality.judge_quality(table(spark, []), forest).collect() == []
    assert not fitted(spark, workspace, [], []).roots


@pytest.mark.parametrize("kind", ["string", "smallint", "decimal(20,2)", "binary"])
def test_other_ids(spark, workspace, kind):
    rows, labels = corpus()
    cast = F.col("doc_id").cast("string").cast(kind) if kind == "binary" else F.col("doc_id").cast(kind)
    docs = table(spark, rows[:90]).withColumn("doc_id", cast)
    known = spark.createDataFrame(labels, "doc_id bigint, quality int").withColumn("doc_id", cast)
    forest = quality.fit_quality(docs, known, workspace, trees=2)
    judged = quality.judge_quality(docs, forest)
    assert judged.schema["doc_id"].dataType == docs.schema["doc_id"].dataType and judged.count() == 90


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_held_out_accuracy(spark):
    judged = queries.op11_boosted_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    unseen = judged.join(labels, "doc_id").filter(
        "not base_failed AND crc32(cast(doc_id AS string)) % 5 = 0"
    ).groupBy("quality", "kept").count().collect()
    counts = {(row.quality, row.kept): row["count"] for row in unseen}
    assert sum(counts.values()) > 500 and sum(n for (q, kept), n in counts.items() if q == 0) > 30
    assert counts.get((1, False), 0) <= 0.005 * sum(counts.values())
    assert counts.get((0, True), 0) <= 0.02 * sum(n for (q, _), n in counts.items() if q == 0)
