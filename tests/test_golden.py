"""The worked example: eleven lines, every score, every selection."""

import pytest

from wordbond import (
    collocations, count_pairs, score_ngrams, score_pairs, select_collocations, top_collocations,
)

LINES = [
    "Strong Tea\t1987\t8\t1\t1",
    "strong tea\t1983\t4\t1\t1",
    "strong coffee\t1981\t2\t1\t1",
    "green tea\t1989\t6\t1\t1",
    "the tea\t1985\t50\t1\t1",
    "tea2 cup\t1985\t9\t1\t1",
    "bye bye\t1984\t3\t1\t1",
    "solo pair\t1950\t7\t1\t1",
    "old ship\t1873\t4\t1\t1",
    "old house\t1874\t6\t1\t1",
    "tall ship\t1879\t5\t1\t1",
]
STOP_WORDS = ["the", "of"]

SCORES = {
    (1870, "tall", "ship"): (5, 15, 5, 9, 0.464974),
    (1870, "old", "house"): (6, 15, 10, 6, 0.442507),
    (1870, "old", "ship"): (4, 15, 10, 9, -0.306762),
    (1980, "bye", "bye"): (3, 23, 3, 3, 1.000000),
    (1980, "strong", "coffee"): (2, 23, 14, 2, 0.203262),
    (1980, "green", "tea"): (6, 23, 6, 18, 0.182419),
    (1980, "strong", "tea"): (12, 23, 14, 18, 0.139830),
}
RELATIVE = {
    "tall ship": (0.774030, 0.774030), "old house": (0.736630, 0.736630),
    "old ship": (-0.510660, -0.510660), "bye bye": (0.655518, 0.470316),
    "strong coffee": (0.133242, 0.095598), "green tea": (0.119579, 0.085795),
    "strong tea": (0.091661, 0.065764),
}


def found(spark, lines, **choices):
    return collocations(spark, lines(*LINES), language="english", stop_words=STOP_WORDS, **choices)


def pairs_of(df):
    return [f"{row.w1} {row.w2}" for row in df.collect()]


def test_scores(lines):
    counts = count_pairs(lines(*LINES), STOP_WORDS, language="english")
    rows = score_pairs(counts).collect()
    assert {(r.decade, r.w1, r.w2): (r.c12, r.n, r.c1, r.c2, round(r.npmi, 6)) for r in rows} == SCORES
    assert sorted(score_ngrams(lines(*LINES), STOP_WORDS, language="english").collect()) == sorted(rows)


def test_counts_keep_the_pair_that_is_its_whole_decade(lines):
    rows = count_pairs(lines(*LINES), STOP_WORDS, language="english").collect()
    assert ("solo", "pair", 7, 7) in {(r.w1, r.w2, r.c12, r.n) for r in rows}
    assert len(rows) == len(SCORES) + 1


@pytest.mark.parametrize("scope, place, total", [("decade", 0, 1.525511), ("running", 1, 2.126229)])
def test_relative_scores(spark, lines, scope, place, total):
    # A running total that reaches 1870 only through the remainder 0 of 11.
    counts = count_pairs(lines(*LINES), STOP_WORDS, language="english")
    rows = select_collocations(
        score_pairs(counts).filter("npmi >= -1"), min_npmi=0.0, rel_min_npmi=0.0, total_scope=scope
    ).collect()
    assert {round(r.total_npmi, 6) for r in rows if r.decade == 1980} == {total}
    assert {round(r.total_npmi, 6) for r in rows if r.decade == 1870} == {0.600718}
    assert {f"{r.w1} {r.w2}": round(r.rel_npmi, 6) for r in rows} == {
        pair: values[place] for pair, values in RELATIVE.items() if pair != "old ship"
    }


@pytest.mark.parametrize("choices, expected", [
    (dict(min_npmi=0.5, rel_min_npmi=0.1),
     ["tall ship", "old house", "bye bye", "strong coffee", "green tea"]),
    (dict(min_npmi=0.5, rel_min_npmi=0.1, total_scope="running"),
     ["tall ship", "old house", "bye bye"]),
    (dict(min_npmi=0.1, rel_min_npmi=0.1),
     ["tall ship", "old house", "bye bye", "strong coffee", "green tea", "strong tea"]),
])
def test_selection_in_output_order(spark, lines, choices, expected):
    assert pairs_of(found(spark, lines, **choices)) == expected


def test_top_rows(spark, lines):
    kept = found(spark, lines, min_npmi=0.1, rel_min_npmi=0.1)
    assert pairs_of(top_collocations(kept, 1, 0.99)) == ["tall ship", "strong coffee"]
    assert pairs_of(top_collocations(kept, 1, 0.99, inclusive=True)) == [
        "tall ship", "old house", "strong coffee", "green tea",
    ]
    assert pairs_of(top_collocations(kept, 1, drop_self_pairs=False)) == ["tall ship", "bye bye"]
    assert pairs_of(top_collocations(kept, 0)) == []
