"""Scores at the edges: undefined, infinite and NaN values, running totals."""

import math

import pytest
from pyspark.sql import functions as F

from wordbond import functions as fn, score_pairs, select_collocations
from wordbond.operators import (
    count_rollup, duplicate_pairs, keep_high_scores, npmi_totals, running_npmi_totals,
    whole_decade_pairs, with_npmi, with_relative_npmi,
)

COUNTS = "decade int, w1 string, w2 string, c12 bigint, n bigint, c1 bigint"
NAN, INF = float("nan"), float("inf")


def same(a, b):
    return a == b or (math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize("score, total, expected", [
    (0.5, 2.0, 0.25), (0.5, 0.0, INF), (-0.5, 0.0, -INF), (0.0, 0.0, NAN), (NAN, 0.0, NAN),
    (NAN, 2.0, NAN), (0.5, NAN, NAN), (0.5, -2.0, -0.25),
])
def test_relative_score_follows_ieee_division(spark, score, total, expected):
    table = spark.createDataFrame([(score, total)], "npmi double, total_npmi double")
    assert same(with_relative_npmi(table).first()["rel_npmi"], expected)


def test_either_threshold_keeps_a_row_and_nan_is_kept(spark):
    table = spark.createDataFrame(
        [(1, 0.6, 0.0), (2, 0.1, 0.3), (3, 0.1, 0.1), (4, NAN, 0.0), (5, 0.1, NAN), (6, 0.5, 0.0), (7, 0.0, 0.2)],
        "id int, npmi double, rel_npmi double",
    )
    assert sorted(row.id for row in keep_high_scores(table, 0.5, 0.2).collect()) == [1, 2, 4, 5, 6, 7]


def test_zero_total_still_lets_the_thresholds_decide(spark):
    scores = spark.createDataFrame(
        [(1980, "a", "b", 0.25), (1980, "c", "d", -0.25)], "decade int, w1 string, w2 string, npmi double"
    )
    rows = select_collocations(scores, min_npmi=0.5, rel_min_npmi=0.2).collect()
    assert [(r.w1, r.rel_npmi) for r in rows] == [("a", INF)]


def test_pair_that_is_its_decade_is_dropped(spark):
    table = spark.createDataFrame(
        [(1950, "solo", "pair", 7, 7, 7, 7), (1960, "a", "b", 3, 7, 3, 3)], COUNTS + ", c2 bigint"
    )
    assert [row.w1 for row in with_npmi(table).collect()] == ["a"]
    assert [row.w1 for row in whole_decade_pairs(table).collect()] == ["solo"]


def test_share_that_rounds_to_one_is_dropped_too(spark):
    # The counts differ, but their quotient is 1.0 and its logarithm zero.
    table = spark.createDataFrame(
        [(1950, "a", "b", 2**60 - 1, 2**60, 2**60, 2**60)], COUNTS + ", c2 bigint"
    )
    assert with_npmi(table).count() == 0


def test_npmi_is_the_formula(spark):
    table = spark.createDataFrame([(12, 23, 14, 18)], "c12 bigint, n bigint, c1 bigint, c2 bigint")
    row = table.select(fn.pmi().alias("pmi"), fn.npmi().alias("npmi")).first()
    pmi = math.log(12) + math.log(23) - math.log(14) - math.log(18)
    assert row.pmi == pytest.approx(pmi, abs=1e-12)
    assert row.npmi == pytest.approx(-pmi / math.log(12 / 23), abs=1e-12)


def test_running_totals_by_remainder(spark):
    totals = spark.createDataFrame(
        [(1760, 1.0, 1), (1870, 2.0, 1), (1880, 10.0, 1), (1980, 4.0, 1), (1990, 20.0, 1)],
        "decade int, total_npmi double, rows bigint",
    )
    running = {r.decade: r.total_npmi for r in running_npmi_totals(totals, 11).collect()}
    assert running == {1760: 1.0, 1870: 3.0, 1880: 10.0, 1980: 7.0, 1990: 30.0}
    alone = {r.decade: r.total_npmi for r in running_npmi_totals(totals, 100_000).collect()}
    assert alone == {1760: 1.0, 1870: 2.0, 1880: 10.0, 1980: 4.0, 1990: 20.0}


def test_total_counts_its_rows(spark):
    scores = spark.createDataFrame([(1980, 0.5), (1980, 0.25), (1990, 1.0)], "decade int, npmi double")
    assert {tuple(r) for r in npmi_totals(scores).collect()} == {(1980, 0.75, 2), (1990, 1.0, 1)}


def test_duplicate_pairs_are_found_and_refused(spark):
    counts = spark.createDataFrame(
        [(1980, "a", "b", 2, 9, 2), (1980, "a", "b", 3, 9, 2), (1990, "a", "b", 3, 9, 2)], COUNTS
    )
    assert [tuple(r) for r in duplicate_pairs(counts).collect()] == [(1980, "a", "b", 2)]
    with pytest.raises(ValueError, match="more than one row"):
        score_pairs(counts)
    assert score_pairs(counts, validate=False).count() == 3


def test_rollup_levels(spark):
    pairs = spark.createDataFrame(
        [(1980, "a", "b", 2), (1980, "a", "c", 3), (1990, "a", "b", 5)],
        "decade int, w1 string, w2 string, c12 bigint",
    )
    rows = {tuple(r) for r in count_rollup(pairs).collect()}
    assert (1980, "a", None, 1, 5, 2) in rows and (1980, None, "b", 2, 2, 1) in rows
    assert (1980, None, None, 3, 5, 2) in rows and (1980, "a", "c", 0, 3, 1) in rows
    assert len(rows) == 3 + 2 + 3 + 2


def test_overflowing_counts_raise(spark):
    from wordbond.operators import count_pairs_per_decade

    rows = spark.createDataFrame(
        [(1980, "a", "b", 2**62), (1980, "a", "b", 2**62)],
        "decade int, w1 string, w2 string, match_count bigint",
    )
    with pytest.raises(Exception, match="OVERFLOW"):
        count_pairs_per_decade(rows).collect()


def test_scores_are_doubles_and_counts_are_longs(spark):
    pairs = spark.createDataFrame([(1980, "a", "b", 2)], "decade int, w1 string, w2 string, c12 bigint")
    assert dict(count_rollup(pairs).dtypes)["total"] == "bigint"
    assert dict(npmi_totals(pairs.withColumn("npmi", F.lit(0.5))).dtypes)["total_npmi"] == "double"
