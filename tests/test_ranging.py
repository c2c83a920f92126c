"""Orders and top rows by counted ranges: against sorting, computed once, whatever the columns are named."""

import random

import pytest
from pyspark.sql import functions as F

from wordbond import top_collocations
from wordbond.operators import JoinLimits, attach_totals, order_collocations, top_k_per_decade
from wordbond.operators.naming import unused_names
from wordbond.operators.ranging import by_score, by_words, count_ranges, range_sorted
from wordbond.sinks import save_collocation_lines

SCORES = "decade int, w1 string, w2 string, npmi double"
NAN, INF = float("nan"), float("inf")


def rows(df):
    return [tuple(row) for row in df.select("decade", "w1", "w2", "npmi").collect()]


def score_order(row):
    decade, w1, w2, npmi = row
    nan = npmi is not None and npmi != npmi
    score = -INF if npmi is None else npmi
    return (
        decade is not None, decade or 0, npmi is None, not nan, 0.0 if nan else 0.0 - score,
        w1 is not None, w1 or "", w2 is not None, w2 or "",
    )


@pytest.fixture(scope="module")
def mixed():
    """Ties, equal rows, a score and a word that hold most rows, and all special values."""
    chance = random.Random(5)
    table = [
        (1980 + 10 * chance.randrange(3), chance.choice(["the", "the", f"w{i}"]), f"v{chance.randrange(40)}",
         chance.choice([0.5, 0.5, 0.5004, 0.50041, round(chance.uniform(-1, 1), 5), chance.uniform(-1, 1)]))
        for i in range(1500)
    ]
    special = [None, NAN, INF, -INF, 0.0, -0.0, 1.0000000000000002, 2.5, -7.0]
    table += [(1980, "a", "b", score) for score in special] + [(None, "c", "d", score) for score in special]
    return table + [(1990, "same", "same", 0.25)] * 400 + [(2000, None, None, 0.5), (2000, "é", "ü", 0.5)]


@pytest.mark.parametrize("range_rows, partitions", [(1, 1000), (7, 1000), (50, 40), (100_000, 8)])
def test_order_by_score(spark, workspace, mixed, range_rows, partitions):
    frame = spark.createDataFrame(mixed, SCORES).repartition(6)
    found = range_sorted(frame, by_score(), workspace, partitions=partitions, range_rows=range_rows)
    assert [repr(score_order(r)) for r in rows(found)] == [repr(score_order(r)) for r in sorted(mixed, key=score_order)]


@pytest.mark.parametrize("range_rows", [3, 100])
def test_order_by_words(spark, workspace, mixed, range_rows):
    table = [r for r in mixed if None not in r[:3]]
    frame = spark.createDataFrame(table, SCORES).repartition(5)
    found = range_sorted(frame, by_words("w2", "w1"), workspace, partitions=1000, range_rows=range_rows)
    assert [(r[0], r[2], r[1]) for r in rows(found)] == sorted((r[0], r[2], r[1]) for r in table)


@pytest.mark.parametrize("k", [1, 3, 40, 390, 5000])
@pytest.mark.parametrize("range_rows", [5, 100_000])
def test_top_rows_of_hot_scores(spark, workspace, mixed, monkeypatch, k, range_rows):
    monkeypatch.setattr("wordbond.operators.selecting.count_ranges", lambda *args, **choices: count_ranges(
        *args, partitions=1000, range_rows=range_rows, **choices
    ))
    frame = spark.createDataFrame(mixed, SCORES).repartition(4)
    expected, seen = [], {}
    for row in sorted(mixed, key=score_order):
        seen[row[0]] = seen.get(row[0], 0) + 1
        if seen[row[0]] <= k:
            expected.append(row)
    found = rows(top_k_per_decade(frame, k, workspace).orderBy(*by_score().order))
    assert [repr(score_order(r)) for r in found] == [repr(score_order(r)) for r in expected]


def test_ranges_are_even(spark, workspace):
    """Also where one score of one word holds a third of the rows."""
    frame = spark.range(9000).selectExpr(
        "1980 AS decade", "if(id % 3 = 0, 'the', concat('w', id % 700)) AS w1", "concat('v', id) AS w2",
        "if(id % 3 = 0, 0.5D, (id % 1000) / 1000D) AS npmi",
    )
    stored = workspace.store(frame, "rows")
    ranges = count_ranges(stored, by_score(), workspace, partitions=30, range_rows=1)
    sizes = [row["count"] for row in ranges.sort(stored).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 9000 and 25 <= len(sizes) <= ranges.partitions <= 31 and max(sizes) <= 600


def counting(spark, runs):
    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    frame = spark.range(500, numPartitions=3).selectExpr(
        "1980 + 10 * (id % 2) AS decade", "concat('a', id) AS w1", "'b' AS w2", "id / 500D AS npmi"
    ).selectExpr("cast(decade AS int) AS decade", "w1", "w2", "npmi")
    return frame.mapInArrow(count, frame.schema)


@pytest.mark.parametrize("deduplicate", [True, False])
def test_top_rows_compute_their_input_once(spark, workspace, deduplicate):
    runs = spark.sparkContext.accumulator(0)
    top = top_collocations(counting(spark, runs), 5, deduplicate=deduplicate, workspace=workspace)
    assert len(top.collect()) == 10
    assert runs.value == 500


def test_an_order_computes_its_input_once(spark, workspace, tmp_path):
    runs = spark.sparkContext.accumulator(0)
    assert len(order_collocations(counting(spark, runs), workspace).collect()) == 500
    assert runs.value == 500
    save_collocation_lines(counting(spark, runs), str(tmp_path / "lines"))
    assert runs.value == 1000


def test_empty_tables(spark, workspace):
    empty = spark.createDataFrame([], SCORES)
    assert rows(order_collocations(empty, workspace)) == rows(top_k_per_decade(empty, 3, workspace)) == []


# --- columns of the input keep their names and values ------------------------

OWN = [
    "_place", "_decade", "_level", "_part", "_cut", "_offset", "_range", "_spread", "_rows", "rows", "first", "_first",
    "_before", "_depth", "_group", "_all", "_digit0", "_digit1", "_digit7", "_PLACE2", "_parts", "_salt", "_Place",
]


def test_unused_names():
    assert unused_names(["a", "_B"], "_b", "c", "c") == ["_b1", "c", "c1"]
    assert unused_names(["x", "x1", "X2"], "x") == ["x3"]


@pytest.mark.parametrize("own", [OWN[:-1], ["_Place", "_PART", "_SALT", "_Parts"]])
def test_clashing_columns_survive_top_rows_and_orders(spark, workspace, own):
    base = spark.range(60).selectExpr(
        "cast(1980 + 10 * (id % 2) AS int) AS decade", "concat('a', id) AS w1", "'b' AS w2", "(id % 7) / 10D AS npmi",
        *[f"cast(id * 100 + {n} AS int) AS `{name}`" for n, name in enumerate(own)],
    )
    given = {row.w1: row for row in base.collect()}
    for found in (top_k_per_decade(base, 9, workspace), order_collocations(base, workspace)):
        assert found.dtypes == base.dtypes
        kept = found.collect()
        assert len(kept) in (18, 60) and all(row == given[row.w1] for row in kept)


@pytest.mark.parametrize("limits", [JoinLimits(), JoinLimits(0, split_rows=4), JoinLimits(0, 0, split_rows=4)])
def test_clashing_columns_survive_joined_totals(spark, limits):
    own = ["_parts", "_salt", "rows", "_Salt1"]
    detail = spark.range(60).selectExpr(
        "cast(id % 3 AS int) AS decade", "concat('a', id) AS w1", "'b' AS w2",
        *[f"cast(id * 100 + {n} AS int) AS `{name}`" for n, name in enumerate(own)],
    )
    totals = spark.createDataFrame([(d, d * 11, 20) for d in range(3)], "decade int, n int, rows bigint")
    given = {row.w1: row for row in detail.collect()}
    joined = attach_totals(detail, totals, ["decade"], ["w1"], limits=limits)
    assert joined.columns == [*detail.columns, "n"]
    kept = joined.collect()
    assert len(kept) == 60
    assert all(tuple(row)[:-1] == tuple(given[row.w1]) and row.n == row.decade * 11 for row in kept)
