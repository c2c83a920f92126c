"""Nearest neighbours against brute force."""

import math

import numpy as np
import pytest

from wordbond.llm import neighbours, queries

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, _id string, rank string, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", 1) for i, v in rows], SCHEMA)


def brute(rows, nearest=5, step=50):
    good = {}
    for i, v in rows:
        if i is None or v is None or len(v) != len(rows[0][1]) or any(x is None for x in v):
            continue
        v = np.array(v, np.float32).astype(float)
        if np.isfinite(v).all() and v.any():
            good.setdefault(i, []).append(v)
    found = {}
    for q in [i for i in good if i % step == 0]:
        scores = [(-max(
            float((a * b).sum() / (math.sqrt((a * a).sum()) * math.sqrt((b * b).sum())))
            for a in good[q] for b in good[i]
        ), i) for i in good if i != q]
        found[q] = [(i, -s) for s, i in sorted(scores)[:nearest]]
    return found


def recall(found, expected):
    by_query = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = total = 0
    for q, want in expected.items():
        got = by_query.pop(q, [])
        assert len(got) == len(want) and len({i for i, _ in got}) == len(got)
        assert got == sorted(got, key=lambda x: (-x[1], x[0]))
        hits += len({i for i, _ in got} & {i for i, _ in want})
        total += len(want)
        assert all(s == pytest.approx(dict(want)[i], abs=1e-12) for i, s in got if i in dict(want))
    assert not by_query
    return hits / max(total, 1)


def clustered(count, size=32, seed=0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(20, size))
    return [(i, (centres[i % 20] + 0.7 * draw.normal(size=size)).astype(np.float32).tolist()) for i in range(count)]


def test_quantile():
    assert neighbours.chi_square_quantile(2, 0.95) == pytest.approx(5.991465, abs=1e-5)
    assert neighbours.chi_square_quantile(8, 0.99) == pytest.approx(20.090235, abs=1e-5)


@pytest.mark.parametrize("leaves", [1, 2, 7, 64])
def test_every_point_falls_into_its_part(leaves):
    points = np.random.default_rng(1).normal(size=(500, 3))
    points[:200] = points[0]
    tree = neighbours.split_space(points, leaves)
    leaf = tree.leaf_of(points)
    assert tree.leaves <= leaves and set(leaf) <= set(range(tree.leaves))
    assert len(set(leaf[:200])) == 1
    if leaves > 1:
        assert len(set(leaf)) > 1


def test_recall_over_many_blocks(spark, workspace, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 200)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 17)
    rows = clustered(3000)
    found = neighbours.nearest_neighbours(table(spark, rows), workspace).collect()
    assert recall(found, brute(rows)) >= 0.97


def test_odd_vectors(spark, workspace, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 100)
    rows = clustered(400, 4)
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(500)]
    rows += [(50, None), (2000, None), (2050, []), (2100, [0.0] * 4), (2150, [1.0, None, 1.0, 1.0]), (None, [1.0] * 4),
             (2200, [float("nan")] * 4), (2250, [float("inf"), 0.0, 0.0, 0.0]), (2300, [1.0] * 5), (100, rows[100][1]),
             (7, [1.0, 2.0, 3.0, 4.0]), (150, [1.0, 2.0, 3.0, 4.0]), (2350, [1e-30, 0.0, 0.0, 0.0]), (-50, [2.0, 4.0, 6.0, 8.0])]
    found = neighbours.nearest_neighbours(table(spark, rows), workspace).collect()
    assert recall(found, brute(rows)) >= 0.97


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, [1.0, 0.0])], [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 0.0])]])
def test_small_tables(spark, workspace, rows):
    found = neighbours.nearest_neighbours(table(spark, rows), workspace).collect()
    assert recall(found, brute(rows)) in (0, 1)
    assert all(type(r.score) is float for r in found)


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert recall(queries.op3_projected_neighbours(spark, SF).collect(), brute(rows)) >= 0.95


def test_blocks_are_repeated_only_for_parts_beyond_the_first(spark, workspace, monkeypatch):
    """With one part enough for each block, the search reads the points once and a row for each visit."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 200)
    rows = clustered(2000)
    found = neighbours.nearest_neighbours(table(spark, rows), workspace)
    import os
    folder = workspace.path.removeprefix("file:")
    stages = {name.split("-", 1)[1]: f"{folder}/{name}" for name in os.listdir(folder)}
    counted = spark.read.parquet(stages["visits"])
    assert counted.agg({"_parts": "max"}).first()[0] == 1
    assert counted.count() <= 10 + 10 and spark.read.parquet(stages["indexed"]).count() == 2000
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_regions_grow_with_the_sample(spark, workspace, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)
    rows = clustered(3000)
    made = neighbours.nearest_neighbours(table(spark, rows), workspace, sample_rows=40).collect()
    assert recall(made, brute(rows)) >= 0.97  # ten regions of six blocks each


def test_ties_of_equal_vectors_go_to_the_smaller_id(spark, workspace, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 300)
    rows = clustered(600, 64) + [(5000 + i, [0.1 * j for j in range(64)]) for i in range(900)]
    found = {}
    for r in neighbours.nearest_neighbours(table(spark, rows), workspace).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for query in (5000, 5050, 5850):
        assert [i for _, i in sorted(found[query])] == [i for i in range(5000, 5006) if i != query][:5]


def test_searching_together_equals_searching_alone():
    draw = np.random.default_rng(8)
    vectors = draw.normal(size=(3000, 16))
    matrix = draw.normal(size=(16, neighbours.DIMENSIONS))
    points = (vectors / np.sqrt((vectors ** 2).sum(axis=1))[:, None]) @ matrix
    block = neighbours._Block(np.arange(3000), vectors, points)
    quantile = neighbours.chi_square_quantile(neighbours.DIMENSIONS, 0.99)
    rows = np.arange(0, 3000, 100)
    together = block.search(rows, vectors[rows], points[rows], 5, quantile, np.full(len(rows), 4.0))
    for place, row in enumerate(rows):
        alone = block.search(rows[[place]], vectors[[row]], points[[row]], 5, quantile, np.full(1, 4.0))
        assert (alone.ids[0] == together.ids[place]).all() and alone.bound[0] == together.bound[place]
        assert row not in alone.ids[0]
