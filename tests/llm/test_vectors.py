"""Vector codes and centroid clusters against plain counting and against SQL."""

import hashlib
import math
from pathlib import Path

import duckdb
import numpy as np
import pytest

from wordbond.llm import codes, integers, queries, va_clustering

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<double>, label int, _id string, _label string, _row string, rows int"


def table(spark, rows, labels=lambda i: None):
    return spark.createDataFrame(
        [(i, v, labels(i), "x", "y", "z", 3) for i, v in rows], SCHEMA
    )


def random_rows(count, length, seed=0, spread=0.3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, length))
    return [(i, (centres[i % 6] + spread * draw.normal(size=length)).tolist()) for i in range(count)]


BROKEN = [
    (500, None), (501, []), (502, [None] * 64), (503, [1.0] * 63 + [None]), (504, [1.0] * 63 + [math.nan]),
    (505, [1.0] * 63 + [math.inf]), (506, [0.5] * 12),
]


def floors(rows, scale, length):
    return [
        (i, tuple(math.floor(scale * x) for x in v)) for i, v in rows
        if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)
    ]


def plain_codes(rows, length, parts=8, entries=16, rounds=6, scale=4096):
    kept = floors(rows, scale, length)
    width = length // parts
    first = sorted((i, v) for i, v in kept if i is not None)
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v in kept]
    # Bytes, not numbers, order the vectors of one id; the tests' repeated ids hold equal vectors.
    books = [[v[p * width:(p + 1) * width] for _, v in first[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), k) for k, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = [[] for _ in books[p]]
            for v in cut:
                members[nearest(v[p], books[p])[1]].append(v[p])
            books[p] = [
                tuple(sum(column) // len(found) for column in zip(*found)) if found else entry
                for found, entry in zip(members, books[p])
            ]
    digest = hashlib.sha256(
        ",".join(str(x) for book in books for entry in book for x in entry).encode()
    ).hexdigest()
    out = []
    for (i, _), v in zip(kept, cut):
        found = [nearest(v[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), digest))
    return out


def plain_clusters(rows, length=64, count=8, rounds=10, scale=1024):
    kept = floors(rows, scale, length)
    order = sorted(kept, key=lambda r: hashlib.sha256(f"3:{r[0]}".encode()).hexdigest())
    centres = [v for _, v in order[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        members = [[] for _ in centres]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centres = [
            tuple(sum(column) // len(found) for column in zip(*found)) if found else old
            for found, old in zip(members, centres)
        ]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = [sum(d for _, d, k in found if k == c) for c in range(len(centres))]
    return sorted((
        i, k, d, inertia[k], sum(inertia), hashlib.sha256(",".join(map(str, centres[k])).encode()).hexdigest()
    ) for i, d, k in found)


# --- exact products ----------------------------------------------------------


@pytest.mark.parametrize("largest", [1, 200, 1 << 13, 1 << 25, (1 << 27) - 1])
@pytest.mark.parametrize("bits", [None, 5, 12])
def test_limb_products_are_exact(largest, bits):
    draw = np.random.default_rng(largest)
    left = draw.integers(-largest, largest, size=(40, 64), endpoint=True)
    right = draw.integers(-largest, largest, size=(9, 64), endpoint=True)
    left[0], right[0] = largest, -largest
    right[1], right[2] = 0, -1
    expected = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in right] for x in left]
    assert integers.exact_products(left, right, bits).tolist() == expected
    for parts, values in ((integers.limbs(left, bits or 7), left), (integers.limbs(right, bits or 7), right)):
        assert (sum(part.astype(np.int64) << ((bits or 7) * n) for n, part in enumerate(parts)) == values).all()
        assert all(np.abs(part).max() < 1 << (bits or 7) for part in parts)


def test_limbs_keep_products_below_the_bound():
    for terms in (1, 2, 7, 8, 9, 64, 1000, 1 << 20):
        assert terms * (1 << 2 * integers.limb_bits(terms)) <= 1 << 53


def test_means_round_down():
    before = np.array([[7, 7], [5, -5]])
    assert integers.floor_means([2, 0], [[-3, 3], [0, 0]], before).tolist() == [[-2, 1], [5, -5]]


def test_sums_of_large_numbers_are_exact():
    points = np.array([[(1 << 30) - 1, -(1 << 30)]] * 5000)
    rows, sums = integers.label_sums(points, np.array([0, 1] * 2500), 3)
    assert rows.tolist() == [2500, 2500, 0]
    assert sums.tolist() == [[2500 * ((1 << 30) - 1), -2500 << 30]] * 2 + [[0, 0]]


# --- codes -------------------------------------------------------------------


def found_codes(spark, workspace, rows, labels=lambda i: None, **choices):
    made = codes.compress_vectors(table(spark, rows, labels), workspace, **choices)
    assert made.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return [tuple(row) for row in made.collect()]


def no_null(rows):
    return sorted(rows, key=lambda row: (row[0] is None, str(row)))


@pytest.mark.parametrize("length, parts", [(64, 8), (16, 8), (12, 4)])
def test_codes_equal_plain_counting(spark, workspace, length, parts):
    rows = random_rows(150, length) + [(3, random_rows(4, length)[3][1]), (None, [0.1] * length)]
    got = found_codes(spark, workspace, rows, parts=parts)
    assert no_null(row[:3] + row[4:] for row in got) == no_null(plain_codes(rows, length, parts))


def test_broken_vectors_take_no_part_in_codes(spark, workspace):
    rows = random_rows(60, 64) + BROKEN
    assert no_null(r[:3] + r[4:] for r in found_codes(spark, workspace, rows)) == no_null(plain_codes(rows, 64))


def test_ties_go_to_the_lower_index_and_unused_entries_stay(spark, workspace):
    rows = [(i, [0.25] * 16) for i in range(40)]
    got = found_codes(spark, workspace, rows)
    assert {row[1:3] for row in got} == {("00" * 8, 0)} and len(got) == 40


def test_few_vectors_and_none(spark, workspace):
    rows = random_rows(3, 8)
    assert no_null(r[:3] + r[4:] for r in found_codes(spark, workspace, rows)) == no_null(plain_codes(rows, 8))
    assert found_codes(spark, workspace, []) == []
    assert found_codes(spark, workspace, BROKEN[:3]) == []
    only = found_codes(spark, workspace, [(None, [1.0] * 8)])
    assert len(only) == 1 and only[0][0] is None


def test_errors_add_up_by_label_nulls_together(spark, workspace):
    rows = random_rows(90, 64)
    labels = {i: None if i % 5 == 0 else i % 3 for i, _ in rows}
    got = found_codes(spark, workspace, rows, labels.get)
    sums = {}
    for i, _, error, _, _ in got:
        sums[labels[i]] = sums.get(labels[i], 0) + error
    assert all(total == sums[labels[i]] for i, _, _, total, _ in got)


def test_too_large_numbers_fail(spark, workspace):
    with pytest.raises(Exception, match="too large"):
        found_codes(spark, workspace, [(1, [1e300] * 8)])
    with pytest.raises(Exception, match="too large"):
        found_codes(spark, workspace, [(1, [5e5] * 64)])


def test_codebooks_decode(spark, workspace):
    rows = random_rows(80, 16)
    numbers = workspace.store(
        integers.scaled_vectors(table(spark, rows), 16, 4096, "vec_id", "embedding", "label"), "numbers"
    )
    books = codes.fit_codebooks(numbers, 16)
    vectors = np.array([v for _, v in floors(rows, 4096, 16)])
    labels, errors = books.nearest(vectors)
    back = books.decode(labels)
    assert ((vectors - back) ** 2).sum(axis=1).tolist() == errors.sum(axis=1).tolist()


# --- clusters ----------------------------------------------------------------


def found_clusters(spark, workspace, rows, **choices):
    made = va_clustering.cluster_vectors(table(spark, rows), workspace, buckets=3, **choices)
    assert made.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(tuple(row) for row in made.collect())


@pytest.mark.parametrize("bits, sample_rows", [(1, 50), (3, 10), (6, 10_000), (8, 10_000), (8, 1)])
def test_clusters_equal_plain_counting(spark, workspace, bits, sample_rows):
    rows = random_rows(130, 64) + BROKEN + [(4, random_rows(5, 64)[4][1])]
    got = found_clusters(spark, workspace, rows, bits=bits, sample_rows=sample_rows)
    assert got == plain_clusters(rows)


def test_overlapping_clusters_equal_plain_counting(spark, workspace):
    rows = random_rows(160, 64, seed=3, spread=2.0)
    assert found_clusters(spark, workspace, rows, bits=4) == plain_clusters(rows)


def test_few_equal_and_no_vectors(spark, workspace):
    rows = random_rows(3, 64)
    assert found_clusters(spark, workspace, rows) == plain_clusters(rows)
    rows = [(i, [0.5] * 64) for i in range(20)]
    assert found_clusters(spark, workspace, rows) == plain_clusters(rows)
    assert found_clusters(spark, workspace, []) == found_clusters(spark, workspace, BROKEN) == []
    made = va_clustering.cluster_vectors(table(spark, [(None, [0.5] * 64)]), workspace).collect()
    assert [tuple(row)[:5] for row in made] == [(None, 0, 0, 0, 0)]


@pytest.mark.parametrize("bits", [1, 2, 5, 8])
def test_cells_hold_their_numbers_and_survive_packing(bits):
    import pyarrow as pa

    draw = np.random.default_rng(bits)
    vectors = draw.integers(-50, 50, size=(300, 9))
    vectors[:, 4] = 7  # a dimension with one number only
    grid = va_clustering.Grid.over(vectors[:40], vectors.min(axis=0), vectors.max(axis=0), bits)
    cells = grid.cells(vectors)
    place = np.arange(9)
    assert (grid.low[place, cells] <= vectors).all() and (vectors <= grid.high[place, cells]).all()
    assert (grid.unpack(grid.pack(cells)) == cells).all()
    assert isinstance(grid.pack(cells), pa.BinaryArray)


def test_intervals_never_lose_the_nearest():
    draw = np.random.default_rng(5)
    vectors = draw.integers(-400, 400, size=(500, 12))
    centroids = draw.integers(-300, 300, size=(8, 12))
    grid = va_clustering.Grid.over(vectors, vectors.min(axis=0), vectors.max(axis=0), 6)
    possible = va_clustering.Intervals(grid, centroids).candidates(grid.cells(vectors))
    exact = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
    least = exact == exact.min(axis=1, keepdims=True)
    assert possible[least].all() and possible.sum() < possible.size / 2


def test_vectors_are_fetched_only_where_intervals_overlap(spark, workspace):
    draw = np.random.default_rng(1)
    centroids = draw.integers(-4000, 4000, size=(4, 8))
    vectors = centroids[np.arange(400) % 4] + draw.integers(-20, 20, size=(400, 8))
    grid = va_clustering.Grid.over(vectors, vectors.min(axis=0), vectors.max(axis=0), 8)
    cells = grid.pack(grid.cells(vectors))
    state = spark.createDataFrame(
        [(i, bytes(cell.as_py()), i % 4) for i, cell in enumerate(cells)], "_row bigint, _cells binary, _label int"
    )
    judged = va_clustering._judge(state, grid, centroids).collect()
    assert [row._new for row in sorted(judged)] == [i % 4 for i in range(400)]


def test_the_vector_file_is_never_shuffled(spark, workspace, plan_of):
    rows = spark.range(300).selectExpr("id AS _row", "cast('v' AS binary) AS _vector")
    file = workspace.store_bucketed(rows, "vectors", ["_row"], 4)
    wanted = spark.range(50).selectExpr("id AS _row", "cast('c' AS binary) AS _cells")
    plan = plan_of(wanted.join(file.hint("merge"), "_row"))
    assert plan.count("Exchange") == 1


# --- the registered queries --------------------------------------------------


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", ["op12_limb_codes", "op13_va_centroids"])
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    theirs = duck.execute(queries.SQL[name])
    names = [column[0] for column in theirs.description]
    ours = queries.QUERIES[name](spark, SF)
    assert ours.columns == names
    assert sorted(tuple(row) for row in ours.collect()) == sorted(theirs.fetchall())
