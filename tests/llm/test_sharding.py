"""Sharding: counts level, slots gapless, equal texts together."""

import zlib
from collections import Counter, defaultdict

import pytest

from wordbond.llm import queries, sharding

SF = "/root/testdata/sf0.001"


def table(spark, rows):
    schema = "doc_id bigint, text string, shard string, slot string, rows int, _group string"
    return spark.createDataFrame([(i, t, "a", "b", 1, "c") for i, t in rows], schema)


def check(found, rows, shards):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in found) == sorted(
        (str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots = defaultdict(list)
    for r in found:
        assert (r.law, r.grown_shard) == ("rows", None) and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    counts = [len(slots[shard]) for shard in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(held) == list(range(len(held))) for held in slots.values())
    return counts


def places(found):
    by_text = defaultdict(Counter)
    for r in found:
        by_text[r.text_crc32, r.size][r.shard] += 1
    return by_text


@pytest.mark.parametrize("count", [0, 1, 5, 24, 25, 400])
def test_counts_are_level(spark, workspace, count):
    rows = [(i, f"text {i}") for i in range(count)]
    check(sharding.shard_documents(table(spark, rows), workspace).collect(), rows, 24)


def test_equal_texts_end_up_together(spark, workspace):
    rows = [(i, f"text {i % 60}" if i < 300 else f"alone {i}") for i in range(2000)]
    found = sharding.shard_documents(table(spark, rows), workspace).collect()
    check(found, rows, 24)
    assert all(len(shards) == 1 for shards in places(found).values())


def test_a_group_larger_than_a_shard_takes_few_shards(spark, workspace):
    rows = [(i, "hot" if i % 3 == 0 else f"pair {i // 8}" if i % 8 < 2 else f"alone {i}") for i in range(1200)]
    found = sharding.shard_documents(table(spark, rows), workspace, shards=10).collect()
    check(found, rows, 10)
    hot, *others = sorted(places(found).values(), key=lambda c: -sum(c.values()))
    assert sum(hot.values()) == 400 and sum(n for _, n in hot.most_common(4)) > 340
    assert sum(len(shards) > 1 for shards in others) <= 10


def test_quotas_let_full_shards_swap():
    flows = {(0, 1): 10.0, (1, 0): 30.0}
    quota = sharding._quotas(flows, [0, 0, 5])
    assert quota[1] == 1 and quota[0] == pytest.approx(1 / 3)
    assert sharding._quotas({(0, 1): 8.0}, [0, 2]) == [0, 0.25]


def test_odd_rows(spark, workspace):
    rows = [(None, None), (None, ""), (1, "é"), (1, "é"), (1, "é"), (2, "x" * 200_000), (3, None)]
    check(sharding.shard_documents(table(spark, rows), workspace, shards=3).collect(), rows, 3)


def test_everything_linked(spark, workspace):
    rows = [(i, f"text {i % 7}") for i in range(500)]
    check(sharding.shard_documents(table(spark, rows), workspace, shards=6).collect(), rows, 6)


def test_query(spark, plan_of):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op6_label_propagation_shards(spark, SF)
    assert "Python" not in plan_of(found) and "Arrow" not in plan_of(found)
    found = found.collect()
    check(found, rows, 24)
    # A shard holds 8 or 9 documents here, so a pair may find no room.
    assert sum(len(shards) > 1 for shards in places(found).values()) <= 1
