"""SimHash and exact deduplication against brute force."""

import hashlib
import random
import re

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from wordbond import JoinLimits
from wordbond.llm import components, exact_dedup, queries, simhash

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, _hash string, fp string, rows int, u int"


def table(spark, rows):
    """Documents with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, "x", "y", 1, 2) for i, t in rows], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_fingerprint(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    cut = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or (
        [" ".join(words)] if words else []
    )
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in cut]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def brute_components(rows, distance=4):
    prints = {i: brute_fingerprint(t) for i, t in rows}
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {(i, f"{prints[i]:016x}", find(i)) for i in ids}


def near_texts():
    draw = random.Random(3)
    base = [f"w{draw.randrange(900)}" for _ in range(400)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "a b c"), (6, "É b c d e")]
    for i in range(7, 40):
        words = list(base)
        for _ in range(draw.randrange(6)):
            words[draw.randrange(400)] = "changed"
        rows.append((i, " ".join(words)))
    rows.append((40, "long " * 1_200_000 + "end"))
    rows += [(i, " ".join(f"v{draw.randrange(10**6)}" for _ in range(30))) for i in range(41, 60)]
    return rows


def test_fingerprints_of_blocks_equal_whole_texts(monkeypatch):
    text = " ".join(f"Word{i % 37}x{i % 11}" for i in range(500))
    expected = brute_fingerprint(text)
    monkeypatch.setattr(simhash, "_BLOCK", 64)
    monkeypatch.setattr(simhash, "_HASHES", 7)
    assert int(simhash.simhash([text.encode(), b""], 2)[0]) % 2**64 == expected


def test_simhash_groups_equal_brute_force(spark, workspace):
    rows, name = near_texts(), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    found = simhash.simhash_groups(table(spark, rows), workspace)
    assert {tuple(r) for r in found.collect()} == brute_components(rows)
    assert spark.conf.get(name) == before


def test_simhash_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = queries.op1_simhash_near_dedup(spark, SF).collect()
    assert {tuple(r) for r in found} == brute_components([tuple(r) for r in rows])


@pytest.mark.parametrize("distance, segments", [(0, 3), (1, 2), (4, 2), (4, 3), (4, 5), (6, 4)])
def test_hamming_balls_find_every_pair(spark, distance, segments):
    draw = random.Random(distance * 10 + segments)
    centre = draw.getrandbits(64)
    prints = {centre} | {draw.getrandbits(64) for _ in range(50)}
    for _ in range(150):
        flipped = centre
        for bit in draw.sample(range(64), draw.randrange(8)):
            flipped ^= 1 << bit
        prints.add(flipped)
    signed = sorted(p - 2**64 if p >> 63 else p for p in prints)
    fps = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    found = {frozenset(r) for r in simhash.near_fingerprints(fps, distance, segments).collect()}
    assert found == {
        frozenset((a, b)) for a in signed for b in signed
        if a < b and ((a ^ b) % 2**64).bit_count() <= distance
    }


def test_components_of_a_path_a_star_and_a_cycle(spark, workspace):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)]
    edges += [(200, 201), (201, 202), (202, 200), (300, 300)]
    found = components.components(spark.createDataFrame(edges, "a int, b int"), workspace)
    expected = {(i, 0) for i in range(1, 51)} | {(i, 100) for i in range(101, 160)}
    assert {tuple(r) for r in found.collect()} == expected | {(201, 200), (202, 200)}


def test_empty_tables(spark, workspace):
    empty = table(spark, [])
    assert simhash.simhash_groups(empty, workspace).collect() == []
    assert simhash.drop_near_copies(empty, workspace).collect() == []
    assert exact_dedup.exact_groups(empty, workspace).collect() == []
    assert exact_dedup.drop_exact_copies(empty, workspace).columns == empty.columns


def test_one_document_of_a_near_group_stays(spark, workspace):
    rows = near_texts()
    kept = simhash.drop_near_copies(table(spark, rows), workspace)
    assert kept.columns == ["doc_id", "text", "_hash", "fp", "rows", "u"]
    assert {r.doc_id for r in kept.collect()} == {root for _, _, root in brute_components(rows)}


ROWS = [
    (1, "Same"), (2, "same"), (3, "SAME"), (4, "other"), (5, None), (6, ""), (7, "É"), (8, "é"),
    (9, "same "), (4, "other"), (4, "OTHER"), (None, "same"), (10, "x" * 300_000), (11, "X" * 300_000),
]


def weak_hash(body):
    return F.unhex(F.substring(F.md5(body), 1, 1))


SPLIT = JoinLimits(broadcast_bytes=0, split_rows=2)


@pytest.mark.parametrize("limits", [JoinLimits(), SPLIT], ids=["broadcast", "split"])
@pytest.mark.parametrize("hash_of", [exact_dedup.content_hash, weak_hash, lambda body: F.unhex(F.lit("00"))])
def test_exact_groups_equal_brute_force(spark, workspace, hash_of, limits):
    how = {"hash_of": hash_of, "limits": limits}
    found = exact_dedup.exact_groups(table(spark, ROWS), workspace, **how).collect()
    groups = {}
    for i, text in ROWS:
        groups.setdefault(lower(text), []).append(-1 if i is None else i)
    assert sorted(map(str, ((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found))) == sorted(
        map(str, ((i, max(groups[lower(t)]), len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest())
            for i, t in ROWS))
    )
    assert sum(r.kept for r in found) == len(groups)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)
    stay = exact_dedup.drop_exact_copies(table(spark, ROWS), workspace, **how).collect()
    assert sorted((r.doc_id, lower(r.text)) for r in stay) == sorted((max(ids), t) for t, ids in groups.items())


def test_exact_query_equals_sql(spark):
    found = queries.op2_exact_dedup(spark, SF)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rows = duck.execute(queries.SQL["op2_exact_dedup"]).fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(rows)


def test_exact_dedup_is_native(spark, plan_of):
    plan = plan_of(queries.op2_exact_dedup(spark, SF))
    assert "Python" not in plan and "Arrow" not in plan


def test_near_copies_with_repeated_and_null_ids_are_decided_row_by_row(spark, workspace):
    draw = random.Random(5)
    a, b, c, d, e = (" ".join(f"{kind}{draw.randrange(900)}" for _ in range(60)) for kind in "abcde")
    assert len({root for _, _, root in brute_components(list(enumerate([a, b, c, d, e])))}) == 5
    rows = [(3, a.upper()), (5, a), (5, b),  # 5 goes with a, and stays with b
            (7, c), (7, c.upper()), (8, c), (7, c),  # the smallest id repeats
            (None, d), (None, d), (None, e), (9, e),  # groups with null ids
            (5, d + " x"), (11, "alone")]
    kept = simhash.drop_near_copies(table(spark, rows), workspace)
    assert kept.columns == table(spark, []).columns
    prints = [brute_fingerprint(text) for _, text in rows]
    near = (prints[7] ^ prints[11]).bit_count() <= 4
    expected = [(3, a), (5, b), (7, c), (5, d + " x"), (9, e), (11, "alone")] + [(None, d)] * (not near)
    found = [(r.doc_id, r.text.lower()) for r in kept.collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_rows_without_any_id_keep_one_of_each_group(spark, workspace):
    rows = [(None, "one two three four"), (None, "One Two Three Four"), (None, "five six seven eight nine")]
    kept = simhash.drop_near_copies(table(spark, rows), workspace)
    assert sorted(r.text.lower() for r in kept.collect()) == ["five six seven eight nine", "one two three four"]
