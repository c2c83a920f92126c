"""The pipeline against its stages done by hand."""

import pytest

import __spark_entry__ as spark_entry
import corpus_pipeline
from wordbond import JoinLimits, Workspace
from wordbond.llm import exact_dedup, toxicity

from .test_dedup import brute_components, lower
from .test_tokens import check_packed

SF = "/root/testdata/sf0.001"


def by_hand(spark, docs, sf_dir, workspace):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), workspace)
    toxic = {r.doc_id for r in toxicity.score_toxicity(docs, model).collect() if r.predicted}
    best = {}
    for i, text in rows:
        if i not in toxic:
            best[lower(text)] = max(i, best.get(lower(text), i))
    kept = {i for i in best.values()}
    single = [(i, t) for i, t in rows if i in kept]
    roots = {root for _, _, root in brute_components(single)}
    return toxic, [(i, t) for i, t in single if i in roots]


def test_run_equals_its_stages_by_hand(spark, workspace):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    _, kept = by_hand(spark, docs, SF, workspace)
    assert 100 < len(kept) < docs.count()
    check_packed(spark_entry.queries()["pipeline"](spark, SF).collect(), kept, 4096)


def test_stages_take_odd_tables(spark, workspace, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, _hash int, fp string, rows int, _toxic int"
    odd = [(1, None, "en", "s", 1, 2, "f", 3, 4), (2, "", None, None, None, None, None, None, None),
           (3, "Same Text", "en", "s", 1, 2, "f", 3, 4), (4, "same text", "en", "s", 1, 2, "f", 3, 4),
           (4, "same text", "en", "s", 1, 2, "f", 3, 4), (5, "word " * 200_000, "en", "s", 1, 2, "f", 3, 4)]
    spark.createDataFrame([(1, 1, 0), (3, 0, 0), (5, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    for rows, expected in ((odd, [[1, 2, 3, 4, 4, 5], [2, 4, 5], [2, 4, 5]]), ([], [[], [], []])):
        docs = spark.createDataFrame(rows, schema)
        for (name, stage), ids in zip(corpus_pipeline.STAGES[:-1], expected):
            docs = workspace.store(stage(spark, docs, str(tmp_path)), name)
            assert docs.columns == [f.split()[0] for f in schema.split(", ")]
            assert sorted(r.doc_id for r in docs.collect()) == ids, name
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert {r.doc_id for r in packed} == set(expected[-1])


OWN = [
    "_hash", "_body", "_row", "_keep", "_top", "_all", "_id", "_text", "rows", "_n", "_sha256", "_parts", "_salt",
    "copies", "group_size", "_gone", "_unclear", "_stays", "_print", "_own", "_first", "fp", "root", "least",
    "component_id", "score", "_md5", "_toxic", "_good",
]


@pytest.mark.parametrize("repeated", [False, True])
@pytest.mark.parametrize("limits", [None, JoinLimits(broadcast_bytes=0, split_rows=2)])
def test_stages_keep_the_values_of_columns_named_like_their_own(spark, workspace, tmp_path, repeated, limits):
    texts = {1: "same text here", 2: "Same Text Here", 3: "SAME TEXT HERE", 4: "another text, alone", 5: None, 6: "a b c d e f"}
    rows = [(i, text) for i, text in texts.items()] + [(3, "same text here"), (6, "quite other words than that")] * repeated
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "doc_id * 7 AS n_chars",
        *[f"cast(doc_id * 100 + {n} AS int) AS `{name}`" for n, name in enumerate(OWN)],
    )
    spark.createDataFrame([(1, 1, 0), (4, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )

    def plain(found):
        return sorted(repr(tuple(row)) for row in found.collect())

    given = plain(docs)
    stages = [stage for _, stage in corpus_pipeline.STAGES[:-1]]
    if limits is not None:
        stages[1] = lambda spark, docs, sf_dir: exact_dedup.drop_exact_copies(docs, Workspace(spark), limits=limits)
    for place, stage in enumerate(stages):
        found = stage(spark, docs, str(tmp_path))
        assert found.dtypes == docs.dtypes
        kept = plain(found)
        assert set(kept) <= set(given)
        ids = sorted(row.doc_id for row in found.select("doc_id").collect())
        again = ([3, 6], [6], [6])[place] if repeated else []  # of two equal rows one stays
        assert ids == sorted(([1, 2, 3, 4, 5, 6], [3, 4, 5, 6], [1, 4, 5, 6])[place] + again)


def test_every_operator_and_the_pipeline_are_registered():
    names = [name.split("_")[0] for name in spark_entry.queries() if name.startswith("op") and name[2].isdigit()]
    assert names == [f"op{n}" for n in range(1, 14)]
    assert "pipeline" in spark_entry.queries()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "simhash_near_dedup", "best_fit_packing"
    ]


@pytest.mark.parametrize("stage", [0, 1, 2])
def test_stages_keep_the_columns_of_documents(spark, workspace, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert corpus_pipeline.STAGES[stage][1](spark, docs, SF).columns == docs.columns
