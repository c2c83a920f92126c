"""Bad parameters raise before any work, and plans stay inside the JVM."""

import pytest

import __spark_entry__ as spark_entry
from wordbond import (
    Workspace, clean_ngrams, collocations, count_pairs, select_collocations, top_collocations,
)
from wordbond.operators import drop_stop_words, running_npmi_totals
from wordbond.sources import read_collocation_lines, read_lines, split_ngrams

GOOD = dict(language="english", min_npmi=0.5, rel_min_npmi=0.2)


@pytest.mark.parametrize("bad", [
    dict(language="french"), dict(language="English"), dict(min_npmi=-0.1), dict(rel_min_npmi=-0.1),
    dict(min_npmi=float("nan")), dict(fraction=-0.1), dict(fraction=1.1), dict(mode="IGNORE"),
    dict(total_scope="century"), dict(sample_by="day"), dict(buckets=0, total_scope="running"),
])
def test_bad_values(spark, lines, bad):
    with pytest.raises(ValueError):
        collocations(spark, lines("a b 1990 1", "c d 1990 2"), **{**GOOD, **bad})


@pytest.mark.parametrize("missing", GOOD)
def test_required_values(spark, lines, missing):
    with pytest.raises(TypeError):
        collocations(spark, lines("a b 1990 1"), **{k: v for k, v in GOOD.items() if k != missing})


def test_bad_formats(spark):
    with pytest.raises(ValueError):
        read_lines(spark, "somewhere", format="zip")
    with pytest.raises(ValueError):
        read_lines(spark, "somewhere", split_size=0)


def test_bad_counts(spark):
    scores = spark.createDataFrame([], "decade int, w1 string, w2 string, npmi double")
    with pytest.raises(ValueError):
        top_collocations(scores, -1)
    with pytest.raises(ValueError):
        select_collocations(scores, min_npmi=-1, rel_min_npmi=0)


def test_without_a_named_folder_stages_go_to_the_warehouse():
    from wordbond import workspace

    class Session:
        class sparkContext:
            @staticmethod
            def getCheckpointDir():
                return None

        class conf:
            @staticmethod
            def get(name, default=None):
                return {"spark.sql.warehouse.dir": "hdfs:/warehouse/"}.get(name, default)

    assert workspace.shared_folder(Session()) == "hdfs:/warehouse/_stages"


def test_sessions_that_hide_overflow_are_refused(spark, lines):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for call in (lambda: count_pairs(lines("a b 1990 1"), language="english"),
                     lambda: read_collocation_lines(spark, "somewhere")):
            with pytest.raises(ValueError, match="ansi"):
                call()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_a_single_string_is_no_list_of_stop_words(spark, lines):
    with pytest.raises(TypeError, match="single string"):
        drop_stop_words(split_ngrams(lines("the x 1990 1")), "the")


def test_no_python_in_the_plans(spark, lines, plan_of):
    workspace = Workspace(spark)
    result = collocations(
        spark, lines("a b 1990 1", "c d 1990 2"), stop_words=["the"], workspace=workspace, **GOOD
    )
    cleaned = clean_ngrams(lines("a b 1990 1"), ["the"], language="english")
    counts = count_pairs(lines("a b 1990 1"), language="english")
    for df in (result, cleaned, counts, top_collocations(result, 3, workspace=workspace)):
        plan = plan_of(df)
        assert "Python" not in plan and "ArrowEval" not in plan


def test_each_record_is_split_once(lines, plan_of):
    plan = plan_of(clean_ngrams(lines("a b 1990 1"), ["the"], language="english"))
    assert plan.count("split(") == 1


def test_pair_tables_are_never_windowed(spark, plan_of):
    for name in ("collocations", "threshold_filter_running", "left_marginal", "npmi", "npmi_in_two_steps"):
        result = spark_entry.queries()[name](spark, "/root/testdata/sf0.001")
        assert "Window" not in plan_of(result)


def test_running_totals_need_buckets(spark):
    totals = spark.createDataFrame([], "decade int, total_npmi double, rows bigint")
    with pytest.raises(ValueError):
        running_npmi_totals(totals, 0)
