"""Sources, sinks and stage tables."""

import os
import subprocess
import sys
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from wordbond import (
    Workspace, collocations, count_pairs, score_pairs, select_collocations, spark_settings,
    top_collocations,
)
from wordbond.sinks import (
    collocation_lines, save_collocation_lines, save_pair_count_lines, save_pair_counts,
    save_pair_score_lines, save_pair_scores, save_top_listing,
)
from wordbond.sources import (
    load_pair_counts, load_pair_scores, read_collocation_lines, read_lines, read_ngrams,
    read_pair_count_lines, read_pair_score_lines, read_stop_words,
)
from wordbond.workspace import check_shared, shared_folder

TEXTS = [
    "strong tea\t1983\t4\t1\t1", "strong coffee\t1981\t2\t1\t1", "green tea\t1989\t6\t1\t1",
    "old ship\t1873\t4\t1\t1", "old house\t1874\t6\t1\t1", "tall ship\t1879\t5\t1\t1",
]
PARSED = sorted(
    (w1, w2, int(year), int(count)) for w1, w2, year, count in (t.replace("\t", " ").split(" ")[:4] for t in TEXTS)
)


def rows(df):
    return sorted(tuple(row) for row in df.collect())


@pytest.fixture
def counts(lines):
    return count_pairs(lines(*TEXTS), language="english")


@pytest.fixture
def selected(lines, spark):
    return collocations(spark, lines(*TEXTS), language="english", min_npmi=0.1, rel_min_npmi=0.1)


def test_text_scan_of_a_file_and_a_folder(spark, tmp_path):
    folder = tmp_path / "ngrams"
    folder.mkdir()
    (folder / "a.txt").write_text("\n".join(TEXTS[:3]) + "\n")
    (folder / "b.txt").write_text("\n".join(TEXTS[3:]) + "\n")
    assert rows(read_ngrams(spark, str(folder))) == PARSED
    assert rows(read_ngrams(spark, [str(folder / "a.txt"), str(folder / "b.txt")])) == PARSED
    assert len(rows(read_ngrams(spark, str(folder / "a.txt")))) == 3


@pytest.mark.parametrize("codec", [None, "org.apache.hadoop.io.compress.DefaultCodec"])
def test_sequence_file_scan(spark, tmp_path, codec):
    path = str(tmp_path / "sequence")
    spark.sparkContext.parallelize(list(enumerate(TEXTS)), 2).saveAsSequenceFile(path, codec)
    assert rows(read_ngrams(spark, path, format="sequence")) == PARSED
    result = collocations(
        spark, path, format="sequence", language="english", min_npmi=0.1, rel_min_npmi=0.1
    )
    assert result.count() > 0


def test_hebrew_sequence_file(spark, tmp_path):
    path = str(tmp_path / "sequence")
    spark.sparkContext.parallelize([(0, "שלום עולם\t1990\t5")], 1).saveAsSequenceFile(path)
    assert [row.value for row in read_lines(spark, path, "sequence").collect()] == ["שלום עולם\t1990\t5"]


def test_split_size_bounds_the_splits(spark, tmp_path):
    path = str(tmp_path / "big.txt")
    (tmp_path / "big.txt").write_text("strong tea\t1983\t4\t1\t1\nold ship 1984 2\n" * 10_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert read_lines(spark, path).rdd.getNumPartitions() <= 8
    seen = []
    store = Workspace.store

    def watched(self, df, name, *rest):
        if name == "pairs":
            seen.append(read_lines(spark, path).rdd.getNumPartitions())
        return store(self, df, name, *rest)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Workspace, "store", watched)
        found = collocations(
            spark, path, language="english", min_npmi=0.0, rel_min_npmi=0.0, split_size=10_000
        )
    assert seen[0] >= 20 and found.count() > 0
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    with pytest.raises(ValueError, match="spark_settings"):
        read_lines(spark, path, split_size=20_000)
    assert spark_settings(split_size=7)["spark.sql.files.maxPartitionBytes"] == "7"


def test_split_size_bounds_sequence_splits(spark, tmp_path):
    path = str(tmp_path / "sequence")
    spark.sparkContext.parallelize([(i, TEXTS[0]) for i in range(20_000)], 1).saveAsSequenceFile(path)
    whole = read_lines(spark, path, "sequence")
    split = read_lines(spark, path, "sequence", split_size=50_000)
    assert split.rdd.getNumPartitions() > whole.rdd.getNumPartitions()
    assert split.count() == whole.count() == 20_000
    assert "Python" not in split._jdf.queryExecution().executedPlan().toString()


def test_a_sequence_record_stays_one_row(spark, tmp_path, plan_of):
    texts = ["a b 1990 1", "a\nb 1991\n2", "c\rd\r\n1992 3", "", " ", "\n", "e f 1993 4 " + "x" * 3_000_000, "ש ע 1994 5"]
    path = str(tmp_path / "sequence")
    spark.sparkContext.parallelize(list(enumerate(texts)), 3).saveAsSequenceFile(path)
    scan = read_lines(spark, path, "sequence")
    assert sorted(row.value for row in scan.collect()) == sorted(texts)
    assert "Python" not in plan_of(scan) and scan.schema.simpleString() == "struct<value:string>"
    kept = read_ngrams(spark, path, format="sequence", mode="DROPMALFORMED")
    assert rows(kept) == [("a", "b", 1990, 1), ("a", "b", 1991, 2), ("c", "d", 1992, 3), ("e", "f", 1993, 4), ("ש", "ע", 1994, 5)]


def test_a_sequence_scan_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "sequence")
    spark.sparkContext.parallelize([(0, TEXTS[0])]).saveAsSequenceFile(path)
    made = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Workspace, "__init__", lambda self, *args: made.append(args))
        assert read_ngrams(spark, path, format="sequence").count() == 1
    assert not made


def test_stop_words_by_language(spark, tmp_path):
    (tmp_path / "eng_stop_words.txt").write_text("the\nof\r\nand")
    (tmp_path / "heb_stop_words.txt").write_text("של\nעל\n", encoding="utf-8")
    assert rows(read_stop_words(spark, str(tmp_path), "english")) == [("and",), ("of",), ("the",)]
    assert rows(read_stop_words(spark, str(tmp_path), "hebrew")) == [("על",), ("של",)]
    assert len(rows(read_stop_words(spark, str(tmp_path / "eng_stop_words.txt")))) == 3


def test_saved_counts_and_scores_go_on_from_there(spark, counts, tmp_path):
    save_pair_counts(counts, str(tmp_path / "counts"))
    loaded = load_pair_counts(spark, str(tmp_path / "counts"))
    assert rows(loaded.select(counts.columns)) == rows(counts)
    direct, resumed = score_pairs(counts), score_pairs(loaded, stored=True)
    assert rows(resumed.select(direct.columns)) == rows(direct)

    save_pair_scores(direct, str(tmp_path / "scores"))
    scores = load_pair_scores(spark, str(tmp_path / "scores"))
    assert rows(scores.select(direct.columns)) == rows(direct)
    assert rows(select_collocations(scores, min_npmi=0.1, rel_min_npmi=0.1, stored=True).select("w1", "w2")) == rows(
        select_collocations(direct, min_npmi=0.1, rel_min_npmi=0.1).select("w1", "w2")
    )


def test_a_decade_filter_prunes_saved_folders(spark, counts, tmp_path, plan_of):
    save_pair_counts(counts, str(tmp_path / "counts"))
    assert sorted(p for p in os.listdir(tmp_path / "counts") if p[0] == "d") == ["decade=1870", "decade=1980"]
    one = load_pair_counts(spark, str(tmp_path / "counts")).filter("decade = 1870")
    assert "PartitionFilters: [isnotnull(decade" in plan_of(one) and one.count() == 3


def test_stage_lines(spark, counts, tmp_path):
    save_pair_count_lines(counts, str(tmp_path / "counts"))
    written = [row.value for row in spark.read.text(str(tmp_path / "counts")).collect()]
    assert "1980,green,tea\t6,12,6" in written
    loaded = read_pair_count_lines(spark, str(tmp_path / "counts"))
    assert rows(loaded) == rows(counts)

    scores = score_pairs(loaded, stored=True)
    save_pair_score_lines(scores, str(tmp_path / "scores"))
    again = read_pair_score_lines(spark, str(tmp_path / "scores"))
    assert rows(again) == rows(scores.select("decade", "w1", "w2", "npmi"))


@pytest.mark.parametrize("tab", [False, True])
def test_result_lines(spark, selected, tmp_path, tab):
    save_collocation_lines(selected, str(tmp_path / "result"), trailing_tab=tab)
    files = sorted(p for p in os.listdir(tmp_path / "result") if p.startswith("part-"))
    text = "".join((tmp_path / "result" / p).read_text() for p in files).splitlines()
    assert text == [row.value for row in collocation_lines(selected, tab).collect()]
    assert text[0].startswith("1870 tall ship 0.4") and text[0].endswith("\t") == tab
    loaded = read_collocation_lines(spark, str(tmp_path / "result"))
    assert rows(loaded) == rows(selected.select("decade", "w1", "w2", "npmi"))


def test_small_scores_keep_their_exact_value(spark, tmp_path):
    scores = spark.createDataFrame([(1980, "a", "b", 5.0e-4), (1980, "c", "d", -1.25e-12)],
                                   "decade int, w1 string, w2 string, npmi double")
    save_collocation_lines(scores, str(tmp_path / "result"))
    assert "1980 a b 5.0E-4" in [row.value for row in spark.read.text(str(tmp_path / "result")).collect()]
    assert rows(read_collocation_lines(spark, str(tmp_path / "result"))) == rows(scores)


def test_top_listing_is_one_ordered_file(selected, tmp_path):
    top = top_collocations(selected, 2, 0.99)
    save_top_listing(top, str(tmp_path / "top"), single_file=True)
    files = [p for p in os.listdir(tmp_path / "top") if p.startswith("part-")]
    assert len(files) == 1
    assert (tmp_path / "top" / files[0]).read_text().splitlines() == [
        row.value for row in collocation_lines(top).collect()
    ]


def test_listing_is_ordered_over_its_files(selected, tmp_path):
    save_top_listing(selected, str(tmp_path / "top"))
    files = sorted(p for p in os.listdir(tmp_path / "top") if p.startswith("part-"))
    text = "".join((tmp_path / "top" / p).read_text() for p in files).splitlines()
    assert text == [row.value for row in collocation_lines(selected).collect()]


def test_stage_tables_live_in_the_shared_folder_until_dropped(spark, tmp_path):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    with Workspace(spark, str(tmp_path)) as workspace:
        stored = workspace.store(spark.range(5).toDF("n"), "numbers")
        assert workspace.path.startswith(str(tmp_path)) and stored.count() == 5
        assert os.path.isdir(workspace.path)
    assert not os.path.exists(workspace.path)


def test_a_listing_runs_its_plan_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    rows = spark.range(5, numPartitions=1).selectExpr("1980 AS decade", "'a' AS w1", "cast(id AS string) AS w2", "0.5D AS npmi")
    save_top_listing(rows.mapInArrow(count, rows.schema).coalesce(1), str(tmp_path / "one"), single_file=True)
    assert runs.value == 5


SCRIPT = """
import sys
from pyspark.sql import SparkSession
from wordbond import Workspace, collocations
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
lines = spark.createDataFrame([("a b 1990 1",), ("c d 1990 2",)], "value string")
assert collocations(spark, lines, language="english", min_npmi=0.0, rel_min_npmi=0.0).count() == 2
import os
assert [name for name in os.listdir(sys.argv[1]) if name.startswith("wordbond-")]
"""


def test_nothing_is_left_once_the_driver_ends(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run(
        [sys.executable, "-c", SCRIPT, str(tmp_path)], check=True, timeout=240, capture_output=True,
        env=os.environ | {"PYTHONPATH": root}, cwd=str(tmp_path),
    )
    assert not [name for name in os.listdir(tmp_path) if name.startswith("wordbond-")]


@pytest.mark.parametrize("master", ["yarn", "k8s://host", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_warehouse_of_one_machine_is_refused_on_a_cluster(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        check_shared("file", master)
    check_shared("hdfs", master)


def test_a_session_without_a_shared_folder_is_refused():
    class Session:
        class sparkContext:
            master = "yarn"

            @staticmethod
            def getCheckpointDir():
                return None

        class conf:
            @staticmethod
            def get(name, default=None):
                return {"spark.sql.warehouse.dir": "file:/home/me/spark-warehouse"}.get(name, default)

    with pytest.raises(ValueError, match="one machine"):
        shared_folder(Session())
    Session.sparkContext.master = "local[2]"
    assert shared_folder(Session()) == "file:/home/me/spark-warehouse/_stages"


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_a_warehouse_of_one_machine_serves_one_machine(master):
    check_shared("file", master)


def test_bucketed_tables_join_in_place(spark, tmp_path, plan_of):
    with Workspace(spark, str(tmp_path)) as workspace:
        detail = spark.range(5000).selectExpr("id % 70 AS k", "id AS n")
        stored = workspace.store_bucketed(detail, "detail", ["k"], buckets=4, sort=["k", "n"])
        totals = stored.groupBy("k").count()
        joined = stored.join(totals.hint("merge"), "k")
        assert "Exchange" not in plan_of(joined)
        assert joined.count() == 5000 and joined.agg({"count": "sum"}).first()[0] == sum(
            (5000 // 70 + (k < 5000 % 70)) ** 2 for k in range(70)
        )
        names = [t.name for t in spark.catalog.listTables() if t.name.startswith("wordbond_")]
        assert names
    assert not [t.name for t in spark.catalog.listTables() if t.name in names]


def _encodings(path):
    found = {}
    for file in Path(path).rglob("*.parquet"):
        for group in range((meta := pq.ParquetFile(file).metadata).num_row_groups):
            for column in (meta.row_group(group).column(n) for n in range(meta.num_columns)):
                found.setdefault(column.path_in_schema, set()).update(column.encodings)
    return found


def test_pairs_and_scores_are_stored_without_a_dictionary(spark, tmp_path):
    lines = spark.createDataFrame([(f"a{chr(97 + i % 26)} b{chr(97 + i % 7)} 1990 {i + 1}",) for i in range(60)], "value string")
    with Workspace(spark, str(tmp_path)) as workspace:
        kept = collocations(
            spark, lines, language="english", min_npmi=0.0, rel_min_npmi=0.0, ordered=False, workspace=workspace
        )
        assert kept.count()
        tables = {name.split("-", 1)[1]: _encodings(f"{workspace.path}/{name}") for name in os.listdir(workspace.path)}
        for name in ("pairs", "scores"):
            assert {"w1", "w2"} <= set(tables[name])
            assert not any("DICTIONARY" in kind for kinds in tables[name].values() for kind in kinds)
