"""Work that follows the size of the input, not how its files happen to be cut."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from wordbond import Workspace, collocations
from wordbond.plans import clean_ngrams, score_ngrams
from wordbond.sinks import save_sequence_lines
from wordbond.sources import document_bigrams, documents, read_lines


def rows(df):
    return sorted(tuple(row) for row in df.collect())


@pytest.fixture
def one_group(spark, tmp_path):
    """Documents in one file of one row group, which one task reads."""
    texts = [(n, f"w{n % 7} w{n % 5} w{n % 3} w{n % 2}") for n in range(4000)]
    spark.createDataFrame([*texts, (4000, ""), (4001, None), (None, "a b")], "doc_id bigint, text string").coalesce(
        1
    ).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


@pytest.fixture
def stored_as(monkeypatch):
    """What is stored under each name: ``(name, DataFrame)``."""
    seen, store = [], Workspace.store
    monkeypatch.setattr(
        Workspace, "store", lambda self, df, name, *rest: seen.append((name, df)) or store(self, df, name, *rest)
    )
    return seen


def test_texts_of_one_row_group_are_cut_by_all_tasks(spark, one_group, plan_of):
    documents = spark.read.parquet(f"{one_group}/documents.parquet")
    bigrams = document_bigrams(documents)
    plan = plan_of(bigrams)
    assert plan.index("Generate") < plan.index("REPARTITION_BY_NUM")  # the texts move before they are cut
    assert "REPARTITION_BY_NUM" not in plan_of(document_bigrams(documents, spread=0))
    assert ", 3), REPARTITION_BY_NUM" in plan_of(document_bigrams(documents, spread=3))
    whole, unmoved = (map(str, table.collect()) for table in (bigrams, document_bigrams(documents, spread=0)))
    assert sorted(whole) == sorted(unmoved)
    assert bigrams.agg(F.sum("match_count")).first()[0] == 3 * 4000 + 1
    dealt = documents.repartition(8, F.monotonically_increasing_id()).groupBy(F.spark_partition_id()).count()
    sizes = [row["count"] for row in dealt.collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_a_task_takes_many_splits(spark, tmp_path, plan_of, stored_as):
    path = str(tmp_path / "big.txt")
    (tmp_path / "big.txt").write_text("strong tea\t1983\t4\t1\t1\nold ship 1984 2\ngreen tea 1985 3\n" * 5_000)
    choices = dict(language="english", stop_words=["old"], min_npmi=0.0, rel_min_npmi=0.0)
    whole = rows(collocations(spark, path, **choices))
    stored_as.clear()
    assert rows(collocations(spark, path, split_size=2_000, **choices)) == whole
    pairs = next(df for name, df in stored_as if name == "pairs")
    plan = plan_of(pairs)
    assert plan.index("BroadcastHashJoin") < plan.index("Coalesce 8") < plan.index("Scan text")
    assert "Coalesce" not in plan_of(clean_ngrams(read_lines(spark, path), ["old"], language="english"))
    assert rows(score_ngrams(read_lines(spark, path), ["old"], language="english", split_size=2_000)) == rows(
        score_ngrams(read_lines(spark, path), ["old"], language="english")
    )


@pytest.mark.parametrize("name", ["ngram_scan_gzip", "sequence_scan"])
def test_lines_are_counted_once_and_by_all_tasks(spark, plan_of, stored_as, name):
    found = spark_entry.queries()[name](spark, "/root/testdata/sf0.001")
    assert [stored for stored, _ in stored_as] == ["lines"]
    assert "Coalesce" not in plan_of(stored_as[0][1]) and found.count() > 0


def test_sequence_files_are_written_without_python(spark, tmp_path, lines):
    texts = ["a b 1990 1", "a\nb 1991\n2", "c\rd\r\n1992 3", "", " ", "ש ע 1994 5", "e f 1993 4 " + "x" * 300_000]
    path, old = str(tmp_path / "new"), str(tmp_path / "old")
    save_sequence_lines(lines(*texts).repartition(3), path)
    spark.sparkContext.parallelize([(0, text) for text in texts], 3).saveAsSequenceFile(old)
    assert sorted(spark.sparkContext.sequenceFile(path).collect()) == sorted(spark.sparkContext.sequenceFile(old).collect())
    assert sorted(row.value for row in read_lines(spark, path, "sequence").collect()) == sorted(texts)
    written = next(file for file in (tmp_path / "new").iterdir() if file.name.startswith("part-"))
    assert written.read_bytes()[:60].split(b"org.apache.hadoop.io.")[1:][0].startswith(b"IntWritable")


def test_names_of_workspaces_that_are_gone_leave_the_catalogue(spark, tmp_path):
    def stored():
        return Workspace(spark, str(tmp_path)).store_bucketed(spark.range(100), "numbers", ["id"], buckets=2)

    def names():
        return {table.name for table in spark.catalog.listTables()}

    before, first = names(), stored()
    (name,) = names() - before
    assert stored().count() == 100 and name not in names()
    assert first.filter("id % 2 = 0").count() == 50  # reads files, not names


def test_a_years_pairs_are_counted_where_its_texts_are(spark, one_group, plan_of):
    texts = spark.read.parquet(f"{one_group}/documents.parquet")
    bigrams = document_bigrams(texts)
    assert plan_of(bigrams).count("Exchange") == 1  # of texts: no pair is shuffled
    assert rows(bigrams.filter("year IS NOT NULL")) == rows(document_bigrams(texts, spread=0).filter("year IS NOT NULL"))


@pytest.mark.parametrize("year_bytes, exchanges", [(100, 1), (10, 2)])
def test_large_years_are_counted_in_parts_or_by_pairs(spark, one_group, plan_of, monkeypatch, year_bytes, exchanges):
    texts = spark.read.parquet(f"{one_group}/documents.parquet").filter("doc_id IS NOT NULL")  # 200 bytes a year
    whole = rows(document_bigrams(texts, spread=0))
    monkeypatch.setattr(documents, "YEAR_BYTES", year_bytes)
    bigrams = document_bigrams(texts)
    assert plan_of(bigrams).count("Exchange") == exchanges and rows(bigrams) == whole
    assert bigrams.columns == ["w1", "w2", "year", "match_count"]


def test_one_year_is_counted_by_all_tasks(spark, one_group, plan_of):
    texts = spark.read.parquet(f"{one_group}/documents.parquet")
    bigrams = document_bigrams(texts, year=F.lit(1990))
    assert plan_of(bigrams).count("Exchange") == 2
    assert rows(bigrams) == rows(document_bigrams(texts, year=F.lit(1990), spread=0))
    assert document_bigrams(texts.limit(0)).count() == 0
