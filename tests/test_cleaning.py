"""Tokenising, word filters, stop words, malformed rows and sampling."""

import pytest
from pyspark.sql import functions as F

from wordbond import clean_ngrams
from wordbond.operators import (
    drop_stop_words, keep_language, reject_malformed, sample_rows, sample_rows_by_hash, with_decade,
)
from wordbond.sources import as_lines, document_bigrams, read_ngrams, split_ngrams
from wordbond.sources.ngrams import _records


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def clean(lines, *texts, **choices):
    return rows(clean_ngrams(lines(*texts), **{"language": "english", **choices}))


def fails(lines, *texts, **choices):
    with pytest.raises(Exception, match="malformed n-gram row"):
        clean(lines, *texts, **choices)
    return True


def test_split_takes_four_columns_on_any_whitespace(lines):
    assert rows(split_ngrams(lines("a b\t1990\t5\t1\t1", "c  d \t 1991   6", "e f g 1992 7"))) == [
        ("a", "b", 1990, 5), ("c", "d", 1991, 6), ("e f", "g", 1992, 7),
    ]


def test_extra_columns_are_ignored(lines):
    assert clean(lines, "a b 1990 5 what ever else") == [(1990, "a", "b", 5)]


def test_english_is_folded_before_the_alphabet_test(lines):
    # The Kelvin sign has a plain k as its lower case.
    kept = clean(lines, "Tea CUP 1990 1", "King cup 1990 2", "café cup 1990 3", "it's so 1990 4")
    assert kept == [(1990, "king", "cup", 2), (1990, "tea", "cup", 1)]


def test_hebrew_is_not_folded_and_takes_letters_only(lines):
    texts = ["שלום עולם 1990 1", "שלום world 1990 2", "שָלום עולם 1990 3", "tea cup 1990 4"]
    assert clean(lines, *texts, language="hebrew") == [(1990, "שלום", "עולם", 1)]


def test_word_with_a_line_break_is_not_in_the_alphabet(spark):
    table = spark.createDataFrame([("tea\n", "cup", 1990, 1)], "w1 string, w2 string, year int, match_count bigint")
    assert rows(keep_language(table, "english")) == []


def test_leading_blank_gives_an_empty_word_that_is_dropped(lines):
    assert clean(lines, " foo 1990 5", "a b 1990 1") == [(1990, "a", "b", 1)]


@pytest.mark.parametrize("year, decade", [("1990", 1990), ("1999", 1990), ("2000", 2000), ("7", 0), ("850", 850)])
def test_decade(lines, year, decade):
    assert clean(lines, f"a b {year} 5") == [(decade, "a", "b", 5)]


def test_decade_stays_an_integer(lines):
    assert dict(with_decade(split_ngrams(lines("a b 1990 1"))).dtypes)["decade"] == "int"


@pytest.mark.parametrize("bad", [
    "", " ", "foo", "foo ", "foo bar 1990", "foo bar 1990 ", "foo bar baz 1990 5",
    "foo bar 1990 0", "foo bar 1990 -2", "foo bar 1990 many", "foo bar soon 5", "foo bar 1990 5.5",
])
def test_malformed_rows_fail_or_are_dropped(lines, bad):
    assert fails(lines, "a b 1990 1", bad)
    assert clean(lines, "a b 1990 1", bad, mode="DROPMALFORMED") == [(1990, "a", "b", 1)]


@pytest.mark.parametrize("bad", ["c d 1990", "e f xx 7", "foo"])
def test_malformed_rows_fail_whatever_is_read(spark, tmp_path, lines, bad):
    (tmp_path / "lines.txt").write_text(f"a b 1990 1\n{bad}\n")
    ngrams = read_ngrams(spark, str(tmp_path / "lines.txt"))
    cleaned = clean_ngrams(lines("a b 1990 1", bad), ["the"], language="english")
    for df in (ngrams.groupBy().count(), ngrams.select("w1"), ngrams.select("w1", "w2"),
               cleaned.groupBy("w1").count(), cleaned.select("w2")):
        with pytest.raises(Exception, match="malformed n-gram row"):
            df.collect()
    with pytest.raises(Exception, match="malformed n-gram row"):
        ngrams.count()


def test_malformed_rows_that_a_word_filter_drops_do_not_fail(lines):
    assert clean(lines, "foo2 bar 1990", "the cat soon 5", "a b 1990 1", stop_words=["the"]) == [
        (1990, "a", "b", 1)
    ]


def test_malformed_rows_outside_the_sample_do_not_fail(lines):
    assert clean(lines, "broken", "a b 1990", fraction=0.0) == []


def test_judged_rows_without_filters(lines):
    split = split_ngrams(lines("x9 y 1990", "x9 y 1990 3"), "DROPMALFORMED")
    assert rows(reject_malformed(split, "DROPMALFORMED")) == [("x9", "y", 1990, 3)]


def test_parsed_tables_are_accepted(spark):
    table = spark.createDataFrame([("Tea", "Cup", 1991, 2)], "w1 string, w2 string, year int, match_count bigint")
    assert rows(clean_ngrams(table, language="english")) == [(1990, "tea", "cup", 2)]
    with pytest.raises(ValueError, match="lines"):
        clean_ngrams(table, language="english", sample_by="hash", fraction=0.5)


def test_sampled_lines_are_counted(lines):
    texts = [f"a{chr(97 + i % 26)} b{chr(97 + i // 26)} 1990 1" for i in range(300)]
    some = clean(lines, *texts, fraction=0.5, sample_by="hash")
    assert 100 < len(some) < 200 and set(some) < set(clean(lines, *texts))


STOP_CASES = [["the"], ["cat"], ["The"], ["the "], ["the", "cat"], []]


@pytest.mark.parametrize("stop_words", STOP_CASES)
@pytest.mark.parametrize("limit", [None, 0])
def test_stop_words_match_exactly_in_either_place(spark, lines, stop_words, limit):
    texts = [("the", "cat"), ("cat", "the"), ("a", "b"), ("a", "cat"), ("the", "b")]
    table = split_ngrams(lines(*[f"{w1} {w2} 1990 1" for w1, w2 in texts]))
    words = spark.createDataFrame([(w,) for w in stop_words], "word string")
    expected = sorted((a, b, 1990, 1) for a, b in texts if a not in stop_words and b not in stop_words)
    assert rows(drop_stop_words(table, words, broadcast_bytes=limit)) == expected


def test_row_sample_is_repeatable_and_near_its_fraction(spark):
    table = spark.range(0, 20_000, numPartitions=4).select(F.concat(F.lit("a b "), "id").alias("value"))
    first, second = sample_rows(table, 0.3, seed=5), sample_rows(table, 0.3, seed=5)
    assert rows(first) == rows(second)
    assert 5_500 < first.count() < 6_500
    assert sample_rows(table, 1.0).count() == 20_000
    assert sample_rows(table, 0.0, seed=1).count() == 0


def test_hash_sample_does_not_depend_on_partitioning(spark):
    table = spark.range(0, 20_000, numPartitions=4).select(F.concat(F.lit("a b "), "id").alias("value"))
    sample = rows(sample_rows_by_hash(table, 0.3))
    assert sample == rows(sample_rows_by_hash(table.repartition(7), 0.3))
    assert set(rows(sample_rows_by_hash(table, 0.1))) < set(sample)
    assert 5_500 < len(sample) < 6_500
    assert sample_rows_by_hash(table, 0.0).count() == 0


def test_document_bigrams_against_plain_python(spark):
    texts = {1: "a b  a b\nc", 2: "  lone ", 3: "", 4: "b a b", 120: "a b", 241: "x y"}
    documents = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    expected = {}
    for doc_id, text in texts.items():
        words = text.split()
        for pair in zip(words, words[1:]):
            key = (*pair, 1780 + doc_id * 37 % 240)
            expected[key] = expected.get(key, 0) + 1
    bigrams = document_bigrams(documents)
    assert rows(bigrams) == sorted((*key, count) for key, count in expected.items())
    assert rows(split_ngrams(as_lines(bigrams))) == rows(bigrams)


def test_records_are_split_as_a_regular_split_does(spark, lines, plan_of):
    marks = [" ", "\t", "  ", "\t\t", " \t", "\n", "\x0b", "\f", "\r", "\x1c", " ", ""]
    records = [
        f"{start}w{a}é{b}1990{c}4{end}" for a in marks for b in marks for c in marks
        for start, end in (("", ""), ("", "\t1\t1"), ("", " "), ("", "\t1 \n"), (" ", "\t1"), ("\t", ""))
    ] + ["", " ", "\t", "a", "a b", "a b\t", "a b\t\t3", "a b\t1990", "a b\t1990\t", "\t\t\t", " \t \t \t", None]

    def fields(t):
        return None if t is None else ([*t, None, None, None])[:4]

    ours = _records(lines(*records))
    theirs = lines(*records).select(F.split("value", r"\s+", 5).alias("t"))
    assert [fields(row.t) for row in ours.collect()] == [fields(row.t) for row in theirs.collect()]
    assert "substring_index" in plan_of(ours)
