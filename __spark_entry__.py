"""

The given tables hold no n-gram rows, so every query builds them from
``documents``: pairs of neighbouring tokens, counted per stand-in year and laid
out as n-gram lines. The SQL side does the same in a shared prefix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wordbond import JoinLimits, Workspace
from wordbond import functions as fn, operators as op, plans, sinks, sources

try:  # the training-data operators can be left out
    import corpus_pipeline
    from wordbond.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "wordbond.llm", "wordbond.llm.queries"):
        raise
    llm = None

STOP_WORDS = ["the", "of", "and", "to", "in", "is", "for", "that", "with", "by", "are", "as", "it", "on"]
MIN_NPMI, REL_MIN_NPMI = 0.9, 0.0002
MAX_NPMI, TOP_K, LARGE_TOP_K = 0.99, 10, 2000
# Force the ways that large data take: nothing is broadcast, and many keys are split.
SHUFFLED = JoinLimits(broadcast_bytes=0, split_rows=20)
SAMPLE = 0.25
# Latin letters written as the Hebrew letters of the same place; w-z stay Latin.
LATIN, HEBREW = "abcdefghijklmnopqrstuv", "אבגדהוזחטיכלמנסעפצקרשת"


# --- inputs ------------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def ngram_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.as_lines(sources.document_bigrams(_documents(spark, sf_dir)))


def _hebrew_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    bigrams = sources.document_bigrams(_documents(spark, sf_dir))
    return sources.as_lines(bigrams.withColumns({
        word: F.translate(F.lower(word), LATIN, HEBREW) for word in ("w1", "w2")
    }))


def _stop_words(spark: SparkSession, workspace: Workspace) -> DataFrame:
    path = workspace.new_path("stop-words")
    spark.createDataFrame([(w,) for w in STOP_WORDS], "value string").write.text(path)
    return sources.read_stop_words(spark, path)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.clean_ngrams(ngram_lines(spark, sf_dir), STOP_WORDS, language="english")


def _stored_pairs(spark: SparkSession, sf_dir: str, workspace: Workspace) -> DataFrame:
    return workspace.store(op.count_pairs_per_decade(_clean(spark, sf_dir)), "pairs")


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.score_ngrams(ngram_lines(spark, sf_dir), STOP_WORDS, language="english")


def _selected(spark: SparkSession, sf_dir: str, ordered: bool = False, **choices) -> DataFrame:
    return plans.collocations(
        spark, ngram_lines(spark, sf_dir), language="english", stop_words=STOP_WORDS,
        min_npmi=MIN_NPMI, rel_min_npmi=REL_MIN_NPMI, ordered=ordered, **choices,
    )


def _lines_in_order(spark: SparkSession, path: str) -> DataFrame:
    """``position, f``: written lines with their place over all files, split into fields."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at")
    )
    files = lines.groupBy("file").agg(F.count("*").alias("lines"))  # a row per file
    before = F.sum("lines").over(Window.orderBy("file")) - F.col("lines")
    place = F.row_number().over(Window.partitionBy("file").orderBy("at"))
    return lines.withColumn("place", place).join(files.withColumn("before", before), "file").select(
        (F.col("before") + F.col("place")).cast("bigint").alias("position"),
        F.split("value", r"[,\s]+").alias("f"),
    )


def _fields(lines: DataFrame, **types: str) -> DataFrame:
    return lines.select("position", *[
        F.col("f")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(types.items())
    ])


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round scores: engines differ in the last bit of logarithms and sums."""
    digits = {"npmi": 6, "total_npmi": 4, "rel_npmi": 9, "pmi": 6} | digits
    return df.withColumns({c: fn.rounded(c, digits[c]) for c in df.columns if c in digits})


# --- scans and row-level operators -------------------------------------------


def ngram_scan(spark, sf_dir):
    path = Workspace(spark).new_path("ngrams")
    ngram_lines(spark, sf_dir).write.text(path)
    return sources.read_ngrams(spark, path)


def ngram_scan_gzip(spark, sf_dir):
    """Two files, each one gzip stream, split into words by all cores."""
    workspace = Workspace(spark)
    lines = workspace.store(ngram_lines(spark, sf_dir), "lines")  # counted by all tasks; two only pack
    path = workspace.new_path("ngrams-gzip")
    lines.coalesce(2).write.text(path, compression="gzip")
    return sources.read_ngrams(spark, path)


def sequence_scan(spark, sf_dir):
    """Some records hold line ends, which are white space like any other."""
    workspace = Workspace(spark)
    path = workspace.new_path("ngrams-sequence")
    lines = workspace.store(ngram_lines(spark, sf_dir), "lines")
    broken = lines.withColumn("value", F.translate("value", "\t", "\n")).filter(F.col("value").startswith("t"))
    returned = broken.withColumn("value", F.translate("value", " \n", "\r\r"))
    sinks.save_sequence_lines(lines.union(broken).union(returned), path)
    return sources.read_ngrams(spark, path, format="sequence")


def malformed_rows(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one_word = documents.select(F.col("lang").alias("value"))
    no_count = documents.select(F.concat("lang", F.lit(" words 1990")).alias("value"))
    zero_count = documents.select(F.concat("lang", F.lit(" words 1990 0")).alias("value"))
    lines = ngram_lines(spark, sf_dir).union(one_word).union(no_count).union(zero_count)
    kept = op.keep_language(sources.split_ngrams(lines, "DROPMALFORMED"), "english")
    return op.reject_malformed(kept, "DROPMALFORMED")


def quarantined_rows(spark, sf_dir):
    workspace = Workspace(spark)
    languages = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang")
    lines = ngram_lines(spark, sf_dir)
    for ending in ("", " words 1990", " words 1990 0", " words never 3"):
        lines = lines.union(languages.select(F.concat("lang", F.lit(ending)).alias("value")))
    path = workspace.new_path("bad-rows")
    plans.clean_ngrams(
        lines, STOP_WORDS, language="english", mode="QUARANTINE", quarantine=path, workspace=workspace
    )
    return spark.read.parquet(path).select("reason", "value")


def malformed_rows_failfast(spark, sf_dir):
    return op.reject_malformed(english_words(spark, sf_dir), "FAILFAST")


def english_words(spark, sf_dir):
    return op.keep_language(sources.split_ngrams(ngram_lines(spark, sf_dir)), "english")


def hebrew_words(spark, sf_dir):
    return op.keep_language(sources.split_ngrams(_hebrew_lines(spark, sf_dir)), "hebrew")


def stop_word_filter(spark, sf_dir):
    return op.drop_stop_words(english_words(spark, sf_dir), _stop_words(spark, Workspace(spark)))


def decade_bucket(spark, sf_dir):
    return op.with_decade(english_words(spark, sf_dir))


def row_sample(spark, sf_dir):
    """What holds for any random sample of stored lines, as rows themselves are chance."""
    lines = Workspace(spark).store(ngram_lines(spark, sf_dir), "lines")
    first, again = (op.sample_rows(lines, SAMPLE, seed=7) for _ in range(2))

    def marked(df, *marks):
        return df.select("value", *[F.lit(m).alias(n) for m, n in zip(marks, ("given", "first", "again"))])

    seen = marked(lines, 1, 0, 0).union(marked(first, 0, 1, 0)).union(marked(again, 0, 0, 1)).groupBy("value").agg(
        *[F.sum(n).alias(n) for n in ("given", "first", "again")]
    )
    return seen.agg(
        F.every(F.col("first") <= F.col("given")).alias("part_of_input"),
        F.every(F.col("first") == F.col("again")).alias("repeatable"),
        (F.abs(F.sum("first") / F.sum("given") - SAMPLE) < 0.01).alias("near_fraction"),
        F.sum("given").alias("lines"),
    )


def row_sample_hash(spark, sf_dir):
    return sources.split_ngrams(op.sample_rows_by_hash(ngram_lines(spark, sf_dir), SAMPLE))


def row_sample_hash_fields(spark, sf_dir):
    rows = sources.split_ngrams(ngram_lines(spark, sf_dir))
    return op.sample_rows_by_hash(rows, SAMPLE, plans.NGRAM_COLUMNS)


# --- counts ------------------------------------------------------------------


def pair_counts(spark, sf_dir):
    return plans.count_pairs(ngram_lines(spark, sf_dir), STOP_WORDS, language="english")


def pair_counts_reload(spark, sf_dir):
    path = Workspace(spark).new_path("saved-counts")
    sinks.save_pair_counts(pair_counts(spark, sf_dir), path)
    return sources.load_pair_counts(spark, path)


def pair_counts_merged(spark, sf_dir):
    """Counted in two batches, the second for some decades only and given twice."""
    workspace = Workspace(spark)
    rows = workspace.store(_clean(spark, sf_dir), "rows")
    path = workspace.new_path("merged-counts")
    later = (F.col("decade") >= 1900) & (F.pmod(F.hash("w2"), F.lit(3)) == 0)
    sinks.merge_pair_counts(spark, path, rows.filter(~later), "first", workspace)
    for _ in range(2):
        sinks.merge_pair_counts(spark, path, rows.filter(later), "second", workspace)
    return sources.load_pair_counts(spark, path)


def decade_totals(spark, sf_dir):
    return op.decade_totals(op.count_pairs_per_decade(_clean(spark, sf_dir)))


def count_rollup(spark, sf_dir):
    return op.count_rollup(op.count_pairs_per_decade(_clean(spark, sf_dir)))


def ordered_count_lines(spark, sf_dir):
    path = Workspace(spark).new_path("count-lines")
    sinks.save_pair_count_lines(pair_counts(spark, sf_dir), path, ordered=True)
    return _fields(
        _lines_in_order(spark, path), decade="int", w1="string", w2="string", c12="bigint", n="bigint", c1="bigint"
    )


def _with_marginal(attach: Callable, limits: JoinLimits = JoinLimits()) -> Callable:
    def query(spark, sf_dir):
        workspace = Workspace(spark)
        pairs = _stored_pairs(spark, sf_dir, workspace)
        return attach(pairs, op.marginals(pairs, workspace, limits=limits))

    return query


def left_marginal_split(spark, sf_dir):
    """The pairs lie in buckets of decade and first word, and do not move."""
    workspace = Workspace(spark)
    pairs = _stored_pairs(spark, sf_dir, workspace)
    counted = op.marginals(pairs, workspace, limits=SHUFFLED)
    return op.locate_by_left(pairs, counted, workspace).attach()


def duplicate_pairs(spark, sf_dir):
    pairs = _stored_pairs(spark, sf_dir, Workspace(spark))
    return op.duplicate_pairs(pairs.union(pairs.filter("decade >= 1900")))


def duplicate_pairs_by_hash(spark, sf_dir):
    workspace = Workspace(spark)
    pairs = _stored_pairs(spark, sf_dir, workspace)
    repeated = pairs.union(pairs.filter("decade >= 1900 AND w1 < 'c'"))
    return op.find_duplicate_pairs(repeated, workspace, part_rows=5_000)


def degenerate_pairs(spark, sf_dir):
    workspace = Workspace(spark)
    solo = spark.range(1).select(F.lit("solo pair\t1500\t7").alias("value"))
    lines = ngram_lines(spark, sf_dir).union(solo)
    counts = plans.count_pairs(lines, STOP_WORDS, language="english", workspace=workspace)
    return op.whole_decade_pairs(counts).select("decade", "w1", "w2", "c12", "n")


# --- scores ------------------------------------------------------------------


def pmi(spark, sf_dir):
    workspace = Workspace(spark)
    pairs = _stored_pairs(spark, sf_dir, workspace)
    counted = op.marginals(pairs, workspace)
    for attach in (op.attach_decade_total, op.attach_left_marginal, op.attach_right_marginal):
        pairs = attach(pairs, counted)
    return _rounded(pairs.select("decade", "w1", "w2", fn.pmi().alias("pmi")))


def npmi(spark, sf_dir):
    return _rounded(_scores(spark, sf_dir))


def npmi_in_two_steps(spark, sf_dir):
    return _rounded(plans.score_pairs(pair_counts(spark, sf_dir), validate=False))


def pair_scores_reload(spark, sf_dir):
    path = Workspace(spark).new_path("saved-scores")
    sinks.save_pair_scores(_scores(spark, sf_dir), path)
    return _rounded(sources.load_pair_scores(spark, path))


def ordered_score_lines(spark, sf_dir):
    path = Workspace(spark).new_path("score-lines")
    sinks.save_pair_score_lines(_scores(spark, sf_dir), path, ordered=True)
    return _rounded(_fields(
        _lines_in_order(spark, path), decade="int", w1="string", w2="string", npmi="double"
    ))


def npmi_totals(spark, sf_dir):
    return _rounded(op.npmi_totals(_scores(spark, sf_dir)))


def npmi_running_totals(spark, sf_dir):
    return _rounded(op.scoped_totals(_scores(spark, sf_dir), "running", buckets=11))


def relative_npmi(spark, sf_dir):
    everything = plans.select_collocations(
        _scores(spark, sf_dir), min_npmi=0.0, rel_min_npmi=0.0, ordered=False
    )
    below = everything.select("decade", "w1", "w2", "npmi", "total_npmi", "rel_npmi")
    return _rounded(below)


# --- selection ---------------------------------------------------------------


def threshold_filter(spark, sf_dir):
    kept = plans.select_collocations(
        _scores(spark, sf_dir), min_npmi=MIN_NPMI, rel_min_npmi=REL_MIN_NPMI, ordered=False
    )
    return _rounded(kept.select("decade", "w1", "w2", "npmi", "rel_npmi"))


def threshold_filter_running(spark, sf_dir):
    kept = _selected(spark, sf_dir, total_scope="running", buckets=11)
    return _rounded(kept.select("decade", "w1", "w2", "npmi", "rel_npmi"))


def collocations(spark, sf_dir):
    return _rounded(_selected(spark, sf_dir, ordered=True))


def collocations_shuffled(spark, sf_dir):
    return _rounded(_selected(spark, sf_dir, limits=SHUFFLED))


def collocations_split_size(spark, sf_dir):
    workspace = Workspace(spark)
    path = workspace.new_path("ngrams")
    ngram_lines(spark, sf_dir).write.text(path)
    return _rounded(plans.collocations(
        spark, path, language="english", stop_words=STOP_WORDS, min_npmi=MIN_NPMI,
        rel_min_npmi=REL_MIN_NPMI, ordered=False, split_size=100_000, workspace=workspace,
    ))


def hebrew_collocations(spark, sf_dir):
    return _rounded(plans.collocations(
        spark, _hebrew_lines(spark, sf_dir), language="hebrew",
        min_npmi=MIN_NPMI, rel_min_npmi=REL_MIN_NPMI,
    ))


def self_pairs(spark, sf_dir):
    scores = op.drop_self_pairs(_scores(spark, sf_dir))
    return _rounded(scores.select("decade", "w1", "w2", "npmi"))


def max_npmi(spark, sf_dir):
    scores = op.drop_high_scores(_scores(spark, sf_dir), MAX_NPMI)
    return _rounded(scores.select("decade", "w1", "w2", "npmi"))


def _top(spark, sf_dir, k: int = TOP_K, **choices) -> DataFrame:
    # Scores that differ only in the last bit are ties, ranked by the words.
    workspace = Workspace(spark)
    scores = workspace.store(_rounded(_selected(spark, sf_dir, workspace=workspace), npmi=10), "kept")
    return plans.top_collocations(scores, k, MAX_NPMI, workspace=workspace, stored=True, **choices)


def _ranked(spark, sf_dir, *k: int, **choices) -> DataFrame:
    return _rounded(_top(spark, sf_dir, *k, **choices).select("decade", "w1", "w2", "npmi"))


def top_k_per_decade(spark, sf_dir):
    return _ranked(spark, sf_dir, deduplicate=False)


def top_k_inclusive(spark, sf_dir):
    return _ranked(spark, sf_dir, inclusive=True)


def top_k_large(spark, sf_dir):
    return _ranked(spark, sf_dir, LARGE_TOP_K, deduplicate=False)


def top_listing(spark, sf_dir):
    path = Workspace(spark).new_path("top")
    sinks.save_top_listing(_top(spark, sf_dir, deduplicate=False), path)
    return _rounded(_fields(
        _lines_in_order(spark, path), decade="int", w1="string", w2="string", npmi="double"
    ))


def collocation_lines(spark, sf_dir):
    return sinks.collocation_lines(_rounded(_selected(spark, sf_dir)))


def result_reload(spark, sf_dir):
    workspace = Workspace(spark)
    kept = workspace.store(_selected(spark, sf_dir, workspace=workspace), "kept")
    paths = [workspace.new_path("result"), workspace.new_path("result")]
    sinks.save_collocation_lines(kept, paths[0], trailing_tab=True)
    sinks.save_collocation_lines(kept, paths[1], ordered=False)
    return _rounded(op.drop_repeated_scores(sources.read_collocation_lines(spark, paths)))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: which English word pairs are collocations, decade by decade?"""
    return collocations(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator of the inventory, then the training-data operators."""
    found = association_queries()
    if llm is not None:
        found |= llm.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    """The same queries for DuckDB over the same tables."""
    found = association_sql()
    if llm is not None:
        found |= llm.SQL
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def association_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ngram_scan": ngram_scan,
        "ngram_scan_gzip": ngram_scan_gzip,
        "sequence_scan": sequence_scan,
        "malformed_rows": malformed_rows,
        "malformed_rows_failfast": malformed_rows_failfast,
        "quarantined_rows": quarantined_rows,
        "english_words": english_words,
        "hebrew_words": hebrew_words,
        "stop_word_filter": stop_word_filter,
        "decade_bucket": decade_bucket,
        "row_sample": row_sample,
        "row_sample_hash": row_sample_hash,
        "row_sample_hash_fields": row_sample_hash_fields,
        "pair_counts": pair_counts,
        "pair_counts_reload": pair_counts_reload,
        "pair_counts_merged": pair_counts_merged,
        "decade_totals": decade_totals,
        "attach_total": _with_marginal(op.attach_decade_total),
        "left_marginal": _with_marginal(op.attach_left_marginal),
        "right_marginal": _with_marginal(op.attach_right_marginal),
        "left_marginal_split": left_marginal_split,
        "right_marginal_split": _with_marginal(op.attach_right_marginal, SHUFFLED),
        "ordered_count_lines": ordered_count_lines,
        "count_rollup": count_rollup,
        "duplicate_pairs": duplicate_pairs,
        "duplicate_pairs_by_hash": duplicate_pairs_by_hash,
        "degenerate_pairs": degenerate_pairs,
        "pmi": pmi,
        "npmi": npmi,
        "npmi_in_two_steps": npmi_in_two_steps,
        "pair_scores_reload": pair_scores_reload,
        "ordered_score_lines": ordered_score_lines,
        "npmi_totals": npmi_totals,
        "npmi_running_totals": npmi_running_totals,
        "relative_npmi": relative_npmi,
        "threshold_filter": threshold_filter,
        "threshold_filter_running": threshold_filter_running,
        "self_pairs": self_pairs,
        "max_npmi": max_npmi,
        "top_k_per_decade": top_k_per_decade,
        "top_k_inclusive": top_k_inclusive,
        "top_k_large": top_k_large,
        "top_listing": top_listing,
        "collocation_lines": collocation_lines,
        "result_reload": result_reload,
        "collocations": collocations,
        "collocations_shuffled": collocations_shuffled,
        "collocations_split_size": collocations_split_size,
        "hebrew_collocations": hebrew_collocations,
    }


# --- the same in SQL ---------------------------------------------------------

_STOP_LIST = ", ".join(f"'{word}'" for word in STOP_WORDS)

_BIGRAMS = r"""
WITH tokens AS (
  SELECT CAST(1780 + (doc_id * 37) % 240 AS INTEGER) AS year,
         list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS t
  FROM documents
), positions AS (
  SELECT year, t, unnest(range(1, len(t))) AS i FROM tokens
), bigrams AS (
  SELECT t[i] AS w1, t[i + 1] AS w2, year, count(*) AS match_count
  FROM positions GROUP BY ALL
)"""


def _prefix(w1: str = "w1", w2: str = "w2", extra_lines: str = "") -> str:
    return _BIGRAMS + rf""", lines AS (
  SELECT {w1} || ' ' || {w2} || chr(9) || year || chr(9) || match_count
         || chr(9) || '1' || chr(9) || '1' AS value
  FROM bigrams {extra_lines}
), split_lines AS (
  SELECT value, regexp_split_to_array(value, '\s+') AS f FROM lines
), records AS (
  SELECT value, f[1] AS w1, f[2] AS w2, TRY_CAST(f[3] AS INTEGER) AS year,
         TRY_CAST(f[4] AS BIGINT) AS match_count
  FROM split_lines
)"""


def _words(pattern: str, fold: str) -> str:
    return rf""", words AS (
  SELECT {fold}(w1) AS w1, {fold}(w2) AS w2, year, match_count FROM records
  WHERE regexp_full_match({fold}(w1), '{pattern}') AND regexp_full_match({fold}(w2), '{pattern}')
)"""


_ENGLISH_WORDS = _words("[a-z]+", "lower")
_HEBREW_WORDS = _words("[א-ת]+", "")


def _pairs(stop_list: str = _STOP_LIST) -> str:
    stop_filter = f"WHERE w1 NOT IN ({stop_list}) AND w2 NOT IN ({stop_list})" if stop_list else ""
    return f""", kept_words AS (SELECT * FROM words {stop_filter})
, pairs AS (
  SELECT year - year % 10 AS decade, w1, w2, CAST(sum(match_count) AS BIGINT) AS c12
  FROM kept_words GROUP BY ALL
), counts AS (
  SELECT decade, w1, w2, c12,
         CAST(sum(c12) OVER (PARTITION BY decade) AS BIGINT) AS n,
         CAST(sum(c12) OVER (PARTITION BY decade, w1) AS BIGINT) AS c1,
         CAST(sum(c12) OVER (PARTITION BY decade, w2) AS BIGINT) AS c2
  FROM pairs
), pointwise AS (
  SELECT *, ln(c12) + ln(n) - ln(c1) - ln(c2) AS pmi FROM counts
), scores AS (
  SELECT * EXCLUDE (pmi), -pmi / ln(c12 / n) AS npmi FROM pointwise WHERE c12 <> n
), totals AS (
  SELECT decade, sum(npmi) AS total_npmi, count(*) AS rows FROM scores GROUP BY decade
), running AS (
  SELECT decade, rows, sum(total_npmi) OVER (
    PARTITION BY decade % 11 ORDER BY decade ROWS UNBOUNDED PRECEDING) AS total_npmi
  FROM totals
), scored AS (
  SELECT s.*, t.total_npmi, s.npmi / t.total_npmi AS rel_npmi FROM scores s JOIN totals t USING (decade)
), scored_running AS (
  SELECT s.*, t.total_npmi, s.npmi / t.total_npmi AS rel_npmi FROM scores s JOIN running t USING (decade)
), kept AS (
  SELECT * FROM scored WHERE NOT (npmi < {MIN_NPMI} AND rel_npmi < {REL_MIN_NPMI})
), ranked AS (
  SELECT decade, w1, w2, round(npmi, 10) AS npmi, row_number() OVER (
    PARTITION BY decade ORDER BY round(npmi, 10) DESC, w1, w2) AS place
  FROM kept WHERE round(npmi, 10) <= {MAX_NPMI} AND w1 <> w2
)"""


def association_sql() -> dict[str, str]:
    records = _prefix()
    words = records + _ENGLISH_WORDS
    pairs = words + _pairs()
    hebrew_lines = _prefix(
        f"translate(lower(w1), '{LATIN}', '{HEBREW}')", f"translate(lower(w2), '{LATIN}', '{HEBREW}')"
    )
    hebrew = hebrew_lines + _HEBREW_WORDS
    solo = _prefix(extra_lines="UNION ALL SELECT 'solo pair' || chr(9) || '1500' || chr(9) || '7'")
    broken = _prefix(extra_lines="""
        UNION ALL SELECT lang FROM documents
        UNION ALL SELECT lang || ' words 1990' FROM documents
        UNION ALL SELECT lang || ' words 1990 0' FROM documents""")
    unclean = _prefix(extra_lines="".join(
        f"\n        UNION ALL SELECT lang || '{ending}' FROM documents"
        for ending in ("", " words 1990", " words 1990 0", " words never 3")
    ))
    all_records = " SELECT w1, w2, year, match_count FROM records"
    reloaded_score = " SELECT decade, w1, w2, round(npmi, 6) AS npmi FROM "
    relative = "decade, w1, w2, round(npmi, 6) AS npmi, round(rel_npmi, 9) AS rel_npmi"
    full_result = (
        " SELECT decade, w1, w2, c12, n, c1, c2, round(npmi, 6) AS npmi,"
        " round(total_npmi, 4) AS total_npmi, round(rel_npmi, 9) AS rel_npmi FROM kept"
    )
    scores = " SELECT decade, w1, w2, c12, n, c1, c2, round(npmi, 6) AS npmi FROM scores"
    counts = " SELECT decade, w1, w2, c12, n, c1 FROM counts"
    return {
        "ngram_scan": records + all_records,
        "ngram_scan_gzip": records + all_records,
        "sequence_scan": records + """
            SELECT w1, w2, year, match_count FROM records
            UNION ALL SELECT w1, w2, year, match_count FROM records WHERE starts_with(w1, 't')
            UNION ALL SELECT w1, w2, year, match_count FROM records WHERE starts_with(w1, 't')""",
        "malformed_rows": broken + _ENGLISH_WORDS
        + " SELECT * FROM words WHERE year IS NOT NULL AND match_count >= 1",
        "quarantined_rows": unclean + f"""
            , judged AS (
              SELECT value, CASE WHEN coalesce(w2, '') = '' THEN 'fewer than two words'
                                 WHEN year IS NULL THEN 'year does not parse'
                                 WHEN match_count IS NULL THEN 'count does not parse'
                                 WHEN match_count < 1 THEN 'count below one' END AS reason
              FROM records
              WHERE coalesce(w2, '') = '' OR (
                regexp_full_match(lower(w1), '[a-z]+') AND regexp_full_match(lower(w2), '[a-z]+')
                AND lower(w1) NOT IN ({_STOP_LIST}) AND lower(w2) NOT IN ({_STOP_LIST}))
            ) SELECT reason, value FROM judged WHERE reason IS NOT NULL""",
        "malformed_rows_failfast": words + " SELECT * FROM words",
        "english_words": words + " SELECT * FROM words",
        "hebrew_words": hebrew + " SELECT * FROM words",
        "stop_word_filter": pairs + " SELECT * FROM kept_words",
        "decade_bucket": words + " SELECT year - year % 10 AS decade, w1, w2, match_count FROM words",
        "row_sample": records + """
            SELECT true AS part_of_input, true AS repeatable, true AS near_fraction, count(*) AS lines FROM records""",
        "row_sample_hash": records + all_records
        + f" WHERE CAST('0x' || substr(md5(value), 1, 8) AS BIGINT) < {int(SAMPLE * 2**32)}",
        "row_sample_hash_fields": records + all_records + f"""
             WHERE CAST('0x' || substr(md5(concat_ws(chr(9), w1, w2, year, match_count)), 1, 8) AS BIGINT)
                   < {int(SAMPLE * 2**32)}""",
        "pair_counts": pairs + counts,
        "pair_counts_merged": pairs + counts,
        "pair_counts_reload": pairs + counts,
        "decade_totals": pairs + " SELECT decade, CAST(sum(c12) AS BIGINT) AS n FROM pairs GROUP BY decade",
        "attach_total": pairs + " SELECT decade, w1, w2, c12, n FROM counts",
        "left_marginal": pairs + " SELECT decade, w1, w2, c12, c1 FROM counts",
        "right_marginal": pairs + " SELECT decade, w1, w2, c12, c2 FROM counts",
        "left_marginal_split": pairs + " SELECT decade, w1, w2, c12, c1 FROM counts",
        "right_marginal_split": pairs + " SELECT decade, w1, w2, c12, c2 FROM counts",
        "ordered_count_lines": pairs + """
            SELECT row_number() OVER (ORDER BY decade, w1, w2) AS position, decade, w1, w2, c12, n, c1
            FROM counts""",
        "ordered_score_lines": pairs + """
            SELECT row_number() OVER (ORDER BY decade, w2, w1) AS position, decade, w1, w2, round(npmi, 6) AS npmi
            FROM scores""",
        "count_rollup": pairs + """
            SELECT decade, w1, w2, CAST(grouping(decade, w1, w2) AS INTEGER) AS level,
                   CAST(sum(c12) AS BIGINT) AS total, count(*) AS rows
            FROM pairs GROUP BY GROUPING SETS ((decade, w1, w2), (decade, w1), (decade, w2), (decade))""",
        "duplicate_pairs": pairs + """
            SELECT decade, w1, w2, count(*) AS copies
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM pairs WHERE decade >= 1900)
            GROUP BY decade, w1, w2 HAVING count(*) > 1""",
        "duplicate_pairs_by_hash": pairs + """
            SELECT decade, w1, w2, count(*) AS copies
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM pairs WHERE decade >= 1900 AND w1 < 'c')
            GROUP BY decade, w1, w2 HAVING count(*) > 1""",
        "degenerate_pairs": solo + _ENGLISH_WORDS + _pairs()
        + " SELECT decade, w1, w2, c12, n FROM counts WHERE c12 = n",
        "pmi": pairs + " SELECT decade, w1, w2, round(pmi, 6) AS pmi FROM pointwise",
        "npmi": pairs + scores,
        "npmi_in_two_steps": pairs + scores,
        "pair_scores_reload": pairs + scores,
        "npmi_totals": pairs + " SELECT decade, round(total_npmi, 4) AS total_npmi, rows FROM totals",
        "npmi_running_totals": pairs + " SELECT decade, round(total_npmi, 4) AS total_npmi, rows FROM running",
        "relative_npmi": pairs + """
            SELECT decade, w1, w2, round(npmi, 6) AS npmi, round(total_npmi, 4) AS total_npmi,
                   round(rel_npmi, 9) AS rel_npmi
            FROM scored WHERE NOT (npmi < 0.0 AND rel_npmi < 0.0)""",
        "threshold_filter": pairs + f" SELECT {relative} FROM kept",
        "threshold_filter_running": pairs + f"""
            SELECT {relative} FROM scored_running
            WHERE NOT (npmi < {MIN_NPMI} AND rel_npmi < {REL_MIN_NPMI})""",
        "self_pairs": pairs + reloaded_score + "scores WHERE w1 <> w2",
        "max_npmi": pairs + reloaded_score + f"scores WHERE npmi <= {MAX_NPMI}",
        "top_k_per_decade": pairs + reloaded_score + f"ranked WHERE place <= {TOP_K}",
        "top_k_inclusive": pairs + reloaded_score + f"ranked WHERE place <= {TOP_K + 1}",
        "top_k_large": pairs + reloaded_score + f"ranked WHERE place <= {LARGE_TOP_K}",
        "top_listing": pairs + f"""
            SELECT row_number() OVER (ORDER BY decade, npmi DESC, w1, w2) AS position,
                   decade, w1, w2, round(npmi, 6) AS npmi
            FROM ranked WHERE place <= {TOP_K}""",
        "collocation_lines": pairs + """
            SELECT decade || ' ' || w1 || ' ' || w2 || ' ' || round(npmi, 6) AS value FROM kept""",
        "result_reload": pairs + reloaded_score + "kept",
        "collocations": pairs + full_result,
        "collocations_shuffled": pairs + full_result,
        "collocations_split_size": pairs + full_result,
        "hebrew_collocations": hebrew + _pairs("") + full_result,
    }
