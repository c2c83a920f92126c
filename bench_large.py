"""Time the flagship's steps on generated, skewed lines; prints one JSON line.

``python bench_large.py 40`` makes 40 million n-gram lines: two decades, one word in
first place in a third of the lines, about as many pairs as lines otherwise. The
join limits are lowered so that the shuffled joins with split keys run, hashed
and merged.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import bench
from wordbond import JoinLimits, Workspace, clean_ngrams
from wordbond.operators import (
    attach_decade_total, attach_left_marginal, attach_right_marginal, count_pairs_per_decade, marginals, with_npmi,
)

LIMITS = JoinLimits(broadcast_bytes=1 << 20, split_rows=200_000)
STRATEGIES = {"hash": LIMITS, "merge": JoinLimits(broadcast_bytes=1 << 20, split_rows=200_000, hash_bytes=0)}


def _word(number: Column) -> Column:
    """A word of letters for a number: its hexadecimal digits, 0-9 as g-p."""
    return F.lower(F.translate(F.hex(number), "0123456789", "GHIJKLMNOP"))


def lines(spark: SparkSession, millions: int) -> DataFrame:
    number = F.col("id")
    first = F.when(number % 3 == 0, "hot").otherwise(_word(F.pmod(F.xxhash64(number), F.lit(20_000))))
    second = _word(F.pmod(F.xxhash64(number, F.lit(1)), F.lit(2_000_000)))
    year = F.when(number % 5 == 0, 1985).otherwise(1995).cast("string")
    return spark.range(millions * 1_000_000).select(
        F.concat(first, F.lit(" "), second, F.lit("\t"), year, F.lit("\t3\t1\t1")).alias("value")
    )


def main() -> None:
    millions = int(sys.argv[1]) if len(sys.argv) > 1 else 40
    spark = bench.build_session()
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}

    def timed(name, action):
        started = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - started, 1)
        return result

    with Workspace(spark) as workspace:
        path = workspace.new_path("lines")
        timed("generate", lambda: lines(spark, millions).write.text(path))
        cleaned = clean_ngrams(spark.read.text(path), language="english")
        pairs = timed("scan, clean, count, store", lambda: workspace.store(count_pairs_per_decade(cleaned), "pairs"))
        counted = timed("marginals", lambda: marginals(pairs, workspace, limits=LIMITS))
        for name, limits in STRATEGIES.items():
            scored = pairs
            for attach in (attach_decade_total, attach_left_marginal, attach_right_marginal):
                scored = attach(scored, counted, limits)
            timed(f"scores, {name} joins", lambda: workspace.store(with_npmi(scored), f"scores-{name}"))
        rows = pairs.count()
    print(json.dumps({"million_lines": millions, "pairs": rows, "seconds": seconds}))
    spark.stop()


if __name__ == "__main__":
    main()
