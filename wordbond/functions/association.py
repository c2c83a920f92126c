"""Association scores as plain column expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _double(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def share(c12: Column | str, n: Column | str) -> Column:
    """The pair's part of all counts in its decade."""
    return _double(c12) / _double(n)


def pmi(c12="c12", n="n", c1="c1", c2="c2") -> Column:
    """Pointwise mutual information in nats."""
    return F.ln(_double(c12)) + F.ln(_double(n)) - F.ln(_double(c1)) - F.ln(_double(c2))


def npmi(c12="c12", n="n", c1="c1", c2="c2") -> Column:
    """PMI divided by -ln(c12 / n); NULL where the pair is its whole decade."""
    return F.try_divide(-pmi(c12, n, c1, c2), F.ln(share(c12, n)))


def relative(score="npmi", total="total_npmi") -> Column:
    """Score as a part of a total, with IEEE results for a zero total.

    ANSI division raises on zero and ``try_divide`` gives NULL, but a zero total
    must give an infinity or NaN so that the threshold test still decides.
    """
    score, total = _double(score), _double(total)
    by_zero = (
        F.when(F.isnan(score) | (score == 0), F.lit(float("nan")))
        .when(score > 0, F.lit(float("inf")))
        .otherwise(F.lit(float("-inf")))
    )
    return F.coalesce(F.try_divide(score, total), by_zero)
