"""The definitions written out over plain dictionaries, for small inputs."""

import math
import re
from collections import Counter


def cleaned(lines, pattern="[a-z]+", fold=True, stop_words=()):
    for line in lines:
        w1, w2, year, count = re.split(r"\s+", line)[:4]
        if fold:
            w1, w2 = w1.lower(), w2.lower()
        if not (re.fullmatch(pattern, w1) and re.fullmatch(pattern, w2)):
            continue
        if w1 in stop_words or w2 in stop_words:
            continue
        yield int(year) // 10 * 10, w1, w2, int(count)


def scores(lines, **choices):
    """{(decade, w1, w2): (c12, n, c1, c2, npmi)}"""
    c12, n, c1, c2 = Counter(), Counter(), Counter(), Counter()
    for decade, w1, w2, count in cleaned(lines, **choices):
        c12[decade, w1, w2] += count
        n[decade] += count
        c1[decade, w1] += count
        c2[decade, w2] += count
    found = {}
    for (decade, w1, w2), pair in c12.items():
        every, left, right = n[decade], c1[decade, w1], c2[decade, w2]
        if pair == every:
            continue
        pmi = math.log(pair) + math.log(every) - math.log(left) - math.log(right)
        found[decade, w1, w2] = (pair, every, left, right, -pmi / math.log(pair / every))
    return found


def totals(found, buckets=None):
    """npmi total per decade, running over decades of equal remainder if asked."""
    alone = Counter()
    for (decade, _, _), row in found.items():
        alone[decade] += row[-1]
    if buckets is None:
        return dict(alone)
    return {
        decade: sum(
            total for other, total in alone.items()
            if other <= decade and other % buckets == decade % buckets
        )
        for decade in alone
    }


def kept(found, min_npmi, rel_min_npmi, buckets=None):
    total = totals(found, buckets)
    return {
        key for key, row in found.items()
        if not (row[-1] < min_npmi and row[-1] / total[key[0]] < rel_min_npmi)
    }
