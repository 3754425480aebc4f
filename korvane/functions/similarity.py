"""Similarities of two strings as column expressions: 1 for equal, 0 for unlike, 0.5 for unknown where said.

mode 'edit' has edit-distance semantics; mode 'difflib' has longest-matching-block ratios
in their place, for results that must equal an engine without an edit-distance library.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from korvane.functions.text import numbers, pin_zip, strip, words


def safe(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit("")))


def _jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, mine = [False] * len(b), []
    for i, c in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if not used[j] and b[j] == c), None)
        if j is not None:
            used[j] = True
            mine.append(c)
    m = len(mine)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(mine, (c for c, u in zip(b, used, strict=True) if u), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    same = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return jaro + same * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & at.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def _indel(a: str, b: str) -> float:
    return 2 * _lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def _blocks(a: str, b: str) -> float:
    return difflib.SequenceMatcher(None, a, b).ratio()


def _partial(a: str, b: str) -> float:
    """The best ratio of the shorter string with a stretch of the longer one, stretches at the ends being shorter."""
    a, b = sorted((a, b), key=len)
    if not a:
        return 1.0 if not b else 0.0
    n = len(a)
    return max([_indel(a, b[max(0, i) : i + n]) for i in range(1 - n, len(b))])


def _token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    left, right = (" ".join(filter(None, (both, " ".join(sorted(z - (x & y)))))) for z in (x, y))
    if both and (x <= y or y <= x):
        return 1.0
    return max([_indel(left, right)] + [_indel(both, x) for x in (left, right) if both])


def _pair(f):
    @F.pandas_udf(DoubleType())
    def each(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([f(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return each


_JW, _INDEL, _BLOCKS, _PARTIAL, _TOKEN_SET = map(_pair, (_jaro_winkler, _indel, _blocks, _partial, _token_set))


def levenshtein_ratio(a: Column, b: Column, mode: str = "edit") -> Column:
    """1 less the edit distance over the longer length; both empty: 1."""
    if mode == "difflib":
        return F.when((a == "") & (b == ""), 1.0).when((a == "") | (b == ""), 0.0).otherwise(_BLOCKS(a, b))
    return F.when((a == "") & (b == ""), 1.0).otherwise(1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def jaro_winkler(a: Column, b: Column, mode: str = "edit") -> Column:
    return (_BLOCKS if mode == "difflib" else _JW)(a, b)


def _sorted(c: Column) -> Column:
    return F.array_join(F.array_sort(words(c)), " ")


def token_sort_ratio(a: Column, b: Column, mode: str = "edit") -> Column:
    return levenshtein_ratio(_sorted(a), _sorted(b), mode) if mode == "difflib" else _INDEL(_sorted(a), _sorted(b))


def token_set_ratio(a: Column, b: Column, mode: str = "edit") -> Column:
    if mode != "difflib":
        return _TOKEN_SET(a, b)
    x, y = F.array_distinct(words(F.lower(a))), F.array_distinct(words(F.lower(b)))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y)))


def partial_ratio(a: Column, b: Column, mode: str = "edit") -> Column:
    return (_BLOCKS if mode == "difflib" else _PARTIAL)(a, b)


def _jaccard(x: Column, y: Column) -> Column:
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def token_jaccard(a: Column, b: Column) -> Column:
    return _jaccard(words(F.lower(a)), words(F.lower(b)))


def char_ngrams(c: Column, n: int) -> Column:
    """Distinct n-grams of a text; none where it is shorter."""
    return F.when(F.length(c) < n, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(n)))))


def char_ngram_jaccard(a: Column, b: Column, n: int = 3) -> Column:
    return _jaccard(char_ngrams(F.lower(a), n), char_ngrams(F.lower(b), n))


def length_ratio(a: Column, b: Column) -> Column:
    x, y = F.length(a), F.length(b)
    return F.when((x == 0) & (y == 0), 1.0).when((x == 0) | (y == 0), 0.0).otherwise(F.least(x, y) / F.greatest(x, y))


def _known(x: Column, y: Column, unknown: Column) -> Column:
    return F.when(unknown, 0.5).otherwise((x == y).cast("double"))


def suffix_match(x: Column, y: Column) -> Column:
    """1 or 0; 0.5 if either suffix is empty."""
    return _known(x, y, (x == "") | (y == ""))


def acronym_match(x: Column, y: Column) -> Column:
    """1 or 0; 0.5 if either acronym has fewer than two letters."""
    return _known(x, y, (F.length(x) < 2) | (F.length(y) < 2))


def number_agreement(a: Column, b: Column) -> Column:
    """Shared numbers over the more numerous side; 0.5 if either address has none."""
    x, y = F.array_distinct(numbers(a)), F.array_distinct(numbers(b))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.5).otherwise(F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y)))


def pin_zip_match(a: Column, b: Column) -> Column:
    x, y = pin_zip(a), pin_zip(b)
    return _known(x, y, (x == "") | (y == ""))
