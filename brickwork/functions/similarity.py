"""Pairwise similarity scorers as Column expressions.

These are this library's own definitions (not bit-equal to third-party
scorers), written only with functions Spark and DuckDB share, so results can
be checked exactly against an oracle:

* ``ratio(a, b)``       = 100 * (1 - levenshtein(a, b) / max(len(a), len(b)))
* ``token_sort_ratio``  = ratio over the space-joined sorted tokens
* ``token_set_ratio``   = best ratio of shared tokens, shared + rest of a, shared + rest of b
* ``weighted_ratio``    = max(ratio, 0.95 * token_sort_ratio, 0.95 * token_set_ratio)
* ``wratio(a, b)``      = max(ratio, 0.95 * token_sort_ratio)
* token rarity overlap (Y3) is a join-based score in ``operators.match``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

_NON_ALNUM = r"[^\p{L}\p{N}]+"


def normalised(c) -> Column:
    """Lower case, runs of non-alphanumerics to one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(_c(c)), _NON_ALNUM, " "))


def tokens(c) -> Column:
    """Distinct non-empty tokens of the normalised text."""
    return F.array_distinct(F.filter(F.split(normalised(c), " "), lambda t: t != ""))


def token_sort_text(c) -> Column:
    """Normalised tokens sorted and re-joined with single spaces."""
    return F.array_join(F.array_sort(F.filter(F.split(normalised(c), " "), lambda t: t != "")), " ")


def ratio(a, b) -> Column:
    a, b = _c(a), _c(b)
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(100.0)).otherwise(
        F.lit(100.0) * (F.lit(1.0) - F.levenshtein(a, b).cast("double") / longest.cast("double"))
    )


def token_sort_ratio(a_sorted, b_sorted) -> Column:
    return ratio(a_sorted, b_sorted)


def token_set_ratio(a, b) -> Column:
    """Best ratio among the shared tokens, the shared ones with the rest of ``a``, and with the rest of ``b``."""
    ta, tb = tokens(a), tokens(b)

    def text(rest=None) -> Column:
        shared = F.array_sort(F.array_intersect(ta, tb))
        return F.array_join(shared if rest is None else F.concat(shared, F.array_sort(rest)), " ")

    both, one, two = text(), text(F.array_except(ta, tb)), text(F.array_except(tb, ta))
    return F.greatest(ratio(both, one), ratio(both, two), ratio(one, two))


def wratio(a, b, a_sorted, b_sorted) -> Column:
    """Without the token-set term: the bound of the unblocked search holds for these two only."""
    return F.greatest(ratio(a, b), F.lit(0.95) * ratio(a_sorted, b_sorted))


def weighted_ratio(a, b) -> Column:
    """Y1 in full: the best of ratio, token-sort and token-set ratio, the latter two at 0.95."""
    return F.greatest(ratio(a, b), F.lit(0.95) * ratio(token_sort_text(a), token_sort_text(b)), F.lit(0.95) * token_set_ratio(a, b))
