"""Text scalars as native Column expressions (no Python on executors).

Each function takes and returns a ``Column``; NULL in gives NULL out unless
stated.  Higher-order functions (``transform``) are used where a per-token
rule is needed; they stay JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's --------------------------------
# UK postcode pattern used when upper-casing postcodes inside addresses.
POSTCODE_PATTERN = r"[a-zA-Z]{1,2}[0-9][a-zA-Z0-9]? ?[0-9][a-zA-Z]{2}|GIR ?0AA"
# UK postcode pattern of the hand-off: upper case, one space.
HANDOFF_POSTCODE = r"[A-Z]{1,2}[0-9R][0-9A-Z]? [0-9][ABD-HJLNP-UW-Z]{2}"
# Whole values (any case) that mean "no value".
PLACEHOLDER_VALUES = ["unknown", "no data!", "nodata!", "nan", "n/a"]
# ----------------------------------------------------------------------------

# Python's str.strip() whitespace for the ASCII range.
_WS = r"[ \t\n\x0B\f\r]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """Strip leading/trailing whitespace incl. tabs/newlines (``trim`` only
    removes spaces)."""
    return F.regexp_replace(_c(c), rf"^{_WS}+|{_WS}+$", "")


def title_case(c) -> Column:
    """Python ``str.title()``: every run of cased letters gets a capital first
    letter, the rest lower case; a letter after anything else, uncased letters
    included, starts a new run (``o'b`` -> ``O'B``, ``1st`` -> ``1St``)."""
    runs = F.regexp_extract_all(F.lower(_c(c)), F.lit(r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"), 0)
    def cap(x):
        first, rest = F.substring(x, 1, 1), F.substring(x, 2, 1 << 30)
        # a word-initial sharp s titles to "Ss" (no single-letter title case)
        return F.when(first == "ß", F.concat(F.lit("Ss"), rest)).otherwise(F.concat(F.upper(first), rest))

    return F.array_join(F.transform(runs, cap), "")


def upper_postcodes(c) -> Column:
    """Upper-case every (unanchored, case-insensitive) postcode match.

    The text is cut into alternating chunks: a postcode match, or a maximal
    run of characters at which no postcode starts.  That is exactly the scan
    ``re.sub`` performs; postcode chunks are upper-cased, the rest is kept.
    """
    chunker = rf"(?i)(?:{POSTCODE_PATTERN})|(?:(?!(?:{POSTCODE_PATTERN}))[\s\S])+"
    chunks = F.regexp_extract_all(_c(c), F.lit(chunker), 0)
    is_pc = rf"(?i)^(?:{POSTCODE_PATTERN})"
    return F.array_join(F.transform(chunks, lambda x: F.when(x.rlike(is_pc), F.upper(x)).otherwise(x)), "")


def format_address(c) -> Column:
    """Title-case an address, then upper-case its postcodes:
    ``123 main street, cowes, po33 1ab`` -> ``123 Main Street, Cowes, PO33 1AB``."""
    return upper_postcodes(title_case(c))


def pascal_case(c) -> Column:
    """Capitalise each whitespace-separated word (rest lower case) and join."""
    words = F.split(trim_ws(c), r"[ \t\n\x0B\f\r]+")
    def cap(w):
        first, rest = F.substring(w, 1, 1), F.lower(F.substring(w, 2, 1 << 30))
        return F.when(first == "ß", F.concat(F.lit("Ss"), rest)).otherwise(F.concat(F.upper(first), rest))

    return F.array_join(F.transform(words, cap), "")


def keep_alnum_space(c) -> Column:
    """Drop every character that is neither a letter/digit nor whitespace."""
    return F.regexp_replace(_c(c), r"[^\p{L}\p{N}\s]", "")


def null_placeholder(c) -> Column:
    """NULL for a whole value (any case) in ``PLACEHOLDER_VALUES``."""
    col = _c(c)
    return F.when(~F.lower(col).isin(PLACEHOLDER_VALUES), col)


def null_if_in(c, values) -> Column:
    col = _c(c)
    return F.when(~col.isin(list(values)), col)


def split_part_at(c, sep: str, i: int) -> Column:
    """0-based part ``i`` of ``c`` split on the literal ``sep``; NULL when
    absent (``element_at`` would raise under ANSI)."""
    import re

    return F.get(F.split(_c(c), re.escape(sep)), i)


def outward_code(c) -> Column:
    """Postcode part before the first space (the district)."""
    return F.substring_index(_c(c), " ", 1)


def partial_postcode(c) -> Column:
    """Outward code + space + first two inward characters (``PO30 1LY`` ->
    ``PO30 1L``).  A postcode without a space yields the outward code alone
    (district level) instead of raising."""
    col = _c(c)
    inward = F.get(F.split(col, " "), 1)
    return F.when(inward.isNull(), outward_code(col)).otherwise(
        F.concat(outward_code(col), F.lit(" "), F.substring(inward, 1, 2))
    )


def match_text(address, posttown, postcode) -> Column:
    """``"{address}, {posttown}, {postcode}"`` lower-cased; NULL parts skipped."""
    return F.lower(F.concat_ws(", ", _c(address), _c(posttown), _c(postcode)))


def default_process(c) -> Column:
    """Lower-case, non-alphanumerics to spaces, trimmed."""
    return trim_ws(F.lower(F.regexp_replace(_c(c), r"[^\p{L}\p{N}]", " ")))


def strip_dot_zero(c) -> Column:
    """``123.0`` -> ``123`` (suffix only)."""
    return F.regexp_replace(_c(c), r"\.0$", "")


def numeric_key_text(c) -> Column:
    """Numeric key to integer text; NULL stays NULL."""
    return _c(c).cast("double").cast("bigint").cast("string")


def title_case_address_parts(c, case_sensitive: bool = True) -> Column:
    """Title-case each ``", "`` part except a part that is a postcode
    (anchored), which is upper-cased."""
    flags = "" if case_sensitive else "(?i)"
    parts = F.split(_c(c), ", ")
    return F.array_join(
        F.transform(parts, lambda p: F.when(p.rlike(rf"{flags}^(?:{HANDOFF_POSTCODE})$"), F.upper(p)).otherwise(title_case(p))),
        ", ",
    )


def remove_postcode_and_title_case(c) -> Column:
    """Drop every upper-case postcode (with a comma before it), trim it and
    its commas at the end, and title-case the comma parts, except one that is a postcode in any case."""
    rest = F.rtrim(trim_ws(F.regexp_replace(_c(c), rf"(,\s*)?{HANDOFF_POSTCODE}", "")), F.lit(","))
    return title_case_address_parts(rest, case_sensitive=False)


def first_contains(c, pairs, default=None) -> Column:
    """Ordered substring map: the label of the first key contained in ``c``.

    ``pairs`` is a list of ``(key_or_keys, label)``; a tuple of keys matches
    if any of them is contained.  NULL input gives NULL unless the caller
    coalesces first.
    """
    col = _c(c)
    expr = None
    for keys, label in pairs:
        keys = (keys,) if isinstance(keys, str) else keys
        cond = None
        for k in keys:
            cond = col.contains(k) if cond is None else (cond | col.contains(k))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if default is not None:
        return F.when(col.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(default)))
    return expr


def exact_map(c, mapping: dict, value_type: str = "string") -> Column:
    """Exact-value lookup through a literal map; unmapped -> NULL."""
    keys = list(mapping)
    m = F.create_map(*[x for k in keys for x in (F.lit(k), F.lit(mapping[k]).cast(value_type))])
    return F.try_element_at(m, _c(c))
