"""Column expressions for the per-job cleaning rules.

The same raw column is cleaned differently by each job (state, size, status,
quantity, month and promotion rules differ); each rule is a small function
returning a ``Column`` so that it stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's behaviour.
# Characters removed by a JVM-style trim: every code point up to U+0020.
JVM_TRIM_CHARS = "".join(chr(c) for c in range(0x00, 0x21))
# Sizes that make a style count in the median-variety job.
BIG_SIZES = ("XXL", "3XL", "4XL", "5XL", "6XL")
# Literal text treated as a missing state.
NULL_TEXT = "NULL"
# Date text format of the sales report.
SALES_DATE_FORMAT = "MM-dd-yy"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jvm_trim(c) -> Column:
    """Trim all characters <= U+0020 on both ends (Spark's ``trim`` only
    removes spaces)."""
    return F.btrim(_c(c), F.lit(JVM_TRIM_CHARS))


def is_blank(c) -> Column:
    """Null or only whitespace/control characters."""
    c = _c(c)
    return c.isNull() | (jvm_trim(c) == F.lit(""))


def norm_state(c) -> Column:
    """trim + upper, as the MapReduce jobs do."""
    return F.upper(jvm_trim(c))


def valid_state(c) -> Column:
    """State usable by the MapReduce jobs: non-empty and not the text NULL."""
    s = norm_state(c)
    return s.isNotNull() & (s != F.lit("")) & (s != F.lit(NULL_TEXT))


def contains_ci(c, needle: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(_c(c)).contains(needle.lower())


def int_or_zero(c) -> Column:
    """Integer parse with 0 for anything unparseable."""
    return F.coalesce(_c(c).try_cast("int"), F.lit(0))


def parse_sales_date(c) -> Column:
    """Strict ``MM-dd-yy`` parse; bad text becomes null instead of failing
    (ANSI mode makes ``to_date`` throw).  Already typed dates pass through."""
    return F.try_to_date(_c(c).cast("string"), SALES_DATE_FORMAT)


def as_date(c, dtype: str) -> Column:
    """Normalise a date-ish column of the given Spark type name to DATE."""
    if dtype == "date":
        return _c(c)
    if dtype.startswith("timestamp"):
        return _c(c).cast("date")
    return parse_sales_date(c)


def promo_tokens(c) -> Column:
    """Split a comma-separated promotion list; tokens are trimmed."""
    return F.transform(F.split(_c(c), ","), lambda t: F.trim(t))


def promo_count_raw(c) -> Column:
    """Promotion count of the percentile job: blank or null text counts 0,
    otherwise every comma-separated token counts, blanks and repeats too."""
    c = _c(c)
    return (F.when(c.isNull() | (F.trim(c) == F.lit("")), F.lit(0))
            .otherwise(F.size(F.split(F.trim(c), ","))))


def promo_count_profile(c) -> Column:
    """Promotion count of the input profile: blank tokens dropped, repeats
    kept."""
    c = _c(c)
    toks = F.filter(F.split(F.trim(c), ","), lambda t: F.trim(t) != F.lit(""))
    return (F.when(c.isNull() | (F.trim(c) == F.lit("")), F.lit(0))
            .otherwise(F.size(toks)))
