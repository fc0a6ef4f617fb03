"""Column expressions.  All of them are built-in Spark SQL functions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters the word splitter treats as blanks.
BLANKS = " \t\n\x0b\f\r"


def _key_text(keys, salt) -> Column:
    parts = [F.coalesce(_col(k).cast("string"), F.lit("")) for k in keys]
    return F.concat_ws("|", F.lit(str(salt)), *parts)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_bucket(*keys, salt="", buckets: int = 100) -> Column:
    """Bucket number of a key, the same on every run, cluster and partitioning."""
    digest = F.substring(F.md5(_key_text(keys, salt)), 1, 8)
    return F.conv(digest, 16, 10).cast("bigint") % F.lit(buckets)


def stable_id(*keys, salt="") -> Column:
    """128-bit row id derived from the key columns (as 32 hex digits).

    Every part is preceded by its length, nulls by a mark of their own, so that different keys
    never give the same text.
    """
    parts = []
    for k in keys:
        text = _col(k).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat_ws("|", F.lit(str(salt)), *parts))


def tokens(text) -> Column:
    """Lower-cased words, split at every single blank.

    Empty words between blanks stay, trailing ones go; an empty text is one empty word.
    """
    lowered = F.lower(_col(text))
    body = F.rtrim(lowered, F.lit(BLANKS))
    return (
        F.when(lowered == "", F.array(F.lit("")))
        .when(body == "", F.array().cast("array<string>"))
        .otherwise(F.split(body, r"[ \t\n\x0B\f\r]"))
    )


def parse_number(c, to: str = "double") -> Column:
    """Number, or null where the text is none."""
    return _col(c).try_cast(to)


def strip_dots(c) -> Column:
    """Trimmed text without trailing dots."""
    return F.rtrim(F.trim(_col(c)), F.lit("."))


def vector_element(vector, position: int) -> Column:
    return vector_to_array(_col(vector))[position]


def rounded(c, digits: int = 4) -> Column:
    return F.round(_col(c), digits)


def sigmoid(z) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(z)))
