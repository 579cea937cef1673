"""Text parsing, sentinel handling, surrogate keys and PII masking."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's conventions.
SURROGATE_NULL_MARKER = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"
MASK_HEX_CHARS = 16


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the separator-joined string casts, NULLs replaced by a marker.

    Deterministic across engines: the same value in any SQL engine that casts
    longs and dates to their canonical text gives the same hex string.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def mask_pii(c: str | Column, salt: str) -> Column:
    """Salted SHA-256 pseudonym truncated to 16 hex chars; NULL in gives NULL out."""
    hashed = F.sha2(F.concat(F.lit(salt), _col(c)), 256)
    return F.substring(hashed, 1, MASK_HEX_CHARS)


def money_to_decimal(c: str | Column, precision: int = 10, scale: int = 2) -> Column:
    """'$1,234.50' -> 1234.50; anything unparseable -> NULL."""
    return F.regexp_replace(_col(c), r"[$,]", "").try_cast(f"decimal({precision},{scale})")


def sentinel_to_null(c: str | Column, sentinel: str = "NULL") -> Column:
    """Turn a literal sentinel string (e.g. 'NULL') into a real NULL."""
    return F.nullif(_col(c), F.lit(sentinel))


def leading_number(c: str | Column, precision: int = 4, scale: int = 1) -> Column:
    """First space-separated token of the trimmed text as a decimal ('2.5 baths' -> 2.5)."""
    token = F.split_part(F.trim(_col(c)), F.lit(" "), F.lit(1))
    return token.try_cast(f"decimal({precision},{scale})")


def contains_ci(c: str | Column, needle: str) -> Column:
    """Case-insensitive containment; NULL text gives NULL."""
    return F.contains(F.lower(_col(c)), F.lit(needle.lower()))


_NON_ALNUM = re.compile(r"[^a-z0-9]+")


def flag_name(prefix: str, value: str) -> str:
    """Safe column identifier for a vocabulary value: lower-case, runs of
    non-alphanumerics collapse to '_', trimmed, family prefix in front."""
    return prefix + _NON_ALNUM.sub("_", value.lower()).strip("_")


def flag_names(prefix: str, values: Iterable[str]) -> dict[str, str]:
    """value -> column name; raises when two values collapse onto one name."""
    out: dict[str, str] = {}
    seen: dict[str, str] = {}
    for v in values:
        name = flag_name(prefix, v)
        if name in seen:
            raise ValueError(f"vocabulary values {seen[name]!r} and {v!r} both map to column {name!r}")
        seen[name] = v
        out[v] = name
    return out
