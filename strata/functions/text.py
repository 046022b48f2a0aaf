"""String expressions: whitespace strip, hash keys, guarded numeric parse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The set Python's ``str.strip()`` removes, derived from ``str.isspace`` so it
# matches the source splitter exactly (tab, LF, VT, FF, CR, U+001C..U+001F, space,
# U+0085, NBSP, U+1680, U+2000..U+200A, U+2028, U+2029, U+202F, U+205F, U+3000).
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

DIGITS_ONLY = r"^[0-9]+$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Remove leading/trailing Unicode whitespace (set trim, not a regex)."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def hash_key(*parts: str | Column, length: int = 16, separator: str = "") -> Column:
    """First ``length`` hex chars of MD5 over the UTF-8 concatenation of ``parts``.

    With the default empty separator ("ab", "c") and ("a", "bc") collide, as in
    the source system; pass a separator to avoid that.
    """
    cols = [_col(p) for p in parts]
    joined = F.concat_ws(separator, *cols) if separator else F.concat(*cols)
    return F.substring(F.md5(joined), 1, length)


def truncate(c: str | Column, max_len: int) -> Column:
    """Keep at most ``max_len`` characters."""
    return F.substring(_col(c), 1, max_len)


def guarded_int(c: str | Column, lo: int | None = None, hi: int | None = None,
                dtype: str = "int") -> Column:
    """Parse only all-digit strings, optionally within ``[lo, hi]``; else null.

    Uses ``try_cast`` so a value outside the target type gives null instead of an
    ANSI error.
    """
    s = strip_ws(c)
    n = s.try_cast("bigint")
    ok = s.rlike(DIGITS_ONLY)
    if lo is not None:
        ok = ok & (n >= F.lit(lo))
    if hi is not None:
        ok = ok & (n <= F.lit(hi))
    return F.when(ok, n.try_cast(dtype))
