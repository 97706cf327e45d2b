"""String helpers for code extraction (X4-X6, C21), JVM-side expressions only."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import CODE_SEPARATOR, CODE_WIDTH, GRD_CLASS

# Whitespace as Python's str.strip() sees it: Unicode White_Space plus the
# four ASCII separators U+001C..U+001F.
_WS = r"[\p{IsWhite_Space}\x{1C}-\x{1F}]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Trim leading and trailing whitespace of every kind (``trim`` only strips spaces)."""
    return F.regexp_replace(_col(c), f"^{_WS}+|{_WS}+$", "")


def part_or_null(c, sep: str, index: int) -> Column:
    """``index``-th (0-based) part of ``c`` split on the literal ``sep``; NULL when absent.

    ``F.get`` returns NULL out of range instead of raising under ANSI mode.
    """
    return F.get(F.split(_col(c), re.escape(sep), -1), index)


def zfill(c, width: int) -> Column:
    """Left-pad with zeros to ``width``; a leading sign stays in front; never truncates."""
    c = _col(c)
    sign = F.substring(c, 1, 1)
    return (
        F.when(F.length(c) >= width, c)
        .when(sign.isin("-", "+"), F.concat(sign, F.lpad(F.substring(c, 2, 1 << 30), width - 1, "0")))
        .otherwise(F.lpad(c, width, "0"))
    )


def extract_code(description, billing_class, width: int = CODE_WIDTH) -> Column:
    """Code after the first separator, trimmed and zero-padded, for ``GRD`` rows only."""
    code = zfill(strip_ws(part_or_null(description, CODE_SEPARATOR, 1)), width)
    return F.when(_col(billing_class) == F.lit(GRD_CLASS), code)
