"""String helpers: null tokens, whitespace trimming, list splitting."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strings that mean "no value" after trimming, compared
# case-insensitively.
NULL_TOKENS = ["", "NA", "N/A", "NULL", "NONE", "?"]

# Whitespace as Unicode defines it (what a Go-style TrimSpace strips). A set
# of characters: trimming looks at the ends of a text, a pattern at all of it.
_WS = " \t\n\v\f\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"


def go_trim(c: Column) -> Column:
    """Strip leading and trailing Unicode whitespace (not only spaces). Most
    texts begin and end with printable ASCII and are left alone."""
    end = F.right(c, F.lit(1))
    return F.when((c < "!") | (c > "~") | (end < "!") | (end > "~"), F.trim(c, F.lit(_WS))).otherwise(c)


def null_tokens_to_null(c: Column) -> Column:
    """Trim a string; blank and NA-like tokens (any case) become null."""
    t = go_trim(c)
    return F.when(F.upper(t).isin(NULL_TOKENS), F.lit(None).cast("string")).otherwise(t)


def split_trim(c: Column, sep: str = ",") -> Column:
    """Split on ``sep`` and trim each part.

    An empty string gives an empty list; empty inner parts are kept as ''.
    A null input stays null.
    """
    parts = F.split(c, re.escape(sep), -1)
    return (F.when(c == "", F.array().cast("array<string>"))
            .otherwise(F.transform(parts, go_trim)))


def normalize_name(name: str) -> str:
    """Column-name normal form: lower case, runs of other characters -> '_'."""
    n = re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")
    return n or "col"
