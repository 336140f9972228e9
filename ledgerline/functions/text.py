"""Text repair of payload columns (JVM-side string functions only)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What ``$`` of a pattern matches before, at the end of a text.
_LINE_ENDS = ("\n", "\r", "\u0085", "\u2028", "\u2029")


def repair_quotes(c: Column | str) -> Column:
    """Undo CSV quote doubling in a legacy export: every ``"`` becomes ``'``,
    then every ``''`` becomes ``"``.  ``"{""k"": ""v""}"`` -> ``'{"k": "v"}'``.

    Only for text read without a CSV escape character.  A literal ``''``
    inside a value is turned into ``"`` as well (documented limit).
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.replace(F.translate(c, '"', "'"), F.lit("''"), F.lit('"'))


def strip_outer_quote(c: Column | str) -> Column:
    """Remove one leading and one trailing single quote, if present."""
    c = F.col(c) if isinstance(c, str) else c
    first, last = F.startswith(c, F.lit("'")).cast("int"), F.endswith(c, F.lit("'")).cast("int")
    cut = F.substring(c, first + 1, F.length(c) - first - last)
    # A quote before the text's final line break is the last one too; only there is a pattern needed.
    ends_line = reduce(Column.__or__, (F.endswith(c, F.lit(x)) for x in _LINE_ENDS))
    return F.when(ends_line, F.regexp_replace(c, r"^'|'$", "")).otherwise(cut)
