"""US state name normalisation as a map lookup (stays in codegen)."""

from __future__ import annotations

import itertools

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import constants as K


def lookup_keys() -> dict[str, str]:
    # Both spellings of a state, normalised the way inputs are: spaces
    # removed, upper case.  Abbreviations have two letters and no full name
    # has, so one map serves both the abbreviation and the name lookup.
    keys = {abbr: name for abbr, name in K.US_STATES.items()}
    keys.update({name.replace(" ", "").upper(): name for name in K.US_STATES.values()})
    return keys


def state_name(c: Column | str) -> Column:
    """``'ca'``, ``'C A'``, ``'california'`` -> ``'California'``; anything
    else (including ``''`` and NULL) -> ``'UNKNOWN'``.  Only the space
    character is removed before the lookup."""
    c = F.col(c) if isinstance(c, str) else c
    pairs = lookup_keys()
    lookup = F.create_map(*[F.lit(x) for x in itertools.chain.from_iterable(pairs.items())])
    key = F.upper(F.replace(c, F.lit(" "), F.lit("")))
    return F.coalesce(F.try_element_at(lookup, key), F.lit(K.UNKNOWN_STATE))
