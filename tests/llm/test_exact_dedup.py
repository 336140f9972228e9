import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import exact_dedup as X
from tests.llm.data import awkward, empty, frame, lower


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r[1])].append(r[0])
    out = []
    for r in rows:
        ids = groups[lower(r[1])]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256(lower(r[1]).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"chunk": 64, "huge": 256}, {"chunk": 16, "huge": 100, "primes": (3, 2)}])
def test_groups_are_those_of_equal_texts(spark, options):
    """Also with many chunk rows, and with primes so small that different texts collide."""
    rows = awkward()
    got = X.exact_groups(frame(spark, rows), **options).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_empty_table(spark):
    assert X.exact_groups(empty(spark)).count() == 0


def test_rows_without_an_id_stay(spark):
    rows = awkward()
    kept = X.drop_exact_copies(frame(spark, rows))
    assert kept.columns == [c.split()[0] for c in "doc_id text lang source n_chars key size h words".split()]
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 2 and 7 not in ids and 8 in ids


@settings(max_examples=50, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 64))
def test_fingerprints_compose(data, chunk):
    whole = X.chunk_hash(data, X._powers(max(len(data), 1), X.PRIMES))
    powers, f = X._powers(chunk, X.PRIMES), (0, 0)
    for i in range(0, len(data), chunk):
        part = data[i:i + chunk]
        f = X.combine(f, X.chunk_hash(part, powers), len(part))
    assert f == whole
