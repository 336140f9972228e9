import random
from collections import defaultdict

import numpy as np
import pytest

from ledgerline.llm import jaccard as J
from tests.llm.data import awkward, empty, frame, lower, prose, row, words


def sets_of(rows, k=5):
    sets = []
    for r in rows:
        w = words(lower(r[1]))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return sets


def component_ids(rows, percent=75):
    """Per row the smallest id reachable by links (None for a row without an id)."""
    sets = sets_of(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and None not in (rows[i][0], rows[j][0]) and 100 * both >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(lambda: 1 << 60)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least[find(i)], r[0])
    return [None if r[0] is None else least[find(i)] for i, r in enumerate(rows)]


def expected(rows):
    return sorted(((r[0], len(s), c) for r, s, c in zip(rows, sets_of(rows), component_ids(rows), strict=True)), key=str)


def chains(seed):
    """Groups of near copies that link only through others, and many documents around one long passage."""
    rng = random.Random(seed)
    rows = []
    for g in range(4):
        text = prose(rng, 80).split()
        for i in range(12):
            rows.append(row(1000 + 50 * g + i, " ".join(text)))
            for _ in range(2):
                text[rng.randrange(80)] = f"x{rng.random()}"
    shared = prose(rng, 70)
    rows += [row(2000 + i, shared + " " + prose(rng, rng.choice([2, 5, 9, 60, 80]))) for i in range(60)]
    rows += [row(3000 + i, prose(rng, rng.randint(1, 12), ["a", "b"])) for i in range(60)]
    return rows


@pytest.mark.parametrize("block", [1024, 7])
def test_components(spark, block, monkeypatch):
    rows = awkward() + chains(1)
    got = J.jaccard_components(frame(spark, rows), block=block).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_order_of_common_shingles_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(J, "SAMPLE", 1)
    monkeypatch.setattr(J, "FREQUENT", 3)
    rows = chains(2)
    got = J.jaccard_components(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_empty_table_and_row_filter(spark):
    assert J.jaccard_components(empty(spark)).count() == 0
    rows = awkward()
    kept = J.drop_near_copies(frame(spark, rows))
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 2 and 7 in ids and not {8, 9, 10} & set(ids) and {1, 2, 3, 13, 14} <= set(ids)


def test_rtree_join_is_the_bound_on_all_pairs():
    rng = np.random.default_rng(0)
    for _ in range(10):
        k = int(rng.integers(1, 300))
        base = rng.integers(0, 9, (max(1, k // 6), 64))
        p = np.maximum(0, base[rng.integers(0, len(base), k)] + rng.integers(-1, 2, (k, 64)))
        n = np.maximum(p.sum(1), 1)
        i, j = J.rtree_join(p, n, p, n)
        fits = (np.minimum(p[:, None], p[None]).sum(2) >= J.least_overlap(n[:, None], n[None])) & (100 * n[:, None] >= 75 * n[None]) & (100 * n[None] >= 75 * n[:, None])
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(fits)), strict=True))


def test_folded_points_bound_the_overlap():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (900, 700))
    b = np.unique(np.concatenate([a[:500], b]))
    (x, f), (y, g) = J.point(J.group_counts(a)), J.point(J.group_counts(b))
    both = len(np.intersect1d(a, b))
    for w in (64, 128):
        assert np.minimum(J.folded(x, w), J.folded(y, w)).sum() >= both
    assert both <= J.fine_overlap(f, len(a), g, len(b)) < both + 250
    (z, h), small = J.point(J.group_counts(a[:100])), len(np.intersect1d(a[:100], b))
    assert small <= J.fine_overlap(h, 100, g, len(b)) and len(z) < len(y)
    big = J.point(J.group_counts(np.full(70_000, 5, np.uint64)))[0]
    assert big.max() == 70_000
