import math

import numpy as np
import pytest

from ledgerline.llm import embed_dedup as E

TYPES = "vec_id long, embedding array<float>, label int, vector string, cell int, dim int, rep int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], TYPES).repartition(3)


def clustered(seed, n=300, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.normal(0, rng.choice([0.0, 0.02, 0.06, 0.1]), dim)
        else:
            v = rng.normal(0, 1, dim)
            v /= np.linalg.norm(v)
        rows.append((int(i * 7 % n), [float(x) for x in np.float32(v)], int(rng.integers(2))))
    return rows


def reachable(links) -> np.ndarray:
    """The smallest row that each row reaches, by a walk along the links."""
    root = np.arange(len(links))
    for start in range(len(links)):
        todo, seen = [start], {start}
        while todo:
            for j in np.flatnonzero(links[todo.pop()]).tolist():
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        root[start] = min(seen)
    return root



def expected(rows, cosine=0.93):
    fine = []
    for i, v, label in rows:
        x = None if v is None or label is None or i is None or any(c is None or not math.isfinite(c) for c in v) else np.array(v, float)
        fine.append(None if x is None or not len(x) or not np.linalg.norm(x) else x / np.linalg.norm(x))
    n = len(rows)
    links = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(a):
            if fine[a] is not None and fine[b] is not None and rows[a][2] == rows[b][2] and len(fine[a]) == len(fine[b]):
                links[a, b] = links[b, a] = fine[a] @ fine[b] >= cosine
    root = reachable(links)
    out = []
    for k, (i, _, _) in enumerate(rows):
        same = [rows[j][0] for j in np.flatnonzero(root == root[k])]
        comp = min((x for x in same if x is not None), default=None)
        out.append((i, int(links[k].sum()), comp, i == comp))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [2048, 16])
def test_links_and_components(spark, block):
    rows = clustered(1)
    got = sorted((tuple(r) for r in E.near_duplicates(frame(spark, rows), block=block).collect()), key=str)
    want = expected(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert there > 200 and 0.99 * there <= found <= there
    assert np.mean([a == b for a, b in zip(got, want, strict=True)]) > 0.98


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 0.0, 0.5]
    rows = [(1, one, 0), (2, one, 0), (2, one, 0), (3, [2.0, 0.0, 1.0], 0), (4, one, 1), (5, one, None), (6, None, 0), (7, [], 0), (8, [0.0, 0.0, 0.0], 0), (9, [1.0, None, 0.5], 0),
            (10, [nan, 0.0, 0.5], 0), (11, [inf, 0.0, 0.5], 0), (None, one, 0), (12, [1.0, 0.0], 0), (13, [-1.0, 0.0, -0.5], 0), (14, [1.0, 0.0], 0)]
    got = sorted((tuple(r) for r in E.near_duplicates(frame(spark, rows)).collect()), key=str)
    want = sorted(((i, n, c, (i == c)) for i, n, c, k in expected(rows)), key=str)
    assert [(a[0], a[1], a[2]) for a in got] == [(a[0], a[1], a[2]) for a in want]


def test_empty_table(spark):
    assert E.near_duplicates(spark.createDataFrame([], TYPES)).count() == 0


def test_count_keeps_the_recall_at_the_threshold():
    """Pairs at exactly the threshold collide often enough."""
    rng = np.random.default_rng(0)
    far = math.sqrt(2 - 2 * E.COSINE)
    count = E.collision_count(E.PROJECTIONS, E.HALF_WIDTH, E.RECALL)
    d = rng.normal(0, far, (20_000, E.PROJECTIONS))
    assert (np.abs(d) <= E.HALF_WIDTH * far).sum(1).__ge__(count).mean() >= E.RECALL - 0.001
