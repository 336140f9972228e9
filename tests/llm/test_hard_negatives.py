import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import hard_negatives as H

TYPES = "vec_id long, embedding array<float>, label int, v string, rank int, score double"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], TYPES).repartition(3)


def brute(rows, anchor, relabel=lambda i, label: label, low=50, high=95):
    """The contract, pair by pair."""
    clean = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, v)
        clean[i] = min(clean.get(i, row), row)
    clean = {i: (relabel(i, label), [math.floor(256 * float(np.float32(x))) for x in v]) for i, (label, v) in clean.items()}
    out = set()
    for a, (label, q) in clean.items():
        if not anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, lab == label) for i, (lab, v) in clean.items() if i != a)
        for k, (ps, p, _) in enumerate([s for s in scored if s[2]][:5]):
            inside = [(s, i) for s, i, same in scored if not same and low * -ps <= 100 * -s <= high * -ps][:3]
            out |= {(a, p, r + 1, i, -ps, -s, k + 1) for r, (s, i) in enumerate(inside)}
    return out


def check(spark, rows, **sizes):
    clean = H.clean_rows(frame(spark, rows))
    got = [tuple(r) for r in H.hard_negatives(clean, F.col("vec_id") % 5 == 0, **sizes).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, lambda i: i % 5 == 0)
    return got


def vectors(n=300, width=12, seed=1, labels=4, scale=lambda rng: 1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(12)]
    rows = []
    for i in range(n):
        c, size, spread = rng.choice(centres), scale(rng), rng.choice([0.02, 0.3, 1.0])
        label = 0 if rng.random() < 0.4 else rng.randrange(labels)
        rows.append((i, [size * (x + rng.gauss(0, spread)) for x in c], label))
    rows += [(n + k, list(rows[k][1]), rng.randrange(labels)) for k in range(0, 60, 2)]  # copies: ties
    return rows


AWKWARD = [(None, [1.0] * 12, 1), (900, None, 1), (901, [1.0] * 12, None), (902, [1.0, None] * 6, 1), (903, [math.nan] * 12, 1), (904, [math.inf] * 12, 2), (905, [0.0] * 12, 1),
           (910, [], 2), (915, [1.0, 2.0], 3), (920, [-1.0] * 12, 1), (925, [1.0] * 12, 2), (925, [1.0] * 12, 2), (925, [2.0] * 12, 1), (930, [1e-9, -1e-9] * 6, 3), (935, [1.0] * 13, 1)]


def test_against_all_pairs(spark):
    check(spark, vectors() + AWKWARD)


def test_many_buckets_runs_and_blocks(spark):
    """Lengths of three orders of magnitude, small buckets and a hot label; the same rows."""
    rows = vectors(scale=lambda rng: 10 ** rng.uniform(-1, 2), seed=3)
    check(spark, rows, bucket_bytes=1, block=7, run=2, focus=4)


def test_products_beyond_doubles(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1, 1]) * rng.uniform(1, 2) * 2.0 ** 20 for _ in range(4)] + [3.0], i % 2) for i in range(40)]
    check(spark, rows)


def test_one_label_and_empty_table(spark):
    assert check(spark, [(i, [1.0, float(i)], 1) for i in range(9)]) == []
    assert check(spark, []) == []


@pytest.mark.parametrize("seed", range(5))
def test_pruning_loses_nothing_and_prunes(seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=16)
    rows = np.concatenate([centre + 0.2 * rng.normal(size=(300, 16)), rng.normal(size=(300, 16))])
    rows = np.floor(2048 * rows / np.sqrt((rows * rows).sum(1))[:, None])  # of one length, as a bucket's are nearly
    bucket = H.Bucket(np.arange(600), rows)
    q = np.floor(256 * centre)
    length = math.sqrt(q @ q)
    products = rows @ q
    pruned = []
    for least in np.quantile(products, [0.1, 0.5, 0.7, 0.9, 0.99, 1.0]):
        which = bucket.feasible(q, length, float(least))
        which = np.arange(600) if which is None else which
        assert set(np.flatnonzero(products >= least)) <= set(which.tolist())
        pruned.append(600 - len(which))
    assert pruned[-1] > 300 and len(bucket.feasible(q, length, length * bucket.longest * 1.01)) == 0
