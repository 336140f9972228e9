from collections import defaultdict

import pytest

from ledgerline.llm import mixing as M
from tests.llm.data import awkward, empty, frame, prose, row, words


def filled(sizes, weights, total, epochs=2):
    """Capped water-filling by plain rounds."""
    target, open_, clamped = {}, dict(weights), set()
    while True:
        left = total - sum(epochs * sizes[s] for s in clamped)
        level = left / sum(open_.values()) if open_ else 0
        over = [s for s in open_ if level * open_[s] > epochs * sizes[s]]
        if not over:
            return {s: epochs * sizes[s] if s in clamped else level * weights[s] for s in sizes}
        for s in over:
            clamped.add(s)
            del open_[s]


def test_targets_and_takes(spark):
    import random

    rng = random.Random(4)
    rows = awkward() + [row(100 + i, prose(rng, rng.randint(1, 60)), rng.choice(["a", "b", "z", None])) for i in range(800)]
    got = M.mix(frame(spark, rows)).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = filled(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()))
    by_size = {v: k for k, v in sizes.items()}
    taken = defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        source = by_size[r["source_size"]]
        assert r["target"] == pytest.approx(target[source]) and r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    for s, t in target.items():
        biggest = max(len(words(r[1])) for r in rows if r[3] == s)
        assert abs(taken[s] - t) <= biggest, (s, taken[s], t)
    assert sorted(map(str, M.mix(frame(spark, rows)).collect())) == sorted(map(str, got))


def test_rows_stand_as_often_as_taken(spark):
    rows = awkward()
    df = frame(spark, rows)
    got = M.mixed(df)
    assert got.columns == df.columns
    times = sorted((str(r["doc_id"]), r["size"]) for r in M.mix(df).collect() for _ in range(r["repetitions"]))
    assert times == sorted((str(r["doc_id"]), len(words(r["text"]))) for r in got.collect())


def test_empty_table_and_no_words(spark):
    assert M.mix(empty(spark)).count() == 0
    got = M.mix(frame(spark, [row(1, None), row(2, "", "b")])).collect()
    assert [(r["target"], r["taken"]) for r in got] == [(0.0, 0), (0.0, 0)]
