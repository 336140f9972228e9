import math
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import hmm as H
from tests.llm.data import awkward, empty, frame, lower, words


def plain_forward(tokens, first, move, emit):
    """log10 likelihood by the textbook recursion in logs, one token at a time."""
    a = np.log(first) + np.log(emit[tokens[0]])
    for t in tokens[1:]:
        a = np.log(np.exp(a - a.max()) @ move) + a.max() + np.log(emit[t])
    return (a.max() + math.log(np.exp(a - a.max()).sum())) / math.log(10)


def random_model(rng, k=3, n=40):
    emit = np.zeros((H.CLASSES, k))
    emit[:n] = rng.dirichlet(np.ones(n), k).T
    return {"emit": emit, "move": rng.dirichlet(np.ones(k), k), "first": rng.dirichlet(np.ones(k))}


def test_scaled_forward_is_the_exact_likelihood():
    rng = np.random.default_rng(0)
    m = random_model(rng)
    sizes = np.array([1, 5, 200, 3, 3, 77])
    tokens = rng.integers(0, 40, sizes.sum())
    got = np.empty(len(sizes))
    for pick, n, alive, start, flat in H.batches_of(tokens, sizes):
        logs = np.log10(H.forward(m["emit"][flat], alive, start, m["first"], m["move"]))
        got[pick] = np.bincount(np.concatenate([np.arange(a) for a in alive]), weights=logs, minlength=len(n))
    texts = np.split(tokens, np.cumsum(sizes)[:-1])
    assert got == pytest.approx([plain_forward(t, m["first"], m["move"], m["emit"]) for t in texts])


def test_expected_counts_are_those_of_all_paths():
    """Against the sum over every path of states, for short texts."""
    from itertools import product

    rng = np.random.default_rng(1)
    m = random_model(rng, k=2, n=4)
    texts = [[0, 1, 2, 3], [3], [2, 2, 1]]
    first, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))
    for t in texts:
        paths = list(product(range(2), repeat=len(t)))
        p = np.array([m["first"][s[0]] * np.prod([m["move"][a, b] for a, b in zip(s, s[1:])]) * np.prod([m["emit"][x, a] for x, a in zip(t, s)]) for s in paths])
        for s, w in zip(paths, p / p.sum()):
            first[s[0]] += w
            for a, b in zip(s, s[1:]):
                move[a, b] += w
            for x, a in zip(t, s):
                emit[x, a] += w
    got = H.expected(np.concatenate(texts), np.array([len(t) for t in texts]), m)
    assert got[0] == pytest.approx(first, rel=1e-4) and got[1] == pytest.approx(move, rel=1e-4) and got[2][:4] == pytest.approx(emit, rel=1e-4, abs=1e-5)


def test_counts_and_base_score(spark):
    rows = awkward()
    got = H.scores(frame(spark, rows), states=3, rounds=2).collect()
    tokens = [[*words(lower(r[1])), None] for r in rows]
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in rows]
    c = Counter(t for ts, h in zip(tokens, held, strict=True) if not h for t in ts)
    n, v = sum(c.values()), len(c)
    want = [(r[0], h, len(ts), sum(c[t] > 0 for t in ts), n, sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)) for r, ts, h in zip(rows, tokens, held, strict=True)]
    key = lambda x: (str(x[0]), x[2], x[5])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
        assert a[6] < 0 and math.isfinite(a[6])


def test_score_is_the_plain_forward_of_the_trained_model(spark, monkeypatch):
    """End to end: the model that the rounds leave, held against the textbook recursion over words and their classes."""
    rows = [r for r in awkward() if r[1] is None or len(r[1]) < 5000]
    seen = {}
    real = H._round
    monkeypatch.setattr(H, "_round", lambda blocks, model: seen.update(model=real(blocks, model)) or seen["model"])
    got = H.scores(frame(spark, rows), states=3, rounds=2).collect()
    m = seen["model"]
    tokens = [words(lower(r[1])) for r in rows]
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in rows]
    vocab = sorted({w for ts in tokens for w in ts})
    group = dict(zip(vocab, H.word_classes(vocab).tolist(), strict=True)) | {None: 0}
    c = Counter(t for ts, h in zip(tokens, held, strict=True) if not h for t in [*ts, None])
    inside, kinds = Counter(), Counter()
    for w, n in c.items():
        inside[group[w]] += n
        kinds[group[w]] += 1

    def score(ts):
        ts = [*ts, None]
        of = np.array([group[t] for t in ts])
        return plain_forward(of, m["first"], m["move"], m["emit"]) + sum(math.log10((c[t] + 0.1) / (inside[g] + 0.1 * (kinds[g] + 1))) for t, g in zip(ts, of, strict=True))

    have = sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in got)
    want = sorted((str(r[0]), len(ts) + 1, score(ts)) for r, ts in zip(rows, tokens, strict=True))
    assert [x[:2] for x in have] == [x[:2] for x in want]
    assert [x[2] for x in have] == pytest.approx([x[2] for x in want], rel=1e-9)


def test_start_model_rows_are_distributions():
    """What each state emits, where it moves and where a text starts sum to one."""
    rng = np.random.default_rng(2)
    c = rng.integers(0, 5, H.CLASSES).astype(float)
    m = H.start_model(c, 4)
    assert m["emit"].sum(0) == pytest.approx(np.ones(4)) and m["move"].sum(1) == pytest.approx(np.ones(4)) and m["first"].sum() == pytest.approx(1)


def test_rounds_raise_the_likelihood(spark):
    rows = [r for r in awkward() if r[0] is not None]
    train = lambda n: sum(r["score"] for r in H.scores(frame(spark, rows), states=3, rounds=n).collect() if not r["held_out"])
    assert train(3) > train(0)


def test_empty_and_only_held_out(spark):
    assert H.scores(empty(spark)).count() == 0
    got = H.scores(frame(spark, [r for r in awkward() if r[0] is None]), rounds=1).collect()
    assert {(r["train_tokens"], r["n_known"], r["base_score"]) for r in got} == {(0, 0, 0.0)}
