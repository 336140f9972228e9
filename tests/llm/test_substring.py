import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import substring as S
from tests.llm.data import awkward, empty, frame, prose, row, words


def expected(rows, width):
    texts = [words(r[1]) for r in rows]
    seen = Counter(tuple(t[i:i + width]) for t in texts for i in range(len(t) - width + 1))
    out = []
    for r, t in zip(rows, texts, strict=True):
        keep = [True] * len(t)
        for i in range(len(t) - width + 1):
            if seen[tuple(t[i:i + width])] > 1:
                keep[i:i + width] = [False] * width
        kept = " ".join(w for w, k in zip(t, keep, strict=True) if k)
        out.append((r[0], len(t), len(t) - sum(keep), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def repetitive(seed, n=40):
    """Texts over few words, with phrases over and over."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        part = prose(rng, rng.randint(1, 6), ["a", "b", "c"])
        rows.append(row(100 + i, " ".join([prose(rng, rng.randint(0, 30), ["a", "b"]), " ".join([part] * rng.randint(1, 12)), prose(rng, rng.randint(0, 9))])))
    return rows


@pytest.mark.parametrize(("width", "gram", "most"), [(35, 12, 2000), (8, 3, 2000), (8, 8, 2000), (6, 2, 3)])
def test_removed_words(spark, width, gram, most):
    """Also with anchors of so many sequences that their windows are counted one by one."""
    rows = awkward() + repetitive(5)
    got = S.remove_repeats(frame(spark, rows), width, gram, most).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, width)


def test_cut_runs(spark, monkeypatch):
    monkeypatch.setattr(S, "RUN", 5)
    rows = repetitive(6) + [row(1, "same " * 500), row(2, "other " * 100)]
    got = S.remove_repeats(frame(spark, rows), 8, 3).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, 8)


def test_empty_table(spark):
    assert S.remove_repeats(empty(spark)).count() == 0


def test_automaton_counts_every_window():
    rng = random.Random(2)
    for _ in range(100):
        seqs = [[rng.choice("ab" if rng.random() < 0.5 else "abc") for _ in range(rng.randint(1, 30))] for _ in range(rng.randint(1, 5))]
        copies = [rng.randint(1, 2) for _ in seqs]
        auto = S.SuffixAutomaton()
        for s, c in zip(seqs, copies, strict=True):
            auto.add(s, c)
        auto.close()
        for w in (1, 3, 6):
            count = Counter()
            for s, c in zip(seqs, copies, strict=True):
                for i in range(len(s) - w + 1):
                    count[tuple(s[i:i + w])] += c
            for s in seqs:
                assert auto.repeated(s, w) == [count[tuple(s[i:i + w])] > 1 for i in range(len(s) - w + 1)]


def test_spans_of_marks():
    got = np.frombuffer(S._spans([0, 1, 1, 0, 1]), "<i4").tolist()
    assert got == [1, 3, 4, 5]
