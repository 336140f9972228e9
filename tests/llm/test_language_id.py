import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import language_id as L
from tests.llm.data import awkward, empty, frame, row

SYLLABLES = {"en": ["th", "ing", "er", "wh", "and"], "de": ["sch", "ung", "ei", "über", "cht"], "el": ["αι", "ος", "την", "και"], "ja": ["ます", "日本", "です"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang] + ["a", "e", "n"]) for _ in range(rng.randint(1, 4))) for _ in range(n)).capitalize() + rng.choice([".", " 12!", ""])


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    return [row(1000 + i, prose(rng, lang, rng.randint(4, 60)), "a", lang) for i in range(n) for lang in [rng.choice(["en", "en", "en", "de", "el", "ja"])]]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 4 == 2


def columns(text) -> Counter:
    """The columns of a text's n-grams, letter by letter."""
    chars = [x.lower()[0] if x.isalpha() else " " for x in " " + text + " "]
    out = Counter()
    for i, c in enumerate(chars):
        if c != " ":
            for key in (ord(c), ord(c) << 21 | ord(chars[i - 1]) | 1 << 62, ord(c) << 42 | ord(chars[i - 1]) << 21 | ord(chars[i + 1]) | 1 << 63):
                out[int(L.mix64(np.array([key], np.uint64))[0]) % L.BUCKETS] += 1
    return out


def test_held_out_accuracy_and_calibration(spark):
    rows = corpus()
    got = {r["doc_id"]: r for r in L.language_id(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    right, scores = [], []
    for doc_id, _, lang, *_ in rows:
        r = got[doc_id]
        assert r["held_out"] == held(doc_id) and 0 <= r["score"] <= 1
        if r["held_out"]:
            right.append(r["lang_pred"] == lang)
            scores.append(r["score"])
    assert np.mean(right) > 0.97 and abs(np.mean(right) - np.mean(scores)) < 0.05


def test_awkward_rows(spark):
    rows = awkward() + [row(100, "123 ++ 45"), row(101, "Ёё", lang=None), row(102, "x" * 300_000, lang=None)]
    got = L.language_id(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["score"] <= 1
    by = {r["doc_id"]: r for r in got}
    assert all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 for k in (1, 2, 3, 100))
    assert by[102]["lang_pred"] == "en" and by[102]["score"] == 1  # the one language there is


def test_nothing_to_learn_from(spark):
    assert L.language_id(empty(spark)).collect() == []
    got = L.language_id(frame(spark, [row(1, "words", lang=None), row(2, "12", lang="en"), row(None, None)])).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}


def test_held_out_rows_and_other_columns_teach_nothing(spark):
    rows = corpus(200)
    other = [row(r[0], r[1] + " zzz", "b", "xx") if held(r[0]) else r for r in rows]
    models = [L.fit(frame(spark, x).where("crc32(cast(doc_id as string)) % 4 != 2")) for x in (rows, other)]
    assert models[0]["langs"] == models[1]["langs"] and np.allclose(models[0]["w"], models[1]["w"], atol=1e-9)


def test_sampling_keeps_small_languages(spark):
    rng = random.Random(3)
    rows = [row(i, prose(rng, "en", 9), lang="en") for i in range(3000)] + [row(9000 + i, prose(rng, "de", 9), lang="de") for i in range(40)]
    langs, drawn = L.fit_rows(frame(spark, rows), 500, 40)
    got = [(r["number"], r["weight"]) for r in drawn.collect()]
    n = Counter(k for k, _ in got)
    assert langs == ["de", "en"] and n[0] == 40 and 420 < n[1] < 580
    share = sum(w for k, w in got if k == 0) / sum(w for _, w in got)
    assert share == pytest.approx(40 / 3040, rel=0.15)


def test_counts_and_sums_against_plain_ones(monkeypatch):
    monkeypatch.setattr(L, "CELLS", 3 * L.BUCKETS)  # several blocks
    texts = ["The cat's", None, "", "ÜBER über x1y", "日本 日本 日本。", "İstanbul 　 Ωmega", "a", "the the the end"]
    want = [columns(t or "") for t in texts]
    for first, counts in L.column_counts(pa.array(texts)):
        for k, line in enumerate(counts):
            assert {c: int(line[c]) for c in np.flatnonzero(line)} == dict(want[first + k])
    rng = np.random.default_rng(0)
    model = {"langs": ["a", "b"], "w": rng.normal(size=(2, L.BUCKETS)), "constant": np.array([0.5, -0.5])}
    n, sums = L.class_sums(model, pa.array(texts))
    for k, c in enumerate(want):
        assert n[k] == sum(c.values()) / 3
        for j in range(2):
            mean = sum(model["w"][j][x] * times for x, times in c.items()) / max(n[k], 1)
            assert sums[j][k] == pytest.approx(mean + model["constant"][j])


def test_follow_the_leader_against_plain_steps():
    """The blocks' updates are those of one weight at a time."""
    rng = np.random.default_rng(1)
    rows = [(int(rng.integers(3)), float(rng.uniform(0.5, 2)), np.sort(rng.choice(50, 8, replace=False)), rng.uniform(0, 3, 8)) for _ in range(60)]
    z, n = np.zeros((3, L.BUCKETS + 1)), np.zeros((3, L.BUCKETS + 1))
    L.follow_the_leader(z, n, rows)
    zz, nn = {}, {}

    def weight(c, i):
        a, b = zz.get((c, i), 0.0), nn.get((c, i), 0.0)
        l1, l2 = (0, 0) if i == L.BUCKETS else (L.L1, L.L2)
        return 0.0 if abs(a) <= l1 else -(a - np.sign(a) * l1) / ((L.BETA + b ** 0.5) / L.ALPHA + l2)

    for number, u, at, x in rows:
        pairs = [*zip(at.tolist(), x, strict=True), (L.BUCKETS, 1.0)]
        s = np.array([sum(weight(c, i) * v for i, v in pairs) for c in range(3)])
        p = np.exp(s - s.max()) / np.exp(s - s.max()).sum()
        steps = [(c, i, u * (p[c] - (c == number)) * v, weight(c, i)) for c in range(3) for i, v in pairs]
        for c, i, g, w in steps:
            b = nn.get((c, i), 0.0)
            zz[c, i] = zz.get((c, i), 0.0) + g - ((b + g * g) ** 0.5 - b ** 0.5) / L.ALPHA * w
            nn[c, i] = b + g * g
    w = L.weights(z, n)
    assert (w == 0).sum() > 0
    for (c, i), v in zz.items():
        assert z[c, i] == pytest.approx(v) and n[c, i] == pytest.approx(nn[c, i]) and w[c, i] == pytest.approx(weight(c, i))
