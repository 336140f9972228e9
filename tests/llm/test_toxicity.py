import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import toxicity as T
from tests.llm.data import awkward, empty, frame, lower, prose, row, words

INSULTS = ["clod", "dolt", "oaf"]


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        text = prose(rng, rng.randint(5, 80)).split()
        for _ in range(max(1, len(text) // 20) if bad else 0):
            text.insert(rng.randrange(len(text)), rng.choice(INSULTS))
        rows.append(row(i, " ".join(text)))
        labels.append((i, int(bad), "x"))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, toxic int, text string")


def test_held_out_rows_are_told_apart(spark):
    rows, labels = corpus()
    got = T.toxicity(frame(spark, rows + awkward()), labelled(spark, labels)).toPandas()
    assert len(got) == len(rows) + len(awkward()) and got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.5)).all()
    truth = {i: t for i, t, _ in labels}
    held = [(truth[r.doc_id], r.predicted) for r in got.itertuples() if r.doc_id == r.doc_id and r.doc_id >= 100 and r.held_out]
    assert len(held) > 40 and np.mean([a == b for a, b in held]) > 0.95
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id != r.doc_id else str(int(r.doc_id))).encode()) % 5 == 0) for r in got.itertuples())


def test_held_out_labels_change_nothing(spark):
    rows, labels = corpus(200)
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t, x) for i, t, x in labels]
    a, b = (sorted(map(tuple, T.toxicity(frame(spark, rows), labelled(spark, x)).collect())) for x in (labels, turned))
    assert a == b


def test_missing_labels_and_rows(spark):
    rows, labels = corpus(30)
    assert T.toxicity(empty(spark), labelled(spark, labels)).count() == 0
    for some, score in (([], 0.0), ([(i, 0, "x") for i in range(30)], 0.0), ([(i, 1, "x") for i in range(30)], 1.0), ([(1, None, None), (None, 1, "x"), (2, 7, "x")], 0.0)):
        assert {r["score"] for r in T.toxicity(frame(spark, rows), labelled(spark, some)).collect()} == {score}


def test_row_filter_keeps_columns_and_clean_rows(spark):
    rows, labels = corpus()
    df = frame(spark, rows)
    kept = T.drop_toxic(df, labelled(spark, labels))
    assert kept.columns == df.columns
    ids = {r["doc_id"] for r in kept.collect()}
    clean = {i for i, t, _ in labels if not t}
    assert len(ids & clean) > 0.95 * len(clean) and len(ids - clean) < 0.1 * len(labels)


def test_pairs_start_anew_with_each_text():
    at, token, before = T.tokens(pa.array(["a b", "", "b", "a b", None]))
    assert at.tolist() == [0, 3, 4, 6, 9, 10]
    starts = [0, 3, 4, 6, 9]
    assert (before[starts] == T.START).all() and (token[[2, 3, 5, 8, 9]] == T.END).all()
    assert token[0] == token[6] == before[1] and token[1] == token[4] == token[7]


class Plain:
    """The models by dictionaries, one probability at a time."""

    def __init__(self, rows, gate=T.GATE, d=T.DISCOUNT):
        self.pairs, self.alone = [Counter(), Counter()], [Counter(), Counter()]
        for text, label in rows:
            w = words(lower(text)) + ["</s>"]
            self.pairs[label].update(set(zip(["<s>"] + w, w)))
            self.alone[label].update(set(w))
        self.d, self.kinds = d, [Counter(w for _, w in p) for p in self.pairs]
        every = set(self.pairs[0]) | set(self.pairs[1])
        self.shared = Counter(w for _, w in every)
        self.whole = len(every) + len(self.shared) + 1
        self.own = {w for w in self.shared if self.differs(w, self.alone, gate)}
        self.gated = {x for x in every if self.differs(x, self.pairs, gate)}
        self.after, self.context = defaultdict(set), [Counter(), Counter()]
        for v, w in self.gated:
            self.after[v].add(w)
        for c in (0, 1):
            for (v, _), n in self.pairs[c].items():
                self.context[c][v] += n

    @staticmethod
    def differs(x, counts, gate):
        t, o = counts[1][x], counts[0][x]
        p = sum(counts[1].values()) / (sum(counts[0].values()) + sum(counts[1].values()))
        return 2 * ((t * math.log(t / ((t + o) * p)) if t else 0) + (o * math.log(o / ((t + o) * (1 - p))) if o else 0)) > gate

    def q(self, w):
        return (self.shared[w] + 1) / self.whole

    def word(self, c, w):
        n = sum(self.kinds[c].values())
        freed = max(sum(min(self.d, self.kinds[c][x]) for x in self.own) / n, T.LEAST)
        took = sum(max(self.kinds[c][x] - self.d, 0) for x in self.own) / n
        rest = (1 - freed - took) / (1 - sum(map(self.q, self.own)))
        return max(self.kinds[c][w] - self.d, 0) / n + freed * self.q(w) if w in self.own else (rest + freed) * self.q(w)

    def p(self, c, v, w):
        n = self.context[c][v]
        if v not in self.after or not n:
            return self.word(c, w)
        freed = max(sum(min(self.d, self.pairs[c][v, x]) for x in self.after[v]) / n, T.LEAST)
        took = sum(max(self.pairs[c][v, x] - self.d, 0) for x in self.after[v]) / n
        beta = max((1 - freed - took) / (1 - sum(self.word(c, x) for x in self.after[v])), T.LEAST ** 2)
        own = max(self.pairs[c][v, w] - self.d, 0) / n if w in self.after[v] else beta * self.word(c, w)
        return own + freed * self.word(c, w)

    def ratio(self, text):
        w = words(lower(text)) + ["</s>"]
        return sum(math.log(self.p(1, a, b) / self.p(0, a, b)) for a, b in zip(["<s>"] + w, w))


def small_corpus():
    """Few words, so that many pairs, contexts and words have counts of their own."""
    rng = random.Random(11)
    rows = []
    for _ in range(260):
        bad = rng.random() < 0.3
        text = [rng.choice("abcdefgh") if rng.random() < 0.9 else f"rare{rng.randint(0, 40)}" for _ in range(rng.randint(0, 12))]
        for k in range(len(text) - 1):
            if bad and text[k] == "c" and rng.random() < 0.8:
                text[k + 1] = "clod"
            if not bad and text[k] == "f":
                text[k + 1] = "polite"
        rows.append((" ".join(text), int(bad)))
    return rows


def test_ratios_are_those_of_the_plain_models(spark):
    rows = small_corpus()
    plain = Plain(rows, gate=6.0)
    assert len(plain.own) > 1 and len(plain.gated) > 4 and len(plain.own) < len(plain.shared)
    model = T.fit_ratios(spark.createDataFrame(rows, "text string, label int").repartition(3), gate=6.0)
    texts = [t for t, _ in rows[:60]] + ["", None, "unseen words only", "c clod clod c", "f polite c unseen", "CLOD", "rare1 rare2 rare999"]
    n, got = T.log_ratios(pa.array(texts), model)
    assert n.tolist() == [len(words(t)) + 1 for t in texts]
    assert got == pytest.approx([plain.ratio(t) for t in texts], abs=1e-9)


def test_plain_models_are_distributions():
    plain = Plain(small_corpus(), gate=6.0)
    unseen = 1 / plain.whole
    for c in (0, 1):
        for v in [None, "<s>", "a", "c", "f", "clod", "polite", "rare1", *list(plain.after)[:10]]:
            total = sum(plain.p(c, v, w) for w in plain.shared) + plain.p(c, v, "never seen")
            assert total == pytest.approx(1, abs=2e-6), (c, v)
    assert plain.q("never seen") == unseen


def test_every_labelled_row_is_fitted(spark):
    docs = spark.range(30_000).selectExpr("id as doc_id", "concat('w', id % 9) as text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 10 = 0) as toxic")
    n = {r["label"]: r["count"] for r in T.labelled_sample(docs, labels).groupBy("label").count().collect()}
    truth = {k: sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(30_000) if (i % 10 == 0) == k) for k in (0, 1)}
    assert n == truth


def test_a_bound_keeps_the_class_share(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(4000):  # most texts with the word are ordinary ones
        bad = rng.random() < 0.11
        rows.append(row(i, prose(rng, 30) + (" clod" if rng.random() < (0.6 if bad else 0.25) else "")))
        labels.append((i, int(bad), "x"))
    df, known = frame(spark, rows), labelled(spark, labels)
    whole, bounded = (T.toxicity(df, known, **x).agg({"predicted": "avg"}).first()[0] for x in ({}, {"fit_docs": 350}))
    assert abs(whole - bounded) < 0.05
