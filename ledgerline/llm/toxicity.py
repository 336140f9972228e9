"""Toxicity by class-conditional Kneser-Ney models.

Each class has a bigram model of words.  Counts are of documents, so that one
text that repeats itself does not weigh more.  A pair's probability is its
discounted count over its context's, plus the mass that the discount frees times
the probability of the word alone; that one is the class's discounted
continuation count (different words before it) plus its freed mass times the
word's share of the continuation counts of both classes together.

Only expressions whose classes differ clearly (``GATE``, a likelihood-ratio
statistic) have counts of their own in the classes.  All others are smoothed
through the shared counts alone: the class's remaining mass is spread over them
as the shared model has it.  A rare or even expression thus weighs as much in
one class as in the other, where the classes' own counts would tell little more
than which class has more text.

A text's log-likelihoods, per token and in all, are compared; a logistic curve
over their difference and the text's length, fitted on labelled rows that the
counts were not taken from, turns it into a score from 0 to 1.  For tokens
without counts of their own the shared probabilities cancel, so tasks get three
tables of log ratios: of pairs, of contexts (their remaining mass) and of words.

The models are fitted on at most about ``fit_docs`` labelled rows that are not
held out (all of them where there are fewer; else a share by a hash of the id, both
classes at one rate, so that the class shares stay), which bounds those tables.
Scoring reads every row and whole text.

Defined cases: null and empty texts are the end token alone; rows without a
usable label (null or other than 0 and 1), without an id or held out are not
learnt from; of several labels for an id the largest counts; without rows of
both classes every score is the share of toxic rows (0 without any); repeated
rows score alike; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import checked_join, crc_mod, hash_words, ids_and_texts, load, materialize, mix64, slices, words

GATE = 20.0
DISCOUNT = 0.75
#: Least mass that a class or context leaves to the level below.
LEAST = 1e-6
FIT_DOCS = 30_000
#: The held-out rows, and the share of the others that the logistic curve is fitted on.
FOLDS = 5
CURVE_SHARE = 4
#: Stand for a text's start and end.
START, END = np.uint64(1), np.uint64(2)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets per text, and the hashes of each token (words, then the end) and of the token before it."""
    at, ids, vocab = words(texts)
    end = at[1:] + np.arange(len(at) - 1)
    new = at + np.arange(len(at))
    token = np.empty(new[-1], np.uint64)
    word = np.ones(new[-1], bool)
    word[end] = False
    token[word] = hash_words(vocab)[ids] if len(ids) else 0
    token[end] = END
    before = np.concatenate([[START], token])[:-1] if len(token) else token
    before[new[:-1]] = START
    return new, token, before


def pair_hash(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix64(before * np.uint64(0x9E3779B97F4A7C15) + token + np.uint64(1))


def class_counts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(v, w, toxic, ordinary) and (w, toxic, ordinary): documents of each class with a pair or word.  ``rows``: text, label."""

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                at, token, before = tokens(part.column("text"))
                label = part.column("label").to_numpy(zero_copy_only=False)
                of = np.repeat(np.arange(len(label)), np.diff(at))
                for alone in (True, False):
                    key = token if alone else pair_hash(before, token)
                    by = np.lexsort((of, key))
                    new = np.ones(len(by), bool)
                    new[1:] = (key[by][1:] != key[by][:-1]) | (of[by][1:] != of[by][:-1])
                    by = by[new]  # one of each expression and text
                    first = np.ones(len(by), bool)
                    first[1:] = key[by][1:] != key[by][:-1]
                    head = by[first]
                    edge = np.flatnonzero(first)
                    toxic = np.add.reduceat(label[of[by]].astype(np.int64), edge)
                    n = np.diff(np.append(edge, len(by)))
                    v = pa.nulls(len(head), pa.int64()) if alone else pa.array(before[head].view(np.int64))
                    yield pa.RecordBatch.from_arrays([v, pa.array(token[head].view(np.int64)), pa.array(toxic), pa.array(n - toxic)], ["v", "w", "toxic", "ordinary"])

    counts = materialize(rows.select("text", "label").mapInArrow(count, "v long, w long, toxic long, ordinary long")
                         .groupBy("v", "w").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")), "class-counts")
    return counts.where("v is not null"), counts.where("v is null").drop("v")


def _differs(counts: DataFrame, gate: float) -> DataFrame:
    """The expressions whose likelihood-ratio statistic against even shares reaches ``gate``."""
    totals = counts.agg(F.sum("toxic").alias("t"), F.sum("ordinary").alias("o")).first()
    p = (totals["t"] or 0) / max((totals["t"] or 0) + (totals["o"] or 0), 1)
    c = F.col("toxic") + F.col("ordinary")
    part = lambda n, share: F.when(n > 0, n * F.log(n / (c * share))).otherwise(0.0)
    return counts.where(2 * (part(F.col("toxic"), p) + part(F.col("ordinary"), 1 - p)) > gate)


CLASSES = ("toxic", "ordinary")


def fit_ratios(rows: DataFrame, gate: float = GATE, discount: float = DISCOUNT) -> dict:
    """Sorted hashes and log ratios of pairs, contexts and words, and the ratio of all other words.  Collects the gated expressions."""
    pairs, alone = class_counts(rows)
    seen = materialize(pairs.groupBy("w").agg(*[F.sum((F.col(c) > 0).cast("long")).alias(f"kinds_{c}") for c in CLASSES], F.count("*").alias("kinds")), "continuations")
    total = seen.agg(*[F.sum(f"kinds_{c}").alias(c) for c in CLASSES], F.sum("kinds").alias("kinds"), F.count("*").alias("words")).first()
    whole = (total["kinds"] or 0) + total["words"] + 1  # one for each word, and one for those never seen
    shared = (F.col("kinds") + 1) / whole

    # Words: own continuation counts of the classes, and what they leave.
    own = materialize(_differs(alone, gate).select("w").join(seen, "w").withColumn("shared", shared), "own-words")
    least = lambda c: F.least(F.lit(discount), F.col(c))
    sums = own.agg(F.sum("shared").alias("shared"), *[F.sum(f"kinds_{c}").alias(f"n_{c}") for c in CLASSES], *[F.sum(least(f"kinds_{c}")).alias(f"freed_{c}") for c in CLASSES]).first()
    freed, rest = {}, {}
    for c in CLASSES:
        n, took, lost = max(total[c] or 0, 1), sums[f"n_{c}"] or 0, sums[f"freed_{c}"] or 0.0
        freed[c] = max(lost / n, LEAST)
        rest[c] = max((1 - freed[c] - (took - lost) / n) / (1 - (sums["shared"] or 0.0)), LEAST * LEAST)
    own = own.select("w", "shared", *[(F.greatest(F.col(f"kinds_{c}") - discount, F.lit(0.0)) / max(total[c] or 0, 1) + freed[c] * F.col("shared")).alias(f"p_{c}") for c in CLASSES])

    # Pairs and their contexts.
    gated = materialize(_differs(pairs, gate), "own-pairs")
    contexts = pairs.join(gated.select("v").distinct(), "v", "left_semi").groupBy("v").agg(*[F.sum(c).alias(f"n_{c}") for c in CLASSES])
    word_p = seen.join(gated.select("w").distinct(), "w", "left_semi").withColumn("tied", shared).select("w", "tied").join(own.drop("shared"), "w", "left")
    gated = gated.join(word_p, "w").join(contexts, "v")
    gated = materialize(gated.select("v", "w", *CLASSES, *[f"n_{c}" for c in CLASSES],
                                     *[F.coalesce(f"p_{c}", (rest[c] + freed[c]) * F.col("tied")).alias(f"p_{c}") for c in CLASSES]), "own-pairs")
    by_context = gated.groupBy("v").agg(*[F.first(f"n_{c}").alias(f"n_{c}") for c in CLASSES], *[F.sum(c).alias(f"took_{c}") for c in CLASSES],
                                        *[F.sum(least(c)).alias(f"lost_{c}") for c in CLASSES], *[F.sum(f"p_{c}").alias(f"below_{c}") for c in CLASSES])
    for c in CLASSES:
        n, g = F.col(f"n_{c}"), F.greatest(F.col(f"lost_{c}") / F.col(f"n_{c}"), F.lit(LEAST))
        beta = F.greatest((1 - g - (F.col(f"took_{c}") - F.col(f"lost_{c}")) / n) / (1 - F.col(f"below_{c}")), F.lit(LEAST * LEAST))
        by_context = by_context.withColumns({f"g_{c}": F.when(n > 0, g).otherwise(1.0), f"left_{c}": F.when(n > 0, beta + g).otherwise(1.0)})
    by_context = materialize(by_context.select("v", *[f"{x}_{c}" for x in ("g", "left") for c in CLASSES]), "own-contexts")
    gated = gated.join(by_context, "v")
    in_pair = {c: F.when(F.col(f"n_{c}") > 0, F.greatest(F.col(c) - discount, F.lit(0.0)) / F.col(f"n_{c}")).otherwise(0.0) + F.col(f"g_{c}") * F.col(f"p_{c}") for c in CLASSES}

    def table(df: DataFrame, ratio) -> tuple[np.ndarray, np.ndarray]:
        got = df.withColumn("r", F.log(ratio)).toArrow()
        h = [got.column(c).to_numpy().view(np.uint64) for c in ("v", "w") if c in got.column_names]
        h = pair_hash(*h) if len(h) > 1 else h[0]
        by = np.argsort(h)
        return h[by], got.column("r").to_numpy()[by]

    return {"pairs": table(gated.select("v", "w", (in_pair["toxic"] / in_pair["ordinary"]).alias("x")), F.col("x")),
            "contexts": table(by_context.select("v", (F.col("left_toxic") / F.col("left_ordinary")).alias("x")), F.col("x")),
            "words": table(own.select("w", (F.col("p_toxic") / F.col("p_ordinary")).alias("x")), F.col("x")),
            "others": math.log((rest["toxic"] + freed["toxic"]) / (rest["ordinary"] + freed["ordinary"]))}


def _looked_up(keys: np.ndarray, table: tuple[np.ndarray, np.ndarray], other: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """For each key its ratio (``other`` if it has none) and whether it has one."""
    hashes, ratios = table
    if not len(hashes):
        return np.full(len(keys), other), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
    hit = hashes[at] == keys
    return np.where(hit, ratios[at], other), hit


def log_ratios(texts: pa.Array, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each text, and the log of its toxic over its ordinary likelihood."""
    at, token, before = tokens(texts)
    kinds, which = np.unique(token, return_inverse=True)  # each token once
    word, _ = _looked_up(kinds, model["words"], model["others"])
    context, known = _looked_up(kinds, model["contexts"])
    first, known_first = _looked_up(np.array([START], np.uint64), model["contexts"])
    previous = np.concatenate([which[:1], which])[:-1] if len(which) else which
    starts = at[:-1]
    r, special = word[which] + context[previous], known[previous]
    r[starts], special[starts] = word[which[starts]] + first[0], known_first[0]
    at_pairs = np.flatnonzero(special)  # a pair with counts has a context with counts
    pair, hit = _looked_up(pair_hash(before[at_pairs], token[at_pairs]), model["pairs"])
    r[at_pairs[hit]] = pair[hit]
    n = np.diff(at)
    return n, np.add.reduceat(r, starts) if len(starts) else np.zeros(0)


def features(texts: pa.Array, model: dict) -> np.ndarray:
    """Per text: the log ratio per token, in all and by the root of the length (both on a scale that flattens far out), and the log length."""
    n, total = log_ratios(texts, model)
    return np.stack([total / n, np.arcsinh(total), np.arcsinh(total / np.sqrt(n)), np.log(n)], 1)


def _vectors(rows: DataFrame, ratios) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                x = features(part.column("text"), ratios)
                yield pa.RecordBatch.from_arrays([pa.array(x[:, k]) for k in range(4)] + [part.column("label").cast(pa.float64())], ["a", "b", "c", "d", "label"])

    return materialize(rows.select("text", "label").mapInArrow(run, "a double, b double, c double, d double, label double"), "curve-vectors")


def _summed(vectors: DataFrame, of) -> np.ndarray:
    """The sum of ``of(x, y)`` over all rows: one array from each task, added without rounding, so their order does not matter."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(np.stack([batch.column(k).to_numpy() for k in range(4)], 1), batch.column(4).to_numpy())
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

    got = vectors.mapInArrow(run, "sums array<double>").toArrow().column("sums").to_pylist()
    return np.array([math.fsum(k) for k in zip(*got, strict=True)])


def _moments(vectors: DataFrame) -> np.ndarray:
    """Rows, toxic rows, sums and sums of squares of the features (empty without rows)."""
    return _summed(vectors, lambda x, y: np.concatenate([[len(y), y.sum()], x.sum(0), (x * x).sum(0)]))


def fit_curve(vectors: DataFrame, moments: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and spread of the features, and logistic weights (the last is the constant), by Newton steps over all rows."""
    n, mean = moments[0], moments[2:6] / moments[0]
    spread = np.sqrt(np.maximum(moments[6:] / n - mean * mean, 0)) + 1e-9
    w = np.zeros(len(mean) + 1)
    for _ in range(50):

        def slopes(x, y, w=w):
            z = np.c_[(x - mean) / spread, np.ones(len(x))]
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            return np.concatenate([z.T @ (p - y), ((z.T * (p * (1 - p) + 1e-6)) @ z).ravel()])

        got = _summed(vectors, slopes)
        step = np.linalg.solve(got[len(w):].reshape(len(w), len(w)) + 1e-2 * np.eye(len(w)), got[:len(w)] + 1e-2 * w)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return mean, spread, w


def labelled_sample(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, fit_docs: int | None = FIT_DOCS) -> DataFrame:
    """(text, label, curve): labelled rows that are not held out; about ``fit_docs`` of both classes together where there are more, by a hash of the id."""
    known = (labels.select(labels["doc_id"].alias("doc_id"), labels["toxic"].cast("int").alias("label")).where("label in (0, 1) and doc_id is not null")
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    known = known.where(crc_mod(F.col("doc_id"), folds) != 0).withColumn("by", F.xxhash64("doc_id", F.lit(7)))
    if fit_docs is not None:
        n = known.count()
        known = known.where(F.shiftrightunsigned("by", 11) < float(1 << 53) * fit_docs / n) if n > fit_docs else known
    picked = materialize(known.select("doc_id", "label", (F.pmod("by", F.lit(CURVE_SHARE)) == 0).alias("curve")), "labelled")
    return materialize(checked_join(docs.where("doc_id is not null"), picked, "doc_id").select("text", "label", "curve"), "labelled-texts")


def fit(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, fit_docs: int | None = FIT_DOCS) -> dict:
    """The model: log ratios and curve, or a constant score where one class is missing."""
    rows = labelled_sample(docs, labels, folds, fit_docs)
    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return {"constant": 1.0 if n.get(1) else 0.0}
    ratios = fit_ratios(rows.where("not curve"))
    vectors = _vectors(rows.where("curve"), ratios)
    moments = _moments(vectors)
    if not len(moments) or moments[1] in (0, moments[0]):
        vectors = _vectors(rows, ratios)
        moments = _moments(vectors)
    return {"ratios": ratios, "curve": fit_curve(vectors, moments)}


def scorer(spark, model: dict):
    """A function from texts to scores (0 to 1), to be called in tasks."""
    held = spark.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> np.ndarray:
        if "constant" in held.value:
            return np.full(len(texts), held.value["constant"])
        ratios, (mean, spread, w) = held.value["ratios"], held.value["curve"]
        out = [np.zeros(0)]
        for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
            z = (features(part.column("text"), ratios) - mean) / spread
            out.append(1 / (1 + np.exp(-np.clip(z @ w[:-1] + w[-1], -30, 30))))
        return np.concatenate(out)

    return run


def toxicity(documents: DataFrame, labels: DataFrame, folds: int = FOLDS, fit_docs: int | None = FIT_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.  Labels are learnt from rows whose crc32(id) mod ``folds`` is not 0."""
    docs = ids_and_texts(documents, id_col, text_col)
    score = scorer(docs.sparkSession, fit(docs, labels, folds, fit_docs))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score(batch.column("text")))], ["doc_id", "score"])

    scored = docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), folds) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(documents: DataFrame, labels: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``documents``, all columns, that score below ``least``."""
    score = scorer(documents.sparkSession, fit(ids_and_texts(documents, id_col, text_col), labels))
    at = documents.columns.index(text_col)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(score(batch.column(at)) < least))

    return documents.mapInArrow(run, documents.schema)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
