"""Language ID by sparse multinomial logistic regression on TF-IDF character n-grams.

Each letter of a text gives three n-grams: itself, it with the character before
and it between its neighbours; whatever is not a letter counts as one border.
Letters are lower-cased, n-grams are hashed to ``BUCKETS`` columns.  A column's
value is its share of the text's n-grams times its inverse document frequency
over all learning texts, so a text's class sums are the mean over its letters of
what each letter's columns weigh, and a task adds them up word by word.

The weights follow the regularised leader (FTRL-proximal: a rate for each
weight, elastic-net penalty, weights within the L1 bound are zero).  Shards of
the learning rows each go on from the common state, text by text; after each
round the shards' states are averaged.  A temperature, fitted on learning rows
that the weights were not, makes the best class's probability the score.

The classifier is fitted on about ``fit_docs`` learning texts (chosen by a hash,
with at least ``least`` of each language where there are as many, and weighted
so that each language keeps its share); document frequencies count all learning
texts, and every row is scored on its whole text.

Defined cases: a null text or one without a letter is ``und`` with score 0; rows
without text, letters or language, and held-out ones, are not learnt from; with
nothing to learn from, every row is ``und`` with score 0; with one language
learnt, it has score 1; of equally likely languages the first by code point is
taken; a null id counts as the empty id for the folds; repeated rows score alike;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import crc_mod, load, materialize, mix64, slices, words

UNKNOWN = "und"
#: Held out: rows whose crc32(id) modulo FOLDS is HELD.
FOLDS, HELD = 4, 2
BUCKETS = 1 << 15
#: Texts that the classifier is fitted on, least of a language, texts in a shard, rounds over them, and one in CALIBRATE for the temperature.
FIT_DOCS, LEAST, SHARD, ROUNDS, CALIBRATE = 16_000, 500, 2_000, 2, 8
#: FTRL-proximal: rate and its offset, L1 and L2 penalties; columns' values are multiplied by UNIT.
ALPHA, BETA, L1, L2, UNIT = 0.5, 1.0, 0.5, 0.01, 32.0
TEMPERATURES = np.geomspace(0.05, 20, 121)
#: Cells of a block of texts by columns while columns are counted.
CELLS = 1 << 22

_BORDER = 0x20


def _letter(c: int) -> int:
    """A letter's lower case, or the border."""
    x = chr(c)
    return ord(x.lower()[0]) if x.isalpha() else _BORDER


_COMMON = np.array([_letter(c) for c in range(0x3000)], np.uint32)


def letters(vocab: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets per word of its letters, and for each letter the columns of its three n-grams."""
    text = " " + " ".join(vocab) + " "
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = np.full(len(points), _BORDER, np.uint32)
    common = points < len(_COMMON)
    low[common] = _COMMON[points[common]]
    if not common.all():
        found, which = np.unique(points[~common], return_inverse=True)
        low[~common] = np.array([_letter(int(c)) for c in found], np.uint32)[which]
    at = np.flatnonzero(low != _BORDER)
    c, before, after = (low[at + k].astype(np.uint64) for k in (0, -1, 1))
    key = np.stack([c, (c << np.uint64(21)) | before | np.uint64(1 << 62), (c << np.uint64(42)) | (before << np.uint64(21)) | after | np.uint64(1 << 63)], 1)
    columns = (mix64(key) & np.uint64(BUCKETS - 1)).astype(np.int32)
    ends = np.cumsum(np.fromiter(map(len, vocab), np.int64, len(vocab)) + 1)  # of each word with the blank before it
    return np.searchsorted(at, np.concatenate([[0], ends])), columns


def _expand(at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the words ``ids``: the positions of all their letters, and how many each has."""
    size = at[ids + 1] - at[ids]
    upto = np.cumsum(size)
    return np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - size - at[ids], size), size


def column_counts(texts: pa.Array):
    """Blocks of texts: (first text, counts by text and column)."""
    of, ids, vocab = words(texts, lower=False)
    at, columns = letters(vocab)
    step = max(1, CELLS // BUCKETS)
    for first in range(0, len(texts), step):
        last = min(first + step, len(texts))
        text = np.repeat(np.arange(last - first), np.diff(of[first:last + 1]))
        pairs, times = np.unique(text * max(len(vocab), 1) + ids[of[first]:of[last]], return_counts=True)  # each word of a text once
        text, word = np.divmod(pairs, max(len(vocab), 1))
        where, size = _expand(at, word)
        cells = (np.repeat(text, size)[:, None] * BUCKETS + columns[where]).ravel()
        counts = np.bincount(cells, weights=np.repeat(times, 3 * size), minlength=(last - first) * BUCKETS)
        yield first, counts.reshape(last - first, BUCKETS)


def document_frequencies(learning: DataFrame) -> tuple[int, np.ndarray]:
    """Learning texts with letters, and for each column how many of them have it.  Collects one row per column."""

    def run(batches):
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text"):
                for _, counts in column_counts(part.column("text")):
                    has = counts > 0
                    total += has.sum(0)
                    n += int(has.any(1).sum())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(total[at], n))], ["column", "n"])

    got = learning.select("text").mapInArrow(run, "column int, n long").groupBy("column").agg(F.sum("n").alias("n")).toArrow()
    at, n = got.column("column").to_numpy(), got.column("n").to_numpy()
    out = np.zeros(BUCKETS, np.int64)
    out[at[at >= 0]] = n[at >= 0]
    return int(n[at < 0].sum()), out


def inverse_frequencies(n: int, df: np.ndarray) -> np.ndarray:
    return np.log((1 + n) / (1 + df)) + 1


def fit_rows(learning: DataFrame, fit_docs: int, least: int) -> tuple[list[str], DataFrame]:
    """The languages in order, and (number, weight, hash, text) of the texts to fit on.  Collects one row per language."""
    n = {r["lang"]: r["n"] for r in learning.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs, all_rows = sorted(n, key=lambda x: x.encode()), sum(n.values())
    take = {k: min(1.0, max(fit_docs * n[k] / all_rows, least) / n[k]) for k in langs}
    mean = sum(n[k] * take[k] for k in langs) / max(all_rows, 1)
    if not langs:
        return langs, learning.select(F.lit(0).alias("number"), F.lit(1.0).alias("weight"), F.lit(0).cast("long").alias("hash"), "text").where("false")
    table = learning.sparkSession.createDataFrame([(k, i, take[k], mean / take[k]) for i, k in enumerate(langs)], "lang string, number int, rate double, weight double")
    drawn = learning.withColumn("hash", F.xxhash64("doc_id", "text", F.lit(11)))
    drawn = drawn.join(F.broadcast(table), "lang").where(F.shiftrightunsigned("hash", 11) < F.col("rate") * float(1 << 53))
    return langs, drawn.select("number", "weight", "hash", "text")


def vectors(rows: DataFrame, idf: np.ndarray) -> DataFrame:
    """(number, weight, hash, columns, values): the rows' sparse TF-IDF vectors, those with letters."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                for first, counts in column_counts(part.column("text")):
                    total = counts.sum(1)
                    keep = np.flatnonzero(total)
                    text, column = np.nonzero(counts[keep])
                    value = counts[keep][text, column] / total[keep][text] * idf[column] * UNIT
                    ends = pa.array(np.searchsorted(text, np.arange(len(keep) + 1)).astype(np.int32))
                    same = part.take(pa.array(first + keep))
                    yield pa.RecordBatch.from_arrays([*(same.column(c) for c in ("number", "weight", "hash")), pa.ListArray.from_arrays(ends, pa.array(column.astype(np.int32))),
                                                      pa.ListArray.from_arrays(ends, pa.array(value))], ["number", "weight", "hash", "columns", "values"])

    return rows.select("number", "weight", "hash", "text").mapInArrow(run, "number int, weight double, hash long, columns array<int>, values array<double>")


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """FTRL-proximal weights of a state; the last column is the constant, without penalty."""
    free = np.zeros(z.shape[-1], bool)
    free[-1] = True
    return _weights(z, n, np.where(free, 0.0, L1), np.where(free, 0.0, L2))


def _weights(z, n, l1, l2):
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + l2))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(0))
    return e / e.sum(0)


def follow_the_leader(z: np.ndarray, n: np.ndarray, rows) -> None:
    """One round over the rows (number, weight, columns, values), text by text; z and n change in place."""
    for number, weight, columns, values in rows:
        at = np.append(columns, BUCKETS)
        x = np.append(values, 1.0)
        penal = np.ones(len(at))
        penal[-1] = 0
        zs, ns = z[:, at], n[:, at]
        w = _weights(zs, ns, L1 * penal, L2 * penal)
        p = softmax(w @ x)
        p[number] -= 1
        g = weight * p[:, None] * x
        grown = ns + g * g
        z[:, at] = zs + g - (np.sqrt(grown) - np.sqrt(ns)) / ALPHA * w
        n[:, at] = grown


def _rows_of(table) -> list:
    number, weight = table.column("number").to_pylist(), table.column("weight").to_pylist()
    parts = [table.column(c).combine_chunks() for c in ("columns", "values")]
    at = parts[0].offsets.to_numpy()
    columns, values = (p.flatten().to_numpy(zero_copy_only=False) for p in parts)
    at = at - at[0]
    return [(number[k], weight[k], columns[at[k]:at[k + 1]], values[at[k]:at[k + 1]]) for k in range(len(number))]


def train(rows: DataFrame, classes: int, rounds: int = ROUNDS, shard: int = SHARD) -> np.ndarray:
    """Weights by class and column.  A round collects the averaged state: at most one row per class and column."""
    n_rows = rows.count()
    shards = max(1, math.ceil(n_rows / shard))
    dealt = rows.withColumn("shard", F.pmod(F.shiftright("hash", 20), F.lit(shards)))
    state = np.zeros((classes, BUCKETS + 1)), np.zeros((classes, BUCKETS + 1))

    def one_round(z0, n0, k):
        def run(table):
            z, n = z0.copy(), n0.copy()
            mine = _rows_of(table)
            order = np.argsort(mix64(table.column("hash").to_numpy().view(np.uint64) + np.uint64(k)), kind="stable")
            follow_the_leader(z, n, [mine[i] for i in order])
            cls, column = np.nonzero((z != z0) | (n != n0))
            return pa.table({"class": pa.array(cls.astype(np.int32)), "column": pa.array(column.astype(np.int32)), "z": pa.array((z - z0)[cls, column]), "n": pa.array((n - n0)[cls, column])})

        return run

    for k in range(rounds if n_rows else 0):
        z, n = state
        found = (dealt.groupBy("shard").applyInArrow(one_round(z, n, k), "class int, column int, z double, n double")
                 .groupBy("class", "column").agg(F.sum("z").alias("z"), F.sum("n").alias("n")).toArrow())
        cls, column = found.column("class").to_numpy(), found.column("column").to_numpy()
        z[cls, column] += found.column("z").to_numpy() / shards
        n[cls, column] += found.column("n").to_numpy() / shards
    return weights(*state)


def fit_temperature(rows: DataFrame, w: np.ndarray) -> float:
    """The temperature of the least log-loss, of a fixed list.  Collects one row of losses per task."""

    def run(batches):
        total = np.zeros(len(TEMPERATURES))
        for batch in batches:
            for number, weight, columns, values in _rows_of(pa.Table.from_batches([batch])):
                x = w[:, columns] @ values + w[:, -1]
                scaled = (x - x.max())[:, None] / TEMPERATURES
                total += weight * (np.log(np.exp(scaled).sum(0)) - scaled[number])
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["loss"])

    got = rows.mapInArrow(run, "loss array<double>").toArrow().column("loss").to_pylist()
    loss = [math.fsum(x) for x in zip(*got, strict=True)]
    return float(TEMPERATURES[int(np.argmin(loss))]) if loss and max(loss) > 0 else 1.0


def fit(learning: DataFrame, fit_docs: int = FIT_DOCS, least: int = LEAST, rounds: int = ROUNDS) -> dict:
    """The model from (doc_id, text, lang): languages, weights of one letter's columns (idf in them), constants, temperature."""
    n, df = document_frequencies(learning)
    idf = inverse_frequencies(n, df)
    langs, rows = fit_rows(learning, fit_docs, least)
    if not n or not langs:
        return {"langs": []}
    found = materialize(vectors(rows, idf), "language-vectors")
    last = F.pmod(F.shiftright("hash", 40), F.lit(CALIBRATE)) == 0
    w = train(found.where(~last), len(langs), rounds)
    held = found.where(last)
    return {"langs": langs, "w": w[:, :-1] * (idf * UNIT / 3), "constant": w[:, -1], "temperature": fit_temperature(held, w)}


def class_sums(model: dict, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters of each text, and its sums by language (before the temperature)."""
    of, ids, vocab = words(texts, lower=False)
    at, columns = letters(vocab)
    size = np.diff(at)
    text = np.repeat(np.arange(len(texts)), np.diff(of))
    n = np.bincount(text, weights=size[ids], minlength=len(texts))
    word = np.repeat(np.arange(len(vocab)), size)
    sums = np.zeros((len(model["langs"]), len(texts)))
    for k, w in enumerate(model["w"]):
        by_word = np.bincount(word, weights=w[columns].sum(1), minlength=len(vocab))
        sums[k] = np.bincount(text, weights=by_word[ids], minlength=len(texts)) / np.maximum(n, 1) + model["constant"][k]
    return n, sums


def language_id(documents: DataFrame, folds: int = FOLDS, held: int = HELD, fit_docs: int = FIT_DOCS, least: int = LEAST, rounds: int = ROUNDS,
                id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.  Languages are learnt from rows that are not held out."""
    docs = documents.select(documents[id_col].alias("doc_id"), documents[text_col].alias("text"), documents[lang_col].cast("string").alias("lang"))
    held_out = crc_mod(F.col("doc_id"), folds) == held
    model = fit(docs.where(~held_out & F.col("text").isNotNull() & F.col("lang").isNotNull()), fit_docs, least, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        names = np.array(model["langs"] or [UNKNOWN], object)
        for batch in batches:
            for part in slices(batch, "text"):
                pred, score = np.full(part.num_rows, UNKNOWN, object), np.zeros(part.num_rows)
                if model["langs"]:
                    n, sums = class_sums(model, part.column("text"))
                    p = softmax(sums / model["temperature"])
                    known = n > 0
                    pred, score = np.where(known, names[sums.argmax(0)], UNKNOWN), np.where(known, p.max(0), 0.0)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(pred, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op12_language_id(spark, sf_dir: str) -> DataFrame:
    return language_id(load(spark, sf_dir, "documents"))
