"""Hidden Markov language model.

A text is its words and one end, a sequence of tokens.  The model has
``states`` latent states; a state emits a class of words, and the class emits
the word, with counts of the whole training corpus (a tenth is added, and one
unknown word per class counts like a word never seen).  Words of up to five
characters are classes of their own; longer ones share a class by their first
two and last three characters, so the emission table has a fixed size whatever
the vocabulary, and tasks can be given it.

Training is Baum-Welch over all training texts: each task runs scaled forward
and backward recursions over its texts and sends expected counts per class and
state; these are summed over the cluster.  Scoring is the scaled forward
recursion in double precision, which gives the exact likelihood.

Word counts grow with the corpus, so no task holds them all.  A block of texts
is read once into token numbers of its own word list; the lists meet by word,
and each block gets back the counts of its own words only.

Defined cases: a null or empty text is the end alone; null ids are held out
(as crc32 of the empty text is 0) and repeated ones scored alike; without
training texts all counts are 0 and classes equally likely; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import crc_mod, hash_words, ids_and_texts, load, materialize, slices, words
from ledgerline.session import shared_dir

STATES = 12
#: Class 0 is the end; longer words share the others.
CLASSES = 1 << 15
ROUNDS = 4
FOLDS = 10
ADDED = 0.1
#: Weight of the classes' overall shares in a state's emissions.
PRIOR = 50.0
STAY = 0.95
BLOCK_BYTES = 32 << 20
#: Tokens whose states a task holds at a time.
BATCH = 300_000
END = np.uint64(1)
BLOCKS = "block long, doc_ids array<long>, held array<boolean>, sizes array<int>, tokens binary, word_classes binary"
LISTS = "block long, wid int, wh long, g int, c long"


def word_classes(vocab: list[str]) -> np.ndarray:
    short = [w if len(w) <= 5 else f"{w[:2]}\t{w[-3:]}" for w in vocab]
    return (1 + hash_words(short, 3) % np.uint64(CLASSES - 1)).astype(np.uint16)


def encode(docs: DataFrame, path: str) -> None:
    """Writes blocks of texts as token numbers (kind b) and their word lists with training counts (kind w)."""

    def run(batches):
        from pyspark import TaskContext

        number = (TaskContext.get().partitionId() << 24) - 1
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                number += 1
                at, ids, vocab = words(part.column("text"))
                end = len(vocab)
                tokens = np.insert(ids.astype(np.int32), at[1:], end)
                sizes = np.diff(at) + 1
                held = part.column("held").to_numpy(zero_copy_only=False)
                c = np.bincount(tokens[np.repeat(~held, sizes)], minlength=end + 1)
                g = np.append(word_classes(vocab), np.uint16(0))
                wh = np.append(hash_words(vocab), END).view(np.int64)
                seen = np.flatnonzero(np.bincount(tokens, minlength=end + 1))
                one = lambda v, t: pa.array([v], t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(["b"]), one(number, pa.int64()), pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([held.tolist()], pa.list_(pa.bool_())),
                     pa.array([sizes.tolist()], pa.list_(pa.int32())), pa.array([tokens.tobytes()], pa.binary()), pa.array([g.tobytes()], pa.binary()),
                     *(pa.nulls(1, t) for t in (pa.int32(), pa.int64(), pa.int32(), pa.int64()))], names)
                for s in range(0, len(seen), 100_000):
                    k = seen[s:s + 100_000]
                    n = len(k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, "w")), pa.array(np.full(n, number)), *(pa.nulls(n, t) for t in (pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary())),
                         pa.array(k.astype(np.int32)), pa.array(wh[k]), pa.array(g[k].astype(np.int32)), pa.array(c[k].astype(np.int64))], names)

    schema = f"kind string, {BLOCKS}, {LISTS.partition(', ')[2]}"
    names = [c.split()[0] for c in schema.split(", ")]
    docs.mapInArrow(run, schema).write.partitionBy("kind").option("compression", "zstd").parquet(path)


def time_major(sizes: np.ndarray):
    """For sequences by falling size: sequences alive at each step, where each step starts, and each token's place by step."""
    alive = np.bincount(sizes, minlength=sizes[0] + 1)[::-1].cumsum()[::-1][1:]  # sequences longer than t
    start = np.concatenate([[0], np.cumsum(alive)[:-1]])
    t = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return alive, start, start[t] + np.repeat(np.arange(len(sizes)), sizes)


def batches_of(tokens: np.ndarray, sizes: np.ndarray):
    """(which sequences, sizes, alive, start, tokens by step), longest first, of about BATCH tokens."""
    begin = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    upto = np.cumsum(sizes[order])
    a = 0
    while a < len(order):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + BATCH, side="right")))
        pick = order[a:b]
        n = sizes[pick]
        alive, start, place = time_major(n)
        flat = np.empty(n.sum(), tokens.dtype)
        flat[place] = tokens[np.repeat(begin[pick] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        yield pick, n, alive, start, flat
        a = b


def forward(b: np.ndarray, alive, start, first: np.ndarray, move: np.ndarray, alpha: np.ndarray | None = None) -> np.ndarray:
    """Scale of each token (its probability given those before); ``b``: emission by token and state, step by step."""
    scale = np.empty(len(b), b.dtype)
    a = None
    for n, s in zip(alive.tolist(), start.tolist(), strict=True):
        a = first * b[s:s + n] if a is None else (a[:n] @ move) * b[s:s + n]
        z = a.sum(1)
        a /= z[:, None]
        scale[s:s + n] = z
        if alpha is not None:
            alpha[s:s + n] = a
    return scale


def expected(classes: np.ndarray, sizes: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of first states, moves, and emissions by class, of the sequences (scaled forward and backward)."""
    emit, move, first = (model[k].astype(np.float32) for k in ("emit", "move", "first"))
    k = len(first)
    firsts, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros((CLASSES, k))
    for _, _, alive, start, flat in batches_of(classes, sizes):
        b = emit[flat]
        alpha = np.empty_like(b)
        b /= forward(b, alive, start, first, move, alpha)[:, None]  # with the token's scale
        beta = None
        back = np.ascontiguousarray(move.T)
        for t in range(len(alive) - 1, -1, -1):
            n, s = int(alive[t]), int(start[t])
            now = np.ones((n, k), np.float32)
            if beta is not None:
                m = len(beta)
                ahead = b[start[t + 1]:start[t + 1] + m] * beta
                moves += alpha[s:s + m].T @ ahead
                now[:m] = ahead @ back
            beta = now
            alpha[s:s + n] *= now
        firsts += alpha[:alive[0]].sum(0)
        for i in range(k):
            emits[:, i] += np.bincount(flat, weights=alpha[:, i], minlength=CLASSES)
    return firsts, moves * model["move"], emits


def start_model(c: np.ndarray, states: int, seed: int = 5) -> dict:
    """Sticky states whose emissions differ by chance; ``c``: training tokens of each class."""
    share = (c + ADDED) / (c + ADDED).sum()
    emit = share[:, None] * (0.1 + np.random.default_rng(seed).random((CLASSES, states)) ** 2)
    move = np.full((states, states), (1 - STAY) / max(states - 1, 1)) + np.eye(states) * (STAY - (1 - STAY) / max(states - 1, 1))
    return {"emit": emit / emit.sum(0), "move": move / move.sum(1, keepdims=True), "first": np.full(states, 1 / states), "share": share}


def _round(blocks: DataFrame, model: dict) -> dict:
    """One Baum-Welch round.  What comes back to the driver is one row per class and state, whatever the corpus."""
    states = len(model["first"])
    held = blocks.sparkSession.sparkContext.broadcast(model)
    cols = [f"s{i}" for i in range(states)]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["sizes"], np.int64)
                train = ~np.array(row["held"], bool)
                tokens = np.frombuffer(row["tokens"], np.int32)[np.repeat(train, sizes)]
                if not train.any():
                    continue
                firsts, moves, emits = expected(np.frombuffer(row["word_classes"], np.uint16)[tokens], sizes[train], held.value)
                g = np.flatnonzero(emits.any(1))
                all_rows = np.concatenate([emits[g], moves, firsts[None]])
                key = np.concatenate([g, -1 - np.arange(states), [-1 - states]])
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), *(pa.array(all_rows[:, i]) for i in range(states))], ["g", *cols])

    sums = blocks.select("sizes", "held", "tokens", "word_classes").mapInArrow(run, "g int, " + ", ".join(f"{c} double" for c in cols))
    got = sums.groupBy("g").agg(*(F.sum(c).alias(c) for c in cols)).toArrow()
    g = got.column("g").to_numpy()
    s = np.stack([got.column(c).to_numpy() for c in cols], 1) if len(g) else np.zeros((0, states))
    emit, move, first = np.zeros((CLASSES, states)), np.zeros((states, states)), np.zeros(states)
    emit[g[g >= 0]] = s[g >= 0]
    for i, row in zip(g.tolist(), s, strict=True):
        if i == -1 - states:
            first = row
        elif i < 0:
            move[-1 - i] = row
    emit = emit + PRIOR * model["share"][:, None]
    move, first = move + 0.5, first + 0.5
    return {"emit": emit / emit.sum(0), "move": move / move.sum(1, keepdims=True), "first": first / first.sum(), "share": model["share"]}


def scores(df: DataFrame, states: int = STATES, rounds: int = ROUNDS, folds: int = FOLDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities)."""
    docs = ids_and_texts(df, id_col, text_col)
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (crc_mod(F.col("doc_id"), folds) == 0).alias("held"))
    path = shared_dir(spark, "hmm-blocks")
    encode(docs, path)
    read = spark.read.schema(f"kind string, {BLOCKS}, {LISTS.partition(', ')[2]}").parquet(path)
    blocks = read.where("kind = 'b'").select(*[c.split()[0] for c in BLOCKS.split(", ")])
    # Every block's words with their counts in the whole training corpus; each word is marked in one block.
    of_word = W.partitionBy("wh")
    counts = read.where("kind = 'w'").select("block", "wid", "g", F.sum("c").over(of_word).alias("c"), (F.col("block") == F.min("block").over(of_word)).alias("once"))
    counts = materialize(counts, "word-counts")
    by_class = counts.where("once and c > 0").groupBy("g").agg(F.sum("c").alias("c"), F.count("*").alias("v")).toArrow()
    c, v = np.zeros(CLASSES), np.zeros(CLASSES)
    c[by_class.column("g").to_numpy()] = by_class.column("c").to_numpy()
    v[by_class.column("g").to_numpy()] = by_class.column("v").to_numpy()
    model = start_model(c, states)
    for _ in range(rounds):
        model = _round(blocks, model)
    total, kinds = float(c.sum()), float(v.sum())
    shared = spark.sparkContext.broadcast(model | {"class_total": c + ADDED * (v + 1)})

    def judge(one: pa.Table, lists: pa.Table) -> pa.Table:
        m = shared.value
        row = one.to_pylist()[0]
        sizes, tokens = np.array(row["sizes"], np.int64), np.frombuffer(row["tokens"], np.int32)
        classes = np.frombuffer(row["word_classes"], np.uint16)
        n = np.zeros(len(classes))
        n[lists.column("wid").to_numpy()] = lists.column("c").to_numpy()
        sums = lambda x: np.add.reduceat(x[tokens], np.cumsum(sizes) - sizes)
        base = sums(np.log10((n + ADDED) / (total + ADDED * (kinds + 1))))
        inside = sums(np.log10((n + ADDED) / m["class_total"][classes]))
        got = np.empty(len(sizes))
        for pick, k, alive, start, flat in batches_of(classes[tokens], sizes):
            logs = np.log10(forward(m["emit"][flat], alive, start, m["first"], m["move"]))
            who = np.concatenate([np.arange(a) for a in alive.tolist()])
            got[pick] = np.bincount(who, weights=logs, minlength=len(k))
        return pa.table({"doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()), "n_tokens": pa.array(sizes),
                         "n_known": pa.array(sums((n > 0).astype(np.int64))), "base_score": pa.array(base), "score": pa.array(got + inside)})

    out = (blocks.groupBy("block").cogroup(counts.select("block", "wid", "c").groupBy("block"))
           .applyInArrow(judge, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")


def op4_hmm_scoring(spark, sf_dir: str) -> DataFrame:
    return scores(load(spark, sf_dir, "documents"))
