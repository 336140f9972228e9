"""Exact de-duplication by composable polynomial fingerprints.

A text's bytes b_0 .. b_n-1 have the fingerprint sum(b_i * r^(n-1-i)) modulo
two primes.  Fingerprints compose: F(AB) = F(A) * r^len(B) + F(B), so chunks
are hashed on their own and combined by a shift of their distance to the end.
Ordinary documents are combined in the task that reads them; a huge one is cut
into chunk rows that are dealt over the cluster, and its shifted chunk hashes
meet again in a sum.  Documents of equal fingerprint and length are then
compared chunk by chunk, so a collision never merges different texts.

Defined cases: a null text counts as empty, and empty texts equal one another;
a null doc_id keeps its row and never wins over another id; rows repeated with
the same id and text are one group and all have ``kept`` (their id is the kept
one); an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_lower, checked_join, ids_and_texts, materialize, parallelism

PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
BASES = (1_103_515_245 % PRIMES[0], 1_664_525_013 % PRIMES[1])
CHUNK_BYTES = 64 << 10
#: Longer texts are hashed as chunk rows by several tasks.
HUGE_BYTES = 1 << 20


def _powers(chunk: int, primes) -> list[np.ndarray]:
    """For each prime, r^(chunk-1) .. r^0."""
    out = []
    for base, p in zip(BASES, primes, strict=True):
        pw = [1]
        for _ in range(chunk - 1):
            pw.append(pw[-1] * base % p)
        out.append(np.array(pw[::-1], np.int64))
    return out


def chunk_hash(data: bytes, powers, primes=PRIMES) -> tuple[int, int]:
    """The two fingerprints of a chunk of at most ``len(powers[0])`` bytes."""
    b = np.frombuffer(data, np.uint8).astype(np.int64)
    return tuple(int(b @ pw[len(pw) - len(b):]) % p for pw, p in zip(powers, primes, strict=True))


def combine(left: tuple[int, int], right: tuple[int, int], right_bytes: int, primes=PRIMES) -> tuple[int, int]:
    """The fingerprint of a concatenation from those of its parts."""
    return tuple((a * pow(r % p, right_bytes, p) + b) % p
                 for a, b, r, p in zip(left, right, BASES, primes, strict=True))


def fingerprints(docs: DataFrame, chunk: int = CHUNK_BYTES, huge: int = HUGE_BYTES, primes=PRIMES) -> DataFrame:
    """Per row: doc_id, text_key, n_bytes, f1, f2 (fingerprint) and text_sha256 of the normalised text."""

    def whole(batches):
        powers = _powers(chunk, primes)
        for batch in batches:
            cols = {k: [] for k in ("n_bytes", "f1", "f2", "text_sha256")}
            for text in batch.column("text").to_pylist():
                data = (text or "").encode().lower()
                cols["n_bytes"].append(len(data))
                cols["text_sha256"].append(hashlib.sha256(data).hexdigest())
                f = (0, 0) if len(data) <= huge else (None, None)
                for i in range(0, len(data) if len(data) <= huge else 0, chunk):
                    part = data[i:i + chunk]
                    f = combine(f, chunk_hash(part, powers, primes), len(part), primes)
                cols["f1"].append(f[0])
                cols["f2"].append(f[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(cols["n_bytes"], pa.int64()), pa.array(cols["f1"], pa.int64()),
                 pa.array(cols["f2"], pa.int64()), pa.array(cols["text_sha256"], pa.string())],
                ["doc_id", "text_key", "n_bytes", "f1", "f2", "text_sha256"])

    schema = "doc_id long, text_key long, n_bytes long, f1 long, f2 long, text_sha256 string"
    known = materialize(docs.mapInArrow(whole, schema), "fingerprints")
    long = known.where("f1 is null")
    if long.isEmpty():
        return known
    # Chunk rows (text, byte offset, bytes) are dealt by their own place; the sum of a text's shifted chunk hashes is the whole's.
    data = ascii_lower(F.col("text"))
    rows = (docs.where(F.octet_length("text") > huge)
            .select(F.sha2(data, 256).alias("text_sha256"), data.cast("binary").alias("data"), F.octet_length("text").alias("n"))
            .select("text_sha256", "data", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(chunk))).alias("at"))
            .select("text_sha256", "n", "at", F.expr(f"substring(data, at + 1, {chunk})").alias("part")))

    def parts(batches):
        powers = _powers(chunk, primes)
        for batch in batches:
            got = [combine(chunk_hash(p, powers, primes), (0, 0), n - at - len(p), primes) for p, at, n in
                   zip(*(batch.column(c).to_pylist() for c in ("part", "at", "n")), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_sha256"), batch.column("at"), pa.array([h[0] for h in got], pa.int64()),
                 pa.array([h[1] for h in got], pa.int64())], ["text_sha256", "at", "h1", "h2"])

    hashed = (rows.repartition(parallelism(docs.sparkSession), "text_sha256", "at")
              .mapInArrow(parts, "text_sha256 string, at int, h1 long, h2 long")
              .groupBy("text_sha256", "at").agg(F.min("h1").alias("h1"), F.min("h2").alias("h2"))  # copies have equal chunks
              .groupBy("text_sha256").agg((F.sum("h1") % primes[0]).alias("f1"), (F.sum("h2") % primes[1]).alias("f2")))
    done = long.drop("f1", "f2").join(hashed, "text_sha256")
    return known.where("f1 is not null").unionByName(done)


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, and text_key, a hash that names the row's text as it stands."""
    docs = ids_and_texts(df, id_col, text_col)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))


def compared(docs: DataFrame, suspects: DataFrame, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Chunk rows (text_key, n_bytes, f1, f2, at, part) of the texts in ``suspects``."""
    names, types = ["text_key", "n_bytes", "f1", "f2", "at", "part"], [pa.int64()] * 5 + [pa.binary()]

    def cut(batches):
        for batch in batches:
            cols = [[] for _ in names]
            for row in batch.to_pylist():
                data = (row["text"] or "").encode().lower()
                for at in range(0, max(len(data), 1), chunk):
                    for c, v in zip(cols, (*(row[k] for k in names[:4]), at, data[at:at + chunk]), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    return (checked_join(docs.select("text", "text_key"), suspects, "text_key").select("text", *names[:4])
            .mapInArrow(cut, "text_key long, n_bytes long, f1 long, f2 long, at long, part binary"))


def groups_of(docs: DataFrame, chunk: int = CHUNK_BYTES, huge: int = HUGE_BYTES, primes=PRIMES) -> DataFrame:
    """One row per row of ``docs`` (keyed): doc_id, text_key, keep_id, group_size, kept, text_sha256."""
    known = fingerprints(docs, chunk, huge, primes)
    same = ["n_bytes", "f1", "f2"]
    groups = materialize(known.groupBy(*same).agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
                         .where("group_size > 1"), "groups")
    suspects = materialize(checked_join(known, groups.select(*same), same).select("text_key", *same).distinct(), "suspects")
    # Copies collapse before the shuffle: what is left of a group is one row per different chunk.
    contents = compared(docs, suspects, chunk).groupBy(*same, "at", "part").agg(F.min("text_key").alias("chunk_class"))
    collided = materialize(contents.groupBy(*same, "at").agg(F.count("*").alias("n")).where("n > 1")
                           .select(*same).distinct(), "collided")
    known = known.withColumn("split", F.lit(None).cast("string"))
    groups = groups.withColumn("split", F.lit(None).cast("string"))
    if not collided.isEmpty():
        known, groups = _separate(docs, known, groups, suspects, collided, chunk)
    out = known.alias("k").join(
        groups.alias("g"), (F.col("k.f1") == F.col("g.f1")) & (F.col("k.f2") == F.col("g.f2"))
        & (F.col("k.n_bytes") == F.col("g.n_bytes")) & F.col("k.split").eqNullSafe(F.col("g.split")), "left")
    keep = F.when(F.col("g.group_size").isNull(), F.col("k.doc_id")).otherwise(F.col("g.keep_id"))
    return out.select(F.col("k.doc_id").alias("doc_id"), F.col("k.text_key").alias("text_key"), keep.alias("keep_id"),
                      F.coalesce(F.col("g.group_size"), F.lit(1)).cast("long").alias("group_size"),
                      F.col("k.doc_id").eqNullSafe(keep).alias("kept"), F.col("k.text_sha256").alias("text_sha256"))


def _separate(docs, known, groups, suspects, collided, chunk):
    """Splits groups in which equal fingerprints met different texts: a text's class is the list of its chunks' classes."""
    same = ["n_bytes", "f1", "f2"]
    hit = materialize(suspects.join(collided, same, "left_semi"), "collided-texts")
    rows = materialize(compared(docs, hit, chunk), "collided-chunks")
    classes = rows.groupBy(*same, "at", "part").agg(F.min("text_key").alias("chunk_class"))
    split = (rows.join(classes, [*same, "at", "part"]).groupBy("text_key", *same)
             .agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("at", "chunk_class"))), lambda x: x["chunk_class"].cast("string")), ",").alias("split")))
    known = known.drop("split").join(split, ["text_key", *same], "left")
    inside = known.where("split is not null").groupBy(*same, "split").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    outside = groups.join(collided, same, "left_anti")
    return known, outside.unionByName(inside)


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK_BYTES,
                 huge: int = HUGE_BYTES, primes=PRIMES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (see the module's defined cases)."""
    return groups_of(keyed(df, id_col, text_col), chunk, huge, primes).drop("text_key")


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, of which no copy with a larger id exists; rows without an id stay."""
    gone = groups_of(keyed(df, id_col, text_col)).where("not kept and doc_id is not null")
    return without(df, gone, id_col, text_col)


def without(df: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``df`` that are not in ``gone`` by doc_id and text_key."""
    gone = materialize(gone.select(F.col("doc_id").alias("_gone"), F.col("text_key").alias("_key")).distinct(), "gone")
    key = F.xxhash64(F.coalesce(df[text_col], F.lit("")))
    return checked_join(df, gone, (df[id_col].cast("long") == gone["_gone"]) & (key == gone["_key"]), "left_anti")


def one_per_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``df``, all columns, of each group of equal texts: one with the largest id, one without an id only where no other is.

    For what ``drop_exact_copies`` leaves: rows repeated with one id, and rows without one.
    """
    text = ascii_lower(F.coalesce(df[text_col], F.lit("")))
    repeated = materialize(df.select(F.xxhash64(text).alias("_text")).groupBy("_text").count().where("count > 1").select("_text"), "repeated-texts")
    if repeated.isEmpty():
        return df
    last = F.max_by(F.struct(*df.columns), F.coalesce(df[id_col].cast("long"), F.lit(-(1 << 63))))
    one = checked_join(df.withColumn("_text", F.xxhash64(text)), repeated, "_text", "left_semi").groupBy(text.alias("_same")).agg(last.alias("_row")).select("_row.*")
    rest = checked_join(df.withColumn("_text", F.xxhash64(text)), repeated, "_text", "left_anti").select(df.columns)
    return rest.unionByName(materialize(one, "one-per-text"))


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    from ledgerline.llm.common import load

    return exact_groups(load(spark, sf_dir, "documents"))


OP2_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
g AS (SELECT x, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(t.x) AS text_sha256
FROM t JOIN g ON t.x = g.x
"""
