"""Helpers shared by the operators: table access, size-checked joins, word arrays."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import materialize, parallelism

__all__ = ["BROADCAST_ROWS", "A_Z", "load", "materialize", "parallelism", "ids_and_texts", "checked_join", "small_batches",
           "ascii_lower", "crc_mod", "slices", "words", "hash_words", "mix64", "shingles", "global_rank"]

#: A written table of narrow rows (a few longs) is broadcast up to this many rows (tens of MB); a larger one is shuffled.
BROADCAST_ROWS = 500_000
A_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Text bytes that a task holds as word arrays at a time.
SLICE_BYTES = 2 << 20


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def ids_and_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under the names doc_id and text; further columns cannot clash."""
    return df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"))


def checked_join(left: DataFrame, written: DataFrame, on, how: str = "inner", rows: int | None = None) -> DataFrame:
    """``left`` joined with a narrow table read back from storage.

    Its rows are counted (from the file footers); up to BROADCAST_ROWS it is
    broadcast, so ``left`` stays where it is; beyond that both are shuffled.
    """
    n = written.count() if rows is None else rows
    return left.join(F.broadcast(written) if n <= BROADCAST_ROWS else written, on, how)


@contextmanager
def small_batches(spark: SparkSession, most: int = 8 << 20):
    """Arrow batches of at most ``most`` bytes for the jobs run inside (rows of several KB would make large ones)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ascii_lower(col):
    """Lower-cases A-Z alone."""
    return F.translate(col, *A_Z)


def crc_mod(id_col, n: int):
    """crc32 of the id as text, modulo n (null id: the empty text's)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` bytes of ``column`` (one row at least)."""
    if not batch.num_rows:
        return
    size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right"))
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.take(pa.array(np.arange(at, to)))  # a copy: some Arrow kernels misread sliced text
        at = to
        pa.default_memory_pool().release_unused()  # workers live on; what they keep counts against their executor


def words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: offsets per text, the words' numbers, the words by number."""
    texts = texts.cast(pa.large_string()).fill_null("")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    coded = lists.flatten().dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False)
    vocab = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # several times faster than to_pylist()
    at = lists.offsets.to_numpy().astype(np.int64)
    at = at - at[0]
    if "" in vocab:  # what splitting leaves at the ends
        real = ids != vocab.index("")
        at = np.concatenate([[0], np.cumsum(real)])[at]
        ids = ids[real]
    return at, ids, vocab


def hash_words(vocab: list[str], seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in vocab), np.uint64, len(vocab))


def mix64(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-grams of a word-hash array (across text borders too: callers cut these)."""
    n = max(len(hashes) - k + 1, 0)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + n]
    return mix64(h)


def global_rank(df: DataFrame, col: str, name: str) -> DataFrame:
    """Adds the 0-based position of each row by ``col`` (nulls last) without putting all rows in one task.

    Rows are range-partitioned by the column and numbered within their
    partition; one count per partition goes through a small offsets table.
    """
    from pyspark.sql import Window as W

    parts = materialize(df.repartitionByRange(F.col(col).asc_nulls_last())
                        .withColumn("_part", F.spark_partition_id()), "rank")
    order = W.partitionBy("_part").orderBy(F.col(col).asc_nulls_last())
    offsets = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = offsets.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    return (parts.withColumn("_row", F.row_number().over(order))
            .join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + F.col("_row") - 1)
            .drop("_part", "_row", "_before"))
