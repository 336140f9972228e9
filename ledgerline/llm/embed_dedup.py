"""Near-duplicate vectors by collision counting on one-dimensional projections.

A pair whose cosine reaches the threshold lies within a known distance, so on
a random projection it falls into a window of given half-width around the query
with a known probability.  ``projections`` of them are sorted; per query each
vector in the window counts one collision.  A pair goes on to the exact cosine
if it collides at least ``count`` times, the largest count that a pair just at
the threshold reaches with probability ``recall``.

Vectors with one label are cut into blocks: by cells of a further projection,
wide enough that linked vectors lie in the same or the next cell, and by a hash
within a cell.  A task takes one pair of blocks, so its memory is bounded
whatever the size of a label or of a group of near copies.  Of a pair of blocks
come the number of links of each vector and links to the smallest vector of
each component in it, never the linked pairs.  Equal vectors are one vector
with a number of copies.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, a null label, or a null vec_id: no links, a component of their own;
vectors of different length do not link; rows repeated with one id and vector
count as vectors of their own; an empty table gives no rows; further columns
are ignored.  A vector's links are those found; measured recall: tests.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import load, materialize
from ledgerline.llm.graph import connected_components

COSINE = 0.93
PROJECTIONS = 24
#: Half-width of a window, in distances of a pair at the threshold.
HALF_WIDTH = 1.5
RECALL = 0.999
#: Width of a cell, in the same measure: a normal value stays below it with probability 0.9995.
CELL = 3.5
BLOCK = 2_048
SEED = 11


def collision_count(projections: int, half_width: float, recall: float) -> int:
    """The largest count that a pair at the threshold reaches with probability ``recall`` (binomial)."""
    p = math.erf(half_width / math.sqrt(2))
    tail = 0.0
    for k in range(projections, 0, -1):
        tail += math.comb(projections, k) * p**k * (1 - p) ** (projections - k)
        if tail >= recall:
            return k
    return 1


def directions(dim: int, n: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, n))


def unit_rows(vectors: list, dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), np.float64).reshape(-1, dim)
    return x / np.sqrt((x * x).sum(1))[:, None]


def prepared(df: DataFrame, cell: float, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """vec_id, label, vector (doubles as bytes), dim, cell; dim is null for a vector that links with nothing."""

    def run(batches):
        for batch in batches:
            vec, dims, cells = [], [], []
            for v in batch.column("vector").to_pylist():
                x = None if not v or None in v else np.array(v, np.float64)
                norm = None if x is None or not np.isfinite(x).all() else math.sqrt(float(x @ x))
                if not norm or not math.isfinite(norm):
                    vec.append(None), dims.append(None), cells.append(None)
                    continue
                vec.append(x.tobytes()), dims.append(len(x))
                cells.append(math.floor(float(x @ directions(len(x), 1, SEED + 1)[:, 0]) / norm / cell))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(vec, pa.binary()), pa.array(dims, pa.int32()), pa.array(cells, pa.int64())],
                                             ["vec_id", "label", "vector", "dim", "cell"])

    rows = df.select(df[id_col].cast("long").alias("vec_id"), df[label_col].cast("string").alias("label"), df[vec_col].cast("array<double>").alias("vector"))
    return rows.mapInArrow(run, "vec_id long, label string, vector binary, dim int, cell long")


def linked(a: np.ndarray, b: np.ndarray, same: bool, cosine: float, n: int, half: float, count: int, seed: int = SEED) -> np.ndarray:
    """Rows of ``a`` by rows of ``b``: whether they link (``same``: b is a, and no row links with itself)."""
    dirs = directions(a.shape[1], n, seed)
    pa_, pb = a @ dirs, b @ dirs
    hits = np.zeros((len(a), len(b)), np.uint8)
    for k in range(n):
        order = np.argsort(pb[:, k], kind="stable")
        line = pb[order, k]
        lo, hi = np.searchsorted(line, pa_[:, k] - half), np.searchsorted(line, pa_[:, k] + half, side="right")
        for q in range(len(a)):
            hits[q, order[lo[q]:hi[q]]] += 1
    i, j = np.nonzero(hits >= count)
    out = np.zeros(hits.shape, bool)
    for s in range(0, len(i), 100_000):
        p, q = i[s:s + 100_000], j[s:s + 100_000]
        out[p, q] = np.einsum("ij,ij->i", a[p], b[q]) >= cosine
    if same:
        np.fill_diagonal(out, False)
        out |= out.T
    return out


def smallest_reachable(links: np.ndarray) -> np.ndarray:
    """Per row of a symmetric link matrix the smallest row reachable."""
    root = np.full(len(links), -1)
    for s in range(len(links)):
        if root[s] < 0:
            seen = front = np.arange(len(links)) == s
            while front.any():
                front = links[front].any(0) & ~seen
                seen = seen | front
            root[seen] = s
    return root


def near_duplicates(df: DataFrame, cosine: float = COSINE, projections: int = PROJECTIONS, half_width: float = HALF_WIDTH, recall: float = RECALL,
                    block: int = BLOCK, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    far = math.sqrt(2 - 2 * cosine)
    half, count = half_width * far, collision_count(projections, half_width, recall)
    rows = materialize(prepared(df, CELL * far, id_col, vec_col, label_col), "vectors")
    fine = rows.where("dim is not null and label is not null and vec_id is not null")
    same = ["label", "dim", "cell", "vector"]
    classes = materialize(fine.groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "classes")
    parts = classes.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    parts = materialize(parts, "cells")
    keys = ["label", "dim", "cell"]
    other = parts.select("label", "dim", F.col("cell").alias("cell2"), F.col("parts").alias("parts2"))
    # A block's pairs: itself and later ones of its cell, and all of the next cell.
    own = classes.join(parts, keys).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    number = lambda lo, hi: F.explode(F.sequence(lo, hi))
    inside = own.select("*", number(F.lit(0), F.col("parts") - 1).alias("with")).select(
        *keys, F.col("cell").alias("cell2"), F.least("part", "with").alias("p"), F.greatest("part", "with").alias("q"), "rep", "copies", "vector",
        F.when(F.col("part") <= F.col("with"), 0).otherwise(1).alias("side"))
    left = own.join(other, ["label", "dim"]).where("cell2 = cell + 1").select(
        *keys, "cell2", F.col("part").alias("p"), number(F.lit(0), F.col("parts2") - 1).alias("q"), "rep", "copies", "vector", F.lit(0).alias("side"))
    right = own.join(other, ["label", "dim"]).where("cell2 = cell - 1").select(
        "label", "dim", F.col("cell2").alias("cell"), F.col("cell").alias("cell2"), number(F.lit(0), F.col("parts2") - 1).alias("p"), F.col("part").alias("q"),
        "rep", "copies", "vector", F.lit(1).alias("side"))
    pair = ["label", "dim", "cell", "cell2", "p", "q"]

    def judge(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        rep, copies, dim = table.column("rep").to_numpy(), table.column("copies").to_numpy(), table.column("dim")[0].as_py()
        x = unit_rows(table.column("vector").to_pylist(), dim)
        order = np.argsort(rep, kind="stable")
        rep, copies, x, side = rep[order], copies[order], x[order], side[order]
        alone = table.column("cell")[0].as_py() == table.column("cell2")[0].as_py() and table.column("p")[0].as_py() == table.column("q")[0].as_py()
        links = np.zeros((len(rep), len(rep)), bool)
        if alone:
            links = linked(x, x, True, cosine, projections, half, count)
        elif 0 < side.sum() < len(side):
            a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            links[np.ix_(a, b)] = linked(x[a], x[b], False, cosine, projections, half, count)
            links |= links.T
        n, root = links @ copies, smallest_reachable(links)
        own = np.flatnonzero(n)
        return pa.table({"rep": pa.array(rep[own], pa.int64()), "n": pa.array(n[own], pa.int64()), "least": pa.array(rep[root[own]], pa.int64())})

    found = inside.unionByName(left).unionByName(right).groupBy(*pair).applyInArrow(judge, "rep long, n long, least long")
    found = materialize(found, "links")
    sums = found.groupBy("rep").agg(F.sum("n").alias("n"))
    comps = connected_components(found.select(F.col("rep").alias("u"), F.col("least").alias("v")))
    named = (classes.join(sums, "rep", "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
             .select(*same, (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    return _out(fine.join(named, same)).unionByName(_out(
        rows.where("dim is null or label is null or vec_id is null").withColumn("n_links", F.lit(0).cast("long")).withColumn("component_id", F.col("vec_id"))))


def _out(df: DataFrame) -> DataFrame:
    return df.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op8_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "embeddings"))


#: By all pairs of a label: what the operator finds if its recall is 1.
OP8_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings),
u AS (SELECT vec_id, label, x, sqrt(list_dot_product(x, x)) AS n FROM v
  WHERE x IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL AND len(x) > 0 AND list_count(x) = len(x) AND len(list_filter(x, lambda c: NOT isfinite(c))) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.x, b.x) / (a.n * b.n) >= 0.93),
k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
r AS (SELECT a, a AS b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT v.vec_id, coalesce(k.n_links, 0)::BIGINT AS n_links, coalesce(m.component_id, v.vec_id) AS component_id,
  v.vec_id IS NOT DISTINCT FROM coalesce(m.component_id, v.vec_id) AS kept
FROM v LEFT JOIN k ON k.a = v.vec_id LEFT JOIN m ON m.a = v.vec_id
"""
