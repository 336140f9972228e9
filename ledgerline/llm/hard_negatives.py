"""Hard negatives by pruned inner-product search over length buckets.

Rows of one label and like length form buckets.  A bucket holds its vectors as
a matrix and, for each coordinate, the list of its rows sorted by that
coordinate of the vector over its length.  Anchors are taken in blocks.  For an
anchor and a least score, a bucket whose longest vector cannot reach it is left
out.  In the others the score asks for a least cosine; from the anchor's focus
coordinates (its largest by size) and that cosine follow feasible ranges of the
rows' coordinates, each a slice of a sorted list.  Rows in all slices are
verified with the whole integer product.  The least score rises with what was
found: it is the score of the last partner still wanted.

Two searches use this.  The first gives each anchor its positives, the best
rows of its label.  The second gives the best rows of other labels between a
low and a high share of each positive's score: the least score is the low share
or that of the last negative still wanted for some positive.

Pairs of anchor block and bucket are dealt over the tasks by block and run of
buckets, so a label with a third of all rows is many runs; a task holds one
block and at most ``RUN`` buckets of ``BUCKET_BYTES``.  The best of each run are
ranked once more.  Every anchor meets every bucket that its bounds allow:
nothing is left out by a cap.

Defined cases: rows with a null label, vector or id, or with a null or
non-finite component, take no part; several rows of one id count as the least
of them by label and vector; a shorter vector counts as padded with zeros; an
empty vector has score 0 with all; zero and negative scores are ordinary scores
for positives, but no negative lies between the shares of a negative one;
scores that a long cannot hold are an error; anchors without positives or
negatives give no rows; an empty table gives none; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import checked_join, load, materialize

POSITIVES, NEGATIVES = 5, 3
#: Shares of the positive's score, in hundredths, between which negatives lie.
LOW, HIGH = 50, 95
SCALE = 256
#: A bucket's matrix in bytes and rows, buckets per task, anchors per block.
BUCKET_BYTES, BUCKET_ROWS = 1 << 20, 4096
RUN = 32
ANCHORS = 1024
#: Coordinates whose feasible ranges are used; lengths in one bucket differ by at most this factor.
FOCUS = 8
LIKE = 1.05
#: Room for rounding in cosines (as a share) and in ranges; the verification is exact.
ROOM, WIDER = 1e-9, 1e-7
EXACT = float(1 << 52)


def clean_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v, length): usable rows, components as whole numbers floor(scale * x) held as doubles."""
    rows = vectors.select(vectors[id_col].alias("vec_id"), vectors[label_col].alias("label"), vectors[vector_col].cast("array<double>").alias("v"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(usable).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row")).select("vec_id", "row.label", "row.v")
    # A double beyond 2^53 is whole already.
    whole = F.transform("v", lambda x: F.when(F.abs(x * scale) < EXACT, F.floor(x * scale).cast("double")).otherwise(x * scale))
    return rows.select("vec_id", "label", whole.alias("v")).withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """The lists as rows, padded with zeros."""
    at = lists.offsets.to_numpy().astype(np.int64)
    size, flat = np.diff(at), lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), width))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(at[:-1] - at[0], size)] = flat
    return out


class Bucket:
    """Vectors of one label, with their coordinates' sorted lists."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, lists: np.ndarray | None = None):
        self.ids, self.rows = ids, rows
        self.length = np.sqrt((rows * rows).sum(1))
        self.longest = float(self.length.max(initial=0.0))
        unit = rows / np.where(self.length > 0, self.length, 1)[:, None]
        self.lists = np.ascontiguousarray(np.argsort(unit, axis=0).T.astype(np.int32)) if lists is None else lists
        self.values = np.take_along_axis(unit.T, self.lists.astype(np.int64), 1)

    def feasible(self, q: np.ndarray, length: float, least: float, focus: int = FOCUS) -> np.ndarray | None:
        """Rows that may have a product of ``least`` or more with q (None: all); none beyond the bounds is lost."""
        if not least > 0 or not 0 < length < math.inf or self.longest == math.inf:
            return None
        cosine = least / (length * self.longest) * (1 - ROOM) if self.longest else 2.0
        if cosine > 1:
            return np.zeros(0, np.int64)
        angle = math.acos(cosine)
        unit = q / length
        coordinates = np.argpartition(-np.abs(unit), min(focus, len(q)) - 1)[:focus]
        own = np.arccos(np.clip(unit[coordinates], -1, 1))
        lows, highs = np.cos(np.minimum(own + angle, math.pi)) - WIDER, np.cos(np.maximum(own - angle, 0)) + WIDER
        ranges = [(f, int(np.searchsorted(self.values[f], lo)), int(np.searchsorted(self.values[f], hi, side="right"))) for f, lo, hi in zip(coordinates, lows, highs, strict=True)]
        ranges = sorted((hi - lo, f, lo, hi) for f, lo, hi in ranges if hi - lo < len(self.ids))  # a range over all rows tells nothing
        if not ranges:
            return None
        if ranges[0][0] <= 0:
            return np.zeros(0, np.int64)
        seen = np.zeros(len(self.ids), np.int16)
        for _, f, lo, hi in ranges:
            seen[self.lists[f, lo:hi]] += 1
        return np.flatnonzero(seen == len(ranges))

    def products(self, q: np.ndarray, length: float, which: np.ndarray | None) -> np.ndarray:
        """Exact whole-number products with the rows ``which``."""
        if length * self.longest < EXACT:  # every partial sum is a whole number that a double holds
            some = which is not None and 4 * len(which) < len(self.ids)
            found = self.rows[which] @ q if some else self.rows @ q
            return (found if some or which is None else found[which]).astype(np.int64)
        mine = [int(x) for x in q]
        rows = self.rows if which is None else self.rows[which]
        return np.array([sum(int(x) * y for x, y in zip(r, mine, strict=True)) for r in rows], np.int64)


def _first(ids: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n best: higher scores, then smaller ids."""
    if len(ids) > 4 * n:  # all that reach the n-th best score
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        ids, scores = ids[scores >= least], scores[scores >= least]
    by = np.lexsort((ids, -scores))[:n]
    return ids[by], scores[by]


def best_of_label(q, length, own, buckets, n=POSITIVES, focus=FOCUS):
    """(ids, scores): the n best rows of the buckets, without the row ``own``."""
    ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for bucket in sorted(buckets, key=lambda b: -b.longest):
        which = bucket.feasible(q, length, float(scores[-1]) if len(ids) == n else -math.inf, focus)
        found = bucket.products(q, length, which)
        names = bucket.ids if which is None else bucket.ids[which]
        keep = names != own
        ids, scores = _first(np.concatenate([ids, names[keep]]), np.concatenate([scores, found[keep]]), n)
    return ids, scores


def best_between(q, length, wanted, buckets, n=NEGATIVES, low=LOW, high=HIGH, focus=FOCUS):
    """For each positive score in ``wanted`` the n best rows of the buckets between its shares: [(score, ids, scores)]."""
    found = {w: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for w in wanted if w >= 0}
    for bucket in sorted(buckets, key=lambda b: -b.longest) if found else ():
        least = min(max(low * w / 100, float(s[-1]) if len(s) == n else -math.inf) for w, (_, s) in found.items())
        which = bucket.feasible(q, length, least, focus)
        scores = bucket.products(q, length, which)
        names = bucket.ids if which is None else bucket.ids[which]
        near = scores >= least - 1
        names, scores = names[near], scores[near]
        for w, (ids, best) in found.items():
            # floor and ceiling of the shares, in whole numbers: no rounding
            inside = (scores >= -(-low * w // 100)) & (scores <= high * w // 100)
            if inside.any():
                found[w] = _first(np.concatenate([ids, names[inside]]), np.concatenate([best, scores[inside]]), n)
    return [(w, *x) for w, x in found.items()]


def buckets_of(rows: DataFrame, width: int, bucket_bytes: int = BUCKET_BYTES, most: int = BUCKET_ROWS) -> DataFrame:
    """(label, bucket, ids, rows, lists): the rows by label and like length, in parts of bounded size; ``bucket`` counts from 0 within the label."""
    size = int(min(max(bucket_bytes // (8 * max(width, 1)), 16), most))
    rows = rows.withColumn("like", F.when(F.col("length") > 0, F.floor(F.log("length") / math.log(LIKE))).otherwise(-1).cast("long"))
    parts = rows.groupBy("label", "like").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    # A label's buckets are numbered through its classes of length, longest first.
    before = F.sum("parts").over(W.partitionBy("label").orderBy(F.desc("like"))) - F.col("parts")
    parts = materialize(parts.select("label", "like", "parts", before.cast("int").alias("before")), "bucket-parts")
    dealt = checked_join(rows, parts, ["label", "like"]).withColumn("bucket", F.col("before") + F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))

    def pack(table):
        made = Bucket(table.column("vec_id").to_numpy().astype(np.int64), _matrix(table.column("v").combine_chunks(), width))
        return pa.table({"label": table.column("label").slice(0, 1), "bucket": table.column("bucket").slice(0, 1),
                         "ids": pa.array([made.ids.tobytes()], pa.binary()), "rows": pa.array([made.rows.tobytes()], pa.binary()), "lists": pa.array([made.lists.tobytes()], pa.binary())})

    kind = rows.schema["label"].dataType.simpleString()
    return dealt.select("label", "bucket", "vec_id", "v").groupBy("label", "bucket").applyInArrow(pack, f"label {kind}, bucket int, ids binary, rows binary, lists binary")


def _search(anchors: DataFrame, buckets: DataFrame, by_label: bool, width: int, block: int, run: int, find) -> DataFrame:
    """``find(vec_id, q, length, wanted, buckets)`` for every anchor and run of buckets: of its own label alone (``by_label``) or of all others."""
    counted = lambda df, size, name: df.groupBy(*(["label"] if by_label else [])).agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    if by_label:
        sizes = materialize(counted(anchors, block, "blocks").join(counted(buckets, run, "runs"), "label"), "blocks-and-runs")
        anchors, buckets = checked_join(anchors, sizes, "label"), checked_join(buckets, sizes, "label")
        group = F.col("label")
    else:
        sizes = {"blocks": F.lit(counted(anchors, block, "blocks").first()[0]), "runs": F.lit(counted(buckets, run, "runs").first()[0])}
        anchors, buckets, group = anchors.withColumns(sizes), buckets.withColumns(sizes), F.lit(0)
    held = (anchors.withColumn("g", group).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("blocks")).cast("int"))
            .withColumn("run", F.explode(F.sequence(F.lit(0), F.col("runs") - 1))).select("g", "block", "run", "vec_id", "label", "v", "length", "wanted"))
    # Dealt in turn: every run has buckets of all lengths, so its least score rises early.
    turn = F.col("bucket") if by_label else F.xxhash64("label", "bucket")
    met = (buckets.withColumn("g", group).withColumn("run", F.pmod(turn, F.col("runs")).cast("int"))
           .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("g", "block", "run", "label", "ids", "rows", "lists"))

    def meet(left, right):
        stored = {}
        for label, ids, rows, lists in zip(*(right.column(c).to_pylist() for c in ("label", "ids", "rows", "lists")), strict=True):
            names = np.frombuffer(ids, np.int64)
            stored.setdefault(label, []).append(Bucket(names, np.frombuffer(rows).reshape(len(names), width), np.frombuffer(lists, np.int32).reshape(width, len(names))))
        out = []
        if stored and left.num_rows:
            q = _matrix(left.column("v").combine_chunks(), width)
            for k, (vec_id, label, length, wanted) in enumerate(zip(*(left.column(c).to_pylist() for c in ("vec_id", "label", "length", "wanted")), strict=True)):
                mine = stored.get(label, []) if by_label else [b for at, bs in stored.items() if at != label for b in bs]
                if mine:
                    out += find(vec_id, q[k], length, wanted, mine)
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["anchor_id", "positive_score", "partner", "score"])

    return held.groupBy("g", "block", "run").cogroup(met.groupBy("g", "block", "run")).applyInArrow(meet, "anchor_id long, positive_score long, partner long, score long")


def hard_negatives(rows: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   focus: int = FOCUS, bucket_bytes: int = BUCKET_BYTES, bucket_rows: int = BUCKET_ROWS, block: int = ANCHORS, run: int = RUN) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank for the rows of ``clean_rows`` that ``is_anchor`` holds for."""
    rows = materialize(rows, "vectors")
    width = max(rows.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    buckets = materialize(buckets_of(rows, width, bucket_bytes, bucket_rows), "length-buckets")
    anchors = rows.where(is_anchor)

    def of_label(vec_id, q, length, wanted, mine):
        return [(vec_id, 0, i, s) for i, s in zip(*(x.tolist() for x in best_of_label(q, length, vec_id, mine, positives, focus)), strict=True)]

    found = _search(anchors.withColumn("wanted", F.array().cast("array<bigint>")), buckets, True, width, block, run, of_label)
    order = lambda *by: F.row_number().over(W.partitionBy(*by).orderBy(F.desc("score"), "partner"))
    best = materialize(found.withColumn("positive_rank", order("anchor_id")).where(F.col("positive_rank") <= positives)
                       .select("anchor_id", "positive_rank", F.col("partner").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    def between(vec_id, q, length, wanted, mine):
        return [(vec_id, w, i, s) for w, ids, scores in best_between(q, length, wanted, mine, negatives, low, high, focus) for i, s in zip(ids.tolist(), scores.tolist(), strict=True)]

    wanted = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_set("positive_score").alias("wanted"))  # at most ``positives`` of each
    found = _search(anchors.join(wanted, "vec_id"), buckets, False, width, block, run, between)
    ranked = found.withColumn("rank", order("anchor_id", "positive_score")).where(F.col("rank") <= negatives)
    return (best.join(ranked.select("anchor_id", "positive_score", "rank", F.col("partner").alias("negative_id"), F.col("score").alias("negative_score")), ["anchor_id", "positive_score"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score", F.col("positive_rank").cast("int").alias("positive_rank")))


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = clean_rows(load(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


OP13_SQL = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from rows a join rows b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
positives as (
  select anchor_id, id as positive_id, score as positive_score, row_number() over (partition by anchor_id order by score desc, id) as positive_rank
  from scores where same qualify positive_rank <= 5),
negatives as (
  select p.anchor_id, p.positive_id, p.positive_score, p.positive_rank, s.id as negative_id, s.score as negative_score,
         row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.id) as rank
  from positives p join scores s on s.anchor_id = p.anchor_id and not s.same and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score
  qualify rank <= 3)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score, positive_rank::int as positive_rank from negatives
"""
