"""Jaccard join of documents on word n-grams, with count-vector R-trees.

A document is the set of its distinct ``k``-word shingles.  Its shingles are
hashed into groups, one for at most eight shingles; the counts per group are a
point.  For two points the sum of the smaller coordinates bounds the overlap of
the sets from above, and for a box of points its upper corner does, so an
R-tree over points skips whole boxes.  (A point of more groups folds into one
of fewer.)  The same bound over two groups or more for each shingle, with a bit
for each that is not empty, thins out the pairs left; what then is left is
verified on the sets.

Count vectors alone prune well only inside a list of documents that have
something in common, so pairs are looked for per shingle:

1. In one order of all shingles (those common in a sample last, the others by
   hash), two documents that link share one of the first n - ceil(t n) + 1 of
   each.  Only these are posted.  Which shingles count as common changes the
   work, never the result.
2. In each posting list every document is held against the first and the last
   one (stars, not all pairs): bound, then sets.  That joins groups of copies.  Lists with
   the same first member become one, as those of one shared passage mostly are.
3. In lists whose other members still lie in several components, an R-tree
   join finds the pairs that the bound leaves between components.  Long lists
   are cut into blocks and pairs of blocks, so a task's memory is bounded.

Equal sets are one class before anything is posted, so copies cost one row.

Defined cases: a text of fewer than ``k`` words is one shingle, the whole
sequence; a null text or one without words has no shingles and links with
nothing; a row without an id has its n_shingles and no component; repeated
rows share their component; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import checked_join, hash_words, load, materialize, mix64, shingles, slices, small_batches, words
from ledgerline.llm.exact_dedup import keyed, without
from ledgerline.llm.graph import connected_components

K = 5
PERCENT = 75
#: Powers of two, so that points fold: groups for PER_GROUP shingles each, and bits for PER_BIT shingles each.
LEAST_GROUPS, MOST_GROUPS, PER_GROUP = 64, 4_096, 8
LEAST_BITS, MOST_BITS, PER_BIT = 2_048, 1 << 17, 0.5
LEAF = 16
#: One document of so many is looked at for common shingles; of these the COMMON most frequent, in FREQUENT or more of them, go last.
SAMPLE = 16
COMMON = 1 << 16
FREQUENT = 8
#: Members of a posting list that one task joins with as many others.
BLOCK = 1_024
BROADCAST_BYTES = 32 << 20


def least_overlap(a, b, percent: int = PERCENT):
    """The smallest overlap at which sets of these sizes link: 100 i >= percent (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Per text its distinct shingle hashes, ascending."""
    at, ids, vocab = words(texts)
    h = hash_words(vocab)[ids] if len(ids) else np.zeros(0, np.uint64)
    grams = shingles(h, k)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a:b - k + 1]))
        elif b > a:
            out.append(mix64(shingles(h[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _power(n: float, least: int, most: int) -> int:
    """The power of two from ``n`` on, within bounds that are powers of two."""
    return min(max(1 << max(math.ceil(n) - 1, 0).bit_length(), least), most)


def group_counts(s: np.ndarray) -> bytes:
    """The set's point: a byte each for the integers' width and the number of groups, the counts, and a bit for each fine group that is not empty."""
    groups, fine = _power(len(s) / PER_GROUP, LEAST_GROUPS, MOST_GROUPS), _power(len(s) / PER_BIT, LEAST_BITS, MOST_BITS)
    at = (s >> np.uint64(7)).astype(np.int64)
    c = np.bincount(at % groups, minlength=groups)
    bits = np.zeros(fine, np.uint8)
    bits[at % fine] = 1
    width = 1 if c.max() < 256 else 4
    return bytes([width, groups.bit_length()]) + c.astype(f"<u{width}").tobytes() + np.packbits(bits).tobytes()


def point(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Counts by group, and the fine groups' bits in bytes."""
    end = 2 + (1 << data[1] - 1) * data[0]
    return np.frombuffer(data[2:end], f"<u{data[0]}").astype(np.int32), np.frombuffer(data, np.uint8, offset=end)


def fine_overlap(bits_a, size_a, bits_b, size_b) -> np.ndarray:
    """Bound of the overlap, row by row: a set has one element at least in each of its groups that the other has none in."""
    width = min(bits_a.shape[-1], bits_b.shape[-1])
    a, b = (np.bitwise_or.reduce(x.reshape(*x.shape[:-1], -1, width), axis=-2) for x in (bits_a, bits_b))
    return np.minimum(size_a - np.bitwise_count(a & ~b).sum(-1, dtype=np.int64), size_b - np.bitwise_count(b & ~a).sum(-1, dtype=np.int64))


def folded(p: np.ndarray, groups: int) -> np.ndarray:
    """Points (in rows, or one) of fewer groups."""
    return p.reshape(*p.shape[:-1], -1, groups).sum(-2)


def _set_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def common_shingles(docs: DataFrame, k: int) -> np.ndarray:
    """Frequent shingles of a sample of documents, at most COMMON, ascending."""

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), k)
                h, n = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(h[n > 1].view(np.int64)), pa.array(n[n > 1].astype(np.int64))], ["h", "n"])

    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).select("text")
    top = (some.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
           .orderBy(F.desc("n"), "h").limit(COMMON).select("h").toArrow())
    return np.sort(top.column("h").to_numpy().view(np.uint64))


def prepared(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, text_key, n, sid (of the set), point, rare and common (posted shingles)."""
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, k))

    def run(batches):
        last = common.value
        for batch in batches:
            for part in slices(batch, "text"):
                cols = [[], [], [], [], []]
                for s in shingle_sets(part.column("text"), k):
                    n = len(s)
                    first = n - -(-percent * n // 100) + 1 if n else 0
                    late = np.zeros(n, bool)
                    if len(last) and n:
                        at = np.minimum(np.searchsorted(last, s), len(last) - 1)
                        late = last[at] == s
                    rare = s[~late][:first]
                    for c, v in zip(cols, (n, _set_id(s), group_counts(s), rare.view(np.int64), s[late][:first - len(rare)].view(np.int64)), strict=True):
                        c.append(v)
                types = [pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
                                                 ["doc_id", "text_key", "n", "sid", "point", "rare", "common"])

    return docs.mapInArrow(run, "doc_id long, text_key long, n int, sid long, point binary, rare array<long>, common array<long>")


def lists(posted: DataFrame) -> DataFrame:
    """(h, hub, hub_n, top, top_n, sid, n): the members of posting lists with two sets or more; hub and top are the list's smallest and largest set id."""

    def find(batches):
        rest = None
        for batch in batches:
            got = [batch.column(c).to_numpy() for c in ("h", "sid", "n")]
            got = got if rest is None else [np.concatenate(p) for p in zip(rest, got, strict=True)]
            cut = int(np.searchsorted(got[0], got[0][-1])) if len(got[0]) else 0  # the last list may go on
            rest = [c[cut:] for c in got]
            yield members(*(c[:cut] for c in got))
        if rest is not None:
            yield members(*rest)

    def members(h, sid, n):
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (sid[1:] != sid[:-1])
        h, sid, n = h[new], sid[new], n[new]
        first = np.ones(len(h), bool)
        first[1:] = h[1:] != h[:-1]
        start = np.flatnonzero(first)
        size = np.diff(np.append(start, len(h)))
        many = np.repeat(size > 1, size)
        ends = [np.repeat(c[at], size) for at in (start, start + size - 1) for c in (sid, n)]
        return pa.RecordBatch.from_arrays([pa.array(c[many]) for c in (h, *ends, sid, n)], ["h", "hub", "hub_n", "top", "top_n", "sid", "n"])

    rare = (posted.select(F.explode("rare").alias("h"), "sid", "n").repartition("h").sortWithinPartitions("h", "sid")
            .mapInArrow(find, "h long, hub long, hub_n int, top long, top_n int, sid long, n int"))
    # A common shingle's list may hold a third of all rows: its smallest set is found by an aggregate, and the join can be split.
    common = posted.select(F.explode("common").alias("h"), "sid", "n").distinct()
    hubs = common.groupBy("h").agg(F.min(F.struct("sid", "n")).alias("x"), F.max(F.struct("sid", "n")).alias("y")).where("x.sid <> y.sid")
    ends = [F.col(f"{c}.{k}").alias(name + e) for c, name in (("x", "hub"), ("y", "top")) for k, e in (("sid", ""), ("n", "_n"))]
    hubs = materialize(hubs.select("h", *ends), "common-hubs")
    return rare.unionByName(common.join(hubs, "h").select("h", "hub", "hub_n", "top", "top_n", "sid", "n"))


def boxes(points: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of an R-tree over points in their order, from the leaves' boxes up: upper corners, least and most set size."""
    levels = [(points, sizes, sizes)]
    while len(levels[-1][0]) > LEAF:
        corner, low, high = levels[-1]
        starts = np.arange(0, len(corner), LEAF)
        levels.append((np.maximum.reduceat(corner, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))
    return levels


def may_link(a, b, i, j, percent: int) -> np.ndarray:
    """Whether box ``i`` of level ``a`` and box ``j`` of level ``b`` may hold a linked pair, by sizes and by summed coordinate minima."""
    ok = (100 * a[2][i] >= percent * b[1][j]) & (100 * b[2][j] >= percent * a[1][i])
    out = np.zeros(len(i), bool)
    step = max(1, (4 << 20) // a[0].shape[1])
    for s in range(0, len(i), step):
        p, q, k = i[s:s + step], j[s:s + step], ok[s:s + step]
        p, q = p[k], q[k]
        hit = np.zeros(len(k), bool)
        hit[k] = np.minimum(a[0][p], b[0][q]).sum(1) >= least_overlap(a[1][p], b[1][q], percent)
        out[s:s + step] = hit
    return out


def rtree_order(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sort-tile-recursive order: slabs by set size, within them by the group that varies most."""
    n = len(sizes)
    by = np.argsort(sizes, kind="stable")
    slab = max(LEAF, LEAF * math.ceil(math.sqrt(n / LEAF)))
    vary = int(points.var(0).argmax())
    return np.concatenate([p[np.argsort(points[p, vary], kind="stable")] for p in (by[s:s + slab] for s in range(0, n, slab))]) if n else by


def rtree_join(pa_, sa, pb, sb, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) that the bound leaves, by a walk down two R-trees."""
    oa, ob = rtree_order(pa_, sa), rtree_order(pb, sb)
    ta, tb = boxes(pa_[oa], sa[oa]), boxes(pb[ob], sb[ob])
    top = min(len(ta), len(tb)) - 1
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(ta[top][0])), np.arange(len(tb[top][0])), indexing="ij"))
    for level in range(top, -1, -1):
        keep = may_link(ta[level], tb[level], i, j, percent)
        i, j = i[keep], j[keep]
        if level:
            na, nb = len(ta[level - 1][0]), len(tb[level - 1][0])
            step = np.arange(LEAF)
            i, j = ((i[:, None, None] * LEAF + step[:, None]) + 0 * step).ravel(), ((j[:, None, None] * LEAF + step[None, :]) + 0 * step[:, None]).ravel()
            fit = (i < na) & (j < nb)
            i, j = i[fit], j[fit]
    return oa[i], ob[j]


def list_pairs(open_lists: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of one list between components that the bound leaves.  Rows of a block pair (hub, p, q) are in a row."""

    def join(rows):
        side, sid, n, comp = (np.array(c) for c in list(zip(*rows, strict=True))[:4])
        points, bits = zip(*(point(r[4]) for r in rows), strict=True)
        groups = np.array([len(p) for p in points])
        out = set()
        for ga in np.unique(groups):
            for gb in np.unique(groups):
                a, b = np.flatnonzero((side != 1) & (groups == ga)), np.flatnonzero((side != 0) & (groups == gb))
                if not len(a) or not len(b) or 100 * n[a].max() < percent * n[b].min() or 100 * n[b].max() < percent * n[a].min():
                    continue
                g = min(ga, gb)
                i, j = rtree_join(folded(np.stack([points[x] for x in a]), g), n[a], folded(np.stack([points[x] for x in b]), g), n[b], percent)
                ok = comp[a[i]] != comp[b[j]]
                i, j = i[ok], j[ok]
                width = min(min(len(bits[x]) for x in a), min(len(bits[x]) for x in b))
                fa, fb = (np.stack([np.bitwise_or.reduce(bits[x].reshape(-1, width), axis=0) for x in c]) for c in (a, b))
                step = max(1, (8 << 20) // fa.shape[1])
                for s in range(0, len(i), step):
                    x, y = i[s:s + step], j[s:s + step]
                    fits = fine_overlap(fa[x], n[a[x]], fb[y], n[b[y]]) >= least_overlap(n[a[x]], n[b[y]], percent)
                    out.update((min(u, v), max(u, v)) for u, v in zip(sid[a[x[fits]]].tolist(), sid[b[y[fits]]].tolist(), strict=True))
        return out

    def run(batches):
        now, rows, out = None, [], set()
        for batch in batches:
            for hub, p, q, *row in zip(*(batch.column(c).to_pylist() for c in ("hub", "p", "q", "side", "sid", "n", "component", "point")), strict=True):
                if (hub, p, q) != now and rows:
                    out.update(join(rows))
                    rows = []
                now = (hub, p, q)
                rows.append(row)
            if len(out) > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])
                out = set()
        out.update(join(rows) if rows else ())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])

    return open_lists.mapInArrow(run, "a long, b long").distinct()


def bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and summed minima leave."""

    def run(batches):
        for batch in batches:
            na, nb = batch.column("na").to_numpy().astype(np.int64), batch.column("nb").to_numpy().astype(np.int64)
            overlap = np.empty(len(na), np.int64)
            for k, (x, y) in enumerate(zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist(), strict=True)):
                (p, f), (q, g) = point(x), point(y)
                w = min(len(p), len(q))
                overlap[k] = min(np.minimum(folded(p, w), folded(q, w)).sum(), fine_overlap(f, na[k], g, nb[k]))
            keep = pa.array(overlap >= least_overlap(na, nb, percent))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])

    of = lambda x: classes.select(F.col("sid").alias(x), F.col("n").alias(f"n{x}"), F.col("point").alias(f"p{x}"))
    near = pairs.join(of("a"), "a").join(of("b"), "b").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    return near.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(run, "a long, b long")


def verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose sets link."""
    pairs = materialize(pairs, "bounded-pairs")
    wanted = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
    wanted = materialize(wanted.join(classes, "sid").select("doc_id", "text_key", "sid"), "wanted-sets")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [s.tobytes() for s in shingle_sets(part.column("text"), k)]
                yield pa.RecordBatch.from_arrays([part.column("sid"), pa.array(sets, pa.binary())], ["sid", "set"])

    sets = checked_join(docs, wanted, ["doc_id", "text_key"]).select("sid", "text").mapInArrow(run, "sid long, set binary")
    sets = materialize(sets.dropDuplicates(["sid"]), "sets")

    def judge(batches):
        for batch in batches:
            fine = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                fine.append(100 * both >= percent * (len(s) + len(t) - both))
            keep = pa.array(fine, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])

    of = lambda x: sets.select(F.col("sid").alias(x), F.col("set").alias(f"s{x}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "sa", "sb").mapInArrow(judge, "a long, b long")


def components_of(docs: DataFrame, k: int = K, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (keyed): doc_id, text_key, n_shingles, component_id."""
    with small_batches(docs.sparkSession):
        rows, of_set = _components(docs, k, percent, block)
    alone = F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    narrow = rows.select("doc_id", "text_key", "n", F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("sid")).alias("sid"))
    return narrow.join(of_set, "sid", "left").select("doc_id", "text_key", F.col("n").cast("long").alias("n_shingles"), alone.alias("component_id"))


def _components(docs: DataFrame, k: int, percent: int, block: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their sets' ids, and component_id by set; both written."""
    rows = materialize(prepared(docs, k, percent), "shingled")
    classes = (rows.where("n > 0 and doc_id is not null").groupBy("sid")
               .agg(F.min(F.struct("doc_id", "text_key")).alias("of"), F.first("n").alias("n"), F.first("point").alias("point")))
    classes = materialize(classes.select("sid", "of.doc_id", "of.text_key", "n", "point"), "classes")
    found = lists(rows.where("n > 0 and doc_id is not null"))
    found = materialize(found.select("hub", "hub_n", "top", "top_n", "sid", "n").distinct(), "members")
    near = lambda end: (f"{end} <> sid and 100 * least(n, {end}_n) >= {percent} * greatest(n, {end}_n)")
    star = [found.where(near(end)).select(F.least(end, "sid").alias("a"), F.greatest(end, "sid").alias("b")) for end in ("hub", "top")]
    star = star[0].unionByName(star[1]).distinct()
    # Lists with the same first member are one from here on: most hold the same documents, those of one passage.
    members = found.where("sid <> hub").select("hub", "sid", "n").distinct()
    links = materialize(verified(docs, bounded(star, classes, percent), classes, k, percent), "links")
    comps = materialize(connected_components(links, "a", "b"), "components")
    # Lists whose members other than the first lie in several components.
    named = members.join(comps, F.col("sid") == F.col("node"), "left").select("hub", "sid", "n", F.coalesce("component", "sid").alias("component"))
    spread = (named.groupBy("hub").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("k")).where("x <> y")
              .select("hub", F.ceil(F.col("k") / block).cast("int").alias("parts")))
    rest = named.join(materialize(spread, "open-lists"), "hub").withColumn("part", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int"))
    rest = rest.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rest = rest.select("hub", F.least("part", "with").alias("p"), F.greatest("part", "with").alias("q"), "sid", "n", "component",
                       F.when(F.col("part") == F.col("with"), 2).when(F.col("part") < F.col("with"), 0).otherwise(1).alias("side"))
    rest = rest.join(classes.select("sid", "point"), "sid").repartition("hub", "p", "q").sortWithinPartitions("hub", "p", "q")
    more = list_pairs(rest, percent)
    links = materialize(links.unionByName(verified(docs, more, classes, k, percent)), "all-links")
    comps = connected_components(links, "a", "b")
    by_set = classes.join(comps, F.col("sid") == F.col("node"), "left").select("sid", "doc_id", F.coalesce("component", "sid").alias("component"))
    by_set = materialize(by_set, "set-components")
    least = by_set.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows, materialize(by_set.join(least, "component").select("sid", "component_id"), "component-ids")


def jaccard_components(df: DataFrame, k: int = K, percent: int = PERCENT, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    return components_of(keyed(df, id_col, text_col), k, percent, block).drop("text_key")


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, that are the smallest id of their group of linked documents; rows without an id stay."""
    return without(df, components_of(keyed(df, id_col, text_col)).where("component_id <> doc_id"), id_col, text_col)


def op5_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(load(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS h FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a, a AS b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = d.doc_id
"""
