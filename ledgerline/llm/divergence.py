"""Source divergence audit by a sort of pointers to the starts of terms.

A task takes a slice of texts as Arrow gives them: one buffer of UTF-8 bytes.
The start of each term (a run of letters, anything beyond ASCII counts as one)
is a pointer into that buffer.  The rows of a slice are put in order of their
(lang, source) group first; then the pointers are sorted by the terms they
point to, by a stable multikey quicksort whose characters are eight bytes wide.
Equal terms so lie in runs, and in each run the pointers are still in order of
group and document: the lengths of a run's pieces are the counts of each source,
the changes of document in it the document frequency.  Spark sums the shards'
counts, keeps each language's terms of enough documents and compares each
source's smoothed share of every term with the language's and with that of each
other source of the language, in whole numbers.

The comparison of sources is a report over all their pairs, as asked for.  Its
work is dealt by pairs of blocks of ``SOURCES`` sources and buckets of terms; a
task adds up differences in an array for its block pair, so no row per term and
pair is made.  A term that neither source has adds the difference of their
shares of a term without occurrences, which is multiplied out at the end.

Defined cases: null text, lang and source count as ''; texts without terms make
their group occur with no counts; a language without kept terms has value 0 for
each pair and no ``term`` rows; a single source of a language has no pairs;
repeated rows are documents of their own; a text of any length is one slice at
most; ties are ordered by the item's UTF-8 bytes; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import load, materialize, slices

LEAST_DOCS = 30
RANKS = 50
#: Share of a whole, and what is added to each count.
WHOLE, ADDED = 1_000_000_000, 5
#: Text bytes sorted at a time; sources in a block; kept rows in a bucket of terms.
SLICE = 8 << 20
SOURCES = 64
BUCKET_ROWS = 50_000
#: Pointers below which a part is finished by one sort instead of further splits.
SMALL = 1 << 14

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: Keeps the first n of eight bytes.
_FIRST = np.array([0] + [(~0 << (64 - 8 * n)) & 0xFFFFFFFFFFFFFFFF for n in range(1, 9)], np.uint64)
_LAST = np.uint64(0xFF)


def term_starts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes (A-Z lower-cased, eight zeros behind), and each term's start, end and text number."""
    texts = texts.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    buffer = np.zeros(len(data) + 8, np.uint8)
    buffer[:len(data)] = _LOWER[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _LETTER[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside[:-1] & ~inside[1:]
    border = at[(at > 0) & (at < len(data))]  # a term ends with its text, also where the next one starts with a letter
    first[border] = inside[border]
    last[border - 1] = inside[border - 1]
    starts, ends = np.flatnonzero(first[:-1]), np.flatnonzero(last) + 1
    return buffer, starts, ends, np.searchsorted(at, starts, side="right") - 1


def multikey_quicksort(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order of the terms by their bytes, and which places in it begin a run of equal terms.

    Parts that agree up to a depth are split in three by the next eight bytes
    of a pivot; the middle part goes on behind them.  Behind its end a term
    counts as zero bytes, which no term holds.
    """
    n = len(starts)
    order, new = np.arange(n), np.zeros(n, bool)
    if not n:
        return order, new
    new[0] = True
    eight = np.ndarray((len(buffer) - 7,), ">u8", buffer, strides=(1,))

    def characters(which: np.ndarray, depth: int) -> np.ndarray:
        at = starts[which] + depth
        left = np.minimum(np.maximum(ends[which] - at, 0), 8)
        return eight[np.minimum(at, len(eight) - 1)].astype(np.uint64) & _FIRST[left]

    def finish(lo: int, hi: int, depth: int) -> None:
        """Sorts a small part, then all its ties by the characters behind, as long as they go on."""
        at, run, key = np.arange(lo, hi), np.zeros(hi - lo, np.int64), keys[lo:hi]
        while True:
            by = np.lexsort((key, run)) if depth else np.argsort(key, kind="stable")
            order[at], key, run = order[at[by]], key[by], run[by]
            change = np.ones(len(at) + 1, bool)
            change[1:-1] = (key[1:] != key[:-1]) | (run[1:] != run[:-1])
            new[at[change[:-1]]] = True
            ties = np.flatnonzero(~(change[:-1] & change[1:]) & ((key & _LAST) != 0))
            if not len(ties):
                return
            run = (np.cumsum(change[:-1]))[ties]
            at, depth = at[ties], depth + 8
            key = characters(order[at], depth)

    keys = characters(order, 0)
    parts = [(0, n, 0)]
    while parts:
        lo, hi, depth = parts.pop()
        if hi - lo <= SMALL:
            finish(lo, hi, depth)
            continue
        part, key = order[lo:hi], keys[lo:hi]
        pivot = np.sort(key[:: (hi - lo) // 9])[4]
        less, greater = key < pivot, key > pivot
        same = ~(less | greater)
        a, b = int(less.sum()), int(same.sum())
        order[lo:hi] = np.concatenate([part[less], part[same], part[greater]])
        keys[lo:hi] = np.concatenate([key[less], key[same], key[greater]])
        for start, end, at in ((lo, lo + a, depth), (lo + a, lo + a + b, depth + 8), (lo + a + b, hi, depth)):
            if start < end:
                new[start] = True
            if end - start > 1 and (at == depth or int(pivot) & 0xFF):  # a key that ends in a zero byte is a whole term
                if at > depth:
                    keys[start:end] = characters(order[start:end], at)
                parts.append((start, end, at))
    return order, new


def _gathered(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes between starts and ends as strings."""
    size = ends - starts
    at = np.concatenate([[0], np.cumsum(size)])
    data = buffer[np.arange(at[-1]) - np.repeat(at[:-1] - starts, size)]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))


def shard_counts(lang: pa.Array, source: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """(lang, source, term, n, docs) of a slice: a term's occurrences in a group and the group's texts with it; each group also with a null term."""
    groups = pa.StructArray.from_arrays([lang, source], ["lang", "source"])
    keys = pa.Table.from_arrays([lang, source, pa.array(np.arange(len(lang)))], ["lang", "source", "row"]).sort_by([("lang", "ascending"), ("source", "ascending"), ("row", "ascending")])
    rows = keys.column("row").to_numpy()
    lang, source, texts = groups.field(0).take(pa.array(rows)), groups.field(1).take(pa.array(rows)), texts.take(pa.array(rows))
    a, b = lang.dictionary_encode().indices.to_numpy(), source.dictionary_encode().indices.to_numpy()
    change = np.ones(len(rows), bool)
    change[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group, first = np.cumsum(change) - 1, np.flatnonzero(change)

    buffer, starts, ends, text = term_starts(texts)
    order, run = multikey_quicksort(buffer, starts, ends)
    text = text[order]
    of = group[text]
    piece, doc = run.copy(), run.copy()
    piece[1:] |= of[1:] != of[:-1]
    doc[1:] |= text[1:] != text[:-1]
    at = np.flatnonzero(piece)
    n = np.diff(np.concatenate([at, [len(order)]]))
    docs = np.add.reduceat(doc, at, dtype=np.int64) if len(at) else np.zeros(0, np.int64)
    head = order[at]
    terms = _gathered(buffer, starts[head], ends[head]).cast(pa.string())
    which = pa.array(np.concatenate([first[of[at]], first]))
    none = np.zeros(len(first), np.int64)
    return pa.RecordBatch.from_arrays([lang.take(which), source.take(which), pa.concat_arrays([terms, pa.nulls(len(first), pa.string())]),
                                       pa.array(np.concatenate([n, none])), pa.array(np.concatenate([docs, none]))], ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) over all rows; each occurring group also has a row with a null term."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield shard_counts(part.column("lang").cast(pa.string()), part.column("source").cast(pa.string()), part.column("text"))

    return (docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(n: str, total: str, kept: str):
    """1 + floor(WHOLE * (n + ADDED) / (total + ADDED * kept)), in decimals of whole numbers; null without kept terms."""
    return F.expr(f"1 + (cast({WHOLE} as decimal(10,0)) * (cast({n} as decimal(18,0)) + {ADDED})) div nullif(cast({total} as decimal(18,0)) + cast({ADDED} as decimal(1,0)) * cast({kept} as decimal(18,0)), 0)")


def _block_sums(size: int):
    """Of one pair of blocks of ``size`` sources and a bucket of terms: (lang, i, j, part, seen), the sums of differences over the terms that the bucket has."""

    def run(key, table):
        lang, a, b = (k.as_py() for k in key[:3])
        number, p = table.column("number").to_numpy(), table.column("p").to_numpy()
        term = table.column("term").combine_chunks().dictionary_encode()
        codes = term.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        marks, t = codes < 0, len(term.dictionary)

        def matrix(block):
            mine = number // size == block
            names = number[mine & marks]
            names, zero = names[by := np.argsort(names)], p[mine & marks][by]
            out = np.repeat(zero[None, :], t, 0)
            cells = mine & ~marks
            out[codes[cells], np.searchsorted(names, number[cells])] = p[cells]
            return names, out

        left, x = matrix(a)
        right, y = (left, x) if a == b else matrix(b)
        sums = np.stack([np.abs(x[:, k:k + 1] - y).sum(0) for k in range(len(left))]) if len(left) else np.zeros((0, len(right)), np.int64)
        i, j = np.repeat(left, len(right)), np.tile(right, len(left))
        use = i < j
        return pa.table({"lang": pa.array([lang] * int(use.sum()), pa.string()), "i": pa.array(i[use], pa.int32()), "j": pa.array(j[use], pa.int32()),
                         "part": pa.array(sums.ravel()[use], pa.int64()), "seen": pa.array(np.full(int(use.sum()), t), pa.int64())})

    return run


def _pairs(cells: DataFrame, groups: DataFrame, buckets: int, size: int) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of a language's sources."""
    dealt = cells.select("lang", "term", "number", "p", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket"), "blocks")
    marks = groups.where("kept > 0").select("lang", F.lit(None).cast("string").alias("term"), "number", F.col("zero").alias("p"),
                                            F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), "blocks")
    block = F.floor(F.col("number") / size).cast("int")
    both = dealt.unionByName(marks).select("*", block.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    sums = (both.select("lang", "term", "number", "p", "bucket", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
            .groupBy("lang", "a", "b", "bucket").applyInArrow(_block_sums(size), "lang string, i int, j int, part long, seen long")
            .groupBy("lang", "i", "j").agg(F.sum("part").alias("part"), F.sum("seen").alias("seen")))
    side = lambda n, to: groups.select("lang", F.col("number").alias(n), F.col("source").alias(to), F.col("zero").alias(f"zero_{n}"), F.col("kept").alias(f"kept_{n}"))
    known = (sums.join(side("i", "left"), ["lang", "i"]).join(side("j", "right"), ["lang", "j"])
             .withColumn("value", F.expr("part + (kept_i - seen) * abs(zero_i - zero_j)")))
    # Languages without kept terms: nothing to sum.
    bare = groups.where("kept = 0").select("lang", "source")
    bare = bare.select("lang", "source").join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
    return (known.select("lang", F.col("left").alias("source"), F.col("right").alias("item"), "value")
            .unionByName(known.select("lang", F.col("right").alias("source"), F.col("left").alias("item"), "value")).unionByName(bare))


def divergence_audit(documents: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS, sources: int = SOURCES, bucket_rows: int = BUCKET_ROWS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank; further the group's and the item's counts or shares.

    ``pair``: how far each other source of the language is from this one, over
    all kept terms.  ``term``: the terms that this source has more often than
    the language, the first ``ranks`` of them.
    """
    text = lambda c: F.coalesce(documents[c].cast("string"), F.lit(""))
    docs = documents.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    counts = materialize(term_counts(docs), "term-counts")
    kept = materialize(counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang"))
                       .where(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    here = materialize(counts.where("term is not null").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "n_lang"), "kept-counts")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n_lang").alias("total_lang"))
    groups = (counts.where("term is null").select("lang", "source")
              .join(here.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(langs, "lang", "left")
              .na.fill(0, ["total", "kept", "total_lang"]))
    groups = materialize(groups.select("lang", "source", "total", "kept", "total_lang", share("0", "total", "kept").alias("zero"),
                                       (F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1).alias("number"),
                                       F.ceil(F.count("*").over(W.partitionBy("lang")) / sources).cast("int").alias("blocks")), "groups")
    cells = here.join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "kept")).withColumn("q", share("n_lang", "total_lang", "kept"))

    rank = lambda: F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    above = cells.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    above = above.withColumn("rank", rank()).where(F.col("rank") <= ranks)
    buckets = max(1, -(-here.count() // bucket_rows))
    pairs = _pairs(cells, groups, buckets, sources).withColumn("rank", rank())
    out = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
    return out(pairs, "pair").unionByName(out(above, "term"))


def op11_source_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence_audit(load(spark, sf_dir, "documents"))


OP11_SQL = r"""
with docs as (
  select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as doc,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
words as (select lang, source, doc, unnest(terms) as term from docs),
kept as (select lang, term, count(*) as c from words group by all having count(distinct doc) >= 30),
langs as (select lang, count(*) as v, sum(c)::hugeint as n from kept group by all),
counts as (select lang, source, term, count(*) as c from words semi join kept using (lang, term) group by all),
groups as (
  select g.lang, g.source, coalesce(l.v, 0) as v, coalesce((select sum(c) from counts x where x.lang = g.lang and x.source = g.source), 0)::hugeint as n
  from (select distinct lang, source from docs) g left join langs l using (lang)),
cells as (
  select g.lang, g.source, k.term, coalesce(x.c, 0) as c,
         1 + (1000000000::hugeint * (coalesce(x.c, 0) + 5)) // (g.n + 5 * g.v) as p,
         1 + (1000000000::hugeint * (k.c + 5)) // (l.n + 5 * l.v) as q
  from groups g join kept k using (lang) join langs l using (lang) left join counts x on x.lang = g.lang and x.source = g.source and x.term = k.term),
sums as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from cells a join cells b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
above as (select lang, source, 'term' as part, term as item, p - q as value from cells where c > 0 and p > q),
ranked as (
  select lang, source, part, item, value::bigint as value,
         (row_number() over (partition by lang, source, part order by value desc, item))::int as rank
  from (select * from pairs union all select * from above))
select * from ranked where part = 'pair' or rank <= 50
"""
