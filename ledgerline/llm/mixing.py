"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a cap (its size times the most epochs).  The
wanted total is dealt out in proportion to weight; sources above their cap are
clamped and what they leave is dealt anew to the others, until none is above.
Each round is one aggregate over the table of sources, which is never
collected.  A source's target over its size is its number of repetitions: the
whole part goes to each of its documents, the fraction to a seeded selection.

The selection orders a source's documents by a seeded hash and takes them up
to the wanted number of words.  It needs no sort of a source: sizes are summed
in hash buckets, and the bucket in which the sum crosses the target is cut
again by further hash bits, so the words taken miss the target by at most the
words of one cell of ``BUCKETS`` squared: about one document in a source of up to
17 million, one part in 17 million of a larger source.

Defined cases: a null text has size 0 and a null source is a source of its own
(last in order); an empty source or table has target 0; documents with a null
or a repeated id are mixed like others (the hash takes id and size); further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import checked_join, global_rank, load, materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
#: Buckets of a cut; two cuts part a source into their square.
BUCKETS = 4096


def _place(docs: DataFrame, seed: str, id_col: str, text_col: str, source_col: str) -> list:
    """Columns source, size, b1, b2: the words of each text, and its place in the seeded order."""
    size = F.coalesce(F.regexp_count(docs[text_col], F.lit(WORD)), F.lit(0)).cast("long")
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(docs[id_col].cast("string"), F.lit("")), size.cast("string")))
    return [docs[source_col].alias("source"), size.alias("size"), F.conv(F.substring(digest, 1, 3), 16, 10).cast("int").alias("b1"), F.conv(F.substring(digest, 4, 3), 16, 10).cast("int").alias("b2")]


def sizes_of(docs: DataFrame, seed: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, b1, b2 of each document."""
    return docs.select(docs[id_col].alias("doc_id"), *_place(docs, seed, id_col, text_col, source_col))


def water_fill(sources: DataFrame, share: float = SHARE, epochs: float = MOST_EPOCHS) -> DataFrame:
    """Adds ``target`` to a table of (source, source_size, weight): capped shares of ``share`` times all sizes."""
    sources = materialize(sources.withColumn("cap", F.lit(float(epochs)) * F.col("source_size")).withColumn("clamped", F.lit(False)), "sources")
    total = (sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]) * share
    while True:
        left = sources.agg(F.coalesce(F.sum(F.when(F.col("clamped"), F.col("cap"))), F.lit(0.0)).alias("used"),
                           F.sum(F.when(~F.col("clamped"), F.col("weight"))).alias("open")).first()
        level = (total - left["used"]) / left["open"] if left["open"] else 0.0
        over = ~F.col("clamped") & (F.col("weight") * F.lit(level) > F.col("cap"))
        if not left["open"] or sources.where(over).isEmpty():
            return sources.withColumn("target", F.when(F.col("clamped"), F.col("cap")).otherwise(F.col("weight") * F.lit(level))).drop("cap", "clamped")
        sources = materialize(sources.withColumn("clamped", F.col("clamped") | over), "sources")


def mix_plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = MOST_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, target, whole (repetitions of every document), cut1 and cut2 (documents up to these get one more)."""
    sources = global_rank(docs.groupBy("source").agg(F.sum("size").alias("source_size")), "source", "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = water_fill(sources.withColumn("weight", weight).drop("rank"), share, epochs)
    sources = (sources.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + F.lit(1e-12))).otherwise(0).cast("long"))
               .withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")))
    of = lambda a, b: F.col(a).eqNullSafe(F.col(b))

    def crossing(sums: DataFrame, before: str, need: str, bucket: str, cut: str) -> DataFrame:
        """Per source: the bucket in which the running sum passes what is needed, and the sum before it."""
        run = W.partitionBy("source").orderBy(bucket)
        run = sums.withColumn("upto", F.col(before) + F.sum("words").over(run)).withColumn("from", F.col("upto") - F.col("words"))
        return run.where(F.col("from") < F.col(need)).groupBy("source").agg(F.max(bucket).alias(cut), F.max("from").alias("from"))

    some = sources.select(F.col("source").alias("s1"), "need").where("need > 0.5")
    first = docs.groupBy("source", "b1").agg(F.sum("size").alias("words")).join(some, of("source", "s1")).drop("s1").withColumn("zero", F.lit(0.0))
    first = materialize(crossing(first, "zero", "need", "b1", "cut1").join(some, of("source", "s1")).drop("s1"), "cut1")
    inside = first.select(F.col("source").alias("s2"), "cut1", F.col("from").alias("before"), "need")
    second = (checked_join(docs, inside, of("source", "s2") & (F.col("b1") == F.col("cut1")))
              .groupBy("source", "b2").agg(F.sum("size").alias("words"), F.first("before").alias("before"), F.first("need").alias("need")))
    # The crossing bucket is taken if that comes nearer to the target than leaving it.
    run = W.partitionBy("source").orderBy("b2")
    second = second.withColumn("upto", F.col("before") + F.sum("words").over(run)).where(F.col("upto") - F.col("words") / 2.0 <= F.col("need"))
    second = second.groupBy(F.col("source").alias("s3")).agg(F.max("b2").alias("cut2"))
    plan = (sources.join(first.select(F.col("source").alias("s4"), "cut1"), of("source", "s4"), "left").drop("s4")
            .join(second, of("source", "s3"), "left").drop("s3")
            .select(F.col("source").alias("plan_source"), "source_size", "target", "whole", "cut1", F.coalesce("cut2", F.lit(-1)).alias("cut2")))
    return materialize(plan, "mix-plan")


def _repetitions(epochs: int):
    extra = F.coalesce((F.col("b1") < F.col("cut1")) | ((F.col("b1") == F.col("cut1")) & (F.col("b2") <= F.col("cut2"))), F.lit(False)).cast("long")
    return F.col("whole") + F.when(F.col("whole") < epochs, extra).otherwise(0)


def mix(df: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = MOST_EPOCHS, seed: str = "mix-1",
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, size, source_size, target (the source's words in the mix), taken, repetitions.

    ``weights`` repeat over the sources in code point order, null last.
    """
    docs = materialize(sizes_of(df, seed, id_col, text_col, source_col), "sizes")
    out = checked_join(docs, mix_plan(docs, weights, share, epochs), F.col("source").eqNullSafe(F.col("plan_source")))
    times = _repetitions(epochs)
    return out.select("doc_id", "size", "source_size", "target", (times * F.col("size")).alias("taken"), times.alias("repetitions"))


def mixed(df: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = MOST_EPOCHS, seed: str = "mix-1",
          id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``df``, all columns, each as often as the mix takes it."""
    plan = mix_plan(materialize(sizes_of(df, seed, id_col, text_col, source_col), "sizes"), weights, share, epochs)
    row = F.struct(*[df[c] for c in df.columns]).alias("row")
    rows = df.select(row, *_place(df, seed, id_col, text_col, source_col))
    rows = checked_join(rows, plan, F.col("source").eqNullSafe(F.col("plan_source"))).withColumn("times", _repetitions(epochs))
    return rows.where("times > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("row.*")


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents"))


#: The same mix by sorted caps: sources fill up in the order of cap by weight, and the level is that of the first that does not.
OP6_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
h AS (SELECT *, md5('mix-1|' || coalesce(doc_id::VARCHAR, '') || '|' || size::VARCHAR) AS m FROM d),
k AS (SELECT doc_id, source, size, ('0x' || substr(m, 1, 3))::INT AS b1, ('0x' || substr(m, 4, 3))::INT AS b2 FROM h),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM k GROUP BY source),
o AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM s),
r AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
  sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM o),
l AS (SELECT coalesce(min(level), 0) AS level FROM (SELECT (total - used) / open AS level FROM r WHERE (total - used) / open * weight <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1)),
t AS (SELECT source, source_size, least(cap, level * weight) AS target FROM o, l),
w AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-12)::BIGINT ELSE 0 END AS whole FROM t),
n AS (SELECT *, target - whole * source_size AS need FROM w),
c AS (SELECT k.source, k.b1, sum(k.size) AS words FROM k JOIN n ON k.source IS NOT DISTINCT FROM n.source WHERE n.need > 0.5 GROUP BY ALL),
u AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY b1) - words AS before FROM c),
x AS (SELECT u.source, max(u.b1) AS cut1, max(u.before) AS before, any_value(n.need) AS need FROM u JOIN n ON u.source IS NOT DISTINCT FROM n.source WHERE u.before < n.need GROUP BY u.source),
y AS (SELECT k.source, k.b2, sum(k.size) AS words, any_value(x.before) AS before, any_value(x.need) AS need FROM k JOIN x ON k.source IS NOT DISTINCT FROM x.source AND k.b1 = x.cut1 GROUP BY ALL),
z AS (SELECT *, before + sum(words) OVER (PARTITION BY source ORDER BY b2) AS upto FROM y),
q AS (SELECT source, max(b2) AS cut2 FROM z WHERE upto - words / 2.0 <= need GROUP BY source),
p AS (SELECT k.doc_id, k.size, n.source_size, n.target, n.whole + CASE WHEN n.whole < 2 AND (k.b1 < x.cut1 OR (k.b1 = x.cut1 AND k.b2 <= coalesce(q.cut2, -1))) THEN 1 ELSE 0 END AS repetitions
  FROM k JOIN n ON k.source IS NOT DISTINCT FROM n.source LEFT JOIN x ON k.source IS NOT DISTINCT FROM x.source LEFT JOIN q ON k.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, (repetitions * size)::BIGINT AS taken, repetitions::BIGINT AS repetitions FROM p
"""
