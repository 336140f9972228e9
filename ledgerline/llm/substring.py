"""Removal of repeated passages by suffix automata of content-routed shards.

A window is ``width`` consecutive words of one document; every word covered by
a window that also starts anywhere else is removed.  Windows are judged on the
input alone.

The reference that a document is held against is the whole corpus, so its
automata have no size bound and are not broadcast.  Instead the passages that
can repeat travel to the shard that can answer for them:

1. Each window is named by the smallest hash among its ``gram``-word sequences
   (its anchor).  Equal windows have equal anchors; neighbouring windows mostly
   share one, so a document yields a row per run of windows, not per word.
2. Anchors that occur once in the corpus cannot belong to a repeated window.
   Where all runs of an anchor are one and the same sequence in several places,
   every window in them repeats.  Only the runs of other anchors go on, as word
   sequences, equal ones of a task's texts merged with their number.
3. A shard holds all sequences of an anchor.  It builds one suffix automaton of
   them, with the number of places of each state, and streams every sequence
   through it: the matching statistics at each word give the state of the last
   ``width`` words, and a state with two places or more marks the window.
4. An anchor with more than ``most`` different sequences (a short phrase that is
   everywhere, in ever different company) would make an unbounded shard.  Its
   windows are dealt by their own hash and counted there, which is exact as well.

Words and sequences are compared by 64-bit hashes.

Defined cases: a null or empty text has no words; fewer than ``width`` words
are never removed; rows repeated with one id and text count as two places;
null ids are kept; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import hash_words, ids_and_texts, load, materialize, mix64, shingles, slices, words

WIDTH = 35
GRAM = 12
#: Different sequences of an anchor in one automaton.
MOST = 256
#: Longer runs of windows (a phrase over and over) are cut.
RUN = 256
#: Joined without moving the texts while the other side has at most so many bytes.
BROADCAST_BYTES = 32 << 20


def with_text(docs: DataFrame, written: DataFrame, size, how: str) -> DataFrame:
    """``docs`` joined by key; ``written`` is broadcast if its measured bytes allow it."""
    held = written.agg(F.coalesce(F.sum(size + 24), F.lit(0))).first()[0]
    return docs.join(F.broadcast(written) if held <= BROADCAST_BYTES else written, "key", how)


def runs(texts: pa.Array, width: int, gram: int):
    """Word hashes, text offsets, and the runs of windows with one anchor: first window, end, anchor, places of the anchor, hash of the words."""
    at, ids, vocab = words(texts, lower=False)
    h = hash_words(vocab)[ids] if len(ids) else np.zeros(0, np.uint64)
    span = width - gram + 1  # grams of a window
    n = len(h) - width + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return h, at, none, none, none.view(np.uint64), none, none.view(np.uint64)
    grams = shingles(h, gram)
    # Ordered by hash, then by place, so that of equal grams the first is taken in every copy of a window.
    bits = np.uint64(len(grams).bit_length())
    least, done = ((grams >> bits) << bits) | np.arange(len(grams), dtype=np.uint64), 1
    while done < span:
        step = min(done, span - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    place = (least[:n] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    anchor = grams[place]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.minimum(at[:-1], n), 1)
    np.add.at(edge, np.minimum(np.maximum(at[1:] - width + 1, at[:-1]), n), -1)
    ok = np.cumsum(edge)[:n] > 0  # windows that do not run over a text's end
    new = ok.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~ok[:-1]
    new[at[:-1][at[:-1] < n]] |= ok[at[:-1][at[:-1] < n]]
    start = np.flatnonzero(new)
    good = np.concatenate([[0], np.cumsum(ok)])
    stop = start + (good[np.append(start[1:], n)] - good[start])
    pieces = -(-(stop - start) // RUN)
    k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    stop = np.minimum(np.repeat(stop, pieces), np.repeat(start, pieces) + RUN * (k + 1))
    start = np.repeat(start, pieces) + RUN * k
    moved = np.concatenate([[True], place[1:] != place[:-1]]) | new
    upto = np.concatenate([[0], np.cumsum(moved & ok)])
    places = upto[stop] - upto[start] + ~moved[start]
    base, back = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    powers = np.cumprod(np.append(np.uint64(1), np.full(len(h), base)))
    inverse = np.cumprod(np.append(np.uint64(1), np.full(len(h), back)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers[:-1])])
    end = stop + width - 1
    content = mix64((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))
    return h, at, start, stop, anchor[start], places, content


ANCHORS = "anchor long, content long, key long, first int, n int, places int"


def anchors(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """One row per run of windows: its anchor, hash of its words, text, first window in the text, windows, places of the anchor."""

    def find(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                _, at, start, stop, anchor, places, content = runs(part.column("text"), width, gram)
                doc = np.searchsorted(at, start, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), part.column("key").take(pa.array(doc)), pa.array((start - at[doc]).astype(np.int32)),
                     pa.array((stop - start).astype(np.int32)), pa.array(places.astype(np.int32))], [c.split()[0] for c in ANCHORS.split(", ")])

    return docs.mapInArrow(find, ANCHORS)


def sequences(chosen: DataFrame, width: int, gram: int) -> DataFrame:
    """(anchor, content, words, copies): the chosen runs as word-hash sequences, equal ones of a task's texts once."""

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                h, at, start, stop, anchor, _, content = runs(part.column("text"), width, gram)
                picked = np.concatenate([a + np.array(f, np.int64) for a, f in zip(at[:-1].tolist(), part.column("firsts").to_pylist(), strict=True)])
                picked = np.searchsorted(start, picked)
                of, one, copies = np.unique(np.stack([anchor[picked], content[picked]], 1), axis=0, return_index=True, return_counts=True)
                data = [h[start[i]:stop[i] + width - 1].tobytes() for i in picked[one].tolist()]
                for s in range(0, len(data), 10_000):
                    e = s + 10_000
                    yield pa.RecordBatch.from_arrays([pa.array(of[s:e, 0].view(np.int64)), pa.array(of[s:e, 1].view(np.int64)), pa.array(data[s:e], pa.binary()), pa.array(copies[s:e].astype(np.int64))],
                                                     ["anchor", "content", "words", "copies"])

    return chosen.select("text", "firsts").mapInArrow(cut, "anchor long, content long, words binary, copies long")


class SuffixAutomaton:
    """Of several sequences, each with a number of copies; ``places`` of a state: where its substrings end, copies counted."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.size = [0]
        self.places = [0]

    def _state(self, size: int, nxt: dict, link: int) -> int:
        self.next.append(nxt)
        self.size.append(size)
        self.link.append(link)
        self.places.append(0)
        return len(self.size) - 1

    def _split(self, p: int, symbol, q: int) -> int:
        """The state of the longest substring of ``q`` that extends ``p``."""
        if self.size[q] == self.size[p] + 1:
            return q
        copy = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        while p != -1 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def add(self, sequence, copies: int = 1) -> None:
        last = 0
        for symbol in sequence:
            if symbol in self.next[last]:
                last = self._split(last, symbol, self.next[last][symbol])
            else:
                cur = self._state(self.size[last] + 1, {}, 0)
                p = last
                while p != -1 and symbol not in self.next[p]:
                    self.next[p][symbol] = cur
                    p = self.link[p]
                if p != -1:
                    self.link[cur] = self._split(p, symbol, self.next[p][symbol])
                last = cur
            self.places[last] += copies

    def close(self) -> None:
        """Carries the places of longer substrings to their suffixes."""
        for v in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            if self.link[v] > 0:
                self.places[self.link[v]] += self.places[v]

    def repeated(self, sequence, width: int, least: int = 2) -> list[bool]:
        """Per window of ``sequence``: whether its words end in ``least`` places or more, by matching statistics."""
        out, state, matched = [], 0, 0
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.size[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                matched += 1
            while state and self.size[self.link[state]] >= width:  # only the last ``width`` words count
                state = self.link[state]
                matched = self.size[state]
            out.append(matched >= width and self.places[state] >= least)
        return out[width - 1:]


def _spans(marks) -> bytes:
    """Runs of marked windows as pairs of 32-bit numbers: first, end."""
    m = np.concatenate([[0], np.asarray(marks, np.int8), [0]])
    edge = np.flatnonzero(np.diff(m))
    return edge.astype("<i4").tobytes()


SPANS = "anchor long, content long, spans binary"


def _rows_of(found: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["anchor", "content", "spans"])


def shard_spans(seqs: DataFrame, width: int) -> DataFrame:
    """(anchor, content, spans) of the sequences with repeated windows.  Rows of an anchor come in a row."""

    def judge(anchor, group: dict):
        auto = SuffixAutomaton()
        for data, copies in group.values():
            auto.add(np.frombuffer(data, np.uint64).tolist(), copies)
        auto.close()
        for content, (data, _) in group.items():
            marks = auto.repeated(np.frombuffer(data, np.uint64).tolist(), width)
            if any(marks):
                yield anchor, content, _spans(marks)

    def run(batches):
        out, group, now = [], {}, None
        for batch in batches:
            for anchor, content, data, copies in zip(*(batch.column(c).to_pylist() for c in ("anchor", "content", "words", "copies")), strict=True):
                if anchor != now and group:
                    out += judge(now, group)
                    group = {}
                now = anchor
                group[content] = (data, copies + (group[content][1] if content in group else 0))
            if len(out) > 10_000:
                yield _rows_of(out)
                out = []
        out += judge(now, group) if group else []
        if out:
            yield _rows_of(out)

    return seqs.repartition("anchor").sortWithinPartitions("anchor").select("anchor", "content", "words", "copies").mapInArrow(run, SPANS)


def window_spans(seqs: DataFrame, width: int) -> DataFrame:
    """As shard_spans, for anchors with very many sequences: every window is dealt by its own hash and counted."""

    def cut(batches):
        for batch in batches:
            cols = [[], [], [], [], []]
            for anchor, content, data, copies in zip(*(batch.column(c).to_pylist() for c in ("anchor", "content", "words", "copies")), strict=True):
                for i in range(len(data) // 8 - width + 1):
                    for c, v in zip(cols, (hashlib.blake2b(data[8 * i:8 * (i + width)], digest_size=16).digest(), anchor, content, i, copies), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)],
                                             ["window", "anchor", "content", "i", "copies"])

    rows = materialize(seqs.mapInArrow(cut, "window binary, anchor long, content long, i int, copies long"), "windows")
    twice = materialize(rows.groupBy("window").agg(F.sum("copies").alias("n")).where("n >= 2").select("window"), "repeated-windows")
    marked = rows.join(twice, "window").groupBy("anchor", "content").agg(F.sort_array(F.collect_set("i")).alias("is"))

    def spans(batches):
        for batch in batches:
            got = []
            for found in batch.column("is").to_pylist():
                marks = np.zeros(found[-1] + 1, np.int8)
                marks[found] = 1
                got.append(_spans(marks))
            yield pa.RecordBatch.from_arrays([batch.column("anchor"), batch.column("content"), pa.array(got, pa.binary())], ["anchor", "content", "spans"])

    return marked.mapInArrow(spans, SPANS)


def _merged(rows: DataFrame) -> DataFrame:
    """(key, spans): the spans of each text as few pairs of 32-bit numbers as they make."""

    def run(batches):
        for batch in batches:
            out = []
            for found in batch.column("found").to_pylist():
                pairs = sorted((f["first"] + a, f["first"] + b) for f in found for a, b in np.frombuffer(f["spans"], "<i4").reshape(-1, 2).tolist())
                kept = [list(pairs[0])]
                for a, b in pairs[1:]:
                    if a <= kept[-1][1]:
                        kept[-1][1] = max(b, kept[-1][1])
                    else:
                        kept.append([a, b])
                out.append(np.array(kept, "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.binary())], ["key", "spans"])

    return rows.groupBy("key").agg(F.collect_set(F.struct("first", "spans")).alias("found")).mapInArrow(run, "key long, spans binary")


def covers(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """(key, spans): per text with repeated windows, the spans of these as pairs of 32-bit numbers (first window, end)."""
    found = materialize(anchors(docs, width, gram), "anchors")
    twice = (found.groupBy("anchor").agg(F.sum("places").alias("places"), F.count("*").alias("rows"), F.min("content").alias("x"), F.max("content").alias("y"))
             .where("places >= 2").select("anchor", F.expr("x = y and rows >= 2").alias("alike")))
    found = materialize(found.join(materialize(twice, "repeated-anchors"), "anchor").select("anchor", "content", "key", "first", "n", "alike"), "repeated-runs")
    # Runs whose every window repeats: one span from 0 to n, as little-endian bytes.
    number = F.concat(*[F.lpad(F.hex(F.shiftrightunsigned("n", 8 * i).bitwiseAND(255)), 2, "0") for i in range(4)])
    whole = F.unhex(F.concat(F.lit("00000000"), number))
    simple = found.where("alike").select("key", "first", whole.alias("spans"))
    open_runs = found.where("not alike")
    picked = materialize(open_runs.groupBy("key").agg(F.collect_set("first").alias("firsts")), "open-runs")
    # Equal sequences are one row with their copies before they are dealt by anchor (combined in each task first).
    seqs = (sequences(with_text(docs, picked, 4 * F.size("firsts"), "inner"), width, gram)
            .groupBy("anchor", "content").agg(F.min("words").alias("words"), F.sum("copies").alias("copies")))
    seqs = materialize(seqs, "sequences")
    large = materialize(seqs.groupBy("anchor").agg(F.count("*").alias("kinds")).where(F.col("kinds") > most).select("anchor"), "large-anchors")
    if large.isEmpty():
        marked = shard_spans(seqs, width)
    else:
        marked = shard_spans(seqs.join(large, "anchor", "left_anti"), width).unionByName(window_spans(seqs.join(large, "anchor", "left_semi"), width))
    marked = materialize(marked, "marked")
    marked = open_runs.select("anchor", "content", "key", "first").join(marked, ["anchor", "content"]).select("key", "first", "spans")
    return _merged(simple.unionByName(marked))


def remove_repeats(df: DataFrame, width: int = WIDTH, gram: int = GRAM, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, with ``keep_text``, kept_text (kept words, one space between)."""
    docs = ids_and_texts(df, id_col, text_col)
    docs = docs.withColumn("key", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    spans = materialize(covers(docs, width, gram, most), "covers")
    fields = "n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text

    def cut(batches):
        for batch in batches:
            cols = [[], [], [], []]
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                ws = (text or "").encode().split()
                keep = np.ones(len(ws), bool)
                for first, end in np.frombuffer(found or b"", "<i4").reshape(-1, 2).tolist():
                    keep[first:end + width - 1] = False
                kept = b" ".join(ws if not found else [ws[i] for i in np.flatnonzero(keep).tolist()])
                for c, v in zip(cols, (len(ws), int(len(ws) - keep.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()), strict=True):
                    c.append(v)
            out = [batch.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if keep_text:
                out, names = [*out, pa.array(cols[3], pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(out, names)

    rows = with_text(docs, spans, F.octet_length("spans"), "left")
    return rows.select("doc_id", "text", "spans").mapInArrow(cut, f"doc_id {df.schema[id_col].dataType.simpleString()}, {fields}")


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(load(spark, sf_dir, "documents"), keep_text=False)


OP9_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
p AS (SELECT r, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
v AS (SELECT p.r, p.i, md5(list_aggregate(d.w[p.i:p.i + 34], 'string_agg', ' ')) AS h FROM p JOIN d USING (r)),
t AS (SELECT h FROM v GROUP BY h HAVING count(*) > 1),
c AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS k FROM v JOIN t USING (h)),
g AS (SELECT r, list(k) AS gone FROM c GROUP BY r),
x AS (SELECT d.r, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS word FROM d),
y AS (SELECT x.r, string_agg(word, ' ' ORDER BY x.k) AS kept FROM x LEFT JOIN c ON x.r = c.r AND x.k = c.k WHERE c.k IS NULL GROUP BY x.r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(len(g.gone), 0)::BIGINT AS n_removed, sha256(coalesce(y.kept, '')) AS kept_sha256
FROM d LEFT JOIN g ON d.r = g.r LEFT JOIN y ON d.r = y.r
"""
