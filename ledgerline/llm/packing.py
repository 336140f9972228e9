"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing.

Documents become token ids and one end id.  Only longer ones are cut, into
pieces of a whole sequence; the rest of each document is one item.  A round
deals the items over tasks, each of which packs its own best fit, longest
first, and emits the sequences that are nearly full.  What stays underfull
goes on as one item to the next round, with fewer tasks: a tree of merges whose
tasks each hold at most ``task_items`` items.  An item is a number and its
length alone; which pieces it holds, and where, is a table beside it that each
round's moves are joined to, so a task's memory does not grow with the members
of a bin.  The tree ends after a round in one task, or when a round joins less
than ``LEAST_GAIN`` of the open bins, at any size.

The tokenizer drops white space and never joins over it, so the ids of a text
are those of its words in a row; a task encodes each different word once.

Defined cases: a null or empty text is the end id alone; null and repeated
ids are packed as they come (a piece is a row); very long texts give many
pieces; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ids_and_texts, load, materialize, parallelism, slices, words

LENGTH = 2048
END_ID = 0
#: A sequence with at most this many free places is emitted before the last round.
NEARLY_FULL = 16
TASK_ITEMS = 100_000
MERGE = 4
LEAST_GAIN = 0.01
#: Words that a Python worker remembers with their ids.
CACHE_WORDS = 400_000
TAIL = re.compile(r"(?<=[^\W_])([.,]+)$")

_TOKENIZERS: dict[str, object] = {}
_IDS: dict[str, dict[str, bytes]] = {}

PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long"
#: A round's moves: an item, the bin that it is in from now on (named after its first item), its place there, and what the bin holds.
MOVE = "item long, bin long, base long, used int"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable bytes stand for themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters()


def _encoded(new: list[str], tokenizer) -> list[bytes]:
    """The ids of each word.  A word of letters alone is one token group, whose merges are asked of the model without the splitting rules."""
    out: list[bytes | None] = [None] * len(new)
    rest = []
    for i, w in enumerate(new):
        low = w.lower()
        if low.isalpha() and "\u03a3" not in w and is_normalized("NFC", w):
            found = tokenizer.model.tokenize(low if low.isascii() else low.encode().decode("latin-1").translate(BYTE_LETTERS))
            out[i] = array("I", [t.id for t in found]).tobytes()
        else:
            rest.append(i)
    for k in range(0, len(rest), 20_000):
        some = rest[k:k + 20_000]
        for i, e in zip(some, tokenizer.encode_batch_fast([new[i] for i in some], add_special_tokens=False), strict=True):
            out[i] = array("I", e.ids).tobytes()
    return out


def word_ids(vocab: list[str], tokenizer: str) -> list[bytes]:
    """The ids of each word as unsigned 32-bit numbers, remembered by the worker.

    A final run of dots and commas after a letter or digit is a token group of
    its own (the tokenizer splits there), so such words share their stem.
    """
    if tokenizer not in _TOKENIZERS:
        from tokenizers import Tokenizer

        _TOKENIZERS[tokenizer] = Tokenizer.from_file(tokenizer)
    known = _IDS.setdefault(tokenizer, {})
    if len(known) > CACHE_WORDS:
        known.clear()
    got = list(map(known.get, vocab))
    new = [w for w, v in zip(vocab, got, strict=True) if v is None]
    if not new:
        return got
    parts = [(w[:m.start()], m[1]) if (m := TAIL.search(w)) else (w, "") for w in new]
    stems = list({p for pair in parts for p in pair if p not in known})
    known.update(zip(stems, _encoded(stems, _TOKENIZERS[tokenizer]), strict=True))
    known.update({a + b: known[a] + known[b] for a, b in parts if b})
    return list(map(known.__getitem__, vocab))


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""

    def cut(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        for batch in batches:
            for part in slices(batch, "text"):
                at, ids, vocab = words(part.column("text"))
                got = word_ids(vocab, tokenizer)
                size = np.fromiter(map(len, got), np.int64, len(got)) // 4
                flat = np.append(np.frombuffer(b"".join(got), "<u4"), np.uint32(end_id))
                starts = np.concatenate([[0], np.cumsum(size)])
                # Where each word's ids come from; an end id after each text.
                ends = at[1:]
                order = np.insert(ids.astype(np.int64), ends, len(got))
                size = np.append(size, 1)
                n = size[order]
                to = np.cumsum(n)
                tokens = flat[np.repeat(starts[order] - (to - n), n) + np.arange(to[-1] if len(to) else 0)]
                last = to[ends + np.arange(len(ends))]
                cols = [[], [], [], [], []]
                begin = 0
                for doc, end in zip(part.column("doc_id").to_pylist(), last.tolist(), strict=True):
                    for k, s in enumerate(range(begin, end, length)):
                        p = tokens[s:min(s + length, end)]
                        for c, v in zip(cols, (doc, k, s - begin, len(p), zlib.crc32(p.tobytes())), strict=True):
                            c.append(v)
                    begin = end
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()), strict=True)],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECE)


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Items by number, packed best fit, longest first: each goes to the fullest bin that still takes it."""
    rooms: list[int] = []  # the different free rooms, ascending
    by_room: dict[int, list[int]] = {}
    bins: list[list[int]] = []

    def put(room: int, b: int) -> None:
        if room not in by_room:
            by_room[room] = []
            insort(rooms, room)
        by_room[room].append(b)

    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        k = bisect_left(rooms, sizes[i])
        if k == len(rooms):
            bins.append([i])
            put(length - sizes[i], len(bins) - 1)
            continue
        room = rooms[k]
        b = by_room[room].pop()
        if not by_room[room]:
            del by_room[room], rooms[k]
        bins[b].append(i)
        put(room - sizes[i], b)
    return bins


def _round(length: int):
    def join(frames):
        rows = [f for f in frames if len(f)]
        if not rows:
            return
        items = pd.concat(rows, ignore_index=True).sort_values(["used", "bin"], ascending=[False, True])
        used, names = items["used"].tolist(), items["bin"].to_numpy()
        bins = best_fit(used, length)
        order = np.fromiter((i for b in bins for i in b), np.int64, len(used))
        size, count = np.array(used, np.int64)[order], np.fromiter(map(len, bins), np.int64, len(bins))
        first = np.concatenate([[0], np.cumsum(count)[:-1]])
        before = np.cumsum(size) - size
        whole = np.add.reduceat(size, first)
        yield pd.DataFrame({"item": names[order], "bin": np.repeat(names[order[first]], count), "base": before - np.repeat(before[first], count), "used": np.repeat(whole, count).astype(np.int32)})

    return join


def pack(items: DataFrame, length: int = LENGTH, nearly_full: int = NEARLY_FULL, task_items: int = TASK_ITEMS, merge: int = MERGE) -> DataFrame:
    """Pieces with sequence_id and offset.  ``items``: piece rows, none longer than ``length``."""
    spark = items.sparkSession
    fields = [c.split()[0] for c in PIECE.split(", ")]
    items = materialize(items.select(*fields, F.monotonically_increasing_id().alias("item")), "numbered-pieces")
    done = items.where(F.col("length") >= length).select("item", F.col("item").alias("bin"), F.lit(0).cast("long").alias("at"))
    left = items.where(F.col("length") < length).select(F.col("item").alias("bin"), F.col("length").alias("used"))
    n, k, places = left.count(), 0, None  # places: pieces of open bins
    tasks = max(1, min(parallelism(spark), -(-n // 2_000)), -(-n // task_items))
    while n:
        k += 1
        moves = materialize(left.repartition(tasks).mapInPandas(_round(length), MOVE), f"pack-{k}")
        if places is None:
            places = moves.select("item", "bin", F.col("base").alias("at"), "used")
        else:
            moved = moves.select(F.col("item").alias("old"), F.col("bin").alias("new"), "base", F.col("used").alias("filled"))
            places = places.join(moved, places["bin"] == moved["old"]).select("item", F.col("new").alias("bin"), (F.col("at") + F.col("base")).alias("at"), F.col("filled").alias("used"))
            places = materialize(places, f"places-{k}")
        full = F.col("used") >= length - nearly_full
        left = moves.where(~full & (F.col("item") == F.col("bin"))).select("bin", "used")
        before, n = n, left.count()
        if tasks == 1 or n > (1 - LEAST_GAIN) * before:
            done = done.unionByName(places.drop("used"))
            break
        done = done.unionByName(places.where(full).drop("used"))
        places = places.where(~full)
        tasks = max(1, min(tasks // merge, -(-n // 2_000)), -(-n // task_items))
    placed = done.select("item", F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    return items.join(placed, "item").select(*fields, "sequence_id", "offset").withColumn("length", F.col("length").cast("long"))


def pack_documents(df: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents of ``df`` as packed pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(materialize(pieces(ids_and_texts(df, id_col, text_col), tokenizer, length, end_id), "pieces"), length)


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
