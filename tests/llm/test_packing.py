import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from ledgerline.llm import packing as P
from tests.llm.data import awkward, empty, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


@pytest.mark.parametrize("length", [64, 2048])
def test_pieces_and_places(spark, tokenizer, length):
    rows = awkward()
    got = P.pack_documents(frame(spark, rows), PATH, length).toPandas()
    want = []
    for r in rows:
        ids = ids_of(tokenizer, r[1])
        for k, s in enumerate(range(0, len(ids), length)):
            p = ids[s:s + length]
            want.append((r[0], k, s, len(p), zlib.crc32(p.tobytes())))
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    key = lambda t: tuple(-1 if x is None else x for x in t)
    have = [tuple(None if v != v else int(v) for v in t) for t in got[cols].itertuples(index=False, name=None)]
    assert sorted(have, key=key) == sorted(want, key=key)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g["offset"].tolist() == [0, *np.cumsum(g["length"])[:-1].tolist()] and g["length"].sum() <= length
    assert got["sequence_id"].nunique() <= 1.05 * -(-got["length"].sum() // length) + 1


def test_empty_table(spark):
    assert P.pack_documents(empty(spark), PATH).count() == 0


def test_several_rounds_keep_every_piece(spark):
    """Many small tasks whose underfull bins merge over rounds."""
    rng = random.Random(3)
    items = [(i, 0, 0, rng.randint(1, 100), i) for i in range(3000)]
    df = spark.createDataFrame(items, P.PIECE)
    got = P.pack(df, length=100, nearly_full=0, task_items=700, merge=2).toPandas()
    assert sorted(got["doc_id"]) == list(range(3000))
    assert got.groupby("sequence_id")["length"].sum().max() <= 100
    assert got["sequence_id"].nunique() <= 1.03 * sum(x[3] for x in items) / 100 + 1


def test_small_tasks_pack_as_well_as_one(spark):
    """At any number of items per task: within half a hundredth of one task's sequences, and no size ends the rounds early."""
    rng = random.Random(6)
    df = spark.createDataFrame([(i, 0, 0, min(1024, 1 + int(rng.lognormvariate(4.7, 1))), i) for i in range(6000)], P.PIECE)
    one = P.pack(df, length=1024).select("sequence_id").distinct().count()
    for task_items in (300, 1500):
        got = P.pack(df, length=1024, task_items=task_items, nearly_full=4)
        assert got.select("sequence_id").distinct().count() <= 1.005 * one + 1 and got.count() == 6000


def test_repeated_rows_over_several_rounds(spark):
    """Pieces that are equal in every column keep places of their own."""
    df = spark.createDataFrame([(i % 7, 0, 0, 10 + i % 3, 5) for i in range(900)], P.PIECE)
    got = P.pack(df, length=100, nearly_full=0, task_items=100, merge=2).toPandas()
    assert len(got) == 900
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g["offset"].tolist() == [0, *np.cumsum(g["length"])[:-1].tolist()] and g["length"].sum() <= 100


def test_best_fit_is_near_the_bound():
    rng = random.Random(1)
    sizes = [rng.randint(1, 2047) for _ in range(5000)]
    bins = P.best_fit(sizes, 2048)
    assert sorted(i for b in bins for i in b) == list(range(5000)) and max(sum(sizes[i] for i in b) for b in bins) <= 2048
    assert len(bins) <= 1.02 * sum(sizes) / 2048 + 1


def test_word_ids_are_those_of_the_whole_text(tokenizer):
    texts = ["a b İstanbul ΟΔΟΣ Σ x́ ́y <|endoftext|>z a<|startoftext|>  b", "x　y don't we'll 1234. ¹, ⅷ.", "é ‍ x é. Éa., x²., 中文. ª º ǅ ŉ ß ẞ ﬁ",
             "a\x1cb \x85c", "ΑΣ ΑΣ'b Å Å K", "İ ̇ x., x_. _., it's. 's, 're."]
    for text in texts:
        words = [w.decode() for w in text.encode().split()]
        got = np.frombuffer(b"".join(P.word_ids(words, PATH)), "<u4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, text
