"""Small documents with the awkward cases that every operator has to stand."""

import random

WORDS = [f"w{i}" for i in range(400)]
TYPES = "doc_id long, text string, lang string, source string, n_chars long, key long, size string, h int, words string"


def prose(rng: random.Random, n: int, vocab=WORDS) -> str:
    return " ".join(rng.choice(vocab) for _ in range(n))


def row(doc_id, text, source="a", lang="en"):
    """A document with further columns whose names operators use inside."""
    return (doc_id, text, lang, source, None if text is None else len(text), 7, "x", 1, "y")


def awkward(seed: int = 0) -> list[tuple]:
    """Null and repeated ids, null, empty, blank and very long texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(seed)
    passage = prose(rng, 60)
    base = prose(rng, 120)
    near = base.split()
    near[60] = "other"
    rows = [row(1, None), row(2, ""), row(3, " \t\n"), row(4, "one"), row(5, "ONE"), row(6, "one two three"), row(None, "one two three"), row(None, None, None),
            row(7, base, None), row(8, base.upper(), "b"), row(9, " ".join(near), "b"), row(10, base + " tail", "c"),
            row(11, prose(rng, 40) + " " + passage + " " + prose(rng, 30)), row(12, prose(rng, 10) + " " + passage), row(12, prose(rng, 50), "c"),
            row(13, "again " * 300, "b"), row(14, prose(rng, 30_000), "d"), row(15, "Été à la ÉTÉ x　y", "é"), row(16, "é" * 20, "\U0001f600"),
            row(17, prose(rng, 200)), row(17, prose(random.Random(9), 200))]
    rows += [row(20 + i, prose(rng, rng.randint(3, 200)), rng.choice("abc")) for i in range(30)]
    return rows + [rows[8], rows[8], rows[16]]


def frame(spark, rows):
    return spark.createDataFrame(rows, TYPES).repartition(3)


def empty(spark):
    return spark.createDataFrame([], TYPES)


def words(text) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]


def lower(text) -> str:
    return (text or "").encode().lower().decode()
