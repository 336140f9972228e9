import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import divergence as D
from tests.llm.data import awkward, empty, frame, prose, row

TERM = re.compile(rb"[A-Za-z\x80-\xff]+")


def terms(text) -> list[bytes]:
    return [t.lower() for t in TERM.findall((text or "").encode())]  # bytes.lower() changes A-Z alone


def brute(rows, least, ranks):
    """The report by plain counting."""
    in_docs, count, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source, found = lang or "", source or "", terms(text)
        groups.add((lang, source))
        count[lang, source].update(found)
        in_docs[lang].update(set(found))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in in_docs[lang].items() if n >= least)
        sources = sorted((s for at, s in groups if at == lang), key=str.encode)
        each = {s: [count[lang, s][t] for t in kept] for s in sources}
        each[None] = [sum(c) for c in zip(*each.values(), strict=True)]
        p = {s: [1 + 10**9 * (c + 5) // (sum(n) + 5 * len(kept)) for c in n] for s, n in each.items()}
        for s in sources:
            pair = [(-sum(abs(a - b) for a, b in zip(p[s], p[o], strict=True)), o.encode()) for o in sources if o != s]
            above = [(-(a - b), t) for a, b, t, c in zip(p[s], p[None], kept, each[s], strict=True) if c and a > b]
            for part, items, most in (("pair", pair, None), ("term", above, ranks)):
                out |= {(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(sorted(items)[:most])}
    return out


def check(spark, rows, least=3, ranks=4, **sizes):
    got = [tuple(r) for r in D.divergence_audit(frame(spark, rows), least, ranks, **sizes).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, least, ranks)
    return got


def many(n=300, sources=9, seed=5):
    rng = random.Random(seed)
    vocab = ["a", "ab", "abcdefgh", "abcdefghi", "abcdefghijklmnop", "abcdefghijklmnopq", "été", "日本", "Zz"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    return [row(1000 + i, prose(rng, rng.randint(0, 60), vocab) + "1x'y", f"s{rng.randint(0, sources)}" if i % 3 else "hot", rng.choice(["en", "de"])) for i in range(n)]


def test_against_plain_counting(spark):
    got = check(spark, awkward() + many())
    assert {r[2] for r in got} == {"pair", "term"}


def test_blocks_of_sources_and_buckets_of_terms(spark):
    """Several blocks and buckets give the sums of one."""
    check(spark, many(), sources=4, bucket_rows=40)


def test_languages_without_kept_terms_and_groups_without_terms(spark):
    rows = [row(1, "one two", "a", "xx"), row(2, None, "b", "xx"), row(3, "12 34", None, None), row(4, "", "c", None)] + many(60) + [row(5, "", "bare", "en")]
    got = check(spark, rows, 5)
    assert ("xx", "a", "pair", "b", 0, 1) in got and any(r[:2] == ("en", "bare") for r in got)


def test_empty_table(spark):
    assert D.divergence_audit(empty(spark)).collect() == []


@pytest.mark.parametrize("small", [1, 40, 4096])
def test_multikey_quicksort(monkeypatch, small):
    monkeypatch.setattr(D, "SMALL", max(small, 9))
    rng = random.Random(small)
    texts = [" ".join("".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 7, 8, 9, 16, 17, 40]))) for _ in range(rng.randint(0, 50))) for _ in range(40)]
    texts += ["", "ab", "ab", "same " * 100, "x" * 5000 + " " + "x" * 5001, None, "tail"]
    buffer, starts, ends, text = D.term_starts(pa.array(texts, pa.string()))
    found = [bytes(buffer[s:e]) for s, e in zip(starts, ends, strict=True)]
    assert found == [t for x in texts for t in terms(x)]
    assert text.tolist() == [k for k, x in enumerate(texts) for _ in terms(x)]
    order, new = D.multikey_quicksort(buffer, starts, ends)
    assert order.tolist() == sorted(range(len(found)), key=lambda k: (found[k], k))
    assert np.flatnonzero(new).tolist() == [k for k in range(len(order)) if not k or found[order[k]] != found[order[k - 1]]]
