import hashlib
import os

from ledgerline.llm import warc as R

PAGES = "page_id long, url string, html string, keep string, payload int, n int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], PAGES).repartition(2)


ROWS = [(1, "http://a/1", "hello"), (2, "http://a/2", "hello"), (3, None, "hello"), (4, "http://a/4\r\nX: y", None), (5, "u", ""), (6, "u", "é\r\n\r\nWARC/1.1\r\n" * 3000),
        (7, "u", "x" * 100_000), (None, "u", "hello"), (None, "u", "alone"), (3, "u", "hello"), (8, "u", "again" * 20_000), (8, "u", "again" * 20_000)]


def expected(rows):
    keep = {}
    for i, _, h in rows:
        keep.setdefault(h or "", []).append(i)
    out = []
    for i, _, h in rows:
        k = max((x for x in keep[h or ""] if x is not None), default=None)
        data = (h or "").encode()
        revisit = k is not None and i != k
        out.append((i, len(data), R.digest(data), "revisit" if revisit else "response", k if revisit else None, True))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    for name, options in (("a", {}), ("b", {"segment_bytes": 1_000, "records_per_file": 7}), ("c", {"compression": "gzip"})):
        path = str(tmp_path / name)
        R.write_archives(pages(spark, ROWS), path, **options)
        got = sorted((tuple(r) for r in R.page_report(spark, path).collect()), key=str)
        assert got == expected(ROWS)


def test_payload_comes_back(spark, tmp_path):
    path = str(tmp_path / "p")
    R.write_archives(pages(spark, ROWS), path, segment_bytes=500)
    got = {bytes(r["payload"]) for r in R.payloads(R.reassemble(R.read_records(spark, path))).collect() if r["payload"] is not None}
    assert got == {(h or "").encode() for _, _, h in ROWS}


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "none")
    R.write_archives(pages(spark, ROWS).where("page_id = -1"), path)
    assert R.page_report(spark, path).count() == 0


def test_missing_or_false_segments_are_not_complete(spark):
    block = R.http_payload.__doc__.encode() * 40
    full = b"HTTP/1.1 200 OK\r\n\r\n" + block
    part = lambda n, a, b, total=None: (f"r{n}" if n > 1 else "o", "continuation" if n > 1 else "response", None, None, None, n, "o" if n > 1 else None, total, full[a:b])
    end = len(full)
    cases = {"fine": ([part(3, 900, end, end), part(1, 0, 400), part(2, 400, 900)], True), "gap": ([part(1, 0, 400), part(3, 900, end, end)], False),
             "no end": ([part(1, 0, 400), part(2, 400, 900)], False), "wrong total": ([part(1, 0, 400), part(2, 400, end, end + 1)], False), "no start": ([part(2, 400, end, end)], False)}
    for name, (rows, fine) in cases.items():
        got = R.payloads(R.reassemble(spark.createDataFrame(rows, R.RECORD))).collect()
        assert len(got) == 1 and got[0]["complete"] == fine, name
        assert (bytes(got[0]["payload"]) == block) if fine else got[0]["payload"] is None, name


def test_chunked_framing():
    data = os.urandom(10_000)
    assert R.unchunked(R.chunked(data, 777)) == data
    assert R.unchunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for broken in (b"", b"5\r\nab", b"zz\r\n", b"3\r\nabcd\r\n0\r\n\r\n"):
        try:
            R.unchunked(broken)
        except ValueError:
            continue
        raise AssertionError(broken)


def test_stated_digest_is_checked(spark):
    row = ("r", "response", None, None, "sha1:" + R.digest(b"other"), None, None, None, b"HTTP/1.1 200 OK\r\n\r\nbody")
    got = R.payloads(R.reassemble(spark.createDataFrame([row], R.RECORD))).first()
    assert not got["complete"] and got["payload"] is None
    assert hashlib.sha1(b"").hexdigest() == "da39a3ee5e6b4b0d3255bfef95601890afd80709" and R.digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
