"""WARC archives: writing pages as records, reading them back, reassembling segments.

Writing: each page becomes an HTTP response record in chunked transfer
framing.  Of records with equal payloads the one with the largest page id
stays a response; the others become revisit records that refer to it.  A block
above ``segment_bytes`` is cut into a first segment and continuation records.
Records are written by Spark's text writer, whose line separator is the two
line ends that close a WARC record, so archives land wherever Spark can write.

Reading: archives are parsed file by file (``records_per_file`` and
``segment_bytes`` bound a file).  Segments are grouped by the record they
started from, ordered by number, joined, and held against the total length
that the last one states; then the chunked framing is decoded.

Defined cases: a null html is an empty payload; a null page_id is written as
such and never is the response that others refer to (unless none of its equals
has an id: then all are responses); rows repeated with one id and payload are
all responses; a segment group with a missing or contradicting part gives a
record that is not ``complete`` and has no payload; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import checked_join, load, materialize
from ledgerline.session import shared_dir

EOL = b"\r\n"
SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 4 << 10
RECORDS_PER_FILE = 2_000
DATE = "2024-01-01T00:00:00Z"
RECORD = ("record_id string, warc_type string, target_uri string, refers_to string, payload_digest string, "
          "segment_number int, origin_id string, total_length long, block binary")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """HTTP/1.1 chunked framing."""
    parts = [b"%x\r\n%s\r\n" % (len(payload[i:i + size]), payload[i:i + size]) for i in range(0, len(payload), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """Decodes chunked framing; chunk extensions and trailers are passed over.  ValueError if it is broken."""
    out, at = [], 0
    while True:
        end = body.index(EOL, at)
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if size < 0:
            raise ValueError("negative chunk size")
        if not size:
            return b"".join(out)
        if body[at + size:at + size + 2] != EOL:
            raise ValueError("chunk without its line end")
        out.append(body[at:at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The body of an HTTP response, without its transfer framing."""
    head, _, body = block.partition(EOL + EOL)
    framed = any(k.strip().lower() == b"transfer-encoding" and b"chunked" in v.lower() for k, _, v in (x.partition(b":") for x in head.split(EOL)[1:]))
    return unchunked(body) if framed else body


def _record(kind: str, record_id: str, fields: dict[str, object], block: bytes) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": DATE, **fields, "Content-Length": len(block)}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None).encode() + EOL + block


def _one_line(url: str | None) -> str | None:
    return None if url is None else "".join("%%%02X" % ord(c) if c in "\r\n" else c for c in url)


def records_of(page_id, url, payload: bytes, keep, segment_bytes: int) -> list[bytes]:
    """The records of a page, without their closing line ends.  ``keep``: the page whose response has the payload, or None."""
    sha1 = hashlib.sha1(payload).hexdigest()
    name = lambda page: f"urn:x-page:{'' if page is None else page}:{sha1}"
    fields = {"WARC-Target-URI": _one_line(url), "WARC-Payload-Digest": f"sha1:{digest(payload)}", "Content-Type": "application/http; msgtype=response"}
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if keep is not None:
        fields |= {"WARC-Refers-To": f"<{name(keep)}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
        return [_record("revisit", name(page_id), fields, head)]
    block = head + chunked(payload)
    if len(block) <= segment_bytes:
        return [_record("response", name(page_id), fields, block)]
    out = [_record("response", name(page_id), fields | {"WARC-Segment-Number": 1}, block[:segment_bytes])]
    for n, at in enumerate(range(segment_bytes, len(block), segment_bytes), 2):
        more = {"WARC-Segment-Origin-ID": f"<{name(page_id)}>", "WARC-Segment-Number": n,
                "WARC-Segment-Total-Length": len(block) if at + segment_bytes >= len(block) else None}
        out.append(_record("continuation", f"{name(page_id)}:{n}", more, block[at:at + segment_bytes]))
    return out


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE,
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html", compression: str = "none") -> None:
    """Writes the pages as WARC files under ``path`` (``compression``: none or gzip, of whole files)."""
    payload = F.coalesce(pages[html_col], F.lit("")).cast("binary")
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"), payload.alias("payload"),
                        F.sha1(payload).alias("sha1"))
    equal = materialize(rows.groupBy("sha1").agg(F.max("page_id").alias("keep"), F.count("*").alias("n"))
                        .where("n > 1 and keep is not null").select("sha1", "keep"), "payloads")
    rows = checked_join(rows, equal, "sha1", "left").select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("keep")), F.col("keep")).alias("keep"))

    def write(batches):
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                found += records_of(row["page_id"], row["url"], row["payload"], row["keep"], segment_bytes)
                if len(found) >= 256:
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["record"])
                    found = []
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["record"])

    (rows.mapInArrow(write, "record binary").select(F.col("record").cast("string"))
     .write.option("lineSep", "\r\n\r\n").option("compression", compression).option("maxRecordsPerFile", records_per_file).text(path))


def parse(data: bytes):
    """(fields by lower-case name, block) of each record of an archive.  ValueError if it is cut off."""
    at = 0
    while at < len(data):
        end = data.index(EOL + EOL, at)
        head = data[at:end].decode().split("\r\n")
        if not head[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head[1:])}
        at = end + 4
        size = int(fields["content-length"])
        if len(data) < at + size + 4 or data[at + size:at + size + 4] != EOL + EOL:
            raise ValueError(f"record of {size} bytes at byte {at} does not end there")
        yield fields, data[at:at + size]
        at += size + 4


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record under ``path``, segments apart."""
    schema = pa.schema([("record_id", pa.string()), ("warc_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
                        ("payload_digest", pa.string()), ("segment_number", pa.int32()), ("origin_id", pa.string()), ("total_length", pa.int64()), ("block", pa.binary())])

    def read(batches):
        for batch in batches:
            for data in batch.column("content"):
                data = data.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows, held = [], 0
                for f, block in parse(data):
                    got = lambda k: f[k].strip("<>") if k in f else None  # noqa: B023, E731
                    num = lambda k: int(f[k]) if k in f else None  # noqa: B023, E731
                    rows.append((got("warc-record-id"), f.get("warc-type"), got("warc-target-uri"), got("warc-refers-to"), f.get("warc-payload-digest"),
                                 num("warc-segment-number"), got("warc-segment-origin-id"), num("warc-segment-total-length"), block))
                    held += len(block)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(read, RECORD)


LOGICAL = "record_id string, warc_type string, target_uri string, refers_to string, payload_digest string, n_segments int, complete boolean, block binary"


def reassemble(records: DataFrame) -> DataFrame:
    """One row per logical record: segments grouped by origin, ordered by number, joined and held against the total length."""
    whole = records.where("segment_number is null and origin_id is null").select(
        "record_id", "warc_type", "target_uri", "refers_to", "payload_digest", F.lit(1).alias("n_segments"), F.lit(True).alias("complete"), "block")
    part = F.struct("segment_number", "warc_type", "target_uri", "refers_to", "payload_digest", "total_length", "block")
    groups = (records.where("segment_number is not null or origin_id is not null")
              .groupBy(F.coalesce("origin_id", "record_id").alias("record_id")).agg(F.collect_list(part).alias("parts")))

    def join(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                by = defaultdict(list)
                for p in row["parts"]:
                    by[p["segment_number"]].append(p)
                n = max(k or 0 for k in by)
                copies = min(Counter(p["segment_number"] for p in row["parts"]).values())  # of a record written more than once
                total = {p["total_length"] for p in by.get(n, [])}
                whole = sorted(k or 0 for k in by) == list(range(1, n + 1)) and all(len({(p["block"], p["total_length"]) for p in ps}) == 1 for ps in by.values())
                block = b"".join(by[k][0]["block"] for k in range(1, n + 1)) if whole else b""
                whole = whole and total == {len(block)}
                first = by[1][0] if 1 in by else {"warc_type": None, "target_uri": None, "refers_to": None, "payload_digest": None}
                rows += copies * [(row["record_id"], first["warc_type"], first["target_uri"], first["refers_to"], first["payload_digest"], len(by), whole, block if whole else None)]
            types = [pa.string()] * 5 + [pa.int32(), pa.bool_(), pa.binary()]
            cols = list(zip(*rows, strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             ["record_id", "warc_type", "target_uri", "refers_to", "payload_digest", "n_segments", "complete", "block"])

    return whole.unionByName(groups.mapInArrow(join, LOGICAL))


def payloads(logical: DataFrame) -> DataFrame:
    """Adds the decoded ``payload`` of responses (null with ``complete`` false where the framing or the stated digest is broken)."""
    names = [c.split()[0] for c in LOGICAL.split(", ")]

    def decode(batches):
        for batch in batches:
            out, fine = [], []
            for kind, ok, block, stated in zip(*(batch.column(c).to_pylist() for c in ("warc_type", "complete", "block", "payload_digest")), strict=True):
                payload = None
                if ok and kind == "response":
                    try:
                        payload = http_payload(block)
                        ok = stated in (None, f"sha1:{digest(payload)}")
                    except ValueError:
                        ok = False
                out.append(payload if ok else None)
                fine.append(ok)
            cols = [pa.array(fine, pa.bool_()) if c == "complete" else batch.column(c) for c in names[:-1]]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(out, pa.binary())], [*names[:-1], "payload"])

    return logical.mapInArrow(decode, LOGICAL.replace("block binary", "payload binary"))


def page_report(spark: SparkSession, path: str) -> DataFrame:
    """Per record read back: page_id, payload_bytes, payload_digest, record_type, refers_to, complete.  Revisits have them of the response they refer to."""

    def digests(batches):
        for batch in batches:
            kept = [c for c in batch.schema.names if c != "payload"]
            got = batch.column("payload").to_pylist()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array([None if p is None else len(p) for p in got], pa.int64()),
                                              pa.array([None if p is None else digest(p) for p in got], pa.string())], [*kept, "payload_bytes", "digest"])

    narrow = LOGICAL.replace("block binary", "payload_bytes long, digest string")
    read = payloads(reassemble(read_records(spark, path))).mapInArrow(digests, narrow)
    read = materialize(read.select("record_id", "warc_type", "refers_to", "complete", "payload_bytes", "digest"), "warc-records")
    page = lambda c: F.split(c, ":")[2].try_cast("long")
    shown = lambda df: df.select(page(F.col("record_id")).alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
                                 F.col("warc_type").alias("record_type"), page(F.col("refers_to")).alias("refers_to"), "complete")
    revisits = read.where("warc_type = 'revisit'").select("record_id", "warc_type", "refers_to", "complete")
    wanted = revisits.select(F.col("refers_to").alias("record_id")).distinct()
    found = (read.where("warc_type = 'response'").join(wanted, "record_id", "left_semi").groupBy(F.col("record_id").alias("refers_to"))
             .agg(F.max("payload_bytes").alias("payload_bytes"), F.max("digest").alias("digest")))
    return shown(read.where("warc_type = 'response'")).unionByName(shown(revisits.join(found, "refers_to", "left")))


def op1_warc(spark, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    write_archives(load(spark, sf_dir, "pages"), path)
    return page_report(spark, path).drop("complete")


#: Base32 from the hex digest: five hex digits are four characters.
OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, strlen(h) AS n, sha1(h) AS s FROM p),
d AS (SELECT *, list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(s, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), 'string_agg', '') AS b FROM x),
k AS (SELECT s, max(page_id) AS keep FROM d GROUP BY s)
SELECT page_id, n::BIGINT AS payload_bytes, b AS payload_digest, CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = keep THEN NULL ELSE keep END AS refers_to
FROM d JOIN k USING (s)
"""
