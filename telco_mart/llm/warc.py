"""WARC archives: one gzip member per record, and a splittable reader.

Writing: payloads of at least ``minimum`` bytes are grouped by SHA-256; the
smallest id of a group becomes a response, the others are revisits that refer
to it. Tasks build the gzip members; Spark's text writer stores them through its
commit protocol on any file system, so a lost executor leaves no half file. That
writer ends every row with a separator: members are given to it without their
last byte, which is the high byte of the length field, and this byte is the
separator (members under 16 MB end in a zero byte; longer ones are written apart
by their last byte, up to 2 GB).

Reading: Spark's line reader, with the gzip magic as the line separator, scans
byte ranges of the files: each task owns the members whose magic starts in its
range. Every piece between two magics is a candidate: it is a record if it
decompresses to the end with the right checksum and its header starts with
``WARC/``. The magic can also occur by chance inside compressed data, which cuts
a member in two; such pieces (a few per 100 MB) are gathered per file, in order,
and joined until the member is whole. Pieces that never become whole are
returned as damaged rows (null id, ``error`` set); stray bytes after the end of
a whole member are passed over.

Inputs: a null payload is empty; a null url is written as an empty target; a
null id as an empty one and reads back as null; rows that repeat the smallest id
of a group are all responses. Empty tables give an archive without records.
Only the id, url and payload columns are read.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

MAGIC = b"\x1f\x8b\x08"
DATE = "2000-01-01T00:00:00Z"


def plan_records(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", minimum: int = 100) -> DataFrame:
    """(id, url, payload, digest, refers_to): refers_to is null for responses.
    Group minima are a map-side aggregate; copies in very large groups are
    spread again by the join (skewed partitions are split at run time)."""
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.length("payload") >= minimum).select("id", "digest")
    first = large.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    refers = large.join(first, "digest").filter("first < id or id is null").select(F.col("id").alias("rid"), F.col("digest").alias("rdigest"), "first").distinct()
    on = F.col("id").eqNullSafe(F.col("rid")) & (F.col("digest") == F.col("rdigest"))
    return rows.join(refers, on, "left").select("id", "url", "payload", "digest", F.col("first").alias("refers_to"))


def record(rid, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP header, not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    target = (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if rid is None else rid}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def length(text: str) -> int | None:
    """A Content-Length; null if it is no number."""
    return int(text) if text.isascii() and text.isdigit() and len(text) < 19 else None


def parse(data: bytes) -> dict | None:
    """Header fields and body of a decompressed record; null if it isn't one."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not sep or not lines[0].startswith("WARC/"):
        return None
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    size = length(fields.get("content-length", ""))
    if size is None or rest[size:] != b"\r\n\r\n":
        return None
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    fields["http"] = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("utf-8", "replace").split("\r\n")[1:])}
    fields["payload"] = payload
    return fields


def write(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", minimum: int = 100) -> list[str]:
    """Write one record per row below ``path``; returns the folders written."""

    def members(batches):
        for b in batches:
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                out = [gzip.compress(record(*r), 6, mtime=0) for r in zip(*(c.to_pylist() for c in part.columns))]
                yield pa.RecordBatch.from_arrays([pa.array([m[-1] for m in out], pa.int32()), pa.array([m[:-1] for m in out], pa.binary())], names=["last", "body"])

    planned = plan_records(df, id_col, url_col, payload_col, minimum)
    made = written(planned.mapInArrow(members, "last int, body binary"), "members")
    folders = []
    for (last,) in sorted(made.select("last").distinct().collect()):  # one number per 16 MB of record length
        folders.append(f"{path}/members-{last:03d}")
        made.filter(F.col("last") == last).select(F.expr("cast(body as string)").alias("value")).write.option("lineSep", chr(last)).text(folders[-1])
    return folders


def _inflate(piece: bytes) -> tuple[bytes | None, str]:
    """(data, '') of one whole member that holds a record; else (None, why):
    'start' if a record begins but the member does not end, 'open' if it is cut
    before it shows what it holds, 'bad' if it is no member."""
    d = zlib.decompressobj(31)
    try:
        data = d.decompress(piece)
    except zlib.error:
        return None, "bad"
    if not d.eof:
        return None, "open" if len(data) < 5 else "start" if data.startswith(b"WARC/") else "bad"
    return (data, "") if data.startswith(b"WARC/") else (None, "bad")


COLUMNS = "record_type string, id string, url string, payload binary, payload_bytes long, payload_digest string, refers_to string, error string"


def _row(data: bytes, payloads: bool) -> tuple:
    f = parse(data)
    if f is None:
        return (None,) * 7 + ("no WARC record",)
    name = lambda x: x.removeprefix("<urn:page:").removesuffix(">") or None
    kind, digest = f.get("warc-type"), f.get("warc-payload-digest", "").removeprefix("sha256:")
    url = f.get("warc-target-uri", "").replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    payload = f["payload"] if kind == "response" else None
    size = len(payload) if payload is not None else length(f["http"].get("content-length", "0"))
    bad = "digest differs" if payload is not None and hashlib.sha256(payload).hexdigest() != digest else None if size is not None else "no payload length"
    refers_to = name(f["warc-refers-to"]) if "warc-refers-to" in f else None
    return kind, name(f.get("warc-record-id", "")), url, payload if payloads else None, size, digest, refers_to, bad


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string()]
    names = [c.split(" ")[0] for c in COLUMNS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows) if rows else [[]] * 8, kinds)], names=names)


def candidates(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(file, block, seq, piece): what lies between two gzip magics; ``block``
    is the start of the byte range whose task owns it, ``seq`` its order there."""
    lines = spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(folders)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").cast("binary").alias("piece"),
    )


def read(spark: SparkSession, folders: list[str], payloads: bool = True) -> DataFrame:
    """One row per record of the archives, digests and lengths of responses
    checked against their payloads. Without ``payloads`` the payload column is
    null, and the payloads are not written to the shared folder in between."""
    if not folders:
        return spark.createDataFrame([], COLUMNS)
    schema = f"{COLUMNS}, file string, block long, seq long, piece binary"
    empty = [pa.nulls(0, t) for t in (pa.string(), pa.int64(), pa.int64(), pa.binary())]

    def whole(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                rows, rest = [], []
                for file, block, seq, piece in zip(*(c.to_pylist() for c in part.columns)):
                    if piece:  # nothing lies before a file's first magic
                        data, _ = _inflate(MAGIC + piece)
                        rows.append(_row(data, payloads) + (None,) * 4) if data is not None else rest.append((None,) * 8 + (file, block, seq, piece))
                rows += rest
                if rows:
                    cols = list(zip(*rows))
                    base = _batch([r[:8] for r in rows])
                    yield pa.RecordBatch.from_arrays([*base.columns, *(pa.array(list(c), e.type) for c, e in zip(cols[8:], empty))], names=[*base.schema.names, "file", "block", "seq", "piece"])

    def join(key: tuple, t: pa.Table) -> pa.Table:
        """Adjacent pieces that are no whole member, joined in order; each is
        inflated once, as it comes."""
        rows, member, out = [], None, []
        for piece in t.sort_by([("block", "ascending"), ("seq", "ascending")]).column("piece"):
            piece = MAGIC + piece.as_py()
            alone = _inflate(piece)[1]
            if member is not None and alone != "start":
                try:
                    out.append(member.decompress(piece))
                except zlib.error:
                    rows.append((None,) * 7 + ("cut record",))
                    member, out = None, []
                else:
                    if member.eof:
                        rows.append(_row(b"".join(out), payloads))
                        member, out = None, []
                continue
            if member is not None or alone == "bad":
                rows.append((None,) * 7 + ("cut record" if member is not None else "no gzip member",))
            member, out = (None, []) if alone == "bad" else (zlib.decompressobj(31), [])
            if member is not None:
                out.append(member.decompress(piece))
        if member is not None:
            rows.append((None,) * 7 + ("cut record",))
        return pa.Table.from_batches([_batch(rows)])

    found = written(candidates(spark, folders).mapInArrow(whole, schema), "records")
    good = found.filter("piece is null").drop("file", "block", "seq", "piece")
    # pieces are joined run by run: within a block, a gap between their numbers is a whole member
    loose = found.filter("piece is not null").select("file", "block", "seq", "piece")
    order = Window.partitionBy("file").orderBy("block", "seq")  # places only, no payloads
    apart = (F.col("block") == F.lag("block").over(order)) & (F.col("seq") > F.lag("seq").over(order) + 1)
    places = loose.select("file", "block", "seq", F.coalesce(apart, F.lit(False)).cast("int").alias("apart"))
    runs = places.select("file", "block", "seq", F.sum("apart").over(order).alias("run"))
    stitched = loose.join(runs, ["file", "block", "seq"]).groupBy("file", "run").applyInArrow(join, COLUMNS)
    return good.unionByName(stitched)
