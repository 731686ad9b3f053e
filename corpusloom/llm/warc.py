"""WARC archives: writing with revisit records, and a splittable reader.

Writing. Payloads are addressed by SHA-1; of equal ones of LEAST_REVISIT bytes or more
the row with the largest id is a response, the others are revisits without a body. The
largest id of a digest comes from a partial aggregate and is joined back on the digest,
where AQE splits a hot one. Each task writes one archive of gzip members, one a record.

Reading. The archives' byte ranges are dealt to tasks. A task looks for gzip's magic
bytes in its range; a candidate is a record if the member decodes, begins with a WARC
header and ends where another such member begins or the file ends. A task owns the
records that start inside its range, and reads past its end to finish the last one.

Defined results: a null payload is empty; rows of one id and one payload that tie for
the largest id are all responses; a null id never is the one referred to unless all
are null; an empty table writes no archive and gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import scratch, table, written
from corpusloom.sources.files import filesystem, replacing

LEAST_REVISIT = 1000
SPLIT = 8 << 20
WINDOW = 1 << 18
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member."""
    name = "null" if page_id is None else page_id
    uri = "".join(c if c.isprintable() and c != " " else "%" + c.encode().hex() for c in url or "about:blank")
    head = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{'null' if refers_to is None else refers_to}>", f"WARC-Profile: {REVISIT}"]
    body = b"" if revisit else payload
    head += ["Content-Type: text/html", f"Content-Length: {len(body)}"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + z.flush()


def _write(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        path, size, rows = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz", 0, 0
        batches = (b for b in batches if b.num_rows)
        if (batch := next(batches, None)) is None:
            return
        with replacing(path) as out:
            while batch is not None:
                for page_id, url, payload, digest, last in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "last"))):
                    page_id, payload, last = page_id.as_py(), payload.as_py(), last.as_py()
                    revisit = len(payload) >= LEAST_REVISIT and page_id != last
                    member = record(page_id, url.as_py(), payload, digest.as_py(), last, revisit)
                    out.write(member)
                    size, rows = size + len(member), rows + 1
                batch = next(batches, None)
        yield pa.RecordBatch.from_pylist([{"path": path, "bytes": size, "records": rows}])

    return write


def write_warc(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html") -> list[dict]:
    """Write the archives; their path, bytes and records."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("payload")).withColumn("digest", F.sha1("payload"))
    # small payloads are all responses and need no partner
    last = rows.where(F.length("payload") >= LEAST_REVISIT).groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = rows.join(last, "digest", "left").withColumn("last", F.coalesce("last", "page_id"))
    files = joined.select("page_id", "url", "payload", "digest", "last").mapInArrow(_write(folder), "path string, bytes long, records long").collect()  # one row a task
    return sorted((r.asDict() for r in files), key=lambda r: r["path"])


class _Source:
    """Reads of one archive at any place, a window at a time."""

    def __init__(self, path: str):
        store, name = filesystem(path)
        self.file = store.open_input_file(name)
        self.size = self.file.size()

    def read(self, at: int, n: int = WINDOW) -> bytes:
        return self.file.read_at(max(0, min(n, self.size - at)), at)


def member(source: _Source, at: int, most: int | None = None) -> tuple[bytes, int] | None:
    """(content, end) of the gzip member that starts here; None if there is none.

    most: stop as soon as so many bytes are decoded; the end is then not known (-1).
    """
    z, out, size, here = zlib.decompressobj(31), [], 0, at
    while not z.eof:
        data = source.read(here)
        if not data:
            return None
        try:
            out.append(z.decompress(data))
        except zlib.error:
            return None
        size += len(out[-1])
        if size >= len(VERSION) and not b"".join(out[:2])[: len(VERSION)].startswith(b"WARC/1."):
            return None
        here += len(data)
        if most is not None and size >= most and not z.eof:
            return b"".join(out), -1
    return b"".join(out), here - len(z.unused_data)


def parsed(content: bytes) -> tuple[dict[str, str], bytes] | None:
    """(headers by lower-case name, body), or None if this is no whole record."""
    head, found, rest = content.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/1."):
        return None
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    length = headers.get("content-length", "")
    if not length.isdigit() or "warc-type" not in headers or len(rest) < int(length):
        return None
    return headers, rest[: int(length)]


def _begins(source: _Source, at: int) -> bool:
    """Whether the file ends here or a member with a WARC header begins."""
    if at >= source.size:
        return True
    return source.read(at, 3) == MAGIC and member(source, at, 1 << 10) is not None


def candidates(source: _Source, start: int, end: int) -> Iterator[int]:
    """Places of gzip's magic in [start, end)."""
    at = start
    while at < end:
        data = source.read(at, min(WINDOW, end - at) + len(MAGIC) - 1)
        place = data.find(MAGIC)
        while 0 <= place and at + place < end:
            yield at + place
            place = data.find(MAGIC, place + 1)
        at += max(1, len(data) - len(MAGIC) + 1)


def records(path: str, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, body) of the records that start in [start, end)."""
    source, known = _Source(path), start == 0
    at = start
    while at < min(end, source.size):
        if not known:  # find the next start; from there each member's end is the next one's
            at = next((c for c in candidates(source, at, end) if (m := member(source, c)) and parsed(m[0]) and _begins(source, m[1])), None)
            if at is None:
                return
            known = True
        found = member(source, at)
        record_ = found and parsed(found[0])
        if not record_:
            known, at = False, at + 1
            continue
        yield at, *record_
        at = found[1]


def _page(uri: str | None) -> int | None:
    name = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return None if name in ("", "null") else int(name)


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, path string, offset long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            rows = []
            for offset, h, body in records(r["path"], r["start"], r["end"]):
                kind, digest = h["warc-type"], h["warc-payload-digest"].removeprefix("sha1:")
                if kind == "response" and hashlib.sha1(body).hexdigest() != digest:
                    raise ValueError(f"{r['path']} at {offset}: the payload is not what its digest says")
                size = len(body) if kind == "response" else int(h["x-payload-length"])
                rows.append((_page(h["warc-record-id"]), size, digest, kind, _page(h.get("warc-refers-to")), r["path"], offset))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in READ.split(", ")])


def read_warc(spark, files: list[dict], split: int = SPLIT) -> DataFrame:
    """READ: one row for each record of the archives (path and bytes of each)."""
    n = sum(-(-f["bytes"] // split) for f in files)
    listed = spark.createDataFrame([(f["path"], f["bytes"]) for f in files if f["bytes"]], "path string, bytes long")
    starts = listed.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split).cast("long"))).alias("start"))
    dealt = starts.select("path", "start", (F.col("start") + split).alias("end")).repartition(max(1, min(n, 10_000)))
    return dealt.mapInArrow(_read, READ)


def read_whole(spark, files: list[dict], split: int = SPLIT) -> DataFrame:
    """read_warc of archives whose number of records is known; an error if some of them
    could not be read, as of a damaged member only its own record is lost."""
    out = written(read_warc(spark, files, split), "warc-records")
    want, got = sum(f["records"] for f in files), out.count()
    if got != want:
        raise ValueError(f"{got} records read of {want} written")
    return out


def op4_splittable_warc(spark, sf_dir):
    files = write_warc(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return read_whole(spark, files).drop("path", "offset")
