"""WARC archives of web pages: writer and salvage reader.

Writer: one record per page, each a gzip member of its own.  Of records with
equal payloads of at least ``min_bytes`` bytes, the one with the smallest
page_id is a ``response``; the others are ``revisit`` records that refer to
it and carry no payload.  Spark's text writer commits the files (the members
are raw bytes, separated by empty gzip members), so a failed or repeated
task leaves no half-written archive and any Hadoop file system will do.

Reader: checks every record (gzip CRC, lengths, block and payload digests).
After a failed check it goes to the next valid gzip member or version line
and goes on; what lies between is logged as a quarantined byte gap.  Inside a
member it searches likewise, also in what could be inflated of a damaged one
(there, only records with a block digest count).  A
record whose frame is whole but whose digest is wrong is skipped as a whole,
so text inside its payload cannot pass for a record.

Scale: payload digests are combined map-side; the join that marks revisits
is on the digest against one row per repeated digest, and adaptive execution
splits a hot digest.  A task reads one archive file at a time; the writer's
files are as large as its shuffle partitions.

Defined results: null html is an empty payload; payloads under ``min_bytes``
are all responses; a null page_id sorts after all others and has no id
header; repeated rows of the smallest page_id are all responses; an empty
table gives no records; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT_BYTES = 100
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_MAGIC, _VERSION, _END = b"\x1f\x8b\x08", b"WARC/1.", b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member, the same bytes in every run."""
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


EMPTY_MEMBER = member(b"")


def marked(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, html, digest, bytes, refers_to``: ``refers_to`` is the
    response's page_id for revisits, else null."""
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumns({"digest": F.sha2(F.encode("html", "UTF-8"), 256),
                       "bytes": F.octet_length("html").cast("long")})
    first = (p.where(F.col("bytes") >= min_bytes).groupBy(F.col("digest").alias("_d"))
             .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    p = p.join(first, p["digest"] == first["_d"], "left")
    other = F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(F.col("page_id"))
    return p.select("page_id", "url", "html", "digest", "bytes", F.when(other, F.col("_first")).alias("refers_to"))


def record(page_id: int | None, url: str | None, html: str, digest: str, size: int,
           refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the HTTP head but no payload."""
    block = HTTP_HEAD if refers_to is not None else HTTP_HEAD + html.encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {size}",
            f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(
            r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url))
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + _END + block + _END


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Writes the pages as gzip WARC files under ``path`` (an action)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                rows = b.slice(k, 256).to_pylist()
                out = [member(record(r["page_id"], r["url"], r["html"], r["digest"], r["bytes"], r["refers_to"]))
                       for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    (marked(pages, min_bytes).mapInArrow(run, "member binary")
     .select(F.col("member").cast("string").alias("value")).write
     .option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1"))
     .option("compression", "none").text(path))


class Broken(ValueError):
    """A failed check; ``end`` is where the damaged record's frame ends, if it is whole."""

    def __init__(self, why: str, end: int | None = None):
        super().__init__(why)
        self.end = end


def parse_record(data: bytes, at: int) -> tuple[dict, int]:
    """The record whose version line starts at ``at`` and the offset behind it."""
    if not data.startswith(_VERSION, at):
        raise Broken("no version line")
    stop = data.find(_END, at)
    if stop < 0 or data.find(b"\n" + _VERSION, at, stop) >= 0:
        raise Broken("header does not end")
    fields = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Broken("header line without a colon")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", length):
        raise Broken("no content length")
    start, end = stop + 4, stop + 4 + int(length)
    if data[end:end + 4] != _END:
        raise Broken("block does not end where its length says")
    block, end = data[start:end], end + 4
    want = fields.get("warc-block-digest")
    if want and want != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise Broken("block digest differs", end)
    head = block.find(_END) if "http" in fields.get("content-type", "") else -4
    payload = block[head + 4:] if head != -1 else block
    digest = "sha256:" + hashlib.sha256(payload).hexdigest()
    if fields.get("warc-type") != "revisit":
        if fields.get("warc-payload-digest", digest) != digest:
            raise Broken("payload digest differs", end)
        fields["warc-payload-digest"], fields["warc-payload-length"] = digest, str(len(payload))
    return {"fields": fields, "payload": payload}, end


def _inflated(data: bytes, at: int, step: int = 1 << 16) -> tuple[bytes, int, str | None]:
    """The content of the gzip member at ``at``, as far as it can be inflated,
    the offset behind what was read for it, and what is wrong with the member."""
    begin, d, out = at, zlib.decompressobj(31), []
    try:
        while not d.eof and at < len(data):
            out.append(d.decompress(data[at:at + step]))
            at += step
    except zlib.error as e:
        # once more, the last step byte by byte, for what comes before the error
        d = zlib.decompressobj(31)
        for k in range(begin, at, step):
            d.decompress(data[k:k + step])
        try:
            while at < len(data):
                out.append(d.decompress(data[at:at + 1]))
                at += 1
        except zlib.error:
            pass
        return b"".join(out), at, f"gzip: {e}"
    return b"".join(out), min(at, len(data)) - len(d.unused_data), None if d.eof else "gzip: member does not end"


def _inner(content: bytes, sound: bool) -> list[tuple[str, int, int, dict | str]]:
    """Like :func:`salvage`, of the content of one member.  If the member is
    not ``sound``, only a block digest can vouch for a record."""
    out, at, gap, why = [], 0, None, ""
    while at < len(content):
        try:
            rec, end = parse_record(content, at)
            if not sound and "warc-block-digest" not in rec["fields"]:
                raise Broken("no block digest in a damaged member", end)
        except Broken as e:
            if gap is None:
                gap, why = at, str(e)
            at = content.find(_VERSION, at + 1 if e.end is None else e.end)
            at = len(content) if at < 0 else at
            continue
        if gap is not None:
            out.append(("gap", gap, at, why))
            gap = None
        out.append(("record", at, end, rec))
        at = end
    if gap is not None:
        out.append(("gap", gap, len(content), why))
    return out


def salvage(data: bytes) -> Iterator[tuple[str, int, int, dict | str]]:
    """("record", start, end, record) and ("gap", start, end, reason) over a
    whole archive, gzip members and plain records in any mixture.  Offsets are
    those of the archive (for a record in a member, the member's); the reason
    of a gap inside a member has the offsets in its content."""
    at, gap, why = 0, None, ""
    seen, until = set(), 0  # block digests of records from a damaged member, and its end
    while at < len(data):
        fault, after = None, at + 1
        if data.startswith(_MAGIC, at):
            content, end, fault = _inflated(data, at)
            found = _inner(content, fault is None)
            good = [x for kind, _, _, x in found if kind == "record"]
            holes = [f"{x} (bytes {a} to {b} of the member's content)" for kind, a, b, x in found if kind == "gap"]
            if fault is not None and good:
                seen, until = {rec["fields"]["warc-block-digest"] for rec in good}, end
                fault = "; ".join([f"{fault}, behind byte {len(content)} of the member's content", *holes])
            elif fault is None:
                after = end
                if holes and not good:
                    fault = found[0][3]
        else:
            good, holes = [], []
            try:
                rec, end = parse_record(data, at)
                if at < until and rec["fields"].get("warc-block-digest") in seen:
                    at = end  # stored uncompressed in the damaged member, and read there
                    continue
                good = [rec]
            except Broken as e:
                fault, after = str(e), after if e.end is None else e.end
        if gap is not None and (fault is None or good):
            yield "gap", gap, at, why
            gap = None
        for rec in good:
            yield "record", at, end, rec
        if fault is None:
            for x in holes:
                yield "gap", at, end, x
            at = end
            continue
        if gap is None:
            gap, why = at, fault
        # a whole member, or a whole frame, is skipped; else search
        spots = [x for x in (data.find(_MAGIC, after), data.find(_VERSION, after)) if x >= 0]
        at = min(spots, default=len(data))
    if gap is not None:
        yield "gap", gap, len(data), why


READ = ("file string, start bigint, end bigint, gap string, record_type string, page_id bigint, url string, "
        "refers_to bigint, payload_digest string, payload_bytes bigint, payload binary")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, and one per quarantined gap (``gap`` is the failed
    check; the other record columns are null).  ``start`` and ``end`` are byte
    offsets in ``file``.  Digest and length are recomputed from the payload of
    responses, and the stated ones of the full payload for revisits."""
    names = [x.split()[0] for x in READ.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(),
             pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def number(value: str | None) -> int | None:
        m = re.fullmatch(r"<urn:page:(-?[0-9]{1,19})>", value or "")
        return int(m.group(1)) if m else None

    def rows(name: str, data: bytes) -> Iterator[list]:
        for kind, start, end, x in salvage(data):
            if kind == "gap":
                yield [name, start, end, x, *[None] * 7]
            else:
                f = x["fields"]
                size = f.get("warc-payload-length", "")
                yield [name, start, end, None, f.get("warc-type"), number(f.get("warc-record-id")),
                       f.get("warc-target-uri"), number(f.get("warc-refers-to")),
                       f.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                       int(size) if size.isdigit() else None, x["payload"]]

    def batch(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)],
                                          names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                out, held = [], 0
                for r in rows(b.column(0)[k].as_py(), b.column(1)[k].as_py()):
                    out.append(r)
                    held += len(r[-1] or b"")
                    if len(out) >= 1000 or held > 1 << 24:
                        yield batch(out)
                        out, held = [], 0
                if out:
                    yield batch(out)

    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "content").mapInArrow(run, READ)


def whole(records: DataFrame) -> DataFrame:
    """The rows of :func:`read_archives`; a gap among them is an error."""
    said = F.concat_ws(" ", F.lit("damaged archive:"), "file", "start", "end", "gap")
    return records.where(F.when(F.col("gap").isNull(), F.lit(True)).otherwise(F.raise_error(said).cast("boolean")))
