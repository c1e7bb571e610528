"""WARC archives of pages: a writer with revisit records, and a reader that salvages damaged files.

An archive is a chain of gzip members, one a record. The reader takes such archives and plain
ones. Where a check fails (inflating, the member's own checksum, the headers, the length, the
end of the record, the payload's digest) it looks for the next member or version line that
holds a sound record, goes on there, and reports the bytes between as a gap.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, stored, table

# Payloads below this many bytes are written each time.
LEAST_BYTES = 100
# Payloads of more than one in so many rows are looked up by broadcast; there are no more of them than this.
HOT_SHARE = 1000
DATE = "2024-01-01T00:00:00Z"
_FEED = 1 << 16

# Fixed values of the formats.
GZIP = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
END = b"\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REPEATABLE = "warc-concurrent-to"
_URN = "urn:x-page:"


def _member(raw: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(raw) + c.flush()


# Stands between records: Spark's text writer ends each row with it, and gzip readers see nothing.
EMPTY_MEMBER = _member(b"")


def _one_line(text: str | None) -> str:
    """A header value: control characters and spaces as percent codes."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text or "")


def record(page: str | None, url: str | None, payload: bytes, digest: str, refers: str | None, revisit: bool) -> bytes:
    """One record. A revisit holds the HTTP headers of the response alone, with its length."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload)) + END
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <{_URN}{_one_line(page)}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {_one_line(url)}", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <{_URN}{_one_line(refers)}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + END + block + END


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("page", "url", "payload", "digest", "refers", "revisit")
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            part = batch.slice(lo, 200)
            rows = zip(*(part.column(part.schema.get_field_index(n)).to_pylist() for n in names), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([_member(record(*r)) for r in rows], pa.binary())], ["member"])


def _addressed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    return pages.select(F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> None:
    """Write one record a row to gzip archives below `folder`, one archive a task.

    Of rows whose payloads are equal and have LEAST_BYTES or more, those of the smallest id are
    responses and the others revisit it; shorter payloads are all responses. Null html is an
    empty payload; a null id counts as greater than all, and rows without any id under one
    payload are all responses. Repeated rows are records of their own.

    Only digests and ids are grouped. A payload of a thousandth of all rows or more is looked
    up by broadcast (at most HOT_SHARE of them), and its rows, as those of short payloads, are
    dealt evenly over the tasks. Spark's text writer commits the files, so a task that runs
    again leaves one copy of its records.
    """
    rows = _addressed(pages, id_col, url_col, html_col)
    long = F.octet_length("payload") >= LEAST_BYTES
    firsts = stored(rows.where(long).groupBy("digest").agg(
        F.min("page").alias("first"), F.count(F.lit(1)).alias("times")))
    total = firsts.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    hot = F.col("times") * HOT_SHARE >= F.lit(total)
    again = firsts.where("times > 1").select("digest", "first", "times")
    common = again.where(hot).select("digest", F.col("first").alias("hot_first"), F.lit(True).alias("hot"))
    other = again.where(~hot).select("digest", "first", F.lit(0).cast("long").alias("deal"))
    dealt = F.coalesce("hot", F.lit(False)) | ~long
    known = rows.join(F.broadcast(common), "digest", "left").withColumn(
        "deal", F.when(dealt, 1 + F.monotonically_increasing_id()).otherwise(F.lit(0).cast("long")))
    refers = F.coalesce("hot_first", "first")
    found = known.join(other, ["digest", "deal"], "left").select(
        F.col("page").cast("string").alias("page"), "url", "payload", "digest",
        refers.cast("string").alias("refers"),
        (refers.isNotNull() & ~refers.eqNullSafe(F.col("page"))).alias("revisit"))
    (
        found.mapInArrow(_members, "member binary").select(F.col("member").cast("string").alias("value"))
        .write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
        .option("compression", "none").text(folder)
    )


class Unsound(Exception):
    """Why bytes are no record."""


@dataclass
class Record:
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""

    def payload(self) -> bytes:
        if "application/http" not in self.headers.get("content-type", ""):
            return self.block
        at = self.block.find(END)
        return self.block[at + 4:] if at >= 0 else b""

    def announced(self) -> int | None:
        """Length of the payload by the HTTP headers; a revisit has no other."""
        for line in self.block[:max(0, self.block.find(END))].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length" and value.strip().isdigit():
                return int(value)
        return None


def _framed(data, at: int) -> tuple[Record, int]:
    """The record at `at` and where it ends; Unsound if its frame does not hold."""
    if data[at:at + len(VERSION)] != VERSION:
        raise Unsound("no version line")
    body = data.find(END, at)
    if body < 0:
        raise Unsound("headers do not end")
    lines = data[at:body].decode("utf-8", "replace").split("\r\n")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Unsound("header without a colon")
        name = name.strip().lower()
        if name in headers and name != REPEATABLE:
            # Cut within its headers, a record would else pass off those of the next one as its own.
            raise Unsound("header occurs twice")
        headers[name] = value.strip()
    size = headers.get("content-length", "")
    if not (size.isascii() and size.isdigit()) or "warc-type" not in headers:
        raise Unsound("no length or type")
    body += len(END)
    end = body + int(size)
    if data[end:end + len(END)] != END:
        raise Unsound("record does not end where it says")
    return Record(headers, data[body:end]), end + len(END)


def _verified(r: Record) -> Record:
    said = r.headers.get("warc-payload-digest", "")
    if said.startswith("sha256:") and r.headers["warc-type"] != "revisit":
        if hashlib.sha256(r.payload()).hexdigest() != said[7:].lower():
            raise Unsound("payload has another digest")
    return r


def _inflated(data: bytes, at: int) -> tuple[bytes, int]:
    """The member at `at` and where it ends; Unsound if it does not inflate or misses its checksum."""
    inflate, parts, view = zlib.decompressobj(31), [], memoryview(data)
    try:
        while not inflate.eof:
            if at >= len(data):
                raise Unsound("member is cut off")
            parts.append(inflate.decompress(view[at:at + _FEED]))
            at += min(_FEED, len(data) - at)
    except zlib.error as e:
        raise Unsound("member does not inflate") from e
    return b"".join(parts), at - len(inflate.unused_data)


def _unit(data: bytes, at: int) -> tuple[list[Record | str], int]:
    """Records (or why there is none) of the member or plain record at `at`, and where it ends."""
    if data[at:at + len(GZIP)] != GZIP:
        r, end = _framed(data, at)
        try:
            return [_verified(r)], end
        except Unsound as e:
            return [str(e)], end
    raw, end = _inflated(data, at)
    found: list[Record | str] = []
    inner = 0
    while inner < len(raw):
        try:
            r, inner = _framed(raw, inner)
        except Unsound as e:
            if not found and not raw.startswith(VERSION):
                raise
            found.append(str(e))
            break
        try:
            found.append(_verified(r))
        except Unsound as e:
            found.append(str(e))
    return found, end


def _next(data: bytes, at: int) -> tuple[int, tuple[list[Record | str], int] | None]:
    """The next place from `at` on where a member or version line starts something sound."""
    member, line = data.find(GZIP, at), data.find(VERSION, at)
    while member >= 0 or line >= 0:
        here = min(x for x in (member, line) if x >= 0)
        try:
            return here, _unit(data, here)
        except Unsound:
            pass
        if here == member:
            member = data.find(GZIP, here + 1)
        else:
            line = data.find(VERSION, here + 1)
    return len(data), None


def salvage(data: bytes) -> Iterator[tuple[int, int, Record | str]]:
    """(start, end, record) of every sound record, (start, end, reason) of every gap, in order.

    Every byte is in one of them, or in an empty member, or shares its member's range.
    """
    at = 0
    while at < len(data):
        try:
            found, end = _unit(data, at)
        except Unsound as e:
            here, unit = _next(data, at + 1)
            yield at, here, str(e)
            if unit is None:
                return
            at, (found, end) = here, unit
        for r in found:
            yield at, end, r
        at = end


READ = ("archive string, start long, end long, gap string, record_type string, record_id string, target_uri string, "
        "refers_to string, payload_digest string, payload_bytes long, payload binary")


def _bare(uri: str | None) -> str | None:
    return uri[1:-1] if uri and uri.startswith("<") and uri.endswith(">") else uri


def _row(archive: str, start: int, end: int, r: Record | str, with_payload: bool) -> tuple:
    if isinstance(r, str):
        return (archive, start, end, r, *[None] * 7)
    h, payload = r.headers, r.payload()
    revisit = h["warc-type"] == "revisit"
    said = h.get("warc-payload-digest", "")
    digest = said[7:].lower() if revisit and said.startswith("sha256:") else hashlib.sha256(payload).hexdigest()
    return (archive, start, end, None, h["warc-type"], _bare(h.get("warc-record-id")), h.get("warc-target-uri"),
            _bare(h.get("warc-refers-to")), digest, r.announced() if revisit else len(payload),
            payload if with_payload and not revisit else None)


def read_archives(spark: SparkSession, path: str, payloads: bool = True, files: str = "*") -> DataFrame:
    """The records and gaps of all archives that `files` matches below `path`.

    A row with `gap` null is a record: type, ids, digest and length of the full payload (of a
    revisit, those its headers state), and the payload itself unless `payloads` is False; a
    revisit has none. A row with `gap` is a stretch of bytes that holds no sound record, with
    the first check that failed. start and end are offsets in the file, of the whole member.

    An archive is read by one task, which holds it whole (the writer's are as large as the
    input of one of its tasks); its records leave in batches. An empty file has no rows.
    """
    whole = spark.read.format("binaryFile").option("pathGlobFilter", files).load(path).select("path", "content")
    types = [f.dataType for f in spark.createDataFrame([], READ).schema.fields]
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([(name.split()[0], to_arrow_type(t)) for name, t in zip(READ.split(", "), types, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, size = [], 0
                for start, end, r in salvage(content.as_py()):
                    rows.append(_row(archive.as_py(), start, end, r, payloads))
                    size += len(rows[-1][-1] or b"")
                    if len(rows) >= 1000 or size > 1 << 24:
                        yield _batch(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, schema)

    return whole.mapInArrow(run, READ)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def log_gaps(read: DataFrame, path: str) -> int:
    """Write the gaps of a reading as JSON lines; returns how many bytes they hold."""
    gaps = read.where(F.col("gap").isNotNull()).select("archive", "start", "end", "gap")
    gaps.write.mode("overwrite").json(path)
    written = read.sparkSession.read.schema(gaps.schema).json(path)
    return written.distinct().agg(F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0))).first()[0]


def op11_warc(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = shared_folder(spark)
    write_archives(pages, folder)
    read = stored(read_archives(spark, folder, payloads=False, files="part-*"))
    lost = log_gaps(read, f"{folder}-gaps")
    if lost:
        raise ValueError(f"{lost} bytes of the archives in {folder} hold no sound record; see {folder}-gaps")
    kind = dict(pages.dtypes)["page_id"]

    def page(uri: str):
        bare = F.substring(F.col(uri), len(_URN) + 1, 1 << 30)
        return F.when(bare != "", bare).cast(kind)

    return read.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       page("refers_to").alias("refers_to"))


ORACLE_OP11 = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST_BYTES} AND first IS DISTINCT FROM page_id AND first IS NOT NULL
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_BYTES} AND first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f"""
