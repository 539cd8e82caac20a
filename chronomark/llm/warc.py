"""Operator 5, WARC: archives in ZIP packages, written and read by range.

A package is a ZIP file with two stored members: ``archive/data.warc.gz`` (one gzip member per record) and
``indexes/index.cdx``, a line per record with its place. The reader takes the end of the file, follows the ZIP64 locator
where there is one, parses the central directory, finds the stored members and reads slices of the index, then only the
byte ranges of the records; nothing is extracted. Large packages are dealt over tasks by slices of their index.

Records with equal payloads of ``least`` bytes or more: the one with the least page_id is the response, the others are
revisits that refer to it. Digests are grouped without their payloads, and only repeated ones are joined back.
Packages are written under a task attempt's own name, so a repeated task never harms a package that is in use; the
table of packages names those of the attempts that counted.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomark.llm._common import materialize, open_filesystem, shared_path, slots, table

LEAST_BYTES = 100
#: Repeated digests (some 100 bytes each) that are broadcast at most.
BROADCAST_DIGESTS = 200_000
PACKAGE_BYTES = 64_000_000
SLICE_RECORDS = 2_000
DATE = "2024-01-01T00:00:00Z"

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdx"

# --- records ------------------------------------------------------------------------------------------------------


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def warc_record(page_id: int | None, url: str | None, payload: bytes | None, payload_bytes: int, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC/1.1 response with its payload, or a revisit with the HTTP head only; Content-Length in that head is the payload's."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % payload_bytes
    block = http if revisit else http + (payload or b"")
    target = re.sub(r"[\r\n]", "", url or "") or "urn:x-no-url"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers and payload of one record; raises on lengths that do not add up."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if len(block) != int(fields["content-length"]):
        raise ValueError("a WARC record is shorter than it says")
    http, _, payload = block.partition(b"\r\n\r\n")
    http_fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}
    return {"warc": fields, "http": http_fields, "payload": payload}


# --- ZIP ----------------------------------------------------------------------------------------------------------

_LOCAL, _CENTRAL, _END, _END64, _LOC64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
_MAX32, _MAX16 = 0xFFFFFFFF, 0xFFFF


class StoredZip:
    """Writes stored members one after the other to a stream; ZIP64 fields where sizes ask for them, or always."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.zip64, self.at, self.members = out, zip64, 0, []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, chunks: list[bytes]) -> int:
        """Add a member; returns where its data begin."""
        size, crc = sum(map(len, chunks)), 0
        for c in chunks:
            crc = zlib.crc32(c, crc)
        start, big, raw = self.at, self.zip64 or size >= _MAX32, name.encode()
        extra = struct.pack("<HHQQ", 1, 16, size, size) if big else b""
        self._write(struct.pack("<IHHHHHIIIHH", _LOCAL, 45 if big else 20, 0x800, 0, 0, 0x21, crc, _MAX32 if big else size, _MAX32 if big else size, len(raw), len(extra)) + raw + extra)
        data_at = self.at
        for c in chunks:
            self._write(c)
        self.members.append((raw, crc, size, start))
        return data_at

    def close(self) -> None:
        start = self.at
        for raw, crc, size, at in self.members:
            big = self.zip64 or size >= _MAX32 or at >= _MAX32
            extra = struct.pack("<HHQQQ", 1, 24, size, size, at) if big else b""
            s, a = (_MAX32, _MAX32) if big else (size, at)
            self._write(struct.pack("<IHHHHHHIIIHHHHHII", _CENTRAL, 45, 45 if big else 20, 0x800, 0, 0, 0x21, crc, s, s, len(raw), len(extra), 0, 0, 0, 0, a) + raw + extra)
        size, n = self.at - start, len(self.members)
        if self.zip64 or start >= _MAX32 or n >= _MAX16:
            end = self.at
            self._write(struct.pack("<IQHHIIQQQQ", _END64, 44, 45, 45, 0, 0, n, n, size, start) + struct.pack("<IIQI", _LOC64, 0, end, 1))
            self._write(struct.pack("<IHHHHIIH", _END, 0, 0, _MAX16, _MAX16, _MAX32, _MAX32, 0))
        else:
            self._write(struct.pack("<IHHHHIIH", _END, 0, 0, n, n, size, start, 0))


def zip_members(f, size: int) -> dict[str, tuple[int, int]]:
    """``name → (where the data begin, size)`` of the stored members of a ZIP file that can be read at any offset."""

    def read(at: int, n: int) -> bytes:
        if at < 0 or at + n > size:
            raise ValueError("a ZIP structure lies outside the file")
        return f.read_at(n, at)

    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(struct.pack("<I", _END))
    while end >= 0 and (len(tail) - end < 22 or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(struct.pack("<I", _END), 0, end)
    if end < 0:
        raise ValueError("no end of a central directory")
    n, length, start = struct.unpack_from("<HII", tail, end + 10)
    locator = tail_at + end - 20
    if locator >= 0 and (loc := read(locator, 20))[:4] == struct.pack("<I", _LOC64):
        record = read(struct.unpack_from("<Q", loc, 8)[0], 56)
        if struct.unpack_from("<I", record)[0] != _END64:
            raise ValueError("no ZIP64 end of the central directory where its locator points")
        n, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, at, found = read(start, length), 0, {}
    for _ in range(n):
        sign, _, _, flags, method, _, _, _, packed, plain, n_name, n_extra, n_note, _, _, _, local = struct.unpack_from("<IHHHHHHIIIHHHHHII", directory, at)
        if sign != _CENTRAL:
            raise ValueError("a broken central directory")
        name = directory[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, i = directory[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while i + 4 <= len(extra):
            tag, width = struct.unpack_from("<HH", extra, i)
            if tag == 1:
                wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, i + 4))
                plain = next(wide) if plain == _MAX32 else plain
                packed = next(wide) if packed == _MAX32 else packed
                local = next(wide) if local == _MAX32 else local
            i += 4 + width
        if method == 0 and not flags & 1:
            sign, _, _, _, _, _, _, _, _, local_name, local_extra = struct.unpack("<IHHHHHIIIHH", read(local, 30))
            if sign != _LOCAL:
                raise ValueError("no local header where the directory points")
            found[name] = (local + 30 + local_name + local_extra, plain)
        at += 46 + n_name + n_extra + n_note
    return found


# --- writing ------------------------------------------------------------------------------------------------------


def record_types(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, revisit, refers_to`` per row.

    The digests that occur more than once are found by narrow rows. They are sent to all executors while there are at most
    ``BROADCAST_DIGESTS`` of them, so payloads stay where they are; beyond that payloads are joined with them by a shuffle.
    """
    raw = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    hashed = pages.select(F.col("page_id").cast("long"), "url", raw.alias("payload"), F.sha2(raw, 256).alias("payload_digest"))
    narrow = hashed.where(F.octet_length("payload") >= least).select("page_id", "payload_digest")
    firsts = narrow.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n")
    firsts = materialize(firsts, "repeated-payloads")
    joined = hashed.join(F.broadcast(firsts) if firsts.count() <= BROADCAST_DIGESTS else firsts, "payload_digest", "left")
    revisit = F.coalesce((F.col("page_id").isNull() | (F.col("page_id") != F.col("first"))) & (F.octet_length("payload") >= least) & F.col("first").isNotNull(), F.lit(False))
    return joined.select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to"))


_PACKAGE_DDL = "path string, records long, bytes long"


def write_archives(typed: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES, zip64: bool = False) -> DataFrame:
    """Write the rows of :func:`record_types` as packages in ``folder``; ``(path, records, bytes)`` of each, as a written table."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, base = open_filesystem(folder)
        store.create_dir(base, recursive=True)
        chunks: list[bytes] = []
        lines: list[str] = []
        size = number = 0

        def package() -> pa.RecordBatch:
            name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{number:04d}.zip"
            with store.open_output_stream(f"{base}/{name}") as out:
                z = StoredZip(out, zip64)
                z.add(WARC_MEMBER, chunks)
                z.add(INDEX_MEMBER, ["".join(lines).encode()])
                z.close()
            row = [pa.array([f"{folder}/{name}"]), pa.array([len(lines)], pa.int64()), pa.array([z.at], pa.int64())]
            return pa.RecordBatch.from_arrays(row, names=["path", "records", "bytes"])

        for batch in it:
            for r in batch.to_pylist():
                record = warc_record(r["page_id"], r["url"], r["payload"], r["payload_bytes"], r["payload_digest"], r["refers_to"], r["revisit"])
                packed = gzip.compress(record, 1, mtime=0)
                lines.append(f"{'' if r['page_id'] is None else r['page_id']} {size} {len(packed)}\n")
                chunks.append(packed)
                size += len(packed)
                if size >= package_bytes:
                    yield package()
                    chunks, lines, size, number = [], [], 0, number + 1
        if lines:
            yield package()

    return materialize(typed.mapInArrow(batches, _PACKAGE_DDL), "packages")


# --- reading ------------------------------------------------------------------------------------------------------

_SLICE_DDL = "path string, start long, stop long, lines string"
_PAGE_DDL = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string"


def read_archives(packages: DataFrame, slice_records: int = SLICE_RECORDS) -> DataFrame:
    """``packages(path)`` → a row per record. Only directories, indexes and the records' own ranges are read."""

    def slices(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in it:
            for path in frame["path"]:
                store, name = open_filesystem(path)
                with store.open_input_file(name) as f:
                    members = zip_members(f, f.size())
                    at, size = members[INDEX_MEMBER]
                    lines = f.read_at(size, at).decode().splitlines()
                    data_at = members[WARC_MEMBER][0]
                rows = []
                for i in range(0, len(lines), slice_records):
                    part = lines[i : i + slice_records]
                    spans = [tuple(map(int, x.split(" ")[1:])) for x in (part[0], part[-1])]
                    rows.append((path, data_at + spans[0][0], data_at + sum(spans[1]), "\n".join(part)))
                yield pd.DataFrame(rows, columns=["path", "start", "stop", "lines"])

    def records(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in it:
            for path, start, stop, lines in frame.itertuples(index=False):
                store, name = open_filesystem(path)
                with store.open_input_file(name) as f:
                    raw = f.read_at(stop - start, start)
                places = [tuple(map(int, x.split(" ")[1:])) for x in lines.split("\n")]
                base = places[0][0]
                rows = []
                for at, n in places:
                    r = parse_record(gzip.decompress(raw[at - base : at - base + n]))
                    warc, revisit = r["warc"], r["warc"]["warc-type"] == "revisit"
                    digest = warc["warc-payload-digest"].removeprefix("sha256:")
                    if not revisit and hashlib.sha256(r["payload"]).hexdigest() != digest:
                        raise ValueError(f"a payload in {path} does not match its digest")
                    page, refers = (re.fullmatch(r"<urn:x-page:(-?\d*)>", warc.get(k, "<urn:x-page:>"))[1] for k in ("warc-record-id", "warc-refers-to"))
                    rows.append((int(page) if page else None, warc["warc-target-uri"], warc["warc-type"], int(refers) if refers else None, None if revisit else r["payload"], int(r["http"]["content-length"]), digest))
                out = pd.DataFrame(rows, columns=["page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest"])
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    spark = packages.sparkSession
    found = packages.select("path").repartition(slots(spark)).mapInPandas(slices, _SLICE_DDL)
    return found.repartition(max(slots(spark), -(-(packages.agg(F.coalesce(F.sum("bytes"), F.lit(0))).head()[0]) // 16_000_000))).mapInPandas(records, _PAGE_DDL)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages → packages → pages.

    Null html is an empty payload; a null url is written empty; a null page_id makes a record without a number, which revisits
    but is never referred to while its payload has another. Of repeated rows each is a record: those of the least page_id with
    an equal payload (ties) are responses all, the others revisits. A very long payload is a record of a row's size; an
    empty table gives no packages and no rows; other columns, whatever their names, are ignored.
    """
    packages = write_archives(record_types(table(spark, sf_dir, "pages")), shared_path(spark, "warc"))
    return read_archives(packages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS d FROM p),
f AS (SELECT d, min(page_id) AS first FROM h WHERE n >= 100 GROUP BY d)
SELECT h.page_id, CAST(h.n AS BIGINT) AS payload_bytes, h.d AS payload_digest,
  CASE WHEN f.first IS NOT NULL AND f.first <> h.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first IS NOT NULL AND f.first <> h.page_id THEN f.first END AS refers_to
FROM h LEFT JOIN f ON f.d = h.d AND h.n >= 100
"""
