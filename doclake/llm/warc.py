"""Dictionary-compressed WARC archives.

Each archive is written by one task from its own records: the first
``sample_records`` records (at most ``sample_bytes``) train a Zstandard
dictionary, which is stored in a leading skippable frame; every record is
then one Zstandard frame of its own that refers to it. Records whose payload
an earlier page already has are revisit records. Archives appear in the
shared folder only when whole, under a name that depends on the partition,
so a retried task writes the same file again.

Defined cases: null html counts as empty; null url is written as an empty
target; a null ``page_id`` sorts behind all others and such records are never
referred to; of repeated rows one is the response. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import AtomicFile, open_folder, shared_folder, write_table

# Fixed values of the archive format.
DICT_FRAME_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:x-page:"
CAPTURE_DATE = "2000-01-01T00:00:00Z"
RECORD_COLUMNS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def mark_revisits(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """(rid, page_id, url, html, first): ``first`` is the page_id that this
    record revisits, null for responses.

    The row with the smallest (page_id, rid) of each digest is a partial
    aggregate over narrow rows; it is stored, so the join back has two plain
    shuffles and AQE can split a payload that a third of all pages share.
    """
    t = write_table(pages.select(
        F.monotonically_increasing_id().alias("rid"), "page_id", F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.unhex(F.sha1(F.encode("html", "utf-8")))),
        "warc-pages", compression="zstd")
    order = F.struct(F.col("page_id").isNull().alias("n"), "page_id", "rid")
    groups = (t.filter(F.octet_length("html") >= min_revisit_bytes).groupBy("digest")
              .agg(F.min(order).alias("f"), F.count(F.lit(1)).alias("c")).filter("c > 1 and not f.n"))
    first = write_table(groups.select(F.col("digest").alias("d"), F.col("f.page_id").alias("first"),
                                      F.col("f.rid").alias("first_rid")), "warc-first").hint("merge")
    return (t.join(first, F.col("digest") == F.col("d"), "left")
            .select("rid", "page_id", "url", "html",
                    F.when(F.col("rid") != F.col("first_rid"), F.col("first")).alias("first")))


def record_bytes(page_id: int | None, url: str, payload: bytes, first: int | None) -> bytes:
    """One WARC/1.1 record: a response, or a revisit of page ``first`` without body."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if first is not None else http + payload
    url = "".join(c for c in url if c not in "\r\n")
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}",
            f"WARC-Record-ID: <{ID_PREFIX}{'' if page_id is None else page_id}>", f"WARC-Date: {CAPTURE_DATE}",
            f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if first is not None:
        head += [f"WARC-Refers-To: <{ID_PREFIX}{first}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class ArchiveWriter:
    """One archive: dictionary frame, then a frame per record."""

    def __init__(self, folder: str, name: str, dict_bytes: int, sample_records: int, sample_bytes: int, level: int):
        self.file, self.dict_bytes, self.level = AtomicFile(folder, name), dict_bytes, level
        self.limits, self.held, self.held_bytes = (sample_records, sample_bytes), [], 0
        self.frames = None
        self.records = self.written = self.raw = 0

    def add(self, record: bytes) -> None:
        self.records += 1
        self.raw += len(record)
        if self.frames is not None:
            return self._write(self.frames.compress(record))
        self.held.append(record)
        self.held_bytes += len(record)
        if len(self.held) >= self.limits[0] or self.held_bytes >= self.limits[1]:
            self._start()

    def _write(self, data: bytes) -> None:
        self.written += len(data)
        self.file.write(data)

    def _start(self) -> None:
        import zstandard as zstd
        args = {"level": self.level, "write_checksum": True}
        try:
            d = zstd.train_dictionary(min(self.dict_bytes, max(1024, self.held_bytes // 8)), self.held)
            raw = d.as_bytes()
            self._write(struct.pack("<II", DICT_FRAME_MAGIC, len(raw)) + raw)
            args["dict_data"] = d
        except zstd.ZstdError:  # too few or too short records to train on: no dictionary frame
            pass
        self.frames = zstd.ZstdCompressor(**args)
        for r in self.held:
            self._write(self.frames.compress(r))
        self.held = []

    def close(self) -> tuple[str, int, int, int]:
        if self.frames is None:
            self._start()
        self.file.close()
        return self.file.name, self.records, self.raw, self.written


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = 1 << 28, dict_bytes: int = 112_640,
                   sample_records: int = 4000, sample_bytes: int = 16 << 20, level: int = 3) -> DataFrame:
    """Write ``mark_revisits`` rows; returns (archive, records, raw_bytes, bytes), stored."""

    def task(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        part, n, cur, done = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            for pid, url, html, first in zip(*(batch.column(c).to_pylist()
                                               for c in ("page_id", "url", "html", "first")), strict=True):
                if cur is None:
                    cur = ArchiveWriter(folder, f"pages-{part:06d}-{n:04d}.warc.zst", dict_bytes, sample_records,
                                        sample_bytes, level)
                    n += 1
                cur.add(record_bytes(pid, url, html.encode(), first))
                if cur.raw >= archive_bytes:
                    done.append(cur.close())
                    cur = None
        if cur is not None:
            done.append(cur.close())
        cols = list(zip(*done, strict=True)) if done else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:])],
                                         names=["archive", "records", "raw_bytes", "bytes"])
    return write_table(pages.select("page_id", "url", "html", "first").mapInArrow(
        task, "archive string, records long, raw_bytes long, bytes long"), "warc-archives")


def read_frames(stream) -> Iterator[bytes]:
    """Records of an archive: its dictionary frame is honoured, one frame at a time is decompressed."""
    import zstandard as zstd
    head = stream.read(8)
    dict_data, rest = None, head
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICT_FRAME_MAGIC:
        dict_data, rest = zstd.ZstdCompressionDict(stream.read(struct.unpack("<I", head[4:])[0])), b""
    d = zstd.ZstdDecompressor(dict_data=dict_data) if dict_data else zstd.ZstdDecompressor()
    while True:
        obj, out = d.decompressobj(), io.BytesIO()
        rest = rest or stream.read(1 << 20)
        if not rest:
            return
        while rest:
            out.write(obj.decompress(rest))
            if obj.eof:
                rest = obj.unused_data
                break
            rest = stream.read(1 << 20)
        if not obj.eof:
            raise ValueError("archive ends within a record")
        yield out.getvalue()


def parse_record(rec: bytes) -> tuple:
    """RECORD_COLUMNS of one record; the digest of a response is taken from its payload."""
    head, _, block = rec.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    ident = fields["WARC-Record-ID"].strip("<>").removeprefix(ID_PREFIX)
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    kind = fields["WARC-Type"]
    if kind == "response" and (length != len(payload) or payload_digest(payload) != stated):
        raise ValueError(f"damaged record {ident}")
    refers = fields.get("WARC-Refers-To")
    return (int(ident) if ident else None, length, stated, kind,
            int(refers.strip("<>").removeprefix(ID_PREFIX)) if refers else None)


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """One row per record of the archives, read back from the shared folder."""

    def task(batches: Iterator) -> Iterator:
        import pyarrow as pa
        fs, base = open_folder(folder)
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = [c.split()[0] for c in RECORD_COLUMNS.split(", ")]
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                rows = []
                with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
                    for rec in read_frames(f):
                        rows.append(parse_record(rec))
                        if len(rows) >= 10_000:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
    # one archive is the unit of reading: deal them out by number, so no task gets many
    return archives.select("archive").repartition(max(1, min(archives.count(), 4096))).mapInArrow(task, RECORD_COLUMNS)


def op2_warc(spark, sf_dir: str) -> DataFrame:
    """Query: write all pages to archives, then read the archives back."""
    folder = shared_folder(spark, "warc")
    pages = mark_revisits(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read_archives(write_archives(pages, folder), folder)


ORACLE_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS f FROM pages),
x AS (SELECT *, sha1(h) AS hex FROM p)
SELECT page_id, CAST(octet_length(h) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((CAST('0x' || substr(hex, (i // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
    CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = f THEN NULL ELSE f END AS refers_to
FROM x
"""
