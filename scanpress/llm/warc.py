"""Operator 5, seekable Zstandard WARC bundles.

Every row becomes a WARC/1.1 record.  Records are grouped into frames of about
``frame_bytes``, each an independent Zstandard frame; a bundle is the frames
followed by the seek table of the public Zstandard seekable format (a
skippable frame whose footer ends in ``0x8F92EAB1``), so a reader finds any
frame without decompressing the ones before it.  The index, an ordinary
Parquet table, maps record ids to (bundle, frame, first byte in the frame,
bytes).  Bundle names are unique per attempt and only bundles named in the
index count, so a repeated task leaves at most an unreferenced file.

Of records with equal payloads of at least ``min_revisit`` bytes the one with
the largest id is the ``response``, the others are ``revisit`` records that
refer to it and hold no payload.  Equality is decided on (SHA-1, length) of the
payload: only those narrow rows are shuffled, with a map-side maximum per
digest, so a payload shared by a third of all rows is one row per task.

Defined results: a null payload counts as empty; a null URL leaves
the target header out; a null id never is the response while another id has
the payload; rows that repeat id and payload get the same type; an empty table
gives an empty index; extra columns are ignored.  Memory: one frame and one
Arrow batch.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanpress.llm.common import file_system, materialize, qualified_uri

# Fixed values of the public Zstandard seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES = 1 << 20
MIN_REVISIT = 1000
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, bundle string, frame int, first int, n_bytes int, record_type string"


# ---------------------------------------------------------------- records


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(urn: str) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def warc_record(
    page_id: int | None, url: str | None, payload: bytes, sha1_hex: str, refers_to: int | None, revisit: bool, date: str
) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to) if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, position after the record) of the record at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        msg = f"no WARC record at {at}"
        raise ValueError(msg)
    headers = dict(line.split(": ", 1) for line in lines[1:])
    first = end + 4
    stop = first + int(headers["Content-Length"])
    return headers, data[first:stop], stop + 4


def payload_facts(headers: dict[str, str], block: bytes) -> tuple[int, str]:
    """(bytes, SHA-1 hex) of the full payload; a response's digest is taken anew and must meet its header."""
    http, _, body = block.partition(b"\r\n\r\n")
    n = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n", 1)[0])
    stated = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if headers["WARC-Type"] == "response" and (len(body) != n or hashlib.sha1(body).hexdigest() != stated):  # noqa: S324
        msg = f"damaged record {headers['WARC-Record-ID']}"
        raise ValueError(msg)
    return n, stated


# ---------------------------------------------------------------- bundles


class BundleWriter:
    """Frames of whole records, then the seek table."""

    def __init__(self, stream, frame_bytes: int, level: int) -> None:
        import zstandard

        self.stream, self.frame_bytes = stream, frame_bytes
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.frame, self.filled, self.table = [], 0, []

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, first byte in it) of the record."""
        place = (len(self.table), self.filled)
        self.frame.append(record)
        self.filled += len(record)
        if self.filled >= self.frame_bytes:
            self._flush()
        return place

    def _flush(self) -> None:
        packed = self.compress(b"".join(self.frame))
        self.stream.write(packed)
        self.table.append(struct.pack("<II", len(packed), self.filled))
        self.frame, self.filled = [], 0

    def close(self) -> None:
        if self.frame:
            self._flush()
        body = b"".join(self.table) + struct.pack("<IBI", len(self.table), 0, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)
        self.stream.close()


class BundleReader:
    def __init__(self, source) -> None:
        import zstandard

        self.file = source
        self.decompress = zstandard.ZstdDecompressor().decompress
        size = source.size()
        n, descriptor, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC:
            msg = "no seek table"
            raise ValueError(msg)
        entry = 12 if descriptor & 0x80 else 8
        table = source.read_at(n * entry, size - 9 - n * entry)
        self.sizes = [struct.unpack_from("<II", table, k * entry) for k in range(n)]
        self.firsts = [0]
        for packed, _ in self.sizes:
            self.firsts.append(self.firsts[-1] + packed)

    def frame(self, k: int) -> bytes:
        packed, full = self.sizes[k]
        return self.decompress(self.file.read_at(packed, self.firsts[k]), max_output_size=full)


# ---------------------------------------------------------------- Spark side


def _with_revisits(df: DataFrame, id_col: str, payload_col: str, url_col: str | None, min_revisit: int) -> DataFrame:
    """page_id, url, payload, sha1, refers_to (null: a response)."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = df.select(
        F.col(id_col).cast("long").alias("page_id"),
        (F.col(url_col) if url_col else F.lit(None)).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("sha1"),
        F.octet_length(payload).alias("n"),
    )
    large = materialize(rows.filter(F.col("n") >= min_revisit).select("sha1", "n", "page_id"), "payload-digests")
    kept = large.groupBy("sha1", "n").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
    kept = kept.filter((F.col("copies") > 1) & F.col("refers_to").isNotNull()).drop("copies")
    revisits = (
        large.join(kept, ["sha1", "n"])
        .filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select(F.col("page_id").alias("r_id"), F.col("sha1").alias("r_sha1"), "refers_to")
        .distinct()
    )
    on = rows["page_id"].eqNullSafe(revisits["r_id"]) & (rows["sha1"] == revisits["r_sha1"])
    return rows.join(revisits, on, "left").select("page_id", "url", "payload", "sha1", "refers_to")


def write_warc(
    df: DataFrame,
    path: str,
    id_col: str = "page_id",
    payload_col: str = "html",
    url_col: str | None = "url",
    min_revisit: int = MIN_REVISIT,
    frame_bytes: int = FRAME_BYTES,
    level: int = 3,
    date: str = DATE,
) -> DataFrame:
    """Write bundles under ``path``, one per task, and return the record index (stored beside them)."""
    spark = df.sparkSession
    uri = qualified_uri(spark, path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, root = file_system(uri)
        name = f"bundle-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
        writer = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                fs.create_dir(root, recursive=True)
                writer = BundleWriter(fs.open_output_stream(f"{root}/{name}", compression=None), frame_bytes, level)
                info = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {date}\r\n"
                writer.add(f"{info}Content-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n".encode())
            places, sizes, kinds = [], [], []
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "sha1", "refers_to")]
            for values in zip(*columns, strict=True):
                page, url, payload, sha1, refers = (v.as_py() for v in values)
                record = warc_record(page, url, payload.encode(), sha1, refers, refers is not None, date)
                places.append(writer.add(record))
                sizes.append(len(record))
                kinds.append("response" if refers is None else "revisit")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    pa.array([name] * len(sizes), pa.string()),
                    pa.array([f for f, _ in places], pa.int32()),
                    pa.array([a for _, a in places], pa.int32()),
                    pa.array(sizes, pa.int32()),
                    pa.array(kinds, pa.string()),
                ],
                names=["page_id", "bundle", "frame", "first", "n_bytes", "record_type"],
            )
        if writer is not None:
            writer.close()  # before the task ends: Spark keeps its index rows only then

    rows = _with_revisits(df, id_col, payload_col, url_col, min_revisit)
    rows.mapInArrow(write, INDEX).write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


FACTS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


READ_BYTES = 64 << 20


def read_tasks(index: DataFrame, read_bytes: int = READ_BYTES) -> int:
    """Tasks that read the indexed records, about ``read_bytes`` of records each.

    Counted from the records' bytes: the index rows that are dealt out say nothing of them, so the number is fixed and
    adaptive execution, which would merge tasks by the index's own bytes, leaves it.
    """
    total = index.agg(F.sum(F.col("n_bytes").cast("long"))).first()[0] or 0
    return max(index.sparkSession.sparkContext.defaultParallelism, -(-total // read_bytes))


def read_warc(index: DataFrame, path: str, read_bytes: int = READ_BYTES) -> DataFrame:
    """Every record of the indexed bundles, read frame by frame through the seek tables."""
    uri = qualified_uri(index.sparkSession, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(uri)
        name, reader = None, None
        for batch in batches:
            for bundle, frame in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bundle != name:
                    name, reader = bundle, BundleReader(fs.open_input_file(f"{root}/{bundle}"))
                data, at, rows = reader.frame(frame), 0, []
                while at < len(data):
                    headers, block, at = parse_record(data, at)
                    if headers["WARC-Type"] == "warcinfo":
                        continue
                    n, sha1 = payload_facts(headers, block)
                    refers = headers.get("WARC-Refers-To")
                    rows.append(
                        (_page_of(headers["WARC-Record-ID"]), n, sha1, headers["WARC-Type"], refers and _page_of(refers))
                    )
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                columns = zip(*rows, strict=True) if rows else [[]] * len(types)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )

    frames = index.select("bundle", "frame").distinct().repartition(read_tasks(index, read_bytes), "bundle", "frame").sortWithinPartitions("bundle", "frame")
    return frames.mapInArrow(read, FACTS)


def fetch_records(index: DataFrame, path: str) -> DataFrame:
    """Single records by their index rows (page_id, record binary): one seek and one frame each."""
    uri = qualified_uri(index.sparkSession, path)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(uri)
        readers: dict[str, BundleReader] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["bundle"] not in readers:
                    readers = {row["bundle"]: BundleReader(fs.open_input_file(f"{root}/{row['bundle']}"))}
                data = readers[row["bundle"]].frame(row["frame"])[row["first"] : row["first"] + row["n_bytes"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["page_id"]], pa.int64()), pa.array([data], pa.binary())], names=["page_id", "record"]
                )

    return index.mapInArrow(fetch, "page_id long, record binary")
