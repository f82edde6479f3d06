"""Web archives as seekable Zstandard bundles.

Records are grouped into Zstandard frames of about ``FRAME`` plain bytes, each of which decodes alone, and all frames of a
bundle are followed by a seek table: a skippable frame that lists the sizes of all frames. An index maps the ids of
records to their bundle, frame and offset within the frame, so a record is read by decoding its frame and no other.

A bundle is a cell of a table in the folder all executors share, since only Spark's writers reach every store;
``bundle_files`` puts bundles into files where the folder is one that Arrow can open.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm import texts as X
from newsloom.session import stored

# Payload bytes of a bundle; a larger record is a bundle of its own.
BUNDLE = 1 << 24
# Plain bytes that the records of a frame have together; a larger record is a frame of its own.
FRAME = 1 << 18

# Fixed values of the seekable format: the skippable frame's number, the footer's number.
_SKIPPABLE = 0x184D2A5E
_FOOTER = 0x8F92EAB1
_DATE = "1970-01-01T00:00:00Z"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """The SHA-1 digest in upper-case base 32: each five hexadecimal digits are four letters."""
    digest = F.sha1(data)
    number = lambda i: F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
    letter = lambda n, shift: F.substr(F.lit(_ALPHABET), F.shiftright(n, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1))
    return F.concat(*(letter(number(i), shift) for i in range(8) for shift in (15, 10, 5, 0)))


def records_of(pages: DataFrame, id_column: str, payload: str, url: str) -> DataFrame:
    """Rows (page_id, url, payload, payload_bytes, payload_digest, second) of a table of pages."""
    data = F.encode(F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"),
        F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")).alias("url"),
        data.alias("payload"),
    )
    rows = rows.withColumn("payload_bytes", F.length("payload").cast("long"))
    return rows.withColumn("payload_digest", base32_sha1(F.col("payload"))).withColumn("second", F.xxhash64("payload"))


def _record(kind: str, page: int | None, url: str, digest: str, payload: bytes, refers: int | None) -> bytes:
    """One record; a revisit has no payload of its own."""
    name = "" if page is None else str(page)
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {' '.join(url.split())}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
    ]
    body = payload
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        body = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame that ends a bundle: sizes of each frame, packed and plain, and a footer."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, _FOOTER)
    return struct.pack("<II", _SKIPPABLE, len(body)) + body


def read_seek_table(bundle: bytes) -> np.ndarray:
    """For each frame: where it starts in the bundle, its packed size, and its plain size."""
    n, _, magic = struct.unpack("<IBI", bundle[-9:])
    start = len(bundle) - 9 - 8 * n
    number, size = struct.unpack("<II", bundle[start - 8 : start])
    if magic != _FOOTER or number != _SKIPPABLE or size != 8 * n + 9:
        raise ValueError("no seek table")
    sizes = np.frombuffer(bundle[start : len(bundle) - 9], "<u4").reshape(n, 2).astype(np.int64)
    return np.column_stack((np.cumsum(sizes[:, 0]) - sizes[:, 0], sizes))


def _bundle(level: int, size: int, frame: int):
    """Records of this task as bundles, each with the frames and offsets of its records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=level, write_content_size=True)
        parts, frames, index, open_, held = [], [], [], bytearray(), 0
        number = TaskContext.get().partitionId() << 32

        def close_frame() -> None:
            if open_:
                parts.append(packer.compress(bytes(open_)))
                frames.append((len(parts[-1]), len(open_)))
                open_.clear()

        def close() -> pa.RecordBatch:
            nonlocal parts, frames, index, held, number
            close_frame()
            ids, at, offsets, lengths = zip(*index, strict=True)
            out = pa.record_batch(
                {
                    "number": pa.array([number], pa.int64()),
                    "bundle": pa.array([b"".join(parts) + seek_table(frames)], pa.binary()),
                    "ids": pa.array([ids], pa.list_(pa.int64())),
                    "frames": pa.array([at], pa.list_(pa.int32())),
                    "offsets": pa.array([offsets], pa.list_(pa.int64())),
                    "lengths": pa.array([lengths], pa.list_(pa.int64())),
                }
            )
            parts, frames, index, held, number = [], [], [], 0, number + 1
            return out

        for batch in X.slices(batches, "payload"):
            for row in batch.to_pylist():
                record = _record(row["record_type"], row["page_id"], row["url"], row["payload_digest"], row["payload"], row["refers_to"])
                if len(open_) + len(record) > frame:
                    close_frame()
                index.append((row["page_id"], len(frames), len(open_), len(record)))
                open_ += record
                held += len(record)
                if held >= size:
                    yield close()
        if index:
            yield close()

    return run


def write_bundles(records: DataFrame, level: int = 3, size: int = BUNDLE, frame: int = FRAME) -> DataFrame:
    """Write records to bundles in the shared folder, and return the stored table.

    Rows (number, bundle, ids, frames, offsets, lengths): the archive, and for each of its records the id, the frame, and
    the place in that frame. ``frame`` is the plain size up to which records share a frame; with 0 each has its own.
    """
    schema = "number long, bundle binary, ids array<long>, frames array<int>, offsets array<long>, lengths array<long>"
    return stored(records.mapInArrow(_bundle(level, size, frame), schema), "bundles")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (of lower-case names) and body of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no record")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


def read_frame(bundle: bytes, table: np.ndarray, frame: int) -> bytes:
    """The plain bytes of one frame; no other is decoded."""
    import zstandard

    start, packed, size = table[frame].tolist()
    return zstandard.ZstdDecompressor().decompress(bundle[start : start + packed], max_output_size=size)


def record_index(bundles: DataFrame) -> DataFrame:
    """Rows (page_id, number, frame, offset, length), one per record, stored in the order of ids apart from the archives."""
    places = F.explode(F.arrays_zip("ids", "frames", "offsets", "lengths")).alias("r")
    rows = bundles.select("number", places).select(
        F.col("r.ids").alias("page_id"), "number", F.col("r.frames").alias("frame"), F.col("r.offsets").alias("offset"), F.col("r.lengths").alias("length")
    )
    return stored(rows.repartitionByRange("page_id", "number", "frame", "offset").sortWithinPartitions("page_id"), "index")


def find_records(bundles: DataFrame, index: DataFrame, ids: DataFrame, id_column: str = "page_id") -> DataFrame:
    """The records of some ids, in the columns of ``read_bundles``.

    The index tells the places of each id; bundles without any are not read further than their number, and of the
    others only the frames that hold a wanted record are decoded. Ids without a record give no row, a repeated id or
    one of several records gives each record once.
    """
    wanted = ids.select(F.col(f"`{id_column}`").cast("long").alias("of")).where("of is not null").distinct()
    places = index.join(wanted, index["page_id"] == wanted["of"]).groupBy("number").agg(F.sort_array(F.collect_list(F.struct("frame", "offset", "length", "page_id"))).alias("p"))
    some = bundles.select("number", "bundle").join(places, "number").select(
        "bundle", F.col("p.page_id").alias("ids"), F.col("p.frame").alias("frames"), F.col("p.offset").alias("offsets"), F.col("p.length").alias("lengths")
    )
    return read_bundles(some)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every record of each bundle, found by its frame and offset."""
    import base64
    import hashlib

    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    number = lambda s: int(s[10:-1]) if len(s) > 11 else None
    for batch in batches:
        for i in range(batch.num_rows):
            bundle = X.column(batch, "bundle")[i].as_buffer().to_pybytes()
            table, rows, last, plain = read_seek_table(bundle), [], -1, b""
            cells = (X.column(batch, c)[i].as_py() for c in ("ids", "frames", "offsets", "lengths"))
            for page, frame, offset, length in zip(*cells, strict=True):
                if frame != last:
                    last, plain = frame, read_frame(bundle, table, frame)
                fields, body = parse_record(plain[offset : offset + length])
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                if number(fields["warc-record-id"]) != page:
                    raise ValueError(f"record {page} is not where the index says")
                kind = fields["warc-type"]
                if kind == "response" and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                    raise ValueError(f"record {page} is damaged")
                refers = number(fields["warc-refers-to"]) if kind == "revisit" else None
                rows.append((page, int(fields["x-payload-length"]), digest, kind, refers, fields["warc-target-uri"], None if kind == "revisit" else body))
            yield pa.record_batch({n: pa.array(c, k) for n, k, c in zip(names, kinds, zip(*rows, strict=True), strict=True)})


def read_bundles(bundles: DataFrame) -> DataFrame:
    """Rows (page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload), one per record.

    Each record is looked up through the seek table, and its payload is held against its digest. A revisit has no
    payload of its own.
    """
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
    return bundles.mapInArrow(_read, schema)


def archive_pages(
    pages: DataFrame, id_column: str = "page_id", payload: str = "html", url: str = "url", least: int = 0
) -> DataFrame:
    """Write ``pages`` to bundles and return them.

    A null or empty payload has no bytes; a null url is empty. Of equal payloads, the record of largest id is the
    response; rows that repeat that id are all responses. A record with a null id is a response. An empty table gives
    no bundle. Other columns are not read.
    """
    rows = records_of(pages, id_column, payload, url)
    same = ["payload_bytes", "payload_digest", "second"]
    # Digests and ids are shuffled to find equal payloads, not the payloads; largest ids are combined before.
    keys = stored(rows.select("page_id", *same).where(F.col("payload_bytes") >= least), "digests")
    last = keys.groupBy(*same).agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1 and response is not null")
    last = stored(last.drop("n"), "repeated")
    revisits = keys.join(last, same).where("page_id != response").select(F.col("page_id").alias("of"), F.col("payload_digest").alias("what"), "response")
    revisits = revisits.distinct()
    joined = rows.join(revisits, (rows["page_id"] == revisits["of"]) & (rows["payload_digest"] == revisits["what"]), "left")
    kind = F.when(F.col("response").isNull(), "response").otherwise("revisit")
    return write_bundles(joined.select("page_id", "url", "payload", "payload_digest", kind.alias("record_type"), F.col("response").alias("refers_to")))


def bundle_files(bundles: DataFrame, folder: str) -> DataFrame:
    """Write each bundle to a file of its own in ``folder`` (a URI that Arrow can open on every executor).

    Rows (name, bytes). A file's name is the digest of its content, so a repeated task writes the same file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for cell in X.column(batch, "bundle"):
                data = cell.as_buffer().to_pybytes()
                name = f"{hashlib.sha256(data).hexdigest()}.warc.zst"
                with store.open_output_stream(f"{base}/{name}") as out:
                    out.write(data)
                yield pa.record_batch({"name": pa.array([name]), "bytes": pa.array([len(data)], pa.int64())})

    return bundles.select("bundle").mapInArrow(run, "name string, bytes long")


WARC_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, octet_length(body)::BIGINT AS payload_bytes,
         list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hex, (i // 4 * 5 + 1)::INTEGER, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1, 1)), 'string_agg', '') AS payload_digest,
         max(page_id) OVER (PARTITION BY body) AS last
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM d
"""
