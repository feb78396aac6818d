"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Reader. An archive starts with a skippable frame (magic 0x184D2A5D) that holds a dictionary, itself a Zstandard frame
or not; an archive without one has no dictionary. Other skippable frames are passed over. Every other frame is one
record: its header's version and fields, its Content-Length and what follows it are checked, and a fault raises
ValueError with the byte at which the frame starts.

Writer. Each task writes one archive with a dictionary trained on its own first records (DICTIONARY_RECORDS at most).
Archives go through Spark's writer of text: a row is a frame, and the line separator is an empty skippable frame, so
the file is an archive that any Zstandard reader takes. The commit of that writer keeps one copy of each task's output.

Repeated payloads. Of records with equal payloads of at least 100 bytes, those of the smallest page_id are responses;
others are revisits, which hold the HTTP header alone and name the response's record.

Defined cases. A null html is an empty payload; a null url is an empty target. A null page_id gives a record whose id
is empty; it never is the one that others refer to, and is a revisit where its payload has one. Rows that repeat the
smallest page_id are all responses. An empty table gives no rows. Other columns are not read. Payloads of any length
are whole records; a record must fit a Python worker's memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import new_folder, small_batches

# Fixed values of the two formats.
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
EMPTY_FRAME = "\x50\x2a\x4d\x18\x00\x00\x00\x00"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Of equal payloads shorter than this none is a revisit.
LEAST_REPEAT = 100
DICTIONARY_RECORDS, DICTIONARY_BYTES = 256, 32 * 1024
#: An equal date for all records makes archives of equal rows equal.
DATE = "2024-01-01T00:00:00Z"


def _id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One uncompressed record; with refers_to a revisit."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        block += payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", " ".join((url or "").split())),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", _id(refers_to)), ("WARC-Profile", PROFILE)]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def dictionary_frame(samples: list[bytes]) -> tuple[bytes, zstandard.ZstdCompressionDict | None]:
    """The leading skippable frame and its dictionary; nothing where the samples are too few to train one."""
    if sum(map(len, samples)) < 8 * 1024 or len(samples) < 8:
        return b"", None
    try:
        trained = zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8), samples)
    except zstandard.ZstdError:
        return b"", None
    body = zstandard.ZstdCompressor().compress(trained.as_bytes())
    return DICTIONARY_MAGIC + len(body).to_bytes(4, "little") + body, trained


def frame_end(data: bytes, at: int) -> int:
    """Where the frame that starts at `at` ends, from its header and block lengths."""

    def need(n: int) -> None:
        if n > len(data):
            raise ValueError(f"the frame at byte {at} is cut off")

    need(at + 8)
    if data[at + 1 : at + 4] == b"\x2a\x4d\x18" and data[at] >> 4 == 5:
        end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
        need(end)
        return end
    if data[at : at + 4] != FRAME_MAGIC:
        raise ValueError(f"no frame starts at byte {at}")
    flags = data[at + 4]
    single, checksum = flags >> 5 & 1, flags >> 2 & 1
    content = (1 if single else 0, 2, 4, 8)[flags >> 6]
    place = at + 5 + (not single) + (0, 1, 2, 4)[flags & 3] + content
    while True:
        need(place + 3)
        head = int.from_bytes(data[place : place + 3], "little")
        kind, size = head >> 1 & 3, head >> 3
        if kind == 3:
            raise ValueError(f"the frame at byte {at} holds a block of no known kind")
        place += 3 + (1 if kind == 1 else size)
        if head & 1:
            place += 4 * checksum
            need(place)
            return place


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of a record; ValueError where it isn't a whole valid one."""
    head, blank, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not blank or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError(f"the record at byte {at} has no WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError(f"the record at byte {at} has a header line without a colon")
        fields[name.strip().lower().decode()] = value.strip().decode()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"the record at byte {at} has no {name}")
    if not fields["content-length"].isdigit() or len(rest) != (size := int(fields["content-length"])) + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"the record at byte {at} isn't as long as it says")
    return fields, rest[:size]


def read_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an archive, in order."""
    at, known = 0, None
    if data[:4] == DICTIONARY_MAGIC:
        at = frame_end(data, 0)
        body = data[8:at]
        if body[:4] == FRAME_MAGIC:
            body = zstandard.ZstdDecompressor().decompress(body, max_output_size=1 << 27)
        known = zstandard.ZstdCompressionDict(body)
    reader = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    while at < len(data):
        end = frame_end(data, at)
        if data[at : at + 4] == FRAME_MAGIC:
            try:
                raw = reader.decompressobj().decompress(data[at:end])
            except zstandard.ZstdError as e:
                raise ValueError(f"the frame at byte {at} can't be decoded: {e}") from e
            yield parse(raw, at)
        at = end


def decided(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, html, digest of the payload, and refers_to for revisits."""
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("bytes"))
    same = rows.where(F.col("bytes") >= LEAST_REPEAT).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
    joined = rows.join(same.where("n > 1").select("digest", "first"), "digest", "left")
    later = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", "digest", F.when(later, F.col("first")).alias("refers_to"))


def write(pages: DataFrame, path: str) -> None:
    """Archives of pages below path, one per task."""
    small_batches(pages.sparkSession)

    def frames(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for part in parts:
            rows = zip(*(part.column(k).to_pylist() for k in range(5)), strict=True)
            records = [record(p, u, (h or "").encode(), d, r) for p, u, h, d, r in rows]
            out = []
            if writer is None and records:
                frame, known = dictionary_frame(records[:DICTIONARY_RECORDS])
                out += [frame] * bool(frame)
                writer = zstandard.ZstdCompressor(level=6, dict_data=known, write_checksum=True)
            out += [writer.compress(r) for r in records]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    made = decided(pages).mapInArrow(frames, "frame binary")
    # a cast keeps the bytes as they are, and the text writer puts them out unchanged
    made.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below path: page_id, record_type, url, payload_bytes, payload_digest, refers_to, payload.

    payload_bytes and payload_digest are of the full payload; those of a response are taken from the payload itself
    and must agree with the header's, a revisit (payload null) has those of its header.
    """

    def page_of(name: str) -> int | None:
        text = name.removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    def records(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path, data in zip(part["path"], part["content"], strict=True):
                rows, held = [], 0
                for fields, block in read_archive(data):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    digest = fields["warc-payload-digest"].removeprefix("sha256:")
                    revisit = fields["warc-type"] == "revisit"
                    if not revisit:
                        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{path}: the payload of {fields['warc-record-id']} isn't what its header says")
                    rows.append((page_of(fields["warc-record-id"]), fields["warc-type"], fields.get("warc-target-uri"), size, digest, page_of(fields["warc-refers-to"]) if revisit else None, None if revisit else payload.decode()))
                    held += len(payload)
                    if held > 4_000_000:
                        yield frame(rows)
                        rows, held = [], 0
                yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["page_id", "record_type", "url", "payload_bytes", "payload_digest", "refers_to", "payload"])
        return out.astype({"page_id": "Int64", "payload_bytes": "int64", "refers_to": "Int64"})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(records, "page_id long, record_type string, url string, payload_bytes long, payload_digest string, refers_to long, payload string")


def archive(pages: DataFrame) -> DataFrame:
    """Write pages to archives in the shared folder and read them back, payloads and all."""
    path = new_folder(pages.sparkSession, "warc")
    write(pages, path)
    return read(pages.sparkSession, path)


def sql() -> str:
    """The same over a table pages with unique page_id, as SQL for DuckDB."""
    return f"""
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as n, sha256(coalesce(html, '')) as d from pages
), f as (
  select d, min(page_id) as first from p where n >= {LEAST_REPEAT} group by d
)
select page_id, cast(n as bigint) as payload_bytes, p.d as payload_digest,
  case when first is null or first = page_id then 'response' else 'revisit' end as record_type,
  case when first <> page_id then first end as refers_to
from p left join f on p.d = f.d
"""
