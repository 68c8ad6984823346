"""WARC archives as seekable Zstandard bundles.

Each partition writes its records into bundles. A bundle is a sequence of independent Zstandard
frames of some records each, closed by a skippable frame with the seek table of the published
seekable format (compressed and decompressed size of each frame), so any Zstandard reader can read
it whole and a reader with the table can read one frame. The index maps a record to its bundle,
frame and offset within the frame. Of records with equal payloads the one with the smallest id is
the response; the others are revisits that refer to it and carry no payload.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.llm.common import attach, cut, fits, qualified, shared_dir, slices

# Fixed values of the seekable format: magic numbers of the skippable frame and of its footer.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit has the digest and length of its payload, but not the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    body = b"" if revisit else payload
    clean = " ".join((url or "").split())
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if clean:
        lines.append(f"WARC-Target-URI: {clean}")
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(frame: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, body) of the records of a decompressed frame."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        headers = dict(line.split(": ", 1) for line in frame[at:end].decode().split("\r\n")[1:])
        n = int(headers["Content-Length"])
        yield at, headers, frame[end + 4 : end + 4 + n]
        at = end + 4 + n + 4


class Bundle:
    """Writes one bundle to a stream, frame by frame."""

    def __init__(self, out: pa.NativeFile) -> None:
        self.out, self.frames, self.buffer, self.size = out, [], bytearray(), 0
        self.packer = zstandard.ZstdCompressor(level=3, write_content_size=True)

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame number and offset in it of the added record."""
        if self.buffer and len(self.buffer) + len(data) > FRAME_BYTES:
            self.flush()
        place = (len(self.frames), len(self.buffer))
        self.buffer += data
        return place

    def flush(self) -> None:
        if self.buffer:
            packed = self.packer.compress(bytes(self.buffer))
            self.out.write(packed)
            self.frames.append((len(packed), len(self.buffer)))
            self.size += len(packed)
            self.buffer = bytearray()

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


def seek_table(source: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(position, compressed size, size) of each frame, from the footer of a bundle."""
    end = source.size()
    n, _, magic = struct.unpack("<IBI", source.read_at(9, end - 9))
    if magic != SEEKABLE:
        raise ValueError("not a seekable bundle")
    entries = struct.iter_unpack("<II", source.read_at(8 * n, end - 9 - 8 * n))
    frames, at = [], 0
    for packed, size in entries:
        frames.append((at, packed, size))
        at += packed
    return frames


def digest_hex(html: Column) -> Column:
    return F.sha1(F.encode(F.coalesce(html.cast("string"), F.lit("")), "UTF-8"))


def plan_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """_digest, first_id, n for every payload of at least ``min_bytes`` that several pages have."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), digest_hex(F.col("html")).alias("_digest"), F.octet_length(F.coalesce(F.col("html").cast("string"), F.lit(""))).alias("_n"))
    groups = rows.where(F.col("_n") >= min_bytes).groupBy("_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    return groups.where("n > 1")


def write(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write all pages to bundles under ``folder``; returns the index.

    The index has page_id, bundle, frame, offset for each record. Every try of a task writes bundles of its
    own, and the index names those of the try that succeeded, whatever the order in which its rows came; bundles that
    lost tries left are removed.
    """
    repeated = cut(plan_revisits(pages, min_bytes))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), digest_hex(F.col("html")).alias("_digest"))
    if fits(repeated, 2_000_000):
        rows = rows.join(F.broadcast(repeated.select("_digest", "first_id")), "_digest", "left")
    else:  # Pages are joined by their own ids, so that a payload of very many pages, such as the empty one, is no hot key.
        same = cut(attach(rows.select("page_id", "_digest"), repeated, "_digest", F.xxhash64("page_id"), "n").select("page_id", "_digest", "first_id").distinct())
        rows = rows.withColumn("_id", F.coalesce("page_id", F.lit(0))).join(same.withColumn("_id", F.coalesce("page_id", F.lit(0))).drop("page_id").distinct(), ["_id", "_digest"], "left").drop("_id")
    rows = rows.withColumn("_part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        bundle, name, number, kept = None, "", 0, []

        def close() -> pa.RecordBatch:
            bundle.close()
            done = pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], t) for i, t in enumerate((pa.int64(), pa.string(), pa.int32(), pa.int64()))], ["page_id", "bundle", "frame", "offset"])
            kept.clear()
            return done

        token = uuid.uuid4().hex
        for b in slices(batches):
            for page_id, url, html, first, part in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "first_id", "_part")), strict=True):
                if bundle is None:
                    name, number = f"bundle-{part:06d}-{number:04d}-{token}.warc.zst", number + 1
                    bundle = Bundle(fs.open_output_stream(f"{root}/{name}", compression=None))
                revisit = first is not None and (page_id is None or page_id > first)
                kept.append((page_id, name, *bundle.add(record(page_id, url, html.encode("utf-8", "surrogatepass"), first, revisit))))
                if bundle.size >= BUNDLE_BYTES:
                    yield close()
                    bundle = None
        if bundle is not None:
            yield close()

    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    index = cut(rows.select("page_id", "url", "html", "first_id", "_part").mapInArrow(run, "page_id long, bundle string, frame int, offset long"))
    named = {r["bundle"] for r in index.select("bundle").distinct().collect()}  # one name for up to BUNDLE_BYTES of pages
    for left in fs.get_file_info(pafs.FileSelector(root)):
        if left.base_name.startswith("bundle-") and left.base_name not in named:
            fs.delete_file(left.path)
    return index


def _checked(headers: dict[str, str], body: bytes) -> tuple[int, str]:
    """Length and digest of a record's full payload, computed from the bytes read; a revisit's are those it names."""
    said = int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"][5:]
    if headers["WARC-Type"] != "response":
        return said
    found = len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()
    if found != said:
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return found


def read_back(folder: str, index: DataFrame, frames_per_task: int = 16) -> DataFrame:
    """Read every record that the index names: page_id, payload_bytes, payload_digest, record_type, refers_to, html.

    The index's (bundle, frame) pairs are dealt to tasks, ``frames_per_task`` to each on average; each reads the seek
    table and only its frames. Records are found by their offsets; digests and lengths of responses are
    computed again from what was read, and must be those of the header; html is null for revisits.
    """
    spots = cut(index.groupBy("bundle", "frame").agg(F.sort_array(F.collect_list("offset")).alias("offsets")))
    spots = spots.repartition(max(1, -(-spots.count() // frames_per_task)), "bundle", "frame")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        unpack = zstandard.ZstdDecompressor()
        tables: dict[str, list[tuple[int, int, int]]] = {}
        for b in batches:
            for name, frame, offsets in zip(*(b.column(c).to_pylist() for c in ("bundle", "frame", "offsets")), strict=True):
                with fs.open_input_file(f"{root}/{name}") as source:
                    if name not in tables:
                        tables[name] = seek_table(source)
                    at, packed, size = tables[name][frame]
                    data = unpack.decompress(source.read_at(packed, at), max_output_size=size)
                out = {k: [] for k in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "html")}
                found = {at: (h, body) for at, h, body in parse(data)}
                for at in offsets:
                    h, body = found[at]
                    ident = lambda x: int(x[10:-1]) if x and x[10:-1] else None
                    n, digest = _checked(h, body)
                    out["page_id"].append(ident(h["WARC-Record-ID"]))
                    out["payload_bytes"].append(n)
                    out["payload_digest"].append(digest)
                    out["record_type"].append(h["WARC-Type"])
                    out["refers_to"].append(ident(h.get("WARC-Refers-To")))
                    out["html"].append(body.decode("utf-8", "surrogatepass") if h["WARC-Type"] == "response" else None)
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("html", pa.string())]))

    return spots.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, html string")


def archive(spark: SparkSession, pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to bundles and read them back.

    Null html is an empty payload; a null page_id counts as larger than any other. All rows that
    carry the smallest page_id of a payload are responses. Other columns than page_id, url, html
    are ignored. An empty table writes nothing and gives an empty result.
    """
    if folder is None:
        folder = qualified(spark, f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}").replace("s3a://", "s3://")
    return read_back(folder, write(pages, folder, min_bytes))
