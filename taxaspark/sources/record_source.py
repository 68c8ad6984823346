"""FASTQ and FASTA as Spark data sources: files are planned as ranges, and each task reads the records that begin in its own.

``spark.read.format("fastq").load(path)`` after ``register(spark)``. Plain files are cut at any byte, blocked gzip files at
their members, other gzip files are one range each, read as a stream. No shuffle, sort or window is needed to
read; ``ordinals`` adds the number of a record in its file from the ranges' counts.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "file string, part int, at long, read_id string, seq string, qual string"
RANGE = 64 << 20
ROWS = 10_000


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


@dataclass
class Range(InputPartition):
    """Bytes of a file in which a task's records begin; ``form`` is plain, blocks or stream."""

    path: str
    part: int
    start: int
    stop: int
    form: str


def _block_starts(file: pa.NativeFile, size: int) -> list[int] | None:
    """Where the members of a blocked gzip file start; None for any other file. Only headers are read."""
    at, found = 0, []
    while at < size:
        file.seek(at)
        head = file.read(18)
        if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04" or head[12:16] != b"BC\x02\x00":
            return None
        found.append(at)
        at += struct.unpack("<H", head[16:18])[0] + 1
    return found


def ranges(paths: list[str], size: int) -> list[Range]:
    """The ranges of all files; folders give their files. An empty file has none."""
    out = []
    for given in paths:
        store, path = _open(given)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(given)
        prefix = given[: len(given) - len(path)] if given.endswith(path) else ""
        inner = [info] if info.type == fs.FileType.File else sorted(store.get_file_info(fs.FileSelector(path)), key=lambda f: f.path)
        for f in inner:
            if f.type != fs.FileType.File or not f.size or f.base_name.startswith((".", "_")):
                continue
            with store.open_input_file(f.path) as file:
                packed = file.read(2) == b"\x1f\x8b"
                starts = _block_starts(file, f.size) if packed else None
            if packed and starts is None:
                out.append(Range(prefix + f.path, 0, 0, f.size, "stream"))
                continue
            cuts = [s for k, s in enumerate(starts) if k == 0 or s // size != starts[k - 1] // size] if packed else list(range(0, f.size, size))
            out += [Range(prefix + f.path, k, s, e, "blocks" if packed else "plain") for k, (s, e) in enumerate(zip(cuts, [*cuts[1:], f.size], strict=True))]
    return out


def _pieces(r: Range) -> Iterator[tuple[bytes, bool]]:
    """Text of the file from the range's start on, and whether a piece still belongs to the range."""
    store, path = _open(r.path)
    if r.form == "stream":
        with store.open_input_stream(path, compression="gzip") as file:
            while piece := file.read(1 << 20):
                yield piece, True
        return
    with store.open_input_file(path) as file:
        size, at = file.size(), r.start
        while at < size:
            file.seek(at)
            own = at < r.stop
            if r.form == "plain":
                piece = file.read(min(1 << 20, r.stop - at) if own else 1 << 16)
                at += len(piece)
            else:
                head = file.read(18)
                length = struct.unpack("<H", head[16:18])[0] + 1
                piece = zlib.decompress(head + file.read(length - 18), 31)
                at += length
            yield piece, own


def _lines(r: Range) -> Iterator[tuple[bytes, bool]]:
    """Lines, and whether each begins in the range or right at its end.

    The line that begins right at a range's end is its last one, as the next range skips its first line, whole or not.
    """
    rest, mine, before = b"", True, True
    for piece, own in _pieces(r):
        begins = mine if rest else before
        lines = (rest + piece).split(b"\n")
        rest = lines.pop()
        for k, line in enumerate(lines):
            yield line.rstrip(b"\r"), begins if k == 0 else own
        mine = own if lines else begins
        before = own
    if rest:
        yield rest.rstrip(b"\r"), mine


def fastq_records(r: Range) -> Iterator[tuple[str, str, str]]:
    """id, bases and qualities of the records that begin in the range. Four lines each; anything else is an error."""
    lines = _lines(r)
    window: list[tuple[bytes, bool]] = []
    if r.part:
        # A record begins at an @ two lines before a +; bases don't begin with +, so no quality line is taken for it.
        next(lines, None)
        for line in lines:
            window = [*window[-3:], line]
            if len(window) == 4 and window[0][0].startswith(b"@") and window[2][0].startswith(b"+"):
                break
        else:
            return
    while True:
        while len(window) < 4:
            line = next(lines, None)
            if line is None:
                if window:
                    raise ValueError(f"{r.path}: the last record is cut off")
                return
            if line[0] or window:
                window.append(line)
        if not window[0][1]:
            return
        a, b, c, d = (x[0] for x in window)
        if not a.startswith(b"@") or not c.startswith(b"+") or len(b) != len(d):
            raise ValueError(f"{r.path}: {a[:50]!r} isn't a record of four lines")
        window = []
        yield (a[1:].split() or [b""])[0].decode(), b.decode(), d.decode()


def fasta_records(r: Range) -> Iterator[tuple[str, str, None]]:
    """Header and bases of the records that begin in the range."""
    lines = _lines(r)
    if r.part:
        next(lines, None)
    name, seq = None, []
    for line, own in lines:
        if line.startswith(b">"):
            if name is not None:
                yield name, b"".join(seq).decode(), None
            name, seq = None, []
            if not own:
                return
            name = line[1:].decode()
        elif name is not None:
            seq.append(b"".join(line.split()))
    if name is not None:
        yield name, b"".join(seq).decode(), None


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], size: int, records):
        self.paths, self.size, self.records = paths, size, records

    def partitions(self) -> list[Range]:
        return ranges(self.paths, self.size) or [Range("", -1, 0, 0, "none")]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for at, record in enumerate(self.records(partition) if partition.part >= 0 else ()):
            held.append((partition.path, partition.part, at, *record))
            if len(held) == ROWS:
                yield _batch(held)
                held = []
        if held:
            yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["file", "part", "at", "read_id", "seq", "qual"])


class FastqSource(DataSource):
    """Options: path, or paths (one a line), and range (bytes of a range, 64 MB). Quality is null for FASTA."""

    records = staticmethod(fastq_records)

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        paths = [p for p in (self.options.get("paths") or self.options["path"]).split("\n") if p]
        return _Reader(paths, int(self.options.get("range", RANGE)), type(self).records)


class FastaSource(FastqSource):
    records = staticmethod(fasta_records)

    @classmethod
    def name(cls) -> str:
        return "fasta"


def register(spark: SparkSession) -> None:
    for source in (FastqSource, FastaSource):
        spark.dataSource.register(source)


def load(spark: SparkSession, kind: str, paths: list[str], size: int = RANGE) -> DataFrame:
    register(spark)
    return spark.read.format(kind).option("paths", "\n".join(paths)).option("range", str(size)).load()


def ordinals(rows: DataFrame) -> DataFrame:
    """``rows`` of a source with ``ordinal``, the number of the record in its file, from 0: the counts of the ranges before are added."""
    sizes = rows.groupBy("file", "part").agg(F.count("*").alias("n"))
    before = sizes.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("s"))  # as many entries as the file has ranges
    base = lambda i: F.aggregate(F.slice("s", F.lit(1), i), F.lit(0).cast("long"), lambda a, y: a + y["n"])
    before = before.select("file", F.explode(F.transform("s", lambda x, i: F.struct(x["part"].alias("part"), base(i).alias("base")))).alias("b")).select("file", "b.*")
    return rows.join(F.broadcast(before), ["file", "part"]).withColumn("ordinal", F.col("base") + F.col("at")).drop("base")  # one row a range
