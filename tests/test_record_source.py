"""Records of FASTQ and FASTA files in any cut, plain, gzip and blocked gzip."""

import gzip
import random
import struct
import zlib

import pytest

from taxaspark.sources import record_source as R


def blocked(data, size=700):
    out = b""
    for k in [*range(0, len(data), size), None]:
        part = b"" if k is None else data[k : k + size]
        packed = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packed.compress(part) + packed.flush()
        out += b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))
    return out


def fastq(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = rng.randint(1, 60)
        # qualities that begin with @ and + are what makes cuts hard
        rows.append((f"r{i}", "".join(rng.choice("ACGT") for _ in range(k)), rng.choice("@+I") + "".join(rng.choice("@+I#") for _ in range(k - 1))))
    return rows, "".join(f"@{i} x\n{s}\n+\n{q}\n" for i, s, q in rows)


@pytest.mark.parametrize("size", [50, 333, 4096, 1 << 20])
def test_every_record_once_in_any_cut(spark, tmp_path, size):
    rows, text = fastq(400)
    (tmp_path / "a.fastq").write_text(text)
    (tmp_path / "b.fastq.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "c.fastq.gz").write_bytes(blocked(text.encode()))
    (tmp_path / "d.fastq").write_bytes(text.replace("\n", "\r\n").rstrip().encode())
    (tmp_path / "e.fastq").write_text("")
    for name in "abcd":
        [path] = tmp_path.glob(f"{name}.*")
        parts = R.ranges([str(path)], size)
        assert [x for r in parts for x in R.fastq_records(r)] == rows
        assert len(parts) > 1 or name == "b" or size > 4096
    if size == 4096:
        df = R.ordinals(R.load(spark, "fastq", [str(tmp_path)], size))
        got = df.orderBy("file", "ordinal").collect()
        assert [(r["read_id"], r["seq"], r["qual"]) for r in got] == rows * 4 and [r["ordinal"] for r in got] == list(range(400)) * 4
        assert R.load(spark, "fastq", [str(tmp_path / "e.fastq")]).count() == 0


@pytest.mark.parametrize("size", [40, 1000, 1 << 20])
def test_fasta(spark, tmp_path, size):
    rng = random.Random(2)
    rows = [(f"s{i} of {i}", "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 200)))) for i in range(60)]
    text = "".join(f">{n}\n" + "".join(s[k : k + 60] + "\n" for k in range(0, len(s), 60)) for n, s in rows)
    for name, data in (("a.fa", text.encode()), ("b.fa.gz", gzip.compress(text.encode())), ("c.fa.gz", blocked(text.encode(), 500))):
        (tmp_path / name).write_bytes(data)
        assert [x[:2] for r in R.ranges([str(tmp_path / name)], size) for x in R.fasta_records(r)] == rows
    if size == 1000:
        assert R.load(spark, "fasta", [str(tmp_path / "a.fa")], size).count() == 60


def test_broken_files(tmp_path):
    for text in ("@a\nAC\n+\nI\n", "ACGT\n", "@a\nAC\n+\n"):
        (tmp_path / "x.fastq").write_text(text)
        with pytest.raises(ValueError, match="record"):
            list(R.fastq_records(R.ranges([str(tmp_path / "x.fastq")], 100)[0]))
    with pytest.raises(FileNotFoundError):
        R.ranges([str(tmp_path / "none")], 100)
