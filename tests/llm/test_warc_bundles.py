import base64
import glob
import hashlib

import zstandard

from taxaspark.llm import warc_bundles as B

ROWS = [(3, "http://a", "<p>x</p>"), (1, "http://b", "<p>x</p>"), (2, None, None), (5, "http://c\r\nX: y", ""), (None, "u", "<p>x</p>"), (1, "http://b", "<p>x</p>"), (9, "u", "é" * 2_000_000), (10, "u", "é" * 10)]


def plain(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        p, f = (h or "").encode(), first.get(h or "")
        revisit = f is not None and (i is None or i > f)
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", f if revisit else None, None if revisit else h or ""))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "html")) for r in df.collect()), key=repr)


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, bundle string")
    for k, parts in enumerate((1, 4)):
        folder = f"file://{tmp_path}/w{k}"
        index = B.write(df.repartition(parts), folder)
        assert rows_of(B.read_back(folder, index)) == plain(ROWS)
        assert index.where("offset < 0 OR frame < 0").count() == 0
    assert B.archive(spark, df.limit(0)).count() == 0


def test_bundles_are_ordinary_zstandard(spark, tmp_path):
    import pyarrow.fs as pafs

    rows = [(i, f"http://h/{i}", f"page {i} " * 20_000) for i in range(30)]
    folder = f"file://{tmp_path}/b"
    B.write(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder).count()
    (path,) = glob.glob(f"{tmp_path}/b/*.zst")
    with pafs.LocalFileSystem().open_input_file(path) as f:
        table = B.seek_table(f)
    assert len(table) > 3
    whole = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"), read_across_frames=True).read()
    assert len(whole) == sum(size for _, _, size in table)
    records = list(B.parse(whole))
    assert sorted(int(h["WARC-Record-ID"][10:-1]) for _, h, _ in records) == list(range(30))
