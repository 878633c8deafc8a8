import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from closebook.llm import warc

SCHEMA = "page_id long, url string, html string, shard string, digest string"
COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload", "uri")


def pages(spark, rows):
    return spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA)


def archived(spark, df, path, **options):
    warc.write_warc(df, path, **options)
    return [tuple(r) for r in warc.read_warc(spark, path).select(*COLUMNS).collect()]


def expected(rows):
    """The contract, row by row."""
    least = {}
    for page_id, _, html in rows:
        if page_id is not None:
            least[html or ""] = min(least.get(html or "", page_id), page_id)
    out = []
    for page_id, url, html in rows:
        payload = (html or "").encode()
        first = least.get(html or "")
        again = len(payload) >= 100 and first is not None and (page_id is None or page_id > first)
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response",
                    first if again else None, None if again else payload, warc.target(url)))
    return out


def same(found, wanted):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(found, key=key) == sorted(wanted, key=key)


def test_odd_rows(spark, tmp_path):
    big = "<p>" + "ä\r\n\r\nWARC/1.1\r\n" * 20
    rows = [
        (5, "http://a/1", big), (3, "http://a/2", big), (9, None, big), (None, "http://a/n", big),
        (7, "http://a/ü b\r\nX: y", "x" * 99), (8, "http://a/8", "x" * 99), (10, "u", None), (11, "u", ""), (12, "u", ""),
        (13, "u", "y" * 100), (13, "u", "y" * 100), (14, "u", "y" * 100), (None, "v", "z" * 200), (None, "v", "z" * 200),
        (15, "long", "w " * 500_000),
    ]
    same(archived(spark, pages(spark, rows), str(tmp_path / "a")), expected(rows))


def test_large_groups_of_copies(spark, tmp_path):
    rows = [(i, f"http://h/{i}", ("copy " * 60) if i % 3 else f"own {i} " * 20) for i in range(3000)]
    same(archived(spark, pages(spark, rows), str(tmp_path / "a"), shard_bytes=40_000), expected(rows))


def test_ids_that_repeat_are_divided_among_shards(spark, tmp_path):
    rows = [(1, "u", f"{i} " * 40) for i in range(2000)]
    path = str(tmp_path / "a")
    same(archived(spark, pages(spark, rows), path, shard_bytes=20_000), expected(rows))
    assert len([f for f in os.listdir(path) if f.endswith(".gz")]) > 5


def test_files_roll_by_compressed_size_and_are_sorted(spark, tmp_path):
    rows = [(i, f"http://h/{i}", hashlib.sha512(str(i).encode()).hexdigest() * 8) for i in range(1500)]
    path = str(tmp_path / "a")
    df = pages(spark, rows).repartition(5)
    same(archived(spark, df, path, shard_bytes=1 << 20, file_bytes=60_000, segment_bytes=10_000), expected(rows))
    files = sorted(f for f in os.listdir(path) if f.endswith(".warc.gz"))
    assert len(files) > 4
    ids = []
    for name in files:
        assert os.path.getsize(os.path.join(path, name)) <= 60_000
        text = gzip.open(os.path.join(path, name)).read()
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        ids += [int(line.split(b": ")[1]) for line in text.split(b"\r\n") if line.startswith(b"X-Page-ID")]
    assert ids == list(range(1500))
    assert spark.read.parquet(f"{path}/{warc.MANIFEST}").count() > len(files)


def test_the_same_rows_give_the_same_bytes(spark, tmp_path):
    rows = [(i * 7 % 1000, f"http://h/{i}", f"text {i} " * 30) for i in range(1000)]
    one, other = str(tmp_path / "a"), str(tmp_path / "b")
    warc.write_warc(pages(spark, rows), one, shard_bytes=30_000)
    warc.write_warc(pages(spark, rows[::-1]).repartition(3), other, shard_bytes=30_000)
    read = lambda path: {f: open(os.path.join(path, f), "rb").read() for f in os.listdir(path) if f.endswith(".gz")}
    assert read(one) == read(other) and len(read(one)) > 3


def test_nothing_is_read_before_the_commit(spark, tmp_path):
    path = str(tmp_path / "a")
    failing = spark.range(200).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.when(F.col("id") == 150, F.raise_error(F.lit("lost"))).otherwise(F.lit("x" * 200)).alias("html"),
    )
    with pytest.raises(Exception, match="lost"):
        warc.write_warc(failing, path)
    with pytest.raises(FileNotFoundError):
        warc.read_warc(spark, path)
    rows = [(1, "u", "whole")]
    same(archived(spark, pages(spark, rows), path), expected(rows))
    with pytest.raises(FileExistsError):
        warc.write_warc(pages(spark, rows), path)


def test_files_may_be_renamed_again(spark, tmp_path):
    import pyarrow as pa

    (tmp_path / "_temporary").mkdir()
    (tmp_path / "_temporary" / "n.1").write_bytes(b"x")
    batch = pa.record_batch([["n.1"], ["n"]], names=["temporary", "name"])
    rename = warc._renamer(f"{tmp_path}/_temporary", str(tmp_path))
    for _ in range(2):
        list(rename([batch]))
    assert (tmp_path / "n").read_bytes() == b"x"
    (tmp_path / "n").unlink()
    with pytest.raises(FileNotFoundError):
        list(rename([batch]))


def test_damaged_archives_fail(spark, tmp_path):
    path = str(tmp_path / "a")
    warc.write_warc(pages(spark, [(i, "u", f"{i} " * 50) for i in range(50)]), path)
    (name,) = (f for f in os.listdir(path) if f.endswith(".gz"))
    data = gzip.open(os.path.join(path, name)).read()
    entry = {"name": name, "at": 0, "bytes": 0, "records": 0}
    with pytest.raises(ValueError, match="digest"):
        warc.parsed(data[data.index(b"WARC/1.1", 10) :].replace(b"0 0 0", b"0 1 0", 1))
    with open(os.path.join(path, name), "rb") as file, pytest.raises(ValueError, match="ends within"):
        list(warc.records_of(file, entry | {"bytes": 10}))
    segment = spark.read.parquet(f"{path}/{warc.MANIFEST}").first().asDict()
    with open(os.path.join(path, name), "rb") as file, pytest.raises(ValueError, match="of 7 records"):
        list(warc.records_of(file, segment | {"records": 7}))


def test_empty_table(spark, tmp_path):
    assert archived(spark, pages(spark, []), str(tmp_path / "a")) == []
