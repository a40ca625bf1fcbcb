"""The file_tree source on real trees: link loops, slices, pushed filters; archives in chunks."""

from __future__ import annotations

import io
import os
import random
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from filelens.sinks.files import write_files
from filelens.sources import files as scan
from filelens.sources import members, tree


def _write(path, data=b"x"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def listed(df, root):
    return sorted(os.path.relpath(r.full_path, root) for r in df.collect())


def test_a_link_loop_ends_and_each_file_is_listed_once(spark, tmp_path):
    _write(str(tmp_path / "a" / "f.txt"))
    _write(str(tmp_path / "a" / "b" / "g.txt"))
    os.symlink(tmp_path / "a", tmp_path / "a" / "loop")
    os.symlink(tmp_path / "a", tmp_path / "a" / "b" / "up")
    os.symlink(tmp_path, tmp_path / "a" / "b" / "top")
    assert listed(scan.scan_files(spark, str(tmp_path), rule="no_zip"), tmp_path) == ["a/b/g.txt", "a/f.txt"]


def test_two_folders_linked_to_each_other(spark, tmp_path):
    """Each is entered under the other too, as a walk that follows links does, and no further."""
    _write(str(tmp_path / "a" / "f.txt"))
    _write(str(tmp_path / "b" / "g.txt"))
    os.symlink(tmp_path / "b", tmp_path / "a" / "to_b")
    os.symlink(tmp_path / "a", tmp_path / "b" / "to_a")
    want = ["a/f.txt", "a/to_b/g.txt", "b/g.txt", "b/to_a/f.txt"]
    assert listed(scan.scan_files(spark, str(tmp_path), rule="no_zip"), tmp_path) == want
    assert listed(scan.scan_files(spark, str(tmp_path), rule="all"), tmp_path) == ["a/f.txt", "b/g.txt"]


def test_one_branch_and_one_flat_folder_are_dealt_to_many_partitions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tree, "FILES_A_TASK", 40)
    monkeypatch.setattr(tree, "FILES_A_SLICE", 10)
    deep = tmp_path / "only" / "one" / "branch"
    for i in range(160):
        _write(str(deep / f"flat_{i:03d}.bin"), b"y" * i)
    for i in range(9):
        _write(str(deep / f"d{i}" / "x.bin"), b"z")
    os.makedirs(deep / "empty")
    got = scan.walk_files(spark, [str(tmp_path)])
    assert got.count() == 169 and got.agg(F.sum("file_size")).first()[0] == sum(range(160)) + 9
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 80
    assert scan.walk_files(spark, [str(tmp_path)], num_partitions=2).rdd.getNumPartitions() <= 2
    assert listed(scan.walk_files(spark, [str(deep)], recursive=False, pattern="flat_00*"), deep) == [f"flat_{i:03d}.bin" for i in range(10)]


def test_an_empty_tree(spark, tmp_path):
    os.makedirs(tmp_path / "a" / "b")
    assert scan.walk_files(spark, [str(tmp_path)]).count() == 0


def test_filters_are_pushed_to_the_source(spark, tmp_path):
    """A file that the path filter leaves out is never sized: a dangling link would raise."""
    _write(str(tmp_path / "a" / "x.png"), b"1234")
    _write(str(tmp_path / "a" / "y.json"), b"12")
    _write(str(tmp_path / "b" / "z.png"), b"1")
    os.symlink(tmp_path / "gone", tmp_path / "b" / "dangling.json")
    key = "spark.sql.python.filterPushdown.enabled"
    spark.conf.set(key, "true")
    try:
        files = scan.walk_files(spark, [str(tmp_path)])
        assert listed(files.where(F.col("full_path").endswith(".png")), tmp_path) == ["a/x.png", "b/z.png"]
        assert listed(files.where(F.col("full_path").startswith(f"{tmp_path}/a/") & (F.col("file_size") > 2)), tmp_path) == ["a/x.png"]
        assert listed(files.where(~F.col("full_path").contains("dangling") & (F.col("file_size") <= 2)), tmp_path) == ["a/y.json", "b/z.png"]
        assert listed(files.where((F.col("full_path") == f"{tmp_path}/a/y.json") & F.col("file_size").isNotNull()), tmp_path) == ["a/y.json"]
        with pytest.raises(Exception, match="No such file"):
            files.where(F.col("full_path").endswith(".json")).count()
    finally:
        spark.conf.unset(key)


def test_files_are_written_whole_and_safely(spark, tmp_path):
    df = spark.createDataFrame([("a/b/c.txt", b"one"), ("d\ne.txt", b"")], "path string, content binary")
    for _ in range(2):  # a task that is run again
        assert write_files(df, f"file://{tmp_path}/out") == f"{tmp_path}/out"
    assert {p: open(os.path.join(r, p), "rb").read() for r, _, ps in os.walk(tmp_path / "out") for p in ps} == {"c.txt": b"one", "d\ne.txt": b""}
    for bad in ("/abs", "a/../../up"):
        with pytest.raises(Exception, match="unsafe path"):
            write_files(spark.createDataFrame([(bad, b"x")], "path string, content binary"), str(tmp_path))
    with pytest.raises(ValueError, match="mount"):
        write_files(df, "hdfs://x/y")


def test_checksums_are_put_together_in_any_order():
    rng = random.Random(2)
    data = rng.randbytes(5000)
    for _ in range(30):
        cuts = sorted({0, len(data), *rng.choices(range(len(data)), k=6)})
        total = 0
        for a, b in zip(cuts, cuts[1:], strict=False):
            total ^= members.crc_shift(zlib.crc32(data[a:b]), len(data) - b)
        assert total == zlib.crc32(data)


@pytest.fixture(scope="module")
def archive_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("zips")
    rng = random.Random(1)
    big = rng.randbytes(3_000_000)
    with zipfile.ZipFile(d / "a.zip", "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("dir/", b"")
        zf.writestr("big.bin", big)
        zf.writestr("empty", b"")
        zf.writestr("same", b"first")
        zf.writestr("zeros", bytes(2_000_000))
        zf.writestr(zipfile.ZipInfo("stored.bin"), big, zipfile.ZIP_STORED)
    with zipfile.ZipFile(d / "b.zip", "w", zipfile.ZIP_STORED) as zf:
        zf.writestr("한글.txt", "한글".encode())
    return d, big


def test_members_larger_than_a_batch_come_in_ordered_chunks(spark, archive_dir, monkeypatch):
    d, big = archive_dir
    monkeypatch.setattr(members, "BATCH_BYTES", 200_000)
    chunks = members.member_chunks(spark, str(d), chunk_bytes=64_000, num_partitions=6)
    got = {}
    for r in chunks.orderBy("archive", "entry", "chunk").collect():
        assert r.length == len(r.content) <= 64_000 and r.start == 64_000 * r.chunk
        got.setdefault((os.path.basename(r.archive), r.member), []).append(bytes(r.content))
    joined = {k: b"".join(v) for k, v in got.items()}
    assert joined == {("a.zip", "big.bin"): big, ("a.zip", "empty"): b"", ("a.zip", "same"): b"first", ("a.zip", "zeros"): bytes(2_000_000),
                      ("a.zip", "stored.bin"): big, ("b.zip", "한글.txt"): "한글".encode()}
    # a stored member is read by several tasks
    stored = chunks.where("member = 'stored.bin'")
    assert stored.groupBy(F.spark_partition_id()).count().count() > 1
    totals = {r.member: r for r in members.member_totals(chunks).collect()}
    assert all(r.ok for r in totals.values()) and totals["big.bin"].crc32 == zlib.crc32(big) and totals["big.bin"].n_chunks == 47
    assert totals["한글.txt"].dest == f"{d}/b"


@pytest.mark.parametrize("chunk_bytes", [64, 1000, 4096])
def test_a_full_chunk_does_not_end_a_member_early(spark, tmp_path, chunk_bytes):
    # the last bytes of input stand for more output than the chunk they are read in has room for
    data = {f"m{n:05d}": b"a" * n for n in (0, 1, 63, 64, 65, 999, 1000, 4095, 4096, 4097, 5000, 8192, 20_000)}
    data |= {f"t{n}": b"some words over and over; " * n for n in (40, 157, 158, 500)}
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as zf:
        for name, content in data.items():
            zf.writestr(name, content)
    chunks = members.member_chunks(spark, str(tmp_path), chunk_bytes=chunk_bytes).cache()
    got = {name: b"" for name in data}
    for r in chunks.orderBy("member", "chunk").collect():
        assert r.length == len(r.content) <= chunk_bytes and r.start == len(got[r.member])
        got[r.member] += bytes(r.content)
    assert got == data and all(r.ok and r.crc32 == zlib.crc32(data[r.member]) for r in members.member_totals(chunks).collect())


def test_a_member_cut_short_is_an_error(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("m", random.Random(3).randbytes(5000))
        info = zf.getinfo("m")
    whole = info.compress_size
    with open(tmp_path / "a.zip", "rb") as f:
        assert len(b"".join(c for _, c in members._chunks(f, info, 512, 0, -1))) == 5000
        for left in (whole - 1, whole // 2, 1, 0):
            info.compress_size = left
            with pytest.raises(ValueError, match="ends early"):
                list(members._chunks(f, info, 512, 0, -1))


def test_damaged_members_are_told_by_their_checksum(spark, tmp_path):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_STORED) as zf:
        zf.writestr("good", b"good data")
        zf.writestr("bad", b"bad-bytes")
        zf.writestr("../up", b"u")
    (tmp_path / "x.zip").write_bytes(buf.getvalue().replace(b"bad-bytes", b"BAD-bytes", 1))
    cut = io.BytesIO()
    with zipfile.ZipFile(cut, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("cut", random.Random(1).randbytes(4000))
    at = cut.getvalue().index(b"cut") + 3 + 100
    (tmp_path / "y.zip").write_bytes(cut.getvalue()[:at] + b"\xff" * 50 + cut.getvalue()[at + 50 :])
    (tmp_path / "z.zip").write_bytes(b"no zip")
    rows = members.member_totals(members.member_chunks(spark, str(tmp_path), errors="record")).collect()
    got = {(os.path.basename(r.archive), r.member): (r.ok, r.error) for r in rows}
    assert got[("x.zip", "good")] == (True, None) and got[("x.zip", "bad")] == (False, None)
    assert got[("x.zip", "../up")] == (False, "unsafe member name") and not got[("y.zip", "cut")][0] and "bad zip" in got[("z.zip", None)][1]
    with pytest.raises(Exception, match="unsafe member|not a zip"):
        members.member_chunks(spark, str(tmp_path)).count()
