from __future__ import annotations

import io
import os
import warnings
import zipfile

import pytest
from pyspark.sql import functions as F

from filelens.operators import batches, constraints
from filelens.operators.catalogue import file_catalogue
from filelens.sources import archives


@pytest.fixture(scope="module")
def zip_dir(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("zips"))
    for name, members in {"a.zip": {"x/1.json": b"{}", "x/2.png": b"\x89PNG" * 100},
                          "b.zip": {"y.txt": "한글".encode()},
                          "c.tar.gz": {}}.items():
        path = os.path.join(d, name)
        if name.endswith(".zip"):
            with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
                zf.writestr("x/", b"")
                for m, data in members.items():
                    zf.writestr(m, data)
        else:
            open(path, "wb").write(b"not a zip")
    os.makedirs(os.path.join(d, "sub"))
    with zipfile.ZipFile(os.path.join(d, "sub", "nested.zip"), "w") as zf:
        zf.writestr("n.txt", b"n")
    return d


def test_scan_and_expand(spark, zip_dir):
    arch = archives.scan_archives(spark, zip_dir)
    assert sorted(r.path.rsplit("/", 1)[1] for r in arch.select("path").collect()) == ["a.zip", "b.zip"]
    rows = archives.expand_archives(arch, num_partitions=2).collect()
    got = sorted((r.dest.rsplit("/", 1)[1], r.member, r.length) for r in rows)
    assert got == [("a", "x/1.json", 2), ("a", "x/2.png", 400), ("b", "y.txt", 6)]
    assert {bytes(r.content) for r in rows if r.member == "y.txt"} == {"한글".encode()}


def test_unsafe_member_raises(spark):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("../evil.txt", b"x")
    df = spark.createDataFrame([("/z/evil.zip", buf.getvalue())], "path string, content binary")
    with pytest.raises(Exception, match="unsafe member"):
        archives.expand_archives(df).collect()


def test_pack_expand_roundtrip(spark):
    members = spark.range(0, 500).selectExpr(
        "concat('/arch/', CAST(id % 3 AS STRING), '.zip') AS archive",
        "concat('m/', CAST(id AS STRING), '.txt') AS member",
        "encode(repeat('ab', CAST(id AS INT)), 'UTF-8') AS content").repartition(4)
    packed = archives.pack_archives(members, max_bytes=2000)
    assert packed.count() > 3  # parts are bounded in size
    out = archives.expand_archives(packed)
    rows = out.select("member", "length").collect()
    assert sorted((r.member, r.length) for r in rows) == sorted((f"m/{i}.txt", 2 * i) for i in range(500))
    # few open parts per task: more, smaller archives, same members
    few = archives.expand_archives(archives.pack_archives(members, max_open=1, compress_level=0))
    assert sorted((r.member, r.length) for r in few.select("member", "length").collect()) == sorted(
        (f"m/{i}.txt", 2 * i) for i in range(500))


def test_assign_batches_matches_row_number(spark):
    import random

    keys = list(range(1000))
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k, f"p{k:05d}") for k in keys], "k int, p string").repartition(5)
    out = batches.assign_batches(df, ["p"], size=3).collect()
    assert sorted((r.k, r.row_index, r.batch_id) for r in out) == [(k, k, k // 3) for k in range(1000)]
    out16 = batches.assign_batches(df, ["p"], size=3, num_partitions=16).collect()
    assert sorted((r.k, r.row_index, r.batch_id) for r in out16) == [(k, k, k // 3) for k in range(1000)]


def test_preview_is_bounded_and_ordered(spark):
    df = spark.range(0, 100).selectExpr("id", "id % 7 AS g")
    got = [r.id for r in batches.preview(df, 5, ["g", "id"]).collect()]
    assert got == [0, 7, 14, 21, 28]


def test_check_constraints(spark):
    paths = spark.createDataFrame(
        [("/a/x.png", 1), ("/b/x.jpg", 2), ("/c/" + "y" * 25 + ".png", 3), ("/d/z.png", None)],
        "full_path string, file_size bigint")
    out = constraints.check_constraints(file_catalogue(paths))
    got = sorted((r.violation, r.file_id, r.n_rows) for r in out.collect())
    assert got == [("key_length", "y" * 25, 1), ("not_null", "z", 1), ("primary_key", "x", 2)]


def test_hot_key_constraint_counts(spark):
    # one key holding a third of all rows
    df = spark.range(0, 3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN '/h/hot.png' ELSE concat('/c/', CAST(id AS STRING), '.png') END AS full_path",
        "id AS file_size")
    out = constraints.check_constraints(file_catalogue(df)).collect()
    assert [(r.violation, r.file_id, r.n_rows) for r in out] == [("primary_key", "hot", 1000)]


def test_assign_batches_hot_key_is_split(spark):
    # a third of the rows share one sort key: the range shuffle still spreads them
    df = spark.range(0, 3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE format_string('k%05d', id) END AS k")
    out = batches.assign_batches(df, ["k"], size=10)
    rows = out.collect()
    assert sorted(r.row_index for r in rows) == list(range(3000))
    hot = [r.row_index for r in rows if r.k == "hot"]
    assert sorted(hot) == list(range(0, 1000))  # 'hot' sorts before every 'k…' key
    assert {r.batch_id for r in rows if r.k == "hot"} == set(range(100))


def test_bucket_column_and_pandas_preview(spark):
    from filelens.operators.stats import BUCKETS_A3, bucket_column

    df = spark.createDataFrame([("/a/x.png",), ("/a/y.jpeg",), ("/a/z.csv",), ("/a.png/file",)], "full_path string")
    got = [r.b for r in df.select(bucket_column("full_path", BUCKETS_A3).alias("b")).collect()]
    assert got == ["png", "jpg", "etc", "etc"]
    pdf = batches.to_pandas_preview(df, 2, ["full_path"])
    assert list(pdf["full_path"]) == ["/a.png/file", "/a/x.png"]


def test_bad_archive_raises_or_is_recorded(spark):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("ok.txt", b"fine")
    df = spark.createDataFrame([("/z/good.zip", buf.getvalue()), ("/z/bad.zip", b"not a zip")],
                               "path string, content binary")
    with pytest.raises(Exception, match="not a zip"):
        archives.expand_archives(df).collect()
    rows = sorted(archives.expand_archives(df, errors="record").select("archive", "member", "error").collect())
    assert [(r.archive, r.member) for r in rows] == [("/z/bad.zip", None), ("/z/good.zip", "ok.txt")]
    assert rows[0].error.startswith("bad zip") and rows[1].error is None


def test_expand_archive_files_matches_row_expansion(spark, zip_dir, tmp_path):
    by_rows = archives.expand_archives(archives.scan_archives(spark, zip_dir))
    by_path = archives.expand_archive_files(spark, zip_dir, num_partitions=3)
    key = lambda r: (r.archive, r.member, r.length, bytes(r.content))
    assert sorted(map(key, by_path.collect())) == sorted(map(key, by_rows.collect()))
    # one big archive is read by several tasks
    big = tmp_path / "big"
    big.mkdir()
    with zipfile.ZipFile(big / "hot.zip", "w") as zf:
        for i in range(64):
            zf.writestr(f"m{i}.bin", bytes([i % 256]) * 1000)
    out = archives.expand_archive_files(spark, str(big), num_partitions=8)
    from pyspark.sql import functions as F

    assert out.count() == 64
    assert out.groupBy(F.spark_partition_id()).count().count() > 1


def test_scan_archives_empty_folder(spark, tmp_path):
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.txt").write_text("no zip here")
    assert archives.scan_archives(spark, str(tmp_path / "none")).count() == 0


def test_type_counts_with_a_hot_group(spark):
    from filelens.operators.stats import BUCKETS_A1, type_counts

    df = spark.range(0, 3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('g', CAST(id % 50 AS STRING)) END AS grp",
        "concat('/d/f', CAST(id AS STRING), CASE WHEN id % 2 = 0 THEN '.png' ELSE '.json' END) AS full_path",
        "id AS file_size")
    rows = {r.grp: r for r in type_counts(df, BUCKETS_A1, size="file_size", by=["grp"]).collect()}
    hot = rows["hot"]
    assert hot.n_files == 1000 and hot.png_count == 500 and hot.json_count == 500
    assert hot.total_bytes == sum(range(0, 3000, 3))
    assert sum(r.n_files for r in rows.values()) == 3000


def _zip(members, corrupt=None):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_STORED) as zf, warnings.catch_warnings():
        warnings.simplefilter("ignore")
        for name, data in members:
            zf.writestr(name, data)
    blob = buf.getvalue()
    return blob.replace(corrupt, b"#" * len(corrupt), 1) if corrupt else blob


def test_bad_members_are_recorded_and_the_rest_is_kept(spark):
    rows = [("/a/crc.zip", _zip([("x", b"good data"), ("y", b"bad-bytes")], corrupt=b"bad-bytes")),
            ("/a/unsafe.zip", _zip([("../up", b"u"), ("ok", b"k")])), ("/a/none.zip", b"no zip")]
    df = spark.createDataFrame(rows, "path string, content binary")
    got = {(r.archive, r.member): (r.length, r.error) for r in archives.expand_archives(df, errors="record").collect()}
    assert got[("/a/crc.zip", "x")] == (9, None) and got[("/a/unsafe.zip", "ok")] == (1, None)
    assert got[("/a/crc.zip", "y")][0] is None and "CRC" in got[("/a/crc.zip", "y")][1]
    assert got[("/a/unsafe.zip", "../up")] == (None, "unsafe member name") and "bad zip" in got[("/a/none.zip", None)][1]
    for path, _ in rows:
        with pytest.raises(Exception, match="cannot read member|unsafe member|not a zip"):
            archives.expand_archives(df.where(F.col("path") == path)).collect()


def test_members_of_equal_name_keep_their_content(spark, tmp_path):
    (tmp_path / "dup.zip").write_bytes(_zip([("m", b"12345"), ("m", b"1234567"), ("d/", b"")]))
    by_path = archives.expand_archive_files(spark, str(tmp_path)).collect()
    by_rows = archives.expand_archives(archives.scan_archives(spark, str(tmp_path))).collect()
    assert sorted(bytes(r.content) for r in by_path) == sorted(bytes(r.content) for r in by_rows) == [b"12345", b"1234567"]


def test_packed_bytes_are_the_same_on_every_run(spark):
    df = spark.createDataFrame([("a.zip", f"m{i}", b"x" * i) for i in range(5)], "archive string, member string, content binary").coalesce(1)
    first, second = (archives.pack_archives(df).first().content for _ in range(2))
    assert bytes(first) == bytes(second)


def test_a_missing_archive_folder_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)not_found|does not exist"):
        archives.scan_archives(spark, str(tmp_path / "none"))
    assert archives.scan_archives(spark, str(tmp_path)).count() == 0


def test_a_task_holds_a_bounded_part_of_its_open_archives(spark):
    import random

    rows = [(f"a{i % 10}.zip", f"m{i}", random.Random(i).randbytes(2_000)) for i in range(600)] + [("a0.zip", f"e{i}", b"") for i in range(300)]
    df = spark.createDataFrame(rows, "archive string, member string, content binary").coalesce(1)
    packed = archives.pack_archives(df, max_held=100_000)
    sizes = [r.length for r in packed.select("length").collect()]
    # with ten archives open at once none can hold more than all are allowed to
    assert len(sizes) > 10 and max(sizes) <= 110_000
    back = archives.expand_archives(packed).select("dest", "member", "content").collect()
    assert sorted((r.dest.split("/")[0] + ".zip", r.member, bytes(r.content)) for r in back) == sorted(rows)
    # empty members have a cost too: their entries in the directory are held until the archive is closed
    empty = spark.createDataFrame([("a.zip", f"e{i}", b"") for i in range(1000)], "archive string, member string, content binary").coalesce(1)
    assert archives.pack_archives(empty, max_held=100_000).count() >= 10


def test_empty_members_fill_a_batch():
    cols = ["archive", "member", "length", "content"]
    rows = [("a.zip", f"m{i}", 0, b"", None) for i in range(10)] + [("a.zip", None, None, None, "bad zip")]
    frames = list(archives._in_batches(iter(rows), cols, 4 * archives.MEMBER_BYTES))
    assert [len(f) for f in frames] == [4, 4, 3] and list(frames[0].columns) == cols
    assert [m for f in frames for m in f["member"]] == [r[1] for r in rows]
