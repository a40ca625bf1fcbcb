"""Label JSON under a declared schema (FIXTURES.md §2) and the label join."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from filelens.operators import catalogue as C
from filelens.sources import labels as L
from filelens.sources.files import label_paths, paths_to_df


def _doc(i, w=640, h=480, q=(2.6, 1.0, 4.0, 10.0), result="pass"):
    return {"id": f"img_{i}", "image": {"size": {"width": w, "height": h}},
            "dataset": dict(zip(["quality1", "quality2", "quality3", "quality4"], q), result=result)}


@pytest.fixture(scope="module")
def label_dir(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("labels"))
    docs = {
        "img_1.json": _doc(1),
        "img_2.json": _doc(2, q=(2.0, 4.0, 6.0, 1.0), result="fail"),
        "missing_key.json": {"id": "img_3", "image": {"size": {"width": 1}}},
        "extra_key.json": dict(_doc(4), extra={"x": 1}),
        "empty.json": {},
        "array_field.json": dict(_doc(5), tags=["a", "b"]),
        "numeric_id.json": dict(_doc(6), id=6),
    }
    for name, doc in docs.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            json.dump(doc, f, indent=2, ensure_ascii=False)
    return d


@pytest.fixture(scope="module")
def bad_dir(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("bad"))
    with open(os.path.join(d, "good.json"), "w") as f:
        json.dump(_doc(1), f, indent=2)
    with open(os.path.join(d, "broken.json"), "w") as f:
        f.write('{"id": "img_9", "image": ')
    return d


def test_read_labels_schema(spark, label_dir):
    df = L.read_labels(spark, label_dir, with_path=True)
    rows = {r["id"]: r for r in df.collect()}
    assert rows["img_1"]["image"]["size"]["width"] == 640
    assert rows["img_3"]["dataset"] is None or rows["img_3"]["dataset"]["quality1"] is None
    assert rows["6"]["image"]["size"]["height"] == 480  # numeric id read as string
    assert df.schema["id"].dataType.simpleString() == "string"
    assert all(r["label_path"].startswith("/") for r in df.collect())


def test_failfast_and_corrupt(spark, bad_dir):
    with pytest.raises((Py4JJavaError, PySparkException)):
        L.read_labels(spark, bad_dir).collect()
    with pytest.raises(ValueError):
        L.read_labels(spark, bad_dir, mode="PERMISSIVE")
    df = L.read_labels(spark, bad_dir, corrupt_column="_corrupt")
    rows = df.collect()
    assert len(rows) == 2 and sum(r["_corrupt"] is not None for r in rows) == 1


def test_label_catalogue_join(spark, label_dir):
    files = paths_to_df(spark, ["/d/TS/img_1.png", "/d/TS/img_2.jpg", "/d/TS/img_7.png", "/d/TS/img_1.png"])
    files = files.selectExpr("full_path", "10L AS file_size")
    cat = C.file_catalogue(files)
    out = C.label_catalogue(cat, L.read_labels(spark, label_dir))
    assert out.columns == ["full_path", "file_name", "folder_name", "file_size", "width", "height",
                           "밀도", "흡수율", "안전성", "잔입자_통과량", "target_data"]
    rows = out.collect()
    assert len(rows) == 3  # img_1 twice (multiplicity kept), img_2 once, img_7 unmatched
    flagged = C.flag_quality(C.select_label_fields(L.read_labels(spark, label_dir)),
                             fields=dict(C.LABEL_FIELDS))
    r = {x.file_id: x for x in flagged.collect()}
    assert (r["img_1"].q1_ok, r["img_1"].q2_ok, r["img_1"].q3_ok) == (True, True, True)
    assert (r["img_2"].q1_ok, r["img_2"].q2_ok, r["img_2"].q3_ok) == (False, False, False)


def test_join_key_type_mismatch(spark):
    files = spark.createDataFrame([("a", 1)], "file_id string, x int")
    labels = spark.createDataFrame([(1, 2)], "file_id bigint, y int")
    with pytest.raises(TypeError):
        C.join_labels(files, labels)


def test_union_labels_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 3.0)], "id int, b double")
    out = C.union_labels([a, b]).orderBy("id").collect()
    assert [tuple(r) for r in out] == [(1, "x", None), (2, None, 3.0)]


def test_parse_labels(spark):
    df = spark.createDataFrame([('{"k": 5}',), ("not json",)], "props string")
    out = L.parse_labels(df, "props", "k bigint").select("props.k").collect()
    assert [r.k for r in out] == [5, None]


def test_deep_flatten_matches_json_normalize(spark, tmp_path):
    """Multi-file read + flatten(".") equals per-file json_normalize + concat."""
    import pandas as pd

    from filelens.functions.flatten import flatten

    docs = [_doc(1), {"id": "img_2", "image": {"size": {"width": 3}}, "extra": {"a": {"b": 1}}},
            {"id": "img_3", "dataset": {"result": "x"}, "empty": {}}]
    for i, doc in enumerate(docs):
        (tmp_path / f"d{i}.json").write_text(json.dumps(doc, indent=1))
    expected = pd.concat([pd.json_normalize(d) for d in docs], ignore_index=True)
    got = flatten(spark.read.option("multiLine", "true").json(str(tmp_path)), sep=".").toPandas()
    assert sorted(got.columns) == sorted(expected.columns)
    key = "id"
    e = expected.set_index(key).sort_index()
    g = got.set_index(key).sort_index()[e.columns]
    for col in e.columns:
        for a, b in zip(e[col], g[col]):
            assert (pd.isna(a) and pd.isna(b)) or a == b, (col, a, b)


def test_top_level_array_file(spark, tmp_path):
    (tmp_path / "arr.json").write_text(json.dumps([_doc(1), _doc(2)], indent=1))
    df = L.read_labels(spark, str(tmp_path))
    assert sorted(r["id"] for r in df.collect()) == ["img_1", "img_2"]


def test_declared_schema_agrees_with_inference(spark, label_dir):
    """The declared label DDL names the same nested fields Spark infers."""
    inferred = L.infer_schema(spark, label_dir)
    declared = spark.createDataFrame([], L.LABEL_DDL).schema

    def leaves(schema, prefix=""):
        out = set()
        for f in schema.fields:
            if hasattr(f.dataType, "fields"):
                out |= leaves(f.dataType, prefix + f.name + ".")
            else:
                out.add(prefix + f.name)
        return out

    assert leaves(declared) <= leaves(inferred)


def test_join_plans_no_job_and_no_single_task(spark):
    files = spark.range(0, 100).selectExpr("concat('f', CAST(id AS STRING)) AS file_id", "id AS file_size")
    labels = spark.range(0, 100, 2).selectExpr("concat('f', CAST(id AS STRING)) AS file_id", "id AS quality")
    out = C.join_labels(files, labels)
    assert "SinglePartition" not in out._jdf.queryExecution().toString()
    assert out.count() == 50


def test_nested_label_folders_with_pattern(spark, tmp_path):
    for i, sub in enumerate(["a", "a/b", "k=v"]):
        d = tmp_path / sub
        d.mkdir(parents=True, exist_ok=True)
        (d / f"img_{i}.json").write_text(json.dumps(_doc(i), indent=1))
        (d / f"img_{i}.png").write_bytes(b"\x89PNG")
    df = L.read_labels(spark, str(tmp_path), pattern="*.json", recursive=True, with_path=True)
    rows = df.collect()
    assert sorted(r["id"] for r in rows) == ["img_0", "img_1", "img_2"]
    assert all(r["label_path"].endswith(".json") for r in rows)


def test_label_path_is_plain_text(spark, tmp_path):
    d = tmp_path / "라벨 데이터"
    d.mkdir()
    (d / "a+b 1.json").write_text(json.dumps(_doc(1)))
    row = L.read_labels(spark, str(d), with_path=True).first()
    assert row["label_path"] == str(d / "a+b 1.json")


def test_corrupt_column_leaves_given_schema_alone(spark, bad_dir):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.StringType())])
    L.read_labels(spark, bad_dir, schema=schema, corrupt_column="_bad").count()
    assert schema.fieldNames() == ["id"]


def test_non_utf8_label_files(spark, tmp_path):
    doc = _doc(1, result="합격")
    (tmp_path / "k.json").write_bytes(json.dumps(doc, ensure_ascii=False, indent=1).encode("euc-kr"))
    row = L.read_labels(spark, str(tmp_path), encoding="EUC-KR").first()
    assert row["dataset"]["result"] == "합격"


def test_non_utf8_label_files_with_path(spark, tmp_path):
    doc = _doc(2, result="불합격")
    (tmp_path / "k2.json").write_bytes(json.dumps(doc, ensure_ascii=False, indent=1).encode("cp949"))
    row = L.read_labels(spark, str(tmp_path), encoding="cp949", with_path=True, pattern="*.json").first()
    assert row["dataset"]["result"] == "불합격" and row["label_path"].endswith("k2.json")
    assert row["image"]["size"]["width"] == 640


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_random_documents_flatten_like_json_normalize(spark, tmp_path, seed):
    import random
    import warnings

    import pandas as pd

    from filelens.functions.flatten import flatten

    rng = random.Random(seed)

    def tree(depth):
        keys = rng.sample(["a", "b", "c", "d", "e"], rng.randint(1, 4))
        out = {}
        for k in keys:
            if depth < 3 and rng.random() < 0.4:
                out[k] = tree(depth + 1)
            else:
                out[k] = rng.choice(["int", "str", "list"])
        return out

    shape = tree(0)

    def doc(node):
        out = {}
        for k, v in node.items():
            if rng.random() < 0.25:
                continue  # missing key
            if isinstance(v, dict):
                out[k] = doc(v)
            elif rng.random() < 0.1:
                out[k] = None
            elif v == "int":
                out[k] = rng.randint(-5, 5)
            elif v == "str":
                out[k] = rng.choice(["x", "y", "한"])
            else:
                out[k] = [rng.randint(0, 3) for _ in range(rng.randint(0, 2))]
        return out

    docs = [dict(doc(shape), id=f"d{i}") for i in range(60)]
    for i, d in enumerate(docs):
        (tmp_path / f"{i}.json").write_text(json.dumps(d, ensure_ascii=False), encoding="utf-8")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", FutureWarning)
        expected = pd.concat([pd.json_normalize(d) for d in docs], ignore_index=True).set_index("id")
    got = flatten(spark.read.option("multiLine", "true").json(str(tmp_path)), sep=".").toPandas().set_index("id")
    # a column that is null in every document is typed null by Spark and dropped
    # by nothing in pandas; compare the columns that carry a value somewhere
    exp_cols = {c for c in expected.columns if expected[c].notna().any()}
    got_cols = {c for c in got.columns if got[c].notna().any()}
    assert exp_cols == got_cols

    def norm(v):
        if isinstance(v, float) and pd.isna(v) or v is None:
            return None
        if hasattr(v, "tolist"):
            v = v.tolist()
        if isinstance(v, float) and v.is_integer():
            return int(v)
        return v

    for c in exp_cols:
        for key in expected.index:
            assert norm(expected.at[key, c]) == norm(got.at[key, c]), (c, key)


def test_decoded_labels_modes(spark, tmp_path):
    (tmp_path / "good.json").write_bytes(json.dumps(_doc(1), ensure_ascii=False).encode("euc-kr"))
    (tmp_path / "bad.json").write_bytes('{"id": '.encode("euc-kr"))
    assert L.read_labels(spark, str(tmp_path), encoding="EUC-KR", corrupt_column="_raw").count() == 2
    assert L.read_labels(spark, str(tmp_path), encoding="EUC-KR", mode="DROPMALFORMED").count() == 1
    with pytest.raises(Exception):
        L.read_labels(spark, str(tmp_path), encoding="EUC-KR").collect()

    kept = L.read_labels(spark, str(tmp_path), encoding="EUC-KR", corrupt_column="_raw").collect()
    assert sorted(r["_raw"] is None for r in kept) == [False, True]


def test_label_files_with_utf8_bom(spark, tmp_path):
    (tmp_path / "bom.json").write_bytes(json.dumps(_doc(5, result="합격"), ensure_ascii=False).encode("utf-8-sig"))
    for kwargs in ({}, {"encoding": "utf-8-sig"}):
        row = L.read_labels(spark, str(tmp_path), **kwargs).first()
        assert row["id"] == "img_5" and row["dataset"]["result"] == "합격"


def test_label_files_from_a_table_of_paths(spark, tmp_path):
    """The paths stay a table; names of any kind, other charsets, bad documents."""
    for name, text in (("a b.json", json.dumps(_doc(1), indent=1)), ("둘.json", json.dumps(_doc(2), ensure_ascii=False)), ("n.json", json.dumps(dict(_doc(3), id=3)))):
        (tmp_path / name).write_text(text, encoding="utf-8")
    paths = paths_to_df(spark, [str(p) for p in tmp_path.iterdir()])
    rows = {os.path.basename(r.label_path): r for r in L.read_label_files(paths, "full_path").collect()}
    assert {k: r.id for k, r in rows.items()} == {"a b.json": "img_1", "둘.json": "img_2", "n.json": "3"}
    assert rows["둘.json"].image.size.width == 640 and rows["둘.json"].dataset.result == "pass"
    assert L.read_label_files(paths.limit(0), "full_path").count() == 0
    (tmp_path / "bad.json").write_text('{"id": "x", ')
    more = paths_to_df(spark, [str(tmp_path / "bad.json"), str(tmp_path / "n.json")])
    with pytest.raises(Exception, match="(?i)malformed"):
        L.read_label_files(more, "full_path").collect()
    kept = {r.id: r.bad for r in L.read_label_files(more, "full_path", corrupt_column="bad").collect()}
    assert kept == {None: '{"id": "x", ', "3": None}
    with pytest.raises(Exception, match="No such file"):
        L.read_label_files(paths_to_df(spark, [str(tmp_path / "gone.json")]), "full_path").collect()
    (tmp_path / "kr.json").write_bytes(json.dumps({"id": "한글"}, ensure_ascii=False).encode("euc-kr"))
    kr = paths_to_df(spark, [str(tmp_path / "kr.json")])
    assert L.read_label_files(kr, "full_path", schema="id string", encoding="euc-kr").first().id == "한글"


def test_label_files_are_held_in_bounded_frames(spark, tmp_path, monkeypatch):
    names = []
    for k in range(300):  # every third is empty, the others are multi-byte
        names.append(str(tmp_path / f"{k:03d}.json"))
        with open(names[-1], "w", encoding="utf-8") as f:
            f.write("" if k % 3 == 0 else json.dumps({"id": "한" * 400 + str(k)}, ensure_ascii=False))
    monkeypatch.setattr(L, "LABEL_BYTES", 20 * L.FILE_BYTES)
    frames = list(L._texts(iter(names), "utf-8"))
    assert [n for frame in frames for n in frame["label_path"]] == names and max(map(len, frames)) <= 20
    assert sum(len(t.encode()) for t in frames[0]["text"]) <= 20 * L.FILE_BYTES
    rows = L.read_label_files(paths_to_df(spark, [n for k, n in enumerate(names) if k % 3]), "full_path", schema="id string").collect()
    assert sorted(r.id for r in rows) == sorted("한" * 400 + str(k) for k in range(300) if k % 3)


def test_label_files_are_read_in_a_stage_after_their_listing(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text('{"id": "1"}')
    got = L.read_label_files(label_paths(spark, str(tmp_path / "a*")))
    plan = got._jdf.queryExecution().executedPlan().toString()
    read, listing = plan.index("MapInPandas read"), plan.index("BatchScan")
    assert "Exchange" in plan[read:listing] and [r.id for r in got.collect()] == ["1"]
