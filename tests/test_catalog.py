from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from lattica.functions.udfs import foreach_row, split_errors
from lattica.operators import catalog as C
from lattica.operators import sampling
from lattica.sources import catalogs as R


def pairs(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_overlay_is_cell_wise_and_idempotent(spark):
    a = spark.createDataFrame([("k1", 1, None), ("k2", None, "a")], "sha256 string, n int, s string")
    b = spark.createDataFrame([("k1", 9, "b"), ("k3", 3, "c")], "sha256 string, n int, s string")
    c = spark.createDataFrame([("k2", 7.0)], "sha256 string, extra double")
    want = [("k1", 1, "b", None), ("k2", None, "a", 7.0), ("k3", 3, "c", None)]
    got = C.overlay([a, b, c])
    key = lambda r: r[0]
    assert sorted(((r.sha256, r.n, r.s, r.extra) for r in got.collect()), key=key) == want
    again = C.overlay([got, a, b, c])
    assert sorted(((r.sha256, r.n, r.s, r.extra) for r in again.collect()), key=key) == want
    merged = C.merge_records(a, {"part_1": b, "part_0": spark.createDataFrame([("k1", 5)], "sha256 string, n int")})
    assert {r.sha256: r.n for r in merged.collect()}["k1"] == 9


def test_overlay_pushes_key_filters(spark, sf):
    a = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("k"), "o_custkey")
    plan = C.overlay([a, a.withColumn("o_custkey", F.lit(1).cast("long"))], "k").where("k = 7")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(o_orderkey,7)") >= 1


def test_duplicate_keys_fail(spark):
    df = spark.createDataFrame([("a",), ("a",)], "sha256 string")
    with pytest.raises(ValueError, match="isn't a key"):
        C.assert_keyed(df, "sha256")
    two = spark.createDataFrame([("a", 1), ("a", 2)], "sha256 string, n int")
    assert C.overlay_join(two, two).count() == 4


def test_three_valued_predicates(spark):
    df = spark.createDataFrame([(1, True, 5.0), (2, False, 4.5), (3, None, math.nan), (4, True, None), (5, None, 4.0)], "i int, done boolean, score double")
    ids = lambda p: [r.i for r in df.where(p).orderBy("i").collect()]
    assert ids(C.at_least("score", 4.5)) == [1, 2]
    assert ids(C.flag_true("done")) == [1, 4]
    assert ids(C.not_done(df, "done")) == [2, 3, 5]
    assert ids(C.not_done(df, "absent")) == [1, 2, 3, 4, 5]
    assert ids(C.any_flag("done")) == [1, 4]
    assert ids(C.any_not_done(df, ["done", "absent"])) == [1, 2, 3, 4, 5]
    assert ids(C.missing(df, "score")) == [4]


@pytest.mark.parametrize("world", [1, 3, 7, 13])
def test_shards_are_a_disjoint_cover(spark, world):
    n = 50
    df = spark.range(n).withColumn("k", F.pmod(F.col("id") * 17, F.lit(101)))
    got = C.with_shard(df, world, "k").collect()
    order = [r.id for r in sorted(got, key=lambda r: r.k)]
    rank = {r.id: r["rank"] for r in got}
    for r in range(world):
        assert [x for x in order if rank[x] == r] == order[n * r // world : n * (r + 1) // world]


def test_priority_keeps_order(spark):
    df = spark.range(10)
    got = {r.i: r.id for r in C.priority_first(df, F.col("id").isin(7, 3), "id").collect()}
    assert [got[i] for i in range(10)] == [3, 7, 0, 1, 2, 4, 5, 6, 8, 9]


def test_entries_and_views(spark):
    df = spark.createDataFrame([("/d/s01_static_camera_distance_v3/o9",)], "p string")
    r = df.select(C.split_entry(F.col("p")).alias("e")).first().e
    assert (r.shard, r.obj) == ("s01", "o9")


def test_asset_counts_skip_empty_objects(spark):
    schema = "objects array<struct<vertices:array<int>,faces:array<int>>>, materials array<struct<baseColorTexture:string,metallicTexture:string,roughnessTexture:string,alphaTexture:string>>"
    df = spark.createDataFrame([([([1, 2, 3], [1]), ([], []), ([1], [])], [("x", None, None, "y"), ("x", None, "z", None)])], schema)
    r = C.asset_counts(df).first()
    assert (r.num_vertices, r.num_faces, r.num_basecolor_tex, r.num_metallic_tex, r.num_roughness_tex, r.num_alpha_tex) == (3, 1, 2, 0, 1, 1)


def test_least_loaded_groups():
    load = [5, 1, 9, 3, 3, 7, 2, 2]
    g = sampling.least_loaded(load, 3)
    sums = [sum(x for x, k in zip(load, g, strict=True) if k == i) for i in range(3)]
    assert max(sums) - min(sums) <= max(load)
    equal = sampling.least_loaded(load, 4, equal=True)
    assert sorted(equal.tolist()) == sorted([0, 1, 2, 3] * 2)
    assert sampling.least_loaded([4, 4, 1], 2).tolist() == [1, 0, 0]  # ties: the later item first, the first group first
    assert sorted(sampling.least_loaded([3, 2, 1], 2, equal=True).tolist()) == [0, 1, 1] and sampling.least_loaded([5], 3, equal=True).tolist() == [0]


def test_balanced_sampler_covers_the_epoch(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "n_chars")
    got = sampling.balanced_sampler(docs, "doc_id", "n_chars", 1, 0, 4, 5).collect()
    n = docs.count()
    assert len(got) == -(-n // 4) * 4 // 20 * 20
    per = {}
    for r in got:
        per.setdefault((r.macro, r["rank"]), []).append(r.doc_id)
    assert {len(x) for x in per.values()} == {5}


def test_sampler_state(spark, tmp_path):
    s = sampling.SamplerState(10).advance(7).advance(5)
    assert (s.epoch, s.idx) == (1, 2)
    s.save(spark, str(tmp_path / "s"))
    again = sampling.SamplerState.load(spark, str(tmp_path / "s"), 10)
    assert (again.epoch, again.idx) == (1, 2)


def test_row_map_keeps_errors(spark):
    def work(row):
        if row["n"] == 0:
            return None
        return {"q": 10 / (row["n"] - 1)}

    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 3)], "sha256 string, n int")
    good, bad = split_errors(foreach_row(df, work, "q double"))
    assert pairs(good, "sha256", "q") == [("c", 5.0)]
    assert [(r.sha256, r.error.split(":")[0]) for r in bad.collect()] == [("b", "ZeroDivisionError")]


def test_catalog_files(spark, tmp_path):
    csv = tmp_path / "aesthetic.csv"
    csv.write_text("sha256,aesthetic_score\na,4.5\nb,NaN\nc,\n")
    got = R.read_catalog(spark, "csv", str(csv), stage="aesthetic_scores")
    assert {r.sha256: r.aesthetic_score for r in got.collect()} == {"a": 4.5, "b": None, "c": None}
    with pytest.raises(ValueError, match="unknown connector"):
        R.read_catalog(spark, "nowhere", "x")
    (tmp_path / "ids.txt").write_text("a\n b \n\n")
    assert pairs(R.read_instances(spark, str(tmp_path / "ids.txt")), "sha256") == [("a",), ("b",)]
    assert pairs(R.read_instances(spark, "x,y"), "sha256") == [("x",), ("y",)]
    folder = tmp_path / "cat"
    R.write_records(spark.createDataFrame([("a", True)], "sha256 string, done boolean"), str(folder), "r1")
    parts = R.pending_records(spark, str(folder))
    assert len(parts) == 1
    R.archive_records(spark, str(folder), parts, "123")
    assert R.pending_records(spark, str(folder)) == []
    assert R.current_catalog(spark, str(folder)) is None
    R.write_catalog(spark.range(3), str(folder), "v1")
    R.write_catalog(spark.range(5), str(folder), "v2")
    assert R.current_catalog(spark, str(folder)).count() == 5


def test_archives_and_outputs(spark, tmp_path):
    import hashlib
    import io
    import tarfile
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("m/x.obj", b"one")
        z.writestr("m/y.txt", b"two")
    with tarfile.open(tmp_path / "b.tar", "w") as t:
        info = tarfile.TarInfo("n/z.obj")
        info.size = 5
        t.addfile(info, io.BytesIO(b"three"))
    got = R.read_archives(spark, str(tmp_path), r".*\.obj")
    assert pairs(got, "member", "sha256") == [("m/x.obj", hashlib.sha256(b"one").hexdigest()), ("n/z.obj", hashlib.sha256(b"three").hexdigest())]
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "k1.vxz").write_bytes(b"x")
    assert pairs(R.existing_outputs(spark, str(tmp_path / "out"), ".vxz"), "sha256") == [("k1",)]
    frames = spark.createDataFrame([("o", 1, b"bb"), ("o", 0, b"a")], "obj string, frame int, content binary")
    row = R.pack_groups(frames, str(tmp_path / "tars"), "obj", "frame", F.format_string("%06d.vxz", "frame"), "content").first()
    with tarfile.open(row.path) as t:
        assert t.getnames() == ["000000.vxz", "000001.vxz"]


def test_json_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"train": ["p/q", "r/s"], "test": ["t/u"]}')
    assert pairs(R.read_annotations(spark, str(tmp_path / "a.json")), "split", "entry") == [("test", "t/u"), ("train", "p/q"), ("train", "r/s")]
    eye = "[[1,0,0,0],[0,1,0,0],[0,0,1,0],[0,0,0,1]]"
    (tmp_path / "c.json").write_text('{"_global": {"static_cameras": [' + ",".join(f'{{"view_index": {i}, "camera_c2w": {eye}}}' for i in range(4)) + "]}}")
    assert pairs(R.read_static_cameras(spark, str(tmp_path / "c.json"), 2, 1), "view_index") == [(1,), (3,)]
    (tmp_path / "t.json").write_text('{"aabb": [[0,0,0],[1,1,1]], "scale": 2.0, "offset": [0,0,0], "frames": [{"file_path": "0.png", "camera_angle_x": 0.5, "transform_matrix": ' + eye + "}]}")
    assert R.read_transforms(spark, str(tmp_path / "t.json")).first().file_path == "0.png"
    (tmp_path / "p0.json").write_text('{"key": "a", "status": "error"}\nnot json\n{"key": "b", "status": "success"}\n')
    (tmp_path / "p1.json").write_text('{"key": "a", "status": "success"}\n')
    assert pairs(R.read_progress(spark, str(tmp_path / "p*.json")), "key", "status") == [("a", "success"), ("b", "success")]


def test_fetch_retries_what_is_missing(spark):
    seen = []

    def fetch(left):
        seen.append(left.count())
        return left.where(F.col("id") % (3 - len(seen) + 1) == 0)

    assert R.fetch_remaining(spark.range(6), "id", fetch).count() == 6
    assert seen[0] == 6 and len(seen) == 3


def test_a_flaky_source_is_asked_once_a_round(spark, tmp_path):
    """What a round saw is what is returned, although the source would answer otherwise if asked again."""
    log = tmp_path / "asked"
    log.mkdir()

    def fetch(left):
        def run(batches):
            import uuid

            for b in batches:
                for i in b.column("id").to_pylist():
                    (log / f"{i}-{uuid.uuid4().hex}").touch()
                yield b

        return left.mapInArrow(run, "id long")

    assert sorted(r.id for r in R.fetch_remaining(spark.range(6), "id", fetch).collect()) == list(range(6))
    assert sorted(f.name.partition("-")[0] for f in log.iterdir()) == list("012345")


def test_progress_order_and_errors(spark, tmp_path):
    (tmp_path / "p0.json").write_text('{"key": "a", "status": "error", "error": "boom"}\n{"key": "a", "status": "success"}\nnot json\n{"status": "no key"}\n')
    r = R.read_progress(spark, str(tmp_path / "p*.json")).collect()
    assert [(x.key, x.status, x.error) for x in r] == [("a", "success", None)]
    assert R.progress_errors(spark, str(tmp_path / "p*.json")).count() == 2


def test_the_current_version_is_replaced_whole(spark, tmp_path):
    folder = str(tmp_path / "cat")
    for i in range(4):
        R.write_catalog(spark.range(i + 1), folder, f"v{i}", keep=2)
        assert R.current_catalog(spark, folder).count() == i + 1
    assert sorted(p.name for p in (tmp_path / "cat" / "versions").iterdir()) == ["v2", "v3"]
    assert [p.name for p in (tmp_path / "cat").iterdir() if p.name.startswith("CURRENT")] == ["CURRENT"]


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    import lattica.session as session

    conf = SimpleNamespace(get=lambda key: None)
    for master in ("yarn", "spark://x:7077", "local-cluster[2,1,1024]"):
        context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master=master)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(SimpleNamespace(sparkContext=context))


def test_dumps_and_obj_files(spark, tmp_path):
    import os
    import pickle

    import numpy as np

    good = {"objects": [{"vertices": np.zeros((2, 3)), "faces": np.array([[0, 1, 1]]), "mat_ids": [0]}], "materials": [{"alphaMode": "OPAQUE", "image": b"x"}]}
    (tmp_path / "a.pickle").write_bytes(pickle.dumps(good))
    (tmp_path / "b.pickle").write_bytes(pickle.dumps({"objects": os.getcwd}))
    got = {r.path[-8:]: r for r in R.read_dumps(spark, str(tmp_path)).collect()}
    assert got["a.pickle"].objects[0].faces == [[0, 1, 1]] and got["a.pickle"].materials == ['{"alphaMode": "OPAQUE"}']
    assert got["b.pickle"].objects is None and "isn't allowed" in got["b.pickle"].error
    (tmp_path / "m.obj").write_text("# x\nv 0 0 0.5\nv 1 0 0\r\nv  0 1 0\nf 1/1 2/2 3/3\nf -3 -2 -1\n")
    r = R.read_obj_meshes(spark, str(tmp_path)).first()
    assert r.vertices == [[0.0, 0.0, 0.5], [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]] and r.faces == [[0, 1, 2], [0, 1, 2]]


def test_variants_become_a_column(spark, tmp_path):
    from pyspark.sql import types as T

    for res in (256, 512):
        spark.createDataFrame([(f"k{res}",)], "sha256 string").write.parquet(str(tmp_path / f"dual_grid_{res}"))
    got = R.read_variants(spark, str(tmp_path), "dual_grid", "res", T.StructType([T.StructField("sha256", T.StringType())]))
    assert pairs(got, "sha256", "res") == [("k256", "256"), ("k512", "512")]
