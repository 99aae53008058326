"""Listing rules, path checks, file writes, copies and the COCO JSON reader."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxwise.sinks import files as fo
from boxwise.sources import coco_json as cj
from boxwise.sources import files as fi


def _tree(tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / ".hid" / "c").mkdir(parents=True)
    for p, body in {"top.txt": "t", "a/x.jpg": "xx", "a/.secret.jpg": "s", "a/b/y.txt": "",
                    ".hid/z.txt": "zzz", ".hid/c/w.jpg": "w", ".dotfile": "d"}.items():
        (tmp_path / p).write_text(body)
    return str(tmp_path)


def test_listing_rules(spark, tmp_path):
    root = _tree(tmp_path)
    flat = {r["rel_path"] for r in fi.list_files(spark, root).collect()}
    assert flat == {"top.txt", "a", ".hid"}
    rec = {r["rel_path"] for r in fi.list_files(spark, root, recursive=True).collect()}
    assert rec == {"top.txt", "a", "a/b", "a/x.jpg", "a/b/y.txt", ".hid", ".hid/c", ".hid/z.txt", ".hid/c/w.jpg"}
    jpg = {r["rel_path"] for r in fi.list_files(spark, root, list_dir=False, suffix=".jpg", recursive=True).collect()}
    assert jpg == {"a/x.jpg", ".hid/c/w.jpg"}
    with pytest.raises(TypeError):
        fi.list_files(spark, root, suffix=".jpg")
    with pytest.raises(TypeError):
        fi.list_files(spark, root, list_dir=False, suffix=["x"])
    keys = {r["rel_path"] for r in fi.list_prefix(spark, root, "a").collect()}
    assert keys == {"x.jpg", ".secret.jpg", "b/y.txt"}


def test_scan_reads_empty_files_and_text(spark, tmp_path):
    root = _tree(tmp_path)
    got = {r["rel_path"]: r["length"] for r in fi.scan_images(spark, root, suffixes=(".txt",)).collect()}
    assert got == {"top.txt": 1, "a/b/y.txt": 0, ".hid/z.txt": 3}
    (tmp_path / "latin.txt").write_bytes("caf\xe9".encode("latin-1"))
    t = {r["rel_path"]: r["text"] for r in fi.read_text_files(spark, root, encoding="iso-8859-1").collect()}
    assert t["latin.txt"] == "caf\xe9"


def test_path_check(spark, tmp_path):
    root = _tree(tmp_path)
    rep = fi.path_check(spark, {"imgs": (root + "/a", "dir")})
    assert rep.first()["ok"]
    with pytest.raises(FileNotFoundError, match="no file at"):
        fi.path_check(spark, {"ann": (root + "/missing.json", "file")})
    assert fi.exists(spark, root + "/top.txt") and fi.isfile(spark, root + "/top.txt") and fi.isdir(spark, root + "/a")


def test_put_and_copy(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = [(f"{out}/d{i % 3}/f{i}.bin", bytes([i]) * i) for i in range(20)]
    w = fo.put_files(spark.createDataFrame(rows, "path string, content binary"))
    assert sum(r["nbytes"] for r in w.collect()) == sum(range(20))
    dst = str(tmp_path / "copy")
    c = fo.copy_tree(spark, out, dst, parallelism=4).collect()
    assert len(c) == 20 and all(r["status"] == "ok" for r in c)
    assert (tmp_path / "copy" / "d1" / "f7.bin").read_bytes() == bytes([7]) * 7


def test_copy_of_mixed_sizes_in_balanced_tasks(spark, tmp_path):
    """One large file and many small ones: equal tasks, whole files, a rest after a failure."""
    src, dst = tmp_path / "src", tmp_path / "dst"
    for d in range(20):
        (src / f"d{d}").mkdir(parents=True)
    for i in range(2000):
        (src / f"d{i % 20}" / f"{i}.bin").write_bytes(bytes([i % 251]) * (i % 90))
    big = np.random.default_rng(0).integers(0, 256, 64 << 20, dtype=np.uint8).tobytes()
    (src / "d3" / "big.bin").write_bytes(big)
    plan = fo.copy_plan(fi.list_prefix(spark, str(src)), tasks=16, part_bytes=1 << 20)
    load = [r.w for r in plan.groupBy("task").agg(F.sum(F.col("size") + fo.FILE_COST).alias("w")).collect()]
    mean = sum(load) / len(load)
    assert len(load) == 16 and max(load) < mean + (1 << 20) + fo.FILE_COST and min(load) > 0.5 * mean
    report = {r.rel_path: (r.nbytes, r.status) for r in fo.copy_tree(spark, str(src), str(dst), parallelism=16, part_bytes=1 << 20).collect()}
    assert len(report) == 2001 and all(s == "ok" for _, s in report.values()) and report["d3/big.bin"][0] == len(big)
    assert (dst / "d3" / "big.bin").read_bytes() == big
    assert all((dst / f"d{i % 20}" / f"{i}.bin").read_bytes() == bytes([i % 251]) * (i % 90) for i in range(0, 2000, 37))
    assert sorted(p.name for p in dst.iterdir()) == sorted(f"d{d}" for d in range(20))


def test_copy_goes_on_from_a_report(spark, tmp_path):
    src, dst = tmp_path / "src", tmp_path / "dst"
    src.mkdir()
    for i in range(30):
        (src / f"{i}.bin").write_bytes(b"x" * i)
    first = fo.copy_tree(spark, str(src), str(dst), parallelism=3)
    held = first.where("nbytes < 20")
    for i in range(30):
        (dst / f"{i}.bin").write_bytes(b"old")
    (src / "5.bin").write_bytes(b"changed")                  # not the reported size any more
    rows = fo.copy_tree(spark, str(src), str(dst), parallelism=3, done=held).collect()
    again = {r.rel_path: r.nbytes for r in rows}
    assert len(rows) == len(again) == 30 and again["5.bin"] == 7
    assert (dst / "5.bin").read_bytes() == b"changed" and (dst / "25.bin").read_bytes() == b"x" * 25
    assert (dst / "3.bin").read_bytes() == b"old"            # reported as copied: left alone


def test_killed_attempt_leaves_no_half_file(tmp_path):
    from pyarrow import fs as pafs
    fs = pafs.LocalFileSystem()

    def dies(out):
        out.write(b"half")
        raise KeyboardInterrupt

    path, aside = str(tmp_path / "to" / "file"), str(tmp_path / "run" / "0-1")
    with pytest.raises(KeyboardInterrupt):
        fo.write_whole(fs, path, aside, dies)
    assert not (tmp_path / "to" / "file").exists()
    assert fo.write_whole(fs, path, str(tmp_path / "run" / "0-2"), lambda o: o.write(b"whole") or 5) == 5
    assert (tmp_path / "to" / "file").read_bytes() == b"whole"


def test_coco_json_with_mixed_segmentation(spark, tmp_path):
    doc = {"images": [{"id": 1, "file_name": "000000000001.jpg", "height": 10, "width": 20}],
           "annotations": [{"id": 5, "image_id": 1, "category_id": 3, "bbox": [1, 2, 3, 4], "iscrowd": 0,
                            "segmentation": [[1, 2, 3]], "area": 12.0},
                           {"id": 6, "image_id": 1, "category_id": 3, "bbox": [0.5, 0, 1, 1], "iscrowd": 1,
                            "segmentation": {"counts": [1, 2], "size": [10, 20]}, "area": 1.0}],
           "categories": [{"id": 3, "name": "cat"}, {"id": 1, "name": "dog"}]}
    p = tmp_path / "instances.json"
    p.write_text(json.dumps(doc, indent=2))
    im, ann, cats = cj.read_coco_json(spark, str(p))
    assert im.count() == 1
    a = {r["id"]: r for r in ann.collect()}
    assert (a[5]["x"], a[5]["h"], a[6]["iscrowd"]) == (1.0, 4.0, 1)
    assert [r["id"] for r in cats.orderBy("pos").collect()] == [3, 1]


def test_missing_root_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        fi.list_files(spark, str(tmp_path / "nowhere"))
    with pytest.raises(FileNotFoundError):
        fo.copy_tree(spark, str(tmp_path / "nowhere"), str(tmp_path / "copy"))


def test_paths_of_other_stores():
    from boxwise.sources.fsutil import as_uri
    assert as_uri("s3a://bucket/data", "bucket/data/x.jpg") == "s3a://bucket/data/x.jpg"
    assert as_uri("hdfs://name:8020/data", "/data/a/x.jpg") == "hdfs://name:8020/data/a/x.jpg"
    assert as_uri("/data", "/data/x.jpg") == "/data/x.jpg"


def test_compressed_files_are_copied_as_they_are(spark, tmp_path):
    import gzip
    (tmp_path / "src").mkdir()
    body = gzip.compress(b"hello" * 100)
    (tmp_path / "src" / "a.gz").write_bytes(body)
    fo.copy_tree(spark, str(tmp_path / "src"), str(tmp_path / "dst"))
    assert (tmp_path / "dst" / "a.gz").read_bytes() == body
    assert fi.read_files(fi.list_files(spark, str(tmp_path / "src"), list_dir=False)).first()["length"] == len(body)


def test_writes_happen_once(spark, tmp_path):
    path = str(tmp_path / "once" / "a.txt")
    report = fo.put_files(spark.createDataFrame([(path, "x")], "path string, content string"))
    (tmp_path / "once" / "a.txt").write_text("changed")
    assert report.count() == 1 and report.count() == 1
    assert (tmp_path / "once" / "a.txt").read_text() == "changed"


def test_no_shuffle_carries_image_bytes(spark, tmp_path):
    """Bytes are read behind the join of records and listing, files listed twice or not at all included."""
    root = _tree(tmp_path)
    im = spark.createDataFrame([(1, root + "/a/x.jpg"), (2, root + "/.hid/c/w.jpg"), (3, root + "/lost.jpg"), (4, "file:" + root + "/a/x.jpg")],
                               "id int, path string")
    listing = fi.list_files(spark, root, list_dir=False, suffix=fi.IMAGE_SUFFIXES, recursive=True)
    got = fi.attach_image_bytes(im, listing)
    assert sorted((r.id, r.length, bytes(r.content)) for r in got.collect()) == [(1, 2, b"xx"), (2, 1, b"w"), (4, 2, b"xx")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "content" not in "".join(line for line in plan.splitlines() if "Exchange" in line or "Sort" in line)
    assert plan.index("MapInArrow") < plan.index("SortMergeJoin")
