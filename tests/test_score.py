"""Batch scoring loads a model once per Python worker."""

import os
import uuid

import pandas as pd

from boxwise import fixtures as fx
from boxwise.operators import score as sc


def test_one_load_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def loader():
        open(os.path.join(folder, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()
        return 2

    def predict(model, pdf):
        return pd.DataFrame({"id": pdf["id"], "v": pdf["id"] * model})

    df = spark.range(0, 640, numPartitions=32)
    for _ in range(2):
        assert sc.batch_score(df, loader, predict, "id long, v long").where("v <> 2 * id").count() == 0
    loads = [n.split("-")[0] for n in os.listdir(folder)]
    assert len(loads) == len(set(loads)) <= 32


def test_two_loaders_do_not_share_a_model(spark):
    def one():
        return 1

    def two():
        return 2

    def predict(model, pdf):
        return pd.DataFrame({"v": [model] * len(pdf)})

    df = spark.range(0, 10, numPartitions=2)
    got = [{r["v"] for r in sc.batch_score(df, f, predict, "v long").collect()} for f in (one, two)]
    assert got == [{1}, {2}]


def test_prototype_detector_reads_its_weights_on_the_worker(spark, sf):
    """Nearest canvas prototypes and their boxes, against a plain loop."""
    from boxwise.session import scratch_path
    im, an, ca = fx.images(spark, sf), fx.annotations(spark, sf), fx.categories(spark, sf)
    weights = sc.fit_prototypes(im, an, ca)
    path = scratch_path(spark, "t-weights")
    sc.save_weights(weights, path)
    got = {}
    for r in sc.batch_score(im, sc.PrototypeLoader(path), sc.predict_prototypes, sc.DETECTIONS, key=path).collect():
        got.setdefault(r.image_id, []).append(r)
    w = sorted((r.asDict() for r in weights.collect()), key=lambda r: r["category_id"])
    assert len(w) == 25 and len(got) == im.count()
    for i in im.limit(50).collect():
        gaps = sorted(((i.width - p["width"]) ** 2 + (i.height - p["height"]) ** 2, p["category_id"], p["x"] * i.width / p["width"]) for p in w)
        mine = sorted(got[i.id], key=lambda r: r.det_id)
        assert [r.category_id for r in mine] == [g[1] for g in gaps[:2]]
        assert all(abs(r.x1 - g[2]) < 1e-9 and 0 < r.score <= 1 for r, g in zip(mine, gaps))
