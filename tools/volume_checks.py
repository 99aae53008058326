"""Volume checks of the skew paths against their single-task equivalents.

* ranking: range-split positions and running sums vs a plain window (sf0.1 annotations)
* NMS: every group forced through the distributed rounds vs the array walk (sf0.01 detections)

Usage: python tools/volume_checks.py [sf0.1_dir] [sf0.01_dir]
"""

from __future__ import annotations

import sys
import time

sys.path.insert(0, ".")


def main() -> None:
    big = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    small = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    from pyspark.sql import functions as F

    from boxwise import fixtures as fx
    from boxwise.functions.draws import order_key
    from boxwise.operators import postprocess as pp
    from boxwise.plans.ranking import ranked
    from boxwise.session import get_session
    spark = get_session("local[8]", shuffle_partitions=16)

    a = fx.annotations(spark, big).select("id", "category_id", "iscrowd").withColumn("k", order_key("id"))
    w = ranked(a, ["k", "id"], partitions=1).select("id", F.col("pos").alias("p1"))
    r = ranked(a, ["k", "id"], partitions=64).select("id", F.col("pos").alias("p2"))
    print("ranking, global: rows", a.count(), "differences", w.join(r, "id").where("p1 <> p2").count())
    g1 = ranked(a, ["k", "id"], group=["category_id"], partitions=1, sums=["iscrowd"])
    g2 = ranked(a, ["k", "id"], group=["category_id"], sums=["iscrowd"], partitions=64)
    d = g1.select("id", F.col("pos").alias("p1"), F.col("iscrowd_cum").alias("c1")).join(
        g2.select("id", F.col("pos").alias("p2"), F.col("iscrowd_cum").alias("c2")), "id")
    print("ranking, grouped with running sums: differences", d.where("p1 <> p2 OR c1 <> c2").count())

    det = pp.confidence_filter(fx.detections(spark, small), 0.1)
    for agnostic in (False, True):
        t = time.time()
        x = {r[0] for r in pp.nms(det, iou_thr=0.5, class_agnostic=agnostic, max_group=None).select("det_id").collect()}
        y = {r[0] for r in pp.nms(det, iou_thr=0.5, class_agnostic=agnostic, max_group=5).select("det_id").collect()}
        print(f"nms (class_agnostic={agnostic}): kept {len(x)} / {len(y)}, equal={x == y} ({time.time() - t:.1f}s)")


if __name__ == "__main__":
    main()
