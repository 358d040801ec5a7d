import os

import pytest
from pyspark.sql import functions as F

from tripflow.operators import number_rows, rank_rows, running_total
from tripflow.operators.fingerprint import fingerprint
from tripflow.session import checkpoint_root, materialise, scratch_scope


def folders(spark):
    root = checkpoint_root(spark).removeprefix("file://")
    return {f for f in os.listdir(root) if f.startswith("work-")} if os.path.isdir(root) else set()


def test_scopes_leave_nothing_behind(spark):
    before = folders(spark)
    rows = spark.range(300).select("id", (F.col("id") % 7).alias("k"))
    for work in (
        lambda: number_rows(rows, ["k"], ranges=3, hot_copies=1).count(),
        lambda: rank_rows(rows, ["k"], ranges=3).count(),
        lambda: running_total(rows, "id", ["k"], ranges=3, groups=["k"]).count(),
    ):
        with scratch_scope(spark):
            assert work() == 300
            assert folders(spark) > before
        assert folders(spark) == before
    with pytest.raises(RuntimeError), scratch_scope(spark):
        materialise(rows)
        raise RuntimeError
    assert folders(spark) == before


def test_kept_frames_outlive_their_scope(spark):
    before = folders(spark)
    with scratch_scope(spark) as outer:
        with scratch_scope(spark) as keep:
            ranked = keep(rank_rows(spark.range(50), ["id"], ranges=3))
        assert ranked.count() == 50 and len(folders(spark) - before) == 1
        last = outer(ranked.filter("rank <= 5"))
    assert last.count() == 5 and len(folders(spark) - before) == 1


def test_fingerprint_ignores_order_and_layout(spark):
    rows = spark.range(100).selectExpr("id", "CAST(id AS STRING) AS `a.b`", "id / 8 AS x", "array(id) AS xs", "IF(id % 3 = 0, NULL, 'n') AS n")
    one = fingerprint(rows).first()
    assert one == fingerprint(rows.repartition(7).orderBy(F.desc("id")).select("n", "x", "`a.b`", "id")).first() and one["n"] == 100
    assert one != fingerprint(rows.filter("id > 0")).first() and one != fingerprint(rows.union(rows.limit(1))).first()
    assert one != fingerprint(rows.fillna("-", ["n"])).first()
    assert tuple(fingerprint(rows.limit(0)).first()) == (0, "0")
