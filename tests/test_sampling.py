import pytest
from pyspark.sql import functions as F

from tripflow.operators.sampling import hash_bound, sample_by_hash


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(5_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("k"), F.array("id").alias("a"))


def ids(df):
    return sorted(r.id for r in df.collect())


def test_layout_does_not_matter(rows):
    some = ids(sample_by_hash(rows, 0.1, 42, ["id"]))
    assert some == ids(sample_by_hash(rows.repartition(13, "k").orderBy(F.desc("id")), 0.1, 42, ["id"]))
    assert 400 < len(some) < 600 and some != ids(sample_by_hash(rows, 0.1, 43, ["id"]))
    assert set(some) < set(ids(sample_by_hash(rows, 0.3, 42, ["id"])))


def test_bounds(rows):
    assert ids(sample_by_hash(rows, 0, 1)) == [] and len(ids(sample_by_hash(rows, 1, 1))) == 5_000
    assert 0 < len(ids(sample_by_hash(rows, 0.05, 1))) < 500
    assert hash_bound(0.5) == "80000000"
    with pytest.raises(ValueError):
        sample_by_hash(rows, 1.5, 1)


def test_equal_keys_stay_together(rows):
    kept = {r.k for r in sample_by_hash(rows, 0.5, 3, ["k"]).select("k").distinct().collect()}
    assert sample_by_hash(rows, 0.5, 3, ["k"]).count() == sum(r["count"] for r in rows.groupBy("k").count().collect() if r.k in kept)


def test_no_shuffle(rows):
    plan = sample_by_hash(rows, 0.1, 42)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
