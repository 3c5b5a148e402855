"""Hot keys: the adaptive join splits them, and totals per group never hold a whole group."""

import pytest
from pyspark.sql import functions as F

from altimart.operators import skew
from altimart.operators.skew import lookup_join, with_group_totals

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def sliced(spark):
    """Partitions count as hot from two kilobytes on."""
    before = {name: spark.conf.get(name) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture(scope="module")
def hot(spark):
    """10,000 rows: a third on key 'A', a sixth without key, the rest on 500 keys."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit("A")).when(n % 6 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("k"), (n % 500).cast("string"))
    )
    return spark.range(0, 10_000, numPartitions=8).select(n, key.alias("key"), (n % 7).alias("v"))


def _same(a, b):
    assert a.columns == b.columns or set(a.columns) == set(b.columns)
    b = b.select(*a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _ran(df) -> str:
    """The plan that ran, with what adaptive execution made of it."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_settings_are_in_force(spark):
    assert {name: spark.conf.get(name) for name in skew.SETTINGS} == skew.SETTINGS
    skew.prepare(spark)


@pytest.mark.parametrize("key", ["A", None])
def test_hot_key_is_split(spark, hot, sliced, key):
    """No task holds a hot key, or the rows without one, as a whole; all rows join."""
    right = spark.range(400).select(F.concat(F.lit("k"), "id").alias("key"), "id").withColumnRenamed("id", "w")
    right = right.unionByName(spark.createDataFrame([("A", 1), (None, 2)], "key string, w long"))
    # totals are partitioned by the key already
    right = right.groupBy("key").agg(F.sum("w").alias("w"))
    out = lookup_join(hot, right, "key")
    assert out.columns == ["key", "id", "v", "w"]
    _same(hot.join(right, "key", "left"), out)
    assert "skew=true" in _ran(out)
    sizes = out.withColumn("p", F.spark_partition_id()).where(F.col("key").eqNullSafe(key)).groupBy("p").count().collect()
    assert sum(r["count"] for r in sizes) == (3334 if key else 1667)
    assert len(sizes) > 1


def test_group_totals_equal_a_window(spark, hot, sliced):
    rows = hot.where("key is not null")
    out = with_group_totals(rows, "key", {"n": F.count(F.lit(1)), "top": F.max("v")})
    window = rows.selectExpr(
        "key", "id", "v", "count(*) over (partition by key) n", "max(v) over (partition by key) top"
    )
    _same(out, window)
    assert "skew=true" in _ran(out)


def test_two_keys_and_two_right_sides(spark, hot, sliced):
    left = hot.withColumn("k2", F.col("id") % 2)
    first = left.groupBy("key", "k2").agg(F.sum("v").alias("s"))
    second = left.groupBy("key", "k2").agg(F.max("v").alias("m"))
    plain = left.join(first, ["key", "k2"], "left").join(second, ["key", "k2"], "left")
    _same(plain, lookup_join(left, [first, second], ["key", "k2"]))


def test_composing_runs_no_job(spark, hot):
    context = spark.sparkContext
    context.setJobGroup("composing", "")
    lookup_join(hot, hot.groupBy("key").agg(F.sum("v").alias("s")), "key")
    assert not context.statusTracker().getJobIdsForGroup("composing")
    context.setLocalProperty("spark.jobGroup.id", None)


def test_each_use_of_a_sheet_is_one_scan(spark):
    """A staged sheet with its totals reads the sheet for the rows and once for the totals."""
    from conftest import TINY

    from altimart.queries import marts

    def scans(name):
        m = marts(spark, TINY)
        plan = m[name]._jdf.queryExecution().optimizedPlan().toString()
        once = m.sheets[sheet]._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Relation ") / once.count("Relation ")

    for name, sheet in (("stg_competitor_context", "competitor_context"), ("stg_loyalty_activity", "loyalty_activity")):
        assert scans(name) <= 2


@pytest.fixture(scope="module")
def skewed_tables(tmp_path_factory):
    """The tiny tables with a third of all bookings on one customer and one flight."""
    import duckdb
    from conftest import TINY

    folder = tmp_path_factory.mktemp("skewed")
    changes = {
        "orders": "* replace (case when o_orderkey % 3 = 0 then 3 else o_custkey end as o_custkey)",
        "lineitem": "* replace (case when hash(l_orderkey, l_linenumber, l_shipdate) % 3 = 0 then 7"
        " else l_partkey end as l_partkey)",
        "events": "* replace (case when event_id % 3 = 0 then 1 else user_id end as user_id)",
    }
    con = duckdb.connect()
    for name in ("nation", "supplier", "part", "customer", *changes):
        con.execute(
            f"copy (select {changes.get(name, '*')} from read_parquet('{TINY}/{name}.parquet'))"
            f" to '{folder}/{name}.parquet' (format parquet)"
        )
    return str(folder)


@pytest.mark.parametrize("name", ["fct_bookings", "fct_tickets", "win_loyalty", "graph_customer_metrics"])
def test_queries_on_skewed_tables(spark, sliced, skewed_tables, name):
    from compare import differences, open_tables

    from __spark_entry__ import oracle_sql, queries
    df = queries()[name](spark, skewed_tables)
    assert differences(df, open_tables(skewed_tables), oracle_sql()[name]) == []
