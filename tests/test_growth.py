"""Reductions that keep a query's shuffles small, against the plain joins they stand for."""

import os
import re
import time

import numpy as np
from conftest import TINY
from pyspark.sql import functions as F

from altimart.llm import lm, ngram_join, text
from altimart.llm.components import components
from altimart.operators.skew import lookup_join
from altimart.plans import build, facts
from altimart.queries import AS_OF, FLIGHT_COLUMNS, QUERIES, SHARED_ENTITIES, marts
from altimart.sources import sinks


def _rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def _odd(m):
    """Staged bookings, flights, customers and extras with repeated, missing and unknown keys."""
    def some(df, key, every, **changed):
        return df.where(F.crc32(F.coalesce(key, F.lit(""))) % every == 0).withColumns(changed)

    none = F.lit(None).cast("string")
    b, f, c = m["stg_bookings"], m["fct_flights"], m["dim_customers"]
    bookings = (
        b.unionByName(some(b, "booking_id", 5)).unionByName(some(b, "booking_id", 7, flight_id=F.lit("F1")))
        .unionByName(some(b, "booking_id", 11, booking_id=none)).unionByName(some(b, "booking_id", 13, customer_id=none))
        .unionByName(some(b, "booking_id", 17, flight_id=none, total_revenue_usd=F.lit(None).cast("double")))
        .unionByName(some(b, "booking_id", 19, customer_id=F.lit("nobody"), flight_id=F.lit("nowhere")))
    )
    flights = f.unionByName(some(f, "flight_id", 3, flight_date=F.date_add("flight_date", 400)))
    customers = c.unionByName(some(c, "customer_id", 3)).unionByName(some(c, "customer_id", 9))
    return bookings, flights, customers, m["stg_ancillary_details"]


def test_customer_bookings_equal_the_fact_added_up(spark):
    parts = _odd(marts(spark, TINY, ("stg_bookings", "fct_flights", "dim_customers")))
    want = facts.bookings_per_customer(facts.fct_bookings(*parts, AS_OF))
    got = facts.customer_bookings(*parts, AS_OF)
    assert got.columns == want.columns and _rows(got) == _rows(want)


def _shuffles(spark) -> set[str]:
    """The shuffles with files on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
    return set(re.findall(r"shuffle_(\d+)_\d+_\d+\.data", files))


def _left(spark, before: set[str]) -> set[str]:
    """New shuffles that still have files, some time after they were let go."""
    for _ in range(50):
        if not _shuffles(spark) - before:
            break
        time.sleep(0.1)
    return _shuffles(spark) - before


def test_shuffle_files_go_once_a_table_is_written(spark, tmp_path):
    frame = spark.range(1000).repartition(4, "id").groupBy(F.col("id") % 7).count()
    before = _shuffles(spark)
    frame.count()
    assert _shuffles(spark) - before  # they stay after other jobs
    before = _shuffles(spark)
    table = sinks.write_model(frame, str(tmp_path / "t"))
    assert _left(spark, before) == set()
    assert _rows(table) == _rows(frame)


def test_the_booking_fact_is_written_in_slices(spark, monkeypatch):
    """Odd keys included; no slice finds shuffle files of another, and none is left."""
    names = ("stg_bookings", "fct_flights", "dim_customers", "stg_ancillary_details")
    m = marts(spark, TINY)
    m._models.update(zip(names, _odd(marts(spark, TINY, names))))
    want = m["fct_bookings"]
    paths, found, calls, before = [], [], [], set()

    def noted(df, path, *args, write=sinks.write_model, **options):
        if not paths:
            before.update(_shuffles(spark))
        found.append(_left(spark, before))
        paths.append(path)
        return write(df, path, *args, **options)

    monkeypatch.setattr(build, "SLICE_ROWS", 1000)
    monkeypatch.setattr(sinks, "write_model", noted)
    monkeypatch.setattr(build, "write_model", noted)
    got = build.bookings_in_slices(m, lambda: calls.append(len(paths)))
    slices = [p for p in paths if "/fct_bookings-" in p]
    assert len(slices) > 4 and calls == [len(paths) - len(slices)] and not any(found)
    assert not [f for p in paths if "/booked-" in p or "/booked_extras-" in p for f in os.listdir(p) if "slice" in f]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.columns == want.columns and _rows(got) == _rows(want)


def test_the_query_of_bookings_equals_its_sql_in_slices(spark, tables, monkeypatch):
    from compare import differences

    from __spark_entry__ import oracle_sql

    monkeypatch.setattr(build, "SLICE_ROWS", 700)
    df = QUERIES["fct_bookings"](spark, TINY)
    # the items sold are not kept beside the fact
    assert all("/fct_bookings-" in f for f in df.inputFiles())
    assert differences(df, tables, oracle_sql()["fct_bookings"]) == []


def test_booking_ids_are_shuffled_to_their_extras_only(spark):
    """Once for the bookings and once for the extras; neither flights nor customers meet them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = marts(spark, TINY)["customer_performance"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1MB")
    assert plan.count("hashpartitioning(booking_id") == 2
    assert "hashpartitioning(customer_id" in plan and ", booking_id" not in "".join(
        line.split("hashpartitioning")[1] for line in plan.splitlines() if "Exchange hashpartitioning" in line
    )


def test_items_sold_are_joined_once_and_flights_written_narrow(spark):
    m = marts(spark, TINY, SHARED_ENTITIES)
    want = marts(spark, TINY)
    assert tuple(m["fct_flights"].columns) == FLIGHT_COLUMNS
    files = [f for name in ("stg_bookings", "stg_ancillary_details") for f in m[name].inputFiles()]
    assert files and all("/sold-" in f for f in files)
    assert _rows(m["customer_metrics"]) == _rows(want["customer_metrics"])
    assert _rows(m["stg_ancillary_details"]) == _rows(want["stg_ancillary_details"])


def test_the_bucketed_figures_write_one_row_a_customer(spark, tmp_path):
    m = marts(spark, TINY)
    done = m.publish(str(tmp_path), buckets=4, prefix="g_", names=["customer_bookings"])
    try:
        table = done["customer_bookings"]
        assert table.count() == table.select("customer_id").distinct().count()
        assert _rows(table) == _rows(marts(spark, TINY)["customer_bookings"])
    finally:
        spark.sql("drop table if exists g_customer_bookings")


def test_hashes_without_memory_and_at_places_equal_the_plain_ones():
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 100, rng.integers(1, 40)).astype(np.uint8)) for _ in range(500)]
    hashes = text.hashed_words(words)
    assert hashes.tolist() == text.word_hashes(words, text.hash_memory()).tolist()
    assert len(text.hashed_words([])) == 0
    at = np.array([0, 3, 4, 200, 487])
    assert text.runs_at(hashes, 13, at).tolist() == text.runs(hashes, 13)[at].tolist()
    assert text.runs_at(hashes, 13, at, backwards=True).tolist() == text.runs(hashes[::-1], 13)[::-1][at].tolist()


def test_a_lookup_carries_a_bit_and_no_whole_hash(spark):
    left = spark.range(1000).withColumn("key", F.concat(F.lit("k"), F.col("id") % 50))
    right = spark.range(40).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("value"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup_join(left, right, "key")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("as tinyint) AS __key_hash") == 2 and out.where("value is null").count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1MB")


def test_neighbours_of_all_words_are_sorted_in_one_go(spark, capsys):
    rng = np.random.default_rng(5)
    rows = [(i, 40, *(int(x) for x in rng.integers(0, 1 << 40, 8))) for i in range(30)]
    rows += [(100 + i, 40, *(x ^ (1 << i if k == 2 else 0) for k, x in enumerate(rows[i][2:]))) for i in range(30)]
    sketches = spark.createDataFrame(rows, "node long, size long, " + ", ".join(f"s{i} long" for i in range(8)))
    found = ngram_join._neighbours(sketches, 85)
    found.explain()
    assert capsys.readouterr().out.count("Exchange rangepartitioning") == 1
    pairs = {(r.a, r.b) for r in found.collect()}
    # one bit of a word that is not sorted by: all other words agree, so the two are side by side in some order
    assert {(i, 100 + i) for i in range(30)} <= pairs
    assert ngram_join._neighbours(sketches.limit(0), 85).count() == 0


def test_rounds_of_components_are_written_once(spark, monkeypatch):
    def checkpoint(*_, **__):
        raise AssertionError("a frame of a round takes two jobs")

    links = spark.createDataFrame([(1, 2), (3, 2), (5, 4), (9, 5), (7, 7)], "a long, b long")
    monkeypatch.setattr(type(links), "checkpoint", checkpoint)
    got = {r.node: r.label for r in components(links).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 9: 4, 7: 7}


def test_grams_are_counted_and_looked_up_without_hashing_each(monkeypatch):
    texts = [b"the cat", b"", b"a" * 300, bytes(range(256)), b"the cat sat on the mat " * 40]
    keys, sizes = lm.grams(texts)
    use = np.repeat([True, False, True, False, True], sizes)
    want, n = np.unique(keys, return_counts=True)
    learnt = [int(use[keys == k].sum()) for k in want]

    def factorize(*_, **__):
        raise AssertionError("every byte's gram is hashed")

    monkeypatch.setattr(lm.pd, "factorize", factorize)
    got, counts = lm.tallied(keys, use)
    assert (got == want).all() and counts.tolist() == learnt and n.sum() == len(keys)
    for tables in (0, 1, 2):
        values = np.arange(len(want), dtype=np.float32)
        assert (lm.Known(want, values, tables).of(keys) == np.searchsorted(want, keys)).all()
    monkeypatch.setattr(lm, "_SPREAD", (np.uint64(0), np.uint64(0)))  # all keys share one slot
    assert (lm.Known(want, values).of(keys) == np.searchsorted(want, keys)).all()
    assert len(lm.Known(want[:0], values[:0]).of(want[:0])) == 0


def test_words_are_hashed_alike_wherever_they_stand():
    texts = ["", " \t", "Word word\x0bwOrd", "x" * 64, "X" * 65 + "\n" + "x" * 65, "abcdefgh abcdefghi É é a\x1cb a\x00 a"]
    keys, sizes = lm.word_keys([t.encode() for t in texts])
    words = [w for t in texts for w in [*t.encode().lower().split(), None]]
    assert sizes.tolist() == [len(t.encode().split()) + 1 for t in texts] and len(keys) == len(words)
    assert all((k == m) == (v == w) for k, v in zip(keys.tolist(), words) for m, w in zip(keys.tolist(), words))
    assert all((k == 0) == (w is None) for k, w in zip(keys.tolist(), words))
