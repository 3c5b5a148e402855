"""Published tables: full refresh that survives a failing write, buckets, graph layouts, keywords."""

import os
import random

import pytest
from conftest import TINY
from pyspark.sql import functions as F

from altimart import fixed_values as V
from altimart.functions.keywords import Keywords
from altimart.functions.tagging import has_any
from altimart.operators import closure, triples
from altimart.plans import facts, graph, kpis
from altimart.queries import GRAINS, marts
from altimart.sources import graphs, sinks


def test_a_failed_refresh_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_model(spark.range(5), path)
    with pytest.raises(Exception):
        sinks.write_model(spark.range(9).select(F.raise_error(F.lit("no")).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 5
    assert os.listdir(tmp_path) == ["t"]
    again = sinks.write_model(spark.read.parquet(path).selectExpr("id", "id % 2 as k"), path, partition_by=["k"])
    assert again.columns == ["id", "k"] and sorted(map(tuple, again.collect())) == [(0, 0), (1, 1), (2, 0), (3, 1), (4, 0)]
    assert os.listdir(tmp_path) == ["t"]


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_bucketed_marts_meet_without_an_exchange(spark, tmp_path):
    m = marts(spark, TINY)
    want = {tuple(r) for r in m["customer_metrics"].collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = m.publish(str(tmp_path), buckets=4, prefix="b_", names=["dim_customers", "fct_bookings", "fct_tickets"])
        metrics = graph.customer_metrics(done["dim_customers"], done["fct_bookings"], done["fct_tickets"])
        plan = _plan(metrics)
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 3
        assert {tuple(r) for r in metrics.collect()} == want
        assert "Exchange" not in _plan(facts.booking_history(done["fct_bookings"]))
        # the same files under another name, as in a session with another catalog
        table = done["dim_customers"]
        known = sinks.register_bucketed(spark, "c_customers", f"{tmp_path}/dim_customers", table.schema, "customer_id", 4)
        assert "Exchange" not in _plan(known.groupBy("customer_id").count()) and known.count() == table.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1MB")
        for name in ("b_dim_customers", "b_fct_bookings", "b_fct_tickets", "c_customers"):
            spark.sql(f"drop table if exists {name}")


def test_keywords_equal_one_search_a_word(spark):
    rng = random.Random(4)
    words = ["ab", "abc", "bca", "b", "caab", "é.", "a|b", "retard", "retardé", "tar"]
    tests = [["ab"], ["abc", "é."], ["b", "tar"], ["retard"], ["a|b"]]
    texts = ["".join(rng.choices("abcé.|", k=rng.randrange(14))) for _ in range(400)]
    texts += [None, "", "bagage retardé", "retar", "xabcabcax"]
    known = Keywords(words, ["ab"])
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", known.found(F.col("text")).alias("found"))
    rows = df.select(*[F.struct(known.any(F.col("found"), t), has_any(F.col("text"), t)) for t in tests]).collect()
    assert len(rows) == len(texts) and all(a is b or a == b for row in rows for a, b in row)
    table = [("x", ["abc"]), ("y", ["b"])]
    found = df.select("text", known.category(F.col("found"), table).alias("c"), known.all(F.col("found"), ["ab", "tar"]).alias("all")).collect()
    for r in found:
        text = r.text or ""
        assert r.c == ("x" if "abc" in text else "y" if "b" in text else "other")
        assert r["all"] == (None if r.text is None else "ab" in text and "tar" in text)
    with pytest.raises(ValueError):
        known.any(F.col("found"), ["zzz"])
    with pytest.raises(ValueError):
        Keywords([""])


def test_tickets_are_searched_once(spark):
    m = marts(spark, TINY)
    tagged = facts.fct_tickets(m["stg_customer_service_tickets"], m["fct_flights"], m["dim_customers"])
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert len(V.COMPLAINT_KEYWORDS) > 3
    # the staged sheet has one pattern of its own, for urgent words
    assert plan.count("regexp_extract_all(") <= 2 + plan.count("has_critical_keywords")
    assert "contains(lower(customer_comments" not in plan.lower()


GRAPH = "s string, p string, o string, dtype string, is_iri boolean"


def _graph(spark, rows):
    return spark.createDataFrame([(s, p, o, None, i) for s, p, o, i in rows], GRAPH)


def test_patterns_read_only_the_predicates_they_name(spark, tmp_path):
    rows = [(f"urn:x#{i}", p, str(i), False) for i in range(50) for p in ("urn:x#a", "urn:x#b", "http://x/c?d=1 2")]
    rows += [(f"urn:x#{i}", V.RDF_TYPE, "urn:x#K", True) for i in range(50)]
    facts_ = _graph(spark, rows)
    stored = graphs.write_by_predicate(facts_, str(tmp_path / "g"))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, facts_.collect()))
    star = triples.star(stored, "urn:x#K", {"a": ("urn:x#a", "integer")})
    plan = _plan(star)
    assert "PartitionFilters: [" in plan and "urn:x#a" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = stored.where(F.col("p").isin("urn:x#a", V.RDF_TYPE)).inputFiles()
    assert star.count() == 50 and len(read) >= 2


def test_one_subject_is_read_from_one_file(spark, tmp_path):
    rows = [(f"urn:x#{i:04d}", f"p{k}", str(i * k), False) for i in range(800) for k in range(3)]
    index = graphs.write_subject_index(_graph(spark, rows), str(tmp_path / "s"), ranges=8)
    assert index.ranges.count() == 8 and index.graph.count() == 2400
    asked = index.about("urn:x#0123")
    assert sorted(r.o for r in asked.collect()) == ["0", "123", "246"]
    scan = asked._jdf.queryExecution().executedPlan()
    while scan.children().size():
        scan = scan.children().head()
    files = scan.metrics().get("numFiles").get().value()
    total = len(index.graph.inputFiles())
    assert files == 1 < total
    assert index.about("urn:x#9999").isEmpty() and index.about("").isEmpty()
    assert index.about("urn:x#0123x").isEmpty()


def test_classes_of_chains_and_cycles(spark):
    links = [("e", "d"), ("d", "c"), ("b", "c"), ("a", "b"), ("x", "y"), ("y", "z"), ("z", "x"), ("q", "q"), ("a", "b"), (None, "a")]
    got = dict(closure.classes(spark.createDataFrame(links, "a string, b string"), sinks.kept).collect())
    assert got == {**dict.fromkeys("abcde", "a"), **dict.fromkeys("xyz", "x"), "q": "q"}
    order = list(range(300))
    random.Random(3).shuffle(order)
    chain = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    assert {r.label for r in closure.classes(chain, sinks.kept).collect()} == {0}
    assert closure.classes(chain.where("false"), sinks.kept).isEmpty()


def test_facts_are_shared_along_chains_and_cycles(spark):
    facts_ = _graph(spark, [("c", "p", "1", False), ("e", "p", "2", False), ("z", "p", "3", False), ("n", "to", "e", True)])
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("x", "y"), ("y", "z"), ("z", "x")], "local string, external string")
    whole = {(r.s, r.p, r.o) for r in triples.same_as_closure(facts_, links, sinks.kept).collect()}
    assert whole == {(n, "p", v) for n in "abcde" for v in "12"} | {(n, "p", "3") for n in "xyz"} | {("n", "to", "e")}
    one = {(r.s, r.p, r.o) for r in triples.canonical(facts_, links, sinks.kept).collect()}
    assert one == {("a", "p", "1"), ("a", "p", "2"), ("x", "p", "3"), ("n", "to", "a")}


def test_schema_memberships_are_a_fixpoint(spark):
    steps = spark.createDataFrame([("A", "B"), ("B", "C"), ("C", "A"), ("D", "A")], "a string, b string")
    start = spark.createDataFrame([("D", "A")], "a string, b string")
    assert {tuple(r) for r in closure.reached(start, steps, sinks.kept).collect()} == {("D", "A"), ("D", "B"), ("D", "C")}
    sub, dom, ran = (V.RDFS + n for n in ("subClassOf", "domain", "range"))
    schema = _graph(spark, [("K1", sub, "K2", True), ("K2", sub, "K3", True), ("has", dom, "K1", True), ("has", ran, "R", True)])
    facts_ = _graph(spark, [("s", "has", "o", True), ("t", "has", "text", False), ("u", V.RDF_TYPE, "K2", True)])
    found = triples.entailed(facts_, schema, sinks.kept).where(F.col("p") == V.RDF_TYPE)
    assert {(r.s, r.o) for r in found.collect()} == {(s, k) for s in "st" for k in ("K1", "K2", "K3")} | {("o", "R"), ("u", "K2"), ("u", "K3")}


def test_schema_has_comments(spark):
    rows = graph.schema_triples(spark).where(F.col("p") == V.RDFS + "comment").collect()
    assert len(rows) == 4 and {r.dtype for r in rows} == {"@fr"}


def test_several_grains_are_one_aggregate_of_a_model(spark):
    m = marts(spark, TINY)
    both = kpis.at_grains(m, {"fct_flights": [[], ["route_id"], ["route_id", "flight_status"]]})
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1
    names = {name for name, d in kpis.KPIS.items() if d.model == "fct_flights"}
    rows = both.collect()
    assert {r.grain for r in rows} == {"", "route_id", "flight_status+route_id"} and {r.metric for r in rows} == names
    want = {(r["route_id"], r["load_factor"]) for r in kpis.metric(m, "load_factor", ["route_id"]).collect()}
    assert {(r.member, r.value) for r in rows if (r.grain, r.metric) == ("route_id", "load_factor")} == want
    assert set(GRAINS) == {d.model for d in kpis.KPIS.values()}


def test_scratch_tables_are_in_the_folder_of_the_application(spark):
    path = sinks.scratch(spark, "x")
    assert path.startswith(f"{sinks.shared_folder(spark)}/altimart-{spark.sparkContext.applicationId}/x-")
    table = sinks.materialised(spark.range(3), "y")
    assert table.count() == 3
    sinks.remove(spark, path)
