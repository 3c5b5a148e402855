"""Labels inferred on the way, bookings that meet repeated flights only, sums of cents, closures of stars."""

import random

from conftest import TINY
from pyspark.sql import functions as F

from altimart.functions import exact
from altimart.operators import closure
from altimart.operators import triples as T
from altimart.plans import facts, graph, tools
from altimart.queries import AS_OF, QUERIES, SHARED_ENTITIES, marts
from altimart.sources import sinks


def _rows(df):
    return sorted(repr(r) for r in df.select(*sorted(df.columns)).collect())


def _odd_graph(m):
    """Entities of which some have a class already, a rule's or the default, and some values are missing or doubled."""
    facts_ = m["route_triples"].unionByName(m["customer_triples"])
    given = [
        facts_.where((F.crc32("s") % every == 0) & F.col("o").endswith(base)).withColumn("o", F.lit(graph.NAMESPACE + name))
        for every, base, name in ((3, "Route", "RouteToDefend"), (5, "Customer", "HighValueAtRisk"), (7, "Customer", "StableCustomer"), (4, "Customer", "Elsewhere"))
    ]
    kept = facts_.where(F.crc32(F.concat("s", "p")) % 9 != 0)
    return T.union_graphs(kept, *given, facts_.where("o = '0'").withColumn("o", F.lit("1"))).localCheckpoint()


def test_labels_inferred_on_the_way_equal_those_of_the_classified_graph(spark):
    g = _odd_graph(marts(spark, TINY))
    whole = graph.classify(g).localCheckpoint()
    for entity in graph.ENTITIES:
        shown = [c for c in graph.explanations(whole, entity).columns if c not in ("reasoning", "raw_metrics")]
        for made in (lambda g, **k: graph.explanations(g, entity, **k).select(*shown, F.map_entries("reasoning").alias("r")),
                     lambda g, **k: graph.classified(g, entity, **k)):
            assert _rows(made(g, infer=True)) == _rows(made(whole))
    one = graph.explanations(g, "customer", "C3", infer=True).select("owl_labels")
    assert _rows(one) == _rows(graph.explanations(whole, "customer", "C3").select("owl_labels"))
    assert _rows(tools.owl_cross_query(g, infer=True)) == _rows(tools.owl_cross_query(whole))


def test_explanations_write_no_graph(spark, monkeypatch):
    written = []
    scratch = sinks.scratch
    monkeypatch.setattr(sinks, "scratch", lambda spark, name: written.append(name) or scratch(spark, name))
    for name in ("graph_explain_labels", "graph_explain_one", "q_owl_cross_query"):
        QUERIES[name](spark, TINY)
    assert "fct_flights" in written and not {n for n in written if "graph" in n or "classified" in n or "triples" in n}


def test_bookings_of_customers_meet_repeated_flights_only(spark):
    m = marts(spark, TINY, SHARED_ENTITIES)
    flights = m["fct_flights"].unionByName(m["fct_flights"].where(F.crc32("flight_id") % 3 == 0))
    bookings = m["stg_bookings"].unionByName(
        m["stg_bookings"].where("crc32(booking_id) % 5 = 0").withColumns({"customer_id": F.lit(None).cast("string")})
    )
    parts = (bookings, flights, m["dim_customers"], m["stg_ancillary_details"], AS_OF)
    want = facts.bookings_per_customer(facts.fct_bookings(*parts)).drop("last_flight_date")
    assert _rows(facts.customer_bookings(*parts, facts.repeated_flights(flights))) == _rows(want)
    plan = m["customer_metrics"]._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "hashpartitioning(flight_id" in line and "__made" in line]
    assert m["repeated_flights"].isEmpty() and "hashpartitioning(booking_id" in plan


def test_sums_and_rounding_without_decimals_equal_those_with(spark):
    rng = random.Random(5)
    values = [0.0, -0.0, 0.005, 1.005, -1.005, 2.675, 1e-9, -0.001, 99999.995, 1e5, 12345678901.125, 5e-11, 0.1 + 0.2, None]
    for _ in range(3000):
        values += [rng.randint(-(10**9), 10**9) / 100, rng.uniform(-1000, 1000), (rng.randint(-(10**6), 10**6) + 0.5) / 1000]
    df = spark.createDataFrame([(v, i % 50) for i, v in enumerate(values)], "v double, g int")
    for digits in (0, 2, 4, 6):
        plain = F.round(exact._decimal(F.col("v"), exact.READ), digits).cast("double")
        assert df.where(~exact.rounded(F.col("v"), digits).cast("string").eqNullSafe(plain.cast("string"))).count() == 0
    totals = df.groupBy("g").agg(exact.exact_total(F.col("v")).alias("new"), F.sum(exact.amount(F.col("v"))).alias("old"))
    assert totals.where("not (new <=> old)").count() == 0
    assert df.where("v is null").agg(exact.exact_sum(F.col("v"))).first()[0] is None


def test_a_class_around_its_smallest_node_takes_no_round(spark):
    frames = []
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "e"), ("e", "e")], "a string, b string")
    found = closure.classes(links, lambda df: frames.append(1) or df.localCheckpoint())
    assert sorted(map(tuple, found.collect())) == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "d")]
    assert len(frames) == 3  # links, labels and one look at them
