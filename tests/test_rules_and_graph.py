"""Rules, graph operators, sinks: small cases with known answers."""

import json
import re

import pytest
from pyspark.sql import functions as F

from altimart.operators import triples as T
from altimart.operators.rules import all_labels, first_label, flags, rule
from altimart.plans import decisions, facts, graph
from altimart.sources import readers, sinks

ROUTE = dict(
    route_id="R1", route_key="A-B", is_strategic_route=False, nb_competitors=3,
    avg_load_factor_pct=50.0, avg_margin_pct=12.0, delay_rate_pct=5.0, profitable_flight_pct=90.0,
    nb_operational_delays=0, nb_weather_delays=0, avg_sentiment_score=0.0, total_revenue_usd=1.0,
    route_sentiment=0.0,
)


def decide(spark, **changes):
    from altimart import fixed_values as V

    df = spark.createDataFrame([ROUTE | changes])
    (row,) = decisions._decided(
        df, decisions.ROUTE_FLAG_RULES, decisions.ROUTE_LABEL_RULES, V.ROUTE_LABELS, V.ROUTE_ADVICE
    ).collect()
    return row


def test_label_and_recommendation_may_disagree(spark):
    row = decide(spark)
    assert row.ontology_label == "🔵 RouteToDefend"
    assert not row.flag_5 and "stable" in row.recommendation
    row = decide(spark, is_strategic_route=True, avg_margin_pct=20.0, profitable_flight_pct=50.0,
                 nb_competitors=0)
    assert row.flag_2 and "StrategicUnderperformer" not in row.ontology_label


def test_rules_on_null_metrics(spark):
    rules = [rule("a", "x > 1 | y > 1"), rule("b", "x <= y")]
    df = spark.createDataFrame([(None, 2), (None, None), (1, 5)], "x int, y int").select(
        *flags(rules, ["fa", "fb"]),
        first_label(rules, {"a": "A", "b": "B", "none": "N"}, "none").alias("label"),
        all_labels(rules, "none").alias("every"),
        all_labels(rules, "none", need_all=True).alias("complete"),
    )
    rows = df.collect()
    assert [(r.fa, r.fb, r.label) for r in rows] == [
        (True, False, "A"), (False, False, "N"), (True, True, "A"),
    ]
    assert [r.every for r in rows] == [["a"], ["none"], ["a", "b"]]
    assert [r.complete for r in rows] == [["none"], ["none"], ["a", "b"]]


def test_history_leaves_out_cancelled_and_null_status(spark):
    df = spark.createDataFrame(
        [("C", s, 1.0) for s in (None, "cancelled", "flown")],
        "customer_id string, booking_status string, total_revenue_usd double",
    ).withColumn("booking_date", F.lit("2024-01-01").cast("date"))
    (row,) = facts.booking_history(df).collect()
    assert row.total_past_bookings == 1


def metrics(spark, **changes):
    base = dict(
        route_id="R1", route_key="A-B", origin_airport_code="A", destination_airport_code="B",
        is_strategic_route=True, nb_competitors=0, avg_load_factor_pct=90.0, avg_margin_pct=20.0,
        delay_rate_pct=40.0, avg_sentiment_score=0.0,
    )
    return spark.createDataFrame([base | changes])


def test_two_labels_and_a_violation(spark):
    g = graph.classify(graph.route_triples(metrics(spark)))
    labels = {r.owl_label for r in graph.classified(g, "route").collect()}
    assert labels == {"GrowthOpportunity", "StrategicUnderperformer"}
    (bad,) = graph.violations(g).collect()
    assert (bad.class_1, bad.class_2) == ("GrowthOpportunity", "StrategicUnderperformer")
    (why,) = graph.explanations(g, "route", "R1").collect()
    assert why.reasoning["GrowthOpportunity"] == "LF=90.0>=80 ET Marge=20.0>=15 ET Concurrents=0.0<=1"
    assert all(t.ok for t in why.trace if t.label == "GrowthOpportunity")
    assert why.raw_metrics["hasRouteKey"] == "A-B"


def test_strategic_route_without_flights(spark):
    routes = metrics(spark).select("route_id", "route_key", "origin_airport_code",
                                   "destination_airport_code", "is_strategic_route", "nb_competitors")
    flights = spark.createDataFrame([], "flight_id string, route_id string, load_factor_pct double, "
                                        "flight_margin_pct double, is_delayed boolean")
    tickets = spark.createDataFrame([], "flight_id string, sentiment_score double")
    g = graph.classify(graph.route_triples(graph.route_metrics(routes, flights, tickets)))
    assert [r.owl_label for r in graph.classified(g, "route").collect()] == ["StrategicUnderperformer"]


@pytest.mark.parametrize("safe, expected", [(False, (6, 2)), (True, (2, 1))])
def test_customer_fan_out(spark, safe, expected):
    people = spark.createDataFrame(
        [("C", True, False, 0.0, 0, False, None)],
        "customer_id string, is_high_value boolean, is_at_risk boolean, avg_sentiment_score double, "
        "total_miles long, is_loyalty_member boolean, customer_segment string")
    bookings = spark.createDataFrame(
        [("C", "B1", 10.0, True, 5), ("C", "B2", 20.0, False, 5)],
        "customer_id string, booking_id string, total_revenue_usd double, "
        "has_ancillary_purchase boolean, days_since_last_booking int")
    tickets = spark.createDataFrame([("C", u) for u in ("critical", "low", "low")],
                                    "customer_id string, urgency_level string")
    (row,) = graph.customer_metrics(people, bookings, tickets, fanout_safe=safe).collect()
    assert (row.total_bookings, row.critical_tickets) == expected
    assert row.ancillary_attach_rate == 50.0 and row.customer_segment == "standard"


def test_existing_label_keeps_the_default_away(spark):
    quiet = metrics(spark, is_strategic_route=False, avg_load_factor_pct=10.0)
    g = graph.route_triples(quiet)
    assert [r.labels for r in graph.labelled(g, "route").collect()] == [["StableRoute"]]
    ns = graph.NAMESPACE
    marked = g.unionByName(spark.createDataFrame(
        [(ns + "R1", T.RDF_TYPE, ns + "RouteToDefend", None, True)], g.schema))
    assert [r.labels for r in graph.labelled(marked, "route").collect()] == [[]]


def test_schema_graph(spark):
    s = graph.schema_triples(spark)
    counts = {r.o.split("#")[-1]: r["count"] for r in
              s.where(F.col("p") == T.RDF_TYPE).groupBy("o").count().collect()}
    assert counts == {"Class": 16, "DatatypeProperty": 19, "ObjectProperty": 3}
    assert s.where(F.endswith("p", F.lit("disjointWith"))).count() == 3


def test_lexical_forms(spark):
    row = spark.range(1).select(
        T.lexical(F.lit(83.5), "decimal"), T.lexical(F.lit(80.0), "decimal"),
        T.lexical(F.lit(12345678.9), "decimal"), T.lexical(F.lit(True), "boolean"),
        T.lexical(F.lit(7), "integer"),
    ).first()
    assert tuple(row) == ("83.5", "80.0", "12345678.9", "true", "7")


def test_ntriples_round_trip(spark, tmp_path):
    g = spark.createDataFrame(
        [("urn:a#x", "urn:a#p", 'say "hi" \\ now\nthen', T.XSD + "string", False),
         ("urn:a#x", "urn:a#q", "urn:a#y", None, True)],
        "s string, p string, o string, dtype string, is_iri boolean")
    sinks.write_ntriples(g, str(tmp_path / "nt"))
    back = readers.read_ntriples(spark, str(tmp_path / "nt"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, g.collect()), key=str)


def test_readers_views_and_tables(spark, tmp_path):
    path = tmp_path / "routes.csv"
    path.write_text("route_id,origin_airport_code,destination_airport_code,route_type,distance_km,"
                    "block_time_min\nR1,ABJ,ACC,Regional,419,70\n", encoding="utf-8")
    raw = readers.read_sheet(spark, "routes", str(path), "csv")
    readers.register_views({"routes": raw}, "raw_")
    assert spark.table("raw_routes").first().route_id == "R1"
    written = sinks.write_model(raw, str(tmp_path / "out"), partition_by=["route_type"],
                                files_by=["route_type"])
    assert written.count() == 1
    again = readers.read_sheet(spark, "routes", str(tmp_path / "out"), "parquet")
    assert again.first().distance_km == "419"
    with pytest.raises(ValueError, match="unknown sheet"):
        readers.read_sheet(spark, "nope", str(path))


def test_json_answer_refuses_to_cut(spark):
    df = spark.createDataFrame([(1, "é"), (2, None)], "a int, b string")
    assert json.loads(sinks.json_answer(df, 5)) == [{"a": 1, "b": "é"}, {"a": 2, "b": None}]
    with pytest.raises(ValueError):
        sinks.json_answer(df, 1)


def test_publish_writes_every_mart(spark, tmp_path):
    from conftest import TINY
    from altimart.queries import AS_OF
    from altimart.plans.build import MART_TABLES, Marts
    from altimart.sources.fixtures import RawSheets

    m = Marts(RawSheets(spark, TINY), as_of=AS_OF)
    written = m.publish(str(tmp_path))
    assert set(written) == set(MART_TABLES)
    assert written["fct_flights"].count() == m["stg_flights"].count()
    assert written["decision_layer"].where("ontology_label is null").isEmpty()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    """No Python workers, no cross products, no windows; scans read only what they need."""
    from conftest import TINY
    from altimart.queries import QUERIES

    for name in ("fct_flights", "fct_bookings", "fct_tickets", "win_loyalty", "graph_customer_labels"):
        text = plan(QUERIES[name](spark, TINY))
        for banned in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
            assert banned not in text, (name, banned)
    text = plan(QUERIES["agg_cargo_per_flight"](spark, TINY))
    (columns,) = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    names = [c.split(":")[0] for c in columns.split(",")]
    assert "l_shipdate" not in names and "l_comment" not in names and "l_partkey" in names


def test_ntriples_round_trip(spark, tmp_path):
    from altimart.sources.readers import read_ntriples
    from altimart.sources.sinks import write_ntriples

    texts = ["C:\\new\\report", 'say "hi"', "a\tb\nc\rd", "\\\\n", "", "é . ^^<x>"]
    rows = [("urn:s", "urn:p", t, None, False) for t in texts]
    rows += [("urn:s", "urn:p", "Route aérienne", "@fr", False), ("urn:s", "urn:q", "5", "urn:int", False)]
    rows += [("urn:s", "urn:l", "urn:o", None, True)]
    facts = spark.createDataFrame(rows, "s string, p string, o string, dtype string, is_iri boolean")
    write_ntriples(facts, str(tmp_path / "t"))
    assert sorted(map(str, read_ntriples(spark, str(tmp_path / "t")).collect())) == sorted(map(str, facts.collect()))


def test_unreadable_triples_are_refused(spark, tmp_path):
    from altimart.sources.readers import read_ntriples

    (tmp_path / "bad.nt").write_text("# fine\n\n_:b <urn:p> <urn:o> .\n")
    with pytest.raises(Exception, match="not a readable triple"):
        read_ntriples(spark, str(tmp_path / "bad.nt")).collect()


def test_schema_says_labels_in_their_language(spark):
    from altimart.plans import graph

    rows = graph.schema_triples(spark).where("dtype = '@fr'").collect()
    assert {r.o for r in rows} >= {"Compagnie aérienne", "Client inactif à réactiver"} and len(rows) == 16
