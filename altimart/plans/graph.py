"""Routes and customers as triples, their rule-inferred classes, checks and explanations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from altimart import fixed_values as V
from altimart.functions.exact import AMOUNT, COUNT, amount, count_if, percent, rounded
from altimart.operators import triples as T
from altimart.operators.rules import Rule, all_labels, rule, trace
from altimart.plans.facts import bookings_per_customer

col, lit = F.col, F.lit
NAMESPACE = "urn:altimart:ontology#"

# FIXED VALUES: graph rules, over the properties of the triples
ROUTE_RULES = (
    rule("GrowthOpportunity", "hasLoadFactorPct >= 80", "hasMarginPct >= 15",
         "hasNbCompetitors <= 1"),
    rule("StrategicUnderperformer", "isStrategicRoute = true",
         "hasMarginPct < 10 | hasDelayRatePct > 30"),
    rule("OperationallyUnprofitable", "hasMarginPct < 0", "hasLoadFactorPct >= 65"),
    rule("DemandUnprofitable", "hasMarginPct < 0", "hasLoadFactorPct < 65"),
    rule("RouteToDefend", "hasMarginPct >= 10", "hasNbCompetitors >= 3",
         "hasAvgSentimentScore < -0.3"),
)
CUSTOMER_RULES = (
    rule("HighValueAtRisk", "isHighValue = true",
         "hasSentimentScore < -0.3 | hasCriticalTickets >= 1 | hasDaysSinceLastFlight > 90"),
    rule("LoyaltyConversionTarget", "isLoyaltyMember = false", "hasTotalBookings >= 2",
         "hasTotalRevenue >= 300"),
    rule("PremiumUpgradeCandidate", "hasCustomerSegment = 'standard'", "hasTotalMiles >= 5000",
         "hasAncillaryAttachRate >= 50"),
    rule("AncillaryOfferTarget", "hasTotalBookings >= 2", "hasAncillaryAttachRate < 30",
         "hasSentimentScore >= -0.2"),
    rule("ReactivationTarget", "hasDaysSinceLastFlight > 180", "hasTotalBookings >= 1"),
)
ENTITIES = {
    "route": ("Route", V.ROUTE_PROPERTIES, ROUTE_RULES, "StableRoute"),
    "customer": ("Customer", V.CUSTOMER_PROPERTIES, CUSTOMER_RULES, "StableCustomer"),
}


def _nz(c: Column, default=0) -> Column:
    return F.coalesce(c, lit(default))


def route_metrics(
    routes: DataFrame, flights: DataFrame, tickets: DataFrame, fanout_safe: bool = False
) -> DataFrame:
    """Per route: means over its flights joined with their tickets.

    In that join a flight counts once per ticket it has.  The join is not made:
    tickets are counted per flight, and the count weighs the flight.
    ``fanout_safe`` weighs every flight once instead.
    """
    per_flight = tickets.groupBy("flight_id").agg(
        F.count(lit(1)).alias("__n"),
        F.sum(amount(col("sentiment_score"))).alias("__mood"),
        F.count("sentiment_score").alias("__moods"),
    )
    weight = lit(1).cast("long") if fanout_safe else F.greatest(_nz(col("__n")), lit(1))
    weighed = (
        flights.select("flight_id", "route_id", "load_factor_pct", "flight_margin_pct", "is_delayed")
        .join(per_flight, "flight_id", "left")
        .withColumn("__w", weight)
    )

    def mean(name: str) -> Column:
        # both sums skip rows without a value
        total = F.sum(amount(col(name)) * col("__w").cast(COUNT))
        known = F.sum(F.when(col(name).isNotNull(), col("__w")))
        return rounded(F.try_divide(total.cast("double"), known), 2)

    rates = weighed.groupBy("route_id").agg(
        mean("load_factor_pct").alias("avg_load_factor_pct"),
        mean("flight_margin_pct").alias("avg_margin_pct"),
        percent(F.sum(F.when(col("is_delayed"), col("__w")).otherwise(0)), F.sum("__w"))
        .alias("delay_rate_pct"),
        rounded(F.try_divide(F.sum("__mood").cast("double"), F.sum("__moods")), 2)
        .alias("avg_sentiment_score"),
    )
    keys = ("route_id", "route_key", "origin_airport_code", "destination_airport_code",
            "is_strategic_route", "nb_competitors")
    return routes.select(*keys).distinct().join(rates, "route_id", "left").select(
        *keys[:4],
        _nz(col("is_strategic_route"), False).alias("is_strategic_route"),
        _nz(col("nb_competitors")).alias("nb_competitors"),
        *[
            _nz(col(name), 0.0).alias(name)
            for name in ("avg_load_factor_pct", "avg_margin_pct", "delay_rate_pct",
                         "avg_sentiment_score")
        ],
    )


def customer_metrics(
    customers: DataFrame, bookings: DataFrame, tickets: DataFrame, fanout_safe: bool = False
) -> DataFrame:
    """Per customer: figures over its bookings joined with its tickets.

    That join pairs every booking with every ticket of the customer, so booking
    figures count once per ticket and ticket figures once per booking.  Both
    sides are reduced to one row per customer and multiplied instead; pairs are
    never built.  ``fanout_safe`` leaves the multiplication out.
    """
    names = ("nb_rows", "nb_bookings", "revenue", "nb_with_ancillary", "days_since_last_booking")
    return customer_figures(customers, bookings_per_customer(bookings, names), tickets, fanout_safe)


def customer_figures(
    customers: DataFrame, bought: DataFrame, tickets: DataFrame, fanout_safe: bool = False
) -> DataFrame:
    """``customer_metrics`` from the figures of ``bookings_per_customer``."""
    keys = ("customer_id", "is_high_value", "is_at_risk", "avg_sentiment_score", "total_miles",
            "is_loyalty_member", "customer_segment")
    people = customers.groupBy(*keys).agg(F.count(lit(1)).alias("__copies"))
    wrote = tickets.groupBy("customer_id").agg(
        F.count(lit(1)).alias("__tickets"),
        count_if(col("urgency_level") == "critical").alias("__critical"),
    )
    df = people.join(bought, "customer_id", "left").join(wrote, "customer_id", "left")
    if fanout_safe:
        by_ticket = by_booking = lit(1).cast("long")
    else:
        by_ticket = F.greatest(_nz(col("__tickets")), lit(1)) * col("__copies")
        by_booking = F.greatest(_nz(col("nb_rows")), lit(1)) * col("__copies")
    revenue = (col("revenue").cast(AMOUNT) * by_ticket.cast(COUNT)).cast("double")
    return df.select(
        "customer_id",
        "is_high_value",
        "is_at_risk",
        _nz(col("avg_sentiment_score"), 0.0).alias("avg_sentiment_score"),
        _nz(col("total_miles")).alias("total_miles"),
        _nz(col("is_loyalty_member"), False).alias("is_loyalty_member"),
        _nz(col("customer_segment"), "standard").alias("customer_segment"),
        (_nz(col("nb_bookings")) * by_ticket).alias("total_bookings"),
        _nz(revenue, 0.0).alias("total_revenue"),
        _nz(percent(col("nb_with_ancillary"), col("nb_bookings")), 0.0).alias("ancillary_attach_rate"),
        _nz(col("days_since_last_booking"), V.NEVER_FLEW_DAYS).alias("days_since_last_flight"),
        (_nz(col("__critical")) * by_booking).alias("critical_tickets"),
    )


def schema_triples(spark: SparkSession, ns: str = NAMESPACE) -> DataFrame:
    """Classes, properties with domain and range, and disjointness as triples."""
    kind, rows = V.RDF_TYPE, []

    def link(s: str, p: str, o: str):
        rows.append((s, p, o, None, True))

    def said(s: str, text: str):
        rows.append((s, V.RDFS + "label", text, "@fr", False))

    for name, text in V.BASE_CLASSES.items():
        link(ns + name, kind, V.OWL + "Class")
        said(ns + name, text)
        rows.append((ns + name, V.RDFS + "comment", V.BASE_COMMENTS[name], "@fr", False))
    for base, properties, rules, default in ENTITIES.values():
        for label in [*(r.name for r in rules), default]:
            link(ns + label, kind, V.OWL + "Class")
            link(ns + label, V.RDFS + "subClassOf", ns + base)
            said(ns + label, V.CLASS_TEXTS[label])
        for name, (xsd, _) in properties.items():
            link(ns + name, kind, V.OWL + "DatatypeProperty")
            link(ns + name, V.RDFS + "domain", ns + base)
            link(ns + name, V.RDFS + "range", V.XSD + xsd)
    for name, (domain, target) in V.LINK_PROPERTIES.items():
        link(ns + name, kind, V.OWL + "ObjectProperty")
        link(ns + name, V.RDFS + "domain", ns + domain)
        link(ns + name, V.RDFS + "range", ns + target)
    for a, b in V.DISJOINT_PAIRS:
        link(ns + a, V.OWL + "disjointWith", ns + b)
    return spark.createDataFrame(rows, "s string, p string, o string, dtype string, is_iri boolean")


def _literals(properties, ns: str):
    return {ns + name: (kind, col(column)) for name, (kind, column) in properties.items()}


def route_triples(metrics: DataFrame, ns: str = NAMESPACE) -> DataFrame:
    """Facts of every route, links to its two airports, and the airports themselves."""
    def node(name: str) -> Column:
        return F.concat(lit(ns), col(name))

    facts = T.row_facts(
        metrics, node("route_id"), ns + "Route", _literals(V.ROUTE_PROPERTIES, ns),
        {ns + "hasOrigin": node("origin_airport_code"),
         ns + "hasDestination": node("destination_airport_code")},
    )
    ends = metrics.where(col("route_id").isNotNull()).select(
        F.explode(F.array(node("origin_airport_code"), node("destination_airport_code")))
        .alias("airport")
    )
    return T.union_graphs(facts, T.node_types(ends, "airport", ns + "Airport"))


def competitor_triples(competitors: DataFrame, ns: str = NAMESPACE) -> DataFrame:
    """hasCompetitor links and the airlines they point to; blanks in names become underscores."""
    links = competitors.select(
        F.concat(lit(ns), "route_id").alias("s"),
        lit(ns + "hasCompetitor").alias("p"),
        F.concat(lit(ns), F.regexp_replace("competitor_name", r"\s+", "_")).alias("o"),
        lit(None).cast("string").alias("dtype"),
        lit(True).alias("is_iri"),
    ).where(col("s").isNotNull() & col("o").isNotNull())
    return T.union_graphs(links, T.node_types(links, "o", ns + "Airline"))


def customer_triples(metrics: DataFrame, ns: str = NAMESPACE) -> DataFrame:
    facts = T.row_facts(
        metrics, F.concat(lit(ns), "customer_id"), ns + "Customer",
        _literals(V.CUSTOMER_PROPERTIES, ns),
    )
    return T.union_graphs(facts)


def _columns(entity: str, ns: str) -> dict[str, tuple[str, str]]:
    return {name: (ns + name, kind) for name, (kind, _) in ENTITIES[entity][1].items()}


def _infer(rows: DataFrame, entity: str) -> DataFrame:
    """``rows``, with a mark ``__is_<class>`` for each of the rules, and the labels these infer."""
    _, _, rules, default = ENTITIES[entity]
    settled = F.greatest(*[col(f"__is_{r.name}") for r in rules])
    return rows.withColumn("labels", all_labels(rules, default, settled, need_all=True))


def labelled(graph: DataFrame, entity: str, ns: str = NAMESPACE) -> DataFrame:
    """One row per entity: its properties and ``labels``, every class its rules infer.

    An entity that already carries one of the rules' classes gets no default.
    """
    base, _, rules, _ = ENTITIES[entity]
    marks = {f"__is_{r.name}": ns + r.name for r in rules}
    return _infer(T.star(graph, ns + base, _columns(entity, ns), marks), entity).drop(*marks)


def _marked(graph: DataFrame, entity: str, ns: str, infer: bool) -> DataFrame:
    """One row per entity of a classified graph, with a mark for each class a rule or the default gives.

    With ``infer`` the graph is not classified yet.  The rows are those of ``classify(graph)``, which is
    not made: a subject is brought together once and gets its labels there.
    """
    base, _, rules, default = ENTITIES[entity]
    marks = {f"__is_{n}": ns + n for n in [*(r.name for r in rules), default]}
    rows = T.star(graph, ns + base, _columns(entity, ns), marks)
    if not infer:
        return rows
    found = {m: col(m) | F.array_contains("labels", lit(m.removeprefix("__is_"))) for m in marks}
    return _infer(rows, entity).withColumns(found).drop("labels")


def _typed(graph: DataFrame, entity: str, ns: str, infer: bool) -> DataFrame:
    """One row per entity of a classified graph, with all its classes; ``infer`` as for ``_marked``."""
    base, _, rules, _ = ENTITIES[entity]
    if not infer:
        return T.star(graph, ns + base, _columns(entity, ns), types_in=ns)
    marks = {f"__is_{r.name}": ns + r.name for r in rules}
    rows = _infer(T.star(graph, ns + base, _columns(entity, ns), marks, ns), entity)
    inferred_ = F.transform("labels", lambda label: F.concat(lit(ns), label))
    return rows.withColumn("types", F.array_union("types", inferred_)).drop("labels", *marks)


def inferred(graph: DataFrame, entity: str, ns: str = NAMESPACE) -> DataFrame:
    """Type triples for the classes the rules infer."""
    return labelled(graph, entity, ns).select("s", F.explode("labels").alias("label")).select(
        "s",
        lit(V.RDF_TYPE).alias("p"),
        F.concat(lit(ns), "label").alias("o"),
        lit(None).cast("string").alias("dtype"),
        lit(True).alias("is_iri"),
    )


def classify(
    graph: DataFrame, ns: str = NAMESPACE, entities: Sequence[str] = tuple(ENTITIES)
) -> DataFrame:
    """The graph with the inferred types of these kinds of entities added."""
    return T.union_graphs(graph, *[inferred(graph, entity, ns) for entity in entities])


def rule_counts(graph: DataFrame, ns: str = NAMESPACE, customers: DataFrame | None = None) -> DataFrame:
    """How many entities each rule labels, rules without a match included.

    ``customers`` is a graph of the customers, where ``graph`` has only the routes.
    """
    def per_entity(graph: DataFrame, entity: str) -> DataFrame:
        _, _, rules, default = ENTITIES[entity]
        names = [*(r.name for r in rules), default]
        hits = [F.count_if(F.array_contains("labels", n)).alias(n) for n in names]
        pairs = [F.struct(lit(n).alias("label"), col(n).alias("matches")) for n in names]
        return (
            labelled(graph, entity, ns).agg(*hits)
            .select(lit(entity).alias("entity_type"), F.inline(F.array(*pairs)))
        )

    return per_entity(graph, "route").unionByName(per_entity(graph if customers is None else customers, "customer"))


def classified(
    graph: DataFrame, entity: str, label: str | None = None, ns: str = NAMESPACE, infer: bool = False
) -> DataFrame:
    """(entity, label) rows of a classified graph with the entity's properties.

    Without ``label``: every class but the base class; with it: that class.  With ``infer`` the graph
    is not classified yet and the rows are those of ``classify(graph)``.
    """
    base = ENTITIES[entity][0]
    rows = _typed(graph, entity, ns, infer).withColumn("rdf_class", F.explode("types"))
    wanted = col("rdf_class") != ns + base if label is None else col("rdf_class") == ns + label
    return rows.where(wanted).select(
        T.local_name(col("s")).alias("entity_id"),
        T.local_name(col("rdf_class")).alias("owl_label"),
        *ENTITIES[entity][1],
    )


def label_facts(models, ns: str = NAMESPACE) -> DataFrame:
    """Type triples of all entities by their rules, without the rest of the graph."""
    return inferred(models["route_triples"], "route", ns).unionByName(
        inferred(models["customer_triples"], "customer", ns)
    )


def violations(graph: DataFrame, ns: str = NAMESPACE) -> DataFrame:
    """Entities labelled with two classes that are declared disjoint."""
    pairs = [(ns + a, ns + b) for a, b in V.DISJOINT_PAIRS]
    return T.disjoint_violations(graph, pairs).select(
        T.local_name(col("s")).alias("entity_id"),
        T.local_name(col("class_1")).alias("class_1"),
        T.local_name(col("class_2")).alias("class_2"),
    )


def _shown(name: str) -> Column:
    """A metric as an explanation prints it: numbers with a decimal point, ? when absent."""
    kinds = V.ROUTE_PROPERTIES | V.CUSTOMER_PROPERTIES
    kind = kinds[name][0]
    text = T.lexical(col(name), "decimal" if kind == "integer" else kind)
    return _nz(text, "?")


# FIXED VALUES: wording of the two explanations with a text of their own
def _worded(label: str) -> Column | None:
    if label == "GrowthOpportunity":
        return F.concat(
            lit("LF="), _shown("hasLoadFactorPct"), lit(">=80 ET Marge="), _shown("hasMarginPct"),
            lit(">=15 ET Concurrents="), _shown("hasNbCompetitors"), lit("<=1"),
        )
    if label == "HighValueAtRisk":
        return F.concat(
            lit("is_high_value=True ET (Sentiment="), _shown("hasSentimentScore"),
            lit("<-0.3 OU CriticalTickets="), _shown("hasCriticalTickets"),
            lit(">=1 OU Inactif="), _shown("hasDaysSinceLastFlight"), lit(">90j)"),
        )
    return None


def _reason(r: Rule) -> Column:
    """The rule spelled out with the values it saw."""
    worded = _worded(r.name)
    if worded is not None:
        return worded
    clauses = []
    for clause in r.clauses:
        tests = [
            F.concat(lit(f"{t.metric}="), _shown(t.metric), lit(f" {t.op} {t.against}".lower()))
            for t in clause
        ]
        text = F.concat_ws(" OU ", *tests)
        clauses.append(F.concat(lit("("), text, lit(")")) if len(tests) > 1 else text)
    return F.concat_ws(" ET ", *clauses)


def explanations(
    graph: DataFrame, entity: str, entity_id: str | None = None, ns: str = NAMESPACE, infer: bool = False
) -> DataFrame:
    """Why an entity of a classified graph has its labels; all entities without ``entity_id``.

    ``reasoning`` maps each label to its text, ``raw_metrics`` each property to
    its text, ``trace`` lists every test of the labels' rules.  With ``infer`` the
    graph is not classified yet and the rows are those of ``classify(graph)``.
    """
    _, properties, rules, default = ENTITIES[entity]
    if entity_id is not None:
        graph = graph.where(col("s") == ns + entity_id)
    rows = _marked(graph, entity, ns, infer)

    def per_label(make, base_case: Column) -> Column:
        cases = [F.when(col(f"__is_{r.name}"), make(r)) for r in rules]
        return F.array_compact(F.array(*cases, F.when(col(f"__is_{default}"), base_case)))

    def entry(key: str, value: Column) -> Column:
        return F.struct(lit(key).alias("key"), value.alias("value"))

    metrics = [
        F.when(col(name).isNotNull(), entry(name, _shown(name))) for name in properties
    ]
    empty_trace = F.slice(trace(rules[0]), 1, 0)
    return rows.select(
        T.local_name(col("s")).alias("entity_id"),
        lit(entity).alias("entity_type"),
        per_label(lambda r: lit(r.name), lit(default)).alias("owl_labels"),
        F.map_from_entries(
            per_label(lambda r: entry(r.name, _reason(r)), entry(default, lit(V.DEFAULT_REASON)))
        ).alias("reasoning"),
        F.map_from_entries(F.array_compact(F.array(*metrics))).alias("raw_metrics"),
        F.flatten(
            per_label(
                lambda r: F.transform(
                    trace(r), lambda t: t.withField("label", lit(r.name))
                ),
                F.transform(empty_trace, lambda t: t.withField("label", lit(default))),
            )
        ).alias("trace"),
        lit(V.RULE_SOURCE).alias("source"),
    )
