"""All models by name, from the raw sheets to the classified graph.

``Marts`` is a mapping: looking a model up composes it from the models it
needs, lazily, once.  Models named in ``tables`` are written to a table when
they are first needed and read back, so that several users share one run.
Where ``tables`` maps a model to columns, only those are written and read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.functions import col

from altimart.operators.triples import union_graphs
from altimart.plans import decisions, dimensions, facts, graph, staging
from altimart.sources.sinks import materialised, materialised_parts, remove, scratch, write_bucketed, write_model

# written by ``publish``; staging models stay views
MART_TABLES = (
    "dim_routes",
    "dim_customers",
    "fct_flights",
    "fct_bookings",
    "fct_tickets",
    "decision_layer",
)

# written where it is asked for: what the bookings of a customer add up to
ON_REQUEST = ("customer_bookings",)

# the key by which a published mart is clustered where buckets are asked for
CLUSTERED_BY = {
    "dim_routes": "route_id",
    "dim_customers": "customer_id",
    "fct_flights": "flight_id",
    "fct_bookings": "customer_id",
    "customer_bookings": "customer_id",
    "fct_tickets": "customer_id",
    "decision_layer": "entity_id",
}

# shared graphs are read by patterns that name predicates: a folder each
LAYOUTS = {"graph": (("p",), ("p", "s")), "classified_graph": (("p",), ("p", "s"))}

# a slice of the booking fact has so many bookings, or more where there are more than in all SLICES
SLICE_ROWS = 8_000_000
SLICES = 16
_SLICE = "__slice"
_DENSE = {"compression": "zstd"}


class Marts(Mapping[str, DataFrame]):
    def __init__(
        self,
        sheets: Mapping[str, DataFrame],
        as_of=None,
        tables: Iterable[str] | Mapping[str, Sequence[str] | None] = (),
        strict: bool = False,
        namespace: str = graph.NAMESPACE,
    ):
        self.sheets = sheets
        self.as_of = as_of
        self.tables = dict(tables) if isinstance(tables, Mapping) else dict.fromkeys(tables)
        self.strict = strict
        self.namespace = namespace
        self._models: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._models:
            df = self._compose(name)
            if name in self.tables:
                df = df if self.tables[name] is None else df.select(*self.tables[name])
                df = materialised(df, name, *LAYOUTS.get(name, ()))
            self._models[name] = df
        return self._models[name]

    def __iter__(self) -> Iterator[str]:
        yield from (f"stg_{name}" for name in staging.MODELS)
        yield from _BUILDERS

    def __len__(self) -> int:
        return len(staging.MODELS) + len(_BUILDERS)

    def _compose(self, name: str) -> DataFrame:
        if name.startswith("stg_") and name[4:] in staging.MODELS:
            sheet = name[4:]
            return staging.MODELS[sheet](self.sheets[sheet], as_of=self.as_of, strict=self.strict)
        if name not in _BUILDERS:
            raise KeyError(name)
        return _BUILDERS[name](self)

    def rows_only(self, sheet: str) -> DataFrame:
        """A staging model without its per-group totals, for users that only need the rows."""
        model = staging.MODELS[sheet]
        return model(self.sheets[sheet], as_of=self.as_of, strict=self.strict, totals=False)

    def publish(
        self, folder: str, buckets: int | None = None, prefix: str = "", names: Iterable[str] = MART_TABLES
    ) -> dict[str, DataFrame]:
        """Full refresh of marts below a folder; later marts read the written earlier ones.

        With ``buckets`` each mart is a catalog table, named with ``prefix``, in so many buckets of its
        key in ``CLUSTERED_BY``: what joins or groups customers, or flights, then shuffles nothing.
        """
        wanted = [name for name in (*MART_TABLES, *ON_REQUEST) if name in set(names)]
        for name in wanted:
            model, path = self._compose(name), f"{folder}/{name}"
            if buckets is None:
                self._models[name] = write_model(model, path)
            else:
                self._models[name] = write_bucketed(model, f"{prefix}{name}", path, CLUSTERED_BY[name], buckets)
        return {name: self._models[name] for name in wanted}


def bookings_in_slices(m: Marts, once_dealt: Callable[[], None] = lambda: None) -> DataFrame:
    """``fct_bookings``, written slice by slice where there are many bookings.

    Whole rows are shuffled by booking, by flight and by customer.  At once that takes the disk of all
    three; here it is that of a slice.  Bookings are written in slices together with their extras, by
    their id, ones without an id by their customer.  A slice goes once its part of the fact is there.
    What slices are looked up in is written once.  ``once_dealt`` is called when that is done and the
    models' own tables are not read any more.
    """
    bookings, ancillary = m["stg_bookings"], m["stg_ancillary_details"]
    spark = bookings.sparkSession
    slices = min(SLICES, -(-bookings.count() // SLICE_ROWS))
    if slices < 2:
        return m["fct_bookings"]

    def dealt(df: DataFrame, keys: Sequence[str], name: str) -> tuple[str, DataFrame]:
        path = scratch(spark, name)
        df = df.withColumn(_SLICE, facts.slice_number(keys, slices))
        return path, write_model(df, path, [_SLICE], options=_DENSE)

    flights = materialised(m["fct_flights"].select(*facts.BOOKED_FLIGHT), "booked_flights")
    customers = materialised(m["dim_customers"].select(*facts.BOOKED_CUSTOMER), "booked_customers")
    inputs = (
        dealt(bookings.select(*facts.BOOKING), ("booking_id", "customer_id", "flight_id"), "booked"),
        dealt(ancillary.select(*facts.BOOKED_EXTRA), ("booking_id",), "booked_extras"),
    )
    history = materialised(facts.booking_history(inputs[0][1]), "booking_history")
    once_dealt()

    def parts() -> Iterator[DataFrame]:
        for i in range(slices):
            rows, extras = [table.where(col(_SLICE) == i).drop(_SLICE) for _, table in inputs]
            yield facts.fct_bookings(rows, flights, customers, extras, m.as_of, history)
            for path, _ in inputs:
                remove(spark, f"{path}/{_SLICE}={i}")

    return materialised_parts(parts(), "fct_bookings", _DENSE)


def _customer_bookings(m: Marts, repeated: DataFrame | None = None) -> DataFrame:
    inputs = (m["stg_bookings"], m["fct_flights"], m["dim_customers"], m["stg_ancillary_details"])
    return facts.customer_bookings(*inputs, m.as_of, repeated)


def _bought(m: Marts) -> DataFrame:
    """``customer_bookings`` as the graph reads it: the written model, else one without dates of flights."""
    written = "customer_bookings" in m._models or "customer_bookings" in m.tables
    return m["customer_bookings"] if written else _customer_bookings(m, m["repeated_flights"])


_BUILDERS = {
    "dim_date": lambda m: dimensions.dim_date(m["stg_flights"].sparkSession),
    "dim_routes": lambda m: dimensions.dim_routes(
        m["stg_routes"], m["stg_airports"], m.rows_only("competitor_context")
    ),
    "dim_customers": lambda m: dimensions.dim_customers(
        m["stg_customers"], m.rows_only("loyalty_activity"), m["stg_customer_service_tickets"]
    ),
    "fct_flights": lambda m: facts.fct_flights(
        m["stg_flights"],
        m["dim_routes"],
        m["stg_flight_costs"],
        m["stg_weather_impact"],
        m["stg_cargo_operations"],
        m["stg_bookings"],
    ),
    "fct_bookings": lambda m: facts.fct_bookings(
        m["stg_bookings"],
        m["fct_flights"],
        m["dim_customers"],
        m["stg_ancillary_details"],
        m.as_of,
    ),
    "fct_tickets": lambda m: facts.fct_tickets(
        m["stg_customer_service_tickets"], m["fct_flights"], m["dim_customers"]
    ),
    "route_decisions": lambda m: decisions.route_decisions(
        m["dim_routes"], m["fct_flights"], m["fct_tickets"]
    ),
    "repeated_flights": lambda m: facts.repeated_flights(m["fct_flights"]),
    # fct_bookings added up per customer, without its rows
    "customer_bookings": _customer_bookings,
    "customer_performance": lambda m: decisions.performance_of(m["customer_bookings"], m.as_of),
    "customer_decisions": lambda m: decisions.decided_customers(
        m["dim_customers"], m["customer_performance"]
    ),
    "decision_layer": lambda m: decisions.decision_layer(
        m["route_decisions"], m["customer_decisions"]
    ),
    "route_metrics": lambda m: graph.route_metrics(
        m["dim_routes"], m["fct_flights"], m["fct_tickets"]
    ),
    "customer_metrics": lambda m: graph.customer_figures(
        m["dim_customers"], _bought(m), m["fct_tickets"]
    ),
    "customer_metrics_fanout_safe": lambda m: graph.customer_figures(
        m["dim_customers"], _bought(m), m["fct_tickets"], fanout_safe=True
    ),
    "route_triples": lambda m: graph.route_triples(m["route_metrics"], m.namespace),
    "customer_triples": lambda m: graph.customer_triples(m["customer_metrics"], m.namespace),
    "competitor_triples": lambda m: graph.competitor_triples(
        m.rows_only("competitor_context"), m.namespace
    ),
    "graph": lambda m: union_graphs(
        graph.schema_triples(m["stg_routes"].sparkSession, m.namespace),
        m["route_triples"],
        m["customer_triples"],
    ),
    "classified_graph": lambda m: graph.classify(m["graph"], m.namespace),
    # the two halves of the classified graph, for questions about one kind of entity
    "classified_routes": lambda m: graph.classify(m["route_triples"], m.namespace, ["route"]),
    "classified_customers": lambda m: graph.classify(
        m["customer_triples"], m.namespace, ["customer"]
    ),
}
