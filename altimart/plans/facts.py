"""The three facts: flights, bookings, tickets.

Detail tables are reduced to the grain of the fact before they are joined, so
no join multiplies rows except where the right side really holds several rows
per key (two cost or weather records for one flight).  Those are kept, as a
left join would; ``one_per_key`` reduces them to one first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from altimart import fixed_values as V
from altimart.functions.clean import flag
from altimart.functions.dates import as_of_date, date_key, days_between
from altimart.functions.exact import (
    AMOUNT,
    COUNT,
    TOTAL,
    added,
    amount,
    count_if,
    exact_sum,
    exact_total,
    percent,
    rounded,
    rounded_mean,
    sum_if,
)
from altimart.functions.keywords import Keywords
from altimart.operators.skew import lookup_join

col = F.col
COST_COLUMNS = (
    "total_cost_usd",
    "fuel_cost_usd",
    "crew_cost_usd",
    "airport_fees_usd",
    "maintenance_cost_usd",
    "catering_cost_usd",
    "fuel_cost_pct",
)
WEATHER_COLUMNS = (
    "disruption_risk_level",
    "disruption_risk_score",
    "average_delay_caused_min",
    "is_disruptive_weather",
    "season_type_normalized",
)
# what the booking fact reads of each of its inputs
BOOKING = (
    "booking_id",
    "customer_id",
    "flight_id",
    "booking_date",
    "booking_channel",
    "fare_class",
    "fare_family",
    "booking_status",
    "is_confirmed",
    "is_flown",
    "is_cancelled",
    "bags_count",
    "has_seat_selection",
    "ticket_price_category",
    "ticket_price_usd",
    "ancillary_revenue_usd",
    "total_revenue_usd",
    "ancillary_revenue_pct",
)
BOOKED_PROFILE = (
    "customer_segment",
    "loyalty_tier",
    "is_loyalty_member",
    "is_high_value",
    "is_at_risk",
    "is_upsell_candidate",
    "age_years",
    "generation",
    "customer_value_score",
)
BOOKED_CUSTOMER = ("customer_id", *BOOKED_PROFILE, "country")
BOOKED_EXTRA = ("booking_id", "item_revenue_usd", "item_category_normalized", "is_premium_seat", "is_digital_purchase")
BOOKED_FLIGHT = (
    "flight_id",
    "route_id",
    "flight_date",
    "is_delayed",
    "delay_minutes",
    "is_cancelled",
    "load_factor_pct",
    "is_profitable",
)


def _zero(name: str):
    return F.coalesce(col(name), F.lit(0))


def _zero_usd(name: str):
    return F.coalesce(col(name), F.lit(0.0))


def _one_per_key(df: DataFrame, keys: list[str], values: tuple[str, ...]) -> DataFrame:
    """The greatest record per key (compared column by column): deterministic, map-side combined."""
    best = df.groupBy(*keys).agg(F.max(F.struct(*values)).alias("__best"))
    return best.select(*keys, "__best.*")


def cargo_per_flight(cargo: DataFrame) -> DataFrame:
    return cargo.groupBy("flight_id").agg(
        F.count(F.lit(1)).alias("nb_cargo_shipments"),
        exact_sum(col("weight_kg")).alias("total_cargo_weight_kg"),
        exact_sum(col("cargo_revenue_usd")).alias("total_cargo_revenue_usd"),
        rounded_mean(col("space_utilization_pct"), 2).alias("avg_cargo_utilization_pct"),
        count_if(col("is_sensitive_cargo")).alias("nb_sensitive_shipments"),
    )


def bookings_per_flight(bookings: DataFrame) -> DataFrame:
    """Spark reduces this by (flight, customer) before flight: a hot flight is spread out."""
    return bookings.groupBy("flight_id").agg(
        F.count(F.lit(1)).alias("nb_bookings"),
        F.count_distinct("customer_id").alias("nb_unique_passengers"),
        exact_sum(col("ticket_price_usd")).alias("total_ticket_revenue_usd"),
        exact_sum(col("ancillary_revenue_usd")).alias("total_ancillary_revenue_usd"),
        exact_sum(col("total_revenue_usd")).alias("total_revenue_usd"),
        F.sum("bags_count").alias("total_bags"),
        count_if(col("is_cancelled")).alias("nb_cancelled_bookings"),
        count_if(col("is_flown")).alias("nb_flown_bookings"),
        count_if(col("has_seat_selection")).alias("nb_seat_selections"),
    )


def fct_flights(
    flights: DataFrame,
    routes: DataFrame,
    costs: DataFrame,
    weather: DataFrame,
    cargo: DataFrame,
    bookings: DataFrame,
    one_per_key: bool = False,
) -> DataFrame:
    """One row per flight with weather, load, revenue, cost and margin."""
    weather = weather.select(
        "airport_code", col("weather_date").alias("flight_date"), *WEATHER_COLUMNS
    )
    costs = costs.select("flight_cost_key", *COST_COLUMNS)
    if one_per_key:
        weather = _one_per_key(weather, ["airport_code", "flight_date"], WEATHER_COLUMNS)
        costs = _one_per_key(costs, ["flight_cost_key"], COST_COLUMNS)
    geography = routes.select(
        "route_id", "distance_km", col("origin_airport_code").alias("airport_code")
    )
    df = (
        lookup_join(lookup_join(flights, geography, "route_id"), weather, ["airport_code", "flight_date"])
        .join(costs, "flight_cost_key", "left")
        .join(bookings_per_flight(bookings).drop("total_revenue_usd"), "flight_id", "left")
        .join(cargo_per_flight(cargo), "flight_id", "left")
    )

    delay, storm = col("delay_minutes"), col("average_delay_caused_min")
    seats, km = col("seat_capacity"), col("distance_km")
    booked, flown = _zero("nb_bookings"), _zero("nb_flown_bookings")
    tickets = _zero_usd("total_ticket_revenue_usd")
    income = col("__income")
    cost = _zero_usd("total_cost_usd")
    fill = F.try_divide(booked.cast("double"), seats)
    seat_km = seats.cast("double") * km
    has_seat_km = (seats > 0) & (km > 0)
    # revenue as an exact decimal, so that ties between revenue and cost are real ties
    parts = ("total_ticket_revenue_usd", "total_ancillary_revenue_usd", "total_cargo_revenue_usd")
    first, *rest = [amount(_zero_usd(p)) for p in parts]
    df = df.withColumn("__income", sum(rest, first).cast("double"))
    return df.select(
        "flight_id",
        "route_id",
        "flight_cost_key",
        date_key(col("flight_date")).alias("date_id"),
        "flight_date",
        "flight_number",
        "aircraft_type",
        "seat_capacity",
        "flight_status",
        "delay_minutes",
        "computed_departure_delay_min",
        "computed_arrival_delay_min",
        "is_delayed",
        "is_cancelled",
        "disruption_risk_level",
        "disruption_risk_score",
        storm.alias("weather_delay_min"),
        "is_disruptive_weather",
        "season_type_normalized",
        F.when((delay > 0) & (storm > 0), percent(storm, delay))
        .otherwise(F.lit(0.0)).alias("weather_delay_share_pct"),
        (col("is_delayed") & F.coalesce(storm < delay * 0.5, F.lit(True)))
        .alias("is_operational_delay"),
        (col("is_delayed") & flag(storm >= delay * 0.5)).alias("is_weather_driven_delay"),
        booked.alias("nb_bookings"),
        _zero("nb_unique_passengers").alias("nb_passengers"),
        flown.alias("nb_flown_passengers"),
        _zero("nb_cancelled_bookings").alias("nb_cancelled_bookings"),
        F.when(seats > 0, percent(booked, seats)).alias("load_factor_pct"),
        flag(fill < 0.60).alias("is_underloaded"),
        flag(fill >= 0.85).alias("is_high_load"),
        tickets.alias("total_ticket_revenue_usd"),
        _zero_usd("total_ancillary_revenue_usd").alias("total_ancillary_revenue_usd"),
        _zero_usd("total_cargo_revenue_usd").alias("total_cargo_revenue_usd"),
        rounded(income, 2).alias("total_revenue_usd"),
        F.when((km > 0) & (flown > 0), rounded(F.try_divide(F.try_divide(tickets, km), flown), 4)).alias("yield_usd_per_km"),
        F.when(has_seat_km, rounded(F.try_divide(tickets, seat_km), 6)).alias("rask"),
        *[_zero_usd(name).alias(name) for name in COST_COLUMNS],
        F.when(has_seat_km, rounded(F.try_divide(cost, seat_km), 6)).alias("cask"),
        rounded(income - cost, 2).alias("flight_margin_usd"),
        F.when(cost > 0, percent(income - cost, cost)).alias("flight_margin_pct"),
        (income > cost).alias("is_profitable"),
        _zero("nb_cargo_shipments").alias("nb_cargo_shipments"),
        _zero_usd("total_cargo_weight_kg").alias("total_cargo_weight_kg"),
        _zero_usd("avg_cargo_utilization_pct").alias("avg_cargo_utilization_pct"),
        _zero("nb_seat_selections").alias("nb_seat_selections"),
        _zero("total_bags").alias("total_bags"),
        F.when(booked > 0, percent(_zero("nb_seat_selections"), booked))
        .otherwise(F.lit(0.0)).alias("seat_selection_attach_rate_pct"),
    )


def ancillary_per_booking(ancillary: DataFrame) -> DataFrame:
    revenue, category = col("item_revenue_usd"), col("item_category_normalized")
    return ancillary.groupBy("booking_id").agg(
        F.count(F.lit(1)).alias("nb_ancillary_items"),
        exact_sum(revenue).alias("total_ancillary_detail_usd"),
        *[
            sum_if(category == name, revenue).alias(f"{name}_revenue_usd")
            for name in ("baggage", "seat", "meal")
        ],
        count_if(col("is_premium_seat")).alias("nb_premium_seats"),
        count_if(col("is_digital_purchase")).alias("nb_digital_purchases"),
    )


def booking_history(bookings: DataFrame) -> DataFrame:
    """Per customer, over bookings with a status other than cancelled (NULL status drops out)."""
    return (
        bookings.where(col("booking_status") != "cancelled")
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("total_past_bookings"),
            exact_sum(col("total_revenue_usd")).alias("total_past_revenue_usd"),
            F.min("booking_date").alias("first_booking_date"),
            F.max("booking_date").alias("last_booking_date"),
        )
    )


def slice_number(keys: Sequence[str], slices: int) -> Column:
    """One of several slices, by a hash of the first key that is there."""
    return F.pmod(F.xxhash64(F.coalesce(*keys)), F.lit(slices)).cast("int")


def fct_bookings(
    bookings: DataFrame,
    flights: DataFrame,
    customers: DataFrame,
    ancillary: DataFrame,
    as_of=None,
    history: DataFrame | None = None,
) -> DataFrame:
    """One row per booking with its flight, customer, extras and the customer's history.

    ``history`` is the ``booking_history``, where it is not that of these bookings alone.
    """
    flight = flights.select(
        "flight_id",
        "route_id",
        "flight_date",
        col("is_delayed").alias("flight_was_delayed"),
        col("delay_minutes").alias("flight_delay_minutes"),
        col("is_cancelled").alias("flight_was_cancelled"),
        "load_factor_pct",
        col("is_profitable").alias("flight_is_profitable"),
    )
    customer = customers.select(
        "customer_id", *BOOKED_PROFILE, col("country").alias("customer_country")
    )
    if history is None:
        history = booking_history(bookings)
    df = bookings.join(ancillary_per_booking(ancillary), "booking_id", "left")
    df = lookup_join(df, flight, "flight_id")
    df = lookup_join(df, [customer, history], "customer_id")

    items, past = _zero("nb_ancillary_items"), _zero("total_past_bookings")
    idle = days_between(col("last_booking_date"), as_of_date(as_of))
    return df.select(
        "booking_id",
        "customer_id",
        "flight_id",
        "route_id",
        date_key(col("booking_date")).alias("date_id"),
        "booking_date",
        "booking_channel",
        "fare_class",
        "fare_family",
        "booking_status",
        "is_confirmed",
        "is_flown",
        "is_cancelled",
        "bags_count",
        "has_seat_selection",
        "ticket_price_category",
        "ticket_price_usd",
        "ancillary_revenue_usd",
        "total_revenue_usd",
        "ancillary_revenue_pct",
        items.alias("nb_ancillary_items"),
        *[_zero_usd(f"{n}_revenue_usd").alias(f"{n}_revenue_usd") for n in ("baggage", "seat", "meal")],
        _zero("nb_premium_seats").alias("nb_premium_seats"),
        _zero("nb_digital_purchases").alias("nb_digital_purchases"),
        (items > 0).alias("has_ancillary_purchase"),
        F.when(items >= 2, "high").when(items == 1, "low").otherwise("none")
        .alias("ancillary_attach_level"),
        "flight_date",
        "flight_was_delayed",
        "flight_delay_minutes",
        "flight_was_cancelled",
        "load_factor_pct",
        "flight_is_profitable",
        *BOOKED_PROFILE,
        "customer_country",
        past.alias("customer_total_bookings"),
        _zero_usd("total_past_revenue_usd").alias("customer_total_revenue_usd"),
        "first_booking_date",
        "last_booking_date",
        (past > 1).alias("is_repeat_customer"),
        idle.alias("days_since_last_booking"),
        flag(idle > 180).alias("is_inactive_customer"),
    )


def bookings_per_customer(bookings: DataFrame, names: Sequence[str] = ()) -> DataFrame:
    """Figures per customer of the rows of ``fct_bookings``, all or those named; sums are decimals."""
    figures = {
        "nb_rows": lambda: F.count(F.lit(1)),
        "nb_bookings": lambda: F.count("booking_id"),
        "nb_distinct_bookings": lambda: F.count_distinct("booking_id"),
        "revenue": lambda: F.sum(amount(col("total_revenue_usd"))),
        "nb_revenues": lambda: F.count("total_revenue_usd"),
        "ancillary_revenue": lambda: F.sum(amount(col("ancillary_revenue_usd"))),
        "nb_with_ancillary": lambda: count_if(col("has_ancillary_purchase")),
        "last_flight_date": lambda: F.max("flight_date"),
        "days_since_last_booking": lambda: F.max("days_since_last_booking"),
    }
    return bookings.groupBy("customer_id").agg(*[figures[name]().alias(name) for name in names or figures])


def repeated_flights(flights: DataFrame) -> DataFrame:
    """(flight_id, __times): the flights with several records, and how many."""
    times = flights.groupBy("flight_id").agg(F.count(F.lit(1)).alias("__times"))
    return times.where(col("flight_id").isNotNull() & (col("__times") > 1))


def customer_bookings(
    bookings: DataFrame,
    flights: DataFrame,
    customers: DataFrame,
    ancillary: DataFrame,
    as_of=None,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """``bookings_per_customer`` of the fact, which is not made.

    Each booking learns first whether it has extras and whether it is the first of its id and customer,
    both where the rows of its id are, so that ids go no further.  Only then does it meet its flight,
    reduced to a date and the number of its records, and customers are looked up once they are added up.
    A flight or a customer with several records counts a booking as often, as the joins of the fact do.
    The date of the last booking that was not cancelled is found in the same pass.

    With ``repeated``, the ``repeated_flights``, bookings meet only these, as no other flight changes
    how often they count.  They are few or none; written beforehand, a small table is broadcast and
    bookings are not dealt to flights.  There is no ``last_flight_date`` then.
    """
    made = F.when(col("booking_status") != "cancelled", col("booking_date")).alias("__made")
    rows = bookings.select(
        "booking_id", "customer_id", "flight_id", "total_revenue_usd", "ancillary_revenue_usd", made
    )
    sold = ancillary.select("booking_id").where(col("booking_id").isNotNull()).distinct()
    same = Window.partitionBy("booking_id", "customer_id").orderBy("flight_id")
    known = col("booking_id").isNotNull()
    rows = rows.join(sold.withColumn("__sold", F.lit(True)), "booking_id", "left").select(
        "customer_id", "flight_id", "total_revenue_usd", "ancillary_revenue_usd", "__made",
        col("__sold").isNotNull().alias("__sold"),
        known.alias("__known"),
        (known & (F.row_number().over(same) == 1)).alias("__first"),
    )
    flight = repeated
    if repeated is None:
        flight = flights.groupBy("flight_id").agg(
            F.count(F.lit(1)).alias("__times"), F.max("flight_date").alias("flight_date")
        )
    rows = lookup_join(rows, flight, "flight_id").withColumn("__times", F.coalesce("__times", F.lit(1)))
    times = col("__times")

    def counted(condition):
        return F.sum(F.when(condition, times).otherwise(F.lit(0)))

    def total(name: str):
        once = exact_total(F.when(times == 1, col(name)))
        # next to no booking has a flight with several records
        again = F.sum(F.when(times > 1, (amount(col(name)) * times.cast(COUNT)).cast(TOTAL)))
        return F.when(F.count(name) > 0, added(once, again))

    bought = rows.groupBy("customer_id").agg(
        F.sum(times).alias("nb_rows"),
        counted(col("__known")).alias("nb_bookings"),
        F.count_if(col("__first")).alias("nb_distinct_bookings"),
        total("total_revenue_usd").alias("revenue"),
        counted(col("total_revenue_usd").isNotNull()).alias("nb_revenues"),
        total("ancillary_revenue_usd").alias("ancillary_revenue"),
        counted(col("__sold")).alias("nb_with_ancillary"),
        *([F.max("flight_date").alias("last_flight_date")] if repeated is None else []),
        F.max("__made").alias("__made"),
    )
    copies = customers.groupBy("customer_id").agg(F.count(F.lit(1)).alias("__copies"))
    per_customer = bought.join(copies, "customer_id", "left")
    # bookings without a customer are nobody's history
    last_made = F.when(col("customer_id").isNotNull(), col("__made"))
    several = F.coalesce("__copies", F.lit(1))
    return per_customer.select(
        "customer_id",
        *[(col(n) * several).alias(n) for n in ("nb_rows", "nb_bookings")],
        "nb_distinct_bookings",
        (col("revenue").cast(AMOUNT) * several.cast(COUNT)).alias("revenue"),
        (col("nb_revenues") * several).alias("nb_revenues"),
        (col("ancillary_revenue").cast(AMOUNT) * several.cast(COUNT)).alias("ancillary_revenue"),
        (col("nb_with_ancillary") * several).alias("nb_with_ancillary"),
        *(["last_flight_date"] if repeated is None else []),
        days_between(last_made, as_of_date(as_of)).alias("days_since_last_booking"),
    )


def fct_tickets(tickets: DataFrame, flights: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per ticket with complaint tags and a check against what the flight did."""
    flight = flights.select(
        "flight_id",
        "route_id",
        "flight_date",
        col("is_delayed").alias("flight_was_delayed"),
        col("delay_minutes").alias("flight_delay_minutes"),
        col("is_cancelled").alias("flight_was_cancelled"),
        "is_operational_delay",
        "is_weather_driven_delay",
        "load_factor_pct",
    )
    profile = (
        "customer_segment",
        "loyalty_tier",
        "is_high_value",
        "is_at_risk",
        "customer_value_score",
    )
    ticket_columns = (
        "ticket_category",
        "customer_comments",
        "resolution_status",
        "resolution_time_days",
        "is_resolved",
        "is_open",
        "is_in_progress",
        "is_sla_breached",
        "sentiment_score",
        "sentiment_label",
        "urgency_level",
    )
    # tags are computed once per ticket, before the rows are shuffled
    late, cancelled = ("retard",), ("annulé",)
    words_ = Keywords(
        late, cancelled, *V.COMPLAINT_KEYWORDS.values(), *[words for _, words in V.PRIMARY_COMPLAINT]
    )
    found = col("__found")
    tagged = tickets.select(
        "ticket_id", "customer_id", "flight_id", *ticket_columns,
        words_.found(F.lower("customer_comments")).alias("__found"),
    ).select(
        "*",
        *[
            flag(words_.any(found, words)).alias(f"has_{topic}_keyword")
            for topic, words in V.COMPLAINT_KEYWORDS.items()
        ],
        words_.category(found, V.PRIMARY_COMPLAINT).alias("primary_complaint_category"),
        flag(words_.any(found, late)).alias("__says_delay"),
        flag(words_.any(found, cancelled)).alias("__says_cancelled"),
    ).drop("__found")
    df = lookup_join(tagged, flight, "flight_id")
    df = lookup_join(df, customers.select("customer_id", *profile), "customer_id")
    return df.select(
        "ticket_id",
        "customer_id",
        "flight_id",
        "route_id",
        *ticket_columns,
        *[f"has_{topic}_keyword" for topic in V.COMPLAINT_KEYWORDS],
        "primary_complaint_category",
        *[c for c in flight.columns if c not in ("flight_id", "route_id")],
        (col("__says_delay") & flag(col("flight_was_delayed")))
        .alias("is_delay_complaint_confirmed"),
        (col("__says_cancelled") & flag(col("flight_was_cancelled")))
        .alias("is_cancellation_complaint_confirmed"),
        *profile,
        (flag(col("is_high_value")) & col("urgency_level").isin("critical", "high"))
        .alias("is_high_value_critical_ticket"),
        (~col("is_resolved") & flag(col("resolution_time_days") > 7)).alias("is_overdue_ticket"),
    )
