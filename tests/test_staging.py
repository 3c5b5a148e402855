"""Edge rows of the staging models."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from altimart.plans import dimensions, staging
from altimart.sources.schemas import SHEETS, schema

AS_OF = dt.date(2025, 6, 30)


def sheet(spark, name, *rows, as_text=False):
    """Rows given as dicts; columns left out are NULL."""
    s = schema(name, as_text)
    return spark.createDataFrame([tuple(r.get(c) for c in s.names) for r in rows], s)


def stage(spark, name, *rows, **kwargs):
    as_text = kwargs.pop("as_text", False)
    model = staging.MODELS[name]
    return model(sheet(spark, name, *rows, as_text=as_text), as_of=AS_OF, **kwargs).collect()


KEYS = {
    "airports": {"airport_code": "A"},
    "routes": {"route_id": "R", "origin_airport_code": "A", "destination_airport_code": "B"},
    "customers": {"customer_id": "C"},
    "bookings": {"booking_id": "B", "customer_id": "C", "flight_id": "F"},
    "ancillary_details": {"ancillary_id": "A", "booking_id": "B"},
    "competitor_context": {"market_id": "M", "route_id": "R", "competitor_name": "N"},
    "weather_impact": {"weather_id": "W", "airport_code": "A", "date": dt.date(2024, 1, 1)},
    "cargo_operations": {"cargo_shipment_id": "G", "flight_id": "F"},
    "loyalty_activity": {"activity_id": "L", "customer_id": "C"},
}


@pytest.mark.parametrize("name", list(KEYS))
def test_null_keys_are_dropped_and_blank_keys_kept(spark, name):
    keys = KEYS[name]
    for column, value in keys.items():
        rows = stage(spark, name, keys, keys | {column: None})
        assert len(rows) == 1
        if isinstance(value, str):
            (row,) = stage(spark, name, keys | {column: "  "})
            assert row[column] is None


def test_ticket_and_cost_keys_treat_blank_as_missing(spark):
    ticket = {"ticket_id": "T", "customer_id": "C", "flight_id": "F"}
    assert len(stage(spark, "customer_service_tickets", ticket, ticket | {"ticket_id": "  "})) == 1
    cost = {"flight_id": "F", "route_id": "R", "flight_date": dt.date(2024, 1, 1)}
    assert len(stage(spark, "flight_costs", cost, cost | {"route_id": " "})) == 1


def test_flight_delays(spark):
    rows = stage(
        spark, "flights",
        *[{"flight_id": str(i), "delay_min": d} for i, d in enumerate((14, 15, 1440, 1441, None))],
    )
    assert [r.is_delayed for r in rows] == [False, True, True, True, False]
    assert [r.is_delay_suspect for r in rows] == [False, False, False, True, False]


def test_flight_id_is_not_trimmed_and_minutes_count_boundaries(spark):
    (row,) = stage(
        spark, "flights",
        {
            "flight_id": " F1", "route_id": " R1 ", "flight_date": dt.date(2024, 5, 1),
            "scheduled_departure": dt.datetime(2024, 5, 1, 10, 0, 59),
            "actual_departure": dt.datetime(2024, 5, 1, 10, 1, 0),
            "scheduled_arrival": dt.datetime(2024, 5, 2, 0, 5, 0),
            "actual_arrival": dt.datetime(2024, 5, 1, 23, 50, 59),
        },
    )
    assert row.flight_id == " F1"
    assert row.flight_cost_key == " F1|R1|2024-05-01"
    assert row.computed_departure_delay_min == 1
    assert row.computed_arrival_delay_min == -15


def test_flight_cost_key_reads_null_parts_as_empty(spark):
    (row,) = stage(spark, "flights", {"flight_id": "F"})
    assert row.flight_cost_key == "F||"


def test_integers_from_text_round_half_away_and_from_bad_text_are_null(spark):
    rows = stage(
        spark, "flights",
        *[{"flight_id": "F", "delay_min": t} for t in ("12.5", "13.5", "-12.5", "x", None)],
        as_text=True,
    )
    assert [r.delay_minutes for r in rows] == [13, 14, -13, None, None]


def test_strict_mode_fails_on_bad_text(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage(spark, "flights", {"flight_id": "F", "delay_min": "x"}, as_text=True, strict=True)


def test_integers_from_doubles_round_half_even(spark):
    raw = sheet(spark, "loyalty_activity", KEYS["loyalty_activity"])
    doubled = raw.drop("miles_amount").selectExpr("*", "explode(array(12.5D, 13.5D)) miles_amount")
    assert [r.miles_amount for r in staging.loyalty_activity(doubled).collect()] == [12, 14]


def test_route_distance_and_speed(spark):
    base = KEYS["routes"] | {"block_time_min": 0}
    rows = stage(spark, "routes", *[base | {"distance_km": d} for d in (499, 500, 1500, 1501, None)])
    assert [r.distance_category for r in rows] == [
        "short_haul", "medium_haul", "medium_haul", "long_haul", None,
    ]
    assert all(r.avg_speed_kmh is None for r in rows)
    (row,) = stage(spark, "routes", base | {"origin_airport_code": "ABJ ", "distance_km": 600,
                                            "block_time_min": 60})
    assert (row.route_key, row.reverse_route_key) == ("ABJ-B", "B-ABJ")
    assert row.avg_speed_kmh == 600.0 and row.is_return_route  # compared untrimmed


def test_customer_tiers_and_generations(spark):
    base = KEYS["customers"]
    tiers = stage(spark, "customers", *[base | {"loyalty_tier": t} for t in ("None", " null ", "", None, "Gold")])
    assert [r.loyalty_tier for r in tiers] == [None, None, None, None, "Gold"]
    assert [r.is_loyalty_member for r in tiers] == [False] * 4 + [True]
    years = (1964, 1965, 1980, 1981, 1996, 1997, 2012, 2013)
    born = [base | {"birth_date": dt.date(y, 12, 31)} for y in years]
    rows = stage(spark, "customers", *born, base)
    assert [r.generation for r in rows] == [
        "Baby Boomer", "Gen X", "Gen X", "Millennial", "Millennial", "Gen Z", "Gen Z",
        "Unknown", "Unknown",
    ]
    assert rows[0].age_years == 61  # years begun, not completed


def test_booking_prices(spark):
    base = KEYS["bookings"] | {"ancillary_revenue_usd": 1.0}
    prices = (-1.0, 0.0, 99.99, 100.0, 300.0, 600.0, None)
    rows = stage(spark, "bookings", *[base | {"ticket_price_usd": p} for p in prices])
    assert [r.ticket_price_category for r in rows] == [
        "low", "free", "low", "medium", "high", "premium", "premium",
    ]
    (row,) = stage(spark, "bookings", KEYS["bookings"] | {"ticket_price_usd": 10.0})
    assert row.total_revenue_usd is None and row.ancillary_revenue_pct == 0


def test_ticket_sentiment_and_urgency(spark):
    base = {"ticket_id": "T", "customer_id": "C", "flight_id": "F"}
    rows = stage(
        spark, "customer_service_tickets",
        *[base | {"sentiment_score": s} for s in (0.5, 0.0, -0.5, -0.51, None)],
    )
    assert [r.sentiment_label for r in rows] == [
        "positive", "neutral", "negative", "very_negative", "very_negative",
    ]
    rows = stage(
        spark, "customer_service_tickets",
        *[base | {"sentiment_score": -0.71, "resolution_status": s} for s in ("Ouvert", "Résolu", None)],
    )
    assert [r.urgency_level for r in rows] == ["critical", "low", "low"]


def test_first_keyword_wins(spark):
    (row,) = stage(spark, "ancillary_details", KEYS["ancillary_details"] | {"item_category": "Siège bagage"})
    assert row.item_category_normalized == "baggage"
    rows = stage(
        spark, "weather_impact",
        *[KEYS["weather_impact"] | {"season_type": s} for s in ("Petite saison sèche", "Saison sèche")],
    )
    assert [r.season_type_normalized for r in rows] == ["short_dry_season", "dry_season"]
    assert [r.delay_category for r in rows] == ["severe", "severe"]  # NULL delay
    (row,) = stage(spark, "loyalty_activity",
                   KEYS["loyalty_activity"] | {"activity_type": "Miles gagnés sur vol"})
    assert row.activity_category == "earn_flight" and row.is_earn


def test_totals_count_rows_that_are_dropped_later(spark):
    base = KEYS["competitor_context"] | {"competitor_average_fare_usd": 100.0}
    (row,) = stage(spark, "competitor_context", base,
                   base | {"market_id": None, "competitor_average_fare_usd": 200.0})
    assert row.nb_competitors_on_route == 2
    assert row.avg_competitor_fare_on_route == 150.0


def test_default_calendar(spark):
    days = dimensions.dim_date(spark).orderBy("date_id").collect()
    assert len(days) == 730
    assert days[-1].full_date == dt.date(2025, 12, 30)
    first = days[0]
    assert (first.date_id, first.day_name, first.quarter_label, first.season_demand) == (
        20240101, "Monday", "Q1 2024", "peak",
    )
    assert sum(d.is_weekend for d in days[:7]) == 2


def test_every_sheet_has_a_model():
    assert set(SHEETS) == set(staging.MODELS)


def test_sums_and_rounding_lose_nothing(spark):
    from altimart.functions.exact import exact_mean, exact_sum, rounded

    def over(values, make):
        rows = spark.createDataFrame([(v,) for v in values], "x double")
        return rows.agg(make(F.col("x"))).first()[0]

    assert over([1e13, 1.0, 2.0], exact_sum) == 10000000000003.0
    assert spark.range(1_000_000).agg(exact_sum(F.lit(4e-7))).first()[0] == 0.4
    assert over([1e13, None, 1.0], exact_mean) == 5000000000000.5
    assert [over([x], lambda c: rounded(F.max(c), 2)) for x in (2.675, -2.675, 1e7 + 0.125, 1e20)] == [2.68, -2.68, 10000000.13, 1e20]
    for bad in (1e18, float("nan"), float("inf")):
        with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|not a finite number"):
            over([bad], exact_sum)


def test_added_files_are_seen(spark, tmp_path):
    import shutil

    from conftest import TINY

    from altimart.queries import QUERIES

    for name in ("part", "supplier", "nation", "orders", "lineitem", "customer", "events"):
        (tmp_path / f"{name}.parquet").mkdir()
        shutil.copy(f"{TINY}/{name}.parquet", tmp_path / f"{name}.parquet" / "a.parquet")
    before = QUERIES["stg_flights"](spark, str(tmp_path)).count()
    shutil.copy(f"{TINY}/part.parquet", tmp_path / "part.parquet" / "b.parquet")
    assert QUERIES["stg_flights"](spark, str(tmp_path)).count() == 2 * before


def test_calendar_ends_with_the_last_flight(spark):
    from conftest import TINY

    from altimart.queries import QUERIES

    last = QUERIES["stg_flights"](spark, TINY).agg(F.max("flight_date")).first()[0]
    assert QUERIES["dim_date"](spark, TINY).agg(F.max("full_date")).first()[0] == last
