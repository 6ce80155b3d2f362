"""Table contracts: columns, keys, write mode and partitioning of every declared table."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import types as T

HOUSEKEEPING = "ingest_ts timestamp NOT NULL, logical_date date NOT NULL, source string NOT NULL, raw_payload string"
RUN_COLUMNS = "_ingest_run_id string, _source_system string"

# --- fixed values: what a bronze row names as its source ------------------------
SOURCE_NAMES = {
    "payments": "postgres-source",
    "rideon": "rideon-source",
    "auth": "postgres.auth",
    "weather": "open-meteo",
    "crypto": "coingecko",
    "earthquake": "usgs",
    "airquality": "openaq",
}
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """One table.

    payload_iso: raw_payload keeps NULL fields, with decimals and ISO times as text;
        otherwise it is Spark's own JSON without NULL fields

    mode: snapshot  replace the day's slice with a full reload
          incremental  the day's rows of an event table
          append    rows are only added
          upsert    insert or replace by key
          slice     replace the partitions present in the result
          full      replace the whole table
          scd2      type 2 dimension
    """

    domain: str
    layer: str
    name: str
    ddl: str
    keys: tuple[str, ...]
    mode: str
    partition: tuple[str, ...] = ()
    day_column: str | None = None
    source_table: str | None = None
    text_columns: tuple[str, ...] = ()
    payload_iso: bool = True
    business_columns: tuple[str, ...] = field(default=())

    @property
    def source_name(self) -> str:
        return SOURCE_NAMES[self.domain]

    @cached_property
    def schema(self) -> T.StructType:
        extra = ""
        if self.layer == "bronze" and self.source_table:
            extra = f", {HOUSEKEEPING}"
            if self.domain == "auth":
                extra += f", {RUN_COLUMNS}"
        return T.StructType.fromDDL(self.ddl + extra)

    @cached_property
    def source_columns(self) -> tuple[str, ...]:
        return tuple(T.StructType.fromDDL(self.ddl).names)


def _bronze(domain, table, source, ddl, keys, day=None, text=(), payload_iso=True) -> TableSpec:
    return TableSpec(
        domain=domain, layer="bronze", name=table, ddl=ddl, keys=keys,
        mode="incremental" if day else "snapshot", partition=("logical_date",), day_column=day,
        source_table=source, text_columns=text, payload_iso=payload_iso,
    )


def _payments(table, source, ddl, key, day=None, text=()) -> TableSpec:
    return _bronze("payments", f"payments_{table}_raw", source, ddl, (key,), day, (key, *text))


def _rideon(table, ddl, key, day=None, text=()) -> TableSpec:
    return _bronze("rideon", f"rideon_{table}_raw", table, ddl, (key,), day, (key, *text))


def _auth(source, ddl, keys, day=None, text=()) -> TableSpec:
    return _bronze("auth", f"{source}_raw", source, ddl, keys, day, text, payload_iso=False)


def _api(domain, table, ddl, keys, day) -> TableSpec:
    return TableSpec(domain, "bronze", table, f"{ddl}, {HOUSEKEEPING}", keys, "append", ("logical_date",), day)


# Fixed values from here on: names, types, keys and write modes of all tables.

BRONZE = [
    _payments("merchants", "merchants", """merchant_id string NOT NULL, name string, category_code string,
        mcc_code string, country string, city string, status string, created_at timestamp""", "merchant_id"),
    _payments("customers", "customers", """customer_id string NOT NULL, first_name string, last_name string,
        email string, birthdate date, phone string, country string, city string, created_at timestamp""", "customer_id"),
    _payments("methods", "payment_methods", """method_id string NOT NULL, customer_id string, type string,
        provider string, card_brand string, last4 string, expiry_month int, expiry_year int,
        is_default boolean, created_at timestamp""", "method_id", text=("customer_id",)),
    _payments("payments", "payments", """payment_id string NOT NULL, merchant_id string, customer_id string,
        method_id string, amount decimal(14,2), currency string, status string, error_code string,
        description string, reference_id string, created_at timestamp, updated_at timestamp,
        settled_at timestamp""", "payment_id", "updated_at", ("merchant_id", "customer_id", "method_id", "reference_id")),
    _payments("refunds", "refunds", """refund_id string NOT NULL, payment_id string, amount decimal(14,2),
        currency string, reason string, status string, created_at timestamp, updated_at timestamp""",
        "refund_id", "updated_at", ("payment_id",)),
    _payments("fees", "fees", """fee_id string NOT NULL, payment_id string, fee_type string,
        amount decimal(14,2), currency string, created_at timestamp""", "fee_id", "created_at", ("payment_id",)),
    _payments("settlements", "settlements", """settlement_id string NOT NULL, merchant_id string,
        settlement_date date, amount decimal(14,2), currency string, payments_count int, status string,
        created_at timestamp""", "settlement_id", "settlement_date", ("merchant_id",)),
    _rideon("cities", """city_id string NOT NULL, name string, country string, timezone string,
        launched_at timestamp""", "city_id"),
    _rideon("vehicle_categories", """category_id string NOT NULL, code string, display_name string,
        base_fare decimal(8,2), per_km_rate decimal(8,2), per_min_rate decimal(8,2), min_fare decimal(8,2)""",
        "category_id"),
    _rideon("riders", """rider_id string NOT NULL, first_name string, last_name string, email string,
        phone string, city_id string, rating decimal(2,1), created_at timestamp""", "rider_id", text=("city_id",)),
    _rideon("drivers", """driver_id string NOT NULL, first_name string, last_name string, email string,
        phone string, city_id string, license_number string, status string, rating decimal(2,1),
        onboarded_at timestamp""", "driver_id", text=("city_id",)),
    _rideon("vehicles", """vehicle_id string NOT NULL, driver_id string, category_id string, make string,
        model string, year int, plate_number string, color string, registered_at timestamp""",
        "vehicle_id", text=("driver_id", "category_id")),
    _rideon("rides", """ride_id string NOT NULL, rider_id string, driver_id string, vehicle_id string,
        city_id string, category_id string, status string, requested_at timestamp, accepted_at timestamp,
        started_at timestamp, completed_at timestamp, pickup_lat decimal(9,6), pickup_lng decimal(9,6),
        dropoff_lat decimal(9,6), dropoff_lng decimal(9,6), distance_km decimal(8,2),
        duration_min decimal(8,2), surge_multiplier decimal(4,2), cancelled_by string,
        created_at timestamp, updated_at timestamp""", "ride_id", "updated_at",
        ("rider_id", "driver_id", "vehicle_id", "city_id", "category_id")),
    _rideon("fares", """fare_id string NOT NULL, ride_id string, base_fare decimal(10,2),
        distance_fare decimal(10,2), time_fare decimal(10,2), surge_amount decimal(10,2),
        discount decimal(10,2), total_fare decimal(10,2), currency string, created_at timestamp""",
        "fare_id", "created_at", ("ride_id",)),
    _rideon("ride_payments", """payment_id string NOT NULL, ride_id string, rider_id string, method string,
        amount decimal(10,2), currency string, status string, created_at timestamp, updated_at timestamp""",
        "payment_id", "updated_at", ("ride_id", "rider_id")),
    _rideon("ratings", """rating_id string NOT NULL, ride_id string, rater_role string, score int,
        comment string, created_at timestamp""", "rating_id", "created_at", ("ride_id",)),
    _rideon("driver_payouts", """payout_id string NOT NULL, driver_id string, payout_date date,
        gross_amount decimal(12,2), commission decimal(12,2), net_amount decimal(12,2), currency string,
        rides_count int, status string, created_at timestamp""", "payout_id", "payout_date", ("driver_id",)),
    _auth("users", """user_id string, username string, email string, email_verified boolean, status string,
        display_name string, country string, created_at timestamp, updated_at timestamp,
        last_login_at timestamp""", ("user_id",)),
    _auth("credentials", """credential_id string, user_id string, password_hash string, algo string,
        password_changed_at timestamp, must_reset boolean""", ("credential_id",)),
    _auth("user_profiles", """user_id string, full_name string, phone string, locale string, timezone string,
        avatar_url string, date_of_birth date, updated_at timestamp""", ("user_id",)),
    _auth("roles", "role_id string, name string, description string", ("role_id",)),
    _auth("permissions", "permission_id string, code string, description string", ("permission_id",)),
    _auth("role_permissions", "role_id string, permission_id string", ("role_id", "permission_id")),
    _auth("user_roles", "user_id string, role_id string, granted_at timestamp", ("user_id", "role_id")),
    _auth("sessions", """session_id string, user_id string, created_at timestamp, expires_at timestamp,
        revoked_at timestamp, ip_address string, user_agent string, auth_method string""",
        ("session_id",), "created_at", ("ip_address",)),
    _auth("login_attempts", """attempt_id bigint, user_id string, username_tried string,
        attempted_at timestamp, success boolean, failure_reason string, mfa_challenged boolean,
        ip_address string, user_agent string, auth_method string""",
        ("attempt_id",), "attempted_at", ("ip_address",)),
    _auth("oauth_accounts", """oauth_account_id string, user_id string, provider string,
        provider_user_id string, linked_at timestamp""", ("oauth_account_id",)),
    _auth("mfa_devices", """mfa_device_id string, user_id string, device_type string, label string,
        confirmed boolean, created_at timestamp, last_used_at timestamp""", ("mfa_device_id",)),
    _auth("password_reset_tokens", """token_id string, user_id string, token_hash string,
        created_at timestamp, expires_at timestamp, used_at timestamp""", ("token_id",), "created_at"),
    _auth("audit_log", """audit_id bigint, user_id string, event_type string, event_at timestamp,
        ip_address string, detail string""", ("audit_id",), "event_at", ("ip_address", "detail")),
    TableSpec("weather", "bronze", "weather_raw", """city string NOT NULL, lat double, lon double,
        observation_ts timestamp NOT NULL, temperature_2m double, relative_humidity_2m double,
        wind_speed_10m double, precipitation double, pressure_msl double, cloud_cover double,
        ingest_ts timestamp NOT NULL, source string NOT NULL, raw_payload string, observation_date date""",
        ("city", "observation_ts"), "append", ("observation_date",), "observation_ts"),
    _api("crypto", "crypto_prices_raw", """coin_id string NOT NULL, symbol string, name string,
        current_price_usd double, market_cap_usd double, market_cap_rank int, total_volume_usd double,
        high_24h_usd double, low_24h_usd double, price_change_24h_usd double,
        price_change_percentage_24h double, price_change_percentage_7d double, market_cap_change_24h double,
        market_cap_change_percentage_24h double, circulating_supply double, total_supply double,
        max_supply double, ath_usd double, ath_change_percentage double, last_updated timestamp""",
        ("coin_id", "logical_date"), "logical_date"),
    _api("earthquake", "earthquake_raw", """event_id string NOT NULL, mag double, mag_type string,
        place string, event_time timestamp NOT NULL, updated_time timestamp, latitude double,
        longitude double, depth_km double, alert string, tsunami int, sig int, net string, status string""",
        ("event_id",), "event_time"),
    _api("airquality", "airquality_hourly_raw", """sensor_id int NOT NULL, location_id int NOT NULL,
        location_name string, country_code string, latitude double, longitude double,
        parameter_name string NOT NULL, parameter_units string, parameter_id int,
        hour_utc timestamp NOT NULL, value double, summary_min double, summary_max double,
        summary_sd double, percent_coverage double, observed_count int""",
        ("sensor_id", "hour_utc"), "hour_utc"),
]


def _silver(domain, name, ddl, keys, partition=(), business=()) -> TableSpec:
    return TableSpec(domain, "silver", name, ddl, keys, "upsert", partition, business_columns=business)


def _clean(name, ddl, key, partition=(), business=()) -> TableSpec:
    """An identity table: cleaned columns, then hash and load columns."""
    ddl = f"{ddl}, _record_hash string, _loaded_at timestamp, _source_logical_date date"
    return TableSpec("auth", "silver", name, ddl, (key,), "upsert", partition, business_columns=business)


def _model(layer, name, ddl, keys) -> TableSpec:
    """A ride-hailing model, rebuilt whole."""
    return TableSpec("rideon", layer, name, ddl, keys, "full")


SILVER = [
    _silver("payments", "dim_customer", """customer_id string NOT NULL, first_name string, last_name string,
        email string, birthdate date, age_band string, country string, city string, phone string,
        created_at timestamp, updated_at timestamp NOT NULL""", ("customer_id",)),
    _silver("payments", "dim_merchant", """merchant_id string NOT NULL, name string, category_code string,
        mcc_code string, country string, city string, status string, created_at timestamp,
        updated_at timestamp NOT NULL""", ("merchant_id",)),
    _silver("payments", "dim_payment_method", """method_id string NOT NULL, customer_id string, type string,
        provider string, card_brand string, last4 string, expiry_month int, expiry_year int,
        is_default boolean, is_expired boolean, created_at timestamp, updated_at timestamp NOT NULL""",
        ("method_id",)),
    _silver("payments", "dim_date", """date date NOT NULL, day int NOT NULL, month int NOT NULL,
        quarter int NOT NULL, year int NOT NULL, day_of_week int NOT NULL, day_name string NOT NULL,
        is_weekend boolean NOT NULL, iso_week int NOT NULL""", ("date",)),
    _silver("payments", "fact_payments", """payment_id string NOT NULL, payment_date date NOT NULL,
        customer_id string, merchant_id string, method_id string, amount decimal(14,2), currency string,
        status string, error_code string, description string, reference_id string, created_at timestamp,
        updated_at timestamp, settled_at timestamp, settled_lag_hours double""",
        ("payment_id",), ("payment_date",)),
    _silver("payments", "fact_refunds", """refund_id string NOT NULL, refund_date date NOT NULL,
        payment_id string, amount decimal(14,2), currency string, reason string, status string,
        created_at timestamp, updated_at timestamp""", ("refund_id",), ("refund_date",)),
    _silver("payments", "fact_fees", """fee_id string NOT NULL, fee_date date NOT NULL, payment_id string,
        fee_type string, amount decimal(14,2), currency string, created_at timestamp""",
        ("fee_id",), ("fee_date",)),
    _silver("payments", "fact_settlements", """settlement_id string NOT NULL, settlement_date date NOT NULL,
        merchant_id string, amount decimal(14,2), currency string, payments_count int, status string,
        created_at timestamp""", ("settlement_id",), ("settlement_date",)),
    _silver("weather", "weather_hourly", """city string NOT NULL, lat double, lon double,
        observation_ts timestamp NOT NULL, temperature_2m double, relative_humidity_2m double,
        wind_speed_10m double, precipitation double, pressure_msl double, cloud_cover double,
        source string NOT NULL, observation_date date""", ("city", "observation_ts"), ("observation_date",)),
    _silver("crypto", "crypto_prices_daily", """coin_id string NOT NULL, symbol string, name string,
        day date NOT NULL, current_price_usd double, market_cap_usd double, market_cap_rank int,
        total_volume_usd double, high_24h_usd double, low_24h_usd double, price_change_24h_usd double,
        price_change_percentage_24h double, price_change_percentage_7d double, market_cap_change_24h double,
        market_cap_change_percentage_24h double, circulating_supply double, total_supply double,
        max_supply double, ath_usd double, ath_change_percentage double, last_updated timestamp,
        source string NOT NULL""", ("coin_id", "day"), ("day",)),
    _silver("earthquake", "earthquake_events", """event_id string NOT NULL, mag double, mag_type string,
        place string, event_time timestamp NOT NULL, updated_time timestamp, latitude double,
        longitude double, depth_km double, alert string, tsunami int, sig int, net string, status string,
        event_date date NOT NULL, magnitude_class string""", ("event_id",), ("event_date",)),
    _silver("airquality", "airquality_hourly", """sensor_id int NOT NULL, location_id int NOT NULL,
        location_name string, country_code string, latitude double, longitude double,
        parameter_name string NOT NULL, parameter_units string, hour_utc timestamp NOT NULL,
        measurement_date date NOT NULL, hour_of_day int, value double, summary_min double,
        summary_max double, percent_coverage double, ingest_ts timestamp NOT NULL,
        logical_date date NOT NULL""", ("sensor_id", "hour_utc"), ("measurement_date",)),
    _clean("users", """user_id string NOT NULL, username string, email string, email_verified boolean,
        status string, display_name string, country string, created_at timestamp, updated_at timestamp,
        last_login_at timestamp, is_locked boolean""", "user_id",
        business=("username", "email", "status", "country", "display_name", "email_verified")),
    _clean("roles", "role_id string NOT NULL, name string, description string", "role_id",
           business=("name", "description")),
    _clean("permissions", "permission_id string NOT NULL, code string, description string", "permission_id",
           business=("code", "description")),
    _clean("sessions", """session_id string NOT NULL, user_id string, created_at timestamp, expires_at timestamp,
        revoked_at timestamp, auth_method string, ip_address string, user_agent string, is_active boolean,
        was_revoked boolean, session_duration_seconds bigint""", "session_id", ("_source_logical_date",),
        ("user_id", "auth_method", "is_active", "was_revoked")),
    _clean("login_attempts", """attempt_id bigint NOT NULL, user_id string, username_tried string,
        attempted_at timestamp, success boolean, failure_reason string, mfa_challenged boolean,
        auth_method string, ip_address string, attempt_outcome string""", "attempt_id", ("_source_logical_date",),
        ("user_id", "success", "failure_reason", "auth_method", "mfa_challenged")),
    _clean("oauth_accounts", """oauth_account_id string NOT NULL, user_id string, provider string,
        provider_user_id string, linked_at timestamp""", "oauth_account_id", business=("user_id", "provider")),
    _clean("mfa_devices", """mfa_device_id string NOT NULL, user_id string, device_type string, label string,
        confirmed boolean, created_at timestamp, last_used_at timestamp""", "mfa_device_id",
        business=("user_id", "device_type", "confirmed")),
    _model("silver", "dim_city", """city_id string NOT NULL, city_name string, country string, timezone string,
        launched_at timestamp, launched_date date""", ("city_id",)),
    _model("silver", "dim_vehicle_category", """category_id string NOT NULL, code string, display_name string,
        base_fare decimal(8,2), per_km_rate decimal(8,2), per_min_rate decimal(8,2), min_fare decimal(8,2)""",
        ("category_id",)),
    _model("silver", "dim_rider", """rider_id string NOT NULL, first_name string, last_name string,
        full_name string, email string, phone string, city_id string, city_name string, country string,
        rating decimal(2,1), created_at timestamp, signup_date date""", ("rider_id",)),
    _model("silver", "dim_driver", """driver_id string NOT NULL, first_name string, last_name string,
        full_name string, email string, phone string, city_id string, city_name string, country string,
        license_number string, status string, rating decimal(2,1), onboarded_at timestamp,
        onboarded_date date""", ("driver_id",)),
    _model("silver", "dim_vehicle", """vehicle_id string NOT NULL, driver_id string, category_id string,
        category_code string, category_name string, make string, model string, make_model string, year int,
        plate_number string, color string, registered_at timestamp""", ("vehicle_id",)),
    _model("silver", "dim_date", """date_day date NOT NULL, year int, quarter int, month int, day int,
        day_of_week int, day_name string, iso_week int, is_weekend boolean""", ("date_day",)),
    _model("silver", "fact_rides", """ride_id string NOT NULL, ride_date date, rider_id string, driver_id string,
        vehicle_id string, city_id string, category_id string, status string, cancelled_by string,
        requested_at timestamp, accepted_at timestamp, started_at timestamp, completed_at timestamp,
        distance_km decimal(8,2), duration_min decimal(8,2), surge_multiplier decimal(4,2),
        total_fare decimal(10,2), surge_amount decimal(10,2), discount decimal(10,2), currency string,
        wait_min decimal(21,2), is_completed boolean, is_cancelled boolean, is_surge boolean""", ("ride_id",)),
    _model("silver", "fact_ride_payments", """payment_id string NOT NULL, payment_date date, ride_id string,
        rider_id string, driver_id string, city_id string, category_id string, method string,
        amount decimal(10,2), currency string, status string, is_captured boolean, is_refunded boolean,
        created_at timestamp, updated_at timestamp""", ("payment_id",)),
    _model("silver", "fact_ratings", """rating_id string NOT NULL, rating_date date, ride_id string,
        rider_id string, driver_id string, city_id string, category_id string, rater_role string, score int,
        comment string, created_at timestamp""", ("rating_id",)),
    _model("silver", "fact_driver_payouts", """payout_id string NOT NULL, payout_date date, driver_id string,
        city_id string, gross_amount decimal(12,2), commission decimal(12,2), net_amount decimal(12,2),
        currency string, rides_count int, status string, avg_fare_per_ride decimal(13,2)""", ("payout_id",)),
]


def _gold(domain, name, ddl, keys, partition, mode="slice") -> TableSpec:
    return TableSpec(domain, "gold", name, ddl, keys, mode, partition)


# Mart sums and counts are wider than the source columns, so a large day cannot overflow.
GOLD = [
    _gold("payments", "daily_payment_summary", """day date NOT NULL, total_payments bigint NOT NULL,
        total_volume decimal(24,2), successful_count bigint NOT NULL, failed_count bigint NOT NULL,
        success_rate_pct double, avg_amount decimal(24,2), unique_customers bigint NOT NULL,
        unique_merchants bigint NOT NULL, refund_volume decimal(24,2), fee_volume decimal(24,2),
        net_revenue decimal(24,2), computed_at timestamp NOT NULL""", ("day",), ("day",)),
    _gold("payments", "daily_revenue_by_merchant", """merchant_id string NOT NULL, merchant_name string,
        category_code string, day date NOT NULL, gross_volume decimal(24,2), txn_count bigint NOT NULL,
        success_count bigint NOT NULL, refund_amount decimal(24,2), fee_amount decimal(24,2),
        net_revenue decimal(24,2), avg_ticket decimal(24,2), computed_at timestamp NOT NULL""",
        ("merchant_id", "day"), ("day",)),
    _gold("payments", "customer_lifetime_value", """customer_id string NOT NULL, full_name string,
        country string, age_band string, total_spend decimal(24,2), total_payments bigint NOT NULL,
        successful_payments bigint NOT NULL, failed_payments bigint NOT NULL, total_refunds decimal(24,2),
        refund_rate_pct double, first_payment_date date, last_payment_date date, active_days bigint NOT NULL,
        computed_at timestamp NOT NULL""", ("customer_id",), (), "full"),
    _gold("payments", "merchant_settlement_daily", """merchant_id string NOT NULL, merchant_name string,
        settlement_date date NOT NULL, settled_amount decimal(24,2), settled_payments_count bigint NOT NULL,
        gross_volume_for_date decimal(24,2), settlement_lag_days int, status string,
        computed_at timestamp NOT NULL""", ("merchant_id", "settlement_date"), ("settlement_date",)),
    _gold("weather", "weather_daily", """city string NOT NULL, day date NOT NULL, temp_min double,
        temp_max double, temp_avg double, humidity_avg double, wind_max double, precipitation_total double,
        hours_observed bigint NOT NULL, computed_at timestamp NOT NULL""", ("city", "day"), ("city", "day")),
    _gold("crypto", "crypto_market_daily", """day date NOT NULL, coin_count bigint NOT NULL,
        total_market_cap_usd double, total_volume_usd double, top_gainer_coin_id string,
        top_gainer_pct_24h double, top_loser_coin_id string, top_loser_pct_24h double,
        highest_volume_coin_id string, highest_volume_usd double, computed_at timestamp NOT NULL""",
        ("day",), ("day",)),
    _gold("earthquake", "earthquake_daily", """event_date date NOT NULL, total_count bigint NOT NULL,
        max_magnitude double, avg_magnitude double, avg_depth_km double, tsunami_count bigint NOT NULL,
        significant_count bigint NOT NULL, micro_count bigint NOT NULL, minor_count bigint NOT NULL,
        light_count bigint NOT NULL, moderate_count bigint NOT NULL, strong_count bigint NOT NULL,
        major_count bigint NOT NULL, great_count bigint NOT NULL, most_significant_place string,
        most_significant_magnitude double""", ("event_date",), ("event_date",)),
    _gold("airquality", "airquality_daily", """location_id int NOT NULL, location_name string,
        country_code string, parameter_name string NOT NULL, measurement_date date NOT NULL,
        avg_value double, min_value double, max_value double, hourly_reading_count bigint NOT NULL,
        aqi_category string""", ("location_id", "parameter_name", "measurement_date"), ("measurement_date",)),
    _gold("auth", "dim_date", """date_key int NOT NULL, full_date date, year int, quarter int, month int,
        day_of_month int, day_of_week int, week_of_year int, day_name string, month_name string,
        is_weekend boolean, _loaded_at timestamp""", ("date_key",), (), "upsert"),
    _gold("auth", "dim_role", """role_id string NOT NULL, role_name string, description string,
        permission_count bigint, _record_hash string, _loaded_at timestamp""", ("role_id",), (), "upsert"),
    _gold("auth", "dim_auth_method", """auth_method_sk string NOT NULL, method_code string, method_family string,
        _loaded_at timestamp""", ("auth_method_sk",), (), "upsert"),
    _gold("auth", "dim_user", """user_sk string, user_nk string, username string, email string, status string,
        country string, display_name string, is_mfa_enabled boolean, primary_role string,
        _loaded_at timestamp, _record_hash string, _effective_from timestamp, _effective_to timestamp,
        _is_current boolean, _closed_on date""", ("user_nk",), ("_closed_on",), "scd2"),
    _gold("auth", "fact_login_attempts", """attempt_id bigint NOT NULL, user_sk string, date_key int,
        auth_method_sk string, attempted_at timestamp, is_success int, is_mfa_challenged int,
        failure_reason string, attempt_date date, _loaded_at timestamp""", ("attempt_id",), ("attempt_date",), "upsert"),
    _gold("auth", "fact_sessions", """session_id string NOT NULL, user_sk string, date_key int,
        auth_method_sk string, created_at timestamp, session_duration_seconds bigint, is_active int,
        was_revoked int, session_date date, _loaded_at timestamp""", ("session_id",), ("session_date",), "upsert"),
    _model("gold", "daily_city_performance", """day date, city_id string, city_name string, country string,
        total_rides bigint, completed_rides bigint, cancelled_rides bigint,
        cancellation_rate_pct decimal(27,2), gross_fare decimal(20,2), avg_surge decimal(16,3),
        avg_distance_km decimal(19,2), avg_duration_min decimal(19,2), unique_riders bigint,
        unique_drivers bigint""", ("day", "city_id")),
    _model("gold", "driver_earnings_daily", """day date, driver_id string, driver_name string, city_id string,
        city_name string, rides_count int, gross_amount decimal(12,2), commission decimal(12,2),
        net_amount decimal(12,2), avg_fare_per_ride decimal(13,2), currency string,
        avg_rating_received double, ratings_received bigint""", ("day", "driver_id")),
    _model("gold", "rider_lifetime_value", """rider_id string, rider_name string, city_name string,
        country string, total_rides bigint, completed_rides bigint, cancelled_rides bigint,
        cancellation_rate_pct decimal(27,2), total_spend decimal(20,2), avg_fare decimal(21,2),
        avg_distance_km decimal(19,2), first_ride_date date, last_ride_date date""", ("rider_id",)),
    _model("gold", "surge_pricing_analysis", """day date, city_id string, city_name string, category_id string,
        category_code string, total_rides bigint, surge_rides bigint, surge_ride_pct decimal(27,2),
        avg_surge_multiplier decimal(16,3), max_surge_multiplier decimal(4,2), surge_revenue decimal(20,2),
        gross_fare decimal(20,2)""", ("day", "city_id", "category_id")),
]

SPECS = {(s.domain, s.layer, s.name): s for s in (*BRONZE, *SILVER, *GOLD)}


def spec(domain: str, layer: str, name: str) -> TableSpec:
    return SPECS[(domain, layer, name)]
