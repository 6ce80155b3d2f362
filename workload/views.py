"""The given tables seen as the domains' bronze tables.

Each text is plain SQL that Spark and DuckDB both run; {name} stands for a given
table or another view. Spark builds job inputs from them, the oracles use them as
common table expressions. Measures that get averaged are cut to multiples of 1/4, so
sums of doubles are exact in any order of addition.
"""

VIEWS = {
    # --- payments -----------------------------------------------------------
    "order_merchant": """
        SELECT l_orderkey AS m_orderkey, MIN(l_suppkey) AS merchant FROM {lineitem} GROUP BY l_orderkey
    """,
    "pay_merchants": """
        SELECT CAST(s_suppkey AS STRING) AS merchant_id,
            CASE WHEN rev = 0 THEN 'old ' || s_name ELSE s_name END AS name,
            CASE s_suppkey % 5 WHEN 0 THEN 'grocery' WHEN 1 THEN 'travel' WHEN 2 THEN 'fuel'
                WHEN 3 THEN 'dining' ELSE 'retail' END AS category_code,
            CAST(5000 + s_suppkey % 1000 AS STRING) AS mcc_code,
            CAST(s_nationkey AS STRING) AS country,
            'City ' || CAST(s_nationkey AS STRING) AS city,
            CASE WHEN s_acctbal < 0 THEN 'inactive' ELSE 'active' END AS status,
            TIMESTAMP '1994-01-01 00:00:00' + INTERVAL '1' DAY * (s_suppkey % 365) AS created_at,
            TIMESTAMP '2001-08-01 06:00:00' + INTERVAL '1' HOUR * (12 * rev) AS ingest_ts,
            DATE '2001-08-01' AS logical_date
        FROM (SELECT s.*, 0 AS rev FROM {supplier} s UNION ALL SELECT s.*, 1 AS rev FROM {supplier} s) x
    """,
    "pay_customers": """
        SELECT CAST(c_custkey AS STRING) AS customer_id,
            CASE WHEN rev = 0 THEN 'Old' ELSE 'Customer' END AS first_name,
            CAST(c_custkey AS STRING) AS last_name,
            'c' || CAST(c_custkey AS STRING) || '@example.com' AS email,
            CAST(TIMESTAMP '1935-01-01 00:00:00' + INTERVAL '1' DAY * ((c_custkey * 37) % 18000) AS DATE) AS birthdate,
            CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE '555-' || CAST(c_custkey AS STRING) END AS phone,
            CAST(c_nationkey AS STRING) AS country, c_mktsegment AS city,
            TIMESTAMP '1994-06-01 00:00:00' + INTERVAL '1' DAY * (c_custkey % 400) AS created_at,
            TIMESTAMP '2001-08-01 06:00:00' + INTERVAL '1' HOUR * (12 * rev) AS ingest_ts,
            DATE '2001-08-01' AS logical_date
        FROM (SELECT c.*, 0 AS rev FROM {customer} c UNION ALL SELECT c.*, 1 AS rev FROM {customer} c) x
    """,
    "pay_methods": """
        SELECT CAST(c_custkey AS STRING) || '-' || CAST(n AS STRING) AS method_id,
            CAST(c_custkey AS STRING) AS customer_id,
            CASE WHEN n = 0 THEN 'card' ELSE 'wallet' END AS type, 'provider' AS provider,
            CASE WHEN n = 0 THEN 'visa' END AS card_brand,
            CAST(c_custkey % 10000 AS STRING) AS last4,
            CASE WHEN c_custkey % 5 = 0 AND n = 1 THEN NULL ELSE CAST(1 + c_custkey % 12 AS INT) END AS expiry_month,
            CASE WHEN c_custkey % 3 = 0 AND n = 1 THEN NULL ELSE CAST(1998 + c_custkey % 7 AS INT) END AS expiry_year,
            n = 0 AS is_default,
            TIMESTAMP '1994-06-01 00:00:00' + INTERVAL '1' DAY * (c_custkey % 400) AS created_at,
            TIMESTAMP '2001-08-01 06:00:00' AS ingest_ts, DATE '2001-08-01' AS logical_date
        FROM (SELECT c.*, 0 AS n FROM {customer} c UNION ALL SELECT c.*, 1 AS n FROM {customer} c) x
    """,
    "pay_payments": """
        SELECT CAST(o_orderkey AS STRING) AS payment_id, CAST(merchant AS STRING) AS merchant_id,
            CAST(o_custkey AS STRING) AS customer_id, CAST(o_custkey AS STRING) || '-0' AS method_id,
            CAST(o_totalprice AS DECIMAL(14,2)) AS amount,
            CASE o_custkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' ELSE 'USD' END AS currency,
            CASE WHEN rev = 0 OR o_orderstatus = 'O' THEN 'pending' WHEN o_orderstatus = 'F' THEN 'completed'
                ELSE 'failed' END AS status,
            CASE WHEN rev = 1 AND o_orderstatus = 'P' THEN 'card_declined' END AS error_code,
            o_orderpriority AS description, 'ref-' || CAST(o_orderkey AS STRING) AS reference_id,
            o_orderdate AS created_at, o_orderdate + INTERVAL '1' HOUR * rev AS updated_at,
            CASE WHEN rev = 1 AND o_orderstatus = 'F'
                THEN o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 72) END AS settled_at,
            o_orderdate + INTERVAL '1' HOUR * rev AS ingest_ts, CAST(o_orderdate AS DATE) AS logical_date
        FROM (SELECT o.*, 0 AS rev FROM {orders} o UNION ALL SELECT o.*, 1 AS rev FROM {orders} o) x
        LEFT JOIN {order_merchant} m ON o_orderkey = m_orderkey
    """,
    "pay_refunds": """
        SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS refund_id,
            CAST(l_orderkey AS STRING) AS payment_id, CAST(l_extendedprice AS DECIMAL(14,2)) AS amount,
            CASE o_custkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' ELSE 'USD' END AS currency,
            'part ' || CAST(l_partkey AS STRING) || ' supplier ' || CAST(l_suppkey AS STRING) AS reason,
            'completed' AS status,
            o_orderdate + INTERVAL '1' DAY * (l_linenumber % 3) AS created_at,
            o_orderdate + INTERVAL '1' DAY * (l_linenumber % 3) AS updated_at,
            l_shipdate AS ingest_ts,
            CAST(o_orderdate + INTERVAL '1' DAY * (l_linenumber % 3) AS DATE) AS logical_date
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'
    """,
    "pay_fees": """
        SELECT 'fee-' || CAST(o_orderkey AS STRING) AS fee_id, CAST(o_orderkey AS STRING) AS payment_id,
            CASE o_orderkey % 3 WHEN 0 THEN 'processing' WHEN 1 THEN 'interchange' ELSE 'scheme' END AS fee_type,
            CAST(o_totalprice AS DECIMAL(14,2)) AS base_amount,
            CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CASE o_orderkey % 3 WHEN 0 THEN CAST(0.029 AS DECIMAL(5,3))
                WHEN 1 THEN CAST(0.018 AS DECIMAL(5,3)) ELSE CAST(0.003 AS DECIMAL(5,3)) END
                AS DECIMAL(14,2)) AS amount,
            'USD' AS currency, o_orderdate AS created_at, o_orderdate AS ingest_ts,
            CAST(o_orderdate AS DATE) AS logical_date
        FROM {orders}
    """,
    "pay_settlements": """
        SELECT CAST(merchant AS STRING) || '/' || CAST(CAST(o_orderdate AS DATE) AS STRING) AS settlement_id,
            CAST(merchant AS STRING) AS merchant_id, CAST(o_orderdate AS DATE) AS settlement_date,
            CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(14,2)) AS amount, 'USD' AS currency,
            CAST(COUNT(*) AS INT) AS payments_count, 'processed' AS status,
            CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL '1' DAY * (merchant % 4) AS created_at,
            CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL '1' DAY * (merchant % 4) AS ingest_ts,
            CAST(o_orderdate AS DATE) AS logical_date
        FROM {orders} JOIN {order_merchant} ON o_orderkey = m_orderkey
        WHERE o_orderstatus = 'F' GROUP BY merchant, CAST(o_orderdate AS DATE)
    """,
    # --- ride-hailing -------------------------------------------------------
    "ride_cities": """
        SELECT CAST(n_nationkey AS STRING) AS city_id,
            CASE WHEN rev = 0 THEN 'old ' || n_name ELSE n_name END AS name,
            CAST(n_regionkey AS STRING) AS country, 'UTC' AS timezone,
            TIMESTAMP '1994-01-01 08:30:00' + INTERVAL '1' DAY * n_nationkey AS launched_at,
            TIMESTAMP '2001-08-01 00:00:00' + INTERVAL '1' DAY * rev AS ingest_ts
        FROM (SELECT n.*, 0 AS rev FROM {nation} n UNION ALL SELECT n.*, 1 AS rev FROM {nation} n) x
    """,
    "ride_categories": """
        SELECT CAST(r_regionkey AS STRING) AS category_id, lower(r_name) AS code, r_name AS display_name,
            CAST(1.5 + 0.5 * r_regionkey AS DECIMAL(8,2)) AS base_fare,
            CAST(0.8 + 0.1 * r_regionkey AS DECIMAL(8,2)) AS per_km_rate,
            CAST(0.25 AS DECIMAL(8,2)) AS per_min_rate, CAST(20 + 5 * r_regionkey AS DECIMAL(8,2)) AS min_fare,
            TIMESTAMP '2001-08-01 00:00:00' AS ingest_ts
        FROM {region}
    """,
    "ride_riders": """
        SELECT CAST(c_custkey AS STRING) AS rider_id, 'Rider' AS first_name, c_name AS last_name,
            'r' || CAST(c_custkey AS STRING) || '@example.com' AS email, CAST(NULL AS STRING) AS phone,
            CAST(c_nationkey AS STRING) AS city_id,
            CAST(1 + (c_custkey % 40) * 0.1 AS DECIMAL(2,1)) AS rating,
            TIMESTAMP '1994-06-01 12:00:00' + INTERVAL '1' DAY * (c_custkey % 400) AS created_at,
            TIMESTAMP '2001-08-01 00:00:00' AS ingest_ts
        FROM {customer}
    """,
    "ride_drivers": """
        SELECT CAST(s_suppkey AS STRING) AS driver_id, 'Driver' AS first_name, s_name AS last_name,
            'd' || CAST(s_suppkey AS STRING) || '@example.com' AS email, CAST(NULL AS STRING) AS phone,
            CAST(s_nationkey AS STRING) AS city_id, 'L' || CAST(s_suppkey AS STRING) AS license_number,
            CASE WHEN s_acctbal < 0 THEN 'suspended' ELSE 'active' END AS status,
            CAST(1 + (s_suppkey % 40) * 0.1 AS DECIMAL(2,1)) AS rating,
            TIMESTAMP '1994-06-01 12:00:00' + INTERVAL '1' DAY * (s_suppkey % 400) AS onboarded_at,
            TIMESTAMP '2001-08-01 00:00:00' AS ingest_ts
        FROM {supplier}
    """,
    "ride_vehicles": """
        SELECT CAST(p_partkey AS STRING) AS vehicle_id, CAST(p_partkey % 97 AS STRING) AS driver_id,
            CAST(p_partkey % 6 AS STRING) AS category_id, p_brand AS make, p_name AS model,
            CAST(2000 + p_size % 24 AS INT) AS year, 'P-' || CAST(p_partkey AS STRING) AS plate_number,
            CASE WHEN p_size > 25 THEN 'black' END AS color,
            TIMESTAMP '1994-09-01 00:00:00' + INTERVAL '1' DAY * (p_partkey % 700) AS registered_at,
            TIMESTAMP '2001-08-01 00:00:00' AS ingest_ts
        FROM {part}
    """,
    "ride_rides": """
        SELECT ride_id, rider_id, driver_id, vehicle_id, city_id, category_id, status, requested_at,
            CASE WHEN status <> 'requested' THEN requested_at + INTERVAL '1' SECOND * (30 + l_suppkey % 211) END
                AS accepted_at,
            CASE WHEN status = 'completed' THEN requested_at + INTERVAL '1' MINUTE * 6 END AS started_at,
            CASE WHEN status = 'completed' THEN requested_at + INTERVAL '1' MINUTE * 66 END AS completed_at,
            CAST(l_suppkey % 60 AS DECIMAL(9,6)) AS pickup_lat, CAST(l_partkey % 60 AS DECIMAL(9,6)) AS pickup_lng,
            CAST(NULL AS DECIMAL(9,6)) AS dropoff_lat, CAST(NULL AS DECIMAL(9,6)) AS dropoff_lng,
            CASE WHEN status = 'completed' THEN CAST(l_quantity AS DECIMAL(8,2)) END AS distance_km,
            CASE WHEN status = 'completed' THEN CAST(l_quantity * 2.5 AS DECIMAL(8,2)) END AS duration_min,
            CAST(CASE WHEN l_tax >= 0.075 THEN 2.0 WHEN l_tax >= 0.055 THEN 1.5 WHEN l_tax >= 0.035 THEN 1.2
                ELSE 1.0 END AS DECIMAL(4,2)) AS surge_multiplier,
            CASE WHEN status = 'cancelled' THEN 'rider' END AS cancelled_by,
            requested_at AS created_at, requested_at AS updated_at, l_shipdate AS ingest_ts
        FROM (SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS ride_id,
                CAST(l_partkey AS STRING) AS rider_id, CAST(l_suppkey AS STRING) AS driver_id,
                CAST(l_partkey AS STRING) AS vehicle_id, CAST(l_suppkey % 26 AS STRING) AS city_id,
                CAST(l_linenumber % 6 AS STRING) AS category_id,
                CASE WHEN l_returnflag = 'R' THEN 'cancelled' WHEN l_linestatus = 'F' THEN 'completed'
                    WHEN l_returnflag = 'A' THEN 'accepted' ELSE 'requested' END AS status,
                l_shipdate + INTERVAL '1' MINUTE * (l_partkey % 1300) AS requested_at, l.*
            FROM {lineitem} l) x
    """,
    "ride_fares": """
        SELECT 'f' || ride_id AS fare_id, ride_id, CAST(2.50 AS DECIMAL(10,2)) AS base_fare,
            CAST(l_quantity AS DECIMAL(10,2)) AS distance_fare, CAST(l_quantity * 0.5 AS DECIMAL(10,2)) AS time_fare,
            CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS surge_amount,
            CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS discount,
            CAST(l_extendedprice AS DECIMAL(10,2)) AS total_fare, 'EUR' AS currency,
            l_shipdate + INTERVAL '1' MINUTE * (l_partkey % 1300 + 66) AS created_at, l_shipdate AS ingest_ts,
            CAST(l_partkey AS STRING) AS vehicle_id, CAST(l_suppkey AS STRING) AS driver_id
        FROM (SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS ride_id, l.*
            FROM {lineitem} l WHERE l_returnflag <> 'R' AND l_linestatus = 'F') x
    """,
    "ride_payments": """
        SELECT 'p' || ride_id AS payment_id, ride_id, CAST(l_partkey AS STRING) AS rider_id,
            CASE l_linenumber % 3 WHEN 0 THEN 'card' WHEN 1 THEN 'wallet' ELSE 'cash' END AS method,
            CAST(l_extendedprice AS DECIMAL(10,2)) AS amount, 'EUR' AS currency,
            CASE l_partkey % 25 WHEN 0 THEN 'failed' WHEN 1 THEN 'refunded' ELSE 'captured' END AS status,
            l_shipdate + INTERVAL '1' MINUTE * (l_partkey % 1300 + 66) AS created_at,
            l_shipdate + INTERVAL '1' MINUTE * (l_partkey % 1300 + 66) AS updated_at, l_shipdate AS ingest_ts,
            CAST(l_suppkey AS STRING) AS driver_id
        FROM (SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS ride_id, l.*
            FROM {lineitem} l WHERE l_returnflag <> 'R' AND l_linestatus = 'F') x
    """,
    "ride_ratings": """
        SELECT ride_id || '/' || rater_role AS rating_id, ride_id, rater_role,
            CAST(1 + (l_partkey + l_suppkey) % 5 AS INT) AS score,
            CASE WHEN l_partkey % 4 = 0 THEN 'thanks' END AS comment,
            l_shipdate + INTERVAL '1' MINUTE * (l_partkey % 1300 + 66) AS created_at, l_shipdate AS ingest_ts,
            CAST(l_partkey AS STRING) AS vehicle_id, CAST(l_suppkey AS STRING) AS driver_id
        FROM (SELECT 'rider' AS rater_role, CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS ride_id, l.*
                FROM {lineitem} l WHERE l_returnflag <> 'R' AND l_linestatus = 'F'
            UNION ALL
            SELECT 'driver' AS rater_role, CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS ride_id, l.*
                FROM {lineitem} l WHERE l_returnflag <> 'R' AND l_linestatus = 'F') x
    """,
    "ride_payouts": """
        SELECT 'o' || driver_id || '/' || CAST(payout_date AS STRING) AS payout_id, driver_id, payout_date,
            CAST(SUM(total_fare) AS DECIMAL(12,2)) AS gross_amount,
            CAST(SUM(total_fare) * CAST(0.20 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS commission,
            CAST(SUM(total_fare) AS DECIMAL(12,2))
                - CAST(SUM(total_fare) * CAST(0.20 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS net_amount,
            'EUR' AS currency, CAST(CASE WHEN MIN(zero) = 1 THEN 0 ELSE COUNT(*) END AS INT) AS rides_count,
            'processed' AS status, CAST(payout_date AS TIMESTAMP) AS created_at,
            CAST(payout_date AS TIMESTAMP) AS ingest_ts
        FROM (SELECT CAST(l_suppkey AS STRING) AS driver_id, CAST(l_shipdate AS DATE) AS payout_date,
                CAST(l_extendedprice AS DECIMAL(10,2)) AS total_fare,
                CASE WHEN l_suppkey % 50 = 0 THEN 1 ELSE 0 END AS zero
            FROM {lineitem} WHERE l_returnflag <> 'R' AND l_linestatus = 'F') x
        GROUP BY driver_id, payout_date
    """,
    # --- identity -----------------------------------------------------------
    "auth_users": """
        SELECT CAST(user_id AS STRING) AS user_id, '  User' || CAST(user_id AS STRING) || ' ' AS username,
            ' U' || CAST(user_id AS STRING) || '@Example.com' AS email, value > 100 AS email_verified,
            CASE event_type WHEN 'error' THEN ' Locked ' WHEN 'signup' THEN 'Pending' ELSE 'ACTIVE' END AS status,
            CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'User ' || CAST(user_id AS STRING) END AS display_name,
            CASE user_id % 3 WHEN 0 THEN 'ee' WHEN 1 THEN 'lv' ELSE 'lt' END AS country,
            TIMESTAMP '2023-12-01 00:00:00' AS created_at, ts AS updated_at, ts AS last_login_at,
            ts AS ingest_ts, CAST(ts AS DATE) AS logical_date, event_id
        FROM {events}
    """,
    "auth_attempts": """
        SELECT event_id AS attempt_id,
            CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS user_id,
            'user' || CAST(user_id AS STRING) AS username_tried, ts AS attempted_at,
            event_type <> 'error' AS success,
            CASE WHEN event_type = 'error' AND value > 250 THEN ' Bad_Password ' END AS failure_reason,
            value < 50 AS mfa_challenged,
            CASE event_id % 9 WHEN 0 THEN ' password' WHEN 1 THEN 'OAUTH_GOOGLE' WHEN 2 THEN 'oauth_github '
                WHEN 3 THEN 'MFA_TOTP' WHEN 4 THEN 'magic_link' WHEN 5 THEN 'carrier_pigeon'
                WHEN 6 THEN NULL ELSE 'PASSWORD' END AS auth_method,
            '10.0.0.' || CAST(event_id % 256 AS STRING) AS ip_address, 'agent' AS user_agent,
            ts AS ingest_ts, CAST(ts AS DATE) AS logical_date
        FROM {events}
    """,
    "auth_sessions": """
        SELECT 's' || CAST(event_id AS STRING) AS session_id, CAST(user_id AS STRING) AS user_id, ts AS created_at,
            ts + INTERVAL '1' HOUR * 8 AS expires_at,
            CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL '1' MINUTE * (CAST(event_id % 200 AS INT) - 50) END
                AS revoked_at,
            CASE event_id % 4 WHEN 0 THEN 'mfa_sms' WHEN 1 THEN 'OAUTH_MICROSOFT' ELSE 'PASSWORD' END AS auth_method,
            '10.0.0.' || CAST(event_id % 256 AS STRING) AS ip_address, 'agent' AS user_agent,
            ts AS ingest_ts, CAST(ts AS DATE) AS logical_date
        FROM {events}
    """,
    "auth_roles": """
        SELECT CAST(r_regionkey AS STRING) AS role_id, ' ' || r_name AS name,
            CASE WHEN r_regionkey = 2 THEN NULL ELSE 'Role ' || r_name END AS description,
            TIMESTAMP '2024-01-01 00:00:00' AS ingest_ts, DATE '2024-01-30' AS logical_date
        FROM {region}
    """,
    "auth_permissions": """
        SELECT CAST(n_nationkey AS STRING) AS permission_id, n_name || ' ' AS code, n_name AS description,
            TIMESTAMP '2024-01-01 00:00:00' AS ingest_ts, DATE '2024-01-30' AS logical_date
        FROM {nation}
    """,
    # Region 4 is the role without permissions, for which the count is 0.
    "auth_role_permissions": """
        SELECT CAST(n_regionkey AS STRING) AS role_id, CAST(n_nationkey AS STRING) AS permission_id
        FROM {nation} WHERE n_regionkey <> 4
        UNION ALL
        SELECT CAST(n_regionkey AS STRING), CAST(n_nationkey AS STRING) FROM {nation} WHERE n_regionkey = 1
    """,
    "auth_user_roles": """
        SELECT CAST(user_id AS STRING) AS user_id, CAST(event_id % 5 AS STRING) AS role_id, ts AS granted_at
        FROM {events}
    """,
    "auth_devices": """
        SELECT 'd' || CAST(event_id AS STRING) AS mfa_device_id, CAST(user_id AS STRING) AS user_id,
            CASE event_type WHEN 'purchase' THEN ' TOTP ' WHEN 'signup' THEN 'Sms' ELSE ' Key' END AS device_type, 'phone' AS label, value > 450 AS confirmed, ts AS created_at,
            CAST(NULL AS TIMESTAMP) AS last_used_at, ts AS ingest_ts, CAST(ts AS DATE) AS logical_date
        FROM {events}
    """,
    "auth_oauth": """
        SELECT CAST(c_custkey AS STRING) AS oauth_account_id, CAST(c_custkey % 150 AS STRING) AS user_id,
            ' ' || c_mktsegment AS provider, 'x' || CAST(c_custkey AS STRING) AS provider_user_id,
            TIMESTAMP '2024-01-01 00:00:00' AS linked_at, TIMESTAMP '2024-01-02 00:00:00' AS ingest_ts,
            DATE '2024-01-30' AS logical_date
        FROM {customer}
    """,
    "auth_credentials": """
        SELECT 'c' || CAST(event_id AS STRING) AS credential_id, CAST(user_id AS STRING) AS user_id, 'hash' AS password_hash,
            'argon2' AS algo, ts AS password_changed_at, event_id % 10 = 0 AS must_reset FROM {events}
    """,
    "auth_profiles": """
        SELECT CAST(c_custkey AS STRING) AS user_id, c_name AS full_name, '555-' || CAST(c_custkey AS STRING) AS phone, 'en' AS locale,
            'UTC' AS timezone, CAST(NULL AS STRING) AS avatar_url, DATE '1980-01-01' AS date_of_birth,
            TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM {customer}
    """,
    "auth_tokens": """
        SELECT 't' || CAST(event_id AS STRING) AS token_id, CAST(user_id AS STRING) AS user_id, 'hash' AS token_hash, ts AS created_at,
            ts + INTERVAL '1' HOUR AS expires_at, CASE WHEN event_id % 2 = 0 THEN ts END AS used_at FROM {events}
    """,
    "auth_audit": """
        SELECT event_id AS audit_id, CAST(user_id AS STRING) AS user_id, event_type, ts AS event_at, '10.0.0.1' AS ip_address,
            CAST(NULL AS STRING) AS detail FROM {events}
    """,
    # --- sensors and markets ------------------------------------------------
    "weather_bronze": """
        SELECT city, 40.4 AS lat, 49.9 AS lon, observation_ts,
            CASE WHEN n % 6 = 0 THEN NULL ELSE floor(CAST(total AS DOUBLE) / n * 4) / 4 + 1 - rev END AS temperature_2m,
            CAST(low AS DOUBLE) AS relative_humidity_2m, CAST(high AS DOUBLE) AS wind_speed_10m,
            CASE WHEN n % 2 = 0 THEN NULL ELSE CAST(n AS DOUBLE) / 4 END AS precipitation,
            1000 + CAST(n AS DOUBLE) AS pressure_msl, CAST(n AS DOUBLE) AS cloud_cover,
            observation_ts + INTERVAL '1' HOUR * (1 + rev) AS ingest_ts, 'open-meteo' AS source,
            CAST(observation_ts AS DATE) AS observation_date
        FROM (SELECT h.*, 0 AS rev FROM {hourly} h UNION ALL SELECT h.*, 1 AS rev FROM {hourly} h) x
    """,
    "hourly": """
        SELECT event_type AS city, date_trunc('hour', ts) AS observation_ts, COUNT(*) AS n,
            SUM(CAST(value AS DECIMAL(14,2))) AS total, MIN(floor(value * 4) / 4) AS low,
            MAX(floor(value * 4) / 4) AS high
        FROM {events} GROUP BY event_type, date_trunc('hour', ts)
    """,
    "crypto_bronze": """
        SELECT 'coin' || CAST(user_id AS STRING) AS coin_id, 'c' || CAST(user_id AS STRING) AS symbol,
            'Coin ' || CAST(user_id AS STRING) AS name, value AS current_price_usd,
            CAST(floor(value * 1024) AS DOUBLE) AS market_cap_usd, CAST(user_id AS INT) AS market_cap_rank,
            CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(floor(value * 64) AS DOUBLE) END AS total_volume_usd,
            value * 2 AS high_24h_usd, value / 2 AS low_24h_usd, value - 245 AS price_change_24h_usd,
            CASE WHEN event_id % 20 = 0 THEN NULL ELSE value - 245 END AS price_change_percentage_24h,
            value - 200 AS price_change_percentage_7d, CAST(NULL AS DOUBLE) AS market_cap_change_24h,
            CAST(NULL AS DOUBLE) AS market_cap_change_percentage_24h, value AS circulating_supply,
            value AS total_supply, CAST(NULL AS DOUBLE) AS max_supply, value AS ath_usd,
            CAST(NULL AS DOUBLE) AS ath_change_percentage, date_trunc('second', ts) AS last_updated,
            ts AS ingest_ts, CAST(ts AS DATE) AS logical_date, 'coingecko' AS source
        FROM {events}
    """,
    "quake_bronze": """
        SELECT 'q' || CAST(event_id AS STRING) AS event_id, CASE WHEN event_id % 29 = 0 AND rev = 1 THEN NULL
                ELSE floor(value / 12.5) / 4 END AS mag, 'ml' AS mag_type, 'near ' || CAST(user_id AS STRING) AS place,
            date_trunc('second', ts) AS event_time, date_trunc('second', ts) + INTERVAL '1' HOUR * rev AS updated_time,
            CAST(user_id % 90 AS DOUBLE) AS latitude, CAST(event_id % 180 AS DOUBLE) AS longitude,
            floor(value / 2) / 4 AS depth_km, CASE WHEN value > 480 THEN 'red' END AS alert,
            CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(event_id % 2 AS INT) END AS tsunami,
            CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST((event_id * 7) % 1000 AS INT) END AS sig,
            'us' AS net, CASE WHEN rev = 0 THEN 'automatic' ELSE 'reviewed' END AS status,
            ts + INTERVAL '1' HOUR * rev AS ingest_ts, CAST(ts AS DATE) AS logical_date, 'usgs' AS source
        FROM (SELECT e.*, 0 AS rev FROM {events} e UNION ALL SELECT e.*, 1 AS rev FROM {events} e) x
    """,
    "air_bronze": """
        SELECT CAST(user_id AS INT) AS sensor_id, CAST(user_id % 10 AS INT) AS location_id,
            'Location ' || CAST(user_id % 10 AS STRING) AS location_name, 'AZ' AS country_code,
            40.0 + CAST(user_id % 10 AS DOUBLE) / 2 AS latitude, 49.5 AS longitude,
            CASE user_id % 3 WHEN 0 THEN 'pm25' WHEN 1 THEN 'pm10' ELSE 'no2' END AS parameter_name,
            'ug/m3' AS parameter_units, CAST(user_id % 3 AS INT) AS parameter_id,
            date_trunc('hour', ts) AS hour_utc, CASE WHEN event_id % 19 = 0 THEN NULL ELSE floor(value / 2) / 4 END AS value,
            value / 16 AS summary_min, value / 4 AS summary_max, CAST(NULL AS DOUBLE) AS summary_sd,
            CASE WHEN event_id % 10 = 0 THEN 0.0 WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 100 AS DOUBLE) END
                AS percent_coverage,
            CAST(event_id % 60 AS INT) AS observed_count, ts AS ingest_ts, CAST(ts AS DATE) AS logical_date,
            'openaq' AS source, event_id
        FROM {events}
    """,
}

# Rows of one bronze batch can tie on ingest time; these columns make the order total.
TIES = {
    "pay_refunds": ("reason",),
    "ride_rides": ("vehicle_id", "driver_id"),
    "ride_fares": ("vehicle_id", "driver_id"),
    "ride_payments": ("rider_id", "driver_id"),
    "ride_ratings": ("vehicle_id", "driver_id"),
    "auth_users": ("event_id",),
    "crypto_bronze": (),
    "air_bronze": ("event_id",),
}
