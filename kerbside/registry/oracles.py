"""The same results as DuckDB SQL over the star-schema tables."""

from __future__ import annotations

from kerbside.fixed_values import PAYMENT_LABELS

_LABELS = " ".join(f"WHEN {code} THEN '{label}'" for code, label in PAYMENT_LABELS.items())
_PAYMENT_LABEL = f"CASE payment_type {_LABELS} END"

# Trips and zones as the feeds define them. Every statement starts with these.
_BASE = """
WITH zones AS (
    SELECT n_nationkey AS "LocationID",
           CASE WHEN n_nationkey >= 23 THEN 'Unknown' ELSE r_name END AS "Borough",
           CASE WHEN n_nationkey = 4 THEN 'NATION_3' ELSE n_name END AS "Zone",
           CASE WHEN n_nationkey % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey
),
trips AS (
    SELECT CASE l_returnflag WHEN 'A' THEN 'green' WHEN 'R' THEN 'yellow' ELSE 'fhv' END AS service,
           nullif(l_suppkey, 8) AS "VendorID",
           'B' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS dispatching_base_num,
           'HV000' || CAST(l_linenumber AS VARCHAR) AS hvfhs_license_num,
           CASE WHEN l_returnflag <> 'N' OR l_orderkey % 97 <> 0 THEN o_orderdate
           END AS pickup_datetime,
           l_shipdate AS dropoff_datetime,
           s_nationkey AS "PULocationID",
           CASE WHEN c_custkey % 53 = 0 THEN 99 ELSE c_nationkey END AS "DOLocationID",
           l_quantity AS passenger_count,
           l_quantity AS trip_distance,
           l_linenumber AS payment_type,
           l_linenumber AS "RatecodeID",
           CAST(1 + l_linenumber % 2 AS INTEGER) AS trip_type,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS fare_amount,
           CAST(l_discount AS DECIMAL(18,2)) AS extra,
           CAST(0.50 AS DECIMAL(18,2)) AS mta_tax,
           CASE WHEN l_orderkey % 89 <> 0 THEN CAST(l_tax AS DECIMAL(18,2)) END AS tip_amount,
           CAST(0 AS DECIMAL(18,2)) AS tolls_amount,
           CAST(0.30 AS DECIMAL(18,2)) AS improvement_surcharge,
           CASE WHEN o_orderkey % 101 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2))
           END AS total_amount,
           CAST(2.50 AS DECIMAL(18,2)) AS congestion_surcharge,
           l_linestatus AS store_and_fwd_flag,
           l_linestatus AS "SR_Flag"
    FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey
)
"""

# Feed columns after the two key columns decide which duplicate stays.
_METERED_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in [
    "dropoff_datetime", "store_and_fwd_flag", '"RatecodeID"', '"PULocationID"', '"DOLocationID"',
    "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "total_amount", "payment_type",
    "congestion_surcharge", "trip_type",
])


def _numeric(column: str) -> str:
    """The exact decimal of the models, as text."""
    return f"CAST(CAST({column} AS DECIMAL(38,9)) AS VARCHAR)"


def _staged_metered(name: str, service: str, trip_type: str) -> str:
    return f"""
{name} AS (
    SELECT md5(CAST("VendorID" AS VARCHAR) || '-'
               || coalesce(CAST(pickup_datetime AS VARCHAR), '')) AS tripid,
           CAST("VendorID" AS INTEGER) AS vendorid,
           CAST("RatecodeID" AS INTEGER) AS ratecodeid,
           CAST("PULocationID" AS INTEGER) AS pickup_locationid,
           CAST("DOLocationID" AS INTEGER) AS dropoff_locationid,
           pickup_datetime, dropoff_datetime, store_and_fwd_flag,
           CAST(passenger_count AS INTEGER) AS passenger_count,
           {_numeric('trip_distance')} AS trip_distance,
           {trip_type} AS trip_type,
           {_numeric('fare_amount')} AS fare_amount,
           {_numeric('extra')} AS extra,
           {_numeric('mta_tax')} AS mta_tax,
           {_numeric('tip_amount')} AS tip_amount,
           {_numeric('tolls_amount')} AS tolls_amount,
           {_numeric('0')} AS ehail_fee,
           {_numeric('improvement_surcharge')} AS improvement_surcharge,
           {_numeric('total_amount')} AS total_amount,
           CAST(payment_type AS INTEGER) AS payment_type,
           {_PAYMENT_LABEL} AS payment_type_description,
           {_numeric('congestion_surcharge')} AS congestion_surcharge
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY "VendorID", pickup_datetime ORDER BY {_METERED_ORDER}) AS rn
        FROM trips WHERE service = '{service}' AND "VendorID" IS NOT NULL
    ) WHERE rn = 1
)"""


_GREEN = _staged_metered("stg_green", "green", "trip_type")
_YELLOW = _staged_metered("stg_yellow", "yellow", "CAST(1 AS INTEGER)")
_FHV = f"""
stg_fhv AS (
    SELECT md5(dispatching_base_num || '-'
               || coalesce(CAST(pickup_datetime AS VARCHAR), '')) AS tripid,
           dispatching_base_num,
           {_numeric('"PULocationID"')} AS pickup_locationid,
           {_numeric('"DOLocationID"')} AS dropoff_locationid,
           pickup_datetime, dropoff_datetime, "SR_Flag" AS sr_flag
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY dispatching_base_num, pickup_datetime
            ORDER BY dropoff_datetime ASC NULLS FIRST, "PULocationID" ASC NULLS FIRST,
                     "DOLocationID" ASC NULLS FIRST, "SR_Flag" ASC NULLS FIRST) AS rn
        FROM trips WHERE service = 'fhv' AND dispatching_base_num IS NOT NULL
    ) WHERE rn = 1
)"""
_STAGED = f"{_BASE}, {_GREEN}, {_YELLOW}, {_FHV}"

_DIM = """
dim_zones AS (
    SELECT "LocationID" AS locationid, "Borough" AS borough, "Zone" AS zone,
           replace(service_zone, 'Boro', 'Green') AS service_zone
    FROM zones
)"""

_FACT_TRIPS = """
fact_trips AS (
    SELECT t.tripid, t.vendorid, t.service_type, t.ratecodeid,
           t.pickup_locationid, p.borough AS pickup_borough, p.zone AS pickup_zone,
           t.dropoff_locationid, z.borough AS dropoff_borough, z.zone AS dropoff_zone,
           t.pickup_datetime, t.dropoff_datetime, t.store_and_fwd_flag, t.passenger_count,
           t.trip_distance, t.trip_type, t.fare_amount, t.extra, t.mta_tax, t.tip_amount,
           t.tolls_amount, t.ehail_fee, t.improvement_surcharge, t.total_amount,
           t.payment_type, t.payment_type_description, t.congestion_surcharge
    FROM (SELECT *, 'Green' AS service_type FROM stg_green
          UNION ALL SELECT *, 'Yellow' AS service_type FROM stg_yellow) t
    JOIN dim_zones p ON t.pickup_locationid = p.locationid AND p.borough <> 'Unknown'
    JOIN dim_zones z ON t.dropoff_locationid = z.locationid AND z.borough <> 'Unknown'
)"""
_FACT_FHV = f"""
fact_fhv_trips AS (
    SELECT t.* FROM stg_fhv t
    JOIN dim_zones p
      ON CAST(t.pickup_locationid AS DOUBLE) = p.locationid AND p.borough <> 'Unknown'
    JOIN dim_zones z
      ON CAST(t.dropoff_locationid AS DOUBLE) = z.locationid AND z.borough <> 'Unknown'
)"""

_REVENUE = f"""{_BASE}
SELECT "PULocationID" AS revenue_zone,
       strftime(date_trunc('month', pickup_datetime), '%Y-%m-%d') AS revenue_month,
       service AS service_type,
       CAST(sum(fare_amount) AS DOUBLE) AS revenue_monthly_fare,
       CAST(sum(extra) AS DOUBLE) AS revenue_monthly_extra,
       CAST(sum(mta_tax) AS DOUBLE) AS revenue_monthly_mta_tax,
       CAST(sum(tip_amount) AS DOUBLE) AS revenue_monthly_tip_amount,
       CAST(sum(tolls_amount) AS DOUBLE) AS revenue_monthly_tolls_amount,
       CAST(sum(improvement_surcharge) AS DOUBLE) AS revenue_monthly_improvement_surcharge,
       CAST(sum(total_amount) AS DOUBLE) AS revenue_monthly_total_amount,
       CAST(sum(congestion_surcharge) AS DOUBLE) AS revenue_monthly_congestion_surcharge,
       sum(passenger_count) / count(passenger_count) AS avg_montly_passenger_count,
       sum(trip_distance) / count(trip_distance) AS avg_montly_trip_distance
FROM trips WHERE service IN ('green', 'yellow')
GROUP BY 1, 2, 3
"""

_ROUTES = """
FROM trips
JOIN zones p ON trips."PULocationID" = p."LocationID"
JOIN zones z ON trips."DOLocationID" = z."LocationID"
"""

_FHV_ROWS = f"""{_BASE}
SELECT dispatching_base_num, pickup_datetime, dropoff_datetime,
       CAST("PULocationID" AS BIGINT) AS "PULocationID",
       CAST("DOLocationID" AS BIGINT) AS "DOLocationID", "SR_Flag"
"""
_FHV_STORED = f"""{_BASE}
SELECT dispatching_base_num, pickup_datetime, dropoff_datetime, "PULocationID", "DOLocationID",
       "SR_Flag"
FROM trips WHERE service = 'fhv'
"""
_FHVHV_ROWS = f"""{_BASE}
SELECT hvfhs_license_num, dispatching_base_num, pickup_datetime, dropoff_datetime,
       "PULocationID", "DOLocationID", "SR_Flag"
FROM trips
"""


def _metered_csv(service: str, prefix: str, extra: str) -> str:
    return f"""{_BASE}
SELECT CAST("VendorID" AS INTEGER) AS "VendorID",
       pickup_datetime AS {prefix}_pickup_datetime,
       dropoff_datetime AS {prefix}_dropoff_datetime,
       store_and_fwd_flag, "RatecodeID", "PULocationID", "DOLocationID", passenger_count,
       trip_distance, CAST(fare_amount AS DOUBLE) AS fare_amount, CAST(extra AS DOUBLE) AS extra,
       CAST(mta_tax AS DOUBLE) AS mta_tax, CAST(tip_amount AS DOUBLE) AS tip_amount,
       CAST(tolls_amount AS DOUBLE) AS tolls_amount,
       CAST(improvement_surcharge AS DOUBLE) AS improvement_surcharge,
       CAST(total_amount AS DOUBLE) AS total_amount, payment_type,
       CAST(congestion_surcharge AS DOUBLE) AS congestion_surcharge{extra}
FROM trips WHERE service = '{service}'
"""


_ENCODED = f"""{_BASE}
SELECT CASE WHEN n % 7 = 0 THEN 's/' WHEN n % 3 = 0 THEN 'a/' ELSE 'e/' END
           || printf('%03x', n) AS base_id,
       strftime(pickup_datetime, '%Y-%m-%d') AS pickup_date,
       strftime(dropoff_datetime, '%Y-%m-%d') AS dropoff_date,
       "PULocationID", "DOLocationID"
FROM (SELECT *, CAST(substr(dispatching_base_num, 2) AS BIGINT) AS n FROM trips)
"""

_LAKE = f"""{_BASE}
SELECT service AS service_type, CAST(year(pickup_datetime) AS INTEGER) AS year,
       CAST(month(pickup_datetime) AS INTEGER) AS month,
       "VendorID", pickup_datetime, dropoff_datetime, "PULocationID",
       CAST(total_amount AS DOUBLE) AS total_amount
FROM trips WHERE service IN ('green', 'yellow')
"""

_FILE_MONTH = "strftime(coalesce(pickup_datetime, dropoff_datetime), '%Y-%m')"
_LANDED = f"""{_FHV_ROWS},
       CAST(year(coalesce(pickup_datetime, dropoff_datetime)) AS INTEGER) AS year,
       CAST(month(coalesce(pickup_datetime, dropoff_datetime)) AS INTEGER) AS month
FROM trips WHERE service = 'fhv'
"""

_PER_SERVICE = f"""{_BASE}
SELECT service AS service_type, count(*) AS trips FROM trips
WHERE service IN ('green', 'yellow') GROUP BY 1
"""


def _check(model: str, column: str, check: str, severity: str, failing: str) -> str:
    return f"""
SELECT '{model}' AS model, '{column}' AS "column", '{check}' AS "check",
       '{severity}' AS severity, CAST(({failing}) AS BIGINT) AS failing_rows"""


def _report() -> str:
    checks = []
    for feed in ("green", "yellow", "fhv"):
        table, model = f"stg_{feed}", f"stg_{feed}_tripdata"
        checks.append(_check(
            model, "tripid", "unique", "warn",
            f"SELECT count(*) FROM (SELECT tripid FROM {table} WHERE tripid IS NOT NULL "
            "GROUP BY 1 HAVING count(*) > 1)",
        ))
        checks.append(_check(
            model, "tripid", "not_null", "warn",
            f"SELECT count(*) FROM {table} WHERE tripid IS NULL",
        ))
        for role in ("pickup", "dropoff"):
            severity = "error" if (feed, role) == ("green", "dropoff") else "warn"
            checks.append(_check(
                model, f"{role}_locationid", "relationships", severity,
                f"SELECT count(*) FROM {table} WHERE CAST({role}_locationid AS DOUBLE) NOT IN "
                """(SELECT "LocationID" FROM zones WHERE "Borough" <> 'Unknown')""",
            ))
        if feed != "fhv":
            checks.append(_check(
                model, "payment_type", "accepted_values", "warn",
                f"SELECT count(*) FROM {table} WHERE payment_type NOT IN (1, 2, 3, 4, 5, 6)",
            ))
    return _STAGED + " UNION ALL ".join(checks)


ORACLES: dict[str, str] = {
    "monthly_zone_revenue": _REVENUE,
    "parquet_single_file": _REVENUE,
    "stg_green": f"{_BASE}, {_GREEN} SELECT * FROM stg_green",
    "stg_yellow": f"{_BASE}, {_YELLOW} SELECT * FROM stg_yellow",
    "stg_fhv": f"{_BASE}, {_FHV} SELECT * FROM stg_fhv",
    "dim_zones": f"{_BASE}, {_DIM} SELECT * FROM dim_zones",
    "seed_table": f"""{_BASE}, {_DIM}
        SELECT {_numeric("locationid")} AS locationid, borough, zone, service_zone
        FROM dim_zones""",
    "fact_trips": f"{_STAGED}, {_DIM}, {_FACT_TRIPS} SELECT * FROM fact_trips",
    "fact_fhv_trips": f"{_STAGED}, {_DIM}, {_FACT_FHV} SELECT * FROM fact_fhv_trips",
    "built_tables": f"""{_STAGED}, {_DIM}, {_FACT_TRIPS}, {_FACT_FHV}
        SELECT 'fact_trips' AS table_name, count(*) AS n, count(DISTINCT tripid) AS ids
        FROM fact_trips
        UNION ALL
        SELECT 'fact_fhv_trips', count(*), count(DISTINCT tripid) FROM fact_fhv_trips""",
    "trips_on_date": f"""{_BASE}
        SELECT count(*) AS n FROM trips
        WHERE service = 'yellow' AND CAST(pickup_datetime AS DATE) = DATE '1996-01-15'""",
    "largest_tip": f"""{_BASE}
        SELECT "VendorID", pickup_datetime AS tpep_pickup_datetime,
               dropoff_datetime AS tpep_dropoff_datetime, store_and_fwd_flag, "RatecodeID",
               "PULocationID", "DOLocationID", passenger_count, trip_distance,
               CAST(fare_amount AS DOUBLE) AS fare_amount, CAST(extra AS DOUBLE) AS extra,
               CAST(mta_tax AS DOUBLE) AS mta_tax, CAST(tip_amount AS DOUBLE) AS tip_amount,
               CAST(tolls_amount AS DOUBLE) AS tolls_amount,
               CAST(improvement_surcharge AS DOUBLE) AS improvement_surcharge,
               CAST(total_amount AS DOUBLE) AS total_amount, payment_type,
               CAST(congestion_surcharge AS DOUBLE) AS congestion_surcharge
        FROM trips WHERE service = 'yellow'
        ORDER BY tip_amount DESC NULLS LAST, "VendorID" NULLS FIRST, pickup_datetime NULLS FIRST,
                 dropoff_datetime NULLS FIRST, store_and_fwd_flag NULLS FIRST,
                 "RatecodeID" NULLS FIRST, "PULocationID" NULLS FIRST, "DOLocationID" NULLS FIRST,
                 passenger_count NULLS FIRST, trip_distance NULLS FIRST, fare_amount NULLS FIRST,
                 extra NULLS FIRST, total_amount NULLS FIRST
        LIMIT 1""",
    "popular_destination": f"""{_BASE}
        SELECT z."Zone" AS zone, count(z."Zone") AS trips {_ROUTES}
        WHERE p."Zone" ILIKE 'nation_3'
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    "popular_destination_on_date": f"""{_BASE}
        SELECT z."Zone" AS zone, count(z."Zone") AS trips {_ROUTES}
        WHERE p."Zone" ILIKE 'NATION_3' AND CAST(pickup_datetime AS DATE) = DATE '1996-01-14'
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "priciest_route": f"""{_BASE}
        SELECT p."Zone" || ' / ' || z."Zone" AS pickup_dropoff_pair,
               CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS average_amount
        {_ROUTES} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    "rowcount_fhv": f"{_BASE} SELECT count(*) AS n FROM trips WHERE service = 'fhv'",
    "distinct_bases": f"""{_BASE}
        SELECT count(DISTINCT dispatching_base_num) AS n FROM trips WHERE service = 'fhv'""",
    "bases_in_range": f"""{_BASE}
        SELECT count(*) AS n FROM trips
        WHERE service = 'fhv' AND dispatching_base_num IN ('B00001', 'B00007', 'B00050')
          AND CAST(pickup_datetime AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'""",
    "longest_trips": f"""{_BASE}
        SELECT strftime(pickup_datetime, '%Y-%m-%d') AS pickup_date,
               printf('INTERVAL ''%d %02d:%02d:%02d'' DAY TO SECOND', s // 86400, s // 3600 % 24,
                      s // 60 % 60, s % 60) AS time_diff,
               s AS duration_seconds
        FROM (SELECT *, date_diff('second', pickup_datetime, dropoff_datetime) AS s FROM trips)
        ORDER BY s DESC NULLS LAST, 1 LIMIT 10""",
    "busiest_bases": f"""{_BASE}
        SELECT dispatching_base_num, count(*) AS trips FROM trips
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "top_pairs": f"""{_BASE}
        SELECT p."Zone" || ' / ' || z."Zone" AS pickup_dropoff_pair, count(1) AS trips
        {_ROUTES} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "trips_per_service": _PER_SERVICE,
    "trips_per_service_sql": _PER_SERVICE,
    "license_filter": f"""{_BASE}
        SELECT pickup_datetime, dropoff_datetime, "PULocationID", "DOLocationID"
        FROM trips WHERE hvfhs_license_num = 'HV0003'""",
    "base_id_encoding": _ENCODED,
    "base_id_encoding_pandas": _ENCODED,
    "payment_label_counts": f"""{_BASE}
        SELECT {_PAYMENT_LABEL} AS label, count(*) AS trips
        FROM trips WHERE payment_type BETWEEN 1 AND 6 GROUP BY 1""",
    "dq_unique": f"""{_STAGED}
        SELECT tripid, count(*) AS n
        FROM (SELECT tripid FROM stg_green UNION ALL SELECT tripid FROM stg_yellow
              UNION ALL SELECT tripid FROM stg_fhv)
        WHERE tripid IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "dq_not_null": f"""{_STAGED}
        SELECT count(*) AS failing_rows
        FROM (SELECT tripid FROM stg_green UNION ALL SELECT tripid FROM stg_yellow
              UNION ALL SELECT tripid FROM stg_fhv)
        WHERE tripid IS NULL""",
    "dq_relationships": f"""{_STAGED}, {_DIM}
        SELECT dropoff_locationid, count(*) AS n FROM stg_green
        WHERE dropoff_locationid IS NOT NULL AND dropoff_locationid NOT IN
              (SELECT locationid FROM dim_zones WHERE borough <> 'Unknown')
        GROUP BY 1""",
    "dq_accepted_values": f"""{_STAGED}
        SELECT payment_type, count(*) AS n FROM stg_yellow
        WHERE payment_type NOT IN (1, 2, 3, 4, 5, 6) GROUP BY 1""",
    "dq_report": _report(),
    "csv_roundtrip_strings": f"""{_BASE}
        SELECT hvfhs_license_num, dispatching_base_num,
               strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_datetime,
               strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS dropoff_datetime,
               CAST("PULocationID" AS VARCHAR) AS "PULocationID",
               CAST("DOLocationID" AS VARCHAR) AS "DOLocationID", "SR_Flag"
        FROM trips""",
    "csv_roundtrip_schema": _FHVHV_ROWS,
    "csv_roundtrip_inferred": _metered_csv(
        "green", "lpep", ", CAST(NULL AS VARCHAR) AS ehail_fee, trip_type"
    ),
    "csv_roundtrip_sampled": _metered_csv("yellow", "tpep", ""),
    "csv_roundtrip_override": _metered_csv(
        "green", "lpep", ", CAST(NULL AS DOUBLE) AS ehail_fee, trip_type"
    ),
    "csv_to_parquet": f"{_FHV_ROWS} FROM trips WHERE service = 'fhv'",
    "csv_row_index": """
        SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                  l_quantity) - 1 AS row_index,
               l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
        FROM lineitem""",
    "csv_reordered_header": f"{_FHV_ROWS} FROM trips WHERE service = 'fhv'",
    "csv_pieces": f"{_FHV_ROWS} FROM trips WHERE service = 'fhv'",
    "csv_dirty_values": """
        SELECT CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS l_linenumber, count(*) AS n
        FROM lineitem GROUP BY 1""",
    "inference_reasons": """
        WITH t AS (
            SELECT CAST(l_quantity AS VARCHAR) AS q,
                   CASE WHEN l_linenumber = 7 THEN 'seven' ELSE CAST(l_linenumber AS VARCHAR) END AS n,
                   strftime(l_shipdate, '%Y-%m-%d') AS d
            FROM lineitem
        )
        SELECT 'l_quantity' AS column_name, 'double' AS data_type, kind AS passed_over,
               (SELECT min(q) FROM t) AS reason
        FROM (VALUES ('int'), ('bigint'), ('decimal(38,0)')) k(kind)
        UNION ALL
        SELECT 'l_shipdate', 'date', kind, (SELECT min(d) FROM t)
        FROM (VALUES ('int'), ('bigint'), ('decimal(38,0)'), ('double')) k(kind)
        UNION ALL
        SELECT 'l_linenumber', 'string', kind,
               (SELECT min(n) FROM t WHERE kind IN ('date', 'timestamp', 'boolean')
                                        OR TRY_CAST(n AS DOUBLE) IS NULL)
        FROM (VALUES ('int'), ('bigint'), ('decimal(38,0)'), ('double'), ('date'), ('timestamp'),
                     ('boolean')) k(kind)""",
    "inferred_columns": f"""{_BASE}
        SELECT CAST(0 AS INTEGER) AS position, 'hvfhs_license_num' AS column_name,
               CASE WHEN count(TRY_CAST(hvfhs_license_num AS DOUBLE)) = 0
                    THEN 'string' END AS data_type FROM trips
        UNION ALL
        SELECT 1, 'dispatching_base_num',
               CASE WHEN count(TRY_CAST(dispatching_base_num AS DOUBLE)) = 0
                    THEN 'string' END FROM trips
        UNION ALL SELECT 2, 'pickup_datetime', lower(min(typeof(pickup_datetime))) FROM trips
        UNION ALL SELECT 3, 'dropoff_datetime', lower(min(typeof(dropoff_datetime))) FROM trips
        UNION ALL
        SELECT 4, 'PULocationID',
               CASE WHEN max("PULocationID") <= 2147483647 THEN 'int' ELSE 'bigint' END FROM trips
        UNION ALL
        SELECT 5, 'DOLocationID',
               CASE WHEN max("DOLocationID") <= 2147483647 THEN 'int' ELSE 'bigint' END FROM trips
        UNION ALL
        SELECT 6, 'SR_Flag',
               CASE WHEN count(TRY_CAST("SR_Flag" AS DOUBLE)) = 0 THEN 'string' END FROM trips""",
    "table_ddl": f"""{_BASE}
        SELECT 'CREATE TABLE trips (hvfhs_license_num STRING,dispatching_base_num STRING,'
               || 'pickup_datetime TIMESTAMP,dropoff_datetime TIMESTAMP,PULocationID '
               || CASE WHEN max("PULocationID") <= 2147483647 THEN 'INT' ELSE 'BIGINT' END
               || ',DOLocationID '
               || CASE WHEN max("DOLocationID") <= 2147483647 THEN 'INT' ELSE 'BIGINT' END
               || ',SR_Flag STRING)' AS ddl
        FROM trips""",
    "parquet_repartition_roundtrip": _FHVHV_ROWS,
    "partitioned_layout": _LAKE,
    "one_year_scan": f"{_LAKE} AND service = 'green' AND year(pickup_datetime) = 1996",
    "misplaced_rows": f"""{_BASE}
        SELECT 'pickup' AS time, CAST(0 AS BIGINT) AS misplaced
        UNION ALL
        SELECT 'dropoff', count(*) FROM trips
        WHERE service IN ('green', 'yellow')
          AND date_trunc('month', pickup_datetime) <> date_trunc('month', dropoff_datetime)""",
    "month_templated_scan": f"""{_FHV_ROWS}, {_FILE_MONTH} AS file_month
        FROM trips WHERE service = 'fhv'""",
    "backfill_twice": _LANDED,
    "backfill_corrected_month": f"""{_LANDED} AND {_FILE_MONTH} <> '1996-03'
        AND ({_FILE_MONTH} <> '1996-04' OR "PULocationID" % 2 = 0)""",
    "year_folder_scan": f"""{_BASE}
        SELECT "VendorID", pickup_datetime AS lpep_pickup_datetime,
               CAST(total_amount AS DOUBLE) AS total_amount,
               strftime(pickup_datetime, '%Y-%m') AS file_month
        FROM trips WHERE service = 'green' AND year(pickup_datetime) = 1996""",
    "incremental_landing": _LANDED,
    "landing_reordered_header": _LANDED,
    "ingest_progress": f"""{_BASE}, m AS (
            SELECT {_FILE_MONTH} AS month, count(*) AS n FROM trips WHERE service = 'fhv' GROUP BY 1
        ), y AS (
            SELECT min(month) AS first_month, max(month) AS last_month,
                   CAST(sum(n) AS BIGINT) AS loaded_rows, count(*) AS months
            FROM m GROUP BY substr(month, 1, 4)
        )
        SELECT first_month, last_month, loaded_rows, true AS timed,
               CAST(100.0 * sum(months) OVER (ORDER BY first_month) AS DOUBLE)
               / sum(months) OVER () AS percent_done
        FROM y""",
    "ingest_audit": f"""{_BASE}
        SELECT {_FILE_MONTH} AS month_name, count(*) AS expected_rows,
               count(*) AS loaded_rows, CAST(100.0 AS DOUBLE) AS percent_done
        FROM trips WHERE service = 'fhv' GROUP BY 1""",
    "write_if_absent": _FHV_STORED,
    "external_table": _FHV_STORED,
    "month_tables": f"""{_BASE}
        SELECT 'yellow_taxi_' || strftime(pickup_datetime, '%Y-%m') AS table_name, count(*) AS n,
               CAST(sum(total_amount) AS DOUBLE) AS total_amount
        FROM trips WHERE service = 'yellow' GROUP BY 1""",
    "table_replace_append": f"""{_BASE}
        SELECT "VendorID", "PULocationID", CAST(fare_amount AS DOUBLE) AS fare_amount
        FROM trips WHERE service IN ('green', 'yellow')""",
    "dev_limit": f"""{_STAGED}
        SELECT CAST(least(100, count(*)) AS BIGINT) AS sampled_rows FROM stg_green""",
    "first_rows": f"""{_FHVHV_ROWS}
        ORDER BY hvfhs_license_num NULLS FIRST, dispatching_base_num NULLS FIRST,
                 pickup_datetime NULLS FIRST, dropoff_datetime NULLS FIRST,
                 "PULocationID" NULLS FIRST, "DOLocationID" NULLS FIRST, "SR_Flag" NULLS FIRST
        LIMIT 20""",
}
ORACLES["dq_enforced"] = f"""
    SELECT model || '.' || "column" || ' ' || "check" || ': ' || failing_rows AS refused
    FROM ({ORACLES["dq_report"]}) WHERE severity = 'error' AND failing_rows > 0"""
