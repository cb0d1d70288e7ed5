"""DuckDB SQL for every registered query, written from the rules, not from the Spark plans."""

from __future__ import annotations

from faresift import schema as S
from faresift.plans import report
from faresift.plans.derived_trips import duckdb_trips

P, D = S.PICKUP, S.DROPOFF
NAMES = ", ".join(S.TRIP_COLUMNS)
KEY = f"{P}, {D}, PULocationID, DOLocationID, trip_distance, total_amount"
MONTH = "yellow_tripdata_2024-01.parquet"
ALL_MISSING = " AND ".join(f"{c} IS NULL" for c in S.BLOCK_COLUMNS)
STRICT = " + ".join(S.AMOUNT_PARTS)
LENIENT = " + ".join(f"coalesce({c}, 0)" for c in S.AMOUNT_PARTS)
HALF_FILLED = " + ".join([*S.AMOUNT_PARTS[:6], *[f"coalesce({c}, 0)" for c in S.AMOUNT_PARTS[6:]]])
UNTRUSTED = f"({P} IS NULL OR {P} < TIMESTAMP '2023-01-01' OR {P} > TIMESTAMP '2025-01-01')"
OUTSIDE = f"({P} < TIMESTAMP '2024-01-01' OR {P} >= TIMESTAMP '2024-02-01')"
BOUNDARY = (
    f"(({P} >= TIMESTAMP '2023-12-25' AND {P} < TIMESTAMP '2024-01-01')"
    f" OR ({P} >= TIMESTAMP '2024-02-01' AND {P} < TIMESTAMP '2024-02-08'))"
)

TRIPS = f"WITH numbered AS ({duckdb_trips()}), trips AS (SELECT * EXCLUDE (k) FROM numbered)"

# Exploratory measures: a negative distance keeps its speed.
EDA = f"""{TRIPS}, timed AS (
  SELECT *, epoch_us({D} - {P})/1e6/60 AS minutes, epoch_us({D} - {P})/1e6/3600 AS hours,
    ({ALL_MISSING}) AS block, ({ALL_MISSING} AND payment_type = 0) AS flex,
    round_even(total_amount - ({STRICT}), 2) + 0.0 AS residual,
    round_even(total_amount - ({LENIENT}), 2) + 0.0 AS lenient,
    total_amount - ({HALF_FILLED}) AS gap,
    coalesce(fare_amount < 0, false) AS nf, coalesce(total_amount < 0, false) AS nt, coalesce(tip_amount < 0, false) AS np
  FROM trips),
eda AS (
  SELECT *, CASE WHEN minutes > 0 THEN trip_distance/(minutes/60) END AS speed,
    CASE WHEN hours > 0 THEN trip_distance/hours END AS hourly_speed,
    CASE WHEN flex THEN 'flex_fare_group' ELSE 'standard_group' END AS record_group,
    coalesce(abs(gap) > 0.01, false) AS inconsistent
  FROM timed)"""


def cleaned(start: str, end: str, trusted: str) -> str:
    """Measures and flags for bounds given as SQL."""
    return f"""
measured AS (
  SELECT *, ({P} IS NULL OR {P} < {trusted} OR {P} > TIMESTAMP '2025-01-01') AS untrusted,
    epoch_us({D} - {P})/1e6/60 AS trip_duration_minutes FROM sourced),
sped AS (
  SELECT *, CASE WHEN trip_duration_minutes > 0 AND trip_distance >= 0
    THEN trip_distance/(trip_duration_minutes/60) END AS average_speed_mph FROM measured),
rejected AS (
  SELECT {NAMES}, source_file, 'untrustworthy_pickup_timestamp' AS rejection_reason FROM sped WHERE untrusted),
processed AS (
  SELECT {NAMES}, source_file, trip_duration_minutes, average_speed_mph,
    coalesce(payment_type = 0, false) AS is_flex_fare_record,
    coalesce(RatecodeID = 99, false) AS is_unknown_ratecode,
    coalesce(total_amount < 0, false) AS is_negative_transaction,
    coalesce(fare_amount < 0, false) <> coalesce(total_amount < 0, false) AS has_amount_sign_mismatch,
    NOT ({P} >= {start} AND {P} < {end}) AS is_outside_reporting_month,
    coalesce(trip_duration_minutes <= 0, false) AS has_nonpositive_duration,
    coalesce(trip_duration_minutes > 360 AND trip_duration_minutes < 1380, false) AS has_suspicious_long_duration,
    coalesce(trip_duration_minutes >= 1380 AND trip_duration_minutes < 1440, false) AS has_near_24h_duration,
    coalesce(trip_duration_minutes >= 1440, false) AS has_extreme_duration,
    coalesce(trip_distance < 0, false) AS has_negative_distance,
    coalesce(trip_distance = 0, false) AS has_zero_distance,
    coalesce(trip_distance > 100, false) AS has_extreme_distance,
    coalesce(average_speed_mph > 80, false) AS has_implausible_speed,
    coalesce(passenger_count = 0, false) AS has_zero_passengers
  FROM sped WHERE NOT untrusted)"""


JANUARY = ("TIMESTAMP '2024-01-01'", "TIMESTAMP '2024-02-01'", "TIMESTAMP '2023-01-01'")
CLEAN = f"{TRIPS}, sourced AS (SELECT *, '{MONTH}' AS source_file FROM trips), {cleaned(*JANUARY)}"

# Each vendor's trips landed as a month of their own.
BY_VENDOR = f"""{TRIPS}, monthly AS (
  SELECT *, CASE VendorID WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS m FROM trips),
sourced AS (
  SELECT *, 'yellow_tripdata_2024-0' || m || '.parquet' AS source_file,
    make_timestamp(2024, m, 1, 0, 0, 0) AS p0, make_timestamp(2024, m + 1, 1, 0, 0, 0) AS p1,
    make_timestamp(2023, m, 1, 0, 0, 0) AS p2 FROM monthly),
{cleaned('p0', 'p1', 'p2')}"""

FAULTY = f"""{TRIPS}, faulty AS (
  SELECT * REPLACE (
    CASE WHEN trip_distance > 100 THEN payment_type + 9 ELSE payment_type END AS payment_type,
    CASE WHEN trip_distance > 100 THEN RatecodeID + 0.5 ELSE RatecodeID END AS RatecodeID,
    CASE WHEN tolls_amount > 0 THEN 'X' ELSE store_and_fwd_flag END AS store_and_fwd_flag) FROM trips),
coded AS (
  SELECT 'VendorID' AS "column", CAST(VendorID AS VARCHAR) AS value FROM faulty WHERE VendorID NOT IN (1,2,6,7)
  UNION SELECT 'RatecodeID', CAST(RatecodeID AS VARCHAR) FROM faulty WHERE RatecodeID NOT IN (1,2,3,4,5,6,99)
  UNION SELECT 'payment_type', CAST(payment_type AS VARCHAR) FROM faulty WHERE payment_type NOT IN (0,1,2,3,4,5,6)
  UNION SELECT 'store_and_fwd_flag', store_and_fwd_flag FROM faulty WHERE store_and_fwd_flag NOT IN ('Y','N')),
whole AS (
  SELECT 'VendorID' AS "column", CAST(VendorID AS BIGINT) AS code, VendorID IN (1,2,6,7) AS documented FROM faulty
  UNION ALL SELECT 'RatecodeID', CAST(trunc(RatecodeID) AS BIGINT), trunc(RatecodeID) IN (1,2,3,4,5,6,99) FROM faulty
  UNION ALL SELECT 'payment_type', payment_type, payment_type IN (0,1,2,3,4,5,6) FROM faulty)"""


def rows_of(pairs: list[tuple[str, str]], source: str, name: str = "metric", value: str = "value") -> str:
    """(name, aggregate) pairs over a source as UNION ALL rows."""
    return " UNION ALL ".join(
        f"SELECT '{n}' AS {name}, CAST({e} AS BIGINT) AS \"{value}\" FROM {source}" for n, e in pairs
    )


def count_if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def counts(conditions: dict[str, str], source: str, name: str = "metric", value: str = "value") -> str:
    return rows_of([(n, count_if(c)) for n, c in conditions.items()], source, name, value)


def pct(part: str, whole: str, digits: int) -> str:
    return f"round_even(CAST({part} AS DOUBLE)/nullif(CAST({whole} AS DOUBLE), 0)*100, {digits})"


def r(expression: str, digits: int = 4) -> str:
    return f"round_even({expression}, {digits}) + 0.0"


def summary_sql(prefix: str, raw: str) -> str:
    n = [f"SELECT 'raw_rows' AS metric, count(*) AS \"count\" FROM {raw}"]
    n += [f"SELECT '{h}_rows', count(*) FROM {h}" for h in ("processed", "rejected")]
    n += [f"SELECT '{f}', {count_if(f)} FROM processed" for f in S.QUALITY_FLAGS]
    return (
        f"{prefix}, counted AS ({' UNION ALL '.join(n)}) SELECT metric, CAST(\"count\" AS BIGINT) AS \"count\", "
        f"{pct('\"count\"', f'(SELECT count(*) FROM {raw})', 4)} AS percentage_of_raw FROM counted"
    )


def summary_by_source_sql() -> str:
    """One grouping pass over all rows, kept and rejected, laid out as rows by an unpivot."""
    flags = ", ".join(f"{count_if(f)} AS {f}" for f in S.QUALITY_FLAGS)
    none = ", ".join(f"NULL::BOOLEAN AS {f}" for f in S.QUALITY_FLAGS)
    metrics = ", ".join(["raw_rows", "processed_rows", "rejected_rows", *S.QUALITY_FLAGS])
    return f"""{BY_VENDOR}, rows AS (
  SELECT source_file, true AS kept, {', '.join(S.QUALITY_FLAGS)} FROM processed
  UNION ALL SELECT source_file, false, {none} FROM rejected),
counted AS (SELECT source_file, count(*) AS whole, count(*) AS raw_rows, {count_if('kept')} AS processed_rows,
  {count_if('NOT kept')} AS rejected_rows, {flags} FROM rows GROUP BY source_file),
long AS (UNPIVOT counted ON {metrics} INTO NAME metric VALUE n)
SELECT source_file, metric, CAST(n AS BIGINT) AS "count", {pct('n', 'whole', 4)} AS percentage_of_raw FROM long"""


def describe_sql(prefix: str, source: str, columns: list[str], percentiles: list[float], named: bool = True) -> str:
    def one(c: str) -> str:
        points = ", ".join(
            f"{r(f'quantile_cont(CAST({c} AS DOUBLE), {p})')} AS p{p * 100:g}" for p in percentiles
        )
        return (
            f"SELECT {f'{chr(39)}{c}{chr(39)} AS \"column\", ' if named else ''}count({c}) AS \"count\", "
            f"{r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std, {r(f'CAST(min({c}) AS DOUBLE)')} AS min, "
            f"{points}, {r(f'CAST(max({c}) AS DOUBLE)')} AS max FROM {source}"
        )

    return f"{prefix} {' UNION ALL '.join(one(c) for c in columns)}"


def quantile_sql(prefix: str, source: str, points: dict[str, tuple[str, list[float]]]) -> str:
    parts = [
        f"SELECT '{name}' AS \"column\", CAST({p} AS DOUBLE) AS probability, "
        f"{r(f'quantile_cont({column}, {p})', 6)} AS quantile FROM {source}"
        for name, (column, probabilities) in points.items()
        for p in probabilities
    ]
    return f"{prefix} {' UNION ALL '.join(parts)}"


def histogram_sql(column: str, low: str | None, high: str | None, bins: int = 100) -> str:
    limits = " AND ".join(c for c in (f"x >= {low}" if low else "", f"x <= {high}" if high else "") if c)
    edge = lambda i: f"CASE WHEN {i} = {bins} THEN hi ELSE {i} * ((hi - lo)/{bins}.0::DOUBLE) + lo END"
    return f"""{EDA}, xs AS (SELECT {column} AS x FROM eda WHERE {column} IS NOT NULL),
kept AS (SELECT x FROM xs WHERE {limits}), 
span AS (SELECT coalesce(CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END, 0) AS lo,
  coalesce(CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END, 1) AS hi FROM kept),
edges AS (SELECT i AS bin, {edge('i')} AS lower, {edge('(i + 1)')} AS upper FROM range({bins}) t(i), span)
SELECT e.bin, {r('lower', 6)} AS lower, {r('upper', 6)} AS upper, count(x) AS "count"
FROM edges e LEFT JOIN kept ON x >= lower AND (x < upper OR (e.bin = {bins - 1} AND x <= upper))
GROUP BY e.bin, lower, upper"""


def value_counts_sql(prefix: str, value: str, source: str, where: str = "true", limit: int | None = None) -> str:
    tail = f' ORDER BY "count" DESC, value NULLS FIRST LIMIT {limit}' if limit else ""
    return f'{prefix} SELECT {value} AS value, count(*) AS "count" FROM {source} WHERE {where} GROUP BY 1{tail}'


def profile_sql(prefix: str, source: str, types: dict[str, str]) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, {count_if(f'{c} IS NULL')} AS missing, "
        f"{pct(count_if(f'{c} IS NULL'), 'count(*)', 2)} AS missing_pct, "
        f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS unique_including_na FROM {source}"
        for c, t in types.items()
    ]
    return f"{prefix} {' UNION ALL '.join(parts)}"


def case_of(column: str, labels: dict[int, str]) -> str:
    return f"CASE {column} {' '.join(f'WHEN {k} THEN {chr(39)}{v}{chr(39)}' for k, v in labels.items())} END"


def month_name(column: str) -> str:
    return f"'yellow_tripdata_' || strftime({column}, '%Y-%m') || '.parquet'"


def duplicates_sql(prefix: str, source: str, keys: str) -> str:
    return (
        f"{prefix} SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_in_duplicate_groups, "
        f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS removable_rows FROM "
        f"(SELECT count(*) AS n FROM {source} GROUP BY {keys} HAVING count(*) > 1) g"
    )


TRIP_TYPES = {f.name: f.dataType.simpleString() for f in S.TRIP_SCHEMA.fields}
MISSING_PATTERN = {
    **{f"{c}_missing": f"{c} IS NULL" for c in S.BLOCK_COLUMNS},
    "payment_type_zero": "payment_type = 0",
    "all six conditions": "flex",
    "some but not all conditions": "("
    + " OR ".join([*[f"{c} IS NULL" for c in S.BLOCK_COLUMNS], "coalesce(payment_type = 0, false)"])
    + ") AND NOT coalesce(flex, false)",
}
PASSENGERS = {
    "missing passenger_count": "passenger_count IS NULL",
    "passenger_count = 0": "passenger_count = 0",
    "passenger_count between 1 and 6": "passenger_count BETWEEN 1 AND 6",
    "passenger_count > 6": "passenger_count > 6",
    "passenger_count < 0": "passenger_count < 0",
}
SIGNS = {
    "fare < 0 and total < 0": "nf AND nt",
    "fare < 0 and total >= 0": "nf AND NOT nt",
    "fare >= 0 and total < 0": "NOT nf AND nt",
    "tip < 0 with fare < 0 and total < 0": "np AND nf AND nt",
    "tip < 0 only": "np AND NOT nf AND NOT nt",
}
DRIVERS = {
    "total > components": "gap > 0.01",
    "total < components": "gap < -0.01",
    "inconsistent and missing block": "inconsistent AND block",
}
DURATIONS = {
    "duration < 0": "minutes < 0",
    "duration = 0": "minutes = 0",
    "0 < duration < 1 minute": "minutes > 0 AND minutes < 1",
    "duration > 6 hours": "minutes > 360",
    "duration > 24 hours": "minutes > 1440",
}
DURATION_RANGES = {
    "<= 0 min": "minutes <= 0",
    "0-1 min": "minutes > 0 AND minutes <= 1",
    "1 min-6 h": "minutes > 1 AND minutes <= 360",
    "6-20 h": "minutes > 360 AND minutes <= 1200",
    "20-23 h": "minutes > 1200 AND minutes <= 1380",
    "23-24 h": "minutes > 1380 AND minutes <= 1440",
    "> 24 h": "minutes > 1440",
}
SPEEDS = {
    "speed = 0": "speed = 0",
    "speed > 80 mph": "speed > 80",
    "speed > 100 mph": "speed > 100",
    "speed > 200 mph": "speed > 200",
}
FAST = {
    "all high-speed records": "speed > 80",
    "duration < 1 minute": "speed > 80 AND minutes < 1",
    "trip_distance > 100 miles": "speed > 80 AND trip_distance > 100",
    "trip_distance > 500 miles": "speed > 80 AND trip_distance > 500",
    "Flex Fare group": "speed > 80 AND flex",
    "negative transaction": "speed > 80 AND total_amount < 0",
}
CHECKS = {
    "missing_pattern": MISSING_PATTERN,
    "passenger_checks": PASSENGERS,
    "sign_populations": SIGNS,
    "inconsistency_drivers": DRIVERS,
    "duration_checks": DURATIONS,
    "duration_bins": DURATION_RANGES,
    "speed_checks": SPEEDS,
    "high_speed_diagnostics": FAST,
}
SCREEN = {
    "trip_distance = 0": "trip_distance = 0",
    "trip_distance > 100": "trip_distance > 100",
    "fare_amount < 0": "fare_amount < 0",
    "total_amount < 0": "total_amount < 0",
    "tip_amount < 0": "tip_amount < 0",
    "passenger_count = 0": "passenger_count = 0",
    "fare_amount = 0": "fare_amount = 0",
    "total_amount = 0": "total_amount = 0",
}
NEAR = f"""{EDA}, near AS (
  SELECT minutes AS original_duration_minutes, 1440 - minutes AS hypothetical_duration_minutes, trip_distance,
    trip_distance/((1440 - minutes)/60) AS hypothetical_speed_mph, fare_amount, total_amount
  FROM eda WHERE minutes >= 1380 AND minutes < 1440)"""
NEAR_COLUMNS = [
    "original_duration_minutes",
    "hypothetical_duration_minutes",
    "trip_distance",
    "hypothetical_speed_mph",
    "fare_amount",
    "total_amount",
]


def violation(rule: str, column: str, detail: str) -> str:
    return f"SELECT '{rule}' AS rule, '{column}' AS \"column\", '{detail}' AS detail"


LACKING = "required column is missing"
SURPLUS = "column is not part of the source schema"
UNKNOWN = "SELECT 'unknown_code' AS rule, \"column\", value AS detail FROM coded"
CODES_OF_TRIPS = FAULTY.replace("trip_distance > 100", "false").replace("tolls_amount > 0", "false")


def issue_sql(where: str) -> str:
    return f"""{EDA} SELECT {P}, {D}, minutes AS trip_duration_minutes, trip_distance, total_amount,
  CASE WHEN NOT {BOUNDARY} AND NOT {UNTRUSTED} THEN 'other outside-month date'
       WHEN {UNTRUSTED} THEN 'ancient/untrustworthy date' ELSE 'month-boundary record' END AS date_issue_type
FROM eda WHERE {OUTSIDE} AND {where}"""


def crosstab_sql() -> str:
    sign = "CASE WHEN total_amount < 0 THEN 'n' WHEN total_amount = 0 THEN 'z' ELSE 'p' END"
    cells = (
        f"{count_if(f'{sign} = {chr(39)}n{chr(39)}')} AS negative, {count_if(f'{sign} = {chr(39)}z{chr(39)}')} AS zero, "
        f"{count_if(f'{sign} = {chr(39)}p{chr(39)}')} AS positive, count(*) AS \"All\""
    )
    lines = [
        f"SELECT '{g}' AS record_group, {cells} FROM eda WHERE {w}"
        for g, w in (("flex_fare_group", "flex"), ("standard_group", "NOT flex"), ("All", "true"))
    ]
    return f"{EDA} {' UNION ALL '.join(lines)}"


def distance_bins_sql() -> str:
    bins = {
        "<= 0": "trip_distance <= 0",
        "0-50": "trip_distance > 0 AND trip_distance <= 50",
        "50-100": "trip_distance > 50 AND trip_distance <= 100",
        "100-500": "trip_distance > 100 AND trip_distance <= 500",
        "> 500": "trip_distance > 500",
    }
    cells = ", ".join(f'{pct(count_if(c), "count(trip_distance)", 4)} AS "{b}"' for b, c in bins.items())
    lines = [
        f"SELECT '{g}' AS record_group, {cells} FROM eda WHERE {w}"
        for g, w in (("flex_fare_group", "flex"), ("standard_group", "NOT flex"))
    ]
    return f"{EDA} {' UNION ALL '.join(lines)}"


def location_sql(range_only: bool) -> str:
    pairs = []
    for z in ("PULocationID", "DOLocationID"):
        sentinel = count_if(f"{z} IN (264, 265)")
        if range_only:
            pairs += [(f"{z} unknown zone", sentinel), (f"{z} outside 1-265", count_if(f"{z} < 1 OR {z} > 265"))]
        else:
            pairs += [
                (f"{z} missing", count_if(f"{z} IS NULL")),
                (f"{z} <= 0", count_if(f"{z} <= 0")),
                (f"{z} minimum", f"min({z})"),
                (f"{z} maximum", f"max({z})"),
                (f"{z} unique", f"count(DISTINCT {z})"),
                (f"{z} in 264, 265", sentinel),
            ]
    if range_only:
        pairs.append(("both ends unknown", count_if("PULocationID IN (264, 265) AND DOLocationID IN (264, 265)")))
    return f"{TRIPS} {rows_of(pairs, 'trips')}"


def build() -> dict[str, str]:
    flagged = {
        name: f"{CLEAN} SELECT {KEY}, {name} FROM processed" for name in [*S.QUALITY_FLAGS, S.DURATION, S.SPEED]
    }
    tables = (
        "region nation customer supplier part orders lineitem events "
        "documents embeddings pages benchmark labels conversations"
    ).split()
    order_file = month_name("o_orderdate")
    sign_sums = "count(*) FILTER (WHERE nf AND nt)", "count(*) FILTER (WHERE nf <> nt)", (
        "count(*) FILTER (WHERE np AND NOT nf AND NOT nt)"
    )
    return {
        "scan_month": f"{TRIPS} SELECT {NAMES} FROM trips",
        "scan_months": f"{BY_VENDOR} SELECT source_file, VendorID, count(*) AS rows, min({P}) AS earliest, "
        f"max({P}) AS latest FROM sourced GROUP BY 1, 2",
        "file_inventory": " UNION ALL ".join(
            f"SELECT '{t}.parquet' AS source_file, count(*) AS rows, false AS is_empty, true AS has_size FROM {t}"
            for t in tables
        ),
        "reporting_period": f"""SELECT o_orderkey,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'x_' ELSE '' END || {order_file} AS source_file,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(year(o_orderdate) AS INT) END AS reporting_year,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(month(o_orderdate) AS INT) END AS reporting_month FROM orders""",
        "with_lineage": f"{TRIPS} SELECT '{MONTH}' AS source_file, {KEY} FROM trips",
        "write_outputs": f"{CLEAN} SELECT 'processed' AS half, source_file, {KEY}, NULL::VARCHAR AS rejection_reason "
        f"FROM processed UNION ALL SELECT 'rejected', source_file, {KEY}, rejection_reason FROM rejected",
        "write_quality": summary_sql(CLEAN, "trips"),
        "pending_files": f"SELECT DISTINCT {order_file} AS file_name FROM orders WHERE {order_file} NOT IN "
        f"(SELECT {month_name('l_shipdate')} FROM lineitem WHERE l_returnflag = 'R')",
        "pending_quarter_ends": f"""WITH listed AS (SELECT DISTINCT CASE WHEN o_orderpriority <> '5-LOW' THEN {order_file} END AS file_name FROM orders)
SELECT file_name FROM listed WHERE NOT EXISTS (
  SELECT 1 FROM lineitem WHERE month(l_shipdate) % 3 <> 0 AND {month_name('l_shipdate')} = file_name)""",
        "missing_months": f"""WITH months AS (
  SELECT CAST(m AS DATE) AS month, {month_name('m')} AS file_name
  FROM generate_series(TIMESTAMP '1991-01-01', TIMESTAMP '2024-12-01', INTERVAL 1 MONTH) g(m))
SELECT file_name, month FROM months WHERE file_name NOT IN (SELECT {order_file} FROM orders)""",
        "ingest_incremental": f"{BY_VENDOR} SELECT source_file, count(*) AS rows FROM sourced GROUP BY 1",
        "ingest_with_quarantine": f"""{BY_VENDOR}, odd AS (
  SELECT DISTINCT source_file FROM sourced WHERE source_file LIKE '%-02.parquet' AND trip_distance > 100 AND payment_type IS NOT NULL)
SELECT source_file, count(*) AS rows, NULL::VARCHAR AS rule, NULL::VARCHAR AS "column" FROM sourced
WHERE source_file NOT IN (SELECT source_file FROM odd) GROUP BY 1
UNION ALL SELECT source_file, CAST(0 AS BIGINT), 'unknown_code', 'payment_type' FROM odd""",
        "check_not_empty": f"{TRIPS} SELECT 'empty' AS rule, NULL::VARCHAR AS \"column\", 'no rows' AS detail "
        "WHERE NOT EXISTS (SELECT 1 FROM trips WHERE total_amount > 1e9)",
        "check_missing_columns": " UNION ALL ".join(
            [
                violation("missing_column", "Airport_fee", LACKING),
                violation("missing_column", "extra", LACKING),
                violation("unexpected_column", "airport_fee", SURPLUS),
            ]
        ),
        "check_unexpected_columns": f"{CODES_OF_TRIPS} {violation('unexpected_column', 'cbd_congestion_fee', SURPLUS)} "
        f"UNION ALL {UNKNOWN}",
        "check_datetime_types": f"{CODES_OF_TRIPS} {violation('not_datetime', P, 'column is string, not a datetime')} "
        f"UNION ALL {UNKNOWN}",
        "check_domains": f'{FAULTY} SELECT "column", value FROM coded',
        "validate_source": f"{FAULTY} {violation('unexpected_column', 'cbd_congestion_fee', SURPLUS)} "
        f"UNION ALL {UNKNOWN}",
        "domain_report": f"""{FAULTY}, codes AS (SELECT "column", code, count(*) AS rows, documented FROM whole
  WHERE code IS NOT NULL GROUP BY ALL)
SELECT *, bool_and(documented) OVER (PARTITION BY "column") AS all_documented FROM codes""",
        "observed_codes": f'{FAULTY} SELECT "column", code, count(*) AS rows, documented FROM whole '
        "WHERE code IS NOT NULL GROUP BY ALL",
        "string_domain_report": f"""{FAULTY} SELECT store_and_fwd_flag AS value, count(*) AS rows,
  coalesce(store_and_fwd_flag NOT IN ('Y', 'N'), false) AS is_outside FROM faulty GROUP BY ALL""",
        "order_status_report": """SELECT o_orderstatus AS value, count(*) AS rows,
  coalesce(o_orderstatus NOT IN ('F', 'O'), false) AS is_outside FROM orders GROUP BY ALL""",
        "period_bounds": """SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
  date_trunc('month', o_orderdate)::TIMESTAMP AS reporting_start,
  date_trunc('month', o_orderdate)::TIMESTAMP + INTERVAL 1 MONTH AS reporting_end,
  date_trunc('month', o_orderdate)::TIMESTAMP - INTERVAL 1 YEAR AS trusted_start FROM orders""",
        "rejected": f"{CLEAN} SELECT * FROM rejected",
        "processed": f"{CLEAN} SELECT * FROM processed",
        **flagged,
        "transform_trips": f"{CLEAN} SELECT *, NULL::VARCHAR AS rejection_reason FROM processed "
        "UNION ALL BY NAME SELECT * FROM rejected",
        "transform_many": f"{BY_VENDOR} SELECT {KEY}, source_file, is_outside_reporting_month, NULL::VARCHAR AS rejection_reason "
        f"FROM processed UNION ALL SELECT {KEY}, source_file, NULL, rejection_reason FROM rejected",
        "reconcile_counts": f"""{CLEAN}, n AS (SELECT (SELECT count(*) FROM trips) AS raw_rows,
  (SELECT count(*) FROM processed) AS processed_rows, (SELECT count(*) FROM rejected) AS rejected_rows)
SELECT *, raw_rows = processed_rows + rejected_rows AS reconciles FROM n""",
        "quality_summary": summary_sql(CLEAN, "trips"),
        "quality_by_source": summary_by_source_sql(),
        "flag_counts": f"{CLEAN} {counts({f: f for f in S.QUALITY_FLAGS}, 'processed', value='count')}",
        "dataset_shape": f"{TRIPS} SELECT count(*) AS rows, CAST({len(S.TRIP_COLUMNS)} AS BIGINT) AS columns, "
        f"'{','.join(S.TRIP_COLUMNS)}' AS column_names FROM trips",
        "period_outliers": f"""{TRIPS}, o AS (SELECT {P} AS p FROM trips WHERE {OUTSIDE})
SELECT count(*) AS rows, min(p) AS earliest, max(p) AS latest,
  (SELECT string_agg(CAST(y AS VARCHAR), ',' ORDER BY y) FROM (SELECT DISTINCT year(p) AS y FROM o)) AS years FROM o""",
        "missing_counts": f"""{TRIPS}, m AS ({rows_of([(c, count_if(f'{c} IS NULL')) for c in S.TRIP_COLUMNS], 'trips', '"column"', 'missing')})
SELECT * FROM m WHERE missing > 0""",
        "column_profile": profile_sql(TRIPS, "trips", TRIP_TYPES),
        "column_profile_orders": profile_sql(
            "",
            "orders",
            {
                "o_orderkey": "bigint",
                "o_custkey": "bigint",
                "o_orderstatus": "string",
                "o_totalprice": "double",
                "o_orderdate": "timestamp_ntz",
                "o_orderpriority": "string",
            },
        ),
        "describe_numeric": describe_sql(TRIPS, "trips", S.METRIC_COLUMNS, [0.25, 0.5, 0.75]),
        "describe_events": describe_sql("", "events", ["value", "user_id"], [0.25, 0.5, 0.75]),
        "preview": f"{TRIPS} SELECT {NAMES} FROM numbered ORDER BY k LIMIT 5",
        "preview_of_files": f"{TRIPS} SELECT {NAMES} FROM numbered ORDER BY k LIMIT 5",
        "month_positions": f"{BY_VENDOR} SELECT source_file, count(*) AS rows, CAST(0 AS BIGINT) AS first_position, "
        "count(*) - 1 AS last_position, count(*) AS positions FROM sourced GROUP BY 1",
        "column_profile_united": 'SELECT "column", dtype, missing, missing_pct, true AS estimate_is_near '
        f"FROM ({profile_sql(TRIPS, 'trips', TRIP_TYPES)})",
        "value_counts": value_counts_sql(TRIPS, "passenger_count", "trips"),
        "event_type_counts": "SELECT event_type AS value, count(*) AS \"count\", "
        f"{pct('count(*)', '(SELECT count(event_type) FROM events)', 2)} AS percentage FROM events "
        "WHERE event_type IS NOT NULL GROUP BY 1",
        "anomaly_screen": f"{TRIPS} "
        + " UNION ALL ".join(
            f"SELECT '{n}' AS condition, {count_if(c)} AS \"count\", {pct(count_if(c), 'count(*)', 4)} AS percentage FROM trips"
            for n, c in SCREEN.items()
        ),
        "negative_amounts": f"{TRIPS} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {count_if(f'{c} < 0')} AS negative, count(*) AS rows, min({c}) AS min FROM trips"
            for c in ("fare_amount", "total_amount", "tip_amount")
        ),
        "distance_profile": f"{TRIPS} SELECT {count_if('trip_distance = 0')} AS zero_distance, "
        f"{count_if('trip_distance > 100')} AS over_100_miles, max(trip_distance) AS max_distance FROM trips",
        "passenger_checks": f"{TRIPS} {counts(PASSENGERS, 'trips')}",
        "location_checks": location_sql(range_only=False),
        "zone_range_checks": location_sql(range_only=True),
        "quantiles": quantile_sql(
            EDA,
            "eda",
            {
                S.DURATION: ("minutes", report.DURATION_POINTS),
                S.SPEED: ("speed", report.SPEED_POINTS),
                "trip_distance": ("trip_distance", report.DISTANCE_POINTS),
                "total_amount": ("total_amount", report.TOTAL_POINTS),
            },
        ),
        "event_quantiles": quantile_sql("", "events", {"value": ("value", [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0])}),
        "histogram": histogram_sql("trip_distance", "0", "(SELECT quantile_cont(x, 0.995) FROM xs)"),
        "total_histogram": histogram_sql(
            "total_amount", "(SELECT quantile_cont(x, 0.005) FROM xs)", "(SELECT quantile_cont(x, 0.995) FROM xs)"
        ),
        "speed_histogram": histogram_sql("speed", "0", "(SELECT quantile_cont(x, 0.999) FROM xs)"),
        "histogram_of_one_value": histogram_sql("extra", "4.4", "5.4"),
        "histogram_of_no_value": histogram_sql("extra", "100", "200"),
        "duration_checks": f"{EDA} {counts(DURATIONS, 'eda')}",
        "duration_hours_checks": f"{EDA} SELECT {count_if('hours > 24')} AS over_24_hours, {count_if('hours > 6')} AS over_6_hours, "
        f"{r('max(hours)', 6)} AS max_hours, {count_if(f'{D} < {P}')} AS dropoff_before_pickup FROM eda",
        "speed_checks": f"{EDA} {counts(SPEEDS, 'eda')}",
        "speed_profile": f"{EDA} SELECT {count_if('hourly_speed > 80')} AS over_80_mph, {r('max(hourly_speed)', 6)} AS max_speed_mph FROM eda",
        "duration_bins": f"{EDA} {counts(DURATION_RANGES, 'eda', 'duration_range', 'count')}",
        "check_counts": f"{EDA} "
        + " UNION ALL ".join(
            f"SELECT '{check}' AS \"check\", '{n}' AS metric, {count_if(c)} AS value FROM eda"
            for check, conditions in CHECKS.items()
            for n, c in conditions.items()
        ),
        "missing_pattern": f"{EDA} {counts(MISSING_PATTERN, 'eda')}",
        "segment_contiguity": f"""{TRIPS} SELECT min(k) AS first_position, max(k) AS last_position, count(*) AS segment_rows,
  max(k) - min(k) + 1 = count(*) AS contiguous FROM numbered WHERE {ALL_MISSING} AND payment_type = 0""",
        # Segment rows lie among others, so they have gaps unless a month has no other rows.
        "segment_contiguity_of_files": f"""{BY_VENDOR} SELECT * FROM (
  SELECT source_file, {count_if(f"{ALL_MISSING} AND payment_type = 0")} AS segment_rows,
    {count_if(f"{ALL_MISSING} AND payment_type = 0")} IN (1, count(*)) AS contiguous FROM sourced GROUP BY 1) WHERE segment_rows > 0""",
        "segment_vendor_mix": f"{EDA} SELECT {case_of('VendorID', S.VENDOR_SLUGS)} AS vendor, {count_if('block')} AS segment_rows, "
        "count(*) AS all_rows FROM eda GROUP BY 1",
        "record_sign_crosstab": crosstab_sql(),
        "sign_populations": f"{EDA} {counts(SIGNS, 'eda', 'population', 'rows')}",
        "payment_by_population": f"{EDA} SELECT {case_of('payment_type', S.PAYMENT_LABELS)} AS payment, "
        f"{sign_sums[0]} AS negative_fare_and_total, {sign_sums[1]} AS negative_fare_or_total_mismatch, "
        f"{sign_sums[2]} AS negative_tip_only FROM eda WHERE payment_type BETWEEN 0 AND 6 GROUP BY 1 "
        "HAVING bool_or(nf OR nt OR np)",
        "payment_mix": f"{EDA} SELECT {case_of('payment_type', S.PAYMENT_SLUGS)} AS value, count(*) AS \"count\", "
        f"{pct('count(*)', '(SELECT count(*) FROM eda WHERE payment_type BETWEEN 0 AND 6)', 2)} AS percentage "
        "FROM eda WHERE payment_type BETWEEN 0 AND 6 GROUP BY 1",
        "reconcile_by_vendor": f"{EDA} SELECT VendorID, count(residual) AS complete_rows, "
        f"{count_if('abs(residual) <= 0.01')} AS matching_within_1_cent, "
        f"{pct(count_if('abs(residual) <= 0.01'), 'count(residual)', 4)} AS matching_percentage, "
        f"{r('median(residual)', 6)} AS median_residual, {r('max(abs(residual))', 6)} AS maximum_absolute_residual "
        "FROM eda GROUP BY 1",
        "top_residuals_by_vendor": f"""{EDA}, c AS (SELECT VendorID, residual, count(*) AS n FROM eda WHERE residual IS NOT NULL GROUP BY 1, 2)
SELECT VendorID, residual AS amount_residual, n AS "count" FROM c
QUALIFY row_number() OVER (PARTITION BY VendorID ORDER BY n DESC, residual) <= 5""",
        "flex_residual_counts": f"""{EDA} SELECT lenient AS residual, count(*) AS "count",
  {pct('count(*)', '(SELECT count(*) FROM eda WHERE flex)', 4)} AS percentage
FROM eda WHERE flex AND lenient IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
        "total_inconsistency": f"{EDA} SELECT {count_if('inconsistent')} AS inconsistent_rows, "
        f"{pct(count_if('inconsistent'), 'count(*)', 2)} AS inconsistent_percentage FROM eda",
        "total_gap_describe": describe_sql(
            f"{EDA}, off AS (SELECT abs(gap) AS gap FROM eda WHERE inconsistent)", "off", ["gap"], [0.25, 0.5, 0.75], named=False
        ),
        "inconsistency_drivers": f"{EDA} {counts(DRIVERS, 'eda')}",
        "inconsistency_top_surcharges": value_counts_sql(EDA, "congestion_surcharge", "eda", "inconsistent", 5),
        "inconsistency_top_extras": value_counts_sql(EDA, "extra", "eda", "inconsistent AND extra IS NOT NULL", 5),
        "date_checks": f"{EDA} SELECT min({P}) AS earliest_pickup, max({P}) AS latest_pickup, {count_if(OUTSIDE)} AS outside_month, "
        f"{count_if(f'{OUTSIDE} AND {BOUNDARY}')} AS boundary_dates, {count_if(UNTRUSTED)} AS untrustworthy_dates, "
        f"{count_if(f'{OUTSIDE} AND NOT {BOUNDARY} AND NOT {UNTRUSTED}')} AS unexplained_dates FROM eda",
        "date_issue_listing": issue_sql("true"),
        "date_issue_unexplained": issue_sql(f"NOT {BOUNDARY} AND NOT {UNTRUSTED}"),
        "high_speed_diagnostics": f"{EDA} {counts(FAST, 'eda')}",
        "top_speed": f"""{EDA} SELECT {P}, {D}, minutes AS trip_duration_minutes, trip_distance, speed AS average_speed_mph,
  fare_amount, total_amount, flex AS is_flex_fare_record FROM eda WHERE speed IS NOT NULL
ORDER BY speed DESC, {P} NULLS FIRST, {D}, minutes, trip_distance, fare_amount, total_amount, flex LIMIT 20""",
        "near_24h_rows": f"{NEAR} SELECT * FROM near",
        "near_24h_checks": f"{NEAR} "
        + counts(
            {
                "records": "true",
                "hypothetical duration <= 0": "hypothetical_duration_minutes <= 0",
                "hypothetical speed <= 80 mph": "hypothetical_speed_mph BETWEEN 0 AND 80",
                "hypothetical speed > 80 mph": "hypothetical_speed_mph > 80",
            },
            "near",
        ),
        "near_24h_describe": describe_sql(NEAR, "near", NEAR_COLUMNS, [0.01, 0.25, 0.5, 0.75, 0.99]),
        "distance_bins_by_group": distance_bins_sql(),
        "exact_duplicates": duplicates_sql(TRIPS, "trips", "ALL").replace("GROUP BY ALL", f"GROUP BY {NAMES}"),
        "business_duplicates": duplicates_sql(TRIPS, "trips", ", ".join(S.IDENTITY_COLUMNS)),
        "lineitem_exact_duplicates": duplicates_sql(
            "",
            "lineitem",
            "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
            "l_returnflag, l_linestatus, l_shipdate",
        ),
        "lineitem_business_duplicates": duplicates_sql("", "lineitem", "l_orderkey, l_linenumber"),
        "enrich": f"{EDA} SELECT {KEY}, flex AS is_flex_fare_record, nt AS is_negative_transaction, "
        "residual AS amount_residual_diagnostic, minutes AS trip_duration_minutes, speed AS average_speed_mph FROM eda",
        "normal_trips": f"{CLEAN} SELECT * FROM processed WHERE NOT (is_outside_reporting_month OR has_nonpositive_duration "
        "OR has_near_24h_duration OR has_extreme_distance OR has_implausible_speed)",
    }
