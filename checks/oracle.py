"""DuckDB SQL for every query, in the plain form: unnest, left join, rank, filter, union."""

from __future__ import annotations

_TABLES = """
WITH profiles AS (
  SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS month,
         CASE WHEN o_custkey % 50 <> 7 THEN CAST(o_custkey AS VARCHAR) END AS ifa,
         CASE l_returnflag WHEN 'N' THEN 'Android' WHEN 'A' THEN 'android' ELSE 'iOS' END
           AS platform,
         CAST(l_partkey AS VARCHAR) AS device_model,
         l_shipdate, l_linenumber, l_orderkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), apps AS (
  SELECT month, ifa, platform, device_model,
         CASE WHEN l_orderkey % 61 <> 0 OR nth < l_linenumber - 1
              THEN l_shipdate + to_days(CAST(7 * nth AS INTEGER)) END AS first_seen
  FROM (SELECT *, unnest(range(l_linenumber)) AS nth FROM profiles)
), flat AS (
  SELECT month, ifa, platform, device_model, first_seen
  FROM apps WHERE lower(platform) = 'android'
), lookup AS (
  SELECT CAST(p_partkey AS VARCHAR) AS model, p_brand AS brand, p_name AS name
  FROM part WHERE p_partkey % 10 <> 0
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), p_brand, 'A ' || p_name
  FROM part WHERE p_partkey % 10 <> 0 AND p_partkey % 15 = 4
), numbered AS (
  SELECT p_name AS name, min(p_partkey) AS k,
         CAST(DATE '1995-01-01' + CAST(7 * min(p_partkey) AS INTEGER) AS DATE) AS day
  FROM part GROUP BY p_name
), launches AS (
  SELECT name, CASE WHEN k % 12 NOT IN (7, 9) THEN day END AS launch FROM numbered
  UNION ALL SELECT name, CAST(day - 10 AS DATE) FROM numbered WHERE k % 12 = 3
  UNION ALL SELECT name, NULL FROM numbered WHERE k % 12 = 5
  UNION ALL SELECT 'A ' || name, CAST(day + 3 AS DATE) FROM numbered WHERE k % 30 = 4
), left_joined AS (
  SELECT ifa, first_seen, brand, name FROM flat LEFT JOIN lookup ON device_model = model
), filled AS (
  SELECT coalesce(ifa, 'Not Detected') AS ifa, first_seen,
         coalesce(brand, 'Not Detected') AS brand, coalesce(name, 'Not Detected') AS name
  FROM left_joined
), launched AS (
  SELECT month, coalesce(ifa, 'Not Detected') AS ifa, first_seen,
         CAST(first_seen AS DATE) AS date, n.name, launch
  FROM apps
  LEFT JOIN lookup AS n ON device_model = model
  JOIN launches ON n.name = launches.name
  WHERE lower(platform) LIKE 'android' AND coalesce(brand, 'Not Detected') = 'Brand#1'
), first_user AS (
  SELECT ifa, name, launch, first_seen, date FROM launched
  QUALIFY row_number() OVER (
    PARTITION BY ifa
    ORDER BY date NULLS FIRST, first_seen NULLS FIRST, name, launch NULLS LAST) = 1
), first_month AS (
  SELECT month, ifa, name, launch, first_seen, date FROM launched
  QUALIFY row_number() OVER (
    PARTITION BY month, ifa
    ORDER BY date NULLS FIRST, first_seen NULLS FIRST, name, launch NULLS LAST) = 1
), deltas_all AS (
  SELECT *, CAST(date_diff('day', launch, date) AS INTEGER) AS delta FROM first_user
), deltas AS (
  SELECT * FROM deltas_all WHERE CAST(delta AS VARCHAR) NOT LIKE '%-%'
), monthly_all AS (
  SELECT *, CAST(date_diff('day', launch, date) AS INTEGER) AS delta FROM first_month
), monthly AS (
  SELECT * FROM monthly_all WHERE CAST(delta AS VARCHAR) NOT LIKE '%-%'
), histogram AS (
  SELECT delta, count(DISTINCT ifa) AS count FROM deltas GROUP BY delta
), histograms AS (
  SELECT month, delta, count(DISTINCT ifa) AS count FROM monthly GROUP BY month, delta
), running AS (
  SELECT delta, sum(count) OVER (ORDER BY delta) AS run, sum(count) OVER () AS total
  FROM histogram
), cuts AS (
  SELECT min(delta) FILTER (run * 1000 >= total * 25) AS c1,
         min(delta) FILTER (run * 1000 >= total * 160) AS c2,
         min(delta) FILTER (run * 1000 >= total * 500) AS c3,
         min(delta) FILTER (run * 1000 >= total * 840) AS c4
  FROM running
), derived AS (
  SELECT 'Innovator' AS segment, 'SEG_TEL_NS_00008' AS segment_id, CAST(NULL AS INTEGER) AS lo, c1 AS hi FROM cuts
  UNION ALL SELECT 'Early_Adopter', 'SEG_TEL_NS_00009', c1 + 1, c2 FROM cuts
  UNION ALL SELECT 'Early_Majority', 'SEG_TEL_NS_00010', c2 + 1, c3 FROM cuts
  UNION ALL SELECT 'Late_Majority', 'SEG_TEL_NS_00011', c3 + 1, c4 FROM cuts
  UNION ALL SELECT 'Laggard', 'SEG_TEL_NS_00012', c4 + 1, NULL FROM cuts
), running_monthly AS (
  SELECT delta, sum(sum(count)) OVER (ORDER BY delta) AS run, sum(sum(count)) OVER () AS total
  FROM histograms GROUP BY delta
), cuts_monthly AS (
  SELECT min(delta) FILTER (run * 1000 >= total * 25) AS c1,
         min(delta) FILTER (run * 1000 >= total * 160) AS c2,
         min(delta) FILTER (run * 1000 >= total * 500) AS c3,
         min(delta) FILTER (run * 1000 >= total * 840) AS c4
  FROM running_monthly
), derived_monthly AS (
  SELECT 'Innovator' AS segment, 'SEG_TEL_NS_00013' AS segment_id, CAST(NULL AS INTEGER) AS lo, c1 AS hi FROM cuts_monthly
  UNION ALL SELECT 'Early_Adopter', 'SEG_TEL_NS_00014', c1 + 1, c2 FROM cuts_monthly
  UNION ALL SELECT 'Early_Majority', 'SEG_TEL_NS_00015', c2 + 1, c3 FROM cuts_monthly
  UNION ALL SELECT 'Late_Majority', 'SEG_TEL_NS_00016', c3 + 1, c4 FROM cuts_monthly
  UNION ALL SELECT 'Laggard', 'SEG_TEL_NS_00017', c4 + 1, NULL FROM cuts_monthly
)
"""


def _segment(source: str, segment: str, segment_id: str, condition: str) -> str:
    return f"""
SELECT '202109' AS quarter, 'samsung_high_end_phones' AS adoption_type, ifa,
       '{segment_id}' AS segment_id, '{segment}' AS segment, 'Brand#1' AS device_brand,
       name AS device_name, launch AS launch_date, first_seen, delta
FROM {source} WHERE {condition}"""


# Segment, id and condition of each band, stated apart from the package's tables.
_MY = [
    ("Innovator", "SEG_TEL_NS_00008", "delta < 7"),
    ("Early_Adopter", "SEG_TEL_NS_00009", "delta BETWEEN 7 AND 108"),
    ("Early_Majority", "SEG_TEL_NS_00010", "delta BETWEEN 109 AND 194"),
    ("Late_Majority", "SEG_TEL_NS_00011", "delta BETWEEN 195 AND 341"),
    ("Laggard", "SEG_TEL_NS_00012", "delta > 341"),
]
_ID_DOCUMENTED = [
    ("Innovator", "SEG_TEL_NS_00013", "delta < 23"),
    ("Early_Adopter", "SEG_TEL_NS_00014", "delta BETWEEN 23 AND 128"),
    ("Early_Majority", "SEG_TEL_NS_00015", "delta BETWEEN 129 AND 332"),
    ("Late_Majority", "SEG_TEL_NS_00016", "delta BETWEEN 333 AND 469"),
    ("Laggard", "SEG_TEL_NS_00017", "delta > 469"),
]
_ID_AS_CODED = [
    ("Innovator", "SEG_TEL_NS_00013", "delta < 23"),
    ("Early_Adopter", "SEG_TEL_NS_00014", "delta BETWEEN 22 AND 129"),
    ("Early_Majority", "SEG_TEL_NS_00015", "delta BETWEEN 128 AND 333"),
    ("Late_Majority", "SEG_TEL_NS_00016", "delta BETWEEN 332 AND 470"),
    ("Laggard", "SEG_TEL_NS_00017", "delta > 469"),
]


def _union(source: str, bands: list[tuple[str, str, str]]) -> str:
    return "\nUNION ALL".join(_segment(source, *band) for band in bands)


def _inside(source: str, bands: str) -> str:
    """Segments of derived bands, by a join on their limits."""
    return f"""
SELECT '202109' AS quarter, 'samsung_high_end_phones' AS adoption_type, ifa,
       segment_id, segment, 'Brand#1' AS device_brand,
       name AS device_name, launch AS launch_date, first_seen, delta
FROM {source} JOIN {bands} ON (lo IS NULL OR delta >= lo) AND (hi IS NULL OR delta <= hi)"""


def _labelled(datamart: str) -> str:
    return f"""SELECT '202201' AS quarter, 'uptake' AS adoption_type, ifa, segment_id, segment,
       'any' AS device_brand, device_name, launch_date, first_seen, delta FROM ({datamart})"""


_DATAMART = _union("deltas", _MY)
_CODED = _union("monthly", _ID_AS_CODED)
_BAND_KEYS = ["innovator", "early_adopter", "early_majority", "late_majority", "laggard"]

_SELECTS = {
    "scan_profiles_month": """SELECT month, ifa, platform, device_model,
         l_linenumber AS n_apps FROM profiles WHERE month = 199806""",
    "scan_profiles_months": """SELECT month, ifa, platform, device_model,
         l_linenumber AS n_apps FROM profiles""",
    "scan_profiles_unequal": """SELECT month, ifa, platform, device_model,
         l_linenumber AS n_apps FROM profiles""",
    "scan_device_lookup_csv": "SELECT model, brand, name FROM lookup",
    "scan_launch_csv": "SELECT name, launch FROM launches",
    "scan_histograms": "SELECT month, delta, count FROM histograms",
    "scan_deltas": "SELECT month, ifa, name, launch, first_seen, delta FROM monthly",
    "sink_datamart_parquet": _DATAMART,
    "sink_histogram_parquet": "SELECT delta, count, month FROM histograms",
    "sink_histogram_csv": """SELECT delta, CAST(sum(count) AS BIGINT) AS sum_count
         FROM histograms GROUP BY delta ORDER BY delta""",
    "sink_deltas_parquet": "SELECT ifa, name, launch, first_seen, delta, month FROM monthly",
    "project_columns": "SELECT ifa, device_model FROM profiles",
    "expand_struct": "SELECT ifa, platform, device_model FROM profiles",
    "explode_apps": "SELECT ifa, platform, device_model, first_seen FROM apps",
    "filter_platform": """SELECT ifa, platform, device_model FROM profiles
         WHERE lower(platform) LIKE 'android'""",
    "flatten_sightings": """SELECT ifa, platform, device_model, first_seen FROM apps
         WHERE lower(platform) LIKE 'android'""",
    "derive_date_parts": """SELECT ifa, first_seen, CAST(first_seen AS DATE) AS date,
         CAST(year(first_seen) AS INTEGER) AS year, CAST(month(first_seen) AS INTEGER) AS month
         FROM flat""",
    "rename_columns": "SELECT ifa, first_seen, brand, name FROM left_joined",
    "drop_columns": "SELECT ifa, first_seen, name FROM filled",
    "fill_not_detected": "SELECT ifa, first_seen, brand, name FROM filled",
    "enrich_device_left": "SELECT ifa, first_seen, brand, name FROM filled",
    "enrich_device": "SELECT ifa, first_seen, brand, name FROM filled WHERE brand = 'Brand#1'",
    "filter_brand": """SELECT ifa, first_seen, brand, name FROM filled
         WHERE brand = 'Not Detected'""",
    "launch_dimension": "SELECT name, launch FROM launches",
    "join_launch_inner": """SELECT ifa, first_seen, filled.name AS name, launch
         FROM filled JOIN launches ON filled.name = launches.name WHERE brand = 'Brand#1'""",
    "first_launched_device": "SELECT ifa, name, launch, first_seen, date FROM first_user",
    "first_device_stepwise": "SELECT ifa, name, launch, first_seen, date FROM first_user",
    "merge_first_device": "SELECT ifa, name, launch, first_seen, date FROM first_user",
    "first_launched_device_monthly": """SELECT month, ifa, name, launch, first_seen, date
         FROM first_month""",
    "launch_delta": "SELECT ifa, name, launch, first_seen, date, delta FROM deltas_all",
    "filter_nonnegative_delta": "SELECT ifa, name, launch, first_seen, date, delta FROM deltas",
    "deltas_large_lookup": "SELECT ifa, name, launch, first_seen, date, delta FROM deltas",
    "enrich_large_lookup": "SELECT ifa, first_seen, brand, name FROM filled WHERE brand = 'Brand#1'",
    "join_launch_large_lookup": """SELECT ifa, first_seen, filled.name AS name, launch
         FROM filled JOIN launches ON filled.name = launches.name WHERE brand = 'Brand#1'""",
    "delta_histogram": """SELECT delta, count(DISTINCT ifa) AS count FROM monthly
         GROUP BY delta ORDER BY delta""",
    "delta_row_histogram": "SELECT delta, count(ifa) AS count FROM monthly GROUP BY delta",
    "delta_histogram_monthly": "SELECT month, delta, count FROM histograms ORDER BY month, delta",
    "combine_histograms": """SELECT delta, CAST(sum(count) AS BIGINT) AS sum_count
         FROM histograms GROUP BY delta ORDER BY delta""",
    "derive_thresholds": "SELECT segment, lo, hi FROM derived",
    **{
        f"segment_{key}": _segment("deltas", *band)
        for key, band in zip(_BAND_KEYS, _MY, strict=True)
    },
    "label_segments": _labelled(_DATAMART),
    "segment_union": _DATAMART,
    "segment_datamart": _DATAMART,
    "segment_datamart_overlap": _union("deltas", _ID_AS_CODED),
    "segment_datamart_monthly": _union("monthly", _ID_DOCUMENTED),
    "segment_datamart_monthly_coded": _CODED,
    "segment_datamart_derived": _inside("deltas", "derived"),
    "segment_many_bands": """SELECT 'b' || p_partkey AS segment, count(*) AS n,
         min(delta) AS least, max(delta) AS most
       FROM part JOIN deltas ON delta BETWEEN p_partkey % 1000 AND p_partkey % 1000 + 30
       GROUP BY p_partkey""",
    "segment_audit": f"""SELECT segment, count(ifa) AS n_rows, count(DISTINCT ifa) AS n_users
         FROM ({_CODED}) GROUP BY segment""",
    "datamart_totals": f"""SELECT count(ifa) AS n_rows, count(DISTINCT ifa) AS n_users
         FROM ({_CODED})""",
    "distinct_users": f"SELECT DISTINCT ifa FROM ({_CODED})",
    "job_batch": _DATAMART,
    "job_rerun": _DATAMART,
    "job_losses": """, counted AS (
         SELECT lower(platform) <> 'android' AS other, device_model IN (
           SELECT model FROM lookup JOIN launches ON lookup.name = launches.name WHERE brand = 'Brand#1') AS ours
         FROM profiles
       )
       SELECT 'profiles' AS step, count(*) AS n FROM counted
       UNION ALL SELECT 'other_platform', count(*) FROM counted WHERE other
       UNION ALL SELECT 'no_app', 0
       UNION ALL SELECT 'unlaunched', count(*) FROM counted WHERE NOT other AND NOT ours
       UNION ALL SELECT 'launched', count(*) FROM counted WHERE NOT other AND ours
       UNION ALL SELECT 'users', count(*) FROM deltas_all
       UNION ALL SELECT 'undated', count(*) FROM deltas_all WHERE first_seen IS NULL
       UNION ALL SELECT 'unreadable', count(*) FROM deltas_all WHERE first_seen IS NOT NULL AND launch IS NULL
       UNION ALL SELECT 'negative', count(*) FROM deltas_all WHERE delta < 0
       UNION ALL SELECT 'kept', count(*) FROM deltas""",
    "job_incremental": _DATAMART,
    "job_monthly_report": """SELECT delta, CAST(sum(count) AS BIGINT) AS sum_count
         FROM histograms GROUP BY delta ORDER BY delta""",
    "job_monthly_segments": _CODED,
    "job_monthly_segments_derived": _inside("monthly", "derived_monthly"),
    "job_monthly_audit": f"""SELECT segment, count(ifa) AS n_rows, count(DISTINCT ifa) AS n_users
         FROM ({_CODED}) GROUP BY segment""",
    "job_distinct_histogram": "SELECT delta, count(DISTINCT ifa) AS count FROM monthly GROUP BY delta",
    "job_distinct_histogram_some": """SELECT delta, count(DISTINCT ifa) AS count FROM monthly
         WHERE month BETWEEN 199401 AND 199712 GROUP BY delta""",
    "preview_segment": f"SELECT * FROM ({_DATAMART}) ORDER BY delta, ifa LIMIT 5",
}

ORACLE_SQL: dict[str, str] = {key: _TABLES + select for key, select in _SELECTS.items()}
