"""DuckDB oracle texts.  Each entry is a complete statement over the raw tables; the fixture
views are inlined as leading CTEs so the oracle shares no code with the Spark side."""

from __future__ import annotations

SEGMENTS = """segments AS (
WITH h AS (SELECT count(*) AS n FROM supplier),
leg AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, l.l_discount, l.l_tax, l.l_returnflag, l.l_shipdate,
         o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_orderpriority,
         l.l_suppkey AS src,
         CASE WHEN l.l_quantity >= 50 AND l.l_discount >= 0.095 THEN o.o_custkey % h.n
              ELSE (l.l_suppkey + 1 + l.l_partkey % 5) % h.n END AS dst,
         CAST(floor(l.l_quantity * 0.75) AS DOUBLE) AS seg_osrm,
         CASE WHEN l.l_partkey % 211 = 0 THEN CAST(-1 AS DOUBLE)
              ELSE CAST(floor(l.l_quantity * 0.75) + floor(l.l_quantity * l.l_discount * 10 + 0.5) + l.l_suppkey % 7 AS DOUBLE) END AS seg_act
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey CROSS JOIN h)
SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'test' ELSE 'training' END AS data,
  'trip-' || CAST(o_orderkey AS STRING) AS trip_uuid,
  'rs-' || CAST(o_custkey % 97 AS STRING) AS route_schedule_uuid,
  CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'FTL' ELSE 'Carting' END AS route_type,
  CASE WHEN l_partkey % 503 = 0 THEN NULL ELSE 'H' || lpad(CAST(src AS STRING), 6, '0') END AS source_center,
  'H' || lpad(CAST(dst AS STRING), 6, '0') AS destination_center,
  'Hub ' || CAST(src AS STRING) AS source_name, 'Hub ' || CAST(dst AS STRING) AS destination_name,
  o_orderdate + INTERVAL '1' HOUR * CAST((o_orderkey * 7) % 24 AS INT) AS trip_creation_time,
  l_shipdate AS od_start_time,
  l_shipdate + INTERVAL '1' MINUTE * CAST(greatest(seg_act, 0) AS INT) AS od_end_time,
  l_shipdate + INTERVAL '1' MINUTE * CAST(seg_osrm AS INT) AS cutoff_timestamp,
  sum(seg_act) OVER (PARTITION BY o_orderkey) AS actual_time,
  sum(seg_osrm) OVER (PARTITION BY o_orderkey) AS osrm_time,
  seg_act AS segment_actual_time, seg_osrm AS segment_osrm_time,
  sum(l_quantity) OVER (PARTITION BY o_orderkey) * 1.1 AS actual_distance_to_destination,
  sum(l_quantity) OVER (PARTITION BY o_orderkey) AS osrm_distance,
  l_quantity AS segment_osrm_distance,
  sum(seg_act) OVER (PARTITION BY o_orderkey) / nullif(sum(seg_osrm) OVER (PARTITION BY o_orderkey), 0) AS factor,
  seg_act / nullif(seg_osrm, 0) AS segment_factor,
  l_returnflag = 'R' AS is_cutoff, CAST(l_linenumber AS INT) AS cutoff_factor,
  'seg-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(src AS STRING) || '-' || CAST(l_shipdate AS STRING) AS segment_key
FROM leg)"""

# raw segments + derived ratios, lane and calendar parts (the EDA notebook frame)
RAW = """raw AS (SELECT *, actual_time / nullif(osrm_time, 0) AS delay_ratio,
  segment_actual_time / nullif(segment_osrm_time, 0) AS segment_delay_ratio,
  source_center || ' → ' || destination_center AS route_lane,
  CAST(hour(trip_creation_time) AS INT) AS trip_hour, CAST(isodow(trip_creation_time) - 1 AS INT) AS trip_dayofweek,
  dayname(trip_creation_time) AS trip_day_name FROM segments)"""

CLEAN = """clean AS (SELECT * FROM raw WHERE segment_actual_time >= 0 AND actual_time >= 0
  AND segment_osrm_time > 0 AND osrm_time > 0 AND source_center IS NOT NULL AND destination_center IS NOT NULL)"""

# lane edge table (processed segments grouped by directed hub pair)
EDGES = """edges AS (SELECT source_center, destination_center, count(route_lane) AS weight,
  avg(segment_delay_ratio) AS avg_delay FROM clean GROUP BY source_center, destination_center)"""

SCORED = """hubt AS (SELECT hub_id, CAST(sum(w) AS DOUBLE) AS traffic FROM
  (SELECT source_center AS hub_id, count(*) AS w FROM clean GROUP BY source_center
   UNION ALL SELECT destination_center, count(*) FROM clean GROUP BY destination_center) u GROUP BY hub_id),
hubm AS (SELECT min(traffic) AS lo, max(traffic) AS hi FROM hubt),
hub AS (SELECT hub_id, (traffic - lo) / (hi - lo + 1e-9) AS score, CAST(substr(hub_id, 2) AS INT) % 4 AS community FROM hubt CROSS JOIN hubm),
one AS (SELECT *, row_number() OVER (PARTITION BY trip_uuid ORDER BY segment_key) AS rn FROM clean),
scored AS (SELECT o.trip_uuid, o.source_center || ' → ' || o.destination_center AS route_lane, o.source_center, o.destination_center, o.route_type,
  CAST(hour(o.trip_creation_time) AS INT) AS trip_hour, o.osrm_time, o.actual_time,
  s.score AS source_bottleneck_score, d.score AS destination_bottleneck_score,
  s.community AS source_community, d.community AS destination_community,
  o.osrm_time * (1.1 + 0.8 * d.score) + 5 AS predicted_eta, o.trip_creation_time
FROM (SELECT * FROM one WHERE rn = 1) o
LEFT JOIN hub s ON o.source_center = s.hub_id LEFT JOIN hub d ON o.destination_center = d.hub_id)"""


def with_ctes(body: str, *extra: str, scored: bool = False) -> str:
    ctes = [SEGMENTS, RAW, CLEAN] + ([SCORED] if scored else []) + list(extra)
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body


ORACLE: dict[str, str] = {}


def oracle(key: str, body: str, *extra: str, scored: bool = False) -> None:
    ORACLE[key] = with_ctes(body, *extra, scored=scored)


# stand-in wide hub table (see fixtures.hub_table)
HUBS = """hubs AS (SELECT t.hub_id, t.tv / sum(t.tv) OVER () AS pagerank, dg.degree_centrality,
  (t.tv - min(t.tv) OVER ()) / (max(t.tv) OVER () - min(t.tv) OVER () + 1e-9) AS bottleneck_score,
  CAST(substr(t.hub_id, 2) AS INT) % 4 AS community_id
  FROM (SELECT hub_id, sum(w) AS tv FROM (SELECT source_center AS hub_id, count(*) AS w FROM clean GROUP BY 1
        UNION ALL SELECT destination_center, count(*) FROM clean GROUP BY 1) GROUP BY hub_id) t
  JOIN (SELECT hub_id, count(*) / ((SELECT count(*) FROM (SELECT source_center FROM clean UNION SELECT destination_center FROM clean)) - 1)
        AS degree_centrality FROM (SELECT source_center AS hub_id FROM (SELECT DISTINCT source_center, destination_center FROM clean)
        UNION ALL SELECT destination_center FROM (SELECT DISTINCT source_center, destination_center FROM clean)) GROUP BY hub_id) dg
  ON dg.hub_id = t.hub_id)"""

# risk columns on the scored view (residual std unknown -> 30.0)
RISK = """sr AS (SELECT *, greatest(coalesce(source_bottleneck_score, 0), coalesce(destination_bottleneck_score, 0)) AS mbn,
  coalesce(predicted_eta / nullif(osrm_time, 0), 1.0) AS eta_vs_osrm_ratio FROM scored),
risk AS (SELECT *, predicted_eta - 1.28 * 30.0 AS confidence_low, predicted_eta + 1.28 * 30.0 AS confidence_high,
  mbn >= 0.35 AS bottleneck_warning,
  CASE WHEN pts >= 4 THEN 'CRITICAL' WHEN pts >= 3 THEN 'HIGH' WHEN pts >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  CASE WHEN mbn >= 0.35 AND eta_vs_osrm_ratio >= 1.5
       THEN 'Touches high-bottleneck hub; expect elevated dwell risk. Predicted ETA materially above OSRM baseline.'
       WHEN mbn >= 0.35 THEN 'Touches high-bottleneck hub; expect elevated dwell risk.'
       WHEN eta_vs_osrm_ratio >= 1.5 THEN 'Predicted ETA materially above OSRM baseline.'
       ELSE 'Within normal network operating envelope.' END AS route_insights
  FROM (SELECT *, (CASE WHEN mbn >= 0.75 THEN 3 WHEN mbn >= 0.55 THEN 2 WHEN mbn >= 0.35 THEN 1 ELSE 0 END)
    + (CASE WHEN eta_vs_osrm_ratio >= 1.8 THEN 2 WHEN eta_vs_osrm_ratio >= 1.4 THEN 1 ELSE 0 END) AS pts FROM sr))"""
