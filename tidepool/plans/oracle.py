"""DuckDB SQL equal in result to each registered query (same column names).

Views ``events customer nation region orders …`` are the driver's tables.
Queries that only Spark can express (file listings, operation history) have
no entry here and get a rows-only check.
"""

from __future__ import annotations

# Shared CTEs (FIXTURES.md): sensor rows, cleaned rows, merge frames T and U.
SENSOR = """
sensor AS (
  SELECT event_id,
         md5(concat_ws('|', CAST(event_id AS VARCHAR), event_type)) AS Id,
         ts AS MeasurementDateTime,
         CASE WHEN event_id % 7 = 0 THEN NULL
              ELSE TRY_CAST(value AS DECIMAL(10,0)) END AS SensorValue,
         'unit' AS SensorUnitDescription,
         event_type AS SensorMeasurement,
         concat('loc_', CAST(user_id % 4 AS VARCHAR)) AS SensorLocation
  FROM events),
clean AS (SELECT * FROM sensor WHERE SensorValue IS NOT NULL),
t AS (SELECT * FROM clean WHERE event_id % 3 <> 1),
u AS (SELECT event_id, Id, MeasurementDateTime,
             CAST(SensorValue + 1 AS DECIMAL(10,0)) AS SensorValue,
             SensorUnitDescription, SensorMeasurement, SensorLocation
      FROM clean WHERE event_id % 2 = 0 OR event_id % 3 = 1)"""

RAW = SENSOR + """,
raw AS (
  SELECT event_id, CAST(NULL AS VARCHAR) AS Skip, CAST(NULL AS VARCHAR) AS SkipResult,
         '0' AS SkipTable,
         MeasurementDateTime - INTERVAL 1 HOUR AS WindowAverageStartDateTime,
         MeasurementDateTime AS WindowAverageStopDateTime,
         MeasurementDateTime, SensorValue, SensorUnitDescription,
         SensorMeasurement, SensorLocation, Id
  FROM sensor)"""

COLS = "Id, MeasurementDateTime, SensorValue, SensorUnitDescription, SensorMeasurement, SensorLocation"
BRONZE = ("WindowAverageStartDateTime, WindowAverageStopDateTime, MeasurementDateTime, "
          "SensorValue, SensorUnitDescription, SensorMeasurement, SensorLocation, Id")

ACCESS = """
membership AS (SELECT c_name AS member, c_mktsegment AS name FROM customer),
entities AS (
  SELECT 'Customer#000000000' AS entity, 'user' AS entity_type
  UNION
  SELECT name AS entity, 'group' AS entity_type FROM membership
  WHERE member = 'Customer#000000000'),
catalog_privileges AS (
  SELECT DISTINCT 'admin' AS grantor, c_mktsegment AS grantee, r_name AS catalog_name,
         'USE_CATALOG' AS privilege_type, 'NONE' AS inherited_from
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey
  WHERE (r_regionkey + length(c_mktsegment)) % 2 = 0),
schema_grants AS (
  SELECT 'admin' AS grantor, c_name AS grantee, r_name AS catalog_name,
         n_name AS schema_name, 'SELECT' AS privilege_type
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey),
schema_privileges AS (
  SELECT *, 'NONE' AS inherited_from FROM schema_grants
  UNION ALL
  SELECT g.grantor, g.grantee, g.catalog_name, n_name AS schema_name,
         g.privilege_type, 'CATALOG' AS inherited_from
  FROM catalog_privileges g JOIN region ON r_name = g.catalog_name
                            JOIN nation ON n_regionkey = r_regionkey),
tables AS (
  SELECT r_name AS table_catalog, n_name AS table_schema,
         'o_' || CAST(o_orderkey AS VARCHAR) AS table_name,
         c_name AS table_owner, o_orderdate AS last_altered, c_name AS last_altered_by,
         o_orderdate AS created, 'o/' || CAST(o_orderkey AS VARCHAR) AS storage_sub_directory
  FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey)"""

ORACLE: dict[str, str] = {}


def _key(*cols: str) -> str:
    """The content key: md5 of one JSON object; times with microseconds."""
    parts = []
    for c in cols:
        value = f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%f')" if c == "MeasurementDateTime" else c
        quoted = f"CAST({c} AS VARCHAR)" if c == "SensorValue" else f"'\"' || {value} || '\"'"
        parts.append(f"'\"{c}\":' || COALESCE({quoted}, 'null')")
    return "md5('{' || " + " || ',' || ".join(parts) + " || '}')"

ORACLE["scan_all"] = "SELECT * FROM events"

ORACLE["sensor_schema_cast"] = """
WITH txt AS (
  SELECT event_id,
         CASE WHEN event_id % 9 = 0 THEN 'not a time' ELSE CAST(ts AS VARCHAR) END
           AS MeasurementDateTime,
         CASE WHEN event_id % 5 = 0 THEN replace(CAST(ts AS VARCHAR), ' ', '')
              ELSE CAST(ts AS VARCHAR) END AS WindowAverageStopDateTime,
         CASE WHEN event_id % 13 = 0 THEN 'abc'
              WHEN event_id % 17 = 0 THEN '99999999999'
              ELSE CAST(value AS VARCHAR) END AS SensorValue,
         event_type AS SensorMeasurement,
         CASE WHEN event_id % 6 = 0 THEN CAST(CAST(ts AS DATE) AS VARCHAR) ELSE CAST(ts AS VARCHAR) END
           AS WindowAverageStartDateTime,
         'loc_' || CAST(user_id % 4 AS VARCHAR) AS SensorLocation
  FROM events)
SELECT event_id, '' AS Skip, SensorMeasurement AS SkipResult, '0' AS SkipTable,
       'unit' AS SensorUnitDescription, SensorLocation, CAST(event_id AS VARCHAR) AS Id,
       TRY_CAST(WindowAverageStartDateTime AS TIMESTAMP) AS WindowAverageStartDateTime,
       TRY_CAST(MeasurementDateTime AS TIMESTAMP) AS MeasurementDateTime,
       TRY_CAST(WindowAverageStopDateTime AS TIMESTAMP) AS WindowAverageStopDateTime,
       TRY_CAST(SensorValue AS DECIMAL(10,0)) AS SensorValue,
       SensorMeasurement
FROM txt"""

ORACLE["filter_not_null"] = f"WITH {SENSOR} SELECT {COLS} FROM sensor WHERE SensorValue IS NOT NULL"

ORACLE["drop_columns"] = f"WITH {RAW} SELECT {BRONZE} FROM raw"

ORACLE["clean_raw"] = f"WITH {RAW} SELECT {BRONZE} FROM raw WHERE SensorValue IS NOT NULL"

ORACLE["assign_id"] = f"""
WITH {SENSOR}
SELECT event_id,
       {_key("MeasurementDateTime", "SensorValue", "SensorMeasurement", "SensorLocation")} AS Id
FROM sensor"""

ORACLE["file_provenance"] = "SELECT event_id, 'events.parquet' AS InputFileName FROM events"

ORACLE["project_to_target"] = f"""
WITH {RAW}
SELECT MeasurementDateTime, SensorValue, SensorUnitDescription, SensorMeasurement,
       SensorLocation, Id, 'events.parquet' AS InputFileName
FROM raw WHERE SensorValue IS NOT NULL"""

ORACLE["filter_partition_eq"] = f"""
WITH {SENSOR} SELECT {COLS} FROM clean
WHERE SensorMeasurement = 'view' AND SensorLocation = 'loc_1'"""

ORACLE["count_rows"] = f"WITH {SENSOR} SELECT COUNT(0) AS row_count FROM clean"

ORACLE["merge_insert_only"] = f"""
WITH {SENSOR}
SELECT {COLS} FROM t
UNION ALL
SELECT {COLS} FROM u WHERE Id NOT IN (SELECT Id FROM t)"""

ORACLE["merge_upsert"] = f"""
WITH {SENSOR}
SELECT {COLS} FROM u
UNION ALL
SELECT {COLS} FROM t WHERE Id NOT IN (SELECT Id FROM u)"""

ORACLE["incremental_by_max_ts"] = f"""
WITH {SENSOR}
SELECT {COLS} FROM clean
WHERE MeasurementDateTime >= (SELECT MAX(MeasurementDateTime) FROM clean
                              WHERE MeasurementDateTime < TIMESTAMP '2024-01-15 00:00:00')"""

ORACLE["delete_where"] = f"""
WITH {SENSOR} SELECT {COLS} FROM sensor WHERE NOT COALESCE(SensorValue > 20, FALSE)"""

ORACLE["replace_where"] = f"""
WITH {SENSOR}
SELECT {COLS} FROM clean
WHERE NOT (SensorMeasurement = 'view' AND SensorLocation = 'loc_1')
UNION ALL
SELECT {COLS} FROM u WHERE SensorMeasurement = 'view' AND SensorLocation = 'loc_1'"""

ORACLE["expire_rows"] = f"""
WITH {SENSOR} SELECT {COLS} FROM clean
WHERE NOT (MeasurementDateTime <= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 10 DAYS)"""

ORACLE["assign_identity"] = f"""
WITH {SENSOR}
SELECT row_number() OVER (ORDER BY event_id) AS seq_id, event_id, {COLS} FROM clean"""

ORACLE["insert_defaults"] = """
SELECT row_number() OVER (ORDER BY c_custkey % 4 = 0, c_custkey) AS id, c_name AS name,
       CASE WHEN c_custkey % 4 <> 0 THEN 'none' END AS description,
       TIMESTAMP '2024-02-01 00:00:00' AS insert_timestamp
FROM customer"""

_THREE_INSERTS = """
SELECT row_number() OVER (ORDER BY c_custkey % 3, c_custkey) AS id,
       CASE WHEN c_custkey % 3 = 1 THEN 'noname' ELSE c_name END AS name,
       CASE WHEN c_custkey % 3 < 2 THEN c_mktsegment {omitted} END AS description, {time}
FROM customer"""
ORACLE["insert_partial"] = _THREE_INSERTS.format(
    omitted="", time="TIMESTAMP '2024-02-01 00:00:00' AS insert_timestamp")
ORACLE["insert_sequence"] = _THREE_INSERTS.format(omitted="ELSE 'none'", time="TRUE AS has_time")

ORACLE["change_feed"] = f"""
WITH {SENSOR},
b AS (SELECT {COLS} FROM t),
a AS (
  SELECT Id, MeasurementDateTime,
         CASE WHEN event_id % 2 = 0 THEN CAST(SensorValue + 1 AS DECIMAL(10,0))
              ELSE SensorValue END AS SensorValue,
         SensorUnitDescription, SensorMeasurement, SensorLocation
  FROM t WHERE event_id % 5 <> 0
  UNION ALL
  SELECT {COLS} FROM u WHERE event_id % 3 = 1),
upd AS (
  SELECT b.Id FROM b JOIN a ON a.Id = b.Id
  WHERE a.MeasurementDateTime IS DISTINCT FROM b.MeasurementDateTime
     OR a.SensorValue IS DISTINCT FROM b.SensorValue
     OR a.SensorUnitDescription IS DISTINCT FROM b.SensorUnitDescription
     OR a.SensorMeasurement IS DISTINCT FROM b.SensorMeasurement
     OR a.SensorLocation IS DISTINCT FROM b.SensorLocation)
SELECT {COLS}, 'insert' AS _change_type FROM a WHERE Id NOT IN (SELECT Id FROM b)
UNION ALL
SELECT {COLS}, 'delete' AS _change_type FROM b WHERE Id NOT IN (SELECT Id FROM a)
UNION ALL
SELECT {COLS}, 'update_preimage' AS _change_type FROM b WHERE Id IN (SELECT Id FROM upd)
UNION ALL
SELECT {COLS}, 'update_postimage' AS _change_type FROM a WHERE Id IN (SELECT Id FROM upd)"""

ORACLE["evolve_append"] = f"""
WITH {SENSOR}
SELECT Id, MeasurementDateTime, SensorValue, CAST(NULL AS VARCHAR) AS SensorUnitDescription,
       SensorMeasurement, SensorLocation FROM t
UNION ALL
SELECT {COLS} FROM u"""

ORACLE["groups_of_user"] = f"""
WITH {ACCESS} SELECT name FROM membership WHERE member = 'Customer#000000000'"""

ORACLE["entity_closure"] = f"WITH {ACCESS} SELECT * FROM entities"

# Reports: the entity set holds each entity once, so membership in it is the join.
ORACLE["catalog_access"] = f"""
WITH {ACCESS}
SELECT entities.*, held.* FROM entities JOIN catalog_privileges AS held ON held.grantee = entity"""

ORACLE["schema_access_explicit"] = f"""
WITH {ACCESS}
SELECT privilege_type, grantor, schema_name, catalog_name FROM schema_privileges
WHERE grantee IN (SELECT entity FROM entities)
  AND schema_name <> 'information_schema' AND inherited_from = 'NONE'"""

ORACLE["schema_access_inherited"] = f"""
WITH {ACCESS}
SELECT entity AS EntityInheritedFrom, entity_type, held.* EXCLUDE (grantee)
FROM entities JOIN schema_privileges AS held ON held.grantee = entity
WHERE inherited_from <> 'NONE' AND schema_name <> 'information_schema'"""

ORACLE["table_access"] = f"""
WITH {ACCESS},
held AS (SELECT * FROM schema_privileges JOIN entities ON grantee = entity)
SELECT held.* EXCLUDE (inherited_from), table_name,
       CASE inherited_from WHEN 'NONE' THEN 'SCHEMA' ELSE inherited_from END AS inherited_from
FROM held JOIN tables ON table_catalog = catalog_name AND table_schema = schema_name"""

ORACLE["owned_tables"] = f"""
WITH {ACCESS}
SELECT * EXCLUDE (table_owner) FROM tables WHERE table_owner IN (SELECT entity FROM entities)"""

ORACLE["stale_tables"] = f"""
{ORACLE["owned_tables"]} AND last_altered + INTERVAL 30 DAYS <= TIMESTAMP '1998-08-01 00:00:00'"""

ORACLE["expand_privileges"] = f"WITH {ACCESS} SELECT * FROM schema_privileges"

# --- tables written by Spark ---------------------------------------------

_CLEAN = f"WITH {SENSOR} SELECT {COLS} FROM clean"
for _k in ("ctas_copy", "ctas_partitioned", "shallow_snapshot", "deep_copy",
           "cluster_by_time", "stream_table_read"):
    ORACLE[_k] = _CLEAN

_TOMBSTONED = f"WITH {SENSOR} SELECT {COLS} FROM clean WHERE NOT (event_id % 11 = 0)"
ORACLE["soft_delete_read"] = _TOMBSTONED
ORACLE["purge_partitions"] = _TOMBSTONED
ORACLE["table_like"] = _TOMBSTONED

ORACLE["soft_delete_reinsert"] = f"""
WITH {SENSOR}
SELECT Id, MeasurementDateTime,
       CASE WHEN event_id % 11 = 0 THEN CAST(SensorValue + 1 AS DECIMAL(10,0)) ELSE SensorValue END AS SensorValue,
       SensorUnitDescription, SensorMeasurement, SensorLocation FROM clean"""

ORACLE["soft_delete_null_partition"] = f"""
WITH {SENSOR} SELECT {COLS} FROM sensor
WHERE event_id % 11 <> 0 AND NOT (SensorValue IS NULL AND event_id % 2 = 0)"""

ORACLE["replace_from_itself"] = f"WITH {SENSOR} SELECT {COLS} FROM clean WHERE event_id % 3 = 0"
ORACLE["table_upsert"] = ORACLE["merge_upsert"]
ORACLE["table_delete_hard"] = f"WITH {SENSOR} SELECT {COLS} FROM clean WHERE NOT (SensorValue > 20)"

ORACLE["table_changes_since"] = f"""
WITH {SENSOR},
v AS (SELECT * FROM u WHERE event_id % 5 <> 0)
SELECT {COLS}, CASE WHEN event_id % 5 = 0 THEN 'delete' ELSE 'update_preimage' END AS _change_type
FROM t WHERE event_id % 5 = 0 OR Id IN (SELECT Id FROM v)
UNION ALL
SELECT {COLS}, CASE WHEN Id IN (SELECT Id FROM t) THEN 'update_postimage' ELSE 'insert' END FROM v"""

ORACLE["table_files"] = f"""
WITH {SENSOR}
SELECT SensorLocation, SensorMeasurement, COUNT(*) AS num_rows, TRUE AS same_bytes
FROM clean GROUP BY ALL"""

ORACLE["table_detail"] = f"""
WITH {SENSOR}
SELECT SensorLocation, SensorMeasurement, COUNT(*) AS num_rows
FROM clean GROUP BY SensorLocation, SensorMeasurement"""

ORACLE["stream_merge_silver"] = ORACLE["merge_insert_only"]

# Streams: the ingest key is the md5 of the measurement content.
_INGEST_KEY = _key("MeasurementDateTime", "SensorValue", "SensorUnitDescription",
                   "SensorMeasurement", "SensorLocation")

ORACLE["stream_csv_ingest"] = f"""
WITH {RAW}
SELECT WindowAverageStartDateTime, WindowAverageStopDateTime, MeasurementDateTime,
       SensorValue, SensorUnitDescription, SensorMeasurement, SensorLocation,
       {_INGEST_KEY} AS Id, TRUE AS from_feed
FROM raw WHERE SensorValue IS NOT NULL"""
ORACLE["stream_rerun_noop"] = ORACLE["stream_csv_ingest"]

ORACLE["stream_replay_idempotent"] = f"""
WITH {RAW}
SELECT MeasurementDateTime, SensorValue, SensorUnitDescription, SensorMeasurement,
       SensorLocation, {_INGEST_KEY} AS Id, TRUE AS from_feed
FROM raw WHERE SensorValue IS NOT NULL"""

ORACLE["stream_repeated_readings"] = f"""
WITH {RAW}
SELECT DISTINCT MeasurementDateTime, SensorValue, SensorUnitDescription, SensorMeasurement,
       SensorLocation, {_INGEST_KEY} AS Id, files_per_trigger
FROM raw, (VALUES (1), (2), (0)) AS runs(files_per_trigger) WHERE SensorValue IS NOT NULL"""

# Operation history: each version's row metric, computed from the data.
# v1 soft-deletes event_id % 11 = 0; v2 replaces partition (loc_1, view) with
# U's rows there (its tombstones go with it); v3 purges the other loc_1
# partitions holding tombstones; v4 rewrites every visible row.
ORACLE["operation_history"] = f"""
WITH {SENSOR},
tomb AS (SELECT * FROM clean WHERE event_id % 11 = 0),
newp AS (SELECT * FROM u WHERE SensorMeasurement = 'view' AND SensorLocation = 'loc_1'),
purged AS (SELECT DISTINCT SensorMeasurement FROM tomb
           WHERE SensorLocation = 'loc_1' AND SensorMeasurement <> 'view')
SELECT CAST(0 AS BIGINT) AS version, 'CREATE TABLE AS SELECT' AS operation,
       (SELECT COUNT(*) FROM clean) AS num_rows
UNION ALL
SELECT CAST(1 AS BIGINT), 'DELETE', (SELECT COUNT(*) FROM tomb)
UNION ALL
SELECT CAST(2 AS BIGINT), 'WRITE', (SELECT COUNT(*) FROM newp)
UNION ALL
SELECT CAST(3 AS BIGINT), 'REORG',
       (SELECT COUNT(*) FROM clean WHERE SensorLocation = 'loc_1' AND event_id % 11 <> 0
          AND SensorMeasurement IN (SELECT SensorMeasurement FROM purged))
UNION ALL
SELECT CAST(4 AS BIGINT), 'OPTIMIZE',
       (SELECT COUNT(*) FROM clean WHERE event_id % 11 <> 0
          AND NOT (SensorMeasurement = 'view' AND SensorLocation = 'loc_1'))
       + (SELECT COUNT(*) FROM newp)"""

# --- tables by name -------------------------------------------------------

ORACLE["catalog_migrate"] = f"WITH {SENSOR} SELECT {COLS}, TRUE AS marked FROM clean"
ORACLE["ctas_location"] = _CLEAN
ORACLE["table_like_location"] = _CLEAN
ORACLE["stream_merge_sql"] = ORACLE["stream_merge_silver"]
ORACLE["stream_interval"] = ORACLE["stream_csv_ingest"]
ORACLE["feed_inventory"] = "SELECT COUNT(*) AS num_rows, TRUE AS same_files, TRUE AS same_bytes FROM events"

ORACLE["table_properties"] = """
WITH about AS (SELECT event_type AS table_name, COUNT(*) AS n, CAST(MAX(ts) AS DATE) AS newest FROM events GROUP BY ALL)
SELECT table_name, 'quality' AS key, 'gold' AS value FROM about
UNION ALL SELECT table_name, 'rows', CAST(n AS VARCHAR) FROM about
UNION ALL SELECT table_name, 'newest', CAST(newest AS VARCHAR) FROM about"""

ORACLE["owned_tables_catalog"] = f"""
WITH {ACCESS}
SELECT 'spark_catalog' AS table_catalog, lower(replace(r_name, ' ', '_')) AS table_schema, lower(c_mktsegment) AS table_name,
       MAX(o_orderdate) AS last_altered, c_mktsegment AS last_altered_by,
       'regionkey=' || r_regionkey || '/segment=' || c_mktsegment AS storage_sub_directory, TRUE AS has_created
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE c_mktsegment IN (SELECT entity FROM entities)
GROUP BY r_name, r_regionkey, c_mktsegment"""

ORACLE["database_listing"] = """
SELECT lower(replace(r_name, ' ', '_')) AS database_name, lower(replace(n_name, ' ', '_')) AS table_name, COUNT(c_custkey) AS num_rows
FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey
WHERE r_regionkey % 2 = 0 AND r_regionkey > (SELECT MIN(r_regionkey) FROM region)
GROUP BY r_name, n_name"""

ORACLE["insert_sql_defaults"] = """
SELECT row_number() OVER (ORDER BY c_custkey % 4, c_custkey) AS id,
       CASE c_custkey % 4 WHEN 1 THEN 'noname' ELSE c_name END AS name,
       CASE c_custkey % 4 WHEN 2 THEN NULL WHEN 3 THEN 'none' ELSE c_mktsegment END AS description, TRUE AS has_time
FROM customer"""

ORACLE["delete_by_key"] = _TOMBSTONED
ORACLE["purge_by_key"] = f"""
{_TOMBSTONED} AND NOT (SensorMeasurement = 'view' AND SensorLocation = 'loc_1')"""
ORACLE["operation_log"] = f"""
WITH {SENSOR},
tomb AS (SELECT * FROM clean WHERE event_id % 11 = 0)
SELECT CAST(0 AS BIGINT) AS version, 'CREATE TABLE AS SELECT' AS operation, (SELECT COUNT(*) FROM clean) AS num_rows
UNION ALL SELECT CAST(1 AS BIGINT), 'DELETE', (SELECT COUNT(*) FROM tomb)
UNION ALL SELECT CAST(2 AS BIGINT), 'REORG', (SELECT COUNT(*) FROM clean WHERE SensorLocation = 'loc_1' AND event_id % 11 <> 0
    AND SensorMeasurement IN (SELECT SensorMeasurement FROM tomb WHERE SensorLocation = 'loc_1'))
UNION ALL SELECT CAST(3 AS BIGINT), 'DELETE', (SELECT COUNT(*) FROM clean WHERE event_id % 11 <> 0 AND SensorValue > 20)"""
