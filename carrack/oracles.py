"""The registered queries in plain SQL over the same tables."""

from __future__ import annotations

_VERSIONS = """
WITH src AS (
  SELECT o_orderkey, o_custkey + CASE WHEN o_orderkey % 7 = 0 THEN 1000 ELSE 0 END AS o_custkey,
         o_orderstatus, o_orderkey % 10 AS cv,
         CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey % 10 + 3
              WHEN o_orderkey % 11 = 0 THEN 0
              ELSE o_orderkey % 10 END AS mv
  FROM orders),
tgt AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderkey % 10 AS cv, o_orderkey % 10 AS mv
  FROM orders WHERE o_orderkey % 10 <= 6),
wm AS (
  SELECT coalesce(max(cv), -1) AS c, coalesce(max(mv), -1) AS m
  FROM tgt WHERE o_orderstatus IN ('O', 'F')),
delta AS (
  SELECT src.* FROM src, wm WHERE (cv > c OR mv > m) AND o_orderstatus IN ('O', 'F')),
chg AS (
  SELECT DISTINCT o_orderkey FROM src, wm WHERE mv > m AND o_orderstatus IN ('O', 'F')),
kept AS (
  SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM chg WHERE chg.o_orderkey = tgt.o_orderkey))
"""

_TYPED = """
SELECT l_orderkey AS "OrderKey", CAST(l_linenumber AS BIGINT) AS "LineNo",
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS "Price", l_returnflag AS "Flag",
       l_linestatus = 'O' AS "IsOpen", l_shipdate AS "Shipped", CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS "ShipDay",
       (2 * l_linenumber - 9) || '.' || repeat('0', 29) || '1' AS "Wide", hex(l_returnflag) AS "Raw"
"""

_SHARDS = """
WITH line AS (
  SELECT c_custkey AS k, CAST(c_custkey % 3 AS INTEGER) AS shard, c_custkey // 3000000 AS piece,
         c_custkey || ',' || c_name || ',' || c_nationkey || ',' || c_mktsegment AS line
  FROM customer
  UNION ALL
  SELECT k, shard, piece, line
  FROM (VALUES (-3, 'c_custkey,c_name,c_nationkey,c_mktsegment'), (-2, ''), (-1, '  ' || chr(9))) AS head(k, line),
       (VALUES (0), (1), (2)) AS shards(shard),
       (SELECT unnest(range(0, (SELECT max(c_custkey) // 3000000 + 1 FROM customer))) AS piece) AS pieces),
physical AS (
  SELECT shard, piece, line, k,
         'cust_' || shard || '_' || lpad(CAST(piece AS VARCHAR), 9, '0') ||
         CASE shard WHEN 0 THEN '_sys_src_AAAA.csv.gz'
                    WHEN 1 THEN '_sys_src_BBBB.csv.bz2'
                    ELSE '_plain.csv' END AS file_name,
         CASE shard WHEN 0 THEN 'AAAA' WHEN 1 THEN 'BBBB' ELSE '' END AS tag,
         row_number() OVER (PARTITION BY shard, piece ORDER BY k) - 1 AS line_no
  FROM line),
filled AS (
  SELECT *, row_number() OVER (ORDER BY shard, piece, k) - 1 AS n FROM physical WHERE k >= 0),
header AS (
  SELECT * FROM physical WHERE shard = 0 AND piece = 0 AND line_no = 0)
"""

_PRICES = "SELECT l_orderkey AS order_key, l_linenumber AS line_no, l_shipdate AS shipped FROM lineitem"


def _statement_counts() -> str:
    from .registry import STATEMENTS

    rows = []
    for number, text in enumerate(STATEMENTS, start=1):
        quoted = text.replace("'", "''")
        rows.append(
            f"SELECT 'BCP_{number:02d}' AS \"BCPPackage\", (SELECT count(*) FROM ({text}) AS s) AS \"NumRecords\", "
            f"false AS \"HasError\", '{quoted}' AS \"SQLStatement\", '' AS \"ProcessingError\""
        )
    failing = "SELECT c_custkey, c_name, CAST(raise_error(''bad row'') AS INT) FROM customer"
    rows.append(f"SELECT 'BCP_{len(STATEMENTS) + 1:02d}', 0, true, '{failing}', 'failed'")
    return " UNION ALL ".join(rows)


def _statements() -> str:
    from .registry import STATEMENTS

    first, second, third = STATEMENTS
    return f"""{first} AND c_name <> 'it''s; not a name' UNION ALL {second} AND c_name <> 'a ; b' UNION ALL {third}"""


ORACLES: dict[str, str] = {
    "slice_scan": _VERSIONS + "SELECT o_orderkey, cv, mv FROM src WHERE o_orderstatus IN ('O', 'F')",
    "version_watermark": _VERSIONS
    + """
SELECT 'source' AS side, coalesce(max(cv), 0) AS created, coalesce(max(mv), 0) AS modified
FROM src WHERE o_orderstatus IN ('O', 'F')
UNION ALL SELECT 'target', c, m FROM wm""",
    "delta_rows": _VERSIONS + "SELECT * FROM delta",
    "changed_keys": _VERSIONS + "SELECT o_orderkey FROM chg",
    "delete_by_keys": _VERSIONS + "SELECT * FROM kept",
    "sync_dataset": _VERSIONS + "SELECT * FROM kept UNION ALL SELECT * FROM delta",
    "stream_table": _VERSIONS + "SELECT * FROM kept UNION ALL SELECT * FROM delta",
    "reconcile": _VERSIONS
    + """
SELECT o_orderkey AS key, CASE WHEN t.n IS NULL THEN 'missing' WHEN s.n IS NULL THEN 'extra' ELSE 'changed' END AS status,
       coalesce(s.n, 0) AS n_source, coalesce(t.n, 0) AS n_target
FROM (SELECT o_orderkey, count(*) AS n, list((o_custkey, o_orderstatus, cv, mv) ORDER BY o_custkey, o_orderstatus, cv, mv) AS rows
      FROM src GROUP BY o_orderkey) s
FULL JOIN (SELECT o_orderkey, count(*) AS n, list((o_custkey, o_orderstatus, cv, mv) ORDER BY o_custkey, o_orderstatus, cv, mv) AS rows
      FROM tgt GROUP BY o_orderkey) t USING (o_orderkey)
WHERE s.rows IS DISTINCT FROM t.rows""",
    "sync_summary": _VERSIONS
    + """
SELECT (SELECT count(*) FROM tgt) - (SELECT count(*) FROM kept) AS deleted,
       (SELECT count(*) FROM delta) AS inserted,
       (SELECT count(*) FROM kept) AS unchanged,
       (SELECT count(*) FROM kept) + (SELECT count(*) FROM delta) AS final""",
    "insert_missing": _VERSIONS
    + """
SELECT * FROM tgt
UNION ALL
SELECT * FROM src WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.o_orderkey = src.o_orderkey)""",
    "staged_publish": _VERSIONS + "SELECT * FROM kept UNION ALL SELECT * FROM delta",
    "typed_projection": _TYPED + "FROM lineitem",
    "typed_default": _TYPED.replace('l_shipdate AS "Shipped"', 'CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS "Shipped"')
    + ', l_quantity AS "Qty" FROM lineitem',
    "sync_schema": _TYPED + ', CAST(year(l_shipdate) AS INTEGER) AS "ShipYear" FROM lineitem',
    "statement_union": _statements(),
    "statement_report": _statement_counts(),
    "ordinal_map": """
SELECT CAST(NULL AS BIGINT) AS row_id, s_suppkey AS id, s_name AS name, s_nationkey AS nation FROM supplier""",
    "append_table": """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer
UNION ALL
SELECT c_custkey, c_name, c_nationkey FROM customer""",
    "split_load": _PRICES,
    "split_load_report": """
SELECT 'BCP lineitem_copy : l_returnflag = ' || l_returnflag AS "BCPPackage", count(*) AS "NumRecords",
       false AS "HasError", 'l_returnflag' AS "BCPSplitOnValueOfField", l_returnflag AS "BCPSplitOnValue",
       '' AS "ProcessingError"
FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT 'BCP lineitem_copy : BCP_02', 0, true, 'l_returnflag', '', 'failed'
UNION ALL SELECT 'BCP lineitem_copy : BCP_03', 0, true, 'l_returnflag', '', 'failed'""",
    "shard_scan": _SHARDS + "SELECT file_name, line FROM physical",
    "shard_encodings": """
SELECT 'cust_' || lpad(CAST(c_custkey // 100000 AS VARCHAR), 6, '0') || '_' ||
       ['utf16le.txt', 'utf16be.csv', 'utf32le.txt', 'lzw.csv.Z', 'members.csv.gz'][c_custkey % 5 + 1] AS file_name,
       row_number() OVER (PARTITION BY c_custkey // 100000, c_custkey % 5 ORDER BY c_custkey) - 1 AS line_no,
       c_custkey || ',' || c_name || ',é€😀,' || c_mktsegment AS line
FROM customer""",
    "shard_skip": _SHARDS
    + """
SELECT file_name, line_no, line FROM physical
WHERE k >= 0 OR (shard = 0 AND piece = 0 AND line_no = 0)""",
    "filename_field": _SHARDS
    + """
SELECT 0 AS position, 'SourceSystem,' || line AS line FROM header
UNION ALL SELECT n + 1, tag || ',' || line FROM filled""",
    "round_robin_split": _SHARDS
    + "SELECT CAST(n % 4 + 1 AS INTEGER) AS output, CAST(n // 4 AS BIGINT) AS position, line FROM filled",
    "shard_outputs": _SHARDS
    + """
SELECT 'merged_' || output || '.csv' AS file_name, 0 AS line_no, 'SourceSystem,' || line AS line
FROM header, (VALUES (1), (2), (3), (4)) AS outputs(output)
UNION ALL
SELECT 'merged_' || (n % 4 + 1) || '.csv', CAST(n // 4 + 1 AS BIGINT), tag || ',' || line FROM filled""",
    "encrypt_roundtrip": """
SELECT c_custkey, c_name, CAST(16 + (strlen(c_name) // 16 + 1) * 16 AS INTEGER) AS sealed_bytes,
       CAST((strlen(c_name) // 16 + 1) * 16 AS INTEGER) AS bare_bytes, true AS hidden
FROM customer""",
    "stream_sync": "SELECT * FROM events",
    "stream_upsert": _VERSIONS
    + """
SELECT src.* FROM src LEFT JOIN tgt ON src.o_orderkey = tgt.o_orderkey
WHERE tgt.o_orderkey IS NULL OR src.mv > tgt.mv
UNION ALL
SELECT tgt.* FROM src JOIN tgt ON src.o_orderkey = tgt.o_orderkey WHERE src.mv <= tgt.mv""",
    "stream_duplicates": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST,
    event_type DESC NULLS LAST, value DESC NULLS LAST, props DESC NULLS LAST) AS place FROM events) AS ranked
WHERE place = 1 OR user_id IS NULL""",
    "scalar_fields": """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d%H%M%S') AS stamp,
       lpad(CAST(o_custkey AS VARCHAR), greatest(8, length(CAST(o_custkey AS VARCHAR)))::INTEGER, '0') AS padded, o_orderstatus AS status,
       regexp_extract(o_orderpriority, '[0-9]+') AS digits,
       coalesce(TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT), -1) AS priority,
       coalesce(TRY_CAST(o_orderstatus AS BIGINT), -1) AS no_number
FROM orders""",
}
