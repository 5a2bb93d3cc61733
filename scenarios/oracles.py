"""The same results in SQL for DuckDB, over the same Parquet tables."""

from __future__ import annotations

MID = "(SELECT (MIN(o_orderkey) + MAX(o_orderkey)) // 2 FROM orders)"

# Wire type codes and compatibility groups, as in functions/types.py.
TYPE_NAMES = (
    "(0,'decimal'),(1,'tinyint'),(2,'smallint'),(3,'int'),(4,'float'),(5,'double'),(6,'null'),(7,'timestamp'),"
    "(8,'bigint'),(9,'mediumint'),(10,'date'),(11,'time'),(12,'datetime'),(13,'year'),(14,'date'),(15,'varchar'),"
    "(16,'bit'),(245,'json'),(246,'decimal'),(247,'enum'),(248,'set'),(249,'tinyblob'),(250,'mediumblob'),"
    "(251,'longblob'),(252,'blob'),(253,'varchar'),(254,'char'),(255,'geometry')"
)
TYPE_TOKENS = (
    "(1,'int'),(1,'integer'),(1,'bigint'),(1,'smallint'),(1,'tinyint'),(1,'mediumint'),"
    "(2,'varchar'),(2,'char'),(2,'text'),(2,'longtext'),(2,'mediumtext'),(2,'tinytext'),"
    "(3,'decimal'),(3,'numeric'),(3,'float'),(3,'double'),(3,'real'),(4,'datetime'),(4,'timestamp'),"
    "(5,'date'),(6,'time'),"
    "(7,'blob'),(7,'longblob'),(7,'mediumblob'),(7,'tinyblob'),(7,'binary'),(7,'varbinary')"
)

# Column names and types of the test tables.
LAYOUT = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


RANKED = (
    "ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS row_no FROM lineitem)"
)
MIXED = (
    "mixed AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN n || '  ' ELSE n END AS c_name, c_acctbal, LOWER(c_name) AS f FROM "
    "(SELECT *, CASE WHEN c_custkey % 3 = 0 THEN UPPER(c_name) ELSE c_name END AS n FROM customer))"
)

# A fold over the rows in order: the keys taken so far, and what became of each row.
_PART_ROWS = """
parts AS (
  SELECT CAST(round(p_retailprice * 10) AS BIGINT) AS id, p_partkey, p_name, p_brand, p_type, p_size, CAST(p_partkey % 27 AS INTEGER) AS origin,
    CASE WHEN p_size > 45 THEN 'check:size' WHEN p_partkey % 27 NOT IN (SELECT n_nationkey FROM nation) THEN 'foreign_key:origin' END AS broken,
    'i' || CAST(round(p_retailprice * 10) AS BIGINT) AS k0, 'n' || p_name || '|' || p_brand AS k1, 'k' || p_brand || '|' || p_type || '|' || p_size AS k2
  FROM part
)"""


def _fold(name: str, rows: str, taken: str = "CAST([] AS VARCHAR[])") -> str:
    """``name``: p_partkey and the outcome of ``rows`` (which names parts) in order, after the keys in ``taken``."""
    return f"""
{name}_list AS (
  SELECT list({{'p': p_partkey, 'k0': k0, 'k1': k1, 'k2': k2}} ORDER BY id, p_partkey) AS l FROM {rows} WHERE broken IS NULL
), {name}_end AS (
  SELECT list_reduce(
    list_concat([{{'taken': {taken}, 'out': CAST([] AS STRUCT(p BIGINT, r VARCHAR)[]), 'x': CAST(NULL AS STRUCT(p BIGINT, k0 VARCHAR, k1 VARCHAR, k2 VARCHAR))}}],
      list_transform(l, lambda x: {{'taken': CAST([] AS VARCHAR[]), 'out': CAST([] AS STRUCT(p BIGINT, r VARCHAR)[]), 'x': x}})),
    lambda a, b: {{
      'taken': CASE WHEN list_has_any(a.taken, [b.x.k0, b.x.k1, b.x.k2]) THEN a.taken ELSE list_concat(a.taken, [b.x.k0, b.x.k1, b.x.k2]) END,
      'out': list_append(a.out, {{'p': b.x.p, 'r': CASE WHEN list_contains(a.taken, b.x.k0) THEN 'duplicate_key'
        WHEN list_contains(a.taken, b.x.k1) THEN 'duplicate_key:name' WHEN list_contains(a.taken, b.x.k2) THEN 'duplicate_key:kind' END}}),
      'x': b.x }}) AS s FROM {name}_list
), {name} AS (SELECT o.p AS p_partkey, o.r AS reason FROM (SELECT unnest(s.out) AS o FROM {name}_end))"""


def _schema(table: str, layout: str, source: str) -> list[str]:
    columns = [c.split(" ") for c in layout.split(", ")]
    return [
        f"SELECT '{table}' AS table_name, {i} AS ordinal, '{name}' AS column_name, '{kind}' AS data_type, "
        f"COUNT(*) AS n_rows, COUNT(*) - COUNT({name}) AS n_null FROM {source}"
        for i, (name, kind) in enumerate(columns, 1)
    ]


SRC = "src AS (SELECT *, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS is_deleted FROM orders)"
DST = (
    f"dst AS (SELECT * FROM orders WHERE (o_orderkey <= {MID} AND o_orderpriority <> '5-LOW') "
    f"OR (o_orderkey > {MID} AND o_orderpriority = '1-URGENT'))"
)
BASE = f"WITH {SRC}, {DST} "
LINES = (
    "WITH lik AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, "
    "l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem) "
)
BAD = (
    "WITH bad AS (SELECT CASE WHEN p_size <> 1 THEN p_partkey END AS id, "
    "CASE WHEN p_type = 'ECONOMY' AND p_size = 2 THEN NULL ELSE p_name END AS name, "
    "CASE WHEN p_brand = 'Brand#1' THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS rank, p_partkey FROM part), "
    "refused AS (SELECT *, CASE WHEN id IS NULL THEN 'null_key' WHEN name IS NULL THEN 'not_null:name' "
    "WHEN rank = 'n/a' THEN 'bad_cast:rank' WHEN LENGTH(name) > 9 THEN 'too_long:name' END AS reason FROM bad) "
)
INCB = (
    f"{BASE}, incb AS (SELECT s.o_orderkey, "
    "CAST((ROW_NUMBER() OVER (ORDER BY s.o_orderkey) - 1) // 1000 + 1 AS BIGINT) AS batch_no, "
    "d.o_orderkey IS NULL AS accepted FROM src s LEFT JOIN dst d ON s.o_orderkey = d.o_orderkey "
    f"WHERE s.o_orderkey > {MID}) "
)


ALLB = INCB.replace(f"WHERE s.o_orderkey > {MID}", "")


def _code(number: str) -> str:
    return f"CASE WHEN {number} % 29 <= 16 THEN {number} % 29 ELSE {number} % 29 + 228 END"



NAMES = f"names AS (SELECT * FROM (VALUES {TYPE_NAMES}) t(code, nm))"
TOKENS = f"toks AS (SELECT * FROM (VALUES {TYPE_TOKENS}) t(grp, tok))"
COMPATIBLE = (
    "members AS (SELECT DISTINCT nm, grp FROM (SELECT nm FROM names UNION ALL SELECT 'unknown') n "
    "JOIN toks ON contains(nm, tok)), "
    "agree AS (SELECT DISTINCT a.nm AS a, b.nm AS b FROM members a JOIN members b ON a.grp = b.grp)"
)
KEYS = (
    "WITH k AS (SELECT l_orderkey AS pair, 'c' || l_linenumber AS column_name, l_linenumber AS ordinal, "
    "CASE MAX(l_returnflag) WHEN 'A' THEN 'PRI' WHEN 'N' THEN 'MUL' ELSE '' END AS column_key, "
    "CASE WHEN MAX(l_linestatus) = 'O' THEN 'AUTO_INCREMENT' ELSE '' END AS extra "
    "FROM lineitem GROUP BY l_orderkey, l_linenumber) "
)
PAIRS = (
    f"WITH {NAMES}, {TOKENS}, {COMPATIBLE}, "
    "s0 AS (SELECT l_orderkey AS pair, 'c' || l_linenumber AS column_name, MIN(l_partkey) AS k, "
    "CASE WHEN MAX(l_discount) > 0.05 THEN 'YES' ELSE 'NO' END AS n FROM lineitem WHERE l_returnflag <> 'A' "
    "GROUP BY l_orderkey, l_linenumber), "
    "d0 AS (SELECT l_orderkey AS pair, 'c' || l_linenumber AS column_name, MIN(l_suppkey) AS k, "
    "CASE WHEN MAX(l_tax) > 0.04 THEN 'YES' ELSE 'NO' END AS n FROM lineitem WHERE l_linestatus = 'O' "
    "GROUP BY l_orderkey, l_linenumber), "
    f"s AS (SELECT pair, column_name, n, COALESCE(nm, 'unknown') AS t FROM s0 LEFT JOIN names ON code = {_code('k')}), "
    f"d AS (SELECT pair, column_name, n, COALESCE(nm, 'unknown') AS t FROM d0 LEFT JOIN names ON code = {_code('k')}), "
    "j AS (SELECT COALESCE(s.pair, d.pair) AS pair, COALESCE(s.column_name, d.column_name) AS column_name, "
    "d.pair IS NULL AS missing, s.pair IS NULL AS extra, s.n = 'YES' AND d.n = 'NO' AS nul, "
    "s.t <> d.t AND agree.a IS NULL AS typ "
    "FROM s FULL JOIN d ON s.pair = d.pair AND s.column_name = d.column_name "
    "LEFT JOIN agree ON agree.a = s.t AND agree.b = d.t), "
    "r AS (SELECT pair, column_name, 'error' AS level, 'missing_in_destination' AS issue FROM j WHERE missing "
    "UNION ALL SELECT pair, column_name, 'warning', 'extra_in_destination' FROM j WHERE extra "
    "UNION ALL SELECT pair, column_name, 'warning', 'type' FROM j WHERE typ AND NOT missing AND NOT extra "
    "UNION ALL SELECT pair, column_name, 'warning', 'nullable' FROM j WHERE nul) "
)
WM = (
    "WITH wm AS (SELECT 'job' || user_id AS job, event_type AS source_table, 'ev' AS dest_table, 'event_id' AS pk, "
    "CAST(event_id AS VARCHAR) AS value, 'bigint' AS value_type, event_id AS seq FROM events) "
)
CP = (
    "WITH cp AS (SELECT 'job' || o_custkey AS job, 'orders' AS source_table, o_orderpriority AS dest_table, "
    "'full' AS mode, CAST(o_orderkey AS VARCHAR) AS last_pk, o_orderkey // 1000 + 1 AS batch_no, "
    "CASE WHEN o_orderstatus = 'P' THEN 'in_progress' ELSE 'completed' END AS status, o_orderkey AS seq FROM orders), "
    "cur AS (SELECT job, source_table, dest_table, mode, arg_max(last_pk, seq) AS last_pk, "
    "arg_max(batch_no, seq) AS batch_no, arg_max(status, seq) AS status FROM cp GROUP BY ALL) "
)
DLOG = (
    f"{BASE}, dlog AS (SELECT o_orderkey AS record_id, "
    "CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS INTEGER) AS processed "
    f"FROM src WHERE is_deleted = 1 AND o_orderkey <= {MID}) "
)
JOBS = (
    f"{BASE}, held AS (SELECT o_custkey, COUNT(*) AS n FROM dst GROUP BY 1), "
    "seen AS (SELECT o_custkey, COUNT(*) FILTER (WHERE is_deleted = 1) AS flagged, "
    "bool_or(o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') AS open FROM src GROUP BY 1), "
    "jobs AS (SELECT c_custkey AS job, COALESCE(held.n, 0) AS dest_rows, COALESCE(flagged, 0) AS flagged, "
    "c_mktsegment <> 'BUILDING' AS has_flag, c_nationkey < 20 AS has_pk, c_acctbal < 0 AS force, "
    "COALESCE(open, FALSE) AS has_checkpoint FROM customer LEFT JOIN held ON held.o_custkey = c_custkey "
    "LEFT JOIN seen ON seen.o_custkey = c_custkey) "
)
AGGREGATE = "SELECT o_custkey AS id, COUNT(*) AS n_orders, MAX(o_orderdate) AS last_order FROM orders GROUP BY o_custkey"
MID_EVENT = "(SELECT (MIN(event_id) + MAX(event_id)) // 2 FROM events)"

ORACLES = {
    "extract_template": "SELECT * FROM orders",
    "extract_join_query": (
        "SELECT o.o_orderkey AS id, c.c_name AS user_name, o.o_orderdate AS order_date, p.p_name AS product_name, "
        "l.l_quantity AS qty, l.l_extendedprice AS price FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey "
        "JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey "
        "WHERE o.o_orderdate >= '2000-01-01'"
    ),
    "extract_aggregate_query": (
        f"SELECT * FROM ({AGGREGATE}) q WHERE id > (SELECT (MIN(c_custkey) + MAX(c_custkey)) // 2 FROM customer)"
    ),
    "extract_projection": "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer",
    "query_schema": (
        f"WITH q AS ({AGGREGATE}) SELECT ordinal, column_name, data_type, n_rows, n_null FROM ("
        + " UNION ALL ".join(_schema("q", "id bigint, n_orders bigint, last_order timestamp_ntz", "q"))
        + ")"
    ),
    "keyset_page": f"SELECT * FROM (SELECT * FROM orders) q WHERE o_orderkey > {MID} ORDER BY o_orderkey LIMIT 1000",
    "keyset_page_composite": (
        "WITH m AS (SELECT (MIN(conv_id) + MAX(conv_id)) // 2 AS c FROM conversations) "
        "SELECT conv_id, turn, role FROM conversations, m WHERE conv_id > c OR (conv_id = c AND turn > 1) "
        "ORDER BY conv_id, turn LIMIT 100"
    ),
    "batch_manifest": (
        "SELECT batch_no, MIN(o_orderkey) AS first_pk, MAX(o_orderkey) AS last_pk, COUNT(*) AS n_rows FROM ("
        "SELECT o_orderkey, CAST((ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1) // 1000 + 1 AS BIGINT) AS batch_no "
        "FROM orders) GROUP BY batch_no"
    ),
    "batch_manifest_composite": (
        "WITH n AS (SELECT l_orderkey, l_linenumber, ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber) AS i "
        "FROM lineitem), b AS (SELECT CAST((i - 1) // 1000 + 1 AS BIGINT) AS batch_no, MIN(i) AS lo, MAX(i) AS hi, "
        "COUNT(*) AS n_rows FROM n GROUP BY 1) SELECT batch_no, f.l_orderkey AS first_order, "
        "f.l_linenumber AS first_line, t.l_orderkey AS last_order, t.l_linenumber AS last_line, n_rows "
        "FROM b JOIN n f ON f.i = lo JOIN n t ON t.i = hi"
    ),
    "keyset_resume": (
        "SELECT o_orderkey, CAST(7 + (ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1) // 1000 + 1 AS BIGINT) AS batch_no "
        f"FROM orders WHERE o_orderkey > {MID}"
    ),
    "offset_page_fallback": (
        "SELECT event_id, event_type, value FROM events ORDER BY ts, user_id, event_type, value, props, event_id "
        "LIMIT 1000 OFFSET 2000"
    ),
    "jdbc_stripes": "SELECT 1 AS n_stripes, COUNT(*) AS n_rows FROM orders",
    "row_count": (
        f"{BASE} SELECT 'src' AS table_name, COUNT(*) AS n_rows FROM src UNION ALL SELECT 'dst', COUNT(*) FROM dst "
        "UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem"
    ),
    "deleted_count": f"{BASE} SELECT COUNT(*) FILTER (WHERE is_deleted = 1) AS n_deleted FROM src",
    "key_profile": BAD
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows, COUNT(DISTINCT {k}) AS n_distinct, "
        f"COUNT(*) FILTER (WHERE {k} IS NULL) AS n_null, MIN({k}) AS min_key, MAX({k}) AS max_key, "
        f"COUNT(*) = COUNT(DISTINCT {k}) AS is_unique FROM {s}"
        for t, k, s in (("orders", "o_orderkey", "orders"), ("lineitem", "l_orderkey", "lineitem"), ("bad_part", "id", "bad"))
    ),
    "table_schema": " UNION ALL ".join(q for t, layout in LAYOUT.items() for q in _schema(t, layout, t)),
    "preflight_report": (
        "SELECT 'orders' AS table_name, 'o_orderkey' AS column_name, TRUE AS table_exists, TRUE AS column_exists, "
        "COUNT(*) AS n_rows FROM orders UNION ALL SELECT 'orders', 'is_deleted', TRUE, FALSE, COUNT(*) FROM orders "
        "UNION ALL SELECT 'lineitem', 'l_orderkey', TRUE, TRUE, COUNT(*) FROM lineitem "
        "UNION ALL SELECT 'missing_table', 'id', FALSE, FALSE, NULL"
    ),
    "query_validation": (
        "SELECT 'ok' AS query_name, TRUE AS is_valid, COUNT(*) AS n_rows FROM orders WHERE o_orderstatus = 'F' "
        "UNION ALL SELECT 'double_where', FALSE, NULL UNION ALL SELECT 'unknown_column', FALSE, NULL "
        "UNION ALL SELECT 'missing_table', FALSE, NULL"
    ),
    "incremental_extract": f"{BASE} SELECT * FROM src WHERE o_orderkey > {MID}",
    "delta_deleted_ids": f"{BASE} SELECT o_orderkey FROM src WHERE is_deleted = 1",
    "type_code_map": (
        f"WITH {NAMES} SELECT CAST(c AS INTEGER) AS type_code, COALESCE(nm, 'unknown') AS type_name, COUNT(*) AS n_columns "
        f"FROM (SELECT {_code('l_partkey')} AS c FROM lineitem) LEFT JOIN names ON code = c GROUP BY 1, 2"
    ),
    "type_compat_matrix": (
        f"WITH {NAMES}, {TOKENS}, {COMPATIBLE}, p AS (SELECT COALESCE(x.nm, 'unknown') AS source_type, "
        "COALESCE(y.nm, 'unknown') AS dest_type, COUNT(*) AS n_columns FROM lineitem "
        f"LEFT JOIN names x ON x.code = {_code('l_partkey')} LEFT JOIN names y ON y.code = {_code('l_suppkey')} GROUP BY 1, 2) "
        "SELECT source_type, dest_type, n_columns, source_type = dest_type OR a IS NOT NULL AS compatible "
        "FROM p LEFT JOIN agree ON a = source_type AND b = dest_type"
    ),
    "schema_compat_report": f"{PAIRS} SELECT * FROM r",
    "schema_verdict": (
        f"{PAIRS} SELECT p.pair, COUNT(*) FILTER (WHERE level = 'error') = 0 AS is_compatible, "
        "COUNT(*) FILTER (WHERE level = 'error') AS n_errors, COUNT(*) FILTER (WHERE level = 'warning') AS n_warnings "
        "FROM (SELECT DISTINCT pair FROM j) p LEFT JOIN r USING (pair) GROUP BY p.pair"
    ),
    "dest_pk_validation": (
        f"{KEYS}, c AS (SELECT t.pair AS table_name, k.column_name IS NULL AS nf, k.column_key <> 'PRI' AS np, "
        "contains(lower(k.extra), 'auto_increment') AS ai FROM (SELECT DISTINCT pair FROM k) t "
        "LEFT JOIN k ON k.pair = t.pair AND k.column_name = 'c1') "
        "SELECT table_name, 'not_found' AS error FROM c WHERE nf UNION ALL SELECT table_name, 'not_primary' FROM c WHERE np "
        "UNION ALL SELECT table_name, 'auto_increment' FROM c WHERE ai"
    ),
    "pk_choice": (
        f"{KEYS} SELECT pair, CASE WHEN COUNT(*) FILTER (WHERE column_key = 'PRI') = 0 "
        "OR bool_or(column_key = 'PRI' AND column_name = 'c2') THEN 'c2' "
        "ELSE arg_min(column_name, ordinal) FILTER (WHERE column_key = 'PRI') END AS pk, "
        "bool_or(column_key = 'PRI') AS has_pk FROM k GROUP BY pair"
    ),
    "column_mapping_insert": (
        "SELECT c_custkey, c_name, CAST(NULL AS INTEGER) AS c_nationkey, CAST(0.0 AS DOUBLE) AS c_acctbal, "
        "CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer"
    ),
    "full_load_accepted": (
        f"{LINES} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lik WHERE rn = 1"
    ),
    "full_load_rejects": (
        f"{LINES} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'duplicate_key' AS reason FROM lik WHERE rn > 1"
    ),
    "incremental_accepted": (
        f"{BASE} SELECT * FROM src s WHERE o_orderkey > {MID} "
        "AND NOT EXISTS (SELECT 1 FROM dst d WHERE d.o_orderkey = s.o_orderkey)"
    ),
    "incremental_first_run": (
        f"{BASE} SELECT * FROM src s WHERE NOT EXISTS (SELECT 1 FROM dst d WHERE d.o_orderkey = s.o_orderkey)"
    ),
    "incremental_rejects": (
        f"{BASE} SELECT o_orderkey, 'duplicate_key' AS reason FROM src s WHERE o_orderkey > {MID} "
        "AND EXISTS (SELECT 1 FROM dst d WHERE d.o_orderkey = s.o_orderkey)"
    ),
    "constraint_rejects": f"{BAD} SELECT p_partkey, reason FROM refused WHERE reason IS NOT NULL",
    "reject_table": f"{BAD} SELECT 'run-1' AS run_id, reason, p_partkey, rank FROM refused WHERE reason IS NOT NULL",
    "classified_load": (
        f"{LINES}, late AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus = 'F') "
        "SELECT CASE WHEN rn > 1 OR late.l_orderkey IS NOT NULL THEN 'duplicate_key' ELSE 'accepted' END AS outcome, "
        "COUNT(*) AS n_rows, CAST(SUM(l_partkey) AS BIGINT) AS sum_partkey FROM lik LEFT JOIN late "
        "ON late.l_orderkey = lik.l_orderkey AND late.l_linenumber = lik.l_linenumber GROUP BY 1"
    ),
    "full_load_hot_keys": (
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, CASE WHEN ROW_NUMBER() OVER ("
        "PARTITION BY l_returnflag ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
        "l_extendedprice, l_discount, l_tax, l_linestatus, l_shipdate) = 1 THEN 'accepted' ELSE 'duplicate_key' END "
        "AS outcome FROM lineitem"
    ),
    "full_load_joined_hot_keys": (
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, COUNT(*) OVER (PARTITION BY l_returnflag) AS n_flag, "
        "CASE WHEN ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) = 1 "
        "THEN 'accepted' ELSE 'duplicate_key' END AS outcome FROM lineitem"
    ),
    "multi_unique_rejects": (
        f"WITH {_PART_ROWS}, {_fold('done', 'parts')} SELECT id, p_partkey, coalesce(broken, reason) AS reason "
        "FROM parts LEFT JOIN done USING (p_partkey) WHERE coalesce(broken, reason) IS NOT NULL"
    ),
    "sync_constraints": (
        f"WITH {_PART_ROWS}, third AS (SELECT * FROM parts WHERE origin % 3 = 0), {_fold('held', 'third')}, "
        f"{_fold('done', 'parts', '(SELECT s.taken FROM held_end)')} "
        "SELECT id, p_partkey, p_name, p_brand, p_type, p_size, origin FROM parts WHERE p_partkey IN "
        "(SELECT p_partkey FROM held WHERE reason IS NULL UNION ALL SELECT p_partkey FROM done WHERE reason IS NULL)"
    ),
    "batch_metrics": (
        f"{ALLB} SELECT batch_no, COUNT(*) AS rows_processed, COUNT(*) FILTER (WHERE accepted) AS rows_inserted, "
        "COUNT(*) FILTER (WHERE NOT accepted) AS rows_rejected, MAX(o_orderkey) AS last_pk FROM incb GROUP BY batch_no"
    ),
    "load_progress": (
        f"{ALLB} SELECT batch_no, CAST(SUM(n) OVER (ORDER BY batch_no) AS BIGINT) AS rows_done, "
        "CAST(ROUND(SUM(n) OVER (ORDER BY batch_no) * 100.0 / SUM(n) OVER (), 2) AS DOUBLE) AS pct "
        "FROM (SELECT batch_no, COUNT(*) AS n FROM incb GROUP BY batch_no)"
    ),
    "delta_apply": f"{BASE} SELECT * FROM dst WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src WHERE is_deleted = 1)",
    "delta_effect": (
        f"{BASE} SELECT (SELECT COUNT(*) FROM src WHERE is_deleted = 1) AS rows_attempted, "
        "(SELECT COUNT(*) FROM dst JOIN src USING (o_orderkey) WHERE is_deleted = 1) AS rows_removed, "
        "CAST(((SELECT COUNT(*) FROM src WHERE is_deleted = 1) + 999) // 1000 AS BIGINT) AS n_batches"
    ),
    "watermark_lookup": (
        f"{WM} SELECT job, source_table, dest_table, pk, arg_max(value, seq) AS value, "
        "arg_max(value_type, seq) AS value_type, MAX(seq) AS seq FROM wm GROUP BY ALL"
    ),
    "watermark_upsert": (
        f"{WM}, w AS (SELECT 'job' || o_custkey AS job, MAX(o_orderkey) AS k FROM orders GROUP BY o_custkey), "
        "a AS (SELECT * FROM wm UNION ALL SELECT job, 'view', 'ev', 'event_id', '1' || k, 'bigint', "
        "k + (SELECT MAX(event_id) + 1 FROM events) FROM w) "
        "SELECT job, source_table, dest_table, pk, arg_max(value, seq) AS value, "
        "arg_max(value_type, seq) AS value_type FROM a GROUP BY ALL"
    ),
    "watermark_advance": f"{INCB} SELECT CAST(MAX(o_orderkey) AS VARCHAR) AS new_value FROM incb",
    "checkpoint_lookup": f"{CP} SELECT job, dest_table, mode, last_pk, batch_no FROM cur WHERE status = 'in_progress'",
    "checkpoint_upsert": (
        f"{CP}, h AS (SELECT job, dest_table, mode, last_pk, "
        f"CASE WHEN seq > {MID} THEN 'in_progress' ELSE status END AS status, seq FROM cp) "
        "SELECT job, dest_table, mode, arg_max(last_pk, seq) AS last_pk, arg_max(status, seq) AS status FROM h GROUP BY ALL"
    ),
    "checkpoint_complete": (
        f"{CP} SELECT job, dest_table, mode, CASE WHEN dest_table = '1-URGENT' THEN 'completed' ELSE status END AS status "
        "FROM cur"
    ),
    "state_clear": (
        f"{CP} SELECT job, source_table, dest_table, mode FROM cur "
        "WHERE NOT (source_table = 'orders' AND dest_table = '1-URGENT')"
    ),
    "state_clear_count": f"{CP} SELECT COUNT(*) AS n_cleared FROM cur WHERE dest_table = '1-URGENT'",
    "delete_log_merge": (
        f"{DLOG} SELECT record_id, processed FROM dlog UNION ALL SELECT o_orderkey, 0 FROM src "
        "WHERE is_deleted = 1 AND o_orderkey NOT IN (SELECT record_id FROM dlog)"
    ),
    "delete_log_pending": f"{DLOG} SELECT record_id FROM dlog WHERE processed = 0",
    "delete_log_mark": (
        f"{DLOG} SELECT record_id, CAST(CASE WHEN o_totalprice > 250000 THEN 1 ELSE processed END AS INTEGER) AS processed "
        "FROM dlog JOIN orders ON o_orderkey = record_id"
    ),
    "run_summary": (
        "SELECT event_type AS mode, COUNT(*) AS n_runs, CAST(SUM(user_id) AS BIGINT) AS rows_processed, "
        "COUNT(*) FILTER (WHERE value < 5) AS n_failed FROM events GROUP BY event_type"
    ),
    "multi_job_state": (
        f"{CP}, wm AS (SELECT DISTINCT 'job' || user_id AS job, event_type FROM events) "
        "SELECT job, COUNT(*) AS n_entries FROM (SELECT job FROM wm UNION ALL SELECT job FROM cur) GROUP BY job"
    ),
    "mode_detect": (
        f"{JOBS} SELECT job, CASE WHEN dest_rows = 0 THEN 'full' WHEN has_flag AND flagged > 0 THEN 'delta' "
        "WHEN has_pk THEN 'incremental' ELSE 'full' END AS mode, "
        "CASE WHEN dest_rows = 0 THEN 'Destination table is empty' WHEN has_flag AND flagged > 0 "
        "THEN 'Found ' || flagged || ' deleted records in source' "
        "WHEN has_pk THEN 'Primary key column ''o_orderkey'' found' "
        "ELSE 'No primary key found, defaulting to full load' END AS reason FROM jobs"
    ),
    "mode_forced": (
        "SELECT c_custkey AS job, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'full' WHEN 'BUILDING' THEN 'incremental' "
        "WHEN 'FURNITURE' THEN 'delta' END AS mode, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') "
        "THEN 'Manually forced' ELSE 'Invalid mode: ' || lower(c_mktsegment) || "
        "'. Valid modes are: full, incremental, delta' END AS reason FROM customer"
    ),
    "fresh_start": f"{JOBS} SELECT job, force OR (dest_rows = 0 AND has_checkpoint) AS clears FROM jobs",
    "sync_full": f"{LINES} SELECT l_orderkey, l_linenumber, l_partkey FROM lik WHERE rn = 1",
    "full_load_resumed": f"{LINES} SELECT l_orderkey, l_linenumber, l_partkey FROM lik WHERE rn = 1",
    "sync_incremental": (
        f"{BASE} SELECT * FROM dst UNION ALL SELECT * FROM orders WHERE o_orderkey > {MID} "
        "AND o_orderkey NOT IN (SELECT o_orderkey FROM dst)"
    ),
    "sync_rejects": f"{BASE} SELECT o_orderkey, 'duplicate_key' AS reason FROM dst WHERE o_orderkey > {MID}",
    "sync_batches": (
        f"{INCB}, b AS (SELECT batch_no, COUNT(*) AS n, COUNT(*) FILTER (WHERE accepted) AS ok, "
        "CAST(MAX(o_orderkey) AS VARCHAR) AS last_pk FROM incb GROUP BY batch_no) "
        "SELECT batch_no, n AS rows_processed, ok AS rows_inserted, n - ok AS rows_rejected, last_pk, "
        "CAST(SUM(n) OVER (ORDER BY batch_no) AS BIGINT) AS rows_done, "
        "CAST(ROUND(SUM(n) OVER (ORDER BY batch_no) * 100.0 / SUM(n) OVER (), 2) AS DOUBLE) AS pct FROM b"
    ),
    "sync_history": (
        f"{INCB} SELECT 'incremental' AS mode, 'Primary key column ''o_orderkey'' found' AS reason, "
        "COUNT(*) AS rows_processed, COUNT(*) FILTER (WHERE accepted) AS rows_inserted, "
        "COUNT(*) FILTER (WHERE NOT accepted) AS rows_rejected, 'completed' AS status, 'o_orderkey' AS pk, "
        "CAST(MAX(o_orderkey) AS VARCHAR) AS value, 'bigint' AS value_type FROM incb"
    ),
    "sync_delta": f"{BASE} SELECT * FROM dst WHERE o_orderstatus <> 'F'",
    "delete_bitmaps": (
        f"{BASE} SELECT * FROM dst WHERE o_orderstatus <> 'F' UNION ALL "
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, 'back' AS o_orderpriority "
        f"FROM dst WHERE o_orderkey <= {MID} AND o_orderstatus = 'F' AND o_custkey % 10 = 0"
    ),
    "manifest_pruned_load": (
        f"{BASE} SELECT * FROM src s WHERE o_orderkey > {MID} "
        "AND NOT EXISTS (SELECT 1 FROM dst d WHERE d.o_orderkey = s.o_orderkey)"
    ),
    "concurrent_commits": (
        "WITH e AS (SELECT MIN(o_orderkey) AS low, MAX(o_orderkey) AS high FROM orders), "
        "c AS (SELECT low + (high - low) // 3 AS a, low + (high - low) * 2 // 3 AS b FROM e) "
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
        "CASE WHEN o_orderkey <= b THEN o_orderpriority ELSE 'second' END AS o_orderpriority, "
        "(SELECT COUNT(*) FROM orders, c WHERE o_orderkey > a AND o_orderkey <= b) AS n_refused "
        "FROM orders, c WHERE NOT (o_orderstatus IN ('F', 'O') AND o_custkey % 4 = 0)"
    ),
    "table_difference": (
        "SELECT * FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'missing' ELSE 'changed' END AS change, CAST(1 AS BIGINT) AS source_n, "
        "CAST(CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE 1 END AS BIGINT) AS dest_n FROM orders WHERE o_orderkey % 13 = 0 OR o_custkey % 11 = 0) "
        "UNION ALL SELECT -1 - o_orderkey, 'extra', 0, 1 FROM orders WHERE o_orderkey % 17 = 0"
    ),
    "sketch_profile": "SELECT COUNT(*) AS n_rows, TRUE AS distinct_ok, TRUE AS middle_ok FROM lineitem",
    "ranked_page_deep": (
        f"WITH {RANKED} SELECT row_no, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM ranked "
        "WHERE row_no > (SELECT COUNT(*) // 2 FROM lineitem) AND row_no <= (SELECT COUNT(*) // 2 FROM lineitem) + 1000"
    ),
    "ranked_resume": (
        f"WITH {RANKED}, m AS (SELECT (MIN(l_orderkey) + MAX(l_orderkey)) // 2 AS k FROM lineitem) "
        "SELECT row_no, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM ranked, m WHERE l_orderkey > k "
        "AND row_no <= (SELECT COUNT(*) FROM lineitem, m WHERE l_orderkey <= k) + 1000"
    ),
    "collated_pages": (
        f"WITH {MIXED}, k AS (SELECT (MIN(c_custkey) + MAX(c_custkey)) // 2 AS mid FROM customer) SELECT c_custkey, c_name, c_acctbal FROM mixed "
        "WHERE f > (SELECT f FROM mixed, k WHERE c_custkey = mid) ORDER BY f, c_name, c_custkey LIMIT 1000"
    ),
    "collated_batches": (
        f"WITH {MIXED}, n AS (SELECT *, (ROW_NUMBER() OVER (ORDER BY f, c_name) - 1) // 1000 + 1 AS batch_no FROM mixed) "
        "SELECT batch_no, arg_min(c_name, f) AS first_pk, arg_max(c_name, f) AS last_pk, COUNT(*) AS n_rows FROM n GROUP BY batch_no"
    ),
    "stream_stateful": "SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type <> 'error'",
    "stream_keyset_source": "SELECT * FROM orders",
    "sync_sequence": "SELECT * FROM orders WHERE o_orderstatus <> 'F'",
    "stream_incremental": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "stream_late_keys": f"SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_id > {MID_EVENT}",
    "stream_late_fill": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "stream_delete": "SELECT event_id, event_type FROM events WHERE event_type <> 'error'",
    "stream_new_checkpoint": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "stream_delete_new_checkpoint": "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('error', 'click')",
    "sync_without_key": "SELECT 'null_key' AS reason, c_name FROM customer",
    "sync_schema_warnings": (
        "SELECT column_name, 'warning' AS level, issue, (SELECT COUNT(*) FROM customer) AS n_rows FROM (VALUES "
        "('c_custkey', 'nullable'), ('c_name', 'nullable'), ('c_acctbal', 'type'), ('note', 'extra_in_destination')) "
        "t(column_name, issue)"
    ),
    "sync_text_key": "SELECT o_orderkey, o_custkey FROM orders",
    "sync_collated_key": (
        "SELECT c_custkey, CASE WHEN c_custkey <= (SELECT (MIN(c_custkey) + MAX(c_custkey)) // 2 FROM customer) "
        "THEN UPPER(c_name) ELSE LOWER(c_name) END AS c_name FROM customer"
    ),
    "sync_zone_watermark": "SELECT 1700000000000000 + event_id * 3600000000 AS micros, event_id FROM events",
    "sync_delta_bad_key": f"{BASE} SELECT * FROM dst WHERE o_orderstatus <> 'F' OR o_orderkey % 7 = 0",
    "offset_page_deep": (
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem ORDER BY l_orderkey, l_partkey, l_suppkey, "
        "l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate "
        "LIMIT 1000 OFFSET (SELECT COUNT(*) // 2 FROM lineitem)"
    ),
    "full_load_resumed_text": "SELECT c_name, c_custkey, c_acctbal FROM customer",
}
