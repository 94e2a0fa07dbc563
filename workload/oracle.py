"""The registered queries in plain SQL, written apart from the Spark plans.

``VIEWS`` are named sub-queries; a query gets those it mentions, directly or not.
"""

from __future__ import annotations

import re

SCOPE = (
    "client_id = 4 AND receipt_date BETWEEN DATE '2025-01-06' AND DATE '2025-01-19' "
    "AND store_nr BETWEEN 100 AND 1000000000"
)
KEY = (
    "loc_sid || '_' || client_id || '_' || register_id || '_' || strftime(receipt_date, '%Y%m%d') "
    "|| '_' || strftime(receipt_ts, '%H%M%S') || '_' || receipt_id"
)
SIX = "store_nr, receipt_date, receipt_ts, register_id, cashier_id, receipt_id"
RAW = "loc_sid, client_id, register_id, receipt_date, receipt_ts, receipt_id"
WEEK = "strftime(receipt_date, '%G-%V')"

VIEWS = {
    # -- the given tables as cash-register data
    "receipts": """
SELECT o_orderkey AS receipt_id, CAST(100 + o_custkey // 75 AS INTEGER) AS store_nr,
  CAST(9000 + o_custkey // 75 AS INTEGER) AS loc_sid, 4 AS client_id,
  DATE '2025-01-06' + CAST(o_orderkey % 14 AS INTEGER) AS receipt_date,
  CAST(DATE '2025-01-06' + CAST(o_orderkey % 14 AS INTEGER) AS TIMESTAMP)
    + to_seconds(25200 + (o_orderkey * 37) % 54000) AS receipt_ts,
  CAST(CASE WHEN o_orderkey % 11 = 0 THEN 80 + o_orderkey % 3 ELSE 1 + o_orderkey % 5 END AS INTEGER) AS register_id,
  CAST(1 + o_custkey % 3 AS INTEGER) AS cashier_id,
  CASE o_orderkey % 10 WHEN 0 THEN 150 WHEN 1 THEN 200 ELSE 100 END AS transaction_type_cd,
  CASE WHEN o_orderkey % 10 = 1 THEN 0 ELSE 1 END AS turnover_relevant_fg,
  CAST(round(CASE WHEN o_orderkey % 10 = 0 THEN -(1 + o_totalprice % 20) ELSE o_totalprice END, 2) AS DECIMAL(18,2))
    AS total_gross_val
FROM orders""",
    "own_line": f"""
SELECT {RAW}, CAST(2 * row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS INTEGER) AS receiptline_nr,
  CASE WHEN transaction_type_cd = 150 THEN 150 WHEN (l_partkey + l_suppkey) % 10 < 5 THEN 101
    WHEN (l_partkey + l_suppkey) % 10 = 5 THEN 102 WHEN (l_partkey + l_suppkey) % 10 < 8 THEN 170 ELSE 171 END
    AS transaction_type_cd,
  CASE WHEN transaction_type_cd = 150 THEN 1 ELSE 0 END AS return_fg, turnover_relevant_fg,
  l_partkey % 7 AS item_sid, 'E' || (l_partkey % 7) AS ean_barcode, l_quantity AS sales_piece_qty,
  1 AS sales_weight_qty, store_nr,
  transaction_type_cd = 150 AND receipt_id % 3 <> 0 AS referenced
FROM lineitem JOIN receipts ON l_orderkey = receipt_id""",
    "raw_line": """
SELECT loc_sid, client_id, register_id, receipt_date, receipt_ts, receipt_id, receiptline_nr, transaction_type_cd,
  return_fg, turnover_relevant_fg, CASE WHEN transaction_type_cd = 170 THEN receiptline_nr + 1 END AS voided_by,
  item_sid, ean_barcode, sales_piece_qty, sales_weight_qty,
  CASE WHEN referenced THEN store_nr END AS orig_store, CASE WHEN referenced THEN register_id END AS orig_register,
  CASE WHEN referenced THEN receipt_date - CAST(receipt_id % 120 AS INTEGER) END AS orig_date,
  CASE WHEN referenced THEN receipt_id + 1000000 END AS orig_receipt
FROM own_line
UNION ALL
SELECT loc_sid, client_id, register_id, receipt_date - CAST(receipt_id % 120 AS INTEGER),
  receipt_ts - to_days(CAST(receipt_id % 120 AS INTEGER)), receipt_id + 1000000, receiptline_nr, 101,
  0, turnover_relevant_fg, NULL, item_sid, ean_barcode, sales_piece_qty, sales_weight_qty, NULL, NULL, NULL, NULL
FROM own_line WHERE referenced""",
    "raw_header": f"""
SELECT {RAW}, transaction_type_cd,
  CAST((SELECT count(*) FROM own_line l WHERE l.receipt_id = r.receipt_id
    AND l.transaction_type_cd IN (101, 102, 170)) AS INTEGER) AS cnt_receiptlines_sales,
  CAST((SELECT count(*) FROM own_line l WHERE l.receipt_id = r.receipt_id
    AND l.transaction_type_cd = 170) AS INTEGER) AS cnt_receiptlines_voids,
  turnover_relevant_fg, cashier_id, total_gross_val
FROM receipts r""",
    "location": "SELECT DISTINCT loc_sid, store_nr FROM receipts",
    # -- sources
    "headers": f"""
SELECT {KEY} AS transaction_id, transaction_type_cd, cnt_receiptlines_sales, cnt_receiptlines_voids,
  turnover_relevant_fg, {SIX}
FROM raw_header JOIN location USING (loc_sid) WHERE {SCOPE}""",
    "lines": f"""
SELECT {KEY} AS transaction_id, transaction_type_cd, receiptline_nr, return_fg,
  CAST(voided_by > 0 AS INTEGER) AS void_fg, ean_barcode, item_sid
FROM raw_line JOIN location USING (loc_sid) WHERE {SCOPE} AND register_id < 80 AND turnover_relevant_fg = 1""",
    "subtotals": f"""
SELECT {KEY} AS transaction_id, CAST(2 * j + 1 AS INTEGER) AS receiptline_nr, {SIX}
FROM receipts, unnest(range(receipt_id % 3 + 1)) AS places(j) WHERE {SCOPE} AND register_id < 80""",
    "payments": """
SELECT *, CASE WHEN receipt_id % 4 = 0 THEN 12 ELSE 11 END AS payment_type FROM receipts WHERE register_id < 80
UNION ALL SELECT *, 12 FROM receipts WHERE register_id < 80 AND receipt_id % 9 = 0""",
    "cash": f"""
SELECT {KEY} AS transaction_id FROM payments WHERE {SCOPE}
GROUP BY 1 HAVING count(DISTINCT payment_type) = 1 AND max(payment_type) = 11""",
    "return_lines": f"""
SELECT {KEY} AS transaction_id, item_sid, orig_store, orig_register, orig_date, orig_receipt
FROM raw_line JOIN location USING (loc_sid)
WHERE {SCOPE} AND register_id < 80 AND return_fg = 1 AND turnover_relevant_fg = 1""",
    "staffed": f"""
SELECT {KEY} AS transaction_id, {SIX}, total_gross_val FROM receipts WHERE {SCOPE} AND register_id < 80""",
    "returns": f"SELECT {SIX}, total_gross_val FROM staffed JOIN return_lines USING (transaction_id)",
    "originals": """
SELECT DISTINCT store_nr AS o_store, register_id AS o_register, receipt_date AS o_date, receipt_id AS o_receipt,
  item_sid AS o_item
FROM raw_line JOIN location USING (loc_sid)
WHERE client_id = 4 AND receipt_date BETWEEN DATE '2024-10-06' AND DATE '2025-01-19'
  AND store_nr BETWEEN 100 AND 1000000000 AND transaction_type_cd IN (101, 102) AND turnover_relevant_fg = 1
  AND voided_by IS NULL AND sales_piece_qty * sales_weight_qty IS NOT NULL""",
    "unreferenced": f"""
SELECT {SIX} FROM staffed JOIN return_lines USING (transaction_id)
WHERE NOT EXISTS (SELECT 1 FROM originals WHERE o_store = orig_store AND o_register = orig_register
  AND o_date = orig_date AND o_receipt = orig_receipt AND o_item = item_sid AND receipt_date - o_date < 92)""",
    "hours": """
SELECT store_nr, DATE '2025-01-06' + CAST(d AS INTEGER) AS receipt_date,
  CASE WHEN d IN (6, 13) AND store_nr % 2 = 0 THEN 0 ELSE 1 END AS is_open,
  CASE WHEN (d IN (6, 13) AND store_nr % 2 = 0) OR (store_nr - 100 + d) % 17 = 0 THEN NULL ELSE '08:00:00' END
    AS open_time,
  CASE WHEN (d IN (6, 13) AND store_nr % 2 = 0) OR (store_nr - 100 + d) % 17 = 0 THEN NULL ELSE '20:00:00' END
    AS close_time
FROM location, range(14) AS days(d)""",
    "org": """
SELECT CASE WHEN store_nr % 2 = 0 THEN 'WEI' ELSE 'SEZ' END AS company, store_nr, 'Store ' || store_nr AS store_desc,
  'VL_' || ((store_nr - 100) % 2) AS account_manager, 'RL_' || ((store_nr - 100) % 4) AS region_manager,
  'RL_' || ((store_nr - 100) % 4) AS sales_manager
FROM location""",
    # -- preparation
    "stats": f"""
SELECT store_nr, cashier_id, {WEEK} AS iso_week, count(transaction_id) AS total_receipts
FROM headers WHERE transaction_type_cd IN (100, 150) GROUP BY ALL""",
    "opening": """
SELECT store_nr, receipt_date, is_open,
  CASE WHEN is_open = 1 THEN CAST(receipt_date || ' ' || open_time AS TIMESTAMP) END AS opens_at,
  CASE WHEN is_open = 1 THEN CAST(receipt_date || ' ' || close_time AS TIMESTAMP) END AS closes_at
FROM hours""",
    "outside": f"""
SELECT {SIX},
  CASE WHEN is_open = 0 OR receipt_ts < opens_at - INTERVAL 30 MINUTE OR receipt_ts > closes_at + INTERVAL 15 MINUTE
    THEN 1 ELSE 0 END AS outside_tolerance_fg,
  CASE transaction_type_cd WHEN 150 THEN 1 ELSE 0 END AS return_fg
FROM headers JOIN opening USING (store_nr, receipt_date)
WHERE transaction_type_cd IN (100, 150) AND (is_open = 0 OR receipt_ts < opens_at OR receipt_ts > closes_at)""",
    "cash_headers": "SELECT * FROM headers WHERE transaction_id IN (FROM cash)",
    "cash_sales": f"""
SELECT {SIX}, transaction_id, cnt_receiptlines_sales, cnt_receiptlines_voids
FROM cash_headers WHERE register_id < 80 AND transaction_type_cd = 100""",
    "voided": f"""
SELECT DISTINCT {SIX}, cnt_receiptlines_sales, cnt_receiptlines_voids
FROM cash_sales JOIN lines USING (transaction_id) WHERE void_fg = 1""",
    # -- metrics
    "m01": f"SELECT DISTINCT {SIX} FROM outside WHERE outside_tolerance_fg = 1 AND return_fg = 0",
    "m02": f"SELECT DISTINCT {SIX} FROM outside WHERE return_fg = 1 AND register_id < 80",
    "m03": f"SELECT DISTINCT {SIX} FROM voided",
    "m04": f"SELECT DISTINCT {SIX} FROM voided WHERE cnt_receiptlines_sales = cnt_receiptlines_voids + 1",
    "cash_subtotals": "SELECT * FROM subtotals WHERE transaction_id IN (FROM cash)",
    "nth_last": f"""
SELECT {SIX}, transaction_id, receiptline_nr AS subtotal_line_nr FROM cash_subtotals s
WHERE 1 = (SELECT count(*) FROM cash_subtotals o
  WHERE o.transaction_id = s.transaction_id AND o.receiptline_nr > s.receiptline_nr)""",
    "after_subtotal": f"""
SELECT {SIX}, transaction_id, transaction_type_cd AS kind, ean_barcode, count(*) OVER receipt AS all_lines,
  sum(CASE WHEN transaction_type_cd BETWEEN 170 AND 173 THEN 1 ELSE 0 END) OVER receipt AS void_lines
FROM lines JOIN nth_last USING (transaction_id) WHERE receiptline_nr > subtotal_line_nr
WINDOW receipt AS (PARTITION BY transaction_id)""",
    "m05": f"""
SELECT DISTINCT {SIX} FROM after_subtotal WHERE transaction_id IN (
  SELECT transaction_id FROM after_subtotal WHERE all_lines = void_lines AND kind IN (171, 173)
  GROUP BY 1 HAVING count(DISTINCT ean_barcode) >= 2)""",
    "successors": f"""
SELECT transaction_id, {SIX}, lead(transaction_id) OVER (PARTITION BY receipt_date, store_nr, register_id
    ORDER BY receipt_ts, transaction_id) AS next_transaction_id
FROM headers WHERE register_id < 80 AND turnover_relevant_fg = 1""",
    "sold": "SELECT DISTINCT transaction_id, item_sid, ean_barcode FROM lines WHERE transaction_type_cd IN (101, 102)",
    "scans": """
SELECT * FROM lines WHERE transaction_type_cd IN (101, 102, 170, 172) AND transaction_id IN (FROM cash)""",
    "m06": f"""
SELECT DISTINCT {SIX}
FROM scans JOIN successors USING (transaction_id)
  JOIN sold ON sold.transaction_id = next_transaction_id AND sold.item_sid = scans.item_sid
    AND sold.ean_barcode = scans.ean_barcode
WHERE void_fg = 1 AND receiptline_nr =
  (SELECT max(receiptline_nr) FROM scans o WHERE o.transaction_id = scans.transaction_id)""",
    "m07": f"SELECT DISTINCT {SIX} FROM returns WHERE total_gross_val > -10 AND total_gross_val < -7",
    "m08": f"SELECT DISTINCT {SIX} FROM returns",
    "m09": f"SELECT DISTINCT {SIX} FROM unreferenced",
    "m10": f"SELECT DISTINCT {SIX} FROM cash_headers WHERE register_id < 80 AND transaction_type_cd = 200",
    "anomalies": """
SELECT store_nr, receipt_date, strftime(receipt_ts, '%H:%M:%S') AS receipt_time, register_id, cashier_id, receipt_id,
  kpi_id
FROM (SELECT *, 1 AS kpi_id FROM m01 UNION ALL SELECT *, 2 FROM m02 UNION ALL SELECT *, 3 FROM m03
  UNION ALL SELECT *, 4 FROM m04 UNION ALL SELECT *, 5 FROM m05 UNION ALL SELECT *, 6 FROM m06
  UNION ALL SELECT *, 7 FROM m07 UNION ALL SELECT *, 8 FROM m08 UNION ALL SELECT *, 9 FROM m09
  UNION ALL SELECT *, 10 FROM m10)""",
    # -- flagging
    "counts": f"""
SELECT store_nr, {WEEK} AS iso_week, kpi_id, cashier_id, count(receipt_id) AS kpi_count FROM anomalies GROUP BY ALL""",
    "active": """
SELECT store_nr, iso_week, kpi_id, cashier_id, kpi_count, total_receipts
FROM counts LEFT JOIN stats USING (store_nr, cashier_id, iso_week)""",
    "enough": """
SELECT * FROM active WHERE total_receipts > 30
  AND NOT (kpi_id IN (4, 5, 6, 7, 10) AND kpi_count < 2) AND NOT (kpi_id = 9 AND kpi_count < 3)""",
    "rule": """
SELECT * FROM (VALUES (1, 60, NULL, 0.90, 50.0::DOUBLE), (2, 8, NULL, 0.85, 100), (3, NULL, 0.97, 0.85, 1),
  (4, 12, NULL, 0.85, 100), (5, 2, NULL, 0.85, 100), (6, NULL, 0.92, 0.85, 100), (7, 3, NULL, 0.88, 100),
  (8, NULL, 0.97, 0.90, 5), (9, NULL, 0.95, 0.90, 100), (10, NULL, 0.95, 0.90, 20))
  AS t(kpi_id, absolute, red_p, orange_p, weight)""",
    "rated": """
SELECT enough.*, kpi_count::DOUBLE / total_receipts * 100 AS kpi_rate,
  kpi_count::DOUBLE / total_receipts * 100 * weight AS kpi_score
FROM enough JOIN rule USING (kpi_id)""",
    "limits": """
SELECT iso_week, kpi_id,
  CASE any_value(orange_p) WHEN 0.85 THEN quantile_disc(kpi_rate, 0.85) WHEN 0.88 THEN quantile_disc(kpi_rate, 0.88)
    WHEN 0.90 THEN quantile_disc(kpi_rate, 0.90) END AS orange_threshold,
  CASE any_value(red_p) WHEN 0.92 THEN quantile_disc(kpi_rate, 0.92) WHEN 0.95 THEN quantile_disc(kpi_rate, 0.95)
    WHEN 0.97 THEN quantile_disc(kpi_rate, 0.97) END AS red_threshold,
  count(cashier_id) AS population
FROM rated JOIN rule USING (kpi_id) GROUP BY iso_week, kpi_id""",
    "sure_limits": """
SELECT iso_week, kpi_id, CASE WHEN population >= 10 AND orange_threshold > 0 THEN orange_threshold END AS orange,
  CASE WHEN population >= 10 AND red_threshold > 0 THEN red_threshold END AS red
FROM limits""",
    "quota": """
SELECT *, CAST(trunc(2.5 * count(store_nr) OVER (PARTITION BY region_manager)) AS INTEGER) AS max_red_flags FROM org""",
    "levelled": """
SELECT rated.*, region_manager, max_red_flags,
  CASE WHEN kpi_count >= absolute THEN 3 WHEN kpi_rate >= red THEN 2 WHEN kpi_rate >= orange THEN 1 END AS level
FROM rated JOIN rule USING (kpi_id) LEFT JOIN sure_limits USING (iso_week, kpi_id) LEFT JOIN quota USING (store_nr)""",
    "ranked": """
SELECT *,
  CAST(rank() OVER (PARTITION BY iso_week, region_manager ORDER BY level DESC NULLS LAST, kpi_score DESC NULLS LAST)
    AS INTEGER) AS region_rank,
  CAST(rank() OVER (PARTITION BY iso_week, store_nr ORDER BY level DESC NULLS LAST, kpi_score DESC NULLS LAST)
    AS INTEGER) AS store_rank
FROM levelled""",
    "flags": """
SELECT iso_week, store_nr, cashier_id, kpi_id, flag FROM (SELECT *,
    CASE WHEN level = 3 OR (level = 2 AND region_rank <= max_red_flags) THEN 2 WHEN store_rank <= 3 THEN 1 END AS flag
  FROM ranked) WHERE flag IS NOT NULL""",
    # -- reporting
    "run": """
SELECT * FROM (VALUES ('2025-02', '20250113000000'), ('2025-03', '20250120000000')) AS t(iso_week, run_id)""",
    "regions": """
SELECT DISTINCT iso_week, store_nr, region_manager FROM org, run
WHERE iso_week IN (SELECT iso_week FROM flags) AND iso_week IN (SELECT strftime(receipt_date, '%G-%V') FROM anomalies)""",
    "found": f"""
SELECT * FROM (SELECT DISTINCT {WEEK} AS iso_week, store_nr, kpi_id, cashier_id, receipt_id FROM anomalies)
JOIN regions USING (iso_week, store_nr)""",
    "flagged": "SELECT flags.*, region_manager FROM flags JOIN regions USING (iso_week, store_nr)",
    "dense": """
SELECT iso_week, region_manager, store_nr, CAST(k AS INTEGER) AS kpi_id, f AS flag,
  (SELECT count(*) FROM flagged g WHERE g.iso_week = r.iso_week AND g.store_nr = r.store_nr
    AND g.region_manager = r.region_manager AND g.kpi_id = k AND g.flag = f) AS flag_count
FROM regions r, range(1, 11) AS kpis(k), (VALUES (1), (2)) AS colours(f)""",
    "with_total": """
SELECT iso_week, region_manager, store_nr, flag, 'KPI_' || lpad(CAST(kpi_id AS VARCHAR), 2, '0') AS kpi, flag_count
FROM dense
UNION ALL
SELECT iso_week, region_manager, store_nr, flag, 'GESAMT', CAST(sum(flag_count) AS BIGINT) FROM dense GROUP BY ALL""",
    "weekly_counts": "SELECT iso_week, region_manager, store_nr, flag, kpi, flag_count::DOUBLE AS v FROM with_total",
    "mean_counts": """
SELECT 'all' AS iso_week, region_manager, store_nr, flag, kpi, avg(flag_count) AS v FROM with_total
GROUP BY region_manager, store_nr, flag, kpi""",
}

LABELS = [f"KPI_{k:02d}" for k in range(1, 11)] + ["GESAMT"]


def _long_stats(counts: str) -> str:
    """Rows (metric, iso_week, kpi, value) of the statistics of a view of counts."""

    def rows(label: str, value: str, source: str) -> str:
        return (
            f"SELECT 'Anzahl Bediener ' || CASE flag WHEN 1 THEN 'orange' ELSE 'rot' END || ' | {label}' AS metric, "
            f"iso_week, kpi, round({value}, 3) AS value FROM {source} GROUP BY flag, iso_week, kpi"
        )

    by_region = f"(SELECT iso_week, flag, kpi, region_manager, sum(v) AS v FROM {counts} GROUP BY ALL)"
    parts = [rows("Landesweit", "sum(v)", counts)]
    for over, source in (("Filiale", counts), ("RL", by_region)):
        parts += [
            rows(f"⌀ {over}", "avg(v)", source),
            rows(f"Median {over}", "quantile_cont(v, 0.5)", source),
            rows(f"Max {over}", "max(v)", source),
            rows(f"Min {over}", "min(v)", source),
        ]
    return " UNION ALL ".join(parts)


def _wide_stats(counts: str, weekly: bool) -> str:
    columns = ", ".join(f"max(CASE WHEN kpi = '{label}' THEN value END) AS {label}" for label in LABELS)
    week = ", iso_week" if weekly else ""
    return f"SELECT metric{week}, {columns} FROM ({_long_stats(counts)}) GROUP BY metric{week}"


def _with_views(sql: str) -> str:
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(VIEWS[name])

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed) + "\n" + sql


def _check(kind: str, name: str, status: str, metric: str, source: str, message: str = "") -> str:
    told = f"{message} AS message, " if message else ""
    return (
        f"SELECT '{kind}' AS check_type, '{name}' AS check_name, {status} AS status, "
        f"{told}CAST({metric} AS DOUBLE) AS metric_value FROM {source}"
    )


def _empty(column: str) -> str:
    return f"'column ''{column}'' has ' || (count(*) - count({column})) || ' empty values'"


def _repeated(*keys: str) -> str:
    return "'key [" + ", ".join(f"''{k}''" for k in keys) + "] has ' || count(*) || ' duplicated values'"


def _different(column: str, least: int, count: str = "count(*)") -> str:
    return f"'column ''{column}'' has ' || {count} || ' distinct values, {least} required'"


def _lacking(colour: str) -> str:
    return f"CASE WHEN count(*) = 0 THEN 'every KPI has {colour} flags' ELSE 'KPIs without {colour} flags: ' || string_agg(kpi_id, ', ' ORDER BY kpi_id) END"


def _status(passed: str, otherwise: str = "FAIL") -> str:
    return f"CASE WHEN {passed} THEN 'PASS' ELSE '{otherwise}' END"


WEEK_1 = "receipt_date < DATE '2025-01-13'"
WEEK_2 = "receipt_date >= DATE '2025-01-13'"
MEAN = "(SELECT avg(cnt_receiptlines_sales) FROM headers WHERE " + WEEK_1 + ")"
LOG = (
    "SELECT 'run-{0}' AS run_id, '2025-01-20' AS run_timestamp, 'weekly' AS task_name, '{0}' AS table_name, "
    "'unique' AS check_type, 'unique' AS check_name, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'WARN' END AS status, "
    "'key [''transaction_id''] has ' || count(*) || ' duplicated values' AS message, CAST(count(*) AS DOUBLE) AS metric_value, CAST(NULL AS VARCHAR) AS metric_text "
    "FROM (SELECT transaction_id FROM {0} GROUP BY 1 HAVING count(*) > 1)"
)
DAILY = (
    "SELECT strftime(receipt_date, '%Y%m%d') AS run_id, 'headers' AS data_name, 'row_count_drift' AS metric_id, "
    "count(*)::DOUBLE AS metric_value, strftime(receipt_date, '%Y%m%d') AS run_timestamp FROM headers GROUP BY ALL"
)
ENTRIES = (
    "SELECT CAST(left(iso_week, 4) AS INTEGER) AS year, CAST(right(iso_week, 2) AS INTEGER) AS weeknumber, "
    "CAST(store_nr AS VARCHAR) AS StoreID, kpi_id AS KPITypeID, cashier_id AS ServicerID, flag AS AnomalyGrade, "
    "NULL AS OccurrenceDateTime, NULL AS TillNr, NULL AS ReceiptNr FROM flags UNION ALL "
    "SELECT CAST(strftime(receipt_date, '%G') AS INTEGER), CAST(strftime(receipt_date, '%V') AS INTEGER), "
    "CAST(a.store_nr AS VARCHAR), a.kpi_id, a.cashier_id, NULL, receipt_date || ' ' || receipt_time, register_id, "
    "CAST(receipt_id AS VARCHAR) FROM anomalies a JOIN flags f ON f.store_nr = a.store_nr AND f.kpi_id = a.kpi_id "
    "AND f.cashier_id = a.cashier_id AND f.iso_week = strftime(receipt_date, '%G-%V')"
)
FILES = (
    """SELECT * FROM (WITH a AS (SELECT iso_week, store_nr, kpi_id, string_agg('{"ServicerID":' || cashier_id || ',"AnomalyGrade":' || flag || '}', ',' ORDER BY cashier_id, flag) AS anomalies FROM flags GROUP BY ALL), """
    """r AS (SELECT f.iso_week, f.store_nr, f.kpi_id, string_agg('{"OccurrenceDateTime":"' || receipt_date || ' ' || receipt_time || '","TillNr":' || register_id || ',"ServicerID":' || f.cashier_id || ',"ReceiptNr":"' || receipt_id || '"}', """
    """',' ORDER BY receipt_date, receipt_time, register_id, f.cashier_id, CAST(receipt_id AS VARCHAR)) AS receipts FROM anomalies x JOIN flags f ON f.store_nr = x.store_nr AND f.kpi_id = x.kpi_id """
    """AND f.cashier_id = x.cashier_id AND f.iso_week = strftime(receipt_date, '%G-%V') GROUP BY ALL), """
    """k AS (SELECT iso_week, store_nr, string_agg('{"KPITypeID":' || kpi_id || ',"Anomalies":[' || anomalies || '],"Receipts":[' || coalesce(receipts, '') || ']}', ',' ORDER BY kpi_id) AS kpis """
    """FROM a LEFT JOIN r USING (iso_week, store_nr, kpi_id) GROUP BY ALL), """
    """w AS (SELECT CAST(left(iso_week, 4) AS INTEGER) AS y, CAST(right(iso_week, 2) AS INTEGER) AS n, string_agg('{"StoreID":"' || store_nr || '","KPI":[' || kpis || ']}', ',' ORDER BY store_nr) AS stores FROM k GROUP BY iso_week), """
    """t AS (SELECT 'dbp_' || y || '_' || n || '.json' AS document, '{"year":' || y || ',"weeknumber":' || n || ',"evaluation":[' || stores || ']}' AS text FROM w) """
    "SELECT document, octet_length(encode(text)) AS n_bytes, sha256(text) AS sha256 FROM t)"
)
DAY = "CAST(o_orderdate AS DATE)"
CODES = (
    "['AT','BE','BG','CH','CY','CZ','INT','DK','EE','ES','FI','FR','GB','GR','HR','HU','IE','IT','LT','LV','NI','NL',"
    "'DE','PL','PT','RO','SE','SI','SK','CS','MT','US','RS']"
)


def _metric(name: str) -> str:
    return f"SELECT {SIX} FROM {name}"


def _histogram(level: str, last: bool) -> str:
    only = "WHERE iso_week = (SELECT max(iso_week) FROM dense)" if last else ""
    member = (
        f"SELECT sum(CASE flag WHEN 2 THEN flag_count ELSE 0 END) AS count_red, sum(CASE flag WHEN 1 THEN flag_count "
        f"ELSE 0 END) AS count_orange, sum(flag_count) AS count_all FROM dense {only} GROUP BY iso_week, {level}"
    )
    kinds = " UNION ALL ".join(
        f"SELECT '{k}' AS kind, CAST({k} AS BIGINT) AS flags FROM ({member})"
        for k in ("count_red", "count_orange", "count_all")
    )
    return (
        f"SELECT kind, flags, count(*) AS occurrences, '{level}' AS level, {str(last).lower()} AS last_only "
        f"FROM ({kinds}) GROUP BY kind, flags"
    )


def _flag_counts(level: str) -> str:
    return (
        f"SELECT iso_week, CAST({level} AS VARCHAR) AS member, "
        "CAST(sum(flag_count) FILTER (flag = 2) AS BIGINT) AS count_red, "
        "CAST(sum(flag_count) FILTER (flag = 1) AS BIGINT) AS count_orange, "
        f"CAST(sum(flag_count) AS BIGINT) AS count_all, '{level}' AS level FROM dense GROUP BY iso_week, {level}"
    )


def _headline(label: str, source: str) -> str:
    return f"SELECT '{label}' AS measure, iso_week, count(*) AS n FROM {source} GROUP BY iso_week"


HEADER_TEXT = (
    f"SELECT {RAW}, transaction_type_cd, cnt_receiptlines_sales, cnt_receiptlines_voids, turnover_relevant_fg, "
    "cashier_id, total_gross_val, 'new' AS EXTRA FROM raw_header"
)
MAPE = (
    "SELECT metric, GESAMT AS total, round(({sum}) / 10, 2) AS mean, target, "
    "round(({dev}) / 10 * 100, 2) AS mape, {kpis} FROM (SELECT *, CASE metric "
    "WHEN 'Anzahl Bediener orange | Landesweit' THEN 130.0::DOUBLE "
    "WHEN 'Anzahl Bediener rot | Landesweit' THEN 56.0::DOUBLE END AS target FROM ({stats})) WHERE target IS NOT NULL"
).format(
    sum=" + ".join(LABELS[:10]),
    dev=" + ".join(f"abs(({k} - target) / target)" for k in LABELS[:10]),
    kpis=", ".join(LABELS[:10]),
    stats=_wide_stats("mean_counts", weekly=False),
)
EVIDENCE = (
    "SELECT CAST(strftime(receipt_date, '%G') AS INTEGER) AS year, CAST(strftime(receipt_date, '%V') AS INTEGER) "
    "AS weeknumber, strftime(receipt_date, '%G-%V') AS iso_week, store_nr, kpi_id, "
    "receipt_date || ' ' || receipt_time AS OccurrenceDateTime, register_id AS TillNr, cashier_id AS ServicerID, "
    "CAST(receipt_id AS VARCHAR) AS ReceiptNr FROM anomalies"
)
HISTORY = "SELECT a.*, run_id, run_id AS run_timestamp FROM anomalies a JOIN run ON iso_week = " + WEEK

_PLAIN = {
    "a01_receipt_key": f"SELECT receipt_id, receiptline_nr, {KEY} AS transaction_id FROM raw_line",
    "a02_in_scope": "SELECT receipt_id, store_nr, receipt_date FROM receipts WHERE client_id = 4 "
    "AND receipt_date BETWEEN DATE '2025-01-06' AND DATE '2025-01-12' AND store_nr BETWEEN 100 AND 1000000000",
    "a03_receipt_headers": "SELECT * FROM headers",
    "a04_receipt_lines": "SELECT * FROM lines",
    "a05_subtotal_lines": "SELECT * FROM subtotals",
    "a06_cash_only_receipts": "SELECT * FROM cash",
    "a07_return_receipts": "SELECT * FROM returns",
    "a08_returns_without_original": "SELECT * FROM unreferenced",
    "a09_opening_hours": "SELECT * FROM hours",
    "a10_store_org": "SELECT * FROM org",
    "a12_lower_columns": "SELECT * FROM orders",
    "a13_cast_columns": "SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderkey % 2 = 1 AS o_odd, "
    "o_orderstatus FROM orders",
    "a14_read_path": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "a15_read_csv": "SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem",
    "a16_load_table": "SELECT * FROM hours",
    "b01_save_table": "SELECT * FROM headers",
    "b02_archive_table": "SELECT run_id, run_id AS run_timestamp, transaction_id, store_nr "
    f"FROM headers JOIN run ON iso_week = {WEEK}",
    "b03_align_schema": HEADER_TEXT,
    "a11_read_query": "SELECT store_nr, transaction_type_cd, count(*) AS receipts, min(receipt_id) AS first_receipt, max(strftime(receipt_ts, '%Y-%m-%d %H:%M:%S')) AS last_ts "
    "FROM headers WHERE receipt_date >= DATE '2025-01-13' AND store_nr < 110 AND transaction_type_cd IN (100, 150) GROUP BY ALL",
    "b04_write_external": "SELECT * FROM org",
    "b05_stage_metrics": DAILY,
    "b06_commit_metrics": f"SELECT *, CASE WHEN run_id IN ('20250106', '20250110') THEN 'permanent' ELSE 'staging' END AS place FROM ({DAILY})",
    "b07_log_checks": LOG.format("headers") + " UNION ALL " + LOG.format("lines"),
    "b08_load_checks": LOG.format("lines"),
    "c01_cashier_stats": "SELECT * FROM stats",
    "c02_opening_timestamps": "SELECT * FROM opening",
    "c03_receipts_outside_hours": "SELECT * FROM outside",
    "c04_cash_sales": "SELECT * FROM cash_sales",
    "c05_voided_cash_receipts": "SELECT * FROM voided",
    "d00_as_metric": _metric("m08"),
    "d01_m01": _metric("m01"),
    "d02_m02": _metric("m02"),
    "d03_m03": _metric("m03"),
    "d04_m04": _metric("m04"),
    "d05a_nth_last_subtotal": "SELECT * FROM nth_last",
    "d05_m05": _metric("m05"),
    "d06a_next_receipt": "SELECT * FROM successors",
    "d06b_sold_articles": "SELECT * FROM sold",
    "d06_m06": _metric("m06"),
    "d07_m07": _metric("m07"),
    "d08_m08": _metric("m08"),
    "d09_m09": _metric("m09"),
    "d10_m10": _metric("m10"),
    "e01_merge_anomalies": "SELECT * FROM anomalies",
    "e02_kpi_counts": "SELECT * FROM counts",
    "e03_with_activity": "SELECT * FROM active",
    "e04_eligible": "SELECT * FROM enough",
    "e05_normalise": "SELECT * FROM rated",
    "e06_thresholds": "SELECT * FROM limits",
    "e07_robust": "SELECT iso_week, kpi_id, population, "
    "CASE WHEN population >= 100 AND orange_threshold > 0 THEN orange_threshold END AS orange_threshold, "
    "CASE WHEN population >= 100 AND red_threshold > 0 THEN red_threshold END AS red_threshold FROM limits",
    "e08_absolute_flags": "SELECT enough.*, CASE WHEN kpi_count >= absolute THEN 1 END AS absolute_flag "
    "FROM enough JOIN rule USING (kpi_id)",
    "e09_region_quota": "SELECT * FROM quota",
    "e10_initial_level": "SELECT iso_week, store_nr, cashier_id, kpi_id, level FROM levelled",
    "e11_rank_flags": "SELECT iso_week, store_nr, cashier_id, kpi_id, region_rank, store_rank FROM ranked",
    "e12_final_flags": "SELECT iso_week, store_nr, cashier_id, kpi_id, flag FROM (SELECT *, CASE WHEN level = 3 "
    "OR (level = 2 AND region_rank <= max_red_flags) THEN 2 WHEN store_rank <= 3 AND level IS NOT NULL THEN 1 END "
    "AS flag FROM ranked) WHERE flag IS NOT NULL",
    "e13_flag_cashiers": "SELECT * FROM flags",
    "week_flags": "SELECT * FROM flags",
    "f01_not_null": _check("not_null", "void", _status("count(*) = count(void_fg)"), "count(*) - count(void_fg)", "lines", _empty("void_fg"))
    + " UNION ALL "
    + _check(
        "not_null", "key", _status("count(*) = count(transaction_id)"), "count(*) - count(transaction_id)", "lines", _empty("transaction_id")
    ),
    "f02_unique": _check(
        "unique", "receipts", _status("count(*) = 0"), "count(*)",
        "(SELECT transaction_id FROM headers GROUP BY 1 HAVING count(*) > 1)", _repeated("transaction_id"),
    )
    + " UNION ALL "
    + _check(
        "unique", "articles", _status("count(*) = 0", "WARN"), "count(*)",
        "(SELECT transaction_id, item_sid FROM lines GROUP BY 1, 2 HAVING count(*) > 1)", _repeated("transaction_id", "item_sid"),
    ),
    "f03_distinct_count": _check(
        "distinct_count", "stores", _status("count(*) >= 15"), "count(*)", "(SELECT DISTINCT store_nr FROM anomalies)", _different("store_nr", 15)
    )
    + " UNION ALL "
    + _check(
        "distinct_count", "void", _status("count(*) >= 3", "WARN"), "count(*)", "(SELECT DISTINCT void_fg FROM lines)", _different("void_fg", 3)
    ),
    "f04_row_count_drift": " UNION ALL ".join(
        _check("row_count_drift", name, status, "now", f"(SELECT count(*) FILTER ({WEEK_1}) AS before, "
               f"count(*) FILTER ({WEEK_2}) AS now FROM anomalies)")
        for name, status in (
            ("usual", _status("now BETWEEN before * 0.7 AND before * 1.3")),
            ("doubled", _status("now BETWEEN before * 0.35 AND before * 0.65", "WARN")),
            ("first run", "'PASS'"),
        )
    ),
    "f05_avg_drift": " UNION ALL ".join(
        _check("avg_drift", name, status, value, f"(SELECT avg(cnt_receiptlines_sales) AS now, {MEAN} AS before "
               f"FROM headers WHERE {WEEK_2})")
        for name, status, value in (
            ("usual", _status("now BETWEEN before * 0.9 AND before * 1.1"), "now"),
            ("halved", _status("now BETWEEN before * 1.8 AND before * 2.2"), "now"),
            ("empty", "'WARN'", "NULL"),
        )
    ),
    "f06_run_checks": " UNION ALL ".join(
        [
            _check("not_null", "not_null", _status("count(*) = count(transaction_id)"),
                   "count(*) - count(transaction_id)", "lines", _empty("transaction_id")),
            _check("not_null", "void", _status("count(*) = count(void_fg)", "WARN"), "count(*) - count(void_fg)", "lines", _empty("void_fg")),
            _check("distinct_count", "distinct_count", _status("count(DISTINCT item_sid) >= 5"),
                   "count(DISTINCT item_sid)", "lines", _different("item_sid", 5, "count(DISTINCT item_sid)")),
            _check("unique", "unique", _status("count(*) = 0"), "count(*)",
                   "(SELECT transaction_id FROM lines GROUP BY transaction_id, receiptline_nr HAVING count(*) > 1)", _repeated("transaction_id", "receiptline_nr")),
            _check("row_count_drift", "row_count_drift", "'PASS'", "count(*)", "lines", "'row_count_drift is ' || count(*) || '.0, nothing to compare with'"),
        ]
    ),
    "f07_baselines": "SELECT 'row_count_drift:' || kpi_id AS metric_id, avg(n) AS baseline_value FROM "
    "(SELECT receipt_date, kpi_id, count(*) AS n FROM anomalies GROUP BY ALL) WHERE kpi_id IN (1, 3, 8) GROUP BY kpi_id",
    "f08_stores_red_flag": " UNION ALL ".join(
        _check("stores_red_flag", name, _status(f"n >= {least}", other),
               f"CASE WHEN n >= {least} THEN n ELSE {least} - n END",
               "(SELECT count(DISTINCT store_nr) FILTER (flag = 2) AS n, count(DISTINCT store_nr) AS stores FROM flags)",
               f"n || ' of ' || stores || ' stores have red flags, {least} required'")
        for name, least, other in (("few", 5, "FAIL"), ("many", 1000000, "WARN"))
    ),
    "f09_kpi_red_flag": _check(
        "kpi_red_flag", "kpi_red_flag", _status("count(*) = 0"), "count(*)",
        "(SELECT kpi_id FROM flags EXCEPT SELECT kpi_id FROM flags WHERE flag = 2)", _lacking("red"),
    )
    + " UNION ALL "
    + _check(
        "kpi_red_flag", "orange only", _status("count(*) = 0", "WARN"), "count(*)",
        "(SELECT DISTINCT kpi_id FROM flags WHERE flag = 1)", _lacking("red"),
    ),
    "f10_kpi_orange_flag": _check(
        "kpi_orange_flag", "kpi_orange_flag", _status("count(*) = 0"), "count(*)",
        "(SELECT kpi_id FROM flags WHERE kpi_id NOT IN (2, 5) EXCEPT SELECT kpi_id FROM flags WHERE flag = 1)", _lacking("orange"),
    )
    + " UNION ALL "
    + _check(
        "kpi_orange_flag", "red only", _status("count(*) = 0"), "count(*)",
        "(SELECT DISTINCT kpi_id FROM flags WHERE flag = 2 AND kpi_id NOT IN (2, 5))", _lacking("orange"),
    ),
    "g01_with_history": HISTORY,
    "g02_run_weeks": f"SELECT DISTINCT run_id, {WEEK} AS iso_week FROM ({HISTORY})",
    "g03_inconsistent_runs": "SELECT run_id, count(DISTINCT w) AS weeks FROM (SELECT CAST(isodow(receipt_date) - 1 AS "
    f"VARCHAR) AS run_id, {WEEK} AS w FROM anomalies UNION SELECT CAST(kpi_id % 2 AS VARCHAR), iso_week FROM flags) "
    "GROUP BY run_id HAVING count(DISTINCT w) > 1",
    "g03_inconsistent_weeks": f"SELECT {WEEK} AS iso_week, count(DISTINCT isodow(receipt_date)) AS runs FROM anomalies "
    "GROUP BY ALL HAVING count(DISTINCT isodow(receipt_date)) > 1",
    "g04_attach_week": "SELECT flags.*, run_id, run_id AS run_timestamp FROM flags JOIN run USING (iso_week)",
    "g05_common_weeks": "SELECT max(iso_week) AS iso_week FROM regions",
    "g06_store_regions": "SELECT * FROM regions",
    "g07_anomalies_with_region": "SELECT * FROM found",
    "g08_flags_with_region": "SELECT * FROM flagged",
    "g09_dense_flag_counts": "SELECT * FROM dense",
    "g10_flag_counts": _flag_counts("region_manager") + " UNION ALL " + _flag_counts("store_nr"),
    "g11_add_total_rows": "SELECT * FROM with_total",
    "g12_flag_stats": _wide_stats("weekly_counts", weekly=True),
    "g13_total_flag_stats": _wide_stats("mean_counts", weekly=False),
    "g14_weekly_flag_stats": _wide_stats("weekly_counts", weekly=True),
    "g15_anomalous_receipts_per_week": "SELECT iso_week, count(DISTINCT receipt_id) AS receipts FROM found GROUP BY 1",
    "g16_anomalies_per_week": "SELECT iso_week, kpi_id, count(*) AS anomalies FROM found GROUP BY 1, 2 UNION ALL "
    "SELECT iso_week, NULL, count(*) FROM found GROUP BY 1",
    "g17_anomalies_per_store": "SELECT iso_week, store_nr, count(*) AS anomalies FROM found GROUP BY 1, 2",
    "g18_anomaly_overview": "SELECT kpi_id, receipts, round(100.0::DOUBLE * receipts / (SELECT count(*) FROM (SELECT "
    "DISTINCT kpi_id, receipt_id FROM found)), 2) AS share_percent FROM (SELECT kpi_id, count(DISTINCT receipt_id) AS "
    "receipts FROM found GROUP BY 1)",
    "g19_flag_distribution": MAPE,
    "g20_melt_stats": f"SELECT metric, kpi, value FROM ({_long_stats('mean_counts')})",
    "g21_weekly_trend": "SELECT iso_week, 'KPI_' || lpad(CAST(kpi_id AS VARCHAR), 2, '0') AS series, count(*) AS anomalies "
    "FROM found GROUP BY 1, 2 UNION ALL SELECT iso_week, '# Auffälligkeiten', count(*) FROM found GROUP BY 1 UNION ALL "
    "SELECT iso_week, '# Bons mit Auffälligkeiten', count(DISTINCT receipt_id) FROM found GROUP BY 1",
    "g22_flag_histogram": " UNION ALL ".join(
        _histogram(level, last) for level in ("region_manager", "store_nr") for last in (False, True)
    ),
    "g23_box_summary": "SELECT iso_week, min(n)::DOUBLE AS minimum, quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.5) "
    "AS median, quantile_cont(n, 0.75) AS q3, max(n)::DOUBLE AS maximum FROM (SELECT iso_week, store_nr, "
    "count(*)::DOUBLE AS n FROM found GROUP BY 1, 2) GROUP BY 1",
    "g24_headline": "SELECT measure, iso_week, n AS value, n - before AS change FROM (SELECT *, lag(n) OVER (PARTITION "
    "BY measure ORDER BY iso_week) AS before, max(iso_week) OVER (PARTITION BY measure) AS latest FROM ("
    + " UNION ALL ".join(
        [
            _headline("Anzahl Auffälligkeiten", "found"),
            _headline("Anzahl auffällige Bons", "(SELECT DISTINCT iso_week, receipt_id FROM found)"),
            _headline("Anzahl Lupen", "(SELECT * FROM flagged WHERE flag = 2)"),
            _headline("Anzahl Fernglässer", "(SELECT * FROM flagged WHERE flag = 1)"),
        ]
    )
    + ")) WHERE iso_week = latest",
    "g25_anomaly_totals": "SELECT (SELECT count(*) FROM (SELECT DISTINCT receipt_id, kpi_id FROM found)) AS anomalies, "
    "(SELECT count(DISTINCT receipt_id) FROM found) AS receipts",
    "h01_evidence": EVIDENCE,
    "h02_flagged_evidence": f"SELECT * FROM ({EVIDENCE}) e WHERE EXISTS (SELECT 1 FROM flags f WHERE f.iso_week = "
    "e.iso_week AND f.store_nr = e.store_nr AND f.kpi_id = e.kpi_id AND f.cashier_id = e.ServicerID)",
    "h03_weekly_documents": ENTRIES,
    "h04_write_documents": ENTRIES,
    "h04_document_files": FILES,
    "h04_document_parts": f"SELECT e.*, grain FROM ({ENTRIES}) e, unnest(['week', 'store', 'kpi', 'day', 'register']) AS g(grain)",
    "week_documents": ENTRIES,
    "i01_iso_week": f"SELECT o_orderkey, strftime({DAY}, '%G-%V') AS week FROM orders",
    "i02_calendar_year_week": f"SELECT o_orderkey, year({DAY}) || '_' || strftime({DAY}, '%V') AS week FROM orders",
    "i03_iso_weeks_between": "SELECT o_orderkey, string_agg(week, ',' ORDER BY week) AS weeks FROM (SELECT DISTINCT "
    f"o_orderkey, strftime({DAY} + CAST(d AS INTEGER), '%G%V') AS week FROM orders, "
    "unnest(range(o_orderkey % 40 + 1)) AS days(d)) GROUP BY 1",
    "i04_ranges": "SELECT o_orderkey, CAST(o_orderkey % 400 + 1 AS INTEGER) AS days, "
    "CAST((CAST(date_trunc('week', later) AS DATE) - CAST(date_trunc('week', day) AS DATE)) // 7 + 1 AS INTEGER) AS weeks, "
    "CAST(date_diff('month', day, later) + 1 AS INTEGER) AS months "
    f"FROM (SELECT o_orderkey, {DAY} AS day, {DAY} + CAST(o_orderkey % 400 AS INTEGER) AS later FROM orders)",
    "i05_week_bounds": "SELECT o_orderkey, m - 7 AS monday, m - 1 AS sunday, m - 28 AS fourth_monday "
    f"FROM (SELECT o_orderkey, CAST(date_trunc('week', {DAY}) AS DATE) AS m FROM orders)",
    "i06_month_bounds": "SELECT o_orderkey, m AS first_day, CAST(m - INTERVAL 1 MONTH AS DATE) AS previous_first_day, "
    "m - 1 AS previous_last_day, strftime(m - 1, '%Y%m') AS previous_month, m + 9 AS tenth "
    f"FROM (SELECT o_orderkey, CAST(date_trunc('month', {DAY}) AS DATE) AS m FROM orders)",
    "i07_lookback_start": f"SELECT o_orderkey, {DAY} - 83 AS start FROM orders",
    "i08_period_bounds": "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'GM' ELSE 'EZ' END AS kind, "
    'CASE WHEN o_orderkey % 2 = 0 THEN CAST(m - INTERVAL 1 MONTH AS DATE) ELSE m END AS start, '
    'CASE WHEN o_orderkey % 2 = 0 THEN m - 1 ELSE m + 13 END AS "end" '
    f"FROM (SELECT o_orderkey, CAST(date_trunc('month', {DAY}) AS DATE) AS m FROM orders)",
    "i09_add_static_columns": f"SELECT o_orderkey, {DAY} AS day, '7' AS run_id, 1 AS attempt FROM orders",
    "i10_reindex": "SELECT code AS transaction_type_cd, (SELECT count(*) FROM headers WHERE transaction_type_cd = code) "
    "AS receipts FROM (VALUES (100), (150), (200), (300)) AS t(code)",
    "i11_percent_of_total": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS value, 100 * l_suppkey / "
    "(SELECT sum(l_suppkey)::DOUBLE FROM lineitem) AS percent FROM lineitem",
    "i12_client_id": f"SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN code ELSE lower(code) END AS code, "
    "CASE WHEN place >= 29 THEN CAST(place + 2 AS INTEGER) ELSE CAST(place + 1 AS INTEGER) END AS client_id "
    f"FROM (SELECT c_custkey, c_custkey % 33 AS place, {CODES}[c_custkey % 33 + 1] AS code FROM customer)",
}

_PLAIN["week_report"] = _PLAIN["g24_headline"]

ORACLES = {name: _with_views(sql) for name, sql in _PLAIN.items()}
