"""SQL text that states the expected results over the given tables."""

from __future__ import annotations

EVENT_LOG = r"""
log AS (
  SELECT event_id AS change_id,
         CASE WHEN event_type = 'signup' THEN 'I'
              WHEN event_type IN ('click', 'purchase') THEN 'U'
              WHEN event_type = 'error' THEN 'D' ELSE 'X' END AS op,
         user_id, TRY_CAST(regexp_extract(props, '"k":\s*(-?\d+)', 1) AS INTEGER) AS k,
         value AS amount
  FROM events),
elog AS (
  SELECT *, CASE WHEN op IN ('I', 'U') AND coalesce(k, 99) >= 98 THEN 'invalid:k' END AS reason,
         CASE WHEN k < 20 THEN 1 WHEN k = 50 THEN 2 ELSE 0 END AS processed
  FROM log)"""

ORDER_LOG = r"""
ins AS (
  SELECT o_orderkey + 1 AS change_id, 'I' AS op, o_orderkey AS order_id,
         CASE WHEN o_orderkey % 11 <> 0 THEN split_part(c_name, '#', 1) END AS cust_first_name,
         CASE WHEN o_orderkey % 7 = 0 THEN '  ' ELSE ' ' || split_part(c_name, '#', 2) END AS cust_last_name,
         strftime(o_orderdate, '%d') AS order_day,
         CASE WHEN o_orderkey % 97 = 5 THEN '13' ELSE strftime(o_orderdate, '%m') END AS order_month,
         strftime(o_orderdate, '%Y') AS order_year,
         CAST(o_totalprice AS DECIMAL(12,2)) AS unit_price,
         CAST(o_orderkey % 9 + 1 AS DECIMAL(8,0)) AS quantity,
         CASE WHEN o_orderkey % 13 = 0 THEN 'CN' WHEN o_orderkey % 17 = 0 THEN NULL
              WHEN o_orderstatus = 'P' THEN 'NW' WHEN o_orderstatus = 'O' THEN 'SH'
              WHEN o_orderstatus = 'F' THEN 'DL' END AS status_code,
         (['US','CA','BR','MX','GB','DE','FR','AE','SA','IN','JP','CN','AU','ZZ'])[c_nationkey % 14 + 1]
           AS country_code
  FROM orders JOIN customer ON o_custkey = c_custkey),
raw AS (
  SELECT * FROM ins
  UNION ALL
  SELECT * REPLACE (order_id + 1000000000000000 AS change_id, 'U' AS op, 'SH' AS status_code)
  FROM ins WHERE order_id % 10 = 0
  UNION ALL
  SELECT o_orderkey + 2000000000000000, 'D', o_orderkey,
         NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM orders WHERE o_orderkey % 100 = 0),
mapped AS (
  SELECT change_id, op, order_id,
         coalesce(nullif(trim(trim(coalesce(cust_first_name, '')) || ' '
                  || trim(coalesce(cust_last_name, ''))), ''), 'UNKNOWN') AS customer_name,
         CAST(try_strptime(order_day || '/' || order_month || '/' || order_year, '%d/%m/%Y') AS DATE)
           AS order_date,
         CAST(round(unit_price * quantity, 2) AS DECIMAL(14,2)) AS total_amount,
         CASE status_code WHEN 'NW' THEN 'NEW' WHEN 'SH' THEN 'SHIPPED' WHEN 'DL' THEN 'DELIVERED'
              WHEN 'CN' THEN 'CANCELLED' ELSE 'UNKNOWN' END AS status,
         CASE WHEN country_code IN ('US','CA','BR','MX') THEN 'AMERICAS'
              WHEN country_code IN ('GB','DE','FR','AE','SA') THEN 'EMEA'
              WHEN country_code IN ('IN','JP','CN','AU') THEN 'APAC' ELSE 'OTHER' END AS region
  FROM raw),
elog AS (
  SELECT *, CASE WHEN op IN ('I', 'U') AND order_date IS NULL THEN 'invalid:order_date' END AS reason
  FROM mapped)"""

LINE_LOG = r"""
elog AS (
  SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey,
           l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS change_id,
         CASE l_returnflag WHEN 'A' THEN 'I' WHEN 'N' THEN 'U' WHEN 'R' THEN 'D' END AS op,
         l_orderkey, l_linenumber, l_linestatus, l_quantity AS quantity, l_extendedprice AS price,
         CASE WHEN l_returnflag IN ('A', 'N') AND l_quantity >= 40 THEN 'invalid:quantity' END AS reason
  FROM lineitem)"""


def replayed(log: str, keys: str, quarantine: bool = True, source: str = "elog", prefix: str = "",
             on_duplicate: str = "fail", on_missing: str = "noop", link_detail: str | None = None) -> str:
    """CTEs that end in ``<prefix>done``: the log with present, quarantined, outcome, detail."""
    before = f"OVER (PARTITION BY {keys} ORDER BY change_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    settles = "op = 'I'" if quarantine else "op = 'I' AND reason IS NULL"
    upsert = "WHEN op = 'U' AND reason IS NULL THEN TRUE" if on_missing == "upsert" else ""
    fails = "reason IS NOT NULL OR present" if on_duplicate == "fail" else "reason IS NOT NULL"
    blocked = f"coalesce(bool_or(ifail) {before}, FALSE)" if quarantine else "FALSE"
    touches = "TRUE" if on_missing == "upsert" else "present"
    inserted = "INSERTED" if link_detail is None else "LINK_FAILED"
    p = prefix
    names = ", ".join(k.strip() for k in keys.split(","))
    duplicate = "duplicate:" + names.replace(" ", "")
    head = f"{log},\n" if log else ""
    return f"""{head}{p}p1 AS (
  SELECT *, coalesce(last_value(CASE WHEN op = 'D' THEN FALSE WHEN {settles} THEN TRUE {upsert} END
                                IGNORE NULLS) {before}, FALSE) AS present
  FROM {source}),
{p}p2 AS (SELECT *, coalesce(op = 'I' AND ({fails}), FALSE) AS ifail FROM {p}p1),
{p}p3 AS (SELECT *, {blocked} AS quarantined FROM {p}p2),
{p}p4 AS (
  SELECT *, CASE WHEN op NOT IN ('I', 'U', 'D') THEN 'SKIPPED_BADROW'
                 WHEN quarantined THEN 'SKIPPED_QUARANTINED'
                 WHEN ifail THEN 'FAILED'
                 WHEN op = 'U' AND {touches} AND reason IS NOT NULL THEN 'FAILED'
                 WHEN op = 'I' THEN '{inserted}' WHEN op = 'D' THEN 'DELETED' ELSE 'UPDATED' END AS outcome
  FROM {p}p3),
{p}done AS (
  SELECT *, CASE outcome WHEN 'SKIPPED_BADROW' THEN 'unknown operation value ''' || op || ''''
                         WHEN 'SKIPPED_QUARANTINED' THEN 'business key is quarantined'
                         WHEN 'LINK_FAILED' THEN '{link_detail or ""}'
                         WHEN 'FAILED' THEN coalesce(reason, '{duplicate}') END AS detail,
         outcome IN ('INSERTED', 'LINK_FAILED') OR (outcome = 'UPDATED' AND {touches}) AS effective
  FROM {p}p4)"""


def imaged(keys: str, columns: str, prefix: str = "") -> str:
    """CTE ``<prefix>img``: final rows, for mappings where every write sets all columns.

    A key's life is cut into generations by its deletes; it is there at the end if some
    change created it in the last one, and its values are those of the last effective change.
    """
    p = prefix
    picks = ", ".join(
        f"last({c.strip()} ORDER BY change_id) FILTER (WHERE effective) AS {c.strip()}"
        for c in columns.split(",")
    )
    return f"""{p}g1 AS (
  SELECT *, count(*) FILTER (WHERE outcome = 'DELETED')
              OVER (PARTITION BY {keys} ORDER BY change_id) AS gen FROM {p}done),
{p}g2 AS (SELECT *, max(gen) OVER (PARTITION BY {keys}) AS last_gen FROM {p}g1),
{p}img AS (
  SELECT {keys}, {picks},
         min(change_id) FILTER (WHERE effective AND NOT present) AS row_id
  FROM {p}g2 WHERE gen = last_gen GROUP BY {keys}
  HAVING count(*) FILTER (WHERE effective) > 0)"""


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"
