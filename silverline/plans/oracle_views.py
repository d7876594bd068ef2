"""DuckDB text of the derived views, used to build oracle SQL.

The driver registers only its own tables in DuckDB, so every oracle statement
carries the views it needs as CTEs. `with_views(sql, *names)` prepends them in
dependency order.
"""

from __future__ import annotations

from silverline.functions.reference import STATE_CODES

CODES = ",".join(STATE_CODES)

VIEW_SQL = {
    "bronze_users": f"""
SELECT c_custkey AS uuid,
  CASE WHEN c_custkey % 3 = 0 THEN '  ' || upper(c_name) || ' ' ELSE c_name END AS username,
  c_name AS name,
  CASE WHEN c_custkey % 2 = 0 THEN ' f' ELSE 'M' END AS sex,
  CASE WHEN c_custkey % 62 >= 59
       THEN 'Unit ' || CAST(c_custkey AS VARCHAR) || ' Box 1' || chr(10) || 'DPO '
       ELSE CAST(c_custkey AS VARCHAR) || ' Main St' || chr(10) || 'Lake ' || c_mktsegment || ', ' END
    || split_part('{CODES}', ',', CAST(c_custkey % 62 AS INT) + 1) || ' '
    || lpad(CAST(c_custkey * 37 % 100000 AS VARCHAR), 5, '0') AS address,
  ' ' || upper(c_name) || '@Example.com ' AS mail,
  CASE WHEN c_custkey % 97 = 0 THEN NULL
       ELSE DATE '1990-01-01' + CAST(c_custkey * 7 % 4000 AS INT) END AS birthdate
FROM customer""",
    "bronze_orders": """
SELECT l_orderkey * 10 + l_linenumber AS uuid, o_custkey AS user_uuid, l_shipdate AS date,
  CAST(l_quantity AS INT) AS quantity, ' ' || p_type AS product, l_partkey, l_suppkey, l_extendedprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "stg_orders": """
SELECT uuid AS order_id, user_uuid AS user_id, date AS ordered_at, quantity, lower(trim(product)) AS product
FROM (SELECT *, row_number() OVER (PARTITION BY uuid
        ORDER BY date DESC, l_partkey, l_suppkey, l_extendedprice, quantity) AS rn FROM bronze_orders) q
WHERE rn = 1""",
    "stg_users": """
SELECT c.uuid AS user_id, trim(c.username) AS username, lower(trim(c.username)) AS username_normalized, trim(c.name) AS name,
  upper(trim(c.sex)) AS sex, lower(trim(c.mail)) AS email, c.birthdate AS birthdate_original,
  CASE WHEN c.first_day < c.birthdate THEN NULL ELSE c.birthdate END AS birthdate,
  c.birthdate IS NOT NULL AND NOT coalesce(c.first_day < c.birthdate, false) AS birthdate_is_valid,
  c.lines[1] AS street,
  CASE WHEN regexp_matches(c.lines[2], '^.+, [A-Z]{2} [0-9]{5}$') THEN c.lines[2][: -11] END AS city,
  CASE WHEN regexp_matches(c.lines[2], '[A-Z]{2} [0-9]{5}$') THEN c.lines[2][-8:-7] END AS state,
  CASE WHEN regexp_matches(c.lines[2], '[A-Z]{2} [0-9]{5}$') THEN c.lines[2][-5:] END AS zip_code
FROM (SELECT *, string_split(address, chr(10)) AS lines,
        (SELECT CAST(min(ordered_at) AS DATE) FROM stg_orders WHERE stg_orders.user_id = bronze_users.uuid) AS first_day
      FROM bronze_users) c""",
    "sales": """
SELECT event_id AS order_id, user_id, ts AS ordered_at, CAST(floor(value) AS INT) + 1 AS quantity,
  event_type AS product FROM events""",
    "zip_states": f"""
SELECT lpad(CAST(c_custkey * 37 % 100000 AS VARCHAR), 5, '0') AS zip_code,
  split_part('{CODES}', ',', CAST((c_custkey + CASE WHEN c_custkey % 5 = 3 THEN 1 ELSE 0 END) % 62 AS INT) + 1) AS state
FROM customer WHERE c_custkey % 5 <> 4""",
    "dirty_orders": """
SELECT order_id, CASE WHEN order_id % 17 = 0 THEN -user_id ELSE user_id END AS user_id, ordered_at,
  CASE WHEN order_id % 19 = 0 THEN NULL WHEN order_id % 23 = 0 THEN 0 ELSE quantity END AS quantity, product
FROM stg_orders""",
    "dirty_users": """
SELECT user_id, username, CASE WHEN user_id % 13 = 0 THEN upper(username) ELSE username_normalized END AS username_normalized,
  birthdate_original, CASE WHEN user_id % 7 = 0 THEN birthdate_original ELSE birthdate END AS birthdate,
  CASE WHEN user_id % 11 = 0 THEN NOT birthdate_is_valid ELSE birthdate_is_valid END AS birthdate_is_valid
FROM stg_users""",
    "states": "SELECT unnest(string_split('" + CODES + "', ',')) AS code",
}

DEPENDS = {
    "stg_orders": ("bronze_orders",),
    "stg_users": ("bronze_users", "stg_orders"),
    "dirty_orders": ("stg_orders",),
    "dirty_users": ("stg_users",),
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in DEPENDS.get(n, ()):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(sql: str, *names: str) -> str:
    """Prefix `sql` (a SELECT, or `WITH ...`-less body) with the CTEs of `names`."""
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]}\n)" for n in _closure(names))
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
