"""The sample queries in SQL, for an independent engine to run over the same tables.

``LANDING`` holds the views of ``views.py``, ``MARTS`` the tables built from them; ``sql`` puts the ones a query names
in front of it.
"""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"
AS_OF_DATE = "DATE '2001-08-01'"
# Cut of the earlier state of a table that the upsert queries start from.
CUT = "TIMESTAMP '2001-06-01 00:00:00'"

CTES: dict[str, str] = {}

CTES["raw_orders"] = """
  SELECT CAST(o_orderkey AS VARCHAR) AS id,
         o_custkey % 100 AS store_id,
         o_custkey AS customer_id,
         CASE o_custkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'PLN' WHEN 2 THEN 'CHF' ELSE 'XXX' END AS currency_code,
         total AS total_price,
         disc AS discount,
         total - disc AS net_amount,
         CASE o_orderkey % 4 WHEN 0 THEN 'web' WHEN 1 THEN 'counter' WHEN 2 THEN 'courier' ELSE 'phone' END AS channel,
         CASE WHEN again > 0 THEN 'returned'
              WHEN o_orderkey % 6 < 2 THEN 'open' WHEN o_orderkey % 6 < 4 THEN 'closed'
              WHEN o_orderkey % 6 = 4 THEN 'returned' ELSE 'void' END AS status,
         o_orderdate AS created_at,
         o_orderdate + again * INTERVAL 1 SECOND AS updated_at,
         o_orderdate + again * INTERVAL 1 SECOND
           + (CASE WHEN o_orderkey % 100 < 3 THEN o_orderkey % 37 ELSE 0 END) * INTERVAL 1 HOUR AS source_ts
  FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(o_orderkey % 20 AS DECIMAL(2,0))
                    * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(20,4)) AS disc
        FROM orders) o
  JOIN (VALUES (0), (60)) AS v(again) ON again = 0 OR o_orderkey % 25 < 2"""

CTES["raw_items"] = """
  SELECT CONCAT(l_orderkey, '-', l_linenumber) AS id,
         CAST(l_orderkey AS VARCHAR) AS order_id,
         CASE WHEN l_partkey % 200 = 0 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
         l_quantity AS quantity,
         CAST(CAST(l_partkey % 3201 + 300 AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS unit_price,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS net_amount,
         CONCAT('SKU-', l_partkey % 9000 + 1000) AS default_code,
         l_partkey % 50 < 9 AS is_recommended,
         o_orderdate AS created_at,
         o_orderdate AS updated_at,
         l_shipdate AS source_ts,
         l_partkey AS part_key,
         l_suppkey AS supp_key
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["raw_stores"] = """
  SELECT s_suppkey AS id,
         CONCAT(s_name, CASE WHEN older > 0 THEN ' (old)' ELSE '' END) AS name,
         CASE s_nationkey % 10 WHEN 0 THEN 'ZA' WHEN 1 THEN 'CA' WHEN 2 THEN 'PE' WHEN 3 THEN 'IE'
              WHEN 4 THEN 'TH' WHEN 5 THEN 'RS' WHEN 6 THEN 'NZ' WHEN 7 THEN 'UY'
              WHEN 8 THEN 'IT' ELSE 'VN' END AS country_code,
         CASE s_nationkey % 10 WHEN 0 THEN 'ZAR' WHEN 1 THEN 'CAD' WHEN 2 THEN 'PEN' WHEN 3 THEN 'EUR'
              WHEN 4 THEN 'THB' WHEN 5 THEN 'RSD' WHEN 6 THEN 'NZD' WHEN 7 THEN 'UYU'
              WHEN 8 THEN 'EUR' ELSE 'VND' END AS currency_code,
         CASE s_nationkey % 10 WHEN 0 THEN 'Africa/Johannesburg' WHEN 1 THEN 'America/Toronto' WHEN 2 THEN 'America/Lima'
              WHEN 3 THEN 'Europe/Dublin' WHEN 4 THEN 'Asia/Bangkok' WHEN 5 THEN 'Europe/Belgrade'
              WHEN 6 THEN 'Pacific/Auckland' WHEN 7 THEN 'America/Montevideo' WHEN 8 THEN 'Europe/Rome' ELSE 'Asia/Ho_Chi_Minh' END AS timezone,
         s_suppkey % 20 < 13 AS is_franchise,
         s_suppkey % 20 = 0 OR older > 0 AS is_dev,
         CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey % 50 = 1 END AS is_excluded,
         CAST(DATE '1995-01-01' + CAST(19 * s_suppkey AS INTEGER) AS DATE) AS opening_date,
         TIMESTAMP '2001-08-01 00:00:00' - older * INTERVAL 1 DAY AS source_ts
  FROM supplier JOIN (VALUES (0), (1)) AS v(older) ON older = 0 OR s_suppkey % 10 = 3"""

CTES["raw_rates"] = """
  SELECT currency_code, exchange_date,
         CAST(ROUND(base * CAST((990 + dayofyear(exchange_date) % 21 - 100 * copy)
                                AS DECIMAL(5,0)) * CAST(0.001 AS DECIMAL(4,3)), 6) AS DECIMAL(17,9)) AS rate_to_usd
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS exchange_date FROM orders) d
  CROSS JOIN (VALUES ('USD', CAST(1.0 AS DECIMAL(9,6))), ('PLN', CAST(0.20 AS DECIMAL(9,6))),
                     ('CHF', CAST(1.08 AS DECIMAL(9,6)))) AS c(currency_code, base)
  JOIN (VALUES (0), (1)) AS v(copy) ON copy = 0 OR day(exchange_date) = 1"""

CTES["rates"] = """
  SELECT currency_code, exchange_date, MAX(rate_to_usd) AS rate FROM raw_rates GROUP BY 1, 2"""

CTES["latest_orders"] = """
  SELECT id AS order_id, store_id, customer_id, currency_code,
         CAST(total_price AS DECIMAL(38,9)) AS total_price_local, CAST(discount AS DECIMAL(38,9)) AS discount_local,
         CAST(net_amount AS DECIMAL(38,9)) AS net_amount_local, channel, status, created_at, updated_at
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY source_ts DESC) AS rn FROM raw_orders) WHERE rn = 1"""

CTES["orders_clean"] = """
  SELECT order_id, store_id, customer_id, channel, status, created_at, updated_at, o.currency_code,
         total_price_local, discount_local, net_amount_local,
         CAST(CAST(total_price_local AS DECIMAL(20,9)) * rate AS DECIMAL(38,9)) AS total_price_usd,
         CAST(CAST(discount_local AS DECIMAL(20,9)) * rate AS DECIMAL(38,9)) AS discount_usd,
         CAST(CAST(net_amount_local AS DECIMAL(20,9)) * rate AS DECIMAL(38,9)) AS net_amount_usd
  FROM latest_orders o LEFT JOIN rates r
    ON r.currency_code = o.currency_code AND r.exchange_date = CAST(o.created_at AS DATE)"""


def items(where: str = "TRUE", raw: str = "raw_items", partition: str = "id", order: str = "source_ts DESC") -> str:
    return f"""
  SELECT id AS order_item_id, order_id, TRY_CAST(product_id AS BIGINT) AS product_id,
         CAST(ROUND(quantity) AS BIGINT) AS quantity, CAST(unit_price AS DECIMAL(38,9)) AS unit_price_local,
         CAST(net_amount AS DECIMAL(38,9)) AS net_amount_local, default_code, is_recommended, created_at, updated_at
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {partition}
          ORDER BY {order}, part_key DESC, supp_key DESC, net_amount DESC) AS rn
        FROM {raw} WHERE {where}) WHERE rn = 1"""


CTES["items_clean"] = items()
# The table as it was when the feed had reached CUT.
CTES["items_before"] = items(f"source_ts <= {CUT}")
CTES["new_items"] = items(f"created_at >= (SELECT MAX(created_at) FROM items_before) - INTERVAL 7 DAY")
CTES["naive_items"] = items(f"created_at > (SELECT MAX(created_at) FROM items_before)")


# The feed of a job that ran every day, with ten days without events, and what its target held before each run.
CTES["outage_feed"] = """
  SELECT * REPLACE (CASE WHEN source_ts >= TIMESTAMP '1998-03-01' AND source_ts < TIMESTAMP '1998-03-11'
                         THEN TIMESTAMP '1998-03-11' ELSE source_ts END AS source_ts)
  FROM raw_items WHERE NOT (created_at >= TIMESTAMP '1998-03-01' AND created_at < TIMESTAMP '1998-03-11')"""
CTES["outage_held"] = f"""
  SELECT run, MAX(top) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
  FROM (SELECT CAST(d AS DATE) AS run FROM generate_series(TIMESTAMP '1995-01-01', {AS_OF}, INTERVAL 1 DAY) AS g(d)) days
  LEFT JOIN (SELECT GREATEST(CAST(source_ts AS DATE), DATE '1995-01-01') AS run, MAX(created_at) AS top
             FROM outage_feed GROUP BY 1) tops USING (run)"""


def upserted(target: str, source: str, key: str, cond: str = "TRUE", keep: tuple[str, ...] = ()) -> str:
    """Content of ``target`` after the merge; ``cond`` restricts matching, columns in ``keep`` are not updated."""
    repl = ", ".join(f"t.{c} AS {c}" for c in keep)
    updated = f"s.* REPLACE ({repl})" if keep else "s.*"
    return f"""
  SELECT {updated} FROM {source} s JOIN {target} t ON s.{key} = t.{key} AND ({cond})
  UNION ALL SELECT s.* FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE t.{key} = s.{key} AND ({cond}))
  UNION ALL SELECT t.* FROM {target} t WHERE NOT (({cond}) AND t.{key} IN (SELECT {key} FROM {source}))"""


CTES["items_after"] = upserted("items_before", "new_items", "order_item_id")
CTES["naive_after"] = upserted("items_before", "naive_items", "order_item_id")

# The second run of the items increment by moment of arrival, whose target window is as wide as its source window.
CTES["new_by_arrival"] = items("source_ts >= (SELECT MAX(created_at) FROM items_before) - INTERVAL 7 DAY")
CTES["arrival_after"] = upserted(
    "items_before",
    "new_by_arrival",
    "order_item_id",
    "t.created_at >= date_trunc('day', (SELECT MAX(created_at) FROM items_before) - INTERVAL 7 DAY)",
)

CTES["stores_clean"] = """
  SELECT id AS store_id, name AS store_name, country_code, currency_code, timezone, is_franchise, opening_date,
         CAST(opening_date AS TIMESTAMP) AS created_at, source_ts AS updated_at
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY source_ts DESC) AS rn FROM raw_stores)
  WHERE rn = 1 AND COALESCE(is_dev, FALSE) = FALSE AND COALESCE(is_excluded, FALSE) = FALSE"""

_REGION = """CASE WHEN country_code IN ('BR', 'AR', 'CL', 'CO', 'MX', 'PE', 'UY') THEN 'LATAM'
              WHEN country_code IN ('US', 'CA') THEN 'NA'
              WHEN country_code IN ('GB', 'IE', 'FR', 'DE', 'IT', 'ES', 'PT', 'CZ', 'RS') THEN 'EMEA'
              WHEN country_code IN ('JP', 'KR', 'SG', 'MY', 'TH', 'ID', 'PH', 'VN', 'KZ') THEN 'APAC' ELSE 'Other' END"""
_AGE = f"date_diff('day', opening_date, {AS_OF_DATE})"
_MATURITY = f"""CASE WHEN {_AGE} < 90 THEN 'Ramp-Up' WHEN {_AGE} < 365 THEN 'Young'
              WHEN {_AGE} < 730 THEN 'Mature' ELSE 'Established' END"""

CTES["dim_stores"] = f"""
  SELECT store_id, store_name, country_code, currency_code, timezone, is_franchise, opening_date,
         {_REGION} AS region, {_AGE} AS store_age_days, {_MATURITY} AS store_maturity, created_at, updated_at
  FROM stores_clean"""


def rollup(items_from: str = "items_clean", where: str = "TRUE") -> str:
    return f"""
  SELECT order_id, COUNT(*) AS item_count, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
         CAST(SUM(CASE WHEN is_recommended THEN 1 ELSE 0 END) AS BIGINT) AS recommended_count
  FROM {items_from} WHERE {where} GROUP BY order_id"""


def fact(rolled: str, orders_from: str = "orders_clean", where: str = "TRUE") -> str:
    return f"""
  SELECT o.order_id, store_id, customer_id, channel, status, currency_code, total_price_local, discount_local,
         net_amount_local, total_price_usd, discount_usd, net_amount_usd,
         COALESCE(item_count, 0) AS item_count, COALESCE(total_quantity, 0) AS total_quantity,
         COALESCE(recommended_count, 0) AS recommended_item_count, created_at, updated_at
  FROM {orders_from} o LEFT JOIN {rolled} r ON r.order_id = o.order_id WHERE {where}"""


CTES["item_rollup"] = rollup()
CTES["item_rollup_30d"] = rollup(where=f"created_at >= {AS_OF} - INTERVAL 30 DAY")
CTES["fct_orders"] = fact("item_rollup")
CTES["fct_window"] = fact("item_rollup_30d", where=f"o.created_at >= {AS_OF} - INTERVAL 30 DAY")
# The fact as it was at CUT: orders created until then, items as recorded until then.
CTES["rollup_before"] = rollup("items_before")
CTES["rollup_after"] = rollup("items_after")
CTES["fct_before"] = fact("rollup_before", where=f"o.created_at <= {AS_OF} - INTERVAL 10 DAY")
CTES["fct_merged"] = upserted(
    "fct_before",
    "fct_window",
    "order_id",
    f"CAST(t.created_at AS DATE) >= {AS_OF_DATE} - 30",
    keep=("created_at",),
)

# The fact merge after two runs of the hot path, at CUT and at AS_OF.
CTES["orders_at_cut"] = CTES["orders_clean"].replace("latest_orders", "latest_at_cut")
CTES["latest_at_cut"] = CTES["latest_orders"].replace("FROM raw_orders)", f"FROM raw_orders WHERE source_ts <= {CUT})")
CTES["rollup_run1"] = rollup("items_before", f"created_at >= {CUT} - INTERVAL 30 DAY")
CTES["fct_run1"] = fact("rollup_run1", "orders_at_cut", f"o.created_at >= {CUT} - INTERVAL 30 DAY")
# Increment matched only against the last 14 days of the items.
CTES["items_run2"] = upserted(
    "items_before", "new_items", "order_item_id", f"CAST(t.created_at AS DATE) >= {AS_OF_DATE} - 14"
)
CTES["rollup_run2"] = rollup("items_run2", f"created_at >= {AS_OF} - INTERVAL 30 DAY")
CTES["fct_source2"] = fact("rollup_run2", where=f"o.created_at >= {AS_OF} - INTERVAL 30 DAY")
CTES["fct_run2"] = upserted(
    "fct_run1", "fct_source2", "order_id", f"CAST(t.created_at AS DATE) >= {AS_OF_DATE} - 30", keep=("created_at",)
)

CTES["baseline"] = f"SELECT * FROM items_clean WHERE CAST(created_at AS DATE) >= {AS_OF_DATE} - 90"
CTES["simulated"] = items(f"CAST(created_at AS DATE) >= {AS_OF_DATE} - 90")
CTES["simulated_60"] = items(f"CAST(created_at AS DATE) >= {AS_OF_DATE} - 60")


def _per_key(a: str, b: str, key: str, cols: list[str], amount: str) -> str:
    """One row for each key of either side: rows, money and, where both sides have the key, pairs that differ."""
    differs = " OR ".join(f"x.{c} IS DISTINCT FROM y.{c}" for c in cols) or "FALSE"
    return f"""
  SELECT coalesce(p.k, q.k) AS k, coalesce(p.n, 0) AS n_a, coalesce(q.n, 0) AS n_b, p.m AS m_a, q.m AS m_b, coalesce(d.n, 0) AS differing
  FROM (SELECT {key} AS k, COUNT(*) AS n, SUM({amount}) AS m FROM {a} GROUP BY 1) p
  FULL JOIN (SELECT {key} AS k, COUNT(*) AS n, SUM({amount}) AS m FROM {b} GROUP BY 1) q ON p.k = q.k
  LEFT JOIN (SELECT x.{key} AS k, COUNT(*) AS n FROM {a} x JOIN {b} y ON x.{key} = y.{key} WHERE {differs} GROUP BY 1) d
    ON d.k = coalesce(p.k, q.k)"""


def _checks(totals: str, checks: dict[str, str]) -> str:
    """A row for each check over the one row of ``totals``."""
    names, values = ", ".join(f"'{n}'" for n in checks), ", ".join(f"CAST({v} AS BIGINT)" for v in checks.values())
    return f"""
  SELECT unnest([{names}]) AS check_name, unnest([{values}]) AS failing_rows FROM ({totals})"""


_TOTALS = """
  SELECT SUM(CASE WHEN n_b = 0 THEN n_a ELSE 0 END) AS only_a, SUM(CASE WHEN n_a = 0 THEN n_b ELSE 0 END) AS only_b,
         SUM(n_a) - SUM(n_b) AS more_rows, COUNT(k) FILTER (n_a > 0) - COUNT(k) FILTER (n_b > 0) AS more_keys,
         SUM(differing) AS differing, SUM(m_a) - SUM(m_b) AS more_money FROM per_key"""


def verdict(a: str, b: str, key: str, amount: str) -> str:
    checks = {
        "C: rows lost (A but not B)": "only_a",
        "D: rows wrongly added (B but not A)": "only_b",
        "parity: total row count": "abs(more_rows)",
        "parity: distinct keys": "abs(more_keys)",
        f"parity: sum({amount})": "round(round(abs(more_money), 2), 0)",
    }
    return f", per_key AS ({_per_key(a, b, key, [], amount)}) {_checks(_TOTALS, checks)}"


def parity(a: str, live: str, key: str, cols: list[str], amount: str) -> str:
    days = f"(SELECT CAST(MIN(created_at) AS DATE) AS lo, CAST(MAX(created_at) AS DATE) AS hi FROM {a})"
    inside = f"(SELECT {live}.* FROM {live}, {days} WHERE CAST(created_at AS DATE) BETWEEN lo AND hi)"
    checks = {
        "rows_only_in_baseline": "only_a",
        "rows_only_in_live": "only_b",
        "rows_with_field_divergence": "differing",
        f"sum_{amount.removesuffix('_local')}_diff_cents": "round(abs(more_money), 2) * 100",
    }
    return f", inside AS {inside}, per_key AS ({_per_key(a, 'inside', key, cols, amount)}) {_checks(_TOTALS, checks)}"


ITEM_FIELDS = ["order_id", "product_id", "quantity", "net_amount_local", "default_code", "is_recommended"]
FACT_FIELDS = ["store_id", "customer_id", "channel", "status", "total_price_usd", "item_count", "total_quantity"]


def sql(body: str) -> str:
    """``body`` behind the WITH clause of every CTE it needs, directly or through another."""
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for name, cte in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(cte)
                needed[name] = None

    visit(body)
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    joint = "" if body.lstrip().startswith(",") else "\n"
    return f"WITH {head}{joint}{body}"


# Messy text of each row of lineitem: integers, decimals, flags, dates, moments and junk.
MESSY = """
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
         CASE l_partkey % 8 WHEN 0 THEN '' WHEN 1 THEN '12.5' WHEN 2 THEN 'abc' WHEN 3 THEN 'yes' WHEN 4 THEN 'TRUE'
              WHEN 5 THEN CAST(l_partkey AS VARCHAR) WHEN 6 THEN strftime(l_shipdate, '%Y-%m-%d')
              ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') END AS t,
         l_extendedprice / 8 AS x
  FROM lineitem"""
CTES["messy"] = MESSY

ORACLE: dict[str, str] = {
    "safe_casts": sql("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, t AS as_text,
       CASE WHEN regexp_full_match(t, '[+-]?[0-9]+') THEN CAST(t AS BIGINT) END AS as_long,
       CASE WHEN regexp_full_match(t, '[+-]?[0-9]+(\\.[0-9]+)?') THEN CAST(t AS DECIMAL(38,9)) END AS as_money,
       CASE lower(t) WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END AS as_flag,
       TRY_CAST(CASE WHEN t LIKE '____-__-__%' THEN replace(replace(t, 'T', ' '), 'Z', '') END AS TIMESTAMP) AS as_moment,
       CASE WHEN length(t) = 10 AND t LIKE '____-__-__' THEN CAST(t AS DATE) END AS as_day,
       CAST(ROUND(x, 0) AS BIGINT) AS rounded,
       CAST(ROUND(l_suppkey + CAST(0.4999999999 AS DOUBLE), 0) AS BIGINT) AS below_half,
       CAST(l_suppkey AS BIGINT) AS below_half_wide
FROM messy"""),
    "latest_orders": sql("SELECT * FROM latest_orders"),
    "latest_items": sql("""
SELECT id, order_id, product_id, quantity, net_amount, created_at, source_ts FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY source_ts DESC, part_key DESC, supp_key DESC, net_amount DESC)
    AS rn FROM raw_items) WHERE rn = 1"""),
    "latest_items_by_source": sql("""
SELECT id, supp_key % 3 AS source_system, order_id, product_id, quantity, net_amount, created_at, source_ts FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY id, supp_key % 3
    ORDER BY source_ts DESC, part_key DESC, supp_key DESC, net_amount DESC) AS rn FROM raw_items) WHERE rn = 1"""),
    "usd_conversion": sql("""
SELECT order_id, currency_code, total_price_local, total_price_usd, discount_usd, net_amount_usd
FROM orders_clean WHERE total_price_usd IS NOT NULL"""),
    "usd_conversion_wide": """
SELECT order_id, currency_code, CAST(units // 1000000000 AS VARCHAR) AS usd_whole, CAST(units % 1000000000 AS BIGINT) AS usd_fraction
FROM (SELECT o_orderkey AS order_id, ['TINY', 'VAST', 'LEAST'][o_orderkey % 3 + 1] AS currency_code,
             (2 * amount * num + den) // (2 * den) AS units
      FROM (SELECT *, (o_orderkey % 9973 + 1)::HUGEINT * 10000000000000000000000 + o_custkey AS amount,
                   [4, 250000001, 7][o_orderkey % 3 + 1]::HUGEINT AS num,
                   [10000000000, 1, 1000000000000][o_orderkey % 3 + 1]::HUGEINT AS den FROM orders))""",
    "usd_missing_rate": sql("""
SELECT currency_code, COUNT(*) AS orders_without_rate, SUM(total_price_local) AS total_price_local
FROM orders_clean WHERE total_price_usd IS NULL GROUP BY currency_code"""),
    "day_part": """
SELECT event_id, hour AS local_hour,
       CASE WHEN hour BETWEEN 6 AND 10 THEN 'Morning' WHEN hour BETWEEN 11 AND 14 THEN 'Lunch'
            WHEN hour BETWEEN 15 AND 18 THEN 'Afternoon' WHEN hour BETWEEN 19 AND 22 THEN 'Evening'
            ELSE 'Night' END AS day_part
FROM (SELECT event_id, CAST(EXTRACT(hour FROM (ts AT TIME ZONE 'UTC') AT TIME ZONE tz) AS INTEGER) AS hour
      FROM (SELECT event_id, ts, CASE user_id % 5 WHEN 0 THEN 'America/Sao_Paulo' WHEN 1 THEN 'America/New_York'
                                     WHEN 2 THEN 'Europe/London' WHEN 3 THEN 'Asia/Tokyo' END AS tz FROM events))""",
    "region": sql(f"""
SELECT {_REGION} AS region, COUNT(*) AS stores FROM (SELECT DISTINCT id, country_code FROM raw_stores) GROUP BY 1"""),
    "store_maturity": sql(f"""
SELECT id AS store_id, opening_date, {_AGE} AS store_age_days, {_MATURITY} AS store_maturity
FROM raw_stores WHERE source_ts = {AS_OF}"""),
    "orders_clean": sql("SELECT * FROM orders_clean"),
    "order_items_clean": sql("SELECT * FROM items_clean"),
    "stores_clean": sql("SELECT * FROM stores_clean"),
    "dim_stores": sql("SELECT * FROM dim_stores"),
    "item_rollup": sql("SELECT * FROM item_rollup"),
    "item_rollup_30d": sql("SELECT * FROM item_rollup_30d"),
    "fct_orders": sql("SELECT * FROM fct_orders"),
    "item_rollup_by_deltas": sql("SELECT * FROM rollup_after"),
    "fct_orders_bucketed": sql("SELECT * FROM fct_orders"),
    "fct_orders_window": sql("SELECT * FROM fct_window"),
    "retro_window": sql("SELECT * FROM new_items"),
    "retro_window_arrival": sql(
        f"SELECT * FROM ({items('source_ts >= (SELECT MAX(created_at) FROM items_before) - INTERVAL 7 DAY')})"
    ),
    "naive_window_loss": sql("""
SELECT n.* FROM new_items n WHERE n.order_item_id NOT IN (SELECT order_item_id FROM naive_after)"""),
    "items_upsert": sql("SELECT * FROM items_after"),
    "items_upsert_twice": sql("SELECT * FROM items_after"),
    "fct_orders_merge": sql("SELECT * FROM fct_merged"),
    "baseline_profile": sql("""
SELECT 'baseline_snapshot' AS check_name, COUNT(*) AS total_rows, COUNT(DISTINCT order_item_id) AS distinct_keys,
       MIN(created_at) AS window_start, MAX(created_at) AS window_end, SUM(net_amount_local) AS sum_net_amount_local
FROM baseline"""),
    "baseline_named": sql("""
SELECT 'baseline_snapshot' AS check_name, COUNT(*) AS total_rows, COUNT(DISTINCT order_item_id) AS distinct_keys,
       MIN(created_at) AS window_start, MAX(created_at) AS window_end, SUM(net_amount_local) AS sum_net_amount_local
FROM baseline"""),
    "simulate_incremental": sql("SELECT * FROM simulated"),
    "rows_lost": sql("""
SELECT a.* FROM baseline a LEFT JOIN simulated_60 b ON a.order_item_id = b.order_item_id
WHERE b.order_item_id IS NULL"""),
    "rows_added": sql("""
SELECT b.* FROM items_after b LEFT JOIN items_before a ON a.order_item_id = b.order_item_id
WHERE a.order_item_id IS NULL"""),
    "abcd_verdict": sql(verdict("baseline", "simulated", "order_item_id", "net_amount_local")),
    "abcd_verdict_short_window": sql(verdict("items_clean", "items_after", "order_item_id", "net_amount_local")),
    "field_divergence": sql(f"""
SELECT a.order_item_id, CAST(1 AS BIGINT) AS rows_a, CAST(1 AS BIGINT) AS rows_b, CAST(1 AS BIGINT) AS diverging_rows
FROM items_clean a JOIN items_before l ON a.order_item_id = l.order_item_id
WHERE {" OR ".join(f"a.{c} IS DISTINCT FROM l.{c}" for c in ITEM_FIELDS)}"""),
    "field_divergence_events": sql("""
SELECT a.id, MAX(a.n) AS rows_a, MAX(b.n) AS rows_b, COUNT(*) AS diverging_rows
FROM (SELECT *, COUNT(*) OVER (PARTITION BY id) AS n FROM raw_items WHERE supp_key % 2 = 0) a
JOIN (SELECT *, COUNT(*) OVER (PARTITION BY id) AS n FROM raw_items WHERE supp_key % 2 = 1) b ON a.id = b.id
WHERE a.product_id IS DISTINCT FROM b.product_id OR a.is_recommended IS DISTINCT FROM b.is_recommended
GROUP BY a.id"""),
    "parity_report": sql(parity("baseline", "items_after", "order_item_id", ITEM_FIELDS, "net_amount_local")),
    "drift_full_vs_incremental": sql(parity("fct_orders", "fct_merged", "order_id", FACT_FIELDS, "net_amount_local")),
    "lag_profile": sql("""
SELECT unnest([0.5, 0.9, 0.99, 1.0])::DOUBLE AS quantile,
       unnest(quantile_cont(CAST(epoch(source_ts) - epoch(created_at) AS DOUBLE), [0.5, 0.9, 0.99, 1.0])) AS lag_seconds
FROM raw_items"""),
    "lag_profile_merged": sql("""
SELECT q AS quantile, COUNT(*) AS rows, CASE q WHEN 0.0 THEN MIN(lag) WHEN 1.0 THEN MAX(lag) END AS exact_lag, TRUE AS within
FROM (SELECT unnest([0.0, 0.5, 0.9, 0.99, 1.0])::DOUBLE AS q, CAST(epoch(source_ts) - epoch(created_at) AS BIGINT) AS lag FROM raw_items)
GROUP BY q"""),
    "distinct_keys_by_day": sql("""
SELECT CAST(date_trunc('month', source_ts) AS DATE) AS first, last_day(CAST(source_ts AS DATE)) AS last, COUNT(DISTINCT id) AS distinct_keys
FROM raw_items GROUP BY 1, 2"""),
    "assert_unique": sql("SELECT id, COUNT(*) AS failing_rows FROM raw_items GROUP BY id HAVING COUNT(*) > 1"),
    "assert_not_null": sql("""
SELECT 'product_id' AS column_name, COUNT(*) AS failing_rows FROM items_clean WHERE product_id IS NULL"""),
    "assert_ref": sql("""
SELECT o.store_id, COUNT(*) AS failing_rows FROM orders_clean o
WHERE o.store_id NOT IN (SELECT store_id FROM stores_clean) GROUP BY o.store_id"""),
    "nested_csv_load": sql("SELECT * FROM latest_orders"),
    "raw_parquet_load": sql("SELECT * FROM latest_orders"),
    "csv_load_items": sql("""
SELECT id AS order_item_id, order_id, TRY_CAST(product_id AS BIGINT) AS product_id,
       CAST(ROUND(quantity) AS BIGINT) AS quantity, CAST(unit_price AS DECIMAL(38,9)) AS unit_price_local,
       CAST(net_amount AS DECIMAL(38,9)) AS net_amount_local, default_code, is_recommended, created_at, updated_at, source_ts
FROM raw_items"""),
    "raw_parquet_items": sql("""
SELECT id AS order_item_id, order_id, TRY_CAST(product_id AS BIGINT) AS product_id,
       CAST(ROUND(quantity) AS BIGINT) AS quantity, CAST(unit_price AS DECIMAL(38,9)) AS unit_price_local,
       CAST(net_amount AS DECIMAL(38,9)) AS net_amount_local, default_code, is_recommended, created_at, updated_at, source_ts
FROM raw_items"""),
    "raw_parquet_stores": sql("SELECT * FROM stores_clean"),
    "raw_parquet_rates": sql("SELECT currency_code, exchange_date, CAST(rate AS DECIMAL(38,18)) AS rate_to_usd FROM rates"),
    "checked_sink": sql("""
SELECT COUNT(*) AS rows_seen, COUNT(*) FILTER (WHERE total_price_usd IS NULL) AS without_rate,
       SUM(net_amount_usd) AS net_amount_usd, COUNT(*) AS rows_written FROM orders_clean"""),
    "csv_load_stores": sql("SELECT * FROM stores_clean"),
    "csv_load_rates": sql("SELECT currency_code, exchange_date, CAST(rate AS DECIMAL(38,18)) AS rate_to_usd FROM rates"),
    "partitioned_sink": sql(f"""
SELECT store_id, COUNT(*) AS orders, SUM(net_amount_usd) AS net_amount_usd FROM orders_clean
WHERE CAST(created_at AS DATE) >= {AS_OF_DATE} - 365 GROUP BY store_id"""),
    "replay_incremental": sql(items(
        "CAST(source_ts AS DATE) <= last_run AND created_at IS NOT NULL",
        f"(SELECT *, LEAST(CAST(created_at AS DATE) + 7, {AS_OF_DATE}) AS last_run FROM raw_items)",
        order="last_run DESC, source_ts DESC",
    )),
    "replay_target_window": sql(f"""
SELECT * FROM ({items(
        f"GREATEST(CAST(source_ts AS DATE), DATE '1995-01-01') <= last_run AND CAST(source_ts AS DATE) <= {AS_OF_DATE}",
        "(SELECT f.*, COALESCE(w.run, (SELECT MAX(run) FROM outage_held WHERE top IS NULL)) AS last_run "
        "FROM outage_feed f ASOF LEFT JOIN (SELECT top, MAX(run) AS run FROM outage_held WHERE top IS NOT NULL GROUP BY top) w "
        "ON f.created_at + INTERVAL 7 DAY >= w.top)",
        order="last_run DESC, source_ts DESC",
    )})"""),
    "stream_items": sql(f"""
SELECT order_item_id, order_id, product_id, quantity, net_amount_local, created_at
FROM ({items(raw="(SELECT * REPLACE (CASE WHEN part_key % 97 > 0 THEN created_at END AS created_at) FROM raw_items)")})"""),
    "refresh_full": sql("SELECT * FROM fct_orders"),
    "refresh_incremental": sql("SELECT * FROM fct_run2"),
    "refresh_by_arrival": sql("SELECT * FROM arrival_after"),
}
