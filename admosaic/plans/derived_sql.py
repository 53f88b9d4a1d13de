"""The derivation of `derived` once more, in the SQL of the checking engine."""

from __future__ import annotations

from ..functions.countries import REGION_TO_COUNTRY
from .compare import sql_list, sql_pick
from .derived import AD_TYPES, AGES, GENDERS, MEDIA, NATION_CODES, PLATFORMS, REGIONS

_LOW = "o_orderpriority <> '4-NOT SPECIFIED'"
_HIGH = "o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW')"

BASE = f"""
lines AS (
  SELECT l_orderkey, count(*) AS n, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey
),
base AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS ad_id,
    {sql_pick(PLATFORMS, 'o_orderkey % 11')} AS platform,
    CAST(o_custkey AS VARCHAR) AS cust, c_name AS name, c_mktsegment AS segment, o_orderpriority AS prio,
    o_orderdate AS d1, greatest(o_orderdate, coalesce(last_ship, o_orderdate)) AS d2,
    CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'INACTIVE' ELSE 'PENDING' END AS status,
    {sql_pick(NATION_CODES, 'c_nationkey')} AS c1, {sql_pick(NATION_CODES, 'o_orderkey % 25')} AS c2,
    [{sql_pick(REGIONS, 'c_nationkey')}, {sql_pick(REGIONS, f'o_orderkey % {len(REGIONS)}')}] AS regions,
    {sql_pick(AGES, 'o_orderkey % 4')} AS ages, {sql_pick(GENDERS, 'o_orderkey % 3')} AS genders,
    coalesce(n, 0) AS n_lines,
    CASE WHEN {_LOW} THEN CAST(floor(o_totalprice / 1000) * 100 AS BIGINT) END AS spend_min,
    CASE WHEN {_HIGH} THEN CAST(floor(o_totalprice / 1000) * 100 AS BIGINT) + 99 END AS spend_max,
    CASE WHEN {_LOW} THEN coalesce(n, 0) * 1000 END AS imp_min,
    CASE WHEN {_HIGH} THEN coalesce(n, 0) * 1000 + 999 END AS imp_max,
    coalesce(text, c_mktsegment || ' offer ' || o_orderpriority) AS ad_text, lang
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN lines ON l_orderkey = o_orderkey
  LEFT JOIN documents ON doc_id = o_orderkey
)"""

FETCHED = "make_timestamp(2024, 1, 1, 0, 0, 0) + to_minutes(k // 25)"
SPEND_TEXT = (
    "CASE WHEN spend_max IS NOT NULL THEN '$' || spend_min || ' - $' || spend_max "
    "WHEN spend_min IS NOT NULL THEN '$' || spend_min || '+' END"
)
IMP_TEXT = (
    "CASE WHEN imp_max IS NOT NULL THEN format('{:,}', imp_min) || ' - ' || format('{:,}', imp_max) "
    "WHEN imp_min IS NOT NULL THEN format('{:,}', imp_min) || '+' END"
)

#: The stored ad table, for the searches and reports.
ADS = f"""{BASE},
ads AS (
  SELECT *, cust AS advertiser_id, name AS advertiser_name, d1 AS first_seen, d2 AS last_seen,
    list_distinct([c1, c2]) AS countries, {sql_pick(MEDIA, 'k % 4')} AS media_type,
    {sql_pick(AD_TYPES, 'k % 5')} AS ad_type, {SPEND_TEXT} AS spend_range, {IMP_TEXT} AS impressions_range,
    CASE WHEN k % 2 = 0 THEN CAST(n_lines * 100 AS VARCHAR) ELSE 'unknown' END AS eu_reach
  FROM base
)"""

REGION_MAP = "MAP {" + ", ".join(f"'{r}': '{c}'" for r, c in REGION_TO_COUNTRY.items()) + "}"
REGION_CODES = f"list_transform(regions, lambda r: coalesce({REGION_MAP}[r], r))"

SHARES = f"""
nation_quantities AS (
  SELECT l_orderkey, s_nationkey, CAST(sum(l_quantity) AS BIGINT) AS q
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2
),
shares AS (
  SELECT l_orderkey AS k, {sql_pick(NATION_CODES, 's_nationkey')} AS country,
    (q * 10000 // CAST(sum(q) OVER (PARTITION BY l_orderkey) AS BIGINT)) / 100.0 AS percentage
  FROM nation_quantities
)"""

FACETS = """
facets AS (
  SELECT DISTINCT l_orderkey AS k, l_linestatus AS segment,
    CASE l_returnflag WHEN 'A' THEN 'Age' WHEN 'N' THEN 'Gender' ELSE 'Location' END AS facet
  FROM lineitem
)"""


def with_base(select: str) -> str:
    return f"WITH {BASE}\n{select}"


def with_ads(select: str) -> str:
    return f"WITH {ADS}\n{select}"


__all__ = [
    "ADS", "BASE", "FACETS", "FETCHED", "IMP_TEXT", "REGION_CODES", "SHARES", "SPEND_TEXT", "sql_list",
    "with_ads", "with_base",
]
