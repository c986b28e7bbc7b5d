"""Oracle SQL for the event, item-revenue, reservation, search and date queries."""

from __future__ import annotations

EVENTS_CTE = """
ev AS (
  SELECT event_id,
         event_type AS event_name,
         CAST(epoch_us(ts) AS BIGINT) AS event_timestamp,
         CASE WHEN event_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_pseudo_id,
         strftime(ts, '%Y%m%d') AS event_date,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         value
  FROM events
),
ev_tagged AS (
  SELECT event_id, event_name, event_timestamp, user_pseudo_id, event_date, k, value,
         '100001' AS property_id, 'north-lounges' AS property_name,
         concat_ws('_', event_name, CAST(event_timestamp AS VARCHAR), user_pseudo_id) AS join_key,
         3 AS n_params, k AS param_k, value AS param_value, event_name AS param_type
  FROM ev
),
ev_flat AS (
  SELECT event_id, event_name, event_timestamp, user_pseudo_id, event_date, property_id, property_name, join_key, n_params, param_k, param_value, param_type,
         'k' AS key, CAST(NULL AS VARCHAR) AS string_value, k AS int_value,
         CAST(NULL AS DOUBLE) AS float_value, CAST(NULL AS DOUBLE) AS double_value
  FROM ev_tagged WHERE event_name <> 'error'
  UNION ALL
  SELECT event_id, event_name, event_timestamp, user_pseudo_id, event_date, property_id, property_name, join_key, n_params, param_k, param_value, param_type,
         'value', NULL, NULL, NULL, value
  FROM ev_tagged WHERE event_name <> 'error'
  UNION ALL
  SELECT event_id, event_name, event_timestamp, user_pseudo_id, event_date, property_id, property_name, join_key, n_params, param_k, param_value, param_type,
         'type', event_name, NULL, NULL, NULL
  FROM ev_tagged WHERE event_name <> 'error'
)
"""


def _round(c: str) -> str:
    # "+ 0.0" turns a negative zero into 0.0 (IEEE) and leaves every other value as it is.
    return f"(ROUND(CAST({c} AS DOUBLE) * CAST(1000000 AS DOUBLE), 0) / CAST(1000000 AS DOUBLE) + 0.0)"


ITEM_CTE = """
ir AS (
  SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'north-lounges' ELSE 'south-stays' END AS property_name,
         strftime(l_shipdate, '%Y%m%d') AS date,
         CASE WHEN l_linestatus = 'F' THEN 'Organic Search' ELSE 'Paid Search' END AS channel,
         p_name AS item_name,
         CASE WHEN l_returnflag = 'R' THEN 0
              ELSE CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) END AS net,
         CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS qty
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
ir_report AS (
  SELECT property_name, date, channel, item_name,
         CAST(SUM(net) AS DECIMAL(24,6)) AS item_revenue, CAST(SUM(qty) AS BIGINT) AS items_purchased
  FROM ir GROUP BY ALL
),
ir_out AS (
  SELECT property_name, property_name AS property_type,
         substr(date, 1, 4) || '-' || substr(date, 5, 2) || '-' || substr(date, 7, 2) AS data_date,
         channel AS session_default_channel_group, item_name,
         CAST(item_revenue AS DOUBLE) AS item_revenue, items_purchased
  FROM ir_report WHERE item_revenue > 0 OR items_purchased > 0
)
"""

SEARCH_CTE = """
s_base AS (
  SELECT CASE user_id % 4 WHEN 0 THEN 'proj-lounge' WHEN 1 THEN 'proj-stays' WHEN 2 THEN '  '
              ELSE 'proj-parking' END AS project_id,
         event_id, event_type, ts, CAST(ts AS DATE) AS data_date
  FROM events
),
s_projects AS (
  SELECT * FROM (VALUES ('proj-lounge', 'north-lounges'), ('proj-stays', 'south-stays'),
                        ('  ', 'ghost-site'), ('proj-parking', 'east-parking')) p(project_id, property_name)
  WHERE trim(project_id) <> ''
),
s_dates AS (SELECT CAST(DATE '2024-01-24' + INTERVAL (i) DAY AS DATE) AS d FROM range(7) t(i)),
s_site AS (
  SELECT p.property_name, 'searchdata_site_impression' AS table_name, strftime(b.data_date, '%Y-%m-%d') AS date
  FROM s_base b JOIN s_projects p ON p.project_id = b.project_id
  WHERE b.event_type <> 'error' AND b.data_date IN (SELECT d FROM s_dates)
),
s_url AS (
  SELECT p.property_name, 'searchdata_url_impression' AS table_name, strftime(b.data_date, '%Y-%m-%d') AS date
  FROM s_base b JOIN s_projects p ON p.project_id = b.project_id
  WHERE b.data_date IN (SELECT d FROM s_dates)
),
s_top AS (
  SELECT * FROM (
    SELECT b.*, ROW_NUMBER() OVER (PARTITION BY project_id ORDER BY ts DESC, event_id DESC) AS rn FROM s_base b
  ) WHERE rn <= 100
),
s_log AS (
  SELECT p.property_name, strftime(d.d, '%Y-%m-%d') AS date, t.event_id, t.event_type AS table_name,
         CAST(epoch_us(t.ts) AS BIGINT) AS publish_time_us
  FROM s_top t JOIN s_projects p ON p.project_id = t.project_id, s_dates d
)
"""

RES_CTE = """
r_src AS (
  SELECT 1 + c_nationkey % 3 AS property_id, o_orderkey AS res_no,
    CASE WHEN o_orderkey % 3 <> 0 THEN 'OC' || CAST(o_orderkey AS VARCHAR) ELSE '' END AS conf,
    CASE WHEN o_orderkey % 50 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 99:99:99'
         WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)), '%Y-%-m-%-d %-H:%-M:%-S')
         WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)), '%Y-%m-%d %H:%M:%S')
         ELSE strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)), '%Y-%m-%dT%H:%M:%S') END AS created_raw,
    CASE WHEN o_orderstatus = 'P'
         THEN strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') END AS cancelled_raw,
    strftime(o_orderdate, '%Y-%m-%d') AS arrive,
    strftime(CAST(o_orderdate AS DATE) + INTERVAL 60 DAY, '%Y-%m-%d') AS depart,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'Sleepover Direct' WHEN o_orderpriority = '5-LOW' THEN ''
         ELSE o_orderpriority END AS source,
    CASE o_custkey % 4 WHEN 0 THEN '176' WHEN 1 THEN '176.9' WHEN 2 THEN '12' ELSE 'x' END AS creator,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'Agent-' || CAST(c_nationkey AS VARCHAR) END AS agent,
    CASE WHEN o_custkey % 11 = 0 THEN '' ELSE c_name END AS surname,
    CASE WHEN o_custkey % 11 = 0 THEN '' ELSE c_mktsegment END AS given,
    'Room-' || CAST(c_nationkey % 5 AS VARCHAR) AS accommodation,
    CASE o_orderstatus WHEN 'F' THEN 'Departed' WHEN 'O' THEN 'Confirmed' ELSE 'Cancelled' END AS status,
    CASE WHEN o_custkey % 5 = 0 THEN '' WHEN c_nationkey % 2 = 0 THEN 'GBP' END AS currency,
    CASE WHEN c_nationkey % 2 = 1 AND o_custkey % 5 <> 0 THEN 'AUD' END AS currency_code
  FROM orders JOIN customer ON o_custkey = c_custkey
),
r_props AS (
  SELECT * FROM (VALUES (1, 'Harbour View', 'Sydney'), (2, 'Airport Inn', 'Manchester'), (3, 'Old Mill', ''))
  p(property_id, property_name, location)
),
r_norm AS (
  SELECT r.*,
    CASE WHEN created_raw = '' THEN ''
         WHEN try_strptime(substr(trim(created_raw), 1, 19), ['%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S']) IS NOT NULL
         THEN strftime(try_strptime(substr(trim(created_raw), 1, 19), ['%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S']) - INTERVAL 3 HOUR, '%Y-%m-%d')
         ELSE substr(trim(created_raw), 1, 10) END AS created_date_utc,
    CASE WHEN cancelled_raw IS NULL OR cancelled_raw = '' THEN ''
         WHEN try_strptime(substr(trim(cancelled_raw), 1, 19), ['%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S']) IS NOT NULL
         THEN strftime(try_strptime(substr(trim(cancelled_raw), 1, 19), ['%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S']) - INTERVAL 3 HOUR, '%Y-%m-%d')
         ELSE substr(trim(cancelled_raw), 1, 10) END AS cancelled_date_utc,
    CASE WHEN source <> '' AND strpos(lower(source), 'sleepover') > 0 THEN
           CASE WHEN TRY_CAST(creator AS DOUBLE) IS NOT NULL AND CAST(trunc(TRY_CAST(creator AS DOUBLE)) AS BIGINT) = 176
                THEN 'Sleepover.com' ELSE 'Sleepover e-mail/phone' END
         ELSE COALESCE(NULLIF(source, ''), NULLIF(agent, ''), '') END AS reservation_agent
  FROM r_src r
),
r_export AS (
  SELECT n.res_no, COALESCE(NULLIF(n.conf, ''), 'REST API') AS rms_conf_no, n.created_date_utc AS date_made_utc,
         n.arrive, n.depart, n.reservation_agent, n.surname, n.given, n.accommodation, 'N/A' AS date_paid,
         n.property_id, p.property_name, p.location, n.status, n.source AS booking_source_name,
         COALESCE(NULLIF(n.currency, ''), NULLIF(n.currency_code, ''), 'USD') AS currency,
         n.created_date_utc, n.cancelled_date_utc
  FROM r_norm n JOIN r_props p ON p.property_id = n.property_id
  WHERE n.created_date_utc BETWEEN '1994-12-31' AND '2001-12-31'
),
r_rates AS (
  SELECT e.res_no, CAST(SUM(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 1000 AS BIGINT) + 3 * l_linenumber) AS BIGINT) AS mills
  FROM r_export e JOIN lineitem ON l_orderkey = e.res_no
  WHERE strftime(l_shipdate, '%Y-%m-%d') >= e.arrive
    AND strftime(l_shipdate, '%Y-%m-%d') <= strftime(CAST(e.depart AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d')
  GROUP BY e.res_no
)
"""

SEARCH_TABLES = "(VALUES ('searchdata_site_impression'), ('searchdata_url_impression')) t(table_name)"
LINE_ORDER = "l_orderkey, l_linenumber, l_shipdate, l_extendedprice"
RES_COLS = ("res_no, rms_conf_no, date_made_utc, arrive, depart, reservation_agent, surname, given, accommodation, "
            "date_paid, property_id, property_name, location, status, booking_source_name, currency, "
            "created_date_utc, cancelled_date_utc")


def _chain_faults(chains: str) -> str:
    """Faults of chains (landing, property_name, page, more, copies) whose first page is 0, from each page's neighbours."""
    return f"""
near AS (SELECT *, LAG(page) OVER w AS before, LEAD(page) OVER w AS after FROM {chains} WINDOW w AS (PARTITION BY landing, property_name ORDER BY page))
SELECT landing, property_name, page, 'doubled' AS fault FROM near WHERE copies = 2
UNION SELECT landing, property_name, page - 1, 'missing' FROM near WHERE page > 0 AND before IS DISTINCT FROM page - 1
UNION SELECT landing, property_name, page + 1, 'missing' FROM near WHERE more AND after IS DISTINCT FROM page + 1
UNION SELECT landing, property_name, page + 1, 'after the end' FROM near WHERE NOT more AND after = page + 1
UNION SELECT DISTINCT landing, 'west-ferry', 0, 'missing' FROM {chains}
"""


# Report shapes: dimensions and metrics in the order of the response.
SHAPES = {
    "range_ads": ("campaign ad_group", "cost clicks impressions"),
    "range_analytics": ("campaign ad_group channel medium", "revenue conversions sessions"),
    "day_campaign_ads": ("date campaign", "cost clicks impressions"),
    "day_campaign_analytics": ("date campaign channel medium", "revenue conversions sessions"),
    "day_adgroup_ads": ("date campaign ad_group", "cost clicks impressions"),
    "day_adgroup_analytics": ("date campaign ad_group channel medium", "revenue conversions sessions"),
    "item_revenue": ("date channel item_name", "item_revenue items_purchased"),
}
SHAPE_VALUES = {
    "date": "strftime(l_shipdate, '%Y%m%d')", "campaign": "'camp-' || CAST(l_partkey % 9 AS VARCHAR)",
    "ad_group": "'group-' || CAST(l_suppkey % 7 AS VARCHAR)", "channel": "l_returnflag", "medium": "l_linestatus",
    "item_name": "'item-' || CAST(l_suppkey % 10 AS VARCHAR)", "cost": "CAST(l_extendedprice AS DECIMAL(12,2))",
    "revenue": "CAST(l_extendedprice AS DECIMAL(12,2)) * 2", "item_revenue": "CAST(l_extendedprice AS DECIMAL(12,2)) * 3",
    "clicks": "CAST(l_quantity AS BIGINT)", "sessions": "CAST(l_quantity AS BIGINT) + 1", "items_purchased": "CAST(l_quantity AS BIGINT) + 2",
    "impressions": "l_linenumber * 10", "conversions": "CAST(l_tax AS DECIMAL(4,2))",
}


def _shape(name: str) -> str:
    have = " ".join(SHAPES[name]).split()

    def value(c: str, aggregate: str) -> str:
        return f"{aggregate}({SHAPE_VALUES[c]})" if c in have else "NULL"

    def key(c: str) -> str:
        return f"{SHAPE_VALUES[c] if c in have else 'CAST(NULL AS VARCHAR)'} AS {c}"
    sums = ", ".join(f"CAST({_round(value(m, 'SUM')) if m in have else 'NULL'} AS DOUBLE) AS sum_{m}"
                     for m in ("cost", "clicks", "impressions", "revenue", "conversions", "sessions", "item_revenue", "items_purchased"))
    return f"""SELECT '{name}' AS report, CASE WHEN (l_orderkey // 100) % 2 = 0 THEN 'north-lounges' ELSE 'south-stays' END AS property_name,
  {key('campaign')}, {key('channel')}, COUNT(*) AS n, {value('date', 'MIN')} AS first_date, {value('date', 'MAX')} AS last_date,
  {value('ad_group', 'MAX')} AS last_ad_group, {value('medium', 'MAX')} AS last_medium, {value('item_name', 'MAX')} AS last_item, {sums}
FROM lineitem GROUP BY ALL"""


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["item_revenue"] = f"""
WITH {ITEM_CTE}
SELECT property_name, property_type, data_date, session_default_channel_group, item_name,
       {_round('item_revenue')} AS item_revenue, items_purchased
FROM ir_out
"""
    q["item_revenue_summary"] = f"""
WITH {ITEM_CTE}
SELECT data_date, COUNT(*) AS row_count, COUNT(DISTINCT data_date) AS days, {_round('SUM(CAST(item_revenue AS DECIMAL(38,6)))')} AS item_revenue
FROM ir_out GROUP BY ROLLUP (data_date)
"""
    q["search_window"] = f"""
WITH {SEARCH_CTE}
SELECT property_name, table_name, date, COUNT(*) AS "rows"
FROM (SELECT property_name, table_name, date FROM s_site
      UNION ALL SELECT property_name, table_name, date FROM s_url
      UNION ALL SELECT property_name, 'ExportLog' AS table_name, date FROM s_log)
GROUP BY ALL
"""
    q["export_log_top100"] = f"""
WITH {SEARCH_CTE}
SELECT property_name, date, event_id, table_name, publish_time_us FROM s_log
"""
    q["search_days"] = f"""
WITH {SEARCH_CTE}
SELECT t.table_name, p.property_name, strftime(b.data_date, '%Y-%m-%d') AS date, b.event_id, e.user_id, b.event_type AS query, e.value AS impressions
FROM s_base b JOIN s_projects p ON p.project_id = b.project_id JOIN events e ON e.event_id = b.event_id
JOIN {SEARCH_TABLES} ON t.table_name = 'searchdata_url_impression' OR b.event_type <> 'error'
WHERE b.data_date IN (SELECT d FROM s_dates)
"""
    q["snapshot_kept_days"] = f"""
WITH {SEARCH_CTE}
SELECT t.table_name, p.property_name, strftime(b.data_date, '%Y-%m-%d') AS date, b.event_id, b.event_type AS query, e.value AS impressions,
       CASE WHEN b.data_date >= DATE '2024-01-24' AND b.data_date <> DATE '2024-01-26' THEN e.value * 2 END AS position
FROM s_base b JOIN s_projects p ON p.project_id = b.project_id JOIN events e ON e.event_id = b.event_id
JOIN {SEARCH_TABLES} ON t.table_name = 'searchdata_url_impression' OR b.event_type <> 'error'
WHERE b.data_date BETWEEN DATE '2024-01-22' AND DATE '2024-01-30'
"""
    q["landed_reports"] = f"""
WITH rows AS (
  SELECT CASE WHEN (l_orderkey // 100) % 2 = 0 THEN 'north-lounges' ELSE 'south-stays' END AS property_name, l_returnflag AS channel,
         'item-' || CAST(l_suppkey % 10 AS VARCHAR) AS item_name, strftime(l_shipdate, '%Y%m%d') AS date,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS revenue, CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS items,
         l_orderkey, l_linenumber, l_shipdate, l_extendedprice
  FROM lineitem WHERE (l_orderkey // 100) % 10 <> 9
)
SELECT property_name, channel, item_name, last(date ORDER BY {LINE_ORDER}) AS date, {_round(f'last(revenue ORDER BY {LINE_ORDER})')} AS item_revenue,
       last(items ORDER BY {LINE_ORDER}) AS items_purchased, COUNT(*) AS n, {_round('SUM(revenue)')} AS sum_revenue, CAST(SUM(items) AS BIGINT) AS sum_items
FROM rows GROUP BY ALL
"""
    q["landed_searches"] = f"""
SELECT strftime(l_shipdate, '%Y-%m-%d') AS data_date,
       CASE WHEN l_linenumber <> 2 THEN 'camp-' || CAST(l_partkey % 9 AS VARCHAR) ELSE 'N/A' END AS campaign,
       CASE WHEN l_linenumber <> 3 THEN 'group-' || CAST(l_suppkey % 9 AS VARCHAR) ELSE 'N/A' END AS ad_group,
       {_round('CAST(l_extendedprice AS DECIMAL(12,2))')} AS cost, CAST(l_quantity AS BIGINT) AS clicks,
       CASE WHEN l_linenumber <> 4 THEN l_orderkey + 9007199254740993 ELSE 0 END AS impressions,
       CAST(CAST(l_tax AS DECIMAL(4,2)) * 1000000000 AS BIGINT) + 123456789 AS conversions_e9, {_round('CAST(l_discount AS DECIMAL(4,2))')} AS revenue,
       l_orderkey // 100 AS page
FROM lineitem
"""
    q["landed_reservations"] = """
WITH o AS (
  SELECT o_orderkey // 100 AS page, o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
         ROW_NUMBER() OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderkey) AS rn
  FROM orders
)
SELECT page, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS "bookingSourceName",
       CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) END AS last_name
FROM o WHERE page % 5 <> 4 OR rn = 1
UNION ALL
SELECT DISTINCT page, '-1', NULL, NULL, NULL FROM o WHERE page % 5 = 0
"""
    q["landed_rates"] = f"""
SELECT l_orderkey AS reservation_id, {_round('SUM(CAST(l_extendedprice AS DECIMAL(12,2)))')} AS rate_sum, strftime(MAX(l_shipdate), '%Y-%m-%d') AS last_stay
FROM lineitem WHERE l_linenumber NOT IN (5, 6) GROUP BY l_orderkey
"""
    q["reservations_normalised"] = f"""
WITH {RES_CTE}
SELECT {RES_COLS} FROM r_export
"""
    q["reservation_rates"] = f"""
WITH {RES_CTE}
SELECT {RES_COLS.replace('date_paid', "COALESCE(CAST(CAST(r.cents AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS VARCHAR), '0.00') AS rate, date_paid")}
FROM r_export e LEFT JOIN (
  SELECT res_no, mills // 10 + CASE WHEN mills % 10 > 5 OR (mills % 10 = 5 AND (mills // 10) % 2 = 1) THEN 1 ELSE 0 END AS cents FROM r_rates
) r USING (res_no)
"""
    q["month_to_date"] = """
WITH daily AS (
  SELECT CAST(l_shipdate AS DATE) AS day, SUM(CAST(l_quantity AS BIGINT)) AS qty, COUNT(*) AS lines
  FROM lineitem GROUP BY 1
)
SELECT strftime(d.day + INTERVAL 1 DAY, '%Y-%m-%d') AS as_of,
       strftime(date_trunc('month', d.day), '%Y-%m-%d') AS range_start,
       strftime(d.day, '%Y-%m-%d') AS range_end,
       CAST(SUM(x.qty) AS BIGINT) AS mtd_quantity, CAST(SUM(x.lines) AS BIGINT) AS mtd_lines
FROM daily d JOIN daily x ON x.day BETWEEN date_trunc('month', d.day) AND d.day
GROUP BY d.day
"""
    q["flatten_events"] = f"""
WITH {EVENTS_CTE}
SELECT event_id, event_name, event_timestamp, user_pseudo_id, event_date, property_id, property_name,
       join_key, n_params, param_k, param_value, param_type, key, string_value, int_value, float_value, double_value
FROM ev_flat
"""
    q["events_join_key"] = f"""
WITH {EVENTS_CTE}
SELECT event_id, event_name, event_timestamp, user_pseudo_id, join_key FROM ev_tagged
"""
    q["flatten_event_arrays"] = f"""
WITH {EVENTS_CTE}
SELECT event_id, join_key, event_date, 4 AS n_params, CASE key WHEN 'k' THEN 0 WHEN 'value' THEN 1 ELSE 2 END AS param_pos, key,
       string_value, int_value, float_value, double_value
FROM ev_flat WHERE event_id % 11 <> 0
UNION ALL
SELECT event_id, join_key, event_date, 4, 3, key, string_value, int_value + 1, float_value, double_value
FROM ev_flat WHERE event_id % 11 <> 0 AND key = 'k'
"""
    q["events_two_days_back"] = f"""
WITH {EVENTS_CTE}
SELECT v.via, event_id, event_name, event_timestamp, user_pseudo_id, event_date, property_id, property_name, join_key, key,
       string_value, int_value, float_value, double_value
FROM ev_flat, (VALUES ('partitions'), ('suffix')) v(via) WHERE event_date = '20240129'
"""
    q["landed_report_specs"] = "\nUNION ALL\n".join(map(_shape, SHAPES))
    q["landed_search_campaigns"] = f"""
SELECT strftime(l_shipdate, '%Y-%m-%d') AS data_date,
       CASE WHEN l_linenumber <> 2 THEN 'camp-' || CAST(l_partkey % 9 AS VARCHAR) ELSE 'N/A' END AS campaign,
       {_round('CAST(l_extendedprice AS DECIMAL(12,2))')} AS cost, CAST(l_quantity AS BIGINT) AS clicks,
       CASE WHEN l_linenumber <> 4 THEN l_orderkey + 9007199254740993 ELSE 0 END AS impressions,
       CAST(CAST(l_tax AS DECIMAL(4,2)) * 1000000000 AS BIGINT) + 123456789 AS conversions_e9, {_round('CAST(l_discount AS DECIMAL(4,2))')} AS revenue,
       l_orderkey // 100 AS page
FROM lineitem
"""
    q["landed_page_gaps"] = f"""
WITH raw AS (
  SELECT 'ads search' AS landing, 3 AS n, l_orderkey // 100 AS raw, 0 AS rows FROM lineitem GROUP BY ALL
  UNION ALL SELECT 'reservations', 2, o_orderkey // 100, COUNT(*) FROM orders GROUP BY ALL
),
named AS (
  SELECT landing, CASE raw % n WHEN 0 THEN 'north-lounges' WHEN 1 THEN 'south-stays' ELSE 'east-parking' END AS property_name, raw // n AS page,
         CASE raw % 5 WHEN 0 THEN rows + 4 WHEN 1 THEN rows + 1 WHEN 4 THEN 1 ELSE rows END AS elements
  FROM raw
),
lasts AS (SELECT *, MAX(page) OVER (PARTITION BY landing, property_name) AS last FROM named),
chains AS (
  SELECT landing, property_name, page, CASE WHEN page % 11 = 5 THEN 2 ELSE 1 END AS copies,
         CASE landing WHEN 'reservations' THEN elements >= 100 ELSE page <> last AND page % 13 <> 6 END AS more
  FROM lasts WHERE page % 7 <> 3 AND NOT (property_name = 'south-stays' AND page = last)
),
{_chain_faults('chains')}
"""
    q["landed_cut_reports"] = """
WITH pages AS (
  SELECT l_orderkey // 100 AS report, CASE WHEN (l_orderkey // 100) % 10 = 9 THEN 0 ELSE COUNT(*) END AS landed FROM lineitem GROUP BY l_orderkey // 100
),
told AS (
  SELECT *, CASE report % 9 WHEN 4 THEN landed + report % 3 WHEN 7 THEN GREATEST(landed - 1, 0) WHEN 5 THEN NULL ELSE landed END AS declared FROM pages
),
judged AS (
  SELECT *, CASE WHEN landed < declared THEN 'fewer rows than declared' WHEN landed > declared THEN 'more rows than declared'
                 WHEN declared IS NULL AND landed > 0 AND landed % 10 = 0 THEN 'as many rows as a request gives' END AS fault FROM told
)
SELECT CASE WHEN report % 2 = 0 THEN 'north-lounges' ELSE 'south-stays' END AS property_name, report, CAST(declared AS BIGINT) AS declared,
       CAST(landed AS BIGINT) AS landed, fault
FROM judged WHERE fault IS NOT NULL
"""
    q["landed_properties"] = """
SELECT CAST(s_suppkey AS INTEGER) AS property_id, s_name AS property_name,
       CASE WHEN s_suppkey % 3 <> 0 THEN 'Pier ' || CAST(s_suppkey % 50 AS VARCHAR) ELSE '' END AS location
FROM supplier
"""
    q["rewritten_days"] = _rewritten_days()
    return q


def _rewritten_days() -> str:
    """The days of each job that two overlapping runs leave: the second's, and the first's on days that the second does not have."""
    from channelmart.oracle.ads_sql import ads_ctes, round_out

    def exact(c: str) -> str:
        return f"SUM(CAST({round_out(c)} AS DECIMAL(38,6)))"

    def days(job: str, amount: str, units: str, source: str) -> str:
        return f"SELECT '{job}' AS job, data_date, COUNT(*) AS row_count, {exact(amount)} AS amount, {exact(units)} AS units FROM {source} GROUP BY data_date"

    def ads(start: str, end: str) -> str:
        return f"WITH RECURSIVE {ads_ctes(start, end)} {days('ads', 'revenue_ga4', 'clicks', 'final')}"

    def items(start: str, end: str, more: int) -> str:
        kept = f"(SELECT *, items_purchased + {more} AS items FROM ir_report)"
        rows = f"""(SELECT substr(date, 1, 4) || '-' || substr(date, 5, 2) || '-' || substr(date, 7, 2) AS data_date, item_revenue, items
                    FROM {kept} WHERE item_revenue > 0 OR items > 0)"""
        return f"WITH {ITEM_CTE} {days('items', 'item_revenue', 'items', rows)} HAVING data_date BETWEEN '{start}' AND '{end}'"

    def stays(start: str, end: str, only: str) -> str:
        rows = f"""(SELECT e.created_date_utc AS data_date, e.res_no, COALESCE(CAST(r.cents AS DECIMAL(20,0)), 0) * CAST(0.01 AS DECIMAL(3,2)) AS rate
                    FROM r_export e LEFT JOIN r_cents r USING (res_no) WHERE e.created_date_utc BETWEEN '{start}' AND '{end}' {only})"""
        return f"""WITH {RES_CTE}, r_cents AS (
  SELECT res_no, mills // 10 + CASE WHEN mills % 10 > 5 OR (mills % 10 = 5 AND (mills // 10) % 2 = 1) THEN 1 ELSE 0 END AS cents FROM r_rates)
{days('stays', 'rate', 'res_no', rows)}"""

    runs = {"ads": (ads("1998-01-01", "1998-02-15"), ads("1998-02-01", "1998-03-31")),
            "items": (items("1992-01-01", "1996-12-31", 0), items("1996-01-01", "1998-12-31", 1)),
            "stays": (stays("1994-12-31", "1996-12-31", ""), stays("1996-06-01", "2001-12-31", "AND e.property_id = 2"))}
    named = ", ".join(f"{job}_{k} AS ({sql})" for job, pair in runs.items() for k, sql in enumerate(pair))
    left = "\nUNION ALL\n".join(f"SELECT * FROM {job}_1 UNION ALL SELECT * FROM {job}_0 WHERE data_date NOT IN (SELECT data_date FROM {job}_1)" for job in runs)
    return f"WITH {named} SELECT job, data_date, row_count, {_round('amount')} AS amount, {_round('units')} AS units FROM ({left})"
