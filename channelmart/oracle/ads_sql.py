"""Oracle SQL for the ads reconciliation and blend queries (DuckDB dialect).

Stand-in report views are rebuilt from lineitem/part with the FIXTURES rules;
the reconciliation follows the step list of the survey: overlay, targets,
weights, per-metric shares and ranks, fan-out, half-even rounding, residual,
and a recursive CTE for the session carry.
"""

from __future__ import annotations

M = "DECIMAL(24,6)"
ADS_RANGE = ("1998-01-01", "1998-03-31")


def _dc(c: str) -> str:
    return (f"(CASE WHEN strpos(lower({c}), 'performance max') > 0 OR strpos(lower({c}), 'pmax') > 0 "
            f"OR strpos(lower({c}), 'performance_max') > 0 THEN 'Cross-network' ELSE 'Paid Search' END)")


def _named(c: str) -> str:
    return f"({c} <> '(not set)' AND regexp_matches({c}, '\\S'))"


def _iso(c: str) -> str:
    return f"(substr({c}, 1, 4) || '-' || substr({c}, 5, 2) || '-' || substr({c}, 7, 2))"


def _on(a: str, b: str, keys: list[str]) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


def _overlay(name: str, an: str, ad: str, keys: list[str]) -> str:
    ks = ", ".join(f"COALESCE(a.{k}, d.{k}) AS {k}" for k in keys)
    return f"""
{name} AS (
  SELECT {ks},
         COALESCE(d.cost, CAST(0 AS {M})) AS cost, COALESCE(d.clicks, 0) AS clicks,
         COALESCE(d.impressions, 0) AS impressions,
         COALESCE(a.revenue, CAST(0 AS {M})) AS revenue, COALESCE(a.conversions, CAST(0 AS {M})) AS conversions,
         COALESCE(a.sessions, 0) AS sessions
  FROM {an} a FULL OUTER JOIN {ad} d ON {_on('a', 'd', keys)}
)"""


T_KEYS = ["property_name", "campaign", "ad_group", "channel", "medium"]
CD_KEYS = ["property_name", "data_date", "campaign", "channel", "medium"]
AD_KEYS = ["property_name", "data_date", "campaign", "ad_group", "channel", "medium"]
GRP = "property_name, campaign, channel, medium"


def ads_ctes(start: str | None = None, end: str | None = None) -> str:
    """The rules as CTEs; with a range, the range reports are asked for it and
    the daily rows are filtered by it."""
    asked = f"WHERE iso_date BETWEEN '{start}' AND '{end}'" if start else ""
    days = f"WHERE data_date BETWEEN '{start}' AND '{end}'" if start else ""
    ads = f"CAST(SUM(tax_amt) AS {M}) AS cost, CAST(SUM(qty) AS BIGINT) AS clicks, CAST(SUM(qty_size) AS BIGINT) AS impressions"
    an = f"CAST(SUM(net) AS {M}) AS revenue, CAST(COUNT(*) AS {M}) AS conversions, CAST(SUM(qty) AS BIGINT) AS sessions"
    nat = (f"CAST(CAST(SUM(tax_amt) * 1000000 AS BIGINT) AS {M}) / 1000000 AS cost_raw, CAST(SUM(qty) AS BIGINT) AS clicks, "
           f"CAST(SUM(qty_size) AS BIGINT) AS impressions, CAST(COUNT(*) AS {M}) AS conversions, CAST(SUM(net) AS {M}) AS revenue")
    return f"""
ads_b0 AS (
  SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'north-lounges' ELSE 'south-stays' END AS property_name,
         CASE WHEN p_brand = 'Brand#25' THEN '(not set)'
              WHEN TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) % 5 = 0 THEN 'PMax ' || p_brand
              ELSE p_brand END AS campaign,
         p_type, p_size, l_returnflag, l_linestatus, l_shipdate,
         CAST(l_quantity AS BIGINT) AS qty,
         CAST(l_quantity AS BIGINT) * p_size AS qty_size,
         CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS net,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS tax_amt
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
ads_base AS (
  SELECT property_name, campaign,
         CASE WHEN campaign LIKE 'PMax %' THEN '(not set)' WHEN p_size <= 3 THEN '(not set)' ELSE p_type END AS ad_group,
         CASE l_returnflag WHEN 'R' THEN {_dc('campaign')} WHEN 'A' THEN 'Organic Search' WHEN 'N' THEN 'Direct' END AS channel,
         CASE WHEN l_returnflag = 'R' THEN 'cpc' WHEN l_linestatus = 'F' THEN 'referral' WHEN l_linestatus = 'O' THEN 'organic' END AS medium,
         strftime(l_shipdate, '%Y%m%d') AS date, strftime(l_shipdate, '%Y-%m-%d') AS iso_date,
         qty, qty_size, net, tax_amt
  FROM ads_b0
),
r_range_ads AS (SELECT property_name, campaign, ad_group, {ads} FROM ads_base {asked} GROUP BY ALL),
r_range_an AS (SELECT property_name, campaign, ad_group, channel, medium, {an} FROM ads_base {asked} GROUP BY ALL),
r_dc_ads AS (SELECT property_name, {_iso('date')} AS data_date, campaign, {ads} FROM ads_base GROUP BY property_name, date, campaign),
r_dc_an AS (SELECT property_name, {_iso('date')} AS data_date, campaign, channel, medium, {an} FROM ads_base GROUP BY property_name, date, campaign, channel, medium),
r_dg_ads AS (SELECT property_name, {_iso('date')} AS data_date, campaign, ad_group, {ads} FROM ads_base GROUP BY property_name, date, campaign, ad_group),
r_dg_an AS (SELECT property_name, {_iso('date')} AS data_date, campaign, ad_group, channel, medium, {an}
            FROM ads_base GROUP BY property_name, date, campaign, ad_group, channel, medium HAVING SUM(qty) >= 10),
nat_base AS (SELECT * FROM (SELECT *, CASE WHEN iso_date NOT LIKE '%-13' THEN iso_date END AS data_date FROM ads_base) {days}),
nat_camp AS (SELECT property_name, data_date, campaign, {nat} FROM nat_base GROUP BY property_name, data_date, campaign),
nat_adg AS (SELECT property_name, data_date, campaign, ad_group, {nat} FROM nat_base
            WHERE campaign NOT LIKE 'PMax %' GROUP BY property_name, data_date, campaign, ad_group),
hybrid AS (
  SELECT property_name, data_date, campaign, ad_group, cost_raw AS cost, clicks, impressions, conversions, revenue
  FROM nat_adg a WHERE EXISTS (SELECT 1 FROM nat_camp c WHERE {_on('c', 'a', ['property_name', 'data_date', 'campaign'])})
  UNION ALL
  SELECT property_name, data_date, campaign, '(campaign level)', cost_raw, clicks, impressions, conversions, revenue
  FROM nat_camp c WHERE NOT EXISTS (SELECT 1 FROM nat_adg a WHERE {_on('c', 'a', ['property_name', 'data_date', 'campaign'])})
),
t_an AS (SELECT property_name, campaign, ad_group, channel, medium, revenue, conversions, sessions FROM r_range_an WHERE {_named('campaign')}),
t_ad AS (SELECT property_name, campaign, ad_group, {_dc('campaign')} AS channel, 'cpc' AS medium, cost, clicks, impressions
         FROM r_range_ads WHERE {_named('campaign')}),
{_overlay('t_all', 't_an', 't_ad', T_KEYS)},
targets AS (
  SELECT t.*, CASE WHEN EXISTS (SELECT 1 FROM t_an a WHERE {_on('a', 't', ['property_name', 'campaign', 'ad_group'])}) THEN 0 ELSE 1 END AS first_seen_side
  FROM t_all t
),
tgt AS (SELECT * FROM targets WHERE ad_group NOT IN ('(not set)', '')),
cd_an AS (SELECT property_name, data_date, campaign, channel, medium, revenue, conversions, sessions FROM r_dc_an {days}),
cd_ad AS (SELECT property_name, data_date, campaign, {_dc('campaign')} AS channel, 'cpc' AS medium, cost, clicks, impressions FROM r_dc_ads {days}),
{_overlay('camp_day', 'cd_an', 'cd_ad', CD_KEYS)},
dg_an AS (SELECT property_name, data_date, campaign, ad_group, channel, medium, revenue, conversions, sessions FROM r_dg_an {days}),
dg_ad AS (SELECT property_name, data_date, campaign, ad_group, {_dc('campaign')} AS channel, 'cpc' AS medium, cost, clicks, impressions FROM r_dg_ads {days}),
{_overlay('adg_day', 'dg_an', 'dg_ad', AD_KEYS)},
observed AS (
  SELECT property_name, campaign, ad_group, channel, medium,
         SUM(cost) AS o_cost, SUM(clicks) AS o_clicks, SUM(impressions) AS o_impressions,
         SUM(revenue) AS o_revenue, SUM(conversions) AS o_conversions, SUM(sessions) AS o_sessions
  FROM adg_day a
  WHERE EXISTS (SELECT 1 FROM tgt t WHERE {_on('t', 'a', ['property_name', 'campaign', 'ad_group'])})
  GROUP BY ALL
),
weights AS (
  SELECT t.property_name, t.campaign, t.ad_group, t.channel, t.medium, t.first_seen_side,
         GREATEST(0, t.cost - COALESCE(o.o_cost, 0)) AS w_cost,
         GREATEST(0, t.clicks - COALESCE(o.o_clicks, 0)) AS w_clicks,
         GREATEST(0, t.impressions - COALESCE(o.o_impressions, 0)) AS w_impressions,
         GREATEST(0, t.revenue - COALESCE(o.o_revenue, 0)) AS w_revenue,
         GREATEST(0, t.conversions - COALESCE(o.o_conversions, 0)) AS w_conversions,
         GREATEST(0, t.sessions - COALESCE(o.o_sessions, 0)) AS w_sessions
  FROM tgt t LEFT JOIN observed o ON {_on('t', 'o', T_KEYS)}
),
shares AS (
  SELECT property_name, campaign, ad_group, channel, medium, first_seen_side,
         COUNT(*) OVER g AS n,
         CASE WHEN SUM(w_revenue) OVER g <= 0 THEN CAST(1 AS DOUBLE) / COUNT(*) OVER g
              ELSE CAST(w_revenue AS DOUBLE) / CAST(SUM(w_revenue) OVER g AS DOUBLE) END AS share_revenue,
         CASE WHEN SUM(w_conversions) OVER g <= 0 THEN CAST(1 AS DOUBLE) / COUNT(*) OVER g
              ELSE CAST(w_conversions AS DOUBLE) / CAST(SUM(w_conversions) OVER g AS DOUBLE) END AS share_conversions,
         CASE WHEN SUM(w_sessions) OVER g <= 0 THEN CAST(1 AS DOUBLE) / COUNT(*) OVER g
              ELSE CAST(w_sessions AS DOUBLE) / CAST(SUM(w_sessions) OVER g AS DOUBLE) END AS share_sessions
  FROM weights
  WINDOW g AS (PARTITION BY {GRP})
),
ranked AS (
  SELECT *,
    ROW_NUMBER() OVER (PARTITION BY {GRP} ORDER BY share_revenue DESC, first_seen_side, ad_group) = n AS last_revenue,
    ROW_NUMBER() OVER (PARTITION BY {GRP} ORDER BY share_conversions DESC, first_seen_side, ad_group) = n AS last_conversions,
    ROW_NUMBER() OVER (PARTITION BY {GRP} ORDER BY share_sessions DESC, first_seen_side, ad_group) = n AS last_sessions
  FROM shares
),
active AS (
  SELECT * FROM camp_day
  WHERE {_named('campaign')} AND (cost > 0 OR clicks > 0 OR impressions > 0 OR revenue > 0 OR sessions > 0)
),
level_rows AS (
  SELECT property_name, data_date, campaign, '(campaign level)' AS ad_group, channel, medium,
         revenue AS revenue_ga4, conversions AS conversions_ga4, sessions AS sessions_ga4
  FROM active a WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.property_name = a.property_name AND t.campaign = a.campaign)
),
day_tot AS (
  SELECT property_name, data_date, campaign, channel, medium,
         SUM(revenue) AS t_revenue, SUM(conversions) AS t_conversions, SUM(sessions) AS t_sessions
  FROM adg_day GROUP BY ALL
),
gap AS (
  SELECT a.property_name, a.data_date, a.campaign, a.channel, a.medium,
         GREATEST(0, a.revenue - COALESCE(d.t_revenue, 0)) AS diff_revenue,
         GREATEST(0, a.conversions - COALESCE(d.t_conversions, 0)) AS diff_conversions,
         CAST(GREATEST(0, a.sessions - COALESCE(d.t_sessions, 0)) AS BIGINT) AS diff_sessions
  FROM active a LEFT JOIN day_tot d ON {_on('a', 'd', CD_KEYS)}
  WHERE EXISTS (SELECT 1 FROM tgt t WHERE t.property_name = a.property_name AND t.campaign = a.campaign)
),
fan AS (
  SELECT g.*, r.ad_group, r.n, r.share_revenue, r.share_conversions, r.share_sessions,
         r.last_revenue, r.last_conversions, r.last_sessions
  FROM gap g JOIN ranked r ON {_on('g', 'r', ['property_name', 'campaign', 'channel', 'medium'])}
),
carry_in AS (
  SELECT property_name, campaign, channel, medium, ad_group, data_date,
         CAST(diff_sessions AS DOUBLE) AS x, share_sessions AS s,
         ROW_NUMBER() OVER (PARTITION BY {GRP}, ad_group ORDER BY data_date) AS step
  FROM fan WHERE n >= 2 AND NOT last_sessions AND diff_sessions > 0
),
carry AS (
  WITH RECURSIVE walk(property_name, campaign, channel, medium, ad_group, step, data_date, alloc, carry) AS (
    SELECT property_name, campaign, channel, medium, ad_group, step, data_date,
           round_even(x * s + 0.0::DOUBLE, 0), (x * s + 0.0::DOUBLE) - round_even(x * s + 0.0::DOUBLE, 0)
    FROM carry_in WHERE step = 1
    UNION ALL
    SELECT i.property_name, i.campaign, i.channel, i.medium, i.ad_group, i.step, i.data_date,
           round_even(i.x * i.s + w.carry, 0), (i.x * i.s + w.carry) - round_even(i.x * i.s + w.carry, 0)
    FROM walk w JOIN carry_in i
      ON i.property_name = w.property_name AND i.campaign = w.campaign AND i.channel = w.channel
     AND i.medium = w.medium AND i.ad_group = w.ad_group AND i.step = w.step + 1
  )
  SELECT property_name, campaign, channel, medium, ad_group, data_date, CAST(alloc AS BIGINT) AS alloc_sessions FROM walk
),
parts AS (
  SELECT f.*, c.alloc_sessions,
    CASE WHEN f.n >= 2 AND NOT f.last_revenue THEN
      CAST(round_even(CAST(f.diff_revenue AS DOUBLE) * f.share_revenue * CAST(1000000 AS DOUBLE), 0) / CAST(1000000 AS DOUBLE) AS DECIMAL(30,6)) END AS part_revenue,
    CASE WHEN f.n >= 2 AND NOT f.last_conversions THEN
      CAST(round_even(CAST(f.diff_conversions AS DOUBLE) * f.share_conversions * CAST(1000000 AS DOUBLE), 0) / CAST(1000000 AS DOUBLE) AS DECIMAL(30,6)) END AS part_conversions
  FROM fan f LEFT JOIN carry c ON {_on('f', 'c', ['property_name', 'campaign', 'channel', 'medium', 'ad_group', 'data_date'])}
),
dist AS (
  SELECT property_name, data_date, campaign, ad_group, channel, medium,
    CASE WHEN n = 1 THEN diff_revenue WHEN NOT last_revenue THEN part_revenue
         ELSE diff_revenue - COALESCE(SUM(part_revenue) OVER d, 0) END AS dist_revenue,
    CASE WHEN n = 1 THEN diff_conversions WHEN NOT last_conversions THEN part_conversions
         ELSE diff_conversions - COALESCE(SUM(part_conversions) OVER d, 0) END AS dist_conversions,
    CASE WHEN n = 1 THEN diff_sessions WHEN NOT last_sessions THEN COALESCE(alloc_sessions, 0)
         ELSE diff_sessions - COALESCE(SUM(alloc_sessions) OVER d, 0) END AS dist_sessions
  FROM parts
  WINDOW d AS (PARTITION BY property_name, data_date, campaign, channel, medium)
),
detailed AS (
  SELECT d.property_name, d.data_date, d.campaign, d.ad_group, d.channel, d.medium,
         COALESCE(o.revenue, 0) + d.dist_revenue AS revenue_ga4,
         COALESCE(o.conversions, 0) + d.dist_conversions AS conversions_ga4,
         CAST(COALESCE(o.sessions, 0) + d.dist_sessions AS BIGINT) AS sessions_ga4
  FROM dist d LEFT JOIN adg_day o ON {_on('d', 'o', AD_KEYS)}
),
reconciled AS (
  SELECT * FROM detailed
  UNION ALL
  SELECT property_name, data_date, campaign, ad_group, channel, medium, revenue_ga4, conversions_ga4, sessions_ga4 FROM level_rows
),
shared AS (
  SELECT *,
    CASE WHEN SUM(sessions_ga4) OVER w <> 0 THEN CAST(sessions_ga4 AS DOUBLE) / CAST(SUM(sessions_ga4) OVER w AS DOUBLE)
         WHEN sessions_ga4 = 0 THEN CAST(1 AS DOUBLE) / COUNT(channel) OVER w
         ELSE CAST(0 AS DOUBLE) END AS session_weight
  FROM reconciled
  WINDOW w AS (PARTITION BY property_name, data_date, campaign, ad_group)
),
props AS (
  SELECT * FROM (VALUES ('north-lounges', 'north-lounges', CAST(1.0 AS DOUBLE)),
                        ('south-stays', 'south-stays', CAST(1.3492 AS DOUBLE))) p(property_name, property_type, fx_divisor)
),
blended AS (
  SELECT h.property_name, COALESCE(p.property_type, h.property_name) AS property_type, h.data_date, h.campaign, h.ad_group,
         COALESCE(s.channel, {_dc('h.campaign')}) AS session_default_channel_group,
         COALESCE(s.medium, 'cpc') AS session_medium,
         COALESCE(CAST(h.cost AS DOUBLE) * COALESCE(s.session_weight, CAST(1 AS DOUBLE)), CAST(0 AS DOUBLE)) AS cost,
         COALESCE(CAST(h.clicks AS DOUBLE) * COALESCE(s.session_weight, CAST(1 AS DOUBLE)), CAST(0 AS DOUBLE)) AS clicks,
         COALESCE(CAST(h.impressions AS DOUBLE) * COALESCE(s.session_weight, CAST(1 AS DOUBLE)), CAST(0 AS DOUBLE)) AS impressions,
         COALESCE(CAST(h.conversions AS DOUBLE) * COALESCE(s.session_weight, CAST(1 AS DOUBLE)), CAST(0 AS DOUBLE)) AS conversions,
         COALESCE(CAST(h.revenue AS DOUBLE) * COALESCE(s.session_weight, CAST(1 AS DOUBLE)), CAST(0 AS DOUBLE)) AS revenue,
         COALESCE(CAST(s.revenue_ga4 AS DOUBLE), CAST(0 AS DOUBLE)) / COALESCE(p.fx_divisor, CAST(1 AS DOUBLE)) AS revenue_ga4,
         COALESCE(CAST(s.conversions_ga4 AS DOUBLE), CAST(0 AS DOUBLE)) AS conversions_ga4,
         COALESCE(CAST(s.sessions_ga4 AS DOUBLE), CAST(0 AS DOUBLE)) AS sessions_ga4,
         COALESCE(CAST(s.sessions_ga4 AS DOUBLE), CAST(0 AS DOUBLE)) AS sessions
  FROM hybrid h
  LEFT JOIN shared s ON {_on('h', 's', ['property_name', 'data_date', 'campaign', 'ad_group'])}
  LEFT JOIN props p ON p.property_name = h.property_name
),
final AS (
  SELECT property_name, property_type, data_date, campaign, ad_group, session_default_channel_group, session_medium,
         cost, revenue, CASE WHEN cost = 0 THEN 0.0 ELSE revenue / cost END AS roas,
         clicks, impressions, CASE WHEN impressions = 0 THEN 0.0 ELSE clicks / impressions * 100 END AS ctr,
         CASE WHEN clicks = 0 THEN 0.0 ELSE cost / clicks END AS avg_cpc,
         conversions, sessions, revenue_ga4, conversions_ga4,
         CASE WHEN cost = 0 THEN 0.0 ELSE revenue_ga4 / cost END AS roas_ga4, sessions_ga4
  FROM blended WHERE data_date IS NOT NULL
)"""


def round_out(c: str) -> str:
    """Same rounding as the Spark side: x*1e6, half away from zero, /1e6."""
    # "+ 0.0" turns a negative zero into 0.0 (IEEE) and leaves every other value as it is.
    return f"(ROUND(CAST({c} AS DOUBLE) * CAST(1000000 AS DOUBLE), 0) / CAST(1000000 AS DOUBLE) + 0.0)"


def _r(c: str, alias: str | None = None) -> str:
    return f"{round_out(c)} AS {alias or c.split('.')[-1]}"


def queries() -> dict[str, str]:
    w = f"WITH {ads_ctes()}\n"
    q: dict[str, str] = {}
    q["native_hybrid"] = w + f"""SELECT property_name, data_date, campaign, ad_group, {_r('cost')}, clicks, impressions,
  {_r('conversions')}, {_r('revenue')} FROM hybrid"""
    q["default_channel"] = w + f"""SELECT DISTINCT property_name, campaign, {_dc('campaign')} AS default_channel FROM r_dc_ads"""
    q["targets_overlay"] = w + f"""SELECT property_name, campaign, ad_group, channel, medium, {_r('cost')}, clicks, impressions,
  {_r('revenue')}, {_r('conversions')}, sessions, first_seen_side FROM targets"""
    q["campaign_day_overlay"] = w + f"""SELECT property_name, data_date, campaign, channel, medium, {_r('cost')}, clicks, impressions,
  {_r('revenue')}, {_r('conversions')}, sessions FROM camp_day"""
    q["adgroup_day_overlay"] = w + f"""SELECT property_name, data_date, campaign, ad_group, channel, medium, {_r('cost')}, clicks,
  impressions, {_r('revenue')}, {_r('conversions')}, sessions FROM adg_day"""
    q["discrepancy_weights"] = w + f"""SELECT property_name, campaign, ad_group, channel, medium, {_r('w_cost')},
  CAST(w_clicks AS BIGINT) AS w_clicks, CAST(w_impressions AS BIGINT) AS w_impressions, {_r('w_revenue')},
  {_r('w_conversions')}, CAST(w_sessions AS BIGINT) AS w_sessions FROM weights"""
    q["campaign_level_rows"] = w + f"""SELECT property_name, data_date, campaign, ad_group, channel, medium,
  {_r('revenue_ga4')}, {_r('conversions_ga4')}, sessions_ga4 FROM level_rows"""
    q["daily_gap"] = w + f"""SELECT property_name, data_date, campaign, channel, medium, {_r('diff_revenue')},
  {_r('diff_conversions')}, diff_sessions FROM gap"""
    q["distribute_revenue"] = w + f"""SELECT property_name, data_date, campaign, ad_group, channel, medium,
  {_r('dist_revenue')}, {_r('dist_conversions')} FROM dist"""
    q["distribute_sessions_carry"] = w + """SELECT property_name, data_date, campaign, ad_group, channel, medium,
  CAST(dist_sessions AS BIGINT) AS dist_sessions FROM dist"""
    q["reconciled_daily"] = w + f"""SELECT property_name, data_date, campaign, ad_group, channel, medium,
  {_r('revenue_ga4')}, {_r('conversions_ga4')}, CAST(sessions_ga4 AS BIGINT) AS sessions_ga4 FROM reconciled"""
    q["session_share"] = w + f"""SELECT property_name, data_date, campaign, ad_group, channel, medium,
  {_r('revenue_ga4')}, {_r('conversions_ga4')}, CAST(sessions_ga4 AS BIGINT) AS sessions_ga4, {_r('session_weight')} FROM shared"""
    q["blended_ads"] = w + f"""SELECT property_name, property_type, data_date, campaign, ad_group, session_default_channel_group,
  session_medium, {_r('cost')}, {_r('clicks')}, {_r('impressions')}, {_r('conversions')}, {_r('revenue')},
  {_r('revenue_ga4')}, {_r('conversions_ga4')}, {_r('sessions_ga4')}, {_r('sessions')} FROM blended"""
    q["ads_metrics"] = w + f"""SELECT property_name, property_type, data_date, campaign, ad_group, session_default_channel_group,
  session_medium, {_r('cost')}, {_r('revenue')}, {_r('roas')}, {_r('clicks')}, {_r('impressions')}, {_r('ctr')},
  {_r('avg_cpc')}, {_r('conversions')}, {_r('sessions')}, {_r('revenue_ga4')}, {_r('conversions_ga4')},
  {_r('roas_ga4')}, {_r('sessions_ga4')} FROM final"""
    q["ads_daily_summary"] = w + f"""SELECT data_date, COUNT(*) AS row_count, COUNT(DISTINCT data_date) AS days,
  {_r(f'SUM(CAST({round_out("cost")} AS DECIMAL(38,6)))', 'cost')}, {_r(f'SUM(CAST({round_out("clicks")} AS DECIMAL(38,6)))', 'clicks')}
  FROM final GROUP BY ROLLUP (data_date)"""
    q["ads_metrics_range"] = q["ads_metrics_stored_days"] = q["ads_metrics"].replace(w, f"WITH {ads_ctes(*ADS_RANGE)}\n", 1)
    return q
