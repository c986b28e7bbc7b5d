"""C1/C2 against a plain-Python row model on random inputs, plus edge cases."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from channelmart.functions.exprs import MONEY
from channelmart.operators.overlay import METRIC_TYPES
from channelmart.plans.ads_daily import ads_daily
from channelmart.sources.properties import properties_dim
from row_model import model

CAMPAIGNS = ["Camp A", "Camp B", "PMax C", "(not set)", " ", "Camp D"]
GROUPS = ["g1", "g2", "g3", "(not set)", ""]
CHANNELS = [("Paid Search", "cpc"), ("Organic Search", "organic"), ("Cross-network", "cpc"), ("Direct", "(none)")]
DAYS = ["20240101", "20240102", "20240103", "20240104"]


def money(rng):
    return Decimal(rng.randint(0, 5000)) / 100


def gen(rng):
    def an(dims):
        return {"revenue": money(rng), "conversions": Decimal(rng.randint(0, 3)), "sessions": rng.randint(0, 30), **dims}

    def ads(dims):
        return {"cost": money(rng), "clicks": rng.randint(0, 40), "impressions": rng.randint(0, 400), **dims}

    def uniq(rows, keys):
        seen, out = set(), []
        for r in rows:
            k = tuple(r[x] for x in keys)
            if k not in seen:
                seen.add(k)
                out.append(r)
        return out
    ch = lambda: rng.choice(CHANNELS)
    rep = {}
    rep["range_analytics"] = uniq([an({"campaign": rng.choice(CAMPAIGNS), "ad_group": rng.choice(GROUPS),
                                       "channel": c, "medium": m}) for c, m in [ch() for _ in range(14)]],
                                  ["campaign", "ad_group", "channel", "medium"])
    rep["range_ads"] = uniq([ads({"campaign": rng.choice(CAMPAIGNS), "ad_group": rng.choice(GROUPS)}) for _ in range(8)],
                            ["campaign", "ad_group"])
    rep["day_campaign_analytics"] = uniq([an({"date": rng.choice(DAYS), "campaign": rng.choice(CAMPAIGNS),
                                              "channel": c, "medium": m}) for c, m in [ch() for _ in range(20)]],
                                         ["date", "campaign", "channel", "medium"])
    rep["day_campaign_ads"] = uniq([ads({"date": rng.choice(DAYS), "campaign": rng.choice(CAMPAIGNS)}) for _ in range(10)],
                                   ["date", "campaign"])
    rep["day_adgroup_analytics"] = uniq([dict(an({"date": rng.choice(DAYS), "campaign": rng.choice(CAMPAIGNS),
                                                  "ad_group": rng.choice(GROUPS), "channel": c, "medium": m}),
                                              sessions=rng.randint(0, 8)) for c, m in [ch() for _ in range(25)]],
                                        ["date", "campaign", "ad_group", "channel", "medium"])
    rep["day_adgroup_ads"] = uniq([ads({"date": rng.choice(DAYS), "campaign": rng.choice(CAMPAIGNS),
                                        "ad_group": rng.choice(GROUPS)}) for _ in range(12)],
                                  ["date", "campaign", "ad_group"])
    nat = lambda dims: {"cost": money(rng), "clicks": rng.randint(0, 40), "impressions": rng.randint(0, 400),
                        "conversions": Decimal(rng.randint(0, 3)), "revenue": money(rng), **dims}
    iso = lambda d: f"{d[:4]}-{d[4:6]}-{d[6:]}"
    ncamp = uniq([nat({"data_date": iso(rng.choice(DAYS)), "campaign": rng.choice(CAMPAIGNS[:3])}) for _ in range(8)],
                 ["data_date", "campaign"])
    nadg = [nat({"data_date": iso(rng.choice(DAYS)), "campaign": rng.choice(CAMPAIGNS[:2]),
                 "ad_group": rng.choice(GROUPS[:3])}) for _ in range(8)]
    return rep, ncamp, nadg


def to_df(spark, rows, prop, extra_cols):
    cols = [c for c in extra_cols]
    types = {c: "string" for c in cols}
    for c in rows[0] if rows else []:
        if c not in types:
            t = METRIC_TYPES.get(c, "string")
            types[c] = t if isinstance(t, str) else t.simpleString()
    schema = ", ".join(f"`{c}` {t}" for c, t in types.items()) + ", property_name string, pos int"
    data = [tuple(r.get(c) for c in types) + (prop, i) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, schema)


SCHEMAS = {
    "range_analytics": ["campaign", "ad_group", "channel", "medium"],
    "range_ads": ["campaign", "ad_group"],
    "day_campaign_analytics": ["date", "campaign", "channel", "medium"],
    "day_campaign_ads": ["date", "campaign"],
    "day_adgroup_analytics": ["date", "campaign", "ad_group", "channel", "medium"],
    "day_adgroup_ads": ["date", "campaign", "ad_group"],
}


def f(x):
    return float(x)


@pytest.mark.parametrize("seed", [1, 2, 3, 4, 5, 6])
def test_against_row_model(spark, seed):
    rng = random.Random(seed)
    rep, ncamp, nadg = gen(rng)
    fx = 1.3492 if seed % 2 else 1.0
    frames = {k: to_df(spark, v, "p", SCHEMAS[k]) for k, v in rep.items()}
    native = {"campaign": to_df(spark, ncamp, "p", ["data_date", "campaign"]),
              "ad_group": to_df(spark, nadg, "p", ["data_date", "campaign", "ad_group"])}
    props = properties_dim(spark, [{"property_name": "p", "fx_divisor": fx}])
    got = ads_daily(frames, native, props).collect()
    fl = lambda rows: [{k: (f(v) if isinstance(v, Decimal) else v) for k, v in r.items()} for r in rows]
    exp = model({k: fl(v) for k, v in rep.items()}, fl(ncamp), fl(nadg), fx)
    key = lambda k, r: (k, round(r["cost"], 5), round(r["sessions"], 5))
    g = sorted(key((r.data_date, r.campaign, r.ad_group, r.session_default_channel_group, r.session_medium),
                   r.asDict()) for r in got)
    e = sorted(key(k, r) for k, r in exp)
    assert g == e
    gd = {(r.data_date, r.campaign, r.ad_group, r.session_default_channel_group, r.session_medium,
           round(r.cost, 5)): r.asDict() for r in got}
    for k, r in exp:
        row = gd[k + (round(r["cost"], 5),)]
        for m in ("revenue", "clicks", "impressions", "conversions", "revenue_ga4", "conversions_ga4",
                  "sessions_ga4", "roas", "ctr", "avg_cpc", "roas_ga4"):
            assert row[m] == pytest.approx(r[m], rel=1e-9, abs=2e-6), (k, m)


def test_carry_alternates(spark):
    """1.5 sessions per day over two equal ad groups: 2,1,2,1 for the first
    (half-even with carry), the residual taker gets the rest."""
    from channelmart.operators.reconcile import distribute
    days = [f"2024-01-0{i}" for i in range(1, 5)]
    gap = spark.createDataFrame([("p", d, "C", "Paid Search", "cpc", Decimal(0), Decimal(0), 3) for d in days],
                                "property_name string, data_date string, campaign string, channel string, medium string,"
                                " diff_revenue decimal(27,12), diff_conversions decimal(27,12), diff_sessions bigint")
    shares = spark.createDataFrame(
        [("p", "C", "g1", "Paid Search", "cpc", 2, 0.5, 0.5, 0.5, False, False, False),
         ("p", "C", "g2", "Paid Search", "cpc", 2, 0.5, 0.5, 0.5, True, True, True)],
        "property_name string, campaign string, ad_group string, channel string, medium string, n bigint,"
        " share_revenue double, share_conversions double, share_sessions double, last_revenue boolean,"
        " last_conversions boolean, last_sessions boolean")
    out = {(r.data_date, r.ad_group): r.dist_sessions for r in distribute(gap, shares).collect()}
    assert [out[(d, "g1")] for d in days] == [2, 1, 2, 1]
    assert [out[(d, "g2")] for d in days] == [1, 2, 1, 2]


def test_invariants_on_standin(spark):
    """Distributed sessions add up to the gap; weights of a group sum to 1."""
    from channelmart.operators.blend import session_share
    from channelmart.plans.queries import REGISTRY
    d = "/root/testdata/sf0.001"
    dist = REGISTRY["distribute_sessions_carry"](spark, d)
    gap = REGISTRY["daily_gap"](spark, d)
    k = ["property_name", "data_date", "campaign", "channel", "medium"]
    s = dist.groupBy(*k).agg(F.sum("dist_sessions").alias("s")).join(gap, k)
    assert s.where(F.col("s") != F.col("diff_sessions")).count() == 0
    w = REGISTRY["session_share"](spark, d)
    tot = w.groupBy("property_name", "data_date", "campaign", "ad_group").agg(
        F.sum("session_weight").alias("t"), F.sum("sessions_ga4").alias("s"), F.max(F.abs("sessions_ga4")).alias("m"), F.count("*").alias("n"))
    # (weights of 6 places; rows that cancel out to no sessions weigh 0)
    assert tot.where((F.col("s") != 0) | (F.col("m") == 0)).where(F.abs(F.col("t") - 1.0) > F.col("n") * 1e-6).count() == 0
    m = REGISTRY["ads_metrics"](spark, d)
    num = [c for c, t in m.dtypes if t == "double"]
    bad = m.where(F.greatest(*[F.isnan(c).cast("int") for c in num]) == 1).count()
    assert bad == 0
    inf = m.where(F.greatest(*[(F.abs(c) == float("inf")).cast("int") for c in num]) == 1).count()
    assert inf == 0


def test_carry_stays_within_half_a_session(spark):
    """Invariant (f): for every non-residual ad group the running difference
    between exact (diff x share) and allocated sessions -- its carry -- stays
    within [-0.5, 0.5] on every day."""
    from pyspark.sql import Window
    from channelmart.operators.reconcile import distribute, fan_out
    from channelmart.plans.queries import gap_and_shares
    gap, shares = gap_and_shares(spark, "/root/testdata/sf0.001")
    keys = ["property_name", "data_date", "campaign", "ad_group", "channel", "medium"]
    exact = (fan_out(gap, shares).where((F.col("n") >= 2) & ~F.col("last_sessions"))
             .select(*keys, (F.col("diff_sessions") * F.col("share_sessions")).alias("x")))
    alloc = distribute(gap, shares).select(*keys, "dist_sessions")
    w = (Window.partitionBy("property_name", "campaign", "ad_group", "channel", "medium")
         .orderBy("data_date").rowsBetween(Window.unboundedPreceding, 0))
    carry = (exact.join(alloc, keys)
             .select((F.sum("x").over(w) - F.sum("dist_sessions").over(w)).alias("carry")))
    assert carry.count() > 0
    assert carry.where(F.abs("carry") > 0.5 + 1e-9).count() == 0


def test_blend_preserves_native_totals(spark):
    """Invariant (c): splitting native metrics by session weight keeps each
    native row's total (per day, campaign and ad group)."""
    from channelmart.operators.hybrid import native_hybrid
    from channelmart.plans.queries import REGISTRY
    from channelmart.sources import standins as si
    d = "/root/testdata/sf0.001"
    nat = si.native_reports(si.ads_fine(spark, d))
    native = native_hybrid(nat["campaign"], nat["ad_group"]).where("data_date is not null")
    k = ["property_name", "data_date", "campaign", "ad_group"]
    blended = REGISTRY["ads_metrics"](spark, d).groupBy(*k).agg(F.sum("cost").alias("c"), F.sum("clicks").alias("k"))
    j = native.groupBy(*k).agg(F.sum(F.col("cost").cast("double")).alias("nc"),
                               F.sum(F.col("clicks").cast("double")).alias("nk")).join(blended, k, "full_outer")
    assert j.where(F.col("c").isNull() | F.col("nc").isNull()).count() == 0
    assert j.where((F.abs(F.col("c") - F.col("nc")) > 1e-4) | (F.abs(F.col("k") - F.col("nk")) > 1e-4)).count() == 0


def test_residual_taker_ties_and_equal_split(spark):
    """The residual taker is the smallest share; equal shares go to
    the latest first appearance; a zero weight total splits evenly."""
    from channelmart.operators.reconcile import target_shares
    rows = [  # ad group, (side, pos) of first appearance, revenue / conversions / sessions weights
        ("g1", (0, 3), Decimal("2"), Decimal("0"), 5),
        ("g2", (1, 0), Decimal("1"), Decimal("0"), 5),
        ("g3", (0, 1), Decimal("1"), Decimal("0"), 5),
        ("g4", (0, 7), Decimal("4"), Decimal("0"), 5),
    ]
    w = spark.createDataFrame(
        [("p", "C", g, "Paid Search", "cpc", {"side": s, "pos": p}, r, c, n) for g, (s, p), r, c, n in rows],
        "property_name string, campaign string, ad_group string, channel string, medium string,"
        " first_seen struct<side:int,pos:int>, w_revenue decimal(27,12), w_conversions decimal(27,12),"
        " w_sessions bigint")
    out = {r.ad_group: r for r in target_shares(w).collect()}
    assert {g: r.n for g, r in out.items()} == {"g1": 4, "g2": 4, "g3": 4, "g4": 4}
    # revenue: g2 and g3 tie at the smallest share 1/8; g2 appears last (ads side) and takes the rest
    assert [g for g, r in sorted(out.items()) if r.last_revenue] == ["g2"]
    assert out["g4"].share_revenue == pytest.approx(0.5)
    # conversions: total 0 -> equal shares 1/4; the taker is the latest first appearance overall
    assert all(r.share_conversions == pytest.approx(0.25) for r in out.values())
    assert [g for g, r in sorted(out.items()) if r.last_conversions] == ["g2"]
    # sessions: equal positive weights, same tie rule
    assert [g for g, r in sorted(out.items()) if r.last_sessions] == ["g2"]


def _window_partitions(df):
    """Partition-key lists of every Window operator in the physical plan."""
    import re
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", m) for m in re.findall(r"\+- Window \[.*?\], \[([^\]]*)\]", plan)]


def test_no_window_over_campaign_groups(spark):
    """Scale guard: shares, takers and residuals are aggregates, never windows
    over a whole campaign; the windows left in the blended table are
    partitioned by ad group (bounded by channel x medium rows)."""
    from channelmart.operators.reconcile import (active_campaign_days, daily_gap, discrepancy_weights,
                                                 distribute, real_targets, target_shares)
    from channelmart.plans.ads_daily import ads_daily, overlays
    from channelmart.sources import standins as si
    d = "/root/testdata/sf0.001"
    fine = si.ads_fine(spark, d)
    t, cd, ad = overlays(si.ads_reports(fine))
    T = real_targets(t)
    shares = target_shares(discrepancy_weights(T, ad))
    dist = distribute(daily_gap(active_campaign_days(cd), T, ad), shares, observed=ad)
    assert _window_partitions(shares) == []
    assert _window_partitions(dist) == []
    full = ads_daily(si.ads_reports(fine), si.native_reports(fine), si.ads_properties(spark))
    parts = _window_partitions(full)
    assert parts and all("ad_group" in p for p in parts), parts


def test_hot_campaign_fan_out_is_split_by_aqe(spark):
    """One campaign holds most campaign-day rows. Beyond the broadcast bound
    the fan-out is a shuffle join; AQE splits the hot partition (skew=true in
    the final plan) and the rows are the same as without the split."""
    from channelmart.operators.reconcile import fan_out
    gap = spark.range(6000).selectExpr(
        "'p' as property_name", "date_format(date_add(date'2000-01-01', cast(id % 3000 as int)), 'yyyy-MM-dd') as data_date",
        "case when id < 4000 then 'H' else concat('C', cast(id % 40 as string)) end as campaign",
        "'Paid Search' as channel", "'cpc' as medium", "cast(id % 7 as decimal(27,12)) as diff_revenue"
    ).dropDuplicates(["property_name", "data_date", "campaign", "channel", "medium"])
    shares = spark.range(120).selectExpr(
        "'p' as property_name", "case when id < 3 then 'H' else concat('C', cast(id % 40 as string)) end as campaign",
        "concat('g', cast(id as string)) as ad_group", "'Paid Search' as channel", "'cpc' as medium",
        "cast(1.0 / 3 as double) as share_revenue")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        split = fan_out(gap, shares)
        got = sorted(tuple(r) for r in split.collect())
        plan = split._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        plain = sorted(tuple(r) for r in fan_out(gap, shares).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "skew=true" in plan
    assert got == plain and len(got) > 0


def test_distributed_money_adds_up_to_the_gap_exactly(spark):
    """Invariant (a) for revenue and conversions: per campaign-day the
    distributed amounts (exact decimals) sum to the gap, to the last digit."""
    from channelmart.operators.reconcile import distribute
    from channelmart.plans.queries import gap_and_shares
    gap, shares = gap_and_shares(spark, "/root/testdata/sf0.001")
    k = ["property_name", "data_date", "campaign", "channel", "medium"]
    sums = (distribute(gap, shares).groupBy(*k)
            .agg(F.sum("dist_revenue").alias("r"), F.sum("dist_conversions").alias("c")))
    j = sums.join(gap, k)
    assert j.count() > 0
    assert j.where((F.col("r") != F.col("diff_revenue")) | (F.col("c") != F.col("diff_conversions"))).count() == 0


def test_native_hybrid_rules(spark):
    """J1 + A1: ad-group rows are kept as they are (duplicates too) when their
    campaign-day has a campaign row; a campaign-day with no ad-group rows
    becomes one '(campaign level)' row carrying the campaign row's last
    values; ad-group rows without a campaign row are dropped."""
    from channelmart.operators.hybrid import native_hybrid
    m = "cost decimal(27,12), clicks bigint, impressions bigint, conversions decimal(27,12), revenue decimal(27,12)"
    camp = spark.createDataFrame(
        [("p", "2024-01-01", "A", Decimal(9), 9, 9, Decimal(9), Decimal(9), 0),
         ("p", "2024-01-01", "B", Decimal(1), 1, 1, Decimal(1), Decimal(1), 1),
         ("p", "2024-01-01", "B", Decimal(2), 2, 2, Decimal(2), Decimal(2), 2)],   # later row wins
        f"property_name string, data_date string, campaign string, {m}, pos int")
    adg = spark.createDataFrame(
        [("p", "2024-01-01", "A", "g", Decimal(1), 1, 1, Decimal(0), Decimal(0), 0),
         ("p", "2024-01-01", "A", "g", Decimal(1), 1, 1, Decimal(0), Decimal(0), 1),   # duplicate kept
         ("p", "2024-01-01", "C", "h", Decimal(5), 5, 5, Decimal(0), Decimal(0), 2)],  # no campaign row
        f"property_name string, data_date string, campaign string, ad_group string, {m}, pos int")
    got = sorted((r.campaign, r.ad_group, int(r.cost)) for r in native_hybrid(camp, adg).collect())
    assert got == [("A", "g", 1), ("A", "g", 1), ("B", "(campaign level)", 2)]


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def test_a_hot_campaign_is_folded_by_many_tasks(spark):
    """With broadcasts off the session fold still exchanges on the whole
    target key, so no task holds all ad groups of a hot campaign, and the fold
    is evaluated once."""
    from channelmart.operators.reconcile import distribute, distribute_sessions
    gap = spark.createDataFrame([("p", f"2024-01-{d:02}", "H", "Paid Search", "cpc", Decimal(d), Decimal(1), 7 * d) for d in range(1, 29)],
                                "property_name string, data_date string, campaign string, channel string, medium string,"
                                " diff_revenue decimal(27,12), diff_conversions decimal(27,12), diff_sessions bigint")
    shares = spark.createDataFrame(
        [("p", "H", f"g{g:02}", "Paid Search", "cpc", 60, 1 / 60, 1 / 60, 1 / 60, g == 59, g == 59, g == 59) for g in range(60)],
        "property_name string, campaign string, ad_group string, channel string, medium string, n bigint,"
        " share_revenue double, share_conversions double, share_sessions double, last_revenue boolean,"
        " last_conversions boolean, last_sessions boolean")
    plain = sorted(tuple(r) for r in distribute(gap, shares).collect())
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    try:
        for k, v in NO_BROADCAST.items():
            spark.conf.set(k, v)
        df = distribute_sessions(gap, shares)
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = sorted(tuple(r) for r in distribute(gap, shares).collect())
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    import re
    keys = [re.sub(r"#\d+L?", "", m) for m in re.findall(r"hashpartitioning\(([^)]*)\)[^\n]*REPARTITION_BY_COL", plan)]
    assert any("ad_group" in k and "medium" in k for k in keys)
    assert "outer=true" in plan.replace(" ", "").lower() or "true, [data_date" in plan
    assert got == plain and len(got) == 28 * 60


def python_carry(days, share):
    out, carry = [], 0.0
    for d, x in days:
        exact = x * share + carry
        alloc = round(exact)
        carry = exact - alloc
        out.append((d, alloc))
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 500, 1000, 2000])
def test_two_level_carry_equals_the_plain_one(spark, n):
    from channelmart.operators.reconcile import session_carry
    rng = random.Random(n)
    days = [(f"d{k:05}", rng.randint(1, 9)) for k in range(n)]
    fanned = spark.createDataFrame(days, "data_date string, diff_sessions bigint").selectExpr(
        "'p' as property_name", "data_date", "'C' as campaign", "'g' as ad_group", "'Paid Search' as channel", "'cpc' as medium",
        "2 as n", "false as last_sessions", "0.37D as share_sessions", "diff_sessions")
    got = [(r.data_date, r.alloc_sessions) for r in session_carry(fanned).orderBy("data_date").collect()]
    assert got == python_carry(days, 0.37)


def test_carry_does_not_grow_with_the_square_of_the_days(spark):
    """Rows of 500, 1,000 and 2,000 days in as many ad groups that the rows are the same: a
    fold that copies its result at each step takes four times as long for 2,000 days as for 500."""
    import time
    from channelmart.operators.reconcile import session_carry

    def seconds(days, groups):
        fanned = spark.range(days * groups).selectExpr(
            "'p' as property_name", f"lpad(cast(id % {days} as string), 5, '0') as data_date", "'C' as campaign",
            f"concat('g', cast(id div {days} as string)) as ad_group", "'Paid Search' as channel", "'cpc' as medium",
            "2 as n", "false as last_sessions", "0.37D as share_sessions", "id % 9 + 1 as diff_sessions")
        t0 = time.perf_counter()
        session_carry(fanned).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0
    seconds(500, 400)
    few, some, many = (min(seconds(days, 400_000 // days) for _ in range(3)) for days in (500, 1000, 2000))
    assert many < 3 * few and some < 2.5 * few, (few, some, many)


def test_joins_on_the_rows_own_key_need_no_exchange_of_them(spark):
    """With broadcasts off, the fanned-out rows, the folded sessions and the
    observed rows are scanned by buckets; on their key only the residual
    takers' rows are exchanged."""
    import re
    from channelmart.operators.reconcile import distribute
    from channelmart.plans.ads_daily import overlays
    from channelmart.operators.reconcile import active_campaign_days, daily_gap, period_shares
    from channelmart.sources import standins as si
    t, cd, ad = overlays(si.ads_reports(si.ads_fine(spark, "/root/testdata/sf0.001")))
    shares = period_shares(t, ad)
    gap = daily_gap(active_campaign_days(cd), shares, ad)
    plain = sorted(map(str, distribute(gap, shares, observed=ad).collect()))
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    try:
        for k, v in NO_BROADCAST.items():
            spark.conf.set(k, v)
        df = distribute(gap, shares, observed=ad)
        plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())
        got = sorted(map(str, df.collect()))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == plain
    keys = "property_name, data_date, campaign, ad_group, channel, medium"
    assert plan.count(f"Exchange hashpartitioning({keys},") <= 2
    joins = re.findall(r"SortMergeJoin \[([^\]]*)\], \[[^\]]*\], LeftOuter", plan)
    assert sum(j == keys for j in joins) == 4
    assert not re.findall(r"hashpartitioning\(property_name, campaign, channel, medium,", plan)
    assert plan.count("Bucketed: true") >= 3
