"""Give back to ad groups what privacy thresholding hid.

Per (property, day, campaign, channel, medium) the campaign-level analytics
numbers exceed the sum of the visible ad-group rows; the gap is spread over
the campaign's target ad groups in proportion to each one's period
discrepancy (target minus observed). Revenue and conversions are rounded
half-even to 6 decimals, sessions to integers with a per-ad-group carry that
moves the rounding remainder to the next active day; the lowest-share ad
group takes the residual. Everything is keyed by ``property_name``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from channelmart.functions.exprs import (CAMPAIGN_LEVEL, clamp0, is_named_campaign,
                                         is_real_ad_group, rint_places)
from channelmart.session import stage, stage_bucketed
from channelmart.operators.overlay import (ADGROUP_DAY_KEYS, ALL_METRICS, AN_METRICS,
                                           CAMPAIGN_DAY_KEYS, TARGET_KEYS)

CAMPAIGN = ["property_name", "campaign"]
PAIR = ["property_name", "campaign", "ad_group"]
GROUP = ["property_name", "campaign", "channel", "medium"]          # W2/W3/W6/J9 key
SHARED = ("revenue", "conversions")                                  # 6-decimal metrics
ALLOC = DecimalType(30, 6)
RECONCILED_COLS = ["property_name", "data_date", "campaign", "ad_group", "channel", "medium",
                   "revenue_ga4", "conversions_ga4", "sessions_ga4"]


def real_targets(targets: DataFrame) -> DataFrame:
    """targets with a real ad group (the set ``T``)."""
    return targets.where(is_real_ad_group("ad_group"))


def discrepancy_weights(T: DataFrame, adgroup_day: DataFrame) -> DataFrame:
    """J5 + A2 + J6 + P25: observed = daily ad-group rows of target (campaign,
    ad group) pairs (any channel) summed over the period; weight = max(0,
    target - observed) per metric. Weights are constant over the range."""
    observed = (adgroup_day.join(T.select(*PAIR).distinct(), PAIR, "left_semi")
                .groupBy(*TARGET_KEYS)
                .agg(*[F.sum(m).alias(f"obs_{m}") for m in ALL_METRICS]))
    w = T.join(observed, TARGET_KEYS, "left")
    return w.select(*TARGET_KEYS, "first_seen",
                    *[clamp0(F.col(m) - F.coalesce(F.col(f"obs_{m}"), F.lit(0))).alias(f"w_{m}")
                      for m in ALL_METRICS])


def active_campaign_days(campaign_day: DataFrame) -> DataFrame:
    """F2 + F4: named campaigns with any activity; conversions do not count."""
    active = ((F.col("cost") > 0) | (F.col("clicks") > 0) | (F.col("impressions") > 0)
              | (F.col("revenue") > 0) | (F.col("sessions") > 0))
    return campaign_day.where(is_named_campaign("campaign") & active)


def campaign_level_rows(active: DataFrame, T: DataFrame) -> DataFrame:
    """Campaigns without any real target ad group report at campaign level."""
    return (active.join(T.select(*CAMPAIGN).distinct(), CAMPAIGN, "left_anti")
            .select("property_name", "data_date", "campaign", F.lit(CAMPAIGN_LEVEL).alias("ad_group"),
                    "channel", "medium",
                    F.col("revenue").alias("revenue_ga4"), F.col("conversions").alias("conversions_ga4"),
                    F.col("sessions").alias("sessions_ga4")))


def day_totals(adgroup_day: DataFrame) -> DataFrame:
    """A3: what a day's ad-group rows (all of them, '(not set)' included) add
    up to per campaign, channel and medium."""
    return adgroup_day.groupBy(*CAMPAIGN_DAY_KEYS).agg(*[F.sum(m).alias(f"tot_{m}") for m in AN_METRICS])


def daily_gap(active: DataFrame, T: DataFrame, adgroup_day: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """J8 + A3 + P25: per targeted campaign-day row, the part of revenue,
    conversions and sessions not visible in that day's ad-group rows.
    ``totals``: ``day_totals`` of the same rows, when the caller has them."""
    targeted = active.join(T.select(*CAMPAIGN).distinct(), CAMPAIGN, "left_semi")
    if totals is None:
        totals = day_totals(adgroup_day)
    g = targeted.join(totals, CAMPAIGN_DAY_KEYS, "left")
    return g.select(*CAMPAIGN_DAY_KEYS,
                    *[clamp0(F.col(m) - F.coalesce(F.col(f"tot_{m}"), F.lit(0))).alias(f"diff_{m}")
                      for m in AN_METRICS])


def target_shares(weights: DataFrame) -> DataFrame:
    """W2 + W3 + W5, once per target (period level, before any fan-out): for
    each metric its share of the (campaign, channel, medium) weight (equal
    shares when the weights sum to <= 0) and whether it is the residual taker:
    the last by share descending, ties by first appearance, i.e. the smallest
    share and, among equal shares, the latest first appearance.

    Group sizes, totals and takers are aggregates (map-side partial sums,
    ``max_by``), joined back on the group key, instead of windows: a campaign
    holding most ad groups is pre-aggregated in pieces and never sorted or
    buffered whole by one task, and the joins stay open to AQE skew splits."""
    stats = weights.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"w_{m}").alias(f"tot_{m}") for m in AN_METRICS])
    out = weights.join(stats, GROUP)
    for m in AN_METRICS:
        tot = F.col(f"tot_{m}")
        out = out.withColumn(f"share_{m}", F.when(tot <= 0, F.lit(1.0) / F.col("n")).otherwise(
            F.col(f"w_{m}").cast("double") / tot.cast("double")))
    takers = out.groupBy(*GROUP).agg(*[
        F.max_by("ad_group", F.struct((F.lit(0.0) - F.col(f"share_{m}")).alias("neg_share"),
                                      F.col("first_seen"))).alias(f"taker_{m}")
        for m in AN_METRICS])
    out = out.join(takers, GROUP)
    return out.select(*TARGET_KEYS, "n", *[f"share_{m}" for m in AN_METRICS],
                      *[(F.col("ad_group") == F.col(f"taker_{m}")).alias(f"last_{m}") for m in AN_METRICS])


def fan_out(gap: DataFrame, shares: DataFrame) -> DataFrame:
    """Each campaign-day gap row x every target ad group of the same
    (campaign, channel, medium); no such target -> the row is dropped."""
    return gap.join(shares, GROUP, "inner")


def session_carry(fanned: DataFrame) -> DataFrame:
    """Integer session allocation with carry for the non-residual ad
    groups of groups with n >= 2. Over the ad group's active days ascending:
    exact = diff*share + carry; alloc = rint(exact); carry = exact - alloc.
    One ordered fold per (property, campaign, channel, medium, ad group), in
    the JVM (``aggregate``); a group holds one row per active day of the run.
    The rows are exchanged on that whole key: a plain ``groupBy`` would reuse
    a partitioning by campaign and fold a hot campaign in one task. Appending
    to a result copies it, so the days are folded in blocks of about their
    square root and the blocks' results are appended: of n days no array
    longer than sqrt(n) is copied at a step. Days with no session gap are left
    out: there exact = 0*share + carry = carry, |carry| <= 0.5 rounds
    (half-even) to 0, so the allocation is 0 and the carry is unchanged -- an
    exact no-op. Callers treat a missing day as 0."""
    rows = fanned.where((F.col("n") >= 2) & ~F.col("last_sessions") & (F.col("diff_sessions") > 0))
    day = F.struct(F.col("data_date").alias("d"), F.col("diff_sessions").cast("double").alias("x"))
    seq = (rows.select(*TARGET_KEYS, "data_date", "diff_sessions", "share_sessions").repartition(*TARGET_KEYS)
           .groupBy(*TARGET_KEYS)
           .agg(F.array_sort(F.collect_list(day)).alias("days"), F.first("share_sessions").alias("share")))
    seq = seq.withColumn("size", F.ceil(F.sqrt(F.size("days"))).cast("int"))
    starts = F.sequence(F.lit(1), F.size("days"), F.col("size"))
    seq = seq.withColumn("blocks", F.transform(starts, lambda at: F.slice("days", at, F.col("size"))))
    alloc_type = "array<struct<data_date:string,alloc_sessions:bigint>>"

    def state(carry: Column, out_type: str) -> Column:
        return F.struct(carry.alias("carry"), F.array().cast(out_type).alias("out"))

    def step(acc, e):
        exact = e["x"] * F.col("share") + acc["carry"]
        alloc = F.rint(exact)
        return F.struct((exact - alloc).alias("carry"),
                        F.array_append(acc["out"], F.struct(e["d"].alias("data_date"),
                                                            alloc.cast("bigint").alias("alloc_sessions"))).alias("out"))

    def block(acc, days):
        done = F.aggregate(days, state(acc["carry"], alloc_type), step)
        # bound to a name by transform, so that a block is folded once
        return F.transform(F.array(done), lambda x: F.struct(x["carry"].alias("carry"), F.array_append(acc["out"], x["out"]).alias("out")))[0]

    folded = seq.select(*TARGET_KEYS, F.flatten(F.aggregate("blocks", state(F.lit(0.0), f"array<{alloc_type}>"), block)["out"]).alias("out"))
    # inline would make Spark test the size of the fold first and run it twice
    return folded.select(*TARGET_KEYS, F.inline_outer("out")).where(F.col("data_date").isNotNull())


def staged_fan_out(gap: DataFrame, shares: DataFrame) -> DataFrame:
    """J9 once for all that read it, bucketed by the rows' own key: the joins
    below on ADGROUP_DAY_KEYS need no exchange of it. The fan-out's join on
    the campaign group stays a shuffle join that AQE splits, as a campaign may
    hold most rows."""
    columns = [f"{c}_{m}" for m in AN_METRICS for c in ("diff", "share", "last")]
    return stage_bucketed(fan_out(gap, shares).select(*ADGROUP_DAY_KEYS, "n", *columns), "fan-out", ADGROUP_DAY_KEYS)


def _residuals(fanned: DataFrame, given: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """The rows of each campaign-day's residual takers (at most one ad
    group a metric), with what the other ad groups (``given``) have left."""
    takers = (fanned.where((F.col("n") >= 2) & reduce(or_, [F.col(f"last_{m}") for m in metrics]))
              .select(*ADGROUP_DAY_KEYS, *[f"{c}_{m}" for m in metrics for c in ("last", "diff")]))
    left = takers.join(given, CAMPAIGN_DAY_KEYS, "left")
    return left.select(*ADGROUP_DAY_KEYS, *[
        F.when(F.col(f"last_{m}"), F.col(f"diff_{m}") - F.coalesce(F.col(f"given_{m}"), F.lit(0))).alias(f"res_{m}")
        for m in metrics])


def _part(m: str) -> Column:
    """A non-residual ad group's rounded part of the gap."""
    return rint_places(F.col(f"diff_{m}").cast("double") * F.col(f"share_{m}"), 6).cast(ALLOC)


def _money_rest(f: DataFrame) -> DataFrame:
    """W6 + P26: the residual takers' rest of revenue and conversions."""
    given = (f.where(F.col("n") >= 2).groupBy(*CAMPAIGN_DAY_KEYS)
             .agg(*[F.sum(F.when(~F.col(f"last_{m}"), _part(m))).alias(f"given_{m}") for m in SHARED]))
    return _residuals(f, given, SHARED)


def _money() -> list[Column]:
    return [F.coalesce(F.when(F.col("n") == 1, F.col(f"diff_{m}")).when(~F.col(f"last_{m}"), _part(m)), F.col(f"res_{m}")).alias(f"dist_{m}") for m in SHARED]


def _session_parts(f: DataFrame, staged: bool = False) -> tuple[DataFrame, DataFrame]:
    """W4 + W6: the folded sessions and the residual takers' rest. The fold is
    read twice, from one exchange, or ``staged`` by its rows' key."""
    carry = session_carry(f).select(*ADGROUP_DAY_KEYS, "alloc_sessions")
    if staged:
        carry = stage_bucketed(carry, "carry", ADGROUP_DAY_KEYS)
    given = carry.groupBy(*CAMPAIGN_DAY_KEYS).agg(F.sum("alloc_sessions").alias("given_sessions"))
    return carry, _residuals(f, given, ("sessions",))


def _attach(f: DataFrame, *parts: DataFrame) -> DataFrame:
    return reduce(lambda j, part: j.join(part, ADGROUP_DAY_KEYS, "left"), parts, f)


def _sessions() -> Column:
    own = F.when(F.col("n") == 1, F.col("diff_sessions"))
    return F.coalesce(own, F.col("alloc_sessions"), F.col("res_sessions"), F.lit(0).cast("bigint")).alias("dist_sessions")


def distribute_money(gap: DataFrame, shares: DataFrame) -> DataFrame:
    """J9 + W6 + P26: the distributed revenue and conversions of every
    fanned-out row. n = 1 takes the whole gap unrounded; otherwise non-residual
    groups get rint(diff*share*1e6)/1e6 and the residual taker gets diff minus
    the others (may be negative)."""
    f = staged_fan_out(gap, shares)
    return _attach(f, _money_rest(f)).select(*ADGROUP_DAY_KEYS, *_money())


def distribute_sessions(gap: DataFrame, shares: DataFrame) -> DataFrame:
    """J9 + W4 + W6: the distributed sessions of every fanned-out row."""
    f = staged_fan_out(gap, shares)
    return _attach(f, *_session_parts(f)).select(*ADGROUP_DAY_KEYS, _sessions())


def distribute(gap: DataFrame, shares: DataFrame, observed: DataFrame | None = None) -> DataFrame:
    """Money and sessions of every fanned-out row; ``observed`` (J10), when
    given, is joined on the same six keys. The fanned-out rows, the folded
    sessions and a staged ``observed`` are bucketed by these, so only the
    residual takers' rows are exchanged."""
    f = staged_fan_out(gap, shares)
    j = _attach(f, _money_rest(f), *_session_parts(f, staged=True))
    seen = []
    if observed is not None:
        seen = [f"obs_{m}" for m in AN_METRICS]
        j = j.join(observed.select(*ADGROUP_DAY_KEYS, *[F.col(m).alias(f"obs_{m}") for m in AN_METRICS]),
                   ADGROUP_DAY_KEYS, "left")
    return j.select(*ADGROUP_DAY_KEYS, *_money(), _sessions(), *seen)


def period_shares(targets: DataFrame, adgroup_day: DataFrame) -> DataFrame:
    """Weights and shares of the real targets, computed once per run and
    staged in the shared folder: they are period-level (one row per target,
    not per day) and read by the fan-out's consumers. The files' size is then
    known to Spark, which broadcasts them only if they fit its limit; beyond
    it the fan-out is a shuffle join open to AQE's skew splits."""
    return stage(target_shares(discrepancy_weights(real_targets(targets), adgroup_day)), "period-shares")


def reconcile_daily(targets: DataFrame, campaign_day: DataFrame, adgroup_day: DataFrame,
                    shares: DataFrame | None = None, totals: DataFrame | None = None) -> DataFrame:
    """Reconciled analytics rows per (property, day, campaign, ad group,
    channel, medium): campaign-level rows for campaigns with no target ad
    group, else observed (or 0) + distributed gap for every target ad group
    of the row's channel/medium (J10). ``shares`` and ``totals``:
    ``period_shares`` and ``day_totals`` of the same inputs, when the caller
    already built them."""
    if shares is None:
        shares = period_shares(targets, adgroup_day)
    # The shares hold exactly the rows of T, so they also name T's campaigns
    # for the semi/anti joins below.
    T = shares
    active = active_campaign_days(campaign_day)
    gap = daily_gap(active, T, adgroup_day, totals)
    j = distribute(gap, shares, observed=adgroup_day)
    detailed = j.select(
        *ADGROUP_DAY_KEYS,
        (F.coalesce(F.col("obs_revenue"), F.lit(0)) + F.col("dist_revenue")).alias("revenue_ga4"),
        (F.coalesce(F.col("obs_conversions"), F.lit(0)) + F.col("dist_conversions")).alias("conversions_ga4"),
        (F.coalesce(F.col("obs_sessions"), F.lit(0)) + F.col("dist_sessions")).alias("sessions_ga4"),
    )
    level = campaign_level_rows(active, T)
    return detailed.select(*RECONCILED_COLS).unionByName(
        level.select(*[F.col(c).cast(detailed.schema[c].dataType) for c in RECONCILED_COLS]))
