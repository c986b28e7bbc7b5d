"""C2 + C3: blend ads-platform rows with reconciled analytics rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from channelmart.functions.exprs import PAID_MEDIUM, default_channel, safe_ratio

# The output columns, in order.
OUTPUT_COLUMNS = [
    "property_name", "property_type", "data_date", "campaign", "ad_group",
    "session_default_channel_group", "session_medium", "cost", "revenue", "roas",
    "clicks", "impressions", "ctr", "avg_cpc", "conversions", "sessions",
    "revenue_ga4", "conversions_ga4", "roas_ga4", "sessions_ga4",
]
NATIVE_METRICS = ["cost", "clicks", "impressions", "conversions", "revenue"]
DAY_AD_GROUP = ["property_name", "data_date", "campaign", "ad_group"]


def session_share(reconciled: DataFrame) -> DataFrame:
    """W1 + A4 + A5: each channel row's share of its (property, day, campaign,
    ad group) sessions; a zero total splits evenly when the row has zero
    sessions itself, else weighs 0 (the source's infinite weight ends as 0).
    The window holds one ad group's rows of one day: one per channel and
    medium, a bound set by the channel groups, not by the data volume."""
    w = Window.partitionBy(*DAY_AD_GROUP)
    total = F.sum("sessions_ga4").over(w)
    size = F.count("channel").over(w)
    weight = (F.when(total != 0, F.col("sessions_ga4").cast("double") / total.cast("double"))
              .when(F.col("sessions_ga4") == 0, F.lit(1.0) / size)
              .otherwise(F.lit(0.0)))
    return reconciled.withColumn("session_weight", weight)


def blend(native: DataFrame, reconciled: DataFrame, properties: DataFrame) -> DataFrame:
    """Native rows left join weighted analytics rows on (property, day,
    campaign, ad group). Native metrics are split by the session weight
    (unmatched rows keep weight 1); analytics metrics are not split; missing
    channel -> the campaign default, medium -> 'cpc', analytics zeros; the
    property's FX divisor applies to analytics revenue; sessions copies the
    analytics sessions."""
    weighted = session_share(reconciled)
    j = native.join(weighted, DAY_AD_GROUP, "left").join(properties, "property_name", "left")
    wt = F.coalesce(F.col("session_weight"), F.lit(1.0))
    fx = F.coalesce(F.col("fx_divisor"), F.lit(1.0))
    sessions = F.coalesce(F.col("sessions_ga4").cast("double"), F.lit(0.0))
    return j.select(
        "property_name",
        F.coalesce(F.col("property_type"), F.col("property_name")).alias("property_type"),
        "data_date", "campaign", "ad_group",
        F.coalesce(F.col("channel"), default_channel("campaign")).alias("session_default_channel_group"),
        F.coalesce(F.col("medium"), F.lit(PAID_MEDIUM)).alias("session_medium"),
        *[F.coalesce(F.col(m).cast("double") * wt, F.lit(0.0)).alias(m) for m in NATIVE_METRICS],
        (F.coalesce(F.col("revenue_ga4").cast("double"), F.lit(0.0)) / fx).alias("revenue_ga4"),
        F.coalesce(F.col("conversions_ga4").cast("double"), F.lit(0.0)).alias("conversions_ga4"),
        sessions.alias("sessions_ga4"),
        sessions.alias("sessions"),
    )


def derive_metrics(df: DataFrame) -> DataFrame:
    """Ratios where x/0 and 0/0 are 0, then the fixed output column list
    (absent columns become null); rows without a day are dropped (F11)."""
    out = (df.withColumn("roas", safe_ratio("revenue", "cost"))
             .withColumn("ctr", safe_ratio("clicks", "impressions", scale=100))
             .withColumn("avg_cpc", safe_ratio("cost", "clicks"))
             .withColumn("roas_ga4", safe_ratio("revenue_ga4", "cost")))
    present = set(out.columns)
    return (out.where(F.col("data_date").isNotNull())
               .select(*[F.col(c) if c in present else F.lit(None).alias(c) for c in OUTPUT_COLUMNS]))
