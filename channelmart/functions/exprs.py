"""Scalar Column builders used by every job.

Nothing here runs Python per row: each helper returns a Catalyst expression,
so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

__all__ = [
    "NOT_SET", "CAMPAIGN_LEVEL", "NAME_DEFAULT", "PAID_MEDIUM", "MONEY",
    "col_", "nonblank", "first_non_empty", "compact_to_iso", "default_channel",
    "is_named_campaign", "is_real_ad_group", "safe_ratio", "rint_places",
    "clamp0", "date_prefix", "parse_and_shift", "to_money", "micros_to_money", "money_text",
    "booking_agent", "metric_or_zero",
]

# ---------------------------------------------------------------------------
# These must equal the source system's literals for the
# results to match.
NOT_SET = "(not set)"                 # analytics placeholder for a missing name
CAMPAIGN_LEVEL = "(campaign level)"   # ad group label when only campaign data exists
NAME_DEFAULT = "N/A"                  # missing campaign / ad group in ads search rows
PAID_MEDIUM = "cpc"                   # medium given to ads-platform rows
CROSS_NETWORK = "Cross-network"       # default channel of performance-max campaigns
PAID_SEARCH = "Paid Search"           # default channel of every other campaign
PMAX_MARKERS = ("performance max", "pmax", "performance_max")
# ---------------------------------------------------------------------------

# Money and fractional metrics are summed exactly; doubles appear only where a
# share or ratio is taken, so results do not depend on summation order.
MONEY = DecimalType(27, 12)


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonblank(c: str | Column) -> Column:
    """NULL for null or empty text, else the value (empty string counts as missing)."""
    c = col_(c)
    return F.when(c != F.lit(""), c)


def first_non_empty(*cols: str | Column, default: str | Column | None = "") -> Column:
    """First argument that is neither null nor '' (P17/P18), else ``default``."""
    parts = [nonblank(col_(c).cast("string")) for c in cols]
    if default is not None:
        parts.append(default if isinstance(default, Column) else F.lit(default))
    return F.coalesce(*parts)


def compact_to_iso(c: str | Column) -> Column:
    """'YYYYMMDD' -> 'YYYY-MM-DD' by position, as the report dates are built."""
    c = col_(c)
    return F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))


def default_channel(campaign: str | Column) -> Column:
    """Channel assumed for ads-platform rows: performance-max campaigns are
    cross-network, everything else (and a missing name) is paid search."""
    name = F.lower(col_(campaign))
    hit = None
    for marker in PMAX_MARKERS:
        cond = F.contains(name, F.lit(marker))
        hit = cond if hit is None else (hit | cond)
    return F.when(F.coalesce(hit, F.lit(False)), F.lit(CROSS_NETWORK)).otherwise(F.lit(PAID_SEARCH))


def is_named_campaign(campaign: str | Column) -> Column:
    """Drop the placeholder and names with no visible character (F2); white
    space is what Unicode and the ASCII separators 1C-1F make of it."""
    c = col_(campaign)
    return (c != F.lit(NOT_SET)) & c.rlike(r"(?U)[^\s\x1c-\x1f]")


def is_real_ad_group(ad_group: str | Column) -> Column:
    """Exactly the placeholder or '' is not an ad group; no trimming."""
    return ~col_(ad_group).isin(NOT_SET, "")


def safe_ratio(num: str | Column, den: str | Column, scale: float | None = None) -> Column:
    """num/den as double where x/0 and 0/0 give 0.0."""
    q = F.try_divide(col_(num).cast("double"), col_(den).cast("double"))
    if scale is not None:
        q = q * F.lit(float(scale))
    return F.coalesce(F.when(~F.isnan(q), q), F.lit(0.0))


def rint_places(c: str | Column, places: int) -> Column:
    """Round half to even at ``places`` decimals (P26); Spark's round is half-up."""
    m = float(10 ** places)
    return F.rint(col_(c) * F.lit(m)) / F.lit(m)


def clamp0(c: str | Column) -> Column:
    """max(0, c) for any numeric type (P25)."""
    return F.greatest(F.lit(0), col_(c))


def date_prefix(c: str | Column) -> Column:
    """First ten characters of the text form."""
    return F.substring(F.coalesce(col_(c).cast("string"), F.lit("")), 1, 10)


# Reservation times: 'date time' or 'dateTtime', fields may be unpadded (the
# source parser accepts both). Checked by pattern first so the fast built-in
# cast does the parsing and a bad value costs no exception.
_TS_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}:\d{1,2}$"


def parse_and_shift(c: str | Column, hours: int = -3) -> Column:
    """trim, first 19 chars, parse (either separator), shift by ``hours`` and
    return the date; unparsable -> first 10 chars of the trimmed text;
    null or '' -> '' (P20). ``hours=0`` gives the day of the text itself."""
    raw = F.trim(F.coalesce(col_(c).cast("string"), F.lit("")))
    head = F.substring(raw, 1, 19)
    parsed = F.when(head.rlike(_TS_TEXT), head.try_cast("timestamp"))
    shifted = F.to_date(parsed + F.make_interval(hours=F.lit(hours))).cast("string")
    return F.coalesce(shifted, F.substring(raw, 1, 10))


def micros_to_money(c: str | Column) -> Column:
    """Micros as text or number -> exact money (P7); missing -> 0."""
    micros = F.coalesce(col_(c).cast("string").try_cast(DecimalType(30, 6)), F.lit(0).cast(DecimalType(30, 6)))
    return (micros / F.lit(1000000).cast(DecimalType(7, 0))).cast(MONEY)


def to_money(c: str | Column) -> Column:
    """Text or number -> exact decimal; missing -> 0."""
    return F.coalesce(col_(c).cast("string").try_cast(MONEY), F.lit(0).cast(MONEY))


def metric_or_zero(c: str | Column, kind: str) -> Column:
    """Positional report value -> typed metric, missing -> 0."""
    if kind == "long":
        whole = col_(c).cast("string").try_cast(DecimalType(38, 6)).try_cast("long")
        return F.coalesce(whole, F.lit(0).cast("long"))
    return to_money(c)


def money_text(c: str | Column) -> Column:
    """Two-decimal text of a decimal sum (half-even, as a float formatter
    rounds most ties), '0.00' when absent (P23)."""
    return F.coalesce(F.bround(col_(c), 2).cast("decimal(38,2)").cast("string"), F.lit("0.00"))


# Fixed values of the reservation agent rule.
SLEEPOVER_MARK = "sleepover"
SLEEPOVER_WEB_AGENT_ID = 176
SLEEPOVER_WEB = "Sleepover.com"
SLEEPOVER_OTHER = "Sleepover e-mail/phone"
# Decimal or scientific number text (inf/nan are not numbers here: they fail
# the integer conversion in the source rule and so do not count as the id).
_NUM_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def booking_agent(source_name: Column, creator_id: Column, *fallbacks: Column) -> Column:
    """A booking source mentioning the partner decides by the creator id
    (numeric and truncating to the web agent id -> web, else phone/e-mail);
    otherwise the source name, then the travel-agent names."""
    text = F.trim(F.coalesce(creator_id.cast("string"), F.lit("")))
    as_num = F.when(text.rlike(_NUM_TEXT), text.try_cast("double"))
    finite = as_num.isNotNull() & (F.abs(as_num) < F.lit(9.2e18))
    is_web = finite & (as_num.cast("long") == F.lit(SLEEPOVER_WEB_AGENT_ID))
    partner = F.contains(F.lower(F.coalesce(source_name, F.lit(""))), F.lit(SLEEPOVER_MARK))
    return (F.when(partner & is_web, F.lit(SLEEPOVER_WEB))
            .when(partner, F.lit(SLEEPOVER_OTHER))
            .otherwise(first_non_empty(source_name, *fallbacks, default="")))
