"""Oracle SQL text, one entry per registered query."""

from __future__ import annotations

from channelmart.oracle import ads_sql, misc_sql


def oracle_queries() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(misc_sql.queries())
    out.update(ads_sql.queries())
    return out
