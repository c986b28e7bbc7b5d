"""Whether a landing is whole (U2, S1): page chains and cut reports.

The services hand out a response page by page, and a landing that lost one still parses. What a page says about the next
one tells: an ads search page names a ``nextPageToken`` unless it is the last; a reservation page holds as many elements as
were asked for unless it is the last; a report declares the number of its rows, and one that does not is suspect when it
holds exactly as many as a request may ask for.

A chain is what one partition folder holds (a property, and whatever else is in the path). Faults are found by joins of
each page with its neighbours on (folder, page), so they are as even as the pages and nothing is held by folder. The
``require_*`` functions fail the job and name folder and page; they read the pages once more, for these few fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from channelmart.sources.pages import other_columns

RESERVATION_LIMIT = 500      # elements that the reservation search asks for at a time
REPORT_LIMIT = 100_000       # rows that an analytics report asks for
SHOWN = 20                   # faults that an error names
MISSING, DOUBLED, AFTER_END = "missing", "doubled", "after the end"


def search_chain(pages: DataFrame) -> DataFrame:
    """Folder columns, ``page`` and ``more`` of ads search pages: a token that is not empty leads on."""
    token = F.from_json("value", "nextPageToken string", {"mode": "FAILFAST"})["nextPageToken"]
    return pages.select(*other_columns(pages), "page", (F.coalesce(token, F.lit("")) != "").alias("more"))


def list_chain(pages: DataFrame, limit: int = RESERVATION_LIMIT) -> DataFrame:
    """Folder columns, ``page`` and ``more`` of pages in a list or an envelope: a page of ``limit`` elements leads on,
    whatever the elements are."""
    from channelmart.sources.reservations import elements
    return pages.select(*other_columns(pages), "page", F.coalesce(F.size(elements("value")) >= limit, F.lit(False)).alias("more"))


def _folders(chain: DataFrame) -> list[str]:
    return [c for c in chain.columns if c not in ("page", "more")]


def chain_faults(chain: DataFrame, first: int | None = None, strict: bool = False, expected: DataFrame | None = None) -> DataFrame:
    """Folder columns (as text), ``page`` and ``fault`` of each page that is missing, or there more than once. Of several
    missing pages in a row, the first and the last are named.

    ``first``: the number of a chain's first page; without it the lowest landed page counts as the first. ``strict``:
    a page behind one that says it is the last is a fault, too. ``expected``: the
    folders that must have landed (some or all folder columns, other columns
    are not read); of one without any page the first page is missing."""
    folders = _folders(chain)
    keys = folders or ["folder"]
    # A null folder is a chain of its own; keys are compared, so it gets a text.
    texts = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in folders] or [F.lit("").alias("folder")]
    named = chain.select(*texts, "page", "more")
    landed = named.groupBy(*keys, "page").agg(F.count(F.lit(1)).alias("copies"), F.bool_or("more").alias("more"))
    on = [*keys, "page"]

    def fault(rows: DataFrame, page: Column, name: str) -> DataFrame:
        return rows.select(*keys, page.alias("page"), F.lit(name).alias("fault"))

    page = F.col("page")
    before = landed.select(*keys, (page + 1).alias("page"))           # pages whose predecessor landed
    cut_off = landed.join(before, on, "left_anti")                     # few: the first page of each stretch
    if first is None:
        start = landed.groupBy(*keys).agg(F.min("page").alias("start"))
        cut_off = cut_off.join(start, keys).where(page > F.col("start"))
    else:
        cut_off = cut_off.where(page > first)
    promised = landed.where("more").select(*keys, (page + 1).alias("page"))
    faults = (fault(landed.where("copies > 1"), page, DOUBLED)
              .unionByName(fault(cut_off, page - 1, MISSING))
              .unionByName(fault(promised.join(landed, on, "left_anti"), page, MISSING)))
    if strict:
        behind = landed.where("not more").select(*keys, (page + 1).alias("page"))
        faults = faults.unionByName(fault(behind.join(landed, on, "left_semi"), page, AFTER_END))
    if expected is not None:
        named_keys = [k for k in folders if k in expected.columns]
        wanted = expected.select(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in named_keys]).distinct()
        absent = wanted.join(landed, named_keys, "left_anti")
        others = [F.lit("").alias(k) for k in folders if k not in named_keys]
        faults = faults.unionByName(absent.select(*named_keys, *others, F.lit(first or 0).cast("long").alias("page"), F.lit(MISSING).alias("fault")))
    return faults.distinct().select(*folders, "page", "fault")


def report_faults(pages: DataFrame, limit: int = REPORT_LIMIT) -> DataFrame:
    """Folder columns, ``declared``, ``landed`` and ``fault`` of reports with fewer or more rows than declared, and of those that
    declare no number and hold exactly a multiple of ``limit`` rows. Each response of a folder declares the rows of its whole
    report; a folder may hold the parts of one report, or several reports."""
    keys = other_columns(pages)
    parsed = F.from_json("value", "rows array<string>, rowCount string", {"mode": "FAILFAST"})
    rows = pages.select(*keys, parsed.alias("p")).select(*keys, F.col("p.rowCount").try_cast("long").alias("rowCount"),
                                                         F.when(F.col("p.rows").isNull(), 0).otherwise(F.size("p.rows")).cast("long").alias("n"))
    reports = rows.groupBy(*keys).agg(F.max("rowCount").alias("declared"), F.sum("rowCount").alias("all"), F.sum("n").alias("landed"))
    cut = F.col("declared").isNull() & (F.col("landed") > 0) & (F.col("landed") % limit == 0)
    fault = F.when(F.col("landed") < F.col("declared"), "fewer rows than declared").when(
        F.col("landed") > F.col("all"), "more rows than declared").when(cut, "as many rows as a request gives")
    return reports.withColumn("fault", fault).where("fault is not null").drop("all")


def _require(faults: DataFrame, what: str) -> None:
    found = faults.limit(SHOWN).collect()
    if found:
        def text(row) -> str:
            return ", ".join(f"{k} {row[k]}" for k in faults.columns[:-1]) + f": {row['fault']}"
        raise ValueError(f"{what}: not whole: " + "; ".join(sorted(map(text, found))) + (" and more" if len(found) == SHOWN else ""))


def require_chains(chain: DataFrame, what: str, first: int | None = None, strict: bool = True, expected: DataFrame | None = None) -> None:
    """Fails unless every chain is whole, and there for every expected folder."""
    _require(chain_faults(chain, first, strict, expected), what)


def require_reports(pages: DataFrame, what: str, limit: int = REPORT_LIMIT, expected: DataFrame | None = None) -> None:
    """Fails unless every report is whole, and there for every expected folder."""
    _require(report_faults(pages, limit), what)
    if expected is not None:
        keys = [k for k in other_columns(pages) if k in expected.columns]
        absent = expected.select(*keys).distinct().join(pages.select(*keys).distinct(), keys, "left_anti")
        _require(absent.withColumn("fault", F.lit("no response")), what)
