"""Landings that are not whole: page chains and cut reports."""

import json
import os

import pytest

from channelmart.sources import chains
from channelmart.sources.ads_search import read_ads_search
from channelmart.sources.pages import read_pages
from channelmart.sources.reports import read_report
from channelmart.sources.reservations import read_reservations


def put(root, rel, obj):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj))


def search(root, prop, pages, last=None):
    """Pages of a property; every page but `last` names a next one."""
    for k in pages:
        put(root, f"property_name={prop}/page-{k}.json", {"results": [{"campaign": {"name": f"C{k}"}}], **({} if k == last else {"nextPageToken": f"t{k}"})})


def reservations(root, prop, sizes):
    for k, n in sizes.items():
        put(root, f"property_id={prop}/page-{k}.json", {"items": [{"id": 100 * k + i} for i in range(n)]})


def faults(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_whole_landing_is_read(spark, scratch):
    search(scratch, "a", range(1, 13), last=12)
    search(scratch, "b", [1], last=1)
    assert read_ads_search(spark, scratch, "campaign", first=1).count() == 13
    put(scratch + "/r", "property_id=1/page-0.json", [])
    assert read_reservations(spark, scratch + "/r", first=0).count() == 0


@pytest.mark.parametrize("pages,last,first,said", [
    ([1, 2, 4], 4, None, "property_name b, page 3: missing"),                 # a gap
    ([1, 2, 3], None, None, "property_name b, page 4: missing"),              # the end
    ([2, 3], 3, 1, "property_name b, page 1: missing"),                       # the first page
    ([1, 2, 3], 2, 1, "property_name b, page 3: after the end")])             # a page of another landing
def test_a_landing_with_a_lost_page_fails(spark, scratch, pages, last, first, said):
    search(scratch, "a", [1, 2], last=2)
    search(scratch, "b", pages, last)
    with pytest.raises(ValueError, match=said) as error:
        read_ads_search(spark, scratch, "campaign", first=first)
    assert "property_name a" not in str(error.value) and scratch in str(error.value)
    assert read_ads_search(spark, scratch, "campaign", check=False).count() == 2 + len(pages)


def test_a_page_that_landed_twice_fails(spark, scratch):
    search(scratch, "a", [1, 2], last=2)
    put(scratch, "property_name=a/again-2.json", {"results": []})
    with pytest.raises(ValueError, match="property_name a, page 2: doubled"):
        read_ads_search(spark, scratch, "campaign")


def test_full_reservation_pages_lead_on(spark, scratch):
    reservations(scratch, 1, {0: 3, 1: 3, 2: 1})
    reservations(scratch, 2, {0: 3, 1: 3})                                    # full to the last page: the end is missing
    with pytest.raises(ValueError, match="property_id 2, page 2: missing"):
        read_reservations(spark, scratch, limit=3)
    put(scratch, "property_id=2/page-2.json", [])
    assert read_reservations(spark, scratch, limit=3, first=0).count() == 13
    put(scratch, "property_id=1/page-3.json", {"items": [{"id": 1}]})
    with pytest.raises(ValueError, match="property_id 1, page 3: after the end"):
        read_reservations(spark, scratch, limit=3, first=0)
    assert read_reservations(spark, scratch, limit=3).count() == 14            # without a first page's number chains are not ended


def test_elements_of_any_kind_count_for_a_full_page(spark, scratch):
    put(scratch, "property_id=1/page-0.json", [1, None, {"id": 1}])
    put(scratch, "property_id=1/page-1.json", {"id": 2})
    put(scratch, "property_id=2/page-0.json", "null")
    pages = chains.list_chain(read_pages(spark, scratch), 3)
    assert sorted((r.property_id, r.page, r.more) for r in pages.collect()) == [("1", 0, True), ("1", 1, False), ("2", 0, False)]


def test_several_lost_pages_and_pages_without_folders(spark):
    chain = spark.createDataFrame([(k, True) for k in (2, 3, 7)] + [(8, False)], "page long, more boolean")
    assert faults(chains.chain_faults(chain)) == [(4, "missing"), (6, "missing")]
    assert faults(chains.chain_faults(chain, first=0)) == [(1, "missing"), (4, "missing"), (6, "missing")]
    folders = spark.createDataFrame([(None, 0, True), (None, 1, False), ("x", 0, True)], "property_name string, page long, more boolean")
    assert faults(chains.chain_faults(folders, first=0, strict=True)) == [("x", 1, "missing")]
    assert faults(chains.chain_faults(chain.where("false"), first=0, strict=True)) == []


def rows(n):
    return [{"dimensionValues": [{"value": str(k)}], "metricValues": [{"value": "1"}]} for k in range(n)]


@pytest.mark.parametrize("response,said", [
    ({"rows": rows(2), "rowCount": 3}, "declared 3, landed 2: fewer rows than declared"),
    ({"rows": rows(4), "rowCount": 3}, "declared 3, landed 4: more rows than declared"),
    ({"rowCount": 1}, "declared 1, landed 0: fewer rows than declared")])
def test_a_cut_report_fails(spark, scratch, response, said):
    put(scratch, "property_name=a/r-0.json", {"rows": rows(3), "rowCount": 3})
    put(scratch, "property_name=b/r-0.json", response)
    with pytest.raises(ValueError, match="property_name b, " + said):
        read_report(spark, scratch, ["date"], [("clicks", "long")])
    assert read_report(spark, scratch, ["date"], [("clicks", "long")], check=False).count() >= 3


def test_a_report_as_long_as_a_request_may_be_is_suspect(spark, scratch):
    put(scratch, "property_name=a/r-0.json", {"rows": rows(4)})
    put(scratch, "property_name=b/r-0.json", {"rows": rows(4), "rowCount": 4})
    put(scratch, "property_name=c/r-0.json", {"rows": rows(3)})
    put(scratch, "property_name=d/r-0.json", {"kind": "empty report"})
    put(scratch, "property_name=e/r-0.json", {"rows": rows(4), "rowCount": 6})     # one report in two responses
    put(scratch, "property_name=e/r-1.json", {"rows": rows(2), "rowCount": 6})
    found = faults(chains.report_faults(read_pages(spark, scratch), limit=4))
    assert found == [("a", None, 4, "as many rows as a request gives")]
    with pytest.raises(ValueError, match="property_name a"):
        chains.require_reports(read_pages(spark, scratch), "reports", limit=4)


def test_lost_pages_are_told_without_exchanging_the_texts_by_property(spark, scratch):
    """All of a property's texts met in one task: one row per property goes to the pages instead."""
    from channelmart.sources import standins
    spark.createDataFrame([(k, str(k)) for k in range(0, 40)], "page long, value string").write.parquet(scratch + "/pages")
    pages = spark.read.parquet(scratch + "/pages")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)       # as if every side were large
    try:
        rows = standins._lossy(pages, ("a", "b"))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        found = sorted((r["property_name"], r["page"], r["value"]) for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    kept = [(p, k) for p in "ab" for k in range(20) if k % 7 != 3 and (p, k) != ("b", 19)]
    assert found == sorted((p, k, str(2 * k + (p == "b"))) for p, k in kept for _ in range(2 if k % 11 == 5 else 1))
