"""Landed-JSON readers (S1-S4, S7) on temporary files."""

import json
import os

import pytest

from channelmart.sources.ads_search import read_ads_search
from channelmart.sources.properties import read_properties
from channelmart.sources.reports import read_report
from channelmart.sources.reservations import read_daily_rates, read_reservations


def put(root, rel, obj):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        json.dump(obj, f)


def vals(*xs):
    return [{"value": x} for x in xs]


def test_read_report_positional_and_empty(spark, scratch):
    put(scratch, "property_name=a/r-0.json", {"rows": [
        {"dimensionValues": vals("20240102", "Camp"), "metricValues": vals("1.25", "3", "10")},
        {"dimensionValues": vals("20240103", "Camp"), "metricValues": vals("2")},
    ]})
    put(scratch, "property_name=b/r-0.json", {"kind": "empty report"})
    df = read_report(spark, scratch, ["date", "campaign"],
                     [("cost", "money"), ("clicks", "long"), ("impressions", "long")])
    rows = sorted((r.property_name, r.date, float(r.cost), r.clicks, r.impressions, r.pos.idx) for r in df.collect())
    assert rows == [("a", "20240102", 1.25, 3, 10, 0), ("a", "20240103", 2.0, 0, 0, 1)]


def test_read_ads_search_pages_and_defaults(spark, scratch):
    put(scratch, "property_name=a/page-0.json", {"results": [
        {"segments": {"date": "2024-01-02"}, "campaign": {"name": "C"}, "adGroup": {"name": "G"},
         "metrics": {"costMicros": "1500000", "clicks": "4", "impressions": "9",
                     "conversions": "1.5", "conversionsValue": "20.25"}}], "nextPageToken": "t"})
    put(scratch, "property_name=a/page-1.json", {"results": [{"segments": {"date": "2024-01-02"}}]})
    df = read_ads_search(spark, scratch, "ad_group")
    rows = sorted((r.campaign, r.ad_group, float(r.cost), r.clicks, r.impressions, float(r.conversions),
                   float(r.revenue), r.pos.page) for r in df.collect())
    assert rows == [("C", "G", 1.5, 4, 9, 1.5, 20.25, 0),
                    ("N/A", "N/A", 0.0, 0, 0, 0.0, 0.0, 1)]


def test_read_reservations_envelopes(spark, scratch):
    put(scratch, "property_id=1/p0.json", [{"id": 1, "status": "A"}, {"id": "2", "status": "B"}])
    put(scratch, "property_id=1/p1.json", {"items": [{"id": 3}], "total": 1})
    put(scratch, "property_id=1/p2.json", {"results": [{"reservationId": 4}]})
    put(scratch, "property_id=1/p3.json", {"data": [{"id": 5, "primaryGuest": {"lastName": "L"}}]})
    put(scratch, "property_id=2/p4.json", {"id": 6, "bookingSource": {"name": "Web"}})
    df = read_reservations(spark, scratch)
    got = sorted((r.property_id, r.id or r.reservationId) for r in df.collect())
    assert got == [("1", "1"), ("1", "2"), ("1", "3"), ("1", "4"), ("1", "5"), ("2", "6")]
    row = df.where("id = '5'").collect()[0]
    assert json.loads(row.primaryGuest) == {"lastName": "L"}
    p0 = sorted((r.pos, r.id) for r in df.collect() if r.property_id == "1" and r.pos.page == 0)
    assert [i for _, i in p0] == ["1", "2"]          # bare list: element order is kept in pos


def test_last_export_row_of_a_bare_list_page_wins(spark, scratch):
    """A1 before J11: the stay window of a repeated id comes from its last row."""
    from channelmart.plans.reservations import stay_rates
    rows = [{"id": 7, "arrivalDate": "2024-01-01", "departureDate": "2024-01-01"},
            {"id": 7, "arrivalDate": "2024-02-01", "departureDate": "2024-02-02"}]
    put(scratch, "property_id=1/p0.json", rows)
    res = read_reservations(spark, scratch).selectExpr(
        "cast(id as long) as res_no", "arrivalDate as arrive", "departureDate as depart", "pos")
    put(scratch, "rates/r0.json", [{"reservationId": 7, "totalRateAmount": "10.00", "stayDate": "2024-01-01"},
                                   {"reservationId": 7, "totalRateAmount": "5.50", "stayDate": "2024-02-02"}])
    rates = read_daily_rates(spark, os.path.join(scratch, "rates"))
    got = [(r.res_no, float(r.rate_sum)) for r in stay_rates(res, rates).collect()]
    assert got == [(7, 5.5)]


def test_read_rates_and_properties(spark, scratch):
    put(scratch, "rates/x-1.json", [{"reservationId": 1, "totalRateAmount": 10.105, "stayDate": "2024-01-01"},
                                  {"reservationId": 1, "stayDate": "2024-01-02"}])
    df = read_daily_rates(spark, os.path.join(scratch, "rates"))
    got = sorted(((r.reservationId, -1.0 if r.totalRateAmount is None else float(r.totalRateAmount))
                  for r in df.collect()))
    assert got == [("1", -1.0), ("1", 10.105)]
    put(scratch, "props/p.json", [{"propertyId": "7", "clientName": "X"},
                                  {"propertyId": 8, "clientName": "Y", "location": "Z"}])
    props = sorted(tuple(r) for r in read_properties(spark, os.path.join(scratch, "props")).collect())
    assert props == [(7, "X", ""), (8, "Y", "Z")]


def test_a_truncated_page_fails_the_job(spark, scratch):
    for root, read in (("a", lambda p: read_report(spark, p, ["date"], [("cost", "money")])),
                       ("b", lambda p: read_ads_search(spark, p, "campaign")), ("c", lambda p: read_reservations(spark, p)),
                       ("d", lambda p: read_daily_rates(spark, p))):
        path = os.path.join(scratch, root)
        put(path, "property_name=x/page-1.json", {"rows": [], "results": []})
        with open(os.path.join(path, "property_name=x/page-2.json"), "w") as f:
            f.write('{"rows": [{"dimensionValues": [{"value": "2024')
        with pytest.raises(Exception, match="(?i)malformed"):
            read(path).collect()


def test_objects_beside_other_values_are_kept(spark, scratch):
    """Rows that are no objects are dropped; a list element keeps its own lists."""
    pages = [[{"id": 1}, 3], [{"id": 2}, None], [{"id": 3}, "x"], {"items": [{"id": 4}, 3]}, [{"id": 5, "data": [{"id": 99}]}],
             {"items": {"id": 98}, "results": [{"id": 6}]}, {"id": 7, "items": 3}, 8, [], [[{"id": 97}]], '{"id": 96}']
    for k, page in enumerate(pages):
        put(scratch, f"property_id=1/page-{k}.json", page)
    assert sorted(r.id for r in read_reservations(spark, scratch).collect()) == ["1", "2", "3", "4", "5", "6", "7"]


def test_the_last_row_of_the_last_page_wins(spark, scratch):
    from channelmart.operators.overlay import last_row_wins
    for k in range(12):
        put(scratch, f"property_name=a/page-{k}.json", {"results": [{"segments": {"date": "2024-01-02"}, "campaign": {"name": "C"},
                                                                     "metrics": {"costMicros": str(k * 1_000_000)}}]})
    rows = read_ads_search(spark, scratch, "campaign")
    assert [float(r.cost) for r in last_row_wins(rows, ["property_name", "data_date", "campaign"], ["cost"]).collect()] == [11.0]


def test_a_page_without_a_number_is_refused(spark, scratch):
    put(scratch, "property_name=a/page.json", {"results": [{"campaign": {"name": "C"}}]})
    with pytest.raises(Exception, match="without a number"):
        read_ads_search(spark, scratch, "campaign").collect()


def test_metrics_keep_their_digits(spark, scratch):
    put(scratch, "property_name=a/page-0.json", {"results": [{"metrics": {
        "costMicros": "9007199254740993", "clicks": "9007199254740993", "impressions": 3.0, "conversions": 0.123456789}}]})
    row = read_ads_search(spark, scratch, "campaign").collect()[0]
    assert (str(row.cost.normalize()), row.clicks, row.impressions) == ("9007199254.740993", 9007199254740993, 3)
    assert str(row.conversions.normalize()) == "0.123456789"


def test_rates_are_read_from_the_parsed_page(spark):
    """Without each object's text written and parsed again; what is no object is left out, its place counts."""
    from decimal import Decimal
    from channelmart.sources.reservations import parse_daily_rates
    texts = ['[{"reservationId": 1, "totalRateAmount": 1.25, "stayDate": "2024-01-01"}, 3, null, "x", [{"reservationId": 9}], {"totalRateAmount": "n/a"}]',
             ' {"items": {"reservationId": 8}, "data": [{"reservationId": "2", "totalRateAmount": "0.005"}]}', '{"reservationId": 3}', "7"]
    pages = spark.createDataFrame([(k, v, "p") for k, v in enumerate(texts)], "page long, value string, property_id string")
    rows = parse_daily_rates(pages)
    assert "from_json" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.columns == ["property_id", "reservationId", "totalRateAmount", "stayDate", "pos"]
    found = sorted((r["pos"]["page"], r["pos"]["idx"], r["reservationId"], r["totalRateAmount"], r["stayDate"]) for r in rows.collect())
    assert found == [(0, 0, "1", Decimal("1.25"), "2024-01-01"), (0, 5, None, None, None), (1, 0, "2", Decimal("0.005"), None), (2, 0, "3", None, None)]
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        parse_daily_rates(spark.createDataFrame([(0, "")], "page long, value string")).collect()
