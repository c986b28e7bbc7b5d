"""The jobs end to end from landed JSON files (the production inputs), with
report positions as the readers produce them."""

import json
import os

import pytest

from channelmart.plans.ads_daily import ads_daily
from channelmart.plans.item_revenue import item_revenue
from channelmart.plans.reservations import COLUMNS, export_reservations
from channelmart.sources.ads_search import read_ads_search
from channelmart.sources.properties import properties_dim, read_properties
from channelmart.sources.reports import read_ads_reports, read_named_report
from channelmart.sources.reservations import read_daily_rates, read_reservations


def put(root, rel, obj):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        json.dump(obj, f)


def report(*rows):
    return {"rows": [{"dimensionValues": [{"value": v} for v in dims],
                      "metricValues": [{"value": v} for v in mets]} for dims, mets in rows]}


def search_row(date, campaign, ad_group, micros, clicks, impressions, conversions, value):
    r = {"segments": {"date": date}, "campaign": {"name": campaign},
         "metrics": {"costMicros": str(micros), "clicks": str(clicks), "impressions": str(impressions),
                     "conversions": str(conversions), "conversionsValue": str(value)}}
    if ad_group:
        r["adGroup"] = {"name": ad_group}
    return r


def test_export_reservations_from_landed_pages(spark, scratch):
    res = os.path.join(scratch, "res")
    put(res, "property_id=1/page-0.json", [
        {"id": 11, "dateCreated": "2024-03-05 10:00:00", "arrivalDate": "2024-03-10", "departureDate": "2024-03-11",
         "primaryGuest": {"lastName": "Lee", "firstName": "Ann"}},
        {"id": 12, "dateCreated": "2024-03-07 10:00:00"},                      # another day: dropped
    ])
    put(res, "property_id=2/page-0.json", {"items": [
        {"reservationId": 21, "createdDate": "2024-03-05T09:00:00", "arriveDate": "2024-03-01",
         "departDate": "2024-03-02", "guest": {"surname": "Roe", "given": "Bo"}, "currencyCode": "EUR"}]})
    rates = os.path.join(scratch, "rates")
    put(rates, "page-0.json", {"data": [
        {"reservationId": "11", "totalRateAmount": "100.10", "stayDate": "2024-03-10"},
        {"reservationId": "11", "totalRateAmount": "50.05", "stayDate": "2024-03-12"},     # depart + 1
        {"reservationId": "11", "totalRateAmount": "9.99", "stayDate": "2024-03-13"},      # outside
        {"reservationId": "21", "totalRateAmount": "7.00", "stayDate": "2024-03-01"}]})
    put(scratch, "props/props.json", [{"propertyId": 1, "clientName": "A", "location": "L"},
                                      {"propertyId": 2, "clientName": "B"}])
    out = export_reservations(read_reservations(spark, res), read_daily_rates(spark, rates),
                              read_properties(spark, os.path.join(scratch, "props")), "2024-03-05")
    assert out.columns == COLUMNS
    got = {r.res_no: r for r in out.collect()}
    assert sorted(got) == [11, 21]
    assert (got[11].rate, got[11].surname, got[11].given, got[11].property_name, got[11].location,
            got[11].currency) == ("150.15", "Lee", "Ann", "A", "L", "USD")
    assert (got[21].rate, got[21].surname, got[21].property_name, got[21].location,
            got[21].currency) == ("7.00", "Roe", "B", "", "EUR")


def test_ads_daily_and_item_revenue_from_landed_reports(spark, scratch):
    """One campaign, two target ad groups on Paid Search / cpc; the ad-group
    report shows only g1, so the campaign-day gap (revenue 30, conversions 3,
    sessions 30) goes to g2, whose whole period target is unexplained."""
    root = os.path.join(scratch, "reports")
    p = "property_name=p/r-0.json"
    put(root, f"range_analytics/{p}", report((["Camp", "g1", "Paid Search", "cpc"], ["10", "1", "10"]),
                                             (["Camp", "g2", "Paid Search", "cpc"], ["30", "3", "30"])))
    put(root, f"range_ads/{p}", report((["Camp", "g1"], ["2", "4", "40"]), (["Camp", "g2"], ["3", "6", "60"])))
    put(root, f"day_campaign_analytics/{p}", report((["20240102", "Camp", "Paid Search", "cpc"], ["40", "4", "40"])))
    put(root, f"day_campaign_ads/{p}", report((["20240102", "Camp"], ["5", "10", "100"])))
    put(root, f"day_adgroup_analytics/{p}",
        report((["20240102", "Camp", "g1", "Paid Search", "cpc"], ["10", "1", "10"])))
    put(root, f"day_adgroup_ads/{p}", report((["20240102", "Camp", "g1"], ["2", "4", "40"]),
                                             (["20240102", "Camp", "g2"], ["3", "6", "60"])))
    nat = os.path.join(scratch, "native")
    put(nat, f"campaign/property_name=p/page-0.json",
        {"results": [search_row("2024-01-02", "Camp", None, 5_000_000, 10, 100, 3, 37)]})
    put(nat, f"ad_group/property_name=p/page-0.json",
        {"results": [search_row("2024-01-02", "Camp", "g1", 2_000_000, 4, 40, 1, 12),
                     search_row("2024-01-02", "Camp", "g2", 3_000_000, 6, 60, 2, 25)]})
    native = {"campaign": read_ads_search(spark, os.path.join(nat, "campaign"), "campaign"),
              "ad_group": read_ads_search(spark, os.path.join(nat, "ad_group"), "ad_group")}
    props = properties_dim(spark, [{"property_name": "p", "fx_divisor": 1.0}])
    out = {r.ad_group: r for r in ads_daily(read_ads_reports(spark, root), native, props).collect()}
    assert sorted(out) == ["g1", "g2"]
    g1, g2 = out["g1"], out["g2"]
    assert (g1.data_date, g1.session_default_channel_group, g1.session_medium) == ("2024-01-02", "Paid Search", "cpc")
    assert (g1.cost, g1.clicks, g1.revenue, g1.revenue_ga4, g1.conversions_ga4, g1.sessions) == (2, 4, 12, 10, 1, 10)
    assert (g2.cost, g2.clicks, g2.revenue, g2.revenue_ga4, g2.conversions_ga4, g2.sessions) == (3, 6, 25, 30, 3, 30)
    assert (g1.roas, g1.ctr, g1.avg_cpc, g1.roas_ga4) == pytest.approx((6.0, 10.0, 0.5, 5.0))
    assert (g2.roas, g2.roas_ga4) == pytest.approx((25 / 3, 10.0))

    put(root, f"item_revenue/{p}", report((["20240102", "Organic Search", "Tea"], ["12.5", "2"]),
                                          (["20240102", "Direct", "Cup"], ["0", "0"])))   # filtered (F1)
    items = item_revenue(read_named_report(spark, root, "item_revenue"), props).collect()
    assert [(r.data_date, r.session_default_channel_group, r.item_name, r.item_revenue, r.items_purchased)
            for r in items] == [("2024-01-02", "Organic Search", "Tea", 12.5, 2)]


def test_jobs_run_from_a_landing_and_refuse_one_that_is_not_whole(spark, scratch):
    from channelmart.plans.landing import ads_daily_landed, item_revenue_landed, reservations_landed
    from channelmart.sinks.writers import read_partitions
    root, out = os.path.join(scratch, "landing"), os.path.join(scratch, "out")
    p = "property_name=p/r-0.json"
    for name, row in {"range_analytics": (["Camp", "g1", "Paid Search", "cpc"], ["10", "1", "10"]), "range_ads": (["Camp", "g1"], ["2", "4", "40"]),
                      "day_campaign_analytics": (["20240102", "Camp", "Paid Search", "cpc"], ["10", "1", "10"]), "day_campaign_ads": (["20240102", "Camp"], ["2", "4", "40"]),
                      "day_adgroup_analytics": (["20240102", "Camp", "g1", "Paid Search", "cpc"], ["10", "1", "10"]), "day_adgroup_ads": (["20240102", "Camp", "g1"], ["2", "4", "40"]),
                      "item_revenue": (["20240102", "Direct", "Tea"], ["12.5", "2"])}.items():
        put(root, f"reports/{name}/{p}", report(row) | {"rowCount": 1})
    for level, group in (("campaign", None), ("ad_group", "g1")):
        put(root, f"search/{level}/property_name=p/page-0.json", {"results": [search_row("2024-01-02", "Camp", group, 2_000_000, 4, 40, 1, 12)], "nextPageToken": "x"})
        put(root, f"search/{level}/property_name=p/page-1.json", {"results": []})
    put(root, "reservations/property_id=7/page-0.json", [{"id": 11, "dateCreated": "2024-01-02 10:00:00"}])
    put(root, "rates/page-0.json", [])
    props = properties_dim(spark, [{"property_name": "p"}])
    put(scratch, "props/props.json", [{"propertyId": 7, "clientName": "A"}])
    stays = read_properties(spark, os.path.join(scratch, "props"))
    day = ("2024-01-01", "2024-01-31")
    assert ads_daily_landed(spark, root, props, f"{out}/ads", "2024-02-01", *day).where("data_date is null").first().row_count == 1
    assert item_revenue_landed(spark, root, props, f"{out}/items", "2024-02-01", *day).count() == 2
    assert [r.row_count for r in reservations_landed(spark, root, stays, f"{out}/stays", "2024-01-03").collect()] == [1]
    assert read_partitions(spark, f"{out}/ads").first().revenue_ga4 == 10

    more = properties_dim(spark, [{"property_name": "p"}, {"property_name": "q"}])
    with pytest.raises(ValueError, match="property_name q: no response"):
        ads_daily_landed(spark, root, more, f"{out}/none", "2024-02-01", *day)
    os.remove(os.path.join(root, "search/ad_group/property_name=p/page-1.json"))
    with pytest.raises(ValueError, match="ad_group.*property_name p, page 1: missing"):
        ads_daily_landed(spark, root, props, f"{out}/none", "2024-02-01", *day)
    put(root, f"reports/item_revenue/{p}", {"rows": [], "rowCount": 1})
    with pytest.raises(ValueError, match="property_name p, declared 1, landed 0: fewer rows than declared"):
        item_revenue_landed(spark, root, props, f"{out}/none", "2024-02-01", *day)
    put(root, "reservations/property_id=7/page-1.json", [])
    with pytest.raises(ValueError, match="property_id 7, page 1: after the end"):
        reservations_landed(spark, root, stays, f"{out}/none", "2024-01-03")
    assert not os.path.exists(f"{out}/none")
