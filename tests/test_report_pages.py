"""Stand-in report responses: their texts, and the one exchange that all shapes share."""

import datetime
import json
import os
from functools import reduce

from pyspark.sql import DataFrame

from channelmart.sources import standins as si
from channelmart.sources.reports import REPORT_SPECS, parse_report

COLUMNS = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
           "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")


def line(order, number, flag="R", status="O", price=10.5, part=4):
    return (order, part, 9, number, 3.0, price, 0.05, flag, status, datetime.datetime(1997, 3, 4))


def put_lines(spark, scratch, lines):
    spark.createDataFrame(lines, COLUMNS).write.parquet(os.path.join(scratch, "lineitem.parquet"))


def test_all_report_shapes_share_one_exchange_of_the_lines(spark, scratch):
    put_lines(spark, scratch, [line(order, n) for order in (1, 150, 999) for n in (1, 2)])
    shapes = [parse_report(si.spec_pages(spark, scratch, *spec), *spec).select("property_name") for spec in REPORT_SPECS.values()]
    rows = reduce(DataFrame.union, shapes)
    assert rows.count() == 6 * len(REPORT_SPECS)
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == len(REPORT_SPECS) - 1


def test_report_pages_hold_the_lines_in_order_as_json(spark, scratch):
    put_lines(spark, scratch, [line(7, 2, flag='a"b\\é\n'), line(7, 1, flag=None, price=None, part=None), line(None, 1),
                               line(3, 5), line(3, 5), line(201, 1)])
    dims, metrics = ["campaign", "channel", "date"], [("cost", "money"), ("clicks", "long")]
    pages = {r.page: r for r in si.spec_pages(spark, scratch, dims, metrics).collect()}

    def row(flag, cost="10.50", campaign="camp-4"):
        return {"dimensionValues": [v if v != {"value": None} else {} for v in ({"value": campaign}, {"value": flag}, {"value": "19970304"})],
                "metricValues": [{"value": cost} if cost else {}, {"value": "3"}]}
    assert sorted(pages, key=str) == [0, 2, None]
    assert json.loads(pages[0].value) == {"rows": [row("R"), row("R"), row(None, None, None), row('a"b\\é\n')]}
    assert pages[0].value.startswith('{"rows":[{"dimensionValues":[{"value":"camp-4"},{"value":"R"},{"value":"19970304"}],"metricValues":[{"value":"10.50"},')
    assert json.loads(pages[2].value) == {"rows": [row("R")]}
    assert (pages[0].property_name, pages[2].property_name, pages[None].property_name) == ("north-lounges", "north-lounges", "south-stays")
