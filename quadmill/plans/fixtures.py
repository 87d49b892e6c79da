"""Geodata out of the driver's tables. The texts are SQL that Spark and DuckDB share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "geo_points": ("lineitem", """select l_orderkey, l_linenumber,
        cast((l_orderkey*7919 % 36000) as double)/100.0-180.0 as lng,
        cast((l_partkey*104729 % 17000) as double)/100.0-85.0 as lat,
        cast(cast(l_extendedprice as decimal(18,2))*100 as bigint) as elev_c from lineitem"""),
    "cells": ("lineitem", """select (l_orderkey*7919)%128 as px, (l_partkey*104729 + l_linenumber*31)%128 as py,
        max(cast(cast(l_extendedprice as decimal(18,2))*100 as bigint)) as v from lineitem
        group by (l_orderkey*7919)%128, (l_partkey*104729 + l_linenumber*31)%128"""),
    "rgba_cells": ("lineitem", """select case when l_linestatus='O' then 'A' else 'B' end as ds, (l_orderkey*7919)%64 as px, (l_partkey*104729)%64 as py,
        max(l_partkey%256) as r, max(l_suppkey%256) as g, max(l_orderkey%256) as b,
        max(case when l_orderkey%5=0 then 0 else 255 end) as a from lineitem
        group by case when l_linestatus='O' then 'A' else 'B' end, (l_orderkey*7919)%64, (l_partkey*104729)%64"""),
    "cloud": ("lineitem", """select l_orderkey, l_linenumber, (l_orderkey*7919)%16 as i, (l_partkey*104729)%16 as j, (l_suppkey*31+l_linenumber)%16 as k,
        l_partkey%256 as r, l_suppkey%256 as g, l_orderkey%256 as b, cast(l_quantity as bigint) as intensity from lineitem"""),
    "ledger": ("orders", """select o_orderpriority as layer, o_orderkey%200 as file_id,
        max(case when o_orderstatus='F' then 1 else 0 end) as finished, count(*) as attempts from orders group by o_orderpriority, o_orderkey%200"""),
    "tiles": ("customer", """select distinct 3 + c_nationkey%5 as lod, (c_custkey*7919)%8 as tx, (c_custkey + c_nationkey*3)%8 as ty from customer"""),
    "arrivals": ("events", """select event_id, ts, user_id%64 as px, event_id%64 as py, cast(round(value*100) as bigint) as v from events"""),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, text = VIEWS[name]
    return spark.sql(text.replace(f"from {source}", "from {source}"), source=table(spark, sf_dir, source))


def with_views(text: str) -> str:
    """``text`` with the views it names as common table expressions."""
    used = [n for n in VIEWS if n in text]
    return "with " + ", ".join(f"{n} as ({VIEWS[n][1]})" for n in used) + (", " + text if text.lstrip().startswith("q_") else " " + text) if used else text
