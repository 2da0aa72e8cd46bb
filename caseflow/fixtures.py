"""The generic test tables viewed as raw service-request tickets.

Every column is text, as in a landed CSV, and carries the dirt a real snapshot has: padded
and blank categories, unparseable and missing dates, non-numeric coordinates and repeated
keys. ``arrival`` orders repeated deliveries of one key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.schema import RAW_COLUMNS

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

    # Orders get their customers first: lines, which are many more, move once for all of these tables.
    orders = (
        table("orders")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    joined = (
        table("lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    created = F.timestamp_add("HOUR", (part % 24).cast("int"), F.col("o_orderdate"))
    closed = F.timestamp_add("HOUR", (supp % 24).cast("int"), F.col("l_shipdate"))
    columns = {
        "unique_key": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "created_date": F.when(supp % 29 == 0, "not a date").otherwise(F.date_format(created, ISO)),
        "closed_date": F.when(part % 23 == 0, None)
        .when(part % 31 == 0, "")
        .otherwise(F.date_format(closed, ISO)),
        "agency": F.when(supp % 17 == 0, "   ")
        .when(supp % 19 == 0, " nan ")
        .otherwise(F.concat(F.lit(" "), "c_mktsegment", F.lit(" "))),
        "complaint_type": F.col("p_type"),
        "descriptor": F.col("p_brand"),
        "borough": F.when(F.col("l_linenumber") != 7, F.col("r_name")),
        "location_type": F.col("o_orderpriority"),
        "incident_zip": F.col("n_nationkey"),
        "community_board": F.concat("l_returnflag", "l_linestatus"),
        "council_district": supp,
        "police_precinct": F.col("p_size"),
        "latitude": F.when(part % 13 == 0, "x").otherwise(F.col("c_acctbal").cast("string")),
        "longitude": F.col("s_acctbal"),
        "arrival": F.concat_ws(
            "|",
            F.lpad(part.cast("string"), 12, "0"),
            F.lpad(supp.cast("string"), 12, "0"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
        ),
    }
    return joined.select(*[columns[c].cast("string").alias(c) for c in [*RAW_COLUMNS, "arrival"]])
