"""Flight table derived from the shipped star-schema tables.

The test data holds no flights, so one flight is made per line item by integer
arithmetic on its keys (rules in FIXTURES.md), with origin = customer nation and
destination = supplier nation. Every ``l_orderkey % 50 = 0`` flight appears twice
(exact duplicate rows) to exercise the de-duplication step.

Plan shape: orders joins customer (customer key), then lineitem joins that on
the order key, then supplier on the supplier key. Customer and supplier are
broadcast after a row-count check, else shuffled; AQE splits a hot key's
partition in a shuffled join. Nation and region are bounded dimensions joined
by broadcast. The duplicate copy is made by a generator after the joins, so
nothing is scanned or joined twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schema import FLIGHT_COLUMNS

STAR_TABLES = ("lineitem", "orders", "customer", "supplier", "nation", "region")


def read_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in STAR_TABLES}


def _hhmm(minutes: Column) -> Column:
    """Minutes after midnight (any day) -> clock time as hhmm."""
    m = minutes % 1440
    return F.floor(m / 60) * 100 + m % 60


def flights_from_star(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                      supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    places = (
        nation.join(region.select("r_regionkey", "r_name"),
                    nation.n_regionkey == region.r_regionkey)
        .select("n_nationkey", "n_name", "r_name"))
    o_place = places.select(F.col("n_nationkey").alias("cn"), F.col("n_name").alias("o_nation"),
                            F.col("r_name").alias("o_region"))
    d_place = places.select(F.col("n_nationkey").alias("sn"), F.col("n_name").alias("d_nation"),
                            F.col("r_name").alias("d_region"))

    # orders x customer first: lineitem, the largest table, is then shuffled once,
    # on the order key. Whether customer and supplier are broadcast is the planner's
    # choice, by its byte threshold and the sizes AQE sees.
    cu = customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("cn"))
    oc = (orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
          .join(cu, "o_custkey")
          .select("l_orderkey", "cn"))
    su = supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("sn"))
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")

    # lineitem x orders is the big-big join: both sides hash-partitioned on the
    # order key, orders (unique keys, so no hot build partition) hashed per
    # partition. The hint keeps the planner from broadcasting either side on a
    # small-file size estimate; AQE still splits a hot lineitem key.
    base = (li.join(oc.hint("shuffle_hash"), "l_orderkey")
            .join(su, "l_suppkey")
            .join(o_place, "cn").join(d_place, "sn"))

    h = (F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17
         + F.col("l_partkey") * 7 + F.col("l_suppkey") * 3)
    step1 = base.withColumns({
        "h": h,
        "d": F.to_date("l_shipdate"),
    })
    hc = F.col("h")
    step2 = step1.withColumns({
        "hr": hc % 25,
        "mi": F.when(hc % 25 == 24, F.lit(0)).otherwise(hc % 60),
        "dd": (F.when(hc % 499 == 0, F.lit(2000))
               .when(hc % 503 == 0, F.lit(-200))
               .when(hc % 19 == 0, 60 + hc % 240)
               .otherwise(hc % 71 - 25)),
        "adj": F.col("l_partkey") % 41 - 22,
        "tox": 5 + F.col("l_partkey") % 30,
        "tix": 2 + F.col("l_suppkey") % 15,
        "dist": 100 + 120 * F.abs(F.col("cn") - F.col("sn")),
        "canc": F.when(hc % 53 == 0, 1).otherwise(0),
    })
    step3 = step2.withColumns({
        "depm": F.col("hr") * 60 + F.col("mi"),
        "ad": F.col("dd") + F.col("adj"),
        "air": 30 + F.floor(F.col("dist") / 8),
        "dv": F.when((hc % 197 == 0) & (F.col("canc") == 0), 1).otherwise(0),
    })
    step4 = step3.withColumns({
        "el": F.col("tox") + F.col("air") + F.col("tix"),
        "late": F.when((F.col("ad") >= 15) & (F.col("canc") == 0) & (F.col("dv") == 0),
                       F.col("ad")),
    })

    flew = F.col("canc") == 0
    landed = flew & (F.col("dv") == 0)
    late = F.col("late")
    half = F.floor(late / 2)
    cause_part = hc % 5

    def share(sel: Column) -> Column:
        return F.when(late.isNotNull(), F.when(sel, half).otherwise(0)).cast("int")

    def dbl(c: Column) -> Column:
        return c.cast("double")

    d = F.col("d")
    depm, dd, tox, air, el, ad = (F.col(c) for c in ("depm", "dd", "tox", "air", "el", "ad"))
    out = step4.select(
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "yyyy-MM-dd").alias("fl_date"),
        F.concat(F.lit("C"), (F.col("l_suppkey") % 12).cast("string")).alias("op_unique_carrier"),
        dbl(F.col("l_partkey")).alias("op_carrier_fl_num"),
        F.concat(F.lit("N"), F.col("cn").cast("string")).alias("origin"),
        F.concat(F.col("o_region"), F.lit(" City")).alias("origin_city_name"),
        F.col("o_nation").alias("origin_state_nm"),
        F.concat(F.lit("N"), F.col("sn").cast("string")).alias("dest"),
        F.concat(F.col("d_region"), F.lit(" City")).alias("dest_city_name"),
        F.col("d_nation").alias("dest_state_nm"),
        (F.col("hr") * 100 + F.col("mi")).cast("int").alias("crs_dep_time"),
        F.when(flew, dbl(_hhmm(depm + dd + 2880))).alias("dep_time"),
        F.when(flew, dbl(dd)).alias("dep_delay"),
        F.when(flew, dbl(tox)).alias("taxi_out"),
        F.when(flew, dbl(_hhmm(depm + dd + tox + 2880))).alias("wheels_off"),
        F.when(flew, dbl(_hhmm(depm + dd + tox + air + 2880))).alias("wheels_on"),
        F.when(flew, dbl(F.col("tix"))).alias("taxi_in"),
        _hhmm(depm + el).cast("int").alias("crs_arr_time"),
        F.when(landed, dbl(_hhmm(depm + el + ad + 2880))).alias("arr_time"),
        F.when(landed & (hc % 61 != 0), dbl(ad)).alias("arr_delay"),
        F.col("canc").cast("int").alias("cancelled"),
        F.when(F.col("canc") == 1, F.substring(F.lit("ABCD"), (hc % 4 + 1).cast("int"), 1))
        .alias("cancellation_code"),
        F.col("dv").cast("int").alias("diverted"),
        dbl(el).alias("crs_elapsed_time"),
        F.when(landed, dbl(el + F.col("adj"))).alias("actual_elapsed_time"),
        F.when(landed, dbl(air)).alias("air_time"),
        dbl(F.col("dist")).alias("distance"),
        (late - half).cast("int").alias("carrier_delay"),
        share(cause_part == 0).alias("weather_delay"),
        share(cause_part.isin(1, 2)).alias("nas_delay"),
        share(cause_part == 3).alias("security_delay"),
        share(cause_part == 4).alias("late_aircraft_delay"),
        # one copy, or two for the duplicated orders
        F.explode(F.when(F.col("l_orderkey") % 50 == 0, F.array(F.lit(1), F.lit(2)))
                  .otherwise(F.array(F.lit(1)))).alias("_copy"),
    )
    return out.select(*FLIGHT_COLUMNS)


def flights_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw flight table (duplicates included) for a test-data folder."""
    return flights_from_star(**read_star(spark, sf_dir))
