"""Place dimensions: airport coordinates and state-name codes (IO4).

For the test data both are derived from the ``nation`` table (FIXTURES §3):
airport ``N<k>`` sits at (25 + k, -70 - 2k) for nations 0-21 (later keys stay
without coordinates, to exercise the dropped-unmatched rule), and nation names
map to ``S<k>`` except keys with k % 8 = 7. Real deployments pass their own
dimension tables with the same columns, e.g. from ``read_dimension``; ``unique_by`` sees to it
that a repeated key multiplies no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The derivation rule parameters.
COORD_MAX_KEY = 21
STATE_SKIP_MOD, STATE_SKIP_REM = 8, 7


def coords_from_nations(nation: DataFrame) -> DataFrame:
    """(code, name, lat, lon) for nations 0..21."""
    k = F.col("n_nationkey")
    return nation.filter(k <= COORD_MAX_KEY).select(
        F.concat(F.lit("N"), k.cast("string")).alias("code"),
        F.col("n_name").alias("name"),
        (25 + k).cast("double").alias("lat"),
        (-70 - 2 * k).cast("double").alias("lon"))


def state_codes_from_nations(nation: DataFrame) -> DataFrame:
    """(state, code): nation name -> S<k>, leaving out k % 8 = 7."""
    k = F.col("n_nationkey")
    return nation.filter(k % STATE_SKIP_MOD != STATE_SKIP_REM).select(
        F.col("n_name").alias("state"), F.concat(F.lit("S"), k.cast("string")).alias("code"))


def coords_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coords_from_nations(spark.read.parquet(f"{sf_dir}/nation.parquet"))


def state_codes_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_codes_from_nations(spark.read.parquet(f"{sf_dir}/nation.parquet"))


# The columns of a coordinate file and of a state code file.
COORDINATES = "code string, name string, lat double, lon double"
STATES = "state string, code string"


def read_dimension(spark: SparkSession, path: str, schema: str = COORDINATES, fmt: str = "csv",
                   header: bool = True) -> DataFrame:
    """IO4: a dimension file in a fixed schema (CSV, or Parquet cast to it).

    A CSV file's header must name the schema's columns, and a cell that its type cannot hold is
    an error, so no latitude comes out as text or NULL unnoticed.
    """
    if fmt == "parquet":
        fields = spark.createDataFrame([], schema).schema.fields
        return spark.read.parquet(path).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    return (spark.read.schema(schema).option("header", header).option("enforceSchema", False)
            .option("mode", "FAILFAST").csv(path))


def unique_by(dimension: DataFrame, key: str, on_repeat: str = "raise") -> DataFrame:
    """The dimension with one row a key, so that a join on it multiplies no rows.

    Rows that repeat a key with other values raise an error when the query runs
    (``on_repeat="raise"``), or the least of them by its columns in order stays (``"least"``).
    A NULL key joins nothing and is left out.
    """
    if on_repeat not in ("raise", "least"):
        raise ValueError(f"on_repeat is 'raise' or 'least', not {on_repeat!r}")
    rest = F.struct(*[F.col(c) for c in dimension.columns if c != key])
    per = dimension.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(rest).alias("_least"), F.max(rest).alias("_most"))
    row = F.col("_least")
    if on_repeat == "raise":
        message = F.concat(F.lit(f"repeated {key} in a dimension: "), F.col(key).cast("string"))
        row = F.when(F.col("_least").eqNullSafe(F.col("_most")), row).otherwise(F.raise_error(message))
    return per.select(key, row.alias("_row")).select(key, "_row.*").select(*dimension.columns)


# US state / territory names and their two-letter postal codes.
US_STATE_CODES = [
    ("Alabama", "AL"), ("Alaska", "AK"), ("Arizona", "AZ"), ("Arkansas", "AR"),
    ("California", "CA"), ("Colorado", "CO"), ("Connecticut", "CT"), ("Delaware", "DE"),
    ("District of Columbia", "DC"), ("Florida", "FL"), ("Georgia", "GA"), ("Hawaii", "HI"),
    ("Idaho", "ID"), ("Illinois", "IL"), ("Indiana", "IN"), ("Iowa", "IA"),
    ("Kansas", "KS"), ("Kentucky", "KY"), ("Louisiana", "LA"), ("Maine", "ME"),
    ("Maryland", "MD"), ("Massachusetts", "MA"), ("Michigan", "MI"), ("Minnesota", "MN"),
    ("Mississippi", "MS"), ("Missouri", "MO"), ("Montana", "MT"), ("Nebraska", "NE"),
    ("Nevada", "NV"), ("New Hampshire", "NH"), ("New Jersey", "NJ"), ("New Mexico", "NM"),
    ("New York", "NY"), ("North Carolina", "NC"), ("North Dakota", "ND"), ("Ohio", "OH"),
    ("Oklahoma", "OK"), ("Oregon", "OR"), ("Pennsylvania", "PA"), ("Rhode Island", "RI"),
    ("South Carolina", "SC"), ("South Dakota", "SD"), ("Tennessee", "TN"), ("Texas", "TX"),
    ("Utah", "UT"), ("Vermont", "VT"), ("Virginia", "VA"), ("Washington", "WA"),
    ("West Virginia", "WV"), ("Wisconsin", "WI"), ("Wyoming", "WY"),
    ("Puerto Rico", "PR"), ("Virgin Islands", "VI"),
]


def us_state_codes(spark: SparkSession) -> DataFrame:
    """(state, code) for the US states, DC and two territories (53 rows)."""
    return spark.createDataFrame(US_STATE_CODES, "state string, code string")


def state_code(name: Column) -> Column:
    """Single-value lookup of a US state name as a map literal; unknown -> NULL."""
    pairs = [x for s, c in US_STATE_CODES for x in (F.lit(s), F.lit(c))]
    return F.try_element_at(F.create_map(*pairs), name)
