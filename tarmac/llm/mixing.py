"""Mixing sources to target weights along a time-varying curriculum (DataFrame functions only).

Targets: each source's share of ``volume`` times all words is in proportion to its
weight, but at most ``most`` times its own size; the excess is shared again by weight
until no source is above. That is a common level per weight, found by one running sum
over the sources in the order in which they fill up.

Training positions: a source's weight over training time t in [0, 1] is a piecewise
linear schedule; its integral, scaled to the target, is the number of words the
source has supplied by t. Documents of a source form a stream in the order of the
MD5 of their id, run through twice at most; a document's words in the stream are an
interval, and the inverse of the integral at its middle is the document's position.
The mix is all taken documents range-sorted by position.

The running sums are taken in two levels (blocks of the MD5 order, then documents
within a block), so a source that holds a third of all rows is spread over
``16 ** BLOCK_DIGITS`` groups.

Defined cases: null text has size 0 and is never taken; a null source is a source of its
own, ordered last; null ids come first in a source's stream. Repeated rows are separate
documents. The last document of a stream is taken in part, so a source's words taken
equal its target rounded down. Extra columns are ignored; ``mixed_rows`` keeps them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import WORD

WEIGHTS = (3, 1, 2)
VOLUME = 1.5
MOST = 2
BLOCK_DIGITS = 3
# Weight schedule of each kind of source: (training time, rate) knots. Heavy sources fade
# out, light ones fade in, the others stay level.
RAMPS = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def default_schedule(position: Column) -> Column:
    """Knots of a source by its place in the source order (from 0); times must increase."""
    knots = [F.array(*(F.struct(F.lit(t).alias("t"), F.lit(r).alias("rate")) for t, r in ramp)) for ramp in RAMPS]
    return F.element_at(F.array(*knots), (F.pmod(position, F.lit(len(RAMPS))) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, volume: float = VOLUME, most: int = MOST,
                   schedule: Callable[[Column], Column] = default_schedule) -> DataFrame:
    """named, name, source_size, target, parts (the schedule's linear parts) per source.

    One row per source: the only windows without a key run on this aggregate.
    """
    listed = sizes.groupBy("named", "name").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy(F.desc("named"), "name")) - 1).cast("long")
    weighed = listed.withColumn("place", place).withColumn(
        "weight", F.element_at(F.array(*(F.lit(w) for w in weights)), (F.pmod("place", F.lit(len(weights))) + 1).cast("int")))
    weighed = weighed.withColumn("most", F.col("source_size") * most)
    filling = Window.orderBy(F.col("most") / F.col("weight"), "place")
    total = F.sum("source_size").over(Window.partitionBy()) * volume
    before = F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, 0)) - F.col("most")
    rest = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    levelled = weighed.withColumn("level", (total - before) / rest)
    # sources fill up in this order; the first one whose level it can hold sets the level
    holds = F.when(F.col("level") <= F.col("most") / F.col("weight"), F.struct(F.col("most") / F.col("weight"), "place", "level"))
    levelled = levelled.withColumn("level", F.min(holds).over(Window.partitionBy())["level"])
    knots = schedule(F.col("place"))
    return levelled.select("named", "name", "source_size",
                           F.least(F.col("most").cast("double"), F.col("weight") * F.col("level")).alias("target"),
                           knots.alias("knots")).withColumn("parts", _parts()).drop("knots")


def _parts() -> Column:
    """Linear parts of the schedule with the integral before each of them."""
    area = lambda a, b: (a["rate"] + b["rate"]) / 2 * (b["t"] - a["t"])
    knot = lambda i: F.col("knots")[i]
    upto = lambda i: F.aggregate(F.when(i > 0, F.sequence(F.lit(0), i - 1)).otherwise(F.array().cast("array<int>")), F.lit(0.0),
                                 lambda s, j: s + area(knot(j), knot(j + 1)))
    return F.transform(F.sequence(F.lit(0), F.size("knots") - 2), lambda i: F.struct(
        knot(i)["t"].alias("t"), knot(i)["rate"].alias("rate"),
        ((knot(i + 1)["rate"] - knot(i)["rate"]) / (knot(i + 1)["t"] - knot(i)["t"])).alias("slope"),
        upto(i).alias("before"), upto(i + 1).alias("after")))


def position_of(share: Column, parts: Column) -> Column:
    """Training time at which the share (0 to 1) of a source's words has been supplied."""
    whole = F.element_at(parts, -1)["after"]
    part = F.get(F.filter(parts, lambda p: share * whole <= p["after"]), 0)
    part = F.coalesce(part, F.element_at(parts, -1))
    more = F.greatest(share * whole - part["before"], F.lit(0.0))
    slanted = (F.sqrt(F.greatest(part["rate"] * part["rate"] + 2 * part["slope"] * more, F.lit(0.0))) - part["rate"]) / part["slope"]
    return part["t"] + F.when(part["slope"] == 0, F.coalesce(F.try_divide(more, part["rate"]), F.lit(0.0))).otherwise(slanted)


def mix(docs: DataFrame, *carry: Column, weights: tuple[int, ...] = WEIGHTS, volume: float = VOLUME, most: int = MOST,
        schedule: Callable[[Column], Column] = default_schedule) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, passes (words and position
    of each pass that takes any) and position (of the first pass), after the ``carry``
    columns; sorted by position over range partitions, documents not taken last."""
    if most > 2:
        raise ValueError("a stream runs twice at most")
    key = ["named", "name", "block"]
    order = F.coalesce(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit(""))
    sized = docs.select(*carry, "doc_id", F.col("source").isNotNull().alias("named"),
                        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"),
                        word_count(F.col("text")).alias("size"), order.alias("order"))
    sized = sized.withColumn("block", F.substring("order", 1, BLOCK_DIGITS))
    narrow = docs.select(F.col("source").isNotNull().alias("named"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"),
                         F.substring(order, 1, BLOCK_DIGITS).alias("block"), word_count(F.col("text")).alias("size"))
    by_block = narrow.groupBy(*key).agg(F.sum("size").alias("size"))
    stream = Window.partitionBy("named", "name").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = by_block.withColumn("ahead", F.sum("size").over(stream) - F.col("size")).drop("size").join(
        source_targets(by_block, weights, volume, most, schedule), ["named", "name"])
    within = Window.partitionBy(*key).orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = sized.withColumn("start", F.sum("size").over(within) - F.col("size")).join(blocks, key).withColumn(
        "start", F.col("start") + F.col("ahead"))
    goal = F.floor("target")
    passes = F.transform(F.array(F.lit(0).cast("long"), F.lit(1).cast("long")), lambda i: F.struct(
        (F.col("start") + i * F.col("source_size")).alias("start"),
        F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), goal - F.col("start") - i * F.col("source_size"))).alias("words")))
    placed = placed.withColumn("passes", F.filter(passes, lambda p: p["words"] > 0))
    placed = placed.withColumn("passes", F.transform("passes", lambda p: F.struct(
        p["words"].alias("words"), position_of((p["start"] + p["words"] / 2) / F.col("target"), F.col("parts")).alias("position"))))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda s, p: s + p["words"])
    names = [c for c in placed.columns if c not in {*key, "order", "size", "start", "ahead", "source_size", "target", "parts", "passes", "doc_id"}]
    return placed.select(*names, "doc_id", "size", "source_size", "target", taken.alias("taken"), "passes",
                         F.get("passes", 0)["position"].alias("position")).orderBy(F.asc_nulls_last("position"), "doc_id")


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` (all columns) that the mix takes, once per pass that takes at
    least half of the document, range-sorted by training position."""
    row = F.struct(*(docs[c] for c in docs.columns)).alias("mixed_row")
    mixed = mix(docs.select("doc_id", "source", "text", row), F.col("mixed_row"), **settings)
    taken = mixed.select("mixed_row", "size", F.explode("passes").alias("pass"))
    return taken.filter(F.col("pass.words") * 2 >= F.col("size")).orderBy("pass.position").select("mixed_row.*")
