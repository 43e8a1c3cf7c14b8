"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target number of words (its weight's share, at most three times its size) and a
weight schedule over training time. The integral of the schedule, scaled to the target, is the
source's cumulative demand for words; a document's place in its source's stream is turned into a
training position by inverting it. Copies are then sorted by range of position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from strata.llm.common import WORD, documents, prefix_sum, stored

#: A source's words are taken at most this often.
MOST = 3
#: Knots (time, weight) of the schedule of sources that weigh 1, 2 and 3: straight between knots,
#: scaled so that the whole integral is the target.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)),
             ((0.0, 1.0), (0.5, 1.25), (1.0, 0.75)),
             ((0.0, 0.5), (1.0, 1.5)))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``sizes`` (source, source_size) with weight and target, one row per source.

    Sources in code point order, NULL last, weigh 1, 2, 3, 1, ... A target above three times the
    source's size stops there and the excess goes to the others by weight: with sources sorted by
    size over weight, running sums give the level at which no other target is above.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("_full", "_place")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    level = (F.col("_total") - F.coalesce(F.sum(F.col("source_size") * MOST).over(before), F.lit(0))) \
        / F.sum("weight").over(onward)
    return (sizes.withColumn("_place", F.row_number().over(by_name) - 1)
            .withColumn("weight", (F.col("_place") % 3 + 1).cast("int"))
            .withColumn("_total", F.sum("source_size").over(all_rows))
            .withColumn("_full", F.col("source_size") * MOST / F.col("weight"))
            .withColumn("_level", level)
            .withColumn("_water", F.min(F.when(F.col("_level") <= F.col("_full"),
                                               F.struct("_full", "_place", "_level")))
                        .over(all_rows)["_level"])
            .withColumn("target", F.when(F.col("_level") <= F.col("_full"), F.col("_water") * F.col("weight"))
                        .otherwise((F.col("source_size") * MOST).cast("double")))
            .select("source", "source_size", "weight", "target"))


def position(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time at which ``share`` (0 to 1) of a schedule's integral is reached."""
    pieces = [(t, u, a, b) for (t, a), (u, b) in zip(knots, knots[1:])]
    area = sum((u - t) * (a + b) / 2 for t, u, a, b in pieces)
    out, done = None, 0.0
    for t, u, a, b in pieces:
        need, slope = F.greatest(share - F.lit(done), F.lit(0.0)) * F.lit(area), (b - a) / (u - t)
        step = need / F.lit(a) if slope == 0 else \
            (F.sqrt(F.greatest(F.lit(a * a) + need * F.lit(2 * slope), F.lit(0.0))) - F.lit(a)) / F.lit(slope)
        at = F.least(F.lit(t) + step, F.lit(u))
        out = at if out is None else F.when(share >= F.lit(done), at).otherwise(out)
        done += (u - t) * (a + b) / 2 / area
    return out


def plan_mix(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, weight, target, taken, position, copies, place.

    The rows are folded from the training stream, whose copies are sorted by range of position: ``copies`` of the
    row are in it, the first at ``place`` (from 0; NULL without copies). ``taken`` words: whole passes over the source, then the first documents in a fixed hashed
    order until the target (rounded to a word) is met; one document of a source may be taken in
    part. ``position`` (0 to 1) is the training time of the document's first taken word, NULL when
    nothing is taken. NULL or blank texts have size 0 and are never taken; a NULL source is a source
    of its own; NULL doc_ids are ids like any other. Repeated rows follow one another in the order and
    are planned as one item, so any number of them meets in one row. Texts of any length are only
    counted and hashed; columns other than doc_id, source and text, whatever their names, are not read;
    an empty table gives no rows.
    """
    parts = ["doc_id", "source", "size", "source_size", "weight", "target"]
    nothing = F.lit(0).cast("long")
    plan = _each(_plan(_items(docs, nothing, nothing)))
    copies = mix_stream(plan.where(F.col("taken") > 0), parts)
    keys = ["_code", "_tie", "_one", "_two"]  # with doc_id, source and size: one of the rows
    found = copies.groupBy(*parts, *keys).agg(
        F.sum("_words").alias("taken"), F.min("_position").alias("position"),
        F.count(F.lit(1)).alias("copies"), F.min("_place").alias("place"))
    rest = plan.where(F.col("taken") == 0).select(
        *parts, "taken", F.lit(None).cast("double").alias("position"), nothing.alias("copies"),
        F.lit(None).cast("long").alias("place"))
    return found.drop(*keys).unionByName(rest)


def _copies(rows: DataFrame) -> DataFrame:
    """A row for each pass in which a row of the plan is taken (``_pass`` from 0), with the ``_words`` that the
    pass takes of it and its ``_position``: the time at which its source's demand reaches the copy."""
    part = F.col("taken") - F.col("_passes") * F.col("size")
    last = F.col("_passes") - F.when(part > 0, 0).otherwise(1)
    return (rows.where(F.col("taken") > 0).withColumn("_pass", F.explode(F.sequence(F.lit(0).cast("long"), last)))
            .withColumn("_words", F.when(F.col("_pass") < F.col("_passes"), F.col("size")).otherwise(part))
            .withColumn("_position", _at(F.col("_pass") * F.col("source_size") + F.col("_start"))))


#: Order of the training stream; no two copies are equal in it.
ORDER = ["_position", "doc_id", "_code", "_tie", "_one", "_two", "_pass"]


def _sorted(copies: DataFrame) -> DataFrame:
    """The copies by range of training position."""
    return copies.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)


def mix_stream(rows: DataFrame, keep: list[str]) -> DataFrame:
    """The training stream of a plan's rows without texts: one row for each copy, sorted by range of position, with
    ``_place``, its number in the stream (from 0), and ``_words``, of which the last pass may take fewer than all."""
    copies = _copies(rows).select(*dict.fromkeys([*keep, *ORDER, "_words"]))
    # numbers rise by one inside a range and tell it in their upper bits
    copies = stored(_sorted(copies).withColumn("_at", F.monotonically_increasing_id()), "mix-stream")
    copies = copies.withColumn("_range", F.shiftright("_at", 33))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    ranges = copies.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")) \
        .select("_range", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1).cast("long"))
    return copies.join(F.broadcast(ranges), "_range").withColumn("_place", F.col("_ahead") + inside).drop("_range", "_ahead", "_at")


def _items(docs: DataFrame, one: Column, two: Column) -> DataFrame:
    """The rows to mix, without their texts: equal ones as one item with ``_times``. ``one`` and ``two`` tell
    rows apart that differ in other columns. (doc_id, _code, _tie, _one, _two) is an order that does not
    depend on how the table is split."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("_code"),
                       one.alias("_one"), two.alias("_two"))
    items = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_times"))
    return stored(items.withColumn("_tie", F.lit(1)), "mix-items")


def _plan(items: DataFrame) -> DataFrame:
    """``items`` with its source's columns and ``_before``, the words of the source ahead of the item."""
    words = F.col("size") * F.col("_times")
    sources = source_targets(items.groupBy("source").agg(F.sum(words).alias("source_size")))
    items = items.withColumn("_source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    items = prefix_sum(items, ["_source"], ["doc_id", "_code", "_tie", "_one", "_two"], words, "_before",
                       dealt=["doc_id", "_code", "_tie"])
    # one row per source: Spark broadcasts it only below its own size limit
    sources = sources.withColumn("_source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))).drop("source")
    quota = F.floor(F.col("target") + 0.5).cast("long")
    return (items.join(sources, "_source")
            .withColumn("_quota", quota)
            .withColumn("_passes", F.when(F.col("source_size") > 0, F.floor(F.col("_quota") / F.col("source_size")))
                        .otherwise(F.lit(0)).cast("long"))
            .withColumn("_rest", F.col("_quota") - F.col("_passes") * F.col("source_size")))


#: Rows that one list holds while an item is spread over its repeated rows.
BLOCK = 4096


def _each(plan: DataFrame) -> DataFrame:
    """One row for each of an item's rows (``_tie`` from 1), with its own ``_start`` and ``taken``."""
    first = F.col("_block") * BLOCK
    return (plan.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_times") - 1) / BLOCK))))
            .withColumn("_tie", F.explode(F.sequence(first + 1, F.least(first + BLOCK, F.col("_times")))))
            .withColumn("_start", F.col("_before") + (F.col("_tie") - 1) * F.col("size"))
            .withColumn("taken", F.col("_passes") * F.col("size") + F.greatest(
                F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_start"))))
            .drop("_block"))


def _at(words: Column) -> Column:
    """Training time at which a source's demand reaches ``words``."""
    share = F.when(F.col("_quota") > 0, words / F.col("_quota")).otherwise(F.lit(0.0))
    out = F.lit(None).cast("double")
    for k, knots in enumerate(SCHEDULES):
        out = F.when(F.col("weight") == k + 1, position(share, knots)).otherwise(out)
    return out


def _plain(kind: DataType) -> bool:
    """Whether values of the type can be hashed: maps cannot."""
    if isinstance(kind, StructType):
        return all(_plain(f.dataType) for f in kind.fields)
    return _plain(kind.elementType) if isinstance(kind, ArrayType) else not isinstance(kind, (MapType, VariantType))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The training stream: each document's row as often as the mix takes it as a whole, sorted by
    range of training position. Has the columns of ``docs``, whatever their names.

    A document taken in part is kept whole if at least half of that pass is taken. The plan is made on
    narrow rows; texts move twice: to one representative of each set of equal rows, which meets its plan
    there, and in the sort. NULLs, repeated rows and an empty table: as for ``plan_mix``.
    """
    cells = [F.col(f"`{f.name}`") if _plain(f.dataType) else F.to_json(F.struct(F.col(f"`{f.name}`"))) for f in docs.schema.fields]
    one, two = F.xxhash64(*cells), F.xxhash64(F.lit(5), *cells)
    plan = _plan(_items(docs, one, two)).where((F.col("size") > 0) & ((F.col("_passes") > 0) | (F.col("_rest") > F.col("_before"))))
    found = docs.select(one.alias("_one"), two.alias("_two"), F.struct("*").alias("_doc")) \
        .groupBy("_one", "_two").agg(F.first("_doc").alias("_doc"))
    plan = plan.select("_one", "_two", "doc_id", "_code", "size", "_times", "_before", "_passes", "_rest",
                                         "source_size", "_quota", "weight")
    copies = _copies(_each(found.join(plan, ["_one", "_two"]))).where(2 * F.col("_words") >= F.col("size"))
    return _sorted(copies.select(*ORDER, "_doc")).select("_doc.*")


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document, and where its copies begin in the training stream."""
    return plan_mix(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", "position", "copies", "place")
