"""Mixing sources to target weights along a curriculum whose weights change over training time.

Each source has a weight, which sets how many words the whole training takes of it, and a
schedule, which sets when: a weight that is linear between knots over training time 0 to 1.
The integral of the schedule, scaled to the source's target, is the cumulative demand for
its words.  The documents of a source stand in an order that only depends on their ids; the
demand curve is inverted at the word at which a document begins, and that time is its place
in training.  Documents are then range-sorted by it.

A target above the size of a source is met by passing over its documents again, in the same
order; the document in which a target ends is taken in part, so that each source gives exactly
its target, rounded down.  Targets are filled up evenly: a source whose share by weight is more
than ``most`` times its size stops there, and the others share the rest by weight.

Null texts have size 0; documents of size 0, and all of a table without words, are not taken
and have no position.  A null source is a source of its own, the last.  Repeated rows are
documents of their own; which of two equal rows comes first makes no difference.  A null id
is placed as the empty text.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm import common
from tidegate.llm.running import running_sums, written
from tidegate.operators.skew import join_groups

#: Knots (training time from 0 to 1, weight) of a schedule.
Schedule = Sequence[tuple[float, float]]

WORD = r"[^\x20\x09-\x0D]+"
#: What sources are dealt in turn, in code-point order of their names: weights, and schedules.
WEIGHTS = (5, 2, 1)
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 1.0), (0.5, 1.0), (1.0, 0.25)),  # most of it early
    ((0.0, 1.0), (1.0, 1.0)),  # even
    ((0.0, 0.0), (0.25, 0.25), (1.0, 1.0)),  # grows towards the end
)


def areas(schedule: Schedule) -> list[float]:
    """The integral of a schedule up to each of its knots."""
    times, weights = zip(*schedule)
    if list(times) != sorted(set(times)) or times[0] != 0 or times[-1] != 1 or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("a schedule has knots from time 0 to time 1 and weights that are not negative nor all zero")
    out = [0.0]
    for (a, v), (b, w) in zip(schedule, schedule[1:]):
        out.append(out[-1] + (b - a) * (v + w) / 2)
    return out


def time_of(share: Column, schedule: Schedule) -> Column:
    """When a source whose weight follows the schedule has given ``share`` of its words: the inverse of the integral."""
    upto = areas(schedule)
    asked = share * F.lit(upto[-1])
    found = F.lit(1.0)
    for (a, v), (b, w), low, high in reversed(list(zip(schedule, schedule[1:], upto, upto[1:]))):
        if high == low:
            continue  # nothing is taken while the weight is zero
        more = asked - F.lit(low)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(v * v) + F.lit(2 * ((w - v) / (b - a))) * more))
        inside = F.when(more <= 0, F.lit(a)).otherwise(F.lit(a) + F.lit(2.0) * more / (F.lit(v) + root))
        found = F.when(asked < F.lit(high), inside).otherwise(found)
    return found


def targets(sources: DataFrame, share: float = 1.5, most: float = 2.0, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """``source``, ``source_size`` and ``rows`` with the source's ``place`` by name, the words of sources before it
    (``start``) and its ``target``."""
    named = running_sums(written(sources.withColumn("one", F.lit(1).cast("long")), "sources"), [F.col("source").asc_nulls_last()], ["one", "source_size"])
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("before_one") % len(weights) + 1).cast("int"))
    named = named.select("source", "source_size", "rows", F.col("before_one").alias("place"), F.col("before_source_size").alias("start"),
                         weight.alias("weight"), (F.col("source_size") * F.lit(float(most))).alias("cap"))
    filled = written(running_sums(written(named, "named"), [F.col("cap") / F.col("weight"), F.col("place")], ["cap", "weight"]), "filled")
    whole = filled.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    budget = F.lit(float(share) * (whole["size"] or 0))
    # The sources that stop at their cap come first in this order; from the first that does not, all share what is left by weight.
    rest, left = budget - F.col("before_cap"), F.lit(whole["weight"] or 0.0) - F.col("before_weight")
    own = F.col("weight") * rest / left
    first = filled.where(own <= F.col("cap")).orderBy(F.col("cap") / F.col("weight"), "place").select("before_cap", "before_weight").first()
    if first is None:  # all stop at their cap
        return filled.withColumn("target", F.col("cap"))
    rest, left = budget - F.lit(first["before_cap"]), F.lit(whole["weight"] - first["before_weight"])
    return filled.withColumn("target", F.least(F.col("cap"), F.col("weight") * rest / left))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: Sequence[float] = WEIGHTS, schedules: Sequence[Schedule] = SCHEDULES,
        doc_id: str = "doc_id", text: str = "text", source: str = "source", keep: list[str | Column] = ()) -> DataFrame:
    """Per row, range-sorted by its first position: ``keep``, ``size``, ``source_size``, ``target``, ``taken``, and
    ``passes`` (of each time it is met: ``position`` from 0 to 1, ``words`` taken)."""
    common.prepared(docs.sparkSession)
    kept = docs.select(*keep).columns if keep else []
    own_id = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*keep).alias("kept") if keep else F.lit(None).cast("string").alias("kept"), F.col(source).alias("source"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.md5(F.concat(own_id, F.lit(":mix"))).alias("key"), own_id.alias("id"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "sizes")
    found = written(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")), share, most, weights), "targets")
    joined = join_groups(rows, found.drop("before_cap", "before_weight", "cap", "weight"), ["source"], "rows", ["row"])
    joined = written(joined.select("kept", "size", "key", "id", "source_size", "place", "start", "target"), "joined")
    ordered = running_sums(joined, [F.col("place"), F.col("key"), F.col("id"), F.col("size")], ["size"])

    begin = F.col("before_size") - F.col("start")
    turn = F.element_at(F.array(*(F.lit(i) for i in range(len(schedules)))), (F.col("place") % len(schedules) + 1).cast("int"))
    wanted = F.floor("target")
    passes = []
    for p in range(math.ceil(most)):
        at = begin + F.lit(p) * F.col("source_size")
        words = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), wanted - at))
        when = F.lit(None).cast("double")
        for i, schedule in enumerate(schedules):
            when = F.when(turn == i, time_of(at.cast("double") / wanted.cast("double"), schedule)).otherwise(when)
        passes.append(F.struct(F.when(words > 0, when).alias("position"), words.alias("words")))
    out = ordered.withColumn("passes", F.filter(F.array(*passes), lambda x: x["words"] > 0))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda total, x: total + x["words"])
    out = out.select(*(F.col(f"kept.`{c}`") for c in kept), "size", "source_size", "target", taken.alias("taken"), "passes", "key")
    return out.orderBy(F.try_element_at("passes", F.lit(1))["position"].asc_nulls_last(), "key", "size").drop("key")


def training_order(mixed: DataFrame) -> DataFrame:
    """A row each time a document is met, in the order of training: the columns of ``mix`` with ``position`` and ``words``."""
    met = mixed.select("*", F.explode("passes").alias("__met")).drop("passes")
    return met.select(*(f"`{c}`" for c in met.columns if c != "__met"), "__met.position", "__met.words").orderBy("position")
