"""Mixing sources to target weights by weighted fair queueing.

=========  ============================================================================================
sizes      words per document, once, into a narrow written table; texts are not read again
targets    each source's share of the budget by its weight, at most ``MOST`` times its own size; what
           that leaves over goes to the others by weight. One row per source
places     documents of a source in shuffled order (by digest), each with the words up to it
queue      every document stands in it ``MOST`` times, at the virtual time at which its source, served
           at its target's rate, has given all words up to it: words so far / target
cut        the queue in order of virtual time, until the budget is spent
=========  ============================================================================================

Served so, all sources reach their targets at the virtual time of 1, where the budget is spent, so each
source's words are off its target by less than its longest document and what others leave over. No
random numbers are drawn: the same rows give the same mix.

Both running totals, within a source and along the whole queue, are taken in two levels: totals of
buckets first, then the rows of each bucket. With as many buckets as the root of the number of documents
both levels have about that many rows: no task holds a source or the queue, and a hot source is spread
evenly. Beside bucket totals only the table of sources passes through one task. All of it is column
expressions; the driver learns the number of documents and of words.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored

#: Weights of the sources in order of their names, repeated as often as needed.
WEIGHTS = (5, 2, 1)
#: How often a document may be taken.
MOST = 3

_WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    """The number of words; none for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, budget: int, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sources`` (``source, source_size``, one row each) with ``rank`` and ``target``, a share of ``budget`` words.

    Names count in code point order, null last, and take the weights in turn. In rising order of
    (cap / weight) a source is capped if, with all before it capped, its share of the rest reaches its
    cap; after the first that does not, none does. So one running total finds the level at which
    resharing ends. A source of no words has the target 0.
    """
    named = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long"))
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    weighed = named.withColumn("weight", F.get(cycle, F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int")).cast("long"))
    weighed = weighed.withColumn("cap", F.col("source_size") * most)
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    all_words = F.lit(int(budget)).cast("long")
    left = weighed.withColumns(
        {
            "words_left": all_words - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weight_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    wide = lambda name: F.col(name).cast("decimal(19,0)")
    capped = left.withColumn("capped", wide("cap") * wide("weight_left") <= wide("words_left") * wide("weight"))
    of_open = lambda name: F.sum(F.when(F.col("capped"), F.col(name)).otherwise(0)).over(everything)
    level = capped.withColumns(
        {"open_words": all_words - of_open("cap"), "open_weight": F.sum("weight").over(everything) - of_open("weight")}
    )
    share = F.col("weight") * (F.col("open_words").cast("double") / F.nullif("open_weight", F.lit(0)).cast("double"))
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share)
    return level.select("source", "rank", "source_size", target.alias("target"))


def running_total(df: DataFrame, value: str, total: str, bucket: str, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``total``: the sum of ``value`` up to and with each row, along (bucket, order) within ``by``.

    No column of ``by`` may be null. Buckets are summed first; the rows of one bucket are all that a
    task has to sort.
    """
    keys = [*by, bucket]
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*keys, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    here = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.join(before, keys).withColumn(total, F.sum(value).over(here) + F.col("_before")).drop("_before")


def queue(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    budget: int | None = None,
) -> DataFrame:
    """Every document ``most`` times in the queue: ``id, source, size, source_size, target, place, copy, finish, taken``.

    ``finish`` is the virtual time, ``taken`` whether the copy comes before the budget is spent.
    Documents without words are in no queue: they come once, with no ``finish``, not taken. A null text
    has no words, a null source is a source of its own, and a null id is an id like others. Rows of one
    id are documents each; rows that agree in everything may stand in either order. An empty table gives
    an empty queue. The budget is the sum of all sizes unless given; beyond ``most`` times that sum
    everything is taken. Only the three named columns are read.
    """
    if most < 1 or not weights or min(weights) < 1 or (budget is not None and budget < 1):
        raise ValueError("weights, the most copies and the budget are at least 1")
    key = F.md5(F.concat(F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit(""))))
    sized = docs.select(F.col(id).alias("id"), F.col(source).cast("string").alias("source"), words_in(F.col(text)).alias("size"), key.alias("key"))
    sized = stored(sized, "mix-sizes")
    rows, words = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    budget = words if budget is None else budget
    known = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), budget, weights, most)
    known = known.withColumnRenamed("source", "known_source")
    named = sized.join(known, F.col("source").eqNullSafe(F.col("known_source"))).drop("known_source")

    buckets = isqrt(rows) + 1
    digits = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    dealt = named.where(F.col("size") > 0).withColumn("bucket", F.shiftright(digits * buckets, 32))
    order = [F.col("key"), F.col("id"), F.col("size")]
    placed = running_total(dealt, "size", "place", "bucket", order, by=["rank"]).drop("bucket", "key")
    placed = stored(placed, "mix-places")

    copies = placed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    finish = (F.col("copy") * F.col("source_size") + F.col("place")).cast("double") / F.col("target")
    queued = copies.withColumn("finish", finish).withColumn("range", F.floor(F.col("finish") * buckets).cast("long"))
    turn = [F.col("finish"), F.col("rank"), F.col("copy"), F.col("place")]
    spent = running_total(queued, "size", "spent", "range", turn)
    columns = ["id", "source", "size", "source_size", "target", "rank", "place", "copy", "finish"]
    served = spent.select(*columns, (F.col("spent") <= F.lit(int(budget))).alias("taken"))
    kinds = dict(served.dtypes)
    rest = {"place": F.lit(None), "copy": F.lit(None), "finish": F.lit(None), "taken": F.lit(False)}
    empty = named.where(F.col("size") == 0).select(*[rest.get(c, F.col(c)).cast(kinds[c]).alias(c) for c in served.columns])
    return served.unionByName(empty)


def mix(docs: DataFrame, **options) -> DataFrame:
    """How often each document goes into the mix: ``id, source, size, source_size, target, copies, taken``.

    ``taken`` is in words. One row per row of ``docs``; options and cases are those of ``queue``.
    """
    queued = queue(docs, **options)
    row = ["id", "source", "size", "source_size", "target", "rank", "place"]
    # Documents with words differ in (rank, place); the others are counted as they come.
    with_words = queued.where(F.col("place").isNotNull()).groupBy(*row).agg(F.count_if("taken").alias("copies"))
    without = queued.where(F.col("place").isNull()).select(*row, F.lit(0).cast("long").alias("copies"))
    out = with_words.unionByName(without)
    return out.select("id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
