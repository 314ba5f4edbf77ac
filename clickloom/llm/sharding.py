"""Sharding by sampled splitters, in DataFrame functions only.

Records are ordered by a key, ties by id and then by row, so that even a third of all rows with one
key can be cut anywhere. A sample is drawn in which a record is met in proportion to its size; the
sample's quantiles are the splitters of ranges of about equal bytes. A range that still holds more
than ``max_rows`` rows is overfull: it gets a sample, now of its rows, and splitters of its own, and so
on, until none is left. Totals per range, added up in order, say where each range begins; a running sum inside a
range then gives the place of every record among all bytes, and its shard. So the sample decides
how the work is spread, while the shards are the same for every sample: consecutive records, whose
bytes differ from an equal share by a record at either end.

The law is ``bytes``: the shards' sizes are near equal. Records with equal texts are neighbours; only
a group that a shard's end falls into is in two shards or more.

A null text is empty, of size 1. Null ids come first among equal texts. Repeated rows are placed
each by itself. An empty table gives no rows; with fewer records than shards some stay empty. Other
columns pass; those named like a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.sources.storage import materialize

LAW = "bytes"


@dataclass(frozen=True)
class Plan:
    shards: int = 8
    # Ranges that one level of splitters makes; a power of two.
    ranges: int = 512
    # Sampled points per range, on average.
    draws: int = 16
    # A range of more rows is subdivided.
    max_rows: int = 100_000


def text_key(text: Column) -> Column:
    """60 bits of the text's MD5: equal texts have equal keys."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _below(order: str, splitters: str, ranges: int) -> str:
    """How many of the sorted splitters are not above ``order``, by halving."""
    steps = [1 << k for k in reversed(range(ranges.bit_length() - 1))]
    return f"""aggregate(array({', '.join(map(str, steps))}), 0, (at, step) ->
        if(at + step <= size({splitters}) and {splitters}[at + step - 1] <= {order},
           at + step, at))"""


def _totals(rows: DataFrame) -> DataFrame:
    return materialize(rows.groupBy("range").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")), "totals")


def _splitters(rows: DataFrame, parents: DataFrame, level: int, plan: Plan) -> DataFrame:
    """``(range, splitters)`` of the ranges in ``parents``, from a sample.

    The first sample is of bytes: a record as large as the bytes for one point is drawn once on
    average, a larger one as often as it is larger. Later ones are of rows, as their ranges have
    too many; there a few very long records would draw all points. The draw is a hash, so it is
    the same when a task is run again, and another one on each level.
    """
    cells = 1 << 30
    chance = F.pmod(F.xxhash64("order", F.lit(level)), F.lit(cells)) / F.lit(float(cells))
    points = plan.ranges * plan.draws
    mean = F.col("size") / F.col("bytes") if level == 0 else 1 / F.col("n")
    sample = (rows.join(parents.select("range", "n", "bytes"), "range")
              .select("range", "order", F.floor(mean * points + chance).alias("points"))
              .where("points > 0"))
    whole = Window.partitionBy("range")
    upto = F.sum("points").over(whole.orderBy("order"))
    quantile = "upto * {0} div drawn".format(plan.ranges)
    before = "(upto - points) * {0} div drawn".format(plan.ranges)
    return (sample.withColumns({"upto": upto, "drawn": F.sum("points").over(whole)})
            .where(f"{quantile} > {before} and {quantile} < {plan.ranges}")
            .groupBy("range").agg(F.sort_array(F.collect_list("order")).alias("splitters")))


def _ranged(keyed: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame, int]:
    """Rows with their range, the totals of the ranges, and how many levels were needed."""
    rows, totals = keyed, _totals(keyed)
    parents, level = totals, 0
    # Ranges are numbered in a long. One that is still overfull then only makes a larger task.
    while level == 0 or (plan.ranges ** (level + 1) < 1 << 62 and not parents.isEmpty()):
        cuts = materialize(_splitters(rows, parents, level, plan), "splitters")
        # The first two levels have at most 1 and ``ranges`` parents with so many splitters each.
        cuts = F.broadcast(cuts) if level < 2 else cuts
        rows = (rows.join(cuts, "range", "left")
                .withColumn("range", F.col("range") * plan.ranges + F.coalesce(
                    F.expr(_below("`order`", "splitters", plan.ranges)), F.lit(0)))
                .drop("splitters"))
        level += 1
        totals = _totals(rows)
        parents = totals.where(F.col("n") > plan.max_rows)
    return rows, totals, level


def _begins(totals: DataFrame, plan: Plan, level: int) -> DataFrame:
    """Rows and bytes before each range, added up in two steps.

    The ranges of the first level, ``ranges`` at most, are added up in one task, and those below
    each of them in theirs.
    """
    parts = totals.withColumn("top", F.expr(f"`range` div {plan.ranges ** (level - 1)}"))
    tops = parts.groupBy("top").agg(F.sum("n").alias("top_n"), F.sum("bytes").alias("top_bytes"))
    outer, inner = Window.orderBy("top"), Window.partitionBy("top").orderBy("range")
    tops = tops.select("top", *[(F.sum(c).over(outer) - F.col(c)).alias(c)
                                for c in ("top_n", "top_bytes")])
    return (parts.select("top", "range", *[(F.sum(c).over(inner) - F.col(c)).alias(c)
                                           for c in ("n", "bytes")])
            .join(tops, "top")
            .select("range", (F.col("top_n") + F.col("n")).alias("rows_before"),
                    (F.col("top_bytes") + F.col("bytes")).alias("bytes_before")))


def shard(records: DataFrame, key: Column, size: Column, tie: Column,
          plan: Plan = Plan()) -> DataFrame:
    """``records`` with ``shard`` and ``slot``.

    ``key`` and ``tie`` are longs, neither null; ``size`` is a long of at least 1.
    """
    # Records are kept whole in one column, so their names meet no others.
    keyed = materialize(records.select(
        F.lit(0).cast("long").alias("range"), F.struct("*").alias("record"), size.alias("size"),
        F.struct(key.alias("key"), tie.alias("tie"),
                 F.monotonically_increasing_id().alias("row")).alias("order")), "keyed")
    total = keyed.agg(F.sum("size")).first()[0] or 1
    rows, totals, level = _ranged(keyed, plan)
    within = Window.partitionBy("range").orderBy("order")
    upto = F.col("bytes_before") + F.sum("size").over(within)
    placed = (rows.join(_begins(totals, plan, level), "range")
              .withColumns({"upto": upto, "place": F.row_number().over(within)})
              .select("record", (F.col("rows_before") + F.col("place") - 1).alias("place"),
                      # The shard that the middle of the record falls into.
                      F.expr(f"least({plan.shards - 1}, (2 * upto - size) * {plan.shards}"
                             f" div {2 * total})").cast("int").alias("shard")))
    placed = materialize(placed, "placed")
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    others = [F.col("record")[c].alias(c) for c in records.columns if c not in ("shard", "slot")]
    return (placed.join(F.broadcast(firsts), "shard")  # one row for each shard
            .select(*others, "shard", (F.col("place") - F.col("first")).alias("slot")))


def shard_documents(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``docs`` with ``size, text_crc32, law, shard, slot, grown_shard``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = ("size", "text_crc32", "law", "grown_shard")
    measured = docs.drop(*found).withColumns({
        "size": (F.octet_length(text) + 1).cast("long"),
        "text_crc32": F.crc32(text.cast("binary"))})
    least_id = F.lit(-(1 << 63)).cast("long")
    placed = shard(measured, text_key(text), F.col("size"),
                   F.coalesce(F.col("doc_id").cast("long"), least_id), plan)
    return placed.withColumns({"law": F.lit(LAW), "grown_shard": F.lit(None).cast("int")})


def places(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The places of :func:`shard_documents` without the texts, which are read once and stay."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), text_key(text).alias("key"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("tie"))
    return shard(narrow, F.col("key"), F.col("size"), F.col("tie"), plan).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, plan: Plan = Plan()) -> None:
    """Stores the documents in a folder per shard, in the order of their slots."""
    (shard_documents(docs, plan).repartitionByRange("shard", "slot")
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
