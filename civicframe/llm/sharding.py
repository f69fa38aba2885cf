"""Sharding by balanced label propagation.

Documents that share a link key (here: equal texts) are neighbours. Each document starts in a shard that a hash names.
In a round, every group's bytes in each shard are summed, and its documents outside the shard that has most of them
ask to move there. Of the wishes from one shard to another as many bytes are granted as wish the other way, plus a part of
the room below the target's capacity; groups are granted whole, in the order of a hash. After the rounds the remaining
members of small groups join the rest of these. At last all documents stand on a line, by shard, group and id, and the line is cut into pieces of equal bytes: this keeps neighbours side by side, and
evens what the rounds left uneven. Only ids, sizes and keys move; texts are read once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicframe.llm.common import small, stored

ROUNDS = 4
#: Room above an equal share during the rounds; the cut of the line takes it back.
SLACK = 0.25
#: Rows that a task orders at a time, on average.
CELL_ROWS = 5000


def _unit(*keys) -> Column:
    """A number in [0, 1) that the keys decide."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 52)) / float(1 << 52)


def grants(flows: dict[tuple[int, int], int], loads: dict[int, int], capacity: float) -> dict[tuple[int, int], float]:
    """Share of the bytes that wish from one shard to another that may go, for each pair of shards."""
    into: dict[int, int] = {}
    for (_, b), f in flows.items():
        into[b] = into.get(b, 0) + f
    room = {b: max(0.0, capacity - loads.get(b, 0)) for b in into}
    return {(a, b): min(1.0, (min(f, flows.get((b, a), 0)) + room[b] * f / into[b]) / f) for (a, b), f in flows.items() if f > 0}


def _wishes(rows: DataFrame) -> DataFrame:
    """``rows`` with ``to``: the shard that has most bytes of their group; null for groups of one."""
    held = rows.where("members > 1").groupBy("group", "shard").agg(F.sum("size").alias("b"))
    most = held.groupBy("group").agg(F.max(F.struct("b", F.xxhash64("group", "shard").alias("h"), "shard")).alias("top"))
    return rows.join(most.select("group", F.col("top.shard").alias("to")), "group", "left")


def propagate(rows: DataFrame, shards: int, *, rounds: int = ROUNDS) -> DataFrame:
    """Label ``rows`` (id, group, size, members, group_bytes and any others) with a shard, after some rounds."""
    spark = rows.sparkSession
    rows = stored(rows.withColumn("shard", F.floor(_unit("id", "group", F.lit("start")) * shards).cast("int")), "labels")
    for k in range(rounds):
        loads = {r.shard: r.b for r in rows.groupBy("shard").agg(F.sum("size").alias("b")).collect()}  # a row a shard
        capacity = (1 + SLACK) * sum(loads.values()) / shards
        wishes = _wishes(rows)
        counted = wishes.where("to <> shard").groupBy("shard", "to").agg(F.sum("size").alias("b")).collect()  # shards ** 2 rows at most
        allowed = grants({(r.shard, r.to): r.b for r in counted}, loads, capacity)
        if not allowed:
            break
        table = F.broadcast(spark.createDataFrame([(a, b, p) for (a, b), p in allowed.items()], "shard int, to int, p double"))
        # groups that are large against a shard are granted document by document
        chance = F.when(F.col("group_bytes") * 50 > capacity, _unit("id", "group", F.lit(k))).otherwise(_unit("group", F.lit(k)))
        moved = wishes.join(table, ["shard", "to"], "left").withColumn("shard", F.when(chance < F.col("p"), F.col("to")).otherwise(F.col("shard")))
        rows = stored(moved.select(*rows.columns), "labels")
    # what quotas still keep apart settles with the rest of its group, if that is small against a shard
    total = rows.agg(F.sum("size")).first()[0] or 0
    settled = F.when((F.col("group_bytes") * 50 * shards <= total) & F.col("to").isNotNull(), F.col("to")).otherwise(F.col("shard"))
    return _wishes(rows).withColumn("shard", settled).select(*rows.columns)


def even_cut(rows: DataFrame, shards: int) -> DataFrame:
    """Put labelled ``rows`` on a line by label and group and cut it into ``shards`` pieces of equal bytes.

    Sets ``shard`` and adds ``slot``, from 0 without gaps in each shard. The line is made of cells: label, range of
    the group's hash, and for groups that alone would fill a task, ranges of the document's hash. Rows are ordered
    inside cells; where a cell begins comes from the sums of those before it, of which there are a bounded number.
    """
    rows = stored(rows, "settled")
    n = rows.count()
    buckets = max(1, n // (shards * CELL_ROWS))
    giant = F.col("members") > CELL_ROWS
    cell = [F.col("shard").alias("_l"), F.floor(_unit("group") * buckets).alias("_b"), F.when(giant, F.col("group")).alias("_g"), F.when(giant, F.floor(_unit("id", "group") * F.ceil(F.col("members") / CELL_ROWS))).otherwise(F.lit(0)).alias("_s")]
    names = ["_l", "_b", "_g", "_s", "_x"]
    rows = rows.select(*[c for c in rows.columns if c != "shard"], *cell).withColumn("_x", F.lit(0).cast("bigint"))
    # rows that share group and id fall in one cell, whatever their number: such a cell is cut by the number of the row
    hot = stored(rows.groupBy(*names[:-1]).agg(F.count("*").alias("_n")).where(F.col("_n") > 2 * CELL_ROWS), "hot-cells")
    if hot.limit(1).count():
        on = [F.col(f"r.{c}").eqNullSafe(F.col(f"h.{c}")) for c in names[:-1]]
        cut = F.coalesce(F.floor(_unit("row") * F.ceil(F.col("h._n") / CELL_ROWS)), F.lit(0))
        rows = rows.drop("_x").alias("r").join(small(hot).alias("h"), reduce(lambda a, b: a & b, on), "left").select("r.*", cut.alias("_x"))
    before = Window.orderBy(*(F.col(c).asc_nulls_first() for c in names)).rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy(*names).agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    cells = cells.select(*names, F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_at"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"), F.sum("_bytes").over(Window.partitionBy()).alias("_total"))
    inside = Window.partitionBy(*names).orderBy("group", F.col("id").asc_nulls_first(), "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_upto", F.sum("size").over(inside)).withColumn("_k", F.row_number().over(inside) - 1)
    same = None
    for c in names:
        test = F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}"))
        same = test if same is None else same & test
    line = rows.alias("r").join(cells.alias("c"), same)
    middle = F.col("_at") + F.col("_upto") - F.col("size") / 2
    kept = [F.col(f"r.{c}").alias(c) for c in rows.columns if c not in (*names, "_upto", "_k")]
    line = stored(line.select(*kept, F.least(F.floor(middle * shards / F.col("_total")), F.lit(shards - 1)).cast("int").alias("shard"), (F.col("_first") + F.col("_k")).alias("_place")), "line")
    starts = F.broadcast(line.groupBy("shard").agg(F.min("_place").alias("_start")))  # a row a shard
    return line.join(starts, "shard").withColumn("slot", F.col("_place") - F.col("_start")).drop("_place", "_start")


def shard(docs: DataFrame, *, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, shard and slot, with near equal bytes in each shard.

    Size is the UTF-8 length of the text plus 1; null texts count as empty. Equal texts are neighbours; empty and null
    ones are so too. After the rounds a group of up to a fiftieth of a shard is put together whole, as the cut of the line
    then moves it little; a larger one stays as far as its quotas brought it, and the cut decides. Repeated rows are documents of their own. A group larger than a shard is spread over neighbouring
    shards. With fewer rows than shards some shards stay empty; an empty table gives no rows. Other columns are ignored.
    """
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), F.xxhash64(data).alias("group"), F.monotonically_increasing_id().alias("row"))
    rows = stored(rows, "shard-rows")
    groups = rows.groupBy("group").agg(F.count("*").alias("members"), F.sum("size").alias("group_bytes")).where("members > 1")
    rows = rows.join(groups, "group", "left").fillna({"members": 1}).withColumn("group_bytes", F.coalesce("group_bytes", "size"))
    done = even_cut(propagate(rows, shards, rounds=rounds), shards)
    return done.select(F.col("id").alias("doc_id"), "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"), "group")
