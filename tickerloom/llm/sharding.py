"""Balanced label propagation: documents with links move towards their neighbours' shards under quotas.

Links are shared group values (equal texts by default); a group is a hub, so n copies have n edges. Every
document starts in the shard its hash names. Copies of one text are alike, so rounds run over cells, the number of a group's documents
in a shard. In each round a small group chooses the shard with most of it among those with room for all of it; any other group the
shards that hold most of it, as many as its size and their room need. Its documents elsewhere ask to move there. A shard admits what
its quota leaves beside the linked documents it has: all that ask, or else a share of large groups and a draw of small ones. A move
either brings a small group together or goes from a smaller cell to a larger one, so the squares of the cells grow, and rounds go on
until no move is left that a shard would admit. Only then do documents
get the shards of their group's cells, in the order of a hash. Documents without links give way at the end, when exact quotas are
restored, and linked ones only where those don't suffice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.common import RANK_BUCKETS, hash_bucket, ranked, spread_join
from tickerloom.session import materialize

SHARDS = 16
#: A group with more than this share of a shard's quota (and than the number of shards) is large: it moves in part where there is not room for all.
LARGE = 1 / 16
#: Less room than this share of the quota is none.
SLACK = 0.02


def _draw(*columns: Column) -> Column:
    """A hash in [0, 1)."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 20)) / float(1 << 20)


def _pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def quotas(total: int, shards: int) -> list[int]:
    """Rows of each shard; they differ by one at most."""
    return [total // shards + (s < total % shards) for s in range(shards)]


def _rooms(cells: DataFrame, quota: list[int]) -> list[int]:
    load = {r[0]: r[1] for r in cells.groupBy("shard").agg(F.sum("n")).collect()}  # one row per shard
    return [q - load.get(s, 0) if q - load.get(s, 0) > q * SLACK else 0 for s, q in enumerate(quota)]


def propagate(cells: DataFrame, quota: list[int]) -> DataFrame:
    """``(group, shard, n)`` of linked groups after rounds of label propagation.

    A round joins the cells with the shards' rooms, orders the few cells of each group in one window, and joins what is asked of each
    shard. Only numbers per shard reach the driver.
    """
    spark, turn, shards = cells.sparkSession, 0, len(quota)
    small = max(max(quota) * LARGE, shards)
    cells = materialize(cells, "cells")
    while True:
        room = _rooms(cells, quota)
        rooms = spark.createDataFrame(list(enumerate(room)), "shard int, room long")
        whole = Window.partitionBy("group")
        sized = cells.join(F.broadcast(rooms), "shard").withColumn("all", F.sum("n").over(whole))
        fits = (F.col("all") <= small) & (F.col("n") + F.col("room") >= F.col("all"))
        best = whole.orderBy(F.desc(fits), F.desc("n"), F.xxhash64("group", "shard"))
        taken = F.coalesce(F.sum(F.col("n") + F.col("room")).over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        wishes = sized.withColumns({"first": F.row_number().over(best), "taken": taken, "lot": _draw(F.col("group"), F.col("shard"), F.lit(turn))})
        # no more than the cells after it hold, as those before it are filled first
        wishes = wishes.withColumn("ask", F.least("room", F.greatest(F.lit(0), F.col("all") - F.col("taken") - F.col("n"))))
        wishes = materialize(wishes.select("group", "shard", "n", "all", "first", "ask", "lot"), "wishes")
        asked = {r.shard: (r.ask, r.lot) for r in wishes.where("ask > 0").groupBy("shard").agg(F.sum("ask").alias("ask"), F.min("lot").alias("lot")).collect()}
        if not asked:
            return cells
        share = [min(1.0, room[s] / asked[s][0]) if s in asked else 0.0 for s in range(shards)]
        least = [asked[s][1] if s in asked else 1.0 for s in range(shards)]  # one is admitted in any case
        part = F.floor(F.col("ask") * _pick(share, F.col("shard"))).cast("long")
        drawn = F.when((F.col("lot") < _pick(share, F.col("shard"))) | (F.col("lot") == _pick(least, F.col("shard"))), F.col("ask")).otherwise(0)
        admitted = wishes.withColumn("in", F.when((F.col("all") > small) & (part > 0), part).otherwise(drawn))
        # what is admitted leaves the cells that were chosen last
        last = whole.orderBy(F.desc("first")).rowsBetween(Window.unboundedPreceding, -1)
        left = F.coalesce(F.sum("n").over(last), F.lit(0))
        gone = F.least("n", F.greatest(F.lit(0), F.sum("in").over(whole) - left))
        moved = admitted.withColumn("out", gone).select("group", "shard", (F.col("n") + F.col("in") - F.col("out")).alias("n"))
        cells = materialize(moved.where("n > 0"), "cells")
        turn += 1


def place(docs: DataFrame, group: str, tie: Column, shards: int = SHARDS) -> DataFrame:
    """``docs`` (a stored table with a unique ``_row``) plus ``shard int`` and ``linked boolean``."""
    total = docs.count()
    named = docs.select(F.col(group).alias("group"), F.pmod(F.xxhash64(tie), F.lit(shards)).cast("int").alias("shard"))
    cells = named.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n"))
    linked = cells.withColumn("all", F.sum("n").over(Window.partitionBy("group"))).where("all > 1").drop("all")
    final = propagate(linked, quotas(total, shards))
    ends = F.sum("n").over(Window.partitionBy("group").orderBy("shard"))
    plan = final.withColumn("end", ends).groupBy("group").agg(F.array_sort(F.collect_list(F.struct("end", "shard"))).alias("plan"), F.sum("n").alias("all"))
    plan = materialize(plan.withColumnRenamed("group", group), "plan")  # at most one entry per shard and group
    known = materialize(spread_join(docs, plan, [group], "all", F.col("_row"), how="left"), "known")
    counted = ranked(known.where("plan is not null"), [group], hash_bucket(F.col("_row")), F.col("_row"), "_at")
    shard = F.filter("plan", lambda p: F.col("_at") < p["end"])[0]["shard"]
    own = F.pmod(F.xxhash64(tie), F.lit(shards)).cast("int")
    alone = known.where("plan is null").withColumns({"shard": own, "linked": F.lit(False)})
    return counted.withColumns({"shard": shard, "linked": F.lit(True)}).drop("_at", "plan").unionByName(alone.drop("plan"))


def level_rows(state: DataFrame, tie: Column, shards: int = SHARDS) -> DataFrame:
    """Move surplus documents to shards that lack some until row counts differ by one at most; unlinked ones go first."""
    load = {r[0]: r[1] for r in state.groupBy("shard").count().collect()}
    over, under = [], []
    for s, quota in enumerate(quotas(sum(load.values()), shards)):
        extra = load.get(s, 0) - quota
        over.append(max(0, extra))
        under.append(max(0, -extra))
    starts = [sum(over[:s]) for s in range(shards)]
    half = RANK_BUCKETS // 2
    order = hash_bucket(tie, half) + F.when(F.col("linked"), half).otherwise(0)
    placed = ranked(state, ["shard"], order, tie, "_rank")
    number = _pick(starts, F.col("shard")) + F.col("_rank")
    target, end = F.lit(None).cast("int"), sum(under)
    for s in reversed(range(shards)):
        end -= under[s]
        if under[s]:
            target = F.when((number >= end) & (number < end + under[s]), F.lit(s)).otherwise(target)
    goes = F.col("_rank") < _pick(over, F.col("shard"))
    return placed.withColumn("shard", F.when(goes, target).otherwise(F.col("shard"))).drop("_rank")


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every row.

    Law ``rows``: row counts of shards differ by one at most. A null text has size 1, and is linked with other null
    texts and empty ones; null or equal keys and repeated rows are rows of their own. An empty table gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"), F.md5(F.encode(body, "UTF-8")).alias("group")
    )
    tie = F.struct("key", "group", "_row")
    stored = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")  # the number is stored
    state = materialize(place(stored, "group", tie, shards), "placed")
    level = materialize(level_rows(state, tie, shards), "level")
    numbered = ranked(level, ["shard"], hash_bucket(tie), tie, "slot")
    return numbered.select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("group").alias("text_md5")
    )


def cut_links(assigned: DataFrame, group: str = "text_md5", shards: int = SHARDS) -> DataFrame:
    """One row: links of the hub graph, those whose end is not in the shard of most of its group, and the shards that groups take
    above the least that hold them."""
    per = assigned.groupBy(group, "shard").agg(F.count(F.lit(1)).alias("n"))
    groups = per.groupBy(group).agg(F.sum("n").alias("all"), F.max("n").alias("most"), F.count(F.lit(1)).alias("used"))
    quota = max(1, -(-assigned.count() // shards))
    linked = groups.withColumn("least", F.ceil(F.col("all") / quota)).where("all > 1")
    zero = F.lit(0)
    return linked.agg(
        F.coalesce(F.sum("all"), zero).alias("links"), F.coalesce(F.sum(F.col("all") - F.col("most")), zero).alias("cut"),
        F.coalesce(F.sum(F.col("used") - F.col("least")), zero).alias("extra_shards"),
    )
