"""Balanced label propagation: linked documents move towards the shard of their
neighbours while shard sizes stay even (DataFrame operations only).

Shards start exactly even (row counts differ by one at most). In each round a
linked document whose neighbours mostly sit in another shard asks to move there.
So that two neighbours don't just trade places, documents that come before all
their neighbours stay put in the first rounds, and later a coin lets half of the
documents ask. Moves are granted under quotas: for each pair of shards as many
documents go one way as come back, counting documents without links as willing
fillers, so every round keeps the counts exact. After ``rounds`` rounds they go on
while some component is larger than a shard and the cut falls (each fall is at
least one link, so they end), or until nobody asks or no request can be granted.

Components that fit into a shard and are still split are then placed whole: the
driver packs their sizes (one row a distinct size), largest first, into the room
that whole components leave, anew with all of them if that leaves fewer out; unlinked documents, and
the rows of groups that found no room, fill up the shards.

Exact counts need ranks; a rank is a row number within one written partition
plus the counts of the partitions before it, so no task holds a whole shard.

While the linked documents are counted to be at most ``BROADCAST_ROWS``, whatever is
known per linked document (its shard, its request, its move) is broadcast, and a round
shuffles rows for its votes and its ranks only.

Defined cases: a null text has no links and size 1; an empty table gives no
rows; rows that repeat a document are placed one by one (and linked, if their
texts are equal); edges to unknown ids are dropped; a group larger than a shard
fills it and spills over; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmesh.llm.shared import bounded_broadcast, components, written

BROADCAST_ROWS = 500_000


def _rank(df: DataFrame, *keys: str, few: bool = False) -> DataFrame:
    """Adds ``rank``: gapless from 0 within ``keys``, in the order (part, uid).
    ``few``: the keys are bounded by the shards, so their counts (one row a key and
    written partition) are broadcast."""
    counts = df.groupBy(*keys, "part").count()
    order = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("count").over(order.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("part").alias("_part"), before.alias("_before"))
    counts = F.broadcast(counts) if few else counts
    on = (F.col("part") == F.col("_part"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    own = F.row_number().over(Window.partitionBy(*keys, "part").orderBy("uid"))
    return df.withColumn("_own", own).join(counts, on) \
        .withColumn("rank", F.col("_own") - 1 + F.col("_before")) \
        .drop("_own", "_before", "_part", *[f"_{k}" for k in keys])


def _coin(round_: int, of: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(round_), "uid"), F.lit(of)).cast("int")


def propagate(nodes: DataFrame, edges: DataFrame, shards: int, rounds: int = 8, settled: int = 3, stars: bool = False) -> DataFrame:
    """``nodes`` (uid, part; a written table) with ``shard``, counts even to one.
    ``edges`` (u, v) are undirected; ``part`` numbers the written partitions.
    ``stars``: the edges are known to be between nodes and from every member of a
    component to its least one, so components are read off them."""
    both = edges.select("u", "v").where("u <> v")
    if stars:
        both = written(both, "links")
    both = both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not stars:
        known = nodes.select("uid")
        both = written(both.join(known.withColumnRenamed("uid", "v"), "v", "left_semi")
                       .join(known.withColumnRenamed("uid", "u"), "u", "left_semi").select("u", "v"), "links")
    linked = written(both.groupBy(F.col("u").alias("uid")).agg(
        F.lit(True).alias("linked"), (F.min("v") > F.col("u")).alias("leads"), F.least(F.min("v"), F.col("u")).alias("root")), "linked")
    small = linked.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS

    def near(df: DataFrame) -> DataFrame:
        """``df`` (one row a linked document, or two) for the inner side of a join."""
        return F.broadcast(df) if small else df

    labels = _rank(nodes.join(near(linked.drop("root")), "uid", "left"), few=True).select(
        "uid", "part", F.coalesce("linked", F.lit(False)).alias("linked"), "leads", F.pmod("rank", F.lit(shards)).cast("int").alias("shard"))
    labels = written(labels, "labels")
    if shards < 2 or both.limit(1).count() == 0:
        return labels
    groups = linked.select("uid", "root") if stars else written(components(both, "u", "v").withColumnRenamed("id", "uid"), "groups")
    counts = {r["shard"]: r["count"] for r in labels.groupBy("shard").count().collect()}
    capacity = [counts.get(s, 0) for s in range(shards)]
    large = groups.groupBy("root").count().where(F.col("count") > max(capacity)).limit(1).count() > 0
    round_, cut = 0, None
    while round_ < rounds or large:
        at = labels.where("linked").select(F.col("uid").alias("v"), "shard")
        votes = both.join(near(at), "v").groupBy("u").agg(F.array(*[F.count_if(F.col("shard") == s) for s in range(shards)]).alias("votes"))
        best = votes.select(F.col("u").alias("uid"), "votes", F.array_max(F.transform("votes", lambda n, s: F.struct(n.alias("count"), (-s).alias("shard")))).alias("best"))
        free = ~F.col("leads") if round_ < settled else _coin(round_, 2) == 0
        asks = labels.where(F.col("linked") & free).join(near(best), "uid") \
            .where(F.col("best.count") > F.element_at("votes", F.col("shard") + 1)) \
            .select("uid", "part", "shard", (-F.col("best.shard")).alias("to"), F.lit(1).alias("asks"))
        fill = labels.where(~F.col("linked")).select(
            "uid", "part", "shard", F.pmod(F.col("shard") + 1 + _coin(round_ + 1000, shards - 1), F.lit(shards)).alias("to"), F.lit(0).alias("asks"))
        wishes = written(asks.union(fill), "wishes")
        n = {(r["shard"], r["to"], r["asks"]): r["count"] for r in wishes.groupBy("shard", "to", "asks").count().collect()}
        quota = []
        for a in range(shards):
            for b in range(a + 1, shards):
                there, back = n.get((a, b, 1), 0), n.get((b, a, 1), 0)
                m = min(max(there, back), there + n.get((a, b, 0), 0), back + n.get((b, a, 0), 0))
                for x, y, k in ((a, b, there), (b, a, back)):
                    quota += [(x, y, 1, min(m, k)), (x, y, 0, m - min(m, k))]
        if not any(q for _, _, asked, q in quota if asked):
            round_ += 1
            if round_ <= settled:
                continue
            break
        spark = nodes.sparkSession
        limits = spark.createDataFrame(quota, "q_shard int, q_to int, q_asks int, q long").where("q > 0")
        wanted = wishes.join(F.broadcast(limits), (F.col("shard") == F.col("q_shard")) & (F.col("to") == F.col("q_to")) & (F.col("asks") == F.col("q_asks")))
        moved = _rank(wanted, "shard", "to", "asks", few=True).where(F.col("rank") < F.col("q")).select("uid", "to")
        labels = written(labels.join(near(moved), "uid", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to"), "labels")
        round_ += 1
        if round_ >= rounds and large:
            at = near(labels.where("linked").select(F.col("uid").alias("v"), "shard"))
            before, cut = cut, _cut(at, both)
            if before is not None and cut >= before:
                break
    return _gather(labels, near(groups), capacity)


def _cut(at: DataFrame, both: DataFrame) -> int:
    """Links (in both directions) between shards. ``at``: (v, shard) of linked documents."""
    return both.join(at.withColumnRenamed("shard", "b"), "v") \
        .join(at.select(F.col("v").alias("u"), F.col("shard").alias("a")), "u").where("a <> b").count()


def _pack(sizes: dict[int, int], room: list[int]) -> tuple[list[tuple[int, int, int, int]], int]:
    """Largest first, each into the shard with most room: (size, from, to, shard)
    for ranks within a size, and how many groups found no room."""
    room, plan, left = list(room), [], 0
    for n, count in sorted(sizes.items(), reverse=True):
        at = 0
        for s in sorted(range(len(room)), key=lambda s: (-room[s], s)):
            k = min(count - at, room[s] // n)
            if k > 0:
                plan.append((n, at, at + k, s))
                room[s] -= k * n
                at += k
        left += count - at
    return plan, left


def _gather(labels: DataFrame, groups: DataFrame, capacity: list[int]) -> DataFrame:
    """``labels`` with the split components that fit placed whole, under the
    same counts. ``groups`` (uid, root) are the components of linked documents."""
    spark, shards = labels.sparkSession, len(capacity)
    linked = written(labels.where("linked").join(groups, "uid").select("uid", "root", "shard"), "linked")
    sized = linked.groupBy("root").agg(F.count("*").alias("n"), (F.min("shard") != F.max("shard")).alias("split"))
    sized = written(sized.withColumn("fits", F.col("n") <= max(capacity)).withColumn("uid", F.monotonically_increasing_id())
                    .withColumn("part", F.shiftright("uid", 33)), "sized")
    sizes, whole = {}, {}
    for r in sized.where("fits").groupBy("n", "split").count().collect():  # distinct sizes grow with the root of the rows at most
        (sizes if r["split"] else whole)[r["n"]] = r["count"]
    if not sizes:
        return labels
    used = {r["shard"]: r["count"] for r in linked.join(sized.where("split and fits").select("root"), "root", "left_anti").groupBy("shard").count().collect()}
    plan, left = _pack(sizes, [capacity[s] - used.get(s, 0) for s in range(shards)])
    chosen = sized.where("fits and split")
    if left:
        every = {n: sizes.get(n, 0) + whole.get(n, 0) for n in {*sizes, *whole}}
        fixed = {r["shard"]: r["count"] for r in linked.join(sized.where("fits").select("root"), "root", "left_anti").groupBy("shard").count().collect()}
        anew, without = _pack(every, [capacity[s] - fixed.get(s, 0) for s in range(shards)])
        if without < left:
            plan, chosen = anew, sized.where("fits")
    spans = F.broadcast(spark.createDataFrame(plan, "p_n long, low long, high long, to int"))
    ranked = _rank(chosen.select("uid", "part", "root", "n"), "n")
    placed = ranked.join(spans, (F.col("n") == F.col("p_n")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")), "left").select("root", "to")
    moved = linked.join(placed.withColumn("chosen", F.lit(True)), "root", "left") \
        .select("uid", "to", (F.col("chosen").isNotNull() & F.col("to").isNull()).alias("loose"))
    labels = written(labels.join(moved, "uid", "left").withColumn("shard", F.coalesce("to", "shard"))
                     .withColumn("filler", ~F.col("linked") | F.coalesce("loose", F.lit(False))).drop("to", "loose"), "labels")
    # fillers (unlinked rows, and groups without room): as many as fit stay, the others go where rows are missing
    full = {(r["filler"], r["shard"]): r["count"] for r in labels.groupBy("filler", "shard").count().collect()}
    free = [full.get((True, s), 0) for s in range(shards)]
    want = [capacity[s] - full.get((False, s), 0) for s in range(shards)]
    spare, need, moves = [max(f - w, 0) for f, w in zip(free, want)], [max(w - f, 0) for f, w in zip(free, want)], []
    for a in range(shards):
        at = free[a] - spare[a]
        for b in range(shards):
            k = min(free[a] - at, need[b])
            if k > 0:
                moves.append((a, at, at + k, b))
                need[b] -= k
                at += k
    if not moves:
        return labels
    spans = F.broadcast(spark.createDataFrame(moves, "p_shard int, low long, high long, to int"))
    fill = _rank(labels.where("filler").select("uid", "part", "shard"), "shard", few=True)
    moved = fill.join(spans, (F.col("shard") == F.col("p_shard")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))).select("uid", "to")
    return written(labels.join(moved, "uid", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to"), "labels")


def equal_text_edges(rows: DataFrame) -> DataFrame:
    """(u, v): every row of a group of equal texts with the group's first row.
    ``rows`` is a written table (uid, h1, h2, size; h1 null for null texts)."""
    groups = rows.where("h1 is not null").groupBy("h1", "h2", "size").agg(F.min("uid").alias("v"), F.count("*").alias("n")).where("n > 1")
    groups = bounded_broadcast(written(groups.select("h1", "h2", "size", "v"), "groups"), BROADCAST_ROWS)
    return rows.join(groups, ["h1", "h2", "size"]).where("uid <> v").select(F.col("uid").alias("u"), "v")


def shard(docs: DataFrame, shards: int = 8, rounds: int = 8, id_column: str = "doc_id",
          edges: DataFrame | None = None) -> DataFrame:
    """Places every row of ``docs`` (``id_column``, text) into a shard; the law
    is ``rows`` (counts at most one apart). Links are equal texts, plus
    ``edges`` (u, v) between ids if given. ``slot`` numbers a shard's rows from 0."""
    text = F.col("text")
    rows = docs.select(F.col(id_column), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
                       F.when(text.isNotNull(), F.xxhash64(text)).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"),
                       F.monotonically_increasing_id().alias("uid"))
    rows = written(rows.withColumn("part", F.shiftright("uid", 33)), "rows")
    links = equal_text_edges(rows)
    if edges is not None:
        ids = rows.select(F.col(id_column).alias("_id"), "uid")
        links = links.union(edges.join(ids.withColumnRenamed("uid", "_u"), F.col("u") == F.col("_id")).drop("_id")
                            .join(ids.withColumnRenamed("uid", "_v"), F.col("v") == F.col("_id")).select("_u", "_v"))
    labels = propagate(rows.select("uid", "part"), links, shards, rounds, stars=edges is None)
    placed = _rank(labels, "shard", few=True).select("uid", "shard", F.col("rank").alias("slot"))
    return rows.join(placed, "uid").select(id_column, "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                                           F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
