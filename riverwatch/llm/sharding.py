"""Sharding by balanced label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverwatch.llm.common import drop_stored, gapless_rank, salts_for, stored, table

SHARDS = 16
PIECES = 1024  # hash pieces of a shard's incoming links, the unit of a quota


def link_parts(members: DataFrame, limit: int) -> DataFrame:
    """``members`` (node, link) with links over ``limit`` nodes cut into even hash parts.

    A link that no shard can hold as a whole is placed part by part, so a
    group that holds a third of all nodes is neither one unit nor one task.
    """
    sized = members.groupBy("link").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / F.lit(limit)).cast("long")
    return members.join(sized, "link").select(
        "node", "link", F.pmod(F.xxhash64("node", "link"), parts).alias("part"))


def accept(asked: list[tuple[int, int, int, int]], load: dict[int, int],
           quota: list[int]) -> list[tuple[int, int]]:
    """The (wish, piece) that may move, of ``asked`` rows (shard, wish, piece, n).

    Rows that leave a shard make room there in the same round, so the pieces
    are gone through until none of those left fits.
    """
    moves: dict[tuple[int, int], dict[int, int]] = {}
    for shard, wish, piece, n in asked:
        moves.setdefault((wish, piece), {})[shard] = n
    room = [q - load.get(s, 0) for s, q in enumerate(quota)]
    left, accepted = sorted(moves, key=lambda m: m[::-1]), []
    while left:
        refused = []
        for move in left:
            n = sum(moves[move].values())
            if n > room[move[0]]:
                refused.append(move)
                continue
            room[move[0]] -= n
            for shard, k in moves[move].items():
                room[shard] += k
            accepted.append(move)
        if len(refused) == len(left):
            break
        left = refused
    return accepted


def propagate(nodes: DataFrame, members: DataFrame, shards: int, quota: list[int],
              rounds: int | None = None) -> DataFrame:
    """(node, shard) for the linked nodes after rounds of balanced label propagation.

    ``nodes``: (node, shard), the labels to start from. ``members``: (node,
    link, part). In a round each link counts its members by shard and prefers
    the shard that has most of them (of equals by hash); each node moves
    towards the shard that its links prefer. A shard accepts no more than its
    ``quota`` and the nodes that leave it make room for: incoming links go in
    the order of a hash, in ``PIECES`` pieces of which all that fit are
    accepted. Rounds go on until no move is accepted or the number of nodes
    that wish to move stops falling (or for ``rounds``). The tables that meet on
    the driver are shards x shards x PIECES rows at most.
    """
    spark = nodes.sparkSession
    now, turn, fewest = nodes, 0, None
    while rounds is None or turn < rounds:
        votes = members.join(now, "node").groupBy("link", "part", "shard").agg(
            F.count("*").alias("n"))
        best = votes.groupBy("link", "part").agg(F.max_by("shard", F.struct(
            "n", F.xxhash64("link", "part", "shard"))).alias("wish"), F.max("n").alias("strength"))
        wishes = members.join(best, ["link", "part"]).groupBy("node").agg(F.max_by(
            F.struct("wish", F.pmod(F.xxhash64("link", "part"), F.lit(PIECES)).alias("piece")),
            F.struct("strength", F.xxhash64("link", "part"))).alias("w"))
        movers = now.join(wishes, "node").select(
            "node", "shard", F.col("w.wish").alias("wish"), F.col("w.piece").alias("piece"))
        moved = stored(movers, "shards-wishes")
        load = {r["shard"]: r["n"] for r in now.groupBy("shard").agg(
            F.count("*").alias("n")).collect()}
        asked = [tuple(r) for r in moved.filter("wish <> shard").groupBy("shard", "wish", "piece").agg(
            F.count("*").alias("n")).collect()]  # shards x shards x PIECES rows at most
        wishing = sum(r[3] for r in asked)
        falling = fewest is None or wishing < fewest
        fewest = wishing
        accepted = accept(asked, load, quota) if falling else []
        if not accepted:
            drop_stored(moved)
            break
        taken = F.broadcast(spark.createDataFrame(accepted, "wish int, piece long")
                            .withColumn("taken", F.lit(True)))
        after = stored(moved.join(taken, ["wish", "piece"], "left").select(
            "node", F.when(F.col("taken"), F.col("wish")).otherwise(F.col("shard")).alias("shard")),
            "shards")
        drop_stored(moved)
        if turn:
            drop_stored(now)
        now, turn = after, turn + 1
    return now


def _ends(groups: DataFrame, key: str, salts: int) -> DataFrame:
    """``groups`` (key, link, part, n) plus ``upto``: the running sum of n in its key, in salted parts."""
    salted = groups.withColumn("salt", F.pmod(F.xxhash64(F.lit("ends"), "link", "part"), F.lit(salts)))
    before = Window.partitionBy(key).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = salted.groupBy(key, "salt").agg(F.sum("n").alias("sum")).select(
        key, "salt", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("before"))
    local = F.sum("n").over(Window.partitionBy(key, "salt").orderBy("link", "part"))
    return salted.withColumn("local", local).join(parts, [key, "salt"]).withColumn(
        "upto", F.col("before") + F.col("local")).drop("salt", "local", "before")


def settle(placed: DataFrame, members: DataFrame, target: list[int], total: int) -> DataFrame:
    """(node, shard, rank): linked nodes that keep their shard, and the others' place in one line.

    Kept are whole groups (links' parts), as many as the shard's target holds.
    All others stand in the line one group after the other, rank 0, 1, 2, ...,
    so that filling the shards from it cuts one group a shard at most.
    """
    at = stored(members.join(placed, "node"), "shards-at")
    groups = stored(at.groupBy("link", "part").agg(
        F.count("*").alias("n"), F.min("shard").alias("shard"), F.max("shard").alias("other")),
        "shards-groups")
    limit = F.element_at(F.array(*[F.lit(t) for t in target]), F.col("shard") + 1)
    whole = groups.filter(F.col("shard") == F.col("other")).drop("other")
    kept = stored(_ends(whole, "shard", salts_for(total)).filter(F.col("upto") <= limit).select(
        "link", "part", "shard"), "shards-kept")
    line = _ends(groups.select("link", "part", "n", F.lit(0).alias("all")).join(
        kept, ["link", "part"], "left_anti"), "all", salts_for(total))
    waiting = stored(at.drop("shard").join(line.select(
        "link", "part", (F.col("upto") - F.col("n")).alias("first")), ["link", "part"]), "shards-line")
    ranked = gapless_rank(waiting, ["link", "part"], ["node"], "own", 8)
    stay = at.drop("shard").join(kept, ["link", "part"]).select(
        "node", "shard", F.lit(None).cast("long").alias("rank"))
    return stay.unionByName(ranked.select(
        "node", F.lit(None).cast("int").alias("shard"), (F.col("first") + F.col("own")).alias("rank")))


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) for each row; shard counts are at most one apart.

    Rows link when their texts are equal. Linked rows take part in the label
    propagation, with quotas an eighth over the exact counts so that groups can
    pass; groups that do not end whole or are too many for a shard are then
    laid out one after the other over the room that is left, and unlinked rows
    fill each shard to its exact count. ``slot`` counts
    from 0 within a shard, without gaps.

    Nulls: a null text counts as empty and is linked with empty texts; null
    ids are carried along. Repeated rows are rows of their own, linked by their
    text. An empty table gives an empty result. Other columns are not read.
    Equality of texts is that of length, CRC-32 and MD5.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.md5(text).alias("link"),
        F.monotonically_increasing_id().alias("node")), "shards-rows")
    total = rows.count()
    target = [total // shards + (s < total % shards) for s in range(shards)]

    members = stored(link_parts(rows.select("node", "link"), max(2, target[-1] // 4)),
                     "shards-members")
    start = members.select("node", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")
                           .alias("shard"))
    placed = propagate(start, members, shards, [t + t // 8 for t in target], rounds)
    settled = stored(settle(placed, members, target, total), "shards-settled")
    load = {r["shard"]: r["n"] for r in settled.filter("shard IS NOT NULL").groupBy("shard").agg(
        F.count("*").alias("n")).collect()}
    waiting = settled.filter("rank IS NOT NULL").count()

    joined = stored(rows.drop("link").join(settled, "node", "left"), "shards-joined")
    free = joined.filter("shard IS NULL AND rank IS NULL").drop("shard", "rank").withColumn("all", F.lit(0))
    ranked = gapless_rank(free, ["all"], ["node"], "rank", salts_for(total)).drop("all").withColumn(
        "rank", F.col("rank") + waiting)
    line = joined.filter("rank IS NOT NULL").drop("shard").unionByName(ranked)
    shard, upto = F.lit(0), 0
    for s in range(shards):  # the row of this rank goes to the first shard with room for it
        shard = F.when(F.col("rank") >= upto, s).otherwise(shard)
        upto += target[s] - load.get(s, 0)
    filled = line.withColumn("shard", shard.cast("int")).drop("rank")
    joined = joined.drop("rank")
    done = stored(joined.filter("shard IS NOT NULL").unionByName(filled), "shards-done")
    return gapless_rank(done, ["shard"], ["node"], "slot", salts_for(total)).select(
        "id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        "slot", F.lit(None).cast("int").alias("grown_shard"))
