"""Balanced label propagation: equal texts into the same shards, counts kept even.

Documents are linked to the documents of equal text, through their group and never
pair by pair. Every document starts in the shard its id hashes to. In each round
the linked documents of a group vote by where they are, and those elsewhere move
to the shard with the most votes (a group larger than a shard: to as many shards
as it needs). Quotas limit the moves: a shard takes linked documents up to its
even share of all documents, plus what leaves it. Where more want to move in, a
hash decides who does, so no task sorts the movers. Documents without a link cut
no edge and fill up what is left, so the counts end at most one apart (law
``rows``).
 Null texts are empty and linked like any other; null ids are ids.
Repeated rows are rows of their own. An empty table gives an empty result; other
columns, whatever their names, are not read. All of it is DataFrame work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joining import attach_totals, store_totals
from ..workspace import Workspace
from .numbering import number_rows

SHARDS, ROUNDS = 24, 12
# Groups above this part of a shard may be moved in parts.
_WHOLE = 3


def _quotas(flows: dict[tuple[int, int], float], room: list[int]) -> list[float]:
    """The part of those who want into a shard that may go.

    What a shard takes in must not exceed its room and what leaves it. Parts start
    at one and fall until that holds everywhere; swaps between full shards remain.
    """
    shards = range(len(room))
    asked = [sum(flows.get((i, j), 0.0) for i in shards) for j in shards]
    quota = [1.0] * len(room)
    for _ in range(200):
        leaving = [sum(flows.get((i, j), 0.0) * quota[j] for j in shards) for i in shards]
        quota = [
            min(quota[j], max(0.0, room[j] + leaving[j]) / asked[j]) if asked[j] else 0.0 for j in shards
        ]
    return quota


def _moved(
    linked: DataFrame, share: int, shards: int, salt: int, workspace: Workspace
) -> DataFrame | None:
    """One round: the linked documents with their new shard, or None if none may move."""
    votes = workspace.store(
        linked.groupBy("_group", "shard").agg(F.count("*").alias("votes")), "votes"
    )
    # A group has at most one vote row per shard; it wants the fewest shards that hold it.
    # Ties fall by hash, so that no shard is everyone's choice.
    tie = F.xxhash64("_group", "shard").alias("tie")
    ranked = F.sort_array(F.collect_list(F.struct("votes", tie, "shard")), asc=False)
    wishes = votes.groupBy("_group").agg(ranked.alias("ranked"), F.sum("votes").alias("rows")).select(
        "_group", F.col("rows").alias("size"), "rows", F.transform(
            F.slice("ranked", 1, F.ceil(F.col("rows") / share).cast("int")), lambda v: v["shard"]
        ).alias("wish"),
    )
    stored, sizes = store_totals(wishes, workspace, "wishes")
    # A row per pair of shards comes to the driver, and one per shard.
    wanted = votes.join(stored, "_group").filter(~F.array_contains("wish", F.col("shard")))
    flows = {
        (row.shard, row.to): row.flow
        for row in wanted.withColumn("to", F.explode("wish")).groupBy("shard", "to")
        .agg(F.sum(F.col("votes") / F.size("wish")).alias("flow")).collect()
    }
    filled = dict(votes.groupBy("shard").agg(F.sum("votes")).collect())
    quota = _quotas(flows, [share - filled.get(shard, 0) for shard in range(shards)])
    if not any(quota):
        return None

    wished = attach_totals(linked, stored, ["_group"], ["_row"], sizes[None])
    pick = F.pmod(F.xxhash64("_row", F.lit(-1 - salt)), F.size("wish")).cast("int") + 1
    target = F.element_at("wish", pick)
    # Small groups go whole or not at all, large ones document by document.
    drawn = F.when(
        F.col("size") * _WHOLE <= F.lit(share), F.xxhash64("_group", F.lit(salt))
    ).otherwise(F.xxhash64("_row", F.lit(salt)))
    allowed = F.element_at(F.array(*[F.lit(part) for part in quota]), target + 1)
    goes = ~F.array_contains("wish", F.col("shard")) & (F.pmod(drawn, F.lit(1 << 30)) < allowed * (1 << 30))
    return wished.withColumn(
        "shard", F.when(goes, target).otherwise(F.col("shard"))
    ).select(*linked.columns)


def _propagate(rows: DataFrame, share: int, shards: int, rounds: int, workspace: Workspace) -> DataFrame:
    linked = workspace.store(rows.filter("_linked"), "linked")
    for salt in range(rounds):
        moved = _moved(linked, share, shards, salt, workspace)
        if moved is None:
            break
        linked = workspace.store(moved, "moved")
    return linked


def _levelled(rows: DataFrame, total: int, shards: int, workspace: Workspace) -> DataFrame:
    """Move what a shard holds beyond its even count into the free places of others.

    Places in a shard are numbered with linked documents first, so unlinked ones
    move if any can.
    """
    ordered = rows.withColumn("_cell", F.col("shard") * 2 + F.when(F.col("_linked"), 0).otherwise(1))
    placed = number_rows(ordered, "_cell", ["_row"], "_place")
    counted = rows.groupBy("shard").agg(
        F.count("*").alias("held"), F.count_if(F.col("_linked")).alias("ahead")
    )
    # A row per shard comes to the driver: what it holds and what it should hold.
    held, ahead = {}, {}
    for row in counted.collect():
        held[row.shard], ahead[row.shard] = row.held, row.ahead
    even = [total // shards + (shard < total % shards) for shard in range(shards)]
    spare = [max(held.get(shard, 0) - even[shard], 0) for shard in range(shards)]
    short = [max(even[shard] - held.get(shard, 0), 0) for shard in range(shards)]

    def of_shard(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(value).cast("bigint") for value in values]), F.col("shard") + 1)

    place = F.col("_place") + F.when(F.col("_linked"), 0).otherwise(
        of_shard([ahead.get(shard, 0) for shard in range(shards)])
    )
    # The surplus, counted through all shards, meets the free places in the same order.
    over = F.col("_slot") - of_shard(even)
    turn = F.when(over >= 0, over + of_shard([sum(spare[:shard]) for shard in range(shards)]))
    seats = [
        F.when((F.col("_turn") >= sum(short[:shard])) & (F.col("_turn") < sum(short[:shard + 1])), F.struct(
            F.lit(shard).alias("shard"),
            (F.col("_turn") + (held.get(shard, 0) - sum(short[:shard]))).alias("slot"),
        )) for shard in range(shards) if short[shard]
    ]
    seat = F.coalesce(*seats, F.struct(F.col("shard"), F.col("_slot").alias("slot")))
    return (
        placed.withColumn("_slot", place).withColumn("_turn", turn).withColumn("_seat", seat)
        .select(
            *[c for c in rows.columns if c != "shard"], F.col("_seat.shard").alias("shard"),
            F.col("_seat.slot").cast("bigint").alias("slot"),
        )
    )


def shard_documents(
    docs: DataFrame,
    workspace: Workspace,
    shards: int = SHARDS,
    rounds: int = ROUNDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: id, ``size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes plus 8; ``slot`` numbers a shard's documents
    from 0 without gaps; ``grown_shard`` is null under the law ``rows``.
    """
    body = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = workspace.store(docs.select(
        F.col(id_column).alias("_id"), F.monotonically_increasing_id().alias("_row"),
        F.unhex(F.md5(body)).alias("_group"), (F.octet_length(body).cast("bigint") + 8).alias("_size"),
        F.crc32(body).alias("_crc"),
        F.pmod(F.xxhash64(F.col(id_column)), F.lit(shards)).cast("int").alias("shard"),
    ), "documents")
    groups, sizes = store_totals(
        rows.groupBy("_group").agg(F.count("*").alias("rows")).filter("rows > 1"), workspace, "groups"
    )
    size = sizes[None]
    linked_rows = attach_totals(rows, groups, ["_group"], ["_row"], size).select(*rows.columns)
    alone = rows.join(groups.select("_group"), "_group", "left_anti").select(*rows.columns)
    total = rows.count()
    marked = linked_rows.withColumn("_linked", F.lit(True))
    moved = _propagate(marked, -(-total // shards), shards, rounds, workspace)
    everything = workspace.store(
        moved.select(*marked.columns).union(alone.withColumn("_linked", F.lit(False))), "labelled"
    )
    return _levelled(everything, total, shards, workspace).select(
        F.col("_id").alias(id_column), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
