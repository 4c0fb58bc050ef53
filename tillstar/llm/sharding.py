"""Balanced label propagation of linked documents into shards of equal counts.

Documents with equal texts are linked through a hub, their text, so that a group
of n copies has n links and not n * n. Copies are interchangeable, hence rounds
work on (hub, shard, count) rows, at most one per hub and shard.

The copies are dealt in turn over the shards, which fills them evenly and cuts most
links. Then rounds of propagation put that right: each hub wants its copies in the
shard that has most of them. What all hubs ask for is added up per pair of shards, and
the driver, which sees these sums only, grants what keeps the quotas: moves along
rings of full shards, two or more, and moves into room that unlinked rows leave. Every
granted move joins more links than it cuts, so the rounds end: first with moves to
any shard, then to shards with room, until none is granted. Hubs that are still torn
are lifted out and packed whole, if that joins more links; only one that fits no
shard is split, which fills a shard. Hubs of more than a quarter of a shard, which are
fewer than four times the shards, are packed before the rest is dealt.

Documents are placed at the end: linked ones by their rank in the hub, all others
wherever quotas leave room. Quotas are never exceeded, so the counts of the shards
differ by one at most (law ``rows``), even if one group holds a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.tables import buckets_for, running_before, stored

SHARDS = 8


def _bucket(column: Column | str, rows: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets_for(rows)))


def _shard_totals(batches: DataFrame, shards: int) -> list[int]:
    found = dict(batches.groupBy("shard").agg(F.sum("cnt")).collect())
    return [int(found.get(s, 0)) for s in range(shards)]


def _by_shard(values: list[int], shard: str) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]),
                        F.col(shard).cast("int") + 1)


def packed(sizes: list[tuple[int, int]], quotas: list[int], even: bool) -> list[tuple]:
    """Pieces (n, rank, hubs, shard, cnt) of hubs given as (copies, hubs) per size.

    ``hubs`` hubs of ``n`` copies from ``rank`` on have ``cnt`` copies each in the
    shard. With ``even`` the hubs of a size are dealt over all shards that have room
    before the rest goes where most room is.
    """
    room, pieces = list(quotas), []
    for n, hubs in sorted(sizes, reverse=True):
        rank = 0

        def put(s: int, most: int) -> int:
            taken = min(most, room[s] // n)
            if taken:
                pieces.append((n, rank, taken, s, n))
                room[s] -= taken * n
            return taken

        by_room = lambda: sorted(range(len(room)), key=lambda s: (-room[s], s))
        for s in by_room() if even else ():
            rank += put(s, hubs // len(room))
        for s in by_room():
            rank += put(s, hubs - rank)
        while rank < hubs:
            left = n
            while left:
                s = by_room()[0]
                piece = min(left, room[s])
                pieces.append((n, rank, 1, s, piece))
                room[s] -= piece
                left -= piece
            rank += 1
    return pieces


def _links(pieces: list[tuple]) -> int:
    """Twice the links inside shards, and a constant."""
    return sum(hubs * cnt * cnt for _, _, hubs, _, cnt in pieces)


def _best_packing(hubs: DataFrame, room: list[int]) -> list[tuple]:
    """The driver sees the distinct sizes only, fewer than the root of twice the rows."""
    sizes = [(r.n, r.hubs) for r in hubs.groupBy("n").agg(F.count(F.lit(1)).alias("hubs")).collect()]
    return max((packed(sizes, room, even) for even in (True, False)), key=_links)


def _put(hubs: DataFrame, pieces: list[tuple], rows: int) -> DataFrame:
    """(hub, shard, cnt) of ``hubs`` as ``pieces`` says."""
    table = stored(hubs.sparkSession.createDataFrame(
        pieces, "n bigint, low bigint, hubs bigint, shard int, cnt bigint"), "packed")
    ranked = running_before(
        hubs.withColumn("one", F.lit(1)), ["n"], _bucket("hub", rows), ["hub"], "one", "rank")
    return ranked.join(table, "n").filter("rank >= low and rank < low + hubs").select(
        "hub", "shard", "cnt")


def dealt(hubs: DataFrame, room: list[int], rows: int) -> DataFrame:
    """(hub, shard, cnt): the copies in order of their hubs, one by one in turn to each shard.

    A shard that is full takes no more turns; the copies fit in ``room`` together.
    """
    placed = running_before(hubs, [], _bucket("hub", rows), ["hub"], "n", "before")
    found = [F.lit(0).cast("bigint") for _ in room]
    begin = level = 0
    for upto in sorted(set(room) - {0}):
        turns = [s for s, r in enumerate(room) if r >= upto]
        end = begin + (upto - level) * len(turns)
        first = F.greatest(F.col("before"), F.lit(begin)) - begin
        last = F.greatest(first, F.least(F.col("before") + F.col("n"), F.lit(end)) - begin)
        for turn, s in enumerate(turns):
            upto_last, upto_first = (
                F.floor((x + len(turns) - 1 - turn) / len(turns)) for x in (last, first))
            found[s] = found[s] + upto_last - upto_first
        begin, level = end, upto
    return placed.select("hub", F.inline(F.array(*[
        F.struct(F.lit(s).alias("shard"), cnt.alias("cnt")) for s, cnt in enumerate(found)]))
    ).filter("cnt > 0")


def _ring(asked: dict[tuple[int, int], int]) -> list[tuple[int, int]] | None:
    """A closed path of moves that are asked for."""
    onward: dict[int, list[int]] = {}
    for a, b in sorted(asked):
        if asked[a, b]:
            onward.setdefault(a, []).append(b)
    while dead := [(a, b) for a in onward for b in onward[a] if b not in onward]:
        for a, b in dead:
            onward[a].remove(b)
        onward = {a: to for a, to in onward.items() if to}
    if not onward:
        return None
    path = [min(onward)]
    while path.count(path[-1]) == 1:
        path.append(onward[path[-1]][0])
    path = path[path.index(path[-1]):]
    return list(zip(path, path[1:], strict=False))


def exchanged(asked: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How much of each asked (from, to) is granted, so that no shard takes more than its room.

    Rings first, which need no room; what is left has no ring, so room wanders
    against the moves and comes to an end.
    """
    left, room = dict(asked), list(room)
    while ring := _ring(left):
        most = min(left[pair] for pair in ring)
        for pair in ring:
            left[pair] -= most
    while pair := next((p for p in sorted(left) if left[p] and room[p[1]] > 0), None):
        most = min(left[pair], room[pair[1]])
        left[pair] -= most
        room[pair[1]] -= most
        room[pair[0]] += most
    return {pair: asked[pair] - left[pair] for pair in asked if asked[pair] > left[pair]}


def propagate(
    batches: DataFrame, quotas: list[int], rows: int, only_room: bool = False
) -> DataFrame | None:
    """One round of moves towards each hub's favourite shard; None if none is granted."""
    shards = len(quotas)
    room = [q - u for q, u in zip(quotas, _shard_totals(batches, shards), strict=True)]
    turn = F.pmod(F.xxhash64("hub") + F.col("shard"), F.lit(shards))
    may_take = _by_shard([int(r > 0 or not only_room) for r in room], "shard") > 0
    wanted = F.max(F.when(may_take, F.struct("cnt", turn.alias("turn"), "shard")))
    favourite = batches.groupBy("hub").agg(wanted.alias("to"), F.sum("cnt").alias("n"))
    moves = F.col("to").isNotNull() & (F.struct("cnt", turn) < F.struct("to.cnt", "to.turn"))
    joined = stored(batches.join(favourite, "hub").select(
        "hub", "shard", "cnt", "n", F.coalesce(moves, F.lit(False)).alias("moves"),
        F.col("to.shard").alias("to")), "wanted_moves")
    asked = {(r.shard, r.to): r.cnt for r in joined.filter("moves").groupBy("shard", "to").agg(
        F.sum("cnt").alias("cnt")).collect()}
    given = exchanged(asked, room)
    if not given:
        return None
    # Small groups first: they become whole with the least moves.
    order = F.floor(F.log2("n")) * buckets_for(rows) + _bucket("hub", rows)
    queue = running_before(
        joined.filter("moves"), ["shard", "to"], order, ["hub"], "cnt", "before")
    most = F.element_at(
        F.array(*[F.lit(given.get((a, b), 0)).cast("bigint")
                  for a in range(shards) for b in range(shards)]),
        (F.col("shard") * shards + F.col("to")).cast("int") + 1)
    granted = queue.withColumn(
        "granted", F.greatest(F.lit(0), F.least(F.col("cnt"), most - F.col("before"))))
    left = granted.select("hub", "shard", (F.col("cnt") - F.col("granted")).alias("cnt"))
    came = granted.select("hub", F.col("to").alias("shard"), F.col("granted").alias("cnt"))
    return joined.filter(~F.col("moves")).select("hub", "shard", "cnt").unionByName(
        left).unionByName(came).groupBy("hub", "shard").agg(F.sum("cnt").alias("cnt")).filter(
        "cnt > 0")


def gathered(batches: DataFrame, quotas: list[int], rows: int) -> DataFrame:
    """Rounds until no move is granted, then the hubs that are still torn packed."""
    while (moved := propagate(batches, quotas, rows) or propagate(
            batches, quotas, rows, only_room=True)) is not None:
        batches = stored(moved, "batches")
    spread = batches.groupBy("hub").agg(
        F.sum("cnt").alias("n"), F.sum(F.col("cnt") * F.col("cnt")).alias("links"),
        F.count(F.lit(1)).alias("pieces"))
    torn = stored(spread.filter("pieces > 1").drop("pieces"), "torn")
    whole = batches.join(torn.select("hub"), "hub", "left_anti")
    room = [q - u for q, u in zip(quotas, _shard_totals(whole, len(quotas)), strict=True)]
    pieces = _best_packing(torn, room)
    if _links(pieces) <= (torn.agg(F.sum("links")).first()[0] or 0):
        return batches
    return stored(whole.unionByName(_put(torn.select("hub", "n"), pieces, rows)), "batches")


def _assigned(hubs: DataFrame, quotas: list[int], rows: int) -> DataFrame:
    """(hub, shard, cnt) of all linked documents."""
    large = F.col("n") > max(quotas) // 4
    first = stored(_put(
        hubs.filter(large), _best_packing(hubs.filter(large), quotas), rows), "large")
    room = [q - u for q, u in zip(quotas, _shard_totals(first, len(quotas)), strict=True)]
    others = stored(dealt(hubs.filter(~large), room, rows), "batches")
    return first.unionByName(gathered(others, room, rows))


def place(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    ``size`` is the UTF-8 bytes of the text plus 1. ``slot`` counts from 0 without
    gaps in each shard. NULL texts have size 1, the crc32 of an empty text and
    are linked with empty ones. Repeated rows are copies like others; rows equal
    in id and text may trade slots. NULL ids sort first. ``grown_shard`` is NULL
    under this law. An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), F.md5(text).alias("hub"))
    rows = stored(rows, "texts")
    total = rows.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    hubs = stored(
        rows.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "hubs")

    batches = _assigned(hubs, quotas, total)
    used = _shard_totals(batches, shards)

    in_hub = Window.partitionBy("hub").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    pieces = running_before(
        batches.withColumn("low", F.coalesce(F.sum("cnt").over(in_hub), F.lit(0))),
        ["shard"], _bucket("hub", total), ["hub"], "cnt", "slot0")
    pieces = stored(pieces, "pieces")
    marked = stored(rows.join(hubs, "hub", "left"), "marked").withColumn("one", F.lit(1))
    ident = F.struct("doc_id", "hub")
    linked = running_before(
        marked.filter("n is not null"), ["hub"], _bucket(ident, total), ["doc_id"], "one", "rank"
    ).join(pieces, "hub").filter("rank >= low and rank < low + cnt").withColumn(
        "slot", F.col("slot0") + F.col("rank") - F.col("low"))
    free = running_before(
        marked.filter("n is null"), [], _bucket(ident, total), ["doc_id", "hub"], "one", "rank")
    bounds = [0]
    for q, u in zip(quotas, used, strict=True):
        bounds.append(bounds[-1] + q - u)
    shard = F.lit(shards - 1)
    for s in range(shards - 2, -1, -1):
        shard = F.when(F.col("rank") < bounds[s + 1], s).otherwise(shard)
    free = free.withColumn("shard", shard).withColumn(
        "slot", F.col("rank") - _by_shard(bounds[:-1], "shard") + _by_shard(used, "shard"))
    columns = [
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard")]
    return linked.select(*columns).unionByName(free.select(*columns))
