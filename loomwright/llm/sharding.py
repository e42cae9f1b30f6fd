"""Balanced label propagation: linked documents move to shards under quotas; DataFrame functions only.

Documents that share a group are linked. Every linked document starts in a shard by the least hash of its groups; what is
over a quota there goes, in the order of those hashes, to the shards with room, so no shard is ever over its quota and few
groups are torn. In each round, groups count their members by shard (a pre-aggregated table of at most ``shards`` rows for
each group), and every document adds up its groups' counts and wants the shard with most of its neighbours. Of all who
want to move from one shard to another, so many may as room and counter-moves allow: room is used first, then moves go
around cycles of shards, so that shards that are full swap. Rounds end when none may move or when neighbours agree no more
than before. Documents without links then fill what the quotas leave, so the shards' row counts differ by one at most
(law ``rows``).

No group is collected: counts are partial aggregates, joins are equi-joins that AQE may split, ranks are
taken in hash buckets or ranges. The driver sees only a count for each two shards. Each round's table is written to the
shared folder. Null ids and texts are allowed (null text is linked like an empty one); very long texts are only measured and
hashed; repeated rows are documents of their own with equal texts. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.operators.windows import place_in_order

from .common import salted_rank, written


def quotas(n: int, shards: int) -> list[int]:
    return [n // shards + (s < n % shards) for s in range(shards)]


def _by_shard(df: DataFrame, shards: int) -> list[int]:
    counts = {r["shard"]: r["n"] for r in df.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    return [counts.get(s, 0) for s in range(shards)]


def _literal(values: list[int], key) -> F.Column:
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), key + 1)


def _filled(room: list[int], rank) -> F.Column:
    """The shard of the row of a rank, if shards with room are filled one after the other."""
    upto, places = [], 0
    for r in room:
        places += r
        upto.append(places)
    return F.size(F.filter(F.array(*[F.lit(u).cast("long") for u in upto]), lambda u: u <= rank)).cast("int")


def _within(state: DataFrame, quota: list[int]) -> DataFrame:
    """``state`` (row, near, shard) with what a shard holds over its quota moved to the shards with room. Rows leave and arrive in the
    order of ``near``, so that only the groups at the edges are torn."""
    load = _by_shard(state, len(quota))
    if all(x <= q for q, x in zip(quota, load)):
        return state.select("row", "shard")
    ranked = written(place_in_order(state, ["near", "row"], "rank", ("shard",)), "ranked")
    stays = F.col("rank") <= _literal(quota, F.col("shard"))
    excess = place_in_order(ranked.where(~stays).select("near", "row"), ["near", "row"], "rank")
    room = [max(0, q - x) for q, x in zip(quota, load)]
    return written(ranked.where(stays).select("row", "shard").unionByName(excess.select("row", _filled(room, F.col("rank") - 1).alias("shard"))), "shards")


def flows(wants: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many of the rows that want to move from one shard to another may, so that no shard takes in more than leave it and its
    room: first into room (and what that frees), then around cycles, a swap being the shortest."""
    left, room, out = {k: n for k, n in wants.items() if n}, list(room), {}

    def move(s: int, t: int, n: int) -> None:
        out[s, t] = out.get((s, t), 0) + n
        left[s, t] -= n
        if not left[s, t]:
            del left[s, t]

    while open_ := [(s, t) for s, t in sorted(left) if room[t]]:
        s, t = open_[0]
        n = min(left[s, t], room[t])
        move(s, t, n)
        room[t] -= n
        room[s] += n
    while cycle := _cycle(left):
        n = min(left[e] for e in cycle)
        for s, t in cycle:
            move(s, t, n)
    return out


def _cycle(edges: dict[tuple[int, int], int]) -> list[tuple[int, int]] | None:
    """A shortest cycle of some edge, if there is one."""
    for s, t in sorted(edges):
        came, queue = {t: None}, [t]
        for at in queue:
            for a, b in sorted(edges):
                if a == at and b not in came:
                    came[b] = a
                    queue.append(b)
        if s in came:
            path, at = [(s, t)], s
            while at != t:
                path.append((came[at], at))
                at = came[at]
            return path
    return None


def propagate(members: DataFrame, n: int, shards: int) -> DataFrame:
    """(row, shard) of all linked rows. ``members``: (row, group), a stored table."""
    quota = quotas(n, shards)
    state = written(members.groupBy("row").agg(F.min(F.xxhash64("group")).alias("near")).withColumn("shard", F.pmod("near", F.lit(shards)).cast("int")), "shards")
    state, best, held = _within(state, quota), -1, None
    while True:
        here = members.join(state, "row")
        # Stored: a join whose two sides are read as they are can be split where a group is hot.
        votes = written(here.groupBy("group", "shard").agg(F.count("*").alias("votes")), "votes")
        aims = votes.withColumnRenamed("shard", "aim")
        # Ties are settled by a hash that the members of a group share, so that they agree on one aim.
        scored = here.join(aims, "group").groupBy("row", "shard", "aim").agg(F.sum("votes").alias("votes"), F.max(F.xxhash64("group", "aim")).alias("tie"))
        top = scored.groupBy("row", "shard").agg(F.max(F.struct("votes", "tie", "aim")).alias("top"), F.sum(F.when(F.col("aim") == F.col("shard"), F.col("votes"))).alias("own"))
        wants = written(top.select("row", "shard", F.col("top.aim").alias("aim"), "own"), "wants")
        seen = wants.groupBy("shard", "aim").agg(F.count("*").alias("n"), F.sum("own").alias("own")).collect()  # a row for each two shards
        agreed = sum(r["own"] for r in seen)
        if agreed <= best:
            return held
        best, held = agreed, state
        load = [sum(r["n"] for r in seen if r["shard"] == s) for s in range(shards)]
        moves = flows({(r["shard"], r["aim"]): r["n"] for r in seen if r["shard"] != r["aim"]}, [q - x for q, x in zip(quota, load)])
        if not moves:
            return held
        movers = wants.where("aim <> shard").select("row", "shard", "aim")
        ranked = salted_rank(movers, ["shard", "aim"], ["row"], sum(moves.values()))
        allowed = _literal([moves.get((s, t), 0) for s in range(shards) for t in range(shards)], F.col("shard") * shards + F.col("aim"))
        moved = F.when(F.col("rank") < allowed, F.col("aim")).otherwise(F.col("shard"))
        state = written(wants.where("aim = shard").select("row", "shard").unionByName(ranked.select("row", moved.cast("int").alias("shard"))), "shards")


def shard_documents(df: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each document: its size, shard and slot; documents of equal text are linked."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    base = df.select(F.col(id_column).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("_h"))
    # Stored, so that a row's number stays what it is.
    base = written(base.withColumn("row", F.monotonically_increasing_id()), "rows")
    n = base.count()
    group = F.struct("size", "text_crc32", "_h")
    linked = written(base.groupBy("size", "text_crc32", "_h").agg(F.count("*").alias("copies")).where("copies > 1").select("size", "text_crc32", "_h"), "linked")
    members = written(base.join(linked, ["size", "text_crc32", "_h"]).select("row", group.alias("group")), "members")
    placed = propagate(members, n, shards)
    free = [q - x for q, x in zip(quotas(n, shards), _by_shard(placed, shards))]
    assert min(free) >= 0, "a shard is over its quota"
    single = base.join(placed, "row", "left_anti")
    single = salted_rank(single.withColumn("_all", F.lit(0)), ["_all"], ["row"], max(sum(free), 1))
    shard = _filled(free, F.col("rank"))
    done = base.join(placed, "row").select("row", "doc_id", "size", "text_crc32", "shard").unionByName(single.select("row", "doc_id", "size", "text_crc32", shard.alias("shard")))
    ranked = salted_rank(written(done, "placed"), ["shard"], ["row"], max(n, 1), name="slot")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
