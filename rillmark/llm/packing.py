"""Filling fixed-capacity containers by bin completion.

Documents are packed in blocks of bounded size, each by branch-and-bound: a container is opened with the largest document
left, its undominated fillings are enumerated by least waste, and a branch is cut when its waste cannot beat the
incumbent, which best-fit decreasing starts. What the blocks leave in poorly filled containers is packed again in fewer
blocks, until one block is left or nothing changes, so the room lost at block ends does not grow with the data.
"""

from __future__ import annotations

import math
from bisect import bisect_right, insort
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.session import checkpointed


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each size into the fullest container that takes it."""
    rooms: list[tuple[int, int]] = []  # (room, container), sorted
    out: list[list[int]] = []
    for s in sorted(sizes, reverse=True):
        i = bisect_right(rooms, (s - 1, 1 << 60))
        if i < len(rooms):
            room, c = rooms.pop(i)
        else:
            room, c = capacity, len(out)
            out.append([])
        out[c].append(s)
        insort(rooms, (room - s, c))
    return out


@dataclass(frozen=True)
class PackParams:
    """Blocks hold about ``block_items`` items; containers with more than a share ``poor`` of their room free are packed again, in at most
    ``rounds`` rounds (what the blocks' ends lose grows with fewer). Within a block the search tries ``width`` fillings a container,
    those that waste at most ``slack`` more than the best found, looks at ``per_filling`` partial fillings for each, and ends after ``nodes``
    containers, when the incumbent stands. None lifts a limit; with none of ``width``, ``slack``, ``per_filling`` and ``nodes`` the search of a block is exhaustive."""

    block_items: int = 4000
    poor: float = 0.01
    rounds: int | None = 6
    width: int | None = 3
    slack: int | None = 8
    per_filling: int | None = 400
    nodes: int | None = 4000


#: how a block's containers were found: best-fit at the lower bound, the search, best-fit after a whole search, or best-fit after one that was cut short
AT_BOUND, BY_SEARCH, SEARCHED, CUT_SHORT = "bound", "search", "searched", "limit"


def fillings(keys: list[int], count: Counter, gap: int, p: PackParams) -> list[list[int]]:
    """Fillings of ``gap`` from the sizes left (``keys`` ascending), least waste first.

    Only fillings to which nothing can be added are kept, and none in which one member could give way to a larger unused
    size that still fits: such a filling is dominated.
    """
    most, slack = p.width or math.inf, math.inf if p.slack is None else p.slack
    effort = [math.inf if p.per_filling is None else p.per_filling]
    found: list[tuple[int, list[int]]] = []
    best = [gap + 1]

    def dominated(chosen: list[int], waste: int) -> bool:
        used = Counter(chosen)
        for y in used:
            i = bisect_right(keys, y + waste) - 1
            while i >= 0 and keys[i] > y:
                if count[keys[i]] - used[keys[i]] > 0:
                    return True
                i -= 1
        return False

    def go(hi: int, room: int, chosen: list[int]) -> None:
        if effort[0] <= 0 or (found and best[0] == 0 and len(found) >= most):
            return
        effort[0] -= 1
        i = min(hi, bisect_right(keys, room) - 1)
        any_fit = False
        used = Counter(chosen)
        while i >= 0 and effort[0] > 0:
            s = keys[i]
            if count[s] - used[s] > 0:
                any_fit = True
                chosen.append(s)
                go(i, room - s, chosen)
                chosen.pop()
                if best[0] == 0 and len(found) >= most:
                    return
            i -= 1
        if not any_fit and room <= best[0] + slack:
            # maximal in the order taken; a smaller size was tried before, a larger one does not fit
            if not any(count[k] - used[k] > 0 for k in keys[: bisect_right(keys, room)]) and (room == 0 or not dominated(chosen, room)):
                found.append((room, list(chosen)))
                best[0] = min(best[0], room)

    go(len(keys) - 1, gap, [])
    found.sort(key=lambda x: (x[0], len(x[1])))
    return [c for _, c in (found if p.width is None else found[: p.width])]


def complete(sizes: list[int], capacity: int, p: PackParams = PackParams()) -> list[list[int]]:
    """Containers (lists of sizes) for ``sizes``, none above ``capacity``."""
    return search(sizes, capacity, p)[0]


def search(sizes: list[int], capacity: int, p: PackParams = PackParams()) -> tuple[list[list[int]], str]:
    """(containers, how they were found): the best of best-fit and a depth-first bin completion.

    Waste bound: n containers waste n*capacity - sum. A branch whose waste so far exceeds what the incumbent's containers
    less one would allow is cut. The search ends at the lower bound ceil(sum/capacity), at its end, or at its limit.
    """
    total = sum(sizes)
    incumbent = best_fit(sizes, capacity)
    bound = -(-total // capacity)
    if len(incumbent) <= bound:
        return incumbent, AT_BOUND
    how = SEARCHED
    count = Counter(sizes)
    keys = sorted(count)
    trail: list[tuple[list[int], list[list[int]]]] = []  # (container, alternatives left)
    waste, tried, left = 0, 0, total

    def take(c: list[int], sign: int) -> None:
        for s in c:
            count[s] -= sign
            if sign > 0 and count[s] == 0:
                keys.pop(bisect_right(keys, s) - 1)
            elif sign < 0 and count[s] == 1:
                insort(keys, s)

    def options() -> list[list[int]]:
        first = keys[-1]
        take([first], 1)
        got = [[first, *c] for c in fillings(keys, count, capacity - first, p)]
        take([first], -1)
        return got or [[first]]

    while True:
        allowed = (len(incumbent) - 1) * capacity - total
        back = False
        if not keys:
            if len(trail) < len(incumbent):
                incumbent, how = [list(c) for c, _ in trail], BY_SEARCH
                if len(incumbent) <= bound:
                    return incumbent, how
            back = True
        elif p.nodes is not None and tried >= p.nodes:
            return incumbent, how if how == BY_SEARCH else CUT_SHORT
        else:
            tried += 1
            opts = options()
            c = opts.pop(0)
            w = capacity - sum(c)
            # a last container's room is not held against a branch
            if waste + (w if left > sum(c) else 0) <= allowed:
                take(c, 1)
                trail.append((c, opts))
                waste += w
                left -= sum(c)
                continue
            back = True
        while back and trail:
            c, opts = trail.pop()
            take(c, -1)
            waste -= capacity - sum(c)
            left += sum(c)
            while opts:
                n = opts.pop(0)
                if waste + capacity - sum(n) <= allowed:
                    take(n, 1)
                    trail.append((n, opts))
                    waste += capacity - sum(n)
                    left -= sum(n)
                    back = False
                    break
        if back and not trail:
            return incumbent, how


def _pack_block(p: PackParams):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        capacity = int(pdf["capacity"].iloc[0])
        pdf = pdf.sort_values(["size", "item"], ascending=[False, True], kind="stable")
        by: dict[int, list[int]] = {}
        for pos, s in enumerate(pdf["size"]):
            by.setdefault(int(s), []).append(pos)
        slot = [0] * len(pdf)
        sizes = [int(s) for s in pdf["size"] if s > 0]
        done, how = search(sizes, capacity, p)
        taken = dict.fromkeys(by, 0)
        room = [0] * max(1, len(done))
        for c, members in enumerate(done):
            room[c] = capacity - sum(members)
            for s in members:
                slot[by[s][taken[s]]] = c
                taken[s] += 1
        if not done:
            room[0] = capacity
        for pos in by.get(0, []):  # what has no size goes with the first container
            slot[pos] = 0
        return pd.DataFrame({"kind": pdf["kind"], "item": pdf["item"], "size": pdf["size"], "capacity": pdf["capacity"], "note": pdf["note"], "block": pdf["block"], "slot": slot, "room": [room[c] for c in slot], "how": how})

    return run


BLOCK_SCHEMA = "kind string, item string, size long, capacity long, note long, block long, slot long, room long, how string"


def pack(items: DataFrame, p: PackParams = PackParams()) -> DataFrame:
    """(kind, item, size, capacity, note, container, room, how) for ``items`` (kind, item, size, capacity, note), sizes at most the capacity.

    ``item`` is unique within a kind; ``note`` is handed through. Blocks hold about ``block_items`` items, chosen by the item's hash, whatever the
    size of the table or of a kind. After each round the items of containers with more than ``poor`` of their room free
    are packed again, in as many blocks as their number then needs; a round is kept only for those items, the others stay.
    Without a limit of rounds it ends when a round leaves as many items as it was given.
    """
    todo, done, level, block_items = items, [], 0, p.block_items
    while True:
        n = todo.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per kind of container
        if not n:
            break
        blocks = F.create_map(*[F.lit(x) for r in n for x in (r["kind"], max(1, -(-r["n"] // block_items)))])[F.col("kind")]
        # above the hash that drew the last round's blocks, so that leftovers meet new company
        h = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(str(level)), "item"), 256), 1, 8), 16, 10).cast("bigint")
        placed = todo.withColumn("block", F.pmod(h, blocks.cast("bigint")))
        placed = checkpointed(placed.groupBy("kind", "block").applyInPandas(_pack_block(p), BLOCK_SCHEMA))
        most, was = max(-(-r["n"] // block_items) for r in n), sum(r["n"] for r in n)
        named = placed.withColumn("container", F.concat_ws("-", F.col("kind"), F.lit(str(level)), F.col("block").cast("string"), F.col("slot").cast("string")))
        if most <= 1 or (p.rounds is not None and level + 1 >= p.rounds):
            done.append(named)
            break
        bad = F.col("room") > F.col("capacity") * p.poor
        done.append(named.where(~bad))
        todo = placed.where(bad).select("kind", "item", "size", "capacity", "note")
        level += 1
        if p.rounds is None and todo.count() >= was:
            done.append(named.where(bad))
            break
    if not done:
        return items.withColumns({"container": F.lit(None).cast("string"), "room": F.lit(None).cast("long"), "how": F.lit(None).cast("string")})
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("kind", "item", "size", "capacity", "note", "container", "room", "how")


def fill_containers(docs: DataFrame, containers: DataFrame, p: PackParams = PackParams()) -> DataFrame:
    """(container_kind, container_id, doc_id, piece_no, token_from, token_to, room_left, found_by), one row per piece.

    ``docs``: doc_id, n_tokens; ``containers``: container_kind, capacity_tokens, a few rows. Only a document longer than
    the capacity is cut: into full containers of its own and one remainder, which is packed like a document. A document
    without tokens goes, as an empty piece, with another. A repeated id counts once, with its largest count; null ids or counts are
    left out; an empty input gives no rows.
    """
    kinds = [(r[0], int(r[1])) for r in containers.where("container_kind is not null and capacity_tokens > 0").select("container_kind", "capacity_tokens").distinct().collect()]
    kind_of_id = docs.schema["doc_id"].dataType
    d = docs.where("doc_id is not null and n_tokens is not null").groupBy(F.col("doc_id").cast("string").alias("doc")).agg(F.max("n_tokens").cast("long").alias("n_tokens"))
    spec: Column = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).cast("long").alias("capacity")) for k, c in sorted(kinds)])
    if not kinds:
        d = d.limit(0)
        spec = F.array(F.struct(F.lit("").alias("kind"), F.lit(1).cast("long").alias("capacity")))
    d = d.withColumn("s", F.explode(spec)).select("doc", "n_tokens", "s.*")
    d = d.withColumn("full", F.when(F.col("n_tokens") > F.col("capacity"), F.expr("n_tokens div capacity")).otherwise(0).cast("long"))
    d = d.withColumn("rest", F.col("n_tokens") - F.col("full") * F.col("capacity"))
    d = checkpointed(d)
    whole = d.where("full > 0").withColumn("p", F.explode(F.sequence(F.lit(1).cast("long"), F.col("full"))))
    whole = whole.select(
        F.col("kind").alias("container_kind"), F.concat_ws("-", "kind", F.lit("w"), "doc", F.col("p").cast("string")).alias("container_id"), F.col("doc").cast(kind_of_id).alias("doc_id"), F.col("p").alias("piece_no"),
        ((F.col("p") - 1) * F.col("capacity")).alias("token_from"), (F.col("p") * F.col("capacity")).alias("token_to"), F.lit(0).cast("long").alias("room_left"), F.lit("whole").alias("found_by"),
    )
    loose = d.where("rest > 0 or full = 0").select("kind", F.col("doc").alias("item"), F.col("rest").alias("size"), "capacity", F.col("full").alias("note"))
    base = F.col("note") * F.col("capacity")
    rest = pack(loose, p).select(
        F.col("kind").alias("container_kind"), F.col("container").alias("container_id"), F.col("item").cast(kind_of_id).alias("doc_id"), (F.col("note") + 1).alias("piece_no"),
        base.alias("token_from"), (base + F.col("size")).alias("token_to"), F.col("room").alias("room_left"), F.col("how").alias("found_by"),
    )
    return whole.unionByName(rest)
