"""Mixing sources to target shares of the tokens.

The total is the largest at which no source needs more than ``max_repeats`` uses of a document. A source's budget is
its share of it. Whole passes over the source come first; what is left of the budget is fitted by subset sum over exact token
lengths: documents are counted by length, most of the rest is spread over the lengths in proportion, and a bounded
knapsack closes the remainder to the token where a subset sum exists, on as large a part of the budget as that takes.
Documents of a length are chosen by seeded hash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.functions.keys import stripped
from rillmark.llm.sampling import bottom_k, salted_hash
from rillmark.session import checkpointed

FIT_SCHEMA = "source string, n_tokens long, k long, passes long"


def source_key(c: Column | str) -> Column:
    """A source's name up to letter case, edge blanks and ``-`` for ``_``; blank becomes null."""
    s = F.lower(F.regexp_replace(stripped(c), "-", "_"))
    return F.when(s != "", s)


def knapsack(lengths: list[int], free: list[int], room: int) -> list[int]:
    """How many of each length (at most ``free``) so that their sum is the largest not above ``room``: bounded knapsack on bit sets.

    Each length's number is split into powers of two; one integer holds all reachable sums, bit n for sum n.
    """
    mask = (1 << (room + 1)) - 1
    reach = 1
    steps: list[tuple[int, int, int]] = []  # (index, copies, reachable before)
    for i, (n, f) in enumerate(zip(lengths, free)):
        f = min(f, room // n) if n > 0 else 0
        p = 1
        while f > 0:
            c = min(p, f)
            new = (reach | (reach << (c * n))) & mask
            if new != reach:
                steps.append((i, c, reach))
                reach = new
            f -= c
            p *= 2
        if reach >> room & 1:
            break
    out = [0] * len(lengths)
    s = reach.bit_length() - 1
    for i, c, before in reversed(steps):
        if not before >> s & 1:
            s -= c * lengths[i]
            out[i] += c
    return out


@dataclass(frozen=True)
class FitParams:
    """The programme runs on a rest of ``first_room`` tokens, then on rests ``growth`` times as large, until the budget is met to the
    token or the programme has covered the whole budget, which proves its sum the largest there is. ``most_room``: the
    largest rest it may take (its memory is as many bits, over the lengths' common divisor); None for no limit. Beyond it the best sum so far stands."""

    first_room: int = 20_000
    growth: int = 8
    most_room: int | None = 32_000_000


def fit_lengths(lengths: list[int], counts: list[int], budget: int, repeats: int, p: FitParams = FitParams()) -> tuple[int, list[int]]:
    """(whole passes, further documents per length) for one source: tokens used never exceed ``budget``.

    Most of the rest is taken in proportion to the lengths' counts, then longest first, and the programme closes what is
    left. Where it falls short it is run again on a larger part, at last on all that the passes leave, with nothing taken before it.
    """
    total = sum(n * c for n, c in zip(lengths, counts))
    if total <= 0 or budget <= 0:
        return 0, [0] * len(lengths)
    passes = min(repeats, budget // total)
    rest = budget - passes * total
    best, best_sum = [0] * len(lengths), 0
    if passes >= repeats or rest == 0:
        return passes, best
    unit = math.gcd(*lengths)
    goal = rest // unit * unit
    room = p.first_room
    while best_sum < goal:
        last = room >= rest
        take = _attempt(lengths, counts, total, rest, rest if last else room, unit)
        got = sum(n * t for n, t in zip(lengths, take))
        if got > best_sum:
            best, best_sum = take, got
        if last or (p.most_room is not None and room >= p.most_room * unit):
            break
        room *= p.growth
        if p.most_room is not None:
            room = min(room, p.most_room * unit)
    return passes, best


def _attempt(lengths: list[int], counts: list[int], total: int, rest: int, room: int, unit: int) -> list[int]:
    """Documents per length with the programme on the last ``room`` tokens; on all of them when ``room`` is the rest."""
    take = [0] * len(lengths)
    if room < rest:
        take = [c * (rest - room) // total for c in counts]
        rest -= sum(n * t for n, t in zip(lengths, take))
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            if rest <= room:
                break
            more = min(counts[i] - take[i], (rest - room // 2) // lengths[i])
            if more > 0:
                take[i] += more
                rest -= more * lengths[i]
    free = [c - t for c, t in zip(counts, take)]
    small = [i for i in range(len(lengths)) if lengths[i] <= rest and free[i] > 0]
    for i, k in zip(small, knapsack([lengths[i] // unit for i in small], [free[i] for i in small], rest // unit)):
        take[i] += k
    return take


def budgets(hist: DataFrame, targets: DataFrame) -> dict[str, tuple[int, int]]:
    """source -> (token budget, max repeats). Only sums per source reach the driver. A source without tokens is left out and the shares of the others scaled up."""
    have = {r["source"]: int(r["t"]) for r in hist.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("c")).alias("t")).collect()}
    want = {r["source"]: (float(r["share"]), int(r["m"])) for r in targets.collect()}
    live = {s: v for s, v in want.items() if have.get(s, 0) > 0 and v[0] > 0 and v[1] > 0}
    scale = sum(v[0] for v in live.values())
    if not live:
        return {}
    total = min(have[s] * m / (share / scale) for s, (share, m) in live.items())
    return {s: (min(int(total * share / scale), have[s] * m), m) for s, (share, m) in live.items()}


def mixture(docs: DataFrame, targets: DataFrame, salt: str = "rillmark-mix-1", p: FitParams = FitParams()) -> tuple[DataFrame, DataFrame]:
    """(mix, targets used): mix is (source, doc_id, n_tokens, times) with times >= 1.

    ``docs``: doc_id, source, n_tokens; ``targets``: source, target_share, max_repeats, a few rows. Documents of no target
    source, without tokens, or with a null id do not enter; a repeated id counts once. The choice depends on ids, lengths
    and salt alone. No source ever gets above its budget; what it may miss is said at ``FitParams``.
    """
    t = targets.select(source_key("source").alias("source"), F.col("target_share").alias("share"), F.col("max_repeats").alias("m")).where("source is not null")
    t = checkpointed(t.groupBy("source").agg(F.sum("share").alias("share"), F.max("m").alias("m")))
    wanted = [r["source"] for r in t.collect()]  # a few rows; documents of other sources go no further
    d = docs.select("doc_id", source_key("source").alias("source"), "n_tokens").where("doc_id is not null and n_tokens > 0").where(F.col("source").isin(wanted))
    d = d.groupBy("doc_id").agg(F.min(F.struct("source", "n_tokens")).alias("x")).select("doc_id", "x.*")
    d = checkpointed(d)
    hist = checkpointed(d.groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("c")))
    plan = budgets(hist, t)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("n_tokens")
        source = pdf["source"].iloc[0]
        lengths, counts = [int(x) for x in pdf["n_tokens"]], [int(x) for x in pdf["c"]]
        passes, take = fit_lengths(lengths, counts, *plan[source], p)
        return pd.DataFrame({"source": source, "n_tokens": lengths, "k": take, "passes": passes})

    # a source's distinct lengths, not its documents
    chosen = hist.where(F.col("source").isin(list(plan))).groupBy("source").applyInPandas(fit, FIT_SCHEMA)
    chosen = checkpointed(chosen)
    rows = d.withColumn("h", salted_hash(F.col("doc_id"), salt)).withColumn("doc_key", F.col("doc_id").cast("string"))
    extra = bottom_k(rows, ["source", "n_tokens"], "h", "doc_key", chosen.select("source", "n_tokens", "k"))
    once = extra.select("source", "doc_id", "n_tokens", F.lit(1).cast("long").alias("times"))
    passes = {r["source"]: int(r["passes"]) for r in chosen.select("source", "passes").distinct().collect()}
    full = {s: p for s, p in passes.items() if p > 0}
    if not full:
        return once, t
    times = F.create_map(*[F.lit(x) for kv in full.items() for x in kv])[F.col("source")].cast("long")
    base = d.where(F.col("source").isin(list(full))).select("source", "doc_id", "n_tokens", times.alias("times"))
    both = base.unionByName(once).groupBy("source", "doc_id", "n_tokens").agg(F.sum("times").alias("times"))
    return both, t


def shares(mix: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, tokens, actual_share, documents, max_times) for every target source."""
    g = mix.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("times")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("times").alias("max_times"))
    total = mix.select(F.sum(F.col("n_tokens") * F.col("times")).alias("t")).scalar()
    j = targets.join(g, "source", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return j.select("source", F.col("share").alias("target_share"), zero("tokens").alias("tokens"), F.coalesce(F.col("tokens") / total, F.lit(0.0)).alias("actual_share"), zero("documents").alias("documents"), zero("max_times").alias("max_times"))
