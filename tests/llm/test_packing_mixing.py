import random

import pytest
from pyspark.sql import functions as F

from rillmark.llm import mixing, packing


def least(sizes, capacity):
    """Fewest containers by trying them all."""
    sizes = sorted(sizes, reverse=True)
    best = [len(sizes)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i] and rooms[k] not in rooms[:k]:
                go(i + 1, rooms[:k] + [rooms[k] - sizes[i]] + rooms[k + 1 :])
        go(i + 1, rooms + [capacity - sizes[i]])

    go(0, [])
    return best[0] if sizes else 0


def test_bin_completion_against_exhaustive_search():
    rng = random.Random(6)
    worse = 0
    for _ in range(60):
        cap = rng.choice([20, 50, 100])
        s = [rng.randrange(1, cap + 1) for _ in range(rng.randrange(0, 10))]
        got = packing.complete(s, cap)
        assert sorted(x for c in got for x in c) == sorted(s) and all(sum(c) <= cap for c in got)
        worse += len(got) != least(s, cap)
    assert worse == 0


def test_search_without_limits_is_exhaustive():
    rng = random.Random(16)
    none = packing.PackParams(width=None, slack=None, per_filling=None, nodes=None)
    better = 0
    for _ in range(60):
        s = [rng.randrange(12, 60) for _ in range(rng.randrange(8, 13))]
        got, how = packing.search(s, 100, none)
        assert len(got) == least(s, 100) and how != packing.CUT_SHORT
        better += how == packing.BY_SEARCH
    assert better > 0
    hard = [rng.randrange(20, 50) * 2 for _ in range(200)]
    assert packing.search(hard, 101, packing.PackParams(nodes=5))[1] in (packing.CUT_SHORT, packing.BY_SEARCH, packing.AT_BOUND)


def test_bin_completion_beats_best_fit():
    s = [6, 6, 4, 4, 4, 4, 2, 2, 2, 2, 7, 3]  # leaves nothing free in containers of 10 or so
    assert len(packing.complete(s, 10)) <= len(packing.best_fit(s, 10))
    assert len(packing.complete([51, 27, 26, 23, 25, 24, 24, 50, 50], 100)) == 3


def test_fill_containers(spark):
    rng = random.Random(9)
    docs = [(i, rng.choice([0, 1, 5, 40, 90, 130, 250]) + rng.randrange(3) * 7) for i in range(900)] + [(5000, 10_000), (5001, None), (None, 4)]
    df = spark.createDataFrame(docs + docs[:5], "doc_id long, n_tokens long")
    kinds = spark.createDataFrame([("s", 100), ("l", 1000), ("bad", 0), (None, 7)], "container_kind string, capacity_tokens long")
    out = packing.fill_containers(df, kinds, p=packing.PackParams(block_items=100)).collect()
    want = {d: n for d, n in docs if d is not None and n is not None}
    for kind, cap in (("s", 100), ("l", 1000)):
        own = [r for r in out if r.container_kind == kind]
        fill: dict = {}
        by_doc: dict = {}
        for r in own:
            fill[r.container_id] = fill.get(r.container_id, 0) + r.token_to - r.token_from
            by_doc.setdefault(r.doc_id, []).append((r.piece_no, r.token_from, r.token_to))
        assert set(by_doc) == set(want)
        for d, p in by_doc.items():
            p.sort()
            assert p[0][1] == 0 and p[-1][2] == want[d] and all(a[2] == b[1] for a, b in zip(p, p[1:]))
            assert len(p) == max(1, -(-want[d] // cap))  # cut only when longer than the capacity
        assert all(0 <= f <= cap for f in fill.values()) and all(r.room_left == cap - fill[r.container_id] for r in own)
        whole = sum(n // cap for n in want.values() if n > cap)
        rest = [n % cap if n > cap else n for n in want.values()]
        at_once = len(packing.best_fit([n for n in rest if n], cap))
        assert len(fill) <= whole + at_once * 1.03 + 1  # in blocks as small as 100 items
    again = {tuple(r) for r in packing.fill_containers(df.repartition(7), kinds, p=packing.PackParams(block_items=100)).collect()}
    assert again == {tuple(r) for r in out}


def test_fill_nothing(spark):
    docs = spark.createDataFrame([(1, 0)], "doc_id long, n_tokens long")
    kinds = spark.createDataFrame([("s", 10)], "container_kind string, capacity_tokens long")
    assert [(r.doc_id, r.room_left) for r in packing.fill_containers(docs, kinds).collect()] == [(1, 10)]
    assert packing.fill_containers(docs.limit(0), kinds).count() == 0 and packing.fill_containers(docs, kinds.limit(0)).count() == 0


def test_knapsack_against_all_subsets():
    rng = random.Random(4)
    for _ in range(80):
        n = rng.randrange(1, 5)
        ls, free, room = [rng.randrange(1, 15) for _ in range(n)], [rng.randrange(0, 4) for _ in range(n)], rng.randrange(0, 60)
        sums = {0}
        for x, f in zip(ls, free):
            sums = {s + x * k for s in sums for k in range(f + 1)}
        k = mixing.knapsack(ls, free, room)
        assert all(0 <= a <= b for a, b in zip(k, free)) and sum(a * b for a, b in zip(k, ls)) == max(s for s in sums if s <= room)


def test_fit_lengths_hits_the_budget():
    rng = random.Random(5)
    for _ in range(30):
        ls = sorted(rng.sample(range(1, 400), 40))
        cs = [rng.randrange(1, 200) for _ in ls]
        total, m = sum(a * b for a, b in zip(ls, cs)), rng.randrange(1, 4)
        budget = rng.randrange(1, total * m)
        passes, take = mixing.fit_lengths(ls, cs, budget, m)
        used = passes * total + sum(a * b for a, b in zip(ls, take))
        assert used <= budget and all(0 <= t <= c for t, c in zip(take, cs)) and passes + (1 if any(take) else 0) <= m
        assert budget - used < max(ls)


def best_sum(ls, cs, room):
    sums = 1
    for n, c in zip(ls, cs):
        for _ in range(c):
            sums |= sums << n
    return (sums & ((1 << (room + 1)) - 1)).bit_length() - 1


def test_few_long_lengths_are_fitted_exactly():
    """What was taken before the programme is given back where that fits better."""
    rng = random.Random(21)
    for _ in range(60):
        ls = sorted(rng.sample(range(700, 9000), rng.randrange(3, 9)))
        cs = [rng.randrange(1, 12) for _ in ls]
        total = sum(a * b for a, b in zip(ls, cs))
        budget = rng.randrange(1, total)
        _, take = mixing.fit_lengths(ls, cs, budget, 1)
        assert all(0 <= t <= c for t, c in zip(take, cs)) and sum(a * b for a, b in zip(ls, take)) == best_sum(ls, cs, budget)
    assert sum(a * b for a, b in zip([3167, 7206, 8404, 8504], mixing.fit_lengths([3167, 7206, 8404, 8504], [4, 11, 3, 9], 107_195, 1)[1])) == 107_174


def test_common_divisor_and_limit():
    p = mixing.FitParams(first_room=100, growth=2, most_room=400)
    _, take = mixing.fit_lengths([600, 1000, 1400], [500, 500, 500], 333_333, 1, p)
    assert sum(a * b for a, b in zip([600, 1000, 1400], take)) == 333_200  # the largest multiple of 200
    _, take = mixing.fit_lengths([7919, 104_729], [3, 3], 200_000, 1, mixing.FitParams(first_room=10, growth=2, most_room=20))
    assert sum(a * b for a, b in zip([7919, 104_729], take)) <= 200_000


def test_mixture(spark):
    rng = random.Random(2)
    docs = [(i, rng.choice(["A", "a ", "b-c", "B_C", "d", None, "other"]), rng.randrange(0, 300)) for i in range(4000)] + [(None, "a", 5)]
    df = spark.createDataFrame(docs + docs[:9], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b_c", 0.25, 2), ("D", 0.25, 3), ("empty", 0.0, 1)], "source string, target_share double, max_repeats long")
    mix, used = mixing.mixture(df, targets)
    rows = {(r.doc_id): r for r in mix.collect()}
    assert len(rows) == mix.count()
    cap = {"a": 1, "b_c": 2, "d": 3}
    assert all(1 <= r.times <= cap[r.source] for r in rows.values())
    sh = {r.source: r for r in mixing.shares(mix, used).collect()}
    for s, want in (("a", 0.5), ("b_c", 0.25), ("d", 0.25)):
        assert sh[s].actual_share == pytest.approx(want, abs=0.001)
    assert sh["empty"].tokens == 0
    total = sum(sh[s].tokens for s in cap)
    have = {"a": 0, "b_c": 0, "d": 0}
    for i, s, n in docs:
        k = (s or "").strip().lower().replace("-", "_")
        if k in have and i is not None:
            have[k] += n
    assert total >= min(have["a"] / 0.5, 2 * have["b_c"] / 0.25, 3 * have["d"] / 0.25) * 0.999
    again = {r.doc_id: r.times for r in mixing.mixture(df.repartition(5), targets)[0].collect()}
    assert again == {k: r.times for k, r in rows.items()}


def test_mixture_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats long")
    mix, used = mixing.mixture(df, targets)
    assert mix.count() == 0 and mixing.shares(mix, used).first().tokens == 0
    mix, _ = mixing.mixture(spark.createDataFrame([(1, "a", 7)], df.schema), targets.limit(0))
    assert mix.count() == 0


def test_hot_length_is_split(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit(10).cast("long").alias("n_tokens"))
    two = df.unionByName(spark.createDataFrame([(9999, "b", 1000)], "doc_id long, source string, n_tokens long"))
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats long")
    mix, _ = mixing.mixture(two, targets)
    assert mix.where("source = 'a'").count() == 100
