import datetime as dt
import random

from rillmark.operators import intervals

D0 = dt.date(2026, 1, 1)
SCHEMA = "rec string, st string, a date, b date, extra string"


def day(n):
    return D0 + dt.timedelta(days=n)


def brute(rows):
    """Counts the sets on each day, one day after another."""
    out = set()
    for rec in {r[0] for r in rows if r[0] is not None}:
        own = [(i, a, b) for k, i, a, b in rows if k == rec and i is not None and a is not None and b is not None and a < b]
        if not own:
            continue
        lo, hi = min(a for _, a, _ in own), max(b for _, _, b in own)
        levels = [(n, len({i for i, a, b in own if a <= n < b})) for n in range(lo, hi)]
        for kind, inside in (("period", lambda c: c >= 1), ("overlap", lambda c: c >= 2), ("gap", lambda c: c == 0)):
            start = None
            for n, c in [*levels, (hi, None)]:
                now = c is not None and inside(c)
                if now and start is None:
                    start = n
                if not now and start is not None:
                    out.add((kind, rec, start, n))
                    start = None
    return out


def run(spark, rows):
    data = [(k, i, None if a is None else day(a), None if b is None else day(b), "x") for k, i, a, b in rows]
    got = intervals.sweep(spark.createDataFrame(data, SCHEMA), "rec", "st", "a", "b").collect()
    return {(r[0], r[1], (r[2] - D0).days, (r[3] - D0).days) for r in got}, len(got)


def test_against_day_by_day_count(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(400):
        a = rng.randrange(60)
        rows.append((f"r{rng.randrange(12)}", f"s{rng.randrange(5)}", a, a + rng.randrange(-2, 12)))
    rows += rows[:50]
    got, n = run(spark, rows)
    assert got == brute(rows) and n == len(got)


def test_nested_touching_repeated_and_null(spark):
    rows = [("r", "s", 0, 10), ("r", "t", 2, 4), ("r", "u", 10, 12), ("r", "u", 10, 12), ("r", "v", 20, 21), (None, "s", 0, 5), ("r", None, 0, 50), ("r", "w", None, 9), ("r", "w", 9, 9), ("r", "w", 9, 3)]
    got, _ = run(spark, rows)
    assert got == {("period", "r", 0, 12), ("period", "r", 20, 21), ("overlap", "r", 2, 4), ("gap", "r", 12, 20)}


def test_one_set_in_two_intervals_is_no_overlap(spark):
    got, _ = run(spark, [("r", "s", 0, 5), ("r", "s", 3, 9)])
    assert got == {("period", "r", 0, 9)}


def test_empty(spark):
    assert run(spark, [])[0] == set()


def test_open_end(spark):
    df = spark.createDataFrame([("r", "s", D0, dt.date(9999, 12, 31), None)], SCHEMA)
    assert intervals.sweep(df, "rec", "st", "a", "b", ("period", "gap")).count() == 1
