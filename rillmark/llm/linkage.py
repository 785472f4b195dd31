"""Matching entities of two sources without keys or labels.

A regularised two-component Gaussian mixture over name similarities is fitted by expectation-maximisation on all candidate
pairs. Transitivity is enforced in each E-step: two records of the catalogue with different names cannot both equal one
text, so the match odds of a text's candidate classes compete, o_c / (1 + sum of o). A class holds the records whose names
are the same to the reader; within it a second attribute (the release) decides, or nothing does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.llm.names import STOP, folded, readings, words
from rillmark.operators.skew import hot_keys, salted_join
from rillmark.session import checkpointed

#: per field the edit similarity relative to length, and closeness in edits, 1 at none and 0 from six on
FEATURES = ("artist_edit", "title_edit", "artist_near", "title_near")


@dataclass(frozen=True)
class LinkParams:
    """``ridge``: added to each variance, so that exact agreement does not make the matched component a point. ``rounds``
    and ``tol`` end the fit. ``accept``: least posterior. ``rival``: classes with at least this share of the best
    odds fit the names about as well. ``common_share``/``common_least``: a word in more of the catalogue's names than
    both is common and blocks only together with another (``block_keys`` says what no setting loses); there are at most
    words-per-name/common_share such words. ``hot_share``/``hot_least``: blocks and classes with more rows than both are spread over ``salts`` tasks.
    ``release_sim``: least similarity of release names that decides."""

    ridge: float = 0.01
    rounds: int = 12
    tol: float = 1e-3
    accept: float = 0.5
    rival: float = 0.2
    common_share: float = 0.001
    common_least: int = 20
    hot_share: float = 0.001
    hot_least: int = 20_000
    salts: int = 24
    release_sim: float = 0.8


READ_SCHEMA = "aw array<string>, tw array<string>, kinds string, remixer string, cut boolean, acut boolean, rel string"


def _release(s: str | None) -> str:
    return "".join(words(folded(s)))


def _reader(key: str, whole: bool):
    """Arrow batches (key, a, t, l) -> one row per reading; ``whole`` keeps only the reading as typed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, a, t, rel in zip(b[key], b["a"], b["t"], b["l"]):
                r = _release(rel)
                got = readings(a, t)
                rows += [(k, *x, r) for x in (got[:1] if whole else got)]
            yield pd.DataFrame(rows, columns=[key, "aw", "tw", "kinds", "remixer", "cut", "acut", "rel"])

    return run


def read_names(df: DataFrame, key: str, artist: str, title: str, release: str, whole: bool = False) -> DataFrame:
    """Readings of each record's names: (key, artist string ``ra``, title string ``rt``, words, kinds, cut, release)."""
    d = df.select(F.col(key), F.col(artist).alias("a"), F.col(title).alias("t"), F.col(release).alias("l"))
    kind = d.schema[key].dataType.simpleString()
    r = d.mapInPandas(_reader(key, whole), f"{key} {kind}, {READ_SCHEMA}")
    return r.withColumns({"ra": F.concat_ws("", "aw"), "rt": F.concat_ws("", F.concat_ws("", "tw"), "remixer")})


def common_words(classes: DataFrame, p: LinkParams) -> tuple[list[str], list[str]]:
    """Artist and title words that are in many names; bounded by the share, so they may go to the driver."""
    n = classes.select(F.count(F.lit(1)).alias("n")).scalar()
    w = classes.select(F.explode(F.concat(F.transform(F.array_distinct("aw"), lambda x: F.concat(F.lit("a"), x)), F.transform(F.array_distinct("tw"), lambda x: F.concat(F.lit("t"), x)))).alias("w"))
    big = w.groupBy("w").agg(F.count(F.lit(1)).alias("df")).where((F.col("df") > n * p.common_share) & (F.col("df") > p.common_least))
    got = sorted(r[0] for r in big.select("w").collect())
    return [x[1:] for x in got if x[0] == "a"], [x[1:] for x in got if x[0] == "t"]


def counted(words: str) -> Column:
    """The words that block: distinct, of two letters or more, no stop words."""
    stop = F.array(*[F.lit(x) for x in sorted(STOP)])
    return F.filter(F.array_distinct(words), lambda x: (F.length(x) > 1) & ~F.array_contains(stop, x))


def block_keys(common: tuple[list[str], list[str]]) -> Column:
    """Array of 64-bit block keys of a reading (aw, tw, ra, rt), in which names are looked for together.

    (artist, title word), (title, first or last two letters of the artist), (artist, first or last two letters of the title),
    (artist word, title word) unless both are common, and where all are common (artist word, two title words), or one title
    word if there are no more than two. No pair is lost that shares a counted artist word and at least half of the counted
    title words of the longer title, nor one that shares all of one of artist and title and either end of the other, or the
    artist and one title word: whatever words are common, since of shared title words either one is rare, or two are common,
    or the titles have at most two. Equal hashes of different keys only add pairs.
    """
    aw, tw = counted("aw"), counted("tw")
    ca, ct = (F.array(*[F.lit(x) for x in c]).cast("array<string>") for c in common)
    h = lambda tag, *c: F.xxhash64(F.lit(tag), *c)
    none = F.array().cast("array<bigint>")
    k1 = F.transform(tw, lambda t: h("at", F.col("ra"), t))
    k2 = F.array(h("tf", F.col("rt"), F.substring("ra", 1, 2)), h("tl", F.col("rt"), F.substring("ra", -2, 2)))
    k5 = F.when(F.col("ra") != "", F.array(h("af", F.col("ra"), F.substring("rt", 1, 2)), h("al", F.col("ra"), F.substring("rt", -2, 2)))).otherwise(none)
    rare_a, some_a = F.array_except(aw, ca), F.array_intersect(aw, ca)
    rare_t, some_t = F.array_except(tw, ct), F.array_intersect(tw, ct)
    pair = lambda xs, ys: F.flatten(F.transform(xs, lambda a: F.transform(ys, lambda t: h("ww", a, t))))
    k3 = F.concat(pair(rare_a, tw), pair(some_a, rare_t))
    s = F.array_sort(some_t)
    twos = F.flatten(F.transform(s, lambda x: F.transform(F.filter(s, lambda y: y > x), lambda y: F.concat_ws(" ", x, y))))
    k4 = pair(some_a, twos)
    k6 = F.when(F.size(tw) <= 2, pair(some_a, some_t)).otherwise(none)
    return F.array_distinct(F.concat(k1, k2, k3, k4, k5, k6))


def _edit(a: Column, b: Column) -> Column:
    return F.when((a == "") | (b == ""), 0.0).otherwise(1.0 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def _near(sim: Column, a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0.0), 1.0 - (1.0 - sim) * F.greatest(F.length(a), F.length(b)) / 6.0)


def _upto(cut: str, text: str, other: str) -> Column:
    """A name that was cut short is held against as much of the other."""
    return F.when(F.col(cut), F.substring(F.col(other), F.lit(1), F.length(text))).otherwise(F.col(other))


def candidates(texts: DataFrame, classes: DataFrame, common: tuple[list[str], list[str]], p: LinkParams) -> DataFrame:
    """(tid, cid, features): each text with each name class it meets in a block, best reading, versions being of one kind.

    Another performance, remix or numbered part is another recording: an exact check on the kinds of version marks. Blocks and
    classes that many names meet are spread over several tasks. A text's candidates come out together, sorted by text.
    """
    key = F.transform(block_keys(common), lambda k: F.xxhash64(k, "kinds"))
    a = texts.select("rid", F.explode(key).alias("k"))
    b = checkpointed(classes.select("cid", F.explode(key).alias("k")))
    met = salted_join(a, b, "k", "inner", p.salts, F.col("rid"), hot_keys(b, "k", p.hot_share, p.hot_least)).select("rid", "cid").distinct()
    met = checkpointed(met)
    left = texts.select("rid", "tid", "kinds", "ra", "rt", "cut", "acut")
    right = classes.select("cid", F.col("kinds").alias("ck"), F.col("ra").alias("ca"), F.col("rt").alias("ct"))
    j = salted_join(met, right, "cid", "inner", p.salts, F.col("rid"), hot_keys(met, "cid", p.hot_share, p.hot_least))
    j = j.join(left, "rid").where("kinds = ck")
    j = j.withColumns({"ca": _upto("acut", "ra", "ca"), "ct": _upto("cut", "rt", "ct")})
    j = j.withColumns({"artist_edit": _edit(F.col("ra"), F.col("ca")), "title_edit": _edit(F.col("rt"), F.col("ct"))})
    j = j.withColumns({"artist_near": _near(F.col("artist_edit"), F.col("ra"), F.col("ca")), "title_near": _near(F.col("title_edit"), F.col("rt"), F.col("ct"))})
    best = F.max(F.struct((F.col("artist_edit") + F.col("title_edit")).alias("s"), *FEATURES)).alias("x")
    g = j.select("tid", "cid", *FEATURES).repartition("tid").groupBy("tid", "cid").agg(best)
    return g.select("tid", "cid", *[F.col(f"x.{f}").cast("float").alias(f) for f in FEATURES]).sortWithinPartitions("tid")


@dataclass
class Mixture:
    """Weights, means and covariances of the unmatched (0) and matched (1) component."""

    pi: float
    mu: np.ndarray
    cov: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.log(self.pi / (1 - self.pi))
        ll = []
        for k in (0, 1):
            c = np.linalg.cholesky(self.cov[k])
            z = np.linalg.solve(c, (x - self.mu[k]).T)
            ll.append(-0.5 * (z * z).sum(0) - np.log(np.diag(c)).sum())
        # similarity above a component's mean never speaks against a match
        z1 = np.linalg.solve(np.linalg.cholesky(self.cov[1]), (np.minimum(x, self.mu[1]) - self.mu[1]).T)
        ll[1] = np.maximum(ll[1], -0.5 * (z1 * z1).sum(0) - np.log(np.diag(np.linalg.cholesky(self.cov[1]))).sum())
        return np.clip(out + ll[1] - ll[0], -60, 60)


def posteriors(tid: np.ndarray, log_odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group number, posterior) of rows sorted by text, a text's candidates competing: o_c / (1 + sum o)."""
    group = np.cumsum(np.r_[False, tid[1:] != tid[:-1]]) if len(tid) else np.zeros(0, int)
    o = np.exp(log_odds)
    total = np.bincount(group, o) if len(tid) else np.zeros(0)
    return group, o / (1 + total[group])


def whole_texts(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of rows sorted by ``tid``, cut so that no text spans two; in memory are one batch and one text's candidates."""
    held: list[pd.DataFrame] = []
    for b in it:
        if not len(b):
            continue
        last = b["tid"].to_numpy()
        cut = int(np.searchsorted(last, last[-1]))
        if cut == 0 and held and held[-1]["tid"].iloc[-1] == last[-1]:
            held.append(b)
            continue
        if cut or held:
            yield pd.concat([*held, b.iloc[:cut]], ignore_index=True)
        held = [b.iloc[cut:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def fit(pairs: DataFrame, p: LinkParams) -> Mixture | None:
    """EM over all pairs, in as many rounds as needed; ``pairs`` must hold a text's candidates together, sorted by text. Only sufficient
    statistics (a few dozen numbers a partition) reach the driver. The first round takes each text's best pair for a match. None without pairs."""
    d = len(FEATURES)
    m = None
    schema = "n double, g double, s array<double>"
    for _ in range(p.rounds):
        cur = m

        def e_step(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            n, sums = 0.0, 0.0
            for b in whole_texts(it):
                x = b[list(FEATURES)].to_numpy(np.float64)
                if cur is None:
                    g = _best_of(b["tid"].to_numpy(), x.sum(1))
                else:
                    g = posteriors(b["tid"].to_numpy(), cur.log_odds(x))[1]
                h = 1 - g
                n += len(g)
                sums = sums + np.concatenate([[g.sum()], g @ x, h @ x, ((x * g[:, None]).T @ x).ravel(), ((x * h[:, None]).T @ x).ravel()])
            if n:
                yield pd.DataFrame({"n": [n], "g": [float(sums[0])], "s": [sums[1:]]})

        rows = pairs.mapInPandas(e_step, schema).collect()
        n, g = sum(r.n for r in rows), sum(r.g for r in rows)
        if n == 0:
            return None
        # a component without members keeps the statistics of all pairs
        s = np.sum([r.s for r in sorted(rows, key=lambda r: (r.n, r.g))], axis=0)
        mu, cov = [], []
        for w, o, q in ((n - g, d, 2 * d + d * d), (g, 0, 2 * d)):
            if w < 1e-6:
                w, sm, sq = n, s[:d] + s[d : 2 * d], s[2 * d : 2 * d + d * d] + s[2 * d + d * d :]
            else:
                sm, sq = s[o : o + d], s[q : q + d * d]
            mu.append(sm / w)
            cov.append(sq.reshape(d, d) / w - np.outer(mu[-1], mu[-1]) + np.eye(d) * p.ridge)
        m = Mixture(float(np.clip(g / n, 1e-4, 1 - 1e-4)), np.stack(mu), np.stack(cov))
        if cur is not None and np.abs(m.mu - cur.mu).max() < p.tol and abs(m.pi - cur.pi) < p.tol:
            break
    return m


def _best_of(tid: np.ndarray, value: np.ndarray) -> np.ndarray:
    """1.0 at the first row of greatest value of each text, else 0.0; rows are sorted by text."""
    g = np.zeros(len(tid))
    order = np.lexsort((-value, tid))
    g[order[np.r_[True, tid[order][1:] != tid[order][:-1]]]] = 1.0
    return g


def link(texts: DataFrame, catalogue: DataFrame, p: LinkParams = LinkParams()) -> DataFrame:
    """(text_key, record_key, posterior): the one catalogued record that each text stands for, where there is one.

    ``texts``: (text_key, artist, title, release), ``catalogue``: (record_key, artist, title, release); repeated rows are
    united first and other columns ignored. Null, blank or placeholder names give no match; a null release decides nothing. Equal names of several
    records are settled by the release alone, and stay unmatched if it cannot.
    """
    names = ["artist", "title", "release"]
    # ids are numbers given once and written down, so no two things share one
    cat = checkpointed(read_names(catalogue.select("record_key", *names).distinct(), "record_key", "artist", "title", "release", whole=True))
    classes = checkpointed(cat.groupBy("ra", "rt", "kinds").agg(F.min("aw").alias("aw"), F.min("tw").alias("tw")).withColumn("cid", F.monotonically_increasing_id()))
    common = common_words(classes, p)
    raw = checkpointed(texts.select("text_key", *names).distinct().withColumn("tid", F.monotonically_increasing_id()))
    t = checkpointed(read_names(raw, "tid", "artist", "title", "release").withColumn("rid", F.monotonically_increasing_id()))
    pairs = checkpointed(candidates(t, classes, common, p))
    m = fit(pairs, p)

    def score(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if m is None:
            return
        for b in whole_texts(it):
            lo = m.log_odds(b[list(FEATURES)].to_numpy(np.float64))
            group, g = posteriors(b["tid"].to_numpy(), lo)
            top = np.full(group[-1] + 1, -np.inf)
            np.maximum.at(top, group, lo)
            total = np.bincount(group, np.exp(lo))
            keep = (lo >= top[group] + np.log(p.rival)) & (total[group] / (1 + total[group]) >= p.accept)
            yield pd.DataFrame({"tid": b["tid"][keep], "cid": b["cid"][keep], "posterior": g[keep], "any": (total / (1 + total))[group][keep]})

    fits = pairs.mapInPandas(score, "tid long, cid long, posterior double, any double")
    recs = cat.join(classes.select("cid", "ra", "rt", "kinds"), ["ra", "rt", "kinds"]).select("cid", "record_key", F.col("rel").alias("crel")).distinct()
    fits = fits.join(recs, "cid")
    rel = t.select("tid", F.col("rel").alias("trel")).distinct()
    fits = fits.join(rel, "tid")
    same = F.when((F.col("trel") != "") & (F.col("crel") != ""), _edit(F.col("trel"), F.col("crel"))).otherwise(0.0)
    one = fits.groupBy("tid", "record_key").agg(F.max("posterior").alias("posterior"), F.max("any").alias("any"), F.max(same).alias("rs"))
    # unbounded in no case: these are the records whose names fit one text
    g = one.groupBy("tid").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("rs") >= p.release_sim).alias("hits"),
        F.max(F.struct("rs", "record_key")).alias("best"), F.max("posterior").alias("posterior"), F.max("any").alias("any"),
        F.sort_array(F.collect_list("rs"), asc=False).alias("all_rs"),
    )
    clear = (F.col("n") == 1) | ((F.col("best.rs") >= p.release_sim) & (F.element_at("all_rs", 1) > F.try_element_at("all_rs", F.lit(2)) + 0.05))
    won = g.where(clear).select("tid", F.col("best.record_key").alias("record_key"), F.when(F.col("n") == 1, F.col("posterior")).otherwise(F.col("any")).alias("posterior"))
    j = raw.select("text_key", "tid").join(won, "tid")
    # a key with several texts stands for one record only if they agree
    return j.groupBy("text_key").agg(F.min("record_key").alias("record_key"), F.max("record_key").alias("_m"), F.max("posterior").alias("posterior")).where("record_key = _m").drop("_m")
