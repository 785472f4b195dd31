import random

import pytest

from rillmark.llm import linkage, names

T = "text_key string, artist string, title string, release string"
C = "record_key string, artist string, title string, release string"


@pytest.mark.parametrize("artist,title,want", [
    ("The Tosu Band", "05. Matam Tunnel (feat. X Y) [Explicit]", (["tosu", "band"], ["matam", "tunnel"], "", "")),
    ("Band, Tosu", "Matam Tunnel - Remastered 2008", (["tosu", "band"], ["matam", "tunnel"], "", "")),
    ("VA", "Tosu Band - 11 Matam Tunnel", (["tosu", "band"], ["matam", "tunnel"], "", "")),
    ("ツタ・ムラ", "Song, Pt. II", (["tsuta", "mura"], ["song"], "part2", "")),
    ("조나 비라", "Song (Live)", (["jona", "bira"], ["song"], "live", "")),
    ("Τονδε Ζαλου", "Song (Nova Remix)", (["tonde", "zalu"], ["song"], "remix", "nova")),
    ("GilrÃ¥d &amp; Co", "Engine o/t Dawn", (["gilrad", "and", "co"], ["engine", "of", "the", "dawn"], "", "")),
])
def test_readings(artist, title, want):
    assert want in [x[:4] for x in names.readings(artist, title)]


@pytest.mark.parametrize("a,t", [(None, None), ("", "x"), ("x", " "), ("!!!", "???"), ("n/a", "Track 03"), ("VA", "no dash here")])
def test_nameless_texts_have_no_reading(a, t):
    assert not names.readings(a, t)


def world(seed=4, n=300):
    rng = random.Random(seed)
    syl = ["ka", "lo", "mi", "ren", "tas", "vor", "del", "pu", "sha", "gri", "bel", "nom"]
    word = lambda k=3: "".join(rng.choice(syl) for _ in range(k)).capitalize()
    cat = [(f"r{i}", f"{word()} {word()}", f"{word(2)} {word()} {word(2)}", f"{word()} {word()}") for i in range(n)]
    texts, truth = [], {}

    def typo(s):
        i = rng.randrange(1, len(s) - 1)
        return rng.choice([s[:i] + s[i + 1 :], s[:i] + rng.choice("aeiou") + s[i:], s[: i - 1] + s[i] + s[i - 1] + s[i + 1 :]])

    for i, (r, a, t, rel) in enumerate(cat[: n * 2 // 3]):
        forms = [(a, t), (a.upper(), t.lower()), (typo(a), t), (a, typo(t)), (typo(a), typo(t)), ("VA", f"{a} - {t}"), (t, a), (a, f"0{i % 9}. {t} [Explicit]")]
        for k, (x, y) in enumerate(forms):
            texts.append((f"t{i}-{k}", x, y, rng.choice([None, rel, "Best of Things"])))
            truth[f"t{i}-{k}"] = r
    for i in range(150):
        texts.append((f"none{i}", f"{word()} {word()}", f"{word(2)} {word()} {word(2)}", None))
    a, t = cat[0][1], cat[0][2]
    cat += [("live", a, f"{t} (Live)", "Live at"), ("twin1", "Ota Mura", "Same Song Here", "Red Album"), ("twin2", "Ota Mura", "Same Song Here", "Blue Album")]
    texts += [("l1", a, f"{t} (live)", None), ("l2", cat[5][1], f"{cat[5][2]} (Live)", None), ("w1", "Ota Mura", "Same Song Here", "blue album"), ("w2", "Ota Mura", "Same Song Here", None), ("w3", "Ota Mura", "Same Song Here", "Green Album"), ("n1", None, None, None), ("n2", "", "x", None)]
    truth |= {"l1": "live", "w1": "twin2"}
    return cat, texts, truth


def test_links_of_a_made_world(spark):
    cat, texts, truth = world()
    c = spark.createDataFrame(cat + cat[:20], C).repartition(3)
    t = spark.createDataFrame(texts + texts[:50], T)
    got = {r.text_key: r for r in linkage.link(t, c).collect()}
    hits = sum(got[k].record_key == v for k, v in truth.items() if k in got)
    assert hits / len(truth) > 0.97 and hits / len(got) > 0.98
    assert "l2" not in got and "w2" not in got and "w3" not in got and "n1" not in got and "n2" not in got
    assert got["l1"].record_key == "live" and got["w1"].record_key == "twin2"
    assert all(0.5 <= r.posterior <= 1 for r in got.values())
    again = {r.text_key: r.record_key for r in linkage.link(t.repartition(5), c).collect()}
    assert again == {k: r.record_key for k, r in got.items()}


def test_empty_tables(spark):
    c, t = spark.createDataFrame([("r", "A B", "C D", None)], C), spark.createDataFrame([("t", "A B", "C D", None)], T)
    assert linkage.link(t.limit(0), c).count() == 0 and linkage.link(t, c.limit(0)).count() == 0
    assert [r.record_key for r in linkage.link(t, c).collect()] in (["r"], [])


def test_clashing_extra_columns(spark):
    cat, texts, _ = world(7, 60)
    c = spark.createDataFrame([(*x, 1, "z") for x in cat], C + ", cid int, rid string")
    t = spark.createDataFrame([(*x, 2.0, "y") for x in texts], T + ", tid double, posterior string")
    a = {tuple(r)[:2] for r in linkage.link(t, c).collect()}
    b = {tuple(r)[:2] for r in linkage.link(t.drop("tid", "posterior"), c.drop("cid", "rid")).collect()}
    assert a == b and a
