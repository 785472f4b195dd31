from dataclasses import replace

import numpy as np
import pytest

from rillmark.llm import bigru, langid

TEXTS = {
    "en": "The ledger for spring was written down long before the letters came from the office. Nobody at the desk mentions what the contract says about this. We were still waiting for an answer to the question.",
    "de": "Die Abrechnung für das Frühjahr wurde zurückgehalten wegen der Briefe aus dem Büro. Niemand am Pult erwähnt, was im Vertrag über die Anteile steht. Wir warten noch immer auf eine Antwort auf die Frage.",
    "fr": "Le relevé du printemps a été retenu à cause de ces lettres venues du bureau. Personne ne mentionne jamais ce que le contrat dit des écoutes. Nous attendons toujours une réponse à cette question.",
    "ru": "Отчёт за весну был задержан из-за писем из конторы. Никто за пультом не упоминает, что написано в договоре. Мы всё ещё ждём ответа на этот вопрос.",
}


def test_gradients():
    rng = np.random.default_rng(0)
    net = bigru.BiGRU.new(4, 3, rng)
    for f in ("wg", "wc", "ug", "uc", "wo", "bo"):
        setattr(net, f, getattr(net, f).astype(np.float64))
    old, bigru.F32 = bigru.F32, np.float64
    try:
        x, size = bigru.padded([b"hello there", b"abc", b"zq zq z"])
        y = np.array([0, 2, 1])
        _, grads = net.grads(x, size, y)
        for p, g in zip(net.params(), grads):
            for i in map(tuple, np.argwhere(np.abs(g) > 1e-9)[:: max(1, int((np.abs(g) > 1e-9).sum()) // 4)]):
                keep, e = p[i], 1e-5
                p[i] = keep + e
                up = net.grads(x, size, y)[0]
                p[i] = keep - e
                down = net.grads(x, size, y)[0]
                p[i] = keep
                assert (up - down) / 2 / e == pytest.approx(g[i], rel=1e-4, abs=1e-8)
        a, b = bigru.pooled(net, [b"hello there"]), bigru.pooled(net, [b"abc", b"hello there", b"hello there and on"])
        assert np.allclose(a[0], b[1])
    finally:
        bigru.F32 = old


@pytest.mark.parametrize("label,want", [("EN", "en"), ("en_GB", "en"), ("German", "de"), ("de-AT", "de"), ("dut", "nl"), ("ja-JP", "ja"), ("??", ""), (None, ""), (" ", ""), ("und", ""), ("n/a", ""), ("unknown", ""), ("sv", "sv"), ("Swedish", "swedish")])
def test_labels(label, want):
    assert langid.label_language(label) == want


def test_sentences_and_plain():
    t = "One here. Two! “Three …” (four)\nfive 六七。八"
    assert [t[a:b] for a, b in langid.sentences(t)] == ["One here.", "Two!", "“Three …", "(four)", "five 六七。", "八"]
    assert langid.plain("12:30 +++ 7bc976d7-e7ee-4fac-9c9d-580a92e9fad9 MRH-521030") == ""
    assert langid.plain("<p>Hello «Волна Мира» my dear friend</p>") == "hello my dear friend"
    s = "слово " * 300 + "x" * 5000 + " 名簿の権利者はみな支払いが止まったままだ。 don't, stop"
    assert "".join(langid.units(s)) == s.replace(" ", "") and max(map(len, langid.units(s))) <= langid.LONG
    assert langid.units("名簿の権利者はみな") == ["名簿の", "権利者はみな"] and langid.units("don't, stop") == ["don't,", "stop"] and langid.units("") == []


@pytest.fixture(scope="module")
def model(spark):
    rows, n = [], 0
    for k, t in TEXTS.items():
        s = [x + "." for x in t.split(". ")]
        for i in range(14):
            n += 1
            text = " ".join([*s[i % 3 :], *s[: i % 3]])
            rows.append((n, text, ("en" if k == "de" and i == 0 else k) if i % 5 else f"{k}-XX"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return langid.fit(docs, langid.LangParams(steps=260, more_steps=120))


CASES = [
    ("Nobody mentions the letters. We were waiting for the contract.", [("en")]),
    ("Niemand erwähnt die Briefe aus dem Büro. We were still waiting for an answer. Wir warten noch immer auf die Briefe.", ["de", "en", "de"]),
    ("NOUS ATTENDONS TOUJOURS CES LETTRES VENUES DU BUREAU.\nНикто не упоминает письма из конторы.", ["fr", "ru"]),
    ("### 12:30 2026-06-01 +++", ["und"]), ("", ["und"]), (None, ["und"]), ("—", ["und"]),
    ("7bc976d7-e7ee-4fac-9c9d-580a92e9fad9 We were still waiting for an answer to the question. 6:55", ["en"]),
    ("The contract says what the letters from the office were about. " * 3000, ["en"]),
]


def test_held_out_segments(spark, model):
    docs = spark.createDataFrame([(i, t, "en", i) for i, (t, _) in enumerate(CASES)], "doc_id long, text string, lang string, confidence long")
    out = langid.identify(docs, model).orderBy("doc_id", "seg_no").collect()
    got: dict = {}
    for r in out:
        got.setdefault(r.doc_id, []).append(r)
    for i, (t, want) in enumerate(CASES):
        segs = got[i]
        assert [r.lang for r in segs] == want and [r.seg_no for r in segs] == list(range(1, len(want) + 1))
        assert segs[0].seg_from == 0 and segs[-1].seg_to == len(t or "") and all(a.seg_to == b.seg_from for a, b in zip(segs, segs[1:]))
        assert all(0 <= r.confidence <= 1 for r in segs)


def test_cases_only(spark, model):
    en, de = CASES[0][0], "Niemand erwähnt die Briefe aus dem Büro."
    rows = [(1, en, "en_US"), (2, en, "German"), (3, en, None), (4, en + " " + de, "en"), (5, "+++", "en"), (6, "+++", "und"), (7, None, None), (8, de, "ger"), (8, de, "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted((r.doc_id, r.seg_no, r.lang) for r in langid.identify(docs, model, cases_only=True).collect())
    assert got == [(2, 1, "en"), (3, 1, "en"), (4, 1, "en"), (4, 2, "de"), (5, 1, "und"), (8, 1, "de")]
    assert langid.identify(docs.limit(0), model).count() == 0


def test_fit_without_labels(spark):
    docs = spark.createDataFrame([(1, "text here", None), (2, None, "en")], "doc_id long, text string, lang string")
    m = langid.fit(docs)
    assert langid.identify(docs, m).count() == 2


def test_memory_and_blocks_change_nothing(model):
    texts = [t or "" for t, _ in CASES] + [f"{a} {b}" for a in TEXTS.values() for b in TEXTS.values()]
    want = langid.segments(model, texts)
    small = langid.Memo(replace(model, params=replace(model.params, memo_words=3, memo_chars=10)))
    got = [langid.segments(model, [t], small)[0] for t in texts]
    for x, y in zip(got, want):
        assert [(a[0], *a[2:]) for a in x] == [(a[0], *a[2:]) for a in y] and np.allclose([a[1] for a in x], [a[1] for a in y])


def test_the_shortcut_takes_the_best_path(model):
    """Whole texts in one language skip the path search: its result must be the same."""
    rng = np.random.default_rng(5)
    pool = [s for t in TEXTS.values() for s in t.split(". ")] + ["Ok", "la la", "no", "Niemand", "et"]
    texts = [". ".join(rng.choice(pool, rng.integers(1, 9))) for _ in range(120)]
    memo = langid.Memo(model)
    for t, segs in zip(texts, langid.segments(model, texts, memo)):
        r = memo.rows([t[a:b] for a, b in langid.sentences(t)])
        ev = memo.logp[r[r >= 0]] / model.look
        cost = lambda path: ev[np.arange(len(ev)), path].sum() - model.params.switch * (path[1:] != path[:-1]).sum()
        path = langid._viterbi(ev, model.params.switch)
        runs = [model.langs[k] for k in path[np.r_[True, path[1:] != path[:-1]]]]
        assert [x[0] for x in segs] == runs or cost(np.full(len(ev), model.langs.index(segs[0][0]))) == pytest.approx(cost(path))


def test_confidence_is_calibrated():
    """On fragments of held-out sentences, made-up languages that share many words: confidence and accuracy agree."""
    rng = np.random.default_rng(11)
    syl = [a + b for a in "bdfgklmnprstvz" for b in "aeiou"]
    make = lambda own, n: ["".join(rng.choice(own, rng.integers(1, 4))) for _ in range(n)]
    common = make(syl, 60)
    vocab = [make(syl[i * 10 : i * 10 + 40], 120) + common for i in range(3)]
    sentence = lambda k: " ".join(rng.choice(vocab[k], rng.integers(5, 12)))
    m = langid.fit_sample({c: [sentence(k) for _ in range(300)] for k, c in enumerate(["aa", "bb", "cc"])}, langid.LangParams(steps=150, more_steps=60))
    conf, hit = [], []
    for _ in range(900):
        k = int(rng.integers(3))
        t = " ".join(sentence(k).split()[: rng.integers(1, 7)])
        segs = langid.segments(m, [t])[0]
        if len(segs) == 1 and segs[0][0] != "und":
            conf.append(segs[0][1])
            hit.append(segs[0][0] == ["aa", "bb", "cc"][k])
    conf, hit = np.array(conf), np.array(hit)
    assert len(conf) > 800 and abs(conf.mean() - hit.mean()) < 0.06
    for lo, hi in ((0.3, 0.7), (0.7, 0.95), (0.95, 1.01)):
        b = (conf >= lo) & (conf < hi)
        assert b.sum() < 30 or abs(conf[b].mean() - hit[b].mean()) < 0.12
