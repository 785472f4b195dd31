"""The language of each document and of each stretch of another language within it, whatever its label says.

A bidirectional GRU reads the bytes of each word and labels every position; the positions of a sentence, and of a segment of
sentences, pool their log-probabilities. Reading word by word makes a word's labels the same wherever it stands, so each
distinct word is read once a task and the cost grows with the vocabulary, not with the text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.functions.keys import hash32
from rillmark.llm.bigru import BiGRU, pooled, train

# Usual codes and names of the languages that get a two-letter code here.
NAMES = {
    "en": "en eng english englisch anglais inglés inglês inglese engels",
    "de": "de deu ger german deutsch allemand alemán alemão tedesco duits",
    "fr": "fr fra fre french français francais französisch francés francês francese frans",
    "es": "es spa spanish español espanol castellano espagnol spanisch espanhol spagnolo spaans",
    "pt": "pt por portuguese português portugues portugais portugiesisch portugués portoghese portugees",
    "it": "it ita italian italiano italienisch italien italiaans",
    "nl": "nl nld dut dutch nederlands niederländisch néerlandais holandés flemish vlaams",
    "ru": "ru rus russian русский russisch russe ruso russo",
    "ja": "ja jpn jp japanese 日本語 japanisch japonais japonés japonês giapponese japans",
}
CODE = {name: code for code, names in NAMES.items() for name in names.split()}
NO_LANGUAGE = {"", "und", "undetermined", "unknown", "n/a", "na", "none", "null", "nan", "zxx", "mul", "mis", "xx", "xxx", "other", "mixed", "multiple", "various", "?", "??"}


def label_language(label: str | None) -> str:
    """The language that a label names: a two-letter code where known, else the name itself, '' for none."""
    s = (label or "").strip().lower()
    if s in NO_LANGUAGE:
        return ""
    if s in CODE:
        return CODE[s]
    base = re.split(r"[\s_\-(,;/.]", s)[0]
    if base in CODE:
        return CODE[base]
    return base if base not in NO_LANGUAGE and len(base) > 1 and base.isalpha() else ""


TAG = re.compile(r"</?[A-Za-z][^<>]{0,60}>")
IDS = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|\b[A-Za-z]{2,5}-\d+\b|https?://\S+|\d[\d.,:/\-]*")
QUOTED = re.compile(r"“[^“”.!?。\n]{1,90}”|„[^„“.!?。\n]{1,90}“|«[^«».!?。\n]{1,90}»|「[^「」.!?。\n]{1,90}」|‘[^‘’.!?。\n]{1,90}’")
ENDS = re.compile(r"[.!?…][\"”»’'\)\]」]*\s+|[。！？][」』）\)]*|\n+")
LETTERS = re.compile(r"[^\W\d_]")
TWO_LETTERS = re.compile(r"[^\W\d_].*?[^\W\d_]", re.S)
#: letters of other scripts than Latin, and Latin words
OTHER = re.compile("[\u0370-\u03ff\u0400-\u04ff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]+")
LATIN = re.compile("[A-Za-z\u00c0-\u024f]+(?:['’&.\\- ]+[A-Za-z\u00c0-\u024f]+)*")
DIGIT = re.compile(r"\d")
#: letters of scripts written without blanks between words, and their units: what leads up to a run of hiragana, with the run
UNSPACED = re.compile("[\u3040-\u30ff\u3400-\u9fff\u0e00-\u0e7f]")
UNIT = re.compile("[^ぁ-ゖ]{0,12}[ぁ-ゖ]{1,12}|[^ぁ-ゖ]{1,12}")
LONG = 24


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of the sentences: text up to an end mark and blank, a CJK full stop, or a line end."""
    out, a = [], 0
    for m in ENDS.finditer(text):
        i, j = m.span()
        i += text[i] != "\n"
        if i > a:
            out.append((a, i))
        a = j
    if a < len(text):
        out.append((a, len(text)))
    return out


def plain(sentence: str) -> str:
    """What of a sentence tells its language: lower case, without tags, ids, numbers, quoted titles and names in a script that is not the sentence's own (the one of most bytes); '' when no word is left."""
    s = TAG.sub(" ", sentence) if "<" in sentence else sentence
    if DIGIT.search(s) or "://" in s:
        s = IDS.sub(" ", s)
    if not s.isascii():  # quotes that are told from apostrophes are not ASCII, nor is a second script
        bare = QUOTED.sub(" ", s)
        if bare is not s and len(LETTERS.findall(bare)) >= 8:
            s = bare
        if other := OTHER.findall(s):
            latin = LATIN.findall(s)
            own = LATIN.sub(" ", s) if 3 * sum(map(len, other)) > 2 * sum(map(len, latin)) else OTHER.sub(" ", s)
            if len(LETTERS.findall(own)) >= 8:
                s = own
    s = " ".join(s.lower().split()).strip(" -#+*>•—–;:,.!?…()[]\"'")
    return s if TWO_LETTERS.search(s) else ""


def units(s: str) -> list[str]:
    """The words of a sentence, which together hold all its bytes but blanks; a run without blanks is cut into units and a very long word into parts."""
    ws = s.split()
    mixed = not s.isascii() and UNSPACED.search(s)
    if not mixed and max(map(len, ws), default=0) <= LONG:
        return ws
    out = []
    for w in ws:
        if mixed and UNSPACED.search(w):
            out += UNIT.findall(w)
        else:
            out += [w[i : i + LONG] for i in range(0, len(w), LONG)]
    return out


def bare(s: str) -> str:
    """Latin letters without their marks; other scripts unchanged."""
    return "".join(unicodedata.normalize("NFD", ch)[0] if ch < "ɐ" else ch for ch in s)


@dataclass(frozen=True)
class LangParams:
    """The sample that the network is fitted on: ``docs_per_label`` documents per named language, of each the first
    ``sentences_per_doc`` sentences of at least ``least_chars``, of a sentence ``most_chars``; in all ``sentences_per_label``.
    A share ``held_out`` of the sentences fits ``Identifier.look`` alone. ``steps`` of training on ``batch`` words (of longer ones ``window`` bytes) each, then
    ``more_steps`` without the sentences that contradict their label. ``switch``: log-cost of a change of language between
    sentences. ``memo_words``, ``memo_chars``: words and sentences whose scores a task remembers; no result depends on them."""

    docs_per_label: int = 160
    sentences_per_doc: int = 40
    least_chars: int = 12
    most_chars: int = 400
    sentences_per_label: int = 1200
    held_out: float = 0.15
    steps: int = 260
    more_steps: int = 160
    batch: int = 384
    window: int = 16
    hidden: int = 24
    switch: float = 4.0
    seed: int = 7
    memo_words: int = 400_000
    memo_chars: int = 32_000_000


@dataclass
class Identifier:
    """``look``: positions that count as one independent look; evidence is the sum of the positions' log-probabilities over it."""

    langs: list[str]
    net: BiGRU
    params: LangParams
    look: float = 8.0


def training_sentences(docs: DataFrame, p: LangParams) -> DataFrame | None:
    """(code, h, s): the sample's documents, their language by label and sentences; None when no label names a language.

    A count of the labels (no text is read for it) sets the salted id hash below which about twice the bound of documents lie,
    alike on every run and layout; their sentences are cut where they are read.
    """
    known = F.create_map(*[F.lit(x) for kv in sorted(CODE.items()) for x in kv])
    label = F.lower(F.trim("lang"))
    code = F.coalesce(F.try_element_at(known, label), F.try_element_at(known, F.element_at(F.split(label, r"[\s_\-(,;/.]"), 1)))
    d = docs.where("lang is not null and text is not null").select("doc_id", "text", code.alias("code")).where("code is not null")
    counts = {r["code"]: r["n"] for r in d.groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per language of the table above
    if not counts:
        return None
    h = hash32(F.concat_ws("|", F.lit(f"langid-{p.seed}"), F.col("doc_id").cast("string")))
    limit = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(min(1.0, (2.0 * p.docs_per_label + 20) / n) * (1 << 32)))])

    def cut(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            rows = []
            for c, k, text in zip(b["code"], b["h"], b["text"]):
                got = [s[: p.most_chars] for x, y in sentences(text) if len(s := plain(text[x:y])) >= p.least_chars]
                rows.append((c, k, got[: p.sentences_per_doc]))
            yield pd.DataFrame(rows, columns=["code", "h", "s"])

    return d.withColumn("h", h).where(F.col("h") < limit[F.col("code")]).mapInPandas(cut, "code string, h long, s array<string>")


def sample_of(rows: Iterable[tuple[str, int, list[str]]], p: LangParams) -> dict[str, list[str]]:
    """Per language the sentences of its documents with the smallest hashes, within the bounds."""
    out: dict[str, list[str]] = {}
    by: dict[str, list] = {}
    for c, h, s in rows:
        by.setdefault(c, []).append((h, list(s)))
    for c in sorted(by):
        if got := [s for _, ss in sorted(by[c])[: p.docs_per_label] for s in ss][: p.sentences_per_label]:
            out[c] = got
    return out


def fit(docs: DataFrame, p: LangParams = LangParams()) -> Identifier:
    """The network trained on the labelled sample, in one task (the sample is bounded); only its weights reach the driver.

    A language without a usable label cannot be learned; with no label at all every text is called English.
    """
    none = Identifier(["en"], BiGRU.new(p.hidden, 1, np.random.default_rng(p.seed)), p)
    sample = training_sentences(docs, p)
    if sample is None:
        return none

    def run(g: pd.DataFrame) -> pd.DataFrame:
        m = fit_sample(sample_of(zip(g["code"], g["h"], g["s"]), p), p)
        if m is None:
            return pd.DataFrame({"langs": [], "look": [], "w": []})
        return pd.DataFrame({"langs": [m.langs], "look": [m.look], "w": [[x.ravel().astype(np.float64) for x in m.net.params()]]})

    got = sample.groupBy(F.lit(1).alias("all")).applyInPandas(run, "langs array<string>, look double, w array<array<double>>").collect()
    if not got:
        return none
    like = BiGRU.new(p.hidden, len(got[0].langs), np.random.default_rng(0)).params()
    net = BiGRU(*[np.array(w, np.float32).reshape(x.shape) for w, x in zip(got[0].w, like)])
    return Identifier(list(got[0].langs), net, p, got[0].look)


def fit_sample(sample: dict[str, list[str]], p: LangParams) -> Identifier | None:
    """Train on (language -> sentences). Labels are often wrong: after a first pass the sentences that the network gives to another
    language are dropped, and training goes on with the rest."""
    langs = sorted(sample)
    if not langs:
        return None
    every = max(2, round(1 / p.held_out))
    kept, held = [], []
    for k, c in enumerate(langs):
        for i, s in enumerate(sample[c]):
            (held if len(sample[c]) >= every and i % every == every - 1 else kept).append((s, k))

    def train_on(pairs: list[tuple[str, int]], steps: int, rate: float, seed: int, net: BiGRU | None = None) -> BiGRU:
        words, y = [], []
        for s, k in pairs:
            # also as typed without marks on its letters
            for v in (s, bare(s)) if not s.isascii() else (s,):
                ws = [w.encode("utf-8", "ignore") for w in units(v)]
                words += ws
                y += [k] * len(ws)
        return train(words, np.array(y), len(langs), p.hidden, steps, batch=p.batch, window=p.window, rate=rate, seed=seed, net=net)

    net = train_on(kept, p.steps, 0.02, p.seed)
    if len(langs) > 1:
        m = Memo(Identifier(langs, net, p))
        r = m.rows([s for s, _ in kept])
        good = [x for x, i, t in zip(kept, r, m.logp[r].argmax(1)) if i >= 0 and x[1] == t]
        if len({k for _, k in good}) == len(langs):
            kept = good
        net = train_on(kept, p.more_steps, 0.012, p.seed + 1, net)
    model = Identifier(langs, net, p)
    return replace(model, look=fit_look(model, held)) if len(langs) > 1 and held else model


def fit_look(model: Identifier, held: list[tuple[str, int]]) -> float:
    """The look under which held-out sentences, whole and cut to their first words, are likeliest; a share of wrong labels is fitted with it and dropped."""
    items, y = [], []
    for s, k in held:
        ws = s.split()
        for n in (1, 2, 4, len(ws)):
            items.append(" ".join(ws[:n]))
            y.append(k)
    m = Memo(model)
    r = m.rows(items)
    ok = r >= 0
    evidence, y = m.logp[r[ok]], np.array(y)[ok]
    if not len(y):
        return model.look
    best = (-np.inf, model.look)
    for look in 2.0 ** np.arange(0, 6.01, 0.25):
        q = np.exp(evidence / look - (evidence / look).max(1, keepdims=True))
        q = (q / q.sum(1, keepdims=True))[np.arange(len(y)), y]
        for wrong in (0.002, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3):
            best = max(best, (float(np.log((1 - wrong) * q + wrong / len(model.langs)).sum()), float(look)))
    return best[1]


class Memo:
    """Scores of the sentences and words that a task has met: a word is read by the network once, not once per use.

    A word's positions are labelled within the word, so their log-probabilities are the same wherever it stands, and a sentence's
    score is a sum of rows. Both tables are bounded and begun anew when full.
    """

    def __init__(self, model: Identifier):
        self.model = model
        self.clear()

    def clear(self) -> None:
        k = len(self.model.langs)
        self.word_at: dict[str, int] = {}
        self.word_logp = np.zeros((1024, k))
        self.at: dict[str, int] = {}
        self.logp = np.zeros((1024, k))
        self.n = self.chars = 0

    def rows(self, raws: list[str]) -> np.ndarray:
        """The rows of ``logp`` that hold the sentences, -1 for one without words. May begin anew, so one block's rows are used before the next call."""
        p = self.model.params
        if len(self.word_at) > p.memo_words or self.chars > p.memo_chars:
            self.clear()
        new, n = [], 0
        for r in raws:
            if r not in self.at:
                self.at[r] = -1
                new.append(r)
                n += len(r)
                if n > 1_000_000:
                    self._learn(new)
                    new, n = [], 0
        self._learn(new)
        return np.fromiter(map(self.at.__getitem__, raws), np.int64, len(raws))

    def _learn(self, new: list[str]) -> None:
        told = [(r, u) for r in new if (u := units(plain(r)))]
        self.chars += sum(map(len, new))
        if not told:
            return
        flat = [w for _, u in told for w in u]
        fresh = [w for w in dict.fromkeys(flat) if w not in self.word_at]
        if fresh:
            a = len(self.word_at)
            self.word_logp = _room(self.word_logp, a + len(fresh))
            raw = [w.encode("utf-8", "ignore") for w in fresh]
            self.word_logp[a : a + len(raw)] = pooled(self.model.net, raw)
            self.word_at.update(zip(fresh, range(a, a + len(raw))))
        ids = np.fromiter(map(self.word_at.__getitem__, flat), np.int64, len(flat))
        first = np.cumsum([0, *[len(u) for _, u in told[:-1]]])
        a, b = self.n, self.n + len(told)
        self.logp = _room(self.logp, b)
        self.logp[a:b] = np.add.reduceat(self.word_logp[ids], first)
        self.at.update(zip([r for r, _ in told], range(a, b)))
        self.n = b


def _room(x: np.ndarray, n: int) -> np.ndarray:
    if n <= len(x):
        return x
    return np.concatenate([x, np.zeros((max(n, 2 * len(x)) - len(x), *x.shape[1:]), x.dtype)])


def _viterbi(score: np.ndarray, switch: float) -> np.ndarray:
    n, k = score.shape
    best = score[0].copy()
    back = np.zeros((n, k), int)
    for i in range(1, n):
        top = int(best.argmax())
        stay = best >= best[top] - switch
        back[i] = np.where(stay, np.arange(k), top)
        best = np.where(stay, best, best[top] - switch) + score[i]
    path = np.zeros(n, int)
    path[-1] = int(best.argmax())
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i][path[i]]
    return path


def _softmax(x: np.ndarray) -> np.ndarray:
    q = np.exp(x - x.max(-1, keepdims=True))
    return q / q.sum(-1, keepdims=True)


def segments(model: Identifier, texts: list[str], memo: Memo | None = None) -> list[list[tuple[str, float, int, int]]]:
    """Per text its segments (lang, confidence, start, end), end exclusive, covering the text; one ``und`` segment when no sentence has words.

    Confidence is the language's share of the evidence pooled over the segment's sentences, a probability whose look is
    fitted on held-out sentences.
    """
    memo = memo or Memo(model)
    switch = model.params.switch
    spans = [sentences(t) for t in texts]
    rows = memo.rows([t[a:b] for t, sp in zip(texts, spans) for a, b in sp])
    doc = np.repeat(np.arange(len(texts)), [len(sp) for sp in spans])
    end = np.array([b for sp in spans for _, b in sp], np.int64)
    told = rows >= 0
    rows, doc, end = rows[told], doc[told], end[told]
    ev = memo.logp[rows] / model.look
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, int)
    out: list[list[tuple[str, float, int, int]]] = [[("und", 0.0, 0, len(t))] for t in texts]
    if not len(doc):
        return out
    total = np.add.reduceat(ev, first)
    top = total.argmax(1)
    # no other path gains more than each sentence's lead over the best single language, and it pays for a switch
    n_of = np.diff(np.r_[first, len(doc)])
    lead = np.add.reduceat(ev.max(1) - ev[np.arange(len(ev)), np.repeat(top, n_of)], first)
    prob = _softmax(total)
    for k, d in enumerate(doc[first]):
        if lead[k] <= switch:
            out[d] = [(model.langs[top[k]], float(prob[k, top[k]]), 0, len(texts[d]))]
            continue
        a, b = first[k], first[k] + n_of[k]
        path = _viterbi(ev[a:b], switch)
        cuts = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
        q = _softmax(np.add.reduceat(ev[a:b], cuts))
        edges = [0, *[int(x) for x in end[a:b][cuts[1:] - 1]], len(texts[d])]
        out[d] = [(model.langs[path[c]], float(q[i, path[c]]), edges[i], edges[i + 1]) for i, c in enumerate(cuts)]
    return out


def is_case(segs: list[tuple[str, float, int, int]], named: str) -> bool:
    """Whether the label fails the document: missing, wrong, or one for several languages; for ``und`` only if it names a language."""
    first = segs[0][0]
    return named != "" if first == "und" else len(segs) > 1 or named != first


def identify(docs: DataFrame, model: Identifier, cases_only: bool = False, block_chars: int = 1_000_000) -> DataFrame:
    """(doc_id, seg_no, lang, confidence, seg_from, seg_to, label_lang) for every document, without a shuffle.

    ``docs``: doc_id, text, lang; ``cases_only`` keeps the documents whose label fails them. A null text counts as empty;
    empty texts, and texts of ids, numbers and symbols alone, are one ``und`` segment. Whole texts are read. ``label_lang``
    is the language the label names, '' for none. A repeated doc_id is labelled row by row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = Memo(model)
        for b in batches:
            ids, texts, labs = list(b["doc_id"]), [t if isinstance(t, str) else "" for t in b["text"]], list(b["lang"])
            i = 0
            while i < len(ids):
                j, n = i, 0
                while j < len(ids) and (j == i or n + len(texts[j]) <= block_chars):
                    n += len(texts[j])
                    j += 1
                rows = []
                for d, lab, segs in zip(ids[i:j], labs[i:j], segments(model, texts[i:j], memo)):
                    named = label_language(lab if isinstance(lab, str) else None)
                    if not cases_only or is_case(segs, named):
                        rows += [(d, k, lang, conf, s, e, named) for k, (lang, conf, s, e) in enumerate(segs, 1)]
                yield pd.DataFrame(rows, columns=["doc_id", "seg_no", "lang", "confidence", "seg_from", "seg_to", "label_lang"])
                i = j

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "lang").mapInPandas(run, f"doc_id {kind}, seg_no long, lang string, confidence double, seg_from long, seg_to long, label_lang string")
