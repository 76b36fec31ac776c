"""Languages of documents and of their segments, whatever the stored label says."""
from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .mail import body_of, paragraphs

#: Labelled documents, and full sentences of theirs, that the word scores are fitted on, at most.
FIT_DOCS, FIT_SENTENCES = 3_000, 60_000
#: Cost of a change of language between two words, in nats, and of a word against the best language at most.
SWITCH, FLOOR = 5.0, -5.0
MIN_WORDS, MIN_SENTENCES = 3, 2

# Frequent function words of each language; hi also in Latin letters.
SEEDS = {
    "en": "the of and to is was that for with not you this on are have has be will from which who please an been by we our your it they",
    "de": "der die das und ist nicht mit für auf ein eine dem den wir sie ich von zu hat wurde auch noch bitte ihre mein meine uns wer vor seit obwohl",
    "fr": "le la les des et est une pour dans pas que qui nous vous avec sur du au je il a été votre notre mon cette en par depuis afin avant",
    "es": "el los las la en y es una para con no por que del se su al como nos está ha más mi usted pero antes desde esta esto favor aunque ya te si lo",
    "pt": "o os as e é uma para com não por que do da no na se seu ao nos está foi mais minha você antes desde esta embora já até",
    "it": "il lo gli e è una per con non di che del della nel si suo al ci ha sono più mia questo prima dalla anche perché già",
    "nl": "de het een en is niet met voor op dat van wij we ik zijn heeft nog wordt mijn naar om ons maar sinds aan hoewel te kan",
    "hi": "है के में की को से का और ने पर नहीं यह हम कि भी hai ke mein ki ko se ka aur ne par nahi yeh hum bhi kripya hain tha liye",
}
LANGS = list(SEEDS)
K = len(LANGS)

_WORD = re.compile(r"[^\W\d_]+(?:[ऀ-ॣ॰-ॿ̀-ͯ]+[^\W\d_]*)*")
_SENT = re.compile(r"(?<=[.!?।])[\"')\]]*\s+")
_END = re.compile(r"[.!?।][\"')\]»]*$")
_NOT_TEXT = re.compile(r"^(?:[\w .-]{1,24}:\s|[-=_*#+|]{3,})")


def fold(word: str) -> str:
    """Lower case; Latin letters without accents, so that stripped and decomposed writings meet."""
    if word.isascii():
        return word.lower()
    if "ऀ" <= word[0] <= "ॿ":
        return word
    w = unicodedata.normalize("NFKD", word.lower().replace("ß", "ss"))
    return "".join(c for c in w if not unicodedata.combining(c))


def split_text(text: str | None) -> list[list[tuple[int, bool, list[str]]]]:
    """Paragraphs of sentences (ordinal, is a full sentence, folded words) of a raw mail."""
    out, k = [], 0
    for par in paragraphs(body_of(text)):
        par = par.replace("​", "").replace("­", "").replace("﻿", "")
        sents = []
        for s in _SENT.split(par):
            words = [fold(w) for w in _WORD.findall(s)]
            if not words:
                continue
            full = bool(_END.search(s)) and len(words) >= MIN_WORDS
            sents.append((k, full, words))
            k += 1
        if sents:
            out.append(sents)
    return out


def fit_words(rows: list[tuple[str, str | None]]) -> dict[str, np.ndarray]:
    """Scores of words per language, log-likelihoods against the best language, from (folded words of a full sentence, language of the
    document's stored label or None). All words of the rows get scores.

    Labels may be wrong: sentences are first labelled by seed words, with the document's label as one vote, then scores and labels are
    refined in turn. Without rows the seeds alone give the scores."""
    seeds: dict[str, list[int]] = defaultdict(list)
    for i, l in enumerate(LANGS):
        for w in SEEDS[l].split():
            seeds[fold(w)].append(i)
    prior: dict[str, np.ndarray] = {}
    for w, ls in seeds.items():
        v = np.full(K, -1.5)
        v[ls] = 0.0
        prior[w] = v
    scores = dict(prior)
    sents = [(LANGS.index(label) if label in LANGS else -1, words.split(" ")) for words, label in rows]
    for turn in range(3):
        counts = [Counter() for _ in LANGS]
        docs: Counter = Counter()
        for vote, words in sents:
            total = np.zeros(K)
            for w in words:
                v = scores.get(w)
                if v is not None:
                    total += v
            if vote >= 0:
                total[vote] += 3.0 if turn == 0 else 2.0
            a = np.partition(total, K - 2)
            if a[-1] - a[-2] < (1.0 if turn == 0 else 2.0):
                continue
            counts[int(total.argmax())].update(words)
            docs.update(set(words))
        if not sents or not docs:
            break
        totals = [sum(c.values()) + 1.0 for c in counts]
        new: dict[str, np.ndarray] = {}
        size = len(docs) + 1
        for w in docs:
            v = np.array([math.log((counts[i][w] + 0.02) / (totals[i] + 0.02 * size)) for i in range(K)])
            n = sum(c[w] for c in counts)
            # a word met rarely, such as a name, says little, and a seed what it said before
            sure = min(1.0, n / 12.0)
            new[w] = np.maximum((v - v.max()) * sure, FLOOR)
            if w in prior:
                new[w] += prior[w] * (1.0 - sure)
        scores = prior | new
    return scores


def viterbi(score: np.ndarray, lengths: list[int]) -> np.ndarray:
    """Labels of words, paragraph by paragraph: score is words x languages, rows of the paragraphs one behind the other. A change of
    language costs SWITCH. Paragraphs of like length go through together."""
    labels = np.zeros(len(score), np.int8)
    lens = np.array(lengths)
    starts = np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64)
    order = np.argsort(-lens, kind="stable")
    for a in range(0, len(order), 1024):
        part = order[a : a + 1024]
        n, T = lens[part], int(lens[part[0]])
        s = starts[part]
        m = len(part)
        v = np.zeros((m, K), np.float32)
        came = np.zeros((T, m), np.int8)
        stay = np.zeros((T, m, K), bool)
        for t in range(T):
            live = int(np.searchsorted(-n, -t, side="left"))  # paragraphs longer than t come first
            cur = v[:live]
            best = cur.argmax(1)
            jump = cur[np.arange(live), best] - SWITCH
            keep = cur >= jump[:, None]
            came[t, :live] = best
            stay[t, :live] = keep
            v[:live] = np.where(keep, cur, jump[:, None]) + score[s[:live] + t]
        at = v.argmax(1)
        for t in range(T - 1, -1, -1):
            live = int(np.searchsorted(-n, -t, side="left"))
            labels[s[:live] + t] = at[:live]
            at[:live] = np.where(stay[t, np.arange(live), at[:live]], at[:live], came[t, :live])
    return labels


def _label(scores: dict[str, np.ndarray], segments: bool):
    index = {w: i + 2 for i, w in enumerate(scores)}
    matrix = np.zeros((len(scores) + 2, K), np.float32)
    for w, i in index.items():
        matrix[i] = scores[w]
    matrix[1] = -8.0  # Devanagari: only hi writes it
    matrix[1, LANGS.index("hi")] = 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = index.get
        for whole in batches:
            for a in range(0, whole.num_rows, 512):
                batch = whole.slice(a, 512)
                ids = batch.column(0).to_pylist()
                wid: list[int] = []
                lengths: list[int] = []
                sent: list[tuple[int, int, bool, int, int]] = []  # document row, ordinal, full, start, end
                for r, text in enumerate(batch.column(1).to_pylist()):
                    for par in split_text(text):
                        p0 = len(wid)
                        for k, full, words in par:
                            w0 = len(wid)
                            wid.extend([get(w) or (1 if "ऀ" <= w[0] <= "ॿ" else 0) for w in words])
                            sent.append((r, k, full, w0, len(wid)))
                        lengths.append(len(wid) - p0)
                if sent:
                    score = matrix[np.array(wid, np.int32)]
                    label = viterbi(score, lengths)
                    starts = np.array([x[3] for x in sent])
                    sums = np.add.reduceat(score, starts, axis=0)
                    counts = np.add.reduceat(np.eye(K, dtype=np.float32)[label] * (np.abs(score).sum(1) > 0)[:, None], starts, axis=0)
                    known = counts.sum(1)
                    best = (counts + sums * 1e-4).argmax(1)
                    z = sums - sums.max(1, keepdims=True)
                    p = np.exp(z[np.arange(len(sent)), best]) / np.exp(z).sum(1)
                out: list[tuple] = []
                if segments:
                    run_: list | None = None
                    for i, (r, k, full, w0, w1) in enumerate(sent):
                        if known[i] == 0:
                            continue
                        l, n = LANGS[best[i]], w1 - w0
                        if run_ and run_[0] == r and run_[3] == l:
                            run_[2] = k
                            run_[4] += n
                            run_[5] += float(p[i]) * n
                        else:
                            if run_:
                                out.append((ids[run_[0]], run_[1], run_[2], run_[3], run_[4], run_[5] / run_[4]))
                            run_ = [r, k, k, l, n, float(p[i]) * n]
                    if run_:
                        out.append((ids[run_[0]], run_[1], run_[2], run_[3], run_[4], run_[5] / run_[4]))
                    yield _rows(out, SEG)
                else:
                    total: dict[tuple[int, int], list[float]] = {}
                    for i, (r, k, full, w0, w1) in enumerate(sent):
                        if full and known[i] >= 2 and p[i] >= 0.5:
                            t = total.setdefault((r, int(best[i])), [0, 0.0])
                            t[0] += 1
                            t[1] += float(p[i])
                    for (r, l), (n, c) in total.items():
                        out.append((ids[r], LANGS[l], int(n), c / n))
                    yield _rows(out, DOC)

    return run


SENTENCE = pa.schema([("doc_id", pa.int64()), ("k", pa.int64()), ("words", pa.string()), ("label", pa.string())])
DOC = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("sentences", pa.int64()), ("confidence", pa.float64())])
SEG = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("lang", pa.string()), ("words", pa.int64()), ("confidence", pa.float64())])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(cols, schema)], schema=schema)


def _sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, k, words, label): the full sentences of whole texts, words folded and joined by spaces."""
    for batch in batches:
        rows = [
            (doc, k, " ".join(words), label) for doc, text, label in zip(*(c.to_pylist() for c in batch.columns)) for par in split_text(text) for k, full, words in par if full
        ]
        yield _rows(rows, SENTENCE)


def _fitted(docs: DataFrame, codes: DataFrame) -> dict[str, np.ndarray]:
    """Word scores from at most FIT_SENTENCES full sentences of at most FIT_DOCS labelled documents. Documents are chosen by a hash of
    their ids, which reads ids and labels only; their whole texts are taken apart in tasks, and sentences are chosen by a hash too."""
    known = codes.where("lang is not null").select("label", F.col("lang").alias("_lang")).distinct()
    chosen = (
        docs.select("doc_id", "lang").join(F.broadcast(known), F.col("lang") == F.col("label"))
        .select("doc_id", "_lang").orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_DOCS)
    )
    rows = docs.select("doc_id", F.col("text").alias("_text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "_text", "_lang")
    sents = rows.mapInArrow(_sentences, "doc_id bigint, k bigint, words string, label string").orderBy(F.xxhash64("doc_id", "k"), "doc_id", "k", "words").limit(FIT_SENTENCES)
    return fit_words(sorted(((r["words"], r["label"]) for r in sents.collect()), key=str))


def detect(docs: DataFrame, codes: DataFrame) -> DataFrame:
    """(doc_id, lang, sentences, confidence): every language in which a document's body has full sentences, with their number and the mean
    probability of the language over them.

    docs(doc_id, text, lang); codes(label, lang) is the table of labels, a dimension of fixed size. The body is the decoded text without
    headers, attachments and data lines. Null, empty and blank texts, and texts without full sentences, give no rows; nor does a row without
    an id. Rows with one id are judged one by one. Whole texts.

    Script ranges narrow a word's candidates; word scores come from a bounded sample of sentences of labelled documents (FIT_DOCS, FIT_SENTENCES); Viterbi
    over the words of a paragraph, with a penalty for switching, labels spans; a sentence has the label of most of its telling words.
    One narrow pass over the documents, no shuffle."""
    scores = _fitted(docs, codes)
    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(_label(scores, False), "doc_id bigint, lang string, sentences bigint, confidence double")


def segments(docs: DataFrame, codes: DataFrame) -> DataFrame:
    """(doc_id, first, last, lang, words, confidence): runs of sentences of one language, by the ordinals of their first and last sentence."""
    scores = _fitted(docs, codes)
    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(
        _label(scores, True), "doc_id bigint, first bigint, last bigint, lang string, words bigint, confidence double"
    )


def relabelled(docs: DataFrame, codes: DataFrame, least: int = MIN_SENTENCES) -> DataFrame:
    """(doc_id, lang): the languages with at least `least` full sentences, of documents whose stored label doesn't already say so alone.

    Rows with one id count as one document: it has the languages of any of them, and its label is right only if all of them have it."""
    langs = detect(docs, codes).where(F.col("sentences") >= least)
    per = langs.groupBy("doc_id").agg(F.collect_set("lang").alias("langs"))
    known = codes.select("label", F.col("lang").alias("_lang")).distinct()
    labels = docs.select("doc_id", F.col("lang").alias("_label")).join(F.broadcast(known), F.col("_label") == F.col("label"), "left")
    stored = labels.groupBy("doc_id").agg(F.collect_set(F.coalesce("_lang", F.lit(""))).alias("stored"))
    right = (F.size("langs") == 1) & (F.col("stored") == F.col("langs"))
    return per.join(stored, "doc_id").where(~right).select("doc_id", F.explode("langs").alias("lang"))
