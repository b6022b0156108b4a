"""Toxicity by a weighted finite-state pattern grammar.

The insult lexicon is learned; threats, targets, negations, reporting and
intent words are fixed lists. A lexicon entry is a whole word or a word
beginning of 4 to 8 bytes (languages inflect). Candidates are counted by the
kind of clause they stand in, as the composed transducer sees it: one is good
if it hardly occurs in clean documents outside negated and reported clauses, or
hardly in clean documents at all. Clean documents may quote or negate an
insult as often as they like. Entries are chosen by greedy cover: the good
candidate that explains most toxic documents not explained yet, as long as it
explains at least ``NEW``. Copies of one document so cannot fill the lexicon
with their ordinary words.

Clauses with a lexicon or threat word run through the composed transducer
(``grammar``). The score of a clause is the entry's precision, moved by the
learned weight of the clause's kind (negated, reported, aimed at someone ...),
and the score of a document is that of its worst clause; without a match it is
the share of toxic documents among those without one.

Training reads at most ``SAMPLE`` labelled documents (the smallest hashes of
doc_id, from all labelled rows that are allowed for training). Scoring reads
whole texts. Labels, language, source and doc_id never enter a score.

Defined cases: null and empty texts score like any text without a match; a null
doc_id is not held out; without usable labels the lexicon is empty and all
scores are 0.5 or less. Repeated rows score alike. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstone.llm import grammar as G
from turnstone.llm.arrays import ALNUM, LOWER, U64, Words, run_hash, slices

SAMPLE = 8_000
PREFIXES = (4, 5, 6, 7, 8)
WORD = 9  # kind of a whole-word entry; a prefix entry's kind is its length
NEW = 3
SHRINK = 20.0
THRESHOLD = 0.7
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?;:\n"]] = True
_TABLE = np.array(G.TABLE)
_LOWERS = (np.array(G.KINDS) & (G.IS_NEGATED | G.IS_REPORTED)) > 0


def _features(w: Words, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of one kind of feature and the words that have it."""
    if kind == WORD:
        return w.hash, np.arange(w.n)
    at = np.flatnonzero(w.end - w.start >= kind)
    return run_hash(w.sums, w.start[at], w.start[at] + kind) ^ U64(kind), at


def _word_classes() -> tuple[np.ndarray, np.ndarray]:
    hashes, classes = [], []
    for cls, words in G.WORDS.items():
        for s in slices(pa.array([words])):
            h = Words(s, ALNUM, LOWER).hash
            hashes.append(h)
            classes.append(np.full(len(h), cls))
    h, c = np.concatenate(hashes), np.concatenate(classes)
    order = np.argsort(h, kind="stable")
    return h[order], c[order]


def _classes(w: Words, fixed: tuple) -> np.ndarray:
    """Class of each word by the fixed lists."""
    cls = np.zeros(w.n, np.int64)
    h, c = fixed
    k = np.minimum(np.searchsorted(h, w.hash), len(h) - 1)
    same = h[k] == w.hash
    cls[same] = c[k[same]]
    return cls


def _clauses(s, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word of each clause and the word after its last."""
    ends = np.concatenate([[0], np.cumsum(_END[s.data])])
    new = np.ones(w.n, bool)
    new[1:] = (w.doc[1:] != w.doc[:-1]) | (ends[w.start[1:]] != ends[w.end[:-1]])
    begin = np.flatnonzero(new)
    return begin, np.append(begin[1:], w.n)


def _lowered(s, w: Words, fixed: tuple) -> np.ndarray:
    """Whether an insult in the place of each word would stand negated or reported, by the composed machine."""
    out = np.zeros(w.n, bool)
    if not w.n:
        return out
    cls = _classes(w, fixed)
    begin, stop = _clauses(s, w)
    cues = np.flatnonzero((cls == G.NEGATION) | (cls == G.REPORT))
    at = np.unique(np.searchsorted(begin, cues, side="right") - 1)  # without a cue nothing is lowered
    at = at[np.argsort(begin[at] - stop[at], kind="stable")]  # longest first
    begin, length = begin[at], (stop - begin)[at]
    state = np.zeros(len(at), np.int64)
    for i in range(int(length[0]) if len(at) else 0):
        live = int(np.searchsorted(-length, -i, side="left"))  # clauses of more than i words
        place = begin[:live] + i
        out[place] = _LOWERS[_TABLE[state[:live], G.INSULT]]
        state[:live] = _TABLE[state[:live], cls[place]]
    return out


@dataclass
class Model:
    base: float = 0.1
    entries: dict = field(default_factory=dict)  # kind -> (sorted hashes, precision)
    moves: dict = field(default_factory=dict)  # clause kind -> shift of the log-odds
    fixed: tuple = field(default_factory=_word_classes)

    def matches(self, s):
        """(text, precision of its entry or 0, clause kind) of each clause that has a lexicon or threat word."""
        w = Words(s, ALNUM, LOWER)
        cls = _classes(w, self.fixed)
        precision = np.zeros(w.n)
        for kind, (eh, ep) in self.entries.items():
            fh, at = _features(w, kind)
            k = np.minimum(np.searchsorted(eh, fh), len(eh) - 1)
            same = eh[k] == fh
            cls[at[same]] = G.INSULT
            precision[at[same]] = np.maximum(precision[at[same]], ep[k[same]])
        hot = np.flatnonzero((cls == G.INSULT) | (cls == G.THREAT))
        if not len(hot):
            return []
        begin, stop = _clauses(s, w)
        out = []
        for i in np.unique(np.searchsorted(begin, hot, side="right") - 1):
            a, b = begin[i], stop[i]
            out.append((int(w.doc[a]), float(precision[a:b].max()), G.clause_kind(cls[a:b].tolist())))
        return out

    def clause_score(self, precision: float, kind: int) -> float:
        p = precision or self.base
        return 1 / (1 + math.exp(-(math.log(p / (1 - p)) + self.moves.get(kind, 0.0))))

    def scores(self, column) -> np.ndarray:
        out = np.full(len(column), self.base)
        for s in slices(column):
            for doc, p, kind in self.matches(s):
                if kind & (G.IS_INSULT | G.IS_THREAT):
                    out[s.first + doc] = max(out[s.first + doc], self.clause_score(p, kind))
        return np.clip(out, 0.0, 1.0)


def _pairs(s, kind: int, lowered: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (feature, text) of a slice, and whether one of them stands in a clause that lowers nothing."""
    w = Words(s, ALNUM, LOWER)
    h, at = _features(w, kind)
    pair, inverse = np.unique(np.stack([h, w.doc[at].astype(U64)]), axis=1, return_inverse=True)
    plain = np.zeros(pair.shape[1], bool)
    plain[inverse.ravel()[~lowered[at]]] = True
    return pair[0], pair[1].astype(np.int64) + s.first, plain


def _candidates(texts: pa.Array, y: np.ndarray, fixed: tuple):
    """{(kind, hash): (toxic texts with it, clean texts with it)} of features that hardly occur in clean texts.

    Both are counted outside negated and reported clauses only, unless the feature hardly occurs in clean
    texts whatever its clause.
    """
    toxic = texts.take(pa.array(np.flatnonzero(y == 1)))
    fair = texts.take(pa.array(np.flatnonzero(y == 0)))
    low_toxic = [_lowered(s, Words(s, ALNUM, LOWER), fixed) for s in slices(toxic)]
    low_fair = [_lowered(s, Words(s, ALNUM, LOWER), fixed) for s in slices(fair)]
    found: dict = {}
    for kind in (*PREFIXES, WORD):
        parts = [_pairs(s, kind, low) for s, low in zip(slices(toxic), low_toxic)]
        if not parts:
            continue
        h, d, plain = (np.concatenate(x) for x in zip(*parts))
        u, inverse, n = np.unique(h, return_inverse=True, return_counts=True)
        inverse = inverse.ravel()
        often = np.flatnonzero(n >= NEW)
        if not len(often):
            continue
        clean, clean_plain = np.zeros(len(u), np.int64), np.zeros(len(u), np.int64)
        for s, low in zip(slices(fair), low_fair):
            h0, _, p0 = _pairs(s, kind, low)
            k = np.minimum(np.searchsorted(u, h0), len(u) - 1)
            same = u[k] == h0
            clean += np.bincount(k[same], minlength=len(u))
            clean_plain += np.bincount(k[same & p0], minlength=len(u))
        n_plain = np.bincount(inverse[plain], minlength=len(u))
        anywhere = (n >= NEW) & (clean <= 0.02 * n)
        good = anywhere | ((n_plain >= NEW) & (clean_plain <= 0.02 * n_plain))
        use = good[inverse] & (plain | anywhere[inverse])
        order = np.flatnonzero(use)[np.argsort(inverse[use], kind="stable")]
        row, docs = inverse[order], d[order]
        kept = np.flatnonzero(good)
        cut = np.searchsorted(row, np.append(kept, len(u)))
        for i, x in enumerate(kept.tolist()):
            found[(kind, int(u[x]))] = (set(docs[cut[i]:cut[i + 1]].tolist()),
                                        int(clean[x] if anywhere[x] else clean_plain[x]))
    return found


def fit(texts: pa.Array, y: np.ndarray) -> Model:
    """Model from labelled texts."""
    model = Model()
    if not len(y):
        return model
    found = _candidates(texts, y, model.fixed) if (y == 1).any() else {}
    left = set(range(int((y == 1).sum())))
    chosen: dict[int, list] = {}
    open_sets = {k: set(v[0]) for k, v in found.items()}
    while open_sets:
        # most toxic texts not explained yet; then the longest feature, then the smallest hash
        key = max(open_sets, key=lambda k: (len(open_sets[k]), k[0], -k[1]))
        new = open_sets[key]
        if len(new) < NEW:
            break
        docs, clean = found[key]
        chosen.setdefault(key[0], []).append((key[1], (len(docs) + 0.1) / (len(docs) + clean + 0.6)))
        left -= new
        open_sets = {k: v & left for k, v in open_sets.items()}
        open_sets = {k: v for k, v in open_sets.items() if len(v) >= NEW}
    for kind, rows in chosen.items():
        rows.sort()
        model.entries[kind] = (np.array([h for h, _ in rows], U64), np.array([p for _, p in rows]))
    matched = np.zeros(len(y), bool)
    kinds: dict[int, Counter] = {}
    told: dict[int, float] = {}  # sum of the entries' precisions
    for s in slices(texts):
        for doc, p, kind in model.matches(s):
            if kind & (G.IS_INSULT | G.IS_THREAT):
                matched[s.first + doc] |= bool(kind & G.IS_INSULT)
                kinds.setdefault(kind, Counter())[int(y[s.first + doc])] += 1
                told[kind] = told.get(kind, 0.0) + p
    rest = y[~matched]
    model.base = float((rest.sum() + 0.5) / (len(rest) + 2))
    for kind, n in kinds.items():
        # how much more or less often than their entries tell such clauses stand in toxic texts, shrunk towards no change
        expected = told[kind] / (n[0] + n[1]) if kind & G.IS_INSULT else model.base
        rate = (n[1] + SHRINK * expected) / (n[0] + n[1] + SHRINK)
        rate = min(max(rate, 1e-4), 1 - 1e-4)
        model.moves[kind] = math.log(rate / (1 - rate)) - math.log(expected / (1 - expected))
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` documents whose label may be learned."""
    usable = (labels.select(labels["doc_id"], labels["toxic"]).where("toxic IS NOT NULL AND doc_id IS NOT NULL")
              .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (docs.select(docs["doc_id"], docs["text"]).join(F.broadcast(usable), "doc_id")  # `sample` rows at most
            .dropDuplicates(["doc_id"]).select("text", "toxic").toArrow())
    text = rows.column("text").combine_chunks().fill_null("") if rows.num_rows else pa.array([], pa.string())
    if isinstance(text, pa.ChunkedArray):
        text = pa.concat_arrays(text.chunks)
    return fit(text, np.array(rows.column("toxic").to_pylist(), np.int64))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_column(docs: DataFrame, model: Model):
    """Column of scores for the text of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(text: pa.Array) -> pa.Array:
        return pa.array(sent.value.scores(text), pa.float64())

    return F.arrow_udf(score, T.DoubleType())(docs["text"])


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    out = docs.select(docs["doc_id"], score_column(docs, model).alias("score"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that score at or above the threshold; its columns are kept."""
    return docs.where(score_column(docs, model) < THRESHOLD)
