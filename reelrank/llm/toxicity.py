"""Toxicity scores from a classifier regularised by counterfactuals.

A logistic model over words and leading parts of words is fitted on labelled
texts. Besides the usual loss it pays for every labelled text whose score
changes when the identity terms in it are swapped for other groups' terms, so
that a neutral mention of a group does not count as toxic.

Spark does the work on the corpus: it draws the bounded training sample,
counts each feature's texts by label, picks the most telling features, and
scores every whole text. The fit itself runs on the sample's index lists in
one task: ``max_rows`` texts at most, whatever the size of the tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import written
from reelrank.llm.wordhash import NOT_ALNUM, hashed_words

#: Terms of one row name groups of one kind; a term is swapped for the next one of its row.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("immigrants", "citizens", "refugees"), ("disabled", "abled"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("schwarze", "weiße"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("noirs", "blancs"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("negros", "blancos"),
)
_SWAP = {term: row[(i + 1) % len(row)] for row in IDENTITY_TERMS for i, term in enumerate(row)}
PREFIXES = (4, 5, 6, 7, 8)


@dataclass(frozen=True)
class Model:
    """Hashes of the features in ascending order, their weights, the bias."""
    features: np.ndarray
    weights: np.ndarray
    bias: float


def _feature_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The distinct feature hashes of each text."""
    lowered = [(t or "").lower() for t in texts]
    for _, bounds, words, leading in hashed_words(lowered, NOT_ALNUM, None, PREFIXES):
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            found = np.unique(np.concatenate([words[a:b], *[p[a:b] for p in leading]]))
            yield found[1:] if len(found) and not found[0] else found


def swapped(text: str | None) -> str | None:
    """The text with every identity term swapped, or None without one."""
    if not text:
        return None
    out, at, lower, hit = [], 0, text.lower(), False
    for a, b in _words(lower):
        if (other := _SWAP.get(lower[a:b])) is not None:
            out += [lower[at:a], other]
            at, hit = b, True
    return "".join(out) + lower[at:] if hit else None


def _words(lower: str) -> Iterator[tuple[int, int]]:
    for term in _SWAP:
        if term in lower:
            break
    else:
        return
    at = None
    for i, c in enumerate(lower + " "):
        if c.isalnum():
            at = i if at is None else at
        elif at is not None:
            yield at, i
            at = None


def training_sample(docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``label``, ``text`` of at most ``max_rows`` labelled ids, those of the
    smallest hash. Null ids and labels other than 0 and 1 take no part; a
    repeated id counts once (its largest label, its smallest text)."""
    chosen = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (rows.join(F.broadcast(chosen), "id")  # max_rows rows
            .groupBy("id", "label").agg(F.min("text").alias("text")).select("label", "text"))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        sets = list(_feature_sets(b["text"].tolist()))
        if not sets:
            continue
        label = np.repeat(b["label"].to_numpy(), [len(s) for s in sets])
        keys, where = np.unique(np.concatenate(sets), return_inverse=True)
        toxic = np.bincount(where, weights=label, minlength=len(keys)).astype(np.int64)
        yield pd.DataFrame({"feature": keys.view(np.int64), "n": np.bincount(where, minlength=len(keys)), "toxic": toxic})


def select_features(sample: DataFrame, n_features: int, min_texts: int = 4) -> np.ndarray:
    """The features that at least ``min_texts`` texts hold with the largest
    chi-square against the label."""
    n, pos = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not n or not pos or pos == n:
        return np.zeros(0, np.uint64)
    a, df = F.col("toxic"), F.col("n")
    chi = (a * n - df * pos) * (a * n - df * pos) / (df * (F.lit(n) - df) + 1e-9)
    top = (sample.mapInPandas(_count, "feature long, n long, toxic long")
           .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
           .filter(F.col("n") >= min_texts)
           .select("feature", chi.cast("double").alias("chi"))
           .orderBy(F.desc("chi"), "feature").limit(n_features).select("feature").collect())
    return np.sort(np.array([r[0] for r in top], np.int64).view(np.uint64))


def _positions(found: np.ndarray, features: np.ndarray) -> np.ndarray:
    at = np.searchsorted(features, found)
    at[at == len(features)] = 0
    return at[features[at] == found].astype(np.int32)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_rows: int = 16_000, n_features: int = 4_096, l2: float = 1e-4,
        swap_weight: float = 1.0) -> Model:
    """Fit on at most ``max_rows`` labelled texts (a bound on the fit alone;
    scoring covers every text). With one class or no labelled text the model
    has no features and its bias is the share of toxic texts."""
    sample = written(training_sample(docs, labels, max_rows, id_col, text_col, label_col), "toxicity-sample")
    features = select_features(sample, n_features)

    def indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].tolist()
            own = [_positions(s, features) if len(features) else [] for s in _feature_sets(texts)]
            other = [swapped(t) for t in texts]
            to = _feature_sets([o for o in other if o is not None])
            swap = [None if o is None else _positions(s, features) if len(features) else []
                    for o, s in ((o, next(to) if o is not None else None) for o in other)]
            yield pd.DataFrame({"label": b["label"], "own": own, "swap": swap})

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [r for b in batches for r in zip(b["label"], b["own"], b["swap"], strict=True)]
        w = _fit_rows(rows, len(features), l2, swap_weight)
        yield pd.DataFrame({"weights": [w.tobytes()]})

    lists = written(sample.mapInPandas(indexed, "label int, own array<int>, swap array<int>"), "toxicity-lists")
    w = np.frombuffer(lists.coalesce(1).mapInPandas(solve, "weights binary").first()[0])
    return Model(features, w[:-1].copy(), float(w[-1]))


class _Rows:
    """Sparse 0/1 rows with the two products the fit needs."""

    def __init__(self, lists: list, width: int):
        self.columns = np.concatenate([np.asarray(x, np.int64) for x in lists]) if lists else np.zeros(0, np.int64)
        self.rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        self.n, self.width = len(lists), width

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights=w[self.columns], minlength=self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, weights=r[self.rows], minlength=self.width)


def _fit_rows(rows: list, width: int, l2: float, swap_weight: float) -> np.ndarray:
    """Weights and bias: class-balanced logistic loss, squared weights, and the squared score
    change of swapped rows, minimised by gradient steps with momentum along a
    limited-memory quasi-Newton direction."""
    y = np.array([r[0] for r in rows], float)
    if not len(y) or y.min() == y.max() or not width:
        share = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 0.0
        return np.append(np.zeros(width), np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)  # both classes weigh the same
    x = _Rows([r[1] for r in rows], width)
    pairs = [(r[1], r[2]) for r in rows if r[2] is not None]
    a, b = _Rows([p[0] for p in pairs], width), _Rows([p[1] for p in pairs], width)

    def loss(v: np.ndarray) -> tuple[float, np.ndarray]:
        w, z = v[:-1], x.times(v[:-1]) + v[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        value = weight @ (np.logaddexp(0, z) - y * z) + l2 / 2 * w @ w
        r = weight * (p - y)
        g = np.append(x.back(r) + l2 * w, r.sum())
        if pairs:
            d = a.times(w) - b.times(w)
            value += swap_weight * np.mean(d * d)
            g[:-1] += 2 * swap_weight / len(pairs) * (a.back(d) - b.back(d))
        return value, g

    v = np.zeros(width + 1)
    f, g = loss(v)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(200):
        q, back = g.copy(), []
        for s, t in reversed(past):
            back.append((s @ q) / (s @ t))
            q -= back[-1] * t
        if past:
            q *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1])
        for (s, t), al in zip(past, reversed(back), strict=True):
            q += s * (al - (t @ q) / (s @ t))
        step, slope = 1.0, -(q @ g)
        while step > 1e-8:
            f2, g2 = loss(v - step * q)
            if f2 <= f + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, t = -step * q, g2 - g
        if s @ t > 1e-12:
            past = [*past[-9:], (s, t)]
        v, small, f, g = v + s, f - f2 < 1e-7 * max(1, f), f2, g2
        if small:
            break
    return v


def score(text: Column, model: Model) -> Column:
    """Probability of the toxic label for each whole text; a null text is
    scored as the empty one."""
    features, weights, bias = model.features, model.weights, model.bias
    bits = 20
    may = np.zeros(1 << bits, bool)  # most words are no feature: one lookup tells
    may[(features >> np.uint64(64 - bits)).astype(np.int64)] = True

    def logits(texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), bias)
        for first, bounds, words, leading in hashed_words([t.lower() for t in texts], NOT_ALNUM, None, PREFIXES):
            owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            hits, docs = [], []
            for found in (words, *leading):
                at = np.flatnonzero(may[(found >> np.uint64(64 - bits)).astype(np.int64)])
                hits.append(found[at])
                docs.append(owner[at])
            found, doc = np.concatenate(hits), np.concatenate(docs)
            if not len(features) or not len(found):
                continue
            at = np.searchsorted(features, found)
            at[at == len(features)] = 0
            ok = features[at] == found
            once = np.unique(doc[ok] * len(features) + at[ok])  # a feature counts once a text
            out[first:first + len(bounds) - 1] += np.bincount(
                once // len(features), weights=weights[once % len(features)], minlength=len(bounds) - 1)
        return out

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        parts = [logits(texts.iloc[i:i + 500].tolist()) for i in range(0, len(texts), 500)]
        return pd.Series(1 / (1 + np.exp(-np.clip(np.concatenate([np.zeros(0), *parts]), -500, 500))))

    return scored(F.coalesce(text, F.lit("")))
