"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting visits one feature at a time with a small step, fits a tree of three leaves to the residuals over that
feature's bins and adds it to the feature's lookup table; a second run does the same with trees of four leaves over the
pairs of features that promise most. A text is scored by looking its bins up and adding, whole batches at a time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, bounded_batches, free_name, objects

FEATURES = (
    "chars", "words", "word_len", "distinct_words", "top_word", "repeat_next", "distinct_pairs", "upper", "digits", "marks", "symbols",
    "symbol_ends", "stop_ends", "shout_ends", "lines", "line_len", "distinct_lines", "long_word", "space", "non_ascii", "byte_entropy", "bars", "caps_words", "short_words", "top_line",
)

_SENTENCE_END = re.compile(rb"[.?!]\s")


def text_features(text: str | None) -> list[float]:
    """Numbers about the form of one whole text; null and empty texts give zeros."""
    raw = (text or "").encode("utf-8", "replace")
    words = WORD_BYTES.findall(raw)
    if not words:
        return [float(np.log1p(len(raw)))] + [0.0] * (len(FEATURES) - 1)
    n, size = len(words), len(raw)
    counts = Counter(words)
    nexts = sum(map(bytes.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:], strict=False)))
    of = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = of[of > 0] / size
    ends = Counter(w[-1] for w in words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    line_counts = Counter(lines)
    letters = of[65:91].sum() + of[97:123].sum()
    marks = of[33:48].sum() + of[58:65].sum() + of[91:97].sum() + of[123:127].sum()
    symbols = marks - of[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum()
    return [
        float(np.log1p(size)), float(np.log1p(n)), size / n, len(counts) / n, max(counts.values()) / n, nexts / n, pairs / n, of[65:91].sum() / max(1, letters), of[48:58].sum() / size, marks / size, symbols / size,
        sum(ends[c] for c in b"#$%&*+/<=>@\\^_`{|}~") / n, sum(ends[c] for c in b".?!:;,") / n, ends[33] / n, float(np.log1p(len(lines))), float(np.log1p(size / max(1, len(lines)))), len(line_counts) / max(1, len(lines)), float(np.log1p(max(map(len, words)))), (of[32] + of[9:14].sum()) / size, of[128:].sum() / size, float(-(share * np.log2(share)).sum()), of[124] / n, sum(w.isupper() for w in counts) / len(counts), sum(len(w) <= 2 for w in words) / n, max(line_counts.values(), default=0) / max(1, len(lines)),
    ]


@dataclass
class AdditiveModel:
    """Cut points and lookup tables; the score is the logistic of their sum."""

    base: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.cuts)], 1) if len(self.cuts) else np.zeros((len(x), 0), int)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        b = self.bins(x)
        for f, t in enumerate(self.tables):
            out += t[b[:, f]]
        for i, j, ci, cj, t in self.pairs:
            out += t[ci[b[:, i]], cj[b[:, j]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _leaf(g: np.ndarray | float, h: np.ndarray | float, l2: float) -> np.ndarray | float:
    return g / (h + l2)


def _cut(g: np.ndarray, h: np.ndarray, l2: float, least: float) -> tuple[float, int]:
    """Gain and place of the best cut of a run of bins in two; place 0 if none."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gt, ht = g.sum(), h.sum()
    gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
    gain[(hl < least) | (ht - hl < least)] = 0
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1 if gain[k] > 0 else 0


def _three_leaves(g: np.ndarray, h: np.ndarray, l2: float, least: float) -> np.ndarray:
    """The values of a tree with up to three leaves over ordered bins."""
    edges = [0, len(g)]
    for _ in range(2):
        best = max(((*_cut(g[a:b], h[a:b], l2, least), a) for a, b in zip(edges, edges[1:], strict=False)), default=(0.0, 0, 0))
        if not best[1]:
            break
        edges = sorted([*edges, best[2] + best[1]])
    out = np.zeros(len(g))
    for a, b in zip(edges, edges[1:], strict=False):
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum(), l2)
    return out


def _four_corners(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """Gain and values of the best cross cut of a table of bins into four leaves."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    best, values = 0.0, np.zeros(g.shape)
    if min(g.shape) < 2:
        return best, values
    a, c = cg[:-1, :-1], ch[:-1, :-1]
    gs = [a, cg[:-1, -1:] - a, cg[-1:, :-1] - a, cg[-1, -1] - cg[:-1, -1:] - cg[-1:, :-1] + a]
    hs = [c, ch[:-1, -1:] - c, ch[-1:, :-1] - c, ch[-1, -1] - ch[:-1, -1:] - ch[-1:, :-1] + c]
    gain = sum(x**2 / (y + l2) for x, y in zip(gs, hs, strict=True))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    v = [float(_leaf(x[i, j], y[i, j], l2)) for x, y in zip(gs, hs, strict=True)]
    values[: i + 1, : j + 1], values[: i + 1, j + 1 :], values[i + 1 :, : j + 1], values[i + 1 :, j + 1 :] = v
    return float(gain[i, j] - cg[-1, -1] ** 2 / (ch[-1, -1] + l2)), values


def fit_additive(x: np.ndarray, y: np.ndarray, rounds: int = 240, rate: float = 0.08, bins: int = 48, n_pairs: int = 8, pair_bins: int = 10, l2: float = 2.0, least: float = 1.0) -> AdditiveModel:
    """Fit on a matrix of features and 0/1 labels. No rows, or labels of one kind, give a constant model."""
    m = AdditiveModel()
    rate_of = (y.sum() + 0.5) / (len(y) + 1)
    m.base = float(np.log(rate_of / (1 - rate_of)))
    if len(y) == 0 or y.min() == y.max():
        return m
    m.cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    m.tables = [np.zeros(len(c) + 1) for c in m.cuts]
    b = m.bins(x)
    s = np.full(len(y), m.base)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-s))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f, t in enumerate(m.tables):
            g, h = residual()
            step = rate * _three_leaves(np.bincount(b[:, f], g, len(t)), np.bincount(b[:, f], h, len(t)), l2, least)
            t += step
            s += step[b[:, f]]
    coarse = [np.minimum(np.arange(len(t)) * pair_bins // max(1, len(t)), pair_bins - 1) for t in m.tables]
    g, h = residual()

    def grid(i: int, j: int, w: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[i][b[:, i]] * pair_bins + coarse[j][b[:, j]], w, pair_bins * pair_bins).reshape(pair_bins, pair_bins)

    ranked = sorted(((_four_corners(grid(i, j, g), grid(i, j, h), l2)[0], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)[:n_pairs]
    m.pairs = [(i, j, coarse[i], coarse[j], np.zeros((pair_bins, pair_bins))) for _, i, j in ranked]
    for _ in range(rounds // 3):
        for i, j, ci, cj, t in m.pairs:
            g, h = residual()
            step = rate * _four_corners(grid(i, j, g), grid(i, j, h), l2)[1]
            t += step
            s += step[ci[b[:, i]], cj[b[:, j]]]
    return m


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: int, value: Column, id_col: str = "doc_id") -> DataFrame:
    """``value, label`` for at most ``bound`` labelled ids for which ``learn`` (a condition on the id) holds.

    The ids with the least hashes are taken, so that the choice is the same in every run. Null ids and null labels are
    left out; an id labelled more than once counts once, with its largest label; ``value`` is an aggregate (a minimum, say)
    over the documents that bear the id, so that one value stands for all of them. The sample's ids, which the bound
    keeps few, are broadcast; the documents are scanned once, and what the sample needs of them is aggregated before it moves.
    """
    picked = (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & learn)
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max(label).cast("double").alias("__label"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(bound)
    )
    return docs.join(F.broadcast(picked), docs[id_col] == F.col("__id")).groupBy("__id").agg(value.alias("value"), F.max("__label").alias("label")).select("value", "label")


def fit_quality(docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: int = 12_000, text_col: str = "text", id_col: str = "doc_id") -> AdditiveModel:
    """Fit the model on a bounded sample of labelled documents (``bound`` at most), whose features alone leave the executors."""

    @F.pandas_udf("array<double>")
    def numbers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield objects([text_features(t) for t in texts])

    some = bounded_batches(docs).select(F.col(id_col), F.col(text_col).alias("__text"))
    got = labelled_sample(some, labels, label, learn, bound, F.min(numbers("__text")), id_col).toPandas()
    x, y = np.array(got["value"].tolist(), float).reshape(len(got), len(FEATURES)), got["label"].to_numpy(float)
    order = np.lexsort([*x.T, y]) if len(got) else np.array([], int)  # the sums of the fit then don't depend on the order of arrival
    return fit_additive(x[order], y[order])


def quality_score(model: AdditiveModel, text: Column) -> Column:
    """The model's score of a text, 0 to 1; every text has one, null and empty ones too."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([text_features(t) for t in texts], float).reshape(len(texts), len(FEATURES))
            yield pd.Series(model.score(x))

    return score(text)


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, threshold: float = 0.3, label: str = "quality", bound: int = 12_000, score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """``docs`` with a score (0 to 1, higher: a label of 1 is likelier) and 1 or 0 for at least ``threshold`` or less. A taken
    name gets a suffix: all columns of ``docs`` stay as they are.

    Inputs of the score are numbers about the text alone. Null and empty texts are scored like any other; repeated rows
    get equal scores; without usable labels every text gets the same score.
    """
    model = fit_quality(bounded_batches(docs), labels, label, learn, bound)
    score_col, predicted_col = free_name(docs.columns, score_col), free_name([*docs.columns, score_col], predicted_col)
    return docs.withColumn(score_col, quality_score(model, F.col("text"))).withColumn(predicted_col, (F.col(score_col) >= threshold).cast("int"))
