"""Toxic passages: maximum-scoring segments over token log-odds.

Tokens, and their beginnings, are scored by the log-odds of the document frequencies in toxic and in other labelled
documents under a Dirichlet prior that holds the frequencies in both. One linear scan finds all maximal scoring segments
of a text. What a segment's score is worth in a text of so many tokens follows from the extreme-value distribution of the
scores in clean text: E = K * tokens * exp(-decay * score) segments as good are expected.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, discard, free_name, objects, staged
from .quality import labelled_sample

_TOKEN = re.compile(r"[^\W\d_]+")
#: Lengths of the beginnings of words that are counted besides whole words.
STEMS = (6, 5, 4)
#: Counters and caches are emptied at so many entries, or characters of keys; caches hold no longer tokens than that.
_FULL, _FULL_CHARS, _LONG = 400_000, 8_000_000, 64


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def _keys(token: str) -> Iterator[str]:
    yield token
    for n in STEMS:
        if len(token) > n:
            yield token[:n] + "*"


class _Scores(dict):
    """Token to score: its own, else that of its longest beginning that has one, else the drift."""

    def __init__(self, table: dict[str, float], drift: float) -> None:
        super().__init__()
        self.table, self.drift = table, drift

    def __missing__(self, token: str) -> float:
        found = next((self.table[k] for k in _keys(token) if k in self.table), self.drift)
        if len(token) <= _LONG:
            if len(self) > _FULL:
                self.clear()
            self[token] = found
        return found


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score), in one pass over the positive scores (Ruzzo and Tompa's scan).

    Each segment keeps the place of the last one before it with a smaller sum before; the search goes by these links
    and so takes linear time in all, however many segments there are."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple] = []  # first, end, sum before, sum after, link
    for i in np.flatnonzero(scores > 0).tolist():
        first, left, right, j = i, total[i], total[i + 1], len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append((first, i + 1, left, right, j))
                break
            first, _, left, _, link = stack[j]
            del stack[j:]
            j = link
    return [(a, b, float(r - l)) for a, b, l, r, _ in stack]


@dataclass
class ToxicModel:
    """Scores of tokens, the decay of the best score in clean text, and the calibration."""

    table: dict[str, float] = field(default_factory=dict)
    drift: float = -0.5
    decay: float = 1.0
    constant: float = 1.0
    level: float = 0.01
    slope: float = 1.0
    shift: float = -3.0
    base: float = 0.0
    scores: _Scores | None = None

    def token_scores(self, words: list[str]) -> np.ndarray:
        """A score for each token, at every occurrence: a passage counts whatever words came before it."""
        if self.scores is None:
            self.scores = _Scores(self.table, self.drift)
        return np.fromiter(map(self.scores.__getitem__, words), float, len(words))

    def expected(self, n_tokens: int, score: np.ndarray) -> np.ndarray:
        """How many segments as good a clean text of ``n_tokens`` tokens is expected to have."""
        return self.constant * n_tokens * np.exp(-np.minimum(self.decay * score, 700.0))

    def passages(self, text: str | None, e_value: float | None = None) -> list[tuple[int, int, float]]:
        """Segments of which ``e_value`` (by default ``level``) as good or fewer are expected by chance: (first token, end, score)."""
        words = tokens(text)
        found = segments(self.token_scores(words))
        few = self.expected(len(words), np.array([s for _, _, s in found])) <= (self.level if e_value is None else e_value)
        return [x for x, keep in zip(found, few.tolist(), strict=True) if keep]

    def evidence(self, text: str | None) -> float:
        """How far all segments together are beyond chance: each counts log(1 + level / E), E being how many as good are
        expected, so that those of the significance level count log 2 and chance finds next to nothing."""
        words = tokens(text)
        found = np.array([s for _, _, s in segments(self.token_scores(words))])
        return float(np.log1p(self.level / self.expected(len(words), found)).sum()) if len(found) else 0.0

    def probability(self, text: str | None) -> float:
        x = self.slope * math.log1p(self.evidence(text)) + self.shift
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def log_odds(toxic: np.ndarray, clean: np.ndarray, sums: tuple[float, float, float], flat: float = 0.5, weight: float = 500.0) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of keys' frequencies in toxic and in clean documents, and their standard errors.

    ``sums`` has the frequencies of all keys, toxic and clean, and the number of keys. The Dirichlet prior has ``flat`` for
    each key and ``weight`` shared out by the keys' frequencies in both together."""
    n_toxic, n_clean, n_keys = sums
    prior = flat + weight * (toxic + clean) / (n_toxic + n_clean)
    whole = flat * n_keys + weight
    odds = lambda k, n: np.log(k + prior) - np.log(n + whole - k - prior)
    return odds(toxic, n_toxic) - odds(clean, n_clean), np.sqrt(1 / (toxic + prior) + 1 / (clean + prior))


def _decay(values: np.ndarray, weights: np.ndarray) -> float:
    """The positive solution of E[exp(decay * score)] = 1 over clean tokens."""
    p = weights / weights.sum()
    if not (values > 0).any() or (p * values).sum() >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    grown = lambda x: float((p * np.exp(np.minimum(x * values, 500))).sum())
    while grown(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if grown(mid) < 1 else (low, mid)
    return (low + high) / 2


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3) -> tuple[float, float]:
    w = np.zeros(2)
    a = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + l2 * np.eye(2)
        step = np.linalg.solve(h, a.T @ (y - p) - l2 * w)
        w += np.clip(step, -5, 5)
        if abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In how many toxic and in how many clean texts of ``text, toxic`` each key occurs, in parts to be summed; the empty key
    counts texts."""
    found: tuple[Counter, Counter] = Counter(), Counter()
    held = 0

    def flush() -> pd.DataFrame:
        keys = sorted(found[0].keys() | found[1].keys())
        out = pd.DataFrame({"key": objects(keys), "toxic": [found[1][k] for k in keys], "clean": [found[0][k] for k in keys]})
        found[0].clear()
        found[1].clear()
        return out

    for part in batches:
        for text, toxic in zip(part["text"], part["toxic"], strict=True):
            keys = {k for t in set(tokens(text)) for k in _keys(t)} | {""}
            found[int(toxic)].update(keys)
            held += sum(map(len, keys))
            if held > _FULL_CHARS or len(found[0]) + len(found[1]) > _FULL:
                yield flush()
                held = 0
    yield flush()


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: int = 20_000, least: float = 1.25, sure: float = 1.28, drift: float = -0.5, text_col: str = "text", id_col: str = "doc_id") -> ToxicModel:
    """Learn from at most ``bound`` labelled documents. A token or beginning scores the lower bound of its log-odds, ``sure``
    standard errors below, if that is ``least`` or more: all of those are kept. Counting and calibration run on the
    executors over the sample's whole texts, which are written once into the shared folder."""
    sample = staged(labelled_sample(bounded_batches(docs), labels, label, learn, bound, F.min(text_col), id_col).select(F.col("value").alias("text"), (F.col("label") > 0).alias("toxic")), "toxic_sample")
    counts = staged(sample.mapInPandas(tally, "key string, toxic long, clean long").groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "toxic_counts")
    whole = counts.agg(*[F.coalesce(F.sum(F.when((F.col("key") == "") == empty, F.col(c))), F.lit(0)).alias(f"{c}_{empty}") for c in ("toxic", "clean") for empty in (True, False)], F.count("*").alias("keys")).first()
    n_toxic, n_clean = whole["toxic_True"], whole["clean_True"]
    model = ToxicModel(drift=drift)
    model.base = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
    if not n_toxic or not n_clean:
        discard(sample, counts)
        model.slope, model.shift = 0.0, math.log(model.base / (1 - model.base))
        return model
    sums = (float(whole["toxic_False"]), float(whole["clean_False"]), float(whole["keys"] - 1))

    def telling(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            delta, error = log_odds(part["toxic"].to_numpy(float), part["clean"].to_numpy(float), sums)
            low = delta - sure * error
            yield pd.DataFrame({"key": part["key"][low >= least], "score": np.minimum(low[low >= least], 8.0)})

    # keys that tell much are few: the words of toxic passages in a bounded sample
    found = counts.where("key != '' and toxic > 0").mapInPandas(telling, "key string, score double").toPandas().sort_values("key")
    model.table = dict(zip(found["key"], found["score"].astype(float), strict=True))

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            spread: Counter = Counter()
            for text in part["text"]:
                spread.update(np.round(model.token_scores(tokens(text)), 2).tolist())
            yield pd.DataFrame({"score": list(spread), "n": list(spread.values())})

    clean = sample.where(~F.col("toxic"))
    spread = clean.mapInPandas(weigh, "score double, n long").groupBy("score").agg(F.sum("n").alias("n")).toPandas()  # a row for each score in hundredths, 1,000 at most
    values = np.array(sorted({drift, *(round(v, 2) for v in model.table.values())}))
    seen = dict(zip(spread["score"], spread["n"], strict=True))
    model.decay = _decay(values, np.array([seen.get(v, 0) + 0.5 for v in values]))

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            words = [tokens(t) for t in part["text"]]
            yield pd.DataFrame({"n": [sum(len(segments(model.token_scores(w))) for w in words)], "tokens": [sum(map(len, words))]})

    if model.table:
        sizes = clean.mapInPandas(pieces, "n long, tokens long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).first()
        model.constant = fitted_constant(sizes["n"], sizes["tokens"], model.decay, min(model.table.values()))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield pd.DataFrame({"x": [math.log1p(model.evidence(t)) for t in part["text"]], "y": part["toxic"].astype(float)})

    got = sample.mapInPandas(measure, "x double, y double").toPandas().sort_values(["x", "y"])  # ``bound`` rows at most
    model.slope, model.shift = _logistic(got["x"].to_numpy(), got["y"].to_numpy())
    discard(sample, counts)
    return model


def fitted_constant(n: int, n_tokens: int, decay: float, least: float) -> float:
    """K, so that as many segments of a score of ``least`` or more, the least that a segment can have, are expected in clean
    text of ``n_tokens`` tokens as were found there."""
    return (n + 0.5) * math.exp(decay * least) / max(1, n_tokens)


def toxic_score(model: ToxicModel, text: Column) -> Column:
    """The probability that a text is toxic; every text has one, null and empty ones too."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.probability(t) for t in texts], dtype=float)

    return score(text)


def toxic_passages(model: ToxicModel, text: Column, e_value: float | None = None) -> Column:
    """Every significant toxic passage of a text: first token, end, score."""

    @F.pandas_udf("array<struct<first:int,end:int,score:double>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"first": a, "end": b, "score": s} for a, b, s in model.passages(t, e_value)] for t in texts])

    return find(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, threshold: float = 0.3, label: str = "toxic", bound: int = 20_000, score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """``docs`` with a score (0 to 1, higher: a label of 1 is likelier) and 1 or 0 for at least ``threshold`` or less. A taken
    name gets a suffix: all columns of ``docs`` stay as they are.

    The score depends on the text alone. Null and empty texts have no evidence and the lowest score; repeated rows get
    equal scores; without usable labels of both kinds every text gets the labels' rate.
    """
    model = fit_toxicity(docs, labels, label, learn, bound)
    score_col, predicted_col = free_name(docs.columns, score_col), free_name([*docs.columns, score_col], predicted_col)
    return docs.withColumn(score_col, toxic_score(model, F.col("text"))).withColumn(predicted_col, (F.col(score_col) >= threshold).cast("int"))
