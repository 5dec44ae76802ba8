"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a row of counts and ratios (one pass over the corpus, stored). The
model is a table of scores for the bins of each feature, and for the bins of chosen
pairs of features, learned by cyclic boosting: in turn, every feature gets a shallow
tree on the current residuals, which is added to its table in small steps. Scoring
looks up a bin in each table and adds, for a whole batch at a time.

Only fitting is bounded: it takes at most ``SAMPLE_ROWS`` labelled rows, chosen by a
hash of the id. Features and scores cover every row and the whole text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import text_or_empty
from millrace.sources.tables import materialise

#: Bound on the labelled rows the model is fitted on.
SAMPLE_ROWS = 50_000
BINS = 48
PAIR_BINS = 12
PAIRS = 8
ROUNDS = 160
RATE = 0.15
LEAVES = 4
RIDGE = 1.0

FEATURES = (
    "words word_length longest_word upper digits marks symbols pipes blanks_per_byte high_bytes lines "
    "words_per_line repeated_lines distinct_words same_next shouted odd_ends sentence_words"
).split()


def measure(text: str) -> tuple[float, ...]:
    """The features of one text, in the order of FEATURES; zeros for a text without
    words, but for the number of lines."""
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    n, size = len(words), max(1, len(text))
    if not n:
        return (0.0,) * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "replace"), "uint8")
    kinds = np.bincount(KIND[raw], minlength=6) / len(raw)
    odd = sum(1 for w in words if w[-1] in ODD)
    return (
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        float(max(map(len, words))),
        kinds[1],
        kinds[2],
        kinds[3],
        kinds[4],
        text.count("|") / n,
        1 - sum(map(len, words)) / size,
        kinds[5],
        float(np.log1p(len(lines))),
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        len(set(words)) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        sum(map(str.isupper, words)) / n,
        odd / n,
        n / (1 + text.count(". ") + text.count(".\n")),
    )


def _kinds() -> np.ndarray:
    kind = np.zeros(256, "int64")
    for b in range(256):
        c = chr(b)
        kind[b] = 5 if b >= 128 else 1 if c.isupper() else 2 if c.isdigit() else 3 if c in ".,;:'\"!?-()" else 0
        if 33 <= b < 127 and not kind[b] and not c.isalnum():
            kind[b] = 4
    return kind


KIND = _kinds()
ODD = frozenset("#$%&*@~^|<>=+_\\/")


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and an array of features for each row; null counts as empty."""

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([measure(t) for t in texts])

    return docs.select(F.col(id_col).alias("doc_id"), of(text_or_empty(text_col)).alias("x"))


@dataclass
class Additive:
    """Tables of a fitted model. ``cuts[j]``: bin borders of feature j; ``coarse[j]``:
    those used in pairs."""

    cuts: list[np.ndarray]
    coarse: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            out += table[np.searchsorted(self.cuts[j], x[:, j], "right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            a, b = (np.searchsorted(self.coarse[k], x[:, k], "right") for k in (i, j))
            out += table[a, b]
        return 1 / (1 + np.exp(-out))


def _borders(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Steps of a tree on one binned feature: from the sums of gradients and of weights
    in each bin. The leaf whose best split gains most is split next."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for k, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            left_g, left_h = np.cumsum(g[a : b - 1]), np.cumsum(h[a : b - 1])
            all_g, all_h = g[a:b].sum(), h[a:b].sum()
            gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
            at = int(np.argmax(gains))
            if gains[at] > best[0]:
                best = (gains[at], k, a + at + 1)
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    step = np.zeros(len(g))
    for a, b in parts:
        step[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return step


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """The best cross of one cut on each of two features: a step for each of its four
    corners, and what it gains."""
    cg, ch = (np.cumsum(np.cumsum(m, 0), 1) for m in (g, h))
    corners = []
    for c in (cg, ch):
        inner = c[:-1, :-1]
        corners.append([inner, c[:-1, -1:] - inner, c[-1:, :-1] - inner, c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + inner])
    gains = sum(_gain(a, b) for a, b in zip(*corners))
    if not gains.size:
        return np.zeros_like(g), 0.0
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    steps = [a[i, j] / (b[i, j] + RIDGE) for a, b in zip(*corners)]
    step = np.empty_like(g)
    step[: i + 1, : j + 1], step[: i + 1, j + 1 :], step[i + 1 :, : j + 1], step[i + 1 :, j + 1 :] = steps
    return step, float(gains[i, j] - _gain(cg[-1, -1], ch[-1, -1]))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS) -> Additive:
    """Fit on the rows of ``x`` with labels 0 and 1. Without rows, or with one label
    only, the model scores every row alike (0.5 without rows)."""
    rate = (y.sum() + 1) / (len(y) + 2)
    width = x.shape[1]
    cuts = [_borders(x[:, j], BINS) if len(x) else np.zeros(0) for j in range(width)]
    coarse = [_borders(x[:, j], PAIR_BINS) if len(x) else np.zeros(0) for j in range(width)]
    model = Additive(cuts, coarse, float(np.log(rate / (1 - rate))), [np.zeros(len(c) + 1) for c in cuts])
    if len(np.unique(y)) < 2:
        return model
    bins = [np.searchsorted(cuts[j], x[:, j], "right") for j in range(width)]
    margin = np.full(len(y), model.base)

    def residuals():
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(width):
            g, h = residuals()
            n = len(model.tables[j])
            step = RATE * _tree(np.bincount(bins[j], g, n), np.bincount(bins[j], h, n))
            model.tables[j] += step
            margin += step[bins[j]]
    g, h = residuals()
    rough = [np.searchsorted(coarse[j], x[:, j], "right") for j in range(width)]
    shape = [len(c) + 1 for c in coarse]

    def sums(i, j, g, h):
        cell = rough[i] * shape[j] + rough[j]
        return (np.bincount(cell, m, shape[i] * shape[j]).reshape(shape[i], shape[j]) for m in (g, h))

    gains = {(i, j): _pair_tree(*sums(i, j, g, h))[1] for i in range(width) for j in range(i + 1, width)}
    model.pairs = sorted(gains, key=lambda p: (-gains[p], p))[:pairs]
    model.pair_tables = [np.zeros((shape[i], shape[j])) for i, j in model.pairs]
    for _ in range(rounds // 2):
        for k, (i, j) in enumerate(model.pairs):
            g, h = residuals()
            step, _ = _pair_tree(*sums(i, j, g, h))
            model.pair_tables[k] += RATE * step
            margin += RATE * step[rough[i], rough[j]]
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Every third row by a checksum of its id is kept from fitting; false without id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    Labels of rows that are held out are not read. An id with several different labels
    and labels other than 0 and 1 are not used; the model sees nothing but the text. A
    null text is the empty text and is scored like it. Repeated rows stay repeated; a
    row without an id is scored too. Without labels all scores are alike.
    """
    measured = materialise(features(docs, id_col, text_col), "quality-features")
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    agreed = known.groupBy(F.col(id_col).alias("doc_id")).agg(
        F.min(label_col).alias("y"), F.max(label_col).alias("_most")
    ).where("y = _most")
    chosen = measured.join(agreed, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = chosen.select("x", "y").toPandas()
    x = np.array(sample["x"].tolist(), "float64").reshape(-1, len(FEATURES))
    model = fit(x, sample["y"].to_numpy("float64"))

    @F.pandas_udf("double")
    def score(rows: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(rows.tolist(), "float64").reshape(-1, len(FEATURES))))

    scored = measured.select("doc_id", held_out("doc_id").alias("held_out"), score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
