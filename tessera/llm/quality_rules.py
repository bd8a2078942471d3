"""Quality classifier: a sparse ensemble of rules over text statistics.

1. STATISTICS are column expressions over the whole text.
2. Shallow trees are grown on resampled labelled rows; every path from a root to a node is a rule, a conjunction of limits.
3. An L1-penalised logistic regression over the rules' truth values keeps few of them, each with a weight.
4. Rules and weights become one column expression, so scoring is a projection without Python.

Fitting reads at most SAMPLE labelled rows; scoring reads every row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_name, hash_bound

#: The bound of the training sample, in labelled rows.
SAMPLE = 12_000
TREES, DEPTH, CUTS, LEAF = 60, 3, 32, 20
PENALTY, STEPS = 0.002, 400
_SYMBOLS = "#$%&*@^~=+<>|{}[]\\/_`"


def statistics(text: Column) -> dict[str, Column]:
    """Name and expression of each statistic. A null text counts as empty. Of an empty one the numbers a line or word have
    are 1 (words_a_line, distinct_words, distinct_lines: it has one line with one empty word), all others are 0."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t).cast("double")
    words = F.split(t, "[ \n\t\r]")
    lines = F.split(t, "\n")
    # What is left of a text without the runs of other characters: a pass by one pattern, far quicker than translate's lookups.
    others = lambda chars: "[^" + "".join(c if c.isalnum() or c.isspace() else f"\\{c}" for c in chars) + "]+"
    share = lambda chars: F.length(F.regexp_replace(t, others(chars), "")) / F.greatest(n, F.lit(1.0))
    n_words, n_lines = (F.length(F.regexp_replace(t, others(c), "")) + 1.0 for c in (" \n\t\r", "\n"))
    upper, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    return {
        "log_chars": F.log1p(n),
        "word_length": n / n_words,
        "words_a_line": n_words / n_lines,
        "symbols": share(_SYMBOLS),
        "bars": share("|"),
        "upper": share(upper),
        "digits": share(digits),
        "stops": share(".?"),
        "marks": share("!"),
        "commas": share(",;:"),
        "quotes": share("\"'()"),
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "longest_line": F.array_max(F.transform(lines, F.length)) / F.greatest(n, F.lit(1.0)),
        "links": (F.length(t) - F.length(F.replace(t, F.lit("://"), F.lit("")))) / F.greatest(n, F.lit(1.0)),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction: each limit is (statistic, True for `<=` or False for `>`, value)."""

    limits: tuple[tuple[str, bool, float], ...]


@dataclass
class Model:
    bias: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)


def _grow(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], rng, depth: int, path: tuple, out: set) -> None:
    """Splits by squared error over a random half of the statistics; adds the path of every node to out."""
    if path:
        out.add(path)
    if depth == 0 or len(y) < 2 * LEAF or y.min() == y.max():
        return
    best = (1e-9, None, None)
    total, mean = len(y), y.mean()
    for f in rng.permutation(x.shape[1])[: max(1, x.shape[1] // 2)]:
        if not len(cuts[f]):
            continue
        bins = np.searchsorted(cuts[f], x[:, f], side="left")  # bin b: x <= cuts[b]
        n = np.cumsum(np.bincount(bins, minlength=len(cuts[f]) + 1))[:-1]
        s = np.cumsum(np.bincount(bins, y, minlength=len(cuts[f]) + 1))[:-1]
        ok = (n >= LEAF) & (total - n >= LEAF)
        if ok.any():
            gain = np.where(ok, (s - n * mean) ** 2 / np.maximum(n * (total - n), 1), -1)
            if gain.max() > best[0]:
                best = (gain.max(), f, cuts[f][int(gain.argmax())])
    _, f, cut = best
    if f is None:
        return
    left = x[:, f] <= cut
    _grow(x[left], y[left], cuts, rng, depth - 1, (*path, (int(f), True, float(cut))), out)
    _grow(x[~left], y[~left], cuts, rng, depth - 1, (*path, (int(f), False, float(cut))), out)


def _holds(x: np.ndarray, path: tuple) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, below, cut in path:
        out &= (x[:, f] <= cut) if below else (x[:, f] > cut)
    return out


def _lasso(r: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty by accelerated proximal gradient; the bias is free."""
    n, m = r.shape
    a = np.hstack([np.ones((n, 1)), r])
    v = np.ones(m + 1)
    for _ in range(20):
        v = a.T @ (weight * (a @ v))
        v /= np.linalg.norm(v)
    step = 1.0 / max(1e-9, 0.25 * float(v @ (a.T @ (weight * (a @ v)))))
    w, z, k = np.zeros(m + 1), np.zeros(m + 1), 1.0
    for _ in range(STEPS):
        g = a.T @ (weight * (1 / (1 + np.exp(-np.clip(a @ z, -30, 30))) - y))
        new = z - step * g
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        k_new = (1 + (1 + 4 * k * k) ** 0.5) / 2
        z, w, k = new + (k - 1) / k_new * (new - w), new, k_new
    return float(w[0]), w[1:]


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str], seed: int = 7, penalty: float = PENALTY) -> Model:
    """A model of rows of statistics and labels 0 / 1; of one class only, its rate (smoothed) and no rules."""
    rate = (y.sum() + 1) / (len(y) + 2)
    if len(y) < 2 * LEAF or y.min() == y.max():
        return Model(float(np.log(rate / (1 - rate))))
    rng, paths = np.random.default_rng(seed), set()
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 1)[1:-1])) for f in range(x.shape[1])]
    cuts = [np.unique(np.round(c, 6)) for c in cuts]
    one, zero = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    for t in range(TREES):  # every other tree on balanced classes, so that rules of the rare class are found too
        rows = rng.integers(0, len(y), len(y) // 2) if t % 2 else np.concatenate([rng.choice(one, min(len(one), len(zero))), rng.choice(zero, min(len(one), len(zero)))])
        found: set = set()
        _grow(x[rows], y[rows].astype(float), cuts, rng, DEPTH, (), found)
        paths |= found
    merged, seen = [], set()
    for p in sorted(paths):
        truth = _holds(x, p)
        key = truth.tobytes()
        if 0 < truth.sum() < len(y) and key not in seen and (~truth).tobytes() not in seen:
            seen.add(key)
            merged.append((p, truth))
    r = np.column_stack([t for _, t in merged]).astype(float) if merged else np.zeros((len(y), 0))
    bias, w = _lasso(r, y.astype(float), np.full(len(y), 1 / len(y)), penalty)
    return Model(bias, [(Rule(tuple((names[f], b, c) for f, b, c in p)), float(v)) for (p, _), v in zip(merged, w, strict=True) if abs(v) > 1e-6])


def fit(labelled: DataFrame, text: str = "text", label: str = "label", order: str = "doc_id", bound: int = SAMPLE, total: int | None = None) -> Model:
    """A model of rows with a text and a label of 0 or 1 (others are left out), at most about bound of them: those with the
    smallest hash of `order`. total: how many such rows there are, if the caller knows that they are at most bound; else they
    are counted first. No such rows: a score of 0.5 for all."""
    rows = labelled.filter(F.col(label).isin(0, 1))
    taken = rows.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"), F.xxhash64(order).alias("h"))
    total = taken.select("h").count() if total is None else total
    if total > bound:
        taken = taken.filter(F.col("h") <= hash_bound(0.95 * bound / total))
    stats = statistics(F.col("text"))
    held = taken.select(*[v.alias(k) for k, v in stats.items()], "label", "h").orderBy("h").toArrow()  # at most about bound rows of numbers
    y = held.column("label").to_numpy().astype(int)
    return fit_rules(np.column_stack([held.column(k).to_numpy() for k in stats]), y, list(stats))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with score, the probability of label 1: one row per row, null and empty texts too. A column named score is replaced."""
    stats = {k: (free_name(docs, f"stat_{k}"), v) for k, v in statistics(F.col(text)).items()}
    used = {f for rule, _ in model.rules for f, _, _ in rule.limits}
    wide = docs.withColumns({stats[k][0]: stats[k][1] for k in stats if k in used}) if used else docs
    total = F.lit(model.bias)
    for rule, weight in model.rules:
        holds = F.lit(True)
        for f, below, cut in rule.limits:
            holds = holds & ((F.col(stats[f][0]) <= cut) if below else (F.col(stats[f][0]) > cut))
        total = total + F.when(holds, weight).otherwise(0.0)
    done = wide.withColumn("score", 1.0 / (1.0 + F.exp(-total)))
    return done.drop(*[v[0] for k, v in stats.items() if k in used])
