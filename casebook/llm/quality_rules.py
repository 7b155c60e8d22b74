"""Operator 1: quality classifier as a sparse rule ensemble.

1. Text statistics are Spark column expressions over the whole text.
2. Small boosted trees are grown on a bounded sample of labelled rows
   (``train_rows``, picked by a hash of the id); every path from a root to a
   node is a conjunctive rule "statistic <= / > cut and ...".
3. A lasso logistic regression over the rules (proximal gradient with
   momentum) leaves few rules with a weight.
4. Those rules are compiled into one Spark column, the score; it covers every
   row and stays inside the generated code.

Labels are only looked at for rows whose crc32(id as text) mod ``folds`` is
not 0. Only the text feeds a score.

Defined cases: a null text is the empty text; the empty text gets a score like
any other; labels that are null, or of ids not in the table, are passed over;
an id with several labels counts once per label; no usable labels give the
score 0.5, labels of one class a score near that class; an empty table gives
an empty result; repeated rows repeat.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm._common import table

Rule = tuple[tuple[str, bool, float], ...]  # (statistic, above?, cut) ...


# -- statistics --------------------------------------------------------------
def _share(text: Column, chars: str) -> Column:
    """Share of the text's characters that are in the regexp class ``chars``."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")) / F.greatest(F.length(text), F.lit(1))


def statistics(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> tuple[DataFrame, list[str]]:
    """``keep`` columns and the statistics of each text; and their names."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.split(text, "\n")
    d = df.select(*keep, text.alias("__t"), words.alias("__w"), lines.alias("__l"))
    n = F.greatest(F.size("__w"), F.lit(1)).cast("double")
    t = F.col("__t")
    stats = {
        "s_words": F.log1p(F.size("__w").cast("double")),
        "s_word_len": F.length(t) / n,
        "s_new_words": F.size(F.array_distinct("__w")) / n,
        "s_new_lines": F.size(F.array_distinct("__l")) / F.size("__l"),
        "s_lines": F.size("__l") / n,
        "s_upper": _share(t, r"\p{Lu}"),
        "s_digit": _share(t, "0-9"),
        "s_stop": _share(t, ".,;:?"),
        "s_symbol": _share(t, r"!|%&*$#@^~<>{}\[\]=_\\"),
    }
    return d.select(*keep, *[v.cast("double").alias(k) for k, v in stats.items()]), list(stats)


# -- rules from trees ----------------------------------------------------------
def _grow(codes: np.ndarray, grad: np.ndarray, hess: np.ndarray, cuts: list[np.ndarray], names: list[str],
          depth: int, least: int, path: Rule, rows: np.ndarray, rules: list[Rule], out: np.ndarray) -> None:
    """One tree on binned statistics; adds each node's path to ``rules`` and
    writes leaf values to ``out``."""
    g, h = grad[rows], hess[rows]
    out[rows] = -g.sum() / (h.sum() + 1.0)
    if depth == 0 or len(rows) < 2 * least:
        return
    best, total, weight = (1e-6, -1, -1), g.sum(), h.sum()
    for j, c in enumerate(cuts):
        if not len(c):
            continue
        k = codes[rows, j]
        gs = np.cumsum(np.bincount(k, g, len(c) + 1))[:-1]
        hs = np.cumsum(np.bincount(k, h, len(c) + 1))[:-1]
        ns = np.cumsum(np.bincount(k, minlength=len(c) + 1))[:-1]
        gain = gs ** 2 / (hs + 1) + (total - gs) ** 2 / (weight - hs + 1) - total ** 2 / (weight + 1)
        gain[(ns < least) | (len(rows) - ns < least)] = 0
        i = int(gain.argmax())
        if gain[i] > best[0]:
            best = (float(gain[i]), j, i)
    _, j, i = best
    if j < 0:
        return
    above = codes[rows, j] > i
    for side in (False, True):
        step = (*path, (names[j], side, float(cuts[j][i])))
        rules.append(step)
        _grow(codes, grad, hess, cuts, names, depth - 1, least, step, rows[above == side], rules, out)


def grow_rules(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = 24, depth: int = 3,
               bins: int = 64, least: int = 10, rate: float = 0.3) -> list[Rule]:
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]))[:bins] for j in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    rules: list[Rule] = []
    score = np.full(len(y), math.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        step = np.zeros(len(y))
        _grow(codes, p - y, p * (1 - p), cuts, names, depth, least, (), np.arange(len(y)), rules, step)
        score += rate * step
    return list(dict.fromkeys(rules))


def rule_matrix(x: np.ndarray, names: list[str], rules: list[Rule]) -> np.ndarray:
    at = {n: i for i, n in enumerate(names)}
    out = np.ones((len(x), len(rules)))
    for r, rule in enumerate(rules):
        for name, above, cut in rule:
            out[:, r] *= (x[:, at[name]] > cut) == above
    return out


def lasso_logistic(m: np.ndarray, y: np.ndarray, penalty: float = 0.002, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights minimising mean log loss + penalty * |w|_1
    (rules scaled by their spread), by accelerated proximal gradient."""
    spread = np.maximum(m.std(axis=0), 0.01)
    z = (m - m.mean(axis=0)) / spread
    z1 = np.hstack([np.ones((len(z), 1)), z])
    v = np.ones(z1.shape[1])
    for _ in range(20):  # largest curvature, by power iteration
        v = z1.T @ (z1 @ v)
        top = np.linalg.norm(v)
        v /= top
    step = 1 / (0.25 * top / len(z) + 1e-9)
    w = np.zeros(z1.shape[1])
    w[0] = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    ahead, t = w.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z1 @ ahead, -30, 30)))
        new = ahead - step * (z1.T @ (p - y) / len(y))
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    weights = w[1:] / spread
    return float(w[0] - weights @ m.mean(axis=0)), weights


@dataclass(frozen=True)
class RuleModel:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self) -> Column:
        """The score over the statistics' columns."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            test = F.lit(True)
            for name, above, cut in rule:
                test = test & (F.col(name) > cut if above else F.col(name) <= cut)
            total = total + F.when(test, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


# -- fitting and scoring -------------------------------------------------------
def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", text_col: str = "text",
        id_col: str = "doc_id", folds: int = 5, train_rows: int = 20_000, **tree_options) -> RuleModel:
    """Fits on at most ``train_rows`` labelled rows outside fold 0; equal ones
    count once. Only their statistics come to the driver (nine numbers a row)."""
    sample = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__y"))
              .where("__y is not null and __id is not null").where(F.crc32(F.col("__id").cast("string")) % folds != 0)
              .orderBy(F.xxhash64("__id"), "__id", "__y").limit(train_rows))
    # at most train_rows rows of two numbers
    train = docs.select(id_col, text_col).join(F.broadcast(sample), F.col(id_col) == F.col("__id")).select("__id", "__y", F.col(text_col).alias("__text"))
    stats, names = statistics(train, "__text", keep=("__id", "__y"))
    # bounded after the join as well, however often ids repeat
    rows = (stats.distinct().orderBy(F.xxhash64("__id", "__y", *names), "__id", "__y", *names).limit(train_rows)
            .toPandas()).sort_values(["__id", "__y", *names])
    if not len(rows):
        return RuleModel(0.0, ())
    x, y = rows[names].to_numpy(dtype=float), (rows["__y"].to_numpy() > 0).astype(float)
    rules = grow_rules(x, y, names, **tree_options)
    if not rules:
        return RuleModel(math.log((y.sum() + 1) / (len(y) - y.sum() + 1)), ())
    bias, weights = lasso_logistic(rule_matrix(x, names, rules), y)
    return RuleModel(bias, tuple((r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6))


def score(docs: DataFrame, model: RuleModel, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
          threshold: float = 0.3) -> DataFrame:
    """``keep`` columns, score and predicted for every row."""
    stats, _ = statistics(docs, text_col, keep)
    return (stats.select(*keep, model.column().alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    out = score(docs, model)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted")
