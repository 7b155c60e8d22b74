"""Operator 8: toxicity by a weighted finite-state pattern grammar.

Words become symbols: insult, threat, target (who is addressed), negation,
reported speech, other. Four transducers are composed over the symbols of a
clause: negation rewrites an insult or threat within a few words of a
negation, reported speech rewrites what follows a verb of saying, and an
insult, threat and target acceptor reads the result. The final state says
what the clause is: a plain, aimed, negated or reported insult or threat. Only
matched clauses count, never isolated words: a document's score is a logistic
function of its matched clauses by kind, with weights fitted to the labels.

The insult lexicon has fixed seed words and what the labels teach: word
beginnings (and whole words) that stand in toxic training documents far more
often than in others (log-likelihood ratio). Beginnings that clean documents
have too now and then are weak insults, a kind of their own. Training
documents that share their smallest shingle hash count as one, so that copies
teach nothing twice.

Labels are only looked at for rows whose crc32(id as text) mod ``folds`` is
not 1; the training sample has at most ``train_rows`` rows and the lexicon at
most ``most_patterns`` entries. Only the text feeds a score.

Defined cases: a null text is the empty text; a text without matched clauses
has the score of the bias alone; null labels are passed over; without usable
labels the seed words and default weights decide; an empty table gives an
empty result; repeated rows repeat.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm._common import table

INSULTS = """idiot idiots moron morons scum trash loser losers stupid pathetic worthless disgusting clown
 imbecile dumbass dumb bastard scumbag filth vermin freak garbage""".split()
THREATS = "kill killing murder hurt destroy burn stab shoot hang beat die".split()
TARGETS = """you your you're u ur he his him she her they them their this that these those
 du dich ihr sie euch tu toi vous il elle ils tú usted vosotros ellos""".split()
NEGATIONS = "not no never isn't aren't don't doesn't wasn't nobody nicht kein keine nie ne pas jamais nunca tampoco".split()
REPORTS = """said says say saying wrote writes called calls claimed claims quoted quotes according reported alleged
 sagte sagt dit disait dijo dice""".split()

# symbols of words: I(nsult) W(eak insult) T(hreat) Y(target) N(egation) R(eport) o(ther)
_SCOPE = 3  # words a negation reaches


class Transducer:
    """A deterministic letter transducer: step[state][symbol] = (state, out)."""

    def __init__(self, step: dict, start=0):
        self.step, self.start = step, start

    def then(self, other: "Transducer") -> "Transducer":
        """The composition: what this one writes, ``other`` reads."""
        start = (self.start, other.start)
        step, todo = {}, [start]
        while todo:
            s = todo.pop()
            if s in step:
                continue
            step[s] = {}
            for symbol, (a, mid) in self.step[s[0]].items():
                b, out = other.step[s[1]][mid]
                step[s][symbol] = ((a, b), out)
                todo.append((a, b))
        return Transducer(step, start)


def _negation() -> Transducer:
    """Writes i, t for an insult or threat within _SCOPE words of a negation."""
    step = {}
    for left in range(_SCOPE + 1):
        down = max(0, left - 1)
        step[left] = {x: (down, x) for x in "YRWo"} | {"N": (_SCOPE, "o")}
        step[left] |= {x: (down, x.lower() if left else x) for x in "IT"}
    return Transducer(step)


def _reported() -> Transducer:
    """Writes r for an insult or threat after a verb of saying."""
    return Transducer({0: {x: (0, x) for x in "ITWitYo"} | {"R": (1, "o")},
                       1: {x: (1, "r") for x in "ITit"} | {"Y": (1, "Y"), "W": (1, "W"), "o": (1, "o"), "R": (1, "o")}})


def _acceptor() -> Transducer:
    """State: (target seen, strongest find); writes nothing of use."""
    order = ["", "W", "r", "t", "i", "I", "T"]  # later is stronger
    step = {}
    for aimed in (0, 1):
        for find in order:
            row = {"o": ((aimed, find), ""), "Y": ((1, find), "")}
            for x in order[1:]:
                row[x] = ((aimed, max(find, x, key=order.index)), "")
            step[(aimed, find)] = row
    return Transducer(step, (0, ""))


GRAMMAR = _negation().then(_reported()).then(_acceptor())
KINDS = ["I0", "I1", "T0", "T1", "i", "t", "r", "W"]


def clause_kind(symbols: str) -> str | None:
    """What a clause (a string of word symbols) is; None: nothing matched."""
    state, step = GRAMMAR.start, GRAMMAR.step
    for x in symbols:
        state = step[state][x][0]
    aimed, find = state[1]
    return f"{find}{aimed}" if find in ("I", "T") else find or None


# -- words to symbols -----------------------------------------------------------
_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")
_MEMO = 500_000
_MATCH = re.compile("[ITW]")
PREFIXES = range(2, 9)


def core(token: str) -> str:
    return _EDGE.sub("", token.lower())


def patterns(word: str) -> list[str]:
    """What the lexicon may list of a word: beginnings, and 'word$'."""
    return [word[:k] for k in PREFIXES if len(word) >= k] + [word + "$"]


class Symbols(dict):
    """Token -> symbol, with ';' after a token that ends a clause."""

    def __init__(self, lexicon: dict[str, str]):
        self.strong = frozenset(p for p, s in lexicon.items() if s == "I")
        self.weak = frozenset(p for p, s in lexicon.items() if s == "W")

    def __missing__(self, token: str) -> str:
        word = core(token)
        if word in _FIXED:
            s = _FIXED[word]
        else:
            found = patterns(word)
            s = "o" if self.weak.isdisjoint(found) else "W"
            if not self.strong.isdisjoint(found):
                s = "I"
        if token[-1] in ".,;:!?":
            s += ";"
        if len(self) > _MEMO:
            self.clear()
        self[token] = s
        return s


_FIXED = ({w: "I" for w in INSULTS} | {w: "T" for w in THREATS} | {w: "Y" for w in TARGETS}
          | {w: "N" for w in NEGATIONS} | {w: "R" for w in REPORTS})


def clause_counts(text: str, symbols: Symbols) -> list[int]:
    """Matched clauses by kind."""
    line = "".join(map(symbols.__getitem__, text.split()))
    if not _MATCH.search(line):
        return [0] * len(KINDS)
    found = Counter(clause_kind(c) for c in line.split(";") if _MATCH.search(c))
    return [found[k] for k in KINDS]


def features(counts: np.ndarray) -> np.ndarray:
    """Per kind: any matched clause, at least two, and the log of their number."""
    counts = np.asarray(counts, dtype=float).reshape(-1, len(KINDS))
    return np.hstack([counts > 0, counts > 1, np.log1p(counts)])


# -- model -----------------------------------------------------------------------
@dataclass(frozen=True)
class Grammar:
    lexicon: dict[str, str]  # pattern -> I(nsult) or W(eak)
    bias: float
    weights: tuple[float, ...]

    def score(self, counts: np.ndarray) -> np.ndarray:
        z = self.bias + features(counts) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


#: Without labels: aimed clauses weigh most, negated and reported ones little.
_PRIOR = (2.0, 4.0, 2.0, 4.0, 0.0, 0.0, 0.0, 0.0) + (0.0,) * 8 + (0.5, 0.5, 0.5, 0.5, 0.0, 0.0, 0.0, 0.0)


def _text(value: pa.Scalar) -> str:
    raw = value.as_py()
    return "" if raw is None else raw.decode("utf-8", "replace")


def _signature(words: list[str]) -> int:
    """Smallest hash of the word 4-grams."""
    return min((xxhash.xxh64_intdigest(" ".join(words[i:i + 4])) for i in range(max(1, len(words) - 3))), default=0) >> 1


def _lexicon(train: DataFrame, least_ratio: float, least_rate: float, weak_rate: float,
             most: int) -> dict[str, str]:
    """Patterns by log-likelihood ratio of their documents."""
    def seen(batches):
        for b in batches:
            rows = []
            for t, y in zip(b.column("t"), b.column("y").to_pylist()):
                words = _text(t).split()
                rows.append((_signature(words), int(y), sorted({p for w in words for p in patterns(core(w)) if len(p) > 1})))
            yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["sig", "y", "found"]),
                                             schema=pa.schema([("sig", pa.int64()), ("y", pa.int32()), ("found", pa.list_(pa.string()))]),
                                             preserve_index=False)

    # one document per signature and label
    docs = train.mapInArrow(seen, "sig bigint, y int, found array<string>").dropDuplicates(["sig", "y"])
    counts = (docs.select("y", F.explode(F.concat("found", F.array(F.lit("")))).alias("p"))  # '' counts the documents
              .groupBy("p").agg(F.sum("y").alias("k1"), F.count(F.lit(1)).alias("n")))
    counts = counts.where("k1 >= 3 or p = ''")
    total = counts.where("p = ''").first()
    if total is None or not 0 < total["k1"] < total["n"]:
        return {}
    base = total["k1"] / total["n"]
    k1, k0 = F.col("k1").cast("double"), (F.col("n") - F.col("k1")).cast("double")
    part = F.when(k0 > 0, k0 * F.log(k0 / (F.col("n") * (1 - base)))).otherwise(0.0)
    g = 2 * (k1 * F.log(k1 / (F.col("n") * base)) + part)
    best = (counts.where("p != ''").withColumn("g", g)
            .where((F.col("g") >= least_ratio) & (F.col("k1") >= weak_rate * F.col("n")))
            .orderBy(F.desc("g"), "p").limit(most).collect())  # at most ``most`` rows
    return {r["p"]: "I" if r["k1"] >= least_rate * r["n"] else "W" for r in best}


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, prior: np.ndarray, ridge: float = 0.3, rounds: int = 60) -> tuple[float, np.ndarray]:
    """Newton steps of a logistic regression pulled towards ``prior``; row i
    stands for ``n[i]`` equal ones."""
    z = np.hstack([np.ones((len(x), 1)), x])
    pull = np.full(z.shape[1], ridge)
    pull[0] = 1e-3
    mid = np.concatenate([[-3.0], prior])
    w = mid.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        grad = z.T @ (n * (p - y)) + pull * (w - mid)
        step = np.linalg.solve((z * (n * (p * (1 - p) + 1e-6))[:, None]).T @ z + np.diag(pull), grad)
        w -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), w[1:]


def _counted(docs: DataFrame, lexicon: dict[str, str], keep: list[str]) -> DataFrame:
    """``keep`` columns and the clause counts of column t (binary)."""
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + ["counts array<int>"])

    def run(batches):
        symbols = Symbols(lexicon)
        for b in batches:
            counts = pa.array([clause_counts(_text(t), symbols) for t in b.column("t")], type=pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [counts], names=[*keep, "counts"])

    return docs.select(*keep, "t").mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", text_col: str = "text", id_col: str = "doc_id",
        folds: int = 3, train_rows: int = 20_000, most_patterns: int = 5_000, least_ratio: float = 30.0,
        least_rate: float = 0.9, weak_rate: float = 0.4) -> Grammar:
    sample = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__y"))
              .where("__y is not null and __id is not null").where(F.crc32(F.col("__id").cast("string")) % folds != 1)
              .orderBy(F.xxhash64("__id"), "__id", "__y").limit(train_rows))
    # at most train_rows rows of two numbers
    train = (docs.select(id_col, text_col).join(F.broadcast(sample), F.col(id_col) == F.col("__id"))
             .select((F.col("__y") > 0).cast("int").alias("y"), F.col(text_col).cast("binary").alias("t")))
    lexicon = _lexicon(train, least_ratio, least_rate, weak_rate, most_patterns)
    # at most train_rows rows of a few numbers, however often ids repeat
    rows = (_counted(train, lexicon, ["y"]).groupBy("y", "counts").count()
            .orderBy(F.desc("count"), "y", "counts").limit(train_rows).toPandas())
    if not len(rows):
        return Grammar(lexicon, -3.0, _PRIOR)
    rows["key"] = rows["counts"].map(tuple)
    rows = rows.sort_values(["y", "key"])
    x, y = features(np.array(rows["key"].tolist())), rows["y"].to_numpy(dtype=float)
    bias, w = _logistic(x, y, rows["count"].to_numpy(dtype=float), np.array(_PRIOR))
    return Grammar(lexicon, bias, tuple(w))


def score(docs: DataFrame, model: Grammar, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
          threshold: float = 0.7) -> DataFrame:
    """``keep`` columns, score, predicted and the matched clauses by kind
    (array in the order of KINDS) for every row."""
    src = docs.select(*keep, F.col(text_col).cast("binary").alias("t"))
    out = _counted(src, model.lexicon, list(keep))
    z = F.lit(model.bias)
    half = len(KINDS)
    for i in range(half):
        n = F.element_at("counts", i + 1).cast("double")
        z = (z + F.when(n > 0, model.weights[i]).otherwise(0.0) + F.when(n > 1, model.weights[half + i]).otherwise(0.0)
             + F.log1p(n) * model.weights[2 * half + i])
    out = out.withColumn("score", 1 / (1 + F.exp(-z)))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted")
