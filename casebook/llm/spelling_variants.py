"""Operator 11: spelling variants of words, by a variable-length gram index.

Words are counted over all documents. Their grams (``low`` to ``high`` code
points of the word padded with ``high - 1`` marks on each side) are counted
over the vocabulary, and the dictionary of *common* grams is pruned by
frequency: common is what occurs more than ``limit`` times. ``limit`` is at
least ``least`` and at least all gram occurrences / ``dictionary``, so fewer
than ``dictionary`` grams are common at any size; they are broadcast.

A word is decomposed into variable grams: at each place the shortest gram
that is not common (``high`` code points at most), without those that lie
inside an earlier one. The affected-gram bound of a word is the largest
number of its grams that one inserted, deleted or replaced code point can
change:

* grams that hold the place of the edit, and
* grams right of it that a gram over the edit could newly cover: it is at most
  ``high`` long, and all of it but its end is common (or shorter than ``low``).

Grams wholly left of an edit always stay, as a longer gram over the edit
would have covered them before. At least one gram outlasts any edit: the
first one, or, where the first letter is hit, the last one. So two near words
share |grams| - bound grams of either, at the same place from the left or the
right. Sorted by (frequency, gram, place), the first bound + 1 grams of near
words therefore meet; only these lists are merged, by equal (gram, place,
length), and the pairs that meet are verified by edit distance inside the
join, so that unverified pairs never leave it. Lists of grams that stay common
at ``high`` code points are split into blocks; a probe goes to all of them.

Forms grow at least ``ratio``-fold in n, so chains are logarithmic and roots
follow by pointer doubling.

Defined cases: a null text has no words; a null doc_id counts as the empty
string in the hashed text; repeated rows count each; an empty table gives an
empty result; other columns are not read; texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm._common import table, written

LETTERS = "[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEFT, RIGHT = "^", "$"  # marks; words hold letters only
LOW, HIGH = 2, 5
#: Fewer grams than this are ever common, whatever the vocabulary.
DICTIONARY = 1 << 17
LEAST = 32
BLOCK = 2000  # words of a common gram's list that one block holds, about


def word_counts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_length: int = 6,
                min_count: int = 5, one_in: int = 199) -> DataFrame:
    """(word, n): the words of at least ``min_length`` code points that occur
    ``min_count`` times. Runs whose hash ``one_in`` divides lose a code point."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTERS}{{{min_length},}}"), F.lit(0))).alias("run"))
    lowered = runs.select("id", F.when(F.regexp(F.col("run"), F.lit("[A-Z]")), F.translate("run", _UPPER, _LOWER)).otherwise(F.col("run")).alias("run"))
    hashed = lowered.select("run", F.crc32(F.concat_ws(":", "id", "run")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run"))
    return (hashed.select(word.alias("word")).where(F.char_length("word") >= min_length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


def _padded(word: Column, high: int) -> Column:
    return F.concat(F.lit(LEFT * (high - 1)), word, F.lit(RIGHT * (high - 1)))


def gram_dictionary(words: DataFrame, low: int = LOW, high: int = HIGH, dictionary: int = DICTIONARY, least: int = LEAST) -> dict[str, int]:
    """The common grams of the vocabulary with their frequencies: fewer than
    ``dictionary``, as each has more than 1 / dictionary of all occurrences."""
    size = F.char_length("word") + 2 * (high - 1)
    total = words.agg(F.sum(sum((size - q + 1 for q in range(low, high + 1)), F.lit(0)))).first()[0] or 0
    limit = max(least, math.ceil(total / dictionary))
    places = words.select(_padded(F.col("word"), high).alias("t")).select("t", F.explode(F.sequence(F.lit(1), F.char_length("t") - low + 1)).alias("p"))
    grams = places.select(F.explode(F.array(*[F.struct(F.substring("t", F.col("p"), F.lit(q)).alias("g"), F.lit(q).alias("q"))
                                              for q in range(low, high + 1)])).alias("x"))
    common = (grams.where(F.char_length("x.g") == F.col("x.q")).groupBy(F.col("x.g").alias("g")).agg(F.count("*").alias("n"))
              .where(F.col("n") > limit))
    return {r.g: r.n for r in common.toLocalIterator()}


def decompose(word: str, common, low: int = LOW, high: int = HIGH) -> tuple[str, list[tuple[int, int]]]:
    """The padded word and its variable grams as (start, end), left to right."""
    text = LEFT * (high - 1) + word + RIGHT * (high - 1)
    grams, reach = [], 0
    for p in range(len(text) - low + 1):
        e, top = p + low, min(p + high, len(text))
        while e < top and text[p:e] in common:
            e += 1
        if e > reach:
            grams.append((p, e))
            reach = e
    return text, grams


def affected_bound(text: str, grams: list[tuple[int, int]], common, low: int = LOW, high: int = HIGH) -> int:
    """The most grams that one edit of a letter can change."""
    worst, first, last = 0, high - 1, len(text) - high + 1
    for i in range(first, last + 1):
        near = [(p, e) for p, e in grams if e > i and p < i + high]
        if i < last:  # the letter at i replaced or deleted
            hit = sum(p <= i or (e - i <= high and (e - 2 - i < low or text[i + 1:e - 1] in common)) for p, e in near)
            worst = max(worst, hit)
        hit = sum(p < i or (1 + e - i <= high and (e - 1 - i < low or text[i:e - 1] in common)) for p, e in near)
        worst = max(worst, hit)  # a letter inserted before i
    return worst


def _lists(common: dict[str, int], low: int, high: int):
    """Arrow function: each word with the grams whose lists it is merged in."""
    kind = pa.list_(pa.struct([("gram", pa.string()), ("pos", pa.int32()), ("blocks", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.value
        for batch in batches:
            out = []
            for word in batch.column("word").to_pylist():
                text, grams = decompose(word, known, low, high)
                bound = affected_bound(text, grams, known, low, high)
                ranked = sorted((known.get(text[p:e], 0), text[p:e], p) for p, e in grams)
                out.append([{"gram": g, "pos": p, "blocks": 1 + n // BLOCK} for n, g, p in ranked[:bound + 1]])
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(out, kind)], ["word", "n", "grams"])

    return run


def near_pairs(words: DataFrame, low: int = LOW, high: int = HIGH, dictionary: int = DICTIONARY, least: int = LEAST) -> DataFrame:
    """(a, a_n, b, b_n): each pair of ``words`` (word, n) at edit distance 1,
    once."""
    spark = words.sparkSession
    common = spark.sparkContext.broadcast(gram_dictionary(words, low, high, dictionary, least))
    merged = written(words.select("word", "n").mapInArrow(
        _lists(common, low, high), "word string, n long, grams array<struct<gram:string,pos:int,blocks:int>>"), "grams")
    size = F.char_length("word")
    flat = merged.select("word", "n", size.alias("size"), F.explode("grams").alias("g"))
    listed = flat.select(F.xxhash64("g.gram", "g.pos", "size", F.pmod(F.hash("word"), F.col("g.blocks"))).alias("key"),
                         F.col("word").alias("b"), F.col("n").alias("b_n"))
    # an equally long word keeps the place; in a word longer by one, a gram
    # right of the edit is one place further
    probes = F.array(*[F.struct((F.col("g.pos") + d).alias("pos"), (F.col("size") + k).alias("size")) for d, k in ((0, 0), (0, 1), (1, 1))])
    asked = (flat.withColumn("probe", F.explode(probes)).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("g.blocks") - 1)))
             .select(F.xxhash64("g.gram", "probe.pos", "probe.size", "block").alias("key"), F.col("word").alias("a"), F.col("n").alias("a_n")))
    la, lb = F.char_length("a"), F.char_length("b")
    near = ((la < lb) | ((la == lb) & (F.col("a") < F.col("b")))) & (F.levenshtein("a", "b", 1) == 1)
    met = asked.hint("merge").join(listed, (asked["key"] == listed["key"]) & near)
    return met.groupBy("a", "b").agg(F.first("a_n").alias("a_n"), F.first("b_n").alias("b_n"))


def with_forms(words: DataFrame, pairs: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n): the near word of largest n (ties: first
    in code-point order) if that n is at least ``ratio`` times the word's."""
    both = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
                   F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    sided = pairs.select(F.explode(both).alias("x")).select("x.*")
    best = sided.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("o"), F.col("near").alias("near"))).alias("best"))
    out = words.join(best, "word", "left")
    take = -F.col("best.o") >= ratio * F.col("n")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(take, F.col("best.near")).alias("form"),
                      F.when(take, -F.col("best.o")).alias("form_n"))


def with_roots(forms: DataFrame, ratio: int = 5) -> DataFrame:
    """``forms`` with ``root``: the last word on the way along the forms. Each
    step multiplies n by ``ratio``, so the way is at most log(n) long and as
    many doublings as its logarithm find its end."""
    bounds = forms.where("form is not null").agg(F.min("n").alias("low"), F.max("form_n").alias("high")).first()
    steps = 0 if bounds.low is None else int(math.log(bounds.high / bounds.low, ratio) + 1e-9)
    hops = forms.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(steps - 1, 0).bit_length()):
        ahead = hops.select(F.col("word").alias("at"), F.col("root").alias("next"))
        hops = written(hops.join(ahead, hops["root"] == ahead["at"], "left")
                       .select("word", F.coalesce("next", "root").alias("root")), "hops")
    return forms.join(hops, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_length: int = 6, min_count: int = 5,
                      one_in: int = 199, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of ``docs``."""
    words = written(word_counts(docs, text_col, id_col, min_length, min_count, one_in), "words")
    forms = written(with_forms(words, near_pairs(words), ratio), "forms")
    return with_roots(forms, ratio).select("word", "form", "root", "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
