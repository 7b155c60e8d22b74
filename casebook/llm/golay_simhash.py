"""Operator 4: SimHash near-duplicates, joined by Golay-code keys.

A fingerprint is cut into three segments of 22, 21 and 21 bits, each padded to
a word of the perfect binary Golay code (23, 12, 7). A word's keys are the
codewords at distance 4 or less: one if its nearest codeword is at distance
0 to 2, six if at distance 3. Two words at distance 2 or less always share a
key (the codeword nearest to a word between them is within 4 of both).

If two fingerprints differ in at most 4 bits, then two of the three segments
together differ in at most 2 (pigeonhole: the segment with most errors has at
least two of four). So the pairs of keys of the two segments, for each of the
three choices, find every link: (key, key) is joined, then the distance is
verified on all 64 bits. The bound must be 4 or less.

Copies are folded first: fingerprints are distinct when keyed. A key that is
shared by m fingerprints gives at most m - 1 links, a spanning forest of the
verified links among them, never all pairs; keys with many fingerprints are
cut in pieces, and every pair of pieces is compared, so that no task holds or
compares an unbounded group. Classes come from alternating large-star and
small-star steps over those links, written to the shared checkpoint folder.

Defined cases: a null or blank text has fingerprint zero and links like any
other; a null id takes part, but a class is named by its smallest non-null
id; rows that repeat an id give one row each; an empty table gives an empty
result; other columns are kept by ``drop_near_duplicates`` and read nowhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm._common import checkpointed, table

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
_GENERATOR = 0xC75        # x^11+x^10+x^6+x^5+x^4+x^2+1 of the Golay code
_PIECE = 2048             # fingerprints of one key compared at once
_SHINGLES = 1 << 17       # hashes summed at once
_SALTS = 32               # parts of a class when its id is handed back


# -- fingerprints ------------------------------------------------------------
def fingerprint(text: bytes, words: int = 4) -> int:
    """SimHash of the word shingles: XXH64 (seed 42); a bit is set if it is
    set in over half the hashes. bytes.lower and bytes.split are ASCII only."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words, len(parts))
    a, b = starts[:len(parts) - k + 1].tolist(), ends[k - 1:].tolist()
    votes = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(a), _SHINGLES):
        h = np.array([digest(joined[x:y], 42) for x, y in zip(a[at:at + _SHINGLES], b[at:at + _SHINGLES])], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    value = 0
    for i in np.flatnonzero(2 * votes > len(a)).tolist():
        value |= 1 << i
    return value


def fingerprints(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", words: int = 4) -> DataFrame:
    """(doc_id, fp, th) for each row; fp is the fingerprint as a signed long,
    th a hash of the text that tells rows of one id apart."""
    kind = df.select(id_col).schema[0].dataType.simpleString()
    src = df.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).cast("binary").alias("t"))

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(x.as_py() or b"", words) for x in b.column("t")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64)), b.column("th")],
                                              names=["doc_id", "fp", "th"])

    return src.mapInArrow(run, f"doc_id {kind}, fp bigint, th bigint")


# -- Golay keys --------------------------------------------------------------
def _golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """(codeword of each message, keys of each 23-bit syndrome class): the
    error patterns that lead from a word to its keys depend on the syndrome
    only, so one row of up to six patterns per syndrome is enough."""
    codewords = np.zeros(4096, dtype=np.int64)
    for m in range(4096):
        word = m << 11
        rest = word
        for i in range(22, 10, -1):
            if rest >> i & 1:
                rest ^= _GENERATOR << (i - 11)
        codewords[m] = word | rest
    patterns = np.full((2048, 6), -1, dtype=np.int64)
    count = np.zeros(2048, dtype=np.int64)
    bits = [1 << i for i in range(23)]
    light = [0] + bits + [a | b for i, a in enumerate(bits) for b in bits[i + 1:]] + [
        a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[i + 1:], i + 1) for c in bits[j + 1:]]
    light += [x | d for x in light[1 + 23 + 253:] for d in bits if d > x]
    e = np.array(light, dtype=np.int64)
    s = syndrome(e)
    for p, k in zip(e.tolist(), s.tolist()):
        patterns[k, count[k]] = p
        count[k] += 1
    return codewords, patterns


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator polynomial."""
    rest = words.copy()
    for i in range(22, 10, -1):
        rest = np.where(rest >> i & 1, rest ^ (_GENERATOR << (i - 11)), rest)
    return rest


_TABLES: list = []


def segment_keys(words: np.ndarray) -> np.ndarray:
    """(n, 6) messages (12 bits) of the codewords within 4 of each word; -1
    where a word has fewer."""
    if not _TABLES:
        _TABLES.extend(_golay_tables())
    p = _TABLES[1][syndrome(words)]
    return np.where(p >= 0, (words[:, None] ^ p) >> 11, -1)


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all joint keys of the fingerprints (uint64)."""
    segs = [segment_keys((fp >> np.uint64(a)).astype(np.int64) & (1 << n) - 1) for a, n in SEGMENTS]
    rows, keys = [], []
    for c, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        a, b = segs[i][:, :, None], segs[j][:, None, :]
        ok = (a >= 0) & (b >= 0)
        key = (c << 24) | (a << 12) | b
        r = np.broadcast_to(np.arange(len(fp))[:, None, None], ok.shape)
        rows.append(r[ok])
        keys.append(key[ok])
    return np.concatenate(rows), np.concatenate(keys)


# -- links -------------------------------------------------------------------
def forest(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints: (a, b).

    Fingerprints are expanded breadth-first from one start after another, so
    a fingerprint is compared once with those not yet reached."""
    left = np.arange(len(fp))
    out_a, out_b = [], []
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(fp[left] ^ fp[x]) <= bits
            if near.any():
                found = left[near]
                out_a.append(np.full(len(found), fp[x]))
                out_b.append(fp[found])
                queue.extend(found.tolist())
                left = left[~near]
    if not out_a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(out_a), np.concatenate(out_b)


def _bucket_links(key: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal keys (sorted by key)."""
    cut = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]), [True]]))
    size = np.diff(cut)
    out = []
    # small groups: all pairs at a lag at once, then a forest per group is
    # left to the classes below
    small = np.repeat(size <= 8, size)
    for lag in range(1, 8):
        if len(key) <= lag:
            break
        hit = (key[lag:] == key[:-lag]) & small[lag:] & (np.bitwise_count(fp[lag:] ^ fp[:-lag]) <= bits)
        i = np.flatnonzero(hit)
        if len(i):
            out.append((fp[i], fp[i + lag]))
    for g in np.flatnonzero(size > 8).tolist():
        out.append(forest(fp[cut[g]:cut[g + 1]], bits))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


class _Union:
    """Union-find over fingerprints seen in one task, to drop links that
    close a circle before they are shuffled."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def new(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def links(fps: DataFrame, bits: int = 4) -> DataFrame:
    """(a, b) of linked fingerprints among the distinct ``fps`` (fp bigint):
    for each class of linked ones at least a spanning tree."""
    if not 0 <= bits <= 4:
        raise ValueError("the keys find links of up to 4 bits")

    def keyed(batches):
        for b in batches:
            fp = b.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(fp), 2048):
                part = fp[at:at + 2048]
                rows, keys = golay_keys(part)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(part[rows].view(np.int64))], names=["key", "fp"])

    keys = fps.select("fp").mapInArrow(keyed, "key int, fp bigint")
    # pieces of large keys: the fingerprints of a key are numbered by hash
    # into pieces, and each pair of pieces becomes a group of its own
    heavy = checkpointed(keys.groupBy("key").count().where(F.col("count") > 2 * _PIECE)
                         .select("key", F.ceil(F.col("count") / _PIECE).cast("int").alias("pieces")))
    many = heavy.count() > 0
    if many:
        keys = keys.join(heavy, "key", "left")
        piece = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
        other = F.explode(F.when(F.col("pieces").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("pieces") - 1)))
        keys = keys.select("key", "fp", F.coalesce(piece, F.lit(0)).alias("p"), other.alias("o"))
        group = F.when(F.col("p") <= F.col("o"), F.struct(F.col("p"), F.col("o"))).otherwise(F.struct(F.col("o").alias("p"), F.col("p").alias("o")))
        keys = keys.select("key", group["p"].alias("g1"), group["o"].alias("g2"), "fp")
        by = ["key", "g1", "g2"]
    else:
        by = ["key"]

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        union = _Union()
        tail: pd.DataFrame | None = None

        def found(part: pd.DataFrame) -> pd.DataFrame:
            key = part["key"].to_numpy().astype(np.int64)
            if len(by) > 1:  # number the groups within this part
                g = part[by].to_numpy()
                key = np.concatenate([[0], np.cumsum((g[1:] != g[:-1]).any(axis=1))])
            a, b = _bucket_links(key, part["fp"].to_numpy().view(np.uint64), bits)
            keep = [union.new(x, y) for x, y in zip(a.tolist(), b.tolist())]
            keep = np.array(keep, dtype=bool)
            return pd.DataFrame({"a": a[keep].view(np.int64), "b": b[keep].view(np.int64)})

        for part in batches:
            if tail is not None:
                part = pd.concat([tail, part], ignore_index=True)
            last = (part[by] == part[by].iloc[-1]).all(axis=1).to_numpy()
            done = len(part) - int(last[::-1].cumprod().sum())
            tail = part.iloc[done:].copy()
            if done:
                yield found(part.iloc[:done])
        if tail is not None:
            yield found(tail)

    return keys.repartition(*by).sortWithinPartitions(*by).mapInPandas(linked, "a bigint, b bigint")


# -- classes -----------------------------------------------------------------
def classes(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with a link: root is the smallest node of
    its connected class. Alternates large-star and small-star until the links
    no longer change; each round is checkpointed."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            e = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            e = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = e.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        e = e.join(least, "a")
        if large:
            out = e.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = e.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return out.where("a != b").distinct()

    e = checkpointed(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def sign(x: DataFrame):
        return x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    mark = sign(e)
    while mark[0]:
        e = checkpointed(star(star(e, True), False))
        mark, old = sign(e), mark
        if mark == old:
            break
    roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", words: int = 4,
                    bits: int = 4) -> DataFrame:
    """(doc_id, fp, th, root, component_id) for each row: root is the smallest
    fingerprint of the class of linked documents, component_id their smallest
    id, th a hash of the row's text."""
    docs = checkpointed(fingerprints(df, text_col, id_col, words))
    fps = checkpointed(docs.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = classes(links(fps, bits))
    named = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", "root")
    # a class may hold a third of all fingerprints: its smallest id is summed
    # up before the shuffle and comes back to them in _SALTS parts
    linked = named.where("root is not null").withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(_SALTS)))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))))
    linked = linked.join(least, ["root", "salt"]).select("fp", "root", "component_id")
    alone = named.where("root is null").select("fp", F.col("fp").alias("root"), F.col("least").alias("component_id"))
    named = checkpointed(linked.union(alone))
    return docs.join(named, "fp").select("doc_id", "fp", "th", "root", "component_id")


def drop_near_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", words: int = 4,
                         bits: int = 4) -> DataFrame:
    """``df`` with one row of each class: the one of the smallest id (of the
    smallest text hash, where rows share that id)."""
    found = near_duplicates(df, text_col, id_col, words, bits)
    first = found.groupBy("root").agg(F.min(F.struct("doc_id", "th")).alias("k"))
    stay = first.select(F.col("k.doc_id").alias("__id"), F.col("k.th").alias("__th")).distinct()
    rows = df.withColumn("__own", F.xxhash64(text_col))
    return (rows.join(stay, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__th")))
            .dropDuplicates([id_col, "__own"]).select(*df.columns))


def op4_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
