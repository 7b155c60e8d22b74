"""Operator 6: byte-level BPE encoding and decoding.

A text is split by the tokenizer's pattern; each piece is merged on its own.
A segment tree over the piece's byte positions holds, in each node, the
smallest (pair rank, position) below it: the root names the leftmost pair of
minimum rank. A merge touches three leaves (the pair's two positions and the
left neighbour) and their ancestors, so it costs a logarithm of the length.
Live neighbours are kept as next/previous indices.

Pieces are merged once per batch of texts and remembered in a bounded cache.
The trees of equally sized pieces are rows of one numpy array and advance
together; pieces beyond ``_LONG`` bytes get a tree of their own.

Defined cases: a null text is the empty text; the empty text has no ids and
decodes to no bytes; bytes that are not UTF-8 are read as U+FFFD; repeated
rows give repeated results; an empty table gives an empty result; other
columns are not read unless named.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm._common import table

_LONG = 512           # bytes; longer pieces get a tree of their own
_BATCH_CHARS = 1 << 20  # texts merged together
_CACHE = 1_000_000      # pieces remembered per worker
_NONE = np.int64(1) << 62
#: White space as the tokenizer's pattern engine sees it (Unicode White_Space).
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class Merger:
    """Merge ranks of one vocabulary, ready for encoding and decoding."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for t, r in ranks.items():
            for cut in range(1, len(t)):
                a, b = ranks.get(t[:cut]), ranks.get(t[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = r
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)
        negated = r"[^\s\p{L}\p{N}]"
        self.pattern = regex.compile(
            pattern.replace(negated, rf"[^{_SPACE}\p{{L}}\p{{N}}]").replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]"))
        order = sorted(self.bytes_of)
        self.token_size = np.zeros(order[-1] + 1, np.int64)
        self.token_size[order] = [len(self.bytes_of[i]) for i in order]
        self.token_start = np.cumsum(self.token_size) - self.token_size
        self.token_bytes = np.frombuffer(b"".join(self.bytes_of[i] for i in order), dtype=np.uint8)
        self.known = _Numbering()
        self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)

    # -- merging -----------------------------------------------------------
    def _rank(self, a: np.ndarray, b: np.ndarray, ok: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Leaf values: rank and position of the pairs (a, b); none where not ok."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = ok & (self.pair_keys[at] == key)
        return np.where(hit, self.pair_ranks[at] << 20 | pos, _NONE)

    def _merge_rows(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Pieces of at most ``width`` bytes (a power of two), all at once."""
        n = len(pieces)
        length = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(n, width)
        ids = self.byte_id[raw]
        col = np.arange(width)
        nxt = np.where(col + 1 < length[:, None], col + 1, width)  # width: no neighbour
        nxt = np.concatenate([nxt, np.full((n, 1), width)], axis=1)
        prv = np.concatenate([np.tile(col - 1, (n, 1)), np.zeros((n, 1), np.int64)], axis=1)
        alive = col < length[:, None]
        ids = np.concatenate([ids, np.zeros((n, 1), np.int64)], axis=1)
        tree = np.full((n, 2 * width), _NONE, dtype=np.int64)
        tree[:, width:] = self._rank(ids[:, :width], np.roll(ids, -1, axis=1)[:, :width], col + 1 < length[:, None], col)
        level = width
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level = half
        rows = np.flatnonzero(tree[:, 1] < _NONE)
        while len(rows):
            top = tree[rows, 1]
            left, token = top & 0xFFFFF, top >> 20
            right = nxt[rows, left]
            after, before = nxt[rows, right], prv[rows, left]
            ids[rows, left] = token
            alive[rows, right] = False
            nxt[rows, left] = after
            prv[rows, after] = left  # column ``width`` takes what has no neighbour
            tree[rows, width + right] = _NONE
            tree[rows, width + left] = self._rank(token, ids[rows, after], after < width, left)
            has = before >= 0
            b = np.where(has, before, 0)
            value = self._rank(ids[rows, b], token, has, b)
            tree[rows[has], width + b[has]] = value[has]
            for leaf, r in ((right, rows), (left, rows), (b[has], rows[has])):
                node = (width + leaf) >> 1
                while len(node) and node[0]:
                    tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
                    node = node >> 1
            rows = rows[tree[rows, 1] < _NONE]
        ids, alive = ids[:, :width], alive
        flat, counts = ids[alive].tolist(), alive.sum(axis=1).tolist()
        out, at = [], 0
        for c in counts:
            out.append(tuple(flat[at:at + c]))
            at += c
        return out

    def _merge_one(self, piece: bytes) -> tuple[int, ...]:
        """One long piece."""
        n = len(piece)
        width = 1 << (n - 1).bit_length()
        shift = width.bit_length()
        none = 1 << 62
        ids = self.byte_id[np.frombuffer(piece, dtype=np.uint8)].tolist()
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        get = self.pairs.get
        tree = [none] * (2 * width)
        for i in range(n - 1):
            r = get(ids[i] << 32 | ids[i + 1])
            if r is not None:
                tree[width + i] = r << shift | i
        for i in range(width - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b

        def put(i: int, value: int) -> None:
            i += width
            tree[i] = value
            i >>= 1
            while i:
                a, b = tree[2 * i], tree[2 * i + 1]
                best = a if a < b else b
                if tree[i] == best:
                    return
                tree[i] = best
                i >>= 1

        def pair(i: int, j: int) -> int:
            r = get(ids[i] << 32 | ids[j])
            return none if r is None else r << shift | i

        while tree[1] < none:
            i, token = tree[1] & (1 << shift) - 1, tree[1] >> shift
            j = nxt[i]
            ids[i], ids[j] = token, -1
            nxt[i] = k = nxt[j]
            put(j, none)
            if k < n:
                prv[k] = i
                put(i, pair(i, k))
            else:
                put(i, none)
            if prv[i] >= 0:
                put(prv[i], pair(prv[i], i))
        return tuple(i for i in ids if i >= 0)

    def merge(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each piece."""
        out: list[tuple[int, ...]] = [()] * len(pieces)
        groups: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[i] = (whole,)
            elif len(p) > _LONG:
                out[i] = self._merge_one(p)
            elif p:
                groups.setdefault(1 << (len(p) - 1).bit_length(), []).append(i)
        for width, members in groups.items():
            step = max(1, (1 << 20) // width)
            for a in range(0, len(members), step):
                some = members[a:a + step]
                for i, ids in zip(some, self._merge_rows([pieces[i] for i in some], width)):
                    out[i] = ids
        return out

    # -- texts -------------------------------------------------------------
    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids begin
        (one entry more than texts)."""
        known = self.known
        if len(known) > _CACHE:
            known.clear()
            self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)
        split = [self.pattern.findall(t) for t in texts]
        sizes = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        at = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(sizes.sum()))
        if known.new:
            merged = self.merge([p.encode() for p in known.new])
            known.new = []
            counts = np.fromiter(map(len, merged), dtype=np.int64, count=len(merged))
            more = np.fromiter(chain.from_iterable(merged), dtype=np.int32, count=int(counts.sum()))
            self.flat = np.concatenate([self.flat, more])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
        counts = self.starts[at + 1] - self.starts[at]
        ids = self.flat[_spread(self.starts[at], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        return ids, ends[np.concatenate([[0], np.cumsum(sizes)])]

    def decode(self, ids: np.ndarray, bounds: np.ndarray | None = None) -> list[bytes]:
        """The bytes of each run of ids between consecutive bounds."""
        ids = np.asarray(ids, dtype=np.int64)
        bounds = np.array([0, len(ids)]) if bounds is None else bounds
        size = self.token_size[ids]
        out = self.token_bytes[_spread(self.token_start[ids], size)].tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])[bounds].tolist()
        return [out[a:b] for a, b in zip(ends, ends[1:])]


class _Numbering(dict):
    """Numbers pieces in the order they are first looked up; ``new`` lists
    those numbered since it was last emptied."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.new.append(piece)
        return n


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... (counts[0] of them), starts[1], ..."""
    total = int(counts.sum())
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return shift + np.arange(total)


_MERGERS: dict[tuple[str, str], Merger] = {}


def merger(rank_file: str, pattern: str) -> Merger:
    """The worker's Merger of a rank file (built once per worker process)."""
    key = (rank_file, pattern)
    if key not in _MERGERS:
        _MERGERS[key] = Merger(rank_file, pattern)
    return _MERGERS[key]


def _groups(column: pa.Array) -> Iterator[list[str]]:
    """The column's texts in groups of about _BATCH_CHARS."""
    group, size = [], 0
    for value in column:
        raw = value.as_py()
        text = "" if raw is None else raw.decode("utf-8", "replace")
        group.append(text)
        size += len(text)
        if size >= _BATCH_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def default_tokenizer() -> tuple[str, str]:
    import public_tokenizers as P
    return P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN


def encode(df: DataFrame, text_col: str = "text", out_col: str = "ids", keep: tuple[str, ...] = ("doc_id",),
           rank_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """``keep`` columns and the ids (array of int) of each row's text."""
    file, pat = (rank_file, pattern) if rank_file and pattern else default_tokenizer()
    src = df.select(*keep, F.col(text_col).cast("binary").alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema] + [f"`{out_col}` array<int>"])

    def run(batches):
        m = merger(file, pat)
        for b in batches:
            at = 0
            for g in _groups(b.column("__text")):
                ids, bounds = m.encode(g)
                arr = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(c).slice(at, len(g)) for c in keep] + [arr], names=[*keep, out_col])
                at += len(g)

    return src.mapInArrow(run, schema)


def decode(df: DataFrame, ids_col: str = "ids", out_col: str = "bytes", keep: tuple[str, ...] = ("doc_id",),
           rank_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """``keep`` columns and the bytes (binary) of each row's ids; null ids give null."""
    file, pat = (rank_file, pattern) if rank_file and pattern else default_tokenizer()
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema] + [f"`{out_col}` binary"])

    def run(batches):
        m = merger(file, pat)
        for b in batches:
            out = [None if x is None else m.decode(x)[0] for x in b.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(out, type=pa.binary())], names=[*keep, out_col])

    return df.select(*keep, ids_col).mapInArrow(run, schema)


def round_trip(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
               rank_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encodes each text, decodes the ids again, and returns per row the id,
    n_tokens, and the SHA-256 of the ids (little-endian unsigned 32-bit) and
    of the decoded bytes, without moving either out of the task."""
    file, pat = (rank_file, pattern) if rank_file and pattern else default_tokenizer()
    kind = df.select(id_col).schema[0].dataType.simpleString()
    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("__text"))

    def run(batches):
        m = merger(file, pat)
        for b in batches:
            n, a, d = [], [], []
            for g in _groups(b.column("__text")):
                ids, bounds = m.encode(g)
                raw = ids.astype("<u4").tobytes()
                n += np.diff(bounds).tolist()
                a += [hashlib.sha256(raw[4 * x:4 * y]).hexdigest() for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                d += [hashlib.sha256(x).hexdigest() for x in m.decode(ids, bounds)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return src.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
