"""BPE against the tiktoken library, and the exact round trip."""

import base64
import hashlib
import random
import struct

import public_tokenizers as P
import tiktoken

from casebook.llm import bpe
from tests.llm.helpers import edge_docs


def _reference():
    file = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(file, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_merges_equal_the_library_on_generated_texts():
    ref, m, rnd = _reference(), bpe.merger(*bpe.default_tokenizer()), random.Random(1)
    alphabet = 'ab \n\t\x85\xa0\x1c\x1f​　éñ漢字"\'s12!!٣'
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(4000)]
    texts += ["a" * 5000, "ab" * 20000, "漢" * 3000, " " * 700, "it's I'LL 'S", "abcdefgh" * 100, "<|endoftext|>"]
    ids, bounds = m.encode(texts)
    for t, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == ref.encode_ordinary(t)
        assert m.decode(ids[a:b]) == [t.encode()]


def test_cache_overflow_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "_CACHE", 10)
    m = bpe.Merger(*bpe.default_tokenizer())
    texts = [f"word{i} other{i}" for i in range(50)]
    first = [m.encode([t])[0].tolist() for t in texts]
    assert first == [m.encode([t])[0].tolist() for t in texts]


def test_round_trip_on_edge_rows(spark):
    ref = _reference()
    df = edge_docs(spark)
    want = []
    for r in df.collect():
        ids = ref.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe.round_trip(df).collect()), key=repr) == sorted(want, key=repr)
    assert bpe.round_trip(df.limit(0)).count() == 0


def test_encode_then_decode(spark):
    df = edge_docs(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    back = bpe.decode(bpe.encode(df))
    got = {r["doc_id"]: bytes(r["bytes"]).decode() for r in back.collect()}
    assert got == {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}
