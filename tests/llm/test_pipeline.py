"""Each stage on its own input, and the whole run."""

import hashlib

import corpus_pipeline as C
from casebook.llm import bpe, golay_simhash, mixing, quality_rules, secret_scan
from casebook.llm._common import table, written
from tests.llm.helpers import SF, edge_docs


def test_stages(spark):
    docs = table(spark, SF, "documents")
    kept = []
    for name, stage in C.STAGES:
        out = stage(spark, docs, SF)
        kept.append((docs, out := written(out, name)))
        docs = out
    for _, out in kept[:-1]:
        assert out.columns == C.COLUMNS
    # 1: exactly the documents the classifier accepts, unchanged
    src, out = kept[0]
    ok = {r.doc_id for r in quality_rules.score(src, quality_rules.fit(src, table(spark, SF, "labels"))).where("predicted = 1").collect()}
    assert {r.doc_id for r in out.collect()} == ok and 0 < len(ok) < src.count()
    assert out.subtract(src.select(*C.COLUMNS)).count() == 0
    # 2: one document of each class, the smallest id
    src, out = kept[1]
    assert sorted(r.doc_id for r in out.collect()) == sorted({r.component_id for r in golay_simhash.near_duplicates(src).collect()})
    # 3: nothing is found any more, clean documents unchanged
    src, out = kept[2]
    before = {r.doc_id: (r.text, r.spans) for r in secret_scan.scan_digest(src).join(src.select("doc_id", "text"), "doc_id").collect()}
    after = {r.doc_id: r for r in out.collect()}
    assert set(before) == set(after)
    for d, (text, spans) in before.items():
        assert (after[d].text == text) == (not spans)
        assert spans == "" or after[d].n_chars == len(after[d].text)
    assert all(not r.spans for r in secret_scan.scan_digest(out).collect())
    # 4: each document as often as taken
    src, out = kept[3]
    times = {r.doc_id: r.taken // r["size"] if r["size"] else 0 for r in mixing.mix_sources(src).collect()}
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {d: n for d, n in times.items() if n}
    # 5: the ids decode to the texts
    src, out = kept[4]
    back = bpe.decode(out)
    sha = lambda rows, c: sorted((r.doc_id, hashlib.sha256(r[c].encode() if isinstance(r[c], str) else bytes(r[c])).hexdigest()) for r in rows)
    assert sha(back.collect(), "bytes") == sha(src.collect(), "text")
    assert sorted(map(tuple, C.run(spark, SF).select("doc_id", "n_tokens").collect())) == sorted(map(tuple, out.select("doc_id", "n_tokens").collect()))


def test_edge_rows_pass_every_stage(spark):
    docs = edge_docs(spark)
    for _, stage in C.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() <= 2 * docs.count()
        if "text" in out.columns:
            docs = out
    empty = edge_docs(spark).limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, empty, SF).count() == 0
