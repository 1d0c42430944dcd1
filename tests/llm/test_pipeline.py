"""The corpus pipeline against a plain version of its stages."""

from __future__ import annotations

from lodeworks.llm import mixing, secret_scan

from . import brute


def test_stages(spark, sf):
    import corpus_pipeline
    from lodeworks.llm import quality

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = corpus_pipeline.run(spark, sf).collect()
    bad = {r.doc_id for r in quality.op2_quality_rules(spark, sf).collect() if not r.kept}
    texts = {}
    for r in docs.collect():  # failing lines go, and then documents that fail or lost too much
        lines = [x for x in (r.text or "").split("\n") if not quality.line_fails(x)]
        chars = lambda t: sum(map(len, brute.SPACE.findall(t)))
        kept = not brute.quality(r.text)[5] and chars("\n".join(lines)) >= quality.MIN_KEPT * chars(r.text or "")
        assert kept == (r.doc_id not in bad)
        if kept:
            texts[r.doc_id] = "\n".join(lines)
    texts = {i: texts[i] for i, _, c in brute.components(sorted(texts.items())) if i == c}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    texts = {i: texts[i] for i, (_, hit, _) in brute.contamination(texts, items).items() if not hit}
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    found = {r.doc_id: r.spans for r in secret_scan.scan(spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")).collect()}
    for r in got:
        want, at = "", 0
        for s in found[r.doc_id]:
            if s.start >= at:
                want += texts[r.doc_id][at : s.start] + secret_scan.MASK
            at = max(at, s.end)
        assert r.text == want + texts[r.doc_id][at:] and r.n_chars == len(r.text)
        assert {(s.start, s.end) for s in found[r.doc_id]} >= {(a, b) for a, _, b, _ in brute.secrets(texts[r.doc_id])}
    assert len({r.position for r in got}) == len(got)
    assert all(r.slot * mixing.BLOCK <= r.position < (r.slot + 1) * mixing.BLOCK for r in got)


def test_columns(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns


def test_registered():
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 11)} | {"pipeline"} <= {q.split("_")[0] for q in entry.queries()}
    assert set(entry.oracle_sql()) <= set(entry.queries())
