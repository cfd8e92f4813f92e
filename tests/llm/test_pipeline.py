from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline
from feedlake.llm import bpe, decontam, quality_rules, simhash
from feedlake.llm.common import table


def test_registration():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1


def test_stages_keep_columns_and_follow_each_other(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        nxt = corpus_pipeline.staged(stage(spark, out, sf_dir), "test-stage")
        assert nxt.columns == docs.columns
        if name == "quality rules":
            want = quality_rules.rule_report(out).where("kept").count()
        elif name == "SimHash near-dedup":
            want = simhash.near_duplicates(out).select("component_id").distinct().count()
        elif name == "benchmark decontamination":
            want = decontam.report(out, table(spark, sf_dir, "benchmark")).where("NOT contaminated").count()
        else:
            want = out.count()
            before = {r.doc_id: r.text for r in out.collect()}
            changed = [r for r in nxt.collect() if r.text != before[r.doc_id]]
            assert changed and all("[" in r.text for r in changed)
        assert nxt.count() == want
        out = nxt
    tokens = corpus_pipeline.run(spark, sf_dir)
    coder = bpe.codec(bpe.RANKS)
    texts = {r.doc_id: r.text for r in out.collect()}
    rows = tokens.collect()
    assert Counter(r.doc_id for r in rows) == Counter(texts.keys())
    for r in rows:
        assert r.round_trip and r.n_tokens == len(r.token_ids)
        assert coder.decode(bpe.np.array(r.token_ids, "<u4").tobytes()).decode() == texts[r.doc_id]


def test_pipeline_on_empty_and_null_rows(spark, sf_dir, docs_of):
    docs = docs_of([(None, None), (1, ""), (2, "plain words " * 3 + "and nine more to pass the rules of length")])
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, sf_dir)
        rows.collect()
