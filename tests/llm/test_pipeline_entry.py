import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import cases  # noqa: E402
from test_documents import base_spans, brute_components  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402


def test_stages_and_run(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, seen[-1], d)
        out.write.parquet(str(tmp_path / str(k)))
        seen.append(spark.read.parquet(str(tmp_path / str(k))))
    for df in seen[:-1]:
        assert df.columns == docs.columns
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in seen]
    assert ids[0] > ids[2] >= ids[3] == ids[4] == ids[5]
    texts = {r.doc_id: r.text for r in seen[2].collect()}
    want = brute_components(sorted(texts.items()), 5, 80, 100)
    assert ids[3] == {c for _, c in want.values()}
    assert not any(base_spans(r.text) for r in seen[4].collect())
    pieces = {tuple(r) for r in seen[5].drop("sequence_id", "offset").collect()}
    assert {r[0] for r in corpus_pipeline.run(spark, d).collect()} == {p[0] for p in pieces}


def test_registered():
    names = list(entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{k}" for k in range(1, 14)}


def test_stages_on_empty_input(spark):
    docs = cases.frame(spark).limit(0).selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0
