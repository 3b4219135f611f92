"""The pipeline's stages against the operators' plain versions."""

import corpus_pipeline
import __spark_entry__ as entry_points
from stockcast.llm.text import materialize
from tests.llm import plain
from tests.llm.conftest import SF, as_rows, frame


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(materialize(stage(spark, seen[-1], SF)))
    start, clean, single, apart, masked, packed = seen
    assert all(x.columns == docs.columns for x in seen[:-1])
    assert 0 < clean.count() <= start.count()
    texts = {}
    for doc_id, text in as_rows(clean):
        texts.setdefault(" ".join(["", *(text or "x").split(), ""]), []).append(doc_id)
    assert sorted(k for k, _ in as_rows(single)) == sorted(min(x) for x in texts.values())
    groups = plain.jaccard_groups(as_rows(single))
    assert sorted(k for k, _ in as_rows(apart)) == sorted(k for k, (_, root) in groups.items() if k == root)
    assert [k for k, _ in sorted(as_rows(masked))] == [k for k, _ in sorted(as_rows(apart))]
    assert not any(plain.base_spans(t) for _, t in as_rows(masked))
    assert {r[0] for r in packed.select("doc_id").collect()} == {k for k, _ in as_rows(masked)}


def test_stages_on_empty_and_odd_tables(spark, edge, empty):
    for rows in (empty, edge, frame(spark, [(1, None, None, None, None), (1, None, None, None, None)])):
        docs = rows
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF))
        assert docs.count() == 0 if rows is empty else docs.count() > 0


def test_registered(spark):
    names = entry_points.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
