"""The pipeline's stages and registration."""

import corpus_pipeline
import __spark_entry__
from tidewatch.llm.common import written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns, name
        assert 0 < docs.count() <= before, name
        before = docs.count()
    pieces = written(corpus_pipeline.STAGES[-1][1](spark, docs, SF), "test-pack")
    assert pieces.select("doc_id").distinct().count() == before
    run = written(corpus_pipeline.run(spark, SF), "test-run")
    assert sorted(map(tuple, run.drop("ids").collect())) == sorted(map(tuple, pieces.drop("ids").collect()))


def test_good_documents_stay(spark):
    """The filters drop no document that its label calls good and the base rules pass."""
    from tidewatch.llm import mil, quality_rules
    from tidewatch.llm.common import table

    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    good = labels.filter("quality = 1").select("doc_id")
    judged = quality_rules.judged(docs).join(good, "doc_id")
    assert judged.filter("not kept and not base_failed").count() == 0
    kept = mil.filtered(docs, mil.trained(docs, labels))
    assert good.join(docs.select("doc_id"), "doc_id").join(kept.select("doc_id"), "doc_id", "left_anti").count() == 0


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1


def test_batches_give_memory_back():
    """What a batch left free between live objects doesn't stay with a worker that waits."""
    import re
    from pathlib import Path

    import pyarrow as pa

    from tidewatch.llm.tokens import slices

    def anonymous() -> float:
        return int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024

    blocks = [bytes(2000) for _ in range(100_000)]
    live = blocks[::1000]
    full = anonymous()
    del blocks
    for _ in slices(pa.record_batch({"text": ["a", None]}), "text"):
        pass
    assert len(live) == 100 and full - anonymous() > 120
