import ast
from pathlib import Path

import corpus_pipeline
import weftlink
from weftlink.llm import common, lang_id

from .conftest import prose


def test_stages(spark, tmp_path):
    item = prose(800, 40)
    texts = [prose(k, 60) for k in range(30)] + [prose(3, 60), prose(4, 59) + " edit", prose(70, 30) + " " + item, "!!! 123", None, ""]
    rows = [(k, t, "en" if k % 5 else None, "s", len(t or ""), k) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = set(range(len(texts)))
    gone = [{33, 34, 35}, {3}, {31}, {32}]  # no letter; equal to 30, the larger; like 4; holds the item
    for (_, stage), drop in zip(corpus_pipeline.STAGES, gone, strict=False):
        docs = stage(spark, docs, str(tmp_path))
        want -= drop
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
        assert {r.doc_id for r in docs.collect()} == want
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == want


def test_empty_and_odd(spark, odd, none, tmp_path):
    spark.createDataFrame([(1, prose(800, 40))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (none, odd):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        docs.count()


def test_without_labels(spark, odd):
    assert lang_id.fit(odd.where("lang is null"))[0] == []
    assert corpus_pipeline.reject_language(spark, odd.where("lang is null"), "").count() == odd.where("lang is null").count()


def test_nothing_else_imports_this_subpackage():
    top = Path(weftlink.__file__).parent
    for path in top.rglob("*.py"):
        if "llm" not in path.relative_to(top).parts:
            for node in ast.walk(ast.parse(path.read_text())):
                names = [node.module or ""] if isinstance(node, ast.ImportFrom) else [a.name for a in node.names] if isinstance(node, ast.Import) else []
                assert not any("llm" in n.split(".") for n in names), path


def test_grown_heap_of_the_driver_is_cleaned(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "_rested", [float("-inf")], raising=False)
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(b.getCollectionCount() for b in beans if "Young" not in b.getName() and "Concurrent" not in b.getName())
    scratch = common.Scratch(spark)
    for share, cleaned in ((1.0, 0), (0.0, 1), (0.0, 0)):  # small enough; grown; grown, but cleaned just now
        monkeypatch.setattr(common, "HEAP_SHARE", share, raising=False)
        before = full()
        scratch.keep(spark.range(3), f"t{share}{cleaned}")
        assert (full() > before) == bool(cleaned)
