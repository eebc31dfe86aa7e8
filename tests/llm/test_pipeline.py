"""The stages on a small corpus, each against what it must do."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registry
import corpus_pipeline
from rowcast.llm.common import stored

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="shared tables not present")
def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "pii", "packing"]
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4] > 0.5 * counts[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_odd_rows_pass_every_stage(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "1.2.3.4 " * 50, None, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (False, True):
        frame = docs.limit(0) if empty else docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            frame = stored(stage(spark, frame, FOLDER), name)
        assert corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER).count() == 0 if empty else frame.count() >= 3


def test_rows_without_an_id_and_with_one_id_are_decided_by_their_text(spark):
    words = [f"word{i} more{i}" for i in range(60)]
    text = " ".join(words)
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").filter("text IS NOT NULL").orderBy("item_id").first().text
    rows = [(None, text), (None, text + " end"), (3, text), (3, "A clean text of another kind that shares its id."), (None, f"before {item} after"), (3, f"x {item}"), (4, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    path = stored(docs, "odd")
    kept = corpus_pipeline.keep_one_of_each_group(spark, path, FOLDER)
    assert sorted((r.doc_id, r.text) for r in kept.filter("text LIKE '%more%'").collect()) == [(3, text)]
    # The two rows around the item are near copies of each other.
    assert kept.count() == 5 and kept.columns == docs.columns
    clean = corpus_pipeline.drop_contaminated(spark, path, FOLDER)
    assert clean.count() == 6 and not [r for r in clean.collect() if item in (r.text or "")]


def test_no_plan_holds_many_exchanges(spark, monkeypatch):
    """The driver keeps threads and broadcasts for all exchanges of a plan at once."""
    texts = [" ".join(f"w{(i // 4) * 90 + j} v{i if j == 7 else j}" for j in range(60)) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame([(1, texts[3]), (2, "one two three")], "item_id long, text string")
    seen = {}

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")

    def counted(df, name):
        seen[name] = max(seen.get(name, 0), exchanges(df))
        return stored(df, name)

    for module in ("rowcast.llm.near_dedup", "rowcast.llm.components", "rowcast.llm.decontaminate", "corpus_pipeline"):
        monkeypatch.setattr(f"{module}.stored", counted)
    kept = corpus_pipeline.keep_one_of_each_group(spark, stored(docs, "docs"), FOLDER)
    seen["kept"] = exchanges(kept)
    assert kept.count() == 10
    assert corpus_pipeline.clean_rows(kept, items).count() == 9
    assert max(seen.values()) <= 12, seen


def test_every_operator_is_registered():
    names = registry.queries()
    assert all(sum(name.startswith(f"op{n}_") for name in names) == 1 for n in range(1, 14)) and "pipeline" in names
