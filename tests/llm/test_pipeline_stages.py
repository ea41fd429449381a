"""The corpus pipeline: every stage on its predecessor's rows, and the whole."""

import re

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.cases import DOCS, frame
from tests.llm.test_python_operators import plain_text


def test_stages(spark, workdir):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "decontamination", "pii", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_SMALL).write.parquet(f"{workdir}/{name}")
        after = spark.read.parquet(f"{workdir}/{name}")
        before = {r["doc_id"]: r for r in docs.collect()}
        if name != "packing":
            assert after.dtypes == docs.dtypes
        kept[name] = rows = {r["doc_id"]: r for r in after.collect()}
        if name == "language":
            assert set(before) - set(rows) == {i for i, r in before.items() if not re.search(r"[^\W\d_]", r["text"] or "")}
        if name == "near_dedup":
            from shelfwise.llm.near_dedup import near_duplicates
            assert set(rows) == {r["doc_id"] for r in near_duplicates(docs).collect() if r["kept"]}
        if name == "decontamination":
            from shelfwise.llm.decontamination import contamination
            bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
            hit = {r["doc_id"]: r for r in contamination(docs, bench).collect() if r["hits"]}
            assert hit and all(rows[i]["text"] == r["text"] for i, r in before.items() if i not in hit)
            assert {i for i in before if i not in rows} == {i for i, r in hit.items() if 2 * len(r["hits"]) >= r["n_words"]}
            assert not [r for r in contamination(after, bench).collect() if r["hits"]]
            assert all(r["n_chars"] == len(r["text"]) for r in rows.values())
        if name == "pii":
            assert {i: r["text"] for i, r in rows.items()} == {i: plain_text(r["text"]) for i, r in before.items()}
        if name == "packing":
            assert set(rows) == set(before)
        docs = after
    whole = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(map(tuple, whole.select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(
        map(tuple, docs.select("doc_id", "piece", "length", "ids_crc32").collect()))


def test_languages_are_worked_out_once(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = corpus_pipeline.language(spark, docs, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_earlier_stages_leave_no_folder(spark):
    from shelfwise.llm.tables import names_in
    from shelfwise.session import ensure_checkpoint_dir

    before = set(names_in(spark, ensure_checkpoint_dir(spark)))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(30).drop("n_chars").selectExpr("*", "1 AS node", "'x' AS pii")
    out = corpus_pipeline.run_stages(spark, docs, SF_SMALL)
    assert out.select("doc_id").distinct().count() <= 30
    new = [n for n in names_in(spark, ensure_checkpoint_dir(spark)) if n not in before and n.startswith("corpus-pipeline")]
    assert len(new) == 1 and names_in(spark, f"{ensure_checkpoint_dir(spark)}/{new[0]}") == ["4-packing"]


def test_stages_on_odd_rows(spark):
    """No text, no letters, copies, a null id, no language; an empty table goes through as one."""
    docs = frame(spark, [(i, t) for i, t in DOCS])
    out = corpus_pipeline.run_stages(spark, docs, SF_SMALL)
    ids = {r["doc_id"] for r in out.collect()}
    lettered = {i for i, t in DOCS if t and re.search(r"[^\W\d_]", t)}
    assert ids <= lettered and {6, 10} <= ids and not {0, 1, 2, 3, 5, 7, 8} & ids  # copies and near copies of 4 and 6
    assert corpus_pipeline.run_stages(spark, docs.limit(0), SF_SMALL).collect() == []
