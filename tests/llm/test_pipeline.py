import corpus_pipeline as cp
from tessera.llm.common import table
from tessera.llm.decontamination import contamination
from tessera.llm.near_duplicates import near_duplicates
from tessera.llm.secrets import secret_report
from tessera.llm.toxicity import toxicity

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = table(spark, SMALL, "documents")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(cp.STAGES):
        before = docs
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / f"{k}"))
        docs = spark.read.parquet(str(tmp_path / f"{k}"))
        if name != "packing":
            assert docs.columns == columns
        ids = {r["doc_id"] for r in docs.collect()}
        kept[name] = ids
        if name == "toxicity":
            scores = toxicity(before, table(spark, SMALL, "labels"))
            assert ids == {r["doc_id"] for r in scores.where("predicted = 0").collect()}
        elif name == "near_duplicates":
            assert ids == {r["doc_id"] for r in near_duplicates(before).where("kept").collect()}
        elif name == "decontamination":
            assert ids == {r["doc_id"] for r in contamination(before, table(spark, SMALL, "benchmark")).where("not contaminated").collect()}
        elif name == "secrets":
            assert ids == kept["decontamination"]
            assert {r["spans"] for r in secret_report(docs).collect()} == {""}
    assert kept["packing"] == kept["secrets"]


def test_run(spark):
    assert cp.run(spark, SMALL).count() > 0
