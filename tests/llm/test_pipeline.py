"""The pipeline against brute force, stage by stage on what each was given."""

import re

import corpus_pipeline
from odd_rows import none, odd
from test_dedup import brute_components, brute_print
from test_packing import check_rows

from formlake.llm.quality import score_quality
from formlake.llm.toxicity import score_toxicity
from formlake.llm.written import written

FOLDER = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "exact_dedup", "simhash_dedup", "packing"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    columns, out = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = written(stage(spark, docs, FOLDER), f"test-{name}")
        assert name == "packing" or docs.columns == columns
    assert ids(out[1]) == ids(score_toxicity(out[0], labels).where("predicted = 0"))
    assert ids(out[2]) == ids(score_quality(out[1], labels).where("predicted = 1"))
    best = {}
    for r in out[2].collect():
        body = re.sub("[\x20\x09-\x0d]", "", r["text"])
        best[body] = min(best.get(body, (0, 1 << 62)), (-len(r["text"]), r["doc_id"]))
    assert ids(out[3]) == sorted(i for _, i in best.values())
    rows = sorted((r["doc_id"], r["text"]) for r in out[3].collect())
    roots = brute_components([brute_print(t) for _, t in rows], 4)
    assert ids(out[4]) == [rows[i][0] for i in sorted(set(roots))]
    check_rows(docs.collect(), [(r["doc_id"], r["text"]) for r in out[4].collect()])
    again = corpus_pipeline.run(spark, FOLDER)
    assert sorted(again.select("doc_id", "piece").collect()) == sorted(docs.select("doc_id", "piece").collect())


def test_odd_and_empty_tables(spark, folder):
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 1)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    for table in (odd, none):
        docs = table(spark)
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, folder), f"odd-{name}")
        assert (docs.count() > 0) == (table is odd)
