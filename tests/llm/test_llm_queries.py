from collections import Counter
from pathlib import Path

import pytest
from compare import connect, differences
from llm_fixtures import prose, rows, table

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tripfold.llm import minhash_dedup, mixing, quality_cnn, quality_rules
from tripfold.llm.oracle import ORACLE
from tripfold.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no generated tables here")


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@here
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    """Against SQL where there is some; all read whole tables."""
    found = QUERIES[name](spark, SF_DIR)
    if name in ORACLE:
        ours, theirs, n = differences(found, connect(SF_DIR), ORACLE[name])
        assert n > 0 and (ours, theirs) == ([], [])
    else:
        source = {"op6_html_extract": "pages", "op12_whitening": "embeddings"}.get(name, "documents")
        whole = spark.read.parquet(f"{SF_DIR}/{source}.parquet")
        assert found.select(found.columns[0]).distinct().count() == whole.count()


def write_tables(folder, docs, spark):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], int("###" not in (r[1] or "###")), 0) for r in docs.select("doc_id", "text").collect()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_pipeline_stage_by_stage(spark, tmp_path):
    bad = [(5000 + i, prose(i, 120).replace(" ", "### "), "en", "a", 0, "", "", 0) for i in range(40)]
    good = [(6000 + i, " the of and ".join(prose(900 + i, 90).split(" ")), "en", "abc"[i % 3], 0, "", "", 0) for i in range(60)]
    write_tables(tmp_path, table(spark, rows() + bad + good), spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet")

    def ids(df):
        return Counter(r.doc_id for r in df.select("doc_id").collect())

    outputs = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out{number}")
        out = spark.read.parquet(f"{tmp_path}/out{number}")
        outputs.append((docs, out))
        docs = out
    (a, b), (c, d), (e, f), (g, h), (i, j) = outputs
    net = quality_cnn.learn(a, labels)
    assert ids(b) == ids(quality_cnn.score_documents(a, net).where("predicted = 1"))
    assert sum(ids(b)[5000 + k] for k in range(40)) <= 2 and sum(ids(b)[6000 + k] for k in range(60)) >= 58
    assert ids(d) == ids(quality_rules.judge(c).where("kept"))
    assert ids(f) == ids(minhash_dedup.near_duplicates(e).where("kept").distinct())
    assert ids(h) == ids(mixing.mixture(g, corpus_pipeline.MIX))
    assert j.agg({"length": "sum"}).first()[0] == j.where("start = 0").agg({"doc_tokens": "sum"}).first()[0]
    assert set(ids(j)) == set(ids(i))
    assert all(x.columns == a.columns for x in (b, d, f, h))


def test_pipeline_of_empty_tables(spark, tmp_path):
    write_tables(tmp_path, table(spark).limit(0), spark)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
