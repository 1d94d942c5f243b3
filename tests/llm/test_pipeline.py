"""Every stage on its own input, against the brute-force versions of the operators' tests."""

import corpus_pipeline
import pytest
from cohortwise.llm import quality
from test_decontaminate import brute as leaks
from test_exact import brute as copies
from test_pack import check_places
from test_simhash import classes, plain_fingerprint


def ids(table):
    return sorted(r["doc_id"] for r in table.select("doc_id").collect())


@pytest.fixture(scope="module")
def stages(spark, sf, docs, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    tables = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], sf).write.parquet(f"{root}/{k}")
        tables.append(spark.read.parquet(f"{root}/{k}"))
    return tables


def test_columns_and_order(stages, docs):
    assert all(t.columns == docs.columns for t in stages[:-1])
    assert len(corpus_pipeline.STAGES) == 5


def test_stages(spark, sf, stages, docs):
    given, clean, single, apart, safe, packed = stages
    model = quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    assert ids(clean) == sorted(r["id"] for r in quality.score(given, model).filter("score >= 0.3").collect())
    rows = [(r["doc_id"], r["text"]) for r in clean.collect()]
    assert ids(single) == sorted(i for i, _ in copies(rows, "largest").values())
    rows = sorted((r["doc_id"], r["text"]) for r in single.collect())
    assert ids(apart) == sorted({rows[k][0] for k in classes([plain_fingerprint(t) for _, t in rows])})
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"]) for r in apart.collect()]
    hit = {int(r[0]) for r in leaks(rows, items)}
    assert ids(safe) == sorted(i for i, _ in rows if i not in hit)
    assert sorted({r["doc_id"] for r in packed.collect()}) == ids(safe)
    check_places(packed.collect(), 2048)


def test_run_equals_stages(spark, sf, stages):
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).select(*keys).collect())) == sorted(map(tuple, stages[-1].select(*keys).collect()))
