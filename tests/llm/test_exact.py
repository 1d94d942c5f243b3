import hashlib
from collections import defaultdict

import pytest
from cohortwise.llm import exact


def brute(rows, keep):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    pick = max if keep == "largest" else min
    return {t: (pick([i for i in g if i is not None], default=None), len(g)) for t, g in groups.items()}


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_odd_rows(odd, keep):
    got = [(r["row"]["doc_id"], r["row"]["text"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact.mark_copies(odd, keep=keep).collect()]
    want = brute([(r["doc_id"], r["text"]) for r in odd.collect()], keep)
    assert len(got) == odd.count()
    for i, text, keep_id, size, kept, digest in got:
        assert (keep_id, size) == want[text or ""]
        assert digest == hashlib.sha256((text or "").encode()).hexdigest()
        assert not kept or i == keep_id
    # exactly one row of each text stays, repeated rows and null ids included
    assert sorted(t or "" for _, t, _, _, kept, _ in got if kept) == sorted(want)


def test_stage_keeps_columns(odd, empty):
    kept = exact.drop_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len({r["text"] or "" for r in odd.collect()})
    assert exact.drop_copies(empty).count() == 0


def test_hot_text_is_split(spark):
    rows = spark.range(6000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'copy' WHEN id % 3 = 1 THEN concat('one', id) ELSE concat('two', id DIV 6) END AS text")
    marked = exact.mark_copies(rows, keep="largest").cache()
    hot = marked.filter("row.text = 'copy'")
    assert hot.count() == 2000
    assert {(r["keep_id"], r["group_size"]) for r in hot.select("keep_id", "group_size").distinct().collect()} == {(5997, 2000)}
    assert hot.filter("kept").count() == 1
    assert marked.filter("kept").count() == rows.select("text").distinct().count()


def test_plan_has_no_python(docs):
    plan = exact.mark_copies(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "rangepartitioning" in plan


def test_normalised(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, "A b"), (2, "a B"), (3, "c")], "doc_id long, text string")
    assert [r["doc_id"] for r in exact.drop_copies(rows, normalise=F.lower).orderBy("doc_id").collect()] == [1, 3]
