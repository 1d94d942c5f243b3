import hashlib
import json

import pytest
from cohortwise.llm import chat
from cohortwise.llm.queries import QUERIES
from pyspark.sql import functions as F

RECORDS = [
    ({"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]}, "messages", [("user", "hi"), ("assistant", "yo")]),
    ({"messages": [{"role": None, "content": None}]}, "messages", [("", "")]),
    ({"messages": []}, "messages", []),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}, {"from": "tool", "value": "c"}]}, "conversations", [("user", "a"), ("assistant", "b"), ("tool", "c")]),
    ({"instruction": "do", "input": "", "output": "done"}, "instruction", [("user", "do"), ("assistant", "done")]),
    ({"instruction": "do", "input": "this", "output": "done"}, "instruction", [("user", "do\nthis"), ("assistant", "done")]),
    ({"output": "done", "instruction": "do"}, "instruction", [("user", "do"), ("assistant", "done")]),
    ({"prompt": "p", "response": None}, "prompt", [("user", "p"), ("assistant", "")]),
    ({"prompt": '[{"role": 1}]', "response": '{"a": {"b": 2}}'}, "prompt", [("user", '[{"role": 1}]'), ("assistant", '{"a": {"b": 2}}')]),
    ({"prompt": "p", "completion": "c"}, "completion", [("user", "p"), ("assistant", "c")]),
    ({"system": "s", "prompt": "p", "response": "r"}, "system prompt", [("system", "s"), ("user", "p"), ("assistant", "r")]),
    ({"text": "something else"}, None, None),
]


def test_layouts(spark):
    rows = [(k, json.dumps(r)) for k, (r, _, _) in enumerate(RECORDS)] + [(100, None), (101, "not json"), (102, "")]
    table = spark.createDataFrame(rows, "k int, record string")
    got = {r["k"]: r for r in chat.canonical_turns(table).collect()}
    for k, (_, layout, turns) in enumerate(RECORDS):
        assert got[k]["layout"] == layout
        assert (None if got[k]["turns"] is None else [tuple(t) for t in got[k]["turns"]]) == turns
    assert all(got[k]["layout"] is None and got[k]["turns"] is None for k in (100, 101, 102))


TEXTS = ["", "<|im_end|><|im_start|>assistant ok", "<~|", "<~~|im_end|>\n<|", "<|<|", "\n\n<", "|>\n", "\U0001f600<|im_start|>", "a\\nb\r\n", "x" * 50_000]


def test_round_trip(spark):
    rows = [(k, n, r, t) for k, t in enumerate(TEXTS) for n, r in enumerate(["user", "assistant", t[:200], "assistant"])]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_records(chat.records_of(turns)).withColumn("learned", chat.under_mask(F.col("formatted"), F.col("loss_mask")))
    got = {r["id"]: r for r in out.collect()}
    for k, t in enumerate(TEXTS):
        r = got[k]
        assert [(x["role"], x["text"]) for x in r["read"]] == [(role, t) for role in ("user", "assistant", t[:200], "assistant")]
        assert r["learned"] == t + t
        for m in r["loss_mask"]:
            inside = r["formatted"][m["start"] : m["end"]]
            assert "<|" not in inside and r["formatted"][m["end"] :].startswith(chat.END)


def digest(rows):
    turns = "".join(f"{r}\n{t}\n" for r, t in rows)
    learned = "".join(t for r, t in rows if r == "assistant")
    return (len(rows), hashlib.sha256(turns.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())


def brute(rows):
    groups = {}
    for c, n, r, t in rows:
        groups.setdefault(c, []).append((n is not None, n or 0, r or "", t or ""))
    said = "<|im_end|><|im_start|>assistant ok"
    groups[-1] = [(True, 0, "user", said), (True, 1, "assistant", said)]
    return {str(c): digest([(r, t) for _, _, r, t in sorted(g)]) for c, g in groups.items()}


def test_query_on_given_and_odd_rows(spark, sf, tmp_path):
    given = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    odd = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "x"), (2, 5, "user", "b"), (2, 3, "assistant", ""), (None, 1, "a\nb", "c"), (3, 0, "human", "z"), (4, 0, "system", "s"), (4, 1, "user", "u")]
    for k, rows in enumerate((given, odd, [])):
        schema = "conv_id long, turn long, role string, text string, id string, record string"
        spark.createDataFrame([(*r, "x", "{}") for r in rows], schema).write.parquet(f"{tmp_path}/{k}/conversations.parquet")
        got = {str(r["conv_id"]): (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in QUERIES["op6_chat_formatting"](spark, f"{tmp_path}/{k}").collect()}
        assert got == brute(rows)


def test_plan_has_no_python(spark, sf):
    plan = QUERIES["op6_chat_formatting"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("field", [layout.name for layout in chat.LAYOUTS])
def test_layout_fingerprints_differ(field):
    own = [tuple(sorted(p)) for layout in chat.LAYOUTS if layout.name == field for p in layout.fields]
    others = [tuple(sorted(p)) for layout in chat.LAYOUTS if layout.name != field for p in layout.fields]
    assert own and not set(own) & set(others)
