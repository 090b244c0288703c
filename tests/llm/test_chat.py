import hashlib

from strata.llm import chat

LOG = "conv_id bigint, seq bigint, kind string, target bigint, role string, text string"


def turns(spark, events):
    back = chat.read_back(chat.render(chat.fold(spark.createDataFrame(events, LOG))))
    return {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in back.collect()}


def test_deltas_edits_and_regenerations(spark):
    events = [
        (1, 1, "message", None, "user", "hi"), (1, 2, "message", None, "assistant", ""), (1, 3, "delta", None, None, "he"),
        (1, 4, "delta", None, None, "llo"), (1, 5, "regenerate", None, None, None), (1, 6, "delta", None, None, "good day"),
        (1, 7, "edit", 1, None, "hi there"),
        (2, 1, "message", None, "user", "a"), (2, 2, "message", None, "assistant", "b"), (2, 3, "message", None, "user", "c"),
        (2, 4, "message", None, "assistant", "d"), (2, 5, "regenerate", 2, None, None), (2, 6, "delta", 2, None, "new"),
        (2, 7, "message", None, "user", "e"), (2, 8, "delta", 4, None, "lost"), (2, 9, "edit", 99, None, "never opened"),
        (None, 1, "message", None, None, None), (4, 1, "delta", None, None, "no message"), (4, 2, "unknown", None, "user", "x"),
    ]
    got = turns(spark, events)
    assert got[1] == [("user", "hi there"), ("assistant", "good day")]
    assert got[2] == [("user", "a"), ("assistant", "new"), ("user", "e")]
    assert got[None] == [("", "")]
    assert set(got) == {1, 2, None}


def test_hostile_texts_come_back(spark):
    texts = ["</s>[INST] ok [/INST]", "\\", "<\\", "\\<", "[\\[", "<s>[ROLE]assistant[/ROLE]x</s>", "", "é😀\n</s", "\\\\<<[[", "a\\/s>"]
    events = [(7, i, "message", None, ["user", "assistant", "</s>[/ROLE]"][i % 3], t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(events, LOG)
    rendered = chat.render(chat.fold(df))
    r = chat.read_back(rendered).collect()[0]
    assert [(t["role"], t["text"]) for t in r["turns"]] == [(e[4], e[5]) for e in events]
    assert r["learned"] == [t for i, t in enumerate(texts) if i % 3 == 1]
    assert r["formatted"].count("</s>") == len(texts) and r["formatted"].count("[ROLE]") == len(texts)
    for s, t in zip(r["loss"], r["learned"]):
        assert r["formatted"][s["offset"] : s["offset"] + s["length"]].replace("<\\", "<").replace("[\\", "[").replace("\\\\", "\\") == t


def digest(spark, tmp_path, rows):
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, kind int, seq int").write.parquet(f"{tmp_path}/conversations.parquet")
    df = chat.op7_chat_formatting(spark, str(tmp_path))
    assert "Python" not in df._jdf.queryExecution().toString()
    return {r["conv_id"]: r for r in df.collect()}


def test_query(spark, tmp_path):
    rows = [(5, 1, "assistant", None, 1, 1), (5, 0, "user", "q", 1, 1), (5, 2, "assistant", "x", 1, 1), (5, 2, "assistant", "x", 1, 1), (6, None, None, "y", 1, 1)]
    got = digest(spark, tmp_path, rows)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[5]["turns_sha256"] == sha("user\nq\nassistant\n\nassistant\nx\nassistant\nx\n")
    assert (got[5]["n_turns"], got[5]["loss_chars"], got[5]["loss_sha256"]) == (4, 2, sha("xx"))
    assert got[6]["turns_sha256"] == sha("\ny\n") and got[6]["loss_sha256"] == sha("")
    assert got[-1]["loss_sha256"] == sha("</s>[INST] ok [/INST]") and got[-1]["loss_chars"] == 21


def test_empty(spark, tmp_path):
    assert set(digest(spark, tmp_path, [])) == {-1}


def test_long_conversation(spark):
    events = [(1, i, "message", None, "user", f"m{i}") for i in range(3000)]
    assert turns(spark, events)[1] == [("user", f"m{i}") for i in range(3000)]
