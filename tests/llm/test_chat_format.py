from pyspark.sql import functions as F

from millrace.llm import chat_format, queries
from tests.conftest import SMALL
from tests.llm.helpers import ODD_TEXTS

SCHEMA = "conv_id long, turn long, role string, text string"


def test_escape_is_undone_on_all_texts(spark):
    texts = [t for t in ODD_TEXTS if t is not None] + ["<s><\\s><\\\\s></s>[INST][\\INST]<<SYS>><|im_start|>", "<<</s>", "\\<s>"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for there, back in ((chat_format.escape, chat_format.unescape), (chat_format.escape_role, chat_format.unescape_role)):
        assert rows.where(back(there(F.col("t"))) != F.col("t")).count() == 0
    free = rows.where(F.rlike(chat_format.escape(F.col("t")), F.lit(r"</?s>|\[/?INST\]|<\|im_(start|end)\|>|<</?SYS>>")))
    assert free.count() == 0


def test_odd_turns_come_back(spark):
    turns = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(ODD_TEXTS)]
    turns += [(2, None, "tool\nx%0A", "a"), (2, 1, None, None), (2, 1, "assistant", "z"), (2, 1, "assistant", "z")]
    turns += [(None, 0, "assistant", "<|im_end|>\n")]
    given = spark.createDataFrame(turns, SCHEMA).withColumn("formatted", F.lit("clash")).withColumn("_place", F.lit(9))
    out = {r["conv_id"]: r for r in chat_format.format_conversations(given).collect()}
    assert set(out) == {1, 2, None} and all(r["round_trip"] for r in out.values())
    assert [t["text"] for t in out[1]["turns"]] == [t or "" for t in ODD_TEXTS]
    assert [(t["role"], t["text"]) for t in out[2]["turns"]] == [("tool\nx%0A", "a"), ("", ""), ("assistant", "z"), ("assistant", "z")]
    for r in out.values():
        masked = [r["formatted"][s["start"] : s["end"]] for s in r["loss_spans"]]
        assert masked == [t["raw"] for t in r["turns"] if t["role"] == "assistant"]


def test_empty_table(spark):
    assert chat_format.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_reads_the_loss_spans_and_the_verdict(spark, monkeypatch):
    right = {r["conv_id"]: r for r in queries.op5_chat_format(spark, SMALL).collect()}
    assert right[-7]["loss_chars"] == len("</s>[INST] ok [/INST]")
    whole = chat_format.format_conversations
    moved = F.transform("loss_spans", lambda s: F.struct((s["start"] + 1).alias("start"), s["end"].alias("end")))
    monkeypatch.setattr(chat_format, "format_conversations", lambda df: whole(df).withColumn("loss_spans", moved))
    for r in queries.op5_chat_format(spark, SMALL).collect():
        assert (r["loss_sha256"] != right[r["conv_id"]]["loss_sha256"]) == (right[r["conv_id"]]["loss_chars"] > 0)
    monkeypatch.setattr(chat_format, "format_conversations", lambda df: whole(df).withColumn("round_trip", F.lit(False)))
    assert all(r["loss_sha256"] is None and r["loss_chars"] is None for r in queries.op5_chat_format(spark, SMALL).collect())
