from __future__ import annotations

from corpuskit.operators import datasets, dialogue


def test_history_and_chat_of_a_long_conversation(spark):
    turns = [(1, t, "user" if t % 2 == 0 else "assistant", f"text {t}") for t in range(200)] + [(2, 0, "user", "alone")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    lines = [f"{r}: {x}" for _, _, r, x in turns[:200]]
    out = {(r["conv_id"], r["turn"]): r["history"] for r in dialogue.with_history(df).collect()}
    assert len(out) == 201 and out[(2, 0)] == ""
    assert all(out[(1, t)] == "\n".join(lines[:t]) for t in range(200))
    chats = {r["conv_id"]: (r["text"], r["turns"]) for r in dialogue.rendered_chat(df).collect()}
    assert chats[1] == ("".join(f"<|{r}|>\n{x}\n" for _, _, r, x in turns[:200]), 200)
    assert datasets.question_answer_pairs(df).count() == 100
