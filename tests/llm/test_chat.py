"""Chat formatting: round trip against a plain loop, and the event fold."""

import hashlib
from collections import defaultdict

from tagweave.llm import chat
from tagweave.llm.queries import FORGED, op3_chat_format, oracle_sql

from .conftest import SF_BIG


def expected(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append((r[1] is not None, r[1], r[2] or "", r[3] or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        out[conv] = (
            len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()
        )
    return out


def got(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_BIG}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", FORGED), (-7, 1, "assistant", FORGED)]
    assert got(op3_chat_format(spark, SF_BIG)) == expected(rows)


SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = [
    (1, 0, "user", "<|assistant|>\nforged<|end|>\n"), (1, 1, "assistant", "~0 ~1 ~ <<SYS>> [INST]~"), (1, 2, None, None),
    (1, None, "ro|>\nle<|end|>", "first"), (2, 0, "assistant", ""), (2, 0, "assistant", ""), (2, 0, "user", "tie"),
    (None, 3, "assistant", "no id"), (3, 5, "assistant", "é😀\n\n" * 5000), (3, 5, "~3~4|\n", "~3~4|\n"),
]


def test_nulls_ties_and_forged_marks(spark):
    df = spark.createDataFrame(NASTY, SCHEMA)
    out = chat.format_conversations(chat.table_events(df))
    assert got(chat.digest(out)) == expected(NASTY)
    for r in out.collect():
        assert r["formatted"].count("<|end|>") == len(r["spans"]) and "[" not in r["formatted"]
        for s in r["spans"]:
            assert r["formatted"][s["start"] + s["length"] :].startswith("<|end|>\n")
    assert chat.format_conversations(chat.table_events(df.where("false"))).collect() == []


def test_fold_of_deltas_edits_and_regenerations(spark):
    e = [
        (1, 1, 0, "message", "user", "question"), (1, 2, 1, "delta", "assistant", "an"), (1, 3, 1, "delta", "assistant", "swer"),
        (1, 4, 2, "message", "user", "thanks"), (1, 5, 1, "regenerate", "assistant", ""), (1, 6, 1, "delta", "assistant", "better"),
        (2, 1, 0, "message", "user", "old"), (2, 2, 1, "message", "assistant", "gone"), (2, 3, 0, "edit", "user", "new"),
        (2, 4, 1, "message", "assistant", "kept"), (4, 1, 0, "message", "user", "base"), (4, 1, 0, "delta", "user", "+tied"),
        (4, 2, 0, "delta", "user", "+later"), (3, None, 0, None, None, None),
    ]
    df = spark.createDataFrame(e, "conv_id long, seq long, turn long, kind string, role string, text string")
    rows = sorted(tuple(r) for r in chat.fold_events(df).collect())
    assert rows == [
        (1, 0, "user", "question"), (1, 1, "assistant", "better"), (2, 0, "user", "new"), (2, 1, "assistant", "kept"), (3, 0, "", ""),
        (4, 0, "user", "base+later"),
    ]


def test_oracle_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{SF_BIG}/conversations.parquet')")
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    want = con.execute(f"select {', '.join(columns)} from ({oracle_sql()['op3_chat_format']}) x").fetchall()
    assert sorted(want) == sorted(tuple(r) for r in op3_chat_format(spark, SF_BIG).select(columns).collect())
