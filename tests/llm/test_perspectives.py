"""Operator 7 against its SQL and a plain-Python rendering; no Python in its plan."""

import duckdb

from llm_helpers import SF_SMALL, as_rows
from refillscope.llm.perspectives import SQL, rotate_perspectives


def brute_force(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append(((turn is not None, turn or 0), role or "unknown", text or "", turn))
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: r[:3])
        for who in {r[1] for r in own} - {"system"}:
            at = 0
            for k, (_, speaker, text, turn) in enumerate(own):
                role = "system" if speaker == "system" else "assistant" if speaker == who else "user"
                head = f"<|im_start|>{role}" + (f" name={speaker}" if role == "user" else "") + "\n"
                rendered = head + text + "<|im_end|>\n"
                learn = (at + len(head), at + len(rendered) - 1) if role == "assistant" else (None, None)
                out.append((conv, who, k, turn, role, speaker if role == "user" else None, rendered, at, at + len(rendered), *learn))
                at += len(rendered)
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_whole_table(spark):
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    out = rotate_perspectives(turns)
    want = brute_force([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])
    assert as_rows(out) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_SMALL}/conversations.parquet'")
    got = con.execute(f"SELECT {', '.join(out.columns)} FROM ({SQL})").fetchall()
    assert sorted(got, key=repr) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_edge_cases(spark):
    rows = [(1, 700, "ann", "hé"), (1, 3, "bob", None), (1, 3, "bob", None), (1, None, None, "x"), (1, 255, "system", ""), (1, 256, "cy", "y" * 50_000),
            (2, 0, "system", "alone"), (None, 0, "ann", "lost"), (3, -5, "ann", "a"), (3, -300, "ann", "b")]
    turns = frame(spark, rows).selectExpr("*", "1 as block", "2 as perspective", "3 as size", "4 as start")
    assert as_rows(rotate_perspectives(turns)) == brute_force(rows)
    assert as_rows(rotate_perspectives(frame(spark, []))) == []


def test_long_conversation(spark):
    rows = [(7, k, f"p{k % 3}", "t" * (k % 11)) for k in range(2_000)]
    assert as_rows(rotate_perspectives(frame(spark, rows))) == brute_force(rows)
