from __future__ import annotations

import hashlib
import random

from conftest import prose
from ordergrain.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
SPECIAL = ["\\", "#", "###", "####", "######", "</turn>", "</turn", ">", "\\h", "\\b", "\\e", ":", ": ", "\n", "### user: ", "é\U0001f600", "</turn>\n"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def conversations(rows):
    found = {}
    for key, turn, role, text in rows:
        found.setdefault(key, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {key: [said[2:] for said in sorted(turns)] for key, turns in found.items()}


def escaped(text, role=False):
    text = text.replace("\\", "\\b").replace("###", "\\h").replace("</turn>", "\\e")
    return text.replace(":", "\\c") if role else text


def expected_examples(rows):
    for key, turns in conversations(rows).items():
        text = ""
        for k, (role, said) in enumerate(turns, 1):
            text += f"### {escaped(role, True)}: {escaped(said)}</turn>\n"
            if role == "assistant" or k == len(turns):
                end = len(text) - len("</turn>\n")
                span = (end - len(escaped(said)), end) if role == "assistant" else (None, None)
                yield (key, k, k == len(turns), text, *span)


def expected_digests(rows):
    for key, turns in conversations(rows).items():
        loss = "".join(text for role, text in turns if role == "assistant")
        whole = sum(len(e[3]) for e in expected_examples(rows) if e[0] == key)
        yield key, len(turns), sha("".join(f"{role}\n{text}\n" for role, text in turns)), len(loss), sha(loss), whole


def check(df, rows):
    examples = chat.expand(df)
    assert sorted(map(tuple, examples.collect()), key=repr) == sorted(expected_examples(rows), key=repr)
    assert sorted(map(tuple, chat.digests(examples).collect()), key=repr) == sorted(expected_digests(rows), key=repr)


def test_every_reply_is_a_target_once(spark):
    roles = ["system", "user", "assistant", "user", "assistant", "assistant", "user"]
    rows = [(1, k, role, f"text {k}") for k, role in enumerate(roles)] + [(2, 0, "user", "alone"), (3, 5, "assistant", "reply")]
    df = spark.createDataFrame(rows[::-1], SCHEMA)
    check(df, rows)
    examples = chat.expand(df).where("conv_id = 1").orderBy("example").collect()
    assert [(e.example, e.last, e.loss_start is None) for e in examples] == [(3, False, False), (5, False, False), (6, False, False), (7, True, True)]
    assert all(e.text[e.loss_start : e.loss_end] == f"text {e.example - 1}" for e in examples[:3])
    assert examples[1].text.startswith(examples[0].text)


def test_control_strings_are_escaped_and_come_back(spark):
    chosen = random.Random(5)
    rows = []
    for key in range(60):
        for turn in range(chosen.randrange(1, 6)):
            role = chosen.choice(["assistant", "user", "a:b", "###", "x</turn>\n### user: y", "\\c"])
            rows.append((key, turn, role, "".join(chosen.choices(SPECIAL, k=chosen.randrange(0, 9)))))
    df = spark.createDataFrame(rows, SCHEMA)
    check(df, rows)
    for text in (r.text for r in df.select(chat.escaped(df.text).alias("text")).collect()):
        assert "###" not in text and "</turn>" not in text


def test_awkward_rows(spark):
    rows = [
        (1, 0, "user", None), (1, 1, None, "no role"), (1, None, "assistant", "no turn"), (1, 2, "assistant", None),
        (2, 0, "assistant", ""), (3, 0, "user", ""), (None, 1, "assistant", "no id"), (None, 0, "user", "no id"),
        (4, 1, "assistant", "same"), (4, 1, "assistant", "same"), (4, 1, "assistant", "other"), (4, 1, "user", "tie"),
        (5, 0, "user", prose(3, 30_000)), (5, 1, "assistant", prose(4, 30_000)), (None, None, None, None),
    ]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA + ", example int, turns string")
    check(df, rows)


def test_long_conversation(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"turn number {k}") for k in range(301)]
    check(spark.createDataFrame(rows, SCHEMA), rows)


def test_other_names(spark):
    df = spark.createDataFrame([("c", 0, "assistant", "hi")], "dialogue string, at int, who string, said string")
    made = chat.expand(df, key="dialogue", turn="at", role="who", text="said")
    assert made.columns == ["dialogue", "example", "last", "text", "loss_start", "loss_end"]
    assert tuple(chat.digests(made, key="dialogue").first()) == ("c", 1, sha("assistant\nhi\n"), 2, sha("hi"), 25)


def test_only_built_in_functions(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "hi")], SCHEMA)
    plan = chat.digests(chat.expand(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange ") == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert chat.expand(df).collect() == [] and chat.digests(chat.expand(df)).collect() == []
