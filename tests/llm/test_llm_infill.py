from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import prose
from ordergrain.llm import infill

UNIT = re.compile(r"[^\n]*\n|[^\n]+")


def plain(key, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return key, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return key, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return key, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(docs, rows, **options):
    made = infill.fill_in_middle(docs, **options).withColumn("restored", infill.restored()).collect()
    spm = options.pop("spm_share", 50)
    expected = [(*plain(k, t, spm=spm, **options), t or "") for k, t in rows]
    assert sorted(map(tuple, made), key=repr) == sorted(expected, key=repr)
    return made


@pytest.mark.parametrize("options", [{}, {"rate": 40}, {"spm_share": 0}, {"spm_share": 100, "seed": 11}, {"rate": 0}])
def test_against_units_one_by_one(documents, options):
    chosen = random.Random(3)
    letters = ["a", "é", "\U0001f600", "\n", "\n", " ", "\r\n", "<", "P", "S>", ">", "<S", "\x0b", "\u2028"]
    rows = [(k, "".join(chosen.choices(letters, k=chosen.randrange(0, 40)))) for k in range(300)]
    made = check(documents(rows), rows, **options)
    assert {r.form for r in made} >= ({"plain"} if options.get("rate") == 0 else {"plain", "spm"} - ({"spm"} if options.get("spm_share") == 0 else set()))


def test_awkward_rows(documents, awkward):
    check(documents(awkward), awkward)


def test_marks_leave_a_text_plain(documents):
    rows = [(k, f"one\ntwo {mark} three\n") for k, mark in enumerate(("<P>", "<S>", "<M>", "<PS>", "< M>"))]
    made = {r.doc_id: r.form for r in check(documents(rows), rows)}
    assert [made[k] == "plain" for k in range(5)] == [True, True, True, False, False]


def test_slices_do_not_change_rows(documents, monkeypatch):
    rows = [(k, "\n".join(prose(k + j, 30) for j in range(k % 9))) for k in range(60)]
    monkeypatch.setattr(infill.slices, "__defaults__", (500,))
    check(documents(rows), rows)


def test_other_key_and_columns(spark):
    rows = [("x", "a\nb\nc"), (None, "d\ne"), ("x", "a\nb\nc")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "name string, body string, output string")
    made = infill.fill_in_middle(df, key="name", text="body")
    assert made.columns == ["name", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert sorted(map(tuple, made.collect()), key=repr) == sorted((plain(*r) for r in rows), key=repr)


def test_empty_table(documents):
    made = infill.fill_in_middle(documents([]))
    assert made.where(F.lit(True)).collect() == []
