from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ordergrain.llm import lines

BLANK = " \t\n\x0b\f\r"


def plain(rows, window):
    """Kept texts by all runs in corpus order; rows are in the order of their ids."""
    seen, found = {}, []
    for key, text in rows:
        parts = [] if text is None else text.split("\n")
        counting = [i for i, line in enumerate(parts) if line.strip(BLANK)]
        dead = set()
        for k in range(len(counting) - window + 1):
            places = counting[k : k + window]
            run, here = tuple(parts[i] for i in places), (key, text, k)
            if seen.setdefault(run, here) != here:
                dead.update(places)
        found.append((key, None if text is None else "\n".join(x for i, x in enumerate(parts) if i not in dead), len(parts), len(dead)))
    return found


def check(documents, rows, window):
    found = lines.remove_repeated_lines(documents(rows), window=window).collect()
    got = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in found]
    assert sorted(got, key=repr) == sorted(plain(rows, window), key=repr)


@pytest.mark.parametrize("window", [1, 2, 3, 5])
def test_against_all_runs(documents, window):
    chosen = random.Random(window)
    pool = [f"line {k}" for k in range(12)] + ["", "  ", "\t"]
    rows = [(k, "\n".join(chosen.choice(pool) for _ in range(chosen.randrange(0, 25)))) for k in range(60)]
    check(documents, rows, window)


def test_awkward_rows(documents, awkward):
    rows = sorted(awkward, key=lambda r: (r[0] is not None, r[0] or 0))
    check(documents, rows, 2)


def test_common_passage_is_kept_once(documents):
    rows = [(k, f"own {k}\nlicence one\nlicence two\n\nlicence three\nend {k}") for k in range(200)]
    found = lines.remove_repeated_lines(documents(rows)).orderBy("doc_id").collect()
    assert found[0].n_removed == 0 and {r.n_removed for r in found[1:]} == {3}
    assert found[7].text == "own 7\n\nend 7"


def test_other_columns_stay(documents, awkward):
    docs = documents(awkward)
    found = lines.remove_repeated_lines(docs)
    assert set(found.columns) == set(docs.columns) | {"n_lines", "n_removed"}
    assert found.where(F.col("kept") != 1).count() == 0


def test_empty_table(documents):
    assert lines.remove_repeated_lines(documents([])).collect() == []


def numbered(documents, rows):
    return documents(rows).select(F.col("doc_id").alias("id"), lines.text_row("doc_id", "text").alias("row"), "text")


@pytest.mark.parametrize("window", [2, 4, 8])
def test_fewer_fingerprints_than_windows(documents, window):
    texts = [(k, "\n".join(f"line {k} {j * 7919 % 101}" for j in range(100))) for k in range(30)]
    stored = lines.fingerprints(numbered(documents, texts), window).count()
    windows = 30 * (101 - window)
    assert stored < 1.15 * windows * 2 / (window + 1)


def test_equal_windows_share_their_fingerprint(documents):
    chosen = random.Random(3)
    window = 4
    rows = [(k, "\n".join(f"l{chosen.randrange(30)}" for _ in range(40))) for k in range(20)]
    found = lines.fingerprints(numbered(documents, rows), window).collect()
    reach = {(r.id, r.line): (len(r.before), len(r.after), r.print) for r in found}
    prints = {}
    for key, text in rows:
        parts = text.split("\n")
        for at in range(len(parts) - window + 1):
            # Exactly one fingerprint claims the window, the same one wherever the window stands.
            own = [
                (i - at, reach[key, i][2])
                for i in range(at, at + window)
                if (key, i) in reach and reach[key, i][0] >= i - at and reach[key, i][1] >= at + window - 1 - i
            ]
            assert len(own) == 1
            assert prints.setdefault(tuple(parts[at : at + window]), own[0]) == own[0]


def test_runs_are_maximal(documents):
    shared = "\n".join(f"shared {j}" for j in range(9))
    rows = [(1, f"a\n{shared}\nb"), (2, f"c\n{shared}\nd")]
    found = lines.repeated_runs(numbered(documents, rows), 4).collect()
    covered = {k for r in found for k in range(r.line, r.line + r.size)}
    assert covered == set(range(1, 10)) and {r.id for r in found} == {2} and max(r.size for r in found) > 4


@pytest.mark.parametrize("window", [2, 3])
def test_long_lines_go_alone(documents, window):
    long, other = "x" * 50, "y" * 50
    rows = [(1, f"a\n{long}\nb\n{other}"), (2, f"c\n{long}\nd"), (3, f"a\n{long}\nz"), (4, f"{other}\nshort"), (5, "short")]
    found = lines.remove_repeated_lines(documents(rows), window=window, alone=40).orderBy("doc_id").collect()
    third = "z" if window == 2 else "a\nz"
    assert [r.text for r in found] == [rows[0][1], "c\nd", third, "short", "short"]


def test_different_texts_of_one_id(documents):
    rows = [(1, "a\nb\nc"), (1, "x\na\nb"), (None, "a\nb"), (None, "q\nr")]
    found = lines.remove_repeated_lines(documents(rows)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in found) == [(0, "a\nb"), (0, "q\nr"), (1, "c"), (1, "x")]


def test_colliding_hashes_keep_texts_apart(documents, monkeypatch):
    monkeypatch.setattr(
        lines, "text_row", lambda key, text: F.struct(F.lit(7).cast("long").alias("a"), F.xxhash64(text, key).alias("b"))
    )
    rows = [(k, "\n".join(f"{k // 2} {j}" for j in range(k + 2))) for k in range(40)]
    check(documents, rows, 2)


def test_small_tables_are_joined_as_large_ones(documents):
    """No broadcast while the deleted runs are few, so that what is shuffled grows in proportion to the input."""
    rows = [(k, f"own {k}\nlicence one\nlicence two\nend {k}") for k in range(50)]
    found = lines.remove_repeated_lines(documents(rows))
    assert found.where("n_removed = 2").count() == 49
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
