from __future__ import annotations

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from fixtures import texts  # noqa: E402, F401

from eigenlake.llm import line_dedup  # noqa: E402
from eigenlake.llm.line_dedup import repeated_lines, within_distance, without_repeated_lines  # noqa: E402
from eigenlake.llm.queries import QUERIES  # noqa: E402


def edited(rng, text, edits):
    letters = list(text)
    for _ in range(edits):
        if not letters:
            break
        at, kind = rng.randrange(len(letters)), rng.random()
        if kind < 0.34:
            letters[at] = rng.choice("xyzß")
        elif kind < 0.67:
            letters.insert(at, rng.choice("xyzß"))
        else:
            letters.pop(at)
    return "".join(letters)


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(1500):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(10)))
        b = edited(rng, a, rng.randrange(4)) if a else "x"
        for distance in (0, 1, 2, 3):
            assert within_distance(a, b, distance) == (brute.levenshtein(a, b) <= distance)


def test_letters_bound_edits():
    # Never refuses a pair within the distance, also beyond the four bits of a counter.
    rng = random.Random(5)
    for _ in range(300):
        a = "".join(rng.choice("aab é漢") for _ in range(rng.randrange(1, 200)))
        b = edited(rng, a, 2)
        sums = [np.array([line_dedup._LETTER[list(t.encode())].sum(dtype=np.uint32)]) for t in (a, b)]
        assert line_dedup.near_letters(*sums, 2).all()


def corpus(rng):
    lines = [" ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(3, 16))) for _ in range(25)]
    rows = []
    for i in range(40):
        own = [edited(rng, rng.choice(lines), rng.choice([0, 0, 1, 2, 3, 4])) for _ in range(rng.randrange(5))]
        rows.append((i, "\n".join(own)))
    return [*rows, (50, None), (51, ""), (52, "\n\n"), (None, lines[0]), (None, lines[0]), (3, rows[3][1])]


def expected(rows, least_words=5, chars_per_edit=10, distance=2):
    lines = {}
    for i, text in rows:
        for number, line in enumerate((text or "").split("\n")):
            if len(brute.words(line)) >= least_words:
                lines.setdefault(line, set()).add((i is None, i or 0, number))
    every = list(lines)
    near = [
        (a, b)
        for k, a in enumerate(every)
        for b in every[:k]
        if abs(len(a) - len(b)) <= distance and brute.levenshtein(a, b) <= min(distance, min(len(a), len(b)) // chars_per_edit)
    ]
    root = brute.classes(lines, near)
    first = {}
    for line, places in lines.items():
        first[root[line]] = min(first.get(root[line], min(places)), min(places))
    return {p for line, places in lines.items() for p in places if p != first[root[line]]}


def test_equals_brute_force(texts, monkeypatch):
    # Keys of more than three lines are compared in blocks.
    monkeypatch.setattr(line_dedup, "BLOCK_ROWS", 3)
    rows = corpus(random.Random(8))
    found = repeated_lines(texts(rows)).collect()
    assert {(r.doc_id is None, r.doc_id or 0, r.line_no) for r in found} == expected(rows)


@pytest.mark.parametrize("chars_per_edit, distance", [(10, 2), (1, 2), (4, 3), (3, 1)])
def test_short_lines_equal_brute_force(texts, monkeypatch, chars_per_edit, distance):
    # Lines of 1 to 30 characters, some of one word; keys of more than five lines in blocks, small arrays of keys.
    monkeypatch.setattr(line_dedup, "BLOCK_ROWS", 5)
    monkeypatch.setattr(line_dedup, "PACKED_KEYS", 50)
    rng = random.Random(2)
    base = ["".join(rng.choice("abcé ß漢") for _ in range(rng.randrange(1, 31))) for _ in range(60)]
    base += ["Alle Rechte vorbehalten 2019", "Alle Rechte vorbehalten 2020"]
    rows = [(i, "\n".join(edited(rng, rng.choice(base), rng.choice([0, 1, 1, 2, 3])) for _ in range(4))) for i in range(60)]
    found = repeated_lines(texts(rows), distance, 1, chars_per_edit).collect()
    assert {(r.doc_id is None, r.doc_id or 0, r.line_no) for r in found} == expected(rows, 1, chars_per_edit, distance)


def test_very_long_line_and_columns_of_any_name(spark):
    long = "many words in one line " * 100_000
    rows = [(1, long + "a\nown", 1, 2, 3, 4), (2, long + "b\nother", 1, 2, 3, 4), (3, "\n" * 50_000, 1, 2, 3, 4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _drop int, _id int, _print int, `row.drop` int")
    kept = without_repeated_lines(frame)
    assert kept.columns == frame.columns
    assert {r.doc_id: (r.text, r._drop, r._id, r._print) for r in kept.collect()} == {
        1: (rows[0][1], 1, 2, 3), 2: ("other", 1, 2, 3), 3: ("\n" * 50_000, 1, 2, 3),
    }


def test_cleaned_documents(texts):
    line = "this very line is found in more than one document"
    rows = [(2, f"own words of two\n{line}\n"), (1, f"{line}\nshort"), (3, line), (4, "short\nshort"), (5, None), (6, "")]
    frame = without_repeated_lines(texts(rows))
    assert frame.columns == texts(rows).columns
    assert {r.doc_id: r.text for r in frame.collect()} == {
        1: f"{line}\nshort", 2: "own words of two\n", 4: "short\nshort", 5: None, 6: "",
    }
    assert without_repeated_lines(texts([])).collect() == []


def test_short_lines_and_scripts_without_spaces(texts):
    chinese = "我们在这里写下一行没有空格的文字"
    rows = [(1, f"All rights reserved.\n{chinese}\nx"), (2, f"own words\nAll rights reserved.\n \n{chinese}"), (3, " \nx\n你好")]
    every = repeated_lines(texts(rows), least_words=1).collect()
    assert {(r.doc_id, r.line_no) for r in every} == {(2, 1), (2, 3), (3, 1)}
    # By default short lines stay, whatever the script.
    assert {(r.doc_id, r.line_no) for r in repeated_lines(texts(rows)).collect()} == {(2, 3)}
    near = "一二三四五六七八九十" * 3
    found = repeated_lines(texts([(1, near), (2, near + "末")])).collect()
    assert [(r.doc_id, r.kept_doc_id) for r in found] == [(2, 1)]


def test_registered_query_takes_every_line(spark, tmp_path):
    rows = [(1, "All rights reserved."), (2, "own\nAll rights reserved.")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op7_line_dedup"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in found] == [(2, 1, 1, 0)]
