from __future__ import annotations

import random
import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from fixtures import sf_dir  # noqa: E402, F401

import __spark_entry__  # noqa: E402
import corpus_pipeline  # noqa: E402
from eigenlake.llm.queries import ORACLES, QUERIES  # noqa: E402
from eigenlake.llm.staging import Staging  # noqa: E402


def test_registered_queries():
    names = [name for name in __spark_entry__.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14)) and len(QUERIES) == 13
    assert set(ORACLES) <= set(QUERIES) and "pipeline" in __spark_entry__.queries()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "mixing"]


def test_planted_cases(spark, tmp_path):
    rng = random.Random(12)
    vocabulary = [f"word{i}" for i in range(500)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, prose(30)) for k in range(3)]
    rows, labels = [], []
    for i in range(300):
        text, toxic = "\n".join(prose(rng.randrange(8, 30)) for _ in range(3)), i % 10 == 0
        if toxic:
            text += " " + " ".join(rng.choice(["vile", "rotten"]) for _ in range(3))
        rows.append([i, text])
        labels.append((i, int(toxic), 1))
    passage = prose(60)
    for i in (11, 12, 13):
        rows[i][1] += "\n" + passage
    # A near copy that differs in every line, and a document with an item.
    rows[22][1] = "\n".join(line + " changed" for line in rows[21][1].split("\n"))
    long = prose(200)
    rows[31][1], rows[32][1] = long, long.replace(long.split()[100], "altered", 1)
    rows[41][1] += " " + items[1][1].upper()
    rows += [[900, None], [901, ""], [None, prose(20)]]
    frame = spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 2}", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    staging, docs, seen = Staging(spark, "test"), frame, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staging.keep(stage(spark, docs, str(tmp_path)), name)
        seen[name] = {r.doc_id: r for r in docs.collect()}
        if name != "mixing":
            assert docs.columns == frame.columns
    given = dict(map(tuple, rows))
    toxic = {i for i, t, _ in labels if t}
    assert set(seen["toxicity"]) == set(given) - toxic
    lines = seen["line_dedup"]
    assert set(lines) == set(seen["toxicity"])
    assert [passage in lines[i].text for i in (11, 12, 13)] == [True, False, False]
    assert all(lines[i].text == given[i] for i in lines if i not in (12, 13))
    assert set(lines) - set(seen["near_duplicates"]) == {32}
    assert set(seen["near_duplicates"]) - set(seen["decontamination"]) == {41}
    mixed = seen["mixing"].values()
    sizes, taken = Counter(), Counter()
    for r in seen["decontamination"].values():
        sizes[r.source] += len(brute.words(r.text))
    for r in mixed:
        taken[r.source] += r.taken
        assert 0 < r.taken <= 2 * r.size
    assert sum(taken.values()) in range(sum(sizes.values()) * 3 // 2 - 2, sum(sizes.values()) * 3 // 2 + 1)


def test_leftovers_of_near_copies_go(spark, tmp_path):
    rng = random.Random(2)
    word = lambda: f"word{rng.randrange(4000)}"
    lines = [" ".join(word() for _ in range(12)) for _ in range(12)]
    # A copy with one line changed beyond an edit: its other lines are repeated ones.
    rows = [(1, "\n".join(lines)), (2, "\n".join([*lines[:5], " ".join([*lines[5].split()[:6], *[word() for _ in range(6)]]), *lines[6:]]))]
    rows += [(i, "\n".join(" ".join(word() for _ in range(12)) for _ in range(8))) for i in range(3, 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    cleaned = Staging(spark, "test").keep(corpus_pipeline.line_dedup(spark, docs, str(tmp_path)), "lines")
    assert {r.doc_id: r.text.count("\n") for r in cleaned.collect()}[2] == 0
    kept = corpus_pipeline.near_duplicates(spark, cleaned, str(tmp_path))
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {2}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_run_over_documents(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert found and len({r.doc_id for r in found}) == len(found) and all(r.taken > 0 for r in found)
