from __future__ import annotations

import random
import re
import sys
from collections import Counter
from hashlib import sha256
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from fixtures import texts  # noqa: E402, F401

from eigenlake.llm import decontaminate, secrets, token_counts  # noqa: E402
from eigenlake.llm.decontaminate import contaminated, without_items  # noqa: E402
from eigenlake.llm.mixing import mix  # noqa: E402
from eigenlake.llm.secrets import find_secrets  # noqa: E402
from eigenlake.llm.token_counts import count_tokens  # noqa: E402
from eigenlake.llm.toxicity import fit_toxicity, maximal_segments, score_documents, without_toxic  # noqa: E402

ODD = [(9000, None), (9001, ""), (9002, " \n"), (None, "no id here"), (None, "no id here")]


# --- mixing ------------------------------------------------------------------------------


def test_mix_follows_targets(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 40)), f"s{min(rng.randrange(9), 4)}") for i in range(300)]
    rows += [(900, None, "s0"), (901, "a b", None), (902, "c", None), (None, "d e", "s1"), (5, rows[5][1], rows[5][2])]
    frame = spark.createDataFrame([(*r, 7, 1) for r in rows], "doc_id long, text string, source string, size int, rank int")
    found = mix(frame.repartition(5))
    assert found.columns == ["doc_id", "text", "source", "rank", "size", "source_size", "target", "finish", "taken"]
    out = found.collect()
    assert len(out) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in out:
        assert r.size == len(brute.words(r.text)) and 0 <= r.taken <= 2 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    names = sorted(s for s in sizes if s is not None) + [None]
    weights = dict(zip(names, [3, 1, 2] * len(names)))
    budget, open_ = 1.5 * sum(sizes.values()), set(names)
    wanted = {}
    while True:
        level = (budget - sum(wanted.values())) / sum(weights[s] for s in open_)
        over = {s for s in open_ if weights[s] * level > 2 * sizes[s]}
        if not over:
            break
        wanted |= {s: 2.0 * sizes[s] for s in over}
        open_ -= over
    wanted |= {s: weights[s] * level for s in open_}
    for s in names:
        assert target[s] == pytest.approx(wanted[s]) and taken[s] == int(wanted[s] + 1e-9)
    times = [r.finish for r in out if r.finish is not None]
    assert times == sorted(times)
    again = Counter((r.doc_id, r.taken) for r in mix(frame.repartition(2)).collect())
    assert again == Counter((r.doc_id, r.taken) for r in out)


def test_mix_keeps_columns_of_any_name(spark):
    frame = spark.createDataFrame([(1, "a b", "s", "x", 5, "y", 9), (2, "c " * 300_000, "t", "x", 5, "y", 9)],
                                  "doc_id long, text string, source string, _source string, Target int, `row.key` string, bucket int")
    found = mix(frame)
    assert found.columns == ["doc_id", "text", "source", "_source", "row.key", "bucket", "size", "source_size", "target", "finish", "taken"]
    assert sorted((r.doc_id, r.size, r._source, r["row.key"], r.bucket) for r in found.collect()) == [(1, 2, "x", "y", 9), (2, 300_000, "x", "y", 9)]


def test_mix_of_very_many_sources(spark):
    rows = [(i, "w " * (1 + i % 7), f"host{i:05d}") for i in range(3000)]
    found = mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)).collect()
    size, weight = {r[2]: 1 + r[0] % 7 for r in rows}, {r[2]: (3, 1, 2)[r[0] % 3] for r in rows}
    level = max(
        (1.5 * sum(size.values()) - sum(2 * size[s] for s in size if 2 * size[s] < weight[s] * at)) / sum(weight[s] for s in size if 2 * size[s] >= weight[s] * at)
        for at in {2 * size[s] / weight[s] for s in size}
    )
    assert all(r.target == pytest.approx(min(2 * size[r.source], weight[r.source] * level)) for r in found)
    assert sum(r.target for r in found) == pytest.approx(1.5 * sum(size.values()))


def test_mix_of_nothing(texts):
    assert mix(texts([])).collect() == []
    assert [(r.size, r.target, r.taken) for r in mix(texts([(1, None), (2, "")])).collect()] == [(0, 0.0, 0)] * 2


# --- toxicity ----------------------------------------------------------------------------


def test_maximal_segments():
    rng = np.random.default_rng(1)

    def slow(scores):
        # The definition: take the best segment, then do the same on either side of it.
        if not len(scores) or scores.max() <= 0:
            return []
        best = max(
            ((scores[a:b].sum(), a - b, -a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
            key=lambda t: (round(t[0], 9), t[1], t[2]),
        )
        a, b = -best[2], best[3]
        return [*slow(scores[:a]), (a, b, best[0]), *[(a2 + b, b2 + b, s) for a2, b2, s in slow(scores[b:])]]

    for _ in range(120):
        scores = rng.normal(-0.2, 1, rng.integers(0, 14))
        got, want = maximal_segments(scores), slow(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def toxic_corpus(seed=3):
    rng = random.Random(seed)
    prose = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        text = [rng.choice(prose) for _ in range(rng.randrange(20, 80))]
        bad = rng.random() < 0.2
        for _ in range(rng.randrange(1, 5) if bad else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["Vile", "rotten,", "nasty!", "FOUL"]))
        rows.append((i, " ".join(text)))
        labels.append((i, None if i % 50 == 7 else int(bad), 1))
    return rows, labels


def test_toxic_documents_are_found(spark, texts):
    rows, labels = toxic_corpus()
    docs = texts(rows + ODD)
    model = fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int, text int"), prior=50.0)
    found = score_documents(docs, model).collect()
    assert len(found) == len(rows) + len(ODD) and all(0 <= r.score <= 1 for r in found)
    truth = {i: toxic for i, toxic, _ in labels}
    held = [r for r in found if r.held_out and truth.get(r.doc_id) is not None]
    assert len(held) > 40 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    text = dict(rows)
    for r in found:
        for passage in r.passages:
            assert re.search("vile|rotten|nasty|foul", text[r.doc_id].lower()[passage.start : passage.end])
    assert all(r.predicted == 0 for r in found if r.doc_id is None or r.doc_id >= 9000)
    kept = without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in found if not r.predicted)


def test_late_passage_that_repeats_words(spark, texts):
    rows, labels = toxic_corpus()
    model = fit_toxicity(texts(rows), spark.createDataFrame(labels, "doc_id long, toxic int, text int"), prior=50.0)
    gap, dense = " ".join(["word1 word2 word3"] * 100), "vile rotten nasty foul"
    scattered = f" {gap} ".join(dense.split())
    given = [(1, f"{scattered} {gap} {dense} {gap} {dense} word5"), (2, f"{gap} {dense} {gap}")]
    found = {r.doc_id: r for r in score_documents(texts(given), model).collect()}
    cut = [given[0][1][p.start : p.end] for p in found[1].passages]
    assert cut.count(dense) == 2 and [given[1][1][p.start : p.end] for p in found[2].passages] == [dense]
    assert found[1].predicted == 1


def test_no_labels(spark, texts):
    docs = texts([(1, "a b c")])
    model = fit_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [(r.predicted, r.n_passages) for r in score_documents(docs, model).collect()] == [(0, 0)]
    assert score_documents(texts([]), model).collect() == []


# --- decontamination ---------------------------------------------------------------------


def brute_matches(rows, items, percent=80):
    out = {}
    for n, (i, text) in enumerate(rows):
        own = brute.plain(text)
        for item, wanted in items:
            want = brute.plain(wanted)
            # An item of fewer words than a shingle has windows of its own size.
            size = min(5, len(want))
            if not want or len(own) < size:
                continue
            bag, held = Counter(brute.shingles(want, size)), brute.shingles(own, size)
            best, span = 0.0, len(brute.shingles(want, size))
            for a in range(max(1, len(held) - span + 1)):
                window = Counter(held[a : a + span])
                best = max(best, sum((window & bag).values()) / sum((window | bag).values()))
            if 100 * best >= percent - 1e-9:
                out[n, i, item] = best
    return out


def test_items_are_found(spark, texts, monkeypatch):
    monkeypatch.setattr(decontaminate, "PASS_ITEMS", 5)
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(200)] + ["É", "the"]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(2, 45)))) for k in range(14)]
    items += [(20, None), (21, ""), (22, items[3][1]), (None, items[4][1]), (24, "the the the the the the the the the")]
    rows = []
    for i in range(60):
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        if i % 2:
            passage = brute.plain(items[rng.randrange(14)][1])
            for _ in range(rng.randrange(2)):
                passage[rng.randrange(len(passage))] = "changed"
            text[len(text) // 2 : len(text) // 2] = [w.upper() + rng.choice(["", ",", "!"]) for w in passage]
        rows.append((i, " ".join(text)))
    rows += ODD
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = contaminated(texts(rows), frame).collect()
    want = brute_matches(rows, items)
    assert Counter((r.doc_id, r.item_id, round(r.similarity, 9)) for r in found) == Counter(
        (i, item, round(value, 9)) for (_, i, item), value in want.items()
    )
    clean = without_items(texts(rows), frame)
    assert clean.columns == texts(rows).columns
    dirty = Counter({n: 1 for n, _, _ in want})
    assert Counter(r.doc_id for r in clean.collect()) == Counter(i for n, (i, _) in enumerate(rows) if not dirty[n])
    assert contaminated(texts([]), frame).collect() == []
    assert contaminated(texts(rows), spark.createDataFrame([], "item_id long, text string")).collect() == []


def test_short_items_inside_long_documents(spark, texts):
    items = [(1, "Blue whale"), (2, "whale"), (3, "a b c d"), (4, "blue whale"), (5, "whale blue"), (6, "a b c")]
    long = "word " * 20_000
    rows = [(1, f"{long} the BLUE, whale! {long}"), (2, f"{long} a b c x d"), (3, "whale"), (4, "blue"), (5, "a b c d"), *ODD]
    found = contaminated(texts(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert Counter((r.doc_id, r.item_id) for r in found) == Counter(
        [(1, 1), (1, 2), (1, 4), (2, 6), (3, 2), (5, 3), (5, 6)]
    )
    assert next(r.first_word for r in found if (r.doc_id, r.item_id) == (1, 4)) == 20_001


def test_byte_blocks_reach_every_print_within_the_radius():
    rng = np.random.default_rng(3)
    for _ in range(300):
        left = rng.integers(0, 256, 8).astype(np.uint8)
        bits = np.unpackbits(left)
        bits[rng.choice(64, rng.integers(0, decontaminate.RADIUS + 1), replace=False)] ^= 1
        right = np.packbits(bits)
        assert any(decontaminate._NEAR_BYTE[left[b], right[b]] for b in range(8))


# --- secrets -----------------------------------------------------------------------------


def base_spans(text):
    pattern = re.compile("(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
    found = [(m.start(), 0, m.end()) for m in pattern.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_secrets(texts):
    rng = random.Random(9)
    prose = ["Ünder", "the", "würde", "information", "characteristically", "andtheotherlongishwordhere", "é"]
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    make = lambda n, a=alphabet: "".join(rng.choice(a) for _ in range(n))
    rows, planted = [], {}
    for i in range(600):
        text = [rng.choice(prose) for _ in range(60)]
        if i % 10 == 0:
            planted[i] = make(64)
            text.insert(30, planted[i])
        if i % 10 == 1:
            text.insert(5, rng.choice(["PassWord = ", "api_key:'", "token=\"", "secret :  ", "paſsword="]) + make(rng.randrange(5, 14)))
        if i % 10 == 2:
            text.insert(9, "AKIA" + make(rng.randrange(10, 20), "ABCDEFGH0123456789"))
        if i % 10 == 3:
            text.insert(50, make(rng.randrange(28, 45), "0123456789abcdef"))
        rows.append((i, " ".join(text)))
    rows += ODD
    out = find_secrets(texts(rows)).collect()
    assert len(out) == len(rows)
    text, hits = dict(rows), 0
    for r in out:
        own = text[r.doc_id] or ""
        base = base_spans(own)
        written = [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == sha256(",".join(written).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for _, k, _ in base) for n in range(3)]
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("random")] == written
        for span in spans:
            kind, a, b = span.split(":")
            if kind == "random":
                assert own[int(a) : int(b)] in (planted.get(r.doc_id), own[int(a) : int(b)]) and r.doc_id in planted
                hits += own[int(a) : int(b)] == planted[r.doc_id]
    assert hits >= 0.9 * len(planted)
    assert find_secrets(texts([])).collect() == []


def test_disorder_of_many_windows():
    rng = np.random.default_rng(2)
    for alphabet in (b"abcdef", b"ABCDEFGH", b"abcxyz", b"aB", b"QRSTUVWXYZabcdefghijk", b"a", b"z09AF+/"):
        for length in secrets.CLASSES:
            windows = rng.choice(np.frombuffer(alphabet, np.uint8), (20, length))
            assert np.allclose(secrets.disorders(windows), [secrets.disorder(w.tobytes()) for w in windows])


def test_keys_of_every_length_and_encoding_are_found(texts):
    rng = random.Random(11)
    prose = ["under", "the", "information", "house", "reading", "of", "water", "and", "little", "mountain", "is", "été", "Wörter"]
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    alphabets = [upper + lower + digits, lower + digits, upper + digits, upper + lower + digits + "+/", upper + lower + digits + "-_", "0123456789ABCDEF"]
    rows, planted = [], {}
    for i in range(900):
        words = [rng.choice(prose) for _ in range(120)]
        if i % 6 == 0:
            length = (24, 32, 40, 48, 64, 128)[i // 6 % 6]
            planted[i] = "".join(rng.choice(alphabets[i // 36 % 6]) for _ in range(length))
            words.insert(60, planted[i])
        if i % 6 == 1:
            # Made of hex digits and dashes at fixed places.
            raw = "".join(rng.choice("0123456789abcdef") for _ in range(32))
            planted[i] = "-".join((raw[:8], raw[8:12], raw[12:16], raw[16:20], raw[20:]))
            words.insert(60, planted[i])
        rows.append((i, " ".join(words)))
    text, hits, wrong = dict(rows), Counter(), 0
    for r in find_secrets(texts(rows)).collect():
        spans = [s.split(":") for s in r.spans.split(",") if s]
        found = [text[r.doc_id][int(a) : int(b)] for kind, a, b in spans if kind == "random"]
        key = planted.get(r.doc_id)
        wrong += any(f != key for f in found)
        if key:
            hits["uuid" if "-" in key and len(key) == 36 else len(key)] += key in found
    # Of 25 keys of each length and 150 grouped ones; the shortest carry the least evidence.
    least = {24: 10, 32: 15, 40: 15, 48: 20, 64: 22, 128: 22, "uuid": 90}
    assert wrong <= 2 and all(hits[length] >= wanted for length, wanted in least.items()), hits


def test_random_keys_of_a_small_table(texts):
    rng = random.Random(4)
    prose = ["under", "the", "information", "house", "reading", "of", "water", "and", "little", "mountain", "is"]
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows = []
    for i in range(60):
        key = ["".join(rng.choice(letters) for _ in range(64))] if i < 3 else []
        rows.append((i, " ".join([rng.choice(prose) for _ in range(300)] + key + ["end"])))
    found = {r.doc_id: r.n_random for r in find_secrets(texts(rows)).collect()}
    assert found == {i: int(i < 3) for i in range(60)}


# --- token counts ------------------------------------------------------------------------


def test_allotment_rules():
    ends, bounds = np.array([2, 5, 9, 10]), np.array([0, 3, 4, 10])
    assert token_counts.allot(ends, bounds, "first")[0].tolist() == [2, 0, 2]
    assert token_counts.allot(ends, bounds, "most")[0].tolist() == [2, 0, 2]
    shared, crossed = token_counts.allot(ends, bounds, "share")
    assert np.allclose(shared, [1 + 1 / 3, 1 / 3, 2 + 1 / 3]) and crossed.tolist() == [1, 1, 1]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(texts, rule):
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    tokenizer.encode_special_tokens = True
    rows = [(1, "One line.\nAnd another,  with   spaces\n\n\n  é ß 漢字 <|endoftext|>\n"), (2, "no feed"), (3, "x" * 3000), *ODD]
    found = count_tokens(texts(rows), rule=rule).collect()
    total, text = Counter(), {}
    for r in found:
        total[r.doc_id] += r.n_tokens
    for i, value in rows:
        copies = 2 if i is None else 1
        assert total[i] == pytest.approx(copies * len(tokenizer.encode(value or "", add_special_tokens=False).ids))
        own = sorted({(r.section, r.start, r.n_chars) for r in found if r.doc_id == i})
        assert sum(n for *_, n in own) == len(value or "")
        text[i] = "".join((value or "")[a : a + n] for _, a, n in own)
        assert text[i] == (value or "")
    assert count_tokens(texts([])).collect() == []


def test_tokens_of_fields(texts):
    found = count_tokens(texts([(1, "a b"), (2, None)]), fields=["source", "lang", "text"]).collect()
    assert [(r.section, r.n_chars) for r in sorted(found, key=lambda r: (r.doc_id, r.section))] == [
        (0, 5), (1, 3), (2, 3), (0, 5), (1, 3), (2, 0),
    ]
    assert sum(r.n_tokens for r in found if r.doc_id == 1) == next(r.doc_tokens for r in found if r.doc_id == 1)


