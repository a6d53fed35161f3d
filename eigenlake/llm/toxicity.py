"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens get log-odds between toxic and clean documents under a Dirichlet prior that follows the
whole corpus (Monroe, Colaresi and Quinn, 2008). A linear scan finds all maximal scoring
segments of a text (Ruzzo and Tompa, 1999). Karlin-Altschul statistics say how surprising a
segment is for a text of that length: the decay of the extreme-value law follows from the scores, its scale is fitted to the
best segments of clean documents. A logistic curve turns the evidence into a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eigenlake.llm.rows import filter_by_text
from eigenlake.llm.staging import Staging
from eigenlake.llm.text import SpanHasher, Words, bytes_of, distinct, mix, string_parts, words

# Tokens are words and, for inflected forms, beginnings of longer words of so many bytes.
BEGINNINGS = (5, 7)

SPAN = "array<struct<start:long,end:long,evidence:double>>"


@dataclass(frozen=True)
class ToxicityModel:
    """Fitted tokens (sorted hashes and scores), segment statistics and the final curve."""

    tokens: np.ndarray
    scores: np.ndarray
    ordinary: float
    decay: float
    scale: float
    curve: tuple[float, float, float]

    def word_scores(self, levels: list[np.ndarray]) -> np.ndarray:
        """Score of every word: that of the longest token of it that the model knows."""
        out = np.full(len(levels[0]), self.ordinary)
        for hashes in levels if len(self.tokens) else []:
            at = np.minimum(np.searchsorted(self.tokens, hashes), len(self.tokens) - 1)
            known = self.tokens[at] == hashes
            out[known] = self.scores[at[known]]
        return out

    def evidence(self, score: float, count: int) -> float:
        """How far a segment exceeds what chance gives in a text of ``count`` words, in nats."""
        return self.decay * score - math.log(max(self.scale * count, 1.0))

    def probability(self, best: np.ndarray, total: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_pieces(best, total) @ np.array(self.curve), -35, 35)))


def is_held_out(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text leaves no remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def token_levels(found: Words, hasher: SpanHasher) -> list[np.ndarray]:
    """Token hashes per word, from the shortest beginning to the whole word; 0 where there is none."""
    levels = []
    for length in BEGINNINGS:
        longer = found.end - found.start > length
        begun = hasher.spans(found.start, np.minimum(found.start + length, found.end))
        levels.append(np.where(longer, mix(begun + np.uint64(length)), np.uint64(0)))
    return [*levels, found.hashes]


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)``, in one pass over the positive scores."""
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[int, int, float, float]] = []
    for i in positive.tolist():
        start, end, low, high = i, i + 1, float(sums[i]), float(sums[i + 1])
        while True:
            # Nearest earlier segment that starts lower; those passed over can't be joined.
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j -= 1
            if j < 0 or stack[j][3] >= high:
                stack.append((start, end, low, high))
                break
            start, _, low, _ = stack[j]
            del stack[j:]
    return [(start, end, high - low) for start, end, low, high in stack]


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = 20_000,
    model_tokens: int = 20_000,
    least_documents: int = 5,
    least_z: float = 2.5,
    prior: float = 1000.0,
    density: float = 0.05,
) -> ToxicityModel:
    """Learn from ``labels(doc_id, toxic)`` outside the held-out fold.

    ``sample_rows`` bounds the labelled documents read for fitting (by md5 of the id),
    ``model_tokens`` the tokens kept, those of the largest z first. The prior counts tokens over all documents.
    Labels that are null are left out; without both classes every text scores 0.
    """
    staging = Staging(docs.sparkSession, "toxicity")
    texts = docs.select(F.col("doc_id").cast("long"), F.lower(F.col("text").cast("string")).alias("text"))
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out(F.col("doc_id")))
    chosen = chosen.groupBy(F.col("doc_id").cast("long")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = chosen.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample_rows)
    sample = staging.keep(texts.join(F.broadcast(chosen), "doc_id").select("toxic", "text"), "sample")
    seen = sample.mapInArrow(_documents_with, "token long, toxic long, clean long")
    seen = seen.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = staging.keep(seen, "seen")
    sizes = {row["toxic"]: row["n"] for row in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    empty = ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), -density, 1.0, 1.0, (-35.0, 0.0, 0.0))
    if not n_toxic or not n_clean:
        return empty
    # Bounded by the sample: only tokens that enough of its documents hold can matter.
    table = counts.where(F.col("toxic") + F.col("clean") >= least_documents).toArrow()
    tokens = table.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    tokens = tokens[order]
    toxic, clean = (table.column(c).to_numpy()[order].astype(float) for c in ("toxic", "clean"))
    corpus, n_corpus = _corpus_counts(texts, tokens)
    share = prior * corpus / max(1, n_corpus) + 0.5

    def odds(found: np.ndarray, total: float) -> np.ndarray:
        return np.log(found + share) - np.log(total + prior + 1 - found - np.minimum(share, prior))

    delta = odds(toxic, n_toxic) - odds(clean, n_clean)
    z = delta / np.sqrt(1 / (toxic + share) + 1 / (clean + share))
    wanted = np.sort(np.argsort(-np.abs(z), kind="stable")[: min(model_tokens, int((np.abs(z) >= least_z).sum()))])
    tokens, scores = tokens[wanted], delta[wanted]
    ordinary = math.log(1 - density)
    chance = (clean[wanted] + 0.5) / max(1.0, n_clean + 1.0) / max(1.0, _mean_words(sample))
    decay = _decay(scores, chance, ordinary)
    # The score of the best segment alone: its evidence in a text of no length.
    bare = ToxicityModel(tokens, scores, ordinary, decay, 0.0, empty.curve)
    tops = score_texts(sample.where("toxic = 0").select("text"), bare, []).select("best", "words").toArrow()
    scale = _scale(tops.column("best").to_numpy(), tops.column("words").to_numpy())
    model = replace(bare, scale=scale)
    held = score_texts(sample.select("toxic", "text"), model, ["toxic"]).select("toxic", "best", "total").toArrow()
    curve = _logistic(held.column("best").to_numpy(), held.column("total").to_numpy(), held.column("toxic").to_numpy())
    return replace(model, curve=curve)


def _documents_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either class that hold a token, summed within the task."""
    hasher = SpanHasher()
    for batch in batches:
        toxic, row, found = batch.column(0).to_numpy(), 0, []
        for part in string_parts(batch.column(1)):
            got = words(part, hasher, plain=True)
            levels = token_levels(got, hasher)
            for i in range(len(part)):
                own = distinct(np.concatenate([level[got.first[i] : got.first[i + 1]] for level in levels]))
                found.append((own, np.full(len(own), toxic[row + i], np.int64)))
            row += len(part)
        if found:
            tokens = np.concatenate([f[0] for f in found])
            marks = np.concatenate([f[1] for f in found])
            order = np.argsort(tokens, kind="stable")
            tokens, marks = tokens[order], marks[order]
            starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else []
            if len(starts):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(tokens[starts].view(np.int64)),
                        pa.array(np.add.reduceat(marks, starts)),
                        pa.array(np.add.reduceat(1 - marks, starts)),
                    ],
                    names=["token", "toxic", "clean"],
                )


def _corpus_counts(texts: DataFrame, tokens: np.ndarray) -> tuple[np.ndarray, int]:
    """Occurrences of the tokens, and of all words, in every whole text."""
    shared = texts.sparkSession.sparkContext.broadcast(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hasher, total = shared.value, SpanHasher(), 0
        counts = np.zeros(len(known), np.int64)
        for batch in batches:
            for part in string_parts(batch.column(0)):
                found = words(part, hasher, plain=True)
                total += len(found.hashes)
                for hashes in token_levels(found, hasher) if len(known) else []:
                    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                    counts += np.bincount(at[known[at] == hashes], minlength=len(known))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([used, [-1]])), pa.array(np.concatenate([counts[used], [total]]))], names=["at", "n"]
        )

    summed = texts.select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    at, n = summed.column("at").to_numpy(), summed.column("n").to_numpy()
    out = np.zeros(len(tokens))
    out[at[at >= 0]] = n[at >= 0]
    return out, int(n[at < 0].sum())


def _mean_words(sample: DataFrame) -> float:
    return sample.agg(F.avg(F.size(F.split("text", r"\s+")))).first()[0] or 1.0


def _decay(scores: np.ndarray, chance: np.ndarray, ordinary: float) -> float:
    """The positive root of sum(p * exp(decay * s)) = 1 over what clean text holds; 1 without positive scores."""
    if not (scores > 0).any():
        return 1.0

    def excess(x: float) -> float:
        rest = max(0.0, 1 - chance.sum())
        return float((chance * np.exp(np.minimum(x * scores, 500))).sum() + rest * math.exp(x * ordinary) - 1)

    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def _scale(tops: np.ndarray, counts: np.ndarray) -> float:
    """Maximum likelihood of K in P(best < x) = exp(-K * words * exp(-x)), with x in nats.

    Texts without a positive segment only say that none came up.
    """
    found = tops > 0
    return float(found.sum() / max(1.0, (counts * np.exp(-np.where(found, tops, 0.0))).sum()))


def _pieces(best: np.ndarray, total: np.ndarray) -> np.ndarray:
    """What the curve weighs: a constant, and both pieces of evidence on a log scale to either side of 0."""
    return np.column_stack([np.ones(len(best)), np.sign(best) * np.log1p(np.abs(best)), np.log1p(total)])


def _logistic(best: np.ndarray, total: np.ndarray, label: np.ndarray) -> tuple[float, float, float]:
    """Newton steps of a lightly ridged logistic regression on the two pieces of evidence."""
    x = _pieces(best, total)
    beta, ridge = np.zeros(3), np.diag([1e-4, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (label - p) - ridge @ beta)
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)


def score_texts(rows: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``rows(text, ...)`` with ``score, best, total, passages, words``.

    ``passages`` are the significant segments in code points of the lower-cased text with their evidence. ``best`` is the
    largest evidence of any segment, below 0 where none is significant, ``total`` the sum of what is above 0; a token
    counts once per segment. A null or empty text has no passage and no evidence.
    """
    fields = [f"`{name}` {kind}" for name, kind in rows.select(*keep).dtypes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            row = 0
            for part in string_parts(batch.column(len(keep))):
                best, total, passages, counts = _segments(part, hasher, model)
                carried = [batch.column(i).slice(row, len(part)) for i in range(len(keep))]
                found = [model.probability(best, total), best, total]
                yield pa.RecordBatch.from_arrays(
                    [*carried, *map(pa.array, found), passages, pa.array(counts)],
                    names=[*keep, "score", "best", "total", "passages", "words"],
                )
                row += len(part)

    schema = ", ".join([*fields, "score double, best double, total double", f"passages {SPAN}, words long"])
    return rows.select(*keep, F.lower(F.col("text").cast("string")).alias("_text")).mapInArrow(run, schema)


def _segments(part: pa.Array, hasher: SpanHasher, model: ToxicityModel):
    data, rows = bytes_of(part)
    found = words(part, hasher, plain=True)
    scores = model.word_scores(token_levels(found, hasher))
    # Without a positive word the best segment is empty.
    counts = found.counts.astype(np.int64)
    best = np.array([model.evidence(0.0, int(count)) for count in counts], float)
    total = np.zeros(len(part))
    spans: list[list[dict]] = [[] for _ in range(len(part))]
    hot = np.unique(np.searchsorted(found.first, np.flatnonzero(scores > 0), "right") - 1)
    for i in hot.tolist():
        a, b = found.first[i], found.first[i + 1]
        own, names = scores[a:b], found.hashes[a:b]
        text = data[rows[i] : rows[i + 1]].tobytes()
        offset = rows[i]
        for start, end, score in maximal_segments(own):
            # For the text a token counts once per passage: repetition alone is no evidence.
            inside = own[start:end]
            again = np.ones(end - start, bool)
            again[np.unique(names[start:end], return_index=True)[1]] = False
            damped = np.where(again & (inside > 0), model.ordinary, inside)
            once = max((model.evidence(s, int(b - a)) for *_, s in maximal_segments(damped)), default=0.0)
            best[i] = max(best[i], once)
            evidence = model.evidence(score, int(b - a))
            if evidence > 0:
                begins, ends = int(found.start[a + start] - offset), int(found.end[a + end - 1] - offset)
                spans[i].append(
                    {"start": len(text[:begins].decode()), "end": len(text[:ends].decode()), "evidence": evidence}
                )
                total[i] += max(once, 0.0)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("evidence", pa.float64())]))
    return best, total, pa.array(spans, kind), counts


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages, passages`` for every row of ``docs``."""
    scored = score_texts(docs.select("doc_id", "text"), model, ["doc_id"])
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"),
        "passages",
    )


def without_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs`` that the model does not predict to be toxic, with all their columns."""

    def task():
        hasher = SpanHasher()

        def clean(part: pa.Array) -> np.ndarray:
            best, total, *_ = _segments(part, hasher, model)
            return model.probability(best, total) < 0.5

        return clean

    return filter_by_text(docs, task)
