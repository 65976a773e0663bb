"""Toxic passages by maximum-scoring segments over token log-odds, calibrated as extreme values.

Evidence comes from labelled documents: how many toxic and clean ones hold a word, or a word's beginning. Log-odds
get a Dirichlet prior in proportion to the background. They count where chance would hardly bring that many toxic
documents together for any trait at all, and as far as their lower confidence bound; every other token scores
slightly below zero. A text's maximal scoring segments are found in one scan.
Under clean text the best segment's score follows an extreme-value distribution whose decay is the root of
sum p(s) exp(decay s) = 1; scores become logarithms of expected chance finds, those of all significant segments
are added, and a logistic curve turns the sum into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stowage.llm.lm_scoring import fold_of
from stowage.llm.shipping import let_go
from stowage.session import share

TOKEN = re.compile(r"[^\W\d_]+")
HEADS = (4, 5, 6)  # letters of the word beginnings that bear evidence
MEMO = 100_000  # token scores remembered by a task
PRIOR = 10.0  # documents that the prior is worth
SURE = 1.0  # standard errors below the estimate
LEAST = 0.5  # smallest log-odds that count
CHANCE = 5.0  # traits that may stand out by chance
FEWEST = 4  # documents below which no trait can stand out
MOST = 8.0
DRIFT = 0.5  # what any other token costs


def traits(token: str) -> list[str]:
    return [token, *[f"{token[:k]}~" for k in HEADS if len(token) >= k]]


def labelled(docs: DataFrame, labels: DataFrame, max_labelled: int, folds: int, held_fold: int, text: str) -> DataFrame:
    """(doc_id, toxic): one id per distinct text of the labelled rows outside the held fold.

    At most about ``max_labelled`` documents, chosen by a hash of the id: the bound of the fit. It makes the table
    small enough to broadcast.
    """
    rows = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = rows.filter(fold_of(F.col("doc_id"), folds) != held_fold)
    n = rows.count()
    part = min(1.0, max_labelled / max(1, n))
    if part < 1:
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(part * 1_000_000))
    texts = docs.select("doc_id", F.xxhash64(docs[text]).alias("body"))
    own = texts.join(F.broadcast(rows), "doc_id")
    return own.groupBy("body").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")).select("doc_id", "toxic")


def evidence(train: DataFrame) -> DataFrame:
    """(trait, toxic, clean): in how many documents of each kind a trait stands, ``FEWEST`` at least."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter[str], Counter[str]] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            names = list(seen[0].keys() | seen[1].keys())
            made = {"trait": names, "clean": [seen[0][t] for t in names], "toxic": [seen[1][t] for t in names]}
            return pa.RecordBatch.from_pydict({k: pa.array(v, pa.string() if k == "trait" else pa.int64()) for k, v in made.items()})

        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = set(TOKEN.findall((text.as_py() or "").lower()))
                seen[int(toxic > 0)].update({x for t in tokens for x in traits(t)})
                if len(seen[0]) + len(seen[1]) > 400_000:
                    yield out()
                    seen[0].clear()
                    seen[1].clear()
        yield out()

    counts = train.select("toxic", "_text").mapInArrow(count, "trait string, clean long, toxic long")
    return counts.groupBy("trait").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter(
        F.col("toxic") + F.col("clean") >= FEWEST
    )


def weights(counts: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Lower bounds of the log-odds of traits that speak for toxicity; as many as the bounded sample can hold.

    A trait on n documents, k of them toxic, stands out when the bound exp(-n KL(k / n, base rate)) of the chance
    to see that many, times the number of traits, is below ``CHANCE``.
    """
    traits_seen = max(1, counts.count())
    base = (toxic + 0.5) / (toxic + clean + 1)
    n = F.col("toxic") + F.col("clean")
    p = F.col("toxic") / n
    surprise = n * (p * F.log(p / base) + F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - base))).otherwise(0.0))
    a, b = F.col("toxic") + n * PRIOR / (toxic + clean), F.col("clean") + n * PRIOR / (toxic + clean)
    odds = F.log(a / (toxic + PRIOR - a + 0.5)) - F.log(b / (clean + PRIOR - b + 0.5))
    bound = odds - SURE * F.sqrt(1 / a + 1 / (b + 0.5))
    standing = counts.filter(F.col("toxic") > 0).filter((p > base) & (surprise >= math.log(max(1.0, traits_seen / CHANCE))))
    rows = standing.select("trait", bound.alias("w")).filter(F.col("w") >= LEAST).collect()
    return {r["trait"]: min(MOST, r["w"]) for r in rows}


class Scores(dict):
    """Score of a token: its strongest trait, or the drift; remembered up to a bound."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, token: str) -> float:
        if len(self) >= MEMO:
            self.clear()
        s = max((self.weights[t] for t in traits(token) if t in self.weights), default=-DRIFT)
        self[token] = s
        return s


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, behind the last, score), in one pass over the scores.

    Candidates are kept with the running sums at their two ends. A new positive score becomes a candidate, and takes
    in earlier ones back to the last that starts lower, as long as that one ends below the new end.
    """
    found: list[tuple[int, int, float, float]] = []
    total = 0.0
    for k, s in enumerate(scores):
        if s > 0:
            first, low, high = k, total, total + s
            while True:
                j = len(found) - 1
                while j >= 0 and found[j][2] >= low:
                    j -= 1
                if j < 0 or found[j][3] >= high:
                    break
                first, low = found[j][0], found[j][2]
                del found[j:]
            found.append((first, k + 1, low, high))
        total += s
    return [(a, b, high - low) for a, b, low, high in found]


def decay_rate(chances: dict[float, float]) -> float:
    """The positive root of sum p(s) exp(x s) = 1, by bisection; the mean score is negative."""
    def f(x: float) -> float:
        return sum(p * math.exp(x * s) for s, p in chances.items()) - 1

    high = 1.0
    while f(high) < 0 and high < 64:
        high *= 2
    low = 1e-9
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return max(high, 0.05)


class Detector:
    """Weights and calibration; ``evidence_of`` gives a text's summed significance and its passages."""

    def __init__(self, weights: dict[str, float], rate: float, share_: float, curve: tuple[float, float]):
        self.weights, self.rate, self.share, self.curve = weights, rate, share_, curve
        self.memo = Scores(weights)

    def __getstate__(self):
        return self.weights, self.rate, self.share, self.curve

    def __setstate__(self, state):
        self.__init__(*state)

    def evidence_of(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        low = text.lower()
        words = TOKEN.findall(low)
        scores = list(map(self.memo.__getitem__, words))
        if not words or max(scores) <= 0:
            return 0.0, []
        chance = math.log(max(self.share * len(words), 1e-9))
        found = [(a, b, self.rate * s - chance) for a, b, s in segments(scores)]
        found = [x for x in found if x[2] > 0]
        if not found:
            return 0.0, []
        spans = [m.span() for m in TOKEN.finditer(low)] if found else []
        return sum(x[2] for x in found), [(spans[a][0], spans[b - 1][1], x) for a, b, x in found]

    def probability(self, evidence: float) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, a + b * evidence))))


def logistic(points: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Intercept and slope for (evidence, toxic, clean) by Newton steps with a weak prior on the slope."""
    if not points:
        return -2.0, 0.5
    x, t, c = (np.array(v, dtype=float) for v in zip(*points))
    n = t + c
    a, b = math.log((t.sum() + 0.5) / (c.sum() + 0.5)), 0.5
    for _ in range(60):
        z = np.clip(a + b * x, -40, 40)
        p = 1 / (1 + np.exp(-z))
        w = np.maximum(n * p * (1 - p), 1e-12)
        g = np.array([(t - n * p).sum(), ((t - n * p) * x).sum() - 0.5 * (b - 0.5)])
        h = np.array([[w.sum() + 1e-6, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 0.5]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(max(b, 0.05))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int, folds: int, held_fold: int, text: str) -> Detector:
    spark = docs.sparkSession
    ids = share(labelled(docs, labels, max_labelled, folds, held_fold, text), "labelled")
    train = share(
        docs.select("doc_id", docs[text].alias("_text")).join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]).select("toxic", "_text"),
        "labelled-texts",
    )
    n = train.agg(F.count_if(F.col("toxic") > 0).alias("t"), F.count_if(F.col("toxic") <= 0).alias("c")).first()
    table = weights(share(evidence(train), "traits"), n["t"], n["c"])
    shared = spark.sparkContext.broadcast(table)

    def score_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, seen = Scores(shared.value), Counter()
        for batch in batches:
            for toxic, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                if toxic <= 0:
                    seen.update(round(memo[w], 2) for w in TOKEN.findall((t.as_py() or "").lower()))
        yield pa.RecordBatch.from_pydict({"s": pa.array(seen.keys(), pa.float64()), "n": pa.array(seen.values(), pa.int64())})

    tallies = train.mapInArrow(score_counts, "s double, n long").groupBy("s").agg(F.sum("n").alias("n")).collect()
    clean = {r["s"]: r["n"] for r in tallies}
    tokens = sum(clean.values()) + 1.0
    clean[MOST] = clean.get(MOST, 0) + 0.5  # a clean text may hold any word at last
    clean[-DRIFT] = clean.get(-DRIFT, 0) + 0.5
    rate = decay_rate({s: k / tokens for s, k in clean.items()})
    positive = sum(k for s, k in clean.items() if s > 0) / tokens
    plain = spark.sparkContext.broadcast(Detector(table, rate, positive, (0.0, 1.0)))

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector, seen = plain.value, Counter()
        for batch in batches:
            for toxic, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen[round(min(detector.evidence_of(t.as_py() or "")[0], 200.0), 1), int(toxic > 0)] += 1
        yield pa.RecordBatch.from_pydict({
            "x": pa.array([k[0] for k in seen], pa.float64()), "toxic": pa.array([k[1] for k in seen], pa.int64()),
            "n": pa.array(seen.values(), pa.int64()),
        })

    told = train.mapInArrow(points, "x double, toxic long, n long").groupBy("x").agg(
        F.sum(F.col("n") * F.col("toxic")).alias("t"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("c")
    )
    curve = logistic([(r["x"], r["t"], r["c"]) for r in told.collect()])
    shared.destroy()
    plain.destroy()
    return Detector(table, rate, positive, curve)


SCORED = "doc_id long, held_out boolean, score double, predicted int, passages array<struct<start:int,stop:int,evidence:double>>"


def toxicity(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_labelled: int = 200_000, folds: int = 3,
    held_fold: int = 1, text: str = "text",
) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` (0 to 1), ``predicted`` (1 from ``threshold`` on) and the
    significant ``passages`` (start and end in code points of the lower-cased text).

    The fit reads at most about ``max_labelled`` labelled documents outside ``held_fold``; scoring covers every whole
    text. A null text counts as empty and has the score of a text without evidence; labels that are null, repeated
    or of unknown documents do no harm (a document labelled twice is toxic if it ever is); a null id counts as an
    empty text when folds are dealt; without labels every score is low. Repeated rows stay, an empty table gives
    none, and other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_labelled, folds, held_fold, text))
    thin = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold_of(F.col("doc_id"), folds) == held_fold).alias("held_out"),
        docs[text].alias("_text"),
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = shared.value
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("evidence", pa.float64())]))
        for batch in batches:
            scores, passages = [], []
            for t in batch.column(2):
                evidence, found = detector.evidence_of(t.as_py() or "")
                scores.append(detector.probability(evidence))
                passages.append([{"start": a, "stop": b, "evidence": x} for a, b, x in found])
            predicted = pa.array([int(s >= threshold) for s in scores], pa.int32())
            columns = [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), predicted, pa.array(passages, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted", "passages"])
        detector.memo.clear()
        let_go()

    return thin.mapInArrow(score, SCORED)


def drop_toxic(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_labelled: int = 200_000, folds: int = 3,
    held_fold: int = 1, text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that ``toxicity`` does not predict to be toxic, with all their columns, in one pass.

    Rows with a null or empty text stay, unless texts without evidence are toxic by their score; repeated rows are
    judged alike, one by one, and rows with a null id as any other; an empty table stays empty. Long texts are read
    whole. Columns may have any names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_labelled, folds, held_fold, text))
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = shared.value
        for batch in batches:
            clean = [detector.probability(detector.evidence_of(t.as_py() or "")[0]) < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(clean, pa.bool_()))
        detector.memo.clear()
        let_go()

    return docs.mapInArrow(keep, docs.schema)
