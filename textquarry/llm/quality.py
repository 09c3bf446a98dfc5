"""Document quality from weak labels: heuristic labellers, EM over their votes, a hashed linear scorer.

1. Labellers look at surface traits and vote bad, good or not at all.
2. Votes of all documents are counted by pattern (at most ``3 ** labellers``
   rows, whatever the corpus), and expectation-maximisation over these counts
   estimates the share of bad documents and how each labeller votes on good and
   on bad ones.  Each pattern so gets a posterior.
3. A logistic scorer over hashed character-shape trigrams and word repetition
   learns the posteriors of a bounded sample: the ``sample`` documents of
   smallest hash of id and text (a parameter; rows that tie are equal in both, so
   any of them will do).  It then scores every document's whole text.

A document is kept when its score, the probability of being good, is at least
``keep_from``.  Edge cases: a null or empty text, or one of white space only,
scores 0, is rejected and has no votes; long texts are read whole; ids may be
null or repeat and play no part but in drawing the sample; repeated rows score
alike; a score of exactly ``keep_from`` is kept; an empty table gives an empty
result; further columns are kept as they are by :func:`keep_good` and ignored by
:func:`score`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.words import release
from textquarry.storage import forget, small_batches, written

SAMPLE, DIMENSIONS, KEEP_FROM = 4000, 4096, 0.5
BAD, GOOD, NONE = 0, 1, 2
RUN, BARE, ENDING = re.compile(r"[^\w\s]{2,}"), re.compile(r"(?<!\S)[^\w\s]+(?!\S)"), re.compile(r"[.,;:?!](?!\S)")
_KINDS = np.array([0 if b in b" \t\n\r\x0b\x0c" or 0x80 <= b < 0xC0 else 1 if chr(b).isupper() and b < 128 else 2 if b >= 0xC0 or chr(b).isalpha() else 3 if chr(b).isdigit() else 4 for b in range(256)])


def traits(text: str) -> dict[str, float]:
    """Shares that the labellers look at; letters beyond ASCII count as small ones."""
    words = text.split()
    n = max(1, len(words))
    _, upper, small, digits, marks = np.bincount(_KINDS, np.bincount(np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8), minlength=256), 5).tolist()
    return {
        "words": len(words),
        "upper": upper / max(1, upper + small),
        "runs": len(RUN.findall(text)) / n,
        "same": sum(map(str.__eq__, words, words[1:])) / n,
        "distinct": len(set(words)) / n,
        "marks": marks / max(1, upper + small + digits + marks),
        "bare": len(BARE.findall(text)) / n,
        "prose": len(ENDING.findall(text)) / n,
    }


def _unless_short(t: dict[str, float], least: int, bad: bool) -> int:
    return NONE if t["words"] < least else BAD if bad else GOOD


#: Name and vote of each labeller; a text of too few words gets no vote.
LABELLERS = (
    ("shouting", lambda t: _unless_short(t, 4, t["upper"] > 0.4)),
    ("symbol runs", lambda t: _unless_short(t, 4, t["runs"] > 0.2)),
    ("stuttering", lambda t: _unless_short(t, 4, t["same"] > 0.25)),
    ("few words", lambda t: _unless_short(t, 20, t["distinct"] < 0.15)),
    ("marks", lambda t: _unless_short(t, 20, t["marks"] > 0.07)),
    ("bare marks", lambda t: _unless_short(t, 4, t["bare"] > 0.1)),
    ("sentences", lambda t: _unless_short(t, 20, not 0.02 < t["prose"] < 0.35)),
)


def votes(text: str) -> str:
    t = traits(text)
    return "".join(str(vote(t)) for _, vote in LABELLERS)


def estimate(counts: dict[str, int], rounds: int = 60) -> tuple[dict[str, float], np.ndarray, float]:
    """EM over vote patterns -> posterior of good by pattern, ``P(vote | class)`` as [class, labeller, bad or good], share of good.

    Starts from labellers that are right more often than wrong; a small prior
    count keeps every probability above 0.
    """
    patterns = sorted(counts)
    if not patterns:
        return {}, np.zeros((2, len(LABELLERS), 2)), 0.5
    weight = np.array([counts[p] for p in patterns], dtype=float)
    seen = np.array([[int(c) for c in p] for p in patterns])
    one_hot = (seen[:, :, None] == np.array([BAD, GOOD])).astype(float)  # no vote says nothing
    like = np.stack([np.tile([0.4, 0.6], (seen.shape[1], 1)), np.tile([0.02, 0.98], (seen.shape[1], 1))])
    good = 0.8
    for _ in range(rounds):
        logs = np.einsum("plv,clv->pc", one_hot, np.log(like)) + np.log([1 - good, good])
        logs -= logs.max(axis=1, keepdims=True)
        post = np.exp(logs)
        post /= post.sum(axis=1, keepdims=True)
        mass = post * weight[:, None]
        like = np.einsum("pc,plv->clv", mass, one_hot) + 0.5
        like /= like.sum(axis=2, keepdims=True)
        good = float(np.clip(mass[:, 1].sum() / weight.sum(), 0.01, 0.99))
    return dict(zip(patterns, post[:, 1].tolist(), strict=True)), like, good


_SHAPE = np.zeros(256, dtype=np.uint32)
for _b in range(256):
    _c = chr(_b)
    _SHAPE[_b] = 1 if _b >= 128 or _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 4 if _c in " \t\r\x0b\x0c" else 5 + _b


def features(text: str, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Square roots of hashed trigram counts and of repetition, to length 1."""
    raw = text.encode("utf-8", "replace")
    shape = _SHAPE[np.frombuffer(b" " + raw + b" ", dtype=np.uint8)]
    code = (shape[:-2] * np.uint32(0x9E3779B1) + shape[1:-1] * np.uint32(0x85EBCA77) + shape[2:] * np.uint32(0xC2B2AE3D)) if len(shape) > 2 else shape[:0]
    x = np.bincount((code ^ (code >> np.uint32(15))) % np.uint32(dimensions - 1), minlength=dimensions).astype(np.float32)
    words = raw.split()
    x[-1] = 5.0 * sum(map(bytes.__eq__, words, words[1:]))
    x = np.sqrt(x)
    return x / max(1e-9, float(np.sqrt((x * x).sum())))


def train(x: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 8.0, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, both classes with equal weight, by gradient descent from 0."""
    w, b = np.zeros(x.shape[1], dtype=np.float32), 0.0
    if not len(x):
        return w, b
    part = np.where(y >= 0.5, 0.5 / max(1, (y >= 0.5).sum()), 0.5 / max(1, (y < 0.5).sum())).astype(np.float32)
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-(x @ w + b))) - y) * part
        w -= rate * (x.T @ error + decay * w)
        b -= rate * float(error.sum())
    return w, b


def probability(text: str | None, w: np.ndarray, b: float, good: float) -> float:
    """The score of one text; below 200 bytes the evidence is weighed down towards the share of good documents."""
    if not text or not text.strip():
        return 0.0
    sure = min(1.0, len(text.encode("utf-8", "replace")) / 200)
    logit = sure * float(features(text, len(w)) @ w + b) + (1 - sure) * float(np.log(good / (1 - good)))
    return 1 / (1 + float(np.exp(-logit)))


def fit(docs: DataFrame, *, sample: int = SAMPLE, dimensions: int = DIMENSIONS) -> dict:
    """The model: vote counts over all documents, a scorer from a bounded sample."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cast = [votes(t) if (t := x.as_py()).strip() else None for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cast, pa.string())], names=["draw", "votes"])
        release()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = [t for x in batch.column(0) if (t := x.as_py()).strip()]
            yield pa.RecordBatch.from_arrays([pa.array([votes(t) for t in some], pa.string()), pa.array([features(t, dimensions).astype(np.float16).tobytes() for t in some], pa.binary())], names=["votes", "x"])

    small_batches(docs.sparkSession)
    full = docs.where("text is not null").select(F.xxhash64(F.lit(29), "doc_id", "text").alias("draw"), "text")
    cast = written(full.mapInArrow(vote, "draw long, votes string").where("votes is not null"), "votes")
    counts = {r["votes"]: r["count"] for r in cast.groupBy("votes").count().collect()}  # at most 3 ** labellers rows
    posterior, like, good = estimate(counts)
    n = sum(counts.values())
    low = cast.select("draw").orderBy("draw").limit(sample).agg(F.max("draw")).first()[0] if n > sample else None
    drawn = full if low is None else full.where(F.col("draw") <= low)
    if low is not None and cast.where(F.col("draw") <= low).count() > sample:
        # many rows tie for the last places: they are equal, so any of them will do
        least = sample - cast.where(F.col("draw") < low).count()
        drawn = full.where(F.col("draw") < low).union(full.where(F.col("draw") == low).limit(least))
    rows = drawn.select("text").mapInArrow(hashed, "votes string, x binary").collect()  # the sample
    rows.sort(key=lambda r: (r["votes"], bytes(r["x"])))
    forget(cast)
    x = np.stack([np.frombuffer(r["x"], dtype=np.float16) for r in rows]).astype(np.float32) if rows else np.zeros((0, dimensions), np.float32)
    y = np.array([posterior.get(r["votes"], good) for r in rows], dtype=np.float32)
    w, b = train(x, y)
    return {"w": w, "b": b, "posterior": posterior, "like": like, "good": good}


def scorer(model: dict):
    """A column function: text -> score."""
    w, b, good = model["w"], model["b"], model["good"]

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in texts:
            yield pd.Series([probability(t, w, b, good) for t in some], dtype="float64")

    run.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")


def score(docs: DataFrame, *, keep_from: float = KEEP_FROM, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, score, keep`` for every row."""
    model = fit(docs, sample=sample)
    return docs.select("doc_id", scorer(model)("text").alias("score")).withColumn("keep", F.col("score") >= keep_from)


def keep_good(docs: DataFrame, *, keep_from: float = KEEP_FROM, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    return docs.where(scorer(fit(docs, sample=sample))("text") >= keep_from)
