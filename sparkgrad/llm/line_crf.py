"""Document quality from a linear-chain conditional random field over the lines of a text.

Every non-blank line gets a vector of shape features (length, symbols, separators, capitals, digits, function words,
repetition, end mark) next to the vectors of the lines before and after it. A CRF with the labels
good and bad, one weight vector and one 2 x 2 transition table, gives by the forward-backward
recursion the probability that each line is good; the score of the document is
their mean weighted with the lines' lengths.

Learning: a bounded sample of labelled documents (``SAMPLE_DOCS`` of each label, chosen by hash;
of each one stretch of at most ``SAMPLE_CHARS`` characters and ``SAMPLE_LINES`` lines), each line labelled as its document,
conditional likelihood with an L2 penalty, full gradients by forward-backward in NumPy, Adam. Chains are packed with others of
about their length, so a long one doesn't widen the rest; the driver holds at most one feature row per sampled line.
Transitions learnt this way favour few changes of label, so single odd lines count little.

Scoring is one map over Arrow batches and reads whole texts line by line.

Defined results: a NULL, empty or blank text has no line and gets the share of good documents in
the sample (0.5 without any labelled row); NULL labels are not learnt from; documents labelled twice
with different labels count with both; of documents that repeat a key one is learnt from; a NULL key is never learnt from and its ``held_out`` is NULL; repeated rows are scored alike; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgrad.llm.quality_rules import STOP_WORDS
from sparkgrad.llm.slices import map_texts
from sparkgrad.llm.text import read

SAMPLE_DOCS = 1_500
SAMPLE_CHARS = 6_000
SAMPLE_LINES = 300
STEPS = 150
RATE = 0.08
PENALTY = 1e-3
THRESHOLD = 0.3
LINE_CHARS = 20_000

STOPS = frozenset(STOP_WORDS)
SYMBOL = re.compile(r"[#*$%&|<>{}\[\]_=~^@\\]")
CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
DIGIT = re.compile(r"[0-9]")
MARK = re.compile(r"[.,;:!?]")
N_OWN = 17


def line_features(line: str, seen: bool) -> list[float]:
    """Shape of one line; ``seen``: the same line stands earlier in the text."""
    words, n = line.split(), len(line)
    k = len(words)
    distinct = len(set(words)) / k
    again = sum(map(eq, words, words[1:])) / k
    symbols = len(SYMBOL.findall(line)) / k
    chars = max(1, n - k + 1)
    return [
        1.0, math.log1p(k) / 5, chars / k / 10, symbols, line.count("|") * 4 / k,
        len(CAPITAL.findall(line)) / chars, len(DIGIT.findall(line)) / chars, len(MARK.findall(line)) / k, line.count("!") / k,
        sum(map(STOPS.__contains__, words)) / k, distinct, float(distinct < 0.4), again, float(again > 0.2), float(symbols > 0.15),
        float(line.rstrip()[-1] in ".!?\"'”»"), float(seen)]


def pieces(text: str) -> Iterator[str]:
    """Non-blank lines; a line of more than LINE_CHARS characters counts as several."""
    for line in text.split("\n"):
        for at in range(0, len(line), LINE_CHARS):
            part = line[at:at + LINE_CHARS]
            if part and not part.isspace():
                yield part


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Per line: own features with those of both neighbours (zeros at the ends), and the length."""
    seen: set[int] = set()
    own, sizes = [], []
    for line in pieces(text):
        h = hash(line)
        own.append(line_features(line, h in seen))
        seen.add(h)
        sizes.append(len(line))
    if not own:
        return np.zeros((0, 3 * N_OWN)), np.zeros(0)
    x = np.array(own)
    pad = np.zeros((1, N_OWN))
    return np.hstack([x, np.vstack([pad, x[:-1]]), np.vstack([x[1:], pad])]), np.array(sizes, float)


def marginals(unary: np.ndarray, table: np.ndarray) -> np.ndarray:
    """P(line is good) for one chain. ``unary``: score of good against bad; ``table``: [before, now] transition scores."""
    (t00, t01), (t10, t11) = np.exp(table - table.max()).tolist()
    odds = np.exp(np.clip(unary, -40, 40)).tolist()
    n = len(odds)
    left, ratio = [0.0] * n, 0.0
    for i, o in enumerate(odds):  # odds of good given the lines up to here
        ratio = o if i == 0 else o * (t01 + ratio * t11) / (t00 + ratio * t10)
        ratio = min(max(ratio, 1e-40), 1e40)
        left[i] = ratio
    p, right = np.empty(n), 1.0
    for i in range(n - 1, -1, -1):  # likelihood ratio of the lines after it
        both = left[i] * right
        p[i] = both / (1 + both)
        o = odds[i] * right
        right = min(max((t10 + o * t11) / (t00 + o * t01), 1e-40), 1e40)
    return p


@dataclass
class Crf:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(3 * N_OWN))
    table: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    share: float = 0.5

    def score(self, text: str | None) -> float:
        x, sizes = features(text or "")
        if not len(x):
            return self.share
        return float(np.average(marginals(x @ self.weights, self.table), weights=sizes))


def chain_gradient(unary: np.ndarray, mask: np.ndarray, y: np.ndarray, table: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood of equal-labelled chains (rows), and its gradients by ``unary`` and ``table``."""
    n, m = unary.shape
    score = np.stack([np.zeros_like(unary), unary], axis=2)
    lse = lambda a, axis: np.logaddexp.reduce(a, axis=axis)
    alpha, beta = np.zeros((n, m, 2)), np.zeros((n, m, 2))
    alpha[:, 0] = score[:, 0]
    for t in range(1, m):
        new = lse(alpha[:, t - 1, :, None] + table, 1) + score[:, t]
        alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
    for t in range(m - 2, -1, -1):
        new = lse(table + (score[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        beta[:, t] = np.where(mask[:, t + 1, None], new, beta[:, t + 1])
    log_z = lse(alpha[:, -1], 1)  # what stands behind a chain's end is carried on
    good = np.exp(np.clip(alpha[:, :, 1] + beta[:, :, 1] - log_z[:, None], -60, 0)) * mask
    pair = np.zeros((2, 2))
    for t in range(1, m):
        joint = alpha[:, t - 1, :, None] + table + (score[:, t] + beta[:, t])[:, None, :] - log_z[:, None, None]
        pair += (np.exp(np.minimum(joint, 0)) * mask[:, t, None, None]).sum(axis=0)
    moves = mask[:, 1:].sum(axis=1)
    seen = np.zeros((2, 2))
    seen[0, 0], seen[1, 1] = moves[y == 0].sum(), moves[y == 1].sum()
    reached = (unary * mask).sum(axis=1) * y + moves * table[y, y]
    return float((reached - log_z).sum()), y[:, None] * mask - good, seen - pair


def packs(lengths: np.ndarray) -> list[np.ndarray]:
    """Chains (their numbers) by length: within a pack the longest has less than twice the lines of the shortest."""
    kind = np.floor(np.log2(lengths)).astype(int) if len(lengths) else np.zeros(0, int)
    return [np.flatnonzero(kind == k) for k in np.unique(kind)]


def train(texts: list[str], labels: list[int]) -> Crf:
    found = [(f[:SAMPLE_LINES].astype(np.float32), y) for t, y in zip(texts, labels) if len(f := features(t)[0])]
    if not found:
        return Crf()
    parts = []
    for chains in packs(np.array([len(f) for f, _ in found])):
        lengths = np.array([len(found[i][0]) for i in chains])
        mask = np.arange(lengths.max()) < lengths[:, None]
        parts.append((np.concatenate([found[i][0] for i in chains]), mask, np.array([found[i][1] for i in chains])))
    share, lines = float(np.mean([b for _, b in found])), sum(mask.sum() for _, mask, _ in parts)
    del found
    theta = np.zeros(3 * N_OWN + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        grad = -PENALTY * theta
        for flat, mask, y in parts:
            unary = np.zeros(mask.shape)
            unary[mask] = flat @ theta[:-4]
            _, by_unary, by_table = chain_gradient(unary, mask, y, theta[-4:].reshape(2, 2))
            grad += np.concatenate([by_unary[mask] @ flat, by_table.ravel()]) / lines
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        theta += RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Crf(theta[:-4], theta[-4:].reshape(2, 2), share)


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> tuple[list[str], list[int], float]:
    """About SAMPLE_DOCS documents of each label, one stretch each, and the share of label 1 among all labelled rows."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(key, (F.col(label) > 0).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return [], [], 0.5
    share = {y: min(1.0, SAMPLE_DOCS / n) for y, n in counts.items()}
    limit = F.when(F.col("y") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0)) * (1 << 30)
    few = known.where(F.pmod(F.xxhash64(key, F.lit("crf")), F.lit(1 << 30)) < limit).distinct()  # at most about 2 x SAMPLE_DOCS keys
    start = F.pmod(F.xxhash64("t", F.lit("at")), F.greatest(F.length("t") - SAMPLE_CHARS + 1, F.lit(1))).cast("int") + 1
    rows = docs.where(F.col(text).isNotNull()).select(key, F.col(text).cast("string").alias("t")).join(F.broadcast(few), key)
    # one row per key and label, however often the documents repeat a key
    stretches = rows.select(key, "y", F.substring(F.col("t"), start, F.lit(SAMPLE_CHARS)).alias("t")).groupBy(key, "y").agg(F.min("t").alias("t"))
    found = sorted((r["t"], r["y"]) for r in stretches.collect())
    return [t for t, _ in found], [y for _, y in found], counts.get(1, 0) / sum(counts.values())


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Crf:
    texts, y, share = sample(docs, labels, key, text, label)
    model = train(texts, y)
    model.share = share
    return model


def score(docs: DataFrame, model: Crf, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` and the score."""
    return map_texts(docs, text, keep, "score double", lambda: lambda found: ([model.score(t) for t in found],))


def op4_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = learn(docs.where(~held), labels.where(~held))
    scored = score(docs.withColumn("held_out", held), model, keep=("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
