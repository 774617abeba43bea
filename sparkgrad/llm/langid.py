"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's letters, lower-cased and cut into words, give all runs of 2 to 4 characters with the word
ends as characters of their own. Each run is hashed to a row of an embedding table; the mean
of the rows goes through one linear layer and a softmax. Table and layer are trained together
by stochastic gradient descent in NumPy, on the driver, on a bounded sample of the labelled
rows: about ``PER_LANGUAGE`` texts of each language, one stretch of at most
``SAMPLE_CHARS`` characters of each. A fifth of the sample is held back: it sets the temperature of the softmax
(lowest loss) and the score below which a prediction counts as rejected.

Scoring is one map over Arrow batches and reads whole texts. Embedding and layer are linear, so they
are multiplied once into a table of one row per hash and a mean of its rows is all that is left per text.

Defined results: a NULL text or one without a letter is ``und`` with score 0; without any
labelled row every text is; ties go to the first language by name; repeated rows are predicted
alike; NULL languages are not learnt from; rows with a NULL key are not learnt from and their ``held_out`` is NULL; more than ``MAX_LANGUAGES``
different labels are an error; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgrad.llm.slices import map_texts
from sparkgrad.llm.text import read

BITS = 16
DIM = 16
LENGTHS = (2, 3, 4)
PER_LANGUAGE = 800
SAMPLE_CHARS = 1_500
MAX_LANGUAGES = 500  # 2^BITS numbers each are broadcast
EPOCHS = 6
BATCH = 32
RATE = 4.0
REJECT_SHARE = 0.01
SEED = 10
UNKNOWN = "und"
CHUNK = 1 << 20

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """True for the code points that are letters; built once per process."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def code_points(text: str) -> np.ndarray:
    """Lower-cased letters as numbers, everything else as 0, with a 0 at both ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(len(codes) + 2, np.uint32)
    out[1:-1] = np.where(letter_table()[codes], codes, 0)
    return out


def runs(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: hashes of the runs that start at each place, and whether they are inside one word."""
    h, inside = codes.copy(), None
    for n in range(2, max(LENGTHS) + 1):
        h = h[:-1] * np.uint32(2654435761) + codes[n - 1:]
        if n == 2:
            inside = (codes[:-1] != 0) | (codes[1:] != 0)
        else:  # all but the ends are letters
            inside = (inside if n > 3 else np.ones(len(codes) - 1, bool))[:len(codes) - n + 1] & (codes[n - 2:-1] != 0)
        if n in LENGTHS:
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(2246822519) + np.uint32(n * 40503)
            yield mixed >> np.uint32(32 - BITS), inside


def subwords(text: str) -> np.ndarray:
    return np.concatenate([h[ok] for h, ok in runs(code_points(text))] or [np.zeros(0, np.uint32)])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # one row of class scores per hash
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def logits(self, text: str) -> np.ndarray | None:
        """Class scores of a whole text, summed over stretches so that memory stays bounded; None without a letter."""
        total, n = np.zeros(len(self.languages)), 0
        overlap = max(LENGTHS) - 1
        codes = code_points(text)
        for start in range(0, len(codes), CHUNK):
            # each stretch counts the runs that start in it
            part = codes[start:start + CHUNK + overlap]
            for h, ok in runs(part):
                picked = h[:CHUNK][ok[:CHUNK]]
                total += self.table[picked].sum(axis=0, dtype=np.float64)
                n += len(picked)
        return total / n + self.bias if n else None

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated score, whether the score is too low to be trusted."""
        z = self.logits(text) if text and self.languages else None
        if z is None:
            return UNKNOWN, 0.0, True
        p = softmax(z / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.reject_below)


def train(texts: list[str], labels: list[str], seed: int = SEED) -> Model:
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    pairs = [(b, languages.index(y)) for t, y in zip(texts, labels) if len(b := subwords(t))]
    order = rng.permutation(len(pairs))
    held, used = order[:len(pairs) // 5], order[len(pairs) // 5:]
    emb = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    layer = rng.normal(0, 0.1, (DIM, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps, done = max(1, EPOCHS * -(-len(used) // BATCH)), 0
    for _ in range(EPOCHS):
        rng.shuffle(used)
        for at in range(0, len(used), BATCH):
            rate = RATE * (1 - done / steps)
            done += 1
            some = [pairs[i] for i in used[at:at + BATCH]]
            ids = np.concatenate([s[0] for s in some])
            sizes = np.array([len(s[0]) for s in some])
            mean = np.add.reduceat(emb[ids], np.r_[0, sizes.cumsum()[:-1]], axis=0) / sizes[:, None]
            delta = softmax(mean @ layer + bias)
            delta[np.arange(len(some)), [s[1] for s in some]] -= 1
            delta = (delta / len(some)).astype(np.float32)
            back = (delta @ layer.T) / sizes[:, None]
            layer -= rate * mean.T @ delta
            bias -= rate * delta.sum(axis=0)
            np.add.at(emb, ids, np.repeat((-rate * len(some) * back).astype(np.float32), sizes, axis=0))
    model = Model(languages, emb @ layer, bias.astype(np.float64))
    if len(held):
        z = np.array([model.table[pairs[i][0]].mean(axis=0, dtype=np.float64) + model.bias for i in held])
        y = np.array([pairs[i][1] for i in held])
        loss = lambda t: -np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean()
        model.temperature = float(min(np.geomspace(0.05, 4, 60), key=loss))
        p = softmax(z / model.temperature)
        right = p.max(axis=1)[p.argmax(axis=1) == y]
        model.reject_below = float(np.quantile(right, REJECT_SHARE)) if len(right) else 0.0
    return model


def sample(docs: DataFrame, learn: Column, text: str, label: str) -> tuple[list[str], list[str]]:
    """About PER_LANGUAGE texts of each language, chosen by a hash of the text, cut to one stretch each."""
    rows = docs.where(learn & F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        F.col(label).cast("string").alias("y"), F.col(text).alias("t"))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different languages: not labels of languages")
    if not counts:
        return [], []
    share = F.create_map(*[F.lit(v) for y, n in counts.items() for v in (y, min(1.0, PER_LANGUAGE / n))])
    draw = lambda salt: F.pmod(F.xxhash64("t", F.lit(salt)), F.lit(1 << 30))
    start = F.pmod(draw("at"), F.greatest(F.length("t") - SAMPLE_CHARS + 1, F.lit(1))).cast("int") + 1
    chosen = rows.where(draw("in") < F.get(F.array(share[F.col("y")]), F.lit(0)) * (1 << 30)).groupBy("t", "y").agg(
        F.count("*")).select("y", F.substring(F.col("t"), start, F.lit(SAMPLE_CHARS)).alias("t"))
    found = sorted((r["y"], r["t"]) for r in chosen.collect())
    return [t for _, t in found], [y for y, _ in found]


def predict(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` with lang_pred, score and rejected."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS rows of one number per language
    return map_texts(docs, text, keep, "lang_pred string, score double, rejected boolean",
                     lambda: lambda found: tuple(zip(*[held.value.predict(t) for t in found])))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn(
        "held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    model = train(*sample(docs, ~F.coalesce(F.col("held_out"), F.lit(True)), "text", "lang"))
    return predict(docs, model, keep=("doc_id", "held_out"))
