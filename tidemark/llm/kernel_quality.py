"""Operator 11: quality classifier from random Fourier features.

1. Statistics: every whole text becomes ``STATS`` whole numbers (lengths, shares of
   kinds of characters, repetition of words, word runs and lines, entropy). One pass,
   written as a small table.
2. Features: statistics, standardised by the moments of all documents, are projected
   on fixed Gaussian directions; the cosines approximate a Gaussian kernel.
3. Ridge: partitions of labelled rows sum their normal equations; the sums of
   ``FOLDS`` folds reach the driver, which picks bandwidth and ridge by leaving
   folds out and solves for the weights.
4. Isotonic calibration: labelled rows are scored by the weights of the other folds,
   counted in ``BINS`` bins of the raw score, and pooled to a rising share of good
   texts; scores are read off that line.

Everything that is summed is a whole number (statistics, rounded cosines and their
products), so models and scores do not depend on partitioning. The driver receives
moments, FOLDS * bandwidths matrices of ``WIDTH`` and the bins, at every size.

Labels are read from rows whose crc32(doc_id as text) mod 3 is not ``HELD_OUT``; texts
with equal statistics train once, with the mean of their labels, and about
``TRAIN_ROWS`` of them at most (a share by hash). Language, source, ids and labels
are never statistics.

Null and empty texts have statistics 0 and are scored like any other. Repeated rows
get equal scores; ties are equal scores. A null label, or one without a document, is
left out; a null doc_id trains nothing. Very long texts are read whole, in one
task's memory. Without labels every score is 0.5, with labels of one kind their
share. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import arrow_groups, arrow_map, table, written
from .text import distinct, ngram_hashes, word_hashes

HELD_OUT = 1
TRAIN_ROWS = 200_000
THRESHOLD = 0.5
WIDTH = 256
FOLDS = 4
BANDWIDTHS = (3.0, 6.0, 12.0)  # of standardised statistics
RIDGES = (1e-4, 1e-3, 1e-2)  # per row
BINS = 4096
LOW, HIGH = -0.5, 1.5  # raw scores beyond go to the outer bins
UNIT = 1024  # statistics and projections are whole multiples of 1 / UNIT
COSINE = 4096  # cosines are whole multiples of 1 / COSINE
SLOTS = 8  # partitions that sum the normal equations

STATS = ("words", "bytes", "word_bytes", "word_spread", "short_words", "long_words", "capitals", "digits", "signs",
         "marks", "bangs", "bars", "marked_ends", "capital_starts", "other_script", "new_words", "same_again",
         "repeated_runs", "common_word", "lines", "line_words", "same_lines", "entropy")

# Kinds of bytes.
_SIGNS, _MARKS, _BLANKS = b"#*$%&<>=+_@~^\\/{}[]", b".,;:!?", b" \t\n\r\x0b\x0c"


def _is(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_BLANK, _SIGN, _MARK = _is(_BLANKS), _is(_SIGNS), _is(_MARKS)
_UPPER, _LOWER, _DIGIT = _is(bytes(range(65, 91))), _is(bytes(range(97, 123))), _is(bytes(range(48, 58)))


def stats(text: str | None) -> list[float]:
    """The values of ``STATS`` for one whole text (0 without words)."""
    raw = text.encode("utf-8") if text else b""
    b = np.frombuffer(raw, np.uint8)
    edge = np.flatnonzero(np.diff(_BLANK[b], prepend=True, append=True)) if len(b) else b
    start, end = edge[::2], edge[1::2]
    n = len(start)
    if n == 0:
        return [0.0] * len(STATS)
    size = end - start
    seen = np.bincount(b, minlength=256)
    p = seen[seen > 0] / len(b)
    letters = max(int(seen[_UPPER].sum() + seen[_LOWER].sum()), 1)
    h = word_hashes(raw)
    counts = np.unique(h, return_counts=True)[1]
    runs = ngram_hashes(h, 5)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return [np.log(n), np.log(len(b)), size.mean(), size.std(), (size <= 3).mean(), (size > 12).mean(),
            seen[_UPPER].sum() / letters, seen[_DIGIT].sum() / len(b), min(seen[_SIGN].sum() / n, 4.0),
            min(seen[_MARK].sum() / n, 4.0), min(seen[33] / n, 2.0), min(seen[124] / n, 2.0),
            _MARK[b[end - 1]].mean(), _UPPER[b[start]].mean(), seen[128:].sum() / len(b),
            np.log(n / len(counts)), (h[1:] == h[:-1]).mean() if n > 1 else 0.0,
            1 - len(distinct(runs)) / len(runs) if len(runs) else 0.0, counts.max() / n,
            np.log(len(lines)), np.log(n / len(lines)), 1 - len(set(lines)) / len(lines), float(-(p * np.log(p)).sum())]


def with_stats(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every document, as whole multiples of 1 / UNIT."""
    def run(batches):
        for b in batches:
            x = np.array([stats(t) for t in b.column("text").to_pylist()], float).reshape(b.num_rows, len(STATS))
            cols = np.rint(x * UNIT).astype(np.int64).T
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, cols)], ["doc_id", *STATS])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, " + ", ".join(f"{c} long" for c in STATS)
    return arrow_map(docs.select("doc_id", "text"), run, schema)


class Kernel:
    """Standardised statistics -> whole-number cosines, the same for a row in any batch."""

    def __init__(self, n: int, total: list[int], squares: list[int]):
        n = max(n, 1)
        self.mean = np.array([t / n for t in total])
        spread = np.array([max(s / n - (t / n) ** 2, 0.0) for s, t in zip(squares, total, strict=True)]) ** 0.5
        self.spread = np.where(spread < 1, 1.0, spread)
        r = np.random.default_rng(20)
        self.directions = np.rint(r.standard_normal((len(STATS), WIDTH)) * UNIT)
        self.phase = r.uniform(0, 2 * np.pi, WIDTH)

    def cosines(self, x: np.ndarray, bandwidth: float) -> np.ndarray:
        """[row, WIDTH + 1] whole numbers as floats, the last column constant."""
        z = np.rint(np.clip((x - self.mean) / self.spread, -8, 8) * UNIT)
        at = (z @ self.directions) / (UNIT * UNIT * bandwidth) + self.phase  # products and sums below 2^53: exact
        return np.hstack([np.rint(np.cos(at) * COSINE), np.full((len(x), 1), COSINE)])


def moments(rows: DataFrame) -> Kernel:
    """Count, sums and sums of squares over all documents: one row."""
    r = rows.agg(F.count("*"), *[F.sum(c) for c in STATS],
                 *[F.sum(F.col(c).cast("decimal(38,0)") * F.col(c)) for c in STATS]).first()
    k = len(STATS)
    return Kernel(r[0], [int(v or 0) for v in r[1:k + 1]], [int(v or 0) for v in r[k + 1:]])


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct statistics of labelled training rows, with good and all labels and a fold."""
    mod = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    known = (labels.select("doc_id", "quality").where("quality is not null and doc_id is not null").where(mod != HELD_OUT)
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    one = rows.where(F.col("doc_id").isNotNull() & (mod != HELD_OUT)).dropDuplicates(["doc_id", *STATS])
    mark = F.xxhash64(*STATS)
    found = (one.join(known, "doc_id").groupBy(*STATS)
             .agg(F.sum(F.col("quality").cast("long")).alias("good"), F.count("*").alias("n"))
             .withColumn("fold", F.pmod(mark, F.lit(FOLDS)).cast("int"))
             .withColumn("part", F.pmod(F.shiftright(mark, 20), F.lit(1 << 20))))
    found = written(found, "quality_labelled")
    share = TRAIN_ROWS / max(found.count(), 1)
    return found.where(F.col("part") < share * (1 << 20)).drop("part")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy() for c in STATS], 1).astype(float)


def normal_equations(train: DataFrame, kernel) -> dict[tuple[int, int], np.ndarray]:
    """(bandwidth, fold) -> products of [features, label], summed over partitions."""
    side = WIDTH + 2
    upper = np.triu_indices(side)

    def run(batches):
        total = np.zeros((len(BANDWIDTHS), FOLDS, side, side), np.int64)
        for b in batches:
            x, fold = _matrix(b), b.column("fold").to_numpy()
            y = np.rint(b.column("good").to_numpy() / b.column("n").to_numpy() * COSINE)
            for i, width in enumerate(BANDWIDTHS):
                z = np.hstack([kernel.value.cosines(x, width), y[:, None]])
                for k in range(FOLDS):
                    total[i, k] += (z[fold == k].T @ z[fold == k]).astype(np.int64)
        for i, k in np.argwhere(total[:, :, -2, -2] > 0).tolist():  # the constant's square: rows were seen
            yield pa.RecordBatch.from_pydict({"width": [i], "fold": [k], "sums": [total[i, k][upper]]},
                                             pa.schema([("width", pa.int32()), ("fold", pa.int32()), ("sums", pa.list_(pa.int64()))]))

    def add(t):
        sums = np.zeros(len(upper[0]), np.int64)
        for part in t.column("sums").chunks:
            sums += part.flatten().to_numpy().reshape(-1, len(sums)).sum(0)
        return pa.table({"width": t.column("width")[:1], "fold": t.column("fold")[:1],
                         "sums": pa.array([sums], pa.list_(pa.int64()))})

    schema = "width int, fold int, sums array<long>"
    # about TRAIN_ROWS rows at most: a fixed number of partitions sums them
    got = arrow_groups(arrow_map(train.repartition(SLOTS), run, schema), ["width", "fold"], add, schema).toArrow()
    out = {(i, k): np.zeros((side, side)) for i in range(len(BANDWIDTHS)) for k in range(FOLDS)}
    for w, f, s in zip(got["width"], got["fold"], got["sums"], strict=True):
        m = np.zeros((side, side))
        m[upper] = s.values.to_numpy()
        out[w.as_py(), f.as_py()] = m + np.triu(m, 1).T
    return out


def solved(m: np.ndarray, ridge: float) -> np.ndarray:
    """Weights for features divided by COSINE; the constant is not shrunk."""
    a, b = m[:-1, :-1] / COSINE ** 2, m[:-1, -1] / COSINE ** 2
    shrink = np.eye(len(b)) * ridge * max(a[-1, -1], 1)
    shrink[-1, -1] = 1e-9
    return np.linalg.solve(a + shrink, b)


def chosen(sums: dict) -> tuple[int, np.ndarray, list[np.ndarray]]:
    """(bandwidth, weights, weights without each fold) of the least squared error left out."""
    best = None
    for i in range(len(BANDWIDTHS)):
        folds = [sums[i, k] for k in range(FOLDS)]
        whole = sum(folds)
        for ridge in RIDGES:
            without = [solved(whole - m, ridge) for m in folds]
            error = sum(m[-1, -1] - 2 * w @ m[:-1, -1] + w @ m[:-1, :-1] @ w for w, m in zip(without, folds, strict=True))
            if best is None or error < best[0]:
                best = error, i, solved(whole, ridge), without
    return best[1:]


def rising(at: np.ndarray, good: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression (pooled neighbours): mean position and share of each pool."""
    pools: list[list[float]] = []
    for x, g, m in zip(at, good, n, strict=True):
        pools.append([x * m, g, m])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [u + v for u, v in zip(pools[-1], last, strict=True)]
    p = np.array(pools).reshape(-1, 3)
    return p[:, 0] / p[:, 2], p[:, 1] / p[:, 2]


def _raw(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.round((z / COSINE * w).sum(1), 9)


def calibration(train: DataFrame, kernel, width: int, without: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The rising line from raw scores to shares of good texts, from left-out scores."""
    def run(batches):
        for b in batches:
            z, fold = kernel.value.cosines(_matrix(b), BANDWIDTHS[width]), b.column("fold").to_numpy()
            raw = np.zeros(len(z))
            for k, w in enumerate(without):
                raw[fold == k] = _raw(z[fold == k], w)
            at = np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), b.column("good"), b.column("n")], ["at", "good", "n"])

    counted = (arrow_map(train, run, "at long, good long, n long")
               .groupBy("at").agg(F.sum(F.col("good") / F.col("n")).alias("good"), F.count("*").alias("n"))
               .orderBy("at").collect())  # at most BINS rows
    at = np.array([(r["at"] + 0.5) / BINS * (HIGH - LOW) + LOW for r in counted])
    return rising(at, np.array([round(r["good"], 9) for r in counted]), np.array([float(r["n"]) for r in counted]))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and the calibrated score of every document."""
    sc = docs.sparkSession.sparkContext
    rows = written(with_stats(docs), "quality_stats")
    train = labelled(rows, labels)
    good, n = train.agg(F.sum(F.col("good") / F.col("n")), F.count("*")).first()
    if not n or not 0 < good < n:
        return rows.select("doc_id", F.lit(float(good / n) if n else 0.5).alias("score"))
    kernel = sc.broadcast(moments(rows))
    width, weights, without = chosen(normal_equations(train, kernel))
    line = calibration(train, kernel, width, without)

    def run(batches):
        for b in batches:
            raw = _raw(kernel.value.cosines(_matrix(b), BANDWIDTHS[width]), weights)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.interp(raw, *line))], ["doc_id", "score"])

    return arrow_map(rows, run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def op11(spark, sf_dir: str) -> DataFrame:
    out = scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == HELD_OUT
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
