"""Operator 8: quality rules as weak supervision.

Every rule looks at a document's features and votes good (1), bad (-1) or
abstains (0). No rule decides alone: expectation-maximisation on the counts of
vote patterns estimates the share of good documents and, for every rule, how
often it votes each way on good and on bad documents. A document is kept when
its posterior probability of being good reaches ``KEEP_FROM``.

Features are computed batch-wise over whole texts (one Arrow pass, no shuffle).
The only thing gathered is the number of documents per vote pattern: at most
3^rules rows whatever the input. EM runs on those counts with fixed starting
values, so the result is deterministic.

Null and empty texts have no words: all features 0, ``base_failed`` true, not
kept. Repeated rows get equal verdicts. An empty table gives an empty result.
Extra columns are ignored by ``judged`` and kept by ``keep_good``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import arrow_map, table, written
from .text import ngram_hashes, word_hashes

KEEP_FROM = 0.5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = BASE + ("n_lines", "n_upper", "n_lower", "n_plain", "n_bangs", "n_adjacent")
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_BLANKS = " \t\n\r\x0b\x0c"
#: every byte as blank, closing mark (symbol or "!") or other
_KIND = bytes(32 if chr(b) in _BLANKS else 49 if b in _SYMBOLS + b"!" else 48 for b in range(256))


def _count(raw: bytes, of: bytes) -> int:
    return len(raw) - len(raw.translate(None, of))


def repeat_words(h: np.ndarray, k: int = 5) -> int:
    """Words inside ``k``-word windows that occur twice or more, first included."""
    grams = ngram_hashes(h, k)
    if len(grams) < 2:
        return 0
    order = np.argsort(grams)
    s = grams[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    again = np.zeros(len(s), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(h) + 1, np.int32)
    edge[:len(grams)] += again
    edge[k:k + len(grams)] -= again
    return int((np.cumsum(edge[:-1]) > 0).sum())


def features(text: str | None) -> tuple[int, ...]:
    """The values of ``FEATURES`` for one text."""
    if not text:
        return (0,) * len(FEATURES)
    raw = text.encode("utf-8")
    h = word_hashes(raw)
    if not len(h):
        return (0,) * len(FEATURES)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    kinds = raw.translate(_KIND)
    marked = kinds.count(b"1 ") + kinds.endswith(b"1")
    return (len(h), len(text) - sum(map(text.count, _BLANKS)), _count(raw, _SYMBOLS),
            len(lines) - len(set(lines)), repeat_words(h), len(lines), _count(raw, _UPPER), _count(raw, _LOWER),
            len(h) - marked, raw.count(b"!!"), int((h[1:] == h[:-1]).sum()))


def with_features(docs: DataFrame) -> DataFrame:
    """doc_id and the feature columns of every document."""
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, " + ", ".join(f"{c} long" for c in FEATURES)

    def run(batches):
        for b in batches:
            rows = [features(t) for t in b.column("text").to_pylist()]
            cols = np.array(rows, np.int64).reshape(len(rows), len(FEATURES)).T
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, cols)], ["doc_id", *FEATURES])

    return arrow_map(docs.select("doc_id", "text"), run, schema)


def _bad(when: Column) -> Column:
    return F.when(when, -1).otherwise(0)


def rules() -> dict[str, Column]:
    """name -> vote. Each symptom rule votes bad or abstains; ``prose`` also
    votes good. Thresholds are fixed shares of a document's words or letters."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    letters = F.greatest(F.col("n_upper") + F.col("n_lower"), F.lit(1))
    normal = (F.col("word_chars") >= 2 * n) & (F.col("word_chars") <= 11 * n)
    return {
        "symbols": _bad(F.col("n_symbols") * 5 >= n),
        "marked_words": _bad(F.col("n_plain") * 4 <= 3 * n),
        "word_length": _bad(~normal),
        "repeats": _bad(F.col("n_repeat_words") * 10 >= n),
        "same_word": _bad((F.col("n_adjacent") > 3) & (F.col("n_adjacent") * 5 >= n)),
        "duplicate_lines": _bad((F.col("n_dup_lines") > 1) & (F.col("n_dup_lines") * 10 >= 3 * F.col("n_lines"))),
        "capitals": _bad(F.col("n_upper") * 2 >= letters),
        "bangs": _bad(F.col("n_bangs") * 10 >= n),
        "prose": F.when((F.col("n_plain") * 20 >= 19 * n) & normal & (F.col("n_adjacent") * 20 <= n), 1)
                  .when(F.col("n_plain") * 10 <= 7 * n, -1).otherwise(0),
    }


# What is believed of a rule before any document: P(bad, abstain, good vote)
# on bad and on good documents.
SYMPTOM = ((0.35, 0.64, 0.01), (0.01, 0.98, 0.01))
PROSE = ((0.40, 0.30, 0.30), (0.01, 0.09, 0.90))
#: weight of those beliefs, as a share of the number of documents: one class of
#: junk can't redefine "bad" as its own symptom
BELIEF = 0.5


def estimate(patterns: list[tuple[tuple[int, ...], int]], steps: int = 100) -> tuple[float, np.ndarray]:
    """EM: share of good documents, and P(vote | class) as [class, rule, vote + 1]."""
    m = len(patterns[0][0]) if patterns else len(rules())
    votes = np.array([p for p, _ in patterns], int).reshape(len(patterns), m) + 1
    n = np.array([c for _, c in patterns], float)
    believed = np.array([[SYMPTOM[c]] * (m - 1) + [PROSE[c]] * min(m, 1) for c in (0, 1)]).reshape(2, m, 3)
    table_, prior, weight = believed.copy(), 0.85, BELIEF * n.sum()
    for _ in range(steps if len(patterns) else 0):
        good = posterior(votes - 1, prior, table_)
        prior = float(((good * n).sum() + 0.85 * weight) / (n.sum() + weight))
        for c, share in ((1, good), (0, 1 - good)):
            size = BELIEF * (share * n).sum() + 10
            for j in range(m):
                got = np.bincount(votes[:, j], weights=share * n, minlength=3) + size * believed[c, j]
                table_[c, j] = got / got.sum()
    return prior, table_


def posterior(votes: np.ndarray, prior: float, table_: np.ndarray) -> np.ndarray:
    log = np.log(table_)
    at = np.arange(votes.shape[1])
    good = np.log(prior) + log[1][at, votes + 1].sum(1)
    bad = np.log(1 - prior) + log[0][at, votes + 1].sum(1)
    return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))


def votes_of(feats: DataFrame) -> DataFrame:
    return feats.select("*", F.struct(*[v.cast("int").alias(k) for k, v in rules().items()]).alias("votes"))


def learned(voted: DataFrame) -> tuple[float, np.ndarray]:
    """EM on the number of documents per vote pattern: at most 3^rules rows."""
    counted = [(tuple(r["votes"]), r["n"]) for r in
               voted.where("n_words > 0").groupBy("votes").agg(F.count("*").alias("n")).collect()]
    return estimate(sorted(counted))


def verdicts(voted: DataFrame, model: tuple[float, np.ndarray]) -> DataFrame:
    """p_good, base_failed and kept from the estimated tables, as column expressions."""
    prior, tab = model
    logit = F.lit(float(np.log(prior / (1 - prior))))
    for j, k in enumerate(rules()):
        odds = np.log(tab[1, j] / tab[0, j])
        logit = logit + F.element_at(F.array(*[F.lit(float(x)) for x in odds]), F.col(f"votes.{k}") + 2)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    p = 1 / (1 + F.exp(-logit))
    return (voted.withColumn("p_good", F.when(F.col("n_words") > 0, p).otherwise(F.lit(0.0)))
            .withColumn("base_failed", base)
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= KEEP_FROM)))


def judged(docs: DataFrame) -> DataFrame:
    """Features, votes and posterior of every document, base rule and verdict."""
    voted = written(votes_of(with_features(docs)), "quality_votes")
    return verdicts(voted, learned(voted))


def keep_good(docs: DataFrame) -> DataFrame:
    """The kept documents with their own columns. The features are computed again
    beside the rows, so no row moves."""
    model = learned(written(votes_of(with_features(docs)), "quality_votes"))
    own = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), F.col("text"))
    schema = f"row {dict(packed.dtypes)['row']}, " + ", ".join(f"{c} long" for c in FEATURES)

    def run(batches):
        for b in batches:
            cols = np.array([features(t) for t in b.column("text").to_pylist()], np.int64).reshape(b.num_rows, len(FEATURES)).T
            yield pa.RecordBatch.from_arrays([b.column("row"), *map(pa.array, cols)], ["row", *FEATURES])

    return verdicts(votes_of(arrow_map(packed, run, schema)), model).where("kept").select("row.*")


def op8(spark, sf_dir: str) -> DataFrame:
    out = judged(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *BASE, "base_failed", "kept", "p_good")
