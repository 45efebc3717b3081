"""Operator 1: toxicity after noisy-channel deobfuscation.

1. Character language model: counts of 4 characters in a row (a-z, blank,
   anything else: 28 classes) over all documents, interpolated to a table of
   28^4 numbers.
2. Restoration: a word that looks disguised (signs or digits among letters, a
   letter three times or more, single letters in a row) becomes a lattice:
   a sign may stand for letters, a separator may be dropped or end a word, a run
   of a letter may be shorter. Viterbi finds the most likely letters under the
   channel's costs and the language model.
3. Score: words and word beginnings of restored texts are features. From labelled
   rows, each gets the smoothed share of toxic texts among those that have
   it; a text scores as its most toxic feature, or the share of toxic texts among
   those without one.

Training reads labels of rows whose crc32(doc_id) mod 4 is not ``HELD_OUT`` only, and
at most ``TRAIN_ROWS`` of them (lowest hash first); language-model counts and
scores cover all documents. Language, source and ids are never features.

Null and empty texts score the floor (no features). Repeated rows get equal
scores; labelled texts that occur twice train once. A null label is left out. With
no labels at all every score is the floor of an untrained model. An empty table
gives an empty result. Extra columns are ignored by ``scored``.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .native import text_key
from .store import arrow_map, table, written

HELD_OUT = 2
TRAIN_ROWS = 50_000
THRESHOLD = 0.3
MIN_TEXTS = 3  # toxic texts a feature needs
SMOOTH = 8.0  # texts of the average kind added to every feature
HELD = 400_000  # features a task sums before it passes them on
BEGINNINGS = (3, 4, 5, 6)
KINDS = 28

# Letters that a sign may stand for.
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "#": "h", "%": "x",
         "€": "e", "£": "l", "¡": "i", "µ": "u", "×": "x"}
SEPARATORS = " .-_*~'^,:;/\\"
SIGN_COST, DROP_COST, SHORTEN_COST, BREAK_COST, ANY_COST = 1.0, 0.3, 0.3, 1.5, 3.0

_WORD = re.compile(r"\S+")
_SPACED = re.compile(r"(?:(?<=\s)|^)\S(?:[^\S\n]\S){2,}(?=\s|$)")
_APART = re.compile(r"(?:(?<=\s)|^)\S(?:\s+\S){2,}(?=\s|$)")  # any blanks between the letters
_EDGE = ".,;:!?\"'()[]{}<>*#$%&|-_~`"
_NO_LETTER = "".join(c for c in _EDGE if c not in SIGNS)  # marks that stand for no letter
_INNER = re.compile(r"[^\W\d_][" + re.escape("".join(SIGNS) + SEPARATORS.strip()) + r"]+[^\W\d_]|"
                    r"^[" + re.escape("".join(SIGNS)) + r"]+[^\W\d_]|[^\W\d_][0-9@$]+$")
_RUN = re.compile(r"([^\W\d_])\1\1")


def kind(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 0 if c.isspace() else 27


_KIND_OF_BYTE = np.array([kind(chr(b).lower()) if b < 128 else 27 for b in range(256)], np.int32)
PIECE = 1 << 19  # characters that are counted at once


def char_counts(docs: DataFrame) -> np.ndarray:
    """Counts of 4 classes in a row over all texts: at most 28^4 rows reach the driver."""
    def run(batches):
        total, held, size = np.zeros(KINDS ** 4, np.int64), [], 0
        for b in batches:
            for t in b.column("text").to_pylist():
                if not t:
                    continue
                c = _KIND_OF_BYTE[np.frombuffer(f" {t} ".encode("utf-8"), np.uint8)]
                two = c[:-1] * KINDS + c[1:]
                held.append(two[:-2] * KINDS ** 2 + two[2:])
                size += len(c)
                if size > PIECE:
                    total += np.bincount(np.concatenate(held), minlength=KINDS ** 4)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=KINDS ** 4)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    got = arrow_map(docs.select("text"), run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(KINDS ** 4, np.int64)
    out[got.column("at").to_numpy()] = got.column("n").to_numpy()
    return out


def language_model(counts: np.ndarray) -> np.ndarray:
    """log P(c4 | c1 c2 c3), each order interpolated with the shorter one."""
    c = counts.reshape((KINDS,) * 4).astype(float)
    p = np.full(KINDS, 1.0 / KINDS)
    for n in (c.sum((0, 1, 2)), c.sum((0, 1)), c.sum(0), c):
        p = (n + 5.0 * p) / (n.sum(-1, keepdims=True) + 5.0)
    return np.log(p).reshape(-1)


class Restorer:
    """Viterbi over the lattice of a disguised word."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.memory: dict[str, str] = {}
        self.seen: dict[str, tuple[str, ...]] = {}

    def options(self, s: str) -> list[tuple[int, list[tuple[str, float]]]]:
        """(characters taken, [(what they may stand for, cost)]) from left to right."""
        out, i = [], 0
        while i < len(s):
            c, j = s[i], i + 1
            while j < len(s) and s[j] == c:
                j += 1
            n = j - i
            if c.isalpha():
                if n >= 3:
                    out.append([(c, SHORTEN_COST), (c * 2, SHORTEN_COST)])
                else:
                    out.append([(c * n, 0.0)] + ([(c, SHORTEN_COST + 1)] if n == 2 else []))
            elif c in SEPARATORS:
                out.append([("", DROP_COST), (" ", BREAK_COST)]
                           + ([(x, ANY_COST) for x in "aeiou"] if c == "*" else []))
            elif c in SIGNS:
                each = [(x, SIGN_COST) for x in SIGNS[c]] + [("", ANY_COST)]
                out += [each] * min(n, 2) if n < 3 else [each]
            else:
                out.append([(c, 0.0)])
            i = j
        return out

    def restore(self, s: str) -> str:
        """The most likely text behind ``s`` (lower case)."""
        if len(self.memory) > 200_000:
            self.memory.clear()
        if s in self.memory:
            return self.memory[s]
        lm = self.model
        # state: the last 3 classes; value: (cost, letters as a linked list)
        best: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
        for step in [*self.options(s), [(" ", 0.0)]]:
            new: dict[int, tuple[float, tuple]] = {}
            for state, (cost, past) in best.items():
                for letters, extra in step:
                    at, total, tail = state, cost + extra, past
                    for c in letters:
                        k = at * KINDS + kind(c)
                        total -= lm[k]
                        at = k % KINDS ** 3
                        tail = (tail, c)
                    if at not in new or total < new[at][0]:
                        new[at] = (total, tail)
            best = new
        _, tail = min(best.values(), key=lambda x: x[0])
        out = []
        while tail:
            tail, c = tail
            out.append(c)
        self.memory[s] = restored = "".join(out[::-1]).strip()
        return restored


    def words_of(self, token: str) -> tuple[str, ...]:
        """The words a blank-separated piece of a lower-case text may stand
        for: as it stands without marks at its edges, and restored."""
        if len(self.seen) > 300_000:
            self.seen.clear()
        got = self.seen.get(token)
        if got is None:
            plain = token.strip(_EDGE)
            found = {plain}
            if disguised(plain):
                found.update(self.restore(plain).split())
            if not token.isalpha():  # a sign at the edge may be a letter, too
                for core in {token.strip(".,;:?\"'()[]{}"), token.strip(_NO_LETTER)}:
                    if core != plain and any(map(str.isalpha, core)):
                        found.update(self.restore(core).split())
            found.discard("")
            got = self.seen[token] = tuple(found)
        return got


def disguised(word: str) -> bool:
    return not word.isalpha() and _INNER.search(word) is not None or _RUN.search(word) is not None


def spaced_words(low: str, tokens: list[str], fix: Restorer) -> list[str]:
    """Words behind single letters in a row, a blank or any blanks between them;
    ``tokens`` are the pieces of ``low`` between blanks."""
    if b"\1\1\1" not in bytes([len(t) == 1 for t in tokens]):
        return []
    rows = dict.fromkeys(" ".join(m.split()) for r in (_SPACED, _APART) for m in r.findall(low))
    return [w for m in rows for w in fix.restore(m).split()]


def restored_words(text: str, fix: Restorer) -> set[str]:
    """Distinct words of the restored text, with the words as they stand."""
    low = text.lower()
    tokens = low.split()
    found = set(spaced_words(low, tokens, fix))
    for t in set(tokens):
        found.update(fix.words_of(t))
    return found


def features(word: str) -> list[str]:
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) > n)]


def train(docs: DataFrame, labels: DataFrame, model) -> tuple[dict[str, tuple[float, float]], float]:
    """(feature -> (rank, score), score without features) from the labelled training rows."""
    spark = docs.sparkSession
    mod = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    known = (labels.select("doc_id", "toxic").where("toxic is not null and doc_id is not null").where(mod != HELD_OUT)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS))
    rows = (docs.select("doc_id", "text").join(known, "doc_id").where("text is not null")
            .groupBy(text_key(F.col("text")).alias("text_id")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")))

    def run(batches):
        fix = Restorer(model.value)
        n, toxic = Counter(), Counter()  # texts by feature

        def sums():
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(n), pa.string()), pa.array(np.fromiter(map(toxic.__getitem__, n), np.int64, len(n))),
                 pa.array(np.fromiter(n.values(), np.int64, len(n)))], ["feature", "t", "n"])
            n.clear()
            toxic.clear()
            return out

        for b in batches:
            for t, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                f = {x for w in restored_words(t, fix) for x in features(w)}
                n.update(f)
                if y:
                    toxic.update(dict.fromkeys(f, int(y)))
                if len(n) > HELD:
                    yield sums()
        yield sums()

    rows = written(rows.select("text", "toxic"), "labelled")
    n, toxic = rows.agg(F.count("*"), F.sum("toxic")).first()
    base = (toxic or 0) / n if n else 0.0
    counted = (arrow_map(rows, run, "feature string, t long, n long").groupBy("feature")
               .agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
               .withColumn("p", (F.col("t") + SMOOTH * base) / (F.col("n") + SMOOTH))
               .where((F.col("t") >= MIN_TEXTS) & (F.col("p") >= max(0.2, 1.5 * base))))
    rank = {r["feature"]: r["p"] for r in counted.collect()}  # bounded by TRAIN_ROWS
    # a decision list: a text is judged by its highest ranked feature alone, so
    # the share is taken again over the texts where a feature is that one
    lead = _leading(rows.select("text", "toxic"), spark.sparkContext.broadcast((model.value, rank)), ["toxic"])
    seen = {r["feature"]: (r["t"], r["n"]) for r in
            lead.groupBy("feature").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).collect()}
    t, n = seen.pop("", (0, 0))
    floor = (t + 0.5 * base) / (n + 1.0)
    return ({f: (p, (seen[f][0] + SMOOTH * floor) / (seen[f][1] + SMOOTH) if f in seen else floor)
             for f, p in rank.items()}, floor)


def _leading(docs: DataFrame, model, keep: list[str]) -> DataFrame:
    """``keep`` and the highest ranked feature of each text ("" if none)."""
    types = dict(docs.dtypes)

    def run(batches):
        lm, rank = model.value
        fix = Restorer(lm)

        def best(words):
            return max(((rank[f], f) for w in words for f in features(w) if f in rank), default=(0.0, ""))

        class Memory(dict):
            def __missing__(self, token):
                v = self[token] = best(fix.words_of(token))
                return v

        tokens = Memory()
        for b in batches:
            out = []
            for t in b.column("text").to_pylist():
                if len(tokens) > 400_000:
                    tokens.clear()
                low = t.lower() if t else ""
                pieces = low.split()
                out.append(max(max(map(tokens.__getitem__, set(pieces)), default=(0.0, "")), best(spaced_words(low, pieces, fix)))[1])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(out, pa.string())], [*keep, "feature"])

    return arrow_map(docs, run, ", ".join(f"{c} {types[c]}" for c in keep) + ", feature string")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and score of every document."""
    sc = docs.sparkSession.sparkContext
    lm = language_model(char_counts(docs))
    weights, floor = train(docs, labels, sc.broadcast(lm))
    lead = _leading(docs.select("doc_id", "text"), sc.broadcast((lm, {f: r for f, (r, _) in weights.items()})), ["doc_id"])
    share = docs.sparkSession.createDataFrame(
        [("", floor), *((f, p) for f, (_, p) in weights.items())], "feature string, score double")
    return lead.join(F.broadcast(share), "feature").select("doc_id", "score")


def op1(spark, sf_dir: str) -> DataFrame:
    out = scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == HELD_OUT
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
