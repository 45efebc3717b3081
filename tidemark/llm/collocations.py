"""Operator 13: phrase collocations from one FM-index per shard.

Shards are stretches of the documents of one lang, about ``SHARD`` words each, cut
between pieces, as whole-number word ids (0 between pieces). A shard's index is
bidirectional: rows are the shard's positions sorted by the words that follow
(forward) and by the words that precede (backward), each with the column of the
word on the other side (the BWT). A phrase is an interval of rows in both; adding
a word at its left end maps the forward interval through that column, and moves
the backward interval by the words smaller than it; a word at the right end
likewise. Rows are sorted by as many words as a phrase may have (3), which is all
that intervals of such phrases need.

Phrases grow level by level, and a phrase is only grown from parts that are frequent in
the whole lang (a phrase is never more frequent than its parts):

1. Shards count their words; the sums name frequent words. A word's id is its
   (shard, place) in the first shard that has it: exact and without a dictionary.
2. Every shard learns which of its words are frequent, indexes those (others end
   a run), and extends each word to the right: bigrams with counts.
3. The sums name frequent bigrams; every shard learns which it has, and extends those
   to the left where the bigram formed there is frequent, too: trigrams.

What a shard learns are its own words or bigrams, so it is no larger than the shard.
Sums are over rows of (shard, phrase), one per shard that has the phrase.

Nulls: a null text is empty, a null lang is ``und``. Empty texts have no words. Repeated
rows count again. Ties are ranked by phrase in byte order. A text longer than a shard
is cut between pieces; a piece is never cut, so one without any mark is one task's
memory. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import arrow_map, ship, table, written

MIN_COUNT = 10
TOP = 2000
COVERED = 50  # per cent of a phrase's occurrences inside a longer one
SCALE = 1_000_000
SHARD = 1 << 20  # words
PLACE_BITS = 28  # of the places in a shard
PLACE = 1 << PLACE_BITS
SHARDS = 1 << 14  # shards of a task
NO_LANG = "und"

_END = b"\n"
#: fixed values: marks and line ends that end a piece; tabs separate words as blanks do
_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
_TOKEN = re.compile(rb"[^ \n]+|\n+")


def tokens(text: str | None) -> list[bytes]:
    """Words in order; a token that starts with a line end stands between pieces."""
    return _TOKEN.findall(text.encode("utf-8").lower().translate(_ENDS)) if text else []


# --- shards ---------------------------------------------------------------------

class _Ids(dict):
    """word -> 1, 2, ... in order of appearance; ends of pieces -> 0."""

    def __missing__(self, word: bytes) -> int:
        v = self[word] = 0 if word[:1] == _END else len(self) + 1
        if v == 0:
            del self[word]
        return v


def _cuts(ids: np.ndarray, size: int) -> list[np.ndarray]:
    """Parts of about ``size`` words, cut at ends of pieces."""
    ends = np.flatnonzero(ids == 0)
    out, at = [], 0
    while len(ids) - at > size + size // 2:
        i = np.searchsorted(ends, at + size)
        if i == len(ends):
            break
        out.append(ids[at:ends[i]])
        at = int(ends[i]) + 1
    return [*out, ids[at:]]


def shards(docs: DataFrame) -> DataFrame:
    """(shard, lang, ids, words, counts): ids as little-endian 32-bit numbers with 0
    between pieces; word i + 1 is words[i], and occurs counts[i] times."""
    from pyspark import TaskContext
    plain = docs.select(F.coalesce(F.col("lang"), F.lit(NO_LANG)).alias("lang"), "text")

    def run(batches):
        made = TaskContext.get().partitionId() * SHARDS
        held: dict[str, list] = {}

        def out(lang):
            nonlocal made
            known, parts, _ = held.pop(lang)
            words = np.array([*known, b""], object)[:-1]
            for ids in _cuts(np.concatenate(parts), SHARD):
                own, n = np.unique(ids[ids > 0], return_counts=True)
                local = np.zeros(len(words) + 1, np.int32)
                local[own] = np.arange(1, len(own) + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([made], pa.int64()), pa.array([lang]), pa.array([local[ids].tobytes()], pa.binary()),
                     pa.array([[w.decode("utf-8") for w in words[own - 1]]], pa.list_(pa.string())),
                     pa.array([n], pa.list_(pa.int64()))],
                    ["shard", "lang", "ids", "words", "counts"])
                made += 1

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                t = tokens(text)
                if t:
                    known, parts, n = cell = held.setdefault(lang, [_Ids(), [], 0])
                    parts += [np.fromiter(map(known.__getitem__, t), np.int32, len(t)), np.zeros(1, np.int32)]
                    cell[2] = n + len(t)
                    if cell[2] >= SHARD:
                        yield from out(lang)
        for lang in list(held):
            yield from out(lang)

    return arrow_map(plain, run, "shard long, lang string, ids binary, words array<string>, counts array<long>")


# --- the index ------------------------------------------------------------------

class Side:
    """One direction: rows in the order of the DEPTH words read from each position,
    and the word on the other side of each row."""

    def __init__(self, s: np.ndarray):
        """``s``: words in reading order, 0 = end of a run; starts and ends with 0."""
        m, bits = len(s), max(int(s.max(initial=0)).bit_length(), 1)
        read = np.concatenate((s, np.zeros(2, s.dtype))).astype(np.int64)
        key = read[:m] << bits | read[1:m + 1]
        if 3 * bits > 62:  # too wide for one number: pairs by rank
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        rows = np.argsort(key << bits | read[2:m + 2], kind="stable")
        self.other = np.concatenate((np.zeros(1, s.dtype), s[:-1]))[rows].astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=int(s.max(initial=0)) + 1))))
        # positions of every word in that column, to rank it before a row
        self.m = m
        order = np.argsort(self.other, kind="stable")
        self.places = self.other[order] * (m + 1) + order
        self.begins = np.searchsorted(self.places, np.arange(len(self.first)) * (m + 1))

    def rank(self, word: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Occurrences of ``word`` in the column before ``row``."""
        return np.searchsorted(self.places, word * (self.m + 1) + row) - self.begins[word]


class Index:
    """Bidirectional: a phrase is (row in forward, row in backward, size)."""

    def __init__(self, s: np.ndarray):
        s = np.concatenate((np.zeros(1, np.int32), s, np.zeros(1, np.int32)))
        self.ahead, self.back = Side(s), Side(s[::-1])

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = self.ahead.first
        return first[1:-1], self.back.first[1:-1], np.diff(first)[1:]

    @staticmethod
    def _grown(this: Side, at: np.ndarray, across: np.ndarray, size: np.ndarray):
        """Every phrase with every word at the end that ``this`` side's column holds:
        (phrase, word, row here, row across, size), by phrase and word."""
        of = np.repeat(np.arange(len(at)), size)
        rows = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(at, size)
        word = this.other[rows]
        width = len(this.first)
        code, n = np.unique(of * width + word, return_counts=True)
        of, word = code // width, code % width
        # across, the phrase's rows are in the order of these words: smaller ones first
        before = np.cumsum(n) - n
        start = before[np.searchsorted(of, np.arange(len(at)))] if len(of) else before
        there = across[of] + before - start[of] if len(of) else before
        keep = word > 0
        of, word, n, there = of[keep], word[keep], n[keep], there[keep]
        here = this.first[word] + this.rank(word, at[of])
        return of, word, here, there, n

    def left(self, at, back, size):
        """Phrases with a word before them: (phrase, word, forward, backward, size)."""
        return self._grown(self.ahead, at, back, size)

    def right(self, at, back, size):
        """Phrases with a word behind them: (phrase, word, forward, backward, size)."""
        of, word, here, there, n = self._grown(self.back, back, at, size)
        return of, word, there, here, n


def _frequent(ids: bytes, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shard's runs of frequent words: (words 1..k in order of ``places``, 0 = end)."""
    s = np.frombuffer(ids, "<i4")
    local = np.zeros(int(max(s.max(initial=0), places.max(initial=0))) + 1, np.int32)
    local[places] = np.arange(1, len(places) + 1)
    s = local[s]
    # only one end between runs
    return s[(s > 0) | (np.concatenate(([0], s[:-1])) > 0)]


def _bigrams(index: Index):
    """(left word, right word, forward, backward, size), by forward row."""
    of, word, here, there, n = index.right(*index.words())
    order = np.argsort(here, kind="stable")
    return tuple(x[order] for x in (of + 1, word, here, there, n))


# --- levels ---------------------------------------------------------------------

def _named(rows: DataFrame, by: list[str], least: int) -> DataFrame:
    """Rows of (own, ``by``, n), own = shard and place in one number, whose key has
    ``least`` in all shards: (own, id), id the first place that has the key, and on
    that row the key with its sum ``f``."""
    of = Window.partitionBy(*by)
    first = F.col("own") == F.col("id")
    return (rows.withColumn("f", F.sum("n").over(of)).withColumn("id", F.min("own").over(of))
            .where(F.col("f") >= least)
            .select("own", "id", *[F.when(first, F.col(c)).alias(c) for c in (*by, "f")]))


def _known(named: DataFrame, place: Column) -> DataFrame:
    """(shard, place, id): what a shard has of the named phrases."""
    return named.select(F.shiftright("own", PLACE_BITS).alias("shard"), place.cast("int").alias("place"), "id")


def _with(shards_: DataFrame, known: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(shard row, rows of known)`` for every shard."""
    ship(shards_.sparkSession)

    def run(key, left, right):
        return fn(left, right)

    return shards_.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(run, schema)


def _column(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).combine_chunks().to_numpy(zero_copy_only=False)


_PAIRS = "own long, a long, b long, n int"
_TRIPLES = "a long, b long, n int"


def _rows(schema: str, *columns) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, columns or [[]] * len(fields), strict=True)})


def _pairs(left: pa.Table, right: pa.Table) -> pa.Table:
    if not left.num_rows or not right.num_rows:
        return _rows(_PAIRS)
    right = right.sort_by("place")
    ids = _column(right, "id")
    a, b, _, _, n = _bigrams(Index(_frequent(left.column("ids")[0].as_py(), _column(right, "place"))))
    own = (left.column("shard")[0].as_py() << PLACE_BITS) + np.arange(len(a))
    return _rows(_PAIRS, own, ids[a - 1], ids[b - 1], n.astype(np.int32))


def _triples(left: pa.Table, right: pa.Table) -> pa.Table:
    """Trigrams as (bigram of the first two words, bigram of the last two, count).
    Places below 0 are bigrams."""
    if not left.num_rows or not right.num_rows:
        return _rows(_TRIPLES)
    right = right.sort_by("place")
    place, known = _column(right, "place"), _column(right, "id")
    pairs = np.flatnonzero(place < 0)
    if not len(pairs):
        return _rows(_TRIPLES)
    index = Index(_frequent(left.column("ids")[0].as_py(), place[place >= 0]))
    _, _, at, back, size = _bigrams(index)
    ids = np.full(len(at), -1, np.int64)
    ids[-1 - place[pairs]] = known[pairs]
    grow = np.flatnonzero(ids >= 0)
    of, _, here, _, n = index.left(at[grow], back[grow], size[grow])
    # the bigram at the front is the forward interval that holds this one
    front = ids[np.searchsorted(at, here, "right") - 1]
    keep = front >= 0
    return _rows(_TRIPLES, front[keep], ids[grow][of][keep], n[keep].astype(np.int32))


# --- scores ---------------------------------------------------------------------

def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(10^6 a^2 / (l r)) in decimals of 38 digits."""
    big = "decimal(20,0)"
    return F.call_function("div", (F.lit(SCALE).cast("decimal(7,0)") * a.cast(big)) * a.cast(big), left.cast(big) * right.cast(big))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of each lang."""
    parts = written(shards(docs), "colloc_shards")
    vocabulary = parts.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts"))).select(
        "lang", (F.shiftleft("shard", PLACE_BITS) + F.col("pos") + 1).alias("own"), F.col("col.words").alias("word"),
        F.col("col.counts").alias("n"))
    total = vocabulary.groupBy("lang").agg(F.sum("n").alias("n"))
    place = F.col("own").bitwiseAND(F.lit(PLACE - 1))
    named = written(_named(vocabulary, ["lang", "word"], min_count), "colloc_words")
    words = named.where("own = id").select("id", "lang", "word", "f")
    ids = parts.select("shard", "ids")
    has_words = _known(named, place)
    found = written(_named(_with(ids, has_words, _pairs, _PAIRS), ["a", "b"], min_count), "colloc_bigrams")
    bigrams = found.where("own = id").select("id", "a", "b", "f")
    has = has_words.unionByName(_known(found, -1 - place))
    trigrams = written(_with(ids, has, _triples, _TRIPLES).groupBy("a", "b").agg(F.sum("n").alias("f"))
                       .where(F.col("f") >= min_count), "colloc_trigrams")

    # a bigram goes when half of its occurrences or more are inside one trigram
    longest = (trigrams.select(F.col("a").alias("id"), "f").unionByName(trigrams.select(F.col("b").alias("id"), "f"))
               .groupBy("id").agg(F.max("f").alias("longer")))
    w = {x: words.select(F.col("id").alias(x), F.col("word").alias(f"{x}_word"), F.col("f").alias(f"{x}_f"), F.col("lang"))
         for x in "abc"}
    texts = bigrams.join(w["a"], "a").join(w["b"].drop("lang"), "b")
    two = (texts.join(longest, "id", "left")
           .where(F.col("longer").isNull() | (100 * F.col("longer") < COVERED * F.col("f")))
           .select("lang", F.concat_ws(" ", "a_word", "b_word").alias("phrase"), F.col("f").alias("a"),
                   F.col("a_f").alias("l"), F.col("b_f").alias("r"))
           .withColumn("score", _score(F.col("a"), F.col("l"), F.col("r"))))
    front = texts.select(F.col("id").alias("front"), "lang", F.col("a_word").alias("w1"), F.col("a_f").alias("f1"),
                         F.col("b_word").alias("w2"), F.col("f").alias("front_f"))
    behind = texts.select(F.col("id").alias("behind"), F.col("b_word").alias("w3"), F.col("b_f").alias("f3"), F.col("f").alias("behind_f"))
    three = (trigrams.select(F.col("a").alias("front"), F.col("b").alias("behind"), F.col("f").alias("n3"))
             .join(front, "front").join(behind, "behind")
             .withColumn("cut1", _score(F.col("n3"), F.col("f1"), F.col("behind_f")))
             .withColumn("cut2", _score(F.col("n3"), F.col("front_f"), F.col("f3"))))
    first = F.col("cut1") <= F.col("cut2")
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("n3").alias("a"),
                         F.when(first, F.col("f1")).otherwise(F.col("front_f")).alias("l"),
                         F.when(first, F.col("behind_f")).otherwise(F.col("f3")).alias("r"),
                         F.least("cut1", "cut2").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (two.unionByName(three).withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
            .join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op13(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
