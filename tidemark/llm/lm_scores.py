"""Operator 9: stupid-backoff scores by joining n-gram count tables.

A word w after v scores c(v w) / c(v) if the bigram was seen at least
``MIN_BIGRAM`` times in the corpus, else ``ALPHA`` * c(w) / N; a text's first word
has no v. All texts are both corpus and scored texts, and every word counts.

* Unigrams: words are counted over all documents by an aggregate, and every word
  keeps its own count. The counts of the head (words with at least ``VOCAB_SHARE``
  of all occurrences, so at most 1 / VOCAB_SHARE words) are broadcast; all other
  words are counted and looked up in the partition of their hash.
* Bigrams of two words that each make up ``HOT_SHARE`` of the corpus (at most
  1 / HOT_SHARE words, squared) are summed to a small table and joined map-side,
  so no group of the shuffle holds a larger share than that.
* All other bigrams are counted by the partition of their hash. A task takes its
  texts in *chunks* of about ``CHUNK`` words (a text that a chunk holds many times
  is kept once with its number). For every bucket a chunk sends the sorted distinct
  64-bit keys that fall there with their numbers, and gets back one number
  per key in the same order: the count in the corpus. Words outside the
  head are asked for in the same way. The chunk's compressed texts meet the
  answers, and every text is summed there.

So what travels follows the number of words, and not that of buckets: a key and an
answer per distinct bigram of a chunk, and the compressed texts.

Null and empty texts, and texts without words, have 0 words and score 0. Equal
texts are all counted and get equal scores (scores are joined by text digest).
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .native import text_key
from .store import arrow_groups, arrow_map, bucket_count, slices, table, text_bytes, written
from .text import _STEP, U, lower_hashes, mix, word_hashes

ALPHA = 0.4
MIN_BIGRAM = 2
VOCAB_SHARE = 2e-7
HOT_SHARE = 1e-3
BYTES_PER_BUCKET = 16 << 20
GATHER = 2_000_000
CHUNK = 1_500_000  # words whose texts are summed together
IDS, PAIRS, WORDS, TEXTS = range(4)  # id pairs, word pairs with a rare word, rare words; a chunk's texts
RARE = U(1 << 63)  # marks the hash of a word outside the head among ids
#: keys of a chunk and their numbers, or (kind TEXTS) text digests, lengths and compressed texts of a chunk
ASKED = pa.schema([("kind", pa.int64()), ("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()),
                   ("numbers", pa.binary()), ("texts", pa.binary())])
ASKED_SQL = "kind long, bucket long, chunk long, keys binary, numbers binary, texts binary"
SCORED_SQL = "text_id string, n_words long, n_seen long, log_score double"
ZSTD = 6  # level
SLICE = 500  # rows that are Python objects at a time


class Vocabulary:
    """Ids of the head's words by descending count (0 is a word outside the
    head), and counts by id. Words are known by their 64-bit hash."""

    def __init__(self, words: np.ndarray, n: np.ndarray, total: int):
        order = np.lexsort((words, -n))
        self.counts = np.concatenate(([1], n[order])).astype(np.int64)
        self.total = total
        by_hash = np.argsort(words[order])
        self.words, self.at = words[order][by_hash], by_hash + 1
        self.hot = int((n >= max(2, HOT_SHARE * self.total)).sum())

    def ids(self, h: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(h), np.int64)
        i = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[i] == h, self.at[i], 0)


def word_counts(docs: DataFrame) -> DataFrame:
    """word (its hash), n over all documents."""
    def count(h: list) -> pa.RecordBatch:
        w, n = np.unique(np.concatenate(h), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            for t in b.column("text").to_pylist():
                held.append(lower_hashes(t))
                size += len(held[-1])
                if size > GATHER:
                    yield count(held)
                    held, size = [], 0
        if held:
            yield count(held)

    return arrow_map(docs.select("text"), run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame) -> tuple[Vocabulary, int]:
    """The head, and the number of words that occur once."""
    counts = written(word_counts(docs), "word_counts")
    total, once = counts.agg(F.sum("n"), F.count_if(F.col("n") == 1)).first()
    total = total or 0
    head = counts.where(F.col("n") >= max(2.0, VOCAB_SHARE * total)).toArrow()  # at most 1 / VOCAB_SHARE rows
    n = head.column("n").to_numpy().astype(np.int64)
    return Vocabulary(head.column("word").to_numpy().astype(np.int64).view(U), n, total), once


def hot_bigrams(docs: DataFrame, vocab) -> np.ndarray:
    """Counts [v, w] of bigrams of the hot words (ids 1 to ``hot``)."""
    def run(batches):
        v = vocab.value
        m, total = v.hot + 1, np.zeros((v.hot + 1) ** 2, np.int64)
        for b in batches:
            pairs = [np.empty(0, np.int64)]
            for t in b.column("text").to_pylist():
                i = v.ids(lower_hashes(t))
                both = (i[1:] <= v.hot) & (i[:-1] <= v.hot) & (i[1:] > 0) & (i[:-1] > 0)
                pairs.append(i[:-1][both] * m + i[1:][both])
            total += np.bincount(np.concatenate(pairs), minlength=m * m)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    m = vocab.value.hot + 1
    got = (arrow_map(docs.select("text"), run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))).toArrow()
    out = np.zeros(m * m, np.int64)
    out[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    return out


def _columns(keys: np.ndarray) -> bytes:
    """64-bit keys byte by byte: the first bytes of sorted keys repeat, and a shuffle's codec sees that."""
    return np.ascontiguousarray(keys.astype(">u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _keys(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(">u8").ravel().astype(U)


def _small(n: np.ndarray) -> bytes:
    """Whole numbers of 0 or more: a byte each, those from 255 in 8 more."""
    return np.minimum(n, 255).astype(np.uint8).tobytes() + n[n >= 255].astype("<i8").tobytes()


def _numbers(raw: bytes, size: int) -> np.ndarray:
    n = np.frombuffer(raw, np.uint8, size).astype(np.int64)
    n[n == 255] = np.frombuffer(raw[size:], "<i8")
    return n


def _cuts(ascending: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of equal values."""
    cuts = np.flatnonzero(np.concatenate(([True], ascending[1:] != ascending[:-1])))
    return list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(ascending)], strict=True))


class Words:
    """The words of a chunk's texts, one text behind the other."""

    def __init__(self, v: Vocabulary, hashes: list[np.ndarray]):
        self.sizes = np.array([len(h) for h in hashes], np.int64)
        h = np.concatenate([np.empty(0, U), *hashes])
        self.ids = i = v.ids(h)
        self.first = np.zeros(len(h), bool)
        self.first[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = True
        x, y, inside = i[:-1], i[1:], ~self.first[1:]
        rare = ((x == 0) | (y == 0)) & inside
        hot = (x <= v.hot) & (y <= v.hot) & inside & ~rare
        cold = inside & ~rare & ~hot
        code = np.where(i > 0, i.astype(U), h | RARE)
        #: the second word of each bigram of hot words
        self.hot = np.flatnonzero(hot) + 1
        #: by kind: places (of the second word), and keys
        self.asked = [
            (np.flatnonzero(cold) + 1, mix((x[cold].astype(U) << U(32)) | y[cold].astype(U))),
            (np.flatnonzero(rare) + 1, mix(code[:-1][rare] * _STEP + code[1:][rare])),
            (np.flatnonzero(i == 0), mix(code[i == 0]))]


def scores(docs: DataFrame, pool_once: bool = True) -> DataFrame:
    """doc_id, n_words, n_seen (words scored by a bigram), log_score.
    ``pool_once``: words that occur once count together, as one unknown word;
    else each has its count of 1 (a bigram with one is never seen twice)."""
    sc = docs.sparkSession.sparkContext
    buckets = bucket_count(text_bytes(docs), BYTES_PER_BUCKET)
    head, once = vocabulary(docs)
    single = max(once, 1) if pool_once else 1  # the count of a word that occurs once
    vocab = sc.broadcast(head)
    hot = sc.broadcast(hot_bigrams(docs, vocab))
    keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_id"))

    def bucket_of(hashed):
        return ((hashed >> U(32)) * U(buckets)) >> U(32)  # ascending, if ``hashed`` is

    def ask(batches):
        from pyspark import TaskContext
        v, part, made = vocab.value, TaskContext.get().partitionId(), 0
        owners, raws, hashes, held = {}, [], [], 0

        def pack():
            words, names = Words(v, hashes), b"".join(owners)
            # a task that runs again on other rows makes other chunks
            chunk = xxhash.xxh3_64_intdigest(names, seed=part << 32 | made) >> 1
            weight = np.repeat(np.fromiter(owners.values(), np.int64, len(owners)), words.sizes)
            blob = pa.Codec("zstd", ZSTD).compress(b"".join(raws), asbytes=True)
            lengths = np.array([len(r) for r in raws], "<i8").tobytes()
            out = [[TEXTS], [chunk % buckets], [chunk], [names], [lengths], [blob]]
            for kind, (at, keys) in enumerate(words.asked):
                if not len(keys):
                    continue
                order = np.argsort(keys)
                keys, n = keys[order], weight[at[order]]
                start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
                keys, n = keys[start], np.add.reduceat(n, start)
                bucket = bucket_of(keys)
                for lo, hi in _cuts(bucket):
                    row = kind, int(bucket[lo]), chunk, _columns(keys[lo:hi]), _small(n[lo:hi]), None
                    for column, x in zip(out, row, strict=True):
                        column.append(x)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, ASKED, strict=True)], schema=ASKED)

        for b in slices(batches, SLICE):
            for t, i in zip(b.column("text").to_pylist(), b.column("text_id").to_pylist(), strict=True):
                own = bytes.fromhex(i)
                if own in owners:  # a copy: kept once with its number
                    owners[own] += 1
                    continue
                raw = (t or "").encode("utf-8").lower()
                owners[own] = 1
                raws.append(raw)
                hashes.append(word_hashes(raw))
                held += len(hashes[-1]) + len(raw) // 16
                if held > CHUNK:
                    yield pack()
                    owners, raws, hashes, held, made = {}, [], [], 0, made + 1
        if owners:
            yield pack()

    def answer(t: pa.Table) -> pa.Table:
        """The corpus count of each key of each chunk, in place of its numbers."""
        if t.column("kind")[0].as_py() == TEXTS:
            return t
        keys = [_keys(k) for k in t.column("keys").to_pylist()]
        sizes = [len(k) for k in keys]
        n = np.concatenate([_numbers(r, k) for r, k in zip(t.column("numbers").to_pylist(), sizes, strict=True)])
        keys = np.concatenate(keys)
        order = np.argsort(keys)
        keys = keys[order]
        start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        total = np.add.reduceat(n[order], start)
        n[order] = np.repeat(total, np.diff(np.append(start, len(keys))))
        ends = np.cumsum(sizes)
        numbers = [_small(n[e - k:e]) for e, k in zip(ends, sizes, strict=True)]
        size = pa.array([np.int64(k).tobytes() for k in sizes], pa.binary())
        return t.set_column(3, "keys", size).set_column(4, "numbers", pa.array(numbers, pa.binary()))

    def score(t: pa.Table) -> pa.Table:
        """Sums of a chunk's texts, by the answers to its keys."""
        v, h = vocab.value, hot.value
        got = {k: [] for k in (IDS, PAIRS, WORDS, TEXTS)}
        for r in t.sort_by([("kind", "ascending"), ("bucket", "ascending")]).to_pylist():
            got[r["kind"]].append(r)
        if len(got[TEXTS]) != 1:
            raise ValueError("a chunk's texts are not there once")
        names, lengths, blob = (got[TEXTS][0][c] for c in ("keys", "numbers", "texts"))
        names, lengths = np.frombuffer(names, "V16"), np.frombuffer(lengths, "<i8")
        ends = np.cumsum(lengths)
        raw = pa.Codec("zstd").decompress(blob, int(ends[-1]), asbytes=True)
        words = Words(v, [word_hashes(raw[e - k:e]) for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)])
        i = words.ids
        pair, count = np.zeros(len(i), np.int64), v.counts[i]
        pair[words.hot] = h[i[words.hot - 1] * (v.hot + 1) + i[words.hot]]
        for kind, (at, keys) in enumerate(words.asked):
            known = [_numbers(r["numbers"], int(np.frombuffer(r["keys"], np.int64)[0])) for r in got[kind]]
            known = np.concatenate([np.empty(0, np.int64), *known])
            distinct_keys, place = np.unique(keys, return_inverse=True)
            if len(known) != len(distinct_keys):
                raise ValueError("a chunk's keys and the answers differ")
            if kind == WORDS:
                known[known == 1] = single
                count[at] = known[place]
            else:
                pair[at] = known[place]
        logs = np.log(count)
        value = logs + (np.log(ALPHA) - np.log(max(v.total, 1)))
        value[words.first] -= np.log(ALPHA)  # the first word is not backed off
        seen = np.flatnonzero(pair >= MIN_BIGRAM)
        value[seen] = np.log(pair[seen]) - logs[seen - 1]
        who = np.repeat(np.arange(len(names)), words.sizes)
        return pa.table({
            "text_id": pa.array([x.tobytes().hex() for x in names], pa.string()), "n_words": pa.array(words.sizes),
            "n_seen": pa.array(np.bincount(who[seen], minlength=len(names)).astype(np.int64)),
            "log_score": pa.array(np.bincount(who, weights=value, minlength=len(names)).astype(float))})

    asked = arrow_map(keyed.select("text", "text_id"), ask, ASKED_SQL)
    answered = arrow_groups(asked, ["kind", "bucket"], answer, ASKED_SQL)
    # a text of several chunks has the same sums in each
    per_text = (arrow_groups(answered, ["chunk"], score, SCORED_SQL).groupBy("text_id")
                .agg(*(F.max(c).alias(c) for c in ("n_words", "n_seen", "log_score"))))
    return keyed.select("doc_id", "text_id").join(per_text, "text_id").drop("text_id")


def op9(spark, sf_dir: str) -> DataFrame:
    """Per document: words, words scored by a bigram, log score and its mean per word."""
    out = scores(table(spark, sf_dir, "documents"), pool_once=False)
    return out.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
