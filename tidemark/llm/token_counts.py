"""Operator 6: token counts without ids, through distinct pre-tokens.

1. Every batch sends its distinct units (pre-tokens with their blank, see
   ``units``) with their frequency; an aggregate makes the vocabulary.
2. Pieces are counted once per distinct unit.
3. Per-document unit frequencies are joined with the counts and summed. The
   ``HEAD`` most frequent units (a fixed number, 12 bytes each: 96 MB at most) are broadcast and
   joined map-side; the rest of a document's units leave the task as
   (text, unit, frequency) rows and meet the vocabulary in a shuffle join,
   summed per text.

No ids are kept. A worker makes Python objects of ``SLICE`` rows at a time and holds
at most ``GATHER`` units and those of one document, so its memory depends neither on
the input nor on the rows of an Arrow batch.

Null and empty texts have 0 bytes and 0 tokens. Repeated rows each keep their
row. Special strings inside texts count as the library counts them. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .native import text_key
from .store import arrow_map, slices, table, written
from .units import encoder, units

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 1024
HEAD = 8_000_000
#: units a task gathers before it sends them on
GATHER = 200_000
#: rows, and units to count, that are Python objects at a time
SLICE, UNITS = 500, 10_000
_TAIL = 1 << 40


def _split(enc, text: str | None) -> tuple[list[str], list[str]]:
    """(bare units, units behind a blank) of a text."""
    if not text:
        return [], []
    bare, spaced = [], []
    for s in enc.segments(text):
        a, b = ([s], []) if s in enc.specials else units(s)
        bare += a
        spaced += b
    return bare, spaced


def vocabulary(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """unit, n (occurrences in all texts), n_tokens."""
    def gather(batches):
        enc, bare, spaced = encoder(path), Counter(), Counter()

        def out():
            names = [*bare, *(" " + u for u in spaced)]
            n = [*bare.values(), *spaced.values()]
            bare.clear()
            spaced.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(n, pa.int64())], ["unit", "n"])

        for b in slices(batches, SLICE):
            for t in b.column("text").to_pylist():
                x, y = _split(enc, t)
                bare.update(x)
                spaced.update(y)
                if len(bare) + len(spaced) > GATHER:
                    yield out()
        yield out()

    def count(batches):
        enc = encoder(path)
        for b in slices(batches, UNITS):
            yield pa.RecordBatch.from_arrays(
                [b.column("unit"), b.column("n"), pa.array(enc.counts(b.column("unit").to_pylist()), pa.int32())],
                ["unit", "n", "n_tokens"])

    found = arrow_map(docs.select("text"), gather, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))
    return arrow_map(found, count, "unit string, n long, n_tokens int")


def _head(vocab: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes (sorted) and token counts of the most frequent units, at most
    HEAD of them, and the frequency from which a unit belongs to them."""
    steps = (vocab.groupBy(F.floor(F.log2("n")).cast("int").alias("log")).agg(F.count("*").alias("units"))
             .orderBy(F.desc("log")).collect())  # one row per power of two
    total, least = 0, 1 << 62
    for r in steps:
        total += r["units"]
        if total > HEAD:
            break
        least = 1 << r["log"]

    def hashed(batches):
        for b in batches:
            h = np.fromiter((xxhash.xxh3_64_intdigest(u) for u in b.column("unit").to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), b.column("n_tokens")], ["h", "n_tokens"])

    got = arrow_map(vocab.where(F.col("n") >= least).select("unit", "n_tokens"), hashed, "h long, n_tokens int").toArrow()
    h = got.column("h").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], got.column("n_tokens").to_numpy()[order].astype(np.int32), least


def counted(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row."""
    vocab = written(vocabulary(docs, path), "vocabulary")
    hashes, counts, least = _head(vocab)
    head = docs.sparkSession.sparkContext.broadcast((hashes, counts))
    schema = (f"doc_id {dict(docs.dtypes)['doc_id']}, text_id string, n_bytes long, known long, "
              "rest array<struct<unit:string,n:long>>")
    rest_type = pa.list_(pa.struct([("unit", pa.string()), ("n", pa.int64())]))

    def join(batches):
        enc = encoder(path)
        h, n = head.value

        class Counts(dict):
            """unit -> tokens from the broadcast head; _TAIL if it is not there."""

            def __init__(self, before):
                super().__init__()
                self.before = before

            def __missing__(self, unit):
                x = np.uint64(xxhash.xxh3_64_intdigest(self.before + unit))
                i = int(np.searchsorted(h, x))
                v = self[unit] = int(n[i]) if i < len(h) and h[i] == x else _TAIL
                return v

        bare, spaced = Counts(""), Counts(" ")
        for b in slices(batches, SLICE):
            known, rest, size = [], [], []
            for t in b.column("text").to_pylist():
                if len(bare) + len(spaced) > GATHER:
                    bare.clear()
                    spaced.clear()
                x, y = _split(enc, t)
                total = sum(map(bare.__getitem__, x)) + sum(map(spaced.__getitem__, y))
                far = Counter()
                if total >= _TAIL:
                    far.update(u for u in x if bare[u] >= _TAIL)
                    far.update(" " + u for u in y if spaced[u] >= _TAIL)
                    total -= _TAIL * sum(far.values())
                known.append(total)
                rest.append([{"unit": u, "n": c} for u, c in far.items()])
                size.append(len(t.encode("utf-8")) if t else 0)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_id"), pa.array(size, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(rest, rest_type)], ["doc_id", "text_id", "n_bytes", "known", "rest"])

    rows = written(arrow_map(docs.select("doc_id", "text", text_key(F.col("text")).alias("text_id")), join, schema), "unit_sums")
    far = (rows.where(F.size("rest") > 0).groupBy("text_id").agg(F.first("rest").alias("rest"))
           .select("text_id", F.explode("rest").alias("r")).select("text_id", "r.unit", F.col("r.n").alias("times")))
    far = (far.join(vocab.where(F.col("n") < least).select("unit", "n_tokens"), "unit")
           .groupBy("text_id").agg(F.sum(F.col("times") * F.col("n_tokens")).alias("more")))
    return (rows.join(far, "text_id", "left")
            .select("doc_id", "n_bytes", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_tokens")))


def op6(spark, sf_dir: str) -> DataFrame:
    out = counted(table(spark, sf_dir, "documents"))
    return out.withColumn("over_limit", F.col("n_tokens") > LIMIT)
