"""Operator 10: best-fit packing with certified bin counts.

Documents are encoded, closed with an end id and, if longer than a sequence,
cut into full pieces and a rest. Full pieces are sequences of their own. The
others are dealt to groups of about ``GROUP`` pieces and packed by best-fit
decreasing. Each group computes lower bounds on its bin count from
dual-feasible functions (sums of transformed lengths that no bin can exceed).
A group whose bin count meets its bound is done. The others keep the bins
that are full to ``KEEP_FILL`` and give the pieces of the rest into a pool, which
is dealt to new groups and packed again, until all groups are certified, the
pool is one group, or ``ROUNDS`` are over; the last round's bins all count.

Groups have a bounded number of pieces, so no task depends on the input's size;
only group counts reach the driver.

Null and empty texts are the end id alone (length 1). Ties in length are broken
by doc_id and piece, so a run is repeatable. Repeated rows are separate pieces.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import arrow_groups, arrow_map, table, written
from .units import encoder

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END = 1
SEQUENCE = 4096
GROUP = 20_000
KEEP_FILL = 0.999
ROUNDS = 4


def pieces(docs: DataFrame, path: str = TOKENIZER, length: int = SEQUENCE, end: int = END, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and the ids themselves, as
    little-endian 32-bit integers, if asked for)."""
    schema = (f"doc_id {dict(docs.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long"
              + ", ids binary" * ids)
    close = np.array([end], "<u4").tobytes()

    def run(batches):
        enc = encoder(path)
        for b in batches:
            row, no, start, size, crc, raw = [], [], [], [], [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                x = enc.encode(t) + close
                for p, at in enumerate(range(0, len(x), 4 * length)):
                    part = x[at:at + 4 * length]
                    row.append(i)
                    no.append(p)
                    start.append(at // 4)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if ids:
                        raw.append(part)
            cols = [b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(no, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if ids:
                cols.append(pa.array(raw, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    return arrow_map(docs.select("doc_id", "text"), run, schema)


def lower_bound(sizes: np.ndarray, room: int) -> int:
    """Least number of bins by dual-feasible functions: the plain sum, the
    step functions x -> (a small item counts nothing, a large one a whole bin)
    for every threshold, and rounding down to multiples 1/k."""
    if not len(sizes):
        return 0
    best = -(-int(sizes.sum()) // room)
    s = np.sort(sizes)
    total = np.concatenate(([0], np.cumsum(s)))
    for eps in np.unique(s[s <= room // 2]):
        # items over room - eps fill a bin alone, items under eps count nothing
        big = len(s) - np.searchsorted(s, room - eps, "right")
        mid = int(total[len(s) - big] - total[np.searchsorted(s, eps, "left")])
        best = max(best, int(big) + -(-mid // room))
    for k in range(1, 33):
        scaled = s * (k + 1)
        whole = scaled % room == 0
        value = np.where(whole, s * k, (scaled // room) * room)
        best = max(best, -(-int(value.sum()) // (k * room)))
    return best


def best_fit(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing of ``sizes`` (already in packing order): bin and
    offset of each, and the number of bins. A bit per amount of free space
    finds the fullest bin with enough room."""
    by_free: list[list[int]] = [[] for _ in range(room + 1)]
    mask, bins = 0, 0
    at, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for i, n in enumerate(sizes.tolist()):
        fits = mask >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                mask ^= 1 << free
        else:
            b, free, bins = bins, room, bins + 1
        at[i], offset[i] = b, room - free
        free -= n
        if not by_free[free]:
            mask |= 1 << free
        by_free[free].append(b)
    return at, offset, bins


def _pack_group(room: int, last: bool, base: int):
    def run(t: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]
        t = t.sort_by(order)
        sizes = t.column("length").to_numpy()
        at, offset, bins = best_fit(sizes, room)
        done = last or bins == lower_bound(sizes, room)
        keep = np.ones(len(sizes), bool) if done else np.bincount(at, weights=sizes)[at] >= KEEP_FILL * room
        seq = base + (t.column("grp")[0].as_py() << 24) + at
        return t.append_column("sequence_id", pa.array(np.where(keep, seq, -1))) \
            .append_column("offset", pa.array(np.where(keep, offset, -1)))
    return run


def packed(parts: DataFrame, room: int = SEQUENCE) -> DataFrame:
    """``parts`` (doc_id, piece, length, ids_crc32, ...) with sequence_id and offset."""
    cols = parts.columns
    whole = parts.where(F.col("length") >= room)
    out = [whole.withColumn("sequence_id", -1 - F.monotonically_increasing_id())
           .withColumn("offset", F.lit(0).cast("long"))]
    pool = parts.where(F.col("length") < room)
    types = dict(parts.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in cols) + ", grp long, sequence_id long, offset long"
    for turn in range(ROUNDS):
        n = pool.count()
        if not n:
            break
        groups = -(-n // GROUP)
        last = turn == ROUNDS - 1 or groups == 1
        dealt = pool.withColumn("grp", F.pmod(
            F.xxhash64(F.lit(turn), "doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))
        # base: the turn; grp and bin take 38 and 24 bits
        got = written(arrow_groups(dealt, ["grp"], _pack_group(room, last, (turn + 1) << 59), schema), "packed")
        out.append(got.where("sequence_id >= 0").drop("grp"))
        pool = got.where("sequence_id < 0").select(*cols)
    result = out[0]
    for o in out[1:]:
        result = result.unionByName(o)
    return result


def op10(spark, sf_dir: str) -> DataFrame:
    parts = written(pieces(table(spark, sf_dir, "documents")), "pieces")
    return packed(parts).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
