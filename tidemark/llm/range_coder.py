"""Operator 2: token ids in a context-mixing range-coded file format.

Documents are encoded, closed with an end id and written in ascending doc_id
order. A row of the format is a *segment*: consecutive documents (a long one has
a segment of its own) with their ids cut into blocks of ``BLOCK`` ids. Every
block starts with an empty model and carries the crc32 of its ids, so blocks
decode independently and a damaged one is found.

The model predicts the next id from three orders and mixes them in one
interval of 2^16: order 2 (the id that last followed the two ids before) and
order 1 (the id that last followed the id before) get shares that adapt to how
often they were right; the rest goes to order 0, adaptive frequencies of the
id's high byte, the low byte being uniform. A range coder with a 64-bit
range codes that interval. All blocks of a batch run in lockstep as lanes of numpy arrays: a
step codes one id in each.

Files: Parquet in the shared folder, one row per segment (part, segment start
inside its part, document ids and lengths, block payloads and checksums),
written by a range partitioning on doc_id; ``part_totals`` gives the ids in front
of each part. Reading decodes segments where they lie, checks every block,
and needs no shuffle.

Null and empty texts are the end id alone. Rows that share a doc_id follow each
other, by text. Null doc_ids come first. An empty table gives an empty file
and result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import arrow_map, bucket_count, scratch, slices, table, text_bytes
from .units import SLICE, encoder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END = 2
BLOCK = 1024
SEGMENT = 1 << 17  # ids from which a segment is closed
LANES = 4096  # blocks that are coded together
PART_BYTES = 40 << 20

SLOTS = 1 << 9  # contexts a block remembers, by hash, for each order
TOTAL = 1 << 16
HIGH = 256  # high bytes: ids below 2^16
NONE = 0xFFFF  # no id remembered
REFRESH = 32  # steps between updates of the order-0 frequencies
STRIPE = 64  # lanes whose frequencies are updated together
U = np.uint64
_ONES = U(0x0001000100010001)


def _reached(starts: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Per row of 16 ascending numbers, the place of the last one that is at most
    ``v``. The first one always is. Truth values are bytes, added up in 64 bits."""
    half = (starts <= v[:, None]).view(U)
    return (((half[:, 0] + half[:, 1]) * U(0x0101010101010101)) >> U(56)).astype(np.int64) - 1


class Model:
    """Predictions of ``n`` blocks side by side. Identical in both directions:
    it only looks at ids already coded."""

    def __init__(self, n: int):
        self.n = n
        self.slot = np.arange(n) * SLOTS
        self.row = (np.arange(n) % STRIPE * HIGH).astype(np.int32)
        self.line = np.arange(n) * (HIGH // 16 + 1)
        self.cell = self.line * 16
        self.seen2 = np.full(n * SLOTS, NONE, np.uint16)
        self.seen1 = np.full(n * SLOTS, NONE, np.uint16)
        self.right2 = np.full(n, 1 << 12, np.int32)  # chance of being right, of 2^16
        self.right1 = np.full(n, 1 << 12, np.int32)
        self.prev = np.zeros(n, np.int32)
        self.prev2 = np.zeros(n, np.int32)
        self.count = np.ones((n, HIGH), np.uint16)  # 1 + 32 x the high byte's ids
        self.late = np.zeros((REFRESH, n), np.uint16)  # high bytes not counted yet, in rows of a stripe
        self.cum = np.zeros(n * (HIGH + 16), np.uint16)
        self.lines = self.cum.reshape(-1, 16)
        self.firsts = np.zeros((16, n), np.uint16)
        self.step = 0
        self.refresh()

    def refresh(self):
        """Order 0: each high byte has 1 + 32 x its count, scaled to a sum of TOTAL
        (at most 256 + 32 x BLOCK before, so each keeps a part). The last sum, TOTAL,
        is 0 in 16 bits, and the differences are right. Lanes are taken in stripes
        that fit the cache."""
        cum = self.cum.reshape(self.n, HIGH + 16)
        part = np.empty((STRIPE, HIGH), np.uint32)
        for i in range(0, self.n, STRIPE):
            count = self.count[i:i + STRIPE]
            if self.step:
                new = np.bincount(self.late[:, i:i + STRIPE].ravel(), minlength=count.size).astype(np.uint16)
                new <<= 5
                count += new.reshape(count.shape)
            four = count.view(U) * _ONES  # sums inside four counts, of 16 bits each
            whole = four >> U(48)
            four += (np.cumsum(whole, axis=1) - whole) * _ONES
            p = part[:len(count)]
            p[:] = four.view(np.uint16)
            p <<= 16
            p //= np.uint32(HIGH + 32 * self.step)
            cum[i:i + STRIPE, 1:HIGH + 1] = p
        self.firsts[:] = cum[:, :HIGH:16].T

    def high_byte(self, v):
        """The last high byte that starts at or below ``v``: its line of 16, and its place there."""
        line = np.add.reduce((self.firsts <= v).view(np.uint8), axis=0, dtype=np.uint8) - np.int64(1)
        return (line << 4) + _reached(self.lines.take(self.line + line, axis=0), v)

    def predict(self):
        """Per lane: the ids of order 2 and 1 (or ``NONE``) and their shares of TOTAL."""
        one = self.prev * 40503
        self.at2 = self.slot + (((one + self.prev2 * 30011) >> 3) & (SLOTS - 1))
        self.at1 = self.slot + ((one >> 3) & (SLOTS - 1))
        p2, p1 = self.seen2.take(self.at2), self.seen1.take(self.at1)
        self.had2 = p2 != NONE
        self.had1 = (p1 != NONE) & (p1 != p2)
        m2 = self.right2 * self.had2
        m1 = ((((TOTAL - m2) >> 4) * (self.right1 >> 4)) >> 8) * self.had1
        return p2, p1, m2, m1

    def update(self, ids, hit2, hit1):
        """Learn the coded ids; ``hit``: which order was right."""
        self.right2 += (((hit2 * np.int32(61936) + np.int32(64)) - self.right2) >> 4) * self.had2
        self.right1 += (((hit1 * np.int32(61936) + np.int32(64)) - self.right1) >> 4) * (self.had1 & ~hit2)
        self.seen2[self.at2] = ids
        self.seen1[self.at1] = ids
        self.late[self.step % REFRESH] = self.row + (ids >> 8)
        self.prev2, self.prev = self.prev, ids
        self.step += 1
        if self.step % REFRESH == 0:
            self.refresh()


def _turned(a: np.ndarray) -> np.ndarray:
    """The transpose, written in stripes that fit the cache."""
    out = np.empty(a.shape[::-1], a.dtype)
    for i in range(0, len(a), 64):
        out[:, i:i + 64] = a[i:i + 64].T
    return out


_SMALL = U(1 << 32)
_START = (1 << 64) - 1
_32 = U(32)


def _carry(digits: np.ndarray, at: np.ndarray) -> None:
    """Add one to the number in front of each place of ``at``."""
    while len(at):
        at = at - 1
        digits[at] += np.uint32(1)  # no place comes twice
        at = at[digits[at] == 0]


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """The payload of every block. Shorter blocks are padded with id 0, which
    the reader cuts off again.

    A lane whose range falls under 2^32 moves 32 bits out (that is enough: a
    step divides the range by 2^32 at most). A carry is added to the digits
    moved out before."""
    n, length = len(blocks), max(map(len, blocks))
    given = np.zeros((n, length), np.int32)
    for row, b in zip(given, blocks, strict=True):
        row[:len(b)] = b
    ids = _turned(given)
    model = Model(n)
    low, rng = np.zeros(n, U), np.full(n, _START, U)
    room = length + 3  # a digit a step and the last two, behind one that takes no carry
    digits = np.zeros(n * room, np.uint32)
    at = np.arange(n) * room + 1
    begin = at.copy()
    plain = np.zeros((length, n), bool)  # coded by order 0

    for t in range(length):
        x = ids[t]
        p2, p1, m2, m1 = model.predict()
        hit2 = (x == p2) & model.had2
        hit1 = (x == p1) & model.had1
        hit = hit2 | hit1
        m12 = m2 + m1
        cell = model.cell + (x >> 8)
        cum = model.cum.take(cell)
        cell += 1
        free = (TOTAL - m12).view(np.uint32)
        width = (model.cum.take(cell) - cum) * free
        start = (m12.view(np.uint32) << 16) + free * cum
        to = np.flatnonzero(hit)
        second, m = hit2[to], m2[to]
        width[to] = np.where(second, m, m1[to]) << 16
        start[to] = (m * ~second) << 16
        r = rng >> _32
        rng = r * width
        r *= start
        new = low + r
        _carry(digits, at[new < low])
        low = new
        small = np.flatnonzero(rng < _SMALL)
        to, out = at[small], new[small]
        digits[to] = out >> _32
        at[small] = to + 1
        low[small] = out << _32
        rng[small] <<= _32
        plain[t] = ~hit
        model.update(x, hit2, hit1)
    for _ in range(2):
        digits[at] = low >> _32
        at += 1
        low = low << _32
    sizes, digits = np.array([len(b) for b in blocks]), digits.astype("<u4", copy=False)
    p = (_turned(plain) & (np.arange(length) < sizes[:, None]))[:, ::-1]
    x, last = given.astype(np.uint8)[:, ::-1][p].tobytes(), np.cumsum(p.sum(1))
    return [digits[i:j].tobytes() + x[k:l] for i, j, k, l in zip(begin, at, [0, *last[:-1]], last, strict=True)]


def decode_blocks(payloads: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The ids of every block."""
    n, length = len(payloads), max(lengths)
    size = np.array([len(p) for p in payloads])
    width = min(int(size.max()) // 4, length + 2) + 1
    digits = np.zeros((n, width), np.uint32)
    for i, p in enumerate(payloads):  # the bytes behind the digits are read by padded blocks only
        d = np.frombuffer(p, "<u4", min(len(p) // 4, width))
        digits[i, :len(d)] = d
    digits = digits.ravel()
    lows = np.frombuffer(b"".join(payloads), np.uint8)
    tail = np.cumsum(size) - 1  # of each block, the low byte that comes next
    model = Model(n)
    at = np.arange(n) * width
    x = np.zeros(n, U)
    for _ in range(2):
        x = (x << _32) | digits.take(at)
        at += 1
    rng = np.full(n, _START, U)
    ids = np.zeros((length, n), np.int32)

    for t in range(length):
        p2, p1, m2, m1 = model.predict()
        m12 = m2 + m1
        free = TOTAL - m12
        r = rng >> _32
        v = np.minimum(x // r, U(_SMALL - U(1))).astype(np.int64)
        part = v >> 16
        hit2 = part < m2
        hit = part < m12
        hit1 = hit & ~hit2
        rest = ~hit
        v = np.minimum((v - (m12.astype(np.int64) << 16)) / free, TOTAL - 1).astype(np.uint16)
        high = model.high_byte(v)
        cell = model.cell + high
        cum = model.cum.take(cell)
        cell += 1
        free = free.view(np.uint32)
        width = (model.cum.take(cell) - cum) * free
        start = (m12.view(np.uint32) << 16) + free * cum
        to = np.flatnonzero(hit)
        second, m = hit2[to], m2[to]
        width[to] = np.where(second, m, m1[to]) << 16
        start[to] = (m * ~second) << 16
        x -= r * start
        rng = r * width
        small = np.flatnonzero(rng < _SMALL)
        to = at[small]
        x[small] = (x[small] << _32) | digits.take(to, mode="clip")
        at[small] = to + 1
        rng[small] <<= _32
        got = ids[t]
        got[:] = (high << 8) | lows.take(tail, mode="clip")
        np.copyto(got, p1, where=hit1)
        np.copyto(got, p2, where=hit2)
        tail -= rest
        model.update(got, hit2, hit1)
    return [x[:k] for x, k in zip(_turned(ids), lengths, strict=True)]


SEGMENT_SQL = ("part int, start long, doc_ids array<long>, lengths array<long>, payloads array<binary>, "
               "sizes array<int>, checksums array<long>")
SEGMENTS = pa.schema([("part", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                      ("lengths", pa.list_(pa.int64())), ("payloads", pa.list_(pa.binary())),
                      ("sizes", pa.list_(pa.int32())), ("checksums", pa.list_(pa.int64()))])


def _segments(rows: list[tuple[list, list, bytes, int]], part: int) -> pa.RecordBatch:
    """Code the blocks of several segments in lockstep."""
    cut = [[np.frombuffer(raw, "<u4", min(BLOCK, len(raw) // 4 - i), 4 * i) for i in range(0, len(raw) // 4, BLOCK)]
           for _, _, raw, _ in rows]
    flat = [b for c in cut for b in c]
    done = [p for i in range(0, len(flat), LANES) for p in encode_blocks(flat[i:i + LANES])]
    out, k = [], 0
    for (docs, lengths, _, start), c in zip(rows, cut, strict=True):
        out.append({"part": part, "start": start, "doc_ids": docs, "lengths": lengths, "payloads": done[k:k + len(c)],
                    "sizes": [len(b) for b in c], "checksums": [zlib.crc32(b.tobytes()) for b in c]})
        k += len(c)
    return pa.RecordBatch.from_pylist(out, SEGMENTS)


def _together(batches):
    """(doc_ids, texts) of many rows: about the bytes that the encoder takes at a time."""
    docs, texts, size = [], [], 0
    for b in slices(batches, 1000):
        docs += b.column("doc_id").to_pylist()
        texts += b.column("text").to_pylist()
        size += b.column("text").nbytes
        if size >= SLICE:
            yield docs, texts
            docs, texts, size = [], [], 0
    if docs:
        yield docs, texts


def write(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end: int = END) -> None:
    """Write the ids of all documents to the folder ``path``."""
    parts = bucket_count(text_bytes(docs), PART_BYTES, 1)
    close = np.array([end], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext
        part, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        start, rows, held = 0, [], 0
        ids, lengths, raw, size = [], [], [], 0

        for docs, texts in _together(batches):
            for doc, x in zip(docs, enc.encode_all(texts), strict=True):
                x += close
                ids.append(doc)
                lengths.append(len(x) // 4)
                raw.append(x)
                size += len(x) // 4
                if size >= SEGMENT:
                    rows.append((ids, lengths, b"".join(raw), start))
                    start, held = start + size, held + size
                    ids, lengths, raw, size = [], [], [], 0
                    if held >= LANES * BLOCK:
                        yield _segments(rows, part)
                        rows, held = [], 0
        if ids:
            rows.append((ids, lengths, b"".join(raw), start))
        if rows:
            yield _segments(rows, part)

    order = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text"))
    arrow_map(order, run, SEGMENT_SQL).write.parquet(path)


def part_totals(files: DataFrame) -> list[tuple[int, int]]:
    """(part, ids in front of it): one number per part of PART_BYTES of text."""
    ends = files.groupBy("part").agg(F.max(F.col("start") + F.aggregate(
        "lengths", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n")).orderBy("part").collect()
    out, before = [], 0
    for r in ends:
        out.append((r["part"], before))
        before += r["n"]
    return out


def read(spark, path: str, ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids, if asked for) from the files."""
    files = spark.read.schema(SEGMENT_SQL).parquet(path)
    before = spark.createDataFrame(part_totals(files), "part int, before long")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids

    def run(batches):
        for b in batches:
            rows = b.to_pylist()
            lo = 0
            while lo < len(rows):
                hi, n = lo, 0
                while hi < len(rows) and (n == 0 or n + len(rows[hi]["sizes"]) <= LANES):
                    n += len(rows[hi]["sizes"])
                    hi += 1
                yield _documents(rows[lo:hi], ids)
                lo = hi

    rows = files.join(F.broadcast(before), "part").withColumn("start", F.col("start") + F.col("before")).drop("before", "part")
    return arrow_map(rows, run, schema)


def _documents(rows: list[dict], with_ids: bool) -> pa.RecordBatch:
    payloads = [p for r in rows for p in r["payloads"]]
    sizes = [s for r in rows for s in r["sizes"]]
    sums = [c for r in rows for c in r["checksums"]]
    got = []
    for i in range(0, len(payloads), LANES):
        got += decode_blocks(payloads[i:i + LANES], sizes[i:i + LANES])
    got = [g.astype("<u4").tobytes() for g in got]
    for g, c in zip(got, sums, strict=True):
        if zlib.crc32(g) != c:
            raise ValueError("a block of token ids does not match its checksum")
    out = {c: [] for c in ("doc_id", "start", "n_tokens", "ids_crc32", "ids")}
    k = 0
    for r in rows:
        raw = b"".join(got[k:k + len(r["sizes"])])
        k += len(r["sizes"])
        at = 0
        for doc, n in zip(r["doc_ids"], r["lengths"], strict=True):
            part = raw[4 * at:4 * (at + n)]
            out["doc_id"].append(doc)
            out["start"].append(r["start"] + at)
            out["n_tokens"].append(n)
            out["ids_crc32"].append(zlib.crc32(part))
            out["ids"].append(part)
            at += n
    if not with_ids:
        del out["ids"]
    kinds = {"ids": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()], list(out))


def op2(spark, sf_dir: str) -> DataFrame:
    path = scratch(spark, "llm_token_ids")
    write(table(spark, sf_dir, "documents"), path)
    return read(spark, path)
