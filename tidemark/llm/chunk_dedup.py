"""Operator 5: substring deduplication by content-defined chunks.

A gear hash rolls over the UTF-8 bytes; a chunk ends behind any character whose
hash is the largest of the ``MIN_CHUNK`` bytes before and behind it (chunks of
``MIN_CHUNK`` to ``MAX_CHUNK`` bytes; a longer stretch without such a place ends at
its largest hash), so borders follow the content alone, with or without blanks,
and an insertion moves only the chunks it touches.
Chunks meet by digest (64 bits and length, in hash buckets). The first
occurrence of a chunk, by (doc_id, start), stays; later ones are copies. Copies
that follow each other in both documents are a seed. A seed grows byte by byte,
as far as its document and the earlier one agree; grown seeds of ``MIN_SPAN`` bytes
or more are spans (so shared phrases stay), and spans that touch are one.

Within an Arrow batch all occurrences but the first go straight to the result,
so a chunk that a third of all documents hold costs its bucket one
entry per batch. Entries travel packed, one row per batch and bucket; the number
of buckets follows the data. To grow, seeds meet the two texts in two joins and
take ``PAD`` bytes at either side along; those that agree that far go again.

Null and empty texts have no chunks. Equal documents: all but the first are
copies as a whole. Rows that share a doc_id are told apart by their text; equal
rows are one. Null doc_ids come first in order. An empty table gives an
empty result. Extra columns are ignored by ``spans`` and kept by ``remove``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .native import text_key
from .store import arrow_groups, arrow_map, bucket_count, table, text_bytes, written
from .text import U, mix

MIN_CHUNK = 16
MAX_CHUNK = 256
MIN_SPAN = 128
PAD = 128  # bytes by which a seed may grow in the first round
BYTES_PER_BUCKET = 48 << 20
#: the gear table: 256 pseudo-random words
GEAR = (mix(np.arange(1, 257, dtype=U)) >> U(32)).astype(np.uint32)


def gear_hash(b: np.ndarray) -> np.ndarray:
    """Rolling hash behind each byte over the last 16 bytes:
    h[i] = sum of GEAR[b[i-j]] << j, by doubling."""
    h = GEAR[b]
    for step in (1, 2, 4, 8):
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    return h


def chunk_ends(raw: bytes) -> list[int]:
    """Ends of the chunks of a text's bytes (the last is the length)."""
    n = len(raw)
    if not n:
        return []
    b = np.frombuffer(raw, np.uint8)
    h = gear_hash(b)
    h[:-1][(b[1:] & 0xC0) == 0x80] = 0  # inside a character
    before, behind = np.zeros(n + MIN_CHUNK, np.uint32), np.zeros(n + MIN_CHUNK, np.uint32)
    before[MIN_CHUNK:], behind[:n] = h, h
    for w in (before, behind):  # the largest of MIN_CHUNK hashes, by doubling
        step = 1
        while step < MIN_CHUNK:
            k = min(step, MIN_CHUNK - step)
            w[:-k] = np.maximum(w[:-k], w[k:])
            step += k
    ends, last = [], 0
    for e in (np.flatnonzero((h > before[:n]) & (h >= behind[1:n + 1])) + 1).tolist():
        while e - last > MAX_CHUNK:  # a long stretch without a border
            last = _strongest(h, last)
            ends.append(last)
        if e - last >= MIN_CHUNK:
            ends.append(e)
            last = e
    while n - last > MAX_CHUNK:
        last = _strongest(h, last)
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def _strongest(h: np.ndarray, last: int) -> int:
    """The end with the largest hash (the latest of equal ones) that a chunk
    from ``last`` may have."""
    w = h[last + MIN_CHUNK - 1:last + MAX_CHUNK]
    return last + MAX_CHUNK - int(w[::-1].argmax())


KIND = pa.schema([("bucket", pa.int64()), ("digests", pa.binary()), ("starts", pa.binary()), ("lengths", pa.binary()),
                  ("docs", pa.binary()), ("texts", pa.binary()), ("counts", pa.binary()),
                  ("doc_id", pa.int64()), ("text_id", pa.string()), ("copies", pa.binary())])
KIND_SQL = ("bucket long, digests binary, starts binary, lengths binary, docs binary, texts binary, counts binary, "
            "doc_id long, text_id string, copies binary")
#: a copied chunk: start and length in its document, and a place that holds it earlier
COPY = np.dtype([("start", "<i8"), ("length", "<i8"), ("first", "<i8"), ("lead_text", "S16"), ("lead_start", "<i8")])
COPIES = pa.schema([("doc_id", pa.int64()), ("text_id", pa.string()), ("copies", pa.binary())])
NO_ID = -(1 << 63)  # a null doc_id


def _scan(buckets: int):
    def pack(rows):
        """``rows``: (doc, text digest, digests, starts, lengths) of documents in order of doc."""
        rows.sort(key=lambda r: (r[0], r[1]))
        sizes = np.array([len(r[2]) for r in rows])
        d, s, n = (np.concatenate([r[i] for r in rows]) for i in (2, 3, 4))
        who = np.repeat(np.arange(len(rows)), sizes)
        _, first, back = np.unique(d ^ mix(n.astype(U)), return_index=True, return_inverse=True)
        lead = first[back]
        later = lead != np.arange(len(d))
        ids = np.array([r[0] for r in rows], np.int64)
        names = np.array([r[1] for r in rows], "S16")
        for i in np.unique(who[later]).tolist():
            lo, hi = np.searchsorted(who, [i, i + 1])
            at = lo + np.flatnonzero(later[lo:hi])
            copies = np.empty(len(at), COPY)
            copies["start"], copies["length"], copies["first"] = s[at], n[at], ids[who[lead[at]]]
            copies["lead_text"], copies["lead_start"] = names[who[lead[at]]], s[lead[at]]
            yield {"doc_id": int(ids[i]), "text_id": rows[i][1].hex(), "copies": copies.tobytes()}
        keep = np.flatnonzero(~later)
        d, s, n, who = d[keep], s[keep], n[keep], who[keep]
        bucket = (((d >> U(32)) * U(buckets)) >> U(32)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
        order = np.argsort(bucket, kind="stable")
        d, s, n, who, bucket = d[order], s[order], n[order], who[order], bucket[order]
        cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        for lo, hi in zip(cuts, [*cuts[1:], len(d)], strict=True):
            w = who[lo:hi]
            run = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
            yield {"bucket": int(bucket[lo]), "digests": d[lo:hi].tobytes(),
                   "starts": s[lo:hi].astype(np.uint32).tobytes(), "lengths": n[lo:hi].astype(np.uint16).tobytes(),
                   "docs": ids[w[run]].tobytes(), "texts": b"".join(rows[i][1] for i in w[run].tolist()),
                   "counts": np.diff(np.append(run, hi - lo)).astype(np.uint32).tobytes()}

    def run(batches):
        rows, seen, held = [], set(), 0
        for b in batches:
            for doc, t, tid in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "text_id")), strict=True):
                if not t or (doc, tid) in seen:
                    continue
                seen.add((doc, tid))
                raw = t.encode("utf-8")
                ends = chunk_ends(raw)
                starts = [0, *ends[:-1]]
                d = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:e]) for a, e in zip(starts, ends, strict=True)), U, len(ends))
                s = np.array(starts, np.int64)
                rows.append((NO_ID if doc is None else doc, bytes.fromhex(tid), d, s, np.array(ends, np.int64) - s))
                held += len(ends)
                if held > 1_000_000:
                    yield pa.RecordBatch.from_pylist(list(pack(rows)), KIND)
                    rows, seen, held = [], set(), 0
        if rows:
            yield pa.RecordBatch.from_pylist(list(pack(rows)), KIND)

    return run


def _copies(t: pa.Table) -> pa.Table:
    """Of one bucket: per document the chunks that an earlier one holds."""
    def cat(c, kind):
        return np.frombuffer(b"".join(t.column(c).to_pylist()), kind)

    d, s, n, runs = cat("digests", U), cat("starts", np.uint32), cat("lengths", np.uint16), cat("counts", np.uint32)
    docs, texts = cat("docs", np.int64), cat("texts", "V16")
    row = np.repeat(np.arange(len(docs)), runs)
    key = d ^ mix(n.astype(U))
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.zeros(len(k), bool)
    same[1:] |= k[1:] == k[:-1]
    same[:-1] |= k[1:] == k[:-1]
    at = order[same]
    text_rank = np.unique(texts.view("S16"), return_inverse=True)[1] if len(texts) else np.empty(0, np.int64)
    at = at[np.lexsort((s[at], text_rank[row[at]], docs[row[at]], key[at]))]
    fresh = np.ones(len(at), bool)
    fresh[1:] = key[at][1:] != key[at][:-1]
    lead = at[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]] if len(at) else at
    # the leader and its own entry again (equal rows in several batches) are not copies
    other = ~fresh & ((docs[row[at]] != docs[row[lead]]) | (text_rank[row[at]] != text_rank[row[lead]]) | (s[at] != s[lead]))
    at, lead = at[other], lead[other]
    if not len(at):
        return COPIES.empty_table()
    order = np.lexsort((s[at], text_rank[row[at]], docs[row[at]]))
    at, lead = at[order], lead[order]
    who = docs[row[at]], text_rank[row[at]]
    cut = np.ones(len(at), bool)
    cut[1:] = (who[0][1:] != who[0][:-1]) | (who[1][1:] != who[1][:-1])
    cuts = np.flatnonzero(cut)
    out = {"doc_id": [], "text_id": [], "copies": []}
    for lo, hi in zip(cuts, [*cuts[1:], len(at)], strict=True):
        c = np.empty(hi - lo, COPY)
        c["start"], c["length"], c["first"] = s[at[lo:hi]], n[at[lo:hi]], docs[row[lead[lo:hi]]]
        c["lead_text"], c["lead_start"] = texts.view("S16")[row[lead[lo:hi]]], s[lead[lo:hi]]
        out["doc_id"].append(int(docs[row[at[lo]]]))
        out["text_id"].append(texts[row[at[lo]]].tobytes().hex())
        out["copies"].append(c.tobytes())
    return pa.table(out, schema=COPIES)


SEED = "doc_id long, text_id string, start long, length long, lead_doc long, lead_text string, lead_start long"


def _seeds(t: pa.Table) -> pa.Table:
    """Of one document: copied chunks that follow each other here and in one earlier text."""
    c = np.unique(np.frombuffer(b"".join(t.column("copies").to_pylist()), COPY))
    shift = c["start"] - c["lead_start"]
    c = c[np.lexsort((c["start"], shift, c["lead_text"], c["first"]))]
    shift = c["start"] - c["lead_start"]
    cut = np.ones(len(c), bool)
    cut[1:] = ((c["first"][1:] != c["first"][:-1]) | (c["lead_text"][1:] != c["lead_text"][:-1]) | (shift[1:] != shift[:-1])
               | (c["start"][1:] != (c["start"] + c["length"])[:-1]))
    at = np.flatnonzero(cut)
    n, lead = len(at), c[at]
    return pa.table({"doc_id": pa.array([t.column("doc_id")[0].as_py()] * n, pa.int64()),
                     "text_id": pa.array([t.column("text_id")[0].as_py()] * n, pa.string()),
                     "start": pa.array(lead["start"]), "length": pa.array(np.add.reduceat(c["length"], at)),
                     "lead_doc": pa.array(lead["first"]),
                     "lead_text": pa.array([x.ljust(16, b"\0").hex() for x in lead["lead_text"].tolist()], pa.string()),
                     "lead_start": pa.array(lead["lead_start"])})


def _agree(a: bytes, b: bytes, order: str) -> int:
    """Bytes in which two byte strings of one length agree from the start
    ("little") or from the end ("big")."""
    x = int.from_bytes(a, order) ^ int.from_bytes(b, order)
    return ((x & -x).bit_length() - 1) // 8 if x else len(a)


def _grow(pad: int):
    """Seeds as far as both texts agree, at character borders; ``more`` if
    that is as far as they see."""
    def run(batches):
        for b in batches:
            out = {c: b.column(c).to_pylist() for c in ("start", "length", "lead_start")}
            more = []
            for i, (left, right, lead_left, lead_right) in enumerate(zip(
                    *(b.column(c).to_pylist() for c in ("left", "right", "lead_left", "lead_right")), strict=True)):
                n, m = min(len(left), len(lead_left)), min(len(right), len(lead_right), pad)
                back = _agree(left[len(left) - n:], lead_left[len(lead_left) - n:], "big")
                on = _agree(right[:m], lead_right[:m], "little")
                more.append(back == pad or on == pad)
                while back and left[len(left) - back] & 0xC0 == 0x80:
                    back -= 1
                while on and on < len(right) and right[on] & 0xC0 == 0x80:
                    on -= 1
                out["start"][i] -= back
                out["lead_start"][i] -= back
                out["length"][i] += back + on
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_id"), pa.array(out["start"], pa.int64()), pa.array(out["length"], pa.int64()),
                 b.column("lead_doc"), b.column("lead_text"), pa.array(out["lead_start"], pa.int64()), pa.array(more, pa.bool_())],
                ["doc_id", "text_id", "start", "length", "lead_doc", "lead_text", "lead_start", "more"])
    return run


def _joined(t: pa.Table) -> pa.Table:
    """Of one document: seeds that overlap or touch in the same earlier text at the same distance are one."""
    c = {x: t.column(x).to_numpy() for x in ("start", "length", "lead_doc", "lead_start")}
    name = np.unique(np.array(t.column("lead_text").to_pylist(), "S32"), return_inverse=True)[1]
    shift = c["start"] - c["lead_start"]
    order = np.lexsort((c["start"], shift, name, c["lead_doc"]))
    start, end = c["start"][order], (c["start"] + c["length"])[order]
    key = np.stack((c["lead_doc"], name, shift), 1)[order]
    fresh = np.concatenate(([True], (key[1:] != key[:-1]).any(1)))
    part = np.cumsum(fresh) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + part) - part
    at = np.flatnonzero(fresh | np.concatenate(([True], start[1:] > reach[:-1])))
    out = t.take(pa.array(order[at]))
    size = reach[np.append(at[1:], len(start)) - 1] - start[at]
    return out.set_column(out.column_names.index("length"), "length", pa.array(size, pa.int64()))


def _with_sides(seeds: DataFrame, texts: DataFrame, pad: int, doc: str, text: str, start: str, left: str, right: str) -> DataFrame:
    """``seeds`` with the bytes before and behind them in the text that (doc, text) name."""
    same = (F.col(doc) == F.col("__doc")) & (F.col(text) == F.col("__text"))
    raw, at = F.col("__raw"), F.col(start).cast("int")
    n = F.least(at, F.lit(pad))
    # a byte more behind: where its character begins is seen
    return seeds.join(texts.hint("merge"), same).select(
        *seeds.columns, F.substring(raw, at - n + 1, n).alias(left),
        F.substring(raw, at + F.col("length").cast("int") + 1, F.lit(pad + 1)).alias(right))


def _grown(seeds: DataFrame, texts: DataFrame) -> DataFrame:
    """Seeds as far as their document and the earlier one agree. What still
    grows is joined and sees eight times as far in the next round."""
    done, pad = None, PAD
    seeds = written(seeds, "seeds")
    while True:
        own = _with_sides(seeds, texts, pad, "doc_id", "text_id", "start", "left", "right").distinct()
        both = _with_sides(own, texts, pad, "lead_doc", "lead_text", "lead_start", "lead_left", "lead_right")
        grown = written(arrow_map(both, _grow(pad), SEED + ", more boolean"), "grown")
        here = grown.where("not more").drop("more")
        done = here if done is None else done.unionByName(here)
        seeds = grown.where("more").drop("more")
        if seeds.isEmpty():
            return done
        seeds, pad = written(arrow_groups(seeds, ["doc_id", "text_id"], _joined, SEED), "seeds"), min(8 * pad, 1 << 28)


def _merge(t: pa.Table) -> pa.Table:
    """Of one document: spans that overlap or touch are one."""
    t = t.sort_by([("start", "ascending"), ("length", "descending"), ("lead_doc", "ascending")])
    start, first = t.column("start").to_numpy(), t.column("lead_doc").to_numpy()
    end = np.maximum.accumulate(start + t.column("length").to_numpy())
    at = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
    stop = end[np.append(at[1:], len(start)) - 1]
    n = len(at)
    return pa.table({"doc_id": pa.array([t.column("doc_id")[0].as_py()] * n, pa.int64()),
                     "text_id": pa.array([t.column("text_id")[0].as_py()] * n, pa.string()),
                     "start": pa.array(start[at]), "length": pa.array(stop - start[at]), "first_doc_id": pa.array(first[at])})


def spans(docs: DataFrame, min_span: int = MIN_SPAN) -> DataFrame:
    """Copied spans: doc_id, text_id, start and length in UTF-8 bytes, and a
    document that holds the span's beginning (``min_span`` bytes or more) earlier
    (``first_doc_id``)."""
    buckets = bucket_count(text_bytes(docs), BYTES_PER_BUCKET)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key(F.col("text")).alias("text_id"))
    # a document's batch of copies and the buckets' rows leave the same scan
    scan = written(arrow_map(keyed, _scan(buckets), KIND_SQL), "chunks")
    own = scan.where("bucket is null").select("doc_id", "text_id", "copies")
    met = arrow_groups(scan.where("bucket is not null").drop("doc_id", "text_id", "copies"), ["bucket"], _copies,
                       "doc_id long, text_id string, copies binary")
    seeds = arrow_groups(own.unionByName(met), ["doc_id", "text_id"], _seeds, SEED)
    null = F.lit(NO_ID)
    texts = keyed.where("text <> ''").select(F.coalesce("doc_id", null).alias("__doc"), F.col("text_id").alias("__text"),
                                             F.col("text").cast("binary").alias("__raw"))
    long = _grown(seeds, texts).where(F.col("length") >= min_span).select("doc_id", "text_id", "start", "length", "lead_doc")
    out = arrow_groups(long, ["doc_id", "text_id"], _merge,
                       "doc_id long, text_id string, start long, length long, first_doc_id long")
    return out.withColumn("doc_id", F.nullif("doc_id", null)).withColumn("first_doc_id", F.nullif("first_doc_id", null))


def remove(docs: DataFrame, min_span: int = MIN_SPAN) -> DataFrame:
    """All documents with their columns, copied spans cut out of ``text``.
    A document that is a copy as a whole keeps an empty text."""
    cut = written(spans(docs, min_span), "spans").groupBy(
        F.col("doc_id").alias("__doc"), F.col("text_id").alias("__text")).agg(
        F.sort_array(F.collect_list(F.struct("start", "length"))).alias("__cut"))
    same = docs["doc_id"].eqNullSafe(cut["__doc"]) & (text_key(docs["text"]) == cut["__text"])
    joined = docs.join(cut.hint("merge"), same, "left")
    spans_, raw = cut["__cut"], docs["text"].cast("binary")
    ends = F.transform(spans_, lambda c: c["start"] + c["length"])
    # the kept pieces lie between the end of a span and the start of the next
    pieces = F.transform(
        F.sequence(F.lit(0), F.size(spans_)),
        lambda i: F.substring(
            raw, F.coalesce(F.get(ends, i - 1), F.lit(0)).cast("int") + 1,
            (F.coalesce(F.get(spans_, i)["start"], F.octet_length(docs["text"]).cast("long"))
             - F.coalesce(F.get(ends, i - 1), F.lit(0))).cast("int")))
    kept = F.decode(F.aggregate(pieces, F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b)), "UTF-8")
    text = F.when(spans_.isNull(), docs["text"]).otherwise(kept).alias("text")
    return joined.select(*[text if c == "text" else docs[c] for c in docs.columns])


def op5(spark, sf_dir: str) -> DataFrame:
    return spans(table(spark, sf_dir, "documents")).drop("text_id")
