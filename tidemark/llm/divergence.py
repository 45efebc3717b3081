"""Operator 12: how the sources of a language differ in their terms.

1. Collapse: equal texts of a lang become one, with the number of documents each
   source has of it. Only the first copy of a text in a task's stretch of rows
   travels; the others are rows of (lang, digest, source, count).
2. Tokenize once: the task that gets a text counts its terms and adds them, weighted
   by those numbers, to (lang, term, source) -> occurrences and documents. Tasks
   hold ``HELD`` such sums and pass them on.
3. Sums by (lang, term, source), then terms in at least ``MIN_DOCS`` documents of the
   lang stay.
4. Sparse pairs: where at most one of two sources has a term, only its number of
   occurrences matters, so a table (source, occurrences) -> number of terms
   stands for all such terms. Terms that both have are evaluated one by one, in
   batches of terms whose pairs are added up before they leave the task.

Arithmetic is exact: shares are whole billionths plus one, found by long division, so
no product passes 64 bits. A share is 1 + floor(10^9 * (count + 1) / (N + V)).

Nulls of text, lang and source are ''. Empty texts have no terms; their (lang, source)
group still counts as one. A lang without kept terms gives pair values of 0. Repeated
rows are documents of their own. Equal values are ranked by item in byte order. Very
long texts are read whole, in one task's memory. An empty table gives an empty
result. Extra columns are ignored. The pair part has a row per ordered pair of
sources of a lang, so it grows with the square of a lang's sources (it is asked for).
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import arrow_map, table, written

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
HELD = 400_000  # sums in a task's memory
DIGESTS = 200_000  # digests a task remembers
CELLS = 1 << 20  # pairs evaluated at once

_TERM = re.compile(rb"[a-z\x80-\xff]+")


def terms(text: str | None) -> list[bytes]:
    """Letters A-Z (as a-z) and characters beyond ASCII in a row."""
    return _TERM.findall(text.encode("utf-8").lower()) if text else []


# --- collapse and count ---------------------------------------------------------

def collapsed(docs: DataFrame) -> DataFrame:
    """(lang, digest, source, n, text): per stretch of rows, the documents each
    source has of a text; the text itself is in one of those rows."""
    plain = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    plain = plain.withColumn("digest", F.md5(F.col("text").cast("binary")))

    def run(batches):
        known: set = set()
        for b in batches:
            if len(known) > DIGESTS:
                known.clear()
            langs, sources, digests = (b.column(c).to_pylist() for c in ("lang", "source", "digest"))
            n = Counter(zip(langs, digests, sources, strict=True))
            at = {}
            for i, k in enumerate(zip(langs, digests, sources, strict=True)):
                at.setdefault(k, i)
            new = []
            for lang, digest, _ in n:
                new.append((lang, digest) not in known)
                known.add((lang, digest))
            rows = b.take(pa.array(list(at.values()), pa.int64()))
            text = pa.compute.if_else(pa.array(new, pa.bool_()), rows.column("text"), None)
            yield pa.RecordBatch.from_arrays([rows.column("lang"), rows.column("digest"), rows.column("source"),
                                              pa.array(list(n.values()), pa.int64()), text],
                                             ["lang", "digest", "source", "n", "text"])

    return arrow_map(plain, run, "lang string, digest string, source string, n long, text string")


def counted(docs: DataFrame) -> DataFrame:
    """(lang, term, source, n, docs), not yet summed over tasks; a null term carries
    a (lang, source) group itself and its number of documents."""
    together = collapsed(docs).repartition("lang", "digest").sortWithinPartitions("lang", "digest")

    def run(batches):
        held: dict = {}  # (lang, source) -> occurrences and documents by term
        groups: Counter = Counter()
        sources: Counter = Counter()
        key, text, size = None, None, 0

        def settle():
            nonlocal size
            if key is None:
                return
            found = terms(text)
            count = Counter(found) if len(sources) > 1 or max(sources.values()) > 1 else None
            distinct = count or set(found)
            for s, n in sources.items():
                of = key[0], s
                groups[of] += n
                cells = held.get(of)
                if cells is None:
                    cells = held[of] = Counter(), Counter()
                occurrences, docs = cells
                size -= len(docs)
                if n == 1:
                    occurrences.update(found)
                    docs.update(iter(distinct))
                else:
                    for t, c in count.items():
                        occurrences[t] += n * c
                        docs[t] += n
                size += len(docs)
                if size > HELD:  # also between the sources of a text that many have
                    yield from out()

        def out():
            nonlocal size
            cells = list(held.values())
            term = pa.array([t for c, _ in cells for t in c], pa.binary()).cast(pa.string())
            n = np.fromiter((v for c, _ in cells for v in c.values()), np.int64, size)
            docs = np.fromiter((d[t] for c, d in cells for t in c), np.int64, size)
            yield rows(held, [len(c) for c, _ in cells], term, n, docs)
            k = len(groups)
            yield rows(groups, [1] * k, pa.nulls(k, pa.string()), np.zeros(k, np.int64), np.fromiter(groups.values(), np.int64, k))
            held.clear()
            groups.clear()
            size = 0

        def rows(of, times, term, n, docs):
            at = pa.array(np.repeat(np.arange(len(of)), times))
            lang, source = (pa.array([x[i] for x in of], pa.string()).take(at) for i in range(2))
            return pa.RecordBatch.from_arrays([lang, term, source, pa.array(n), pa.array(docs)],
                                              ["lang", "term", "source", "n", "docs"])

        for b in batches:
            for lang, digest, source, n, t in zip(*(b.column(c).to_pylist() for c in ("lang", "digest", "source", "n", "text")),
                                                  strict=True):
                if (lang, digest) != key:
                    yield from settle()
                    key, text = (lang, digest), None
                    sources.clear()
                sources[source] += n
                text = text or t
        yield from settle()
        yield from out()

    return arrow_map(together, run, "lang string, term string, source string, n long, docs long")


# --- shares ---------------------------------------------------------------------

def share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 * count / total) for count <= total < 9e15: long division by
    thousands, so nothing passes 64 bits."""
    whole, rest = F.lit(0).cast("long"), count.cast("long")
    for _ in range(3):
        step = rest * 1000
        digit = _div(step, total)
        whole, rest = whole * 1000 + digit, step - digit * total
    return whole + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return _div((p - q) * (p - q), q)


def _shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    whole, rest = np.zeros_like(n), n
    for _ in range(3):
        step = rest * 1000
        whole, rest = whole * 1000 + step // total, step % total
    return whole + 1


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


# --- pairs ----------------------------------------------------------------------

def _cells(term: np.ndarray, source: np.ndarray, p: np.ndarray, p0: np.ndarray, n_sources: int,
           cells: int) -> dict[int, int]:
    """pair (a * n_sources + b) -> what terms that both sources have add to the value
    beyond what each of them adds alone. Rows are sorted by term."""
    starts = np.flatnonzero(np.diff(term, prepend=-1))
    sizes = np.diff(np.append(starts, len(term)))
    total: dict[int, int] = {}

    def add(code, value):
        at, inverse = np.unique(code, return_inverse=True)
        sums = np.zeros(len(at), np.int64)
        np.add.at(sums, inverse, value)
        for c, v in zip(at.tolist(), sums.tolist(), strict=True):
            total[c] = total.get(c, 0) + v

    def pairs(a, b):  # index arrays of rows that share a term
        a, b = a.reshape(-1), b.reshape(-1)
        keep = a != b
        a, b = a[keep], b[keep]
        add(source[a] * n_sources + source[b],
            _gap(p[a], p[b]) - _gap(p[a], p0[b]) - _gap(p0[a], p[b]) + _gap(p0[a], p0[b]))

    for k in np.unique(sizes[sizes > 1]).tolist():
        first = starts[sizes == k]
        step = max(1, cells // (k * k))
        if k * k <= cells:
            for i in range(0, len(first), step):
                rows = first[i:i + step, None] + np.arange(k)
                pairs(np.repeat(rows, k, axis=1), np.tile(rows, (1, k)))
        else:  # a term of very many sources: some rows of it against all
            for f in first.tolist():
                rows = np.arange(f, f + k)
                for i in range(0, k, max(1, cells // k)):
                    some = rows[i:i + max(1, cells // k)]
                    pairs(np.repeat(some, k), np.tile(rows, len(some)))
    return total


def met(rows: DataFrame) -> DataFrame:
    """(lang, source, item, value) from terms that both sources have; ``rows``
    are (lang, term, source, p, p0)."""
    together = rows.repartition("lang", "term").sortWithinPartitions("lang", "term")

    def flush(parts):
        t = pa.concat_tables([pa.Table.from_batches([x]) for x in parts]).combine_chunks()
        lang, word, name = (t.column(c).combine_chunks().dictionary_encode() for c in ("lang", "term", "source"))
        names = name.dictionary.to_pylist()
        code = lang.indices.to_numpy().astype(np.int64) * max(len(word.dictionary), 1) + word.indices.to_numpy()
        change = np.cumsum(np.diff(code, prepend=code[0]) != 0)
        # a source of two langs is two sources
        source = lang.indices.to_numpy().astype(np.int64) * len(names) + name.indices.to_numpy()
        own, source = np.unique(source, return_inverse=True)
        got = _cells(change, source, t.column("p").to_numpy(), t.column("p0").to_numpy(), len(own), CELLS)
        langs = lang.dictionary.to_pylist()
        a = [own[c // len(own)] for c in got]
        b = [own[c % len(own)] for c in got]
        return pa.RecordBatch.from_arrays(
            [pa.array([langs[x // len(names)] for x in a], pa.string()), pa.array([names[x % len(names)] for x in a], pa.string()),
             pa.array([names[x % len(names)] for x in b], pa.string()), pa.array(list(got.values()), pa.int64())],
            ["lang", "source", "item", "value"])

    def run(batches):
        parts, n = [], 0
        for b in batches:
            # the last term of a batch may go on in the next one
            while b.num_rows:
                parts.append(b)
                n += b.num_rows
                if n < HELD:
                    break
                key = (b.column("lang")[-1], b.column("term")[-1])
                cut = b.num_rows
                while cut and (b.column("lang")[cut - 1], b.column("term")[cut - 1]) == key:
                    cut -= 1
                if cut == 0:  # this batch holds one term: wait for its end
                    break
                parts[-1] = b.slice(0, cut)
                yield flush(parts)
                parts, n, b = [], 0, b.slice(cut)
        if parts:
            yield flush(parts)

    return arrow_map(together, run, "lang string, source string, item string, value long")


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: see the contract of the two parts."""
    sums = written(counted(docs).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
                   "divergence_counts")
    of_lang = (sums.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("df"))
               .where(F.col("df") >= MIN_DOCS).drop("df"))
    kept = written(sums.where("term is not null").drop("docs").join(of_lang, ["lang", "term"]), "divergence_kept")
    langs = (kept.dropDuplicates(["lang", "term"]).groupBy("lang")
             .agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total")))
    groups = written(sums.where("term is null").select("lang", "source")
                     .join(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
                     .join(langs, "lang", "left").na.fill(0, ["total", "v", "lang_total"])
                     .withColumn("size", F.col("total") + F.col("v"))
                     .withColumn("p0", F.when(F.col("v") > 0, share(F.lit(1), F.greatest("size", F.lit(1)))).otherwise(1)),
                     "divergence_groups")
    shared = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n") + 1, F.col("size")))

    # terms: what a source has more of than its lang
    q = share(F.col("lang_n") + 1, F.col("lang_total") + F.col("v"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = (shared.withColumn("q", q).where("p > q")
           .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
           .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP_TERMS))

    # pairs: both absent, one present, both present
    a, b = groups.alias("a"), groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0")).alias("b")
    pairs = a.join(b, "lang").where("source <> item")
    f00 = gap(F.col("p0"), F.col("q0"))
    none = pairs.select("lang", "source", "item", (F.col("v") * f00).alias("value"))
    alone = (shared.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("terms"))
             .select("lang", "source", "p", "p0", "terms"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    one = alone.join(others, "lang").where("source <> item")
    mine = one.select("lang", "source", "item", (F.col("terms") * (gap(F.col("p"), F.col("q0")) - f00)).alias("value"))
    # the same with the roles changed: the source lacks the term, the item has it
    back = gap(F.col("q0"), F.col("p")) - gap(F.col("q0"), F.col("p0"))
    theirs = one.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (F.col("terms") * back).alias("value"))
    both = met(shared.select("lang", "term", "source", "p", "p0"))
    pair = (none.unionByName(mine).unionByName(theirs).unionByName(both)
            .groupBy("lang", "source", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
            .withColumn("rank", F.row_number().over(best)))
    return pair.unionByName(top)


def op12(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))
