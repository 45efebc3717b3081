"""Operator 4: n-gram Jaccard join over parity sketches.

Two documents link when 100 * |A & B| >= 75 * |A | B| for their sets of 5-word
shingles. A parity sketch of a set XORs every shingle hash into one of ``k``
words. One shingle that is in A or B only changes one word, so the Hamming
distance of two sketches (words that differ) is at most |A ^ B|, and a link
bounds |A ^ B| by (|A| + |B|) / 7. By the pigeonhole principle at least
``k - (|A| + |B|) / 7`` words agree.

* Size bands: band ``i`` holds set sizes from 0.75^-i up to the next border. A
  link is inside a band or between neighbours, so every set is sketched for
  its own band (role 0) and for the band below (role 1); ``k`` follows the
  band's size.
* Words that no shingle touched are equal for any two texts and carry no
  information, so only the touched words are joined, and a set with ``t``
  touched words must find at least ``t - bound`` of them in other sets. Sets
  that find fewer are dropped before any pair is made. (A set whose count
  is not positive also gets one common key, so it is compared with its like.)
* Sketch words travel packed: one row per Arrow batch and hash bucket, 4 bytes per
  word plus a set id per set. Equal sets are one set (id = digest of the set);
  a set that a batch holds many times is sent once, so a group of copies
  costs a bucket one entry per batch. Buckets follow the data's size.
* A group's pairs are not enumerated. A round verifies every member against one
  pivot of the group (a role-0 member of the smallest component in it, drawn by a
  number that the group's key gives, so that a set, which is in many groups, meets
  many pivots); then components of the links are formed, the pivot leaves the group,
  and the next round only looks at groups that still hold several components. When the
  pairs between components are at most ``PAIRS_PER_MEMBER`` times the members of
  the first round, they are tested all at once. Pairs are tested first by the Hamming distance
  of short bit sketches, which bounds |A ^ B| from below, then exactly. So every pair of sets that
  shares a sketch word is verified, or both are already in one component.
* Verification intersects the exact shingle sets (64-bit hashes), recomputed
  from the texts of the documents involved.

Nulls, empty texts and texts without words have an empty set and are linked
with nothing, not even each other. Texts of fewer than 5 words have one
shingle, the whole sequence. Equal rows are linked (if they have words).
Rows that share a doc_id share its component. Rows whose doc_id is null
can't be named as a component: they get a null component_id. An empty table
gives an empty result. Extra columns are ignored by ``classes`` and kept by
``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from .graph import components
from .native import text_key
from .store import arrow_groups, arrow_map, bucket_count, table, text_bytes, written
from .text import U, mix, shingle_set

BYTES_PER_BUCKET = 10 << 20
#: sketch words a task gathers before it sends them
SEND = 1_500_000
PAIRS_PER_MEMBER = 100
#: 64-bit words of the bit sketch that pairs are tested with before their sets meet
BIT_WORDS = 16
SKETCH = 1  # sketch words per shingle of the band's smallest set
#: at least so many sketch words: small sets get (nearly) a word per shingle
LEAST_WORDS = 64


def band_borders(limit: int = 1 << 40) -> np.ndarray:
    """Sizes at which bands begin: neighbours are at least 4/3 apart, so a link
    (sizes within 3/4) never skips a band."""
    out = [1]
    while out[-1] < limit:
        out.append(-(-out[-1] * 4 // 3))
    return np.array(out, np.int64)


BORDERS = band_borders()


def sketch(s: np.ndarray, band: int, role: int) -> tuple[np.ndarray, int]:
    """(keys, need): the touched sketch words of set ``s`` for ``band``, each
    hashed with band and place, and how many of them any linked set of that
    band shares (at least 1)."""
    n, low, end = len(s), int(BORDERS[band]), int(BORDERS[band + 1])
    k = max(LEAST_WORDS, int(low * SKETCH)) if low > 1 else 1
    place = ((s >> U(32)) * U(k)) >> U(32)
    # s is sorted, so the places come sorted too: XOR each run
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    words = np.bitwise_xor.reduceat(s, first)
    place = place[first]
    if not words.all():
        place, words = place[words != 0], words[words != 0]
    # the largest |A ^ B| of a linked pair that is compared in this band
    partner = end - 1 if role else 4 * n // 3
    need = len(words) - (n + partner) // 7
    keys = mix(words + place * U(0xD6E8FEB86659FD93) + U(band << 40))
    if need <= 0:
        keys, need = np.append(keys, mix(np.array([band], U))), 1
    return keys, need


def set_id(s: np.ndarray) -> int:
    """62-bit digest of a set of shingle hashes; 0 for the empty set."""
    if not len(s):
        return 0
    both = np.array([np.bitwise_xor.reduce(s), np.add.reduce(s), len(s)], U)
    return max(1, xxhash.xxh3_64_intdigest(both.tobytes()) >> 2)


def _pack(keys, owners, needs, buckets: int):
    """One row per bucket from the sets of a batch. An owner is set_id * 2 + role."""
    lens = np.fromiter(map(len, keys), np.int64, len(keys))
    k = np.concatenate(keys)
    who = np.repeat(np.arange(len(keys)), lens)
    bucket = (((k >> U(32)) * U(buckets)) >> U(32)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    k, who, bucket = k[order].astype(np.uint32), who[order], bucket[order]
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    out = {c: [] for c in ("bucket", "keys", "owners", "counts", "needs")}
    for lo, hi in zip(cuts, [*cuts[1:], len(k)], strict=True):
        w = who[lo:hi]
        run = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
        own = w[run]
        out["bucket"].append(int(bucket[lo]))
        out["keys"].append(k[lo:hi].tobytes())
        out["owners"].append(owners[own].tobytes())
        out["counts"].append(np.diff(np.append(run, hi - lo)).astype(np.uint32).tobytes())
        out["needs"].append(needs[own].tobytes())
    return pa.RecordBatch.from_pydict(out, PACKED)


PACKED = pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("owners", pa.binary()),
                    ("counts", pa.binary()), ("needs", pa.binary())])
PACKED_SQL = ("bucket long, keys binary, owners binary, counts binary, needs binary, "
              "doc_id long, text_id string, n_shingles long, set_id long")


def sketches(docs: DataFrame, buckets: int) -> DataFrame:
    """Packed sketch words of all sets, a row per batch of sets and bucket; and
    a row per document, its bucket negative and given by its text."""
    full = pa.schema([*PACKED, ("doc_id", pa.int64()), ("text_id", pa.string()), ("n_shingles", pa.int64()), ("set_id", pa.int64())])

    def both(rows: pa.Table | pa.RecordBatch) -> pa.RecordBatch:
        n, have = rows.num_rows, set(rows.schema.names)
        return pa.RecordBatch.from_arrays([rows.column(f.name) if f.name in have else pa.nulls(n, f.type) for f in full], schema=full)

    def run(batches):
        keys, owners, needs, seen, held = [], [], [], set(), 0
        for b in batches:
            n, ids = [], []
            for t in b.column("text").to_pylist():
                s = shingle_set(t)
                i = set_id(s)
                n.append(len(s))
                ids.append(i)
                if not i or i in seen:
                    continue
                seen.add(i)
                band = int(np.searchsorted(BORDERS, len(s), "right")) - 1
                for role in (0, 1) if band else (0,):
                    k, need = sketch(s, band - role, role)
                    keys.append(k)
                    owners.append(2 * i + role)
                    needs.append(need)
                    held += len(k)
                if held > SEND:
                    yield both(_pack(keys, np.array(owners, np.int64), np.array(needs, np.uint32), buckets))
                    keys, owners, needs, held = [], [], [], 0
                    seen.clear()
            to = [-1 - int(x[:8], 16) % buckets for x in b.column("text_id").to_pylist()]
            yield both(pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int64()), b.column("doc_id"), b.column("text_id"), pa.array(n, pa.int64()), pa.array(ids, pa.int64())],
                ["bucket", "doc_id", "text_id", "n_shingles", "set_id"]))
        if keys:
            yield both(_pack(keys, np.array(owners, np.int64), np.array(needs, np.uint32), buckets))

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "text_id"), run, PACKED_SQL)


MEMBERS_SQL = "key long, owner long, need long, size long, doc_id long, text_id string, n_shingles long, set_id long"


def _group(t: pa.Table) -> pa.Table:
    """Of one bucket: the members of groups (equal key) with two sets or more,
    at least one of them in role 0. A row per member."""
    names = [x.split()[0] for x in MEMBERS_SQL.split(", ")]
    bucket = t.column("bucket")[0].as_py()
    if bucket < 0:  # documents pass
        return pa.table([t.column(c) if c in t.column_names and c not in ("key", "owner") else pa.nulls(t.num_rows, pa.int64())
                         for c in names], names)

    def cat(c, kind):
        return np.frombuffer(b"".join(t.column(c).to_pylist()), kind)

    key, owner, need = cat("keys", np.uint32), cat("owners", np.int64), cat("needs", np.uint32)
    n = cat("counts", np.uint32)
    owner, need = np.repeat(owner, n), np.repeat(need, n)
    order = np.argsort(key)
    order = order[_alike(key[order])]  # drop keys that occur once before the costly sort
    key, owner, need = key[order], owner[order], need[order]
    order = np.lexsort((owner, key))
    key, owner, need = key[order], owner[order], need[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, owner, need = key[fresh], owner[fresh], need[fresh]
    size = np.empty(0, np.int64)
    if len(key):
        g = np.cumsum(np.concatenate(([True], key[1:] != key[:-1]))) - 1
        size = np.bincount(g)[g]
        native = np.bincount(g, weights=(owner & 1) == 0)[g]
        keep = (size > 1) & (native > 0)
        key, owner, need, size = key[keep], owner[keep], need[keep], size[keep]
    n = len(key)
    return pa.table([pa.array((np.int64(bucket) << 32) | key.astype(np.int64)), pa.array(owner), pa.array(need.astype(np.int64)),
                     pa.array(size), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()),
                     pa.nulls(n, pa.int64())], names)


def _alike(k: np.ndarray) -> np.ndarray:
    """Of sorted values: which equal a neighbour."""
    same = k[1:] == k[:-1]
    out = np.zeros(len(k), bool)
    out[1:] |= same
    out[:-1] |= same
    return out


def members(found: DataFrame) -> DataFrame:
    """(key, owner): members of groups of equal sketch words that may be linked.

    A set needs ``need`` words in common with any linked one, so sets that
    share fewer words with all others together are dropped. Of a set's shared
    words, ordered by the size of their group, all but the last ``need - 1``
    are kept: two linked sets still meet in one, while words of a passage that
    thousands of texts hold are left out wherever a set has rarer ones.
    """
    own = W.partitionBy("owner")
    return written(found.where("key is not null").select("key", "owner", "need", "size")
                   .withColumn("n", F.count("*").over(own))
                   .withColumn("at", F.row_number().over(own.orderBy("size", "key")))
                   .where("n >= need and at <= n - need + 1").select("key", "owner"), "sketch_members")


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a < b) of set ids that link."""
    a = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("sb"))

    def run(batches):
        for t in batches:
            ok = []
            for x, y in zip(t.column("sa"), t.column("sb"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                n = len(x) + len(y)
                if 4 * min(len(x), len(y)) < 3 * max(len(x), len(y)):
                    ok.append(False)
                    continue
                both = n - len(np.unique(np.concatenate((x, y))))
                ok.append(100 * both >= 75 * (n - both))
            yield t.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return arrow_map(pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb"), run, "a long, b long")


def parity_bits(s: np.ndarray) -> np.ndarray:
    """The set as ``64 * BIT_WORDS`` bits: each shingle flips one of them."""
    at = (mix(s + U(1)) >> U(32)) * U(64 * BIT_WORDS) >> U(32)
    odd = np.bincount(at.astype(np.int64), minlength=64 * BIT_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _shingles(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """set_id, size, shingle hashes and bit sketch (b0, b1, ...) of the wanted
    sets, from one document of each."""
    def run(batches):
        for b in batches:
            got = [shingle_set(t) for t in b.column("text").to_pylist()]
            bits = np.array([parity_bits(s) for s in got], np.int64).reshape(len(got), BIT_WORDS).T
            yield pa.RecordBatch.from_arrays(
                [b.column("set_id"), pa.array(map(len, got), pa.int64()),
                 pa.array([s.tobytes() for s in got], pa.binary()), *map(pa.array, bits)],
                ["set_id", "size", "shingles", *_BITS])

    one = (docs["text_id"] == wanted["its_text"]) & docs["doc_id"].eqNullSafe(wanted["its_doc"])
    return arrow_map(docs.join(wanted, one).select("set_id", "text"), run,
                     "set_id long, size long, shingles binary, " + ", ".join(f"{c} long" for c in _BITS)
                     ).dropDuplicates(["set_id"])


_BITS = [f"b{i}" for i in range(BIT_WORDS)]


def _side(s: DataFrame, of: str) -> DataFrame:
    return s.select("key", *[F.col(c).alias(f"{of}_{c}") for c in ("set", "comp", "role", "size", *_BITS)])


def _near() -> Column:
    """Whether pair (x, y) may link: Hamming distance of the bit sketches is at
    most |x ^ y|, which a link bounds by (|x| + |y|) / 7."""
    distance = sum((F.bit_count(F.col(f"x_{c}").bitwiseXOR(F.col(f"y_{c}"))) for c in _BITS), F.lit(0))
    sizes = F.col("x_size") + F.col("y_size")
    return (4 * F.least("x_size", "y_size") >= 3 * F.greatest("x_size", "y_size")) & (7 * distance <= sizes)


def _near_pairs(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """The pairs (x, y) of set ids that may link."""
    a, b = (shingles.select(F.col("set_id").alias(of), *[F.col(c).alias(f"{of}_{c}") for c in ("size", *_BITS)]) for of in "xy")
    return pairs.join(a, "x").join(b, "y").where(_near()).select("x", "y")


def drawn(key: str, value: Column) -> Column:
    """A set id as its place in the order that draws a group's pivot, and back again:
    XOR with a number that the group's key gives."""
    return F.xxhash64(key).bitwiseXOR(value)


def linked(docs: DataFrame, sets: DataFrame, m: DataFrame) -> DataFrame:
    """(node, component) in set ids, of all sets that link with another one.
    ``docs`` and ``sets`` carry doc_id and text_id; ``sets`` also set_id."""
    wanted = (sets.join(m.select(F.shiftright("owner", 1).alias("set_id")).distinct(), "set_id", "left_semi")
              .groupBy("set_id").agg(F.min(F.struct("text_id", "doc_id")).alias("one"))
              .select("set_id", F.col("one.text_id").alias("its_text"), F.col("one.doc_id").alias("its_doc")))
    shingles = written(_shingles(docs, wanted), "shingles")
    links = written(docs.sparkSession.range(0).select(F.col("id").alias("a"), F.col("id").alias("b")), "links")
    label, budget = None, 0
    while True:
        # a row per member: its set, role and current component
        s = m.select("key", F.shiftright("owner", 1).alias("set"), F.col("owner").bitwiseAND(1).alias("role"))
        if label is None:
            s = s.withColumn("comp", F.col("set"))
        else:
            s = (s.join(label, s["set"] == label["node"], "left")
                 .select("key", "set", "role", F.coalesce("component", "set").alias("comp")))
        s = written(s, "sketch_members")
        parts = s.groupBy("key", "comp").agg(
            F.count("*").alias("n"), F.min(F.when(F.col("role") == 0, drawn("key", F.col("set")))).alias("least"))
        groups = (parts.groupBy("key").agg(
            F.sum("n").alias("size"), F.sum(F.col("n") * F.col("n")).alias("squares"),
            F.max(F.struct("n", "comp")).alias("main"),
            F.min(F.when(F.col("least").isNotNull(), F.struct("n", "least", "comp"))).alias("pivot"))
            .where("size * size > squares and pivot is not null")
            .withColumn("pivot_set", drawn("key", F.col("pivot.least"))))
        groups = written(groups, "sketch_open")
        size, across = groups.agg(
            F.sum("size"), F.sum((F.col("size") * F.col("size") - F.col("squares")) / 2)).first()
        if not size:
            return components(links)
        budget = budget or PAIRS_PER_MEMBER * size
        s = s.join(groups.select("key", F.col("main.comp").alias("main"), "pivot_set",
                                 F.col("pivot.comp").alias("pivot_comp")), "key")
        last = label is not None and across <= budget
        if last:
            sized = s.join(shingles.drop("shingles"), s["set"] == shingles["set_id"])
            pairs = (_side(sized.where("comp <> main"), "x").join(_side(sized, "y"), "key")
                     .where("x_comp <> y_comp and x_role + y_role < 2").where(_near())
                     .select(F.col("x_set").alias("x"), F.col("y_set").alias("y")))
        else:
            pairs = s.where("comp <> pivot_comp").select(F.least("pivot_set", "set").alias("x"), F.greatest("pivot_set", "set").alias("y"))
            pairs = _near_pairs(pairs.distinct(), shingles)
        pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        links = written(links.unionByName(_verify(pairs, shingles)), "links")
        if last:
            return components(links)
        label = written(components(links), "sketch_labels")
        done = groups.select("key", (F.col("pivot_set") * 2).alias("owner"))
        m = m.join(done, ["key", "owner"], "left_anti").join(groups.select("key"), "key", "left_semi")
        m = written(m, "sketch_members")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, text_id, n_shingles, component_id of every row."""
    docs = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_id"))
    buckets = bucket_count(text_bytes(docs), BYTES_PER_BUCKET)
    # one scan and one shuffle: documents' sets, and the groups of equal sketch words
    found = written(arrow_groups(sketches(docs, buckets), ["bucket"], _group, MEMBERS_SQL), "sketch_groups")
    rows = found.where("key is null").select("doc_id", "text_id", "n_shingles", "set_id")
    comp = linked(docs, rows.where("n_shingles > 0"), members(found)).withColumnRenamed("node", "set_id")
    named = (rows.join(comp, "set_id", "left")
             .withColumn("component", F.coalesce("component", "set_id")))
    named = written(named, "components")
    least = named.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    return (named.join(least, "component", "left")
            .select("doc_id", "text_id", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The document with the smallest doc_id of each group, and all documents
    without words, with their own columns. Rows that share doc_id and text
    stay or go together."""
    drop = (classes(docs).where("n_shingles > 0 and doc_id <> component_id")
            .select(F.col("doc_id").alias("__doc"), F.col("text_id").alias("__text")).distinct())
    same = (docs["doc_id"] == drop["__doc"]) & (text_key(docs["text"]) == drop["__text"])
    return docs.join(drop.hint("merge"), same, "left_anti")


def op4(spark, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).drop("text_id")
