"""Operators against brute force, round trips and planted cases, and the cases
every operator promises to handle: nulls, empty and long texts, ties and
repeated rows, empty tables, extra columns with clashing names."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (chunk_dedup, decontaminate, graph, lm_scores, packing, parity_join, quality, range_coder,
                          sharding, store, token_counts, toxicity, units)
from tidemark.llm.queries import QUERIES
from tidemark.llm.store import scratch
from tidemark.llm.text import shingle_set
from tidemark.llm.units import encoder

SF = "/root/testdata/sf0.001"
BYTE, WORD = token_counts.TOKENIZER, packing.TOKENIZER

WORDS = [f"w{i}" for i in range(400)]


def words_of(seed, n):
    r = np.random.default_rng(seed)
    return [WORDS[i] for i in r.integers(0, len(WORDS), n)]


LONG = " ".join(words_of(1, 30_000))
PASSAGE = " ".join(words_of(2, 60))
NEAR = words_of(3, 200)
ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, "a"), (4, LONG, "en", "a"),
    (5, "one two three", "en", "a"), (6, "One  TWO three", "en", "a"), (7, " ".join(NEAR), "en", "a"),
    (8, " ".join(NEAR[:100] + ["x"] + NEAR[101:]), "en", "a"), (9, " ".join(NEAR), "de", "b"), (9, " ".join(NEAR), "de", "b"),
    (10, "start " + PASSAGE + " end of ten", "en", "a"), (11, "other words " + PASSAGE + " last", "en", "a"),
    (12, "ünï cödé 日本語 テキスト <|endoftext|> x", "fr", None), (13, "a  b\n\n c \t d", "fr", "c"),
    (None, "no id here but words", "en", "a"), (14, "### $$$ %%% " * 10, "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: names the operators use themselves
CLASH = ("text_id", "set_id", "key", "owner", "cell", "arc", "bucket", "start", "length", "grp", "score", "feature", "n", "__doc")


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    for i, c in enumerate(CLASH):
        df = df.withColumn(c, F.lit(f"extra{i}"))
    return df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def ids_of(path, text):
    return encoder(path).tokenizer.encode(text or "", add_special_tokens=False).ids


# --- 4: n-gram Jaccard join ---------------------------------------------------

def brute_components(rows):
    sets = [(d, set(shingle_set(t).tolist())) for d, t in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            n = len(a & b)
            if a and b and 100 * n >= 75 * (len(a) + len(b) - n):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, a) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(a), least.get(root(i)) if a else d) for i, (d, a) in enumerate(sets)), key=str)


@pytest.mark.parametrize("which", ["odd", "docs", "none"])
def test_parity_join_equals_brute_force(which, request):
    df = request.getfixturevalue(which)
    want = brute_components([(r.doc_id, r.text) for r in df.collect()])
    got = sorted((tuple(r) for r in parity_join.classes(df).drop("text_id").collect()), key=str)
    assert got == want


def test_parity_join_near_the_threshold(spark):
    """A cloud of texts with every overlap around 0.75, sizes over several
    bands: chains, hubs and pairs that just miss."""
    rows, r = [], np.random.default_rng(5)
    for i in range(160):
        base = words_of(100 + i % 8, [9, 30, 70, 160][i % 4])
        for _ in range(r.integers(0, max(2, len(base) // 20))):
            base[r.integers(0, len(base))] = f"e{r.integers(0, 5)}"
        rows.append((i, " ".join(base[:len(base) - r.integers(0, len(base) // 5)])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(x) for x in parity_join.classes(df).drop("text_id").collect()), key=str)
    assert got == brute_components(rows)


def test_parity_join_rounds_find_the_same(spark, monkeypatch):
    """Without the final all-at-once step the pivot rounds alone get there."""
    rows = [(i, " ".join(words_of(7, 60)[:60 - i % 9] + [f"t{i}"])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(parity_join, "PAIRS_PER_MEMBER", 0)
    got = sorted((tuple(x) for x in parity_join.classes(df).drop("text_id").collect()), key=str)
    assert got == brute_components(rows)


def test_pivots_differ_between_groups(spark, monkeypatch):
    """Texts that each lie around the threshold from each other: one pivot per group
    joins nearly all of them, so few pairs are left for the last step."""
    rows, r = [], np.random.default_rng(3)
    for i in range(120):
        t = [f"w{k}" for k in range(200)]
        for k in r.choice(200, r.integers(3, 5), replace=False):
            t[k] = f"x{i}_{k}"
        rows.append((i, " ".join(t)))
    df, steps, verify = spark.createDataFrame(rows, "doc_id long, text string"), [], parity_join._verify

    def counted(pairs, sets):
        steps.append(pairs.count())
        return verify(pairs, sets)

    monkeypatch.setattr(parity_join, "_verify", counted)
    got = sorted((tuple(x) for x in parity_join.classes(df).drop("text_id").collect()), key=str)
    assert got == brute_components(rows)
    assert len(steps) > 1 and steps[-1] < len(rows)


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=80, unique=True), st.integers(0, 40), st.integers(0, 40), st.data())
@settings(max_examples=150, deadline=None)
def test_sketch_words_meet_their_bound(base, drop, add, data):
    a = np.unique(np.array(base, np.uint64))
    b = np.unique(np.concatenate((a[min(drop, len(a) - 1):], np.array(data.draw(
        st.lists(st.integers(0, 2**64 - 1), min_size=add, max_size=add)), np.uint64))))
    n = len(np.intersect1d(a, b))
    if 100 * n < 75 * (len(a) + len(b) - n):
        return
    a, b = sorted((a, b), key=len)
    band = [int(np.searchsorted(parity_join.BORDERS, len(x), "right")) - 1 for x in (a, b)]
    assert band[1] - band[0] in (0, 1)
    ka, na = parity_join.sketch(a, band[0], 0)
    kb, nb = parity_join.sketch(b, band[0], band[1] - band[0])
    assert len(np.intersect1d(ka, kb)) >= max(na, nb)
    distance = sum(int(x).bit_count() for x in (parity_join.parity_bits(a) ^ parity_join.parity_bits(b)).view(np.uint64))
    assert 7 * distance <= len(a) + len(b)


def test_keep_one_keeps_columns_and_one_of_each_group(odd):
    out = parity_join.keep_one(odd)
    assert out.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 1, 2, 3, 4, 5, 7, 10, 12, 13, 14]


def test_components_of_a_long_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in graph.components(e).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# --- 7: decontamination ---------------------------------------------------------

WORD_RE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def norm(t):
    return WORD_RE.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute_hits(text, items):
    w, hit, found = norm(text), set(), set()
    for item, t in items:
        x = norm(t)
        n = min(10, len(x))
        wins = {tuple(x[i:i + n]) for i in range(len(x) - n + 1)} if x else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i:i + n]) in wins:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


ITEMS = [(1, PASSAGE), (20, "one two three"), (3, None), (4, "..."), (5, "two"), (6, "Here, but WORDS"), (6, PASSAGE)]


def test_decontamination_equals_brute_force(spark, odd, none, docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("key", F.lit(1))
    real = spark.read.parquet(f"{SF}/benchmark.parquet")
    for df, b in ((odd, bench), (docs, real), (none, bench), (odd, bench.limit(0))):
        items = [(r.item_id, r.text) for r in b.collect()]
        want = sorted(((r.doc_id, *brute_hits(r.text, items)) for r in df.collect()), key=str)
        got = sorted((tuple(r) for r in decontaminate.contamination(df, b).drop("text_id").collect()), key=str)
        assert got == want


def test_decontamination_removes_documents_or_spans(spark, odd):
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    kept = decontaminate.remove_documents(odd, bench)
    assert kept.columns == odd.columns and {10, 11}.isdisjoint({r.doc_id for r in kept.collect()}) and kept.count() == len(ROWS) - 2
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(odd, bench).collect()}
    assert cut[10] == "start end of ten" and cut[11] == "other words last" and cut[5] == "one two three" and cut[1] is None


# --- 8: quality rules ---------------------------------------------------------

def brute_features(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    win = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    inside = {j for i in range(len(w) - 4) if win[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines, seen, dup = (t or "").split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or "") if w else 0, dup, len(inside))


@pytest.mark.parametrize("which", ["odd", "docs", "none"])
def test_quality_features_equal_brute_force(which, request):
    df = request.getfixturevalue(which)
    got = {}
    for r in quality.judged(df).collect():
        want = brute_features({(x.doc_id): x.text for x in df.collect()}[r.doc_id])
        assert tuple(r[c] for c in quality.BASE) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)
        got[r.doc_id] = r.kept
    if which == "odd":
        assert got[7] and got[4] and not got[14] and not got[1]


def test_quality_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = quality.judged(spark.read.parquet(f"{sf}/documents.parquet")).where("not base_failed")
    lab = spark.read.parquet(f"{sf}/labels.parquet")
    hit = out.join(lab, "doc_id").agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert hit > 0.97


def test_keep_good_keeps_columns(odd):
    out = quality.keep_good(odd)
    assert out.columns == odd.columns and 7 in {r.doc_id for r in out.collect()}


# --- 2, 6, 10: tokens ---------------------------------------------------------

ODD_TEXTS = ["a  b", "a \n b", "\n\na", "a\n b\t c", " x", "x ", "", "a<|endoftext|> b  <|endoftext|>c\n", "it's  we'll d",
             "é x   y", "don't.,x. 12,3.4 A1.,", "  \n  ", "\x1ca b\x1c c", "Σας ΑΣ.", "é x", "a b c", "<|startoftext|>x"]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_units_encode_like_whole_texts(path):
    for t in ODD_TEXTS + [r[1] or "" for r in ROWS]:
        assert np.frombuffer(encoder(path).encode(t), "<u4").tolist() == ids_of(path, t), t


@given(st.text(st.sampled_from("ab.,' \n\t é1!<|>"), max_size=30))
@settings(max_examples=300, deadline=None)
def test_units_encode_like_any_text(t):
    for path in (BYTE, WORD):
        assert np.frombuffer(encoder(path).encode(t), "<u4").tolist() == ids_of(path, t)


@given(st.text(st.sampled_from("aBzéÀßÿŸµªſİ×\u0301 .,'#_&12\n"), max_size=30))
@settings(max_examples=300, deadline=None)
def test_letters_and_signs_encode_like_any_text(t):
    for path in (BYTE, WORD):
        assert np.frombuffer(encoder(path).encode(t), "<u4").tolist() == ids_of(path, t)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_letters_go_to_the_model_alone(path, monkeypatch):
    text = "Unseen wordlings, ÉLAN and élan### go straight"
    enc = units.Encoder(path)
    for ids in (enc.bare, enc.spaced):
        monkeypatch.setattr(ids, "encode", lambda unit: {"###": np.array(ids_of(path, "###"), "<u4").tobytes()}.get(unit))
    enc.bare.end[","] = np.array(ids_of(path, ","), "<u4").tobytes()
    monkeypatch.setattr(enc.bare, "signs", {",": enc.bare.end[","]})
    monkeypatch.setattr(enc.spaced, "signs", {",": enc.bare.end[","]})
    assert np.frombuffer(enc.encode(text), "<u4").tolist() == ids_of(path, text)


def test_full_memory_keeps_the_latest_words(monkeypatch):
    monkeypatch.setattr(units, "MEMORY", 3)
    enc = units.Encoder(BYTE)
    enc.encode("one two three four")
    enc.encode("five")  # more than MEMORY held: a new generation
    monkeypatch.setattr(enc.spaced, "letters", None)  # would be called for a forgotten word
    assert np.frombuffer(enc.encode("five two four"), "<u4").tolist() == ids_of(BYTE, "five two four")


@pytest.mark.parametrize("head", [8_000_000, 8])
def test_token_counts(odd, none, docs, monkeypatch, head):
    """With the whole vocabulary broadcast, and with nearly all of it joined."""
    monkeypatch.setattr(token_counts, "HEAD", head)
    for df in (odd, docs, none):
        want = sorted(((r.doc_id, len((r.text or "").encode()), len(ids_of(BYTE, r.text))) for r in df.collect()), key=str)
        assert sorted((tuple(r) for r in token_counts.counted(df).collect()), key=str) == want


def test_token_counts_hold_few_rows_at_a_time(spark, odd, monkeypatch):
    """A worker takes rows and units in slices, and keeps no unit it has counted."""
    rows = [pa.RecordBatch.from_pydict({"x": list(range(7))})]
    assert [b.column("x").to_pylist() for b in store.slices(rows, 3)] == [[0, 1, 2], [3, 4, 5], [6]]
    enc, batch = units.Encoder(BYTE), [" a", "a", " ", "\n", " Zoë's,", "ﬁ x\u2003", "<|", " İ."]
    assert enc.counts(batch) == [len(ids_of(BYTE, u)) for u in batch]
    for i in range(50):
        enc.counts([f" w{i}", f"w{i}"])
    assert len(enc.bare) + len(enc.spaced) + len(enc.bare.old) + len(enc.spaced.old) < 20
    monkeypatch.setattr(token_counts, "SLICE", 2)
    monkeypatch.setattr(token_counts, "UNITS", 3)
    want = sorted(((r.doc_id, len((r.text or "").encode()), len(ids_of(BYTE, r.text))) for r in odd.collect()), key=str)
    assert sorted((tuple(r) for r in token_counts.counted(odd).collect()), key=str) == want


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark, odd, none, docs):
    for df in (odd, docs, none):
        path = scratch(spark, "test_token_ids")
        range_coder.write(df, path)
        want, at = [], 0
        for r in sorted(df.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or "")):
            ids = ids_of(BYTE, r.text) + [2]
            want.append((r.doc_id, at, len(ids), crc(ids)))
            at += len(ids)
        got = sorted((tuple(r) for r in range_coder.read(spark, path).collect()), key=lambda r: r[1])
        assert got == want


@given(st.lists(st.lists(st.integers(0, 50256), min_size=1, max_size=200), min_size=1, max_size=5), st.integers(1, 40))
@settings(max_examples=40, deadline=None)
def test_blocks_decode(blocks, times):
    blocks = [np.array((b * times)[:1024], "<u4") for b in blocks]
    out = range_coder.decode_blocks(range_coder.encode_blocks(blocks), [len(b) for b in blocks])
    assert all((a == b).all() for a, b in zip(blocks, out, strict=True))


def test_many_texts_meet_the_model_together():
    """Each distinct unit is encoded once for many texts, words of letters in one call of the model."""
    enc = units.Encoder(BYTE)

    class Counted:
        def __init__(self, of):
            self.of, self.calls = of, 0

        def tokenize(self, s):
            self.calls += 1
            return self.of.tokenize(s)

    enc.model = Counted(enc.model)
    texts = [f"Zoë the wordage{c}, wordage{c}! the\nlast.{c}" for c in "abcdefgh" * 5]
    assert enc.encode_all(texts) == [np.array(ids_of(BYTE, t), "<u4").tobytes() for t in texts]
    assert enc.model.calls == 1 and not enc.bare and not enc.spaced


@given(st.lists(st.none() | st.lists(st.sampled_from([
    "a", "the", "Zoë", "é,", "é", "İ.", " ", "  ", "\n", ",", ".", "don't", "'s", "x.", "(hi)", "a!?", "<|endoftext|>", "<|", "\t",
    "\xa0", "\u3000", "\x85", "日本", "a×", "÷.", "ÿ", "Ġ", "Ã", "1,", "¼", "ª,", "\0"]), max_size=12).map("".join), max_size=8),
    st.sampled_from([1, 20, 1 << 20]), st.sampled_from([1, 2, 100]))
@settings(max_examples=60, deadline=None)
def test_many_texts_have_the_ids_of_each(texts, size, together):
    with pytest.MonkeyPatch.context() as m:
        m.setattr(units, "SLICE", size)
        m.setattr(units, "_TOGETHER", together)
        m.setattr(units, "_GATHERED", 2)
        for path in (BYTE, packing.TOKENIZER):
            assert units.encoder(path).encode_all(texts) == [np.array(ids_of(path, t), "<u4").tobytes() for t in texts]


def test_carries_run_through_full_digits():
    digits = np.array([0, 5, 0xFFFFFFFF, 0xFFFFFFFF, 7, 0, 8], np.uint32)
    range_coder._carry(digits, np.array([4, 7]))
    assert digits.tolist() == [0, 6, 0, 0, 7, 0, 9]


def test_low_bytes_of_unforeseen_ids_stand_behind_the_digits():
    ids = np.random.default_rng(5).permutation(1 << 16)[:1024].astype("<u4")
    ids[:3] = 65535, 0, 65534
    short = ids[:7]
    both = range_coder.encode_blocks([ids, short])
    assert both[0].endswith((ids & 255).astype(np.uint8)[::-1].tobytes())
    assert both[1].endswith((short & 255).astype(np.uint8)[::-1].tobytes())
    assert all((a == b).all() for a, b in zip([ids, short], range_coder.decode_blocks(both, [1024, 7]), strict=True))


def test_repetition_is_compressed_and_damage_found(spark, docs):
    ids = np.tile(np.arange(100, 150, dtype="<u4"), 20)[:1024]
    assert len(range_coder.encode_blocks([ids])[0]) < 400
    path = scratch(spark, "test_damage")
    range_coder.write(docs.limit(3), path)
    bad = spark.read.parquet(path).withColumn("checksums", F.transform("checksums", lambda c: c + 1))
    bad.write.parquet(path + "_bad")
    with pytest.raises(Exception, match="checksum"):
        range_coder.read(spark, path + "_bad").collect()


@pytest.mark.parametrize("group", [20_000, 6])
def test_packing_places_every_piece(odd, docs, none, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP", group)
    for df in (odd, docs, none):
        parts = packing.pieces(df).persist()
        out = packing.packed(parts).collect()
        want = collections.Counter()
        for r in df.collect():
            ids = ids_of(WORD, r.text) + [1]
            for p, s in enumerate(range(0, len(ids), 4096)):
                want[(r.doc_id, p, s, len(ids[s:s + 4096]), crc(ids[s:s + 4096]))] += 1
        assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
        seqs = collections.defaultdict(list)
        for r in out:
            seqs[r.sequence_id].append((r.offset, r.length))
        for s in seqs.values():
            at = 0
            for o, n in sorted(s):
                assert o == at
                at += n
            assert at <= 4096
        if group == 20_000 and out:
            assert len(seqs) <= -(-sum(r.length for r in out) // 4096) + 1 + len(out) // 50


@given(st.lists(st.integers(1, 60), min_size=1, max_size=40))
@settings(max_examples=200, deadline=None)
def test_bins_hold_and_bounds_are_bounds(sizes):
    s = np.sort(np.array(sizes))[::-1]
    at, offset, bins = packing.best_fit(s, 60)
    assert bins >= packing.lower_bound(s, 60)
    fill = np.bincount(at, weights=s)
    assert len(fill) == bins and fill.max() <= 60
    assert all(offset[i] == s[:i][at[:i] == at[i]].sum() for i in range(len(s)))


def test_bounds_certify_known_cases():
    assert packing.lower_bound(np.array([31] * 5), 60) == 5   # no two fit
    assert packing.lower_bound(np.array([21] * 6), 60) == 3   # two fit
    assert packing.lower_bound(np.array([], int), 60) == 0


# --- 3: sharding ----------------------------------------------------------------

@pytest.mark.parametrize("cell", [20_000, 3])
def test_shards_are_balanced_and_gapless(odd, docs, none, monkeypatch, cell):
    monkeypatch.setattr(sharding, "ROWS_PER_CELL", cell)
    for df in (odd, docs, none):
        out = sharding.assign(df).collect()
        want = collections.Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in df.collect())
        assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in out) == want
        slots = collections.defaultdict(list)
        for r in out:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        if out:
            n = [len(slots[i]) for i in range(8)]
            assert max(n) - min(n) <= 1


def test_ring_moves_little_when_a_shard_is_added(docs):
    a = {r.doc_id: r.shard for r in sharding.assign(docs, 8).collect()}
    b = {r.doc_id: r.shard for r in sharding.assign(docs, 9).collect()}
    assert sum(a[d] != b[d] for d in a) < 0.6 * len(a)  # a modulus moves 8 of 9


def test_hot_row_is_fanned_out(spark):
    df = spark.createDataFrame([(1, "x")] * 500 + [(i, "y") for i in range(2, 302)], "doc_id long, text string")
    out = sharding.assign(df).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in out) == [100] * 8


# --- 5: substring dedup ---------------------------------------------------------

def test_chunks_cover_the_text_and_follow_the_content():
    raw = LONG.encode()[:20_000]
    ends = chunk_dedup.chunk_ends(raw)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(raw) and sizes.max() <= chunk_dedup.MAX_CHUNK and sizes[:-1].min() >= chunk_dedup.MIN_CHUNK
    moved = chunk_dedup.chunk_ends(b"some inserted words " + raw)
    same = {raw[a:b] for a, b in zip([0, *ends], ends)} & \
        {(b"some inserted words " + raw)[a:b] for a, b in zip([0, *moved], moved)}
    assert len(same) > 0.98 * len(ends)
    assert chunk_dedup.chunk_ends(b"") == []
    tight = ("é" * 2000).encode()
    assert all((tight[e:e + 1] or b"a")[0] & 0xC0 != 0x80 for e in chunk_dedup.chunk_ends(tight))


def test_spans_are_copies_and_passages_are_found(spark, odd, none, docs):
    for df in (odd, docs, none):
        texts = collections.defaultdict(list)
        for r in df.collect():
            texts[r.doc_id].append((r.text or "").encode())
        spans = chunk_dedup.spans(df).collect()
        for s in spans:
            piece = texts[s.doc_id][0][s.start:s.start + s.length]
            assert len(piece) == s.length >= chunk_dedup.MIN_SPAN
            if len(texts[s.first_doc_id]) == 1 and s.first_doc_id is not None:
                assert piece[:chunk_dedup.MIN_CHUNK] in texts[s.first_doc_id][0]
    got = {(s.doc_id, s.first_doc_id) for s in chunk_dedup.spans(odd).collect()}
    assert (11, 10) in got and any(d == 9 and f == 7 for d, f in got) and not any(d in (4, 7, 10) for d, _ in got)


def test_passages_in_many_documents(spark):
    """60-word passages in random places of clean texts: every later copy is
    found, and nothing in the clean texts."""
    r = np.random.default_rng(9)
    clean = [[f"c{i}x{k}" for k in r.integers(0, 10**9, 300)] for i in range(60)]
    shared = [f"p{k}" for k in r.integers(0, 10**9, 60)]
    rows = []
    for i, w in enumerate(clean):
        at = int(r.integers(0, 300))
        rows.append((i, " ".join(w[:at] + (shared if i < 30 else []) + w[at:])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {s.doc_id for s in chunk_dedup.spans(df).collect()} == set(range(1, 30))
    left = {x.doc_id: x.text for x in chunk_dedup.remove(df).collect()}
    assert all(left[i] == rows[i][1] for i in [0, *range(30, 60)])
    assert all(len(left[i]) < len(rows[i][1]) - 150 for i in range(1, 30))


def test_remove_keeps_columns_and_rows(odd):
    out = chunk_dedup.remove(odd)
    assert out.columns == odd.columns and out.count() == len(ROWS)
    assert {r.text for r in out.where("doc_id = 12").collect()} == {ROWS[12][1]}


def common_bytes(passage, seed):
    """Bytes of a text in chunks that it shares with another, which holds
    ``passage`` at another place."""
    r, texts = np.random.default_rng(seed), []
    for _ in range(2):
        raw = (" ".join(f"c{k}" for k in r.integers(0, 10**9, r.integers(20, 60))) + passage + " the end").encode()
        ends = chunk_dedup.chunk_ends(raw)
        texts.append([raw[a:b] for a, b in zip([0, *ends], ends)])
    return sum(len(c) for c in texts[0] if c in texts[1])


def test_chunks_follow_the_content_without_blanks():
    r = np.random.default_rng(3)
    for i in range(30):
        words = [f"p{k}" for k in r.integers(0, 10**6, 100)]
        odd = {sep: sep.join(words) for sep in ("\t", "\r", "\x0b", "\x0c", "\u00a0", ",")}
        odd["chinese"] = "".join(chr(k) for k in r.integers(0x4E00, 0x9000, 250))
        odd["periodic"] = "".join(words[:4]) * 30
        for name, passage in odd.items():
            assert common_bytes(passage, i) >= 0.6 * min(len(passage.encode()), 512), name


def test_short_passages_are_found_whole(spark):
    """Passages of 51 short words: each later holder gets one span, to the byte."""
    r, rows, want = np.random.default_rng(12), [], {}
    letters = list("abcdefghijklmnopqrstuvwxyzé")
    for i in range(120):
        words = ["".join(r.choice(letters, r.integers(2, 4))) for _ in range(51)]
        passage = " ".join(words)
        for k in range(2):
            before = " ".join(f"c{x}" for x in r.integers(0, 10**9, r.integers(5, 40))) + "<[" [k]
            text = before + passage + ">]"[k] + " ".join(f"e{x}" for x in r.integers(0, 10**9, 20))
            rows.append((1000 * k + i, text))
            want[1000 + i] = (len(before.encode()), len(passage.encode()), i)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert min(n for _, n, _ in want.values()) >= chunk_dedup.MIN_SPAN
    got = {s.doc_id: (s.start, s.length, s.first_doc_id) for s in chunk_dedup.spans(df).collect()}
    assert got == want
    for text in (x.text for x in chunk_dedup.remove(df).collect()):
        assert "\ufffd" not in text


def test_patchwork_is_no_span(spark):
    """Pieces of 60 bytes of many documents in a row are no copied passage."""
    r = np.random.default_rng(13)
    rows = [(i, " ".join(f"q{x}" for x in r.integers(0, 10**9, 40))) for i in range(30)]
    rows.append((99, "".join(t[100:160] for _, t in rows)))
    rows.append((100, "start " + rows[7][1][50:300] + " end"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(s.doc_id, s.start, s.length, s.first_doc_id) for s in chunk_dedup.spans(df).collect()]
    assert got == [(100, 6, 250, 7)] or [g[0] for g in got] == [100] and 250 <= got[0][2] <= 254


def test_long_growth_takes_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(chunk_dedup, "PAD", 4)
    text = "".join(words_of(21, 200))
    rows = [(1, "two " + text + " more"), (2, "other things before " + text + "!")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(s.doc_id, s.start, s.length, s.first_doc_id) for s in chunk_dedup.spans(df).collect()]
    assert got == [(2, 19, len(text) + 1, 1)]


# --- 9: language-model scores ---------------------------------------------------

def brute_scores(texts):
    w = [(t or "").encode().lower().split() for t in texts]
    uni = collections.Counter(x for t in w for x in t)
    total = sum(uni.values())
    known = {x for x, n in uni.items() if n >= max(2.0, lm_scores.VOCAB_SHARE * total)}
    unknown = sum(n for x, n in uni.items() if x not in known)
    bi = collections.Counter(p for t in w for p in zip(t, t[1:]))
    out = []
    for t in w:
        s, seen = 0.0, 0
        for i, x in enumerate(t):
            c = uni[x] if x in known else unknown
            if i and x in known and t[i - 1] in known and bi[t[i - 1], x] >= 2:
                s += np.log(bi[t[i - 1], x] / uni[t[i - 1]])
                seen += 1
            else:
                s += np.log(c / total) + (np.log(lm_scores.ALPHA) if i else 0)
        out.append((len(t), seen, s))
    return out


@pytest.mark.parametrize("hot", [1e-3, 0.5])
def test_scores_equal_brute_force(odd, docs, none, monkeypatch, hot):
    monkeypatch.setattr(lm_scores, "HOT_SHARE", hot)
    for df in (odd, docs, none):
        rows = df.select("doc_id", "text").collect()
        want = sorted(((r.doc_id, *s) for r, s in zip(rows, brute_scores([r.text for r in rows]), strict=True)), key=str)
        got = sorted((tuple(r) for r in lm_scores.scores(df).collect()), key=str)
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert np.allclose([g[3] for g in got], [w[3] for w in want])


def whole_scores(texts):
    """Every word with its own count, no class of unknown words."""
    w = [(t or "").encode().lower().split() for t in texts]
    uni, bi = collections.Counter(x for t in w for x in t), collections.Counter(p for t in w for p in zip(t, t[1:]))
    total, out = sum(uni.values()), []
    for t in w:
        hits = [bi[p] >= 2 for p in zip(t, t[1:])]
        s = sum(np.log(uni[x] / total) + np.log(lm_scores.ALPHA) * (i > 0) if not i or not hits[i - 1]
                else np.log(bi[t[i - 1], x] / uni[t[i - 1]]) for i, x in enumerate(t))
        out.append((len(t), sum(hits), s))
    return out


@pytest.mark.parametrize("share", [2e-7, 1e-3, 0.5])
def test_scores_keep_every_word(spark, odd, docs, none, monkeypatch, share):
    """Whatever part of the words is broadcast, all are counted."""
    monkeypatch.setattr(lm_scores, "VOCAB_SHARE", share)
    twice = odd.unionByName(odd).repartition(5)  # copies in several batches
    for df in (odd, twice, docs, none):
        rows = df.select("doc_id", "text").collect()
        want = sorted(((r.doc_id, *s) for r, s in zip(rows, whole_scores([r.text for r in rows]), strict=True)), key=str)
        got = sorted((tuple(r) for r in lm_scores.scores(df, pool_once=False).collect()), key=str)
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert np.allclose([g[3] for g in got], [w[3] for w in want])


def test_scores_come_back_once_a_text(odd, docs, monkeypatch):
    """However many buckets there are, a text's sums are one row of its chunk."""
    monkeypatch.setattr(lm_scores, "BYTES_PER_BUCKET", 500)
    made, groups = [], lm_scores.arrow_groups
    monkeypatch.setattr(lm_scores, "arrow_groups", lambda *a: made.append(groups(*a)) or made[-1])
    lm_scores.scores(docs.repartition(1), pool_once=False)
    texts = docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert [d.where("text_id is not null").count() for d in made if "text_id" in d.columns] == [texts]
    monkeypatch.setattr(lm_scores, "CHUNK", 100)  # copies in several chunks
    for df in (odd.unionByName(odd).repartition(5), docs):
        rows = df.select("doc_id", "text").collect()
        want = sorted(((r.doc_id, *s) for r, s in zip(rows, whole_scores([r.text for r in rows]), strict=True)), key=str)
        got = sorted((tuple(r) for r in lm_scores.scores(df, pool_once=False).collect()), key=str)
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert np.allclose([g[3] for g in got], [w[3] for w in want])


def test_keys_and_numbers_of_chunks_round_trip():
    keys = np.array([0, 1, 255, 1 << 40, (1 << 64) - 1], np.uint64)
    assert (lm_scores._keys(lm_scores._columns(keys)) == keys).all()
    for n in ([0, 1, 254], [255, 3, 256, 1 << 40]):
        n = np.array(n)
        assert (lm_scores._numbers(lm_scores._small(n), len(n)) == n).all()


# --- 1: toxicity -----------------------------------------------------------------

@pytest.mark.parametrize("piece", [1, 40, 1 << 19])
def test_characters_are_counted_in_pieces(odd, docs, none, monkeypatch, piece):
    monkeypatch.setattr(toxicity, "PIECE", piece)
    for df in (odd, docs, none):
        want = collections.Counter()
        for r in df.collect():
            c = [toxicity.kind(chr(b).lower()) if b < 128 else 27 for b in f" {r.text} ".encode()] if r.text else []
            want.update(zip(c, c[1:], c[2:], c[3:], strict=False))
        got = toxicity.char_counts(df).reshape((toxicity.KINDS,) * 4)
        assert {tuple(map(int, k)): int(got[tuple(k)]) for k in np.argwhere(got)} == want


@pytest.fixture(scope="module")
def restorer():
    text = " ".join(["the idiot is a stupid loser and an idiot or a clown", "this list of leet rest data one two"] * 50)
    c = toxicity._KIND_OF_BYTE[np.frombuffer(f" {text} ".encode(), np.uint8)]
    at = ((c[:-3] * 28 + c[1:-2]) * 28 + c[2:-1]) * 28 + c[3:]
    return toxicity.Restorer(toxicity.language_model(np.bincount(at, minlength=28**4)))


@pytest.mark.parametrize("disguise", ["1d10t", "!diot", "i.d.i.o.t", "i d i o t", "idiooooot", "id-iot", "1 d 1 0 t", "i*d*i*o*t", "idi0t,"])
def test_disguises_are_restored(restorer, disguise):
    assert "idiot" in toxicity.restored_words(f"what an {disguise} he is", restorer)


@pytest.mark.parametrize("disguise, word", [
    ("$tupid", "stupid"), ("|diot", "idiot"), ("$tupid!", "stupid"), ("(lown", "clown"), ("#idiot#", "idiot"), ("idiot###", "idiot"),
    ("lo$er$", "loser"), ("i  d  i  o  t", "idiot"), ("i d\ni o t", "idiot"), ("i\td\ti\to\tt", "idiot")])
def test_signs_at_the_edge_are_read_both_ways(restorer, disguise, word):
    found = toxicity.restored_words(f"what a {disguise} he is", restorer)
    assert any(w.startswith(word) for w in found), found


def test_plain_words_stay(restorer):
    assert toxicity.restored_words("A plain text, with words: 2024 and 3.5", restorer) >= {"plain", "text", "with", "words", "2024"}


def test_only_texts_with_single_letters_are_searched(restorer, monkeypatch):
    """Plain texts never meet the patterns of spaced letters; others give all their words."""
    for low in ("you i d i o t", "you i  d\ti\no  t", "a b c de", "x\ny\nz", "\u00e9 \u00e8 \u00e0", "s t u\x1cp i d"):
        rows = dict.fromkeys(" ".join(m.split()) for r in (toxicity._SPACED, toxicity._APART) for m in r.findall(low))
        want = [w for m in rows for w in restorer.restore(m).split()]
        assert want and toxicity.spaced_words(low, low.split(), restorer) == want
    monkeypatch.setattr(toxicity, "_SPACED", None)
    monkeypatch.setattr(toxicity, "_APART", None)
    for low in ("", "a plain text i say", "a b cd e f", "x\n\ny"):
        assert toxicity.spaced_words(low, low.split(), restorer) == []


def test_toxicity_is_learned_from_training_rows_only(spark, odd, none):
    r = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(600):
        w = words_of(1000 + i, 40)
        bad = i % 5 == 0
        if bad:
            w[r.integers(0, 40)] = "zorgo" + "abcdefgh"[i % 8] * 2
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {x.doc_id: x.score for x in toxicity.scored(df, lab).collect()}
    assert len(got) == 600 and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= toxicity.THRESHOLD) == bool(y) for i, y in labels)
    # held-out labels do not matter
    flipped = lab.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic"))
                             .otherwise(F.col("toxic")))
    assert {x.doc_id: x.score for x in toxicity.scored(df, flipped).collect()} == got
    assert toxicity.scored(none, lab).count() == 0
    empty = lab.limit(0)
    assert {s.score for s in toxicity.scored(odd, empty).collect()} == {0.0} and toxicity.scored(odd, empty).count() == len(ROWS)


# --- the queries and the pipeline ------------------------------------------------

def test_every_query_returns_a_row_per_document(spark, docs):
    n = docs.count()
    for name in ("op1_toxicity", "op2_token_ids", "op3_sharding", "op6_token_counts", "op8_quality_rules", "op9_lm_scores"):
        assert QUERIES[name](spark, SF).count() == n, name


def test_pipeline_stages_agree_with_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    cols = docs.columns
    a = {r.doc_id for r in quality.judged(docs).where("kept").collect()}
    kept = corpus_pipeline.quality_rules(spark, docs, sf)
    assert kept.columns == cols and {r.doc_id for r in kept.collect()} == a
    b = corpus_pipeline.near_duplicates(spark, kept, sf)
    want = {c for d, n, c in brute_components([(r.doc_id, r.text) for r in kept.collect()])}
    assert b.columns == cols and {r.doc_id for r in b.collect()} == want
    c = corpus_pipeline.substring_dedup(spark, b, sf)
    assert c.columns == cols and dict(c.dtypes) == dict(docs.dtypes)
    d = corpus_pipeline.decontamination(spark, c, sf)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert {r.doc_id for r in d.collect()} == {r.doc_id for r in c.collect() if not brute_hits(r.text, items)[1]}
    out = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in d.collect()}


def test_pipeline_handles_odd_rows(spark, odd, tmp_path):
    df = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, SF)
        assert df.columns == odd.columns, name
    assert corpus_pipeline.best_fit_packing(spark, df, SF).count() > 0
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), SF).count() == 0, name
