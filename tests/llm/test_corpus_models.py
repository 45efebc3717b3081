"""Quality classifier, source divergence and collocations against plain second
versions, and the odd rows every operator promises to handle."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm import CLASH, ROWS, SCHEMA, SF, words_of

from tidemark.llm import collocations, divergence, kernel_quality


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ROWS + [(70 + i, "Ünï a b-c! d'e\x0bf g\x0ch 日本 é z" * (i % 3), None, None) for i in range(6)],
                               SCHEMA).repartition(3)
    for i, c in enumerate((*CLASH, "term", "digest", "docs", "p", "place", "shard")):
        df = df.withColumn(c, F.lit(f"extra{i}"))
    return df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# --- 11: quality classifier -------------------------------------------------------

def plain_scores(rows, labels):
    """The same model with numpy alone, in one piece."""
    k = kernel_quality
    x = [tuple(np.rint(np.array(k.stats(t), float) * k.UNIT).astype(int).tolist()) for _, t in rows]
    known = {}
    for d, q in labels:
        if d is not None and q is not None:
            known[d] = max(q, known.get(d, 0))
    seen = collections.defaultdict(list)
    for (d, _), v in {(r[0], v): v for r, v in zip(rows, x, strict=True)}.items():
        if d in known and zlib.crc32(str(d).encode()) % 3 != k.HELD_OUT:
            seen[v].append(known[d])
    return x, {v: sum(q) / len(q) for v, q in seen.items()}


def labels_of(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_statistics_of_texts():
    s = dict(zip(kernel_quality.STATS, kernel_quality.stats("One two two four!\nOne two two four!\n### 12"), strict=True))
    assert s["words"] == pytest.approx(np.log(10)) and s["lines"] == pytest.approx(np.log(3))
    assert s["same_lines"] == pytest.approx(1 / 3) and s["same_again"] == pytest.approx(2 / 9)
    assert s["bangs"] == pytest.approx(0.2) and s["signs"] == pytest.approx(0.3) and s["capital_starts"] == pytest.approx(0.2)
    assert s["common_word"] == pytest.approx(0.4) and s["marked_ends"] == pytest.approx(0.2)
    assert kernel_quality.stats(None) == kernel_quality.stats(" \n") == [0.0] * len(kernel_quality.STATS)


def test_classifier_trains_on_training_rows_only(spark, docs):
    rows, labels = docs.select("doc_id", "text").collect(), labels_of(spark)
    _, want = plain_scores([(r.doc_id, r.text) for r in rows], [(r.doc_id, r.quality) for r in labels.collect()])
    got = {tuple(r[c] for c in kernel_quality.STATS): r["good"] / r["n"]
           for r in kernel_quality.labelled(kernel_quality.with_stats(docs), labels).collect()}
    assert got == want


def test_scores_tell_good_from_bad_on_rows_held_out(spark, docs):
    got = {r.doc_id: r.score for r in kernel_quality.scored(docs, labels_of(spark)).collect()}
    held = [(got[r.doc_id], r.quality) for r in labels_of(spark).collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == kernel_quality.HELD_OUT]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert good and bad and all(0 <= s <= 1 for s in got.values())
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.9


def test_scores_do_not_depend_on_partitions_or_other_columns(spark, docs):
    labels = labels_of(spark)
    one = {r.doc_id: r.score for r in kernel_quality.scored(docs.coalesce(1), labels).collect()}
    other = docs.repartition(7, "text").withColumns({"lang": F.lit("x"), "source": F.lit(None).cast("string"), "words": F.lit("y"),
                                                     "fold": F.lit(0)})
    assert one == {r.doc_id: r.score for r in kernel_quality.scored(other, labels.repartition(3)).collect()}


def test_classifier_takes_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(i, None if i in (5, None) else i % 2, 0) for i in [*range(80), None, 7]], "doc_id long, quality int, toxic int")
    got = kernel_quality.scored(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3, 70, 73)}) == 1  # no words
    assert {r.score for r in kernel_quality.scored(odd, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in kernel_quality.scored(odd, labels.where("quality = 1")).collect()} == {1.0}
    assert kernel_quality.scored(none, labels).collect() == []


def test_isotonic_line_pools_neighbours():
    x, y = kernel_quality.rising(np.arange(5.0), np.array([0, 2, 1, 3, 4.0]), np.array([4.0] * 5))
    assert y.tolist() == [0, 1.5 / 4, 3 / 4, 1] and x.tolist() == [0, 1.5, 3, 4]


def test_ridge_weights_equal_a_direct_solution(spark):
    r = np.random.default_rng(1)
    z, y = r.standard_normal((300, 6)), r.standard_normal(300)
    z[:, -1] = 1
    m = np.hstack([z, y[:, None]]) * kernel_quality.COSINE
    got = kernel_quality.solved(m.T @ m, 1e-2)
    pen = np.sqrt(np.diag([3.0] * 5 + [1e-9]))
    want = np.linalg.lstsq(np.vstack([z, pen]), np.append(y, np.zeros(6)), rcond=None)[0]
    assert np.allclose(got, want)


# --- 12: source divergence ----------------------------------------------------------

def plain_audit(rows):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(t))) for t, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = collections.Counter(t for d in own for t in set(d[2]))
        kept = [t for t in df if df[t] >= 3]
        n = {s: collections.Counter() for _, s, _ in own}
        for _, s, w in own:
            n[s].update(t for t in w if df[t] >= 3)
        n[None] = sum(n.values(), collections.Counter())
        v = len(kept)
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + v) for t in kept} for s, c in n.items()}

        def gap(a, b):
            return (a - b) ** 2 // b

        for s in n:
            if s is None:
                continue
            pairs = [(sum(gap(p[s][t], p[o][t]) for t in kept), o) for o in n if o not in (None, s)]
            terms = [(gap(p[s][t], p[None][t]), t) for t in kept if n[s][t] and p[s][t] > p[None][t]]
            for part, found in (("pair", pairs), ("term", sorted(terms, key=lambda x: (-x[0], x[1].encode()))[:200])):
                for i, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))):
                    out.append((lang, s, part, item, value, i + 1))
    return sorted(out)


@pytest.mark.parametrize("which", ["odd", "docs", "none"])
def test_divergence_equals_brute_force(which, request):
    df = request.getfixturevalue(which)
    got = sorted(tuple(r) for r in divergence.audit(df).collect())
    assert got == plain_audit([(r.text, r.lang, r.source) for r in df.collect()])


def test_divergence_in_small_pieces(spark, monkeypatch):
    """Copies, flushes and batches of terms in many pieces change nothing."""
    rows = [(" ".join(words_of(i % 40, 30 + i % 7)), "en" if i % 5 else "de", f"s{i % 9 if i % 3 else 0}") for i in range(300)]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    for name, value in (("HELD", 50), ("DIGESTS", 3), ("CELLS", 16)):
        monkeypatch.setattr(divergence, name, value)
    assert sorted(tuple(r) for r in divergence.audit(df).collect()) == plain_audit(rows)


def test_copies_of_a_text_travel_once(spark):
    df = spark.createDataFrame([("same text here", "en", f"s{i % 4}") for i in range(500)], "text string, lang string, source string")
    got = divergence.collapsed(df.coalesce(2)).collect()
    assert sum(r.n for r in got) == 500 and sum(r.text is not None for r in got) <= 2 and len(got) <= 16


def test_counts_of_copies_and_many_sources(spark, monkeypatch):
    """Copies weigh by their number, texts of one source once; also when sums are passed on often."""
    rows = [("b a a c", "en", f"s{i % 3}") for i in range(7)] + [("a d", "en", "s0"), ("a d", "de", "s0"), (None, "en", "s9")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1)
    want = collections.defaultdict(lambda: [0, 0])
    for t, lang, s in rows:
        for w, n in [*collections.Counter((t or "").split()).items(), (None, 0)]:
            want[lang, w, s][0] += n
            want[lang, w, s][1] += 1
    for held in (400_000, 1):
        monkeypatch.setattr(divergence, "HELD", held)
        got = divergence.counted(df).groupBy("lang", "term", "source").agg(F.sum("n"), F.sum("docs")).collect()
        assert {tuple(r[:3]): list(r[3:]) for r in got} == want


def test_shares_by_long_division(spark):
    cases = [(1, 3), (7, 7), (10**14, 10**15), (1, 8 * 10**15), (8 * 10**15 - 1, 8 * 10**15), (123456789, 987654321)]
    got = spark.createDataFrame(cases, "c long, t long").select(divergence.share(F.col("c"), F.col("t")).alias("p")).collect()
    assert [r.p for r in got] == [1 + 10**9 * c // t for c, t in cases]


# --- 13: collocations ---------------------------------------------------------------

def plain_phrases(rows, least, top):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for t, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(t)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        inner = collections.Counter()
        for g, a in cand.items():
            if len(g) == 3:
                for x in (g[:2], g[1:]):
                    inner[x] = max(inner[x], a)
        found = []
        for g, a in cand.items():
            if 100 * inner[g] >= 50 * a and inner[g]:
                continue
            score, _, left, right = min((10**6 * a * a // (c[g[:k]] * c[g[k:]]), k, c[g[:k]], c[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.mark.parametrize("which", ["odd", "docs", "none"])
def test_collocations_equal_brute_force(which, request):
    df = request.getfixturevalue(which)
    for least, top in ((10, 2000), (2, 50)):
        got = sorted(tuple(r) for r in collocations.collocations(df, least, top).collect())
        assert got == plain_phrases([(r.text, r.lang) for r in df.collect()], least, top)


def test_collocations_over_many_small_shards(spark, monkeypatch):
    r = np.random.default_rng(3)
    rows = [(" ".join(f"w{x}" + ".,"[x % 2] * (x % 11 == 0) for x in (r.zipf(1.3, 400) % 60).tolist()), ["en", "de", None][i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    monkeypatch.setattr(collocations, "SHARD", 100)
    assert collocations.shards(df).count() > 100
    assert sorted(tuple(x) for x in collocations.collocations(df, 5).collect()) == plain_phrases(rows, 5, 2000)


def test_index_extends_both_ways():
    """Intervals of all phrases of up to three words, both ways, against the text."""
    s = np.random.default_rng(4).integers(0, 5, 300).astype(np.int32)
    index = collocations.Index(s)
    run = [0, *s.tolist(), 0]

    def count(*g):
        return sum(run[i:i + len(g)] == list(g) for i in range(len(run)))

    a, b, at, back, n = collocations._bigrams(index)
    assert {(x, y): c for x, y, c in zip(a.tolist(), b.tolist(), n.tolist(), strict=True)} == \
        {(x, y): count(x, y) for x in range(1, 5) for y in range(1, 5) if count(x, y)}
    of, w, here, there, m = index.left(at, back, n)
    lefts = {(x, a[o], b[o]): c for o, x, c in zip(of.tolist(), w.tolist(), m.tolist(), strict=True)}
    of, w, here2, there2, m = index.right(at, back, n)
    rights = {(a[o], b[o], x): c for o, x, c in zip(of.tolist(), w.tolist(), m.tolist(), strict=True)}
    assert lefts == rights == {g: count(*g) for g in lefts} and sum(lefts.values()) == sum(
        all(run[i:i + 3]) for i in range(len(run) - 2))
    # the same trigram has the same intervals, whichever way it was reached
    assert sorted(zip(here.tolist(), there.tolist())) == sorted(zip(here2.tolist(), there2.tolist()))
