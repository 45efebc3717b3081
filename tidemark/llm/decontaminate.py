"""Operator 7: benchmark decontamination with a broadcast set of test n-grams.

Texts are lower-cased (A-Z) and cut into words. A window is 10 consecutive
words of a benchmark item (an item of fewer words is one window). A window of a
document holds a full ``gram`` (5 words) that begins at a multiple of 6, so
only every sixth 5-gram of a document is hashed and looked up in the
broadcast hash set of all 5-grams of benchmark windows. A hit leaves the scan
with the words around it, is verified against the whole window, word by word,
and every word inside an occurrence is marked. Shorter items are searched the same way with their own, shorter,
grams.

The broadcast set grows with the benchmark only; its row count is taken first
and beyond ``BROADCAST_ROWS`` the same join runs as a shuffle join. Matches
are kept per distinct text and joined back by digest. DataFrame functions only.

Nulls and texts without words: no words, no hits, one row. Repeated rows each
keep their row. A benchmark item without words has no window; a null item_id
is left out of ``items_sha256``; items with equal texts all count. Empty tables
give empty results (no benchmark: no hits). Extra columns are ignored by
``contamination`` and kept by ``remove_documents`` and ``remove_spans``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import lower_ascii, text_key
from .store import table, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5
BROADCAST_ROWS = 2_000_000


def word_array(c: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(lower_ascii(c), F.lit(f"({WORD})"), F.lit(1)),
                      F.array().cast("array<string>"))


def _gram(length: int) -> tuple[int, int]:
    """(words per looked-up gram, distance of looked-up positions) for windows
    of ``length`` words: any window holds a gram at such a position."""
    g = min(GRAM, length)
    return g, length - g + 1


def windows(bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: item_id, length, words."""
    w = bench.select("item_id", word_array(F.col("text")).alias("w")).where(F.size("w") > 0)
    at = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    return (w.select("item_id", "w", F.explode(at).alias("p"))
            .select("item_id", F.slice("w", F.col("p") + 1, window).alias("words"))
            .withColumn("length", F.size("words")).distinct())


def matches(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every occurrence of a window in a distinct text: text_id, start, length, item_id."""
    spark = docs.sparkSession
    texts = docs.select(text_key(F.col("text")).alias("text_id"), word_array(F.col("text")).alias("w"))
    win = written(windows(bench, window), "bench_windows")
    found = None
    for length in sorted(r["length"] for r in win.select("length").distinct().collect()):  # at most `window` values
        g, step = _gram(length)
        own = win.where(F.col("length") == length)
        grams = (own.select("item_id", "words", F.explode(F.sequence(F.lit(0), F.lit(length - g))).alias("o"))
                 .withColumn("gram", F.xxhash64(F.slice("words", F.col("o") + 1, g))))
        keys = grams.select("gram").distinct()
        if keys.count() <= BROADCAST_ROWS:
            keys = F.broadcast(keys)
        at = F.sequence(F.lit(0), F.size("w") - g, F.lit(step))
        # each looked-up gram takes the words around it along, so that the texts
        # themselves never move
        base = lambda q: F.greatest(q - (length - g), F.lit(0))
        looked = (texts.where(F.size("w") >= length)
                  .select("text_id", F.explode(F.transform(at, lambda q: F.struct(
                      q.alias("q"), F.xxhash64(F.slice("w", q + 1, g)).alias("gram"),
                      F.slice("w", base(q) + 1, 2 * length - g).alias("part")))).alias("x"))
                  .select("text_id", "x.q", "x.gram", "x.part"))
        around = looked.join(keys, "gram", "left_semi").withColumn("base", base(F.col("q")))
        around = written(around, "gram_hits")
        verified = (around.join(grams, "gram")
                    .withColumn("start", F.col("q") - F.col("o"))
                    .where((F.col("start") >= 0)
                           & (F.slice("part", F.col("start") - F.col("base") + 1, length) == F.col("words")))
                    .select("text_id", "start", F.lit(length).alias("length"), "item_id").distinct())
        found = verified if found is None else found.unionByName(verified)
    if found is None:
        found = spark.createDataFrame([], "text_id string, start int, length int, item_id long")
    return written(found, "bench_matches")


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, text_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = matches(docs, bench, window)
    words_hit = (found.select("text_id", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at"))
                 .distinct().groupBy("text_id").agg(F.count("*").alias("n_hit")))
    items = (found.select("text_id", F.col("item_id").cast("string").alias("item")).distinct()
             .groupBy("text_id").agg(F.sort_array(F.collect_list("item")).alias("items")))
    per_text = written(words_hit.join(items, "text_id"), "bench_hits")
    none = F.array().cast("array<string>")
    return (docs.select("doc_id", text_key(F.col("text")).alias("text_id"),
                        F.coalesce(F.regexp_count(lower_ascii(F.col("text")), F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"))
            .join(per_text, "text_id", "left")
            .select("doc_id", "text_id", "n_words",
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", F.coalesce("items", none)), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def remove_documents(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any occurrence, with their own columns."""
    found = matches(docs, bench, window).select(F.col("text_id").alias("__text")).distinct()
    # sort-merge at every size: the number of contaminated texts has no bound
    return docs.join(found.hint("merge"), text_key(docs["text"]) == found["__text"], "left_anti")


def remove_spans(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """All documents; the words inside occurrences are cut out of ``text`` and
    the rest joined by single blanks (only in texts with a hit; words are the
    normalised ones there)."""
    found = matches(docs, bench, window)
    at = (found.select("text_id", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at"))
          .groupBy("text_id").agg(F.collect_set("at").alias("hit")))
    hit = at.select(F.col("text_id").alias("__text"), F.col("hit").alias("__hit"))
    w = word_array(docs["text"])
    kept = F.array_join(F.filter(w, lambda x, i: ~F.array_contains(hit["__hit"], i.cast("int"))), " ")
    text = F.when(hit["__hit"].isNull(), docs["text"]).otherwise(kept).alias("text")
    joined = docs.join(hit.hint("merge"), text_key(docs["text"]) == hit["__text"], "left")
    return joined.select(*[text if c == "text" else docs[c] for c in docs.columns])


def op7(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_id")
