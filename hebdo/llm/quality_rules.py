"""Quality rules: base statistics, and a hashed n-gram log-likelihood ratio.

Words and word pairs of a document are hashed into ``BUCKETS``. Counts over the trusted
documents and over the whole corpus give two smoothed multinomials; a document's score is the
mean over its n-grams of the log ratio of the two, so it does not depend on its length. Ratios
are kept as whole millionths: their sum, and so the verdict, does not depend on the order of
addition. Everything is built from DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import SYMBOLS, WORD, once, squeezed, text_of, written

BUCKETS = 1 << 14
SMOOTHING = 1.0
#: Kept if the mean log ratio is at least this.
THRESHOLD = -0.08
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
MILLION = 1_000_000
PAIR_FACTOR = 1_000_003  # the hash of a pair: that of the first word times this, plus the second's


def word_hashes(text: Column) -> Column:
    """The words' CRC-32 values, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
                       lambda w: F.crc32(w.cast("binary")))


def neighbours(hashes: Column) -> Column:
    """array<struct<word, next>>: each word's hash and that of the word after it (null at the end)."""
    return F.arrays_zip(hashes.alias("word"), F.slice(hashes, 2, F.greatest(F.size(hashes), F.lit(1))).alias("next"))


def buckets_of(word: Column, following: Column, buckets: int) -> tuple[Column, Column]:
    """The bucket of a word, and that of the pair it begins (null at the end)."""
    return word % buckets, (word * PAIR_FACTOR + following) % buckets


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, ratio (millionths): a row for each bucket that the corpus hits, ``buckets`` rows at
    most. ``trusted`` has the doc_ids of the trusted documents. Counts are added up in the
    tasks before the shuffle. The trusted ids grow with the corpus, so this join is a sort-merge
    join at every size: the texts are shuffled once, and the plan on a small sample is the plan
    on the whole corpus."""
    ids = trusted.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("trusted_id")).distinct()
    counts = (docs.select("doc_id", text_of().alias("text"))
              .join(ids.hint("merge"), F.col("doc_id") == F.col("trusted_id"), "left")
              .select(F.col("trusted_id").isNotNull().cast("long").alias("good"), once(hashes=word_hashes(F.col("text"))))
              .select("good", F.inline(neighbours(F.col("hashes"))).alias("word", "next"))
              .select("good", F.explode(F.array(*buckets_of(F.col("word"), F.col("next"), buckets))).alias("bucket"))
              .filter("bucket IS NOT NULL")
              .groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("target")))
    counts = written(counts, "quality-counts")
    sums = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    whole = lambda name: float(sums[name] or 0) + SMOOTHING * buckets
    share = lambda name: (F.col(name) + SMOOTHING) / whole(name)
    return counts.select("bucket", F.rint((F.log(share("target")) - F.log(share("raw"))) * MILLION)
                         .cast("long").alias("ratio"))


def joined(hashes: Column, step: int) -> Column:
    """Each element hashed with the one ``step`` after it; elements without one are left out."""
    n = F.size(hashes) - step
    return F.when(n > 0, F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, step + 1, n), lambda a, b: F.xxhash64(a, b))) \
        .otherwise(F.array().cast("array<bigint>"))


def repeated_words(windows: Column) -> dict[str, Column]:
    """The stages of counting words under windows that occur twice: each refers to the column
    of the one before, which must have been computed once."""
    numbered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # most texts repeat no window: those are not sorted
    sorted_ = F.when(F.size(F.array_distinct(windows)) < F.size(windows), numbered).otherwise(
        F.array().cast("array<struct<h: bigint, i: int>>"))
    by_hash = F.col("sorted")
    again = F.filter(by_hash, lambda x, k: (F.coalesce(F.get(by_hash, k - 1)["h"] == x["h"], F.lit(False))
                                            | F.coalesce(F.get(by_hash, k + 1)["h"] == x["h"], F.lit(False))))
    places = F.sort_array(F.transform(again, lambda x: x["i"]))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(F.col("places"), zero, lambda acc, p: F.struct(
        (acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).cast("long").alias("n"), (p + WINDOW).alias("end")),
        lambda acc: acc["n"])
    return {"sorted": sorted_, "places": places, "covered": covered}


def quality(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, score (mean log ratio; null without words) and kept.

    Null text counts as empty: no words, base_failed. Repeated rows give repeated rows; ids in
    ``trusted`` that no document has, and null ids, do nothing; without trusted documents the
    ratios say little, but every row still gets a verdict; other columns are not read; an empty
    table gives none.
    """
    ratios = written(log_ratios(docs, trusted, buckets), "quality-ratios")
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(squeezed(line)) > 0)
    count = lambda chars: F.length("text") - F.length(F.translate("text", chars, ""))
    found = docs.select("doc_id", F.monotonically_increasing_id().alias("uid"), text_of().alias("text"),
                        once(hashes=word_hashes(text_of())))
    found = found.select("*", once(lines=lines, joined=joined(F.col("hashes"), 1)))
    for step in (2, 4):  # hashes of 2, 4 and 8 words from two halves each
        found = found.withColumnRenamed("joined", "half").select(
            *[c for c in found.columns if c != "joined"], once(joined=joined(F.col("half"), step)))
    found = found.withColumnRenamed("joined", "windows")
    stages = repeated_words(F.col("windows"))
    found = (found.select("*", once(sorted=stages["sorted"])).select("*", once(places=stages["places"]))
             .select("doc_id", "uid", F.size("hashes").cast("long").alias("n_words"),
                     F.length(squeezed(F.col("text"))).cast("long").alias("word_chars"),
                     count(SYMBOLS).cast("long").alias("n_symbols"),
                     (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                     stages["covered"].alias("n_repeat_words"), "hashes"))
    base = ["doc_id", "uid", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    # a document's n-grams meet the ratios (a broadcast of ``buckets`` rows at most) and are added
    # up again in the same task: one narrow row per document is shuffled
    of_word, of_pair = buckets_of(F.col("word"), F.col("next"), buckets)
    by_word = F.broadcast(ratios.select(F.col("bucket").alias("word_bucket"), F.col("ratio").alias("word_ratio")))
    by_pair = F.broadcast(ratios.select(F.col("bucket").alias("pair_bucket"), F.col("ratio").alias("pair_ratio")))
    summed = (found.select(*base, F.inline_outer(neighbours(F.col("hashes"))).alias("word", "next"))
              .select(*base, of_word.alias("of_word"), of_pair.alias("of_pair"))
              .join(by_word, F.col("of_word") == F.col("word_bucket"), "left")
              .join(by_pair, F.col("of_pair") == F.col("pair_bucket"), "left")
              .groupBy(*base).agg(
                  (F.coalesce(F.sum("word_ratio"), F.lit(0)) + F.coalesce(F.sum("pair_ratio"), F.lit(0))).alias("total"),
                  (F.count("word_ratio") + F.count("pair_ratio")).alias("n_grams")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    passes = (F.col("n_grams") > 0) & (F.col("total") >= F.lit(round(threshold * MILLION)) * F.col("n_grams"))
    return summed.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"),
                         (F.col("total") / F.when(F.col("n_grams") > 0, F.col("n_grams")) / MILLION).alias("score"),
                         (~failed & passes).alias("kept"))
