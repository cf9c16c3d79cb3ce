"""Quality rules: counts per document and a hashed n-gram log-likelihood ratio between trusted texts and the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.exprs import let, text_of, words
from riskloom.session import materialize

#: Runs of letters and digits, and runs of other characters, are tokens; the n-grams are the tokens and their pairs.
TOKEN = r"[\p{L}\p{N}]+|[^\x20\x09-\x0D\p{L}\p{N}]+"
SYMBOLS = r"[#*$%&|<>]"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"
BUCKETS = 1 << 14
SMOOTHING = 1.0
#: So many ids of trusted documents go to every task (some 40 MB); more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: Least mean log-likelihood ratio (natural logarithm, per n-gram) of a kept document.
THRESHOLD = -0.25
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), 0)


def buckets_of(text: Column, buckets: int) -> Column:
    """The bucket of every token and of every pair of neighbouring tokens."""
    def hashed(gram: Column) -> Column:
        return (F.crc32(gram.cast("binary")) % F.lit(buckets)).cast("int")

    def grams(own: Column) -> Column:
        pairs = F.zip_with(
            F.slice(own, 1, F.greatest(F.size(own) - 1, F.lit(0))), F.slice(own, 2, F.greatest(F.size(own), F.lit(1))),
            lambda a, b: hashed(F.concat(a, F.lit(" "), b)),
        )
        return F.concat(F.transform(own, hashed), pairs)

    return let(tokens(text), grams)


def ratio_table(grams: DataFrame, labels: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """One row with ``ratios``: ln(p trusted / p corpus) of each bucket, from (doc_id, buckets). The corpus counts are
    those of all documents, the trusted ones those of all that a label calls good."""
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)

    def counted(rows: DataFrame, name: str) -> DataFrame:
        each = rows.select(F.explode("buckets").alias("bucket"))
        return each.groupBy(F.col("bucket").cast("int").alias("bucket")).agg(F.count("*").alias(name))

    counts = counted(grams, "corpus").unionByName(
        counted(grams.join(good, "doc_id", "left_semi"), "trusted"), allowMissingColumns=True
    )
    empty = grams.sparkSession.range(buckets).select(
        F.col("id").cast("int").alias("bucket"), F.lit(0).cast("bigint").alias("corpus"),
        F.lit(0).cast("bigint").alias("trusted"),
    )
    every = counts.unionByName(empty).groupBy("bucket").agg(
        F.sum("corpus").alias("corpus"), F.sum("trusted").alias("trusted")
    )
    held = every.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "corpus", "trusted"))).alias("cells"),
        F.sum("corpus").alias("all_corpus"), F.sum("trusted").alias("all_trusted"),
    )
    whole = smoothing * buckets
    return held.select(F.transform("cells", lambda c: F.ln(
        (c.trusted + smoothing) / (F.col("all_trusted") + whole) * (F.col("all_corpus") + whole) / (c.corpus + smoothing)
    )).alias("ratios"))


def repeated_words(own: Column) -> Column:
    """Words that lie in a window of three words found twice or more in the array; windows meet by 64-bit hashes."""
    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - 3),
            lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)),
        )

    def starts(placed: Column) -> Column:
        """Where the windows start that are not alone, in order."""
        def twin(k: Column) -> Column:
            here = F.get(placed, k)["hash"]
            same = (F.get(placed, k - 1)["hash"] == here) | (F.get(placed, k + 1)["hash"] == here)
            return F.struct(F.get(placed, k)["at"].alias("at"), F.coalesce(same, F.lit(False)).alias("twin"))

        marked = F.transform(F.sequence(F.lit(0), F.size(placed) - 1), twin)
        return F.sort_array(F.transform(F.filter(marked, lambda m: m.twin), lambda m: m.at))

    def covered(at: Column) -> Column:
        begin = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(at, begin, lambda s, i: F.struct(
            i.alias("last"), (s.n + F.least(F.lit(3), i - s["last"])).alias("n")
        ), lambda s: s.n)

    def count(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            let(placed, lambda p: let(starts(p), covered))
        )

    return F.when(F.size(own) < 3, F.lit(0).cast("bigint")).otherwise(
        let(F.transform(own, lambda w: F.xxhash64(w)), lambda hashes: let(windows(hashes), count))
    )


def base_counts(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_CHARACTER))
    return let(words(text), lambda own: F.struct(
        F.size(own).cast("bigint").alias("n_words"),
        F.char_length(F.array_join(own, "")).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("bigint").alias("n_dup_lines"),
        repeated_words(own).alias("n_repeat_words"),
    ))


def assess(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD,
    smoothing: float = SMOOTHING, with_text: bool = True,
) -> DataFrame:
    """The rows of ``docs`` with the base counts, ``base_failed``, ``ratio`` and ``kept``.

    ``ratio`` is the mean over a document's n-grams of ln(p trusted / p corpus), hashed into ``buckets``; documents
    under the threshold go, as do those that fail the base rules (under 50 words, or more than half of the words in
    repeated windows). The corpus is all of ``docs``. Each text is read once: its counts and bucket numbers are written
    to a stage table, from which the table of ratios and then the documents' means are made. That table has a fixed size
    and reaches the tasks as a literal; texts are not shuffled. ``with_text=False`` leaves the text out.

    Null and empty texts have no words, so they fail; their ratio is 0. Without labels every n-gram is judged by the
    corpus alone, evenly. Null and repeated doc_ids are rows of their own. Columns of ``docs`` keep their names and
    come first; a clashing one (such as ``kept``) is replaced. An empty table gives no rows.
    """
    own = F.col("_text")
    held = [c for c in docs.columns if with_text or c != "text"]
    read = docs.withColumn("_text", text_of("text")).select(
        *held, base_counts(own).alias("_base"), buckets_of(own, buckets).cast("array<smallint>").alias("_buckets")
    )
    found = materialize(read, "grams")
    table = ratio_table(found.select("doc_id", F.col("_buckets").alias("buckets")), labels, buckets, smoothing).first()[0]
    ratios = F.split(F.lit(" ".join(map(repr, table))), " ").cast("array<double>")  # folded to one literal
    mean = F.when(F.size("_buckets") == 0, F.lit(0.0)).otherwise(
        F.aggregate("_buckets", F.lit(0.0), lambda s, b: s + F.get(ratios, b.cast("int"))) / F.size("_buckets")
    )
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    counted = found.withColumn("ratio", mean).withColumns({c: F.col(f"_base.{c}") for c in base})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = counted.withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold)).drop("_base", "_buckets")
