"""Secret scan: candidates by pattern, false positives removed by a random forest."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.exprs import let, lower_ascii, text_of, words
from riskloom.session import materialize

KEY_SIGNS = r"A-Za-z0-9+/_\-"
#: Keys that their prefix gives away.
PREFIXED = r"(?:AKIA[0-9A-Z]{16}(?![A-Za-z0-9])|gh[pousr]_\w{36,}|sk_live_\w{16,}|xox[abp]-[\w\-]{10,})"
HEXADECIMAL = r"(?:[0-9a-fA-F]{64}|[0-9a-fA-F]{40}|[0-9a-fA-F]{32})"
#: Forms of issued keys: plain hexadecimal of usual lengths, and prefixes.
ISSUED = rf"^(?:{HEXADECIMAL}|{PREFIXED})$"
NAME = r"(?i:api|auth|credential|key|passphrase|passwd|password|pwd|secret|token)[\w\-]{0,16}\W{0,6}"
#: In this order: an issued form; a value of 8 characters behind a telling name and an equals sign or colon, up to white
#: space, the next assignment or an issued form; a run of 16 key characters with a digit in it; a quoted value of 8
#: characters after an equals sign or colon. Long repetitions are possessive: Java keeps no stack for them.
CANDIDATE = (
    rf"(?<![A-Za-z0-9]){PREFIXED}"
    rf"|(?<![{KEY_SIGNS}]){HEXADECIMAL}(?![{KEY_SIGNS}=])"
    rf"""|(?<=[=:\s])(?<=[=:]\s{{0,4}})(?<={NAME})(?!["'])"""
    rf"""(?:(?!(?<![A-Za-z0-9]){PREFIXED}|[,;&]["']?[\w\-]{{1,64}}["']?\s{{0,4}}[=:])\S){{8,}}+"""
    rf"|(?:(?<![{KEY_SIGNS}])|\G)(?=[A-Za-z+/_\-]*+[0-9])(?:[A-Za-z0-9]|[+/_\-](?!{PREFIXED})){{16,}}+={{0,2}}"
    r"""|(?<=[=:] {0,2}["'])[^\s"']{8,}(?=["'])"""
)
#: Neighbourhood of a candidate, in characters on each side; names stand in the last words before it.
CONTEXT = 64
NAMES = f"{NAME}$"
ASSIGNED = r"""[=:]\s{0,4}["']?$"""
#: The dictionary: the most frequent words of four letters at least in all texts.
DICTIONARY_WORDS = 1000
#: Labelled findings that the forest is fitted on: those of the least hashes.
TRAINING_FINDINGS = 20_000
TREES, DEPTH, SEED = 20, 6, 7
THRESHOLD = 0.5
MASK = "[secret]"
PLACES = 64

FEATURES = [
    "length", "class_changes", "digit_share", "upper_share", "distinct_share", "hexadecimal", "dictionary_share",
    "slashes", "place", "named", "assigned", "quoted", "word_before_known",
    "issued",
]


def dictionary(docs: DataFrame, size: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent words of four to twelve letters, counted over all texts; ties by the alphabet."""
    split = docs.select(F.explode(words(lower_ascii(text_of("text")))).alias("word"))
    counts = split.filter(F.col("word").rlike("^[a-z]{4,12}$")).groupBy("word").agg(F.count("*").alias("n"))
    return [r.word for r in counts.orderBy(F.desc("n"), "word").limit(size).collect()]


def findings(docs: DataFrame) -> DataFrame:
    """One row per candidate: doc_id, place (of the document's source, hashed), start, value, and what stands before
    and after it."""
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    place = F.coalesce(F.crc32(source.cast("binary")) % PLACES, F.lit(-1)).cast("int")
    rows = docs.select("doc_id", text_of("text").alias("text"), place.alias("place"))
    found = rows.withColumn("values", F.regexp_extract_all("text", F.lit(CANDIDATE), 0)).filter(F.size("values") > 0)
    gaps = found.withColumn("gaps", F.split("text", CANDIDATE, -1))

    def place_all(row: Column) -> Column:
        begin = F.struct(F.lit(0).cast("bigint").alias("end"), F.array().cast("array<bigint>").alias("starts"))
        starts = F.aggregate(F.sequence(F.lit(0), F.size(row["values"]) - 1), begin, lambda s, i: let(
            s["end"] + F.char_length(F.get(row.gaps, i)), lambda at: F.struct(
                (at + F.char_length(F.get(row["values"], i))).alias("end"),
                F.array_append(s.starts, at).alias("starts"),
            )
        ), lambda s: s.starts)
        return F.transform(F.arrays_zip(starts.alias("start"), row["values"].alias("value")), lambda z, i: F.struct(
            z.start.alias("start"), z.value.alias("value"),
            F.right(F.get(row.gaps, i), F.lit(CONTEXT)).alias("before"),
            F.left(F.get(row.gaps, i + 1), F.lit(CONTEXT)).alias("after"),
        ))

    listed = gaps.withColumn("found", let(F.struct("values", "gaps"), place_all))
    return listed.select("doc_id", "place", F.explode("found").alias("f")).select("doc_id", "place", "f.*")


def with_features(found: DataFrame, known: list[str]) -> DataFrame:
    value = F.col("value")
    length = F.char_length(value)
    runs = F.filter(F.regexp_extract_all(lower_ascii(value), F.lit("[a-z]{4,}"), 0), lambda r: r.isin(known))
    last = F.regexp_extract(lower_ascii(F.col("before")), r"([a-z]+)[^a-z]*$", 1)
    flags = {
        "hexadecimal": value.rlike("^[0-9a-fA-F]+$"), "named": F.col("before").rlike(NAMES),
        "assigned": F.col("before").rlike(ASSIGNED), "quoted": F.col("after").rlike("""^["']"""),
        "word_before_known": last.isin(known), "issued": value.rlike(PREFIXED),
    }
    return found.withColumns({
        "length": length, "class_changes": F.regexp_count(value, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+")) - 1,
        "digit_share": F.regexp_count(value, F.lit("[0-9]")) / length,
        "upper_share": F.regexp_count(value, F.lit("[A-Z]")) / length,
        "distinct_share": F.size(F.array_distinct(F.split(value, ""))) / length,
        "dictionary_share": F.char_length(F.array_join(runs, "")) / length,
        "slashes": F.regexp_count(value, F.lit("/")), **{k: v.cast("int") for k, v in flags.items()},
    })


def certain() -> Column:
    """Prefixed keys wherever they stand, and other issued forms assigned to a telling name."""
    return F.col("value").rlike(f"^{PREFIXED}$") | (
        F.col("value").rlike(ISSUED) & (F.col("named") == 1) & (F.col("assigned") == 1)
    )


def weak_label(rows: DataFrame) -> DataFrame:
    """``is_secret`` of findings that need no judgement: 1.0 for what is ``certain``; 0.0 for bare numbers, dictionary
    text and unassigned values of few different characters. Others are left out."""
    false = (F.col("digit_share") == 1) | (F.col("dictionary_share") > 0.5) | (
        (F.col("assigned") == 0) & ((F.col("distinct_share") < 0.2) | (F.col("slashes") > 2))
    )
    return rows.withColumn("is_secret", F.when(certain(), 1.0).when(false, 0.0)).filter("is_secret IS NOT NULL")


def assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows)


def fit_forest(labelled: DataFrame, limit: int = TRAINING_FINDINGS) -> RandomForestClassificationModel | None:
    """A forest from labelled findings (the features and ``is_secret``), at most ``limit`` of each kind; None unless
    both kinds occur."""
    bounded = [
        labelled.filter(F.col("is_secret") == kind).orderBy(F.xxhash64("doc_id", "start", "value")).limit(limit)
        for kind in (0.0, 1.0)
    ]
    rows = materialize(bounded[0].unionByName(bounded[1]).select(*FEATURES, "is_secret"), "findings")
    if rows.select("is_secret").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="is_secret", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
        probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction",
    )
    return forest.fit(assembled(rows))


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per candidate of a text: doc_id, start, length, value, probability and is_secret.

    Candidates come from the whole text by pattern. A random forest on the value's length, character classes and
    dictionary words, on the document's source and on the words around it gives the probability that it is a secret.
    The forest is fitted on ``labelled`` findings, by default on those candidates of the same documents that a strict
    rule decides; if these are all of one kind, only what the rule calls a secret is one. By default keys of an
    unmistakable prefix are secrets whatever the forest says.

    ``start`` counts code points from 0. Null and empty texts have no candidates; null doc_ids are kept; repeated rows
    repeat their findings. Documents without a column ``source`` share one place. Other columns are ignored, and no
    text is shuffled.
    """
    known = dictionary(docs)
    rows = materialize(with_features(findings(docs), known), "candidates")
    forest = fit_forest(weak_label(rows) if labelled is None else labelled)
    if forest is None:
        scored = rows.withColumn("probability", certain().cast("double"))
    else:
        scored = forest.transform(assembled(rows)).withColumn("probability", vector_to_array("_probability")[1])
    if labelled is None:  # a few prefixed keys among many other labels do not move a forest
        scored = scored.withColumn(
            "probability", F.when(F.col("value").rlike(f"^{PREFIXED}$"), 1.0).otherwise(F.col("probability"))
        )
    return scored.select(
        "doc_id", "start", F.col("length").cast("bigint").alias("length"), "value", "probability",
        (F.col("probability") >= threshold).alias("is_secret"),
    )


def redact(docs: DataFrame, found: DataFrame, mask: str = MASK) -> DataFrame:
    """The rows of ``docs`` with every secret of the document replaced in ``text``; n_chars follows where it exists.

    Only texts that hold a candidate are joined with the findings; all others pass as they are. Documents without an id
    share their findings, so each loses the secrets of all of them.
    """
    columns = docs.columns
    values = found.filter("is_secret").groupBy(F.col("doc_id").alias("_id")).agg(
        F.array_sort(F.collect_set("value"), lambda a, b: F.char_length(b) - F.char_length(a)).alias("_values")
    )
    candidate = F.coalesce(F.col("text").rlike(CANDIDATE), F.lit(False))
    joined = docs.filter(candidate).join(values, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    hidden = F.aggregate(
        F.coalesce("_values", F.array().cast("array<string>")), F.col("text"),
        lambda text, value: F.replace(text, value, F.lit(mask)),
    )
    changed = {"text": hidden}
    if "n_chars" in columns:
        changed["n_chars"] = F.when(F.col("_values").isNotNull(), F.char_length(hidden)).otherwise(F.col("n_chars")).cast(
            docs.schema["n_chars"].dataType
        )
    return docs.filter(~candidate).unionByName(joined.withColumns(changed).select(*columns))
