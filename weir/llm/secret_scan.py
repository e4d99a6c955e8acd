"""Secret scan: candidate strings, filtered by a random forest. SQL only.

A candidate is a run of at least 12 token characters with a digit or a known
key's prefix, or whatever is quoted or assigned after a secret's name. Its features are
its length, how often its characters change class, its shares of digits,
capitals and distinct characters, how much of it dictionary words cover, whether
it stands in a path, host or address, and what the words and signs around it say.
The forest is trained on labelled findings: a bounded sample (`TRAIN_ROWS`) of
the corpus' own candidates, as many of each label, labelled by formats that leave
little doubt (`certain_label`), unless the caller brings labels. It then judges
the candidates that no format decides; a label stands.

Dictionary words are those of all documents, counted once per document. Texts are
scanned for candidates once; candidates and features are written narrow, and
training and scoring read them there. Every place of a string is a finding of its own,
judged by its own context; a string is redacted if any of its places is a secret.

Defined cases: a null or empty text has no finding; a null doc_id is kept and
its rows' findings are returned; repeated rows give repeated findings; an empty
table gives an empty result; where the corpus has no finding of one of the two
labels, the labelling formats decide alone.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from weir.session import scratch_path

TRAIN_ROWS = 20_000  # labelled findings the forest is fitted on, at most: half of them of each label
WORD_SHARE = 1e-4  # a dictionary word is in more than one document and in at least this share of them
TREES, DEPTH = 20, 8
THRESHOLD = 0.5
REDACTED = "[SECRET]"
# at least 12 token characters with a digit or a known key's prefix, at the start of a run of them
PREFIX = r"AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|[sr]k_live_|xox[abprs]-|AIza"
RUN = rf"(?:(?=[A-Za-z_+/-]*[0-9])|(?={PREFIX}))(?=[A-Za-z0-9_+/-]{{12}})%s[A-Za-z0-9_+/-]+={{0,2}}"
CANDIDATE = r"(?<![A-Za-z0-9_+/-])" + RUN
NAMES = r"(?i:token(?!i[sz])|secret(?!ar)|passw|pwd|api.?key|access.?key|private.?key|auth(?!ors?\b)|credential|bearer)"
AFTER_NAME = rf"(?<={NAMES}\w{{0,16}}\W{{1,4}})"
# what stands after a secret's name, of any signs: up to its closing quote, or
# assigned, up to white space or a quote, less closing signs; or after a scheme
VALUE = (
    rf"(?:(?<=[=:>\"'`]\s{{0,2}}){AFTER_NAME}|(?<=(?i:authorization\W{{1,4}}(?:bearer|basic) )))(?!(?i:bearer|basic)\s)%s(?:"
    + "|".join(rf"(?<=\W{q})[^{q}\\\r\n]++(?:\\.[^{q}\\\r\n]*+){{0,50}}+(?={q})" for q in "\"'`")
    + r"|(?<=[=:]>?\s{0,2}[\"'`]?|[bB]earer |[bB]asic )(?![=:>])[^\s\"'`]*[^\s\"'`,;.)\]}])")
AROUND = 32  # characters of context on either side
BEFORE = rf"(?<=(^.{{0,{AROUND - 1}}}|.{{{AROUND}}}))"  # goes where a pattern has its %s: group 1
AFTER = rf"(?=(.{{0,{AROUND}}}))"  # ends a pattern: group 2
WORD = r"(?<![\p{L}\p{N}_])\p{L}++(?![\p{L}\p{N}_])"  # in lower-cased text, of any script
PART = WORD + r"|\p{L}{4,}"
KEYWORDS = NAMES + r"\w*\W{0,4}(?:(?i:basic) )?$"
FEATURES = ["length", "transitions", "digits", "capitals", "distinct", "hex", "covered", "in_path",
            "keyword", "assigned", "quoted", "digits_only", "grouped"]


def dictionary(docs: DataFrame) -> DataFrame:
    """`w`: the words of all documents that are in enough of them (`WORD_SHARE`)."""
    texts = docs.select(F.lower(F.col("text").cast("string")).alias("t"))
    least = max(2, math.ceil(WORD_SHARE * texts.count()))
    words = texts.select(F.explode(F.array_distinct(F.regexp_extract_all("t", F.lit(WORD), F.lit(0)))).alias("w"))
    return words.groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("w")


def with_covered(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds `covered`: the share of a candidate's characters that are dictionary
    words. `found` has one `id` a row; rows without letters are not joined."""
    parts = found.select("id", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit(PART), F.lit(0))).alias("w"))
    letters = parts.join(words, "w").groupBy(F.col("id").alias("of")).agg(F.sum(F.length("w")).alias("letters"))
    return found.join(letters, F.col("id") == F.col("of"), "left").drop("of").withColumn(
        "covered", F.coalesce(F.col("letters"), F.lit(0)) / F.length("candidate")).drop("letters", "id")


def findings(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, candidate, start (characters before it), times (its
    places in the text), before, after: one row per place of a candidate."""
    text = F.col("text").cast("string")

    def places(kind: int, pattern: str) -> Column:
        """Every match of a pattern, with what stands between it and the one before."""
        take = [F.regexp_extract_all("t", F.lit(pattern), F.lit(k)) for k in range(3)]
        gaps = F.transform(F.split("t", pattern, -1), lambda g: F.length(g).cast("long"))
        zipped = F.arrays_zip(*[x.alias(n) for x, n in zip([*take, gaps], ("candidate", "before", "after", "gap"))])
        return F.transform(zipped, lambda f, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("pos"), f["candidate"].alias("candidate"), f["before"].alias("before"),
            f["after"].alias("after"), f["gap"].alias("gap")))

    patterns = ["(?s)" + x % BEFORE + AFTER for x in (CANDIDATE, VALUE)]
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("t")).where(
        F.col("t").rlike(patterns[0]) | F.col("t").rlike(patterns[1]))
    # ids come before the places are exploded, so that a text's places share one
    rows = found.select("doc_id", F.xxhash64("t").alias("text_hash"), F.monotonically_increasing_id().alias("row"),
                        F.concat(*[places(k, x) for k, x in enumerate(patterns)]).alias("places"))
    each = rows.select("doc_id", "text_hash", "row", F.explode("places").alias("f")).select("doc_id", "text_hash", "row", "f.*").where(
        "candidate is not null").repartition("row")
    n = F.length("candidate").cast("long")
    upto = Window.partitionBy("row", "kind").orderBy("pos")
    placed = each.withColumn("start", F.sum(F.col("gap") + n).over(upto) - n)
    # a value that is a run is among the runs already
    return placed.where((F.col("kind") == 0) | ~F.col("candidate").rlike(f"^(?:{RUN % ''})$")).select(
        "doc_id", "text_hash", "candidate", "start", F.count("*").over(Window.partitionBy("row", "candidate")).alias("times"), "before", "after")


def with_features(found: DataFrame) -> DataFrame:
    """Adds one double column per feature but `covered`, from the finding alone."""
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    n = F.length(c).cast("double")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "9")
    changes = F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1
    flag = lambda x: x.cast("double")
    return found.withColumns({
        "length": n,
        "transitions": changes / n,
        "digits": F.length(F.regexp_replace(c, "[^0-9]", "")) / n,
        "capitals": F.length(F.regexp_replace(c, "[^A-Z]", "")) / n,
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "hex": flag(c.rlike("^[0-9a-f]+$")),
        "in_path": flag(before.rlike(r"([./@:\\]|://\S*)$") | after.rlike(r"^[./@\\]\w") | c.contains("/")),
        "keyword": flag(before.rlike(KEYWORDS)),
        "assigned": flag(before.rlike(r"[=:]>?\s{0,2}(?:(?i:bearer|basic) )?[\"'`]?$")),
        "quoted": flag(before.rlike(r"[\"'`]$") & after.rlike(r"^[\"'`]")),
        "digits_only": flag(c.rlike("^[0-9]+$")),
        "grouped": flag(before.rlike(r"[0-9] ?$") | after.rlike(r"^ ?[0-9]")),
    })


def certain_label() -> Column:
    """1.0 or 0.0 where a finding's format leaves little doubt, else null: key
    formats and long mixed strings assigned to a secret's name are secrets;
    plain numbers, strings that dictionary words mostly cover, addresses and one
    sign repeated are not, where no secret's name claims them as its value."""
    c = F.col("candidate")
    run = c.rlike("^[A-Za-z0-9_+/-]+={0,2}$") & c.rlike("[0-9]") & c.rlike("[A-Za-z]")
    named = (F.col("keyword") == 1) & (F.col("assigned") == 1)
    secret = c.rlike("^(AKIA|ASIA)[A-Z2-7]{16}$") | c.rlike("^(gh[pousr]_|sk_live_|xox[abpr]-)[A-Za-z0-9-]{16,}$") | (
        run & named & (F.col("length") >= 16))
    plain = ((F.col("digits_only") == 1) & ~named) | ((F.col("covered") > 0.6) & ~(named & (F.col("quoted") == 1))) | (
        (F.col("in_path") == 1) & (F.col("keyword") == 0)) | c.rlike(r"^(?i)[a-z][a-z0-9+.-]*://[^@]*$") | c.rlike(r"^(.)\1*$")
    return F.when(secret, F.lit(1.0)).when(plain, F.lit(0.0))


def scan(docs: DataFrame, label: Column | None = None) -> DataFrame:
    """doc_id, candidate, start, length, times, probability, is_secret: one row
    per finding. `label`: a column over findings and features, 1.0, 0.0 or null."""
    return _judged(docs, label).drop("text_hash")


def _judged(docs: DataFrame, label: Column | None = None) -> DataFrame:
    """`scan` with the hash of each finding's text."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    places, lexicon, path = (scratch_path(spark, x) for x in ("places", "dictionary", "findings"))
    # written first: ids stand still, and a small dictionary is known to be small
    findings(docs).withColumn("id", F.monotonically_increasing_id()).write.mode("overwrite").parquet(places)
    dictionary(docs).write.mode("overwrite").parquet(lexicon)
    covered = with_covered(spark.read.parquet(places), spark.read.parquet(lexicon))
    with_features(covered).write.mode("overwrite").parquet(path)
    found = spark.read.parquet(path)
    label = certain_label() if label is None else label
    # of each label, distinct findings in the order of a hash: a sample that does not depend on partitions,
    # nor on how rare one label is
    labelled = found.select(*FEATURES, "candidate", label.alias("label")).where("label is not null")
    order = [F.xxhash64("candidate", *FEATURES), "candidate", *FEATURES]
    one, other = (labelled.where(F.col("label") == x).distinct().orderBy(*order).limit(TRAIN_ROWS // 2) for x in (0.0, 1.0))
    drawn_path = scratch_path(spark, "labelled")
    one.unionByName(other).coalesce(1).write.mode("overwrite").parquet(drawn_path)
    drawn = spark.read.parquet(drawn_path)
    counts = {r.label: r.n for r in drawn.groupBy("label").agg(F.count("*").alias("n")).collect()}
    judged = found.withColumn("certain", label)
    if set(counts) == {0.0, 1.0}:
        assembler = VectorAssembler(inputCols=FEATURES, outputCol="vector")
        # both labels weigh alike
        weight = F.when(F.col("label") == 1.0, F.lit(sum(counts.values()) / 2 / counts[1.0])).otherwise(
            F.lit(sum(counts.values()) / 2 / counts[0.0]))
        forest = RandomForestClassifier(
            featuresCol="vector", labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=7,
            rawPredictionCol="raw", probabilityCol="p", predictionCol="predicted")
        model = forest.fit(assembler.transform(drawn).select("vector", "label", weight.alias("weight")))
        # a format that leaves no doubt stands, whatever the forest makes of its context
        judged = model.transform(assembler.transform(judged)).withColumn(
            "probability", F.coalesce("certain", vector_to_array("p")[1]))
    else:
        judged = judged.withColumn("probability", F.coalesce("certain", F.lit(0.0)))
    return judged.select(
        "doc_id", "text_hash", "candidate", "start", F.col("length").cast("long").alias("length"), "times", "probability",
        (F.col("probability") >= THRESHOLD).alias("is_secret"))


def _without(text: Column, secret: Column) -> Column:
    """`text` with the string replaced: a long one wherever it is, one that may
    be part of a word only as a whole word, one of under 4 characters only after
    a secret's name."""
    whole = F.concat(F.lit(r"\Q"), F.replace(secret, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![\p{L}\p{N}])"))
    place = F.when(F.length(secret) < 4, F.lit(AFTER_NAME)).otherwise(F.lit(r"(?<![\p{L}\p{N}])"))
    return F.when(F.length(secret) >= 12, F.replace(text, secret, F.lit(REDACTED))).otherwise(
        F.regexp_replace(text, F.concat(place, whole), F.lit(REDACTED)))


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with every secret's string replaced in its texts; `n_chars`, where
    there is one, follows the text. No document is dropped."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    # by id and text: rows of a null or repeated id have their own secrets, and no group is larger than a text
    secrets = _judged(docs).where("is_secret").groupBy(key.alias("of_doc"), F.col("text_hash").alias("of_text")).agg(
        F.collect_set("candidate").alias("strings"))
    # longest first, so that a secret within another does not break it
    ordered = secrets.select("of_doc", "of_text", F.array_sort(
        "strings", lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1)
        .otherwise(0)).alias("strings"))
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], key.alias("row_doc"),
                       F.xxhash64(F.col("text").cast("string")).alias("row_text"))
    own = (F.col("row_doc") == F.col("of_doc")) & (F.col("row_text") == F.col("of_text"))
    joined = rows.join(ordered, own, "left")
    names = {c: i for i, c in enumerate(docs.columns)}
    text = F.col(f"c{names['text']}")
    clean = F.when(F.col("strings").isNull(), text).otherwise(
        F.aggregate("strings", text, _without))
    out = []
    for name, i in names.items():
        column = F.col(f"c{i}")
        if name == "text":
            column = clean
        elif name == "n_chars":
            column = F.when(F.col("strings").isNull(), column).otherwise(F.length(clean).cast(docs.schema[i].dataType))
        out.append(column.alias(name))
    return joined.select(*out)
