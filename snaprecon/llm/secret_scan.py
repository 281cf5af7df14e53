"""Secret scan with a random forest that removes false positives.

Candidates are runs of 16 and more letters, digits and + / _ -, with the parts
that dots join to them and = as padding; after a name and a sign of assignment
also shorter values: 8 and more characters with a digit, 4 and more after a
name that says key, token, password and the like, and there also after the
word "is" if they hold a digit. Between quotes such a value may hold any
character but blanks and quotes. Names and the blanks around a sign may be of any length. The
name and the sign belong to the neighbouring text, not to the candidate. Each
candidate is described by its length, its changes between character classes,
its shares of digits and distinct characters, the share that words of the
corpus's own dictionary cover, its document's path (source) and the words
beside it, beyond the name and the sign. The forest is trained on labelled
findings and scores every candidate. Where the labels are made by a rule over
the name and the sign, the forest sees neither, so it cannot learn the rule back.

Only DataFrame and ML expressions: a text is split at its candidates, so the
parts between them are the neighbouring words without a second search. The
dictionary (lower-case letter runs that at least ``MIN_DOCS`` documents hold)
is counted over all documents and joined to the candidates' letter runs.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaprecon.llm._common import cut

KEY_NAMES = "(?i:api|token|secret|passw|pwd|auth|bearer|credential|private|access|key)"
_RUN = "[A-Za-z0-9+/_-]"
_NAME = "[A-Za-z0-9_-]"
_SIGN = "[\"']?+[ \\t]*+(?:={1,2}>?|:=?)[ \\t]*+[\"']?+"
_QUOTED = "[^\"'\\s]"
_DIGIT = rf"(?=(?<=[\"']){_QUOTED}*?[0-9]|[A-Za-z+/_.-]*+[0-9])"


def _value(least: int) -> str:
    """Look ahead: a value of ``least`` characters or more, between quotes or as a run."""
    return rf"(?=(?<=[\"']){_QUOTED}{{{least},}}+[\"']|{_RUN}[A-Za-z0-9+/_.-]{{{least - 1}}})"


#: the name and sign before a value (a key's name, or any), or the start of a bare run: group 1; then the value itself
CANDIDATE = (
    rf"((?<!{_NAME})(?={_NAME}++[\"']?+[ \t]*+[=:iI])(?:"
    rf"(?={_NAME}*?{KEY_NAMES}){_NAME}++(?:{_SIGN}(?!{_NAME}*?{KEY_NAMES}{_NAME}*+{_SIGN}{_RUN}){_value(4)}|[ \t]++(?i:is)[ \t]++[\"']?+{_DIGIT}{_value(4)})"
    rf"|{_NAME}++{_SIGN}(?!{_NAME}*?{KEY_NAMES}{_NAME}*+{_SIGN}{_RUN}){_DIGIT}{_value(8)})"
    rf"|(?<!{_RUN})(?<!{_RUN}\.)(?=(?:{_RUN}{{1,15}}+\.)*+{_RUN}{{16}}))"
    rf"(?:(?<=[\"']){_QUOTED}{{4,}}+(?=[\"'])|{_RUN}++(?:\.{_RUN}++)*+(?:={{1,2}}(?![A-Za-z0-9+/_=-]))?+)"
)
RUN = "[a-z]{3,}"
MIN_DOCS = 5
TRAIN_ROWS = 20_000
#: what the rule of ``seed_labels`` looks at
RULED = ["assigned", "quoted", "named"]
HASHED = ["path", "word_before", "word_after"]
CELLS = 32
FEATURES = ["length", "changes", "digits", "uppers", "distinct", "hex", "covered", "path", "assigned", "quoted", "named", "word_before", "word_after"]


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate: doc_id, ordinal (in the text), candidate, before, after, source, sign.

    ``before`` and ``after`` are the text beside it, as far as the next
    candidate and to the far end of the nearest word; ``sign`` is the name and
    the sign of assignment before it (empty: none), with which ``before`` ends.
    Where only a sign lies between two candidates, the first is the second's
    name. Null and empty texts have none.
    """
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), source.alias("source"))
    every = lambda group: F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(group))
    found = rows.filter(F.col("text").rlike(CANDIDATE)).select("doc_id", "source", every(0).alias("whole"), every(1).alias("sign"), F.split("text", CANDIDATE, -1).alias("parts"))
    near = r"^\P{L}*+\p{L}*+\P{L}?+"
    each = found.select("doc_id", "source", F.posexplode(F.transform("whole", lambda w, k: F.struct(
        F.substring(w, F.length(F.get("sign", k)) + 1, F.length(w)).alias("candidate"),
        F.reverse(F.regexp_extract(F.reverse(F.get("parts", k)), near, 0)).alias("gap"),
        F.when((k > 0) & (F.get("sign", k) == "") & F.get("parts", k).rlike(f"^{_SIGN}$"), F.concat(F.get("whole", k - 1), F.get("parts", k))).alias("chained"),
        F.get("sign", k).alias("sign"),
        F.concat(F.regexp_extract(F.get("parts", k + 1), near, 0), F.coalesce(F.get("sign", k + 1), F.lit(""))).alias("after"),
    ))).alias("ordinal", "c"))
    return each.select("doc_id", "source", "ordinal", F.col("c.candidate").alias("candidate"), F.coalesce("c.chained", F.concat("c.gap", "c.sign")).alias("before"), F.col("c.after").alias("after"), F.coalesce("c.chained", "c.sign").alias("sign"))


def dictionary(docs: DataFrame, least: int = MIN_DOCS) -> DataFrame:
    """Words (lower-case letter runs of three and more) that ``least`` documents or more hold, over all documents."""
    text = F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), CANDIDATE, "$1 ")
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(RUN), F.lit(0)))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).select("word")


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """The candidates with their features, each a double."""
    c, size = F.col("candidate"), F.length("candidate").cast("double")
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / size
    beyond = F.substring("before", F.lit(1), F.length("before") - F.length("sign"))
    last = F.regexp_extract(beyond, r"(\p{L}++)\P{L}*+$", 1)
    name = F.regexp_extract("before", rf"({_NAME}++)[^A-Za-z0-9_-]*+$", 1)
    first = F.regexp_extract("after", r"^\P{L}*(\p{L}+)", 1)
    runs = found.select("candidate").distinct().select("candidate", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("candidate"), F.lit(RUN), F.lit(0)))).alias("word"))
    covered = runs.join(words, "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("letters"))
    return found.join(covered, "candidate", "left").select(
        "doc_id", "source", "ordinal", "candidate", "before", "after",
        size.alias("length"),
        (F.regexp_count(c, F.lit("[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])|[^A-Za-z0-9](?=[A-Za-z0-9])")) / size).alias("changes"),
        share("[0-9]").alias("digits"), share("[A-Z]").alias("uppers"),
        (F.size(F.array_distinct(F.split(c, ""))) / size).alias("distinct"),
        share("[0-9a-fA-F]").alias("hex"),
        F.least(F.lit(1.0), F.coalesce(F.col("letters"), F.lit(0)) / size).alias("covered"),
        F.pmod(F.xxhash64("source"), F.lit(CELLS)).cast("double").alias("path"),
        (F.col("sign") != "").cast("double").alias("assigned"),
        F.col("before").rlike("[\"']$").cast("double").alias("quoted"),
        name.rlike(KEY_NAMES).cast("double").alias("named"),
        F.pmod(F.xxhash64(F.lower(last)), F.lit(CELLS)).cast("double").alias("word_before"),
        F.pmod(F.xxhash64(F.lower(first)), F.lit(CELLS)).cast("double").alias("word_after"),
    )


def seed_labels(found: DataFrame) -> DataFrame:
    """Labelled findings where nobody has reviewed any: doc_id, ordinal, secret.

    1 for a value assigned to a name that says key, token, password and the
    like, in quotes or right after =, and mixing letters with digits; 0 for a
    candidate that is not assigned to such a name and has no digits, no
    letters or no sign of assignment before it; the rest stays unlabelled.
    """
    mixed = F.col("candidate").rlike("[0-9]") & F.col("candidate").rlike("[A-Za-z]")
    key = KEY_NAMES + "[\\w-]*\\s*[\"']?\\s*"
    sign = F.col("before").rlike(key + "([=:]\\s*[\"']|=)$")
    assigned = F.col("before").rlike(key + "[=:]\\s*[\"']?$")
    label = F.when(mixed & sign, 1).when(assigned, None).when(~mixed | ~F.col("before").rlike("[=:]\\s*[\"']?$"), 0)
    return found.select("doc_id", "ordinal", label.alias("secret")).filter("secret is not null")


def _vectors(rows: DataFrame, features: list[str]) -> DataFrame:
    """``rows`` with the vector ``features``; hashed columns are marked as categories, which have no order."""
    nominal = {"ml_attr": {"type": "nominal", "num_vals": CELLS}}
    return VectorAssembler(inputCols=features, outputCol="features").transform(rows.withColumns({c: F.coalesce(c, F.lit(0.0)).alias(c, metadata=nominal) for c in HASHED}))


def train(featured: DataFrame, labels: DataFrame, features: list[str] = FEATURES, trees: int = 24, depth: int = 6, bound: int = TRAIN_ROWS):
    """A forest over ``features`` fitted on at most ``bound`` labelled findings of each class (smallest hash first); none without both classes."""
    marked = featured.join(labels.select("doc_id", "ordinal", F.col("secret").cast("double").alias("label")).filter("label in (0, 1)").dropDuplicates(["doc_id", "ordinal"]), ["doc_id", "ordinal"])
    order = [F.xxhash64("doc_id", "ordinal", "candidate"), F.col("doc_id"), F.col("ordinal")]
    rows = None
    for k in (0.0, 1.0):
        part = marked.filter(F.col("label") == k).orderBy(*order).limit(bound)
        rows = part if rows is None else rows.unionByName(part)
    rows = _vectors(cut(rows.select("label", *FEATURES)), features).select("label", "features")
    classes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(classes) < 2:
        return None, (1.0 if 1.0 in classes else 0.0)
    even = rows.withColumn("weight", F.when(F.col("label") == 1, 1.0 / classes[1.0]).otherwise(1.0 / classes[0.0]) * F.lit(float(min(classes.values()))))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=CELLS, seed=11, featureSubsetStrategy="sqrt", weightCol="weight")
    # a copy carries no training summary, whose session cannot be sent to tasks once a query has been observed
    return forest.fit(even).copy(), None


def secret_scan(docs: DataFrame, labels: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """One row per candidate: doc_id, ordinal, length, the features, probability, secret, and the candidate's SHA-256.

    ``labels`` are findings (doc_id, ordinal, secret); without them
    :func:`seed_labels` makes them, and the forest does without the features
    that its rule looks at (``RULED``). If they hold one class only, every
    candidate has that class; with none, 0. Repeated rows give their
    candidates each; null ids are scanned but train nothing; other columns do
    not matter, ``source`` may be missing. An empty table gives no rows.
    """
    found = cut(candidates(docs))
    featured = cut(described(found, dictionary(docs)))
    features = [f for f in FEATURES if labels is not None or f not in RULED]
    model, sole = train(featured, seed_labels(found) if labels is None else labels, features)
    if model is None:
        scored = featured.withColumn("probability", F.lit(float(sole)))
    else:
        scored = model.transform(_vectors(featured, features))
        scored = scored.withColumn("probability", F.round(vector_to_array("probability").getItem(1), 6))
    return scored.select("doc_id", "ordinal", *[F.round(f, 6).alias(f) for f in FEATURES], "probability", (F.col("probability") >= threshold).alias("secret"), F.sha2("candidate", 256).alias("candidate_sha256"))
