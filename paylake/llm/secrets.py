"""Secret scan: candidates by a broad pattern, false positives removed by a random forest.

A candidate is a long run of characters that keys and tokens are made of, or what a name
like "token" is given: after ``=`` or ``:``, in quotes or to the next blank, of any length and
characters.  In runs, ``=`` only stands at the end.  The forest
judges it by its length, character transitions, how much of it dictionary words cover,
paths and the words next to it.  It learns from labelled findings: those given by the
caller, or those on which two strict rules agree (an assignment to a name like "token" of
something with digits is a secret; a run of letters only, a path or a plain number
is none).  Each labelled finding is learnt from twice, the second time without its
neighbours, so that a secret is known by its looks, too.

The sample learnt from is bounded: ``SAMPLE`` findings of either label, chosen by hash.
The dictionary is a table of the words that make up at least ``FREQUENT`` of all words of
all texts outside candidates, and that a candidate's letter pieces are joined to.  Everything
else covers all rows.

Defined cases: a NULL text has no candidates.  Rows alike in id and text get the same
result.  If findings of one label are missing, the strict rule alone decides.  Empty
tables give no rows.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import kept, row_key, scratch, stored, unused
from paylake.llm.matches import found

LEAST_LENGTH = 16
RUN = f"[A-Za-z0-9+/_-]{{{LEAST_LENGTH},}}+(?:={{1,2}}+(?![A-Za-z0-9+/_=-]))?"
# Characters of context on either side.
CONTEXT = 40

NAMED = r"(?i)(?:token|secret|passw(?:or)?d|pwd|credentials?|api[_-]?key|access[_-]?key|private[_-]?key)"
ASSIGNED = NAMED + r"""["']?\s*[:=]+\s*["']?$"""
# A name that ends in one of NAMED, tried only where a name begins, and what it is given.
TO = rf"""[A-Za-z0-9_-]*(?:{NAMED})["']?\s*+[:=]++\s*+"""
GIVEN = rf"""(?<![A-Za-z0-9_-]){TO}(?:"[^"\n]++(?=")|'[^'\n]++(?=')|["']?[^\s"']\S*+)"""
CANDIDATE = f"(?:{GIVEN}|{RUN})"

SAMPLE = 4000
# Words of at least this part of all words, and at least twice, make the dictionary.
FREQUENT = 1e-6
WORD = r"\p{L}{3,}+"
# Pieces of an identifier: configurationManager, HTTPServer.
PIECE = "[A-Z]?[a-z]{2,}+|[A-Z]{3,}+(?![a-z])|[A-Z]{2,}(?=[A-Z][a-z])"
TREES, DEPTH, SEED = 20, 6, 7
THRESHOLD = 0.5
MASK = "[secret]"

LOOKS = (
    "length", "digits", "upper", "marks", "transitions", "vowel_steps", "variety", "hex", "covered", "path",
)
NEIGHBOURS = ("named", "assigned", "quoted", "words_near")


def _name(match: Column) -> Column:
    """What of a match of CANDIDATE comes before the candidate itself."""
    return F.regexp_extract(match, rf"""^{TO}["']?(?=[^"'])""", 0)


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate: ``key, place, start, end, value, before, after``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(row_key().alias("key"), text.alias("text")).where(F.col("text").rlike(CANDIDATE))
    def piece(m: Column) -> Column:
        name = _name(m["value"])
        before = F.concat(m["before"], name)
        return F.struct(
            (m["start"] + F.length(name)).alias("start"), m["end"].alias("end"),
            F.substring(m["value"], F.length(name) + 1, F.length(m["value"])).alias("value"),
            F.substring(before, F.greatest(F.length(before) - CONTEXT + 1, F.lit(1)), F.lit(CONTEXT)).alias("before"),
            F.substring(m["after"], 1, CONTEXT).alias("after"),
        )

    cut = F.transform(found(F.col("text"), CANDIDATE), piece)
    return rows.select("key", F.posexplode(cut).alias("place", "m")).select("key", "place", "m.*")


def dictionary(docs: DataFrame) -> DataFrame:
    """The frequent words of all texts outside candidates, in lower case: ``word``."""
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), CANDIDATE, " ")
    counted = stored(
        docs.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))).alias("word"))
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words",
    )
    least = max((counted.agg(F.sum("n")).first()[0] or 0) * FREQUENT, 2)
    return stored(counted.where(F.col("n") >= least).select("word"), "dictionary")


def with_coverage(rows: DataFrame, words: DataFrame) -> DataFrame:
    """Adds ``known_letters``: how many letters of a candidate are in pieces that are words."""
    pieces = rows.dropDuplicates(["key", "place"]).select(
        "key", "place", F.explode(F.regexp_extract_all("value", F.lit(PIECE), F.lit(0))).alias("piece")
    ).select("key", "place", F.lower("piece").alias("word"))
    covered = (
        pieces.groupBy("key", "place", "word").agg(F.count(F.lit(1)).alias("n")).join(words, "word")
        .groupBy("key", "place").agg(F.sum(F.col("n") * F.length("word")).alias("known_letters"))
    )
    return rows.join(covered, ["key", "place"], "left").withColumn("known_letters", F.coalesce("known_letters", F.lit(0)))


def with_features(rows: DataFrame) -> DataFrame:
    """Adds the columns LOOKS and NEIGHBOURS to rows of :func:`with_coverage`."""
    value, low = F.col("value"), F.lower("value")
    length = F.length(value).cast("double")

    def share(pattern: str, of: Column = value) -> Column:
        return F.regexp_count(of, F.lit(pattern)) / length

    features = {
        "length": F.least(F.log(length), F.lit(7.0)),
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "marks": share("[+/_=-]"),
        "transitions": (
            F.regexp_count(value, F.lit("(?<=[A-Za-z])[0-9]")) + F.regexp_count(value, F.lit("(?<=[0-9])[A-Za-z]"))
            + F.regexp_count(value, F.lit("(?<=[a-z])[A-Z]"))
        ) / length,
        "vowel_steps": share("(?<=[aeiou])[bcdfghjklmnpqrstvwxyz]", low),
        "variety": F.size(F.array_distinct(F.split(value, ""))) / F.least(length, F.lit(64.0)),
        "hex": value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "covered": F.col("known_letters") / length,
        "path": (value.rlike("[A-Za-z]/[A-Za-z]") | F.col("before").rlike(r"[/.\\]$")).cast("double"),
        "named": F.col("before").rlike(NAMED).cast("double"),
        "assigned": F.col("before").rlike(r"""[:=]\s*["']?$""").cast("double"),
        "quoted": (F.col("before").rlike("""["']$""") & F.col("after").rlike("""^["']""")).cast("double"),
        "words_near": F.regexp_count(F.concat_ws(" ", "before", "after"), F.lit(r"\p{L}{3,}")).cast("double"),
    }
    return rows.select("*", *[column.cast("double").alias(name) for name, column in features.items()])


def strict_label(value: Column, before: Column) -> Column:
    """1 or 0 where the strict rules are sure, otherwise NULL."""
    return (
        F.when(before.rlike(ASSIGNED) & value.rlike("[0-9]"), 1)
        .when(value.rlike("^[A-Za-z]+$|^[0-9]+$|[A-Za-z]{2}/[A-Za-z]{2}|^[=_+/-]+$"), 0)
    )


def train(labelled: DataFrame):
    """The forest learnt from rows with features and ``label``, or None if a label is missing."""
    order = F.xxhash64("key", "place")
    one = labelled.where("label IS NOT NULL")
    picked = stored(one.where("label = 1").orderBy(order, "value").limit(SAMPLE).unionByName(
        one.where("label = 0").orderBy(order, "value").limit(SAMPLE)
    ).select("label", *LOOKS, *NEIGHBOURS), "findings")
    if picked.select("label").distinct().count() < 2:
        return None
    blind = picked.select("label", *LOOKS, *[F.lit(-1.0).alias(name) for name in NEIGHBOURS])
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
        probabilityCol="probability",
    )
    assembled = VectorAssembler(inputCols=[*LOOKS, *NEIGHBOURS], outputCol="features")
    return Pipeline(stages=[assembled, forest]).fit(picked.unionByName(blind))


def scan(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """One row per candidate: ``key, place, start, end, value, score, is_secret``.

    ``findings`` has ``doc_id, start, label`` (1: a secret) and replaces the strict rules.
    """
    rows = stored(candidates(docs), "candidates")
    described = stored(with_features(with_coverage(rows, dictionary(docs))), "features")
    strict = strict_label(F.col("value"), F.col("before"))
    if findings is None:
        labelled = described.withColumn("label", strict)
    else:
        given = findings.select(F.col("doc_id").alias("g_id"), F.col("start").alias("g_start"), "label")
        labelled = described.join(
            given, F.col("key.id").eqNullSafe(F.col("g_id")) & (F.col("start") == F.col("g_start"))
        )
    model = train(labelled)
    if model is None:
        score = F.coalesce(strict, F.lit(0)).cast("double")
        scored = described.withColumn("score", score)
    else:
        scored = model.transform(described).withColumn("score", vector_to_array("probability")[1])
    return scored.select(
        "key", "place", "start", "end", "value", "score", (F.col("score") >= THRESHOLD).alias("is_secret")
    )


def secrets(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """Per document: ``doc_id, n_candidates, n_secrets, spans`` (start:end of secrets, in order)."""
    judged = scan(docs, findings).dropDuplicates(["key", "place"])
    of_docs = judged.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_candidates"),
        F.array_sort(F.collect_list(F.when(F.col("is_secret"), F.struct("start", "end")))).alias("at"),
    )
    spans = F.array_join(F.transform("at", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return (
        docs.select("doc_id", row_key().alias("key")).join(of_docs, "key", "left")
        .select(
            "doc_id", F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"),
            F.coalesce(F.size("at"), F.lit(0)).cast("long").alias("n_secrets"),
            F.coalesce(spans, F.lit("")).alias("spans"),
        )
    )


def masked(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """The documents with each secret replaced by MASK; ``n_chars``, if there, is brought up to date."""
    key, places = unused("secret_key", docs.columns), unused("secret_places", docs.columns)
    with scratch(docs.sparkSession):
        changed = kept(
            scan(docs, findings).where("is_secret").groupBy("key").agg(F.array_sort(F.collect_set("place")).alias(places)),
            "secret-places",
        ).withColumnRenamed("key", key)
    text, at = F.col("text"), F.col(places)
    values = F.transform(found(text, CANDIDATE), lambda m, i: F.concat(
        m["before"], F.when(F.array_contains(at, i), F.concat(_name(m["value"]), F.lit(MASK))).otherwise(m["value"])
    ))
    rest = F.element_at(F.split(text, CANDIDATE, -1), -1)
    joined = docs.withColumn(key, row_key()).join(changed, key, "left")
    out = joined.withColumn("text", F.when(at.isNull(), text).otherwise(F.concat(F.array_join(values, ""), rest)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(at.isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(
            docs.schema["n_chars"].dataType
        ))
    return out.select(*docs.columns)
