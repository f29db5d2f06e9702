"""Personal data: patterns, and information-theoretic sanitisation of what gives them away.

The base finds e-mail addresses, IP numbers, payment cards and phone numbers.  Each value
found is a protected entity.  How strongly a term reveals an entity is estimated from the
corpus: with P(e | t) the share of the documents with term t that have e, too, the
pointwise mutual information is log2 P(e | t) + IC(e), where IC(e) = -log2 P(e) is the
information of the entity itself.  A term that gives away at least ``DISCLOSED`` of IC(e) of
any entity is a span wherever it occurs, in all documents; one that gives away ``GIVEN_AWAY``
is removed when a text is sanitised, others are replaced by a general word.

Terms are those of whole documents, outside the matches of the base.  Counts are numbers of
documents, of the whole corpus, aggregated before they are shuffled.  As a term of too many
documents cannot give an entity away (see ``_most_with_term``), only the others are paired.

Defined cases: a NULL text is empty.  Rows alike in id and text get the same spans and
count as one document each.  Empty tables give no rows.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import row_key, stored, unused
from paylake.llm.matches import found, let, running

KINDS = ("email", "ip", "card", "phone")

# Possessive forms of the patterns: they match the same and never go back over long runs.
# A start within a run of name characters is only possible right after another match.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"\p{L}{3,}+"

# Terms with at least this part of all (document, term) pairs are looked up in a small table
# instead of a shuffle; for speed only.
FREQUENT = 1 / 50000

DISCLOSED = 0.9
GIVEN_AWAY = 0.97


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        digits = F.regexp_replace(value, r"[\x20-]", "")
        return F.length(digits).between(12, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _matches(text: Column) -> Column:
    """All valid matches, a sorted array of ``start, kind`` (the place in KINDS), ``end, value``."""
    possible = {
        "email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9][\x20-]?[0-9]"), "phone": F.contains(text, F.lit("+")),
    }

    def of(i: int, kind: str) -> Column:
        valid = F.filter(found(text, PATTERNS[kind]), lambda m: _valid(kind, m["value"]))
        rows = F.transform(valid, lambda m: F.struct(
            m["start"].alias("start"), F.lit(i).alias("kind"), m["end"].alias("end"), m["value"].alias("value")
        ))
        return F.coalesce(F.when(possible[kind], rows), F.array())

    return F.array_sort(F.concat(*[of(i, kind) for i, kind in enumerate(KINDS)]))


def _outside(text: Column, matches: Column) -> Column:
    """``text`` with blanks in place of the matches; all other places stay."""

    def with_ends(ends: Column) -> Column:
        def piece(m: Column, i: Column) -> Column:
            before = F.coalesce(F.get(ends, i - 1), F.lit(0))
            gap = F.greatest(m["start"] - before, F.lit(0))
            return F.concat(F.substring(text, before + 1, gap), F.repeat(F.lit(" "), F.get(ends, i) - before - gap))

        rest = F.substring(text, F.get(ends, F.size(ends) - 1) + 1, F.length(text))
        return F.concat(F.array_join(F.transform(matches, piece), ""), rest)

    ends = running(F.transform(matches, lambda m: m["end"]), lambda a, b: F.greatest(a, b))
    return F.when(F.size(matches) == 0, text).otherwise(let(ends, with_ends))


def _read(docs: DataFrame) -> DataFrame:
    """``key``, ``found``: the matches, and ``words``: the text outside of them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(row_key().alias("key"), text.alias("text")).withColumn("found", _matches(F.col("text")))
    return rows.select("key", "found", _outside(F.col("text"), F.col("found")).alias("words"))


def _distinct_terms() -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower("words"), F.lit(TERM), F.lit(0)))


def entities(docs: DataFrame) -> DataFrame:
    """Documents that have some: ``key``, ``found`` and ``terms``, the different terms."""
    return _read(docs).where(F.size("found") > 0).select("key", "found", _distinct_terms().alias("terms"))


def _most_with_term(with_entity: Column, total: int) -> Column:
    """No term of more documents than this gives an entity of ``with_entity`` documents away.

    A share of DISCLOSED needs both / with_term >= (with_entity / total) ** (1 - DISCLOSED), and
    both is with_entity at most.  The last digits are on the safe side.
    """
    return F.pow(with_entity, F.lit(DISCLOSED)) * float(max(total, 1)) ** (1 - DISCLOSED) * 1.000001


def _documents(docs: DataFrame) -> tuple[int, DataFrame]:
    """The number of different documents, and the ``key`` and ``times`` of those given more than once."""
    times = stored(docs.groupBy(row_key().alias("key")).agg(F.count(F.lit(1)).alias("times")), "document-times")
    return times.count(), stored(times.where("times > 1"), "repeated-documents")


def _document_terms(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """All terms: ``term`` and ``with_term``, the number of documents that have it."""
    terms = _read(docs).join(repeated, "key", "left").select(
        F.coalesce("times", F.lit(1)).alias("times"), F.explode(_distinct_terms()).alias("term")
    )
    # A document given k times has each of its terms in k rows.
    return (
        terms.groupBy("term", "times").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("term").agg(F.sum(F.expr("n div times")).alias("with_term"))
    )


def _frequent(of_terms: DataFrame) -> DataFrame:
    least = (of_terms.agg(F.sum("with_term")).first()[0] or 0) * FREQUENT
    return stored(of_terms.where(F.col("with_term") >= least), "frequent-terms")


def _strong(found_rows: DataFrame, of_terms: DataFrame, total: int) -> DataFrame:
    """``term`` and ``share``, the largest one, of the terms that give some entity away."""
    one = found_rows.dropDuplicates(["key"])
    of_keys = one.select("key", F.explode(F.array_distinct(F.transform(
        "found", lambda m: F.concat_ws(":", m["kind"], F.lower(m["value"]))
    ))).alias("entity"))
    of_entities = of_keys.groupBy("entity").agg(F.count(F.lit(1)).alias("with_entity")).where(
        F.col("with_entity") < total
    )
    shown = stored(
        of_keys.join(of_entities, "entity").withColumn("most", _most_with_term(F.col("with_entity"), total)),
        "shown-entities",
    )
    bounds = shown.groupBy("key").agg(F.max("most").alias("most"))
    words = one.select("key", "terms").join(bounds, "key").select("key", "most", F.explode("terms").alias("term"))
    frequent = _frequent(of_terms)
    rest = words.join(frequent, "term", "left_anti").join(of_terms, "term")
    rare = words.join(frequent, "term").unionByName(rest).where(F.col("with_term") <= F.col("most"))
    together = (
        shown.join(rare.drop("most"), "key").where(F.col("with_term") <= F.col("most"))
        .groupBy("entity", "term", "with_entity", "with_term").agg(F.count(F.lit(1)).alias("both"))
    )
    information = F.log2(F.lit(float(total)) / F.col("with_entity"))
    share = 1 + F.log2(F.col("both") / F.col("with_term")) / information
    return together.withColumn("share", share).where(F.col("share") >= DISCLOSED).groupBy("term").agg(
        F.max("share").alias("share")
    )


def revealing(docs: DataFrame, found_rows: DataFrame) -> DataFrame:
    """Spans of terms that give an entity away, in all documents: ``key, start, end, share``."""
    total, repeated = _documents(docs)
    of_terms = stored(_document_terms(docs, repeated), "document-terms")
    strong = stored(_strong(found_rows, of_terms, total), "strong-terms")
    weak = stored(_frequent(of_terms).select("term").join(strong, "term", "left_anti"), "weak-terms")
    places = F.transform(found(F.col("words"), TERM), lambda t: F.struct(
        F.lower(t["value"]).alias("term"), t["start"].alias("start"), t["end"].alias("end")
    ))
    occurring = _read(docs).select("key", F.explode(places).alias("t")).select("key", "t.*")
    return (
        occurring.join(weak, "term", "left_anti").join(strong, "term")
        .groupBy("key", "start", "end").agg(F.max("share").alias("share"))
    )


def _listed(spans: Column, names: tuple[str, ...]) -> Column:
    kinds = F.array(*[F.lit(name) for name in names])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def _spans_of(docs: DataFrame) -> DataFrame:
    """``key``, ``base`` and ``terms``: arrays of ``start, kind, end`` (terms: and ``share``)."""
    rows = stored(entities(docs), "entities")
    extra = revealing(docs, rows).groupBy("key").agg(F.array_sort(F.collect_list(F.struct(
        "start", F.lit(len(KINDS)).alias("kind"), "end", "share"
    ))).alias("terms"))
    base = rows.dropDuplicates(["key"]).select("key", F.transform("found", lambda m: F.struct(
        m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")
    )).alias("base"))
    return base.join(extra, "key", "full")


def personal_data(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term``."""
    none = F.expr("array_remove(array(named_struct('start', 0, 'kind', 0, 'end', 0)), named_struct('start', 0, 'kind', 0, 'end', 0))")
    joined = (
        docs.select("doc_id", row_key().alias("key")).join(_spans_of(docs), "key", "left")
        .withColumn("base", F.coalesce("base", none))
        .withColumn("terms", F.coalesce(F.transform("terms", lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")
        )), none))
    )
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return joined.select(
        "doc_id", *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(_listed(F.col("base"), KINDS), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", "terms")), (*KINDS, "term")).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """The documents with spans replaced: entities by their kind, terms by a general word or by nothing."""
    spans = _spans_of(docs)
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.get(names, s["kind"]).alias("by")))
    terms = F.transform("terms", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"),
        F.when(s["share"] >= GIVEN_AWAY, F.lit("")).otherwise(F.lit("[term]")).alias("by"),
    ))
    key, places = unused("pii_key", docs.columns), unused("pii_spans", docs.columns)
    changes = spans.select(
        F.col("key").alias(key),
        F.array_sort(F.concat(F.coalesce(base, F.array()), F.coalesce(terms, F.array()))).alias(places),
    )

    def replace(state: Column, s: Column) -> Column:
        # A span that begins before the last one ended is part of it.
        fresh = s["start"] >= state["at"]
        return F.struct(
            F.when(fresh, F.concat(state["out"], F.array(
                F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"]), s["by"]
            ))).otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], s["end"]).alias("at"),
        )

    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("at"))
    text = F.aggregate(places, start, replace, lambda st: F.concat(
        F.array_join(st["out"], ""), F.substring(F.col("text"), st["at"] + 1, F.length("text"))
    ))
    return (
        docs.withColumn(key, row_key()).join(changes, key, "left")
        .withColumn("text", F.when(F.col(places).isNull(), F.col("text")).otherwise(text))
        .select(*docs.columns)
    )
