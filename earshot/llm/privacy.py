"""Personal data: patterns, and terms that reveal a protected entity by their co-occurrence with it."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.text import set_aside, spans, whole
from earshot.operators.sizing import broadcast_within, measured, scratch_path, staged

# A match can only begin where a run begins or where the last match ended, so
# each run is read once.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
# A run of fewer than 16 digits is no card; the others match as a whole.
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
KINDS = ("email", "ip", "card", "phone")
TERM = r"(?<![\p{L}\p{N}])\p{L}[\p{L}\p{N}]{2,}"

MIN_TEXTS = 3
"""Fewest distinct texts in which a term accompanies an entity, for a judgement."""
ALPHA = 0.9
"""Share of an entity's information from which a term discloses it."""

SPAN = "struct<kind:string,start:int,end:int,found:string>"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum of card numbers."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda t, i: t + value(i))
    return total % 10 == 0


def _kept(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(rf"^{BYTE}(\.{BYTE}){{3}}$")
    n = F.length(_digits(found))
    if kind == "card":
        return n.between(16, 19) & luhn(_digits(found))
    return n.between(8, 15)


def _of_kind(text: Column, kind: str, pattern: str, sign: str) -> Column:
    """The matches of one kind; ``sign`` is a cheaper pattern that any text with a match has."""
    found = spans(text, pattern)
    if kind != "email":
        found = F.filter(found, lambda x: _kept(kind, x["found"]))
    named = F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["found"].alias("found")))
    return F.when(text.rlike(sign), named).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> Column:
    """All pattern matches, by kind in the order of ``KINDS``, then by start."""
    patterns = (EMAIL, IP, CARD, PHONE)
    signs = ("@", r"[0-9]\.[0-9]", r"[0-9][\x20-]?[0-9]", r"\+[0-9]")
    return F.concat(*[_of_kind(text, *x) for x in zip(KINDS, patterns, signs, strict=True)])


def digest_text(found: Column) -> Column:
    """Spans as kind:start:end, joined by commas in their order."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _terms(text: Column) -> Column:
    """The distinct terms of a text, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(f"({TERM})"), F.lit(1)), F.lower))


def disclosing_terms(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Terms to hide in each text: ``key`` and ``terms``, in lower case.

    Chances are shares of distinct texts, and a term accompanies an entity
    wherever it stands in the same text. A term discloses an entity if their
    pointwise mutual information reaches ``ALPHA`` times the entity's own
    information: then the term alone tells nearly as much as the entity, so it is
    hidden in all texts. ``texts`` has ``key``, ``text`` of all documents,
    ``found`` those with entities and their ``base`` spans.
    """
    spark = texts.sparkSession
    none = texts.select("key", F.array().cast("array<string>").alias("terms")).limit(0)
    total = texts.select("key").distinct().count()
    held = found.select("key", F.explode("base").alias("e")).select("key", F.xxhash64("e.kind", F.lower("e.found")).alias("entity")).distinct()
    held = staged(held, scratch_path(spark, "held"))
    # With fewer texts an entity cannot accompany any term in enough of them.
    texts_of = [F.bit_xor(F.xxhash64("key", F.lit(k))).alias(f"texts_{k}") for k in (1, 2)]
    entities = held.groupBy("entity").agg(F.count("*").alias("n_entity"), *texts_of).where(F.col("n_entity") >= MIN_TEXTS)
    # Entities of the same texts, as in copies of a directory, share all counts; one of them stands for all.
    entities = entities.groupBy("n_entity", "texts_1", "texts_2").agg(F.min("entity").alias("entity"))
    entities, n_entities = measured(entities.select("entity", "n_entity"))
    if not n_entities:
        return none
    held = held.join(broadcast_within(entities, n_entities), "entity")
    per_text = held.groupBy("key").agg(F.collect_list(F.struct("entity", "n_entity")).alias("entities"))

    # A term can only disclose an entity if it is in few enough texts; it is at least in those of its entities.
    def most(both: Column) -> Column:
        return both * F.pow(F.lit(total) / F.col("n_entity"), F.lit(1 - ALPHA)) * (1 + 1e-9)

    # Parts of an entity accompany it in any case; they are no terms.
    outside = F.explode(_terms(replaced(F.col("text"), F.col("base"), blank=True))).alias("term")
    near = found.select("key", "text", "base").join(per_text, "key").select("key", "entities", outside)
    near = staged(near, scratch_path(spark, "near"))
    near_texts = near.groupBy("term").agg(F.count("*").alias("n_near")).where(F.col("n_near") >= MIN_TEXTS)
    near_texts, n_near = measured(near_texts)
    pairs = near.join(broadcast_within(near_texts, n_near), "term").select("term", "n_near", F.inline("entities"))
    pairs = pairs.where(F.col("n_near") <= most(F.col("n_entity")))
    together = pairs.groupBy("entity", "term").agg(F.count("*").alias("both"), F.first("n_near").alias("n_near"), F.first("n_entity").alias("n_entity"))
    together = together.where((F.col("both") >= MIN_TEXTS) & (F.col("n_near") <= most(F.col("both"))))
    together, n_pairs = measured(together.select("entity", "term", "both", "n_entity"))
    if not n_pairs:
        return none

    def said(of: DataFrame, judged: DataFrame) -> DataFrame:
        terms, n_terms = measured(judged.select("term").distinct())
        each = of.select("key", F.explode(_terms(F.col("text"))).alias("term"))
        return each.join(broadcast_within(terms, n_terms), "term", "left_semi").distinct()

    # A term that is in too many texts of a sixteenth is in too many of all; this leaves out only what cannot disclose.
    some = said(texts.where(F.pmod("key", F.lit(16)) == 0), together).groupBy("term").agg(F.count("*").alias("n_some"))
    together = together.join(some, "term", "left").where(F.coalesce("n_some", F.lit(0)) <= most(F.col("both"))).drop("n_some")
    together, _ = measured(together)
    spoken = staged(said(texts, together), scratch_path(spark, "spoken"))
    judged = together.join(spoken.groupBy("term").agg(F.count("*").alias("n_term")), "term")
    information = F.lit(math.log2(max(total, 1))) - F.log2("n_entity")
    mutual = F.log2(F.col("both") * total / (F.col("n_term") * F.col("n_entity")))
    telling = judged.where((information > 0) & (mutual >= ALPHA * information)).select("term").distinct()
    telling, n_telling = measured(telling)
    hidden = spoken.join(broadcast_within(telling, n_telling), "term", "left_semi")
    return hidden.groupBy("key").agg(F.collect_set("term").alias("terms"))


def term_spans(text: Column, terms: Column, base: Column) -> Column:
    """Every occurrence of some terms of a text, as spans, but for those that overlap pattern matches."""
    forms = F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit(f"({TERM})"), F.lit(1))), lambda x: F.array_contains(terms, F.lower(x)))
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join(forms, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    found = F.filter(spans(text, pattern), lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (b["end"] > x["start"])))
    named = F.transform(
        found, lambda x: F.struct(F.lit("term").alias("kind"), x["start"].alias("start"), x["end"].alias("end"), F.lower(x["found"]).alias("found"))
    )
    return F.when(F.size(terms) > 0, named).otherwise(F.array().cast(f"array<{SPAN}>"))


def replaced(text: Column, found: Column, blank: bool = False) -> Column:
    """The text with each span replaced by its kind in brackets, or by a space; overlapping spans become one."""
    ordered = F.array_sort(F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    empty = F.struct(F.lit(0).alias("done"), F.lit("").alias("out"))

    def step(state: Column, x: Column) -> Column:
        gap = F.substring(text, state["done"] + 1, x["start"] - state["done"])
        joined = F.concat(state["out"], gap, F.lit(" ") if blank else F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
        return F.struct(
            F.greatest(state["done"], x["end"]).alias("done"),
            F.when(x["start"] >= state["done"], joined).otherwise(state["out"]).alias("out"),
        )

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substring(text, state["done"] + 1, F.length(text)))

    return F.when(F.size(found) > 0, F.aggregate(ordered, empty, step, finish)).otherwise(text)


def find_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base`` (pattern spans), ``hidden_terms`` (spans of disclosing terms) and ``safe_text``.

    Corpus statistics are over distinct texts. Every occurrence of a
    term that discloses an entity is hidden, also in texts without the entity. A null or empty text has no spans and
    stays empty; repeated rows get equal results; an empty table gives no rows.
    Columns of ``docs`` with the names above are replaced. The statistics are
    computed while the plan is built.
    """
    return set_aside(docs, lambda d: _found(d, text_col), [text_col])


def _found(docs: DataFrame, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.drop("base", "hidden_terms", "safe_text")
    text = whole(text_col)
    texts = docs.select(F.xxhash64(text).alias("key"), text.alias("text"))
    found = texts.withColumn("base", base_spans(F.col("text"))).where(F.size("base") > 0).dropDuplicates(["key"])
    found = staged(found, scratch_path(spark, "entities"))
    hidden, n_hidden = measured(disclosing_terms(texts, found))
    hidden = hidden.withColumnsRenamed({"key": "_hidden_key", "terms": "_hidden_terms"})
    out = docs.withColumns({"_safe": text, "_key": F.xxhash64(text)})
    out = out.withColumn("base", base_spans(F.col("_safe")))
    out = out.join(broadcast_within(hidden, n_hidden, 100_000), out["_key"] == hidden["_hidden_key"], "left")
    out = out.withColumn("hidden_terms", term_spans(F.col("_safe"), F.coalesce("_hidden_terms", F.array().cast("array<string>")), F.col("base")))
    safe = replaced(F.col("_safe"), F.concat("base", "hidden_terms"))
    return out.withColumn("safe_text", safe).drop("_safe", "_key", "_hidden_key", "_hidden_terms")


def hide_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the safe text in place of the text; a null text becomes empty, all other columns stay.

    Repeated rows stay and get equal texts; an empty table gives no rows.
    """

    def hidden(docs: DataFrame) -> DataFrame:
        found = find_personal_data(docs, text_col)
        return found.withColumn(text_col, F.col("safe_text")).select(*docs.columns)

    return set_aside(docs, hidden, [text_col], ("base", "hidden_terms", "safe_text"))


def personal_data_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of each kind, a digest of the base spans, and all spans as text.

    One row for each row of ``found``, repeated ones included; no spans give zeros and empty texts.
    """

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        id_col,
        *[count(kind) for kind in KINDS],
        F.sha2(digest_text(F.col("base")), 256).alias("base_sha256"),
        digest_text(F.concat("base", "hidden_terms")).alias("spans"),
    )
