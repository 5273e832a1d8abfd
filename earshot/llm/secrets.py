"""Secret scans: strong patterns, and weak candidates linked to their complementary parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.text import one_pass, set_aside, spans, whole

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
KINDS = ("assign", "access", "hex")
LINKED = "linked"

_TOKEN = "[A-Za-z0-9+/_=-]"
WEAK = (
    rf"(?<!{_TOKEN})(?={_TOKEN}*?[0-9])(?={_TOKEN}*?[A-Z])(?={_TOKEN}*?[a-z]){_TOKEN}{{20,}}+"
    r"""|\b(?i:pwd|pass|passphrase|auth|private_?key|credentials?)["']?\x20*[:=]\x20*["']?[^\x20\x09-\x0D"',;]{4,}+"""
)
IDENTIFIER = (
    r"AKIA[A-Z0-9]{12,}+"
    r"""|\b(?i:client_?id|access_?key(?:_?id)?|user(?:_?name)?|login|account(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{3,}+"""
)
ENDPOINT = (
    r"""\b(?i:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|ssh)://[^\x20\x09-\x0D"'<>]++"""
    r"""|\b(?i:host|server|endpoint|region)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._-]{3,}+"""
)
SCOPE_BREAK = r"\n[\x20\x09\r]*\n"

SPAN = "struct<start:int,kind:string,end:int,found:string>"
PART = "struct<start:int,end:int,found:string>"
SEEN = "struct<at:int,found:string>"
CREDENTIAL = "struct<start:int,kind:string,end:int,found:string,identifier:string,endpoint:string>"


def _where_any(text: Column, sign: str, found: Column, kind: str) -> Column:
    """``found`` if the cheap pattern ``sign`` occurs at all."""
    return F.when(text.rlike(sign), found).otherwise(F.array().cast(f"array<{kind}>"))


def _named(found: Column, kind: str) -> Column:
    return F.transform(
        found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), x["found"].alias("found"))
    )


def strong_spans(text: Column) -> Column:
    """Matches of the three patterns, by start, then by kind in the order of ``KINDS``."""
    assigned = F.filter(spans(text, ASSIGN, {"value": 2}), lambda x: F.length(x["value"]) >= 6)
    parts = [
        _where_any(text, r"[:=]", _named(assigned, "assign"), SPAN),
        _where_any(text, "AKIA", _named(spans(text, ACCESS), "access"), SPAN),
        _where_any(text, "[0-9a-f]{24}", _named(spans(text, HEX), "hex"), SPAN),
    ]
    return in_order(F.concat(*parts))


def in_order(found: Column) -> Column:
    """Spans by start, then by kind."""

    def place(x: Column) -> Column:
        return F.array_position(F.array(*[F.lit(k) for k in (*KINDS, LINKED)]), x["kind"])

    keyed = F.transform(found, lambda x: F.struct(x["start"].alias("start"), place(x).alias("place"), x.alias("span")))
    return F.transform(F.array_sort(keyed), lambda x: x["span"])


def _events(found: Column, kind: str, at: str, order: int) -> Column:
    """Spans as events of a pass, at their start or end; ``order`` decides between events of one place."""
    fields = [F.lit(order).alias("order"), F.lit(kind).alias("kind")]
    return F.transform(found, lambda x: F.struct(x[at].alias("pos"), *fields, *[x[f].alias(f) for f in ("start", "end", "found")]))


def _seen(state: Column, x: Column, kind: str, at: str) -> Column:
    """The last part of a kind within the scope, after event ``x``."""
    here = F.struct(x[at].alias("at"), x["found"].alias("found"))
    return F.when(x["kind"] == kind, here).when(x["kind"] != "break", state[kind]).alias(kind)


def _left_parts(parts: Column) -> Column:
    """For each weak candidate, the last identifier and endpoint before it, and how far strong matches reach.

    A candidate opens at its start, where the parts that ended are noted, and
    closes at its end, when every strong match that begins within it is known.
    """
    events = F.concat(
        _events(parts["weak"], "close", "end", 0),
        _events(parts["identifiers"], "identifier", "end", 1),
        _events(parts["endpoints"], "endpoint", "end", 1),
        _events(parts["breaks"], "break", "start", 2),
        _events(parts["strong"], "strong", "start", 2),
        _events(parts["weak"], "open", "start", 3),
    )
    nothing = [F.lit(None).cast(SEEN).alias(k) for k in ("identifier", "endpoint")]
    noted = [F.lit(None).cast(SEEN).alias(k) for k in ("noted_identifier", "noted_endpoint")]
    kind = f"struct<start:int,end:int,found:string,identifier:{SEEN},endpoint:{SEEN},strong:int>"

    def step(state: Column, x: Column) -> Column:
        opens = x["kind"] == "open"
        return F.struct(
            _seen(state, x, "identifier", "end"),
            _seen(state, x, "endpoint", "end"),
            F.when(opens, state["identifier"]).otherwise(state["noted_identifier"]).alias("noted_identifier"),
            F.when(opens, state["endpoint"]).otherwise(state["noted_endpoint"]).alias("noted_endpoint"),
            F.when(x["kind"] == "strong", F.greatest(state["strong"], x["end"])).otherwise(state["strong"]).alias("strong"),
        )

    def made(state: Column, x: Column) -> Column:
        noted = [state[f"noted_{k}"].alias(k) for k in ("identifier", "endpoint")]
        return F.when(x["kind"] == "close", F.struct(x["start"], x["end"], x["found"], *noted, state["strong"]))

    return one_pass(F.array_sort(events), F.struct(*nothing, *noted, F.lit(-1).alias("strong")), step, made, kind)


def _right_parts(parts: Column) -> Column:
    """For each weak candidate, the first identifier and endpoint after it, from the last candidate to the first."""
    events = F.concat(
        _events(parts["weak"], "weak", "end", 0),
        _events(parts["identifiers"], "identifier", "start", 1),
        _events(parts["endpoints"], "endpoint", "start", 1),
        _events(parts["breaks"], "break", "start", 1),
    )
    nothing = [F.lit(None).cast(SEEN).alias(k) for k in ("identifier", "endpoint")]

    def step(state: Column, x: Column) -> Column:
        return F.struct(_seen(state, x, "identifier", "start"), _seen(state, x, "endpoint", "start"))

    def made(state: Column, x: Column) -> Column:
        return F.when(x["kind"] == "weak", F.struct(state["identifier"], state["endpoint"]))

    kind = f"struct<identifier:{SEEN},endpoint:{SEEN}>"
    return one_pass(F.reverse(F.array_sort(events)), F.struct(*nothing), step, made, kind)


def linked_credentials(text: Column, strong: Column) -> Column:
    """Weak candidates whose scope holds a complementary part, with the nearest identifier and endpoint.

    A scope ends at a blank line. The intervals of candidates, identifiers,
    endpoints, scope ends and strong matches are sorted once; one pass in each
    direction carries the last parts of the scope, so steps grow with the number
    of parts. Of two parts at the same distance the earlier counts. A part that
    overlaps the candidate is none of it; candidates that overlap a strong match
    are left to it.
    """
    parts = F.struct(
        spans(text, WEAK).alias("weak"),
        spans(text, IDENTIFIER).alias("identifiers"),
        spans(text, ENDPOINT).alias("endpoints"),
        _where_any(text, SCOPE_BREAK, spans(text, SCOPE_BREAK), PART).alias("breaks"),
        strong.alias("strong"),
    )

    def nearest(left: Column, right: Column, kind: str) -> Column:
        before, after = left[kind], right[kind]
        first = after.isNull() | (left["start"] - before["at"] <= after["at"] - left["end"])
        return F.when(first, before["found"]).otherwise(after["found"]).alias(kind)

    def credential(left: Column, right: Column) -> Column:
        span = [left["start"].alias("start"), F.lit(LINKED).alias("kind"), left["end"].alias("end"), left["found"].alias("found")]
        made = F.struct(*span, nearest(left, right, "identifier"), nearest(left, right, "endpoint"))
        return F.when(left["strong"] <= left["start"], made)

    def link(p: Column) -> Column:
        made = F.zip_with(_left_parts(p), F.reverse(_right_parts(p)), credential)
        return F.filter(made, lambda c: c["identifier"].isNotNull() | c["endpoint"].isNotNull())

    linked = F.transform(F.array(parts), link)[0]
    return F.when(text.rlike(WEAK) & text.rlike(f"{IDENTIFIER}|{ENDPOINT}"), linked).otherwise(F.array().cast(f"array<{CREDENTIAL}>"))


def find_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``strong`` (pattern matches) and ``linked`` (weak candidates with their complements).

    Only the row's own text is looked at. A null or empty text has no spans; an
    empty table gives no rows; repeated rows get equal results; columns with
    these names are replaced.
    """

    def work(docs: DataFrame) -> DataFrame:
        out = docs.drop("strong", "linked").withColumn("_text", whole(text_col))
        out = out.withColumn("strong", strong_spans(F.col("_text")))
        return out.withColumn("linked", linked_credentials(F.col("_text"), F.col("strong"))).drop("_text")

    return set_aside(docs, work, [text_col])


def span_text(found: Column) -> Column:
    """Spans as kind:start:end, joined by commas in their order."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def secrets_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of each strong kind, a digest of the strong spans, and all spans as text.

    One row for each row of ``found``, repeated ones included; no spans give zeros and empty texts.
    """

    def count(kind: str) -> Column:
        return F.size(F.filter("strong", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    plain = F.transform("linked", lambda x: F.struct(*[x[f].alias(f) for f in ("start", "kind", "end", "found")]))
    return found.select(
        id_col,
        *[count(kind) for kind in KINDS],
        F.sha2(span_text(F.col("strong")), 256).alias("base_sha256"),
        span_text(in_order(F.concat("strong", plain))).alias("spans"),
    )
