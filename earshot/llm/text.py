"""Column expressions on whole texts, shared by the operators that use no Python in tasks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
CHUNK = 256


def whole(text: Column | str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def spans(text: Column, pattern: str | Column, groups: dict[str, int] | None = None) -> Column:
    """Leftmost non-overlapping matches of a pattern, as structs ``start``, ``end``, ``found``.

    Positions are code points, the end is exclusive. ``groups`` adds fields that
    hold the text of groups of the pattern. A position is the length of all that
    lies before it: the gaps that ``split`` leaves and the earlier matches.
    """
    grouped = F.concat(F.lit("("), pattern, F.lit(")")) if isinstance(pattern, Column) else F.lit(f"({pattern})")
    found = F.regexp_extract_all(text, grouped, F.lit(1))
    gaps = F.split(text, pattern, -1)
    columns = {"found": found, "gap": F.slice(gaps, 1, F.size(found))}
    for name, number in (groups or {}).items():
        columns[name] = F.regexp_extract_all(text, grouped, F.lit(number + 1))
    pairs = F.arrays_zip(*[c.alias(k) for k, c in columns.items()])
    empty = F.array().cast("array<struct<start:int,end:int,found:string" + "".join(f",{g}:string" for g in groups or {}) + ">>")

    def step(done: Column, x: Column) -> Column:
        before = F.when(F.size(done) > 0, F.element_at(done, -1)["end"]).otherwise(0)
        start = before + F.length(x["gap"])
        fields = [start.cast("int").alias("start"), (start + F.length(x["found"])).cast("int").alias("end"), x["found"].alias("found")]
        return F.concat(done, F.array(F.struct(*fields, *[x[g].alias(g) for g in groups or {}])))

    return F.aggregate(pairs, empty, step)


def one_pass(
    events: Column, start: Column, step: Callable[[Column, Column], Column], made: Callable[[Column, Column], Column], kind: str
) -> Column:
    """Go through an array once with a state; the outputs of type ``kind`` that ``made`` gives, in order.

    ``made`` sees the state before the event and gives null for no output. Arrays
    cannot be appended to in place, so outputs are gathered by chunks, which
    keeps the copying in proportion to the events.
    """
    none = F.array().cast(f"array<{kind}>")

    def one(acc: Column, x: Column) -> Column:
        out = F.when(made(acc["state"], x).isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(made(acc["state"], x).cast(kind))))
        return F.struct(step(acc["state"], x).alias("state"), out.alias("out"))

    def chunk(acc: Column, part: Column) -> Column:
        done = F.aggregate(part, F.struct(acc["state"].alias("state"), none.alias("out")), one)
        both = F.transform(F.array(done), lambda d: F.struct(d["state"].alias("state"), F.concat(acc["out"], F.array(d["out"])).alias("out")))
        return both[0]

    def run(held: Column) -> Column:
        last = F.floor((F.size(held) - 1) / CHUNK).cast("int")
        parts = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(held, i * CHUNK + 1, CHUNK))
        nothing = F.struct(start.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        return F.when(F.size(held) > 0, F.flatten(F.aggregate(parts, nothing, chunk)["out"])).otherwise(none)

    return F.transform(F.array(events), run)[0]


def set_aside(docs: DataFrame, work: Callable[[DataFrame], DataFrame], used: Sequence[str], own: Sequence[str] = ()) -> DataFrame:
    """``work(docs)``, with columns that its helpers could meet under other names meanwhile.

    Helper columns begin with an underscore; ``own`` adds names that ``work``
    gives to columns of its own. ``used`` columns stay as they are.
    """
    taken, mine = {c.lower() for c in docs.columns}, {c.lower() for c in own}
    meet = [c for c in docs.columns if c not in used and (c.startswith("_") or c.lower() in mine)]
    if not meet:
        return work(docs)
    prefix = "aside"
    while any(c.startswith(prefix) for c in taken):
        prefix += "x"
    names = {c: f"{prefix}{i}" for i, c in enumerate(meet)}
    done = work(docs.withColumnsRenamed(names))
    return done.withColumnsRenamed({new: old for old, new in names.items()})
