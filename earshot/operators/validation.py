"""Row validation: rules as column expressions, rows split into valid and rejected.

All rules see the whole input. A row is valid if it is the first of its key and
passes every rule, so a failing first row does not make room for a later row
with the same key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.errors import MissingDataException
from earshot.functions.text import not_blank as has_text
from earshot.operators.dedupe import keep_first

REASONS = "reasons"


@dataclass(frozen=True)
class Rule:
    """A named condition on one column. ``passes`` may be any boolean expression."""

    column: str
    name: str
    passes: Callable[[Column], Column]

    @property
    def reason(self) -> str:
        return f"{self.column}: {self.name}"

    def condition(self) -> Column:
        return self.passes(F.col(self.column))


def not_null(column: str) -> Rule:
    return Rule(column, "null", lambda c: c.isNotNull())


def not_blank(column: str) -> Rule:
    """Fails on text of white space only; nulls are the business of ``not_null``."""
    return Rule(column, "blank", lambda c: F.coalesce(has_text(c), F.lit(True)))


@dataclass(frozen=True)
class RuleSet:
    """The rules of one table: column types, conditions and the unique key."""

    name: str
    key: str
    types: T.StructType
    rules: tuple[Rule, ...]

    def allow_null(self, *columns: str) -> RuleSet:
        """The same rules, with nulls accepted in ``columns``."""
        kept = tuple(r for r in self.rules if not (r.name == "null" and r.column in columns))
        return replace(self, rules=kept)

    def skipped(self, df: DataFrame) -> list[str]:
        """Reasons that cannot arise because their column is absent from ``df``."""
        return [r.reason for r in self.rules if r.column not in df.columns]

    def applicable(self, df: DataFrame) -> list[Rule]:
        return [r for r in self.rules if r.column in df.columns]


def _conform(df: DataFrame, types: T.StructType) -> tuple[DataFrame, list[Rule]]:
    """Cast to the declared types; values that do not fit become null and fail a rule."""
    casts, flags, rules = {}, {}, []
    for field in types:
        if field.name not in df.columns or df.schema[field.name].dataType == field.dataType:
            continue
        given = F.col(field.name)
        from_fraction = isinstance(df.schema[field.name].dataType, (T.FloatType, T.DoubleType))
        if from_fraction:
            # NaN is how a missing number looks in a column of doubles
            given = F.when(~F.isnan(given), given)
        cast = given.try_cast(field.dataType)
        fits = given.isNull() | cast.isNotNull()
        if from_fraction and isinstance(field.dataType, T.IntegralType):
            fits = fits & F.coalesce(cast.cast("double") == given, F.lit(True))
        flag = f"_fits_{field.name}"
        casts[field.name], flags[flag] = cast, fits
        rules.append(Rule(field.name, f"not {field.dataType.simpleString()}", lambda _, f=flag: F.col(f)))
    return (df.withColumns(flags).withColumns(casts), rules) if casts else (df, rules)


def valid_rows(df: DataFrame, rule_set: RuleSet, ordinal: str) -> DataFrame:
    """Rows that are the first of their key and pass every rule, in declared types."""
    typed, type_rules = _conform(df, rule_set.types)
    first = keep_first(typed, rule_set.key, [ordinal])
    # A conjunction, not a count of failures: Spark moves the conditions on the
    # key alone below the exchange, which drops the group of null keys early.
    rules = [*rule_set.applicable(df), *type_rules]
    passing = reduce(lambda a, b: a & b, (r.condition() for r in rules), F.lit(True))
    return first.where(passing).select(*df.columns)


def rejected_rows(df: DataFrame, rule_set: RuleSet, ordinal: str) -> DataFrame:
    """The other rows as they came, with an array of ``reasons``.

    Which rows are first is joined back on the ordinal. It is unique, so the
    join is even however the keys are distributed.
    """
    given = df.withColumn("_given", F.struct(*df.columns))
    typed, type_rules = _conform(given, rule_set.types)
    firsts = keep_first(typed.select(rule_set.key, ordinal), rule_set.key, [ordinal])
    firsts = firsts.select(ordinal, F.lit(True).alias("_first"))
    failed = [F.when(~r.condition(), F.lit(r.reason)) for r in [*rule_set.applicable(df), *type_rules]]
    failed.append(F.when(F.col("_first").isNull(), F.lit(f"{rule_set.key}: duplicate")))
    judged = typed.join(firsts, ordinal, "left").withColumn(REASONS, F.array_compact(F.array(*failed)))
    return judged.where(F.size(REASONS) > 0).select("_given.*", REASONS)


# --- presence of fields ---------------------------------------------------------


def field_paths(schema: T.StructType, prefix: str = "") -> set[str]:
    """Dotted names of all fields, nested ones included."""
    paths = set()
    for field in schema:
        name = f"{prefix}{field.name}"
        paths.add(name)
        if isinstance(field.dataType, T.StructType):
            paths |= field_paths(field.dataType, f"{name}.")
    return paths


def check_required(schema: T.StructType, required: Sequence[str]) -> None:
    """Raise if a required path is absent from the schema. Runs no job."""
    raise_missing([p for p in required if p not in field_paths(schema)])


def raise_missing(missing: Sequence[str]) -> None:
    if missing:
        # fixed value: the text of the error
        raise MissingDataException(f"Data has missing columns: {list(missing)}")
