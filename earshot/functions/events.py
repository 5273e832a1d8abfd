"""Event columns: payload fields, the type rule and the merged payload."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds of the years 1 to 9999, the range of a calendar time.
MIN_SECOND = -62135596800
MAX_SECOND = 253402300799


def event_type(name: Column) -> Column:
    """First part of ``a:b[:c...]``, empty where there is no colon."""
    return F.when(F.contains(name, F.lit(":")), F.substring_index(name, ":", 1)).otherwise("")


def event_subtype(name: Column) -> Column:
    """Second part where there are at least three, else empty."""
    first_two = F.substring_index(name, ":", 2)
    return F.when(first_two != name, F.substring_index(first_two, ":", -1)).otherwise("")


# White space of JSON.
_BLANKS = " \t\r\n"


def json_array(text: Column) -> Column:
    """Parse ``text`` as the content of a JSON array.

    The parser ignores what follows a complete value. Inside brackets, text after
    the first value is either an error or a further element.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))


def is_one_object(array: Column, text: Column) -> Column:
    """Whether ``text``, parsed as ``array = json_array(text)``, is a single JSON object."""
    single = array.isNotNull() & F.try_variant_get(array, "$[1]", "variant").isNull()
    braced = F.startswith(F.ltrim(text, F.lit(_BLANKS)), F.lit("{"))
    # A bracket of the text itself may have closed the array early. Such text
    # does not parse inside braces.
    may_close = F.contains(text, F.lit("]")) & text.rlike(r"\}\s*\]")
    in_braces = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return single & braced & F.when(may_close, in_braces.isNotNull()).otherwise(F.lit(True))


def field(array: Column, name: str, kind: str) -> Column:
    """A field of the object in ``array``, null where absent or not of that kind."""
    return F.try_variant_get(array, f"$[0].{name}", kind)


def field_kind(array: Column, name: str) -> Column:
    """The type of a field as its JSON value shows it, such as ``STRING``."""
    return F.schema_of_variant(field(array, name, "variant"))


def text_value(kind: Column, array: Column, name: str) -> Column:
    """A field as text, null where it is not a JSON string."""
    return F.when(kind == "STRING", field(array, name, "string"))


def seconds_value(kind: Column, array: Column, name: str) -> Column:
    """A field holding epoch seconds: a number, or text of a whole number."""
    is_number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | F.startswith(kind, F.lit("DECIMAL"))
    is_whole_text = (kind == "STRING") & field(array, name, "string").rlike(r"^\s*[+-]?\d+\s*$")
    return F.when(is_number | is_whole_text, field(array, name, "double"))


def whole_seconds(seconds: Column) -> Column:
    """Truncate towards zero."""
    return seconds.cast("bigint")


def merged_payload(array: Column, text: Column, added: dict[str, Column]) -> Column:
    """The JSON object ``text`` with the text fields ``added`` set, all others kept.

    The fields, none of them null, go behind the opening brace of an object that
    has other fields. Only where it has one of them already is it taken apart and
    put together again.
    """
    opened = F.rtrim(F.to_json(F.struct(*[v.alias(name) for name, v in added.items()])), F.lit("}"))
    rest = F.substr(F.ltrim(text, F.lit(_BLANKS)), F.lit(2))
    put_in_front = F.concat(opened, F.lit(","), rest)

    fields = F.try_variant_get(array, "$[0]", "map<string,variant>")
    kept = F.map_filter(fields, lambda key, _: ~key.isin(*added))
    extra = F.create_map(*[part for name, v in added.items() for part in (F.lit(name), v.cast("variant"))])

    # a name that is not in the text can still be there in escaped form
    may_have = reduce(or_, [F.contains(text, F.lit(part)) for part in ("\\", *added)])
    has = F.coalesce(*[field(array, name, "variant") for name in added]).isNotNull()
    return F.when(may_have & has, F.to_json(F.map_concat(kept, extra))).otherwise(put_in_front)
