"""Text columns: surrogate keys, white space and base64."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(value: Column) -> Column:
    """Surrogate key: lowercase hex SHA-256 of the UTF-8 bytes, null for null."""
    return F.sha2(value, 256)


def strip(value: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def not_blank(value: Column) -> Column:
    """True where the text has something other than white space."""
    return value.rlike(r"(?U)\S")


def encode_text(value: Column) -> Column:
    """Base64 of the UTF-8 bytes, on one line (Spark may break it every 76 characters)."""
    return F.replace(F.base64(F.encode(value, "UTF-8")), F.lit("\r\n"), F.lit(""))


def decode_text(value: Column) -> Column:
    """UTF-8 text of a base64 value, null where either decoding fails."""
    return F.try_validate_utf8(F.try_to_binary(value, F.lit("base64")).cast("string"))
