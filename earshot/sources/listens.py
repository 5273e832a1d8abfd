"""The raw listening log: JSON lines in a text file or in a zip archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.errors import UnsupportedFileFormatException
from earshot.operators.validation import field_paths
from earshot.operators.sizing import broadcast_within, measured
from earshot.schemas import RAW_LISTEN
from earshot.sources.zip_lines import zip_lines

ORDINAL = "_ordinal"
"""Place of a row in the input; rows compare by it in input order."""

# fixed values: extensions and the text of the error
ARCHIVE_EXTENSION = ".zip"
TEXT_EXTENSIONS = (".txt", ".json")
UNSUPPORTED = "Unsupported file format, provide '.zip' or '.txt' file/path as input."


def extract(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = RAW_LISTEN,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Read the log as nested rows, each with its ordinal.

    ``schema=None`` infers all fields at the price of one more pass. A malformed
    line fails the read, and the error names its file, or its archive, member and
    line; ``malformed_lines`` finds the places of all of them. With
    ``corrupt_column`` it becomes a row holding the line in that column instead.
    """
    if not path.endswith((ARCHIVE_EXTENSION, *TEXT_EXTENSIONS)):
        raise UnsupportedFileFormatException(UNSUPPORTED)
    options = {"mode": "FAILFAST"}
    if corrupt_column:
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_column}
        if schema is not None:
            schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
    if path.endswith(ARCHIVE_EXTENSION):
        return _extract_archive(spark, path, schema, options)
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return reader.json(path).select("*", place.alias(ORDINAL))


def _extract_archive(
    spark: SparkSession, path: str, schema: T.StructType | None, options: dict[str, str]
) -> DataFrame:
    lines = _archive_lines(spark, path)
    if schema is None:
        schema = infer_schema(lines, _refused())
    place = F.struct("archive", "member", "line")
    # A large member is one task's work to read; spread its lines before parsing.
    spread = lines.select("value", "name", place.alias(ORDINAL)).repartition(ORDINAL)
    if not schema.fields:
        return spread.select(ORDINAL)
    if options["mode"] == "FAILFAST":
        wide, corrupt, permissive = _with_corrupt(schema)
        read = spread.select(F.from_json("value", wide, permissive).alias("listen"), "name", ORDINAL)
        checked = F.when(F.col(f"listen.{corrupt}").isNotNull(), _refused(f"{ORDINAL}.")).otherwise(F.col("listen"))
        return read.select(checked.alias("listen"), ORDINAL).select("listen.*", ORDINAL).drop(corrupt)
    parsed = F.from_json("value", schema, options)
    return spread.select(parsed.alias("listen"), ORDINAL).select("listen.*", ORDINAL)


def _with_corrupt(schema: T.StructType) -> tuple[T.StructType, str, dict[str, str]]:
    """The schema with a column for lines that do not fit it, the column's name, and the options to read so."""
    corrupt = "_corrupt"
    while corrupt in schema.names:
        corrupt += "_"
    wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    return wide, corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}


def _malformed(schema: T.StructType) -> Column:
    """Whether ``value`` cannot be read as a record of the schema."""
    wide, corrupt, options = _with_corrupt(schema)
    return F.from_json("value", wide, options)[corrupt].isNotNull()


def _refused(prefix: str = "") -> Column:
    """An error that names the place of a line of an archive; lines count from 1."""
    line = (F.col(f"{prefix}line") + 1).cast("string")
    parts = ["[MALFORMED_RECORD] archive '", F.col(f"{prefix}archive"), "', member '", F.col("name"), "', line ", line]
    return F.raise_error(F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))


def malformed_lines(spark: SparkSession, path: str, schema: T.StructType = RAW_LISTEN) -> DataFrame:
    """The places of all malformed lines: ``file``, ``member`` (null for plain files), ``line`` from 1, ``value``.

    The lines of a plain file are counted per split in one aggregate, so only
    the malformed ones meet the counts of the splits before theirs. Blank lines
    count as lines and are not malformed; an empty log has none.
    """
    bad = (F.trim("value") != "") & _malformed(schema)
    if path.endswith(ARCHIVE_EXTENSION):
        found = zip_lines(spark, path).where(bad)
        return found.select(F.col("archive").alias("file"), F.col("name").alias("member"), (F.col("line") + 1).alias("line"), "value")
    split = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    lines = spark.read.text(path).select("value", *split, F.monotonically_increasing_id().alias("row"))
    splits = lines.groupBy("file", "start").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1
    splits, n = measured(splits.select("file", "start", shift.alias("shift")))
    found = lines.where(bad).join(broadcast_within(splits, n), ["file", "start"])
    return found.select("file", F.lit(None).cast("string").alias("member"), (F.col("row") + F.col("shift")).alias("line"), "value")


def _archive_lines(spark: SparkSession, path: str) -> DataFrame:
    return zip_lines(spark, path).where(F.col("value") != "")


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the log, unparsed, in column ``value``."""
    if path.endswith(ARCHIVE_EXTENSION):
        return _archive_lines(spark, path)
    return spark.read.text(path).where(F.col("value") != "")


def infer_schema(lines: DataFrame, refused: Column | None = None) -> T.StructType:
    """Schema of all JSON objects in ``value``, computed as one aggregate.

    A field that is null in every row is kept, as text, as Spark's JSON reader
    does; a field that occurs in no row is absent. ``refused`` is the error of a
    line that is no JSON.
    """
    parsed = F.parse_json("value")
    if refused is not None:
        valid = F.try_parse_json("value")
        parsed = F.when(valid.isNull(), refused.cast("variant")).otherwise(valid)
    found = lines.agg(F.schema_of_variant_agg(parsed).alias("ddl")).first()["ddl"]
    schema = _without_void(T._parse_datatype_string((found or "VOID").replace("OBJECT<", "STRUCT<")))
    return schema if isinstance(schema, T.StructType) else T.StructType([])


def _without_void(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _without_void(f.dataType)) for f in dtype])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_without_void(dtype.elementType))
    return T.StringType() if isinstance(dtype, T.NullType) else dtype


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs as top-level columns with dotted names; arrays stay as they are."""

    def leaves(schema: T.StructType, trail: tuple[str, ...] = ()):
        for field in schema:
            here = (*trail, field.name)
            if isinstance(field.dataType, T.StructType) and field.name != ORDINAL:
                yield from leaves(field.dataType, here)
            else:
                yield here

    def column(parts: tuple[str, ...]):
        return F.col(".".join(f"`{p}`" for p in parts)).alias(".".join(parts))

    return df.select(*[column(parts) for parts in leaves(df.schema)])


def absent_paths(listens: DataFrame, lines: DataFrame, required: list[str]) -> list[str]:
    """Required paths that occur in no row, for rows read with a declared schema.

    A value that is set proves its path, and the first rows mostly settle that.
    What they leave open is counted over all rows, and a path without any value
    is looked up in the unparsed lines, since a null also counts as present.
    """

    def unseen(rows: DataFrame, paths: list[str]) -> list[str]:
        counts = rows.agg(*[F.count(p).alias(str(i)) for i, p in enumerate(paths)]).first()
        return [p for p, n in zip(paths, counts) if n == 0]

    known = field_paths(listens.schema)
    open_paths = unseen(listens.limit(1000), [p for p in required if p in known]) if known else []
    if open_paths:
        open_paths = unseen(listens, open_paths)
    missing = [p for p in required if p not in known]
    if open_paths:
        # One count for each path: a JSON null is a value of the variant, an absent field is none.
        value = F.try_parse_json("value")
        counts = [F.count(F.try_variant_get(value, f"$.{p}", "variant")).alias(str(i)) for i, p in enumerate(open_paths)]
        missing += [p for p, n in zip(open_paths, lines.agg(*counts).first(), strict=True) if n == 0]
    return [p for p in required if p in missing]


def numbered(listens: DataFrame) -> DataFrame:
    """The listens with their ordinal as one BIGINT, so that first-of-key aggregates need no sort.

    The parts of the input (splits of files, or members of archives) are numbered
    in order; the number fills the upper bits and the row within the part the
    lower 33. There is one part for each input task, so their list is short.
    """
    place = listens.schema[ORDINAL].dataType
    if not isinstance(place, T.StructType):
        return listens
    *part, row = place.names
    parts = listens.select(*[F.col(f"{ORDINAL}.{c}").alias(f"_{c}") for c in part]).distinct()
    order = W.orderBy(*[f"_{c}" for c in part])
    parts, n = measured(parts.withColumn("_part", F.row_number().over(order)))
    same = [F.col(f"{ORDINAL}.{c}").eqNullSafe(F.col(f"_{c}")) for c in part]
    within = F.col(f"{ORDINAL}.{row}").bitwiseAND(F.lit((1 << 33) - 1))
    ordinal = F.shiftleft(F.col("_part").cast("bigint"), 33).bitwiseOR(within)
    joined = listens.join(broadcast_within(parts, n), same)
    return joined.withColumn(ORDINAL, ordinal).select(*listens.columns)
