"""CSV files with a header row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from bazar.sources.describe import describe

# Text forms of each type, tried in this order. A number written with a
# leading zero is a code, not a number.
TEXT_FORMS = (
    ("boolean", r"^(?i:true|false)$"),
    ("date", r"^\d{4}-\d{2}-\d{2}$"),
    ("timestamp_ntz", r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"),
    ("bigint", r"^[+-]?(0|[1-9]\d{0,17})$"),
    ("double", r"^[+-]?(0|[1-9]\d*)?(\.\d*)?([eE][+-]?\d+)?$"),
)


def _reader(spark: SparkSession, multi_line: bool):
    # quotes inside a field are doubled; a row that does not fit stops the job
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line).option("mode", "FAILFAST")


def _text(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """All columns as text; reads no more than a header line."""
    return _reader(spark, multi_line).csv(path)


def _all_match(column: str, dtype: str, pattern: str) -> Column:
    c = F.col(f"`{column}`")
    fits = c.rlike(pattern) & c.try_cast(dtype).isNotNull()
    return (F.count(c) > 0) & (F.count_if(fits) == F.count(c))


def infer_csv_schema(spark: SparkSession, path: str, *, multi_line: bool) -> StructType:
    """Types from every value of the file, in one distributed pass.

    One row of flags comes back to the driver. Codes such as '02403' stay text, which
    Spark's own inference would turn into numbers.
    """
    text = _text(spark, path, multi_line)
    flags = [
        _all_match(name, dtype, pattern).alias(f"{i}_{dtype}") for i, name in enumerate(text.columns) for dtype, pattern in TEXT_FORMS
    ]
    found = text.agg(*flags).first()
    fields = []
    for i, name in enumerate(text.columns):
        dtype = next((d for d, _ in TEXT_FORMS if found[f"{i}_{d}"]), "string")
        fields.append(StructField(name, _parse_datatype_string(dtype)))
    return StructType(fields)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, *, multi_line: bool) -> DataFrame:
    """All columns of a CSV file or folder, with the given types or inferred ones.

    Columns are found by their names in the header, whatever their order there; a missing or surplus one is refused, as is a file of a folder
    whose header differs. A row with a value that does not fit its type, or with too few or too many fields, stops the job that reads it.

    ``multi_line`` says whether fields may hold quoted line breaks. Such files are read one task each; all others are split.
    """
    if schema is None:
        schema = infer_csv_schema(spark, path, multi_line=multi_line)
    elif isinstance(schema, str):
        schema = _parse_datatype_string(schema)
    header = _text(spark, path, multi_line).columns
    if sorted(header) != sorted(schema.names):
        raise ValueError(f"{path} has columns {header}, not {schema.names}")
    in_file = StructType([schema[name] for name in header])
    return _reader(spark, multi_line).option("enforceSchema", False).schema(in_file).csv(path).select(*[f"`{n}`" for n in schema.names])


def preview_csv(spark: SparkSession, path: str, limit: int = 10, schema: StructType | str | None = None, *, multi_line: bool) -> DataFrame:
    """The first rows, as text unless there is a schema; reads no more of the file than that."""
    rows = _text(spark, path, multi_line) if schema is None else read_csv(spark, path, schema, multi_line=multi_line)
    return rows.limit(limit)


def describe_csv(spark: SparkSession, path: str, *, multi_line: bool) -> DataFrame:
    """``column_name, column_type`` as inferred."""
    return describe(read_csv(spark, path, multi_line=multi_line))
