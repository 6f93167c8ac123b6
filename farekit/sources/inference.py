"""Types of text columns, found in one aggregation over the rows.

Every value shows one sort: whole number, long whole number, number, date or
other text. A column's type is the smallest that holds all the sorts it has:

    null < int < long < double < string,   null < date < string

The sorts of a column are bits, so ``bit_or`` by column folds them in the map
tasks, and a number a column reaches the driver however many rows or files
there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farekit.sources import readers

INT, LONG, DOUBLE, DATE, TEXT = 1, 2, 4, 8, 16

_SHORT = r"^[+-]?[0-9]{1,9}$"
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_NOT_FINITE = ("NaN", "Inf", "+Inf", "-Inf", "Infinity", "-Infinity")
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_CODE = r"^[+-]?0[0-9]+$"


def sort_of(text: Column, *, codes_as_text: bool = False) -> Column:
    """The bit of a value's sort; 0 for null and empty text."""
    # Every number and date starts with a character from + to 9, so one comparison settles most texts. Then
    # patterns, the frequent ones first: a cast that fails costs an exception, so only what looks right is cast.
    not_finite = text.isin(*_NOT_FINITE)
    long = text.try_cast("bigint")
    whole = F.when(long.between(-(2**31), 2**31 - 1), INT).when(long.isNotNull(), LONG).otherwise(DOUBLE)
    sort = F.when(text.isNull() | (text == ""), 0)
    sort = sort.when((text < "+") | (text >= ":"), F.when(not_finite, DOUBLE).otherwise(TEXT))
    if codes_as_text:
        sort = sort.when(text.rlike(_CODE), TEXT)
    return (
        sort.when(text.rlike(_SHORT), INT)
        .when((F.length(text) == 10) & text.rlike(_DATE) & text.try_cast("date").isNotNull(), DATE)
        .when(text.rlike(_WHOLE), whole)
        .when(text.rlike(_NUMBER) | not_finite, DOUBLE)
        .otherwise(TEXT)
    )


def type_of(sorts: int) -> T.DataType:
    """The smallest type that holds all sorts of a column; a column without a value stays text."""
    if sorts & TEXT or sorts == 0 or (sorts & DATE and sorts != DATE):
        return T.StringType()
    if sorts == DATE:
        return T.DateType()
    if sorts & DOUBLE:
        return T.DoubleType()
    return T.LongType() if sorts & LONG else T.IntegerType()


def inferred_schema(texts: DataFrame, *, codes_as_text: bool = False) -> T.StructType:
    """The type of every column of a table of texts, from one pass over it.

    Null and empty values fit every type. Whole numbers beyond 64 bits are
    doubles. ``codes_as_text`` keeps columns as text in which a number has
    leading zeros, such as postal codes; without it they are numbers. An empty
    table and a column without values are text. Names may hold any characters,
    but no two may be equal.
    """
    if not texts.columns:
        return T.StructType([])
    # A row per value keeps the expression as small for a thousand columns as for one.
    values = texts.select(F.posexplode(F.array(*[F.col(_quoted(name)) for name in texts.columns])).alias("column", "text"))
    folded = values.groupBy("column").agg(F.bit_or(sort_of(F.col("text"), codes_as_text=codes_as_text)).alias("sorts"))
    sorts = {row["column"]: row["sorts"] for row in folded.collect()}
    return T.StructType([T.StructField(name, type_of(sorts.get(i, 0))) for i, name in enumerate(texts.columns)])


def typed(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """The table under an inferred schema. Infinite and missing numbers keep the spellings that the inference accepts."""

    def cast(field: T.StructField) -> Column:
        text = F.col(_quoted(field.name))
        if isinstance(field.dataType, T.DoubleType):
            text = F.when(text == "+Inf", "Inf").otherwise(text)
        if not isinstance(field.dataType, T.StringType):
            text = F.nullif(text, F.lit("")).try_cast(field.dataType)
        return text.alias(field.name)

    return texts.select(*[cast(f) for f in schema.fields])


def read_inferred_csv(spark: SparkSession, path: str, *, codes_as_text: bool = False) -> DataFrame:
    """A headed CSV with the types that its values have. The files are read once more when the result is used."""
    texts = readers.read_untyped_csv(spark, path)
    return typed(texts, inferred_schema(texts, codes_as_text=codes_as_text))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
