"""Schemas of the relation tables and the checks against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

BRONZE = T.StructType(
    [
        T.StructField("Purchaser", T.StringType()),
        T.StructField("Seller", T.StringType()),
        T.StructField("src_id", T.LongType()),
        T.StructField("dst_id", T.LongType()),
        T.StructField("probability", T.DoubleType()),
    ]
)
EDGES = T.StructType(
    [T.StructField("src_id", T.LongType()), T.StructField("dst_id", T.LongType())]
)
SCORED = T.StructType([*EDGES.fields, T.StructField("gnn_prediction", T.DoubleType())])


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def as_landed(schema: T.StructType) -> T.StructType:
    """The same columns as text, the form in which records land.

    A number, a number in quotes and a nested value all fit a text column, so no record is lost to a type.
    """
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def typed(landed: DataFrame, schema: T.StructType) -> DataFrame:
    """Landed text as ``schema`` says; text that is no value of its type becomes null. Other columns stay."""

    def value(f: T.StructField) -> Column:
        have = landed.schema[f.name].dataType
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        if nested and isinstance(have, T.StringType):
            return F.from_json(F.col(f.name), f.dataType)
        return F.col(f.name) if have == f.dataType else F.col(f.name).try_cast(f.dataType)

    known = [f for f in schema.fields if f.name in landed.columns]
    return landed.withColumns({f.name: value(f) for f in known})


def require(df: DataFrame, contract: T.StructType, what: str = "input") -> DataFrame:
    """Fails before planning when a contract column is absent or of another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: {have[f.name].simpleString() if f.name in have else 'absent'}"
        f" instead of {f.dataType.simpleString()}"
        for f in contract.fields
        if have.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError(f"{what} breaks its contract: {'; '.join(wrong)}")
    return df


def model_signature(relations: DataFrame) -> dict[str, T.StructType]:
    """Input and output contract of the link scorer for this relation table."""
    require(relations, EDGES, "relation table")
    return {"inputs": EDGES, "outputs": T.StructType([SCORED["gnn_prediction"]])}
