"""What the records should obey: dependencies between columns, and one type per field of the documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# (columns that decide, column that follows from them)
DEPENDENCIES = (
    (("case_id",), "court_district"),
    (("court_district",), "court_district_code"),
    (("defendant_id",), "income_level"),
    (("assigned_judge", "court_district_code"), "court_district"),
)


def dependency_errors(
    rows: DataFrame, dependencies: Sequence[tuple[Sequence[str], str]] = DEPENDENCIES
) -> DataFrame:
    """How far each dependency is from holding: groups that break it and the fewest rows to remove for it.

    All dependencies are counted in one pass: equal values are added up before the shuffle, then the most
    frequent value of a group stays and the others would go. Null is a value like others.
    """
    def named(name: str, columns: Sequence[str], follows: str):
        decides = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"})
        return F.struct(F.lit(name).alias("dependency"), decides.alias("given"),
                        F.col(follows).cast("string").alias("value"))

    listed = F.array(*[
        named(f"{', '.join(columns)} -> {follows}", columns, follows) for columns, follows in dependencies
    ])
    counted = rows.select(F.inline(listed)).groupBy("dependency", "given", "value").agg(
        F.count(F.lit(1)).alias("_rows")
    )
    groups = counted.groupBy("dependency", "given").agg(
        F.sum("_rows").alias("_rows"), F.max("_rows").alias("_most"), F.count(F.lit(1)).alias("_values")
    )
    return groups.groupBy("dependency").agg(
        F.count(F.lit(1)).alias("groups"), F.count_if(F.col("_values") > 1).alias("broken_groups"),
        F.sum("_rows").alias("records"), F.sum(F.col("_rows") - F.col("_most")).alias("records_to_remove"),
    )


#: Types of JSON values, by the bit that stands for each.
KINDS = ("null", "boolean", "integer", "number", "text", "object", "array")


def _kind(value):
    """Spark's name of a variant's type without its details: OBJECT, DECIMAL; VOID or null of a null."""
    return F.substring_index(F.substring_index(F.schema_of_variant(value), "<", 1), "(", 1)


def _kind_bit(kind):
    """The bit of a type. Types of a field add up by or, in any order."""
    name = (
        F.when(kind.isNull() | (kind == "VOID"), "null").when(kind == "BOOLEAN", "boolean")
        .when(kind == "BIGINT", "integer").when(kind.isin("DECIMAL", "DOUBLE", "FLOAT"), "number")
        .when(kind == "OBJECT", "object").when(kind == "ARRAY", "array").otherwise("text")
    )
    bits = F.create_map(*[F.lit(x) for i, kind in enumerate(KINDS) for x in (kind, 1 << i)])
    return bits[name].cast("int")


def schema_drift(bronze: DataFrame) -> DataFrame:
    """Per day and field of the documents: the types it had, how often, and whether they conflict.

    Null agrees with every type, an integer is a number. Documents that are no object have no fields. One
    aggregate of bits: days can be added up in any order and again by months.
    """
    # the document is parsed inside a generator, so that no filter parses it again
    document = F.explode(F.array(F.try_parse_json("raw_json"))).alias("document")
    documents = bronze.select(F.to_date("eventhub_timestamp").alias("day"), document).filter(
        F.col("document").isNotNull() & F.schema_of_variant("document").startswith("OBJECT")
    )
    each = bronze.sparkSession.tvf.variant_explode(F.col("document").outer())
    fields = documents.lateralJoin(each).select("day", F.col("key").alias("field"), "value")
    # equal types are counted first, so the bits are looked up once per day, field and type
    typed = fields.groupBy("day", "field", _kind(F.col("value")).alias("_kind")).agg(F.count(F.lit(1)).alias("_rows"))
    typed = typed.withColumn("_bit", _kind_bit(F.col("_kind")))
    found = typed.groupBy("day", "field").agg(
        F.bit_or("_bit").alias("_bits"), F.sum("_rows").alias("records"),
        F.coalesce(F.sum(F.when(F.col("_bit") == 1, F.col("_rows"))), F.lit(0)).alias("nulls"),
    )
    present = [F.when(F.col("_bits").bitwiseAND(F.lit(1 << i)) != 0, F.lit(kind)) for i, kind in enumerate(KINDS)]
    lasting = F.col("_bits").bitwiseAND(F.lit(~1 & 0x7F))
    alone = F.bit_count(lasting) <= 1
    numeric = lasting == F.lit((1 << KINDS.index("integer")) | (1 << KINDS.index("number")))
    return found.select(
        "day", "field", F.array_join(F.array_compact(F.array(*present)), ",").alias("types"), "records", "nulls",
        (~(alone | numeric)).alias("conflicts"),
    )
