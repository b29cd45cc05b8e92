"""Semi-structured values as Spark's variant type: kinds, keys, parts taken out or put in, nested documents built and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What JSON calls the kinds that a variant's schema names by these first words.
KINDS = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null"}


def kind_of(value: Column) -> Column:
    """``object``, ``array``, ``string``, ``number``, ``boolean`` or ``null`` (a JSON null); null where there is no value."""
    first = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    named = F.lit("number")
    for name, kind in KINDS.items():
        named = F.when(first == name, kind).otherwise(named)
    return F.when(value.isNotNull(), named)


def parsed(text: Column) -> Column:
    """A variant; null where the text is no JSON."""
    return F.try_parse_json(text)


def fields_of(document: Column) -> Column:
    """An object as a map from key to variant; null for anything else."""
    return F.when(kind_of(document) == "object", document.cast("map<string,variant>"))


def without(document: Column, *keys: str) -> Column:
    """An object without some of its keys; anything else is null."""
    return F.to_variant_object(F.map_filter(fields_of(document), lambda k, _: ~k.isin(*keys)))


def with_fields(document: Column, **values: Column) -> Column:
    """An object with fields set, whether it had them or not."""
    named = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v.cast("variant"))])
    kept = F.map_filter(fields_of(document), lambda k, _: ~k.isin(*values))
    return F.to_variant_object(F.map_concat(kept, named))


def document(**fields: Column) -> Column:
    """One nested document from columns; structs, arrays and maps in them nest."""
    return F.to_variant_object(F.struct(*[v.alias(k) for k, v in fields.items()]))


def elements(df: DataFrame, value: str, path: str, keys: list[str], fields: dict[str, str]) -> DataFrame:
    """The elements of an array inside a document as rows with their place (from 1): (*keys, ordinality, *fields with their types).

    A path that names no array gives no rows; a field that is missing or of another kind is null.
    """
    inner = F.try_variant_get(F.col(value), path, "array<variant>")
    rows = df.select(*keys, F.posexplode(inner).alias("_p", "_v"))
    return rows.select(*keys, (F.col("_p") + 1).alias("ordinality"), *[F.try_variant_get("_v", f"$.{k}", kind).alias(k) for k, kind in fields.items()])
