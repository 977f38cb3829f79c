"""Schema lookup. The registry is a table ``(vendor, name, model, revision, addition, schema_json)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.names import entity_column_name
from landfall.operators.entities import ENTITY

KEY = ("vendor", "name", "model", "revision", "addition")
REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("vendor", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("model", T.IntegerType(), False),
        T.StructField("revision", T.IntegerType(), False),
        T.StructField("addition", T.IntegerType(), False),
        T.StructField("schema_json", T.StringType(), False),
    ]
)


def registry_from_folder(spark: SparkSession, path: str) -> DataFrame:
    """Registry of a folder laid out ``<vendor>/<name>/<format>/<version>``.

    The path is the key; a ``self`` block inside the file is not consulted.
    """
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    parts = F.split(F.url_decode(F.col("_metadata.file_path")), "/")
    version = F.split(F.element_at(parts, -1), "-")
    return files.select(
        F.element_at(parts, -4).alias("vendor"),
        F.element_at(parts, -3).alias("name"),
        F.get(version, F.lit(0)).try_cast("int").alias("model"),
        F.get(version, F.lit(1)).try_cast("int").alias("revision"),
        F.get(version, F.lit(2)).try_cast("int").alias("addition"),
        F.col("value").alias("schema_json"),
    ).where(F.col("model").isNotNull() & F.col("revision").isNotNull())


def resolve(discovered: DataFrame, registry: DataFrame) -> DataFrame:
    """Discovered versions with their schema text; NULL text where none is registered.

    Both sides are distinct schema versions, so the join needs no hint: the planner
    broadcasts the registry when its size allows and merges otherwise.
    """
    known = registry.select(*KEY, "schema_json").dropDuplicates(list(KEY))
    return discovered.join(known, list(KEY), "left").select(*discovered.columns, "schema_json")


def missing_schemas(discovered: DataFrame, registry: DataFrame) -> DataFrame:
    """Discovered versions that are not registered."""
    return discovered.join(registry.select(*KEY), list(KEY), "left_anti")


def clashing_schemas(discovered: DataFrame) -> DataFrame:
    """Column names that more than one schema asks for, with those schemas."""
    entities = discovered.select(*ENTITY).distinct()
    named = entities.select(
        entity_column_name(*[F.col(c) for c in ENTITY]).alias("column_name"),
        F.struct("vendor", "name").alias("owner"),
    )
    clashes = named.groupBy("column_name").agg(F.sort_array(F.collect_set("owner")).alias("owners"))
    texts = F.transform("owners", lambda o: F.concat_ws(".", o["vendor"], o["name"]))
    return clashes.where(F.size("owners") > 1).select("column_name", F.sort_array(texts).alias("schemas"))


def registered_versions(registry: DataFrame, models: DataFrame) -> DataFrame:
    """Every registered version of the given ``(vendor, name, model)`` rows."""
    return registry.select(*KEY, "schema_json").join(models, ["vendor", "name", "model"], "left_semi")


def schema_fields(registry: DataFrame) -> DataFrame:
    """One row per field of each registered version: its JSON type, format, required or not."""
    shape = "properties map<string,struct<type:string,format:string>>, required array<string>"
    parsed = registry.select(*KEY, F.from_json("schema_json", shape).alias("schema"))
    fields = parsed.select(*KEY, "schema.required", F.explode("schema.properties"))
    return fields.select(
        *KEY,
        F.col("key").alias("field"),
        F.concat_ws("/", "value.type", "value.format").alias("type"),
        F.coalesce(F.array_contains("required", F.col("key")), F.lit(False)).alias("required"),
    )


def field_history(discovered: DataFrame, registry: DataFrame) -> DataFrame:
    """How each field of the discovered entities stands across versions.

    All versions up to the newest discovered one count. A field missing from a version, or
    optional in one, is nullable; one with several types needs recovery columns.
    """
    position = F.struct("revision", "addition")
    newest = discovered.groupBy(*ENTITY).agg(F.max(position).alias("newest"))
    model = ["vendor", "name", "model"]
    versions = newest.join(registry.select(*KEY), model).where(position <= F.col("newest"))
    totals = versions.groupBy(*ENTITY).agg(F.count("*").alias("versions"))
    grouped = (
        newest.join(schema_fields(registry), model)
        .where(position <= F.col("newest"))
        .groupBy(*ENTITY, "field")
        .agg(
            F.sort_array(F.collect_set("type")).alias("types"),
            F.count("*").alias("present"),
            F.count_if("required").alias("required"),
        )
    )
    return grouped.join(totals, list(ENTITY)).select(
        *ENTITY,
        "field",
        "types",
        "versions",
        (F.col("required") < F.col("versions")).alias("nullable"),
        (F.size("types") > 1).alias("conflicting"),
    )
