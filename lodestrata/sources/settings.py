"""Settings and listings kept as JSON: read with a schema, a wrong one is an error, a missing one is none."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PROFILES = "profiles map<string,struct<logLevel:string,migrations:struct<directory:string,modelApiKey:string,template:string,tsconfig:string>,baseUrl:string>>"
LISTING = "id string, namespace string, endpoints array<struct<name:string,rawName:string,urlTemplate:string,entityIdPlaceholders:array<string>,requestBodyRequired:boolean>>"


def read_settings(spark: SparkSession, path: str, schema: str = PROFILES) -> DataFrame | None:
    """The settings at a path; None if there are none. What doesn't fit the schema ends the read with an error."""
    try:
        return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_listing(spark: SparkSession, *paths: str) -> DataFrame:
    """The resources of an API from the first path that there is."""
    for path in paths:
        found = read_settings(spark, path, LISTING)
        if found is not None:
            return found
    raise FileNotFoundError(", ".join(paths))


def endpoints(listing: DataFrame) -> DataFrame:
    """(resource, method, raw_name, n_ids, needs_body): a row for each call that a listing has."""
    each = listing.select(F.col("id").alias("resource"), F.explode("endpoints").alias("e"))
    return each.select("resource", F.col("e.name").alias("method"), F.col("e.rawName").alias("raw_name"), F.size("e.entityIdPlaceholders").alias("n_ids"), F.coalesce("e.requestBodyRequired", F.lit(False)).alias("needs_body"))


def relaxed(text: Column, schema: str) -> Column:
    """JSON as people write it: bare names, single quotes, comments, leading zeros and trailing marks of numbers."""
    options = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true", "allowComments": "true", "allowNumericLeadingZeros": "true", "allowBackslashEscapingAnyCharacter": "true", "allowNonNumericNumbers": "true"}
    return F.from_json(text, schema, options)
