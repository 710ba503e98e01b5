"""Shape guards for landed API bodies (P9) and the GraphQL rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def body_shape(body: Column) -> Column:
    """``object``, ``list``, ``scalar``, or null where the text is not JSON."""
    schema = F.schema_of_variant(F.try_parse_json(body))
    return (
        F.when(schema.isNull(), F.lit(None).cast("string"))
        .when(schema.startswith("OBJECT"), "object")
        .when(schema.startswith("ARRAY"), "list")
        .otherwise("scalar")
    )


def object_or_null(status: Column, body: Column, raw: bool = False) -> Column:
    """The body if it is a JSON object. Error bodies count as null unless ``raw`` keeps them."""
    right = body_shape(body) == "object"
    return F.when(right if raw else right & (status == 200), body)


def graphql_body(status: Column, body: Column) -> Column:
    """A body with errors is still a body; any status but 200 leaves an empty object."""
    return F.when(status == 200, body).otherwise("{}")


def graphql_has_errors(status: Column, body: Column) -> Column:
    return F.get_json_object(graphql_body(status, body), "$.errors").isNotNull()
