"""Tolerant decoding of queue messages and telemetry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def message_text(raw: Column) -> Column:
    """The text of a queue message: of a JSON object its string ``text``; text that is no JSON as it is; null
    for any other JSON."""
    v = F.try_parse_json(raw)
    field = F.try_variant_get(v, "$.text", "variant")
    is_object = F.schema_of_variant(v).startswith("OBJECT")
    return F.when(v.isNull(), raw).when(is_object & (F.schema_of_variant(field) == "STRING"), F.try_variant_get(v, "$.text", "string"))


def message_id(raw: Column) -> Column:
    """The id of a queue message as a string; null where it is missing or empty."""
    v = F.try_parse_json(raw)
    return F.nullif(F.try_variant_get(v, "$.id", "string"), F.lit(""))


def result(id_: Column, text: Column, label: Column, score: Column) -> Column:
    """A result message; a null id is left out."""
    return F.to_json(F.struct(id_.alias("id"), text.alias("text"), label.alias("label"), score.alias("score")))


def pair_key(request_id: Column, texts: Column) -> Column:
    """The request id, else a hash of the texts, else the empty string."""
    return F.when(F.coalesce(request_id, F.lit("")) != "", request_id).when(F.size(texts) > 0, F.sha2(F.concat_ws("\x1f", texts), 256)).otherwise("")


def body_texts(body: Column) -> Column:
    """The strings under ``texts`` of a request body, in order; none where it is no such object."""
    v = F.try_variant_get(F.try_parse_json(body), "$.texts", "array<variant>")
    strings = F.filter(v, lambda x: F.schema_of_variant(x) == "STRING")
    return F.coalesce(F.transform(strings, lambda x: F.try_variant_get(x, "$", "string")), F.array().cast("array<string>"))


def body_labels(body: Column) -> Column:
    """The labels under ``predictions`` of an answer's body ('' for one without a label); none where it is no such object."""
    v = F.try_variant_get(F.try_parse_json(body), "$.predictions", "array<variant>")
    return F.coalesce(F.transform(v, lambda x: F.coalesce(F.try_variant_get(x, "$.label", "string"), F.lit(""))), F.array().cast("array<string>"))
