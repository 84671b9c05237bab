"""Small text and document expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def address_parts(full_address) -> dict[str, Column]:
    """``street, house, apt N`` split into typed parts; a bad number is NULL."""
    part = F.split(full_address, ", ")
    apartment = F.split(F.get(part, F.lit(2)), " ")
    return {
        "street": F.get(part, F.lit(0)),
        "house_number": F.get(part, F.lit(1)).try_cast("int"),
        "apartment": F.get(apartment, F.lit(1)).try_cast("int"),
    }


def document_id(field) -> Column:
    """Value of an extended-JSON object id (``{"$oid": "…"}``)."""
    return (F.col(field) if isinstance(field, str) else field).getField("$oid")


def document_time(field) -> Column:
    """Value of an extended-JSON date (``{"$date": "…Z"}``) as UTC wall-clock time."""
    text = (F.col(field) if isinstance(field, str) else field).getField("$date")
    return F.to_timestamp_ntz(F.regexp_replace(text, "Z$", ""))


def with_document(df: DataFrame, text: str, schema: str, into: str = "doc") -> DataFrame:
    """Add a JSON text as a struct column; text that is not valid gives a struct of NULLs.

    Exploding an array of one struct parses each text exactly once: filters
    and projections on the fields are not merged with the parser, which would
    otherwise run again for each of them.
    """
    return df.select("*", F.explode(F.array(F.from_json(F.col(text).cast("string"), schema))).alias(into))


BROKEN = "_broken_text"


def _with_reason(
    df: DataFrame, text: str, schema: str, required: list[str], options: dict[str, str] | None = None,
) -> DataFrame:
    """Add the parsed text (``__doc``) and the ``reason`` why it cannot be used, NULL if it can."""
    parsed = F.from_json(
        F.col(text).cast("string"), f"{schema}, {BROKEN} string", {**(options or {}), "columnNameOfCorruptRecord": BROKEN})
    doc = F.col("__doc")
    reason = F.when(doc.isNull() | doc[BROKEN].isNotNull(), F.lit("broken"))
    for field in required:
        value = reduce(lambda part, name: part[name], field.split("."), doc)
        reason = reason.when(F.get(F.array(value), F.lit(0)).isNull(), F.lit(f"missing {field}"))
    return df.select("*", F.explode(F.array(parsed)).alias("__doc")).withColumn("reason", reason)


def json_rejects(df: DataFrame, text: str, schema: str, required: list[str]) -> DataFrame:
    """Rows whose JSON text cannot be used, with the ``reason``: ``broken`` or ``missing <field>``.

    The complement of what a parser keeps.  All columns stay, so the text can be
    mended and sent again.  ``a.b`` requires a nested field.
    """
    return _with_reason(df, text, schema, required).where("reason is not null").drop("__doc")


def with_checked(
    df: DataFrame, text: str, schema: str, required: list[str], options: dict[str, str] | None = None,
) -> DataFrame:
    """``with_parsed`` that also adds the ``reason`` of ``json_rejects``, NULL for a usable row.

    The text is parsed once for those who keep both kinds of rows.
    """
    return _with_reason(df, text, schema, required, options).select(*df.columns, "__doc.*", "reason").drop(BROKEN)


def with_parsed(df: DataFrame, text: str, schema: str, keep: list[str] | None = None) -> DataFrame:
    """Add the fields of a JSON text as columns, next to all or only the ``keep`` columns."""
    kept = df.columns if keep is None else keep
    return with_document(df, text, schema, "__doc").select(*kept, "__doc.*")
