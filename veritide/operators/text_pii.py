"""Emails and phone numbers inside free text: where they stand, and the text with them masked.

One pattern finds both, from left to right; what one span covers starts no other, so spans never overlap. An email
starts where its local part does, and a phone number has no digit right before or after it. The gaps between the spans
and the spans themselves come from the same pattern, so their lengths give the places, and masking puts the text
together again from gaps and masked spans. All of it is made of column functions; no row moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritide.functions.mask import mask_email, mask_phone
from veritide.functions.names import exact

#: The contract's patterns without their anchors.
EMAIL_IN_TEXT = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_IN_TEXT = r"(?<![0-9])(?:\+?1[\s.-]?)?\(?[0-9]{3}\)?[\s.-]?[0-9]{3}[\s.-]?[0-9]{4}(?![0-9])"
ANY = f"{EMAIL_IN_TEXT}|{PHONE_IN_TEXT}"
SPAN = "struct<kind:string,start:int,stop:int,found:string>"


def kind_of(found: Column) -> Column:
    return F.when(F.contains(found, F.lit("@")), "email").otherwise("phone")


def _cut(text: Column) -> tuple[Column, Column]:
    """What was found, in order, and the gaps before, between and after."""
    return F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), F.split(text, ANY, -1)


def spans(text: Column) -> Column:
    """An array of ``kind``, ``start`` and ``stop`` (in characters) and ``found``; empty for a null text."""
    text = F.coalesce(text, F.lit(""))
    found, gaps = _cut(text)

    def placed(done: Column, pair: Column) -> Column:
        start = F.coalesce(F.try_element_at(done, F.lit(-1))["stop"], F.lit(0)) + F.length(pair["gap"])
        span = F.struct(
            kind_of(pair["found"]).alias("kind"),
            start.alias("start"),
            (start + F.length(pair["found"])).alias("stop"),
            pair["found"].alias("found"),
        )
        return F.concat(done, F.array(span))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, f: F.struct(g.alias("gap"), f.alias("found")))
    return F.aggregate(pairs, F.array().cast(f"array<{SPAN}>"), placed)


def masked(text: Column) -> Column:
    """The text with every email and phone number masked; null stays null."""
    found, gaps = _cut(text)
    hidden = F.transform(found, lambda f: F.when(kind_of(f) == "email", mask_email(f)).otherwise(mask_phone(f)))
    whole = F.array_join(F.zip_with(gaps, F.concat(hidden, F.array(F.lit(""))), lambda g, h: F.concat(g, h)), "")
    return F.when(F.size(found) > 0, whole).otherwise(text)


def text_spans(table: DataFrame, key: str, column: str) -> DataFrame:
    """``key``, ``kind``, ``start``, ``stop`` and ``found`` of every span in a text column, one row each."""
    return table.select(exact(key).alias(key), F.inline(spans(exact(column))))


def text_masked(table: DataFrame, *columns: str) -> DataFrame:
    """The table with its text columns masked, all other columns as they are."""
    return table.withColumns({c: masked(exact(c)) for c in columns})


def exposure(table: DataFrame, column: str) -> DataFrame:
    """One row: texts, those with an email, with a phone number and with either, and the spans of each kind."""
    kinds = F.transform(spans(exact(column)), lambda s: s["kind"])
    held = table.select(F.size(F.filter(kinds, lambda k: k == "email")).alias("e"), F.size(F.filter(kinds, lambda k: k == "phone")).alias("p"))
    return held.agg(
        F.count(F.lit(1)).alias("texts"),
        F.count_if(F.col("e") > 0).alias("with_email"),
        F.count_if(F.col("p") > 0).alias("with_phone"),
        F.count_if(F.col("e") + F.col("p") > 0).alias("with_any"),
        F.coalesce(F.sum("e"), F.lit(0)).alias("emails"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("phones"),
    )
