"""Strict reading of post documents: which members each app needs, and the record a post becomes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from chainloom.contracts import FIELD
from chainloom.functions.typed import field, value

RECORD = f"struct<record:string,fields:array<{FIELD.simpleString()}>>"
RECORDS = f"array<{RECORD}>"

# Members of list elements, all text (fixed values).
ATTRIBUTE = ("traitType", "displayType", "value")
MEDIA = ("item", "type")
TEXT = None


@dataclass(frozen=True)
class AppRules:
    app_id: str
    text: tuple[str, ...]
    optional: tuple[str, ...]
    lists: tuple[tuple[str, tuple[str, ...] | None], ...]


# Rules per app (fixed values).
APPS = (
    AppRules(
        "Lenster",
        text=(
            "appId",
            "version",
            "metadata_id",
            "name",
            "content",
            "external_url",
            "mainContentFocus",
            "locale",
        ),
        optional=("image", "imageMimeType", "animation_url", "contentWarning"),
        lists=(("attributes", ATTRIBUTE), ("media", MEDIA), ("tags", TEXT)),
    ),
    AppRules(
        "phaver",
        text=("appId", "version", "metadata_id", "name", "content"),
        optional=("image", "imageMimeType"),
        lists=(("attributes", ATTRIBUTE), ("media", MEDIA)),
    ),
)


def _kind(document: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(document, path, "variant"))


def _is_text(document: Column, path: str) -> Column:
    return F.coalesce(_kind(document, path) == "STRING", F.lit(False))


def _is_optional_text(document: Column, path: str) -> Column:
    # An absent member and a JSON null both count as not given.
    return F.coalesce(_kind(document, path).isin("STRING", "VOID"), F.lit(True))


def _element_fits(element: Column, members: tuple[str, ...] | None) -> Column:
    if members is TEXT:
        return _is_text(element, "$")
    named = F.lit(True)
    for member in members:
        named = named & _is_text(element, f"$.{member}")
    # A list of the members in order is read the same way.
    listed = F.try_variant_get(element, "$", "array<variant>")
    in_order = (F.size(listed) == len(members)) & F.forall(listed, lambda m: _is_text(m, "$"))
    return F.coalesce(named, F.lit(False)) | F.coalesce(in_order, F.lit(False))


def _is_list(document: Column, path: str, members: tuple[str, ...] | None) -> Column:
    elements = F.try_variant_get(document, path, "array<variant>")
    return F.coalesce(F.forall(elements, lambda e: _element_fits(e, members)), F.lit(False))


def _follows(document: Column, rules: AppRules) -> Column:
    out = F.try_variant_get(document, "$.appId", "string") == rules.app_id
    for name in rules.text:
        out = out & _is_text(document, f"$.{name}")
    for name in rules.optional:
        out = out & _is_optional_text(document, f"$.{name}")
    for name, members in rules.lists:
        out = out & _is_list(document, f"$.{name}", members)
    return out


def parse_post(content: Column, uri: Column, table: str = "lens_posts_offchain") -> Column:
    """The records of a post document: one, or none when the text is not a post of a known app."""

    def record(document: Column) -> Column:
        known = F.lit(False)
        for rules in APPS:
            known = known | F.coalesce(_follows(document, rules), F.lit(False))

        def text(path: str) -> Column:
            return value(string=F.try_variant_get(document, path, "string"))

        fields = F.array(
            field("uri", value(string=uri)),
            field("app_id", text("$.appId")),
            field("name", text("$.name")),
            field("content", text("$.content")),
        )
        one = F.struct(F.lit(table).alias("record"), fields.alias("fields")).cast(RECORD)
        return F.when(known, one)

    # The one-element array binds the parsed document, so that the text is parsed once.
    parsed = F.transform(F.array(F.try_parse_json(content)), record)
    return F.filter(parsed, lambda r: r.isNotNull()).cast(RECORDS)
