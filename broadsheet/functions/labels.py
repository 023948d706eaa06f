"""Label scalars and the text of heterogeneous inference items."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from broadsheet.config import LABEL_SYNONYMS, SITE_RULES, TEXT_FIELDS
from broadsheet.functions.binding import let
from broadsheet.functions.text import normalise, strip
from broadsheet.functions.urls import label_from_host, url_words


def canonical_label(raw: Column, synonyms=LABEL_SYNONYMS) -> Column:
    """Class id of a label spelling, null when the spelling is unknown."""

    def choose(key: Column) -> Column:
        chain = None
        for label, spellings in synonyms.items():
            hit = key.isin(*spellings)
            chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
        return chain.otherwise(F.lit(None).cast("int"))

    return let(strip(F.lower(raw.cast("string"))), choose)


def resolve_label(raw: Column | None, url: Column | None, rules=SITE_RULES, synonyms=LABEL_SYNONYMS) -> Column:
    """Explicit label if it is a known spelling, else the label of the URL's host."""
    options = []
    if raw is not None:
        options.append(canonical_label(raw, synonyms))
    if url is not None:
        options.append(label_from_host(url, rules))
    return F.coalesce(*options) if options else F.lit(None).cast("int")


def text_of_string(item: Column) -> Column:
    """A string item: URLs are read as words, anything else is normalised."""
    is_url = item.startswith("http://") | item.startswith("https://")
    return normalise(F.when(is_url, url_words(item)).otherwise(item))


def text_of_fields(fields: dict[str, Column], whole: Column) -> Column:
    """A record item: first filled text field, else its URL, else the record itself."""
    filled = [F.nullif(fields[name], F.lit("")) for name in TEXT_FIELDS if name in fields]
    if "url" in fields:
        filled.append(url_words(F.nullif(fields["url"], F.lit(""))))
    return normalise(F.coalesce(*filled, whole))


def text_of_map(item: Column) -> Column:
    """A ``MAP<STRING,STRING>`` item."""
    names = (*TEXT_FIELDS, "url")
    return text_of_fields({n: F.try_element_at(item, F.lit(n)) for n in names}, F.to_json(item))
