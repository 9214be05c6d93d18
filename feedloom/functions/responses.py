"""Readers for the answers of a tagging model.

The taxonomy is a short list of names and is planned as a literal array.  JSON is
checked as a whole by parsing it as the only element of an array, since the JSON
reader on its own accepts trailing text after a complete value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import stripped, without_fences, without_quotes

UNCATEGORIZED = "Uncategorized"
_STRICT = {"allowSingleQuotes": "false"}


def _names(taxonomy: Sequence[str]) -> Column:
    return F.array(*[F.lit(name) for name in taxonomy])


def _whole_json(text: Column, kind: str) -> Column:
    elements = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{kind}>", _STRICT)
    return F.when(F.size(elements) == 1, elements[0])


def _members(tags: Column, taxonomy: Sequence[str]) -> Column:
    return F.filter(tags, lambda tag: tag.isin(*taxonomy))


def _mentioned(text: Column, taxonomy: Sequence[str]) -> Column:
    low = F.lower(text)
    return F.filter(_names(taxonomy), lambda name: F.contains(low, F.lower(name)))


def _or_default(tags: Column) -> Column:
    return F.when(F.size(tags) > 0, tags).otherwise(F.array(F.lit(UNCATEGORIZED)))


def multi_tags(response: Column, taxonomy: Sequence[str]) -> Column:
    """Tags in one answer.

    A whole JSON list decides even when none of its names is known; otherwise the
    first bracketed list with a known name; otherwise every name found in the text.
    """
    text = without_fences(stripped(response))
    whole = _members(_whole_json(text, "array<string>"), taxonomy)
    bracketed = _members(_whole_json(F.regexp_extract(text, r"(?s)\[.*?\]", 0), "array<string>"), taxonomy)
    found = (
        F.when(whole.isNotNull(), whole)
        .when(F.size(F.coalesce(bracketed, F.array().cast("array<string>"))) > 0, bracketed)
        .otherwise(_mentioned(text, taxonomy))
    )
    return _or_default(found)


def single_tag(response: Column, taxonomy: Sequence[str]) -> Column:
    """The one tag of an answer: exact, then case-free, then containment either way."""
    text = without_quotes(stripped(response))
    low = F.lower(text)
    names = _names(taxonomy)
    same = F.filter(names, lambda name: F.lower(name) == low)
    near = F.filter(names, lambda name: F.contains(low, F.lower(name)) | F.contains(F.lower(name), low))
    return F.coalesce(
        F.when(text.isin(*taxonomy), text), F.get(same, F.lit(0)), F.get(near, F.lit(0)), F.lit(UNCATEGORIZED)
    )


def batch_tags(response: Column, position: Column, taxonomy: Sequence[str], fallback: Column, allow_multiple: bool = True) -> Column:
    """Tags of the item at `position` (from 1) in an answer that covers a batch.

    The answer is an object keyed by position.  A list or a bare name is accepted as
    value; anything else is Uncategorized.  Without `allow_multiple` the first known name of a
    list is the only tag.  An answer that is not JSON gives `fallback`.
    """
    text = without_fences(stripped(response))
    entries = _whole_json(text, "map<string,string>")
    # a value and nothing after it: it stands alone in an object as well as in an array
    is_json = F.lit(True)
    for left, right in (('{"v":', "}"), ("[", "]")):
        is_json = is_json & F.try_parse_json(F.concat(F.lit(left), text, F.lit(right))).isNotNull()
    value = F.try_element_at(entries, position.cast("string"))
    listed = _members(F.from_json(value, "array<string>", _STRICT), taxonomy)
    listed = listed if allow_multiple else F.slice(listed, 1, 1)
    tags = F.when(F.startswith(F.ltrim(value), F.lit("[")), _or_default(listed)).when(
        value.isin(*taxonomy), F.array(value)
    )
    default = F.array(F.lit(UNCATEGORIZED))
    return F.when(is_json, F.coalesce(tags, default)).otherwise(F.coalesce(fallback, default))
