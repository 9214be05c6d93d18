"""Text expressions: quality rule, clean-up and numbered sample blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Answers that carry no content, compared after upper(trim(text)).
EMPTY_ANSWERS = ("NA", "N/A", "N.A.", "N.A", "NOT APPLICABLE")


# Fixed value: a Markdown fence, opening with its json mark or closing.
FENCE = r"```json\s*|\s*```"


def has_content(text: Column) -> Column:
    """True for a text worth analysing.  Only blanks are trimmed, tabs are kept."""
    bare = F.trim(text)
    return (
        text.isNotNull()
        & (bare != "")
        & text.rlike("[A-Za-z0-9]")
        & ~F.upper(bare).isin(*EMPTY_ANSWERS)
    )


def normalised(text: Column) -> Column:
    """Lower-case form used for embedding, on the stored and on the query side alike."""
    return F.lower(text)


def without_fences(text: Column) -> Column:
    """Drop Markdown code fences, with the `json` mark and the blanks around them."""
    return F.regexp_replace(text, FENCE, "")


def without_quotes(text: Column) -> Column:
    """Strip single and double quotes from both ends."""
    return F.regexp_replace(text, r"""^["']+|["']+$""", "")


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def numbered_block(texts: Column, width: int | None = None) -> Column:
    """`1. first text`, `2. second text`, ... joined by newlines; with `width`, each cut to so many characters."""
    lines = F.transform(
        texts,
        lambda t, i: F.concat((i + 1).cast("string"), F.lit(". "), F.substring(t, 1, width) if width else t),
    )
    return F.array_join(lines, "\n")
