"""The dotted cluster label: building, parsing, depth and prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slice_label(source: Column, style: Column) -> Column:
    """Label of one (source, style) slice; a missing part reads `none`."""
    none = F.lit("none")
    return F.concat(
        F.lit("source_"), F.coalesce(source, none), F.lit(".style_"), F.coalesce(style, none)
    )


def child_label(parent: Column, child: Column) -> Column:
    """Label of a sub-cluster; `child` is a number or one of noise / unclustered / failed."""
    return F.concat(parent, F.lit("."), child.cast("string"))


def label_depth(label: Column) -> Column:
    """Depth is the number of dots."""
    return (F.size(F.split(label, r"\.")) - 1).cast("int")


def _last_part(label: Column, prefix: str, default: Column) -> Column:
    hits = F.filter(F.split(label, r"\."), lambda part: part.startswith(prefix))
    return F.when(F.size(hits) > 0, F.replace(F.element_at(hits, -1), F.lit(prefix), F.lit(""))).otherwise(default)


def label_source(label: Column) -> Column:
    """Text after `source_` in the last part that carries it, else `unknown`."""
    return _last_part(label, "source_", F.lit("unknown"))


def label_style(label: Column) -> Column:
    """Text after `style_` in the last part that carries it, else null."""
    return _last_part(label, "style_", F.lit(None).cast("string"))


def label_ancestors(label: Column) -> Column:
    """The label and all its ancestors down to the slice (two parts)."""
    parts = F.split(label, r"\.")
    return F.transform(
        F.sequence(F.lit(2), F.greatest(F.size(parts), F.lit(2))),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."),
    )


def file_safe(label: Column) -> Column:
    """The label with dots replaced, for use in file names."""
    return F.translate(label, ".", "_")
