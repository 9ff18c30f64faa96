"""Ordered regex rule packs and their column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def matches(col: Column, pattern: str) -> Column:
    """Case-insensitive search with Unicode case and word rules; null text is no match."""
    return F.coalesce(col.rlike("(?iuUd)" + pattern), F.lit(False))


@dataclass(frozen=True)
class RulePack:
    """Named patterns in priority order."""

    rules: tuple[tuple[str, str], ...]
    default: str = "unmatched_other"

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.rules]

    def pattern(self, name: str) -> str:
        return dict(self.rules)[name]

    def flag(self, col: Column, name: str) -> Column:
        return matches(col, self.pattern(name))

    def first_match(self, col: Column) -> Column:
        """Name of the first rule that hits, else the default."""
        hits = [F.when(matches(col, p), F.lit(name)) for name, p in self.rules]
        return F.coalesce(*hits, F.lit(self.default))

    def hit_names(self, col: Column) -> Column:
        """All rules that hit, in pack order."""
        hits = [F.when(matches(col, p), F.lit(name)) for name, p in self.rules]
        return F.array_compact(F.array(*hits))

    def hit_count(self, col: Column) -> Column:
        total = F.lit(0)
        for _, pattern in self.rules:
            total = total + matches(col, pattern).cast("int")
        return total


@dataclass(frozen=True)
class Taxonomy:
    """Labels, which of them are risky, and how rule tags map to labels."""

    labels: tuple[str, ...]
    out_of_scope: tuple[str, ...]
    high_risk: tuple[str, ...]
    tag_to_label: tuple[tuple[str, str], ...]
    fallback_tag: str = "unmatched_other"
    fallback_label: str = "Other / Out of Scope"
    non_english_tag: str = "non_english_out_of_scope"

    @property
    def all_labels(self) -> list[str]:
        return [*self.labels, *self.out_of_scope]

    def in_scope(self, col: Column) -> Column:
        return F.coalesce(col.isin(*self.labels), F.lit(False))

    def risky(self, col: Column) -> Column:
        return F.coalesce(col.isin(*self.high_risk), F.lit(False))

    def label_of(self, tag: Column) -> Column:
        """Label for a tag; an unknown or missing tag gives the fallback label."""
        return F.coalesce(_lookup(tag, self.tag_to_label), F.lit(self.fallback_label))

    def tag_of(self, label: Column) -> Column:
        """Tag for a label; null where the label has none."""
        return _lookup(label, tuple((b, a) for a, b in self.tag_to_label))


def _lookup(key: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    return F.when(key.isNotNull(), F.try_element_at(table, key))
