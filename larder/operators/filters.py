"""Predicates as Columns. User values become literals of the plan; no SQL text is put together."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.constants import KCAL_CAP, OUTLIER_ITEMS, OUTLIER_KCAL, OUTLIER_MINUTES


def all_of(predicates: Sequence[Column]) -> Column:
    return reduce(and_, predicates, F.lit(True))


def any_of(predicates: Sequence[Column]) -> Column:
    return reduce(or_, predicates, F.lit(False))


def any_present(columns: Sequence[str]) -> Column:
    """At least one of the columns is known."""
    return any_of([F.col(c).isNotNull() for c in columns])


def all_present(columns: Sequence[str]) -> Column:
    return all_of([F.col(c).isNotNull() for c in columns])


@dataclass(frozen=True)
class Facets:
    """The dashboard's filter state. An absent facet filters nothing; a kcal bound drops unknown kcal."""

    scores: Sequence[str] = ()
    classes: Sequence[str] = ()
    kcal_min: float | None = None
    kcal_max: float | None = None

    @classmethod
    def from_state(cls, state: dict | None, floor: float = 0, cap: float = KCAL_CAP) -> Facets:
        """Facets of a client state; empty lists and sliders left at their ends count as absent."""
        state = state or {}
        low, high = state.get("kcal_min"), state.get("kcal_max")
        return cls(
            scores=tuple(state.get("nutri_scores") or ()),
            classes=tuple(state.get("cook_cats") or ()),
            kcal_min=None if low == floor else low,
            kcal_max=None if high == cap else high,
        )

    def __bool__(self) -> bool:
        return bool(self.scores or self.classes) or self.kcal_min is not None or self.kcal_max is not None

    def predicate(
        self, score: str = "nutri_score", time_class: str = "cook_time_category", kcal: str = "mit_energy_kcal"
    ) -> Column:
        parts = []
        if self.scores:
            parts.append(F.col(score).isin(*self.scores))
        if self.classes:
            parts.append(F.col(time_class).isin(*self.classes))
        if self.kcal_min is not None:
            parts.append(F.col(kcal) >= self.kcal_min)
        if self.kcal_max is not None:
            parts.append(F.col(kcal) <= self.kcal_max)
        return all_of(parts)

    def apply(self, df: DataFrame, **columns: str) -> DataFrame:
        return df.filter(self.predicate(**columns)) if self else df


def holds_text(column: str, text: str) -> Column:
    """Case-insensitive substring. ``%`` and ``_`` in the text are wildcards, a backslash is itself.

    Parts between ``%`` are looked for one after the other, each at its first place behind the one before, which is always
    enough; a pattern that tries their other places too takes a power of the text's length.
    """
    parts = [p for p in text.split("%") if p]
    if len(parts) > 1:
        # No text in lower case holds the mark that ends a quotation.
        quoted = [[F.concat(F.lit("\\Q"), F.lower(F.lit(q)), F.lit("\\E")) for q in p.split("_")] for p in parts]
        found = [F.concat(F.lit("(?>.*?"), F.concat_ws(".", *q), F.lit(")")) for q in quoted]
        return F.regexp(F.lower(column), F.concat(F.lit("(?s)\\A"), *found))
    return F.col(column).ilike("%" + text.replace("\\", "\\\\") + "%")


def usable(image: str = "has_image", kcal: str = "mit_energy_kcal", items: str = "n_ingredients_validated") -> Column:
    """Has an image, known energy and at least one ingredient; unknown counts as no."""
    return F.coalesce(F.col(image), F.lit(False)) & F.col(kcal).isNotNull() & (F.coalesce(F.col(items), F.lit(0)) > 0)


def outlying(limits: dict[str, float] | None = None) -> Column:
    """Any of the columns strictly above its limit."""
    limits = limits or {
        "n_ingredients_validated": OUTLIER_ITEMS,
        "mit_energy_kcal": OUTLIER_KCAL,
        "cook_minutes": OUTLIER_MINUTES,
    }
    return any_of([F.col(c) > limit for c, limit in limits.items()])


def long_enough(item: str, floor: int = 1) -> Column:
    """Trimmed length above the floor; null fails."""
    return F.length(F.trim(F.col(item))) > floor
