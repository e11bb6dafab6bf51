"""Text to tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_lower(*columns: str) -> Column:
    """The columns as one lower-case text, nulls as empty."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns]))


def ascii_tokens(text: Column) -> Column:
    """Runs of ``a-z0-9``; every other character splits. Repeats are kept."""
    return F.array_remove(F.split(text, "[^a-z0-9]+"), "")


def unicode_tokens(text: Column) -> Column:
    """Runs of letters and digits of any script."""
    return F.array_remove(F.split(text, r"[^\p{L}\p{N}]+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value worked out once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lookup(value: Column, entries: dict[str, Column]) -> Column:
    """The entry for ``value``, null if there is none; ``value`` is worked out once."""
    pairs = [part for key, entry in entries.items() for part in (F.lit(key), entry)]
    return F.try_element_at(F.create_map(*pairs), value)


def phrases(tokens: Column, longest: int, starts: list[str] | None = None) -> Column:
    """Tokens and the runs of up to ``longest`` neighbouring ones, joined by a blank.

    ``starts`` leaves out runs that begin with any other word.
    """

    def runs(words: Column) -> Column:
        places = F.when(F.size(words) > 0, F.sequence(F.lit(1), F.size(words)))
        if starts is not None:
            places = F.filter(places, lambda place: F.element_at(words, place).isin(starts))
        sizes = [F.lit(size) for size in range(2, longest + 1)]
        # A run cut short by the end of the text is one of the shorter runs.
        longer = F.transform(
            places,
            lambda place: F.array(*[F.array_join(F.slice(words, place, size), " ") for size in sizes]),
        )
        return F.concat(words, F.coalesce(F.flatten(longer), F.array().cast("array<string>")))

    return tokens if longest == 1 else let(tokens, runs)


def sorted_text(values: Column) -> Column:
    """Array members sorted and joined by a comma; null reads as empty."""
    return F.coalesce(F.array_join(F.sort_array(values), ", "), F.lit(""))


def without_scheme(url: Column) -> Column:
    return F.replace(F.replace(url, F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
