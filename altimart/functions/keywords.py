"""Many keywords in one pass over a text."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from altimart.functions.tagging import first_true


class Keywords:
    """All words that some tests ask for, compiled to one pattern.

    ``found`` is one search that lists the words a text holds.  The pattern looks ahead without
    moving on, so words that overlap are all seen.  At one place it reports the longest word only; a
    word that begins another one is in the text wherever that one is, and the tests know it.
    Tests are lookups in that short list, however many of them there are.
    """

    def __init__(self, *tables: Iterable[str]):
        self.words = sorted({w for table in tables for w in table}, key=lambda w: (-len(w), w))
        if not all(self.words):
            raise ValueError("a keyword is empty")

    @property
    def pattern(self) -> str:
        firsts: dict[str, list[str]] = {}
        for word in self.words:  # longest first below each first letter
            firsts.setdefault(word[0], []).append(word[1:])
        parts = [re.escape(c) + "(?:" + "|".join(map(re.escape, rest)) + ")" for c, rest in sorted(firsts.items())]
        return f"(?=({'|'.join(parts)}))"

    def found(self, text: Column) -> Column:
        """Which of the words a text (already lower-case) holds; NULL for a NULL text."""
        if not self.words:
            return F.when(text.isNotNull(), F.array().cast("array<string>"))
        return F.array_distinct(F.regexp_extract_all(text, F.lit(self.pattern), F.lit(1)))

    def _implying(self, words: Sequence[str]) -> Column:
        unknown = set(words) - set(self.words)
        if unknown:
            raise ValueError(f"not among the keywords: {sorted(unknown)}")
        return F.array(*[F.lit(w) for w in self.words if any(w.startswith(asked) for asked in words)])

    def any(self, found: Column, words: Sequence[str]) -> Column:
        """The text holds one of the words; NULL for a NULL text."""
        return F.arrays_overlap(found, self._implying(words))

    def all(self, found: Column, words: Sequence[str]) -> Column:
        return reduce(and_, [self.any(found, [w]) for w in words])

    def category(self, found: Column, table: Iterable[tuple[str, Sequence[str]]], default: str = "other") -> Column:
        """The first category of which the text holds a word."""
        return first_true([(self.any(found, words), name) for name, words in table], default)
