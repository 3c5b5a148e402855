"""Small text helpers to write the checking SQL."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def clean(c: str) -> str:
    return f"nullif(trim(cast({c} as varchar)), '')"


def low(c: str) -> str:
    return f"lower(cast({c} as varchar))"


def yes(condition: str) -> str:
    return f"coalesce({condition}, false)"


def rnd(expression: str, digits: int) -> str:
    return f"cast(round(cast({expression} as decimal(30,8)), {digits}) as double)"


def total(expression: str) -> str:
    return f"fsum(cast({expression} as double))"  # compensated: right to the last digit


def mean(expression: str) -> str:
    return f"({total(expression)} / nullif(count({expression}), 0))"


def share(part: str, whole: str) -> str:
    return rnd(f"cast({part} as double) / nullif(cast({whole} as double), 0) * 100", 2)


def n_if(condition: str) -> str:
    return f"count(*) filter (where {condition})"


def any_word(c: str, words: Sequence[str]) -> str:
    return "(" + " or ".join(f"contains({c}, {quoted(w)})" for w in words) + ")"


def category(c: str, table: Iterable[tuple[str, Sequence[str]]], default: str) -> str:
    arms = " ".join(f"when {any_word(c, words)} then {quoted(name)}" for name, words in table)
    return f"case {arms} else {quoted(default)} end"


def cases(pairs: Iterable[tuple[str, str]], default: str) -> str:
    arms = " ".join(f"when {condition} then {quoted(value)}" for condition, value in pairs)
    return f"case {arms} else {quoted(default)} end"


def columns(prefix: str, names: str) -> str:
    return ", ".join(f"{prefix}.{n}" for n in names.split())
