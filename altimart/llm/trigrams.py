"""Boolean trigram queries that every match of a regular expression fulfils."""

from __future__ import annotations

from re import _constants as sre
from re import _parser

#: A query: any of these sets of trigrams must be in the text as a whole.  ``ALWAYS`` asks nothing.
Query = frozenset[frozenset[str]]
ALWAYS: Query = frozenset([frozenset()])
#: Strings that a part of a pattern is spelt out to, and sets of a query, before it asks less.
SPELLINGS, SETS = 64, 64


def folded(text: str) -> str:
    """A-Z in lower case, like the index."""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _simplest(sets) -> Query:
    """Without sets that ask for more than another one of the query."""
    kept: list[frozenset[str]] = []
    for s in sorted(set(sets), key=len):
        if not any(k <= s for k in kept):
            kept.append(s)
    return frozenset(kept)


def _both(a: Query, b: Query) -> Query:
    found = _simplest(x | y for x in a for y in b)
    # asking for less than is known is right: only more candidates are verified
    return found if len(found) <= SETS else min(a, b, key=len)


def _spelt(strings: set[str]) -> Query:
    """What a text asks for that holds one of these strings."""
    return _simplest(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _alternatives(op, arg) -> set[str] | None:
    """All strings that a part of a pattern can match, in lower case; None if they are too many."""
    if op is sre.LITERAL:
        return {folded(chr(arg))}
    if op is sre.IN:
        out: set[str] = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                out.add(folded(chr(value)))
            elif kind is sre.RANGE and value[1] - value[0] < SPELLINGS:
                out |= {folded(chr(c)) for c in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is sre.SUBPATTERN:
        return _exact(arg[3])
    if op is sre.BRANCH:
        parts = [_exact(p) for p in arg[1]]
        return None if None in parts else set().union(*parts)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] <= 4:
        once = _exact(arg[2])
        if once is None:
            return None
        out, now = set(), {""}
        for n in range(arg[1] + 1):
            out |= now if n >= arg[0] else set()
            now = {a + b for a in now for b in once}
            if len(out) + len(now) > SPELLINGS:
                return None
        return out
    if op is sre.AT:
        return {""}
    return None


def _exact(parts) -> set[str] | None:
    out = {""}
    for op, arg in parts:
        found = _alternatives(op, arg)
        if found is None or len(out) * len(found) > SPELLINGS:
            return None
        out = {a + b for a in out for b in found}
    return out


def _asked(op, arg) -> Query:
    """Of a part that is not spelt out."""
    if op is sre.SUBPATTERN:
        return _sequence(arg[3])
    if op is sre.BRANCH:
        found = _simplest(s for part in arg[1] for s in _sequence(part))
        return found if len(found) <= SETS else ALWAYS
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] > 0:
        return _sequence(arg[2])
    return ALWAYS


def _sequence(parts) -> Query:
    """Neighbouring parts are spelt out together as long as that stays small."""
    query, run = ALWAYS, {""}
    for op, arg in parts:
        found = _alternatives(op, arg)
        if found is not None and len(run) * len(found) <= SPELLINGS:
            run = {a + b for a in run for b in found}
            continue
        query = _both(query, _spelt(run))
        run = found or {""}
        if found is None:
            query = _both(query, _asked(op, arg))
    return _both(query, _spelt(run))


def trigram_query(pattern: str) -> Query:
    """Sets of lower-case (A-Z) trigrams; a text that the pattern matches holds all of one set.

    Literals, classes of few characters, groups, alternatives and short repeats are spelt out; what
    cannot be spelt out asks nothing and separates its neighbours.  ``ALWAYS``, a query with an
    empty set, is what a pattern without mandatory trigrams gives.
    """
    return _sequence(_parser.parse(pattern))
