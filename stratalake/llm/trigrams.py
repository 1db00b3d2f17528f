"""Boolean trigram queries: what a text must contain if a regular expression is to match in it.

A query is ``None`` (no condition), a trigram, or ``("and" | "or", [queries])``. Trigrams are in
lower case, so they hold for patterns in either case when looked up in lower-cased text; only ASCII
ones are asked for.
"""

from __future__ import annotations

import re
from functools import reduce

try:
    from re import _constants as sre
    from re import _parser as parser
except ImportError:  # before Python 3.11
    import sre_constants as sre
    import sre_parse as parser

#: Beyond so many alternatives a set of exact strings is turned into a query.
MAX_STRINGS = 64

Query = None | str | tuple[str, list]


def _join(kind: str, parts: list[Query]) -> Query:
    if kind == "or" and any(part is None for part in parts):
        return None
    flat: list = []
    for part in parts:
        if part is None:
            continue
        for x in part[1] if isinstance(part, tuple) and part[0] == kind else [part]:
            if x not in flat:
                flat.append(x)
    if not flat:
        return None
    return flat[0] if len(flat) == 1 else (kind, flat)


def _of_strings(strings: set[str]) -> Query:
    return _join("or", [
        _join("and", [s[i:i + 3] for i in range(len(s) - 2) if s[i:i + 3].isascii()])
        for s in sorted(strings)])


def _class(items: list) -> set[str] | None:
    """The characters of a class, lower-cased; None for a large or open one."""
    out: set[str] = set()
    for kind, value in items:
        if kind is sre.LITERAL:
            out.add(chr(value).lower())
        elif kind is sre.RANGE and value[1] - value[0] < 16:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _sequence(nodes) -> tuple[set[str] | None, Query]:
    """(all strings it can match, condition), or (None, condition) if they are too many."""
    exact: set[str] | None = {""}
    whole, known = True, []

    def flush() -> None:
        nonlocal exact, whole
        known.append(_of_strings(exact))
        exact, whole = {""}, False

    for kind, value in nodes:
        strings, query = None, None
        if kind is sre.LITERAL:
            strings = {chr(value).lower()}
        elif kind is sre.IN:
            strings = _class(value)
        elif kind is sre.AT:
            strings = {""}
        elif kind is sre.SUBPATTERN:
            strings, query = _sequence(value[3])
        elif kind is sre.BRANCH:
            parts = [_sequence(branch) for branch in value[1]]
            if all(part[0] is not None for part in parts):
                strings = set().union(*(part[0] for part in parts))
            query = _join("or", [_query(part) for part in parts])
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, body = value
            inner = _sequence(body)
            if (least, most) == (0, 1) and inner[0] is not None:
                strings = inner[0] | {""}
            elif least == most and inner[0] is not None and len(inner[0]) == 1:
                strings = {s * least for s in inner[0]}
            elif least:
                query = _query(inner)
        if strings is not None and len(strings) * len(exact) <= MAX_STRINGS:
            exact = {a + b for a in exact for b in strings}
        else:
            flush()
            known.append(_of_strings(strings) if strings is not None else query)
    if whole:
        return exact, None
    return None, _join("and", [*known, _of_strings(exact)])


def _query(part: tuple[set[str] | None, Query]) -> Query:
    return _of_strings(part[0]) if part[0] is not None else part[1]


def trigram_query(pattern: str) -> Query:
    """The condition for ``pattern``; None if it has no mandatory trigram."""
    return _query(_sequence(parser.parse(pattern, re.ASCII)))


def trigrams(query: Query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def holds(query: Query, has):
    """The condition as an expression; ``has(trigram)`` gives a column or a boolean."""
    if query is None:
        raise ValueError("a pattern without mandatory trigrams has no condition")
    if isinstance(query, str):
        return has(query)
    parts = [holds(part, has) for part in query[1]]
    return reduce(lambda a, b: a & b if query[0] == "and" else a | b, parts)
