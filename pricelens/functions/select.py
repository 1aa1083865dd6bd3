"""Selecting nodes from a shredded page, as JVM Column expressions.

A selector such as ``div.margin div.detail-info.mt-10 div.right > a`` is a
chain of steps over nodes numbered in document order, each with the number of
its last descendant.  A child step looks its parent up by number.  A descendant
step asks whether a node lies inside one of the nodes selected so far: of those
only the outermost count, which are disjoint intervals in order, so one binary
search answers it.  The work grows with the nodes of a page (times a logarithm),
not with the depth it nests to.

Supported syntax: type, ``.class``, ``#id``, ``*``, descendant (space) and
child (``>``) combinators.  Attribute predicates, positions and text tests
are plain Column lambdas (``has_attr``, ``attr_contains``, ``nth_of_type``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPOUND = re.compile(r"([a-zA-Z][a-zA-Z0-9-]*|\*)?((?:[.#][^.#\s>]+)*)")


def _esc(name: str) -> str:
    return (name.replace("%", "%25").replace("/", "%2F")
            .replace(".", "%2E").replace("#", "%23"))


def _parts(compound: str) -> tuple[str | None, str | None, list[str]]:
    """(tag, id, classes) of one compound; null where it does not say."""
    m = _COMPOUND.fullmatch(compound)
    if not m or not compound:
        raise ValueError(f"unsupported selector part: {compound!r}")
    ident, classes = None, []
    for kind, name in re.findall(r"([.#])([^.#]+)", m.group(2)):
        if kind == "#":
            ident = name
        else:
            classes.append(name)
    tag = m.group(1)
    return tag.lower() if tag and tag != "*" else None, ident, classes


def _chain(css: str) -> list[list[tuple]]:
    """The selector as runs of child steps; a run lies anywhere inside the one before."""
    runs, child = [], False
    for tok in re.findall(r">|[^\s>]+", css.strip()):
        if tok == ">":
            child = True
            continue
        if child and runs:
            runs[-1].append(_parts(tok))
        else:
            runs.append([_parts(tok)])
        child = False
    if not runs:
        raise ValueError("empty selector")
    return runs


# The expressions are put together as SQL text: a selector is some hundred
# nested calls, and one parse is far cheaper than building them one by one.
def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(n: str, part: tuple) -> str:
    """Whether node ``n`` is what one compound asks for; the cheapest test first."""
    tag, ident, classes = part
    tests = [] if tag is None else [f"{n}.tag = {_quoted(tag)}"]
    if ident is not None:
        tests.append(f"{n}.id <=> {_quoted(ident)}")
    return " AND ".join(tests + [f"array_contains({n}.classes, {_quoted(c)})" for c in classes]) or f"{n}.tag IS NOT NULL"


def _run_test(nodes: str, run: list[tuple], inside: str | None) -> str:
    """Whether node ``n`` ends a run of child steps whose top lies in the intervals ``inside``."""
    n, tests = "n", [_matches("n", run[-1])]
    for part in reversed(run[:-1]):
        n = f"get({nodes}, {n}.parent)"
        tests.append(_matches(n, part))
    if inside:
        tests.append(_lies_inside(f"{n}.ord", inside))
    return f"coalesce({' AND '.join(tests)}, false)"


def _outermost(selected: str) -> str:
    """The intervals of the selected nodes that lie in no other one, in order.
    Mostly none lies in another, and nothing needs gathering one by one."""
    spans = f"transform({selected}, n -> named_struct('lo', n.ord, 'hi', n.last))"
    rest = "greatest(size(s) - 1, 0)"
    nested = f"exists(zip_with(slice(s, 1, {rest}), slice(s, 2, {rest}), (a, b) -> b.lo <= a.hi), x -> x)"
    kept = "aggregate(s, cast(array() AS array<struct<lo:int,hi:int>>), (out, i) -> " \
           "if(size(out) > 0 AND coalesce(i.lo <= get(out, size(out) - 1).hi, false), out, concat(out, array(i))))"
    return f"get(transform(array({spans}), s -> if({nested}, {kept}, s)), 0)"


def _lies_inside(place: str, intervals: str) -> str:
    """Binary search: the last interval that starts before the place ends behind it."""
    few = f"exists({intervals}, i -> i.lo < {place} AND {place} <= i.hi)"
    mid = "shiftright(s.lo + s.hi, 1)"
    found = f"aggregate(sequence(0, cast(ceil(log2(size({intervals}) + 1)) AS int)), named_struct('lo', 0, 'hi', size({intervals})), (s, _) -> " \
            f"CASE WHEN s.lo >= s.hi THEN s WHEN get({intervals}, {mid}).lo < {place} THEN named_struct('lo', {mid} + 1, 'hi', s.hi) " \
            f"ELSE named_struct('lo', s.lo, 'hi', {mid}) END).lo"
    return f"if(size({intervals}) <= 8, {few}, coalesce(get({intervals}, {found} - 1).hi >= {place}, false))"


def select(nodes, css: str, where=None) -> Column:
    """Nodes matching ``css`` (document order); ``where`` adds a lambda.
    ``nodes`` names the column, or is it."""
    name = nodes if isinstance(nodes, str) else nodes._jc.toString()
    if not re.fullmatch(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)*", name):
        raise ValueError(f"select needs a column, not an expression: {name}")
    runs = _chain(css)
    out = f"filter({name}, n -> {_run_test(name, runs[0], None)})"
    for k, run in enumerate(runs[1:]):
        # one element to transform: the intervals are computed once, not for every node
        out = f"get(transform(array({_outermost(out)}), o{k} -> filter({name}, n -> {_run_test(name, run, f'o{k}')})), 0)"
    return F.expr(out) if where is None else F.filter(F.expr(out), where)


# ---- the same selectors over css_path: a debugging aid and an independent check --
def _segment_rx(compound: str) -> str:
    tag, ident, classes = _parts(compound)
    rx = re.escape(tag) if tag else "[a-z0-9-]+"
    rx += ("#" + re.escape(_esc(ident))) if ident else "(?:#[^/.]*)?"
    for c in classes:
        rx += r"(?=(?:\.[^/.]+)*\." + re.escape(_esc(c)) + r"(?:[./]|$))"
    return rx + r"(?:\.[^/.]+)*"


def selector_regex(css: str) -> str:
    """Anchored regex over ``parse_nodes``' css_path that finds what ``css`` selects."""
    out = ""
    for run in re.split(r"\s+", re.sub(r"\s*>\s*", ">", css.strip())):
        parts = [p for p in run.split(">") if p]
        if not parts:
            raise ValueError("empty selector")
        out += ("(?:/[^/]+)*/" if out else "^(?:/[^/]+)*/") + "/".join(_segment_rx(p) for p in parts)
    return out + "$"


def attr(n: Column, name: str) -> Column:
    return F.try_element_at(n["attrs"], F.lit(name))


def has_attr(name: str):
    return lambda n: F.map_contains_key(n["attrs"], F.lit(name))


def attr_contains(name: str, needle: str):
    """XPath contains(@name, needle): false when the attribute is absent."""
    return lambda n: F.coalesce(F.instr(attr(n, name), needle) > 0, F.lit(False))


def attr_equals(name: str, value: str):
    return lambda n: F.coalesce(attr(n, name) == F.lit(value), F.lit(False))


def first_text_contains(needle: str):
    """XPath contains(text(), needle): tests the first direct text node."""
    return lambda n: F.coalesce(F.instr(F.get(n["texts"], 0), needle) > 0, F.lit(False))


def first_text_nonempty():
    """XPath string-length(text()) > 0 on the first direct text node."""
    return lambda n: F.coalesce(F.length(F.get(n["texts"], 0)) > 0, F.lit(False))


def nth_of_type(k: int):
    """XPath tag[k]: k-th among same-tag siblings (1-based)."""
    return lambda n: n["sib_tag_pos"] == k


def attrs_of(sel: Column, name: str) -> Column:
    """@name of each selected node that has it (like xpath '.../@name')."""
    return F.transform(F.filter(sel, has_attr(name)), lambda n: attr(n, name))


def texts_of(sel: Column) -> Column:
    """All direct text nodes of the selected nodes, in order (text())."""
    return F.flatten(F.transform(sel, lambda n: n["texts"]))


def first(arr: Column) -> Column:
    """extract_first(): null when empty (never raises under ANSI)."""
    return F.get(arr, 0)


def nth(arr: Column, k: int) -> Column:
    return F.get(arr, k)


def last(arr: Column) -> Column:
    return F.get(arr, F.size(arr) - 1)


def tail(arr: Column, skip: int = 1) -> Column:
    """Python list[skip:]."""
    return F.slice(arr, skip + 1, F.greatest(F.size(arr) - skip, F.lit(0)))
