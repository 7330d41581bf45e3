"""SQL texts for work inside one row, in time nearly in proportion to the length of its arrays and texts.

Extending an array copies it, and finding a place in a text reads all before it. So a pass over an array goes by blocks of the
square root of its length, and a text that is cut in many places is first cut into short pieces.
"""

from __future__ import annotations

PIECE = 1000  # characters


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` for ``value``, which is computed once, also where the body uses it in lambdas."""
    return f"transform(array({value}), {name} -> {body})[0]"


def running(array: str, state: dict[str, tuple[str, str]], value: str, kind: str) -> str:
    """An array with ``value`` (of type ``kind``) for each element ``x``, in order. The value sees the state as ``s``: each
    field begins with its first text and goes on with its second, in which ``s`` is the state before and ``x`` the element."""
    first, step = (", ".join(f"{v[i]} as {n}" for n, v in state.items()) for i in (0, 1))
    inward, outward = (", ".join(f"{r}.{n} as {n}" for n in state) for r in ("o_", "r_"))
    added = f"concat(s.out, array(cast({value} as {kind})))"
    block = f"aggregate(b_, struct({inward}, cast(array() as array<{kind}>) as out), (s, x) -> struct({step}, {added} as out))"
    after = let(block, "r_", f"struct({outward}, concat(o_.out, array(r_.out)) as out)")
    size = "cast(ceil(sqrt(size(v_))) as int)"
    blocks = f"transform(sequence(0, cast((size(v_) - 1) div n_ as int)), i_ -> slice(v_, i_ * n_ + 1, n_))"
    start = f"struct({first}, cast(array() as array<array<{kind}>>) as out)"
    passed = let(size, "n_", f"aggregate({blocks}, {start}, (o_, b_) -> {after}, o_ -> flatten(o_.out))")
    return let(array, "v_", f"if(size(v_) > 0, {passed}, cast(array() as array<{kind}>))")


def _between(a: str, b: str) -> str:
    """Characters ``a`` to ``b`` of the text whose pieces are ``t_``."""
    i, j = f"cast({a} div {PIECE} as int)", f"cast({b} div {PIECE} as int)"
    begin, end = f"substring(t_[{i}], {a} % {PIECE} + 1)", f"coalesce(substring(get(t_, {j}), 1, {b} % {PIECE}), '')"
    middle = f"array_join(slice(t_, {i} + 2, {j} - {i} - 1), '')"
    inside = f"substring(t_[{i}], {a} % {PIECE} + 1, {b} - {a})"
    return f"if({a} >= {b}, '', if({i} = {j}, {inside}, concat({begin}, {middle}, {end})))"


def replaced(text: str, spans: str, put: str) -> str:
    """The text with each span (``start`` and ``end`` in characters, in order of their start) replaced by ``put``, which sees
    the span as ``x``. A span that begins inside another is part of it."""
    kind = "struct<a:int,b:int,put:string>"
    state = {"at": ("0", "greatest(s.at, cast(x.end as int))")}
    gaps = running("w_", state, f"if(x.start >= s.at, struct(s.at, x.start, {put}), null)", kind)
    rest = f"struct(array_max(transform(w_, x -> x.end)), char_length({text}), '')"
    parts = f"concat(filter({gaps}, g -> g is not null), array(cast({rest} as {kind})))"
    joined = f"array_join(transform({parts}, g -> concat({_between('g.a', 'g.b')}, g.put)), '')"
    pieces = f"regexp_extract_all({text}, '(?s).{{1,{PIECE}}}', 0)"
    return let(spans, "w_", f"if(size(w_) > 0, {let(pieces, 't_', joined)}, {text})")
