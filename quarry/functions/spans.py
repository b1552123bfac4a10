"""Where patterns match: spans (start, end) in code points, from 0, as native
SQL over a text column.

Spark's regex functions return what matched, not where.  So each match is put
between two marks, the text is split at them, and the lengths of the parts add
up to the starts.  The marks are private-use characters; a text that holds them
is searched with another character of equal length in their place (``searchable``),
which no pattern tells apart from them.

Sums and maxima over a prefix of an array go by blocks: of n elements they take
n * BLOCK / 2 steps, and (n / BLOCK)^2 / 2 for the blocks.
"""

from __future__ import annotations

OPEN, CLOSE, OTHER = "\ue000", "\ue001", "\ufffd"
BLOCK = 32
PAGE = 512


def sql_str(v: str) -> str:
    """A Spark SQL string literal (backslash and quote escaped)."""
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def searchable(text: str) -> str:
    """The text with no marks in it."""
    return f"CASE WHEN contains({text}, '{OPEN}') OR contains({text}, '{CLOSE}') THEN translate({text}, '{OPEN}{CLOSE}', '{OTHER}{OTHER}') ELSE {text} END"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def parts(text: str, pattern: str) -> str:
    """Outside, match, outside, match, .., outside; ``pattern`` is SQL whose group 1 is the match."""
    return f"split(regexp_replace({text}, {pattern}, '{OPEN}$1{CLOSE}'), '[{OPEN}{CLOSE}]', -1)"


def _div(x: str, by: int) -> str:
    return f"CAST(({x}) div {by} AS INT)"


def _blocks(values: str, fold: str) -> str:
    """``fold`` of all whole blocks before each block."""
    own = f"transform(sequence(0, {_div(f'size({values})', BLOCK)}), _b -> {fold.format(f'slice({values}, _b * {BLOCK} + 1, {BLOCK})')})"
    return let("_w", own, f"transform(_w, (_x, _b) -> {fold.format('slice(_w, 1, _b)')})")


def _before(values: str, at: str, fold: str, blocks: str, both: str) -> str:
    """``fold`` of the elements of ``values`` before the 0-based ``at``: of the whole blocks, then of the rest."""
    rest = fold.format(f"slice({values}, {_div(at, BLOCK)} * {BLOCK} + 1, ({at}) % {BLOCK})")
    return both.format(f"{blocks}[{_div(at, BLOCK)}]", rest)


_SUM = "aggregate({0}, 0, (_a, _x) -> _a + _x)"
_MAX = "coalesce(array_max({0}), 0)"
_PLUS, _LARGER = "({0} + {1})", "greatest({0}, {1})"


def of_parts(split: str) -> str:
    """array<struct<start, end>> of the matches in what ``parts`` returns (an empty array without a match)."""
    at = _before("_l", "2 * _k - 1", _SUM, "_s", _PLUS)
    item = let("_at", at, "named_struct('start', _at, 'end', _at + element_at(_l, 2 * _k))")
    spans = f"transform(sequence(1, {_div('size(_l) - 1', 2)}), _k -> {item})"
    body = let("_l", f"transform({split}, _x -> length(_x))", let("_s", _blocks("_l", _SUM), spans))
    return f"CASE WHEN size({split}) > 1 THEN {body} ELSE CAST(array() AS array<struct<start:int,end:int>>) END"


def block_starts(split: str, block: int) -> str:
    """array<int>: where each ``block`` elements of what ``parts`` returns start."""
    own = f"transform(sequence(0, {_div(f'size({split}) - 1', block)}), _b -> length(array_join(slice({split}, _b * {block} + 1, {block}), '')))"
    return let("_l", own, let("_s", _blocks("_l", _SUM), f"transform(_l, (_x, _k) -> {_before('_l', '_k', _SUM, '_s', _PLUS)})"))


def of_pattern(text: str, pattern: str) -> str:
    """The spans of a pattern in a text."""
    return let("_p", parts(text, pattern), of_parts("_p"))


def clusters(spans: str, key: str) -> str:
    """Spans that overlap become one: struct<start, end, best> in text order,
    ``best`` being the largest ``key`` (SQL over a span ``_x``) among them.  Spans
    that only touch stay apart."""
    reach = _before("_e", "_i - 1", _MAX, "_m", _LARGER)
    heads = f"filter(sequence(1, size(_o)), _i -> {reach} <= element_at(_o, _i).start)"
    group = "slice(_o, _h, (CASE WHEN _j + 1 < size(_hs) THEN _hs[_j + 1] ELSE size(_o) + 1 END) - _h)"
    item = let("_g", group, f"named_struct('start', _g[0].start, 'end', array_max(transform(_g, _x -> _x.end)), 'best', array_max(transform(_g, _x -> {key})))")
    body = let("_e", "transform(_o, _x -> _x.end)", let("_m", _blocks("_e", _MAX), let("_hs", heads, f"transform(_hs, (_h, _j) -> {item})")))
    return let("_o", f"sort_array({spans})", f"CASE WHEN size(_o) > 0 THEN {body} ELSE filter(transform(_o, _x -> named_struct('start', _x.start, 'end', _x.end, 'best', {key})), _x -> false) END")


def replaced(text: str, clustered: str, label: str) -> str:
    """The text with each cluster replaced by ``label`` (SQL over a cluster ``_c``)."""
    end = "(CASE WHEN _n > 0 THEN _cs[_n - 1].end ELSE 0 END)"
    # a substring is looked for from the start of its string, so a long text is cut into pages first
    pages = f"CASE WHEN length({text}) > {PAGE} THEN regexp_extract_all({text}, '(?s).{{1,{PAGE}}}', 0) ELSE array({text}) END"
    first = _div(end, PAGE)
    between = f"substring(array_join(slice(_ps, {first} + 1, {_div('_c.start', PAGE)} - {first} + 1), ''), {end} % {PAGE} + 1, _c.start - {end})"
    pieces = f"transform(_cs, (_c, _n) -> concat({between}, {label}))"
    tail = f"substring({text}, element_at(_cs, -1).end + 1)"
    return let("_cs", clustered, f"CASE WHEN size(_cs) > 0 THEN concat({let('_ps', pages, f"array_join({pieces}, '')")}, {tail}) ELSE {text} END")
