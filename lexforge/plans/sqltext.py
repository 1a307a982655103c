"""Pieces of DuckDB SQL that the queries' oracles share: blanks, Unicode normalization and character classes.

DuckDB has NFC but neither NFKC nor case folding; both are joins with small tables that are built here by rule from the
Unicode database. A query that uses them names ``FOLDING`` among its common table expressions.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from lexforge.functions import charset

#: Blanks for DuckDB's RE2, as in strings.BLANK.
B = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

_PARTED = "\x1d"
# No character beyond has a compatibility decomposition or a case.
_ALL = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _table(pairs: dict[str, str]) -> str:
    return f"(SELECT unnest(string_split({literal(''.join(pairs))}, '')) AS c, unnest(string_split({literal(_PARTED.join(pairs.values()))}, '{_PARTED}')) AS r)"


@lru_cache(maxsize=1)
def _folding() -> str:
    compatible = {c: k for c in _ALL if c > "\x7f" and (k := unicodedata.normalize("NFKD", c)) != unicodedata.normalize("NFD", c)}
    folded = {c: c.casefold() for c in _ALL if c.casefold() != c}
    return f"nf AS MATERIALIZED {_table(compatible)}, cf AS MATERIALIZED {_table(folded)}"


#: Common table expressions nf (compatibility decompositions) and cf (case foldings).
FOLDING = _folding()


def _mapped(x: str, table: str) -> str:
    each = f"SELECT unnest(string_split({x}, '')) AS _c, unnest(range(len(string_split({x}, '')))) AS _i"
    return f"CASE WHEN {x} IS NOT NULL THEN coalesce((SELECT string_agg(coalesce(_m.r, _u._c), '' ORDER BY _u._i) FROM ({each}) _u LEFT JOIN {table} _m ON _m.c = _u._c), '') END"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{B}+|{B}+$', '', 'g')"


def sql_nfkc(x: str) -> str:
    return f"nfc_normalize({_mapped(x, 'nf')})"


def sql_title(x: str) -> str:
    """strings.nfkc_title."""
    return sql_strip(sql_nfkc(x))


def sql_key(x: str) -> str:
    """strings.index_key; ``x`` is a column."""
    return f"(SELECT nullif({sql_strip(f"regexp_replace({_mapped('_n', 'cf')}, '{B}+', ' ', 'g')")}, '') FROM (SELECT {sql_nfkc(x)} AS _n) _t)"


def _representable() -> str:
    return f"rep AS MATERIALIZED (SELECT unnest(string_split({literal(''.join(filter(charset.is_representable, _ALL[:0xF800])))}, '')) AS c)"


def _wide() -> str:
    """Ranges of the wide and full-width characters as a character class."""
    codes = [c for c in range(0x1100, 0x40000) if not 0xD800 <= c < 0xE000 and charset.width_of(chr(c)) == "wide"]
    starts = [c for c, before in zip(codes, [-1, *codes]) if c != before + 1]
    ends = [c for c, after in zip(codes, [*codes[1:], -1]) if c != after - 1]
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in zip(starts, ends)) + "]"


#: Common table expression rep(c): the representable characters.
REPRESENTABLE = _representable()
_WIDE = _wide()


def sql_width(ch: str) -> str:
    return f"CASE WHEN regexp_matches({ch}, '{_WIDE}') THEN 'wide' ELSE 'narrow' END"


def sql_class(ch: str, rep: str) -> str:
    """charset.class_of for an assigned character; ``rep`` tells whether it is representable."""
    return f"CASE WHEN {rep} THEN 'A' WHEN regexp_matches({ch}, '[\\x{{A0}}‘’“”\\x{{FE00}}-\\x{{FE0F}}\\x{{E0100}}-\\x{{E01EF}}]') THEN 'B' WHEN regexp_matches({ch}, '[\\p{{Cc}}\\p{{Cf}}\\p{{Co}}]') THEN 'D' ELSE 'C' END"
