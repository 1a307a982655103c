"""Oversized documents cut into pieces at natural boundaries, by structure-tree packing.

A document is a tree: sections under headings, blocks (paragraphs, HTML blocks, fenced code), list items by their
nesting, lines, sentences, clauses, words, characters. Sibling subtrees are merged up to the limit from the bottom; only
a node that is larger than the limit by itself is descended into, and its last part merges with the siblings behind it.
A heading stays with what follows it. All sizes are token counts of the document's own encoding, so a document is
encoded once for all limits and the tree is a sorted array of boundary positions per level.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from lexforge.llm.bpe import FOLDER
from lexforge.llm.packing import tokenizer

#: Names of the boundary levels, coarsest first: heading depths 1 to 6, then finer ones.
LEVELS = ("section1", "section2", "section3", "section4", "section5", "section6", "block", "item1", "item2", "item3", "line", "sentence", "clause", "word", "character")
_NEVER = len(LEVELS)
_BLOCK_LEVEL, _ITEM_LEVEL, _LINE_LEVEL, _SENTENCE_LEVEL, _CLAUSE_LEVEL, _WORD_LEVEL = map(LEVELS.index, ("block", "item1", "line", "sentence", "clause", "word"))

#: Tokens of each piece left unused, see cut_document.
SLACK = 2
#: A piece filled beyond this share takes nothing of the inside of an oversized node behind it.
SEALED = 0.7

_HEADING = re.compile(rb"^(?:(#{1,6})[ \t]+\S|(={1,6})[^=\n].*?={1,6}[ \t]*$|\xe2\x96\xa0|\\((?:sub){0,2})section\b)", re.M)
_BLOCK = re.compile(rb"\n[ \t\r]*\n\s*")
_LINE = re.compile(rb"\n")
_SENTENCE = re.compile(rb"(?:[.!?][\"')\]]*(?=\s)|\xe3\x80\x82(?!\xe3\x80\x8d|\xef\xbc\x89)|\xef\xbc\x81|\xef\xbc\x9f)")
_CLAUSE = re.compile(rb"(?:[,;:](?=\s)|\xe3\x80\x81|\xef\xbc\x8c|\xef\xbc\x9b)")
_FENCE = re.compile(rb"^(```|~~~).*?^\1[ \t]*$", re.M | re.S)
# An item's sign: Markdown bullets and numbers by their indentation, wiki signs by their number, rendered dots.
_ITEM = re.compile(rb"^(?:([ \t]*)(?:[-+*]|\d{1,3}[.)])[ \t]+|([*#:;]{1,6})[ \t]*(?=[^\s*#:;])|([ \t]*)\xe3\x83\xbb)", re.M)
_MARKUP = re.compile(rb"<(/?)(h[1-6]|ul|ol|dl|li|dt|dd|p|div|section|article|table|tr|blockquote|pre|figure|hr)\b[^<>]*>", re.I)


def _html_boundaries(data: bytes) -> list[tuple[int, int]]:
    """(offset, level) of the structures that HTML tags begin or end: headings, blocks, list items by nesting, rows."""
    out: list[tuple[int, int]] = []
    lists = 0
    for m in _MARKUP.finditer(data):
        tag = m[2].lower()
        if tag in (b"ul", b"ol", b"dl"):
            # an inner list belongs to the item it stands in
            out.append((m.end() if m[1] else m.start(), _BLOCK_LEVEL if lists <= (1 if m[1] else 0) else min(_ITEM_LEVEL + lists - 1, _LINE_LEVEL - 1)))
            lists = max(0, lists - 1) if m[1] else lists + 1
        elif tag in (b"li", b"dt", b"dd"):
            if not m[1]:
                out.append((m.start(), min(_ITEM_LEVEL + max(lists, 1) - 1, _LINE_LEVEL - 1)))
        elif tag == b"tr":
            out.append((m.end() if m[1] else m.start(), _LINE_LEVEL))
        elif tag[:1] == b"h" and tag != b"hr":
            if not m[1]:
                out.append((m.start(), tag[1] - 49))
        else:
            out.append((m.end() if m[1] else m.start(), _BLOCK_LEVEL))
    return out


def boundary_levels(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Level of each token boundary: the coarsest structure that begins at token i, ``_NEVER`` inside a character.

    ``starts`` are the tokens' byte offsets, followed by the length. Inside a fenced code block only lines part.
    """
    raw = np.frombuffer(data, dtype=np.uint8)
    level = np.full(len(starts), _NEVER, dtype=np.int8)
    inner = starts[:-1]
    first = raw[inner]
    level[:-1][(first & 0xC0) != 0x80] = _NEVER - 1
    level[:-1][(first == 32) | (first == 10)] = _WORD_LEVEL
    fences = np.array([m.span() for m in _FENCE.finditer(data)] if b"```" in data or b"~~~" in data else [], dtype=np.int64).reshape(-1, 2)

    def tokens_at(o: np.ndarray) -> np.ndarray:
        at = np.searchsorted(starts, o)
        return at[(at < len(starts)) & (starts[np.minimum(at, len(starts) - 1)] == o)]

    def outside(o: np.ndarray) -> np.ndarray:
        """Whether offsets are in no fence; its ends are not in it."""
        if len(fences) == 0:
            return np.ones(len(o), dtype=bool)
        at = np.searchsorted(fences[:, 0], o, "left") - 1
        return (at < 0) | (o >= fences[at, 1])

    def put(offsets: list[int], value: int) -> None:
        if offsets:
            o = np.array(offsets, dtype=np.int64)
            hit = tokens_at(o if value == _LINE_LEVEL else o[outside(o)])
            level[hit] = np.minimum(level[hit], value)

    put([m.end() for m in _CLAUSE.finditer(data)], _CLAUSE_LEVEL)
    put([m.end() for m in _SENTENCE.finditer(data)], _SENTENCE_LEVEL)
    put([m.end() for m in _LINE.finditer(data)], _LINE_LEVEL)
    blocks = [m.end() for m in _BLOCK.finditer(data)]
    put(blocks, _BLOCK_LEVEL)
    by_level: dict[int, list[int]] = {}
    for m in _ITEM.finditer(data):
        depth = len(m[2]) - 1 if m[2] else len((m[1] or m[3] or b"").expandtabs(4)) // 2
        by_level.setdefault(min(_ITEM_LEVEL + depth, _LINE_LEVEL - 1), []).append(m.start())
    headings: list[int] = []
    for m in _HEADING.finditer(data):
        depth = len(m[1] or m[2] or b"") or (1 + len(m[3]) // 3 if m[3] is not None else 2)
        by_level.setdefault(depth - 1, []).append(m.start())
        headings.append(m.start())
    for value, offsets in by_level.items():
        put(offsets, value)
    if b"<" in data:
        # tags often share a token ("><"): the boundary before that token stands for the one inside it
        tags = _html_boundaries(data)
        o = np.array([x for x, _ in tags], dtype=np.int64)
        at = np.searchsorted(starts, o, "right") - 1
        for k, free, (_, value) in zip(at.tolist(), outside(o).tolist(), tags):
            if free and level[k] != _NEVER:
                level[k] = min(level[k], value)
    # what follows a heading line is no place to part: only a sentence's end is preferred less
    lead = np.array(headings, dtype=np.int64)
    for h in lead[outside(lead)].tolist():
        end = data.find(b"\n", h)
        while end >= 0:
            at = tokens_at(np.array([end + 1]))
            level[at[(level[at] >= _BLOCK_LEVEL) & (level[at] < _WORD_LEVEL)]] = _CLAUSE_LEVEL
            if not data[end + 1 : end + 2].isspace():
                break
            end += 1
    return level


def pack_tree(level: np.ndarray, limit: int, *, first: int | None = None, least: int = 0) -> list[tuple[int, int, int]]:
    """(start, end, level cut at start): token ranges of at most ``limit`` that tile the document.

    The boundaries at or above a level are that level's children. Siblings are merged in order as long as they fit; a
    node larger than the limit is descended into, its parts being merged with what stands before (unless that is well
    filled) and behind it. A run of tokens without any boundary is cut by count. The first range has the limit
    ``first`` and is filled to at least ``least`` tokens, whatever must be descended into for that.
    """
    n = len(level) - 1
    first = limit if first is None else first
    at_level: dict[int, np.ndarray] = {}
    out: list[list[int]] = []
    sealed = False

    def inside(s: int, e: int, k: int) -> np.ndarray:
        if k not in at_level:
            at_level[k] = np.flatnonzero(level <= k)
        p = at_level[k]
        return p[np.searchsorted(p, s, "right") : np.searchsorted(p, e, "left")]

    stack = [(0, n, 0, 0)]  # start, end, finest level tried, level at the start
    while stack:
        s, e, k, own = stack.pop()
        most = first if len(out) < 2 else limit
        if out and not sealed and e - out[-1][0] <= most:
            out[-1][1] = e
            continue
        short = len(out) == 1 and out[0][1] < least
        if e - s <= (limit if out else first) and not short:
            out.append([s, e, own])
            sealed = False
            continue
        if out and not short and e - s > limit and out[-1][1] - out[-1][0] > SEALED * most:
            sealed = True
        cuts = inside(s, e, k)
        while len(cuts) == 0 and k < _NEVER - 1:
            k += 1
            cuts = inside(s, e, k)
        if len(cuts) == 0:
            # one character of more tokens than are left: cut by count
            room = first - out[0][1] if short else limit if out else first
            if short:
                out[0][1] = s + room
            else:
                out.append([s, min(e, s + room), own])
                sealed = False
            if s + room < e:
                stack.append((s + room, e, k, _NEVER))
            continue
        edges = [s, *cuts.tolist(), e]
        for a, b in reversed(list(zip(edges, edges[1:]))):
            stack.append((a, b, k + 1, own if a == s else int(level[a])))
    return [tuple(x) for x in out]


def cut_document(text: str, limits: list[tuple[int, int, int]], encoding) -> list[tuple]:
    """(limit_id, piece_no, token_start, token_end, n_overlap, cut, text) for each limit the document exceeds.

    ``limits`` are (limit_id, max_tokens, overlap_tokens). Each piece after the first begins ``overlap_tokens`` before
    the end of its predecessor, moved back to the start of that character if it falls inside one. The first piece has
    at least that many tokens, so no overlap is shorter (unless the overlap is not below the limit).

    A piece read by itself has the same tokens: merges never cross a boundary that the document's encoding kept, so
    both sides of it are encoded as before. Only the pattern that parts words can read a beginning differently (an
    apostrophe that now starts the text), by a token at most; SLACK leaves room for that.
    """
    data = text.encode("utf-8", "replace")
    if len(data) <= min((m for _, m, _ in limits), default=0):
        return []  # a token has at least one byte
    ids = encoding.encode_ordinary(text)
    todo = [x for x in limits if len(ids) > x[1]]
    if not todo:
        return []
    starts = np.zeros(len(ids) + 1, dtype=np.int64)
    np.cumsum(token_bytes(encoding)[np.array(ids, dtype=np.int64)], out=starts[1:])
    level = boundary_levels(data, starts)
    rows = []
    for limit_id, most, overlap in todo:
        fresh = max(1, most - overlap - (SLACK + 3 if overlap else SLACK))  # a character has at most three tokens more
        whole = max(1, most - SLACK)
        before = 0
        for no, (s, e, cut) in enumerate(pack_tree(level, fresh, first=whole, least=min(overlap, whole))):
            start = max(before, s - overlap) if no else s
            while start > before and level[start] == _NEVER:
                start -= 1
            piece = data[starts[start] : starts[e]].decode("utf-8", "replace")
            rows.append((limit_id, no, start, e, s - start, LEVELS[cut] if no and cut < _NEVER else "start" if not no else "token", piece))
            before = start
    return rows


_LENGTHS: dict[int, np.ndarray] = {}


def token_bytes(encoding) -> np.ndarray:
    """Bytes of each token id."""
    if id(encoding) not in _LENGTHS:
        _LENGTHS[id(encoding)] = np.array([len(encoding.decode_single_token_bytes(i)) for i in range(encoding.n_vocab)], dtype=np.int64)
    return _LENGTHS[id(encoding)]


_PIECE = "limit_id int, piece_no int, token_start int, token_end int, n_overlap int, cut string, text string"


def split_documents(documents: DataFrame, limits: DataFrame, *, key: str = "doc_id", text: str = "text", folder: str = FOLDER) -> DataFrame:
    """(key, limit_id, piece_no, token_start, token_end, n_overlap, cut, text) of every document over a ``piece`` limit.

    Without a shuffle; documents within a limit, null and empty texts give no rows for it. token_start and token_end
    are positions in the document's encoding, token_end - token_start is at most max_tokens, and the first n_overlap
    tokens are shared with the piece before. ``cut`` names the structure at whose start the piece's new part begins.
    """
    wanted = [(r["tokenizer"], r["limit_id"], r["max_tokens"], r["overlap_tokens"] or 0) for r in limits.filter("purpose = 'piece'").orderBy("limit_id").collect()]  # a few rows of settings
    by_tokenizer: dict[str, list[tuple[int, int, int]]] = {}
    for name, *rest in wanted:
        by_tokenizer.setdefault(name, []).append(tuple(rest))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [key, *(c.split(" ")[0] for c in _PIECE.split(", "))]
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at : at + 500]
                rows = [(k, *r) for name, own in by_tokenizer.items() for k, t in zip(part[key], part[text]) if t for r in cut_document(t, own, tokenizer(name, folder))]
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    return documents.select(key, text).mapInPandas(run, f"`{key}` {dict(documents.dtypes)[key]}, {_PIECE}")
