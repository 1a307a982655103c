"""Byte-pair encoding of a whole corpus by DuckDB recursive queries inside each partition.

A text is cut into words by the tokenizer's pattern, each distinct word of a task is encoded once, and documents are
put together from the words' ids. Encoding is relational: rows (word, position, token) join the merge table, every
word contracts its leftmost pair of minimum rank, and recursion goes on until no pair is left; an ordered aggregation
then gives the ids.

Two exact refinements keep the recursion shallow. Words are first cut where no token of the vocabulary can span the
boundary. And besides the leftmost minimum-rank pair, each step also contracts every pair that nothing can take apart
before its turn: its rank is lower than both neighbours' and lower than any merge in which a longer neighbour (one that
ends, or starts, like the present one) could take either half. Merge ranks never decrease while BPE runs, so such a
pair is contracted by BPE in any case. The few words that are not at their fixpoint after some steps (long ones without
any blank) are cut once more, where no token contains both neighbours, and contract every occurrence of a part's
minimum-rank pair per step.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the public tokenizers' files.
FOLDER = "/opt/tokenizers"
#: The pattern of the byte-level BPE tokenizers (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries after which a task's memory of encoded words starts afresh.
REMEMBER = 400_000


class Vocabulary(NamedTuple):
    """Merge table and what follows from it, as arrays small enough to broadcast (the vocabulary bounds them)."""

    byte_ids: np.ndarray  # id of each byte
    merges: np.ndarray  # rows: left id, right id, rank, merged id
    left_thief: np.ndarray  # rows: token, right id, lowest rank of a merge of a longer token ending in token with right id
    right_thief: np.ndarray  # rows: left id, token, lowest rank of a merge of left id with a longer token starting with token
    texts: list  # letters of each token, by id
    all_texts: str  # all of them, parted by a sign that none contains
    spans: dict  # by the two bytes at it: (end of left side, start of right side) of the inner boundaries of all tokens, four bytes at most


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself if printable, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


@lru_cache(maxsize=4)
def load_vocabulary(name: str = "byte_bpe_50k", folder: str = FOLDER) -> Vocabulary:
    """Read a byte-level BPE vocabulary (``<folder>/<name>.json``)."""
    model = json.loads(Path(folder, f"{name}.json").read_text(encoding="utf-8"))["model"]
    ids: dict[str, int] = model["vocab"]
    letters = _byte_letters()
    back = {c: b for b, c in enumerate(letters)}
    merges, left, right, spans = [], {}, {}, {}
    for rank, merge in enumerate(model["merges"]):
        a, b = merge if isinstance(merge, list) else merge.split(" ")
        merges.append((ids[a], ids[b], rank, ids[a + b]))
        for i in range(1, len(a)):
            if (s := ids.get(a[i:])) is not None:
                left.setdefault((s, ids[b]), rank)  # ranks ascend, so the first is the lowest
        for i in range(1, len(b)):
            if (p := ids.get(b[:i])) is not None:
                right.setdefault((ids[a], p), rank)
        raw = bytes(back[c] for c in a + b)
        for i in range(1, len(raw)):
            spans.setdefault((raw[i - 1], raw[i]), {})[raw[max(0, i - 4) : i], raw[i : i + 4]] = None
    pack = lambda d: np.array([(*k, v) for k, v in d.items()], dtype=np.int32).reshape(-1, 3)
    texts = [""] * (max(ids.values()) + 1)
    for t, i in ids.items():
        texts[i] = t
    return Vocabulary(np.array([ids[c] for c in letters], dtype=np.int32), np.array(merges, dtype=np.int32).reshape(-1, 4), pack(left), pack(right), texts, "\n".join(texts), {k: tuple(d) for k, d in spans.items()})


#: Steps of the first recursion; words that need more are cut again and go on in the second one.
FIRST_STEPS = 12

_FIRST = f"""
WITH RECURSIVE t AS (
  SELECT w, pos, tok, false AS done, 0 AS step FROM symbols
  UNION ALL
  SELECT w, pos, tok, done, step FROM (
    SELECT w, pos, CASE WHEN take THEN merged ELSE tok END AS tok, coalesce(lag(take) OVER o, false) AS eaten, NOT bool_or(take) OVER (PARTITION BY w) AS done, step + 1 AS step
    FROM (
      SELECT *, coalesce(rank IS NOT NULL AND (pos = first_lowest
          OR (rank < coalesce(lag(rank) OVER o, 1e9) AND rank <= coalesce(lead(rank) OVER o, 1e9) AND rank < l_rank AND rank < r_rank)), false) AS take
      FROM (
        SELECT x.*, m.rank, m.merged, coalesce(l.rank, 1000000000) AS l_rank, coalesce(r.rank, 1000000000) AS r_rank,
          arg_min(x.pos, m.rank * 4294967296 + x.pos) OVER (PARTITION BY x.w) AS first_lowest
        FROM (SELECT w, pos, tok, step, lag(tok) OVER o AS before, lead(tok) OVER o AS nxt, lead(tok, 2) OVER o AS after
              FROM t WHERE NOT done AND step < {FIRST_STEPS} WINDOW o AS (PARTITION BY w ORDER BY pos)) x
        LEFT JOIN merges m ON m.a = x.tok AND m.b = x.nxt
        LEFT JOIN left_thief l ON l.a = x.before AND l.b = x.tok
        LEFT JOIN right_thief r ON r.a = x.nxt AND r.b = x.after)
      WINDOW o AS (PARTITION BY w ORDER BY pos))
    WINDOW o AS (PARTITION BY w ORDER BY pos))
  WHERE NOT eaten)
SELECT w, list(tok ORDER BY pos) AS ids, bool_and(done) AS done FROM t WHERE done OR step = {FIRST_STEPS} GROUP BY w
"""

#: Every occurrence of a part's lowest pair at once; in a run of one token every other pair, from the left.
_SECOND = """
WITH RECURSIVE t AS (
  SELECT w, pos, tok, false AS done FROM symbols
  UNION ALL
  SELECT w, pos, tok, done FROM (
    SELECT w, pos, CASE WHEN take THEN merged ELSE tok END AS tok, coalesce(lag(take) OVER o, false) AS eaten, NOT bool_or(take) OVER (PARTITION BY w) AS done
    FROM (
      SELECT *, coalesce(rank = min(rank) OVER (PARTITION BY w) AND (tok <> nxt OR row_number() OVER (PARTITION BY w, tok, run ORDER BY pos) % 2 = 1), false) AS take
      FROM (
        SELECT x.*, m.rank, m.merged
        FROM (SELECT w, pos, tok, lead(tok) OVER o AS nxt, row_number() OVER o - row_number() OVER (PARTITION BY w, tok ORDER BY pos) AS run
              FROM t WHERE NOT done WINDOW o AS (PARTITION BY w ORDER BY pos)) x
        LEFT JOIN merges m ON m.a = x.tok AND m.b = x.nxt))
    WINDOW o AS (PARTITION BY w ORDER BY pos))
  WHERE NOT eaten)
SELECT w, list(tok ORDER BY pos) AS ids, true AS done FROM t WHERE done GROUP BY w
"""


class Encoder:
    """Encodes texts of one task; each distinct word goes through the recursive query once."""

    def __init__(self, vocabulary: Vocabulary):
        import duckdb
        import regex

        self.v = vocabulary
        self.words = regex.compile(PATTERN).findall
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB"})
        for name, columns, rows in (("merges", ("a", "b", "rank", "merged"), vocabulary.merges), ("left_thief", ("a", "b", "rank"), vocabulary.left_thief), ("right_thief", ("a", "b", "rank"), vocabulary.right_thief)):
            arrow = pa.table({c: rows[:, i] for i, c in enumerate(columns)})
            self.db.register("incoming", arrow)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
            self.db.unregister("incoming")
        self.known: dict[str, list[int]] = {}
        self.parts: dict[bytes, list[int]] = {}
        self.cut: dict[str, bool] = {}
        self.joins: dict[tuple[int, int], bool] = {}

    def _cuts(self, pair: str) -> bool:
        """Whether no token can span the boundary between two characters (compared as far as both reach)."""
        a, b = pair[0].encode("utf-8", "surrogatepass"), pair[1].encode("utf-8", "surrogatepass")
        near = self.v.spans.get((a[-1], b[0]), ())
        return not any((a.endswith(x) if len(x) <= len(a) else x.endswith(a)) and (b.startswith(y) if len(y) <= len(b) else y.startswith(b)) for x, y in near)

    def pieces(self, word: str) -> list[bytes]:
        """The word cut where no token can span; short ASCII words stay whole."""
        if len(word) < 14 and word.isascii():
            return [word.encode()]
        out, start = [], 0
        for i in range(1, len(word)):
            pair = word[i - 1 : i + 1]
            cut = self.cut.get(pair)
            if cut is None:
                cut = self.cut[pair] = self._cuts(pair)
            if cut:
                out.append(word[start:i].encode("utf-8", "surrogatepass"))
                start = i
        out.append(word[start:].encode("utf-8", "surrogatepass"))
        return out

    def _recurse(self, query: str, lengths: np.ndarray, tokens: np.ndarray) -> list[tuple[list[int], bool]]:
        """(ids, done) of each part; the parts' tokens are given end to end."""
        starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
        symbols = pa.table({"w": np.repeat(np.arange(len(lengths), dtype=np.int32), lengths), "pos": (np.arange(len(tokens)) - starts).astype(np.int32), "tok": tokens})
        self.db.register("symbols", symbols)
        got = self.db.sql(query).to_arrow_table()
        self.db.unregister("symbols")
        out: list = [None] * len(lengths)
        for w, ids, done in zip(got["w"].to_pylist(), got["ids"].to_pylist(), got["done"].to_pylist()):
            out[w] = (ids, done)
        return out

    def solve(self, pieces: list[bytes]) -> None:
        """Encode new pieces by the recursive queries."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        first = self._recurse(_FIRST, lengths, self.v.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)])
        open_: list[tuple[bytes, list[tuple[int, ...]]]] = []
        for piece, (ids, done) in zip(pieces, first):
            if done:
                self.parts[piece] = ids
            else:
                open_.append((piece, self._dead_ends(ids)))
        if open_:
            rest = list(dict.fromkeys(p for _, ps in open_ for p in ps if len(p) > 1))
            ended = {p: ids for p, (ids, _) in zip(rest, self._recurse(_SECOND, np.array([len(p) for p in rest], dtype=np.int64), np.array(list(chain.from_iterable(rest)), dtype=np.int32)))} if rest else {}
            for piece, ps in open_:
                self.parts[piece] = list(chain.from_iterable(ended.get(p, p) for p in ps))

    def _dead_ends(self, ids: list[int]) -> list[tuple[int, ...]]:
        """Tokens cut where no token of the vocabulary contains both neighbours, so that no later merge can join them."""
        out, start = [], 0
        for i in range(1, len(ids)):
            pair = (ids[i - 1], ids[i])
            alive = self.joins.get(pair)
            if alive is None:
                alive = self.joins[pair] = self.v.texts[pair[0]] + self.v.texts[pair[1]] in self.v.all_texts
            if not alive:
                out.append(tuple(ids[start:i]))
                start = i
        return [*out, tuple(ids[start:])]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; an empty list for an empty text and for null."""
        split = [self.words(t) if t else () for t in texts]
        if len(self.known) > REMEMBER:
            self.known.clear()
            self.parts.clear()
            self.joins.clear()
        new = set(chain.from_iterable(split)) - self.known.keys()
        cut = {w: self.pieces(w) for w in new}
        todo = list(dict.fromkeys(p for ps in cut.values() for p in ps if p not in self.parts))
        size, at = 0, 0
        for k, p in enumerate(todo):  # bounded batches, whatever the words
            size += len(p)
            if size > 400_000 or k == len(todo) - 1:
                self.solve(todo[at : k + 1])
                size, at = 0, k + 1
        for w, ps in cut.items():
            self.known[w] = self.parts[ps[0]] if len(ps) == 1 else list(chain.from_iterable(map(self.parts.__getitem__, ps)))
        return [list(chain.from_iterable(map(self.known.__getitem__, ws))) for ws in split]


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encode_documents(documents: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = FOLDER) -> DataFrame:
    """(key, ids): the ids of every row's text without special tokens; an empty list for empty and null texts.

    No shuffle: each task encodes its own rows. The vocabulary file is read on the driver and broadcast (its size is
    that of the vocabulary, some 10 MB).
    """
    shared = documents.sparkSession.sparkContext.broadcast(load_vocabulary(tokenizer, folder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get((folder, tokenizer))
        if encoder is None:
            encoder = _ENCODERS[folder, tokenizer] = Encoder(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                ids = encoder.encode(part.column(1).to_pylist())
                offsets = np.zeros(len(ids) + 1, dtype=np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(offsets[-1]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[key, "ids"])

    kind = dict(documents.dtypes)[key]
    return documents.select(key, F.col(text)).mapInArrow(run, f"`{key}` {kind}, ids array<int>")
