"""Documents packed into containers of fixed token capacity.

Items of one size are interchangeable, so the packing is solved on the histogram of sizes, which the capacity bounds
(at most ``capacity`` sizes however many documents there are). Martello-Toth dominance fixes containers that provably
belong to some optimal packing, the remainder is filled best fit, and the resulting patterns (container types with
multiplicities) are mapped back to documents by their distributed rank within each size. No document list ever reaches
the driver.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexforge.llm.bpe import FOLDER, PATTERN
from lexforge.session import materialize


class Run(NamedTuple):
    """``times`` equal containers holding ``count`` items of each ``size`` in ``content``."""

    content: tuple[tuple[int, int], ...]
    times: int


def _fix_dominating(left: Counter, sizes: list[int], capacity: int, runs: list[Run]) -> None:
    """Martello-Toth: fix each largest item with a set of others that dominates every other feasible set for it.

    A set dominates another if the other's items can be parted so that each part fits into the place of one of its
    items. With room ``r`` left beside the item: nothing fits -> alone; one item of exactly ``r`` -> it dominates all;
    if no two items fit together, the largest that fits dominates. If two but never three fit together, the largest
    that fits dominates alone if no two hold more than it; else the largest with the largest that fits beside it
    dominates all, provided that no two items above the smaller of them fit together. Anything else stays for best fit.
    """
    alive = list(sizes)  # ascending, only sizes with items left

    def take(size: int, times: int) -> None:
        left[size] -= times
        if left[size] == 0:
            alive.pop(bisect.bisect_left(alive, size))

    for big in reversed(list(sizes)):
        while left[big] > 0:
            room = capacity - big
            k = bisect.bisect_right(alive, room) - 1
            if k >= 0 and alive[k] == big and left[big] == 1:
                k -= 1  # the item itself is no companion
            if k < 0:
                runs.append(Run(((big, 1),), left[big]))
                take(big, left[big])
                break
            mate, low = alive[k], alive[0]
            spare = left[low] - (low == big)
            if spare == 0:
                low, spare = alive[1], left[alive[1]]
            after = alive[bisect.bisect_right(alive, low) :][:2]
            second = low if spare > 1 else next((x for x in after if left[x] - (x == big) > 0), capacity + 1)
            if mate != room and low + second <= room:
                pair = _dominating_pair(left, alive, big, room, mate)
                if pair is None:
                    break
                if len(pair) == 2:
                    content = Counter((big, *pair))
                    times = min(left[x] // n for x, n in content.items())
                    runs.append(Run(tuple(sorted(content.items())), times))
                    for x, n in content.items():
                        take(x, n * times)
                    continue
            times = left[big] // 2 if mate == big else min(left[big], left[mate])
            runs.append(Run(((big, 2),) if mate == big else ((big, 1), (mate, 1)), times))
            take(big, times)
            take(mate, times)


def _dominating_pair(left: Counter, alive: list[int], big: int, room: int, mate: int) -> tuple[int, ...] | None:
    """Companions that dominate all others beside ``big``: (mate,) or (mate, other), or None if that cannot be proved."""
    spare = lambda x: left[x] - (x == big)
    fitting = [x for x in alive[: bisect.bisect_right(alive, room)] if spare(x) > 0]
    three, n = 0, 0
    for x in fitting:  # the three smallest items together
        used = min(spare(x), 3 - n)
        three, n = three + x * used, n + used
        if n == 3:
            break
    if n == 3 and three <= room:
        return None
    best, k = 0, len(fitting) - 1  # the largest sum of two that fit
    for i, x in enumerate(fitting):
        while k > i and x + fitting[k] > room:
            k -= 1
        if k < i or (k == i and (spare(x) < 2 or 2 * x > room)):
            break
        best = max(best, x + fitting[k])
    if mate >= best:
        return (mate,)
    other = next((x for x in reversed(fitting) if mate + x <= room and spare(x) > (x == mate)), None)
    if other is None:
        return None
    above = [x for x in fitting[bisect.bisect_right(fitting, other) :]][:2]
    if above:
        second = above[0] if spare(above[0]) > 1 else above[1] if len(above) > 1 else room + 1
        if above[0] + second <= room:
            return None
    return (mate, other)


def _best_fit(left: Counter, capacity: int, runs: list[Run]) -> None:
    """Best-fit decreasing on the histogram: equal containers are kept as one run with a multiplicity.

    Sizes descend; the items of a size go to the fullest runs with room first. A run that only part of the items
    reach is divided in two.
    """
    open_: dict[int, list[list]] = {}  # room -> [[content Counter, times]]
    rooms: list[int] = []

    def add(room: int, content: Counter, times: int) -> None:
        if room == 0:
            runs.append(Run(tuple(sorted(content.items())), times))
            return
        if room not in open_:
            open_[room] = []
            bisect.insort(rooms, room)
        open_[room].append([content, times])

    for size in sorted((s for s, n in left.items() if n > 0), reverse=True):
        n = left[size]
        while n:
            k = bisect.bisect_left(rooms, size)
            if k == len(rooms):
                per = capacity // size
                full, rest = divmod(n, per)
                if full:
                    add(capacity - per * size, Counter({size: per}), full)
                if rest:
                    add(capacity - rest * size, Counter({size: rest}), 1)
                break
            room = rooms[k]
            content, times = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(k)
            per = min(room // size, n)
            used = min(times, n // per)
            if used < times:
                add(room, content, times - used)
            add(room - per * size, content + Counter({size: per}), used)
            n -= per * used
        left[size] = 0
    for room in rooms:
        for content, times in open_[room]:
            runs.append(Run(tuple(sorted(content.items())), times))


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[Run]:
    """Container runs that hold exactly the items of ``histogram`` (size -> count, sizes 1..capacity)."""
    left = Counter({s: n for s, n in histogram.items() if n > 0})
    if any(s < 1 or s > capacity for s in left):
        raise ValueError("a size is outside 1..capacity")
    runs: list[Run] = []
    sizes = sorted(left)
    _fix_dominating(left, sizes, capacity, runs)
    _best_fit(left, capacity, runs)
    return runs


_TOKENIZERS: dict = {}


def tokenizer(name: str, folder: str = FOLDER):
    """A byte-level tokenizer by name, loaded once per Python worker from ``<folder>/<name>.tiktoken``."""
    if (folder, name) not in _TOKENIZERS:
        import base64

        import tiktoken

        with open(f"{folder}/{name}.tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _TOKENIZERS[folder, name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _TOKENIZERS[folder, name]


def token_counts(documents: DataFrame, *, key: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", folder: str = FOLDER) -> DataFrame:
    """(key, n_tokens) of every row; 0 for null and empty texts. The tokenizer's file is read on each worker."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokenizer(name, folder).encode_ordinary
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "n_tokens": [len(encode(t)) if t else 0 for t in pdf[text]]})

    return documents.select(key, text).mapInPandas(run, f"`{key}` {dict(documents.dtypes)[key]}, n_tokens int")


#: Items that one numbering group holds on average, and the most groups there are (their counts are summed in one task).
GROUP_ITEMS = 100_000
MOST_GROUPS = 16_384
#: Rows of the slot table that one broadcast holds (some 32 MB); more are applied size range by size range.
SLOT_ROWS = 1_000_000


def _groups(total: int) -> int:
    return min(MOST_GROUPS, max(1, -(-total // GROUP_ITEMS)) * 8)


def _numbered(items: DataFrame, total: int) -> DataFrame:
    """``items`` plus ``_rank``: 0, 1, ... within each size, without collecting a size into one task.

    Each size is spread over hash groups; group counts give each group its offset, ranks are taken within the groups.
    """
    groups = _groups(total)
    spread = items.withColumn("_group", F.pmod(F.xxhash64("_key", "_piece"), F.lit(groups)).cast("int"))
    counts = spread.groupBy("_size", "_group").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_size", "_group", (F.sum("_n").over(Window.partitionBy("_size").orderBy("_group")) - F.col("_n")).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_size", "_group").orderBy("_key", "_piece")) - 1
    return spread.withColumn("_inside", inside).join(offsets, ["_size", "_group"]).withColumn("_rank", F.col("_inside") + F.col("_offset")).drop("_group", "_inside", "_offset")


def _slots(runs: list[Run], first: int) -> tuple[pd.DataFrame, int]:
    """For each size and run: which ranks it takes and which container numbers they go to; the number after the last."""
    taken: Counter = Counter()
    rows = []
    number = first
    for content, times in runs:
        for size, per in content:
            rows.append((size, taken[size], per, number))
            taken[size] += per * times
        number += times
    return pd.DataFrame(rows, columns=["_size", "_from", "_per", "_first"], dtype="int64"), number


def _ranges(slots: pd.DataFrame) -> list[tuple[int, int, pd.DataFrame]]:
    """(lowest size, highest size, slots) of ranges of sizes, each of at most SLOT_ROWS rows or of one size.

    A size has at most two slots for each other size (every size opens or divides at most two runs), so the capacity
    bounds each range.
    """
    if len(slots) <= SLOT_ROWS:
        return [(0, 2**31 - 1, slots)]
    out, low, n = [], None, 0
    counts = slots.groupby("_size").size().sort_index()
    for size, c in counts.items():
        if low is not None and n + c > SLOT_ROWS:
            out.append((low, last))
            low, n = None, 0
        low = size if low is None else low
        last, n = size, n + c
    out.append((low, last))
    return [(int(a), int(b), slots[slots["_size"].between(a, b)]) for a, b in out]


def pack_documents(counts: DataFrame, capacity: int, *, key: str = "doc_id") -> DataFrame:
    """(key, piece_no, token_start, token_end, container_id): every document in containers of ``capacity`` tokens.

    A document that fits stays whole. A longer one is cut into full containers of its own and one remainder that is
    packed like any other. Documents without tokens take no room; they are put into container 1. Containers are
    numbered from 1. Rows with a null key or repeated keys are packed like any other row.
    """
    spark = counts.sparkSession
    n, c = F.col("n_tokens"), F.lit(capacity)
    whole = F.when(n > c, F.floor(n / c)).otherwise(0).cast("int")
    items = counts.select(F.col(key).alias("_key"), n.alias("_tokens"), whole.alias("_piece"), (n - whole * c).cast("int").alias("_size"))
    histogram = {r["_size"]: r["n"] for r in items.filter("_size > 0").groupBy("_size").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    runs = pack_histogram(histogram, capacity)
    slots, after = _slots(runs, 1)
    numbered = _numbered(items.filter("_size > 0"), sum(histogram.values()))
    placed = None
    for low, high, own in _ranges(slots):
        part = numbered if own is slots else numbered.filter(F.col("_size").between(low, high))
        part = part.withColumn("container_id", _locate(spark, own)(F.col("_size").cast("bigint"), F.col("_rank")))
        placed = part if placed is None else placed.unionByName(part)
    rest = placed.select("_key", "_piece", (F.col("_piece") * c).alias("token_start"), F.col("_tokens").alias("token_end"), "container_id")
    # full pieces of long documents own a container each; the long documents are numbered after all others by prefix sums
    spread = items.filter("_piece > 0").withColumn("_group", F.pmod(F.xxhash64("_key"), F.lit(_groups(sum(histogram.values())))).cast("int"))
    totals = spread.groupBy("_group").agg(F.sum("_piece").alias("_n"))
    offsets = totals.select("_group", (F.sum("_n").over(Window.orderBy("_group")) - F.col("_n")).alias("_offset"))
    w = Window.partitionBy("_group").orderBy("_key", "_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = spread.withColumn("_before", F.sum("_piece").over(w) - F.col("_piece")).join(offsets, "_group")
    full = starts.select("_key", "_offset", "_before", F.explode(F.sequence(F.lit(0), F.col("_piece") - 1)).alias("_no")).select(
        "_key", F.col("_no").alias("_piece"), (F.col("_no") * c).alias("token_start"), ((F.col("_no") + 1) * c).alias("token_end"), (F.lit(after) + F.col("_offset") + F.col("_before") + F.col("_no")).alias("container_id")
    )
    empty = items.filter("_tokens = 0").select("_key", F.lit(0).alias("_piece"), F.lit(0).alias("token_start"), F.lit(0).alias("token_end"), F.lit(1).cast("bigint").alias("container_id"))
    united = rest.unionByName(full).unionByName(empty)
    return united.select(F.col("_key").alias(key), F.col("_piece").cast("int").alias("piece_no"), F.col("token_start").cast("int").alias("token_start"), F.col("token_end").cast("int").alias("token_end"), F.col("container_id").cast("bigint").alias("container_id"))


def _locate(spark, slots: pd.DataFrame):
    """Container number of (size, rank): a vectorized search in the slot table, which the capacity bounds."""
    ordered = slots.sort_values(["_size", "_from"])
    shared = spark.sparkContext.broadcast(tuple(ordered[c].to_numpy() for c in ("_size", "_from", "_per", "_first")))

    @F.pandas_udf("bigint")
    def find(sizes: pd.Series, ranks: pd.Series) -> pd.Series:
        size, start, per, first = shared.value
        key = (size << np.int64(44)) + start
        at = np.searchsorted(key, (sizes.to_numpy(np.int64) << np.int64(44)) + ranks.to_numpy(np.int64), side="right") - 1
        return pd.Series(first[at] + (ranks.to_numpy(np.int64) - start[at]) // per[at])

    return find


def pack_all(documents: DataFrame, limits: DataFrame, *, folder: str = FOLDER) -> DataFrame:
    """(limit_id, doc_id, piece_no, token_start, token_end, container_id) for each ``container`` row of ``limits``.

    Documents are tokenized once per tokenizer named there; the counts are written to the shared folder.
    """
    wanted = limits.filter("purpose = 'container'").select("limit_id", "tokenizer", "max_tokens").orderBy("limit_id").collect()  # a few rows of settings
    counts: dict[str, DataFrame] = {}
    out = None
    for r in wanted:
        if r["tokenizer"] not in counts:
            counts[r["tokenizer"]] = materialize(token_counts(documents, name=r["tokenizer"], folder=folder), "counts")
        part = pack_documents(counts[r["tokenizer"]], r["max_tokens"]).select(F.lit(r["limit_id"]).alias("limit_id"), "*")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = documents.sparkSession.createDataFrame([], "limit_id int, doc_id bigint, piece_no int, token_start int, token_end int, container_id bigint")
    return out
