"""One surviving record for each group of duplicates, built from consistent bundles of fields.

Fields that depend on each other form a *bundle* and are taken whole from one record. Each record that offers a bundle
gives it a trust, a vector of non-negative numbers compared tier by tier; functional dependencies say which bundles must
fit each other (the value of a determinant chosen in one bundle fixes which records another may come from). A
branch-and-bound search chooses one candidate per bundle so that the sum of the trusts is highest and every dependency
holds; taking the best of each bundle by itself may break a dependency, and taking bundles one after the other may miss
the best sum.

The bounding is done twice. Over the whole table, aggregates find for each group the best record taken whole (an
incumbent, as a record is consistent with itself) and the best candidate of each bundle; a candidate whose trust plus
the best of all other bundles stays below the incumbent can be in no optimum and is dropped, and so are candidates whose
determinant was. What is left of a group, usually a record or two, is searched in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.operators.skew import attach
from lexforge.session import materialize

Trust = tuple[int, ...]
Candidate = tuple[Trust, Any]


class Bundle(NamedTuple):
    """``fields`` taken whole from one record; ``trust`` gives (tier, number) pairs, ``given`` the records that offer it."""

    name: str
    fields: tuple[str, ...]
    trust: tuple[tuple[int, Column], ...]
    given: Column | None = None


class Dependency(NamedTuple):
    """The value of the field ``determinant`` fixes the bundle ``dependent``.

    The dependent's record must have the determinant's chosen value. A ``soft`` dependency binds only where some record
    of that value offers the dependent; else any record may.
    """

    determinant: str
    dependent: str
    soft: bool = False


def source_trust(source: Column, trusts: dict[str, int]) -> Column:
    """Trust of a record's source by name; 0 for sources that are not named."""
    pairs = [x for name, n in trusts.items() for x in (F.lit(name), F.lit(n))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), source), F.lit(0))


def branch_and_bound(bundles: list[list[Candidate]], allowed: Callable[[list[Any], int, Any], bool]) -> list[Any]:
    """The choice of one candidate's value per bundle with the highest sum of trusts; None for a bundle that stays empty.

    ``allowed(chosen, k, value)`` tells whether ``value`` of bundle k fits the values chosen for the bundles before it.
    A bundle stays empty only where none of its candidates is allowed; this adds no trust. A branch is cut when its
    trust plus the best of each open bundle is not above the incumbent. Of equal sums the one met first wins
    (candidates of equal trust keep their given order).
    """
    order = [sorted(b, key=lambda c: c[0], reverse=True) for b in bundles]
    width = max((len(t) for b in order for t, _ in b), default=0)
    nothing = (0,) * width
    add = lambda a, b: tuple(map(int.__add__, a, b))
    rest = [nothing]
    for b in reversed(order):
        rest.append(add(rest[-1], max(b[0][0], nothing) if b else nothing))
    rest.reverse()
    best: tuple[Trust, list[Any]] | None = None

    def visit(k: int, trust: Trust, chosen: list[Any]) -> None:
        nonlocal best
        if best is not None and add(trust, rest[k]) <= best[0]:
            return
        if k == len(order):
            best = (trust, list(chosen))
            return
        fitting = [c for c in order[k] if allowed(chosen, k, c[1])]
        for t, value in fitting or [(nothing, None)]:
            chosen.append(value)
            visit(k + 1, add(trust, t), chosen)
            chosen.pop()

    visit(0, nothing, [])
    return best[1]


def _searcher(at: list[int], dependencies: list[tuple[int, int, int, bool]]):
    """Vectorized search: per group the row of each bundle's choice, -1 where it stays empty; null for null.

    ``at`` is the order in which bundles are chosen, determinants before their dependents; ``dependencies`` are
    (bundle of the determinant, number of the determinant, dependent bundle, soft). Trusts come negated; an empty
    vector is a candidate that the bound has excluded but that still binds a soft dependency.
    """

    @F.pandas_udf("array<int>")
    def search(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for witnesses, trusts in batches:
            out = []
            for seen, rows in zip(witnesses, trusts):
                if seen is None:
                    out.append(None)
                    continue
                seen = [tuple(w) for w in seen]
                bundles = [[(tuple(-int(x) for x in r[b]), i) for i, r in enumerate(rows) if r[b] is not None and len(r[b])] for b in at]
                offered = {(b, d): {seen[i][d] for i, r in enumerate(rows) if r[b] is not None} for _, d, b, soft in dependencies if soft}

                def allowed(chosen: list, k: int, row: int) -> bool:
                    for source, d, b, soft in dependencies:
                        if b != at[k]:
                            continue
                        lead = chosen[at.index(source)]
                        if lead is None or seen[lead][d] == seen[row][d] or (soft and seen[lead][d] not in offered[b, d]):
                            continue
                        return False
                    return True

                found = branch_and_bound(bundles, allowed)
                picked = [-1] * len(at)
                for b, row in zip(at, found):
                    picked[b] = -1 if row is None else row
                out.append(picked)
            yield pd.Series(out)

    return search


def _order(bundles: list[Bundle], dependencies: list[Dependency]) -> list[int]:
    """Bundles with every determinant's bundle before its dependents; a cycle is an error."""
    owner = {f: i for i, b in enumerate(bundles) for f in b.fields}
    number = {b.name: i for i, b in enumerate(bundles)}
    before = {i: {owner[d.determinant] for d in dependencies if number[d.dependent] == i} for i in range(len(bundles))}
    out: list[int] = []
    while len(out) < len(bundles):
        ready = [i for i in range(len(bundles)) if i not in out and before[i] <= set(out)]
        if not ready:
            raise ValueError("the dependencies of the bundles form a cycle")
        out.append(ready[0])
    return out


def consolidate(records: DataFrame, *, group: str, bundles: list[Bundle], dependencies: list[Dependency], counts: dict[str, Column] | None = None) -> DataFrame:
    """(group, ``counts``, all fields of all bundles): one row for each not-null ``group``.

    ``counts`` are sums over the group's records. Fields of a bundle that stays empty are null. Of candidates of equal
    trust the one with the smallest values wins. Repeated records change nothing but the counts.
    """
    counts = counts or {}
    determinants = list(dict.fromkeys(d.determinant for d in dependencies))
    owner = {f: i for i, b in enumerate(bundles) for f in b.fields}
    number = {b.name: i for i, b in enumerate(bundles)}
    tiers = sorted({t for b in bundles for t, _ in b.trust})
    named = [sorted(t for t, _ in b.trust) for b in bundles]
    names = [f"__b{i}" for i in range(len(bundles))]

    def candidate(b: Bundle) -> Column:
        negated = [(-F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))).alias(f"t{t}") for t, c in sorted(b.trust, key=lambda x: x[0])]
        offer = F.struct(F.struct(*negated).alias("n"), F.struct(*[F.col(f"`{f}`") for f in b.fields]).alias("v"))
        return offer if b.given is None else F.when(b.given, offer)

    # of the records that agree in all determinants only the most trusted of each bundle can win; combined on the map side
    keys = [F.col(f"`{d}`").alias(f"__d{i}") for i, d in enumerate(determinants)]
    rows = (
        records.filter(F.col(f"`{group}`").isNotNull())
        .groupBy(F.col(f"`{group}`").alias("__g"), *keys)
        .agg(*[F.min(candidate(b)).alias(n) for n, b in zip(names, bundles)], *[F.sum(c).alias(f"__c{i}") for i, c in enumerate(counts.values())])
    )
    rows = materialize(rows, "candidates")

    def part(column: str, i: int, tier: int) -> Column:
        """What a candidate of bundle i adds in a tier (negated)."""
        return F.coalesce(F.col(f"{column}.n.t{tier}"), F.lit(0).cast("bigint")) if tier in named[i] else F.lit(0).cast("bigint")

    def summed(suffix: str, swapped: int | None = None) -> Column:
        """Trust of all bundles together, bundle ``swapped`` taken from the row itself."""
        return F.struct(*[sum((part(n if i == swapped else n + suffix, i, t) for i, n in enumerate(names) if t in named[i]), F.lit(0).cast("bigint")).alias(f"t{t}") for t in tiers])

    leads = sorted({owner[d.determinant] for d in dependencies})
    whole = F.lit(True)
    for i in leads:
        whole = whole & F.col(names[i]).isNotNull()
    # one row per group: the incumbent, each bundle's best candidate, the counts
    bounds = rows.groupBy("__g").agg(
        F.min(F.when(whole, summed(""))).alias("__best"), F.count(F.lit(1)).alias("__n"), *[F.min(n).alias(f"{n}_top") for n in names], *[F.sum(f"__c{i}").alias(f"__s{i}") for i in range(len(counts))]
    )
    bounds = materialize(bounds, "bounds")
    every = bounds.agg(F.sum("__n")).first()[0] or 0
    joined = attach(rows.drop(*[f"__c{i}" for i in range(len(counts))]), bounds.drop(*[f"__s{i}" for i in range(len(counts))]), ["__g"], weight="__n", total=every)
    for i, n in enumerate(names):
        joined = joined.withColumn(f"{n}_in", F.col(n).isNotNull() & F.coalesce(summed("_top", i) <= F.col("__best"), F.lit(True)))
    kept = {}
    for i, (n, b) in enumerate(zip(names, bundles)):
        own = [d for d in dependencies if d.dependent == b.name]
        kept[n] = F.col(f"{n}_in")
        if len(determinants) == 1 and own:
            # the determinant's own candidate is in the same row: without it the dependents cannot be chosen either
            lead = names[owner[own[0].determinant]]
            kept[n] = kept[n] & (F.col(f"{lead}_in") | (F.lit(own[0].soft) & (F.col(n) == F.col(f"{n}_top"))) | F.col(f"{lead}_top").isNull())
        elif any(d.soft for d in own):
            kept[n] = F.col(n).isNotNull()
    numbers = lambda i, n: F.array(*[part(n, i, t) for t in tiers])
    marks = [F.when(kept[n], numbers(i, n)).when(F.col(n).isNotNull(), F.array().cast("array<bigint>")) for i, n in enumerate(names)]
    some = F.lit(False)
    for n in names:
        some = some | kept[n]
    open_ = joined.filter(some).select("__g", F.struct(F.array(*[F.col(f"__d{i}").cast("string") for i in range(len(determinants))]).alias("w"), F.array(*marks).alias("t"), *[F.col(f"{n}.v").alias(n) for n in names]).alias("__r"))
    left = open_.groupBy("__g").agg(F.collect_list("__r").alias("__rows"))
    search = _searcher(_order(bundles, dependencies), [(owner[d.determinant], determinants.index(d.determinant), number[d.dependent], d.soft) for d in dependencies])
    # a group of which the bounds have left one record has one choice
    several = F.size("__rows") > 1
    at = search(F.when(several, F.transform("__rows", lambda r: r["w"])), F.when(several, F.transform("__rows", lambda r: r["t"])))
    found = left.withColumn("__at", F.coalesce(at, F.array_repeat(F.lit(0), len(bundles))))
    values = [F.get(F.col("__rows"), F.col("__at")[i])[names[i]][f].alias(f) for i, b in enumerate(bundles) for f in b.fields]
    answer = bounds.select("__g", *[f"__s{i}" for i in range(len(counts))]).join(found, "__g", "left")
    return answer.select(F.col("__g").alias(group), *[F.col(f"__s{i}").alias(n) for i, n in enumerate(counts)], *values)


def clean_hash(c: Column) -> Column:
    """64 hexadecimal digits in lower case; blanks at the ends do not count; anything else is null."""
    bare = F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    return F.when(bare.rlike(r"^[0-9a-f]{64}$") & (F.length(bare) == 64), bare)


def known_states(states: DataFrame, duplicates: DataFrame) -> DataFrame:
    """All states either table knows, with cleaned hashes; ``own`` is 1 for rows of the state table."""
    a = states.select("page_id", "revision_id", clean_hash(F.col("source_hash")).alias("source_hash"), "source_sequence", F.lit(1).alias("own"), "title", "ingest_status", "is_deleted", "seen_at")
    b = duplicates.select(
        "page_id", F.col("kept_revision_id").alias("revision_id"), clean_hash(F.col("kept_hash")).alias("source_hash"), "source_sequence", F.lit(0).alias("own"), F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("ingest_status"), F.lit(None).cast("boolean").alias("is_deleted"), F.lit(None).cast("timestamp").alias("seen_at"),
    )
    return a.unionByName(b).filter("page_id is not null")


_LAST = 2**62


def surviving_states(states: DataFrame, duplicates: DataFrame) -> DataFrame:
    """One row per page of either table: its surviving state.

    Three bundles: the revision (the highest known is trusted most), its fingerprint (source_hash with source_sequence:
    a valid hash before none, then the lowest sequence) and its description (the most complete, then most recent, then
    earliest delivered row). The revision determines the fingerprint, and the description wherever the state table
    describes that revision. Rows without page_id are left out; null sequences lose against all others; a page without
    any revision keeps a null revision.
    """
    known = known_states(states, duplicates)
    early = F.lit(_LAST) - F.least(F.greatest(F.coalesce("source_sequence", F.lit(_LAST)), F.lit(-_LAST + 1)), F.lit(_LAST))
    hashed = F.col("source_hash").isNotNull()
    complete = F.col("title").isNotNull().cast("int") + F.col("seen_at").isNotNull().cast("int") + F.col("is_deleted").isNotNull().cast("int") + (F.coalesce("ingest_status", F.lit("")) == "accepted").cast("int")
    columns = known.withColumn("_early", early).withColumn("source_sequence", F.when(hashed, F.col("source_sequence"))).withColumn("detail_revision_id", F.col("revision_id"))
    described = F.col("seen_at").isNotNull()
    bundles = [
        Bundle("revision", ("revision_id",), ((0, F.col("revision_id")),), F.col("revision_id").isNotNull()),
        Bundle("fingerprint", ("source_hash", "source_sequence"), ((1, hashed.cast("int")), (2, F.when(hashed, F.col("_early")))), F.col("revision_id").isNotNull()),
        Bundle("description", ("title", "ingest_status", "is_deleted", "seen_at", "detail_revision_id"), ((3, complete), (4, described.cast("int")), (5, F.when(described, F.unix_micros("seen_at"))), (6, F.col("_early"))), F.col("own") == 1),
    ]
    return consolidate(columns, group="page_id", bundles=bundles, dependencies=[Dependency("revision_id", "fingerprint"), Dependency("revision_id", "description", soft=True)], counts={"own_rows": F.col("own")})


def surviving_duplicates(states: DataFrame, duplicates: DataFrame) -> DataFrame:
    """(page_id, revision_id, source_hash) of pages with at least two rows in ``states`` and at least one known revision."""
    return surviving_states(states, duplicates).filter("own_rows >= 2 and revision_id is not null").select("page_id", "revision_id", "source_hash")
