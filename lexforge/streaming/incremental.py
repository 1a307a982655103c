"""Incremental ingest: accepted state per page over a stream of deliveries. An extension; the batch form is operators.ingest.

State per page is one narrow row (revision, hash, arrival), so it grows with pages, not with deliveries.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_EVENT = "page_id bigint, revision_id bigint, source_hash string, source_sequence bigint, action string, previous_revision_id bigint"
_STATE = "revision_id bigint, source_hash string"


def accepted_states(deliveries: DataFrame, *, output_mode: str = "append") -> DataFrame:
    """One event per delivery: first_seen, newer_revision_replaced_older, out_of_order_older_revision_dropped,
    identical_duplicate_delivery or same_revision_conflicting_hash.

    Input: (page_id, revision_id, source_hash, source_sequence). Deliveries are folded as they arrive, Arrow batch by
    Arrow batch and in source_sequence order within each, so a page that holds much of a micro-batch is never in memory
    as a whole; only the state is kept. The state has no timeout: a page stays known.
    """

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        revision, digest = state.get if state.exists else (None, None)
        for batch in batches:
            rows = []
            for x in batch.sort_values("source_sequence").itertuples():
                new, h = int(x.revision_id), x.source_hash
                before = revision
                if revision is None:
                    action, revision, digest = "first_seen", new, h
                elif new > revision:
                    action, revision, digest = "newer_revision_replaced_older", new, h
                elif new < revision:
                    action = "out_of_order_older_revision_dropped"
                else:
                    action = "identical_duplicate_delivery" if h == digest else "same_revision_conflicting_hash"
                rows.append((key[0], new, h, int(x.source_sequence), action, before))
            state.update((revision, digest))
            out = pd.DataFrame(rows, columns=[c.split(" ")[0] for c in _EVENT.split(", ")])
            out["previous_revision_id"] = out["previous_revision_id"].astype("Int64")
            yield out

    sound = deliveries.filter("page_id is not null and revision_id is not null and source_sequence is not null")
    return sound.groupBy("page_id").applyInPandasWithState(fold, _EVENT, _STATE, output_mode, "NoTimeout")


def windowed_counts(events: DataFrame, *, at: str, by: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(window_start, by, n) with a watermark: late rows beyond ``late`` are dropped by design."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), by, "n")
