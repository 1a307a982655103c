"""Exactly one row of each message delivered at least once, by per-file deletion vectors.

Only identifier, delivery order and file-row position are shuffled. Winners are chosen by a hash aggregation that
combines on the map side, so a message holding a third of all rows costs one row per task. The rows to drop become
bit vectors per (file, block of 4,096 rows); the wide payload is then read once, without any shuffle, and each row is
tested against the vector of its own position.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.functions.times import iso_instant
from lexforge.session import materialize

#: Rows of a block are 64 words of 64 bits.
WORDS = 64
#: Bytes of deletion vectors that one broadcast may hold; more are applied file group by file group.
VECTOR_BYTES = 64 << 20
_BLOCK_BYTES = WORDS * 8 + 48


def _position(df: DataFrame) -> DataFrame:
    return df.select("*", F.xxhash64(F.col("_metadata.file_path")).alias("__lx_file"), F.col("_metadata.row_index").alias("__lx_row"))


def _assert_distinct_files(df: DataFrame) -> None:
    """The 64-bit file ids must name files one to one; a clash is reported rather than risked. One file clashes with none."""
    if len(df.inputFiles()) == 1:
        return
    clash = df.select(F.col("_metadata.file_path").alias("p")).groupBy(F.xxhash64("p").alias("f")).agg((F.min("p") != F.max("p")).alias("clash")).filter("clash")
    if clash.limit(1).count():
        raise ValueError("two input files share one 64-bit id")


def _bit(row: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (row % 64).cast("int"))


def deletion_vectors(table: DataFrame, *, message: list[Column], counted: Column, order: Column) -> DataFrame:
    """(__lx_file, __lx_block, __lx_vector): for each block that loses rows, 64 longs whose set bits are the rows to drop.

    ``message`` are the columns naming a message (null equals null), ``counted`` says which rows are messages, ``order``
    (not null; a struct for several criteria) is the order whose lowest value wins. Rows that tie in it are equally good:
    one wins, which one is fixed when the vectors are written. ``table`` must be a Parquet scan (row positions come from its metadata).
    """
    keys = [c.alias(f"__lx_k{i}") for i, c in enumerate(message)]
    narrow = _position(table).filter(counted).select(*keys, order.alias("__lx_order"), "__lx_file", "__lx_row")
    names = [f"__lx_k{i}" for i in range(len(keys))]
    winners = narrow.groupBy(*names).agg(F.min_by("__lx_file", "__lx_order").alias("__lx_file"), F.min_by("__lx_row", "__lx_order").alias("__lx_row"))
    word = (F.col("__lx_row") / 64).cast("bigint").alias("__lx_word")
    all_bits = _position(table).filter(counted).select("__lx_file", word, _bit(F.col("__lx_row")).alias("__lx_all")).groupBy("__lx_file", "__lx_word").agg(F.bit_or("__lx_all").alias("__lx_all"))
    won_bits = winners.select("__lx_file", word, _bit(F.col("__lx_row")).alias("__lx_won")).groupBy("__lx_file", "__lx_word").agg(F.bit_or("__lx_won").alias("__lx_won"))
    dropped = all_bits.join(won_bits, ["__lx_file", "__lx_word"], "left").select("__lx_file", "__lx_word", F.col("__lx_all").bitwiseAND(F.bitwise_not(F.coalesce("__lx_won", F.lit(0).cast("bigint")))).alias("__lx_bits")).filter("__lx_bits != 0")
    blocks = dropped.groupBy("__lx_file", (F.col("__lx_word") / WORDS).cast("bigint").alias("__lx_block")).agg(
        F.map_from_entries(F.collect_list(F.struct((F.col("__lx_word") % WORDS).cast("int").alias("w"), F.col("__lx_bits").alias("b")))).alias("__lx_m")
    )  # a block has at most 64 words
    dense = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.coalesce(F.try_element_at(F.col("__lx_m"), w), F.lit(0).cast("bigint")))
    return blocks.select("__lx_file", "__lx_block", dense.alias("__lx_vector"))


def with_deletions(table: DataFrame, vectors: DataFrame, columns: list[Column | str] | None = None, *, limit_bytes: int = VECTOR_BYTES) -> DataFrame:
    """``table``'s columns plus ``__lx_deleted``, read without a shuffle.

    The vectors are broadcast if their counted size is within ``limit_bytes``; else the files are split into groups
    whose vectors are, each group is scanned for itself (the predicate on the file path prunes its other files), and
    the disjoint scans are united.
    """
    size = vectors.count() * _BLOCK_BYTES
    groups = max(1, -(-size // limit_bytes))
    picked = [F.col(f"`{c}`") for c in table.columns] if columns is None else columns
    # the position rides along under names that the payload cannot have
    base = _position(table)
    parts = []
    for g in range(groups):
        rows, own = base, vectors
        if groups > 1:
            rows = rows.filter(F.pmod(F.xxhash64(F.col("_metadata.file_path")), F.lit(groups)) == g)
            own = own.filter(F.pmod(F.col("__lx_file"), F.lit(groups)) == g)
        rows = rows.select(*picked, "__lx_file", "__lx_row", (F.col("__lx_row") / (64 * WORDS)).cast("bigint").alias("__lx_block"))
        own = F.broadcast(own.select(F.col("__lx_file").alias("__lx_f"), F.col("__lx_block").alias("__lx_b"), "__lx_vector"))
        joined = rows.join(own, (F.col("__lx_file") == F.col("__lx_f")) & (F.col("__lx_block") == F.col("__lx_b")), "left")
        at = ((F.col("__lx_row") / 64).cast("bigint") % WORDS).cast("int")
        hit = F.col("__lx_vector").isNotNull() & (F.get(F.col("__lx_vector"), at).bitwiseAND(_bit(F.col("__lx_row"))) != 0)
        parts.append(joined.withColumn("__lx_deleted", F.coalesce(hit, F.lit(False))).drop("__lx_file", "__lx_row", "__lx_block", "__lx_f", "__lx_b", "__lx_vector"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def message_columns() -> list[Column]:
    """What names an article message: identifier, version.identifier and the instant of date_modified (raw text where it denotes none)."""
    instant = iso_instant(F.col("date_modified"))
    return [F.col("identifier"), F.col("version.identifier"), instant, F.when(instant.isNull(), F.col("date_modified"))]


def article_message() -> Column:
    """Rows that are messages: identifier and version.identifier are known."""
    return F.col("identifier").isNotNull() & F.col("version.identifier").isNotNull()


def article_deletion_vectors(table: DataFrame) -> DataFrame:
    """Deletion vectors of an article-message table, written once so that every later read sees the same winners."""
    _assert_distinct_files(table)
    order = F.coalesce("source_sequence", F.lit(2**63 - 1))  # an unknown position loses against any known one
    return materialize(deletion_vectors(table, message=message_columns(), counted=article_message(), order=order), "deletions")


def newest_rows(table: DataFrame, *, key: Column, counted: Column, revision: Column, arrival: list[str]) -> DataFrame:
    """The full rows of ``table`` that ``counted`` admits, one per key: highest revision, earliest arrival of it.

    ``table`` is a Parquet scan, possibly with derived columns. Wide columns are not shuffled.
    """
    _assert_distinct_files(table)
    order = F.struct((-revision).alias("newest"), *arrival)
    vectors = materialize(deletion_vectors(table, message=[key], counted=counted, order=order), "deletions")
    return with_deletions(table.filter(counted), vectors).filter("not __lx_deleted").drop("__lx_deleted")


def has_positions(table: DataFrame) -> bool:
    """Whether ``table`` is a Parquet scan (possibly with derived columns), whose rows have positions in files."""
    try:
        return table.select("_metadata.row_index") is not None
    except AnalysisException:
        return False


def distinct_by(table: DataFrame, message: list[Column]) -> DataFrame:
    """The rows of a Parquet scan, one for each distinct ``message`` (null equals null); wide columns are not shuffled.

    ``table`` may have derived columns. Of equal messages any row may stay, the same one for every reader.
    """
    _assert_distinct_files(table)
    vectors = materialize(deletion_vectors(table, message=message, counted=F.lit(True), order=F.col("__lx_row")), "deletions")
    return with_deletions(table, vectors).filter("not __lx_deleted").drop("__lx_deleted")


def distinct_messages(table: DataFrame) -> DataFrame:
    """The full rows of ``table``, exactly one for each message; rows that are no messages are left out."""
    return with_deletions(table.filter(article_message()), article_deletion_vectors(table)).filter("not __lx_deleted").drop("__lx_deleted")


def repeated_messages(table: DataFrame) -> DataFrame:
    """(source_sequence): every row of a message but the one with its lowest source_sequence."""
    return with_deletions(table, article_deletion_vectors(table), ["source_sequence"]).filter("__lx_deleted").select("source_sequence")
