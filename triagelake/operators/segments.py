"""Merging of ordered rows into the entry that opened them.

A raw log file is an ordered run of rows in which some rows open an entry and the others continue
the latest one. Order matters within a file, yet a file may hold a large part of all data, so no
step here works on a whole file: rows carry a `block` (a bounded, ordered slice of the file) and
only one small row per block is looked at across blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triagelake.session import broadcast_if_small, materialize

#: Bytes of one merged entry, which is one value of a row; a larger one is an error that names where it lies.
MAX_ENTRY = 256 << 20


def joined_lines(lines: Column, of_entry: Window, limit: int, file: Column, block: Column) -> Column:
    """The lines of a window partition joined by line feeds; an error, before they are gathered, if they are too many.

    A quote that is never closed makes the rest of a file one record; nothing can be told from it but where it is.
    """
    size = F.sum(F.octet_length(lines) + 1).over(of_entry)
    place = F.concat(F.lit("an entry has more than "), F.lit(str(limit)), F.lit(" bytes, in file "), file.cast("string"),
                     F.lit(", block "), block.cast("string"))
    kept = F.when(size <= limit, lines).otherwise(F.raise_error(place))
    return F.array_join(F.collect_list(kept).over(of_entry), "\n")


def with_owner_block(rows: DataFrame, file: list[str], block: str, pos: str, opens: Column) -> DataFrame:
    """Add `_opens` and `_owner`, the block that holds the opener of each row; orphans are dropped.

    Rows before the first opener of their block belong to the latest earlier block that has one.
    The per-block table is aggregated before its shuffle; the window over it sees one row per
    block. It is stored at once and broadcast if its count allows, so that the rows themselves need
    no shuffle here.
    """
    flagged = rows.withColumn("_opens", opens)
    blocks = flagged.groupBy(*file, block).agg(F.min(F.when(F.col("_opens"), F.col(pos))).alias("_first_open"))
    earlier = Window.partitionBy(*file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last(F.when(F.col("_first_open").isNotNull(), F.col(block)), ignorenulls=True)
    table = broadcast_if_small(materialize(blocks.withColumn("_carried", carried.over(earlier)), "blocks"))
    return (
        flagged.join(table, [*file, block])
        .withColumn(
            "_owner",
            F.when(F.col(pos) >= F.col("_first_open"), F.col(block)).otherwise(F.col("_carried")),
        )
        .where(F.col("_owner").isNotNull())
        .drop("_first_open", "_carried")
    )


def merge_continuations(
    rows: DataFrame,
    opens: Column,
    file: list[str],
    block: str = "block",
    pos: str = "rid",
    ts: str = "ts_ms",
    message: str = "message",
    aligned: bool = False,
    max_entry: int = MAX_ENTRY,
) -> DataFrame:
    """One row per entry: the opener's time, all messages joined by line feeds in file order.

    Rows before the first opener of a file are dropped. The rows are shuffled once, by file and
    owning block; both windows share that partitioning, and the opener's row is the one kept. `aligned` says that no entry
    crosses a block (as in `read_log_csv`), so owners need not be looked up and a partitioning by
    file and block is reused as it is.
    """
    if aligned:
        owned = rows.withColumn("_opens", opens).withColumn("_owner", F.col(block))
    else:
        owned = with_owner_block(rows, file, block, pos, opens)
    running = (
        Window.partitionBy(*file, "_owner").orderBy(block, pos)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    entry = F.sum(F.col("_opens").cast("bigint")).over(running)
    of_entry = (
        Window.partitionBy(*file, "_owner", "_entry").orderBy(block, pos)
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return (
        owned.withColumn("_entry", entry)
        .where(F.col("_entry") > 0)
        .withColumns({
            message: joined_lines(F.col(message), of_entry, max_entry, F.concat_ws("/", *file), F.col("_owner")),
            "n_continuations": F.count(F.lit(1)).over(of_entry) - 1,
        })
        .where("_opens")
        .select(*file, ts, pos, message, "n_continuations")
    )
