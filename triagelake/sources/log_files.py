"""Raw log files: CSV with a time and a message column, one service per file or folder.

A quoted message may hold line feeds, which normally makes a CSV file unsplittable. Here files are
read as text in parallel slices (blocks). Whether a line starts inside quotes follows from the
lines before it, and each line acts on that state in one of four ways: keep it, flip it, leave it
outside or leave it inside. A first pass reduces each block to one small row; a window over those
rows gives the state at every block start. The second pass then assembles rows block by block. A
row that crosses a block end stays with the block it began in.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triagelake.functions.text import clean_service_name, enrich, parse_lines, strip, valid_epoch_ms
from triagelake.functions.times import resolve_timestamp
from triagelake.operators.segments import MAX_ENTRY as MAX_RECORD
from triagelake.operators.segments import joined_lines, merge_continuations
from triagelake.schemas import LOG
from triagelake.session import broadcast_if_small, materialize

# CSV grammar. Possessive quantifiers keep the matching iterative on very long lines.
QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
CLOSED_FIELD = rf'(?:{QUOTED}"[^,]*+|[^",][^,]*+|)'
CLOSED_OUTSIDE = rf'\A{CLOSED_FIELD}(?:,{CLOSED_FIELD})*+\z'
CLOSED_INSIDE = rf'\A[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{CLOSED_FIELD})*+\z'
ANY_FIELD = rf',({QUOTED}(?:"[^,]*+|\z)|[^",][^,]*+|)'
ENTRY_START = r'\A\s*(?:[0-9]{13}|"\s*[0-9]{13}\s*")\s*(?:,|\z)'
UNQUOTE = r'(?s)\A"([^"]*+(?:""[^"]*+)*+)"?(.*)\z'

# A field of 13 digits behind the first one, and such a field alone.
LATER_START = r'(?:\A|,)\s*(?:[0-9]{13}|"\s*[0-9]{13}\s*")\s*(?:,|\z)'
EPOCH_FIELD = r'\A\s*(?:[0-9]{13}|"\s*[0-9]{13}\s*")\s*\z'

OUTSIDE, INSIDE = 0, 1

LINE_COLUMNS = "file bigint, service_name string, block bigint, block_bytes bigint, pos bigint, value string"
BLOCK = ["file", "block", "block_bytes"]
ROW_COLUMNS = "file bigint, service_name string, block bigint, rid bigint, ts_ms string, message string"


def newest_change(spark: SparkSession, path: str, service_from: str = "stem") -> int | None:
    """When the newest `*.csv` file of a folder was written, in epoch microseconds, from the listing alone."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option(
        "recursiveFileLookup", str(service_from == "dir").lower()
    )
    try:
        return reader.load(path).agg(F.max(F.unix_micros("modificationTime"))).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def discover_log_files(
    spark: SparkSession, path: str, service_from: str = "stem", after: int | None = None, upto: int | None = None
) -> DataFrame:
    """Lines of all `*.csv` files of a folder, with service, file, block and order.

    Files can be limited to those written `after` and not later than `upto` (epoch microseconds); others are not read.

    The service is the file's stem, or with `service_from="dir"` the name of the folder that holds the file
    (`svc-1` or `service_name=svc-1`); only then sub-folders are read. A missing or empty folder gives no lines.
    """
    reader = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", str(service_from == "dir").lower())
    try:
        lines = reader.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LINE_COLUMNS)
    written = F.col("_metadata.file_modification_time")
    if after is not None:
        lines = lines.where(written > F.timestamp_micros(F.lit(after)))
    if upto is not None:
        lines = lines.where(written <= F.timestamp_micros(F.lit(upto)))
    if service_from == "stem":
        service = F.substring(F.col("_metadata.file_name"), F.lit(1), F.length("_metadata.file_name") - len(".csv"))
    else:
        folder = F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1)
        service = F.substring_index(folder, "=", -1)
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        service.alias("service_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("block_bytes"),
        F.monotonically_increasing_id().alias("pos"),
        F.make_valid_utf8("value").alias("value"),
    )


def csv_fields(record: Column) -> Column:
    """The raw fields of one CSV record, quotes still on."""
    quoted = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(ANY_FIELD), F.lit(1))
    return F.when(F.contains(record, F.lit('"')), quoted).otherwise(F.split(record, ","))


def unquote(field: Column) -> Column:
    """The value of a raw CSV field."""
    quote = F.lit('"')

    def unescape(text: Column) -> Column:
        return F.replace(text, F.lit('""'), quote)

    inner = F.substring(field, F.lit(2), F.length(field) - 2)
    odd = F.concat(unescape(F.regexp_extract(field, UNQUOTE, 1)), F.regexp_extract(field, UNQUOTE, 2))
    regular = F.endswith(field, quote) & (F.length(field) > 1)
    return (
        F.when(~F.startswith(field, quote), field)
        .when(regular & ~F.contains(inner, quote), inner)
        .when(regular & ~F.contains(F.replace(inner, F.lit('""'), F.lit("")), quote), unescape(inner))
        .otherwise(odd)
    )


def _with_effect(lines: DataFrame) -> DataFrame:
    """Add `_fixed` (state after the line whatever it was before, else null) and `_flips`."""
    has_quote = F.contains("value", F.lit('"'))
    from_outside = F.when(F.col("value").rlike(CLOSED_OUTSIDE), OUTSIDE).otherwise(INSIDE)
    from_inside = F.when(F.col("value").rlike(CLOSED_INSIDE), OUTSIDE).otherwise(INSIDE)
    return (
        lines.withColumn("_o", F.when(has_quote, from_outside).otherwise(OUTSIDE))
        .withColumn("_i", F.when(has_quote, from_inside).otherwise(INSIDE))
        .withColumn("_fixed", F.when(F.col("_o") == F.col("_i"), F.col("_o")))
        .withColumn("_flips", F.when((F.col("_o") == INSIDE) & (F.col("_i") == OUTSIDE), 1).otherwise(0))
        .drop("_o", "_i")
    )


def _with_state(df: DataFrame, partition: list[str], order: list[str]) -> DataFrame:
    """Add `_known` (state before the row where it does not depend on the start) and `_odd` flips.

    The state before a row is `_known` if set, else the start state flipped `_odd` times.
    """
    so_far = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = df.withColumn("_count", F.sum("_flips").over(so_far))
    fixed_at = F.when(F.col("_fixed").isNotNull(), F.struct(F.col("_fixed").alias("s"), F.col("_count").alias("n")))
    return (
        counted.withColumn("_last", F.last(fixed_at, ignorenulls=True).over(before))
        .withColumn("_odd", (F.col("_count") - F.col("_flips")) % 2)
        .withColumn(
            "_known",
            F.when(
                F.col("_last").isNotNull(),
                (F.col("_last.s") + F.col("_count") - F.col("_flips") - F.col("_last.n")) % 2,
            ),
        )
        .drop("_count", "_last")
    )


def _block_table(lines: DataFrame) -> DataFrame:
    """Per block: where its first certain entry start is, the block rows before it belong to, and the header.

    A certain entry start is a line that begins outside quotes and has, whole and on this line, 13 digits in the
    file's time column. The column is known only when the header is found, so starts are kept by column: each line
    tells the first of its fields that is such a number. Only narrow columns are shuffled here.
    """
    header_like = (F.col("block") == 0) & F.contains(F.lower("value"), F.lit("timestamp"))
    value = F.col("value")
    later = F.array_position(F.transform(csv_fields(value), lambda x: x.rlike(EPOCH_FIELD)), F.lit(True))
    start_at = F.when(value.rlike(ENTRY_START), F.lit(1)).when(value.rlike(LATER_START), F.nullif(later, F.lit(0)).cast("int"))
    narrow = _with_effect(lines).withColumn("_col", start_at).select(
        *BLOCK, "pos", "_fixed", "_flips", "_col",
        F.when(header_like & F.col("_col").isNull(), F.col("value")).alias("_line"),
    )
    stated = _with_state(narrow, BLOCK, ["pos"])
    begins = {
        start: F.col("_col").isNotNull() & (F.coalesce(F.col("_known"), (F.col("_odd") + start) % 2) == OUTSIDE)
        for start in (OUTSIDE, INSIDE)
    }
    after_fixed = F.coalesce(F.col("_fixed"), F.when(F.col("_known").isNotNull(), (F.col("_known") + F.col("_flips")) % 2))
    last = F.struct("pos", after_fixed.alias("fixed"), ((F.col("_odd") + F.col("_flips")) % 2).alias("flips"))
    by_column = stated.groupBy(*BLOCK, "_col").agg(
        F.max(last).alias("_last"),
        F.min(F.when(begins[OUTSIDE], F.col("pos"))).alias("outside"),
        F.min(F.when(begins[INSIDE], F.col("pos"))).alias("inside"),
        F.min(F.when(F.col("_line").isNotNull(), F.struct("pos", F.col("_line").alias("line")))).alias("_line"),
        F.min("pos").alias("_first_pos"),
    )
    starts = F.when(F.col("_col").isNotNull(), F.struct(F.col("_col").alias("at"), "outside", "inside"))
    blocks = by_column.groupBy(*BLOCK).agg(
        F.max("_last").alias("_last"), F.min("_line").alias("_line"), F.min("_first_pos").alias("_first_pos"),
        F.collect_list(starts).alias("_syncs"),
    ).select(
        *BLOCK, F.col("_last.fixed").alias("_fixed"), F.col("_last.flips").alias("_flips"), "_syncs",
        F.col("_line.line").alias("_line"), "_first_pos",
    )
    file = Window.partitionBy("file").orderBy("block")
    whole = file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    names = F.transform(csv_fields(F.first("_line").over(whole)), lambda c: F.lower(strip(unquote(c))))
    state = F.coalesce(F.col("_known"), F.col("_odd"))
    return (
        _with_state(blocks, ["file"], ["block"])
        .withColumn("_names", names)
        .withColumn(
            "_ts_at",
            F.coalesce(
                F.nullif(F.array_position("_names", F.lit("timestamp_ms")), F.lit(0)),
                F.nullif(F.array_position("_names", F.lit("timestamp")), F.lit(0)),
            ),
        )
        .withColumn("_msg_at", F.coalesce(F.nullif(F.array_position("_names", F.lit("message")), F.lit(0)), F.lit(2)))
        .withColumn("_header_pos", F.when(F.col("block") == 0, F.col("_first_pos")))
        .withColumn("_sync", F.get(F.filter("_syncs", lambda x: x["at"] == F.col("_ts_at")), F.lit(0)))
        .withColumn("_sync", F.when(state == OUTSIDE, F.col("_sync.outside")).otherwise(F.col("_sync.inside")))
        .withColumn("_start", F.first("block").over(whole))
        .withColumn(
            "_carried",
            F.coalesce(
                F.last(F.when(F.col("_sync").isNotNull(), F.col("block")), ignorenulls=True).over(before), "_start"
            ),
        )
        .select(*BLOCK, "_sync", "_carried", "_header_pos", "_ts_at", "_msg_at")
    )


def _pin_splits(spark: SparkSession) -> None:
    """Keep the splitting of files independent of the executors that happen to be there.

    Both passes must see the same splits. Without a set minimum Spark derives the split size of
    small inputs from the cores registered at that moment.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        parallelism = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
        spark.conf.set(
            "spark.sql.files.minPartitionNum", str(parallelism or spark.sparkContext.defaultParallelism)
        )


def read_log_csv(
    spark: SparkSession, path: str, service_from: str = "stem", after: int | None = None, upto: int | None = None,
    max_record: int = MAX_RECORD,
) -> DataFrame:
    """CSV rows as (file, service_name, block, rid, ts_ms, message), in order within (file, block).

    No log entry crosses a `block` of the result. A field that is missing reads as the empty text.
    The first pass runs at once and stores one row per block; that table is broadcast if its count
    allows, so the lines themselves are shuffled only once.
    """
    _pin_splits(spark)
    lines = discover_log_files(spark, path, service_from, after, upto)
    blocks = broadcast_if_small(materialize(_block_table(lines), "blocks"))
    moved = F.raise_error(F.lit("file splits differ between the two passes; read the files again")).cast("boolean")
    usable = F.when(F.col("_carried").isNull(), moved).otherwise(F.col("_ts_at").isNotNull())
    located = lines.join(blocks, BLOCK, "left").where(usable)
    owner = F.when(F.col("pos") >= F.col("_sync"), F.col("block")).otherwise(F.col("_carried"))
    owned = _with_effect(
        located.where(~F.col("pos").eqNullSafe(F.col("_header_pos"))).withColumn("_owner", owner)
    )
    stated = _with_state(owned, ["file", "_owner"], ["block", "pos"])
    running = (
        Window.partitionBy("file", "_owner").orderBy("block", "pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    of_record = (
        Window.partitionBy("file", "_owner", "rid").orderBy("block", "pos")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    records = (
        stated.withColumn("_begins", F.coalesce(F.col("_known"), F.col("_odd")) == OUTSIDE)
        .withColumn("rid", F.sum(F.col("_begins").cast("bigint")).over(running))
        .withColumn("_record", joined_lines(F.col("value"), of_record, max_record, F.col("file"), F.col("_owner")))
        .where(F.col("_begins") & (F.col("_record") != ""))
        .withColumn("_fields", csv_fields(F.col("_record")))
    )

    def field(position: str) -> Column:
        return F.coalesce(unquote(F.get("_fields", (F.col(position) - 1).cast("int"))), F.lit(""))

    return records.select(
        "file", "service_name", F.col("_owner").alias("block"), "rid",
        strip(field("_ts_at")).alias("ts_ms"), field("_msg_at").alias("message"),
    )


def parse_entries(entries: DataFrame) -> DataFrame:
    """Parsed fields, resolved time, status, latency and error flag of merged entries.

    Entries of another shape stay, with `parsed = false`, for the statistics.
    """
    stamp = F.when(F.col("parsed"), resolve_timestamp(F.col("timestamp"), F.col("ts_ms")))
    return enrich(parse_lines(entries)).withColumn("timestamp_dt", stamp)


def entries_from_rows(rows: DataFrame, file: list[str], aligned: bool = False, max_entry: int = MAX_RECORD) -> DataFrame:
    """Merge continuation rows: a row whose time is not 13 digits continues the entry before it."""
    return merge_continuations(rows, valid_epoch_ms(F.col("ts_ms")), file, aligned=aligned, max_entry=max_entry)


def read_logs(
    spark: SparkSession, path: str, service_from: str = "stem", strip_suffix: bool = False, after: int | None = None,
    upto: int | None = None, max_record: int = MAX_RECORD,
) -> DataFrame:
    """Parsed log entries of all files below a folder.

    `strip_suffix` drops a trailing `-<digits>` from service names; labels that carry the number
    then no longer match, so it is off by default.
    """
    rows = read_log_csv(spark, path, service_from, after, upto, max_record)
    if strip_suffix:
        rows = rows.withColumn("service_name", clean_service_name(F.col("service_name")))
    entries = entries_from_rows(rows, ["file", "service_name"], aligned=True, max_entry=max_record)
    return parse_entries(entries).where("parsed").select(*LOG.fieldNames())


def parse_stats(entries: DataFrame, by: list[str]) -> DataFrame:
    """Entries, parsed, failed, merged continuations, errors, latency samples and valid documents."""
    return entries.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if("parsed").alias("parsed_lines"),
        F.count_if(~F.col("parsed")).alias("failed_lines"),
        F.sum("n_continuations").alias("merged_stack_traces"),
        F.count_if(F.coalesce("is_error", F.lit(False))).alias("error_count"),
        F.count("latency_ms").alias("latency_count"),
        F.count_if(F.col("parsed") & F.col("timestamp_dt").isNotNull()).alias("valid_documents"),
    )
