"""Text extraction from log lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.schemas import DOC_ERROR_LEVELS, ERROR_KEYWORDS, ERROR_LEVELS

# Patterns of the log format.
ANSI = r"\x1b\[[0-9;]*m"
EPOCH_MS = r"^[0-9]{13}$"
LINE_HEAD = r"(?s)^(?:\[?([^|\]]+)\|\]?)?(.+?):\s+"
LATENCY = r"(?i)\[End Request\].*?([\d.]+)\s*ms"
STATUS = r"\[End Request\]\s+(\w+)\s+(\S+)\s+(\d{3})"

WHITESPACE = " \t\n\r\f\x0b"


def strip(col: Column) -> Column:
    """Remove blanks, tabs and line ends on both sides."""
    return F.btrim(col, F.lit(WHITESPACE))


def strip_ansi(col: Column) -> Column:
    """Remove terminal colour codes."""
    return F.when(F.contains(col, F.lit("\x1b")), F.regexp_replace(col, ANSI, "")).otherwise(col)


def parse_lines(df: DataFrame, message: str = "message") -> DataFrame:
    """Split each message into level, correlation_id, tenant_id, req_id, timestamp and log_text.

    The three leading fields are cut off by position. One regular expression then looks at the
    rest only up to the first `:` followed by a blank, so the cost does not grow with the message
    body. Lines of another shape get `parsed = false` and null fields.
    """
    clean = df.withColumn("_clean", strip_ansi(strip(F.col(message))))
    parts = clean.withColumn("_parts", F.split("_clean", r"\|", 4))
    rest = F.get("_parts", F.lit(3))
    head = parts.withColumn("_head", F.regexp_extract(rest, LINE_HEAD, 0))
    filled = reduce(
        lambda a, b: a & b,
        [F.length(F.get("_parts", F.lit(i))) > 0 for i in range(3)] + [F.length("_head") > 0],
    )
    ok = head.withColumn("parsed", F.coalesce(filled, F.lit(False)))

    def when_parsed(col: Column) -> Column:
        return F.when(F.col("parsed"), col)

    # Without a further `|` there is no request id, and the time is the head up to its last colon.
    with_req = F.contains("_head", F.lit("|"))
    bare = strip(F.col("_head"))
    req_id = F.when(with_req, strip(F.regexp_extract("_head", LINE_HEAD, 1))).otherwise("")
    stamp = F.when(with_req, F.regexp_extract("_head", LINE_HEAD, 2)).otherwise(
        F.substring(bare, F.lit(1), F.length(bare) - 1)
    )

    return ok.withColumns({
        "level": when_parsed(F.lower(strip(F.get("_parts", F.lit(0))))),
        "correlation_id": when_parsed(strip(F.get("_parts", F.lit(1)))),
        "tenant_id": when_parsed(strip(F.get("_parts", F.lit(2)))),
        "req_id": when_parsed(req_id),
        "timestamp": when_parsed(strip(stamp)),
        "log_text": when_parsed(strip(F.substring(rest, F.length("_head") + 1, F.length(rest)))),
    }).drop("_clean", "_parts", "_head")


def extract_latency_ms(text: Column) -> Column:
    """Milliseconds reported by an end-of-request line; null when absent or not a number."""
    return F.regexp_extract(text, LATENCY, 1).try_cast("double")


def extract_status_code(text: Column) -> Column:
    """HTTP status of an end-of-request line; null outside 100 to 599."""
    code = F.regexp_extract(text, STATUS, 3).try_cast("int")
    return F.get(F.filter(F.array(code), lambda c: c.between(100, 599)), F.lit(0))


def has_error_keyword(lowered: Column) -> Column:
    """Any error keyword in text that is already in lower case."""
    return reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(word)) for word in ERROR_KEYWORDS])


def is_error(level: Column, lowered: Column | None = None, policy: str = "logs") -> Column:
    """`logs`: five levels or any keyword in the lower-case text; `docs`: three levels only."""
    if policy == "docs":
        return F.coalesce(F.upper(level).isin(DOC_ERROR_LEVELS), F.lit(False))
    if policy != "logs":
        raise ValueError(f"unknown error policy: {policy}")
    by_level = F.coalesce(level.isin(ERROR_LEVELS), F.lit(False))
    if lowered is None:
        return by_level
    return by_level | F.coalesce(has_error_keyword(lowered), F.lit(False))


def enrich(df: DataFrame, text: str = "log_text", level: str = "level") -> DataFrame:
    """Add status_code, latency_ms and is_error of a log text.

    The lower-case text is made once per row; the two expressions of end-of-request lines run only
    on texts that name one.
    """
    ended = F.contains("_lower", F.lit("[end request]"))
    return (
        df.withColumn("_lower", F.lower(text))
        .withColumns({
            "status_code": F.when(ended, extract_status_code(F.col(text))),
            "latency_ms": F.when(ended, extract_latency_ms(F.col(text))),
            "is_error": F.when(F.col("_lower").isNotNull(), is_error(F.col(level), F.col("_lower"))),
        })
        .drop("_lower")
    )


def valid_epoch_ms(col: Column) -> Column:
    """True for exactly 13 digits, blanks around them allowed."""
    return F.coalesce(strip(col).rlike(EPOCH_MS), F.lit(False))


def clean_service_name(col: Column) -> Column:
    """Drop a trailing `-<digits>`."""
    return F.regexp_replace(col, r"-\d+$", "")


def last_path_segment(col: Column) -> Column:
    return F.element_at(F.split(col, "/"), -1)


def safe_double(col: Column) -> Column:
    """Number from text; blank, `nan`, `None` and other words become null."""
    value = strip(col.cast("string")).try_cast("double")
    return F.when(~F.isnan(value), value)


def safe_long(col: Column) -> Column:
    return safe_double(col).try_cast("bigint")
