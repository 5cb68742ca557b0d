"""Log documents: conversion, storage and scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.functions.times import to_epoch_us, utc_day
from triagelake.schemas import DOC

# Field names a store may use, by their role here.
FIELDS = {
    "timestamp": "_timestamp",
    "service": "service_name",
    "level": "log_level",
    "latency": "latency_ms",
    "status_code": "status_code",
}


def to_log_documents(logs: DataFrame, with_req_id: bool = True) -> DataFrame:
    """Parsed logs as documents; entries without a time are dropped, absent fields are null."""
    docs = logs.where(F.col("timestamp_dt").isNotNull()).select(
        to_epoch_us(F.col("timestamp_dt")).alias("_timestamp"),
        "service_name",
        F.upper("level").alias("log_level"),
        F.col("log_text").alias("message"),
        "correlation_id",
        "tenant_id",
        "is_error",
        F.when(~F.isnan("latency_ms"), F.col("latency_ms")).alias("latency_ms"),
        F.col("status_code").cast("bigint").alias("status_code"),
        F.nullif("req_id", F.lit("")).alias("req_id"),
    )
    return docs if with_req_id else docs.drop("req_id")


def to_json_lines(docs: DataFrame) -> DataFrame:
    """One JSON object per document; null fields are left out."""
    return docs.select(F.to_json(F.struct(*docs.columns)).alias("json"))


def write_log_documents(docs: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Store documents by UTC day. The rebalance hint evens out file sizes and splits a heavy day."""
    dated = docs.withColumn("ds", utc_day(F.timestamp_micros("_timestamp")))
    dated.hint("rebalance", "ds").write.mode(mode).partitionBy("ds").format(fmt).save(path)


def read_log_docs(
    spark: SparkSession,
    path: str,
    service: str | None = None,
    start: Column | None = None,
    end: Column | None = None,
    columns: list[str] | None = None,
    fields: dict[str, str] | None = None,
    fmt: str = "parquet",
    ordered: bool = False,
) -> DataFrame:
    """Documents of a service and time range, with standard field names.

    The time test is put on the stored number and on the day folder, so both reach the scan.
    `fields` names the store's own fields by role; `columns` limits the result.
    """
    names = {**FIELDS, **(fields or {})}
    schema = T.StructType([*DOC.fields, T.StructField("ds", T.DateType())])
    if fields:
        renamed = {FIELDS[role]: name for role, name in fields.items()}
        schema = T.StructType([T.StructField(renamed.get(f.name, f.name), f.dataType) for f in schema])
    docs = spark.read.schema(schema).format(fmt).load(path)
    return scan_docs(docs, names, service, start, end, columns, ordered)


def scan_docs(
    docs: DataFrame,
    names: dict[str, str] | None = None,
    service: str | None = None,
    start: Column | None = None,
    end: Column | None = None,
    columns: list[str] | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Filter, project and optionally sort a document table."""
    names = {**FIELDS, **(names or {})}
    stamp = F.col(names["timestamp"])
    kept = docs
    if service is not None:
        kept = kept.where(F.col(names["service"]) == service)
    for bound, compare in ((start, "ge"), (end, "le")):
        if bound is None:
            continue
        micros, day = F.unix_micros(bound), utc_day(bound)
        kept = kept.where(stamp >= micros if compare == "ge" else stamp <= micros)
        if "ds" in docs.columns:
            kept = kept.where(F.col("ds") >= day if compare == "ge" else F.col("ds") <= day)
    standard = {names[role]: FIELDS[role] for role in FIELDS}
    kept = kept.withColumnsRenamed({k: v for k, v in standard.items() if k != v and k in docs.columns})
    kept = kept.withColumn("timestamp_dt", F.timestamp_micros("_timestamp")).drop("ds")
    if columns:
        kept = kept.select(*columns)
    return kept.orderBy("timestamp_dt") if ordered else kept
