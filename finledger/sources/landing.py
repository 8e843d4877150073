"""Landed API pages: reading them, taking the records out, checking page completeness.

A landed page is one row: source, endpoint, request_id, account_number, bank_number,
movement_type, page, page_size, fetched_at, body.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_SCHEMA = """source STRING, endpoint STRING, request_id STRING, account_number STRING,
    bank_number STRING, movement_type STRING, page INT, page_size INT,
    fetched_at TIMESTAMP_NTZ, body STRING"""

# Where a response keeps its records, in order of preference.
RECORD_KEYS = (
    "accounts", "transfers", "statements", "movements_detail",
    "data", "results", "items", "content",
    "movimientos", "cuentas", "saldos", "transferencias", "extractos", "comprobantes",
)


def read_pages(spark: SparkSession, path: str, schema: str | T.StructType = PAGE_SCHEMA) -> DataFrame:
    """Landed pages as JSON lines with a declared schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


def stream_pages(
    spark: SparkSession, path: str, schema: str | T.StructType = PAGE_SCHEMA,
    fmt: str = "json", **options: str,
) -> DataFrame:
    """The same rows as a stream, from files or from the values of a message bus."""
    reader = spark.readStream.format(fmt).options(**options)
    return reader.schema(schema).load(path) if fmt != "kafka" else parse_messages(reader.load(), schema)


def parse_messages(messages: DataFrame, schema: str | T.StructType = PAGE_SCHEMA) -> DataFrame:
    """Rows of a message bus (binary ``value`` holding JSON) as landed pages."""
    row = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(row.alias("m")).select("m.*")


def with_records(
    df: DataFrame, body: str = "body", record: T.DataType | None = None,
    keys: Sequence[str] = RECORD_KEYS,
) -> DataFrame:
    """The records of each response body as array column ``records``: first listed key that
    holds an array, or the body itself when it is an array, else NULL.

    The body is parsed once, in a projection of its own. With a record type that gives
    typed rows, of which Catalyst reads the fields that are used; without one, records
    are VARIANT and the parsed body stays as ``parsed``.
    """
    if record is None:
        out = df.withColumn("parsed", F.try_parse_json(body))
        paths = ["$", *[f"$.{k}" for k in keys]]
        found = [f"try_variant_get(parsed, '{p}', 'array<variant>')" for p in paths]
        return out.withColumn("records", F.expr(f"coalesce({', '.join(found)})"))
    rows = T.ArrayType(record)
    envelope = T.StructType([T.StructField(k, rows) for k in keys])
    out = df.withColumns(
        {
            "__envelope": F.from_json(F.col(body), envelope),
            "__bare": F.when(F.ltrim(body).startswith("["), F.from_json(F.col(body), rows)),
        }
    )
    found = ["__bare", *[f"__envelope.`{k}`" for k in keys]]
    out = out.withColumn("records", F.expr(f"coalesce({', '.join(found)})"))
    return out.drop("__envelope", "__bare")


def extract_records(
    df: DataFrame, body: str = "body", record: T.DataType | None = None,
    keys: Sequence[str] = RECORD_KEYS,
) -> DataFrame:
    """One row per record with ``ordinal`` = (fetched_at, page, pos): the arrival order
    that "last wins" and "first wins" rules need. Request columns are carried along."""
    rest = [c for c in df.columns if c != body]
    # the outer form, because the plain one tests the array in a filter below and so
    # has every body parsed once more
    out = with_records(df, body, record, keys).select(
        *rest, F.posexplode_outer("records").alias("pos", "record")
    ).where(F.col("pos").isNotNull())
    order = [c for c in ("fetched_at", "page", "pos") if c in out.columns]
    return out.withColumn("ordinal", F.struct(*order)).drop("pos")


def expand_record(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Record members as columns, next to the kept request columns and the ordinal.

    A request column is prefixed ``req_`` so that it cannot hide a record member.
    """
    return df.select(
        *[F.col(c).alias(f"req_{c}") for c in keep], "ordinal", "record.*"
    )


def stitch_pages(df: DataFrame) -> DataFrame:
    """One body per (request, page): a page landed again replaces the earlier landing."""
    keys = ["request_id", "page"]
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct("fetched_at", "body")).alias("last"))
        .select(*keys, "last.*")
    )


def _number(path: str) -> Column:
    return F.try_variant_get("parsed", path, "string").try_cast("bigint")


def has_next_page() -> Column:
    """Whether a response (``parsed``, ``n`` records, ``page``, ``page_size``) says that more
    pages follow.

    ``general_data.total_rows``, then ``totalPages``, ``last``, ``totalElements``; without any
    of them a full page means that another one follows. An empty page ends the request.
    """
    page, size, n = F.col("page"), F.col("page_size"), F.col("n")
    total_rows, total_pages = _number("$.general_data.total_rows"), _number("$.totalPages")
    last = F.try_variant_get("parsed", "$.last", "boolean")
    total_elements = _number("$.totalElements")
    reached = (page + 1) * size
    return (
        F.when(n <= 0, F.lit(False))
        .when(total_rows.isNotNull(), reached < total_rows)
        .when(total_pages.isNotNull(), page + 1 < total_pages)
        .when(last.isNotNull(), ~last)
        .when(total_elements.isNotNull(), reached < total_elements)
        .otherwise(n >= size)
    )


def page_completeness(df: DataFrame) -> DataFrame:
    """Per request: pages landed, records, whether the last page promised more, gaps.

    Pages are first reduced to one row per (request, page), so a request with very
    many landings never gathers in one task before it is small.
    """
    per_page = (
        with_records(df.select("request_id", "page", "page_size", "fetched_at", "body"))
        .withColumn("n", F.coalesce(F.size("records"), F.lit(0)))
        .select("request_id", "page", "fetched_at", "n", has_next_page().alias("more"))
        .groupBy("request_id", "page")
        .agg(F.max_by(F.struct("n", "more"), "fetched_at").alias("p"))
    )
    out = per_page.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("pages_landed"),
        F.max("page").alias("last_page"),
        F.sum("p.n").alias("records"),
        F.max_by("p.more", "page").alias("more_expected"),
    )
    missing = F.col("last_page") + 1 - F.col("pages_landed")
    return out.withColumns(
        {
            "missing_pages": missing.cast("bigint"),
            "complete": (missing == 0) & ~F.col("more_expected"),
        }
    )


def inspect_sections(df: DataFrame, body: str, sections: dict[str, str]) -> DataFrame:
    """Total matches and how many documents hold a non-empty value per section.

    ``sections`` maps an output name to a JSON path. Null, ``{}`` and ``[]`` count as empty.
    """
    v = F.try_parse_json(F.col(body))
    texts = {n: F.to_json(F.try_variant_get(F.col("__v"), p, "variant")) for n, p in sections.items()}
    counts = [
        F.count_if(t.isNotNull() & ~t.isin("null", "{}", "[]")).alias(n) for n, t in texts.items()
    ]
    return df.select(v.alias("__v")).agg(F.count(F.lit(1)).alias("total"), *counts)
