"""Landed bank pages into the six bank tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finledger.operators import flatten
from finledger.operators.control import (
    EVENT_DDL,
    advance_control,
    finish_run,
    fold_runs,
    start_run,
    window_for,
)
from finledger.operators.mutate import insert_missing, reset_tables
from finledger.operators.normalize import TABLE_OF, normalize
from finledger.schemas import CONTROL_SEED, SPECS, TableSpec
from finledger.session import folder_exists, remove_folder
from finledger.sources.commits import transact
from finledger.sources import aliases as A
from finledger.sources.conform import conform, rename_fields
from finledger.sources.landing import (
    expand_record,
    extract_records,
    page_completeness,
    stitch_pages,
)
from finledger.sources.tables import (
    GONE,
    prepare,
    read_table,
    reconcile_table,
    stage,
    upsert_table,
    write_table,
)

# Order of the steps of one cycle.
STEPS = ("account", "balance", "movement", "transfer", "voucher", "extract")


def wire_rows(pages: DataFrame, dataset: str) -> DataFrame:
    """Flat text rows of one dataset, names folded, request parameters filled in."""
    records = extract_records(pages, record=A.wire_schema(dataset))
    rows = expand_record(records, keep=("account_number", "bank_number", "movement_type"))
    if dataset == "balance":
        rows = flatten.balances(rows)
    elif dataset == "transfer":
        rows = flatten.transfers(rows)
    elif dataset == "voucher":
        rows = flatten.vouchers(rows)
    elif dataset == "extract":
        rows = flatten.statements(rows)
    else:
        rows = rename_fields(rows, A.alias_map(dataset))
    # the account is not in the record, the request is the only place that knows it
    if dataset == "movement":
        rows = flatten.inject_request_params(
            rows, source_account=F.col("req_account_number"),
            movement_type=F.col("req_movement_type"), account_number=F.col("req_account_number"),
        )
    elif dataset == "extract":
        rows = flatten.inject_request_params(rows, source_account=F.col("req_account_number"))
    return rows.drop("req_account_number", "req_bank_number", "req_movement_type")


def arrival_block() -> Column:
    """Stretches of 1000 pages of one fetch: the unit in which arrival order is ranked."""
    return F.struct(F.col("ordinal.fetched_at"), F.floor(F.col("ordinal.page") / 1000))


def bank_rows(pages: DataFrame, dataset: str, as_of: Column, feed: str | None = None,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed, keyed rows of one dataset, ready to merge."""
    rows = wire_rows(stitch_pages(pages), dataset)
    if dataset == "movement":
        feed = feed or "anteriores"
        if feed == "dia":
            return normalize(rows, dataset, feed, as_of, ["ordinal"], arrival_block(), keep)
        return normalize(rows, dataset, feed, keep=keep)
    return normalize(rows, dataset, keep=keep)


def sync_dataset(
    spark: SparkSession, root: str, pages: DataFrame, dataset: str, as_of: Column, batch_id: str,
    specs: Mapping[str, TableSpec] = SPECS,
) -> dict[str, int]:
    """Merge the landed pages of one dataset; a record seen twice counts once, the last one.
    Returns the counters of the batch."""
    spec = specs[TABLE_OF[dataset]]
    feed = "anteriores" if dataset == "movement" else None
    if feed:
        pages = pages.where(F.col("movement_type") == feed)
    rows = bank_rows(pages, dataset, as_of, feed, keep=("ordinal",))
    return upsert_table(spark, f"{root}/{spec.name}", spec, rows, as_of, batch_id, ordinal=("ordinal",))


def newest_complete(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pages of each account's newest complete request, and the requests of accounts that
    have none, with what they lack. Landed cycles pile up in a folder; ranking two of them
    together would see every movement twice."""
    who = ["account_number", "bank_number"]
    requests = (
        pages.groupBy("request_id", *who).agg(F.max("fetched_at").alias("fetched_at"))
        .join(page_completeness(pages), "request_id")
        .withColumn("who", F.struct(*who))
    )
    newest = requests.where("complete").groupBy("who").agg(
        F.max_by("request_id", F.struct("fetched_at", "request_id")).alias("request_id")
    )
    kept = pages.join(newest.select("request_id").distinct(), "request_id", "left_semi")
    failed = requests.join(newest.select("who"), "who", "left_anti").select(
        "request_id", *who, "fetched_at", "pages_landed", "missing_pages", "more_expected"
    )
    return kept, failed


def sync_same_day(
    spark: SparkSession, root: str, pages: DataFrame, as_of: Column, batch_id: str,
    scope: DataFrame | None = None, specs: Mapping[str, TableSpec] = SPECS,
) -> dict[str, int]:
    """Bring the same-day rows in line with each account's newest complete feed.

    Accounts without a complete request keep their rows; their requests are written to
    ``failed_requests`` and counted. ``scope`` lists the accounts to bring in line; by default those
    with a complete request. Returns the counters of the batch.
    """
    spec = specs["ib_movements"]
    kept, failed = newest_complete(pages.where(F.col("movement_type") == "dia"))
    failures, folder = stage(failed, "failed")
    count = failures.count()
    if count:
        failures.write.mode("overwrite").parquet(f"{root}/failed_requests/batch={batch_id}")
    remove_folder(spark, folder)
    if scope is None:
        scope = kept.select(F.trim("account_number").alias("source_account")).distinct()
    rows = bank_rows(kept, "movement", as_of, "dia")
    done = reconcile_table(spark, f"{root}/{spec.name}", spec, rows, as_of, batch_id, scope)
    return {**done, "failed_requests": count}


# -- one cycle ------------------------------------------------------------------------------
CONTROL = TableSpec("sync_control", ("process_name",), buckets=1)


def read_control(spark: SparkSession, root: str) -> DataFrame:
    """The control rows; before the first cycle those of the seed, which never ran."""
    seed = conform(
        spark.createDataFrame(list(CONTROL_SEED), "process_name STRING, source_system STRING"),
        CONTROL.schema,
    )
    return insert_missing(read_table(spark, f"{root}/sync_control", CONTROL), seed, CONTROL.keys)


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """Current state of every run in the ledger."""
    path = f"{root}/run_events"
    events = spark.read.schema(EVENT_DDL).parquet(path) if folder_exists(spark, path) \
        else spark.createDataFrame([], EVENT_DDL)
    return fold_runs(events)


def run_step(
    spark: SparkSession, root: str, dataset: str, pages: DataFrame, as_of: Column, batch_id: str,
    specs: Mapping[str, TableSpec] = SPECS,
) -> dict[str, int]:
    """One step of a cycle: a dataset, for movements the settled ones and then the same day's."""
    done = sync_dataset(spark, root, pages, dataset, as_of, batch_id, specs)
    if dataset == "movement":
        today = sync_same_day(spark, root, pages, as_of, batch_id, specs=specs)
        done = {k: done.get(k, 0) + today.get(k, 0) for k in {**done, **today}}
    return done


def run_cycle(
    spark: SparkSession, root: str, feeds: Mapping[str, DataFrame], as_of: dt.datetime, batch_id: str,
    specs: Mapping[str, TableSpec] = SPECS, step: Callable[..., dict[str, int]] = run_step,
) -> dict[str, dict[str, int] | None]:
    """All steps in order over the landed pages of each dataset.

    Every step has its row in the ledger (RUNNING, then SUCCESS or ERROR with its counters) and in
    the control table; one that fails does not stop the next, and does not move its window.
    Returns the counters per step, None where it failed.
    """
    control, now = read_control(spark, root), F.lit(as_of).cast("timestamp_ntz")
    source = {p: s for p, s in CONTROL_SEED}
    first = read_runs(spark, root).agg(F.coalesce(F.max("sync_run_id"), F.lit(0))).first()[0] + 1
    log = f"{root}/run_events"
    counters, outcomes = {}, []
    for run_id, dataset in enumerate((d for d in STEPS if d in feeds), first):
        process = TABLE_OF[dataset]
        begin, end = window_for(control, process, as_of)
        start_run(spark, run_id, process, source[process], as_of).write.mode("append").parquet(log)
        error, done = None, None
        try:
            done = step(spark, root, dataset, feeds[dataset], now, batch_id, specs)
        except Exception as e:  # whatever it was: it is told in ledger and control
            error = (str(e).splitlines() or [type(e).__name__])[0][:2000]
        read, upserted, gone = ((done or {}).get(k) for k in ("read", "upserted", "deleted"))
        finish_run(
            spark, run_id, process, source[process], as_of, error is None, read or 0, upserted or 0,
            gone, error,
        ).write.mode("append").parquet(log)
        counters[dataset] = done
        outcomes.append((process, error is None, begin, end, as_of, error))
    ran = spark.createDataFrame(
        outcomes, "process_name STRING, ok BOOLEAN, begin_date DATE, end_date DATE, "
        "at TIMESTAMP_NTZ, error STRING",
    )
    write_table(advance_control(control, ran), f"{root}/sync_control", CONTROL, batch_id)
    return counters


def reset(
    spark: SparkSession, root: str, specs: Sequence[TableSpec], as_of: dt.datetime, batch_id: str
) -> None:
    """Empties these tables, in the given order (``RESET_ORDER``: children first), and sets every
    control row back to "never ran", all in one commit. Ids given so far are not given again."""
    now = F.lit(as_of).cast("timestamp_ntz")
    empty, cleared = reset_tables(
        {s.name: spark.createDataFrame([], s.schema) for s in specs}, read_control(spark, root), now
    )

    def build(at: int):
        changes = [
            prepare(spark, f"{root}/{s.name}", s, empty[s.name].withColumn(GONE, F.lit(False)), batch_id,
                    at, whole=True)
            for s in specs
        ]
        changes.append(prepare(
            spark, f"{root}/{CONTROL.name}", CONTROL, cleared.withColumn(GONE, F.lit(False)), batch_id,
            at, whole=True,
        ))
        return changes, None

    transact(spark, root, batch_id, build)
