"""End-to-end flows: inbound (X1), outbound (X2), view -> table.

Inbound, per run:
  count request (one task) -> page plan -> waves of parallel fetches, each
  landed as one job -> planned against landed records -> one lazy plan over
  the landed bodies: extract -> infer/ignore/merge/diff -> conform ->
  blank->null -> envelope -> dynamic-overwrite of the load's partition;
  records that do not fit go to quarantine.
Outbound, per run:
  SQL source -> stable global index -> batches -> bodies, kept as the run's
  snapshot -> waves: skip delivered, send on executors, append the log.
Both open and close an append-only audit record and re-raise on failure. A
run whose landed or delivered records are not those planned fails.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ferry.config import ExchangeConfig
from ferry.functions import encode, envelope as env, extract
from ferry.operators import audit, chunking, delivery, evolve, schema as sch, sink
from ferry.plans import paging
from ferry.session import ensure_checkpoint_dir, remove_path, scratch_path
from ferry.sources import pages, tables

log = logging.getLogger("ferry")

#: Batches sent and logged per Spark job, for each core.
BATCHES_PER_CORE = 64
SNAPSHOT = "batch_num bigint, n bigint, body string, wave int"
DELIVERY_LOG = f"{delivery.DELIVERY_SCHEMA}, delivered_at timestamp, audit_id string, wave int"


class SchemaConflict(RuntimeError):
    """A stored field would change type; the load needs a new table version."""


class IncompleteLoad(RuntimeError):
    """Pages are missing, short or unreadable; they stay open and a rerun fetches them again."""


@dataclass
class LoadResult:
    audit_id: str
    load_id: str
    source_count: int = 0
    total_obj_count: int = 0
    loaded_obj_count: int = 0
    target_count: int = 0
    quarantined: int = 0
    rejected: int = 0
    schema: StructType | None = None
    diff: dict = field(default_factory=dict)


def _now() -> datetime:
    return datetime.now(timezone.utc)


# ------------------------------------------------------------------ inbound

def _fetch_tasks(plan: DataFrame, n_pages: int, parallelism: int | None) -> DataFrame:
    """Spread a wave's plan over fetch tasks after the resume anti-join.

    AQE would coalesce the join's small output (a few thousand plan rows)
    into one partition, i.e. one task fetching the whole wave; a repartition
    to an explicit count is never coalesced. ``parallelism`` caps the tasks
    (rate limits), else one per core.
    """
    cores = plan.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(int(parallelism or cores), max(n_pages, 1)))
    return plan.repartition(tasks, "page")


def _land_wave(spark, cfg, plan, fetch, landing_path, load_id, wave, concurrency=1) -> None:
    """Fetch and land one wave; a body that cannot be read fails the run once the wave is landed."""
    pages.land(pages.fetch_pages(plan, fetch, None, concurrency), landing_path, cfg.source_id, load_id, wave,
               cfg.data_field, cfg.response_format, cfg.soap, bool(cfg.namespace))


def _check_bodies(spark, cfg, landing_path, load_id) -> None:
    """Raise if a page has unreadable bodies only."""
    bad = pages.bad_bodies(spark, landing_path, cfg.source_id, load_id).select("page", "status")
    good = pages.landed_pages(spark, landing_path, cfg.source_id, load_id).select("page")
    left = bad.join(good, "page", "left_anti").agg(F.count_distinct("page").alias("n"), F.min("page").alias("first")).first()
    if left["n"]:
        raise IncompleteLoad(f"{left['n']} pages with unreadable bodies, the first is page {left['first']}")


def _whole(landed: Column) -> Column:
    """Whether a planned page has landed as asked for: neither short nor over-full."""
    return F.coalesce((landed >= F.col("expected")) & (F.col("most").isNull() | (landed <= F.col("most"))), F.lit(False))


def _short_of_plan(spark, plan: DataFrame, landing_path: str, source_id: str, load_id: str) -> DataFrame:
    """The planned pages (``page``, ``expected``, ``most`` and request fields) that have not landed as asked for: short, or over-full."""
    done = pages.landed_pages(spark, landing_path, source_id, load_id).withColumnRenamed("n_records", "_landed")
    return plan.join(done, "page", "left").filter(~_whole(F.col("_landed"))).drop("_landed")


def land_all_pages(
    spark: SparkSession,
    cfg: ExchangeConfig,
    fetch: Callable[[dict], str | None],
    landing_path: str,
    load_id: str,
    parallelism: int | None = None,
    concurrency: int = 1,
) -> tuple[int | None, int]:
    """Count request, plan and waves of fetch+land. Returns (total, planned pages).

    Raises ``IncompleteLoad`` unless every planned page has landed with the
    records it should hold.
    """
    where = (landing_path, cfg.source_id, load_id)
    fresh = pages.landed(spark, *where).limit(1).count() == 0
    page_size, since = int(cfg.page_size or 1), _now()
    # what earlier runs have landed, read once; checkpointed, as a cached read would be made anew after each wave's write
    before = pages.landed_pages(spark, *where)
    full, other = pages.landed_sets(before.limit(0) if fresh else before, page_size)
    if not fresh:
        ensure_checkpoint_dir(spark)
        full, other = full.checkpoint(), other.checkpoint()

    def fetch_wave(plan: DataFrame, n: int, wave: int) -> None:
        if not fresh:
            # Materialised first: left lazy and empty, AQE re-plans the join on its
            # first use and the wave's fetch collapses into a single task.
            plan = pages.with_landed(plan, full, other, page_size).filter(~_whole(F.col("landed"))).drop("landed").cache()
            n = plan.count()
        try:
            if n:
                _land_wave(spark, cfg, _fetch_tasks(plan.drop("expected", "most"), n, parallelism), fetch, landing_path, load_id, wave, concurrency)
        finally:
            if not fresh:
                plan.unpersist()

    if cfg.pagination_type is None:
        fetch_wave(paging.plan_pages(spark, 0, None, None).withColumn("expected", F.lit(0)).withColumn("most", F.lit(None).cast("bigint")), 1, 0)
        _check_bodies(spark, cfg, landing_path, load_id)
        return None, 1
    size, cores = int(cfg.page_size), spark.sparkContext.defaultParallelism
    wave = cfg.wave_size(cores)
    total = None
    if cfg.count_field:  # JSON or XML: the total is a field of the count response
        summary = extract.body_summary(
            pages.fetch_count(spark, fetch), cfg.data_field, cfg.count_field, cfg.response_format, cfg.soap, prefixes=bool(cfg.namespace)
        ).first()
        total = summary["total"]
        if total is None and cfg.response_format == "json":
            raise IncompleteLoad(f"the count response has no {cfg.count_field!r}")
    if total is not None:
        total = int(total)
        n = paging.page_count(total, size)
        expected = F.least(F.lit(size).cast("bigint"), F.lit(total) - F.col("page") * size)

        def planned(lo: int, hi: int) -> DataFrame:
            plan = paging.plan_pages(spark, total, size, cfg.pagination_type, first_page=lo, end_page=hi)
            # a page-index source may have grown since it was counted; no page may hold more than was asked for
            most = expected if cfg.pagination_type == paging.LIMIT_OFFSET else F.lit(size).cast("bigint")
            return plan.withColumn("expected", expected).withColumn("most", most)

        for w, lo in enumerate(range(0, n, wave)):
            fetch_wave(planned(lo, lo + wave), min(wave, n - lo), w)
        _check_bodies(spark, cfg, landing_path, load_id)
        short = _short_of_plan(spark, planned(0, n), *where).agg(F.count(F.lit(1)).alias("n"), F.min("page").alias("first")).first()
        if short["n"]:
            raise IncompleteLoad(f"{short['n']} of {n} pages hold fewer records than planned, or more than asked for, the first is page {short['first']}")
        return total, n
    # No total announced: fetch waves until a wave ends in a short page, all pages
    # after it empty. Waves start at one page per core and double up to the full
    # wave size, so requests past the end stay below the pages already read.
    lo, w, step = 0, 0, max(1, min(wave, cores))
    while True:
        plan = spark.range(lo, lo + step, 1, max(1, min(step, cores))).withColumnRenamed("id", "page")
        plan = plan.select("page", *paging.request_columns(F.col("page"), F.lit(None).cast("bigint"), size, cfg.pagination_type))
        if cfg.pagination_type == paging.LIMIT_OFFSET:
            plan = plan.withColumn("limit", F.lit(size).cast("bigint"))
        asked = F.lit(size).cast("bigint")
        fetch_wave(plan.withColumn("expected", asked).withColumn("most", asked), step, w)
        # this run's rows of the wave (files of others are skipped by their statistics) before what earlier runs have landed
        now = pages.landed_pages(spark, *where, wave=w, since=since).withColumnRenamed("n_records", "_now")
        state = pages.with_landed(plan, full, other, size).join(now, "page", "left")
        state = state.select("page", F.coalesce("_now", "landed").alias("n_records"))
        got = state.agg(
            F.count("n_records").alias("have"),
            F.min(F.when(F.col("n_records") < size, F.col("page"))).alias("short"),
            F.min(F.when(F.col("n_records") == 0, F.col("page"))).alias("empty"),
            F.max(F.when(F.col("n_records") > 0, F.col("page"))).alias("last"),
            F.min(F.when(F.col("n_records") > size, F.col("page"))).alias("full"),
        ).first()
        if got["have"] < step:
            _check_bodies(spark, cfg, landing_path, load_id)
            raise IncompleteLoad(f"{step - got['have']} of the pages from {lo} to {lo + step - 1} have not landed")
        if got["full"] is not None:
            raise IncompleteLoad(f"page {got['full']} holds more records than were asked for")
        if got["empty"] is not None and got["last"] is not None and got["empty"] < got["last"]:
            raise IncompleteLoad(f"page {got['empty']} is empty but page {got['last']} is not")
        lo, w = lo + step, w + 1
        if got["short"] is not None and (got["last"] is None or got["last"] <= got["short"]):
            break
        step = min(step * 2, wave)
    return None, pages.landed_pages(spark, *where).count()


def rejects_location(table_path: str) -> str:
    return f"{table_path.rstrip('/')}_rejects"


def read_rejects(spark: SparkSession, table_path: str) -> DataFrame:
    """``page, pos, path, text, load_id``: the values that loads with ``on_type_change="reject"`` could not type."""
    schema, path = "page bigint, pos int, path string, text string, load_id string", rejects_location(table_path)
    if not sink.path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def load_landed(
    spark: SparkSession,
    cfg: ExchangeConfig,
    bodies: DataFrame,
    table_path: str,
    load_id: str,
    load_ts: str | None = None,
    user: str | None = None,
    ignore: Sequence[str] = (),
    schema_audit_path: str | None = None,
    quarantine_path: str | None = None,
    on_type_change: str = "fail",
    max_records_per_file: int | None = None,
) -> LoadResult:
    """Landed bodies -> typed, enveloped rows in the load's partition.

    ``on_type_change``: ``"fail"`` raises ``SchemaConflict`` when a stored
    field would change type; ``"widen"`` first rewrites the stored rows with
    the widened type (see ``ferry.operators.evolve``); ``"reject"`` keeps the
    stored types: a value that does not fit is NULL in its row and kept as text in
    ``read_rejects``, the record's other fields are loaded. Records that do not
    fit, or are no objects, go to ``quarantine_path`` (default: beside the table).
    A load without records writes nothing and is no failure.
    """
    if on_type_change not in ("fail", "widen", "reject"):
        raise ValueError("on_type_change must be 'fail', 'widen' or 'reject'")
    rest = (table_path, load_id, load_ts, user, ignore, schema_audit_path, quarantine_path, on_type_change, max_records_per_file)
    if cfg.response_format != "xml":
        records = extract.extract_records(bodies, cfg.data_field, cfg.response_format, cfg.soap, prefixes=bool(cfg.namespace))
        return _load_records(spark, cfg, records, *rest)
    # parsing XML costs far more than storing what was parsed, and the records are read at least twice
    staged, prefixes = scratch_path(spark, "parsed"), bool(cfg.namespace)
    try:
        parsed = extract.parsed_bodies(bodies, cfg.response_format, prefixes=prefixes)
        parsed.write.parquet(staged)
        stored = spark.read.schema(parsed.schema).parquet(staged)
        return _load_records(spark, cfg, extract.parsed_records(stored, cfg.data_field, cfg.soap, prefixes=prefixes), *rest)
    finally:
        remove_path(spark, staged)


def _load_records(spark, cfg, records, table_path, load_id, load_ts, user, ignore, schema_audit_path, quarantine_path,
                  on_type_change, max_records_per_file) -> LoadResult:
    existing = tables.existing_payload_schema(spark, table_path)
    # ignored fields are dropped from what comes in, never from what is stored
    inferred = sch.drop_fields(sch.infer_schema(records), ignore)
    by_field = on_type_change == "reject"
    current = (sch.keep_stored if by_field else sch.merge_schemas)(existing, inferred)
    sch.check_names(current)
    quarantine_path = quarantine_path or f"{table_path.rstrip('/')}_quarantine"
    diff = sch.schema_diff(existing, current)
    ts = load_ts or _now().isoformat(sep=" ")
    if diff.type_changed:
        if on_type_change == "fail":
            raise SchemaConflict(f"stored fields would change type: {diff.type_changed}")
        evolve.widen_table(spark, table_path, current)
    if schema_audit_path and (diff.only_in_current or ignore):
        sch.schema_audit_rows(spark, table_path, diff, list(ignore), ts).write.mode("append").parquet(schema_audit_path)
    typed = (sch.conform_fields if by_field else sch.conform)(records, current)
    seen = Observation("ferry_records")
    lost = F.sum(F.size("rejects")) if by_field else F.lit(0)
    typed = typed.observe(seen, F.count(F.lit(1)).alias("all"), F.count(sch.CORRUPT).alias("bad"), lost.alias("lost"))
    written = rejected = 0
    if current.fields:
        sink.save_schema(spark, table_path, current)
        good, _ = sch.split_corrupt(typed.drop("rejects"))
        rows = env.envelope(env.blank_payload(good), cfg.source_id, load_id, ts, user)
        written = sink.write_partitions(rows, table_path, max_records_per_file=max_records_per_file)
        quarantined, rejected = int(seen.get.get("bad", 0) or 0), int(seen.get.get("lost", 0) or 0)
    else:  # no object anywhere: whatever is there does not fit
        quarantined = records.count()
    if written == 0:
        sink.drop_partition(spark, table_path, {"source_id": cfg.source_id, "load_id": load_id})
    rejects_path = rejects_location(table_path)
    if rejected:
        each = sch.conform_fields(records, current).select("page", "pos", F.explode("rejects").alias("r"))
        (
            each.select("page", "pos", "r.path", "r.text", F.lit(load_id).alias("load_id"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(rejects_path)
        )
    else:
        sink.drop_partition(spark, rejects_path, {"load_id": load_id})
    if quarantined:  # the bodies are read once more only if something did not fit
        told = records.withColumn("_text", F.to_json("record"))
        _, bad = sch.split_corrupt((sch.conform_fields if by_field else sch.conform)(told, current, keep=["page", "pos", "_text"]))
        (
            bad.select("page", "pos", F.col("_text").alias("record"), F.lit(load_id).alias("load_id"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_id")
            .parquet(quarantine_path)
        )
    else:  # a clean rerun must not leave the earlier run's rejects
        sink.drop_partition(spark, quarantine_path, {"load_id": load_id})
    return LoadResult(
        audit_id=load_id, load_id=load_id, target_count=written, quarantined=quarantined, rejected=rejected,
        schema=current, diff=diff.as_dict(),
    )


def run_inbound(
    spark: SparkSession,
    cfg: ExchangeConfig,
    fetch: Callable[[dict], str | None],
    *,
    landing_path: str,
    table_path: str,
    audit_path: str,
    load_ts: str | None = None,
    user: str | None = None,
    ignore: Sequence[str] = (),
    schema_audit_path: str | None = None,
    quarantine_path: str | None = None,
    parallelism: int | None = None,
    concurrency: int = 1,
    on_type_change: str = "fail",
    max_records_per_file: int | None = None,
    settings: DataFrame | None = None,
    catalog_table: str | None = None,
    check_content: bool = False,
    lease_seconds: int = 6 * 3600,
) -> LoadResult:
    """API pages -> landed bodies -> typed table; returns the run's counters.

    ``settings`` (``table_name``, ``field_name``) names fields to ignore, by the
    configured table name or else the table path. With an ad-hoc start date, or
    the checkpoint of the last successful run, every request has ``start_date``.
    ``catalog_table`` registers the table under that name. Before the run closes
    as a success, every page's rows are counted against its landed records;
    with ``check_content`` their values are compared as well, which reads the
    bodies and the load once more. Of two runs of a pair at once the second is
    refused (``audit.claim``); a claim ends with its run, or
    after ``lease_seconds``.
    """
    if cfg.dataflow != "Inbound":
        raise ValueError("run_inbound needs an Inbound configuration")
    with audit.claim(spark, audit_path, cfg.source_id, cfg.destination_id, lease_seconds):
        return _run_inbound(spark, cfg, fetch, landing_path, table_path, audit_path, load_ts, user, ignore, schema_audit_path, quarantine_path,
                            parallelism, concurrency, on_type_change, max_records_per_file, settings, catalog_table, check_content)


def _run_inbound(spark, cfg, fetch, landing_path, table_path, audit_path, load_ts, user, ignore, schema_audit_path, quarantine_path,
                 parallelism, concurrency, on_type_change, max_records_per_file, settings, catalog_table, check_content) -> LoadResult:
    run = audit.open_run(spark, audit_path, cfg.source_id, cfg.destination_id)
    load_id = run.audit_id
    total, n_pages = None, 0
    start = cfg.adhoc_start_date or run.last_checkpoint
    if start is not None:  # an incremental source gets the date in every request
        fetch = _with_start_date(fetch, start if isinstance(start, str) else start.isoformat())
    try:
        if settings is not None:  # S5
            ignore = [*ignore, *tables.ignore_fields(settings, cfg.table_name or table_path)]
        total, n_pages = land_all_pages(spark, cfg, fetch, landing_path, load_id, parallelism, concurrency)
        bodies = pages.read_bodies(spark, landing_path, cfg.source_id, load_id)
        res = load_landed(spark, cfg, bodies, table_path, load_id, load_ts, user, ignore, schema_audit_path,
                          quarantine_path, on_type_change, max_records_per_file)
        _check_counts(spark, cfg, landing_path, table_path, quarantine_path or f"{table_path.rstrip('/')}_quarantine", load_id)
        if check_content and res.target_count:
            bad = content_reconciliation(spark, cfg, bodies, table_path, load_id, on_type_change == "reject").filter(F.col("status") != "ok")
            first = bad.orderBy("page").first()
            if first:
                raise IncompleteLoad(f"page {first['page']} differs between landing zone and table: {first['status']}")
        if catalog_table:
            sink.register_table(spark, table_path, catalog_table)
        res.total_obj_count = n_pages
        res.loaded_obj_count = pages.landed_pages(spark, landing_path, cfg.source_id, load_id).count()
        res.source_count = int(total) if total is not None else res.target_count + res.quarantined
        audit.close_run(spark, audit_path, run, audit.SUCCESS, res.source_count, res.total_obj_count,
                        res.loaded_obj_count, res.target_count)
        res.audit_id = run.audit_id
        return res
    except Exception:
        log.exception("inbound run %s failed", run.audit_id)
        done = pages.landed_pages(spark, landing_path, cfg.source_id, load_id).count()
        audit.close_run(spark, audit_path, run, audit.FAILED, int(total or 0), n_pages, done, 0)
        raise


def _payload_digest(rows: DataFrame, count: str, digest: str, good: Column | None = None) -> DataFrame:
    """Per page the number of payloads and a digest that does not depend on their order, but on how often each is there.

    With ``good``, those rows only; the others' number is ``rejected``. The good and the other rows without a page are two rows.
    """
    counted = F.lit(True) if good is None else good
    text = F.to_json(F.col(sch.PAYLOAD), {"ignoreNullFields": "false"})
    rows = rows.select("page", counted.alias("_good"), text.alias("_text"))
    parts = [F.when(F.col("_good"), F.xxhash64(F.lit(salt), "_text").cast("decimal(20,0)")) for salt in ("a", "b")]
    sums = F.concat_ws(":", *[F.sum(x).cast("string") for x in parts])
    n = F.count(F.when(F.col("_good"), 1))
    if good is None:
        return rows.groupBy("page").agg(n.alias(count), sums.alias(digest))
    found = rows.groupBy("page", F.when(F.col("page").isNull(), F.col("_good")).alias("_part"))
    return found.agg(n.alias(count), F.count(F.when(~F.col("_good"), 1)).alias("rejected"), F.when(n > 0, sums).alias(digest)).drop("_part")


def content_reconciliation(spark: SparkSession, cfg: ExchangeConfig, bodies: DataFrame, table_path: str, load_id: str,
                           by_field: bool = False) -> DataFrame:
    """M4 by content: ``page, landed, rejected, loaded, status`` for every page of a load.

    The landed bodies' records, typed with the stored schema, against the table's
    rows: by number and by a multiset digest. ``status`` is ``ok``, ``missing``
    or ``unplanned`` (a page on one side only), ``short``, ``extra`` or, with the
    right number of rows, ``altered``. ``by_field``: the load kept records with rejected fields.
    """
    schema = sink.load_schema(spark, table_path) or StructType([])
    records = extract.extract_records(bodies, cfg.data_field, cfg.response_format, cfg.soap, prefixes=bool(cfg.namespace))
    typed = env.blank_payload((sch.conform_fields if by_field else sch.conform)(records, schema))
    landed = _payload_digest(typed, "landed", "_want", F.col(sch.CORRUPT).isNull())
    table = sink.read_table(spark, table_path).filter((F.col("source_id") == cfg.source_id) & (F.col("load_id") == load_id))
    both = landed.join(_payload_digest(table, "loaded", "_got"), "page", "full_outer")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("landed", "rejected", "loaded")]
    status = (
        F.when(F.col("landed") == F.col("loaded"), F.when(F.col("_want").eqNullSafe(F.col("_got")), "ok").otherwise("altered"))
        .when(F.col("loaded") == 0, "missing").when(F.col("landed") + F.col("rejected") == 0, "unplanned")
        .when(F.col("loaded") < F.col("landed"), "short").otherwise("extra")
    )
    return both.select("page", *counts, "_want", "_got").select("page", "landed", "rejected", "loaded", status.alias("status"))


def _check_counts(spark, cfg: ExchangeConfig, landing_path: str, table_path: str, quarantine_path: str, load_id: str) -> None:
    """Raise unless every page has as many rows, table and quarantine together, as records have landed."""
    here = F.col("load_id") == load_id
    parts = []
    if sink.path_exists(spark, f"{table_path.rstrip('/')}/source_id={cfg.source_id}/load_id={load_id}"):
        parts.append(sink.read_table(spark, table_path).filter((F.col("source_id") == cfg.source_id) & here).select("page"))
    if sink.path_exists(spark, f"{quarantine_path.rstrip('/')}/load_id={load_id}"):
        parts.append(spark.read.parquet(quarantine_path).filter(here).select("page"))
    found = spark.createDataFrame([], "page bigint") if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    planned = pages.landed_pages(spark, landing_path, cfg.source_id, load_id).filter("n_records > 0").withColumnRenamed("n_records", "planned")
    wrong = audit.reconcile(planned, found.groupBy("page").agg(F.count(F.lit(1)).alias("landed"))).filter(F.col("status") != "ok")
    first = wrong.agg(F.count(F.lit(1)).alias("n"), F.min_by("status", "page").alias("status"), F.min("page").alias("page")).first()
    if first["n"]:
        raise IncompleteLoad(f"{first['n']} pages differ between landing zone and table, the first is page {first['page']} ({first['status']})")


def _with_start_date(fetch: Callable[[dict], str | None], start: str) -> Callable[[dict], str | None]:
    def dated(request: dict) -> str | None:
        return fetch({**request, "start_date": start})

    return dated


def landed_reconciliation(spark: SparkSession, cfg: ExchangeConfig, plan: DataFrame, table_path: str, load_id: str) -> DataFrame:
    """M4 for one load: records planned per page vs rows in the table."""
    planned = plan.select("page", F.col("limit" if "limit" in plan.columns else "pageSize").alias("planned"))
    got = (
        sink.read_table(spark, table_path)
        .filter((F.col("source_id") == cfg.source_id) & (F.col("load_id") == load_id))
        .groupBy("page").agg(F.count(F.lit(1)).alias("landed"))
    )
    return audit.reconcile(planned, got)


# ------------------------------------------------------------------ outbound

def outbound_batches(
    df: DataFrame,
    cfg: ExchangeConfig,
    order_by: Sequence[str | Column],
    unique: bool = False,
    n_blocks: int | None = None,
    one_shuffle: bool = False,
    staged: str | None = None,
) -> tuple[int, DataFrame]:
    """(row count, ``(batch_num, n, body)`` for every batch of the query result).

    ``one_shuffle`` makes the same batches by ``chunking.ordered_batches``: whole rows
    are staged in ``staged`` and shuffled once, for more CPU; ``order_by`` names columns then.
    """
    payload = list(df.columns)
    if cfg.api_dataformat == "dict":
        indexed, count = chunking.global_index_with_count(df, order_by, unique=unique, n_blocks=n_blocks)
        return count, indexed.select(
            F.col("rn").alias("batch_num"), F.lit(1).cast("bigint").alias("n"),
            encode.dict_body(F.struct(*[F.col(f"`{c}`") for c in payload])).alias("body"),
        )
    size = cfg.api_limit
    if size is None:
        raise ValueError(f"api-dataformat {cfg.api_dataformat!r} needs api-limit")
    if one_shuffle:
        batches, count = chunking.ordered_batches(df, order_by, size, unique, n_blocks, staged=staged)
    else:
        indexed, count = chunking.global_index_with_count(df, order_by, unique=unique, n_blocks=n_blocks)
        batches = chunking.collect_batches(indexed, size, payload)
    return count, batches.select("batch_num", "n", encode.encode_batch(F.col("items"), cfg.api_dataformat, cfg.xml_root, cfg.xml_item).alias("body"))


def run_outbound(
    spark: SparkSession,
    cfg: ExchangeConfig,
    send: Callable[[int, str], object],
    *,
    audit_path: str,
    delivery_path: str,
    order_by: Sequence[str | Column],
    unique: bool = False,
    n_blocks: int | None = None,
    parallelism: int | None = None,
    concurrency: int = 1,
    lease_seconds: int = 6 * 3600,
    one_shuffle: bool = False,
) -> LoadResult:
    """Query -> batches -> ``send``; resumes by skipping delivered batches. Of two runs of a pair at once the second is refused."""
    if cfg.dataflow != "Outbound":
        raise ValueError("run_outbound needs an Outbound configuration")
    if not cfg.source_query:
        raise ValueError("an outbound flow needs source-query")
    with audit.claim(spark, audit_path, cfg.source_id, cfg.destination_id, lease_seconds):
        return _run_outbound(spark, cfg, send, audit_path, delivery_path, order_by, unique, n_blocks, parallelism, concurrency, one_shuffle)


def _run_outbound(spark, cfg, send, audit_path, delivery_path, order_by, unique, n_blocks, parallelism, concurrency, one_shuffle) -> LoadResult:
    run = audit.open_run(spark, audit_path, cfg.source_id, cfg.destination_id)
    res = LoadResult(audit_id=run.audit_id, load_id=run.audit_id)
    log_path = f"{delivery_path.rstrip('/')}/audit_id={run.audit_id}"
    # the run's batches as first numbered: a rerun sends from these, whatever has happened to the source
    snapshot = f"{delivery_path.rstrip('/')}_snapshot/{run.audit_id}"
    staged = f"{delivery_path.rstrip('/')}_staged/{run.audit_id}"
    try:
        if not sink.path_exists(spark, f"{snapshot}/_SUCCESS"):
            start = cfg.adhoc_start_date or run.last_checkpoint
            args = None
            if ":start_date" in cfg.source_query:
                if start is None:
                    raise ValueError("the first run of a query with :start_date needs adhoc_start_date")
                args = {"start_date": start}
            df = tables.sql_source(spark, cfg.source_query, args)
            _, batches = outbound_batches(df, cfg, order_by, unique, n_blocks, one_shuffle, staged)
            # a folder for each wave, so that a wave opens its own files only; a resumed run keeps the waves of the first
            wave = F.floor((F.col("batch_num") - 1) / (BATCHES_PER_CORE * spark.sparkContext.defaultParallelism)).cast("int")
            batches.withColumn("wave", wave).write.mode("overwrite").partitionBy("wave").parquet(snapshot)
            remove_path(spark, staged)
        batches = spark.read.schema(SNAPSHOT).parquet(snapshot)
        planned = batches.agg(F.count(F.lit(1)).alias("b"), F.sum("n").alias("rows"), F.max("wave").alias("last")).first()
        res.source_count, res.total_obj_count = int(planned["rows"] or 0), int(planned["b"])
        for wave in range(planned["last"] + 1 if planned["b"] else 0):
            done = None
            if sink.path_exists(spark, f"{log_path}/wave={wave}"):
                done = spark.read.schema(DELIVERY_LOG).option("basePath", delivery_path).parquet(f"{log_path}/wave={wave}")
            todo = delivery.pending_batches(batches.filter(F.col("wave") == wave).drop("wave"), done)
            (
                delivery.deliver(todo, send, parallelism=parallelism, concurrency=concurrency)
                .withColumn("audit_id", F.lit(run.audit_id))
                .withColumn("wave", F.lit(wave))
                .withColumn("delivered_at", F.current_timestamp())
                .write.mode("append").partitionBy("audit_id", "wave").parquet(delivery_path)
            )
        if res.total_obj_count:
            sent = spark.read.schema(DELIVERY_LOG).option("basePath", delivery_path).parquet(log_path).filter(F.col("ok"))
            per_batch = sent.groupBy("batch_num").agg(F.max("n").alias("n"))  # a re-sent batch counts once
            agg = per_batch.agg(F.count(F.lit(1)).alias("b"), F.sum("n").alias("rows")).first()
            res.loaded_obj_count = int(agg["b"] or 0)
            res.target_count = int(agg["rows"] or 0)
        if res.loaded_obj_count < res.total_obj_count:
            raise RuntimeError(f"{res.total_obj_count - res.loaded_obj_count} batches not delivered")
        audit.close_run(spark, audit_path, run, audit.SUCCESS, res.source_count, res.total_obj_count,
                        res.loaded_obj_count, res.target_count)
        remove_path(spark, snapshot)
        return res
    except Exception:
        log.exception("outbound run %s failed", run.audit_id)
        audit.close_run(spark, audit_path, run, audit.FAILED, res.source_count, res.total_obj_count,
                        res.loaded_obj_count, res.target_count)
        raise


# ------------------------------------------------------------------ view -> table

def view_to_table(spark: SparkSession, source: str, view_name: str, predicate: str, target: str | None = None) -> DataFrame:
    """A view over a scan (K5), a filter on it (F1), materialised (K4) if a target is given."""
    sink.define_view(tables.scan(spark, source), view_name)
    out = spark.table(view_name).filter(F.expr(predicate))
    if target:
        sink.materialize(out, target)
    return out


# ------------------------------------------------------------------ dispatch

def execute(
    spark: SparkSession,
    cfg: ExchangeConfig,
    *,
    fetch: Callable[[dict], str | None] | None = None,
    send: Callable[[int, str], object] | None = None,
    **kwargs,
) -> LoadResult:
    """Run the flow the configuration names (``dataflow``): Inbound or Outbound."""
    if cfg.dataflow == "Inbound":
        if fetch is None:
            raise ValueError("an Inbound flow needs a fetch callable")
        return run_inbound(spark, cfg, fetch, **kwargs)
    if cfg.dataflow == "Outbound":
        if send is None:
            raise ValueError("an Outbound flow needs a send callable")
        return run_outbound(spark, cfg, send, **kwargs)
    raise ValueError(f"unknown dataflow {cfg.dataflow!r}")
