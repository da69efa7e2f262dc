"""The refresh job (N12): source → (staging ∥ audit) → marts → cohort.

Every stage is written as a full-replace Parquet table and the next stage
reads that table back, so lineage is cut at each layer and a lost executor
only recomputes work since the last written table. The audit reads the
source tables, not staging, and runs concurrently with staging (separate
Spark jobs submitted from a small driver thread pool); an audit failure is
reported but does not stop the marts, a staging failure does.

A run writes into a folder of its own and is published as a whole when it has
ended: readers see all tables of one run, during a run and after a failed one.
"""

from __future__ import annotations

import hashlib
import json
import logging
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.plans.audit import data_quality_issues
from tallyhouse.plans.cohort import cohort_retention
from tallyhouse.plans.marts import category_performance, monthly_revenue_by_country, user_segments
from tallyhouse.plans.reference import issue_catalog, ref_allowed_age_group, ref_allowed_status
from tallyhouse.plans.staging import stg_orders, stg_products, stg_users
from tallyhouse.sources.published import KEEP, Files, Log
from tallyhouse.sources.sinks import write_files
from tallyhouse.sources.tables import raw_sources

log = logging.getLogger(__name__)

STAGING = ("stg_orders", "stg_products", "stg_users")
REFERENCE = ("ref_allowed_status", "ref_allowed_age_group", "issue_catalog")
MARTS = ("monthly_revenue_by_country", "category_performance", "user_segments")

#: The declared key of each table; a run that doubles one stops.
KEYS: dict[str, Sequence[str]] = {
    "stg_orders": ["order_id"], "stg_products": ["product_id"], "stg_users": ["user_id"],
    "ref_allowed_status": ["status"], "ref_allowed_age_group": ["age_group"], "issue_catalog": ["table_name", "issue_type"],
    "data_quality_issues": ["table_name", "issue_type"],
    "monthly_revenue_by_country": ["country", "month"], "category_performance": ["category"], "user_segments": ["user_id"],
    "cohort_retention": ["cohort_month"],
}
#: Tables whose key must not be NULL (staging keeps one row for all NULL keys).
NOT_NULL = ("ref_allowed_status", "ref_allowed_age_group", "issue_catalog", "data_quality_issues", "cohort_retention")

RUNS = "runs"
#: Hours after which the folder of a run that never ended may go.
ABANDONED_HOURS = 48.0


@dataclass
class RefreshResult:
    out: str
    written: dict[str, str] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    run: str = ""
    loaded_at: datetime | None = None
    #: False where readers still see an earlier run.
    published: bool = False

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.written[name])

    def register_views(self, spark: SparkSession) -> list[str]:
        """Expose every written table as a temp view of the same name, so the
        published tables can be queried with ``spark.sql`` as before."""
        for name in self.written:
            self.table(spark, name).createOrReplaceTempView(name)
        return sorted(self.written)


class Run:
    """One run in ``<out>/runs``: what it reads (a digest of the input files), its
    stamp, and a marker file for each table it has finished."""

    def __init__(self, files: Files, out: str, name: str, inputs: str, loaded_at: datetime):
        self.files, self.name, self.inputs, self.loaded_at = files, name, inputs, loaded_at
        self.folder = f"{out}/{RUNS}/{name}"
        self.kept: set[str] = set()

    @classmethod
    def begin(cls, spark: SparkSession, out: str, raw: dict[str, DataFrame], resume: bool) -> Run:
        """The newest run over the same inputs where ``resume`` finds one, else a new one."""
        files, inputs = Files(spark, out), _digest(spark, raw)
        if resume and inputs:
            found = [r for name in files.names(f"{out}/{RUNS}") if (r := cls._read(files, out, name)) and r.inputs == inputs]
            if found:
                run = max(found, key=lambda r: (r.loaded_at, r.name))
                run.kept = set(files.names(f"{run.folder}/_finished"))
                return run
        now = datetime.now(timezone.utc)
        run = cls(files, out, f"{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}", inputs, now)
        files.create(f"{run.folder}/_run.json", json.dumps({"inputs": inputs, "loaded_at": now.isoformat()}))
        return run

    @classmethod
    def _read(cls, files: Files, out: str, name: str) -> Run | None:
        try:
            record = json.loads(files.read(f"{out}/{RUNS}/{name}/_run.json"))
            return cls(files, out, name, record["inputs"], datetime.fromisoformat(record["loaded_at"]))
        except Exception:  # a folder without a whole record is no run
            return None

    def finished(self, table: str) -> None:
        self.files.create(f"{self.folder}/_finished/{table}")


def _digest(spark: SparkSession, raw: dict[str, DataFrame]) -> str:
    """Names, sizes and times of the files behind the sources; empty where there are none."""
    lines = []
    for name in sorted(raw):
        for file in sorted(raw[name].inputFiles()):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI.create(file))
            status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
            lines.append(f"{name} {file} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(lines).encode()).hexdigest() if lines else ""


def published_run(spark: SparkSession, out: str) -> RefreshResult:
    """The run that readers of ``out`` see: all its tables, or an error if none was published."""
    out = out.rstrip("/")
    entry = Log(spark, out).current()
    if entry is None:
        raise FileNotFoundError(f"no run has been published in {out}")
    return RefreshResult(out, {n: f"{out}/{p}" for n, p in entry["tables"].items()}, entry["errors"], entry["run"],
                         datetime.fromisoformat(entry["loaded_at"]), True)


def _publish(spark: SparkSession, result: RefreshResult, keep: int, abandoned_hours: float) -> None:
    """Switch readers of ``result.out`` to its run, and remove the folders of runs that
    ``keep`` newer ones have followed or that never ended."""
    entries = Log(spark, result.out)
    if (entries.current() or {}).get("run") != result.run:
        entries.publish({"run": result.run, "loaded_at": result.loaded_at.isoformat(), "errors": result.errors,
                         "tables": {n: p[len(result.out) + 1:] for n, p in result.written.items()}})
    result.published = True
    dropped = {e["run"] for e in entries.forget(keep)}
    held = {e["run"] for e in entries.entries()}
    oldest = datetime.now(timezone.utc).timestamp() - 3600 * abandoned_hours
    for name in entries.files.names(f"{result.out}/{RUNS}"):
        folder = f"{result.out}/{RUNS}/{name}"
        if name not in held and (name in dropped or entries.files.modified(folder) < oldest):
            entries.files.delete(folder)


def refresh(spark: SparkSession, source: str | dict[str, DataFrame], out: str,
            run_audit: bool = True, resume: bool = False, source_format: str = "parquet", keep: int = KEEP,
            accept_audit_failure: bool = False, abandoned_hours: float = ABANDONED_HOURS) -> RefreshResult:
    """Run the whole chain; returns where each table was written.

    ``source`` is a folder (raw_* tables, or the driver's tables they are
    derived from) or a dict of the three raw DataFrames. ``out`` must be a
    shared folder on a cluster (e.g. under ``spark.checkpoint.dir``).

    Tables go to ``<out>/runs/<run>``; once all are whole, one entry in
    ``<out>/_published`` makes them the ones that :func:`published_run` and
    ``read_table(spark, out, name)`` find. Until then, and after a run that
    failed, these give the tables of the run before. A run whose audit failed is
    complete but for the audit and is not published, unless
    ``accept_audit_failure``; then its readers find no audit tables. The last ``keep`` published runs stay on disk.

    Every table's declared key is checked after it is written (:data:`KEYS`); a doubled
    one stops the run with the table's name. All tables carry the run's one stamp.

    With ``resume=True`` the newest run over the same inputs (a digest of their
    files) continues under its stamp and keeps the tables it has finished; over other
    inputs a new run starts. Tables of two runs are never taken for one.
    """
    raw = raw_sources(spark, source, fmt=source_format) if isinstance(source, str) else source
    out = out.rstrip("/")
    run = Run.begin(spark, out, raw, resume)
    result = RefreshResult(out, run=run.name, loaded_at=run.loaded_at)
    stamp = {"loaded_at": run.loaded_at}

    def write(name: str, layer: str, df: DataFrame) -> None:
        path = f"{run.folder}/{layer}/{name}"
        if name in run.kept:
            log.info("resume: keeping committed %s", path)
        else:
            write_files(df, path, key=KEYS[name], nulls=name not in NOT_NULL)
            run.finished(name)
        result.written[name] = path

    def run_audit_phase() -> None:
        refs = {"ref_allowed_status": ref_allowed_status(spark),
                "ref_allowed_age_group": ref_allowed_age_group(spark),
                "issue_catalog": issue_catalog(spark)}
        for name, df in refs.items():
            write(name, "audit", df.coalesce(1))
        back = {name: spark.read.parquet(result.written[name]) for name in refs}
        issues = data_quality_issues(spark, raw["raw_orders"], raw["raw_products"], raw["raw_users"],
                                     ref_status=back["ref_allowed_status"],
                                     ref_age_group=back["ref_allowed_age_group"],
                                     catalog=back["issue_catalog"], ordered=True)
        write("data_quality_issues", "audit", issues)

    # Independent writes are separate Spark jobs submitted from a few driver
    # threads, so small jobs overlap instead of queueing one after another.
    with ThreadPoolExecutor(max_workers=4) as pool:
        # phase 1: staging (three tables) and the audit side by side
        staging_jobs = [
            pool.submit(write, "stg_orders", "staging", stg_orders(raw["raw_orders"], **stamp)),
            pool.submit(write, "stg_products", "staging", stg_products(raw["raw_products"], **stamp)),
            pool.submit(write, "stg_users", "staging", stg_users(raw["raw_users"], **stamp)),
        ]
        audit_job = pool.submit(run_audit_phase) if run_audit else None
        if audit_job is not None:
            try:
                audit_job.result()
            except Exception as exc:  # reported, not swallowed: marts still run
                log.error("audit phase failed: %s", exc)
                result.errors["audit"] = repr(exc)
        for job in staging_jobs:
            job.result()  # a staging failure stops the job

        # phase 2: marts from the written staging tables
        orders = result.table(spark, "stg_orders")
        products = result.table(spark, "stg_products")
        users = result.table(spark, "stg_users")
        mart_jobs = [
            pool.submit(lambda: write("monthly_revenue_by_country", "analytics",
                                      monthly_revenue_by_country(orders, users, ordered=True))),
            pool.submit(lambda: write("category_performance", "analytics",
                                      category_performance(orders, products, ordered=True))),
            pool.submit(lambda: write("user_segments", "analytics", user_segments(users, orders, ordered=True))),
        ]
        for job in mart_jobs:
            job.result()  # the cohort is published only if every mart was

        # phase 3: cohort from the written user_segments and staged orders
        cohort = cohort_retention(result.table(spark, "user_segments"), orders, ordered=True)
        write("cohort_retention", "analytics", cohort)
    if not result.errors or accept_audit_failure:
        _publish(spark, result, keep, abandoned_hours)
    return result


def main(argv: list[str] | None = None) -> None:  # pragma: no cover - CLI
    import argparse

    from tallyhouse.session import build_session, size_shuffle_partitions

    ap = argparse.ArgumentParser(description="run the staging → audit → marts → cohort refresh")
    ap.add_argument("source")
    ap.add_argument("out")
    ap.add_argument("--master", default=None)
    ap.add_argument("--resume", action="store_true", help="keep tables already committed in <out>")
    ap.add_argument("--accept-audit-failure", action="store_true", help="publish the marts of a run whose audit failed")
    ap.add_argument("--keep", type=int, default=KEEP, help="published runs that stay on disk")
    ap.add_argument("--format", default="parquet", choices=("parquet", "csv"),
                    help="format of landed raw_* source tables")
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    size_shuffle_partitions(spark, [args.source])
    res = refresh(spark, args.source, args.out, resume=args.resume, source_format=args.format,
                  keep=args.keep, accept_audit_failure=args.accept_audit_failure)
    for name, path in res.written.items():
        print(f"{name}\t{path}")
    for name, err in res.errors.items():
        print(f"ERROR {name}\t{err}")
    if res.errors:
        raise SystemExit(1)


if __name__ == "__main__":  # pragma: no cover
    main()
