"""Whole-warehouse build: every layer in dependency order, written to a
table store, followed by the data tests.

Store layout (parquet under one root, which on a cluster is shared storage):

* full-rebuild tables (dims, facts, marts): ``<root>/<table>/run=<run_id>/``;
  a reader takes the latest run.  A run never overwrites the files another
  reader may be scanning, and a retried run overwrites only its own folder.
* insert-only / append tables (hubs, links, satellites, quarantine):
  ``<root>/<table>/run=<run_id>/`` holding that run's delta; a reader takes
  every run.  Hubs and links lie in hash buckets with a sketch of their keys,
  satellites have their latest versions in buckets beside them
  (``plans.buckets``): a run reads only the buckets its keys fall into.
* the SCD-2 snapshot: ``<root>/snp_dim_policy/closed/run=<id>/`` (append-only
  closed versions) and the open versions in hash buckets, of which a run
  rewrites those that changed; a reader takes all closed runs plus the live
  buckets.

Every layer is read back from the store by the next one, so lineage is cut
at each layer and a lost executor re-reads files instead of recomputing the
chain.  A run's tables become visible together: its id is published last,
after its data tests, and readers only open the folders of published runs.  A
run that dies half-way, or fails a test of severity ``error``, stays unseen.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dims, facts, marts, scd
from ..operators import vault as V
from ..operators.quality import DataTest, run_tests
from .buckets import BucketState, KeySet, append_versions, bucket_of
from .declared_tests import CORE, MARTS, VAULT, declared
from .tables import stage, write
from .warehouse import Warehouse


def run_id_of(run_ts: str) -> str:
    return run_ts.replace("-", "").replace(":", "").replace(" ", "T")


@dataclass
class TableStore:
    spark: SparkSession
    root: str
    buckets: int = 16              # hash buckets of keyed tables; fixed for the life of a store

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def write_run(self, name: str, df: DataFrame, run_id: str) -> None:
        write(df, f"{self.path(name)}/run={run_id}")

    def publish(self, run_id: str) -> None:
        """Make a finished run visible to readers (once, also when retried)."""
        if run_id not in self.published():
            self.spark.createDataFrame([(run_id,)], "run string").coalesce(1).write.mode("append").parquet(
                self.path("_published"))

    def published(self, before: str | None = None) -> list[str]:
        """Ids of the published runs, oldest first (one small row a run)."""
        if not self._exists(self.path("_published")):
            return []
        ids = sorted({r["run"] for r in self.spark.read.parquet(self.path("_published")).collect()})
        # run ids are zero-padded timestamps: string order is time order
        return [r for r in ids if before is None or r < before]

    def _exists(self, path: str) -> bool:
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(target)

    def _folders(self, name: str, runs: list[str]) -> list[str]:
        return [f for f in (f"{self.path(name)}/run={r}" for r in runs) if self.has_files(f)]

    def has_files(self, path: str) -> bool:
        """Does a folder hold data?  (A partitioned write of no rows holds none.)"""
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return files.exists(target) and any(
            "=" in name or name[0] not in "_." for name in (f.getPath().getName() for f in files.listStatus(target)))

    @staticmethod
    def _plain(rows: DataFrame, keep_bucket: bool) -> DataFrame:
        return rows if keep_bucket or "_bucket" not in rows.columns else rows.drop("_bucket")

    def current(self, name: str, run_id: str, keep_bucket: bool = False) -> DataFrame:
        """A run's own rows, published or not."""
        return self._plain(self.spark.read.parquet(f"{self.path(name)}/run={run_id}"), keep_bucket)

    def latest(self, name: str, before: str | None = None) -> DataFrame | None:
        """The rows of the latest published run (of those before ``before``)."""
        folders = self._folders(name, self.published(before))
        return self.spark.read.parquet(folders[-1]) if folders else None

    def every_run(self, name: str, before: str | None = None, own: str | None = None,
                  keep_bucket: bool = False) -> DataFrame | None:
        """The rows of all published runs (of those before ``before``), with
        run ``own``: the state an incremental run compares against, so a
        retried run never sees its own partial output."""
        runs = [r for r in self.published(before) if r != own] + ([own] if own else [])
        folders = self._folders(name, runs)
        if not folders:
            return None
        rows = self.spark.read.option("basePath", self.path(name)).parquet(*folders).drop("run")
        return self._plain(rows, keep_bucket)


class BuildFailed(Exception):
    """An ``error`` data test failed: the run stays unpublished."""


BUILD_THREADS = 4


def run_wave(tasks: list, threads: int = BUILD_THREADS) -> None:
    """Submit independent writes as concurrent Spark jobs (the way a
    model runner uses several client threads); waits for all, re-raises the
    first failure."""
    if threads <= 1 or len(tasks) <= 1:
        for task in tasks:
            task()
        return
    with ThreadPoolExecutor(max_workers=threads) as pool:
        for f in [pool.submit(task) for task in tasks]:
            f.result()


FULL_REBUILD = ["dim_date", "dim_advisor", "dim_client", "dim_fund", "dim_product", "dim_policy",
                "fct_commissions", "fct_valuations", "fct_transactions", "fct_policies"]


def build_warehouse(wh: Warehouse, store: TableStore, run_ts: str, threads: int = BUILD_THREADS,
                    tests: list[DataTest] | None = None) -> DataFrame:
    """Build everything for one run, test it and publish it; returns the
    data-test results (a small DataFrame, also written to the store as
    ``test_results``), or raises ``BuildFailed`` and publishes nothing.  Layers run
    as waves of independent writes: dims; facts; then vault, snapshot,
    policy fact and marts (all of which read only stored dims and facts)."""
    tests = BUILD_TESTS if tests is None else tests
    rid = run_id_of(run_ts)
    ts = F.lit(run_ts).cast("timestamp_ntz")

    def write(name, make):
        return lambda: store.write_run(name, make(), rid)

    # ---- wave 1: dimensions (full rebuild)
    dims_built = {
        "dim_date": lambda: wh.dim_date, "dim_advisor": lambda: wh.dim_advisor,
        "dim_client": lambda: wh.dim_client, "dim_fund": lambda: wh.dim_fund,
        "dim_product": lambda: wh.dim_product, "dim_policy": lambda: wh.dim_policy,
    }
    run_wave([write(n, m) for n, m in dims_built.items()], threads)
    t = {n: store.current(n, rid) for n in dims_built}

    # ---- wave 2: facts (from staging + stored dims)
    run_wave([
        write("fct_commissions", lambda: facts.fct_commissions(wh.stg_commissions)),
        write("fct_valuations", lambda: facts.fct_valuations(wh.stg_valuations, draw=wh.some_valuations)),
        write("fct_transactions", lambda: facts.fct_transactions(
            wh.stg_risk_transactions, wh.stg_investment_transactions, t["dim_fund"], draw=wh.some_transactions)),
    ], threads)
    for n in ("fct_commissions", "fct_valuations", "fct_transactions"):
        t[n] = store.current(n, rid)
    txns = t["fct_transactions"]

    # ---- wave 3: vault (each delta against runs before this one), snapshot, policy fact, marts
    tasks = [write("fct_policies", lambda: facts.fct_policies(
        t["dim_policy"], t["fct_commissions"], t["fct_valuations"], txns, wh.as_of, ts))]
    for x in [*V.HUBS.values(), *V.LINKS.values()]:
        candidates = V.hub_candidates if isinstance(x, V.Hub) else V.link_candidates
        tasks.append(lambda x=x, candidates=candidates: KeySet(store, x.name, x.hk).append(candidates(txns, x, ts), rid))
    for name, cols in V.SATELLITES.items():
        tasks.append(lambda name=name, cols=cols: append_versions(
            store, name, "transaction_hk", V.satellite_source(txns, cols, ts), rid))
    tasks.append(lambda: take_snapshot(store, t["dim_policy"], ts, rid))

    tasks += [
        write("finance_advisor_commissions_monthly", lambda: marts.finance_advisor_commissions_monthly(
            t["fct_commissions"], t["dim_date"], ts)),
        write("portfolio_aum_monthly", lambda: marts.portfolio_aum_monthly(
            t["fct_valuations"], t["dim_date"], t["dim_fund"], ts)),
        write("risk_policy_inforce", lambda: marts.risk_policy_inforce(t["dim_policy"], ts)),
    ]
    run_wave(tasks, threads)
    t["fct_policies"] = store.current("fct_policies", rid)
    for n in ("finance_advisor_commissions_monthly", "portfolio_aum_monthly", "risk_policy_inforce"):
        t[n] = store.current(n, rid)

    # ---- data tests over the stored tables
    tables = dict(t)
    for n in [*V.SATELLITES, *(h.name for h in V.HUBS.values()), *(x.name for x in V.LINKS.values())]:
        tables[n] = store.every_run(n, rid, own=rid)
    results = run_tests(tables, tests, materialise=False)
    store.write_run("test_results", results, rid)
    results = store.current("test_results", rid)
    failed = [r["test_name"] for r in results.where("status = 'FAIL'").select("test_name").collect()]
    if failed:
        raise BuildFailed(f"run {rid} is not published, failed: {', '.join(sorted(failed))}")
    store.publish(rid)
    return results


SNAPSHOT = "snp_dim_policy"


def take_snapshot(store: TableStore, state: DataFrame, run_ts, run_id: str) -> None:
    """One snapshot run: closed versions are appended, open versions are
    rewritten in the buckets where a version was closed or opened."""
    open_table = BucketState(store, f"{SNAPSHOT}/open", scd.UNIQUE_KEY)
    bucket = bucket_of(scd.UNIQUE_KEY, store.buckets)
    before = open_table.read(run_id)
    if before is None:
        open_table.write(run_id, scd.first_snapshot(state, run_ts).withColumn("_bucket", bucket))
        return
    rows = stage(scd.after_run(before.drop("_bucket"), state, run_ts).withColumn("_bucket", bucket), "snapshot-join")
    store.write_run(f"{SNAPSHOT}/closed", rows.where("_closed").drop("_closed", "_bucket"), run_id)
    changed = rows.where(F.col("_closed") | (F.col("dbt_valid_from") == run_ts)).select("_bucket").distinct()
    open_table.write(run_id, rows.where("not _closed").drop("_closed").join(
        F.broadcast(changed), "_bucket", "left_semi"))      # a row a bucket


def read_snapshot(store: TableStore) -> DataFrame | None:
    open_v = BucketState(store, f"{SNAPSHOT}/open", scd.UNIQUE_KEY).read()
    closed = store.every_run(f"{SNAPSHOT}/closed")
    if open_v is None:
        return None
    open_v = open_v.drop("_bucket")
    return open_v if closed is None else open_v.unionByName(closed)


#: Every declared test of the built layers.
BUILD_TESTS = declared(CORE) + declared(VAULT) + declared(MARTS)
