"""The warehouse as a graph of DataFrame functions.

``Warehouse`` wires landing -> staging -> dims/facts -> marts lazily: each
property builds (once) a DataFrame from the ones it depends on, so Catalyst
sees the whole chain and prunes columns and pushes filters all the way to
the parquet scans.  Nothing is collected.  ``run_ts`` / ``as_of`` are
injected, never read from the clock, so reruns are reproducible.

Landing data comes either from the fixture rules over the driver's tables
(``Warehouse.from_fixtures``) or from a landing root written by the ingest
jobs (``Warehouse.from_landing``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dims, facts, marts, staging
from ..sources import fixtures
from ..sources.tables import TableSource

DEFAULT_RUN_TS = "2024-06-30 00:00:00"
DEFAULT_AS_OF = "2024-06-30"


class Warehouse:
    def __init__(self, spark: SparkSession, landing: dict, run_ts: str = DEFAULT_RUN_TS,
                 as_of: str = DEFAULT_AS_OF, plain_numbering: bool = False):
        self.spark = spark
        self.landing = landing  # shape -> callable returning a landing DataFrame
        self.run_ts_text = run_ts
        self.as_of = as_of
        self.plain_numbering = plain_numbering

    # ------------------------------------------------------------ builders
    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str, variant: int = 0,
                      materialise: bool = True, **kw) -> "Warehouse":
        """Landing feeds derived from the driver's tables.  With
        ``materialise`` (default) the join behind the line feeds is written once
        per session to the shared folder; the feeds are projections of it."""
        t = TableSource(spark, sf_dir)
        if materialise:
            landing = {s: (lambda s=s: fixtures.stored_landing(t, s, variant))
                       for s in fixtures.SHAPE_BUILDERS}
        else:
            landing = {s: (lambda s=s: fixtures.SHAPE_BUILDERS[s](t, variant)) for s in fixtures.SHAPE_BUILDERS}
        wh = cls(spark, landing, **kw)
        wh.tables = t
        return wh

    @classmethod
    def from_landing(cls, spark: SparkSession, landing_root: str, **kw) -> "Warehouse":
        """Landing layout ``<root>/<shape>/load_id=<id>/company=<tenant>/dataset=<name>/``
        (parquet, all-string columns + ``_loaded_at``), as written by the
        batch and streaming ingest jobs."""
        from ..sources.landing import read_landing
        landing = {shape: (lambda s=shape: read_landing(spark, landing_root, s))
                   for shape in ["commissions", "valuations", "investment_transactions",
                                 "risk_transactions", "risk_policies"]}
        return cls(spark, landing, **kw)

    @property
    def run_ts(self):
        return F.lit(self.run_ts_text).cast("timestamp_ntz")

    # ------------------------------------------------------------ staging
    @cached_property
    def stg_commissions(self) -> DataFrame:
        return staging.stage_commissions(self.landing["commissions"]())

    @cached_property
    def stg_valuations(self) -> DataFrame:
        return staging.stage_valuations(self.landing["valuations"]())

    @cached_property
    def stg_investment_transactions(self) -> DataFrame:
        return staging.stage_investment_transactions(self.landing["investment_transactions"]())

    @cached_property
    def stg_risk_transactions(self) -> DataFrame:
        return staging.stage_risk_transactions(self.landing["risk_transactions"]())

    @cached_property
    def stg_risk_policies(self) -> DataFrame:
        return staging.stage_risk_policies(self.landing["risk_policies"]())

    # ------------------------------------------------------------ dims
    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.spark)

    @cached_property
    def dim_advisor(self) -> DataFrame:
        return dims.dim_advisor(self.stg_commissions, self.stg_valuations, self.stg_risk_policies,
                                self.run_ts)

    @cached_property
    def dim_client(self) -> DataFrame:
        return dims.dim_client(self.stg_valuations, self.stg_investment_transactions, self.as_of,
                               self.run_ts)

    @cached_property
    def dim_fund(self) -> DataFrame:
        return dims.dim_fund(self.stg_valuations, self.run_ts)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dims.dim_product(self.stg_valuations, self.stg_risk_policies, self.run_ts)

    @cached_property
    def dim_policy(self) -> DataFrame:
        return dims.dim_policy(self.stg_risk_policies, self.stg_valuations,
                               self.stg_investment_transactions, self.run_ts)

    # ------------------------------------------------------------ facts
    @cached_property
    def fct_commissions(self) -> DataFrame:
        return facts.fct_commissions(self.stg_commissions)

    @cached_property
    def fct_valuations(self) -> DataFrame:
        return facts.fct_valuations(self.stg_valuations, self.plain_numbering, self.some_valuations)

    # Samples are drawn from the landing rows, before they are typed.
    def some_valuations(self, part: float) -> DataFrame:
        return staging.stage_valuations(self.landing["valuations"]().sample(part))

    def some_transactions(self, part: float) -> tuple[DataFrame, DataFrame]:
        return (staging.stage_risk_transactions(self.landing["risk_transactions"]().sample(part)),
                staging.stage_investment_transactions(self.landing["investment_transactions"]().sample(part)))

    @cached_property
    def valuations_keyed(self) -> DataFrame:
        return facts.valuations_keyed(self.stg_valuations)

    @cached_property
    def transactions_numbered(self) -> DataFrame:
        """Both transaction universes with K5's row number in the grain, and
        ``_alone`` for rows known to be the only ones of theirs."""
        return facts.transactions_numbered(self.stg_risk_transactions, self.stg_investment_transactions,
                                           self.plain_numbering, self.some_transactions, "_alone")

    @cached_property
    def transactions_keyed(self) -> DataFrame:
        return facts.transactions_keyed(self.stg_risk_transactions, self.stg_investment_transactions,
                                        self.dim_fund)

    @cached_property
    def fct_transactions(self) -> DataFrame:
        return facts.fct_transactions(self.stg_risk_transactions, self.stg_investment_transactions,
                                      self.dim_fund, self.plain_numbering, self.some_transactions)

    @cached_property
    def fct_policies(self) -> DataFrame:
        # The valuation and transaction facts are 1:1 projections of their
        # staging rows and the roll-ups read none of the keys the facts add,
        # so the roll-ups read the staging frames and skip the numbering.
        return facts.fct_policies(
            self.dim_policy, self.fct_commissions, self.stg_valuations,
            facts.transactions_union(self.stg_risk_transactions, self.stg_investment_transactions),
            self.as_of, self.run_ts)

    # ------------------------------------------------------------ marts
    @cached_property
    def finance_advisor_commissions_monthly(self) -> DataFrame:
        return marts.finance_advisor_commissions_monthly(self.fct_commissions, self.dim_date, self.run_ts)

    @cached_property
    def portfolio_aum_monthly(self) -> DataFrame:
        return marts.portfolio_aum_monthly(self.valuations_keyed, self.dim_date, self.dim_fund, self.run_ts)

    @cached_property
    def risk_policy_inforce(self) -> DataFrame:
        return marts.risk_policy_inforce(self.dim_policy, self.run_ts)
