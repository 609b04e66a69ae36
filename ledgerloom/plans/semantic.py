"""A small semantic metric layer over the marts.

A logical table is a base DataFrame plus named dimensions, time dimensions
and measures; a measure either has a default aggregation (sum / avg / ...)
or is pre-computed per row and may not be re-aggregated.  Names and
synonyms resolve case-insensitively.  A metric query compiles to one
``groupBy().agg()``; filters are column predicates.

Measures that may not be summed have a rule of their own: ``Ratio`` divides
two summed measures after they are summed, ``Latest`` is summed over rows of
one time and taken at a group's last time (a balance adds up over funds, not
over months).  A query with a ``Latest`` groups twice: first by the dimensions
and the time, to partial sums, then by the dimensions, where sums are summed
and balances are picked by ``max_by``; both steps combine map-side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.safe import safe_ratio


@dataclass(frozen=True)
class Field:
    name: str
    synonyms: tuple[str, ...] = ()
    default_aggregation: str | None = None  # measures only


@dataclass
class LogicalTable:
    name: str
    synonyms: tuple[str, ...]
    dimensions: list[Field]
    time_dimensions: list[Field]
    measures: list[Field]

    def _find(self, fields: list[Field], term: str) -> Field | None:
        t = term.strip().lower()
        for f in fields:
            if f.name.lower() == t or t in (s.lower() for s in f.synonyms):
                return f
        return None

    def dimension(self, term: str) -> Field:
        f = self._find(self.dimensions + self.time_dimensions, term)
        if f is None:
            raise KeyError(f"{self.name}: unknown dimension {term!r}")
        return f

    def measure(self, term: str) -> Field:
        f = self._find(self.measures, term)
        if f is None:
            raise KeyError(f"{self.name}: unknown measure {term!r}")
        return f


# --- fixed values: the semantic model (tables, fields, synonyms, default
# aggregations) --------------------------------------------------------------
MODEL = [
    LogicalTable(
        "advisor_commissions_monthly", ("commissions", "advisor performance", "broker earnings"),
        dimensions=[
            Field("company", ("tenant", "business", "firm")),
            Field("advisor_identifier", ("advisor", "broker", "agent", "advisor code")),
            Field("commission_category", ("category", "product line", "type")),
        ],
        time_dimensions=[Field("year_month", ("month", "period", "billing month"))],
        measures=[
            Field("commission_count", ("number of commissions", "commission volume", "deal count"), "sum"),
            Field("commission_gross_total", ("gross commissions", "total commissions before vat"), "sum"),
            Field("commission_net_total", ("net commissions", "net earnings", "payout", "take-home"), "sum"),
            Field("avg_commission_amount", ("average commission", "average deal size"), "avg"),
            Field("running_net_total", ("cumulative commissions", "lifetime net")),
            Field("pct_change_yoy", ("year-on-year change", "yoy growth", "yoy delta")),
        ]),
    LogicalTable(
        "aum_monthly", ("assets under management", "portfolio", "fund book"),
        dimensions=[
            Field("company", ("tenant", "business")),
            Field("fund_name", ("fund", "investment")),
            Field("fund_type", ("investment vehicle", "product structure")),
            Field("jse_code", ("ticker", "jse ticker", "exchange code")),
        ],
        time_dimensions=[Field("year_month", ("month", "period", "as-of month"))],
        measures=[
            Field("aum_amount", ("aum", "assets", "book value", "market value total"), "sum"),
            Field("unique_policies", ("policies invested", "investor count on this fund"), "sum"),
            Field("unique_clients", ("clients invested", "number of clients"), "sum"),
            Field("aum_mom_change", ("mom change", "month-on-month change", "net flow")),
            Field("aum_mom_pct_change", ("mom %", "monthly growth", "month-on-month growth rate")),
            Field("aum_12m_avg", ("12-month trailing average", "ttm average", "rolling aum")),
        ]),
    LogicalTable(
        "policy_inforce", ("policy book", "risk book", "in-force policies", "book of business"),
        dimensions=[
            Field("company", ("tenant",)),
            Field("policy_status", ("status", "policy state")),
            Field("smoker_status", ("smoker flag", "tobacco status")),
            Field("income_bracket", ("income band", "salary range")),
        ],
        time_dimensions=[],
        measures=[
            Field("policy_count", ("number of policies", "book size"), "sum"),
            Field("active_policy_count", ("in-force policies", "active book"), "sum"),
            Field("lapsed_policy_count", ("lapses", "lapsed book"), "sum"),
            Field("active_rate", ("retention rate", "active ratio")),
            Field("lapse_rate", ("lapse ratio", "attrition rate")),
            Field("total_monthly_premium_sum", ("monthly premium", "monthly income"), "sum"),
            Field("annualised_premium", ("annual premium", "ape", "annualised income", "yearly premium"), "sum"),
            Field("avg_age_next", ("average age", "mean age"), "avg"),
            Field("total_life_sum_assured", ("sum assured", "life cover in force", "coverage amount"), "sum"),
        ]),
]

@dataclass(frozen=True)
class Ratio:
    """The quotient of two summed measures."""

    numerator: str
    denominator: str


@dataclass(frozen=True)
class Latest:
    """A measure summed at the last ``time`` of a group."""

    measure: str
    time: str


#: Rules of measures that may not be summed over rows, by table and name.
RULES = {
    ("policy_inforce", "lapse_rate"): Ratio("lapsed_policy_count", "policy_count"),
    ("policy_inforce", "active_rate"): Ratio("active_policy_count", "policy_count"),
    ("aum_monthly", "closing_aum"): Latest("aum_amount", "year_month"),
    ("aum_monthly", "aum_per_policy"): Ratio("aum_amount", "unique_policies"),
    ("aum_monthly", "closing_policies"): Latest("unique_policies", "year_month"),
}
COUNTS = ("commission_count", "unique_policies", "unique_clients", "policy_count", "active_policy_count",
          "lapsed_policy_count")

AGGREGATIONS = {
    "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max,
    "count": F.count, "count_distinct": F.countDistinct,
}


class SemanticModel:
    def __init__(self, bases: dict[str, DataFrame], model: list[LogicalTable] = MODEL):
        self.bases = bases
        self.tables = model

    def table(self, term: str) -> LogicalTable:
        t = term.strip().lower()
        for lt in self.tables:
            if lt.name == t or t in lt.synonyms:
                return lt
        raise KeyError(f"unknown logical table {term!r}")

    def query(self, table: str, measures: list[str], dimensions: list[str] = (),
              filters: list[Column] = (), order_by: list[Column] | None = None,
              limit: int | None = None) -> DataFrame:
        lt = self.table(table)
        df = self.bases[lt.name]
        for f in filters:
            df = df.where(f)
        dims = [lt.dimension(d).name for d in dimensions]
        rules = {m: RULES.get((lt.name, self._rule_name(lt, m))) for m in measures}
        if any(isinstance(r, Latest) for r in rules.values()):
            out = self._by_time(lt, df, dims, rules)
        else:
            out = df.groupBy(*dims).agg(*[self._measure(lt, m, rules[m]) for m in measures])
        if order_by:
            out = out.orderBy(*order_by)
        if limit is not None:
            out = out.limit(limit)
        return out

    @staticmethod
    def _rule_name(lt: LogicalTable, term: str) -> str:
        if (lt.name, term) in RULES:
            return term
        return lt.measure(term).name

    @staticmethod
    def _typed(name: str, total: Column) -> Column:
        return total.cast("bigint" if name in COUNTS else "decimal(38,2)")

    def _measure(self, lt: LogicalTable, term: str, rule) -> Column:
        if isinstance(rule, Ratio):
            return F.round(safe_ratio(F.sum(rule.numerator), F.sum(rule.denominator)), 6).alias(self._rule_name(lt, term))
        field = lt.measure(term)
        if field.default_aggregation is None:
            raise ValueError(f"{field.name} is pre-computed per row and cannot be aggregated")
        agg = AGGREGATIONS[field.default_aggregation](F.col(field.name))
        agg = F.round(agg.cast("double"), 6) if field.default_aggregation == "avg" else self._typed(field.name, agg)
        return agg.alias(field.name)

    def _by_time(self, lt: LogicalTable, df: DataFrame, dims: list[str], rules: dict) -> DataFrame:
        """A query with a balance in it: partial sums by time, then picked
        or summed.  Only sums, ratios of sums and balances can be mixed."""
        times = {r.time for r in rules.values() if isinstance(r, Latest)}
        if len(times) > 1:
            raise ValueError(f"balances over different times: {sorted(times)}")
        time, parts, out = times.pop(), set(), []
        for term, rule in rules.items():
            name = self._rule_name(lt, term)
            if isinstance(rule, Latest):
                parts.add(rule.measure)
                out.append(self._typed(rule.measure, F.max_by(rule.measure, "_time")).alias(name))
            elif isinstance(rule, Ratio):
                parts |= {rule.numerator, rule.denominator}
                out.append(F.round(safe_ratio(F.sum(rule.numerator), F.sum(rule.denominator)), 6).alias(name))
            elif lt.measure(term).default_aggregation == "sum":
                parts.add(name)
                out.append(self._typed(name, F.sum(name)).alias(name))
            else:
                raise ValueError(f"{name} cannot be put beside a balance")
        by_time = df.groupBy(*dims, F.col(time).alias("_time")).agg(*[F.sum(m).alias(m) for m in sorted(parts)])
        return by_time.groupBy(*dims).agg(*out)
