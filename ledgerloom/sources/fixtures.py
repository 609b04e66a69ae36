"""Landing feeds derived from the driver's tables.

The reference ships no data, so each of the six feed shapes is derived
deterministically from a TPC-H-style table (see FIXTURES.md).  Output is in
*landing form*: every business column a string, plus ``company``,
``dataset`` (the partition columns of ``raw/<company>/<dataset>``) and a
``_loaded_at`` stamp.  The DuckDB twin of every rule lives in
``ledgerloom.oracle.fixtures_sql``; the two are kept rule-for-rule equal.

``variant=1`` is the second-run state used by incremental tests: risk
transactions with ``event_id % 100 = 0`` change status and risk policies
with ``c_custkey % 50 = 0`` change policy status, transactions and policies
under new keys appear, and some old ones are gone.
"""

from __future__ import annotations

from decimal import Decimal
from threading import Lock

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import TENANTS
from .tables import TableSource

LOAD_TS = "2024-03-01 00:00:00"
RISK_LOAD_TS = "2024-01-01 00:00:00"
RISK_RELOAD_TS = "2024-02-01 00:00:00"
YEAR_SHIFT_MONTHS = 240


def ts_ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def tenant(k: Column) -> Column:
    idx = F.pmod(k, F.lit(3))
    return (F.when(idx == 0, TENANTS[0]).when(idx == 1, TENANTS[1]).otherwise(TENANTS[2]))


def pad(x: Column, n: int) -> Column:
    """Left-pad with zeros to ``n`` characters; never truncates longer keys."""
    s = x.cast("string")
    return F.when(F.length(s) >= n, s).otherwise(F.lpad(s, n, "0"))


def shift20(ts: Column) -> Column:
    return F.add_months(F.to_date(ts), YEAR_SHIFT_MONTHS)


def money(x: Column) -> Column:
    return x.cast("decimal(18,2)")


def scaled(m: Column, factor: str) -> Column:
    return (m * F.lit(Decimal(factor)).cast("decimal(8,4)")).cast("decimal(18,2)")


def txt(c: Column) -> Column:
    return c.cast("string")


def null() -> Column:
    return F.lit(None).cast("string")


def client_id_number(custkey: Column) -> Column:
    return F.concat(
        F.when(custkey % 17 == 0, F.lit("X")).otherwise(F.lit("")),
        pad(custkey % 100, 2), pad(1 + custkey % 12, 2), pad(1 + custkey % 31, 2),
        pad(custkey, 7),
    )


def investment_policy(custkey: Column, orderkey: Column) -> Column:
    return F.concat(F.lit("INV"), pad(custkey * 2 + orderkey % 2, 8))


def commissions(tables: TableSource) -> DataFrame:
    o = tables("orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    tx_date = txt(shift20(F.col("o_orderdate")))
    total = money(F.col("o_totalprice"))
    gross, net = scaled(total, "0.0500"), scaled(total, "0.0425")
    status = F.col("o_orderstatus")
    return o.select(
        tenant(c).alias("company"),
        F.when(k % 2 == 0, "ins_commissions").otherwise("inv_commissions").alias("dataset"),
        F.concat(F.lit("COM"), pad(k, 9)).alias("commission_id"),
        F.when(k % 7 == 3, null())
         .when(k % 2 == 0, F.concat(F.lit("RB"), pad(c, 8)))
         .otherwise(F.concat(F.lit("INV"), pad(c * 2 + 1, 8))).alias("policy_number"),
        F.when(k % 11 == 0, null()).otherwise(F.concat(F.lit("ADV"), pad(c % 40, 4))).alias("advisor_identifier"),
        F.substring(F.col("o_orderpriority"), 3, 100).alias("business_line"),
        F.when(status == "F", "INITIAL").when(status == "O", "RECURRING")
         .otherwise("CLAWBACK").alias("commission_type"),
        tx_date.alias("transaction_date"),
        txt(gross).alias("gross_amount"),
        txt((gross - net).cast("decimal(18,2)")).alias("vat_amount"),
        txt(net).alias("net_amount"),
        F.when(k % 5 == 0, null()).otherwise(F.concat(F.lit("PC"), txt(c % 4))).alias("product_code"),
        F.lit("0.0500").alias("commission_rate"),
        F.when(status == "P", "LAPSE").alias("clawback_reason"),
        F.concat(F.lit("PAY"), pad(k, 9)).alias("payment_reference"),
        F.when(status == "O", null()).otherwise(tx_date).alias("payment_date"),
        F.lit("1.0000").alias("brokerage_split"),
        F.when(status == "F", "PAID").otherwise("PENDING").alias("status"),
        null().alias("client_title"), null().alias("client_first_name"),
        null().alias("client_surname"), null().alias("client_initials"),
        ts_ntz(LOAD_TS).alias("_loaded_at"),
    )


def _line_orders_parts(tables: TableSource) -> DataFrame:
    li = tables("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                   "l_quantity", "l_extendedprice", "l_returnflag",
                                   "l_linestatus", F.to_date("l_shipdate").alias("l_shipdate"))
    o = tables("orders").select("o_orderkey", "o_custkey")
    p = tables("part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
              .join(p, li.l_partkey == p.p_partkey, "inner").drop("o_orderkey", "p_partkey"))


def _client_columns(c: Column) -> list[Column]:
    return [
        F.when(c % 4 == 0, "Mr").when(c % 4 == 1, "Ms").when(c % 4 == 2, "Dr").alias("client_title"),
        F.when(c % 10 == 9, null()).otherwise(F.concat(F.lit("Client"), txt(c % 97))).alias("client_first_name"),
        F.concat(F.lit("Surname"), pad(c, 7)).alias("client_surname"),
        F.when(c % 10 == 9, null()).otherwise(F.lit("C")).alias("client_initials"),
    ]


def valuations(tables: TableSource, lines: DataFrame | None = None) -> DataFrame:
    j = _line_orders_parts(tables) if lines is None else lines
    c, ok, pk = F.col("o_custkey"), F.col("l_orderkey"), F.col("l_partkey")
    ptype, psize = F.col("p_type"), F.col("p_size")
    mv = money(F.col("l_extendedprice"))
    income = F.col("l_linenumber") % 4 == 0
    cl = _client_columns(c)
    return j.select(
        tenant(c).alias("company"),
        F.lit("valuations").alias("dataset"),
        F.when(F.col("l_suppkey") % 7 == 0, null())
         .otherwise(F.concat(F.lit("ADV"), pad(F.col("l_suppkey"), 4))).alias("advisor_identifier"),
        cl[0], cl[1], cl[2], cl[3],
        client_id_number(c).alias("client_id_number"),
        F.when(F.col("l_orderkey") % 13 == 0, null()).otherwise(investment_policy(c, ok)).alias("policy_number"),
        F.when(pk % 5 == 3, null()).otherwise(F.concat(F.lit("Product "), txt(psize % 4))).alias("product_name"),
        F.when(pk % 6 == 1, null()).otherwise(F.concat(F.lit("PC"), txt(psize % 4))).alias("product_code"),
        F.when(pk % 7 == 1, null()).otherwise(ptype).alias("fund_name"),
        F.when(pk % 9 == 0, null()).otherwise(F.concat(F.lit("FC"), txt(psize % 12))).alias("fund_code"),
        F.when((ptype < "M") & (pk % 5 != 0), F.concat(F.lit("J"), F.substring(ptype, 1, 3))).alias("jse_code"),
        F.when(pk % 13 == 0, null()).otherwise(txt(shift20(F.col("l_shipdate")))).alias("valuation_date"),
        F.lit("ZAR").alias("currency"),
        txt(mv).alias("market_value_amount"),
        txt(F.col("l_quantity").cast("decimal(18,4)")).alias("units"),
        txt(1 + ok % 12).alias("anniversary_month"),
        F.when(income, txt(scaled(mv, "0.0040"))).alias("monthly_income_amount"),
        F.when(income, F.lit("0.0040")).alias("monthly_income_pct"),
        F.when(income, F.lit("MONTHLY")).alias("income_frequency"),
        ts_ntz(LOAD_TS).alias("_loaded_at"),
    )


def _replaced(rows: DataFrame, **columns: Column) -> DataFrame:
    return rows.withColumns(columns)


def investment_transactions(tables: TableSource, variant: int = 0, lines: DataFrame | None = None) -> DataFrame:
    rows = _investment_transactions(_line_orders_parts(tables) if lines is None else lines)
    if not variant:
        return rows
    # second run: new transactions, clients, policies and funds; some are gone
    ref = F.col("reference_number")
    new = _replaced(rows.where(ref.like("%25")), transaction_id=F.concat(F.lit("N"), F.col("transaction_id")),
                    policy_number=F.concat(F.lit("INX"), F.substring("policy_number", 4, 100)),
                    client_id_number=F.concat(F.lit("9"), F.substring("client_id_number", 2, 100)),
                    fund_code=F.concat(F.lit("FN"), F.coalesce(F.substring("fund_code", 3, 100), F.lit("0"))))
    return rows.where(~ref.like("%77")).unionByName(new)


def _investment_transactions(j: DataFrame) -> DataFrame:
    c, lk, pk = F.col("o_custkey"), F.col("l_orderkey"), F.col("l_partkey")
    cl = _client_columns(c)
    company = tenant(c)
    return j.select(
        company.alias("company"),
        F.when(company == TENANTS[0], "valuation_transactions").otherwise("transactions").alias("dataset"),
        F.when(lk % 12 == 0, null())
         .otherwise(F.concat(F.lit("IT"), pad(lk, 9), F.lit("-"), txt(F.col("l_linenumber")))).alias("transaction_id"),
        investment_policy(c, lk).alias("policy_number"),
        client_id_number(c).alias("client_id_number"),
        F.when(pk % 9 == 0, null()).otherwise(F.concat(F.lit("FC"), txt(F.col("p_size") % 12))).alias("fund_code"),
        F.col("l_returnflag").alias("transaction_type"),
        txt(shift20(F.col("l_shipdate"))).alias("transaction_date"),
        txt(money(F.col("l_extendedprice"))).alias("amount"),
        txt(F.col("l_quantity").cast("decimal(18,4)")).alias("units"),
        txt(F.col("p_retailprice").cast("decimal(18,4)")).alias("price_per_unit"),
        F.when(F.col("l_linestatus") == "F", "SETTLED").otherwise("PENDING").alias("status"),
        F.concat(F.lit("REF"), pad(lk, 9)).alias("reference_number"),
        null().alias("source_fund"),
        F.col("p_name").alias("narrative"),
        cl[0], cl[1], cl[2], cl[3],
        ts_ntz(LOAD_TS).alias("_loaded_at"),
    )


def risk_transactions(tables: TableSource, variant: int = 0) -> DataFrame:
    e = tables("events")
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    company = tenant(uid)
    status = F.when(et == "error", "REVERSED").otherwise("POSTED")
    if variant:
        status = F.when(eid % 100 == 0, F.lit("AMENDED")).otherwise(status)
    purchase = et == "purchase"
    rows = e.select(
        company.alias("company"),
        F.when(company == TENANTS[0], "risk_benefits_transactions").otherwise("ins_transactions").alias("dataset"),
        F.when(eid % 12 == 0, null()).otherwise(F.concat(F.lit("RT"), pad(eid, 9))).alias("transaction_id"),
        F.when(eid % 13 == 0, null()).otherwise(F.concat(F.lit("RB"), pad(uid, 8))).alias("policy_number"),
        F.concat(F.lit("MEM"), pad(uid, 7)).alias("member_id"),
        et.alias("transaction_type"),
        txt(F.to_date(F.col("ts"))).alias("transaction_date"),
        txt(money(F.col("value"))).alias("amount"),
        status.alias("status"),
        F.concat(F.lit("RTR"), pad(eid, 9)).alias("reference_number"),
        F.col("props").alias("narrative"),
        F.when(purchase, "DEATH").alias("claim_type"),
        F.when(purchase, "NATURAL").alias("claim_reason"),
        F.when(purchase, "LIFE").alias("benefit_affected"),
        null().alias("client_title"), null().alias("client_first_name"),
        null().alias("client_surname"), null().alias("client_initials"),
        ts_ntz(LOAD_TS).alias("_loaded_at"),
    )
    if not variant:
        return rows
    ref = F.col("reference_number")
    new = _replaced(rows.where(ref.like("%25")), transaction_id=F.concat(F.lit("RN"), F.substring("reference_number", 4, 100)),
                    policy_number=F.concat(F.lit("RX"), F.substring("member_id", 4, 100)))
    return rows.where(~ref.like("%77")).unionByName(new)


def _risk_policy_load(cust: DataFrame, age_offset: int, loaded_at: str, variant: int) -> DataFrame:
    c = F.col("c_custkey")
    company = tenant(c)
    acct = money(F.col("c_acctbal"))
    m6 = c % 6
    status = (F.when(m6 == 0, "Active").when(m6 == 1, "Lapsed").when(m6 == 2, "Cancelled")
               .when(m6 == 3, "Pending").when(m6 == 4, null()).otherwise("Active"))
    if variant:
        status = F.when(c % 50 == 0, F.lit("Lapsed")).otherwise(status)
    return cust.select(
        company.alias("company"),
        F.when(company == TENANTS[0], "risk_benefits")
         .when(company == TENANTS[1], "insurance").otherwise("assurance").alias("dataset"),
        F.when(c % 29 == 0, null()).otherwise(F.concat(F.lit("RB"), pad(c, 8))).alias("policynumber"),
        F.when(c % 12 == 5, null())
         .otherwise(txt(F.date_add(F.lit("2015-01-01").cast("date"), (c % 2000).cast("int")))).alias("inceptiondate"),
        status.alias("policystatus"),
        F.concat(F.lit("MEM"), pad(c, 7)).alias("memberid"),
        txt(age_offset + 20 + c % 50).alias("agenext"),
        F.when(c % 5 == 0, "Smoker").when(c % 5 == 1, null()).otherwise("Non-Smoker").alias("smokerstatus"),
        F.when(c % 10 == 3, null()).otherwise(F.col("c_mktsegment")).alias("incomebrackets"),
        F.when(company == TENANTS[0], null()).when(c % 8 == 7, null())
         .otherwise(F.concat(F.lit("Cover "), txt(F.col("c_nationkey") % 4))).alias("productname"),
        txt(scaled(acct, "100")).alias("life_sumassured"),
        txt(scaled(acct, "0.0100")).alias("life_premium"),
        F.when(c % 2 == 0, "FUNCTIONAL").otherwise("OCCUPATIONAL").alias("disability_type"),
        txt(scaled(acct, "50")).alias("disability_sumassured"),
        txt(scaled(acct, "0.0050")).alias("disability_premium"),
        F.when(c % 3 == 0, "LEVEL1").when(c % 3 == 1, "LEVEL2").alias("chronic_level"),
        F.lit("3 months").alias("chronic_waitingperiod"),
        F.when(c % 3 == 2, null()).otherwise(txt(scaled(acct, "0.0020"))).alias("chronic_premium"),
        txt(scaled(acct, "10")).alias("accident_benefit"),
        txt(scaled(acct, "0.0010")).alias("accident_premium"),
        txt(scaled(acct, "0.0180")).alias("total_monthlypremium"),
        F.lit("0.0300").alias("commission_rate"),
        F.when(c % 9 == 0, null()).otherwise(F.concat(F.lit("ADV"), pad(c % 40, 4))).alias("advisor_identifier"),
        null().alias("client_title"), null().alias("client_first_name"),
        F.col("c_name").alias("client_surname"), null().alias("client_initials"),
        ts_ntz(loaded_at).alias("_loaded_at"),
    )


def risk_policies(tables: TableSource, variant: int = 0) -> DataFrame:
    """Risk master feed: one load of every customer plus a reload of
    ``c_custkey % 10 = 0`` one month later with ``age_next + 1``."""
    cust = tables("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    first = _risk_policy_load(cust, 0, RISK_LOAD_TS, variant)
    reload = _risk_policy_load(cust.where(F.col("c_custkey") % 10 == 0), 1, RISK_RELOAD_TS, variant)
    rows = first.unionByName(reload)
    if not variant:
        return rows
    member = F.col("memberid")
    new = _replaced(rows.where(member.like("%31")), policynumber=F.concat(F.lit("RN"), F.substring("memberid", 4, 100)))
    return rows.where(~member.like("%47")).unionByName(new)


def pipe_errors(tables: TableSource) -> DataFrame:
    """Load errors of the risk-transaction pipes, derived from the ``error``
    events: one rejected row per error event, with NULL file names and lines
    mixed in so the null-safe MERGE key is exercised.  ``error_ts`` is when
    the load failed."""
    e = tables("events").where(F.col("event_type") == "error")
    eid, uid = F.col("event_id"), F.col("user_id")
    line = F.when(eid % 11 == 0, F.lit(None).cast("bigint")).otherwise(eid % 1000 + 2)
    return e.select(
        F.concat(F.lit("PIPE_"), tenant(uid), F.lit("_RISK_TRANSACTIONS")).alias("pipe_name"),
        F.concat(F.lit("Numeric value '"), F.col("props"), F.lit("' is not recognized")).alias("error"),
        F.when(eid % 7 == 0, null())
         .otherwise(F.concat(F.lit("fsp-risk-"), F.date_format("ts", "yyyyMMdd"), F.lit(".csv"))).alias("file_name"),
        line.alias("line"),
        F.lit(1).cast("bigint").alias("character_pos"),
        F.lit(None).cast("bigint").alias("byte_offset"),
        F.lit("conversion").alias("category"), F.lit("100038").alias("code"), F.lit("22018").alias("sql_state"),
        F.lit('"AMOUNT"').alias("column_name"),
        (eid % 1000 + 1).alias("row_number"),
        line.alias("row_start_line"),
        F.col("props").alias("rejected_record"),
        F.col("ts").cast("timestamp_ntz").alias("error_ts"),
    )


# ------------------------------------------------------------------ stored landing
_STORED: dict[tuple, str] = {}
_STORING = Lock()

SHAPE_BUILDERS = {
    "commissions": lambda t, v: commissions(t),
    "valuations": lambda t, v, lines=None: valuations(t, lines),
    "investment_transactions": lambda t, v, lines=None: investment_transactions(t, v, lines),
    "risk_transactions": lambda t, v: risk_transactions(t, v),
    "risk_policies": lambda t, v: risk_policies(t, v),
}
LINE_SHAPES = ("valuations", "investment_transactions")


def _stored(tables: TableSource, name: str, rows) -> DataFrame:
    """``rows(tables)`` written once per session under the shared checkpoint
    folder and read back."""
    from ..plans.tables import write
    from ..session import shared_path
    import uuid

    spark = tables.spark
    key = (id(spark.sparkContext), spark.sparkContext.applicationId, tables.root, name)
    with _STORING:
        if key not in _STORED:
            path = shared_path(spark, "landing-cache", f"{name}-{uuid.uuid4().hex}")
            write(rows(tables), path)
            _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def stored_landing(tables: TableSource, shape: str, variant: int = 0) -> DataFrame:
    """A landing feed of this session.  The line feeds of both variants are
    projections of one stored join of the lines with their orders and parts,
    in the tables' own types, so the join runs once and no line feed is
    written as text; commissions are stored as they land; the risk feeds are
    projections of one table each."""
    build = SHAPE_BUILDERS[shape]
    if shape in LINE_SHAPES:
        return build(tables, variant, _stored(tables, "lines", _line_orders_parts))
    return _stored(tables, shape, commissions) if shape == "commissions" else build(tables, variant)
