"""K5: the skew-safe row number equals the single-window row number."""

from pyspark.sql import functions as F

from ledgerloom.operators.numbering import Order, row_in_grain


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_skew_safe_equals_plain_on_hot_group(spark):
    # 2000 rows, 1/3 in one hot grain, NULLs in the split column and in ties
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 11).alias("d"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id") % 4).alias("a"),
        F.col("id"))
    for nulls_last in (True, False):
        order = [Order("d", True, nulls_last), Order("a", False, True), Order("id")]
        safe = row_in_grain(df, ["k"], order)
        plain = row_in_grain(df, ["k"], order, plain=True)
        assert _rows(safe) == _rows(plain)


def test_two_split_columns(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("k"), (F.col("id") % 3).alias("d"),
                                 (F.col("id") % 5).alias("a"), F.col("id"))
    order = [Order("d"), Order("a"), Order("id")]
    assert _rows(row_in_grain(df, ["k"], order)) == _rows(row_in_grain(df, ["k"], order, plain=True))


def test_one_grain_holds_nine_tenths_with_equal_leading_values(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 10 > 0, F.lit("HOT")).otherwise(F.lit("c")).alias("k"),
        F.when(F.col("id") % 4 > 0, F.lit("2020-01-01").cast("date")).alias("d"),
        F.when(F.col("id") % 9 > 0, (F.col("id") * 7919 % 1000).cast("decimal(18,2)")).alias("a"),
        F.col("id").cast("string").alias("id"))
    for up in (True, False):
        for nulls_last in (True, False):
            order = [Order("d", up, nulls_last), Order("a", not up, nulls_last), Order("id")]
            got = row_in_grain(df, ["k"], order)
            assert _rows(got) == _rows(row_in_grain(df, ["k"], order, plain=True))
    assert dict(got.dtypes)["_row_in_grain"] == "bigint"
    # the hot grain is dealt over many window partitions
    from ledgerloom.operators import numbering
    rows = df.where("k = 'HOT'").withColumn("_h", F.xxhash64("k"))
    cuts, depth, most = numbering._cuts(rows, order, rows.sample)
    ranged = numbering._ranged(rows, cuts, most, numbering._position(rows, order, depth))
    largest = ranged.groupBy("_b").count().agg(F.max("count")).first()[0]
    assert largest < 400                    # rows with NULL in both columns stay together
    words = [Order("id", True), Order("a")]
    assert _rows(row_in_grain(df, ["k"], words)) == _rows(row_in_grain(df, ["k"], words, plain=True))
    assert row_in_grain(df.limit(0), ["k"], order).collect() == []


def test_keys_that_share_a_prefix_are_cut(spark):
    """String keys that differ only behind a long common prefix."""
    df = spark.range(6000).select(F.lit(1).alias("k"), F.format_string("POLICY-2020-%06d", F.col("id") * 7919 % 6000).alias("id"))
    order = [Order("id")]
    assert _rows(row_in_grain(df, ["k"], order)) == _rows(row_in_grain(df, ["k"], order, plain=True))
    from ledgerloom.operators import numbering
    rows = df.withColumn("_h", F.xxhash64("k"))
    cuts, depth, most = numbering._cuts(rows, order, rows.sample)
    ranged = numbering._ranged(rows, cuts, most, numbering._position(rows, order, depth))
    assert ranged.groupBy("_b").count().agg(F.max("count")).first()[0] < 600


def test_an_order_that_descends_on_a_string_is_not_cut_there(spark):
    df = spark.range(900).select(F.lit(1).alias("k"), (F.col("id") % 3).alias("a"), F.col("id").cast("string").alias("s"))
    order = [Order("a", False), Order("s", False)]
    assert _rows(row_in_grain(df, ["k"], order)) == _rows(row_in_grain(df, ["k"], order, plain=True))
    # and a grain of which every row is met at most once is numbered without cuts
    one = spark.range(50).select(F.col("id").alias("k"), F.col("id"))
    assert {r["_row_in_grain"] for r in row_in_grain(one, ["k"], [Order("id")]).collect()} == {1}


def test_no_single_task_draws_the_sample(spark, monkeypatch):
    """The sample ends in one partition, the rows it is drawn from do not."""
    from ledgerloom.operators import numbering
    staged, write = [], numbering.stage
    monkeypatch.setattr(numbering, "stage", lambda df, name: staged.append((name, df)) or write(df, name))
    df = spark.range(0, 4000, 1, 8).select((F.col("id") % 2).alias("k"), "id")
    row_in_grain(df, ["k"], [Order("id")])
    plan = dict(staged)["numbering-sample"]._jdf.queryExecution().executedPlan().toString()
    assert "Sample" in plan and "Coalesce" not in plan


def test_a_suite_builds_only_the_tables_it_names():
    from ledgerloom.operators.quality import DataTest
    from ledgerloom.queries.quality import core_tables

    class Built:
        def __init__(self):
            self.names = []

        def __getattr__(self, name):
            self.names.append(name)
            return name
    w = Built()
    tests = [DataTest("unique", "dim_client", ("client_sk",)),
             DataTest("relationships", "fct_valuations", ("fund_sk",), to="dim_fund", field="fund_sk")]
    assert set(core_tables(w, tests)) == set(w.names) == {"dim_client", "fct_valuations", "dim_fund"}


def test_rows_alone_in_their_grain_are_not_exchanged(spark, monkeypatch):
    from ledgerloom.operators import numbering
    taken, cuts = [], numbering._cuts
    monkeypatch.setattr(numbering, "_cuts", lambda rows, *a: taken.append(rows.count()) or cuts(rows, *a))
    df = spark.range(3000).select(F.when(F.col("id") < 2700, F.concat(F.lit("k"), F.col("id").cast("string")))
                                  .when(F.col("id") % 3 > 0, F.lit("HOT")).alias("k"),
                                  (F.col("id") * 7919 % 1000).alias("a"), F.col("id"))
    order = [Order("a", False), Order("id")]
    want = _rows(row_in_grain(df, ["k"], order, plain=True))
    assert _rows(row_in_grain(df, ["k"], order)) == want and 300 <= taken[-1] < 900
    assert row_in_grain(df, ["k"], order).columns == ["k", "a", "id", "_row_in_grain"]
    monkeypatch.setattr(numbering, "WORDS", 0)          # the grains do not fit the bitmap
    assert _rows(row_in_grain(df, ["k"], order)) == want and taken[-1] == 3000
    # every grain twice, and most bits taken
    monkeypatch.setattr(numbering, "WORDS", 3)
    twice = df.where("id < 40").union(df.where("id < 2700"))
    assert _rows(row_in_grain(twice, ["k"], order)) == _rows(row_in_grain(twice, ["k"], order, plain=True))


def test_both_universes_are_read_by_tasks_of_their_own(spark, monkeypatch):
    """The tables that the transactions' numbering writes are made of rows that
    an exchange brings: no task reads both universes whole."""
    from ledgerloom.operators import facts, numbering

    def universe(n):
        own = {"company": F.lit("A"), "transaction_id": F.when(F.col("id") % 3 > 0, F.col("id").cast("string")),
               "amount": F.col("id") % 7, "narrative": F.col("id").cast("string")}
        return spark.range(0, n, 1, 4).select(*[own.get(c, F.lit(None).cast("string")).alias(c) for c in facts.TXN_COLUMNS])
    risk, investment = universe(900), universe(600)
    staged, write = [], numbering.stage
    monkeypatch.setattr(numbering, "stage", lambda df, name: staged.append((name, df)) or write(df, name))
    got = facts.transactions_numbered(risk, investment, draw=lambda part: (risk.sample(part), investment.sample(part)))
    assert _rows(got) == _rows(facts.transactions_numbered(risk, investment, plain_numbering=True))
    plans = {name: df._jdf.queryExecution().executedPlan().toString() for name, df in staged}
    reading = {name: plan for name, plan in plans.items() if "Range (" in plan}
    assert {"numbering-sample", "numbering-shared"} <= set(reading)
    for plan in reading.values():
        assert "Coalesce" not in plan and 0 <= plan.find("Exchange") < plan.index("Union")


def test_rows_alone_in_their_grain_are_not_grouped_for_the_last_row(spark):
    """A satellite's row per key: only the rows that share a grain are exchanged."""
    from ledgerloom.operators import vault as V
    from ledgerloom.operators.numbering import Order, row_in_grain
    rows = spark.range(4_000).selectExpr(
        "if(id % 50 = 0, null, 'C') AS company", "if(id < 3900, concat('t', id), if(id % 2 = 0, '_NULL_', 't7')) AS transaction_id",
        "if(id % 9 = 0, null, id) AS v")
    rows = rows.unionByName(rows.limit(3).selectExpr("company", "null AS transaction_id", "v"))
    numbered = row_in_grain(rows, [F.col("company"), F.coalesce(F.col("transaction_id"), F.lit("_NULL_"))], [Order("v")], alone_as="_alone")
    alone = numbered.where("_alone")
    assert 3_000 < alone.count() <= 3_900 and alone.where("_row_in_grain != 1").count() == 0
    assert alone.groupBy("company", "transaction_id").count().where("count > 1").count() == 0
    stamp = F.lit("2024-06-30 00:00:00").cast("timestamp_ntz")
    got = V.satellite_source(numbered, ["v"], stamp, collapse=True)
    want = V.satellite_source(numbered.drop("_alone"), ["v"], stamp, collapse=True)
    assert _rows(got) == _rows(want) and got.columns == want.columns
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("max_by") >= 1


def test_the_sample_takes_the_number_of_rows_from_the_counted_grains(spark, monkeypatch):
    from ledgerloom.operators import numbering
    sizes, cuts = [], numbering._cuts
    monkeypatch.setattr(numbering, "_cuts", lambda rows, order, draw, size=None: sizes.append(size) or cuts(rows, order, draw, size))
    rows = spark.range(1_000).selectExpr("if(id < 600, -1, id) AS g", "id AS v")
    got = numbering.row_in_grain(rows, ["g"], [numbering.Order("v")])
    assert sizes == [600]
    assert {(r.g, r.v, r._row_in_grain) for r in got.collect()} == {(-1, v, v + 1) if v < 600 else (v, v, 1) for v in range(1_000)}
