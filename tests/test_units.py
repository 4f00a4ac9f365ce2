"""Binds, spec checks, scalar helpers, row validity, ranks, generator, source options."""

from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.compare import duck
from tests.seed import SCHEMA, good, order_row, seed
from tidemark import ChangeSpec, Column, Link, Mapping, SpecError, apply_final, replay
from tidemark.examples.orders import orders_spec, user_link
from tidemark.functions import bind, bind_names, clean, code_map, cut_detail, date_from_parts, first_line
from tidemark.functions import joined_text, rounded_product, text_or
from tidemark.operators import audit, mapping
from tidemark.operators.ranks import with_rank
from tidemark.operators.skew import SkewPolicy
from tidemark.sources.changelog import first_rows, keyset_page, page_borders
from tidemark.sources.generate import generate_changes
from tidemark.sources.jdbc import jdbc_options
from workload.logs import event_log, event_spec, line_log, line_spec, order_log, order_spec

SF = "/root/testdata/sf0.01"


# -- binds ---------------------------------------------------------------------


def test_bind_skips_comments_strings_and_casts():
    text = """:A || ':B' || ":C" /* :D
      :E */ || a::string || `:F` -- :G
      || 'it''s :H' || x:y || :a"""
    assert bind_names(text) == ["A"]
    bound = bind(text, lambda n: f"col_{n.lower()}")
    assert bound.startswith("`col_a` || ':B'") and bound.endswith("|| `col_a`")
    assert "a::string" in bound and "x:y" in bound and ":E */" in bound


def test_clean_drops_semicolons_and_refuses_nothing():
    assert clean("  :A + 1 ; ; ") == ":A + 1"
    for empty in ("", "  ", " ; "):
        with pytest.raises(ValueError):
            clean(empty)


def test_binds_ignore_case(spark):
    df = good(spark, (1, "I", 7)).withColumnRenamed("order_id", "ORDER_ID")
    rows = apply_final(df, orders_spec(order_key="CHANGE_ID")).collect()
    assert rows[0].order_id == 7 and rows[0].summary_id == 1


# -- spec ----------------------------------------------------------------------


def spec(**changed):
    settings = dict(
        business_keys=("k",), target={"a": Column("string")},
        insert=Mapping({"a": ":A"}), update=Mapping({"a": ":A"}),
    )
    return ChangeSpec(**{**settings, **changed})


@pytest.mark.parametrize(
    "changed",
    [
        {"business_keys": ()},
        {"business_keys": ("k", " ")},
        {"on_duplicate": "replace"},
        {"on_missing": "insert"},
        {"mark_policy": "none"},
        {"insert": Mapping({"b": ":B"})},
        {"insert": Mapping({"k": ":K"})},
        {"insert": Mapping({"a": " ; "})},
        {"update": Mapping({}), "on_missing": "upsert"},
        {"link": user_link("u", "s"), "on_duplicate": "upsert"},
        {"link": Link({"p": ":NEW_ID", "u": ":WHO"}, {"p": Column("bigint"), "u": Column("string")})},
        {"link": Link({"u": ":WHO"}, {"u": Column("string")}, {"WHO": 1})},
    ],
    ids=str,
)
def test_bad_specs(changed):
    with pytest.raises(SpecError):
        spec(**changed)


@pytest.mark.parametrize(
    "columns, changed",
    [
        ("change_id long, operation string, a string", {}),
        ("id long, operation string, k int, a string", {}),
        ("change_id long, op string, k int, a string", {}),
        ("change_id long, operation string, k int", {}),
        ("change_id long, operation string, k int, a string", {"processed_column": "done"}),
    ],
)
def test_missing_source_columns(spark, columns, changed):
    with pytest.raises(SpecError):
        replay(spark.createDataFrame([], columns), spec(**changed), skew=None)


def test_two_columns_of_one_name(spark):
    df = spark.createDataFrame([], "change_id long, operation string, k int, a string")
    with pytest.raises(SpecError):
        replay(df.withColumn("x", F.lit(1)).toDF("change_id", "operation", "k", "a", "A"), spec(), skew=None)


def test_log_columns_may_be_called_like_results(spark):
    log = good(spark, (1, "I", 7), (2, "I", 7)).withColumns({c: F.lit("mine") for c in ("detail", "present", "kind")})
    assert apply_final(log, orders_spec()).count() == 1
    with pytest.raises(SpecError):
        replay(log, orders_spec())


def test_equal_flags_take_the_first_match(spark):
    same = orders_spec(op_update="I", op_delete="D")
    rows = replay(good(spark, (1, "I", 7), (2, "D", 7)), same).orderBy("change_id").collect()
    assert [r.outcome for r in rows] == ["INSERTED", "DELETED"]


# -- scalars -------------------------------------------------------------------


def value(spark, expression):
    return spark.range(1).select(F.expr(expression)).first()[0]


def test_scalars(spark):
    assert value(spark, joined_text("'a'", "null", "'c'")) == "a  c"
    assert value(spark, text_or("''", "UNKNOWN")) == "UNKNOWN"
    assert value(spark, text_or("null", "UNKNOWN")) == "UNKNOWN"
    assert str(value(spark, date_from_parts("'5'", "'1'", "'2026'"))) == "2026-01-05"
    assert value(spark, date_from_parts("'10'", "'13'", "'2026'")) is None
    assert value(spark, date_from_parts("'30'", "'02'", "'2026'")) is None
    assert value(spark, date_from_parts("null", "'02'", "'2026'")) is None
    assert value(spark, code_map("null", {"NW": "NEW"}, "OTHER")) == "OTHER"
    assert value(spark, code_map("'NW'", {"NW": "NEW"}, "OTHER")) == "NEW"
    product = rounded_product("cast('49.995' as decimal(12,3))", "cast(3 as decimal(8,0))")
    assert value(spark, product) == Decimal("149.99")
    assert len(value(spark, cut_detail("repeat('x', 500)"))) == 400
    assert value(spark, first_line("'  one \\n two'")) == "one"


# -- validity --------------------------------------------------------------------


def test_row_validity(spark):
    big = order_row(1, "I", 1, "A", "B", "01/02/2026", "9999999999.99", "99999999", "NW", "US")
    rows = [
        big,
        order_row(2, "I", 2, "x" * 150, "y" * 150, "01/02/2026", "1", "1"),
        order_row(3, "U", 3, "A", "B", "31/02/2026", "1", "1"),
        order_row(4, "D", 4),
        order_row(5, "I", 5, "A", "B", "1/2/2026", None, "1"),
        order_row(6, "I", 6, None, "  ", "1/2/2026", "0.005", "1", None, "ZZ"),
    ]
    log = spark.createDataFrame(rows, SCHEMA)
    got = {r.change_id: r.reason for r in mapping.row_validity(log, orders_spec()).collect()}
    assert got == {
        1: "invalid:total_amount", 2: "invalid:customer_name", 3: "invalid:order_date",
        4: None, 5: "invalid:total_amount", 6: None,
    }
    row = mapping.map_insert(log, orders_spec()).where("change_id = 6").first()
    assert (row.customer_name, row.status, row.region, str(row.total_amount)) == (
        "UNKNOWN", "UNKNOWN", "OTHER", "0.01",
    )


def test_null_business_key(spark):
    log = good(spark, (1, "I", 7), (2, "U", 7), (3, "D", 7))
    log = log.withColumn("order_id", F.lit(None).cast("long"))
    rows = replay(log, orders_spec()).orderBy("change_id").collect()
    assert [r.outcome for r in rows] == ["FAILED", "SKIPPED_QUARANTINED", "SKIPPED_QUARANTINED"]
    assert rows[0].detail == "invalid:order_id"
    held = spark.createDataFrame([(None,)], "order_id int")
    again = replay(log.where("change_id = 2"), orders_spec(), quarantine=held).collect()
    assert again[0].outcome == "SKIPPED_QUARANTINED"


def test_outcome_table(spark):
    """One row per case of the contract, on a key of its own."""
    target = apply_final(good(spark, (1, "I", 1), (2, "I", 2), (3, "I", 3), (4, "I", 4)), orders_spec())
    bad = order_row(14, "U", 2, "A", "B", "40/02/2026", "1", "1")
    absent = order_row(15, "U", 20, "A", "B", "40/02/2026", "1", "1")
    broken = order_row(16, "I", 21, "A", "B", "40/02/2026", "1", "1")
    rows = good(
        spark, (10, "X", 1), (11, "I", 10), (12, "I", 1), (13, "U", 3), (17, "D", 4), (18, "D", 22),
        (19, "U", 23), (20, "U", 30), (21, "I", 40), (22, "U", 1),
    )
    log = rows.union(spark.createDataFrame([bad, absent, broken], SCHEMA))
    held = spark.createDataFrame([(30,)], "order_id int")
    got = {r.change_id: (r.outcome, r.detail) for r in replay(log, orders_spec(), target, held).collect()}
    assert got == {
        10: ("SKIPPED_BADROW", "unknown operation value 'X'"),
        11: ("INSERTED", None),
        12: ("FAILED", "duplicate:order_id"),
        13: ("UPDATED", None),
        14: ("FAILED", "invalid:order_date"),
        15: ("UPDATED", None),
        16: ("FAILED", "invalid:order_date"),
        17: ("DELETED", None),
        18: ("DELETED", None),
        19: ("UPDATED", None),
        20: ("SKIPPED_QUARANTINED", "business key is quarantined"),
        21: ("INSERTED", None),
        22: ("SKIPPED_QUARANTINED", "business key is quarantined"),
    }


def test_link_reason_keeps_the_row(spark):
    broken = orders_spec(link=user_link("u" * 65, "s"))
    log = good(spark, (1, "I", 7))
    row = replay(log, broken).first()
    assert (row.outcome, row.detail) == ("LINK_FAILED", "link:user_id")
    assert apply_final(log, broken).count() == 1


def test_link_value_keeps_leading_zeros(spark):
    from tidemark.operators.links import links_new

    zeros = orders_spec(link=user_link("007", "s"))
    assert links_new(replay(good(spark, (1, "I", 7)), zeros), zeros).first().user_id == "007"


# -- published counts of the derived logs ---------------------------------------


def totals(df):
    return {r.outcome: r["rows"] for r in audit.outcome_totals(df).collect()}


def test_counts_of_the_event_log(spark):
    log = event_log(spark, SF)
    assert totals(replay(log, event_spec())) == {
        "INSERTED": 286, "UPDATED": 871, "DELETED": 426, "FAILED": 155,
        "SKIPPED_BADROW": 1982, "SKIPPED_QUARANTINED": 6280,
    }
    assert totals(replay(log, event_spec(quarantine=False))) == {
        "INSERTED": 1038, "UPDATED": 3940, "DELETED": 2014, "FAILED": 1026, "SKIPPED_BADROW": 1982,
    }


def test_counts_of_the_order_log(spark):
    log = order_log(spark, SF)
    assert totals(replay(log, order_spec())) == {
        "INSERTED": 14845, "UPDATED": 1485, "DELETED": 148, "FAILED": 155, "SKIPPED_QUARANTINED": 17,
    }
    assert apply_final(log, order_spec()).count() == 14697
    assert totals(replay(log, order_spec(quarantine=False))) == {
        "INSERTED": 14845, "UPDATED": 1500, "DELETED": 150, "FAILED": 155,
    }


def test_counts_of_the_line_log(spark):
    log = line_log(spark, SF)
    outcomes = replay(log, line_spec())
    assert totals(outcomes) == {
        "INSERTED": 14364, "UPDATED": 19183, "DELETED": 19548, "FAILED": 5466, "SKIPPED_QUARANTINED": 1439,
    }
    assert audit.quarantine_new(outcomes, line_spec()).count() == 5208
    assert apply_final(log, line_spec()).count() == 13149


def test_empty_text_is_null(spark):
    log = good(spark, (1, "I", 1)).withColumn("cust_last_name", F.lit("")).withColumn("cust_first_name", F.lit(""))
    spec = orders_spec(insert=Mapping({**orders_spec().insert.columns, "customer_name": ":CUST_FIRST_NAME"}))
    assert [r.outcome for r in replay(log, spec).collect()] == ["FAILED"]
    assert [r.outcome for r in replay(log, replace(spec, empty_is_null=False)).collect()] != ["FAILED"]


def test_blank_link_parameters_are_refused():
    with pytest.raises(SpecError):
        orders_spec(link=user_link(" ", "orders"))


# -- ranks and pages -------------------------------------------------------------


@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_rank_over_several_partitions(spark, partitions):
    rows = spark.range(0, 20_000, numPartitions=5).withColumn("x", F.xxhash64("id"))
    got = with_rank(rows, ["x"], partitions=partitions)
    expected = {r.id: i for i, r in enumerate(sorted(rows.collect(), key=lambda r: r.x), start=1)}
    assert {r.id: r["rank"] for r in got.collect()} == expected


def test_a_page_is_cut_at_a_border(spark):
    rows = spark.range(0, 1000).select((F.col("id") * 3).alias("change_id"))
    assert sorted(r[0] for r in first_rows(rows, "change_id", 400).collect()) == list(range(0, 1200, 3))
    assert first_rows(rows, "change_id", 5000).count() == 1000
    borders = [rows.limit(1).select(b).first()[0] for b in page_borders(rows, "change_id", 400)]
    assert borders == [399 * 3, 799 * 3, 999 * 3]


def test_a_border_takes_all_rows_of_its_key(spark):
    rows = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "k int")
    assert sorted((r[0] or 0) for r in first_rows(rows, "k", 2).collect()) == [0, 1, 2, 2]


def test_keyset_page(spark):
    log = seed(spark)
    assert sorted(r.change_id for r in keyset_page(log, orders_spec(), 5, 3).collect()) == [6, 7, 8]
    assert keyset_page(log, orders_spec(), 17).count() == 0


@pytest.mark.parametrize("slices", [1, 2, 5, 90])
def test_slices_keep_the_order(spark, slices):
    """Each row of a hot key gets the slice its order key falls into; others get none."""
    from bisect import bisect_right

    from tidemark.operators.skew import SLICE, find_hot_keys, with_slice

    n = 1800
    hot = F.col("id") % 2 == 0
    rows = spark.range(n).select(
        F.when(hot, F.lit(None)).when(F.col("id") % 10 == 1, 7).otherwise(F.col("id") + 100).alias("k"),
        F.when(F.col("id") % 97 != 0, F.col("id") * 37 % 1000).alias("at"),
    )
    found = find_hot_keys(rows, ["k"], "at", SkewPolicy(hot_rows=100, sample=1.0, slice_rows=max(1, 900 // slices)))
    assert found.null_safe
    borders = {k: [] for k in (None, 7)}
    for k, number, low, _ in sorted(found.slices.collect(), key=lambda r: r[1]):
        assert (low is None) == (number == 0)
        borders[k] += [low] if number else []
    assert set(borders) == {None, 7}
    for r in with_slice(rows, found, ["k"], "at").collect():
        if r.k not in borders:
            assert r[SLICE] is None
        else:
            assert r[SLICE] == (0 if r["at"] is None else bisect_right(borders[r.k], r["at"]))


def test_a_row_meets_few_candidate_slices(spark, monkeypatch):
    """Each join that finds a slice offers a bounded number of candidates, however many slices there are."""
    from tidemark.operators import skew

    rows = spark.range(6_000).select(F.lit("a").alias("k"), F.col("id").alias("at"))
    found = skew.find_hot_keys(rows, ["k"], "at", SkewPolicy(hot_rows=100, sample=1.0, slice_rows=4))
    assert found.most > 1_000
    offered, plain = [], skew.match_keys

    def watched(rows, small, *rest):
        by = [c for c in small.columns if c in ("k", skew._OF_BLOCK)]
        # The topmost table has no block above it: all its rows are candidates.
        by = by if skew._BLOCK in rows.columns else ["k"]
        offered.append(small.groupBy(*by).count().agg(F.max("count")).first()[0])
        return plain(rows, small, *rest)

    monkeypatch.setattr(skew, "match_keys", watched)
    got = skew.with_slice(rows, found, ["k"], "at")
    assert max(offered) <= 16
    assert got.count() == 6_000 and got.select(skew.SLICE).distinct().count() == found.most



def test_hot_rows_are_summed_up_once(spark):
    """However many levels the slices are chained in, the log is not read again for each."""
    log = spark.range(400).selectExpr("id + 1 AS change_id", "'I' AS operation", "'x' AS k", "'1' AS a")

    def reads(chain):
        rows = replay(log, spec(quarantine=False), skew=SkewPolicy(hot_rows=10, sample=1.0, slice_rows=4, chain=chain))
        assert totals(rows) == {"INSERTED": 1, "FAILED": 399}
        return rows._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 400")

    assert reads(2) <= reads(1_000)


# -- generator -------------------------------------------------------------------


def test_generated_log(spark):
    log = generate_changes(spark, 10_000)
    assert log.groupBy("operation").count().collect() and log.count() == 11_100
    assert totals(replay(log, orders_spec())) == {"INSERTED": 10_000, "UPDATED": 1_000, "DELETED": 100}
    target = apply_final(log, orders_spec())
    assert target.count() == 9_900
    assert target.where("status = 'SHIPPED'").count() == 2_500 + 1_000 - 100


def test_skewed_generated_log(spark):
    """A third of all rows on one key, cut into slices, against SQL over the same rows."""
    from workload.sql import imaged, replayed, with_

    n = 30_000
    key = F.when(F.pmod(F.xxhash64("id"), F.lit(3)) == 0, 0).otherwise(F.pmod("id", F.lit(4_000)))
    pick = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(10))
    log = spark.range(n).select(
        F.col("id").alias("change_id"),
        F.when(pick < 4, "I").when(pick < 7, "U").otherwise("D").alias("operation"),
        key.alias("user_id"),
        F.pmod(F.xxhash64("id", F.lit(6)), F.lit(100)).cast("int").alias("k"),
        F.col("id").cast("double").alias("value"),
    )
    spec = event_spec(quarantine=False)
    hot = SkewPolicy(hot_rows=2_000, sample=1.0, slice_rows=700)
    got = apply_final(log, spec, skew=hot).toPandas()
    base = """elog AS (SELECT change_id, operation AS op, user_id, k, value AS amount,
      CASE WHEN operation IN ('I', 'U') AND k >= 98 THEN 'invalid:k' END AS reason FROM log)"""
    ctes = replayed(base, "user_id", quarantine=False) + ",\n" + imaged("user_id", "k, amount")
    con = duck(SF)
    con.register("log", log.toPandas())
    expected = con.execute(with_(ctes, "SELECT row_id, user_id, k, amount FROM img")).fetchall()
    rows = got[["profile_id", "user_id", "k", "amount"]].itertuples(index=False, name=None)
    assert sorted(tuple(r) for r in rows) == sorted(expected)


# -- jdbc ------------------------------------------------------------------------


def test_jdbc_options():
    plain = jdbc_options("jdbc:x:y", "log", "change_id")
    assert plain == {"url": "jdbc:x:y", "dbtable": "log", "fetchsize": "10000"}
    split = jdbc_options("jdbc:x:y", "log", "change_id", 1, 900, 8, user="u")
    assert split["partitionColumn"] == "change_id" and split["numPartitions"] == "8"
    assert (split["lowerBound"], split["upperBound"], split["user"]) == ("1", "900", "u")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x:y", "log", "change_id", partitions=4)


# -- names of keys, instants -----------------------------------------------------


def test_target_keys_rename_business_keys(spark):
    log = seed(spark)
    plain, renamed = apply_final(log, orders_spec()), apply_final(log, orders_spec(target_keys={"order_id": "order_no"}))
    assert renamed.columns == ["order_no" if c == "order_id" else c for c in plain.columns]
    assert sorted(map(tuple, renamed.collect())) == sorted(map(tuple, plain.collect()))
    again = apply_final(log.where("operation = 'U'"), orders_spec(target_keys={"order_id": "order_no"}), renamed)
    assert again.columns == renamed.columns and again.count() == renamed.count()
    for names in ({"status": "x"}, {"order_id": "summary_id"}, {"order_id": "status"}):
        with pytest.raises(SpecError):
            orders_spec(target_keys=names)


def test_one_instant_for_a_run(spark):
    from datetime import datetime, timezone

    at = datetime(2026, 5, 4, 3, 2, 1, tzinfo=timezone.utc)
    rows = apply_final(seed(spark), orders_spec(stamped=True, as_of=at)).select(F.unix_micros("synced_at").alias("t")).distinct()
    assert [r.t for r in rows.collect()] == [int(at.timestamp() * 1e6)]
