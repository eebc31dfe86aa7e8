from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rowcast.functions import draws
from rowcast.operators import bank, basics, nested, payments
from rowcast.plans.scratch import is_folder, release, scratch_path
from rowcast.sources import datasets, files, synth


def test_csv_by_header_name_with_bad_values(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("city,customer_id,first_name\nP,1,Jan\nQ,x,Ewa\n,3,\n")
    rows = files.read_csv(spark, str(path), "customer_id int, city string").collect()
    assert [tuple(r) for r in rows] == [(1, "P"), (None, "Q"), (3, None)]


def test_headerless_and_gzip(spark, tmp_path):
    table = spark.range(40).selectExpr("id * 1.0D AS label", "id / 7.0D AS a", "id / 3.0D AS b")
    files.write_csv(table.coalesce(1), str(tmp_path / "g"), header=False, compression="gzip")
    back = files.read_numeric_gzip(spark, str(tmp_path / "g"), 2, partitions=4)
    assert back.columns == ["label", "f0", "f1"]
    assert back.rdd.getNumPartitions() == 4
    assert Counter(map(tuple, back.collect())) == Counter(map(tuple, table.collect()))
    plain = tmp_path / "h.csv"
    plain.write_text("1.5,setosa\n2.5,virginica\n")
    rows = files.read_csv_headerless(spark, str(plain), "width double, target string").collect()
    assert [tuple(r) for r in rows] == [(1.5, "setosa"), (2.5, "virginica")]


def test_write_if_absent_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "p")
    files.write_if_absent(spark.range(3), path)
    files.write_if_absent(spark.range(9), path)
    assert files.read_parquet(spark, path).count() == 3
    files.write_parquet(spark.range(5), path)
    assert files.read_parquet(spark, path).count() == 5


def test_lazy_csv_and_text(spark, tmp_path):
    files.write_csv(spark.range(20).selectExpr("id", "id * 2 AS v"), str(tmp_path / "l"))
    table = files.read_csv_lazy(spark, str(tmp_path / "l"), "id bigint, v bigint")
    assert table.agg({"v": "sum"}).first()[0] == 380
    files.write_text(spark.createDataFrame([("a",), ("",), ("ż",)], "value string"), str(tmp_path / "t"))
    assert Counter(r.value for r in files.read_text(spark, str(tmp_path / "t")).collect()) == Counter(
        ["a", "", "ż"]
    )


def test_preview_schema_and_pandas(spark):
    table = files.from_rows(spark, [(1, "a"), (2, None)], "id int, name string")
    assert files.preview(table, 1).count() == 1
    assert [tuple(r) for r in files.schema_table(table).collect()] == [
        (0, "id", "int", True), (1, "name", "string", True),
    ]
    assert files.to_pandas(table).shape == (2, 2)
    with pytest.raises(ValueError):
        files.to_pandas(table, limit=1)


def test_scratch_paths_are_new(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


SAMPLE = [
    (1, 101, "electronics", 299.99), (2, 102, "books", 16.22), (3, 103, "books", 31.0),
    (4, 104, "electronics", 425.0), (5, 105, "clothing", 88.54), (6, 107, "books", 299.99),
]


def test_sample_orders(spark):
    table = files.from_rows(
        spark, SAMPLE, "order_id int, customer_id int, category string, amount double"
    )
    assert [r.order_id for r in basics.above(table, "amount", 100).orderBy("order_id").collect()] == [
        1, 4, 6,
    ]
    means = {r[0]: r[1] for r in basics.group_average(table, "category", "amount").collect()}
    assert means["electronics"] == pytest.approx(362.495)
    assert means["books"] == pytest.approx(115.7366667)
    assert means["clothing"] == pytest.approx(88.54)
    assert basics.group_average(table, "category", "amount").columns == ["category", "avg(amount)"]
    assert basics.average(table, "amount").first()[0] == pytest.approx(193.4566667)
    assert [r.order_id for r in basics.head(table, 2, "order_id").collect()] == [1, 2]


def test_scalar_arithmetic(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(
        basics.widen(F.lit(78), F.lit(7.85)).alias("a"),
        basics.minus_flag(F.lit(78), F.lit(True)).alias("b"),
        basics.times_text(F.lit(9), F.lit("12")).alias("c"),
        basics.times_text(F.lit(9), F.lit("twelve")).alias("d"),
    ).first()
    assert tuple(row) == (85.85, 77, 108, None)


def test_profile(spark):
    table = spark.createDataFrame([(1, "ab", [1.0]), (None, "ż", None)], "i int, s string, v array<double>")
    rows = {r.column_name: tuple(r)[1:] for r in basics.profile(table).collect()}
    assert rows["i"] == (2, 1, 4)
    assert rows["s"] == (2, 2, 4)
    assert rows["v"] == (2, 1, len("[1.0]"))
    sizes = basics.partitions(spark.range(10, numPartitions=2)).first()
    assert tuple(sizes) == (2, 5, 5)


def test_draws_do_not_depend_on_partitions(spark):
    one = synth.transactions(synth.id_range(spark, 500).coalesce(1), 50)
    many = synth.transactions(synth.id_range(spark, 500).repartition(7), 50)
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, many.collect()))


def test_draw_shares(spark):
    """Each digit pair of two streams is about equally likely."""
    from pyspark.sql import functions as F

    pairs = spark.range(200_000).select(
        draws.below("id", 1, 10).alias("a"), draws.below("id", 2, 10).alias("b")
    )
    counts = [r.n for r in pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(counts) == 100 and max(counts) < 2400 and min(counts) > 1600
    moments = spark.range(200_000).select(draws.normal("id", 5, 100.0, 20.0).alias("v")).agg(
        F.avg("v").alias("m"), F.stddev("v").alias("s")
    ).first()
    assert moments.m == pytest.approx(100, abs=0.3) and moments.s == pytest.approx(20, abs=0.3)


def test_generated_ranges(spark):
    ids = synth.id_range(spark, 20_000)
    shares = Counter(r.paid_ratio for r in synth.payments(ids).collect())
    assert shares[0.0] == pytest.approx(2000, rel=0.1)
    assert shares[0.5] == pytest.approx(2000, rel=0.1)
    assert set(shares) == {0.0, 0.5, 1.0}
    low, high = synth.orders(ids, 300).selectExpr("min(order_amount)", "max(order_amount)").first()
    assert 100 <= low < 102 and 1998 < high <= 2000
    low, high = synth.orders(ids, 300).selectExpr("min(customer_id)", "max(customer_id)").first()
    assert (low, high) == (1, 300)
    for row in synth.alerts(ids, 50).limit(200).collect():
        want = "high" if row.risk_score >= 0.8 else "medium" if row.risk_score >= 0.4 else "low"
        assert row.risk_class == want


def test_generated_nested_orders(spark):
    table = synth.nested_orders(synth.id_range(spark, 5000))
    sizes = Counter(len(r["items"]) for r in table.collect())
    assert set(sizes) == {0, 1, 2, 3, 4, 5}
    assert sizes[0] == pytest.approx(250, rel=0.3)
    bounds = {name: (low, high) for name, low, high in synth.PRODUCTS}
    seen = Counter()
    for row in nested.items(table).collect():
        low, high = bounds[row["product"]]
        assert low <= row.price <= high and 1 <= row.qty <= 5
        seen[row["product"], row.qty] += 1
    assert len(seen) == 40 and min(seen.values()) > 0.6 * max(seen.values())


def test_scratch_folder_is_marked_for_removal(spark):
    import os

    path = scratch_path(spark, "gone")
    parent = os.path.dirname(path.removeprefix("file:"))
    assert os.path.isdir(parent) and not os.path.exists(path.removeprefix("file:"))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.none() | st.text(st.sampled_from("\n\r\x1b\"'\\ ,ne0a\té\x00"), max_size=12), st.none() | st.integers(-9, 9)), max_size=12))
def test_csv_returns_any_text(spark, rows):
    path = scratch_path(spark, "texts")
    numbered = [(i, *row) for i, row in enumerate(rows)]
    frame = spark.createDataFrame(numbered, "i int, t string, n int").coalesce(1)
    files.write_csv(frame, path)
    for reader in (files.read_csv, files.read_csv_lazy):
        assert sorted(map(tuple, reader(spark, path, "i int, t string, n int").collect())) == numbered
    files.write_csv(frame, path, header=False)
    assert sorted(map(tuple, files.read_csv_headerless(spark, path, "i int, t string, n int").collect())) == numbered


def test_csv_files_of_other_column_order_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,Jan\n")
    (tmp_path / "b.csv").write_text("name,id\nEwa,2\n")
    for reader in (files.read_csv, files.read_csv_lazy):
        with pytest.raises(Exception, match="header"):
            reader(spark, str(tmp_path), "id int, name string").collect()


def test_scratch_folders(spark, tmp_path):
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert is_folder(spark, path) and release(spark, path)
    with pytest.raises(FileNotFoundError):
        is_folder(spark, path)
    with pytest.raises(ValueError):
        release(spark, str(tmp_path))


def test_data_sets_are_written_once(spark, tmp_path):
    paths = datasets.write_payment_sources(spark, str(tmp_path / "p"), customers=20, orders=50)
    orders, customers, paid = payments.read_sources(spark, paths["customers"], paths["orders"], paths["payments"])
    assert payments.totals(orders, paid).first().orders_count == 50 and customers.count() == 20
    again = datasets.write_payment_sources(spark, str(tmp_path / "p"), customers=30, orders=70)
    assert again == paths and spark.read.parquet(paths["orders"]).count() == 50
    paths = datasets.write_bank_sources(spark, str(tmp_path / "b"), 20, 60, 10)
    people, moves, alerts = bank.read_sources(spark, paths["customers"], paths["transactions"], paths["alerts"])
    assert (people.count(), moves.count(), alerts.count()) == (20, 60, 10)
    assert alerts.filter("created_at IS NULL OR risk_class IS NULL").count() == 0


def test_draws_do_not_repeat_above_the_modulus(spark):
    starts = [0, 2**31 - 1, 2 * (2**31 - 1), 2**40]
    seen = [
        [r[0] for r in spark.range(start, start + 20).orderBy("id").select(draws.draw("id", 3)).collect()]
        for start in starts
    ]
    assert all(0 <= value < draws.PRIME for part in seen for value in part)
    assert len({tuple(part) for part in seen}) == len(starts)
