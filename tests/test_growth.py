"""Steps whose cost grew faster than their input: file names of rows, column profiles, the forest's tasks, task sizes."""
import contextlib
import io
import statistics

import pytest
from pyspark.sql import functions as F

from salescope import session as SS
from salescope.operators import profile as P
from salescope.sources.raw import scan_layouts


def _plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_the_files_name_is_cut_out_without_a_pattern(spark, tmp_path):
    names = ["plain.csv", "a b+c%2B.csv", "é.csv", "part-1.csv"]
    for name in names:
        (tmp_path / name).write_text("x,y\n1,2\n")
    spark.range(4).selectExpr("id x", "id y").write.option("header", True).csv(str(tmp_path / "written.csv"))
    layouts, errors = scan_layouts(spark, str(tmp_path))
    assert not errors and len(layouts) == 1
    rows = layouts[0].frame
    found = {r["source_file"]: r["n"] for r in rows.groupBy("source_file").agg(F.count("*").alias("n")).collect()}
    assert found == {**dict.fromkeys(names, 1), "written.csv": 4}
    assert "regexp_extract" not in _plan(rows)


def test_profile_reads_the_cells_once_and_keeps_the_digits(spark):
    big = [10_000_000_000_000 + 7 * k for k in range(50)]
    values = ([("f", "id", str(x)) for x in big * 3] + [("f", "money", f"{k % 7}.25") for k in range(40)]
              + [("f", "mixed", x) for x in ["1", "1", None, "x", "2024-01-31", "2024-01-31", "44000", "SP", " sp "]]
              + [("f", "one", "5"), ("f", "none", None), ("f", "text", "abc")])
    cells = spark.createDataFrame(values, "source_file string, column string, value string")
    profile = P.cell_profile(cells)
    assert _plan(profile.where("true")).count("Scan ExistingRDD") <= 2      # once in the tree, once in the details
    rows = {r["column"]: r for r in profile.collect()}
    assert rows["id"]["num_std"] == pytest.approx(statistics.stdev(big * 3), rel=1e-6)
    assert rows["id"]["num_mean"] == pytest.approx(statistics.mean(big), rel=1e-9)
    assert rows["money"]["num_std"] == pytest.approx(statistics.stdev([k % 7 + 0.25 for k in range(40)]), abs=1e-6)
    mixed = rows["mixed"]
    assert (mixed["pct_num"], mixed["pct_date"], mixed["pct_uf"], mixed["distinct_ratio"]) == (0.375, 0.25, 0.25, 0.75)
    assert mixed["mean_len"] == pytest.approx((1 + 1 + 1 + 10 + 10 + 5 + 2 + 4) / 8)
    assert mixed["num_std"] == pytest.approx(statistics.stdev([1, 1, 44000]), abs=1e-5)
    assert (rows["one"]["num_std"], rows["one"]["num_mean"], rows["one"]["distinct_ratio"]) == (0.0, 5.0, 1.0)
    assert (rows["none"]["mean_len"], rows["none"]["distinct_ratio"], rows["none"]["num_max"]) == (0.0, 0.0, 0.0)
    assert (rows["text"]["mean_len"], rows["text"]["pct_num"]) == (3.0, 0.0)


def test_the_forest_does_not_depend_on_the_sessions_partitions(spark):
    rows = [(f"f{i % 3}", f"c{i}", float(i % 2), *[float((i * 7 + k) % 5) for k in range(len(P.FEATURES))])
            for i in range(24)]
    train = spark.createDataFrame(rows, ["source_file", "column", "label", *P.FEATURES])
    before, trees = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for partitions in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            trees.append(P.train_classifier(train.repartition(int(partitions)), num_trees=4)[0].toDebugString.split("\n", 1)[1])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert trees[0] == trees[1]


def test_task_sizes_are_set(spark):
    SS.prepare(spark)
    assert {k: spark.conf.get(k) for k in SS.TASK_SIZES} == SS.TASK_SIZES
    assert int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b")) <= 32 << 20


def test_a_coverage_state_is_as_large_as_its_pairs(spark):
    import datetime as dt
    from decimal import Decimal

    from salescope.operators import coverage as CV
    rows = [(f"c{k % 400}" if k % 50 else None, f"s{k % 300}", "N", "X", dt.date(2024, 1 + k % 2, 1), Decimal(k))
            for k in range(2000)]
    fact = spark.createDataFrame(rows, "customer_id string, seller string, region string, channel string, "
                                       "sale_date date, amount decimal(18,2)")
    numbers = spark.createDataFrame([(f"c{k}", 1 + k * 700) for k in range(400)], "customer_id string, number long")
    halves = [CV.coverage_state(fact.where(F.col("sale_date") < "2024-02-01"), numbers),
              CV.coverage_state(fact.where(F.col("sale_date") >= "2024-02-01"), numbers)]
    assert max(r["n"] for h in halves for r in h.select(F.length("customers").alias("n")).collect()) <= 32
    found = {(r["dimension"], r["value"]): (r["customers"], r["amount"])
             for r in CV.coverage(CV.merge_states(*halves)).collect()}
    for dimension, column in (("seller", 1), ("region", 2), ("total", None)):
        for value in {"" if column is None else r[column] for r in rows}:
            own = [r for r in rows if column is None or r[column] == value]
            assert found[dimension, value] == (len({r[0] for r in own if r[0]}), float(sum(r[5] for r in own)))
