"""One-to-one column assignment, stratified folds, aligned columns, mappings per layout."""
import itertools
import random

from pyspark.sql import functions as F

from salescope import schema as S
from salescope.operators import profile as P
from salescope.plans.schema_inference import SchemaInference, infer_layout_mappings
from salescope.sources import fixtures as FX
from salescope.sources.raw import scan_layouts
from paths import SF_SMALL


def best_assignment(scores, threshold):
    """All one-to-one assignments of a few fields and columns, tried one by one."""
    columns = sorted({c for c, _ in scores})
    fields = sorted({f for _, f in scores}, key=S.FIELDS.index)
    places = [*range(len(columns)), *[None] * len(fields)]
    best = max(set(itertools.permutations(places, len(fields))),
               key=lambda picks: (sum(round(scores.get((columns[c], f), 0) * P.SCORE_UNIT)
                                      for f, c in zip(fields, picks) if c is not None)))
    total = sum(round(scores.get((columns[c], f), 0) * P.SCORE_UNIT) for f, c in zip(fields, best) if c is not None)
    return total


def total_of(rows, scores):
    return sum(round(scores[r["column"], r["field"]] * P.SCORE_UNIT) for r in rows)


def test_assignment_is_the_best_of_all(spark):
    rng = random.Random(4)
    rows, by_file = [], {}
    for file in range(40):
        columns, fields = rng.randrange(1, 5), rng.sample(S.FIELDS, rng.randrange(1, 5))
        scores = {(f"c{c}", f): rng.choice([0.0, 0.1, 0.3, 0.3, 0.5, 0.9]) for c in range(columns) for f in fields}
        by_file[f"f{file}"] = scores
        rows += [(f"f{file}", c, f, s) for (c, f), s in scores.items()]
    df = spark.createDataFrame(rows, "source_file string, column string, field string, confidence double").repartition(5)
    got = {}
    for r in P.assign_fields(df, threshold=0.0001).collect():
        got.setdefault(r["source_file"], []).append(r)
    for file, scores in by_file.items():
        picked = got.get(file, [])
        assert len({r["column"] for r in picked}) == len({r["field"] for r in picked}) == len(picked)
        assert total_of(picked, scores) == best_assignment(scores, 0)
    again = {tuple(r) for r in P.assign_fields(df.repartition(1), threshold=0.0001).collect()}
    assert again == {tuple(r) for rows in got.values() for r in rows}          # ties do not depend on the partitioning


def test_a_field_gets_its_second_column_when_another_needs_the_first(spark):
    rows = [("f", "a", "amount", 0.9), ("f", "a", "quantity", 0.8), ("f", "b", "amount", 0.6), ("f", "b", "quantity", 0.1),
            ("g", "x", "region", 0.19), ("g", "y", "channel", 0.2)]
    df = spark.createDataFrame(rows, "source_file string, column string, field string, confidence double")
    assert {tuple(r)[:3] for r in P.assign_fields(df).collect()} == {
        ("f", "quantity", "a"), ("f", "amount", "b"), ("g", "channel", "y")}
    assert P.assign_fields(df.limit(0)).collect() == []


def test_every_label_is_in_every_fold(spark):
    rows = [(f"f{k}", f"c{j}", float(j)) for j, n in enumerate([3, 4, 7, 30, 2]) for k in range(n)]
    df = spark.createDataFrame(rows, "source_file string, column string, label double")
    folds = P.stratified_folds(df)
    got = {}
    for r in folds.groupBy("label", "fold").count().collect():
        got.setdefault(r["label"], []).append(r["count"])
    assert all(len(got[float(j)]) == 3 for j in range(4)) and all(max(v) - min(v) <= 1 for v in got.values())
    assert folds.exceptAll(P.stratified_folds(df.repartition(7))).count() == 0


def test_aligned_columns(spark):
    df = spark.createDataFrame([("f", "c", 1, None, 9.0)], "source_file string, column string, a int, b double, z double")
    aligned = P.align_columns(df, ["b", "a", "x"])
    assert aligned.columns == ["source_file", "column", "b", "a", "x"] and tuple(aligned.first()) == ("f", "c", 0.0, 1.0, 0.0)


def test_mappings_per_layout_equal_mappings_per_file(spark, tmp_path):
    """Files of one layout are profiled in one branch; the plan does not grow with them."""
    for name, _, headers in FX.SOURCES[:2]:
        raw = FX.landing_file(spark, SF_SMALL, name).drop("_row_no").repartition(3)
        raw.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False).csv(str(tmp_path / name))
    layouts, errors = scan_layouts(spark, str(tmp_path))
    assert errors == [] and len(layouts) == 2
    model = SchemaInference(spark, SF_SMALL).trained()[0]
    found = infer_layout_mappings(spark, model, layouts)
    assert found == {name: dict(headers) for name, _, headers in FX.SOURCES[:2]}
    cells = P.layout_values([x.frame for x in layouts])
    assert cells._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2


def test_rules_map_without_training(spark):
    si = SchemaInference(spark, SF_SMALL)
    accuracy = {r["source_file"]: r["accuracy"] for r in si.rule_accuracy().collect()}
    assert accuracy["source_a.csv"] >= 0.7 and accuracy["source_c.csv"] >= 0.8
    assert si.rule_report().where(F.col("band").isNull() != (F.col("column") == "not detected")).count() == 0
