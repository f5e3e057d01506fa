"""Mergeable coverage states and the trigram search index against plain reports."""
import random

from pyspark.sql import functions as F

from salescope.operators import coverage as CV
from salescope.operators import customers as C
from salescope.operators.search import SearchIndex
from salescope.sources.fact import sales_fact
from paths import SF_SMALL


def plain(fact):
    out = {}
    for dimension, key in [("seller", F.col("seller")), ("region", F.col("region")), ("channel", F.col("channel")),
                           ("month", F.date_format(F.trunc("sale_date", "month"), "yyyy-MM-dd")), ("total", F.lit(""))]:
        for r in fact.where(key.isNotNull()).groupBy(key.alias("v")).agg(
                F.countDistinct("customer_id").alias("n"), F.sum("amount").cast("double").alias("a")).collect():
            out[dimension, r["v"]] = (r["n"], r["a"])
    return out


def got(state):
    return {(r["dimension"], r["value"]): (r["customers"], r["amount"]) for r in CV.coverage(state).collect()}


def written(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def test_states_merge_to_the_whole(spark, tmp_path):
    fact = sales_fact(spark, SF_SMALL).select("customer_id", "seller", "region", "channel", "sale_date", "amount")
    odd = spark.createDataFrame([(None, "s1", None, "C", None, None), (None, None, "R", None, None, None)], fact.schema)
    fact = fact.unionByName(odd.withColumn("amount", F.lit(2).cast(fact.schema["amount"].dataType)))
    numbers = written(CV.number_customers(fact), tmp_path / "numbers")
    assert numbers.select("number").distinct().count() == numbers.count() == fact.select("customer_id").distinct().count() - 1
    parts = [written(CV.coverage_state(fact.where(F.coalesce(F.pmod(F.hash("seller"), F.lit(3)), F.lit(0)) == k), numbers),
                     tmp_path / f"s{k}") for k in range(3)]
    assert got(CV.merge_states(*parts)) == plain(fact) == got(CV.coverage_state(fact, numbers))
    assert got(CV.merge_states(parts[0], parts[1].limit(0))) == got(parts[0])


def test_customers_keep_their_numbers(spark, tmp_path):
    fact = sales_fact(spark, SF_SMALL)
    early = fact.where("sale_date < '1996-01-01'")
    first = written(CV.number_customers(early), tmp_path / "first")
    both = written(CV.number_customers(fact, first), tmp_path / "both")
    assert both.join(first, ["customer_id", "number"]).count() == first.count()
    assert both.select("number").distinct().count() == both.count() == fact.select("customer_id").distinct().count()
    late = CV.coverage_state(fact.where("sale_date >= '1996-01-01'"), both)
    assert got(CV.merge_states(CV.coverage_state(early, first), late)) == got(CV.coverage_state(fact, both))


def test_one_scan_of_the_sales(spark):
    fact = sales_fact(spark, SF_SMALL)
    state = CV.coverage_state(fact, spark.createDataFrame([], "customer_id string, number long"))
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Window" not in plan and "CartesianProduct" not in plan


def test_search_finds_the_same_rows(spark, tmp_path):
    detail = C.customer_detail(sales_fact(spark, SF_SMALL))
    odd = spark.createDataFrame([("%_", "Ação %_ x", None, "É", "s", None), ("999", "", "", "", "", "")],
                                "customer_id string, customer_name string, region string, channel string, seller string, "
                                "top_product string")
    detail = written(detail.unionByName(odd, allowMissingColumns=True), tmp_path / "detail")
    index = SearchIndex(spark, str(tmp_path / "index")).build(detail)
    rows = [r for r in detail.collect()]
    rng = random.Random(1)
    terms = ["", " ", "a", "%_", "ção", "zzzz", "É", "BUILDING", " building "]
    for _ in range(12):
        text = str(rng.choice(rows)[rng.choice(C.SEARCH_COLUMNS)] or "")
        at = rng.randrange(len(text) + 1)
        terms.append(text[at:at + rng.randrange(1, 9)].swapcase())
    for term in terms:
        want = {r["customer_id"] for r in C.customer_search(detail, term).collect()}
        assert {r["customer_id"] for r in index.search(term).collect()} == want, term
    assert any(len(t.strip()) > 3 for t in terms)


def test_search_reads_part_of_the_index(spark, tmp_path):
    detail = C.customer_detail(sales_fact(spark, SF_SMALL))
    index = SearchIndex(spark, str(tmp_path / "index")).build(detail)
    plan = index.search("building")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(gram" in plan.replace("IsNotNull(customer_id), ", "") or "In(gram, [" in plan
