"""Spark ML reports (invariants) and sources / sinks / streaming round trips."""
from __future__ import annotations

import json
import os
import shutil
import tempfile

from pyspark.sql import functions as F

from salescope import schema as S
from salescope.operators import ingest
from salescope.operators import segments as SG
from salescope.plans.consolidate import Ingest, empty_fact
from salescope.plans.publish import publish
from salescope.plans.schema_inference import RENAMED_FILE, SchemaInference
from salescope.sources import fixtures as FX
from salescope.sources.fact import sales_fact
from salescope.sources.raw import scan_landing
from salescope.streaming.landing import consolidate_staging, start_landing_stream

from paths import SF_SMALL


def test_segments_invariants(spark):
    fact = sales_fact(spark, SF_SMALL)
    seg = SG.rfm_segments(fact, n_init=3).collect()
    customers = fact.select("customer_id").distinct().count()
    assert sum(r.customers for r in seg) == customers
    means = [r.mean_monetary for r in seg]
    assert means == sorted(means, reverse=True)
    assert [r.label for r in seg] == S.SEGMENT_LABELS[:len(seg)]


def test_mapping_generalises_to_unseen_headers(spark):
    si = SchemaInference(spark, SF_SMALL)
    acc = {r.source_file: r for r in si.accuracy().collect()}
    assert acc["source_a.csv"].accuracy >= 0.8
    assert acc[RENAMED_FILE].correct >= 7                  # unseen, reordered headers
    report = si.report().where(F.col("source_file") == "source_c.csv").collect()
    assert len(report) == len(S.FIELDS)
    assert {r.column for r in report if r.field == "channel"} == {"not detected"}


def _write_csv_files(spark, folder):
    """The supplier files as single CSV files (one Spark part file copied per file)."""
    scratch = tempfile.mkdtemp(prefix="csv-parts-")
    for name, _, _, raw in FX.raw_sources(spark, SF_SMALL)[:3]:
        out = os.path.join(scratch, name)
        (raw.orderBy("_row_no").drop("_row_no").coalesce(1).write.option("header", True)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(out))
        part = [f for f in os.listdir(out) if f.endswith(".csv")][0]
        shutil.copyfile(os.path.join(out, part), os.path.join(folder, name))


def test_csv_landing_round_trip(spark):
    folder = tempfile.mkdtemp(prefix="landing-")
    _write_csv_files(spark, folder)
    with open(os.path.join(folder, "planilha.xlsx"), "wb") as f:   # not a readable format
        f.write(b"PK\x03\x04")
    files = scan_landing(spark, folder)
    assert [n for n, _ in files] == ["source_a.csv", "source_b.csv", "source_c.csv"]
    known = {n: (s, h) for n, s, h in FX.SOURCES}
    from_files = [(n, known[n][0], known[n][1], df) for n, df in files]
    csv_fact = Ingest(spark, sources=from_files).fact()
    mem_fact = Ingest(spark, SF_SMALL).fact()
    cols = ["customer_id", "sale_date", "product_code", "amount", "quantity", "source_file"]
    assert csv_fact.count() == mem_fact.count()
    assert csv_fact.select(cols).exceptAll(mem_fact.select(cols)).count() == 0


def test_streaming_landing_ingests_each_file_once(spark):
    base = tempfile.mkdtemp(prefix="stream-")
    landing = os.path.join(base, "landing")
    os.makedirs(landing)
    _, _, headers, raw = FX.raw_sources(spark, SF_SMALL)[0]
    (raw.drop("_row_no").coalesce(1).write.option("header", True)
        .option("ignoreTrailingWhiteSpace", False).csv(os.path.join(landing, "up1")))
    staging, ckpt = os.path.join(base, "staging"), os.path.join(base, "ckpt")
    for _ in range(2):                                   # a rerun finds nothing new
        q = start_landing_stream(spark, os.path.join(landing, "*"), headers, "Distribuidor A",
                                 staging, ckpt)
        q.awaitTermination(120)
    staged = spark.read.parquet(staging)
    assert staged.count() == raw.count()
    fact = consolidate_staging(spark, staging)
    assert fact.columns == S.FACT_COLUMNS
    expected = ingest.consolidate([ingest.standardize(raw, headers, "Distribuidor A", "x")])
    assert fact.count() == expected.count()


def test_publish_and_empty_state(spark):
    out = tempfile.mkdtemp(prefix="reports-")
    fact = sales_fact(spark, SF_SMALL)
    written = publish(spark, fact, out, stock=FX.stock_table(spark, SF_SMALL))
    assert {"kpis", "by_seller", "customers", "stock", "meta"} <= set(written)
    k = spark.read.json(written["kpis"]).collect()[0]
    assert k.transactions == fact.count()
    # the stock list shows the top rows by value, the summary counts every SKU
    stock_rows = spark.read.json(written["stock"])
    skus = FX.stock_table(spark, SF_SMALL).select("product_code").union(
        fact.select("product_code")).distinct().count()
    assert stock_rows.count() == min(S.STOCK_LIST_ROWS, skus)
    assert spark.read.json(written["stock_summary"]).collect()[0].skus == skus
    daily = spark.read.json(written["daily_sales"]).collect()
    assert len(daily[0].period) == 10                    # yyyy-MM-dd text
    empty_out = tempfile.mkdtemp(prefix="empty-")
    w2 = publish(spark, empty_fact(spark), empty_out)
    assert set(w2) == {"meta"}
    meta = [json.loads(line) for f in os.listdir(w2["meta"]) if f.endswith(".json")
            for line in open(os.path.join(w2["meta"], f))]
    assert meta[0]["empty"] is True


def test_read_raw_strips_byte_order_mark(spark):
    from salescope.sources.raw import read_raw
    folder = tempfile.mkdtemp(prefix="bom-")
    path = os.path.join(folder, "with_bom.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("CNPJ,Produto,UN \n12.345,Soro ½,3\n")
    df = read_raw(spark, path)
    assert df.columns[:3] == ["CNPJ", "Produto", "UN "]
    row = df.collect()[0]
    assert row["CNPJ"] == "12.345" and row["Produto"] == "Soro ½" and row["source_file"] == "with_bom.csv"


def test_user_flow_on_a_landing_folder(spark):
    """The README example: scan a folder, infer mappings, consolidate, write, publish."""
    from salescope.plans.consolidate import auto_seller
    from salescope.plans.publish import publish
    from salescope.plans.schema_inference import infer_mappings
    from salescope.sources.fact import read_fact, write_fact
    folder = tempfile.mkdtemp(prefix="landing-")
    _write_csv_files(spark, folder)
    out = tempfile.mkdtemp(prefix="out-")

    files = scan_landing(spark, folder)
    model = SchemaInference(spark, SF_SMALL).trained()[0]
    mappings = infer_mappings(spark, model, files)
    ig = Ingest(spark, sources=[(n, auto_seller(n), mappings.get(n, {}), df) for n, df in files])
    write_fact(ig.fact(), out + "/fact")
    written = publish(spark, read_fact(spark, out + "/fact"), out + "/reports")

    known = {n: h for n, _, h in FX.SOURCES}
    assert all(mappings[n] == known[n] for n, _ in files)
    fact = read_fact(spark, out + "/fact")
    assert fact.count() == Ingest(spark, SF_SMALL).fact().count()
    assert {r.seller for r in fact.select("seller").distinct().collect()} == \
        {"Auto · source_a", "Auto · source_b", "Auto · source_c"}
    assert "by_seller" in written


def test_changed_inputs_are_read_again(spark):
    """A written-once table follows the listing of its input folder."""
    from salescope.sources.materialize import materialized
    folder = tempfile.mkdtemp(prefix="inputs-")
    spark.range(3).write.parquet(os.path.join(folder, "t.parquet"))

    def count():
        return materialized(spark, "copy", folder, lambda: spark.read.parquet(os.path.join(folder, "t.parquet"))).count()

    assert count() == 3 and count() == 3
    spark.range(5).write.parquet(os.path.join(folder, "u.parquet"))
    spark.range(4).write.mode("append").parquet(os.path.join(folder, "t.parquet"))
    assert count() == 7


def test_layouts_are_read_once(spark):
    """As many scans as header layouts, whatever the number of files; bad files are reported."""
    from salescope.sources.raw import scan_layouts
    folder = tempfile.mkdtemp(prefix="layouts-")
    for k in range(6):
        with open(os.path.join(folder, f"f{k}.csv"), "w") as f:
            f.write(("a,b\n1,2\n3,4\n" if k % 2 else "c\nx\n"))
    open(os.path.join(folder, "empty.csv"), "w").close()
    layouts, errors = scan_layouts(spark, folder)
    assert sorted((layout.headers, len(layout.files)) for layout in layouts) == [(("a", "b"), 3), (("c",), 3)]
    assert [name for name, _ in errors] == ["empty.csv"]
    for layout in layouts:
        plan = layout.frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan csv") == 1
        rows = layout.frame.groupBy("source_file").count().collect()
        assert sorted(r.source_file for r in rows) == layout.files
        assert {r["count"] for r in rows} == {len(layout.headers) if "a" in layout.headers else 1}
