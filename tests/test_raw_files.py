"""Supplier CSV files as spreadsheets export them: quoting, separators, rows that do not fit, many files."""
import os

import pytest
from pyspark.sql import functions as F

from salescope.sources import raw as R


def folder_of(tmp_path, **files):
    for name, text in files.items():
        data = text if isinstance(text, bytes) else text.encode()
        (tmp_path / f"{name}.csv").write_bytes(data)
    return str(tmp_path)


def rows_of(layout):
    return sorted(tuple(r) for r in layout.frame.select(*[f"`{c}`" for c in layout.headers]).collect())


def test_cells_as_spreadsheets_write_them(spark, tmp_path):
    path = folder_of(tmp_path, a='nome,qtd,valor\r\n"Tubo 1/2"", aco",10,2\r\n"duas\r\nlinhas",1,3\r\nTubo 3" x,4,5\r\n,,\r\n"",6,7\r\n')
    (layout,), errors = R.scan_layouts(spark, path)
    assert errors == [] and layout.headers == ("nome", "qtd", "valor")
    got = [tuple(r) for r in layout.frame.orderBy("_row_no").select("nome", "qtd", "valor").collect()]
    assert [(x[0] or "").replace("\r\n", "\n") for x in got] == ['Tubo 1/2", aco', "duas\nlinhas", 'Tubo 3" x', "", ""]
    assert [x[1:] for x in got] == [("10", "2"), ("1", "3"), ("4", "5"), (None, None), ("6", "7")]
    assert layout.rejected.count() == 0


def test_rows_that_do_not_fit_are_told_with_their_lines(spark, tmp_path):
    path = folder_of(tmp_path, a="x,y\n1,2\n3\n4,5,6\n7,8\n", b='x,y\n1,"open\n2,3\n', c="k;v\na;1.234,5\nb;-0,25\nc;1,2,3\nd;x;y\ne;12\n")
    layouts, errors = R.scan_layouts(spark, path)
    assert errors == [] and {x.separator for x in layouts} == {",", ";"}
    comma, semi = sorted(layouts, key=lambda x: x.separator)
    assert rows_of(comma) == [("1", "2"), ("7", "8")] and comma.files == ["a.csv", "b.csv"]
    assert rows_of(semi) == [("a", "1234.5"), ("b", "-0.25"), ("c", "1,2,3"), ("e", "12")]
    bad = {(r["source_file"], r["line"].strip(), r["reason"]) for r in R.rejected_rows(spark, layouts).collect()}
    assert {x for x in bad if x[0] != "b.csv"} == {
        ("a.csv", "3", "fewer cells than the header: 1 of 2"), ("a.csv", "4,5,6", "more cells than the header: 3 of 2"),
        ("c.csv", "d;x;y", "more cells than the header: 3 of 2")}
    assert len(bad) == 4 and ("b.csv", "1,open\n2,3") in {x[:2] for x in bad}
    # every line is either kept or rejected, whatever columns a query reads
    assert comma.frame.count() + comma.rejected.where("source_file = 'a.csv'").count() == 4
    assert comma.frame.select("x").collect() == comma.frame.select(F.col("x")).collect()
    assert comma.frame.select(F.sum(F.col("y").cast("int"))).first()[0] == 10
    assert comma.frame.select("source_file").distinct().count() == 1


def test_headers(spark, tmp_path):
    path = folder_of(tmp_path, bom=b"\xef\xbb\xbfa,b\n1,2\n", plain="a,b\n3,4\n", tab="a\tb\n5\t6\n", twice="a,A,\n1,2,3\n",
                     one="alone\n1\n", empty="", blank="\n1,2\n", only="p,q\n", odd='"x,1\n2,3\n', quoted='"n;1",v\n"a",2\n')
    layouts, errors = R.scan_layouts(spark, path)
    by = {(x.separator, x.headers): x for x in layouts}
    assert by[",", ("a", "b")].files == ["bom.csv", "plain.csv"] and rows_of(by[",", ("a", "b")]) == [("1", "2"), ("3", "4")]
    assert rows_of(by["\t", ("a", "b")]) == [("5", "6")] and rows_of(by[",", ("a", "A_1", "_c2")]) == [("1", "2", "3")]
    assert rows_of(by[",", ("p", "q")]) == [] and rows_of(by[",", ("n;1", "v")]) == [("a", "2")]
    told = dict(errors)
    assert rows_of(by[",", ("alone",)]) == [("1",)] and told["empty.csv"] == "empty file: no header line"
    assert told["blank.csv"] == "empty header line" and told["odd.csv"].startswith("unreadable header")
    assert len(layouts) == 6 and len(errors) == 3


def test_names_that_look_like_patterns(spark, tmp_path):
    path = folder_of(tmp_path, **{"a [1] {x}": "k,v\n1,2\n", "b +%20é": "k,v\n3,4\n"})
    (layout,), errors = R.scan_layouts(spark, path)
    assert errors == [] and layout.files == ["a [1] {x}.csv", "b +%20é.csv"]
    assert sorted(tuple(r) for r in layout.frame.select("source_file", "k").collect()) == [
        ("a [1] {x}.csv", "1"), ("b +%20é.csv", "3")]


def test_missing_folder_and_no_files(spark, tmp_path):
    assert R.scan_layouts(spark, str(tmp_path / "none")) == ([], [])
    assert R.rejected_rows(spark, []).collect() == []
    with pytest.raises(ValueError):
        R.read_raw(spark, folder_of(tmp_path, a="\n1\n") + "/a.csv")


def test_jobs_do_not_grow_with_the_files(spark, tmp_path):
    """2,000 files of three layouts: as many jobs as for three files, and as many reads as layouts."""
    tracker = spark.sparkContext.statusTracker()

    def scan(folder, n):
        os.makedirs(folder)
        for k in range(n):
            head = ["a,b", "a,b,c", "c;d"][k % 3]
            with open(f"{folder}/f{k:05d}.csv", "w") as f:
                f.write(f"{head}\n{head.replace('a', str(k)).replace('c', str(k))}\n")
        name = f"scan-{n}"
        spark.sparkContext.setJobGroup(name, name)
        try:
            layouts, errors = R.scan_layouts(spark, str(folder))
        finally:
            spark.sparkContext._jsc.clearJobGroup()
        assert errors == [] and sum(len(x.files) for x in layouts) == n
        return layouts, len(tracker.getJobIdsForGroup(name))

    few, jobs_of_few = scan(tmp_path / "few", 3)
    many, jobs_of_many = scan(tmp_path / "many", 2000)
    assert len(few) == len(many) == 3
    assert jobs_of_many <= jobs_of_few + 4                # listing jobs of a long list of paths, once a read
    assert sum(x.frame.count() for x in many) == 2000


def test_stream_keeps_what_does_not_fit(spark, tmp_path):
    from salescope.streaming.landing import start_landing_stream
    headers = {"customer_id": "id", "sale_date": "data", "product_name": "produto", "amount": "valor", "quantity": "qtd"}
    landing = tmp_path / "in"
    landing.mkdir()
    folder_of(landing, a='id,data,produto,valor,qtd\n1,2024-01-02,"a ""b"",\nc",5,1\n2,2024-01-02,x\n3,2024-01-03,y,6,1\n')
    start_landing_stream(spark, str(landing), headers, "S", str(tmp_path / "std"), str(tmp_path / "log"),
                         str(tmp_path / "bad")).awaitTermination()
    assert sorted(r["product_name"] for r in spark.read.parquet(str(tmp_path / "std")).collect()) == ['a "b",\nc', "y"]
    assert [(r["line"].strip(), r["reason"]) for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == [
        ("2,2024-01-02,x", "fewer cells than the header: 3 of 5")]


def test_stream_parses_files_once_where_all_rows_fit(spark, tmp_path):
    from salescope.streaming.landing import start_landing_stream
    headers = {"customer_id": "id", "sale_date": "data", "product_name": "produto", "amount": "valor", "quantity": "qtd"}
    landing = tmp_path / "in"
    landing.mkdir()
    folder_of(landing, a="id,data,produto,valor,qtd\n1,2024-01-02,x,5,1\n2,2024-01-03,y,6,1\n3,2024-01-04,z,7,1\n")
    q = start_landing_stream(spark, str(landing), headers, "S", str(tmp_path / "std"), str(tmp_path / "log"),
                             str(tmp_path / "bad"))
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 3
    assert spark.read.parquet(str(tmp_path / "std")).count() == 3
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert bad.count() == 0 and {"source_file", "line", "reason"} <= set(bad.columns)


def test_stream_writes_no_second_copy_of_the_supplier_files(spark, tmp_path):
    """The files become CSV as they are built; a landing file that another query had written is read."""
    from salescope import session as SS
    from salescope.sources import fixtures as FX
    from salescope.sources.materialize import written
    from salescope.streaming.landing import stream_supplier_files
    SS.prepare(spark)
    tables = {"nation": "1 n_nationkey, 'Acre' n_name", "part": "7 p_partkey, 'soro' p_name, 'grande' p_type",
              "customer": "5 c_custkey, 'Loja' c_name, 1 c_nationkey, 'FARMA' c_mktsegment",
              "orders": "explode(array(1, 2, 3)) o_orderkey, 5 o_custkey",
              "lineitem": "explode(array(1, 2, 3)) l_orderkey, 7 l_partkey, 1 l_linenumber, 2.0D l_quantity, "
                          "10.5D l_extendedprice, timestamp_ntz'2024-01-02 00:00:00' l_shipdate",
              "events": "1 event_id, timestamp_ntz'2024-01-03 04:05:06' ts, 9 user_id, 'view' event_type, 3.0D value, 'p' props"}
    for name, columns in tables.items():
        spark.sql(f"select {columns}").write.parquet(str(tmp_path / f"{name}.parquet"))
    fact = stream_supplier_files(spark, str(tmp_path)).drop("source_file")
    files = ("source_a.csv", "source_b.csv", "source_c.csv")
    assert [written(spark, f"landing-{name}", str(tmp_path)) for name in files] == [None] * 3
    # one day, code, amount and quantity: A's copy stays, with its own name
    assert sorted((r["seller"], str(r["sale_date"]), r["product_name"], r["product_canon"]) for r in fact.collect()) == [
        ("Distribuidor A", "2024-01-02", "soro", "soro"), ("Distribuidor C", "2024-01-03", "event view", "event view")]
    once = FX.landing_file(spark, str(tmp_path), "source_a.csv")
    again = FX.supplier_file(spark, str(tmp_path), "source_a.csv")
    assert again.inputFiles() and again.inputFiles() == once.inputFiles()


def test_staged_names_come_from_the_copies_that_are_kept(spark, tmp_path):
    """The names' side reads only the columns it needs, and the wide rows are not sorted for the join."""
    from salescope.streaming.landing import consolidate_staging
    rows = [("b", 0, "1", "2024-01-01", "7", "a much longer name, but a copy", "5"), ("a", 0, "1", "2024-01-01", "7", "short", "5"),
            ("b", 1, "2", "2024-01-01", "7", "longest", "5"), ("b", 2, "3", "2024-01-01", "8", None, "5"),
            ("b", 3, "4", None, "7", "a name on a row without a date", "5"), ("b", 4, "4", "2024-01-01", "7", "a name at no price", "0")]
    spark.createDataFrame(rows, "p string, n long, id string, day string, code string, name string, price string").selectExpr(
        "id customer_name", "id customer_id", "'AC' region", "cast(day as timestamp_ntz) sale_date", "code product_code",
        "name product_name", "cast(price as decimal(38,6)) amount", "1L quantity", "'X' channel", "'S' seller",
        "p source_file", "n _row_no", "p _file_path").write.parquet(str(tmp_path / "std"))
    fact = consolidate_staging(spark, str(tmp_path / "std"))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted((r["customer_id"], r["source_file"], r["product_name"], r["product_canon"]) for r in fact.collect()) == [
        ("1", "a", "short", "longest"), ("2", "b", "longest", "longest"), ("3", "b", None, None)]


def test_log_of_inferred_files(spark, tmp_path):
    """Status, rows, rejected rows, mapping and confidences per file; a file without required fields is an error."""
    import json
    from salescope import schema as S
    from salescope.plans.consolidate import inferred_log
    layouts, _ = R.scan_layouts(spark, folder_of(tmp_path, a="x,y\n1,2\n3\n", b="k,v,w\n1,2,3\n"))
    rows = layouts[0].frame.select("source_file").unionByName(layouts[1].frame.select("source_file"))
    files = spark.createDataFrame([("a.csv",), ("b.csv",), ("c.csv",)], "source_file string")
    mapping = spark.createDataFrame([("a.csv", f, f"h {f}", 0.5) for f in reversed(S.REQUIRED_FIELDS)]
                                    + [("b.csv", "channel", "w", 0.25)],
                                    "source_file string, field string, column string, confidence double")
    got = {r["source_file"]: r for r in inferred_log(files, mapping, rows, R.rejected_rows(spark, layouts)).collect()}
    assert [(got[f]["status"], got[f]["rows"], got[f]["rejected"]) for f in ("a.csv", "b.csv", "c.csv")] == [
        ("ok", 1, 1), ("error", 1, 0), ("error", 0, 0)]
    assert list(json.loads(got["a.csv"]["mapping"])) == [f for f in S.FIELDS if f in S.REQUIRED_FIELDS]
    assert json.loads(got["b.csv"]["confidences"]) == {"channel": 0.25} and got["c.csv"]["mapping"] == "{}"
    assert got["c.csv"]["error"] == "required fields not found: " + ", ".join(S.REQUIRED_FIELDS)
