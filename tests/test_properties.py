"""Property tests: Spark expressions against small Python models of the same
rules, on generated inputs (each example is one batch, one Spark job)."""
from __future__ import annotations

import datetime as dt
import re
import unicodedata

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from salescope.functions import expressions as E

SETTINGS = settings(max_examples=15, deadline=None)


def spark_map(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", expr(F.col("v"))).orderBy("i").collect()]


def model_id(v: str) -> str:
    d = re.sub(r"[^0-9]", "", v)
    return d.zfill(14)


def model_synthetic(v: str) -> str:
    """NFKD, ASCII part, runs of anything else to one underscore."""
    plain = unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode("ascii")
    return "SYN_" + re.sub(r"[^A-Za-z0-9]+", "_", plain).strip("_").upper()[:24]


ids = st.text(alphabet="0123456789.-/ ()", max_size=22)
# letters of all planes; those with a decomposition are drawn more often
names = st.text(alphabet=st.one_of(
    st.characters(min_codepoint=32, max_codepoint=0x24F, blacklist_categories=("Cs", "Cc")),
    st.characters(min_codepoint=0x2000, max_codepoint=0x218F, blacklist_categories=("Cs", "Cc")),
    st.characters(min_codepoint=0x3000, max_codepoint=0xFFEF, blacklist_categories=("Cs", "Cc")),
    st.characters(min_codepoint=0x1D400, max_codepoint=0x1F1FF, blacklist_categories=("Cs", "Cc")),
    st.sampled_from("ﬁﬂﬃ½¼㎏㏒™№𝐀🄰")), max_size=40)


@SETTINGS
@given(st.lists(ids, min_size=1, max_size=30))
def test_normalize_id_matches_model(spark, values):
    assert spark_map(spark, values, E.normalize_id) == [model_id(v) for v in values]


@SETTINGS
@given(st.lists(names, min_size=1, max_size=30))
def test_synthetic_code_matches_model(spark, values):
    assert spark_map(spark, values, E.synthetic_code) == [model_synthetic(v) for v in values]


dates = st.datetimes(min_value=dt.datetime(1960, 1, 1), max_value=dt.datetime(2090, 12, 31))
formats = st.sampled_from(["%d/%m/%Y", "%d-%m-%Y", "%d.%m.%Y", "%d/%m/%Y %H:%M",
                           "%d/%m/%Y %H:%M:%S", "%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "serial",
                           "%d/%m/%Y %H:%M:%S.%f", "%d/%m/%Y %I:%M %p", "%Y/%m/%d", "%Y.%m.%d",
                           "%Y-%m-%dT%H:%M:%SZ", "%d-%b-%Y", "%d %B %Y", "%Y-%m", "%d/%m/%y"])


def render(d: dt.datetime, fmt: str) -> tuple[str, dt.datetime | None]:
    if fmt == "serial":
        days = (d.date() - dt.date(1899, 12, 30)).days
        when = dt.datetime.combine(d.date(), dt.time())
        return str(days), when if 20000 < days < 80000 else None
    text = d.strftime(fmt)
    return text, dt.datetime.strptime(text, fmt)


@SETTINGS
@given(st.lists(st.tuples(dates, formats), min_size=1, max_size=30))
def test_parse_mixed_date_matches_model(spark, pairs):
    rendered = [render(d, f) for d, f in pairs]
    got = spark_map(spark, [t for t, _ in rendered], E.parse_mixed_date)
    assert got == [want for _, want in rendered]
