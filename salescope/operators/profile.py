"""Column profiling and column-to-field mapping.

Every column of every raw table is profiled in one distributed pass: the
tables are unpivoted to ``(source_file, column, value)`` and grouped by
``(source_file, column)``; all features are aggregates with map-side
partial combine. A Spark ML random forest, trained on tables whose mapping
is known, scores each column for each field, and the assignment of the greatest
sum of scores keeps one column per field and one field per column.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import schema as S
from ..functions import expressions as E
from ..functions.numeric import half_up

HEADER_FEATURES = [f"hdr_{f}" for f in S.FIELDS]
CONTENT_FEATURES = ["pct_num", "pct_int", "num_mean", "num_std", "num_max", "num_min",
                    "pct_len14", "pct_len12_13", "pct_len8_14", "pct_excel_serial", "pct_date",
                    "mean_len", "max_len", "distinct_ratio", "pct_uf", "pct_canal_kw",
                    "money_like", "product_like"]
FEATURES = HEADER_FEATURES + CONTENT_FEATURES
CLASSES = S.FIELDS + ["ignore"]


def long_values(tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """``(source_file, column, value)`` for every cell of every raw table."""
    out = None
    for name, raw in tables:
        cols = [c for c in raw.columns if c != "_row_no"]
        cells = F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
            for c in cols]))
        df = raw.select(F.lit(name).alias("source_file"), cells.alias("kv")) \
                .select("source_file", "kv.column", "kv.value")
        out = df if out is None else out.unionByName(df)
    return out


def header_flag(column: Column, keywords: Sequence[str]) -> Column:
    """1 when a header token contains a keyword, or a token of 2+ characters
    is part of a keyword."""
    tokens = F.split(F.trim(F.regexp_replace(F.lower(column), "[^a-z0-9]+", " ")), " ")
    kws = F.array(*[F.lit(k) for k in keywords])
    hit = F.exists(tokens, lambda t: F.exists(
        kws, lambda k: t.contains(k) | ((F.length(t) >= 2) & k.contains(t))))
    return hit.cast("int").cast("double")


def layout_values(frames: Sequence[DataFrame]) -> DataFrame:
    """``long_values`` of frames that read many files each (``source_file`` in a column): one branch a layout."""
    out = None
    for raw in frames:
        cells = F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
            for c in raw.columns if c not in ("_row_no", "source_file")]))
        df = raw.select("source_file", cells.alias("kv")).select("source_file", "kv.column", "kv.value")
        out = df if out is None else out.unionByName(df)
    return out


LARGE = 1e9
HIGH = float(1 << 20)


def nine_digits(x: Column) -> Column:
    """Six decimals; of a large number nine digits, as the last bits of a mean depend on the order of summation."""
    unit = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))) - 8)
    return F.when(F.abs(x) >= LARGE, F.floor(x / unit + 0.5) * unit).otherwise(half_up(x, 6))


def content_profile(tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """M5 content features (everything but the header flags) per
    (source_file, column), rounded to 6 decimals."""
    return cell_profile(long_values(tables))


def cell_profile(cells: DataFrame) -> DataFrame:
    """``content_profile`` of ``(source_file, column, value)`` rows."""
    v = F.col("value")
    num = E.to_number(v)
    is_num = num.isNotNull() & ~F.isnan(num)
    is_int = is_num & ((num % F.lit(1.0)) == 0)
    # characters of the integer as text (sign included), by arithmetic
    digits = (F.when(num == 0, F.lit(1))
               .otherwise(F.floor(F.log10(F.abs(num))) + 1 + F.when(num < 0, 1).otherwise(0)))
    up = F.upper(F.trim(v))
    # an OR of contains (not a lambda over an array) keeps the aggregate in codegen
    kw_hit = None
    for k in S.CHANNEL_KEYWORDS:
        kw_hit = up.contains(k) if kw_hit is None else (kw_hit | up.contains(k))
    # equal cells of a column become one row with their number: every test below runs once a distinct value, and
    # the cells are shuffled once, for the counts and the distinct values alike
    counted = cells.groupBy("source_file", "column", "value").agg(F.count(F.lit(1)).alias("n"))
    high = F.floor(num / HIGH) * F.lit(HIGH)              # large numbers are summed in two parts, so no digit is lost
    alike = counted.groupBy("source_file", "column", "n").agg(
        F.count(v).alias("_nn"), F.count_if(is_num).alias("_num"), F.count_if(is_int).alias("_int"),
        F.sum(F.when(is_num, high)).alias("_high"), F.sum(F.when(is_num, num - high)).alias("_low"),
        F.var_pop(F.when(is_num, num)).alias("_var"),
        F.max(F.when(is_num, num)).alias("_max"), F.min(F.when(is_num, num)).alias("_min"),
        F.count_if(is_int & (digits == 14)).alias("_l14"),
        F.count_if(is_int & digits.between(12, 13)).alias("_l1213"),
        F.count_if(is_int & digits.between(8, 14)).alias("_l814"),
        F.count_if(is_num & num.between(S.PROFILE_SERIAL_MIN, S.PROFILE_SERIAL_MAX)).alias("_ser"),
        F.count_if(v.isNotNull() & ~is_num & E.parse_text_date(v).isNotNull()).alias("_date"),
        F.sum(F.length(v)).alias("_len"), F.max(F.length(v)).alias("_xlen"),
        F.count_if(up.isin(*S.REGION_CODES)).alias("_uf"),
        F.count_if(v.isNotNull() & kw_hit).alias("_kw"),
    )
    # the mean before the squares, as a sum of squares alone loses the digits of large numbers; a column has at most
    # about the square root of its cells of different numbers of equal cells
    whole = Window.partitionBy("source_file", "column")
    per = F.col("n") * F.col("_num")
    mean_of = {c: F.try_divide(F.sum(F.col("n") * F.col(c)).over(whole), F.sum(per).over(whole)) for c in ("_high", "_low")}
    off = sum((F.try_divide(F.col(c), F.col("_num")) - F.col(f"_mean{c}") for c in mean_of), F.lit(0.0))
    alike = alike.select("*", *[mean.alias(f"_mean{c}") for c, mean in mean_of.items()])
    g = alike.groupBy("source_file", "column").agg(
        *[F.sum(F.col("n") * F.col(c)).alias(c) for c in ("_nn", "_num", "_int", "_l14", "_l1213", "_l814", "_ser",
                                                        "_date", "_uf", "_kw")],
        (F.max("_mean_high") + F.max("_mean_low")).alias("_mean"), F.sum(per * (F.col("_var") + off * off)).alias("_squares"),
        F.sum(F.col("n") * F.col("_len")).alias("_len"), F.max("_xlen").alias("_xlen"), F.max("_max").alias("_max"),
        F.min("_min").alias("_min"), F.sum("_nn").alias("_dist"))
    g = g.withColumn("_std", F.when(F.col("_num") > 1, F.sqrt(F.try_divide(F.col("_squares"), F.col("_num") - 1))))
    g = g.withColumn("_mlen", F.try_divide(F.col("_len"), F.col("_nn")))
    n = F.greatest(F.col("_nn"), F.lit(1)).cast("double")

    def frac(c: str, den: Column = n) -> Column:
        return F.col(c).cast("double") / den

    nz = lambda c: F.coalesce(F.when(~F.isnan(F.col(c)), F.col(c)), F.lit(0.0))
    per_int = F.greatest(F.col("_int"), F.lit(1)).cast("double")
    feats = {
        "pct_num": frac("_num"),
        "pct_int": frac("_int", F.greatest(F.col("_num"), F.lit(1)).cast("double")),
        "num_mean": nz("_mean"), "num_std": nz("_std"), "num_max": nz("_max"), "num_min": nz("_min"),
        "pct_len14": frac("_l14", per_int), "pct_len12_13": frac("_l1213", per_int),
        "pct_len8_14": frac("_l814", per_int),
        "pct_excel_serial": frac("_ser"), "pct_date": frac("_date"),
        "mean_len": F.coalesce(F.col("_mlen"), F.lit(0.0)),
        "max_len": F.coalesce(F.col("_xlen"), F.lit(0)).cast("double"),
        "distinct_ratio": frac("_dist"), "pct_uf": frac("_uf"), "pct_canal_kw": frac("_kw"),
    }
    return g.select("source_file", "column", *[
        (nine_digits(c) if k.startswith("num_") else half_up(c, 6)).alias(k) for k, c in feats.items()])


def with_header_flags(content: DataFrame) -> DataFrame:
    """Full M5 rows: header flags from the column name, content features, and
    the two derived flags, in the fixed feature order."""
    money = ((F.col("pct_num") > 0.9) & (F.col("pct_int") < 0.5)
             & (F.col("num_mean") > 1) & (F.col("num_mean") < 100000))
    product = (F.col("mean_len") > 18) & (F.col("distinct_ratio") > 0.05)
    hdr = [half_up(header_flag(F.col("column"), S.HEADER_KEYWORDS[f]), 6).alias(f"hdr_{f}")
           for f in S.FIELDS]
    return content.select("source_file", "column", *hdr,
                          *[c for c in CONTENT_FEATURES if c not in ("money_like", "product_like")],
                          money.cast("double").alias("money_like"),
                          product.cast("double").alias("product_like"))


def relabel(content: DataFrame, spark: SparkSession,
            renames: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Content profiles of (file, column) pairs seen under other names: rows
    ``(source_file, column, new_file, new_column)``. The same values have the
    same content features, so only the names change (the map has one row per
    column)."""
    m = spark.createDataFrame(list(renames), "source_file string, column string, "
                                             "new_file string, new_column string")
    return (content.join(F.broadcast(m), ["source_file", "column"])
                   .drop("source_file", "column")
                   .withColumnRenamed("new_file", "source_file")
                   .withColumnRenamed("new_column", "column")
                   .select(*content.columns))


def profile_columns(tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """M5: one row of features per (source_file, column)."""
    return with_header_flags(content_profile(tables))


def labelled(profiles: DataFrame, spark: SparkSession,
             truths: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Attach the true field (or ``ignore``) to each profiled column."""
    rows = [(f, field, col) for f, m in truths.items() for field, col in m.items() if col]
    truth = spark.createDataFrame(rows, "source_file string, field string, column string")
    j = profiles.join(truth, ["source_file", "column"], "left")
    label = F.coalesce(F.col("field"), F.lit("ignore"))
    idx = F.array_position(F.array(*[F.lit(c) for c in CLASSES]), label) - 1
    return j.select("*", label.alias("label_name"), idx.cast("double").alias("label"))


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURES, outputCol="features")


def with_class_weights(df: DataFrame) -> DataFrame:
    """Balanced class weights: n / (classes * count of the class)."""
    counts = df.groupBy("label").agg(F.count(F.lit(1)).alias("_c"))
    n = df.agg(F.count(F.lit(1))).scalar()
    k = counts.agg(F.count(F.lit(1))).scalar()
    return (df.join(counts, "label")
              .withColumn("weight", n.cast("double") / (k * F.col("_c")).cast("double"))
              .drop("_c"))


def forest(num_trees: int = 300, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                                  numTrees=num_trees, seed=seed, maxDepth=12)


def stratified_folds(train: DataFrame, folds: int = 3, seed: int = 42) -> DataFrame:
    """Training rows with ``fold``: each label's rows are shuffled by the seed and dealt in turn, so a label with at
    least as many rows as folds is in every fold; labels begin at different folds, so the folds are of like size.
    (The training set is one row per labelled column.)"""
    order = Window.partitionBy("label").orderBy(F.xxhash64("source_file", "column", F.lit(seed)), "source_file", "column")
    return train.withColumn("fold", F.pmod(F.row_number().over(order) + F.col("label").cast("int"), F.lit(folds)).cast("int"))


def train_classifier(train: DataFrame, num_trees: int = 300, folds: int = 3, seed: int = 42):
    """M7: fit the forest on labelled profiles and report its stratified k-fold CV accuracy.

    The training set is one row per labelled column (tens of rows); it is
    cached while the folds (fitted concurrently) and the final fit on all
    rows read it many times."""
    data = stratified_folds(with_class_weights(assembler().transform(train)), folds, seed)
    # a task a tree level, not one a shuffle partition; in order, so the trees do not depend on the session's partitions
    data = data.coalesce(1).sortWithinPartitions("source_file", "column").persist()
    try:
        rows = data.count()
        evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction",
                                                      metricName="accuracy")
        cv = CrossValidator(estimator=forest(num_trees, seed),
                            estimatorParamMaps=ParamGridBuilder().build(), evaluator=evaluator,
                            numFolds=folds, seed=seed, parallelism=folds, foldCol="fold")
        cv_model = cv.fit(data)
        # the cross-validator refits the forest on every row at the end
        return cv_model.bestModel, float(cv_model.avgMetrics[0]), rows
    finally:
        data.unpersist()


def score(model, profiles: DataFrame) -> DataFrame:
    """P11 + M6 (scores): the probability of each field for each column,
    ``(source_file, column, field, confidence)``."""
    scored = model.transform(assembler().transform(align_columns(profiles, FEATURES)))
    prob = vector_to_array("probability")
    fields = F.array(*[F.struct(F.lit(f).alias("field"),
                                F.coalesce(F.get(prob, i), F.lit(0.0)).alias("p"))
                       for i, f in enumerate(S.FIELDS)])
    return (scored.select("source_file", "column", F.explode(fields).alias("s"))
                  .select("source_file", "column", "s.field", F.col("s.p").alias("confidence")))


SCORE_UNIT = 1_000_000         # sums of scores are taken in whole millionths, so ties are ties


def _better(state: Column, scores: Column, index: Column) -> Column:
    """States after one more column. A state is a set of fields with the least (-sum, columns picked) that fills them."""
    n = len(S.FIELDS)

    def with_column(pick: Column, f: int) -> Column:
        return F.transform(pick, lambda x, i: F.when(i == f, index).otherwise(x))

    def best(fields: Column) -> Column:
        offers = [F.get(state, fields)]
        for f in range(n):
            before = F.get(state, fields - (1 << f))
            pick = with_column(before["pick"], f)
            offers.append(F.when((fields.bitwiseAND(F.lit(1 << f)) != 0) & before.isNotNull(), F.struct(
                (before["less"] - F.get(scores, F.lit(f))).alias("less"), pick.alias("pick"))))
        return F.array_min(F.array(*offers))

    return F.transform(F.sequence(F.lit(0), F.lit((1 << n) - 1)), best)


def assign_fields(scores: DataFrame, threshold: float = S.MAPPING_THRESHOLD) -> DataFrame:
    """M6 + F6: the one-to-one assignment of fields and columns with the greatest
    sum of confidences per file, of which pairs with confidence >= threshold stay.

    A fold over a file's columns keeps, for each of the 512 sets of the nine
    fields, the best way to fill it; all files at once, as column expressions.
    Ties go to the least sequence of columns, field by field, in the order of
    their names. A file's row holds its header: scores per column, no data.
    """
    n = len(S.FIELDS)
    units = F.floor(F.col("confidence") * SCORE_UNIT + 0.5).cast("long")
    per_column = scores.groupBy("source_file", "column").agg(F.array(*[
        F.coalesce(F.max(F.when(F.col("field") == f, units)), F.lit(0).cast("long")) for f in S.FIELDS]).alias("scores"))
    files = per_column.groupBy("source_file").agg(
        F.array_sort(F.collect_list(F.struct("column", "scores"))).alias("columns"))
    none = F.array_repeat(F.lit(1 << 30), n)              # an unfilled field comes after every column
    start = F.transform(F.sequence(F.lit(0), F.lit((1 << n) - 1)), lambda fields: F.when(
        fields == 0, F.struct(F.lit(0).cast("long").alias("less"), none.alias("pick"))))
    numbered = F.transform("columns", lambda c, i: F.struct(i.alias("i"), c["scores"].alias("scores")))
    filled = F.aggregate(numbered, start, lambda state, c: _better(state, c["scores"], c["i"]))
    picked = files.select("source_file", "columns", F.posexplode(F.array_min(filled)["pick"]).alias("f", "c"))
    picked = picked.where(F.col("c") < F.size("columns")).select(
        "source_file", F.element_at(F.array(*[F.lit(f) for f in S.FIELDS]), F.col("f") + 1).alias("field"),
        F.get("columns", "c")["column"].alias("column"))
    return (picked.join(scores, ["source_file", "field", "column"]).where(F.col("confidence") >= threshold)
            .select("source_file", "field", "column", half_up("confidence", 3).alias("confidence")))


def align_columns(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("source_file", "column")) -> DataFrame:
    """The keys and exactly ``columns``, in order; absent columns and nulls are 0."""
    have = set(df.columns)
    return df.select(*keys, *[(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in have else F.lit(0.0)).alias(c)
                              for c in columns])


# Rules for a start without a trained model: the content feature that speaks for a field, beside its header flag.
RULE_FEATURES = {
    "customer_id": "pct_len14", "region": "pct_uf", "product_code": "pct_len12_13", "product_name": "product_like",
    "amount": "money_like", "quantity": "pct_int", "channel": "pct_canal_kw"}
RULE_HEADER_WEIGHT, RULE_CONTENT_WEIGHT = 0.6, 0.4


def rule_scores(profiles: DataFrame) -> DataFrame:
    """Scores like :func:`score`'s from header flags and one content feature a field, without a model."""
    p = align_columns(profiles, FEATURES)
    speaks = {f: F.col(c) for f, c in RULE_FEATURES.items()}
    speaks["sale_date"] = F.greatest("pct_date", "pct_excel_serial")
    speaks["customer_name"] = F.when((F.col("pct_num") < 0.1) & (F.col("mean_len") > 8), 1.0).otherwise(0.0)
    each = F.array(*[F.struct(F.lit(f).alias("field"), half_up(
        F.lit(RULE_HEADER_WEIGHT) * F.col(f"hdr_{f}") + F.lit(RULE_CONTENT_WEIGHT) * speaks[f], 6).alias("confidence"))
        for f in S.FIELDS])
    return p.select("source_file", "column", F.explode(each).alias("s")).select("source_file", "column", "s.*")


def mapping_report(spark: SparkSession, mapping: DataFrame, files: DataFrame) -> DataFrame:
    """All nine fields per file, with detected column or ``not detected``,
    confidence and its band (>0.7 high, >0.4 medium, else low)."""
    fields = F.explode(F.array(*[F.struct(F.lit(i).alias("field_order"), F.lit(f).alias("field"))
                                 for i, f in enumerate(S.FIELDS)]))
    grid = (files.select("source_file").distinct()
                 .select("source_file", fields.alias("f"))
                 .select("source_file", "f.field_order", "f.field"))
    j = grid.join(mapping, ["source_file", "field"], "left")
    band = (F.when(F.col("confidence").isNull(), F.lit(None))
             .when(F.col("confidence") > S.CONFIDENCE_HIGH, F.lit("high"))
             .when(F.col("confidence") > S.CONFIDENCE_MEDIUM, F.lit("medium"))
             .otherwise(F.lit("low")))
    return j.select("source_file", "field_order", "field",
                    F.coalesce("column", F.lit("not detected")).alias("column"),
                    "confidence", band.alias("band")).orderBy("source_file", "field_order")


def mapping_accuracy(spark: SparkSession, mapping: DataFrame,
                     truths: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """J4 + M8: per file, fields with a known column, how many were mapped to
    it, and the accuracy."""
    rows = [(f, field, col) for f, m in truths.items() for field, col in m.items() if col]
    truth = spark.createDataFrame(rows, "source_file string, field string, expected string")
    j = truth.join(mapping.select("source_file", "field", F.col("column").alias("predicted")),
                   ["source_file", "field"], "left")
    hit = F.coalesce((F.col("predicted") == F.col("expected")).cast("int"), F.lit(0))
    return (j.groupBy("source_file")
             .agg(F.count(F.lit(1)).alias("fields"), F.sum(hit).alias("correct"))
             .select("source_file", "fields", "correct",
                     half_up(F.col("correct") / F.col("fields"), 4).alias("accuracy")))
