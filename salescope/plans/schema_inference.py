"""Schema inference over supplier files: profile, train, map, report, evaluate.

Targets are the four supplier files plus one with renamed and reordered
headers (the generalisation check). The trained forest is kept per
application and folder, and saved under the shared checkpoint folder.
"""
from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import session as SS
from ..operators import profile as P
from ..sources import fixtures as FX
from ..sources.materialize import materialized

ALIGNED = [c for c in P.FEATURES if not c.startswith("num_")]
RENAMED_FILE = "source_b_renamed.csv"
_lock = threading.Lock()
_models: dict[tuple[str, str], tuple] = {}


class SchemaInference:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.training = FX.training_tables(spark, sf_dir)
        renamed, renamed_truth = FX.renamed_source(spark, sf_dir)
        self.base = [(name, raw) for name, _, _, raw in FX.raw_sources(spark, sf_dir)]
        self.files = {name for name, _ in self.base}
        self.targets = self.base + [(RENAMED_FILE, renamed)]
        self.truths = {name: h for name, _, h in FX.SOURCES}
        self.truths[RENAMED_FILE] = renamed_truth

    def _content(self) -> DataFrame:
        """Content features of the four supplier files, computed once (one row
        per column, a single partition holds them). Files that are the same
        data under other headers reuse these rows."""
        return materialized(self.spark, "content-profiles", self.sf_dir.rstrip("/"),
                            lambda: P.content_profile(self.base).coalesce(1))

    def profiles(self) -> DataFrame:
        """M5 over the target files (the renamed file reuses its source's content)."""
        renamed = [("source_b.csv", old, RENAMED_FILE, new)
                   for old, new in FX.renamed_headers("source_b.csv").items()]
        content = self._content()
        return P.with_header_flags(content.unionByName(P.relabel(content, self.spark, renamed)))

    def _training_set(self) -> DataFrame:
        """Labelled profiles of the training files (a few dozen rows, read many
        times by the forest and the folds), written once."""
        def build() -> DataFrame:
            content = self._content()
            known = {n for n, _, _ in self.training}
            renames = []
            for name, src, layout in FX.TRAINING_LAYOUTS:
                src_headers = dict(next(h for n, _, h in FX.SOURCES if n == src))
                renames += [(src, src_headers[f], name, col) for f, col in layout.items()]
            base = content.where(F.col("source_file").isin(*[n for n in known if n in self.files]))
            prof = P.with_header_flags(base.unionByName(P.relabel(content, self.spark, renames)))
            return P.labelled(prof, self.spark, {n: h for n, h, _ in self.training}).coalesce(1)
        return materialized(self.spark, "training-profiles", self.sf_dir.rstrip("/"), build)

    def trained(self):
        """M7: (model, cv accuracy, training rows, saved path), once per app and folder."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir.rstrip("/"))
        with _lock:
            if key not in _models:
                train = self._training_set()
                model, cv_acc, rows = P.train_classifier(train)
                digest = hashlib.sha1("|".join(key).encode()).hexdigest()[:16]
                path = SS.shared_path(self.spark, f"schema-model-{digest}")
                model.write().overwrite().save(path)
                _models[key] = (model, cv_acc, rows, path, train)
            return _models[key]

    def training_summary(self) -> DataFrame:
        model, cv_acc, rows, _, train = self.trained()
        pred = model.transform(P.assembler().transform(train))
        return pred.agg(
            F.count(F.lit(1)).alias("training_columns"),
            F.countDistinct("label").alias("classes"),
            F.lit(model.getNumTrees).alias("trees"),
            F.lit(round(cv_acc, 4)).alias("cv_accuracy"),
            F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("train_accuracy"))

    def scores(self) -> DataFrame:
        return P.score(self.trained()[0], self.profiles())

    def mapping(self) -> DataFrame:
        """M6: (source_file, field, column, confidence)."""
        return P.assign_fields(self.scores())

    def report(self) -> DataFrame:
        """J5."""
        files = self.spark.createDataFrame([(n,) for n, _ in self.targets], "source_file string")
        return P.mapping_report(self.spark, self.mapping(), files)

    def accuracy(self) -> DataFrame:
        """M8."""
        return P.mapping_accuracy(self.spark, self.mapping(), self.truths)


    def rule_mapping(self) -> DataFrame:
        """M6 on the scores of the rules, which need no training."""
        return P.assign_fields(P.rule_scores(self.profiles()))

    def rule_report(self) -> DataFrame:
        """J5 of the mapping by rules."""
        files = self.spark.createDataFrame([(n,) for n, _ in self.targets], "source_file string")
        return P.mapping_report(self.spark, self.rule_mapping(), files)

    def rule_accuracy(self) -> DataFrame:
        """J4 + M8 of the mapping by rules."""
        return P.mapping_accuracy(self.spark, self.rule_mapping(), self.truths)

    def rule_log(self) -> DataFrame:
        """S4 of the target files under the mapping by rules: mapping, confidences, rows and errors."""
        from .consolidate import inferred_log
        files = self.spark.createDataFrame([(n,) for n, _ in self.targets], "source_file string")
        rows = None
        for name, raw in self.targets:
            names = raw.select(F.lit(name).alias("source_file"))
            rows = names if rows is None else rows.unionByName(names)
        return inferred_log(files, self.rule_mapping(), rows)

    def aligned(self) -> DataFrame:
        """The profiles without two of their features, brought to the columns of a model without sizes."""
        return P.align_columns(self.profiles().drop("hdr_region", "pct_uf"), ALIGNED)

    def folds(self) -> DataFrame:
        """M7: rows per label and fold of the training set."""
        return (P.stratified_folds(self._training_set()).groupBy("label_name", "fold")
                .agg(F.count(F.lit(1)).alias("rows")))


def _by_file(mapping: DataFrame) -> dict[str, dict[str, str]]:
    out: dict[str, dict[str, str]] = {}
    for r in mapping.select("source_file", "field", "column").collect():
        out.setdefault(r["source_file"], {})[r["field"]] = r["column"]
    return out


def infer_mappings(spark: SparkSession, model, tables) -> dict[str, dict[str, str]]:
    """Column mapping of every raw table with a trained forest (M5 + M6):
    ``{file name: {field: column}}``. The tables are profiled on the
    cluster; only the mapping (at most nine rows per file) comes back."""
    return _by_file(P.assign_fields(P.score(model, P.profile_columns(list(tables)))))


def infer_layout_mappings(spark: SparkSession, model, layouts) -> dict[str, dict[str, str]]:
    """``infer_mappings`` for the layouts of a landing folder: one plan branch a layout, whatever the number of
    files, as ``source_file`` is a key of the profile."""
    profiles = P.with_header_flags(P.cell_profile(P.layout_values([layout.frame for layout in layouts])))
    return _by_file(P.assign_fields(P.score(model, profiles)))
