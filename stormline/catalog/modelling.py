"""D28 and D31: nested cross-validation and sweeps over labelled documents. Tests hold both against a plain version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormline.plans import evaluation, selection
from stormline.registry import query, table

FEATURES = ["length", "words", "english", "lines"]


def labelled(spark, sf) -> DataFrame:
    """Labelled documents with numbers of their texts; documents that share their first words are one group."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return d.select(
        "doc_id", F.col("quality").alias("y"), F.sha1(F.substring("text", 1, 40).cast("binary")).alias("family"), F.log1p("n_chars").alias("length"),
        F.log1p(F.size(F.split("text", " "))).alias("words"), (F.col("lang") == "en").cast("int").alias("english"), F.log1p(F.size(F.split("text", "\n"))).alias("lines"),
    )


@query("d28_nested_cv")
def d28_nested(spark, sf):
    v = selection.nested_cv(labelled(spark, sf), FEATURES, "y", "family", "family")
    penalty = F.element_at(F.array(*[F.lit(v.penalties[k]) for k in sorted(v.penalties)]), F.col("outer") + 1)
    return v.rows.select("doc_id", F.col("outer").alias("fold"), penalty.alias("penalty"), F.round("score", 6).alias("score"))


@query("d31_config_sweep")
def d31_configs(spark, sf):
    out = selection.sweep(labelled(spark, sf), FEATURES, "y", "family", "family", 1.0, {"size": ["length", "words"], "language": ["english"], "layout": ["lines"]})
    return out.select("config", F.round("average_precision", 9).alias("average_precision"), F.round("delta", 9).alias("delta"))


def sourced(spark, sf) -> DataFrame:
    return labelled(spark, sf).join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")


@query("d30_model_evaluation")
def d30_models(spark, sf):
    r, _ = evaluation.evaluation_table(sourced(spark, sf), FEATURES, "y", "family", "family", ["length", "words"], "lines", ["source"], "source")
    return r.select("model", "tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("csi", "pod", "far", "lift", "lo", "hi", "average_precision")], "ship")


@query("d30_events")
def d30_events(spark, sf):
    v = selection.nested_cv(sourced(spark, sf), FEATURES, "y", "family", "family")
    return evaluation.event_rows(evaluation.decided(evaluation.of_validation(v)), "y", "source").withColumn("csi", F.round("csi", 6))
