"""Trees and forests with a least size of a node that may be split, which MLlib has no setting for.

A greedy tree decides at each node from the rows of that node alone, so a tree grown without the
bound and cut at nodes with too few rows is the tree that would have grown with it, unless
features are drawn at random per node, where it is one of the trees that may be drawn.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.sql import DataFrame, SparkSession, functions as F

from traceframe.session import shared_folder


def cut_small(nodes: pd.DataFrame, min_split: int) -> pd.DataFrame:
    """Nodes of one tree (parents before their children), those with fewer rows made leaves.

    Nodes below a cut go, the others are numbered anew without gaps, in the same order.
    """
    nodes = nodes.sort_values("id")
    left, right, rows = (nodes[c].to_numpy() for c in ("leftChild", "rightChild", "rawCount"))
    split = (left >= 0) & (rows >= min_split)
    kept = np.zeros(len(nodes), bool)
    level = np.zeros(1, np.int64)
    while len(level):
        kept[level] = True
        level = level[split[level]]
        level = np.concatenate([left[level], right[level]])
    number = np.cumsum(kept) - 1
    out, still = nodes[kept].copy(), split[kept]
    for name, child in (("leftChild", left), ("rightChild", right)):
        out[name] = np.where(still, number[np.where(still, child[kept], 0)], -1)
    out["gain"] = np.where(still, out["gain"], -1.0)
    out["id"] = np.arange(len(out))
    return out


def prune(spark: SparkSession, model: Model, min_split: int) -> Model:
    """The model with every node of fewer than ``min_split`` rows a leaf; forests tree by tree.

    The stored form of the model is read as a table, cut and stored again beside it, tree by tree
    in as many tasks as there are; what else the model has is copied.
    """
    path = shared_folder(spark, "trees")
    model.write().save(f"{path}/grown")
    nodes = spark.read.parquet(f"{path}/grown/data")
    forest = "treeID" in nodes.columns
    # One group is one tree, which the driver has held whole as part of the model.
    flat = nodes.select("treeID", "nodeData.*") if forest else nodes.select(F.lit(0).alias("treeID"), "*")
    threshold = F.struct(
        F.when(F.col("leftChild") < 0, -1).otherwise(F.col("split.featureIndex")).cast("int").alias("featureIndex"),
        F.when(F.col("leftChild") < 0, F.array().cast("array<double>")).otherwise(F.col("split.leftCategoriesOrThreshold")).alias("leftCategoriesOrThreshold"),
        F.when(F.col("leftChild") < 0, -1).otherwise(F.col("split.numCategories")).cast("int").alias("numCategories"),
    )
    links = flat.select("treeID", "id", "rawCount", "gain", "leftChild", "rightChild", F.col("id").alias("old"))
    kept = links.groupBy("treeID").applyInPandas(lambda tree: cut_small(tree, min_split), links.schema)
    rest = flat.select("treeID", F.col("id").alias("old"), "prediction", "impurity", "impurityStats", "split")
    cut = kept.join(rest, ["treeID", "old"]).withColumn("split", threshold)
    fields = nodes.schema["nodeData"].dataType.names if forest else nodes.columns
    out = cut.select("treeID", F.struct(*fields).alias("nodeData")) if forest else cut.select(*fields)
    out.write.parquet(f"{path}/cut/data")
    _copy_but(spark, f"{path}/grown", f"{path}/cut", "data")
    return type(model).load(f"{path}/cut")


def _copy_but(spark: SparkSession, source: str, target: str, left_out: str) -> None:
    """Copy a folder on whatever file system it is, but for one entry."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    root = hadoop.Path(source)
    files = root.getFileSystem(conf)
    for found in files.listStatus(root):
        name = found.getPath().getName()
        if name != left_out:
            hadoop.FileUtil.copy(files, found.getPath(), files, hadoop.Path(f"{target}/{name}"), False, conf)


class SplitSize(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """A tree or forest classifier whose nodes split only from ``minSplit`` rows on."""

    classifier: Param = Param(Params._dummy(), "classifier", "tree or forest classifier")
    minSplit: Param = Param(Params._dummy(), "minSplit", "least rows of a node that is split", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, classifier=None, minSplit=2):
        super().__init__()
        self._setDefault(minSplit=2)
        self._set(**self._input_kwargs)

    def getClassifier(self):
        return self.getOrDefault(self.classifier)

    def _fit(self, df: DataFrame) -> Model:
        model = self.getClassifier().fit(df)
        least = self.getOrDefault(self.minSplit)
        # A split leaves rows on both sides, so two rows are no bound.
        return prune(df.sparkSession, model, least) if least > 2 else model
