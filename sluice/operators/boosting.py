"""AdaBoost over decision trees (SAMME and SAMME.R) as an MLlib estimator."""

from __future__ import annotations

import math
from dataclasses import replace
from functools import cached_property

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.flat_trees import FlatTrees, FlatTreesModel
from sluice.session import cut_lineage

LEAST_PROBABILITY = 1e-15


class AdaBoostParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    rounds = Param(Params._dummy(), "rounds", "most trees to fit", TypeConverters.toInt)
    algorithm = Param(Params._dummy(), "algorithm", "SAMME or SAMME.R", TypeConverters.toString)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    treeFeatures = Param(
        Params._dummy(), "treeFeatures", "features per split: all or sqrt", TypeConverters.toString
    )
    rowShare = Param(
        Params._dummy(), "rowShare", "share of the rows each tree sees", TypeConverters.toFloat
    )
    checkpointEvery = Param(
        Params._dummy(), "checkpointEvery", "rounds between checkpoints", TypeConverters.toInt
    )


class AdaBoost(Estimator, AdaBoostParams):
    """Each round fits one tree to reweighted rows; the rows it gets wrong gain weight.

    Trees are shallow by default.  A fully grown tree fits its training rows, and
    boosting would end after the first round.
    """

    @keyword_only
    def __init__(
        self,
        *,
        featuresCol: str | None = None,
        labelCol: str | None = None,
        predictionCol: str | None = None,
        rounds: int | None = None,
        algorithm: str | None = None,
        maxDepth: int | None = None,
        treeFeatures: str | None = None,
        rowShare: float | None = None,
        checkpointEvery: int | None = None,
        seed: int | None = None,
    ):
        super().__init__()
        self._setDefault(
            rounds=50,
            algorithm="SAMME",
            maxDepth=3,
            treeFeatures="all",
            rowShare=1.0,
            checkpointEvery=5,
            seed=1,
        )
        self._set(**self._input_kwargs)

    def _tree(self, round_no: int) -> RandomForestClassifier:
        return RandomForestClassifier(
            numTrees=1,
            bootstrap=False,
            featuresCol=self.getFeaturesCol(),
            labelCol=self.getLabelCol(),
            predictionCol="_pred",
            probabilityCol="_prob",
            rawPredictionCol="_raw",
            weightCol="_w",
            maxDepth=self.getOrDefault("maxDepth"),
            featureSubsetStrategy=self.getOrDefault("treeFeatures"),
            subsamplingRate=self.getOrDefault("rowShare"),
            seed=self.getSeed() + round_no,
        )

    def _fit(self, dataset: DataFrame) -> AdaBoostModel:
        label = F.col(self.getLabelCol())
        rows = dataset.select(
            self.getFeaturesCol(), label.cast("double").alias(self.getLabelCol())
        ).withColumn("_w", F.lit(1.0))
        start = rows.agg(F.max(label).alias("top"), F.count("*").alias("n")).first()
        classes = int(start.top) + 1
        by_probability = self.getOrDefault("algorithm") == "SAMME.R"
        trees, alphas = [], []
        rows = cut_lineage(rows.withColumn("_w", F.lit(1.0 / start.n)))
        for i in range(self.getOrDefault("rounds")):
            tree = self._tree(i).fit(rows)
            scored = tree.transform(rows)
            miss = (F.col("_pred") != label).cast("double")
            sums = scored.agg(
                F.sum("_w").alias("all"), F.sum(F.col("_w") * miss).alias("wrong")
            ).first()
            error = sums.wrong / sums.all
            if error >= 1 - 1 / classes and not (by_probability and error < 1):
                if not trees:
                    trees, alphas = [tree], [1.0]
                break
            if error == 0:
                trees, alphas = [*trees, tree], [*alphas, 1.0]
                break
            if by_probability:
                alpha = 1.0
                gain = F.exp(_probability_gain(label, classes))
            else:
                alpha = math.log((1 - error) / error) + math.log(classes - 1)
                gain = F.exp(alpha * miss)
            trees, alphas = [*trees, tree], [*alphas, alpha]
            rows = scored.withColumn("_w", F.col("_w") * gain / sums.all).select(rows.columns)
            if (i + 1) % self.getOrDefault("checkpointEvery") == 0:
                rows = cut_lineage(rows)
        model = AdaBoostModel(trees, alphas, classes, by_probability)
        return self._copyValues(model)


def _log_probabilities() -> Column:
    return F.transform(
        vector_to_array("_prob"), lambda p: F.log(F.greatest(p, F.lit(LEAST_PROBABILITY)))
    )


def _probability_gain(label: Column, classes: int) -> Column:
    """Exponent of the SAMME.R weight update: coded label times log probability."""
    coded = F.aggregate(
        F.transform(
            _log_probabilities(),
            lambda p, k: F.when(k == label, p).otherwise(-p / (classes - 1)),
        ),
        F.lit(0.0),
        lambda total, x: total + x,
    )
    return -(classes - 1) / classes * coded


class AdaBoostModel(Model, AdaBoostParams):
    """The fitted trees with the weight of their votes."""

    def __init__(self, trees: list, alphas: list[float], classes: int, by_probability: bool):
        super().__init__()
        self.trees, self.alphas = trees, alphas
        self.classes, self.by_probability = classes, by_probability

    @cached_property
    def flat(self) -> FlatTrees:
        """All trees as arrays, each leaf with the votes of its tree."""
        parts = []
        for tree, alpha in zip(self.trees, self.alphas, strict=True):
            own = FlatTrees.of_node(tree.trees[0]._call_java("rootNode"), self.classes)
            if self.by_probability:
                logs = np.log(np.maximum(own.votes, LEAST_PROBABILITY))
                votes = (self.classes - 1) * (logs - logs.mean(axis=1, keepdims=True))
            else:
                votes = alpha * np.eye(self.classes)[own.votes.argmax(axis=1)]
            parts.append(replace(own, votes=votes))
        return FlatTrees.join(parts)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        model = FlatTreesModel(self.flat)
        model._set(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())
        return model.transform(dataset)
