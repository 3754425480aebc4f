"""The pair classifier: gradient-boosted trees with early stopping, saved with its thresholds."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from korvane.operators.features import FEATURE_COLUMNS, NOT_FOUND, RETRIEVAL_FEATURE_COLUMNS
from korvane.session import cut, release

#: Rows of a part in training.
PART = 1 << 16


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in FEATURE_COLUMNS + RETRIEVAL_FEATURE_COLUMNS if c in df.columns]


@dataclass
class PairMatcher:
    model: PipelineModel
    columns: list[str]
    match: float = 0.5
    singleton: float = 0.3

    @classmethod
    def train(cls, train: DataFrame, val: DataFrame | None = None, rounds: int = 20, depth: int = 5, step: float = 0.1, seed: int = 42) -> PairMatcher:
        """Either label weighs the same in all. val, if given, says when to stop.

        The trees read the rows again and again, pair them with errors by position and draw the candidates of splits by
        position, so the rows are written once in an order of their values: what order they come in changes nothing.
        """
        columns = feature_columns(train)
        rows = train.select(*columns, "label").withColumn("is_val", F.lit(False))
        if val is not None:
            rows = rows.unionByName(val.select(*columns, "label").withColumn("is_val", F.lit(True)))
        n_all, n, pos = rows.agg(F.count("*"), F.count_if(~F.col("is_val")), F.sum(F.when(~F.col("is_val"), F.col("label")))).first()
        weight = F.when(F.col("label") == 1, n / (2 * max(1, pos or 0))).otherwise(n / (2 * max(1, n - (pos or 0))))
        rows = cut(rows.repartition(max(1, -(-n_all // PART)), *rows.columns).sortWithinPartitions(*rows.columns), "training")
        gbt = GBTClassifier(
            labelCol="label", featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=step, minInstancesPerNode=5, featureSubsetStrategy="0.8", seed=seed, weightCol="weight",
            **({"validationIndicatorCol": "is_val", "validationTol": 0.0} if val is not None else {}),
        )
        made = VectorAssembler(inputCols=columns, outputCol="features").transform(rows.withColumn("weight", weight))
        model = PipelineModel([VectorAssembler(inputCols=columns, outputCol="features"), gbt.fit(made)])
        release(rows)
        return cls(model, columns)

    def score(self, df: DataFrame) -> DataFrame:
        """df with score. Columns that the model knows and df lacks (a retriever that was not run) count as not found."""
        lacking = {c: F.lit(float(NOT_FOUND) if c.endswith("_rank") else 0.0) for c in self.columns if c not in df.columns}
        made = self.model.transform(df.withColumns(lacking))
        return made.select(*df.columns, vector_to_array("probability")[1].alias("score"))

    def importance(self) -> list[tuple[str, float]]:
        """Features by gain, greatest first."""
        gains = self.model.stages[-1].featureImportances.toArray()
        return sorted(zip(self.columns, map(float, gains), strict=True), key=lambda x: (-x[1], x[0]))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        spark = self.model.stages[-1]._java_obj and self._spark()
        spark.createDataFrame([(json.dumps([self.columns, self.match, self.singleton]),)], "said string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")

    @staticmethod
    def _spark():
        from pyspark.sql import SparkSession

        return SparkSession.getActiveSession()

    @classmethod
    def load(cls, path: str) -> PairMatcher:
        columns, match, singleton = json.loads(cls._spark().read.text(f"{path}/settings").first()[0])
        return cls(PipelineModel.load(f"{path}/model"), columns, match, singleton)
