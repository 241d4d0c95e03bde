"""An RBF support-vector classifier by random Fourier features and linear machines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.flat_trees import SparseRows


# Products held at a time: values of rows times components.  These stay in a core's cache; blocks too large for it, taken
# from the system anew each time, made tasks wait for memory.
CELLS = 1 << 16


def _scrambled(x: np.ndarray) -> np.ndarray:
    """64-bit numbers that look random (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def directions(features: np.ndarray, components: int, gamma: float, seed: int) -> np.ndarray:
    """The row of each feature in the random directions: normal numbers drawn from its own hash.

    No task needs the rows of features that its own rows do not have.
    """
    start = _scrambled(features.astype(np.uint64) + (np.uint64(seed) << np.uint64(40)))
    place = _scrambled(start[:, None] ^ _scrambled(np.arange(components, dtype=np.uint64)))
    one = (place >> np.uint64(32)).astype(float) + 0.5
    two = (place & np.uint64(0xFFFFFFFF)).astype(float)
    normal = np.sqrt(-2.0 * np.log(one / 2.0**32)) * np.cos(2.0 * np.pi * two / 2.0**32)
    return np.sqrt(2.0 * gamma) * normal


def fourier(rows: SparseRows, components: int, gamma: float, seed: int) -> np.ndarray:
    """Cosines whose products approximate ``exp(-gamma |x - y|^2)``; only the entries of rows are touched."""
    phases = np.random.default_rng(seed).uniform(0.0, 2.0 * np.pi, size=components)
    features, place = np.unique(rows.indices, return_inverse=True)
    along = directions(features, components, gamma, seed)
    sums = np.zeros((len(rows), components))
    row, at = 0, rows.starts
    while row < len(rows):
        end = max(row + 1, int(np.searchsorted(at, at[row] + CELLS // components, side="right")) - 1)
        own = slice(at[row], at[end])
        filled = np.flatnonzero(np.diff(at[row : end + 1]))
        if len(filled):
            products = along[place[own]]
            products *= rows.values[own, None]
            sums[row + filled] = np.add.reduceat(products, at[row + filled] - at[row])
        row = end
    return np.sqrt(2.0 / components) * np.cos(sums + phases)


class FourierFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed):
    """Random Fourier features of a vector column (Rahimi and Recht, 2007).

    ``gamma=0`` stands for one over the number of features.
    """

    components = Param(Params._dummy(), "components", "features made", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "width of the kernel", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self,
        *,
        inputCol: str | None = None,
        outputCol: str | None = None,
        components: int | None = None,
        gamma: float | None = None,
        seed: int | None = None,
    ):
        super().__init__()
        self._setDefault(components=128, gamma=0.0, seed=1, inputCol="features", outputCol="fourier")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        components = self.getOrDefault("components")
        gamma, seed = self.getOrDefault("gamma"), self.getSeed()
        source, output = self.getInputCol(), self.getOutputCol()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column(source)
                own = gamma
                if not gamma and len(column):
                    first = column[0].as_py()
                    own = 1.0 / (first["size"] or len(first["values"]))
                made = fourier(SparseRows.of(column), components, own, seed)
                values = pa.array(made.ravel())
                offsets = pa.array(np.arange(len(column) + 1, dtype=np.int32) * components)
                yield batch.append_column(output, pa.ListArray.from_arrays(offsets, values))

        typed = dataset.withColumn(output, F.array(F.lit(0.0))).schema
        made = dataset.drop(output).mapInArrow(run, typed)
        return made.withColumn(output, array_to_vector(output))


def linear_machine(penalty: float, rows: int, max_iter: int = 50) -> LinearSVC:
    """The linear machine whose objective has hinge penalty ``penalty`` over ``rows`` rows."""
    return LinearSVC(regParam=regularisation(penalty, rows), maxIter=max_iter)


def regularisation(penalty: float, rows: int) -> float:
    return 1.0 / (penalty * max(rows, 1))


def kernel_svc(machine: LinearSVC, label: str = "label", parallelism: int = 4) -> OneVsRest:
    """One machine per class over the ``fourier`` column."""
    return OneVsRest(
        classifier=machine.setFeaturesCol("fourier"),
        featuresCol="fourier",
        labelCol=label,
        parallelism=parallelism,
    )


def kernel_svc_pipeline(
    machine: LinearSVC, components: int = 128, gamma: float = 0.0, seed: int = 1
) -> Pipeline:
    mapping = FourierFeatures(components=components, gamma=gamma, seed=seed)
    return Pipeline(stages=[mapping, kernel_svc(machine)])
