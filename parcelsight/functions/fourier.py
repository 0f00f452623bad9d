"""Random Fourier features: a linear stand-in for the radial kernel."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cosine_waves(inputs: list[str], weights: np.ndarray, offsets: np.ndarray) -> Column:
    """sqrt(2/D) cos(W x + b) as an array column, one matrix product per Arrow batch."""
    scale = float(np.sqrt(2.0 / len(offsets)))

    @F.arrow_udf("array<double>")
    def waves(*columns: pa.Array) -> pa.Array:
        x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])
        z = scale * np.cos(x @ weights.T + offsets)
        starts = np.arange(0, z.size + 1, z.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(starts), pa.array(z.ravel()))

    return waves(*inputs)


class FourierFeatures(
    Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Pipeline stage over :func:`cosine_waves`; its drawn weights are stored with it."""

    weights = Param(
        Params._dummy(), "weights", "row-major weight matrix", TypeConverters.toListFloat
    )
    offsets = Param(Params._dummy(), "offsets", "phase per feature", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, weights=None, offsets=None):
        super().__init__()
        self._set(**self._input_kwargs)

    @classmethod
    def drawn(
        cls, inputs: list[str], output: str, features: int, gamma: float, seed: int
    ) -> FourierFeatures:
        """Weights of the kernel exp(-gamma |x - y|^2)."""
        random = np.random.default_rng(seed)
        weights = random.normal(0.0, np.sqrt(2.0 * gamma), (features, len(inputs)))
        offsets = random.uniform(0.0, 2.0 * np.pi, features)
        return cls(
            inputCols=list(inputs),
            outputCol=output,
            weights=weights.ravel().tolist(),
            offsets=offsets.tolist(),
        )

    def drawn_arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights, a row for each feature, and phases."""
        offsets = np.array(self.getOrDefault(self.offsets))
        weights = np.array(self.getOrDefault(self.weights)).reshape(len(offsets), -1)
        return weights, offsets

    def _transform(self, dataset: DataFrame) -> DataFrame:
        inputs = self.getInputCols()
        weights, offsets = self.drawn_arrays()
        waves = cosine_waves(inputs, weights, offsets)
        return dataset.withColumn(self.getOutputCol(), array_to_vector(waves))
