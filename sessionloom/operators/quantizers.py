"""The contract a quantizer fulfils, and the two that come with the library."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame

from sessionloom.config import QUANTIZER_LEVELS
from sessionloom.operators import product, quantize


class Quantizer(Protocol):
    """Models are DataFrames, so they can be written next to the codes."""

    def fit(self, vectors: DataFrame) -> DataFrame: ...

    def encode(self, vectors: DataFrame, model: DataFrame) -> DataFrame: ...

    def decode(self, codes: DataFrame, model: DataFrame) -> DataFrame: ...


class ScalarQuantizer:
    def __init__(self, levels: int = QUANTIZER_LEVELS, method: str = "exact"):
        self.levels, self.method = levels, method

    def fit(self, vectors: DataFrame) -> DataFrame:
        return quantize.train_scalar_quantizer(vectors, self.levels, self.method)

    def encode(self, vectors: DataFrame, model: DataFrame) -> DataFrame:
        return quantize.quantize(vectors, model)

    def decode(self, codes: DataFrame, model: DataFrame) -> DataFrame:
        return quantize.dequantize(codes, model)


class ProductQuantizer:
    # Codes per slice and number of slices.
    def __init__(self, cluster_size: int = 256, subquantizer_size: int = 32, rounds: int = 20, seed: int = 0):
        self.n_codes, self.n_slices, self.rounds, self.seed = cluster_size, subquantizer_size, rounds, seed

    def fit(self, vectors: DataFrame) -> DataFrame:
        return product.train_product_quantizer(vectors, self.n_slices, self.n_codes, self.rounds, self.seed)

    def encode(self, vectors: DataFrame, model: DataFrame) -> DataFrame:
        return product.pq_encode(vectors, model)

    def decode(self, codes: DataFrame, model: DataFrame) -> DataFrame:
        return product.pq_decode(codes, model)
