"""Sketching a collection: train a quantizer on a sample and store codes and model."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.config import MAX_TRAIN_PROBES, QUANTIZER_TRAIN_SIZE, TOPK_QUANT, stage
from sessionloom.operators.knn import knn_join
from sessionloom.operators.profiles import random_queries
from sessionloom.operators.quantizers import Quantizer, ScalarQuantizer
from sessionloom.sources.items import embedding_width


def training_sample(
    items: DataFrame, train_size: int = QUANTIZER_TRAIN_SIZE, seed: int = 0, max_probes: int = MAX_TRAIN_PROBES
) -> DataFrame:
    """Neighbours of random probes, ``(q_idx, rank, id, embedding)``; repeats are kept.

    One probe for every TOPK_QUANT vectors of ``train_size``, ``max_probes`` at most.
    """
    probes = min(int(train_size / TOPK_QUANT), max_probes)
    queries = random_queries(items.sparkSession, probes, embedding_width(items), TOPK_QUANT, seed)
    near = knn_join(queries.drop("top_k_mmr"), items).select("q_idx", "rank", "id")
    # The sample is at most max_probes * TOPK_QUANT rows of ids.
    return items.select("id", "embedding").join(F.broadcast(near), "id")


def fraction_sample(items: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """A plain random share of the collection, for training on more of it."""
    return items.sample(fraction, seed).select("id", "embedding")


def sketch_collection(
    items: DataFrame,
    collection: str,
    registry: DataFrame | None = None,
    quantizer: Quantizer | None = None,
    train_size: int = QUANTIZER_TRAIN_SIZE,
    seed: int = 0,
) -> tuple[DataFrame, DataFrame] | None:
    """Codes of the training sample and the trained model.

    None where ``registry(collection)`` shows that the collection has a sketch.
    """
    if registry is not None and not registry.where(F.col("collection") == collection).isEmpty():
        return None
    quantizer = quantizer or ScalarQuantizer()
    sample = stage(training_sample(items, train_size, seed))
    model = quantizer.fit(sample).withColumn("collection", F.lit(collection))
    return quantizer.encode(sample, model).withColumn("collection", F.lit(collection)), model


def write_sketch(codes: DataFrame, model: DataFrame, collection: str, path: str) -> None:
    """Stores a collection's sketch; those of other collections stay."""
    for rows, name in ((codes, "codes"), (model, "model")):
        rows.drop("collection").write.mode("overwrite").parquet(f"{path}/{name}/collection={quote(collection, safe='')}")


def sketched_collections(spark: SparkSession, path: str) -> DataFrame:
    """Registry of the collections that have a sketch under ``path``."""
    named = spark.read.option("basePath", f"{path}/model").parquet(f"{path}/model")
    return named.select(F.col("collection").cast("string")).distinct()
