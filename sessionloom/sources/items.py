"""The item collection: any DataFrame source with an id and an embedding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.config import HISTORY_FIELD


def load_items(
    df: DataFrame,
    id_col: str = "id",
    embedding_col: str = "embedding",
    dim: int | None = None,
    history_field: str = HISTORY_FIELD,
) -> DataFrame:
    """Items of the right width: ``(id, embedding, history_value, <metadata>)``.

    ``history_field`` names the column whose value is written to a session's
    history; by default the id itself.
    """
    items = df.withColumnRenamed(id_col, "id").withColumnRenamed(embedding_col, "embedding")
    if dim is not None:
        items = items.where(F.size("embedding") == dim)
    field = "id" if history_field in (id_col, "id") else history_field
    rest = [c for c in items.columns if c not in ("id", "embedding")]
    # The marks let a search skip a look at the data.
    mark = {"history_value_is_id": True} if field == "id" else {}
    width = {} if dim is None else {"dim": dim}
    return items.select(
        "id",
        F.col("embedding").alias("embedding", metadata=width),
        F.col(field).alias("history_value", metadata=mark),
        *rest,
    )


def rejected_items(df: DataFrame, dim: int, id_col: str = "id", embedding_col: str = "embedding") -> DataFrame:
    """Rows ``load_items`` leaves out, with their width."""
    width = F.coalesce(F.size(embedding_col), F.lit(-1))
    return df.where(width != dim).select(F.col(id_col).alias("id"), width.alias("width"))


def embedding_width(items: DataFrame) -> int:
    """Width of the collection: as loaded, else read from a single row."""
    known = (items.schema["embedding"].metadata or {}).get("dim")
    if known:
        return known
    row = items.select(F.size("embedding").alias("n")).first()
    return row["n"] if row else 0


def fetch(items: DataFrame, item_id) -> DataFrame:
    """One item with vector and metadata; a missing id is an error."""
    found = items.where(F.col("id") == F.lit(item_id))
    if found.isEmpty():
        raise KeyError(f"no item with id {item_id!r}")
    return found


def multi_fetch(items: DataFrame, ids: DataFrame) -> DataFrame:
    """Items for a table of ids; unknown ids are dropped, repeats kept."""
    return items.join(ids.select("id"), "id", "inner")


def missing_ids(items: DataFrame, ids: DataFrame) -> DataFrame:
    return ids.select("id").distinct().join(items.select("id"), "id", "left_anti")


def project_result(
    candidates: DataFrame,
    items: DataFrame,
    include_values: bool = True,
    include_metadata: bool = True,
    return_fields: list[str] | None = None,
) -> DataFrame:
    """Attach item columns to search results, only those that are asked for."""
    fields: list[str] = []
    if include_metadata:
        metadata = [c for c in items.columns if c not in ("id", "embedding", "history_value")]
        fields += return_fields if return_fields is not None else metadata
    if include_values:
        fields.append("embedding")
    return candidates.join(items.select("id", *fields), "id") if fields else candidates


def restrict(items: DataFrame, predicate: Column | None) -> DataFrame:
    """A caller's metadata filter, applied before any search."""
    return items if predicate is None else items.where(predicate)
