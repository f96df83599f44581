"""Vector tables as classes of equal vectors.

Rows with a null id or a vector that is null, empty, holds a null or
non-finite component, or has another length than most vectors take no part.
Of several vectors under one id the smallest takes part.  Equal vectors form a
class, which keeps its ``keep`` smallest ids: an exact nearest list with ties
to the smaller id never needs more, so a vector that a third of the rows share
costs no more than another one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from wiremap.llm.common import stored


def clean_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part; ids are unique."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    out = rows.select(F.col(id_col).cast("long").alias("vec_id"),
                      F.col(vec_col).cast("array<double>").alias("v"))
    out = out.filter(F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.forall("v", finite))
    sizes = out.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    out = out.filter(F.size("v") == (sizes["n"] if sizes else 0))
    return out.groupBy("vec_id").agg(F.min("v").alias("v"))


def classes(rows: DataFrame, keep: int, is_query: Column) -> tuple[DataFrame, DataFrame]:
    """(class_id, v, ids) of the classes and (query_id, class_id) of the query rows."""
    rows = stored(rows, "vectors")
    first = Window.partitionBy("v").orderBy("vec_id")
    some = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= keep)
    groups = some.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    groups = stored(groups.select(F.element_at("ids", 1).alias("class_id"), "v", "ids"), "vector-classes")
    asked = rows.filter(is_query).join(groups.select("v", "class_id"), "v")
    return groups, stored(asked.select(F.col("vec_id").alias("query_id"), "class_id"), "queries")


def ranked(found: DataFrame, groups: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The k best ids of each query from (class_id of the query, other, score).

    ``found`` holds at least the k + 1 best classes of each query's class.
    """
    best = Window.partitionBy("class_id").orderBy(F.desc("score"), "other")
    found = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
    ids = groups.select(F.col("class_id").alias("other"), "ids")
    rows = asked.join(found.join(ids, "other"), "class_id").select(
        "query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def matrix(raw: list[bytes], dtype) -> np.ndarray:
    return np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1)


def best_columns(scores: np.ndarray, k: int, slack: float = 0.0) -> list[np.ndarray]:
    """For each row the columns that may hold its k largest values (ties and near ties too)."""
    if scores.shape[1] <= k:
        return [np.arange(scores.shape[1])] * len(scores)
    low = np.partition(scores, -k, axis=1)[:, -k]
    return [np.flatnonzero(row >= cut - slack) for row, cut in zip(scores, low)]
