"""Keyed writes as DataFrame algebra: insert-ignore, partial upsert, update-from.

There is no MERGE on plain parquet paths, so each operation returns the new
snapshot of the target as a DataFrame; :func:`write_snapshot` writes it to a
fresh folder (never the one being read) and returns the new path.

Skew: de-duplication uses ``min_by``/``max_by`` hash aggregates, which combine
map-side, so a key holding a third of the batch is reduced per partition before
the shuffle instead of landing whole in one window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brewlens.session import merging, scratch_path


def _ordered(cols: Sequence[str]):
    return F.struct(*[F.col(c) for c in cols])


def dedupe(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], keep: str = "last") -> DataFrame:
    """One row per key: the row with the largest (``keep='last'``) or smallest
    (``keep='first'``) value of ``order_cols``.  Null keys are kept as a group."""
    payload = [c for c in df.columns if c not in keys]
    pick = F.max_by if keep == "last" else F.min_by
    if not payload:
        return df.select(*keys).distinct()
    if list(order_cols) == payload:       # the row that sorts last or first is told by itself: it travels once
        most = F.max if keep == "last" else F.min
        agg = df.groupBy(*keys).agg(most(_ordered(payload)).alias("_r"))
        return agg.select(*keys, *[F.col("_r")[c].alias(c) for c in payload])
    agg = df.groupBy(*keys).agg(pick(F.struct(*[F.col(c) for c in payload]), _ordered(order_cols)).alias("_r"))
    return agg.select(*keys, *[F.col("_r")[c].alias(c) for c in payload])


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                  order_cols: Sequence[str] | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO NOTHING`` applied to a batch.

    Within the batch the first row per key (by ``order_cols``) wins; rows whose
    key is already in the target are dropped; the result is the new snapshot.
    Running it twice with the same batch gives the same table, but for rows
    with a null key: as in SQL a null conflicts with nothing, so each run adds
    its (one) row again.  Without ``order_cols`` the row that sorts first by
    its other columns wins, whatever the partitioning.
    """
    cols = target.columns
    batch = dedupe(batch, keys, order_cols or [c for c in batch.columns if c not in keys] or list(keys), keep="first")
    fresh = batch.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*cols))


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           set_cols: Sequence[str], order_cols: Sequence[str] | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE SET <set_cols>``.

    New keys are inserted with all their columns; on a conflict only
    ``set_cols`` take the new value and every other column keeps the stored
    one.  Duplicate keys in ``updates`` are reduced to the last row first (by
    ``order_cols``, else by all other columns).  Null keys match nothing.
    """
    cols = target.columns
    updates = dedupe(updates, keys, order_cols or [c for c in updates.columns if c not in keys] or list(keys), keep="last")
    u = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in cols if c not in keys and c in updates.columns],
                       F.lit(True).alias("_u_hit"))
    t = target.withColumn("_t_hit", F.lit(True))
    j = t.join(u, list(keys), "full_outer")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
            continue
        new = F.col(f"_u_{c}") if c in updates.columns else F.lit(None).cast(target.schema[c].dataType)
        old = F.col(c)
        inserted = F.col("_t_hit").isNull()
        if c in set_cols:
            out.append(F.when(F.col("_u_hit").isNotNull(), new).otherwise(old).alias(c))
        else:
            out.append(F.when(inserted, new).otherwise(old).alias(c))
    return j.select(*out)


def update_from(target: DataFrame, upd: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``UPDATE target SET cols FROM upd WHERE keys match``.

    Target rows without a match keep their values; ``upd`` rows without a
    target row are ignored; ``upd`` must be unique on ``keys`` (an aggregate).
    """
    u = upd.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in cols], F.lit(True).alias("_u_hit"))
    j = target.join(u, list(keys), "left")
    out = []
    for c in target.columns:
        if c in cols:
            out.append(F.when(F.col("_u_hit").isNotNull(), F.col(f"_u_{c}")).otherwise(F.col(c))
                       .cast(target.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def ids_writeback(reviews: DataFrame, links: DataFrame, review_key: str, id_col: str,
                  order_col: str, target_col: str) -> DataFrame:
    """Write each review's linked ids back as an array column.

    One aggregate per review (bounded by the review's own mentions), ordered by
    ``order_col``; reviews without links keep their stored array.
    """
    return update_from(reviews, merging(id_arrays(links, review_key, id_col, order_col, target_col)), [review_key], [target_col])


def id_arrays(links: DataFrame, review_key: str, id_col: str, order_col: str, target_col: str) -> DataFrame:
    """(review_key, target_col): each review's linked ids as an array, ordered by ``order_col``."""
    return (links.groupBy(review_key)
            .agg(F.sort_array(F.collect_list(F.struct(F.col(order_col), F.col(id_col)))).alias("_s"))
            .select(review_key, F.transform("_s", lambda s: s[id_col]).alias(target_col)))


def write_snapshot(df: DataFrame, name: str, partition_by: Sequence[str] | None = None) -> str:
    """Write a snapshot under the shared checkpoint root; returns its path."""
    path = scratch_path(df.sparkSession, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
