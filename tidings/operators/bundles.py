"""Bundle repair before the model stages: bad item urls drop the item, never the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.functions.urls import normalize_url


def sanitize_bundles(items: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``items`` (cluster_id, url, ...) and ``links`` (cluster_id, link) in long form. Each url is
    normalised; rows without one are dropped. Clusters themselves are kept even when emptied (their id
    stays in the bundle table upstream). Returns (items, canonical links)."""
    it = items.withColumn("url", normalize_url(F.col("url"))).filter(F.col("url").isNotNull())
    ln = links.withColumn("link", normalize_url(F.col("link"))).filter(F.col("link").isNotNull())
    return it, ln
