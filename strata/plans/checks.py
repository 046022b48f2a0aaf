"""Post-load probes of the silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.exact import exact_avg
from strata.schemas import KEY


def silver_probe(silver: DataFrame) -> DataFrame:
    """Rows, distinct keys, blank keys (expect 0), out-of-range popularity (expect 0)."""
    k, p = F.col(KEY), F.col("popularity")
    return silver.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct(KEY).alias("distinct_tracks"),
        F.count_if(k.isNull() | (k == "")).alias("null_track_id"),
        F.count_if((p < 0) | (p > 100)).alias("invalid_popularity"),
    )


def genre_counts(df: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` genres by row count with their average popularity."""
    return (df.groupBy("genre")
              .agg(F.count(F.lit(1)).alias("nb_tracks"),
                   exact_avg("popularity", 2, integral=True).alias("avg_pop"))
              .orderBy(F.col("nb_tracks").desc(), F.col("genre").asc_nulls_first())
              .limit(n))
