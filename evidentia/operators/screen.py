"""Screening of records by their text: mentions that read as nomenclature, confirmed leads, and the decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions import text as tx


def screen(df: DataFrame, number: str, target: Column, description: str, claims: str, confirmed: Column | None = None, *, offices: tuple[str, ...] = ("WO", "EP"), least: int = 3) -> DataFrame:
    """Records of the offices whose description names the target, kept with at least ``least`` mentions, a confirmed lead or a mention in the claims.

    ``confirmed`` is an array of leads that a matcher has confirmed (chemistry is pluggable). What has the mentions but no confirmed lead needs its images read."""
    plain = F.regexp_replace(F.coalesce(F.col(description), F.lit("")), "<[^>]+>", " ")
    rows = df.filter(F.substring(number, 1, 2).isin(*offices) & F.upper(plain).contains(F.upper(target)))
    found = rows.withColumns({"_m": F.size(tx.nomenclature(plain)), "_c": tx.nomenclature(F.col(claims)), "_l": F.size(tx.lead_names(F.col(description)))})
    n = F.coalesce(F.size(confirmed), F.lit(0)) if confirmed is not None else F.lit(0)
    out = found.select(*df.columns, F.col("_m").alias("mentions"), F.col("_l").alias("lead_names"), n.alias("confirmed"), F.slice("_c", 1, 2).alias("in_claims"))
    kept = out.filter((F.col("mentions") >= least) | (F.col("confirmed") > 0) | (F.size("in_claims") > 0))
    return kept.withColumn("needs_images", (F.col("mentions") >= least) & (F.col("confirmed") == 0))
