"""Gene identifiers and category tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from hopscan.functions.labels import case_normalize_id

# The gene kind ids are resolved against.
PROTEIN_CODING = "protein coding gene"
# End of fixed values.


def id_lookup(gene_ids: DataFrame) -> DataFrame:
    """(alias, resolved): current ids, then names, then synonyms; ambiguous ones are NULL."""
    coding = gene_ids.filter(F.col("gene_type") == PROTEIN_CODING).select(
        F.col("gene_systematic_id").alias("id"),
        F.coalesce("gene_name", "gene_systematic_id").alias("name"),
        "synonyms",
    )
    current = coding.select(F.col("id").alias("alias"), "id", F.lit(0).alias("rank"))
    names = coding.select(F.col("name").alias("alias"), "id", F.lit(1).alias("rank")).distinct()
    synonyms = coding.select(
        F.explode(F.split("synonyms", ",")).alias("alias"), "id", F.lit(2).alias("rank")
    ).withColumn("alias", F.trim("alias"))
    every = current.distinct().unionByName(names).unionByName(synonyms)
    unique = every.groupBy("alias", "rank").agg(
        F.when(F.count(F.lit(1)) == 1, F.min("id")).alias("id")
    )
    return unique.groupBy("alias").agg(F.min_by("id", "rank").alias("resolved"))


def resolve_ids(
    df: DataFrame, column: str, gene_ids: DataFrame, normalize_case: bool = False,
    name: str = "resolved_id",
) -> DataFrame:
    """Current id for ``column``; unknown ones stay as they are, ambiguous ones become NULL."""
    lookup = id_lookup(gene_ids).withColumn("_known", F.lit(True))
    source = case_normalize_id(F.col(column)) if normalize_case else F.col(column)
    rows = df.withColumn("_alias", source)
    out = rows.join(lookup.withColumnRenamed("alias", "_alias"), "_alias", "left")
    value = F.when(F.col("_known"), F.col("resolved")).otherwise(F.col("_alias"))
    return out.select(*df.columns, value.alias(name))


def hierarchy_union(
    tables: Sequence[DataFrame], codes: DataFrame, prefix: str = "spo", digits: int = 5
) -> DataFrame:
    """Stack category tables of different depth and attach their code descriptions.

    Tables have Name, Level_1 ... Level_n. Missing levels repeat the level to their left.
    ``codes`` has Code, Category, Description.
    """
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    levels = sorted(
        (c for c in every.columns if c.startswith("Level_")), key=lambda c: int(c.split("_")[1])
    )
    left_to_right = ["Name", *levels]
    filled = every.filter(F.col("Name").isNotNull()).select(
        "Name",
        *[F.coalesce(*[F.col(c) for c in reversed(left_to_right[: i + 2])]).alias(level)
          for i, level in enumerate(levels)],
    )
    width = F.greatest(F.length(F.col("Code").cast("string")), F.lit(digits))
    coded = codes.select(
        F.concat(F.lit(prefix), F.lpad(F.col("Code").cast("string"), width, F.lit("0"))).alias("Level_1"),
        "Category", "Description",
    )
    return filled.join(coded, "Level_1", "left").select("Name", "Category", "Description", *levels)
