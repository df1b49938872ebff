"""Official names from a catalog by close keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import vocabulary as voc
from ..functions.similarity import best_ratios
from .prices import length_candidates, similar_candidates

CUTOFF = 0.85


def catalog_keys(catalog: DataFrame, name: str = "producto_genhospi") -> DataFrame:
    """llave and oficial of a catalog (ordinal and a name column); of equal keys the last name stays."""
    keyed = catalog.withColumn("llave", tx.catalog_key(F.col(name)))
    return keyed.groupBy("llave").agg(F.max_by(F.col(name), F.col("ordinal")).alias("oficial"))


def candidates(keys: DataFrame, catalog: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Pairs of a key and a catalog key whose lengths allow the cutoff; equal keys need no others."""
    wanted = keys.select("llave_cruce").distinct().where("llave_cruce <> ''")
    return length_candidates(wanted, "llave_cruce", catalog.select("llave", "oficial"), "llave", cutoff)


def match_catalog(keys: DataFrame, catalog: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """llave_cruce (distinct), producto_oficial and match_found; the closest catalog key wins, of equally close ones the larger."""
    wanted = keys.select("llave_cruce").distinct()
    equal = wanted.where("llave_cruce <> ''").join(catalog, F.col("llave_cruce") == F.col("llave")).select("llave_cruce", "oficial")
    open_ = wanted.join(equal.select("llave_cruce"), "llave_cruce", "left_anti")
    pairs = similar_candidates(open_.where("llave_cruce <> ''"), "llave_cruce", catalog.select("llave", "oficial"), "llave", cutoff)
    scored = best_ratios(pairs, "llave_cruce", "llave", cutoff, reverse=True)
    close = scored.groupBy("llave_cruce").agg(F.max(F.struct("sim", "llave", "oficial")).alias("b")).select("llave_cruce", F.col("b.oficial").alias("oficial"))
    found = wanted.join(equal.unionByName(close), "llave_cruce", "left")
    return found.select(
        "llave_cruce", F.coalesce("oficial", F.concat(F.lit(voc.NOT_IN_CATALOG), "llave_cruce")).alias("producto_oficial"),
        F.when(F.col("oficial").isNotNull(), 1.0).otherwise(0.0).alias("match_found"),
    )


def map_back(rows: DataFrame, matched: DataFrame) -> DataFrame:
    """Rows with the outcome of their key."""
    return rows.join(matched, "llave_cruce", "left")
