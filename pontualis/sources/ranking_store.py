"""A service ranking on disk, for look-ups by service.

Names are stored without surrounding blanks, one row each, ranged and sorted by name, so a look-up
of one service skips all row groups but one by their bounds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pontualis.sources.day_store import exists

_SCHEMA = "nome string, posicao bigint, servico string, indicador double"
UNRANKED = -1.0


class RankingStore:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def write_once(self, ranking: Callable[[], DataFrame]) -> None:
        """Write the ranking unless a finished one is there; of equal names the best placed one stays."""
        if exists(self.spark, f"{self.path}/_SUCCESS"):
            return
        best = F.min_by(F.struct("posicao", "servico", "indicador"), "posicao").alias("_best")
        rows = ranking().groupBy(F.trim("servico").alias("nome")).agg(best)
        (rows.select("nome", "_best.*").repartitionByRange("nome").sortWithinPartitions("nome")
         .write.mode("overwrite").parquet(self.path))

    def read(self) -> DataFrame:
        return self.spark.read.schema(_SCHEMA).parquet(self.path)

    def scores(self, requested: DataFrame) -> DataFrame:
        """Indicator of each service of a table, -1 for services that are not ranked."""
        known = self.read().select(F.col("nome").alias("_nome"), F.col("indicador").alias("_known"))
        return (requested.withColumn("_nome", F.trim("servico")).join(known, "_nome", "left")
                .select("servico", F.coalesce("_known", F.lit(UNRANKED)).alias("indicador")))

    def lookup(self, servico: str) -> DataFrame:
        return self.read().where(F.col("nome") == servico.strip(" ")).select("indicador")

    def score(self, servico: str) -> float:
        found = self.lookup(servico).first()
        return UNRANKED if found is None else found.indicador
