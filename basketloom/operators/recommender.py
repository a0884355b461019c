"""A factorisation with the ids its rows stand for: fitted, saved and asked as one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.operators.als import fit_als, index_ids, novel, recommend, restore_ids


@dataclass(frozen=True)
class Recommender:
    """A model on dense ids and what they stand for.

    ``users`` is ``DF[user_id, dense_id]``, ``products`` is ``DF[product_id, dense_id]``.
    All that goes in or comes out has real ids of up to 64 bits.
    """

    model: ALSModel
    users: DataFrame
    products: DataFrame

    @staticmethod
    def fit(interactions: DataFrame, **settings: float) -> Recommender:
        """Fitted on ``DF[user_id, product_id, purchases]``; settings as for ``fit_als``."""
        bought, users, products = index_ids(interactions)
        return Recommender(fit_als(bought, **settings), users, products)

    def _dense(self, df: DataFrame) -> DataFrame:
        """Rows of known users (and products, where there are any) in dense ids."""
        for name, ids in (("user_id", self.users), ("product_id", self.products)):
            if name in df.columns:
                df = df.join(ids, name).drop(name).withColumnRenamed("dense_id", name)
        return df

    def recommend(self, k: int = 10, users: DataFrame | None = None) -> DataFrame:
        """Best ``k`` products, bought before or not: ``DF[user_id, product_id, rank, score]``.

        For all users of the model or for the given ones; unknown users have no rows.
        """
        if users is not None:
            users = self._dense(users.select("user_id").distinct())
        return restore_ids(recommend(self.model, k, users), self.users, self.products)

    def novel(self, interactions: DataFrame, k: int = 10) -> DataFrame:
        """The best ``k`` products that each user of ``interactions`` has not bought."""
        bought = self._dense(interactions.select("user_id", "product_id"))
        return restore_ids(novel(self.model, bought, k), self.users, self.products)

    def save(self, path: str) -> None:
        """Save all three parts below ``path``, over an older one."""
        path = path.rstrip("/")
        self.users.write.mode("overwrite").parquet(f"{path}/user_ids")
        self.products.write.mode("overwrite").parquet(f"{path}/product_ids")
        self.model.write().overwrite().save(f"{path}/als")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Recommender:
        """All three parts; ValueError if the ids are not those of the factors."""
        path = path.rstrip("/")
        found = Recommender(
            ALSModel.load(f"{path}/als"),
            spark.read.parquet(f"{path}/user_ids"),
            spark.read.parquet(f"{path}/product_ids"),
        )
        for factors, ids in (
            (found.model.userFactors, found.users), (found.model.itemFactors, found.products)
        ):
            both = factors.select("id").join(ids, F.col("id") == F.col("dense_id"), "full")
            if both.where("id IS NULL OR dense_id IS NULL").limit(1).count():
                raise ValueError(f"{path} has ids of another model")
        return found
