"""Bias baseline: global mean plus regularised user and item offsets (Koren 2010)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft import ITEM, RATING, USER
from ratecraft.models.routes import Routes
from ratecraft.session import cut_lineage


@dataclass
class FittedBias:
    mean: float
    users: DataFrame  # user_id, b_u
    items: DataFrame  # business_id, b_i
    low: float
    high: float

    def score(self) -> Column:
        raw = F.lit(self.mean) + F.coalesce("b_u", F.lit(0.0)) + F.coalesce("b_i", F.lit(0.0))
        return F.least(F.greatest(raw, F.lit(self.low)), F.lit(self.high))

    def predict(self, pairs: DataFrame) -> DataFrame:
        """Unknown users and items count as average."""
        joined = pairs.join(self.users, USER, "left").join(self.items, ITEM, "left")
        return joined.withColumn("prediction", self.score()).drop("b_u", "b_i")


@dataclass
class BiasModel:
    epochs: int = 10
    reg_item: float = 10.0
    reg_user: float = 15.0
    low: float = 1.0
    high: float = 5.0
    checkpoint_every: int = 5

    def fit(self, ratings: DataFrame) -> FittedBias:
        """Alternate the two regularised means; the user table is checkpointed every few epochs.

        The ratings are laid out once by user and once by item; a half step sends offsets to the blocks that
        need them and adds up what comes back. The offset tables hold one row per key.
        """
        routes = Routes(ratings, RATING)
        mean = routes.span[0] or 0.0
        users = routes.ids[USER].withColumn("b_u", F.lit(0.0))
        items = routes.ids[ITEM].withColumn("b_i", F.lit(0.0))

        def less_far(value: np.ndarray, at: np.ndarray, to: np.ndarray, begins: np.ndarray, own: np.ndarray, far: np.ndarray) -> np.ndarray:
            return np.add.reduceat(value - mean - far[to, 0], begins)[:, None]

        for epoch in range(1, self.epochs + 1):
            gaps = routes.step(ITEM, items, (), users, ("b_u",), less_far, ("gap",))
            items = self._shrunk(routes.ids[ITEM], gaps, ITEM, "b_i", self.reg_item)
            if epoch == self.epochs:
                items = cut_lineage(items)
            gaps = routes.step(USER, users, (), items, ("b_i",), less_far, ("gap",))
            users = self._shrunk(routes.ids[USER], gaps, USER, "b_u", self.reg_user)
            if epoch % self.checkpoint_every == 0 or epoch == self.epochs:
                users = cut_lineage(users)
        users, items = users.select(USER, "b_u"), items.select(ITEM, "b_i")
        routes.close()
        return FittedBias(mean, users, items, self.low, self.high)

    @staticmethod
    def _shrunk(ids: DataFrame, gaps: DataFrame, key: str, name: str, weight: float) -> DataFrame:
        return ids.join(gaps, key).select(*ids.columns, (F.col("gap") / (F.lit(weight) + F.col("n"))).alias(name))
