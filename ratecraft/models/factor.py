"""Factor models trained by full-batch gradient steps on tables keyed by user and by item.

Each factor is a column of its own. The samples are laid out once (``routes``); a step sends factor rows to their
blocks, sums gradients per key there and moves every key by ``lr * sum / (1 + damping * lr * n)``: small groups
follow the summed gradient, large ones a fraction of its mean, which keeps hot keys
stable. No factor table is collected; tables are written down in every step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft import ITEM, PAIR, PREDICTION, USER
from ratecraft.functions.scalar import clip
from ratecraft.models.routes import CHUNK, Routes, Turn, added_up
from ratecraft.operators.ranking import encode_ids
from ratecraft.session import forget, stored_copy

_STEPS = 1 << 48


def digest_number(*parts: Column) -> Column:
    """A number from 0 to 2^48 - 1 by the digest of the parts; any engine with md5 draws the same one."""
    text = F.concat_ws(":", *(p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def _far_sums(value, at, to, begins, own, far):
    """By own id: the sums of the other ids' states."""
    return np.add.reduceat(far[to], begins)


def _names(prefix: str, k: int) -> list[str]:
    return [f"{prefix}{j}" for j in range(k)]


def _dot(left: str, right: str, k: int) -> Column:
    return reduce(Column.__add__, (F.col(a) * F.col(b) for a, b in zip(_names(left, k), _names(right, k))))


def _start(table: DataFrame, key: str, prefix: str, k: int, seed: int, scale: float = 0.1) -> DataFrame:
    """Start values spread over [-scale, scale] by a digest of the id, the same on every run."""
    spread = {f"{prefix}{j}": (digest_number(F.col(key), F.lit(seed), F.lit(j)) / F.lit(float(_STEPS)) - F.lit(0.5)) * F.lit(2.0 * scale) for j in range(k)}
    return table.withColumns(spread)


def _moved(old: str, gradient: Column, n: Column, lr: float, reg: float, damping: float = 1.0) -> Column:
    value = F.col(old)
    step = F.lit(lr) * (gradient - F.lit(reg) * n * value) / (F.lit(1.0) + F.lit(damping * lr) * n)
    return (value + step).alias(old)


@dataclass
class FittedSvdpp:
    mean: float
    users: DataFrame  # user_id, bu, w0.. (own factors plus the implicit part)
    items: DataFrame  # business_id, bi, q0..
    k: int
    low: float
    high: float

    def predict(self, pairs: DataFrame) -> DataFrame:
        joined = pairs.join(self.users, USER, "left").join(self.items, ITEM, "left")
        zero = F.lit(0.0)
        raw = (F.lit(self.mean) + F.coalesce("bu", zero) + F.coalesce("bi", zero)
               + F.coalesce(_dot("q", "w", self.k), zero))
        return joined.withColumn(PREDICTION, clip(raw, self.low, self.high)).select(*pairs.columns, PREDICTION)


@dataclass
class SvdppModel:
    """mean + b_u + b_i + q_i (p_u + |N(u)|^-1/2 sum y_j), N(u) the user's rated items (Koren 2008)."""

    factors: int = 20
    epochs: int = 20
    lr: float = 0.02
    reg: float = 0.02
    seed: int = 7
    #: All parts of the prediction move at once, so each takes a fraction of its own best step.
    damping: float = 8.0

    def fit(self, ratings: DataFrame, target: str = "rating") -> FittedSvdpp:
        k = self.factors
        routes = Routes(ratings, target)
        mean, low, high = routes.span
        users = _start(routes.ids[USER].withColumns({"root": F.lit(1.0) / F.sqrt("n"), "bu": F.lit(0.0)}), USER, "p", k, self.seed)
        # c adds up the list lengths of an item's raters, for y moves with all items of a rater's list.
        lengths = routes.step(ITEM, routes.ids[ITEM], (), users, ("n",), _far_sums, ("c",))
        items = routes.ids[ITEM].join(lengths, ITEM).withColumn("bi", F.lit(0.0))
        items = _start(_start(items, ITEM, "q", k, self.seed + 1), ITEM, "y", k, self.seed + 2)
        users, items = stored_copy(users, "users"), stored_copy(items, "items")
        if routes.undivided(USER):
            users, items = self._by_turns(routes, users, items, mean)
        else:
            for _ in range(self.epochs):
                last = users, items
                users, items = self._epoch(routes, users, items, mean)
                for table in last:
                    forget(table)
        whole = stored_copy(self._combined(routes, users, items).select(USER, "bu", *_names("w", k)), "users")
        routes.close()
        return FittedSvdpp(mean, whole, items.select(ITEM, "bi", *_names("q", k)), k, low, high)

    def _by_turns(self, routes: Routes, users: DataFrame, items: DataFrame, mean: float) -> tuple[DataFrame, DataFrame]:
        """All epochs where a user's ratings lie in one block: each is one turn of the blocks and one step of the items."""
        k = self.factors
        state = ("bu", *_names("p", k))
        turned, turn = routes.gathered(users, state), self._turn(mean)
        for _ in range(self.epochs):
            last = turned, items
            turned = routes.turn(turned, len(state), items, ("bi", *_names("q", k), *_names("y", k)), turn)
            pushed = routes.far_sums(turned, ("he", *_names("h", k), *_names("i", k)))
            items = stored_copy(self._pushed(items, pushed), "items")
            for table in last:
                forget(table)
        return users.drop(*state).join(routes.spread(turned, state), USER), items

    def _turn(self, mean: float) -> Turn:
        k, lr, reg, damping = self.factors, self.lr, self.reg, self.damping

        def turn(value, at, to, known, own, far):
            """What ``_epoch`` does, for a block that holds all ratings of its users; a null user has no state."""
            q, y = far[:, 1:1 + k], far[:, 1 + k:]
            n = np.bincount(at, minlength=len(own)).astype(np.float64)
            root = np.where(known, 1.0 / np.sqrt(n), 0.0)
            chunks = [slice(start, start + CHUNK) for start in range(0, len(at), CHUNK)]
            z, error = np.zeros((len(own), k)), np.empty(len(at))
            for c in chunks:
                added_up(z, at[c], y[to[c]])
            w = own[:, 1:] + root[:, None] * z
            pull = np.zeros((len(own), 1 + k))
            for c in chunks:
                error[c] = value[c] - (mean + own[at[c], 0] + far[to[c], 0] + np.einsum("ij,ij->i", w[at[c]], q[to[c]]))
                added_up(pull, at[c], np.column_stack([error[c], error[c, None] * q[to[c]]]))
            back = root[:, None] * pull[:, 1:]
            push = far  # the items' states are not needed any more, and have the shape of what is sent back
            push[:] = 0.0
            order = np.argsort(to, kind="stable")
            for c in chunks:
                o = order[c]
                added_up(push, to[o], np.column_stack([error[o], error[o, None] * w[at[o]], back[at[o]]]))
            moved = own + lr * (pull - reg * n[:, None] * own) / (1.0 + damping * lr * n[:, None])
            return np.where(known[:, None], moved, 0.0), push
        return turn

    def _move(self, old: str, gradient: Column, n: Column) -> Column:
        return _moved(old, gradient, n, self.lr, self.reg, self.damping)

    def _pushed(self, items: DataFrame, pushed: DataFrame) -> DataFrame:
        k, n = self.factors, F.col("n")
        return items.join(pushed, ITEM).select(
            ITEM, "n", "own", "far", "c", self._move("bi", F.col("he"), n), *(self._move(f"q{j}", F.col(f"h{j}"), n) for j in range(k)),
            *(self._move(f"y{j}", F.col(f"i{j}"), F.col("c")) for j in range(k)))

    def _combined(self, routes: Routes, users: DataFrame, items: DataFrame) -> DataFrame:
        """Users with w = p + root * (sum of y over their items)."""
        k = self.factors
        implicit = routes.step(USER, users, (), items, _names("y", k), _far_sums, _names("z", k))
        joined = users.join(implicit, USER)
        return joined.select(*users.columns, *((F.col(f"p{j}") + F.col("root") * F.col(f"z{j}")).alias(f"w{j}")
                                               for j in range(k)))

    def _epoch(self, routes: Routes, users: DataFrame, items: DataFrame, mean: float) -> tuple[DataFrame, DataFrame]:
        k = self.factors

        def pull(value, at, to, begins, own, far):
            """By user: its errors, and these times the items' factors."""
            error = value - (mean + own[at, 0] + far[to, 0] + np.einsum("ij,ij->i", own[at, 1:], far[to, 1:]))
            return np.add.reduceat(np.column_stack([error, error[:, None] * far[to, 1:]]), begins)

        def push(value, at, to, begins, own, far):
            """By item: its errors, these times its raters' vectors, and their pull on the implicit factors."""
            bias, root, w, g = far[to, 0], far[to, 1], far[to, 2:2 + k], far[to, 2 + k:]
            error = value - (mean + bias + own[at, 0] + np.einsum("ij,ij->i", own[at, 1:], w))
            return np.add.reduceat(np.column_stack([error, error[:, None] * w, root[:, None] * g]), begins)

        whole = stored_copy(self._combined(routes, users, items), "whole")  # sent and joined below
        own, far = ("bu", *_names("w", k)), ("bi", *_names("q", k))
        known = stored_copy(whole.join(routes.step(USER, whole, own, items, far, pull, ("ge", *_names("g", k))), USER), "known")
        forget(whole)
        n = F.col("n")
        new_users = known.select(USER, "n", "own", "far", "root", self._move("bu", F.col("ge"), n),
                                 *(self._move(f"p{j}", F.col(f"g{j}"), n) for j in range(k)))
        pushed = routes.step(ITEM, items, far, known, ("bu", "root", *_names("w", k), *_names("g", k)), push,
                             ("he", *_names("h", k), *_names("i", k)))
        new_items = self._pushed(items, pushed)
        new_users, new_items = stored_copy(new_users, "users"), stored_copy(new_items, "items")
        forget(known)
        return new_users, new_items


@dataclass
class FittedLogistic:
    users: DataFrame  # user_id, bu, p0..
    items: DataFrame  # business_id, bi, q0..
    k: int

    def score(self) -> Column:
        return F.col("bu") + F.col("bi") + _dot("p", "q", self.k)

    def predict(self, pairs: DataFrame) -> DataFrame:
        """Log odds of an interaction; pairs with an unknown user or item are dropped."""
        return (pairs.join(self.users, USER).join(self.items, ITEM)
                .withColumn(PREDICTION, self.score()).select(*pairs.columns, PREDICTION))

    def loss(self, samples: DataFrame) -> DataFrame:
        """One row: mean log loss over (user, item, label)."""
        margin = F.when(F.col("label") == 1, F.col(PREDICTION)).otherwise(-F.col(PREDICTION))
        return self.predict(samples).agg(F.avg(F.log1p(F.exp(-margin))).alias("loss"))


@dataclass
class LogisticModel:
    """Logistic matrix factorisation of interactions (Johnson 2014) with drawn negatives."""

    factors: int = 10
    epochs: int = 10
    lr: float = 0.05
    reg: float = 0.001
    negatives: int = 1
    seed: int = 11

    def samples(self, interactions: DataFrame) -> DataFrame:
        """(user, item, label): the distinct pairs, and per pair some items drawn by digest the user has not met."""
        positive = interactions.select(*PAIR).distinct()
        codes = encode_ids(positive, ITEM)
        n_items = codes.agg(F.count(F.lit(1))).scalar()
        draws = F.explode(F.array(*(F.lit(s) for s in range(self.negatives)))).alias("draw")
        drawn = positive.select(*PAIR, draws).select(
            USER, (digest_number(F.col(USER), F.col(ITEM), F.col("draw"), F.lit(self.seed)) % n_items).alias("code"))
        negative = drawn.join(codes, "code").select(*PAIR).distinct().join(positive, PAIR, "left_anti")
        return positive.withColumn("label", F.lit(1)).unionByName(negative.withColumn("label", F.lit(0)))

    def fit(self, interactions: DataFrame) -> FittedLogistic:
        fitted = None
        for fitted in self.fit_epochs(interactions):
            pass
        return fitted

    def fit_epochs(self, interactions: DataFrame, samples: DataFrame | None = None) -> Iterator[FittedLogistic]:
        """The model after each epoch of one training run."""
        routes = Routes(self.samples(interactions) if samples is None else samples, "label")
        users = _start(routes.ids[USER].withColumn("bu", F.lit(0.0)), USER, "p", self.factors, self.seed)
        items = _start(routes.ids[ITEM].withColumn("bi", F.lit(0.0)), ITEM, "q", self.factors, self.seed + 1)
        for _ in range(self.epochs):
            users = stored_copy(self._half(routes, users, items, USER), "users")
            items = stored_copy(self._half(routes, users, items, ITEM), "items")
            yield FittedLogistic(users.drop("n", "own", "far"), items.drop("n", "own", "far"), self.factors)
        routes.close()

    def _half(self, routes: Routes, users: DataFrame, items: DataFrame, side: str) -> DataFrame:
        k = self.factors
        sides = {USER: (users, "bu", "p"), ITEM: (items, "bi", "q")}
        (own, bias, mine), (far, other_bias, theirs) = sides[side], sides[ITEM if side == USER else USER]

        def pull(value, at, to, begins, own, far):
            odds = own[at, 0] + far[to, 0] + np.einsum("ij,ij->i", own[at, 1:], far[to, 1:])
            error = value - 1.0 / (1.0 + np.exp(-odds))
            return np.add.reduceat(np.column_stack([error, error[:, None] * far[to, 1:]]), begins)

        pulled = routes.step(side, own, (bias, *_names(mine, k)), far, (other_bias, *_names(theirs, k)), pull, ("ge", *_names("g", k)))
        return own.join(pulled, side).select(
            side, "n", "own", "far", _moved(bias, F.col("ge"), F.col("n"), self.lr, 0.0),
            *(_moved(f"{mine}{j}", F.col(f"g{j}"), F.col("n"), self.lr, self.reg) for j in range(k)))
