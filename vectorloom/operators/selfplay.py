"""Self-play: one tree search an episode, episodes spread over the cluster.

An episode is one group of applyInPandas, keyed by worker and number and seeded by them,
so a lost executor replays the same episodes. A state is the sequence of actions that
leads to it, which identifies it. Any game with the methods of Spheres and any evaluator
(state -> prior over actions, value) can be used.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.operators.geometry import finalised, grown, valid_actions


@dataclass(frozen=True)
class State:
    actions: tuple[int, ...] = ()
    partial: tuple[float, ...] = ()
    gram: np.ndarray = field(default_factory=lambda: np.ones((1, 1)))
    is_dead: bool = False

    @property
    def m(self) -> int:
        return len(self.gram)


class Game(Protocol):
    size: int

    def start(self) -> State: ...
    def after(self, state: State, action: int) -> State: ...
    def valid(self, state: State) -> np.ndarray: ...
    def over(self, state: State) -> bool: ...


Evaluator = Callable[[State], tuple[np.ndarray, float]]


class Spheres:
    """Adds spheres one cosine at a time; a sphere that cannot be completed ends the game, as does a full board."""

    def __init__(self, dim: int, upper_bound: int, cosines: list[float], seed_gram: np.ndarray | None = None):
        self.dim, self.bound, self.cosines, self.size, self.seed = dim, upper_bound, np.array(cosines), len(cosines), seed_gram

    def start(self) -> State:
        return State() if self.seed is None else State(gram=np.asarray(self.seed, dtype=np.float64))

    def after(self, state: State, action: int) -> State:
        if state.is_dead:
            return state
        actions, partial = (*state.actions, action), (*state.partial, float(self.cosines[action]))
        if len(partial) < min(state.m, self.dim):
            return State(actions, partial, state.gram)
        row = finalised(state.gram, np.array(partial), self.dim, self.cosines)
        return State(actions, (), state.gram, True) if row is None else State(actions, (), grown(state.gram, row))

    def valid(self, state: State) -> np.ndarray:
        return valid_actions(state.gram, list(state.partial), self.dim, self.cosines, state.is_dead, self.bound)

    def over(self, state: State) -> bool:
        return state.is_dead or state.m >= self.bound


def uniform(size: int) -> Evaluator:
    return lambda state: (np.full(size, 1 / size), 0.0)


class Search:
    """Select by upper confidence, expand and evaluate a leaf, back its value up along the path."""

    def __init__(self, game: Game, evaluate: Evaluator, exploration: float = 2.0, depth: int = 1000):
        self.game, self.evaluate, self.c, self.depth = game, evaluate, exploration, depth
        self.nodes: dict[tuple, dict] = {}

    def simulate(self, state: State) -> None:
        path = []
        for _ in range(self.depth):
            node = self.nodes.get(state.actions)
            if node is None:
                value = self.expand(state)
                break
            if node["ended"] is not None:
                value = node["ended"]
                break
            score = node["q"] + self.c * node["prior"] * np.sqrt(node["n"].sum() + 1e-8) / (1 + node["n"])
            action = int(np.where(node["valid"], score, -np.inf).argmax())
            path.append((node, action))
            state = self.game.after(state, action)
        else:
            value = -1.0
        for node, action in path:
            n = node["n"][action]
            node["q"][action] = (n * node["q"][action] + value) / (n + 1)
            node["n"][action] = n + 1

    def expand(self, state: State) -> float:
        valid = self.game.valid(state)
        prior, value = self.evaluate(state)
        kept = np.where(valid, prior, 0.0)
        full = self.game.over(state) and not state.is_dead
        ended = float(state.m) if full else None if valid.any() else -1.0
        total = kept.sum()
        prior = kept / total if total > 0 else valid / max(1, valid.sum())
        self.nodes[state.actions] = {"prior": prior, "valid": valid, "n": np.zeros(self.game.size), "q": np.zeros(self.game.size), "ended": ended}
        return ended if ended is not None else float(value)

    def policy(self, state: State, simulations: int, temperature: float) -> np.ndarray:
        for _ in range(simulations):
            self.simulate(state)
        node = self.nodes[state.actions]
        n = node["n"]
        if not n.sum():
            return node["valid"] / node["valid"].sum() if node["valid"].any() else np.full(self.game.size, 1 / self.game.size)
        if not temperature:
            return np.eye(self.game.size)[int(n.argmax())]
        n = n ** (1 / temperature)
        return n / n.sum()


def episode(game: Game, evaluate: Evaluator, simulations: int, seed: int, threshold: int = 15, low: float = 0.0, high: float | None = None) -> list[dict]:
    """One game: a row a step with the policy, and the reward of the best live state on every row."""
    r, search, state, out = np.random.default_rng(seed), Search(game, evaluate), game.start(), []
    best, high = state.m, float(getattr(game, "bound", 75)) if high is None else high
    while not game.over(state) and len(out) < 10_000:
        pi = search.policy(state, simulations, 1.0 if len(out) + 1 < threshold else 0.0)
        action = int(r.choice(game.size, p=pi))
        out.append({"step": len(out), "m": state.m, "is_dead": state.is_dead, "partial": list(state.partial), "gram": state.gram.ravel().tolist(), "action": action, "pi": pi.tolist()})
        state = game.after(state, action)
        if not state.is_dead:
            best = max(best, state.m)
    reward = float(np.clip(2 * (best - low) / (high - low + 1e-5) - 1, -1, 1))
    return [x | {"best_m": best, "reward": reward} for x in out]


SCHEMA = "iter int, rank int, episode int, step int, m int, is_dead boolean, partial array<double>, gram array<double>, action int, pi array<double>, best_m int, reward double"


def play(spark: SparkSession, dim: int, upper_bound: int, cosines: list[float], workers: int, episodes: int, simulations: int, seed: int = 0, iteration: int = 0, evaluator: Evaluator | None = None, seed_gram: np.ndarray | None = None) -> DataFrame:
    """Examples of workers * episodes games: one group a game."""
    game = Spheres(dim, upper_bound, cosines, seed_gram)
    evaluate = evaluator or uniform(len(cosines))

    def run(x: pd.DataFrame) -> pd.DataFrame:
        number = int(x["id"].iloc[0])
        rows = episode(game, evaluate, simulations, int(np.random.SeedSequence([seed, iteration, number]).generate_state(1)[0]))
        return pd.DataFrame(rows).assign(iter=iteration, rank=number // episodes, episode=number % episodes)[[c.split()[0] for c in SCHEMA.split(", ")]]

    return spark.range(workers * episodes).repartition(workers, "id").groupBy("id").applyInPandas(run, SCHEMA)


def training_loop(spark: SparkSession, path: str, iterations: int, keep: int, fit: Callable[[DataFrame], Evaluator], **game) -> Evaluator | None:
    """Plays, stores, keeps the last iterations and fits, again and again; each iteration is one written partition."""
    from vectorloom.sources.tables import append_metrics, append_replay, read_replay

    evaluator = None
    for i in range(1, iterations + 1):
        append_replay(play(spark, iteration=i, evaluator=evaluator, **game), f"{path}/replay")
        window = read_replay(spark, f"{path}/replay", keep, i)
        best = window.filter(F.col("iter") == i).agg(F.max("best_m")).first()[0]
        append_metrics(spark, f"{path}/metrics", i, best_m=best or 0)
        evaluator = fit(window)
    return evaluator
