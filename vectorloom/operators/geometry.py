"""Legality of spheres, state transitions and volumes of bases, in column expressions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.functions import linear
from vectorloom.functions.columns import dot
from vectorloom.functions.linear import let
from vectorloom.operators.ranks import drawn, placed
from vectorloom.sources.tables import stored

JITTER, UNIT, LISTED, VOLUME_JITTER = 1e-7, 1e-3, 2e-3, 1e-6


def finalised(gram: np.ndarray, partial: np.ndarray, dim: int, cosines: np.ndarray) -> np.ndarray | None:
    """The new sphere's cosines with the m spheres of gram, null if there is no such sphere.

    Below full rank the bordered matrix must be positive definite up to a small jitter.
    From then on the sphere is solved for in the basis of the first dim spheres, must have
    length 1, and all its cosines must be in the alphabet.
    """
    m = len(gram)
    if m < dim:
        bordered = np.block([[gram, partial[:, None]], [partial[None, :], np.ones((1, 1))]])
        try:
            np.linalg.cholesky(bordered + JITTER * np.eye(m + 1))
        except np.linalg.LinAlgError:
            return None
        return partial
    try:
        x = np.linalg.solve(gram[:dim, :dim], partial)
    except np.linalg.LinAlgError:
        return None
    if not abs(float(x @ partial) - 1.0) <= UNIT:
        return None
    row = gram[:, :dim] @ x
    if not (np.abs(row[:, None] - cosines).min(axis=1) <= LISTED).all():
        return None
    return row


def grown(gram: np.ndarray, row: np.ndarray) -> np.ndarray:
    return np.block([[gram, row[:, None]], [row[None, :], np.ones((1, 1))]])


def valid_actions(gram: np.ndarray, partial: list[float], dim: int, cosines: np.ndarray, dead: bool, bound: int) -> np.ndarray:
    """All actions until the last one of a sphere, then those that complete one; none when dead or full."""
    m = len(gram)
    if dead or m >= bound:
        return np.zeros(len(cosines), dtype=bool)
    if len(partial) + 1 < min(m, dim):
        return np.ones(len(cosines), dtype=bool)
    return np.array([finalised(gram, np.array([*partial, c]), dim, cosines) is not None for c in cosines])


def completed(rows: Column, m: Column, row: Column, dim: int, cosines: list[float], basis: Column | None = None) -> Column:
    """finalised() as an expression over a matrix's rows; basis: the inverse of the first dim rows and columns, if it is at hand."""
    listed = lambda c: F.exists(F.array(*(F.lit(float(v)) for v in cosines)), lambda v: F.abs(c - v) <= LISTED)
    basis = inverted(rows, dim) if basis is None else basis

    def solved(x: Column) -> Column:
        near = F.abs(dot(x, row) - 1.0) <= UNIT
        return let(linear.times(F.transform(rows, lambda r: F.slice(r, 1, dim)), x), lambda new: F.when(near & F.forall(new, listed), new))

    full = let(basis, lambda inverse: F.when(inverse.isNotNull(), let(linear.times(inverse, row), solved)))
    fits = linear.definite(linear.with_diagonal(linear.bordered(rows, row), JITTER), m + 1)
    return F.when(m < dim, F.when(fits, row)).otherwise(full)


def inverted(rows: Column, dim: int) -> Column:
    """The inverse of the basis of the first dim spheres; null if it is singular."""
    return linear.inverse(F.transform(F.slice(rows, 1, dim), lambda r: F.slice(r, 1, dim)), F.lit(dim))


def root_states(embeddings: DataFrame, dim: int = 3) -> DataFrame:
    """state, place, m, gram (flat), partial: states whose spheres are vectors of a root system, under and over full rank in turn.

    At every coordinate of a vector, read as a ring, begins a piece of dim coordinates. It becomes the root with the
    signs of its two largest coordinates (of equals the first), so cosines are multiples of 1/2. The state at a place has
    m = dim - 1, dim or dim + 1 of the pieces that follow each other from there, and the cosines, but
    the last, of the piece after them. Rows are made from one vector each. Shorter vectors and nulls have no states.
    """
    e, n = F.col("v"), F.nullif(F.size("v"), F.lit(0))

    def root(c: Column) -> Column:
        piece = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda k: F.element_at(e, ((c + k) % n + 1).cast("int")))
        order = lambda p: F.slice(F.transform(F.sort_array(F.transform(p, lambda x, i: F.struct((-F.abs(x)).alias("x"), i.alias("i")))), lambda s: s["i"]), 1, 2)
        return let(piece, lambda p: let(order(p), lambda top: F.transform(p, lambda x, i: F.when(F.array_contains(top, i), F.when(x < 0, -1.0).otherwise(1.0)).otherwise(0.0))))

    parts = int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = embeddings.select(F.col("vec_id").alias("state"), F.col("embedding").cast("array<double>").alias("v")).filter(F.size("v") >= dim).repartition(parts)
    rooted = own.select("state", F.sequence(F.lit(0), n - 1).alias("places"), F.transform(F.sequence(F.lit(0), n - 1), root).alias("roots"))
    at = rooted.select("state", "roots", F.explode("places").alias("place")).withColumn("m", (F.lit(dim - 1) + F.col("place") % 3).cast("int"))
    piece = lambda j: F.element_at("roots", ((F.col("place") + j * dim) % F.size("roots") + 1).cast("int"))
    spheres = at.select("state", "place", "m", F.transform(F.sequence(F.lit(0), F.col("m") - 1), piece).alias("s"), piece(F.col("m")).alias("w"))
    cosines = lambda w: F.transform("s", lambda u: dot(u, w) / 2)
    return spheres.select("state", "place", "m", F.flatten(F.transform("s", cosines)).alias("gram"), F.slice(cosines(F.col("w")), 1, F.least(F.col("m"), F.lit(dim)) - 1).alias("partial"))


def pair_states(vectors: DataFrame) -> DataFrame:
    """state, gram (flat), m, partial: each vector and the label's next as two spheres, and the first cosine of the one after them.

    The next ones are joined by place, so that a label may hold all rows.
    """
    own = vectors.filter("embedding is not null").select("label", "vec_id", F.col("embedding").cast("array<double>").alias("v"))
    at = own.join(placed(own.select("label", "vec_id"), "label", "vec_id"), ["label", "vec_id"])
    later = lambda k, name: at.select("label", (F.col("place") - k).alias("place"), F.col("v").alias(name))
    three = at.join(later(1, "x"), ["label", "place"]).join(later(2, "w"), ["label", "place"])
    one = F.lit(1.0)
    cut = three.select(F.col("vec_id").alias("state"), F.lit(2).alias("m"), F.round(dot(F.col("v"), F.col("x")), 6).alias("c"), F.round(dot(F.col("v"), F.col("w")), 6).alias("a"))
    return cut.select("state", "m", F.array(one, F.col("c"), F.col("c"), one).alias("gram"), F.array("a").alias("partial"))


def legal_actions(states: DataFrame, cosines: list[float], dim: int = 3, bound: int = 75) -> DataFrame:
    """The keys of states (any keys, m, gram, partial), action, cos, valid: the legality of each action, in expressions.

    All actions are legal until the last one of a sphere, then those that complete one; none when it is full. A state's
    basis is inverted once for all its actions.
    """
    keys = [c for c in states.columns if c not in ("m", "gram", "partial")]
    rows = states.select(*keys, "m", "partial", linear.rows_of(F.col("gram"), F.col("m")).alias("rows"))
    based = rows.withColumn("basis", F.when(F.col("m") >= dim, inverted(F.col("rows"), dim)))
    tried = based.select("*", moves(cosines)).select(*keys, "m", "partial", "rows", "basis", "x.*")
    row = F.concat("partial", F.array("cos"))
    early = F.size("partial") + 1 < F.least(F.col("m"), F.lit(dim))
    good = completed(F.col("rows"), F.col("m"), row, dim, cosines, F.col("basis")).isNotNull()
    return tried.select(*keys, "action", "cos", F.when(F.col("m") >= bound, False).when(early, True).otherwise(good).alias("valid"))


def moves(cosines: list[float]) -> Column:
    """A row for each action: x.action, x.cos."""
    return F.explode(F.array(*(F.struct(F.lit(a).alias("action"), F.lit(float(c)).alias("cos")) for a, c in enumerate(cosines)))).alias("x")


def start_states(spark: SparkSession, seed_gram: list[list[float]] | None = None) -> DataFrame:
    """The one state that a game starts from: a single sphere, or a seed's Gram matrix."""
    seed = seed_gram or [[1.0]]
    row = (0, False, len(seed), [float(x) for r in seed for x in r], [])
    return spark.createDataFrame([row], "state long, is_dead boolean, m int, gram array<double>, partial array<double>")


def micro_steps(states: DataFrame, cosines: list[float], dim: int = 3) -> DataFrame:
    """states (any keys, is_dead, m, gram, partial) after each action: the keys, action, cos and the new state.

    A dead state stays as it is. An action adds its cosine to the partial row; the one that completes
    the row adds a sphere, or ends the game where there is none. All of it is expressions.
    """
    keys = [c for c in states.columns if c not in ("is_dead", "m", "gram", "partial")]
    tried = states.select(*keys, "is_dead", "m", "gram", "partial", moves(cosines)).withColumn("row", F.when(F.col("is_dead"), F.col("partial")).otherwise(F.concat("partial", F.array("x.cos"))))
    waits = F.col("is_dead") | (F.size("row") < F.least(F.col("m"), F.lit(dim)))
    rows = linear.rows_of(F.col("gram"), F.col("m"))
    done = tried.withColumn("waits", waits).withColumn("own", F.when(~waits, let(rows, lambda r: completed(r, F.col("m"), F.col("row"), dim, cosines))))
    fits, empty = F.col("own").isNotNull(), F.expr("cast(array() as array<double>)")
    # a column of its own first: beside a new m, the m in the function over rows would be that one
    done = done.withColumn("grown", F.when(fits, F.flatten(linear.bordered(rows, F.col("own")))).otherwise(F.col("gram")))
    state = F.when(F.col("waits"), F.col("is_dead")).otherwise(~fits), F.col("m") + fits.cast("int"), F.col("grown"), F.when(F.col("waits"), F.col("row")).otherwise(empty)
    return done.select(*keys, "x.*", *(c.alias(name) for c, name in zip(state, ("is_dead", "m", "gram", "partial"), strict=True)))


def frontier(start: DataFrame, cosines: list[float], levels: int, dim: int = 3, bound: int = 75) -> DataFrame:
    """actions, is_dead, m, gram, partial: the states that sequences of so many actions lead to from live states that are not full.

    Each level is dealt anew, as all of them come from one row; adaptive execution joins small ones.
    """
    now = start.select(F.expr("cast(array() as array<int>)").alias("actions"), "is_dead", "m", "gram", "partial")
    for _ in range(levels):
        after = micro_steps(now.filter(~F.col("is_dead") & (F.col("m") < bound)).repartition("actions"), cosines, dim)
        now = after.select(F.concat("actions", F.array("action")).alias("actions"), "is_dead", "m", "gram", "partial")
    return now


def volume_bases(spheres: DataFrame, dim: int, trials: int = 5000) -> DataFrame:
    """round, ids, log_volume, best: the best of so many random dim-subsets of each round (round, id, v).

    Each trial is a row and draws from the whole round by a hash of the round, the trial and the draw; all spheres where
    there are no more than dim, the first dim where no subset is regular. best marks the winner over all rounds of
    dim spheres or more. Volumes are of Gram matrices with a small jitter, in expressions.
    """
    own = spheres.select(F.col("round").cast("long").alias("round"), F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v"))
    parts = int(spheres.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = own.groupBy("round").agg(F.count("*").alias("n"))
    located = own.join(placed(own.select("round", "id"), "round", "id"), ["round", "id"])
    # trial -1: the first spheres, for rounds without choice or without a regular subset
    tries = sizes.select("round", "n", F.explode(F.sequence(F.lit(-1), F.when(F.col("n") > dim, trials - 1).otherwise(-1))).alias("trial")).repartition(parts, "round", "trial")
    first = F.sequence(F.lit(0).cast("long"), F.least(F.col("n"), F.lit(dim)) - 1)
    picked = tries.select("round", "trial", F.explode(F.when(F.col("trial") < 0, first).otherwise(drawn(F.col("n"), dim, F.col("round"), F.col("trial")))).alias("place"))
    # few bytes but much work a row: a number of its own keeps adaptive execution from joining the partitions
    subsets = picked.join(located, ["round", "place"]).repartition(parts, "round", "trial").groupBy("round", "trial").agg(F.sort_array(F.collect_list(F.struct("id", "v"))).alias("own"))
    volume = linear.log_determinant(linear.with_diagonal(linear.gram_of(F.col("own.v")), VOLUME_JITTER), F.size("own"))
    found = subsets.select("round", "trial", F.col("own.id").alias("ids"), F.coalesce(volume, F.lit(float("-inf"))).alias("log_volume"))
    chosen = F.struct((F.col("trial") >= 0) & (F.col("log_volume") > float("-inf")), "log_volume", -F.col("trial"))
    best = stored(found.groupBy("round").agg(F.max_by(F.struct("ids", "log_volume"), chosen).alias("x")).select("round", "x.ids", "x.log_volume"))
    top = best.filter(F.size("ids") >= dim).agg(F.max(F.struct("log_volume", (-F.col("round")).alias("r"))).alias("t"))
    return best.join(F.broadcast(top), how="cross").select("round", "ids", F.round("log_volume", 6).alias("log_volume"), (F.col("round") == -F.col("t.r")).alias("best"))
