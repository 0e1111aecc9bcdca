"""The catalogue of named queries and their DuckDB counterparts.

Embeddings stand for unit vectors (a label for a round of packing); events for a search
trace: user_id is the state or episode, event_type the action, value what is backed up,
event_id the order, and the day of ts the iteration.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.functions import columns as C
from vectorloom.functions import tables
from vectorloom.operators import attention, bounds, canonical, episodes, geometry, gram, learn, listed, ranks, search, selfplay, simulate
from vectorloom.session import Settings
from vectorloom.sources.tables import append_metrics_of, append_replay, checkpoint_names, load_model, new_store, read_replay, read_store, save_model, stored, table
from vectorloom.streaming import metrics, replay, state

#: The event types, in the order of their action numbers.
ACTIONS = ("click", "error", "purchase", "signup", "view")
#: Thresholds of a run, with their usual values.
SETTINGS = Settings()
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


def action() -> Column:
    return (F.array_position(F.array(*map(F.lit, ACTIONS)), F.col("event_type")) - 1).cast("int")


def trace(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").alias("s"), action().alias("a"), F.col("value").alias("v"), F.col("event_id").alias("sim"))


def steps(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").alias("episode"), F.col("event_id").alias("step"), F.col("value").alias("m"), (F.col("event_type") == "error").alias("is_dead"), F.dayofmonth("ts").alias("iter"))


def actions(spark: SparkSession) -> DataFrame:
    return spark.range(len(ACTIONS)).select(F.col("id").cast("int").alias("a"))


A = "list_position(['click','error','purchase','signup','view'], event_type) - 1"
T = f"(select user_id s, cast({A} as int) a, value v, event_id sim from events)"
E = f"(select s, a, count(*) n, avg(v) q from {T} group by s, a)"
PAIRS = "(select x.vec_id i, y.vec_id j, list_dot_product(x.embedding::double[], y.embedding::double[]) c from embeddings x join embeddings y on x.vec_id < y.vec_id)"
CROSS = "(select x.vec_id id, list_dot_product(x.embedding::double[], y.embedding::double[]) c from embeddings x join embeddings y on x.label < 5 and y.label >= 5)"
BOTH = "(select x.vec_id i, y.vec_id j, list_dot_product(x.embedding::double[], y.embedding::double[]) c from embeddings x join embeddings y on x.vec_id <> y.vec_id)"


def snap_sql(v: str, t: float = 0.03) -> str:
    roots = "".join(f" when abs({v} - ({f})) < {t} then {e!r}::double" for e, f in ((-math.sqrt(0.5), -0.7071), (-math.sqrt(3) / 2, -0.8660)))
    near = {d: (f"(round_even({v} * {d}, 0) / {d})", f"abs({v} - round_even({v} * {d}, 0) / {d})") for d in (2, 3, 4)}
    fit = {d: f"case when {n} between -1 - 1e-9 and 0.5 + 1e-9 and {away} < {t} then {away} end" for d, (n, away) in near.items()}
    least = f"least({', '.join(fit.values())})"
    tail = "".join(f" when ({fit[d]}) = {least} then {near[d][0]}" for d in (2, 3, 4))
    return f"(case when {v} > 0.5 + {t} then null when abs({v} - 0.5) < {t} then 0.5::double when abs({v} + 0.5) < {t} then -0.5::double when abs({v}) < {t} then 0.0::double when abs({v} + 1) < {t} then -1.0::double{roots}{tail} end)"


HISTOGRAM = f"(select cast(round_even(c * 1000, 0) as bigint) as key, count(*) n from {PAIRS} group by 1)"
FREQUENT = f"(select key, n from {HISTOGRAM} where n >= greatest(15, (select cast(floor(0.02 * count(*)) as int) from embeddings)) and key <= 510)"
ALPHABET = f"(select cast(row_number() over (order by cos) - 1 as int) as action, cos from (select distinct {snap_sql('(key / 1000.0::double)')} cos from {FREQUENT} union select unnest([-1.0::double, 0.0::double, 0.5::double])) where cos is not null)"


@query(f"select i, j, round(c, 6) as cos from {PAIRS}")
def gram_pairs(spark, d):
    return gram.pair_cosines(table(spark, d, "embeddings"), places=6)


@query(f"select i as vec_id, round(max(c), 6) as max_cos, count(*) filter (c > 0.3) as n_over, bool_or(c > 0.3) as crowded from {BOTH} group by i")
def gram_threshold_summary(spark, d):
    out = gram.row_extremes(table(spark, d, "embeddings"), 0.3)
    return out.select(F.col("id").alias("vec_id"), F.round("max_cos", 6).alias("max_cos"), "n_over", (F.col("n_over") > 0).alias("crowded"))


@query("select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))), 6) as length, round(embedding[1]::double / sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))), 6) as first from embeddings")
def normalize_vectors_norm(spark, d):
    e = F.col("embedding")
    return table(spark, d, "embeddings").select("vec_id", F.round(C.norm(e), 6).alias("length"), C.rounded(C.normalised(e)[0], 6).alias("first"))


@query(f"select vec_id, neighbour, cos from (select i as vec_id, j as neighbour, round(c, 6) as cos, row_number() over (partition by i order by round(c, 6) desc, j) k from {BOTH}) where k = 1")
def nearest_neighbor_top1(spark, d):
    return bounds.nearest(table(spark, d, "embeddings"))[0].select(F.col("id").alias("vec_id"), "neighbour", "cos")


def contact(spark, d):
    e = table(spark, d, "embeddings")
    return gram.contacts(e.filter("label < 5"), e.filter("label >= 5"), 0.2)


@query(f"select id as vec_id, round(max(c), 6) as max_cos from {CROSS} group by id having max(c) <= 0.4 and max(c) >= 0.25")
def overlap_contact_filter(spark, d):
    e = table(spark, d, "embeddings")
    near, _ = bounds.contacts_within(e.filter("label < 5"), e.filter("label >= 5"), 0.25)
    return near.filter(F.col("max_cos") <= 0.4).select(F.col("id").alias("vec_id"), F.round("max_cos", 6).alias("max_cos"))


@query(f"select round(avg(100 * overlap - case when (select count(*) from embeddings where label >= 5) < 128 then 0.1 * m else 0 end), 6) as loss from (select sum(power(greatest(c - 0.2, 0), 2)) overlap, max(c) m from {CROSS} group by id)")
def overlap_loss(spark, d):
    spheres = table(spark, d, "embeddings").filter("label >= 5").count()
    return gram.overlap_loss(contact(spark, d), spheres, 64).select(F.round("loss", 6).alias("loss"))


@query(f"select key, cast(n as bigint) as n from {FREQUENT}")
def cosine_histogram(spark, d):
    e = table(spark, d, "embeddings")
    return gram.frequent(gram.histogram(e), e.count()).select("key", "n")


@query(f"select action, round(cos, 9) as cos, (select count(*) from {FREQUENT} f where {snap_sql('(f.key / 1000.0::double)')} = x.cos) as n_keys from {ALPHABET} x")
def alphabet_discovery(spark, d):
    e = table(spark, d, "embeddings")
    counts = stored(gram.histogram(e))
    keys = gram.frequent(counts, e.count()).groupBy(C.snapped(F.col("key") / 1000).alias("cos")).agg(F.count("*").alias("n_keys"))
    return gram.alphabet(counts, e.count()).join(keys, "cos", "left").select("action", F.round("cos", 9).alias("cos"), F.coalesce("n_keys", F.lit(0)).alias("n_keys"))


@query(f"select round(entry, 3) as entry, count(*) as n from (select case when {snap_sql('r')} is not null then {snap_sql('r')} when abs(r) < 0.1 then 0.0 when abs(r - 0.5) < 0.1 then 0.5 when abs(r + 0.5) < 0.1 then -0.5 else r end entry from (select round(c, 6) r from {PAIRS})) group by 1")
def snap_gram(spark, d):
    return gram.entries(table(spark, d, "embeddings")).select((F.col("key") / 1000).alias("entry"), "n")


@query(f"select label, count(*) as n_pairs, count(*) filter (w) as n_listed, bool_and(w) as all_listed from (select label, exists (select 1 from {ALPHABET} where abs(cos - c) <= 2e-3) w from (select round(c, 6) c, label from {PAIRS} p join embeddings e on e.vec_id = p.i)) group by label")
def alphabet_whitelist(spark, d):
    e = table(spark, d, "embeddings")
    values = [r.cos for r in gram.alphabet(gram.histogram(e), e.count()).collect()]  # thirteen at most
    both = gram.listed_by_row(e, values).join(e.select(F.col("vec_id").alias("i"), "label"), "i").groupBy("label").agg(F.sum("n").alias("n_pairs"), F.sum("k").alias("n_listed"))
    return both.select("label", "n_pairs", "n_listed", (F.col("n_pairs") == F.col("n_listed")).alias("all_listed"))


@query(f"select s, a, n, round(n / sum(n) over (partition by s), 6) as p from {E}")
def policy_visit_counts(spark, d):
    return search.policy(search.edges(trace(spark, d)), 1.0).select("s", "a", "n", F.round("p", 6).alias("p"))


@query(f"select s, a, round(n * n / sum(n * n) over (partition by s), 6) as p from {E}")
def policy_temperature(spark, d):
    return search.policy(search.edges(trace(spark, d)), 0.5).select("s", "a", F.round("p", 6).alias("p"))


@query(f"select s, a, list_transform(range(5), lambda i: case when i = a then 1.0::double else 0.0::double end) as p from (select s, a, row_number() over (partition by s order by n desc, a) k from {E}) where k = 1")
def policy_greedy(spark, d):
    return search.greedy(search.edges(trace(spark, d))).select("s", "a", C.one_hot(F.col("a"), 5).alias("p"))


FULL = f"(select x.s, x.a, e.n, e.q from (select s, cast(a as int) a from (select distinct user_id s from events), unnest(range(5)) r(a)) x left join {E} e on e.s = x.s and e.a = x.a)"
DAY_FULL = f"(select x.s, x.a, e.n from (select s, cast(a as int) a from (select distinct user_id s from events), unnest(range(5)) r(a)) x left join (select user_id s, cast({A} as int) a, count(*) n from events where dayofmonth(ts) <= 2 group by 1, 2) e on e.s = x.s and e.a = x.a)"


@query(f"select s, a, round(case when t > 0 then coalesce(n, 0) / t when l > 0 then v / l else 0.2 end, 6) as p from (select s, a, n, v, sum(coalesce(n, 0)) over (partition by s) t, sum(v) over (partition by s) l from (select s, a, n, cast((s + a) % 7 < 3 as int) v from {DAY_FULL}))")
def policy_zero_visit_fallback(spark, d):
    first = table(spark, d, "events").filter(F.dayofmonth("ts") <= 2)
    edge = first.select(F.col("user_id").alias("s"), action().alias("a")).groupBy("s", "a").agg(F.count("*").alias("n"))
    states = table(spark, d, "events").select(F.col("user_id").alias("s")).distinct()
    full = search.expanded(states, edge, actions(spark)).withColumn("valid", (F.col("s") + F.col("a")) % 7 < 3)
    return search.with_fallback(full).select("s", "a", F.round("p", 6).alias("p"))


@query(f"select s, a, u from (select s, a, u, row_number() over (partition by s order by u desc, a) k from (select s, a, round(coalesce(q, 0) + 2.0 * 0.2 * sqrt(sum(coalesce(n, 0)) over (partition by s) + 1e-8) / (1 + coalesce(n, 0)), 6) u from {FULL})) where k = 1")
def puct_select(spark, d):
    t = trace(spark, d)
    full = search.expanded(t.select("s").distinct(), search.edges(t), actions(spark)).withColumn("prior", F.lit(0.2))
    return search.selection(full, SETTINGS.exploration)


@query(f"with x as (select s, list(p order by a) p, list(v order by a) v from (select s, a, round(coalesce(n, 0) / sum(coalesce(n, 0)) over (partition by s), 9) p, (s + a) % 5 < 2 v from {FULL}) group by s), y as (select s, list_sum(list_transform(list_zip(p, v), lambda z: case when z[2] then z[1] else 0 end)) t, list_sum(list_transform(v, lambda b: b::int)) l, p, v from x) select s, list_transform(list_zip(p, v), lambda z: round(case when t > 0 then case when z[2] then z[1] else 0 end / t else z[2]::int::double / l end, 6)) as p from y")
def masked_prior(spark, d):
    t = trace(spark, d)
    full = search.expanded(t.select("s").distinct(), search.edges(t).select("s", "a", "n"), actions(spark))
    rows = full.groupBy("s").agg(F.sort_array(F.collect_list(F.struct("a", F.coalesce("n", F.lit(0)).alias("n")))).alias("x"))
    sizes = F.transform("x", lambda x: x["n"].cast("double"))
    listed = rows.select("s", sizes.alias("n"), F.transform("x", lambda x: (F.col("s") + x["a"]) % 5 < 2).alias("v"))
    prior = listed.select("s", "v", F.transform("n", lambda n: F.round(n / C.total(F.col("n")), 9)).alias("prior"))
    return prior.select("s", F.transform(C.masked_prior(F.col("prior"), F.col("v")), lambda p: F.round(p, 6)).alias("p"))


@query(f"select s, a, n, round(q, 6) as q from {E}")
def backup_mean_batch(spark, d):
    return search.edges(trace(spark, d)).select("s", "a", "n", F.round("q", 6).alias("q"))


@query(f"select sim, s, a, count(*) over w as n, round(avg(v) over w, 6) as q from {T} window w as (partition by s, a order by sim rows unbounded preceding)")
def backup_running_mean(spark, d):
    return search.running_backup(trace(spark, d)).select("sim", "s", "a", "n", F.round("q", 6).alias("q"))


@query("select distinct user_id as s from events where user_id not in (select user_id from events where ts < timestamp '2024-01-01 06:00:00')")
def unexpanded_states(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("s"), "ts")
    return search.unexpanded(e.select("s").distinct(), e.filter("ts < timestamp_ntz'2024-01-01 06:00:00'").select("s").distinct())


@query("select event_id, row_number() over w > 5 and coalesce(list_contains(list(cast(floor(value) as bigint)) over (partition by user_id order by event_id rows between 10 preceding and 1 preceding), cast(floor(value) as bigint)), false) as repeat from events window w as (partition by user_id order by event_id)")
def recent_repeat_guard(spark, d):
    path = table(spark, d, "events").select("event_id", F.col("user_id").alias("path"), F.col("event_id").alias("step"), F.floor("value").alias("s"))
    return search.repeats(path).select("event_id", "repeat")


@query("select event_id as step, greatest(1.0, coalesce(max(case when event_type <> 'error' then value end) over (partition by user_id order by event_id rows unbounded preceding), 1.0)) as best from events")
def episode_running_best(spark, d):
    return episodes.running_best(steps(spark, d)).select("step", "best")


RESULTS = "(select cast(dayofmonth(ts) as int) iter, user_id % 4 as rank, user_id episode, max(value) m from events group by 1, 2, 3)"


def results(spark, d):
    e = steps(spark, d).groupBy("iter", "episode").agg(F.max("m").alias("m"))
    return e.withColumn("rank", F.col("episode") % 4)


@query(f"select iter, rank, episode, m from (select *, row_number() over (partition by iter, rank order by m desc, episode) k from {RESULTS}) where k = 1")
def best_per_worker(spark, d):
    return episodes.best_by(results(spark, d), "iter", "rank").select("iter", "rank", "episode", "m")


@query(f"select iter, rank, episode, m from (select *, row_number() over (partition by iter order by m desc, rank, episode) k from {RESULTS}) where k = 1")
def best_global(spark, d):
    return episodes.best_by(results(spark, d), "iter").select("iter", "rank", "episode", "m")


ITERATIONS = "(select cast(dayofmonth(ts) as int) as iter, max(value) as m from events group by 1)"
BEST = f"(select iter, m, max(m) over (order by iter rows unbounded preceding) as best, coalesce(m > max(m) over (order by iter rows between unbounded preceding and 1 preceding), true) as improved from {ITERATIONS})"


def iterations(spark, d):
    return episodes.improvements(steps(spark, d).groupBy("iter").agg(F.max("m").alias("m")))


@query(f"select iter, m, best, improved from {BEST}")
def best_ever_improvements(spark, d):
    return iterations(spark, d)


@query(f"select iter, array_to_string(list_filter(['temp', case when improved then 'best_ever' end, case when iter % 10 = 0 then 'checkpoint_' || iter end], lambda x: x is not null), ',') as names from {BEST}")
def checkpoint_cadence(spark, d):
    return iterations(spark, d).select("iter", F.array_join(checkpoint_names(F.col("iter"), F.col("improved")), ",").alias("names"))


@query("select event_id as step, cast(dayofmonth(ts) as int) as iter from events where dayofmonth(ts) in (select distinct dayofmonth(ts) from events order by 1 desc limit 20)")
def replay_retention(spark, d):
    return episodes.retained(steps(spark, d), SETTINGS.history).select("step", "iter")


@query("select event_id as step, round(greatest(-1, least(1, 2 * (r - 0) / (75 - 0 + 1e-5) - 1)), 6) as reward from events join (select user_id, max_by(value, event_id) r from events group by user_id) using (user_id)")
def reward_backfill(spark, d):
    return episodes.with_reward(steps(spark, d), SETTINGS.reward_min, SETTINGS.reward_max).select("step", F.round("reward", 6).alias("reward"))


@query("select event_id as step, cast(row_number() over w as int) as nth, case when row_number() over w < 15 then 1 else 0 end as temperature from events window w as (partition by user_id order by event_id)")
def temperature_switch(spark, d):
    return episodes.with_temperature(steps(spark, d), SETTINGS.temperature_threshold).select("step", "nth", "temperature")


@query("select event_id, cast(k as int) as step, round(case when k >= 31 then 1 - (k - 31) / (300 - 31 + 1e-8) else k / 31 end, 9) as rate, round(0.5 * (1 + cos(pi() * k / 300)), 9) as cosine from (select event_id, row_number() over (partition by user_id order by event_id) - 1 k from events)")
def lr_schedule(spark, d):
    """Learning rates of 300 steps, where a step is the place of an event among its user's."""
    step = F.col("place")
    placed = ranks.placed(table(spark, d, "events").select("user_id", "event_id"), "user_id", "event_id")
    return placed.select("event_id", step.cast("int").alias("step"), F.round(C.warm_up_rate(step, 300), 9).alias("rate"), F.round(C.cosine_rate(step, 300), 9).alias("cosine"))


@query("select event_type, round(sum(value * w), 4) as sum, cast(sum(w) as bigint) as count, round(sum(value * w) / sum(w), 6) as avg from (select event_type, value, 1 + event_id % 3 as w from events) group by event_type")
def weighted_meter(spark, d):
    e = table(spark, d, "events").select("event_type", "value", (1 + F.col("event_id") % 3).alias("weight"))
    return episodes.meter(e, "event_type").select("event_type", F.round("sum", 4).alias("sum"), "count", F.round("avg", 6).alias("avg"))


@query(f"with x as (select s, a, n / sum(n) over (partition by s) p, q / 100 z from {E}), y as (select s, a, p, z, z - ln(sum(exp(z)) over (partition by s)) lp from x) select round(avg(ce), 6) as cross_entropy, round(avg(se), 6) as squared_error from (select s, -sum(p * lp) ce, power(sum(p * z) - 0.2, 2) se from y group by s)")
def loss_ce_mse(spark, d):
    edge = search.policy(search.edges(trace(spark, d)), 1.0)
    return learn.losses(edge.select("s", "p", (F.col("q") / 100).alias("z")), 0.2).select(F.round("cross_entropy", 6).alias("cross_entropy"), F.round("squared_error", 6).alias("squared_error"))


@query("select user_id as rank, cast(user_id % 8 as int) as device, cast(greatest(1, count(*) // 64) as int) as episodes, 'run_d6_r' || user_id as name from events group by user_id")
def batch_split(spark, d):
    """The events of each user, a worker, in 64 batches: its device, batch size and name."""
    n = table(spark, d, "events").groupBy(F.col("user_id").alias("rank")).agg(F.count("*").alias("n"))
    return n.select("rank", C.placement(F.col("rank"), 8).cast("int").alias("device"), C.batch_sizes(F.col("n"), 64).cast("int").alias("episodes"), F.concat(F.lit("run_d6_r"), F.col("rank").cast("string")).alias("name"))


@query("select vec_id, list_transform(range(8), lambda i: i >= label) as padded, list_transform(range(16), lambda i: round(embedding[i // 2 + 1 + (i % 2) * 8]::double, 6)) as token from embeddings")
def board_tokens(spark, d):
    e = F.col("embedding").cast("array<double>")
    return table(spark, d, "embeddings").select("vec_id", C.padding_mask(F.col("label"), 8).alias("padded"), F.transform(C.tokens(F.slice(e, 1, 8), F.slice(e, 9, 8)), lambda x: C.rounded(x, 6)).alias("token"))


@query(f"select i, j, round(c, 6) as cos from {PAIRS} where i < 10 and j < 10")
def gram_head(spark, d):
    return gram.pair_cosines(table(spark, d, "embeddings").filter("vec_id < 10"), places=6)


@query("select * from (values (0, 1.0::double, 0.0::double), (1, 0.5::double, round(sqrt(0.75), 9))) t(sphere_id, x, y)")
def start_spheres(spark, d):
    start = simulate.start_spheres(spark, 2)
    return start.select("sphere_id", F.round(F.col("v")[0], 9).alias("x"), F.round(F.col("v")[1], 9).alias("y"))


@query(f"select s, a from (select s, a, upto, row_number() over (partition by s order by a) k from (select s, a, sum(n) over (partition by s order by a) / sum(n) over (partition by s)::double upto from {E}) where upto > (s % 97) / 97.3::double) where k = 1")
def action_sample(spark, d):
    return search.sampled(search.policy(search.edges(trace(spark, d)), 1.0), (F.col("s") % 97) / F.lit(97.3))


VOLUMES = """
with recursive p as materialized (select label r, vec_id id, embedding::double[] v, row_number() over (partition by label order by vec_id) - 1 place from embeddings),
d(r, t, n, j, c) as (select r, t, n, 0, []::bigint[] from (select r, count(*) n from p group by r), range(5000) u(t) where n > 6
 union all select r, t, n, j + 1, list_sort(list_append(c, list_reduce(c, lambda x, y: case when x >= y then x + 1 else x end, ('0x' || substr(md5(concat_ws(':', r, t, j)), 1, 8))::bigint % (n - j)))) from d where j < 6),
x as (select r, t, list(id order by id) ids, list(v order by id) vs from (select r, t, unnest(c) place from d where j = 6) join p using (r, place) group by r, t),
e(r, t, ids, k, g, volume) as (select r, t, ids, 1, list_transform(range(1, 7), lambda i: list_transform(range(1, 7), lambda j: list_dot_product(vs[i], vs[j]) + case when i = j then 1e-6 else 0 end)), 0.0::double from x
 union all select r, t, ids, k + 1, list_transform(range(1, 7), lambda i: list_transform(range(1, 7), lambda j: case when i > k then g[i][j] - g[i][k] * g[k][j] / g[k][k] else g[i][j] end)), volume + ln(g[k][k]) from e where k < 7),
b as (select r, ids, volume, row_number() over (partition by r order by volume desc, t) nth from e where k = 7)
select r::bigint as round, ids, round(volume, 6) as log_volume, row_number() over (order by volume desc, r) = 1 as best from b where nth = 1"""


@query(VOLUMES)
def max_volume_basis(spark, d):
    """The dim-subset of greatest log-determinant of each label's vectors, and the best of all."""
    return geometry.volume_bases(table(spark, d, "embeddings").select(F.col("label").alias("round"), F.col("vec_id").alias("id"), F.col("embedding").alias("v")), 6)


def _roots() -> str:
    """Gram entries and cosines of states of root vectors, as DuckDB reads them: the dot products of pieces dim places apart."""
    at = lambda k: f"v[(c + {k}) % len(v) + 1]"
    sign = lambda k: f"case when {at(k)} < 0 then -1.0 else 1.0 end"
    least = f"case when abs({at(2)}) <= abs({at(0)}) and abs({at(2)}) <= abs({at(1)}) then 2 when abs({at(1)}) <= abs({at(0)}) then 1 else 0 end"
    piece = f"[{', '.join(f'case when {least} = {k} then 0.0 else {sign(k)} end::double' for k in range(3))}]"
    roots = f"select state, v, list_transform(range(len(v)), lambda c: {piece}) q from (select vec_id state, embedding::double[] v from embeddings)"
    own = ", ".join(f"q[(place + {3 * j}) % len(q) + 1] s{j}" for j in range(5))
    return f"(select state, cast(place as int) as place, cast(2 + place % 3 as int) m, {own} from ({roots}), range(64) t(place))"


def _finalisation() -> str:
    """Definiteness by determinants below full rank; Cramer's rule in three dimensions from there on."""
    cos = lambda i, j: f"list_dot_product(s{i}, s{j}) / 2"
    given = ", ".join([*(f"{cos(i, j)} g{i}{j}" for i, j in ((0, 1), (0, 2), (1, 2), (0, 3), (1, 3), (2, 3))), *(f"case m when 2 then {cos(i, 2)} when 3 then {cos(i, 3)} else {cos(i, 4)} end b{i}" for i in (0, 1))])
    det = "(1 + 2 * g01 * g02 * g12 - g01 * g01 - g02 * g02 - g12 * g12)"
    x = (
        f"(b0 * (1 - g12 * g12) - g01 * (b1 - g12 * b) + g02 * (b1 * g12 - b)) / nullif({det}, 0)",
        f"((b1 - g12 * b) - b0 * (g01 - g12 * g02) + g02 * (g01 * b - b1 * g02)) / nullif({det}, 0)",
        f"((b - b1 * g12) - g01 * (g01 * b - b1 * g02) + b0 * (g01 * g12 - g02)) / nullif({det}, 0)",
    )
    listed = lambda c: f"least(abs({c} + 1), abs({c} + 0.5), abs({c}), abs({c} - 0.5)) <= 2e-3"
    full = f"coalesce(abs(x0 * b0 + x1 * b1 + x2 * b - 1) <= 1e-3 and {listed('b0')} and {listed('b1')} and {listed('b')} and (m = 3 or {listed('(g03 * x0 + g13 * x1 + g23 * x2)')}), false)"
    below = "1.0000001 * 1.0000001 - g01 * g01 > 0 and power(1.0000001, 3) + 2 * g01 * b0 * b - 1.0000001 * (g01 * g01 + b0 * b0 + b * b) > 0"
    solved = f"select *, {', '.join(f'{e} x{i}' for i, e in enumerate(x))} from (select state, place, m, {given} from {_roots()}), (values (0, -1.0::double), (1, -0.5::double), (2, 0.0::double), (3, 0.5::double)) t(action, b)"
    return f"select state, place, m, cast(action as int) as action, b as cos, case when m = 2 then {below} else {full} end as valid from ({solved})"


@query(_finalisation())
def sphere_finalisation(spark, d):
    """Legality of every action in states of root vectors, two under and of full rank, that all coordinates of the embeddings give."""
    states = geometry.root_states(table(spark, d, "embeddings")).withColumn("spheres", F.col("m"))
    return geometry.legal_actions(states, [-1.0, -0.5, 0.0, 0.5]).select("state", "place", F.col("spheres").alias("m"), "action", "cos", "valid")


TRIPLES = (
    "(select vec_id, round(list_inner_product(u, v), 6) c, round(list_inner_product(u, w), 6) a from (select vec_id, embedding::double[] u, lead(embedding::double[], 1) over k v, lead(embedding::double[], 2) over k w"
    " from embeddings window k as (partition by label order by vec_id)) where w is not null)"
)


@query(f"select vec_id as state, cast(action as int) as action, b as cos, 1.0000001 * 1.0000001 - c * c > 0 and power(1.0000001, 3) + 2 * a * b * c - 1.0000001 * (a * a + b * b + c * c) > 0 as valid from {TRIPLES}, (values (0, -1.0::double), (1, -0.5::double), (2, 0.0::double), (3, 0.5::double)) t(action, b)")
def legality_of_third_sphere(spark, d):
    """Legal last cosines of a third sphere, for every three consecutive vectors of a label."""
    return geometry.legal_actions(geometry.pair_states(table(spark, d, "embeddings")), [-1.0, -0.5, 0.0, 0.5]).select("state", "action", "cos", "valid")


@query(ORACLES["legality_of_third_sphere"])
def legality_by_table_function(spark, d):
    """The same by SQL: every state's legal actions from a table function that is called laterally."""
    tables.register(spark)
    states = geometry.pair_states(table(spark, d, "embeddings"))
    return spark.sql("select s.state, x.* from {states} s, lateral legal_actions(s.m, s.gram, s.partial, array(-1.0D, -0.5D, 0.0D, 0.5D), 3) x", states=states)


@query("select event_id as step, cast(dayofmonth(ts) as int) as iter, value as m from events where dayofmonth(ts) > (select max(dayofmonth(ts)) from events) - 20")
def replay_round_trip(spark, d):
    """The last 20 iterations of a replay store that all steps were written to."""
    every, path = steps(spark, d), new_store(spark, "replay")
    append_replay(every.select("iter", "step", "m"), path)
    last = every.agg(F.max("iter").alias("iter")).first().iter
    return read_replay(spark, path, SETTINGS.history, last or 0).select("step", "iter", "m")


@query("select cast(dayofmonth(ts) as int) as iter, unnest(['best', 'mean', 'steps']) as name, round(unnest([max(value), avg(value), count(*)::double]), 6) as value from events group by 1")
def metrics_round_trip(spark, d):
    """Metrics of every iteration, from a store that they were written to."""
    each = steps(spark, d).groupBy("iter").agg(F.max("m").alias("best"), F.avg("m").alias("mean"), F.count("*").cast("double").alias("steps"))
    path = new_store(spark, "metrics")
    append_metrics_of(each, path)
    return read_store(spark, path).select("iter", "name", F.round("value", 6).alias("value"))


def event_stream(spark: SparkSession, d: str) -> DataFrame:
    kind = table(spark, d, "events").schema
    return spark.readStream.schema(kind).option("pathGlobFilter", "events.parquet").option("recursiveFileLookup", "true").parquet(d)


@query("select strftime(time_bucket(interval '1 hour', ts), '%Y-%m-%d %H') as hour, max(value) as best from events group by 1")
def windowed_best_stream(spark, d):
    """The best value of every hour of event time, from a stream of the events."""
    path = new_store(spark, "windows")
    replay.follow_best(event_stream(spark, d).select("ts", F.col("value").alias("m")), path, f"{path}-checkpoint").awaitTermination()
    return read_store(spark, path).select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), F.col("m").alias("best"))


@query(f"select sim, s, a, count(*) over edge as n, round(avg(v) over edge, 6) as q, greatest(1.0, max(v) over (partition by s order by sim rows unbounded preceding)) as best from {T} window edge as (partition by s, a order by sim rows unbounded preceding)")
def backup_running_stream(spark, d):
    """Running means of edges and the best so far of every state, from a stream of the events that keeps them as state.

    A user has a few events a day, so a slice is a week.
    """
    path = new_store(spark, "running")
    rows = event_stream(spark, d).select(F.col("user_id").alias("s"), action().alias("a"), F.col("value").alias("v"), F.col("event_id").alias("sim"), "ts")
    state.follow_running(rows, path, f"{path}-checkpoint", slice_ms=7 * 86_400_000).awaitTermination()
    return state.all_running(spark, path, f"{path}-checkpoint").select("sim", "s", "a", "n", F.round("q", 6).alias("q"), "best")


@query(f"select cast(round_even((c::float * 1000::float)::double, 0) as bigint) as key, count(*) as n from {PAIRS} group by 1")
def cosine_histogram_single(spark, d):
    """All pairs by cosine in thousandths, in single precision throughout."""
    return gram.histogram(table(spark, d, "embeddings"), single=True)


METRICS = "select cast(dayofmonth(ts) as int) as iter, unnest(['best', 'mean', 'steps']) as name, round(unnest([max(value), avg(value), count(*)::double]), 6) as value from events group by 1"


@query(METRICS)
def metrics_stream(spark, d):
    """The same metrics, from a store that a stream of the events was written to."""
    path = new_store(spark, "metrics-stream")
    metrics.follow_metrics(event_stream(spark, d).select(F.dayofmonth("ts").alias("iter"), F.col("value").alias("m")), path, f"{path}-checkpoint").awaitTermination()
    return metrics.read_metrics(spark, path).select("iter", "name", F.round("value", 6).alias("value"))


@query("select vec_id, count(*) filter (where len(list_filter(l, lambda a: abs(a - x) <= 2e-4)) > 0) as n_listed, count(*) as n from (select vec_id, unnest(embedding)::double x from embeddings), (select list(distinct round(embedding[1]::double, 6)) l from embeddings) group by vec_id")
def listed_coordinates(spark, d):
    """How many of each vector's coordinates are near one of the alphabet of all first coordinates."""
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    found = listed.listed(e.select("vec_id", F.explode("v").alias("x")), e.select(F.round(F.col("v")[0], 6).alias("a")), 2e-4)
    return found.groupBy("vec_id").agg(F.count(F.when(F.col("listed"), 1)).alias("n_listed"), F.count("*").alias("n"))


@query()
def merged_states(spark, d):
    """States of root vectors that are equal but for the order of their spheres, as one: its key, how many they are, and the first."""
    out = canonical.merged(geometry.root_states(table(spark, d, "embeddings")), F.col("state"), F.col("place"))
    return out.select("key", "n", "first.state", "first.place", "first.m", "first.partial")


ACTIONS_SQL = "(values (0, -1.0::double), (1, -0.5::double), (2, 0.0::double), (3, 0.5::double)) t(action, b)"
#: Whether a third sphere with cosines a and b to two spheres at cosine c exists, up to the jitter.
THIRD = "1.0000001 * 1.0000001 - c * c > 0 and power(1.0000001, 3) + 2 * a * b * c - 1.0000001 * (a * a + b * b + c * c) > 0"


@query(
    f"select state, action, case when k = 2 and fits then 3 else 2 end as m, case k when 0 then true when 1 then false else not fits end as is_dead, case k when 0 then [a] when 1 then [b] else []::double[] end as partial,"
    f" case when k = 2 and fits then [1.0, c, a, c, 1.0, b, a, b, 1.0]::double[] else [1.0, c, c, 1.0]::double[] end as gram from (select vec_id as state, cast(action as int) as action, vec_id % 3 k, a, b, c, {THIRD} fits from {TRIPLES}, {ACTIONS_SQL})"
)
def micro_steps(spark, d):
    """What each action makes of dead states, states with an empty row, and states whose row it completes."""
    pairs, kind = geometry.pair_states(table(spark, d, "embeddings")), F.col("state") % 3
    empty = F.expr("cast(array() as array<double>)")
    states = pairs.withColumn("is_dead", kind == 0).withColumn("partial", F.when(kind == 1, empty).otherwise(F.col("partial")))
    return geometry.micro_steps(states, [-1.0, -0.5, 0.0, 0.5]).drop("cos")


@query(f"with t as (select * from {ACTIONS_SQL}) select actions, case when {THIRD} then 3 else 2 end as m from (select [x.action, y.action, z.action]::int[] as actions, x.b c, y.b a, z.b b from t x, t y, t z)")
def frontier_growth(spark, d):
    """The states after three actions from a single sphere: the second sphere, and the two cosines of the third."""
    return geometry.frontier(geometry.start_states(spark), [-1.0, -0.5, 0.0, 0.5], 3).select("actions", "m")


@query(
    "with recursive c as (select label, vec_id, embedding::double[] v, row_number() over (partition by label order by vec_id) k from embeddings),"
    " g(label, k, ids, vs) as (select distinct label, 0::bigint, []::bigint[], []::double[][] from c union all select label, k, case when ok then list_append(ids, vec_id) else ids end, case when ok then list_append(vs, v) else vs end"
    " from (select g.label, c.k, ids, vs, vec_id, v, len(ids) < 10 and len(list_filter(vs, lambda x: list_dot_product(x, c.v) > 0.2)) = 0 ok from g join c on c.label = g.label and c.k = g.k + 1))"
    " select label as round, unnest(ids) as id, cast(unnest(range(len(ids))) as int) as place from (select label, max_by(ids, k) ids from g group by label)"
)
def greedy_acceptance(spark, d):
    """Of each label's vectors, in the order of their ids, the first ten that have no larger cosine than 0.2 with each other."""
    offered = table(spark, d, "embeddings").select(F.col("label").alias("round"), F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    return simulate.first_independent(offered, "id", 0.2).select("round", "id", "place")


@query("select label as round, count(*) as n, (select count(*) from embeddings) as total from embeddings group by label")
def round_sizes(spark, d):
    return simulate.round_sizes(table(spark, d, "embeddings").select(F.col("label").alias("round")))


@query()
def greedy_packing(spark, d):
    """All ten rounds in three dimensions, with 1024 candidates a round and step and 150 gradient steps."""
    return simulate.packed_spheres(spark, 3)


@query()
def seed_discovery(spark, d):
    return simulate.discover(spark, 3)[1]


@query()
def selfplay_episodes(spark, d):
    return selfplay.play(spark, dim=3, upper_bound=14, cosines=[-1.0, -0.5, 0.0, 0.5], workers=4, episodes=2, simulations=24, seed=1).select("rank", "episode", "step", "m", "is_dead", "action", "pi", "reward")


def replay_examples(spark: SparkSession, d: str) -> DataFrame:
    """id, x, pi, reward: every event with its state's visits as policy and its episode's last value as reward."""
    e, t = steps(spark, d), trace(spark, d)
    full = search.expanded(t.select("s").distinct(), search.edges(t).select("s", "a", "n"), actions(spark))
    listed = full.groupBy(F.col("s").alias("episode")).agg(F.sort_array(F.collect_list(F.struct("a", F.coalesce("n", F.lit(0)).cast("double").alias("n")))).alias("x"))  # five actions
    policy = listed.select("episode", F.transform("x.n", lambda n: n / C.total(F.col("x.n"))).alias("pi"))
    x = F.array(F.lit(1.0), F.col("m") / 100, F.col("iter") / 31, F.col("is_dead").cast("double"))
    return episodes.with_reward(e, SETTINGS.reward_min, SETTINGS.reward_max).join(policy, "episode").select(F.col("step").alias("id"), x.alias("x"), "pi", "reward")


UNIFORM = "('0x' || substr(md5(concat_ws(':', {})), 1, 8))::bigint / 4294967296.0"
GRADIENT = f"""
with e as (select event_id id, [1.0, value / 100, dayofmonth(ts) / 31, (event_type = 'error')::int::double] x, pi, greatest(-1, least(1, 2 * r / (75 + 1e-5) - 1)) z
 from events join (select user_id, max_by(value, event_id) r from events group by user_id) using (user_id)
 join (select s, list(p order by a) pi from (select s, a, coalesce(n, 0) / sum(coalesce(n, 0)) over (partition by s) p from {FULL}) group by s) on s = user_id),
k as (select n // least(256, n) steps, n // least(256, n) * least(256, n) / n r from (select count(*) n from e)),
p as (select steps, list_transform(range(12), lambda i: list_sum(list_transform(range(i + 1), lambda j: exp(-r) * power(r, j) / factorial(j::int)))) upto from k),
d as (select *, unnest(range(1, 1 + len(list_filter(upto, lambda c: c <= u)))) draw from (select *, {UNIFORM.format("0, 0, id")} u from e, p)),
b as (select x, pi, z from d where floor({UNIFORM.format("1, 0, id, draw")} * steps) = 0)
select 'policy' as head, cast(f as int) as feature, cast(a as int) as action, round(avg(x[f + 1] * (0.2 - pi[a + 1])), 9) as slope from b, range(4) u(f), range(5) v(a) group by f, a
union all select 'value', cast(f as int), null, round(avg(2 * x[f + 1] * (0 - z)), 9) from b, range(4) u(f) group by f"""


@query(GRADIENT)
def policy_value_gradient(spark, d):
    """The mean gradient of the first minibatch of a fit of all events."""
    return learn.first_gradient(replay_examples(spark, d), 4, len(ACTIONS)).withColumn("slope", F.round("slope", 9))


@query()
def policy_value_fit(spark, d):
    """Losses of three epochs of minibatches over all events, in one barrier stage."""
    return learn.fitted_losses(replay_examples(spark, d), 4, len(ACTIONS), 3)


MODEL = GRADIENT.replace("\nselect 'policy' as head", ",\ng as materialized (select 'policy' as head").replace("round(avg(x[f + 1] * (0.2 - pi[a + 1])), 9)", "avg(x[f + 1] * (0.2 - pi[a + 1]))").replace("round(avg(2 * x[f + 1] * (0 - z)), 9)", "avg(2 * x[f + 1] * (0 - z))")
#: One step of Adam from zero moves each weight by the rate, against its gradient.
PREDICTIONS = f"""{MODEL}),
w as materialized (select head, list(-0.05 * slope / (abs(slope) + 1e-8) order by action, feature) w from g group by head),
o as (select id, list_transform(range(5), lambda a: exp(list_sum(list_transform(range(1, 5), lambda f: x[f] * p.w[4 * a + f])))) l, list_sum(list_transform(range(1, 5), lambda f: x[f] * v.w[f])) v from e, (select w from w where head = 'policy') p, (select w from w where head = 'value') v)
select id as event_id, list_transform(l, lambda y: round(y / list_sum(l), 6)) as pi, round(v, 6) as value from o"""


@query(PREDICTIONS)
def model_predictions(spark, d):
    """Policy and value of every event by a model that was fitted for a step, saved under a name, and loaded."""
    examples, path = replay_examples(spark, d), new_store(spark, "models")
    weights = learn.fit_vectors(examples, 4, len(ACTIONS), 1, rate=0.05, most_steps=1).weights
    save_model(spark, path, 1, "temp", {k: v.ravel().tolist() for k, v in weights.items()})
    loaded = load_model(spark, path, "temp")
    model = {"policy": np.array(loaded["policy"]).reshape(4, len(ACTIONS)), "value": np.array(loaded["value"])}
    out = learn.predict_vectors(examples, model, "id")
    return out.select(F.col("id").alias("event_id"), F.transform("pi", lambda x: C.rounded(x, 6)).alias("pi"), C.rounded(F.col("value"), 6).alias("value"))


SHAPE = attention.Shape(bound=8, actions=4, width=32)


def _embedding() -> str:
    """The linear part of the evaluator: the first token times the first matrix of the rule, and its bias."""
    cos = lambda i, j: f"list_dot_product(s{i}, s{j}) / 2"
    last = lambda i: f"case m when 2 then {cos(i, 2)} when 3 then {cos(i, 3)} else {cos(i, 4)} end"
    token = ", ".join(f"{cos(0, i) if i < 2 else f'case when m > {i} then {cos(0, i)} else 0 end'}, {last(0) if i == 0 else f'case when m > 2 then {last(1)} else 0 end' if i == 1 else '0'}" for i in range(4))
    return f"select state, place, list_transform(range(4), lambda j: round(list_sum(list_transform(range(8), lambda i: t[i + 1] * sin(1 + 7 * i + 13 * j) / sqrt(16))) + sin(1 + 13 * j + 17), 6)) as first from (select state, place, [{token}]::double[] t from {_roots()})"


def evaluations(spark: SparkSession, d: str, *give: str) -> DataFrame:
    states = geometry.root_states(table(spark, d, "embeddings")).withColumn("is_dead", F.lit(False))
    return attention.evaluated(states, SHAPE, attention.fixed_weights(SHAPE), "state", "place", give=give)


@query(_embedding())
def board_embeddings(spark, d):
    """The first four numbers of the embedded first token of every state of root vectors."""
    return evaluations(spark, d, "first").select("state", "place", F.transform(F.slice("first", 1, 4), lambda x: C.rounded(x, 6)).alias("first"))


@query()
def board_evaluations(spark, d):
    """Policy and value of every state of root vectors by the attention encoder."""
    return evaluations(spark, d, "pi", "value").select("state", "place", F.transform("pi", lambda x: C.rounded(x, 6)).alias("pi"), F.round("value", 6).alias("value"))
