"""The registered queries: name to function of (spark, folder).  Doubles are rounded to six places, ids cast to bigint."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fingerprint, norm, request
from ..functions import beliefs
from ..operators import cache, credit, facts, gating, ranks, replies, report, rewards, statistics
from ..sources import episodes as source
from . import extraction, fixtures, oracles
from .parameters import DEFAULTS as P

KEY = ("case_id", "traj_id", "t")


def r6(*names: str):
    return [F.round(F.col(n), 6).alias(n) for n in names]


def longs(*names: str):
    return [F.col(n).cast("long").alias(n) for n in names]


def episode_assembly(spark, d) -> DataFrame:
    rows = fixtures.episodes(spark, d)
    return rows.select(F.col("case_id").alias("conv_id"), F.size("dialogue").cast("long").alias("n_turns"), F.array_join("dialogue.role", "|").alias("roles"), F.array_join("dialogue.content", "|").alias("contents"), "conclusion")


def dialogue_fingerprint(spark, d) -> DataFrame:
    return fixtures.episodes(spark, d).select(F.col("case_id").alias("conv_id"), fingerprint(F.col("dialogue")).alias("fp"))


def normalize_text(spark, d) -> DataFrame:
    return fixtures.read(spark, d, "conversations").select("conv_id", "turn", norm(F.col("text")).alias("normed"))


def _fact_rows(wide):
    def query(spark, d) -> DataFrame:
        return facts.by_fact(fixtures.fact_episodes(spark, d, wide)).select(F.col("case_id").alias("conv_id"), *longs("pos"), "category", "name", "reason")

    return query


def facts_per_episode(spark, d) -> DataFrame:
    rows = facts.validated(fixtures.fact_episodes(spark, d, True))
    return rows.select(F.col("case_id").alias("conv_id"), F.size("facts").cast("long").alias("n_kept"), F.size("dropped").cast("long").alias("n_dropped"), F.get("facts", 0)["name"].alias("first_name"), F.get("facts", F.size("facts") - 1)["name"].alias("last_name"))


def facts_report_category(spark, d) -> DataFrame:
    return report.by_category(facts.validated(fixtures.fact_episodes(spark, d)))


def drop_reasons(spark, d) -> DataFrame:
    return report.by_reason(facts.validated(fixtures.fact_episodes(spark, d)))


def episode_counters(spark, d) -> DataFrame:
    return report.counters(facts.validated(fixtures.fact_episodes(spark, d)))


def facts_report(spark, d) -> DataFrame:
    rows = report.report(facts.validated(fixtures.fact_episodes(spark, d)))
    return rows.select("episodes", "failed", "no_facts", *(F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias(m) for m in ("by_category", "drop_reasons")))


def cache_last_wins(spark, d) -> DataFrame:
    return cache.last_entries(fixtures.cache_entries(spark, d)).select("case_id", "seq", "fp")


def cache_hits(spark, d) -> DataFrame:
    rows = cache.with_cache(fixtures.fingerprinted(spark, d), fixtures.cache_entries(spark, d))
    return rows.where("cached is not null").select("case_id", "cached.seq")


def cache_misses(spark, d) -> DataFrame:
    return cache.misses(fixtures.fingerprinted(spark, d), fixtures.cache_entries(spark, d)).select("case_id", "fp")


def limit_per_split(spark, d) -> DataFrame:
    rows = fixtures.read(spark, d, "conversations").where("turn = 0").withColumn("split", F.element_at(F.array(*map(F.lit, ("train", "dev", "test"))), (F.col("conv_id") % 3 + 1).cast("int")))
    return source.first_per_group(rows, 20, "split", F.col("conv_id")).select("split", "conv_id")


def request_json(spark, d) -> DataFrame:
    rows = fixtures.episodes(spark, d)
    made = request(F.col("dialogue"), F.col("conclusion"), F.lit(""))
    back = F.from_json(made, "struct<turns:array<struct<role:string,text:string>>,reference_conclusion:string,department:string>")
    return rows.select(F.col("case_id").alias("conv_id"), back.alias("r")).select("conv_id", F.size("r.turns").cast("long").alias("n_turns"), F.array_join("r.turns.role", "|").alias("roles"), F.array_join("r.turns.text", "|").alias("texts"), F.col("r.reference_conclusion").alias("conclusion"), F.col("r.department").alias("department"))


def reply_parse_status(spark, d) -> DataFrame:
    rows = fixtures.replies(spark, d).withColumn("p", replies.parsed(F.col("raw")))
    return rows.select(F.col("case_id").alias("conv_id"), F.col("p.status").alias("status"), F.when(F.col("p.facts").isNotNull(), F.size("p.facts")).cast("long").alias("n_facts"))


def reply_validation(spark, d) -> DataFrame:
    """All replies parsed and validated: the same outcome as for facts that were never JSON; invalid replies yield none."""
    rows = fixtures.replies(spark, d).withColumn("facts", replies.parsed(F.col("raw"))["facts"])
    return facts.by_fact(rows).groupBy("reason").agg(F.count("*").alias("n"))


def _measured(*columns: str):
    def query(spark, d) -> DataFrame:
        return rewards.measured(fixtures.log(spark, d)).select(*KEY, *r6(*columns))

    return query


def fact_self_information(spark, d) -> DataFrame:
    rows = rewards.fact_reward(fixtures.log(spark, d))
    return rows.select(*KEY, F.size("new_facts").cast("long").alias("n_new"), *r6("r_f"))


def terminal_utility(spark, d) -> DataFrame:
    return rewards.terminal(fixtures.log(spark, d)).select(*KEY, *r6("utility_end"))


def turn_reward(spark, d) -> DataFrame:
    return rewards.rewarded(fixtures.log(spark, d)).select(*KEY, "rejected", "paid", *r6("reward"))


def _returns(flag: str, *columns: str):
    def query(spark, d) -> DataFrame:
        return rewards.returns(rewards.rewarded(fixtures.log(spark, d))).select("case_id", "traj_id", flag, *r6(*columns))

    return query


def value_of_information(spark, d) -> DataFrame:
    """Observed next beliefs as the sampled observations of a turn's action, over the trajectories of a case."""
    return _information(rewards.measured(fixtures.log(spark, d))).select("case_id", "t", "action", *r6("voi"), "samples")


def _information(rows) -> DataFrame:
    rows = rows.where("ig is not null")
    samples = rows.select("case_id", F.lit(0).alias("traj_id"), "t", F.col("u").alias("action"), "psi", (F.col("psi") + F.col("r_p")).alias("psi_after"))
    return rewards.value_of_information(samples)


def sufficiency_thresholds(spark, d) -> DataFrame:
    return gating.thresholds(rewards.measured(fixtures.log(spark, d))).select(*r6("tau_low", "tau_high"))


def threshold_sweep(spark, d) -> DataFrame:
    """tau_low at 10 to 50 %, tau_high at 50 to 90 %."""
    rows = rewards.measured(fixtures.log(spark, d)).groupBy(*rewards.TRAJECTORY).agg(F.max_by("s", "t").alias("s"))
    qs = [round(0.1 * k, 1) for k in range(1, 10)]
    wide = ranks.quantiles(rows, "s", {f"q{k}": q for k, q in enumerate(qs)})
    return wide.select(F.explode(F.array(*(F.struct(F.lit(q).alias("q"), F.round(f"q{k}", 6).alias("v")) for k, q in enumerate(qs)))).alias("x")).select("x.*")


def turn_budget(spark, d) -> DataFrame:
    return fixtures.log(spark, d).groupBy(*rewards.TRAJECTORY).agg(F.max("real_turns").alias("n")).select("case_id", "traj_id", gating.turn_budget(F.col("n")).cast("long").alias("budget"))


def emergency_channel(spark, d) -> DataFrame:
    return gating.with_emergency(fixtures.log(spark, d)).select(*KEY, "u_masked", "late", "penalty", "normalised")


def gate_decision(spark, d) -> DataFrame:
    return gating.gated(rewards.measured(fixtures.log(spark, d))).select(*KEY, "u", "gate")


def gate_off(spark, d) -> DataFrame:
    return gating.gated(rewards.measured(fixtures.log(spark, d)), on=False).groupBy("gate").agg(F.count("*").alias("n"))


def disclosure_choice(spark, d) -> DataFrame:
    rows = gating.gated(rewards.measured(fixtures.log(spark, d))).where("gate = 'rejected'")
    return gating.disclosure(rows).select(*KEY, *longs("disclose"))


def termination(spark, d) -> DataFrame:
    return gating.disclosures_left(gating.gated(rewards.measured(fixtures.log(spark, d)))).select("case_id", "traj_id", *longs("rejections", "disclosed"), "ends")


def branch_trigger(spark, d) -> DataFrame:
    rows = rewards.measured(fixtures.log(spark, d))
    best = _information(rows).groupBy("case_id", "t").agg(F.max("voi").alias("voi"))
    return gating.branches(rows.join(best, ["case_id", "t"], "left")).select(*KEY, "branch")


def distinct_questions(spark, d) -> DataFrame:
    """Three sampled questions a turn, two of them alike."""
    rows = fixtures.read(spark, d, "conversations").select(F.expr("conv_id div 4").alias("case_id"), (F.col("conv_id") % 4).alias("traj_id"), F.col("turn").alias("t"), "text", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"))
    rows = rows.withColumn("question", F.concat(F.substring("text", 1, 20), (F.col("k") % 2).cast("string")))
    return gating.distinct_questions(rows.select("case_id", "traj_id", "t", "question"), "question").groupBy("case_id", "traj_id").agg(F.count("*").alias("n"))


def stage_gating(spark, d) -> DataFrame:
    rows = rewards.measured(fixtures.log(spark, d)).withColumn("stage", gating.bucket(F.count("*").over(Window.partitionBy(*rewards.TRAJECTORY))))
    return gating.gated_in(rows, ("C2",)).groupBy("stage", "gate").agg(F.count("*").alias("n"))


def _cases(spark, d) -> DataFrame:
    rows = rewards.rewarded(fixtures.log(spark, d))
    trajectories = rows.groupBy("batch", "case_id", "traj_id").agg(F.min_by("h", "t").alias("h0"), F.sum("reward").alias("total"))
    return trajectories.groupBy("batch", "case_id").agg(F.min_by("h0", "traj_id").alias("h0"), F.var_pop("total").alias("variance"))


def group_size(spark, d) -> DataFrame:
    return credit.group_sizes(_cases(spark, d)).select("case_id", *longs("n"))


def group_quota(spark, d) -> DataFrame:
    return credit.group_sizes(_cases(spark, d)).select("batch", "case_id", *longs("granted"))


def allocation_rules(spark, d) -> DataFrame:
    return credit.allocations(_cases(spark, d)).select("batch", "case_id", *r6("by_entropy", "even", "by_variance"))


def budget_parity(spark, d) -> DataFrame:
    runs = fixtures.log(spark, d).select(F.concat(F.lit("m"), F.col("traj_id").cast("string")).alias("method"), F.lit(1).cast("long").alias("calls"), F.col("n_tok").alias("tokens"))
    return credit.budget_parity(runs)


def _clustered(spark, d) -> DataFrame:
    return credit.clustered(fixtures.rewarded_log(spark, d), fixtures.CENTROIDS)


def occupancy_cluster(spark, d) -> DataFrame:
    return _clustered(spark, d).select(*KEY, *longs("cluster"))


def exact_state_groups(spark, d) -> DataFrame:
    """Turns grouped by identical occupancy."""
    from ..functions.beliefs import occupied

    rows = fixtures.log(spark, d).groupBy("batch", occupied(F.col("belief"), P.facts, P.occupancy).alias("state")).agg(F.count("*").alias("n"))
    return rows.groupBy("batch").agg(F.count("*").alias("states"), F.count_if(F.col("n") > 1).alias("shared"))


def cluster_advantage(spark, d) -> DataFrame:
    return credit.advantages(_clustered(spark, d)).select(*KEY, *r6("baseline", "advantage"))


def clipped_objective(spark, d) -> DataFrame:
    return credit.objective(credit.advantages(_clustered(spark, d))).select("batch", *r6("clipped", "kl", "objective"))


def kl_coefficient(spark, d) -> DataFrame:
    return credit.kl_coefficient(credit.objective(credit.advantages(_clustered(spark, d)))).select("batch", *r6("coefficient"))


def curriculum_bucket(spark, d) -> DataFrame:
    rows = fixtures.log(spark, d).groupBy(*rewards.TRAJECTORY).agg(F.count("*").alias("doctor_turns"))
    return rows.groupBy(gating.bucket(F.col("doctor_turns")).alias("bucket")).agg(F.count("*").alias("n"))


def curriculum_terciles(spark, d) -> DataFrame:
    rows = fixtures.log(spark, d).groupBy(*rewards.TRAJECTORY).agg(F.count("*").alias("doctor_turns"))
    return gating.tercile_bounds(rows).select(*r6("first", "second"))


def curriculum_switch(spark, d) -> DataFrame:
    rows = rewards.rewarded(fixtures.log(spark, d)).groupBy(*rewards.TRAJECTORY).agg(F.count("*").alias("n"), F.max_by("utility_end", "t").alias("utility_end"), F.max_by("s", "t").alias("s"))
    return gating.stage_switch(rows.withColumn("stage", gating.bucket(F.col("n"))), 0.3, 0.5).select("stage", *r6("mean_utility", "early_rate"), "switch")


def replay_sample(spark, d) -> DataFrame:
    return gating.replayed(fixtures.log(spark, d).select("case_id").distinct())


def early_rate(spark, d) -> DataFrame:
    return gating.early_rate(rewards.measured(fixtures.log(spark, d))).select(*r6("early_rate", "s_10", "s_50", "s_90"))


def potential_sweep(spark, d) -> DataFrame:
    """Residuals for every beta and lambda of the grids: rows are multiplied by a short array, nothing is joined."""
    rows = rewards.fact_reward(rewards.measured(fixtures.log(spark, d)))
    ends = rows.groupBy(*rewards.TRAJECTORY).agg((F.max_by("h", "t") - F.min_by("h", "t")).alias("dh"), (F.max_by("phi", "t") - F.min_by("phi", "t")).alias("dphi"), (F.sum("r_f") / P.fact_weight).alias("bits"))
    grid = F.explode(F.array(*(F.struct(F.lit(b).alias("beta"), F.lit(w).alias("weight")) for b in (0.0, 0.25, 0.5, 0.75, 1.0) for w in (0.0, 0.1, 0.3)))).alias("g")
    rows = ends.select("dh", "dphi", "bits", grid)
    beta, weight = F.col("g.beta"), F.col("g.weight")
    return rows.groupBy(beta.alias("beta"), weight.alias("weight")).agg(F.round(F.avg((1 - beta) * -F.col("dh") + beta * F.col("dphi")), 6).alias("residual"), F.round(F.avg(weight * F.col("bits")), 6).alias("facts"))


def _case_measures(spark, d) -> DataFrame:
    rows = rewards.rewarded(fixtures.log(spark, d))
    return rows.groupBy("case_id").agg(F.round(F.sum("ig"), 6).alias("ig"), F.round(F.sum("r_f"), 6).alias("r_f"), F.round(F.sum("dphi"), 6).alias("dphi"), F.avg("reward").alias("reward"))


def spearman(spark, d) -> DataFrame:
    return statistics.spearman(_case_measures(spark, d), "ig", "r_f").select(*r6("rho"), "n")


def signal_correlations(spark, d) -> DataFrame:
    return statistics.correlations(_signals(spark, d), list(SIGNALS)).select("x", "y", *r6("r"))


SIGNALS = ("ig", "dphi", "r_f", "consistency", "answer")


def _signals(spark, d) -> DataFrame:
    return rewards.signals(rewards.fact_reward(rewards.measured(fixtures.log(spark, d)))).where("ig is not null")


def signal_distributions(spark, d) -> DataFrame:
    return statistics.distributions(_signals(spark, d), list(SIGNALS)).select("signal", "n", *r6("mean", "sd", "least", "greatest"))


def rank_agreement(spark, d) -> DataFrame:
    """Ranks of a measure against labels of three levels."""
    rows = fixtures.read(spark, d, "labels").select((F.col("quality") + F.col("doc_id") % 2).alias("level"), (F.col("doc_id") % 11 + 3 * F.col("toxic")).cast("double").alias("measure"))
    return statistics.spearman(rows, "measure", "level").select(*r6("rho"), "n")


def atom_space(spark, d) -> DataFrame:
    """Each case's atoms: the facts that its turns confirm, and the diagnoses that its beliefs hold."""
    rows = fixtures.log(spark, d).groupBy("case_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("confirmed")))).alias("facts"), F.max(F.size("belief")).alias("size"))
    found = beliefs.atoms(F.col("facts"), F.sequence(F.lit(P.facts), F.col("size") - 1))
    return rows.select("case_id", F.size(found).cast("long").alias("n"), F.array_join(found.cast("array<string>"), ",").alias("atoms"))


def _batch(spark, d) -> tuple[str, dict]:
    """The batch job over written splits, twice: the second time nothing answers, and the cache does."""
    folder = fixtures.workspace(spark)
    fixtures.write_splits(spark, d, f"{folder}/in")
    cloudpickle.register_pickle_by_value(fixtures)
    config = extraction.Config(f"{folder}/in", f"{folder}/out", retries=2, pause=0.0)
    extraction.run(spark, config, fixtures.responder)
    return folder, extraction.run(spark, config, fixtures.silent)


def batch_results(spark, d) -> DataFrame:
    """What the batch job wrote, read again: facts kept and dropped per case, and those dropped that still have members of their own."""
    folder, _ = _batch(spark, d)
    rows = spark.read.json(f"{folder}/out/facts")
    return rows.select("case_id", "split", F.size("facts").cast("long").alias("n_facts"), F.size("dropped").cast("long").alias("n_dropped"), F.size(F.filter("dropped", lambda x: x["fact"]["note"] == "as said")).cast("long").alias("n_raw"))


def batch_cache(spark, d) -> DataFrame:
    """The cache that the batch job left: an entry per case that was answered."""
    folder, _ = _batch(spark, d)
    return spark.read.schema(extraction.RECORD).parquet(f"{folder}/out/cache").select("case_id", "fp", F.size("facts").cast("long").alias("n_facts"))


def batch_report(spark, d) -> DataFrame:
    _, found = _batch(spark, d)
    pairs = lambda m: ",".join(f"{k}={n}" for k, n in sorted(m.items()))
    row = (found["episodes"], found["failed"], found["no_facts"], pairs(found["by_category"]), pairs(found["drop_reasons"]))
    return spark.createDataFrame([row], "episodes long, failed long, no_facts long, by_category string, drop_reasons string")


def ece(spark, d) -> DataFrame:
    rows = fixtures.read(spark, d, "labels").withColumn("conf", (F.col("doc_id") % 100) / 100.0)
    return statistics.calibration_error(rows, "conf", "quality").select(*r6("ece"), "n")


def bootstrap_ci(spark, d) -> DataFrame:
    return statistics.bootstrap(_case_measures(spark, d), "ig").select(*r6("mean", "low", "high"))


def holm(spark, d) -> DataFrame:
    rows = fixtures.read(spark, d, "labels").groupBy(F.concat(F.lit("H"), (F.col("doc_id") % 3 + 1).cast("string")).alias("hypothesis")).agg((F.avg(1.0 - F.col("quality")) / 10).alias("p"))
    return statistics.holm(rows).select("hypothesis", *r6("p", "adjusted"))


def icc21(spark, d) -> DataFrame:
    rows = fixtures.read(spark, d, "labels").select(F.col("doc_id").alias("subject"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("rater"), "quality")
    rows = rows.withColumn("score", (F.col("quality") * 2 + (F.col("subject") * F.col("rater")) % 3).cast("double"))
    return statistics.agreement(rows).select("subjects", "raters", *r6("icc"))


def leave_one_source_out(spark, d) -> DataFrame:
    docs = fixtures.read(spark, d, "documents").select("doc_id", "source")
    rows = docs.join(fixtures.read(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    return statistics.leave_one_out(rows, "source", "quality").select("held_out", *r6("others", "own"))


def human_agreement(spark, d) -> DataFrame:
    return statistics.crosstab(fixtures.read(spark, d, "labels").select(*longs("quality", "toxic")), "quality", "toxic")


def variance_comparison(spark, d) -> DataFrame:
    return statistics.variances(rewards.rewarded(fixtures.log(spark, d))).select(*r6("by_turn", "by_trajectory", "by_mean"))


def irrelevant_information(spark, d) -> DataFrame:
    rows = rewards.fact_reward(fixtures.log(spark, d))
    rows = rows.select(F.size("new_facts").alias("all"), F.size(F.array_except("new_facts", "required")).alias("other"))
    return statistics.share(rows, "other", "all").select(*r6("share"))


def estimator_bias(spark, d) -> DataFrame:
    """Two estimators: the belief's potential, and that of a slightly flattened belief."""
    log = fixtures.log(spark, d)
    second = log.withColumn("belief", F.transform("belief", lambda b: 0.99 * b + 0.01 / P.atoms))
    rows = rewards.measured(log).select(*KEY, F.col("r_p").alias("a")).join(rewards.measured(second).select(*KEY, F.col("r_p").alias("b")), list(KEY))
    return statistics.bias_bound(rows, "a", "b", 0.2).select(*r6("gap"), "within")


def fact_acquisition(spark, d) -> DataFrame:
    """The share of required facts confirmed by the end, and turns from an emergency hit to the end."""
    w = rewards.TRAJECTORY
    rows = fixtures.log(spark, d).groupBy(*w).agg(F.max_by(F.size(F.array_intersect("required", "confirmed")), "t").alias("got"), F.max(F.size("required")).alias("need"), (F.max("t") - F.min(F.when(F.col("emergency_hit"), F.col("t")))).alias("delay"))
    return rows.agg(F.round(F.sum("got") / F.sum("need"), 6).alias("acquired"), F.round(F.avg("delay"), 6).alias("delay"), F.count("delay").alias("emergencies"))


def recogniser_recall(spark, d) -> DataFrame:
    """How many emergencies the recogniser hits; by the fixture it misses some."""
    rows = fixtures.log(spark, d).withColumn("true", ((F.col("case_id") * 4 + F.col("traj_id")) * 13 + F.col("t")) % 37 < 3)
    return statistics.recall(rows, "true", "emergency_hit").select(*r6("recall"), "n")


def run_diagnostics(spark, d) -> DataFrame:
    rows = gating.gated(rewards.measured(fixtures.log(spark, d)))
    by = rows.groupBy("batch", *rewards.TRAJECTORY).agg(F.count("*").alias("turns"), F.count_if(F.col("gate") == "rejected").alias("rejections"))
    return by.groupBy("batch").agg(F.count("*").alias("trajectories"), F.round(F.sum("rejections") / F.sum("turns"), 6).alias("rejected_share"), F.round(F.avg("turns"), 6).alias("mean_turns"), F.max("turns").alias("most_turns"))


def normalisation_ablation(spark, d) -> DataFrame:
    """Advantages by turn against rewards summed over the trajectory."""
    rows = credit.advantages(_clustered(spark, d)).groupBy("batch", "case_id", "traj_id").agg(F.avg("advantage").alias("by_turn"), F.sum("reward").alias("total"))
    means = rows.groupBy("batch", "case_id").agg(F.avg("total").alias("m"))
    return rows.join(means, ["batch", "case_id"]).groupBy("batch").agg(F.round(F.var_pop("by_turn"), 6).alias("turn_level"), F.round(F.var_pop(F.col("total") - F.col("m")), 6).alias("accumulated"))


def split_audit(spark, d) -> DataFrame:
    rows = fixtures.episodes(spark, d).withColumn("split", F.expr(fixtures.split()))
    return statistics.split_audit(rows)


QUERIES = {
    "fact_validation": _fact_rows(False),
    "fact_validation_wide": _fact_rows(True),
    "belief_entropy": _measured("h"),
    "information_gain": _measured("ig", "dphi"),
    "sufficiency": _measured("s"),
    "potential": _measured("phi", "psi"),
    "process_reward": _measured("r_p"),
    "return_decomposition": _returns("adds_up", "total", "facts", "end"),
    "residual_bounds": _returns("in_bounds", "residual", "low", "high"),
} | {
    f.__name__: f
    for f in (
        episode_assembly, dialogue_fingerprint, normalize_text, facts_per_episode, facts_report_category, drop_reasons, episode_counters, facts_report,
        cache_last_wins, cache_hits, cache_misses, limit_per_split, request_json, reply_parse_status, reply_validation, fact_self_information, terminal_utility,
        turn_reward, value_of_information, sufficiency_thresholds, threshold_sweep, turn_budget, emergency_channel, gate_decision, gate_off, disclosure_choice,
        termination, branch_trigger, group_size, group_quota, allocation_rules, budget_parity, occupancy_cluster, exact_state_groups, cluster_advantage,
        clipped_objective, kl_coefficient, curriculum_bucket, curriculum_terciles, curriculum_switch, replay_sample, early_rate, potential_sweep, spearman,
        signal_correlations, ece, bootstrap_ci, holm, icc21, leave_one_source_out, human_agreement, variance_comparison, irrelevant_information, estimator_bias,
        fact_acquisition, run_diagnostics, normalisation_ablation, split_audit, distinct_questions, stage_gating, signal_distributions, rank_agreement, atom_space,
        batch_results, batch_cache, batch_report, recogniser_recall,
    )
}
ORACLES = oracles.SQL
