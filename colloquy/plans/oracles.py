"""The catalogue's queries in DuckDB SQL, written with joins and windows of their own rather than the operators' array functions."""

from __future__ import annotations

from .fixtures import CATEGORIES, CENTROIDS
from .parameters import DEFAULTS as P

_WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _norm(x: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({x}, '')), '{_WS}', ' ', 'g'))"


_ROLE = "CASE role WHEN 'user' THEN 'patient' WHEN 'assistant' THEN 'doctor' ELSE role END"
_EP = f"""ep AS (SELECT conv_id, count(*) AS n_turns, list({_ROLE} ORDER BY turn) AS roles, list(text ORDER BY turn) AS texts,
  coalesce(max_by(text, turn) FILTER (WHERE role = 'assistant'), '') AS conclusion,
  string_agg({_ROLE} || ':' || coalesce(text, 'None'), '|' ORDER BY turn) AS payload FROM conversations GROUP BY conv_id)"""
_FP = f"{_EP}, fp AS (SELECT conv_id AS case_id, substring(sha256(payload), 1, 16) AS fp FROM ep)"
_CACHE = f"""{_FP}, entries AS (SELECT case_id, case_id * 10 + i AS seq, CASE WHEN (case_id + i) % 2 = 1 THEN 'stale' || i ELSE fp END AS fp
  FROM fp, range(1, 3) r(i) WHERE i <= case_id % 3),
  latest AS (SELECT case_id, seq, fp FROM entries QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY seq DESC) = 1)"""


def _facts(per: int = 3, names: int = 4, gaps: bool = True, where: str = "true") -> str:
    name = f"'f' || (pos % {names})"
    name = f"CASE WHEN (conv_id + pos) % 17 = 0 THEN '' ELSE {name} END" if gaps else name
    return f"""{_EP}, c0 AS (SELECT conv_id, turn, text, turn * {per} + k AS pos FROM conversations, range({per}) r(k) WHERE {where}),
  c1 AS (SELECT conv_id, pos, [{", ".join(f"'{c}'" for c in CATEGORIES)}][((conv_id + pos) % 8 + 1)::INT] AS category, {name} AS name, 'v' || pos AS value,
    CASE WHEN pos % 13 = 0 THEN NULL WHEN pos % 11 = 0 THEN turn + 100 ELSE turn END AS source_turn,
    {_norm("CASE WHEN pos % 7 = 0 THEN 'no such quote' WHEN pos % 5 = 0 THEN '' ELSE substring(text, 3, 12) END")} AS evidence FROM c0),
  c2 AS (SELECT c1.*, s.role AS cited, {_norm("s.text")} AS said, {_norm("ep.conclusion")} AS conclusion
    FROM c1 JOIN ep USING (conv_id) LEFT JOIN conversations s ON s.conv_id = c1.conv_id AND s.turn = c1.source_turn),
  c3 AS (SELECT *, CASE WHEN category = 'lab' THEN 'bad_category' WHEN name = '' OR value = '' THEN 'empty_field' END AS pre,
    CASE WHEN category NOT IN ('cause', 'disease_name') THEN CASE WHEN source_turn IS NULL OR cited IS NULL THEN 'bad_source_turn' WHEN cited <> 'user' THEN 'not_patient_turn'
      WHEN evidence <> '' AND NOT contains(said, evidence) THEN 'evidence_mismatch' END
      WHEN evidence <> '' AND conclusion <> '' AND NOT contains(conclusion, evidence) THEN 'evidence_mismatch' END AS own FROM c2),
  c4 AS (SELECT *, min(CASE WHEN pre IS NULL AND own IS NULL THEN pos END) OVER (PARTITION BY conv_id, category, lower(name)) AS fv FROM c3),
  c5 AS (SELECT *, coalesce(pre, CASE WHEN pos > fv THEN 'duplicate' END, own, 'kept') AS r0 FROM c4),
  facts AS (SELECT *, CASE WHEN r0 = 'kept' AND sum((r0 = 'kept')::INT) OVER (PARTITION BY conv_id ORDER BY pos) > 10 THEN 'truncated' ELSE r0 END AS reason FROM c5)"""


_LOG = f"""l0 AS (SELECT c.conv_id, c.turn, length(c.text) AS chars, max(c.turn) OVER (PARTITION BY c.conv_id) AS last,
    list_transform(e.embedding, lambda x: pow(abs(x::DOUBLE), 1 + c.turn)) AS w
  FROM conversations c JOIN embeddings e ON e.vec_id = c.conv_id % (SELECT count(*) FROM embeddings)),
  log AS (SELECT conv_id // 4 AS case_id, conv_id % 4 AS traj_id, turn AS t, conv_id // 64 AS batch, last + 1 AS real_turns, conv_id,
    CASE WHEN turn = last OR (conv_id * 7 + turn) % 11 = 0 THEN 'DIG' WHEN (conv_id + turn) % 4 = 3 THEN 'TALK' ELSE 'WEN' END AS u,
    chars // 4 AS n_tok, list_transform(w, lambda x: x / list_sum(w)) AS b,
    list_filter(range(0, {P.facts}), lambda k: k % 9 <= turn AND (conv_id + k) % 5 = 0) AS confirmed,
    (conv_id * 13 + turn) % 37 = 0 AS hit, ((conv_id + turn) % 7 - 3) / 10.0::DOUBLE AS shift, (conv_id % 3) / 2.0::DOUBLE AS r_out FROM l0),
  m0 AS (SELECT *, -list_sum(list_transform(b, lambda p: CASE WHEN p > 0 THEN p * log2(p) ELSE 0 END)) AS h,
    list_sum(list_transform(b, lambda p, i: p * ((i - 1) % 10) / 10.0::DOUBLE)) AS phi, coalesce(lag(confirmed) OVER w, []) AS before, lag(u) OVER w AS u_before
    FROM log WINDOW w AS (PARTITION BY conv_id ORDER BY t)),
  m1 AS (SELECT *, {P.alpha} * ((1 - {P.beta}) * -h + {P.beta} * phi) AS psi, list_filter(confirmed, lambda k: NOT list_contains(before, k)) AS fresh FROM m0),
  m2 AS (SELECT *, h - lead(h) OVER w AS ig, lead(phi) OVER w - phi AS dphi, coalesce(lead(psi) OVER w - psi, 0) AS r_p, first(h) OVER w AS h0, 1 - h / first(h) OVER w AS s,
    {P.fact_weight} * coalesce(list_sum(list_transform(fresh, lambda k: -log2(greatest(b[k + 1], {P.floor})))), 0) AS r_f,
    {P.outcome_weight} * r_out - {P.cost_weight} * ({P.turn_cost} * count(*) OVER v + {P.token_cost} * sum(n_tok) OVER v) AS utility_end
    FROM m1 WINDOW w AS (PARTITION BY conv_id ORDER BY t), v AS (PARTITION BY conv_id)),
  m3 AS (SELECT *, u = 'DIG' AND s < {P.tau_low} AS rejected FROM m2),
  m4 AS (SELECT *, coalesce(t = min(CASE WHEN u = 'DIG' AND NOT rejected THEN t END) OVER (PARTITION BY conv_id), false) AS paid,
    min(CASE WHEN hit THEN t END) OVER (PARTITION BY conv_id) AS first_hit FROM m3),
  r AS (SELECT *, r_p + r_f + CASE WHEN paid THEN utility_end ELSE 0 END AS reward, coalesce(t > first_hit, false) AS late, coalesce(t < first_hit, true) AS normalised,
    CASE WHEN hit THEN 'emergency' WHEN s >= {P.tau_high} AND (u = 'WEN' OR (u = 'TALK' AND u_before = 'TALK')) THEN 'masked' WHEN rejected THEN 'rejected' ELSE 'pass' END AS gate FROM m4),
  trajectories AS (SELECT batch, case_id, traj_id, count(*) AS turns, sum(reward) AS total, sum(r_f) AS facts, sum(CASE WHEN paid THEN utility_end ELSE 0 END) AS paid_end, min_by(h, t) AS h0, max_by(h, t) AS h_last,
    max_by(psi, t) - min_by(psi, t) AS residual, max_by(s, t) AS s, max_by(utility_end, t) AS utility_end, max(real_turns) AS real_turns FROM r GROUP BY ALL),
  cases AS (SELECT batch, case_id, min_by(h0, traj_id) AS h0, var_pop(total) AS variance, ceil({P.group_min} + {P.group_max - P.group_min} * min_by(h0, traj_id) / {P.most_bits})::BIGINT AS n FROM trajectories GROUP BY ALL)"""
_BITS = f"list_sum(list_transform(range(0, {P.facts}), lambda k: CASE WHEN b[k + 1] >= {P.occupancy} THEN 1::BIGINT << k::INT ELSE 0 END))::BIGINT"
_CLUSTER = f"""{_LOG}, o AS (SELECT *, {_BITS} AS bits FROM r),
  k AS (SELECT *, list_sort([{", ".join("{'d': bit_count(xor(bits, " + str(c) + "::BIGINT)), 'c': " + str(i) + "}" for i, c in enumerate(CENTROIDS))}])[1].c AS cluster FROM o),
  base AS (SELECT batch, cluster, CASE WHEN count(*) FILTER (WHERE ok) >= {P.cluster_least} THEN avg(reward) FILTER (WHERE ok) ELSE any_value(whole) END AS baseline
    FROM (SELECT *, normalised AND NOT rejected AS ok, avg(CASE WHEN normalised AND NOT rejected THEN reward END) OVER (PARTITION BY batch) AS whole FROM k) GROUP BY ALL),
  adv AS (SELECT k.*, baseline, CASE WHEN rejected THEN -{P.early_penalty} ELSE reward - baseline END AS advantage FROM k JOIN base USING (batch, cluster)),
  o1 AS (SELECT batch, case_id, traj_id, avg(least(exp(shift) * advantage, greatest({1 - P.clip}, least({1 + P.clip}, exp(shift))) * advantage)) AS v, avg(-shift) AS kl FROM adv GROUP BY ALL),
  o2 AS (SELECT batch, case_id, avg(v) AS v, avg(kl) AS kl FROM o1 GROUP BY ALL),
  obj AS (SELECT batch, avg(v) AS clipped, avg(kl) AS kl, avg(v) - {P.kl_weight} * avg(kl) AS objective FROM o2 GROUP BY ALL)"""
_CASE = f"{_LOG}, cm AS (SELECT case_id, round(sum(ig), 6) AS ig, round(sum(r_f), 6) AS r_f, round(sum(dphi), 6) AS dphi FROM r GROUP BY ALL)"
SIGNALS = ("ig", "dphi", "r_f", "consistency", "answer")
_SIGNALS = f"""{_LOG}, s0 AS (SELECT *, max_by(b, t) OVER (PARTITION BY conv_id) AS ended FROM r),
  s1 AS (SELECT *, b[{P.facts} + list_position(ended[{P.facts + 1}:], list_max(ended[{P.facts + 1}:]))] AS ap FROM s0),
  s2 AS (SELECT *, coalesce(list_avg(list_transform(fresh, lambda k: b[k + 1])), 0) AS consistency, lead(ap) OVER (PARTITION BY conv_id ORDER BY t) - ap AS answer FROM s1),
  x AS (SELECT * FROM s2 WHERE ig IS NOT NULL)"""
_SPLIT = "CASE WHEN conv_id % 10 < 8 THEN 'train' WHEN conv_id % 10 = 8 THEN 'dev' ELSE 'test' END"
_BUCKET = f"CASE WHEN turns <= {P.short_turns} THEN 'C1' WHEN turns <= {P.middle_turns} THEN 'C2' ELSE 'C3' END"


def _r(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def _log(select: str) -> str:
    return f"WITH {_LOG} {select}"


def _turn(*columns: str) -> str:
    return _log(f"SELECT case_id, traj_id, t, {', '.join(columns)} FROM r")


def _corr(x: str, y: str, table: str) -> str:
    return f"SELECT '{x}' AS x, '{y}' AS y, round(CASE WHEN stddev_pop({x}) > 0 AND stddev_pop({y}) > 0 THEN covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})) END, 6) AS r FROM {table}"


SQL = {
    "episode_assembly": f"WITH {_EP} SELECT conv_id, n_turns, array_to_string(roles, '|') AS roles, array_to_string(texts, '|') AS contents, conclusion FROM ep",
    "dialogue_fingerprint": f"WITH {_FP} SELECT case_id AS conv_id, fp FROM fp",
    "normalize_text": f"SELECT conv_id, turn, {_norm('text')} AS normed FROM conversations",
    "fact_validation": f"WITH {_facts()} SELECT conv_id, pos, category, name, reason FROM facts",
    "fact_validation_wide": f"WITH {_facts(10, 40, False)} SELECT conv_id, pos, category, name, reason FROM facts",
    "facts_per_episode": f"""WITH {_facts(10, 40, False)} SELECT conv_id, count(*) FILTER (WHERE reason = 'kept') AS n_kept, count(*) FILTER (WHERE reason NOT IN ('kept', 'truncated')) AS n_dropped,
        min_by(name, pos) FILTER (WHERE reason = 'kept') AS first_name, max_by(name, pos) FILTER (WHERE reason = 'kept') AS last_name FROM facts GROUP BY conv_id""",
    "facts_report_category": f"WITH {_facts()} SELECT category, count(*) AS n FROM facts WHERE reason = 'kept' GROUP BY category",
    "drop_reasons": f"WITH {_facts()} SELECT reason, count(*) AS n FROM facts WHERE reason NOT IN ('kept', 'truncated') GROUP BY reason",
    "episode_counters": f"WITH {_facts()} SELECT (SELECT count(*) FROM ep) AS episodes, 0::BIGINT AS failed, (SELECT count(*) FROM ep WHERE conv_id NOT IN (SELECT conv_id FROM facts WHERE reason = 'kept')) AS no_facts",
    "facts_report": f"""WITH {_facts()} SELECT (SELECT count(*) FROM ep) AS episodes, 0::BIGINT AS failed, (SELECT count(*) FROM ep WHERE conv_id NOT IN (SELECT conv_id FROM facts WHERE reason = 'kept')) AS no_facts,
        (SELECT string_agg(category || '=' || n, ',' ORDER BY category) FROM (SELECT category, count(*) AS n FROM facts WHERE reason = 'kept' GROUP BY ALL)) AS by_category,
        (SELECT string_agg(reason || '=' || n, ',' ORDER BY reason) FROM (SELECT reason, count(*) AS n FROM facts WHERE reason NOT IN ('kept', 'truncated') GROUP BY ALL)) AS drop_reasons""",
    "cache_last_wins": f"WITH {_CACHE} SELECT case_id, seq, fp FROM latest",
    "cache_hits": f"WITH {_CACHE} SELECT fp.case_id, latest.seq FROM fp JOIN latest ON fp.case_id = latest.case_id AND fp.fp = latest.fp",
    "cache_misses": f"WITH {_CACHE} SELECT case_id, fp FROM fp WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.case_id = fp.case_id AND l.fp = fp.fp)",
    "limit_per_split": "SELECT split, conv_id FROM (SELECT ['train', 'dev', 'test'][(conv_id % 3 + 1)::INT] AS split, conv_id FROM conversations WHERE turn = 0) QUALIFY row_number() OVER (PARTITION BY split ORDER BY conv_id) <= 20",
    "request_json": f"WITH {_EP} SELECT conv_id, n_turns, array_to_string(roles, '|') AS roles, array_to_string(texts, '|') AS texts, conclusion, '' AS department FROM ep",
    "reply_parse_status": f"""WITH {_EP} SELECT conv_id, ['ok', 'ok', 'invalid_json', 'not_object', 'no_facts', 'bad_element'][(conv_id % 6 + 1)::INT] AS status, CASE WHEN conv_id % 6 < 2 THEN n_turns * 3 END AS n_facts FROM ep""",
    "reply_validation": f"WITH {_facts(where='conv_id % 6 < 2')} SELECT reason, count(*) AS n FROM facts GROUP BY reason",
    "belief_entropy": _turn(_r("h")),
    "information_gain": _turn(_r("ig", "dphi")),
    "sufficiency": _turn(_r("s")),
    "potential": _turn(_r("phi", "psi")),
    "process_reward": _turn(_r("r_p")),
    "fact_self_information": _turn("len(fresh) AS n_new", _r("r_f")),
    "terminal_utility": _turn(_r("utility_end")),
    "turn_reward": _turn("rejected", "paid", _r("reward")),
    "return_decomposition": _log("SELECT case_id, traj_id, abs(total - paid_end - residual - facts) < 1e-6 AS adds_up, round(total, 6) AS total, round(facts, 6) AS facts, round(paid_end, 6) AS \"end\" FROM trajectories"),
    "residual_bounds": _log(
        f"""SELECT case_id, traj_id, round(residual, 6) AS residual, round(low, 6) AS low, round(high, 6) AS high, residual >= low - 1e-9 AND (h_last > h0 OR residual <= high + 1e-9) AS in_bounds FROM
        (SELECT *, CASE WHEN h_last <= h0 THEN {-P.alpha * P.beta} ELSE {-P.alpha * ((1 - P.beta) * P.most_bits + P.beta)} END ::DOUBLE AS low, {P.alpha} * ({1 - P.beta} * h0 + {P.beta}) AS high FROM trajectories)"""
    ),
    "value_of_information": _log("SELECT case_id, t, u AS action, round(avg(r_p), 6) AS voi, count(*) AS samples FROM r WHERE ig IS NOT NULL GROUP BY ALL"),
    "sufficiency_thresholds": _log("SELECT round(quantile_cont(s, 0.25), 6) AS tau_low, round(quantile_cont(s, 0.75), 6) AS tau_high FROM trajectories"),
    "threshold_sweep": _log("SELECT round(q / 10.0::DOUBLE, 1) AS q, round(v, 6) AS v FROM (SELECT unnest(range(1, 10)) AS q, unnest(quantile_cont(s, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS v FROM trajectories)"),
    "turn_budget": _log(f"SELECT case_id, traj_id, greatest({P.budget_least}, least({P.budget_most}, real_turns + {P.budget_more}))::BIGINT AS budget FROM trajectories"),
    "emergency_channel": _turn("CASE WHEN hit AND u = 'DIG' THEN 'REFER' ELSE u END AS u_masked", "late", f"CASE WHEN late THEN {-P.delay_penalty}::DOUBLE ELSE 0 END AS penalty", "normalised"),
    "gate_decision": _turn("u", "gate"),
    "gate_off": _log("SELECT CASE WHEN hit THEN 'emergency' ELSE 'pass' END AS gate, count(*) AS n FROM r GROUP BY ALL"),
    "disclosure_choice": _log(
        f"""SELECT case_id, traj_id, t, (SELECT k FROM (SELECT unnest(list_filter(range(0, {P.facts}), lambda k: k % 6 = 0 AND NOT list_contains(r.confirmed, k))) AS k)
        ORDER BY (1 + k % 3) * -log2(greatest(r.b[k + 1], {P.floor})) DESC, k LIMIT 1) AS disclose FROM r WHERE gate = 'rejected'"""
    ),
    "termination": _log(
        f"""SELECT case_id, traj_id, count(*) FILTER (WHERE gate = 'rejected') AS rejections, least(count(*) FILTER (WHERE gate = 'rejected'), {len(range(0, P.facts, 6))}) AS disclosed,
        count(*) <= greatest({P.budget_least}, least({P.budget_most}, max(real_turns) + {P.budget_more})) + {len(range(0, P.facts, 6))} AS ends FROM r GROUP BY ALL"""
    ),
    "branch_trigger": _log(
        f"""SELECT case_id, traj_id, t, h > {P.branch_entropy} OR coalesce(voi > {P.branch_voi}, false) AS branch FROM r LEFT JOIN
        (SELECT case_id, t, max(voi) AS voi FROM (SELECT case_id, t, u, avg(r_p) AS voi FROM r WHERE ig IS NOT NULL GROUP BY ALL) GROUP BY ALL) USING (case_id, t)"""
    ),
    "distinct_questions": "SELECT conv_id // 4 AS case_id, conv_id % 4 AS traj_id, count(DISTINCT (turn, left(text, 20) || k % 2)) AS n FROM conversations, range(3) q(k) GROUP BY conv_id",
    "stage_gating": _log(
        f"""SELECT stage, CASE WHEN gate = 'emergency' OR stage = 'C2' THEN gate ELSE 'pass' END AS gate, count(*) AS n
        FROM (SELECT gate, {_BUCKET} AS stage FROM (SELECT gate, count(*) OVER (PARTITION BY conv_id) AS turns FROM r)) GROUP BY ALL"""
    ),
    "signal_distributions": f"WITH {_SIGNALS} " + " UNION ALL ".join(f"SELECT '{c}' AS signal, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS sd, round(min({c}), 6) AS least, round(max({c}), 6) AS greatest FROM x" for c in SIGNALS),
    "rank_agreement": """WITH x AS (SELECT quality + doc_id % 2 AS a, doc_id % 11 + 3 * toxic AS b FROM labels),
        rk AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0::DOUBLE AS a, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0::DOUBLE AS b FROM x)
        SELECT round(corr(a, b), 6) AS rho, count(*) AS n FROM rk""",
    "atom_space": _log(
        f"""SELECT case_id, len(a)::BIGINT AS n, array_to_string(a, ',') AS atoms FROM
        (SELECT case_id, list_concat(list_sort(list_distinct(flatten(list(confirmed)))), range({P.facts}, max(len(b)))) AS a FROM r GROUP BY case_id)"""
    ),
    "batch_results": f"""SELECT conv_id::VARCHAR AS case_id, {_SPLIT} AS split, count(DISTINCT turn % 4) FILTER (WHERE role = 'user') AS n_facts,
        count(*) FILTER (WHERE role = 'user') - count(DISTINCT turn % 4) FILTER (WHERE role = 'user') + 1 AS n_dropped, 1::BIGINT AS n_raw FROM conversations WHERE conv_id % 7 <> 0 GROUP BY conv_id""",
    "batch_cache": f"""WITH {_FP} SELECT case_id::VARCHAR AS case_id, fp, (SELECT count(DISTINCT turn % 4) FROM conversations c WHERE c.conv_id = fp.case_id AND role = 'user') AS n_facts FROM fp WHERE case_id % 7 <> 0""",
    "batch_report": """WITH x AS (SELECT conv_id, count(DISTINCT turn % 4) FILTER (WHERE role = 'user') AS kept, count(*) FILTER (WHERE role = 'user') AS said FROM conversations GROUP BY conv_id), y AS (SELECT * FROM x WHERE conv_id % 7 <> 0)
        SELECT (SELECT count(*) FROM x) AS episodes, (SELECT count(*) FROM x WHERE conv_id % 7 = 0) AS failed, count(*) FILTER (WHERE kept = 0) AS no_facts, CASE WHEN sum(kept) > 0 THEN 'symptom=' || sum(kept) ELSE '' END AS by_category,
        'bad_category=' || count(*) || CASE WHEN sum(said - kept) > 0 THEN ',duplicate=' || sum(said - kept) ELSE '' END AS drop_reasons FROM y""",
    "recogniser_recall": _log("SELECT round(count(*) FILTER (WHERE e AND hit) / count(*) FILTER (WHERE e), 6) AS recall, count(*) FILTER (WHERE e) AS n FROM (SELECT hit, (conv_id * 13 + t) % 37 < 3 AS e FROM r)"),
    "group_size": _log("SELECT case_id, n FROM cases"),
    "group_quota": _log(
        f"""SELECT batch, case_id, greatest(0, least(n, quota - coalesce(before, 0)))::BIGINT AS granted FROM (SELECT *, count(*) OVER (PARTITION BY batch) * {P.group_mean} AS quota,
        sum(n) OVER (PARTITION BY batch ORDER BY h0 DESC, case_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM cases)"""
    ),
    "allocation_rules": _log(
        """SELECT batch, case_id, round(h0 / sum(h0) OVER w, 6) AS by_entropy, round(1.0::DOUBLE / count(*) OVER w, 6) AS even,
        round(coalesce(variance / nullif(sum(variance) OVER w, 0), 1.0::DOUBLE / count(*) OVER w), 6) AS by_variance FROM cases WINDOW w AS (PARTITION BY batch)"""
    ),
    "budget_parity": _log(
        f"""SELECT method, calls, tokens, abs(calls / avg(calls) OVER () - 1) <= {P.budget_tolerance} AND abs(tokens / avg(tokens) OVER () - 1) <= {P.budget_tolerance} AS matched
        FROM (SELECT 'm' || traj_id AS method, count(*) AS calls, sum(n_tok)::BIGINT AS tokens FROM r GROUP BY ALL)"""
    ),
    "occupancy_cluster": f"WITH {_CLUSTER} SELECT case_id, traj_id, t, cluster::BIGINT AS cluster FROM k",
    "exact_state_groups": f"WITH {_CLUSTER} SELECT batch, count(*) AS states, count(*) FILTER (WHERE n > 1) AS shared FROM (SELECT batch, bits, count(*) AS n FROM o GROUP BY ALL) GROUP BY batch",
    "cluster_advantage": f"WITH {_CLUSTER} SELECT case_id, traj_id, t, {_r('baseline', 'advantage')} FROM adv",
    "clipped_objective": f"WITH {_CLUSTER} SELECT batch, {_r('clipped', 'kl', 'objective')} FROM obj",
    "kl_coefficient": f"""WITH {_CLUSTER} SELECT batch, round(pow(2.0::DOUBLE, sum(CASE WHEN kl > {2 * P.kl_target} THEN 1 WHEN kl < {0.5 * P.kl_target} THEN -1 ELSE 0 END) OVER (ORDER BY batch)), 6) AS coefficient FROM obj""",
    "curriculum_bucket": _log(f"SELECT {_BUCKET} AS bucket, count(*) AS n FROM trajectories GROUP BY ALL"),
    "curriculum_terciles": _log("SELECT round(quantile_cont(turns, 1 / 3.0::DOUBLE), 6) AS first, round(quantile_cont(turns, 2 / 3.0::DOUBLE), 6) AS second FROM trajectories"),
    "curriculum_switch": _log(
        f"""SELECT stage, round(mu, 6) AS mean_utility, round(er, 6) AS early_rate, mu >= 0.3 AND er <= 0.5 AS switch FROM
        (SELECT {_BUCKET} AS stage, avg(utility_end) AS mu, avg(CASE WHEN s < {P.tau_low} THEN 1.0::DOUBLE ELSE 0 END) AS er FROM trajectories GROUP BY ALL)"""
    ),
    "replay_sample": f"SELECT DISTINCT conv_id // 4 AS case_id FROM conversations WHERE ('0x' || substring(md5((conv_id // 4)::VARCHAR), 1, 8))::BIGINT % 1000 < {round(1000 * P.replay)}",
    "early_rate": _log(f"SELECT round(avg(CASE WHEN s < {P.tau_low} THEN 1.0::DOUBLE ELSE 0 END), 6) AS early_rate, round(quantile_cont(s, 0.1), 6) AS s_10, round(quantile_cont(s, 0.5), 6) AS s_50, round(quantile_cont(s, 0.9), 6) AS s_90 FROM trajectories"),
    "potential_sweep": _log(
        f"""SELECT beta, weight, round(avg((1 - beta) * -dh + beta * dphi), 6) AS residual, round(avg(weight * bits), 6) AS facts
        FROM (SELECT max_by(h, t) - min_by(h, t) AS dh, max_by(phi, t) - min_by(phi, t) AS dphi, sum(r_f) / {P.fact_weight} AS bits FROM r GROUP BY conv_id),
        (SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0]::DOUBLE[]) AS beta), (SELECT unnest([0.0, 0.1, 0.3]::DOUBLE[]) AS weight) GROUP BY ALL"""
    ),
    "spearman": f"""WITH {_CASE}, rk AS (SELECT rank() OVER (ORDER BY ig) + (count(*) OVER (PARTITION BY ig) - 1) / 2.0::DOUBLE AS a, rank() OVER (ORDER BY r_f) + (count(*) OVER (PARTITION BY r_f) - 1) / 2.0::DOUBLE AS b FROM cm WHERE ig IS NOT NULL AND r_f IS NOT NULL)
        SELECT round(corr(a, b), 6) AS rho, count(*) AS n FROM rk""",
    "signal_correlations": f"WITH {_SIGNALS} " + " UNION ALL ".join(_corr(a, b, "x") for i, a in enumerate(SIGNALS) for b in SIGNALS[i + 1 :]),
    "ece": f"""SELECT round(sum(n * abs(a - c)) / sum(n), 6) AS ece, sum(n)::BIGINT AS n FROM (SELECT least(floor(conf * {P.bins}), {P.bins - 1}) AS bin, count(*) AS n, avg(quality) AS a, avg(conf) AS c FROM (SELECT (doc_id % 100) / 100.0::DOUBLE AS conf, quality FROM labels) GROUP BY 1)""",
    "bootstrap_ci": f"""WITH {_CASE}, num AS (SELECT row_number() OVER (ORDER BY case_id) - 1 AS i, ig AS v FROM cm), n AS (SELECT count(*) AS n FROM cm),
        means AS (SELECT r, avg(v) AS m FROM (SELECT r, ('0x' || substring(md5(r || ':' || q), 1, 8))::BIGINT % n.n AS i FROM n, range(1, 1001) a(r), (SELECT unnest(range((SELECT n FROM n))) AS q)) JOIN num USING (i) GROUP BY r)
        SELECT (SELECT round(avg(ig), 6) FROM cm) AS mean, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high FROM means""",
    "holm": """WITH p AS (SELECT 'H' || (doc_id % 3 + 1) AS hypothesis, avg(1.0 - quality) / 10 AS p FROM labels GROUP BY 1),
        s AS (SELECT *, least(1.0, (count(*) OVER () - row_number() OVER (ORDER BY p, hypothesis) + 1) * p) AS step FROM p)
        SELECT hypothesis, round(p, 6) AS p, round(max(step) OVER (ORDER BY p, hypothesis), 6) AS adjusted FROM s""",
    "icc21": """WITH x AS (SELECT doc_id AS subject, r AS rater, (quality * 2 + (doc_id * r) % 3)::DOUBLE AS score FROM labels, range(1, 4) t(r)), g AS (SELECT avg(score) AS g FROM x),
        a AS (SELECT count(*) AS n, 3 * sum((m - g) * (m - g)) AS ss FROM (SELECT avg(score) AS m FROM x GROUP BY subject), g), b AS (SELECT count(*) AS k, (SELECT n FROM a) * sum((m - g) * (m - g)) AS ss FROM (SELECT avg(score) AS m FROM x GROUP BY rater), g),
        t AS (SELECT sum((score - g) * (score - g)) AS ss FROM x, g),
        m AS (SELECT n, k, a.ss / (n - 1) AS msr, b.ss / (k - 1) AS msc, (t.ss - a.ss - b.ss) / ((n - 1) * (k - 1)) AS mse FROM a, b, t)
        SELECT n AS subjects, k AS raters, round((msr - mse) / (msr + (k - 1) * mse + k * (msc - mse) / n), 6) AS icc FROM m""",
    "leave_one_source_out": """WITH x AS (SELECT source, quality FROM documents JOIN labels USING (doc_id))
        SELECT source AS held_out, round((SELECT avg(quality) FROM x y WHERE y.source <> x.source), 6) AS others, round(avg(quality), 6) AS own FROM x GROUP BY source""",
    "human_agreement": "SELECT quality::BIGINT AS quality, toxic::BIGINT AS toxic, count(*) AS n FROM labels GROUP BY ALL",
    "variance_comparison": _log("SELECT (SELECT round(var_samp(reward), 6) FROM r) AS by_turn, round(var_samp(total), 6) AS by_trajectory, round(var_samp(total / turns), 6) AS by_mean FROM trajectories"),
    "irrelevant_information": _log("SELECT round(sum(len(list_filter(fresh, lambda k: k % 6 <> 0))) / sum(len(fresh)), 6) AS share FROM r"),
    "estimator_bias": _log(
        f"""SELECT round(max(abs(r_p - p2)), 6) AS gap, max(abs(r_p - p2)) <= 0.4 AS within FROM (SELECT r_p, coalesce(lead(psi2) OVER (PARTITION BY conv_id ORDER BY t) - psi2, 0) AS p2 FROM
        (SELECT *, {P.alpha} * ({1 - P.beta} * list_sum(list_transform(b2, lambda p: p * log2(p))) + {P.beta} * list_sum(list_transform(b2, lambda p, i: p * ((i - 1) % 10) / 10.0::DOUBLE))) AS psi2 FROM
        (SELECT *, list_transform(b, lambda x: 0.99 * x + 0.01 / {P.atoms}) AS b2 FROM r)))"""
    ),
    "fact_acquisition": _log(
        f"""SELECT round(sum(got) / sum({len(range(0, P.facts, 6))}), 6) AS acquired, round(avg(delay), 6) AS delay, count(delay) AS emergencies
        FROM (SELECT max_by(len(list_filter(confirmed, lambda k: k % 6 = 0)), t) AS got, max(t) - min(first_hit) AS delay FROM r GROUP BY conv_id)"""
    ),
    "run_diagnostics": _log(
        """SELECT batch, count(*) AS trajectories, round(sum(rejections) / sum(turns), 6) AS rejected_share, round(avg(turns), 6) AS mean_turns, max(turns) AS most_turns
        FROM (SELECT batch, conv_id, count(*) AS turns, count(*) FILTER (WHERE gate = 'rejected') AS rejections FROM r GROUP BY ALL) GROUP BY batch"""
    ),
    "normalisation_ablation": f"""WITH {_CLUSTER}, x AS (SELECT batch, case_id, traj_id, avg(advantage) AS a, sum(reward) AS total FROM adv GROUP BY ALL)
        SELECT batch, round(var_pop(a), 6) AS turn_level, round(var_pop(total - m), 6) AS accumulated FROM (SELECT *, avg(total) OVER (PARTITION BY batch, case_id) AS m FROM x) GROUP BY batch""",
    "split_audit": "SELECT CASE WHEN conv_id % 10 < 8 THEN 'train' WHEN conv_id % 10 = 8 THEN 'dev' ELSE 'test' END AS split, count(DISTINCT conv_id) AS n FROM conversations GROUP BY ALL",
}
