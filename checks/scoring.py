"""Ranges, signals, draws, decisions, backtest, ranks, corridors and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.views import duck, view
from fluxsieve import fixed
from fluxsieve.functions import sampling
from fluxsieve.operators import remedies, validation
from fluxsieve.plans import backtest, corridors, decision, report, scoring, signals
from fluxsieve.session import shelve

FLOW = ["v_flowgates"]
SEED, DRAWS = 7, 40
PRIORS = {
    "version": "check-priors",
    "haircut": {"lo": 0.5, "mode": 0.7, "hi": 0.9},
    "gets": {
        fixed.RATING: {
            "relief_share": {"lo": 0.05, "mode": 0.15, "hi": 0.30},
            "annual_cost_musd": {"lo": 0.02, "mode": 0.05, "hi": 0.10},
            "applicability": dict(zip(fixed.EVIDENCE_CLASSES, (0.7, 0.5, 0.5, 0.8, 0.0, 0.0, 0.25, 0.0))),
            "relief_scale": {"interface": 0.5}},
        fixed.FLOW_CONTROL: {
            "relief_share": {"lo": 0.05, "mode": 0.10, "hi": 0.20},
            "annual_cost_musd": {"lo": 0.03, "mode": 0.08, "hi": 0.15},
            "applicability": dict(zip(fixed.EVIDENCE_CLASSES, (0.3, 0.7, 0.6, 0.0, 0.4, 0.6, 0.75, 0.3)))},
        fixed.TOPOLOGY: {
            "relief_share": {"lo": 0.02, "mode": 0.08, "hi": 0.15},
            "annual_cost_musd": {"lo": 0.01, "mode": 0.03, "hi": 0.08},
            "applicability": dict(zip(fixed.EVIDENCE_CLASSES, (0.1, 0.5, 0.7, 0.0, 0.1, 0.5, 0.4, 0.8)))},
    },
}
FORWARD = {"predictor": "months_binding_share",
           # values with many digits, so that no result sits on a rounding boundary
           "ratio_quantiles": {"0": 0.0, "0.25": 0.2123457, "0.5": 0.8123461, "0.75": 1.5123473, "0.99": 6.0, "1": 6.0}}


def _congestion(spark, folder):
    return view(spark, folder, "v_flowgates").select(
        "constraint_id", "hours_binding", "rent_musd", "max_month_cost_musd", "breached_hours", "months_binding")


def derive_references(spark, folder):
    r = scoring.derive_references(_congestion(spark, folder))
    return r.select("name", F.round("value", 9).alias("value"), "n")


def _sig4(x: str) -> str:
    return f"ROUND(CAST(printf('%.3e', {x}) AS DOUBLE), 9)"


REFERENCES = duck(FLOW, f""", v AS (
  SELECT 'rent_ref_musd' AS name, rent_musd AS x FROM v_flowgates UNION ALL SELECT 'persist_ref_hours', hours_binding FROM v_flowgates
  UNION ALL SELECT 'coi_ref_musd', CASE WHEN rent_musd IS NOT NULL AND max_month_cost_musd IS NOT NULL
                                   THEN greatest(rent_musd - max_month_cost_musd, 0) END FROM v_flowgates)
SELECT name, {_sig4('quantile_cont(x, 0.99)')} AS value, COUNT(x) AS n FROM v WHERE x IS NOT NULL GROUP BY 1""")


def congestion_ranges(spark, folder):
    r = signals.congestion_ranges(_congestion(spark, folder))
    parts = [F.round(f"{c}.{k}", 9).alias(f"{c}_{k}") for c in ("rent", "hours", "recurring") for k in ("lo", "expected", "hi")]
    return r.select("constraint_id", *parts)


RANGES = duck(FLOW, """
SELECT constraint_id, ROUND(0.6 * rent_musd, 9) AS rent_lo, ROUND(rent_musd, 9) AS rent_expected, ROUND(1.5 * rent_musd, 9) AS rent_hi,
       ROUND(0.8 * hours_binding, 9) AS hours_lo, hours_binding AS hours_expected, ROUND(1.2 * hours_binding, 9) AS hours_hi,
       ROUND(0.6 * c, 9) AS recurring_lo, ROUND(c, 9) AS recurring_expected, ROUND(1.5 * c, 9) AS recurring_hi
FROM (SELECT *, CASE WHEN rent_musd IS NOT NULL AND max_month_cost_musd IS NOT NULL THEN greatest(rent_musd - max_month_cost_musd, 0) END AS c
      FROM v_flowgates)""")


def assumed_rent(spark, folder):
    rows = view(spark, folder, "v_flowgates").select(
        "constraint_id", "hours_binding", (F.col("hours_binding") * 1000).alias("shadow_price_sum"))
    r = signals.congestion_ranges(rows)
    return r.select("constraint_id", *[F.round(f"rent.{k}", 9).alias(k) for k in ("lo", "expected", "hi")])


ASSUMED = duck(FLOW, """
SELECT constraint_id, ROUND(0.6 * hours_binding * 1000 * 100 / 1e6, 9) AS lo, ROUND(hours_binding * 1000 * 250 / 1e6, 9) AS expected,
       ROUND(1.5 * hours_binding * 1000 * 1200 / 1e6, 9) AS hi FROM v_flowgates""")


def _plans(flow):
    fix = F.when(F.pmod("ord", F.lit(2)) == 0, "ITP").otherwise("FCA")
    once = flow.where("ord % 4 = 0").select(
        "constraint_id", fix.alias("plan"), F.lit("rebuild").alias("proposed_fix"),
        F.pmod("ord", F.lit(300)).cast("double").alias("assigned_cost_musd"), "ord")
    again = flow.where("ord % 12 = 0").select(
        "constraint_id", F.lit("FCA").alias("plan"), F.lit("again").alias("proposed_fix"),
        F.pmod("ord", F.lit(500)).cast("double").alias("assigned_cost_musd"), (F.col("ord") + 1).alias("ord"))
    return signals.planning_items(once.unionByName(again))


PLANS = """, plans AS (SELECT constraint_id, CASE WHEN ord % 12 = 0 THEN 'FCA' WHEN ord % 2 = 0 THEN 'ITP' ELSE 'FCA' END AS plan,
  CASE WHEN ord % 12 = 0 THEN ord % 500 ELSE ord % 300 END AS cost FROM v_flowgates WHERE ord % 4 = 0)"""


def planning_items(spark, folder):
    p = _plans(view(spark, folder, "v_flowgates"))
    return p.select("constraint_id", "plan", "provider", F.round("plan_cost.lo", 9).alias("lo"),
                    F.round("plan_cost.hi", 9).alias("hi"))


PLANNING = duck(FLOW, PLANS + """
SELECT constraint_id, plan, CASE plan WHEN 'ITP' THEN 'spp_itp' ELSE 'spp_fca' END AS provider, ROUND(0.8 * cost, 9) AS lo,
       ROUND(1.4 * cost, 9) AS hi FROM plans""")


def _signals(spark, folder):
    """Signals where some flowgates are off the map, off the congestion table or off the plans."""
    flow = shelve(view(spark, folder, "v_flowgates"))  # five inputs are taken from it: hours are rolled up once
    constraints = flow.select(
        "constraint_id", "ctype", "ord", "radial", F.when(F.pmod("ord", F.lit(5)) > 0, F.concat(F.lit("L"), F.pmod("ord", F.lit(200)).cast("string"))).alias("monitored_line"),
        F.lit(None).cast("string").alias("contingency_line"), "monitored_facility", "contingency_facility",
        F.col("contingency").alias("contingency_name"))
    congestion = signals.congestion_ranges(flow.where("ord % 11 <> 0").select(
        "constraint_id", "hours_binding", "rent_musd", "max_month_cost_musd", "breached_hours", "months_binding"))
    load = F.pmod("ord", F.lit(17)) / 10.0
    loading = flow.select(
        "constraint_id", F.when(F.pmod("ord", F.lit(5)) > 0, "ok").otherwise("unmapped_monitored").alias("status"),
        F.when(F.pmod("ord", F.lit(5)) > 0, F.struct((load * 0.5).alias("lo"), load.alias("expected"), (load * 1.5).alias("hi")))
        .otherwise(F.struct(F.lit(0.0).alias("lo"), F.lit(0.0).alias("expected"), F.lit(0.0).alias("hi"))).alias("loading"))
    near = view(spark, folder, "v_lines").select("line_id", (F.col("length_mi") * 30).alias("mw"))
    return signals.build_signals(
        constraints, congestion, loading, near, _plans(flow),
        references={"rent_ref_musd": 5.3, "persist_ref_hours": 20.0, "coi_ref_musd": 3.0}, recurring_rent=True,
        table_coverage={"planning": "unobserved"})


SIG = PLANS + """, base AS (
  SELECT f.*, ord % 5 > 0 AS placed, ord % 11 <> 0 AS has, CASE WHEN max_month_cost_musd IS NOT NULL AND rent_musd IS NOT NULL
         THEN greatest(rent_musd - max_month_cost_musd, 0) END AS rec, p.cost, (ord % 17) / 10.0E0 AS load, COALESCE(l.length_mi * 30, 0) / 1000 AS q
  FROM v_flowgates f LEFT JOIN plans p ON f.constraint_id = p.constraint_id
  LEFT JOIN v_lines l ON f.ord % 5 > 0 AND l.line_id = 'L' || (f.ord % 200)), s AS (
  SELECT constraint_id, ctype, ord, placed, has, radial, hours_binding, breached_hours, months_binding, rent_musd, contingency, contingency_facility, monitored_facility,
    CASE WHEN NOT has THEN [0, 0, 0.05] WHEN rent_musd IS NULL THEN [0, 0, 0] ELSE [0.6 * rent_musd / 5.3E0, rent_musd / 5.3E0, 1.5 * rent_musd / 5.3E0] END AS rent,
    CASE WHEN NOT placed THEN [0, 0, 0] ELSE [load * 0.5, load, load * 1.5] END AS loading,
    CASE WHEN NOT has THEN [0, 0, 0.05] ELSE [0.8 * hours_binding / 20, hours_binding / 20, 1.2 * hours_binding / 20] END AS persistence,
    CASE WHEN NOT placed THEN [0, 0, 0] ELSE [greatest(0, q - 0.05), q, q + 0.05] END AS demand_pressure,
    CASE WHEN cost IS NULL THEN [0, 0, 0] ELSE [0.7, greatest(0.7, 0.5 + 0.5 * least(1.0, cost / 200.0)), 1.0] END AS planning,
    CASE WHEN NOT has THEN [0, 0, 0.05] WHEN rec IS NULL THEN [0, 0, 0] ELSE [0.6 * rec / 3, rec / 3, 1.5 * rec / 3] END AS cost_of_inaction,
    CASE WHEN has AND rent_musd IS NULL THEN 'unobserved' ELSE 'observed' END AS cov_rent,
    CASE WHEN placed THEN 'observed' ELSE 'unobserved' END AS cov_loading, 'observed' AS cov_persistence,
    CASE WHEN placed THEN 'observed' ELSE 'unobserved' END AS cov_demand_pressure,
    CASE WHEN cost IS NULL THEN 'unobserved' ELSE 'observed' END AS cov_planning,
    CASE WHEN has AND rec IS NULL THEN 'unobserved' ELSE 'observed' END AS cov_cost_of_inaction FROM base)"""
SIG_VIEWS = ["v_flowgates", "v_lines"]


def build_signals(spark, folder):
    s = _signals(spark, folder)
    return s.select("constraint_id", *[F.round(f"sig_{n}.{k}", 9).alias(f"{n}_{k}") for n in fixed.SIGNALS
                                       for k in ("lo", "expected", "hi")], *[f"cov_{n}" for n in fixed.SIGNALS])


BUILD_SIGNALS = duck(SIG_VIEWS, SIG + " SELECT constraint_id, " + ", ".join(
    f"ROUND({n}[{i + 1}], 9) AS {n}_{k}" for n in fixed.SIGNALS for i, k in enumerate(("lo", "expected", "hi")))
    + ", " + ", ".join(f"cov_{n}" for n in fixed.SIGNALS) + " FROM s")


def _uniform_sql(digest: str, slot: int) -> str:
    return f"(CAST('0x' || substr({digest}, {1 + 10 * slot}, 10) AS BIGINT) / 1099511627776.0E0)"


def _tri_sql(u: str, lo: str, mode: str, hi: str) -> str:
    return (f"CASE WHEN {lo} = {hi} THEN {mode} WHEN {u} * ({hi} - {lo}) < {mode} - {lo} "
            f"THEN {lo} + sqrt({u} * ({hi} - {lo}) * ({mode} - {lo})) "
            f"ELSE {hi} - sqrt((1.0E0 - {u}) * ({hi} - {lo}) * ({hi} - {mode})) END")


WEIGHTED = " + ".join(
    f"{float(w)}E0 * ({_tri_sql(f'u{i}', f'{n}[1]', f'{n}[2]', f'{n}[3]')})" for i, (n, w) in enumerate(fixed.DEFAULT_WEIGHTS.items()))
DRAWN = SIG + f""", hashed AS (
  SELECT s.*, d.draw, md5('{SEED}:' || d.draw || ':' || constraint_id || ':0') AS h0, md5('{SEED}:' || d.draw || ':' || constraint_id || ':1') AS h1
  FROM s CROSS JOIN (SELECT unnest(range(1, {DRAWS + 1})) AS draw) d), uni AS (
  SELECT *, {", ".join(_uniform_sql(f'h{i // 3}', i % 3) + f' AS u{i}' for i in range(6))} FROM hashed), comp AS (
  SELECT constraint_id, draw, {WEIGHTED} AS composite FROM uni)"""


def rank_stability(spark, folder):
    r = scoring.rank_stability(_signals(spark, folder), draws=DRAWS, top_fraction=0.05, seed=SEED, portable=True)
    return r.select("constraint_id", F.round("p_top_k", 9).alias("p_top_k"), F.round("composite_lo", 9).alias("composite_lo"),
                    F.round("composite_expected", 9).alias("composite_expected"), F.round("composite_hi", 9).alias("composite_hi"))


STABILITY = duck(SIG_VIEWS, DRAWN + f""", hits AS (
  SELECT constraint_id, COUNT(*) AS n FROM (SELECT constraint_id, row_number() OVER (PARTITION BY draw ORDER BY composite DESC, constraint_id) AS rn FROM comp)
  WHERE rn <= greatest(1, CAST(round_even((SELECT COUNT(*) FROM s) * 0.05, 0) AS BIGINT)) GROUP BY 1)
SELECT c.constraint_id, ROUND(COALESCE(MAX(h.n), 0) / {DRAWS}.0E0, 9) AS p_top_k, ROUND(quantile_cont(composite, 0.05), 9) AS composite_lo,
       ROUND(quantile_cont(composite, 0.5), 9) AS composite_expected, ROUND(quantile_cont(composite, 0.95), 9) AS composite_hi
FROM comp c LEFT JOIN hits h ON c.constraint_id = h.constraint_id GROUP BY 1""")


def composite_draws(spark, folder):
    """Mean composite per draw: every draw of every flowgate enters."""
    d = scoring.composite_draws(_signals(spark, folder), draws=DRAWS, seed=SEED, portable=True)
    return d.groupBy("draw").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("composite"), 9).alias("mean"))


COMPOSITE = duck(SIG_VIEWS, DRAWN + """
SELECT CAST(draw AS INT) AS draw, COUNT(*) AS n, ROUND(AVG(composite), 9) AS mean FROM comp GROUP BY 1""")


def monte_carlo(spark, folder):
    """The production form of rank stability: 64-bit keyed uniforms and 200 draws."""
    return scoring.rank_stability(_signals(spark, folder), draws=200, top_fraction=0.05, seed=SEED)


def distributions(spark, folder):
    """One draw per flowgate from each distribution family."""
    f = view(spark, folder, "v_flowgates").where("rent_musd is not null")
    h = sampling.portable_digest(F.lit(SEED), F.col("constraint_id"))
    rng = F.struct((F.col("rent_musd") * 0.6).alias("lo"), F.col("rent_musd").alias("expected"), (F.col("rent_musd") * 1.5).alias("hi"))
    f = f.withColumn("h", h).withColumn("r", rng)
    u1, u2 = sampling.portable_uniform(F.col("h"), 0), sampling.portable_uniform(F.col("h"), 1)
    return f.select("constraint_id", *[
        F.round(sampling.sample(F.col("r"), u1, u2, F.lit(d)), 6).alias(d) for d in ("uniform", "triangular", "lognormal")])


DISTRIBUTIONS = duck(FLOW, f""", x AS (
  SELECT constraint_id, rent_musd AS m, rent_musd * 0.6 AS lo, rent_musd * 1.5 AS hi, md5('{SEED}:' || constraint_id) AS h FROM v_flowgates WHERE rent_musd IS NOT NULL), y AS (
  SELECT *, {_uniform_sql('h', 0)} AS u1, {_uniform_sql('h', 1)} AS u2 FROM x)
SELECT constraint_id, ROUND(lo + u1 * (hi - lo), 6) AS uniform, ROUND({_tri_sql('u1', 'lo', 'm', 'hi')}, 6) AS triangular,
       ROUND(exp(ln(m) + (ln(hi) - ln(lo)) / (2 * 1.645) * sqrt(-2 * ln(1 - u1)) * cos(2 * pi() * u2)), 6) AS lognormal FROM y""")


# --- remedies and decisions ----------------------------------------------------------------

def _judged(spark, folder):
    from fluxsieve.plans.ranking import evidence

    return evidence(_signals(spark, folder))


JUDGED = SIG + """, j AS (
  SELECT *, contingency = 'BASE' AS base,
    CASE WHEN contingency <> 'BASE' THEN CASE WHEN contingency_facility LIKE '%:%' THEN trim(split_part(contingency_facility, ':', 2)) LIKE '% %'
      ELSE contingency_facility LIKE 'LN%' OR contingency_facility LIKE 'DBL%' OR contingency_facility LIKE 'XF%' END END AS branch,
    CASE WHEN has THEN breached_hours END AS br, CASE WHEN has THEN months_binding END AS mb FROM s), k AS (
  SELECT *, CASE WHEN ctype = 'loopflow' THEN 'Topology Optimization' WHEN ctype = 'interface' THEN 'Advanced Power Flow Control'
    WHEN (CASE WHEN placed THEN loading[2] >= 1.0 ELSE COALESCE(br >= 1, FALSE) END) AND persistence[2] >= 0.6 THEN 'Combination'
    WHEN placed AND ctype = 'thermal' AND COALESCE(radial, FALSE) THEN 'Dynamic Line Rating'
    WHEN placed OR ctype = 'transformer' OR (NOT base AND COALESCE(branch, FALSE)) THEN 'Advanced Power Flow Control'
    ELSE 'Dynamic Line Rating' END AS pick,
    CASE WHEN ctype IN ('loopflow', 'interface') THEN ctype WHEN ctype = 'transformer' THEN CASE WHEN base THEN 'transformer_base' ELSE 'transformer_n1' END
    WHEN COALESCE(radial, FALSE) THEN 'line_radial' WHEN base THEN 'line_base' WHEN mb <= 1 THEN 'line_n1_episodic' ELSE 'line_n1' END AS evidence,
    ctype = 'thermal' AND COALESCE(radial, FALSE) AS stub FROM j), r AS (
  SELECT *, CASE WHEN placed THEN [pick] ELSE list_filter([
      CASE WHEN ctype <> 'transformer' OR pick = 'Dynamic Line Rating' THEN 'Dynamic Line Rating' END,
      CASE WHEN NOT stub OR pick = 'Advanced Power Flow Control' THEN 'Advanced Power Flow Control' END,
      CASE WHEN NOT stub OR pick = 'Topology Optimization' THEN 'Topology Optimization' END,
      CASE WHEN (ctype <> 'transformer' AND NOT stub) OR pick = 'Combination' THEN 'Combination' END], lambda x: x IS NOT NULL) END AS opts FROM k)"""


def remedy_rules(spark, folder):
    j = _judged(spark, folder)
    return j.select("constraint_id", "base_case", "branch_outage", "evidence", "recommended_get", "corridor",
                    F.array_join("remedies", ";").alias("get_set"), remedies.remedy_label(F.col("remedies")).alias("get_shown"),
                    remedies.same_station(F.col("monitored_facility")).alias("same_station"), "get_basis")


SHORT = "CASE x WHEN 'Dynamic Line Rating' THEN 'DLR' WHEN 'Advanced Power Flow Control' THEN 'APFC' WHEN 'Topology Optimization' THEN 'TO' ELSE x END"
B = fixed.BASIS_TEXT
REMEDIES = duck(SIG_VIEWS, JUDGED + f"""
SELECT constraint_id, base AS base_case, branch AS branch_outage, evidence, pick AS recommended_get,
       CASE WHEN placed AND lid IS NOT NULL THEN lid WHEN monitored_facility <> '' THEN monitored_facility ELSE constraint_id END AS corridor,
       array_to_string(opts, ';') AS get_set,
       CASE WHEN len(opts) = 1 THEN opts[1] ELSE array_to_string(list_transform(opts[1:len(opts) - 1], lambda x: {SHORT}), ', ') || ' or '
         || list_transform(opts, lambda x: {SHORT})[len(opts)] END AS get_shown, station AS same_station,
       CASE WHEN placed THEN concat_ws('; ', 'ctype=' || ctype, CASE WHEN radial IS NULL THEN '{B["radial_meshed"]}' WHEN radial THEN 'radial=True' ELSE 'radial=False' END, '{B["heavy_screen"]}')
       ELSE concat_ws('; ', 'ctype=' || ctype, CASE WHEN radial IS NULL THEN 'radial=unknown' WHEN radial THEN 'radial=True' ELSE 'radial=False' END,
         CASE WHEN br IS NULL THEN '{B["heavy_unobserved"]}' ELSE 'heavy=DA breached hours (' || CAST(br AS BIGINT) || ' h)' END,
         CASE WHEN base THEN '{B["base"]}' WHEN branch THEN '{B["branch"]}' ELSE '{B["not_branch"]}' END,
         CASE WHEN pick = 'Combination' THEN '{B["combination"]}' WHEN ctype = 'transformer' THEN '{B["transformer"]}'
              WHEN ctype = 'thermal' AND pick = 'Advanced Power Flow Control' THEN '{B["flow_control"]}'
              WHEN ctype = 'thermal' AND pick = 'Dynamic Line Rating' THEN '{B["rating"]}' END,
         CASE WHEN ctype = 'thermal' AND station THEN '{B["caution"]}' END) END AS get_basis
FROM (SELECT *, 'L' || (ord % 200) AS lid, COALESCE(monitored_facility LIKE 'LN %' AND trim(split_part(substr(monitored_facility, 4), ' - ', 1))
      = trim(split_part(substr(monitored_facility, 4), ' - ', 2)), FALSE) AS station FROM r)""")


def _case(values: dict, default: float) -> str:
    return "CASE evidence " + " ".join(f"WHEN '{c}' THEN {float(v)}E0" for c, v in values.items()) + f" ELSE {default}E0 END"


def _mean(t: dict) -> float:
    return sum(t.values()) / 3.0


G = [PRIORS["gets"][g] for g in fixed.SINGLE_REMEDIES]
RATIO_MEAN = sum((p1 - p0) * (v1 + v0) / 2 for (p0, v0), (p1, v1) in zip(
    decision.quantile_points(FORWARD), decision.quantile_points(FORWARD)[1:]))
VALUED = JUDGED + f""", e AS (
  SELECT constraint_id, evidence, rent_musd, CASE WHEN placed THEN 'L' || (ord % 200) WHEN monitored_facility <> '' THEN monitored_facility ELSE constraint_id END AS element,
         rent_musd * least(mb, 12) / 12.0E0 AS point, {', '.join(_case(G[i]['applicability'], 0) + f' AS q{i}' for i in range(3))},
         {', '.join(str(_mean(G[i]['relief_share'])) + ' * ' + _case(G[i].get('relief_scale', {'line_n1': 1.0}), 1.0) + f' AS m{i}' for i in range(3))}
  FROM k WHERE has AND rent_musd IS NOT NULL), mu AS (
  SELECT *, {_mean(PRIORS['haircut'])} * point * {RATIO_MEAN} AS gain FROM e), mus AS (
  SELECT *, {', '.join(f"m{i} * gain - {_mean(G[i]['annual_cost_musd'])} AS mu{i + 1}" for i in range(3))},
         (1 - (1 - m0) * (1 - m1)) * gain - {_mean(G[0]['annual_cost_musd'])} - {_mean(G[1]['annual_cost_musd'])} AS mu4 FROM mu), combos AS (
  SELECT mus.*, (CASE WHEN a0 THEN q0 ELSE 1 - q0 END) * (CASE WHEN a1 THEN q1 ELSE 1 - q1 END) * (CASE WHEN a2 THEN q2 ELSE 1 - q2 END) AS w,
         greatest(0, CASE WHEN a0 THEN mu1 END, CASE WHEN a1 THEN mu2 END, CASE WHEN a2 THEN mu3 END, CASE WHEN a0 AND a1 THEN mu4 END) AS v, a0, a1, a2
  FROM mus CROSS JOIN (VALUES (TRUE), (FALSE)) x(a0) CROSS JOIN (VALUES (TRUE), (FALSE)) y(a1) CROSS JOIN (VALUES (TRUE), (FALSE)) z(a2)), chosen AS (
  SELECT *, CASE WHEN v = 0 THEN 0 WHEN a0 AND mu1 = v THEN 1 WHEN a1 AND mu2 = v THEN 2 WHEN a2 AND mu3 = v THEN 3 ELSE 4 END AS o FROM combos), exact AS (
  SELECT constraint_id, SUM(w * v) AS ev_mean, {', '.join(f"SUM(CASE WHEN o = {i} THEN w ELSE 0 END) AS p_best_{s}" for i, s in enumerate(fixed.REMEDY_SLUG.values()))},
         {', '.join(f"SUM(CASE WHEN o = {i} THEN w * v ELSE 0 END) AS ev_from_{s}" for i, s in enumerate(fixed.REMEDY_SLUG.values()) if i)}
  FROM chosen GROUP BY 1)"""
SPLIT = [f"p_best_{s}" for s in fixed.REMEDY_SLUG.values()] + [f"ev_from_{s}" for s in list(fixed.REMEDY_SLUG.values())[1:]]


def _elements(judged):
    return judged.select("constraint_id", F.col("corridor").alias("element"), "evidence", "rent", "months_binding")


def _decidable(spark, folder):
    return _elements(_judged(spark, folder))


def decide(spark, folder):
    d = decision.decide(_decidable(spark, folder), PRIORS, FORWARD)
    return d.select("constraint_id", F.round("ev_mean", 9).alias("ev_mean"), *[F.round(c, 9).alias(c) for c in SPLIT], "ev_get")


DECIDE = duck(SIG_VIEWS, VALUED + f"""
SELECT constraint_id, ROUND(ev_mean, 9) AS ev_mean, {', '.join(f'ROUND({c}, 9) AS {c}' for c in SPLIT)},
       CASE WHEN greatest(ev_from_dlr, ev_from_apfc, ev_from_to, ev_from_c) <= 0 THEN 'No cost-effective GET'
            WHEN ev_from_dlr >= greatest(ev_from_apfc, ev_from_to, ev_from_c) THEN 'Dynamic Line Rating'
            WHEN ev_from_apfc >= greatest(ev_from_to, ev_from_c) THEN 'Advanced Power Flow Control'
            WHEN ev_from_to >= ev_from_c THEN 'Topology Optimization' ELSE 'Combination' END AS ev_get FROM exact""")


def expected_values(spark, folder):
    prior = decision.prior_settings(PRIORS)
    v = decision.expected_values(_decidable(spark, folder).where("rent is not null"), prior, decision.rent_mean(FORWARD))
    return v.select("constraint_id", *[F.round(f"mu{i}", 9).alias(f"mu{i}") for i in (1, 2, 3, 4)],
                    F.array_join(decision.candidates(prior), ";").alias("candidates"))


EXPECTED = duck(SIG_VIEWS, VALUED + """
SELECT constraint_id, ROUND(mu1, 9) AS mu1, ROUND(mu2, 9) AS mu2, ROUND(mu3, 9) AS mu3, ROUND(mu4, 9) AS mu4,
       concat_ws(';', CASE WHEN q0 > 0 THEN 'Dynamic Line Rating' END, CASE WHEN q1 > 0 THEN 'Advanced Power Flow Control' END,
                 CASE WHEN q2 > 0 THEN 'Topology Optimization' END, CASE WHEN q0 > 0 AND q1 > 0 THEN 'Combination' END) AS candidates FROM mus""")


def realized_band(spark, folder):
    valued = decision.decide(_decidable(spark, folder), PRIORS, FORWARD)
    b = decision.realized_band(valued, PRIORS, draws=DRAWS, top_fraction=0.05, seed=SEED, forward=FORWARD, portable=True)
    return b.select("constraint_id", *[F.round(c, 9).alias(c) for c in ("ev_lo", "ev_expected", "ev_hi", "p_top_k")])


def _t(u: str, t: dict) -> str:
    return "(" + _tri_sql(u, f"{t['lo']}E0", f"{t['mode']}E0", f"{t['hi']}E0") + ")"


def _interp(u: str) -> str:
    pts = decision.quantile_points(FORWARD)
    parts = [f"WHEN {u} >= {pts[-1][0]} THEN {pts[-1][1]}"]
    for (p0, v0), (p1, v1) in reversed(list(zip(pts, pts[1:]))):
        parts.append(f"WHEN {u} >= {p0} THEN {v0} + ({u} - {p0}) * {(v1 - v0) / (p1 - p0)}")
    return f"(CASE {' '.join(parts)} ELSE {pts[0][1]} END)"


REALIZED = duck(SIG_VIEWS, VALUED + f""", h AS (
  SELECT mus.*, draw, {', '.join(f"md5('{SEED}:' || draw || ':t:{b}') AS t{b}" for b in range(3))},
         md5('{SEED}:' || draw || ':' || element || ':e:0') AS eh, md5('{SEED}:' || draw || ':' || constraint_id || ':r:0') AS rh
  FROM mus CROSS JOIN (SELECT unnest(range(1, {DRAWS + 1})) AS draw) d), u AS (
  SELECT constraint_id, draw, q0, q1, q2, mu1, mu2, mu3, mu4, evidence, {_t(_uniform_sql('t0', 0), PRIORS['haircut'])} * point * {_interp(_uniform_sql('rh', 0))} AS g,
         {', '.join(_t(_uniform_sql(f't{(1 + i) // 3}', (1 + i) % 3), G[i]['relief_share']) + ' * ' + _case(G[i].get('relief_scale', {'line_n1': 1.0}), 1.0) + f' AS x{i}' for i in range(3))},
         {', '.join(_t(_uniform_sql(f't{(4 + i) // 3}', (4 + i) % 3), G[i]['annual_cost_musd']) + f' AS c{i}' for i in range(3))},
         {', '.join(_uniform_sql('eh', i) + f' < q{i} AS a{i}' for i in range(3))} FROM h), v AS (
  SELECT *, greatest(0, CASE WHEN a0 THEN mu1 END, CASE WHEN a1 THEN mu2 END, CASE WHEN a2 THEN mu3 END, CASE WHEN a0 AND a1 THEN mu4 END) AS best FROM u), z AS (
  SELECT constraint_id, draw, CASE WHEN best = 0 THEN 0 WHEN a0 AND mu1 = best THEN x0 * g - c0 WHEN a1 AND mu2 = best THEN x1 * g - c1
         WHEN a2 AND mu3 = best THEN x2 * g - c2 ELSE (1 - (1 - x0) * (1 - x1)) * g - (c0 + c1) END AS realized FROM v), top AS (
  SELECT constraint_id, COUNT(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY draw ORDER BY realized DESC, constraint_id) AS rn FROM z)
  WHERE rn <= greatest(1, CAST(round_even((SELECT COUNT(*) FROM mus) * 0.05, 0) AS BIGINT)) AND realized > 0 GROUP BY 1)
SELECT z.constraint_id, ROUND(quantile_cont(realized, 0.05), 9) AS ev_lo, ROUND(quantile_cont(realized, 0.5), 9) AS ev_expected,
       ROUND(quantile_cont(realized, 0.95), 9) AS ev_hi, ROUND(COALESCE(MAX(top.n), 0) / {DRAWS}.0E0, 9) AS p_top_k
FROM z LEFT JOIN top ON z.constraint_id = top.constraint_id GROUP BY 1""")


def sensitivity_sweep(spark, folder):
    return decision.sensitivity_sweep(_decidable(spark, folder), PRIORS, FORWARD)


# --- backtest -------------------------------------------------------------------------------

def _splits_sql() -> str:
    rows = []
    for name, (train, held) in fixed.MONTH_SPLITS.items():
        t, h = ", ".join(map(str, train)), ", ".join(map(str, held))
        base = (f"SELECT constraint_id, '{name}' AS split, COALESCE(SUM(usd) FILTER (WHERE month IN ({t})), 0) AS trained, "
                f"COALESCE(SUM(usd) FILTER (WHERE month IN ({h})), 0) AS held, "
                f"COUNT(*) FILTER (WHERE month IN ({t}) AND usd > 0) AS active FROM v_monthly GROUP BY 1")
        rows.append(base)
    return " UNION ALL ".join(rows)


BACK = f""", per AS ({_splits_sql()}), pred AS (
  SELECT 'annual' AS predictor, split, constraint_id, trained, held, trained AS predicted FROM per
  UNION ALL SELECT 'months_binding_share', split, constraint_id, trained, held, trained * active / 6.0E0 FROM per), sized AS (
  SELECT predictor, split, greatest(1, CAST(round_even(COUNT(*) FILTER (WHERE predicted > 0) * 0.05, 0) AS BIGINT)) AS k,
         SUM(held) / SUM(trained) AS system FROM pred GROUP BY 1, 2), placed AS (
  SELECT p.*, k, system, row_number() OVER (PARTITION BY p.predictor, p.split ORDER BY predicted DESC, constraint_id) AS place,
         row_number() OVER (PARTITION BY p.predictor, p.split ORDER BY held DESC, constraint_id) AS best
  FROM pred p JOIN sized s ON p.predictor = s.predictor AND p.split = s.split)"""


def backtest_metrics(spark, folder):
    places = backtest.backtest_places(backtest.split_predictions(view(spark, folder, "v_monthly")))
    m = backtest.backtest_metrics(places)
    return m.withColumn("capture", F.round("capture", 9)).withColumn("overlap", F.round("overlap", 9))


BACKTEST = duck(["v_monthly"], BACK + """
SELECT predictor, split, MAX(k) AS k, ROUND(SUM(held) FILTER (WHERE place <= k) / SUM(held) FILTER (WHERE best <= k), 9) AS capture,
       ROUND(COUNT(*) FILTER (WHERE place <= k AND best <= k) / MAX(k), 9) AS overlap,
       COUNT(*) FILTER (WHERE place <= k AND held = 0) AS leaders_realizing_zero FROM placed GROUP BY 1, 2""")


def ratio_quantiles(spark, folder):
    places = backtest.backtest_places(backtest.split_predictions(view(spark, folder, "v_monthly")))
    q = backtest.ratio_quantiles(backtest.leader_ratios(places))
    return q.select("predictor", "p", F.round("value", 9).alias("value"))


POINTS = ", ".join(f"({p}, {p})" for p in fixed.QUANTILE_POINTS) + ", (1.0, 0.99)"
QUANTILES = duck(["v_monthly"], BACK + f""", ratio AS (SELECT predictor, held / predicted / system AS r FROM placed WHERE place <= k), q AS (
  SELECT predictor, list_sort(list(r)) AS rs FROM ratio GROUP BY 1), v AS (
  SELECT predictor, CAST(p AS DOUBLE) AS p, rs[CAST(FLOOR(pt * (len(rs) - 1)) AS BIGINT) + 1] AS lo, rs[CAST(CEIL(pt * (len(rs) - 1)) AS BIGINT) + 1] AS hi,
         pt * (len(rs) - 1) - FLOOR(pt * (len(rs) - 1)) AS part FROM q CROSS JOIN (SELECT CAST(a AS DOUBLE) AS p, CAST(b AS DOUBLE) AS pt FROM (VALUES {POINTS}) t(a, b)) w)
SELECT predictor, p, ROUND(CAST(printf('%.2e', lo + (hi - lo) * part) AS DOUBLE), 9) AS value FROM v""")


def quantile_means(spark, folder):
    places = backtest.backtest_places(backtest.split_predictions(view(spark, folder, "v_monthly")))
    m = backtest.quantile_mean(backtest.ratio_quantiles(backtest.leader_ratios(places)))
    return m.withColumn("mean", F.round("mean", 6))


MEANS = QUANTILES.replace("SELECT predictor, p, ROUND(CAST(printf", "SELECT predictor, ROUND(SUM((p - pp) * (value + pv) / 2), 6) AS mean FROM (SELECT *, lag(p) OVER w AS pp, lag(value) OVER w AS pv FROM (SELECT predictor, p, ROUND(CAST(printf") \
    + ") WINDOW w AS (PARTITION BY predictor ORDER BY p)) GROUP BY 1"


# --- ranks, corridors, reports ------------------------------------------------------------------

SCORED = ("composite_lo", "composite_expected", "composite_hi", "p_top_k", "ev_mean")
#: Columns that ``export_rows`` cannot do without, and those of a corridor's row.
LISTED = ("constraint_id", "corridor", "recommended_get", "remedies", "monitored_facility", "rent", "hours", "p_top_k", "composite_expected",
          "ev_mean", *[f"{c}_{n}" for c in ("sig", "cov") for n in fixed.SIGNALS])
ROLLED = ("constraint_id", "corridor", "recommended_get", "provenance", "ev_get", *SCORED)


def _ranked(spark, folder, *kept):
    """Flowgates ranked by exact decision value with the composite's expectation as stability.

    ``kept``: the columns that the query goes on with, all if there are none; ranks are given to rows without the others.
    """
    judged = shelve(_judged(spark, folder))
    value = decision.decide(_elements(judged), PRIORS, FORWARD).drop(
        "element", "evidence", "rent", "months_binding", "q0", "q1", "q2", "mu1", "mu2", "mu3", "mu4")
    total = sum((F.lit(w) * F.col(f"sig_{n}.expected") for n, w in fixed.DEFAULT_WEIGHTS.items()), F.lit(0.0))
    scored = judged.join(value, "constraint_id", "left").withColumn("composite_expected", F.round(total, 9)).withColumn(
        "composite_lo", F.col("composite_expected") * 0.9).withColumn("composite_hi", F.col("composite_expected") * 1.1).withColumn(
        "p_top_k", F.round(F.least(F.lit(1.0), F.col("composite_expected")), 1)).withColumn("ev_mean", F.round("ev_mean", 9))
    if kept:
        scored = scored.select(*dict.fromkeys([*kept, "ev_mean", "p_top_k", "composite_expected", "ord"]))
    return scoring.with_rank(scored, by_value=True)


EXPECT = " + ".join(f"{float(w)}E0 * {n}[2]" for n, w in fixed.DEFAULT_WEIGHTS.items())
RANKED = VALUED + f""", rk AS (
  SELECT *, row_number() OVER (ORDER BY ev_mean DESC NULLS LAST, p_top_k DESC, composite_expected DESC, ord) AS rank FROM (
    SELECT r.*, CASE WHEN placed THEN 'L' || (r.ord % 200) WHEN monitored_facility <> '' THEN monitored_facility ELSE r.constraint_id END AS corridor,
           ROUND({EXPECT}, 9) AS composite_expected, ROUND(least(1.0, ROUND({EXPECT}, 9)), 1) AS p_top_k, ROUND(x.ev_mean, 9) AS ev_mean, x.p_best_none
    FROM r LEFT JOIN exact x ON r.constraint_id = x.constraint_id))"""


def rank_flowgates(spark, folder):
    return _ranked(spark, folder, "constraint_id").select("rank", "constraint_id", "p_top_k", "composite_expected", "ev_mean")


def corridor_rollup(spark, folder):
    c = corridors.corridor_rollup(_ranked(spark, folder, *ROLLED))
    return c.select("corridor_rank", "physical_corridor", "representative_flowgate", "n_flowgates", "p_top_k", "composite_expected",
                    F.round("expected_topk_slots", 6).alias("expected_topk_slots"), "recommended_get",
                    "sum_composite_expected", "ev_mean",
                    "sum_ev_mean")


CORRIDORS = duck(SIG_VIEWS, RANKED + """, c AS (
  SELECT corridor, MIN(rank) AS best, COUNT(*) AS n, SUM(CAST(p_top_k AS DECIMAL(28, 12))) AS slots, SUM(CAST(composite_expected AS DECIMAL(28, 12))) AS total,
         SUM(CAST(ev_mean AS DECIMAL(28, 12))) AS ev FROM rk GROUP BY 1)
SELECT row_number() OVER (ORDER BY best) AS corridor_rank, c.corridor AS physical_corridor, k.constraint_id AS representative_flowgate, n AS n_flowgates,
       k.p_top_k, k.composite_expected, ROUND(CAST(slots AS DOUBLE), 6) AS expected_topk_slots, k.pick AS recommended_get,
       CAST(total AS DOUBLE) AS sum_composite_expected, k.ev_mean, CAST(ev AS DOUBLE) AS sum_ev_mean
FROM c JOIN rk k ON c.best = k.rank""")


def corridor_members(spark, folder):
    return corridors.corridor_members(_ranked(spark, folder, "constraint_id", "corridor"))


MEMBERS = duck(SIG_VIEWS, RANKED + """
SELECT corridor AS physical_corridor, row_number() OVER (PARTITION BY corridor ORDER BY rank) AS position, constraint_id FROM rk""")


def _export(spark, folder):
    return corridors.export_rows(_ranked(spark, folder, *LISTED))


def export_rows(spark, folder):
    return corridors.export_rows(_ranked(spark, folder)).select(
        "rank", "constraint_id", "physical_corridor", "p_top_k", "composite_expected", "recommended_get", "get_shown", "get_resolved",
        "get_set", "screen_status", "monitored_facility", "sig_rent", "sig_loading", "cov_rent", "cov_planning", "rent_musd",
        "hours_binding", "breached_hours", "months_binding", "ev_mean_musd", "caution", "get_evidence", "p_best_none")


EXPORT = duck(SIG_VIEWS, RANKED + f"""
SELECT rank, constraint_id, corridor AS physical_corridor, p_top_k, round_even(composite_expected, 4) AS composite_expected, pick AS recommended_get,
       CASE WHEN len(opts) = 1 THEN opts[1] ELSE array_to_string(list_transform(opts[1:len(opts) - 1], lambda x: {SHORT}), ', ') || ' or '
         || list_transform(opts, lambda x: {SHORT})[len(opts)] END AS get_shown, len(opts) = 1 AS get_resolved, array_to_string(opts, ';') AS get_set,
       CASE WHEN placed THEN 'ok' ELSE 'unmapped_monitored' END AS screen_status, monitored_facility, round_even(rent[2], 4) AS sig_rent,
       round_even(loading[2], 4) AS sig_loading, cov_rent, cov_planning, CASE WHEN has THEN round_even(rent_musd, 6) END AS rent_musd,
       CASE WHEN has THEN hours_binding END AS hours_binding, br AS breached_hours, mb AS months_binding, round_even(ev_mean, 6) AS ev_mean_musd,
       CASE WHEN monitored_facility LIKE 'LN %' AND trim(split_part(substr(monitored_facility, 4), ' - ', 1)) = trim(split_part(substr(monitored_facility, 4), ' - ', 2))
            THEN 'same_station_ends' ELSE '' END AS caution, evidence AS get_evidence, round_even(p_best_none, 4) AS p_best_none FROM rk""")


def top_flowgates(spark, folder):
    return corridors.top_flowgates(_export(spark, folder), 25).select("rank", "constraint_id", "ev_mean_musd")


def filter_rows(spark, folder):
    rows = corridors.filter_rows(_export(spark, folder), remedy=fixed.TOPOLOGY, min_p=0.2, search="k1", worth="yes", sort="ev_mean_musd",
                                 descending=True)
    return rows.select("rank", "constraint_id", "p_top_k")


def corridor_segments(spark, folder):
    ranked = _ranked(spark, folder, *ROLLED)
    buses = view(spark, folder, "v_points").select((F.col("id") * 2).alias("bus_id"), "lat", "lon")
    seg = corridors.corridor_segments(corridors.corridor_rollup(ranked), view(spark, folder, "v_lines"), buses)
    return seg.select("physical_corridor", "representative_flowgate", "from_lat", "from_lon", "to_lat", "to_lon", "has_geometry")


SEGMENTS = duck(SIG_VIEWS + ["v_points"], RANKED + """, c AS (SELECT corridor, MIN(rank) AS best FROM rk GROUP BY 1), g AS (
  SELECT c.corridor, k.constraint_id, f.lat AS flat, f.lon AS flon, t.lat AS tlat, t.lon AS tlon FROM c JOIN rk k ON c.best = k.rank
  LEFT JOIN v_lines l ON c.corridor = l.line_id LEFT JOIN v_points f ON l.from_bus = f.id * 2 LEFT JOIN v_points t ON l.to_bus = t.id * 2)
SELECT corridor AS physical_corridor, constraint_id AS representative_flowgate, CASE WHEN tlat IS NOT NULL THEN flat END AS from_lat,
       CASE WHEN tlat IS NOT NULL THEN flon END AS from_lon, CASE WHEN flat IS NOT NULL THEN tlat END AS to_lat,
       CASE WHEN flat IS NOT NULL THEN tlon END AS to_lon, flat IS NOT NULL AND tlat IS NOT NULL AS has_geometry FROM g""")


def corridor_detail(spark, folder):
    ranked = shelve(_ranked(spark, folder))
    d = corridors.corridor_detail(corridors.corridor_rollup(ranked), corridors.export_rows(ranked))
    return d.groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("value").cast("decimal(28,6)")).cast("double"), 3).alias("total"))


_ITEMS = [("signal", n, f"{n}[2]", 4) for n in fixed.SIGNALS] + [("p_best", o, f"x.p_best_{t}", 4) for o, t in fixed.REMEDY_SLUG.items()] + [
    ("ev_from_musd", o, f"x.ev_from_{t}", 6) for o, t in fixed.REMEDY_SLUG.items() if o != fixed.NO_REMEDY]
DETAIL = duck(SIG_VIEWS, RANKED + f""", best AS (SELECT * FROM rk QUALIFY row_number() OVER (PARTITION BY corridor ORDER BY rank) = 1), items AS (
  {" UNION ALL ".join(f"SELECT '{k}' AS kind, '{n}' AS name, round_even({v}, {places}) AS value FROM best LEFT JOIN exact x ON x.constraint_id = best.constraint_id"
                      for k, n, v, places in _ITEMS)})
SELECT kind, name, COUNT(*) AS n, ROUND(CAST(SUM(CAST(value AS DECIMAL(28, 6))) AS DOUBLE), 3) AS total FROM items
WHERE value IS NOT NULL OR kind = 'signal' GROUP BY 1, 2""")


PAGE_FIELDS = ("rank int, constraint_id string, physical_corridor string, p_top_k double, composite_expected double, rent_musd double, "
               "get_shown string, ev_mean_musd double")


def page_rows(spark, folder):
    """The page's JSON rows, read back."""
    page = corridors.page_rows(_export(spark, folder), 30)
    return page.select(F.from_json("row_json", PAGE_FIELDS).alias("r")).select("r.*")


PAGE_ROWS = f"""
SELECT rank, constraint_id, physical_corridor, round_even(p_top_k, 3) AS p_top_k, round_even(composite_expected, 3) AS composite_expected,
       round_even(rent_musd, 2) AS rent_musd, get_shown, round_even(ev_mean_musd, 3) AS ev_mean_musd FROM ({EXPORT}) WHERE rank <= 30"""


def signal_coverage(spark, folder):
    return report.signal_coverage(_signals(spark, folder))


COVERAGE = duck(SIG_VIEWS, SIG + "".join([", l AS (", " UNION ALL ".join(
    f"SELECT '{n}' AS signal, {w}E0 AS weight, cov_{n} AS c FROM s" for n, w in fixed.DEFAULT_WEIGHTS.items()), ")"]) + """
SELECT signal, COUNT(*) FILTER (WHERE c = 'observed') AS observed, COUNT(*) FILTER (WHERE c = 'unobserved') AS unobserved, MAX(weight) AS weight,
       CASE WHEN COUNT(*) FILTER (WHERE c = 'observed') = 0 THEN 'unobserved for all ' || COUNT(*) || ' flowgates: contributes 0 to every composite and cannot change the order'
            WHEN COUNT(*) FILTER (WHERE c = 'unobserved') > 0 THEN 'unobserved for ' || COUNT(*) FILTER (WHERE c = 'unobserved') || ' of ' || COUNT(*)
              || ' flowgates: those are compared without it, so they are biased low on this signal' END AS effect FROM l GROUP BY 1""")


def gap_list(spark, folder):
    tables = spark.createDataFrame([("planning", "unobserved", "no table"), ("queue", "observed", ""), ("congestion", "partial", "some rows")],
                                   "table string, coverage string, note string")
    return report.gap_list(tables, report.signal_coverage(_signals(spark, folder)))


GAP_LIST = f"""
WITH cov AS ({COVERAGE}), w AS (SELECT COALESCE(SUM(weight) FILTER (observed = 0), 0) AS weight, SUM(unobserved) AS gaps FROM cov)
SELECT 'planning: unobserved — no table' AS gap UNION ALL SELECT 'congestion: partial — some rows'
UNION ALL SELECT 'composite: ' || printf('%.2f', weight) || ' of the configured weight is unobserved for every flowgate; the ranking rests on the remaining '
  || printf('%.2f', 1 - weight) || '.' FROM w WHERE gaps > 0"""


def mixes(spark, folder):
    return report.mixes(_judged(spark, folder))


MIXES = duck(SIG_VIEWS, JUDGED + """
SELECT 'recommended_get' AS kind, pick AS name, COUNT(*) AS n FROM r GROUP BY 2
UNION ALL SELECT 'get_set', array_to_string(opts, ';'), COUNT(*) FROM r GROUP BY 2
UNION ALL SELECT 'screen_status', CASE WHEN placed THEN 'ok' ELSE 'unmapped_monitored' END, COUNT(*) FROM r GROUP BY 2""")


def negative_recurring(spark, folder):
    n = validation.negative_recurring_rent(view(spark, folder, "v_flowgates").withColumn(
        "max_month_cost_musd", F.when(F.pmod("ord", F.lit(13)) == 0, F.col("rent_musd") + 1).otherwise(F.col("max_month_cost_musd"))))
    return n.withColumn("recurring_musd", F.round("recurring_musd", 6))


def disordered_ranges(spark, folder):
    s = _signals(spark, folder).withColumn("r", F.struct(
        F.col("sig_loading.hi").alias("lo"), F.col("sig_loading.expected").alias("expected"), F.col("sig_loading.hi").alias("hi")))
    return validation.disordered_ranges(s, "r", "constraint_id").select("constraint_id")


def replay_comparison(spark, folder):
    """Digests of two runs of the same table joined by artifact; only changed rows come back."""
    f = view(spark, folder, "v_flowgates")
    old = f.select(F.col("constraint_id").alias("artifact"), F.sha2(F.col("hours_binding").cast("bigint").cast("string"), 256).alias("sha256"))
    new = f.where("ord % 10 <> 3").select(
        F.col("constraint_id").alias("artifact"),
        F.sha2((F.col("hours_binding") + F.when(F.pmod("ord", F.lit(10)) == 4, 1).otherwise(0)).cast("bigint").cast("string"), 256).alias("sha256"))
    return validation.digest_mismatches(old, new, "artifact")


REPLAY = duck(FLOW, """
SELECT constraint_id AS artifact, sha256(CAST(CAST(CAST(hours_binding AS BIGINT) AS VARCHAR) AS BLOB)) AS recorded,
       CASE WHEN ord % 10 <> 3 THEN sha256(CAST(CAST(CAST(hours_binding AS BIGINT) + 1 AS VARCHAR) AS BLOB)) END AS found
FROM v_flowgates WHERE ord % 10 IN (3, 4)""")

QUERIES = {
    "derive_references": (derive_references, REFERENCES),
    "congestion_ranges": (congestion_ranges, RANGES),
    "assumed_rent": (assumed_rent, ASSUMED),
    "planning_items": (planning_items, PLANNING),
    "build_signals": (build_signals, BUILD_SIGNALS),
    "composite_draws": (composite_draws, COMPOSITE),
    "rank_stability": (rank_stability, STABILITY),
    "monte_carlo": (monte_carlo, None),
    "distributions": (distributions, DISTRIBUTIONS),
    "remedy_rules": (remedy_rules, REMEDIES),
    "expected_values": (expected_values, EXPECTED),
    "decide": (decide, DECIDE),
    "realized_band": (realized_band, REALIZED),
    "sensitivity_sweep": (sensitivity_sweep, None),
    "backtest_metrics": (backtest_metrics, BACKTEST),
    "ratio_quantiles": (ratio_quantiles, QUANTILES),
    "quantile_means": (quantile_means, MEANS),
    "rank_flowgates": (rank_flowgates, duck(SIG_VIEWS, RANKED + " SELECT rank, constraint_id, p_top_k, composite_expected, ev_mean FROM rk")),
    "corridor_rollup": (corridor_rollup, CORRIDORS),
    "corridor_members": (corridor_members, MEMBERS),
    "export_rows": (export_rows, EXPORT),
    "top_flowgates": (top_flowgates, duck(SIG_VIEWS, RANKED + " SELECT rank, constraint_id, round_even(ev_mean, 6) AS ev_mean_musd FROM rk WHERE rank <= 25")),
    "filter_rows": (filter_rows, duck(SIG_VIEWS, RANKED + """ SELECT rank, constraint_id, p_top_k FROM rk WHERE p_top_k >= 0.2 AND ev_mean > 0
AND list_contains(opts, 'Topology Optimization') AND lower(concat_ws(' ', constraint_id, corridor, monitored_facility)) LIKE '%k1%'""")),
    "corridor_segments": (corridor_segments, SEGMENTS),
    "corridor_detail": (corridor_detail, DETAIL),
    "page_rows": (page_rows, PAGE_ROWS),
    "signal_coverage": (signal_coverage, COVERAGE),
    "gap_list": (gap_list, GAP_LIST),
    "remedy_mixes": (mixes, MIXES),
    "negative_recurring_rent": (negative_recurring, duck(FLOW, """
SELECT constraint_id, ROUND(-1.0, 6) AS recurring_musd FROM v_flowgates WHERE ord % 13 = 0 AND rent_musd IS NOT NULL
UNION ALL SELECT constraint_id, ROUND(rent_musd - max_month_cost_musd, 6) FROM v_flowgates WHERE ord % 13 <> 0 AND rent_musd - max_month_cost_musd < -1e-9""")),
    "disordered_ranges": (disordered_ranges, duck(SIG_VIEWS, SIG + " SELECT constraint_id FROM s WHERE loading[3] > loading[2]")),
    "replay_comparison": (replay_comparison, REPLAY),
}
