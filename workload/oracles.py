"""DuckDB SQL for every query, composed from named common table expressions."""

from __future__ import annotations

import re

from workload import fixtures as fx

RUN_TS = "2026-01-01T00:00:00+00:00"
PRIME = 2147483647
COHORT = (
    "study_id, patient_id, treatment, age, risk_score, prior_cost, pre_outcome, post_outcome"
)
COVARIATES = ("age", "risk_score", "prior_cost")

_CTES: dict[str, str] = {}
_ORACLES: dict[str, str] = {}


def _compose(final: str) -> str:
    """Prefix ``final`` with the expressions it reads, directly or not, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_][a-z0-9_]*", text)):
            if word in _CTES and word not in order:
                visit(_CTES[word])
                order.append(word)

    visit(final)
    if not order:
        return final
    parts = ",\n".join(f"{name} as materialized ({_CTES[name]})" for name in order)
    return f"with {parts}\n{final}"


def _oracle(key: str, sql: str) -> None:
    _ORACLES[key] = sql


def all_oracles() -> dict[str, str]:
    return {key: _compose(sql) for key, sql in _ORACLES.items()}


# --- study tables --------------------------------------------------------------------------

_CTES["x_covariates"] = """
select c_custkey as patient_id, c_mktsegment as segment,
       cast(coalesce(b.u, 0) as int) as treatment,
       40.0e0 + (c_acctbal + 1000.0e0) / 11000.0e0 * 50.0e0 as age,
       b.n / 3.0e0 as risk_score,
       coalesce(b.s, 0.0e0) / 100.0e0 as prior_cost,
       coalesce(p0.s, 0.0e0) / 100.0e0 as pre_outcome,
       coalesce(p1.s, 0.0e0) / 100.0e0 as post_outcome
from customer
left join (select o_custkey as k, count(*) as n, cast(sum(cast(o_totalprice as decimal(18, 4))) as double) as s,
                  max(case when o_orderpriority = '1-URGENT' then 1 else 0 end) as u
           from orders where o_orderdate < timestamp '1998-01-01 00:00:00' group by o_custkey) b on b.k = c_custkey
left join (select o_custkey as k, cast(sum(cast(o_totalprice as decimal(18, 4))) as double) as s from orders
           where year(o_orderdate) = 1997 group by o_custkey) p0 on p0.k = c_custkey
left join (select o_custkey as k, cast(sum(cast(o_totalprice as decimal(18, 4))) as double) as s from orders
           where year(o_orderdate) = 1998 group by o_custkey) p1 on p1.k = c_custkey"""
_CTES["x_cohorts"] = f"""
select concat('SEG_', segment) as study_id, patient_id, treatment, age, risk_score, prior_cost,
       pre_outcome, post_outcome from x_covariates"""
_CTES["x_pe"] = """
select case patient_id % 3 when 0 then 'PE_ATT' when 1 then 'PE_RANK' else 'PE_SKEW' end as study_id,
       patient_id, treatment, age, risk_score, prior_cost, pre_outcome,
       case when patient_id % 3 = 2 then post_outcome * post_outcome / 1000.0e0 else post_outcome end as post_outcome
from x_covariates"""
_CTES["x_panel"] = """
select case when patient_id % 2 = 0 then 'LME_MIXED' else 'LME_GROWTH' end as study_id,
       patient_id, treatment, age,
       case when patient_id % 29 = 0 then null else risk_score end as risk_score, prior_cost,
       cast(year(o_orderdate) - 1997 as int) as period, cast(sum(cast(o_totalprice as decimal(18, 4))) as double) / 100.0e0 as outcome
from x_covariates join orders on o_custkey = patient_id
where year(o_orderdate) between 1997 and 2000
group by patient_id, treatment, age, risk_score, prior_cost, year(o_orderdate)"""
_CTES["x_config"] = fx.STUDY_CONFIG_SQL
_CTES["x_modular"] = fx.MODULAR_CONFIG_SQL
_CTES["x_pe_config"] = fx.PE_CONFIG_SQL
_CTES["x_families"] = """
select *, coalesce(nullif(model_family, ''), 'standard') as family from x_modular"""
_CTES["x_methods"] = """
select study_id, family,
       case when family <> 'standard' then 'panel' else substr(feature_nb, 9) end as feature_method,
       case when matching_nb = 'matching_stratified' then 'stratified' else matching_method end as matching_method,
       case when family <> 'standard' then family else substr(model_nb, 7) end as model_method,
       min_quality_score, active, performance_months
from x_families"""


def _scores(source: str) -> str:
    return f"""
select study_id, count(*) as n_total, count(*) filter (treatment = 1) as n_treated,
       count(*) filter (treatment = 0) as n_control,
       avg(case when risk_score is null then 1.0e0 else 0.0e0 end) as missing_fraction,
       round(0.6e0 * (1.0e0 - avg(case when risk_score is null then 1.0e0 else 0.0e0 end))
             + 0.4e0 * least(1.0e0, least(count(*) filter (treatment = 1),
                                          count(*) filter (treatment = 0)) / 100.0e0), 3) as quality_score
from {source} group by study_id"""


def _status(config: str, scores: str) -> str:
    return f"""
select c.*, n_total, n_treated, n_control, missing_fraction, quality_score,
       coalesce(quality_score >= min_quality_score, false) as quality_passed
from {config} c left join {scores} s on s.study_id = c.study_id"""


_CTES["x_scores"] = _scores("x_cohorts")
_CTES["x_pe_scores"] = _scores("x_pe")
_CTES["x_all_scores"] = (
    f"select * from x_scores union all {_scores('(select * from x_panel where period = 0)')}"
)
_CTES["x_status"] = _status("x_config", "x_scores")
_CTES["x_modular_status"] = _status("x_methods", "x_all_scores")
_CTES["x_pe_status"] = _status("x_pe_config", "x_pe_scores")


# --- features ------------------------------------------------------------------------------

_CTES["x_global"] = """
select study_id, patient_id, treatment, age, coalesce(risk_score, m) as risk_score, prior_cost,
       pre_outcome, post_outcome
from x_cohorts left join
  (select study_id, quantile_cont(risk_score, 0.5) as m from x_cohorts group by study_id) g
using (study_id)"""
_CTES["x_arm"] = """
select study_id, patient_id, treatment, age, coalesce(risk_score, m) as risk_score, prior_cost,
       pre_outcome, post_outcome
from x_cohorts left join
  (select study_id, treatment, quantile_cont(risk_score, 0.5) as m from x_cohorts
   group by study_id, treatment) g using (study_id, treatment)"""
_CTES["x_pe_global"] = """
select study_id, patient_id, treatment, age, coalesce(risk_score, m) as risk_score, prior_cost,
       pre_outcome, post_outcome
from x_pe left join (select study_id, quantile_cont(risk_score, 0.5) as m from x_pe group by study_id) g
using (study_id)"""
_CTES["x_seg"] = f"""
select {COHORT} from x_arm where study_id in
  (select study_id from x_status where quality_passed and feature_method = 'aggressive_impute')
union all
select {COHORT} from x_global where study_id in
  (select study_id from x_status where quality_passed and feature_method <> 'aggressive_impute')"""
_CTES["x_window"] = """
select p.*, performance_months from x_panel p join x_methods using (study_id)"""
_CTES["x_base_median"] = """
select study_id, quantile_cont(risk_score, 0.5) as m from x_panel where period = 0 group by study_id"""
_CTES["x_perf"] = """
select study_id, patient_id, avg(outcome) as post_outcome from x_window
where period between 1 and performance_months group by study_id, patient_id"""
_CTES["x_panel_feat"] = """
select b.study_id, b.patient_id, treatment, age, coalesce(risk_score, m) as risk_score, prior_cost,
       outcome as pre_outcome, post_outcome, coalesce(slope, 0.0e0) as slope
from x_panel b join x_perf using (study_id, patient_id)
join x_base_median using (study_id)
join (select study_id, patient_id, regr_slope(outcome, period) as slope from x_window
      where period between 0 and performance_months group by study_id, patient_id) s
  using (study_id, patient_id)
where period = 0"""
_CTES["x_all_feat"] = f"""
select {COHORT}, cast(null as double) as slope from x_seg
union all select {COHORT}, slope from x_panel_feat"""


# --- matching ------------------------------------------------------------------------------

_BINS = """
       case when age > 0 and age <= 50 then 0 when age > 50 and age <= 60 then 1
            when age > 60 and age <= 70 then 2 when age > 70 and age <= 200 then 3 end as age_b,
       case when risk_score > 0 and risk_score <= 1 then 0 when risk_score > 1 and risk_score <= 1.5e0 then 1
            when risk_score > 1.5e0 and risk_score <= 2 then 2
            when risk_score > 2 and risk_score <= 100 then 3 end as risk_b"""


def _newton(prefix: str, source: str, steps: int = 12) -> None:
    """Propensity scores ``{prefix}_ps`` of ``source``: unrolled Newton steps."""
    cols = ["1.0e0", "z1", "z2", "z3"]
    _CTES[f"{prefix}_z"] = f"""
select s.*, (age - ma) / (sa + 1e-9) as z1, (risk_score - mr) / (sr + 1e-9) as z2,
       (prior_cost - mp) / (sp + 1e-9) as z3
from {source} s join (select study_id, avg(age) as ma, stddev_pop(age) as sa, avg(risk_score) as mr,
  stddev_pop(risk_score) as sr, avg(prior_cost) as mp, stddev_pop(prior_cost) as sp
  from {source} group by study_id) m using (study_id)"""
    _CTES[f"{prefix}_b0"] = (
        f"select study_id, 0.0e0 as b0, 0.0e0 as b1, 0.0e0 as b2, 0.0e0 as b3 from {prefix}_z group by study_id"
    )
    eta = "b0 + b1 * z1 + b2 * z2 + b3 * z3"
    for step in range(1, steps + 1):
        sums = [f"sum((treatment - p) * {c}) as a{i}4" for i, c in enumerate(cols)]
        sums += [
            f"sum(greatest(p * (1.0e0 - p), 1e-6) * {cols[i]} * {cols[j]})"
            + (" + 1e-6" if i == j else "") + f" as a{i}{j}"
            for i in range(4) for j in range(4)
        ]
        text = (
            f"select study_id, b0, b1, b2, b3, {', '.join(sums)} from"
            f" (select *, 1.0e0 / (1.0e0 + exp(-({eta}))) as p from {prefix}_z join {prefix}_b{step - 1} using (study_id)) q"
            " group by study_id, b0, b1, b2, b3"
        )
        # Gauss-Jordan elimination, one nested select per pivot.
        for k in range(4):
            cells = []
            for i in range(4):
                for j in range(5):
                    if i == k:
                        cells.append(f"a{k}{j} / a{k}{k} as a{i}{j}")
                    else:
                        cells.append(f"a{i}{j} - a{i}{k} * a{k}{j} / a{k}{k} as a{i}{j}")
            text = f"select study_id, b0, b1, b2, b3, {', '.join(cells)} from ({text}) e{k}"
        _CTES[f"{prefix}_b{step}"] = (
            f"select study_id, b0 + a04 as b0, b1 + a14 as b1, b2 + a24 as b2, b3 + a34 as b3 from ({text}) f"
        )
    _CTES[f"{prefix}_ps"] = (
        f"select *, least(greatest(1.0e0 / (1.0e0 + exp(-({eta}))), 0.01e0), 0.99e0) as ps"
        f" from {prefix}_z join {prefix}_b{steps} using (study_id)"
    )


def _matchings(prefix: str, source: str, columns: str = COHORT) -> None:
    """All four matchings of ``source``, and their union ``{prefix}_grid``."""
    _newton(prefix, source)
    _CTES[f"{prefix}_bins"] = f"select *, {_BINS} from {source}"
    _CTES[f"{prefix}_strata"] = (
        "select study_id, age_b, risk_b, count(*) filter (treatment = 1) as n_treated,"
        f" count(*) filter (treatment = 0) as n_control from {prefix}_bins"
        " where age_b is not null and risk_b is not null group by study_id, age_b, risk_b"
        " having count(distinct treatment) = 2"
    )
    _CTES[f"{prefix}_exact"] = (
        f"select {columns}, 1.0e0 as weight, concat('p:', patient_id) as unit_id"
        f" from {prefix}_bins join {prefix}_strata using (study_id, age_b, risk_b)"
    )
    _CTES[f"{prefix}_stratified"] = (
        f"select {columns}, 1.0e0 / count(*) over (partition by study_id, age_b, risk_b, treatment) as weight,"
        f" concat('p:', patient_id) as unit_id"
        f" from {prefix}_bins join {prefix}_strata using (study_id, age_b, risk_b)"
    )
    _CTES[f"{prefix}_raw"] = (
        f"select {columns}, case when treatment = 1 then 1.0e0 / ps else 1.0e0 / (1.0e0 - ps) end as weight,"
        f" concat('p:', patient_id) as unit_id from {prefix}_ps"
    )
    _CTES[f"{prefix}_ipw"] = (
        f"select {columns}, least(weight, cut) as weight, unit_id from {prefix}_raw join"
        f" (select study_id, quantile_cont(weight, 0.99) as cut from {prefix}_raw group by study_id) c using (study_id)"
    )
    _CTES[f"{prefix}_pairs"] = (
        "select t.study_id, t.patient_id as treated_id, c.patient_id as control_id"
        f" from {prefix}_ps t join {prefix}_ps c on c.study_id = t.study_id and c.treatment = 0"
        " where t.treatment = 1"
        " qualify row_number() over (partition by t.study_id, t.patient_id"
        " order by abs(c.ps - t.ps), c.patient_id) = 1"
    )
    qualified = ", ".join(f"s.{name.strip()}" for name in columns.split(","))
    _CTES[f"{prefix}_knn"] = (
        f"select {qualified}, 1.0e0 as weight, concat('t:', treated_id) as unit_id from {prefix}_pairs p"
        f" join {source} s on s.study_id = p.study_id and s.patient_id = p.treated_id union all"
        f" select {qualified}, 1.0e0 as weight, concat('c:', treated_id) as unit_id from {prefix}_pairs p"
        f" join {source} s on s.study_id = p.study_id and s.patient_id = p.control_id"
    )
    _CTES[f"{prefix}_grid"] = " union all ".join(
        f"select *, '{m}' as matching_method from {prefix}_{m}"
        for m in ("exact", "stratified", "ipw", "knn")
    )


_matchings("g", "x_seg")
_matchings("p", "x_panel_feat", COHORT + ", slope")
_matchings("e", "x_all_feat", COHORT + ", slope")
_matchings("q", "x_pe_global")
_matchings("c", "x_cohorts")

_CTES["x_configured"] = """
select g.* from e_grid g join x_methods m on m.study_id = g.study_id and m.matching_method = g.matching_method"""
_CTES["x_none"] = f"select {COHORT}, 1.0e0 as weight, concat('p:', patient_id) as unit_id from x_cohorts"


# --- estimators ----------------------------------------------------------------------------

def _contrast(source: str, outcome: str, keys: str = "study_id") -> str:
    def mean(arm: int) -> str:
        return (
            f"sum(weight * ({outcome})) filter (treatment = {arm}) / sum(weight) filter (treatment = {arm})"
        )
    return f"select {keys}, {mean(1)} - {mean(0)} as estimate from {source} group by {keys}"


def _regression(source: str, covariates: tuple[str, ...], keys: str) -> str:
    """Weighted least squares with intercept: elimination on centred columns, treatment last.

    Null when a pivot shrinks to 1e-12 of its diagonal: the effect is then not identified.
    """
    names = [*covariates, "treatment", "post_outcome"]
    means = ", ".join(f"sum(weight * {n}) / sum(weight) as m_{n}" for n in names)
    size = len(names)
    cells = ", ".join(
        f"sum(weight * ({names[i]} - m_{names[i]}) * ({names[j]} - m_{names[j]})) as a{i}_{j}"
        for i in range(size - 1) for j in range(size)
    )
    kept = ", ".join(f"d{i}" for i in range(size - 1))
    text = (
        f"select {keys}, {cells} from {source} join (select {keys}, {means} from {source} group by {keys}) m"
        f" using ({keys}) group by {keys}"
    )
    text = f"select *, {', '.join(f'a{i}_{i} as d{i}' for i in range(size - 1))} from ({text}) d"
    for k in range(size - 2):
        pivot = f"case when a{k}_{k} > 1e-12 * d{k} then a{k}_{k} end"
        cells = ", ".join(
            f"a{i}_{j} - a{i}_{k} * a{k}_{j} / ({pivot}) as a{i}_{j}"
            for i in range(k + 1, size - 1) for j in range(k + 1, size)
        )
        text = f"select {keys}, {kept}, {cells} from ({text}) e{k}"
    last = size - 2
    return (
        f"select {keys}, case when a{last}_{last} > 1e-12 * d{last} then a{last}_{last + 1} / a{last}_{last} end"
        f" as estimate from ({text}) z"
    )


def _hex(text: str, start: int, length: int = 8) -> str:
    return f"cast('0x' || substr({text}, {start}, {length}) as bigint)"


def _bootstrap(
    prefix: str, source: str, outcome: str, *, by_arm: bool, seed: int, reps: int = 300,
    scheme: str = "fixed_n",
) -> None:
    """Replicates ``{prefix}_est`` and intervals ``{prefix}_ci`` from the same hashes as Spark."""
    pool = "treatment" if by_arm else "-1"
    rate = "greatest(0.0e0, 1.0e0 - 5.0e0 / sqrt(n))" if scheme == "fixed_n" else "1.0e0"
    _CTES[f"{prefix}_raw"] = (
        f"select *, study_id || '|' || unit_id as unit, {pool} as pool, weight as w, weight * ({outcome}) as wy"
        f" from {source}"
    )
    _CTES[f"{prefix}_cells"] = (
        f"select study_id, pool, n, most_w, most_wy, {rate} as rate from"
        " (select study_id, pool, count(*) as n, coalesce(nullif(max(abs(w)), 0), 1.0e0) as most_w,"
        f" coalesce(nullif(max(abs(wy)), 0), 1.0e0) as most_wy from {prefix}_raw group by study_id, pool) c"
    )
    # Terms in two bins of whole multiples of a power of two each, so that their sums are exact in any order.
    room = "ceil(log2(4.0e0 * n * 1.0000001e0))"
    units, parts = [], []
    for m in ("w", "wy"):
        top = f"(ceil(log2(most_{m} * 1.0000001e0)) + {room} + 1.0e0)"
        units.append(f"1.5e0 * pow(2.0e0, {top}) as coarse_{m}, 1.5e0 * pow(2.0e0, {top} - 52.0e0 + {room}) as fine_{m}")
        high = f"(({m} + coarse_{m}) - coarse_{m})"
        parts.append(f"{high} as {m}_high, ((({m} - {high}) + fine_{m}) - fine_{m}) as {m}_low")
    _CTES[f"{prefix}_units"] = f"select study_id, pool, {', '.join(units)} from {prefix}_cells"
    _CTES[f"{prefix}_rows"] = (
        f"select study_id, unit_id, treatment, pool, {', '.join(parts)},"
        f" {_hex('h', 1)} % {PRIME} as x1, {_hex('h', 9)} % {PRIME} as x2"
        f" from (select r.*, md5(unit) as h, u.* exclude (study_id, pool) from {prefix}_raw r"
        f" join {prefix}_units u on u.study_id = r.study_id and u.pool = r.pool) s"
    )
    _CTES[f"{prefix}_reps"] = (
        f"select rep, {_hex('h', 1)} % {PRIME} as a, {_hex('h', 9)} % {PRIME} as b, {_hex('h', 17)} % {PRIME} as c"
        f" from (select cast(rep as int) as rep, md5('{seed}|' || rep) as h from range({reps}) r(rep)) s"
    )
    factorial, terms = 1, []
    for k in range(13):
        factorial *= max(k, 1)
        terms.append(f"pow(rate, {k}) / {factorial}.0e0")
    _CTES[f"{prefix}_limits"] = "select *, " + ", ".join(
        f"cast(floor(exp(-rate) * ({' + '.join(terms[:k + 1])}) * {PRIME}.0e0) as bigint) as t{k}"
        for k in range(13)
    ) + f" from {prefix}_cells"
    count = " + ".join(f"(u >= t{k})::int" for k in range(13))
    _CTES[f"{prefix}_drawn"] = (
        "select study_id, pool, rep, treatment, sum(k) as drawn, "
        + ", ".join(f"sum(k * {b}) as {b}" for b in ("w_high", "w_low", "wy_high", "wy_low"))
        + f" from (select study_id, pool, rep, treatment, w_high, w_low, wy_high, wy_low, {count} as k from"
        f"  (select r.*, rep, (a * x1 + b * x2 + c) % {PRIME} as u from {prefix}_rows r, {prefix}_reps) v"
        f"  join {prefix}_limits using (study_id, pool)) k where k > 0 group by study_id, pool, rep, treatment"
    )
    total = f"select study_id, rep, treatment, w_high, w_low, wy_high, wy_low from {prefix}_drawn"
    if scheme == "fixed_n":
        total += (
            f" anti join (select study_id, pool, rep from {prefix}_short where drawn > n) o"
            " using (study_id, pool, rep)"
        )
        cubic = {
            h: f"((((({h}0 * draw + {h}1) % {PRIME}) * draw + {h}2) % {PRIME}) * draw + {h}3) % {PRIME}"
            for h in ("hx", "hy")
        }
        _CTES[f"{prefix}_short"] = (
            f"select c.study_id, c.pool, r.rep, n, d.drawn, case when d.drawn > n then n else n - coalesce(d.drawn, 0) end as short from {prefix}_cells c"
            f" cross join {prefix}_reps r left join (select study_id, pool, rep, cast(sum(drawn) as bigint) as drawn"
            f" from {prefix}_drawn group by study_id, pool, rep) d"
            " on d.study_id = c.study_id and d.pool = c.pool and d.rep = r.rep"
        )
        key = f"'{seed}|' || study_id || '|' || pool || '|' || rep"
        hashes = ", ".join(
            f"{_hex(h, 8 * i + 1)} % {PRIME} as {h}{i}" for h in ("hx", "hy") for i in range(4)
        )
        _CTES[f"{prefix}_draws"] = (
            f"select study_id, pool, rep, (({cubic['hx']}) * 2147483648 + ({cubic['hy']})) % n as idx from"
            f" (select *, unnest(range(1, short + 1)) as draw from (select *, {hashes} from"
            f" (select *, md5({key} || '|x') as hx, md5({key} || '|y') as hy from {prefix}_short where short > 0) a) b) d"
        )
        _CTES[f"{prefix}_index"] = (
            "select *, row_number() over (partition by study_id, pool order by unit_id) - 1 as idx"
            f" from {prefix}_rows"
        )
        total += (
            f" union all select study_id, rep, treatment, w_high, w_low, wy_high, wy_low from {prefix}_draws"
            f" join {prefix}_index using (study_id, pool, idx)"
        )
    def mean(arm: int) -> str:
        def total_of(m: str) -> str:
            return f"(sum({m}_high) filter (treatment = {arm}) + sum({m}_low) filter (treatment = {arm}))"
        return f"{total_of('wy')} / {total_of('w')}"

    _CTES[f"{prefix}_est"] = (
        f"select * from (select study_id, rep, {mean(1)} - {mean(0)} as estimate"
        f" from ({total}) t group by study_id, rep) e where estimate is not null"
    )
    _CTES[f"{prefix}_ci"] = (
        "select study_id, count(*) as n_reps, stddev_pop(estimate) as std_error,"
        " quantile_cont(estimate, 0.025) as ci_low, quantile_cont(estimate, 0.975) as ci_high"
        f" from {prefix}_est group by study_id"
    )


def _resampled(prefix: str, source: str, scheme: str) -> None:
    """``{prefix}_resampled``: the rows of each replicate of ``{prefix}``, weights times how often they are drawn."""
    count = " + ".join(f"(u >= t{k})::int" for k in range(13))
    counts = (
        f"select study_id, unit_id, rep, {count} as k from (select r.*, rep, (a * x1 + b * x2 + c) % {PRIME} as u"
        f" from {prefix}_rows r, {prefix}_reps) v join {prefix}_limits using (study_id, pool)"
    )
    if scheme == "fixed_n":
        counts = (
            f"select study_id, unit_id, c.rep, k from ({counts}) c anti join (select study_id, rep from {prefix}_short"
            f" where drawn > n) o using (study_id, rep) union all select study_id, unit_id, rep, 1 from {prefix}_draws"
            f" join {prefix}_index using (study_id, pool, idx)"
        )
    _CTES[f"{prefix}_resampled"] = (
        f"select s.* replace (s.weight * k as weight), rep from {source} s join ({counts}) c"
        " on c.study_id = s.study_id and c.unit_id = s.unit_id where k > 0"
    )


def _interval(prefix: str, source: str, covariates: tuple[str, ...]) -> str:
    """Adjusted effects with intervals, every replicate fitted from its own rows."""
    fitted = _regression(f"{prefix}_resampled", covariates, "study_id, rep")
    return (
        "select study_id, round(p.estimate, 4) as estimate, coalesce(n_reps, 0) as n_reps,"
        " round(coalesce(std_error, 0), 4) as std_error, round(coalesce(ci_low, p.estimate), 4) as ci_low,"
        f" round(coalesce(ci_high, p.estimate), 4) as ci_high from ({_regression(source, covariates, 'study_id')}) p"
        " left join (select study_id, count(*) as n_reps, stddev_pop(estimate) as std_error,"
        " quantile_cont(estimate, 0.025) as ci_low, quantile_cont(estimate, 0.975) as ci_high"
        f" from ({fitted}) f where estimate is not null group by study_id) c using (study_id)"
    )


_DID = "post_outcome - pre_outcome"
_bootstrap("ig", "g_exact", "post_outcome", by_arm=True, seed=5, scheme="poisson")
_resampled("ig", "g_exact", "poisson")
_bootstrap("im", "g_stratified", "post_outcome", by_arm=False, seed=9)
_resampled("im", "g_stratified", "fixed_n")
_CTES["x_outcomes"] = f"""
select g.*, case model_method when 'did' then {_DID} when 'lme_mixed' then {_DID}
            when 'lme_growth' then slope else post_outcome end as y
from x_configured g join x_methods using (study_id)"""
_bootstrap("ba", "g_stratified", _DID, by_arm=True, seed=7)
_bootstrap("br", "g_exact", "post_outcome", by_arm=False, seed=0)
_CTES["x_slopes"] = "select * replace (floor(slope * 1e9 + 0.5e0) / 1e9 as slope) from p_knn"
_bootstrap("bp", "x_slopes", "slope", by_arm=False, seed=0)
_bootstrap("bo", "g_exact", "post_outcome", by_arm=True, seed=11, scheme="poisson")
_bootstrap("be", "x_outcomes", "y", by_arm=False, seed=0)
_CTES["x_after_outcomes"] = "select * from x_outcomes where study_id like 'SEG%'"
_bootstrap("bf", "x_after_outcomes", "y", by_arm=True, seed=7)
_bootstrap("s1", "x_none", "post_outcome", by_arm=True, seed=3, reps=300, scheme="poisson")
_bootstrap("s2", "x_none", _DID, by_arm=True, seed=3, reps=300, scheme="poisson")
_CTES["x_pe_att"] = "select * from q_exact where study_id = 'PE_ATT'"
_bootstrap("bq", "x_pe_att", "post_outcome", by_arm=False, seed=0)

_CTES["x_naive"] = """
select study_id, avg(post_outcome) filter (treatment = 1) - avg(post_outcome) filter (treatment = 0) as naive_estimate
from x_cohorts group by study_id"""
_CTES["x_naive_panel"] = """
select study_id, avg(outcome) filter (treatment = 1) - avg(outcome) filter (treatment = 0) as naive_estimate
from x_panel where period >= 1 group by study_id"""


def _arms(source: str) -> str:
    return (
        "select study_id, count(*) filter (treatment = 1) as n_treated,"
        f" count(*) filter (treatment = 0) as n_control from {source} group by study_id"
    )


def _simple(day: int, model: str, outcome: str, boot: str) -> str:
    return f"""
select p.study_id, '2026-01-0{day}T00:00:00+00:00' as run_ts, 'none' as matching_method, '{model}' as model_method,
       n_treated, n_control, round(estimate, 3) as estimate, round(std_error, 3) as std_error,
       round(ci_low, 3) as ci_low, round(ci_high, 3) as ci_high, round(naive_estimate, 3) as naive_estimate,
       ci_low > 0 or ci_high < 0 as significant, 'after' as source
from ({_contrast('x_none', outcome)}) p join {boot}_ci using (study_id)
join ({_arms('x_none')}) a using (study_id) join x_naive using (study_id)"""


_CTES["x_results"] = (
    _simple(1, "att", "post_outcome", "s1") + " union all " + _simple(2, "did", _DID, "s2")
)
_CTES["x_latest"] = """
select * from x_results qualify row_number() over (partition by study_id order by run_ts desc) = 1"""


def _stamp(source: str, columns: dict[str, str]) -> str:
    def split(x: str) -> str:
        high = f"floor({x} * 1048576e0)"
        return (
            f"case when isnan({x}) then 'nan' else concat('0:', cast({high} as bigint), '/',"
            f" cast(floor(({x} * 1048576e0 - {high}) * 1099511627776e0) as bigint)) end"
        )

    parts = ", ".join(
        f"case when {name} is null then '~' else {split(f'cast({name} as double)')} end"
        if kind == "d" else f"coalesce(cast({name} as varchar), '~')"
        for name, kind in columns.items()
    )
    return (
        "select count(*) as n_rows,"
        " cast((coalesce(sum(h), 0) * 31 + count(*)) % 2305843009213693951 as bigint) as stamp from"
        f" (select {_hex('md5(r)', 1, 15)} as h from (select concat_ws('|', {parts}) as r from {source}) a) b"
    )


_COHORT_KINDS = {
    "study_id": "s", "patient_id": "l", "treatment": "i", "age": "d", "risk_score": "d",
    "prior_cost": "d", "pre_outcome": "d", "post_outcome": "d",
}
_CTES["x_stamp_cohort"] = _stamp("x_cohorts", _COHORT_KINDS)
_CTES["x_stamp_panel"] = _stamp(
    "x_panel",
    {"study_id": "s", "patient_id": "l", "treatment": "i", "age": "d", "risk_score": "d",
     "prior_cost": "d", "period": "i", "outcome": "d"},
)
_CTES["x_stamp_config"] = _stamp(
    "x_modular",
    {"study_id": "s", "study_name": "s", "vendor": "s", "model_family": "s", "feature_nb": "s",
     "matching_nb": "s", "matching_method": "s", "model_nb": "s", "min_quality_score": "d",
     "active": "b", "baseline_months": "l", "performance_months": "l"},
)


def _evaluation(boot: str, outcomes: str, source: str, extra: str) -> str:
    return f"""
select p.study_id, '{RUN_TS}' as run_ts, m.matching_method, m.model_method, a.n_treated, a.n_control,
       round(p.estimate, 3) as estimate, round(std_error, 3) as std_error, round(ci_low, 3) as ci_low,
       round(ci_high, 3) as ci_high,
       round(case when m.model_method = 'lme_growth' then p.estimate else naive_estimate end, 3) as naive_estimate,
       ci_low > 0 or ci_high < 0 as significant, '{source}' as source{extra}
from ({_contrast(outcomes, 'y')}) p join {boot}_ci using (study_id)
join ({_arms(outcomes)}) a using (study_id) join x_methods m using (study_id)
join x_modular_status s on s.study_id = p.study_id and s.quality_passed and s.active
left join (select * from x_naive union all select * from x_naive_panel) n on n.study_id = p.study_id"""


# --- paired tests --------------------------------------------------------------------------

_CTES["x_diffs"] = """
select study_id, patient_id, post_outcome - pre_outcome as d from x_pe where treatment = 1"""
_CTES["x_skew"] = """
select study_id, count(*) as n_treated, avg(pow((d - mu) / (sd + 1e-9), 3)) as skew
from x_diffs join (select study_id, avg(d) as mu, stddev_pop(d) as sd from x_diffs group by study_id) m
using (study_id) group by study_id"""
_CTES["x_routes"] = """
select study_id, n_treated, skew, abs(skew) > 1 as routed,
       case when abs(skew) > 1 then coalesce(nullif(fallback_model, ''), 'None')
            else 'model_' || model_type end as model_phase
from x_skew join x_pe_config using (study_id)
where study_id in (select study_id from x_pe_status where quality_passed) and model_type = 'wilcoxon'"""
_N = (
    "3.52624965998911e-2 0.700383064443688 6.37396220353165 33.912866078383 112.079291497871"
    " 221.213596169931 220.206867912376"
).split()
_D = (
    "8.83883476483184e-2 1.75566716318264 16.064177579207 86.7807322029461 296.564248779674"
    " 637.333633378831 793.826512519948 440.413735824752"
).split()


def _poly(values: list[str]) -> str:
    top = len(values) - 1
    return " + ".join(f"cast({v} as double) * pow(a, {top - i})" for i, v in enumerate(values))


def _p_value(source: str) -> str:
    """``source`` with ``p_value`` from its column z."""
    return f"""
select * exclude (a), 2.0e0 * exp(-0.5e0 * a * a) * case when a < 7.07106781186547e0
  then ({_poly(_N)}) / ({_poly(_D)})
  else 1.0e0 / (a + 1.0e0 / (a + 2.0e0 / (a + 3.0e0 / (a + 4.0e0 / (a + 0.65e0))))) / 2.506628274631e0 end as p_value
from (select *, abs(z) as a from ({source}) s) t"""


_CTES["x_exact_ways"] = """
with recursive ways as (
  select 0 as n, 0 as total, 1.0e0 as ways
  union all
  select n + 1 as n, t as total, sum(ways) as ways
  from (select n, total as t, ways from ways where n < 50
        union all select n, total + n + 1 as t, ways from ways where n < 50) s group by n, t)
select n, cast(total as double) as w_min,
       least(1.0e0, 2.0e0 * sum(ways) over (partition by n order by total) / pow(2.0e0, n)) as p_exact
from ways"""
_CTES["x_ranked"] = """
select study_id, d, (rank() over w + (count(*) over (partition by study_id, abs(d)) - 1) / 2.0e0) as r,
       count(*) over (partition by study_id, abs(d)) as c
from x_diffs where d <> 0 window w as (partition by study_id order by abs(d))"""
_CTES["x_rank_sums"] = """
select study_id, count(*) as n, sum(case when d > 0 then r else 0 end) as w_plus,
       sum(c * c - 1.0e0) as tie_term from x_ranked group by study_id"""
_CTES["x_signed_rank"] = f"""
select study_id, n_treated, n, w_plus,
       case when n_zero = 0 and tie_term = 0 and p_exact is not null then p_exact else p_value end as p_value
from ({_p_value('''
  select study_id, n_treated, n_zero, n, w_plus, tie_term,
         least(w_plus, n * (n + 1) / 2.0e0 - w_plus) as w_min,
         (w_plus - n * (n + 1) / 4.0e0) / sqrt((n * (n + 1.0e0) * (2 * n + 1) - tie_term / 2.0e0) / 24.0e0) as z
  from (select study_id, count(*) as n_treated, count(*) filter (d = 0) as n_zero from x_diffs group by study_id) t
  left join x_rank_sums using (study_id)''')}) u
left join x_exact_ways using (n, w_min)"""
_CTES["x_sign"] = _p_value("""
  select study_id, n_treated, n_pos, n_neg,
         (n_pos - (n_pos + n_neg) / 2.0e0) / nullif(sqrt((n_pos + n_neg) / 4.0e0), 0) as z
  from (select study_id, count(*) as n_treated, count(*) filter (d > 0) as n_pos,
               count(*) filter (d < 0) as n_neg from x_diffs group by study_id) t""")
_CTES["x_median"] = "select study_id, quantile_cont(d, 0.5) as estimate from x_diffs group by study_id"
_CTES["x_tests"] = """
select r.study_id, case when routed then 'sign_test' else 'wilcoxon' end as model_method, estimate,
       case when routed then s.p_value else w.p_value end as p_value, r.n_treated
from x_routes r join x_median using (study_id) join x_sign s on s.study_id = r.study_id
join x_signed_rank w on w.study_id = r.study_id where not routed or model_phase = 'model_sign_test'"""
_CTES["x_pe_effect"] = f"""
select study_id, estimate, std_error, ci_low, ci_high, n_treated, n_control
from ({_contrast('x_pe_att', 'post_outcome')}) p join bq_ci using (study_id)
join ({_arms('x_pe_att')}) a using (study_id)
where study_id in (select study_id from x_pe_status where quality_passed)"""


# The same rows under the phased studies of the other models.
_CTES["x_phase_config"] = fx.PHASE_CONFIG_SQL
_CTES["x_pf"] = (
    "select * replace (case study_id when 'PE_ATT' then 'PF_DID' when 'PE_RANK' then 'PF_SIGN' else 'PF_FALL' end"
    " as study_id) from x_pe"
)
_CTES["x_pf_diffs"] = "select study_id, patient_id, post_outcome - pre_outcome as d from x_pf where treatment = 1"
for _name in ("x_sign", "x_median", "x_skew"):
    _CTES[f"{_name}_pf"] = _CTES[_name].replace("x_diffs", "x_pf_diffs")
_CTES["x_pf_global"] = _CTES["x_pe_global"].replace("x_pe ", "x_pf ")
_matchings("f", "x_pf_global")
_CTES["x_pf_did"] = (
    f"select {COHORT}, weight, unit_id from f_exact where study_id = 'PF_DID' union all"
    f" select {COHORT}, 1.0e0 as weight, concat('p:', patient_id) as unit_id from x_pf_global where study_id = 'PF_FALL'"
    " and study_id in (select study_id from x_skew_pf where abs(skew) > 1)"
)
_bootstrap("bd", "x_pf_did", _DID, by_arm=False, seed=0)

# --- one oracle per query ------------------------------------------------------------------

_oracle("config_scan", "select * from x_modular")
_oracle("config_lookup", "select study_id, feature_method, matching_method, model_method, min_quality_score"
        " from x_config where study_id in (select study_id from x_cohorts)")
_ROUNDED = ", ".join(
    ["study_id", "patient_id", "treatment"]
    + [f"round({c}, 4) as {c}" for c in ("age", "risk_score", "prior_cost", "pre_outcome", "post_outcome")]
)
_oracle("cohort_slice", f"select {_ROUNDED} from x_cohorts where study_id in"
        " (select study_id from x_config where matching_method = 'knn')")
_oracle("panel_slice", "select study_id, patient_id, treatment, round(age, 4) as age, round(risk_score, 4) as risk_score,"
        " round(prior_cost, 4) as prior_cost, period, round(outcome, 4) as outcome from x_panel"
        " where study_id = 'LME_MIXED' and period >= 1")
_oracle("sink_overwrite", "select study_id, count(*) as n, round(sum(case when study_id = 'SEG_BUILDING'"
        " then 2 * prior_cost else prior_cost end), 2) as total_cost from x_cohorts group by study_id")
_oracle("results_union", "select *, cast(null as bigint) as config_version, cast(null as bigint) as data_version,"
        " cast(null as varchar) as job_run_id from x_results where model_method = 'att' union all"
        " select * replace ('modular' as source), cast(1 as bigint), cast(2 as bigint), 'run-1'"
        " from x_results where model_method = 'did'")
_oracle("publish_runs", "select *, cast(null as bigint) as config_version, cast(null as bigint) as data_version,"
        " cast(null as varchar) as job_run_id, 'run-a' as run_id from x_results where model_method = 'att' union all"
        " select * replace ('modular' as source), cast(1 as bigint), cast(2 as bigint), 'run-1', 'run-b'"
        " from x_results where model_method = 'did'")
_oracle("record_run", "select study_id, 'headline' as part, study_name || ' (' || vendor || '): ' ||"
        f" upper(r.model_method) || ' on ' || r.matching_method || '-matched cohort estimates a ' ||"
        f" format('{{:,.0f}}', abs(estimate)) || case when estimate < 0 then ' reduction' else ' increase' end ||"
        " ' in the outcome (' || case when significant then '' else 'not ' end || 'statistically significant).'"
        " as text, cast(1 as bigint) as n from x_latest r join x_config using (study_id)"
        " union all select study_id, 'results', 'att,did', count(*) from x_results group by study_id")
_oracle("study_intermediate", f"select {_ROUNDED}, round(weight, 4) as weight, unit_id from g_exact where study_id in"
        " (select study_id from x_config where model_method = 'att' and matching_method = 'exact')")
_oracle("result_rows", "select study_id, cast(null as varchar) as run_ts, cast(null as varchar) as matching_method,"
        " cast(null as varchar) as model_method, cast(null as bigint) as n_treated, cast(null as bigint) as n_control,"
        " round(naive_estimate, 3) as estimate, cast(null as double) as std_error, cast(null as double) as ci_low,"
        " cast(null as double) as ci_high, cast(null as double) as naive_estimate,"
        " cast(null as boolean) as significant, 'before' as source, cast(null as bigint) as config_version,"
        " cast(null as bigint) as data_version, cast(null as varchar) as job_run_id from x_naive")
_oracle("assign_ids", "select study_id, patient_id as source_id, row_number() over (order by study_id, patient_id)"
        " + (select max(patient_id) from x_cohorts) as patient_id from x_panel where period = 0")
_oracle("ids_by_name", "select study_id, patient_id as source_id, row_number() over (order by study_id desc, patient_id)"
        " + (select max(patient_id) from x_cohorts) as patient_id from x_panel where period = 0")
_oracle("config_defaults", "select study_id, 'standard' as model_family, true as active,"
        " cast(3 as bigint) as performance_months from x_config")
_oracle("data_stamp", "select * from x_stamp_cohort")
# A table read back has its partition column last.
_STORED_KINDS = {name: kind for name, kind in _COHORT_KINDS.items() if name != "study_id"} | {"study_id": "s"}
_CTES["x_changed_cohort"] = """
select * replace (case when study_id = 'SEG_BUILDING' then prior_cost * 2 else prior_cost end as prior_cost) from x_cohorts"""
_oracle("stamp_manifest", "select 1 as step, n_rows, stamp, (select count(distinct study_id) from x_cohorts) as n_reread"
        f" from ({_stamp('x_cohorts', _STORED_KINDS)}) a union all select 2, n_rows, stamp, 1 from"
        f" ({_stamp('x_changed_cohort', _STORED_KINDS)}) b union all select 3, n_rows, stamp, 0 from"
        f" ({_stamp('x_changed_cohort', _STORED_KINDS)}) c")
_oracle("select_active", "select study_id, active from x_modular where active")
_oracle("select_subset", "select study_id, active from x_modular where study_id in ('SEG_ARCHIVED', 'SEG_BUILDING')")
_oracle("family_split", "select family as model_family, count(*) as n_studies,"
        " string_agg(study_id, ',' order by study_id) as studies from x_families group by family")
_oracle("family_flags", "select bool_or(family = 'standard') as has_standard, bool_or(family = 'lme_mixed')"
        " as has_lme_mixed, bool_or(family = 'lme_growth') as has_lme_growth from x_families where active")
_oracle("study_methods", "select study_id, feature_method, matching_method, model_method from x_methods")
_oracle("gate_pass", "select study_id, count(*) as n, round(sum(post_outcome), 2) as total from x_cohorts where study_id"
        " in (select study_id from x_modular_status where quality_passed) group by study_id")
_oracle("gate_fail", "select study_id, n_total, n_treated, n_control, quality_score, min_quality_score"
        " from x_modular_status where not quality_passed")
_oracle("route_before", "select study_id, matching_method as chosen_matching, model_method as chosen_model, quality_passed,"
        " case when quality_passed and matching_method in ('exact', 'knn') and model_method in ('att', 'did')"
        " then 'model_' || matching_method || '_' || model_method end as branch from x_status")
_NEXT = ("case when not quality_passed then 'None' when needs_matching then 'matching'"
         " else 'model_' || model_type end")
_oracle("next_phase", f"select study_id, quality_passed, {_NEXT} as nextphase from x_pe_status")
_oracle("fallback_route", "select study_id, n_treated, round(skew, 4) as skew, routed, model_phase from x_routes")
_oracle("phase_trace", "select s.study_id, 'feature_engineering' || case when not quality_passed then ''"
        " when needs_matching then ' -> matching -> model_' || model_type"
        " else ' -> model_' || model_type || case when routed and model_phase <> 'None'"
        " then ' -> ' || model_phase else '' end end as trace"
        " from x_pe_status s left join x_routes r on r.study_id = s.study_id")
_oracle("phase_chain", fx.PHASES_WALK_SQL)
_oracle("missing_fraction", "select study_id, round(missing_fraction, 4) as missing_fraction from x_scores")
_oracle("arm_counts", "select study_id, n_total, n_treated, n_control from x_scores")
_oracle("quality_score", "select study_id, n_total, n_treated, n_control, round(missing_fraction, 4)"
        " as missing_fraction, quality_score from x_scores")
_oracle("impute_global", "select study_id, patient_id, round(risk_score, 4) as risk_score from x_global")
_oracle("impute_arm", "select study_id, patient_id, round(risk_score, 4) as risk_score from x_arm")
_oracle("period_split", "select study_id, patient_id, period, case when period = 0 then 'baseline' else 'performance' end"
        " as phase from x_window where period <= performance_months")
_oracle("performance_mean", "select study_id, patient_id, round(post_outcome, 6) as post_outcome from x_perf")
_oracle("panel_features", f"select {_ROUNDED.replace(', 4)', ', 6)')} from x_panel_feat")
_oracle("panel_periods", "select study_id, patient_id, treatment, period, round(outcome, 4) as outcome from x_window"
        " where period between 1 and performance_months")
_oracle("panel_impute", "select study_id, patient_id, period, round(coalesce(risk_score, m), 4) as risk_score"
        " from x_window join x_base_median using (study_id) where period between 1 and performance_months")
_oracle("coarsen", "select study_id, patient_id, cast(age_b as int) as age_b, cast(risk_b as int) as risk_b from c_bins")
_oracle("common_strata", "select study_id, cast(age_b as int) as age_b, cast(risk_b as int) as risk_b, n_treated,"
        " n_control, age_b || '_' || risk_b as stratum from c_strata")
_oracle("standardize", "select study_id, patient_id, round(z1, 4) as z_age, round(z2, 4) as z_risk_score,"
        " round(z3, 4) as z_prior_cost from g_z")
_oracle("propensity", "select study_id, patient_id, treatment, round(ps, 6) as ps from g_ps")
_MATCHED = ("study_id, patient_id, treatment, round(post_outcome, 4) as post_outcome, round(weight, 4) as weight,"
            " unit_id")
for _method in ("exact", "stratified", "knn", "ipw"):
    _oracle(f"match_{_method}", f"select {_MATCHED} from g_{_method}")
_oracle("unscored_rows", "select study_id, treatment, count(*) as n, count(*) filter (risk_score is null) as n_unscored"
        " from x_pe group by study_id, treatment")
_oracle("ipw_raw", "select study_id, patient_id, round(weight, 4) as weight from g_raw")
_oracle("match_none", "select study_id, patient_id, treatment, round(post_outcome, 4) as post_outcome,"
        " 1.0e0 as weight, concat('p:', patient_id) as unit_id from x_pe_global")
_oracle("matched_counts", _arms("q_exact"))
_oracle("dispatch_matching", "select study_id, treatment, count(*) as n, round(sum(weight), 4) as total_weight"
        " from x_configured where study_id like 'SEG%' group by study_id, treatment")
_CTES["x_seg_none"] = (
    f"select s.*, 1.0e0 as weight, matching_method as m, model_method from x_seg s join x_config using (study_id)"
)
_oracle("dispatch_model",
        "select study_id, case m when 'exact' then 'gee' when 'ipw' then 'mixed' else model_method end as model_method,"
        " round(estimate, 4) as estimate from (select study_id, m, model_method from x_seg_none group by all) k join ("
        + _regression("(select * from x_seg_none where m = 'exact') s1", COVARIATES, "study_id") + " union all "
        + _regression("(select * from x_seg_none where m = 'ipw') s2", ("pre_outcome", *COVARIATES), "study_id")
        + " union all "
        + _contrast(f"(select *, case when model_method = 'did' then {_DID} else post_outcome end as y"
                    " from x_seg_none where m not in ('exact', 'ipw')) s3", "y")
        + ") e using (study_id)")
_oracle("plugin_contract", "select study_id, treatment, count(*) as n, round(sum(weight), 4) as total_weight"
        " from g_stratified group by study_id, treatment")
_oracle("weighted_means", "select study_id, treatment, round(sum(weight * post_outcome) / sum(weight), 4)"
        " as weighted_mean from g_stratified group by study_id, treatment")
_GRID_KEYS = "study_id, matching_method"
for _model, _outcome in (("att", "post_outcome"), ("ate", "post_outcome"), ("did", _DID)):
    _oracle(f"effect_{_model}", f"select {_GRID_KEYS}, round(estimate, 4) as estimate from"
            f" ({_contrast('g_grid', _outcome, _GRID_KEYS)}) e")
for _model, _covs in (("gee", COVARIATES), ("mixed", ("pre_outcome", *COVARIATES))):
    _oracle(f"effect_{_model}", f"select {_GRID_KEYS}, round(estimate, 4) as estimate from"
            f" ({_regression('g_grid', _covs, _GRID_KEYS)}) e")
for _family, _outcome in (("mixed", _DID), ("growth", "slope")):
    _oracle(f"effect_lme_{_family}", "select study_id, round(estimate, 4) as estimate from"
            f" ({_contrast('p_knn', _outcome)}) e where study_id = 'LME_{_family.upper()}'")
_oracle("patient_slopes", "select study_id, patient_id, round(slope, 6) as slope from x_panel_feat")
_oracle("naive_effect", "select study_id, round(naive_estimate, 4) as naive_estimate from x_naive")
_oracle("naive_panel", "select study_id, round(naive_estimate, 4) as naive_estimate from x_naive_panel")
for _key, _prefix in (("by_arm", "ba"), ("rows", "br"), ("panel", "bp"), ("poisson", "bo")):
    _oracle(f"bootstrap_{_key}", f"select study_id, rep, floor(estimate * 1e6 + 0.5e0) / 1e6 as estimate from {_prefix}_est")
_oracle("bootstrap_ci", "select study_id, round(estimate, 4) as estimate, n_reps, round(std_error, 4) as std_error,"
        f" round(ci_low, 4) as ci_low, round(ci_high, 4) as ci_high from ({_contrast('g_stratified', _DID)}) p"
        " join ba_ci using (study_id)")
_oracle("interval_gee", _interval("ig", "g_exact", COVARIATES))
_oracle("interval_mixed", _interval("im", "g_stratified", ("pre_outcome", *COVARIATES)))
_oracle("skew_check", "select study_id, n_treated, round(skew, 4) as skew from x_skew")
_oracle("wilcoxon", "select study_id, n_treated, n, round(w_plus, 6) as w_plus, round(p_value, 6) as p_value from x_signed_rank")
_oracle("sign_test", "select study_id, n_treated, n_pos, n_neg, round(p_value, 6) as p_value from x_sign")
_oracle("median_diff", "select study_id, round(estimate, 4) as estimate from x_median")
_oracle("rank_or_sign", "select study_id, model_method, round(estimate, 5) as estimate, round(p_value, 5) as p_value,"
        " n_treated from x_tests")
_oracle("evaluate_all", _evaluation(
    "be", "x_outcomes", "modular",
    ", (select stamp from x_stamp_config) as config_version, case when m.family = 'standard'"
    " then (select stamp from x_stamp_cohort) else (select stamp from x_stamp_panel) end as data_version,"
    " 'run-1' as job_run_id"))
_oracle("evaluate_after", _evaluation("bf", "x_after_outcomes", "after", ""))
_CTES["x_before"] = f"""
select {COHORT}, weight, y from x_outcomes where study_id in (select study_id from x_status
  where quality_passed and matching_method in ('exact', 'knn') and model_method in ('att', 'did'))"""
_oracle("evaluate_before", f"select p.study_id, '{RUN_TS}' as run_ts, c.matching_method, c.model_method, n_treated,"
        " n_control, round(estimate, 3) as estimate, cast(null as double) as std_error, cast(null as double) as ci_low,"
        " cast(null as double) as ci_high, cast(null as double) as naive_estimate, cast(null as boolean) as significant,"
        f" 'before' as source from ({_contrast('x_before', 'y')}) p join ({_arms('x_before')}) a using (study_id)"
        " join x_config c using (study_id)")
_oracle("evaluate_phases", "select 'run-1' as run_id, study_id, 'att' as model_method, 'exact' as matching_method,"
        " round(estimate, 3) as estimate, round(std_error, 3) as std_error, round(ci_low, 3) as ci_low,"
        " round(ci_high, 3) as ci_high, cast(null as double) as p_value, cast(n_treated as int) as n_treated,"
        f" cast(n_control as int) as n_control, 'dev' as pe_environment, '{RUN_TS}' as ts from x_pe_effect union all"
        " select 'run-1', study_id, model_method, 'none', round(estimate, 3), null, null, null, round(p_value, 5),"
        f" cast(n_treated as int), null, 'dev', '{RUN_TS}' from x_tests")
_oracle("evaluate_phase_models", "select 'run-1' as run_id, study_id, 'did' as model_method,"
        " case study_id when 'PF_DID' then 'exact' else 'none' end as matching_method,"
        " round(estimate, 3) as estimate, round(std_error, 3) as std_error, round(ci_low, 3) as ci_low,"
        " round(ci_high, 3) as ci_high, cast(null as double) as p_value, cast(n_treated as int) as n_treated,"
        f" cast(n_control as int) as n_control, 'dev' as pe_environment, '{RUN_TS}' as ts,"
        " case study_id when 'PF_DID' then 'feature_engineering -> matching -> model_did'"
        " else 'feature_engineering -> model_wilcoxon -> model_did' end as trace"
        f" from ({_contrast('x_pf_did', _DID)}) p join bd_ci using (study_id) join ({_arms('x_pf_did')}) a using (study_id)"
        " union all select 'run-1', study_id, 'sign_test', 'none', round(estimate, 3), null, null, null, round(p_value, 5),"
        f" cast(n_treated as int), null, 'dev', '{RUN_TS}', 'feature_engineering -> model_sign_test'"
        " from x_sign_pf join x_median_pf using (study_id) where study_id = 'PF_SIGN'")
_STEP = ("'run-1' as run_id, study_id, {id} as step_id, {name} as step_name, {status} as status, {text} as pass_description,"
         " {error} as error_msg, cast({n_input} as int) as n_input, cast(n_treated as int) as n_treated,"
         " cast({n_columns} as int) as n_columns, true as timed, 'dev' as pe_environment,"
         f" '{RUN_TS}' as ts")


def _step(source: str, **parts: str) -> str:
    parts = {"error": "cast(null as varchar)", "n_input": "null", "n_columns": "null", **parts}
    return f"select {_STEP.format(**parts)} from {source}"


def _fmt(value: str, digits: int) -> str:
    return f"format('{{:,.{digits}f}}', {value})"


_oracle("step_log", " union all ".join([
    _step("x_pe_status", id="'1'", name="'Feature Engineering & Data Standardization'",
          status="case when quality_passed then 'PASS' else 'FAIL' end",
          text=f"'quality=' || quality_score || ' threshold=' || min_quality_score || '; nextphase=' || {_NEXT}",
          error="case when not quality_passed then 'quality ' || quality_score || ' below ' || min_quality_score end",
          n_input="n_total", n_columns="8"),
    _step("(select a.*, n_total from (" + _arms("x_pe_att") + ") a join x_pe_status s on s.study_id = a.study_id"
          " and quality_passed) m",
          id="'2'", name="'Matching'", status="'PASS'",
          text="'method=exact; matched ' || n_treated || ' treated / ' || n_control || ' control'", n_input="n_total"),
    _step("x_pe_effect", id="'3'", name="'Modeling (att)'", status="'PASS'",
          text=f"'ATT estimate=' || {_fmt('estimate', 2)} || ' CI[' || {_fmt('ci_low', 1)} || ',' || {_fmt('ci_high', 1)} || ']'"),
    _step("x_routes where routed", id="'3'", name="'Modeling (wilcoxon)'", status="'ROUTED'",
          text=f"'symmetry assumption violated (skew=' || {_fmt('skew', 2)} || '); routing to ' || model_phase"),
    _step("x_tests", id="case model_method when 'wilcoxon' then '3' else '3b' end",
          name="case model_method when 'wilcoxon' then 'Modeling (wilcoxon)' else 'Modeling (sign_test, fallback)' end",
          status="'PASS'",
          text=f"'median diff=' || {_fmt('estimate', 1)} || ' p=' || {_fmt('p_value', 5)} ||"
               " case model_method when 'wilcoxon' then '' else ' (fallback from wilcoxon)' end"),
]))
_oracle("observed_steps", "select 'features' as step, count(*) as n_rows, count(*) filter (treatment = 1) as n_treated"
        " from x_pe where study_id in (select study_id from x_pe_status where quality_passed) union all"
        " select 'matching', count(*), count(*) filter (treatment = 1) from x_pe_att")
_oracle("latest_result", "select * from x_latest")
_oracle("headline", f"select study_id, '{RUN_TS}' as run_ts, study_name || ' (' || vendor || '): ' ||"
        f" upper(r.model_method) || ' on ' || r.matching_method || '-matched cohort estimates a ' ||"
        f" {_fmt('abs(estimate)', 0)} || case when estimate < 0 then ' reduction' else ' increase' end ||"
        " ' in the outcome (' || case when significant then '' else 'not ' end || 'statistically significant).'"
        " as headline from x_latest r join x_config using (study_id)")
_oracle("interpretation", f"select study_id, 'Estimate ' || {_fmt('estimate', 1)} || ' (95% CI [' || {_fmt('ci_low', 1)}"
        f" || ', ' || {_fmt('ci_high', 1)} || ']). Naive unadjusted comparison was ' || {_fmt('naive_estimate', 1)} ||"
        f" '; matching/weighting shifted the estimate by ' || {_fmt('estimate - naive_estimate', 1)} ||"
        " ', removing confounding bias. n=' || n_treated || ' treated / ' || n_control || ' control.' as interpretation"
        " from x_latest")
_oracle("interpretation_plain", _ORACLES["interpretation"].replace(", removing confounding bias. n=", ". n="))
_oracle("matching_shift", "select study_id, model_method, estimate, naive_estimate,"
        " round(estimate - naive_estimate, 3) as shift from x_results")
_oracle("cohort_summary", "select study_id, treatment, count(*) as n, round(avg(risk_score), 2) as avg_risk,"
        " round(avg(post_outcome - pre_outcome), 1) as avg_delta from x_cohorts group by study_id, treatment")
_oracle("panel_summary", "select study_id, treatment, period, count(*) as n, round(avg(outcome), 0) as avg_outcome"
        " from x_panel group by study_id, treatment, period")
_oracle("results_listing", "select source, study_id, model_method, estimate from x_results")
_oracle("study_count", "select count(distinct study_id) as n_studies, count(*) as n_rows from x_cohorts")
_oracle("approx_distinct", "select study_id, count(distinct patient_id) as n_exact, true as is_near from x_cohorts"
        " group by study_id union all select 'all', count(distinct patient_id), true from x_cohorts")
_oracle("metric_rows", "select study_id, unnest(['estimate', 'ci_low', 'ci_high']) as metric,"
        " unnest([estimate, ci_low, ci_high]) as value from x_results where model_method = 'did'")
