"""Split, evaluation and explanation queries on score and contribution tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from firnline import fixed_values as fv
from firnline.catalog.registry import query, r6, rounded, with_place
from firnline.catalog.tables import Tables
from firnline.operators import evaluate, explain, negatives, split

_DRAWN = "(select *, md5(cast(id as varchar) || '|42') as draw from v_labelled)"
_QUOTAS = """(
  select label, base + case when row_number() over (order by rest desc, label)
      <= wanted - sum(base) over () then 1 else 0 end as quota
  from (select label, wanted, floor(exact) as base, exact - floor(exact) as rest from (
    select label, ceil(sum(count(*)) over () * 0.2::double) as wanted,
      count(*) * ceil(sum(count(*)) over () * 0.2::double) / sum(count(*)) over () as exact
    from v_labelled group by label)))"""


@query("split_stratified", f"""
  select id, d.label, row_number() over (partition by d.label order by draw) <= quota as is_test
  from {_DRAWN} d join {_QUOTAS} q on q.label = d.label""")
def _(t: Tables):
    return split.stratified(t.labelled, "label", "id").select("id", "label", "is_test")


@query("split_random", f"""
  select id, row_number() over (order by draw)
    <= (select ceil(count(*) * 0.2::double) from v_labelled) as is_test from {_DRAWN}""")
def _(t: Tables):
    return split.plain(t.labelled, "id").select("id", "is_test")


@query("cv_folds", f"""
  select id, label, cast((row_number() over (partition by label order by draw) - 1) % 5 as int)
    as fold from {_DRAWN}""")
def _(t: Tables):
    return split.folds(t.labelled, "label", "id").select("id", "label", "fold")


@query("sample_n", f"select id, label from {_DRAWN} order by draw limit 100")
def _(t: Tables):
    return split.sample(t.labelled, "id", fv.EXPLAIN_SAMPLE).select("id", "label")


@query("sample_shuffle", """
  select "Observation ID", avalanche_occurred,
    cast(row_number() over (order by md5("Observation ID" || '|42')) as int) as place
  from v_training""")
def _(t: Tables):
    return with_place(negatives.shuffled(
        t.training.select("Observation ID", "avalanche_occurred"), "Observation ID"
    ))


_CELLS = """(select count_if(score < {0} and label = 0) as tn, count_if(score >= {0} and label = 0)
  as fp, count_if(score < {0} and label = 1) as fn, count_if(score >= {0} and label = 1) as tp
  from v_scores)"""
_AT_HALF = _CELLS.format("0.5::double")


@query("eval_confusion", f"""
  select cast(tn as bigint) as tn, cast(fp as bigint) as fp, cast(fn as bigint) as fn,
    cast(tp as bigint) as tp from {_AT_HALF}""")
def _(t: Tables):
    return evaluate.confusion(t.scores, 0.5)


_D = "cast({} as double)".format
_REPORT_BASE = f"""
  select {_D('tn')} / (tn + fn) as sp, {_D('tn')} / (tn + fp) as sr, tn + fp as sn,
    {_D('2 * tn')} / (2 * tn + fn + fp) as sf, {_D('tp')} / (tp + fp) as dp,
    {_D('tp')} / (tp + fn) as dr, {_D('2 * tp')} / (2 * tp + fp + fn) as df, tp + fn as dn,
    {_D('tn + tp')} / (tn + fp + fn + tp) as acc from {_AT_HALF}"""


def _report_row(name: str, p: str, r: str, f: str, n: str) -> str:
    return (f"select '{name}' as class, round({p}, 6) as precision, round({r}, 6) as recall, "
            f"round({f}, 6) as f1, cast({n} as bigint) as support from ({_REPORT_BASE})")


def _weighted(s: str, d: str) -> str:
    return f"({s} * sn + {d} * dn) / (sn + dn)"


@query("eval_report", " union all ".join([
    _report_row("No Avalanche", "sp", "sr", "sf", "sn"),
    _report_row("Avalanche", "dp", "dr", "df", "dn"),
    _report_row("accuracy", "null::double", "null::double", "acc", "sn + dn"),
    _report_row("macro avg", "(sp + dp) / 2", "(sr + dr) / 2", "(sf + df) / 2", "sn + dn"),
    _report_row("weighted avg", _weighted("sp", "dp"), _weighted("sr", "dr"),
                _weighted("sf", "df"), "sn + dn"),
]))
def _(t: Tables):
    return rounded(evaluate.report(t.scores, 0.5))


_CUMULATIVE = """(
  select score, sum(pos) over w as tp, sum(neg) over w as fp, sum(pos) over () as p,
    sum(neg) over () as n, pos, neg
  from (select score, count_if(label = 1) as pos, count_if(label = 0) as neg
    from v_scores group by score)
  window w as (order by score desc rows unbounded preceding))"""


@query("eval_roc_auc", f"""
  select round(sum(cast(pos as double) * (n - fp + cast(neg as double) / 2))
    / (cast(max(p) as double) * max(n)), 6) as auc from {_CUMULATIVE}""")
def _(t: Tables):
    return rounded(evaluate.roc_auc(t.scores))


@query("curve_roc", f"""
  select score as threshold, round({_D('fp')} / n, 6) as fpr, round({_D('tp')} / p, 6) as tpr
  from {_CUMULATIVE}""")
def _(t: Tables):
    return rounded(evaluate.roc_curve(t.scores))


@query("curve_precision_recall", f"""
  select score as threshold, round({_D('tp')} / (tp + fp), 6) as precision,
    round({_D('tp')} / p, 6) as recall from {_CUMULATIVE}
  union all select null, 1.0::double, 0.0::double""")
def _(t: Tables):
    return rounded(evaluate.precision_recall_curve(t.scores))


@query("eval_regression", """
  select round(sqrt(avg((y - f) * (y - f))), 6) as rmse, round(avg(abs(y - f)), 6) as mae,
    round(1 - sum((y - f) * (y - f)) / sum((y - m) * (y - m)), 6) as r2
  from (select l_extendedprice / 10000 as y, l_quantity / 10 as f from lineitem),
    (select avg(l_extendedprice / 10000) as m from lineitem)""")
def _(t: Tables):
    rows = t.read("lineitem").select(
        (F.col("l_extendedprice") / 10000.0).alias("label"),
        (F.col("l_quantity") / 10.0).alias("prediction"),
    )
    return rounded(evaluate.regression(rows))


def _sweep_sql(thresholds: list[float]) -> str:
    listed = ", ".join(f"({t!r}::double)" for t in thresholds)
    return f"""(
  select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall)
      else 0 end as f1
  from (select t as threshold, {_D('tp')} / p as recall,
      case when tp + fp > 0 then {_D('tp')} / (tp + fp) else 0 end as precision,
      p - tp as fn, {_D('p - tp')} / p as fn_rate
    from (select t, count_if(score >= t and label = 1) as tp, count_if(score >= t and label = 0)
        as fp, count_if(label = 1) as p
      from v_scores, (values {listed}) as v(t) group by t)))"""


_SWEPT = _sweep_sql(fv.SWEEP_THRESHOLDS)
_RATING = """case when fn_rate < 0.15 then '✓ Excellent (very safe)'
  when fn_rate < 0.25 then '✓ Good (safe)' when fn_rate < 0.35 then '⚠ Acceptable'
  else '✗ Too risky' end as rating"""
_SWEEP_COLUMNS = f"""threshold, round(recall, 6) as recall, round(precision, 6) as precision,
  round(f1, 6) as f1, cast(fn as bigint) as fn, round(fn_rate, 6) as fn_rate, {_RATING}"""


@query("eval_threshold_sweep", f"select {_SWEEP_COLUMNS} from {_SWEPT}")
def _(t: Tables):
    return rounded(evaluate.sweep(t.scores))


_CURVE = evaluate.evenly_spaced(*fv.CURVE_THRESHOLDS)


@query("eval_threshold_curve", f"""
  select round(threshold, 6) as threshold, round(recall, 6) as recall,
    round(precision, 6) as precision, round(f1, 6) as f1 from {_sweep_sql(_CURVE)}""")
def _(t: Tables):
    return rounded(evaluate.threshold_curve(t.scores))


_BEST = """order by fn_rate < 0.25 desc, case when fn_rate < 0.25 then f1 end desc nulls last,
  case when fn_rate >= 0.25 then fn_rate end nulls first, threshold limit 1"""


@query("pick_best_threshold", f"""
  select {_SWEEP_COLUMNS} from (select * from {_SWEPT} {_BEST})""")
def _(t: Tables):
    return rounded(evaluate.best_threshold(evaluate.sweep(t.scores)))


@query("sink_threshold", f"""
  select threshold as optimal_threshold,
    printf('Use threshold=%.2f for predictions', threshold) as recommendation
  from (select * from {_SWEPT} {_BEST})""")
def _(t: Tables):
    return evaluate.threshold_advice(evaluate.best_threshold(evaluate.sweep(t.scores)))


@query("eval_safety_metrics", f"""
  select round(miss_rate, 6) as miss_rate, round({_D('fp')} / (tn + fp), 6) as false_alarm_rate,
    case when miss_rate < 0.15 then '✓ EXCELLENT: Very safe model (missing <15% of avalanches)'
      when miss_rate < 0.25 then '✓ GOOD: Safe model (missing <25% of avalanches)'
      when miss_rate < 0.35 then '⚠ ACCEPTABLE: Could be safer (missing <35% of avalanches)'
      else '✗ NEEDS IMPROVEMENT: Too many missed avalanches (>35%)' end as rating
  from (select *, {_D('fn')} / (fn + tp) as miss_rate from {_AT_HALF})""")
def _(t: Tables):
    return rounded(evaluate.safety(t.scores, 0.5))


@query("eval_baselines", """
  select 'always safe' as baseline, 0.0::double as recall, 0.0::double as precision
  union all select 'always danger', 1.0::double,
    round(cast(count_if(label = 1) as double) / count(*), 6) from v_labelled
  union all select 'random', round(cast(count_if(guess and label = 1) as double)
      / count_if(label = 1), 6),
    round(cast(count_if(guess and label = 1) as double) / count_if(guess), 6)
  from (select label, cast(cast('0x' || substr(md5(cast(id as varchar) || '|42'), 1, 8) as bigint)
      as double) / 4294967296 < (select avg(label) from v_labelled) as guess from v_labelled)""")
def _(t: Tables):
    return rounded(evaluate.fixed_baselines(t.labelled).unionByName(
        evaluate.random_baseline(t.labelled, "id")
    ))


@query("rank_contributions", """
  select id, feature, round(shap_value, 6) as shap_value, cast(sign(shap_value) as int) as direction,
    row_number() over (partition by id, sign(shap_value) order by abs(shap_value) desc, feature)
      as rank,
    case when shap_value > 0 then '↑ INCREASES RISK' else '↓ DECREASES RISK' end as impact
  from v_contributions where shap_value <> 0
  qualify row_number() over (partition by id, sign(shap_value)
    order by abs(shap_value) desc, feature) <= 3""")
def _(t: Tables):
    return explain.with_impact(explain.ranked(t.contributions, "id")).select(
        "id", "feature", r6("shap_value").alias("shap_value"), "direction",
        F.col("rank").cast("long").alias("rank"), "impact",
    )


@query("explain_global", """
  select feature, round(avg(abs(shap_value)), 6) as mean_shap from v_contributions group by 1""")
def _(t: Tables):
    return rounded(explain.global_importance(t.contributions))


@query("explain_waterfall", """
  select id, feature, round(shap_value, 6) as shap_value, round(start, 6) as start,
    round("end", 6) as "end"
  from (select *, "end" - shap_value as start from (
    select *, 0.25::double + sum(shap_value) over (partition by id order by abs(shap_value), feature
      rows unbounded preceding) as "end" from v_contributions))""")
def _(t: Tables):
    return rounded(explain.waterfall(t.contributions, "id", F.lit(0.25)))


_LINE = """case when direction > 0 then '  🔺 ' else '  🔻 ' end
  || case feature when 'elevation' then 'Elevation' when 'slope' then 'Slope'
    when 'aspect_degrees' then 'Aspect Degrees' when 'snow_depth' then 'Snow Depth'
    when 'new_snow_24h' then 'New Snow 24H' when 'swe' then 'Swe' else 'Temp' end
  || ': ' || printf('%.1f', round_even(value, 1))
  || case when direction > 0 then
      case when feature = 'new_snow_24h' and value > 20 then ' (heavy recent snowfall - CRITICAL)'
        when feature = 'slope' and value > 35 then ' (steep slope - HIGH IMPACT)'
        when feature = 'temp' and value > 0 then ' (warming temps - unstable snow)'
        when feature = 'snow_depth' and value > 150 then ' (very deep snowpack)' else '' end
    else
      case when feature = 'new_snow_24h' and value < 5 then ' (minimal new snow)'
        when feature = 'temp' and value < -10 then ' (cold temps - stable snow)'
        when feature = 'slope' and value < 30 then ' (gentler slope)' else '' end end
  || ' [' || case when direction > 0 then '+' else '' end
  || printf('%.2f', round_even(shap_value, 2)) || ']' || chr(10)"""


EXPLAIN_TEXT_SQL = f"""
  select p.id, chr(10) || case when prediction >= 0.5 then '🔴 **AVALANCHE RISK: HIGH DANGER ('
      when prediction >= 0.4::double then '🟡 **AVALANCHE RISK: MODERATE ('
      else '🟢 **AVALANCHE RISK: LOW/SAFE (' end
    || printf('%.0f', round_even(prediction * 100, 0)) || '%)**' || chr(10)
    || '(Decision threshold: 0.50)' || chr(10)
    || coalesce(chr(10) || '**Factors INCREASING risk:**' || chr(10) || up, '')
    || coalesce(chr(10) || '**Factors DECREASING risk:**' || chr(10) || down, '')
    || chr(10) || '**Recommendation:**' || chr(10)
    || case when prediction >= 0.5 then
        '  ⚠️ DANGEROUS CONDITIONS. Avoid all avalanche terrain.' || chr(10) || '  Model is '
        || printf('%.0f', round_even((prediction / 0.5::double - 1) * 100, 0))
        || '% above safety threshold.'
      when prediction >= 0.4::double then
        '  ⚠️ CONSIDERABLE DANGER. Careful snowpack evaluation required.' || chr(10)
        || '  Conditions approaching unsafe levels.'
      else '  ✓ LOW DANGER. Normal caution advised.' || chr(10) || '  '
        || printf('%.0f', round_even((0.5::double - prediction) / 0.5::double * 100, 0))
        || '% below danger threshold.' end as text
  from v_predictions p left join (
    select id, string_agg(line, '' order by rank) filter (where direction > 0) as up,
      string_agg(line, '' order by rank) filter (where direction < 0) as down
    from (select id, direction, rank, {_LINE} as line from (
      select *, sign(shap_value) as direction, row_number() over (partition by id, sign(shap_value)
        order by abs(shap_value) desc, feature) as rank
      from v_contributions where shap_value <> 0)
      where rank <= 3)
    group by id) l on l.id = p.id"""


@query("explain_text", EXPLAIN_TEXT_SQL)
def _(t: Tables):
    return explain.texts(t.contributions, t.predictions, "id", 0.5)
