"""Registered scorecard and experiment-delta queries (section 2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewatch.operators import score as sc
from tablewatch.plans.common import query, t

KEYS = ["account_id"]


def _results(spark, d):
    """Check results per account derived from orders: one finding row per order."""
    o = t(spark, d, "orders")
    k, p, st = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
    return o.select(
        (F.col("o_custkey") % 100).alias("account_id"), p.alias("check_id"),
        F.when(p.isin("1-URGENT", "2-HIGH"), "reliability").otherwise("cost").alias("area"),
        F.when(p.isin("1-URGENT", "2-HIGH"), "high").when(p == "3-MEDIUM", "medium").otherwise("low").alias("severity"),
        F.when(k % 11 == 0, "manual").when(k % 13 == 0, "unassessed")
        .when(st == "F", "pass").when(st == "O", "fail").otherwise("partial").alias("outcome"))


RESULTS_SQL = """results as (select o_custkey % 100 as account_id, o_orderpriority as check_id,
  case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'reliability' else 'cost' end as area,
  case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'high' when o_orderpriority = '3-MEDIUM' then 'medium'
       else 'low' end as severity,
  case when o_orderkey % 11 = 0 then 'manual' when o_orderkey % 13 = 0 then 'unassessed'
       when o_orderstatus = 'F' then 'pass' when o_orderstatus = 'O' then 'fail' else 'partial' end as outcome
  from orders)"""

COLLAPSED_SQL = RESULTS_SQL + """,
g as (select account_id, check_id, area, severity,
        max(case when outcome in ('pass','partial','fail') then case outcome when 'pass' then 0 when 'partial' then 1 else 2 end end) as worst,
        count_if(outcome in ('partial','fail')) as offenders,
        max(case when outcome = 'manual' then 1 else 0 end) as manual
      from results group by 1, 2, 3, 4),
c as (select account_id, check_id, area, severity,
        case when manual = 1 then 'manual' when worst is null then 'unassessed' when worst = 0 then 'pass'
             when worst = 1 then 'partial' else 'fail' end as outcome, offenders from g),
w as (select *, case when outcome in ('pass','partial','fail') then case severity when 'high' then 5 when 'medium' then 3 else 1 end else 0 end as wt,
        case when outcome in ('pass','partial','fail') then (case severity when 'high' then 5 when 'medium' then 3 else 1 end)
             * (case outcome when 'pass' then 2 when 'partial' then 1 else 0 end) else 0 end as h from c)"""


def _collapsed(spark, d):
    return sc.collapse_findings(_results(spark, d), KEYS)


@query("collapse_findings", f"with {COLLAPSED_SQL}\nselect account_id, check_id, area, severity, outcome, offenders from c")
def _collapse(spark, d):
    return _collapsed(spark, d)


HEALTH_SQL = f"""with {COLLAPSED_SQL}
select account_id, count_if(outcome in ('pass','partial','fail')) as assessed_checks,
  case when sum(wt) > 0 then cast(floor((100 * sum(h) + sum(wt)) / (2 * sum(wt))) as bigint) end as score
from w group by 1"""


@query("health_score", HEALTH_SQL)
def _health(spark, d):
    return sc.health_score(_collapsed(spark, d), KEYS)


@query("area_scores", f"""with {COLLAPSED_SQL}
select account_id, area, cast(floor((100 * sum(h) + sum(wt)) / (2 * sum(wt))) as bigint) as score
from w group by 1, 2 having sum(wt) > 0""")
def _area(spark, d):
    return sc.area_scores(_collapsed(spark, d), KEYS)


@query("coverage", f"""with {COLLAPSED_SQL}
select account_id, count_if(outcome <> 'manual') as assessable, count_if(outcome in ('pass','partial','fail')) as assessed,
  case when count_if(outcome <> 'manual') > 0 then cast(floor((count_if(outcome in ('pass','partial','fail')) * 200
       + count_if(outcome <> 'manual')) / (count_if(outcome <> 'manual') * 2)) as bigint) end as coverage_pct,
  coalesce(case when count_if(outcome <> 'manual') > 0 then floor((count_if(outcome in ('pass','partial','fail')) * 200
       + count_if(outcome <> 'manual')) / (count_if(outcome <> 'manual') * 2)) end < 60, true) as provisional
from c group by 1""")
def _coverage(spark, d):
    return sc.coverage(_collapsed(spark, d), KEYS)


@query("score_bands", f"""select *, case when score >= 90 then 'Excellent' when score >= 75 then 'Healthy'
  when score >= 60 then 'Needs attention' when score >= 40 then 'At risk' when score >= 0 then 'Critical' end as band
from ({HEALTH_SQL})""")
def _bands(spark, d):
    return sc.score_bands(sc.health_score(_collapsed(spark, d), KEYS))


def _assertions(spark, d):
    """Eval assertions derived from events: case = user, config by event parity, view events are manual."""
    e = t(spark, d, "events")
    return e.select(F.col("user_id").alias("case_id"),
                    F.when(F.col("event_id") % 2 == 0, "with_skill").otherwise("without_skill").alias("config"),
                    F.when(F.col("event_type") == "view", "manual").otherwise("coded").alias("kind"),
                    (F.col("value") > 100).alias("passed"), F.col("value"), F.col("ts"))


PASS_SQL = """select user_id as case_id, case when event_id % 2 = 0 then 'with_skill' else 'without_skill' end as config,
  count_if(event_type <> 'view') as coded, count_if(event_type <> 'view' and value > 100) as passed,
  cast(cast(count_if(event_type <> 'view' and value > 100) as decimal(18,6)) / nullif(count_if(event_type <> 'view'), 0)
       as decimal(18,4)) as pass_rate_d,
  cast(sum(cast(floor(value * 100) as bigint)) as bigint) as tokens
from events group by 1, 2"""


@query("pass_rate", f"select case_id, config, coded, passed, cast(pass_rate_d as double) as pass_rate from ({PASS_SQL})")
def _pass(spark, d):
    return sc.pass_rate(_assertions(spark, d), ["case_id", "config"])


def _per_case(spark, d):
    a = _assertions(spark, d)
    pr = sc.pass_rate(a, ["case_id", "config"])
    tok = a.groupBy("case_id", "config").agg(F.sum(F.floor(F.col("value") * 100).cast("bigint")).alias("tokens"))
    return pr.join(tok, ["case_id", "config"])


STATS_SQL = f"""select config, count(*) as n,
  cast(cast(avg(cast(pass_rate_d as double)) as decimal(18,4)) as double) as pass_rate_mean,
  cast(cast(case when count(*) > 1 then stddev_samp(cast(pass_rate_d as double)) end as decimal(18,4)) as double) as pass_rate_sd,
  cast(cast(avg(tokens) as decimal(18,4)) as double) as tokens_mean,
  cast(cast(case when count(*) > 1 then stddev_samp(tokens) end as decimal(18,4)) as double) as tokens_sd
from ({PASS_SQL}) group by 1"""


@query("config_stats", STATS_SQL)
def _stats(spark, d):
    return sc.config_stats(_per_case(spark, d), "config", ["pass_rate", "tokens"])


@query("config_delta", f"""
select cast(cast(max(case when config = 'with_skill' then pass_rate_mean end)
  - max(case when config = 'without_skill' then pass_rate_mean end) as decimal(18,4)) as double) as pass_rate_delta,
  cast(cast(max(case when config = 'with_skill' then tokens_mean end)
  - max(case when config = 'without_skill' then tokens_mean end) as decimal(18,4)) as double) as tokens_delta
from ({STATS_SQL})""")
def _delta(spark, d):
    stats = sc.config_stats(_per_case(spark, d), "config", ["pass_rate", "tokens"])
    return sc.config_delta(stats, "config", ["pass_rate", "tokens"], "with_skill", "without_skill")
