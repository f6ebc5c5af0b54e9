from decimal import Decimal

from pyspark.sql import functions as F

from tablewatch.operators import cost as c
from tablewatch.plans.common import t
from tablewatch.plans.cost import AS_OF, AUDITED, CFG
from tests.conftest import SMALL


def tables(spark):
    return {name: t(spark, SMALL, name) for name in AUDITED}


def test_usage_cube_keeps_every_finding(spark):
    """Checks over the cube equal checks over all usage rows."""
    x = tables(spark)
    pu = c.priced_usage(x["usage"], x["list_prices"], AS_OF, CFG)
    cube = c.usage_cube(pu)
    for check in (c.c01_all_purpose_jobs, c.c04_photon_review, c.c11_tag_hygiene):
        assert sorted(check(pu, AS_OF, CFG).collect(), key=str) == sorted(check(cube, AS_OF, CFG).collect(), key=str)


def test_usage_is_not_dealt_by_sku(spark):
    """The sums of usage of one SKU are made in many tasks, not where its price was looked up."""
    usage = spark.range(4000).selectExpr("timestamp_ntz '2001-06-01' as usage_date", "'1' as workspace_id", "'JOBS_COMPUTE' as sku_name",
                                         "cast(id % 7 as double) as usage_quantity", "cast(null as map<string,string>) as custom_tags",
                                         "struct(cast(id as string) as cluster_id, id as job_id, cast(null as string) as warehouse_id) as usage_metadata")
    prices = t(spark, SMALL, "list_prices")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        sums = c.usage_cube(c.with_cost(usage, prices))
        held = [r["count"] for r in sums.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(held) == 4000 and max(held) < 1000
        assert sums.agg(F.sum("cost_usd")).first()[0] == sum(i % 7 for i in range(4000)) * Decimal("0.15")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_needs_are_declared(spark):
    """A missing table or column skips what needs it, with the reason; the rest run."""
    x = tables(spark)
    assert all(reason is None for _, reason in c.planned_checks(x))
    x["clusters"] = x["clusters"].drop("worker_count")
    del x["query_history"]
    why = {check.check_id[:3]: reason for check, reason in c.planned_checks(x) if reason}
    assert why == {"C03": "no column worker_count in clusters", "C05": "no table query_history", "C06": "no table query_history",
                   "C07": "no table query_history"}


def test_audit_replaces_its_day(spark, tmp_path):
    """Run again, a day's findings are its own latest ones, even if there are none; other days stay."""
    x, path = tables(spark), str(tmp_path / "audit")
    days = c.audit_dates(AS_OF, [60, 0])
    checks = [k for k in c.CHECKS if k.check_id[:3] in ("C01", "C03", "C08")]
    first = c.run_audit(x, days, CFG, path, checks).collect()
    again = c.run_audit(x, days, CFG, path, checks).collect()
    assert sorted(first, key=str) == sorted(again, key=str) and len({r["run_date"] for r in first}) == 2
    x["clusters"], x["managed_tables"] = x["clusters"].limit(0), x["managed_tables"].limit(0)
    left = c.run_audit(x, days[1:], CFG, path, checks[1:]).collect()
    assert {str(r["run_date"]) for r in left} == {days[0][:10]}


def test_job_names(spark):
    x = tables(spark)
    pu = c.priced_usage(x["usage"], x["list_prices"], AS_OF, CFG)
    named = {r["resource_id"]: r["resource_name"] for r in c.c09_job_failures(pu, x["job_run_timeline"], AS_OF, CFG, x["job_names"]).collect()}
    bare = {r["resource_id"]: r["resource_name"] for r in c.c09_job_failures(pu, x["job_run_timeline"], AS_OF, CFG).collect()}
    assert set(named) == set(bare) and all(k == v for k, v in bare.items())
    assert any(v.endswith(" v2") for k, v in named.items() if int(k) % 3 == 0 and int(k)) and named != bare
