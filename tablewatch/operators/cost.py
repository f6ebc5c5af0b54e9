"""Cost and usage checks over billing, compute and query-history tables.

Every check returns the same 11 finding columns. Money is kept in decimals
(quantity x list price) so sums are exact and rounding is half-up in every
engine; savings are reported as doubles at the end. The price list is a
dimension of a few SKUs, reduced to one row per SKU and broadcast.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.functions.timeutil import as_of_text, date_lit, ts_lit

FINDING_COLUMNS = ["run_date", "check_id", "check_name", "severity", "resource_type", "resource_id",
                   "resource_name", "owner", "workspace_id", "detail", "est_monthly_saving_usd"]
KINDS = {"run_date": "date", "est_monthly_saving_usd": "double"}
FINDING_SCHEMA = ", ".join(f"{c} {KINDS.get(c, 'string')}" for c in FINDING_COLUMNS)


@dataclass
class CostConfig:
    # Default thresholds of the audit.
    lookback: int = 30
    min_cost: int = 50
    idle_cpu: int = 15
    max_autoterm: int = 60
    big_workers: int = 10
    repeat_runs: int = 20
    ap_to_jobs_saving: float = 0.40
    idle_saving: float = 0.50
    photon_saving: float = 0.15
    spot_saving: float = 0.40
    wh_idle_saving: float = 0.50
    big_bytes: int = 50 * 1024 ** 3
    unused_days: int = 90


MONEY = "decimal(18,6)"


def _since(col: str, as_of, days: int) -> Column:
    """Within the ``days`` before ``as_of``; nothing at or after it, so an audit of a past day sees
    what was known then."""
    return (F.col(col) >= F.date_sub(date_lit(as_of), days).cast("timestamp_ntz")) & (F.col(col) < ts_lit(as_of))


def _int_text(c: Column) -> Column:
    """Whole-number text of a decimal amount (half up)."""
    return F.round(c.cast(MONEY), 0).cast("bigint").cast("string")


def _saving(c: Column, share: float) -> Column:
    return F.round(c.cast(MONEY) * F.lit(share).cast("decimal(4,2)"), 2).cast("double")


def finding(as_of, check_id: str, check_name: str, severity: str, resource_type, resource_id, resource_name,
            owner, workspace_id, detail, saving) -> list[Column]:
    def lit(v):
        return v if isinstance(v, Column) else F.lit(v)
    return [date_lit(as_of).alias("run_date"), F.lit(check_id).alias("check_id"),
            F.lit(check_name).alias("check_name"), F.lit(severity).alias("severity"),
            lit(resource_type).cast("string").alias("resource_type"),
            lit(resource_id).cast("string").alias("resource_id"),
            lit(resource_name).cast("string").alias("resource_name"), lit(owner).cast("string").alias("owner"),
            lit(workspace_id).cast("string").alias("workspace_id"), lit(detail).cast("string").alias("detail"),
            lit(saving).cast("double").alias("est_monthly_saving_usd")]


def unit_prices(list_prices: DataFrame) -> DataFrame:
    return (list_prices.where((F.col("currency_code") == "USD") & F.col("price_end_time").isNull())
            .groupBy("sku_name").agg(F.max("pricing.default").alias("unit_price")))


def priced_usage(usage: DataFrame, list_prices: DataFrame, as_of, cfg: CostConfig) -> DataFrame:
    """Usage in the lookback window with ``cost_usd = quantity * list price`` (0 when unpriced)."""
    return with_cost(usage.where(_since("usage_date", as_of, cfg.lookback)), list_prices)


def with_cost(usage: DataFrame, list_prices: DataFrame) -> DataFrame:
    """``usage`` with ``cost_usd``. The prices, a row for each SKU, are broadcast: dealt by SKU, all usage would
    meet in a task for each, and stay there for sums by SKU and more."""
    return (usage.join(F.broadcast(unit_prices(list_prices)), "sku_name", "left")
            .withColumn("cost_usd", F.col("usage_quantity").cast("decimal(18,2)")
                        * F.coalesce(F.col("unit_price"), F.lit(0)).cast("decimal(18,4)"))
            .drop("unit_price"))


def c01_all_purpose_jobs(pu: DataFrame, as_of, cfg: CostConfig) -> DataFrame:
    g = (pu.where(F.col("sku_name").like("%ALL_PURPOSE%") & F.col("usage_metadata.job_id").isNotNull())
         .groupBy("workspace_id", F.col("usage_metadata.cluster_id").alias("cluster_id"))
         .agg(F.max("usage_metadata.job_id").alias("job_id"), F.sum("cost_usd").alias("cost"))
         .where(F.col("cost") > cfg.min_cost))
    detail = F.concat(F.lit("all-purpose DBUs on job_id "), F.col("job_id").cast("string"), F.lit(" cost $"),
                      _int_text(F.col("cost")), F.lit(f" over {cfg.lookback}d"))
    return g.select(*finding(as_of, "C01_all_purpose_for_jobs", "All-purpose compute running scheduled jobs",
                             "high", "cluster", F.col("cluster_id"), F.col("cluster_id"), F.lit(None),
                             F.col("workspace_id"), detail, _saving(F.col("cost"), cfg.ap_to_jobs_saving)))


def cluster_cost(pu: DataFrame) -> DataFrame:
    return (pu.where(F.col("usage_metadata.cluster_id").isNotNull())
            .groupBy(F.col("usage_metadata.cluster_id").alias("cluster_id"), "workspace_id")
            .agg(F.sum("cost_usd").alias("cost")))


def c02_idle_clusters(pu: DataFrame, node_timeline: DataFrame, as_of, cfg: CostConfig) -> DataFrame:
    util = (node_timeline.where(_since("start_time", as_of, cfg.lookback) & (F.col("driver") == F.lit(False)))
            .groupBy("cluster_id")
            .agg(F.avg(F.col("cpu_user_percent") + F.col("cpu_system_percent")).alias("avg_cpu"),
                 F.avg("mem_used_percent").alias("avg_mem")))
    j = cluster_cost(pu).join(util, "cluster_id", "inner").where(
        (F.col("avg_cpu") < cfg.idle_cpu) & (F.col("cost") > cfg.min_cost))
    one = (lambda c: F.col(c).cast("decimal(18,1)").cast("string"))
    detail = F.concat(F.lit("avg CPU "), one("avg_cpu"), F.lit("%, avg mem "), one("avg_mem"),
                      F.lit(f"%, {cfg.lookback}d cost $"), _int_text(F.col("cost")))
    return j.select(*finding(as_of, "C02_idle_clusters", "Under-utilised clusters (low CPU)", "high", "cluster",
                             F.col("cluster_id"), F.col("cluster_id"), F.lit(None), F.col("workspace_id"), detail,
                             _saving(F.col("cost"), cfg.idle_saving)))


def latest_clusters(clusters: DataFrame) -> DataFrame:
    """Newest live version per cluster (``row_number() = 1``; Spark plans a per-key group limit)."""
    w = Window.partitionBy("cluster_id").orderBy(F.col("change_time").desc())
    return (clusters.where(F.col("delete_time").isNull()).withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") == 1).drop("rn"))


def c03_cluster_config(clusters: DataFrame, as_of, cfg: CostConfig) -> DataFrame:
    lt = latest_clusters(clusters).where(
        F.col("cluster_source").isin("UI", "API")
        & ((F.coalesce(F.col("auto_termination_minutes"), F.lit(0)) == 0)
           | (F.col("auto_termination_minutes") > cfg.max_autoterm)
           | (F.col("min_autoscale_workers").isNull()
              & (F.coalesce(F.col("worker_count"), F.lit(0)) >= cfg.big_workers))))
    detail = F.concat(F.lit("auto_term="), F.coalesce(F.col("auto_termination_minutes").cast("string"), F.lit("null")),
                      F.lit(", workers="), F.coalesce(F.col("worker_count").cast("string"), F.lit("null")),
                      F.lit(", autoscale="), F.coalesce(F.col("min_autoscale_workers").cast("string"), F.lit("off")))
    return lt.select(*finding(as_of, "C03_cluster_config", "Risky cluster config (no auto-term / no autoscale)",
                              "medium", "cluster", F.col("cluster_id"), F.col("cluster_name"), F.col("owned_by"),
                              F.col("workspace_id"), detail, F.lit(None)))


def c04_photon_review(pu: DataFrame, as_of, cfg: CostConfig) -> DataFrame:
    g = (pu.where(F.col("sku_name").like("%JOBS%") & ~F.col("sku_name").like("%PHOTON%")
                  & F.col("usage_metadata.cluster_id").isNotNull())
         .groupBy("workspace_id", F.col("usage_metadata.cluster_id").alias("cluster_id"))
         .agg(F.sum("cost_usd").alias("cost")).where(F.col("cost") > cfg.min_cost * 4))
    detail = F.concat(F.lit("non-Photon jobs compute $"), _int_text(F.col("cost")),
                      F.lit(f" over {cfg.lookback}d - evaluate Photon for throughput/$"))
    return g.select(*finding(as_of, "C04_photon_review", "Photon review (high-cost non-Photon jobs)", "medium",
                             "cluster", F.col("cluster_id"), F.col("cluster_id"), F.lit(None), F.col("workspace_id"),
                             detail, _saving(F.col("cost"), cfg.photon_saving)))


def query_shape(text_col: str = "statement_text") -> Column:
    """sha256 of the lower-cased statement with every digit run replaced by ``N``."""
    return F.sha2(F.regexp_replace(F.lower(F.col(text_col)), "[0-9]+", "N"), 256)


def c05_repeat_queries(qh: DataFrame, as_of, cfg: CostConfig) -> DataFrame:
    g = (qh.where(_since("start_time", as_of, cfg.lookback) & (F.col("statement_type") == "SELECT")
                  & (F.col("execution_status") == "FINISHED"))
         .groupBy("workspace_id", query_shape().alias("q_hash"))
         .agg(F.min("statement_text").alias("q_sample"), F.count(F.lit(1)).alias("runs"),
              F.round((F.sum("total_duration_ms") / 1000).cast("decimal(38,6)"), 0).alias("total_sec"),
              F.round((F.sum("read_bytes") / 1e12).cast("decimal(38,6)"), 3).alias("read_tb"))
         .where((F.col("runs") >= cfg.repeat_runs) & (F.col("total_sec") > 600)))
    detail = F.concat(F.col("runs").cast("string"), F.lit(" runs, "), F.col("total_sec").cast("bigint").cast("string"),
                      F.lit("s total, "), F.col("read_tb").cast("decimal(18,3)").cast("string"),
                      F.lit(f" TB scanned over {cfg.lookback}d"))
    return g.select(*finding(as_of, "C05_expensive_queries", "Expensive and repeated queries", "medium", "query",
                             F.col("q_hash"), F.col("q_sample"), F.lit(None), F.col("workspace_id"), detail,
                             F.lit(None)))


def c06_full_scans(qh: DataFrame, as_of, cfg: CostConfig) -> DataFrame:
    g = (qh.where(_since("start_time", as_of, cfg.lookback) & (F.col("read_files") > 0)
                  & (F.col("read_bytes") > cfg.big_bytes))
         .groupBy("workspace_id", query_shape().alias("q_hash"))
         .agg(F.min("statement_text").alias("q_sample"), F.count(F.lit(1)).alias("runs"),
              F.round((F.avg("read_bytes") / 1e9).cast("decimal(38,6)"), 1).alias("avg_gb"),
              F.sum("pruned_files").alias("files_pruned"))
         .where(F.col("files_pruned") == 0))
    detail = F.concat(F.col("runs").cast("string"), F.lit(" runs, avg "),
                      F.col("avg_gb").cast("decimal(18,1)").cast("string"),
                      F.lit(" GB/scan, 0 files pruned - partition or cluster the source"))
    return g.select(*finding(as_of, "C06_full_scans", "Full-table scans (no file pruning)", "medium", "query",
                             F.col("q_hash"), F.col("q_sample"), F.lit(None), F.col("workspace_id"), detail,
                             F.lit(None)))


def c07_warehouse_rightsizing(pu: DataFrame, qh: DataFrame, as_of, cfg: CostConfig) -> DataFrame:
    wcost = (pu.where(F.col("usage_metadata.warehouse_id").isNotNull())
             .groupBy(F.col("usage_metadata.warehouse_id").alias("wh"), "workspace_id")
             .agg(F.sum("cost_usd").alias("cost")))
    wq = (qh.where(_since("start_time", as_of, cfg.lookback) & F.col("compute.warehouse_id").isNotNull())
          .groupBy(F.col("compute.warehouse_id").alias("wh"))
          .agg(F.count(F.lit(1)).alias("runs"), (F.sum("total_duration_ms") / 1000).alias("busy_sec")))
    window_s = cfg.lookback * 86400
    j = wcost.join(wq, "wh", "left")
    busy = F.coalesce(F.col("busy_sec"), F.lit(0.0)) / window_s
    j = j.where((F.col("cost") > cfg.min_cost) & (busy < 0.25))
    detail = F.concat(F.lit("$"), _int_text(F.col("cost")), F.lit(f" over {cfg.lookback}d, "),
                      F.coalesce(F.col("runs"), F.lit(0)).cast("string"), F.lit(" queries, busy "),
                      (busy * 100).cast("decimal(18,1)").cast("string"), F.lit("% of the window"))
    saving = (F.col("cost").cast("double") * (1 - F.least(F.lit(1.0), busy)) * cfg.wh_idle_saving)
    return j.select(*finding(as_of, "C07_warehouse_rightsizing", "SQL warehouse right-sizing / auto-stop", "high",
                             "warehouse", F.col("wh"), F.col("wh"), F.lit(None), F.col("workspace_id"), detail,
                             saving.cast("decimal(18,2)").cast("double")))


def c08_unused_tables(tables: DataFrame, reads: DataFrame, as_of, cfg: CostConfig) -> DataFrame:
    """Managed tables with no read in ``unused_days``: an anti join on the distinct
    read keys (instead of a null-aware ``NOT IN``). All of them: only a report cuts."""
    used = (reads.where(_since("read_at", as_of, cfg.unused_days) & F.col("table_id").isNotNull())
            .select("table_id").distinct())
    unused = (tables.where(F.col("table_type") == "MANAGED").join(used, "table_id", "left_anti"))
    return unused.select(*finding(
        as_of, "C08_storage_sprawl", "Storage sprawl (tables not queried in 90d)", "low", "table",
        F.col("table_id"), F.col("table_name"), F.lit(None), F.lit(None),
        "managed table with no read in 90d - archive or drop", F.lit(None)))


def c09_job_failures(pu: DataFrame, runs: DataFrame, as_of, cfg: CostConfig, names: DataFrame | None = None) -> DataFrame:
    """Jobs with failed runs. ``names (job_id, job_name, change_time)`` gives the name a job had last before
    ``as_of``; without it, or for a job that is not there, the id stands in."""
    r = (runs.where(_since("period_start_time", as_of, cfg.lookback))
         .groupBy("job_id", "run_id", "workspace_id")
         .agg(F.max("result_state").alias("state"),
              F.sum(F.unix_timestamp(F.col("period_end_time").cast("timestamp"))
                    - F.unix_timestamp(F.col("period_start_time").cast("timestamp"))).alias("run_sec")))
    a = (r.groupBy("job_id", "workspace_id")
         .agg(F.count(F.lit(1)).alias("total_runs"), F.count_if(F.col("state") == "FAILED").alias("failed_runs"),
              F.sum(F.when(F.col("state") == "FAILED", F.col("run_sec")).otherwise(0)).alias("failed_sec"),
              F.sum("run_sec").alias("all_sec"))
         .where(F.col("failed_runs") >= 3))
    jcost = (pu.where(F.col("usage_metadata.job_id").isNotNull())
             .groupBy(F.col("usage_metadata.job_id").alias("job_id")).agg(F.sum("cost_usd").alias("cost")))
    j = a.join(jcost, "job_id", "left")
    detail = F.concat(F.col("failed_runs").cast("string"), F.lit("/"), F.col("total_runs").cast("string"),
                      F.lit(f" runs failed over {cfg.lookback}d, "),
                      (F.col("failed_sec").cast("decimal(38,6)") / 3600).cast("decimal(18,1)").cast("string"),
                      F.lit(" compute-hours wasted"))
    saving = (F.coalesce(F.col("cost"), F.lit(0)).cast("double") * F.col("failed_sec")
              / F.when(F.col("all_sec") != 0, F.col("all_sec")))
    name = F.col("job_id").cast("string")
    if names is not None:
        last = (names.where(F.col("change_time") < ts_lit(as_of)).groupBy("job_id")
                .agg(F.max(F.struct("change_time", "job_name"))["job_name"].alias("job_name")))
        j, name = j.join(last, "job_id", "left"), F.coalesce("job_name", name)
    return j.select(*finding(as_of, "C09_job_failures", "Job failures burning compute", "medium", "job",
                             F.col("job_id"), name, F.lit(None), F.col("workspace_id"), detail,
                             saving.cast("decimal(18,2)").cast("double")))


def c10_on_demand(pu: DataFrame, clusters: DataFrame, as_of, cfg: CostConfig) -> DataFrame:
    lt = latest_clusters(clusters)
    avail = F.upper(F.coalesce(F.col("aws_attributes.availability"), F.col("azure_attributes.availability"),
                               F.col("gcp_attributes.availability"), F.lit("")))
    co = cluster_cost(pu).withColumnRenamed("workspace_id", "cost_workspace_id")
    j = lt.join(co, "cluster_id", "inner").where((F.col("cost") > cfg.min_cost) & avail.like("%ON_DEMAND%"))
    detail = F.concat(F.lit("on-demand workers, "), _int_text(F.col("cost")),
                      F.lit(f" $/{cfg.lookback}d - use spot for fault-tolerant work"))
    return j.select(*finding(as_of, "C10_pricing_leakage", "On-demand where spot would do", "medium", "cluster",
                             F.col("cluster_id"), F.col("cluster_name"), F.col("owned_by"),
                             F.col("cost_workspace_id"), detail, _saving(F.col("cost"), cfg.spot_saving)))


def c11_tag_hygiene(pu: DataFrame, as_of, cfg: CostConfig, strict: bool = False) -> DataFrame:
    """Spend with neither ``cost_centre`` nor ``team`` tag. A null tag map counts as
    untagged unless ``strict`` (then the row drops out, as a bare predicate would)."""
    tags = F.col("custom_tags") if strict else F.coalesce(F.col("custom_tags"), F.create_map().cast("map<string,string>"))
    untagged = ~(F.map_contains_key(tags, "cost_centre") | F.map_contains_key(tags, "team"))
    md = "usage_metadata"
    rtype = F.coalesce(F.when(F.col(f"{md}.warehouse_id").isNotNull(), "warehouse")
                       .when(F.col(f"{md}.job_id").isNotNull(), "job")
                       .when(F.col(f"{md}.cluster_id").isNotNull(), "cluster"), F.lit("other"))
    rid = F.coalesce(F.col(f"{md}.warehouse_id"), F.col(f"{md}.job_id").cast("string"), F.col(f"{md}.cluster_id"),
                     F.lit("unknown"))
    g = (pu.where(untagged).groupBy("workspace_id", rtype.alias("rtype"), rid.alias("rid"))
         .agg(F.sum("cost_usd").alias("cost")).where(F.col("cost") > cfg.min_cost))
    detail = F.concat(F.lit("$"), _int_text(F.col("cost")),
                      F.lit(f" untagged over {cfg.lookback}d - add cost_centre/team tag"))
    return g.select(*finding(as_of, "C11_tag_hygiene", "Untagged spend (no cost-centre attribution)", "low",
                             F.col("rtype"), F.col("rid"), F.col("rid"), F.lit(None), F.col("workspace_id"), detail,
                             F.lit(None)))


# --- findings history and summary --------------------------------------------------

def findings_summary(findings: DataFrame) -> DataFrame:
    """Today's findings (the newest run_date) with first_seen, last_seen, days_open, is_new.

    The newest date is a one-row aggregate joined back by broadcast.
    """
    hist = findings.groupBy("check_id", "resource_id").agg(F.min("run_date").alias("first_seen"),
                                                          F.max("run_date").alias("last_seen"))
    latest = findings.agg(F.max("run_date").alias("__d"))
    today = findings.join(F.broadcast(latest), F.col("run_date") == F.col("__d"), "inner").drop("__d")
    j = today.join(hist, ["check_id", "resource_id"], "inner")
    return j.select(*FINDING_COLUMNS, "first_seen", "last_seen",
                    F.datediff("last_seen", "first_seen").cast("bigint").alias("days_open"),
                    (F.col("first_seen") == F.col("run_date")).alias("is_new"))


def findings_totals(summary: DataFrame) -> DataFrame:
    s = F.coalesce(F.col("est_monthly_saving_usd"), F.lit(0.0)).cast("decimal(18,2)")
    return summary.agg(F.count(F.lit(1)).alias("n_findings"), F.round(F.sum(s), 0).cast("bigint").alias("est_saving"),
                       F.count_if("is_new").alias("n_new"),
                       F.round(F.sum(F.when(F.col("is_new"), s)), 0).cast("bigint").alias("new_saving"))


def findings_top(summary: DataFrame, n: int = 15) -> DataFrame:
    """Top n by saving, new first on ties (then check and resource for a stable order)."""
    return (summary.orderBy(F.coalesce(F.col("est_monthly_saving_usd"), F.lit(0.0)).desc(), F.col("is_new").desc(),
                            "check_id", "resource_id").limit(n)
            .select("check_id", "severity", "resource_type", "resource_id", "resource_name", "detail",
                    "est_monthly_saving_usd", "is_new", "days_open"))


def findings_by_check(summary: DataFrame) -> DataFrame:
    s = F.coalesce(F.col("est_monthly_saving_usd"), F.lit(0.0)).cast("decimal(18,2)")
    return summary.groupBy("check_id").agg(F.count(F.lit(1)).alias("n"),
                                           F.round(F.sum(s), 0).cast("bigint").alias("saving"))


# --- cost drivers ---------------------------------------------------------------------

def job_costs(pu: DataFrame) -> DataFrame:
    return (pu.where(F.col("usage_metadata.job_id").isNotNull())
            .groupBy(F.col("usage_metadata.job_id").alias("job_id"))
            .agg(F.sum("cost_usd").alias("total_cost"), F.countDistinct(F.to_date("usage_date")).alias("days")))


def cost_drivers(pu: DataFrame, n: int = 10) -> DataFrame:
    """Top n jobs by cost with average daily cost and share of all job spend.

    The total is a one-row aggregate broadcast to the per-job rows (no
    unpartitioned window)."""
    jc = job_costs(pu)
    total = jc.agg(F.sum("total_cost").alias("__all"))
    j = jc.crossJoin(F.broadcast(total))
    return (j.orderBy(F.col("total_cost").desc(), "job_id").limit(n)
            .select("job_id", F.col("total_cost").cast("decimal(18,2)").cast("double").alias("total_cost"),
                    (F.col("total_cost") / F.col("days")).cast("decimal(18,2)").cast("double").alias("avg_daily_cost"),
                    (F.col("total_cost") * 100 / F.col("__all")).cast("decimal(18,2)").cast("double").alias("share_pct")))


def cost_trend(usage_priced_all: DataFrame, as_of, window_days: int, flat_pct: int = 5) -> DataFrame:
    """Per job: cost in the last window vs the prior window of the same length
    (one conditional aggregate, no self join)."""
    cur = _since("usage_date", as_of, window_days)
    prior = _since("usage_date", as_of, 2 * window_days) & ~cur
    end = F.col("usage_date") < ts_lit(as_of)
    g = (usage_priced_all.where(F.col("usage_metadata.job_id").isNotNull() & end
                                & _since("usage_date", as_of, 2 * window_days))
         .groupBy(F.col("usage_metadata.job_id").alias("job_id"))
         .agg(F.sum(F.when(cur, F.col("cost_usd")).otherwise(0)).alias("cur"),
              F.sum(F.when(prior, F.col("cost_usd")).otherwise(0)).alias("prior")))
    pct = F.when(F.col("prior") != 0, (F.col("cur") - F.col("prior")) * 100 / F.col("prior"))
    trend = (F.when(pct.isNull(), F.when(F.col("cur") > 0, "new").otherwise("flat"))
             .when(pct > flat_pct, "up").when(pct < -flat_pct, "down").otherwise("flat"))
    return g.select("job_id", F.col("cur").cast("decimal(18,2)").cast("double").alias("current_cost"),
                    F.col("prior").cast("decimal(18,2)").cast("double").alias("prior_cost"),
                    pct.cast("decimal(18,1)").cast("double").alias("change_pct"), trend.alias("trend"))


def cost_proxy(runs: DataFrame, pu: DataFrame, cluster_size: Column | int = 1) -> DataFrame:
    """Billed cost per job where usage exists, else duration x cluster size flagged as a proxy."""
    size = cluster_size if isinstance(cluster_size, Column) else F.lit(cluster_size)
    dur = (runs.groupBy("job_id").agg(F.sum((F.unix_timestamp(F.col("period_end_time").cast("timestamp"))
                                             - F.unix_timestamp(F.col("period_start_time").cast("timestamp")))
                                            * size).alias("node_sec")))
    billed = job_costs(pu).select("job_id", "total_cost")
    j = dur.join(billed, "job_id", "left")
    return j.select("job_id", F.coalesce(F.col("total_cost").cast("decimal(18,2)").cast("double"),
                                         (F.col("node_sec") / 3600).cast("decimal(18,2)").cast("double"))
                    .alias("cost_value"),
                    F.col("total_cost").isNull().alias("is_proxy"))


def cost_anomaly(pu: DataFrame, history: int = 7, k: float = 3.0) -> DataFrame:
    """Days where a job's cost jumps beyond its own trailing volatility.

    The window is partitioned by job over that job's daily series (one row per
    job-day), so each task holds a few hundred rows per job at most."""
    daily = (pu.where(F.col("usage_metadata.job_id").isNotNull())
             .groupBy(F.col("usage_metadata.job_id").alias("job_id"), F.to_date("usage_date").alias("day"))
             .agg(F.sum("cost_usd").cast("double").alias("cost")))
    w = Window.partitionBy("job_id").orderBy("day").rowsBetween(-history, -1)
    s = (daily.withColumn("mu", F.avg("cost").over(w)).withColumn("sd", F.stddev_samp("cost").over(w))
         .withColumn("n", F.count("cost").over(w)))
    z = (F.col("cost") - F.col("mu")) / F.col("sd")
    return (s.where((F.col("n") >= 3) & (F.col("sd") > 0) & (z > k))
            .select("job_id", F.date_format("day", "yyyy-MM-dd").alias("day"),
                    F.col("cost").cast("decimal(18,2)").cast("double").alias("cost"),
                    z.cast("decimal(18,2)").cast("double").alias("z_score")))


# --- the audit: checks with declared needs, run per day -----------------------------------

TAGS = "map<string,string>"


def usage_cube(pu: DataFrame) -> DataFrame:
    """Priced usage summed over everything no check looks at: a row for each time, workspace, SKU, job, cluster,
    warehouse and pair of cost tags. Sums are exact decimals, so checks over it equal checks over all rows."""
    kept = F.map_filter("custom_tags", lambda k, v: k.isin("cost_centre", "team"))
    md = [F.col(f"usage_metadata.{c}").alias(c) for c in ("cluster_id", "job_id", "warehouse_id")]
    cube = (pu.select("usage_date", "workspace_id", "sku_name", *md, F.to_json(kept).alias("tags"), "cost_usd")
            .groupBy("usage_date", "workspace_id", "sku_name", "cluster_id", "job_id", "warehouse_id", "tags").agg(F.sum("cost_usd").alias("cost_usd")))
    return cube.select("usage_date", "workspace_id", "sku_name", F.struct("cluster_id", "job_id", "warehouse_id").alias("usage_metadata"),
                       F.from_json("tags", TAGS).alias("custom_tags"), "cost_usd")


@dataclass(frozen=True)
class Day:
    """What a check is given: the tables, priced usage in the lookback of its day, and the settings."""
    tables: dict[str, DataFrame]
    priced: DataFrame | None
    as_of: str
    cfg: CostConfig


@dataclass(frozen=True)
class Check:
    """A check and what it needs: columns by table. ``wants`` are tables it can do without."""
    check_id: str
    needs: dict[str, tuple[str, ...]]
    build: Callable[[Day], DataFrame]
    wants: tuple[str, ...] = ()


USAGE = {"usage": ("usage_date", "workspace_id", "sku_name", "usage_quantity", "usage_metadata", "custom_tags"),
         "list_prices": ("sku_name", "currency_code", "price_end_time", "pricing")}
HISTORY = ("workspace_id", "start_time", "statement_text", "statement_type", "execution_status", "total_duration_ms", "read_bytes")
CLUSTERS = ("cluster_id", "cluster_name", "owned_by", "workspace_id", "change_time", "delete_time")

CHECKS = [
    Check("C01_all_purpose_for_jobs", USAGE, lambda d: c01_all_purpose_jobs(d.priced, d.as_of, d.cfg)),
    Check("C02_idle_clusters", USAGE | {"node_timeline": ("cluster_id", "start_time", "driver", "cpu_user_percent", "cpu_system_percent", "mem_used_percent")},
          lambda d: c02_idle_clusters(d.priced, d.tables["node_timeline"], d.as_of, d.cfg)),
    Check("C03_cluster_config", {"clusters": (*CLUSTERS, "cluster_source", "auto_termination_minutes", "worker_count", "min_autoscale_workers")},
          lambda d: c03_cluster_config(d.tables["clusters"], d.as_of, d.cfg)),
    Check("C04_photon_review", USAGE, lambda d: c04_photon_review(d.priced, d.as_of, d.cfg)),
    Check("C05_expensive_queries", {"query_history": HISTORY}, lambda d: c05_repeat_queries(d.tables["query_history"], d.as_of, d.cfg)),
    Check("C06_full_scans", {"query_history": (*HISTORY, "read_files", "pruned_files")}, lambda d: c06_full_scans(d.tables["query_history"], d.as_of, d.cfg)),
    Check("C07_warehouse_rightsizing", USAGE | {"query_history": ("start_time", "total_duration_ms", "compute")},
          lambda d: c07_warehouse_rightsizing(d.priced, d.tables["query_history"], d.as_of, d.cfg)),
    Check("C08_storage_sprawl", {"managed_tables": ("table_id", "table_name", "table_type"), "table_reads": ("table_id", "read_at")},
          lambda d: c08_unused_tables(d.tables["managed_tables"], d.tables["table_reads"], d.as_of, d.cfg)),
    Check("C09_job_failures", USAGE | {"job_run_timeline": ("job_id", "run_id", "workspace_id", "result_state", "period_start_time", "period_end_time")},
          lambda d: c09_job_failures(d.priced, d.tables["job_run_timeline"], d.as_of, d.cfg, d.tables.get("job_names")), ("job_names",)),
    Check("C10_pricing_leakage", USAGE | {"clusters": (*CLUSTERS, "aws_attributes", "azure_attributes", "gcp_attributes")},
          lambda d: c10_on_demand(d.priced, d.tables["clusters"], d.as_of, d.cfg)),
    Check("C11_tag_hygiene", USAGE, lambda d: c11_tag_hygiene(d.priced, d.as_of, d.cfg)),
]


def planned_checks(tables: dict[str, DataFrame], checks: list[Check] | None = None) -> list[tuple[Check, str | None]]:
    """Each check with the reason why it cannot run (None: it can): the first table or column it needs and
    does not find. Only schemas are looked at; an error while a check runs is an error of the audit."""
    out = []
    for check in checks or CHECKS:
        reason = None
        for table, columns in check.needs.items():
            if table not in tables:
                reason = f"no table {table}"
            elif lost := [c for c in columns if c not in tables[table].columns]:
                reason = f"no column {lost[0]} in {table}"
            if reason:
                break
        out.append((check, reason))
    return out


def audit_checks(spark, tables: dict[str, DataFrame], checks: list[Check] | None = None) -> DataFrame:
    """``(check_id, status, reason)`` of every check."""
    rows = [(c.check_id, "skipped" if reason else "ran", reason) for c, reason in planned_checks(tables, checks)]
    return spark.createDataFrame(rows, "check_id string, status string, reason string")


def run_audit(tables: dict[str, DataFrame], days: list[str], cfg: CostConfig, path: str, checks: list[Check] | None = None) -> DataFrame:
    """Runs every check whose needs are met for each day and leaves the findings under ``path``, a folder for
    each day. Usage is read, priced and summed once for all days and checks. A day that is audited again
    replaces its own findings, also if it has none any more; other days stay. Returns the findings of all
    days that are stored."""
    spark = next(iter(tables.values())).sparkSession
    able = [c for c, reason in planned_checks(tables, checks) if reason is None]
    cube = None
    if any("usage" in c.needs for c in able):
        since, until = min(days), max(days)
        usage = tables["usage"].where((F.col("usage_date") >= F.date_sub(date_lit(since), cfg.lookback).cast("timestamp_ntz"))
                                      & (F.col("usage_date") < ts_lit(until)))
        cube = usage_cube(with_cost(usage, tables["list_prices"])).checkpoint(eager=True)
    for day in days:
        priced = cube.where(_since("usage_date", day, cfg.lookback)) if cube is not None else None
        parts = [c.build(Day(tables, priced, day, cfg)) for c in able]
        none = spark.createDataFrame([], FINDING_SCHEMA)
        # A folder of the day's own, replaced as a whole: an empty day leaves none of its old rows.
        reduce(lambda a, b: a.unionByName(b), parts, none).drop("run_date").write.mode("overwrite").parquet(f"{path}/run_date={day[:10]}")
    stored = spark.read.schema(FINDING_SCHEMA).parquet(path)
    return stored.select(*FINDING_COLUMNS)


def audit_dates(as_of, days: list[int]) -> list[str]:
    import datetime as dt
    base = dt.datetime.strptime(as_of_text(as_of), "%Y-%m-%d %H:%M:%S")
    return [(base - dt.timedelta(days=d)).strftime("%Y-%m-%d %H:%M:%S") for d in days]
