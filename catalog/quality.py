"""Profile, checks, score."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.views import FEED_SQL, feed, with_sql
from tidegate.operators import quality as q
from tidegate.operators.quantiles import group_quantiles
from tidegate.session import scratch_path
from tidegate.sources.tables import stored_report, write_report

_COLUMNS = ["date", "cycle", "location", "capacity", "available", "note"]
_NULLS = ", ".join(f"count(*) - count({c}) as {c}__nulls" for c in _COLUMNS)
_STATS = ", ".join(
    f"min({c}) as {c}__min, max({c}) as {c}__max, round(avg({c}), 6) as {c}__mean" for c in ("capacity", "available")
)


@query("profile", with_sql(FEED_SQL) + f"""
select file_name, count(*) as record_count, {_NULLS}, {_STATS} from feed group by file_name
""")
def profile(spark, sf_dir):
    wide = q.profile(feed(spark, sf_dir))
    return wide.withColumns({c: F.round(c, 6) for c in ("capacity__mean", "available__mean")})


_METRICS_SQL = ",\nstats as (select file_name, count(*) as n, " + ", ".join(
    f"count(*) - count({c}) as {c}_gaps" for c in _COLUMNS
) + """, min(capacity) as c0, max(capacity) as c1, round(avg(capacity), 2) as c2,
  min(available) as a0, max(available) as a1, round(avg(available), 2) as a2,
  count(distinct location) as u
  from feed group by file_name)
select file_name, 'capacity_min' as name, c0 as value from stats
union all select file_name, 'capacity_max', c1 from stats
union all select file_name, 'capacity_mean', c2 from stats
union all select file_name, 'available_min', a0 from stats
union all select file_name, 'available_max', a1 from stats
union all select file_name, 'available_mean', a2 from stats
union all select file_name, 'unique_locations', cast(u as double) from stats
union all select file_name, 'completeness', round(1 - (""" + " + ".join(f"{c}_gaps" for c in _COLUMNS) + """) / (n * 6.0), 4) from stats
"""


@query("quality_metrics", with_sql(FEED_SQL) + _METRICS_SQL)
def quality_metrics(spark, sf_dir):
    return q.profile_metrics(feed(spark, sf_dir))


@query("null_counts", with_sql(FEED_SQL) + "select * from (" + " union all ".join(
    f"select file_name, '{c}' as column_name, '{'ERROR' if c in ('date', 'cycle', 'location') else 'WARNING'}' as severity,"
    f" count(*) - count({c}) as missing from feed group by file_name" for c in _COLUMNS
) + ") where missing > 0")
def null_counts(spark, sf_dir):
    issues = q.quality_report(feed(spark, sf_dir)).issues
    return issues.where("type = 'MISSING_VALUES'").select(
        "file_name", F.col("column").alias("column_name"), "severity", F.col("affected_count").alias("missing")
    )


@query("unique_locations", with_sql(FEED_SQL) + """,
sizes as (select file_name, location, count(*) over (partition by file_name, date, cycle, location) as n from feed)
select file_name, cast(count(*) filter (where n > 1) as bigint) as duplicate_rows,
  count(distinct location) as unique_locations
from sizes group by file_name
""")
def unique_locations(spark, sf_dir):
    return q.key_statistics(feed(spark, sf_dir))


@query("quartiles", with_sql(FEED_SQL) + """
select file_name, round(quantile_cont(capacity, 0.25), 6) as capacity_q0, round(quantile_cont(capacity, 0.75), 6) as capacity_q1,
  round(quantile_cont(available, 0.25), 6) as available_q0, round(quantile_cont(available, 0.75), 6) as available_q1
from feed group by file_name
""")
def quartiles(spark, sf_dir):
    found = group_quantiles(
        feed(spark, sf_dir), ["file_name"], ["capacity", "available"], q.QUARTILES, ["row_id"]
    )
    return found.select("file_name", *[F.round(c, 6).alias(c) for c in found.columns if c != "file_name"])


_BOUNDS = """,
bounds as (
  select file_name, quantile_cont(capacity, 0.25) as c1, quantile_cont(capacity, 0.75) as c3,
    quantile_cont(available, 0.25) as a1, quantile_cont(available, 0.75) as a3
  from feed group by file_name
),
cells as (
  select file_name, row_id, 'capacity' as "column", capacity as value, c1 as q1, c3 as q3 from feed join bounds using (file_name)
  union all
  select file_name, row_id, 'available', available, a1, a3 from feed join bounds using (file_name)
),
outlying as (
  select file_name, row_id, "column", value from cells
  where value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1)
)
"""


@query("outliers", with_sql(FEED_SQL) + _BOUNDS + "select * from outlying")
def outliers(spark, sf_dir):
    return q.outliers(feed(spark, sf_dir))


@query("inconsistent", with_sql(FEED_SQL) + "select * from feed where capacity < available")
def inconsistent(spark, sf_dir):
    return feed(spark, sf_dir).where(q.inconsistent())


_ISSUE_ROWS = _BOUNDS + """,
members as (select *, count(*) over (partition by file_name, date, cycle, location) as n from feed),
issue_rows as (
  select file_name, 'INCONSISTENT_DATA' as type, null as "column", row_id from feed where capacity < available
  union all select file_name, 'DUPLICATE_RECORDS', null, row_id from members where n > 1
""" + "".join(
    f"  union all select file_name, 'MISSING_VALUES', '{c}', row_id from feed where {c} is null\n" for c in _COLUMNS
) + """  union all select file_name, 'POTENTIAL_OUTLIERS', "column", row_id from outlying
)
"""


@query("quality_issue_rows", with_sql(FEED_SQL) + _ISSUE_ROWS + "select * from issue_rows")
def quality_issue_rows(spark, sf_dir):
    return q.quality_report(feed(spark, sf_dir)).issue_rows


_ISSUES = _ISSUE_ROWS + """,
issues as (
  select file_name, case when type = 'INCONSISTENT_DATA' then 'ERROR' when type = 'POTENTIAL_OUTLIERS' then 'INFO'
      when type = 'MISSING_VALUES' and "column" in ('date', 'cycle', 'location') then 'ERROR' else 'WARNING' end as severity,
    type, "column", count(*) as affected_count
  from issue_rows group by file_name, type, "column"
)
"""


@query("quality_issues", with_sql(FEED_SQL) + _ISSUES + """
select *, case type
  when 'INCONSISTENT_DATA' then concat('Inconsistent capacity data: capacity < available for ', affected_count, ' records')
  when 'DUPLICATE_RECORDS' then concat('Duplicate location entries found: ', affected_count, ' records')
  when 'MISSING_VALUES' then concat('Missing values in ', "column", ': ', affected_count, ' records affected')
  else concat('Potential outliers in ', "column", ': ', affected_count, ' records affected') end as description
from issues
""")
def quality_issues(spark, sf_dir):
    return q.quality_report(feed(spark, sf_dir)).issues.drop("issue_id")


@query("severity_counts", with_sql(FEED_SQL) + _ISSUES + """
select file_name, severity, count(*) as issue_count from issues group by file_name, severity
""")
def severity_counts(spark, sf_dir):
    return q.severity_counts(q.quality_report(feed(spark, sf_dir)).issues)


_SUMMARY = with_sql(FEED_SQL) + _ISSUES + """,
sizes as (select file_name, count(*) as record_count from feed group by file_name),
counted as (
  select file_name, cast(count(*) as integer) as issue_count, count(*) filter (where severity = 'ERROR') * 1.0
    + count(*) filter (where severity = 'WARNING') * 0.5 + count(*) filter (where severity = 'INFO') * 0.1 as weight
  from issues group by file_name
),
scored as (
  select file_name, record_count, 6 as column_count, coalesce(issue_count, 0) as issue_count,
    round(cast(greatest(0, 1 - coalesce(weight, 0) / (greatest(record_count, 1) * 2)) as double), 2) as quality_score
  from sizes left join counted using (file_name)
)
select *, case when quality_score >= 0.8 then 'PASSED' when quality_score >= 0.5 then 'WARNING' else 'FAILED' end as status,
  quality_score >= 0.8 as passed
from scored
"""


@query("quality_summary", _SUMMARY)
def quality_summary(spark, sf_dir):
    return q.quality_report(feed(spark, sf_dir)).summary


@query("stored_reports", _SUMMARY.replace("from scored\n", "from scored, (select unnest(['run-1', 'run-2']) as run)\n"))
def stored_reports(spark, sf_dir):
    """Two runs' reports written as JSON and read again; neither replaces the other's, a repeated run its own."""
    out = scratch_path(spark, "reports")
    report = stored_report(q.quality_report(feed(spark, sf_dir)), f"{out}__staging/issue_rows")
    for run in ("run-1", "run-2", "run-2"):
        write_report(report, out, run)
    again = spark.read.json(f"{out}/reports").select(F.col("run_date").alias("run"), "file_name", "summary.*")
    return again.withColumns({c: F.col(c).cast("int") for c in ("column_count", "issue_count")})


_LACKING = "file_name in ('click', 'error')"
_TWO_LAYOUTS = with_sql(FEED_SQL.replace("case when k < 95 then k end as available", "case when k < 95 and event_type not in ('click', 'error') then k end as available"))


def _two_layouts(spark, sf_dir):
    """Clicks and errors come in files without availability; read together they have the column, empty."""
    lacking = F.expr(_LACKING)
    rows = feed(spark, sf_dir).withColumn("available", F.when(~lacking, F.col("available")))
    every = [c for c in rows.columns if c not in ("file_name", "row_id")]
    own = F.when(lacking, F.array(*[F.lit(c) for c in every if c != "available"])).otherwise(F.array(*map(F.lit, every)))
    return q.quality_report(rows, layouts=rows.select("file_name").distinct().withColumn("file_columns", own))


@query("quality_issues_layouts", _TWO_LAYOUTS + _ISSUES + f"""
select file_name, severity, type, "column", affected_count from issues
where not ({_LACKING} and type = 'MISSING_VALUES' and "column" = 'available')
union all select distinct file_name, 'ERROR', 'MISSING_COLUMNS', null, 0 from feed where {_LACKING}
""")
def quality_issues_layouts(spark, sf_dir):
    return _two_layouts(spark, sf_dir).issues.select("file_name", "severity", "type", "column", "affected_count")


@query("quality_layouts", _TWO_LAYOUTS + _ISSUES + f"""
select file_name, record_count, if({_LACKING}, 5, 6) as column_count, round(cast(1 - nulls / (record_count * if({_LACKING}, 5, 6)) as double), 4) as completeness,
  coalesce(rows_named, 0) as rows_named
from (
  select file_name, count(*) as record_count, 6 * count(*) - count(date) - count(cycle) - count(location) - count(capacity)
    - count(note) - case when {_LACKING} then count(*) else count(available) end as nulls
  from feed group by file_name
) left join (
  select file_name, count(*) as rows_named from issue_rows
  where not ({_LACKING} and type = 'MISSING_VALUES' and "column" = 'available') group by file_name
) using (file_name)
""")
def quality_layouts(spark, sf_dir):
    """Columns, completeness and affected rows per file, each by the file's own columns."""
    report = _two_layouts(spark, sf_dir)
    complete = report.metrics.where("name = 'completeness'").select("file_name", F.col("value").alias("completeness"))
    named = report.issue_rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("rows_named"))
    return report.summary.select("file_name", "record_count", "column_count").join(complete, "file_name").join(
        named, "file_name", "left").withColumn("rows_named", F.coalesce("rows_named", F.lit(0)))


@query("quality_missing_columns", """
select event_type as file_name, 'ERROR' as severity, 'MISSING_COLUMNS' as type,
  'Missing required columns: available, capacity, date, location' as description, count(*) as record_count
from events group by event_type
""")
def quality_missing_columns(spark, sf_dir):
    """A feed that lacks most expected columns: one issue per file, whatever its size."""
    rows = feed(spark, sf_dir).select("file_name", "row_id", "cycle")
    report = q.quality_report(rows)
    return report.issues.select("file_name", "severity", "type", "description").join(
        report.summary.select("file_name", "record_count"), "file_name"
    )
