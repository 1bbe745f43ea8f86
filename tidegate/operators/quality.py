"""Quality of feed files: profile, issues, affected rows, metrics, score and status.

All files of a load are checked together; every step is an aggregation per file
or a join to per-file statistics.  Issue counts never depend on row lists: the
affected rows are a DataFrame of their own, as long as the data makes it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidegate.functions import sqltext as sql
from tidegate.functions.numbers import round_exact
from tidegate.operators.clean import nan_to_null
from tidegate.operators.duplicates import flag_duplicates
from tidegate.operators.quantiles import ACCURACY, bracket_aggregates, quantiles_within
from tidegate.operators.skew import BROADCAST_ROWS, join_groups
from tidegate.schema import QUALITY_COLUMNS
from tidegate.session import materialise

ERROR, WARNING, INFO = "ERROR", "WARNING", "INFO"
# Weights of one issue, and the lowest score of a status.
SEVERITY_WEIGHTS = ((ERROR, 1.0), (WARNING, 0.5), (INFO, 0.1))
PASSED_FROM, WARNING_FROM = 0.8, 0.5
QUARTILES = (0.25, 0.75)
FENCE = 1.5


@dataclass(frozen=True)
class Checks:
    """What a file is checked for; the defaults are those of a capacity feed."""

    by: str = "file_name"
    row_id: str = "row_id"
    expected: tuple[str, ...] = tuple(QUALITY_COLUMNS)
    keys: tuple[str, ...] = ("date", "cycle", "location")
    upper: str = "capacity"
    lower: str = "available"
    location: str = "location"
    no_outliers: tuple[str, ...] = ("date", "cycle")
    helpers: tuple[str, ...] = ("file_path", "file_size", "file_modified", "block_start")
    accuracy: int = ACCURACY
    limits: dict = field(default_factory=dict)
    # Further checks: each maps the rows to findings, one line per file and finding, with
    # the file, severity, type, column, description and affected_count.
    extra: tuple[Callable[[DataFrame], DataFrame], ...] = ()

    def columns(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c not in {self.by, self.row_id, *self.helpers}]

    def numeric(self, df: DataFrame) -> list[str]:
        return [c for c in self.columns(df) if isinstance(df.schema[c].dataType, T.NumericType)]

    def outlier_columns(self, df: DataFrame) -> list[str]:
        return [c for c in self.numeric(df) if c not in self.no_outliers]

    def missing(self, df: DataFrame) -> list[str]:
        return missing_columns(self.columns(df), self.expected)

    def has(self, df: DataFrame, *names: str) -> bool:
        return all(n in df.columns for n in names)


@dataclass(frozen=True)
class QualityReport:
    """``issues``, ``metrics`` and ``summary`` per file; ``issue_rows`` may be long."""

    issues: DataFrame
    metrics: DataFrame
    summary: DataFrame
    find_rows: Callable[[], DataFrame]

    @property
    def issue_rows(self) -> DataFrame:
        """The rows each issue affects; planned only when asked for."""
        return self.find_rows()


def missing_columns(actual: Sequence[str], expected: Sequence[str] = tuple(QUALITY_COLUMNS)) -> list[str]:
    return sorted(set(expected) - set(actual))


def inconsistent(upper: str = "capacity", lower: str = "available") -> Column:
    """More available than there is capacity; unknown values are no contradiction."""
    return F.coalesce(F.col(upper) < F.col(lower), F.lit(False))


def profile(df: DataFrame, checks: Checks = Checks()) -> DataFrame:
    """One line per file: rows, nulls per column, min, max and mean per numeric column."""
    df = nan_to_null(df)
    return df.groupBy(checks.by).agg(*_profile_aggregates(df, checks))


def _profile_aggregates(df: DataFrame, checks: Checks) -> list[Column]:
    aggregates = ["count(1) as record_count"]
    aggregates += [f"count(1) - count({sql.name(c)}) as {sql.name(f'{c}__nulls')}" for c in checks.columns(df)]
    aggregates += [
        f"cast({f}({sql.name(c)}) as double) as {sql.name(f'{c}__{label}')}"
        for c in checks.numeric(df)
        for f, label in (("min", "min"), ("max", "max"), ("avg", "mean"))
    ]
    return [F.expr(a) for a in aggregates]


# Columns of a row's own file, where files differ in them.
OWN = "__own_columns"


def _owns(df: DataFrame, column: str) -> str:
    """SQL: whether the file has the column; all files have all columns unless layouts are given."""
    return f"array_contains({OWN}, {sql.text(column)})" if OWN in df.columns else "true"


def _column_count(wide: DataFrame, df: DataFrame, checks: Checks) -> Column:
    columns = checks.columns(df)
    if OWN not in wide.columns:
        return F.lit(len(columns))
    return F.size(F.array_intersect(OWN, F.array(*map(F.lit, columns)).cast("array<string>")))


def _with_layouts(wide: DataFrame, df: DataFrame, layouts: DataFrame | None, checks: Checks) -> DataFrame:
    if layouts is None:
        return wide
    every = F.array(*map(F.lit, checks.columns(df))).cast("array<string>")
    joined = _joined(wide, layouts.select(checks.by, F.col("file_columns").alias(OWN)), checks.by)
    return joined.withColumn(OWN, F.coalesce(OWN, every))


def _completeness(wide: DataFrame, df: DataFrame, checks: Checks) -> Column:
    columns = checks.columns(df)
    empty = F.expr(" + ".join(f"if({_owns(wide, c)}, {sql.name(f'{c}__nulls')}, 0)" for c in columns) or "0")
    cells = F.col("record_count") * _column_count(wide, df, checks)
    return F.when(cells > 0, round_exact(1 - empty / cells, 4)).otherwise(F.lit(0.0))


def key_statistics(df: DataFrame, checks: Checks = Checks()) -> DataFrame:
    """Per file: rows in duplicate groups (``duplicate_rows``) and ``unique_locations``.

    One pre-aggregation on file and key serves both.
    """
    has_keys, has_location = checks.has(df, *checks.keys), checks.has(df, checks.location)
    keys = list(checks.keys) if has_keys else [checks.location] if has_location else []
    counted = df.groupBy(checks.by, *keys).agg(F.count(F.lit(1)).alias("n"))
    repeated = F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0))
    if not has_location:
        return counted.groupBy(checks.by).agg(
            (repeated if has_keys else F.lit(0)).cast("long").alias("duplicate_rows"),
            F.lit(None).cast("long").alias("unique_locations"),
        )
    per_location = counted.groupBy(checks.by, checks.location).agg(repeated.alias("d"))
    return per_location.groupBy(checks.by).agg(
        (F.sum("d") if has_keys else F.lit(0)).cast("long").alias("duplicate_rows"),
        F.count(checks.location).alias("unique_locations"),
    )


def _joined(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
    same = F.expr(sql.same({by: "__by"}))
    return left.join(right.withColumnRenamed(by, "__by"), same, "left").drop("__by")


@dataclass(frozen=True)
class _Measured:
    """Statistics per file, computed once, and how many files there are."""

    statistics: DataFrame
    files: int


def _measure(df: DataFrame, checks: Checks) -> _Measured:
    columns = checks.outlier_columns(df)
    aggregates = _profile_aggregates(df, checks) + bracket_aggregates(columns, QUARTILES, checks.accuracy)
    if checks.has(df, checks.upper, checks.lower):
        aggregates.append(F.count_if(inconsistent(checks.upper, checks.lower)).alias("inconsistent_rows"))
    statistics = materialise(df.groupBy(checks.by).agg(*aggregates))
    return _Measured(statistics, statistics.count())


def _fences(df: DataFrame, measured: _Measured, checks: Checks) -> DataFrame:
    """Per file and outlier column the quartiles and the lowest and highest ordinary value."""
    columns = checks.outlier_columns(df)
    lines = measured.statistics.select(checks.by, "record_count")
    if not columns:
        return lines
    quartiles = quantiles_within(
        df, measured.statistics, [checks.by], columns, QUARTILES, "record_count", [checks.row_id],
        lines=measured.files, **checks.limits,
    )
    bounds = []
    for c in columns:
        low, high = sql.name(f"{c}_q0"), sql.name(f"{c}_q1")
        bounds += [
            f"{low} as {sql.name(f'{c}__q1')}",
            f"{high} as {sql.name(f'{c}__q3')}",
            f"{low} - {FENCE}D * ({high} - {low}) as {sql.name(f'{c}__low')}",
            f"{high} + {FENCE}D * ({high} - {low}) as {sql.name(f'{c}__high')}",
        ]
    joined = _joined(lines, quartiles, checks.by)
    return joined.selectExpr(sql.name(checks.by), "record_count", *bounds)


def _is_outlier(c: str) -> str:
    value, low, high = (sql.name(x) for x in (c, f"{c}__low", f"{c}__high"))
    return f"coalesce({value} < {low} or {value} > {high}, false)"


def outlier_bounds(df: DataFrame, checks: Checks = Checks()) -> DataFrame:
    """``<column>__q1/q3/low/high`` per file."""
    df = nan_to_null(df)
    return _fences(df, _measure(df, checks), checks)


def _with_fences(df: DataFrame, fences: DataFrame, files: int, checks: Checks) -> DataFrame:
    ends = [f"{c}__{end}" for c in checks.outlier_columns(df) for end in ("low", "high")]
    if not ends:
        return df
    fences = fences.select(checks.by, "record_count", *ends)
    if files > checks.limits.get("broadcast_rows", BROADCAST_ROWS):
        fences = materialise(fences)  # used twice where it is not broadcast
    return join_groups(
        df, fences, [checks.by], "record_count", [checks.row_id], "inner", lines=files, **checks.limits
    )


def outliers(df: DataFrame, checks: Checks = Checks()) -> DataFrame:
    """One line per outlying cell: file, row, column, value."""
    df = nan_to_null(df)
    columns = checks.outlier_columns(df)
    measured = _measure(df, checks)
    rows = _with_fences(df, _fences(df, measured, checks), measured.files, checks)
    cells = ", ".join(
        f"case when {_is_outlier(c)} then"
        f" named_struct('column', {sql.text(c)}, 'value', cast({sql.name(c)} as double)) end"
        for c in columns
    )
    return rows.select(
        checks.by, checks.row_id, F.expr(f"explode(array_compact(array({cells}))) as cell")
    ).select(checks.by, checks.row_id, "cell.*")


def _issue(severity: str, kind: str, column: str | None, count: str, before: str, after: str) -> str:
    """SQL of one issue; ``count`` rows are named between the two halves of its description."""
    place = "cast(null as string)" if column is None else sql.text(column)
    description = f"concat({sql.text(before)}, {count}, {sql.text(after)})" if after else sql.text(before)
    return (
        f"named_struct('severity', {sql.text(severity)}, 'type', {sql.text(kind)}, 'column', {place},"
        f" 'description', {description}, 'affected_count', cast({count} as bigint))"
    )


def _issues(wide: DataFrame, df: DataFrame, checks: Checks) -> DataFrame:
    """Issues of every file from its statistics, numbered in the order of the checks."""
    found = []

    def add(severity: str, kind: str, column: str | None, counter: str, before: str, after: str) -> None:
        count = sql.name(counter)
        there = "" if column is None or OWN not in wide.columns else f" and {_owns(wide, column)}"
        found.append(f"case when {count} > 0{there} then {_issue(severity, kind, column, count, before, after)} end")

    if OWN in wide.columns:
        lacking = f"array_sort(array_except(array({', '.join(map(sql.text, checks.expected))}), {OWN}))"
        wide = wide.withColumn("__lacking", F.expr(f"array_join({lacking}, ', ')"))
        found.append(
            "case when __lacking <> '' then named_struct('severity', 'ERROR', 'type', 'MISSING_COLUMNS', 'column', cast(null as"
            " string), 'description', concat('Missing required columns: ', __lacking), 'affected_count', 0L) end"
        )
    elif missing := checks.missing(df):
        found.append(
            _issue(ERROR, "MISSING_COLUMNS", None, "0", f"Missing required columns: {', '.join(missing)}", "")
        )
    if checks.has(df, checks.upper, checks.lower):
        add(ERROR, "INCONSISTENT_DATA", None, "inconsistent_rows",
            f"Inconsistent capacity data: {checks.upper} < {checks.lower} for ", " records")
    if checks.has(df, *checks.keys):
        add(WARNING, "DUPLICATE_RECORDS", None, "duplicate_rows", "Duplicate location entries found: ", " records")
    for c in checks.columns(df):
        add(ERROR if c in checks.keys else WARNING, "MISSING_VALUES", c, f"{c}__nulls",
            f"Missing values in {c}: ", " records affected")
    for c in checks.outlier_columns(df):
        add(INFO, "POTENTIAL_OUTLIERS", c, f"{c}__outliers",
            f"Potential outliers in {c}: ", " records affected")
    listed = f"array_compact(array({', '.join(found)}))" if found else "array()"
    return wide.withColumn("issues", F.expr(listed)).drop("__lacking")


def _with_extra(wide: DataFrame, df: DataFrame, checks: Checks) -> DataFrame:
    """Findings of the further checks, put after the built-in ones."""
    for check in checks.extra:
        found = check(df).selectExpr(
            sql.name(checks.by),
            "named_struct('severity', severity, 'type', type, 'column', cast(column as string),"
            " 'description', description, 'affected_count', cast(affected_count as bigint)) as issue",
        )
        listed = found.groupBy(checks.by).agg(F.array_sort(F.collect_list("issue")).alias("__more"))
        added = _joined(wide, listed, checks.by)
        wide = added.withColumn("issues", F.expr("concat(issues, coalesce(__more, array()))")).drop("__more")
    return wide


def severity_counts(issues: DataFrame, by: str = "file_name") -> DataFrame:
    return issues.groupBy(by, "severity").agg(F.count(F.lit(1)).alias("issue_count"))


def quality_score(errors: Column, warnings: Column, infos: Column, records: Column) -> Column:
    """1 minus the weighted issues over twice the rows, not below 0, two places."""
    weighted = sum(
        (count * weight for count, (_, weight) in zip((errors, warnings, infos), SEVERITY_WEIGHTS)), F.lit(0.0)
    )
    lost = weighted / (F.greatest(records, F.lit(1)) * 2)
    return round_exact(F.greatest(F.lit(0.0), 1 - lost), 2)


def quality_status(score: Column) -> Column:
    return (
        F.when(score >= PASSED_FROM, "PASSED").when(score >= WARNING_FROM, "WARNING").otherwise("FAILED")
    )


def has_passed(status: Column) -> Column:
    return F.coalesce(status == "PASSED", F.lit(False))


def _summary(wide: DataFrame, df: DataFrame, checks: Checks) -> DataFrame:
    def number(severity: str) -> Column:
        return F.size(F.filter("issues", lambda i: i["severity"] == severity))

    score = quality_score(number(ERROR), number(WARNING), number(INFO), F.col("record_count"))
    return (
        wide.select(
            checks.by,
            "record_count",
            _column_count(wide, df, checks).alias("column_count"),
            F.size("issues").alias("issue_count"),
            score.alias("quality_score"),
        )
        .withColumn("status", quality_status(F.col("quality_score")))
        .withColumn("passed", has_passed(F.col("status")))
    )


def _metrics(wide: DataFrame, df: DataFrame, checks: Checks) -> DataFrame:
    def metric(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"))

    listed = []
    for c in checks.numeric(df):
        listed += [
            metric(f"{c}_min", F.col(f"{c}__min")),
            metric(f"{c}_max", F.col(f"{c}__max")),
            metric(f"{c}_mean", round_exact(F.col(f"{c}__mean"), 2)),
        ]
    listed.append(metric("completeness", _completeness(wide, df, checks)))
    if checks.has(df, checks.location):
        listed.append(metric("unique_locations", F.col("unique_locations")))
    return wide.select(checks.by, F.explode(F.array(*listed)).alias("m")).select(checks.by, "m.*")


def profile_metrics(df: DataFrame, checks: Checks = Checks()) -> DataFrame:
    """The metrics alone, in long form: one aggregation and one key count."""
    df = nan_to_null(df)
    wide = _joined(profile(df, checks), key_statistics(df, checks), checks.by)
    return _metrics(wide, df, checks)


def _issue_rows(df: DataFrame, fences: DataFrame, files: int, checks: Checks) -> DataFrame:
    """Rows each issue affects: file, type, column, row id."""
    rows = _with_fences(df, fences, files, checks)
    if OWN in fences.columns:
        rows = join_groups(
            rows, fences.select(checks.by, "record_count", OWN), [checks.by], "record_count", [checks.row_id], "inner",
            lines=files, **checks.limits,
        )
    kinds = []

    def add(kind: str, column: str | None, hit: str) -> None:
        place = "cast(null as string)" if column is None else sql.text(column)
        kinds.append(f"case when {hit} then named_struct('type', {sql.text(kind)}, 'column', {place}) end")

    if checks.has(df, checks.upper, checks.lower):
        add("INCONSISTENT_DATA", None, f"{sql.name(checks.upper)} < {sql.name(checks.lower)}")
    if checks.has(df, *checks.keys):
        flagged = [checks.by, *checks.keys]
        rows = flag_duplicates(rows, flagged, [checks.by, checks.row_id], "__duplicate", **_hot(checks))
        add("DUPLICATE_RECORDS", None, "__duplicate")
    for c in checks.columns(df):
        there = f" and {_owns(rows, c)}" if OWN in rows.columns else ""
        add("MISSING_VALUES", c, f"{sql.name(c)} is null{there}")
    for c in checks.outlier_columns(df):
        add("POTENTIAL_OUTLIERS", c, _is_outlier(c))
    listed = F.expr(f"explode(array_compact(array({', '.join(kinds)}))) as k")
    return rows.select(checks.by, checks.row_id, listed).select(checks.by, "k.*", checks.row_id)


def _hot(checks: Checks) -> dict:
    return {k: v for k, v in checks.limits.items() if k == "hot_rows"}


def quality_report(df: DataFrame, checks: Checks = Checks(), layouts: DataFrame | None = None) -> QualityReport:
    """All checks for all files of ``df``; per-file statistics are computed once.

    ``layouts`` says which columns every file has, one line per file (``checks.by``,
    ``file_columns``), where files of several layouts stand in one frame: a column
    that a file lacks is a missing column there, not a column of missing values.
    A file without a line has all columns.
    """
    df = nan_to_null(df)
    measured = _measure(df, checks)
    fences = _fences(df, measured, checks)
    wide = _joined(measured.statistics, key_statistics(df, checks), checks.by)
    if columns := checks.outlier_columns(df):
        # The fences are the same in all rows of a file; they are kept for the affected rows.
        ends = [sql.name(f"{c}__{end}") for c in columns for end in ("low", "high")]
        counted = _with_fences(df, fences, measured.files, checks).groupBy(checks.by).agg(
            *[F.expr(f"count_if({_is_outlier(c)}) as {sql.name(f'{c}__outliers')}") for c in columns],
            *[F.expr(f"max({end}) as {end}") for end in ends],
        )
        wide = _joined(wide, counted, checks.by)
    wide = _with_layouts(wide, df, layouts, checks)
    wide = materialise(_with_extra(_issues(wide, df, checks), df, checks))
    issues = wide.select(
        checks.by, F.posexplode("issues").alias("issue_id", "issue")
    ).select(checks.by, "issue_id", "issue.*")
    return QualityReport(
        issues=issues,
        metrics=_metrics(wide, df, checks),
        summary=_summary(wide, df, checks),
        find_rows=lambda: _issue_rows(df, wide, measured.files, checks),
    )


def unreadable_files(expected: DataFrame, listing: DataFrame, row_counts: DataFrame, by: str = "file_name") -> DataFrame:
    """Issues of files that cannot be checked: expected but not there, or without rows.

    All three have one line per file; ``row_counts`` holds ``by`` and ``record_count``.
    """
    gone = expected.select(by).join(listing.select(by), by, "left_anti").select(
        by,
        F.lit("FILE_NOT_FOUND").alias("type"),
        F.concat(F.lit("Data file not found: "), by).alias("description"),
    )
    filled = row_counts.where(F.col("record_count") > 0).select(by)
    empty = listing.select(by).join(filled, by, "left_anti").select(
        by,
        F.lit("EMPTY_FILE").alias("type"),
        F.concat(F.lit("Data file is empty: "), by).alias("description"),
    )
    return gone.unionByName(empty).withColumns({
        "severity": F.lit(ERROR), "issue_id": F.lit(0), "affected_count": F.lit(0).cast("long"),
    })


def refused_files(refused: DataFrame, by: str = "file_name") -> DataFrame:
    """Issues of files that could not be read from end to end: ``by`` and ``error``."""
    return refused.select(
        by,
        F.lit("UNREADABLE_FILE").alias("type"),
        F.concat(F.lit("Data file could not be read: "), by, F.lit(" ("), "error", F.lit(")")).alias("description"),
        F.lit(ERROR).alias("severity"), F.lit(0).alias("issue_id"), F.lit(0).cast("long").alias("affected_count"),
    )


def failed_summary(unreadable: DataFrame, by: str = "file_name") -> DataFrame:
    """Summary lines of files that could not be checked: zeros and FAILED."""
    return unreadable.groupBy(by).agg(F.count(F.lit(1)).cast("int").alias("issue_count")).select(
        by,
        F.lit(0).cast("long").alias("record_count"),
        F.lit(0).alias("column_count"),
        "issue_count",
        F.lit(0.0).alias("quality_score"),
        F.lit("FAILED").alias("status"),
        F.lit(False).alias("passed"),
    )


Checker = Callable[[DataFrame], QualityReport]


def checker(kind: str = "capacity", checks: Checks = Checks()) -> Checker:
    """The checker for a kind of feed; every kind is checked as capacity data."""
    del kind
    return lambda df: quality_report(df, checks)


def report_documents(report: QualityReport, by: str = "file_name") -> DataFrame:
    """One nested record per file: summary, metrics, issues and counts by severity.

    Affected rows stay out of the records, they are unbounded; see ``issue_rows``.
    """
    issue = F.struct("issue_id", "severity", "type", "column", "description", "affected_count")
    issues = report.issues.groupBy(by).agg(F.array_sort(F.collect_list(issue)).alias("issues"))
    metrics = report.metrics.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("metrics"))
    counts = severity_counts(report.issues, by).groupBy(by).agg(
        F.map_from_entries(F.collect_list(F.struct("severity", "issue_count"))).alias("issue_counts")
    )
    body = [c for c in report.summary.columns if c != by]
    summary = report.summary.select(by, F.struct(*body).alias("summary"))
    out = summary
    for part in (metrics, issues, counts):
        out = _joined(out, part, by)
    return out.withColumn("issues", F.coalesce("issues", F.array().cast(out.schema["issues"].dataType)))
