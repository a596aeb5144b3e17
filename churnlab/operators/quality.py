"""Q1-Q5 data-quality baseline, suggested constraints, drift check, baseline choice.

A profile is ONE wide aggregate over all columns, turned into one row per
column with ``inline`` (no per-column jobs). Baselines, constraints and
violations are small frames (one row per column) and stay DataFrames, so a
scheduled job or a ``foreachBatch`` monitor can write or join them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.functions import ratio
from churnlab.session import cut_lineage

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


QUANTILES = (0.25, 0.5, 0.75)


def profile_table(df: DataFrame, cols: list[str] | None = None, exact_distinct: bool = False) -> DataFrame:
    """(column, n, n_missing, mean, total, std, min, max, n_distinct, integral,
    p25, p50, p75, type, min_text, max_text, total_text) per column, of any atomic type.

    Counts and moments come from ONE aggregate turned into one row per column
    with ``inline``. Moments and quartiles are NULL where a column is not numeric;
    there ``min_text``/``max_text`` hold its range in text form; for whole numbers
    they, and ``total_text``, hold the exact figures that a double may round. With
    ``exact_distinct`` distinct counts and quartiles are exact: the one by a count of distinct
    (column, value) rows, the other by ranges narrowed around the wanted ranks (``exact_quantiles``; NaN
    is not ranked); otherwise a HyperLogLog++ sketch and ``percentile_approx`` inside the same aggregate.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = cols or [c for c, t in types.items() if isinstance(t, T.AtomicType)]
    numeric = {c for c in cols if isinstance(types[c], _NUMERIC)}
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        whole = isinstance(types[c], _INTEGRAL)
        exact = F.sum(F.col(c).cast("decimal(38,0)")) if whole else F.lit(None).cast("string")
        aggs += [F.count_if(F.col(c).isNull()).alias(f"m{i}"), F.avg(x).alias(f"a{i}"), F.sum(x).alias(f"s{i}"),
                 exact.cast("string").alias(f"st{i}"),
                 F.stddev_samp(x).alias(f"d{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 *[(f(c).cast("string") if whole or c not in numeric else F.lit(None).cast("string")).alias(f"{n}{i}")
                   for f, n in ((F.min, "lt"), (F.max, "ht"))]]
        if not exact_distinct:
            aggs += [F.approx_count_distinct(F.col(c)).alias(f"k{i}"),
                     F.percentile_approx(x, list(QUANTILES), 10000).alias(f"q{i}")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(
        F.lit(c).alias("column"), F.col("_n").alias("n"), F.col(f"m{i}").alias("n_missing"),
        F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("total"), F.col(f"d{i}").alias("std"),
        F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"),
        (F.lit(None) if exact_distinct else F.col(f"k{i}")).cast("bigint").alias("n_distinct"),
        F.lit(isinstance(types[c], _INTEGRAL)).alias("integral"),
        *[(F.lit(None).cast("double") if exact_distinct else F.col(f"q{i}")[j]).alias(q)
          for j, q in enumerate(_QNAMES)],
        F.lit(types[c].simpleString()).alias("type"), F.col(f"lt{i}").alias("min_text"),
        F.col(f"ht{i}").alias("max_text"), F.col(f"st{i}").alias("total_text")) for i, c in enumerate(cols)])
    prof = wide.select(F.inline(rows))
    if exact_distinct:
        from churnlab.operators.prep import exact_quantiles
        dc = (value_pairs(df, cols).where(F.col("value").isNotNull()).groupBy("column")
              .agg(F.count_distinct("value").alias("n_distinct")))  # one row per column
        ranked = [c for c in cols if c in numeric]
        if ranked:
            qs = exact_quantiles(df, ranked, list(QUANTILES)).select("column", *[F.col(f"q_{j}").alias(q) for j, q in enumerate(_QNAMES)])
        else:
            qs = prof.select("column", *_QNAMES).limit(0)
        prof = (prof.drop("n_distinct", *_QNAMES).join(dc, "column", "left").join(qs, "column", "left")
                    .withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)).cast("bigint"))
                    .select(*PROFILE_FIELDS))
    return prof


_QNAMES = ("p25", "p50", "p75")
PROFILE_FIELDS = ["column", "n", "n_missing", "mean", "total", "std", "min", "max", "n_distinct", "integral", *_QNAMES,
                  "type", "min_text", "max_text", "total_text"]


def value_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value) of every row: values in text form, whole numbers in decimal
    and fractions in their shortest exact form, so no two values are merged."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]))
    return df.select(pairs.alias("p")).select("p.*")


def category_domains(df: DataFrame, categorical: list[str] | None = None) -> DataFrame:
    """(column, value): the observed values of the declared categorical columns
    (by default those of type string), one row each, whatever their number."""
    cols = categorical if categorical is not None else [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string")
    return value_pairs(df, cols).where(F.col("value").isNotNull()).distinct()


def suggest_constraints(profile: DataFrame, domains: DataFrame | None = None) -> DataFrame:
    """Per column: type, completeness, non-negativity, whether whole numbers, and
    for columns with a category domain the number of its values (the values
    themselves stay rows of ``domains``)."""
    out = profile.select(
        "column", "type",
        F.coalesce(ratio(F.col("n") - F.col("n_missing"), "n"), F.lit(1.0)).alias("completeness"),
        F.coalesce(F.col("min") >= 0, F.lit(True)).alias("non_negative"),
        "integral",
    )
    if domains is not None:
        sizes = domains.groupBy("column").agg(F.count(F.lit(1)).alias("domain_size"))
        out = out.join(sizes, "column", "left")
    return out


def domain_violations(current_rows: DataFrame, domains: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, check='domain', baseline_value=NULL, observed_value=#rows whose
    non-null value lies outside the baseline domain). Rows are counted per
    (column, value) before the anti-join with the domain rows."""
    if cols is None:
        cols = [r["column"] for r in domains.select("column").distinct().collect()]  # column names
    cols = [c for c in current_rows.columns if c in set(cols)]
    if not cols:
        return current_rows.sparkSession.createDataFrame(
            [], "column string, check string, baseline_value double, observed_value double")
    counts = (value_pairs(current_rows, cols).where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("k")))
    outside = counts.join(domains, ["column", "value"], "left_anti").groupBy("column").agg(F.sum("k").alias("k"))
    return outside.select("column", F.lit("domain").alias("check"), F.lit(None).cast("double").alias("baseline_value"),
                          F.col("k").cast("double").alias("observed_value"))


def drift_violations(baseline: DataFrame, current: DataFrame, mean_shift_stds: float = 1.0,
                     domains: DataFrame | None = None, current_rows: DataFrame | None = None,
                     domain_cols: list[str] | None = None) -> DataFrame:
    """One row per violated check: (column, check, baseline_value, observed_value).

    Checks: completeness fell; negative values where the baseline had none;
    mean moved by more than ``mean_shift_stds`` baseline standard deviations;
    column missing from the current data, or of another type there (reported
    without values); with ``domains`` and the current rows, values outside a
    baseline category domain (of ``domain_cols``, the columns that have one). Profiles are one row per
    column, so their join is small and bounded by the column count.
    """
    b = suggest_constraints(baseline).withColumnRenamed("type", "b_type").join(
        baseline.select("column", F.col("mean").alias("b_mean"), F.col("std").alias("b_std")), "column")
    cur = current.select("column", F.col("mean").alias("c_mean"), F.col("min").alias("c_min"),
                         F.coalesce(ratio(F.col("n") - F.col("n_missing"), "n"), F.lit(1.0)).alias("c_compl"),
                         F.col("type").alias("c_type"), F.lit(True).alias("present"))
    j = b.join(F.broadcast(cur), "column", "left")
    checks = F.array(
        F.struct(F.lit("missing_column").alias("check"), F.lit(None).cast("double").alias("baseline_value"),
                 F.lit(None).cast("double").alias("observed_value"), F.col("present").isNull().alias("bad")),
        F.struct(F.lit("type").alias("check"), F.lit(None).cast("double").alias("baseline_value"),
                 F.lit(None).cast("double").alias("observed_value"),
                 F.coalesce(F.col("c_type") != F.col("b_type"), F.lit(False)).alias("bad")),
        F.struct(F.lit("completeness").alias("check"), F.col("completeness").alias("baseline_value"),
                 F.col("c_compl").alias("observed_value"),
                 F.coalesce(F.col("c_compl") < F.col("completeness"), F.lit(False)).alias("bad")),
        F.struct(F.lit("non_negative").alias("check"), F.lit(0.0).alias("baseline_value"),
                 F.col("c_min").alias("observed_value"),
                 F.coalesce(F.col("non_negative") & (F.col("c_min") < 0), F.lit(False)).alias("bad")),
        F.struct(F.lit("mean_shift").alias("check"), F.col("b_mean").alias("baseline_value"),
                 F.col("c_mean").alias("observed_value"),
                 # a baseline of one value has no deviation: any other mean is a shift
                 F.coalesce(F.abs(F.col("c_mean") - F.col("b_mean")) > F.lit(mean_shift_stds) * F.coalesce("b_std", F.lit(0.0)),
                            F.lit(False)).alias("bad")),
    )
    out = j.select("column", F.inline(checks)).where("bad").drop("bad")
    if domains is not None and current_rows is not None:
        out = out.unionByName(domain_violations(current_rows, domains, domain_cols))
    return out


def write_baseline(profile: DataFrame, path: str, version: int, approved: bool) -> None:
    """Store a profile as one version of a baseline table (appended; a version
    is never overwritten)."""
    row = profile.withColumns({"version": F.lit(version), "approved": F.lit(approved)})
    row.write.mode("append").partitionBy("version").parquet(path)


def read_baselines(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def baseline_choices(registry: DataFrame, flags: DataFrame, version: str = "version",
                     approved: str = "approved") -> DataFrame:
    """Apply the baseline truth table to every (skip_check, register_new) row
    of ``flags``: a new baseline gets the next version number; otherwise the
    latest approved version is used. ``n_columns`` and ``n_rows`` describe the
    stored baseline that an existing version names (NULL for a new one)."""
    stored = registry.groupBy(version).agg(F.max(approved).alias("_approved"), F.count(F.lit(1)).alias("n_columns"),
                                           F.max("n").alias("n_rows"))
    latest = stored.where("_approved").select(F.max(version)).scalar()
    nxt = stored.select(F.coalesce(F.max(version), F.lit(0)) + 1).scalar()
    new = F.col("register_new")
    chosen = flags.select(
        "skip_check", "register_new",
        F.when(new, F.lit("new")).otherwise(F.lit("existing")).alias("baseline"),
        F.when(new, nxt).otherwise(latest).alias("version_used"),
        (~F.col("skip_check")).alias("check_runs"))
    described = stored.select(F.col(version).alias("version_used"), F.lit("existing").alias("baseline"), "n_columns", "n_rows")
    return chosen.join(described, ["version_used", "baseline"], "left")
