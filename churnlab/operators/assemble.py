"""Assemble the per-user frame and tame its categories.

Rare-category bucketing keeps a value only when its share of ALL rows is at
least ``min_share``. The set of kept values therefore has at most
``1/min_share`` members per column (200 at 0.5%), a bound that does not grow
with the data: that set is fitted with ONE aggregate over all bucketed columns
and applied as a projection (no join, no second pass per column). The
unbounded rare set is never collected or inlined.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.operators.members import age_capped, tenure_years
from churnlab.session import cut_lineage
from churnlab.schemas import LOG1P_COLUMNS, RARE_COLUMNS

# Rare-category share threshold and bucket label.
RARE_SHARE = 0.005
OTHER = "other"


def assert_unique_key(df: DataFrame, key: str) -> None:
    """Distributed uniqueness check (one aggregate; only a count returns)."""
    dup = df.groupBy(key).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"key {key!r} is not unique")


def unique_by(df: DataFrame, key: str) -> DataFrame:
    """``df`` with the check in its plan that no key occurs twice: a repeated key raises
    when the rows are computed, instead of doubling a user in a join. The rows are
    exchanged by the key, as the join that follows needs them."""
    others = [c for c in df.columns if c != key]
    rows = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*others)).alias("_row"))
    fault = F.raise_error(F.concat(F.lit(f"key {key!r} is not unique: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL"))))
    own = F.when(F.col("_n") > 1, fault.cast(df.schema[key].dataType)).otherwise(F.col(key))
    return rows.select(own.alias(key), "_row.*").select(df.columns)


def features_joined(train: DataFrame, txn: DataFrame, members: DataFrame, log_feats: DataFrame) -> DataFrame:
    """labels LEFT JOIN transactions LEFT JOIN members LEFT JOIN logs on msno.

    Every side is one row per user and all joins share the key, so each side is
    exchanged once and the chain reuses that partitioning; outer joins are not
    reordered. A hot user is still one row per side here.
    """
    return (train.join(txn, on="msno", how="left")
                 .join(unique_by(members, "msno"), on="msno", how="left")
                 .join(log_feats, on="msno", how="left"))


def category_counts(df: DataFrame, cols: list[str] = RARE_COLUMNS, total: int | None = None) -> DataFrame:
    """(feature, value, n, share) for several columns in ONE aggregate.

    ``n`` counts non-null values, so the NULL group has n = 0 and is always
    rare; ``share`` is over all rows. Their number is ``total`` where the caller has
    it (of a written table it stands in the files' footers), else the sum of one column's
    row counts (written out, so that the input is read once).
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols
    ]))
    counted = df.select(pairs.alias("p")).select("p.*").groupBy("feature", "value").agg(F.count("value").alias("n"), F.count(F.lit(1)).alias("_rows"))
    if total is None:
        counted = cut_lineage(counted, "category_counts")
        of_rows = counted.where(F.col("feature") == cols[0]).select(F.sum("_rows")).scalar()
    else:
        of_rows = F.lit(total)
    return counted.select("feature", "value", "n", (F.col("n") / of_rows).alias("share"))


def rare_categories(df: DataFrame, cols: list[str] = RARE_COLUMNS, min_share: float = RARE_SHARE) -> DataFrame:
    return category_counts(df, cols).where(F.col("share") < min_share)


def frequent_values(df: DataFrame, cols: list[str] = RARE_COLUMNS,
                    min_share: float = RARE_SHARE, total: int | None = None) -> dict[str, list[str]]:
    """Values kept per column: at most ``1/min_share`` each, by arithmetic."""
    if not 0 < min_share <= 1:
        raise ValueError("min_share must be in (0, 1]")
    rows = category_counts(df, cols, total).where(F.col("share") >= min_share).select("feature", "value").collect()
    kept = {c: [] for c in cols}
    for r in rows:
        kept[r["feature"]].append(r["value"])
    return kept


def apply_buckets(df: DataFrame, kept: dict[str, list[str]]) -> DataFrame:
    """Each listed column becomes a string; values outside ``kept`` (and NULL) become 'other'."""
    exprs = {}
    for c, values in kept.items():
        s = F.col(c).cast("string")
        hit = s.isin(sorted(values)) if values else F.lit(False)
        exprs[c] = F.when(hit, s).otherwise(F.lit(OTHER))
    return df.withColumns(exprs)


def rare_bucketed(df: DataFrame, cols: list[str] = RARE_COLUMNS, min_share: float = RARE_SHARE) -> DataFrame:
    """The fit and the output both read the frame, so it is written out once; its
    number of rows then comes from the files' footers."""
    df = cut_lineage(df, "bucketed")
    return apply_buckets(df, frequent_values(df, cols, min_share, df.count()))


def log1p_features(df: DataFrame, cols: list[str] = LOG1P_COLUMNS) -> DataFrame:
    return df.withColumns({c: F.log1p(F.col(c)) for c in cols})


def features_clean(joined: DataFrame, as_of: _dt.date, min_share: float = RARE_SHARE) -> DataFrame:
    """Age cap, tenure, rare buckets and log1p, in the reference order.

    The per-user frame feeds the bucket fit and the output; ``rare_bucketed``
    writes it out once, so the joins are not computed twice.
    """
    return log1p_features(rare_bucketed(tenure_years(age_capped(joined), as_of), RARE_COLUMNS, min_share))
