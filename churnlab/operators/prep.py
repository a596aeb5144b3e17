"""Split, impute, encode, tame outliers, scale, rebalance.

Fitted state is either an MLlib model (Imputer, StringIndexer) or a small dict
of per-column statistics computed by ONE Spark aggregate; only those few
numbers reach the driver, never rows.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Imputer, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.functions import hash_bucket
from churnlab.functions.hashing import MODULO
from churnlab.functions.running import running_totals
from churnlab.functions.selection import kth_smallest, quantile_values
from churnlab.session import cut_lineage

OTHER = "other"


def present(c: str) -> Column:
    """The column as double, NaN as NULL: both are missing values here, as in pandas."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


# ---------------------------------------------------------------- F10 split
def split_assign(df: DataFrame, weights=(0.7, 0.2, 0.1), names=("train", "test", "validation"),
                 seed: int = 200, key: str = "msno", out: str = "split") -> DataFrame:
    """Deterministic split on a key hash: the same key lands in the same split
    whatever the partitioning or row order (unlike ``randomSplit``)."""
    if len(weights) != len(names):
        raise ValueError("weights and names differ in length")
    total = float(sum(weights))
    bucket = hash_bucket(key, seed, MODULO)
    edges, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        edges.append(int(round(acc * MODULO)))
    expr = None
    for edge, name in zip(edges, names[:-1]):
        expr = F.when(bucket < edge, F.lit(name)) if expr is None else expr.when(bucket < edge, F.lit(name))
    expr = F.lit(names[-1]) if expr is None else expr.otherwise(F.lit(names[-1]))
    return df.withColumn(out, expr)


def key_hash(key: str, seed: int) -> Column:
    """60 bits of md5(key|seed)."""
    return F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))), 1, 15), 16, 10).cast("long")


def split_exact(df: DataFrame, stages: list[tuple[float, str, int]], rest: str, key: str = "msno", out: str = "split") -> DataFrame:
    """Splits of exact sizes. A stage (share, name, seed) takes ``ceil(share * n)`` of the
    ``n`` rows that the stages before it left, those with the smallest key hashes under its
    seed; what is left in the end is ``rest``. Sizes are exact for unique keys; rows that
    share a key stay together. The same rows whatever the partitioning, without a sort:
    a threshold is found by ``kth_smallest``, in a few passes over the keys."""
    keys, name = cut_lineage(df.select(key), "split_keys"), F.lit(None).cast("string")
    left, n = keys, keys.count()
    for share, stage, seed in stages:
        take = math.ceil(share * n - 1e-9)
        if not take:
            continue
        edge = kth_smallest(left, key_hash(key, seed), [take])[0]
        name = F.coalesce(name, F.when(key_hash(key, seed) <= edge, F.lit(stage)))
        left = left.where(key_hash(key, seed) > edge)
        n = left.count()
    return df.withColumn(out, F.coalesce(name, F.lit(rest)))


# ----------------------------------------------------------- F11/F12 impute
def fit_mean_imputer(train: DataFrame, cols: list[str]):
    """MLlib Imputer (mean): fit on the training rows, one aggregate."""
    casted = train.withColumns({c: F.col(c).cast("double") for c in cols})
    return Imputer(strategy="mean", inputCols=cols, outputCols=cols).fit(casted)


def impute_mean(df: DataFrame, model, cols: list[str]) -> DataFrame:
    return model.transform(df.withColumns({c: F.col(c).cast("double") for c in cols}))


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation between order statistics
    (rank h = (n-1)p + 1), all columns at once: (column, q_<i> for each p in
    ``probs``). The median is p = 0.5 (mean of the two middle values for even n).

    The columns are written once and ranges around the wanted ranks narrowed by
    counting (``quantile_values``), so the shuffle does not grow with the number of
    distinct values. Meant for a few ``probs``; for many of them see ``quantile_grid``.
    """
    rows = cut_lineage(df.select(*[present(c).alias(f"c{i}") for i, c in enumerate(cols)]), "quantile_columns")
    pairs = rows.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("v")) for i, c in enumerate(cols)])))
    schema = ", ".join(["column string", *[f"q_{i} double" for i in range(len(probs))]])
    return df.sparkSession.createDataFrame([(c, *q) for c, (_, q) in quantile_values(pairs, probs).items()], schema)


def quantile_grid(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """The same as ``exact_quantiles`` for any number of ``probs``: values are counted per
    (column, distinct value) with map-side combine, then a running count along the value order
    (sliced by range partitions, see ``running_totals``) finds all ranks."""
    return quantiles_from_counts(long_value_counts(df, cols), probs)


def long_value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, v, k): rows per distinct non-null value of each column, one
    aggregate with map-side combine."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), present(c).alias("v")) for c in cols]))
    return (df.select(pairs.alias("p")).select("p.*").where(F.col("v").isNotNull())
              .groupBy("column", "v").agg(F.count(F.lit(1)).alias("k")))


def quantiles_from_counts(counts: DataFrame, probs: list[float]) -> DataFrame:
    ranked = running_totals(counts, "v", ["k"], group="column")
    sizes = counts.groupBy("column").agg(F.sum("k").alias("n"))  # one row per column
    ranked = ranked.join(F.broadcast(sizes), "column")
    n, cum, k = F.col("n"), F.col("cum_k"), F.col("k")
    covers = lambda r: (r > cum - k) & (r <= cum)
    aggs = [F.first("n").alias("n")]
    for i, p in enumerate(probs):
        h = (n - 1) * F.lit(float(p)) + 1
        aggs += [F.max(F.when(covers(F.floor(h)), F.col("v"))).alias(f"_lo{i}"),
                 F.max(F.when(covers(F.ceil(h)), F.col("v"))).alias(f"_hi{i}")]
    per = ranked.groupBy("column").agg(*aggs)
    out = []
    for i, p in enumerate(probs):
        h = (F.col("n") - 1) * F.lit(float(p)) + 1
        frac = h - F.floor(h)
        out.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * frac).alias(f"q_{i}"))
    return per.select("column", *out)


def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Exact medians; one or two numbers per column return to the driver."""
    got = {r["column"]: r["q_0"] for r in exact_quantiles(df, cols, [0.5]).collect()}
    return {c: got.get(c) for c in cols}


def fit_median_imputer(train: DataFrame, cols: list[str]) -> dict[str, float | None]:
    return exact_medians(train, cols)


def impute_with(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(present(c), F.lit(v).cast("double")) for c, v in values.items()})


# ---------------------------------------------------- F13/F14 string index
def fill_other(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(OTHER)) for c in cols})


def fit_string_indexer(train: DataFrame, cols: list[str], max_levels: int = 100_000):
    """One multi-column indexer: frequency descending, ties alphabetical;
    unseen labels get the extra index ``numLabels``. The vocabularies come to the
    driver, so their sizes are checked first (by a sketch): a column with more
    than ``max_levels`` is refused, never truncated; ``fit_dictionary`` has no such limit."""
    sizes = train.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first().asDict()
    too_many = sorted(c for c, n in sizes.items() if n > max_levels)
    if too_many:
        raise ValueError(f"columns with more than {max_levels} levels: {too_many}")
    outs = [f"{c}__idx" for c in cols]
    return StringIndexer(inputCols=cols, outputCols=outs, handleInvalid="keep",
                         stringOrderType="frequencyDesc").fit(fill_other(train, cols))


def fit_dictionary(train: DataFrame, cols: list[str]) -> DataFrame:
    """(column, level, n, index) written out: the vocabularies of ``fit_string_indexer``
    (frequency descending, ties alphabetical, missing values as ``OTHER``) for columns of any
    number of levels. Levels are counted with map-side combine and ranked by running counts
    over range slices; nothing comes to the driver."""
    levels = (fill_other(train.select(*cols), cols)
              .select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in cols])).alias("p"))
              .select("p.*").groupBy("column", "level").agg(F.count(F.lit(1)).alias("n")))
    order = levels.withColumns({"order": F.struct((-F.col("n")).alias("n"), F.col("level").alias("level")), "one": F.lit(1)})
    ranked = running_totals(order, "order", ["one"], group="column")
    return cut_lineage(ranked.select("column", "level", "n", (F.col("cum_one") - 1).alias("index")), "dictionary")


def dictionary_index(df: DataFrame, dictionary: DataFrame, cols: list[str], small: int = 100_000) -> DataFrame:
    """``cols`` as their indices in ``dictionary``; unseen levels get the extra index, the
    number of levels. A column with at most ``small`` levels (counted) is looked up in a
    broadcast; a larger one by a join on the level, where a written dictionary on its own
    side lets Spark split the partitions of hot levels by their measured size."""
    sizes = {r["column"]: r["k"] for r in dictionary.groupBy("column").agg(F.count(F.lit(1)).alias("k")).collect()}
    out = fill_other(df, cols)
    for c in cols:
        own = dictionary.where(F.col("column") == c).select(F.col("level").alias(c), F.col("index").alias("_index"))
        if sizes.get(c, 0) <= small:
            own = F.broadcast(own)
        out = out.join(own, c, "left").withColumn(c, F.coalesce("_index", F.lit(sizes.get(c, 0))).cast("double")).drop("_index")
    return out.select(*df.columns)


def string_index(df: DataFrame, model, cols: list[str]) -> DataFrame:
    out = model.transform(fill_other(df, cols))
    return out.withColumns({c: F.col(f"{c}__idx") for c in cols}).drop(*[f"{c}__idx" for c in cols])


# ------------------------------------------------------ F15/F16 one-hot
def category_levels(df: DataFrame, cols: list[str], max_levels: int = 1000) -> dict[str, list[str]]:
    """Distinct levels per column. (column, level) pairs are de-duplicated on
    the cluster; only after the per-column counts are checked against
    ``max_levels`` (raising, never truncating) do the levels, at most
    ``len(cols) * max_levels`` values, come to the driver."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("f"), F.col(c).cast("string").alias("v")) for c in cols]))
    levels = df.select(pairs.alias("p")).select("p.*").where(F.col("v").isNotNull()).distinct()
    counts = {r["f"]: r["n"] for r in levels.groupBy("f").agg(F.count(F.lit(1)).alias("n")).collect()}
    too_many = sorted(c for c, n in counts.items() if n > max_levels)
    if too_many:
        raise ValueError(f"columns with more than {max_levels} levels: {too_many}")
    got: dict[str, list[str]] = {c: [] for c in cols}
    for r in levels.collect():
        got[r["f"]].append(r["v"])
    return {c: sorted(v) for c, v in got.items()}


def one_hot_long(df: DataFrame, cols: list[str], key: str = "msno") -> DataFrame:
    """The ones of a one-hot encoding as rows (key, column, level), for columns of
    any number of levels: no list of levels on the driver, no wide schema."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in cols]))
    return df.select(key, pairs.alias("p")).select(key, "p.*").where(F.col("level").isNotNull())


def one_hot(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """``{col}_{level}`` 0/1 columns for every level (no level dropped)."""
    exprs = {}
    for c, lv in levels.items():
        for v in lv:
            exprs[f"{c}_{v}"] = F.when(F.col(c).cast("string") == F.lit(v), 1).otherwise(0)
    return df.withColumns(exprs).drop(*levels.keys())


def undummy(df: DataFrame, prefixes: list[str], levels: dict[str, list[str]] | None = None) -> DataFrame:
    """Inverse of one_hot: ``{prefix}_{level}`` columns -> one ``prefix`` column.

    The level is all that follows the prefix and ``_``, whatever it holds. Where
    one prefix begins another (``a`` and ``a_b``), a column belongs to the
    longest one that fits; ``levels`` (as given to one_hot) settles any other
    doubt. Names are inspected on the driver, values stay on the executors.
    """
    out = df
    for p in prefixes:
        if levels is not None:
            dummies = [f"{p}_{v}" for v in levels[p]]
        else:
            longer = [q + "_" for q in prefixes if q.startswith(p + "_")]
            dummies = [c for c in out.columns if c.startswith(p + "_") and not c.startswith(tuple(longer))]
        if not dummies:
            continue
        level = F.coalesce(*[F.when(F.col(_quoted(d)) == 1, F.lit(d[len(p) + 1:])) for d in dummies])
        keep = [F.col(_quoted(c)) for c in out.columns if c not in set(dummies) and c != p]
        out = out.select(*keep, level.alias(p))
    return out


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# ------------------------------------------------------------ F17 outliers
def fit_outlier_means(train: DataFrame, cols: list[str], z: float = 3.0) -> dict[str, dict]:
    """Per column: mean, sample std, mean of inliers (|z| < z) and the number
    of outliers (|z| > z). Two aggregates in total, whatever the column count."""
    st = train.agg(*[F.avg(present(c)).alias(f"m_{c}") for c in cols],
                   *[F.stddev_samp(present(c)).alias(f"s_{c}") for c in cols]).first()
    aggs = []
    for c in cols:
        m, s = st[f"m_{c}"], st[f"s_{c}"]
        zc = (present(c) - F.lit(m)) / F.lit(s) if s else F.lit(0.0)
        aggs += [F.avg(F.when(F.abs(zc) < z, present(c))).alias(f"in_{c}"),
                 F.count_if(F.abs(zc) > z).alias(f"n_{c}")]
    inl = train.agg(*aggs).first()
    return {c: {"mean": st[f"m_{c}"], "std": st[f"s_{c}"], "inlier_mean": inl[f"in_{c}"],
                "outliers": inl[f"n_{c}"]} for c in cols}


def outliers_to_mean(df: DataFrame, stats: dict[str, dict], z: float = 3.0) -> DataFrame:
    exprs = {}
    for c, s in stats.items():
        if not s["std"]:
            continue
        zc = (present(c) - F.lit(s["mean"])) / F.lit(s["std"])
        exprs[c] = F.when(F.abs(zc) > z, F.lit(s["inlier_mean"])).otherwise(present(c))
    return df.withColumns(exprs)


# ------------------------------------------------------------- F18 scaling
def fit_standardizer(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and POPULATION std per column (sklearn's StandardScaler rule) of the values that are there."""
    r = train.agg(*[F.avg(present(c)).alias(f"m_{c}") for c in cols],
                  *[F.stddev_pop(present(c)).alias(f"s_{c}") for c in cols]).first()
    return {c: (r[f"m_{c}"], r[f"s_{c}"]) for c in cols}


def standardize(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    exprs = {}
    for c, (m, s) in stats.items():
        scale = s if s else 1.0  # constant column: centre only (sklearn rule)
        exprs[c] = (present(c) - F.lit(m)) / F.lit(scale)
    return df.withColumns(exprs)


# ------------------------------------------------------ A12/F19 rebalance
def class_balance(df: DataFrame, label: str = "is_churn") -> DataFrame:
    """One row: majority (label 0) count, minority (label 1) count, and
    ``int(major / minor)`` (NULL when there is no minority row)."""
    c = df.agg(F.count_if(F.col(label) == 0).alias("n_major"), F.count_if(F.col(label) == 1).alias("n_minor"))
    return c.withColumn("ratio", F.floor(F.try_divide(F.col("n_major"), F.col("n_minor"))).cast("int"))


def class_weights(df: DataFrame, label: str = "is_churn", out: str = "weight") -> DataFrame:
    """The weight column that equals oversampling (minority rows count
    ``max(1, int(major/minor))`` times) without repeating a row."""
    ratio = class_balance(df, label).select(F.greatest(F.coalesce("ratio", F.lit(1)), F.lit(1))).scalar()
    return df.withColumn(out, F.when(F.col(label) == 1, ratio).otherwise(F.lit(1)).cast("double"))


def oversample(df: DataFrame, label: str = "is_churn") -> DataFrame:
    """Minority rows repeated ``max(1, int(major/minor))`` times; majority rows
    once. The ratio is a scalar subquery (one aggregate), applied row-wise:
    no collect, no union of copies, no cross join."""
    ratio = class_balance(df, label).select(F.greatest(F.coalesce("ratio", F.lit(1)), F.lit(1))).scalar()
    copies = F.when(F.col(label) == 1, ratio).otherwise(F.lit(1))
    return (df.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))))
              .drop("_copy"))
