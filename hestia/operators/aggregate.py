"""Aggregations.

Every aggregate here is one Spark ``Aggregate`` with a partial (map-side)
phase, so a key that holds a third of all rows is combined inside each
task before the shuffle. Global totals that later rows need (shares,
histogram bounds) are scalar subqueries, not cross joins or global windows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hestia.functions.text import ColumnOrName, _c
from hestia.operators.relational import ratio

DEFAULT_ACCURACY = 10000


def row_count(df: DataFrame) -> DataFrame:
    """A1: one-row table ``n_rows``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None, long: bool = True) -> DataFrame:
    """A2: null count of every column in a single pass.

    ``long=True`` returns ``(column_name, n_null)`` rows via ``unpivot``.
    """
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    if not long:
        return wide
    return wide.unpivot([], cols, "column_name", "n_null")


def group_count(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[ColumnOrName] | None = None) -> DataFrame:
    """A3/A4/A5: rows per group; keys may be expressions (aliased)."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(*order) if order else out


def group_stats(
    df: DataFrame,
    keys: Sequence[ColumnOrName],
    value: ColumnOrName,
    exact: bool = False,
    accuracy: int = DEFAULT_ACCURACY,
    digits: int | None = 4,
) -> DataFrame:
    """Mean, median and count of ``value`` per group.

    ``exact=False`` uses ``percentile_approx`` (bounded sketch per group);
    ``exact=True`` selects the exact median within the narrow range that the
    sketch leaves open (see ``exact_quantiles``).
    """
    v = _c(value)
    if exact:
        names = [k if isinstance(k, str) else f"__k{i}" for i, k in enumerate(keys)]
        rows = df.select(*[_c(k).alias(n) for k, n in zip(keys, names)], v.alias("__v"))
        q = exact_quantiles(rows, names, "__v", [0.5], accuracy)
        g = rows.groupBy(*names).agg(F.avg("__v").alias("moyenne"), F.count(F.lit(1)).alias("nb_obs"))
        j = _join_on(g, q, names, "left").select(*names, "moyenne", F.col("values")[0].alias("mediane"), "nb_obs")
        return j if digits is None else j.withColumns({c: F.round(c, digits) for c in ("moyenne", "mediane")})
    med = F.percentile_approx(v, 0.5, accuracy)
    mean = F.avg(v)
    if digits is not None:
        mean = F.round(mean, digits)
        med = F.round(med.cast("double"), digits)
    return df.groupBy(*keys).agg(
        mean.alias("moyenne"), med.alias("mediane"), F.count(F.lit(1)).alias("nb_obs")
    )


def center(df: DataFrame, col: ColumnOrName, digits: int | None = 2) -> DataFrame:
    """Global median (exact) and mean."""
    # Both read the same rows, so that Spark can use their shuffle for both.
    rows = df.select(_c(col).alias("__v")).filter(F.col("__v").isNotNull())
    median = exact_quantiles(rows, [], "__v", [0.5]).select("values").scalar()
    out = rows.agg(F.avg("__v").alias("mean")).select(median[0].alias("median"), "mean")
    return out if digits is None else out.select(*[F.round(c, digits).alias(c) for c in ("median", "mean")])


def _join_on(a: DataFrame, b: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Join on key columns that may be null; the keys of ``a`` stay."""
    b = b.withColumnsRenamed({n: f"__of_{n}" for n in names})
    return a.join(b, [F.col(n).eqNullSafe(F.col(f"__of_{n}")) for n in names], how)


#: Slots that the values between two bounds are dealt to.
SLOTS = 65_536
#: Tasks that the values of one group are dealt to at most, where they meet its bounds.
SHARES = 64


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Exact interpolated quantiles per group: ``(keys…, values)``, an array in the order of ``probs``.

    A sketch (``percentile_approx``: rank error at most n / accuracy) gives a
    low and a high bound around each quantile. One pass counts the values
    below the low bounds; the values between the bounds, at most some
    thousandths of the rows, are counted per distinct value (in a group of at most
    ``accuracy`` rows, where a rank is finer than the sketch's error, all
    values are). These are dealt to ``SLOTS`` slots of equal width between the
    bounds; running counts of the slots tell which one or two hold the ranks
    wanted, and only the values of these are put in order. A task so orders the
    slots, or the distinct values of one slot. Rows are counted per value before
    they meet their group's bounds, and the values of a group are dealt to
    ``SHARES`` tasks for that. Nulls are left out; a group without values
    has no row.
    """
    from pyspark.sql import Window

    names = list(keys)
    rows = df.select(*names, F.col(value).cast("double").alias("__x")).filter(F.col("__x").isNotNull())
    slack = 4.0 / accuracy
    around = [min(1.0, max(0.0, p + d)) for p in probs for d in (-slack, slack)]
    found = F.percentile_approx("__x", around, accuracy)
    bounds = F.transform(
        F.sequence(F.lit(0), F.lit(len(probs) - 1)),
        lambda i: F.struct(i.alias("i"), F.get(F.col("__b"), 2 * i).alias("lo"), F.get(F.col("__b"), 2 * i + 1).alias("hi")),
    )
    per_group = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"), found.alias("__b")).select(*names, "__n", bounds.alias("__r"))
    if names:
        values = rows.groupBy(*names, "__x").agg(F.count(F.lit(1)).alias("__c"))
        values = values.withColumn("__share", F.pmod(F.xxhash64("__x"), F.lit(SHARES)).cast("int"))
        bounds_of = per_group.withColumn("__share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
        near = _join_on(values, bounds_of, [*names, "__share"], "inner").select(*names, "__x", "__c", "__n", F.explode("__r").alias("r"))
    else:
        one = per_group.select(F.struct("__n", "__r").alias("s")).scalar()
        near = rows.select("__x", F.lit(1).alias("__c"), one["__n"].alias("__n"), F.explode(one["__r"]).alias("r"))
    # All values below become one entry, and all above: of those, only the least can be wanted.
    side = F.when(F.col("__n") <= accuracy, 1).when(F.col("__x") < F.col("r.lo"), 0).when(F.col("__x") <= F.col("r.hi"), 1).otherwise(2)
    inside = F.when(side == 1, F.col("__x"))
    group = [*names, "__n", "i"]
    counts = near.groupBy(*names, "__n", F.col("r.i").alias("i"), F.col("r.lo").alias("__lo"), F.col("r.hi").alias("__hi"), side.alias("__side"), inside.alias("__in")).agg(
        F.sum("__c").alias("c"), F.min("__x").alias("__at")
    )
    part = F.try_divide(F.col("__at") - F.col("__lo"), F.col("__hi") - F.col("__lo")) * SLOTS
    slot = F.when(part.isNull() | F.isnan(part), SLOTS - 1).otherwise(F.greatest(F.lit(0), F.least(F.lit(SLOTS - 1), F.floor(part))))
    counts = counts.select(*group, "c", "__at", F.when(F.col("__side") == 1, slot).when(F.col("__side") == 0, -1).otherwise(SLOTS).cast("int").alias("slot"))
    p = F.get(F.array(*[F.lit(float(x)) for x in probs]), F.col("i"))
    place = p * (F.col("__n") - 1)
    slots = counts.groupBy(*group, "slot").agg(F.sum("c").alias("c"))
    slots = slots.withColumn("to", F.sum("c").over(Window.partitionBy(*group).orderBy("slot"))).withColumn("before", F.col("to") - F.col("c"))
    wanted = slots.filter((F.col("to") > F.floor(place)) & (F.col("before") <= F.ceil(place))).select(*group, "slot", "before")
    held = _join_on(counts, wanted, [*group, "slot"], "inner")
    running = held.withColumn("to", F.col("before") + F.sum("c").over(Window.partitionBy(*group, "slot").orderBy("__at")))
    ranked = running.withColumns({"__place": place, "__low": F.floor(place), "__high": F.ceil(place)})
    first = lambda rank: F.min(F.when(F.col("to") > F.col(rank), F.col("__at")))
    each = ranked.groupBy(*names, "i").agg(first("__low").alias("a"), first("__high").alias("b"), F.max(F.col("__place") - F.col("__low")).alias("f"))
    exact = F.when(F.col("f") == 0, F.col("a")).otherwise((1 - F.col("f")) * F.col("a") + F.col("f") * F.col("b"))
    out = each.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("i", exact.alias("v")))).alias("q"))  # one entry for each of ``probs``
    return out.select(*names, F.transform("q", lambda x: x["v"]).alias("values"))


def group_mean(df: DataFrame, key: str, value: ColumnOrName, name: str = "mean", digits: int = 4) -> DataFrame:
    """Mean per key, null keys dropped (pandas ``groupby`` semantics)."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.round(F.avg(_c(value)), digits).alias(name))
    )


def top_ratio_mean(
    df: DataFrame, key: str, num: ColumnOrName, den: ColumnOrName, k: int = 10, name: str = "mean_ratio"
) -> DataFrame:
    """Mean of a per-row ratio per key, top ``k`` (ties by key)."""
    g = group_mean(df.withColumn("__r", ratio(num, den)), key, "__r", name)
    return g.filter(F.col(name).isNotNull()).orderBy(F.desc(name), F.asc(key)).limit(k)


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    exact: bool = False,
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """A10: several quantiles of several columns, long form
    ``(column_name, prob, value)``: approximate ones in one aggregate, exact
    ones with one ``exact_quantiles`` over (column, value) rows."""
    if exact:
        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("__v")) for c in cols])).alias("r")).select("r.*")
        at = F.array(*[F.lit(float(p)) for p in probs])
        q = exact_quantiles(long, ["column_name"], "__v", probs, accuracy)
        return q.select("column_name", F.inline(F.arrays_zip(at.alias("prob"), F.col("values").alias("value"))))
    aggs = []
    names = []
    for c in cols:
        for i, p in enumerate(probs):
            n = f"{c}__{i}"
            names.append((n, c, p))
            q = F.percentile_approx(c, p, accuracy)
            aggs.append(q.cast("double").alias(n))
    wide = df.agg(*aggs)
    parts = [
        F.struct(F.lit(c).alias("column_name"), F.lit(float(p)).alias("prob"), F.col(n).alias("value"))
        for n, c, p in names
    ]
    return wide.select(F.explode(F.array(*parts)).alias("q")).select("q.*")


def describe_table(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """Count, mean, stddev, min, max per column, typed, long form."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"{c}__count"),
            F.round(F.avg(x), digits).alias(f"{c}__mean"),
            F.round(F.stddev_samp(x), digits).alias(f"{c}__stddev"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    wide = df.agg(*aggs)
    parts = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"{c}__count").alias("count"),
            F.col(f"{c}__mean").alias("mean"),
            F.col(f"{c}__stddev").alias("stddev"),
            F.col(f"{c}__min").alias("min"),
            F.col(f"{c}__max").alias("max"),
        )
        for c in cols
    ]
    return wide.select(F.explode(F.array(*parts)).alias("d")).select("d.*")


def row_hash(df: DataFrame, cols: Sequence[str]) -> Column:
    """A 256-bit hash of the columns of a row: equal where ``groupBy`` takes rows for equal (nulls alike, 0.0 and -0.0 alike)."""
    plus = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    each = [(F.col(c) + F.lit(0.0)).alias(c) if c in plus else F.col(c) for c in cols]
    return F.unhex(F.sha2(F.to_json(F.struct(*each)), 256))


def duplicate_totals(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Total rows, distinct rows and duplicates, in one aggregation over
    row hashes: what is shuffled doesn't depend on how long the rows are."""
    cols = list(cols or df.columns)
    g = df.groupBy(row_hash(df, cols).alias("__h")).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg(
        F.sum("__n").cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).withColumn("duplicates", F.col("total_rows") - F.col("distinct_rows"))


def duplicate_groups(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every value group that occurs more than once, with its count, the
    most frequent first.

    One aggregate over the rows: each is read and shuffled once, repeats within
    a task as one.
    """
    cols = list(cols)
    often = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)
    return often.orderBy(F.desc("count"), *cols)


def share(df: DataFrame, key: str, digits: int = 6) -> DataFrame:
    """Rows per key and their share of all rows. Counts per key are a
    partial aggregate; the total is a scalar subquery of its own, so no task
    sees all keys."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("share", F.round(F.col("count") / total, digits))


def histogram(df: DataFrame, col: ColumnOrName, bins: int, digits: int = 4) -> DataFrame:
    """Equal-width histogram over [min, max], last bin closed.

    Returns the non-empty bins ``(bin, bin_lo, bin_hi, count)``. Bounds are
    scalar subqueries; binning is arithmetic, counting is a partial agg.
    """
    c = _c(col).cast("double")
    vals = df.select(c.alias("__x")).filter(F.col("__x").isNotNull())
    # One scalar subquery (one scan) for both bounds.
    bounds = vals.agg(F.struct(F.min("__x").alias("lo"), F.max("__x").alias("hi")).alias("b")).scalar()
    lo = bounds.getField("lo")
    hi = bounds.getField("hi")
    width = (hi - lo) / F.lit(bins)
    idx = F.least(
        F.coalesce(F.floor(F.try_divide(F.col("__x") - lo, width)), F.lit(0)),
        F.lit(bins - 1),
    ).cast("int")
    return (
        vals.withColumn("bin", idx)
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            "bin",
            F.round(lo + F.col("bin") * width, digits).alias("bin_lo"),
            F.round(lo + (F.col("bin") + 1) * width, digits).alias("bin_hi"),
            "count",
        )
    )


#: Rows that one list holds at most, about.
LIST_ROWS = 100_000


def _with_size(df: DataFrame, key: str, most: int) -> tuple[DataFrame, int]:
    """``df`` with ``__n``, the rows of its key where these are more than
    ``most`` (else 1), and the largest of these numbers.

    Sizes are a partial aggregate; only keys above the bound (at most rows /
    ``most`` of them) are joined back."""
    heavy = df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > most)
    largest = heavy.agg(F.max("__n")).first()[0] or 1
    sized = df.join(heavy, F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
    return sized.withColumn("__n", F.coalesce("__n", F.lit(1))), largest


def group_by_key(df: DataFrame, key: str, value: str, id_cols: Sequence[str], chunks: int | None = None, most: int = LIST_ROWS) -> DataFrame:
    """Values of each key gathered into lists, ``(key, chunk, values)``,
    values sorted.

    A key of more than ``most`` rows is dealt, by a hash of the row id columns
    and the value, to as many lists as keep each at about half of that;
    smaller keys have one list. ``chunks`` sets the number for all keys
    instead. ``values_of`` gives long rows without any list.
    """
    columns = dict.fromkeys([key, value, *id_cols])
    spread = F.xxhash64(*[F.col(c) for c in id_cols], F.col(value))
    if chunks is None:
        rows, _ = _with_size(df.select(*columns), key, most)
        dealt = F.pmod(spread, F.when(F.col("__n") > most, F.ceil(F.col("__n") * 2 / most)).otherwise(1))
    else:
        rows, dealt = df, F.pmod(spread, F.lit(chunks))
    return rows.groupBy(key, dealt.cast("int").alias("chunk")).agg(F.array_sort(F.collect_list(value)).alias("values"))


def values_of(df: DataFrame, key: str, value: str) -> DataFrame:
    """A16 without lists: ``(key, value)`` rows, sorted by both."""
    return df.select(key, F.col(value).alias("value")).orderBy(key, "value")


# Named folds with a partial (combinable) phase.
FOLDS = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "mean": F.avg,
    "product": F.product,
    "any": F.bool_or,
    "all": F.bool_and,
}


def reduce_by_key(
    df: DataFrame,
    key: str,
    value: ColumnOrName,
    op: str | None = "sum",
    name: str = "value",
    zero: Column | None = None,
    merge: Callable[[Column, Column], Column] | None = None,
    most: int = LIST_ROWS,
) -> DataFrame:
    """Fold the values of each key, with a named operation or with any
    associative and commutative ``merge(a, b)`` and its neutral ``zero``.

    A general fold runs in steps, so that no list holds more than about
    ``most`` values: the values of a larger key are dealt to lists of about
    half of that and folded, and so are the results, until one list takes them.
    """
    if merge is not None:
        if zero is None:
            raise ValueError("a fold with merge needs its zero")
        spread = F.xxhash64(_c(value), F.monotonically_increasing_id())
        rows, largest = _with_size(df.select(key, _c(value).alias("__v"), spread.alias("__s")), key, most)
        fold_all = F.aggregate(F.collect_list("__v"), zero, merge)
        while largest > most:
            lists = F.when(F.col("__n") > most, F.ceil(F.col("__n") * 2 / most)).otherwise(1)
            dealt = rows.select(key, "__v", lists.alias("__n"), F.pmod("__s", lists).alias("__s"))
            rows = dealt.groupBy(key, "__n", "__s").agg(fold_all.alias("__v")).withColumn("__s", F.xxhash64("__s"))
            largest = math.ceil(largest * 2 / most)
        return rows.groupBy(key).agg(fold_all.alias(name))
    try:
        fold = FOLDS[op]
    except KeyError as e:
        raise ValueError(f"unknown fold {op!r}; use one of {sorted(FOLDS)}, or merge and zero") from e
    return df.groupBy(key).agg(fold(_c(value)).alias(name))


def group_value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Count per (keys, value), the input of a per-group mode."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("count"))


def mode_per_group(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent value per group, ties to the smallest value, for
    values of any type that can be ordered.

    A minimum over the already-aggregated (keys, value) counts: one more
    partial aggregate, no window, no list.
    """
    vc = group_value_counts(df, keys, value)
    # Order: higher count first, then smaller value.
    best = F.min(F.struct((-F.col("count")).alias("less"), F.col(value).alias("value")))
    return vc.groupBy(*keys).agg(best.alias("__m")).select(*keys, F.col("__m.value").alias(value), (-F.col("__m.less")).alias("count"))
