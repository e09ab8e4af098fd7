"""Look up attributes of a dimension for many rows, whatever the spread of the keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# At most this many keys and their dim rows, a few MB, travel by broadcast. Any other key holds
# less than 1/HOT_KEYS of the rows, since that many keys are at least as frequent.
HOT_KEYS = 10_000


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's own size estimate lets it broadcast this frame."""
    spark = df.sparkSession
    limit = int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return 0 <= int(str(size)) <= limit


def lookup(
    rows: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    spread_by: list[str],
    how: str = "left",
    keys_from: DataFrame | None = None,
    hot_keys: int = HOT_KEYS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``rows`` joined to ``dim``, which has at most one row per key.

    ``on`` maps row columns to dim columns; the result has the row columns and the remaining
    dim columns. If the dimension is small, Catalyst broadcasts it and there is no shuffle.
    Otherwise the ``hot_keys`` most frequent keys and their dim rows, a bounded set, are
    broadcast, and only the other rows are matched by a shuffle. Hot rows and rows with a
    NULL key pass through that shuffle under a NULL key, spread evenly by a hash of
    ``spread_by``, a function of the row so that a lost task repeats the same split.

    ``hot`` has the frequent keys, as the row columns of ``on``: at most ``hot_keys`` of them, known
    from a summary (see ``frequent``). Without it they are counted, on ``keys_from``, which may be
    any cheap frame with the same key columns (it defaults to ``rows``). Both steer the split,
    never the result.
    """
    if how not in ("left", "inner"):
        raise ValueError(how)
    attrs = [c for c in dim.columns if c not in on.values()]
    clash = set(attrs) & set(rows.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    keys = {f"_key{i}": (r, d) for i, (r, d) in enumerate(on.items())}
    small = dim.select(
        *[F.col(d).alias(k) for k, (_, d) in keys.items()],
        *attrs,
        F.lit(True).alias("_found"),
    ).dropna(subset=list(keys))

    if fits_broadcast(small):
        joined = rows.withColumns({k: F.col(r) for k, (r, _) in keys.items()}).join(
            small, list(keys), "left"
        )
    else:
        joined = _split_join(rows, small, keys, attrs, spread_by, keys_from, hot_keys, hot)
    if how == "inner":
        joined = joined.where("_found")
    return joined.select(*rows.columns, *attrs)


def _counted(rows, names, hot_keys):
    return rows.groupBy(*names).count().orderBy(F.desc("count"), *names).limit(hot_keys).select(*names)


def _split_join(rows, small, keys, attrs, spread_by, keys_from, hot_keys, hot):
    names = list(keys)
    source = hot if hot is not None else keys_from if keys_from is not None else rows
    source = source.select(*[F.col(r).alias(k) for k, (r, _) in keys.items()]).dropna()
    hot = source.distinct().limit(hot_keys) if hot is not None else _counted(source, names, hot_keys)
    payload = F.struct(*attrs, "_found").alias("_hot_row")
    hot_rows = small.join(F.broadcast(hot), names, "left_semi").select(*names, payload)
    hot_dim = hot.join(F.broadcast(hot_rows), names, "left").withColumn("_hot", F.lit(True))

    marked = rows.withColumns({k: F.col(r) for k, (r, _) in keys.items()}).join(
        F.broadcast(hot_dim), names, "left"
    )
    aside = F.col("_hot").isNotNull()
    for k in names:
        aside = aside | F.col(k).isNull()
    # Slot 0 for every row that can match. pmod(.., 1) is 0 too, but not a constant Catalyst
    # would fold out of the join key.
    marked = marked.withColumn(
        "_slot", F.when(aside, F.xxhash64(*spread_by)).otherwise(F.lit(0))
    ).withColumns({k: F.when(~aside, F.col(k)) for k in names})
    cold = small.select(
        *names,
        F.pmod(F.xxhash64(*names), F.lit(1)).alias("_slot"),
        F.struct(*attrs, "_found").alias("_cold_row"),
    )
    joined = marked.join(cold, [*names, "_slot"], "left")
    row = F.coalesce(F.col("_hot_row"), F.col("_cold_row"))
    return joined.select(
        *rows.columns, *[row[a].alias(a) for a in attrs], row["_found"].alias("_found")
    )
