"""First-occurrence-wins deduplication, ledgers and limits.

D1-D5, J3, J4, SNK4 (ledger side), L1-L3, O1, U1.

Dedup is ``groupBy(key).agg(min(struct(order..., payload...)))`` rather
than a window: the aggregate runs map-side first (partial min), so a key
holding a third of all rows is collapsed to one row per map task before
the shuffle, and no task ever holds a whole hot group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def first_wins(df: DataFrame, key, order: Sequence[str]) -> DataFrame:
    """Keep, per ``key``, the row smallest by ``order`` (the source order:
    e.g. source priority, page, position).  ``order`` must make rows of a
    key distinct for a deterministic result.  Output keeps ``df``'s columns."""
    keys = _cols(key)
    order = list(order)
    payload = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                      *[F.col(c).alias(f"p{i}") for i, c in enumerate(payload)])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("__w"))
    sel = [F.col(k) for k in keys]
    sel += [F.col(f"__w.o{i}").alias(c) for i, c in enumerate(order)]
    sel += [F.col(f"__w.p{i}").alias(c) for i, c in enumerate(payload)]
    return agg.select(*sel).select(*df.columns)


def union_sources(*sources: DataFrame) -> DataFrame:
    """Bag union by column name; each input carries its own
    ``source_priority`` so the first-wins order survives the union."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def new_only(frontier: DataFrame, ledger: DataFrame, on) -> DataFrame:
    """Frontier rows whose key is not in the ledger (left anti join).

    Both sides are large in general, so no broadcast hint: Catalyst/AQE
    broadcast the ledger only when its measured size is under the
    threshold, else shuffle both on the key."""
    keys = _cols(on)
    led = ledger.select(*keys).where(F.coalesce(*[F.col(k).isNotNull() for k in keys]))
    return frontier.join(led, on=keys, how="left_anti")


def ledger_additions(candidates: DataFrame, ledger: DataFrame, key: str,
                     extra: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """SNK4 insert-if-absent: the new keys to append to a ledger, each with
    the ``extra`` columns of one of its rows: the first by ``order``, then by
    the columns themselves."""
    cols = [key, *extra]
    fresh = candidates.where(F.col(key).isNotNull())
    if extra:
        by = [*order, *[c for c in extra if c not in order]]
        fresh = first_wins(fresh.select(key, *by), key, by).select(*cols)
    else:
        fresh = fresh.select(key).distinct()
    return new_only(fresh, ledger, key)


def priority_fill(df: DataFrame, key, order: Sequence[str], limit: int) -> DataFrame:
    """L1 + L3: dedup across prioritised sources (first wins), then the
    first ``limit`` rows in source order (TakeOrderedAndProject)."""
    deduped = first_wins(df, key, order)
    return deduped.orderBy(*[F.col(c).asc() for c in order]).limit(int(limit))


def staged_fill(sources: Sequence[Callable[[], DataFrame]], key, order: Sequence[str], limit: int) -> DataFrame:
    """L1 + L3 in stages: like ``priority_fill`` over all ``sources`` in
    their order, but a source is built and read only if those before it give
    fewer than ``limit`` distinct keys.

    ``order`` must begin with the source's priority.  What a stage keeps is
    written once, so no source is read twice."""
    from feedloom.sources.io import written
    kept: DataFrame | None = None
    for i, source in enumerate(sources):
        rows = first_wins(source(), key, order)
        if kept is not None:
            rows = kept.unionByName(rows.join(kept.select(*_cols(key)), _cols(key), "left_anti"))
        rows = rows.orderBy(*[F.col(c).asc() for c in order]).limit(int(limit))
        if i == len(sources) - 1:
            return rows
        kept = written(rows, "fill")
        if kept.count() >= limit:
            return kept
    raise ValueError("no sources")


def cut_at_limit(calls: DataFrame, key, order: Sequence[str], limit: int) -> DataFrame:
    """the rows of ``calls`` up to the one that brings the ``limit``-th
    distinct key, in ``order``; all if there are fewer keys.

    That row is the last of the first ``limit`` rows of the distinct keys, so
    no running count over all calls is needed; only its place reaches the
    driver."""
    last = priority_fill(calls, key, order, limit).orderBy(*[F.col(c).desc() for c in order]).select(*order).limit(1)
    n = first_wins(calls, key, order).limit(int(limit)).count()
    if n < limit:
        return calls
    row = last.head()
    if row is None:
        return calls.limit(0)
    return calls.where(F.struct(*[F.col(c) for c in order]) <= F.struct(*[F.lit(row[c]).cast(calls.schema[c].dataType).alias(c) for c in order]))


def rank_within(df: DataFrame, group, order: Sequence[Column]) -> Column:
    return F.row_number().over(Window.partitionBy(*_cols(group)).orderBy(*order))


def overfetch_dedup_limit(df: DataFrame, feed_key, order: Sequence[Column], dedup_key: str,
                          limit: int) -> DataFrame:
    """L2 + O1 + D3 per feed: take the first ``2*limit`` entries in feed
    order, drop repeated ``dedup_key`` (first wins), keep ``limit``.

    Feeds are landed documents of bounded size, so the per-feed window
    sorts one feed's entries, never a data-proportional group."""
    fk = _cols(feed_key)
    ranked = df.withColumn("__rank", rank_within(df, fk, order)).where(F.col("__rank") <= 2 * int(limit))
    firsts = first_wins(ranked, [*fk, dedup_key], ["__rank"])
    out = firsts.withColumn("__rank2", rank_within(firsts, fk, [F.col("__rank")]))
    return out.where(F.col("__rank2") <= int(limit)).drop("__rank2")
