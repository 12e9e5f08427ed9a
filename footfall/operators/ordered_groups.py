"""``row_number``, ``lag`` and running totals over whole groups, also when one group is huge.

A window function puts a whole group into one task. That is fine until one
session, user or brand holds a large share of all rows. Here rows are dealt out
by ranges of (group, order) instead, so a group that is larger than a part lies
in several consecutive parts. A window runs inside each (part, group); only the
last group of a part can go on in the next one, so one small row per part (how
many rows that group has there, its last values and totals) carries the result
on. Every row is kept and the result is that of the plain window.

It is one plan, whatever the data: a shuffle by range, one by (part, group), and
a broadcast of two rows per part at most. The dealt rows are a common table
expression that holds the number of the part. Spark does not inline such an
expression (it is not deterministic) but shuffles it once and reads that shuffle
in both places, so rows and carried totals always agree on the parts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

# How the totals of earlier parts are joined to a running value.
_JOINED = {
    "sum": "coalesce({local}, 0) + coalesce({carried}, 0)",
    "bit_xor": "coalesce({local}, 0) ^ coalesce({carried}, 0)",
}


def scan_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rank: str | None = None,
    lags: Mapping[str, str] | None = None,
    running: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """All rows, with what the rows before them in their group say.

    ``order`` are ascending columns (NULL first) that together are unique in a
    group; NULL is a group like any other. ``rank`` names the row's number (from
    1); ``lags`` maps new names to columns of the previous row (NULL in the first
    row); ``running`` maps new names to ``("sum" | "bit_xor", column)`` over the
    rows up to this one (NULL counts as 0).
    """
    if df.sparkSession.conf.get("spark.sql.exchange.reuse", "true") != "true":
        raise ValueError("rows and carried totals must read one shuffle: spark.sql.exchange.reuse has to be on")
    lags, running = dict(lags or {}), dict(running or {})
    group = ", ".join(f"`{k}`" for k in keys)
    sequence = ", ".join(f"`{o}`" for o in order)
    before = f"OVER (PARTITION BY _part, {group} ORDER BY {sequence})"
    upto = before[:-1] + " ROWS UNBOUNDED PRECEDING)"

    # What a row hands on: its number, its values and the totals up to it.
    handed = [f"`{source}` AS `v{i}`" for i, source in enumerate(lags.values())]
    handed += [f"`_total{i}` AS `t{i}`" for i in range(len(running))]
    packed = ", ".join(["_local AS n", *handed])
    local = [f"row_number() {before} AS _local", f"lead(1) {before} IS NULL AS _ends"]
    local += [f"{kind}(`{source}`) {upto} AS `_total{i}`" for i, (kind, source) in enumerate(running.values())]
    if lags:
        previous = ", ".join(f"`{source}` AS `v{i}`" for i, source in enumerate(lags.values()))
        local.append(f"lag(struct({previous})) {before} AS _previous")

    carried = ["sum(handed.n) OVER earlier AS _n"]
    carried += [f"{kind}(handed.`t{i}`) OVER earlier AS `_t{i}`" for i, (kind, _) in enumerate(running.values())]
    if lags:
        carried.append("last_value(handed, true) OVER earlier AS _border")
    renamed = ", ".join(f"`{k}` AS `_k{i}`" for i, k in enumerate(keys))
    names = ", ".join(f"`_k{i}`" for i in range(len(keys)))

    results = [f"l.`{c}`" for c in df.columns]
    if rank:
        results.append(f"CAST(_local + coalesce(_n, 0) AS BIGINT) AS `{rank}`")
    results += [
        f"CASE WHEN _previous IS NULL THEN _border.`v{i}` ELSE _previous.`v{i}` END AS `{new}`"
        for i, new in enumerate(lags)
    ]
    results += [
        f"{_JOINED[kind].format(local=f'`_total{i}`', carried=f'`_t{i}`')} AS `{new}`"
        for i, (new, (kind, _)) in enumerate(running.items())
    ]
    same = " AND ".join(f"l.`{k}` <=> c.`_k{i}`" for i, k in enumerate(keys))
    return df.sparkSession.sql(
        f"""
        WITH dealt AS (
            SELECT /*+ REPARTITION(_part, {group}) */ * FROM (SELECT *, spark_partition_id() AS _part FROM {{ranged}})
        ), local AS (
            SELECT *, {", ".join(local)} FROM dealt
        ), borders AS (
            SELECT _part,
                   min(struct({renamed})) AS first,
                   max_by(struct({renamed}), struct({group}, {sequence})) AS last,
                   max_by(struct({packed}), struct({group}, {sequence})) AS handed
            FROM local WHERE _ends GROUP BY _part
        ), met AS (
            SELECT _part, 0 AS goes_on, first.*, NULL AS handed FROM borders
            UNION ALL SELECT _part, 1, last.*, handed FROM borders
        ), carried AS (
            SELECT _part, goes_on, {names}, {", ".join(carried)} FROM met
            WINDOW earlier AS (PARTITION BY {names} ORDER BY _part, goes_on ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        )
        SELECT /*+ BROADCAST(c) */ {", ".join(results)}
        FROM local AS l LEFT JOIN (SELECT * FROM carried WHERE goes_on = 0) AS c ON l._part = c._part AND {same}
        """,
        ranged=df.repartitionByRange(*keys, *order),
    )


def rank_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Add the row's number (from 1) within its group. For a descending order pass a negated number."""
    return scan_groups(df, keys, order, rank=name)


def lag_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, str]
) -> DataFrame:
    """Add, per ``new name -> column``, the column's value in the group's previous row."""
    return scan_groups(df, keys, order, lags=values)
