"""Rows whose key is not in a table of excluded keys, with SQL's outcome for NULLs on either side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def excluded_by(df: DataFrame, key: str, excluded: DataFrame, excluded_key: str | None = None) -> DataFrame:
    """``where key not in (select excluded_key from excluded)``, three-valued:

    * no excluded rows: every row stays, also one without a key;
    * a NULL among the excluded keys: no row stays, as none is known not to be it;
    * else a row stays when it has a key and that is not excluded.

    The engine's own form of it needs the whole exclusion table in every task. Here the NULLs are settled first, by one
    small job that brings two counts to the driver, and the rest is an ordinary anti-join on the key, which may be
    broadcast or shuffled and split like any other. Only distinct keys of the table are joined.
    """
    keys = excluded.select(F.col(excluded_key or key).alias(key))
    facts = keys.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("unknown")).first()
    if not facts.n:
        return df
    if facts.unknown:
        return df.where(F.lit(False))
    return df.where(F.col(key).isNotNull()).join(keys.distinct(), key, "left_anti").select(*df.columns)
