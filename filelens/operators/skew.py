"""Equi-joins in which a few keys hold a large share of the rows.

The heavy keys are found by a sketch (``approx_top_k`` of a key hash: one pass,
a bounded table a task, merged without a shuffle of the rows).  Their rows do
not go through the shuffle of the others: where the other side has few rows for
them, by a measured count, those are broadcast; where it has many, both sides
are dealt to salted groups.  Which keys the sketch names changes the plan only,
never the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy with more than this share of the rows (so there are fewer than its inverse).
HEAVY_SHARE = 1e-3
#: Items that a sketch tracks; its counts are off by a few rows in as many at most.
TRACKED = 10_000
#: Rows of the other side that may be broadcast for the heavy keys.
BROADCAST_ROWS = 10_000
#: Salted groups of a heavy key whose other side is larger.
SALTS = 64


def _hash(keys: Sequence[str]) -> F.Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def heavy_hashes(rows: DataFrame, keys: Sequence[str], share: float = HEAVY_SHARE) -> list[int]:
    """Hashes of the keys with more than ``share`` of the rows, at most ``1 / share``."""
    most = max(1, min(TRACKED // 2, int(1 / share)))
    hashed = rows.select(_hash(keys).alias("h"))
    got = hashed.agg(F.expr(f"approx_top_k(h, {most}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return sorted(r["item"] for r in got["top"] or [] if r["item"] is not None and r["count"] > share * got["n"])


def skew_join(rows: DataFrame, facts: DataFrame, keys: Sequence[str], how: str = "inner", share: float = HEAVY_SHARE) -> DataFrame:
    """``rows`` joined to ``facts`` on ``keys`` (``inner`` or ``left``), the rows
    of heavy keys apart.

    ``rows`` is read three times: give it a table, not a long plan.  Rows with
    a null key match nothing, as in any equi-join.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    keys = list(keys)
    heavy = heavy_hashes(rows, keys, share)
    if not heavy:
        return rows.join(facts, keys, how)
    is_heavy = _hash(keys).isin(heavy)
    light = rows.where(~is_heavy).join(facts.where(~is_heavy), keys, how)
    few = facts.where(is_heavy)
    if few.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return light.unionByName(rows.where(is_heavy).join(F.broadcast(few), keys, how))
    salt = "__filelens_salt"
    dealt = rows.where(is_heavy).withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    copied = few.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return light.unionByName(dealt.join(copied, [*keys, salt], how).drop(salt))
