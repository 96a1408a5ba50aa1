"""Joins: enrichment, overlays, factorial designs, anti/semi restrictions,
fallback resolution, look-ups and nearest-level snapping.

Equi joins carry no hints: AQE measures the real size of each side at run
time and switches to a broadcast join only under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise it keeps a
sort-merge join and splits skewed partitions (``skewJoin.enabled``). Explicit
``broadcast`` is used only for sides bounded by construction (level lists,
top-n tables, one-row scalars).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialflow.operators.nearest import nearest
from vialflow.session import small


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def enrich(left: DataFrame, right: DataFrame, key, cols: Sequence[str]) -> DataFrame:
    """Left join bringing ``cols`` of ``right`` (right keys assumed unique)."""
    keys = _keys(key)
    return left.join(right.select(*keys, *cols), keys, "left")


def overlay(base: DataFrame, upd: DataFrame, keys, cols: Sequence[str]) -> DataFrame:
    """Left join; the update's value wins when present (non-NULL)."""
    keys = _keys(keys)
    u = upd.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in cols])
    j = base.join(u, keys, "left")
    return j.select(*[F.coalesce(F.col(f"_u_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
                      for c in base.columns])


def factorial(*levels: DataFrame) -> DataFrame:
    """Full factorial of small level tables.

    Every level table is a distinct list of levels, bounded by the design and
    broadcast; the product is the design itself, so its size is the intended
    output, not an accident of the data.
    """
    out = levels[0]
    for lv in levels[1:]:
        out = out.crossJoin(small(lv))
    return out


def align(a: DataFrame, b: DataFrame, id_col: str) -> DataFrame:
    """Row-by-row alignment re-expressed as an inner join on the id."""
    return a.join(b, id_col, "inner")


def untested(space: DataFrame, seen: DataFrame, keys) -> DataFrame:
    """Candidates whose keys were never observed (left anti join)."""
    keys = _keys(keys)
    return space.join(seen.select(*keys), keys, "left_anti")


def restrict(df: DataFrame, keep: DataFrame, key: str, bounded: bool = True) -> DataFrame:
    """Rows whose key is in ``keep`` (left semi join). ``bounded=True`` marks
    ``keep`` as a small list (e.g. a top-n table) and broadcasts it."""
    k = keep.select(key)
    return df.join(F.broadcast(k) if bounded else k, key, "left_semi")


def resolve(df: DataFrame, key: str, primary: DataFrame, fallback: DataFrame,
            value: str = "value") -> DataFrame:
    """Look ``key`` up in ``primary``; when absent, in ``fallback``; record
    which source answered. Both look-ups are ``(key, value)`` tables."""
    p = primary.select(F.col(primary.columns[0]).alias(key), F.col(primary.columns[1]).alias("_p"))
    f = fallback.select(F.col(fallback.columns[0]).alias(key), F.col(fallback.columns[1]).alias("_f"))
    j = df.join(p, key, "left").join(f, key, "left")
    src = F.when(F.col("_p").isNotNull(), F.lit("primary")).when(F.col("_f").isNotNull(), F.lit("fallback"))
    return j.select(*df.columns, F.coalesce("_p", "_f").alias(value), src.alias("source"))


def source_agreement(a: DataFrame, b: DataFrame, key: str, col: str) -> DataFrame:
    """Full outer join of two sources on ``key``; flag NULL-safe agreement and
    which sides were present."""
    x = a.select(F.col(key), F.col(col).alias("value_a"))
    y = b.select(F.col(key), F.col(col).alias("value_b"))
    j = x.join(y, key, "full_outer")
    return j.select(key, "value_a", "value_b",
                    F.col("value_a").eqNullSafe(F.col("value_b")).alias("agree"),
                    F.when(F.col("value_a").isNull(), "b_only").when(F.col("value_b").isNull(), "a_only")
                    .otherwise("both").alias("presence"))


def lookup_outcomes(proposals: DataFrame, runs: DataFrame, keys, val: str,
                    out: str = "outcome") -> DataFrame:
    """Outcome for each proposed key tuple: the max observed value when several
    runs match (partial aggregate first), NULL when none."""
    keys = _keys(keys)
    agg = runs.groupBy(*keys).agg(F.max(val).alias(out))
    return proposals.join(agg, keys, "left")


def snap(df: DataFrame, col: str, levels: DataFrame, out: str = "snapped") -> DataFrame:
    """Snap ``col`` to the nearest level; the lower level wins ties. Each distinct
    value looks its level up once (``operators.nearest``), so neither the number of
    levels nor of rows is bounded. NULL stays NULL."""
    x = F.col(col).cast("double")
    have = levels.select(F.col(levels.columns[0]).cast("double").alias("_level")).distinct()
    ask = df.select(x.alias("_value")).distinct()
    found = nearest(ask.withColumn("_at", F.col("_value")), have.withColumn("_at", F.col("_level")), ["_at"], "_value", "_level")
    return df.join(found.select("_value", F.col("_level").alias(out)), x == F.col("_value"), "left").drop("_value")


def nearest_row(props: DataFrame, pool: DataFrame, feats: Sequence[str], prop_id: str,
                pool_id: str) -> DataFrame:
    """Nearest pool row (Euclidean over ``feats``) to every proposal; ties go
    to the smallest pool id. Any number of both: see ``operators.nearest``."""
    return nearest(props, pool, feats, prop_id, pool_id)


def route_identifier(col: Column | str, code_pattern: str) -> Column:
    """'id' when all digits, 'code' when it matches ``code_pattern``, else 'name'."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.when(c.rlike(r"^[0-9]+$"), F.lit("id"))
            .when(c.rlike(code_pattern), F.lit("code")).otherwise(F.lit("name")))


def resolve_mixed(df: DataFrame, col: str, code_pattern: str, by_id: DataFrame,
                  by_code: DataFrame, by_name: DataFrame) -> DataFrame:
    """Route each identifier by its form and resolve it through the matching
    look-up (each a ``(lookup_key STRING, resolved BIGINT)`` table). Unresolved
    identifiers are kept with ``resolved = false``."""
    d = df.withColumn("route", route_identifier(col, code_pattern))
    ids = by_id.select(F.col(by_id.columns[0]).cast("string").alias("_k"), F.col(by_id.columns[1]).alias("_id"))
    codes = by_code.select(F.col(by_code.columns[0]).cast("string").alias("_k"), F.col(by_code.columns[1]).alias("_code"))
    names = by_name.select(F.lower(F.col(by_name.columns[0]).cast("string")).alias("_k"),
                           F.col(by_name.columns[1]).alias("_name"))
    j = (d.join(ids, (d["route"] == "id") & (F.col(col) == ids["_k"]), "left").drop("_k")
          .join(codes, (F.col("route") == "code") & (F.col(col) == codes["_k"]), "left").drop("_k")
          .join(names, (F.col("route") == "name") & (F.lower(F.col(col)) == names["_k"]), "left").drop("_k"))
    key = F.coalesce("_id", "_code", "_name")
    return j.select(*df.columns, "route", key.alias("resolved_key"), key.isNotNull().alias("resolved"))
