"""User-function surface: row functions returning several fields, per-group
table functions, batched external-model calls, row generators and custom
aggregates.

Python runs only through Arrow-batched pandas UDFs, ``applyInPandas``,
``mapInPandas`` or Python UDTFs, over data Spark has already partitioned;
the per-row Python stays a small helper.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from vialflow.operators.window import RANGE, running


def map_struct(col: Column | str, fn: Callable, ddl: str) -> Column:
    """Apply ``fn(value) -> dict`` to every value through a pandas UDF
    returning a struct; a failing call yields NULL fields, not an error."""
    fields = [f.strip().split()[0].strip("`") for f in ddl.split(",")]

    @F.pandas_udf(ddl)
    def apply(s: pd.Series) -> pd.DataFrame:
        out = []
        for v in s:
            try:
                r = fn(v)
                out.append([r.get(f) for f in fields])
            except Exception:  # noqa: BLE001 - failures become NULLs by contract
                out.append([None] * len(fields))
        return pd.DataFrame(out, columns=fields)

    return apply(F.col(col) if isinstance(col, str) else col)


def json_summary(text):
    """Example row function: number of keys and the numeric value of 'k'."""
    obj = json.loads(text)
    return {"n_keys": len(obj), "k": float(obj["k"])}


def map_groups(df: DataFrame, key: str, fn: Callable[[pd.DataFrame], pd.DataFrame], ddl: str) -> DataFrame:
    """Per-group table function (``groupBy.applyInPandas``). Each group is
    handed to one Python worker whole, so use it on groups whose size is
    bounded by construction (e.g. one row per arm of an entity, after an
    aggregate), not on raw rows of a possibly hot key."""
    return df.groupBy(key).applyInPandas(fn, ddl)


def arm_summary(pdf: pd.DataFrame) -> pd.DataFrame:
    """Example group function over one entity's arm table: best arm by mean
    (name breaks ties), its pulls and its share of the entity's pulls."""
    pdf = pdf.sort_values(["mean", "arm"], ascending=[False, True], kind="mergesort")
    best = pdf.iloc[0]
    total = pdf["pulls"].sum()
    return pd.DataFrame({"user_id": [int(best["user_id"])], "best_arm": [best["arm"]],
                         "pulls": [int(best["pulls"])],
                         "pull_share": [float(best["pulls"]) / float(total) if total else 0.0]})


class RuleClient:
    """Default client for ``infer``: a deterministic rule-based stand-in for a
    remote model (no network). Answers 'Y' when a strong cue is present."""

    def __init__(self, cue: str = "Released under the"):
        self.cue = cue

    def complete(self, prompt: str) -> str:
        if prompt is None:
            raise ValueError("empty prompt")
        if self.cue in prompt:
            return f"Y\nRationale: contains '{self.cue}'"
        return "N\nRationale: no cue"


def infer(df: DataFrame, id_col: str, prompt_col: str, make_client: Callable[[], object] = RuleClient,
          max_calls_per_sec: float | None = None) -> DataFrame:
    """Batched model calls: one client per partition (``mapInPandas``),
    prompt in, raw text out, with latency (ms) and error columns; an
    optional per-partition rate cap."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        gap = 1.0 / max_calls_per_sec if max_calls_per_sec else 0.0
        last = 0.0
        for pdf in batches:
            raw, lat, err = [], [], []
            for p in pdf[prompt_col]:
                if gap:
                    wait = last + gap - time.monotonic()
                    if wait > 0:
                        time.sleep(wait)
                    last = time.monotonic()
                t0 = time.perf_counter()
                try:
                    raw.append(client.complete(p))
                    err.append(None)
                except Exception as e:  # noqa: BLE001 - reported per row
                    raw.append(None)
                    err.append(type(e).__name__)
                lat.append((time.perf_counter() - t0) * 1000.0)
            yield pd.DataFrame({id_col: pdf[id_col], "raw": raw, "latency_ms": lat, "error": err})

    id_type = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, prompt_col).mapInPandas(
        run, f"{id_col} {id_type}, raw string, latency_ms double, error string")


@udtf(returnType="step int, component string, volume double")
class TransferRows:
    """Row generator: one row -> one transfer per component of a recipe
    (``n`` components, volume split evenly)."""

    def eval(self, name: str, n: int, total: float):
        if name is None or n is None or n <= 0:
            return
        for i in range(n):
            yield i, f"{name}#{i}", float(total) / n


def front_agg(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Pareto front size and 2-D hypervolume (reference point 0, 0) per group,
    for maximised x and y.

    Points are counted per distinct value first. Walking x from high to low,
    a point is on the front if its y beats all larger x, and it adds its width
    times that gain to the area: one running maximum over ranges of the points.
    """
    pts = df.select(group, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).dropna()
    per = pts.groupBy(group, "_x", "_y").agg(F.count(F.lit(1)).alias("_c"))
    top = per.groupBy(group, "_x").agg(F.max("_y").alias("_v"), F.max_by("_c", "_y").alias("_c"))
    walk = running(top, [F.col("_x").desc()], {"_before": ("max", "_v")}, [group], block=RANGE, exclusive=True)
    on_front = F.col("_before").isNull() | (F.col("_v") > F.col("_before"))
    floor = F.greatest(F.coalesce("_before", F.lit(0.0)), F.lit(0.0))
    area = F.greatest(F.col("_x"), F.lit(0.0)) * (F.greatest(F.col("_v"), floor) - floor)
    return walk.groupBy(group).agg(F.sum(F.when(on_front, F.col("_c")).otherwise(0)).cast("long").alias("n_front"),
                                   F.sum(area).alias("hypervolume"))
