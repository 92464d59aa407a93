"""Upserts with sticky ids, snapshot diffs, hard assertions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .window import numbered


def sticky_ids(df: DataFrame, known: DataFrame, key: str, order: list[str], first: int = 100001) -> DataFrame:
    """Adds ``id``: the known one where there is one, else the next free numbers in an order. ``known``: (key, id)."""
    old = df.join(known, key)
    new = df.join(known, key, "left_anti")
    start = known.agg(F.greatest(F.coalesce(F.max("id"), F.lit(0)) + 1, F.lit(first)).alias("start"))
    made = numbered(new, order, "", 18, "_k").crossJoin(F.broadcast(start)).withColumn("id", F.col("start") + F.col("_k").cast("long") - 1).drop("_k", "start")
    return old.unionByName(made.select(*old.columns))


def upsert(base: DataFrame, change: DataFrame, key: str, when: dict[str, Column]) -> DataFrame:
    """Base rows with columns taken from ``change`` where a condition over both holds, and rows that only ``change`` has.

    ``when``: column to condition; base columns as they are, those of the change with the prefix ``new_``. Runs as one full join.
    """
    c = change.select(F.col(key).alias("_k"), *(F.col(x).alias(f"new_{x}") for x in change.columns if x != key))
    j = base.withColumn("_old", F.lit(True)).join(c, F.col(key) == F.col("_k"), "full")
    cols = [F.coalesce(F.col(key), F.col("_k")).alias(key)]
    for x in base.columns:
        if x == key:
            continue
        if x in when:
            cols.append(F.when(F.col("_old").isNull() | (F.col("_k").isNotNull() & F.coalesce(when[x], F.lit(False))), F.col(f"new_{x}")).otherwise(F.col(x)).alias(x))
        else:
            cols.append((F.when(F.col("_old").isNull(), F.col(f"new_{x}")).otherwise(F.col(x)) if x in change.columns else F.col(x)).alias(x))
    return j.select(*cols)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, before, after) of every field that differs, null-safe; a row that only one side has gives field ``NEW`` or
    ``GONE``."""
    o = old.select(F.col(key).alias("_o"), *(F.col(f).cast("string").alias(f"o_{f}") for f in fields))
    n = new.select(F.col(key).alias("_n"), *(F.col(f).cast("string").alias(f"n_{f}") for f in fields))
    j = o.join(n, F.col("_o") == F.col("_n"), "full")
    none = F.lit(None).cast("string")
    changed = F.filter(F.array(*(F.when(~F.col(f"o_{f}").eqNullSafe(F.col(f"n_{f}")), F.struct(F.lit(f).alias("field"), F.col(f"o_{f}").alias("before"), F.col(f"n_{f}").alias("after"))) for f in fields)), lambda x: x.isNotNull())
    whole = lambda what: F.array(F.struct(F.lit(what).alias("field"), none.alias("before"), none.alias("after")))
    d = F.when(F.col("_o").isNull(), whole("NEW")).when(F.col("_n").isNull(), whole("GONE")).otherwise(changed)
    return j.select(F.coalesce("_o", "_n").alias(key), F.explode(d).alias("d")).select(key, "d.field", "d.before", "d.after")


def patch(df: DataFrame, patches: DataFrame, key: str, fields: list[str], note: str) -> DataFrame:
    """Fields replaced where a patch gives them; ``note`` is appended to the row's notes (an array) where any was."""
    p = patches.select(F.col(key).alias("_k"), *(F.col(f).alias(f"p_{f}") for f in fields))
    j = df.join(p, F.col(key) == F.col("_k"), "left")
    any_ = F.col("_k").isNotNull()
    out = [F.coalesce(F.col(f"p_{c}"), F.col(c)).alias(c) if c in fields else (F.when(any_, F.array_append(F.col(c), F.lit(note))).otherwise(F.col(c)).alias(c) if c == "notes" else F.col(c)) for c in df.columns]
    return j.select(*out)


def assert_none_missing(needed: DataFrame, there: DataFrame, key: str) -> DataFrame:
    """``needed`` itself; the job fails on the first row that ``there`` lacks."""
    t = there.select(F.col(key).alias("_k")).distinct()
    j = needed.join(t, F.col(key) == F.col("_k"), "left")
    ok = F.when(F.col("_k").isNull(), F.raise_error(F.concat(F.lit("missing: "), F.col(key).cast("string")))).otherwise(F.lit(True))
    return j.withColumn("_ok", ok).where("_ok").drop("_k", "_ok")


def keep_labels(old: DataFrame, new: DataFrame, key: str, label: str, source: str, default: str) -> DataFrame:
    """Labels merged last-wins; the source of one that did not change is kept, else it is ``default``."""
    n = new.select(F.col(key).alias("_k"), F.col(label).alias("_l"))
    j = old.join(n, F.col(key) == F.col("_k"), "full")
    kept = F.col("_l").isNull() | (F.col(label).eqNullSafe(F.col("_l")) & F.col(source).isNotNull())
    return j.select(F.coalesce(F.col(key), F.col("_k")).alias(key), F.coalesce("_l", label).alias(label), F.when(kept, F.col(source)).otherwise(F.lit(default)).alias(source))
