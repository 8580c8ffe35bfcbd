"""What changed between consecutive full snapshots.

Identical rows are removed by a multiset difference both ways (EXCEPT ALL in either direction, done in one shuffle as a
signed count per distinct row); a full join of the two residues by key then labels additions, removals and changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def clean_text(c: Column | str) -> Column:
    """Trimmed; empty is null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.regexp_replace(c.cast("string"), r"^\s+|\s+$", ""), F.lit(""))


def snapshot_changes(
    snaps: DataFrame,
    snapshot: str,
    keys: Sequence[str],
    texts: Sequence[str],
    numbers: Sequence[str],
    order: str,
    within: float = 0.005,
    missing: str = "NA",
) -> DataFrame:
    """(snapshot, obs_id, changement, changed): per consecutive pair, the keys that are added, removed or changed.

    snapshot numbers the deliveries 1, 2, ...; in a snapshot the row with the highest `order` holds for its key, so
    repeated keys and repeated rows count once. Texts are compared trimmed with empty as null, numbers within `within`
    (NaN as null); null equals null only. `changed` lists the changed fields, null unless changement is `changed`.
    A missing key part reads `missing`. Other columns are ignored; an empty table gives no row.
    """
    key = F.concat_ws("_", *[F.coalesce(clean_text(k), F.lit(missing)) for k in keys])
    number = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in numbers}
    row = F.struct(*[clean_text(c).alias(c) for c in texts], *[number[c].alias(c) for c in numbers])
    # a key's copies are combined map-side before they are shuffled
    held = (
        snaps.where(F.col(snapshot).isNotNull())
        .groupBy(F.col(snapshot).cast("int").alias("_s"), key.alias("obs_id"))
        .agg(F.max_by(row, F.col(order)).alias("_r"))
    )
    # every snapshot is the new side of one comparison and the old side of the next; one row per delivery, so broadcast
    w = Window.orderBy("_s")
    turns = snaps.where(F.col(snapshot).isNotNull()).select(F.col(snapshot).cast("int").alias("_s")).distinct()
    turns = turns.select("_s", F.lag("_s").over(w).alias("_before"), F.lead("_s").over(w).alias("_next"))
    uses = F.array(
        F.struct(F.lit(1).alias("side"), F.when(F.col("_before").isNotNull(), F.col("_s")).alias("at")),
        F.struct(F.lit(-1).alias("side"), F.col("_next").alias("at")),
    )
    sides = held.join(F.broadcast(turns), "_s").select("obs_id", "_r", F.explode(uses).alias("_u")).where("_u.at IS NOT NULL")
    residue = (
        sides.groupBy(F.col("_u.at").alias("_at"), "obs_id", F.col("_r"))
        .agg(F.sum("_u.side").alias("_n"))
        .where("_n <> 0")
    )
    new = residue.where("_n > 0").select("_at", "obs_id", F.col("_r").alias("_new"))
    old = residue.where("_n < 0").select("_at", "obs_id", F.col("_r").alias("_old"))
    both = new.join(old, ["_at", "obs_id"], "full")
    differs = [
        (c, ~F.col(f"_new.{c}").eqNullSafe(F.col(f"_old.{c}"))) for c in texts
    ] + [
        (
            c,
            F.coalesce(F.abs(F.col(f"_new.{c}") - F.col(f"_old.{c}")) > within, F.col(f"_new.{c}").isNotNull() != F.col(f"_old.{c}").isNotNull()),
        )
        for c in numbers
    ]
    fields = F.filter(F.array(*[F.when(d, F.lit(c)) for c, d in differs]), lambda x: x.isNotNull())
    label = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("changed")
    return (
        both.withColumn("changement", label)
        .withColumn("changed", F.when(F.col("changement") == "changed", fields))
        .where("changed IS NULL OR size(changed) > 0")
        .select(F.col("_at").alias(snapshot), "obs_id", "changement", "changed")
    )
