"""Bronze -> silver: clean, keep the latest row per event key, then gate.

The order of the three steps is the reference's: the "latest" row is picked
on the raw timestamp *before* the quality gate, so a latest duplicate with an
unusable type removes the whole event (it does not fall back to an older
copy). NULL keys form one group, so only one NULL-key row can survive.

Plan shape: ``row_number() <= 1`` over ``partitionBy(key)`` is planned by
Catalyst as a partial ``WindowGroupLimit`` *before* the shuffle and a final one
after it, so every map task already reduces each key to one candidate row: a
key holding a third of all rows (mass copies) costs one row per map task in
the exchange, not a third of the data in one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.plans.channels import SPECS, ChannelSpec


def clean(bronze: DataFrame, spec: ChannelSpec) -> DataFrame:
    """P1-P10 projection; the raw timestamp (``_raw_ts``) and every raw column
    that breaks its ties (``_tb`` prefix, see ``tie_columns``) ride along."""
    cols = [c.alias(n) for n, c in spec.columns()]
    tb = [F.col(t).alias(f"_tb{i}") for i, t in enumerate(tie_columns(bronze, spec))]
    return bronze.select(*cols, F.col(spec.ts).alias("_raw_ts"), *tb)


def tie_columns(bronze: DataFrame, spec: ChannelSpec) -> list[str]:
    """The spec's tie-break columns, then every other raw column by name, so that
    copies which differ anywhere have one winner."""
    rest = sorted(set(bronze.columns) - set(spec.tiebreak) - {spec.ts, spec.key})
    return [*spec.tiebreak, *rest]


def dedup_latest(df: DataFrame, key: str, ts: str, tiebreak: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Keep the latest row per key (ties broken by ``tiebreak`` ascending)."""
    order = [F.col(ts).desc_nulls_last()] + [F.col(t).asc_nulls_first() for t in tiebreak]
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def latest(bronze: DataFrame, spec: ChannelSpec) -> DataFrame:
    """Cleaned rows, the latest per cleaned key by the raw timestamp. Only raw
    columns are shuffled and sorted; the rows that stay are cleaned after."""
    keyed = bronze.withColumn(spec.key, dict(spec.columns())[spec.key])  # a cast, the same when cleaned again
    return clean(dedup_latest(keyed, spec.key, spec.ts, tie_columns(bronze, spec)), spec)


def quality_gate(df: DataFrame, spec: ChannelSpec) -> DataFrame:
    """entity, type and timestamp must be present."""
    return df.where(F.col("hcp_id").isNotNull() & F.col(spec.gate_type).isNotNull() & F.col(spec.ts).isNotNull())


def to_silver(bronze: DataFrame, spec: ChannelSpec) -> DataFrame:
    return quality_gate(latest(bronze, spec), spec).select(*spec.silver_columns())


def silver(spark, sf_dir: str, channel: str) -> DataFrame:
    from pulsegrid.sources.adapters import BRONZE

    return to_silver(BRONZE[channel](spark, sf_dir), SPECS[channel])
