"""Apply the silver cleaning expressions to a streaming bronze source.

``clean(stream, spec)`` is the same projection the batch silver layer uses
(P1-P10); the result can be written with any streaming sink, e.g. appended
to a cleaned-bronze table that the batch layer de-duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from pulsegrid.operators.silver import clean
from pulsegrid.plans.channels import SPECS


def clean_stream(stream: DataFrame, channel: str) -> DataFrame:
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame (spark.readStream...)")
    spec = SPECS[channel]
    return clean(stream, spec).select(*spec.silver_columns())
