"""Learning-rate curves and closed-form estimates as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _warming(step: Column, warmup: int) -> Column:
    return F.greatest(step, F.lit(1)) / F.lit(float(max(warmup, 1)))


def _falling(progress: Column, least: float) -> Column:
    half = F.lit(0.5) * (1 + F.cos(F.lit(math.pi) * F.least(progress, F.lit(1.0))))
    return F.lit(least) + F.lit(1.0 - least) * half


def warmup_cosine(step: Column, warmup: int, total: int, least: float) -> Column:
    progress = (step - warmup) / F.lit(float(max(total - warmup, 1)))
    return F.when(step < warmup, _warming(step, warmup)).otherwise(_falling(progress, least))


def warmup_stable_decay(step: Column, warmup: int, total: int, stable: float, least: float) -> Column:
    """One between warm-up and the share ``stable`` of all steps, then a cosine fall."""
    if total <= 0:
        return F.lit(1.0)
    end = int(total * stable)
    progress = (step - end) / F.lit(float(max(total - end, 1)))
    return F.when(step < warmup, _warming(step, warmup)).when(step < end, F.lit(1.0)).otherwise(_falling(progress, least))


def decoder_parameters(vocabulary: Column, width: Column, layers: Column, heads: Column, kv_heads: Column, inner: Column) -> Column:
    """Weights of a decoder with tied embeddings, grouped key and value heads and a gated inner layer."""
    kv = width / heads * kv_heads
    return (vocabulary * width + layers * (2 * width * width + 2 * width * kv + 3 * width * inner + 2 * width) + width).cast("long")


def training_bytes(parameters: Column, weight: int = 4, gradient: int = 4, moments: int = 8) -> Column:
    return parameters * (weight + gradient + moments)
