"""Functions on arrays of samples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SILENT = 1e-10
QUIET_DB = -50.0


def _sum(a: Column, f) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + f(x.cast("double")))


def rms_db(a: Column) -> Column:
    """20 log10(rms + 1e-10); null for an empty array."""
    return F.when(F.size(a) > 0, 20 * F.log10(F.sqrt(_sum(a, lambda x: x * x) / F.size(a)) + SILENT))


def loud_enough(a: Column, floor: float = QUIET_DB) -> Column:
    level = rms_db(a)
    return F.coalesce(~F.isnan(level) & (level >= floor), F.lit(False))


def peak(a: Column) -> Column:
    return F.array_max(F.transform(a, lambda x: F.abs(x.cast("double"))))


def peak_normalised(a: Column, target_db: float = -3.0) -> Column:
    """Scaled so that the peak has the target level; an all-zero array stays as it is."""
    scale = F.lit(10 ** (target_db / 20)) / F.greatest(peak(a), F.lit(SILENT))
    return F.when(peak(a) > 0, F.transform(a, lambda x: x.cast("double") * scale)).otherwise(F.transform(a, lambda x: x.cast("double")))


def not_silent(a: Column) -> Column:
    return F.coalesce((F.size(a) > 0) & F.exists(a, lambda x: x != 0), F.lit(False))


def gained(a: Column, db: float) -> Column:
    """Louder by `db`, clipped at -1 and 1."""
    g = 10 ** (db / 20)
    return F.transform(a, lambda x: F.greatest(F.least(x.cast("double") * g, F.lit(1.0)), F.lit(-1.0)))


def cropped(a: Column, start: float, share: float) -> Column:
    """The stretch from the fraction `start` that holds `share` of the samples, at least one."""
    return F.slice(a, F.floor(F.size(a) * start).cast("int") + 1, F.greatest(F.floor(F.size(a) * share).cast("int"), F.lit(1)))


def hard_clipped(a: Column, share_of_peak: float) -> Column:
    limit = peak(a) * share_of_peak
    return F.transform(a, lambda x: F.greatest(F.least(x.cast("double"), limit), -limit))


def mixed_at_snr(a: Column, noise: Column, snr_db: float) -> Column:
    """`a` plus `noise` (of equal length) scaled to the wanted ratio of powers."""
    power = lambda c: _sum(c, lambda x: x * x) / F.greatest(F.size(c), F.lit(1))
    scale = F.sqrt(power(a) / F.greatest(power(noise) * F.lit(10 ** (snr_db / 10)), F.lit(SILENT)))
    return F.zip_with(a, noise, lambda x, y: x.cast("double") + y.cast("double") * scale)
