"""Unit converters and the registry of named transforms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
MPH_PER_MS = 2.2369362920544
MPH_PER_MS_MODEL = 2.2369362921
MPH_PER_KT = 1.150779448
M_PER_MI = 1609.344
FT_PER_M = 3.2808398950131
KG_M2_PER_IN = 25.4
M_PER_FT = 0.3048
MS_PER_KT = 0.514444
#: Magnus formula: factor and offset.
MAGNUS_A, MAGNUS_B = 17.67, 243.5


def k_to_f(x: Column) -> Column:
    return (x - 273.15) * 9.0 / 5.0 + 32.0


def delta_k_to_f(x: Column) -> Column:
    return x * 9.0 / 5.0


def c_to_f(x: Column) -> Column:
    return x * 9.0 / 5.0 + 32.0


def half_even_degree(x: Column) -> Column:
    return F.bround(x, 0).cast("long")


def half_up_degree(x: Column) -> Column:
    """Half away from zero."""
    return F.round(x, 0).cast("long")


TRANSFORMS: dict[str, Callable[[Column], Column]] = {
    "copy": lambda x: x,
    "k_to_f": k_to_f,
    "delta_k_to_f": delta_k_to_f,
    "ms_to_mph": lambda x: x * MPH_PER_MS,
    "kt_to_mph": lambda x: x * MPH_PER_KT,
    "m_to_mi": lambda x: x / M_PER_MI,
    "m_to_ft": lambda x: x * FT_PER_M,
    "hundred_ft_to_ft": lambda x: x * 100.0,
    "kg_m2_to_in": lambda x: x / KG_M2_PER_IN,
}

#: The models' own transforms: one constant differs.
MODEL_TRANSFORMS = TRANSFORMS | {"ms_to_mph": lambda x: x * MPH_PER_MS_MODEL}
#: Bulletin units back to SI.
TO_SI: dict[str, Callable[[Column], Column]] = {
    "f_to_k": lambda x: (x - 32.0) * (5.0 / 9.0) + 273.15,
    "kt_to_ms": lambda x: x * MS_PER_KT,
    "hundred_ft_to_m": lambda x: x * 100.0 * M_PER_FT,
    "mi_to_m": lambda x: x * M_PER_MI,
}

#: Suffix of a source column -> (transform, suffix of the result).
SUFFIXES = {"_k": ("k_to_f", "_f"), "_ms": ("ms_to_mph", "_mph"), "_kt": ("kt_to_mph", "_mph"), "_m": ("m_to_ft", "_ft"), "_kg_m2": ("kg_m2_to_in", "_in")}


def convert_by_suffix(df: DataFrame) -> DataFrame:
    """Every column with a known unit suffix, converted and renamed; the longest suffix counts."""
    out = []
    for name in df.columns:
        suffix = max((s for s in SUFFIXES if name.endswith(s)), key=len, default=None)
        if suffix is None:
            out.append(F.col(name))
        else:
            transform, new = SUFFIXES[suffix]
            out.append(TRANSFORMS[transform](F.col(name)).alias(name[: -len(suffix)] + new))
    return df.select(out)


#: Statistics of a field that are differences of its values.
DIFFERENCES = ("_std", "_gradient_west_east", "_gradient_south_north")


def convert_family(df: DataFrame, base: str, target: str, transform: str) -> DataFrame:
    """A field and its statistics (``base`` and base_...) converted and renamed to ``target``; of temperatures, differences are converted as such."""
    def converted(name: str) -> Column:
        rest = name[len(base) :]
        own = "delta_k_to_f" if transform == "k_to_f" and rest.endswith(DIFFERENCES) else transform
        return TRANSFORMS[own](F.col(f"`{name}`").cast("double")).alias(target + rest)

    return df.select(*[converted(n) if n == base or n.startswith(f"{base}_") else F.col(f"`{n}`") for n in df.columns])


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def wind_direction(u: Column, v: Column) -> Column:
    """Where the wind comes from, in degrees; calm is null."""
    return F.when((u == 0) & (v == 0), None).otherwise(F.pmod(270.0 - F.degrees(F.atan2(v, u)), F.lit(360.0)))


def wind_direction_hourly(u: Column, v: Column) -> Column:
    """The hourly rows' form, where calm is 180."""
    return F.when((u == 0) & (v == 0), 180.0).otherwise(F.pmod(F.degrees(F.atan2(-u, -v)), F.lit(360.0)))


def relative_humidity(t_c: Column, td_c: Column) -> Column:
    """Magnus formula, clipped to 0..100; null where either is."""
    def vapour(t: Column) -> Column:
        return F.exp(MAGNUS_A * t / (MAGNUS_B + t))

    ratio = 100.0 * vapour(td_c) / vapour(t_c)
    return F.when(ratio.isNotNull(), F.least(F.lit(100.0), F.greatest(F.lit(0.0), ratio)))
