"""Buckets, regimes and vocabularies."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.session import scratch_path

# Vocabularies and their aliases.
VOCABULARIES = {
    "cloud_cover": {"__MISSING__": 0, "__UNK__": 1, "CLR": 2, "SKC": 3, "FEW": 4, "SCT": 5, "BKN": 6, "OVC": 7, "VV": 8},
    "weather_family": {"__MISSING__": 0, "__UNK__": 1, "NONE": 2, "HAZE": 3, "MIST": 4, "FOG": 5, "RAIN": 6, "SNOW": 7, "FREEZING": 8, "THUNDER": 9},
    "precip_type": {"__MISSING__": 0, "__UNK__": 1, "NONE": 2, "R": 3, "S": 4, "ZR": 5, "IP": 6, "T": 7},
}
CLOUD_ALIASES = {"C": "CLR", "CLEAR": "CLR", "BK": "BKN", "OV": "OVC"}
PRECIP_ALIASES = {"NIL": "NONE", "RW": "R", "RS": "R", "SW": "S", "PL": "IP", "TS": "T"}
WEATHER_CODES = {
    "NONE": "NONE", "NO WX": "NONE", "NO WEATHER": "NONE", "": "NONE",
    "HZ": "HAZE", "BR": "MIST", "FG": "FOG", "FZFG": "FOG", "RA": "RAIN", "SHRA": "RAIN", "SN": "SNOW", "DZ": "RAIN",
    "FZDZ": "FREEZING", "FZRA": "FREEZING", "PL": "FREEZING", "TS": "THUNDER", "TSRA": "THUNDER",
}
WEATHER_PHRASES = (
    ("THUNDER", "THUNDER"), ("FREEZ", "FREEZING"), ("SNOW", "SNOW"), ("RAIN", "RAIN"), ("SHOWER", "RAIN"), ("DRIZZLE", "RAIN"),
    ("FOG", "FOG"), ("MIST", "MIST"), ("HAZE", "HAZE"), ("SMOKE", "HAZE"), ("CLOUD", "NONE"), ("FAIR", "NONE"), ("CLEAR", "NONE"),
)


def lookup(key: Column, table: Mapping, default: Column | None = None) -> Column:
    """The table's value of ``key``, else ``default``."""
    entries = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    found = F.try_element_at(entries, key)
    return found if default is None else F.coalesce(found, default)


def _token(x: Column) -> Column:
    return F.upper(F.trim(x))


def cloud_token(x: Column) -> Column:
    t = _token(x)
    return F.when(x.isNull() | (t == ""), "__MISSING__").otherwise(lookup(t, CLOUD_ALIASES, t))


def precip_token(x: Column) -> Column:
    t = _token(x)
    return F.when(x.isNull() | (t == ""), "__MISSING__").otherwise(lookup(t, PRECIP_ALIASES, t))


def weather_token(x: Column) -> Column:
    """A code's family, else that of the first phrase that the text holds."""
    t = _token(x)
    phrase = F.coalesce(*[F.when(F.contains(t, F.lit(needle)), family) for needle, family in WEATHER_PHRASES], F.lit("__UNK__"))
    return F.when(x.isNull(), "__MISSING__").otherwise(lookup(t, WEATHER_CODES, phrase))


def vocabulary_id(token: Column, vocabulary: Mapping[str, int]) -> Column:
    return lookup(token, vocabulary, F.lit(vocabulary["__UNK__"]))


def learned_ids(df: DataFrame, column: str, out: str, known: Sequence[str] | None = None) -> DataFrame:
    """Ids by sorted order of the distinct values, or of the stored values ``known``; unseen and null are -1."""
    if known is not None:
        return df.withColumn(out, F.coalesce(F.array_position(F.array(*map(F.lit, sorted(known))), F.col(column)) - 1, F.lit(-1)).cast("long"))
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    # Sorted by ranges: a value's id is its place in its range and the sizes of the ranges before it, so no task orders all values.
    # Written once: ranges are numbered by one exchange, whatever reads them.
    at = scratch_path(df.sparkSession, "ranges")
    values.repartitionByRange(column).withColumn("__range", F.spark_partition_id()).write.parquet(at)
    ranged = df.sparkSession.read.parquet(at).withColumn("__place", F.row_number().over(Window.partitionBy("__range").orderBy(column)) - 1)
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__size"))
    before = sizes.select("__range", F.coalesce(F.sum("__size").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    ids = ranged.join(F.broadcast(before), "__range").select(column, (F.col("__before") + F.col("__place")).cast("long").alias(out))
    return df.join(ids, column, "left").withColumn(out, F.coalesce(out, F.lit(-1)))


def disagreement_bucket(difference: Column, missing: str = "5f_or_more") -> Column:
    """Bucket of an absolute difference: below 2, below 5, or more; ``missing`` where there is none."""
    size = F.abs(difference)
    return F.when(size.isNull(), missing).when(size < 2, "lt_2f").when(size < 5, "2f_to_5f").otherwise("5f_or_more")


def direction_segment(difference: Column, width: float = 3.0) -> Column:
    return F.when(difference.isNull(), "unknown").when(difference >= width, "warmer").when(difference <= -width, "colder").otherwise("near")


# Regime names, their thresholds below, and weights.
HIGH_REGIMES = ("native_warm_hrrr_cold", "native_cold_hrrr_warm", "hrrr_hot_outlier", "hrrr_cold_outlier", "broad_disagreement")


def row_median(values: Sequence[Column]) -> Column:
    """Median of the non-null values of a row."""
    present = F.array_sort(F.array_compact(F.array(*values)))
    n = F.size(present)
    low, high = F.try_element_at(present, F.floor((n + 1) / 2).cast("int")), F.try_element_at(present, F.floor(n / 2).cast("int") + 1)
    return F.when(n > 0, (low + high) / 2)


def regime(nbm: Column, native: Column, lamp: Column, hrrr: Column) -> Column:
    """The disagreement regime of four sources, by the first rule that holds."""
    everything = [nbm, native, lamp, hrrr]
    spread = F.greatest(*everything) - F.least(*everything)
    middle = row_median(everything)
    others = [nbm, native, lamp]
    complete = nbm.isNotNull() & native.isNotNull() & lamp.isNotNull() & hrrr.isNotNull()
    return (
        F.when(~complete, "unknown")
        .when((native - hrrr >= 3) & (native - middle >= 1) & (hrrr - middle <= -1), "native_warm_hrrr_cold")
        .when((hrrr - native >= 3) & (hrrr - middle >= 1) & (native - middle <= -1), "native_cold_hrrr_warm")
        .when(hrrr - F.greatest(*others) >= 3, "hrrr_hot_outlier")
        .when(F.least(*others) - hrrr >= 3, "hrrr_cold_outlier")
        .when(spread >= 4, "broad_disagreement")
        .when(spread >= 2, "moderate_disagreement")
        .otherwise("tight_consensus")
    )


def reason(regime_: Column, nbm: Column, native: Column, lamp: Column, hrrr: Column) -> Column:
    """Why a row has its regime, in words, with the difference that decided."""
    def told(before: str, x: Column, after: str = "") -> Column:
        return F.concat(F.lit(before), F.format_string("%.1f", F.round(x + 1e-9, 1)), F.lit(after))

    everything = [nbm, native, lamp, hrrr]
    return (
        F.when(regime_ == "unknown", "a source is missing")
        .when(regime_ == "native_warm_hrrr_cold", told("native is ", native - hrrr, " above hrrr"))
        .when(regime_ == "native_cold_hrrr_warm", told("hrrr is ", hrrr - native, " above native"))
        .when(regime_ == "hrrr_hot_outlier", told("hrrr is ", hrrr - F.greatest(nbm, native, lamp), " above all others"))
        .when(regime_ == "hrrr_cold_outlier", told("hrrr is ", F.least(nbm, native, lamp) - hrrr, " below all others"))
        .otherwise(told("sources spread over ", F.greatest(*everything) - F.least(*everything)))
    )


def risk(regime_: Column, spread: Column) -> Column:
    return (
        F.when(regime_ == "unknown", "unknown").when(spread >= 6, "very_high").when(regime_.isin(*HIGH_REGIMES), "high").when(regime_ == "moderate_disagreement", "medium").otherwise("low")
    )


def regime_weight(regime_: Column, specialist: str | None = None) -> Column:
    """Sample weight of a row: high regimes count twice, or a named regime four times and the other high ones 1.5 times."""
    if specialist is None:
        return F.when(regime_.isin(*HIGH_REGIMES), 2.0).otherwise(1.0)
    return F.when(regime_ == specialist, 4.0).when(regime_.isin(*HIGH_REGIMES), 1.5).otherwise(1.0)


#: Weight of the model with the fourth source, by policy and regime.
GUARD_POLICIES: dict[str, Callable[[Column, Column], Column]] = {
    "always_no_hrrr": lambda regime_, risk_: F.lit(0.0),
    "always_with_hrrr": lambda regime_, risk_: F.lit(1.0),
    "with_hrrr_except_native_cold_hrrr_warm": lambda regime_, risk_: F.when(regime_ == "native_cold_hrrr_warm", 0.0).otherwise(1.0),
    "with_hrrr_only_high_or_very_high_disagreement": lambda regime_, risk_: F.when(risk_.isin("high", "very_high"), 1.0).otherwise(0.0),
    "probability_blend_by_regime": lambda regime_, risk_: lookup(
        regime_,
        {"native_cold_hrrr_warm": 0.25, "hrrr_cold_outlier": 0.25, "hrrr_hot_outlier": 0.65, "native_warm_hrrr_cold": 0.65, "broad_disagreement": 0.5, "moderate_disagreement": 0.5, "tight_consensus": 0.35},
        F.lit(0.5),
    ),
}
