"""Reducers: checkpoints, modes, revisions, islands, coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_labels(observations: DataFrame, by: Sequence[str], value: str, time: str, amount: str, source: str | None = None) -> DataFrame:
    """Per key: max, min and count of ``value``, sum of ``amount`` (null as 0), first and last time, and the bin of the max (half to even)."""
    out = observations.groupBy(*by).agg(
        F.max(value).alias("final_tmax"), F.min(value).alias("final_tmin"), F.sum(F.coalesce(F.col(amount), F.lit(0))).alias("total_precip"),
        F.count("*").alias("obs_count"), F.min(time).alias("first_obs"), F.max(time).alias("last_obs"), *([F.min(source).alias("source_file")] if source else []),
    )
    return out.withColumn("market_bin", F.concat(F.bround("final_tmax", 0).cast("long").cast("string"), F.lit("F")))


def running_max(value: str, by: Sequence[str], order: Sequence[str]) -> Column:
    """Running maximum; a null row stays null and later rows keep the maximum."""
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return F.when(F.col(value).isNotNull(), F.max(value).over(window))


def checkpoints(df: DataFrame, by: Sequence[str], hour: str, value: str, order: Column, hours: Sequence[int], rule: str) -> DataFrame:
    """A column for each hour: the value there by ``rule``.

    Rules for several rows in an hour: first_non_null, first_row (its null
    stays) and last_row (its null stays).
    """
    def at(h: int) -> Column:
        there = F.col(hour) == h
        if rule == "first_non_null":
            return F.min_by(F.col(value), F.when(there & F.col(value).isNotNull(), order))
        return (F.min_by if rule == "first_row" else F.max_by)(F.col(value), F.when(there, order))

    out = df.where(F.col(hour).isin(*hours)).groupBy(*by).agg(*[at(h).alias(f"at_{h:02d}") for h in hours], F.countDistinct(hour).alias("covered_hours"))
    missing = sum((F.col(f"at_{h:02d}").isNull().cast("long") for h in hours), F.lit(0).cast("long"))
    return out.withColumn("missing_checkpoint_count", missing)


def stable_mode(value: str) -> Column:
    """The most frequent value, the least of equals."""
    return F.mode(value, True)


def first_argmax(df: DataFrame, by: Sequence[str], value: str, position: str, out: str) -> DataFrame:
    """The least ``position`` with the largest value."""
    return df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.max_by(position, F.struct(F.col(value), -F.col(position))).alias(out))


def distinct_text(column: str, separator: str = ";") -> Column:
    """The distinct values, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(column)), separator)


def keep_first(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row of each key, the first in a total order."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def anchor_cycle(df: DataFrame, by: Sequence[str], cycle: str, slot: str, rank: Column, expected: int) -> DataFrame:
    """Of each key's cycles that with all slots and the lowest rank, else that with most slots and then the lowest rank."""
    covered = df.groupBy(*by, cycle).agg(F.countDistinct(slot).alias("covered"), F.min(rank).alias("rank"))
    window = Window.partitionBy(*by).orderBy(F.desc(F.col("covered") >= expected), F.when(F.col("covered") >= expected, 0).otherwise(-F.col("covered")), "rank", cycle)
    return covered.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").select(*by, cycle, "covered", (F.col("covered") >= expected).alias("full_coverage"))


def merge_ranges(df: DataFrame, by: Sequence[str], start: str, end: str, max_gap: float = 0) -> DataFrame:
    """Ranges whose gap is at most ``max_gap``, merged: start, end and how many there were."""
    before = Window.partitionBy(*by).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*by).orderBy(start, end).rowsBetween(Window.unboundedPreceding, 0)
    reached = F.max(end).over(before)
    marked = df.withColumn("__new", F.when(reached.isNull() | (F.col(start) > reached + max_gap), 1).otherwise(0))
    islands = marked.withColumn("__island", F.sum("__new").over(upto))
    return islands.groupBy(*by, "__island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n_ranges")).drop("__island")


def revision(latest: DataFrame, previous: DataFrame, on: Sequence[str], values: Sequence[str]) -> DataFrame:
    """latest - previous of each value, null where either is missing."""
    earlier = previous.select(*on, *[F.col(v).alias(f"__previous_{v}") for v in values])
    return latest.join(earlier, list(on), "left").select(*on, *values, *[(F.col(v) - F.col(f"__previous_{v}")).alias(f"{v}_revision") for v in values])


def date_spine(bounds: DataFrame, first: str, last: str, by: Sequence[str], out: str) -> DataFrame:
    """A row for each key and day between its bounds."""
    return bounds.select(*by, F.explode(F.sequence(first, last)).alias(out))


def vector_mean(u: str, v: str) -> tuple[Column, Column]:
    """Speed and direction (from, in degrees) of the mean vector."""
    mu, mv = F.avg(u), F.avg(v)
    return F.sqrt(mu * mu + mv * mv), F.when((mu == 0) & (mv == 0), None).otherwise(F.pmod(270.0 - F.degrees(F.atan2(mv, mu)), F.lit(360.0)))


def provenance(df: DataFrame, keys: Sequence[str], features: dict[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """A row for each row and feature: status and the sources that were there.

    ``features``: name -> (kind, source columns). Kinds: direct (present or
    missing), derived (needs all sources) and fallback (the first source is the
    feature proper; any other that stands in is a fallback).
    """
    def entry(name: str, kind: str, sources: Sequence[str]) -> Column:
        there = F.array_compact(F.array(*[F.when(F.col(s).isNotNull(), F.lit(s)) for s in sources]))
        if kind == "derived":
            status = F.when(F.size(there) == len(sources), "derived").otherwise("missing_optional")
        elif kind == "fallback":
            status = F.when(F.col(sources[0]).isNotNull(), "present").when(F.size(there) > 0, "fallback").otherwise("missing_optional")
        else:
            status = F.when(F.size(there) > 0, "present").otherwise("missing_optional")
        return F.struct(F.lit(name).alias("feature"), status.alias("status"), F.array_join(there, ";").alias("sources"))

    return df.select(*keys, F.explode(F.array(*[entry(n, k, s) for n, (k, s) in features.items()])).alias("__p")).select(*keys, "__p.*")


def first_available(df: DataFrame, names: Sequence[str]) -> Column:
    """The first of the named columns that the frame has and that is not null; null if it has none."""
    have = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*have) if have else F.lit(None)


def without_source(df: DataFrame, prefix: str) -> DataFrame:
    """The frame without one source's columns, for ablations."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def first_pattern(column: str, patterns: Sequence[tuple[str, str]]) -> Column:
    """The name of the first pattern that the text fits; null if none does."""
    return F.coalesce(*[F.when(F.rlike(F.col(column), F.lit(p)), F.lit(name)) for name, p in patterns])


def signature(columns: Sequence[str]) -> Column:
    """SHA-256 of a row's values as text, null as the empty text: equal rows can be reused."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)


def crop_box(cells: DataFrame, keys: Sequence[str], lat: tuple[float, float], lon: tuple[float, float]) -> DataFrame:
    """First and last row and column of the cells within the bounds; longitudes in either convention (0..360 or -180..180; others are in no box)."""
    west = F.when(F.col("lon") >= 180, F.col("lon") - 360.0).otherwise(F.col("lon"))
    return cells.where(F.col("lat").between(*lat) & west.between(*lon)).groupBy(*keys).agg(F.min("row").alias("row_first"), F.max("row").alias("row_last"), F.min("col").alias("col_first"), F.max("col").alias("col_last"), F.count("*").alias("n_cells"))


def any_token(token: Column, missing: Sequence[str] = ("", "NG", "NONE")) -> Column:
    """Whether any row has a token that is none of ``missing``; false without rows."""
    t = F.upper(F.trim(token))
    return F.coalesce(F.bool_or(t.isNotNull() & ~t.isin(*missing)), F.lit(False))


def any_positive(value: str) -> Column:
    """Whether any number is above zero; null without numbers."""
    return F.bool_or(F.col(value) > 0)


def slots_or_rows(slot: str) -> Column:
    """Distinct slots, or the rows where no row has a slot."""
    return F.when(F.count(slot) > 0, F.countDistinct(slot)).otherwise(F.count("*"))


def hourly(reducer: str, value: str | Column, where: Column | None = None) -> Column:
    """max, min, mean or sum of the numbers, within ``where``; null without any."""
    x = F.nanvl((F.col(value) if isinstance(value, str) else value).cast("double"), F.lit(None))
    return {"max": F.max, "min": F.min, "mean": F.avg, "sum": F.sum}[reducer](x if where is None else F.when(where, x))


def bulletin_day(df: DataFrame, by: Sequence[str], hour: str, order: Column) -> DataFrame:
    """A bulletin's day summary: columns forecast_hour, tmp, cld, cig, vis, obv, p01, p06, p12, pos, poz and typ.

    The morning is local hours 6 to 12, both included; the flag of low ceilings
    or visibility holds at 10 (hundreds of feet) or 3 miles. Modes take the
    least of equals.
    """
    morning = F.col(hour).between(6, 12)
    token = F.upper(F.trim("typ"))
    real = F.when(~token.isin("", "NG", "NONE"), F.col("typ"))
    out = df.groupBy(*by).agg(
        F.min("forecast_hour").alias("forecast_hour_min"), F.max("forecast_hour").alias("forecast_hour_max"), F.count("*").alias("target_day_row_count"),
        F.max("tmp").alias("day_tmp_max_f"), F.min("tmp").alias("day_tmp_min_f"), F.min_by(F.col(hour), F.when(F.col("tmp").isNotNull(), F.struct(-F.col("tmp"), order))).alias("day_tmp_argmax_local_hour"),
        F.mode(F.when(morning, F.col("cld")), True).alias("morning_cld_mode"), F.min(F.when(morning, F.col("cig"))).alias("morning_cig_min"), F.min(F.when(morning, F.col("vis"))).alias("morning_vis_min"),
        any_token(F.when(morning, F.col("obv"))).alias("morning_obv_any"), *[F.max(p).alias(f"day_{p}_max_pct") for p in ("p01", "p06", "p12", "pos", "poz")],
        any_token(F.col("typ")).alias("day_precip_type_any"), F.mode(real, True).alias("day_precip_type_mode"),
    )
    low = (F.col("morning_cig_min") <= 10) | (F.col("morning_vis_min") <= 3)
    return out.withColumns({"day_tmp_range_f": F.col("day_tmp_max_f") - F.col("day_tmp_min_f"), "morning_ifr_like_any": F.coalesce(low, F.lit(False))})


# The columns of a gridded day summary, by kind.
GRID_HOURS = {
    "temp_2m_{h}_local_k": ("tmp_2m_k", (6, 9, 12, 15, 18)), "dewpoint_2m_{h}_local_k": ("dpt_2m_k", (6, 9, 12, 15, 18)), "rh_2m_{h}_local_pct": ("rh_2m_pct", (6, 9, 12, 15, 18)),
    "u10m_{h}_local_ms": ("ugrd_10m_ms", (9, 12, 15, 18)), "v10m_{h}_local_ms": ("vgrd_10m_ms", (9, 12, 15, 18)), "wind_10m_{h}_local_speed_ms": ("wind_10m_speed_ms", (9, 12, 15, 18)),
    "mslp_{h}_local_pa": ("mslma_pa", (9, 12, 15)), "surface_pressure_{h}_local_pa": ("surface_pressure_pa", (9,)),
}
GRID_WIND_HOURS = (9, 12, 15, 18)
GRID_REDUCED = {
    "tcdc_day_mean_pct": ("tcdc_entire_pct", "mean", "day"), "tcdc_morning_mean_pct": ("tcdc_entire_pct", "mean", "morning"), "tcdc_afternoon_mean_pct": ("tcdc_entire_pct", "mean", "afternoon"), "tcdc_day_max_pct": ("tcdc_entire_pct", "max", "day"),
    "mcdc_day_mean_pct": ("mcdc_mid_pct", "mean", "day"), "hcdc_day_mean_pct": ("hcdc_high_pct", "mean", "day"), "mcdc_afternoon_mean_pct": ("mcdc_mid_pct", "mean", "afternoon"), "hcdc_afternoon_mean_pct": ("hcdc_high_pct", "mean", "afternoon"),
    "dswrf_day_max_w_m2": ("dswrf_surface_w_m2", "max", "day"), "pwat_day_mean_kg_m2": ("pwat_entire_atmosphere_kg_m2", "mean", "day"), "hpbl_day_max_m": ("hpbl_m", "max", "day"), "temp_2m_day_max_k": ("tmp_2m_k", "max", "day"),
    "temp_2m_day_mean_k": ("tmp_2m_k", "mean", "day"), "rh_2m_day_min_pct": ("rh_2m_pct", "min", "day"), "wind_10m_day_max_ms": ("wind_10m_speed_ms", "max", "day"), "gust_day_max_ms": ("gust_surface_ms", "max", "day"),
    "lcdc_morning_mean_pct": ("lcdc_low_pct", "mean", "morning"), "dlwrf_night_mean_w_m2": ("dlwrf_surface_w_m2", "mean", "night"), "apcp_day_total_kg_m2": ("apcp_surface_kg_m2", "sum", "day"), "cape_day_max_j_kg": ("cape_surface_j_kg", "max", "day"),
    "cape_afternoon_max_j_kg": ("cape_surface_j_kg", "max", "afternoon"), "cin_day_min_j_kg": ("cin_surface_j_kg", "min", "day"), "cin_afternoon_min_j_kg": ("cin_surface_j_kg", "min", "afternoon"), "refc_day_max": ("refc_entire_atmosphere", "max", "day"),
    "ltng_day_max": ("ltng_entire_atmosphere", "max", "day"), "mslp_day_mean_pa": ("mslma_pa", "mean", "day"), "temp_1000mb_day_mean_k": ("tmp_1000mb_k", "mean", "day"), "temp_925mb_day_mean_k": ("tmp_925mb_k", "mean", "day"),
    "temp_850mb_day_mean_k": ("tmp_850mb_k", "mean", "day"), "rh_925mb_day_mean_pct": ("rh_925mb_pct", "mean", "day"), "temp_2m_k_nb3_day_mean": ("tmp_2m_k_nb3_mean", "mean", "day"), "temp_2m_k_crop_day_mean": ("tmp_2m_k_crop_mean", "mean", "day"),
    "tcdc_entire_pct_crop_day_mean": ("tcdc_entire_pct_crop_mean", "mean", "day"), "dswrf_surface_w_m2_crop_day_max": ("dswrf_surface_w_m2_crop_max", "max", "day"), "pwat_entire_atmosphere_kg_m2_nb7_day_mean": ("pwat_entire_atmosphere_kg_m2_nb7_mean", "mean", "day"),
    "u925_day_mean_ms": ("ugrd_925mb_ms", "mean", "day"), "v925_day_mean_ms": ("vgrd_925mb_ms", "mean", "day"), "u850_day_mean_ms": ("ugrd_850mb_ms", "mean", "day"), "v850_day_mean_ms": ("vgrd_850mb_ms", "mean", "day"),
    "hgt_925_day_mean_gpm": ("hgt_925mb_gpm", "mean", "day"), "hgt_700_day_mean_gpm": ("hgt_700mb_gpm", "mean", "day"),
}


def gridded_day(df: DataFrame, by: Sequence[str], hour: str, order: Column, prefix: str = "") -> DataFrame:
    """The gridded day summary in one aggregate: values at local hours (the last row of an hour, its null stays), reductions over the day and its parts, lightning, and the mean speed at 850 mb.

    Morning is [6, 12), afternoon [12, 18), night up to and with 6. Columns
    that ``df`` lacks count as null.
    """
    have = set(df.columns)
    h = F.col(hour)
    parts = {"day": None, "morning": (h >= 6) & (h < 12), "afternoon": (h >= 12) & (h < 18), "night": h <= 6}

    def column(name: str) -> Column:
        return F.nanvl(F.col(name).cast("double"), F.lit(None)) if name in have else F.lit(None).cast("double")

    def at(name: str, k: int) -> Column:
        return F.max_by(column(name), F.when(h == k, order))

    speed = F.sqrt(column("ugrd_850mb_ms") * column("ugrd_850mb_ms") + column("vgrd_850mb_ms") * column("vgrd_850mb_ms"))
    aggregates = [at(source, k).alias(prefix + out.format(h=f"{k:02d}")) for out, (source, hours) in GRID_HOURS.items() for k in hours]
    aggregates += [hourly(reducer, column(source), parts[part]).alias(prefix + out) for out, (source, reducer, part) in GRID_REDUCED.items()]
    aggregates += [F.bool_or(column("ltng_entire_atmosphere") > 0).alias(f"{prefix}ltng_day_any"), F.avg(speed).alias(f"{prefix}wind_850mb_speed_day_mean_ms")]
    found = df.groupBy(*by).agg(*aggregates)
    u, v = (lambda k, c=c: F.col(f"{prefix}{c}10m_{k:02d}_local_ms") for c in "uv")
    directions = {f"{prefix}wind_10m_{k:02d}_local_direction_deg": F.when((u(k) == 0) & (v(k) == 0), None).otherwise(F.pmod(270.0 - F.degrees(F.atan2(v(k), u(k))), F.lit(360.0))) for k in GRID_WIND_HOURS}
    return found.withColumns(directions)


def lag_revisions(df: DataFrame, by: Sequence[str], newest: Sequence[Column | str], values: Sequence[str], lags: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """The newest row of each key, with its values less those of the ``lags``-th rows before it; null where there is none.

    ``newest`` orders from the newest row on.
    """
    order = Window.partitionBy(*by).orderBy(*newest)
    earlier = [F.lead(v, k).over(order).alias(f"__{v}_{k}") for v in values for k in lags]
    found = df.select("*", F.row_number().over(order).alias("__place"), *earlier).where("__place = 1")
    return found.select(*df.columns, *[(F.col(v) - F.col(f"__{v}_{k}")).alias(f"{v}_rev_{k}cycle") for v in values for k in lags])


def unique_or_error(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df``, or an error where a key repeats. One row of each key is joined to nothing: the check is the key's own aggregate."""
    first = df.groupBy(*by).agg(F.count("*").alias("__n"), *[F.first(c).alias(c) for c in df.columns if c not in by])
    return first.where(F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("repeated key: "), F.concat_ws(", ", *[F.col(c).cast("string") for c in by]))).cast("boolean")).otherwise(True)).select(df.columns)


def pivoted(df: DataFrame, by: Sequence[str], name: str, names: Sequence[str], values: Sequence[str], order: Column) -> DataFrame:
    """A column for each of ``names`` and each of ``values`` (name_value): the first in order."""
    return df.where(F.col(name).isin(*names)).groupBy(*by).agg(*[F.min_by(F.col(v), F.when(F.col(name) == n, order)).alias(f"{n}_{v}") for n in names for v in values])


def prefix_counts(names: Sequence[str], prefixes: Sequence[str]) -> dict[str, int]:
    """Columns by the first prefix that they begin with; the others under other."""
    out = dict.fromkeys([*prefixes, "other"], 0)
    for n in names:
        out[next((p for p in prefixes if n.startswith(p)), "other")] += 1
    return out
