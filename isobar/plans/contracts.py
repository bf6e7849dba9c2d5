"""Registries of ordered columns, their audit, and the normalised registry derived from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.functions.units import SUFFIXES, TO_SI, TRANSFORMS

PREFIXES = ("label_", "meta_", "wu_", "nbm_", "lamp_", "hrrr_", "station_", "target_", "anchor_")


def column(name: str, kind: str, role: str, freeze: str = "core_required", units: str = "") -> T.StructField:
    types = {"string": T.StringType(), "float64": T.DoubleType(), "int64": T.LongType(), "bool": T.BooleanType(), "date": T.DateType()}
    return T.StructField(name, types[kind], True, {"role": role, "freeze": freeze, "units": units})


def registry(*columns: T.StructField) -> T.StructType:
    return T.StructType(list(columns))


def layout(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The registry's columns in order; missing ones null, booleans false where unknown, others gone."""
    have = set(df.columns)
    out = []
    for f in schema:
        c = (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType)
        if isinstance(f.dataType, T.BooleanType):
            c = F.coalesce(c, F.lit(False))
        out.append(c.alias(f.name, metadata=f.metadata))
    return df.select(out)


def normalised_registry(schema: T.StructType) -> list[tuple[str, str, str]]:
    """(source, transform, name) of every column: unit suffixes are converted, other columns copied."""
    out = []
    for f in schema:
        suffix = max((s for s in SUFFIXES if f.name.endswith(s)), key=len, default=None)
        out.append((f.name, *((SUFFIXES[suffix][0], f.name[: -len(suffix)] + SUFFIXES[suffix][1]) if suffix else ("copy", f.name))))
    return out


def leaks(names: Sequence[str], exact: Sequence[str] = (), prefixes: Sequence[str] = ("label_", "target_residual"), parts: Sequence[str] = ("observed_", "final_t")) -> list[str]:
    """Names that a model must not see."""
    return [n for n in names if n in exact or n.startswith(tuple(prefixes)) or any(p in n for p in parts)]


#: Parts of names of time codes, which are numbers but no features.
TIME_CODES = ("_time_", "_code", "_utc", "_local_minutes")


def _has_converted(name: str, names: set[str]) -> bool:
    """Whether the same quantity stands beside it in converted units."""
    if name.endswith("_k") and f"{name[:-2]}_f" in names or name.endswith("_ms") and f"{name[:-3]}_mph" in names:
        return True
    return "_kt_" in name and name.replace("_kt_", "_mph_") in names


def why_not(df: DataFrame, name: str, exclude: Sequence[str] = ()) -> str:
    """Why a model may not see a column; feature if it may."""
    if name in exclude or leaks([name]):
        return "leak"
    if name.startswith("meta_"):
        return "meta"
    if not isinstance(df.schema[name].dataType, (T.NumericType, T.BooleanType)):
        return "not numeric"
    if any(part in name for part in TIME_CODES):
        return "time code"
    return "converted" if _has_converted(name, set(df.columns)) else "feature"


def feature_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric and boolean columns that are neither labels, identity nor time codes, each quantity in one unit only."""
    return [n for n in df.columns if why_not(df, n, exclude) == "feature"]


def within(day: Column, first: str | None, last: str | None) -> Column:
    """Closed window of ISO days; an end that is None is open."""
    text = day.cast("string")
    return (F.lit(True) if first is None else text >= first) & (F.lit(True) if last is None else text <= last)


def in_window(df: DataFrame, day: str, first: str | None, last: str | None) -> DataFrame:
    """``df`` within the window; compared as dates, so that the filter reaches the scan where the column is one."""
    for bound, side in ((first, "ge"), (last, "le")):
        if bound is not None:
            d = F.lit(bound).cast("date")
            df = df.where(F.col(day) >= d if side == "ge" else F.col(day) <= d)
    return df


def finite(x: Column) -> Column:
    """Whether a number is there and finite."""
    v = x.cast("double")
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))


def eligible(available: Sequence[Column], core: Sequence[str]) -> Column:
    """All sources available (unknown is not) and all core columns finite."""
    out = F.lit(True)
    for a in available:
        out = out & F.coalesce(a, F.lit(False))
    for c in core:
        out = out & finite(F.col(c))
    return out


def renamed(df: DataFrame, names: Mapping[str, str], prefixes: Mapping[str, str] | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """Columns renamed, then prefixed (by their new names), then only those in ``keep``, in its order."""
    prefixes = prefixes or {}
    new = {c: names.get(c, c) for c in df.columns}
    out = df.select(*[F.col(f"`{c}`").alias(prefixes.get(n, "") + n) for c, n in new.items()])
    return out if keep is None else out.select(*keep)


def canonical(df: DataFrame, schema: T.StructType, mapping: Mapping[str, tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """``df`` in a shared schema: column <- (own column, transform), columns of one name as they are, others null; and the columns ``keep``."""
    transforms = TRANSFORMS | TO_SI

    def value(f: T.StructField) -> Column:
        if f.name in mapping and mapping[f.name][0] in df.columns:
            own, transform = mapping[f.name]
            return F.col(own) if transform == "copy" else transforms[transform](F.col(own).cast("double"))
        return F.col(f.name) if f.name in df.columns and f.name not in mapping else F.lit(None)

    return df.select(*keep, *[value(f).cast(f.dataType).alias(f.name) for f in schema])


def legacy_aliases(names: Sequence[str]) -> list[str]:
    """Columns named in an earlier way."""
    return sorted(n for n in names if n.endswith("_nearest") or "_3x3_" in n or "_7x7_" in n)


def surface(missing: Sequence[str], legacy: Sequence[str], longitude: str, on_grid: bool = True) -> str:
    """synced, partially synced or divergent: by how many of missing columns, old aliases and another longitude convention (on grids) there are."""
    problems = bool(missing) + bool(legacy) + (on_grid and longitude != "-180..180")
    return ("synced", "partially synced")[problems] if problems < 2 else "divergent"


def matrix(spark: SparkSession, features: Sequence[str], sources: Mapping[str, Sequence[str]]) -> DataFrame:
    """A row for each feature of the schema: whether each source has it, and how widely it is shared."""
    names = {0: "absent", 1: "one source", len(sources): "shared"}
    rows = [(f, *(f in own for own in sources.values())) for f in features]
    return spark.createDataFrame([(*r, names.get(sum(r[1:]), "partly shared")) for r in rows], "feature string, " + ", ".join(f"{s} boolean" for s in sources) + ", status string")


def experiment_audit(df: DataFrame, key: Sequence[str], label: str, anchor: str, residual: str, cut: str, expected_cut: Column, forbidden: Sequence[str], units_of: Mapping[str, str], tolerance: float = 1e-6) -> DataFrame:
    """One row of counts of what is wrong with an experiment's table; all zero but row_count if nothing is."""
    labelled = finite(F.col(label))
    wrong = {
        "label_missing": ~labelled,
        "anchor_missing": labelled & ~finite(F.col(anchor)),
        "residual_mismatch": F.coalesce(F.abs(F.col(residual) - (F.col(label) - F.col(anchor))) > tolerance, F.lit(False)),
        "cutoff_mismatch": F.coalesce(F.col(cut) != expected_cut, F.lit(True)),
    }
    by_key = df.groupBy(*key).agg(F.count("*").alias("__n"), *[F.count_if(c).alias(n) for n, c in wrong.items()])
    names = [c for c in df.columns if c.startswith(tuple(forbidden))]
    units = [c for c, u in units_of.items() if not c.endswith(f"_{u}")]
    return by_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("row_count"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in wrong], F.count_if(F.col("__n") > 1).alias("duplicate_keys"),
        F.lit(len(names)).cast("long").alias("forbidden_columns"), F.lit(len(units)).cast("long").alias("unit_violations"),
    )


def audit(df: DataFrame, schema: T.StructType, key: Sequence[str], model_inputs: bool = False, violations: dict[str, Column] | None = None) -> DataFrame:
    """One row: what breaks the contract, and how many rows fulfil each condition of ``violations``.

    Names are checked on the driver. Values are checked in one pass: sums by
    key, then sums of those, so a repeated key is seen on the way.
    """
    names, violations = df.columns, violations or {}
    core = [f.name for f in schema if f.metadata.get("freeze") == "core_required" and f.name in names]
    missing = [n for n in schema.names if n not in names]
    unknown = [n for n in names if n not in schema.names]
    strings = [f.name for f in df.schema if model_inputs and isinstance(f.dataType, T.StringType) and not f.name.startswith(("meta_", "station_"))]
    policy = [n for n in names if not n.startswith(PREFIXES) and n not in key]
    nulls = sum((F.col(c).isNull().cast("long") for c in core), F.lit(0).cast("long"))
    by_key = df.groupBy(*key).agg(F.count("*").alias("__n"), F.sum(nulls).alias("__nulls"), *[F.count_if(c).alias(f"__v_{n}") for n, c in violations.items()])

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0).cast("long"))

    counts = by_key.agg(total(F.col("__n")).alias("row_count"), total(F.col("__nulls")).alias("core_nulls"), F.count_if(F.col("__n") > 1).alias("duplicate_keys"), *[total(F.col(f"__v_{n}")).alias(n) for n in violations])
    return counts.select(
        "row_count", "core_nulls", "duplicate_keys", F.lit(names == schema.names).alias("exact_layout"), F.lit(len(missing)).cast("long").alias("missing_columns"), F.lit(len(unknown)).cast("long").alias("unknown_columns"),
        F.lit(len(policy)).cast("long").alias("prefix_violations"), F.lit(len(strings)).cast("long").alias("string_inputs"),
        ((F.col("row_count") > 0) & (F.col("duplicate_keys") == 0) & F.lit(not missing and not unknown and not policy and not strings)).alias("passed"), *violations,
    )


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: null rate, and sample variance of numbers (null under two values). One aggregate, then a row a column."""
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    found = df.agg(
        F.count("*").alias("n"),
        *[F.struct(F.avg(F.col(c).isNull().cast("double")).alias("null_rate"), (F.var_samp(F.col(c).cast("double")) if c in numeric else F.lit(None).cast("double")).alias("variance")).alias(c) for c in columns],
    )
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c)["null_rate"].alias("null_rate"), F.col(c)["variance"].alias("variance")) for c in columns]))
    return found.select("n", rows.alias("r")).select("r.column", "n", "r.null_rate", "r.variance")
