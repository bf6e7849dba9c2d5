"""Classes of failures and when to try again, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What messages mean, first that fits, and how they are tried again (never, bounded by a budget).
MESSAGES = (
    ("missing_required_fields", "missing_required_fields", "never"), ("no_matching_records", "no_matching_records", "never"), ("unable to locate klga grid cell", "grid_cell_missing", "never"),
    ("did not expose init/valid timestamps", "timestamp_missing", "never"), ("wgrib2 was not found|requires cfgrib|requires xarray", "dependency_missing", "never"), ("no feature rows could be built", "feature_rows_missing", "never"),
    ("broken pipe", "broken_pipe", "bounded"), ("timed? out", "timeout", "bounded"), ("connection reset", "connection_reset", "bounded"), ("connection aborted", "connection_aborted", "bounded"), ("connection refused", "connection_refused", "bounded"),
    ("temporarily unavailable", "temporarily_unavailable", "bounded"), ("service unavailable|http error 50[234]", "remote_service_error", "bounded"), ("too many requests|http error 429", "rate_limited", "bounded"),
)
# Kinds of errors that may pass, that will not, and phases in which others may.
PASSING = (
    "BrokenPipeError", "ChunkedEncodingError", "ConnectTimeout", "ConnectionAbortedError", "ConnectionError", "ConnectionRefusedError", "ConnectionResetError", "OSError", "ProtocolError", "ReadTimeout", "TimeoutError", "URLError",
)
LASTING = ("AssertionError", "FileNotFoundError", "ImportError", "KeyError", "ModuleNotFoundError", "SystemExit", "ValueError")
UNSURE_PHASES = ("crop", "download", "extract", "open", "reduce")
DECODERS = "cfgrib open failed|wgrib2"


def failure(message: Column, kind: Column, phase: Column) -> Column:
    """struct<error_class, mode>: by the message, then by the kind of error, then by the phase; mode is never, bounded, or single (once more).

    A null message, kind or phase tells nothing.
    """
    text, name = F.lower(F.coalesce(message, F.lit(""))), F.trim(F.coalesce(kind, F.lit("")))
    unsure = F.coalesce(phase.isin(*UNSURE_PHASES), F.lit(False))

    def decided(error_class: Column | str, mode: str) -> Column:
        return F.struct((F.lit(error_class) if isinstance(error_class, str) else error_class).alias("error_class"), F.lit(mode).alias("mode"))

    by_message = [F.when(F.rlike(text, F.lit(pattern)), decided(error_class, mode)) for pattern, error_class, mode in MESSAGES]
    file_error = (name == "OSError") & ~unsure & ~F.contains(text, F.lit("pipe"))
    return F.coalesce(
        *by_message,
        F.when(name.isin(*LASTING), decided(F.lower(name), "never")),
        F.when(file_error, decided("os_error", "never")),
        F.when(name.isin(*PASSING), decided(F.lower(name), "bounded")),
        F.when(F.rlike(text, F.lit(DECODERS)), decided("subprocess_or_decode_error", "single")),
        F.when(unsure, decided("transient_phase_error", "single")),
        decided(F.when(name == "", "unknown_error").otherwise(F.lower(name)), "never"),
    )


def try_again(attempt: Column, mode: Column, most: int = 6) -> Column:
    """Whether a failed attempt (from 1) is followed by another."""
    return (attempt < most) & ((mode == "bounded") | ((mode == "single") & (attempt == 1)))


def delay_seconds(attempt: Column, jitter: Column, backoff: float = 2.0, most: float = 30.0, share: float = 0.2) -> Column:
    """Seconds to wait before an attempt: none before the first, then doubled each time up to ``most``, and moved by up to ``share`` as ``jitter`` (0 to 1) says."""
    base = F.least(F.lit(most), backoff * F.pow(F.lit(2.0), F.greatest(attempt - 2, F.lit(0))))
    return F.when(attempt <= 1, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(most), base * (1 - share + 2 * share * jitter))))
