"""Event bins from market JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions.parse import event_bin, let

#: Fields of a market that may hold its label, in order.
TEXT_FIELDS = ("groupItemTitle", "title", "question", "name", "label", "slug", "subtitle", "description")
MARKETS = f"struct<markets:array<struct<{','.join(f'{f}:string' for f in TEXT_FIELDS)},outcomes:string>>>"


def event_bins(documents: DataFrame, text: str, by: list[str]) -> DataFrame:
    """A row for each bin of each document: name, lower, upper; by the first field that parses, one row a name, in order of bounds."""
    # Reading labels takes far longer than their bytes suggest: documents are dealt to all cores, whatever files they come in.
    documents = documents.repartition(4 * documents.sparkSession.sparkContext.defaultParallelism)
    parsed = F.from_json(F.col(text), MARKETS)
    markets = documents.select(*by, F.explode(parsed["markets"]).alias("m"))

    def candidate(c: Column) -> Column:
        return let(event_bin(c), lambda found: F.when(found.isNotNull(), F.struct(F.trim(c).alias("name"), found["lower"].alias("lower"), found["upper"].alias("upper"))))

    texts = F.concat(F.array(*[F.col(f"m.{f}") for f in TEXT_FIELDS]), F.coalesce(F.from_json("m.outcomes", "array<string>"), F.array().cast("array<string>")))
    # a text is parsed only if none before it has, and once: what explode makes is not worked out again by what reads it
    none = F.lit(None).cast("struct<name:string,lower:int,upper:int>")
    first = F.aggregate(F.filter(texts, lambda c: c.isNotNull()), none, lambda found, c: F.coalesce(found, candidate(c)))
    bins = markets.select(*by, F.explode(F.array_compact(F.array(first))).alias("b"))
    return bins.select(*by, "b.*").dropDuplicates([*by, "name"])
