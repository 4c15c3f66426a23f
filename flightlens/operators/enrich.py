"""Flight enrichment: departure and arrival country by equi-join.

Replaces the reference's two driver-side lookups per flight with two joins
against the deduplicated airport dimension. Semantics kept:

* F2: a flight needs both ICAO codes non-empty (NULL and ``''`` drop it);
* F3: both countries must be found and non-empty: inner joins against a
  dimension that only holds non-empty countries;
* lookups are exact and case-sensitive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dims import broadcast_if_small


def with_countries(flights: DataFrame, dimension: DataFrame,
                   dep_code: str = "dep_icao", arr_code: str = "arr_icao",
                   airport_names_from_dimension: bool = False,
                   max_broadcast_bytes: int | None = None,
                   persist_dimension: bool = True,
                   size_checked: bool = False) -> DataFrame:
    """Add ``departure_country`` and ``arrival_country`` by two equi-joins.

    ``dimension`` must have one row per ``id`` (see ``airport_dimension``).
    When it is small enough it is broadcast once and both joins reuse it, so
    the flights are never shuffled; otherwise both joins shuffle on the codes.
    With ``airport_names_from_dimension`` the airport names also come from the
    dimension (used when the flight records carry codes only). A caller that
    manages the dimension's caching itself passes ``persist_dimension=False``;
    one that already ran ``broadcast_if_small`` on it passes ``size_checked=True``.
    """
    if size_checked:
        dim = dimension
    else:
        dim, _ = broadcast_if_small(dimension, max_broadcast_bytes, persist=persist_dimension)
    kept = flights.where((F.col(dep_code) != "") & (F.col(arr_code) != ""))

    def side(prefix: str, code: str) -> DataFrame:
        cols = [F.col("id").alias(code), F.col("country_name").alias(f"{prefix}_country")]
        if airport_names_from_dimension:
            cols.append(F.col("airport_name").alias(f"{prefix}_airport"))
        return dim.select(*cols)

    return (kept
            .join(side("departure", dep_code), on=dep_code, how="inner")
            .join(side("arrival", arr_code), on=arr_code, how="inner"))


def with_countries_or_reason(flights: DataFrame, dimension: DataFrame, dep_code: str = "dep_icao",
                             arr_code: str = "arr_icao") -> DataFrame:
    """``flights`` with both countries, and ``reject_reason`` where one is missing (F2, F3); no row is dropped.

    ``flights`` has a ``reject_reason`` (NULL where the record is readable),
    which wins. Rows without a reason are those that ``with_countries`` keeps.
    """
    dim, _ = broadcast_if_small(dimension, persist=False)

    def side(prefix: str, code: str) -> DataFrame:
        return dim.select(F.col("id").alias(code), F.col("country_name").alias(f"{prefix}_country"))

    def missing(code: str):
        return F.coalesce(F.col(code), F.lit("")) == ""

    joined = flights.join(side("departure", dep_code), dep_code, "left").join(side("arrival", arr_code), arr_code, "left")
    return joined.withColumn("reject_reason", F.coalesce(
        F.col("reject_reason"),
        F.when(missing(dep_code), F.lit("departure code is missing"))
        .when(missing(arr_code), F.lit("arrival code is missing"))
        .when(F.col("departure_country").isNull(), F.lit("departure airport is unknown"))
        .when(F.col("arrival_country").isNull(), F.lit("arrival airport is unknown"))))


def lookup_country(airports_dimension: DataFrame, icao_code: str) -> DataFrame:
    """Point lookup of one airport (F5): ``WHERE id = <code>``, one row or none."""
    return (airports_dimension
            .where(F.col("id") == F.lit(icao_code))
            .select("id", "country_name"))
