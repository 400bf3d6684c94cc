"""Schema snapshots: tables, columns and value hints of a domain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stats import distinct_values, ordered_tokens, top_counts
from .prompts import schema_text

# Fixed values: (table, column, most values) of each domain's hints.
DISTINCT = {
    "education": [("counties", "county_name", 30), ("localities", "residency_area", 10), ("schools", "unit_type", 10)],
    "trains": [("trains", "operator_name", 20), ("stations", "station_name", 40), ("timetables", "day_type", 20)],
}


def hints(tables: dict[str, DataFrame], domain: str) -> DataFrame:
    """(key, values): distinct values in order, and for the domains that have them level tokens or the stations with most stops.  Domains
    without presets have no hints.  Reports of a few dozen values each."""
    parts = []
    for t, c, n in DISTINCT.get(domain, []):
        values = distinct_values(tables[t], c, n).agg(F.array_sort(F.collect_list("value")).alias("values"))
        parts.append(values.select(F.lit(f"{t}.{c}").alias("key"), "values"))
    if domain == "education":
        raw = distinct_values(tables["schools"], "education_level", 200)
        tokens = ordered_tokens(raw, "value", ["value"], 20).agg(F.array_sort(F.collect_list(F.struct("place", "token"))).alias("x"))
        parts.append(tokens.select(F.lit("schools.education_level_tokens").alias("key"), F.transform("x", lambda r: r["token"]).alias("values")))
    if domain == "trains":
        top = top_counts(tables["timetables"], tables["stations"], "station_id", "station_name", 20)
        order = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "station_name"))).alias("x"))
        parts.append(order.select(F.lit("stations.top_station_names").alias("key"), F.transform("x", lambda r: r["station_name"]).alias("values")))
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    if out is None:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "key string, values array<string>")
    return out


def snapshot(tables: dict[str, DataFrame], domain: str, db_id: str, most: int = 10) -> str:
    """The text of a domain's schema and hints."""
    spark = next(iter(tables.values())).sparkSession
    columns = spark.createDataFrame([(n, df.columns) for n, df in tables.items()], "name string, columns array<string>")
    return schema_text(columns, hints(tables, domain), domain, db_id, most).first().text
