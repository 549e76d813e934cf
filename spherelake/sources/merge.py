"""Merging candidates into a store's table along time: joins by kind, and set operations.

Tables are long, with a time column; variables are columns.  A store's time axis is much
smaller than its data, so only axes are compared, and data are filtered by them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def times(df: DataFrame, time: str = "time") -> DataFrame:
    return df.select(time).distinct()


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; the row travels as a struct, so partial aggregation does most of it."""
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.struct(*order))
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).agg(first.alias("_r")).select("_r.*")


def latest(df: DataFrame, time: str, variable: str) -> DataFrame:
    """One row: the last time over everything, and the variables there are, sorted."""
    return df.agg(F.max(time).alias("latest"), F.array_sort(F.collect_set(variable)).alias("variables"))


def combine(parts: list[DataFrame], time: str = "time", order: list[str] | None = None, preprocess: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Files' tables as one: missing columns are NULL, and of repeated times the first file's rows stay.

    ``preprocess`` is applied to each file's table before they are put together.
    """
    out = None
    for i, p in enumerate(parts):
        own = (p.transform(preprocess) if preprocess else p).withColumn("_file", F.lit(i))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    first = out.groupBy(time).agg(F.min("_file").alias("_first"))
    kept = out.join(first, time).where(F.col("_file") == F.col("_first")).drop("_file", "_first")
    return kept.select(*[c for c in kept.columns if c != time], time).orderBy(time, *(order or []))


def combine_by_coords(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """A full outer join on coordinates; where both have a variable, the first that isn't NULL counts."""
    both = [c for c in a.columns if c in b.columns and c not in keys]
    right = b.withColumnsRenamed({c: f"_right_{c}" for c in both})
    met = a.join(right, keys, "full_outer")
    return met.select(*keys, *[(F.coalesce(c, f"_right_{c}").alias(c) if c in both else F.col(c)) for c in [*[c for c in a.columns if c not in keys], *[c for c in b.columns if c not in keys and c not in both]]])


def missing_variables(existing: DataFrame, candidate: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in candidate.columns if c not in existing.columns and c not in keys]


def reindex(axis: DataFrame, df: DataFrame, time: str = "time") -> DataFrame:
    """Every time of the axis, with the data where there are any."""
    return times(axis, time).join(df, time, "left")


def overlapping(existing: DataFrame, candidate: DataFrame, time: str = "time") -> DataFrame:
    """The candidate's rows at times that exist."""
    return candidate.join(times(existing, time), time, "left_semi")


def unseen(existing: DataFrame, candidate: DataFrame, time: str = "time") -> DataFrame:
    """The candidate's rows at times that don't exist."""
    return candidate.join(times(existing, time), time, "left_anti")


def common_times(a: DataFrame, b: DataFrame, time: str = "time") -> DataFrame:
    return a.select(time).intersect(b.select(time))


def same_axis(a: DataFrame, b: DataFrame, time: str = "time") -> bool:
    """Whether two tables have the same times."""
    x, y = times(a, time), times(b, time)
    return x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()


def first_difference(a: DataFrame, b: DataFrame, time: str = "time") -> DataFrame:
    """One row: the first place at which two sorted time axes differ (NULL if none), and their lengths.

    Axes are tables of one row per time step, so a window over one is small.
    """
    place = F.row_number().over(Window.orderBy(time)) - 1
    x, y = times(a, time).select(place.alias("i"), F.col(time).alias("_a")), times(b, time).select(place.alias("i"), F.col(time).alias("_b"))
    met = x.join(y, "i", "full_outer")
    return met.agg(F.min(F.when(~F.col("_a").eqNullSafe(F.col("_b")), F.col("i"))).alias("first_difference"), F.count("_a").alias("n_a"), F.count("_b").alias("n_b"))


def fill_value(kind: T.DataType):
    """What stands for missing in an array-shaped store: NaN, the least integer, or nothing."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return float("nan")
    bits = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}.get(type(kind))
    return None if bits is None else -(1 << (bits - 1))


def pad(existing: DataFrame, candidate: DataFrame, fill: bool = False) -> DataFrame:
    """The candidate with the store's columns, those it lacks NULL (or a fill value by type)."""
    out = []
    for f in existing.schema.fields:
        if f.name in candidate.columns:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(fill_value(f.dataType) if fill else None).cast(f.dataType).alias(f.name))
    return candidate.select(*out)


def append(existing: DataFrame, candidate: DataFrame, time: str = "time", fill: bool = False) -> DataFrame:
    """The store's rows and the candidate's at unseen times.  Doing it twice changes nothing."""
    return existing.unionByName(pad(existing, unseen(existing, candidate, time), fill))


def add_variables(existing: DataFrame, candidate: DataFrame, keys: list[str]) -> DataFrame:
    """The store's rows with the candidate's new variables, on the store's whole axis."""
    new = missing_variables(existing, candidate, keys)
    return existing.join(candidate.select(*keys, *new), keys, "left") if new else existing


def rewrite(existing: DataFrame, candidate: DataFrame, keys: list[str], time: str = "time") -> DataFrame:
    """The store with the candidate's rows in place of its own at times both have; other times stay."""
    both = overlapping(existing, candidate, time)
    # A time that the candidate has counts as rewritten with all its rows.
    kept = existing.join(times(both, time), time, "left_anti")
    return kept.select(*existing.columns).unionByName(pad(existing, both))


def merge(existing: DataFrame | None, candidate: DataFrame, keys: list[str], time: str = "time", replace: bool = False, overwrite_static: bool = False) -> tuple[DataFrame, dict[str, int]]:
    """The merged table and counts of what was done.

    In turn: variables that are missing are added, unseen times appended, and, if asked
    for, existing times rewritten.  Without a store the candidate is it; a candidate
    without a time column replaces the store only if ``overwrite_static``.
    """
    done = {"time_slices_written": 0, "missing_variables_added": 0, "static_writes": 0, "overlapping_times_rewritten": 0}
    if existing is None:
        done["static_writes"] = 1
        done["time_slices_written"] = times(candidate, time).count() if time in candidate.columns else 0
        return candidate, done
    if time not in candidate.columns:
        done["static_writes"] = int(overwrite_static)
        return (candidate if overwrite_static else existing), done
    done["missing_variables_added"] = len(missing_variables(existing, candidate, keys))
    done["time_slices_written"] = times(unseen(existing, candidate, time), time).count()
    out = append(add_variables(existing, candidate, keys), candidate, time)
    if replace:
        done["overlapping_times_rewritten"] = times(overlapping(existing, candidate, time), time).count()
        out = rewrite(add_variables(existing, candidate, keys), candidate, keys, time).unionByName(pad(out, unseen(existing, candidate, time)))
    return out, done
