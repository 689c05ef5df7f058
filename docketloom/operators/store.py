"""Keeping the tables of cases and entries: upsert, insert-ignore, nesting, references. Each returns the new state of a table;
``docketloom.sources.sinks.swap`` writes it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest(df: DataFrame, keys: list[str], order: list | None = None) -> DataFrame:
    """One row for each key: the last by ``order`` and then by all columns, so that the choice is always the same.

    The whole row travels as a struct through an aggregate with map-side combining: a key with very many rows costs no
    more than one row a task."""
    order = [c for c in (order or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], *rest)
    return df.groupBy(*keys).agg(F.max(ranked).alias("__top")).select(*keys, *[F.col(f"__top.{c}").alias(c) for c in rest]).select(df.columns)


def upsert(target: DataFrame, source: DataFrame, key: str = "case_id", order: list | None = None) -> DataFrame:
    """``target`` with the rows of ``source`` put in, replacing those with the same key. A source key with several rows counts
    once, with the last by ``order``; null keys of the source are left out, as they can't be stored."""
    clean = newest(source.where(F.col(key).isNotNull()), [key], order).select(target.columns)
    return target.join(clean.select(key), key, "left_anti").select(target.columns).unionByName(clean)


def upsert_status(target: DataFrame, source: DataFrame, key: str = "case_id") -> DataFrame:
    """``new``, ``updated`` or ``failed`` for each row of ``source``, as the target stood before: a row fails without a key."""
    known = target.select(F.col(key).alias("__known")).distinct()
    status = F.when(F.col(key).isNull() | (F.col(key) == ""), "failed").when(F.col("__known").isNotNull(), "updated").otherwise("new")
    return source.join(known, F.col(key) == F.col("__known"), "left").select(key, status.alias("status"))


def save_totals(status: DataFrame) -> DataFrame:
    return status.agg(F.count_if(F.col("status") != "failed").alias("successful"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "new").alias("new"), F.count_if(F.col("status") == "updated").alias("updated"))


def insert_entries(target: DataFrame, source: DataFrame, on_conflict: str = "ignore", order: list | None = None) -> DataFrame:
    """``target`` with the entries of ``source`` whose (case_id, doc_id) it lacks; with ``on_conflict="update"`` the source's win.
    Of several source rows for a key the first by ``order``, then by all columns, is taken."""
    keys = ["case_id", "doc_id"]
    rest = [c for c in source.columns if c not in keys]
    ranked = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order or [])], *rest)
    first = source.dropna(subset=keys).groupBy(*keys).agg(F.min(ranked).alias("__top")).select(*keys, *[F.col(f"__top.{c}").alias(c) for c in rest]).select(target.columns)
    if on_conflict == "update":
        return target.join(first.select(keys), keys, "left_anti").select(target.columns).unionByName(first)
    return target.unionByName(first.join(target.select(keys), keys, "left_anti").select(target.columns))


def nest(cases: DataFrame, entries: DataFrame) -> DataFrame:
    """Cases with their entries as an array in the order of doc_id; an empty array if there are none."""
    columns = [c for c in entries.columns if c != "case_id"]
    lead = ["doc_id", *[c for c in columns if c != "doc_id"]]
    lists = entries.groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct(*lead))).alias("docket_entries"))
    kind = lists.schema["docket_entries"].dataType
    return cases.join(lists, "case_id", "left").withColumn("docket_entries", F.coalesce("docket_entries", F.array().cast(kind)))


def unnest(nested: DataFrame) -> DataFrame:
    """Entries, one to a row, with their place in the array."""
    return nested.select("case_id", F.posexplode("docket_entries").alias("position", "e")).select("case_id", "position", "e.*")


def orphans(entries: DataFrame, cases: DataFrame) -> DataFrame:
    """Entries whose case is not stored."""
    return entries.join(cases.select("case_id"), "case_id", "left_anti")


def without_entries(cases: DataFrame, entries: DataFrame) -> DataFrame:
    return cases.join(entries.select("case_id"), "case_id", "left_anti")


def to_collect(candidates: DataFrame, cases: DataFrame, force: bool = False) -> DataFrame:
    """Candidates that are not stored yet; all of them if forced."""
    return candidates if force else candidates.join(cases.select("case_id"), "case_id", "left_anti")


def unique_stems(new: DataFrame, existing: DataFrame, stem: str = "stem", order: str = "case_id", most: int = 100) -> DataFrame:
    """File stems that clash with nothing: repeats of a stem, and stems that exist, get ``-1``, ``-2``, ... up to ``most``;
    beyond that the name is null."""
    have = existing.groupBy(F.regexp_replace(stem, r"-\d{1,3}$", "").alias("__base")).agg(F.collect_set(stem).alias("__taken"))
    numbered = new.withColumn("__n", F.row_number().over(Window.partitionBy(stem).orderBy(order)))
    joined = numbered.join(have, F.col(stem) == F.col("__base"), "left").join(existing.select(F.col(stem).alias("__own"), F.lit(1).alias("__is")).distinct(), F.col(stem) == F.col("__own"), "left")
    names = F.concat(F.array(F.col(stem)), F.transform(F.sequence(F.lit(1), F.lit(most)), lambda k: F.concat(F.col(stem), F.lit("-"), k.cast("string"))))
    free = F.array_except(names, F.coalesce(F.concat(F.coalesce("__taken", F.array().cast("array<string>")), F.when(F.col("__is") == 1, F.array(F.col(stem))).otherwise(F.array().cast("array<string>"))), F.array().cast("array<string>")))
    return joined.withColumn("unique_stem", F.get(free, F.col("__n") - 1)).select(*new.columns, "unique_stem")
