"""Catalog queries over a registry table of datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainframe.functions.domain import dataset_ref, is_semver, semver
from chainframe.operators.ordered import numbered

#: Ages in days of the last-updated buckets, each within the next.
BUCKETS = {"last_day": 1, "last_week": 7, "last_month": 30, "last_year": 365}


def counts_by(registry: DataFrame, column: str) -> DataFrame:
    """(value, count) of a column; each entry of an array counts."""
    value = F.explode(column) if registry.schema[column].dataType.typeName() == "array" else F.col(column)
    return registry.select(value.alias("value")).groupBy("value").agg(F.count("*").alias("count"))


def counts_by_age(registry: DataFrame, age: str = "age_days") -> DataFrame:
    """(value, count) by last update; buckets hold those before them."""
    of = F.explode(F.array_compact(F.array(*(F.when(F.col(age) <= days, name) for name, days in BUCKETS.items()))))
    return registry.select(of.alias("value")).groupBy("value").agg(F.count("*").alias("count"))


def filtered(registry: DataFrame, chains=(), keywords=(), status: str | None = None, visibility: str | None = None, owner: str | None = None, last_updated: str | None = None) -> DataFrame:
    """Datasets that meet every condition given; lists: any of their entries."""
    conditions = [
        F.arrays_overlap("indexing_chains", F.array(*map(F.lit, chains))) if chains else None,
        F.arrays_overlap("keywords", F.array(*map(F.lit, keywords))) if keywords else None,
        F.col("status") == status if status else None,
        F.col("visibility") == visibility if visibility else None,
        F.col("owner") == owner if owner else None,
        F.col("age_days") <= BUCKETS[last_updated] if last_updated else None,
    ]
    for condition in conditions:
        registry = registry if condition is None else registry.where(condition)
    return registry


def page(df: DataFrame, number: int, limit: int, *order: Column) -> DataFrame:
    """One page (from 1) with ``total_count`` and ``has_next_page`` on each row."""
    if number < 1 or limit < 1:
        raise ValueError("page and limit are positive")
    total = df.agg(F.count("*").alias("total_count"))
    rows = df.orderBy(*order).offset((number - 1) * limit).limit(limit)
    return rows.join(F.broadcast(total)).withColumn("has_next_page", F.lit(number * limit) < F.col("total_count"))


def keyset_page(df: DataFrame, key: str, after, limit: int) -> DataFrame:
    """Rows after a cursor, by key, with ``next_cursor``: the last key of a page that may have a successor."""
    rows = df.where(F.col(key) > after) if after is not None else df
    rows = rows.orderBy(key).limit(limit)
    last = rows.agg(F.when(F.count("*") == limit, F.max(key)).alias("next_cursor"))
    return rows.join(F.broadcast(last))


def latest(versions: DataFrame, by: list[str], version: str = "version_tag") -> DataFrame:
    """The greatest version of each dataset; prereleases come before their release."""
    v = semver(F.col(version))
    order = F.struct(v["major"], v["minor"], v["patch"], v["release"], v["prerelease"], F.col(version))
    return versions.groupBy(*by).agg(F.max_by(version, order).alias("latest_version"), F.count("*").alias("n_versions"))


def semver_rank(versions: DataFrame, version: str = "version_tag") -> DataFrame:
    """(version, rank) of distinct versions, from the least."""
    v = semver(F.col("version"))
    order = [v[f] for f in ("major", "minor", "patch", "release", "prerelease")]
    return numbered(versions.select(F.col(version).alias("version")).distinct(), order, "rank", name="versions")


def text_search(registry: DataFrame, words: list[str], columns: dict[str, float]) -> DataFrame:
    """Datasets with ``score``: the weights of the columns that hold a word, summed over words; only those that match."""
    score = sum((F.when(F.contains(F.lower(F.col(c)), F.lit(w.lower())), F.lit(weight)).otherwise(0.0) for w in words for c, weight in columns.items()), start=F.lit(0.0))
    return registry.withColumn("score", score).where("score > 0")


def vector_search(vectors: DataFrame, query: list[float], k: int, vector: str = "embedding") -> DataFrame:
    """The k rows of largest cosine with one query vector, with ``score``; Spark keeps k rows a task."""
    v = F.col(vector).cast("array<double>")
    q = F.array(*(F.lit(float(x)) for x in query))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    return vectors.withColumn("score", dot(v, q) / F.sqrt(dot(v, v) * dot(q, q))).orderBy(F.desc("score"), "vec_id").limit(k)


def lineage(edges: DataFrame, start: str, down: bool = True, most: int = 64) -> DataFrame:
    """(version, distance): descendants (or ancestors) of a version over edges (parent, child)."""
    spark = edges.sparkSession
    a, b = ("parent", "child") if down else ("child", "parent")
    edges.createOrReplaceTempView("_lineage_edges")
    return spark.sql(
        f"WITH RECURSIVE walk(version, distance) MAX RECURSION LEVEL {most + 1} AS (SELECT {b}, 1L FROM _lineage_edges WHERE {a} = :start"
        f" UNION ALL SELECT e.{b}, w.distance + 1 FROM walk w JOIN _lineage_edges e ON e.{a} = w.version) SELECT version, min(distance) AS distance FROM walk GROUP BY version",
        {"start": start},
    )


def sync_progress(feed: DataFrame) -> DataFrame:
    """Progress of each network of a feed: first and current block, messages."""
    return feed.groupBy("stream", "network").agg(F.min("start_block").alias("start_block"), F.max("end_block").alias("current_block"), F.count_distinct("seq").alias("n_messages"))


def files_of(path_df: DataFrame) -> DataFrame:
    """files_count and total_size_bytes of the files behind a DataFrame."""
    return path_df.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.count("*").alias("files_count"), F.sum("file_size").alias("total_size_bytes"))


def upsert(rows: DataFrame, changed: DataFrame, keys: list[str]) -> DataFrame:
    """A metadata table with the changed rows in place of those of the same keys: registers, publishes, updates and archives."""
    return rows.join(changed.select(*keys).distinct(), keys, "left_anti").unionByName(changed)


def with_status(versions: DataFrame, chosen: DataFrame, keys: list[str], status: str) -> DataFrame:
    """versions with a status for those whose keys are chosen (``archived`` for a version that is taken back)."""
    changed = versions.join(chosen.select(*keys).distinct(), keys, "left_semi").withColumn("status", F.lit(status)).select(versions.columns)
    return upsert(versions, changed, keys)


def resolve(refs: DataFrame, versions: DataFrame, ref: str = "ref") -> DataFrame:
    """refs with the version that each names. versions: namespace, name, version, hash, registered (order of registration), and more.

    A version or a hash (in any case) names itself, latest the greatest version, dev the one registered last. References to nothing are left out.
    """
    r = dataset_ref(F.col(ref))
    asked = refs.select("*", r["namespace"].alias("_ns"), r["name"].alias("_name"), F.lower(r["revision"]).alias("_wanted"))
    v = semver(F.col("version"))
    by = ["namespace", "name"]
    tags = versions.groupBy(*by).agg(F.max_by("version", F.when(is_semver(F.col("version")), F.struct(v["major"], v["minor"], v["patch"], v["release"], v["prerelease"]))).alias("latest"), F.max_by("version", "registered").alias("dev"))
    named = versions.join(tags, by).withColumn(
        "_names", F.array_distinct(F.array_compact(F.array(F.lower("version"), F.lower("hash"), F.when(F.col("version") == F.col("latest"), "latest"), F.when(F.col("version") == F.col("dev"), "dev"))))
    )
    each = named.withColumn("_names", F.explode("_names")).drop("latest", "dev")
    met = asked.join(each, (F.col("_ns") == F.col("namespace")) & (F.col("_name") == F.col("name")) & (F.col("_wanted") == F.col("_names")))
    return met.drop("_ns", "_name", "_wanted", "_names")


def dependencies(used: DataFrame, given: DataFrame, versions: DataFrame) -> DataFrame:
    """used (alias, ...) with the dataset that each alias stands for: ref, namespace, name, version, and code, null if it is found.

    given: alias, ref. An alias that is not given and a reference that names no version have a code of their own, and no version.
    """
    named = used.join(given.select("alias", "ref"), "alias", "left")
    found = resolve(given.select("ref").distinct(), versions).select("ref", "namespace", "name", "version")
    code = F.when(F.col("ref").isNull(), "DEPENDENCY_ALIAS_NOT_FOUND").when(F.col("version").isNull(), "DEPENDENCY_NOT_FOUND")
    return named.join(found, "ref", "left").withColumn("code", code)


def list_parameter(value: Column) -> Column:
    """The entries of a comma-separated, percent-encoded list of a request (null or empty: none)."""
    return F.when(F.coalesce(value, F.lit("")) != "", F.transform(F.split(value, ","), lambda x: F.url_decode(x))).otherwise(F.array().cast("array<string>"))
