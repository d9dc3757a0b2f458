"""Mixing sources to target weights by pivotal dependent rounding. DataFrame and SQL functions only.

Every source gets a target of words; each of its documents would be taken ``target / source_size`` times.
The whole part of that is certain. The fraction is rounded by pivotal sampling: two documents meet, word
mass moves at random from one to the other until one of the two is settled, and the other meets the next.
That keeps the expected number of copies of each document and the sum of taken words. Documents meet in
small buckets of their source, large ones first, so that what stays is small; what a bucket leaves
unsettled (one document) goes up a reduction tree, so a hot source is as many tasks as it has buckets.
The last document of a source is rounded to the nearer side: its words end within half of it of the target.

Draws are hashes of the keys and the seed: reruns and recomputed tasks agree. Null texts have no words;
documents without words move no mass and draw alone. A null source is a source of its own. Rows are told apart by all their columns, so
a doc_id that many rows share, or none, settles each on its own; n rows that are equal in every column are n times the whole and
fractional copies of one, of which a fraction of one row is left to be rounded. Very long texts are one unit each, whatever their length. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainframe.llm.common import cut, row_hashes
from chainframe.operators.ordered import numbered

#: Units that meet in a task's bucket at a time, and so the fan-in of the reduction tree.
FAN_IN = 64
#: A table of sources up to this long is broadcast (some 10 MB); a longer one is joined by salted keys.
BROADCAST_SOURCES, SALTS = 100_000, 32


def targets(sources: DataFrame, share: float, weights: tuple[float, ...], most: float) -> DataFrame:
    """(source, source_size, ...) with ``target``: shares by weight, none above ``most`` times its source.

    What the shares exceed their caps by is shared out again until none is above; each round is one sum over the sources.
    """
    ranked = numbered(sources, [F.col("source").asc_nulls_last()], "rank", name="mix-ranks")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = cut(ranked.select(*sources.columns, weight.alias("weight"), (F.col("source_size") * float(most)).alias("cap")), "mix-caps")
    size, open_weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    total, level = float(share) * (size or 0), 0.0
    while open_weight and (reached := total / open_weight) > level:
        level = reached
        over = F.col("cap") < level * F.col("weight")
        capped, open_weight = ranked.agg(F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("weight")))).first()
        total = float(share) * size - (capped or 0.0)
    if size and not open_weight:
        level = float("inf")
    return ranked.withColumn("target", F.least("cap", F.lit(level) * F.col("weight"))).select(*sources.columns, "target")


def _uniform(seed: int, *keys) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 53)) / float(1 << 53)


def _meet(seed: int, level: int):
    """One step of pivotal rounding over structs (key, w, p): settled units are appended to ``out``."""

    def step(acc, b):
        a = acc["cur"]
        a_up = F.least(1 - a["p"], b["p"] * b["w"] / a["w"])
        a_down = F.least(a["p"], (1 - b["p"]) * b["w"] / a["w"])
        up = _uniform(seed + level, a["key"], b["key"]) * (a_up + a_down) < a_down

        def settle(unit, bit, other, p):
            p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))
            return F.struct(F.concat(acc["out"], F.array(F.struct(unit["key"].alias("key"), F.lit(bit).alias("bit")))).alias("out"), F.struct(other["key"].alias("key"), other["w"].alias("w"), p.alias("p")).alias("cur"))

        return (
            F.when(a.isNull(), F.struct(acc["out"].alias("out"), b.alias("cur")))
            .when(up & (1 - a["p"] <= b["p"] * b["w"] / a["w"]), settle(a, 1, b, b["p"] - (1 - a["p"]) * a["w"] / b["w"]))
            .when(up, settle(b, 0, a, a["p"] + b["p"] * b["w"] / a["w"]))
            .when(a["p"] <= (1 - b["p"]) * b["w"] / a["w"], settle(a, 0, b, b["p"] + a["p"] * a["w"] / b["w"]))
            .otherwise(settle(b, 1, a, a["p"] - (1 - b["p"]) * b["w"] / a["w"]))
        )

    return step


def _round(units: DataFrame, buckets: int, seed: int) -> DataFrame:
    """(source, key, bit) of units (source, key, w, p, bucket). buckets: the largest number that a source has."""
    settled, level = [], 0
    while True:
        kind = units.select(F.struct(F.array(F.struct("key", F.lit(0).alias("bit"))).alias("out"), F.struct("key", "w", "p").alias("cur")).alias("x")).schema["x"].dataType.simpleString()
        start = F.expr(f"cast(named_struct('out', array(), 'cur', null) as {kind})")
        unit = F.struct((-F.col("w")).alias("first"), F.xxhash64(F.lit(seed + level), "key").alias("at"), "key", "w", "p")
        folded = cut(
            units.groupBy("source", "bucket")
            .agg(F.array_sort(F.collect_list(unit)).alias("met"))
            .select("source", "bucket", F.aggregate(F.transform("met", lambda x: F.struct(x["key"].alias("key"), x["w"].alias("w"), x["p"].alias("p"))), start, _meet(seed, level)).alias("done"))
            .select("source", "bucket", "done.out", "done.cur"),
            f"mix{level}",
        )
        settled.append(folded.select("source", F.explode("out").alias("x")).select("source", "x.key", "x.bit"))
        left = folded.where(F.col("cur").isNotNull())
        if buckets <= 1:
            settled.append(left.select("source", "cur.key", (F.col("cur.p") >= 0.5).cast("int").alias("bit")))
            break
        units = left.select("source", "cur.*", F.floor(F.col("bucket") / FAN_IN).alias("bucket"))
        buckets, level = -(-buckets // FAN_IN), level + 1
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def _of_source(rows: DataFrame, sources: DataFrame, short: bool) -> DataFrame:
    """rows with the columns of their source."""
    named = sources.withColumnRenamed("source", "of")
    same = F.col("source").eqNullSafe(F.col("of"))
    if short:
        return rows.join(F.broadcast(named), same).drop("of")
    salted = named.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = rows.withColumn("salt", F.pmod(F.col("h1"), F.lit(SALTS)).cast("int"))
    return met.join(salted, (F.col("salt") == F.col("of_salt")) & same).drop("of", "of_salt", "salt")


def plan(docs: DataFrame, size: Column, key: str = "doc_id", source: str = "source", share: float = 1.5, weights: tuple[float, ...] = (5, 2, 1), most: float = 2.0, seed: int = 17) -> DataFrame:
    """One row per row of docs that differs from all others: with ``h1`` and ``h2`` (row_hashes of its columns), ``n_rows`` (how often it
    stands there), ``source_size``, ``target`` and ``copies`` (how often these rows are taken, together). size: words of a row."""
    units = cut(
        docs.select(F.col(key).alias("id"), F.col(source).cast("string").alias("source"), size.cast("long").alias("size"), *(h.alias(f"h{i + 1}") for i, h in enumerate(row_hashes(docs, docs.columns))))
        .groupBy("id", "source", "size", "h1", "h2")
        .agg(F.count("*").alias("n_rows")),
        "mix-units",
    )
    per_source = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n_rows")).alias("source_size"), F.sum((F.col("size") > 0).cast("long")).alias("n_units"))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    sources = cut(
        targets(per_source, share, weights, most)
        .withColumn("rate", rate)
        .withColumn("buckets", F.greatest(F.lit(1), F.ceil(F.col("n_units") / FAN_IN))),
        "mix-sources",
    )
    n_sources, buckets = sources.agg(F.count("*"), F.coalesce(F.max("buckets"), F.lit(1))).first()
    short = n_sources <= BROADCAST_SOURCES
    due = F.col("rate") * F.col("n_rows")
    met = _of_source(units, sources, short).withColumn("sure", F.floor(due).cast("long")).withColumn("p", due - F.floor(due))
    fractional = (F.col("size") > 0) & (F.col("p") > 0)
    named = F.struct("id", "size", "h1", "h2", "n_rows", "sure").alias("key")
    drawn = met.where(fractional).select("source", named, F.col("size").cast("double").alias("w"), "p", F.pmod(F.xxhash64(F.lit(seed), "h1", "h2"), F.col("buckets")).alias("bucket"))
    rounded = _round(drawn, buckets, seed).select("source", "key.*", "bit")
    alone = met.where(~fractional).select("source", "id", "size", "h1", "h2", "n_rows", "sure", (_uniform(seed, "h1", "h2") < F.col("p")).cast("int").alias("bit"))
    out = _of_source(rounded.unionByName(alone), sources, short)
    return out.select(F.col("id").alias(key), F.col("source").alias(source), "size", "h1", "h2", "n_rows", "source_size", "target", (F.col("sure") + F.col("bit")).alias("copies"))


def per_row(planned: DataFrame) -> DataFrame:
    """planned with a row for each row of the documents, and ``copies`` those of the one row."""
    rows = planned.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), "n_rows")))
    return rows.withColumn("copies", F.floor(F.col("copies") / F.col("n_rows")) + (F.col("_row") <= F.col("copies") % F.col("n_rows")).cast("long")).drop("_row")


def mix(docs: DataFrame, size: Column, key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """docs with every row as often as the mix takes it; its columns as they are."""
    decided = plan(docs, size, key, source, **options).where("copies > 0").select("h1", "h2", F.col("n_rows").alias("_n"), F.col("copies").alias("_copies"))
    h1, h2 = row_hashes(docs, docs.columns)
    met = docs.withColumns({"_h1": h1, "_h2": h2}).join(decided, (F.col("_h1") == F.col("h1")) & (F.col("_h2") == F.col("h2")))
    single = met.where("_n = 1").select(*docs.columns, "_copies")
    # equal rows meet before the shuffle, and come back as one row times their copies
    repeated = met.where("_n > 1").groupBy("_h1", "_h2").agg(*(F.first(c).alias(c) for c in docs.columns), F.first("_copies").alias("_copies")).select(*docs.columns, "_copies")
    return single.unionByName(repeated).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*docs.columns)
