"""Queries of the core engine and the SQL that an oracle runs beside them.

SQL pieces that several oracles share: FEED, the feed over events; MESSAGES, its messages with
transaction ids; MARKS, watermarks and reorganisations by id.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainframe.functions import domain
from chainframe.operators import catalog, cdc, joins, protocol
from chainframe.operators.ordered import numbered
from chainframe.operators.transactions import Marks, tx_ids
from chainframe.plans import derived, gate
from chainframe.sources import arrow_types, stores
from chainframe.sources.feed import event_rows, extracted, from_metadata, registry, resume_cursor, synthetic_feed, table, to_metadata
from chainframe.sources.shared import new_path
from chainframe.streaming import processor, stream

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its oracle."""

    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synthetic_feed(table(spark, sf_dir, "events"))


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry(table(spark, sf_dir, "documents"))


_FEED = """
b AS (SELECT DISTINCT CAST(floor(event_id / 20.0) AS BIGINT) AS b FROM events),
k AS (SELECT b, unnest(CASE WHEN b % 7 = 6 THEN [0, 1, 2, 3] ELSE [0, 1] END) AS kind, CASE WHEN b % 21 = 20 THEN 2 ELSE 1 END AS depth FROM b),
r AS (SELECT b, kind, network, network = 'eth' AND kind >= 2 AS redone,
  CASE WHEN network = 'eth' AND kind >= 2 THEN (b - depth + 1) * 10 ELSE b * 10 END AS start_block, b * 10 + 9 AS end_block
  FROM k CROSS JOIN (SELECT unnest(['eth', 'polygon']) AS network)),
feed AS (SELECT 'events' AS stream, CAST(b * 4 + kind AS BIGINT) AS seq, kind IN (1, 3) AS ranges_complete, network,
  CAST(start_block AS BIGINT) AS start_block, CAST(end_block AS BIGINT) AS end_block,
  '0x' || sha256(network || ':' || end_block || ':' || CAST(redone AS INT)) AS hash,
  CASE WHEN start_block > 0 THEN '0x' || sha256(network || ':' || (start_block - 1) || ':' ||
    CASE WHEN network = 'eth' AND kind < 2 AND (start_block // 10 - 1) % 7 = 6 THEN 1 ELSE 0 END) END AS prev_hash FROM r)"""
_LAGGED = (
    _FEED
    + """,
lagged AS (SELECT *, lag(start_block) OVER w AS p_start, lag(end_block) OVER w AS p_end, lag(hash) OVER w AS p_hash, lag(prev_hash) OVER w AS p_prev
  FROM feed WINDOW w AS (PARTITION BY network ORDER BY seq)),
judged AS (SELECT *, start_block = p_start AND end_block = p_end AND hash = p_hash AND prev_hash IS NOT DISTINCT FROM p_prev AS same FROM lagged),
reorgs AS (SELECT stream, seq, network, start_block AS inv_start, greatest(end_block, p_end) AS inv_end FROM judged WHERE p_end IS NOT NULL AND NOT same AND start_block < p_end + 1),
messages AS (SELECT f.stream, f.seq, CASE WHEN r.inv_start IS NOT NULL THEN 'Reorg' WHEN f.complete THEN 'Watermark' ELSE 'Data' END AS tag, f.n_networks, r.inv_start, r.inv_end,
  row_number() OVER (ORDER BY f.seq) - 1 AS tx_id
  FROM (SELECT stream, seq, bool_and(ranges_complete) AS complete, count(*) AS n_networks FROM feed GROUP BY ALL) f
  LEFT JOIN (SELECT seq, min(inv_start) AS inv_start, max(inv_end) AS inv_end FROM reorgs GROUP BY seq) r USING (seq))"""
)
_MARKS = (
    _LAGGED
    + """,
w AS (SELECT m.tx_id AS w_id, f.network, f.start_block, f.end_block FROM messages m JOIN feed f USING (seq) WHERE m.tag = 'Watermark'),
p AS (SELECT m.tx_id AS r_id, x.network, x.inv_start FROM messages m JOIN reorgs x USING (seq)),
killed AS (SELECT w_id, min(r_id) AS killed_by FROM w JOIN p ON w.network = p.network AND r_id > w_id AND start_block >= inv_start GROUP BY w_id),
alive AS (SELECT w.*, killed_by FROM w LEFT JOIN killed USING (w_id)),
behind AS (SELECT w.w_id, v.w_id AS v_id, bool_and(v.end_block < greatest(0, w.start_block - 128)) AS out
  FROM w JOIN alive v ON v.network = w.network AND v.w_id < w.w_id AND (v.killed_by IS NULL OR v.killed_by > w.w_id) AND v.end_block < greatest(0, w.start_block - 128)
  GROUP BY ALL HAVING count(*) = 2),
pruned AS (SELECT * FROM (SELECT w_id, prune, max(prune) OVER (ORDER BY w_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM (SELECT w_id, max(v_id) AS prune FROM behind GROUP BY w_id)) WHERE before IS NULL OR prune > before),
r_ids AS (SELECT DISTINCT r_id FROM p),
floors AS (SELECT r_id, (SELECT max(prune) FROM pruned WHERE w_id < r_id) AS floor FROM r_ids),
recovered AS (SELECT f.r_id, f.floor, max(a.w_id) AS recovery FROM floors f
  LEFT JOIN alive a ON a.w_id < f.r_id AND (a.killed_by IS NULL OR a.killed_by > f.r_id) AND (f.floor IS NULL OR a.w_id > f.floor) GROUP BY ALL),
undone AS (SELECT r_id, coalesce(recovery + 1, 0) AS undo_start, greatest(coalesce(recovery + 1, 0), r_id - 1) AS undo_end FROM recovered)"""
)


# The feed and the protocol layer


@query(f"WITH {_FEED} SELECT * FROM feed")
def feed_ranges(spark, sf_dir):
    return _feed(spark, sf_dir)


@query(f"WITH {_FEED} SELECT stream, seq, network, start_block, end_block, hash, prev_hash, ranges_complete FROM feed")
def metadata_round_trip(spark, sf_dir):
    """The feed through the JSON that record batches carry."""
    return from_metadata(to_metadata(_feed(spark, sf_dir))).select("stream", "seq", "network", "start_block", "end_block", "hash", "prev_hash", "ranges_complete")


@query(f"WITH {_FEED} SELECT network, CASE WHEN start_block = 0 THEN 'first' WHEN prev_hash IS NULL THEN 'missing' ELSE 'named' END AS parent, count(*) AS n FROM feed GROUP BY ALL")
def prev_hash_validation(spark, sf_dir):
    parent = F.when(F.col("start_block") == 0, "first").when(protocol.prev_hash_error().isNotNull(), "missing").otherwise("named")
    return _feed(spark, sf_dir).groupBy("network", parent.alias("parent")).agg(F.count("*").alias("n"))


@query(f"WITH {_FEED} SELECT stream, seq, CAST(NULL AS VARCHAR) AS error FROM feed GROUP BY stream, seq")
def network_validation(spark, sf_dir):
    return protocol.network_errors(_feed(spark, sf_dir))


@query(
    f"WITH {_LAGGED} SELECT network, CASE WHEN p_end IS NULL THEN 'first' WHEN same THEN 'identical' WHEN start_block = p_end + 1 AND prev_hash = p_hash THEN 'consecutive' WHEN start_block < p_end + 1 AND prev_hash IS DISTINCT FROM p_hash THEN 'reorg' ELSE 'error' END AS relation, count(*) AS n FROM judged GROUP BY ALL"
)
def consecutiveness_validation(spark, sf_dir):
    same = (F.col("start_block") == F.col("p_start")) & (F.col("end_block") == F.col("p_end")) & (F.col("hash") == F.col("p_hash"))
    relation = F.when(F.col("p_end").isNull(), "first").when(protocol.consecutiveness_error().isNotNull(), "error").when(same, "identical").when(F.col("start_block") > F.col("p_end"), "consecutive").otherwise("reorg")
    return protocol.with_previous(_feed(spark, sf_dir)).groupBy("network", relation.alias("relation")).agg(F.count("*").alias("n"))


@query(
    """SELECT * FROM (VALUES ('duplicate_network', 40, 'DuplicateNetworkError'), ('gap', 40, 'GapError'), ('network_dropped', 40, 'NetworkCountChangedError'), ('network_renamed', 40, 'UnexpectedNetworkError'),
('prev_hash_missing', 40, 'MissingPrevHashError'), ('prev_hash_on_first', 0, 'InvalidPrevHashError'), ('prev_hash_zero', 40, 'MissingPrevHashError'), ('same_parent_back', 40, 'InvalidReorgError'),
('wrong_parent', 40, 'HashMismatchOnConsecutiveBlocksError')) AS t(stream, seq, error)"""
)
def validate_all_first_error(spark, sf_dir):
    """The first error of a stream for each defect."""
    return protocol.first_errors(protocol.defective_feeds(_feed(spark, sf_dir), 40)).select("stream", F.col("seq").cast("int").alias("seq"), "error")


@query(f"WITH {_LAGGED} SELECT * FROM reorgs")
def reorg_detect(spark, sf_dir):
    return protocol.reorgs(_feed(spark, sf_dir))


@query(f"WITH {_LAGGED} SELECT tag, n_networks, count(*) AS n, CAST(sum(inv_end - inv_start + 1) AS BIGINT) AS blocks FROM messages GROUP BY ALL")
def message_classify(spark, sf_dir):
    found = protocol.classify(_feed(spark, sf_dir))
    return found.groupBy("tag", "n_networks").agg(F.count("*").alias("n"), F.sum(F.col("inv_end") - F.col("inv_start") + 1).alias("blocks"))


@query(f"WITH {_LAGGED} SELECT x.seq AS reorg_seq, f.seq, f.network FROM reorgs x JOIN feed f ON x.network = f.network AND f.end_block >= x.inv_start AND x.inv_end >= f.start_block")
def range_overlap(spark, sf_dir):
    """Ranges of the feed that each reorganisation touches, joined by network and bin of 64 blocks."""
    feed, width = _feed(spark, sf_dir), 64
    bins = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / width), F.floor(F.col(b) / width)))
    a = protocol.reorgs(feed).select("seq", "network", F.col("inv_start").alias("start_block"), F.col("inv_end").alias("end_block")).withColumn("bin", bins("start_block", "end_block")).alias("a")
    b = feed.select("seq", "network", "start_block", "end_block").withColumn("bin", bins("start_block", "end_block")).alias("b")
    met = a.join(b, (F.col("a.network") == F.col("b.network")) & (F.col("a.bin") == F.col("b.bin")) & protocol.overlaps("a", "b"))
    first = F.col("a.bin") == F.floor(F.greatest("a.start_block", "b.start_block") / width)  # a pair in several bins counts in one
    return met.where(first).select(F.col("a.seq").alias("reorg_seq"), F.col("b.seq").alias("seq"), F.col("b.network").alias("network"))


@query(f"WITH {_FEED} SELECT stream, network, max_by(end_block, seq) AS number, max_by(hash, seq) AS hash FROM feed GROUP BY ALL")
def resume_cursors(spark, sf_dir):
    return resume_cursor(_feed(spark, sf_dir))


@query(f"WITH {_FEED} SELECT stream, network, min(start_block) AS start_block, max(end_block) AS current_block, count(DISTINCT seq) AS n_messages FROM feed GROUP BY ALL")
def sync_progress(spark, sf_dir):
    return catalog.sync_progress(_feed(spark, sf_dir))


# The transactional and change layers


@query(f"WITH {_LAGGED} SELECT stream, seq, tag, n_networks, inv_start, inv_end, CAST(tx_id AS BIGINT) AS tx_id FROM messages")
def transaction_ids(spark, sf_dir):
    return tx_ids(_feed(spark, sf_dir))


@query(f"WITH {_MARKS} SELECT 'events' AS stream, CAST(r_id AS BIGINT) AS r_id, CAST(recovery AS BIGINT) AS recovery, CAST(floor AS BIGINT) AS floor FROM recovered")
def recovery_point(spark, sf_dir):
    return Marks(_feed(spark, sf_dir)).recoveries()


@query(f"WITH {_MARKS} SELECT 'events' AS stream, CAST(w_id AS BIGINT) AS w_id, CAST(prune AS BIGINT) AS prune FROM pruned")
def prune_point(spark, sf_dir):
    return Marks(_feed(spark, sf_dir)).prunes()


@query(f"WITH {_MARKS} SELECT 'events' AS stream, CAST(r_id AS BIGINT) AS r_id, CAST(undo_start AS BIGINT) AS undo_start, CAST(undo_end AS BIGINT) AS undo_end FROM undone")
def undo_ranges(spark, sf_dir):
    return Marks(_feed(spark, sf_dir)).undos()


@query(
    f"WITH {_MARKS} SELECT 'events' AS stream, CAST(d.r_id AS BIGINT) AS r_id, min(w.network) AS network FROM recovered d JOIN w ON w.w_id = d.recovery JOIN p ON p.r_id = d.r_id AND p.network = w.network WHERE w.start_block < inv_start AND inv_start <= w.end_block GROUP BY ALL"
)
def partial_reorg(spark, sf_dir):
    return Marks(_feed(spark, sf_dir)).partial()


@query(f"WITH {_MARKS} SELECT DISTINCT 'events' AS stream, CAST(w_id AS BIGINT) AS w_id FROM alive WHERE killed_by IS NULL AND w_id > coalesce((SELECT max(prune) FROM pruned), -1)")
def commit_compress(spark, sf_dir):
    return Marks(_feed(spark, sf_dir)).commits()


@query(
    f"WITH {_MARKS}, l AS (SELECT coalesce(max(w_id) + 1, 0) AS s FROM alive WHERE w_id < 101 AND (killed_by IS NULL OR killed_by >= 101)) SELECT 'events' AS stream, CAST(s AS BIGINT) AS undo_start, CAST(100 AS BIGINT) AS undo_end FROM l WHERE 101 > s"
)
def rewind_range(spark, sf_dir):
    """What a restart after 101 events undoes."""
    return Marks(_feed(spark, sf_dir)).rewinds(101)


_CHANGES = (
    _MARKS
    + """,
rows AS (SELECT CAST(floor(event_id / 20.0) AS BIGINT) * 4 AS seq, CASE WHEN user_id % 2 = 0 THEN 'eth' ELSE 'polygon' END AS network, event_id // 2 AS block_num, event_id FROM events),
inserted AS (SELECT m.tx_id, rows.* EXCLUDE (seq) FROM messages m JOIN rows USING (seq) WHERE m.tag = 'Data'),
gone AS (SELECT m.tx_id AS of_tx, min(r_id) AS tx_id FROM messages m JOIN undone ON m.tx_id BETWEEN undo_start AND undo_end WHERE m.tag = 'Data' GROUP BY ALL),
changes AS (SELECT CAST(tx_id AS BIGINT) AS tx_id, 'insert' AS change, CAST(tx_id AS BIGINT) AS of_tx, network, block_num, event_id FROM inserted
  UNION ALL SELECT CAST(g.tx_id AS BIGINT), 'delete', CAST(of_tx AS BIGINT), network, block_num, event_id FROM gone g JOIN inserted i ON i.tx_id = g.of_tx)"""
)


def _changes(spark, sf_dir) -> DataFrame:
    rows = event_rows(table(spark, sf_dir, "events")).select(F.lit("events").alias("stream"), (F.col("b") * 4).alias("seq"), "network", "block_num", "event_id")
    return cdc.changes(Marks(_feed(spark, sf_dir)), rows)


@query(f"WITH {_CHANGES} SELECT 'events' AS stream, * FROM changes")
def cdc_changes(spark, sf_dir):
    return _changes(spark, sf_dir)


@query(f"WITH {_CHANGES} SELECT 'events' AS stream, of_tx, network, block_num, event_id FROM changes WHERE change = 'insert' AND of_tx NOT IN (SELECT of_tx FROM changes WHERE change = 'delete')")
def cdc_live_rows(spark, sf_dir):
    return cdc.live_rows(_changes(spark, sf_dir))


@query(f"WITH {_MARKS} SELECT 'events' AS stream, CAST(u.r_id AS BIGINT) AS r_id, CAST(m.tx_id AS BIGINT) AS tx_id FROM undone u JOIN messages m ON m.tx_id BETWEEN undo_start AND undo_end WHERE m.tag = 'Data'")
def batch_seek(spark, sf_dir):
    """Ids of the Data transactions in each undo range."""
    marks = Marks(_feed(spark, sf_dir))
    return cdc.seek(marks.events.where("tag = 'Data'").select("stream", "tx_id"), marks.undos())


# Types and egress


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS orderkey, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS price, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(CAST(extract(millisecond FROM o_orderdate) AS BIGINT) % 1000 AS VARCHAR), 3, '0') || 'Z' AS at,
strftime(CAST(o_orderdate AS DATE), '%Y-%m-%dT00:00:00.000Z') AS day, to_base64(encode(o_orderpriority || repeat(o_orderstatus, 80))) AS bytes, lower(hex(encode(o_orderstatus))) AS status_hex FROM orders"""
)
def json_egress_types(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.col("o_orderdate").alias("at"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.concat("o_orderpriority", F.expr("repeat(o_orderstatus, 80)")).cast("binary").alias("bytes"),
        F.lower(F.hex(F.col("o_orderstatus").cast("binary"))).alias("status_hex"),
    )
    return arrow_types.json_ready(o)


@query(
    """SELECT o_orderkey AS orderkey, CAST(epoch_ms(o_orderdate) AS BIGINT) AS at, CAST(epoch_ms(CAST(o_orderdate AS DATE)) AS BIGINT) AS day,
    lower(hex(encode(o_orderpriority))) AS priority, [ascii(o_orderstatus), 45, ascii(o_orderstatus)] AS status FROM orders"""
)
def json_egress_options(spark, sf_dir):
    """Egress with numbers for 64-bit integers and times, and binary as hex digits or bytes."""
    status = F.concat("o_orderstatus", F.lit("-"), "o_orderstatus").cast("binary")
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_orderdate").alias("at"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderpriority").cast("binary").alias("priority"),
        arrow_types.json_value(status, T.BinaryType(), arrow_types.Egress(binary="array")).alias("status"),
    )
    return arrow_types.json_ready(o, arrow_types.Egress("number", "timestamp", "hex"))


@query("SELECT event_type, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS BIGINT) AS code, count(*) AS n FROM events GROUP BY event_type")
def dictionary_lookup(spark, sf_dir):
    """Codes looked up in a dictionary of the values that the column has."""
    events = table(spark, sf_dir, "events").select("event_type")
    codes = numbered(events.distinct(), [F.col("event_type")], "code", first=0, name="dictionary")
    encoded = events.join(codes, "event_type").select("code")
    return encoded.join(codes, "code").groupBy("event_type", "code").agg(F.count("*").alias("n"))


@query("SELECT * FROM (SELECT 'prev_hash' AS field, count(*) FILTER (prev_hash IS NULL) AS null_count, count(*) AS length FROM feed UNION ALL SELECT 'hash', count(*) FILTER (hash IS NULL), count(*) FROM feed)".join([f"WITH {_FEED} ", ""]))
def null_counts(spark, sf_dir):
    counted = _feed(spark, sf_dir).agg(F.count("*").alias("length"), *(F.count_if(F.col(c).isNull()).alias(c) for c in ("prev_hash", "hash")))
    return counted.select("length", F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("null_count")) for c in ("prev_hash", "hash")))).alias("x")).select("x.field", "x.null_count", "length")


@query("SELECT doc_id, lower(lang) AS network, n_chars FROM documents WHERE n_chars >= 100")
def consumer_schema(spark, sf_dir):
    """A projection onto a consumer's schema: cast, checked for nulls."""
    from pyspark.sql import types as T

    wanted = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("network", T.StringType()), T.StructField("n_chars", T.LongType())])
    return table(spark, sf_dir, "documents").where("n_chars >= 100").select("doc_id", F.lower("lang").alias("network"), "n_chars").to(wanted)


# The catalog

_REGISTRY = """registry AS (SELECT CAST(doc_id AS BIGINT) AS ds_id, 'org_' || doc_id % 17 AS namespace, 'ds_' || doc_id AS name, 'owner_' || doc_id % 11 AS owner,
list_filter([lang, CASE WHEN doc_id % 3 = 0 THEN 'mainnet' END], lambda x: x IS NOT NULL) AS indexing_chains, list_filter([source, CASE WHEN doc_id % 5 = 0 THEN 'defi' END], lambda x: x IS NOT NULL) AS keywords,
['draft', 'published', 'deprecated', 'archived'][doc_id % 4 + 1] AS status, CASE WHEN doc_id % 6 = 0 THEN 'private' ELSE 'public' END AS visibility, CAST(doc_id % 400 AS BIGINT) AS age_days,
(doc_id % 3) || '.' || (doc_id % 12) || '.' || (doc_id % 7) || CASE WHEN doc_id % 10 = 0 THEN '-dev1' ELSE '' END AS version_tag FROM documents)"""


@query(f"WITH {_REGISTRY} SELECT value, count(*) AS count FROM (SELECT unnest(indexing_chains) AS value FROM registry) GROUP BY value")
def counts_by_chain(spark, sf_dir):
    return catalog.counts_by(_registry(spark, sf_dir), "indexing_chains")


@query(f"WITH {_REGISTRY} SELECT value, count(*) AS count FROM (SELECT unnest(keywords) AS value FROM registry) GROUP BY value")
def counts_by_keyword(spark, sf_dir):
    return catalog.counts_by(_registry(spark, sf_dir), "keywords")


@query(f"WITH {_REGISTRY} SELECT b.value, count(*) AS count FROM registry JOIN (VALUES ('last_day', 1), ('last_week', 7), ('last_month', 30), ('last_year', 365)) b(value, days) ON age_days <= days GROUP BY b.value")
def counts_by_last_updated(spark, sf_dir):
    return catalog.counts_by_age(_registry(spark, sf_dir))


@query(f"WITH {_REGISTRY} SELECT status AS value, count(*) AS count FROM registry GROUP BY status")
def counts_by_status(spark, sf_dir):
    return catalog.counts_by(_registry(spark, sf_dir), "status")


@query(f"WITH {_REGISTRY} SELECT visibility AS value, count(*) AS count FROM registry GROUP BY visibility")
def counts_by_visibility(spark, sf_dir):
    return catalog.counts_by(_registry(spark, sf_dir), "visibility")


@query(f"WITH {_REGISTRY} SELECT ds_id, namespace, name FROM registry WHERE list_has_any(indexing_chains, ['en', 'mainnet']) AND list_has_any(keywords, ['defi']) AND status = 'published' AND visibility = 'public' AND age_days <= 365")
def registry_filter(spark, sf_dir):
    return catalog.filtered(_registry(spark, sf_dir), ["en", "mainnet"], ["defi"], "published", "public", None, "last_year").select("ds_id", "namespace", "name")


@query(f"WITH {_REGISTRY} SELECT ds_id, namespace, name, count(*) OVER () AS total_count, 100 < count(*) OVER () AS has_next_page FROM registry ORDER BY namespace, name LIMIT 50 OFFSET 50")
def list_datasets_page(spark, sf_dir):
    return catalog.page(_registry(spark, sf_dir).select("ds_id", "namespace", "name"), 2, 50, F.col("namespace"), F.col("name"))


@query("WITH p AS (SELECT event_id, event_type FROM events WHERE event_id > 1000 ORDER BY event_id LIMIT 100) SELECT *, (SELECT CASE WHEN count(*) = 100 THEN max(event_id) END FROM p) AS next_cursor FROM p")
def jobs_keyset_page(spark, sf_dir):
    return catalog.keyset_page(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id", 1000, 100)


@query(f"WITH {_REGISTRY} SELECT namespace, arg_max(version_tag, (string_split(split_part(version_tag, '-', 1), '.')::BIGINT[], NOT contains(version_tag, '-'))) AS latest_version, count(*) AS n_versions FROM registry GROUP BY namespace")
def latest_version(spark, sf_dir):
    return catalog.latest(_registry(spark, sf_dir), ["namespace"])


@query(f"WITH {_REGISTRY} SELECT namespace, array_to_string(list_sort(list_distinct(list(version_tag))), ',') AS versions FROM registry GROUP BY namespace")
def dataset_versions(spark, sf_dir):
    """The distinct versions in each namespace, as text in the order of their code points."""
    return _registry(spark, sf_dir).groupBy("namespace").agg(F.array_join(F.array_sort(F.collect_set("version_tag")), ",").alias("versions"))


_EDITED = "CASE WHEN ds_id % 4 = 0 THEN upper(name) WHEN ds_id % 4 = 1 THEN '1' || name ELSE name END", "CASE WHEN ds_id % 5 = 0 THEN version_tag || '.0' WHEN ds_id % 5 = 1 THEN 'v' || version_tag ELSE version_tag END"


@query(
    f"WITH {_REGISTRY} SELECT ds_id, regexp_matches(namespace, '{domain.PATTERNS['dataset_namespace']}') AS namespace_ok, regexp_matches({_EDITED[0]}, '{domain.PATTERNS['dataset_name']}') AS name_ok, regexp_matches({_EDITED[1]}, '{domain.SEMVER}') AS version_ok FROM registry"
)
def validate_domain(spark, sf_dir):
    """Which names and versions are well formed, over a registry with some that are not."""
    name, version = map(F.expr, _EDITED)
    return _registry(spark, sf_dir).select("ds_id", domain.is_valid("dataset_namespace", F.col("namespace")).alias("namespace_ok"), domain.is_valid("dataset_name", name).alias("name_ok"), domain.is_semver(version).alias("version_ok"))


@query(f"WITH {_REGISTRY}, v AS (SELECT DISTINCT version_tag AS version FROM registry) SELECT version, row_number() OVER (ORDER BY string_split(split_part(version, '-', 1), '.')::BIGINT[], NOT contains(version, '-')) AS rank FROM v")
def semver_order(spark, sf_dir):
    return catalog.semver_rank(_registry(spark, sf_dir))


@query(f"WITH {_REGISTRY} SELECT ds_id, namespace, name, CASE WHEN ds_id % 2 = 0 THEN version_tag ELSE 'dev' END AS revision FROM registry")
def parse_dataset_ref(spark, sf_dir):
    r = _registry(spark, sf_dir)
    ref = F.concat(F.col("namespace"), F.lit("/"), F.col("name"), F.when(F.col("ds_id") % 2 == 0, F.concat(F.lit("@"), F.col("version_tag"))).otherwise(""))
    return r.select("ds_id", domain.dataset_ref(ref).alias("r")).select("ds_id", "r.*")


@query("WITH RECURSIVE w(version, distance) AS (SELECT 'v1', CAST(0 AS BIGINT) UNION ALL SELECT 'v' || (CAST(substr(w.version, 2) AS BIGINT) * 2 + c), distance + 1 FROM w, (VALUES (0), (1)) t(c) WHERE CAST(substr(w.version, 2) AS BIGINT) * 2 + c <= (SELECT count(*) FROM nation)) SELECT version, distance FROM w WHERE distance > 0")
def version_lineage(spark, sf_dir):
    """Descendants of a version in a tree as large as the table of nations."""
    n = table(spark, sf_dir, "nation")
    ids = n.select((F.row_number().over(Window.orderBy("n_nationkey"))).alias("i")).where("i > 1")
    edges = ids.select(F.concat(F.lit("v"), F.floor(F.col("i") / 2).cast("string")).alias("parent"), F.concat(F.lit("v"), F.col("i").cast("string")).alias("child"))
    return catalog.lineage(edges, "v1")


@query(f"WITH {_REGISTRY} SELECT ds_id, CAST(score AS DOUBLE) AS score FROM (SELECT ds_id, CASE WHEN contains(name, '7') THEN 2.0 ELSE 0 END + CASE WHEN contains(owner, '7') THEN 1.0 ELSE 0 END AS score FROM registry) WHERE score > 0")
def text_search(spark, sf_dir):
    return catalog.text_search(_registry(spark, sf_dir), ["7"], {"name": 2.0, "owner": 1.0}).select("ds_id", "score")


@query("SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], q) / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) * list_dot_product(q, q)), 9) AS score FROM embeddings, (SELECT embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id = 0) ORDER BY score DESC, vec_id LIMIT 10")
def vector_search_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    asked = vectors.where("vec_id = 0").select("embedding").first()[0]
    return catalog.vector_search(vectors, asked, 10).select("vec_id", F.round("score", 9).alias("score"))


@query("SELECT hash, count(*) AS n FROM (SELECT sha256(lang || ':' || source) AS hash FROM documents) GROUP BY hash")
def manifest_hash(spark, sf_dir):
    """Content addresses of manifests."""
    return table(spark, sf_dir, "documents").select(F.sha2(F.concat_ws(":", "lang", "source"), 256).alias("hash")).groupBy("hash").agg(F.count("*").alias("n"))


_GATED = {
    "projection": "SELECT event_id FROM ds.events",
    "filter": "SELECT event_id, value FROM ds.events WHERE value > 1",
    "inner_join": "SELECT a.event_id FROM ds.events a JOIN ds.events b ON a.event_id = b.event_id",
    "union_all": "SELECT event_id FROM ds.events UNION ALL SELECT event_id FROM ds.events",
    "limit": "SELECT event_id FROM ds.events LIMIT 5",
    "order_by": "SELECT event_id FROM ds.events ORDER BY event_id",
    "group_by": "SELECT event_type, count(*) FROM ds.events GROUP BY event_type",
    "distinct": "SELECT DISTINCT event_type FROM ds.events",
    "window": "SELECT row_number() OVER (PARTITION BY event_type ORDER BY event_id) FROM ds.events",
    "left_join": "SELECT a.event_id FROM ds.events a LEFT JOIN ds.events b ON a.event_id = b.event_id",
    "full_join": "SELECT a.event_id FROM ds.events a FULL JOIN ds.events b ON a.event_id = b.event_id",
    "in_subquery_limit": "SELECT event_id FROM ds.events WHERE event_id IN (SELECT event_id FROM ds.events LIMIT 3)",
    "unqualified": "SELECT * FROM events",
    "catalog_qualified": "SELECT * FROM c.ds.events",
    "unknown": "SELECT * FROM ds.nothing",
    "broken": "SELECT FROM WHERE",
}


@query(
    "SELECT name, code FROM (VALUES "
    + ", ".join(f"('{n}', CAST(NULL AS VARCHAR))" for n in ("projection", "filter", "inner_join", "union_all"))
    + ", "
    + ", ".join(f"('{n}', 'NON_INCREMENTAL_QUERY')" for n in ("limit", "order_by", "group_by", "distinct", "window", "left_join", "full_join", "in_subquery_limit"))
    + ", ('unqualified', 'UNQUALIFIED_TABLE'), ('catalog_qualified', 'CATALOG_QUALIFIED_TABLE'), ('unknown', 'TABLE_NOT_FOUND_IN_DATASET'), ('broken', 'INVALID_TABLE_SQL')) t(name, code)"
)
def incremental_gate(spark, sf_dir):
    own = f"ds_{uuid.uuid4().hex}"  # no other query's
    spark.sql(f"CREATE DATABASE {own}")
    spark.sql(f"CREATE TABLE {own}.events USING parquet LOCATION '{sf_dir}/events.parquet'")
    found = gate.check_all(spark, {name: sql.replace("ds.", f"{own}.") for name, sql in _GATED.items()}, known={own: ["events"]})
    spark.sql(f"DROP DATABASE {own} CASCADE")
    return spark.createDataFrame(list(found.items()), "name string, code string")


@query("SELECT event_id, event_type, event_id % 20 AS place, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS level FROM events WHERE value > 1")
def derived_dataset(spark, sf_dir):
    """A view over a raw dataset that calls the derived dataset's own function."""
    raw, own = f"raw_{uuid.uuid4().hex}", f"derived_{uuid.uuid4().hex}"  # no other query's
    spark.sql(f"CREATE DATABASE {raw}")
    spark.sql(f"CREATE TABLE {raw}.events USING parquet LOCATION '{sf_dir}/events.parquet'")
    level = derived.Function("CASE WHEN x0 > 50 THEN 'high' ELSE 'low' END", ["DOUBLE"], "STRING")
    sql = f"SELECT event_id, event_type, event_id % 20 AS place, {own}.level(value) AS level FROM {raw}.events WHERE value > 1"
    derived.deploy(spark, own, {"levels": sql}, {"level": level}, {raw: ["events"]})
    found = spark.table(f"{own}.levels")  # analysed: its plan needs the names no more
    for name in (own, raw):
        spark.sql(f"DROP DATABASE {name} CASCADE")
    return found


@query(
    """WITH e AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'eth' ELSE 'polygon' END AS network, CAST(floor(event_id / 2.0) AS BIGINT) AS block_num, event_id FROM events),
    f AS (SELECT network, max(block_num) - 12 AS finalized_block FROM e GROUP BY network)
    SELECT network, block_num, event_id FROM e JOIN f USING (network) WHERE block_num >= 100 AND block_num <= finalized_block"""
)
def extracted_blocks(spark, sf_dir):
    """Rows from block 100 on that are at least twelve blocks behind the head of their network."""
    rows = event_rows(table(spark, sf_dir, "events")).select("network", "block_num", "event_id")
    finalized = rows.groupBy("network").agg((F.max("block_num") - 12).alias("finalized_block"))
    return extracted(rows, start_block=100, finalized=finalized)


@query(
    f"""WITH {_REGISTRY}, used AS (SELECT 'a' || (event_id % 50) AS alias, count(*) AS n FROM events GROUP BY 1),
    given AS (SELECT 'a' || ds_id AS alias, namespace || '/' || name || '@' || CASE WHEN ds_id % 4 = 0 THEN '99.0.0' ELSE version_tag END AS ref, ds_id FROM registry WHERE ds_id % 3 > 0)
    SELECT u.alias, u.n, g.ref, v.version_tag AS version, CASE WHEN g.ref IS NULL THEN 'DEPENDENCY_ALIAS_NOT_FOUND' WHEN v.ds_id IS NULL THEN 'DEPENDENCY_NOT_FOUND' END AS code
    FROM used u LEFT JOIN given g USING (alias) LEFT JOIN registry v ON v.ds_id = g.ds_id AND g.ds_id % 4 > 0"""
)
def dependency_aliases(spark, sf_dir):
    """The datasets that aliases stand for; some are not given, some name a version that does not exist."""
    r = _registry(spark, sf_dir)
    used = table(spark, sf_dir, "events").groupBy(F.concat(F.lit("a"), (F.col("event_id") % 50).cast("string")).alias("alias")).agg(F.count("*").alias("n"))
    version = F.when(F.col("ds_id") % 4 == 0, "99.0.0").otherwise(F.col("version_tag"))
    given = r.where("ds_id % 3 > 0").select(F.concat(F.lit("a"), F.col("ds_id").cast("string")).alias("alias"), domain.format_ref(F.col("namespace"), F.col("name"), version).alias("ref"))
    versions = r.select("namespace", "name", F.col("version_tag").alias("version"), F.sha2("name", 256).alias("hash"), F.col("ds_id").alias("registered"))
    return catalog.dependencies(used, given, versions).select("alias", "n", "ref", "version", "code")


# The relational operators that the engine takes from Spark SQL


@query("SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) * CAST(1 - l_discount AS DECIMAL(4, 2)) AS DECIMAL(24, 4)) AS net FROM lineitem WHERE l_quantity < 10 AND l_returnflag = 'R'")
def sql_filter_project(spark, sf_dir):
    net = (F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount")).cast("decimal(4,2)")).cast("decimal(24,4)").alias("net")
    return table(spark, sf_dir, "lineitem").where("l_quantity < 10 and l_returnflag = 'R'").select("l_orderkey", "l_linenumber", net)


@query("SELECT n_name, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def join_inner(spark, sf_dir):
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    met = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return met.groupBy("n_name").agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"))


@query("SELECT c_custkey, count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def join_left(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_orders"))


@query("SELECT coalesce(a.b, c.b) AS bucket, a.n AS n_customers, c.n AS n_suppliers FROM (SELECT CAST(floor(c_acctbal / 100) AS BIGINT) AS b, count(*) AS n FROM customer GROUP BY 1) a FULL JOIN (SELECT CAST(floor(s_acctbal / 100) AS BIGINT) AS b, count(*) AS n FROM supplier GROUP BY 1) c ON a.b = c.b")
def join_full(spark, sf_dir):
    a = table(spark, sf_dir, "customer").groupBy(F.floor(F.col("c_acctbal") / 100).alias("bucket")).agg(F.count("*").alias("n_customers"))
    b = table(spark, sf_dir, "supplier").groupBy(F.floor(F.col("s_acctbal") / 100).alias("bucket")).agg(F.count("*").alias("n_suppliers"))
    return a.join(b, "bucket", "full")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)")
def join_semi(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").where("o_totalprice > 100000")
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def join_anti(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")


@query("SELECT p.event_id, v.event_id AS view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT user_id, event_id FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.event_id >= v.event_id")
def asof_join(spark, sf_dir):
    """The last view of its user before each purchase: a window over both, no join."""
    e = table(spark, sf_dir, "events").where("event_type in ('purchase', 'view')")
    before = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(F.col("event_type") == "view", F.col("event_id")), ignorenulls=True).over(before)
    return e.withColumn("view_id", last).where("event_type = 'purchase'").select("event_id", "view_id")


@query("SELECT p.event_id, v.event_id AS view_id FROM events p JOIN events v ON v.user_id = p.user_id AND v.event_id BETWEEN p.event_id - 500 AND p.event_id - 1 WHERE p.event_type = 'purchase' AND v.event_type = 'view'")
def range_join(spark, sf_dir):
    """The views of its user among the 500 events before each purchase."""
    e = table(spark, sf_dir, "events")
    views = e.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"))
    bought = e.where("event_type = 'purchase'").select("user_id", "event_id")
    return joins.within(views, bought, ["user_id"], "view_id", F.col("event_id") - 500, F.col("event_id") - 1, 500).select("event_id", "view_id")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS quantity, min(l_shipdate) AS first, max(l_shipdate) AS last FROM lineitem GROUP BY ALL")
def agg_basic(spark, sf_dir):
    quantity = F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(28,2)").alias("quantity")
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), quantity, F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))


@query("SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def agg_distinct(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))


def _grouped(spark, sf_dir, how):
    o = table(spark, sf_dir, "orders")
    return getattr(o, how)("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def agg_rollup(spark, sf_dir):
    return _grouped(spark, sf_dir, "rollup")


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def agg_cube(spark, sf_dir):
    return _grouped(spark, sf_dir, "cube")


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
def agg_grouping_sets(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.groupingSets([["o_orderstatus"], ["o_orderpriority"], []], "o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CAST(row_number() OVER w AS INT) AS place, CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS INT) AS rank FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)")
def win_rank(spark, sf_dir):
    w = Window.partitionBy("o_custkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.row_number().over(w.orderBy(F.desc("o_totalprice"), "o_orderkey")).alias("place"), F.rank().over(w.orderBy("o_orderpriority")).alias("rank"))


@query("SELECT event_id, lag(event_id) OVER w AS before, lead(event_type) OVER w AS after FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def win_lag(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("event_id")
    return table(spark, sf_dir, "events").select("event_id", F.lag("event_id").over(w).alias("before"), F.lead("event_type").over(w).alias("after"))


@query("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id) AS running, max(event_id) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS recent FROM events")
def win_frame(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("event_id")
    return table(spark, sf_dir, "events").select("event_id", F.count("*").over(w).alias("running"), F.max("event_id").over(w.rowsBetween(-2, -1)).alias("recent"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 25 OFFSET 50")
def offset_page(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").offset(50).limit(25)


def _keys(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def set_union(spark, sf_dir):
    a, b = _keys(spark, sf_dir)
    return a.union(b).distinct()


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 0")
def set_intersect(spark, sf_dir):
    return _keys(spark, sf_dir)[0].intersect(table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_nationkey").alias("k")))


@query("SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def set_except(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k")).subtract(table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("k")))


@query("SELECT p_partkey, upper(p_name) AS name, replace(p_brand, '#', '-') AS brand, CAST(length(p_type) AS INT) AS n, substr(p_type, 1, 5) AS start, lpad(CAST(p_size AS VARCHAR), 4, '0') AS size FROM part")
def fn_string(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.upper("p_name").alias("name"), F.replace("p_brand", F.lit("#"), F.lit("-")).alias("brand"), F.length("p_type").alias("n"), F.substring("p_type", 1, 5).alias("start"), F.lpad(F.col("p_size").cast("string"), 4, "0").alias("size"))


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS DATE) + 30 AS due, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders")
def fn_date(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), d.alias("d"), F.date_add(d, 30).alias("due"), F.trunc(d, "month").alias("m"))


@query("SELECT vec_id, CAST(len(embedding) AS INT) AS n, round(CAST(list_max(embedding) AS DOUBLE), 6) AS most, CAST(len(list_filter(embedding, lambda x: x > 0)) AS INT) AS positive FROM embeddings")
def fn_array(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.size("embedding").alias("n"), F.round(F.array_max("embedding").cast("double"), 6).alias("most"), F.size(F.filter("embedding", lambda x: x > 0)).alias("positive"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def fn_json(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT p_partkey, CAST(floor(p_retailprice) AS BIGINT) AS low, CAST(ceil(p_retailprice) AS BIGINT) AS high, round(sqrt(p_retailprice), 6) AS root, CAST(p_size % 7 AS BIGINT) AS rest, CAST(abs(p_size - 25) AS BIGINT) AS away FROM part")
def fn_math(spark, sf_dir):
    price, size = F.col("p_retailprice"), F.col("p_size").cast("long")
    return table(spark, sf_dir, "part").select("p_partkey", F.floor(price).cast("long").alias("low"), F.ceil(price).cast("long").alias("high"), F.round(F.sqrt(price), 6).alias("root"), (size % 7).alias("rest"), F.abs(size - 25).alias("away"))


@query("SELECT n_nationkey, 'name' AS key, n_name AS value FROM nation UNION ALL SELECT n_nationkey, 'region', CAST(n_regionkey AS VARCHAR) FROM nation")
def fn_map(spark, sf_dir):
    """The entries of a map, a row each."""
    m = F.create_map(F.lit("name"), F.col("n_name"), F.lit("region"), F.col("n_regionkey").cast("string"))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.explode(F.map_entries(m)).alias("e")).select("n_nationkey", "e.key", "e.value")


_HOURS = "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL"


@query(_HOURS)
def tumbling_window(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


@query("SELECT start, event_type, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS start, event_type FROM events) GROUP BY ALL")
def sliding_window(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.window("ts", "1 hour", "30 minutes").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


@query(
    "SELECT user_id, min(ts) AS first, max(ts) AS last, count(*) AS n FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))) GROUP BY user_id, s"
)
def session_window(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.session_window("ts", "30 minutes").alias("w"), "user_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("n")).drop("w")


@query(_HOURS)
def stream_windows(spark, sf_dir):
    """The tumbling windows of a stream of the events file: each micro-batch writes the windows it changed, the last of each counts."""
    e = spark.readStream.schema(table(spark, sf_dir, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    out, progress = (new_path(spark, f"windows-{x}") for x in ("changed", "progress"))
    counted = processor.windowed_counts(e)
    write = lambda changed, batch: changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")
    counted.writeStream.foreachBatch(write).option("checkpointLocation", progress).outputMode("update").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).groupBy("start", "event_type").agg(F.max_by("n", "batch").alias("n"))


@query(
    f"WITH {_MARKS} SELECT m.stream, m.seq, CAST(m.tx_id AS BIGINT) AS tx_id, CASE WHEN m.tag = 'Reorg' THEN 'Undo' ELSE m.tag END AS tag, CAST(undo_start AS BIGINT) AS undo_start, CAST(undo_end AS BIGINT) AS undo_end, CAST(prune AS BIGINT) AS prune"
    " FROM messages m LEFT JOIN undone u ON u.r_id = m.tx_id LEFT JOIN pruned ON pruned.w_id = m.tx_id"
)
def stream_transactions(spark, sf_dir):
    """The transaction events of a stream of messages, by the stateful operator, written as they come and read back."""
    source, out, progress = (new_path(spark, f"transactions-{x}") for x in ("messages", "events", "progress"))
    made = processor.messages(_feed(spark, sf_dir))
    made.write.parquet(source)
    events = processor.transactions(spark.readStream.schema(made.schema).parquet(source))
    events.writeStream.format("parquet").option("checkpointLocation", progress).outputMode("append").trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(events.schema).parquet(out).select("stream", "seq", "tx_id", "tag", "undo_start", "undo_end", "prune")


@query(f"WITH {_CHANGES} SELECT 'events' AS stream, * FROM changes")
def stream_changes(spark, sf_dir):
    """The changes of cdc_changes from a stream of messages: transaction events by the stateful operator, and changes by micro-batch."""
    source, progress, kept, out = (new_path(spark, f"changes-{x}") for x in ("messages", "progress", "store", "out"))
    made = processor.messages(_feed(spark, sf_dir))
    made.write.parquet(source)
    rows = event_rows(table(spark, sf_dir, "events")).select(F.lit("events").alias("stream"), (F.col("b") * 4).alias("seq"), "network", "block_num", "event_id")
    store = stores.BatchStore(spark, kept, "stream string, tx_id long, network string, block_num long, event_id long")
    events = processor.transactions(spark.readStream.schema(made.schema).parquet(source))
    stream.for_each(events, stream.changes(rows, store, out), progress).awaitTermination()
    return spark.read.parquet(out).drop("batch")


@query(f"WITH {_REGISTRY} SELECT concat(namespace, '/', name, '@', CASE ds_id % 4 WHEN 0 THEN 'latest' WHEN 1 THEN version_tag WHEN 2 THEN sha256(name) ELSE 'dev' END) AS ref, name, version_tag AS version FROM registry")
def resolve_revision(spark, sf_dir):
    """References by tag, version and hash to the versions that they name."""
    versions = registry(table(spark, sf_dir, "documents")).select("ds_id", "namespace", "name", F.col("version_tag").alias("version"), F.sha2("name", 256).alias("hash"), F.col("ds_id").alias("registered"))
    revision = F.when(F.col("ds_id") % 4 == 0, "latest").when(F.col("ds_id") % 4 == 1, F.col("version")).when(F.col("ds_id") % 4 == 2, F.col("hash")).otherwise("dev")
    refs = versions.select(domain.format_ref(F.col("namespace"), F.col("name"), revision).alias("ref"))
    return catalog.resolve(refs, versions).select("ref", "name", "version")
