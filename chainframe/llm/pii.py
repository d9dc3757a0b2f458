"""Personal data by bootstrapped contextual extraction. DataFrame and SQL functions only.

Regular expressions with checks (Luhn, ranges, digit counts) find e-mail addresses, IP addresses, card and
phone numbers. These base entities are seeds: the words around them induce lexical patterns, patterns and
the identifiers that they surround (words with digits or an @) form a graph, and a few rounds score it: a
pattern is as good as the share of its identifiers that are known, an identifier as the patterns
it appears in. Identifiers of no base kind, met in a pattern of high confidence, are added as kind ``id``.

Null texts count as empty. Rows that repeat, null keys and further columns are kept (a column named ``spans`` is replaced); an empty
table gives an empty result. Positions are code points; a span's end is exclusive; spans are sorted by start, then kind. Very long texts
are searched whole, in time that grows with their length and the number of their matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainframe.llm.common import cut, others, row_hashes

#: Java patterns. Possessive repeats and \\G (where the last match ended) find what the plain expressions
#: find, in linear time and without recursion.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_SPACE = r"\x20\x09-\x0D"
#: Words that may be identifiers: they hold a digit or an @.
IDENTIFIER = r"(?<![A-Za-z0-9@])(?=[A-Za-z]*+[0-9@])[A-Za-z0-9@]++(?:[._%+/:#-]++[A-Za-z0-9@]++)*+"
#: Characters of the text at each side of a word that its patterns are taken from.
CONTEXT = 80

ROUNDS = 3
#: A pattern counts with at least this many different identifiers, one of them supposed wrong beforehand.
LEAST_INSTANCES, DOUBT = 3, 1.0
CONFIDENT = 0.8
#: Matches whose results are put together at a time (at least CONTEXT), and characters of the segments that texts are masked in.
CHUNK, SEGMENT = 128, 2_048
#: Found spans of up to this many documents are broadcast to the texts; more are joined by a shuffle.
BROADCAST_ROWS = 10_000


def _digits(match: Column) -> Column:
    return F.length(F.regexp_replace(match, "[^0-9]", ""))


def _is_card(match: Column) -> Column:
    plain = F.translate(match, " -", "")
    return F.length(plain).between(12, 19) & F.call_function("luhn_check", plain)


#: kind: (cheap test of the text, pattern, test of a match)
BASE: dict[str, tuple[Callable[[Column], Column], str, Callable[[Column], Column]]] = {
    "email": (lambda text: F.contains(text, F.lit("@")), EMAIL, lambda m: F.lit(True)),
    "ip": (lambda text: text.rlike(r"[0-9]\.[0-9]"), IP, lambda m: m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
    "card": (lambda text: text.rlike(r"[0-9][\x20-]?[0-9]"), CARD, _is_card),
    "phone": (lambda text: text.rlike(r"\+[0-9]"), PHONE, lambda m: _digits(m).between(9, 15)),
}


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once; inside a lambda it would be computed for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(items: Column, start: Column, step: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column], kind: str) -> Column:
    """Array of emit(state before, item), state being the fold of the items by step. kind: SQL type of an array of what emit gives.

    A growing array is copied at each step, so states are first carried from chunk to chunk, and each chunk then fills an array of its own.
    """

    def carry(acc, chunk):
        after = F.aggregate(chunk, acc["state"], step)
        return F.struct(after.alias("state"), F.concat(acc["all"], F.array(acc["state"])).alias("all"))

    def fill(chunk, state):
        nothing = F.expr(f"cast(array() as {kind})")
        push = lambda acc, x: F.struct(step(acc["state"], x).alias("state"), F.concat(acc["out"], F.array(emit(acc["state"], x))).alias("out"))
        return F.aggregate(chunk, F.struct(state.alias("state"), nothing.alias("out")), push, lambda acc: acc["out"])

    def cut_up(all_items):
        last = F.floor((F.size(all_items) - 1) / CHUNK).cast("int")
        some = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(all_items, i * CHUNK + 1, F.lit(CHUNK)))
        return F.when(F.size(all_items) > 0, some).otherwise(F.slice(F.array(all_items), 1, 0))

    def filled(chunks):
        states = F.aggregate(chunks, F.struct(start.alias("state"), F.slice(F.array(start), 1, 0).alias("all")), carry, lambda acc: acc["all"])
        return F.flatten(F.zip_with(chunks, states, fill))

    return _let(items, lambda x: _let(cut_up(x), filled))


def matches(text: Column, pattern: str, keep: Callable[[Column], Column], context: bool = False) -> Column:
    """Array of (start, end, value, before, after) of the matches that ``keep`` holds for; before and after: with context, the text
    on both sides of a match, CONTEXT characters of it, whatever else matches there."""
    near, none = F.lit(CONTEXT), F.lit("")

    def entries(gaps):
        # one entry a match: its text and the gaps at its sides; starts are running sums of lengths
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        each = F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("m"), F.length(g).alias("n"), (F.right(g, near) if context else none).alias("left")))
        return F.filter(each, lambda e: e["m"].isNotNull())

    def with_after(each, gaps):
        # from the last match on: what follows a match goes on into later matches
        nexts = F.transform(F.slice(gaps, F.lit(2), F.greatest(F.size(gaps) - 1, F.lit(0))), lambda g: F.left(g, near))
        backward = F.reverse(F.zip_with(each, nexts, lambda e, g: F.struct(e["m"].alias("m"), g.alias("g"))))
        beyond = lambda state, e: F.left(F.concat(e["g"], state), near)
        after = F.reverse(running(backward, none, lambda state, e: F.left(F.concat(e["m"], beyond(state, e)), near), beyond, "array<string>"))
        return F.zip_with(each, after, lambda e, x: F.struct(e["m"].alias("m"), e["n"].alias("n"), e["left"].alias("left"), x.alias("after")))

    def before(state, e):
        return F.right(F.concat(state["tail"], e["left"]), near) if context else none

    def step(state, e):
        tail = F.right(F.concat(before(state, e), e["m"]), near) if context else none
        return F.struct((state["at"] + e["n"] + F.length(e["m"])).alias("at"), tail.alias("tail"))

    def emit(state, e):
        at = state["at"] + e["n"]
        return F.struct(at.alias("start"), (at + F.length(e["m"])).alias("end"), e["m"].alias("value"), before(state, e).alias("before"), (e["after"] if context else none).alias("after"))

    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("tail"))
    spans = lambda each: running(each, start, step, emit, "array<struct<start:bigint,end:bigint,value:string,before:string,after:string>>")
    whole = lambda gaps: spans(_let(entries(gaps), lambda each: with_after(each, gaps)) if context else entries(gaps))
    return F.filter(_let(F.split(text, pattern, -1), whole), lambda x: keep(x["value"]))


def base_spans(text: Column) -> Column:
    """Array of (start, rank, end, kind), sorted."""

    def named(rank, kind):
        return lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"))

    nothing = F.expr("cast(array() as array<struct<start:bigint,rank:int,end:bigint,kind:string>>)")
    each = [F.when(test(text), F.transform(matches(text, pattern, keep), named(rank, kind))).otherwise(nothing) for rank, (kind, (test, pattern, keep)) in enumerate(BASE.items())]
    return F.array_sort(F.concat(*each))


def _mentions(text: Column) -> Column:
    """Identifiers of a text with the patterns that they stand in: the two words before; the word before and the one after.
    Runs of digits in a pattern count as the same."""
    ends = lambda s: F.regexp_replace(F.lower(F.regexp_replace(s, "[^\\p{L}\\p{N}=:#]+$", "")), "[0-9]+", "0")
    one = lambda x: F.regexp_extract(x["before"], rf"([^{_SPACE}]+)[{_SPACE}\p{{P}}]*$", 1)
    two = lambda x: F.regexp_extract(x["before"], rf"([^{_SPACE}]+[{_SPACE}]+[^{_SPACE}]+)[{_SPACE}\p{{P}}]*$", 1)
    after = lambda x: F.regexp_extract(x["after"], rf"^[{_SPACE}\p{{P}}]*([^{_SPACE}]+)", 1)

    def mention(x):
        patterns = F.array(
            F.when(ends(two(x)) != "", F.concat(F.lit("before: "), F.regexp_replace(ends(two(x)), rf"[{_SPACE}]+", " "))),
            F.when((ends(one(x)) != "") & (ends(after(x)) != ""), F.concat(F.lit("around: "), ends(one(x)), F.lit(" _ "), ends(after(x)))),
        )
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lower(x["value"]).alias("value"), F.array_compact(patterns).alias("patterns"))

    return F.when(text.rlike("[0-9@]"), F.transform(matches(text, IDENTIFIER, lambda m: F.lit(True), context=True), mention))


def _annotated(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """(row, k1, k2, base, mentions), written once: the columns to keep, what tells the row apart, and what is found in its text."""
    t = F.coalesce(F.col(text), F.lit(""))
    row = (F.struct(*keep) if keep else F.struct(F.lit(0))).alias("row")
    return cut(docs.select(row, *_keys(docs), base_spans(t).alias("base"), _mentions(t).alias("mentions")), "pii")


def _keys(docs: DataFrame) -> list[Column]:
    return [h.alias(f"k{i + 1}") for i, h in enumerate(row_hashes(docs, docs.columns))]


def score(mentions: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, confidence) of the pattern graph. mentions: pattern, value, known (part of a base entity)."""
    edges = cut(mentions.groupBy("pattern", "value").agg(F.max(F.col("known").cast("int")).alias("known")), "pii-edges")
    seeds = edges.groupBy("value").agg(F.max("known").alias("known"))
    values = cut(seeds.select("value", "known", F.col("known").cast("double").alias("score")), "pii-values")
    for k in range(rounds):
        patterns = cut(
            edges.join(values.select("value", "score"), "value").groupBy("pattern").agg(F.sum("score").alias("s"), F.count("*").alias("n")).where(F.col("n") >= LEAST_INSTANCES).select("pattern", (F.col("s") / (F.col("n") + DOUBT)).alias("confidence")),
            f"pii-patterns{k}",
        )
        if k + 1 < rounds:
            met = edges.join(patterns, "pattern").groupBy("value").agg(F.sum(F.log(1 - F.least("confidence", F.lit(0.99)))).alias("miss"))
            values = cut(values.select("value", "known").join(met, "value", "left").select("value", "known", F.when(F.col("known") == 1, 1.0).otherwise(F.coalesce(1 - F.exp("miss"), F.lit(0.0))).alias("score")), f"pii-values{k}")
    return patterns


def _judged(base: Column, mentions: Column) -> Column:
    """The mentions with ``known``, whether a base span overlaps them: one that starts no later and ends after their start, or the next one."""
    kind = "array<struct<start:bigint,is:int,end:bigint,value:string,patterns:array<string>,known:boolean>>"

    def entry(x, is_, value, patterns, known):
        return F.struct(x["start"].alias("start"), is_.alias("is"), x["end"].alias("end"), value.alias("value"), patterns.alias("patterns"), known.alias("known"))

    nothing = F.lit(None).cast("array<string>")
    spans = F.transform(base, lambda x: entry(x, F.lit(0), F.lit(None).cast("string"), nothing, F.lit(False)))
    both = F.array_sort(F.concat(spans, F.transform(mentions, lambda x: entry(x, F.lit(1), x["value"], x["patterns"], F.lit(False)))))
    marked = lambda x, hit: entry(x, x["is"], x["value"], x["patterns"], x["known"] | hit)
    ends = running(both, F.lit(-1).cast("long"), lambda end, x: F.when(x["is"] == 0, F.greatest(end, x["end"])).otherwise(end), lambda end, x: marked(x, end > x["start"]), kind)
    starts = running(F.reverse(ends), F.lit((1 << 63) - 1), lambda start, x: F.when(x["is"] == 0, x["start"]).otherwise(start), lambda start, x: marked(x, start < x["end"]), kind)
    return F.filter(starts, lambda x: x["is"] == 1)


def discover(annotated: DataFrame, confident: float = CONFIDENT) -> DataFrame:
    """(k1, k2, more): spans of kind ``id`` that patterns of high confidence found, by row."""
    seen = annotated.where(F.size("mentions") > 0).select("k1", "k2", F.explode(_judged(F.col("base"), F.col("mentions"))).alias("m"))
    each = cut(seen.select("k1", "k2", "m.start", "m.end", "m.value", "m.known", F.explode("m.patterns").alias("pattern")), "pii-mentions")
    good = score(each.select("pattern", "value", "known")).where(F.col("confidence") >= confident)
    found = each.where("not known").join(good, "pattern")
    span = F.struct("start", F.lit(len(BASE)).alias("rank"), "end", F.lit("id").alias("kind"))
    return cut(found.groupBy("k1", "k2").agg(F.array_sort(F.collect_set(span)).alias("more")), "pii-found")


def _joined(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows with ``more``; found is broadcast only if it is short."""
    small = found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(found) if small else found, ["k1", "k2"], "left")


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without the text, with ``spans``: array of (start, rank, end, kind)."""
    annotated = _annotated(docs, text, others(docs, text, "spans"))
    return _joined(annotated, discover(annotated)).select("row.*", _all_spans().alias("spans"))


def _all_spans() -> Column:
    return F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))


def mask(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans replaced by the kind of its first one, as <EMAIL>."""
    kept = F.expr("cast(null as struct<at:bigint,start:bigint,end:bigint,kind:string>)")
    # at: where text that is not yet given out starts. A span that starts earlier belongs to the run before it.
    step = lambda at, x: F.greatest(at, x["end"])
    emit = lambda at, x: F.when(x["start"] >= at, F.struct(at.alias("at"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))).otherwise(kept)
    runs = F.filter(running(spans, F.lit(0).cast("long"), step, emit, "array<struct<at:bigint,start:bigint,end:bigint,kind:string>>"), lambda x: x.isNotNull())

    def piece(segments, a, b):
        first, last = F.floor(a / SEGMENT).cast("int"), F.floor(b / SEGMENT).cast("int")
        from_, to = (a % SEGMENT).cast("int"), (b % SEGMENT).cast("int")
        head = F.substring(F.get(segments, first), from_ + 1, F.when(first == last, to - from_).otherwise(SEGMENT))
        middle = F.array_join(F.slice(segments, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        tail = F.when(first == last, "").otherwise(F.substring(F.coalesce(F.get(segments, last), F.lit("")), F.lit(1), to))
        return F.concat(F.coalesce(head, F.lit("")), middle, tail)

    def masked(segments):
        parts = F.transform(runs, lambda x: F.concat(piece(segments, x["at"], x["start"]), F.lit("<"), F.upper(x["kind"]), F.lit(">")))
        return F.concat(F.array_join(parts, ""), piece(segments, F.array_max(F.transform(spans, lambda x: x["end"])), F.length(text).cast("long")))

    # in segments, a piece is found without a walk from the start of the text
    return F.when(F.size(spans) > 0, _let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{SEGMENT}}}"), F.lit(0)), masked)).otherwise(text)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with personal data masked in the text; null texts stay null."""
    annotated = _annotated(docs, text, docs.columns)
    masked = mask(F.col(f"row.{text}"), _all_spans())
    return _joined(annotated, discover(annotated)).select(*(masked.alias(text) if c == text else F.col(f"row.{c}") for c in docs.columns))
