"""Language identification by word scores and a Viterbi pass.

Training counts hashed character n-grams of words for each label, over a bounded sample of labelled
rows. Prediction: the script of a word's letters narrows which labels are candidates; the n-grams of the word
score them; a Viterbi pass over the words of the whole text with a penalty for each switch labels spans,
so texts in several languages come apart. The label with the most letters is the prediction, and its share
of the letters, weighed by how sure its words are, is the score.

Words are runs of letters with the marks that go with them (vowel signs, accents); numerals that are no letters are in none. A text that
is null or has no letter is ``und`` with score 0. Ties go to the label that sorts first. Repeated
rows, null keys and further columns are kept; columns named like one of the results are replaced. An empty table gives an empty result; without
any labelled row every text is ``und``. Very long texts are labelled whole. Any number of labels is learned: the more there are,
the fewer buckets their n-grams share, so that the model has at most MODEL_NUMBERS numbers.
"""

from __future__ import annotations

import functools
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainframe.llm.common import bound_batches, others, slices

UNKNOWN = "und"
#: Labelled rows that the model is fitted on, at most about this many, chosen for each label by the hash of their key and text.
SAMPLE_ROWS = 8_000
#: Buckets of hashed n-grams at most, the n of the n-grams, and the bound of buckets times labels.
BUCKETS, ORDERS, MODEL_NUMBERS = 1 << 16, (1, 2, 3, 4), 1 << 23
SWITCH_PENALTY = 6.0
#: Distinct words whose scores a worker keeps.
KNOWN_WORDS = 200_000
#: Scores that a worker holds at a time.
SCORES = 1_000_000
#: Longer words (and texts without spaces) are scored in parts of this many letters.
WORD_LETTERS = 24
WORDS = regex.compile(rf"\p{{L}}[\p{{L}}\p{{M}}]{{0,{WORD_LETTERS - 1}}}")
#: The first and last code point of scripts, by their Unicode blocks.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F),),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "kana": ((0x3040, 0x30FF),),
    "hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF)),
}
_BOUNDS = sorted((first, last, name) for name, spans in SCRIPTS.items() for first, last in spans)
_FIRST, _LAST = np.array([b[0] for b in _BOUNDS]), np.array([b[1] for b in _BOUNDS])
_NAMES = [b[2] for b in _BOUNDS]
_NUMBERED = [*SCRIPTS, "other"]


def script(word: str) -> str:
    """The script of a word's first letter."""
    i = int(np.searchsorted(_FIRST, ord(word[0]), "right")) - 1
    return _NAMES[i] if i >= 0 and ord(word[0]) <= _LAST[i] else "other"


def grams(words: list[str], buckets: int = BUCKETS):
    """For each n: the bucket of the n-gram at each place of the words with their ends marked, and whether it lies in one word.
    Last, where each word starts."""
    marked = [f"<{w.lower()}>" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    letters = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(marked)), lengths)
    out = []
    for n in ORDERS:
        h, ok = np.full(len(letters), n, np.uint64), np.zeros(len(letters), bool)
        for k in range(n):
            h[: len(letters) - k] = (h[: len(letters) - k] ^ letters[k:]) * np.uint64(0x9E3779B97F4A7C15)
        ok[: len(letters) - n + 1] = word[n - 1 :] == word[: len(letters) - n + 1]
        out.append(((h >> np.uint64(40)) % np.uint64(buckets), ok))
    return out, np.cumsum(lengths) - lengths


@dataclass
class Model:
    labels: list[str]
    logs: np.ndarray  # buckets x labels: log probability of a bucket
    scripts: dict[str, list[int]]  # labels seen with a script

    def words(self, words: list[str]) -> np.ndarray:
        """Log scores of the labels for each word, at most 0; labels never seen with a word's script are out of the question."""
        step = max(1, SCORES // (12 * max(1, len(self.labels))))
        out = np.zeros((len(words), len(self.labels)), np.float32)
        for at in range(0, len(words), step):
            some = words[at : at + step]
            found, starts = grams(some, len(self.logs))
            scores = sum(np.add.reduceat(np.where(ok[:, None], self.logs[bucket], np.float32(0)), starts) for bucket, ok in found)
            for i, name in enumerate(map(script, some)):
                seen = self.scripts.get(name)
                if seen and len(seen) < len(self.labels):
                    scores[i] -= _barred(len(self.labels), tuple(seen))
            out[at : at + step] = scores - scores.max(axis=1, keepdims=True)
        return out


@functools.lru_cache(64)
def _barred(n: int, seen: tuple[int, ...]) -> np.ndarray:
    mask = np.full(n, 50, np.float32)
    mask[list(seen)] = 0
    return mask


def _counted(rows: DataFrame, buckets: int) -> DataFrame:
    """(label, bucket, n) over rows (text, label), and (label, script, n) as negative buckets. label: its number."""
    schema = pa.schema([("label", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches):
        for batch in slices(batches, "text"):
            by_label: dict[int, Counter] = {}
            for t, name in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                by_label.setdefault(name, Counter()).update(WORDS.findall(t))
            for name, counted in by_label.items():
                if not counted:
                    continue
                words, times = list(counted), np.fromiter(counted.values(), np.int64, len(counted))
                found, starts = grams(words, buckets)
                each = np.repeat(times, np.diff(starts, append=len(found[0][0])))
                n = sum(np.bincount(bucket[ok].astype(np.int64), each[ok], buckets) for bucket, ok in found).astype(np.int64)
                scripts = Counter()
                for w, k in counted.items():
                    scripts[-1 - _NUMBERED.index(script(w))] += k
                seen = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict({"label": [name] * (len(seen) + len(scripts)), "bucket": [*seen.tolist(), *scripts], "n": [*n[seen].tolist(), *scripts.values()]}, schema=schema)

    return rows.mapInArrow(run, "label int, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))


def _quota(sizes: list[int], total: int) -> int:
    """The largest number of rows that each label may give, as far as it has them, so that all give at most total (at least 1)."""
    for i, n in enumerate(sorted(sizes)):
        even = total // (len(sizes) - i)
        if n > even:
            return max(1, even)
        total -= n
    return max(1, *sizes) if sizes else 1


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """labelled: rows to learn from. Counts come to the driver by bucket and label: at most MODEL_NUMBERS rows of 16 bytes, whatever the
    number of labelled rows."""
    spark = bound_batches(labelled.sparkSession)
    usable = labelled.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).cast("string").alias("name"))
    per_label = sorted((r[0], r[1]) for r in usable.groupBy("name").count().collect())
    labels = [name for name, _ in per_label]
    buckets = BUCKETS
    while buckets > 1 and buckets * len(labels) > MODEL_NUMBERS:
        buckets //= 2
    counts, scripts = np.zeros((buckets, len(labels)), np.float32), {}
    if labels:
        most = _quota([n for _, n in per_label], sample_rows)
        chosen = spark.createDataFrame([(name, i, -(-n // most)) for i, (name, n) in enumerate(per_label)], "name string, label int, every long")
        sample = usable.join(F.broadcast(chosen), "name").where(F.pmod(F.xxhash64("key", "text"), F.col("every")) == 0)  # a row a label
        found = _counted(sample.select("text", "label"), buckets).toArrow()
        column, bucket, n = (found.column(c).to_numpy() for c in ("label", "bucket", "n"))
        in_text = bucket >= 0
        counts[bucket[in_text], column[in_text]] = n[in_text]
        for b, c, k in zip(bucket[~in_text].tolist(), column[~in_text].tolist(), n[~in_text].tolist(), strict=True):
            if k >= 3:
                scripts.setdefault(_NUMBERED[-1 - b], []).append(c)
    counts += np.float32(0.1)
    return Model(labels, np.log(counts / counts.sum(axis=0, keepdims=True)).astype(np.float32), scripts)


def viterbi(scores: list[np.ndarray], penalty: float = SWITCH_PENALTY) -> list[np.ndarray]:
    """The best label of each word, for many texts at once. scores: words x labels for each text.

    Texts of like length move together, a word at a time, and the few longest go on alone; a text's result does not depend on the others.
    """
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(scores)
    order = sorted((i for i in range(len(scores)) if len(scores[i])), key=lambda i: -len(scores[i]))
    for at in range(0, len(order), 256):
        group = order[at : at + 256]
        n = np.array([len(scores[i]) for i in group])
        best = np.stack([scores[i][0] for i in group]).astype(np.float64)
        few = max(1, 32 // best.shape[1])
        came = [np.zeros(best.shape, np.int16)]
        flat, first = np.concatenate([scores[i] for i in group]), np.concatenate([[0], np.cumsum(n)[:-1]])
        own = np.arange(best.shape[1], dtype=np.int16)
        live = np.searchsorted(-n, -np.arange(int(n[0])), "left")  # texts longer than t words
        live[0] = len(group)
        together = int(np.searchsorted(-live, -few, "right")) or 1  # words that at least so many texts have
        for t in range(1, together):
            now = best[: live[t]]
            top = now.argmax(axis=1)
            jump = now[np.arange(live[t]), top] - penalty
            switch = jump[:, None] > now
            came.append(np.where(switch, top[:, None].astype(np.int16), own))
            best[: live[t]] = np.where(switch, jump[:, None], now) + flat[first[: live[t]] + t]
        label = best.argmax(axis=1)
        paths = np.zeros(len(flat), np.int64)
        for i in np.flatnonzero(n > together).tolist():
            label[i], paths[first[i] + together : first[i] + n[i]] = _alone(best[i].tolist(), flat[first[i] + together : first[i] + n[i]].tolist(), penalty)
        for t in range(together - 1, -1, -1):
            paths[first[: live[t]] + t] = label[: live[t]]
            if t:
                label[: live[t]] = came[t][np.arange(live[t]), label[: live[t]]]
        for i, a, k in zip(group, first, n, strict=True):
            out[i] = paths[a : a + k]
    return out


def _alone(best: list[float], rows: list[list[float]], penalty: float) -> tuple[int, list[int]]:
    """(label before, labels of the rows): the pass of one text on from the values best."""
    came, own = [], range(len(best))
    for row in rows:
        high = max(best)
        jump, top = high - penalty, best.index(high)
        came.append([top if jump > b else k for k, b in zip(own, best, strict=True)])
        best = [(jump if jump > b else b) + x for b, x in zip(best, row, strict=True)]
    label, path = best.index(max(best)), []
    for back in reversed(came):
        path.append(label)
        label = back[label]
    return label, path[::-1]


def settled(scores: np.ndarray, penalty: float) -> int:
    """The label of a text that keeps one throughout, or -1 if only the Viterbi pass can tell.

    Leaving the best label for a stretch costs two switches (one at an end of the text), so if no stretch
    gains as much, however labels change in it, the constant path is the best one.
    """
    best = int(scores.sum(axis=0, dtype=np.float64).argmax())
    gain = np.delete(scores, best, axis=1).max(axis=1, initial=-np.inf).astype(np.float64) - scores[:, best]
    sums = np.concatenate([[0.0], np.cumsum(gain)])
    if sums.max() >= penalty or (sums[-1] - sums).max() >= penalty or (sums - np.minimum.accumulate(sums)).max() >= 2 * penalty:
        return -1
    return best


def paths(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """The label of each word of each text."""
    same = [settled(x, penalty) if len(x) else -1 for x in scores]
    rest = iter(viterbi([x for x, k in zip(scores, same, strict=True) if k < 0], penalty))
    return [np.full(len(x), k) if k >= 0 else next(rest) for x, k in zip(scores, same, strict=True)]


def _spans(text: str, words: list[str], path: np.ndarray, labels: list[str]) -> list[dict]:
    turns = np.flatnonzero(np.diff(path, prepend=-1)).tolist()
    if len(turns) == 1:  # from the first word to where the last one stands last
        return [{"lang": labels[path[0]], "start": text.index(words[0]), "end": text.rindex(words[-1]) + len(words[-1])}]
    at, starts, find = 0, [], text.find
    for w in words:  # no letter stands between a word and the next, so that is where its letters are found next
        at = find(w, at)
        starts.append(at)
        at += len(w)
    return [{"lang": labels[path[a]], "start": starts[a], "end": starts[b - 1] + len(words[b - 1])} for a, b in zip(turns, [*turns[1:], len(path)], strict=True)]


def _label(texts: list[str], words: list[list[str]], scores: np.ndarray, labels: list[str], penalty: float) -> list[tuple]:
    """(label, score, spans) of texts; scores: of all their words in order."""
    bounds = np.cumsum([0, *map(len, words)])
    each = [scores[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
    out = []
    for text, found, score, path in zip(texts, words, each, paths(each, penalty), strict=True):
        if not found:
            out.append((UNKNOWN, 0.0, []))
            continue
        letters = np.fromiter(map(len, found), np.float64, len(found))
        mass = np.bincount(path, letters, len(labels))
        pick = int(mass.argmax())
        inside = path == pick
        odds = np.exp(score[inside].astype(np.float64))
        trust = (odds[:, pick] / odds.sum(axis=1) * letters[inside]).sum() / mass[pick]
        out.append((labels[pick], float(min(1.0, mass[pick] / letters.sum() * trust)), _spans(text, found, path, labels)))
    return out


def predict(docs: DataFrame, model: Model, text: str = "text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """docs with ``lang_pred``, ``score`` and ``lang_spans`` (label, start, end in code points, end exclusive)."""
    spark = bound_batches(docs.sparkSession, size="4m")
    shared = spark.sparkContext.broadcast(model)  # at most MODEL_NUMBERS numbers, whatever the number of documents
    span = T.StructType([T.StructField("lang", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    docs = docs.select(*others(docs, "lang_pred", "score", "lang_spans"))
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False), T.StructField("lang_spans", T.ArrayType(span), False)])
    arrow = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        model = shared.value
        labels = model.labels
        known: dict[str, int] = {}
        table = np.zeros((0, len(labels)), np.float32)
        most = max(1, SCORES // max(1, len(labels)))  # words at a time
        for batch in slices(batches, text, most=1 << 21, rows=4_096):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            made, group, words, n = [], [], [], 0
            for i, t in enumerate(texts):
                found = WORDS.findall(t) if labels else []
                group.append(t)
                words.append(found)
                n += len(found)
                if n < most and i + 1 < len(texts):
                    continue
                if len(known) > KNOWN_WORDS:
                    known, table = {}, table[:0]
                fresh = [w for w in set(chain.from_iterable(words)) if w not in known]
                known.update(zip(fresh, range(len(known), len(known) + len(fresh)), strict=True))
                table = np.concatenate([table, model.words(fresh)])
                at = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.int64, n)
                made += _label(group, words, table[at], labels, penalty)
                group, words, n = [], [], 0
            columns = [pa.array([x[k] for x in made], kind) for k, kind in enumerate((pa.string(), pa.float64(), arrow))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "lang_pred", "score", "lang_spans"])

    return docs.mapInArrow(run, schema)


def held_out(key: str = "doc_id"):
    """Whether a row is kept out of training."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
