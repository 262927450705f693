"""Periodic runs of words, found through string synchronising sets.

A run is a stretch of words with smallest period q and at least 2 * q words that no neighbouring
word extends. Documents are worked on whole, many at once. For windows of 1, 2, 4, ... words:

1. Equal windows of a document get equal names, from the names of their halves. Windows that
   occur once have no name, and documents without a named window are left out of longer ones.
   So names are exact, and the common prefix of two places is found by going down the sizes.
2. Periods up to ``SMALL`` are read off by comparing the words with themselves, shifted.
3. At scale t = 4, 8, ... a synchronising set has the places whose least hashed window of t words
   among the next t + 1 is the first or the last. Windows with a period of t / 3 or less, which are
   those inside the runs found before, take no part. Places with equal contexts of 2 * t words
   are both in the set or both not, and any t places in a row have one, unless they are highly
   periodic. Two places with equal contexts at a distance of 3 * t - 1 to 6 * t - 2 propose it as
   a period. Such scales cover every period above ``SMALL``.
4. A run that has no such place in its first period is made of two highly periodic regions that
   touch, runs of one small period. Each pair of them proposes the distances at which the two are
   in phase.
5. Every proposal is extended both ways as far as it goes. Of the same stretch with several
   periods the smallest stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefetch.llm.common import mix, schema_with, ship_package, sliding_min, utf8, with_columns

#: Shortest run that is reported.
LEAST = 12
#: Periods that are found by shifting; the least scale is 4, whose periods begin at 11.
SMALL = 10
#: Words that are worked on at once, if a document has no more.
BLOCK = 1 << 18
#: Bytes of the output columns after which a batch is handed on.
BATCH_BYTES = 8 << 20

RUNS = T.ArrayType(
    T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
)
_NEVER = np.uint64((1 << 64) - 1)


@dataclass
class _Level:
    """Names of the windows of one size, in the documents that have a named one."""

    names: np.ndarray  # negative if the window occurs once
    alive: np.ndarray  # by document
    shift: np.ndarray  # by document: what to add to a place to find it in ``names``


def _named(keys: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Equal numbers for equal keys that repeat, and a negative number of its own anywhere else."""
    names = -1 - np.arange(length, dtype=np.int64)
    if len(keys):
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        again = counts[inverse] > 1
        names[at[again]] = inverse[again]
    return names


class _Texts:
    """The words of many documents in a row, and the names of their windows."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray):
        self.size = len(words)
        self.starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(lengths) else np.empty(0, np.int64)
        self.ends = self.starts + lengths
        self.doc = np.repeat(np.arange(len(lengths)), lengths)
        keys = self.doc * (int(words.max(initial=0)) + 1) + words
        names = _named(keys, np.arange(self.size), self.size)
        self.levels = [_Level(names, np.ones(len(lengths), bool), np.zeros(len(lengths), np.int64))]

    def places(self, level: _Level) -> np.ndarray:
        """The places that ``names`` of a level stand for."""
        return np.flatnonzero(level.alive[self.doc])

    def grow(self) -> bool:
        """Names windows of twice the size. False if none occurs twice in a document."""
        last, size = self.levels[-1], 1 << (len(self.levels) - 1)
        at = np.flatnonzero(last.names[: len(last.names) - size] >= 0)
        at = at[last.names[at + size] >= 0]
        # A named window ends in its document, so two of them in touch are in the same one
        # unless the first ends where the second document begins.
        places = self.places(last)
        at = at[places[at] + 2 * size <= self.ends[self.doc[places[at]]]]
        if not len(at):
            return False
        names = _named(last.names[at] * (int(last.names.max()) + 1) + last.names[at + size], at, len(last.names))
        docs = self.doc[places]
        alive = np.zeros(len(self.starts), bool)
        alive[docs[names >= 0]] = True
        if not alive.any():
            return False
        lengths = np.where(alive, self.ends - self.starts, 0)
        shift = np.cumsum(lengths) - lengths - self.starts
        self.levels.append(_Level(names[alive[docs]], alive, shift))
        return True

    def _same(self, k: int, first: np.ndarray, second: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Whether windows of 2 ** k words at two places are equal."""
        level = self.levels[k]
        shift = level.shift[docs]
        last = len(level.names) - 1
        return level.names[np.clip(first + shift, 0, last)] == level.names[np.clip(second + shift, 0, last)]

    def ahead(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """How many words from ``first`` on equal those from ``second`` on, which is later."""
        docs, done = self.doc[first], np.zeros(len(first), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            can = self.levels[k].alive[docs] & (second + done + (1 << k) <= self.ends[docs])
            done += (can & self._same(k, first + done, second + done, docs)).astype(np.int64) << k
        return done

    def behind(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """How many words before ``first`` equal those before ``second``, which is later."""
        docs, done = self.doc[first], np.zeros(len(first), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            size = 1 << k
            can = self.levels[k].alive[docs] & (first - done - size >= self.starts[docs])
            done += (can & self._same(k, first - done - size, second - done - size, docs)).astype(np.int64) << k
        return done


class _Runs:
    """The runs found so far: [left, right) and the smallest period."""

    def __init__(self, size: int):
        self.size = size + 1
        self.left = self.right = self.period = np.empty(0, np.int64)

    def add(self, left: np.ndarray, right: np.ndarray, period: np.ndarray) -> None:
        """Proposed runs, whose periods are larger than those found before, or come in one call."""
        long = right - left >= 2 * period
        left, right, period = left[long], right[long], period[long]
        order = np.lexsort((period, right, left))
        left, right, period = left[order], right[order], period[order]
        key = left * self.size + right
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        new &= ~np.isin(key, self.left * self.size + self.right)
        self.left = np.concatenate([self.left, left[new]])
        self.right = np.concatenate([self.right, right[new]])
        self.period = np.concatenate([self.period, period[new]])

    def covered(self, which: np.ndarray, less: int) -> np.ndarray:
        """Whether a place is in [left, right - less] of one of the runs."""
        edges = np.zeros(self.size + 1, np.int64)
        np.add.at(edges, self.left[which], 1)
        np.add.at(edges, self.right[which] - less + 1, -1)
        return np.cumsum(edges[: self.size - 1]) > 0


def _shifted(texts: _Texts, runs: _Runs) -> None:
    names, found = texts.levels[0].names, []
    for q in range(1, min(SMALL, texts.size - 1) + 1):
        same = np.concatenate([[False], names[:-q] == names[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        left, right = edges[::2], edges[1::2] + q
        found.append((left, right, np.full(len(left), q)))
    if found:
        runs.add(*(np.concatenate(column).astype(np.int64) for column in zip(*found)))


def _synchronised(texts: _Texts, runs: _Runs, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Proposals (place, period) of scale 2 ** k, from pairs of its synchronising set with equal contexts."""
    t, short, context = 1 << k, texts.levels[k], texts.levels[k + 1]
    places = texts.places(context)
    names = short.names[places + short.shift[texts.doc[places]]]
    hashed = mix(names.view(np.uint64))
    periodic = runs.covered((3 * runs.period <= t) & (runs.right - runs.left >= t), t)[places]
    hashed[periodic] = _NEVER
    least = sliding_min(hashed, t + 1)
    n = len(least)
    chosen = (least != _NEVER) & ((least == hashed[:n]) | (least == hashed[t : t + n])) & (context.names[:n] >= 0)
    at = np.flatnonzero(chosen)
    order = np.argsort(context.names[at], kind="stable")
    place, name = places[at][order], context.names[at][order]
    found = [(place[:0], place[:0])]
    apart = 1
    while apart < len(place):
        distance = place[apart:] - place[:-apart]
        near = (name[apart:] == name[:-apart]) & (distance <= 6 * t - 2)
        if not near.any():
            break
        wanted = near & (distance >= 3 * t - 1)
        found.append((place[:-apart][wanted], distance[wanted]))
        apart += 1
    place, period = (np.concatenate(column) for column in zip(*found))
    # Contexts that overlap at one distance are in one run, so the first of them will do.
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    first = np.ones(len(place), bool)
    first[1:] = (period[1:] != period[:-1]) | (place[1:] - place[:-1] > 2 * t) | (texts.doc[place[1:]] != texts.doc[place[:-1]])
    return place[first], period[first]


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element its number, repeated ``counts`` times, and 0, 1, 2, ... within."""
    of = np.repeat(np.arange(len(counts)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)


def _touching(texts: _Texts, runs: _Runs, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Proposals (place, period) of scale 2 ** k, from highly periodic regions that touch."""
    t = 1 << k
    regions = np.flatnonzero((3 * runs.period <= t) & (runs.right - runs.left >= 3 * t - 1))
    regions = regions[np.lexsort((runs.left[regions], runs.period[regions]))]
    left, right, p = runs.left[regions], runs.right[regions], runs.period[regions]
    key = p * runs.size + left
    low = np.searchsorted(key, p * runs.size + np.maximum(right - 2 * p, 0), side="right")
    counts = np.maximum(np.searchsorted(key, p * runs.size + right, side="right") - low, 0)
    a, n = _spread(counts)
    b = low[a] + n
    other = a != b
    # texts.doc has no place at the end of the last document
    same = texts.doc[left[a]] == texts.doc[left[b]]
    a, b = a[other & same], b[other & same]
    # The one place in the last period of the first region at which the second one's words begin.
    pair, n = _spread(p[a])
    x = right[a][pair] - 2 * p[a][pair] + n
    fits = texts.ahead(x, np.maximum(left[b][pair], x + 1)) >= p[a][pair]
    fits &= left[b][pair] > x
    a, b, x = a[pair[fits]], b[pair[fits]], x[fits]
    base, step = left[b] - x, p[a]
    most = np.minimum(np.minimum(right[a] - left[a], right[b] - left[b]), 6 * t - 2)
    first = base + step * np.maximum(0, -((base - (3 * t - 1)) // step))
    pair, n = _spread(np.maximum(0, (most - first) // step + 1))
    return (right[a] - step)[pair], first[pair] + n * step[pair]


def find_runs(words: np.ndarray, lengths: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (left, right, period), sorted, of the runs with ``least`` words or more.

    ``words`` are numbers from 0 on, those of documents with ``lengths`` words in a row.
    """
    texts = _Texts(words.astype(np.int64), np.asarray(lengths, np.int64))
    runs = _Runs(texts.size)
    if texts.size:
        _shifted(texts, runs)
    while texts.grow():  # all sizes are named before places are compared, as what they share may be long
        pass
    for scale in range(2, len(texts.levels) - 1):
        pairs = [_synchronised(texts, runs, scale), _touching(texts, runs, scale)]
        place, period = (np.concatenate(column) for column in zip(*pairs))
        inside = place + period < texts.ends[texts.doc[place]]
        place, period = place[inside], period[inside]
        left = place - texts.behind(place, place + period)
        right = place + period + texts.ahead(place, place + period)
        runs.add(left, right, period)
    long = runs.right - runs.left >= least
    found = np.stack([runs.left, runs.right, runs.period], axis=1)[long]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _numbers(split: list[list[bytes]]) -> np.ndarray:
    """Equal numbers for equal words."""
    words = pa.array(list(chain.from_iterable(split)), pa.binary())
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _collapse(columns: list[str], least: int):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def block(split: list[list[bytes]]) -> tuple[list, list]:
        lengths = np.asarray([len(words) for words in split], np.int64)
        starts = np.cumsum(lengths) - lengths
        found = find_runs(_numbers(split), lengths, least)
        edges = np.zeros(int(lengths.sum()) + 1, np.int64)
        np.add.at(edges, found[:, 0] + found[:, 2], 1)
        np.add.at(edges, found[:, 1], -1)
        gone = np.cumsum(edges[:-1]) > 0
        cuts = np.searchsorted(found[:, 0], np.append(starts, len(gone)))
        runs, texts = [], []
        for i, words in enumerate(split):
            rows = found[cuts[i] : cuts[i + 1]] if len(words) else found[:0]
            runs.append([{"start": a - int(starts[i]), "length": b - a, "period": q} for a, b, q in rows.tolist()])
            if len(rows):
                drop = gone[starts[i] : starts[i] + len(words)].tolist()
                words = [w for w, out in zip(words, drop) if not out]
            texts.append(b" ".join(words))
        return runs, texts

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(batch.schema.get_field_index("text")))
            at = 0
            while at < len(texts):
                first, split, size = at, [], 0
                while at < len(texts) and (at == first or size < BLOCK):
                    split.append((texts[at] or b"").split())
                    size += len(split[-1])
                    at += 1
                runs, collapsed = block(split)
                made = {
                    "runs": pa.array(runs, kind),
                    "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string()),
                }
                yield with_columns(batch.slice(first, at - first), made).select(columns)

    return collapse


def collapse_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` with runs, by start and period, and collapsed: the text with each run cut to its first period.

    Words are runs of anything but ASCII white space, joined by one space in collapsed. A word goes
    if a run holds it after that run's first period. A null or empty text has no run, and an empty
    collapsed text. Each row is a document of its own, whatever its doc_id; a task holds it whole,
    some hundred bytes for each of its words. All columns are kept, but runs and collapsed replace
    columns of these names.
    """
    ship_package(docs.sparkSession)
    docs = docs.withColumn("text", F.col("text").cast("string"))
    schema = schema_with(docs.schema, {"runs": RUNS, "collapsed": T.StringType()})
    return docs.mapInArrow(_collapse(schema.names, least), schema)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, which in a tenth of the documents is periodic from some word on.

    With h the crc32 of the doc_id as text and g = h div 10: if h % 10 = 0, each word from word
    a = g % n on is the one at a + (i - a) % p, with p = 1 + (n - a) div (3 + g % 8). Such a text has
    its words joined by one space. A text without words, or without a doc_id, stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split(F.col("text").cast("string"), r"[\x20\x09-\x0D]+"), "")
    chosen = F.coalesce(h % 10 == 0, F.lit(False)) & F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    g, n = F.floor(h / 10), F.size("__words")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), h.alias("__h"), F.when(chosen, words).alias("__words"))
    rows = rows.withColumn("__a", (F.expr("__h div 10") % n).cast("int"))
    rows = rows.withColumn("__p", F.expr("int(1 + (size(__words) - __a) div (3 + (__h div 10) % 8))"))

    def word(i: Column) -> Column:
        return F.when(i < F.col("__a"), i).otherwise(F.col("__a") + (i - F.col("__a")) % F.col("__p"))

    places = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("__words", word(i)))
    text = F.when(F.col("__words").isNotNull(), F.array_join(places, " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


def digest(collapsed: DataFrame) -> DataFrame:
    """doc_id, the number of runs, the longest of them, and the hashes of all runs and of the collapsed text."""
    # The longest; of equal ones the first, then the one of the smallest period.
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    rows = collapsed.select("doc_id", "runs", "collapsed", best.alias("best"))
    start, period = -F.col("best.start"), -F.col("best.period")
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        F.col("best.length").alias("length"),
        period.alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
