"""Suffix-array dedup: removes bytes of strings that start earlier, through merged Burrows-Wheeler transforms.

A string of ``size`` bytes is a window. Windows that may repeat are cut out as fragments, and
fragments that share windows meet in one bucket, where their suffixes are put in order:

1. The anchor of a window is the least of the hashes of its ``GRAM``-byte grams. Equal windows
   have equal anchors, and windows in a row mostly share one: together they are a fragment. Tasks
   send the anchors' hashes, packed; anchors that occur twice make up a bitmap of bounded size.
2. A second scan gives the fragments whose anchor is in the bitmap. It only lets too many pass.
   Equal fragments are put together, with their number and the earliest place.
3. Fragments are dealt over buckets of bounded size by their anchor. The fragments of an anchor
   that is too common for a bucket are cut into single windows, which are dealt by their content.
4. In a bucket, the symbols are blocks of bytes, numbered. A shard of fragments is a few hundred
   kilobytes: its suffixes are sorted, which gives its transform. The transforms of all
   shards are merged by refining the interleave of their rows: reading the symbols in the order of
   the interleave and dealing the rows by them, stably, extends the order by one symbol. No suffix
   is compared with one of another shard. Rows that are told apart by a round get that round as
   their common prefix; intervals that no round parts are the repeated windows.
5. Each interval has its earliest place. A window that does not start there is removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefetch.llm.common import (
    discard,
    mix,
    ngrams,
    schema_with,
    settle,
    ship_package,
    sliding_min,
    utf8,
    with_columns,
)

SIZE = 100
GRAM = 24
#: Bytes of a symbol at most; it divides the size of a window.
SYMBOL = 50
#: Bytes of text that are scanned together, and window starts whose hashes are held at once.
SLICE = 4 << 20
CHUNK = 1 << 19
#: Bytes of text whose anchors are counted in one group.
COUNTED = 64 << 20
#: The bitmap has 8 bits for each anchor, up to this number as a power of two (128 MB).
MOST_BITS = 30
#: Bytes of fragments in a bucket and in a shard, and those of one anchor from which on it is split.
BUCKET = 3 << 19
SHARD = 1 << 18
HOT = 1 << 20
#: Fragments with more than this part of all occurrences are fewer than this many.
HOT_PART = 1_000

_PLACE_BITS = 20
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
_AGAIN = np.uint64(0x9E3779B97F4A7C15)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _AGAIN)


def _slices(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[list[pa.Array], list[bytes]]]:
    """The columns ``names`` and the texts of some rows at a time, about ``SLICE`` bytes of text."""
    for batch in batches:
        texts = [t or b"" for t in utf8(batch.column(batch.schema.get_field_index("text")))]
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        at = 0
        while at < len(texts):
            first, size = at, 0
            while at < len(texts) and (at == first or size + len(texts[at]) <= SLICE):
                size += len(texts[at])
                at += 1
            yield [c.slice(first, at - first) for c in columns], texts[first:at]


def _runs(texts: list[bytes], size: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined texts, the end of each, and first start, last start and anchor of runs of windows that share an anchor.

    The anchor is the leftmost gram with the least hash, but for the last bits of it, so a run is
    shorter than a window and an anchor that occurs twice makes two runs.
    """
    data = b"".join(texts)
    ends = np.cumsum([len(t) for t in texts])
    array, gram = np.frombuffer(data, np.uint8), min(GRAM, size)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))]
    for low in range(0, len(array) - size + 1, CHUNK):
        grams = ngrams(_BYTES[array[low : low + CHUNK + size - 1]], gram)
        packed = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        least = (sliding_min(packed, size - gram + 1) & _PLACE).astype(np.int64)
        # Windows that end in the text that they start in.
        a, b = np.searchsorted(ends, [low, low + len(least) - 1], side="right")
        reach = np.repeat(ends[a : b + 1], np.diff(np.clip(np.append(low, ends[a : b + 1]), low, low + len(least))))
        starts = np.flatnonzero(np.arange(low + size, low + size + len(least)) <= reach)
        anchors = least[starts]
        edge = np.flatnonzero(anchors[1:] != anchors[:-1])
        first = starts[np.concatenate([[0], edge + 1])] if len(starts) else starts
        last = starts[np.append(edge, len(starts) - 1)] if len(starts) else starts
        # Least hashes are small, so they are hashed again to spread.
        found.append((first + low, last + low, mix(grams[least[first]] + _AGAIN)))
    return data, ends, *(np.concatenate(column) for column in zip(*found))


def _count(size: int, part_bits: int):
    """Packed anchors of each part of the hash range; one that a slice has twice is there twice."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _slices(batches, ()):
            anchors, counts = np.unique(_runs(texts, size)[4], return_counts=True)
            anchors = np.repeat(anchors, np.minimum(counts, 2))
            bounds = np.arange(1, 1 << part_bits, dtype=np.uint64) << np.uint64(64 - part_bits) if part_bits else []
            cuts = [0, *np.searchsorted(anchors, bounds).tolist(), len(anchors)]
            parts = [p for p in range(1 << part_bits) if cuts[p] < cuts[p + 1]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(parts, pa.int32()),
                    pa.array([anchors[cuts[p] : cuts[p + 1]].tobytes() for p in parts], pa.binary()),
                ],
                ["part", "anchors"],
            )

    return count


def _repeated(bits: int, part_bits: int):
    """The bits of the anchors of a part that occur twice."""

    def repeated(table: pa.Table) -> pa.Table:
        anchors = np.frombuffer(b"".join(table.column("anchors").to_pylist()), np.uint64)
        anchors = np.sort(anchors)
        again = anchors[1:][anchors[1:] == anchors[:-1]]
        held = np.zeros(1 << (bits - part_bits), bool)
        held[(again >> np.uint64(64 - bits)) & np.uint64(len(held) - 1)] = True
        return pa.table({"part": table.column("part").slice(0, 1), "held": pa.array([np.packbits(held).tobytes()], pa.binary())})

    return repeated


def _bitmap(docs: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Which hashes, by their first bits, may be those of an anchor that occurs twice."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    part_bits = max(0, (total // COUNTED).bit_length())
    bits = min(MOST_BITS, max(16 + part_bits, (total // 4).bit_length()))
    part_bits = min(part_bits, bits - 3)
    packed = docs.mapInArrow(_count(size, part_bits), "part int, anchors binary")
    rows = packed.groupBy("part").applyInArrow(_repeated(bits, part_bits), "part int, held binary").toArrow()
    held = np.zeros(1 << (bits - 3), np.uint8)
    length = len(held) >> part_bits
    for part, piece in zip(rows.column("part").to_pylist(), rows.column("held")):
        held[part * length : (part + 1) * length] = np.frombuffer(piece.as_buffer(), np.uint8)
    return held, bits


_FRAGMENTS = (
    "doc_id long, mark long, starts array<long>, k1s array<long>, k2s array<long>, "
    "k1 long, k2 long, anchor long, content binary, first_doc long, first_start long, n long"
)


def _cut(size: int, bitmap, bits: int):
    """Two kinds of rows: the places and keys of each document's fragments, and the distinct fragments of a slice."""
    names = [part.split()[0] for part in _FRAGMENTS.split(", ")]
    longs = pa.list_(pa.int64())
    kinds = [pa.int64(), pa.int64(), longs, longs, longs, pa.int64(), pa.int64(), pa.int64(), pa.binary()] + [pa.int64()] * 3

    def rows(columns: dict[str, pa.Array | np.ndarray | list], n: int) -> pa.RecordBatch:
        arrays = [pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bitmap.value
        for (ids, marks), texts in _slices(batches, ("doc_id", "mark")):
            data, ends, first, last, anchors = _runs(texts, size)
            cells = anchors >> np.uint64(64 - bits)
            wanted = (held[cells >> np.uint64(3)] >> (np.uint8(7) - (cells & np.uint64(7)).astype(np.uint8))) & 1 == 1
            first, last, anchors = first[wanted], last[wanted], anchors[wanted]
            if not len(first):
                continue
            known: dict[bytes, int] = {}
            which = np.empty(len(first), np.int64)
            for i, (a, b) in enumerate(zip(first.tolist(), (last + size).tolist())):
                which[i] = known.setdefault(data[a:b], len(known))
            contents = list(known)
            keys = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, contents)), "<i8").reshape(-1, 2)
            doc = np.searchsorted(ends, first, side="right")
            starts = first - np.append(0, ends)[doc]
            doc_ids = ids.to_numpy()[doc]
            order = np.lexsort((starts, doc_ids, which))
            heads = order[np.searchsorted(which[order], np.arange(len(contents)))]
            counts = np.bincount(which, minlength=len(contents))
            yield rows(
                {
                    "k1": keys[:, 0].copy(),
                    "k2": keys[:, 1].copy(),
                    "anchor": anchors.view(np.int64)[heads],
                    "content": contents,
                    "first_doc": doc_ids[heads],
                    "first_start": starts[heads],
                    "n": counts,
                },
                len(contents),
            )
            docs, at = np.unique(doc, return_index=True)
            edges = pa.array(np.append(at, len(doc)), pa.int32())
            yield rows(
                {
                    "doc_id": ids.to_numpy()[docs],
                    "mark": marks.to_numpy()[docs],
                    "starts": pa.ListArray.from_arrays(edges, pa.array(starts)),
                    "k1s": pa.ListArray.from_arrays(edges, pa.array(keys[which, 0])),
                    "k2s": pa.ListArray.from_arrays(edges, pa.array(keys[which, 1])),
                },
                len(docs),
            )

    return cut


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element its number, repeated ``counts`` times, and 0, 1, 2, ... within."""
    of = np.repeat(np.arange(len(counts)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)


def _stable(values: np.ndarray) -> np.ndarray:
    """A stable order of unsigned 32-bit values, by their halves."""
    order = np.argsort((values & np.uint32(0xFFFF)).astype(np.uint16), kind="stable")
    if len(values) and int(values.max()) >> 16:
        order = order[np.argsort((values >> np.uint32(16)).astype(np.uint16)[order], kind="stable")]
    return order


def _order(values: np.ndarray) -> np.ndarray:
    """A stable order of unsigned 64-bit values.

    Where a value and its place fit into one number, these are sorted, which takes a fraction of the time.
    """
    bits = max(1, len(values).bit_length())
    if int(values.max(initial=0)).bit_length() + bits > 64:
        return np.argsort(values, kind="stable")
    mask = np.uint64((1 << bits) - 1)
    return (np.sort(values << np.uint64(bits) | np.arange(len(values), dtype=np.uint64)) & mask).view(np.int64)


class Shards:
    """The suffixes of some strings, cut into shards, at every place from which a window follows.

    A symbol is ``width`` bytes, so a string is read as chains of symbols, one for each rest of a
    place by ``width``; those on which no window of ``depth`` symbols starts are left out. Each chain
    ends with the mark 0. The rows are the places of a chain one after the other, chain by chain;
    the last, from which no whole symbol follows, is the end of its chain.
    """

    def __init__(self, strings: list[bytes], width: int, depth: int, shard_bytes: int = SHARD):
        self.width, self.depth = width, depth
        lengths = np.asarray([len(s) for s in strings], np.int64)
        self.base = np.cumsum(lengths + 1) - lengths - 1
        chain_string, rest = _spread(np.clip(lengths - width * depth + 1, 0, width))
        chain, step = _spread((lengths[chain_string] - rest) // width + 1)
        self.string, self.place, self.step = chain_string[chain], rest[chain] + step * width, step
        self.left = lengths[self.string] - self.place
        self.symbols = self._symbols(b"\0".join(strings) + bytes(width + 8))
        # Shards of whole strings.
        shard = ((np.cumsum(lengths) - lengths) // shard_bytes)[self.string]
        self.edges = np.append(np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])), len(shard))

    def _symbols(self, data: bytes) -> np.ndarray:
        """A number from 1 on for the whole block at each place, equal for equal blocks; 0 at an end.

        Blocks are put in the order of a hash. Neighbours in it of one hash are compared, so equal
        numbers mean equal bytes. The first bits of the hash are tried first; if they have two blocks,
        the whole hash is, and if that has two, the order is by the blocks' bytes.
        """
        whole = np.flatnonzero(self.left >= self.width)
        at = (self.base[self.string] + self.place)[whole]
        hashes = ngrams(_BYTES[np.frombuffer(data, np.uint8)], self.width)[at]
        for values in (hashes >> np.uint64(len(at).bit_length()), hashes):
            order = _order(values)
            in_order = values[order]
            new = np.concatenate([[True], in_order[1:] != in_order[:-1]])[: len(at)]
            same = np.flatnonzero(~new)
            if self._equal(data, at[order[same]], at[order[same - 1]]):
                break
        else:
            blocks = np.asarray([data[a : a + self.width] for a in at.tolist()], f"S{self.width}")
            order = np.argsort(blocks)
            new = np.concatenate([[True], blocks[order][1:] != blocks[order][:-1]])
        symbols = np.zeros(len(self.place), np.uint32)
        symbols[whole[order]] = np.cumsum(new, dtype=np.uint32)
        return symbols

    def _equal(self, data: bytes, one: np.ndarray, other: np.ndarray) -> bool:
        """Whether the blocks at these places are equal, pair by pair."""
        eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        for start in range(0, self.width, 8):
            start = min(start, max(0, self.width - 8))
            different = eight[one + start] ^ eight[other + start]
            if self.width < 8:
                different &= np.uint64((1 << 8 * self.width) - 1)
            if different.any():
                return False
        return True

    def ahead(self, steps: int) -> np.ndarray:
        """The symbol that many symbols further on in the chain, 0 behind its end."""
        inside = np.flatnonzero(self.left >= steps * self.width)
        out = np.zeros(len(self.symbols), np.uint64)
        out[inside] = self.symbols[inside + steps]
        return out

    def transform(self, number: int, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The rows of a shard in the order of ``depth`` symbols, and the symbol before each: its transform."""
        low, high = self.edges[number], self.edges[number + 1]
        own = [key[low:high] for key in reversed(keys)]
        rows = (_order(own[0]) if len(own) == 1 else np.lexsort(own)) + low
        before = np.where(self.step[rows] > 0, self.symbols[rows - 1], np.uint32(0))
        return rows, before

    def _keys(self) -> list[np.ndarray]:
        """The next ``depth`` symbols, as many in one number as it can hold."""
        bits = max(1, int(self.symbols.max(initial=0)).bit_length())
        keys: list[np.ndarray] = []
        for step in range(self.depth):
            if step % (64 // bits):
                keys[-1] = keys[-1] << np.uint64(bits) | self.ahead(step)
            else:
                keys.append(self.ahead(step))
        return keys

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        """All rows in the order of ``depth`` symbols, and the symbols that each has in common with the one before.

        Rows with ``depth`` symbols in common are not told apart.
        """
        keys = self._keys()
        made = [self.transform(i, keys) for i in range(len(self.edges) - 1)]
        rows, before = (np.concatenate(column) for column in zip(*made))
        interleave = np.repeat(np.arange(len(made)), np.diff(self.edges)).astype(np.uint8 if len(made) <= 256 else np.uint16)
        block = np.zeros(len(rows), np.int32)
        common = np.full(len(rows), self.depth, np.int32)
        common[:1] = 0
        for done in range(self.depth):
            symbols = np.empty(len(rows), np.uint32)
            symbols[np.argsort(interleave, kind="stable")] = before
            order = _stable(symbols)
            interleave, symbols, tails = interleave[order], symbols[order], block[order]
            parted = (symbols[1:] != symbols[:-1]) | (tails[1:] != tails[:-1]) & (symbols[1:] > 0)
            block = np.concatenate([[0], np.cumsum(parted, dtype=np.int32)])
            new = np.flatnonzero(parted) + 1
            common[new] = np.minimum(common[new], done)
        merged = np.empty(len(rows), np.int64)
        merged[np.argsort(interleave, kind="stable")] = rows
        return merged, common


def _width(size: int) -> int:
    return max(w for w in range(1, min(SYMBOL, size) + 1) if size % w == 0)


_VERDICT = "k1 long, k2 long, a long, b long, first_doc long, first_start long"


def _verdicts(size: int):
    """For each fragment the windows a..b that repeat and have their earliest places in a row from (first_doc, first_start)."""
    width = _width(size)

    def verdicts(table: pa.Table) -> pa.Table:
        own_doc, own_start, n, k1, k2 = (
            table.column(c).to_numpy() for c in ("first_doc", "first_start", "n", "k1", "k2")
        )
        shards = Shards(table.column("content").to_pylist(), width, size // width)
        rows, common = shards.merge()
        interval = np.cumsum(common < shards.depth)
        window = shards.left[rows] >= size
        rows, interval = rows[window], interval[window]
        # Most windows are alone in their interval; they repeat only if their fragment does.
        heads = np.flatnonzero(np.concatenate([[True], interval[1:] != interval[:-1]]))
        sizes = np.diff(np.append(heads, len(rows)))
        several = np.repeat(sizes > 1, sizes) | (n > 1)[shards.string[rows]]
        rows, interval = rows[several], interval[several]
        heads = np.flatnonzero(np.concatenate([[True], interval[1:] != interval[:-1]])[: len(rows)])
        string, place = shards.string[rows], shards.place[rows]
        of = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(rows))))
        docs, starts = own_doc[string], own_start[string] + place
        first_doc = np.minimum.reduceat(docs, heads)[of]
        first_start = np.minimum.reduceat(np.where(docs == first_doc, starts, np.iinfo(np.int64).max), heads)[of]
        again = np.add.reduceat(n[string], heads)[of] > 1
        # The only occurrence of a fragment that is the earliest of a window keeps it.
        again &= (n[string] > 1) | (docs != first_doc) | (starts != first_start)
        rows, first_doc, first_start = rows[again], first_doc[again], first_start[again]
        # Places of two strings are never next to each other, as the end of the first is between them.
        at = shards.base[shards.string[rows]] + shards.place[rows]
        order = _order(at.view(np.uint64))
        rows, at, first_doc, first_start = rows[order], at[order], first_doc[order], first_start[order]
        goes_on = (np.diff(at) == 1) & (np.diff(first_doc) == 0) & (np.diff(first_start) == 1)
        first = np.flatnonzero(np.concatenate([[True], ~goes_on])) if len(rows) else np.empty(0, np.int64)
        last = np.append(first[1:], len(rows)) - 1 if len(rows) else first
        string = shards.string[rows[first]]
        return pa.table(
            {
                "k1": k1[string],
                "k2": k2[string],
                "a": shards.place[rows[first]],
                "b": shards.place[rows[last]],
                "first_doc": first_doc[first],
                "first_start": first_start[first],
            }
        )

    return verdicts


#: First document and first start as one number, so that its minimum is found before a shuffle.
_ONE = "cast(first_doc as decimal(38,0)) * 1099511627776 + first_start"


def _both(one: str) -> list:
    rest = f"pmod({one}, cast(1099511627776 as decimal(38,0)))"
    return [
        F.expr(f"({one} - {rest}) div cast(1099511627776 as decimal(38,0))").cast("long").alias("first_doc"),
        F.expr(rest).cast("long").alias("first_start"),
    ]


def _judge(fragments: DataFrame, key, size: int) -> DataFrame:
    """The verdicts on written fragments, dealt over buckets by ``key``."""
    total = fragments.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    bucket = F.pmod(key, F.lit(max(1, -(-total // BUCKET))))
    dealt = fragments.select("k1", "k2", "content", "first_doc", "first_start", "n", bucket.alias("bucket"))
    return dealt.groupBy("bucket").applyInArrow(_verdicts(size), _VERDICT)


def _find(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, mark and spans (first byte, byte after the last) of the windows to remove, for rows that have any."""
    spark = docs.sparkSession
    held, bits = _bitmap(docs, size)
    bitmap = spark.sparkContext.broadcast(held)
    # Fragments of one text overlap, which a stronger compression finds.
    cut = settle(docs.mapInArrow(_cut(size, bitmap, bits), _FRAGMENTS), "fragments", "zstd")
    distinct = (
        cut.where("content is not null")
        .select("k1", "k2", "anchor", "content", F.expr(_ONE).alias("one"), "n")
        .groupBy("k1", "k2", "anchor", "content")
        .agg(F.min("one").alias("one"), F.sum("n").alias("n"))
        .select("k1", "k2", "anchor", "content", *_both("one"), "n")
    )
    distinct = settle(distinct, "distinct", "zstd")
    hot = distinct.groupBy("anchor").agg(F.sum(F.octet_length("content")).alias("bytes")).where(F.col("bytes") > HOT)
    hot = settle(hot.select("anchor"), "hot-anchors")
    verdicts = _judge(distinct.join(hot, "anchor", "left_anti"), F.col("anchor"), size)
    used = []
    if not hot.isEmpty():
        windows = distinct.join(hot, "anchor", "left_semi").select(
            "k1", "k2", "n", "first_doc", "first_start", "content",
            F.explode(F.sequence(F.lit(0), F.octet_length("content") - size)).alias("at"),
        )
        window = F.expr(f"substring(content, at + 1, {size})")
        windows = settle(
            windows.select(
                F.col("k1").alias("f1"), F.col("k2").alias("f2"), "at", "n", "first_doc",
                (F.col("first_start") + F.col("at")).alias("first_start"), window.alias("content"),
                F.xxhash64(window).alias("k1"), F.xxhash64(window, F.lit(1)).alias("k2"),
            ),
            "hot-windows",
        )
        single = (
            windows.select("k1", "k2", "content", "n", F.expr(_ONE).alias("one"))
            .groupBy("k1", "k2", "content")
            .agg(F.min("one").alias("one"), F.sum("n").alias("n"))
            .select("k1", "k2", "content", *_both("one"), "n")
        )
        single = settle(single, "single-windows")
        used = [windows, single]
        judged = _judge(single, F.col("k1"), size).select("k1", "k2", "first_doc", "first_start")
        # The earliest place is that of the window, whichever fragment has it.
        back = windows.select("f1", "f2", F.col("at").cast("long").alias("a"), "k1", "k2").join(judged, ["k1", "k2"])
        verdicts = verdicts.unionByName(
            back.select(
                F.col("f1").alias("k1"), F.col("f2").alias("k2"), "a", F.col("a").alias("b"), "first_doc", "first_start"
            )
        )
    verdicts = settle(verdicts, "verdicts")
    total = distinct.agg(F.sum("n")).first()[0] or 0
    # Fragments that are common are few, so what holds for them is broadcast.
    common = settle(distinct.where(F.col("n") * HOT_PART > total).select("k1", "k2"), "common")
    discard(distinct, hot, *used)

    at = cut.where("starts is not null").select(
        "doc_id", "mark", F.explode(F.arrays_zip("starts", "k1s", "k2s")).alias("f")
    )
    at = at.select("doc_id", "mark", F.col("f.starts").alias("start"), F.col("f.k1s").alias("k1"), F.col("f.k2s").alias("k2"))
    of_common = F.broadcast(verdicts.join(F.broadcast(common), ["k1", "k2"]))
    rare = verdicts.join(F.broadcast(common), ["k1", "k2"], "left_anti")
    met = at.join(of_common, ["k1", "k2"]).unionByName(
        at.join(F.broadcast(common), ["k1", "k2"], "left_anti").join(rare, ["k1", "k2"])
    )
    earlier = (F.col("first_doc") < F.col("doc_id")) | (
        (F.col("first_doc") == F.col("doc_id")) & (F.col("first_start") < F.col("start") + F.col("a"))
    )
    span = F.struct((F.col("start") + F.col("a")).alias("low"), (F.col("start") + F.col("b") + size).alias("high"))
    spans = met.where(earlier).groupBy("doc_id", "mark").agg(F.collect_set(span).alias("spans"))
    spans = settle(spans, "spans")
    discard(cut, verdicts, common)
    return spans


def _remove(columns: list[str]):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(batch.schema.get_field_index("text")))
            found = batch.column(batch.schema.get_field_index("__spans"))
            kept, sizes, removed, spans = [], [], [], []
            for text, marks in zip(texts, found):
                data = np.frombuffer(text or b"", np.uint8)
                sizes.append(len(data))
                if marks.values is None or not len(marks.values):
                    kept.append(text)
                    removed.append(0)
                    spans.append(0)
                    continue
                edges = np.zeros(len(data) + 1, np.int64)
                np.add.at(edges, marks.values.field("low").to_numpy(), 1)
                np.add.at(edges, marks.values.field("high").to_numpy(), -1)
                gone = np.cumsum(edges[:-1]) > 0
                kept.append(data[~gone].tobytes())
                removed.append(int(gone.sum()))
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            made = {
                "kept": pa.array(kept, pa.binary()),
                "n_bytes": pa.array(sizes, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans, pa.int64()),
            }
            yield with_columns(batch, made, ["__spans"]).select(columns)

    return remove


def remove_repeated_bytes(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``docs`` with kept, the bytes of ``text`` that are left, n_bytes, n_removed and n_spans (removed stretches).

    A byte goes if a string of ``size`` bytes over it also starts earlier: in a document with a
    smaller doc_id, or earlier in the same one. Strings are those of the input, and lie in one
    row. What is kept may begin or end inside a character, so it is binary. A null text has no
    bytes and keeps null. A null doc_id is before or after nothing: such rows stay whole and remove
    nothing. Rows that repeat a doc_id are one document: the same place in two of them is not
    earlier. All columns are kept, but the new ones replace columns of these names.
    """
    ship_package(docs.sparkSession)
    docs = docs.withColumn("text", F.col("text").cast("string"))
    id_, mark = F.col("doc_id").cast("long"), F.xxhash64("text")
    input_ = docs.select(id_.alias("doc_id"), mark.alias("mark"), "text").where("doc_id is not null and text is not null")
    spans = _find(input_, size).select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), F.col("spans").alias("__spans"))
    added = {"kept": T.BinaryType(), "n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType()}
    schema = schema_with(docs.schema, added)
    joined = docs.join(spans, (id_ == F.col("__id")) & (mark == F.col("__mark")), "left").drop("__id", "__mark")
    return joined.mapInArrow(_remove(schema.names), schema)


def digest(cleaned: DataFrame) -> DataFrame:
    """doc_id, the three counts and the hash of the bytes that are left."""
    return cleaned.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.coalesce("kept", F.lit(b"")), 256).alias("kept_sha256")
    )
