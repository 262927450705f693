"""Near-duplicates by improved consistent weighted sampling of TF-IDF shingles.

A text is the weighted set of its five-word shingles: how often one occurs, times the mean
idf of its words. Each of ``BANDS * ROWS`` samples picks a shingle with a probability in
proportion to its weight, and two texts pick the same one with the probability of their
weighted Jaccard similarity. Texts that agree on all samples of a band are candidates, and
candidates are verified by the similarity itself. At 0.8 a pair misses all bands with a
probability of 0.0002.

Groups of any size: equal texts are one node. The members of a bucket are first compared with
representatives only, and buckets that still hold more than one class get others, as long as most
pairs are alike. All texts of the buckets that are then still open are joined exactly: each pair of
two classes that can reach the similarity by its rarest shingles is tested. Nothing is capped or
dropped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefetch.llm.common import (
    among,
    lists,
    mix,
    narrow_batches,
    ngrams,
    plain_words,
    releasing,
    settle,
    ship_package,
    utf8,
    word_hashes,
)
from tidefetch.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 16
ROWS = 4
#: Words that more than this share of documents have get idfs of their own; rarer ones share the largest.
RARE = 0.001
#: Bound of the idf table that is broadcast; RARE rises where it would be exceeded.
MOST_WORDS = 100_000
#: Distinct words that a task counts at once, and words that it holds before it counts them.
COUNTED = 1_000_000
UNCOUNTED = 1 << 18
#: Members that are compared with one copy of a representative's text.
CHUNK = 128
#: Representatives of an open bucket in every round but the first.
DRAWN = 8
#: Texts of a block, whose candidate pairs with another block are tested together.
BLOCK = 64
#: Cells in which the shingles of open texts are counted: 16 MB that are broadcast.
CELLS = 1 << 22
#: Cells whose counts the driver gets as one compressed value.
RUN = 1 << 13
#: Rows, of 64 bits each, that the broadcast bitmap of members has at most: some 160 MB.
BITMAP_ROWS = 1 << 22

_CELLS = 14


class Sampler:
    """The random variates of the sampling, from fixed tables, so that all tasks draw the same."""

    def __init__(self, samples: int, seed: int = 8):
        draw = np.random.default_rng(seed)
        n = 1 << _CELLS
        r, log_c, beta = draw.gamma(2.0, 1.0, n), np.log(draw.gamma(2.0, 1.0, n)), draw.random(n)
        # The cost of a shingle is log_c - r * (t + 1 - beta) for t = floor(log(weight) / r + beta).
        self.r, self.beta = r.astype(np.float32), beta.astype(np.float32)
        self.rest = (log_c + r * (beta - 1)).astype(np.float32)
        self.factors = draw.integers(1 << 62, 1 << 63, samples, np.uint64) * np.uint64(2) + np.uint64(1)

    def draw(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """A 64-bit value for each sample: the shingle picked, and the step of its weight."""
        logs = np.log(weights).astype(np.float32)
        out = np.empty(len(self.factors), np.uint64)
        step = max(1, 40_000 // len(shingles))
        for at in range(0, len(out), step):
            cell = ((shingles * self.factors[at : at + step, None]) >> np.uint64(64 - _CELLS)).view(np.int64)
            r = self.r.take(cell)
            t = np.floor(logs / r + self.beta.take(cell))
            cost = self.rest.take(cell) - r * t
            best = cost.argmin(1)
            steps = t[np.arange(len(best)), best].astype(np.int64).view(np.uint64)
            out[at : at + step] = mix(shingles[best] + steps * np.uint64(0x9E3779B97F4A7C15))
        return out


class Weights:
    """idfs of the common words by their hash. It is broadcast."""

    def __init__(self, words: np.ndarray, idfs: np.ndarray, largest: float):
        order = np.argsort(words)
        self.words = words[order]
        self.idfs = idfs[order] if len(words) else np.array([largest])
        self.largest = largest

    def shingles(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """The distinct shingles of a text, in order, and their weights.

        A text of fewer words than a shingle has one, of all its words; one without words none.
        """
        words = plain_words(text) if text else []
        hashes = word_hashes.of(words)
        size = min(SHINGLE, len(words))
        if not size:
            return hashes, np.empty(0)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.idfs) - 1)
        idf = np.where(among(hashes, self.words), self.idfs[at], self.largest)
        sums = np.concatenate([[0.0], np.cumsum(idf)])
        means = (sums[size:] - sums[:-size]) / size
        found, first, times = np.unique(ngrams(hashes, size), return_index=True, return_counts=True)
        # Rounded: the running sum must not make one shingle's weight differ between texts.
        return found, times * np.round(means[first], 4)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][i], b[1][j]).sum()
    total = a[1].sum() + b[1].sum() - common
    return float(common / total) if total else 0.0


def _added(words: np.ndarray, times: np.ndarray, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words, in order, with those of ``parts`` counted too."""
    new, more = np.unique(np.concatenate(parts), return_counts=True)
    known = among(new, words)
    times[np.searchsorted(words, new[known])] += more[known]
    at = np.searchsorted(words, new[~known])
    return np.insert(words, at, new[~known]), np.insert(times, at, more[~known])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents each word is. A task has a row for each word, more only beyond ``COUNTED`` words."""

    def counted(words: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(words), UNCOUNTED):
            found = [pa.array(words[at : at + UNCOUNTED].view(np.int64)), pa.array(times[at : at + UNCOUNTED])]
            yield pa.RecordBatch.from_arrays(found, ["word", "n"])

    words, times = none = np.empty(0, np.uint64), np.empty(0, np.int64)
    parts, held = [], 0
    for (texts,) in narrow_batches(batches, ("text",)):
        for text in utf8(texts):
            parts.append(word_hashes.of(list(set(plain_words(text) if text else ()))))
            held += len(parts[-1])
            if held > UNCOUNTED:
                words, times = _added(words, times, parts)
                parts, held = [], 0
                if len(words) > COUNTED:
                    yield from counted(words, times)
                    words, times = none
    if parts:
        words, times = _added(words, times, parts)
    yield from counted(words, times)


def _sketch(shared, sampler: Sampler, bands: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        salt = mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
        for ids, nodes, texts in narrow_batches(batches, ("doc_id", "node", "text")):
            keys, counts, totals = [], [], []
            for text in utf8(texts):
                shingles, weight = weights.shingles(text)
                counts.append(len(shingles))
                totals.append(float(weight.sum()))
                if not len(shingles):
                    keys.append(np.empty(0, np.int64))
                    continue
                drawn = sampler.draw(shingles, weight).reshape(bands, -1)
                band = salt
                for row in range(drawn.shape[1]):
                    band = mix(band * np.uint64(3) + drawn[:, row])
                keys.append(band.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [ids, nodes, pa.array(counts, pa.int64()), pa.array(totals, pa.float64()), lists(keys, pa.int64())],
                ["doc_id", "node", "n_shingles", "total", "bands"],
            )

    return sketch


def _verify(shared, least: float):
    """Rows in order of a representative's chunks; its own text comes first in each."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, current, own = shared.value, None, None
        for reps, chunks, nodes, texts in narrow_batches(batches, ("rep", "chunk", "node", "text")):
            a, b = [], []
            for rep, chunk, node, text in zip(reps.to_pylist(), chunks.to_pylist(), nodes.to_pylist(), utf8(texts)):
                if (rep, chunk) != current:
                    current, own = (rep, chunk), weights.shingles(text)
                elif weighted_jaccard(own, weights.shingles(text)) >= least:
                    a.append(rep)
                    b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return verify


def _count_cells(shared):
    """How many texts have a shingle in each cell, for cells with any; counted by task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.int64)
        for (texts,) in narrow_batches(batches, ("text",)):
            for text in utf8(texts):
                np.add.at(counts, _cell(shared.value.shingles(text)[0]), 1)
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(counts[cells])], ["cell", "n"])

    return count


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles % np.uint64(CELLS)).astype(np.int64)


def _packed(cells: pa.Table) -> pa.Table:
    """The counts of one run of cells, 1 where there is no row, as compressed 32-bit numbers."""
    at, n = cells.column("cell").to_numpy(), cells.column("n").to_numpy()
    counts = np.ones(RUN, np.uint32)
    counts[at % RUN] = np.minimum(n, (1 << 32) - 1)
    return pa.table({"run": at[:1] // RUN, "counts": [zlib.compress(counts.tobytes(), 1)]})


def _cell_counts(texts: DataFrame, shared) -> np.ndarray:
    """In how many of the ``texts`` each cell is, 1 for those in one or none.

    All cells are 16 MB, and as rows four times that; what is sent to the driver is packed before.
    """
    cells = texts.mapInArrow(releasing(_count_cells(shared)), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    runs = cells.where("n > 1").groupBy(F.floor(F.col("cell") / RUN)).applyInArrow(_packed, "run long, counts binary").toArrow()
    counts = np.ones(CELLS, np.uint32)
    for run, packed in zip(runs.column("run").to_pylist(), runs.column("counts").to_pylist()):
        counts[run * RUN : (run + 1) * RUN] = np.frombuffer(zlib.decompress(packed), np.uint32)
    return counts


def _prefixes(shared, counted, least: float):
    """The rarest shingles of each text, of which a partner at ``least`` must have one.

    All texts have the same order, by count of the cell and hash. What two texts share weighs at
    most ``rest``, the weight from their first common shingle on. A shingle whose cell is one
    text's alone has no partner.
    """

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, counts = shared.value, counted.value
        for nodes, texts in narrow_batches(batches, ("node", "text")):
            whose, found, rests = [], [], []
            for i, text in enumerate(utf8(texts)):
                shingles, weight = weights.shingles(text)
                times = counts[_cell(shingles)]
                order = np.lexsort((shingles, times))
                rest = np.cumsum(weight[order][::-1])[::-1]
                kept = (rest >= (least - 1e-9) * weight.sum()) & (times[order] > 1)
                found.append(shingles[order][kept])
                rests.append(rest[kept])
                whose.append(np.full(len(found[-1]), i))
            yield pa.RecordBatch.from_arrays(
                [
                    nodes.take(pa.array(np.concatenate(whose), pa.int64())),
                    pa.array(np.concatenate(found).view(np.int64)),
                    pa.array(np.concatenate(rests), pa.float64()),
                ],
                ["node", "shingle", "rest"],
            )

    return prefixes


def _verify_blocks(shared, least: float):
    """Rows in order of pairs of blocks; the texts come first in each, then the pairs of nodes."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, current, own = shared.value, None, {}
        for xs, ys, nodes, others, texts in narrow_batches(batches, ("x", "y", "node", "other", "text")):
            a, b = [], []
            rows = zip(xs.to_pylist(), ys.to_pylist(), nodes.to_pylist(), others.to_pylist(), utf8(texts))
            for x, y, node, other, text in rows:
                if (x, y) != current:
                    current, own = (x, y), {}
                if other is None:
                    own[node] = weights.shingles(text)
                elif weighted_jaccard(own[node], own[other]) >= least:
                    a.append(node)
                    b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return verify


def _idfs(docs: DataFrame) -> Weights:
    counts = settle(
        docs.select("text").mapInArrow(releasing(_count_words), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")),
        "words",
    )
    n_docs = max(1, docs.where("text is not null").count())
    total = counts.agg(F.sum("n")).first()[0] or 0
    # Words in more than a share s of the documents: at most total / (s * documents).
    share = max(RARE, total / n_docs / MOST_WORDS)
    # As Arrow, so that the driver holds two numbers for each word and no row objects.
    common = counts.where(F.col("n") > share * n_docs).toArrow()
    words, n = common.column("word").to_numpy(), common.column("n").to_numpy()
    return Weights(words.view(np.uint64), 1.0 + np.log(n_docs / n), 1.0 + float(np.log(1 / share)) if share < 1 else 1.0)


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, class_size, n_shingles, kept: the class of near-duplicates of each row of ``docs``.

    Words are lower-cased (A-Z only) runs of ASCII letters, digits and characters beyond ASCII.
    class_id is the least doc_id of the class, and kept is true for that document only. Rows that
    repeat a doc_id and text are one document and get the same result; class_size counts rows.
    A text that is null or has no word is in no class with others. A null doc_id is larger than
    all others; a class of nothing else has a null class_id and keeps these rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    docs = docs.withColumn("node", F.unhex(F.md5(F.col("text").cast("binary"))))
    shared = spark.sparkContext.broadcast(_idfs(docs))
    read = settle(
        docs.mapInArrow(
            releasing(_sketch(shared, Sampler(BANDS * ROWS), BANDS)), "doc_id long, node binary, n_shingles long, total double, bands array<long>"
        ),
        "sketches",
    )
    buckets = (
        read.where("n_shingles > 0")
        .groupBy("node")
        .agg(F.first("bands").alias("bands"), F.first("total").alias("total"))
        .select("node", "total", F.explode("bands").alias("bucket"))
    )
    several = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = settle(buckets.join(several, "bucket"), "members")
    # A text from which many were copied with changes meets more of them than they meet each other.
    central = members.groupBy("node").agg((-F.sum("n")).alias("central"))
    members = settle(members.select("bucket", "node", "total").join(central, "node"), "members")
    nodes = members.select("node").distinct()
    texts = settle(
        _likely(docs, nodes).join(nodes, "node", "left_semi").dropDuplicates(["node"]).select("node", "text"), "texts"
    )
    roots = _classes(members, texts, shared, similarity)
    shared.destroy()  # all that used it is written

    nodes = read.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    alone = F.coalesce(F.col("n_shingles") == 0, F.lit(True))
    sizes = nodes.where(~alone).groupBy("root").agg(F.min("doc_id").alias("least"), F.count("*").alias("size"))
    # The representative is one node: the least of those that hold the least doc_id.
    holder = (
        nodes.where(~alone)
        .join(sizes, "root")
        .where(F.col("doc_id").eqNullSafe(F.col("least")))
        .groupBy("root")
        .agg(F.min("node").alias("holder"))
    )
    classes = sizes.join(holder, "root").withColumnRenamed("root", "class_root")
    return nodes.join(classes, (nodes["root"] == classes["class_root"]) & ~alone, "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("least")).alias("class_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("class_size"),
        "n_shingles",
        (alone | (F.col("doc_id").eqNullSafe(F.col("least")) & (F.col("node") == F.col("holder")))).alias("kept"),
        "node",
    )


def _likely(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose node may be among ``nodes``: all that are, and few others.

    A bitmap with one bit for each hash spares most other texts the shuffle. It has at most
    ``BITMAP_ROWS`` rows; where it is full, more rows pass, and an exact join follows in any case.
    """
    hashed = F.xxhash64("node")
    row = F.pmod(F.shiftright(hashed, 6), F.lit(BITMAP_ROWS)).alias("row")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), hashed.bitwiseAND(F.lit(63)).cast("int")).alias("bit")
    bitmap = nodes.select(row, bit).groupBy("row").agg(F.bit_or("bit").alias("bits"))
    marked = docs.select("*", row, bit)
    met = (marked["row"] == bitmap["row"]) & (F.col("bits").bitwiseAND(F.col("bit")) != 0)
    return marked.join(F.broadcast(bitmap), met, "left_semi").drop("row", "bit")


def _classes(members: DataFrame, texts: DataFrame, shared, similarity: float) -> DataFrame:
    """node, root for the nodes that have links.

    In the first round the most central node represents a bucket, so that most copies meet the
    text they were made from. In later ones every open bucket draws up to ``DRAWN`` of its own.
    Only open buckets, those of several classes, are carried on. Rounds only save tests: they end
    when most pairs of one are not alike, and what is then open is joined exactly.
    """
    tested, turn = None, 0
    roots = members.select("node", F.col("node").alias("root")).limit(0)
    while True:
        if turn:
            labelled = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        else:
            labelled = members.withColumn("root", F.col("node"))
        if turn:
            rank, slot = F.xxhash64("node", "bucket", F.lit(turn)), F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(DRAWN))
        else:
            rank, slot = F.col("central"), F.lit(0)
        # Grouped by slot first, so that the list of a bucket has at most DRAWN entries.
        open_ = (
            labelled.groupBy("bucket", slot.alias("slot"))
            .agg(
                F.min(F.struct(rank.alias("rank"), "node", "root", "total")).alias("r"),
                F.min("root").alias("x"),
                F.max("root").alias("y"),
            )
            .groupBy("bucket")
            .agg(F.collect_list("r").alias("reps"), F.min("x").alias("x"), F.max("y").alias("y"))
            .where("x != y")
            .select("bucket", "reps")
        )
        members = settle(labelled.join(open_, "bucket"), "members")
        # The similarity is at most the lighter text's weight over the heavier one's. Two
        # representatives of a bucket are compared once.
        alike = F.least("total", "r.total") >= (similarity - 1e-9) * F.greatest("total", "r.total")
        twice = (F.col("node") < F.col("r.node")) & F.array_contains("reps.node", F.col("node"))
        pairs = (
            members.withColumn("r", F.explode("reps"))
            .where(alike & ~twice & (F.col("root") != F.col("r.root")))
            .select(F.col("r.node").alias("rep"), "node")
            .distinct()
        )
        members = members.select("bucket", "node", "total", "central")
        if tested is not None:
            pairs = pairs.join(tested, ["rep", "node"], "left_anti").join(
                tested.select(F.col("node").alias("rep"), F.col("rep").alias("node")), ["rep", "node"], "left_anti"
            )
        pairs = settle(pairs, "pairs")
        n_pairs = pairs.count()
        if not n_pairs:
            break
        links = settle(_verified(pairs, texts, shared, similarity), "links")
        n_links = links.count()
        if not n_links:
            break
        tested = pairs if tested is None else tested.unionByName(pairs)
        roots = settle(_merge(roots, links), "roots")
        turn += 1
        if 2 * n_links < n_pairs:
            break
    return _finished(members, roots, texts, shared, similarity)


def _finished(members: DataFrame, roots: DataFrame, texts: DataFrame, shared, similarity: float) -> DataFrame:
    """``roots`` with the links of all pairs of two classes among the ``members`` of open buckets.

    A prefix join: two texts at the similarity have a common shingle among the rarest of both, and
    from the first such on enough weight. One pass is exact, since all pairs of two classes take part.
    """
    spark = members.sparkSession
    labelled = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = labelled.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x != y")
    nodes = (
        labelled.join(open_, "bucket", "left_semi")
        .groupBy("node")
        .agg(F.first("root").alias("root"), F.first("total").alias("total"), F.min("bucket").alias("home"))
    )
    # Texts of one bucket are likely to be candidates of each other, so they make blocks together.
    homes = nodes.groupBy("home").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    block = F.xxhash64("home", F.pmod(F.xxhash64("node"), "blocks"))
    nodes = settle(nodes.join(homes, "home").select("node", "root", "total", block.alias("block")), "open-nodes")
    if nodes.isEmpty():
        return roots
    texts = settle(texts.join(nodes.select("node"), "node"), "open-texts")
    counted = spark.sparkContext.broadcast(_cell_counts(texts, shared))
    prefixes = texts.mapInArrow(releasing(_prefixes(shared, counted, similarity)), "node binary, shingle long, rest double")
    prefixes = settle(prefixes.join(nodes, "node"), "prefixes")
    counted.destroy()

    # Members of the class that most texts of a shingle are in do not meet each other.
    of_root = prefixes.groupBy("shingle", "root").agg(F.count("*").alias("n"))
    several = of_root.groupBy("shingle").agg(F.max_by("root", "n").alias("major"), F.count("*").alias("n")).where("n > 1")
    rows = settle(prefixes.join(several.drop("n"), "shingle"), "prefixes")
    # The lighter text of a pair has the common shingle in a shorter prefix.
    lighter = F.col("rest") >= (2 * similarity / (1 + similarity) - 1e-9) * F.col("total")
    light, small = rows.where(lighter), F.col("root") != F.col("major")

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        a, b = a.alias("a"), b.alias("b")
        lighter = (F.col("a.total") < F.col("b.total")) | (
            (F.col("a.total") == F.col("b.total")) & (F.col("a.node") < F.col("b.node"))
        )
        alike = F.col("a.total") >= (similarity - 1e-9) * F.col("b.total")
        enough = F.least("a.rest", "b.rest") >= (similarity / (1 + similarity) - 1e-9) * (F.col("a.total") + F.col("b.total"))
        two = (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.root") != F.col("b.root"))
        return a.join(b, two & lighter & alike & enough).select(
            F.col("a.node").alias("node"),
            F.col("b.node").alias("other"),
            F.least("a.block", "b.block").alias("x"),
            F.greatest("a.block", "b.block").alias("y"),
        )

    pairs = met(light.where(small), rows).unionByName(met(light.where(~small), rows.where(small))).distinct()
    pairs = settle(pairs, "open-pairs")
    ends = pairs.select("x", "y", "node").unionByName(pairs.select("x", "y", F.col("other").alias("node"))).distinct()
    ends = ends.join(texts, "node").withColumn("other", F.lit(None).cast("binary"))
    links = (
        ends.unionByName(pairs.withColumn("text", F.lit(None).cast("string")))
        .repartition("x", "y")
        .sortWithinPartitions("x", "y", F.col("other").asc_nulls_first())
        .mapInArrow(releasing(_verify_blocks(shared, similarity)), "a binary, b binary")
    )
    links = settle(links, "links")
    return roots if links.isEmpty() else _merge(roots, links)


def _merge(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The roots of all nodes so far when ``links`` are added: only classes that they join are looked at."""
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    nodes = roots.unionByName(ends.join(roots, "node", "left_anti").withColumn("root", F.col("node")))
    nodes = settle(nodes, "nodes")
    between = links.join(nodes.select(F.col("node").alias("a"), F.col("root").alias("x")), "a").join(
        nodes.select(F.col("node").alias("b"), F.col("root").alias("y")), "b"
    )
    joined = components(between.select(F.col("x").alias("a"), F.col("y").alias("b")))
    joined = joined.select(F.col("node").alias("root"), F.col("root").alias("new"))
    return nodes.join(joined, "root", "left").select("node", F.coalesce("new", "root").alias("root"))


def _verified(pairs: DataFrame, texts: DataFrame, shared, similarity: float) -> DataFrame:
    chunks = pairs.groupBy("rep").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    pairs = pairs.join(chunks, "rep").select(
        "rep", F.pmod(F.xxhash64("node"), "chunks").cast("int").alias("chunk"), "node"
    )
    heads = pairs.select("rep", "chunk").distinct().withColumn("node", F.col("rep"))
    rows = heads.withColumn("kind", F.lit(0)).unionByName(pairs.withColumn("kind", F.lit(1)))
    rows = rows.join(texts, "node")
    return (
        rows.repartition("rep", "chunk")
        .sortWithinPartitions("rep", "chunk", "kind")
        .mapInArrow(releasing(_verify(shared, similarity)), "a binary, b binary")
    )


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class, the one with the least doc_id; columns as they are.

    Rows that repeat a doc_id and text are one document, so they stay or go together.
    """
    gone = near_duplicates(docs, similarity).where(~F.col("kept")).select(F.col("doc_id").alias("__id"), "node").distinct()
    text = F.unhex(F.md5(F.col("text").cast("string").cast("binary")))
    return docs.join(
        gone, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (text == F.col("node")), "left_anti"
    )
