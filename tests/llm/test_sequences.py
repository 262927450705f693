"""Periodic runs, suffix dedup and whitening against brute force, and on awkward tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tests.llm.conftest import prose
from tidefetch.llm import periods, suffixes, whitening


def runs_of(words, least):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b, q) for (a, b), q in found.items() if b - a >= least), key=lambda r: (r[0], r[2]))


def repetitive(draw: random.Random) -> list[int]:
    letters, n = draw.choice([1, 2, 3, 8]), draw.randint(0, 200)
    kind = draw.randrange(4)
    if kind == 0:
        return [draw.randrange(letters) for _ in range(n)]
    if kind == 1:
        return ([draw.randrange(letters) for _ in range(draw.randint(1, 60))] * 8)[:n]
    if kind == 2:  # highly periodic regions that touch
        out = []
        while len(out) < n:
            out += [draw.randrange(3) for _ in range(draw.randint(1, 3))] * draw.randint(1, 25)
        return out[:n]
    word = ([draw.randrange(2) for _ in range(3)] * 40)[: draw.randint(3, 80)]
    return word + word * draw.randint(1, 2)


@pytest.mark.parametrize("least", [1, 12])
def test_runs_equal_brute_force(least):
    draw = random.Random(least)
    for _ in range(150):
        docs = [repetitive(draw) for _ in range(draw.randint(0, 4))]
        wanted, at = [], 0
        for words in docs:
            wanted += [(a + at, b + at, q) for a, b, q in runs_of(words, least)]
            at += len(words)
        flat = np.asarray([w for words in docs for w in words], np.int64)
        found = periods.find_runs(flat, np.asarray([len(d) for d in docs], np.int64), least)
        assert sorted(map(tuple, found.tolist())) == sorted(wanted)


def test_fibonacci_words_have_many_runs():
    a, b = [0], [0, 1]
    for _ in range(11):
        a, b = b, b + a
    found = periods.find_runs(np.asarray(b), np.asarray([len(b)]), 1)
    assert list(map(tuple, found.tolist())) == runs_of(b, 1)


def test_collapsed_texts_equal_brute_force(spark, awkward):
    extra = [
        (20, " ".join(["la"] * 500), "a", 1, "x"),
        (21, " ".join((prose(9, 37) + " ").split() * 5), "a", 1, "x"),
        (22, "x " * 11, "a", 1, "x"),
        (23, prose(10, 3) + " y" * 12 + "\t\n" + prose(11, 4), "a", 1, "x"),
    ]
    docs = awkward.unionByName(spark.createDataFrame(extra, awkward.schema))
    wanted = []
    for r in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        runs = [] if len(words) > 5000 else runs_of(words, 12)
        if len(words) > 5000:
            continue
        gone = {i for a, b, q in runs for i in range(a + q, b)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs)
        best = min(((a - b, a, q) for a, b, q in runs), default=None)
        longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        wanted.append((r.doc_id or -1, len(runs), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    made = periods.collapse_runs(docs)
    assert set(awkward.columns) < set(made.columns)
    got = [(r[0] or -1, *r[1:]) for r in periods.digest(made).collect() if r.doc_id != 6]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert periods.collapse_runs(docs.limit(0)).count() == 0


def test_planted_runs_follow_the_rule(spark, awkward):
    rows = [(i, prose(i, 40 + i), "a", 1, "x") for i in range(60)]
    docs = awkward.unionByName(spark.createDataFrame(rows, awkward.schema))
    planted = 0
    texts = {(r.doc_id, r.text) for r in periods.with_planted_runs(docs).collect()}
    for r in docs.collect():
        words = (r.text or "").split()
        h = zlib.crc32(str(r.doc_id).encode())
        g, n = h // 10, len(words)
        text = r.text
        if r.doc_id is not None and h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[i if i < a else a + (i - a) % p] for i in range(n))
        assert (r.doc_id, text) in texts
    assert planted > 2


def without_repeats(rows, size):
    """The rows' counts and hashes, every window compared with the earliest of its kind."""
    texts = [(d, None if t is None else t.encode()) for d, t in rows]
    first = {}
    for d, t in texts:
        if d is not None and t is not None:
            for i in range(len(t) - size + 1):
                first[t[i : i + size]] = min(first.get(t[i : i + size], (d, i)), (d, i))
    out = []
    for d, t in texts:
        data = t or b""
        gone = np.zeros(len(data), bool)
        if d is not None:
            for i in range(len(data) - size + 1):
                if first[data[i : i + size]] < (d, i):
                    gone[i : i + size] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((d if d is not None else -99, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def bytes_left(docs, size):
    rows = suffixes.digest(suffixes.remove_repeated_bytes(docs, size)).collect()
    return sorted((-99 if r[0] is None else r[0], *r[1:]) for r in rows)


def passages():
    draw = random.Random(8)

    def text(n, letters="abcdefghijklmno é"):
        return "".join(draw.choice(letters) for _ in range(n))

    common, rows = [text(300) for _ in range(3)], []
    for i in range(50):
        made = text(draw.randint(0, 300))
        if draw.random() < 0.6:
            made += draw.choice(common)[draw.randint(0, 60) : draw.randint(150, 300)] + text(draw.randint(0, 80))
        if draw.random() < 0.2:
            made = "ab" * draw.randint(10, 300)
        if draw.random() < 0.2 and rows:
            made = draw.choice(rows)[1] or ""
        rows.append((draw.choice([i, i, i // 2, -i, None]), made))
    return rows + [(90, None), (91, ""), (92, common[0]), (92, common[0]), (92, common[0] + "x")]


def test_bytes_left_equal_brute_force(spark):
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert bytes_left(docs, 100) == without_repeats(rows, 100)


def test_many_shards_and_split_anchors_change_nothing(spark, monkeypatch):
    # Every bucket has many shards, and most anchors are too common for one.
    monkeypatch.setattr(suffixes, "HOT", 1500)
    monkeypatch.setattr(suffixes, "SHARD", 400)
    monkeypatch.setattr(suffixes, "BUCKET", 4000)
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert bytes_left(docs, 100) == without_repeats(rows, 100)
    draw = random.Random(1)
    short = [(i, "".join(draw.choice("ab") for _ in range(draw.randint(0, 90)))) for i in range(40)]
    assert bytes_left(spark.createDataFrame(short, docs.schema), 14) == without_repeats(short, 14)


def test_merged_rows_are_in_the_order_of_their_suffixes():
    draw = random.Random(2)
    strings = [bytes(draw.choice(b"ab") for _ in range(draw.randint(12, 60))) for _ in range(30)]
    shards = suffixes.Shards(strings, 3, 4, shard_bytes=100)
    assert len(shards.edges) > 5
    rows, common = shards.merge()
    assert sorted(rows.tolist()) == list(range(len(rows)))
    number = {}
    for row in range(len(rows)):
        block = strings[shards.string[row]][shards.place[row] :][:3]
        assert (len(block) < 3) == (shards.symbols[row] == 0)
        if len(block) == 3:
            assert number.setdefault(block, shards.symbols[row]) == shards.symbols[row]
    assert len(set(number.values())) == len(number)
    ahead = np.stack([shards.ahead(k) for k in range(4)], axis=1)[rows].tolist()
    whole = [i for i, s in enumerate(ahead) if 0 not in s]
    windows = {(s, p) for s in range(len(strings)) for p in range(len(strings[s]) - 11)}
    assert windows == {(shards.string[rows[i]], shards.place[rows[i]]) for i in whole}
    assert [ahead[i] for i in whole] == sorted(ahead[i] for i in whole)
    for i, j in zip(whole, whole[1:]):
        shared = min(common[i + 1 : j + 1])
        assert shared == next((k for k in range(4) if ahead[i][k] != ahead[j][k]), 4)


def test_blocks_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(suffixes, "ngrams", lambda values, size: (values[: len(values) - size + 1] & np.uint64(1)))
    strings = [b"abcabcabdabc", b"xbcabdabdabc" + bytes(3)]
    shards = suffixes.Shards(strings, 3, 2)
    blocks = {(strings[s][p : p + 3], n) for s, p, n in zip(shards.string, shards.place, shards.symbols) if n}
    assert len({b for b, _ in blocks}) == len({n for _, n in blocks}) == len(blocks)


def test_repeated_bytes_of_awkward_tables(spark, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    wanted = without_repeats([(d, t) for d, t in rows if d != 6], 100)
    made = suffixes.remove_repeated_bytes(awkward.where("doc_id is null or doc_id <> 6"), 100)
    assert set(awkward.columns) < set(made.columns)
    got = sorted((-99 if r[0] is None else r[0], *r[1:]) for r in suffixes.digest(made).collect())
    assert got == wanted
    assert suffixes.remove_repeated_bytes(awkward.limit(0)).count() == 0
    # A long text of one period keeps the first window of each of its places in the period.
    loop = spark.createDataFrame([(1, "abc" * 200_000)], "doc_id long, text string")
    assert suffixes.remove_repeated_bytes(loop).first().n_removed == 600_000 - 3


def brute_whitening(vectors, weights, components):
    x = np.asarray([[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors], object)
    n, sums = int(sum(weights)), (x * np.asarray(weights, object)[:, None]).sum(0)
    centred = (n * x - sums).astype(float) / n
    values, axes = np.linalg.eigh((centred * np.asarray(weights)[:, None]).T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    white = centred @ (axes[:, :components] / np.sqrt(values[:components]))
    return n, ((n * x - sums) ** 2).sum(1), white, values[:components] / values.sum()


@pytest.mark.parametrize("weights", ["copies", "one"])
def test_whitening_equals_brute_force(spark, weights):
    draw = np.random.default_rng(4)
    distinct = draw.normal(size=(70, 6)) * [5, 4, 3, 2, 1, 0.5]
    vectors = [v for i, v in enumerate(distinct) for _ in range(200 if i == 0 else 1 + i % 3)]  # one is hot
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(0, None), (900, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (901, [float("nan")] * 6), (902, [float("-inf")] * 6), (903, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    keys, first, copies = np.unique(np.floor(64 * np.asarray(vectors)), axis=0, return_index=True, return_counts=True)
    counts = copies if weights == "copies" else np.ones(len(keys), int)
    n, deviation, white, explained = brute_whitening([vectors[i] for i in first], counts, 4)
    got = whitening.whiten(table, components=4, weights=weights).collect()
    assert len(got) == len(vectors) and {r.n for r in got} == {n}
    where = {tuple(k): i for i, k in enumerate(keys)}
    for r in got:
        i = where[tuple(np.floor(64 * vectors[r.vec_id]))]
        assert int(r.deviation) == deviation[i]
        assert np.allclose(np.abs(r.whitened), np.abs(white[i]), atol=1e-8)
        assert np.allclose(r.explained, explained, rtol=1e-9)
        assert r.identity_error < 1e-9


def test_whitening_of_awkward_tables(spark):
    rows = [(1, [1.0, 2.0], 1.0), (1, [1.0, 2.0], 1.0), (None, [3.0, 1.0], 2.0), (8, [1e30, 2.0], 3.0), (9, None, 4.0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened double")
    digest = whitening.digest(whitening.whiten(table)).collect()
    assert sorted((r.vec_id or -1) for r in digest if r.component == 1) == [-1, 1, 1, 8]
    equal = whitening.whiten(table.limit(2)).collect()
    assert [(r.n, r.whitened, r.identity_error) for r in equal] == [(2, [], 0.0)] * 2
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.where("vec_id = 9")).count() == 0
    with pytest.raises(ValueError, match="differ in length"):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>"))
