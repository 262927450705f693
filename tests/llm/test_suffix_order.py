"""The orders in a bucket of fragments."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tidefetch.llm import suffixes


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000])
@pytest.mark.parametrize("top", [1, 3, 1 << 42, (1 << 64) - 1])
def test_order_is_stable_for_values_of_any_size(n, top):
    values = np.random.default_rng(n).integers(0, top, n, np.uint64, endpoint=True)
    values[n // 2 :] = values[: n - n // 2]
    assert suffixes._order(values).tolist() == np.argsort(values, kind="stable").tolist()


@pytest.mark.parametrize("hashed", [lambda h: h, lambda h: h & np.uint64(63), lambda h: h & np.uint64(0)])
@pytest.mark.parametrize("width", [1, 5, 8, 10])
def test_equal_symbols_are_equal_blocks_even_if_hashes_meet(monkeypatch, hashed, width):
    grams = suffixes.ngrams
    monkeypatch.setattr(suffixes, "ngrams", lambda values, size: hashed(grams(values, size)))
    draw = random.Random(width)
    strings = [bytes(draw.choice(b"ab\0") for _ in range(draw.randint(20, 60))) for _ in range(40)]
    shards = suffixes.Shards(strings, width, 2, shard_bytes=200)
    found: dict[int, set[bytes]] = {}
    for string, place, left, symbol in zip(shards.string, shards.place, shards.left, shards.symbols):
        assert (symbol == 0) == (left < width)
        if symbol:
            found.setdefault(int(symbol), set()).add(strings[string][place : place + width])
    assert all(len(blocks) == 1 for blocks in found.values())
    assert len(set().union(*found.values())) == len(found)

    rows, common = shards.merge()
    blocks = [strings[s][p : p + 2 * width] for s, p in zip(shards.string[rows], shards.place[rows])]
    for before, block, same in zip(blocks, blocks[1:], common[1:]):
        if len(before) == len(block) == 2 * width:
            assert (before == block) == (same == 2)


def test_one_shard_sorts_numbers_not_places(monkeypatch):
    """What a key and a place fit into is sorted as one number."""
    shards = suffixes.Shards([b"abcdefgh" * 30, b"bcdefgha" * 20], 10, 2)

    def never(keys):
        raise AssertionError("sorted by keys")

    monkeypatch.setattr(np, "lexsort", never)
    rows, _ = shards.merge()
    assert sorted(rows.tolist()) == list(range(len(rows)))


def _verdicts(strings: list[bytes], n: list[int]) -> list[tuple]:
    places = list(range(len(strings)))
    table = pa.table(
        {"k1": places, "k2": places, "content": pa.array(strings, pa.binary()), "first_doc": [7 + i for i in places],
         "first_start": [0] * len(n), "n": n}
    )
    return sorted(zip(*suffixes._verdicts(10)(table).to_pydict().values()))


def test_windows_that_are_alone_have_no_verdict():
    assert _verdicts([b"abcdefghijkl", b"0123456789"], [1, 1]) == []


def test_windows_of_repeated_fragments_and_of_two_fragments_have_verdicts():
    assert _verdicts([b"abcdefghijkl"], [2]) == [(0, 0, 0, 2, 7, 0)]
    assert _verdicts([b"abcdefghijkl", b"-bcdefghijkl"], [1, 1]) == [(1, 1, 1, 2, 7, 1)]
    assert _verdicts([b"0123456789", b"abcdefghijkl", b"-bcdefghijkl"], [3, 1, 1]) == [(0, 0, 0, 0, 7, 0), (2, 2, 1, 2, 8, 1)]
