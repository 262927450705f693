"""Token ids of whole texts with a public tokenizer, for packing and for token files.

The tokenizer drops white space and never joins characters across it, so a text's ids are
those of its white-space parts in a row. Texts are split, and their distinct parts found, by
Arrow, some megabytes at a time. Most parts are a letter run and marks behind it; the ids of
such runs are kept in a bounded table, and only runs that are new go to the tokenizers library,
many in one call. The ids of all parts are then gathered by their numbers.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidefetch.llm.common import kept

#: Characters after which a run of letters surely ends; they make up one token run of their own.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Stands before a part that is no run of letters or marks. No part of white space begins with it.
_ODD = "\n"
#: Bytes that the table of runs may hold, as counted by ``Table``.
RUN_BYTES = 96 << 20
#: Characters of texts that are split together, and parts whose ids are gathered together.
SLICE = 4 << 20
GATHER = 1 << 18
#: What a table entry takes besides its key and value, about.
_ENTRY_BYTES = 180


class Table:
    """What is known of strings, in two halves. When the newer is full it takes the place of the older.

    So strings that are in use stay, and at most ``most`` bytes are held.
    """

    def __init__(self, most: int):
        self.most = most // 2
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def recall(self, keys: set[str]) -> set[str]:
        """Brings ``keys`` to the newer half; those that are in none."""
        missing, old = keys.difference(self.new), self.old
        self.add({key: old[key] for key in missing if key in old})
        return missing.difference(self.new)

    def add(self, entries: dict[str, bytes]) -> None:
        self.new.update(entries)
        self.held += sum(map(len, entries)) + sum(map(len, entries.values())) + _ENTRY_BYTES * len(entries)

    def turn(self) -> None:
        """Call when nothing that was recalled is needed any more."""
        if self.held > self.most:
            self.old, self.new, self.held = self.new, {}, 0


def _listed(strings: pa.Array) -> list:
    """The values of a string or binary column. NumPy makes them many times faster than ``to_pylist``."""
    return strings.to_numpy(zero_copy_only=False).tolist()


def _runs_of(parts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Runs of letters or marks, and for each part the numbers of its one or two, from 1 on; 0 is none.

    A part that is nothing but letters and marks behind them, in any case of letters, has a run of
    each. Any other is a run by itself, with ``_ODD`` before it, for the tokenizer to take apart.
    """
    trimmed = pc.utf8_rtrim(parts, characters=_MARKS)
    cores = pc.ascii_lower(trimmed).dictionary_encode()
    which, names = cores.indices.to_numpy(), cores.dictionary
    simple = pc.utf8_is_alpha(names).to_numpy(zero_copy_only=False).copy()
    other = np.flatnonzero(simple & ~pc.string_is_ascii(names).to_numpy(zero_copy_only=False))
    letters = _listed(names.take(pa.array(other)))
    simple[other] = [n.isalpha() and n.lower().isalpha() and "Σ" not in n for n in letters]
    runs = _listed(names.filter(pa.array(simple)))
    number = np.zeros(len(names), np.int64)
    number[simple] = 1 + np.arange(len(runs))
    first, second = number[which], np.zeros(len(parts), np.int64)

    sizes = pc.binary_length(parts).to_numpy()
    kept = pc.binary_length(trimmed).to_numpy()
    marked = (first > 0) & (kept < sizes)
    ended = _listed(parts.filter(pa.array(marked)).cast(pa.large_binary()))
    behind = [p[n:] for p, n in zip(ended, kept[marked].tolist())]
    marks = pa.array(behind, pa.large_string()).dictionary_encode()
    second[marked] = 1 + len(runs) + marks.indices.to_numpy()
    runs += _listed(marks.dictionary)

    odd = (first == 0) & (sizes > 0)
    first[odd] = 1 + len(runs) + np.arange(int(odd.sum()))
    runs += [_ODD + p for p in _listed(parts.filter(pa.array(odd)))]
    return runs, first, second


class PartEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids.

    Only for a tokenizer that drops white space, lower-cases and marks the end of a word
    (as word_bpe_49k.json).
    """

    def __init__(self, path: str, run_bytes: int = RUN_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.runs = Table(run_bytes)
        ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            ends[number] = token.endswith("</w>")
        self.ends = ends

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, without an end id; none for a null."""
        made: list[bytes] = []
        at = 0
        while at < len(texts):
            first, size = at, 0
            while at < len(texts) and (at == first or size + len(texts[at] or "") <= SLICE):
                size += len(texts[at] or "")
                at += 1
            made += self._slice(texts[first:at])
            self.runs.turn()
        return made

    def forget(self) -> None:
        """Give the table's memory back, as workers live on for other stages."""
        self.runs = Table(2 * self.runs.most)
        pa.default_memory_pool().release_unused()

    def _slice(self, texts: list[str | None]) -> list[bytes]:
        # Arrow also splits at four control characters that are no white space to the tokenizer.
        whole = [i for i, t in enumerate(texts) if t and any(map(t.__contains__, "\x1c\x1d\x1e\x1f"))]
        plain = pa.array(texts, pa.large_string())
        if whole:
            kept = np.ones(len(texts), bool)
            kept[whole] = False
            plain = pc.if_else(pa.array(kept), plain, pa.scalar(None, pa.large_string()))
        parts = pc.utf8_split_whitespace(plain.fill_null(""))
        numbered = parts.flatten().dictionary_encode()
        numbers = numbered.indices.to_numpy()
        runs, first, second = _runs_of(numbered.dictionary)
        ids, starts, lengths = self._ids(runs)
        counts = np.zeros(len(numbers) + 1, np.int64)
        np.cumsum((lengths[first] + lengths[second])[numbers], out=counts[1:])
        data = b"".join(self._gathered(numbers, first, second, ids, starts, lengths))
        ends = (4 * counts[parts.offsets.to_numpy()]).tolist()
        made = [data[a:b] for a, b in zip(ends, ends[1:])]
        for i in whole:
            made[i] = np.asarray(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, "<u4").tobytes()
        return made

    def _gathered(self, numbers, first, second, ids, starts, lengths):
        for at in range(0, len(numbers), GATHER):
            part = numbers[at : at + GATHER]
            runs = np.stack([first[part], second[part]], axis=1).ravel()
            count = lengths[runs]
            before = np.cumsum(count) - count
            yield ids[np.repeat(starts[runs] - before, count) + np.arange(int(count.sum()))].tobytes()

    def _ids(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all runs in a row, and where each run's begin and how many they are."""
        new = self.runs.recall(set(runs))
        self._learn_runs([r for r in new if r[:1] != _ODD])
        odd = [r for r in new if r[:1] == _ODD]
        for start in range(0, len(odd), 2000):
            block = odd[start : start + 2000]
            made = self.tokenizer.encode_batch_fast([r[1:] for r in block], add_special_tokens=False)
            self.runs.add({run: np.asarray(m.ids, "<u4").tobytes() for run, m in zip(block, made)})
        made = [b"", *map(self.runs.new.__getitem__, runs)]
        lengths = np.fromiter(map(len, made), np.int64, len(made)) // 4
        return np.frombuffer(b"".join(made), "<u4"), np.cumsum(lengths) - lengths, lengths

    def _learn_runs(self, runs: list[str]) -> None:
        """Each run is one word to the tokenizer, so the word-end tokens tell the runs apart."""
        for start in range(0, len(runs), 4000):
            block = runs[start : start + 4000]
            made = self.tokenizer.encode_batch_fast([" ".join(block)], add_special_tokens=False)
            ids = np.asarray(made[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(block):
                data, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
                self.runs.add({run: data[a:b] for run, a, b in zip(block, at, at[1:])})
            else:
                made = self.tokenizer.encode_batch_fast(block, add_special_tokens=False)
                self.runs.add({run: np.asarray(m.ids, "<u4").tobytes() for run, m in zip(block, made)})


@lru_cache(maxsize=1)
def encoder(path: str) -> PartEncoder:
    """One encoder for each Python worker. Its table stays from task to task, until another operator's ``releasing`` task."""
    made = PartEncoder(path)
    kept["encoder"] = made.forget
    return made


def frugal(run):
    """A task function that gives up freed Arrow memory at its end, but keeps the encoder's table."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return task
