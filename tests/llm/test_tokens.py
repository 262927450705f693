"""The encoder's ids against the tokenizers library."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tidefetch.llm import packing, queries, tokens
from tidefetch.llm.common import releasing

ALPHABETS = [
    "abcdefgh ,.",
    "ABCxyz \t\n!?'\"-_",
    "éÉßİıΣσς ǅ,ﬁ.",
    "日本語 中文한국어。、",
    "абвГД ёЁ;:",
    "ελλΗΝΙΚά .",
    "ابجد هوز،؟",
    "אבגד 12.5%",
    "देवनागरी ा ् ",
    "0123456789 .,e+-",
    "\x00\x01\x1c\x1d\x1e\x1f\x7f\x85\xa0 a\u200b\u2028\u3000\u180e\ufeff",
    "😀👩\u200d🔬 x\u0301e\u0308 𝒜𝔅",
    "</s>[INST]\\ {}~`^|",
]


def text(draw: random.Random) -> str:
    letters = "".join(draw.sample(ALPHABETS, draw.randint(1, 3)))
    return "".join(draw.choice(letters) for _ in range(draw.randint(0, 30)))


@pytest.fixture(scope="module")
def encoder():
    return tokens.PartEncoder(queries.tokenizer_path())


def same(encoder, texts):
    wanted = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for t, ids, made in zip(texts, wanted, encoder.encode(texts), strict=True):
        assert np.frombuffer(made, "<u4").tolist() == ids, repr(t)


def test_ids_equal_the_library(encoder):
    draw = random.Random(17)
    for _ in range(30):
        same(encoder, [None, "", *(text(draw) for _ in range(400))])


def test_small_tables_and_slices_change_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "SLICE", 300)
    monkeypatch.setattr(tokens, "GATHER", 7)
    small = tokens.PartEncoder(queries.tokenizer_path(), run_bytes=20_000)
    draw = random.Random(3)
    for _ in range(20):
        same(small, [" ".join(text(draw) for _ in range(draw.randint(0, 30))) for _ in range(30)])
        assert small.runs.held < 200_000
    small.forget()
    same(small, ["word Word, WORD! word...", "x" * 5000])


def test_packing_tasks_keep_the_table_until_another_operator_runs():
    path = queries.tokenizer_path()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["some words", None])], ["doc_id", "text"])
    task = tokens.frugal(packing._pieces(path, 4096, 1))
    first = pa.Table.from_batches(task([batch]))
    table = tokens.encoder(path).runs
    assert {"some", "words"} <= table.new.keys()
    assert pa.Table.from_batches(task([batch])) == first
    assert tokens.encoder(path).runs is table
    list(releasing(lambda batches: batches)([batch]))
    assert not tokens.encoder(path).runs.new
    assert pa.Table.from_batches(task([batch])) == first
