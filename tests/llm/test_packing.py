from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hackney.llm import packing, queries
from tests.llm.conftest import CLASHING, rows

PATH = public_tokenizers.path(packing.TOKENIZER)
RANKS = public_tokenizers.path(packing.RANKS)


def check_whole(pieces, texts):
    """Pieces hold each document's ids once, sequences are gapless and full."""
    library = Tokenizer.from_file(PATH)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for doc_id, text in texts.items():
        want = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(by_doc[doc_id], key=lambda p: p.start)
        got = np.concatenate([np.frombuffer(p.ids, "<u4") for p in own]).tolist()
        assert got == want
        assert [p.start for p in own] == np.cumsum([0, *[p.length for p in own]])[:-1].tolist()
        assert {p.doc_tokens for p in own} == {len(want)}
    for sequence in by_sequence.values():
        sequence.sort(key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in sequence])
        assert [p.offset for p in sequence] == [0, *ends[:-1]]
        assert ends[-1] == sequence[0].sequence_tokens
        assert ends[-1] == 1024 or ends[-1] & (ends[-1] - 1) == 0


def test_every_id_in_one_piece(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_whole(packing.pack(docs, batch_tokens=50_000).collect(), texts)


@pytest.mark.parametrize("seed", range(20))
def test_assignment(seed):
    draw = random.Random(seed)
    lengths = [draw.choice([1, 2, 7, 100, 900, 1024, 3000]) for _ in range(draw.randint(0, 60))]
    pieces, rooms = packing.assign(lengths, 1024, 1.0, 1 / 1024)
    filled = [0] * len(rooms)
    for _, _, length, sequence, _ in pieces:
        filled[sequence] += length
    assert filled == rooms
    for doc, total in enumerate(lengths):
        own = sorted((s, n) for d, s, n, _, _ in pieces if d == doc)
        assert sum(n for _, n in own) == total
        assert all(s + n == t for (s, n), (t, _) in zip(own, own[1:], strict=False))


def test_costs_are_balanced():
    lengths = [500] * 40 + [100] * 40
    pieces, rooms = packing.assign(lengths, 1024, 1.0, 1 / 1024)
    costs = [0.0] * len(rooms)
    for _, _, n, sequence, _ in pieces:
        costs[sequence] += n + n * n / 1024
    whole = [c for c, r in zip(costs, rooms, strict=True) if r == 1024]
    assert max(whole) < 1.4 * min(whole)
    assert sum(start > 0 for _, start, _, _, _ in pieces) < len(lengths) / 3


def test_odd_rows(spark, make_docs):
    docs = make_docs((1, None), (2, ""), (None, "a b"), (3, "x"), (3, "x"), (4, "long " * 5000))
    wide = docs.withColumns({c: F.lit(1) for c in CLASHING})
    pieces = packing.pack(wide).collect()
    assert sum(p.length for p in pieces) == 1 + 1 + 3 + 2 * 2 + 5002
    assert sorted(p.doc_tokens for p in pieces if p.doc_id == 3) == [2, 2]
    assert rows(packing.pack(docs.limit(0))) == []


def test_batches_are_bounded_by_bytes(spark, monkeypatch):
    """What the query hands to Python at once does not follow the width of texts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)

    def sizes(batches):
        for batch in batches:
            row = {f.name: [b"" if f.name == "ids" else batch.nbytes] for f in packing.PIECES}
            yield pa.RecordBatch.from_pydict(row)

    wide = spark.range(0, 6_000, 1, 1).select("id", F.repeat(F.lit("w "), 1000).alias("text"))
    monkeypatch.setattr(packing, "pack", lambda docs: docs.mapInArrow(sizes, packing.PIECES))
    assert queries.packed_pieces(wide).agg(F.max("length")).first()[0] < 5 << 20
    assert spark.conf.get(key) == before


TEXTS = [
    "", " ", "  two  spaces ", "tab\tand\nline\r\n\n", "it's we'll I'M", "1234567 3.14", "naïve — ümläut",
    "日本語のテキスト", "emoji 👩‍👩‍👧 z̀", "a<|endoftext|>b", "<|endoftext|>", "\x00\x01\x7f", " nbsp em",
    "CAPS!! *** $$$ | bar", "x" * 3000, "é" * 500, "   \n   trailing   ", "﻿bom", "ﬁ ﷺ",
]


def test_ranks_give_the_library_ids():
    draw = random.Random(1)
    alphabet = "ab eé\n\t'1日.👍 <|>​"
    texts = TEXTS + ["".join(draw.choices(alphabet, k=draw.randint(1, 60))) for _ in range(500)]
    assert packing.encode(texts, PATH, RANKS) == packing.encode(texts, PATH, None)
