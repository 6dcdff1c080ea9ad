from __future__ import annotations

import random

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from hackney.llm import token_counts
from tests.llm.conftest import CLASHING, rows
from tests.llm.test_packing import TEXTS

PATH = public_tokenizers.path(token_counts.MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    draw = random.Random(5)
    alphabets = ["ab ", "the reonst  ", "▁ a▁", "é日 1x\n", "</s> <s>", "=-_* "]
    made = [
        "".join(draw.choices(draw.choice(alphabets), k=draw.randint(1, 80))) for _ in range(400)
    ]
    return [*TEXTS, "▁", "</s>", "<unk><s>", " " * 40, "a" + " " * 33 + "b", "-" * 70, *made]


def test_counts_of_the_library_for_any_cut():
    machine = token_counts.transducer(PATH)
    draw = random.Random(6)
    for text in texts():
        escaped = (" " + text if text else "").replace(" ", token_counts.SPACE)
        want = len(LIBRARY.encode(text))
        for size in (1, 3, 10, 1000):
            chunks = [escaped[i : i + size] for i in range(0, len(escaped), size)]
            assert machine.scan([machine.chunk_map(c) for c in chunks]) == want, (text, size)
        cut = draw.randint(0, len(escaped))
        maps = [machine.chunk_map(escaped[:cut]), machine.chunk_map(escaped[cut:])]
        assert machine.scan(maps) == want


def test_maps_compose_in_any_grouping():
    machine = token_counts.transducer(PATH)
    text = (" some words and  more of them" * 3).replace(" ", token_counts.SPACE)
    maps = [machine.chunk_map(text[i : i + 7]) for i in range(0, len(text), 7)]
    start = ("", 0, token_counts.START)
    left = start
    for m in maps:
        left = machine.compose(left, m)
    right = maps[-1]
    for m in reversed(maps[:-1]):
        right = machine.compose(m, right)
    assert machine.compose(start, right)[1:] == left[1:]


def test_forgetting_changes_nothing():
    machine = token_counts.Transducer(PATH)
    text = "▁forgetful▁machines▁count▁alike"
    before = machine.scan([machine.chunk_map(text)])
    machine.forget()
    assert machine.scan([machine.chunk_map(text)]) == before


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, chunk_chars=300).collect()}
    for r in docs.collect():
        assert got[r.doc_id].n_tokens == len(LIBRARY.encode(r.text))
        assert got[r.doc_id].n_bytes == len(r.text.encode())


def test_odd_rows(spark, make_docs):
    long = "word " * 20_000
    docs = make_docs((1, None), (2, ""), (None, "a b"), (3, "é"), (3, "é"), (4, long))
    wide = docs.withColumns({c: F.lit(1) for c in CLASHING})
    assert rows(token_counts.count_tokens(wide)) == [
        (None, 3, 2),
        (1, 0, 0),
        (2, 0, 0),
        (3, 2, len(LIBRARY.encode("é"))),
        (3, 2, len(LIBRARY.encode("é"))),
        (4, 100_000, len(LIBRARY.encode(long))),
    ]
    assert rows(token_counts.count_tokens(docs.limit(0))) == []
