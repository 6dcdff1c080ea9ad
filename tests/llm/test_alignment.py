from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hackney.llm import alignment
from tests.llm.conftest import CLASHING, rows

ODD = [
    (1, None), (None, ""), (5, "<|endoftext|> a<s>b</s> <unk>"), (6, "has ▁ in it"), (6, "a b"), (6, "a b"),
    (7, "\0 a\t\tb" + " " * 50 + "z"), (9, "①ﬁ 字字字 é \x1c \x85  " + "x" * 3000), (10, "word " * 900),
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.MODEL))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    level = {chr(c): c for c in printable} | {chr(256 + n): c for n, c in enumerate(rest)}
    return a, b, level


def spans(tokens):
    ends = np.cumsum([len(t) for t in tokens]).tolist()
    return list(zip([0, *ends], ends))


def brute(documents, libraries):
    """Tokens by the libraries, and every two spans compared near each other."""
    a_side, b_side, level = libraries
    found = []
    for doc_id, text in documents:
        text = text or ""
        a = a_side.encode(" " + text, add_special_tokens=False).ids
        b = b_side.encode(text)
        a_bytes = [bytes(level[c] for c in a_side.id_to_token(i)) for i in a]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode()
            for i in b for p in [b_side.id_to_piece(i)]
        ]
        raw = (" " + text).encode()
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            found.append((doc_id, [], [], [], [], 0))
            continue
        one, other = spans(a_bytes), spans(b_bytes)
        links, k = [], 0
        for i, (lo, hi) in enumerate(one):
            while other[k][1] <= lo:
                k += 1
            j = k
            while j < len(other) and other[j][0] < hi:
                links.append((i, j, min(hi, other[j][1]) - max(lo, other[j][0])))
                j += 1
        cuts = sorted({e for _, e in one} & {e for _, e in other})
        groups = [([], []) for _ in cuts]
        for side, ids, ranges in ((0, a, one), (1, b, other)):
            n = 0
            for token, (_, end) in zip(ids, ranges):
                groups[n][side].append(token)
                n += end == cuts[n]
        found.append((doc_id, a, b, groups, links, sum(len(x) * len(y) for x, y in groups)))
    return found


def expected(found):
    held = Counter(p for _, a, b, _, links, _ in found for p in {(a[i], b[j]) for i, j, _ in links})
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = []
    for doc_id, a, b, groups, links, _ in found:
        pairs = [(a[i], b[j]) for i, j, _ in links]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            doc_id, len(a), len(b), len(groups), len(links), sum(held[p] == most[p[0]] for p in pairs),
            sum(held[p] for p in pairs), hashlib.sha256(text.encode()).hexdigest() if a else "",
        ))
    return sorted(out, key=lambda r: [(v is not None, v) for v in r])


@pytest.mark.parametrize("sizes", [{}, {"part_chars": 40, "together_chars": 200, "block_chars": 5000}])
def test_counts_against_brute_force(spark, libraries, sizes):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    documents = [tuple(r) for r in table.collect()] + ODD
    docs = spark.createDataFrame(documents, "doc_id long, text string").coalesce(2)
    assert rows(alignment.link_counts(docs, **sizes)) == expected(brute(documents, libraries))


def test_align_against_brute_force(spark, libraries):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20)
    documents = list(enumerate([r.text for r in table.collect()] + [t for _, t in ODD]))
    found = {r.doc_id: r for r in alignment.align(spark.createDataFrame(documents, "doc_id long, text string")).collect()}
    for doc_id, a, b, groups, links, shared in brute(documents, libraries):
        r = found[doc_id]
        assert (r.a_ids, r.b_ids, r.n_shared) == (a, b, shared)
        assert list(zip(r.link_a, r.link_b, r.link_bytes)) == links
        assert r.a_group == [n for n, (x, _) in enumerate(groups) for _ in x]
        assert r.b_group == [n for n, (_, y) in enumerate(groups) for _ in y]


def test_products_as_dense_ones():
    draw = np.random.default_rng(3)
    for _ in range(50):
        a, b = draw.integers(0, 3, (draw.integers(1, 9), 7)), draw.integers(0, 3, (7, draw.integers(1, 9)))

        def rows_of(dense):
            r, c = np.nonzero(dense)
            return alignment.Rows(
                np.searchsorted(r, np.arange(len(dense) + 1)), c, dense[r, c], dense.shape[1]
            )

        def dense(m):
            out = np.zeros((len(m), m.n_columns), np.int64)
            out[m.row_of_entries(), m.columns] = m.values
            return out

        assert (dense(rows_of(a).times(rows_of(b))) == a @ b).all()
        assert (dense(rows_of(a).transposed()) == a.T).all()
        some = draw.integers(0, len(a), 4)
        assert (dense(rows_of(a).only(some)) == a[some]).all()


def test_shared_links_are_all_pairs_of_groups():
    two = alignment.sides(*alignment._paths(None, None))
    found = alignment.align_parts(two, ["hello wörld  x", "ab 字字"])
    links = found.shared_links(np.arange(len(found.a)))
    pairs = set(zip(links.row_of_entries().tolist(), links.columns.tolist()))
    same = found.a_groups.columns[:, None] == found.b_groups.columns[None, :]
    assert pairs == set(zip(*(x.tolist() for x in np.nonzero(same))))
    assert found.n_shared().sum() == len(pairs)


def test_extra_columns_and_empty_table(spark, make_docs):
    docs = make_docs((1, "a b"), (2, None)).withColumns(
        {c: F.lit("x") for c in [*CLASHING, "block", "position", "pairs", "n_a", "digest"]}
    )
    assert [r[:2] for r in rows(alignment.link_counts(docs))] == [(1, 2), (2, 0)]
    assert rows(alignment.link_counts(docs.limit(0))) == []
    assert rows(alignment.align(docs.limit(0))) == []
