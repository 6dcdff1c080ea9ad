"""How the sources of a language differ in their use of its frequent terms.

**Frequent terms by iceberg prefix refinement.** A term is kept if at least `min_docs` documents of its
language hold it. No term is counted whole at first: a level counts the documents per byte prefix of
some length, discards the prefixes below the threshold (no term that begins with one can reach it), and
the next level extends the rest to twice the length, until every prefix left is a complete term. Rare
terms, the bulk of a vocabulary, thus leave as short prefixes that many of them share.

A document counts once for a prefix, however many of its terms begin with it. Documents are read once:
within one, sorted, a term is the first of those with its prefix if it shares fewer bytes than that
with the term before. So per term it is enough to keep the number of documents by how much is shared
(`docs[k]`: documents in which the term is the first with its prefix of level k). These numbers add up
over documents, and blocks of documents are summed inside the task that reads them, before anything is
shuffled.

**Divergence.** A source's share of a term is `1 + floor(10**9 (n + 5) / (N + 5 V))` in integers, for n
occurrences there, N occurrences of all kept terms and V kept terms. The distance of two sources of a
language sums the differences of their shares over all kept terms, of which each source lacks some. It
is summed in blocks of terms by tiles of sources: a task holds `TILE` sources by `TERMS` terms at most a
tile, whatever the number of either.

Defined results: null text, language or source are empty strings. Repeated and null ids do not matter,
each row is a document. A source without terms is a group like any other; a language without kept terms
has distances of 0 and no term rows. Ties are ranked by item in byte order. Empty tables give no rows.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hackney.llm.common import LOWER, blocks, pick, utf8_rows, word_spans
from hackney.session import stage, stages_dropped

FIRST_LEVEL = 4  # bytes of the first level's prefixes; each level has twice those of the one before
BLOCK = 8 << 20  # bytes of text whose words are found at once
SUMMED = 32 << 20  # bytes of text that are summed before rows leave the task
TERMS, TILE = 4096, 64
SHARE = 1_000_000_000
SMOOTHING = 5

#: Bytes outside terms: all of ASCII but letters.
OUTSIDE = np.arange(256) < 0x80
OUTSIDE[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = False

ROWS = "lang string, term binary, docs array<int>, sources array<struct<source: string, n: bigint>>"


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sum of what they carry."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


def _document_terms(data: np.ndarray, bounds: np.ndarray, block: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Row, term and occurrences of each distinct term of each row; the terms as a sorted dictionary."""
    rows, counts, words = [], [], []
    for row, part, cuts in blocks(LOWER[data], bounds, block):
        starts, ends, local = word_spans(part, cuts, OUTSIDE)
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        letters = np.ascontiguousarray(part[~OUTSIDE[part]])
        found = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
        ).dictionary_encode()
        size = max(len(found.dictionary), 1)
        keys, n = np.unique(
            (row + local) * size + found.indices.to_numpy().astype(np.int64), return_counts=True
        )
        rows.append(keys // size)
        counts.append(n)
        words.append(
            pa.DictionaryArray.from_arrays(pa.array((keys % size).astype(np.int32)), found.dictionary)
        )
    if not words:
        return np.zeros(0, np.int64), pa.array([], pa.binary()), np.zeros(0, np.int64)
    joined = pa.chunked_array(words).unify_dictionaries()
    terms = joined.chunk(0).dictionary
    index = np.concatenate([c.indices.to_numpy() for c in joined.chunks]).astype(np.int64)
    order = pc.sort_indices(terms).to_numpy()
    rank = np.empty(len(terms), np.int64)
    rank[order] = np.arange(len(terms))
    # A text that came in several blocks has a term once in each.
    size = max(len(terms), 1)
    keys, n = _summed(np.concatenate(rows) * size + rank[index], np.concatenate(counts))
    return keys, terms.take(pa.array(order)), n


def _first_of_prefix(row: np.ndarray, rank: np.ndarray, terms: pa.Array) -> np.ndarray:
    """Per entry, at how many levels the term before it in the same row has the same prefix."""
    same_row = np.zeros(len(row), bool)
    same_row[1:] = row[1:] == row[:-1]
    shared = np.zeros(len(row), np.int64)
    longest = pc.max(pc.binary_length(terms)).as_py() or 0
    level = FIRST_LEVEL
    while level < longest:
        prefixes = pc.binary_slice(terms, 0, level)
        number = np.zeros(len(terms), np.int64)
        changes = pc.not_equal(prefixes[1:], prefixes[:-1])
        np.cumsum(changes.to_numpy(zero_copy_only=False), out=number[1:])
        mine = number[rank]
        shared[1:] += same_row[1:] & (mine[1:] == mine[:-1])
        level *= 2
    return shared


def _term_rows(
    data: np.ndarray, bounds: np.ndarray, langs: pa.Array, sources: pa.Array, block: int
) -> pa.RecordBatch:
    """One row per language and term of a run of documents, as `ROWS` has them."""
    keys, terms, n = _document_terms(data, bounds, block)
    size = max(len(terms), 1)
    row, rank = keys // size, keys % size
    shared = _first_of_prefix(row, rank, terms)
    lang = langs.indices.to_numpy()[row].astype(np.int64)
    source = sources.indices.to_numpy()[row].astype(np.int64)
    groups, group = np.unique(lang * size + rank, return_inverse=True)
    levels = int(shared.max(initial=0)) + 1
    table = np.bincount(group * levels + shared, minlength=len(groups) * levels)
    docs = np.cumsum(table.reshape(len(groups), levels), axis=1).astype(np.int32)
    per_source, occurrences = _summed(group * len(sources.dictionary) + source, n)
    ends = np.searchsorted(per_source // len(sources.dictionary), np.arange(len(groups) + 1))
    structs = pa.StructArray.from_arrays(
        [sources.dictionary.take(pa.array(per_source % len(sources.dictionary))),
         pa.array(occurrences, pa.int64())], ["source", "n"],
    )
    return pa.RecordBatch.from_arrays(
        [
            langs.dictionary.take(pa.array(groups // size)),
            terms.take(pa.array(groups % size)),
            pa.ListArray.from_arrays(
                pa.array(np.arange(len(groups) + 1) * levels, pa.int32()), pa.array(docs.ravel())
            ),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
        ],
        names=["lang", "term", "docs", "sources"],
    )


def _read_terms(
    batches: Iterator[pa.RecordBatch], block: int, summed: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = utf8_rows(batch.column("text"))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(bounds, bounds[lo] + summed, "right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            part = data[bounds[lo] : bounds[hi]]
            langs, sources = (
                batch.column(c).slice(lo, hi - lo).dictionary_encode() for c in ("lang", "source")
            )
            yield _term_rows(part, bounds[lo : hi + 1] - bounds[lo], langs, sources, block)
            lo = hi


def frequent_terms(rows: DataFrame, min_docs: int) -> DataFrame:
    """`lang` and `term` of all terms in at least `min_docs` documents, by growing prefixes.

    `rows` has `lang`, `term` and `docs` as the module describes; terms may have several rows.
    """
    left = rows.select("lang", "term", "docs")
    kept = []
    level, size = 0, FIRST_LEVEL
    while True:
        first = F.element_at("docs", F.least(F.lit(level + 1), F.size("docs")))
        whole = F.when(F.octet_length("term") <= size, F.element_at("docs", -1))
        prefix = F.substring("term", 1, size).alias("prefix")
        counted = left.groupBy("lang", prefix).agg(
            F.sum(first).alias("n_docs"), F.sum(whole).alias("n_whole")
        )
        frequent = stage(counted.where(F.col("n_docs") >= min_docs), "prefixes")
        kept.append(
            frequent.where(F.col("n_whole") >= min_docs).select("lang", F.col("prefix").alias("term"))
        )
        longer = left.where(F.octet_length("term") > size).withColumn("prefix", prefix)
        left = stage(longer.join(frequent, ["lang", "prefix"], "left_semi").drop("prefix"), "refined")
        if left.isEmpty():
            return reduce(DataFrame.unionAll, kept)
        level, size = level + 1, size * 2


def _documents(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    chosen = pick(docs, text=text_col, lang=lang_col, source=source_col)
    return chosen.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in chosen.columns])


def term_counts(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = 30,
    block: int = BLOCK,
    summed: int = SUMMED,
) -> DataFrame:
    """Occurrences `n` of the kept terms per `lang`, `source` and `term`, as a stored table."""
    with stages_dropped(docs.sparkSession) as keep:
        chosen = _documents(docs, text_col, lang_col, source_col)
        found = chosen.mapInArrow(lambda batches: _read_terms(batches, block, summed), ROWS)
        rows = stage(found, "terms")
        kept = frequent_terms(rows, min_docs)
        counted = (
            rows.select("lang", "term", "sources")
            .join(kept, ["lang", "term"], "left_semi")
            .select("lang", "term", F.inline("sources"))
            .groupBy("lang", "source", F.col("term").cast("string").alias("term"))
            .agg(F.sum("n").alias("n"))
        )
        return keep(stage(counted, "term-counts"))


def _share(count: str | int) -> Column:
    return F.expr(
        f"1 + cast(({SHARE} * cast({count} + {SMOOTHING} as decimal(20, 0)))"
        f" div greatest(cast(n_all + {SMOOTHING} * v as decimal(20, 0)), 1) as bigint)"
    )


def _block_distances(table: pa.Table, tile: int) -> pa.Table:
    """Differences of each two sources of a tile pair, summed over the terms of a block.

    Rows without a term give a source's number, its share of terms it lacks, and the block's terms.
    """
    numbers = table["number"].to_numpy()
    shares = table["share"].to_numpy()
    given = table["term"].is_null().to_numpy()
    members, first = np.unique(numbers[given], return_index=True)
    none = shares[given][first]
    high, low = table["high"][0].as_py(), table["low"][0].as_py()
    n_terms = int(table["n_terms"].to_numpy(zero_copy_only=False)[given][0])
    terms = table["term"].combine_chunks().dictionary_encode()
    dense = np.repeat(none[:, None], n_terms, axis=1)
    held = ~given
    index = terms.indices.filter(pa.array(held)).to_numpy()
    dense[np.searchsorted(members, numbers[held]), index] = shares[held]
    ones, others, sums = [], [], []
    tiles = members // tile
    mine, theirs = np.flatnonzero(tiles == high), np.flatnonzero(tiles == low)
    for i in mine:
        to = theirs[theirs < i]
        ones.append(np.repeat(members[i], len(to)))
        others.append(members[to])
        sums.append(np.abs(dense[to] - dense[i]).sum(axis=1))
    langs = pa.array([table["lang"][0].as_py()] * sum(map(len, ones)), pa.string())
    columns = [np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in (ones, others, sums)]
    return pa.table([langs, *map(pa.array, columns)], names=["lang", "one", "other", "value"])


def distances(
    counts: DataFrame, groups: DataFrame, tile: int = TILE, terms: int = TERMS
) -> DataFrame:
    """`lang`, `source`, `item` and `value` for each two sources of a language, both ways.

    `groups` has each `lang` and `source` with its kept occurrences `n_all` and the language's kept
    terms `v`; their numbers are given in order.
    """
    in_lang = Window.partitionBy("lang")
    numbered = groups.withColumn("number", F.row_number().over(in_lang.orderBy("source")) - 1).withColumn(
        "n_tiles", F.ceil(F.count("*").over(in_lang) / tile).cast("int")
    )
    numbered = stage(numbered.withColumn("n_blocks", F.ceil((F.col("v") + 1) / terms).cast("int")), "numbers")
    block = F.pmod(F.xxhash64("term"), F.col("n_blocks")).cast("int").alias("block")
    held = counts.join(numbered, ["lang", "source"]).select(
        "lang", "number", "n_tiles", block, "term", _share("n").alias("share"),
        F.lit(None).cast("long").alias("n_terms"),
    )
    sizes = (
        counts.select("lang", "term")
        .distinct()
        .join(numbered.select("lang", "n_blocks").distinct(), "lang")
        .groupBy("lang", block)
        .agg(F.count("*").alias("n_terms"))
    )
    every_block = numbered.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    members = every_block.join(sizes, ["lang", "block"], "left").select(
        "lang", "number", "n_tiles", "block", F.lit(None).cast("string").alias("term"),
        _share(0).alias("share"), F.coalesce("n_terms", F.lit(0).cast("long")).alias("n_terms"),
    )
    tiled = (
        held.unionByName(members)
        .withColumn("tile", F.expr(f"number div {tile}").cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)))
        .select(
            "lang", "block", F.greatest("tile", "with").alias("high"), F.least("tile", "with").alias("low"),
            "number", "term", "share", "n_terms",
        )
    )
    summed = (
        tiled.groupBy("lang", "block", "high", "low")
        .applyInArrow(
            lambda table: _block_distances(table, tile), "lang string, one bigint, other bigint, value bigint"
        )
        .groupBy("lang", "one", "other")
        .agg(F.sum("value").alias("value"))
    )
    names = numbered.select("lang", "number", "source")
    both = summed.select(
        "lang", "value", F.inline(F.array(F.struct(F.col("one").alias("number"), F.col("other").alias("to")),
                                          F.struct(F.col("other").alias("number"), F.col("one").alias("to"))))
    )
    return (
        both.join(names, ["lang", "number"])
        .join(names.select("lang", F.col("number").alias("to"), F.col("source").alias("item")), ["lang", "to"])
        .select("lang", "source", "item", "value")
    )


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = 30,
    top: int = 50,
) -> DataFrame:
    """Per source, its distance to each other source of the language (part `pair`) and the `top` terms
    that it uses more than the language does (part `term`): `lang`, `source`, `part`, `item`, `value`
    and `rank`."""
    counts = term_counts(docs, text_col, lang_col, source_col, min_docs)
    in_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"))
    totals = in_lang.groupBy("lang").agg(F.sum("n_lang").alias("n_all"), F.count("*").alias("v"))
    groups = _documents(docs, text_col, lang_col, source_col).select("lang", "source").distinct()
    zero = F.lit(0).cast("long")
    groups = (
        groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("n_all")), ["lang", "source"], "left")
        .join(totals.select("lang", "v"), "lang", "left")
        .select("lang", "source", F.coalesce("n_all", zero).alias("n_all"), F.coalesce("v", zero).alias("v"))
    )
    groups = stage(groups, "groups")
    pairs = distances(counts, groups)
    usual = in_lang.join(totals, "lang").select("lang", "term", _share("n_lang").alias("usual"))
    above = (
        counts.join(groups, ["lang", "source"])
        .withColumn("share", _share("n"))
        .join(usual, ["lang", "term"])
        .where(F.col("share") > F.col("usual"))
        .select("lang", "source", F.col("term").alias("item"), (F.col("share") - F.col("usual")).alias("value"))
    )
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))

    def part(name: str, rows: DataFrame) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", ranked.alias("rank"))

    return part("pair", pairs).unionAll(part("term", above).where(F.col("rank") <= top))
