"""Near-duplicate documents by DartMinHash signatures in bands, verified exactly.

A document is the set of its shingles of five consecutive words (of all its words, if fewer); two
documents are linked if the Jaccard similarity of their sets is at least `similarity`, and a class is a
connected component of links.

Signatures. Every shingle owns a region of the plane of weight and rank, as wide as its weight, into
which darts fall at rate one per unit area; a hash decides where, so a shingle meets the same darts in
every document. Each dart is hashed to one of the signature's coordinates, and a coordinate keeps its
earliest dart, that of least rank. Two documents agree in a coordinate with the chance of their weighted
similarity. Only darts below a rank are thrown, chosen so that coordinates fill with about
k ln k + 2k darts whatever the document's size; the rank is doubled while a coordinate is empty.

Search. Signatures are cut into bands. Documents that agree in a band form a bucket:

1. Equal word sequences collapse to one text first, whose classes carry over to all copies.
2. In each bucket all texts are paired with one centre, the text with the largest buckets: among copies
   of one original that is the original or what comes closest to it. Each text keeps its most promising
   centre by the number of equal coordinates. These pairs are verified on the shingles, and join
   components.
3. Where a bucket still holds several components, pairs between them can still be links. Buckets are cut
   into blocks of bounded size, and each two blocks of a bucket meet in one row. A first pass compares
   their signatures in NumPy and keeps, of each block, the texts with a promising partner in another
   component, in the first bucket that the two share. A second pass gets the shingles of just these and
   puts out the links alone, skipping pairs that links found before have connected.

Pairs within a component can't change the classes, so they are never made. A large group of copies costs
a star, and no table of pairs grows with the square of a group: what is written is texts and links.

A pair is promising unless its signatures agree in less than `HOPELESS` of the coordinates, four
deviations below the limit, so one link at the very limit in thirty thousand is missed by it.
With 32 bands of 5 of 160 coordinates a pair at 0.8 escapes all bands with a chance of 3 in a million.

Everything between steps is a table in the shared folder; the driver sees counts only. Shingles are sent
for texts that have a candidate. Rows go to Python in batches bounded by bytes, as sets and texts are wide.

Defined results: words are runs outside ASCII white space, compared as they are. A null text or a null
id takes part in nothing: its class is its own id. Texts without words are copies of each other. A class
is named by the least id of its documents. Repeated ids are carried along, one row each. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.llm.common import blocks, mix, pick, span_hashes, utf8_rows, word_spans
from hackney.llm.components import components
from hackney.session import small_batches, stage, stages_dropped

WORDS = 5
BANDS = 32
BAND_ROWS = 5
HOPELESS = 0.67
BLOCK_TEXTS = 1024  # texts of a bucket that are compared in one row
BLOCK_BYTES_OF_SETS = 1 << 24
ROWS = 128  # documents whose signatures are made together
MASK = (1 << 64) - 1
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xD6E8FEB86659FD93)
GROUP = 1 << 17  # shingles whose darts are thrown together


def row_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the rows, and where each row's words begin."""
    data, bounds = utf8_rows(column)
    hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for first, part, inner in blocks(data, bounds):
        starts, ends, row = word_spans(part, inner)
        hashes.append(span_hashes(part, starts, ends))
        rows.append(row + first)
    all_rows = np.concatenate(rows)
    return np.concatenate(hashes), np.searchsorted(all_rows, np.arange(len(column) + 1))


def shingles(words: np.ndarray, begins: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the rows' shingles, and where each row's begin; repeated shingles are kept."""
    lengths = np.diff(begins)
    counts = np.where(lengths >= size, lengths - size + 1, (lengths > 0).astype(np.int64))
    out = np.concatenate([[0], np.cumsum(counts)])
    rows = np.repeat(np.arange(len(lengths)), counts)
    at = begins[rows] + np.arange(out[-1]) - out[rows]
    width = np.minimum(lengths, size)[rows]
    value = width.astype(np.uint64)
    for k in range(size):
        inside = k < width
        value[inside] = mix(value[inside] * GOLDEN + words[at[inside] + k])
    return value, out


def fingerprints(words: np.ndarray, begins: np.ndarray) -> list[bytes]:
    """128 bits of each row's word sequence."""
    lengths = np.diff(begins)
    place = np.arange(len(words)) - np.repeat(begins[:-1], lengths)
    out = np.zeros((len(lengths), 2), np.uint64)
    full = np.flatnonzero(lengths)
    for k, salt in enumerate((GOLDEN, _SECOND)):
        terms = mix(words ^ salt) * (mix(place.astype(np.uint64) + salt) | np.uint64(1))
        if len(full):
            out[full, k] = np.add.reduceat(terms, begins[full])
        out[:, k] = mix(out[:, k] + lengths.astype(np.uint64) * salt)
    return [row.tobytes() for row in out]


def dart_signatures(
    elements: np.ndarray, weights: np.ndarray | None, begins: np.ndarray, k: int
) -> np.ndarray:
    """One row of `k` dart hashes per row of elements; zeros where a row has no element.

    Weights are positive numbers, one for each element; None stands for sets, where each is one and
    repeated elements count once, as they meet the same darts.
    """
    n = len(begins) - 1
    out = np.zeros((n, k), np.uint64)
    sizes = np.diff(begins)
    total = sizes.astype(float)
    if weights is not None:
        sums = np.concatenate([[0.0], np.cumsum(weights)])
        total = sums[begins[1:]] - sums[begins[:-1]]
    todo = np.flatnonzero(sizes)
    limit = np.zeros(n)
    limit[todo] = k * (np.log(k) + 2) / total[todo]
    while len(todo):
        counts = sizes[todo]
        cuts = np.concatenate([[0], np.cumsum(counts)])
        row = np.repeat(np.arange(len(todo)), counts)
        pick_at = begins[todo][row] + np.arange(cuts[-1]) - cuts[row]
        best, dart = _throw(
            elements[pick_at], None if weights is None else weights[pick_at], row, limit[todo], k
        )
        full = np.isfinite(best).all(1)
        out[todo[full]] = dart[full]
        todo = todo[~full]
        limit[todo] *= 2
    return out


def _throw(elements, weights, row, limit, k):
    """The least rank and its dart for each row and coordinate, of darts up to the rows' limits."""
    best = np.full(len(limit) * k, np.inf)
    found_key, found_rank, found_dart = [], [], []
    slab = 0
    while len(elements):
        # The darts of a slab of unit weight arrive in rank as a Poisson process.
        live, live_row = elements, row
        share = None if weights is None else np.minimum(weights - slab, 1.0)
        rank = np.zeros(len(live))
        state = mix(live + np.uint64((slab + 1) * int(_SECOND) & MASK))
        arrival = 0
        while len(live):
            arrival += 1
            draw = mix(state + np.uint64(arrival * int(GOLDEN) & MASK))
            chance = ((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
            if arrival == 1:  # most elements get no dart at all: spare them the logarithm
                near = np.flatnonzero(chance >= np.exp(-limit)[live_row])
                live, live_row, state, draw = live[near], live_row[near], state[near], draw[near]
                rank, chance = rank[near], chance[near]
                share = None if share is None else share[near]
            rank = rank - np.log(chance)
            near = np.flatnonzero(rank <= limit[live_row])
            live, live_row, state, draw = live[near], live_row[near], state[near], draw[near]
            rank = rank[near]
            share = None if share is None else share[near]
            dart = mix(draw ^ _SECOND)
            hit = slice(None)
            if share is not None:  # the dart's place within the slab must lie in the region
                place = (mix(dart + GOLDEN) >> np.uint64(11)).astype(float) * 2.0**-53
                hit = np.flatnonzero(place < share)
            coordinate = (dart[hit] >> np.uint64(20)) % np.uint64(k)
            found_key.append(live_row[hit] * k + coordinate.astype(np.int64))
            found_rank.append(rank[hit])
            found_dart.append(dart[hit])
        slab += 1
        if weights is None:
            break
        wide = np.flatnonzero(weights > slab)
        elements, row, weights = elements[wide], row[wide], weights[wide]
    dart_of = np.zeros(len(best), np.uint64)
    if found_key:
        key, rank, dart = map(np.concatenate, (found_key, found_rank, found_dart))
        np.minimum.at(best, key, rank)
        first = rank == best[key]
        dart_of[key[first]] = dart[first]
    return best.reshape(-1, k), dart_of.reshape(-1, k)


SIGNED = "doc_id long, text_key binary, n_shingles long, signature binary, bands array<long>"


def signatures(
    docs: DataFrame, words: int = WORDS, bands: int = BANDS, band_rows: int = BAND_ROWS
) -> DataFrame:
    """For `doc_id, text`: the text's key, number of shingles, 16 bits per coordinate, band hashes."""
    k = bands * band_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), ROWS):
                yield sign(batch.slice(lo, ROWS))

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, begins = row_words(batch.column("text"))
        values, cuts = shingles(hashes, begins, words)
        out = np.zeros((len(batch), k), np.uint64)
        row = 0
        while row < len(batch):
            last = int(np.searchsorted(cuts, cuts[row] + GROUP, "right")) - 1
            last = min(max(row + 1, last), len(batch))
            part = values[cuts[row] : cuts[last]]
            out[row:last] = dart_signatures(part, None, cuts[row : last + 1] - cuts[row], k)
            row = last
        joined = np.zeros((len(batch), bands), np.uint64)
        for j in range(band_rows):
            joined = mix(joined * GOLDEN + out[:, j::band_rows])
        joined = mix(joined + np.arange(bands, dtype=np.uint64))
        counts = np.diff(cuts)
        offsets = np.concatenate([[0], np.cumsum(np.where(counts > 0, bands, 0))])
        small = (out & np.uint64(0xFFFF)).astype("<u2")
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(fingerprints(hashes, begins), pa.binary()),
                pa.array(counts),
                pa.array([row.tobytes() for row in small], pa.binary()),
                pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()),
                    pa.array(joined[counts > 0].ravel().view(np.int64)),
                ),
            ],
            names=["doc_id", "text_key", "n_shingles", "signature", "bands"],
        )

    return docs.mapInArrow(run, SIGNED)


def _agreement(pairs: DataFrame, signed: DataFrame, k: int) -> DataFrame:
    """Pairs of texts `a, b` with `agree`, the share of equal coordinates."""
    both = pairs.join(
        signed.select(F.col("text_key").alias("a"), F.col("signature").alias("sa")), "a"
    ).join(signed.select(F.col("text_key").alias("b"), F.col("signature").alias("sb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("sa", "sb"):
                flat = b"".join(batch.column(name).to_pylist())
                sides.append(np.frombuffer(flat, "<u2").reshape(len(batch), k))
            share = (sides[0] == sides[1]).mean(1) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(share)], names=["a", "b", "agree"]
            )

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a binary, b binary, agree double")


def _shingle_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """`text_key, shingles` (sorted, 64 bits each) of the wanted `text_key, doc_id`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), ROWS):
                part = batch.slice(lo, ROWS)
                hashes, begins = row_words(part.column("text"))
                values, cuts = shingles(hashes, begins, words)
                sets = [
                    np.unique(values[a:b]).tobytes()
                    for a, b in zip(cuts[:-1], cuts[1:], strict=True)
                ]
                keys = fingerprints(hashes, begins)
                same = [k == w for k, w in zip(keys, part.column("text_key").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(sets, pa.binary())],
                    names=["text_key", "shingles"],
                ).filter(pa.array(same))

    rows = docs.join(wanted, "doc_id").select("text_key", "text")
    found = rows.mapInArrow(run, "text_key binary, shingles binary")
    return found.dropDuplicates(["text_key"])


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs `a, b` whose shingle sets are similar enough."""
    both = pairs.join(
        sets.select(F.col("text_key").alias("a"), F.col("shingles").alias("xa")), "a"
    ).join(sets.select(F.col("text_key").alias("b"), F.col("shingles").alias("xb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                _similar(
                    *(np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in ("xa", "xb")),
                    similarity,
                )
                for i in range(len(batch))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "xa", "xb").mapInArrow(run, "a binary, b binary")


def classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = 0.8,
    words: int = WORDS,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """`doc_id, class_id`, `text_key`, equal for equal word sequences, and `class_key`, the text key of
    the document that names the class."""
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    whole = rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    with stages_dropped(docs.sparkSession) as keep, small_batches(docs.sparkSession):
        signed = keep(stage(signatures(whole, words, bands, band_rows), "signatures"))
        texts = stage(
            signed.groupBy("text_key").agg(
                F.min("doc_id").alias("doc_id"),
                F.first("signature").alias("signature"),
                F.first("bands").alias("bands"),
            ),
            "texts",
        )
        k = bands * band_rows

        def promising(pairs: DataFrame) -> DataFrame:
            return _agreement(pairs.distinct(), texts, k).where(F.col("agree") >= HOPELESS)

        buckets = _shared_buckets(texts)
        centres = (
            buckets.groupBy("bucket")
            .agg(F.max(F.struct("central", "text_key")).alias("centre"))
            .select("bucket", F.col("centre.text_key").alias("centre"))
        )
        pairs = buckets.join(stage(centres, "centres"), "bucket").where("centre <> text_key")
        candidates = promising(pairs.select(F.col("centre").alias("a"), F.col("text_key").alias("b")))
        first = candidates.groupBy("b").agg(F.max(F.struct("agree", "a")).alias("best"))
        stars = stage(first.select(F.col("best.a").alias("a"), "b"), "stars")
        wanted = buckets.select("text_key").distinct().join(texts, "text_key").select("text_key", "doc_id")
        sets = stage(_shingle_sets(whole, wanted, words), "shingles")
        links = stage(_verified(stars, sets, similarity), "links")
        found = components(links)
        parted = _divided(buckets, found)
        if not parted.isEmpty():
            signs = texts.select("text_key", "signature", "bands")
            fields = ["text_key", "component", "signature", "bands"]
            near = _blocks(parted.join(signs, "text_key"), fields, F.lit(1.0 / BLOCK_TEXTS))
            near = stage(near.mapInArrow(_promising_texts(k), "bucket long, text_key binary"), "near")
            kept = parted.join(near.distinct(), ["bucket", "text_key"]).join(signs, "text_key")
            share = 1.0 / BLOCK_TEXTS + F.octet_length("shingles") / float(BLOCK_BYTES_OF_SETS)
            met = _blocks(kept.join(sets, "text_key"), [*fields, "shingles"], share)
            more = stage(met.mapInArrow(_links_of_blocks(k, similarity), "a binary, b binary"), "links")
            found = components(links.union(more))
        named = (
            texts.select("text_key", "doc_id")
            .join(found.withColumnRenamed("node", "text_key"), "text_key", "left")
            .withColumn("component", F.coalesce("component", "text_key"))
        )
        least = named.groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("least"))
        by_text = keep(stage(
            stage(named.select("text_key", "component"), "named")
            .join(stage(least, "least"), "component")
            .select("text_key", F.col("least.doc_id").alias("class_id"), F.col("least.text_key").alias("class_key")),
            "classes",
        ))
    apart = rows.where(F.col("doc_id").isNull() | F.col("text").isNull())
    no_key = F.lit(None).cast("binary")
    return (
        signed.select("doc_id", "text_key")
        .join(by_text, "text_key")
        .select("doc_id", "class_id", "text_key", "class_key")
        .union(apart.select("doc_id", F.col("doc_id").alias("class_id"), no_key, no_key))
    )


def _shared_buckets(texts: DataFrame) -> DataFrame:
    """`bucket, band, text_key` of buckets with several texts, and how `central` the text is: the sum of
    its buckets' sizes."""
    member = texts.select("text_key", F.posexplode("bands").alias("band", "hash")).select(
        "text_key", "band", F.xxhash64("band", "hash").alias("bucket")
    )
    sizes = member.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    sized = stage(member.join(stage(sizes, "sizes"), "bucket"), "sized")
    central = sized.groupBy("text_key").agg(F.sum("size").alias("central"))
    return stage(
        sized.drop("size").join(stage(central, "central"), "text_key"), "buckets"
    )


def _divided(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """`bucket, band, text_key, central, component` of buckets that hold several components."""
    known = found.withColumnRenamed("node", "text_key")
    member = buckets.join(known, "text_key", "left")
    member = stage(
        member.withColumn("component", F.coalesce("component", "text_key")), "members"
    )
    several = (
        member.groupBy("bucket")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"))
        .where("least <> most")
        .select("bucket")
    )
    return stage(member.join(stage(several, "several"), "bucket"), "divided")


def _blocks(rows: DataFrame, fields: list[str], share) -> DataFrame:
    """`bucket, band, left, right, same`: any two blocks of a bucket as lists of `fields`.

    `share` is how much of a block a row fills; a bucket has as many blocks as its rows fill.
    """
    filled = rows.withColumn("share", share)
    sizes = stage(
        filled.groupBy("bucket").agg(F.ceil(F.sum("share")).cast("int").alias("blocks")), "sizes"
    )
    dealt = filled.join(sizes, "bucket").withColumn(
        "block", F.pmod(F.xxhash64("text_key", "bucket"), F.col("blocks")).cast("int")
    )
    # A block meets itself and each block of a higher number.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    sides = dealt.withColumn("other", other).select(
        "bucket",
        "band",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        F.when(F.col("block") <= F.col("other"), F.struct(*fields)).alias("left"),
        F.when(F.col("block") >= F.col("other"), F.struct(*fields)).alias("right"),
    )
    return sides.groupBy("bucket", "band", "low", "high").agg(
        F.collect_list("left").alias("left"),
        F.collect_list("right").alias("right"),
        (F.first("low") == F.first("high")).alias("same"),
    )


def _sides(batch: pa.RecordBatch, row: int, k: int) -> Iterator[dict]:
    """The two lists of a row: keys, components, signatures and band hashes."""
    for name in ("left", "right"):
        items = batch.column(name)[row].values
        signature = b"".join(items.field("signature").to_pylist())
        bands = items.field("bands").flatten().to_numpy()
        yield {
            "items": items,
            "keys": items.field("text_key").to_pylist(),
            "components": items.field("component").to_pylist(),
            "signature": np.frombuffer(signature, "<u2").reshape(len(items), k),
            "bands": bands.reshape(len(items), -1),
        }


def _promising_pairs(batch: pa.RecordBatch, row: int, k: int) -> tuple[dict, dict, np.ndarray]:
    """Both sides, and the pairs of their rows that may be links and share no earlier bucket."""
    left, right = _sides(batch, row, k)
    number = {c: n for n, c in enumerate({*left["components"], *right["components"]})}
    parts = [np.array([number[c] for c in side["components"]]) for side in (left, right)]
    band = batch.column("band")[row].as_py()
    pairs = [np.zeros((0, 2), np.int64)]
    for i in range(len(parts[0])):
        lo = i + 1 if batch.column("same")[row].as_py() else 0
        agree = (right["signature"][lo:] == left["signature"][i]).mean(1)
        j = np.flatnonzero((agree >= HOPELESS) & (parts[1][lo:] != parts[0][i])) + lo
        earlier = (right["bands"][j, :band] == left["bands"][i, :band]).any(1)
        j = j[~earlier]
        pairs.append(np.column_stack([np.full(len(j), i), j]))
    return left, right, np.concatenate(pairs)


def _promising_texts(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                left, right, pairs = _promising_pairs(batch, row, k)
                if len(pairs):
                    keys = [left["keys"][i] for i in np.unique(pairs[:, 0])]
                    keys += [right["keys"][j] for j in np.unique(pairs[:, 1])]
                    bucket = batch.column("bucket")[row].as_py()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([bucket] * len(keys), pa.int64()), pa.array(keys, pa.binary())],
                        names=["bucket", "text_key"],
                    )

    return run


def _links_of_blocks(k: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                links = links_of(batch, row)
                if links:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(side, pa.binary()) for side in zip(*links, strict=True)],
                        names=["a", "b"],
                    )

    def links_of(batch: pa.RecordBatch, row: int) -> list[tuple[bytes, bytes]]:
        left, right, pairs = _promising_pairs(batch, row, k)
        up: dict[bytes, bytes] = {}

        def root(x: bytes) -> bytes:
            while (above := up.get(x, x)) != x:
                x = above
            return x

        links = []
        for i, j in pairs:
            a, b = root(left["components"][i]), root(right["components"][j])
            if a != b and _similar(_set_of(left, i), _set_of(right, j), similarity):
                up[a] = b
                links.append((left["keys"][i], right["keys"][j]))
        return links

    return run


def _set_of(side: dict, i: int) -> np.ndarray:
    return np.frombuffer(side["items"].field("shingles")[i].as_buffer(), np.uint64)


def _similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    if min(len(x), len(y)) < similarity * max(len(x), len(y)):
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared >= similarity * (len(x) + len(y) - shared)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class, the one that names it, with all columns.

    Rows with a null id or text are kept. Of several rows with the id and the text of the document
    that names the class, any one is kept: they are copies.
    """
    with stages_dropped(docs.sparkSession) as keep:
        found = classes(docs, id_col, text_col).where("text_key is not null")
        found = keep(stage(found, "classes"))
    chosen = found.where("doc_id = class_id and text_key = class_key")
    chosen = stage(chosen.select("doc_id", "text_key").distinct(), "chosen")
    # Ids that several rows have: their rows are told apart by text, and copies dropped.
    repeated = stage(
        found.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated"
    )
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
    )
    apart = rows.where(F.col("doc_id").isNull() | F.col("text").isNull())
    whole = rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    plain = whole.join(
        chosen.join(repeated, "doc_id", "left_anti").select("doc_id"), "doc_id", "left_semi"
    )

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array(fingerprints(*row_words(batch.column("text"))), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), keys], names=["row", "doc_id", "text_key"]
            )

    schema = T.StructType(
        [whole.schema["row"], T.StructField("doc_id", T.LongType()), T.StructField("text_key", T.BinaryType())]
    )
    kept = plain.select("row").union(apart.select("row"))
    if not repeated.isEmpty():
        several = (
            whole.join(repeated, "doc_id", "left_semi")
            .select("row", "doc_id", "text")
            .mapInArrow(key, schema)
            .join(chosen, ["doc_id", "text_key"], "left_semi")
            .dropDuplicates(["doc_id", "text_key"])
        )
        with small_batches(docs.sparkSession):
            kept = kept.union(stage(several.select("row"), "several"))
    return kept.select("row.*")
