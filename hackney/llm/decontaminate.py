"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

A window is `window` consecutive words of an item; an item of fewer words is one window. A document
contains a window if its words stand there side by side. Containment of all of a window's words makes
any one of them necessary, so a window's prefix is a single word, its rarest by the counts over all
documents: rare words meet few windows, however frequent the others are.

1. Count the benchmark's words over all documents, and take each window's rarest word and its offset.
2. Join document words with these prefix words. Offset and lengths bound where the window would begin;
   candidates that would leave the document are dropped.
3. Join the candidates back by a hash of the text and compare the words side by side.

Documents are exploded into words only on the way into a join with the benchmark, which Spark broadcasts
when small; then nothing but matches is shuffled, and equal texts merge their matches before that. The
last join deals whole texts by their hash, and Spark can split a hash that many copies share, as the
candidates are a stored table with one row per text. A hash shared by different texts does no harm:
every candidate is verified on the text itself.

Defined results: words are runs of ASCII digits and letters, A-Z lower-cased, and of all characters
beyond ASCII. A null or empty text has no words, so it is not contaminated; `contaminated` is never
null. Items without words or without an id are no items; several rows with one item id are one item.
Null and repeated document ids are carried along, one row each. Without items nothing is hit. An empty
table of documents gives no rows. Other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import pick
from hackney.session import stage, stages_dropped

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
WINDOWS_A_FILE = 100_000


def words_of(text: Column) -> Column:
    """The words of a text in order; `lower` is used only where it means A-Z."""
    ascii_only = F.length(text) == F.octet_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    # Splitting is several times quicker than extracting all matches; empty parts stand at the ends.
    parts = F.array_remove(F.split(low, BETWEEN_WORDS), "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def item_windows(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """Distinct windows: `words`, `len` and the `items` that hold them."""
    items = (
        pick(benchmark, item_id=id_col, text=text_col)
        .where(F.col("item_id").isNotNull())
        .select(F.col("item_id").cast("string"), words_of(F.col("text")).alias("all"))
        .where(F.size("all") > 0)
        .withColumn("len", F.least(F.size("all"), F.lit(window)))
    )
    begins = F.explode(F.sequence(F.lit(0), F.size("all") - F.col("len")))
    return (
        items.select("item_id", "all", "len", begins.alias("begin"))
        .select("item_id", "len", F.slice("all", F.col("begin") + 1, F.col("len")).alias("words"))
        .groupBy("words", "len")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )


def prefix_words(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """`window, len, word, at`: each window's rarest word over all documents and its offset."""
    positions = windows.select("window", "len", F.posexplode("words").alias("at", "word"))
    vocabulary = _small(positions.select("word").distinct(), windows, "vocabulary")
    counts = (
        docs.select(F.explode("doc_words").alias("word"))
        .join(vocabulary, "word")
        .groupBy("word")
        .agg(F.count("word").alias("n"))
    )
    ranked = positions.join(stage(counts, "counts"), "word", "left")
    # A window with a word that no document has cannot occur.
    return (
        ranked.groupBy("window", "len")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("first"))
        .where(F.col("first.n") > 0)
        .select("window", "len", F.col("first.word").alias("word"), "first.at")
    )


def _small(rows: DataFrame, windows: DataFrame, label: str) -> DataFrame:
    """Staged in as few files as the number of windows asks for, so that Spark sees its true size."""
    return stage(rows.coalesce(1 + windows.count() // WINDOWS_A_FILE), label)


def find_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """`row`, a struct of all columns of `docs`, then `n_words` and the verified `hits`.

    A hit has `start`, `len` and `items`; hits are null where no prefix word is found.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{text_col}`").alias("text"))
    words = words_of(F.col("text"))
    texts = rows.select(F.xxhash64("text").alias("key"), words.alias("doc_words"))
    with stages_dropped(docs.sparkSession) as keep:
        windows = item_windows(benchmark, item_id_col, item_text_col, window)
        windows = stage(windows.withColumn("window", F.monotonically_increasing_id()), "windows")
        prefixes = _small(prefix_words(windows, texts), windows, "prefixes")
        placed = texts.select(
            "key", F.size("doc_words").alias("size"), F.posexplode("doc_words").alias("position", "word")
        ).join(prefixes, "word")
        places = (
            placed.withColumn("start", F.col("position") - F.col("at"))
            .where((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("size")))
            .select("key", "window", "start")
            .distinct()
        )
        candidates = (
            places.join(windows, "window")
            .groupBy("key")
            .agg(F.collect_list(F.struct("start", "len", "words", "items")).alias("candidates"))
        )
        found = keep(stage(candidates, "candidates"))
    joined = rows.select(
        "row", "text", F.xxhash64("text").alias("key"), F.size(words).cast("long").alias("n_words")
    ).join(found, "key", "left")

    def side_by_side(text_words: Column) -> Column:
        return F.filter(
            "candidates", lambda c: F.slice(text_words, c["start"] + 1, c["len"]) == c["words"]
        )

    # The array of one element holds the words, which else would be split again for each candidate.
    hits = F.get(F.transform(F.array(words), side_by_side), F.lit(0))
    return joined.select(
        "row", "n_words", F.when(F.col("candidates").isNotNull(), hits).alias("hits")
    )


def _verdict(share: int) -> list[Column]:
    inside = F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["len"] - 1))
    hit_words = F.coalesce(F.flatten(inside), F.array().cast("array<int>"))
    n_hit = F.size(F.array_distinct(hit_words)).cast("long")
    names = F.flatten(F.transform("hits", lambda h: h["items"]))
    items = F.array_sort(F.array_distinct(F.coalesce(names, F.array().cast("array<string>"))))
    return [
        F.col("n_words"),
        n_hit.alias("n_hit"),
        items.alias("items"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    ]


def judge(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    share: int = 20,
) -> DataFrame:
    """Per document `doc_id, n_words, n_hit, items, contaminated`.

    `n_hit` counts the words inside any occurrence; a document is contaminated if it has such words
    and they are at least one of `share` of its words.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    found = find_windows(rows, benchmark, "text", item_id_col, item_text_col, window)
    return found.select("row.doc_id", *_verdict(share))


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    share: int = 20,
) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = find_windows(docs, benchmark, text_col, item_id_col, item_text_col, window)
    return found.where(~_verdict(share)[-1]).select("row.*")
