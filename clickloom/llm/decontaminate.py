"""Benchmark decontamination with spaced seeds.

A word is a run of ASCII letters and digits and of non-ASCII bytes; case (of ASCII letters) and
punctuation do not count. Every fixed mask of ``MASKS`` hashes the words it selects from each
window and ignores the others, so a passage is found although some of its words were replaced.
Hashes of documents and benchmark are joined; around each hit the document and the item are laid
over one another, and the best stretch is taken: matching words count 1, replaced ones ``-MISMATCH``.
A document is contaminated if a stretch has at least ``min_matches`` matching words and
``min_percent`` of its words match.

Before the join, documents drop the windows whose hash is not in a bitmap of the benchmark's hashes.
The bitmap has a fixed size and no false negatives, so it only saves work. What is kept of a
document is the region around its hits, not the text.

Null and empty texts are clean. Items with fewer than ``min_matches`` words cannot be overlapped
enough and are never found. Rows that repeat a ``doc_id`` (or have none) share one result. Items
without an id are found like all others, and repeated items count once. With an
empty benchmark all documents are clean. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.words import mix, words_by_text
from clickloom.sources.storage import materialize

# Fixed masks: 1 selects a word, 0 ignores it.
MASKS = ("111010011", "1100101011", "1011000111")
MISMATCH = 2
BITS = 26
# Words kept on either side of a document's hits.
PAD = 64

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_U = np.uint64


def seeds(words: np.ndarray) -> list[np.ndarray]:
    """For each mask: the hash of every window of ``words`` it fits in."""
    found = []
    for number, mask in enumerate(MASKS):
        n = len(words) - len(mask) + 1
        if n <= 0:
            found.append(np.empty(0, dtype=np.uint64))
            continue
        code = np.full(n, number + 1, dtype=np.uint64)
        for k, one in enumerate(mask):
            if one == "1":
                code *= _U(0x9E3779B97F4A7C15)
                code += words[k:n + k]
        found.append(mix(code))
    return found


def _texts(batch: pa.RecordBatch, ids: str):
    for first, hashes, cuts in words_by_text(batch["text"], _IS_WORD):
        for k, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
            yield batch[ids][first + k], hashes[low:high]


def _items(benchmark: DataFrame) -> DataFrame:
    def cut(batches):
        for batch in batches:
            ids, words = [], []
            for item, held in _texts(batch, "item_id"):
                ids.append(item.as_py())
                words.append(held.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(words, pa.list_(pa.int64()))],
                names=["item_id", "item"])

    return benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, "item_id long, item array<long>").withColumn("key", F.expr("uuid()"))


def _item_seeds(items: DataFrame) -> DataFrame:
    def cut(batches):
        for batch in batches:
            for item, words in zip(batch["key"].to_pylist(), batch["item"]):
                held = np.array(words.values if words.is_valid else [], dtype=np.int64)
                for codes in seeds(held.view(np.uint64)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(codes.view(np.int64)),
                         pa.array(np.arange(len(codes), dtype=np.int64)),
                         pa.array([item] * len(codes), pa.string())],
                        names=["seed", "item_at", "key"])

    return items.select("key", "item").mapInArrow(cut, "seed long, item_at long, key string")


def _cells(codes: np.ndarray) -> np.ndarray:
    return (codes >> _U(64 - BITS)).astype(np.int64)


def _bitmap(item_seeds: DataFrame) -> np.ndarray:
    """One bit per cell of hashes; partitions send theirs as the cells they fill, made distinct."""
    bits = np.zeros(1 << (BITS - 3), dtype=np.uint8)
    cells = item_seeds.select(
        F.shiftrightunsigned("seed", 64 - BITS).alias("cell")).distinct()
    packed = cells.groupBy(F.shiftright("cell", 12).alias("page")).agg(
        F.collect_list((F.col("cell") % 4096).cast("int")).alias("cells"))
    for row in packed.toLocalIterator():
        at = np.array(row["cells"], dtype=np.int64) + (row["page"] << 12)
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return bits


def _regions(docs: DataFrame, bits) -> DataFrame:
    """Stretches of documents around windows that the bitmap knows, with those windows' hashes."""
    longest = max(map(len, MASKS))

    def search(batches):
        held = bits.value
        for batch in batches:
            rows = []
            for doc, words in _texts(batch, "doc_id"):
                at, codes = [], []
                for found in seeds(words):
                    cells = _cells(found)
                    hit = np.flatnonzero((held[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1)
                    at.append(hit)
                    codes.append(found[hit])
                at, codes = np.concatenate(at), np.concatenate(codes)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, codes = at[order], codes[order]
                cuts = np.flatnonzero(np.diff(at) > PAD) + 1
                for a, c in zip(np.split(at, cuts), np.split(codes, cuts)):
                    low = max(0, int(a[0]) - PAD)
                    rows.append((doc.as_py(), low, words[low:int(a[-1]) + longest + PAD]
                                 .view(np.int64), a, c.view(np.int64)))
            columns = list(zip(*rows)) or [()] * 5
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    columns, (pa.int64(), pa.int64(), longs, longs, longs))],
                names=["doc_id", "start", "words", "at", "seeds"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        search, "doc_id long, start long, words array<long>, at array<long>, seeds array<long>")


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """Start, end and matches of the stretch with the highest score, the first of equal ones."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -MISMATCH))])
    gain = total - np.minimum.accumulate(total)
    end = int(np.argmax(gain))
    start = int(np.argmin(total[:end + 1]))
    return start, end, int(equal[start:end].sum())


def overlaps(docs: DataFrame, benchmark: DataFrame, min_matches: int = 12,
             min_percent: int = 80) -> DataFrame:
    """``(doc_id, item_id, matches, length, doc_word, item_word)``: the verified overlaps."""
    spark = docs.sparkSession
    items = materialize(_items(benchmark), "items")
    item_seeds = materialize(_item_seeds(items), "seeds")
    bits = spark.sparkContext.broadcast(_bitmap(item_seeds))
    regions = materialize(_regions(docs, bits).withColumn(
        "region", F.expr("uuid()")), "regions")
    hits = regions.select("region", F.explode(F.arrays_zip("at", "seeds")).alias("hit")).select(
        "region", F.col("hit.at").alias("at"), F.col("hit.seeds").alias("seed"))
    aligned = (hits.join(item_seeds, "seed")
               .select("region", "key", (F.col("at") - F.col("item_at")).alias("shift"))
               .distinct())

    def verify(batches):
        for batch in batches:
            rows = []
            for doc, item_id, shift, start, words, item in zip(
                    *(batch[c].to_pylist() for c in ("doc_id", "item_id", "shift", "start")),
                    batch["words"], batch["item"]):
                one, two = np.asarray(words.values), np.asarray(item.values)
                # The item's first word would stand at this place of the region.
                place = shift - start
                low, high = max(0, -place), min(len(two), len(one) - place)
                equal = one[low + place:high + place] == two[low:high]
                a, b, matches = best_stretch(equal)
                if matches >= min_matches and 100 * matches >= min_percent * (b - a):
                    rows.append((doc, item_id, matches, b - a, low + a + shift, low + a))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "item_id", "matches", "length", "doc_word", "item_word"])

    return (aligned.join(regions.select("region", "doc_id", "start", "words"), "region")
            .join(items, "key")
            .select("doc_id", "item_id", "shift", "start", "words", "item")
            .mapInArrow(verify, "doc_id long, item_id long, matches long, length long,"
                                " doc_word long, item_word long"))


def contamination(docs: DataFrame, benchmark: DataFrame, min_matches: int = 12,
                  min_percent: int = 80) -> DataFrame:
    """Per row of ``docs``: ``doc_id, contaminated, n_items, item_id, matches``: of the largest
    overlap (the smallest item of equal ones); null and 0 for clean documents."""
    found = overlaps(docs, benchmark, min_matches, min_percent).groupBy("doc_id").agg(
        F.count_distinct(F.struct("item_id")).alias("n_items"),
        F.max(F.struct("matches", (-F.col("item_id")).alias("item"))).alias("top"))
    found = found.select(F.col("doc_id").alias("_doc"), "n_items",
                         (-F.col("top.item")).alias("item_id"), F.col("top.matches"))
    ids = docs.select(F.col("doc_id").cast("long"))
    return ids.join(found, ids["doc_id"].eqNullSafe(found["_doc"]), "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"), "item_id",
        F.coalesce("matches", F.lit(0)).alias("matches"))
