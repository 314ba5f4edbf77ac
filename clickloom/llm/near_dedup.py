"""Near-duplicate documents: MinHash signatures, searched by a signature-coordinate inverted join.

A document is posted under each (coordinate, value) pair of its signature. Two documents whose sets
overlap by the threshold agree on at least ``Sizes.matches`` of the coordinates but for about one
pair in a million that lies right at the threshold. As in prefix and skip merging, the longest
posting lists are skipped: a document searches by the ``coordinates - matches + 1`` rarest of its
pairs only, since two documents that agree on ``matches`` pairs share one of those.

A posting list is never expanded into pairs. Its most central document leads it, and:

1. every other document of the list is compared with the leader, on full shingle sets;
2. documents that are not linked with their leader ("strays") are compared with all documents of
   the same leader, block by block, on full sets; a block returns only links that join two of its
   parts. Two documents of one list have the same leader, so no link is lost.

Texts with equal sets are one document throughout. The longest of the steps grows with strays times
group size, in blocks of bounded size; groups of near copies of one text have few strays, as their
leader is the text they stem from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.components import components
from clickloom.llm.words import mix, shingle_codes, words_by_text
from clickloom.sources.storage import materialize

# Shingles of a block's documents, and documents of a block.
BLOCK_SHINGLES = 1 << 20
BLOCK_DOCS = 512
# Up to so many ids (8 bytes each) go to every executor, so that the texts they stand for need no
# exchange; more are joined by exchanging both sides.
BROADCAST_IDS = 2_000_000


@dataclass(frozen=True)
class Sizes:
    """``percent``: link if 100 * intersection >= percent * union. ``matches``: of coordinates."""

    width: int = 5
    percent: int = 80
    coordinates: int = 64
    matches: int = 33

    @property
    def prefix(self) -> int:
        return self.coordinates - self.matches + 1


def _signature(codes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The smallest value of each coordinate's hash, marked with the coordinate."""
    low = np.full(len(keys), ~np.uint64(0), dtype=np.uint64)
    for at in range(0, len(codes), 2048):
        part = codes[at:at + 2048]
        values = (part[None, :] ^ keys[:, None]) * (keys[:, None] | np.uint64(1))
        np.minimum(low, values.min(axis=1), out=low)
    return mix(low + keys * np.uint64(3))


def _keys(n: int) -> np.ndarray:
    return mix(np.arange(1001, 1001 + n, dtype=np.uint64))


def signatures(docs: DataFrame, sizes: Sizes) -> DataFrame:
    """Per row: the size of its set, two hashes of the set, and the posting keys (none if empty)."""

    def sign(batches):
        keys = _keys(sizes.coordinates)
        for batch in batches:
            ids = batch["doc_id"]
            for first, hashes, cuts in words_by_text(batch["text"]):
                n, one, two, posted = [], [], [], []
                for low, high in zip(cuts[:-1], cuts[1:]):
                    codes = shingle_codes(hashes[low:high], sizes.width)
                    n.append(len(codes))
                    one.append(int(mix(codes).sum(dtype=np.uint64).view(np.int64)))
                    two.append(int(mix(codes ^ keys[0]).sum(dtype=np.uint64).view(np.int64)))
                    posted.append(_signature(codes, keys).view(np.int64) if len(codes)
                                  else np.empty(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(n)), pa.array(n, pa.int64()), pa.array(one, pa.int64()),
                     pa.array(two, pa.int64()), pa.array(posted, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "set_1", "set_2", "posted"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        sign, "doc_id long, n_shingles long, set_1 long, set_2 long, posted array<long>")


def _candidates(sets: DataFrame, sizes: Sizes) -> DataFrame:
    """``(a, leader)``: each document and the leaders of the posting lists of its prefix."""
    posts = sets.select("rep", F.explode("posted").alias("post"))
    lengths = posts.groupBy("post").agg(F.count("*").alias("n")).where("n > 1")
    # Lists of one are skipped, and stand first in the prefix.
    shared = (posts.join(lengths, "post").groupBy("rep")
              .agg(F.sort_array(F.collect_list(F.struct("n", "post"))).alias("posted"),
                   F.sum("n").alias("centre")))
    room = F.lit(sizes.prefix - sizes.coordinates) + F.size("posted")
    prefix = materialize(
        shared.withColumn("room", room).where("room > 0")
        .select("rep", "centre", F.explode(F.slice("posted", F.lit(1), F.col("room"))).alias("p"))
        .select("rep", "centre", "p.post"), "prefix")
    leaders = (prefix.groupBy("post")
               .agg(F.max(F.struct("centre", (-F.col("rep")).alias("r"))).alias("top"),
                    F.count("*").alias("m")).where("m > 1")
               .select("post", (-F.col("top.r")).alias("leader")))
    return (prefix.join(leaders, "post").where("rep <> leader")
            .groupBy(F.col("rep").alias("a"), "leader").agg(F.count("*").alias("lists")))


def _shared(one: np.ndarray, two: np.ndarray) -> int:
    """Size of the intersection of two sets."""
    if len(one) > len(two):
        one, two = two, one
    at = np.searchsorted(two, one)
    at[at == len(two)] = len(two) - 1
    return int((two[at] == one).sum())


def _linked(shared, n_one, n_two, percent: int):
    return 100 * shared >= percent * (n_one + n_two - shared)


def _sets_of(texts: pa.Array, width: int) -> list[np.ndarray]:
    return [shingle_codes(hashes[low:high], width) for _, hashes, cuts in words_by_text(texts)
            for low, high in zip(cuts[:-1], cuts[1:])]


def _verified(pairs: DataFrame, texts: DataFrame, sizes: Sizes) -> DataFrame:
    """``(a, leader, linked)``: the comparison on full sets."""

    def compare(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                one = _sets_of(part["text"], sizes.width)
                # Rows of one leader come in a row, sharing its set.
                other = part["leader_text"].dictionary_encode()
                two = _sets_of(other.dictionary, sizes.width)
                linked = [_linked(_shared(x, two[k]), len(x), len(two[k]), sizes.percent)
                          for x, k in zip(one, other.indices.to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part["a"], part["leader"], pa.array(linked, pa.bool_())],
                    names=["a", "leader", "linked"])

    led = texts.select(F.col("rep").alias("leader"), F.col("text").alias("leader_text"))
    joined = (pairs.select("a", "leader")
              .join(texts.select(F.col("rep").alias("a"), "text"), "a").join(led, "leader")
              .select("a", "leader", "text", "leader_text"))
    return joined.mapInArrow(compare, "a long, leader long, linked boolean")


class _Forest:
    """Union-find over the documents of a block."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def overlaps(rows: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of the row sets with the column sets."""
    codes = np.concatenate([*rows, *columns])
    owner = np.repeat(np.arange(len(rows) + len(columns)), [len(x) for x in [*rows, *columns]])
    _, place, seen = np.unique(codes, return_inverse=True, return_counts=True)
    keep = seen[place] > 1
    owner, place = owner[keep], np.unique(place[keep], return_inverse=True)[1]
    found = np.zeros((len(rows), len(columns)), dtype=np.float32)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    top = int(place[-1]) + 1 if len(place) else 0
    for low in range(0, top, 2048):
        a, b = np.searchsorted(place, [low, low + 2048])
        held = np.zeros((len(rows) + len(columns), 2048), dtype=np.float32)
        held[owner[a:b], place[a:b] - low] = 1
        found += held[:len(rows)] @ held[len(rows):].T
    return found.astype(np.int64)


def _strays_linked(pairs: DataFrame, texts: DataFrame, sizes: Sizes) -> DataFrame:
    """Links between strays and the other documents of their leader, as far as they join parts.

    A group is cut into blocks by hash; a task compares one block of strays with one block of
    documents at a time. Each stray is sent to every block of documents, and the reverse.
    """
    weighed = pairs.join(texts.select(F.col("rep").alias("a"), "n_shingles"), "a")
    blocks = (weighed.groupBy("leader").agg(
        F.count("*").alias("m"), F.sum("n_shingles").alias("w"),
        F.count_if(~F.col("linked")).alias("s"),
        F.sum(F.when(F.col("linked"), 0).otherwise(F.col("n_shingles"))).alias("sw"))
        .where("s > 0 and m > 1")
        .select("leader", *[
            F.greatest(F.ceil(F.col(n) / BLOCK_DOCS), F.ceil(F.col(w) / BLOCK_SHINGLES))
            .cast("int").alias(name) for n, w, name in (("m", "w", "mb"), ("s", "sw", "sb"))]))
    members = (weighed.drop("n_shingles").join(blocks, "leader")
               .withColumn("hash", F.xxhash64("a")))
    own_m = F.pmod("hash", F.col("mb")).cast("int")
    own_s = F.pmod(F.shiftright("hash", 20), F.col("sb")).cast("int")
    all_s = F.sequence(F.lit(0), F.col("sb") - 1)
    all_m = F.sequence(F.lit(0), F.col("mb") - 1)
    as_member = members.select("leader", "a", F.lit(False).alias("stray"), own_m.alias("m"),
                               F.explode(all_s).alias("s"))
    as_stray = members.where(~F.col("linked")).select(
        "leader", "a", F.lit(True).alias("stray"), F.explode(all_m).alias("m"), own_s.alias("s"))
    sent = (as_member.union(as_stray)
            .join(texts.select(F.col("rep").alias("a"), "text"), "a")
            .select("leader", "m", "s", "stray", "a", "text")
            .repartition("leader", "m", "s").sortWithinPartitions("leader", "m", "s"))

    def compare(batches):
        held, key = [], None
        for batch in batches:
            keys = list(zip(*(batch[c].to_pylist() for c in ("leader", "m", "s"))))
            start = 0
            for k in range(1, len(keys) + 1):
                if k == len(keys) or keys[k] != keys[start]:
                    if key is not None and keys[start] != key:
                        yield from _block_links(held, sizes)
                        held = []
                    key = keys[start]
                    held.append(batch.slice(start, k - start))
                    start = k
        if held:
            yield from _block_links(held, sizes)

    return sent.mapInArrow(compare, "a long, b long")


def _block_links(parts: list[pa.RecordBatch], sizes: Sizes):
    table = pa.Table.from_batches(parts)
    stray = np.array(table["stray"].to_pylist(), dtype=bool)
    ids = table["a"].to_pylist()
    sets = _sets_of(table["text"], sizes.width)
    rows, columns = np.flatnonzero(stray), np.flatnonzero(~stray)
    if not len(rows) or not len(columns):
        return
    n = np.array([len(x) for x in sets])
    shared = overlaps([sets[k] for k in rows], [sets[k] for k in columns])
    linked = _linked(shared, n[rows][:, None], n[columns][None, :], sizes.percent)
    number = {x: k for k, x in enumerate(dict.fromkeys(ids))}
    forest, links = _Forest(len(number)), []
    for i, j in np.argwhere(linked):
        a, b = ids[rows[i]], ids[columns[j]]
        if a != b and forest.join(number[a], number[b]):
            links.append((a, b))
    if links:
        a, b = zip(*links)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                         names=["a", "b"])


def near_duplicates(docs: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest ``doc_id`` reachable by links, and ``kept`` marks the document
    that has it. Texts that are null or without words are empty sets, which link with nothing.
    Rows that repeat a ``doc_id`` share its fate; rows whose ``doc_id`` is null are on their own
    and kept. Other columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    signed = materialize(signatures(docs, sizes), "signatures")
    members = signed.where("n_shingles > 0 and doc_id is not null")
    sets = materialize(members.groupBy("set_1", "set_2", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.first("posted").alias("posted")), "sets")
    pairs = materialize(_candidates(sets.select("rep", "posted"), sizes), "candidates")
    searched = (pairs.select(F.col("a").alias("rep")).union(pairs.select("leader")).distinct())
    searched = materialize(searched, "searched")
    if searched.count() <= BROADCAST_IDS:
        searched = F.broadcast(searched)
    texts = materialize(
        docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string"))
        .join(searched, "rep").join(sets.select("rep", "n_shingles"), "rep")
        .select("rep", "text", "n_shingles"), "texts")
    checked = materialize(_verified(pairs, texts, sizes), "checked")
    strays = _strays_linked(checked, texts, sizes)
    links = checked.where("linked").select("a", F.col("leader").alias("b")).union(strays)
    found = components(links)
    of_set = (sets.join(found, sets["rep"] == found["node"], "left")
              .select("set_1", "set_2", "n_shingles",
                      F.coalesce("component", "rep").alias("component_id")))
    keys = ["set_1", "set_2", "n_shingles"]
    own = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(own, F.col("doc_id")))
    return (signed.drop("posted").join(of_set, keys, "left")
            .select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"),
                                           F.lit(True))))
