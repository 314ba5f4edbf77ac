"""Best-fit packing of tokenised documents, after Martello and Toth's dominance reduction.

Sizes are whole numbers up to the sequence length, so an instance is a histogram of at most that
many rows, however many documents there are. Only the histogram meets in one place. It is packed as
patterns (these sizes together, so many times over); then every piece finds its pattern by the rank
it has among the pieces of its size. Ranks are counted in hashed buckets, so no size, however
common, is ordered by one task.

The reduction looks at each size, the largest first: if the best partner (or none, or a pair) to
share a sequence with it is at least as good as every other set that fits beside it, that sequence
is fixed for good and leaves the instance. What is left is packed best fit, decreasing.
"""

from __future__ import annotations

import functools
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.sources.storage import materialize

MAX_TOKENS = 4096
END_ID = 1
# Ranks of a size are counted in so many buckets.
BUCKETS = 512
# Distinct words a task remembers the ids of; beyond it, it starts over.
CACHE_WORDS = 800_000
# Characters split into words at a time, of one text or of several.
SLICE = 1 << 20
# Plain words that are tokenised as one run.
RUN_WORDS = 256
# Punctuation that starts a piece of its own after a letter or digit, and ends no special token.
_TAIL = ".,;:!?*#$%&|"
_GAP = re.compile(r"[ \t\n\r]+")

Pattern = tuple[int, tuple[int, ...]]  # how often; the sizes, in order of their places


# --- tokens ---------------------------------------------------------------------------------

@functools.cache
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordTokens:
    """Token ids as little-endian 32-bit bytes, word by word.

    The vocabulary's pieces never span white space, so the ids of a text are those of its words
    put together. Only spaces, tabs and line ends cut here; other white space is the tokenizer's.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.held: dict[str, bytes] = {"": b""}
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends_word[[i for piece, i in self.tokenizer.get_vocab().items()
                        if piece.endswith("</w>")]] = True

    def _slices(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > SLICE:
            gap = _GAP.search(text, start + SLICE)
            end = gap.start() if gap else len(text)
            yield text[start:end]
            start = end
        yield text[start:]

    def _learn(self, words: list[str]) -> None:
        """Ids of new words; a stem and the punctuation behind it are looked up apart."""
        parts = {}
        for word in words:
            stem = word.rstrip(_TAIL)
            if not stem or not stem[-1].isalnum() or stem[-1] == "\u0130":
                stem = word
            # A special token has a case of its own, and no other script's is safe to fold.
            low = stem.lower() if "<" not in stem and stem.isascii() else stem
            parts[word] = low, word[len(stem):]
        new = {x for pair in parts.values() for x in pair if x not in self.held}
        plain = [x for x in new if x.isalpha()]
        runs = [plain[k:k + RUN_WORDS] for k in range(0, len(plain), RUN_WORDS)]
        for run, got in zip(runs, self.tokenizer.encode_batch_fast(
                [" ".join(run) for run in runs], add_special_tokens=False)):
            ids = np.array(got.ids, dtype="<u4")
            ends = 4 * (np.flatnonzero(self.ends_word[ids]) + 1)
            if len(ends) == len(run):  # letters alone are one run, closed by one word end
                held, start = ids.tobytes(), 0
                for word, end in zip(run, ends.tolist()):
                    self.held[word] = held[start:end]
                    start = end
        rest = [x for x in new if x not in self.held]
        for word, got in zip(rest, self.tokenizer.encode_batch_fast(
                rest, add_special_tokens=False)):
            self.held[word] = np.array(got.ids, dtype="<u4").tobytes()
        for word, (stem, tail) in parts.items():
            self.held[word] = self.held[stem] + self.held[tail]

    def _know(self, split: list[list[str]]) -> None:
        new = set().union(*split).difference(self.held)
        if new:
            if len(self.held) + len(new) > CACHE_WORDS:
                self.held = {"": b""}
                new = set().union(*split) - {""}
            self._learn(list(new))

    def of_texts(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of one text after the other; new words of short texts are learned together."""
        split: list[list[str]] = []  # words of each slice
        last: list[bool] = []  # whether it is the last one of its text
        done: list[bytes] = []  # what there is of a text that goes on
        size = 0

        def joined():
            self._know(split)
            for words, ends in zip(split, last):
                done.append(b"".join(map(self.held.__getitem__, words)))
                if ends:
                    yield b"".join(done)
                    done.clear()
            split.clear()
            last.clear()

        for text in texts:
            for part in self._slices(text):
                split.append(part.replace("\n", " ").replace("\t", " ").replace("\r", " ")
                             .split(" "))
                last.append(False)
                size += len(part)
                if size >= SLICE:
                    yield from joined()
                    size = 0
            if last:
                last[-1] = True
            else:
                yield b"".join(done)
                done.clear()
        yield from joined()

    def ids(self, text: str) -> bytes:
        return next(self.of_texts([text]))


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                     ("length", pa.int64()), ("ids_crc32", pa.int64())])


def token_pieces(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS,
                 end_id: int = END_ID) -> DataFrame:
    """A row per piece of at most ``max_tokens`` ids; null text is empty, so one end id."""
    end = np.array([end_id], dtype="<u4").tobytes()
    width = 4 * max_tokens

    def cut(batches):
        tokens = WordTokens(tokenizer)
        for batch in batches:
            rows = []
            texts = (text.as_py() or "" for text in batch["text"])
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), tokens.of_texts(texts)):
                ids += end
                for k, at in enumerate(range(0, len(ids), width)):
                    piece = ids[at:at + width]
                    rows.append((doc_id, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
            columns = list(zip(*rows)) or [()] * len(_PIECES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


# --- the instance ---------------------------------------------------------------------------

def reduce_by_dominance(counts: dict[int, int], size: int) -> tuple[list[Pattern], dict[int, int]]:
    """Sequences that can be fixed without loss, and what remains of the instance."""
    left = {s: n for s, n in counts.items() if n > 0}
    fixed: list[Pattern] = []
    changed = True
    while changed and left:
        changed = False
        for big in sorted(left, reverse=True):
            while left.get(big):
                times, sizes = _dominating(left, big, size)
                if not times:
                    break
                fixed.append((times, sizes))
                for s in sizes:
                    left[s] -= times
                    if not left[s]:
                        del left[s]
                changed = True
    return fixed, left


def _dominating(left: dict[int, int], big: int, size: int) -> tuple[int, tuple[int, ...]]:
    """How often a set with ``big`` is at least as good as any other one; 0 if not known."""
    left = {**left, big: left[big] - 1}
    others = sorted(s for s, n in left.items() if n and s <= size - big)
    room = size - big
    if not others:
        return left[big] + 1, (big,)
    best = others[-1]
    # The smallest sizes with their copies, at most three.
    low = [s for s in others[:3] for _ in range(min(3, left[s]))][:3]

    def often(*sizes: int) -> int:
        return min((left[s] + (s == big)) // sizes.count(s) for s in sizes)

    if best == room or len(low) < 2 or low[0] + low[1] > room:
        return often(big, best), (big, best)
    if len(low) == 3 and sum(low) <= room:
        return 0, ()
    # At most two more fit. Take the largest, then the largest beside it: this is as good as
    # any pair if no pair has a smaller member above that second one.
    after = {**left, best: left[best] - 1}
    seconds = [s for s in others if after[s] and s <= room - best]
    if not seconds:
        return 0, ()
    second = seconds[-1]
    smaller = max((s for k, s in enumerate(others)
                   if (left[s] > 1 and 2 * s <= room)
                   or (k + 1 < len(others) and s + others[k + 1] <= room)), default=0)
    if smaller > second:
        return 0, ()
    # One round at a time: another copy may see other neighbours.
    return 1, (big, best, second)


def best_fit_decreasing(counts: dict[int, int], size: int) -> list[Pattern]:
    """Best fit over runs of equal sequences: each step treats all of one kind alike."""
    kinds: dict[int, dict[tuple[int, ...], int]] = {}
    rooms: list[int] = []

    def put(room: int, sizes: tuple[int, ...], times: int) -> None:
        if room not in kinds:
            kinds[room] = {}
            insort(rooms, room)
        kinds[room][sizes] = kinds[room].get(sizes, 0) + times

    def take(room: int, times: int) -> tuple[int, tuple[int, ...]]:
        sizes, held = next(iter(kinds[room].items()))
        used = min(times, held)
        if used == held:
            del kinds[room][sizes]
            if not kinds[room]:
                del kinds[room]
                rooms.pop(bisect_left(rooms, room))
        else:
            kinds[room][sizes] = held - used
        return used, sizes

    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            at = bisect_left(rooms, s)
            if at < len(rooms):
                room = rooms[at]
                each = min(room // s, n)
                used, sizes = take(room, n // each)
            else:
                room, sizes = size, ()
                each = min(size // s, n)
                used = n // each
            put(room - each * s, sizes + (s,) * each, used)
            n -= used * each
    return [(times, sizes) for held in kinds.values() for sizes, times in held.items()]


def plan(counts: dict[int, int], size: int) -> list[Pattern]:
    """Patterns that hold every piece of the histogram once."""
    fixed, left = reduce_by_dominance(counts, size)
    merged: dict[tuple[int, ...], int] = {}
    for times, sizes in [*fixed, *best_fit_decreasing(left, size)]:
        merged[sizes] = merged.get(sizes, 0) + times
    return [(times, sizes) for sizes, times in merged.items()]


def _places(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """For each pattern and size: which ranks of the size it takes, and where they go."""
    rows, taken, sequence = [], {}, 0
    for times, sizes in patterns:
        offset = 0
        for s in dict.fromkeys(sizes):
            each = sizes.count(s)
            first = taken.get(s, 0)
            rows.append((s, first, each, sequence, offset))
            taken[s] = first + each * times
            offset += each * s
        sequence += times
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("size", "first", "each", "sequence", "offset"), columns))


# --- the packing ----------------------------------------------------------------------------

def with_ranks(pieces: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``rank`` of every piece among those of its length, from 0 without gaps."""
    hashed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = (hashed.groupBy("length", "bucket").count()
              .withColumn("before", F.sum("count").over(
                  Window.partitionBy("length").orderBy("bucket")) - F.col("count")))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(
        "doc_id", "piece", "ids_crc32")) - 1
    return (hashed.withColumn("inside", inside)
            .join(before.select("length", "bucket", "before"), ["length", "bucket"])
            .withColumn("rank", F.col("before") + F.col("inside"))
            .drop("bucket", "before", "inside"))


def pack(pieces: DataFrame, size: int = MAX_TOKENS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; an empty table stays empty."""
    histogram = {row["length"]: row["count"]
                 for row in pieces.groupBy("length").count().toLocalIterator()}
    spark = pieces.sparkSession
    places = spark.sparkContext.broadcast(_places(plan(histogram, size)))

    def assign(batches):
        held = places.value
        sizes = held["size"]
        for batch in batches:
            length = batch["length"].to_numpy()
            rank = batch["rank"].to_numpy()
            at = np.empty(len(length), dtype=np.int64)
            for one in np.unique(length):
                low, high = np.searchsorted(sizes, [one, one + 1])
                rows = length == one
                at[rows] = low + np.searchsorted(held["first"][low:high], rank[rows],
                                                 "right") - 1
            turn = rank - held["first"][at]
            each = held["each"][at]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in _PIECES.names),
                 pa.array(held["sequence"][at] + turn // each),
                 pa.array(held["offset"][at] + turn % each * length)],
                names=[*_PIECES.names, "sequence_id", "offset"])

    return with_ranks(pieces).select(*_PIECES.names, "rank").mapInArrow(
        assign, "doc_id long, piece int, start long, length long, ids_crc32 long,"
        " sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS,
                   end_id: int = END_ID) -> DataFrame:
    """One row per piece of every document with its place in a sequence.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Null and empty texts are
    one end id. Repeated rows are packed as often as they occur; a null ``doc_id`` stays null.
    """
    pieces = materialize(token_pieces(docs, tokenizer, max_tokens, end_id), "pieces")
    return pack(pieces, max_tokens)
