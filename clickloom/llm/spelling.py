"""Spelling variants: words one edit apart, found in sorted lists with shared rows.

Words are the runs of letters of whole texts, with a planted slip where the contract asks for one;
they are counted per Arrow batch by numpy and added up by Spark.

Two words one edit apart have a common first half or a common second half, so every word is posted
under both (of its length, and of one letter less, for pairs of different length): lists are sorted,
those of second halves by the reversed word, and never hold pairs that are far apart from the start.
A list is scanned as a sorted vocabulary: neighbours share the rows of the banded edit matrix up to
their longest common prefix, so the row of a prefix is computed once for all words behind it, and a
range whose row exceeds one edit everywhere is skipped whole. numpy does this for all queries of
many lists at once, one letter further in each step. A list of more than ``max_list`` words is cut
into blocks by a hash and every two blocks are scanned together, so no task meets an unbounded list
and no pair is lost.

Then a word's form is its most frequent near word, if that is frequent enough, and its root the end
of the chain of forms. Frequencies grow along a chain by the factor, so a chain is short: doubling
the steps finds all roots in a few rounds.

Null and empty texts have no words. A null ``doc_id`` counts as the empty text where slips are drawn.
Repeated rows count as often as they occur. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.words import CHUNK, runs, utf8, word_hashes
from clickloom.sources.storage import materialize


@dataclass(frozen=True)
class Rules:
    min_letters: int = 5
    min_count: int = 3
    # A form occurs at least so many times as often as the word; at least 2.
    factor: int = 2
    # One of so many runs loses a letter, chosen by the crc32 of id and run.
    slip_every: int = 97
    # Words of a list that are scanned together.
    max_list: int = 50_000


# --- words ----------------------------------------------------------------------------------

# In UTF-8 the letters U+00C0 to U+00FF are this byte and one byte more; in Latin-1, which holds
# every letter of a word, they are one byte.
_WIDE = 0xC3
_TO_LATIN = 0x40
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]] = True
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)
_ALL = np.uint32(0xFFFFFFFF)
# Bytes of a stretch that numpy adds to a crc32 step by step.
_CRC_STEPS = 32

# Distinct words a task holds before it passes them on.
HELD_WORDS = 500_000


def latin(data: np.ndarray) -> np.ndarray:
    """Text in Latin-1, from UTF-8 without its lead bytes C3; any other character is zeros."""
    out = data.copy()
    out[data >= 128] = 0
    lead = data == _WIDE
    after = np.flatnonzero(lead) + 1
    out[after] = data[after] + _TO_LATIN
    return out[~lead]


def crc32_after(before: np.ndarray, data: np.ndarray, first: np.ndarray,
                length: np.ndarray) -> np.ndarray:
    """crc32 of texts, each given by its crc32 so far, when a stretch of ``data`` is added."""
    order = np.argsort(-length, kind="stable")
    at, left = first[order], length[order]
    code = before[order] ^ _ALL
    # Stretches that go on come first.
    for k in range(min(_CRC_STEPS, int(left[0]) if len(left) else 0)):
        n = np.searchsorted(-left, -k, "left")
        code[:n] = (code[:n] >> np.uint32(8)) ^ _CRC[(code[:n] ^ data[at[:n] + k]) & np.uint32(255)]
    code ^= _ALL
    for i in range(int(np.searchsorted(-left, -_CRC_STEPS, "left"))):
        code[i] = zlib.crc32(data[at[i] + _CRC_STEPS:at[i] + left[i]].tobytes(), int(code[i]))
    result = np.empty_like(code)
    result[order] = code
    return result


def _count(ids: list[str], at: np.ndarray, data: np.ndarray, rules: Rules,
           found: dict[bytes, int]) -> None:
    """Add the words, in Latin-1, of texts that begin at ``at`` in ``data``."""
    data = _LOWER[data]
    inside = _LETTER[data] & (data < 128) | (data == _WIDE)
    inside[1:] |= data[:-1] == _WIDE
    starts = at[at < len(data)]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[starts] = inside[starts]
    heads = np.flatnonzero(first)
    if not len(heads):
        return
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    lengths = np.flatnonzero(last) + 1 - heads
    text = np.searchsorted(at, heads, "right") - 1
    prefixes = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], dtype=np.uint32)
    codes = crc32_after(prefixes[text], data, heads, lengths)
    slips = codes % np.uint32(rules.slip_every) == 0
    letters = latin(data)
    place = np.concatenate([[0], np.cumsum(data != _WIDE)])
    hashes, begin = word_hashes(letters, _LETTER, place[starts])
    end = begin + place[heads + lengths] - place[heads]
    raw = letters.tobytes()
    for k in np.flatnonzero(slips).tolist():
        word = raw[begin[k]:end[k]]
        gone = int(codes[k]) % len(word)
        word = word[:gone] + word[gone + 1:]
        if len(word) >= rules.min_letters:
            found[word] = found.get(word, 0) + 1
    counted = ~slips & (end - begin >= rules.min_letters)
    begin, end = begin[counted], end[counted]
    _, one, n = np.unique(hashes[counted], return_index=True, return_counts=True)
    for low, high, times in zip(begin[one].tolist(), end[one].tolist(), n.tolist()):
        word = raw[low:high]
        found[word] = found.get(word, 0) + times


def _cuts(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of a long text of about CHUNK bytes; no word and no character is cut."""
    start = 0
    while len(data) - start > 2 * CHUNK:
        end = start + CHUNK
        while end < len(data) and (data[end] >= 128 or _LETTER[data[end]]):
            end += 1
        yield start, end
        start = end
    yield start, len(data)


def words(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``(word, n)`` of the words that occur often enough.

    Within a batch equal words are recognised by a 64-bit hash, everywhere else by themselves.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def as_batch(found: dict[bytes, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in found], pa.string()),
             pa.array(list(found.values()), pa.int64())], schema=schema)

    def count(batches):
        found: dict[bytes, int] = {}
        for batch in batches:
            ids = batch["id"].to_pylist()
            at, held = utf8(batch["text"])
            for low, high in runs(at):
                data = held[at[low]:at[high]]
                if high - low > 1:
                    _count(ids[low:high], at[low:high] - at[low], data, rules, found)
                else:
                    for start, end in _cuts(data):
                        _count(ids[low:high], np.zeros(1, np.int64), data[start:end], rules, found)
                if len(found) > HELD_WORDS:
                    yield as_batch(found)
                    found = {}
        yield as_batch(found)

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                        F.col("text").cast("string").alias("text"))
    return (texts.mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= rules.min_count))


# --- sorted lists ---------------------------------------------------------------------------

# Rows that are scanned together, bytes of their letters at most, and queries at a time.
SCAN_WORDS, SCAN_BYTES, QUERIES = 20_000, 1 << 26, 8192


def scan(letters: np.ndarray, length: np.ndarray, head: np.ndarray, shared: int,
         shorter: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words of one list that are one edit apart, as row numbers, the smaller one first.

    ``letters`` has a word per row, padded with zeros, the lists one after the other, each sorted
    and without repeats; ``head`` marks their first rows. Words of a list share ``shared`` letters
    and have ``shorter`` letters or one more; pairs of two longer words are left out.

    The banded edit matrix of a query has three cells per row: the distances of a prefix of ``d``
    letters to the query's first ``d - 1``, ``d`` and ``d + 1``. A row belongs to the range of all
    words with that prefix.
    """
    n = len(letters)
    common = np.zeros(n, dtype=np.int64)  # with the row before
    if n > 1:
        differ = letters[1:] != letters[:-1]
        common[1:] = np.where(head[1:], 0, differ.argmax(axis=1))
    begin = np.flatnonzero(head)
    list_of = np.cumsum(head) - 1
    list_end = np.append(begin[1:], n)
    # Where a new prefix of d letters begins, for every d; words that are shorter have none.
    opens = {d: np.flatnonzero((common < d) & (length >= d))
             for d in range(shared + 1, shorter + 2)}
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for low in range(0, n, QUERIES):
        query = np.arange(low, min(n, low + QUERIES))
        start, end = begin[list_of[query]], list_end[list_of[query]]
        # Every pair is found by its earlier word.
        alive = end - 1 > query
        query, start, end = query[alive], start[alive], end[alive]
        less, same, more = (np.full(len(query), v, dtype=np.int8) for v in (1, 0, 1))
        for d in range(shared + 1, shorter + 2):
            if d == shorter + 1:  # the prefix before this letter is all of the shorter word
                close = np.where(length[query] == shorter, same, more)
                hit = (length[start] == shorter) & (close <= 1) & (start > query)
                found.append((query[hit], start[hit]))
                keep = length[query] == shorter
                query, start, end = query[keep], start[keep], end[keep]
                less, same, more = less[keep], same[keep], more[keep]
            open_d = opens[d]
            one, past = np.searchsorted(open_d, start), np.searchsorted(open_d, end)
            times = past - one
            parent = np.repeat(np.arange(len(query)), times)
            child = np.arange(len(parent)) - np.repeat(np.cumsum(times) - times, times) + one[parent]
            until = np.minimum(np.append(open_d, n)[child + 1], end[parent])
            keep = until - 1 > query[parent]
            parent, child, until = parent[keep], child[keep], until[keep]
            query, start, end = query[parent], open_d[child], until
            letter = letters[start, d - 1]
            was_less, was_same, was_more = less[parent], same[parent], more[parent]
            less = np.minimum(was_less + (letter != letters[query, d - 2]), was_same + 1)
            same = np.minimum(np.minimum(was_same + (letter != letters[query, d - 1]),
                                         was_more + 1), less + 1)
            beyond = letters[query, d] if d <= shorter else np.zeros(len(query), np.uint8)
            more = np.minimum(was_more + (letter != beyond), same + 1)
            # Beyond one edit everywhere: the range is skipped with all its words.
            keep = np.minimum(np.minimum(less, same), more) <= 1
            query, start, end = query[keep], start[keep], end[keep]
            less, same, more = (np.minimum(c[keep], 2).astype(np.int8) for c in (less, same, more))
        hit = (length[start] == shorter + 1) & (less <= 1)
        found.append((query[hit], start[hit]))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (
        np.empty(0, np.int64), np.empty(0, np.int64))


def _matrix(words: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The words' letters, a row each, and their lengths."""
    at, held = utf8(words)
    data = held[at[0]:at[-1]]
    place = np.concatenate([[0], np.cumsum(data != _WIDE)])[at - at[0]]
    length = np.diff(place)
    letters = np.zeros((len(length), width), dtype=np.uint8)
    letters[np.repeat(np.arange(len(length)), length),
            np.arange(place[-1]) - np.repeat(place[:-1], length)] = latin(data)
    return letters, length


def _turned(letters: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The words' letters in reverse order."""
    at = length[:, None] - 1 - np.arange(letters.shape[1])
    return np.where(at >= 0, np.take_along_axis(letters, np.maximum(at, 0), axis=1), 0)


_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()),
                   ("best", pa.string())])


def _near_words(rows: pa.Table, backward: bool, shorter: int) -> Iterator[pa.RecordBatch]:
    """What the lists in ``rows`` say about their words: near words, and the best of them."""
    half = shorter // 2
    shared = shorter - half if backward else half
    letters, length = _matrix(rows["letters"].combine_chunks(), shorter + 1)
    blocks = [rows[c].to_numpy() for c in ("low", "high")]
    head = np.ones(len(letters), dtype=bool)
    head[1:] = (letters[1:, :shared] != letters[:-1, :shared]).any(axis=1)
    for block in blocks:
        head[1:] |= block[1:] != block[:-1]
    a, b = scan(letters, length, head, shared, shorter)
    own = rows["own"].to_numpy()
    across = (blocks[0][a] == blocks[1][a]) | (own[a] != own[b])
    forward = _turned(letters, length) if backward else letters
    if backward:  # pairs with a common first half are found in its list
        across &= (forward[a, :half] != forward[b, :half]).any(axis=1)
    a, b = a[across], b[across]
    word, near = np.concatenate([a, b]), np.concatenate([b, a])
    if not len(word):
        return
    text = np.ascontiguousarray(forward).view(f"S{shorter + 1}").ravel()
    place = np.empty(len(text), dtype=np.int64)
    place[np.argsort(text, kind="stable")] = np.arange(len(text))
    n = rows["n"].to_numpy()
    order = np.lexsort((place[near], -n[near], word))
    word, near = word[order], near[order]
    one, times = np.unique(word, return_index=True, return_counts=True)[1:]
    yield pa.RecordBatch.from_arrays(
        [pa.array([w.decode("latin-1") for w in text[word[one]].tolist()], pa.string()),
         pa.array(times), pa.array(n[near[one]]),
         pa.array([w.decode("latin-1") for w in text[near[one]].tolist()], pa.string())],
        schema=_NEAR)


def _postings(vocabulary: DataFrame, rules: Rules) -> DataFrame:
    """Every word under the first and the second half of a word of its length, or one less."""
    forms = vocabulary.select(
        F.expr("length(word)").alias("length"), "n",
        F.explode(F.array(F.struct(F.lit(False).alias("backward"), F.col("word").alias("letters")),
                          F.struct(F.lit(True).alias("backward"),
                                   F.reverse("word").alias("letters")))).alias("form"))
    posted = forms.select("form.*", "n", F.explode(F.expr(
        f"filter(array(length, length - 1), x -> x >= {rules.min_letters})")).alias("shorter"))
    return posted.withColumn("half", F.expr(
        "substring(letters, 1, if(backward, shorter - shorter div 2, shorter div 2))"))


def near_words(vocabulary: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``(word, n_near, best_n, best)`` of the words in ``(word, n)`` that have near ones."""
    posted = _postings(vocabulary, rules)
    key = ["backward", "shorter", "half"]
    long_lists = materialize(
        posted.groupBy(key).count().where(F.col("count") > rules.max_list)
        .withColumn("blocks", F.expr(f"cast(ceil(count / {rules.max_list}) as int)")).drop("count"),
        "long_lists")
    # A word of a long list meets those of its own block and of each other one.
    placed = (posted.join(long_lists, key, "left")
              .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
              .withColumn("own", F.expr("cast(pmod(xxhash64(letters), blocks) as int)"))
              .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
              .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}))
    lists = (placed.repartition(*key, "low", "high")
             .sortWithinPartitions("backward", "shorter", "low", "high", "letters")
             .select("backward", "shorter", "low", "high", "letters", "n", "own"))

    def search(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= SCAN_WORDS:
                table = pa.Table.from_batches(held).combine_chunks()
                heads = _list_heads(table)
                yield from _scanned(table.slice(0, heads[-1]), heads[:-1])
                rest = table.slice(heads[-1])
                held, rows = rest.to_batches(), rest.num_rows
        if rows:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from _scanned(table, _list_heads(table))

    found = lists.mapInArrow(search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("best_n"), "best")).alias("best")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
            .select("word", "n_near", (-F.col("best.best_n")).alias("best_n"), "best.best"))


def _list_heads(table: pa.Table) -> np.ndarray:
    """The first rows of the lists in sorted postings."""
    first = np.zeros(table.num_rows, dtype=bool)
    first[0] = True
    for name in ("backward", "shorter", "low", "high"):
        values = np.asarray(table[name].to_numpy(zero_copy_only=False))
        first[1:] |= values[1:] != values[:-1]
    half = table["shorter"].to_numpy() // 2
    shared = np.where(table["backward"].to_numpy(zero_copy_only=False),
                      table["shorter"].to_numpy() - half, half)
    texts = table["letters"].to_pylist()
    for k in np.flatnonzero(~first).tolist():
        first[k] = texts[k][:shared[k]] != texts[k - 1][:shared[k]]
    return np.flatnonzero(first)


def _scanned(table: pa.Table, heads: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Scans whole lists; those of one kind and length together, up to a number of bytes."""
    if not table.num_rows:
        return
    backward = table["backward"].to_numpy(zero_copy_only=False)[heads]
    shorter = table["shorter"].to_numpy()[heads]
    ends = np.append(heads[1:], table.num_rows)
    low = 0
    for k in range(1, len(heads) + 1):
        done = k == len(heads) or (backward[k], shorter[k]) != (backward[low], shorter[low]) or (
            (ends[k] - heads[low]) * (shorter[k] + 1) > SCAN_BYTES)
        if done:
            part = table.slice(heads[low], ends[k - 1] - heads[low])
            yield from _near_words(part, bool(backward[low]), int(shorter[low]))
            low = k


# --- forms and roots ------------------------------------------------------------------------

def with_roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the words in ``(word, form)``: the end of the chain of forms.

    Every round doubles the steps each word has gone. As frequencies double along a chain, it has
    less than 64 steps, and six rounds reach its end.
    """
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        gone = materialize(roots.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "roots")
        roots = gone.select("word", "root")
        if gone.where("moved").isEmpty():
            return roots


def variants(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of all words of ``docs`` (``doc_id, text``)."""
    vocabulary = materialize(words(docs, rules), "vocabulary")
    near = near_words(vocabulary, rules)
    enough = F.col("best_n") >= rules.factor * F.col("n")
    judged = materialize(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best")).alias("form"),
        F.when(enough, F.col("best_n")).alias("form_n")), "forms")
    roots = with_roots(judged.where("form is not null").select("word", "form"))
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
