"""Spelling variants, collocations and shards: brute force, odd rows, and the exact ways for long lists."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import collocations, sharding, spelling
from clickloom.llm.bitmaps import bitmap, holds

ODD = [(1, None), (2, ""), (3, " \n\t . ,"), (None, "words without id words"), (None, None), (4, "x" * 70_000)]


# --- spelling -------------------------------------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(texts, rules):
    n = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if code % rules.slip_every == 0:
                at = code % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= rules.min_letters and k >= rules.min_count}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= rules.factor * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, n[w], len(near[w]), form[w], n.get(form[w]), root(w)) for w in n}


def spelled(docs, texts, rules):
    found = spelling.variants(docs(texts, "word", "n"), rules).collect()
    assert len(found) == len({r.word for r in found})
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in found}


def random_texts(rng, n):
    """Few letters, so that many words are near; some words are frequent, some beyond ASCII."""
    stems = ["".join(rng.choice("abé×") for _ in range(rng.randrange(4, 10))) for _ in range(60)]
    return [(k, " ".join(rng.choices(stems, [1 / (1 + i) for i in range(60)], k=40)).replace(
        "a", rng.choice("aaA"))) for k in range(n)]


@pytest.mark.parametrize("max_list", [50_000, 7])
def test_spelling_equals_brute_force(docs, max_list):
    rules = spelling.Rules(min_count=2, slip_every=5, max_list=max_list)
    texts = random_texts(random.Random(5), 60) + ODD + [(7, "Straße strasse"), (7, "Straße strasse")]
    texts += [(k, "zzzzz " * 16 + "zzzzy " * 7 + "zzzxy " * 3) for k in range(3)]  # a chain
    want = brute_variants(texts, rules)
    assert len({w[3] for w in want}) > 5 and any(w[3] and w[5] != w[3] for w in want)
    assert spelled(docs, texts, rules) == want


def test_long_runs_and_long_texts_are_whole(docs, monkeypatch):
    monkeypatch.setattr(spelling, "CHUNK", 1000)
    rng = random.Random(1)
    long = " ".join(rng.choices(["alpha", "alphe", "béta" * 30, "gamma-delta", "ONE"], k=2000))
    data = np.frombuffer(long.encode(), np.uint8)
    cuts = list(spelling._cuts(data))
    assert len(cuts) > 5 and b"".join(data[a:b].tobytes() for a, b in cuts) == long.encode()
    texts = [(1, long), (2, "x" * 5000), (3, "x" * 5000), (4, "x" * 4999 + "y")] * 2
    rules = spelling.Rules(min_count=2)
    assert spelled(docs, texts, rules) == brute_variants(texts, rules)


def test_crc32_goes_on_from_a_prefix():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    first = rng.integers(0, 4000, 300)
    length = rng.integers(1, 90, 300)
    before = rng.integers(0, 1 << 32, 300).astype(np.uint32)
    found = spelling.crc32_after(before, data, first, length)
    assert found.tolist() == [zlib.crc32(data[a:a + n].tobytes(), int(b))
                              for a, n, b in zip(first, length, before)]


@pytest.mark.parametrize("queries", [8192, 3])
def test_scan_of_sorted_lists(monkeypatch, queries):
    monkeypatch.setattr(spelling, "QUERIES", queries)
    rng = random.Random(8)
    for shorter, shared in ((5, 2), (6, 3), (9, 5)):
        words = sorted({"".join(rng.choice("ab") for _ in range(rng.choice([shorter, shorter + 1])))
                        for _ in range(80)})
        letters = np.zeros((len(words), shorter + 1), np.uint8)
        for k, w in enumerate(words):
            letters[k, :len(w)] = list(w.encode())
        head = np.array([k == 0 or w[:shared] != words[k - 1][:shared] for k, w in enumerate(words)])
        a, b = spelling.scan(letters, np.array(list(map(len, words))), head, shared, shorter)
        want = {(i, j) for i, j in itertools.combinations(range(len(words)), 2)
                if words[i][:shared] == words[j][:shared] and one_edit(words[i], words[j])
                and min(len(words[i]), len(words[j])) == shorter}
        assert sorted(zip(a.tolist(), b.tolist())) == sorted(want) and want


def test_spelling_of_nothing(docs):
    assert spelling.variants(docs([])).count() == 0
    assert spelling.variants(docs(ODD)).count() == 0


# --- collocations ---------------------------------------------------------------------------

def brute_collocations(texts, rules):
    found = []
    for lang in {t[2] or "und" for t in texts}:
        f = Counter()
        for _, text, of in texts:
            if (of or "und") != lang:
                continue
            low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
            for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
                words = [w for w in re.split("[ \t]+", piece) if w]
                for size in range(1, 5):
                    for k in range(len(words) - size + 1):
                        f[tuple(words[k:k + size])] += 1
        total = sum(n for p, n in f.items() if len(p) == 1)
        every = {p: n for p, n in f.items() if len(p) > 1 and n >= rules.min_count}
        rows = []
        for p, a in every.items():
            inside = any(len(q) > len(p) and 100 * n >= rules.inside_percent * a
                         and any(q[k:k + len(p)] == p for k in range(len(q)))
                         for q, n in every.items())
            if not inside:
                score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                     for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:rules.top], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, total, -score))
    return sorted(found)


def collocated(docs, texts, rules):
    return sorted(tuple(r) for r in collocations.collocations(docs(texts, "phrase", "n"), rules)
                  .select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def worded(rng, n, lang):
    names = [f"W{k}é" if k % 3 == 0 else f"w{k}" for k in range(12)]
    fixed = [" ".join(rng.choices(names, k=rng.randrange(2, 6))) for _ in range(8)]
    return [(k, " ".join(rng.choice([*fixed, *names]) + rng.choice(["", "", ",", ".\n", "\t"])
                         for _ in range(rng.randrange(12))), lang) for k in range(n)]


@pytest.mark.parametrize("rules", [
    collocations.Rules(min_count=3, top=10, widen=1), collocations.Rules(min_count=3, top=25),
    collocations.Rules(min_count=2, top=4, widen=2, inside_percent=50),
    collocations.Rules(min_count=3)])
def test_collocations_equal_brute_force(docs, rules):
    rng = random.Random(11)
    texts = worded(rng, 60, "en") + worded(rng, 40, None) + [(*r, "xx") for r in ODD]
    texts += [(9, "same same same same same, same same", "re")] * 2
    assert collocated(docs, texts, rules) == brute_collocations(texts, rules)


def test_the_frontier_grows_until_the_list_is_settled(docs, monkeypatch):
    """With one place a round, low-scoring phrases come into the list in later rounds."""
    rounds = []
    expand = collocations._Frontier.expand
    monkeypatch.setattr(collocations._Frontier, "expand",
                        lambda self, phrases: (rounds.append(self.size), expand(self, phrases)))
    monkeypatch.setattr(collocations, "_thresholds", lambda pairs, places: pairs.groupBy("lang").agg(
        F.greatest(F.lit(0), F.max("score") - F.lit(500 * places)).alias("theta")))
    texts = worded(random.Random(3), 80, "en")
    rules = collocations.Rules(min_count=2, top=40, widen=2)
    assert collocated(docs, texts, rules) == brute_collocations(texts, rules)
    assert rounds.count(2) > 1 and rounds.count(3) == rounds.count(2)


def test_full_bitmaps_change_nothing(docs, monkeypatch):
    monkeypatch.setattr(collocations, "bitmap", lambda codes, code: bitmap(codes, code, 16)
                        | np.uint8(0x55))
    monkeypatch.setattr(collocations, "HELD_PHRASES", 50)
    texts = worded(random.Random(4), 50, "en")
    rules = collocations.Rules(min_count=3, top=20)
    assert collocated(docs, texts, rules) == brute_collocations(texts, rules)


def test_long_pieces_are_whole(docs, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 200)
    texts = [(1, " ".join(t[1] for t in worded(random.Random(6), 300, "en")), "en")]
    assert len(list(collocations._cuts(np.frombuffer(texts[0][1].encode(), np.uint8)))) > 5
    rules = collocations.Rules(min_count=4)
    assert collocated(docs, texts, rules) == brute_collocations(texts, rules)


def test_collocations_of_nothing(docs):
    assert collocations.collocations(docs([])).count() == 0
    assert collocations.collocations(docs(ODD)).count() == 0


def test_scores_beyond_64_bits(spark):
    a = 9_000_000_000_000
    score = collocations._dice("a", "l + r")
    found = spark.sql(f"select {score} as s from values ({a}L, {a + 7}L, {2 * a}L) as t(a, l, r)")
    assert found.first().s == 2_000_000 * a // (3 * a + 7)


def test_bitmaps(spark):
    rng = np.random.default_rng(3)
    codes = rng.integers(-(1 << 63), 1 << 63, 3000)
    held = bitmap(spark.createDataFrame([(int(c),) for c in codes], "code long"), "code", 20)
    want = np.zeros(1 << 20, bool)
    want[codes.view(np.uint64) >> np.uint64(44)] = True
    assert (np.unpackbits(held, bitorder="little").astype(bool) == want).all()
    assert holds(held, codes.view(np.uint64)).all()


# --- shards ---------------------------------------------------------------------------------

SMALL = sharding.Plan(ranges=4, draws=4, max_rows=20)


def brute_shards(texts, shards):
    import hashlib

    rows = sorted((int(hashlib.md5((t or "").encode()).hexdigest()[:15], 16),
                   -(1 << 63) if d is None else d, d is not None, d, t) for d, t in texts)
    total = sum(len((t or "").encode()) + 1 for *_, t in rows)
    found, before, used = [], 0, Counter()
    for *_, doc_id, text in rows:
        size = len((text or "").encode()) + 1
        shard = min(shards - 1, (2 * before + size) * shards // (2 * total))
        found.append((doc_id, size, zlib.crc32((text or "").encode()), shard, used[shard]))
        used[shard] += 1
        before += size
    return sorted(found, key=str)


@pytest.mark.parametrize("plan", [SMALL, sharding.Plan(ranges=16, max_rows=3), sharding.Plan(),
                                  sharding.Plan(shards=3, ranges=8, draws=1, max_rows=30)])
def test_shards_equal_brute_force(docs, plan):
    """Any splitters give the same shards; a third of the rows are copies, some of one id."""
    rng = random.Random(9)
    texts = [(k, "é" * rng.randrange(40)) for k in range(120)] + [(k, "copy") for k in range(60)]
    texts += [(7, "again")] * 50 + [(None, "again"), (None, None), (1, ""), (2, "long " * 500)]
    table = docs(texts, "range", "shard", "slot", "record")
    found = sharding.shard_documents(table, plan).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in found),
                  key=str) == brute_shards(texts, plan.shards)
    assert {r.law for r in found} == {"bytes"} and {r.grown_shard for r in found} == {None}
    assert all(r.range == 0 and r.record == 0 for r in found)  # the table's own columns
    narrow = sharding.places(table, plan).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in narrow
                  if r.doc_id is not None) == sorted(
        (r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in found if r.doc_id is not None)


def test_overfull_ranges_are_subdivided(docs):
    texts = [(k, "one text") for k in range(300)]
    rows = docs(texts)
    keyed = rows.select(F.lit(0).cast("long").alias("range"), F.lit(9).cast("long").alias("size"),
                        F.struct(F.lit(1).alias("key"), F.col("doc_id").alias("tie"),
                                 F.monotonically_increasing_id().alias("row")).alias("order"))
    totals, level = sharding._ranged(keyed, SMALL)[1:]
    found = [r.n for r in totals.collect()]
    assert level > 1 and sum(found) == 300 and max(found) <= SMALL.max_rows


def test_written_shards(docs, spark, tmp_path):
    texts = [(k, f"text {k}" * (k % 7)) for k in range(90)]
    sharding.write_shards(docs(texts), f"{tmp_path}/shards", SMALL)
    held = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted((r.doc_id, r.text) for r in held.collect()) == texts
    sizes = [r[1] for r in held.groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 2 * max(len(t) + 1 for _, t in texts)


def test_shards_of_nothing(docs):
    assert sharding.places(docs([])).count() == 0
    assert sorted((r.doc_id, r.size) for r in sharding.places(docs([(1, None)])).collect()) == [(1, 1)]
