"""The methods against brute-force versions of themselves."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from clickloom.llm import (
    decontaminate, html_extract, language_id, near_dedup, packing, secret_scan, toxicity)
from clickloom.llm.components import components
from tests.llm.test_small_tables import PIECES, TOKENS


def test_components_of_edges_that_turn_round_when_computed_again(spark):
    """As those of a spanning tree may, which depends on the order in which rows arrive."""
    def turned(batches):
        for batch in batches:
            for a in batch["id"].to_pylist():
                pair = random.SystemRandom().sample([2 * a, 2 * a + 1], 2)
                yield pa.RecordBatch.from_pydict({"a": pair[:1], "b": pair[1:]})

    edges = spark.range(200).mapInArrow(turned, "a long, b long")
    found = {(r.node, r.component) for r in components(edges).collect()}
    assert found == {(k, k - k % 2) for k in range(400)}


def test_near_duplicates_equal_all_pairs(docs):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(400)}" for _ in range(90)] for _ in range(12)]
    rows = []
    for k in range(220):
        words = list(base[0] if k % 2 else rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    rows += [(300 + k, "a b") for k in range(3)] + [(310, "A  b"), (311, "b a")]
    sizes = near_dedup.Sizes(width=3, percent=85, coordinates=64, matches=40)
    sets = {}
    for k, text in rows:
        w = text.lower().split()
        sets[k] = set(zip(w, w[1:], w[2:])) or {tuple(w)}
    group = {k: k for k in sets}
    for _ in range(len(group)):
        before = dict(group)
        for a, b in itertools.combinations(sets, 2):
            both = len(sets[a] & sets[b])
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                group[a] = group[b] = min(group[a], group[b])
        if before == group:
            break
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
             for r in near_dedup.near_duplicates(docs(rows), sizes).collect()}
    assert found == {k: (len(sets[k]), group[k], group[k] == k) for k in sets}


def test_overlaps_of_blocks():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(9)]
    want = [[len(set(a) & set(b)) for b in sets[4:]] for a in sets[:4]]
    assert near_dedup.overlaps(sets[:4], sets[4:]).tolist() == want


def _fewest(sizes, room):
    best = len(sizes)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] >= sizes[k] and bins[i] not in bins[:i]:
                place(k + 1, [*bins[:i], bins[i] - sizes[k], *bins[i + 1:]])
        place(k + 1, [*bins, room - sizes[k]])

    place(0, [])
    return best


def test_reduction_loses_nothing():
    rng = random.Random(4)
    for _ in range(150):
        room = rng.choice([10, 17, 30])
        sizes = sorted((rng.randint(1, room) for _ in range(rng.randint(0, 9))), reverse=True)
        counts = {s: sizes.count(s) for s in sizes}
        fixed, left = packing.reduce_by_dominance(counts, room)
        rest = sorted((s for s, n in left.items() for _ in range(n)), reverse=True)
        assert sum(n for n, _ in fixed) + _fewest(rest, room) == _fewest(sizes, room)
        held = {}
        for times, pattern in packing.plan(counts, room):
            assert sum(pattern) <= room
            for s in pattern:
                held[s] = held.get(s, 0) + times
        assert held == counts


def test_ids_by_words_are_those_of_the_text():
    rng = random.Random(1)
    alphabet = [*"ab 's'trȩ́́가 \n\t\x0b\x1c\u0085　ΣςİÉ.,#|<>1²", "<|endoftext|>"]
    tokens = packing.WordTokens(TOKENS)
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(50))
        want = tokens.tokenizer.encode(text, add_special_tokens=False).ids
        assert tokens.ids(text) == np.array(want, dtype="<u4").tobytes()


def test_forward_sums_all_segmentations():
    pieces = language_id.vocabulary(PIECES)
    chances = np.random.default_rng(1).random((len(pieces), 2))
    chances /= chances.sum(axis=0)
    scorer = language_id.Scorer(language_id.Model(["a", "b"], chances, PIECES))
    words = [b"the", b"a", b"thought", "été".encode()]
    scorer.know([words])

    def total(word):
        if not word:
            return np.ones(2)
        return sum((chances[pieces[word[:k]]] * total(word[k:])
                    for k in range(1, len(word) + 1) if word[:k] in pieces), np.zeros(2))

    for word in words:
        np.testing.assert_allclose(scorer.log_probability([word]),
                                   np.log(total("▁".encode() + word)), rtol=1e-9)


def test_long_words_are_summed_whole():
    pieces = language_id.vocabulary(PIECES)
    rng = random.Random(2)
    chances = np.random.default_rng(2).random((len(pieces), 2))
    chances /= chances.sum(axis=0)
    model = language_id.Model(["a", "b"], chances, PIECES)
    most = max(map(len, pieces))

    def unbounded(word):
        word = "▁".encode() + word
        log = np.full((len(word) + 1, 2), -np.inf)
        log[0] = 0
        for end in range(1, len(word) + 1):
            for width in range(1, min(most, end) + 1):
                number = pieces.get(word[end - width:end])
                if number is not None:
                    log[end] = np.logaddexp(log[end], log[end - width] + np.log(chances[number]))
        return log[-1]

    common = ["international", "responsibilities", "the", "été", "ß", "가나", "q", "straße"]
    for n in (3, 60, 255, 256, 257, 10_000):
        word = "".join(rng.choices(common, k=n)).encode()[:n].decode(errors="ignore").encode()
        scorer = language_id.Scorer(model)
        scorer.know([[word, b"short"]])
        np.testing.assert_allclose(scorer.log_probability([word]), unbounded(word), rtol=1e-9)


def test_expected_pieces_over_all_segmentations():
    pieces = language_id.vocabulary(PIECES)
    most = language_id.longest(PIECES)
    rng = np.random.default_rng(4)
    log = np.log(rng.dirichlet(np.full(len(pieces), 0.5)) + 1e-9).tolist()

    def segmentations(word):
        if not word:
            yield []
        for k in range(1, len(word) + 1):
            if word[:k] in pieces:
                for rest in segmentations(word[k:]):
                    yield [pieces[word[:k]], *rest]

    for word in (b"a", b"the", b"thought", "été".encode(), b"housing"):
        ways = list(segmentations(word))
        weights = [np.exp(sum(log[p] for p in way)) for way in ways]
        want = {}
        for way, weight in zip(ways, weights):
            for p in way:
                want[p] = want.get(p, 0) + weight / sum(weights)
        assert dict(language_id.expected_pieces(word, pieces, most, log)) == pytest.approx(want)
    # Every byte of a word of any length is in one piece.
    sizes = {number: len(piece) for piece, number in pieces.items()}
    long = "responsibilities가ß".encode() * 500
    found = language_id.expected_pieces(long, pieces, most, log)
    assert sum(n * sizes[p] for p, n in found.items()) == pytest.approx(len(long))


def test_rounds_raise_the_likelihood(docs):
    """Each round makes the training words likelier, with the smoothing as a prior of the pieces."""
    rng = random.Random(3)
    words = ["thinkingly", "unhoused", "irresponsibles", "nationalising", "xylophonist", "rethought"]
    table = docs([(k, " ".join(rng.choices(words, k=30)), "en") for k in range(30)])
    likelihood = []
    for rounds in range(4):
        model = language_id.Model.learn(table, PIECES, rounds=rounds)
        scorer = language_id.Scorer(model)
        held = [w.encode() for r in table.collect() for w in r.text.split()]
        scorer.know([held])
        prior = language_id.SMOOTH * np.log(model.chances).sum()
        likelihood.append(scorer.log_probability(held)[0] + prior)
    assert all(b > a for a, b in zip(likelihood, likelihood[1:])), likelihood


def test_best_stretch():
    rng = np.random.default_rng(3)
    for _ in range(200):
        equal = rng.random(rng.integers(1, 20)) < 0.6
        value = np.where(equal, 1, -decontaminate.MISMATCH)
        best = max((value[a:b].sum() for a in range(len(equal))
                    for b in range(a + 1, len(equal) + 1)), default=0)
        a, b, matches = decontaminate.best_stretch(equal)
        assert value[a:b].sum() == max(0, best) and matches == equal[a:b].sum()


def test_minimum_cut():
    rng = random.Random(9)
    for _ in range(200):
        n = rng.randint(1, 8)
        score = [rng.uniform(-2, 2) for _ in range(n)]
        joined = [(k - 1, k, rng.uniform(0, 2)) for k in range(1, n)]
        joined += [(a, b, 0.7) for a in range(n) for b in range(a + 2, n) if rng.random() < 0.3]

        def cost(side):
            return (sum(abs(s) for s, on in zip(score, side) if (s > 0) != on)
                    + sum(c for a, b, c in joined if side[a] != side[b]))

        best = min(map(cost, itertools.product([True, False], repeat=n)))
        assert cost(html_extract.minimum_cut(score, joined)) == pytest.approx(best)


def test_random_strings_are_found_and_others_are_not(docs):
    rng = random.Random(6)
    secret = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
                     for _ in range(40))
    other = "zzzzzzzzzzzzzzzz1111111111zzzzzzzzzzyyyyyyyyyyyy"
    rows = [(1, f"key {secret} end"), (2, f"not {other} end"), (3, "x" * 30 + " plain words"),
            (4, "user2name2has2digits2in2a2very2regular2way2here2too")]
    found = {r.doc_id: r.s for r in secret_scan.find_secrets(docs(rows)).withColumn(
        "s", secret_scan.span_text("secrets")).collect()}
    assert found == {1: "random:4:44", 2: "", 3: "", 4: ""}


def test_overlaps_of_all_alignments(spark, docs):
    """Passages with replaced words, against the best stretch of every document, item and shift."""
    rng = random.Random(11)

    def other(n):
        return [f"w{rng.randrange(3000)}" for _ in range(n)]

    items = {k: other(rng.randint(14, 40)) for k in range(30)}
    texts = {}
    for k in range(400):
        item = rng.choice(items)
        low = rng.randrange(0, len(item) - 11)
        held = item[low:rng.randint(low + 12, len(item))]
        rate = rng.choice([0, 0.05, 0.1, 0.15, 0.2])
        held = [f"new{rng.randrange(10**6)}" if rng.random() < rate else w for w in held]
        texts[k] = other(rng.randint(0, 30)) + held + other(rng.randint(0, 30))
    want = set()
    for k, text in texts.items():
        one = np.array(text)
        for number, item in items.items():
            for place in range(1 - len(item), len(text)):
                low, high = max(0, -place), min(len(item), len(text) - place)
                equal = one[low + place:high + place] == np.array(item[low:high])
                if equal.sum() >= 12:
                    a, b, matches = decontaminate.best_stretch(equal)
                    if matches >= 12 and 100 * matches >= 80 * (b - a):
                        want.add((k, number))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()],
                                  "item_id long, text string")
    table = docs([(k, " ".join(w)) for k, w in texts.items()])
    found = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(table, bench).collect()}
    assert len(want) > 250 and found <= want
    assert len(found) >= 0.98 * len(want), (len(found), len(want))


def _risk(margins, positive, prior):
    """The two parts of the risk, one text at a time."""
    def loss(x):
        return float(np.log1p(np.exp(-x)))

    toxic = [m for m, p in zip(margins, positive) if p]
    other = [m for m, p in zip(margins, positive) if not p]
    as_toxic = prior * sum(map(loss, toxic)) / len(toxic)
    clean = (sum(loss(-m) for m in other) / len(other)
             - prior * sum(loss(-m) for m in toxic) / len(toxic))
    return as_toxic, clean


def test_steps_follow_the_nonnegative_risk():
    """Gradients against differences of the risk; it is turned where the clean part is negative."""
    rng = np.random.default_rng(6)
    signs = []
    for trial in range(40):
        n, size = rng.integers(4, 12), 5
        rows = rng.random((n, size)) < 0.5
        positive = np.arange(n) < n // 2
        prior = rng.uniform(0.2, 0.8)
        known = np.arange(10, 10 + size, dtype=np.uint64)
        held = [known[row] for row in rows]
        texts = [toxicity._Texts([h for h, p in zip(held, positive) if p == kind], known)
                 for kind in (True, False)]
        point = rng.normal(0, 3, size + 1)

        def goal(x):
            as_toxic, clean = _risk(rows @ x[:size] + x[size], positive, prior)
            return as_toxic + clean if turn else -clean

        turn = _risk(rows @ point[:size] + point[size], positive, prior)[1] >= 0
        signs.append(turn)
        g_w, g_c = toxicity.nonnegative_step(*texts, point[:size], point[size], prior)
        for k, got in enumerate([*g_w, g_c]):
            step = np.eye(size + 1)[k] * 1e-5
            assert got == pytest.approx((goal(point + step) - goal(point - step)) / 2e-5, abs=1e-6)
    assert 5 < sum(signs) < 35


def test_trie_finds_every_piece_of_every_word():
    rng = random.Random(12)
    pieces, most = language_id.vocabulary(PIECES), language_id.longest(PIECES)
    inside = sorted(pieces)
    parts = [language_id._START + b"".join(rng.choice(inside) for _ in range(rng.randint(1, 5)))
             for _ in range(60)]
    parts += [bytes(rng.randrange(256) for _ in range(rng.randint(1, 30))) for _ in range(60)]
    parts += [b"a", b"\0", b"\0\0", max(inside, key=len) * 2]
    found = {(row, end - width, end): number
             for end, edges in language_id.trie(PIECES).found(parts).items()
             for width, rows, numbers in edges for row, number in zip(rows, numbers)}
    assert found == {
        (row, end - width, end): pieces[part[end - width:end]]
        for row, part in enumerate(parts) for end in range(1, len(part) + 1)
        for width in range(1, min(most, end) + 1) if part[end - width:end] in pieces}


def test_forward_sums_look_up_no_substring_by_itself(monkeypatch):
    """A word's pieces are found for all words at once, with the sums of the slow way."""
    pieces = language_id.vocabulary(PIECES)
    chances = np.random.default_rng(6).random((len(pieces), 2))
    scorer = language_id.Scorer(language_id.Model(["a", "b"], chances / chances.sum(0), PIECES))
    words = [b"a", b"hello", "gr\u00fc\u00dfe".encode(), b"internationalisation", b"x" * 40]
    parts = [language_id._START + w for w in words]
    want = [scorer._forward_alone(p) for p in parts]
    monkeypatch.setattr(scorer, "pieces", None)
    assert np.allclose(scorer._forward(parts), want, rtol=1e-12)


def test_words_of_several_texts_are_learned_together(monkeypatch):
    whole = packing._tokenizer(TOKENS)
    texts = ["", "One two, three.", "two Three\tfour\r\n", " ", "na\u00efve \u6f22\u5b57 caf\u00e9s!",
             "abc123 <|endoftext|> x_y", *(f"word{chr(97 + k % 26)}{chr(97 + k // 26)} and more"
                                          for k in range(300))]
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]

    def ids(tokens):
        return [np.frombuffer(b, dtype="<u4").tolist() for b in tokens.of_texts(texts)]

    tokens, calls = packing.WordTokens(TOKENS), []
    learn = tokens._learn
    monkeypatch.setattr(tokens, "_learn", lambda words: (calls.append(len(words)), learn(words)))
    assert ids(tokens) == want
    assert len(calls) == 1
    # Slices and the bound on held words cut anywhere, also within a text.
    monkeypatch.setattr(packing, "SLICE", 7)
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    assert ids(packing.WordTokens(TOKENS)) == want
