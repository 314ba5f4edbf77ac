"""The licence scan against Dice of every stretch, and on full licence texts that were edited."""

import random
import time
from collections import Counter
from importlib import resources

import pyarrow as pa

from clickloom.llm import license_texts, licenses
from clickloom.llm.words import words_by_text


def hashes(text):
    return next(words_by_text(pa.array([text]), licenses._IS_WORD))[1]


def by_brute_force(templates, text, least):
    """All stretches of all templates with plain Counters, then the best that do not overlap."""
    pairs = list(zip(text.split(), text.split()[1:]))
    found = []
    for k, (name, body) in enumerate(templates):
        own = list(zip(body.split(), body.split()[1:]))
        cuts = [(max(0, s), min(len(pairs), s + len(own))) for s in range(1 - len(own), len(pairs))]
        for low, high in [*cuts, (0, len(pairs))]:
            shared = sum((Counter(own) & Counter(pairs[low:high])).values())
            dice = 2 * shared / (len(own) + high - low)
            if dice >= least:
                found.append((-shared, -dice, low, k, high, name))
    kept = []
    for _, dice, low, _, high, name in sorted(found):
        if all(high <= a or low >= b for _, _, a, b in kept):
            kept.append((name, -dice, low, high))
    return sorted(((n, d, a, b - a + 1) for n, d, a, b in kept), key=lambda m: m[2])


def test_matches_equal_brute_force():
    rng = random.Random(7)
    n_found = 0
    for _ in range(300):
        letters = "abcdef"[:rng.randint(2, 6)]
        templates = [(f"t{k}", " ".join(rng.choices(letters, k=rng.randint(2, 12))))
                     for k in range(rng.randint(1, 5))]
        words = []
        for _ in range(rng.randint(0, 6)):
            words += rng.choices(letters, k=rng.randint(0, 5))
            words += [w if rng.random() < 0.93 else "x" for w in rng.choice(templates)[1].split()]
        least = rng.choice([0.6, 0.85, 1.0])
        found = licenses.Templates(templates, least).matches(hashes(" ".join(words)))
        want = by_brute_force(templates, " ".join(words), least) if len(words) > 1 else []
        assert found == want
        n_found += len(found)
    assert n_found > 300


def edited(text, rng, share):
    """``text`` with a share of its words replaced, left out or doubled, and other white space."""
    words = []
    for word in text.split():
        if rng.random() >= share:
            words.append(word)
        else:
            words += rng.choice([["other"], [], [word, word]])
    return rng.choice([" ", "\n", "  \t"]).join(words).swapcase()


def test_edited_licences_are_found_in_other_text():
    """Every full text and header notice, whole or between other words, with 3 % of words edited."""
    rng = random.Random(8)
    templates = license_texts.templates()
    held = licenses.Templates(templates)
    long = [(name, text) for name, text in templates if len(text.split()) > 25]
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0"} <= {
        name for name, text in long if len(text.split()) > 1000}
    tried = right = 0
    for name, text in long:
        for around in (0, 300):
            for _ in range(3):
                other = [f"w{rng.randrange(10**6)}" for _ in range(around)]
                body = " ".join(other) + "\n" + edited(text, rng, 0.03) + "\n" + " ".join(other)
                found = held.matches(hashes(body))
                most = max(found, key=lambda m: m[3], default=(None,))
                tried, right = tried + 1, right + (most[0] == name)
    assert right / tried >= 0.97, (right, tried)


def test_files_of_full_texts():
    names = {f.name for f in (resources.files("clickloom.llm") / "license_bodies").iterdir()}
    templates = license_texts.templates()
    assert {f"{name}.txt" for name, _ in templates} >= names
    held = licenses.Templates(templates)
    for name, text in templates:
        found = held.matches(hashes(text))
        assert [(m[0], m[1]) for m in found] == [(name, 1.0)]


def test_plain_and_nearly_licensed_texts_have_no_matches():
    held = licenses.Templates(license_texts.templates())
    for text in ("", "licence", "We licensed under two hundred films and released under ten.",
                 "the of and to in a is that " * 4000,
                 "You may obtain a copy of the book. Permission was granted to no one."):
        assert held.matches(hashes(text)) == []


def test_repeated_notices_take_linear_time():
    held = licenses.Templates(license_texts.templates())
    taken = []
    for n in (2_000, 16_000):
        words = hashes("Released under the MIT License. some words between them. " * n)
        began = time.process_time()
        found = held.matches(words)
        taken.append(time.process_time() - began)
        assert len(found) == n and {m[:2] for m in found} == {("MIT", 1.0)}
    assert taken[1] < 24 * taken[0] + 0.5
