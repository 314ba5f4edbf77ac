"""Findings among random strings and identifiers, and the battery and the rule in plain Python."""

import math
import random
import re

import numpy as np

from clickloom.llm import secret_scan
from clickloom.llm.secret_scan import Battery

WORDS = ("get user name from table list of open order items and send them to remote service with "
         "default value for each field that was changed since last update check index builder file "
         "reader stream config parser handler factory manager request response status message "
         "account customer product database connection pool thread worker queue").split()
ALPHABETS = [secret_scan._UPPER + secret_scan._LOWER + secret_scan._DIGITS,
             secret_scan._LOWER + secret_scan._DIGITS, secret_scan._UPPER + "234567",
             secret_scan._UPPER + secret_scan._LOWER + secret_scan._DIGITS + "+/"]


def mixed(found):
    return (len(found) >= 20 and re.search("[0-9]", found) and re.search("[A-Za-z]", found)
            and not re.search("[0-9a-f]{16}", found))


def of_words(rng, style):
    words = [rng.choice(WORDS) for _ in range(rng.randint(4, 8))]
    words.insert(rng.randint(1, len(words)), str(rng.randint(1, 999)))
    if style == "camel":
        return words[0] + "".join(w.capitalize() for w in words[1:])
    if style == "constant":
        return "_".join(words).upper()
    return {"snake": "_", "kebab": "-", "path": "/"}[style].join(words)


def made(seed, n_random, n_words):
    rng = random.Random(seed)
    secrets, names = [], []
    while len(secrets) < n_random:
        found = "".join(rng.choices(ALPHABETS[len(secrets) % 4], k=rng.randint(20, 64)))
        if mixed(found):
            secrets.append(found)
    while len(names) < n_words:
        found = of_words(rng, ("camel", "snake", "path", "kebab", "constant")[len(names) % 5])
        if mixed(found):
            names.append(found)
    return secrets, names


def findings(docs, rows):
    held = secret_scan.find_secrets(docs(rows)).selectExpr(
        "doc_id", "transform(filter(secrets, s -> s.kind = 3), s -> s.found) as found")
    return {r.doc_id: r.found for r in held.collect()}


def test_few_findings_are_identifiers_and_few_secrets_are_lost(docs):
    secrets, names = made(1, 2000, 6000)
    found = findings(docs, [(k, f"see {s} there") for k, s in enumerate(secrets + names)])
    right = sum(bool(found[k]) for k in range(2000))
    wrong = sum(bool(found[k]) for k in range(2000, 8000))
    assert right >= 0.9 * 2000
    assert wrong <= 0.05 * (right + wrong)


def test_identifiers_alone_give_few_findings(docs):
    _, names = made(2, 0, 3000)
    found = findings(docs, [(k, s) for k, s in enumerate(names)])
    assert sum(map(bool, found.values())) <= 3


def alphabet(found):
    return next((a for p, a in secret_scan.ENCODINGS if re.search(p, found)),
                secret_scan._UPPER + secret_scan._LOWER + secret_scan._DIGITS + "+/-_")


def battery(found):
    letters = alphabet(found)
    k, n = len(letters), len(found)
    x = np.array([letters.index(c) for c in found])
    b = min(k, max(2, n // 3))
    chi = (np.bincount(x * b // k, minlength=b) ** 2).sum() * b / n - n
    uniform = (((chi / (b - 1)) ** (1 / 3) - (1 - 2 / (9 * (b - 1)))) / math.sqrt(2 / (9 * (b - 1))))
    high = 2 * x >= k
    up = int(high.sum())
    expected = 2 * up * (n - up) / n + 1
    spread = (expected - 1) * (expected - 2) / (n - 1)
    runs = ((1 + (high[1:] != high[:-1]).sum() - expected) / math.sqrt(spread)) if spread > 0 else 40
    off = x - x.mean()
    serial = math.sqrt(n) * ((off[1:] * off[:-1]).sum() / (off ** 2).sum() + 1 / n) if off.any() else 40
    return min(1.0, 3 * min(math.erfc(abs(z) / math.sqrt(2)) for z in (uniform, runs, serial)))


def power(found):
    """Of ten: how much likelier as a random string than as an identifier."""
    kind = [0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in found]
    log = math.log(secret_scan.STARTS[kind[0]])
    log += sum(math.log(secret_scan.FOLLOWS[a][b]) for a, b in zip(kind, kind[1:]))
    for c in found:
        if c.isalpha():
            at = ord(c.lower()) - ord("a")
            log += math.log(secret_scan.LETTERS[at] / sum(secret_scan.LETTERS))
        else:
            log += math.log(0.1 if c.isdigit() else secret_scan.SEPARATORS[c])
    return (-len(found) * math.log(len(alphabet(found))) - log) / math.log(10)


def test_findings_equal_the_battery_and_the_rule_in_plain_python(docs):
    rule = Battery()
    secrets, names = made(3, 150, 450)
    table = [(k, s) for k, s in enumerate(secrets + names)]
    cells = {}
    for k, s in table:
        cells.setdefault(sum(len(s) >= n for n in rule.bands), {})[k] = (
            0 if battery(s) < rule.lost_rate else
            min(rule.cells * rule.decades, int(max(0.0, power(s)) * rule.cells)))
    want = set()
    for held in cells.values():
        for cut in sorted(set(held.values())):
            beyond = {k for k, c in held.items() if c >= cut}
            if 10 ** (-cut / rule.cells) * len(held) <= rule.false_rate * len(beyond):
                want |= beyond
                break
    assert {k for k, found in findings(docs, table).items() if found} == want
    assert 100 < len(want) <= 160


def test_base_spans_equal_regular_expressions(docs):
    rng = random.Random(4)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", '"', "'", " ", "  ", ":", "=", "é",
             "abcdef0123456789", "0123456789abcdef01", "AKIA", "ABCDEFGHIJKLMN", "hunter2hunter2",
             "/._-", "\n", "x"]
    rows = [(k, "".join(rng.choices(parts, k=rng.randint(0, 40)))) for k in range(300)]
    kinds = [secret_scan.ASSIGN.replace("(?i:", "(?ai:"), secret_scan.ACCESS, secret_scan.HEX]

    def spans(text):
        out = [(m.start(), k, m.end()) for k, p in enumerate(kinds) for m in re.finditer(p, text)
               if k or len(m[2]) >= secret_scan.MIN_VALUE]
        return sorted(out)

    held = secret_scan.find_secrets(docs(rows)).selectExpr("doc_id", "base").collect()
    got = {r.doc_id: [(s.start, s.kind, s.stop) for s in r.base] for r in held}
    assert got == {k: spans(text) for k, text in rows}
    assert sum(map(len, got.values())) > 300
