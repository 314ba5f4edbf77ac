"""Texts with hundreds of spans: each step's work grows with the text, not with its square."""

import random
import re
import time

from pyspark.sql import functions as F

from clickloom.llm import secret_scan

LETTERS = secret_scan._UPPER + secret_scan._LOWER + secret_scan._DIGITS
KINDS = [secret_scan.ASSIGN.replace("(?i:", "(?ai:"), secret_scan.ACCESS, secret_scan.HEX]


def text_of(seed, n, others):
    rng = random.Random(seed)

    def part():
        kind = rng.randrange(6)
        if kind == 0:
            return "".join(rng.choices("abcdef0123456789", k=rng.choice([12, 16, 40])))
        if kind == 1:
            return rng.choice(["password=", "Token: ", "api_key = '"]) + "".join(
                rng.choices(LETTERS + ".=/", k=rng.randint(6, 60)))
        if kind == 2:
            return "AKIA" + "".join(rng.choices(secret_scan._UPPER, k=rng.randint(10, 20)))
        if kind == 3:
            return "".join(rng.choices(LETTERS + "+/", k=rng.randint(16, 64)))
        return rng.choice(others)

    return rng.choice(others) + "".join(part() + rng.choice([" ", "\n", ""]) for _ in range(n))


def base_spans(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(KINDS) for m in re.finditer(p, text)
                  if k or len(m[2]) >= secret_scan.MIN_VALUE)


def clear_candidates(text, base):
    return [(m.start(), 3, m.end()) for m in re.finditer(secret_scan.CANDIDATE % 20, text)
            if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])
            and not any(b[0] < m.end() and m.start() < b[2] for b in base)]


def mask(text, spans):
    out, reach = [], 0
    for k, (start, _, stop) in enumerate(sorted(spans)):
        if k == 0 or start > reach:
            out += [text[reach:start], secret_scan.MASK]
        reach = max(reach, stop)
    return "".join(out) + text[reach:]


def test_texts_with_many_spans(docs):
    plain, wide = [" plain ", "some words,"], [" naïve ", "﻿x ", "𝒳y ", "日本 "]
    texts = {k: text_of(k, 600, plain if k % 2 else plain + wide) for k in range(8)}
    texts[8], texts[9] = "﻿" + "ab12" * 8 + "﻿", "ab12" * 8
    began = time.monotonic()
    table = docs(list(texts.items()))
    found = secret_scan.find_secrets(table)
    rows = {r.doc_id: r for r in secret_scan.masked(found).collect()}
    took = time.monotonic() - began
    n_random = 0
    for k, text in texts.items():
        got = [(s.start, s.kind, s.stop) for s in rows[k].secrets]
        base = base_spans(text)
        assert [(s.start, s.kind, s.stop) for s in rows[k].base] == base
        assert [s for s in got if s[1] < 3] == base
        strings = [s for s in got if s[1] == 3]
        assert set(strings) <= set(clear_candidates(text, base))
        assert all(text[s.start:s.stop] == s.found for s in rows[k].secrets)
        assert rows[k].text == mask(text, got)
        n_random += len(strings)
    assert rows[9].text == "[SECRET]" and rows[8].text == "﻿[SECRET]﻿"
    assert n_random > 300
    assert sum(map(len, (r.base for r in rows.values()))) > 1000
    # As long as a pattern was searched for anew for each of its matches, this took minutes.
    assert took < 90


def test_columns_that_parquet_cannot_hold_pass(docs):
    table = docs([(1, "a 0123456789abcdef")]).withColumns(
        {"nothing": F.lit(None), "span": F.expr("make_interval(1, 2)")})
    row = secret_scan.find_secrets(table).select("n_hex", "nothing", F.size("secrets")).first()
    assert tuple(row) == (1, None, 1)
    assert "text" not in secret_scan.find_secrets(docs([(1, "a")]), texts=False).columns
