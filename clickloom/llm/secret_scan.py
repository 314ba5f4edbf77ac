"""Secret scan, in DataFrame functions only: known forms, and strings that look random.

Known forms ("base" kinds) are found by pattern: assignments, access keys, long hex strings. Their
positions come from the lengths of what lies between the matches.

Other secrets are found by what they are made of. A candidate is a run of at least ``min_length``
letters, digits and ``+/_-`` that mixes letters and digits. Its encoding is the smallest alphabet
that holds it (hex, base 32, base 36, letters and digits, base 64). A battery of tests asks whether
it could be a random string over that alphabet: chi-squared uniformity, the number of runs above
and below the middle, and serial correlation, together by Bonferroni's bound. What the battery
rejects at ``lost_rate`` is no secret; so a share of the random strings is lost, of ``lost_rate``.

Many identifiers and paths pass a battery that has 20 characters to go by. So the others have to
reject the opposite hypothesis, that the candidate is an identifier: words, capitals, digits and
separators that follow one another as ``FOLLOWS`` says, with the letters of prose. The likelihood of
the string as a random one over that as an identifier is an e-value, and its inverse a p-value that
holds at every length (Markov's inequality). Since thousands of candidates are tested, those that
count as findings are chosen by Benjamini and Hochberg's rule at rate ``false_rate``, which bounds
the share of identifiers among them, in each band of lengths by itself, as short strings have less
power. The rule's thresholds come from a histogram of p-values of the whole table, with a fixed
number of cells. A finding that touches a base span is left out.

Texts are scanned once; what is found in them is stored until the thresholds are known. The work
grows with a text's length, however many spans it holds: what a step needs is made once per text and
not once per span, and a condition that is cheap to test spares most texts a pattern they cannot hold.

Null and empty texts have no spans. Rows are scanned one by one: repeated rows have equal results,
null ids and other columns (but for those named in the result) pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.columns import sets_aside
from clickloom.sources.storage import materialize

# Fixed patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
CANDIDATE = r"[A-Za-z0-9+/_-]{%d,}"
MIN_VALUE = 12
# What a text with an assignment, and one with an access key or a long hex string, holds at least.
ASSIGNED = r"[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{%d}" % MIN_VALUE
RUN = r"[A-Za-z0-9+/_-]{%d}"
MIN_RUN = 16
MASK = "[SECRET]"
# Beyond all cells: nothing of the band is a finding.
_NO_CUT = 1_000_000

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Encodings from the smallest alphabet on: pattern of the whole string, its alphabet.
ENCODINGS = (
    (r"^[0-9a-f]+$", _DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    (r"^[A-Z2-7]+$", _UPPER + "234567"),
    (r"^[a-z0-9]+$", _DIGITS + _LOWER),
    (r"^[A-Z0-9]+$", _DIGITS + _UPPER),
    (r"^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS),
    (r"^[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
    (r"^[A-Za-z0-9_-]+$", _UPPER + _LOWER + _DIGITS + "-_"),
)

# The model of identifiers; fixed values. Shares of letters in prose, a to z, in tenths of percents
# (rounded means of the common European languages), and of the separators.
LETTERS = (87, 14, 33, 42, 140, 12, 15, 30, 72, 4, 7, 45, 26, 75, 65, 24, 5, 66, 66, 72, 37, 12, 10,
           3, 10, 6)
SEPARATORS = {"_": 0.4, "-": 0.3, "/": 0.25, "+": 0.05}
# Lower case, upper case, digit, separator: the chance of each at the start, and after each.
STARTS = (0.60, 0.25, 0.05, 0.10)
FOLLOWS = ((0.82, 0.07, 0.04, 0.07),
           (0.36, 0.54, 0.04, 0.06),
           (0.20, 0.12, 0.53, 0.15),
           (0.62, 0.20, 0.12, 0.06))
_ALL = _LOWER + _UPPER + _DIGITS + "".join(SEPARATORS)


@dataclass(frozen=True)
class Battery:
    min_length: int = 20
    # The share of random strings that the battery may lose, and of findings that may be false.
    lost_rate: float = 0.01
    false_rate: float = 0.05
    # Lengths from which a band starts.
    bands: tuple[int, ...] = (20, 32, 48, 96)
    # Cells of the histogram per factor ten of p, and the smallest p told apart, as a power.
    cells: int = 20
    decades: int = 12


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """SQL of ``body``, where ``name`` stands for ``value``, which is made once.

    Spark puts a column that is used once into the place where it is used. Inside of a lambda
    function it would be made anew for every element.
    """
    return f"transform(array({value}), {name} -> {body})[0]"


def _quick(pattern: str) -> str:
    """The same pattern with its ranges spelled out: Java looks single characters up in a table."""
    for short, spelled in (("A-Z", _UPPER), ("a-z", _LOWER), ("0-9", _DIGITS), ("a-f", "abcdef")):
        pattern = pattern.replace(short, spelled)
    return pattern


def _running(values: str, merge: str, zero: str = "0L") -> str:
    """SQL of the running values before each element, in blocks of the square root of the size.

    ``merge`` combines ``t`` and ``x``; growing one list element by element would take time that
    grows with the square of the size.
    """
    def grown(items: str, start: str) -> str:
        step = merge.replace("{t}", "s.t").replace("{x}", "x")
        return (f"aggregate({items}, named_struct('t', {start}, 'a', cast(array() as array<long>)),"
                f" (s, x) -> named_struct('t', {step}, 'a', array_append(s.a, s.t)), s -> s.a)")

    total = merge.replace("{t}", "t").replace("{x}", "x")
    blocks = "transform(sequence(1, size(all_v), all_k), k -> slice(all_v, k, all_k))"
    sums = f"transform(all_b, b -> aggregate(b, {zero}, (t, x) -> {total}))"
    parts = "flatten(transform(all_b, (b, i) -> " + grown("b", "all_s[i]") + "))"
    parts = _let("all_b", blocks, _let("all_s", grown(sums, zero), parts))
    parts = _let("all_k", "cast(ceil(sqrt(size(all_v))) as int)", parts)
    return _let("all_v", values, f"if(size(all_v) = 0, cast(array() as array<long>), {parts})")


def with_spans(df: DataFrame, text: str, pattern: str, kind: int, name: str, keep: str = "true",
               possible: str = "true") -> DataFrame:
    """Adds ``name``: spans ``(start, kind, stop, found)`` of the matches, in code points.

    ``keep`` may use ``z.m``, the match, and ``z.v``, the value that is assigned. ``possible`` holds
    of every text with such a match.
    """
    # Each keyword of an assignment begins with one of these letters.
    p = _quoted(("(?=[APSTapst])" if pattern == ASSIGN else "") + _quick(pattern))
    value = f"regexp_extract_all(w_t, {p}, 2)" if pattern == ASSIGN else "w_m"
    spans = ("transform(filter(transform(w_m, (x, i) -> named_struct('m', x, 'v', w_v[i],"
             f" 'at', w_at[i] + w_g[i])), z -> {keep}),"
             f" z -> named_struct('start', z.at, 'kind', {kind}, 'stop', z.at + length(z.m),"
             " 'found', z.m))")
    steps = "transform(w_m, (x, i) -> cast(w_g[i] + length(x) as long))"
    spans = _let("w_v", value, _let("w_at", _running(steps, "{t} + {x}"), spans))
    spans = _let("w_g", f"transform(split(w_t, {p}, -1), x -> length(x))", spans)
    none = "cast(array() as array<struct<start: long, kind: int, stop: long, found: string>>)"
    spans = _let("w_m", f"regexp_extract_all(w_t, {p}, 0)", f"if(size(w_m) = 0, {none}, {spans})")
    spans = _let("w_t", f"`{text}`", spans)
    return df.withColumn(name, F.expr(f"if({possible}, {spans}, {none})"))


def _apart(strings: str, base: str) -> str:
    """SQL of the strings, which are disjoint, that overlap no base span.

    Both are sorted together, a string by its stop, so that the base spans that begin before it
    stops stand before it: the largest of their stops decides.
    """
    ends = (f"sort_array(concat(transform({strings}, c -> named_struct('at', c.stop, 'base', 0,"
            " 'stop', 0L, 'span', c)),"
            f" transform({base}, b -> named_struct('at', b.start, 'base', 1, 'stop', b.stop,"
            " 'span', b))))")
    kept = ("transform(filter(transform(e_all, (x, i) -> named_struct('x', x, 'reach', e_r[i])),"
            " z -> z.x.base = 0 and z.reach <= z.x.span.start), z -> z.x.span)")
    reach = _running("transform(e_all, x -> x.stop)", "greatest({t}, {x})")
    return (f"if(size({strings}) = 0 or size({base}) = 0, {strings}, "
            + _let("e_all", ends, _let("e_r", reach, kept)) + ")")


def _normal_tail(z: str) -> str:
    """SQL of the two-sided tail of a normal value (Abramowitz and Stegun 7.1.26)."""
    x = f"(abs({z}) / sqrt(2.0D))"
    t = f"(1.0D / (1.0D + 0.3275911D * {x}))"
    return (f"greatest(1e-300D, least(1.0D, {t} * (0.254829592D + {t} * (-0.284496736D + {t} * "
            f"(1.421413741D + {t} * (-1.453152027D + {t} * 1.061405429D)))) * exp(-{x} * {x})))")


def within_class() -> list[float]:
    """Log chance of each character of ``_ALL`` in an identifier, within its class."""
    letters = [math.log(n / sum(LETTERS)) for n in LETTERS]
    return letters * 2 + [math.log(0.1)] * 10 + [math.log(x) for x in SEPARATORS.values()]


def _array(values) -> str:
    return "array(" + ", ".join(f"{x!r}D" if isinstance(x, float) else str(x) for x in values) + ")"


def _by_code(values: dict[str, float], other: float) -> str:
    """SQL of an array with the value of every character, by its code."""
    return _array(values.get(chr(k), other) for k in range(128))


def _codes(found: str) -> str:
    """SQL of the characters' codes; those of candidates are below 128."""
    return f"transform(filter(split({found}, ''), c -> c <> ''), c -> ascii(c))"


def _as_identifier(codes: str) -> str:
    """SQL of the log likelihood of one candidate string as an identifier."""
    classes = dict(zip(_ALL, [0] * 26 + [1] * 26 + [2] * 10 + [3] * len(SEPARATORS)))
    chances = _by_code(dict(zip(_ALL, within_class())), 0.0)
    kinds = f"transform({codes}, c -> {_by_code(classes, 0)}[c])"
    follows = _array(math.log(x) for row in FOLLOWS for x in row)
    starts = _array(math.log(x) for x in STARTS)
    return _let("i_k", kinds, f"aggregate(transform({codes}, (c, i) -> {chances}[c] + if(i = 0,"
                f" {starts}[i_k[i]], {follows}[4 * i_k[i - 1] + i_k[i]])), 0.0D, (t, v) -> t + v)")


def _battery(found: str, codes: str) -> str:
    """SQL of a struct ``(n, p, random)`` for one candidate string: the length, the battery's p and
    the log likelihood as a random string."""
    alphabets = [a for _, a in ENCODINGS] + [_UPPER + _LOWER + _DIGITS + "+/-_"]
    whens = " ".join(f"when {found} rlike {_quoted(p)} then {k}"
                     for k, (p, _) in enumerate(ENCODINGS))
    encoding = f"(case {whens} else {len(ENCODINGS)} end)"
    places = "array(" + ", ".join(
        _by_code({c: k for k, c in enumerate(a)}, -1) for a in alphabets) + ")"
    x = _let("b_p", f"{places}[b_e]", f"transform({codes}, c -> b_p[c])")
    # Each character as one of the lower or the higher half.
    halves = " ".join(
        f"when {k} then translate({found}, {_quoted(a)},"
        f" '{''.join('lh'[2 * at >= len(a)] for at in range(len(a)))}')"
        for k, a in enumerate(alphabets))
    # Cells of uniformity hold three characters or more on average.
    held = _let("b_e", encoding, f"named_struct('k', {_array(map(len, alphabets))}[b_e],"
                f" 'n', length({found}), 'x', {x}, 'h', case b_e {halves} end)")
    bins = _let("w", held, "named_struct('n', w.n, 'x', w.x, 'k', w.k, 'h', w.h,"
                " 'b', least(w.k, greatest(2, w.n div 3)),"
                " 'mean', aggregate(w.x, 0.0D, (t, v) -> t + v) / w.n)")
    # Each cell has a letter. They are taken out one after the other, and the lengths give the counts.
    letters = "array(" + ", ".join(_quoted(chr(ord("0") + k)) for k in range(len(_ALL))) + ")"
    cells = f"array_join(transform(w.x, v -> {letters}[v * w.b div w.k]), '')"
    count = "(s.m - length(s.y))"
    squares = (f"aggregate(sequence(0, w.b - 1), named_struct('y', {cells}, 'm', w.n, 't', 0L),"
               f" (s, j) -> named_struct('y', replace(s.y, {letters}[j], ''), 'm', length(s.y),"
               f" 't', s.t + cast({count} as long) * {count}),"
               f" s -> cast(s.t + cast({count} as long) * {count} as double))")
    sums = _let("w", bins, (
        "named_struct('n', w.n, 'b', w.b, 'k', w.k,"
        f" 'chi', {squares} * w.b / w.n - w.n,"
        " 'up', w.n - length(replace(w.h, 'h', '')),"
        " 'runs', 1 + (w.n - length(replace(w.h, 'lh', ''))) div 2"
        "   + (w.n - length(replace(w.h, 'hl', ''))) div 2,"
        " 'sq', aggregate(w.x, 0.0D, (t, v) -> t + (v - w.mean) * (v - w.mean)),"
        " 'lag', aggregate(transform(w.x, (v, i) -> if(i = 0, 0.0D,"
        "   (v - w.mean) * (w.x[i - 1] - w.mean))), 0.0D, (t, v) -> t + v))"))
    # Wilson and Hilferty's cube root; Wald and Wolfowitz's runs; correlation of neighbours.
    df = "(w.b - 1)"
    uniform = (f"((power(w.chi / {df}, 1.0D / 3) - (1 - 2.0D / (9 * {df})))"
               f" / sqrt(2.0D / (9 * {df})))")
    expected = "(2.0D * w.up * (w.n - w.up) / w.n + 1)"
    spread = f"(({expected} - 1) * ({expected} - 2) / (w.n - 1))"
    runs = f"if({spread} > 0, (w.runs - {expected}) / sqrt({spread}), 40.0D)"
    serial = "if(w.sq > 0, sqrt(1.0D * w.n) * (w.lag / w.sq + 1.0D / w.n), 40.0D)"
    zs = f"array({uniform}, {runs}, {serial})"
    least = f"array_min(transform({zs}, z -> {_normal_tail('z')}))"
    return _let("w", sums, f"named_struct('n', w.n, 'p', least(1.0D, 3 * {least}),"
                " 'random', -w.n * ln(w.k))")


def _scanned(docs: DataFrame, battery: Battery) -> DataFrame:
    """``docs`` with ``_base`` spans, sorted, the numbers of each kind, and ``_tests``: candidates
    that touch none of them."""
    df = docs.withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    run = RUN % min(MIN_RUN, battery.min_length)
    df = df.withColumn("_run", F.expr(f"_text rlike {_quoted(_quick(run))}"))
    df = with_spans(df, "_text", ASSIGN, 0, "_assign", f"length(z.v) >= {MIN_VALUE}",
                    f"_text rlike {_quoted(_quick(ASSIGNED))}")
    df = with_spans(df, "_text", ACCESS, 1, "_access", possible="contains(_text, 'AKIA')")
    df = with_spans(df, "_text", HEX, 2, "_hex", possible="_run")
    df = with_spans(df, "_text", CANDIDATE % battery.min_length, 3, "_strings",
                    "z.m rlike '[0-9]' and z.m rlike '[A-Za-z]'", "_run")
    df = df.withColumn("_base", F.sort_array(F.concat("_assign", "_access", "_hex")))
    band = " + ".join(f"if(t.t.n >= {n}, 1, 0)" for n in battery.bands)
    # Of the p-value against an identifier; what the battery rejects has the p-value 1.
    power = "(t.t.random - t.identifier) / ln(10.0D)"
    cell = (f"if(t.t.p < {battery.lost_rate}D, 0, cast(least({battery.cells * battery.decades},"
            f" floor(greatest(0.0D, {power}) * {battery.cells})) as int))")
    tested = _let("c_c", _codes("c.found"),
                  f"named_struct('span', c, 't', {_battery('c.found', 'c_c')},"
                  f" 'identifier', {_as_identifier('c_c')})")
    counts = {name: F.size(name).cast("long") for name in ("_assign", "_access", "_hex")}
    return (
        df.withColumn("_clear", F.expr(_apart("_strings", "_base")))
        .withColumn("_tested", F.expr(f"transform(_clear, c -> {tested})"))
        .withColumns({**counts, "_tests": F.expr(
            f"transform(_tested, t -> named_struct('span', t.span, 'band', {band},"
            f" 'cell', {cell}))")})
        .drop("_text", "_run", "_strings", "_clear", "_tested"))


def thresholds(tests: DataFrame, battery: Battery) -> DataFrame:
    """``(band, cut)``: candidates of a band in cell ``cut`` or beyond are findings.

    Cells run from p = 1 down. A cell counts with its largest p, so the false rate is kept.
    """
    cells = tests.groupBy("band", "cell").agg(F.count("*").alias("n"))
    beyond = Window.partitionBy("band").orderBy(F.desc("cell"))
    ranked = cells.select(
        "band", "cell", F.sum("n").over(beyond).alias("i"),
        F.sum("n").over(Window.partitionBy("band")).alias("m"))
    largest = F.pow(F.lit(10.0), -F.col("cell") / battery.cells)
    return (ranked.where(largest * F.col("m") <= battery.false_rate * F.col("i"))
            .groupBy("band").agg(F.min("cell").alias("cut")))


@sets_aside("_text", "_run", "_assign", "_access", "_hex", "_base", "_strings", "_clear", "_tested",
            "_tests", "_random")
def find_secrets(docs: DataFrame, battery: Battery = Battery(), texts: bool = True) -> DataFrame:
    """``docs`` with ``n_assign, n_access, n_hex, n_random``, ``base`` and ``secrets``: arrays of
    ``(start, kind, stop, found)`` ordered by start, then kind; ``texts``: with the texts, too."""
    scanned = _scanned(docs, battery)
    if not texts:
        scanned = scanned.drop("text")
    try:
        scanned = materialize(scanned, "scanned")
    except AnalysisException:
        pass  # Other columns that Parquet has no form for: the texts are scanned again below.
    tests = scanned.select(F.explode("_tests").alias("t")).select("t.band", "t.cell")
    # One number for each band of lengths.
    cuts = {row["band"]: row["cut"] for row in thresholds(tests, battery).collect()}
    above = " ".join(f"when {band} then {cut}" for band, cut in sorted(cuts.items()))
    cut = f"case t.band {above} else {_NO_CUT} end" if cuts else str(_NO_CUT)
    random = F.expr(f"transform(filter(_tests, t -> t.cell >= {cut}), t -> t.span)")
    return (scanned.withColumn("_random", random)
            .withColumns({"n_assign": F.col("_assign"),
                          "n_access": F.col("_access"),
                          "n_hex": F.col("_hex"),
                          "n_random": F.size("_random").cast("long"),
                          "base": F.col("_base"),
                          "secrets": F.sort_array(F.concat("_base", "_random"))})
            .drop("_assign", "_access", "_hex", "_base", "_tests", "_random"))


def span_text(spans: str):
    """``kind:start:stop`` of each span, comma-joined."""
    kinds = "array(" + ", ".join(_quoted(k) for k in KINDS) + ")"
    return F.expr(f"array_join(transform(`{spans}`, s -> concat({kinds}[s.kind], ':', s.start,"
                  " ':', s.stop)), ',')")


@sets_aside("_cuts", "_end", "_length")
def masked(docs: DataFrame, text: str = "text", spans: str = "secrets") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``MASK``; touching ones by one.

    Pieces are taken from the text's bytes, where a place needs no counting from the start: those of
    ASCII, or four for each code point.
    """
    reach = _running("transform(m_s, x -> cast(x.stop as long))", "greatest({t}, {x})")
    cuts = _let("m_s", f"`{spans}`", _let("m_r", reach, (
        "filter(transform(m_s, (s, i) -> named_struct('start', s.start, 'reach', m_r[i],"
        " 'first', i = 0)), s -> s.first or s.start > s.reach)")))

    def piece(start: str, stop: str, plain: bool) -> str:
        width = 1 if plain else 4
        found = (f"substring(m_b, cast({start} * {width} + 1 as int),"
                 f" cast(({stop} - {start}) * {width} as int))")
        # A mark of the byte order in front is dropped, and spares one that the text begins with.
        return f"cast({found} as string)" if plain else f"decode(concat(X'0000FEFF', {found}), 'UTF-32')"

    def joined(plain: bool) -> str:
        data = f"cast(`{text}` as binary)" if plain else f"encode(`{text}`, 'UTF-32')"
        return _let("m_b", data, (
            f"concat(array_join(transform(_cuts, s -> {piece('s.reach', 's.start', plain)}),"
            f" {_quoted(MASK)}), {_quoted(MASK)}, {piece('_end', '_length', plain)})"))

    plain = f"octet_length(`{text}`) = _length"
    return (
        docs.withColumn("_cuts", F.expr(cuts))
        .withColumn("_end", F.expr(f"array_max(transform(`{spans}`, s -> cast(s.stop as long)))"))
        .withColumn("_length", F.length(text))
        .withColumn(text, F.when(F.size("_cuts") == 0, F.col(text)).otherwise(F.expr(
            f"if({plain}, {joined(True)}, {joined(False)})")))
        .drop("_cuts", "_end", "_length"))
