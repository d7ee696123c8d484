"""Secret scan in built-in functions only: fixed formats, and a battery of randomness tests on opaque tokens.

Opaque tokens (runs of 20 or more letters, digits, + / _ = -) are tested, without - _ =, in the alphabet of their inferred encoding:
chi-squared for uniform use of the alphabet, runs above and below its middle, and serial correlation; letters of one case
also for pairs that are frequent in text. Tokens of digits only are not reported: dates and running numbers look as random. Alphabets are
in the order in which text uses their letters, and the chi-squared test joins neighbours into cells of five expected
symbols or more, so that it tells text from random symbols in short tokens too. The p-values are combined (Fisher). Words joined to tokens of the same length and encoding give the distribution of
the combined value for text; a token's p-value against it is controlled for false discoveries (Benjamini-Hochberg)
separately in each length class, and for letters of one case apart, since short tokens of text look random more often than long ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genespark.llm.util import materialize

# The formats of the base kinds, in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
OPAQUE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
# Encodings as (name, pattern, alphabet), the first that fits is taken.
_DIGIT, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Letters, most frequent in text first.
_OFTEN = "etaoinsrhldcumfpgwybvkxjqz"
ENCODINGS = (
    ("digits", "^[0-9]+$", _DIGIT),
    ("hex", "^[0-9a-f]+$", _DIGIT + "abcdef"),
    ("HEX", "^[0-9A-F]+$", _DIGIT + "ABCDEF"),
    ("word", "^[A-Za-z]?[a-z]+$", _LOWER),
    ("WORD", "^[A-Z]+$", _UPPER),
    ("base32", "^[A-Z2-7]+=*$", _UPPER + "234567"),
    ("BASE36", "^[A-Z0-9]+$", _DIGIT + _UPPER),
    ("base36", "^[a-z0-9]+$", _DIGIT + _LOWER),
    ("base62", "^[A-Za-z0-9]+$", _DIGIT + _UPPER + _LOWER),
    ("base64", "^[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGIT + "+/"),
)
# What joins the parts of names, dates and numbers; it is left off before the encoding is inferred.
SEPARATORS = "[-_=]"
# Encodings of letters of one case, which are tested for pairs of letters too.
PROSE = ("word", "WORD")
# Pairs of letters that are frequent in text of some European languages.
PAIRS = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur ei ie ge un qu el la ta ue os do da em us ec et ai".split()
BINS = 200
BLOCK = 256
CELL = 5  # symbols that a cell of the chi-squared test is to expect at least
# What tokens that are text are made of, and the last length class that is made.
STYLES = ("hex", "HEX", "word", "WORD", "base32", "BASE36", "base36", "base62", "base64", "base64url", "mixed")
WORDS = (
    "the of and to in is that for was with this from have which not are one all were there been their more will when who would time people first get name user data file list value type index table page item key node test view build set find read write order group service config request "
    "der die und das nicht von sie ist des sich mit dem auch als nach wird bei einer zeit jahr haus strasse les que une dans pour pas sur avec plus par leur mais comme nous tout deux temps monde los del las por con para como pero sus sobre entre cuando hasta desde todo tiempo mundo"
).split()
LONGEST = 8


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, token>> of the leftmost non-overlapping matches, in code points.

    The gaps between matches come from splitting at the same pattern, so lengths of gaps and matches add up to offsets.
    """
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.transform(F.slice(gaps, 1, F.size(found)), F.length).alias("gap"), found.alias("token"))
    none = F.array().cast("array<struct<start:int,end:int,token:string>>")
    place = lambda a, b, token: F.struct(a.alias("start"), b.alias("end"), token.alias("token"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["token"])
        return F.struct(end.alias("at"), F.array_append(acc["out"], place(start, end, x["token"])).alias("out"))

    # an append copies the array: folds over blocks of matches, then over blocks, are not quadratic in the matches of a text
    of_block = lambda b: F.aggregate(b, F.struct(F.lit(0).alias("at"), none.alias("out")), step)
    blocks = _let(pairs, lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / BLOCK).cast("int")), lambda k: of_block(F.slice(p, k * BLOCK + 1, F.lit(BLOCK)))))
    before = lambda b: F.aggregate(b, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"])
    shifted = _let(blocks, lambda b: F.flatten(F.zip_with(b, before(b), lambda x, at: F.transform(x["out"], lambda s: place(s["start"] + at, s["end"] + at, s["token"])))))
    return F.when(text.rlike(pattern), shifted).otherwise(none)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _erfc(x: Column) -> Column:
    """Complementary error function for x >= 0 (rational approximation, error below 2e-7)."""
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return poly * F.exp(-x * x)


def _two_sided(z: Column) -> Column:
    return F.greatest(_erfc(F.abs(z) / 2**0.5), F.lit(1e-12))


def _upper(z: Column) -> Column:
    half = _erfc(F.abs(z) / 2**0.5) / 2
    return F.greatest(F.when(z >= 0, half).otherwise(1 - half), F.lit(1e-12))


def battery(spans: Column) -> Column:
    """For each span: start, end, encoding, n and p, the combined p-value of randomness in its encoding."""
    body = lambda s: F.when(s["token"].rlike("^[A-Z][a-z]+$"), F.lower(s["token"])).otherwise(s["token"])
    often = F.array(*(F.lit(x) for x in PAIRS))
    name = lambda s: F.coalesce(*(F.when(s["token"].rlike(p), F.lit(n)) for n, p, _ in ENCODINGS), F.lit("mixed"))
    mixed = _UPPER + _LOWER + _DIGIT + "+/-_="
    rank = {c: k for k, c in enumerate(_OFTEN + _OFTEN.upper() + _DIGIT)}
    alphabet = F.create_map(*(F.lit(x) for n, _, a in (*ENCODINGS, ("mixed", "", mixed)) for x in (n, "".join(sorted(a, key=lambda c: (rank.get(c, len(rank)), c))))))

    def codes(s: Column) -> Column:
        encoding = name(s)
        letters = F.element_at(alphabet, encoding)
        chars = F.filter(F.split(body(s), ""), lambda c: c != "")
        # frequent pairs, of letters of one case only
        pair = lambda t: F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.length(t) - 1, F.lit(1))), lambda i: F.array_contains(often, t.substr(i, F.lit(2)))))
        pairs = F.when(encoding.isin(*PROSE), pair(F.lower(s["token"]))).otherwise(0).cast("double")
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), encoding.alias("encoding"), F.length(letters).cast("double").alias("k"), F.transform(chars, lambda c: F.instr(letters, c)).alias("x"), pairs.alias("pairs"))

    def sums(s: Column) -> Column:
        n = F.size(s["x"]).cast("double")
        # cells of neighbouring symbols; the chi-squared sum over those that occur, each with its share of the alphabet
        cells = F.least(F.greatest(F.floor(n / CELL), F.lit(2).cast("long")).cast("double"), s["k"])
        cell = F.transform(s["x"], lambda c: F.floor((c - 1) * cells / s["k"]))
        share = lambda j: (F.ceil((j + 1) * s["k"] / cells) - F.ceil(j * s["k"] / cells)) / s["k"]
        squares = _let(cell, lambda own: F.aggregate(F.array_distinct(own), F.lit(0.0), lambda acc, j: acc + F.pow(F.size(F.filter(own, lambda y: y == j)).cast("double"), F.lit(2.0)) / (n * share(j))))
        total = F.aggregate(s["x"], F.lit(0.0), lambda acc, c: acc + c)
        square = F.aggregate(s["x"], F.lit(0.0), lambda acc, c: acc + c.cast("double") * c)
        ahead = F.slice(s["x"], F.lit(2), F.greatest(F.size(s["x"]) - 1, F.lit(0)))
        back = F.slice(s["x"], F.lit(1), F.greatest(F.size(s["x"]) - 1, F.lit(0)))
        lag = F.aggregate(F.zip_with(back, ahead, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda acc, c: acc + c)
        middle = s["k"] / 2
        turns = F.size(F.filter(F.zip_with(back, ahead, lambda a, b: (a > middle) != (b > middle)), lambda c: c)).cast("double")
        high = F.size(F.filter(s["x"], lambda c: c > middle)).cast("double")
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["encoding"].alias("encoding"), s["k"].alias("k"), n.alias("n"), cells.alias("cells"), squares.alias("oo"), total.alias("sx"), square.alias("sxx"), lag.alias("lag"),
            turns.alias("turns"), high.alias("high"), F.element_at(s["x"], 1).cast("double").alias("first"), F.element_at(s["x"], -1).cast("double").alias("last"), s["pairs"].alias("pairs"),
        )

    def p(s: Column) -> Column:
        n, free = s["n"], s["cells"] - 1
        # the tail of chi-squared by the cube root, which is near to normal for few degrees of freedom too
        p_chi = _upper((F.cbrt(F.greatest(s["oo"] - n, F.lit(0.0)) / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free)))
        low = n - s["high"]
        mean = 2 * s["high"] * low / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        # no symbol on one side of the middle is as non-random as it gets for this length
        p_runs = F.when(var > 0, _two_sided((s["turns"] + 1 - mean) / F.sqrt(F.greatest(var, F.lit(1e-9))))).otherwise(F.greatest(F.pow(F.lit(0.5), n - 1), F.lit(1e-12)))
        m = s["sx"] / n
        spread = s["sxx"] - n * m * m
        r = (s["lag"] - m * (2 * s["sx"] - s["first"] - s["last"]) + (n - 1) * m * m) / F.greatest(spread, F.lit(1e-9))
        p_serial = F.when(spread > 0, _two_sided((r + 1 / (n - 1)) * F.sqrt(n))).otherwise(F.lit(1e-12))
        half = -(F.log(p_chi) + F.log(p_runs) + F.log(p_serial))
        fisher = F.exp(-half) * (1 + half + half * half / 2)
        # letters of one case: a fourth test, of more frequent pairs than random letters have
        rare = len(PAIRS) / 26**2
        p_pairs = _upper((s["pairs"] - (n - 1) * rare) / F.sqrt((n - 1) * rare * (1 - rare)))
        more = half - F.log(p_pairs)
        fisher = F.when(s["encoding"].isin(*PROSE), F.exp(-more) * (1 + more + more * more / 2 + more * more * more / 6)).otherwise(fisher)
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["encoding"].alias("encoding"), n.cast("int").alias("n"), F.least(F.greatest(fisher, F.lit(1e-30)), F.lit(1.0)).alias("p"))

    bare = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.regexp_replace(s["token"], SEPARATORS, "").alias("token")))
    enough = F.filter(F.transform(bare, codes), lambda s: F.size(s["x"]) >= 8)
    return F.transform(F.transform(enough, sums), p)


def length_class(n: Column) -> Column:
    """Classes 0, 1, 2, ... for token lengths up to 23, 31, 47, 63, 95, ..."""
    octave = F.floor(F.log2(n / 16.0))
    return F.least((2 * octave + (n >= 24 * F.pow(F.lit(2.0), octave)).cast("int")).cast("int"), F.lit(19))


def p_bin(p: Column) -> Column:
    """0 (least random) to BINS - 1, finer towards small values."""
    return F.least(F.greatest(F.floor(BINS + F.log10(p) * (BINS / 15)), F.lit(0)), F.lit(BINS - 1)).cast("int")


def null_tokens(spark: SparkSession, classes: list[int], each: int = 500) -> DataFrame:
    """(start, end, encoding, n, p) of made-up tokens that are text: `each` for each style of writing and length class.

    Words run on, with digits, capitals and separators so that every encoding gets some. They do not depend on the
    documents, so a table of any size has the same distribution. Classes over LONGEST share its tokens, which look
    random more often than longer ones.
    """
    lows = sorted({_class_start(min(c, LONGEST)) for c in classes})
    draw = lambda k, n, *salt: F.pmod(F.xxhash64("id", k, *(F.lit(x) for x in salt)), F.lit(n).cast("long")).cast("int")
    words, styles = F.array(*(F.lit(w) for w in WORDS)), F.array(*(F.lit(x) for x in STYLES))
    rows = spark.range(len(lows) * len(STYLES) * each).select("id", F.get(styles, (F.col("id") % len(STYLES)).cast("int")).alias("style"), F.get(F.array(*(F.lit(x) for x in lows)), (F.expr(f"id div {len(STYLES)}") % len(lows)).cast("int")).alias("low"))
    # a class ends below 3/2 or 4/3 of its start
    rows = rows.withColumn("n", (F.col("low") + F.floor(draw(F.lit(0), 1000, "n") * F.col("low") / 3000)).cast("int"))

    def piece(k: Column) -> Column:
        word, style = F.get(words, draw(k, len(WORDS), "w")), F.col("style")
        word = F.when(style.isin("HEX", "base32", "BASE36", "WORD"), F.upper(word)).when(style.isin("base36", "hex", "word"), word).when(draw(k, 3, "c") == 0, F.initcap(word)).otherwise(word)
        word = F.when(style == "hex", F.translate(word, _LOWER, "abcdefabcdefabcdefabcdefab")).when(style == "HEX", F.translate(word, _UPPER, "ABCDEFABCDEFABCDEFABCDEFAB")).otherwise(word)
        number = F.when(draw(k, 2, "d") == 0, F.substring(draw(k, 9000, "x").cast("string"), 1, 3)).otherwise("")
        number = F.when(style == "base32", F.translate(number, "0189", "2345")).when(style.isin(*PROSE), "").otherwise(number)
        sep = F.when(style == "base64", "/").when(style == "base64url", F.when(draw(k, 2, "s") == 0, "-").otherwise("_")).when(style == "mixed", F.when(draw(k, 2, "s") == 0, "/").otherwise("-")).otherwise("")
        return F.concat(word, number, sep)

    token = F.array_join(F.transform(F.sequence(F.lit(1), F.expr("n div 2 + 2")), piece), "").substr(F.lit(1), F.col("n"))
    return rows.select(F.inline(battery(F.array(F.struct(F.lit(0).alias("start"), F.col("n").alias("end"), token.alias("token"))))))


def _class_start(c: int) -> int:
    return int((24 if c % 2 else 16) * 2.0 ** (c // 2))


def cuts(tokens: DataFrame, alpha: float, reject: float) -> dict[tuple[str, int], int]:
    """The least bin to report for each encoding and length class, from counts by both and bin (at most 10 x 22 x BINS rows).

    Tokens with a p-value below `reject` are not random by the battery itself, however little text looks like them: they
    are tested, but no discovery.

    A token's p-value is the share of null tokens of its encoding and class that look as random, counted as far as
    ten of them do; from there on it falls as the normal distribution of their log10 p does, so it has no least
    value that the number of null tokens sets.
    """
    opaque = F.col("encoding") != "digits"
    count = lambda t: t.where(opaque).groupBy("encoding", length_class(F.col("n")).alias("c"), p_bin(F.col("p")).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.log10("p")).alias("x"), F.sum(F.pow(F.log10("p"), F.lit(2.0))).alias("xx")).collect()
    rows = count(tokens)
    if not rows:
        return {}
    null: dict[tuple[str, int], list] = {}
    for r in count(null_tokens(tokens.sparkSession, sorted({r.c for r in rows}))):
        null.setdefault((r.encoding, r.c), []).append(r)

    def p0(encoding: str, c: int, b: int) -> float:
        own = null.get((encoding, min(c, LONGEST))) or [r for (_, k), x in null.items() if k == min(c, LONGEST) for r in x]
        n = sum(r.n for r in own)
        mean = sum(r.x for r in own) / n
        spread = max((sum(r.xx for r in own) / n - mean * mean) ** 0.5, 1.0)
        beyond = lambda k: math.erfc(((k - BINS) * 15 / BINS - mean) / spread / 2**0.5) / 2
        tail = lambda k: sum(r.n for r in own if r.b >= k)
        last = max((r.b for r in own if tail(r.b) >= 10), default=0)
        return tail(b) / n if b <= last else tail(last) / n * beyond(b) / max(beyond(last), 1e-300)

    out: dict[tuple[str, int], int] = {}
    floor = min(max(math.ceil(BINS + math.log10(reject) * BINS / 15), 0), BINS - 1)
    # words, which are letters of one case, are many: they are controlled apart, so that they do not hide other tokens
    for c, prose in sorted({(r.c, r.encoding in PROSE) for r in rows}):
        ranked = sorted((p0(r.encoding, c, r.b) if r.b >= floor else 1.0, r.encoding, r.b, r.n) for r in rows if r.c == c and (r.encoding in PROSE) == prose)
        total, seen, most = sum(x[3] for x in ranked), 0, -1.0
        for k, x in enumerate(ranked):
            seen += x[3]
            if (k + 1 == len(ranked) or ranked[k + 1][0] > x[0]) and total * x[0] <= alpha * seen:
                most = x[0]
        for p, encoding, b, _ in ranked:
            if p <= most:
                out[encoding, c] = max(floor, min(b, out.get((encoding, c), b)))
    return out


def scan(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, alpha: float = 0.05, reject: float = 0.001) -> DataFrame:
    """Adds assign, access, hex (arrays of the base spans) and random (spans that the battery finds outside those).

    Offsets are code points, ends exclusive. Null texts are empty. An empty table gives an empty result. Repeated rows are
    scanned each, and count each in the control of false discoveries; texts of any length are scanned whole. The
    distribution of text is that of made-up tokens, the control of false discoveries is over all documents given.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (*KINDS, "random")]
    t = F.coalesce(F.col("t"), F.lit(""))
    assign = F.filter(matches(t, ASSIGN), lambda s: F.length(F.regexp_extract(s["token"], ASSIGN_VALUE, 1)) >= 8)
    access = F.filter(matches(t, ACCESS), lambda s: F.length(s["token"]) >= 16)
    bare = lambda a: F.transform(a, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)), F.col(f"`{text}`").cast("string").alias("t"))
    rows = rows.select(*(f"c{i}" for i in range(len(keep))), bare(assign).alias("assign"), bare(access).alias("access"), bare(matches(t, HEX)).alias("hex"), battery(matches(t, OPAQUE)).alias("tokens"))
    rows = materialize(rows, "secrets")
    least = cuts(rows.select(F.inline("tokens")), alpha, reject)
    cut = F.create_map(*(F.lit(x) for (e, c), b in sorted(least.items()) for x in (f"{e} {c}", b))) if least else F.create_map().cast("map<string,int>")
    base = F.concat("assign", "access", "hex")
    free = lambda s: ~F.exists(base, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]))
    good = lambda s: (s["encoding"] != "digits") & F.coalesce(p_bin(s["p"]) >= F.try_element_at(cut, F.concat_ws(" ", s["encoding"], length_class(s["n"]).cast("string"))), F.lit(False))
    random = bare(F.filter("tokens", lambda s: good(s) & free(s)))
    return rows.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(keep)), *KINDS, random.alias("random"))


def listed(*kinds: str) -> Column:
    """kind:start:end by start, then in the order of `kinds`, comma-joined."""

    def tag(rank: int) -> Column:
        return F.transform(kinds[rank], lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))

    tagged = F.concat(*(tag(i) for i in range(len(kinds))))
    names = F.array(*(F.lit(k) for k in kinds))
    return F.array_join(F.transform(F.array_sort(tagged), lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
