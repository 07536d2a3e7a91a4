"""Secrets in texts: known shapes, and any token that passes a battery of randomness tests.

Base spans come from three patterns (assignments, access keys, long hexadecimal runs). The
method adds spans of kind ``random``:

1. Candidates are runs of encoding characters of ``MIN_CHARS`` or more that hold letters and digits.
2. The encoding is inferred from the characters: hexadecimal, base 32, alphanumeric or base 64.
3. Tests against a uniform random string over that alphabet: chi-squared of the character
   counts and of the counts of digits, capitals and small letters, the Wald-Wolfowitz number of runs above and below the
   alphabet's middle, and the lag-one serial correlation of the characters' numbers. A candidate that one of them rejects at
   ``REJECT`` is no secret.
4. What is left is held against ordinary text: by the chi-squared statistic, when two characters are equal as often
   as in prose (``TEXT_SAME``, at least twice as often as in a uniform alphabet), which must be improbable at
   ``FALSE_SHARE``; and by the cost of its pairs of neighbours (``PAIR_COST``: bits of a letter after a letter in
   prose, and fixed ones for digits, separators and capitals within words) against the mean cost in
   ordinary tokens (``HEX_MEAN`` for hexadecimal ones, as ordinary tokens of those characters are mostly numbers). A weighted Benjamini-Hochberg step on the second p-value, over the candidates of a document that
   no test of step 3 rejects, with weights that grow with length up to ``FULL_CHARS``, keeps the share of
   false finds below ``FALSE_SHARE``. That p-value is so small for keys that hundreds of ordinary tokens do not hide them.

A candidate with separators is also cut at them, and the pieces are candidates of their own; a piece inside a candidate that is found
whole is not listed again.

All of it is expressions over arrays of one row: no shuffle and no Python. Positions come from
the lengths of the pieces between matches.

Defined cases. Null counts as empty: no spans, ``base_sha256`` of the empty string. Repeated rows are scanned
each on its own, extra columns stay. A random span inside a base span is not listed again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.llm.common import hidden, sha256_hex

# The base patterns, in the order of their kinds.
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_CHARS = 8
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_CHARS = 16
HEX = r"[0-9a-f]+"
HEX_CHARS = 32
KINDS = ("assign", "access", "hex", "random")

MIN_CHARS = 20
FULL_CHARS = 40
REJECT = 0.001
FALSE_SHARE = 0.05
TEXT_SAME = 0.065
# Cost of the pairs of the costliest usual tokens (short words joined by capitals, with numbers), spread widened.
PAIR_MEAN = 4.3
HEX_MEAN = 3.3
PAIR_SPREAD = 2.1
DIGITS_COST, MIXED_COST, SEPARATOR_COST, CAPITAL_COST = 3, 7, 4, 4
# Minus log2 of the share of a letter after a letter, rounded, a row of 26 for each first letter.
PAIR_COST = (
    "66555977498562679442488979699929995791994995894999495979399129959939989469999945971995399695399654696999"
    "37645986499572688235688897488935863997982993735999573689297349969457935478699726891985499695499654896999"
    "65473668799662389643969999099939999999996999995999998999099949979599994999999939971999399399699978699929"
    "35991999299969449949599999466339355986854886427769787876737959975186925637799929994398599499449395499949"
    "99999999999999999999099999366819754966554794547869685747398248977747865259799957994991299797499566997976"
    "55562786598563578443978399599919992999994999999999993999699139999739979999999939392997499669445493969979"
    "4699399449959428944499699956564957677669887655179996"
)

HEX_ALPHABET = "0123456789abcdef"
BASE32_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
LOWER_ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyz"
UPPER_ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALNUM_ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE64_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
URL64_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"

CLASSES = (ALNUM_ALPHABET[:10], ALNUM_ALPHABET[10:36], ALNUM_ALPHABET[36:])

# The first encoding that all characters fit is inferred.
ENCODINGS = (
    ("hex", HEX_ALPHABET),
    ("HEX", HEX_ALPHABET.upper()),
    ("base32", BASE32_ALPHABET),
    ("base36", LOWER_ALPHABET),
    ("BASE36", UPPER_ALPHABET),
    ("base62", ALNUM_ALPHABET),
    ("base64", BASE64_ALPHABET),
    ("base64url", URL64_ALPHABET),
)


def _spans(text: Column, pattern: str, kind: int, at_least: int, group: int = 0) -> Column:
    """Matches of a pattern as (start, kind, stop, value); positions in code points.

    The pieces between matches and the matches themselves alternate, so their running lengths are
    the positions. Matches shorter than ``at_least`` are passed over, not cut out of the search.
    """
    whole = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    value = whole if not group else F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1 + group))
    gaps = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<start:int,kind:int,stop:int,value:string>>")
    walk = F.aggregate(
        F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("whole"), value.alias("value")),
        F.struct(F.lit(0).alias("at"), empty.alias("found")),
        lambda s, m: F.struct(
            (s["at"] + F.length(m["gap"]) + F.length(m["whole"])).alias("at"),
            F.when(
                F.length(m["value"]) >= at_least,
                F.array_append(
                    s["found"],
                    F.struct(
                        (s["at"] + F.length(m["gap"])).alias("start"),
                        F.lit(kind).alias("kind"),
                        (s["at"] + F.length(m["gap"]) + F.length(m["whole"])).alias("stop"),
                        m["value"].alias("value"),
                    ),
                ),
            )
            .otherwise(s["found"])
            .alias("found"),
        ),
        lambda s: s["found"],
    )
    return F.when(F.regexp_like(text, F.lit(pattern)), walk).otherwise(empty)


def _erfc(x: Column) -> Column:
    """Complementary error function of a number of 0 or more (Numerical approximation, error below 2e-7)."""
    t = 1 / (1 + x / 2)
    terms = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)
    poly = F.lit(0.0)
    for c in reversed(terms):
        poly = poly * t + F.lit(c)
    return t * F.exp(-x * x + poly)


def _two_sided(z: Column) -> Column:
    return _erfc(F.abs(z) / math.sqrt(2))


def _upper(z: Column) -> Column:
    tail = _erfc(F.abs(z) / math.sqrt(2)) / 2
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _cube_root_z(x: Column, degrees: Column) -> Column:
    """Normal value of a chi-squared statistic (Wilson-Hilferty)."""
    spread = F.lit(2.0) / (degrees * 9)
    return (F.pow(F.greatest(x, F.lit(1e-9)) / degrees, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)


def _alphabet(value: Column) -> Column:
    """Alphabet of the first encoding that all characters fit; null if none does."""
    found = F.lit(None).cast("string")
    for _, alphabet in reversed(ENCODINGS):
        found = F.when(F.length(F.translate(value, alphabet, "")) == 0, F.lit(alphabet)).otherwise(found)
    return found


def _measures(value: Column, alphabet: Column) -> Column:
    """Chi-squared of the character counts, and sums over the characters' numbers in order."""
    k = F.length(alphabet).cast("double")
    n = F.length(value).cast("double")
    # Equal characters lie side by side once sorted; the r-th of them adds r^2 - (r - 1)^2.
    squares = F.aggregate(
        F.array_sort(F.split(value, "")),
        F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("run"), F.lit("").alias("last")),
        lambda s, c: F.struct(
            (s["sum"] + F.when(c == s["last"], 2 * s["run"] + 1).otherwise(1.0)).alias("sum"),
            F.when(c == s["last"], s["run"] + 1).otherwise(1.0).alias("run"),
            c.alias("last"),
        ),
        lambda s: s["sum"],
    )
    # Numbers around zero: above and below the middle of the alphabet.
    numbers = F.transform(F.split(value, ""), lambda c: F.instr(alphabet, c) - 1 - (k - 1) / 2)
    zero = F.lit(0.0)
    walk = F.aggregate(
        numbers,
        F.struct(
            *[zero.alias(x) for x in ("high", "turns", "cross", "total", "square")], F.lit(None).cast("double").alias("last")
        ),
        lambda s, x: F.struct(
            (s["high"] + (x > 0).cast("double")).alias("high"),
            (s["turns"] + F.coalesce((x > 0) != (s["last"] > 0), F.lit(False)).cast("double")).alias("turns"),
            (s["cross"] + x * F.coalesce(s["last"], zero)).alias("cross"),
            (s["total"] + x).alias("total"),
            (s["square"] + x * x).alias("square"),
            x.alias("last"),
        ),
    )
    return F.struct(
        k.alias("k"), n.alias("n"), (squares * k / n - n).alias("chi"), _class_test(value, alphabet).alias("classes"), walk.alias("w")
    )


def _class_test(value: Column, alphabet: Column) -> Column:
    """p-value of the numbers of digits, capitals and small letters, by chi-squared."""
    k, n = F.length(alphabet).cast("double"), F.length(value).cast("double")
    chi, classes, covered = F.lit(0.0), F.lit(0.0), F.lit(0.0)
    for chars in CLASSES:
        size = k - F.length(F.translate(alphabet, chars, ""))
        seen = n - F.length(F.translate(value, chars, ""))
        usual = F.greatest(size, F.lit(1.0)) * n / k
        chi = chi + F.when(size > 0, (seen - usual) * (seen - usual) / usual).otherwise(0.0)
        classes = classes + (size > 0).cast("double")
        covered = covered + size
    return _upper(_cube_root_z(chi, F.greatest(classes - (covered == k).cast("double"), F.lit(1.0))))


def _p_values(m: Column) -> Column:
    """(fit: smallest p-value against a random string, text: p-value against prose)."""
    n, k, chi, w = m["n"], m["k"], m["chi"], m["w"]
    mean = 2 * w["high"] * (n - w["high"]) / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    runs = F.when(var > 0, _two_sided((w["turns"] + 1 - mean) / F.sqrt(var))).otherwise(0.0)
    centre = w["total"] / n
    spread = w["square"] - n * centre * centre
    lag = (w["cross"] - n * centre * centre) / spread + 1 / n
    serial = F.when(spread > 0, _two_sided(lag * F.sqrt(n))).otherwise(0.0)
    uniform = _upper(_cube_root_z(chi, k - 1))
    # In prose two characters are the same with probability TEXT_SAME: a shifted, wider chi-squared.
    far = n * (F.greatest(k * TEXT_SAME, F.lit(2.0)) - 1)
    text_z = (chi - (k - 1 + far)) / F.sqrt(2 * (k - 1) + 4 * far)
    # No words are made of hexadecimal characters alone, so there is no prose to hold those against.
    prose = F.when(k == len(HEX_ALPHABET), 0.0).otherwise(1 - _upper(text_z))
    return F.struct(F.least(uniform, m["classes"], runs, serial).alias("fit"), prose.alias("text"))


def _pair_p(value: Column, k: Column) -> Column:
    """p-value of the mean cost of neighbours against ordinary tokens of an alphabet of k characters."""
    between = lambda x, a, b: (x >= a) & (x <= b)
    digit = lambda x: between(x, "0", "9")
    letter = lambda x: between(F.lower(x), "a", "z")
    at = lambda x: F.ascii(F.lower(x)) - ord("a")

    def cost(x: Column, y: Column) -> Column:
        return (
            F.when(digit(x) & digit(y), DIGITS_COST)
            .when((digit(x) & letter(y)) | (letter(x) & digit(y)), MIXED_COST)
            .when(digit(x) | digit(y), DIGITS_COST)
            .when(~letter(x) | ~letter(y), SEPARATOR_COST)
            .when(between(x, "a", "z") & between(y, "A", "Z"), CAPITAL_COST)
            .otherwise(F.substring(F.lit(PAIR_COST), 26 * at(x) + at(y) + 1, F.lit(1)).cast("int"))
        )

    total = F.aggregate(
        F.split(value, ""),
        F.struct(F.lit(0).alias("n"), F.lit(None).cast("string").alias("last")),
        lambda s, c: F.struct((s["n"] + F.when(s["last"].isNull(), 0).otherwise(cost(s["last"], c))).alias("n"), c.alias("last")),
        lambda s: s["n"],
    )
    pairs = (F.length(value) - 1).cast("double")
    usual = F.when(k == len(HEX_ALPHABET), HEX_MEAN).otherwise(PAIR_MEAN)
    return _upper((total - pairs * usual) / (F.sqrt(pairs) * PAIR_SPREAD))


CANDIDATE = r"[A-Za-z0-9+/_-]{%d,}+" % MIN_CHARS
PIECE = r"[A-Za-z0-9]{%d,}+" % MIN_CHARS
SEPARATORS = r"[+/_-]"


def _with_random(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the spans of random tokens, step by step so that no step is worked out twice."""
    steps = [hidden(f"step{i}") for i in range(5)]
    whole, pieces = hidden("whole"), hidden("pieces")
    cand, measured, tested, ordered, limit = (F.col(x) for x in steps)

    def mixed(value: Column, pattern: str) -> Column:
        return F.filter(
            _spans(value, pattern, KINDS.index("random"), MIN_CHARS),
            lambda m: F.regexp_like(m["value"], F.lit("[0-9]")) & F.regexp_like(m["value"], F.lit("[A-Za-z]")),
        )

    spelled = lambda x: F.transform(x, lambda m: F.struct(m.alias("m"), _alphabet(m["value"]).alias("a")))

    def moved(m: Column, by: Column) -> Column:
        return F.struct((m["start"] + by).alias("start"), m["kind"].alias("kind"), (m["stop"] + by).alias("stop"), m["value"].alias("value"))

    def parts(c: Column) -> Column:
        return spelled(F.transform(mixed(c["m"]["value"], PIECE), lambda m: moved(m, c["m"]["start"])))

    df = df.withColumn(whole, spelled(mixed(F.col(text), CANDIDATE)))
    df = df.withColumn(
        pieces, F.flatten(F.transform(F.filter(F.col(whole), lambda c: F.regexp_like(c["m"]["value"], F.lit(SEPARATORS))), parts))
    )
    weight = lambda m: F.least(F.lit(1.0), F.length(m["value"]) / F.lit(float(FULL_CHARS)))
    out = (
        df.withColumn(steps[0], F.concat(whole, pieces))
        .withColumn(
            steps[1],
            F.transform(
                F.filter(cand, lambda c: c["a"].isNotNull()),
                lambda c: F.struct(c["m"].alias("m"), _measures(c["m"]["value"], c["a"]).alias("x")),
            ),
        )
        .withColumn(steps[2], F.transform(measured, lambda c: F.struct(c["m"].alias("m"), c["x"]["k"].alias("k"), _p_values(c["x"]).alias("p"))))
        .withColumn(
            steps[3],
            F.array_sort(
                F.transform(
                    F.filter(tested, lambda t: t["p"]["fit"] >= REJECT),
                    lambda t: F.struct(
                        (_pair_p(t["m"]["value"], t["k"]) / weight(t["m"])).alias("q"),
                        (t["p"]["text"] / weight(t["m"])).alias("text"),
                        t["m"].alias("m"),
                    ),
                )
            ),
        )
        .withColumn(
            steps[4],
            F.aggregate(
                F.transform(ordered, lambda t, i: F.when(t["q"] <= (i + 1) * F.lit(FALSE_SHARE) / F.size(ordered), t["q"])),
                F.lit(-1.0),
                lambda s, q: F.greatest(s, F.coalesce(q, F.lit(-1.0))),
            ),
        )
    )
    passed = F.filter(ordered, lambda t: (t["q"] <= limit) & (t["text"] <= FALSE_SHARE))
    # By start, the longest first: a span that ends within the one before lies inside it.
    ordered_spans = F.array_sort(F.transform(passed, lambda t: F.struct(t["m"]["start"].alias("start"), (-t["m"]["stop"]).alias("stop"), t["m"].alias("m"))))
    outer = F.aggregate(
        ordered_spans,
        F.struct(F.lit(0).alias("upto"), F.filter(F.transform(passed, lambda t: t["m"]), lambda m: F.lit(False)).alias("kept")),
        lambda s, x: F.struct(
            F.greatest(s["upto"], x["m"]["stop"]).alias("upto"),
            F.when(x["m"]["stop"] > s["upto"], F.array_append(s["kept"], x["m"])).otherwise(s["kept"]).alias("kept"),
        ),
        lambda s: s["kept"],
    )
    return out.withColumn(name, outer).drop(*steps, whole, pieces)


def with_secrets(docs: DataFrame, name: str = "secrets", text_col: str = "text") -> DataFrame:
    """Add a struct column ``name``: base and all spans as arrays of (start, kind, stop), in order."""
    text, known, random = hidden("text"), hidden("known"), hidden("random")
    read = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    base = F.concat(
        _spans(F.col(text), ASSIGN, 0, ASSIGN_CHARS, 1),
        _spans(F.col(text), ACCESS, 1, ACCESS_CHARS),
        # Runs are never cut, so a run of enough characters is a match of enough characters.
        _spans(F.col(text), "[0-9a-f]{%d,}+" % HEX_CHARS, 2, HEX_CHARS),
    )
    spans = _with_random(read.withColumn(known, F.array_sort(F.transform(base, _plain))), text, random)
    extra = F.filter(
        F.transform(F.col(random), _plain),
        lambda r: ~F.exists(F.col(known), lambda b: (b["start"] <= r["start"]) & (r["stop"] <= b["stop"])),
    )
    every = F.when(F.size(F.col(random)) > 0, F.array_sort(F.concat(F.col(known), extra))).otherwise(F.col(known))
    return spans.withColumn(name, F.struct(F.col(known).alias("base"), every.alias("spans"))).drop(text, known, random)


def _plain(m: Column) -> Column:
    return F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["stop"].alias("stop"))


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, the digest of the base spans, all spans."""
    got = hidden("secrets")
    found = with_secrets(docs.select(id_col, text_col), got, text_col)
    count = lambda kind: F.size(F.filter(F.col(got)["base"], lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        id_col,
        *[count(i).alias(f"n_{KINDS[i]}") for i in range(3)],
        sha256_hex(_listed(F.col(got)["base"])).alias("base_sha256"),
        _listed(F.col(got)["spans"]).alias("spans"),
    )


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Replace every span, overlapping ones together, by ``mark``. Null texts stay null."""
    got = hidden("secrets")
    found = with_secrets(docs, got, text_col)
    text = F.col(text_col)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    walk = F.aggregate(
        F.col(got)["spans"],
        start,
        lambda s, x: F.when(x["stop"] <= s["at"], s)
        .when(
            (x["start"] < s["at"]),
            F.struct(x["stop"].alias("at"), s["out"].alias("out")),
        )
        .otherwise(
            F.struct(
                x["stop"].alias("at"),
                F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(mark)).alias("out"),
            )
        ),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
    )
    clean = F.when(F.size(F.col(got)["spans"]) > 0, walk).otherwise(text)
    return found.withColumn(text_col, clean).select(*docs.columns)
