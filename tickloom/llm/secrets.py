"""Secret scans, in DataFrame expressions only.

Base kinds are patterns with least lengths (``assign``, ``access``, ``hex``).
The method adds kind ``random``: tokens of key characters that look drawn at
random from an alphabet.

* Encoding: the first of decimal, hex, base32, base36 and base64 whose alphabet,
  in one letter case where it has one, holds all of a token's characters.
* Battery: a chi-squared test of counts over equal shares of the alphabet, a runs
  test of ranks above and below the middle, and the serial correlation of
  neighbouring ranks about the middle.
* Each test is read twice.  Against "uniform and independent" a token passes if
  no z-score is larger than ``BATTERY_Z``.  Against "written text" it gives a
  p-value: the chance that text of the token's length in that alphabet looks as
  uniform.  What the statistics are in text follows from the letters and pairs
  of neighbouring letters of all words of the corpus shorter than a token, and of a
  little built-in English, which is all there is in a corpus of keys alone.
* The three p-values are combined as three times the smallest, which holds
  whatever the tests' dependence.  Benjamini and Hochberg's rule is applied
  within each length class to all tokens of the corpus, so short tokens, which
  text can imitate, need more.  p-values are counted in whole bits: the driver
  sees at most ``MAX_BITS`` counts a class and 64 x 65 counts of letters,
  whatever the corpus.

A token that counts as a discovery and passes as uniform is a span, unless a
base span overlaps it.  Spans are half-open ranges of code points.

Edge cases: null is read as empty; empty and blank texts have no spans.
Repeated rows are scanned alike, and the tokens of each count.  An empty table
gives no rows.  All other columns of the table are passed on, but for columns
named like the result's, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.storage import stored

# The patterns of the base kinds and their least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

#: What the method tests.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
TOKEN_LEAST = 16
BATTERY_Z = 3.3
RATE = 0.001
MAX_BITS = 400
LENGTH_CLASSES = (20, 24, 32, 48, 64, 128)

_LOW, _HIGH, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# How often each letter, a to z, stands in a thousand letters of English text.
ENGLISH = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
#: Letters of such text that count beside those of the corpus: where it has no words, they stand for them.
BUILT_IN = 500
#: Pattern, alphabet, and the number of equal shares of it that the chi-squared test counts:
#: letters, or where an alphabet has both cases and digits the groups that tell these apart.
ENCODINGS = (
    ("^[0-9]+$", _DIGIT, 10),
    ("^[0-9a-f]+$", _DIGIT + "abcdef", 16),
    ("^[0-9A-F]+$", _DIGIT + "ABCDEF", 16),
    ("^[A-Z2-7]+$", _HIGH + "234567", 32),
    ("^[0-9a-z]+$", _DIGIT + _LOW, 36),
    ("^[0-9A-Z]+$", _DIGIT + _HIGH, 36),
    ("", _HIGH + _LOW + _DIGIT + "+/", 8),
)


def _spans(gaps: Column, found: Column) -> Column:
    """(start, end, found) of all matches, from the text between them and the matches."""
    pairs = F.filter(F.zip_with(gaps, found, lambda g, f: F.struct(F.length(g).alias("gap"), f.alias("found"))), lambda p: p["found"].isNotNull())
    empty = F.array().cast("array<struct<start:int,end:int,found:string>>")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        end = start + F.length(pair["found"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"), pair["found"].alias("found")))
        return F.struct(end.alias("at"), F.concat(state["spans"], one).alias("spans"))

    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda s: s["spans"])


def _core(token: Column) -> Column:
    """A token without padding, in the letters of plain base64; a '=' inside counts as the first."""
    return F.translate(F.regexp_replace(token, "=+$", ""), "-_=", "+/A")


def _encoding(core: Column) -> Column:
    """An index of ENCODINGS."""
    out = F.lit(len(ENCODINGS) - 1)
    for i, (pattern, *_) in reversed(list(enumerate(ENCODINGS[:-1]))):
        out = F.when(core.rlike(pattern), F.lit(i)).otherwise(out)
    return out


def pieces(documents: DataFrame) -> DataFrame:
    """(piece, times): what stands between blanks in all texts; tokens hold no blank, so each lies in one piece."""
    # one plain blank is split at without a regular expression, which is twenty times as fast
    found = documents.select(F.explode(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), " ")).alias("piece"))
    return found.where("piece <> ''").groupBy("piece").agg(F.count("*").alias("times"))


def _written(letters: str) -> list[float]:
    """The shares of an alphabet's letters in written text: capitals are one letter in twenty, digits one in thirty, the rest one in a thousand."""
    plain = {c: share / 1000 for c, share in zip(_LOW, ENGLISH, strict=True)}
    both = set(letters) & set(_LOW) and set(letters) & set(_HIGH)
    each = [plain[c] if c in plain else plain[c.lower()] / (20 if both else 1) if c.lower() in plain else 1 / 300 if c in _DIGIT else 1 / 2000 for c in letters]
    return [e / sum(each) for e in each]


def text_model(words: DataFrame) -> list[tuple[float, float, float, float]]:
    """How written text looks in each encoding.

    The sums of squares and of cubes of the shares' frequencies, the chance that
    neighbours lie on different sides of the middle, and their correlation
    about it; of all pieces (piece, times) that are shorter than a token.
    """
    words = words.where(F.length("piece") < TOKEN_LEAST)
    pairs = words.select("times", F.explode(F.expr("transform(sequence(1, length(piece)), i -> struct(substr(piece, i, 1) as one, substr(piece, i + 1, 1) as two))")).alias("pair"))
    letter = F.col("pair.one").rlike("[A-Za-z0-9+/]")
    counted = [(r.one, r.two, r.times) for r in pairs.where(letter).select("times", "pair.one", F.when(F.col("pair.two").rlike("[A-Za-z0-9+/]"), F.col("pair.two")).alias("two")).groupBy("one", "two").agg(F.sum("times").alias("times")).collect()]
    out = []
    for _, letters, shares in ENCODINGS:
        size, middle = len(letters), (len(letters) - 1) / 2
        fold = str if len(set(letters) & set(_LOW)) and len(set(letters) & set(_HIGH)) else (str.upper if set(letters) & set(_HIGH) else str.lower)
        rank = {c: i for i, c in enumerate(letters)}
        # written text whose neighbours have nothing to do with each other is counted beside the corpus
        held, above, mean, square = [0.0] * shares, 0.0, 0.0, 0.0
        for i, share in enumerate(_written(letters)):
            held[i * shares // size] += BUILT_IN * share
            above += share * (2 * i + 1 > size)
            mean, square = mean + share * (i - middle), square + BUILT_IN * share * (i - middle) ** 2
        switched, pairs_seen, product = BUILT_IN * 2 * above * (1 - above), float(BUILT_IN), BUILT_IN * mean * mean
        for one, two, times in counted:
            a, b = rank.get(fold(one)), rank.get(fold(two)) if two else None
            if a is not None:
                held[a * shares // size] += times
            if a is not None and b is not None:
                pairs_seen += times
                switched += times * ((2 * a + 1 > size) != (2 * b + 1 > size))
                product += times * (a - middle) * (b - middle)
                square += times * ((a - middle) ** 2 + (b - middle) ** 2) / 2
        frequency = [h / sum(held) for h in held]
        out.append((sum(f**2 for f in frequency), sum(f**3 for f in frequency), switched / pairs_seen, product / square))
    return out


def _length_class(core: Column) -> Column:
    out = F.lit(0)
    for least in LENGTH_CLASSES:
        out = out + (F.length(core) >= least).cast("int")
    return out


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def statistics(core: Column) -> Column:
    """encoding, n, shares, chi (the chi-squared sum), ones (ranks above the middle), runs, serial (the correlation about the middle)."""
    letters = F.array(*(F.lit(alphabet) for _, alphabet, _ in ENCODINGS))
    shares = F.array(*(F.lit(n) for *_, n in ENCODINGS))

    def ranks(e: Column) -> Column:
        alphabet = F.element_at(letters, e + 1)
        places = F.transform(F.split(core, ""), lambda c: F.instr(alphabet, c) - 1)
        return F.struct(e.alias("encoding"), F.length(alphabet).alias("size"), F.element_at(shares, e + 1).alias("shares"), F.filter(places, lambda r: r >= 0).alias("ranks"))

    def sums(t: Column) -> Column:
        size, middle = t["size"], (t["size"] - 1) / 2
        n = F.size(t["ranks"]).cast("double")
        counts = F.transform(F.sequence(F.lit(0), t["shares"] - 1), lambda b: F.size(F.filter(t["ranks"], lambda r: F.floor(r * t["shares"] / size) == b)).cast("double"))
        chi = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c) * t["shares"] / n - n
        begin = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("ones"), F.lit(0).alias("runs"), F.lit(0.0).alias("products"), F.lit(0.0).alias("squares"))

        def step(s: Column, r: Column) -> Column:
            above, was = 2 * r + 1 > size, 2 * s["last"] + 1 > size
            off = r - middle
            return F.struct(
                r.cast("int").alias("last"),
                (s["ones"] + above.cast("int")).alias("ones"),
                (s["runs"] + ((s["last"] < 0) | (above != was)).cast("int")).alias("runs"),
                (s["products"] + F.when(s["last"] < 0, 0.0).otherwise(off * (s["last"] - middle))).alias("products"),
                (s["squares"] + off * off).alias("squares"),
            )

        return F.struct(t["encoding"].alias("encoding"), n.alias("n"), t["shares"].alias("shares"), chi.alias("chi"), F.aggregate(t["ranks"], begin, step).alias("s"))

    def told(t: Column) -> Column:
        serial = t["s"]["products"] / F.greatest(t["s"]["squares"], F.lit(1e-9))
        return F.struct(t["encoding"].alias("encoding"), t["n"].alias("n"), t["shares"].alias("shares"), t["chi"].alias("chi"), t["s"]["ones"].cast("double").alias("ones"), t["s"]["runs"].cast("double").alias("runs"), serial.alias("serial"))

    return _let(_let(_let(_encoding(core), ranks), sums), told)


def passes_as_uniform(t: Column) -> Column:
    """Whether none of the three tests rejects that a token's characters are uniform and independent."""
    n, ones, free = t["n"], t["ones"], t["shares"] - 1
    share = 2 / (9 * free)
    z_chi = (F.cbrt(t["chi"] / free) - (1 - share)) / F.sqrt(share)
    mean = 2 * ones * (n - ones) / n + 1
    spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9)))
    return (ones > 0) & (ones < n) & (z_chi <= BATTERY_Z) & (F.abs(t["runs"] - mean) <= BATTERY_Z * spread) & (F.abs(t["serial"]) * F.sqrt(n) <= BATTERY_Z)


def _lower_tail(z: Column) -> Column:
    """The normal distribution function, by Zelen and Severo's polynomial."""

    def tail(v: Column) -> Column:
        x = F.least(F.abs(v), F.lit(37.0))
        t = 1 / (1 + 0.2316419 * x)
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        upper = F.exp(-x * x / 2) * poly * 0.3989422804014327
        return F.when(v < 0, upper).otherwise(1 - upper)

    return _let(z, tail)


def p_values(t: Column, model: list[tuple[float, float, float, float]]) -> list[Column]:
    """The chances that written text looks as uniform to the chi-squared, runs and serial tests as a token does."""
    two, three, switch, serial = (F.element_at(F.array(*(F.lit(float(m[k])) for m in model)), t["encoding"] + 1) for k in range(4))
    n, shares = t["n"], t["shares"]
    # moments of the chi-squared sum for counts that are multinomial in text's frequencies
    mean = shares * (1 - two) + n * (shares * two - 1)
    variance = shares * shares / (n * n) * 2 * n * (n - 1) * (two + (2 * n - 4) * three - (2 * n - 3) * two * two)
    z_chi = (t["chi"] - mean) / F.sqrt(F.greatest(variance, F.lit(1e-9)))
    towards = F.when(switch < 0.5, -1.0).otherwise(1.0)
    z_runs = towards * (t["runs"] - 1 - (n - 1) * switch) / F.sqrt(F.greatest((n - 1) * switch * (1 - switch), F.lit(1e-9)))
    z_serial = F.signum(serial) * (t["serial"] - serial) * F.sqrt(n / F.greatest(1 - serial * serial, F.lit(1e-9)))
    return [_lower_tail(z) for z in (z_chi, z_runs, z_serial)]


def _bits(t: Column, model: list[tuple[float, float, float, float]]) -> Column:
    """Whole bits of the combined p-value."""
    smallest = F.least(*p_values(t, model))
    return F.greatest(F.lit(0), F.floor(F.least(F.lit(float(MAX_BITS)), -F.log2(F.greatest(3 * smallest, F.lit(1e-300))))).cast("int"))


def discoveries(tokens: DataFrame, rate: float = RATE) -> DataFrame:
    """The least bits that count in each length class, of tokens (core, bits, times).

    Of m tokens of a class, k of them at b bits or more, b counts if 2^-b <= rate * k / m.
    """
    cells = tokens.groupBy(_length_class(F.col("core")).alias("length_class"), "bits").agg(F.sum("times").alias("here"))
    of_class = Window.partitionBy("length_class")
    k = F.sum("here").over(of_class.orderBy(F.desc("bits")))
    m = F.sum("here").over(of_class)
    found = cells.select("length_class", "bits", k.alias("k"), m.alias("m")).where(F.pow(F.lit(2.0), -F.col("bits").cast("double")) <= rate * F.col("k") / F.col("m"))
    return found.groupBy("length_class").agg(F.min("bits").alias("least"))


#: Names of a scan's own columns; a caller's columns can't have them.
_OWN = "__secrets_"


def scan(documents: DataFrame, rate: float = RATE) -> DataFrame:
    """All columns of ``documents`` and ``secrets``: array of (start, kind, end), in order; kind is an index of KINDS."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = stored(pieces(documents), "secret-pieces")
    model = text_model(held)
    tokens = held.where(F.length("piece") >= TOKEN_LEAST).select("times", F.explode(F.regexp_extract_all("piece", F.lit(TOKEN), F.lit(0))).alias("token"))
    tokens = tokens.select("times", _core(F.col("token")).alias("core")).where(F.length("core") >= TOKEN_LEAST)
    told = tokens.select("times", "core", _bits(statistics(F.col("core")), model).alias("bits"))
    least = {r.length_class: r.least for r in discoveries(told, rate).collect()}
    bars = F.array(*(F.lit(least.get(i, MAX_BITS + 1)) for i in range(len(LENGTH_CLASSES) + 1)))

    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "random": TOKEN}
    own = {name: _OWN + name for name in ("text", "base", "tokens", *(f"{part}_{kind}" for kind in KINDS for part in ("gaps", "found")))}
    rows = documents.drop("secrets").withColumn(own["text"], text)
    rows = rows.withColumns({own[f"found_{k}"]: F.regexp_extract_all(own["text"], F.lit(p), F.lit(0)) for k, p in patterns.items()})
    # texts without a match are not split
    rows = rows.withColumns({own[f"gaps_{k}"]: F.when(F.size(own[f"found_{k}"]) > 0, F.split(own["text"], p, -1)).otherwise(F.array().cast("array<string>")) for k, p in patterns.items()})
    spans = {k: _spans(F.col(own[f"gaps_{k}"]), F.col(own[f"found_{k}"])) for k in KINDS}
    spans["assign"] = F.filter(spans["assign"], lambda s: F.length(F.regexp_extract(s["found"], ASSIGN, 2)) >= ASSIGN_LEAST)

    def listed(kind: str) -> Column:
        return F.transform(spans[kind], lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))

    rows = rows.withColumn(own["base"], F.concat(*map(listed, KINDS[:3])))
    cored = F.filter(F.transform(spans["random"], lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), _core(s["found"]).alias("core"))), lambda t: F.length(t["core"]) >= TOKEN_LEAST)
    tested = F.transform(cored, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.element_at(bars, _length_class(t["core"]) + 1).alias("bar"), statistics(t["core"]).alias("told")))
    rows = rows.withColumn(own["tokens"], F.filter(tested, lambda t: (_bits(t["told"], model) >= t["bar"]) & passes_as_uniform(t["told"])))
    alone = F.filter(own["tokens"], lambda t: ~F.exists(own["base"], lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    drawn = F.transform(alone, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    return rows.withColumn("secrets", F.array_sort(F.concat(own["base"], drawn))).drop(*own.values())


def span_text(secrets: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, secrets: Column, mark: str = "[secret]") -> Column:
    """A text with each span, or group of overlapping spans, replaced by a mark."""

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        more = F.when(fresh, F.concat(F.substr(text, state["at"] + 1, s["start"] - state["at"]), F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], more).alias("out"))

    done = F.aggregate(secrets, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(secrets) > 0, done).otherwise(text)
