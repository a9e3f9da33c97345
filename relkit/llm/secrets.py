"""Secret scan with a randomness test battery (operator 1, DataFrame functions only).

Base spans come from three patterns (assignments, access key ids, hex runs).
The battery adds spans of kind ``random``: long unbroken tokens with digits and
letters that look drawn evenly from the alphabet of their inferred encoding
(the smallest that holds them: hex, base32 or base36 of either case with
separators left out, else base64):

* chi-squared uniformity: the statistic's lower tail under a text-like source
  of the same length (a noncentral chi-squared whose noncentrality grows with
  the length) is the token's p-value: small means far more even than text;
* a runs test about the middle of the alphabet and a lag-1 serial correlation
  test must not reject evenness (two-sided, ``REJECT_Z``).

Tokens that pass both tests compete under the Benjamini-Hochberg procedure at
level ``FALSE_DISCOVERY``, over all documents, with weights in proportion to
their length (long tokens carry more evidence), normalised to mean one.  The
procedure works on a histogram of binned p-values, rounded against discovery,
which has at most ``_BINS`` rows at any input size.

Positions are code points, end exclusive.  Defined cases: NULL or empty text
has no span; repeated rows and NULL ids are rows of their own; an added span
never overlaps a base span; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import prepare, stored, text_or_empty

# The patterns of the base spans.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
MIN_ASSIGNED = 12

#: An unbroken token that may be encoded bytes.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
# Alphabets in value order, and the sum of squared symbol shares of text-like tokens written in them.
ALPHABETS = {
    "hex": ("0123456789abcdef", 0.125),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.07),
    "base36": ("0123456789abcdefghijklmnopqrstuvwxyz", 0.06),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.055),
}
REJECT_Z = 3.29
FALSE_DISCOVERY = 0.01
_BINS_PER_DECADE, _DECADES = 50, 30
_BINS = _BINS_PER_DECADE * _DECADES + 1

_SPANS = "array<struct<start:int,kind:int,end:int>>"
_TOKENS = "array<struct<start:int,end:int,token:string>>"


#: Arrays that grow step by step do so in blocks of this size, as every step copies what it has.
_BLOCK = 64


def _let(value: Column, body) -> Column:
    """``body`` of one value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _blocks(values: Column) -> Column:
    """An array cut into arrays of ``_BLOCK`` (one empty array for an empty one)."""
    def cut(v: Column) -> Column:
        last = F.greatest(F.ceil(F.size(v) / _BLOCK).cast("int") - 1, F.lit(0))
        # By places: a slice would copy the whole array.
        own = lambda i: F.transform(F.sequence(i * _BLOCK, F.least((i + 1) * _BLOCK, F.size(v)) - 1), lambda j: F.get(v, j))
        return F.when(F.size(v) == 0, F.array(v)).otherwise(F.transform(F.sequence(F.lit(0), last), own))

    return _let(values, cut)


def _sums_before(values: Column) -> Column:
    """For each value of an array the sum of those before it, by blocks of blocks."""
    def within(block: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(block, start, lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
                           lambda s: s["out"])

    def of(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, x: acc + x))
        return _let(within(totals, F.lit(0)), lambda firsts: F.flatten(F.zip_with(blocks, firsts, within)))

    return _let(_blocks(values), of)


def _matches(text: Column, pattern: str, kind: int, long_enough=None) -> Column:
    """Spans of all matches, from the lengths of the matches and of the text between them; kind 3 with their text.

    ``long_enough``: least length of group 1 for a match to count.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if long_enough else found
    parts = F.arrays_zip(F.transform(F.slice(gaps, F.lit(1), F.size(found)), F.length).alias("gap"),
                         found.alias("match"), value.alias("value"))
    places = lambda p: F.zip_with(p, _sums_before(F.transform(p, lambda x: x["gap"] + F.length(x["match"]))), span)

    def span(part: Column, before: Column) -> Column:
        start = before + part["gap"]
        end = start + F.length(part["match"])
        if kind == 3:
            return F.struct(start.alias("start"), end.alias("end"), part["match"].alias("token"))
        keep = F.length(part["value"]) >= (long_enough or 0)
        return F.struct(start.alias("start"), F.when(keep, kind).cast("int").alias("kind"), end.alias("end"))

    spans = _let(parts, places)
    if long_enough:
        spans = F.filter(spans, lambda s: s["kind"].isNotNull())
    schema = _TOKENS if kind == 3 else _SPANS
    return F.when(text.rlike(pattern), spans.cast(schema)).otherwise(F.array().cast(schema))


def base_spans(text: Column) -> Column:
    """The base spans, in order of start and then of kind."""
    return F.array_sort(F.concat(_matches(text, ASSIGN, 0, MIN_ASSIGNED), _matches(text, ACCESS, 1),
                                 _matches(text, HEX, 2)))


def _bare(token: Column) -> Column:
    """The token without separators."""
    return F.translate(token, "-_+/", "")


def encoding_of(token: Column) -> Column:
    """The inferred encoding of a token; NULL without a digit or without a letter."""
    digit, upper, lower = token.rlike("[0-9]"), token.rlike("[A-Z]"), token.rlike("[a-z]")
    return F.when(digit & (upper | lower), F.when(_bare(token).rlike("^[0-9A-Fa-f]+$"), "hex")
                  .when(_bare(token).rlike("^([A-Z2-7]+|[a-z2-7]+)$"), "base32")
                  .when(upper & lower, "base64").otherwise("base36"))


def _normal_cdf(z: Column) -> Column:
    """Abramowitz and Stegun 26.2.17, absolute error below 1e-7; the far tail by its leading term."""
    x = F.abs(z)
    t = F.lit(1.0) / (F.lit(1.0) + x * 0.2316419)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    density = F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    tail = F.when(x < 5, density * poly).otherwise(density / F.greatest(x, F.lit(1.0)))
    return F.when(z < 0, tail).otherwise(1 - tail)


def battery(token: Column) -> Column:
    """struct(n, p_text, z_runs, z_serial) of a token that has an encoding.

    ``p_text``: how likely a text-like source of this length is to look so
    even; the two z are standard normal for evenly drawn symbols.
    """
    encoding = encoding_of(token)

    def per(values: dict) -> Column:
        return F.coalesce(*(F.when(encoding == k, F.lit(v)) for k, v in values.items()))

    plain = (F.when(encoding == "base64", F.translate(token, "-_", "+/")).when(encoding == "base32", F.upper(_bare(token)))
             .otherwise(F.lower(_bare(token))))
    setup = F.struct(plain.alias("t"), per({k: v[0] for k, v in ALPHABETS.items()}).alias("a"),
                     per({k: float(len(v[0])) for k, v in ALPHABETS.items()}).alias("k"),
                     per({k: v[1] for k, v in ALPHABETS.items()}).alias("c"))

    def total(values: Column, term) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + term(x))

    def runs(values: Column) -> Column:
        """The sum of squared symbol counts: in sorted order the r-th equal symbol adds 2r - 1."""
        def step(s: Column, x: Column) -> Column:
            nth = F.when(x == s["prev"], s["nth"] + 1).otherwise(F.lit(1.0))
            return F.struct(x.alias("prev"), nth.alias("nth"), (s["sum"] + 2 * nth - 1).alias("sum"))
        start = F.struct(F.lit(-1.0).alias("prev"), F.lit(0.0).alias("nth"), F.lit(0.0).alias("sum"))
        return F.aggregate(F.array_sort(values), start, step, lambda s: s["sum"])

    def tests(e: Column, v: Column, m: Column) -> Column:
        n, mean = F.size(v).cast("double"), m["mean"]
        pairs = F.arrays_zip(F.slice(v, F.lit(1), F.size(v) - 1).alias("a"), F.slice(v, 2, F.size(v)).alias("b"))
        changes = total(pairs, lambda p: F.when((p["a"] < e["k"] / 2) != (p["b"] < e["k"] / 2), 1.0).otherwise(0.0))
        around = total(pairs, lambda p: (p["a"] - mean) * (p["b"] - mean))
        spread = total(v, lambda x: (x - mean) * (x - mean))
        chi, degrees, shift = e["k"] / n * m["squares"] - n, e["k"] - 1, n * (e["k"] * e["c"] - 1)
        z_serial = F.when(spread > 0, around / spread * F.sqrt(n)).otherwise(F.lit(99.0))
        return F.struct(n.alias("n"), _normal_cdf((chi - degrees - shift) / F.sqrt(2 * (degrees + 2 * shift))).alias("p_text"),
                        ((changes - (n - 1) / 2) / F.sqrt((n - 1) / 4)).alias("z_runs"), z_serial.alias("z_serial"))

    def measured(e: Column) -> Column:
        place = lambda c: F.call_function("locate", c, e["a"]).cast("double") - 1
        return _let(F.transform(F.split(e["t"], ""), place), lambda v: _let(
            F.struct((total(v, lambda x: x) / F.size(v)).alias("mean"), runs(v).alias("squares")),
            lambda m: tests(e, v, m)))

    return _let(setup, measured)


def _even(stats) -> Column:
    return (F.abs(stats["z_runs"]) < REJECT_Z) & (F.abs(stats["z_serial"]) < REJECT_Z)


def _bin(p: Column, n: Column, mean_n: float) -> Column:
    """The weighted p-value's bin, counted from 1 downwards in steps of 1/50 decade."""
    weighted = F.greatest(p / (n / mean_n), F.lit(10.0 ** -_DECADES))
    return F.greatest(F.lit(0), F.floor(-F.log10(weighted) * _BINS_PER_DECADE)).cast("int")


def discovery_bin(histogram: dict[int, int], tested: int, level: float = FALSE_DISCOVERY) -> int:
    """The least bin whose p-values Benjamini-Hochberg calls discoveries; past the last bin for none."""
    least, above = _BINS, 0
    for b in sorted(histogram, reverse=True):
        above += histogram[b]
        if 10.0 ** (-b / _BINS_PER_DECADE) <= level * above / tested:
            least = b
    return least


def _apart(tokens: Column, base: Column) -> Column:
    """The tokens that touch no base span; both are in order of their starts."""
    def reach(block: Column) -> Column:
        return F.struct(F.get(block, F.lit(0))["start"].alias("start"), F.array_max(F.transform(block, lambda s: s["end"])).alias("end"),
                        block.alias("spans"))

    meets = lambda x, y: (x["start"] < y["end"]) & (y["start"] < x["end"])

    def per(held: Column) -> Column:
        def left(block: Column) -> Column:
            near = lambda r: F.flatten(F.transform(F.filter(held, lambda h: meets(h, r)), lambda h: h["spans"]))
            return _let(near(reach(block)), lambda spans: F.filter(block, lambda t: ~F.exists(spans, lambda b: meets(b, t))))
        return F.flatten(F.transform(_blocks(tokens), left))

    return F.when(F.size(base) == 0, tokens).otherwise(_let(F.transform(_blocks(base), reach), per))


def _found(docs: DataFrame, keep: list) -> DataFrame:
    """``keep`` with ``base`` (spans) and ``tokens``: those with an encoding that touch no base span, tested."""
    rows = docs.select(*keep, text_or_empty().alias("_text"))
    text = F.col("_text")
    rows = rows.withColumn("base", base_spans(text)).withColumn("_all", _matches(text, TOKEN, 3))
    free = _apart(F.filter("_all", lambda t: encoding_of(t["token"]).isNotNull()), F.col("base"))
    tested = F.transform(free, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"),
                                                  battery(t["token"]).alias("stats")))
    return rows.withColumn("tokens", F.when(F.size("_all") > 0, tested)).drop("_all")


def _threshold(tokens: DataFrame) -> tuple[float, int]:
    """(mean length, least bin) of the discoveries among the column ``tokens``."""
    tested = tokens.select(F.explode("tokens").alias("t")).select("t.stats.*")
    total = tested.agg(F.count(F.lit(1)).alias("m"), F.avg("n").alias("mean")).first()
    if not total["m"]:
        return 1.0, _BINS
    # At most `_BINS` rows.
    bins = (tested.where(_even({k: F.col(k) for k in ("z_runs", "z_serial")}))
            .groupBy(_bin(F.col("p_text"), F.col("n"), total["mean"]).alias("b")).agg(F.count(F.lit(1)).alias("c")).collect())
    return total["mean"], discovery_bin({r["b"]: r["c"] for r in bins}, total["m"])


def _spans(threshold: tuple[float, int]) -> Column:
    """Base spans and discovered tokens in order of start and kind."""
    mean, least = threshold
    random = F.filter("tokens", lambda t: _even(t["stats"]) & (_bin(t["stats"]["p_text"], t["stats"]["n"], mean) >= least))
    added = F.transform(random, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    return F.array_sort(F.concat("base", F.coalesce(added, F.array()).cast(_SPANS)))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans (arrays of start, kind number, end) for every row of ``docs``."""
    prepare(docs.sparkSession)
    found = stored(_found(docs, ["doc_id"]).select("doc_id", "base", "tokens"), "secret-spans")
    return found.select("doc_id", "base", _spans(_threshold(found)).alias("spans"))


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark``; all other columns stay."""
    prepare(docs.sparkSession)
    names = docs.columns
    found = _found(docs, [F.struct(*names).alias("_row")])
    threshold = _threshold(stored(found.select("tokens"), "secret-tokens"))
    text = F.col("_text")

    # Spans that overlap count as one; the text between two blocks of spans is cut out once, and within it each gap.
    def step(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        kept = F.call_function("substr", state["text"], state["at"] - state["off"] + 1, span["start"] - state["at"])
        out = F.when(fresh, F.concat(state["out"], F.array(kept, F.lit(mark)))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), state["off"].alias("off"), state["text"].alias("text"), out.alias("out"))

    def cleaned(block: Column, before: Column) -> Column:
        """The clean text from the end of the spans before the block to the end of its own."""
        stop = F.array_max(F.transform(block, lambda s: s["end"]))
        own = F.call_function("substr", text, before + 1, F.greatest(stop, before) - before)
        start = F.struct(before.alias("at"), before.alias("off"), own.alias("text"), F.array().cast("array<string>").alias("out"))
        return F.array_join(F.aggregate(block, start, step, lambda s: s["out"]), "")

    def joined(blocks: Column) -> Column:
        ends = F.transform(blocks, lambda b: F.array_max(F.transform(b, lambda s: s["end"])))
        furthest = F.transform(blocks, lambda b, i: F.array_max(F.concat(F.array(F.lit(0)), F.slice(ends, F.lit(1), i))))
        body = F.zip_with(blocks, furthest, cleaned)
        return F.concat(F.array_join(body, ""), F.call_function("substr", text, F.array_max(ends) + 1, F.length(text)))

    clean = _let(_blocks(F.col("spans")), joined)
    out = found.withColumn("spans", _spans(threshold)).withColumn(
        "_clean", F.when(F.size("spans") > 0, clean).otherwise(F.col("_row.text")))
    return out.select(*(F.col("_clean").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in names))


def written(spans: str | Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def digests(scanned: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_random from ``scan_secrets``."""
    count = lambda k, c: F.size(F.filter(c, lambda s: s["kind"] == k)).cast("long")
    return scanned.select(
        "doc_id", *(count(k, "base").alias(f"n_{KINDS[k]}") for k in range(3)),
        F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans"), count(3, "spans").alias("n_random"))
