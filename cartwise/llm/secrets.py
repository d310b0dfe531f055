"""Secret scan: fixed patterns plus a randomness test battery.

Three kinds of span come from patterns (``assign``, ``access``, ``hex``).  The
battery adds spans of kind ``random``: every run of 20 or more characters of
``[A-Za-z0-9+/_=-]``, without what pattern spans cover of it, is a candidate if it
has a letter (hexadecimal, base32, base36, base62 or base64 by the characters it
uses).  A run that fits neither base64 form is cut at the characters foreign to
the one and to the other, and the parts of 20 or more characters of both cuts are
candidates (they may overlap).  Its symbols, as numbers in that alphabet, are
tested for

* uniformity (chi-squared against equal counts, Wilson-Hilferty tail),
* runs above and below the middle of the alphabet (two-sided), and
* serial correlation at lag one (two-sided).

The smallest of the three p-values, times three, is the candidate's p-value
under "random in its alphabet".  Candidates are grouped by length class (powers
of two) because short strings leave the tests little power; within each class
Benjamini-Hochberg at ``q`` rejects randomness, over all candidates of the
corpus, and what is not rejected is reported.  The ranking needs only counts by
quantised p-value, summed before any shuffle; at most one threshold per length
class (32) comes back to the driver.

Only DataFrame and SQL functions are used; a text costs time in proportion to its
length, however many matches it holds.  The scanned spans are written once, without
the texts where the caller does not ask for them.  Offsets are code points, end
exclusive.  Defined results: null text is empty (no spans); a text is scanned
whole; repeated rows are scanned each for itself; an empty table gives no rows;
extra columns are kept, and columns this operator adds replace their namesakes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import highest_before, let, totals_before, written

P = "__sec_"
KINDS = ("assign", "access", "hex", "random")

# The patterns and what they must reach to count.
ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)[\x22']?\x20*[:=]\x20*[\x22']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
ASSIGN_VALUE = 6

# Alphabets, in the order of their symbols.
HEX_LOWER = "0123456789abcdef"
HEX_UPPER = "0123456789ABCDEF"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE36 = "0123456789abcdefghijklmnopqrstuvwxyz"
BASE36_UPPER = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASE62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
BASE64 = BASE62 + "+/"
BASE64_URL = BASE62 + "-_"

BINS = 2000      # p-values are ranked by floor(100 * -ln p), up to exp(-20)
MAX_CLASS = 31   # length classes: floor(log2(length))


def _pieces(text, pattern: str):
    """The text cut after every match: each piece is a gap and a match; the
    last is the tail.  The ``\\z`` branch keeps the search linear."""
    return F.regexp_extract_all(text, F.lit(r"(?s).*?(?:" + pattern + r"|\z)"), F.lit(0))


def _spans(text, pattern: str, kind: int):
    """array<struct<start, k, end, body>> of all matches of one pattern.  Linear in the
    text: pieces' lengths are summed in runs, no array grows match by match."""
    def found(pieces):
        def located(before):
            def span(piece, i):
                body = F.regexp_extract(piece, "(?s)^.*?(" + pattern + r")\z", 1)
                end = (F.get(before, i) + F.char_length(piece)).cast("int")
                return F.struct((end - F.char_length(body)).alias("start"), F.lit(kind).alias("k"),
                                end.alias("end"), body.alias("body"))

            return F.filter(F.transform(pieces, span), lambda x: x["body"] != "")

        lengths = F.transform(pieces, lambda p: F.char_length(p).cast("long"))
        return let(let(lengths, totals_before), located)

    return let(_pieces(text, pattern), found)


def _cut(wide, start, end):
    """Characters [start, end) of a text in fixed-width UTF-32, where a cut costs no more
    than what it takes."""
    return F.decode(F.substring(wide, (start * 4 + 1).cast("int"), ((end - start) * 4).cast("int")), "UTF-32")


def _characters(wide):
    return (F.octet_length(wide) / 4).cast("int")


def _blanked(text, spans):
    """The text with the characters of spans (sorted, apart) as spaces."""
    def cut(wide):
        def blank(x, i):
            before = F.when(i == 0, F.lit(0)).otherwise(F.get(spans, i - 1)["end"])
            return F.concat(_cut(wide, before, x["start"]), F.repeat(F.lit(" "), x["end"] - x["start"]))

        last = F.get(spans, F.size(spans) - 1)["end"]
        return F.concat(F.array_join(F.transform(spans, blank), ""), _cut(wide, last, _characters(wide)))

    return F.when(F.size(spans) == 0, text).otherwise(let(F.encode(text, "UTF-32"), cut))


def _none():
    return F.array().cast("array<struct<start:int,k:int,end:int,body:string>>")


def _strip(spans):
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["k"].alias("k"),
                                                 x["end"].alias("end")))


def _base(text):
    low = F.lower(text)
    named = (low.contains("password") | low.contains("passwd") | low.contains("secret")
             | low.contains("token") | low.contains("apikey") | low.contains("api_key"))
    # the value is what the greedy group took: the tail of the match
    value = lambda x: F.char_length(F.regexp_extract(x["body"], "^" + ASSIGN + r"\z", 1))
    assign = F.filter(_spans(text, ASSIGN.replace("([A", "(?:[A", 1), 0),
                      lambda x: value(x) >= ASSIGN_VALUE)
    return F.concat(F.when(named, assign).otherwise(_none()),
                    F.when(text.contains("AKIA"), _spans(text, ACCESS, 1)).otherwise(_none()),
                    F.when(text.rlike(HEX), _spans(text, HEX, 2)).otherwise(_none()))


def _upper_tail(z):
    """P(Z > z) for a standard normal; Abramowitz and Stegun 26.2.17."""
    a = F.abs(z)
    t = 1.0 / (1.0 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937
                + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2.0) * 0.3989422804014327 * poly
    return F.when(z >= 0, tail).otherwise(1.0 - tail)


def _alphabet(body):
    has = lambda p: body.rlike(p)
    return (F.when(~has("[A-Za-z]"), F.lit(None))
            .when(has("^[0-9a-f]+$"), F.lit(HEX_LOWER))
            .when(has("^[0-9A-F]+$"), F.lit(HEX_UPPER))
            .when(has("^[A-Z2-7]+$"), F.lit(BASE32))
            .when(has("^[0-9a-z]+$"), F.lit(BASE36))
            .when(has("^[0-9A-Z]+$"), F.lit(BASE36_UPPER))
            .when(has("^[0-9A-Za-z]+$"), F.lit(BASE62))
            .when(has("^[0-9A-Za-z+/]+$"), F.lit(BASE64))
            .when(has("^[0-9A-Za-z_-]+$"), F.lit(BASE64_URL)))


def _free(text, base):
    """The text without what base spans cover: the spans of one kind at a time, which
    are sorted and apart."""
    for kind in range(3):
        text = let(text, lambda t, k=kind: let(  # noqa: B023
            F.filter(base, lambda x: x["k"] == k), lambda s: _blanked(t, s)))
    return text


def _candidates(text, base):
    """Candidates outside all base spans, with their battery p-value.  What base spans
    leave of a run of 20 or more characters is a run of the text without them."""
    def runs(t):
        return F.when(t.rlike(CANDIDATE), _spans(t, CANDIDATE, 3)).otherwise(_none())

    found = F.when(F.size(base) == 0, runs(text)).otherwise(let(_free(text, base), runs))

    def encoded(c):
        """The run, or where it fits neither base64 form its parts in each."""
        body = F.regexp_replace(c["body"], "=+$", "")
        cut = lambda p: F.transform(_spans(c["body"], p, 3), lambda x: F.struct(
            (c["start"] + x["start"]).alias("start"), F.lit(3).alias("k"),
            (c["start"] + x["end"]).alias("end"), x["body"].alias("body")))
        mixed = body.rlike("[^A-Za-z0-9+/]") & body.rlike("[^A-Za-z0-9_-]")
        return F.when(mixed, F.array_union(cut("[A-Za-z0-9+/]{20,}=*"), cut("[A-Za-z0-9_-]{20,}=*"))
                      ).otherwise(F.array(c))

    free = F.flatten(F.transform(found, encoded))

    def symbols(c):
        body = F.regexp_replace(c["body"], "=+$", "")  # padding is no symbol
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), body.alias("body"),
                        _alphabet(body).alias("abc"))

    def numbers(c):
        chars = F.split(c["body"], "")
        return F.struct(c["start"].alias("start"), c["end"].alias("end"),
                        F.char_length(c["body"]).cast("double").alias("n"),
                        F.char_length(c["abc"]).cast("double").alias("k"),
                        F.transform(F.filter(chars, lambda x: x != ""),
                                    lambda x: (F.instr(c["abc"], x) - 1).cast("double")).alias("v"))

    def stats(c):
        add = lambda arr, zero: F.aggregate(arr, zero, lambda acc, x: acc + x)

        def of(v, mean, half):
            """Moments of the numbers v; the mean is a variable, computed once."""
            squares = F.aggregate(F.array_distinct(v), F.lit(0.0), lambda acc, s: acc
                                  + F.pow(F.size(F.filter(v, lambda y: y == s)).cast("double"), F.lit(2)))
            first, second = F.slice(v, F.lit(1), F.size(v) - 1), F.slice(v, F.lit(2), F.size(v) - 1)
            pairs = F.zip_with(first, second, lambda x, y: (x - mean) * (y - mean))
            turns = F.zip_with(first, second, lambda x, y: ((x >= half) != (y >= half)).cast("int"))
            return F.struct(
                c["start"].alias("start"), c["end"].alias("end"), c["n"].alias("n"), c["k"].alias("k"),
                (c["k"] / c["n"] * squares - c["n"]).alias("chi"),
                F.size(F.filter(v, lambda x: x >= half)).cast("double").alias("n1"),
                (add(turns, F.lit(0)) + 1).cast("double").alias("runs"),
                add(pairs, F.lit(0.0)).alias("cov"),
                add(F.transform(v, lambda x: (x - mean) * (x - mean)), F.lit(0.0)).alias("var"))

        return let(c["v"], lambda v: let(add(v, F.lit(0.0)) / c["n"], lambda mean: let(
            c["k"] / 2, lambda half: of(v, mean, half))))

    def scores(c):
        n, df = c["n"], c["k"] - 1
        spread = 2.0 / (9.0 * df)
        z_chi = (F.pow(c["chi"] / df, F.lit(1.0 / 3)) - (1 - spread)) / F.sqrt(spread)
        mu = 2.0 * c["n1"] * (n - c["n1"]) / n + 1
        var = (mu - 1) * (mu - 2) / (n - 1)
        z_runs = F.when(var > 0, (c["runs"] - mu) / F.sqrt(F.greatest(var, F.lit(1e-9)))).otherwise(9.0)
        z_ser = F.when(c["var"] > 0, (c["cov"] / c["var"] + 1 / n) * F.sqrt(n)).otherwise(9.0)
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), n.alias("n"),
                        z_chi.alias("zc"), F.abs(z_runs).alias("zr"), F.abs(z_ser).alias("zs"))

    def decided(c):
        p = F.least(F.lit(1.0), 3.0 * F.least(_upper_tail(c["zc"]), 2.0 * _upper_tail(c["zr"]),
                                              2.0 * _upper_tail(c["zs"])))
        bin_ = F.least(F.lit(BINS), F.floor(-100.0 * F.log(F.greatest(p, F.lit(1e-30))))).cast("int")
        return F.struct(c["start"].alias("start"), F.lit(3).alias("k"), c["end"].alias("end"),
                        F.least(F.lit(MAX_CLASS), F.floor(F.log2(c["n"]))).cast("int").alias("cls"),
                        F.greatest(F.lit(0), bin_).alias("bin"))

    coded = F.filter(F.transform(free, symbols),
                     lambda c: c["abc"].isNotNull() & (F.char_length(c["body"]) >= 20))
    return F.transform(F.transform(F.transform(F.transform(coded, numbers), stats), scores), decided)


def scan(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``keep`` columns) with base (pattern spans) and candidates (with
    class and bin): a written table, as thresholds and spans both read it, and each text
    is scanned once."""
    own = [c for c in docs.columns if c not in (P + "base", P + "cand")]
    kept = own if keep is None else list(keep)
    text = F.coalesce(F.col(text_col), F.lit(""))
    with_base = docs.select(*own, _base(text).alias(P + "base"))
    return written(with_base.select(*kept, _strip(P + "base").alias(P + "base"),
                                    _candidates(text, F.col(P + "base")).alias(P + "cand")), "secrets-scan")


def thresholds(scanned: DataFrame, q: float) -> dict[int, int]:
    """Benjamini-Hochberg by length class: the smallest bin that is rejected.

    A bin holds the p-values in (exp(-(b+1)/100), exp(-b/100)]; its upper end
    stands for all of them, so no more is rejected than the exact ranks would.
    """
    from pyspark.sql import Window

    counts = (scanned.where(F.size(P + "cand") > 0)
              .select(F.explode(F.col(P + "cand")).alias("c"))
              .groupBy(F.col("c.cls").alias("cls"), F.col("c.bin").alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    of = Window.partitionBy("cls")
    rising = of.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.select("cls", "bin", F.sum("n").over(rising).alias("rank"),
                           F.sum("n").over(of).alias("m"))
    hit = ranked.where(F.exp(-F.col("bin") / 100.0) <= q * F.col("rank") / F.col("m"))
    return {r["cls"]: r["bin"] for r in hit.groupBy("cls").agg(F.min("bin").alias("bin")).collect()}


def find_secrets(docs: DataFrame, text_col: str = "text", q: float = 0.01,
                 keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``keep`` columns) with n_assign, n_access, n_hex, n_random and ``found``: all
    spans as array<struct<start, k, end>> by start, then kind (see KINDS)."""
    added = ["n_assign", "n_access", "n_hex", "n_random", "found", "base_found"]
    docs = docs.select(*[c for c in docs.columns if c not in added])
    scanned = scan(docs, text_col, keep)
    cut = thresholds(scanned, q)
    kept = F.col(P + "cand")
    if cut:
        limit = F.create_map(*[F.lit(x) for pair in sorted(cut.items()) for x in pair])
        kept = F.filter(kept, lambda c: F.coalesce(
            c["bin"] < F.element_at(limit, c["cls"]), F.lit(True)))
    base = F.array_sort(F.col(P + "base"))
    count = lambda k: F.size(F.filter(P + "base", lambda x: x["k"] == k)).cast("long")
    return scanned.select(
        *(docs.columns if keep is None else keep), count(0).alias("n_assign"), count(1).alias("n_access"),
        count(2).alias("n_hex"), F.size(kept).cast("long").alias("n_random"),
        F.array_sort(F.concat(F.col(P + "base"), _strip(kept))).alias("found"),
        base.alias("base_found"))


def spans_text(spans):
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["start"].cast("string"),
        x["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars",
           mark: str = "[SECRET]", q: float = 0.01) -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans by one)."""
    found = find_secrets(docs.select(*docs.columns), text_col, q)
    text = F.col(text_col)

    def marked(spans, wide):
        """Each span that begins after all before it have ended gets a mark."""
        ends = F.transform(spans, lambda x: x["end"])

        def cut(before):
            def shown(x, i):
                return F.when(x["start"] >= F.get(before, i), F.concat(
                    _cut(wide, F.get(before, i), x["start"]), F.lit(mark))).otherwise(F.lit(""))

            return F.concat(F.array_join(F.transform(spans, shown), ""),
                            _cut(wide, F.array_max(ends), _characters(wide)))

        return let(let(ends, highest_before), cut)

    done = let(F.col("found"), lambda spans: let(F.encode(text, "UTF-32"), lambda w: marked(spans, w)))
    clean = F.when(F.size("found") > 0, done).otherwise(text)
    out = found.select(*[c for c in docs.columns if c != text_col], clean.alias(text_col),
                       (F.size("found") > 0).alias(P + "hit"))
    if length_col in docs.columns:
        length = F.when(F.col(P + "hit"), F.char_length(text_col)).otherwise(F.col(length_col))
        out = out.withColumn(length_col, length.cast(docs.schema[length_col].dataType))
    return out.select(*docs.columns)


def op10_secrets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_secrets(docs, keep=["doc_id"])
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(spans_text(F.col("base_found")), 256).alias("base_sha256"),
                        spans_text(F.col("found")).alias("spans"))
