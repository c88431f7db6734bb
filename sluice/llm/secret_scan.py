"""Secret scan with DataFrame functions only.

Base rules are three patterns. The method adds random-looking tokens: every
token of 20 or more key characters whose inferred encoding (hex, base32,
base62, base64) mixes letter cases or digits is put through a battery of
randomness tests - chi-squared uniformity over the encoding's alphabet, runs
above and below the middle of the alphabet, lag-1 serial correlation. A token
passes when none of the three rejects randomness. Passing alone says little
about short tokens, so each has a second p-value against ordinary writing: the
chi-squared statistic of ``n`` characters written with the collision rate of
text over ``k`` symbols is noncentral, with mean ``k - 1 + n * l`` and variance
``2 (k - 1) + 4 n l`` where ``l = k * rate - 1``; Mills' bound of the lower
tail is the p-value. Benjamini-Hochberg holds the false-discovery rate within
each length class (powers of two), over the tokens of all documents. It needs
the counts by class and binned p-value only: a bounded number of rows goes to
the driver, a threshold for each class comes back.

Positions come from the texts between matches (``split``) and the matches
themselves, summed up; they are code points, ends exclusive. A match never
crosses a line.

Defined cases: a null text is empty and has no spans; texts are scanned whole;
equal rows give equal results, one each; an empty table gives no rows; names of
further columns don't matter.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import text as tx

# Fixed values of the base rules: pattern, least length of the match or value.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
KINDS = ["assign", "access", "hex", "random"]       # order of spans that start together

TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
ALPHA = 0.01                # level of the battery, shared by its three tests
FALSE_RATE = 0.01           # false-discovery rate within a length class
TEXT_COLLISIONS = 0.0667    # chance that two letters of ordinary writing are equal
DIGIT_COLLISIONS = 0.1      # the same for numbers, the ordinary case of hex
MAX_BIN = 400               # p-values are binned by tenths of their decimal logarithm
MIN_CLASS, MAX_CLASS = 4, 16

LOWER, UPPER, DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ENCODINGS = [               # pattern, alphabet, collision rate; the first that fits holds
    (r"^[0-9a-f]+$", DIGIT + LOWER[:6], DIGIT_COLLISIONS),
    (r"^[0-9A-F]+$", DIGIT + UPPER[:6], DIGIT_COLLISIONS),
    (r"^[A-Z2-7]+$", UPPER + "234567", TEXT_COLLISIONS),
    (r"^[A-Za-z0-9]+$", DIGIT + UPPER + LOWER, TEXT_COLLISIONS),
    (r"^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGIT + "+/", TEXT_COLLISIONS),
    (r"^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGIT + "-_", TEXT_COLLISIONS),
]
BLOCK = 256                 # matches placed at once; keeps a text with very many matches linear

NO_SPANS = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def _no_spans() -> Column:
    return F.array().cast(NO_SPANS)


def _spans(text: Column, pattern: str, kind: int) -> Column:
    """All matches as ``start, kind, end, value``."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(found.alias("m"), F.transform(F.split(text, pattern, -1), F.length).alias("g"))
    pairs = F.filter(pairs, lambda x: x["m"].isNotNull())       # the gap after the last match
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / F.lit(BLOCK)).cast("int")),
                         lambda i: F.slice(pairs, i * BLOCK + 1, BLOCK))

    def place(state, pair):
        start = state["at"] + pair["g"]
        end = start + F.length(pair["m"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["m"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).cast(NO_SPANS).alias("out"))

    def place_block(state, block):
        done = F.aggregate(block, F.struct(state["at"].alias("at"), _no_spans().alias("out")), place)
        return F.struct(done["at"].alias("at"), F.concat(state["out"], F.array(done["out"])).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{NO_SPANS}>").alias("out"))
    placed = F.flatten(F.aggregate(blocks, start, place_block)["out"])
    return F.when(F.size(found) > 0, placed).otherwise(_no_spans())


def base_spans(text: Column) -> Column:
    value = lambda x: F.regexp_extract(x["value"], ASSIGN, 1)
    return F.concat(F.filter(_spans(text, ASSIGN, 0), lambda x: F.length(value(x)) >= MIN_ASSIGN),
                    # Runs can't overlap, so short ones may be left out by the pattern itself.
                    _spans(text, f"AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}+", 1),
                    _spans(text, f"(?<![0-9a-f])[0-9a-f]{{{MIN_HEX},}}+", 2))


def _normal_bound(p: float) -> float:
    return NormalDist().inv_cdf(1 - p)


def _score(token: Column) -> Column:
    """-10 log10 of the p-value against ordinary writing, whole and 0 where the
    battery rejects randomness; null where no encoding fits."""
    n = F.length(token).cast("double")
    fits = lambda of: F.coalesce(*[F.when(F.rlike(token, F.lit(p)), F.lit(of(a, r))) for p, a, r in ENCODINGS])
    mixed = F.rlike(token, F.lit("[0-9]")) & F.rlike(token, F.lit("[A-Za-z]")) | F.rlike(token, F.lit("[a-z][A-Z]"))
    alphabet = F.when(mixed, fits(lambda a, r: a))
    k = F.length(alphabet).cast("double")
    chars = F.split(token, "")
    squares = F.aggregate(F.array_distinct(chars), F.lit(0.0),
                          lambda s, c: s + F.pow(n - F.length(F.replace(token, c, F.lit(""))), F.lit(2.0)))
    chi = k / n * squares - n
    free = k - 1
    chi_z = (F.pow(chi / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    # Runs above and below the middle of the alphabet.
    halves = F.coalesce(*[F.when(F.rlike(token, F.lit(p)), F.translate(
        token, a, "0" * (len(a) // 2) + "1" * (len(a) - len(a) // 2))) for p, a, _ in ENCODINGS])
    ones = F.length(F.replace(halves, F.lit("0"), F.lit(""))).cast("double")
    pairs = 2 * ones * (n - ones)
    runs = 1 + F.regexp_count(halves, F.lit("01")) + F.regexp_count(halves, F.lit("10"))
    spread = F.sqrt(F.greatest(pairs * (pairs - n) / (n * n * (n - 1)), F.lit(1e-9)))
    runs_z = F.abs(runs - pairs / n - 1) / spread
    # Circular lag-1 serial correlation of the symbols' places in the alphabet.
    places = F.transform(chars, lambda c: F.instr(alphabet, c).cast("double"))
    next_places = F.concat(F.slice(places, F.lit(2), F.size(places) - 1), F.slice(places, 1, 1))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    s1, s2 = total(places), total(F.transform(places, lambda x: x * x))
    s12 = total(F.zip_with(places, next_places, lambda x, y: x * y))
    r = (n * s12 - s1 * s1) / F.greatest(n * s2 - s1 * s1, F.lit(1e-9))
    serial_z = F.abs(r + 1 / (n - 1)) / F.sqrt(n * n / ((n - 1) * (n - 1) * (n - 2)))
    passes = ((chi_z <= _normal_bound(ALPHA / 3)) & (runs_z <= _normal_bound(ALPHA / 6))
              & (serial_z <= _normal_bound(ALPHA / 6)))
    # Lower tail of the noncentral statistic of ordinary writing.
    excess = k * fits(lambda a, r: r) - 1
    z = (free + n * excess - chi) / F.sqrt(2 * free + 4 * n * excess)
    tail = F.when(z > 1, z * z / 2 * math.log10(math.e) + F.log10(z * math.sqrt(2 * math.pi))).otherwise(0.0)
    score = F.when(passes, F.least(F.floor(10 * tail), F.lit(MAX_BIN))).otherwise(0)
    return F.when(alphabet.isNotNull(), score.cast("int"))


def _class(token: Column) -> Column:
    return F.least(F.floor(F.log2(F.length(token).cast("double"))), F.lit(MAX_CLASS)).cast("int")


def scored_tokens(text: Column) -> Column:
    """``span, class, score`` of the tokens with an encoding."""
    tokens = F.transform(_spans(text, TOKEN, 3), lambda x: F.struct(
        x.alias("span"), _class(x["value"]).alias("class"), _score(x["value"]).alias("score")))
    return F.filter(tokens, lambda x: x["score"].isNotNull())


def thresholds(docs: DataFrame, text: str = "text", false_rate: float = FALSE_RATE) -> dict[int, int]:
    """Least score of a discovery in each length class: the largest set of
    tokens whose expected number of false ones is within the rate."""
    counts = (docs.select(F.explode(scored_tokens(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))).alias("t"))
              .groupBy(F.col("t.class").alias("class"), F.col("t.score").alias("score")).count())
    rows = counts.collect()             # at most 13 classes x 401 bins
    out = {}
    for c in range(MIN_CLASS, MAX_CLASS + 1):
        own = sorted(((r["score"], r["count"]) for r in rows if r["class"] == c), reverse=True)
        tested, found = sum(n for _, n in own), 0
        for score, n in own:
            found += n
            if score > 0 and tested * 10 ** (-score / 10) <= false_rate * found:
                out[c] = score
    return out


def find_secrets(docs: DataFrame, text: str = "text", false_rate: float = FALSE_RATE) -> DataFrame:
    """``row`` (the input row), ``text`` and ``spans`` (start, kind, end, value;
    in order of start, then kind)."""
    least = thresholds(docs, text, false_rate)
    rows = tx.row_and_text(docs, text).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    if least:
        def discovery(x):
            reached = F.lit(False)
            for c, score in least.items():
                reached = reached | ((x["class"] == c) & (x["score"] >= score))
            overlaps = F.exists("base", lambda b: (b["start"] < x["span"]["end"]) & (x["span"]["start"] < b["end"]))
            return reached & ~overlaps
        added = F.transform(F.filter(scored_tokens(F.col("text")), discovery), lambda x: x["span"])
    else:
        added = _no_spans()
    return rows.select("row", "text", F.array_sort(F.concat("base", added)).alias("spans"))


def _said(spans: Column, kinds: int) -> Column:
    names = F.array(*map(F.lit, KINDS))
    own = F.filter(spans, lambda x: x["kind"] < kinds)
    return F.array_join(F.transform(own, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by a mark (spans that overlap
    by one); ``n_chars``, where there is such a column, follows."""
    found = find_secrets(docs, text)

    def put(state, x):
        """Copy what stands before a span that begins beyond the last one."""
        gap = F.substring(F.col("text"), state["at"].cast("int") + 1, (x["start"] - state["at"]).cast("int"))
        fresh = F.concat(state["out"], gap, F.lit(mark))
        inside = x["start"] < state["at"]
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"),
                        F.when(inside, state["out"]).otherwise(fresh).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    done = F.aggregate("spans", start, put, lambda s: F.concat(
        s["out"], F.substring(F.col("text"), s["at"].cast("int") + 1, F.length("text"))))
    return found.select("row", F.when(F.size("spans") == 0, F.col(f"row.`{text}`").cast("string")).otherwise(done)
                        .alias("new_text")).select(*tx.with_text(docs, text))


def op7_secret_randomness(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    spans = F.col("spans")
    n = lambda k: F.size(F.filter(spans, lambda x: x["kind"] == k)).cast("long")
    return find_secrets(docs).select(
        F.col("row.doc_id").alias("doc_id"), n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(_said(spans, 3), 256).alias("base_sha256"), _said(spans, len(KINDS)).alias("spans"))
