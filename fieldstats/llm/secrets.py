"""Secret scans: fixed patterns, and strings that look random to a pair of character Markov models.

One model is trained on random strings (the values of pattern matches and
generated keys), the other on ordinary identifiers (long words outside any
match). A long word is a secret if the log-likelihood ratio per character pair
is above a limit. Everything is built from column functions; no row leaves its
partition in a scan.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Kinds and patterns, in the order in which equal starts are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "markov")

#: What the models look at: whole runs of at least 16 of these characters.
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_=-."
#: Distinct labelled strings per class the models are fitted on (smallest hashes); generated random ones.
FIT_STRINGS, GENERATED = 20_000, 2_000
#: Added to every count of a character; pairs after a character count as if so many more had been drawn by characters alone.
SMOOTHING, BACKED = 0.5, 20.0
#: Least mean log-likelihood ratio (nats per pair) of a secret.
LIMIT = 0.75

_SIZE = len(ALPHABET)
_EMPTY = "cast(array() as array<struct<start:int,stop:int>>)"


def _shortest(kind: str) -> str:
    """The pattern of hex and access with the least length written in, which finds the same matches that pass."""
    return {"hex": HEX[:-1] + "{%d,}+" % LEAST["hex"], "access": ACCESS[:-1] + "{%d,}+" % (LEAST["access"] - 4)}[kind]


def _spans(text: Column, pattern: str, keep) -> Column:
    """Spans (code points) of the matches that keep() takes, leftmost first.

    The text falls into pieces before, between and after the matches; running
    lengths of pieces and matches give the positions.
    """
    cut = F.arrays_zip(
        F.split(text, pattern, -1).alias("piece"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(1 if pattern == ASSIGN else 0)).alias("value"),
    )
    zero = F.struct(F.lit(0).alias("at"), F.expr(_EMPTY).alias("out"))

    def step(state, x):
        start = state["at"] + F.length(x["piece"])
        stop = start + F.coalesce(F.length(x["match"]), F.lit(0))
        own = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        good = x["match"].isNotNull() & keep(x["value"])
        return F.struct(stop.alias("at"), F.when(good, F.concat(state["out"], own)).otherwise(state["out"]).alias("out"))

    found = F.aggregate(cut, zero, step, lambda s: s["out"])
    return F.when(text.rlike(pattern), found).otherwise(F.expr(_EMPTY))


def _codes(word: Column) -> Column:
    """Number of each character in the alphabet; other characters do not occur."""
    table = F.lit([ALPHABET.find(chr(c)) for c in range(128)])
    return F.transform(F.slice(F.split(word, ""), 1, F.length(word)), lambda c: F.get(table, F.ascii(c)))


def _pairs(word: Column) -> Column:
    codes = _codes(word)
    n = F.greatest(F.length(word) - 1, F.lit(0))
    return F.zip_with(F.slice(codes, 1, n), F.slice(codes, 2, n), lambda a, b: a * _SIZE + b)


def labelled_strings(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(word, random): labelled samples from the documents and generated keys.

    Random are the values of pattern matches, and encoded digests; ordinary are
    the long words of the texts without the matches. Distinct strings are
    chosen by hash, a bounded number per class.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    any_match = "|".join((ASSIGN, _shortest("access"), _shortest("hex")))
    values = F.concat(
        F.filter(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)), lambda v: F.length(v) >= LEAST["assign"]),
        F.regexp_extract_all(text, F.lit(_shortest("access")), F.lit(0)),
        F.regexp_extract_all(text, F.lit(_shortest("hex")), F.lit(0)),
    )
    secret = F.when(text.rlike(any_match), values).otherwise(F.expr("cast(array() as array<string>)"))
    rest = F.when(text.rlike(any_match), F.regexp_replace(text, any_match, " ")).otherwise(text)
    words = F.regexp_extract_all(rest, F.lit(WORD), F.lit(0))
    both = F.concat(
        F.transform(secret, lambda v: F.struct(v.alias("word"), F.lit(True).alias("random"))),
        F.transform(words, lambda v: F.struct(v.alias("word"), F.lit(False).alias("random"))),
    )
    found = documents.select(F.inline(both)).groupBy("word").agg(F.max("random").alias("random"))
    chosen = [found.where(F.col("random") == v).orderBy(F.xxhash64("word"), "word").limit(FIT_STRINGS) for v in (True, False)]
    digest = F.sha2(F.concat(F.lit("key"), F.col("id").cast("string")), 256)
    keys = spark.range(0, GENERATED, 1, 1).select(
        F.explode(F.array(F.base64(F.unhex(digest)), digest)).alias("word"), F.lit(True).alias("random")
    )
    return chosen[0].union(chosen[1]).union(keys)


def fit(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of every pair of characters, random against ordinary, from labelled strings (word, random).

    Null words are left out; a class without strings is a uniform model.
    """
    usable = F.col("word").isNotNull() & ~F.col("word").rlike(r"[^A-Za-z0-9+/_=.\-]")
    pairs = samples.where(usable).select(F.explode(_pairs(F.col("word"))).alias("pair"), "random")
    counts = {(r["pair"], r["random"]): r["n"] for r in pairs.groupBy("pair", "random").agg(F.count("*").alias("n")).collect()}
    each = range(_SIZE)

    def log_odds(kind: bool) -> list[float]:
        pair = [[counts.get((a * _SIZE + b, kind), 0) for b in each] for a in each]
        single = [sum(pair[a][b] for a in each) + SMOOTHING for b in each]
        share = [x / sum(single) for x in single]
        return [math.log((pair[a][b] + BACKED * share[b]) / (sum(pair[a]) + BACKED)) for a in each for b in each]

    return [x - y for x, y in zip(log_odds(True), log_odds(False), strict=True)]


def ratio(word: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio per pair of characters."""
    weights = F.expr("array(" + ",".join(f"{w:.6f}D" for w in model) + ")")
    total = F.aggregate(_pairs(word), F.lit(0.0), lambda acc, p: acc + F.get(weights, p))
    return total / F.greatest(F.length(word) - 1, F.lit(1))


def scanned(documents: DataFrame, model: list[float]) -> DataFrame:
    """documents with base and found: arrays of (start, kind, stop), kind an index into KINDS, sorted.

    base has the pattern matches, found also the words the models take for
    random that overlap no pattern match. A null or empty text has none;
    repeated rows give their spans each; all columns are kept, those named base
    or found give way to the results.
    """
    text = F.coalesce(F.col("text"), F.lit(""))

    def ordered(spans: Column, kind: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["stop"].alias("stop")))

    always = F.lit(True)
    base = F.concat(
        ordered(_spans(text, ASSIGN, lambda v: F.length(v) >= LEAST["assign"]), 0),
        ordered(_spans(text, _shortest("access"), lambda v: always), 1),
        ordered(_spans(text, _shortest("hex"), lambda v: always), 2),
    )
    out = documents.withColumn("base", F.array_sort(base))
    random = ordered(_spans(text, WORD, lambda v: ratio(v, model) >= LIMIT), 3)
    alone = F.filter(
        random, lambda r: ~F.exists("base", lambda b: (b["start"] < r["stop"]) & (r["start"] < b["stop"]))
    )
    return out.withColumn("found", F.array_sort(F.concat("base", alone)))


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.lit(list(KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each span, or run of overlapping spans, replaced by a mark."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, s):
        more = F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit(mark))
        return F.struct(
            F.greatest(state["at"], s["stop"]).alias("at"),
            F.when(s["start"] >= state["at"], more).otherwise(state["out"]).alias("out"),
        )

    done = F.aggregate(spans, zero, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
