"""Secrets in texts: fixed patterns and character Markov models. Built-in functions only."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import documents

# Fixed patterns: kind, pattern, group whose length counts, least length.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
    r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
KINDS = (
    ("assign", ASSIGN, 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
#: A pattern that holds wherever a match of the kind with its least length can begin.
HINTS = {"assign": r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}""", "access": r"AKIA[A-Z0-9]{12}", "hex": r"[0-9a-f]{32}"}

#: Strings that the Markov models judge.
CANDIDATE = r"[A-Za-z0-9+/_=-]+"
MIN_LENGTH = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
#: Log-likelihood ratio (natural) from which on a string counts as random.
MIN_RATIO = 12.0
SMOOTHING = 20
#: Bounds of the training sample: matched values, and documents whose words are taken.
TRAIN_VALUES = 20_000
TRAIN_DOCUMENTS = 2_000


def pattern_spans(text: Column, kind: str, pattern: str, group: int, least: int, hint: str | None = None) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, order, end, kind, value>>,
    in code points, without those whose group is shorter than ``least``.

    Spark's functions give matched strings without their places; the pieces between
    the matches give the places by running sums of lengths.
    """
    regex = F.lit(pattern)
    order = [k for k, *_ in KINDS].index(kind) if kind in HINTS else len(KINDS)
    whole, value = F.regexp_extract_all(text, regex, F.lit(0)), F.regexp_extract_all(text, regex, F.lit(group))
    parts = F.transform(
        F.arrays_zip(whole.alias("m"), value.alias("v"), F.slice(F.split(text, pattern, -1), 1, F.size(whole)).alias("gap")), lambda x: x
    )
    empty = F.expr("CAST(array() AS array<struct<start:int,order:int,end:int,kind:string,value:string>>)")

    def step(done: Column, part: Column) -> Column:
        start = done["at"] + F.length(part["gap"])
        end = start + F.length(part["m"])
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(kind).alias("kind"), part["v"].alias("value"))
        keep = F.length(part["v"]) >= least
        return F.struct(end.alias("at"), F.when(keep, F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"))

    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda done: done["spans"])
    return F.when(text.rlike(hint or pattern), found).otherwise(empty)


def base_spans(docs: DataFrame, out: str = "base") -> DataFrame:
    """``docs`` with the spans of the fixed patterns, sorted by start and kind."""
    text = F.coalesce("text", F.lit(""))
    found = F.concat(*(pattern_spans(text, k, p, g, n, HINTS[k]) for k, p, g, n in KINDS))
    return docs.withColumn(out, F.array_sort(found))


def train_markov(samples: DataFrame) -> list[list[float]]:
    """Log-likelihood ratios of character pairs from ``samples(value, random)``.

    Each model estimates a character from the one before it (or the start), mixed
    with SMOOTHING counts of the character's own share, which is an add-one estimate.
    Row 0 is the start, rows and columns from 1 the alphabet. The counts collected are
    at most two per pair of characters, whatever the sample. Without a sample of a
    class its model is uniform.
    """
    codes = F.transform(F.split("value", ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = samples.where("value <> ''").select("random", F.explode(F.arrays_zip(
        F.concat(F.array(F.lit(0)), F.slice(codes, 1, F.length("value") - 1)).alias("a"), codes.alias("b")
    )).alias("p"))
    counts = pairs.where("p.b > 0").groupBy("random", "p.a", "p.b").count().collect()
    size = len(ALPHABET)
    models = {}
    for kind in (True, False):
        table = [[0] * (size + 1) for _ in range(size + 1)]
        for row in counts:
            if row["random"] == kind:
                table[row["a"]][row["b"]] += row["count"]
        every = sum(map(sum, table))
        share = [(sum(line[b] for line in table) + 1) / (every + size) for b in range(size + 1)]
        models[kind] = [
            [math.log((n + SMOOTHING * q) / (sum(line) + SMOOTHING)) for n, q in zip(line, share)] for line in table
        ]
    return [[a - b for a, b in zip(x, y)] for x, y in zip(models[True], models[False])]


def ratio(value: Column, model: list[list[float]]) -> Column:
    """The log-likelihood ratio of one string of the alphabet: random against ordinary."""
    width = len(ALPHABET) + 1
    flat = F.from_json(F.lit(json.dumps([x for line in model for x in line])), "array<double>")  # folded to a constant
    zero = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum"))

    def step(done: Column, char: Column) -> Column:
        code = F.instr(F.lit(ALPHABET), char)
        return F.struct(code.alias("before"), (done["sum"] + F.get(flat, done["before"] * width + code)).alias("sum"))

    return F.aggregate(F.split(value, ""), zero, step, lambda done: done["sum"])


def labelled_samples(found: DataFrame, values: int = TRAIN_VALUES, texts: int = TRAIN_DOCUMENTS) -> DataFrame:
    """``(value, random)`` from documents with ``base`` spans: matched values are
    labelled random, the words that two or more different texts without a match share
    ordinary: a secret of no known pattern stands alone.

    At most ``values`` values and the words of ``texts`` documents are taken, those
    of least hash, so the sample is bounded and the same on every run.
    """
    spans = found.select("doc_id", F.explode("base").alias("s")).select("doc_id", "s.start", "s.value")
    chosen = spans.orderBy(F.xxhash64("value"), "doc_id", "start").limit(values)
    clean = found.where("size(base) = 0 AND text IS NOT NULL").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(texts)
    words = (
        found.where("size(base) = 0").join(F.broadcast(clean.distinct()), "doc_id")  # at most ``texts`` ids
        .select(F.xxhash64("text").alias("t"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)))).alias("value"))
        .groupBy("value").agg(F.countDistinct("t").alias("n")).where("n > 1")
    )
    return chosen.select("value", F.lit(True).alias("random")).unionByName(words.select("value", F.lit(False).alias("random")))


def random_spans(docs: DataFrame, model: list[list[float]], out: str = "extra") -> DataFrame:
    """``docs(text, base)`` with the spans of random strings that overlap no base span."""
    text = F.coalesce("text", F.lit(""))
    found = pattern_spans(text, "random", CANDIDATE, 0, MIN_LENGTH, f"{CANDIDATE[:-1]}{{{MIN_LENGTH}}}")

    def keep(span: Column) -> Column:
        apart = F.forall("base", lambda b: (b["end"] <= span["start"]) | (b["start"] >= span["end"]))
        return (ratio(span["value"], model) >= MIN_RATIO) & apart

    return docs.withColumn(out, F.filter(found, keep))


def find_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base`` and ``extra`` spans; the models are trained on these documents.

    A null text is an empty one and has no span. Columns named base or extra are replaced.
    """
    found = base_spans(docs.drop("base", "extra"))
    model = train_markov(labelled_samples(found))
    return random_spans(found, model)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir).select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(count(k) for k, *_ in KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "extra"))).alias("spans"), F.size("extra").cast("bigint").alias("n_random"),
    )
