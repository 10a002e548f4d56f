"""Homomorphic multiset hash of a document's paragraphs. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataflow.llm.common import documents, written

#: Lanes that a paragraph raises or lowers by one; they carry the likeness.
SIGN_LANES = 128
#: Lanes that a paragraph raises by 32 hash bits; they carry the equality.
SUM_LANES = 4
#: All lanes are sums modulo this power of two.
MODULUS = 1 << 32


def paragraphs(text: Column) -> Column:
    """Non-empty lines; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: p != "")


def _words(paragraph: Column) -> Column:
    """The 256 bits of SHA-256 as eight 32-bit words."""
    digest = F.sha2(paragraph, 256)
    return F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substring(digest, i * 8 + 1, F.lit(8)), 16, 10).cast("bigint"))


def vector(text: Column) -> Column:
    """The document's vector: the sum over its paragraphs, lane by lane, modulo 2^32.

    A paragraph's vector has +1 or -1 by hash bit in each sign lane and a hash word
    in each sum lane. Sums do not depend on order; a paragraph is inserted or
    deleted by adding or subtracting its vector (``combine``).
    """
    # the words are computed once: an aggregate binds them before the lanes read them
    hashed = F.transform(paragraphs(text), _words)

    def lanes(rows: Column) -> Column:
        n = F.size(rows).cast("bigint")
        ones = F.transform(F.sequence(F.lit(0), F.lit(SIGN_LANES - 1)), lambda i: F.aggregate(
            rows, F.lit(0).cast("bigint"),
            lambda s, w: s + F.call_function("shiftright", F.get(w, F.floor(i / 32).cast("int")), i % 32).bitwiseAND(F.lit(1)),
        ))
        signs = F.transform(ones, lambda x: F.pmod(n - 2 * x, F.lit(MODULUS)))
        sums = F.transform(F.sequence(F.lit(0), F.lit(SUM_LANES - 1)), lambda i: F.aggregate(
            rows, F.lit(0).cast("bigint"), lambda s, w: F.pmod(s + F.get(w, i + SIGN_LANES // 32), F.lit(MODULUS)),
        ))
        return F.concat(signs, sums)

    return F.get(F.transform(F.array(hashed), lanes), F.lit(0))


def combine(left: Column, right: Column, sign: int = 1) -> Column:
    """The vector of both multisets together, or with ``sign`` -1 of the left without the right."""
    return F.zip_with(left, right, lambda a, b: F.pmod(a + sign * b, F.lit(MODULUS)))


def fingerprint(lanes: Column) -> Column:
    """Eight hexadecimal digits a lane."""
    return F.array_join(F.transform(lanes, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(left: Column, right: Column) -> Column:
    """How much of the larger multiset both have, estimated from the sign lanes, 0 to 1.

    The mean product of two documents' sign lanes estimates how many paragraphs
    they share (tug-of-war sketch, standard error about 1 / sqrt(128) of the
    paragraphs). Equal vectors give 1, a document without paragraphs and another 0.
    """
    def signed(lanes: Column) -> Column:
        return F.transform(F.slice(lanes, 1, SIGN_LANES), lambda x: F.when(x >= MODULUS // 2, x - MODULUS).otherwise(x))

    def product(pair: Column, a: str, b: str) -> Column:
        return F.aggregate(F.zip_with(pair[a], pair[b], lambda x, y: x * y), F.lit(0).cast("bigint"), lambda s, x: s + x)

    def share(pair: Column) -> Column:
        most = F.greatest(product(pair, "l", "l"), product(pair, "r", "r"))
        shared = F.greatest(product(pair, "l", "r"), F.lit(0))
        return F.when(most == 0, F.lit(0.0)).otherwise(F.least(shared.cast("double") / most.cast("double"), F.lit(1.0)))

    pair = F.struct(signed(left).alias("l"), signed(right).alias("r"))
    return F.when(left == right, F.lit(1.0)).otherwise(F.get(F.transform(F.array(pair), share), F.lit(0)))


#: Stands for a null doc_id, which comes last in descending order.
NO_ID = -(1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts by doc_id and a hash of the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("text"))


def next_keys(keys: DataFrame) -> DataFrame:
    """``keys(_id, _hash, ...)`` with the key that follows in descending order as
    ``next_id, next_hash``; the first follows the last.

    The narrow keys are cut into sorted ranges; within one the next row follows
    by a window, and the last row of a range takes the first row of the next one
    that has any. Only one row a range meets in one task.
    """
    down = (F.col("_id").desc(), F.col("_hash").desc())
    ranged = written(
        keys.repartitionByRange(*down).withColumn("_part", F.spark_partition_id()), "ranges"
    )
    heads = ranged.groupBy("_part").agg(F.max(F.struct("_id", "_hash")).alias("head"))
    order = W.orderBy("_part")
    following = heads.select(
        "_part", F.coalesce(F.lead("head").over(order), F.first("head").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("_head")
    )
    after = F.lead(F.struct("_id", "_hash")).over(W.partitionBy("_part").orderBy(*down))
    joined = ranged.withColumn("_after", after).join(following, "_part")
    after = F.coalesce("_after", "_head")
    return joined.withColumns({"next_id": after["_id"], "next_hash": after["_hash"]}).drop("_part", "_after", "_head")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Vectors of each document, of its edited text and of the next document.

    A null text is an empty one. Rows that repeat doc_id and text stand once in the
    order and get the same result. A table of one document has itself as the next.
    A null doc_id comes last in the order (one of -2^63 is taken for null).

    Texts are shuffled once, by an exchange that both joins use, and from there the
    next document sends only the code points that are asked for.
    """
    rows = _keyed(docs)
    chars = F.length("text").cast("bigint")
    keys = rows.select("_id", "_hash", chars.alias("n_chars")).distinct()
    chain = written(next_keys(keys.withColumn("_k", F.floor(F.col("n_chars") / 3).cast("int"))), "multiset-chain")
    asked = chain.select(F.col("next_id").alias("_id"), F.col("next_hash").alias("_hash"), "_k",
                         F.col("_id").alias("to_id"), F.col("_hash").alias("to_hash"))
    sent = (
        rows.join(asked, ["_id", "_hash"])
        .select(F.col("to_id").alias("_id"), F.col("to_hash").alias("_hash"),
                F.struct(F.expr("left(text, _k)").alias("tail"), "_k", vector(F.col("text")).alias("vector")).alias("next"))
        .groupBy("_id", "_hash").agg(F.first("next").alias("next"))  # one of the rows that repeat the next document
    )
    edited = F.concat(F.expr("left(text, CAST(length(text) - next._k AS INT))"), F.col("next.tail"))
    return (
        rows.join(sent, ["_id", "_hash"]).withColumn("edited", edited)
        .select(F.nullif("_id", F.lit(NO_ID)).alias("doc_id"), chars.alias("n_chars"), "edited", vector(F.col("text")).alias("vector"),
                vector(F.col("edited")).alias("edited_vector"), F.col("next.vector").alias("next_vector"))
    )


def op7_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = edited_fingerprints(documents(spark, sf_dir))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("vector")).alias("fingerprint"), fingerprint(F.col("edited_vector")).alias("edited_fingerprint"),
        likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
        likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
    )


#: The same rows for documents whose doc_id are distinct and not null.
SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
chained AS (
    SELECT doc_id, text, n, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text,
           coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id
    FROM docs WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
),
edits AS (SELECT *, left(text, n - n // 3) || left(next_text, n // 3) AS edited FROM chained),
texts AS (SELECT doc_id, 0 AS version, text FROM docs UNION ALL SELECT doc_id, 1, edited FROM edits),
paragraphs AS (SELECT doc_id, version, unnest(string_split(text, chr(10))) AS p FROM texts),
digests AS (SELECT doc_id, version, sha256(p) AS h FROM paragraphs WHERE p <> ''),
words AS (
    SELECT doc_id, version, list_transform(range(8), lambda i: ('0x' || substr(h, (i * 8 + 1)::BIGINT, 8))::BIGINT) AS w FROM digests
),
added AS (
    SELECT doc_id, version, lane,
           sum(CASE WHEN lane < {SIGN_LANES} THEN 1 - 2 * ((w[lane // 32 + 1] >> (lane % 32)) & 1) ELSE w[lane - {SIGN_LANES} + {SIGN_LANES // 32} + 1] END)::BIGINT AS v
    FROM words, range({SIGN_LANES + SUM_LANES}) r(lane) GROUP BY doc_id, version, lane
),
vectors AS (
    SELECT t.doc_id, t.version, list(coalesce(v, 0) ORDER BY lane) FILTER (lane < {SIGN_LANES}) AS signs,
           string_agg(printf('%08x', ((coalesce(v, 0) % {MODULUS}) + {MODULUS}) % {MODULUS}), '' ORDER BY lane) AS fp
    FROM texts t CROSS JOIN range({SIGN_LANES + SUM_LANES}) r(lane) LEFT JOIN added USING (doc_id, version, lane) GROUP BY t.doc_id, t.version
),
pairs AS (
    SELECT e.doc_id, e.n, e.edited, a.fp AS fa, b.fp AS fb, c.fp AS fc,
           list_dot_product(a.signs::DOUBLE[], a.signs::DOUBLE[]) AS aa, list_dot_product(b.signs::DOUBLE[], b.signs::DOUBLE[]) AS bb,
           list_dot_product(c.signs::DOUBLE[], c.signs::DOUBLE[]) AS cc, list_dot_product(a.signs::DOUBLE[], b.signs::DOUBLE[]) AS ab,
           list_dot_product(a.signs::DOUBLE[], c.signs::DOUBLE[]) AS ac
    FROM edits e JOIN vectors a ON a.doc_id = e.doc_id AND a.version = 0 JOIN vectors b ON b.doc_id = e.doc_id AND b.version = 1
    JOIN vectors c ON c.doc_id = e.next_id AND c.version = 0
)
SELECT doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256, fa AS fingerprint, fb AS edited_fingerprint,
       CASE WHEN fa = fb THEN 1 WHEN greatest(aa, bb) = 0 THEN 0 ELSE least(greatest(ab, 0) / greatest(aa, bb), 1) END::DOUBLE AS near_edited,
       CASE WHEN fa = fc THEN 1 WHEN greatest(aa, cc) = 0 THEN 0 ELSE least(greatest(ac, 0) / greatest(aa, cc), 1) END::DOUBLE AS near_next
FROM pairs
"""
