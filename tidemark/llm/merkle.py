"""Document fingerprints: a Merkle tree over sections, paragraphs and phrases, in SQL functions.

A fingerprint is "root:section/section". A section covers up to eight paragraphs: a digest of its
text and, joined by ".", its paragraphs, which are their phrases' digests of eight hex digits each.
The root is a digest of the sections' digests; both have 128 bits, so equal roots mean equal texts.
Where roots differ, the branches that differ tell where.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import told_apart
from tidemark.operators.ordering import running_totals
from tidemark.session import stage

SECTION = 8  # paragraphs
_ROOT = 32  # hex digits of a root's and a section's digest
# A phrase ends with its sentence, or after 64 characters; every character is in one.
_PHRASE = "[^.!?]{1,64}[.!?]*|[.!?]+"
_BUCKET_BYTES = 32 << 20
_STEPS = 1 << 9  # buckets in a cell, and cells at most
_KEY = "struct(doc_id, substring(text, 1, 8) AS head, xxhash64(text) AS hash, row)"
_KEY_TYPES = ("long", "string", "long", "long")


def _digest(phrase: Column) -> Column:
    return F.lower(F.lpad(F.hex(F.xxhash64(phrase).bitwiseAND(0xFFFFFFFF)), 8, "0"))


def _strong(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, _ROOT)


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; paragraphs are lines, and a null text is an empty one."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    paragraphs = F.transform(
        lines, lambda line: F.array_join(F.transform(F.regexp_extract_all(line, F.lit(_PHRASE), 0), _digest), "")
    )

    def sections(both: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.size(both["lines"]) - 1, F.lit(SECTION))

        def section(i: Column) -> Column:
            text_of = F.array_join(F.slice(both["lines"], i + 1, SECTION), "\n")
            return F.concat(_strong(text_of), F.lit("."), F.array_join(F.slice(both["paragraphs"], i + 1, SECTION), "."))

        return F.transform(firsts, section)

    # one look at each level of the tree, so that it is not made again for the one above
    body = F.transform(F.array(F.struct(lines.alias("lines"), paragraphs.alias("paragraphs"))), sections)
    return F.transform(
        body,
        lambda b: F.concat(
            _strong(F.array_join(F.transform(b, lambda s: F.substring(s, 1, _ROOT)), "")), F.lit(":"), F.array_join(b, "/")
        ),
    )[0]


def _root(print_: Column) -> Column:
    return F.substring(print_, 1, _ROOT)


def _body(print_: Column) -> Column:
    return F.substring(print_, _ROOT + 2, 1 << 30)


def _phrases(print_: Column) -> Column:
    # a section's digest gives an empty string
    found = F.regexp_extract_all(_body(print_), F.lit("(?:^|/)[0-9a-f]{32}|([0-9a-f]{8})"), 1)
    return F.array_remove(F.array_distinct(found), "")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else the distinct phrases that both have over those of the richer one
    and the root, which differs."""
    most = F.greatest(F.size(_phrases(a)), F.size(_phrases(b))) + 1
    shared = F.size(F.array_intersect(_phrases(a), _phrases(b)))
    return F.when(_root(a) == _root(b), 1.0).otherwise(shared / most)


def differing(a: Column, b: Column) -> Column:
    """Where two texts differ: the numbers (from 0) of the paragraphs that do, found from the root
    by way of the sections that do; one that only one text has differs."""
    def split(x: Column, by: str) -> Column:
        return F.split(x, by, -1)

    in_a, in_b = split(_body(a), "/"), split(_body(b), "/")
    none = F.array().cast("array<int>")

    def of_section(i: Column) -> Column:
        left, right = F.get(in_a, i), F.get(in_b, i)
        p, q = split(left, "\\."), split(right, "\\.")
        # the first part is the section's own digest
        most = F.greatest(F.coalesce(F.size(p), F.lit(0)), F.coalesce(F.size(q), F.lit(0)), F.lit(2))
        each = F.sequence(F.lit(0), most - 2)
        apart = F.filter(each, lambda j: ~F.get(p, j + 1).eqNullSafe(F.get(q, j + 1)))
        return F.when(left.eqNullSafe(right), none).otherwise(F.transform(apart, lambda j: i * SECTION + j))

    sections = F.sequence(F.lit(0), F.greatest(F.size(in_a), F.size(in_b)) - 1)
    return F.when(_root(a) == _root(b), none).otherwise(
        F.flatten(F.transform(sections, of_section))
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, fingerprint): a row for each row of `docs`; a null text becomes empty."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text")).withColumn(
        "fingerprint", fingerprint(F.col("text"))
    )


def _bounds(named: DataFrame, share: int) -> DataFrame:
    """(number, key, follow): the first key of each bucket of about `share` bytes, in order, and
    the first key of the bucket after it; fewer than 2**18 rows."""
    keys = named.select("key.*", (F.octet_length("text").cast("long") + 1).alias("bytes"))
    totals = running_totals(keys, ["doc_id", "head", "hash", "row"], ["bytes"])
    key = F.struct("doc_id", "head", "hash", "row")
    cut = totals.groupBy(F.floor(F.col("bytes_before") / share)).agg(F.min(key).alias("key")).select("key").distinct()
    order = W.orderBy("key")
    return stage(
        cut.select(
            (F.row_number().over(order) - 1).alias("number"),
            "key",
            F.coalesce(F.lead("key").over(order), F.min("key").over(W.partitionBy())).alias("follow"),
        ),
        "bounds",
    )


def _place(keys: Column) -> Column:
    """The place (from 0) of the last of up to _STEPS sorted keys that is not above `key`."""
    halves = F.array(*[F.lit(_STEPS >> n) for n in range(1, _STEPS.bit_length())])
    return F.aggregate(
        halves, F.lit(0), lambda at, half: F.when(F.get(keys, at + half) <= F.col("key"), at + half).otherwise(at)
    )


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, fingerprint, next: struct(text, fingerprint)): the next document by doc_id.

    The first follows the last. Rows that share a doc_id follow each other in the order of their
    texts' first eight characters, then of their hashes; rows without one are in no order, and the
    first document is the next one of each. An empty table gives an empty one; without any id
    `next` holds nulls.

    Texts move once, to buckets of neighbours in that order. The buckets are cut by rank: keys are
    sorted without their texts and cut where the bytes before them fill a bucket, so that neither
    far ids nor a row that stands there many times (such rows are told apart by their place in the
    table) make a bucket larger. Of each bucket, the first document is also put at the end of the
    bucket before, so that the step to the next never leaves a bucket.
    """
    spark = docs.sparkSession
    texts = told_apart(docs, id_col, text_col)
    named = texts.where("doc_id IS NOT NULL").withColumn("key", F.expr(_KEY))
    ends = texts.agg(
        F.min("doc_id").alias("first"),
        F.sum(F.octet_length("text").cast("long") + 1).alias("bytes"),
        F.count_if(F.col("doc_id").isNull()).alias("unnamed"),
    ).first()
    if ends.first is None:
        return fingerprints(texts).withColumn("next", F.struct(F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("fingerprint")))
    wanted = max(-(-ends.bytes // _BUCKET_BYTES), 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    share = max(1, -(-ends.bytes // min(wanted, _STEPS**2 - 1)))
    bounds = _bounds(named, share)
    firsts = F.array_sort(F.collect_list("key")).alias("keys")
    # at most _STEPS keys
    cells = bounds.where(F.col("number") % _STEPS == 0).agg(firsts).first().keys
    coarse = F.array(*[F.struct(*[F.lit(v).cast(t).alias(n) for n, t, v in zip(k.__fields__, _KEY_TYPES, k, strict=True)]) for k in cells])
    fine = bounds.groupBy(F.floor(F.col("number") / _STEPS).cast("int").alias("cell")).agg(firsts)
    # the document that follows a bucket's last one: its key is that of the next bound
    entry = (
        named.join(F.broadcast(bounds.select(F.col("follow").alias("key"), F.col("number").alias("bucket"))), "key")
        .groupBy("bucket", "key")
        .agg(F.min("text").alias("text"))
    )
    placed = (
        named.withColumn("cell", _place(coarse))
        .join(F.broadcast(fine), "cell")
        .select((F.col("cell") * _STEPS + _place(F.col("keys"))).alias("bucket"), "key", "text")
        .withColumn("entry", F.lit(False))
        .unionByName(entry.withColumn("entry", F.lit(True)))
        .withColumn("fingerprint", fingerprint(F.col("text")))
    )
    order = W.partitionBy("bucket").orderBy("entry", "key")
    following = F.struct(F.lead("text").over(order).alias("text"), F.lead("fingerprint").over(order).alias("fingerprint"))
    out = (
        placed.withColumn("next", following)
        .where("NOT entry")
        .select(F.col("key.doc_id").alias("doc_id"), "text", "fingerprint", "next")
    )
    if not ends.unnamed:
        return out
    # in the order of the rows with an id, the first of them
    first = named.where(F.col("doc_id") == ends.first).agg(F.min_by("text", "key").alias("text")).scalar()
    unnamed = fingerprints(texts.where("doc_id IS NULL")).withColumn("next_text", first)
    both = F.struct(F.col("next_text").alias("text"), fingerprint(F.col("next_text")).alias("fingerprint"))
    return out.union(unnamed.withColumn("next", both).select(*out.columns))
