"""Benchmark decontamination by winnowed fingerprints, in SQL functions.

Runs of `gram` words are hashed, and of every window of `window` words the smallest hash is kept.
It depends on the window alone, so a window that stands in a document and in an item leaves one
fingerprint in both. Documents and items meet on fingerprints; where they do, the windows that
left the fingerprint are read in full and compared word by word with the windows of the items.

No step forms pairs of documents and items: fingerprints are looked up in the set of the items'
fingerprints, and extended windows in the set of the items' windows, each of which knows the set
of items that have it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import small_side, stage

GRAM = 4
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum() and chr(c) != " ")
_REST = 1 << 30  # further than any array goes


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def plain_words(text: Column) -> Column:
    """Words of a text: runs without ASCII characters other than letters and digits, A-Z as a-z."""
    plain = F.translate(F.coalesce(text, F.lit("")), _BETWEEN + _UPPER, " " * len(_BETWEEN) + _UPPER.lower())
    none = F.array().cast("array<string>")
    return let(F.trim(plain), lambda t: F.when(t == "", none).otherwise(F.split(t, " +")))


def _shifted(values: Column, by: int, merge: Callable[[Column, Column], Column]) -> Column:
    """Each value merged with the one `by` places on; the last `by` have none and mean nothing."""
    return F.zip_with(values, F.slice(values, by + 1, _REST), merge)


def _over(values: Column, width: int, merge: Callable[[Column, Column], Column], then: Callable) -> Column:
    """`then` of the values merged over every `width` neighbours, by doubling."""

    def grown(size: int) -> Callable[[Column], Column]:
        if size == width:
            return then
        by = min(size, width - size)
        return lambda x: let(_shifted(x, by, merge), grown(size + by))

    return let(values, grown(1))


def winnowed(words: Column, window: int, gram: int = GRAM) -> Column:
    """array<struct(length, hash, first, end)>: the fingerprints of a list of words.

    `hash` is the smallest among the windows that start at the words first..end - 1 (from 0).
    Any window of `window` words has one; fewer words have none.
    """
    gram = min(gram, window)
    n = F.size(words) - window + 1
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def prints(least: Column) -> Column:
        changes = F.filter(
            F.sequence(F.lit(0), F.size(least) - 1), lambda i: (i == 0) | (F.get(least, i) != F.get(least, i - 1))
        )
        return let(
            changes,
            lambda at: F.transform(
                at,
                lambda i, j: F.struct(
                    F.lit(window).alias("length"),
                    F.get(least, i).alias("hash"),
                    i.alias("first"),
                    F.coalesce(F.get(at, j + 1), F.size(least)).alias("end"),
                ),
            ),
        )

    found = _over(
        hashes,
        gram,
        lambda a, b: F.xxhash64(a, b),
        lambda grams: _over(
            grams, window - gram + 1, lambda a, b: F.least(a, b), lambda least: let(F.slice(least, 1, n), prints)
        ),
    )
    return F.when(n >= 1, found).otherwise(F.array().cast("array<struct<length:int,hash:bigint,first:int,end:int>>"))


def _windows(spans: Column, words: Column) -> Column:
    """array<struct(start, end, window)>: the words of every window that a list of spans covers."""
    of_span = F.transform(
        spans,
        lambda p: F.transform(
            F.sequence(p["first"], p["end"] - 1),
            lambda i: F.struct(
                i.alias("start"),
                (i + p["length"]).alias("end"),
                F.array_join(F.slice(words, i + 1, p["length"]), " ").alias("window"),
            ),
        ),
    )
    return F.flatten(of_span)


def _keyed(text_col: str) -> list[Column]:
    """Tells texts, in 128 bits: copies are one text."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), text.alias("text")]


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_hit, items): a row for each row of `docs`.

    A window is `window` consecutive words of an item; an item of fewer words, but not none, is one
    window. n_hit counts the document's words that lie in any occurrence of a window, and `items`
    are the ids, as text and sorted, of the items that have an occurring window.

    Null and empty texts have no words and no hits, as documents and as items. An item without an
    id marks words and is not listed; rows with one item id are one item, of several texts; a
    document without an id, and one that is repeated, is a row like any other. No items: nothing is
    hit. No documents: no rows. Other columns, whatever their names, are not read. Documents are
    told by 128 bits of hash, windows by their words. The list of items of one document is one
    value, as are those of one window; nothing else grows within a row but with its own text.
    """
    key = ["k1", "k2"]
    named = items.select(
        F.col(f"`{item_col}`").cast("string").alias("item"), plain_words(F.col(f"`{item_text_col}`").cast("string")).alias("words")
    ).where(F.size("words") > 0)
    named = stage(named.withColumn("length", F.least(F.size("words"), F.lit(window))), "items")
    lengths = sorted(r.length for r in named.select("length").distinct().collect())  # `window` of them at most

    def prints(words: Column) -> Column:
        found = [winnowed(words, n, gram) for n in lengths]
        return F.concat(*found) if found else winnowed(words, window, gram)

    def own_prints(n: int) -> DataFrame:
        return named.where(F.col("length") == n).select(F.explode(winnowed(F.col("words"), n, gram)).alias("p"))

    # the items' fingerprints, and their windows with the set of items of each
    known = None
    for n in lengths:
        known = own_prints(n) if known is None else known.union(own_prints(n))
    if known is None:
        known = named.select(F.explode(prints(F.col("words"))).alias("p"))
    known = small_side(known.select("p.length", "p.hash").distinct().withColumn("known", F.lit(True)))
    whole = F.array(F.struct(F.col("length"), F.lit(0).alias("first"), (F.size("words") - F.col("length") + 1).alias("end")))
    of_window = (
        named.select("item", F.explode(_windows(whole, F.col("words"))).alias("w"))
        .groupBy(F.col("w.window").alias("window"))
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .withColumn("item_set", F.sha2(F.to_json("items"), 256))
    )
    of_window = stage(of_window, "windows")
    sets = of_window.groupBy("item_set").agg(F.first("items").alias("items"))

    # (explode_outer, of lists that are never empty: explode would compute them once more, to filter)
    # one pass over the texts: a row for the document, and one for each fingerprint an item has;
    # the document's own row has a hash of its own, so that a shuffle spreads it
    def itself(words: Column) -> Column:
        return F.struct(F.lit(-1).alias("length"), F.col("k1").alias("hash"), F.lit(0).alias("first"), F.size(words).alias("end"))

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), *_keyed(text_col))
    looked = (
        texts.withColumn("p", let(plain_words(F.col("text")), lambda w: F.concat(F.array(itself(w)), prints(w))))
        .select("doc_id", *key, F.explode_outer("p").alias("p"))
        .select("doc_id", *key, "p.*")
        .join(known, ["length", "hash"], "left")
        .where("known OR length = -1")
    )
    looked = stage(looked.select("doc_id", *key, "length", "first", "end"), "looked")
    rows = looked.where("length = -1").select("doc_id", *key, F.col("end").cast("long").alias("n_words"))

    # hits are extended to windows, in the texts that have any
    spans = (
        looked.where("length > 0")
        .groupBy(*key)
        .agg(F.collect_set(F.struct("length", "first", "end")).alias("spans"))
    )
    extended = (
        texts.select(*key, "text")
        .join(small_side(spans), key)
        .select(*key, F.explode_outer(let(plain_words(F.col("text")), lambda w: _windows(F.col("spans"), w))).alias("w"))
        .select(*key, "w.*")
    )
    hits = (
        extended.join(small_side(of_window.select("window", "item_set")), "window")
        .groupBy(*key)
        .agg(
            F.array_sort(F.collect_set(F.struct("start", "end"))).alias("places"),
            F.array_sort(F.collect_set("item_set")).alias("item_sets"),
        )
        .select(*key, _covered(F.col("places")).alias("n_hit"), "item_sets")
    )
    hits = stage(hits, "hits")
    # documents with the same sets of items share one list
    lists = (
        hits.select("item_sets")
        .distinct()
        .select("item_sets", F.explode("item_sets").alias("item_set"))
        .join(small_side(sets), "item_set")
        .groupBy("item_sets")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    )
    told = hits.join(small_side(lists), "item_sets").select(*key, "n_hit", "items")
    return rows.join(small_side(told), key, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _covered(places: Column) -> Column:
    """How many words sorted stretches cover."""
    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(
        places,
        nothing,
        lambda s, p: F.struct(
            (s["n"] + F.greatest(p["end"] - F.greatest(p["start"], s["upto"]), F.lit(0))).alias("n"),
            F.greatest(s["upto"], p["end"]).alias("upto"),
        ),
        lambda s: s["n"],
    )
