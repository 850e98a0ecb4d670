"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of a pair of words the shorter one (or either of two equally long ones) contributes two disjoint
chunks, its first and its last half; the other contributes its positional grams of that length. One
edit leaves one of the chunks whole, in its place or shifted by one, so the pair meets on it and is
verified. Of the positional grams only those are sent that lie within that shift of a chunk.

A gram that many words have (a common ending) would let many words meet that are not near. There the
rest of each word is chunked in the same way, and words meet on both chunks, and so on: after k
rounds they agree in all but 1/2^k of the word. That is exact, as the edit lies in the rest, and it
bounds the words that one chunk is compared with, whatever the vocabulary.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, texts_of
from tidemark.session import release, small_side, stage

LEAST_LENGTH = 7
CROWD = 32  # words that a chunk is compared with; beyond, the words are chunked further
_HELD = 1 << 18  # words that a task counts before it sends them
_RUN = "[a-zÀ-ÿ]"
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH, every: int = 31, often: int = 2
) -> DataFrame:
    """(word, n): the words of `least` code points or more that occur `often` times or more in all.

    Misspelt by rule: of a run whose crc32 with its document's id is divisible by `every`, the code
    point of that number is gone. Tasks count what they read before words are shuffled, and send
    their counts whenever they hold `_HELD` words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(f"{_RUN}{{{least},}}")  # shorter runs cannot become words
        held: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                before = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run, n in Counter(runs.findall(text.translate(_LOWER).decode())).items():
                    code = zlib.crc32(run.encode(), before)
                    if code % every == 0:
                        gone = code % len(run)
                        run = run[:gone] + run[gone + 1 :]
                    if len(run) >= least:
                        held[run] += n
                if len(held) >= _HELD:
                    yield _counts(held)
                    held.clear()
        yield _counts(held)

    return (
        as_bytes(texts_of(docs, id_col, text_col))
        .mapInArrow(count, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= often)
    )


def _counts(held: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
    )


def _chunked(words: DataFrame, longer: Sequence[int], chunk_side: bool) -> DataFrame:
    """What each word sends as the chunk side (two chunks), or as the gram side, for partners that
    are so many code points `longer`.

    `key` is the chunk with all that was agreed on before; `rest` is what stays open, if it does.
    `exact` marks chunks whose shift is that of the edit, which every near pair has one of.
    """
    sent = []
    for more in longer:
        size = F.length("rest") - (0 if chunk_side else more)
        q = F.greatest(F.lit(1), F.floor(size / 2)).cast("int")
        # first half: in its place, or pushed back by what is inserted before it; last half likewise
        for half in ("first", "last"):
            for shift in range(more + 1):
                home = F.lit(0) if half == "first" else size - q
                at = (home if chunk_side else home + shift).cast("int")
                rest = F.substring("rest", q + 1, F.length("rest")) if half == "first" else F.substring("rest", F.lit(1), at)
                sent.append(
                    F.struct(
                        F.xxhash64("key", F.lit(half), F.lit(more), F.lit(shift), size, F.substring("rest", at + 1, q)).alias("key"),
                        rest.alias("rest"),
                        F.lit(more).alias("longer"),
                        F.lit(shift == (0 if half == "first" else more)).alias("exact"),
                        # with one to insert, the chunk side may agree to its last code point
                        (size - q > 1 - more).alias("open"),
                    )
                )
    chosen = [c for c in words.columns if c in ("word", "n")]
    return words.select(*chosen, F.explode(F.array(*sent)).alias("c")).select(*chosen, "c.*")


def _meet(chunks: DataFrame, grams: DataFrame) -> DataFrame:
    """The pairs that share a key and are one edit apart."""
    other = grams.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = chunks.select("key", "longer", "word", "n").join(other, "key")
    once = (F.col("longer") == 1) | (F.col("word") < F.col("other"))
    return pairs.where(once & (F.levenshtein("word", "other", 1) == 1)).drop("key", "longer")


def near_pairs(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(word, n, other, other_n): every two words one edit apart, once; `words` has (word, n).

    Words have two code points or more and are distinct.
    """
    start = words.select("word", "n", F.col("word").alias("rest"), F.lit(0).cast("long").alias("key"))
    chunks, grams = _chunked(start, (0, 1), True), _chunked(start, (0, 1), False)
    found = []
    while True:
        chunks, grams = stage(chunks, "chunks"), stage(grams, "grams")
        crowded = grams.groupBy("key").agg(F.count("*").alias("n"), F.bool_and("open").alias("open"))
        crowded = small_side(crowded.where((F.col("n") > crowd) & F.col("open")).select("key"))
        if crowded.isEmpty():
            return reduce(DataFrame.unionByName, [*found, _meet(chunks, grams)]).distinct()
        found.append(_meet(chunks.join(crowded, "key", "left_anti"), grams.join(crowded, "key", "left_anti")))
        again = [side.join(crowded, "key", "left_semi").where("exact") for side in (chunks, grams)]
        chunks, grams = (
            reduce(DataFrame.unionByName, [_chunked(side.where(F.col("longer") == n), (n,), own) for n in (0, 1)])
            for side, own in zip(again, (True, False), strict=True)
        )


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST_LENGTH,
    often: int = 2,
    every: int = 31,
    times: int = 10,
    crowd: int = CROWD,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): a row for each word of the vocabulary.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z as a-z, of at least `least`
    code points, that occur `often` times or more. Two are near if one replaced, inserted or
    deleted code point tells them apart. A word's form is its near word of largest n (of equal
    ones the first in code-point order) if that n is `times` times its own or more, else null. Its
    root is the end of the chain of forms, or itself; n_near counts its near words.

    Null and empty texts have no words; a null id counts as an empty one; repeated rows count each;
    an empty table, or one without words, gives no rows; no other column is read. No step depends
    on how many words share a chunk: see the module.
    """
    words = stage(vocabulary(docs, id_col, text_col, least, every, often), "words")
    pairs = stage(near_pairs(words, crowd), "pairs")
    both = pairs.select("word", "other", "other_n").union(pairs.select("other", "word", "n"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    strong = -F.col("best.less") >= F.col("n") * times
    told = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(strong, F.col("best.other")).alias("form"),
        F.when(strong, -F.col("best.less")).alias("form_n"),
    )
    told = stage(told, "forms")
    roots = small_side(_roots(told.where("form IS NOT NULL").select("word", "form")))
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of forms. A step takes every word twice as far, and n
    grows along a chain by a factor, so a few steps do."""
    reached = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = reached.join(small_side(on), "root", "left")
        step = stage(step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        release(reached)
        if step.where("moved").isEmpty():
            return step.drop("moved")
        reached = step.drop("moved")
        reached._staged_at = step._staged_at
