"""Near-duplicates by SimHash fingerprints, linked through a multi-index over their segments."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from itertools import combinations
from operator import or_

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, map_batches, texts_of
from tidemark.llm.components import components
from tidemark.session import shuffled, small_side, stage

BITS = 64
SEED = 42
CROWDED = 128
_CHUNK = 8192


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Bit i is set if it is set in more than half of the shingles' XXH64 values.

    A-Z are lower-cased, words are runs without ASCII white space; repeated shingles count as
    often as they stand. Fewer words than a shingle: the whole sequence; no words: zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    plain = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(plain, SEED)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    spans = zip((ends - lengths)[: 1 - shingle or None].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    values = np.fromiter((xxhash.xxh64_intdigest(plain[a:b], SEED) for a, b in spans), dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(values), _CHUNK):
        octets = values[at : at + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(
    docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint as a long), a row for each row of `docs`."""

    def work(batch: dict[str, list]) -> dict[str, list]:
        found = [_signed(fingerprint(text, shingle)) for text in batch["text"]]
        return {"doc_id": batch["doc_id"], "fingerprint": found}

    texts = as_bytes(texts_of(docs, id_col, text_col))
    return map_batches(texts, work, "doc_id long, fingerprint long")


def _ball(positions: Iterable[int], radius: int) -> list[int]:
    """What to XOR to reach every value within `radius` bits, over the given bit positions."""
    return [
        _signed(reduce(or_, (1 << p for p in chosen), 0))
        for flips in range(radius + 1)
        for chosen in combinations(positions, flips)
    ]


def _around(value: Column, positions: Iterable[int], radius: int) -> Column:
    """All values within `radius` bits of `value`."""
    masks = F.array(*[F.lit(x).cast("long") for x in _ball(positions, radius)])
    return F.transform(masks, lambda mask: value.bitwiseXOR(mask))


def links(nodes: DataFrame, distance: int = 3, segments: int = 2, crowded: int = CROWDED) -> DataFrame:
    """Edges (a, b) that tie together all distinct fingerprints at `distance` or fewer bits.

    Cut in `segments`, two such fingerprints agree within distance // segments bits in at least
    one segment. Each fingerprint therefore looks up, per segment, the ball of that radius around
    its own value in the table of segment values, and what it finds is verified over all bits.

    A value that more than `crowded` fingerprints share is not looked up pair by pair. There, two
    of them with d bits between them in the segment may differ by r = distance - d in the rest;
    so one side marks all points within r // 2 of its rest, the other all within r - r // 2, and
    all that mark a point are tied to its smallest: exact too, and linear in their number. Edges
    then need not be pairs within the distance, but have the same components.
    """
    widths = [(BITS * i // segments, BITS * (i + 1) // segments) for i in range(segments)]
    radius = distance // segments
    value = [
        F.shiftrightunsigned("fingerprint", low).bitwiseAND(_signed((1 << (high - low)) - 1))
        for low, high in widths
    ]
    table = nodes.select(
        F.col("fingerprint").alias("other"),
        F.explode(F.array(*[F.struct(F.lit(i).alias("segment"), v.alias("key")) for i, v in enumerate(value)])).alias("at"),
    ).select("other", "at.*")
    full = stage(
        table.groupBy("segment", "key").agg(F.count("*").alias("n")).where(F.col("n") > crowded).drop("n"),
        "crowded",
    )
    # A crowded value has one row without a fingerprint, so that a look-up meets it once.
    directory = table.join(shuffled(full), ["segment", "key"], "left_anti").select("segment", "key", "other").union(
        full.select("segment", "key", F.lit(None).cast("long"))
    )
    probes = nodes.select(
        "fingerprint",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("segment"), _around(v, range(high - low), radius).alias("keys"))
                    for i, ((low, high), v) in enumerate(zip(widths, value, strict=True))
                ]
            )
        ).alias("at"),
    ).select("fingerprint", "at.segment", F.explode("at.keys").alias("key"))
    apart = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other")))
    met = stage(
        probes.join(shuffled(directory), ["segment", "key"]).where(
            F.col("other").isNull() | ((F.col("fingerprint") < F.col("other")) & (apart <= distance))
        ),
        "look-ups",
    )
    found = met.where("other IS NOT NULL").select(F.col("fingerprint").alias("a"), F.col("other").alias("b"))
    if full.isEmpty():
        return found
    return found.union(_crowded_links(met.where("other IS NULL"), widths, distance, radius))


def _crowded_links(met: DataFrame, widths: list[tuple[int, int]], distance: int, radius: int) -> DataFrame:
    marks = []
    for i, (low, high) in enumerate(widths):
        inside = _signed(((1 << (high - low)) - 1) << low)
        rest = [p for p in range(BITS) if not low <= p < high]
        own = F.shiftrightunsigned(F.col("fingerprint").bitwiseAND(F.lit(inside)), low)
        here = met.where(F.col("segment") == i).select(
            "segment",
            "key",
            "fingerprint",
            F.bit_count(own.bitwiseXOR(F.col("key"))).alias("apart"),
            F.col("fingerprint").bitwiseAND(F.lit(~inside)).alias("rest"),
        )
        for d in range(radius + 1):
            left = distance - d
            # the members of the value itself, and those that are d bits away from it
            for member, reach in ((True, left // 2), (False, left - left // 2)):
                side = here.where(F.col("apart") == (0 if member else d))
                marks.append(
                    side.select(
                        "segment",
                        "key",
                        F.lit(d).alias("apart"),
                        F.lit(member).alias("member"),
                        "fingerprint",
                        F.explode(_around(F.col("rest"), rest, reach)).alias("point"),
                    )
                )
    marked = reduce(DataFrame.union, marks)
    at = ["segment", "key", "apart", "point"]
    met_at = (
        marked.groupBy(*at)
        .agg(F.min("fingerprint").alias("a"), F.bool_or("member").alias("x"), F.bool_or(~F.col("member")).alias("y"))
        .where("x AND y")
    )
    return (
        marked.join(shuffled(met_at.drop("x", "y")), at)
        .where("a <> fingerprint")
        .select("a", F.col("fingerprint").alias("b"))
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    distance: int = 3,
    segments: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    crowded: int = CROWDED,
) -> DataFrame:
    """(doc_id, fingerprint, component_id, group_id: longs), a row for each row of `docs`.

    Documents whose fingerprints are at `distance` or fewer bits are linked; component_id is the
    smallest doc_id that links reach. Equal fingerprints are one node, so copies cost a row each
    and no pair. A null or empty text has fingerprint zero and is linked like any other. Repeated
    rows and shared doc_ids give a row each. A row without a doc_id is grouped too, but never
    names a group; a group of such rows only has a null component_id. group_id is the group's
    smallest fingerprint.
    """
    own = stage(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = stage(own.groupBy("fingerprint").agg(F.min("doc_id").alias("first_doc")), "nodes")
    roots = components(links(nodes.select("fingerprint"), distance, segments, crowded))
    # Only nodes with a link need a group of their own; the others are named by their first row.
    grouped = nodes.join(shuffled(roots), F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first_doc", F.coalesce("root", "fingerprint").alias("root")
    )
    names = grouped.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    named = grouped.join(shuffled(names), "root").select("fingerprint", "component_id", F.col("root").alias("group_id"))
    return own.join(shuffled(named), "fingerprint").select("doc_id", "fingerprint", "component_id", "group_id")


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """One row of `docs` for each group, that with the group's smallest doc_id, all columns kept.

    Rows are told by doc_id and fingerprint: texts of several groups under one doc_id are each
    judged in their own group. Of a group's rows with its smallest doc_id, one with the smallest
    fingerprint stays. Rows without a doc_id stay only if no row of their group has one, and then
    one of them does.
    """
    id_col, text_col = settings.get("id_col", "doc_id"), settings.get("text_col", "text")
    groups = stage(near_duplicates(docs, **settings), "near-duplicates")
    own_id = F.col(f"`{id_col}`").cast("long")
    firsts = (
        groups.where("component_id IS NULL OR doc_id = component_id")
        .groupBy(F.col("group_id").alias("_llm_group"))
        .agg(F.min("component_id").alias("_llm_id"), F.min("fingerprint").alias("_llm_print"))
    )
    rows = groups.where("doc_id IS NOT NULL").groupBy("doc_id").agg((F.count("*") == 1).alias("_llm_alone"))
    firsts = stage(firsts.join(shuffled(rows), F.col("_llm_id") == F.col("doc_id"), "left").drop("doc_id"), "firsts")
    alone = small_side(firsts.where("_llm_alone").select("_llm_id"))
    kept = docs.join(alone, own_id == F.col("_llm_id"), "left_semi")
    # only rows that their doc_id does not tell need their fingerprint again
    several = firsts.where("_llm_alone IS NULL OR NOT _llm_alone").drop("_llm_alone")
    if not several.isEmpty():
        shingle = settings.get("shingle", 3)

        @F.pandas_udf("long")
        def printed(texts: pd.Series) -> pd.Series:
            return pd.Series([_signed(fingerprint((t or "").encode(), shingle)) for t in texts])

        own = [F.col(f"`{c}`") for c in docs.columns]
        ids = small_side(several.where("_llm_id IS NOT NULL").select(F.col("_llm_id").alias("_llm_own")).distinct())
        told = docs.where(own_id.isNull()).union(docs.join(ids, own_id == F.col("_llm_own"), "left_semi"))
        told = told.select(*own, own_id.alias("_llm_own"), printed(F.col(f"`{text_col}`")).alias("_llm_own_print"))
        same = F.col("_llm_own").eqNullSafe(F.col("_llm_id")) & (F.col("_llm_own_print") == F.col("_llm_print"))
        kept = kept.union(told.join(shuffled(several), same).dropDuplicates(["_llm_group"]).select(*own))
    return kept
