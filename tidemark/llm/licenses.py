"""Licence scan: ordered signature rules, gated by keywords, overlaps resolved by priority."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable

from pyspark.sql import DataFrame

from tidemark.llm.common import as_bytes, map_batches, texts_of
from tidemark.llm.license_rules import Rule, rules

# Bytes outside words become spaces, and A-Z becomes a-z.
_PLAIN = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 32
    for c in range(256)
)

DETECTION = (
    "struct<rule:string,label:string,priority:int,weight:double,first_word:long,last_word:long,"
    "base:boolean,kept:boolean>"
)
SCHEMA = f"doc_id long, n_words long, detections array<{DETECTION}>"


class Scanner:
    """Rules by keyword; a rule's regex runs only over texts that have its keyword as a word."""

    def __init__(self, ordered: Iterable[Rule]) -> None:
        self.by_keyword: dict[bytes, list[tuple[Rule, re.Pattern[bytes]]]] = {}
        for rule in ordered:
            # A look-ahead, so that places that overlap each other are all found.
            regex = re.compile(rf"(?<![^ ])(?=({rule.pattern})(?![^ ]))".encode())
            self.by_keyword.setdefault(rule.keyword.encode(), []).append((rule, regex))
        self.keywords = frozenset(self.by_keyword)

    def scan(self, text: bytes) -> tuple[int, list[dict]]:
        words = text.translate(_PLAIN).split()
        present = self.keywords.intersection(words)
        if not present:
            return len(words), []
        plain = b" ".join(words)
        places = []
        for keyword in sorted(present):
            for rule, regex in self.by_keyword[keyword]:
                at, first = 0, 0
                for match in regex.finditer(plain):
                    first += plain.count(b" ", at, match.start(1))
                    at = match.start(1)
                    places.append((rule, first, first + match[1].count(b" ")))
        return len(words), self._resolve(places)

    @staticmethod
    def _resolve(places: list[tuple[Rule, int, int]]) -> list[dict]:
        """Highest priority first, then the longest; a place inside a kept one is suppressed."""
        ordered = sorted(places, key=lambda p: (-p[0].priority, p[1] - p[2], p[1], p[0].name))
        kept: list[tuple[int, int]] = []  # by start, no one inside another: ends rise too
        found = []
        for rule, first, last in ordered:
            at = bisect_right(kept, (first, float("inf")))
            inside = at > 0 and kept[at - 1][1] >= last
            if not inside:
                # those that it holds, if any, have a higher priority and stay as detections
                while at < len(kept) and kept[at][1] <= last:
                    del kept[at]
                if at > 0 and kept[at - 1][0] == first:
                    del kept[at - 1]
                    at -= 1
                kept.insert(at, (first, last))
            found.append(
                {
                    "rule": rule.name,
                    "label": rule.label,
                    "priority": rule.priority,
                    "weight": rule.weight,
                    "first_word": first,
                    "last_word": last,
                    "base": rule.base,
                    "kept": not inside,
                }
            )
        return sorted(found, key=lambda d: (d["first_word"], d["last_word"], d["rule"]))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ordered: Iterable[Rule] | None = None,
) -> DataFrame:
    """doc_id, n_words and every detection of every document, the suppressed ones marked.

    One pass without an exchange; a row in, a row out, repeated rows and null ids included. A null
    or empty text has no words and no detections. Whole texts are read, however long. Of two
    places of equal priority the longer wins, then the earlier, then the rule's name.
    """
    wanted = tuple(ordered if ordered is not None else rules())
    scanner: list[Scanner] = []  # made once in each task

    def work(batch: dict[str, list]) -> dict[str, list]:
        if not scanner:
            scanner.append(Scanner(wanted))
        found = [scanner[0].scan(text) for text in batch["text"]]
        return {
            "doc_id": batch["doc_id"],
            "n_words": [n for n, _ in found],
            "detections": [places for _, places in found],
        }

    return map_batches(as_bytes(texts_of(docs, id_col, text_col)), work, SCHEMA)
