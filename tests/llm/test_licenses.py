import re

from tidemark.llm.license_rules import BASE, rules
from tidemark.llm.licenses import Scanner, scan_licenses
from tidemark.llm.queries import QUERIES

PLACE = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = PLACE.findall(low)
    at, labels = [], set()
    for label, _, phrase in BASE:
        want = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(want)] == want:
                at.append(i)
                labels.add(label)
    return (
        len(words),
        len(at),
        min(at, default=None),
        max(at, default=None),
        ",".join(sorted(labels)),
    )


TEXTS = [
    None,
    "",
    "\n\t  ",
    "CC BY cc by-nc CC-BY 4.0",
    "MIT License\nMIT  license, GNU General\nPublic License v2 or later Apache License, Version 2.0",
    "mit licenses xcc by gnu general public-license é mit license2",
    "Éa cc\x85by ünd cc by",
    "word " * 30_000 + "Apache License",
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "labels string, doc_id long, text string, n_words string")


def test_base_places_match_brute_force(spark, tmp_path):
    rows = [("x", i, t, "y") for i, t in enumerate(TEXTS)] + [("x", None, "cc by", "y")] * 2
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op10_licenses"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for row in got:
        text = "cc by" if row.doc_id is None else TEXTS[row.doc_id]
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == brute(text)
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
        assert 0 <= row.score <= 1


def test_every_document_of_the_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op10_licenses"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])


def test_hundreds_of_rules_whose_keyword_is_in_every_match():
    found = rules()
    assert len(found) > 300 and len({r.name for r in found}) == len(found)
    for rule in found:
        re.compile(rule.pattern)
        assert rule.keyword in rule.pattern


def test_priority_then_containment(spark):
    _, places = Scanner(rules()).scan(b"Licensed under the Apache License, Version 2.0 (the License)")
    kept = [p for p in places if p["kept"]]
    assert [p["label"] for p in kept] == ["apache-2.0"]
    assert {p["label"] for p in places if not p["kept"]} >= {"apache", "licensed"}
    _, places = Scanner(rules()).scan(b"Permission is hereby granted, free of charge, to any person obtaining a copy of this software")
    assert [p["label"] for p in places if p["kept"]] == ["mit"]
    _, places = Scanner(rules()).scan(b"CC BY-NC-SA 4.0")
    assert [p["label"] for p in places if p["kept"]] == ["cc-by-nc-sa"]


def test_suppression_matches_brute_force():
    text = b"gnu gpl v2 gnu general public license version 2 or later lgpl 2 1 mit license bsd 2 clause license"
    _, places = Scanner(rules()).scan(text)
    weight = {r.name: r for r in rules()}
    order = sorted(places, key=lambda p: (-p["priority"], p["first_word"] - p["last_word"], p["first_word"], p["rule"]))
    kept = []
    for p in order:
        inside = any(q["first_word"] <= p["first_word"] and p["last_word"] <= q["last_word"] for q in kept)
        assert p["kept"] == (not inside), (p, weight[p["rule"]])
        if not inside:
            kept.append(p)


def test_empty_table(spark):
    assert scan_licenses(frame(spark, [])).collect() == []


def strings_of(parsed):
    """Every string that a parsed pattern matches; any one for what is not a space."""
    found = [""]
    for kind, arg in parsed:
        kind = str(kind)
        if kind == "LITERAL":
            each = [chr(arg)]
        elif kind == "IN" and str(arg[0][0]) == "CATEGORY":
            each = ["x"]
        elif kind == "IN":
            each = [chr(c) for k, a in arg for c in ([a] if str(k) == "LITERAL" else [a[0]])]
        elif kind == "SUBPATTERN":
            each = strings_of(arg[-1])
        elif kind == "BRANCH":
            each = [s for branch in arg[1] for s in strings_of(branch)]
        else:
            assert kind == "MAX_REPEAT", kind
            each = ([""] if arg[0] == 0 else []) + strings_of(arg[2])
        found = [a + b for a in found for b in each]
    return found


def test_each_rule_is_found_in_all_that_its_pattern_matches():
    for rule in rules():
        scanner = Scanner([rule])
        for phrase in strings_of(re._parser.parse(rule.pattern)):
            assert re.fullmatch(rule.pattern, phrase)
            _, places = scanner.scan(f"so {phrase} so".encode())
            assert any(p["first_word"] == 1 for p in places), (rule.name, phrase)


def test_versions_however_they_are_announced():
    names = {
        "GPL {}2 or later": "gpl-2.0",
        "LGPL {}2.1": "lgpl-2.1",
        "AGPL {}3": "agpl-3.0",
        "MPL {}2.0": "mpl-2.0",
        "EUPL {}1.2": "eupl",
        "CDDL {}1.0": "cddl",
        "Apache License {}2.0": "apache-2.0",
        "Apache {}2.0 license": "apache-2.0",
        "GNU General Public License, {}3": "gpl-3.0",
        "Mozilla Public License {}2.0": "mpl-2.0",
        "Mulan PSL {}2": "mulan-2.0",
        "CC BY {}4.0": "cc-by-4.0",
    }
    scanner = Scanner(rules())
    for name, label in names.items():
        for how in ("", "v", "v. ", "version ", "ver. ", "Version v"):
            _, places = scanner.scan(f"Under the {name.format(how)}, as is".encode())
            assert label in {p["label"] for p in places if p["kept"]}, (name, how)
    for text, label in (("FreeBSD license", "bsd-2-clause"), ("LGPLv2.1", "lgpl-2.1"), ("LGPLv3", "lgpl-3.0")):
        assert [p["label"] for p in scanner.scan(text.encode())[1] if p["kept"]] == [label]
