"""Signature rules for licences: one line per licence, with the patterns a person would look for.

A line is (label, priority, keyword, weight, patterns). Patterns run over words joined by one
space, lower-cased, without punctuation, and match whole words only; `keyword` is a word that
every text with a match has. Higher priorities win where places overlap.
"""

from __future__ import annotations

from dataclasses import dataclass

# How a version is announced, up to its number: "2", "v2", "v 2", "version 2", "ver 2", "version v2".
N = r"(?: version| ver)? (?:v ?)?"


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    priority: int
    keyword: str
    weight: float
    pattern: str
    base: bool = False


# Phrases whose label is a place of its own, found wherever they stand.
BASE = (
    ("gpl", "gnu", "gnu general public license"),
    ("apache", "apache", "apache license"),
    ("cc-by", "cc", "cc by"),
    ("mit", "mit", "mit license"),
)

SIGNATURES = (
    # identifiers, as in a source file's header
    ("mit", 90, "spdx", 1.0, (r"spdx license identifier mit",)),
    ("apache-2.0", 90, "spdx", 1.0, (r"spdx license identifier apache 2 0",)),
    ("gpl-2.0", 90, "spdx", 1.0, (r"spdx license identifier gpl 2 0(?: only| or later)?",)),
    ("gpl-3.0", 90, "spdx", 1.0, (r"spdx license identifier gpl 3 0(?: only| or later)?",)),
    ("lgpl-2.1", 90, "spdx", 1.0, (r"spdx license identifier lgpl 2 1(?: only| or later)?",)),
    ("lgpl-3.0", 90, "spdx", 1.0, (r"spdx license identifier lgpl 3 0(?: only| or later)?",)),
    ("agpl-3.0", 90, "spdx", 1.0, (r"spdx license identifier agpl 3 0(?: only| or later)?",)),
    ("bsd-2-clause", 90, "spdx", 1.0, (r"spdx license identifier bsd 2 clause",)),
    ("bsd-3-clause", 90, "spdx", 1.0, (r"spdx license identifier bsd 3 clause",)),
    ("mpl-2.0", 90, "spdx", 1.0, (r"spdx license identifier mpl 2 0",)),
    ("isc", 90, "spdx", 1.0, (r"spdx license identifier isc",)),
    ("unlicense", 90, "spdx", 1.0, (r"spdx license identifier unlicense",)),
    ("cc0-1.0", 90, "spdx", 1.0, (r"spdx license identifier cc0 1 0",)),
    ("zlib", 90, "spdx", 1.0, (r"spdx license identifier zlib",)),
    ("bsl-1.0", 90, "spdx", 1.0, (r"spdx license identifier bsl 1 0",)),
    ("epl-2.0", 90, "spdx", 1.0, (r"spdx license identifier epl 2 0",)),
    ("epl-1.0", 90, "spdx", 1.0, (r"spdx license identifier epl 1 0",)),
    ("cddl-1.0", 90, "spdx", 1.0, (r"spdx license identifier cddl 1 0",)),
    ("artistic-2.0", 90, "spdx", 1.0, (r"spdx license identifier artistic 2 0",)),
    ("wtfpl", 90, "spdx", 1.0, (r"spdx license identifier wtfpl",)),
    ("eupl-1.2", 90, "spdx", 1.0, (r"spdx license identifier eupl 1 2",)),
    ("0bsd", 90, "spdx", 1.0, (r"spdx license identifier 0bsd",)),
    ("spdx-other", 40, "spdx", 0.9, (r"spdx license identifier \S+",)),
    # permissive: full texts by their characteristic sentences
    ("mit", 70, "granted", 0.95, (
        r"permission is hereby granted free of charge to any person obtaining a copy of this software",)),
    ("mit", 70, "sublicense", 0.9, (
        r"to use copy modify merge publish distribute sublicense and or sell copies",)),
    ("mit", 60, "mit", 0.9, (
        r"licensed under (?:the )?(?:terms of )?(?:the )?mit(?: licen[cs]e)?",
        r"released under (?:the )?mit licen[cs]e",
        r"distributed under (?:the )?(?:terms of )?(?:the )?mit licen[cs]e",
        r"mit licensed", r"the mit licen[cs]e(?: mit)?", r"mit licen[cs]e",
        r"opensource org licenses mit(?: license)?(?: php)?",
        r"expat mit licen[cs]e", r"dual licensed mit",)),
    ("mit-0", 72, "mit", 0.9, (r"mit no attribution(?: license)?", r"mit 0 licen[cs]e")),
    ("expat", 60, "expat", 0.8, (r"expat licen[cs]e", r"licensed under expat")),
    ("x11", 60, "x11", 0.8, (r"x11 licen[cs]e", r"mit x11(?: licen[cs]e)?", r"x11 style licen[cs]e")),
    ("x11", 65, "consortium", 0.85, (r"except as contained in this notice the name of the x consortium",)),
    ("apache-2.0", 75, "apache", 0.95, (
        r"licensed under the apache license" + N + r"2 0",
        r"apache license" + N + r"2(?: 0)?",
        r"apache software license" + N + r"2(?: 0)?",
        r"apache licenses license 2 0(?: txt| html)?",
        r"www apache org licenses license 2 0",
        r"apache" + N + r"2(?: 0)? licen[cs]e(?:d)?", r"asl" + N + r"2 0 apache",)),
    ("apache-1.1", 75, "apache", 0.9, (
        r"apache (?:software )?license" + N + r"1 1",
        r"this product includes software developed by the apache software foundation",)),
    ("apache-1.0", 75, "apache", 0.9, (r"apache (?:software )?license" + N + r"1 0",)),
    ("apache", 50, "apache", 0.8, (
        r"(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?apache licen[cs]e",
        r"apache (?:software )?licen[cs]e", r"apache licensed",)),
    ("bsd-2-clause", 72, "bsd", 0.9, (
        r"bsd 2 clause(?: licen[cs]e)?", r"2 clause bsd(?: licen[cs]e)?",
        r"two clause bsd(?: licen[cs]e)?", r"simplified bsd licen[cs]e",
        r"bsd two clause licen[cs]e",)),
    ("bsd-2-clause", 72, "freebsd", 0.9, (r"freebsd licen[cs]e",)),
    ("bsd-3-clause", 72, "bsd", 0.9, (
        r"bsd 3 clause(?: licen[cs]e)?", r"3 clause bsd(?: licen[cs]e)?",
        r"three clause bsd(?: licen[cs]e)?", r"(?:new|modified|revised) bsd licen[cs]e",
        r"bsd three clause licen[cs]e",)),
    ("bsd-4-clause", 72, "bsd", 0.9, (
        r"bsd 4 clause(?: licen[cs]e)?", r"4 clause bsd(?: licen[cs]e)?",
        r"(?:original|old) bsd licen[cs]e",)),
    ("bsd-4-clause", 74, "advertising", 0.9, (
        r"all advertising materials mentioning features or use of this software",)),
    ("bsd-3-clause", 73, "endorse", 0.9, (
        r"may be used to endorse or promote products derived from this software without specific prior written permission",)),
    ("bsd", 65, "redistribution", 0.85, (
        r"redistribution and use in source and binary forms with or without modification are permitted",)),
    ("bsd", 64, "redistributions", 0.8, (
        r"redistributions of source code must retain the above copyright notice",
        r"redistributions in binary form must reproduce the above copyright notice",)),
    ("bsd", 50, "bsd", 0.75, (
        r"(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the |a )?bsd(?: style)? licen[cs]e",
        r"bsd style licen[cs]e", r"bsd licensed", r"(?:the )?bsd licen[cs]e",)),
    ("0bsd", 73, "0bsd", 0.9, (r"0bsd(?: licen[cs]e)?",)),
    ("0bsd", 73, "clause", 0.9, (r"zero clause bsd(?: licen[cs]e)?", r"bsd zero clause(?: licen[cs]e)?")),
    ("isc", 72, "isc", 0.9, (r"isc licen[cs]e(?: isc)?", r"licensed under (?:the )?isc", r"isc licensed")),
    ("isc", 71, "fee", 0.9, (
        r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        r"permission to use copy modify and distribute this software for any purpose with or without fee",)),
    ("zlib", 72, "zlib", 0.9, (r"zlib licen[cs]e", r"zlib libpng licen[cs]e", r"licensed under (?:the )?zlib")),
    ("zlib", 71, "misrepresented", 0.9, (r"the origin of this software must not be misrepresented",)),
    ("libpng", 72, "libpng", 0.85, (r"libpng licen[cs]e", r"libpng" + N + r"2 licen[cs]e")),
    ("bsl-1.0", 72, "boost", 0.95, (
        r"boost software licen[cs]e(?:" + N + r"1 0)?", r"distributed under the boost software licen[cs]e",
        r"www boost org license 1 0(?: txt)?", r"boost licen[cs]e",)),
    ("ncsa", 72, "ncsa", 0.9, (
        r"university of illinois ncsa open source licen[cs]e", r"ncsa open source licen[cs]e", r"ncsa licen[cs]e")),
    ("python-2.0", 72, "python", 0.9, (
        r"python software foundation licen[cs]e(?:" + N + r"2)?", r"psf licen[cs]e agreement for python",
        r"python licen[cs]e" + N + r"2 0",)),
    ("psf", 60, "psf", 0.8, (r"psf licen[cs]e", r"psf licensed", r"licensed under (?:the )?psf")),
    ("php-3.01", 72, "php", 0.9, (r"php license" + N + r"3 01", r"www php net license 3 01(?: txt)?")),
    ("php-3.0", 71, "php", 0.9, (r"php license" + N + r"3 0",)),
    ("ruby", 60, "ruby", 0.8, (r"ruby licen[cs]e", r"same terms as ruby")),
    ("perl", 60, "perl", 0.85, (r"same terms as perl(?: itself)?", r"under the terms of perl")),
    ("openssl", 72, "openssl", 0.9, (
        r"openssl licen[cs]e", r"developed by the openssl project for use in the openssl toolkit")),
    ("ssleay", 72, "ssleay", 0.85, (r"original ssleay licen[cs]e", r"ssleay licen[cs]e")),
    ("curl", 72, "curl", 0.85, (r"curl licen[cs]e",)),
    ("icu", 72, "icu", 0.85, (r"icu licen[cs]e",)),
    ("unicode", 72, "unicode", 0.85, (
        r"unicode licen[cs]e agreement(?: data files and software)?", r"unicode licen[cs]e" + N + r"3")),
    ("ftl", 72, "freetype", 0.9, (r"freetype project licen[cs]e", r"freetype licen[cs]e")),
    ("ijg", 72, "jpeg", 0.85, (r"independent jpeg group licen[cs]e",)),
    ("postgresql", 72, "postgresql", 0.9, (r"postgresql licen[cs]e",)),
    ("ms-pl", 72, "microsoft", 0.9, (r"microsoft public licen[cs]e(?: ms pl)?",)),
    ("ms-rl", 72, "microsoft", 0.9, (r"microsoft reciprocal licen[cs]e(?: ms rl)?",)),
    ("w3c", 72, "w3c", 0.9, (
        r"w3c software notice and licen[cs]e", r"w3c software licen[cs]e", r"w3c document licen[cs]e")),
    ("afl-3.0", 74, "academic", 0.9, (r"academic free licen[cs]e" + N + r"3(?: 0)?",)),
    ("afl-2.1", 74, "academic", 0.9, (r"academic free licen[cs]e" + N + r"2 1",)),
    ("afl", 60, "academic", 0.85, (r"academic free licen[cs]e",)),
    ("artistic-2.0", 74, "artistic", 0.9, (r"artistic licen[cs]e" + N + r"2(?: 0)?",)),
    ("artistic-1.0", 74, "artistic", 0.9, (r"artistic licen[cs]e" + N + r"1(?: 0)?",)),
    ("artistic", 60, "artistic", 0.85, (r"(?:the )?artistic licen[cs]e",)),
    ("beerware", 72, "beer", 0.85, (r"beer ware licen[cs]e(?: revision 42)?",)),
    ("beerware", 72, "beerware", 0.85, (r"beerware licen[cs]e",)),
    ("wtfpl", 72, "wtfpl", 0.9, (r"wtfpl(?: licen[cs]e|" + N + r"2)?",)),
    ("wtfpl", 72, "fuck", 0.9, (r"do what the fuck you want to public licen[cs]e",)),
    ("unlicense", 72, "unlicense", 0.9, (r"(?:the )?unlicense(?: license)?", r"unlicense org")),
    ("unlicense", 71, "unencumbered", 0.95, (
        r"this is free and unencumbered software released into the public domain",)),
    ("public-domain", 55, "domain", 0.6, (
        r"(?:released|placed|dedicated) (?:in|into|to) the public domain",
        r"this work is in the public domain", r"public domain dedication", r"in the public domain",)),
    ("upl-1.0", 72, "universal", 0.9, (r"universal permissive licen[cs]e(?:" + N + r"1 0)?",)),
    ("vim", 72, "vim", 0.85, (r"vim licen[cs]e",)),
    ("xfree86", 72, "xfree86", 0.85, (r"xfree86 licen[cs]e(?:" + N + r"1 1)?",)),
    ("zpl-2.1", 74, "zope", 0.9, (r"zope public licen[cs]e" + N + r"2 1",)),
    ("zpl", 60, "zope", 0.85, (r"zope public licen[cs]e",)),
    ("mulan-2.0", 72, "mulan", 0.9, (r"mulan p(?:ermissive software licen[cs]e|sl)" + r"(?: version| ver)? ?(?:v ?)?2",)),
    # strong and weak copyleft
    ("gpl-1.0", 76, "gnu", 0.9, (r"gnu general public licen[cs]e" + N + r"1(?: 0)?",)),
    ("gpl-2.0", 76, "gnu", 0.95, (
        r"gnu general public licen[cs]e" + N + r"2(?: 0)?", r"gnu gpl" + N + r"2(?: 0)?",
        r"gnu general public licen[cs]e as published by the free software foundation either" + N + r"2",
        r"www gnu org licenses (?:old licenses )?gpl 2 0(?: html| txt)?",)),
    ("gpl-3.0", 76, "gnu", 0.95, (
        r"gnu general public licen[cs]e" + N + r"3(?: 0)?", r"gnu gpl" + N + r"3(?: 0)?",
        r"gnu general public licen[cs]e as published by the free software foundation either" + N + r"3",
        r"www gnu org licenses gpl 3 0(?: html| txt)?",)),
    ("gpl-2.0", 74, "gplv2", 0.9, (r"gplv2(?: licen[cs]e)?", r"licensed under (?:the )?gplv2")),
    ("gpl-3.0", 74, "gplv3", 0.9, (r"gplv3(?: licen[cs]e)?", r"licensed under (?:the )?gplv3")),
    ("gpl-2.0", 74, "gpl", 0.85, (r"gpl" + N + r"2(?: 0)?(?: only| or later)?",)),
    ("gpl-3.0", 74, "gpl", 0.85, (r"gpl" + N + r"3(?: 0)?(?: only| or later)?",)),
    ("gpl", 50, "gnu", 0.8, (
        r"(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?gnu general public licen[cs]e",
        r"gnu general public licen[cs]e", r"gnu gpl", r"gnu public licen[cs]e",)),
    ("gpl", 45, "gpl", 0.7, (
        r"(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?gpl",
        r"gpl licen[cs]e", r"gpl licensed",)),
    ("gpl-classpath", 80, "classpath", 0.9, (r"classpath exception", r"gpl with classpath exception")),
    ("gpl-font", 80, "font", 0.85, (r"gpl with font exception", r"font exception to the gpl")),
    ("lgpl-2.0", 78, "library", 0.9, (r"gnu library general public licen[cs]e(?:" + N + r"2(?: 0)?)?",)),
    ("lgpl-2.1", 78, "lesser", 0.95, (
        r"gnu lesser general public licen[cs]e" + N + r"2 1",
        r"gnu lesser general public licen[cs]e as published by the free software foundation either" + N + r"2 1",)),
    ("lgpl-3.0", 78, "lesser", 0.95, (
        r"gnu lesser general public licen[cs]e" + N + r"3(?: 0)?",
        r"gnu lesser general public licen[cs]e as published by the free software foundation either" + N + r"3",)),
    ("lgpl", 70, "lesser", 0.85, (r"gnu lesser general public licen[cs]e", r"lesser general public licen[cs]e", r"lesser gpl")),
    ("lgpl-2.1", 74, "lgpl", 0.85, (r"lgpl" + N + r"2 1(?: only| or later)?",)),
    ("lgpl-2.1", 74, "lgplv2", 0.85, (r"lgplv2 1(?: only| or later)?",)),
    ("lgpl-3.0", 74, "lgplv3", 0.85, (r"lgplv3",)),
    ("lgpl-3.0", 74, "lgpl", 0.85, (r"lgpl" + N + r"3(?: 0)?(?: only| or later)?",)),
    ("lgpl", 45, "lgpl", 0.75, (r"lgpl licen[cs]e(?:d)?", r"(?:licensed|released) under (?:the )?lgpl", r"gnu lgpl")),
    ("agpl-3.0", 78, "affero", 0.95, (
        r"gnu affero general public licen[cs]e" + N + r"3(?: 0)?",
        r"affero general public licen[cs]e as published by the free software foundation either" + N + r"3",)),
    ("agpl-1.0", 78, "affero", 0.9, (r"affero general public licen[cs]e" + N + r"1(?: 0)?",)),
    ("agpl", 70, "affero", 0.85, (r"gnu affero general public licen[cs]e", r"affero general public licen[cs]e", r"affero gpl")),
    ("agpl-3.0", 74, "agpl", 0.85, (r"agpl" + N + r"3(?: 0)?(?: only| or later)?",)),
    ("agpl-3.0", 74, "agplv3", 0.85, (r"agplv3",)),
    ("agpl", 45, "agpl", 0.75, (r"agpl licen[cs]e(?:d)?", r"(?:licensed|released) under (?:the )?agpl")),
    ("gfdl-1.3", 78, "documentation", 0.9, (r"gnu free documentation licen[cs]e" + N + r"1 3",)),
    ("gfdl-1.2", 78, "documentation", 0.9, (r"gnu free documentation licen[cs]e" + N + r"1 2",)),
    ("gfdl-1.1", 78, "documentation", 0.9, (r"gnu free documentation licen[cs]e" + N + r"1 1",)),
    ("gfdl", 70, "documentation", 0.85, (r"gnu free documentation licen[cs]e",)),
    ("gfdl", 60, "gfdl", 0.8, (r"gfdl(?: licen[cs]e)?",)),
    ("mpl-2.0", 76, "mozilla", 0.95, (
        r"mozilla public licen[cs]e" + N + r"2 0",
        r"subject to the terms of the mozilla public licen[cs]e" + N + r"2 0",
        r"(?:www )?mozilla org mpl 2 0",)),
    ("mpl-1.1", 76, "mozilla", 0.9, (r"mozilla public licen[cs]e" + N + r"1 1", r"www mozilla org mpl mpl 1 1")),
    ("mpl-1.0", 76, "mozilla", 0.9, (r"mozilla public licen[cs]e" + N + r"1 0",)),
    ("mpl", 60, "mozilla", 0.85, (r"mozilla public licen[cs]e", r"mozilla licen[cs]e")),
    ("mpl-2.0", 70, "mpl", 0.85, (r"mpl" + N + r"2 0",)),
    ("mpl-1.1", 70, "mpl", 0.85, (r"mpl" + N + r"1 1", r"mpl" + N + r"1 1 gpl" + N + r"2 0 lgpl" + N + r"2 1")),
    ("epl-2.0", 76, "eclipse", 0.95, (r"eclipse public licen[cs]e" + N + r"2 0", r"eclipse org legal epl 2 0")),
    ("epl-1.0", 76, "eclipse", 0.95, (r"eclipse public licen[cs]e" + N + r"1 0", r"eclipse org legal epl v10(?: html)?")),
    ("edl-1.0", 76, "eclipse", 0.9, (r"eclipse distribution licen[cs]e(?:" + N + r"1 0)?",)),
    ("epl", 60, "eclipse", 0.85, (r"eclipse public licen[cs]e",)),
    ("cddl-1.1", 76, "distribution", 0.9, (r"common development and distribution licen[cs]e" + N + r"1 1",)),
    ("cddl-1.0", 76, "distribution", 0.9, (r"common development and distribution licen[cs]e" + N + r"1 0",)),
    ("cddl", 60, "distribution", 0.85, (r"common development and distribution licen[cs]e(?: cddl)?",)),
    ("cddl", 50, "cddl", 0.75, (r"cddl licen[cs]e(?:d)?", r"cddl" + N + r"1 [01]")),
    ("cpl-1.0", 72, "common", 0.9, (r"common public licen[cs]e(?:" + N + r"1 0)?",)),
    ("cpal-1.0", 72, "attribution", 0.9, (r"common public attribution licen[cs]e(?:" + N + r"1 0)?",)),
    ("ipl-1.0", 72, "ibm", 0.9, (r"ibm public licen[cs]e(?:" + N + r"1 0)?",)),
    ("eupl-1.2", 76, "european", 0.95, (r"european union public licen[cs]e" + N + r"1 2",)),
    ("eupl-1.1", 76, "european", 0.95, (r"european union public licen[cs]e" + N + r"1 1",)),
    ("eupl", 60, "european", 0.85, (r"european union public licen[cs]e",)),
    ("eupl", 50, "eupl", 0.75, (r"eupl" + N + r"1 [012]", r"eupl licen[cs]e")),
    ("osl-3.0", 76, "open", 0.9, (r"open software licen[cs]e" + N + r"3(?: 0)?",)),
    ("osl-2.1", 76, "open", 0.9, (r"open software licen[cs]e" + N + r"2 1",)),
    ("ofl-1.1", 76, "sil", 0.95, (r"sil open font licen[cs]e(?:" + N + r"1 1)?", r"sil ofl(?:" + N + r"1 1)?")),
    ("ofl-1.1", 70, "scripts", 0.9, (r"scripts sil org ofl",)),
    ("cecill-2.1", 76, "cecill", 0.9, (r"cecill" + N + r"2 1",)),
    ("cecill-b", 76, "cecill", 0.9, (r"cecill b(?: licen[cs]e)?",)),
    ("cecill-c", 76, "cecill", 0.9, (r"cecill c(?: licen[cs]e)?",)),
    ("cecill", 60, "cecill", 0.8, (r"cecill(?: free software)? licen[cs]e",)),
    ("qpl-1.0", 72, "public", 0.9, (r"q public licen[cs]e(?:" + N + r"1 0)?",)),
    ("sleepycat", 72, "sleepycat", 0.9, (r"sleepycat licen[cs]e",)),
    ("apsl-2.0", 76, "apple", 0.9, (r"apple public source licen[cs]e(?:" + N + r"2 0)?",)),
    ("npl-1.1", 72, "netscape", 0.9, (r"netscape public licen[cs]e(?:" + N + r"1 [01])?",)),
    ("spl-1.0", 72, "sun", 0.9, (r"sun public licen[cs]e(?:" + N + r"1 0)?",)),
    ("sissl", 72, "sun", 0.9, (r"sun industry standards source licen[cs]e",)),
    ("nasa-1.3", 72, "nasa", 0.9, (r"nasa open source agreement(?:" + N + r"1 3)?",)),
    ("rpl-1.5", 72, "reciprocal", 0.9, (r"reciprocal public licen[cs]e(?:" + N + r"1 5)?",)),
    ("sspl-1.0", 72, "server", 0.95, (r"server side public licen[cs]e(?:" + N + r"1)?",)),
    ("sspl-1.0", 60, "sspl", 0.85, (r"sspl(?: licen[cs]e)?",)),
    ("busl-1.1", 72, "business", 0.95, (r"business source licen[cs]e(?:" + N + r"1 1)?",)),
    ("elastic-2.0", 72, "elastic", 0.95, (r"elastic licen[cs]e(?:" + N + r"2(?: 0)?)?",)),
    ("commons-clause", 72, "commons", 0.9, (r"commons clause licen[cs]e condition", r"commons clause")),
    ("polyform", 72, "polyform", 0.9, (
        r"polyform (?:noncommercial|small business|shield|perimeter|strict|internal use|free trial) licen[cs]e(?:" + N + r"1 0 0)?",)),
    ("hippocratic", 72, "hippocratic", 0.9, (r"hippocratic licen[cs]e",)),
    # content
    ("cc0-1.0", 78, "cc0", 0.95, (r"cc0" + N + r"1 0(?: universal)?(?: public domain dedication)?", r"cc0(?: licen[cs]e| waiver)?")),
    ("cc-by-nc-nd", 80, "cc", 0.95, (r"cc by nc nd(?:" + N + r"[1234] [05])?",)),
    ("cc-by-nc-sa", 80, "cc", 0.95, (r"cc by nc sa(?:" + N + r"[1234] [05])?",)),
    ("cc-by-nc", 78, "cc", 0.95, (r"cc by nc(?:" + N + r"[1234] [05])?",)),
    ("cc-by-nd", 78, "cc", 0.95, (r"cc by nd(?:" + N + r"[1234] [05])?",)),
    ("cc-by-sa", 78, "cc", 0.95, (r"cc by sa(?:" + N + r"[1234] [05])?",)),
    ("cc-by-4.0", 77, "cc", 0.95, (r"cc by" + N + r"4 0",)),
    ("cc-by-3.0", 77, "cc", 0.95, (r"cc by" + N + r"3 0",)),
    ("cc-by-2.5", 77, "cc", 0.95, (r"cc by" + N + r"2 5",)),
    ("cc-by-2.0", 77, "cc", 0.95, (r"cc by" + N + r"2 0",)),
    ("cc-by", 60, "cc", 0.8, (r"cc by",)),
    ("cc-by-nc-nd", 80, "noncommercial", 0.95, (r"(?:creative commons )?attribution noncommercial noderiv(?:s|atives)(?:" + N + r"[1234] [05])?",)),
    ("cc-by-nc-sa", 80, "noncommercial", 0.95, (r"(?:creative commons )?attribution noncommercial sharealike(?:" + N + r"[1234] [05])?",)),
    ("cc-by-nc", 78, "noncommercial", 0.95, (r"(?:creative commons )?attribution noncommercial(?:" + N + r"[1234] [05])?",)),
    ("cc-by-sa", 78, "sharealike", 0.95, (r"(?:creative commons )?attribution sharealike(?:" + N + r"[1234] [05])?",)),
    ("cc-by-nd", 78, "creative", 0.95, (r"creative commons attribution noderiv(?:s|atives)(?:" + N + r"[1234] [05])?",)),
    ("cc-by", 74, "creative", 0.9, (
        r"creative commons attribution(?:" + N + r"[1234] [05])?(?: international| unported)? licen[cs]e",
        r"creative commons attribution",)),
    ("cc-by", 74, "creativecommons", 0.9, (r"creativecommons org licenses by(?: [1234] [05])?",)),
    ("cc-by-sa", 78, "creativecommons", 0.9, (r"creativecommons org licenses by sa(?: [1234] [05])?",)),
    ("cc-by-nc", 78, "creativecommons", 0.9, (r"creativecommons org licenses by nc(?: [1234] [05])?",)),
    ("cc-by-nc-sa", 80, "creativecommons", 0.9, (r"creativecommons org licenses by nc sa(?: [1234] [05])?",)),
    ("cc-by-nc-nd", 80, "creativecommons", 0.9, (r"creativecommons org licenses by nc nd(?: [1234] [05])?",)),
    ("cc0-1.0", 78, "creativecommons", 0.9, (r"creativecommons org publicdomain zero 1 0",)),
    ("pdm-1.0", 76, "mark", 0.85, (r"public domain mark(?:" + N + r"1 0)?",)),
    ("cc", 40, "creative", 0.6, (r"creative commons(?: licen[cs]e)?",)),
    ("odbl-1.0", 76, "odbl", 0.9, (r"odbl(?:" + N + r"1 0)?(?: licen[cs]e)?",)),
    ("odbl-1.0", 76, "database", 0.95, (r"open (?:data commons open )?database licen[cs]e(?: odbl)?",)),
    ("odc-by-1.0", 76, "commons", 0.95, (r"open data commons attribution licen[cs]e",)),
    ("pddl-1.0", 76, "pddl", 0.9, (r"pddl(?: licen[cs]e)?",)),
    ("ogl-3.0", 72, "government", 0.9, (r"open government licen[cs]e(?:" + N + r"3 0)?",)),
    ("fal-1.3", 72, "art", 0.85, (r"free art licen[cs]e(?:" + N + r"1 3)?",)),
    ("openrail", 72, "openrail", 0.9, (r"(?:creativeml )?openrail(?: m)?(?: licen[cs]e)?", r"bigscience openrail m")),
    ("llama", 72, "llama", 0.9, (r"llama [23](?: [123])? community licen[cs]e(?: agreement)?",)),
    # not free, or a claim without a licence
    ("proprietary", 45, "proprietary", 0.7, (
        r"proprietary and confidential", r"confidential and proprietary", r"proprietary licen[cs]e",
        r"proprietary software",)),
    ("proprietary", 45, "unauthorized", 0.7, (r"unauthorized copying of this file",)),
    ("eula", 50, "eula", 0.75, (r"end user licen[cs]e agreement eula", r"eula licen[cs]e")),
    ("eula", 51, "user", 0.75, (r"end user licen[cs]e agreement",)),
    ("shareware", 45, "shareware", 0.6, (r"shareware licen[cs]e", r"this program is shareware")),
    ("freeware", 45, "freeware", 0.6, (r"freeware licen[cs]e", r"this program is freeware")),
    ("all-rights-reserved", 30, "reserved", 0.5, (r"all rights reserved", r"some rights reserved", r"rights reserved worldwide")),
    ("copyright", 20, "copyright", 0.3, (
        r"copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?", r"copyright c", r"copyright holders?", r"copyright notice")),
    ("licensed", 10, "licensed", 0.3, (r"licensed under (?:the )?(?:terms of )?(?:the )?\S+", r"licensed to you")),
    ("licensed", 10, "license", 0.3, (r"see (?:the )?license(?: file)?(?: for details)?", r"license agreement", r"subject to the license")),
)


def rules() -> tuple[Rule, ...]:
    """The base phrases, then every signature pattern in the order written."""
    found = [
        Rule(f"base-{label}", label, 60, keyword, 0.8, phrase, base=True)
        for label, keyword, phrase in BASE
    ]
    for label, priority, keyword, weight, patterns in SIGNATURES:
        for pattern in patterns:
            found.append(Rule(f"{label}-{len(found)}", label, priority, keyword, weight, pattern))
    return tuple(found)
