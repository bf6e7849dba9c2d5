"""License scans: ordered signature rules, in DataFrame functions only.

Texts become words: A-Z in lower case, runs of other ASCII characters than
letters and digits are gaps, all other characters belong to words. A rule is a
regular expression over words joined by single spaces; it begins with its
keyword, of one to four words, and has a priority (0 first). One prefilter looks
for any keyword, and only texts that pass are cut into words; a rule then runs
only on the windows of ``WINDOW`` words that begin with its own keyword. A
detection is suppressed
if a detection of better priority contains its interval, or one of the same
priority contains it and is longer. A detection is no longer than a window, so
only those of the ``WINDOW`` keywords before it can contain it, and a text's
work grows with its length.

Base phrases are searched beside the rules and never suppressed.

A null or empty text, or one without words, has no places, empty labels and
score 0. Repeated rows and null ids each give a row; an empty table gives an
empty result. Other columns are left out unless named in ``keep``. Texts are
scanned whole at any length.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import text_or_empty

WINDOW, KEYWORD_WORDS = 24, 4
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Score of a base phrase, and of rules by priority.
BASE_SCORE, SCORES = 1.0, (0.95, 0.8, 0.6)


class Rule(NamedTuple):
    keyword: str
    pattern: str
    label: str
    priority: int


def _versioned(name: str, label: str, versions: str, licence: str = "(?: software| public)?(?: licen[sc]e)?") -> list[Rule]:
    """A rule for each version of a named license, and one for the name alone."""
    keyword = name.split()[0]
    out = []
    for version in versions.split():
        major, _, minor = version.partition(".")
        number = f"{major}(?: {minor})?" if minor == "0" else f"{major} {minor}" if minor else major
        out.append(Rule(keyword, f"{name}{licence},? ?(?:version |v ?)?{number}(?: or (?:any )?later(?: version)?)?".replace(",? ?", " "), f"{label}-{version}", 0))
        if " " not in name and not minor.strip("0"):
            out.append(Rule(f"{keyword}v{major}", f"{keyword}v{major}(?: 0)?(?: or (?:any )?later(?: version)?)?", f"{label}-{version}", 0))
            out.append(Rule(f"{keyword}{major}", f"{keyword}{major}(?: 0)?", f"{label}-{version}", 0))
    return out


def _keyword(pattern: str) -> str:
    """The plain words that a pattern begins with, at most ``KEYWORD_WORDS``."""
    words = pattern.split(" ")
    plain = next((k for k, w in enumerate(words) if not re.fullmatch("[a-z0-9]+", w)), len(words))
    return " ".join(words[: min(plain, KEYWORD_WORDS)]) or re.match("[a-z0-9]+(?=\\(\\?: )", pattern)[0]


def rules() -> list[Rule]:
    """The signature table: ``TEXTS``, and names of license families with their versions."""
    out: list[Rule] = []
    for name, label, versions in (
        ("gnu general public", "gpl", "1.0 2.0 3.0"), ("gnu lesser general public", "lgpl", "2.0 2.1 3.0"), ("gnu library general public", "lgpl", "2.0 2.1"),
        ("gnu affero general public", "agpl", "1.0 3.0"), ("gnu free documentation", "gfdl", "1.1 1.2 1.3"), ("gnu gpl", "gpl", "1.0 2.0 3.0"), ("gnu lgpl", "lgpl", "2.0 2.1 3.0"), ("gnu agpl", "agpl", "3.0"),
        ("gpl", "gpl", "1.0 2.0 3.0"), ("lgpl", "lgpl", "2.0 2.1 3.0"), ("agpl", "agpl", "1.0 3.0"), ("gfdl", "gfdl", "1.1 1.2 1.3"),
        ("apache", "apache", "1.0 1.1 2.0"), ("mozilla public", "mpl", "1.0 1.1 2.0"), ("mpl", "mpl", "1.0 1.1 2.0"), ("eclipse public", "epl", "1.0 2.0"), ("epl", "epl", "1.0 2.0"),
        ("cddl", "cddl", "1.0 1.1"), ("common development and distribution", "cddl", "1.0 1.1"), ("european union public", "eupl", "1.0 1.1 1.2"), ("eupl", "eupl", "1.0 1.1 1.2"),
        ("artistic", "artistic", "1.0 2.0"), ("boost", "bsl", "1.0"), ("academic free", "afl", "1.1 1.2 2.0 2.1 3.0"), ("afl", "afl", "1.1 1.2 2.0 2.1 3.0"), ("open software", "osl", "1.0 1.1 2.0 2.1 3.0"), ("osl", "osl", "1.0 1.1 2.0 2.1 3.0"),
        ("sil open font", "ofl", "1.0 1.1"), ("ofl", "ofl", "1.0 1.1"), ("cecill", "cecill", "1.0 1.1 2.0 2.1"), ("educational community", "ecl", "1.0 2.0"), ("php", "php", "3.0 3.01"), ("python", "python", "2.0"), ("zope public", "zpl", "1.1 2.0 2.1"), ("zpl", "zpl", "1.1 2.0 2.1"),
        ("lppl", "lppl", "1.0 1.1 1.2 1.3"), ("common public", "cpl", "1.0"), ("ibm public", "ipl", "1.0"), ("netscape public", "npl", "1.0 1.1"), ("npl", "npl", "1.0 1.1"), ("sun public", "spl", "1.0"), ("universal permissive", "upl", "1.0"),
        ("open database", "odbl", "1.0"), ("odbl", "odbl", "1.0"), ("mulan permissive", "mulan-psl", "1.0 2.0"), ("business source", "busl", "1.1"), ("server side public", "sspl", "1.0"), ("sspl", "sspl", "1.0"), ("elastic", "elastic", "1.0 2.0"), ("llama community", "llama", "2.0 3.0 3.1"),
    ):
        out += _versioned(name, label, versions)
        if " " in name or label in ("gpl", "lgpl", "agpl", "gfdl"):
            out.append(Rule(name.split()[0], name if label == name else f"{name} licen[sc]e" if not name.startswith("gnu ") or "public" in name or "documentation" in name else name, label, 1))
        else:
            out.append(Rule(name, f"{name}(?: software| public)? licen[sc]ed?", label, 1))
    for parts, label in ((p, "-".join(p)) for p in (("by",), ("by", "sa"), ("by", "nd"), ("by", "nc"), ("by", "nc", "sa"), ("by", "nc", "nd"))):
        words = {"by": "attribution", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s?", "nc": "non ?commercial"}
        short, long = "cc " + " ".join(parts), "creative commons " + " ".join(words[p] for p in parts)
        out += [Rule("cc", short, f"cc-{label}", 1), Rule("creative", long, f"cc-{label}", 1)]
        for text, version in product((short, long), "1.0 2.0 2.5 3.0 4.0".split()):
            major, minor = version.split(".")
            out.append(Rule(text.split()[0], f"{text} (?:licen[sc]e )?(?:version |v)?{major} {minor}(?: international| unported| generic)?(?: licen[sc]e)?", f"cc-{label}-{version}", 0))
    out += [Rule("cc0", "cc0(?: 1 0)?(?: universal)?", "cc0-1.0", 0), Rule("creative", "creative commons (?:zero|cc0)(?: 1 0)?", "cc0-1.0", 0), Rule("creative", "creative commons licen[sc]e", "cc", 2)]
    out += [Rule("bsd", f"bsd {n} clause(?: licen[sc]e)?", f"bsd-{n}-clause", 0) for n in range(5)]
    out += [Rule(w, f"{w} clause bsd(?: licen[sc]e)?", f"bsd-{n}-clause", 0) for n, w in enumerate("zero one two three four".split())]
    for keyword, text, label, priority in (
        ("mit", "mit(?: x11)? licen[sc]ed?", "mit", 1), ("mit", "mit no attribution licen[sc]e", "mit-0", 0), ("expat", "expat licen[sc]e", "mit", 1), ("x11", "x11 licen[sc]e", "x11", 1), ("isc", "isc licen[sc]ed?", "isc", 1),
        ("bsd", "bsd(?: style)? licen[sc]ed?", "bsd", 1), ("0bsd", "0bsd", "0bsd", 0), ("zlib", "zlib(?: libpng)? licen[sc]e", "zlib", 1), ("libpng", "libpng licen[sc]e", "libpng", 1), ("unlicense", "unlicense", "unlicense", 1), ("unlicence", "unlicence", "unlicense", 1),
        ("wtfpl", "wtfpl(?: version 2)?", "wtfpl", 1), ("ncsa", "ncsa(?: open source)? licen[sc]e", "ncsa", 1), ("postgresql", "postgresql licen[sc]e", "postgresql", 1), ("openssl", "openssl licen[sc]e", "openssl", 1), ("vim", "vim licen[sc]e", "vim", 1),
        ("ms", "ms pl", "ms-pl", 1), ("ms", "ms rl", "ms-rl", 1), ("microsoft", "microsoft public licen[sc]e", "ms-pl", 1), ("microsoft", "microsoft reciprocal licen[sc]e", "ms-rl", 1), ("sleepycat", "sleepycat licen[sc]e", "sleepycat", 1),
        ("beerware", "beerware(?: licen[sc]e)?", "beerware", 1), ("psf", "psf licen[sc]e(?: version 2)?", "psf-2.0", 1), ("ruby", "ruby licen[sc]e", "ruby", 1), ("json", "json licen[sc]e", "json", 1), ("unicode", "unicode licen[sc]e", "unicode", 1), ("w3c", "w3c(?: software)? licen[sc]e", "w3c", 1),
    ):
        out.append(Rule(keyword, text, label, priority))
    out += [Rule(_keyword(pattern), pattern, label, priority) for pattern, label, priority in TEXTS]
    return list(dict.fromkeys(out))


#: Hand-written signatures: words that only a license's text, header, notice, identifier or address has. Words, not punctuation: dots and slashes are gaps.
TEXTS: tuple[tuple[str, str, int], ...] = (
    # texts, by sentences of their own
    (r"permission is hereby granted free of charge to any person obtaining a copy", "mit", 0),
    (r"the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies", "mit", 0),
    (r"the software is provided as is without warranty of any kind express or implied", "mit", 1),
    (r"except as contained in this notice the name of the x consortium shall not be used", "x11", 0),
    (r"except as contained in this notice the names? of (?:the )?(?:above )?copyright holders? shall not be used", "x11", 1),
    (r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that", "isc", 0),
    (r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", "0bsd", 0),
    (r"permission to use copy modify and(?: or)? distribute this software for any purpose", "isc", 1),
    (r"the author disclaims all warranties with regard to this software", "isc", 2),
    (r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd", 1),
    (r"redistribution and use in source and binary forms", "bsd", 2),
    (r"redistributions of source code must retain the above copyright notice", "bsd", 2),
    (r"redistributions in binary form must reproduce the above copyright notice", "bsd-2-clause", 1),
    (r"neither the names? of (?:the )?(?:\S+ ){1,8}nor the names of (?:its|their|the) contributors may be used to endorse or promote", "bsd-3-clause", 0),
    (r"all advertising materials mentioning features or use of this software must display", "bsd-4-clause", 0),
    (r"this software is provided by the copyright holders and contributors as is", "bsd", 2),
    (r"no express or implied licenses to any party s patent rights are granted by this license", "bsd-3-clause-clear", 0),
    (r"subject to the terms and conditions of this license each copyright holder and contributor hereby grants to those receiving rights", "bsd-2-clause-patent", 0),
    (r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "zlib", 0),
    (r"the origin of this software must not be misrepresented", "zlib", 0),
    (r"altered source versions must be plainly marked as such", "zlib", 1),
    (r"free and unencumbered software released into the public domain", "unlicense", 0),
    (r"anyone is free to copy modify publish use compile sell or distribute this software", "unlicense", 0),
    (r"everyone is permitted to copy and distribute verbatim or modified copies of this license document", "wtfpl", 0),
    (r"you just do what the fuck you want to", "wtfpl", 0),
    (r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", "gpl", 2),
    (r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "bsl-1.0", 0),
    (r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable", "apache-2.0", 1),
    (r"you must cause any modified files to carry prominent notices stating that you changed the files", "apache-2.0", 1),
    (r"terms and conditions for use reproduction and distribution", "apache-2.0", 1),
    (r"this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0", 0),
    (r"if a copy of the mpl was not distributed with this file you can obtain one", "mpl-2.0", 0),
    (r"the contents of this file are subject to the mozilla public license version 1 1", "mpl-1.1", 0),
    (r"the contents of this file are subject to the netscape public license", "npl", 0),
    (r"the contents of this file are subject to the terms of the common development and distribution license", "cddl", 0),
    (r"this program and the accompanying materials are made available under the terms of the eclipse public license v ?1 0", "epl-1.0", 0),
    (r"this program and the accompanying materials are made available under the terms of the eclipse public license(?: v(?:ersion)?)? ?2 0", "epl-2.0", 0),
    (r"the accompanying program is provided under the terms of this eclipse public license", "epl", 0),
    (r"the accompanying program is provided under the terms of this common public license", "cpl", 0),
    (r"this package is free software you can redistribute it and or modify it under the same terms as perl", "artistic-perl", 0),
    (r"the intent of this document is to state the conditions under which a package may be copied", "artistic-1.0", 0),
    (r"everyone is permitted to copy and distribute verbatim copies of this license document", "artistic-2.0", 2),
    (r"this license establishes the terms under which a given free software package may be copied modified distributed", "artistic-2.0", 0),
    (r"the php license version 3 01", "php-3.01", 0),
    (r"products derived from this software may not be called php", "php", 0),
    (r"this product includes software developed by the openssl project", "openssl", 0),
    (r"redistributions of any form whatsoever must retain the following acknowledgment", "openssl", 1),
    (r"this product includes software developed by the apache software foundation", "apache-1.1", 0),
    (r"this product includes software developed by the university of california berkeley", "bsd-4-clause-uc", 0),
    (r"python software foundation license version 2", "psf-2.0", 0),
    (r"psf is making python available to licensee on an as is basis", "psf-2.0", 0),
    (r"this license is copyright (?:c )?1998 by the sil", "ofl", 1),
    (r"the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects", "ofl-1.1", 0),
    (r"the font software may be modified altered or added to", "bitstream-vera", 0),
    (r"this font software is licensed under the sil open font license version 1 1", "ofl-1.1", 0),
    (r"permission is granted to anyone to use this software for any purpose including commercial applications", "zlib", 1),
    (r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation", "gfdl", 0),
    (r"gnu general public license as published by the free software foundation either version 3 of the license or", "gpl-3.0-or-later", 0),
    (r"gnu general public license as published by the free software foundation either version 2 of the license or", "gpl-2.0-or-later", 0),
    (r"this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl", 0),
    (r"this library is free software you can redistribute it and or modify it under the terms of the gnu library general public license", "lgpl-2.0", 0),
    (r"you should have received a copy of the gnu general public license", "gpl", 1),
    (r"you should have received a copy of the gnu lesser general public license", "lgpl", 1),
    (r"you should have received a copy of the gnu library general public license", "lgpl-2.0", 1),
    (r"you should have received a copy of the gnu affero general public license", "agpl", 1),
    (r"as published by the free software foundation version 2", "gpl-2.0-only", 1),
    (r"if the program as you received it specifies that a certain numbered version", "gpl", 2),
    (r"this is a free software license and is compatible with the gnu gpl", "gpl-compatible", 2),
    (r"licensor shall be liable for direct damages this european union public licence", "eupl", 1),
    (r"licensed under the eupl", "eupl", 0),
    (r"ce contrat est une licence de logiciel libre", "cecill", 0),
    (r"ce logiciel est regi par la licence cecill", "cecill", 0),
    (r"this software is governed by the cecill(?: [bc])? license under french law", "cecill", 0),
    (r"this work may be distributed and or modified under the conditions of the latex project public license", "lppl", 0),
    (r"you may use this software under the terms of the ruby license or the bsd license", "ruby", 1),
    (r"you can redistribute it and or modify it under either the terms of the (?:2 clause )?bsdl?", "ruby", 1),
    (r"this software is released under the academic free license", "afl", 0),
    (r"licensed under the open software license", "osl", 0),
    (r"licensed under the educational community license version 2 0", "ecl-2.0", 0),
    (r"the university of illinois ncsa open source license", "ncsa", 0),
    (r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement", "postgresql", 0),
    (r"permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted", "hpnd", 0),
    (r"permission to use copy modify distribute and sell this software and its documentation for any purpose is hereby granted without fee", "hpnd-sell-variant", 0),
    (r"unicode copyright and terms of use", "unicode", 0),
    (r"unicode inc license agreement data files and software", "unicode-dfs", 0),
    (r"this software may be used and distributed according to the terms of the gnu general public license", "gpl", 0),
    (r"the json license", "json", 1),
    (r"the software shall be used for good not evil", "json", 0),
    (r"as long as you retain this notice you can do whatever you want with this stuff", "beerware", 0),
    (r"if we meet some day and you think this stuff is worth it you can buy me a beer", "beerware", 0),
    (r"this work is published from", "cc0-1.0", 2),
    (r"to the extent possible under law the (?:author|person who associated cc0)", "cc0-1.0", 0),
    (r"has waived all copyright and related or neighboring rights", "cc0-1.0", 0),
    (r"released into the public domain", "public-domain", 1),
    (r"dedicated to the public domain", "public-domain", 1),
    (r"placed in the public domain", "public-domain", 1),
    (r"is in the public domain", "public-domain", 2),
    (r"no rights reserved", "public-domain", 2),
    (r"all rights reserved", "all-rights-reserved", 2),
    (r"this work is licensed under a creative commons", "cc", 1),
    (r"this work is licensed under the creative commons", "cc", 1),
    (r"except where otherwise noted content on this (?:site|wiki) is licensed under a creative commons", "cc", 1),
    (r"text is available under the creative commons attribution share ?alike license", "cc-by-sa", 0),
    (r"some rights reserved", "cc", 2),
    (r"proprietary and confidential", "proprietary", 1),
    (r"confidential and proprietary", "proprietary", 1),
    (r"unauthorized copying of this file via any medium is strictly prohibited", "proprietary", 0),
    (r"this software is the confidential and proprietary information of", "proprietary", 0),
    (r"end user license agreement", "eula", 1),
    (r"for non commercial use only", "non-commercial", 1),
    (r"for research purposes only", "research-only", 1),
    (r"free for personal use", "personal-use", 1),
    # headers and notices
    (r"licensed under the apache license version 2 0(?: the license)?", "apache-2.0", 0),
    (r"licensed under the apache license", "apache", 2),
    (r"licensed to the apache software foundation asf under one or more contributor license agreements", "apache-2.0", 0),
    (r"licensed under either of apache license version 2 0 or mit license", "apache-2.0-or-mit", 0),
    (r"licensed under the mit license", "mit", 1),
    (r"released under the mit license", "mit", 1),
    (r"distributed under the mit license", "mit", 1),
    (r"mit licensed", "mit", 1),
    (r"dual licensed under (?:the )?mit and (?:gnu )?gpl", "mit-or-gpl", 0),
    (r"dual licensed under (?:the )?mit (?:and|or) apache(?: 2 0)?", "apache-2.0-or-mit", 0),
    (r"licensed under the bsd 2 clause", "bsd-2-clause", 0),
    (r"licensed under the bsd 3 clause", "bsd-3-clause", 0),
    (r"use of this source code is governed by a bsd style license that can be found in the license file", "bsd-3-clause", 0),
    (r"use of this source code is governed by an mit style license", "mit", 0),
    (r"use of this source code is governed by the apache 2 0 license", "apache-2.0", 0),
    (r"distributed under the boost software license version 1 0", "bsl-1.0", 0),
    (r"licensed under the gnu general public license v ?2 0?", "gpl-2.0", 0),
    (r"licensed under the gnu general public license v ?3 0?", "gpl-3.0", 0),
    (r"licensed under the gnu affero general public license", "agpl", 0),
    (r"licensed under the gnu lesser general public license", "lgpl", 0),
    (r"licensed under the gplv?2", "gpl-2.0", 0),
    (r"licensed under the gplv?3", "gpl-3.0", 0),
    (r"licensed under the lgpl", "lgpl", 0),
    (r"licensed under the isc license", "isc", 0),
    (r"licensed under the zlib license", "zlib", 0),
    (r"licensed under the unlicense", "unlicense", 0),
    (r"licensed under the mozilla public license version 2 0", "mpl-2.0", 0),
    (r"licensed under the microsoft public license", "ms-pl", 0),
    (r"licensed under the elastic license(?: 2 0)?", "elastic-2.0", 0),
    (r"licensed under the server side public license", "sspl", 0),
    (r"licensed under the business source license(?: 1 1)?", "busl-1.1", 0),
    (r"licensed under the same terms as perl", "artistic-perl", 0),
    (r"licensed under cc by", "cc-by", 0),
    (r"licensed under cc by sa", "cc-by-sa", 0),
    (r"licensed under cc by nc", "cc-by-nc", 0),
    # identifiers: SPDX-License-Identifier lines
    (r"spdx license identifier mit", "mit", 0),
    (r"spdx license identifier mit 0", "mit-0", 0),
    (r"spdx license identifier apache 2 0 with llvm exception", "apache-2.0-with-llvm-exception", 0),
    (r"spdx license identifier apache 2 0", "apache-2.0", 0),
    (r"spdx license identifier apache 2 0 or mit", "apache-2.0-or-mit", 0),
    (r"spdx license identifier mit or apache 2 0", "apache-2.0-or-mit", 0),
    (r"spdx license identifier bsd 2 clause", "bsd-2-clause", 0),
    (r"spdx license identifier bsd 3 clause", "bsd-3-clause", 0),
    (r"spdx license identifier 0bsd", "0bsd", 0),
    (r"spdx license identifier isc", "isc", 0),
    (r"spdx license identifier zlib", "zlib", 0),
    (r"spdx license identifier unlicense", "unlicense", 0),
    (r"spdx license identifier wtfpl", "wtfpl", 0),
    (r"spdx license identifier bsl 1 0", "bsl-1.0", 0),
    (r"spdx license identifier mpl 2 0", "mpl-2.0", 0),
    (r"spdx license identifier epl 2 0", "epl-2.0", 0),
    (r"spdx license identifier epl 1 0", "epl-1.0", 0),
    (r"spdx license identifier cddl 1 0", "cddl-1.0", 0),
    (r"spdx license identifier gpl 2 0 only with linux syscall note", "gpl-2.0-only-with-linux-syscall-note", 0),
    (r"spdx license identifier gpl 2 0 with linux syscall note", "gpl-2.0-with-linux-syscall-note", 0),
    (r"spdx license identifier gpl 2 0 (?:only )?with classpath exception 2 0", "gpl-2.0-with-classpath-exception", 0),
    (r"spdx license identifier gpl 2 0(?: only)?", "gpl-2.0-only", 0),
    (r"spdx license identifier gpl 2 0 or later", "gpl-2.0-or-later", 0),
    (r"spdx license identifier gpl 3 0(?: only)?", "gpl-3.0-only", 0),
    (r"spdx license identifier gpl 3 0 or later", "gpl-3.0-or-later", 0),
    (r"spdx license identifier lgpl 2 1(?: only)?", "lgpl-2.1-only", 0),
    (r"spdx license identifier lgpl 2 1 or later", "lgpl-2.1-or-later", 0),
    (r"spdx license identifier lgpl 3 0(?: only)?", "lgpl-3.0-only", 0),
    (r"spdx license identifier lgpl 3 0 or later", "lgpl-3.0-or-later", 0),
    (r"spdx license identifier agpl 3 0(?: only)?", "agpl-3.0-only", 0),
    (r"spdx license identifier agpl 3 0 or later", "agpl-3.0-or-later", 0),
    (r"spdx license identifier cc0 1 0", "cc0-1.0", 0),
    (r"spdx license identifier cc by 4 0", "cc-by-4.0", 0),
    (r"spdx license identifier cc by sa 4 0", "cc-by-sa-4.0", 0),
    (r"spdx license identifier cc by nc 4 0", "cc-by-nc-4.0", 0),
    (r"spdx license identifier ofl 1 1", "ofl-1.1", 0),
    (r"spdx license identifier artistic 2 0", "artistic-2.0", 0),
    (r"spdx license identifier postgresql", "postgresql", 0),
    (r"spdx license identifier busl 1 1", "busl-1.1", 0),
    (r"spdx license identifier elastic 2 0", "elastic-2.0", 0),
    (r"spdx license identifier sspl 1 0", "sspl-1.0", 0),
    (r"spdx license identifier eupl 1 2", "eupl-1.2", 0),
    (r"spdx license identifier upl 1 0", "upl-1.0", 0),
    (r"spdx license identifier licenseref \S+", "licenseref", 1),
    # addresses
    (r"opensource org licenses mit(?: license)?(?: php| html)?", "mit", 1),
    (r"opensource org licenses apache 2 0", "apache-2.0", 1),
    (r"opensource org licenses bsd 2 clause", "bsd-2-clause", 1),
    (r"opensource org licenses bsd 3 clause", "bsd-3-clause", 1),
    (r"opensource org licenses bsd license(?: php)?", "bsd", 1),
    (r"opensource org licenses isc", "isc", 1),
    (r"opensource org licenses zlib", "zlib", 1),
    (r"opensource org licenses gpl 2 0", "gpl-2.0", 1),
    (r"opensource org licenses gpl 3 0", "gpl-3.0", 1),
    (r"opensource org licenses lgpl 2 1", "lgpl-2.1", 1),
    (r"opensource org licenses artistic license 2 0", "artistic-2.0", 1),
    (r"opensource org licenses mpl 2 0", "mpl-2.0", 1),
    (r"opensource org licenses osl 3 0", "osl-3.0", 1),
    (r"opensource org licenses afl 3 0", "afl-3.0", 1),
    (r"www apache org licenses license 2 0(?: txt| html)?", "apache-2.0", 0),
    (r"www apache org licenses license 1 1", "apache-1.1", 0),
    (r"www gnu org licenses gpl 3 0(?: txt| html)?", "gpl-3.0", 0),
    (r"www gnu org licenses gpl 2 0(?: txt| html)?", "gpl-2.0", 0),
    (r"www gnu org licenses old licenses gpl 2 0(?: txt| html)?", "gpl-2.0", 0),
    (r"www gnu org licenses lgpl 3 0(?: txt| html)?", "lgpl-3.0", 0),
    (r"www gnu org licenses agpl 3 0(?: txt| html)?", "agpl-3.0", 0),
    (r"www gnu org licenses fdl 1 3(?: txt| html)?", "gfdl-1.3", 0),
    (r"www gnu org (?:licenses|copyleft) gpl(?: txt| html)?", "gpl", 1),
    (r"www gnu org (?:licenses|copyleft) lgpl(?: txt| html)?", "lgpl", 1),
    (r"www gnu org licenses", "gnu", 2),
    (r"mozilla org mpl 2 0", "mpl-2.0", 0),
    (r"www mozilla org mpl", "mpl", 1),
    (r"www boost org license 1 0(?: txt)?", "bsl-1.0", 0),
    (r"www eclipse org legal epl v10(?: html)?", "epl-1.0", 0),
    (r"www eclipse org legal epl 2 0", "epl-2.0", 0),
    (r"creativecommons org publicdomain zero 1 0", "cc0-1.0", 0),
    (r"creativecommons org publicdomain mark 1 0", "public-domain", 0),
    (r"creativecommons org licenses by 4 0", "cc-by-4.0", 0),
    (r"creativecommons org licenses by 3 0", "cc-by-3.0", 0),
    (r"creativecommons org licenses by sa 4 0", "cc-by-sa-4.0", 0),
    (r"creativecommons org licenses by sa 3 0", "cc-by-sa-3.0", 0),
    (r"creativecommons org licenses by nd 4 0", "cc-by-nd-4.0", 0),
    (r"creativecommons org licenses by nc 4 0", "cc-by-nc-4.0", 0),
    (r"creativecommons org licenses by nc 3 0", "cc-by-nc-3.0", 0),
    (r"creativecommons org licenses by nc sa 4 0", "cc-by-nc-sa-4.0", 0),
    (r"creativecommons org licenses by nc nd 4 0", "cc-by-nc-nd-4.0", 0),
    (r"scripts sil org ofl", "ofl", 0),
    (r"openfontlicense org", "ofl", 1),
    (r"unlicense org", "unlicense", 0),
    (r"www wtfpl net", "wtfpl", 0),
    (r"www php net license 3 01(?: txt)?", "php-3.01", 0),
    (r"www zlib net zlib license(?: html)?", "zlib", 0),
    (r"www cecill info", "cecill", 0),
    (r"opendatacommons org licenses odbl 1 0", "odbl-1.0", 0),
    (r"opendatacommons org licenses by 1 0", "odc-by-1.0", 0),
    (r"opendatacommons org licenses pddl 1 0", "pddl-1.0", 0),
    (r"www openssl org source license", "openssl", 0),
    (r"joinup ec europa eu \S+ eupl", "eupl", 1),
    # exceptions
    (r"gpl(?: 2 0| version 2)? with (?:the )?classpath exception", "gpl-2.0-with-classpath-exception", 0),
    (r"gplv2 with (?:the )?classpath exception", "gpl-2.0-with-classpath-exception", 0),
    (r"gnu general public license version 2(?: only)? with (?:the )?classpath exception", "gpl-2.0-with-classpath-exception", 0),
    (r"subject to the classpath exception", "classpath-exception", 0),
    (r"linking this library statically or dynamically with other modules is making a combined work", "classpath-exception", 0),
    (r"as a special exception the copyright holders of this library give you permission to link", "classpath-exception", 0),
    (r"as a special exception if you link this library with other files", "gcc-exception", 0),
    (r"gcc runtime library exception", "gcc-exception", 0),
    (r"as a special exception to the gnu general public license if you distribute this file as part of a program", "autoconf-exception", 0),
    (r"in addition as a special exception the copyright holders give permission to link the code of portions of this program with", "openssl-exception", 0),
    (r"with the font exception", "font-exception", 1),
    (r"as a special exception if you create a document which uses this font", "font-exception", 0),
    (r"apache(?: license(?: version)?)? 2 0 with llvm exceptions?", "apache-2.0-with-llvm-exception", 0),
    (r"gpl 3 0 with (?:the )?autoconf exception", "gpl-3.0-with-autoconf-exception", 0),
    # what is said not to be so, with what it would otherwise be read as inside
    (r"not in the public domain", "not-public-domain", 0),
    (r"unlike the (?:gnu )?gpl", "not-gpl", 0),
    (r"incompatible with the (?:gnu )?gpl(?:v?[23])?", "gpl-incompatible", 0),
    (r"no license is granted", "no-license", 0),
    (r"without any license", "no-license", 1),
    (r"not released under (?:the )?mit license", "not-mit", 0),
    (r"not licensed under (?:the )?mit license", "not-mit", 0),
    (r"not available under (?:the )?mit license", "not-mit", 0),
    (r"not released under (?:the )?(?:gnu )?(?:general public license|gpl)", "not-gpl", 0),
    (r"not licensed under (?:the )?(?:gnu )?(?:general public license|gpl)", "not-gpl", 0),
    (r"not available under (?:the )?(?:gnu )?(?:general public license|gpl)", "not-gpl", 0),
    (r"not released under (?:the )?apache license(?: version)?(?: 2(?: 0)?)?", "not-apache", 0),
    (r"not licensed under (?:the )?apache license(?: version)?(?: 2(?: 0)?)?", "not-apache", 0),
    (r"not released under an open source license", "proprietary", 0),
    (r"not licensed under an open source license", "proprietary", 0),
)


def words_text(text: Column) -> Column:
    """The words, joined by single spaces."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.trim(F.regexp_replace(F.translate(text, upper, upper.lower()), GAPS, " "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _prefilter(keywords: list[str]) -> str:
    """Any keyword as a word of its own, grouped by first letter; the common word mit only before a license."""
    by: dict[str, list[str]] = {}
    for word in sorted(keywords):
        by.setdefault(word[0], []).append("it(?: x11| no attribution)? licen" if word == "mit" else f"{word[1:]} ")
    return " (?:" + "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in by.items()) + ")"


def _detections(words: Column, table: list[Rule]) -> Column:
    """array<array<struct<label, priority, start, end>>>: for each keyword's place, in order, what its rules find there."""
    by_words: dict[int, list[str]] = {}
    for keyword in sorted({r.keyword for r in table}):
        by_words.setdefault(len(keyword.split(" ")), []).append(keyword)
    first_words = sorted({r.keyword.split(" ")[0] for r in table})

    def gram(i: Column, n: int) -> Column:
        return F.array_join(F.slice(words, i + 1, n), " ")

    def begins(place: Column) -> Column:
        any_of = F.lit(False)
        for n, own in by_words.items():
            any_of = any_of | (place["w"] if n == 1 else gram(place["i"], n)).isin(own)
        return place["w"].isin(first_words) & any_of

    places = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), begins)
    none = F.array().cast("array<struct<label:string,priority:int,match:string>>")

    def found(place: Column) -> Column:
        window = F.concat(gram(place["i"], WINDOW), F.lit(" "))
        parts = []
        for n, own in by_words.items():
            key = place["w"] if n == 1 else gram(place["i"], n)
            by_keyword = [(k, F.array(*[F.struct(F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.regexp_extract(window, f"^{r.pattern}(?= )", 0).alias("match")) for r in table if r.keyword == k])) for k in own]
            parts.append(reduce(lambda c, kv, key=key: c.when(key == kv[0], kv[1]), by_keyword[1:], F.when(key == by_keyword[0][0], by_keyword[0][1])).otherwise(none))
        chosen = F.concat(*parts)
        return F.transform(
            F.filter(chosen, lambda d: d["match"] != ""),
            lambda d: F.struct(d["label"].alias("label"), d["priority"].alias("priority"), place["i"].alias("start"), (place["i"] + _spaces(d["match"]) + 1).alias("end")),
        )

    return F.transform(places, found)


def _kept(per_place: Column) -> Column:
    """The detections that no better one contains; only the WINDOW places up to a detection's own can hold such."""

    def better(e: Column, d: Column) -> Column:
        contains = (e["start"] <= d["start"]) & (e["end"] >= d["end"])
        longer = (e["end"] - e["start"]) > (d["end"] - d["start"])
        return contains & ((e["priority"] < d["priority"]) | ((e["priority"] == d["priority"]) & longer))

    def at(own: Column, k: Column) -> Column:
        near = F.flatten(F.slice(per_place, F.greatest(k - WINDOW + 2, F.lit(1)), F.least(k + 1, F.lit(WINDOW))))
        return F.filter(own, lambda d: ~F.exists(near, lambda e: better(e, d)))

    return F.flatten(F.transform(per_place, at))


def license_scan(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), base: dict[str, str] | None = None, table: list[Rule] | None = None) -> DataFrame:
    """``keep`` and, for each row: n_words, n_base, first_word, last_word, base_labels, spans, labels and score.

    n_base counts all places of base phrases; first_word and last_word are the
    smallest and largest word at which one starts. spans are the detections
    kept, array<struct<label, priority, start, end>> in words, end exclusive.
    base_labels and labels are sorted arrays without repeats.
    """
    base = BASE if base is None else base
    table = rules() if table is None else table
    scanned = docs.select(*keep, words_text(text_or_empty(text_col)).alias("__words"))
    scanned = scanned.withColumn("__spaced", F.concat(F.lit(" "), "__words", F.lit(" ")))
    spaced = F.col("__spaced")
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in base.items():
        padded = f" {phrase} "
        has = F.contains(spaced, F.lit(padded))
        counts.append(F.when(has, F.regexp_count(spaced, F.lit(f" {re.escape(phrase)}(?= )"))).otherwise(0))
        first = F.instr(spaced, padded)
        last = F.length(spaced) - F.locate(padded[::-1], F.reverse(spaced)) - len(padded) + 2
        firsts.append(F.when(has, _spaces(F.substring(spaced, F.lit(1), first)) - 1))
        lasts.append(F.when(has, _spaces(F.substring(spaced, F.lit(1), last)) - 1))
        labels.append(F.when(has, F.lit(label)))
    keywords = sorted({r.keyword for r in table})
    none = F.lit(None).cast("array<array<struct<label:string,priority:int,start:int,end:int>>>")
    scanned = scanned.select(
        *keep,
        F.when(F.col("__words") == "", 0).otherwise(_spaces(F.col("__words")) + 1).cast("long").alias("n_words"),
        reduce(lambda a, b: a + b, counts).cast("long").alias("n_base"),
        F.array_min(F.array(*firsts)).cast("long").alias("first_word"),
        F.array_max(F.array(*lasts)).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))).alias("base_labels"),
        F.when(F.rlike(spaced, F.lit(_prefilter(keywords))), F.split("__words", " ")).alias("__list"),
    )
    scanned = scanned.withColumn("__found", F.when(F.col("__list").isNotNull(), _detections(F.col("__list"), table)).otherwise(none)).drop("__list")
    scanned = scanned.withColumn("spans", F.coalesce(_kept(F.col("__found")), F.array().cast("array<struct<label:string,priority:int,start:int,end:int>>"))).drop("__found")
    by_priority = F.array(*map(F.lit, SCORES))
    return scanned.withColumns({
        "labels": F.array_sort(F.array_union("base_labels", F.transform("spans", lambda s: s["label"]))),
        "score": F.when(F.col("n_base") > 0, F.lit(BASE_SCORE)).otherwise(F.coalesce(F.array_max(F.transform("spans", lambda s: F.element_at(by_priority, s["priority"] + 1))), F.lit(0.0))),
    })
