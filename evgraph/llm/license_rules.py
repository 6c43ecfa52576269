"""Signature rules of the licence scan.

A pattern is written over words: lower case, one space between words, nothing but letters, digits and `(?: | )?` around them.
Each line of a table below gives rules of one tier; tiers and then lines are the order of the rules. The keyword is a word
that stands in every match; the word license is another one where a pattern can't do without it.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    number: int
    tier: int
    label: str
    keywords: list[str]
    pattern: str


#: How sure a detection of each tier is.
CONFIDENCE = {1: 1.0, 2: 0.95, 3: 0.9, 4: 0.6}
GNU, V = "gnu ", "(?:version |v )?v?"
LATER = "(?: or later| or any later version| or at your option any later version)"
GRANT = "(?:licensed|sublicensed|released|distributed|redistributed|published|available|provided|covered|governed|used) (?:under|by|subject to|in accordance with) (?:the |an |a )?(?:terms (?:and conditions )?of (?:the )?)?"

# label; keyword of the name; SPDX identifier in words; name. One line makes three rules: tag, grant, name.
NAMES = [
    ("agpl-3.0", "affero", "agpl 3 0(?: only| or later)?", f"(?:{GNU})?affero general public license {V}3(?: 0)?{LATER}?"),
    ("agpl", "affero", "agpl 1 0(?: only| or later)?", f"(?:{GNU})?affero general public license"),
    ("lgpl-3.0", "lesser", "lgpl 3 0(?: only| or later)?", f"(?:{GNU})?lesser general public license {V}3(?: 0)?{LATER}?"),
    ("lgpl-2.1", "lesser", "lgpl 2 1(?: only| or later)?", f"(?:{GNU})?lesser general public license {V}2 1{LATER}?"),
    ("lgpl-2.0", "library", "lgpl 2 0(?: only| or later)?", f"(?:{GNU})?library general public license(?: {V}2(?: 0)?)?{LATER}?"),
    ("lgpl", "lesser", "lgpl", f"(?:{GNU})?lesser general public license"),
    ("gpl-3.0", "general", "gpl 3 0(?: only| or later)?", f"(?:{GNU})?general public license {V}3(?: 0)?{LATER}?"),
    ("gpl-2.0", "general", "gpl 2 0(?: only| or later)?", f"(?:{GNU})?general public license {V}2(?: 0)?{LATER}?"),
    ("gpl-1.0", "general", "gpl 1 0(?: only| or later)?", f"(?:{GNU})?general public license {V}1(?: 0)?{LATER}?"),
    ("gpl", "general", "gpl", f"{GNU}general public license"),
    ("gfdl-1.3", "documentation", "gfdl 1 3(?: only| or later)?", f"(?:{GNU})?free documentation license {V}1 3{LATER}?"),
    ("gfdl-1.2", "documentation", "gfdl 1 2(?: only| or later)?", f"(?:{GNU})?free documentation license {V}1 2{LATER}?"),
    ("gfdl", "documentation", "gfdl 1 1(?: only| or later)?", f"(?:{GNU})?free documentation license"),
    ("apache-2.0", "apache", "apache 2 0", f"apache (?:software )?license {V}2(?: 0)?"),
    ("apache-1.1", "apache", "apache 1 1", f"apache (?:software )?license {V}1 1"),
    ("apache-1.0", "apache", "apache 1 0", f"apache (?:software )?license {V}1 0"),
    ("apache", "apache", "apache", "apache (?:software )?license"),
    ("mit-0", "mit", "mit 0", "mit no attribution license"),
    ("mit", "mit", "mit", "mit license"),
    ("x11", "x11", "x11", "(?:mit )?x11 license"),
    ("bsd-4-clause", "bsd", "bsd 4 clause", "(?:4|four) clause bsd license|(?:original|old) bsd license|bsd 4 clause license"),
    ("bsd-3-clause", "bsd", "bsd 3 clause(?: clear)?", "(?:3|three) clause bsd license|(?:modified|new|revised) bsd license|bsd 3 clause license"),
    ("bsd-2-clause", "bsd", "bsd 2 clause(?: patent)?", "(?:2|two) clause bsd license|(?:simplified|freebsd) bsd license|bsd 2 clause license"),
    ("bsd-0-clause", "bsd", "0bsd", "(?:0|zero) clause bsd license|bsd zero clause license"),
    ("bsd", "bsd", "bsd", "bsd license"),
    ("isc", "isc", "isc", "isc license"),
    ("zlib", "zlib", "zlib", "zlib(?: libpng)? license"),
    ("boost-1.0", "boost", "bsl 1 0", f"boost software license(?: {V}1 0)?"),
    ("business-source-1.1", "business", "busl 1 1", f"business source license(?: {V}1 1)?"),
    ("mpl-2.0", "mozilla", "mpl 2 0(?: no copyleft exception)?", f"mozilla public license {V}2(?: 0)?"),
    ("mpl-1.1", "mozilla", "mpl 1 1", f"mozilla public license {V}1 1"),
    ("mpl", "mozilla", "mpl 1 0", "mozilla public license"),
    ("epl-2.0", "eclipse", "epl 2 0", f"eclipse public license {V}2(?: 0)?"),
    ("epl-1.0", "eclipse", "epl 1 0", f"eclipse public license(?: {V}1 0)?"),
    ("cddl-1.1", "common", "cddl 1 1", f"common development and distribution license {V}1 1"),
    ("cddl-1.0", "common", "cddl 1 0", f"common development and distribution license(?: {V}1 0)?"),
    ("cpl-1.0", "common", "cpl 1 0", f"common public license(?: {V}1 0)?"),
    ("cpal-1.0", "attribution", "cpal 1 0", f"common public attribution license(?: {V}1 0)?"),
    ("eupl-1.2", "union", "eupl 1 2", f"european union public licen[cs]e(?: {V}1 2)?"),
    ("artistic-2.0", "artistic", "artistic 2 0", f"artistic license {V}2(?: 0)?"),
    ("artistic-1.0", "artistic", "artistic 1 0(?: perl| cl8)?", f"artistic license(?: {V}1 0)?"),
    ("osl-3.0", "open", "osl 3 0", f"open software license {V}3(?: 0)?"),
    ("afl-3.0", "academic", "afl 3 0", f"academic free license(?: {V}3(?: 0)?)?"),
    ("ms-pl", "microsoft", "ms pl", "microsoft public license"),
    ("ms-rl", "microsoft", "ms rl", "microsoft reciprocal license"),
    ("python-2.0", "python", "(?:psf|python) 2 0", f"(?:python software foundation|python) license(?: {V}2)?"),
    ("php-3.01", "php", "php 3 01", f"php license(?: {V}3 01)?"),
    ("ruby", "ruby", "ruby", "ruby license"),
    ("vim", "vim", "vim", "vim license"),
    ("w3c", "w3c", "w3c", "w3c (?:software )?(?:notice and )?license"),
    ("openssl", "openssl", "openssl", "openssl license"),
    ("ofl-1.1", "font", "ofl 1 1", f"(?:sil )?open font license(?: {V}1 1)?"),
    ("ncsa", "illinois", "ncsa", "university of illinois (?:ncsa )?(?:open source )?license"),
    ("postgresql", "postgresql", "postgresql", "postgresql license"),
    ("unlicense", "unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", f"wtfpl(?: {V}2)?"),
    ("sspl-1.0", "side", "sspl 1 0", f"server side public license(?: {V}1(?: 0)?)?"),
    ("elastic-2.0", "elastic", "elastic 2 0", f"elastic license(?: {V}2(?: 0)?)?"),
    ("ecl-2.0", "educational", "ecl 2 0", f"educational community license(?: {V}2(?: 0)?)?"),
    ("upl-1.0", "universal", "upl 1 0", f"universal permissive license(?: {V}1(?: 0)?)?"),
    ("bsd-protection", "protection", "bsd protection", "bsd protection license"),
    ("odbl-1.0", "database", "odbl 1 0", f"(?:odc )?open database license(?: {V}1(?: 0)?)?"),
    ("odc-by-1.0", "odc", "odc by 1 0", f"odc (?:open data commons )?attribution license(?: {V}1(?: 0)?)?"),
    ("pddl-1.0", "dedication", "pddl 1 0", "(?:odc )?public domain dedication and license(?: pddl)?"),
    ("openrail-m", "openrail", "(?:bigscience |creativeml )?openrail m", "(?:bigscience |creativeml )?openrail m license"),
    ("cc0-1.0", "cc0", "cc0 1 0", "(?:creative commons )?cc0(?: 1 0)?(?: universal)?(?: public domain dedication)?"),
]

# Creative Commons: elements in words, as they stand in tags, names and addresses. Rules by versions follow below.
COMMONS = [
    ("cc-by-nc-nd", "by nc nd", "attribution non(?: )?commercial no(?: )?deriv(?:ative)?s(?: works)?"), ("cc-by-nc-sa", "by nc sa", "attribution non(?: )?commercial share(?: )?alike"),
    ("cc-by-nc", "by nc", "attribution non(?: )?commercial"), ("cc-by-nd", "by nd", "attribution no(?: )?deriv(?:ative)?s(?: works)?"),
    ("cc-by-sa", "by sa", "attribution share(?: )?alike"), ("cc-by", "by", "attribution"),
]
COMMONS_VERSIONS = [("4.0", "4 0"), ("3.0", "3 0"), ("2.5", "2 5"), ("2.0", "2 0"), ("", "")]

# Addresses: label; keyword; the address in words.
ADDRESSES = [
    ("apache-2.0", "apache", "www apache org licenses license 2 0(?: txt| html)?"), ("apache-1.1", "apache", "www apache org licenses license 1 1(?: txt)?"), ("apache", "apache", "www apache org licenses"),
    ("gpl-3.0", "gnu", "www gnu org licenses (?:old licenses )?gpl 3 0(?: en)?(?: html| txt)?"), ("gpl-2.0", "gnu", "www gnu org licenses (?:old licenses )?gpl 2 0(?: en)?(?: html| txt)?"), ("gpl", "gnu", "www gnu org licenses (?:gpl|gpl html)"),
    ("lgpl-3.0", "gnu", "www gnu org licenses lgpl 3 0(?: en)?(?: html| txt)?"), ("lgpl-2.1", "gnu", "www gnu org licenses (?:old licenses )?lgpl 2 1(?: en)?(?: html| txt)?"), ("agpl-3.0", "gnu", "www gnu org licenses agpl 3 0(?: en)?(?: html| txt)?"),
    ("gfdl", "gnu", "www gnu org (?:licenses|copyleft) fdl(?: 1 [123])?(?: html| txt)?"), ("mpl-2.0", "mozilla", "(?:www )?mozilla org mpl 2 0"), ("mpl-1.1", "mozilla", "(?:www )?mozilla org mpl mpl 1 1(?: html| txt)?"), ("mpl", "mozilla", "(?:www )?mozilla org mpl"),
    ("epl-2.0", "eclipse", "www eclipse org legal epl (?:2 0|v20)(?: html)?"), ("epl-1.0", "eclipse", "www eclipse org legal epl v10(?: html)?"), ("boost-1.0", "boost", "www boost org license 1 0(?: txt)?"), ("unlicense", "unlicense", "unlicense org"),
    ("mit", "opensource", "(?:www )?opensource org licen[cs]es mit(?: license)?(?: php)?"), ("apache-2.0", "opensource", "(?:www )?opensource org licenses apache 2 0"), ("bsd-3-clause", "opensource", "(?:www )?opensource org licenses bsd 3 clause"),
    ("bsd-2-clause", "opensource", "(?:www )?opensource org licenses bsd 2 clause"), ("bsd", "opensource", "(?:www )?opensource org licenses bsd license(?: php)?"), ("isc", "opensource", "(?:www )?opensource org licenses isc(?: license)?"),
    ("artistic-2.0", "opensource", "(?:www )?opensource org licenses artistic (?:license )?2 0"), ("zlib", "opensource", "(?:www )?opensource org licenses zlib(?: license)?(?: php)?"), ("ofl-1.1", "scripts", "scripts sil org ofl"),
    ("wtfpl", "wtfpl", "www wtfpl net"), ("odbl-1.0", "opendatacommons", "(?:www )?opendatacommons org licenses odbl(?: 1 0)?"), ("pddl-1.0", "opendatacommons", "(?:www )?opendatacommons org licenses pddl(?: 1 0)?"),
    ("cc0-1.0", "creativecommons", "creativecommons org publicdomain zero 1 0"), ("public-domain", "creativecommons", "creativecommons org publicdomain mark 1 0"), ("elastic-2.0", "elastic", "www elastic co licensing elastic license"),
]

# Sentences of licence texts: label; keyword; the sentence in words.
TEXTS = [
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "notice", "the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software"),
    ("isc", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd-0-clause", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-2-clause", "redistributions", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-2-clause", "redistributions", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-3-clause", "endorse", "neither the names? of (?:the )?[a-z]+(?: [a-z]+){0,6} nor the names of (?:its|their|any) contributors may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "grants", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) license"),
    ("apache-2.0", "conditions", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("apache-1.1", "foundation", "this product includes software developed by the apache software foundation"),
    ("gpl", "redistribute", "this (?:program|library|file|software) is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl-3.0", "redistribute", "this (?:program|library|file|software) is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2.0", "redistribute", "this (?:program|library|file|software) is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("lgpl", "redistribute", "this (?:program|library|file|software) is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "redistribute", "this (?:program|library|file|software) is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"),
    ("gpl", "copyleft", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl", "merchantability", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("gfdl", "granted", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2.0", "subject", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "subject", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-1.0", "accompanying", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2.0", "accompanying", "this program and the accompanying materials are made available under the terms of the eclipse public license v?(?: )?2 0"),
    ("cddl-1.0", "subject", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("boost-1.0", "hereby", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("zlib", "altered", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", "arising", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "fuck", "you just do what the fuck you want to"),
    ("cc0-1.0", "rights", "has (?:dedicated the work to the public domain by )?waiv(?:ed|ing) all (?:of his or her |copyright and related )?rights to the work worldwide under copyright law"),
    ("cc-by", "remix", "you are free to share copy distribute and transmit the work to remix to adapt the work"),
    ("ofl-1.1", "font", "this font software is licensed under the sil open font license"),
    ("artistic-2.0", "package", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed this license establishes the terms under which a given free software package may be copied"),
    ("ncsa", "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction"),
    ("postgresql", "agreement", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
]

# Notices that name no licence, and short forms: label; tier; keyword; words.
NOTICES = [
    ("proprietary", 3, "reserved", "all rights (?:are )?reserved"), ("proprietary", 3, "proprietary", "proprietary and confidential"), ("proprietary", 3, "permission", "(?:may not|must not|not) be (?:copied|reproduced|redistributed)(?: or [a-z]+)? without (?:prior |express |the )?(?:written |prior )?permission"),
    ("proprietary", 3, "unauthorized", "unauthorized (?:copying|use|reproduction|distribution)(?: or [a-z]+)? (?:of this [a-z]+ )?is (?:strictly )?prohibited"), ("public-domain", 3, "domain", "(?:is|are|placed|released|dedicated) (?:in|into|to) the public domain"), ("public-domain", 4, "domain", "public domain"),
    ("dual-license", 3, "dual", "dual licensed (?:under|with|as)"), ("royalty-free", 4, "royalty", "royalty free license"), ("non-commercial", 4, "commercial", "for non commercial (?:use|purposes) only"), ("research-only", 4, "research", "for (?:academic and )?research (?:use|purposes) only"),
    ("gpl", 4, "gplv3", "(?:gnu )?gplv3"), ("gpl", 4, "gplv2", "(?:gnu )?gplv2"), ("lgpl", 4, "lgplv3", "(?:gnu )?lgplv3"), ("agpl-3.0", 4, "agplv3", "(?:gnu )?agplv3"), ("gpl", 4, "gpl", "gnu gpl"), ("lgpl", 4, "lgpl", "gnu lgpl"),
    ("apache-2.0", 4, "apache", "apache 2 0"), ("bsd", 4, "bsd", "bsd style license"), ("mit", 4, "mit", "mit style license"), ("mit", 4, "expat", "expat license"), ("eula", 4, "end", "end user license agreement"),
]


def always(word: str, pattern: str) -> bool:
    """Whether the word stands in every choice of a pattern, not counting what is optional."""
    bare, before = pattern, ""
    while bare != before:
        before, bare = bare, re.sub(r"\(\?:[^()]*\)\?", "", bare)
    whole = bare.removeprefix("(?:").removesuffix(")") if bare.count("(") == 1 and bare.startswith("(?:") and bare.endswith(")") else bare
    choices = whole.split("|") if "(" not in whole else [whole]
    return all(word in re.sub(r"\(\?:[^()]*\)", " ", x).split(" ") for x in choices)


def rules() -> list[Rule]:
    """All rules in order. What stands first wins where two detections of equal place and tier disagree."""
    out: list[tuple[int, str, str, str]] = []
    for label, keyword, words in ADDRESSES:
        out.append((1, label, keyword, words))
    for label, keyword, tag, name in NAMES:
        out.append((1, label, "spdx", f"spdx license identifier {tag}"))
        out.append((3, label, keyword, f"{GRANT}(?:{name})"))
        out.append((4, label, keyword, f"(?:{name})" if "|" in name else name))
    for label, tag, name in COMMONS:
        for version, words in COMMONS_VERSIONS:
            own, after = (f"{label}-{version}", f" {words}") if version else (label, "")
            out.append((1, own, "spdx", f"spdx license identifier cc {tag}{after}"))
            out.append((1, own, "creativecommons", f"creativecommons org licenses {tag}{after}"))
            out.append((3, own, "commons", f"{GRANT}creative commons {name}(?: license)?{after}(?: (?:international|unported|generic))?(?: license)?"))
            out.append((3, own, "cc", f"{GRANT}cc {tag}{after}"))
            out.append((4, own, "commons", f"creative commons {name}(?: license)?{after}(?: (?:international|unported|generic))?(?: license)?"))
            out.append((4, own, "cc", f"cc {tag}{after}"))
    out += [(2, label, keyword, words) for label, keyword, words in TEXTS]
    out += [(tier, label, keyword, words) for label, tier, keyword, words in NOTICES]
    out.sort(key=lambda r: r[0])  # by tier, else as written
    return [Rule(i, tier, label, [keyword, "license"] if always("license", words) else [keyword], words) for i, (tier, label, keyword, words) in enumerate(out)]
