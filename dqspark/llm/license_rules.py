"""Signatures of licenses, in the words of a normalised text.

Normalised texts are lower case with single blanks between words; a version
like 2.0 is the two words ``2 0``. A rule is tried on texts that have one of its
keywords, as whole words; every match of its pattern has one.
"""

from __future__ import annotations

from typing import NamedTuple

TAG, GRANT, MENTION = 3, 2, 1
_V = "(?:version |v )?"


class Rule(NamedTuple):
    label: str
    priority: int
    weight: float
    keywords: tuple[str, ...]
    regex: str


#: label, keywords of its name, identifier (its first words are a keyword too), name.
LICENSES = (
    ("apache-1.1", "apache", "apache 1 1", rf"apache software license {_V}1 1"),
    ("apache-2.0", "apache", "apache 2 0", rf"apache (?:software )?license {_V}2(?: 0)?"),
    ("mit", "mit license|expat license", "mit", "(?:mit|expat) license"),
    ("mit-0", "mit no attribution", "mit 0", "mit no attribution(?: license)?"),
    ("isc", "isc license", "isc", "isc license"),
    ("0bsd", "bsd|zero clause", "0bsd", "(?:bsd zero clause|zero clause bsd)(?: license)?"),
    ("bsd-1-clause", "bsd", "bsd 1 clause", "(?:bsd 1 clause|1 clause bsd|one clause bsd)(?: license)?"),
    ("bsd-2-clause", "bsd|freebsd", "bsd 2 clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: license)?"),
    ("bsd-3-clause", "bsd", "bsd 3 clause", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: license)?"),
    ("bsd-4-clause", "bsd", "bsd 4 clause", "(?:bsd 4 clause|4 clause bsd|original bsd|old bsd)(?: license)?"),
    ("gpl-1.0", "general public license", "gpl 1 0(?: only| or later)?", rf"(?:gnu )?general public license {_V}1(?: 0)?"),
    ("gpl-2.0", "general public license", "gpl 2 0(?: only)?", rf"(?:gnu )?general public license {_V}2(?: 0)?"),
    ("gpl-2.0-or-later", "general public license", "gpl 2 0 or later",
     rf"(?:gnu )?general public license {_V}2(?: 0)?(?: as published by [^ ]+ [^ ]+ [^ ]+ [^ ]+)? or (?:at your option )?any later(?: version)?"),
    ("gpl-3.0", "general public license", "gpl 3 0(?: only)?", rf"(?:gnu )?general public license {_V}3(?: 0)?"),
    ("gpl-3.0-or-later", "general public license", "gpl 3 0 or later",
     rf"(?:gnu )?general public license {_V}3(?: 0)? or (?:at your option )?any later(?: version)?"),
    ("lgpl-2.0", "general public license", "lgpl 2 0(?: only| or later)?", rf"(?:gnu )?library general public license(?: {_V}2(?: 0)?)?"),
    ("lgpl-2.1", "general public license", "lgpl 2 1(?: only| or later)?", rf"(?:gnu )?lesser general public license {_V}2 1"),
    ("lgpl-3.0", "general public license", "lgpl 3 0(?: only| or later)?", rf"(?:gnu )?lesser general public license {_V}3(?: 0)?"),
    ("agpl-1.0", "general public license", "agpl 1 0(?: only| or later)?", rf"affero general public license {_V}1(?: 0)?"),
    ("agpl-3.0", "general public license", "agpl 3 0(?: only| or later)?", rf"(?:gnu )?affero general public license(?: {_V}3(?: 0)?)?"),
    ("gfdl-1.1", "free documentation", "gfdl 1 1(?: only| or later)?", rf"(?:gnu )?free documentation license {_V}1 1"),
    ("gfdl-1.2", "free documentation", "gfdl 1 2(?: only| or later)?", rf"(?:gnu )?free documentation license {_V}1 2"),
    ("gfdl-1.3", "free documentation", "gfdl 1 3(?: only| or later)?", rf"(?:gnu )?free documentation license {_V}1 3"),
    ("mpl-1.0", "mozilla", "mpl 1 0", rf"mozilla public license {_V}1 0"),
    ("mpl-1.1", "mozilla", "mpl 1 1", rf"mozilla public license {_V}1 1"),
    ("mpl-2.0", "mozilla", "mpl 2 0", rf"mozilla public license {_V}2(?: 0)?"),
    ("epl-1.0", "eclipse", "epl 1 0", rf"eclipse public license {_V}1(?: 0)?"),
    ("epl-2.0", "eclipse", "epl 2 0", rf"eclipse public license {_V}2(?: 0)?"),
    ("edl-1.0", "eclipse", "edl 1 0", rf"eclipse distribution license(?: {_V}1(?: 0)?)?"),
    ("eupl-1.1", "european union", "eupl 1 1", rf"european union public licen[cs]e {_V}1 1"),
    ("eupl-1.2", "european union", "eupl 1 2", rf"european union public licen[cs]e(?: {_V}1 2)?"),
    ("cddl-1.0", "common development", "cddl 1 0", rf"common development and distribution license(?: {_V}1(?: 0)?)?"),
    ("cddl-1.1", "common development", "cddl 1 1", rf"common development and distribution license {_V}1 1"),
    ("cpl-1.0", "common public license", "cpl 1 0", rf"common public license(?: {_V}1(?: 0)?)?"),
    ("ipl-1.0", "ibm public license", "ipl 1 0", rf"ibm public license(?: {_V}1(?: 0)?)?"),
    ("osl-3.0", "open software license", "osl 3 0", rf"open software license(?: {_V}3(?: 0)?)?"),
    ("afl-3.0", "academic free license", "afl 3 0", rf"academic free license(?: {_V}3(?: 0)?)?"),
    ("artistic-1.0", "artistic license", "artistic 1 0", rf"artistic license {_V}1(?: 0)?"),
    ("artistic-2.0", "artistic license", "artistic 2 0", rf"artistic license {_V}2(?: 0)?"),
    ("bsl-1.0", "boost", "bsl 1 0", rf"boost software license(?: {_V}1(?: 0)?)?"),
    ("busl-1.1", "business source license", "busl 1 1", rf"business source license(?: {_V}1 1)?"),
    ("sspl-1.0", "server side public license", "sspl 1 0", rf"server side public license(?: {_V}1(?: 0)?)?"),
    ("elastic-2.0", "elastic license", "elastic 2 0", rf"elastic license(?: {_V}2(?: 0)?)?"),
    ("zlib", "zlib", "zlib", "zlib(?: libpng)? license"),
    ("libpng", "libpng|png reference", "libpng(?: 2 0)?", rf"(?:png reference library|libpng) license(?: {_V}2)?"),
    ("unlicense", "unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "you want to public license", "wtfpl", "do what the f[^ ]* you want to public license"),
    ("postgresql", "postgresql license", "postgresql", "postgresql license"),
    ("python-2.0", "python license|python software foundation license|psf license|python 2 0|psf 2 0", "(?:python|psf) 2 0", "(?:python software foundation|psf|python) license(?: agreement)?"),
    ("php-3.01", "php license", "php 3 01", rf"php license(?: {_V}3 0?1)?"),
    ("ruby", "ruby license", "ruby", "ruby license"),
    ("perl", "same terms as perl", "artistic 1 0 perl", "same terms as perl(?: itself)?"),
    ("ofl-1.1", "open font license", "ofl 1 1", rf"(?:sil )?open font license(?: {_V}1 1)?"),
    ("ms-pl", "microsoft public license", "ms pl", "microsoft public license"),
    ("ms-rl", "microsoft reciprocal license", "ms rl", "microsoft reciprocal license"),
    ("ncsa", "ncsa", "ncsa", "(?:university of illinois )?ncsa open source license"),
    ("w3c", "w3c", "w3c", "w3c (?:software (?:and document )?notice and |software )?license"),
    ("openssl", "openssl license", "openssl", "openssl license"),
    ("vim", "vim license", "vim", "vim license"),
    ("cecill-2.1", "cecill", "cecill 2 1", rf"cecill (?:free software )?license(?: agreement)?(?: {_V}2 1)?"),
    ("cecill-b", "cecill b", "cecill b", "cecill b(?: license)?"),
    ("odbl-1.0", "open database license|open data commons", "odbl 1 0", rf"open (?:data commons open )?database license(?: {_V}1(?: 0)?)?"),
    ("odc-by-1.0", "data commons attribution", "odc by 1 0", rf"open data commons attribution license(?: {_V}1(?: 0)?)?"),
    ("pddl-1.0", "public domain dedication", "pddl 1 0", "open data commons public domain dedication(?: and license)?"),
    ("cdla-permissive-2.0", "community data license", "cdla permissive 2 0", rf"community data license agreement permissive(?: {_V}[12] 0)?"),
    ("cdla-sharing-1.0", "community data license", "cdla sharing 1 0", rf"community data license agreement sharing(?: {_V}1 0)?"),
    ("ogl-3.0", "open government licence|open government license|ogl uk 3|ogl 3", "ogl (?:uk )?3 0", rf"open government licen[cs]e(?: {_V}3 0)?"),
    ("etalab-2.0", "licence ouverte", "etalab 2 0", "licence ouverte(?: open licence)?(?: etalab)?(?: (?:version )?2 0)?"),
    ("openrail-m", "openrail|open rail|bigscience|creativeml", "openrail m", "(?:bigscience |creativeml )?open ?rail m(?: license)?"),
    ("llama-community", "llama", "llama [23]", "llama [0-9]+(?: [0-9]+)? community license(?: agreement)?"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?", rf"(?:creative commons )?cc0(?: 1 0)?(?: universal)?(?: public domain dedication)?"),
    ("cc-by-2.0", "creative commons", "cc by 2 [05]", "creative commons attribution 2 [05](?: generic)?(?: license)?"),
    ("cc-by-3.0", "creative commons", "cc by 3 0", "creative commons attribution 3 0(?: unported)?(?: license)?"),
    ("cc-by-4.0", "creative commons", "cc by 4 0", "creative commons attribution 4 0(?: international)?(?: (?:public )?license)?"),
    ("cc-by-sa-3.0", "creative commons", "cc by sa 3 0", "creative commons attribution share ?alike 3 0(?: unported)?(?: license)?"),
    ("cc-by-sa-4.0", "creative commons", "cc by sa 4 0", "creative commons attribution share ?alike 4 0(?: international)?(?: license)?"),
    ("cc-by-nc-3.0", "creative commons", "cc by nc 3 0", "creative commons attribution non ?commercial 3 0(?: unported)?(?: license)?"),
    ("cc-by-nc-4.0", "creative commons", "cc by nc 4 0", "creative commons attribution non ?commercial 4 0(?: international)?(?: license)?"),
    ("cc-by-nd-4.0", "creative commons", "cc by nd 4 0", "creative commons attribution no ?deriv[^ ]* 4 0(?: international)?(?: license)?"),
    ("cc-by-nc-sa-4.0", "creative commons", "cc by nc sa 4 0", "creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: license)?"),
    ("cc-by-nc-nd-4.0", "creative commons", "cc by nc nd 4 0", "creative commons attribution non ?commercial no ?deriv[^ ]* 4 0(?: international)?(?: license)?"),
)

#: label, priority, keyword and pattern of sentences that stand in notices and texts.
NOTICES = (
    ("mit", GRANT, "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", MENTION, "merchantability", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("isc", GRANT, "permission to use copy", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", MENTION, "redistribution and use", "redistribution and use in source and binary forms"),
    ("bsd-3-clause", GRANT, "neither the name of", "neither the name of (?:[^ ]+ ){1,12}?nor the names of its contributors"),
    ("bsd-4-clause", GRANT, "advertising", "all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", GRANT, "licensed under the apache", "licensed under the apache license version 2 0 the license"),
    ("apache-2.0", MENTION, "applicable law", "unless required by applicable law or agreed to in writing"),
    ("gpl", GRANT, "free software", "this (?:program|library|file) is free software you can redistribute it and or modify it under the terms of"),
    ("gpl", MENTION, "general public license", "you should have received a copy of the gnu general public license"),
    ("lgpl", MENTION, "lesser general public license", "(?:gnu )?lesser general public license"),
    ("agpl", MENTION, "affero", "affero general public license"),
    ("gfdl", GRANT, "free documentation", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gfdl", MENTION, "free documentation", "(?:gnu )?free documentation license"),
    ("mpl-2.0", GRANT, "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl", MENTION, "mozilla", "mozilla public license"),
    ("epl", MENTION, "eclipse", "eclipse public license"),
    ("apache", MENTION, "apache", "apache (?:software )?license"),
    ("artistic", MENTION, "artistic license", "artistic license"),
    ("unlicense", GRANT, "public domain", "this is free and unencumbered software released into the public domain"),
    ("zlib", GRANT, "permission is granted to anyone", "permission is granted to anyone to use this software for any purpose including commercial applications"),
    ("bsl-1.0", GRANT, "boost", "distributed under the boost software license"),
    ("cc-by", MENTION, "creative commons", "creative commons attribution(?: license)?"),
    ("cc-by-sa", MENTION, "cc by sa", "cc by sa"),
    ("cc-by-sa", MENTION, "creative commons", "creative commons attribution share ?alike"),
    ("cc-by-nc", MENTION, "cc by nc", "cc by nc"),
    ("cc-by-nc", MENTION, "creative commons", "creative commons attribution non ?commercial"),
    ("cc-by-nd", MENTION, "cc by nd", "cc by nd"),
    ("cc-by-nc-sa", MENTION, "cc by nc sa", "cc by nc sa"),
    ("cc-by-nc-nd", MENTION, "cc by nc nd", "cc by nc nd"),
    ("creative-commons", MENTION, "creative commons", "creative commons(?: licen[cs]es?)?"),
    ("public-domain", MENTION, "public domain", "(?:in|into|to) the public domain"),
    ("public-domain", GRANT, "public domain", "(?:hereby )?(?:dedicated|released|placed) (?:in|into|to) the public domain"),
    ("proprietary", GRANT, "proprietary", "proprietary and confidential"),
    ("proprietary", MENTION, "confidential", "confidential (?:information )?(?:of|to) [^ ]+"),
    ("proprietary", MENTION, "proprietary", "proprietary (?:software|license|information)"),
    ("no-reproduction", GRANT, "no part of this", "no part of this (?:publication|book|document|work) may be reproduced"),
    ("no-reproduction", MENTION, "unauthorized|unauthorised", "unauthori[sz]ed (?:reproduction|copying|distribution|use)"),
    ("non-commercial", MENTION, "noncommercial|non commercial", "(?:for )?non ?commercial use only"),
    ("copyright", MENTION, "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?"),
    ("copyright", MENTION, "copyright|copyrights", "(?:all )?copyrights? (?:is |are )?(?:reserved|held|owned)"),
    ("eula", MENTION, "end user", "end user licen[cs]e agreement"),
    ("warranty-disclaimer", MENTION, "warranty|warranties", "without (?:any )?warrant(?:y|ies)(?: of any kind)?"),
    ("dual-licensed", MENTION, "dual licensed|dual licenced", "dual licen[cs]ed"),
)

_GIVEN = r"(?:licen[cs]ed|released|distributed|published|available|provided|shared) (?:[^ ]+ )?under (?:the )?(?:terms of (?:the )?)?(?:gnu )?"
#: What can stand before a name in a phrase of that kind.
_BEFORE = ("under", "under the", "terms of", "of the", "gnu")


def _beginning(identifier: str) -> str | None:
    """The first words of a pattern, two at most, as far as they are plain."""
    words = []
    for word in identifier.split("(")[0].split()[:2]:
        if not word.isalnum():
            break
        words.append(word)
    return " ".join(words) or None


def _compiled() -> tuple[Rule, ...]:
    """Three rules of each license, then the notices, in order of precedence."""
    rules = []
    for label, names, identifier, name in LICENSES:
        keywords, start = tuple(names.split("|")), _beginning(identifier)
        one_word = len(identifier.split()) < 2
        given = tuple(f"{b} {start}" for b in _BEFORE if start)
        rules.append(Rule(label, TAG, 1.0, ("spdx license identifier",), f"spdx license identifier {identifier}"))
        rules.append(Rule(label, GRANT, 0.95, keywords + given, f"{_GIVEN}(?:{name}|{identifier})(?: licen[cs]e)?"))
        keywords += (start,) if start and not one_word else ()
        rules.append(Rule(label, MENTION, 0.7, tuple(dict.fromkeys(keywords)), name if one_word else f"(?:{name}|{identifier})"))
    for label, priority, keyword, regex in NOTICES:
        rules.append(Rule(label, priority, 0.9 if priority == GRANT else 0.6, tuple(keyword.split("|")), regex))
    return tuple(rules)


RULES = _compiled()
