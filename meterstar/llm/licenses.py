"""License scans: ordered signature rules over the words of a text.

Words are runs of ASCII letters and digits (lower-cased) and of everything outside ASCII;
a text becomes its words joined by single spaces. A rule is a regular expression over that
form. It is tried only if its keyword, which every match contains, occurs
in the text. Detections are resolved in order
of priority: one that lies inside the interval of an accepted detection is suppressed, so
"gpl 2 0" inside a full grant for "gpl 2 0 or later" says nothing of its own.
"""

from __future__ import annotations

import bisect
import re
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.llm.common import over_texts

# The words of a text: A-Z become a-z, the other ASCII characters become separators.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)

# Phrases whose places are the base result, with their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# label | priority | keyword | regular expression over the words
# Priorities: 90 grant or condition text, 80 name with version, 70 SPDX tag, 60 name,
# 50 abbreviation with version, 40 abbreviation next to a licensing word, 30 address.
RULES = r"""
mit | 90 | free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 90 | without restriction | deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies
mit | 90 | permission notice | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit-0 | 80 | no attribution | mit no attribution(?: license)?
mit | 80 | expat | expat license
mit | 80 | x11 | (?:mit x11|x11 mit) license
x11 | 60 | x11 | x11 license
mit-modern | 80 | modern variant | mit (?:license )?modern variant
mit | 60 | mit | (?:the )?mit licen[sc]e
mit | 40 | mit | (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?mit
mit | 70 | spdx | spdx license identifier mit
mit | 30 | opensource | opensource org licenses mit
apache-2.0 | 90 | apache | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2.0 | 90 | you may obtain | you may obtain a copy of the license at (?:https? )?www apache org licenses license 2 0
apache-2.0 | 80 | apache | apache (?:software )?license (?:version |v ?)?2(?: 0)?
apache-1.1 | 80 | apache | apache (?:software )?license (?:version |v ?)?1 1
apache-1.0 | 80 | apache | apache (?:software )?license (?:version |v ?)?1 0
apache-2.0 | 70 | spdx | spdx license identifier apache 2 0
apache-2.0 | 50 | apache | apache (?:v ?)?2(?: 0)?
apache | 60 | apache | apache software license
apache-1.1 | 90 | apache | this product includes software developed by the apache (?:software foundation|group)
apache-2.0 | 30 | apache | apache org licenses license 2 0
gpl-3.0-or-later | 90 | general public | gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-2.0-or-later | 90 | general public | gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-1.0-or-later | 90 | general public | gnu general public license as published by the free software foundation either version 1 of the license or at your option any later version
gpl-2.0-only | 90 | free software foundation | gnu general public license (?:version 2 )?as published by the free software foundation version 2
gpl-3.0-only | 90 | free software foundation | gnu general public license (?:version 3 )?as published by the free software foundation version 3
gpl-3.0 | 80 | general public | gnu general public license (?:version |v ?)?3(?: 0)?
gpl-2.0 | 80 | general public | gnu general public license (?:version |v ?)?2(?: 0)?
gpl-1.0 | 80 | general public | gnu general public license (?:version |v ?)?1(?: 0)?
gpl-3.0-or-later | 70 | gpl | spdx license identifier gpl 3 0 (?:or later)
gpl-2.0-or-later | 70 | gpl | spdx license identifier gpl 2 0 (?:or later)
gpl-3.0-only | 70 | gpl | spdx license identifier gpl 3 0(?: only)?
gpl-2.0-only | 70 | gpl | spdx license identifier gpl 2 0(?: only)?
gpl-3.0-or-later | 50 | gpl | gpl ?v?3(?: 0)? or (?:any )?later(?: version)?
gpl-2.0-or-later | 50 | gpl | gpl ?v?2(?: 0)? or (?:any )?later(?: version)?
gpl-3.0 | 50 | gpl | (?:gnu )?gpl ?(?:version |v ?)?3(?: 0)?
gpl-2.0 | 50 | gpl | (?:gnu )?gpl ?(?:version |v ?)?2(?: 0)?
gpl | 60 | general public | (?:gnu )?general public licen[sc]e
gpl | 40 | gpl | (?:gnu gpl|gpl licen[sc]e|under (?:the )?gpl)
gpl | 30 | gnu | gnu org (?:licenses|copyleft) gpl
gpl-2.0-with-classpath-exception | 80 | classpath | (?:gpl|general public license)(?: \S+){0,6} with (?:the )?classpath exception
gpl-with-linking-exception | 80 | linking | (?:gpl|general public license)(?: \S+){0,6} with (?:the )?linking exception
gpl-with-bison-exception | 80 | bison | bison exception
gpl-with-autoconf-exception | 80 | autoconf | autoconf exception
gpl-with-font-exception | 80 | font exception | (?:gpl|general public license)(?: \S+){0,6} font exception
gcc-exception-3.1 | 80 | runtime library | gcc runtime library exception(?: version 3 1)?
agpl-3.0-or-later | 90 | affero | gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
agpl-3.0 | 80 | affero | (?:gnu )?affero general public license (?:version |v ?)?3(?: 0)?
agpl-1.0 | 80 | affero | affero general public license (?:version |v ?)?1(?: 0)?
agpl | 60 | affero | (?:gnu )?affero general public licen[sc]e
agpl-3.0 | 70 | agpl | spdx license identifier agpl 3 0(?: only| or later)?
agpl-3.0 | 50 | agpl | agpl ?(?:version |v ?)?3(?: 0)?
agpl | 40 | agpl | (?:gnu agpl|agpl licen[sc]e|under (?:the )?agpl)
lgpl-2.1-or-later | 90 | lesser | gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
lgpl-3.0-or-later | 90 | lesser | gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
lgpl-2.0-or-later | 90 | library general | gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version
lgpl-2.1 | 80 | lesser | (?:gnu )?lesser general public license (?:version |v ?)?2 1
lgpl-3.0 | 80 | lesser | (?:gnu )?lesser general public license (?:version |v ?)?3(?: 0)?
lgpl-2.0 | 80 | library general | (?:gnu )?library general public license (?:version |v ?)?2(?: 0)?
lgpl | 60 | lesser | (?:gnu )?lesser general public licen[sc]e
lgpl | 60 | library general | (?:gnu )?library general public licen[sc]e
lgpl-2.1 | 70 | lgpl | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-3.0 | 70 | lgpl | spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-2.1 | 50 | lgpl | lgpl ?(?:version |v ?)?2 1
lgpl-3.0 | 50 | lgpl | lgpl ?(?:version |v ?)?3(?: 0)?
lgpl | 40 | lgpl | (?:gnu lgpl|lgpl licen[sc]e|under (?:the )?lgpl)
gfdl-1.3 | 80 | free documentation | (?:gnu )?free documentation license (?:version |v ?)?1 3
gfdl-1.2 | 80 | free documentation | (?:gnu )?free documentation license (?:version |v ?)?1 2
gfdl-1.1 | 80 | free documentation | (?:gnu )?free documentation license (?:version |v ?)?1 1
gfdl | 60 | free documentation | (?:gnu )?free documentation licen[sc]e
gfdl | 50 | gfdl | gfdl(?: 1 [123])?
gfdl | 90 | invariant sections | with no invariant sections no front cover texts and no back cover texts
bsd-3-clause | 90 | endorse or promote | neither the name of(?: \S+){1,12} nor the names of (?:its|the|any) contributors may be used to endorse or promote products derived from this software
bsd-2-clause | 90 | source and binary | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-4-clause | 90 | advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-disclaimer | 90 | as is | this software is provided by the(?: \S+){1,8} as is and any express or implied warranties
bsd-3-clause | 80 | bsd | (?:3 clause|three clause|new|modified|revised) bsd licen[sc]e
bsd-2-clause | 80 | bsd | (?:2 clause|two clause|simplified|freebsd) bsd licen[sc]e
bsd-4-clause | 80 | bsd | (?:4 clause|four clause|original|old) bsd licen[sc]e
0bsd | 80 | bsd | (?:zero clause|0 clause) bsd licen[sc]e
bsd-1-clause | 80 | bsd | (?:1 clause|one clause) bsd licen[sc]e
bsd-3-clause | 70 | bsd | (?:spdx license identifier )?bsd 3 clause
bsd-2-clause | 70 | bsd | (?:spdx license identifier )?bsd 2 clause
bsd-4-clause | 70 | bsd | (?:spdx license identifier )?bsd 4 clause
0bsd | 70 | 0bsd | (?:spdx license identifier )?0bsd
bsd-2-clause-patent | 80 | bsd | bsd (?:2 clause )?(?:plus )?patent licen[sc]e
bsd-3-clause-clear | 80 | clear | (?:the )?clear bsd licen[sc]e
bsd | 60 | bsd | bsd (?:style )?licen[sc]e
bsd | 40 | bsd | (?:licensed|released|distributed) under (?:the )?(?:terms of the )?bsd
mpl-2.0 | 90 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | 90 | mozilla | the contents of this file are subject to the mozilla public license version 1 1
mpl-2.0 | 80 | mozilla | mozilla public license (?:version |v ?)?2(?: 0)?
mpl-1.1 | 80 | mozilla | mozilla public license (?:version |v ?)?1 1
mpl-1.0 | 80 | mozilla | mozilla public license (?:version |v ?)?1 0
mpl | 60 | mozilla | mozilla public licen[sc]e
mpl-2.0 | 50 | mpl | mpl ?(?:v ?)?2(?: 0)?
mpl-1.1 | 50 | mpl | mpl ?(?:v ?)?1 1
mpl-2.0-no-copyleft-exception | 90 | incompatible | incompatible with secondary licenses as defined by the mozilla public license
epl-2.0 | 80 | eclipse | eclipse public license (?:version |v ?)?2(?: 0)?
epl-1.0 | 80 | eclipse | eclipse public license (?:version |v ?)?1(?: 0)?
epl | 60 | eclipse | eclipse public licen[sc]e
epl-2.0 | 50 | epl | epl ?(?:v ?)?2(?: 0)?
epl-1.0 | 50 | epl | epl ?(?:v ?)?1(?: 0)?
edl-1.0 | 60 | eclipse | eclipse distribution license(?: version 1 0| v ?1 0)?
cpl-1.0 | 60 | common public | common public license(?: version 1 0| v ?1 0)?
ipl-1.0 | 60 | ibm | ibm public license(?: version 1 0| v ?1 0)?
cpal-1.0 | 60 | common public attribution | common public attribution license(?: version 1 0)?
cddl-1.1 | 80 | common development | common development and distribution license (?:version |v ?)?1 1
cddl-1.0 | 80 | common development | common development and distribution license (?:version |v ?)?1 0
cddl | 60 | common development | common development and distribution licen[sc]e
cddl | 50 | cddl | cddl(?: 1 [01])?
eupl-1.2 | 80 | european union public | european union public licen[sc]e (?:version |v ?)?1 2
eupl-1.1 | 80 | european union public | european union public licen[sc]e (?:version |v ?)?1 1
eupl | 60 | european union public | european union public licen[sc]e
eupl | 50 | eupl | eupl(?: v ?)?(?: 1 [012])?
cc0-1.0 | 80 | cc0 | cc0 (?:1 0|universal|public domain)(?: universal)?
cc0-1.0 | 50 | cc0 | (?:licensed|released|available) under cc0
cc0-1.0 | 60 | creative commons | creative commons (?:zero|cc0)(?: 1 0)?(?: universal)?
cc0-1.0 | 90 | this deed | the person who associated a work with this deed has dedicated the work to the public domain
cc-by-nc-nd-4.0 | 80 | cc by | cc by nc nd 4 0
cc-by-nc-nd-3.0 | 80 | cc by | cc by nc nd 3 0
cc-by-nc-sa-4.0 | 80 | cc by | cc by nc sa 4 0
cc-by-nc-sa-3.0 | 80 | cc by | cc by nc sa 3 0
cc-by-nc-4.0 | 80 | cc by | cc by nc 4 0
cc-by-nc-3.0 | 80 | cc by | cc by nc 3 0
cc-by-nd-4.0 | 80 | cc by | cc by nd 4 0
cc-by-nd-3.0 | 80 | cc by | cc by nd 3 0
cc-by-sa-4.0 | 80 | cc by | cc by sa 4 0
cc-by-sa-3.0 | 80 | cc by | cc by sa 3 0
cc-by-sa-2.5 | 80 | cc by | cc by sa 2 5
cc-by-sa-2.0 | 80 | cc by | cc by sa 2 0
cc-by-4.0 | 70 | cc by | cc by 4 0
cc-by-3.0 | 70 | cc by | cc by 3 0
cc-by-2.5 | 70 | cc by | cc by 2 5
cc-by-2.0 | 70 | cc by | cc by 2 0
cc-by-nc-nd | 60 | cc by | cc by nc nd
cc-by-nc-sa | 60 | cc by | cc by nc sa
cc-by-nc | 50 | cc by | cc by nc
cc-by-nd | 50 | cc by | cc by nd
cc-by-sa | 50 | cc by | cc by sa
cc-by | 40 | cc by | cc by
cc-by-nc-nd | 80 | commercial | attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [234] [05])?(?: international| unported| generic)?
cc-by-nc-sa | 80 | commercial | attribution non ?commercial share ?alike(?: [234] [05])?(?: international| unported| generic)?
cc-by-nc | 60 | commercial | attribution non ?commercial(?: [234] [05])?(?: international| unported| generic)?
cc-by-sa | 60 | share | attribution share ?alike(?: [234] [05])?(?: international| unported| generic)?
cc-by-nd | 60 | attribution | attribution no ?deriv(?:ative)?s?(?: works)?(?: [234] [05])?(?: international| unported| generic)?
cc-by-4.0 | 80 | creative commons | creative commons attribution 4 0(?: international)?(?: licen[sc]e)?
cc-by-3.0 | 80 | creative commons | creative commons attribution 3 0(?: unported)?(?: licen[sc]e)?
cc-by-2.0 | 80 | creative commons | creative commons attribution 2 0(?: generic)?(?: licen[sc]e)?
cc-by | 60 | creative commons | creative commons attribution(?: licen[sc]e)?
cc-by-sa | 80 | creative commons | creative commons attribution share ?alike(?: [234] [05])?(?: licen[sc]e)?
cc-by | 30 | creativecommons | creativecommons org licenses by(?: [234] [05])?
cc-by-sa | 30 | creativecommons | creativecommons org licenses by sa(?: [234] [05])?
cc-by-nc | 30 | creativecommons | creativecommons org licenses by nc(?: [234] [05])?
cc-by-nd | 30 | creativecommons | creativecommons org licenses by nd(?: [234] [05])?
cc-by-nc-sa | 40 | creativecommons | creativecommons org licenses by nc sa(?: [234] [05])?
cc-by-nc-nd | 40 | creativecommons | creativecommons org licenses by nc nd(?: [234] [05])?
cc0-1.0 | 30 | creativecommons | creativecommons org publicdomain zero 1 0
cc-pd | 60 | creative commons | creative commons public domain (?:mark|dedication)(?: 1 0)?
cc | 40 | creative commons | (?:under a|under the) creative commons licen[sc]e
unlicense | 90 | unencumbered | this is free and unencumbered software released into the public domain
unlicense | 60 | unlicense | (?:the )?unlicense
public-domain | 60 | public domain | (?:placed|released|dedicated|is) (?:in|into|to) the public domain
wtfpl | 60 | what the | do what the f\S+ you want to public licen[sc]e
wtfpl | 50 | wtfpl | wtfpl
isc | 90 | with or without fee | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | 60 | isc | (?:the )?isc licen[sc]e
isc | 70 | isc | spdx license identifier isc
zlib | 90 | altered source | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib | 60 | zlib | zlib(?: libpng)? licen[sc]e
libpng | 60 | libpng | libpng licen[sc]e(?: version 2)?
bsl-1.0 | 60 | boost | boost software license(?: version 1 0| v ?1 0)?
bsl-1.0 | 90 | accompanying documentation | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
bsl-1.0 | 70 | bsl | spdx license identifier bsl 1 0
busl-1.1 | 60 | business source | business source license(?: version 1 1| 1 1)?
sspl-1.0 | 60 | server side public | server side public license(?: version 1| v ?1)?
elastic-2.0 | 60 | elastic | elastic license (?:version |v ?)?2(?: 0)?
artistic-2.0 | 80 | artistic | artistic license (?:version |v ?)?2(?: 0)?
artistic-1.0 | 80 | artistic | artistic license (?:version |v ?)?1(?: 0)?
artistic | 60 | artistic | (?:perl |clarified )?artistic licen[sc]e
perl | 60 | perl | (?:under )?the same terms as perl itself
afl-3.0 | 80 | academic free | academic free license (?:version |v ?)?3(?: 0)?
afl-2.1 | 80 | academic free | academic free license (?:version |v ?)?2 1
afl | 60 | academic free | academic free licen[sc]e
osl-3.0 | 80 | open software | open software license (?:version |v ?)?3(?: 0)?
osl | 60 | open software | open software licen[sc]e
ofl-1.1 | 80 | open font | (?:sil )?open font license (?:version |v ?)?1 1
ofl | 60 | open font | (?:sil )?open font licen[sc]e
psf-2.0 | 60 | python software | python software foundation license(?: version 2)?
python-2.0 | 60 | python | python license(?: 2 0)?
php-3.01 | 80 | php | php license (?:version |v ?)?3 01
php | 60 | php | php licen[sc]e
ruby | 60 | ruby | ruby(?: s)? licen[sc]e
vim | 60 | vim | vim licen[sc]e
postgresql | 60 | postgresql | postgresql licen[sc]e
openssl | 60 | openssl | openssl (?:ssleay )?licen[sc]e
openssl | 90 | openssl | this product includes software developed by the openssl project
curl | 60 | curl | curl licen[sc]e
ncsa | 60 | ncsa | (?:university of illinois )?ncsa (?:open source )?licen[sc]e
unicode | 60 | unicode | unicode(?: inc)? license(?: agreement)?
w3c | 60 | w3c | w3c (?:software )?(?:notice and )?licen[sc]e
beerware | 90 | beer | if we meet some day and you think this stuff is worth it you can buy me a beer
beerware | 60 | beer | beer ?ware licen[sc]e
json | 90 | good not evil | the software shall be used for good not evil
json | 60 | json | json licen[sc]e
upl-1.0 | 60 | universal permissive | universal permissive license(?: version 1 0| v ?1 0)?
ms-pl | 60 | microsoft | microsoft public licen[sc]e
ms-rl | 60 | microsoft | microsoft reciprocal licen[sc]e
apsl-2.0 | 60 | apple | apple public source license(?: version 2 0)?
npl-1.1 | 60 | netscape | netscape public license(?: version 1 [01])?
qpl-1.0 | 60 | public license | q public license(?: version 1 0)?
sleepycat | 60 | sleepycat | sleepycat licen[sc]e
zpl-2.1 | 60 | zope | zope public license(?: version 2 [01])?
cecill-2.1 | 60 | cecill | cecill(?: [bc])?(?: version 2 [01]| v ?2 [01])?
mulan-psl-2.0 | 60 | mulan | mulan (?:psl|permissive software license)(?: v ?2| version 2)?
ecl-2.0 | 60 | educational community | educational community license(?: version 2 0)?
lppl-1.3c | 60 | latex | latex project public license(?: version 1 3c?)?
odbl-1.0 | 60 | open database | open database license(?: version 1 0| v ?1 0)?
odc-by-1.0 | 60 | open data commons | open data commons attribution licen[sc]e
pddl-1.0 | 60 | public domain dedication | (?:open data commons )?public domain dedication and licen[sc]e
cdla-permissive | 60 | community data | community data license agreement permissive(?: [12] 0)?
cdla-sharing | 60 | community data | community data license agreement sharing(?: 1 0)?
openrail | 60 | rail | (?:creative ?ml |bigcode )?open ?rail(?: m)?(?: licen[sc]e)?
llama-community | 60 | llama | llama [234] community license(?: agreement)?
ogl-uk-3.0 | 60 | open government | open government licen[sc]e(?: v ?3 0)?
blueoak-1.0.0 | 60 | blue oak | blue oak model license(?: 1 0 0)?
hippocratic | 60 | hippocratic | hippocratic licen[sc]e
parity | 60 | parity | parity public licen[sc]e
prosperity | 60 | prosperity | prosperity public licen[sc]e
polyform | 60 | polyform | polyform (?:noncommercial|small business|shield|strict) license(?: 1 0 0)?
commons-clause | 60 | commons clause | commons clause(?: license condition)?
proprietary | 60 | proprietary | proprietary (?:and confidential|licen[sc]e)
all-rights-reserved | 50 | all rights reserved | all rights reserved
copyright | 30 | copyright | copyright (?:c )?(?:19|20)\d\d
""".strip().splitlines()


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    pattern: re.Pattern


@cache
def rules() -> dict[bytes, list[Rule]]:
    """The rules by keyword, in the order of the table."""
    by_keyword: dict[bytes, list[Rule]] = {}
    for line in RULES:
        label, priority, keyword, pattern = (x.strip() for x in line.split(" | ", 3))
        rule = Rule(label, int(priority), re.compile(f"(?<= )(?:{pattern})(?= )".encode()))
        by_keyword.setdefault(keyword.encode(), []).append(rule)
    return by_keyword


def canonical(text: str) -> tuple[bytes, int]:
    """The words joined by spaces, a space on either side, and their number."""
    words = text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()
    return b" " + b" ".join(words) + b" ", len(words)


def _word_numbers(body: bytes, places: list[int]) -> list[int]:
    """The numbers of the words that start at ascending places."""
    numbers, at, n = [], 0, -1
    for place in places:
        n += body.count(b" ", at, place)
        at = place
        numbers.append(n)
    return numbers


def phrase_places(body: bytes) -> dict[str, list[int]]:
    """Label to the word numbers at which its phrase starts."""
    found = {}
    for phrase, label in PHRASES.items():
        wanted, places = f" {phrase} ".encode(), []
        at = body.find(wanted)
        while at >= 0:
            places.append(at + 1)
            at = body.find(wanted, at + 1)
        if places:
            found[label] = _word_numbers(body, places)
    return found


def detections(body: bytes) -> list[tuple[int, int, str, int]]:
    """(first word, word after the last, label, priority), containment resolved."""
    raw = [
        (-rule.priority, m.start() - m.end(), m.start(), m.end(), rule.label)
        for keyword, group in rules().items()
        if keyword in body
        for rule in group
        for m in rule.pattern.finditer(body)
    ]
    # Strongest first, then longest: whatever contains a detection was accepted before it.
    raw.sort()
    kept: list[tuple[int, int, str, int]] = []
    by_strength: dict[tuple[int, int], list[tuple[int, int, str]]] = {}
    for priority, length, start, end, label in raw:
        by_strength.setdefault((priority, length), []).append((start, end, label))
    cover = _Cover()
    for (priority, _), group in by_strength.items():
        fresh = [(s, e, label) for s, e, label in group if not cover.contains(s, e)]
        # Equal intervals of equal strength suppress nothing among each other.
        kept += [(s, e, label, -priority) for s, e, label in fresh]
        cover.add([(s, e) for s, e, _ in fresh])
    kept.sort()
    starts = _word_numbers(body, [s for s, *_ in kept])
    return [
        (n, n + 1 + body.count(b" ", s, e), label, priority)
        for n, (s, e, label, priority) in zip(starts, kept)
    ]


class _Cover:
    """Intervals, none inside another, by start; ends then ascend as well."""

    def __init__(self) -> None:
        self.intervals: list[tuple[int, int]] = []

    def contains(self, start: int, end: int) -> bool:
        i = bisect.bisect_right(self.intervals, (start, float("inf"))) - 1
        return i >= 0 and self.intervals[i][1] >= end

    def add(self, new: list[tuple[int, int]]) -> None:
        merged: list[tuple[int, int]] = []
        for start, end in sorted({*self.intervals, *new}, key=lambda x: (x[0], -x[1])):
            if not merged or end > merged[-1][1]:
                merged.append((start, end))
        self.intervals = merged


DETECTION = pa.struct(
    [("first_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()),
     ("priority", pa.int32())]
)


def scan_licenses(docs: DataFrame, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """License notes of every whole text, one row per row of `docs`.

    `phrases` are the places of the base phrases (label and word number), `detections` what
    the rules left after suppression. Null and empty texts have no words. Ids may be null or
    repeat; other columns are not looked at.
    """

    def make():
        def scan(batch: pa.RecordBatch) -> dict:
            words, phrases, found = [], [], []
            for text in batch.column(1).to_pylist():
                body, n = canonical(text or "")
                words.append(n)
                phrases.append([
                    {"label": label, "word": w}
                    for label, places in phrase_places(body).items() for w in places
                ])
                found.append([
                    {"first_word": a, "end_word": b, "label": label, "priority": p}
                    for a, b, label, p in detections(body)
                ])
            place = pa.struct([("label", pa.string()), ("word", pa.int64())])
            return {"id": batch.column(0), "n_words": pa.array(words, pa.int64()),
                    "phrases": pa.array(phrases, pa.list_(place)),
                    "detections": pa.array(found, pa.list_(DETECTION))}

        return scan

    kind = docs.schema[id_column].dataType.simpleString()
    plain = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return over_texts(
        plain, "text",
        f"id: {kind}, n_words: long, phrases: array<struct<label: string, word: long>>, "
        "detections: array<struct<first_word: long, end_word: long, label: string, priority: int>>",
        make,
    ).withColumnRenamed("id", id_column)


def digest(scanned: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts and labels; the score is the strongest detection's priority, of 100."""
    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    words = F.col("phrases.word")
    base, own = F.col("phrases.label"), F.col("detections.label")
    strongest = F.coalesce(F.array_max("detections.priority"), F.lit(0)) / 100.0
    return scanned.select(
        id_column,
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, own)).alias("labels"),
        strongest.alias("score"),
    )
