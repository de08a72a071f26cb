"""Licence scans by sentence rules.

A text is cut into sentences: a known licence sentence goes over wrapped lines, comment marks, ';' and ':'
to its end, other text is cut at those.  Each sentence is normalised and looked up among known licence sentences; what
is found forms a sequence of sentence identifiers.  Ordered rules are then matched against
the sequence: the first rule that matches claims the identifiers it needs, and the scan goes on with
the rest, so one text can carry several licences.  Texts with licence words but no rule are
reported as unknown.

Sentences are found by built-in expressions; sequences are matched in Arrow batches, each rule by one walk
over the places of its identifiers, so in time in proportion to the sequence.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import map_batches

_V = "( v| version)? ?"
_L = "licen[sc]e"
# Licences and how a normalised sentence names them, as in "distributed under the terms of the ...".
NAMED: tuple[tuple[str, str], ...] = (
    ("MPL-2.0", f"(mozilla public {_L}|mpl){_V}2 0"),
    ("MPL-1.1", f"(mozilla public {_L}|mpl){_V}1 1"),
    ("EPL-2.0", f"(eclipse public {_L}|epl){_V}2 0"),
    ("EPL-1.0", f"(eclipse public {_L}|epl){_V}1 0"),
    ("CDDL-1.0", f"(common development and distribution {_L}|cddl)( cddl)?{_V}1 0"),
    ("CDDL-1.1", f"(common development and distribution {_L}|cddl)( cddl)?{_V}1 1"),
    ("Artistic-2.0", f"artistic {_L}{_V}2 0"),
    ("Artistic-1.0", f"artistic {_L}{_V}1 0"),
    ("PSF-2.0", f"(python software foundation|psf) {_L}( agreement)?({_V}2)?"),
    ("OpenSSL", f"openssl {_L}"),
    ("WTFPL", f"(do what the fuck you want to public {_L}|wtfpl)({_V}2)?"),
    ("GFDL-1.3-only", f"gnu free documentation {_L}{_V}1 3"),
    ("GFDL-1.2-only", f"gnu free documentation {_L}{_V}1 2"),
    ("MS-PL", f"microsoft public {_L}( ms pl)?"),
    ("MS-RL", f"microsoft reciprocal {_L}( ms rl)?"),
    ("EUPL-1.2", f"(european union public {_L}|eupl){_V}1 2"),
    ("EUPL-1.1", f"(european union public {_L}|eupl){_V}1 1"),
    ("BUSL-1.1", f"business source {_L}{_V}1 1"),
    ("SSPL-1.0", f"(server side public {_L}|sspl){_V}1( 0)?"),
    ("Elastic-2.0", f"elastic {_L}{_V}2 0"),
    ("PostgreSQL", f"postgresql {_L}"),
    ("NCSA", f"(university of illinois )?ncsa open source {_L}"),
    ("UPL-1.0", f"universal permissive {_L}{_V}1 0"),
    ("AFL-3.0", f"academic free {_L}{_V}3 0"),
    ("OSL-3.0", f"open software {_L}{_V}3 0"),
    ("QPL-1.0", f"q public {_L}{_V}1 0"),
    ("CPL-1.0", f"common public {_L}{_V}1 0"),
    ("IPL-1.0", f"ibm public {_L}{_V}1 0"),
    ("APSL-2.0", f"apple public source {_L}{_V}2( 0)?"),
    ("LPPL-1.3c", f"latex project public {_L}{_V}1 3c"),
    ("OFL-1.1", f"sil open font {_L}{_V}1 1"),
    ("ODbL-1.0", f"open (data commons open )?database {_L}({_V}1 0)?"),
    ("MulanPSL-2.0", f"mulan (psl|permissive software {_L}){_V}2( 0)?"),
    ("Zlib", f"zlib {_L}"),
    ("Unlicense", "unlicen[sc]e"),
    ("0BSD", f"(bsd zero clause|zero clause bsd|0bsd) {_L}"),
    ("BSD-4-Clause", f"(bsd 4 clause|4 clause bsd|original bsd) {_L}"),
    ("X11", f"x11 {_L}"),
    ("MIT-0", f"mit no attribution {_L}"),
    ("JSON", f"json {_L}"),
    ("Beerware", f"beer ?ware {_L}"),
    ("Vim", f"vim {_L}"),
    ("Ruby", f"ruby {_L}"),
    ("curl", f"curl {_L}"),
    ("libpng-2.0", f"(png reference library|libpng) {_L}({_V}2)?"),
    ("CC-BY-NC-SA-4.0", f"(cc|creative commons) (by nc sa|attribution non ?commercial share ?alike) 4 0( international)?( public)?( {_L})?"),
    ("CC-BY-NC-ND-4.0", f"(cc|creative commons) (by nc nd|attribution non ?commercial no ?deriv(ative)?s) 4 0( international)?( public)?( {_L})?"),
    ("CC-BY-NC-4.0", f"creative commons attribution non ?commercial 4 0( international)?( public)?( {_L})?"),
    ("CC-BY-ND-4.0", f"(cc|creative commons) (by nd|attribution no ?deriv(ative)?s) 4 0( international)?( public)?( {_L})?"),
    ("CC-BY-SA-4.0", f"creative commons attribution share ?alike 4 0( international)?( public)?( {_L})?"),
    ("CC-BY-4.0", f"creative commons attribution 4 0( international)?( public)?( {_L})?"),
    ("CC-BY-SA-3.0", f"(cc|creative commons) (by sa|attribution share ?alike) 3 0( unported)?( {_L})?"),
    ("CC-BY-3.0", f"(cc|creative commons) (by|attribution) 3 0( unported)?( {_L})?"),
)
_UNDER = "^((this|the) (work|text|document|software|program|project|code|file|library|package) is )?(released|licensed|distributed|available|made available|provided) under (a |an |the )?(terms of )?(a |an |the )?"
# Licences whose whole text is known by a sentence at its beginning, and exceptions by theirs.
TEXTS: tuple[tuple[str, str], ...] = (
    ("GPL-3.0-only", "gnu general public license version 3 29 june 2007"),
    ("GPL-2.0-only", "gnu general public license version 2 june 1991"),
    ("LGPL-3.0-only", "gnu lesser general public license version 3 29 june 2007"),
    ("LGPL-2.1-only", "gnu lesser general public license version 2 1 february 1999"),
    ("AGPL-3.0-only", "gnu affero general public license version 3 19 november 2007"),
    ("Apache-2.0", "apache license version 2 0 january 2004"),
    ("MPL-2.0", "mozilla public license version 2 0 1 definitions"),
    ("EPL-2.0", "eclipse public license v 2 0 the accompanying program is provided"),
    ("EPL-1.0", "eclipse public license v 1 0 the accompanying program is provided"),
    ("CC-BY-NC-SA-4.0", "attribution noncommercial sharealike 4 0 international (public license )?by exercising the licensed rights"),
    ("CC-BY-NC-ND-4.0", "attribution noncommercial noderivatives 4 0 international (public license )?by exercising the licensed rights"),
    ("CC-BY-NC-4.0", "attribution noncommercial 4 0 international (public license )?by exercising the licensed rights"),
    ("CC-BY-ND-4.0", "attribution noderivatives 4 0 international (public license )?by exercising the licensed rights"),
    ("CC-BY-SA-4.0", "attribution sharealike 4 0 international (public license )?by exercising the licensed rights"),
    ("CC-BY-4.0", "attribution 4 0 international (public license )?by exercising the licensed rights"),
    ("CC0-1.0", "the laws of most jurisdictions throughout the world automatically confer exclusive copyright and related rights"),
    ("Artistic-2.0", "this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("PSF-2.0", "this license agreement is between the python software foundation"),
    ("OpenSSL", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("WTFPL", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed"),
    ("CDDL-1.0", "common development and distribution license cddl version 1 0"),
    ("GFDL-1.3-or-later", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3 or any later version"),
    ("GFDL-1.2-or-later", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 2 or any later version"),
    ("OFL-1.1", "this font software is licensed under the sil open font license version 1 1"),
    ("BSL-1.0", "boost software license version 1 0"),
    ("PostgreSQL", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("JSON", "the software shall be used for good not evil"),
    ("Classpath-exception-2.0", "as a special exception the copyright holders of this library give you permission to link this library with independent modules"),
    ("GCC-exception-3.1", "this gcc runtime library exception exception is an additional permission"),
    ("LLVM-exception", "llvm exceptions to the apache 2 0 license"),
    ("Bison-exception-2.2", "as a special exception you may create a larger work that contains part or all of the bison parser skeleton"),
    ("Font-exception-2.0", "as a special exception if you create a document which uses this font"),
)
# Pattern of a normalised sentence -> its identifier; the first that matches names it.
SENTENCES: tuple[tuple[str, str], ...] = (
    *((f"^{text}", f"{name}:text") for name, text in TEXTS),
    (r"^(released|licensed|distributed|available) under the (terms of the )?mit licen[sc]e$", "MITref"),
    (r"^permission is hereby granted free of charge to any person obtaining a copy of this software", "MITgrant"),
    (r"^the above copyright notice and this permission notice shall be included in all copies", "MITcond"),
    (r"^the software is provided as is without warranty of any kind", "MITwarr"),
    (r"^(released|licensed|distributed) under the (terms of the )?apache licen[sc]e,? ?(version )?2( 0)?( the license)?$", "Apache2ref"),
    (r"^you may obtain a copy of the license at https? www apache org licenses license 2 0$", "Apache2link"),
    (r"^unless required by applicable law or agreed to in writing software distributed under the license", "Apache2warr"),
    (r"^this work is licensed under the gnu general public licen[sc]e,? ?version 3$", "GPL3ref"),
    (r"^this (program|work|file|library) is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e", "GPLgrant"),
    (r"^this (program|work|file|library) is free software you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public licen[sc]e", "LGPLgrant"),
    (r"^this (program|work|file|library) is free software you can redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e", "AGPLgrant"),
    (r"(either )?version 2 1 of the license or( at your option)? any later version$", "GPL21plus"),
    (r"(either )?version 3 of the license or( at your option)? any later version$", "GPL3plus"),
    (r"(either )?version 2 of the license or( at your option)? any later version$", "GPL2plus"),
    (r"^this (program|work|file|library) is distributed in the hope that it will be useful but without any warranty", "GPLwarr"),
    (r"^(this (work|text|document) is )?licensed under (a )?(cc|creative commons) by nc 4 0( international)?( licen[sc]e)?$", "CCBYNC4ref"),
    (r"^(this (work|text|document) is )?licensed under (a )?(cc|creative commons) by sa 4 0( international)?( licen[sc]e)?$", "CCBYSA4ref"),
    (r"^(this (work|text|document) is )?licensed under (a )?(cc|creative commons) by 4 0( international)?( licen[sc]e)?$", "CCBY4ref"),
    (r"^redistribution and use in source and binary forms with or without modification are permitted", "BSDgrant"),
    (r"^redistributions of source code must retain the above copyright notice", "BSDsource"),
    (r"^redistributions in binary form must reproduce the above copyright notice", "BSDbinary"),
    (r"^neither the name of .* may be used to endorse or promote products", "BSDendorse"),
    (r"^this software is provided by the copyright holders and contributors as is and any express or implied warranties", "BSDwarr"),
    (r"^this source code form is subject to the terms of the mozilla public license v 2 0$", "MPL2ref"),
    (r"^permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that", "ISCgrant"),
    (r"^permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted$", "ZEROBSDgrant"),
    (r"^the software is provided as is and the author disclaims all warranties", "ISCwarr"),
    (r"^this software is provided as is without any express or implied warranty", "ZLIBwarr"),
    (r"^permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely", "ZLIBgrant"),
    (r"^the origin of this software must not be misrepresented", "ZLIBorigin"),
    (r"^altered source versions must be plainly marked as such", "ZLIBaltered"),
    (r"^this notice may not be removed or altered from any source distribution", "ZLIBnotice"),
    (r"^this is free and unencumbered software released into the public domain", "UNLrelease"),
    (r"^anyone is free to copy modify publish use compile sell or distribute this software", "UNLfree"),
    (r"^to the extent possible under law .* (waived|dedicated) all copyright and related", "CC0waiver"),
    (r"^(this (work|text|document) is )?(licensed|released) under (the )?(cc0|creative commons zero)( 1 0)?( universal)?( licen[sc]e)?$", "CC0ref"),
    (r"^this program and the accompanying materials are made available under the terms of the eclipse public license( v| version)? 2 0", "EPL2ref"),
    (r"^this program and the accompanying materials are made available under the terms of the eclipse public license( v| version)? 1 0", "EPL1ref"),
    (r"^distributed under the boost software license,? ?version 1 0", "BSL1ref"),
    (r"^permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "BSL1grant"),
    (r"^(released|licensed|distributed) under the (terms of the )?gnu lesser general public licen[sc]e,? ?version 3$", "LGPL3ref"),
    (r"^(released|licensed|distributed) under the (terms of the )?gnu affero general public licen[sc]e,? ?version 3$", "AGPL3ref"),
    (r"^(released|licensed|distributed) under the (terms of the )?gnu general public licen[sc]e,? ?version 2$", "GPL2ref"),
    (r"^(released|licensed|distributed) under the (terms of the )?isc licen[sc]e$", "ISCref"),
    (r"^(released|licensed|distributed) under the (terms of the )?(bsd 3 clause|3 clause bsd|new bsd|modified bsd) licen[sc]e$", "BSD3ref"),
    (r"^(released|licensed|distributed) under the (terms of the )?(bsd 2 clause|2 clause bsd|simplified bsd) licen[sc]e$", "BSD2ref"),
    (r"^all rights reserved$", "AllRights"),
    *((f"{_UNDER}{pattern}$", f"{name}:name") for name, pattern in NAMED),
)
#: A sentence with one of these that no pattern names becomes UNKNOWN.
LICENCE_WORDS = r"\b(licen[sc]ed?|copyright(ed)?|redistribut\w+|warrant(y|ies)|spdx)\b"
# Ordered rules; identifiers in order, other ones may stand between.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    # a whole text ends with the notice that programs are to carry: it is the text's own and grants no later version
    ("GPL-3.0-only", ("GPL-3.0-only:text", "GPLgrant", "GPL3plus", "GPLwarr")),
    ("GPL-2.0-only", ("GPL-2.0-only:text", "GPLgrant", "GPL2plus", "GPLwarr")),
    ("LGPL-2.1-only", ("LGPL-2.1-only:text", "LGPLgrant", "GPL21plus", "GPLwarr")),
    ("AGPL-3.0-only", ("AGPL-3.0-only:text", "AGPLgrant", "GPL3plus", "GPLwarr")),
    ("CC0-1.0", ("CC0-1.0:text", "CC0waiver")),
    *((name, (f"{name}:text",)) for name, _ in TEXTS),
    ("GPL-3.0-or-later", ("GPLgrant", "GPL3plus", "GPLwarr")),
    ("GPL-3.0-or-later", ("GPLgrant", "GPL3plus")),
    ("GPL-2.0-or-later", ("GPLgrant", "GPL2plus", "GPLwarr")),
    ("GPL-2.0-or-later", ("GPLgrant", "GPL2plus")),
    ("LGPL-3.0-or-later", ("LGPLgrant", "GPL3plus", "GPLwarr")),
    ("LGPL-3.0-or-later", ("LGPLgrant", "GPL3plus")),
    ("LGPL-2.1-or-later", ("LGPLgrant", "GPL21plus", "GPLwarr")),
    ("LGPL-2.1-or-later", ("LGPLgrant", "GPL21plus")),
    ("LGPL-2.0-or-later", ("LGPLgrant", "GPL2plus", "GPLwarr")),
    ("LGPL-2.0-or-later", ("LGPLgrant", "GPL2plus")),
    ("AGPL-3.0-or-later", ("AGPLgrant", "GPL3plus", "GPLwarr")),
    ("AGPL-3.0-or-later", ("AGPLgrant", "GPL3plus")),
    ("BSD-3-Clause", ("BSDgrant", "BSDsource", "BSDbinary", "BSDendorse", "BSDwarr")),
    ("BSD-3-Clause", ("BSDgrant", "BSDsource", "BSDbinary", "BSDendorse")),
    ("BSD-2-Clause", ("BSDgrant", "BSDsource", "BSDbinary", "BSDwarr")),
    ("BSD-2-Clause", ("BSDgrant", "BSDsource", "BSDbinary")),
    ("Zlib", ("ZLIBwarr", "ZLIBgrant", "ZLIBorigin", "ZLIBaltered", "ZLIBnotice")),
    ("Zlib", ("ZLIBgrant", "ZLIBorigin", "ZLIBaltered", "ZLIBnotice")),
    ("ISC", ("ISCgrant", "ISCwarr")),
    ("ISC", ("ISCgrant",)),
    ("0BSD", ("ZEROBSDgrant", "ISCwarr")),
    ("0BSD", ("ZEROBSDgrant",)),
    ("Unlicense", ("UNLrelease", "UNLfree", "MITwarr")),
    ("Unlicense", ("UNLrelease", "UNLfree")),
    ("Unlicense", ("UNLrelease",)),
    ("BSL-1.0", ("BSL1grant", "MITwarr")),
    ("BSL-1.0", ("BSL1grant",)),
    ("BSL-1.0", ("BSL1ref",)),
    ("MIT", ("MITgrant", "MITcond", "MITwarr")),
    ("MIT", ("MITgrant", "MITcond")),
    ("Apache-2.0", ("Apache2ref", "Apache2link", "Apache2warr")),
    ("Apache-2.0", ("Apache2ref",)),
    ("GPL-3.0-only", ("GPL3ref",)),
    ("MIT", ("MITref",)),
    ("CC-BY-NC-4.0", ("CCBYNC4ref",)),
    ("CC-BY-SA-4.0", ("CCBYSA4ref",)),
    ("CC-BY-4.0", ("CCBY4ref",)),
    ("MPL-2.0", ("MPL2ref",)),
    ("CC0-1.0", ("CC0waiver",)),
    ("CC0-1.0", ("CC0ref",)),
    ("EPL-2.0", ("EPL2ref",)),
    ("EPL-1.0", ("EPL1ref",)),
    ("LGPL-3.0-only", ("LGPL3ref",)),
    ("AGPL-3.0-only", ("AGPL3ref",)),
    ("GPL-2.0-only", ("GPL2ref",)),
    ("ISC", ("ISCref",)),
    ("BSD-3-Clause", ("BSD3ref",)),
    ("BSD-2-Clause", ("BSD2ref",)),
    *((name, (f"{name}:name",)) for name, _ in NAMED),
)
#: Words of known sentences that hold none of LICENCE_WORDS; what has neither is not looked up.
OTHER_WORDS = r"\b(permission|rights|version|neither|software|mozilla|origin|altered|notice|anyone|waived|dedicated|cc0|creative|accompanying|boost|exception|provided|released|available|distributed|unlicen[sc]e)\b"

#: What is no known sentence ends at a line's end, and at ; : ! ? or a full stop before white space.
BREAK = r"\n+|(?<=[.;:!?])\s+"
_GAP, _MARKS = r"(?:[^a-z0-9]++)", r"[^a-z0-9\n]*+"
_ITEM = rf"(?:[a-z0-9]\){_MARKS})?"  # as in (a) or 1)


def _raw(pattern: str) -> str:
    """A pattern of normalised sentences as one of raw text, where anything but letters and digits may part two words."""
    words = pattern.removeprefix("^").removesuffix("$").replace(".*", r"(?s:.{0,400}?)").replace(" ", _GAP)
    return f"(?:{words})"


_WHOLE, _BEGUN = ("|".join(_raw(p) for p, _ in SENTENCES if p.endswith("$") == whole) for whole in (True, False))
# a pattern with $ needs the end of a line or clause, or another known sentence after it
_WHOLE = rf"(?:{_WHOLE})(?={_MARKS}(?:\n|\z)|[^a-z0-9\s]*[.;:!?]\s|\s{_MARKS}(?:{_BEGUN}))"
_KNOWN = f"{_WHOLE}|{_BEGUN}"
# a known sentence ends at a full stop, ! or ?, an empty line, the text's end, or where the next known one begins
_END = rf"(?=(?<=[.!?])\s|\n{_MARKS}\n|\z|(?:\n|(?<=[;:])\s){_MARKS}{_ITEM}(?:{_KNOWN})|(?<=[a-z0-9,;:]){_GAP}(?:either{_GAP})?version{_GAP}(?:2{_GAP}1|[23]){_GAP}of{_GAP}the{_GAP}licen[sc]e)"
_ID = r"\(*[a-z0-9](?:[a-z0-9.:+-]*[a-z0-9+])?\)*"
#: The tag of a short-form identifier and the SPDX expression after it.
SPDX = rf"(?i)spdx-license-identifier:[ \t]*({_ID}(?:[ \t]+(?:and|or|with)[ \t]+{_ID})*)"
#: One sentence: a tag, a known sentence with the marks before it, or what stands up to the next BREAK or tag.
SENTENCE = rf"{SPDX}|{_MARKS}{_ITEM}(?:{_WHOLE}|(?:{_BEGUN})(?s:.*?){_END})|[^\n]+?(?=\n|\z|(?<=[.;:!?])\s|spdx-license-identifier:)"


def normalised(sentence: Column) -> Column:
    """Lower case, letters and digits in words with one blank between; comment marks go."""
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^a-z0-9]+", " "))


def identify(sentence: Column) -> Column:
    """The identifier of a normalised sentence; null if it is no licence sentence."""
    known = F.when(F.lit(False), F.lit(""))
    for pattern, name in SENTENCES:
        known = known.when(sentence.rlike(pattern.replace("^", "^([a-z0-9] )?")), F.lit(name))
    return known.otherwise(F.lit("UNKNOWN"))


def names(sentence: Column) -> Column:
    """The identifiers of one sentence: one of SENTENCES, SPDX- and a licence for each licence of a tag, or UNKNOWN."""
    # exceptions (WITH) name no licence; licences that RULES name are written as there
    parts = F.split(F.regexp_replace(F.regexp_extract(sentence, SPDX, 1), r"(?i)[()]|\s+with\s+\S+", ""), r"(?i)\s+(?:and|or)\s+")
    usual = F.create_map(*[F.lit(x) for name in sorted({n for n, _ in RULES}) for x in (name.lower(), name)])
    tagged = F.transform(parts, lambda x: F.concat(F.lit("SPDX-"), F.coalesce(F.try_element_at(usual, F.lower(x)), x)))
    return F.when(sentence.rlike(SPDX), tagged).otherwise(F.array(identify(normalised(sentence))))


def sequence(text: Column) -> Column:
    """The identifiers of a text's licence sentences, in order."""
    rough = F.filter(F.regexp_extract_all(text, F.lit(SENTENCE), 0), lambda s: F.lower(s).rlike(f"{LICENCE_WORDS}|{OTHER_WORDS}"))
    found = F.transform(rough, lambda s: F.struct(F.lower(s).rlike(LICENCE_WORDS).alias("l"), names(s).alias("i")))
    return F.flatten(F.transform(F.filter(found, lambda x: x["l"] | (x["i"][0] != "UNKNOWN")), lambda x: x["i"]))


def match(ids: list[str], rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES) -> tuple[list[str], int]:
    """(sorted distinct licences of a sequence, UNKNOWN and other identifiers that no rule claimed).

    Rules in order, each as often as it matches: a match takes the first free place of its first identifier, then the
    first free one of the next after that, and so on.  Later matches of a rule begin later, so each rule walks once
    over the places of its identifiers.  Tags (SPDX-) are licences by themselves.
    """
    places: dict[str, list[int]] = {}
    for at, x in enumerate(ids):
        places.setdefault(x, []).append(at)
    found = {x.removeprefix("SPDX-") for x in ids if x.startswith("SPDX-")}
    for name, need in rules:
        if not all(x in places for x in need):
            continue
        walks = [0] * len(need)
        used: list[set[int]] = [set() for _ in need]
        while True:
            last, claim = -1, []
            for k, x in enumerate(need):
                own = places[x]
                while walks[k] < len(own) and own[walks[k]] <= last:
                    walks[k] += 1
                if walks[k] == len(own):
                    break
                last = own[walks[k]]
                claim.append(last)
            if len(claim) < len(need):
                break
            found.add(name)
            for k, at in enumerate(claim):
                walks[k] += 1
                used[k].add(at)
        for k, x in enumerate(need):
            if used[k]:
                places[x] = [at for at in places[x] if at not in used[k]]
        places = {x: p for x, p in places.items() if p}
    return sorted(found), sum(len(p) for x, p in places.items() if not x.startswith("SPDX-"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, sentences (identifiers in order), licenses (sorted, distinct), n_unknown; a row a row of docs.

    A null or empty text has no sentences and no licence; n_unknown counts licence sentences that no rule claimed.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), sequence(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("sentences"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [match(ids) for ids in batch.column(1).to_pylist()]
        licenses, left = pa.array([x for x, _ in found], pa.list_(pa.string())), pa.array([n for _, n in found], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), licenses, left], ["doc_id", "sentences", "licenses", "n_unknown"])

    schema = StructType([d.schema.fields[0], *StructType.fromDDL("sentences array<string>, licenses array<string>, n_unknown bigint").fields])
    return map_batches(d, work, schema)


def op1(docs: DataFrame) -> DataFrame:
    """One row a row of documents, in plain columns: doc_id, license_sentences, licenses (both joined by commas), n_unknown."""
    s = scan(docs)
    return s.select("doc_id", F.array_join("sentences", ",").alias("license_sentences"), F.array_join("licenses", ",").alias("licenses"), "n_unknown")
