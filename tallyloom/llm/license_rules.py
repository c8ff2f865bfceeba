"""License detection with ordered signature rules, in DataFrame functions only.

Each text becomes words joined by single spaces. A keyword prefilter looks for words that some rule needs; only texts
that have one are lower-cased, and only the rules whose keyword stands there are matched, as regular expressions over
the words. Detections inside a detection of higher priority (or of the same priority and longer) are suppressed; the
labels of the rest are the answer. Everything is computed within the row, so the operator has no shuffle and no group
that could grow.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands between words: ASCII without letters and digits.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"

# The phrases that are always reported, with their labels.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

#: In a rule, a version: it becomes part of the label.
VERSION = r"(?: version)? v?(\d(?: \d){0,2})"

# Rules by hand, in falling order of what they say: label, priority, keyword, regular expression over lower-case words.
# The keyword is a word of each match, the rarest one. {V} is a version. Of two rules that match at the same place, the one
# with the higher priority stays; within equal priority the longer match.
RULES = r"""
mit | 90 | obtaining | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?: the software)? to deal in the software without restriction
mit | 88 | obtaining | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 86 | portions | the above copyright notice and this permission notice shall be included in all copies or substantial portions(?: of the software)?
mit | 84 | noninfringement | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
mit-0 | 92 | attribution | mit no attribution(?: licen[cs]e)?
x11 | 87 | consortium | except as contained in this notice the name of the x consortium shall not be used
isc | 90 | disclaims | the software is provided as is and the author disclaims all warranties with regard to this software
isc | 88 | purpose | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
hpnd | 87 | purpose | permission to use copy modify and distribute this software and its documentation for any purpose(?: and)? without fee is hereby granted
0bsd | 91 | purpose | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
bsd | 90 | redistribution | redistribution and use in source and binary forms with or without modification are permitted(?: provided that the following conditions are met)?
bsd | 85 | redistributions | redistributions of source code must retain the above copyright notice(?: this list of conditions and the following disclaimer)?
bsd | 85 | redistributions | redistributions in binary form must reproduce the above copyright notice(?: this list of conditions and the following disclaimer)?
bsd-3-clause | 86 | endorse | neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | 87 | acknowledgement | all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd-2-clause-freebsd | 86 | freebsd | the views and conclusions contained in the software and documentation are those of the authors and should not be interpreted as representing official policies (?:[^ ]+ ){0,8}freebsd project
bsd-3-clause-clear | 88 | patent | no express or implied licenses to any party s patent rights are granted by this license
zlib | 90 | liable | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | 86 | misrepresented | the origin of this software must not be misrepresented
zlib | 85 | altered | altered source versions must be plainly marked as such
gpl | 88 | redistribute | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl | 87 | copyleft | the gnu general public license is a free copyleft license for software
gpl | 86 | received | you should have received a copy of the gnu general public license
lgpl | 90 | lesser | you can redistribute it and or modify it under the terms of the gnu lesser general public license
lgpl | 90 | library | you can redistribute it and or modify it under the terms of the gnu library general public license
lgpl | 88 | lesser | you should have received a copy of the gnu lesser general public license
agpl | 90 | affero | you can redistribute it and or modify it under the terms of the gnu affero general public license
agpl | 88 | affero | you should have received a copy of the gnu affero general public license
gfdl | 90 | documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl | 86 | invariant | with no invariant sections
apache-2.0 | 90 | compliance | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache | 88 | compliance | you may not use this file except in compliance with the license
apache | 86 | warranties | software distributed under the license is distributed on an as is basis without warranties or conditions of any kind
apache | 85 | asf | licensed to the apache software foundation asf under one or more contributor license agreements
apache-1.1 | 87 | apache | this product includes software developed by the apache software foundation
mpl-2.0 | 90 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl | 88 | mozilla | this source code form is subject to the terms of the mozilla public license
mpl-1.1 | 88 | mozilla | the contents of this file are subject to the mozilla public license version 1 1
mpl-2.0-no-copyleft-exception | 91 | incompatible | this source code form is incompatible with secondary licenses as defined by the mozilla public license
epl | 88 | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license
epl-2.0 | 90 | eclipse | made available under the terms of the eclipse public license 2 0
edl-1.0 | 90 | eclipse | made available under the terms of the eclipse distribution license v 1 0
cddl | 88 | distribution | the contents of this file are subject to the terms of the common development and distribution license
cddl | 87 | distribution | subject to the terms of the common development and distribution license
eupl | 88 | eupl | licensed under the eupl
bsl-1.0 | 88 | organization | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
bsl-1.0 | 90 | boost | distributed under the boost software license version 1 0
unlicense | 90 | unencumbered | this is free and unencumbered software released into the public domain
unlicense | 86 | compile | anyone is free to copy modify publish use compile sell or distribute this software
wtfpl | 88 | fuck | you just do what the fuck you want to
cc0-1.0 | 88 | waived | to the extent possible under law (?:[^ ]+ ){1,12}waived all copyright and related or neighboring rights
cc | 80 | creativecommons | creativecommons org licenses
cc-by-nc-nd | 92 | creativecommons | creativecommons org licenses by nc nd
cc-by-nc-sa | 92 | creativecommons | creativecommons org licenses by nc sa
cc-by-nc | 90 | creativecommons | creativecommons org licenses by nc
cc-by-nd | 90 | creativecommons | creativecommons org licenses by nd
cc-by-sa | 90 | creativecommons | creativecommons org licenses by sa
cc-by | 88 | creativecommons | creativecommons org licenses by
cc0 | 90 | creativecommons | creativecommons org publicdomain zero
public-domain | 88 | creativecommons | creativecommons org publicdomain mark
artistic | 88 | perl | this (?:program|library|module) is free software you can redistribute it and or modify it under the same terms as perl itself
artistic-2.0 | 88 | artistic | the artistic license 2 0
psf | 86 | psf | psf is making python available to licensee
python | 85 | cwi | cwi disclaims all warranties
openssl | 88 | openssl | this product includes software developed by the openssl project
ssleay | 88 | cryptographic | this product includes cryptographic software written by eric young
ofl | 88 | sil | this font software is licensed under the sil open font license
ofl | 86 | fonts | the fonts and derivatives however cannot be released under any other type of license
odbl | 88 | database | made available under the open database license
ms-pl | 86 | accompanying | this license governs use of the accompanying software if you use the software you accept this license
json | 90 | evil | the software shall be used for good not evil
beerware | 90 | beer | if we meet some day and you think this stuff is worth it you can buy me a beer
vim | 88 | vim | distribute unmodified copies of vim without restriction
sleepycat | 88 | redistributions | redistributions in any form must be accompanied by information on how to obtain complete source code
ncsa | 88 | deal | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction
curl | 88 | haxx | copyright c (?:[^ ]+ ){1,8}daniel haxx se
libpng | 88 | png | the png reference library is supplied as is
ijg | 88 | jpeg | this software is based in part on the work of the independent jpeg group
freetype | 88 | freetype | portions of this software are copyright (?:[^ ]+ ){0,5}the freetype project
unicode | 88 | unicode | permission is hereby granted free of charge to any person obtaining a copy of the unicode data files
w3c | 88 | w3c | this work is being provided by the copyright holders under the following license w3c
zpl | 86 | zope | this software is subject to the provisions of the zope public license
sspl | 88 | mongodb | server side public license as published by mongodb
busl | 88 | governed | use of this software is governed by the business source license
elastic | 88 | elasticsearch | licensed to elasticsearch b v under one or more contributor license agreements
commons-clause | 90 | sell | the license does not grant to you the right to sell the software
proprietary | 82 | confidential | proprietary and confidential
proprietary | 82 | unauthorized | unauthorized copying of this file via any medium is strictly prohibited
proprietary | 80 | trade | trade secrets? of (?:[^ ]+ ){1,6}(?:inc|corporation|ltd|llc|gmbh)
proprietary | 78 | eula | end user licen[cs]e agreement eula
proprietary | 76 | agreement | end user licen[cs]e agreement
all-rights-reserved | 40 | reserved | all rights reserved
public-domain | 72 | domain | (?:released|dedicated|placed|put) (?:in|into|to) the public domain
public-domain | 60 | domain | (?:is|are) in the public domain
public-domain | 50 | domain | public domain (?:work|software|text|dedication|mark)
gpl | 79 | gpl | spdx license identifier gpl {V}(?: only| or later)?
lgpl | 80 | lgpl | spdx license identifier lgpl {V}(?: only| or later)?
agpl | 80 | agpl | spdx license identifier agpl {V}(?: only| or later)?
apache | 80 | apache | spdx license identifier apache {V}
mit | 80 | mit | spdx license identifier mit
bsd-2-clause | 80 | bsd | spdx license identifier bsd 2 clause
bsd-3-clause | 80 | bsd | spdx license identifier bsd 3 clause
isc | 80 | isc | spdx license identifier isc
mpl | 80 | mpl | spdx license identifier mpl {V}
epl | 80 | epl | spdx license identifier epl {V}
unlicense | 80 | unlicense | spdx license identifier unlicense
cc0 | 80 | cc0 | spdx license identifier cc0 {V}
agpl | 78 | affero | (?:gnu )?affero general public licen[cs]e(?: agpl)?{V}(?: only| or (?:at your option )?(?:any )?later(?: version)?)?
agpl | 68 | affero | (?:gnu )?affero general public licen[cs]e
agpl | 76 | agpl | (?:gnu )?agpl{V}(?: only| or (?:any )?later(?: version)?)?
agpl-3 | 75 | agplv3 | agplv3
agpl | 62 | agpl | (?:gnu )?agpl
lgpl | 78 | lesser | (?:gnu )?lesser general public licen[cs]e(?: lgpl)?{V}(?: only| or (?:at your option )?(?:any )?later(?: version)?)?
lgpl | 68 | lesser | (?:gnu )?lesser general public licen[cs]e
lgpl | 78 | library | (?:gnu )?library general public licen[cs]e{V}(?: or (?:any )?later(?: version)?)?
lgpl | 68 | library | (?:gnu )?library general public licen[cs]e
lgpl | 76 | lgpl | (?:gnu )?lgpl{V}(?: only| or (?:any )?later(?: version)?)?
lgpl-2.1 | 75 | lgplv2 | lgplv2 1
lgpl-2 | 74 | lgplv2 | lgplv2
lgpl-3 | 75 | lgplv3 | lgplv3
lgpl | 62 | lgpl | (?:gnu )?lgpl
gpl | 76 | general | (?:gnu )?general public licen[cs]e(?: gpl)?{V}(?: only| or (?:at your option )?(?:any )?later(?: version)?)?
gpl | 66 | general | (?:gnu )?general public licen[cs]e
gpl | 74 | gpl | (?:gnu )?gpl{V}(?: only| or (?:any )?later(?: version)?)?
gpl-2 | 74 | gplv2 | gplv2(?: or (?:any )?later(?: version)?)?
gpl-3 | 74 | gplv3 | gplv3(?: or (?:any )?later(?: version)?)?
gpl | 60 | gpl | (?:gnu gpl|under the gpl|gpl licen[cs]ed?|gpl compatible)
gpl-classpath-exception | 79 | classpath | gnu general public licen[cs]e (?:[^ ]+ ){0,6}with (?:the )?classpath exception
gfdl | 78 | documentation | (?:gnu )?free documentation licen[cs]e{V}(?: or (?:any )?later(?: version)?)?
gfdl | 68 | documentation | (?:gnu )?free documentation licen[cs]e
gfdl | 62 | gfdl | gfdl
apache | 76 | apache | apache (?:software |public )?licen[cs]e{V}
apache | 66 | apache | apache (?:software |public )?licen[cs]e
apache | 74 | apache | apache {V}
apache | 72 | asl | asl {V}
apache | 64 | apache | (?:under the apache|apache licen[cs]ed)
mit | 70 | mit | mit (?:style )?licen[cs]e
mit | 72 | mit | (?:under (?:the|an) mit|mit licensed)
mit | 70 | expat | (?:mit )?expat licen[cs]e
x11 | 70 | x11 | (?:mit )?x11 licen[cs]e
bsd-0-clause | 78 | bsd | bsd (?:0|zero) clause(?: licen[cs]e)?
bsd-2-clause | 78 | bsd | bsd (?:2|two) clause(?: licen[cs]e)?
bsd-3-clause | 78 | bsd | bsd (?:3|three) clause(?: licen[cs]e)?
bsd-4-clause | 78 | bsd | bsd (?:4|four) clause(?: licen[cs]e)?
bsd-2-clause | 78 | bsd | (?:2|two) clause bsd(?: style)?(?: licen[cs]e)?
bsd-3-clause | 78 | bsd | (?:3|three) clause bsd(?: style)?(?: licen[cs]e)?
bsd-4-clause | 78 | bsd | (?:4|four) clause bsd(?: style)?(?: licen[cs]e)?
bsd-3-clause | 76 | bsd | (?:new|modified|revised) bsd licen[cs]e
bsd-2-clause | 76 | bsd | simplified bsd licen[cs]e
bsd-4-clause | 76 | bsd | (?:original|old) bsd licen[cs]e
bsd | 66 | bsd | bsd (?:style )?licen[cs]e
bsd | 64 | bsd | under (?:the|a) bsd(?! [^ ]+ clause)
bsd-2-clause | 74 | freebsd | freebsd licen[cs]e
mpl | 76 | mozilla | mozilla public licen[cs]e(?: mpl)?{V}
mpl | 66 | mozilla | mozilla public licen[cs]e
mpl | 74 | mpl | mpl{V}
mpl-2.0 | 74 | mplv2 | mplv2(?: 0)?
mpl | 60 | mpl | under the mpl
epl | 76 | eclipse | eclipse public licen[cs]e(?: epl)?{V}
epl | 66 | eclipse | eclipse public licen[cs]e
epl | 74 | epl | epl{V}
edl | 76 | eclipse | eclipse distribution licen[cs]e(?: edl)?{V}
edl | 66 | eclipse | eclipse distribution licen[cs]e
cddl | 76 | distribution | common development and distribution licen[cs]e(?: cddl)?{V}
cddl | 66 | distribution | common development and distribution licen[cs]e
cddl | 74 | cddl | cddl{V}
cddl | 62 | cddl | cddl
cpl | 76 | common | common public licen[cs]e(?: cpl)?{V}
cpl | 66 | common | common public licen[cs]e
cpal | 72 | attribution | common public attribution licen[cs]e
ipl | 76 | ibm | ibm public licen[cs]e{V}
ipl | 66 | ibm | ibm public licen[cs]e
eupl | 76 | european | european union public licen[cs]e(?: eupl)?{V}
eupl | 66 | european | european union public licen[cs]e
eupl | 74 | eupl | eupl{V}
eupl | 62 | eupl | eupl
isc | 70 | isc | isc licen[cs]e
isc | 70 | consortium | internet systems consortium licen[cs]e
zlib | 70 | zlib | zlib(?: libpng)? licen[cs]e
libpng | 70 | libpng | libpng licen[cs]e
bsl | 76 | boost | boost software licen[cs]e{V}
bsl | 66 | boost | boost software licen[cs]e
artistic | 76 | artistic | (?:perl )?artistic licen[cs]e{V}
artistic | 66 | artistic | (?:perl )?artistic licen[cs]e
unlicense | 64 | unlicense | (?:the )?unlicense
wtfpl | 76 | fuck | do what the fuck you want to public licen[cs]e
wtfpl | 64 | wtfpl | wtfpl
psf | 76 | python | python software foundation licen[cs]e{V}
psf | 66 | python | python software foundation licen[cs]e
psf | 64 | psf | psf licen[cs]e
python | 62 | python | python licen[cs]e
php | 76 | php | php licen[cs]e{V}
php | 66 | php | php licen[cs]e
ruby | 66 | ruby | ruby licen[cs]e
openssl | 66 | openssl | openssl licen[cs]e
ssleay | 66 | ssleay | ssleay licen[cs]e
ofl | 76 | font | (?:sil )?open font licen[cs]e(?: ofl)?{V}
ofl | 66 | font | (?:sil )?open font licen[cs]e
ofl | 72 | ofl | (?:sil )?ofl{V}
odbl | 72 | database | open database licen[cs]e(?: odbl)?
odbl | 62 | odbl | odbl
pddl | 72 | pddl | public domain dedication and licen[cs]e pddl
pddl | 70 | dedication | public domain dedication and licen[cs]e
odc-by | 72 | commons | open data commons attribution licen[cs]e
odc-by | 70 | odc | odc by
ms-pl | 70 | microsoft | microsoft public licen[cs]e
ms-rl | 70 | microsoft | microsoft reciprocal licen[cs]e
ms-pl | 64 | ms | ms pl
ms-rl | 64 | ms | ms rl
afl | 76 | academic | academic free licen[cs]e{V}
afl | 66 | academic | academic free licen[cs]e
osl | 76 | open | open software licen[cs]e{V}
osl | 66 | open | open software licen[cs]e
ecl | 76 | educational | educational community licen[cs]e{V}
ecl | 66 | educational | educational community licen[cs]e
apsl | 76 | apple | apple public source licen[cs]e{V}
apsl | 66 | apple | apple public source licen[cs]e
cecill | 76 | cecill | cecill(?: [bc])?(?: licen[cs]e)?{V}
cecill | 66 | cecill | cecill(?: [bc])?(?: licen[cs]e)?
ncsa | 72 | ncsa | (?:university of illinois )?ncsa(?: open source)? licen[cs]e
upl | 76 | universal | universal permissive licen[cs]e{V}
upl | 66 | universal | universal permissive licen[cs]e
zpl | 76 | zope | zope public licen[cs]e{V}
zpl | 66 | zope | zope public licen[cs]e
sleepycat | 66 | sleepycat | sleepycat licen[cs]e
w3c | 72 | w3c | w3c (?:software notice and |software |document )?licen[cs]e
postgresql | 66 | postgresql | postgresql licen[cs]e
vim | 66 | vim | vim licen[cs]e
tcl | 66 | tcl | tcl(?: tk)? licen[cs]e
curl | 66 | curl | curl licen[cs]e
qpl | 72 | q | q public licen[cs]e
npl | 76 | netscape | netscape public licen[cs]e{V}
npl | 66 | netscape | netscape public licen[cs]e
spl | 66 | sun | sun public licen[cs]e
sspl | 76 | side | server side public licen[cs]e{V}
sspl | 66 | side | server side public licen[cs]e
sspl | 62 | sspl | sspl
busl | 76 | business | business source licen[cs]e{V}
busl | 66 | business | business source licen[cs]e
elastic | 76 | elastic | elastic licen[cs]e{V}
elastic | 66 | elastic | elastic licen[cs]e
mulan | 76 | mulan | mulan (?:permissive software licen[cs]e|psl){V}
mulan | 66 | mulan | mulan (?:permissive software licen[cs]e|psl)
bzip2 | 66 | bzip2 | bzip2 licen[cs]e
json | 66 | json | json licen[cs]e
beerware | 66 | beerware | beerware(?: licen[cs]e)?
beerware | 66 | beer | beer ware licen[cs]e
eiffel | 66 | eiffel | eiffel forum licen[cs]e
nasa | 70 | nasa | nasa open source agreement
reciprocal | 70 | reciprocal | reciprocal public licen[cs]e
ricoh | 66 | ricoh | ricoh source code public licen[cs]e
interbase | 66 | interbase | interbase public licen[cs]e
simple-public | 66 | simple | simple public licen[cs]e
blue-oak | 66 | oak | blue oak model licen[cs]e
hippocratic | 66 | hippocratic | hippocratic licen[cs]e
openldap | 66 | openldap | openldap public licen[cs]e
latex | 66 | latex | latex project public licen[cs]e
lppl | 72 | lppl | lppl{V}
llvm-exception | 76 | llvm | apache (?:[^ ]+ ){1,5}with llvm exceptions?
cc-by-nc-nd | 80 | cc | cc by nc nd{V}
cc-by-nc-nd | 72 | cc | cc by nc nd
cc-by-nc-sa | 80 | cc | cc by nc sa{V}
cc-by-nc-sa | 72 | cc | cc by nc sa
cc-by-nc | 78 | cc | cc by nc{V}
cc-by-nc | 70 | cc | cc by nc
cc-by-nd | 78 | cc | cc by nd{V}
cc-by-nd | 70 | cc | cc by nd
cc-by-sa | 78 | cc | cc by sa{V}
cc-by-sa | 70 | cc | cc by sa
cc-by | 76 | cc | cc by{V}
cc-by | 66 | cc | cc by
cc0 | 76 | cc0 | cc0{V}(?: universal)?
cc0 | 66 | cc0 | cc0
cc0 | 76 | zero | creative commons zero{V}
cc0 | 66 | zero | creative commons zero
cc-by-nc-nd | 82 | creative | creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: works)?{V}
cc-by-nc-nd | 74 | creative | creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: works)?
cc-by-nc-sa | 82 | creative | creative commons attribution non ?commercial share ?alike{V}
cc-by-nc-sa | 74 | creative | creative commons attribution non ?commercial share ?alike
cc-by-nc | 80 | creative | creative commons attribution non ?commercial{V}
cc-by-nc | 72 | creative | creative commons attribution non ?commercial
cc-by-nd | 80 | creative | creative commons attribution no ?deriv(?:ative)?s(?: works)?{V}
cc-by-nd | 72 | creative | creative commons attribution no ?deriv(?:ative)?s(?: works)?
cc-by-sa | 80 | creative | creative commons attribution share ?alike{V}
cc-by-sa | 72 | creative | creative commons attribution share ?alike
cc-by | 78 | creative | creative commons attribution(?: licen[cs]e)?{V}
cc-by | 68 | creative | creative commons attribution(?: licen[cs]e)?
cc | 30 | creative | creative commons(?: licen[cs]e)?
open-source | 10 | source | open source licen[cs]e
open-source | 10 | free | free software licen[cs]e
"""

DETECTION = "array<struct<start:int,down:int,lower:int,label:string,first_word:bigint,n_words:int>>"


def rules() -> list[tuple[str, int, str, str, bool]]:
    """(label, priority, keyword, pattern, whether group 1 is a version that the label gets), in order."""
    out = []
    for line in RULES.strip().splitlines():
        label, priority, key, pattern = line.split(" | ")
        out.append((label, int(priority), key, pattern.replace("{V}", VERSION), "{V}" in pattern))
    return out


def one_of(words: list[str]) -> str:
    """A regular expression for these words as a tree of their letters, so that few branches are tried at a place."""
    heads: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        heads.setdefault(w[:1], []).append(w[1:])
    if set(heads) == {""}:
        return ""
    branches = [c + one_of(rest) for c, rest in heads.items() if c]
    body = branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"
    return f"(?:{body})?" if "" in heads else body


def words_text(text: Column) -> Column:
    """The words with one space before, between and after them."""
    return F.regexp_replace(F.concat(F.lit(" "), text, F.lit(" ")), BETWEEN, " ")


def spaces(text: Column) -> Column:
    """How many spaces a text has. In words that each follow one space: how many words."""
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once for each row, however often body or functions in it use it."""
    return F.transform(F.array(value), body)[0]


def places(words: Column, pattern: Column) -> Column:
    """Array of (start, word, match) of a pattern's matches: first character, number of the first word, and the match.

    A match has the space before its first word and not the one after it. One pass carries characters and words along.
    """
    none = F.array().cast("array<struct<start:int,word:bigint,match:string>>")
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("word"), none.alias("found"))

    def step(acc: Column, pair: Column) -> Column:
        start, word = acc["at"] + F.length(pair["between"]), acc["word"] + spaces(pair["between"])
        hit = F.struct(start.alias("start"), word.alias("word"), pair["match"].alias("match"))
        return F.struct((start + F.length(pair["match"])).alias("at"), (word + spaces(pair["match"])).alias("word"), F.concat(acc["found"], F.array(hit)).alias("found"))

    pairs = lambda m: F.arrays_zip(F.slice(F.split(words, pattern, -1), 1, F.size(m)).alias("between"), m.alias("match"))
    return let(F.regexp_extract_all(words, pattern, F.lit(0)), lambda m: F.when(F.size(m) == 0, none).otherwise(F.aggregate(pairs(m), zero, step)["found"]))


def suppressed(found: Column) -> Column:
    """Detections without those inside one of higher priority, or of equal priority and longer; each once.

    `lower` and `down` are the negated priority and end. In the order of start, end and priority, what holds a detection
    stands before it, so one pass with the detections that are still open is enough.
    """
    inside = lambda a, b: (a["down"] >= b["down"]) & ((b["lower"] < a["lower"]) | (b["lower"] == a["lower"]) & ((b["start"] < a["start"]) | (b["down"] < a["down"])))
    none = F.array().cast(DETECTION)
    zero = F.struct(none.alias("open"), none.alias("left"))

    def step(acc: Column, a: Column) -> Column:
        opened = F.filter(acc["open"], lambda b: -b["down"] > a["start"])
        hidden = F.exists(acc["open"], lambda b: inside(a, b))
        more = F.when(hidden, none).otherwise(F.array(a))
        return F.struct(F.concat(opened, more).alias("open"), F.concat(acc["left"], more).alias("left"))

    return F.aggregate(F.array_sort(F.array_distinct(found)), zero, step)["left"]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each text: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    The base columns tell where the four base phrases stand; labels adds those of the rules. detections has (label,
    priority, first_word, n_words) of what isn't suppressed, by place; rules that tie at a place with equal length and
    priority are all kept. score is the priority of the best detection, in hundredths (0: none). Null text counts as
    empty; null ids and repeated rows are rows like others; very long texts are matched whole, in one pass for each rule
    whose keyword they hold; an empty table gives an empty result; further columns are not read.
    """
    every = rules()
    keywords = sorted({r[2] for r in every} | {p.split()[0] for p, _ in BASE})
    # one literal that Spark folds into a map from keyword to rules, each a line of fields
    lines = [f"{key}\t" + "\v".join(f"{label}\f{-priority}\f{versioned}\f {pattern}(?= )" for label, priority, k, pattern, versioned in every if k == key) for key in sorted({r[2] for r in every})]
    by_key = F.str_to_map(F.lit("\n".join(lines)), F.lit("\n"), F.lit("\t"))
    gate = f" {one_of(keywords)} "
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), words_text(F.coalesce(F.col(text_col), F.lit(""))).alias("words"))

    def matches(words: Column, r: Column) -> Column:
        version = lambda p: F.call_function("regexp_extract", F.concat(p["match"], F.lit(" ")), r["pattern"], F.lit(1))
        label = lambda p: F.when(r["versioned"], F.concat(r["label"], F.lit("-"), F.replace(version(p), F.lit(" "), F.lit(".")))).otherwise(r["label"])
        return F.transform(places(words, r["pattern"]), lambda p: F.struct(p["start"].alias("start"), (-p["start"] - F.length(p["match"])).alias("down"), r["lower"].alias("lower"), label(p).alias("label"), p["word"].alias("first_word"), spaces(p["match"]).cast("int").alias("n_words")))

    def answer(words: Column) -> Column:
        keys = F.array_distinct(F.regexp_extract_all(words, F.lit(f" ({one_of(keywords)})(?= )"), F.lit(1)))
        base = F.array(*(F.when(F.contains(words, F.lit(f" {phrase} ")), F.transform(places(words, F.lit(f" {phrase}(?= )")), lambda p: p["word"])).otherwise(F.array().cast("array<bigint>")) for phrase, _ in BASE))
        ready = F.flatten(F.transform(F.filter(keys, lambda k: F.map_contains_key(by_key, k)), lambda k: F.split(by_key[k], "\v")))
        ready = F.transform(F.transform(ready, lambda r: F.split(r, "\f")), lambda r: F.struct(r[0].alias("label"), r[1].cast("int").alias("lower"), (r[2] == "True").alias("versioned"), r[3].alias("pattern")))
        found = F.flatten(F.transform(ready, lambda r: matches(words, r)))
        return F.struct(base.alias("base"), suppressed(found).alias("detections"))

    lowered = F.translate("words", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.when(F.col("words").rlike(f"(?i){gate}"), let(lowered, answer))
    out = out.select("doc_id", (spaces(F.col("words")) - 1).alias("n_words"), hit.alias("hit"))
    starts = F.coalesce(F.flatten("hit.base"), F.array().cast("array<bigint>"))
    base_labels = F.array_compact(F.array(*(F.when(F.size(F.col("hit.base")[i]) > 0, F.lit(label)) for i, (_, label) in enumerate(BASE))))
    found = F.coalesce("hit.detections", F.array().cast(DETECTION))
    return out.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.concat_ws(",", F.array_sort(base_labels)).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(base_labels, F.transform(found, lambda x: x["label"])))).alias("labels"),
        F.greatest(F.coalesce(F.array_max(F.transform(found, lambda x: -x["lower"])), F.lit(0)) / 100.0, F.when(F.size(starts) > 0, 0.6).otherwise(0.0)).alias("score"),
        F.transform(found, lambda x: F.struct(x["label"].alias("label"), (-x["lower"]).alias("priority"), x["first_word"].alias("first_word"), x["n_words"].alias("n_words"))).alias("detections"),
    )
