"""The rules of the license scan: hand-written signatures over words.

A text is read as lower-case words (letters and digits) with single blanks
between them. In a signature ``@`` stands before its keyword, a word written out
(``licen[cs]e`` stands for both spellings); the signature is tried where that
word stands and nowhere else. Every word and every optional group of words ends
with a blank, but for the last word.

Families give several rules each: their tag after ``SPDX-License-Identifier:``,
their name, and the name after "licensed under the terms of the". ``{v}`` in a
family stands for each of its versions.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    number: int
    label: str
    priority: int  # the lower, the stronger
    strength: float
    base: bool
    keywords: tuple[str, ...]
    left: str  # words before the keyword, each with a blank after it
    right: str  # the keyword and what follows


# The phrases that are always reported (fixed values).
BASE = [("cc-by", "@cc by"), ("gpl", "@general public license"), ("reserved", "all rights @reserved")]

TAG, TEXT, NOTICE, ADDRESS, NAME, HINT, ALWAYS = range(1, 8)
STRENGTH = {TAG: 1.0, TEXT: 0.95, NOTICE: 0.95, ADDRESS: 0.9, NAME: 0.7, HINT: 0.3, ALWAYS: 0.5}

NOTICE_BEFORE = (
    "(?:licensed|licenced|released|distributed|redistributed|available|published|provided|covered|governed|offered|shared) "
    "(?:under|by|according to) (?:the )?(?:(?:terms|conditions) (?:and conditions )?of )?(?:the |a |an )?"
)
# "version 2.0", "v2.0", "2.0", "2": a version is written with blanks here.
VERSION = "(?:licen[cs]e )?(?:version |ver |v )?v?"

# label | versions | tag | name
FAMILIES = """
apache-{v} | 1 0, 1 1, 2 0 | apache {v} | @apache (?:software )?VERSION{v}
mit | | mit | mit (?:x11 )?@licen[cs]e
mit-0 | | mit 0 | mit no @attribution
mit-advertising | | mit advertising | mit @advertising licen[cs]e
mit-cmu | | mit cmu | cmu @licen[cs]e
x11 | | x11 | @x11 (?:style )?licen[cs]e
isc | | isc | isc @licen[cs]e
bsd-1-clause | | bsd 1 clause | (?:1|one) clause @bsd
bsd-2-clause | | bsd 2 clause | (?:(?:2|two) clause|simplified) @bsd
bsd-2-clause-patent | | bsd 2 clause patent | @bsd 2 clause plus patent
bsd-3-clause | | bsd 3 clause | (?:(?:3|three) clause|new|revised|modified) @bsd
bsd-3-clause-clear | | bsd 3 clause clear | clear @bsd
bsd-4-clause | | bsd 4 clause | (?:(?:4|four) clause|original|old) @bsd
0bsd | | 0bsd | (?:zero clause|0 clause) @bsd
freebsd | | bsd 2 clause freebsd | @freebsd licen[cs]e
netbsd | | bsd 2 clause netbsd | @netbsd licen[cs]e
gpl-{v} | 1 0, 2 0, 3 0 | gpl {v} | gnu @gpl VERSION{v}
gpl-{v}-only | 1 0, 2 0, 3 0 | gpl {v} only | gnu @gpl VERSION{v} only
gpl-{v}-or-later | 1 0, 2 0, 3 0 | gpl {v} or later | gnu @gpl VERSION{v} or (?:any )?later
gpl-{v}.0 | 1, 2, 3 | gplv{v} | (?:gnu )?@general public licen[cs]e (?:version |v )?v?{v}
gpl-{v}.0-or-later | 1, 2, 3 | gpl {v} plus | (?:gnu )?@general public licen[cs]e (?:as published by the free software foundation )?either version {v} of the licen[cs]e or at your option any later
lgpl-{v} | 2 0, 2 1, 3 0 | lgpl {v} | (?:gnu )?(?:lesser|library) @general public licen[cs]e (?:version |v )?v?{v}
lgpl-{v}-only | 2 0, 2 1, 3 0 | lgpl {v} only | gnu @lgpl VERSION{v} only
lgpl-{v}-or-later | 2 0, 2 1, 3 0 | lgpl {v} or later | gnu @lgpl VERSION{v} or (?:any )?later
agpl-{v} | 1 0, 3 0 | agpl {v} | (?:gnu )?affero @general public licen[cs]e (?:version |v )?v?{v}
agpl-{v}-only | 1 0, 3 0 | agpl {v} only | gnu @agpl VERSION{v} only
agpl-{v}-or-later | 1 0, 3 0 | agpl {v} or later | gnu @agpl VERSION{v} or (?:any )?later
gfdl-{v} | 1 1, 1 2, 1 3 | gfdl {v} | (?:gnu )?free @documentation licen[cs]e (?:version )?{v}
mpl-{v} | 1 0, 1 1, 2 0 | mpl {v} | @mozilla public licen[cs]e (?:version |v )?v?{v}
epl-{v} | 1 0, 2 0 | epl {v} | @eclipse public licen[cs]e (?:version |v )?v?{v}
edl-1.0 | | bsd 3 clause eclipse | @eclipse distribution licen[cs]e
cddl-{v} | 1 0, 1 1 | cddl {v} | common @development and distribution licen[cs]e (?:cddl )?(?:version )?{v}
cpl-{v} | 1 0 | cpl {v} | common public @licen[cs]e (?:version )?{v}
ipl-{v} | 1 0 | ipl {v} | @ibm public licen[cs]e (?:version )?{v}
eupl-{v} | 1 0, 1 1, 1 2 | eupl {v} | @european union public licen[cs]e (?:version |v )?v?{v}
cc0-{v} | 1 0 | cc0 {v} | @cc0 {v}
cc-by-{v} | 1 0, 2 0, 2 5, 3 0, 4 0 | cc by {v} | creative @commons attribution {v}
cc-by-sa-{v} | 1 0, 2 0, 2 5, 3 0, 4 0 | cc by sa {v} | creative @commons attribution share ?alike {v}
cc-by-nd-{v} | 1 0, 2 0, 2 5, 3 0, 4 0 | cc by nd {v} | creative @commons attribution no ?deriv(?:ative|ativ|s)?s? {v}
cc-by-nc-{v} | 1 0, 2 0, 2 5, 3 0, 4 0 | cc by nc {v} | creative @commons attribution non ?commercial {v}
cc-by-nc-sa-{v} | 1 0, 2 0, 2 5, 3 0, 4 0 | cc by nc sa {v} | creative @commons attribution non ?commercial share ?alike {v}
cc-by-nc-nd-{v} | 1 0, 2 0, 2 5, 3 0, 4 0 | cc by nc nd {v} | creative @commons attribution non ?commercial no ?deriv(?:ative|ativ|s)?s? {v}
cc-by-{v} | 1 0, 2 0, 2 5, 3 0, 4 0 | cc by {v} international | @cc by {v}
cc-by-sa-{v} | 1 0, 2 0, 2 5, 3 0, 4 0 | cc by sa {v} international | @cc by sa {v}
cc-by-nd-{v} | 1 0, 2 0, 2 5, 3 0, 4 0 | cc by nd {v} international | @cc by nd {v}
cc-by-nc-{v} | 1 0, 2 0, 2 5, 3 0, 4 0 | cc by nc {v} international | @cc by nc {v}
cc-by-nc-sa-{v} | 1 0, 2 0, 2 5, 3 0, 4 0 | cc by nc sa {v} international | @cc by nc sa {v}
cc-by-nc-nd-{v} | 1 0, 2 0, 2 5, 3 0, 4 0 | cc by nc nd {v} international | @cc by nc nd {v}
cc-pdm-1.0 | | cc pdm 1 0 | creative @commons public domain mark
unlicense | | unlicense | the @unlicense
wtfpl | | wtfpl | do what the fuck you want to public @licen[cs]e
zlib | | zlib | (?:zlib|zlib libpng) @licen[cs]e
libpng | | libpng 2 0 | libpng @licen[cs]e
bsl-1.0 | | bsl 1 0 | @boost software licen[cs]e
artistic-{v} | 1 0, 2 0 | artistic {v} | @artistic licen[cs]e (?:version )?{v}
perl | | artistic 1 0 perl | same @terms as perl(?: itself)?
psf-2.0 | | psf 2 0 | @python software foundation licen[cs]e
python-2.0 | | python 2 0 | python @licen[cs]e
ruby | | ruby | ruby @licen[cs]e
php-{v} | 3 0, 3 01 | php {v} | php @licen[cs]e (?:version )?{v}
openssl | | openssl | @openssl licen[cs]e
ssleay | | ssleay | @ssleay licen[cs]e
postgresql | | postgresql | @postgresql licen[cs]e
ncsa | | ncsa | @ncsa (?:open source )?licen[cs]e
w3c | | w3c | @w3c (?:software (?:notice and )?)?(?:document )?licen[cs]e
ofl-{v} | 1 0, 1 1 | ofl {v} | (?:sil )?open @font licen[cs]e (?:version )?{v}
odbl-1.0 | | odbl 1 0 | open @database licen[cs]e
odc-by-1.0 | | odc by 1 0 | open data @commons attribution licen[cs]e
pddl-1.0 | | pddl 1 0 | public domain @dedication and licen[cs]e
afl-{v} | 1 1, 2 0, 2 1, 3 0 | afl {v} | academic free @licen[cs]e (?:version |v )?{v}
osl-{v} | 1 0, 2 0, 2 1, 3 0 | osl {v} | open software @licen[cs]e (?:version |v )?{v}
ecl-{v} | 1 0, 2 0 | ecl {v} | educational community @licen[cs]e (?:version )?{v}
ms-pl | | ms pl | @microsoft public licen[cs]e
ms-rl | | ms rl | @microsoft reciprocal licen[cs]e
qpl-1.0 | | qpl 1 0 | q public @licen[cs]e
sleepycat | | sleepycat | @sleepycat licen[cs]e
vim | | vim | vim @licen[cs]e
curl | | curl | curl @licen[cs]e
icu | | icu | icu @licen[cs]e
unicode-dfs | | unicode dfs 2016 | @unicode licen[cs]e agreement
ijg | | ijg | independent @jpeg group
json | | json | json @licen[cs]e
beerware | | beerware | beer ?ware @licen[cs]e
blueoak-1.0.0 | | blueoak 1 0 0 | blue oak model @licen[cs]e
busl-1.1 | | busl 1 1 | business source @licen[cs]e
sspl-1.0 | | sspl 1 0 | server side public @licen[cs]e
elastic-2.0 | | elastic 2 0 | @elastic licen[cs]e
commons-clause | | commons clause | @commons clause
polyform-noncommercial | | polyform noncommercial 1 0 0 | @polyform noncommercial
polyform-small-business | | polyform small business 1 0 0 | @polyform small business
cecill-{v} | 1 0, 1 1, 2 0, 2 1 | cecill {v} | @cecill (?:licen[cs]e )?(?:version |v )?{v}
cecill-b | | cecill b | @cecill b
cecill-c | | cecill c | @cecill c
mulan-psl-2.0 | | mulanpsl 2 0 | @mulan psl v2
upl-1.0 | | upl 1 0 | universal @permissive licen[cs]e
nasa-1.3 | | nasa 1 3 | @nasa open source agreement
efl-{v} | 1 0, 2 0 | efl {v} | eiffel @forum licen[cs]e (?:version )?{v}
lppl-{v} | 1 0, 1 1, 1 2, 1 3c | lppl {v} | @latex project public licen[cs]e (?:version )?{v}
apsl-{v} | 1 0, 1 1, 2 0 | apsl {v} | @apple public source licen[cs]e (?:version )?{v}
watcom-1.0 | | watcom 1 0 | @sybase open watcom
intel | | intel | @intel open source licen[cs]e
naumen | | naumen | @naumen public licen[cs]e
motosoto | | motosoto | @motosoto open source licen[cs]e
nokia | | nokia | @nokia open source licen[cs]e
rpl-{v} | 1 1, 1 5 | rpl {v} | @reciprocal public licen[cs]e (?:version )?{v}
rpsl-1.0 | | rpsl 1 0 | @realnetworks public source licen[cs]e
spl-1.0 | | spl 1 0 | sun public @licen[cs]e
hpnd | | hpnd | @historical permission notice and disclaimer
ntp | | ntp | ntp @licen[cs]e
tcl | | tcl | tcl tk @licen[cs]e
xnet | | xnet | x net @licen[cs]e
zpl-{v} | 2 0, 2 1 | zpl {v} | @zope public licen[cs]e (?:version )?{v}
zend-2.0 | | zend 2 0 | @zend (?:engine )?licen[cs]e
fair | | fair | fair @licen[cs]e
entessa | | entessa | @entessa public licen[cs]e
frameworx-1.0 | | frameworx 1 0 | @frameworx open licen[cs]e
wxwindows | | wxwindows | @wxwindows library licen[cs]e
sissl | | sissl | sun industry standards source @licen[cs]e
oclc-2.0 | | oclc 2 0 | @oclc research public licen[cs]e
simpl-2.0 | | simpl 2 0 | simple public @licen[cs]e
openldap-2.8 | | oldap 2 8 | @openldap public licen[cs]e
info-zip | | info zip | info zip @licen[cs]e
ogl-3.0 | | ogl uk 3 0 | open @government licen[cs]e
etalab-2.0 | | etalab 2 0 | @licence ouverte
liliq-r-1.1 | | liliq r 1 1 | @licence libre du quebec
gfsl | | gust font license | gust @font licen[cs]e
"""

# priority | label | signature
SIGNATURES = """
text | mit | permission is hereby @granted free of charge to any person obtaining a copy of this software
text | mit | the above copyright notice and this permission notice shall be @included in all copies or substantial portions
text | isc | permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby @granted
text | bsd | @redistribution and use in source and binary forms with or without modification are permitted
text | bsd | @redistributions of source code must retain the above copyright notice
text | bsd | @redistributions in binary form must reproduce the above copyright notice
text | bsd-3-clause | neither the name of (?:the )?(?:\\S+ ){1,4}nor the names of its @contributors may be used to endorse
text | bsd-4-clause | all @advertising materials mentioning features or use of this software must display
text | warranty-disclaimer | software is provided as is without @warranty of any kind
text | warranty-disclaimer | @warranties of merchantability (?:and )?fitness for a particular purpose
text | gpl | this program is free @software you can redistribute it and or modify it under the terms of the gnu general public license
text | gpl | see the gnu @general public licen[cs]e for more details
text | gpl | you should have received a copy of the gnu @general public licen[cs]e
text | lgpl | this library is free @software you can redistribute it and or modify it
text | lgpl | see the gnu (?:lesser|library) @general public licen[cs]e for more details
text | lgpl | you should have received a copy of the gnu (?:lesser|library) @general public licen[cs]e
text | agpl | you should have received a copy of the gnu affero @general public licen[cs]e
text | apache-2.0 | you may not use this file except in @compliance with the licen[cs]e
text | apache-2.0 | unless required by @applicable law or agreed to in writing software distributed under the licen[cs]e
text | mpl-2.0 | this source code form is subject to the terms of the @mozilla public licen[cs]e
text | mpl-1.1 | the contents of this file are subject to the @mozilla public licen[cs]e
text | epl | this program and the accompanying materials are made available under the terms of the @eclipse public licen[cs]e
text | cddl | the contents of this file are subject to the terms of the common @development and distribution licen[cs]e
text | unlicense | this is free and @unencumbered software released into the public domain
text | public-domain | (?:is |are |been )?(?:placed|released|dedicated) (?:in|into|to) the public @domain
text | public-domain | this work is in the public @domain
text | zlib | this software is provided as is without any express or implied @warranty in no event will the authors be held liable
text | zlib | altered source versions must be plainly marked as such and must not be @misrepresented
text | bsl-1.0 | permission is hereby @granted free of charge to any person or organization obtaining a copy
text | ofl | this font software is licensed under the sil open @font licen[cs]e
text | wtfpl | you just do what the @fuck you want to
text | beerware | if we meet some day and you think this stuff is worth it you can buy me a @beer
text | json | the software shall be used for good not @evil
text | proprietary | this (?:document|file|software) contains @proprietary (?:and confidential )?information
text | proprietary | @unauthorized (?:copying|use|reproduction|distribution) of this (?:file|document|software|material|work)
text | proprietary | (?:no part of this \\S+ may be|may not be) @reproduced
text | proprietary | without (?:the )?(?:prior |express )*written @permission
text | proprietary | trade @secrets of
text | openssl | this product includes software developed by the @openssl project
text | ssleay | this product includes cryptographic software written by eric @young
text | cc | this work is licensed under a creative @commons
text | cc0 | to the extent possible under law (?:the )?(?:\\S+ ){1,6}has @waived all copyright
text | free-use | may be freely @copied
text | free-use | free for (?:personal|private|academic|educational|non ?commercial) @use only
text | non-commercial | for non ?@commercial (?:use|purposes) only
text | non-commercial | not for @commercial use
notice | custom | @licensed under (?:the )?(?:terms|conditions) (?:in|of) (?:the )?(?:accompanying |attached |included )?licen[cs]e file
notice | custom | see (?:the )?(?:accompanying |attached |included )?@licen[cs]e(?: txt| md)? file
notice | dual | dual @licensed under
address | apache-2.0 | @apache org licenses license 2 0
address | apache-1.1 | @apache org licenses license 1 1
address | gpl-2.0 | @gnu org licenses (?:old licenses )?gpl 2 0
address | gpl-3.0 | @gnu org licenses gpl 3 0
address | gpl | @gnu org (?:licenses|copyleft) gpl
address | lgpl-2.1 | @gnu org licenses (?:old licenses )?lgpl 2 1
address | lgpl-3.0 | @gnu org licenses lgpl 3 0
address | lgpl | @gnu org (?:licenses|copyleft) lesser
address | agpl-3.0 | @gnu org licenses agpl 3 0
address | gfdl | @gnu org licenses fdl
address | mpl-2.0 | @mozilla org mpl 2 0
address | mpl-1.1 | @mozilla org mpl mpl 1 1
address | epl-1.0 | @eclipse org legal epl v10
address | epl-2.0 | @eclipse org legal epl (?:v20|2 0)
address | mit | @opensource org licen[cs]es? mit
address | bsd-2-clause | @opensource org licen[cs]es? bsd 2 clause
address | bsd-3-clause | @opensource org licen[cs]es? bsd 3 clause
address | isc | @opensource org licen[cs]es? isc
address | zlib | @opensource org licen[cs]es? zlib
address | osl-3.0 | @opensource org licen[cs]es? osl 3 0
address | afl-3.0 | @opensource org licen[cs]es? afl 3 0
address | ms-pl | @opensource org licen[cs]es? ms pl
address | unlicense | @unlicense org
address | wtfpl | @wtfpl net
address | bsl-1.0 | @boost org license 1 0
address | ofl-1.1 | @scripts sil org ofl
address | cc-by | @creativecommons org licenses by \\d
address | cc-by-sa | @creativecommons org licenses by sa
address | cc-by-nd | @creativecommons org licenses by nd
address | cc-by-nc | @creativecommons org licenses by nc \\d
address | cc-by-nc-sa | @creativecommons org licenses by nc sa
address | cc-by-nc-nd | @creativecommons org licenses by nc nd
address | cc0 | @creativecommons org publicdomain zero
address | cc-pdm-1.0 | @creativecommons org publicdomain mark
address | odbl-1.0 | @opendatacommons org licenses odbl
address | odc-by-1.0 | @opendatacommons org licenses by
address | pddl-1.0 | @opendatacommons org licenses pddl
address | eupl | joinup ec europa eu (?:\\S+ ){0,6}@eupl
name | apache | @apache (?:software )?licen[cs]e
name | bsd | @bsd (?:style |type )?licen[cs]e
name | bsd-2-clause | @bsd 2 clause
name | bsd-3-clause | @bsd 3 clause
name | bsd-4-clause | @bsd 4 clause
name | gpl | gnu @general public licen[cs]e
name | gpl | @gpl licen[cs]e
name | lgpl | (?:gnu )?(?:lesser|library) @general public licen[cs]e
name | agpl | (?:gnu )?affero @general public licen[cs]e
name | gfdl | (?:gnu )?free @documentation licen[cs]e
name | gpl-2.0 | @gplv2
name | gpl-3.0 | @gplv3
name | lgpl-2.1 | @lgplv2
name | lgpl-3.0 | @lgplv3
name | agpl-3.0 | @agplv3
name | mpl | @mozilla public licen[cs]e
name | epl | @eclipse public licen[cs]e
name | cddl | common @development and distribution licen[cs]e
name | artistic | @artistic licen[cs]e
name | eupl | @european union public licen[cs]e
name | cecill | @cecill licen[cs]e
name | ofl | (?:sil )?open @font licen[cs]e
name | cc | creative @commons licen[cs]e
name | cc-by | creative @commons attribution
name | cc-by-sa | creative @commons attribution share ?alike
name | cc-by-nc | creative @commons attribution non ?commercial
name | cc-by-nd | creative @commons attribution no ?deriv(?:ative|s)?s?
name | cc-by-sa | @cc by sa
name | cc-by-nd | @cc by nd
name | cc-by-nc | @cc by nc
name | cc-by-nc-sa | @cc by nc sa
name | cc-by-nc-nd | @cc by nc nd
name | cc0 | creative @commons zero
name | cc0 | @cc0
name | wtfpl | @wtfpl
name | psf | @python software foundation
name | shareware | @shareware
name | freeware | @freeware
name | copyleft | @copyleft
hint | gpl | @gpl
hint | lgpl | @lgpl
hint | agpl | @agpl
hint | copyright | @copyright (?:c )?(?:19|20)\\d\\d
hint | copyright | @copyright by
hint | copyright | @copyrighted (?:material|work)
hint | open-source | open source @licen[cs]e
hint | public-domain | public @domain
hint | license | end user @licen[cs]e agreement
hint | license | all rights @released
hint | license | terms of @licen[cs]e
"""


def _spellings(keyword: str) -> tuple[str, ...]:
    return tuple(keyword.replace("[cs]", c) for c in "sc") if "[cs]" in keyword else (keyword,)


def _parse(signature: str) -> tuple[tuple[str, ...], str, str]:
    left, right = signature.split("@")
    word = re.match(r"(?:[a-z0-9]|\[cs\])+", right)[0]
    return _spellings(word), left, right


def _families() -> list[tuple[int, str, str]]:
    out = []
    for line in FAMILIES.strip().splitlines():
        label, versions, tag, name = (part.strip() for part in line.split("|", 3))
        for version in [v.strip() for v in versions.split(",")]:
            filled = [text.replace("VERSION", VERSION).replace("{v}", version) for text in (tag, name)]
            label_now = label.replace("{v}", version.replace(" ", "."))
            out.append((TAG, label_now, "spdx licen[cs]e @identifier " + filled[0]))
            out.append((NOTICE, label_now, NOTICE_BEFORE + filled[1]))
            out.append((NAME, label_now, filled[1]))
    return out


def rules() -> list[Rule]:
    """All rules in order: among rules that match the same words the first wins."""
    names = {"text": TEXT, "notice": NOTICE, "address": ADDRESS, "name": NAME, "hint": HINT}
    written = [[part.strip() for part in line.split("|", 2)] for line in SIGNATURES.strip().splitlines()]
    listed = [(ALWAYS, label, text) for label, text in BASE] + _families() + [(names[p], label, text) for p, label, text in written]
    listed = [(p, label, text.replace("\\\\", "\\")) for p, label, text in listed]
    return [Rule(i, label, p, STRENGTH[p], p == ALWAYS, *_parse(text)) for i, (p, label, text) in enumerate(listed)]
