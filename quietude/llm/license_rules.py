"""Signature rules of the license scan.

One rule a line: ``label | priority | pattern``. A pattern is a regular
expression over words joined by one blank (lower case, no punctuation: "BSD
3-Clause" is ``bsd 3 clause``, "Apache-2.0" is ``apache 2 0``). It matches from
its first word, a literal that gates it: a rule is only tried where that word
stands, so patterns begin with a word that is rare elsewhere. It ends at the
end of a word. Patterns use what Java's and RE2's regular expressions have in
common and no backslash; gaps are bounded, and no pattern spans more than
``WINDOW`` words.

Priorities: 4 a declaration (an SPDX tag, "licensed under ..."), 3 a sentence
of the license text or its standard notice, 2 a name with its version or
variant, 1 a bare name.
"""

from __future__ import annotations

import re
from typing import NamedTuple

WINDOW = 28

#: What a detection of each priority is worth.
WEIGHTS = {0: 0.25, 1: 0.25, 2: 0.5, 3: 0.75, 4: 1.0}


class Rule(NamedTuple):
    label: str
    priority: int
    pattern: str
    base: bool = False

    @property
    def keyword(self) -> str:
        return re.match("[a-z0-9]+", self.pattern).group()


BASE = [Rule("gpl", 0, "gnu general public license", True),
        Rule("apache", 0, "apache license", True),
        Rule("cc-by", 0, "cc by", True),
        Rule("mit", 0, "mit license", True)]

_V = "(?:version |v)?"  # before a number
_LATER = "(?: (?:or|and) (?:later|any later version|at your option any later version)| only)?"

_SIGNATURES = f"""
mit | 2 | mit licen[cs]es?
mit | 2 | mit x11(?: licen[cs]e)?
mit | 2 | mit style licen[cs]e
mit | 1 | mit licen[cs]ed
mit | 2 | expat licen[cs]e
mit | 3 | permission is hereby granted free of charge to any person obtaining a copy(?: of this software)?
mit | 3 | above copyright notice and this permission notice shall be included in all copies or substantial portions
mit | 3 | licensed under the mit licen[cs]e
mit-0 | 2 | mit 0(?: licen[cs]e)?
mit-0 | 2 | mit no attribution(?: licen[cs]e)?
x11 | 2 | x11 licen[cs]e
x11 | 3 | except as contained in this notice the names? of the (?:x consortium|above copyright holders?) shall not be used
isc | 2 | isc licen[cs]e
isc | 3 | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
0bsd | 2 | 0bsd(?: licen[cs]e)?
0bsd | 2 | zero clause bsd(?: licen[cs]e)?
bsd | 1 | bsd licen[cs]ed?
bsd | 1 | bsd style licen[cs]e
bsd-1-clause | 2 | bsd 1 clause(?: licen[cs]e)?
bsd-2-clause | 2 | bsd 2 clause(?: licen[cs]e)?
bsd-2-clause | 2 | simplified bsd(?: licen[cs]e)?
bsd-2-clause | 2 | freebsd licen[cs]e
bsd-2-clause | 2 | two clause bsd(?: licen[cs]e)?
bsd-3-clause | 2 | bsd 3 clause(?: licen[cs]e)?
bsd-3-clause | 2 | new bsd licen[cs]e
bsd-3-clause | 2 | modified bsd licen[cs]e
bsd-3-clause | 2 | revised bsd licen[cs]e
bsd-3-clause | 2 | three clause bsd(?: licen[cs]e)?
bsd-3-clause | 3 | neither the names? of (?:[^ ]+ ){{1,10}}nor the names of (?:its|their) contributors may be used
bsd-4-clause | 2 | bsd 4 clause(?: licen[cs]e)?
bsd-4-clause | 2 | original bsd licen[cs]e
bsd-4-clause | 3 | advertising materials mentioning features or use of this software must display
bsd-protection | 2 | bsd protection licen[cs]e
bsd | 3 | redistribution and use in source and binary forms with or without modification are permitted
bsd | 3 | redistributions of source code must retain the above copyright notice
bsd | 3 | redistributions in binary form must reproduce the above copyright notice
apache-1.0 | 2 | apache licen[cs]e {_V}1 0
apache-1.0 | 2 | apache 1 0
apache-1.1 | 2 | apache (?:software )?licen[cs]e {_V}1 1
apache-1.1 | 2 | apache 1 1
apache-2.0 | 2 | apache licen[cs]e {_V}2(?: 0)?
apache-2.0 | 2 | apache {_V}2(?: 0)?(?: licen[cs]ed?)?
apache-2.0 | 2 | apache2(?: 0)?(?: licen[cs]ed?)?
apache-2.0 | 2 | asl {_V}2(?: 0)?
apache | 1 | apache software licen[cs]e
apache-2.0 | 3 | licensed under the apache licen[cs]e {_V}2 0(?: the license)?
apache | 3 | licensed under the apache (?:software )?licen[cs]e
apache-2.0 | 3 | www apache org licenses license 2 0
apache-2.0 | 3 | http www apache org licenses license 2 0
apache-2.0 | 3 | https www apache org licenses license 2 0
apache-2.0 | 3 | distributed on an as is basis without warranties or conditions of any kind
apache-2.0 | 3 | except in compliance with the license
gpl | 1 | gnu gpl
gpl | 1 | gpl licen[cs]ed?
gpl-1.0 | 2 | gpl {_V}1(?: 0)?{_LATER}
gpl-1.0 | 2 | gnu general public licen[cs]e {_V}1(?: 0)?{_LATER}
gpl-2.0 | 2 | gpl {_V}2(?: 0)?{_LATER}
gpl-2.0 | 2 | gplv2(?: 0)?{_LATER}
gpl-2.0 | 2 | gpl2
gpl-2.0 | 2 | gnu gpl {_V}2(?: 0)?{_LATER}
gpl-2.0 | 2 | gnu general public licen[cs]e {_V}2(?: 0)?{_LATER}
gpl-2.0 | 3 | gnu general public licen[cs]e as published by the free software foundation either version 2(?: of the license)?{_LATER}
gpl-3.0 | 2 | gpl {_V}3(?: 0)?{_LATER}
gpl-3.0 | 2 | gplv3(?: 0)?{_LATER}
gpl-3.0 | 2 | gpl3
gpl-3.0 | 2 | gnu gpl {_V}3(?: 0)?{_LATER}
gpl-3.0 | 2 | gnu general public licen[cs]e {_V}3(?: 0)?{_LATER}
gpl-3.0 | 3 | gnu general public licen[cs]e as published by the free software foundation either version 3(?: of the license)?{_LATER}
gpl | 3 | program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
gpl | 3 | released under the (?:terms of the )?gnu general public licen[cs]e
gpl | 3 | licensed under the (?:terms of the )?gnu general public licen[cs]e
gpl | 3 | received a copy of the gnu general public licen[cs]e
lgpl | 1 | lgpl(?: licen[cs]ed?)?
lgpl | 1 | gnu lesser general public licen[cs]e
lgpl | 1 | gnu library general public licen[cs]e
lgpl-2.0 | 2 | lgpl {_V}2(?: 0)?{_LATER}
lgpl-2.0 | 2 | gnu library general public licen[cs]e {_V}2(?: 0)?{_LATER}
lgpl-2.1 | 2 | lgpl {_V}2 1{_LATER}
lgpl-2.1 | 2 | lgplv2 1{_LATER}
lgpl-2.1 | 2 | gnu lesser general public licen[cs]e {_V}2 1{_LATER}
lgpl-2.1 | 3 | gnu lesser general public licen[cs]e as published by the free software foundation either version 2 1(?: of the license)?{_LATER}
lgpl-3.0 | 2 | lgpl {_V}3(?: 0)?{_LATER}
lgpl-3.0 | 2 | lgplv3(?: 0)?{_LATER}
lgpl-3.0 | 2 | gnu lesser general public licen[cs]e {_V}3(?: 0)?{_LATER}
lgpl-3.0 | 3 | gnu lesser general public licen[cs]e as published by the free software foundation either version 3(?: of the license)?{_LATER}
agpl | 1 | agpl(?: licen[cs]ed?)?
agpl | 1 | affero general public licen[cs]e
agpl | 1 | gnu affero general public licen[cs]e
agpl-1.0 | 2 | affero general public licen[cs]e {_V}1(?: 0)?{_LATER}
agpl-3.0 | 2 | agpl {_V}3(?: 0)?{_LATER}
agpl-3.0 | 2 | agplv3(?: 0)?{_LATER}
agpl-3.0 | 2 | gnu affero general public licen[cs]e {_V}3(?: 0)?{_LATER}
agpl-3.0 | 3 | gnu affero general public licen[cs]e as published by the free software foundation either version 3(?: of the license)?{_LATER}
gfdl | 1 | gfdl
gfdl | 1 | gnu free documentation licen[cs]e
gfdl-1.1 | 2 | gnu free documentation licen[cs]e {_V}1 1{_LATER}
gfdl-1.2 | 2 | gnu free documentation licen[cs]e {_V}1 2{_LATER}
gfdl-1.3 | 2 | gnu free documentation licen[cs]e {_V}1 3{_LATER}
gfdl | 3 | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e
gpl-exception | 2 | classpath exception(?: 2 0)?
gpl-exception | 2 | gcc runtime library exception(?: 3 1)?
gpl-exception | 2 | linking exception
gpl-exception | 3 | special exception (?:[^ ]+ ){{0,12}}permission to link
mpl | 1 | mozilla public licen[cs]e
mpl-1.0 | 2 | mozilla public licen[cs]e {_V}1 0
mpl-1.1 | 2 | mozilla public licen[cs]e {_V}1 1
mpl-1.1 | 2 | mpl {_V}1 1
mpl-2.0 | 2 | mozilla public licen[cs]e {_V}2(?: 0)?
mpl-2.0 | 2 | mpl {_V}2(?: 0)?
mpl-2.0 | 3 | source code form is subject to the terms of the mozilla public licen[cs]e
mpl-2.0 | 3 | mozilla org mpl 2 0
epl | 1 | eclipse public licen[cs]e
epl-1.0 | 2 | eclipse public licen[cs]e {_V}1(?: 0)?
epl-1.0 | 2 | epl {_V}1 0
epl-2.0 | 2 | eclipse public licen[cs]e {_V}2(?: 0)?
epl-2.0 | 2 | epl {_V}2(?: 0)?
edl-1.0 | 2 | eclipse distribution licen[cs]e(?: {_V}1 0)?
cpl-1.0 | 2 | common public licen[cs]e(?: {_V}1 0)?
ibm-pl-1.0 | 2 | ibm public licen[cs]e(?: {_V}1 0)?
cddl | 1 | common development and distribution licen[cs]e
cddl-1.0 | 2 | common development and distribution licen[cs]e {_V}1 0
cddl-1.0 | 2 | cddl {_V}1 0
cddl-1.1 | 2 | common development and distribution licen[cs]e {_V}1 1
cddl-1.1 | 2 | cddl {_V}1 1
cpal-1.0 | 2 | common public attribution licen[cs]e(?: {_V}1 0)?
eupl | 1 | european union public licen[cs]e
eupl-1.1 | 2 | european union public licen[cs]e {_V}1 1
eupl-1.2 | 2 | european union public licen[cs]e {_V}1 2
eupl-1.1 | 2 | eupl {_V}1 1
eupl-1.2 | 2 | eupl {_V}1 2
cecill | 1 | cecill licen[cs]e
cecill-2.1 | 2 | cecill {_V}2 1
cecill-b | 2 | cecill b
cecill-c | 2 | cecill c
artistic | 1 | artistic licen[cs]e
artistic-1.0 | 2 | artistic licen[cs]e {_V}1(?: 0)?
artistic-2.0 | 2 | artistic licen[cs]e {_V}2(?: 0)?
perl | 3 | same terms as perl itself
python-2.0 | 2 | python software foundation licen[cs]e(?: {_V}2)?
python-2.0 | 2 | psf licen[cs]e(?: agreement)?
php-3.01 | 2 | php licen[cs]e(?: {_V}3 01)?
ruby | 2 | ruby licen[cs]e
ruby | 3 | same terms as ruby
openssl | 2 | openssl licen[cs]e
openssl | 3 | includes software developed by the openssl project
openssl | 2 | ssleay licen[cs]e
zlib | 2 | zlib licen[cs]e
zlib | 2 | zlib libpng licen[cs]e
zlib | 3 | altered source versions must be plainly marked as such
libpng | 2 | libpng licen[cs]e
libtiff | 2 | libtiff licen[cs]e
bsl-1.0 | 2 | boost software licen[cs]e(?: {_V}1 0)?
bsl-1.0 | 3 | distributed under the boost software licen[cs]e
unlicense | 2 | unlicense
unlicense | 3 | unencumbered software released into the public domain
wtfpl | 2 | wtfpl
wtfpl | 2 | fuck you want to public licen[cs]e
beerware | 2 | beerware licen[cs]e
beerware | 2 | beer ware licen[cs]e
public-domain | 1 | public domain
public-domain | 3 | released into the public domain
public-domain | 3 | dedicated to the public domain
ncsa | 2 | university of illinois ncsa open source licen[cs]e
ncsa | 2 | ncsa open source licen[cs]e
upl-1.0 | 2 | universal permissive licen[cs]e(?: {_V}1 0)?
afl-3.0 | 2 | academic free licen[cs]e(?: {_V}3 0)?
osl-3.0 | 2 | open software licen[cs]e(?: {_V}3 0)?
ofl-1.1 | 2 | sil open font licen[cs]e(?: {_V}1 1)?
ofl-1.1 | 2 | open font licen[cs]e(?: {_V}1 1)?
ofl-1.1 | 3 | font software is licensed under the sil open font licen[cs]e
lppl-1.3c | 2 | latex project public licen[cs]e(?: {_V}1 3c?)?
lppl-1.3c | 2 | lppl {_V}1 3c?
ms-pl | 2 | microsoft public licen[cs]e
ms-pl | 2 | ms pl
ms-rl | 2 | microsoft reciprocal licen[cs]e
ms-rl | 2 | ms rl
apsl-2.0 | 2 | apple public source licen[cs]e(?: {_V}2 0)?
npl-1.1 | 2 | netscape public licen[cs]e(?: {_V}1 1)?
sleepycat | 2 | sleepycat licen[cs]e
postgresql | 2 | postgresql licen[cs]e
qpl-1.0 | 2 | q public licen[cs]e(?: {_V}1 0)?
rpl-1.5 | 2 | reciprocal public licen[cs]e(?: {_V}1 5)?
sspl-1.0 | 2 | server side public licen[cs]e(?: {_V}1)?
sspl-1.0 | 2 | sspl(?: {_V}1)?
busl-1.1 | 2 | business source licen[cs]e(?: {_V}1 1)?
elastic-2.0 | 2 | elastic licen[cs]e(?: {_V}2(?: 0)?)?
polyform | 2 | polyform (?:noncommercial|small business|shield|strict|perimeter) licen[cs]e(?: 1 0 0)?
commons-clause | 2 | commons clause(?: licen[cs]e condition)?
json | 3 | shall be used for good not evil
unicode | 2 | unicode licen[cs]e(?: agreement)?
w3c | 2 | w3c software (?:notice and )?licen[cs]e
vim | 2 | vim licen[cs]e
tcl | 2 | tcl tk licen[cs]e
curl | 2 | curl licen[cs]e
icu | 2 | icu licen[cs]e
blueoak-1.0.0 | 2 | blue oak model licen[cs]e(?: 1 0 0)?
mulanpsl-2.0 | 2 | mulan permissive software licen[cs]e(?: {_V}2)?
hippocratic | 2 | hippocratic licen[cs]e(?: {_V}[0-9]+(?: [0-9]+)?)?
odbl-1.0 | 2 | open database licen[cs]e(?: {_V}1 0)?
odbl-1.0 | 2 | odbl(?: {_V}1 0)?
odc-by-1.0 | 2 | open data commons attribution licen[cs]e(?: {_V}1 0)?
odc-by-1.0 | 2 | odc by(?: 1 0)?
pddl-1.0 | 2 | open data commons public domain dedication and licen[cs]e(?: 1 0)?
pddl-1.0 | 2 | pddl(?: 1 0)?
cdla-permissive | 2 | community data licen[cs]e agreement permissive(?: {_V}[12] 0)?
cdla-sharing | 2 | community data licen[cs]e agreement sharing(?: {_V}1 0)?
ogl-uk | 2 | open government licen[cs]e(?: {_V}[123](?: 0)?)?
openrail | 2 | openrail(?: m)?(?: licen[cs]e)?
openrail | 2 | bigscience openrail m
llama | 2 | llama (?:[23] )?(?:[123] )?community licen[cs]e(?: agreement)?
creative-commons | 1 | creative commons(?: licen[cs]e)?
cc0-1.0 | 2 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | 2 | creative commons zero(?: {_V}1 0)?
cc0-1.0 | 3 | creative commons cc0 1 0 universal
cc-pdm-1.0 | 2 | creative commons public domain mark(?: 1 0)?
cc-by | 1 | creative commons attribution(?: licen[cs]e)?
cc-by-2.0 | 2 | cc by 2 0
cc-by-2.5 | 2 | cc by 2 5
cc-by-3.0 | 2 | cc by 3 0
cc-by-4.0 | 2 | cc by 4 0
cc-by-2.0 | 2 | creative commons attribution 2 0(?: generic)?
cc-by-3.0 | 2 | creative commons attribution 3 0(?: unported)?
cc-by-4.0 | 2 | creative commons attribution 4 0(?: international)?
cc-by-sa | 2 | cc by sa
cc-by-sa | 2 | creative commons attribution share ?alike
cc-by-sa-2.0 | 2 | cc by sa 2 0
cc-by-sa-3.0 | 2 | cc by sa 3 0
cc-by-sa-4.0 | 2 | cc by sa 4 0
cc-by-sa-3.0 | 2 | creative commons attribution share ?alike 3 0(?: unported)?
cc-by-sa-4.0 | 2 | creative commons attribution share ?alike 4 0(?: international)?
cc-by-nd | 2 | cc by nd
cc-by-nd-4.0 | 2 | cc by nd 4 0
cc-by-nd-4.0 | 2 | creative commons attribution no ?deriv(?:ative)?s 4 0
cc-by-nc | 2 | cc by nc
cc-by-nc-3.0 | 2 | cc by nc 3 0
cc-by-nc-4.0 | 2 | cc by nc 4 0
cc-by-nc-4.0 | 2 | creative commons attribution non ?commercial 4 0(?: international)?
cc-by-nc-sa | 2 | cc by nc sa
cc-by-nc-sa-3.0 | 2 | cc by nc sa 3 0
cc-by-nc-sa-4.0 | 2 | cc by nc sa 4 0
cc-by-nc-sa-4.0 | 2 | creative commons attribution non ?commercial share ?alike 4 0(?: international)?
cc-by-nc-nd | 2 | cc by nc nd
cc-by-nc-nd-4.0 | 2 | cc by nc nd 4 0
cc-by-nc-nd-4.0 | 2 | creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?
cc-by | 3 | creativecommons org licenses by(?: [0-9] [0-9])?
cc-by-sa | 3 | creativecommons org licenses by sa(?: [0-9] [0-9])?
cc-by-nd | 3 | creativecommons org licenses by nd(?: [0-9] [0-9])?
cc-by-nc | 3 | creativecommons org licenses by nc(?: [0-9] [0-9])?
cc-by-nc-sa | 3 | creativecommons org licenses by nc sa(?: [0-9] [0-9])?
cc-by-nc-nd | 3 | creativecommons org licenses by nc nd(?: [0-9] [0-9])?
cc0-1.0 | 3 | creativecommons org publicdomain zero 1 0
proprietary | 2 | rights reserved
proprietary | 3 | proprietary and confidential
proprietary | 3 | unauthorized copying of this file via any medium is strictly prohibited
commercial | 2 | commercial licen[cs]e agreement
commercial | 2 | end user licen[cs]e agreement
freeware | 1 | freeware licen[cs]e
shareware | 1 | shareware licen[cs]e
""" + "".join(
    # "SPDX-License-Identifier: X" and "License :: OSI Approved :: X" declare one license.
    f"{label} | 4 | spdx license identifier {words}\n" for label, words in (
        ("mit", "mit"), ("mit-0", "mit 0"), ("isc", "isc"), ("0bsd", "0bsd"), ("bsd-2-clause", "bsd 2 clause"),
        ("bsd-3-clause", "bsd 3 clause"), ("bsd-4-clause", "bsd 4 clause"), ("apache-2.0", "apache 2 0"),
        ("gpl-2.0", "gpl 2 0(?: only| or later)?"), ("gpl-3.0", "gpl 3 0(?: only| or later)?"),
        ("lgpl-2.1", "lgpl 2 1(?: only| or later)?"), ("lgpl-3.0", "lgpl 3 0(?: only| or later)?"),
        ("agpl-3.0", "agpl 3 0(?: only| or later)?"), ("mpl-2.0", "mpl 2 0"), ("epl-2.0", "epl 2 0"),
        ("cddl-1.0", "cddl 1 0"), ("eupl-1.2", "eupl 1 2"), ("artistic-2.0", "artistic 2 0"), ("zlib", "zlib"),
        ("bsl-1.0", "bsl 1 0"), ("unlicense", "unlicense"), ("cc0-1.0", "cc0 1 0"), ("cc-by-4.0", "cc by 4 0"),
        ("cc-by-sa-4.0", "cc by sa 4 0"), ("ofl-1.1", "ofl 1 1"), ("postgresql", "postgresql"), ("python-2.0", "psf 2 0"))
) + "".join(
    f"{label} | 4 | license osi approved {words}\n" for label, words in (
        ("mit", "mit license"), ("bsd", "bsd license"), ("apache", "apache software license"), ("isc", "isc license iscl"),
        ("gpl-2.0", "gnu general public license v2(?: or later)?(?: gplv2)?"),
        ("gpl-3.0", "gnu general public license v3(?: or later)?(?: gplv3)?"),
        ("lgpl-3.0", "gnu lesser general public license v3(?: or later)?(?: lgplv3)?"),
        ("mpl-2.0", "mozilla public license 2 0(?: mpl 2 0)?"), ("python-2.0", "python software foundation license"))
) + "".join(
    f"{label} | 4 | {verb} under (?:the )?(?:terms of (?:the )?)?{words}\n"
    for verb in ("released", "licensed", "distributed", "available", "published") for label, words in (
        ("mit", "mit(?: licen[cs]e)?"), ("apache-2.0", f"apache(?: licen[cs]e)? {_V}2(?: 0)?"),
        ("bsd", "(?:[^ ]+ ){0,2}bsd(?: licen[cs]e)?"), ("gpl", f"(?:gnu )?gpl(?: {_V}[123])?"),
        ("cc-by", "cc by(?: [0-9] [0-9])?"), ("isc", "isc licen[cs]e"), ("mpl-2.0", f"mpl {_V}2(?: 0)?")))


def _read(lines: str) -> list[Rule]:
    rows = (line.split(" | ", 2) for line in lines.strip().split("\n"))
    return [Rule(label, int(priority), pattern.strip()) for label, priority, pattern in rows]


#: All rules: the base phrases, then the signatures, grouped by keyword (the
#: order in which they are tried; of equal ones the first wins).
RULES: list[Rule] = BASE + sorted(_read(_SIGNATURES), key=lambda r: r.keyword)
