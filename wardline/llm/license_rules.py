"""Signatures of licenses over normalised words (lower case, single spaces, no punctuation).

One rule a line: ``label | keyword | pattern``. The keyword is a part of the lower-cased text without which the pattern
cannot occur. Rules stand in order of priority: identifiers, sentences of the license texts, versioned names, plain
names, and hints that some terms apply. Patterns are matched from word to word.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str
    pattern: str


#: Licenses with an identifier of the public SPDX list; each gives a rule for its tag line and one for its page there.
IDENTIFIERS = """
0bsd aal afl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.1 apache-2.0 apsl-2.0 artistic-1.0 artistic-2.0 blueoak-1.0.0
bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 bzip2-1.0.6 cc0-1.0
cc-by-3.0 cc-by-4.0 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0
cddl-1.0 cddl-1.1 cecill-2.1 cecill-b cecill-c cpal-1.0 cpl-1.0 ecl-2.0 efl-2.0 elastic-2.0 epl-1.0 epl-2.0 eupl-1.1
eupl-1.2 fsfap ftl gfdl-1.2-only gfdl-1.3-only gpl-1.0-only gpl-2.0-only gpl-2.0-or-later gpl-3.0-only gpl-3.0-or-later
hpnd icu ijg intel ipl-1.0 isc lgpl-2.0-only lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0-only lgpl-3.0-or-later libpng-2.0
lppl-1.3c mit mit-0 mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa nposl-3.0 odbl-1.0 odc-by-1.0 ofl-1.1 oldap-2.8
openssl osl-3.0 pddl-1.0 php-3.01 postgresql psf-2.0 python-2.0 qpl-1.0 ruby sissl sleepycat spl-1.0 ssh-openssh
sspl-1.0 tcl unicode-3.0 unlicense upl-1.0 vim w3c wtfpl x11 xfree86-1.1 zlib zpl-2.1
""".split()

#: Sentences and addresses that stand in the license texts themselves.
SENTENCES = r"""
mit | charge | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | sublicense | to use copy modify merge publish distribute sublicense and or sell copies of the software
mit | noninfringement | provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
mit-0 | charge | permission is hereby granted free of charge .{0,400} to permit persons to whom the software is furnished to do so the software is provided
bsd | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd | redistributions | redistributions of source code must retain the (?:above|accompanying) copyright notice
bsd | redistributions | redistributions in binary form must reproduce the (?:above|accompanying) copyright notice
bsd-3-clause | endorse | neither the name of .{1,120} may be used to endorse or promote products
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display
bsd-3-clause-clear | patent | no express or implied licenses to any party s patent rights are granted
apache-2.0 | apache | https? www apache org licenses license 2 0(?: txt| html)?
apache-2.0 | license | you may not use this file except in compliance with the license
apache-2.0 | basis | distributed under the license is distributed on an as is basis without warranties or conditions of any kind
apache-1.1 | apache | this product includes software developed by the apache software foundation
gpl | redistribute | you can redistribute it and or modify it under the terms of the gnu general public license
gpl | gnu | you should have received a copy of the gnu general public license
gpl | published | published by the free software foundation either version \d of the license or at your option any later version
gpl | merchantability | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license
gpl | copyleft | the gnu general public license is a free copyleft license
gpl | gnu | https? www gnu org licenses (?:old licenses )?gpl(?: \d 0)?(?: txt| html)?
lgpl | redistribute | you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
lgpl | gnu | you should have received a copy of the gnu (?:lesser|library) general public license
lgpl | gnu | https? www gnu org licenses lgpl(?: \d \d)?(?: txt| html)?
agpl | redistribute | you can redistribute it and or modify it under the terms of the gnu affero general public license
agpl | affero | you should have received a copy of the gnu affero general public license
agpl | gnu | https? www gnu org licenses agpl(?: \d 0)?(?: txt| html)?
gfdl | gnu | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | mozilla | the contents of this file are subject to the mozilla public license version 1 1
mpl-2.0 | mozilla | https? (?:www )?mozilla org mpl 2 0
epl | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license
epl | eclipse | https? www eclipse org (?:legal|org documents) epl (?:v\d{1,2}|2 0)(?: html)?
cddl | distribution | subject to the terms of the common development and distribution license
isc | fee | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
hpnd | fee | permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted
zlib | altered | altered source versions must be plainly marked as such and must not be misrepresented
zlib | origin | the origin of this software must not be misrepresented
bsl-1.0 | boost | https? www boost org license 1 0 txt
bsl-1.0 | boost | boost software license version 1 0 august 17th 2003
unlicense | unencumbered | this is free and unencumbered software released into the public domain
unlicense | unlicense | https? (?:www )?unlicense org
wtfpl | fuck | do what the fuck you want to public license
ofl-1.1 | font | this font software is licensed under the sil open font license version 1 1
ofl-1.1 | sil | https? scripts sil org ofl
cc0-1.0 | neighboring | to the extent possible under law .{1,120} waived all copyright and related or neighboring rights
cc0-1.0 | creativecommons | https? creativecommons org publicdomain zero 1 0
cc-by | creativecommons | https? creativecommons org licenses by \d \d
cc-by-sa | creativecommons | https? creativecommons org licenses by sa \d \d
cc-by-nc | creativecommons | https? creativecommons org licenses by nc \d \d
cc-by-nc-sa | creativecommons | https? creativecommons org licenses by nc sa \d \d
cc-by-nc-nd | creativecommons | https? creativecommons org licenses by nc nd \d \d
cc-by-nd | creativecommons | https? creativecommons org licenses by nd \d \d
public-domain-mark | creativecommons | https? creativecommons org publicdomain mark 1 0
odbl-1.0 | opendatacommons | https? (?:www )?opendatacommons org licenses odbl(?: 1 0)?
odc-by-1.0 | opendatacommons | https? (?:www )?opendatacommons org licenses by(?: 1 0)?
pddl-1.0 | opendatacommons | https? (?:www )?opendatacommons org licenses pddl(?: 1 0)?
openssl | openssl | this product includes software developed by the openssl project
php-3.01 | php | this product includes php software freely available from
python-2.0 | python | python software foundation license version 2
json | evil | the software shall be used for good not evil
beerware | beer | you can buy me a beer in return
sspl-1.0 | server | server side public license version 1 october 16 2018
busl-1.1 | licen | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use
elastic-2.0 | hosted | you may not provide the software to third parties as a hosted or managed service
unicode-3.0 | unicode | https? www unicode org copyright html
w3c | licen | by obtaining and or copying this work you the licensee agree that you have read understood
curl | stenberg | copyright .{1,60} daniel stenberg
"""

#: Names with a version.
VERSIONED = r"""
apache-2.0 | apache | apache (?:software )?(?:public )?licen[sc]e (?:v|v 2|version 2|version 2 0|v2|v2 0|2|2 0)
apache-2.0 | apache | apache 2 0 licen[sc]e
apache-1.1 | apache | apache (?:software )?licen[sc]e (?:v ?|version )?1 1
apache-1.0 | apache | apache (?:software )?licen[sc]e (?:v ?|version )?1 0
gpl-1.0 | gnu | gnu general public licen[sc]e (?:v ?|version )1(?: 0)?
gpl-2.0 | gnu | gnu general public licen[sc]e (?:v ?|version )2(?: 0)?
gpl-3.0 | gnu | gnu general public licen[sc]e (?:v ?|version )3(?: 0)?
gpl-2.0 | gpl | (?:gnu )?gpl(?: ?v ?| version | )2(?: 0)?
gpl-3.0 | gpl | (?:gnu )?gpl(?: ?v ?| version | )3(?: 0)?
lgpl-2.0 | gnu | gnu library general public licen[sc]e (?:v ?|version )2(?: 0)?
lgpl-2.1 | gnu | gnu lesser general public licen[sc]e (?:v ?|version )2 1
lgpl-3.0 | gnu | gnu lesser general public licen[sc]e (?:v ?|version )3(?: 0)?
lgpl-2.1 | lgpl | (?:gnu )?lgpl(?: ?v ?| version | )2 1
lgpl-3.0 | lgpl | (?:gnu )?lgpl(?: ?v ?| version | )3(?: 0)?
agpl-3.0 | affero | (?:gnu )?affero general public licen[sc]e (?:v ?|version )3(?: 0)?
agpl-3.0 | agpl | (?:gnu )?agpl(?: ?v ?| version | )3(?: 0)?
gfdl-1.1 | gnu | gnu free documentation licen[sc]e (?:v ?|version )1 1
gfdl-1.2 | gnu | gnu free documentation licen[sc]e (?:v ?|version )1 2
gfdl-1.3 | gnu | gnu free documentation licen[sc]e (?:v ?|version )1 3
bsd-2-clause | bsd | (?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?
bsd-3-clause | bsd | (?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?
bsd-4-clause | bsd | (?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)(?: licen[sc]e)?
0bsd | bsd | (?:zero clause bsd|bsd zero clause|0bsd)(?: licen[sc]e)?
mpl-1.0 | mozilla | mozilla public licen[sc]e (?:v ?|version )?1 0
mpl-1.1 | mozilla | mozilla public licen[sc]e (?:v ?|version )?1 1
mpl-2.0 | mozilla | mozilla public licen[sc]e (?:v ?|version )?2(?: 0)?
mpl-2.0 | mpl | mpl(?: v)? 2 0
epl-1.0 | eclipse | eclipse public licen[sc]e (?:v ?|version )?1(?: 0)?
epl-2.0 | eclipse | eclipse public licen[sc]e (?:v ?|version )?2(?: 0)?
cddl-1.0 | distribution | common development and distribution licen[sc]e (?:v ?|version )?1 0
cddl-1.1 | distribution | common development and distribution licen[sc]e (?:v ?|version )?1 1
eupl-1.1 | union | european union public licen[sc]e (?:v ?|version )?1 1
eupl-1.2 | union | european union public licen[sc]e (?:v ?|version )?1 2
artistic-1.0 | artistic | artistic licen[sc]e (?:v ?|version )?1(?: 0)?
artistic-2.0 | artistic | artistic licen[sc]e (?:v ?|version )?2(?: 0)?
bsl-1.0 | boost | boost software licen[sc]e (?:v ?|version )?1(?: 0)?
ofl-1.0 | font | (?:sil )?open font licen[sc]e (?:v ?|version )?1 0
ofl-1.1 | font | (?:sil )?open font licen[sc]e (?:v ?|version )?1 1
afl-3.0 | academic | academic free licen[sc]e (?:v ?|version )?3(?: 0)?
osl-3.0 | licen | open software licen[sc]e (?:v ?|version )?3(?: 0)?
lppl-1.3c | latex | latex project public licen[sc]e (?:v ?|version )?1 3c?
cc-by-1.0 | cc | cc by 1 0
cc-by-2.0 | cc | cc by 2 0
cc-by-2.5 | cc | cc by 2 5
cc-by-3.0 | cc | cc by 3 0
cc-by-4.0 | cc | cc by 4 0
cc-by-sa-2.0 | cc | cc by sa 2 0
cc-by-sa-3.0 | cc | cc by sa 3 0
cc-by-sa-4.0 | cc | cc by sa 4 0
cc-by-nc-2.0 | cc | cc by nc 2 0
cc-by-nc-3.0 | cc | cc by nc 3 0
cc-by-nc-4.0 | cc | cc by nc 4 0
cc-by-nc-sa-3.0 | cc | cc by nc sa 3 0
cc-by-nc-sa-4.0 | cc | cc by nc sa 4 0
cc-by-nc-nd-3.0 | cc | cc by nc nd 3 0
cc-by-nc-nd-4.0 | cc | cc by nc nd 4 0
cc-by-nd-3.0 | cc | cc by nd 3 0
cc-by-nd-4.0 | cc | cc by nd 4 0
cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc-by-4.0 | creative | creative commons attribution 4 0(?: international)?(?: licen[sc]e)?
cc-by-sa-4.0 | creative | creative commons attribution share ?alike 4 0(?: international)?(?: licen[sc]e)?
cc-by-nc-4.0 | creative | creative commons attribution non ?commercial 4 0(?: international)?(?: licen[sc]e)?
cc-by-nd-4.0 | creative | creative commons attribution no ?deriv(?:s|atives) 4 0(?: international)?(?: licen[sc]e)?
cc-by-nc-sa-4.0 | creative | creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: licen[sc]e)?
cc-by-nc-nd-4.0 | creative | creative commons attribution non ?commercial no ?deriv(?:s|atives) 4 0(?: international)?(?: licen[sc]e)?
sspl-1.0 | server | server side public licen[sc]e (?:v ?|version )?1
busl-1.1 | business | business source licen[sc]e (?:v ?|version )?1 1
elastic-2.0 | elastic | elastic licen[sc]e (?:v ?|version )?2(?: 0)?
polyform | polyform | polyform (?:noncommercial|small business|strict|shield|perimeter|internal use) licen[sc]e 1 0 0
zpl-2.1 | zope | zope public licen[sc]e (?:v ?|version )?2 1
php-3.01 | php | php licen[sc]e (?:v ?|version )?3 01
cecill-2.1 | cecill | cecill(?: free software licen[sc]e agreement)?(?: v| version)? 2 1
"""

#: Names without a version.
NAMES = r"""
mit | licen | mit licen[sc]e
mit | mit | (?:licensed|released|distributed) under (?:the )?mit
expat | expat | expat licen[sc]e
x11 | x11 | x11 licen[sc]e
apache | apache | apache licen[sc]e
apache | apache | apache software licen[sc]e
gpl | licen | general public licen[sc]e
gpl | gnu | gnu gpl
lgpl | licen | (?:lesser|library) general public licen[sc]e
lgpl | gnu | gnu lgpl
agpl | affero | affero general public licen[sc]e
gfdl | documentation | free documentation licen[sc]e
bsd | bsd | bsd (?:style )?licen[sc]e
isc | isc | isc licen[sc]e
mpl | mozilla | mozilla public licen[sc]e
epl | eclipse | eclipse public licen[sc]e
cddl | distribution | common development and distribution licen[sc]e
cpl | common | common public licen[sc]e
eupl | union | european union public licen[sc]e
artistic | artistic | artistic licen[sc]e
bsl | boost | boost software licen[sc]e
zlib | zlib | zlib (?:libpng )?licen[sc]e
libpng | libpng | libpng licen[sc]e
unlicense | unlicense | the unlicense
wtfpl | wtfpl | wtfpl
ofl | font | open font licen[sc]e
afl | academic | academic free licen[sc]e
osl | licen | open software licen[sc]e
ncsa | illinois | university of illinois(?: ncsa)? open source licen[sc]e
psf | python | python software foundation licen[sc]e
postgresql | postgresql | postgresql licen[sc]e
openssl | openssl | openssl licen[sc]e
ruby | ruby | ruby licen[sc]e
php | php | php licen[sc]e
vim | vim | vim licen[sc]e
ms-pl | microsoft | microsoft public licen[sc]e
ms-rl | microsoft | microsoft reciprocal licen[sc]e
odbl | database | open database licen[sc]e
odc-by | open | open data commons attribution licen[sc]e
cc-by-nc-nd | creative | creative commons attribution non ?commercial no ?deriv(?:s|atives)(?: licen[sc]e)?
cc-by-nc-sa | creative | creative commons attribution non ?commercial share ?alike(?: licen[sc]e)?
cc-by-nc | creative | creative commons attribution non ?commercial(?: licen[sc]e)?
cc-by-sa | creative | creative commons attribution share ?alike(?: licen[sc]e)?
cc-by-nd | creative | creative commons attribution no ?deriv(?:s|atives)(?: licen[sc]e)?
cc-by | creative | creative commons attribution(?: licen[sc]e)?
cc0 | zero | creative commons zero
creative-commons | creative | creative commons licen[sc]e
sspl | server | server side public licen[sc]e
busl | business | business source licen[sc]e
public-domain | public | (?:in|into|to) the public domain
"""

#: Terms that apply without naming a license.
HINTS = r"""
all-rights-reserved | rights | all rights reserved
all-rights-reserved | reproduced | no part of this (?:publication|book|work) may be reproduced
proprietary | proprietary | proprietary and confidential
proprietary | licen | proprietary licen[sc]e
non-commercial | commercial | for (?:personal and )?non ?commercial use only
non-commercial | commercial | not for commercial use
no-derivatives | derivative | no derivative works
eula | licen | end user licen[sc]e agreement
unknown-license | licen | see (?:the )?licen[sc]e(?: file)? for (?:details|more information)
"""


def _block(text: str, priority: int) -> list[Rule]:
    return [Rule(label, priority, keyword, pattern) for label, keyword, pattern in (line.split(" | ", 2) for line in text.strip().split("\n"))]


def _tags() -> list[Rule]:
    rules = []
    for name in IDENTIFIERS:
        words = name.replace("-", " ").replace(".", " ")
        rules.append(Rule(name, 0, "spdx", f"spdx license identifier {words}"))
        rules.append(Rule(name, 0, "spdx", f"spdx org licenses {words}"))
    return rules


RULES: tuple[Rule, ...] = tuple(_tags() + _block(SENTENCES, 1) + _block(VERSIONED, 2) + _block(NAMES, 3) + _block(HINTS, 4))

#: How sure a surviving detection of each priority makes us that the text is under a license.
CONFIDENCE = (1.0, 0.95, 0.9, 0.75, 0.4)
