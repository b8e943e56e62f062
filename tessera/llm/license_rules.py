"""Signature rules for licence texts, as plain patterns over normalised words.

A line is: label | keyword | pattern | weight.  Patterns see lower-case words with one space
between them ("CC BY-SA 4.0" is "cc by sa 4 0").  ``{a,b}`` writes the line once for each
alternative, ``<n>`` in the label being the n-th alternative in use with dashes for spaces;
the order of the lines is the priority.  The keyword is part of every text that the pattern
matches.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

SIGNATURES = r"""
cc-by-<1>-<2> | cc by | cc by {nc sa,nc nd,nc,sa,nd} {1 0,2 0,2 5,3 0,4 0} | 0.95
cc-by-<1> | cc by | cc by {1 0,2 0,2 5,3 0,4 0} | 0.95
cc-by-<1> | cc by | cc by {nc sa,nc nd,nc,sa,nd} | 0.85
cc-by-nc-sa-<1> | creative commons | creative commons attribution non ?commercial share ?alike {1 0,2 0,2 5,3 0,4 0} | 0.98
cc-by-nc-nd-<1> | creative commons | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)? {1 0,2 0,2 5,3 0,4 0} | 0.98
cc-by-nc-<1> | creative commons | creative commons attribution non ?commercial {1 0,2 0,2 5,3 0,4 0} | 0.98
cc-by-sa-<1> | creative commons | creative commons attribution share ?alike {1 0,2 0,2 5,3 0,4 0} | 0.98
cc-by-nd-<1> | creative commons | creative commons attribution no ?deriv(?:ative)?s?(?: works)? {1 0,2 0,2 5,3 0,4 0} | 0.98
cc-by-<1> | creative commons | creative commons attribution {1 0,2 0,2 5,3 0,4 0} | 0.98
cc-by | creative commons | creative commons attribution | 0.85
cc-by-<1>-<2> | creativecommons | creativecommons org licenses by {nc sa,nc nd,nc,sa,nd} {1 0,2 0,2 5,3 0,4 0} | 0.98
cc-by-<1> | creativecommons | creativecommons org licenses by {1 0,2 0,2 5,3 0,4 0} | 0.98
cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)? | 0.95
cc0-1.0 | publicdomain | creativecommons org publicdomain zero 1 0 | 0.98
cc-pdm-1.0 | public domain mark | public domain mark(?: 1 0)? | 0.9
public-domain | public domain | (?:released|dedicated|placed|is) (?:in|into|to) the public domain | 0.85
agpl-<1>-or-later | affero | gnu affero general public license (?:version|v) ?{1,3}(?: 0)? or(?: at your option)? any later version | 0.98
agpl-<1> | affero | gnu affero general public license (?:version |v ?)?{1,3}(?: 0)? | 0.95
agpl | affero | affero general public license | 0.85
agpl-<1> | agpl | agpl (?:v ?)?{1,3}(?: 0)? | 0.9
agpl | agpl | agplv?[0-9]? | 0.8
lgpl-<1>-or-later | lesser | gnu lesser general public license (?:version|v) ?{2 1,3}(?: 0)? or(?: at your option)? any later version | 0.98
lgpl-<1> | lesser | gnu lesser general public license (?:version |v ?)?{2 1,3}(?: 0)? | 0.95
lgpl | lesser | lesser general public license | 0.85
lgpl-2.0 | library general | gnu library general public license(?: version 2)?(?: 0)? | 0.95
lgpl-<1> | lgpl | lgpl (?:v ?)?{2 0,2 1,3 0,3} | 0.9
lgpl | lgpl | lgplv?[0-9]? | 0.8
gpl-<1>-or-later | general public license | gnu general public license (?:version|v) ?{1,2,3}(?: 0)? or(?: at your option)? any later version | 0.98
gpl-<1>-or-later | general public license | general public license as published by the free software foundation either version {1,2,3} | 0.98
gpl-<1>-only | general public license | gnu general public license (?:version|v) ?{1,2,3}(?: 0)? only | 0.98
gpl-<1> | general public license | (?:gnu )?general public license (?:version |v ?)?{1,2,3}(?: 0)? | 0.95
gpl | general public license | gnu general public license | 0.85
gpl-<1> | gpl | (?:gnu )?gpl (?:version |v ?)?{1,2,3}(?: 0)? | 0.9
gpl-<1> | gplv | gplv{1,2,3} | 0.9
gfdl-<1> | free documentation | gnu free documentation license (?:version |v ?)?{1 1,1 2,1 3} | 0.95
gfdl | free documentation | gnu free documentation license | 0.9
apache-<1> | apache | apache (?:software )?license (?:version |v ?)?{1 0,1 1,2 0} | 0.97
apache-<1> | apache | apache {1 0,1 1,2 0} | 0.85
apache-2.0 | apache org | apache org licenses license 2 0 | 0.98
apache | apache | apache (?:software )?license | 0.85
mit | mit license | (?:the )?mit license | 0.95
mit | expat license | expat license | 0.9
mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy | 0.95
mit-0 | mit no attribution | mit no attribution | 0.95
x11 | x11 license | x11 license | 0.9
bsd-<1>-clause | clause | (?:the )?(?:modified |new |simplified )?bsd {0,1,2,3,4} clause(?: license)? | 0.97
bsd-<1>-clause | clause bsd | {0,1,2,3,4} clause bsd(?: license)? | 0.97
bsd-2-clause | simplified bsd | simplified bsd license | 0.93
bsd-3-clause | bsd license | (?:modified|new|revised) bsd license | 0.93
bsd-4-clause | bsd license | original bsd license | 0.93
bsd | bsd license | bsd license | 0.85
bsd | redistribution and use | redistribution and use in source and binary forms with or without modification | 0.9
mpl-<1> | mozilla | mozilla public license (?:version |v ?)?{1 0,1 1,2 0} | 0.97
mpl | mozilla | mozilla public license | 0.87
mpl-<1> | mpl | mpl (?:v ?)?{1 0,1 1,2 0} | 0.9
epl-<1> | eclipse | eclipse public license (?:version |v ?)?{1 0,2 0} | 0.97
epl | eclipse | eclipse public license | 0.87
epl-<1> | epl | epl (?:v ?)?{1 0,2 0} | 0.9
edl-1.0 | eclipse distribution | eclipse distribution license(?: v 1 0)? | 0.93
cddl-<1> | common development | common development and distribution license (?:version |v ?)?{1 0,1 1} | 0.97
cddl-<1> | cddl | cddl (?:v ?)?{1 0,1 1} | 0.9
cpl-1.0 | common public license | common public license(?: version)?(?: 1 0)? | 0.92
cpal-1.0 | common public attribution | common public attribution license(?: version)?(?: 1 0)? | 0.93
eupl-<1> | european union public | european union public licen[cs]e (?:version |v ?)?{1 0,1 1,1 2} | 0.97
eupl-<1> | eupl | eupl (?:v ?)?{1 0,1 1,1 2} | 0.9
artistic-<1> | artistic license | artistic license (?:version |v ?)?{1 0,2 0} | 0.95
artistic | artistic license | (?:perl )?artistic license | 0.87
isc | isc license | (?:the )?isc license | 0.95
isc | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose | 0.9
zlib | zlib | zlib(?: libpng)? license | 0.93
libpng-2.0 | png | (?:png|libpng) (?:reference library )?license(?: version 2)? | 0.9
unlicense | unlicense | (?:the )?unlicense | 0.93
unlicense | unencumbered | free and unencumbered software released into the public domain | 0.97
wtfpl | wtfpl | wtfpl(?: version 2)? | 0.93
bsl-1.0 | boost software | boost software license(?: version)?(?: 1 0)? | 0.95
busl-1.1 | business source | business source license(?: version)?(?: 1 1)? | 0.95
sspl-1.0 | server side public | server side public license(?: version 1| v1)? | 0.95
elastic-2.0 | elastic license | elastic license(?: version)?(?: 2 0)? | 0.93
commons-clause | commons clause | commons clause(?: license condition)?(?: v ?1 0)? | 0.93
postgresql | postgresql license | (?:the )?postgresql license | 0.93
psf-2.0 | python software foundation | python software foundation license(?: version 2)? | 0.95
python-<1> | python license | python license (?:version )?{2 0,2 0 1} | 0.93
php-<1> | php license | php license (?:version |v ?)?{3 0,3 01} | 0.95
php | php license | php license | 0.87
zpl-<1> | zope public | zope public license (?:version |v ?)?{1 1,2 0,2 1} | 0.95
ofl-<1> | open font | sil open font license (?:version |v ?)?{1 0,1 1} | 0.95
ofl | open font | open font license | 0.87
odbl-1.0 | open database | open database license(?: v?1 0)? | 0.93
odc-by-1.0 | open data commons | open data commons attribution license(?: v?1 0)? | 0.95
pddl-1.0 | public domain dedication | (?:open data commons )?public domain dedication and licen[cs]e(?: v?1 0)? | 0.95
cdla-<1>-1.0 | community data | community data license agreement {permissive,sharing}(?: version)?(?: 1 0)? | 0.95
ms-pl | microsoft public | microsoft public license | 0.95
ms-rl | microsoft reciprocal | microsoft reciprocal license | 0.95
afl-<1> | academic free | academic free license (?:version |v ?)?{1 1,1 2,2 0,2 1,3 0} | 0.95
osl-<1> | open software license | open software license (?:version |v ?)?{1 0,1 1,2 0,2 1,3 0} | 0.95
apsl-<1> | apple public source | apple public source license (?:version |v ?)?{1 0,1 1,1 2,2 0} | 0.95
apl-1.0 | adaptive public | adaptive public license(?: version)?(?: 1 0)? | 0.93
ipl-1.0 | ibm public | ibm public license(?: version)?(?: 1 0)? | 0.95
spl-1.0 | sun public | sun public license(?: version)?(?: 1 0)? | 0.95
npl-<1> | netscape public | netscape public license (?:version |v ?)?{1 0,1 1} | 0.95
lppl-<1> | latex project | latex project public license (?:version |v ?)?{1 0,1 1,1 2,1 3a,1 3c} | 0.95
lppl | latex project | latex project public license | 0.87
ncsa | illinois | university of illinois ncsa open source license | 0.95
openssl | openssl license | openssl license | 0.93
ssleay | ssleay | ssleay license | 0.93
ruby | ruby license | ruby license | 0.9
vim | vim license | vim license | 0.9
w3c | w3c software | w3c software (?:notice|and document)(?: and)? license | 0.93
curl | curl license | curl license | 0.9
json | json license | json license | 0.9
beerware | beerware | beerware license(?: revision 42)? | 0.9
sleepycat | sleepycat | sleepycat license | 0.9
qpl-1.0 | q public | q public license(?: version)?(?: 1 0)? | 0.93
rpl-<1> | reciprocal public | reciprocal public license (?:version )?{1 1,1 5} | 0.95
nasa-1.3 | nasa open source | nasa open source agreement(?: version)?(?: 1 3)? | 0.95
upl-1.0 | universal permissive | universal permissive license(?: version| v)?(?: 1 0)? | 0.95
mulan-<1> | mulan | mulan (?:permissive software license|psl) v{1,2} | 0.95
cecill-<1> | cecill | cecill (?:version |v ?)?{1 0,1 1,2 0,2 1,b,c} | 0.93
cecill | cecill | cecill | 0.8
ecl-<1> | educational community | educational community license (?:version )?{1 0,2 0} | 0.95
efl-<1> | eiffel forum | eiffel forum license (?:version )?{1 0,2 0} | 0.93
entessa | entessa | entessa public license | 0.9
frameworx-1.0 | frameworx | frameworx open license(?: 1 0)? | 0.9
hpnd | historical permission | historical permission notice and disclaimer | 0.93
imagemagick | imagemagick license | imagemagick license | 0.9
jasper-2.0 | jasper license | jasper license(?: version)?(?: 2 0)? | 0.9
motosoto | motosoto | motosoto open source license | 0.9
naumen | naumen | naumen public license | 0.9
nokia | nokia open source | nokia open source license | 0.93
ntp | ntp license | ntp license | 0.85
oclc-2.0 | oclc | oclc research public license(?: 2 0)? | 0.93
realnetworks | realnetworks | realnetworks public source license(?: v?1 0)? | 0.93
ricoh | ricoh source | ricoh source code public license | 0.93
sissl | sun industry | sun industry standards source license | 0.93
vovida | vovida | vovida software license | 0.9
watcom-1.0 | watcom | sybase open watcom public license(?: 1 0)? | 0.93
xnet | net license | x ?net license | 0.85
open-rail-m | rail | (?:creativeml )?open ?rail ?m? license | 0.9
ogl-<1> | open government | open government licen[cs]e (?:v|version )?{1 0,2 0,3 0} | 0.95
gutenberg | project gutenberg | project gutenberg license | 0.9
spdx | spdx | spdx license identifier [0-9a-z]+ | 0.8
proprietary | proprietary | proprietary and confidential | 0.85
proprietary | unauthorized | unauthorized (?:copying|reproduction|distribution) .{0,60}prohibited | 0.8
no-redistribution | redistribut | (?:may not be|not be) (?:copied |reproduced )?(?:or )?redistributed | 0.75
non-commercial | commercial | (?:for )?non ?commercial (?:use|purposes) only | 0.75
research-only | research | for research (?:use|purposes) only | 0.75
with-permission | permission | (?:used|reprinted|reproduced) (?:with|by) permission | 0.7
copyright | copyright | copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])* | 0.6
copyright | copyright | copyright (?:c|©) | 0.5
licensed-under | licensed under | licensed under | 0.3
terms-of-use | terms | (?:terms of (?:use|service)|terms and conditions) (?:apply|govern) | 0.4
see-license | license | see (?:the )?license(?: file)? for (?:details|more information) | 0.4
"""


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    keyword: str
    pattern: str
    weight: float


def rules(signatures: str = SIGNATURES) -> list[Rule]:
    """One rule for each alternative of each line, in order of priority."""
    out: list[Rule] = []
    for line in signatures.strip().splitlines():
        # the pattern itself may hold the separator inside brackets, but never between blanks
        label, keyword, pattern, weight = (x.strip() for x in line.split(" | "))
        braces = re.findall(r"\{([^{}]*[a-z ,][^{}]*|[0-9](?:,[0-9])+)\}", pattern)
        braces = [b for b in braces if not re.fullmatch(r"[0-9]+,[0-9]{2,}", b)]
        for chosen in itertools.product(*[b.split(",") for b in braces]):
            p, name = pattern, label
            for k, (b, c) in enumerate(zip(braces, chosen), 1):
                p = p.replace("{" + b + "}", c, 1)
                dots = re.sub(r"(?<=[0-9]) (?=[0-9])", ".", c)
                name = name.replace(f"<{k}>", dots.replace(" ", "-"))
            out.append(Rule(len(out), name, keyword, f"(?<= )(?:{p})(?= )", float(weight)))
    return out
