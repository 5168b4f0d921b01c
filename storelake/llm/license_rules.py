"""The signature rules of the licence scan, in order of priority.

One rule a line: label, then a regular expression over words. Words are lower case and
parted by one space; an optional group holds the space after its words. The word in
braces is the rule's keyword: the expression is tried only where this word stands, so
the words on either side of it are the whole context it needs.
"""

from __future__ import annotations

import re
from typing import NamedTuple

#: Sentences that are part of a licence or grant it in its own words.
NOTICES = """
mit | permission is {hereby} granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | the software is provided as is without {warranty} of any kind express or implied including but not limited to the warranties of merchantability
isc | permission to use copy modify and or distribute this software for any purpose with or without fee is {hereby} granted
isc | the software is provided as is and the author {disclaims} all warranties with regard to this software
bsd | {redistribution} and use in source and binary forms with or without modification are permitted
bsd | {redistributions} of source code must retain the above copyright notice
bsd | {redistributions} in binary form must reproduce the above copyright notice
bsd-3 | neither the name of .{0,80}nor the names of its contributors may be used to {endorse} or promote products
bsd-4 | all advertising materials mentioning features or use of this software must display the following {acknowledgement}
apache-2 | licensed under the {apache} license version 2 (0 )?the license you may not use this file except in compliance
apache-2 | unless required by applicable law or agreed to in writing software {distributed} under the license is distributed on an as is basis
gpl | you can {redistribute} it and or modify it under the terms of the gnu general public license
lgpl | you can {redistribute} it and or modify it under the terms of the gnu (lesser |library )general public license
agpl | you can {redistribute} it and or modify it under the terms of the gnu affero general public license
gpl | you should have received a copy of the {gnu} general public license
lgpl | you should have received a copy of the {gnu} (lesser |library )general public license
agpl | you should have received a copy of the {gnu} affero general public license
gpl | everyone is permitted to copy and distribute {verbatim} copies of this license document
mpl-2 | this source code form is subject to the terms of the {mozilla} public license v (2 0 )?
mpl-1.1 | the contents of this file are subject to the {mozilla} public license version 1 1
cddl | the contents of this file are subject to the terms of the common {development} and distribution license
epl | this program and the accompanying materials are made available under the terms of the {eclipse} public license
unlicense | this is free and {unencumbered} software released into the public domain
unlicense | anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a {compiled} binary
zlib | this software is provided as is without any express or implied warranty in no event will the authors be {held} liable
zlib | altered source versions must be {plainly} marked as such
boost | permission is {hereby} granted free of charge to any person or organization obtaining a copy of the software
wtfpl | do what the {fuck} you want to public license
cc0 | to the extent possible under law .{0,80}has {waived} all copyright and related or neighboring rights
public-domain | has been {dedicated} to the public domain
ofl | this font software is licensed under the {sil} open font license
artistic | the intent of this document is to state the conditions under which a {package} may be copied
postgresql | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is {hereby} granted
python | subject to the terms and conditions of this license agreement {psf} hereby grants
openssl | this product includes software developed by the {openssl} project
proprietary | all rights {reserved} (no part of this |unauthorized |reproduction )
proprietary | {unauthorized} copying of this file via any medium is strictly prohibited
proprietary | this software is {proprietary} and confidential
proprietary | no part of this (publication |work |document |book )may be {reproduced}
proprietary | for {internal} use only
"""

#: Identifiers as tools write them: spdx license identifier, license field, deed addresses.
TAGS = """
mit | spdx license identifier {mit}
mit-0 | spdx license identifier {mit} 0
mit | spdx license identifier {expat}
x11 | spdx license identifier {x11}
apache-2 | spdx license identifier {apache} 2 0
apache-1.1 | spdx license identifier {apache} 1 1
apache-1 | spdx license identifier {apache} 1 0
gpl-1 | spdx license identifier {gpl} 1 0 (only |or later )?
gpl-2 | spdx license identifier {gpl} 2 0 (only )?
gpl-2+ | spdx license identifier {gpl} 2 0 or later
gpl-3 | spdx license identifier {gpl} 3 0 (only )?
gpl-3+ | spdx license identifier {gpl} 3 0 or later
lgpl-2 | spdx license identifier {lgpl} 2 0 (only )?
lgpl-2.1 | spdx license identifier {lgpl} 2 1 (only )?
lgpl-2.1+ | spdx license identifier {lgpl} 2 1 or later
lgpl-3 | spdx license identifier {lgpl} 3 0 (only )?
lgpl-3+ | spdx license identifier {lgpl} 3 0 or later
agpl-3 | spdx license identifier {agpl} 3 0 (only )?
agpl-3+ | spdx license identifier {agpl} 3 0 or later
bsd-2 | spdx license identifier {bsd} 2 clause
bsd-3 | spdx license identifier {bsd} 3 clause
bsd-4 | spdx license identifier {bsd} 4 clause
0bsd | spdx license identifier {0bsd}
isc | spdx license identifier {isc}
mpl-1.1 | spdx license identifier {mpl} 1 1
mpl-2 | spdx license identifier {mpl} 2 0
epl-1 | spdx license identifier {epl} 1 0
epl-2 | spdx license identifier {epl} 2 0
cddl | spdx license identifier {cddl} 1 (0 |1 )
eupl | spdx license identifier {eupl} 1 (0 |1 |2 )
cecill | spdx license identifier {cecill} (b |c |2 0 |2 1 )?
artistic | spdx license identifier {artistic} (1 |2 )0
boost | spdx license identifier {bsl} 1 0
busl | spdx license identifier {busl} 1 1
zlib | spdx license identifier {zlib}
unlicense | spdx license identifier {unlicense}
wtfpl | spdx license identifier {wtfpl}
cc0 | spdx license identifier {cc0} 1 0
cc-by | spdx license identifier {cc} by [1-4] [05]
cc-by-sa | spdx license identifier {cc} by sa [1-4] [05]
cc-by-nc | spdx license identifier {cc} by nc [1-4] [05]
cc-by-nd | spdx license identifier {cc} by nd [1-4] [05]
cc-by-nc-sa | spdx license identifier {cc} by nc sa [1-4] [05]
cc-by-nc-nd | spdx license identifier {cc} by nc nd [1-4] [05]
ofl | spdx license identifier {ofl} 1 (0 |1 )
odbl | spdx license identifier {odbl} 1 0
postgresql | spdx license identifier {postgresql}
python | spdx license identifier {psf} 2 0
sspl | spdx license identifier {sspl} 1 0
ncsa | spdx license identifier {ncsa}
upl | spdx license identifier {upl} 1 0
blueoak | spdx license identifier {blueoak} 1 0 0
mulan | spdx license identifier {mulanpsl} [12] 0
cc-by | {creativecommons} org licenses by [1-4] [05]
cc-by-sa | {creativecommons} org licenses by sa [1-4] [05]
cc-by-nc | {creativecommons} org licenses by nc [1-4] [05]
cc-by-nd | {creativecommons} org licenses by nd [1-4] [05]
cc-by-nc-sa | {creativecommons} org licenses by nc sa [1-4] [05]
cc-by-nc-nd | {creativecommons} org licenses by nc nd [1-4] [05]
cc0 | {creativecommons} org publicdomain zero 1 0
public-domain | {creativecommons} org publicdomain mark 1 0
apache-2 | {apache} org licenses license 2 0
gpl | {gnu} org licenses (old licenses )?gpl
lgpl | {gnu} org licenses (old licenses )?lgpl
agpl | {gnu} org licenses agpl
mpl-2 | {mozilla} org mpl 2 0
mpl-2 | {mozilla} org en us mpl 2 0
mit | {opensource} org licenses mit
bsd-2 | {opensource} org licenses bsd 2 clause
bsd-3 | {opensource} org licenses bsd 3 clause
isc | {opensource} org licenses isc
wtfpl | {wtfpl} net
unlicense | {unlicense} org
odbl | {opendatacommons} org licenses odbl
pddl | {opendatacommons} org licenses pddl
odc-by | {opendatacommons} org licenses by
ofl | scripts {sil} org ofl
"""

#: A licence by its name and version, or in a sentence that applies it.
NAMES = """
mit | (released |licensed |distributed |available |published |provided )under (the )?(terms of the )?{mit} licen[sc]e
mit | (sous |unter der |bajo la )(licence |lizenz |licencia )?{mit}
mit | (this )?(is )?{mit} licensed
mit | {expat} licen[sc]e
x11 | {x11} licen[sc]e
apache-2 | (licensed |released |distributed |available |published )?(under )?(the )?{apache} licen[sc]e (version |v )?2 (0 )?
apache-2 | {apache} (software )?licen[sc]e v2 (0 )?
apache-2 | {apache} 2 (0 )?licen[sc]e
apache-2 | {apache2} licen[sc]ed?
apache-1.1 | {apache} (software )?licen[sc]e (version |v )?1 1
apache-1 | {apache} (software )?licen[sc]e (version |v )?1 0
gpl-3 | (licensed |released |distributed )?(under )?(the )?(terms of the )?{gnu} general public licen[sc]e (version |v )?3 (0 )?
gpl-3+ | {gnu} general public licen[sc]e (version |v )?3 (0 )?or (any )?(later |newer )
gpl-2 | (licensed |released |distributed )?(under )?(the )?(terms of the )?{gnu} general public licen[sc]e (version |v )?2 (0 )?
gpl-2+ | {gnu} general public licen[sc]e (version |v )?2 (0 )?or (any )?(later |newer )
gpl-1 | {gnu} general public licen[sc]e (version |v )?1 (0 )?
gpl-3 | {gnu} gpl (version |v )?3 (0 )?
gpl-3 | {gnu} gpl v3
gpl-2 | {gnu} gpl (version |v )?2 (0 )?
gpl-2 | {gnu} gpl v2
gpl-3 | {gpl} (version |v )?3 (0 )?
gpl-2 | {gpl} (version |v )?2 (0 )?
gpl-3 | {gpl} v3 (0 )?
gpl-2 | {gpl} v2 (0 )?
gpl-3 | {gplv3}
gpl-3+ | {gplv3} or (any )?later
gpl-2 | {gplv2}
gpl-2+ | {gplv2} or (any )?later
lgpl-3 | {gnu} (lesser |library )general public licen[sc]e (version |v )?3 (0 )?
lgpl-2.1 | {gnu} (lesser |library )general public licen[sc]e (version |v )?2 1
lgpl-2 | {gnu} (lesser |library )general public licen[sc]e (version |v )?2 (0 )?
lgpl-3 | {lgpl} (version |v )?3 (0 )?
lgpl-2.1 | {lgpl} (version |v )?2 1
lgpl-3 | {lgplv3}
lgpl-2.1 | {lgplv2} 1
agpl-3 | {gnu} affero general public licen[sc]e (version |v )?3 (0 )?
agpl-3+ | {gnu} affero general public licen[sc]e (version |v )?3 (0 )?or (any )?later
agpl-3 | {agpl} (version |v )?3 (0 )?
agpl-3 | {agplv3}
gfdl | {gnu} free documentation licen[sc]e
gfdl-1.3 | {gnu} free documentation licen[sc]e (version |v )?1 3
gfdl-1.2 | {gnu} free documentation licen[sc]e (version |v )?1 2
gfdl | {gfdl}
bsd-2 | (simplified |freebsd |2 clause |two clause ){bsd} licen[sc]e
bsd-3 | (new |modified |revised |3 clause |three clause ){bsd} licen[sc]e
bsd-4 | (original |old |4 clause |four clause ){bsd} licen[sc]e
bsd-2 | {bsd} (2 |two )clause (licen[sc]e )?
bsd-3 | {bsd} (3 |three )clause (licen[sc]e )?
bsd-4 | {bsd} (4 |four )clause (licen[sc]e )?
0bsd | (zero clause |free public ){bsd} (licen[sc]e )?
isc | (under )?(the )?{isc} licen[sc]e
mpl-2 | {mozilla} public licen[sc]e (version |v )?2 (0 )?
mpl-1.1 | {mozilla} public licen[sc]e (version |v )?1 1
mpl-1 | {mozilla} public licen[sc]e (version |v )?1 0
mpl-2 | {mpl} (version |v )?2 (0 )?
mpl-1.1 | {mpl} (version |v )?1 1
epl-2 | {eclipse} public licen[sc]e (version |v )?2 (0 )?
epl-1 | {eclipse} public licen[sc]e (version |v )?1 (0 )?
epl-2 | {epl} (version |v )?2 0
epl-1 | {epl} (version |v )?1 0
eupl | {european} union public licen[sc]e (version |v )?(1 [012] )?
eupl | {eupl} (version |v )?1 [012]
cddl | common {development} and distribution licen[sc]e (version |v )?(1 [01] )?
cpl | {ibm} common public licen[sc]e
ibm | {ibm} public licen[sc]e
cecill | {cecill} (b |c )?(licen[sc]e |free software )
artistic-2 | {artistic} licen[sc]e (version |v )?2 (0 )?
artistic-1 | {artistic} licen[sc]e (version |v )?1 (0 )?
boost | {boost} software licen[sc]e (version |v )?(1 0 )?
busl | {business} source licen[sc]e (version |v )?(1 1 )?
sspl | server side public licen[sc]e (version |v )?(1 )?{sspl}
sspl | {server} side public licen[sc]e
elastic-2 | {elastic} licen[sc]e (version |v )?2 (0 )?
commons-clause | {commons} clause (license )?condition
zlib | {zlib} (libpng )?licen[sc]e
libpng | {libpng} licen[sc]e
openssl | {openssl} licen[sc]e
postgresql | {postgresql} licen[sc]e
python | {python} software foundation licen[sc]e
zope | {zope} public licen[sc]e
php | {php} licen[sc]e (version |v )?(3 0 |3 01 )?
ruby | {ruby} licen[sc]e
perl | same terms as {perl} itself
vim | {vim} licen[sc]e
tcl | {tcl} tk licen[sc]e
ms-pl | {microsoft} public licen[sc]e
ms-rl | {microsoft} reciprocal licen[sc]e
ncsa | university of {illinois} (ncsa )?open source licen[sc]e
upl | {universal} permissive licen[sc]e
osl | {open} software licen[sc]e (version |v )?3 0
afl | {academic} free licen[sc]e
w3c | {w3c} software (notice and )?licen[sc]e
ofl | {sil} open font licen[sc]e (version |v )?(1 1 )?
odbl | open {database} licen[sc]e
odc-by | open data commons {attribution} licen[sc]e
pddl | public domain {dedication} and licen[sc]e
cc-by-nc | (licensed |released |available |published )?under (a )?(the )?{cc} by nc ([1-4] [05] )?
cc-by-nc-sa | {cc} by nc sa ([1-4] [05] )?
cc-by-nc-nd | {cc} by nc nd ([1-4] [05] )?
cc-by-nc | {cc} by nc ([1-4] [05] )?
cc-by-sa | {cc} by sa ([1-4] [05] )?
cc-by-nd | {cc} by nd ([1-4] [05] )?
cc-by | {cc} by [1-4] [05]
cc0 | {cc} zero
cc0 | {cc0} (1 0 )?(universal )?
cc-by | {creative} commons attribution ([1-4] [05] )?(international |unported |generic )?(licen[sc]e )?
cc-by-sa | {creative} commons attribution share ?alike ([1-4] [05] )?(international |unported |generic )?(licen[sc]e )?
cc-by-sa | {creative} commons attribution sharealike ([1-4] [05] )?(international |unported |generic )?(licen[sc]e )?
cc-by-nc | {creative} commons attribution non ?commercial ([1-4] [05] )?(international |unported |generic )?(licen[sc]e )?
cc-by-nc | {creative} commons attribution noncommercial ([1-4] [05] )?(international |unported |generic )?(licen[sc]e )?
cc-by-nd | {creative} commons attribution no ?derivs ([1-4] [05] )?(licen[sc]e )?
cc-by-nd | {creative} commons attribution noderivatives ([1-4] [05] )?(licen[sc]e )?
cc-by-nc-sa | {creative} commons attribution non ?commercial share ?alike ([1-4] [05] )?(licen[sc]e )?
cc-by-nc-sa | {creative} commons attribution noncommercial sharealike ([1-4] [05] )?(licen[sc]e )?
cc-by-nc-nd | {creative} commons attribution noncommercial no ?derivs ([1-4] [05] )?(licen[sc]e )?
cc0 | {creative} commons zero (licen[sc]e )?
public-domain | released (in)?to the public {domain}
public-domain | (placed |released |is )in the public {domain}
unlicense | (under )?the {unlicense}
wtfpl | (under )?the {wtfpl}
jquery | {jquery} licen[sc]e
beerware | {beerware} licen[sc]e
curl | {curl} licen[sc]e
json | {json} licen[sc]e
ssh | {openssh} licen[sc]e
oracle-bcl | {oracle} binary code licen[sc]e
nvidia | {nvidia} software licen[sc]e
llama | {llama} (2 |3 )?community licen[sc]e
rail | {openrail} (m )?licen[sc]e
rail | responsible ai licen[sc]e {rail}
"""

#: A family of licences, version unknown.
MENTIONS = """
mit | {mit} licen[sc]e
apache | {apache} (software )?licen[sc]e
gpl | {gnu} general public licen[sc]e
gpl | {gnu} gpl
gpl | {gpl} licen[sc]ed?
lgpl | {gnu} (lesser |library )general public licen[sc]e
lgpl | {lgpl} licen[sc]ed?
agpl | {gnu} affero general public licen[sc]e
agpl | {agpl} licen[sc]ed?
bsd | {bsd} (style )?licen[sc]ed?
mpl | {mozilla} public licen[sc]e
mpl | {mpl} licen[sc]ed?
epl | {eclipse} public licen[sc]e
artistic | {artistic} licen[sc]e
creative-commons | {creative} commons (licen[sc]ed? )?
elastic | {elastic} licen[sc]e
public-domain | public {domain} (work |dedication |notice |mark )
shared-source | {shared} source initiative
freeware | is {freeware}
shareware | is {shareware}
proprietary | {proprietary} licen[sc]e
all-rights | all rights {reserved}
all-rights | tous droits {réservés}
all-rights | alle rechte {vorbehalten}
all-rights | todos los derechos {reservados}
"""

#: By level: the rules, and how sure a detection of that level is.
LEVELS = ((NOTICES, 1.0), (TAGS, 0.95), (NAMES, 0.85), (MENTIONS, 0.5))


class Rule(NamedTuple):
    """A rule taken apart at its keyword."""

    level: int
    label: str
    keyword: str
    before: str
    after: str
    sure: float


def parsed(line: str, level: int, sure: float) -> Rule:
    """``before`` ends at the keyword, ``after`` begins with it; both hold whole words.

    ``before`` is matched on words with a space on either side, ``after`` on words with
    a space behind each.
    """
    label, pattern = line.split(" | ", 1)
    before, keyword, after = re.fullmatch(r"(.*)\{(\S+)\}(.*)", pattern).groups()
    after = after.strip() if not after.endswith(" )?") else after.removeprefix(" ")
    if after and not after.endswith(" )?") and not after.endswith(" )"):
        after += " "
    return Rule(level, label, keyword, f" (?:{before})$", f"^{keyword} (?:{after})", sure)


def rules_of(levels=LEVELS) -> list[Rule]:
    """All rules in order of priority."""
    return [
        parsed(line, level, sure)
        for level, (lines, sure) in enumerate(levels, 1)
        for line in lines.strip().splitlines()
    ]


RULES = rules_of()
