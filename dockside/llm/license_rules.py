"""Signature rules of the license scan, one to a line.

A rule reads ``label | priority | keywords | pattern``.  Patterns are matched against the
lower-cased words of a text joined by single spaces, so that punctuation, comment marks and line
breaks play no part (``Apache-2.0`` is ``apache 2 0``), and always cover whole words.  Every match
of a pattern holds one of its keywords as a word.  Priorities: 1 a tag, an address or a sentence
of the license itself, 2 a full name with its version, 3 a name, 4 a mention.
"""

from __future__ import annotations

from dataclasses import dataclass

_RULES = """
mit | 1 | spdx | spdx license identifier mit
mit | 1 | permission | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?: the software)? to deal in the software without restriction
mit | 1 | merchantability | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
mit | 1 | opensource | opensource org licenses? mit(?: license)?(?: php)?
mit | 2 | mit | (?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of the )?mit (?:license|licence)
mit | 3 | mit | (?:the )?mit (?:license|licence)(?: mit)?
mit | 3 | expat | expat (?:license|licence)
mit | 3 | mit | mit style (?:license|licence)
mit-0 | 1 | spdx | spdx license identifier mit 0
mit-0 | 2 | mit | mit no attribution(?: license)?
x11 | 3 | x11 | x11 (?:license|licence)
x11 | 1 | consortium | except as contained in this notice the name of the x consortium shall not be used in advertising
apache-2.0 | 1 | spdx | spdx license identifier apache 2 0
apache-2.0 | 1 | apache | (?:https? )?(?:www )?apache org licenses license 2 0(?: txt| html)?
apache-2.0 | 1 | apache | licensed under the apache license version 2 0(?: the license)? you may not use this file except in compliance with the license
apache-2.0 | 2 | apache | apache (?:software )?(?:license|licence)(?: version| v)? 2(?: 0)?
apache-2.0 | 2 | apache | apache (?:license|licence) v2(?: 0)?
apache-2.0 | 3 | apache | apache 2(?: 0)?(?: license| licence)?
apache-2.0 | 3 | asl | asl 2 0
apache-1.1 | 1 | spdx | spdx license identifier apache 1 1
apache-1.1 | 2 | apache | apache (?:software )?license(?: version| v)? 1 1
apache-1.0 | 1 | spdx | spdx license identifier apache 1 0
apache-1.0 | 2 | apache | apache (?:software )?license(?: version| v)? 1 0
gpl-1.0 | 2 | gnu | gnu general public license(?: gpl)?(?: version| v)? 1(?: 0)?
gpl-2.0 | 1 | gnu | under the terms of the gnu general public license version 2 as published by the free software foundation
gpl-2.0 | 1 | gnu | (?:www )?gnu org licenses (?:old licenses )?gpl 2 0(?: txt| html)?
gpl-2.0 | 2 | gnu | gnu general public license(?: gpl)?(?: version| v)? 2(?: 0)?
gpl-2.0 | 2 | gnu | gnu gpl(?: version| v)? 2(?: 0)?
gpl-2.0 | 3 | gplv2 | (?:gnu )?gplv2(?: 0)?
gpl-2.0 | 3 | gpl | gpl(?: version| v)? 2(?: 0)?
gpl-2.0 | 3 | gpl2 | gpl2
gpl-2.0-only | 1 | spdx | spdx license identifier gpl 2 0(?: only)?
gpl-2.0-or-later | 1 | spdx | spdx license identifier gpl 2 0 or later
gpl-2.0-or-later | 1 | gnu | gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-2.0-or-later | 2 | gnu | gnu general public license(?: version| v)? 2(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
gpl-2.0-or-later | 3 | gplv2 | gplv2 or (?:any )?later
gpl-3.0 | 1 | gnu | (?:www )?gnu org licenses gpl 3 0(?: txt| html| en html)?
gpl-3.0 | 2 | gnu | gnu general public license(?: gpl)?(?: version| v)? 3(?: 0)?
gpl-3.0 | 2 | gnu | gnu gpl(?: version| v)? 3(?: 0)?
gpl-3.0 | 3 | gplv3 | (?:gnu )?gplv3(?: 0)?
gpl-3.0 | 3 | gpl | gpl(?: version| v)? 3(?: 0)?
gpl-3.0 | 3 | gpl3 | gpl3
gpl-3.0-only | 1 | spdx | spdx license identifier gpl 3 0(?: only)?
gpl-3.0-or-later | 1 | spdx | spdx license identifier gpl 3 0 or later
gpl-3.0-or-later | 1 | gnu | gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-3.0-or-later | 2 | gnu | gnu general public license(?: version| v)? 3(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
gpl-3.0-or-later | 3 | gplv3 | gplv3 or (?:any )?later
gpl | 1 | gnu | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl | 1 | gnu | (?:www )?gnu org (?:licenses|copyleft) gpl(?: txt| html)?
gpl | 1 | gnu | you should have received a copy of the gnu general public license along with this program
gpl | 3 | gnu | gnu gpl
gpl | 3 | gpl | (?:licensed|released|distributed) under (?:the )?(?:terms of the )?gpl
gpl | 4 | gpl | gpl (?:license|licence|licensed|compatible)
gpl-classpath-exception | 2 | classpath | gpl(?: 2 0)? with (?:the )?classpath exception(?: 2 0)?
gpl-classpath-exception | 1 | statically | linking this library statically or dynamically with other modules is making a combined work
lgpl-2.0 | 2 | gnu | gnu library general public license(?: version| v)?(?: 2)?(?: 0)?
lgpl-2.1 | 1 | gnu | (?:www )?gnu org licenses (?:old licenses )?lgpl 2 1(?: txt| html)?
lgpl-2.1 | 2 | gnu | gnu lesser general public license(?: lgpl)?(?: version| v)? 2 1
lgpl-2.1 | 3 | lgplv2 | lgplv2(?: 1)?
lgpl-2.1 | 3 | lgpl | lgpl(?: version| v)? 2 1
lgpl-2.1-only | 1 | spdx | spdx license identifier lgpl 2 1(?: only)?
lgpl-2.1-or-later | 1 | spdx | spdx license identifier lgpl 2 1 or later
lgpl-2.1-or-later | 1 | gnu | gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
lgpl-3.0 | 1 | gnu | (?:www )?gnu org licenses lgpl 3 0(?: txt| html)?
lgpl-3.0 | 2 | gnu | gnu lesser general public license(?: lgpl)?(?: version| v)? 3(?: 0)?
lgpl-3.0 | 3 | lgplv3 | lgplv3
lgpl-3.0 | 3 | lgpl | lgpl(?: version| v)? 3(?: 0)?
lgpl-3.0-only | 1 | spdx | spdx license identifier lgpl 3 0(?: only)?
lgpl-3.0-or-later | 1 | spdx | spdx license identifier lgpl 3 0 or later
lgpl | 1 | gnu | this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license
lgpl | 3 | gnu | gnu lesser general public license
lgpl | 3 | gnu | gnu lgpl
lgpl | 4 | lgpl | lgpl (?:license|licence|licensed)
agpl-3.0 | 1 | gnu | (?:www )?gnu org licenses agpl 3 0(?: txt| html| en html)?
agpl-3.0 | 2 | gnu | gnu affero general public license(?: agpl)?(?: version| v)? 3(?: 0)?
agpl-3.0 | 3 | agplv3 | agplv3
agpl-3.0 | 3 | agpl | agpl(?: version| v)? 3(?: 0)?
agpl-3.0-only | 1 | spdx | spdx license identifier agpl 3 0(?: only)?
agpl-3.0-or-later | 1 | spdx | spdx license identifier agpl 3 0 or later
agpl-3.0-or-later | 1 | affero | gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
agpl | 3 | affero | (?:gnu )?affero general public license
agpl | 4 | agpl | agpl (?:license|licence|licensed)
gfdl-1.3 | 2 | gnu | gnu free documentation license(?: version| v)? 1 3
gfdl-1.2 | 2 | gnu | gnu free documentation license(?: version| v)? 1 2
gfdl | 1 | gnu | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl | 1 | gnu | (?:www )?gnu org (?:licenses|copyleft) fdl(?: 1 [0-9])?(?: txt| html)?
gfdl | 3 | gnu | gnu free documentation license
gfdl | 3 | gfdl | gfdl(?: 1 [0-9])?
bsd-2-clause | 1 | spdx | spdx license identifier bsd 2 clause
bsd-2-clause | 1 | opensource | opensource org licenses bsd 2 clause
bsd-2-clause | 2 | bsd | (?:simplified|freebsd|2 clause|two clause) bsd (?:license|licence)
bsd-2-clause | 2 | bsd | bsd 2 clause(?: simplified)?(?: license| licence)?
bsd-2-clause-patent | 1 | bsd | bsd 2 clause (?:plus )?patent(?: license)?
bsd-3-clause | 1 | spdx | spdx license identifier bsd 3 clause
bsd-3-clause | 1 | opensource | opensource org licenses bsd (?:3 clause|license(?: php)?)
bsd-3-clause | 1 | endorse | neither the names? of (?:\\S+ ){1,8}nor the names of (?:its|any) contributors may be used to endorse or promote products
bsd-3-clause | 2 | bsd | (?:new|modified|revised|3 clause|three clause) bsd (?:license|licence)
bsd-3-clause | 2 | bsd | bsd 3 clause(?: new| revised| new or revised)?(?: license| licence)?
bsd-3-clause-clear | 1 | bsd | bsd 3 clause clear(?: license)?
bsd-4-clause | 1 | spdx | spdx license identifier bsd 4 clause
bsd-4-clause | 1 | advertising | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-4-clause | 2 | bsd | (?:original|old|4 clause|four clause) bsd (?:license|licence)
bsd-4-clause | 2 | bsd | bsd 4 clause(?: license| licence)?
0bsd | 1 | spdx | spdx license identifier 0bsd
0bsd | 2 | bsd | zero clause bsd(?: license)?
0bsd | 3 | 0bsd | 0bsd
bsd | 1 | redistribution | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd | 1 | redistributions | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd | 1 | redistributions | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd | 3 | bsd | bsd (?:style )?(?:license|licence|licensed)
isc | 1 | spdx | spdx license identifier isc
isc | 1 | permission | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
isc | 2 | isc | (?:the )?isc (?:license|licence)
isc | 2 | consortium | internet (?:systems|software) consortium license
mpl-1.0 | 2 | mozilla | mozilla public license(?: version| v)? 1 0
mpl-1.1 | 1 | spdx | spdx license identifier mpl 1 1
mpl-1.1 | 1 | mozilla | (?:www )?mozilla org mpl (?:mpl )?1 1(?: html| txt)?
mpl-1.1 | 2 | mozilla | mozilla public license(?: version| v)? 1 1
mpl-2.0 | 1 | spdx | spdx license identifier mpl 2 0
mpl-2.0 | 1 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | 1 | mozilla | mozilla org (?:en us )?mpl 2 0
mpl-2.0 | 2 | mozilla | mozilla public license(?: mpl)?(?: version| v)? 2(?: 0)?
mpl-2.0 | 3 | mpl | mpl(?: version| v)? 2(?: 0)?
mpl | 3 | mozilla | mozilla public license
npl-1.1 | 2 | netscape | netscape public license(?: version| v)? 1 [01]
epl-1.0 | 1 | spdx | spdx license identifier epl 1 0
epl-1.0 | 1 | eclipse | (?:www )?eclipse org legal epl v10(?: html)?
epl-1.0 | 2 | eclipse | eclipse public license(?: version| v)? 1(?: 0)?
epl-2.0 | 1 | spdx | spdx license identifier epl 2 0
epl-2.0 | 1 | eclipse | (?:www )?eclipse org legal epl 2 0
epl-2.0 | 2 | eclipse | eclipse public license(?: version| v)? 2(?: 0)?
epl | 3 | eclipse | eclipse public license
edl-1.0 | 2 | eclipse | eclipse distribution license(?: version| v)?(?: 1 0)?
cddl-1.0 | 1 | spdx | spdx license identifier cddl 1 0
cddl-1.0 | 2 | cddl | cddl(?: version| v)? 1 0
cddl-1.1 | 2 | cddl | cddl(?: version| v)? 1 1
cddl | 3 | development | common development and distribution license(?: cddl)?
cpl-1.0 | 2 | common | common public license(?: version| v)?(?: 1 0)?
ipl-1.0 | 2 | ibm | ibm public license(?: version| v)?(?: 1 0)?
eupl-1.1 | 2 | union | european union public licen[cs]e(?: eupl)?(?: version| v)? 1 1
eupl-1.2 | 1 | spdx | spdx license identifier eupl 1 2
eupl-1.2 | 2 | union | european union public licen[cs]e(?: eupl)?(?: version| v)? 1 2
eupl-1.2 | 3 | eupl | eupl(?: version| v)? 1 2
eupl | 3 | union | european union public licen[cs]e
cecill-2.1 | 2 | cecill | cecill(?: version| v)? 2 1
cecill | 3 | cecill | cecill(?: [abc])?(?: free software)?(?: license| licence)
artistic-1.0 | 2 | artistic | artistic license(?: version| v)? 1(?: 0)?
artistic-2.0 | 1 | spdx | spdx license identifier artistic 2 0
artistic-2.0 | 2 | artistic | artistic license(?: version| v)? 2(?: 0)?
artistic | 3 | artistic | (?:perl )?artistic license
perl | 1 | perl | this (?:program|library|module) is free software you can redistribute it and or modify it under the same terms as perl itself
python-2.0 | 2 | python | python software foundation license(?: version| v)?(?: 2)?(?: 0)?
python-2.0 | 3 | psf | psf (?:license|licence)(?: agreement)?
ruby | 3 | ruby | ruby (?:license|licence)
php-3.01 | 1 | php | (?:www )?php net license 3 01(?: txt)?
php-3.01 | 2 | php | php license(?: version| v)? 3 01
php | 3 | php | php license
zlib | 1 | spdx | spdx license identifier zlib
zlib | 1 | misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib | 1 | altered | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib | 3 | zlib | zlib(?: libpng)? (?:license|licence)
libpng | 3 | libpng | libpng (?:license|licence)
bsl-1.0 | 1 | spdx | spdx license identifier bsl 1 0
bsl-1.0 | 1 | boost | (?:www )?boost org license 1 0(?: txt)?
bsl-1.0 | 2 | boost | boost software license(?: version| v)?(?: 1 0)?
unlicense | 1 | spdx | spdx license identifier unlicense
unlicense | 1 | unencumbered | this is free and unencumbered software released into the public domain
unlicense | 3 | unlicense | (?:the )?unlicense
wtfpl | 1 | spdx | spdx license identifier wtfpl
wtfpl | 2 | fuck | do what the fuck you want to public license
wtfpl | 3 | wtfpl | wtfpl
beerware | 1 | beer | if we meet some day and you think this stuff is worth it you can buy me a beer
beerware | 3 | beerware | beerware(?: license)?
ofl-1.1 | 1 | spdx | spdx license identifier ofl 1 1
ofl-1.1 | 1 | sil | this font software is licensed under the sil open font license
ofl-1.1 | 2 | sil | sil open font license(?: ofl)?(?: version| v)?(?: 1 1)?
ncsa | 2 | ncsa | (?:university of illinois )?ncsa open source license
postgresql | 3 | postgresql | postgresql (?:license|licence)
openssl | 2 | openssl | openssl (?:license|licence)
openssl | 1 | openssl | this product includes software developed by the openssl project
sleepycat | 2 | sleepycat | sleepycat (?:license|licence)
ms-pl | 2 | microsoft | microsoft public license(?: ms pl)?
ms-rl | 2 | microsoft | microsoft reciprocal license(?: ms rl)?
osl-3.0 | 2 | open | open software license(?: osl)?(?: version| v)? 3(?: 0)?
afl-3.0 | 2 | academic | academic free license(?: afl)?(?: version| v)? 3(?: 0)?
upl-1.0 | 2 | permissive | universal permissive license(?: upl)?(?: version| v)?(?: 1 0)?
qpl-1.0 | 2 | q | q public license(?: version| v)?(?: 1 0)?
sspl-1.0 | 2 | server | server side public license(?: sspl)?(?: version| v)?(?: 1)?(?: 0)?
busl-1.1 | 2 | business | business source license(?: version| v)?(?: 1 1)?
elastic-2.0 | 2 | elastic | elastic license(?: version| v)? 2(?: 0)?
polyform | 2 | polyform | polyform (?:noncommercial|small business|strict|shield|perimeter) license(?: 1 0 0)?
commons-clause | 2 | commons | commons clause license condition(?: v1 0)?
json | 1 | evil | the software shall be used for good not evil
json | 3 | json | json (?:license|licence)
curl | 2 | curl | curl (?:license|licence)
vim | 3 | vim | vim (?:license|licence)
icu | 3 | icu | icu (?:license|licence)
unicode | 2 | unicode | unicode (?:inc )?license agreement(?: data files and software)?
w3c | 2 | w3c | w3c (?:software )?(?:notice and )?(?:license|licence)
lppl-1.3 | 2 | latex | latex project public license(?: lppl)?(?: version| v)?(?: 1 3[abc]?)?
mulan-2.0 | 2 | mulan | mulan (?:permissive software license|psl)(?: version| v)?(?: 2| v2)?
blueoak-1.0.0 | 2 | blue | blue oak model license(?: 1 0 0)?
odbl-1.0 | 1 | odbl | (?:open database license )?odbl(?: version| v)?(?: 1 0)?
odbl-1.0 | 2 | database | open database license(?: version| v)?(?: 1 0)?
odc-by-1.0 | 2 | odc | odc by(?: version| v)?(?: 1 0)?
odc-by-1.0 | 2 | data | open data commons attribution license
pddl-1.0 | 2 | dedication | (?:open data commons )?public domain dedication and license
cdla-permissive-2.0 | 2 | community | community data license agreement permissive(?: version| v)?(?: 2 0)?
cdla-sharing-1.0 | 2 | community | community data license agreement sharing(?: version| v)?(?: 1 0)?
openrail | 2 | rail | (?:creativeml |bigscience )?open rail(?: m| s| d)?(?: license)?
openrail | 2 | openrail | (?:creativeml |bigscience )?openrail(?: m| s| d)?(?: license)?
cc0-1.0 | 1 | spdx | spdx license identifier cc0 1 0
cc0-1.0 | 1 | creativecommons | creativecommons org publicdomain zero 1 0(?: legalcode)?
cc0-1.0 | 2 | cc0 | cc0(?: 1 0)?(?: universal)?(?: public domain dedication)?
cc0-1.0 | 2 | creative | creative commons (?:zero|cc0)(?: v?1 0)?(?: universal)?
cc-by-1.0 | 2 | cc | cc by 1 0
cc-by-2.0 | 2 | cc | cc by 2 0
cc-by-2.5 | 2 | cc | cc by 2 5
cc-by-3.0 | 1 | creativecommons | creativecommons org licenses by 3 0
cc-by-3.0 | 2 | cc | cc by 3 0(?: us| unported| igo)?
cc-by-3.0 | 2 | creative | creative commons attribution 3 0(?: unported| united states)?(?: license| licence)?
cc-by-4.0 | 1 | creativecommons | creativecommons org licenses by 4 0
cc-by-4.0 | 2 | cc | cc by 4 0(?: international)?
cc-by-4.0 | 2 | creative | creative commons attribution 4 0(?: international)?(?: public)?(?: license| licence)?
cc-by-sa-2.0 | 2 | cc | cc by sa 2 [05]
cc-by-sa-3.0 | 1 | creativecommons | creativecommons org licenses by sa 3 0
cc-by-sa-3.0 | 2 | cc | cc by sa 3 0(?: us| unported)?
cc-by-sa-3.0 | 2 | creative | creative commons attribution share ?alike 3 0(?: unported)?(?: license| licence)?
cc-by-sa-4.0 | 1 | creativecommons | creativecommons org licenses by sa 4 0
cc-by-sa-4.0 | 2 | cc | cc by sa 4 0(?: international)?
cc-by-sa-4.0 | 2 | creative | creative commons attribution share ?alike 4 0(?: international)?(?: public)?(?: license| licence)?
cc-by-sa | 3 | cc | cc by sa
cc-by-sa | 3 | creative | creative commons attribution share ?alike(?: license| licence)?
cc-by-nd-4.0 | 1 | creativecommons | creativecommons org licenses by nd 4 0
cc-by-nd-4.0 | 2 | cc | cc by nd 4 0(?: international)?
cc-by-nd | 3 | cc | cc by nd
cc-by-nd | 3 | creative | creative commons attribution no ?deriv(?:ative)?s(?: license| licence)?
cc-by-nc-3.0 | 2 | cc | cc by nc 3 0
cc-by-nc-4.0 | 1 | creativecommons | creativecommons org licenses by nc 4 0
cc-by-nc-4.0 | 2 | cc | cc by nc 4(?: 0)?(?: international)?
cc-by-nc-4.0 | 2 | creative | creative commons attribution non ?commercial 4 0(?: international)?(?: license| licence)?
cc-by-nc | 3 | cc | cc by nc
cc-by-nc | 3 | creative | creative commons attribution non ?commercial(?: license| licence)?
cc-by-nc-sa-3.0 | 2 | cc | cc by nc sa 3 0
cc-by-nc-sa-4.0 | 1 | creativecommons | creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-4.0 | 2 | cc | cc by nc sa 4 0(?: international)?
cc-by-nc-sa | 3 | cc | cc by nc sa
cc-by-nc-sa | 3 | creative | creative commons attribution non ?commercial share ?alike(?: [234] [05])?(?: license| licence)?
cc-by-nc-nd-4.0 | 1 | creativecommons | creativecommons org licenses by nc nd 4 0
cc-by-nc-nd-4.0 | 2 | cc | cc by nc nd 4 0(?: international)?
cc-by-nc-nd | 3 | cc | cc by nc nd
cc-by-nc-nd | 3 | creative | creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [234] [05])?(?: license| licence)?
cc-by | 3 | creative | creative commons attribution(?: license| licence)?
cc | 1 | creativecommons | (?:www )?creativecommons org licenses
cc | 4 | creative | creative commons(?: license| licence)?
public-domain | 1 | dedicate | (?:we|i|the authors?) (?:hereby )?dedicate (?:this|the) (?:\\S+ ){1,3}to the public domain
public-domain | 2 | domain | (?:released|placed|dedicated|is|are) (?:in|into|to) the public domain
public-domain | 4 | domain | public domain
proprietary | 1 | confidential | (?:confidential and proprietary|proprietary and confidential)(?: information)?
proprietary | 1 | unauthorized | unauthorized copying of this file via any medium is strictly prohibited
proprietary | 2 | reserved | all rights reserved
proprietary | 3 | proprietary | proprietary (?:license|licence|software)
proprietary | 3 | eula | end user license agreement eula
proprietary | 3 | end | end user licen[cs]e agreement
"""

#: The phrases every scan counts, with their labels.
BASE = (
    ("gpl", "gnu", "gnu general public license"),
    ("apache", "apache", "apache license"),
    ("cc-by", "cc", "cc by"),
    ("mit", "mit", "mit license"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keywords: tuple[str, ...]
    pattern: str
    base: bool = False

    @property
    def whole_words(self) -> str:
        """The pattern between word ends; only the space parts words here."""
        return f"(?<![^ ])(?:{self.pattern})(?![^ ])"


def _read(line: str) -> Rule:
    label, priority, keywords, pattern = line.split(" | ")
    return Rule(label, int(priority), tuple(keywords.split(",")), pattern)


RULES = tuple(Rule(label, 4, (word,), phrase, True) for label, word, phrase in BASE) + tuple(
    map(_read, _RULES.strip().splitlines())
)
#: How much a detection of each priority says, from 1 on.
WEIGHTS = (0.95, 0.85, 0.7, 0.4)
