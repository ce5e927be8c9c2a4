"""Signatures of licences for lower-cased text: label, priority, keywords, pattern.

A space in a pattern stands for anything between two words. A rule is tried on texts
that hold one of its keywords (set apart by commas), so whatever its pattern matches
must hold one. Priorities: 95 machine-readable tags, 85 exact titles with a
version, 75 addresses, 70 sentences of grants and conditions, 50 titles without a
version, 30 mentions.
"""

from __future__ import annotations

# the phrases that every scan must report, wherever their words follow one another
BASE_RULES = [
    ("mit", 60, "license", r"mit license"),
    ("apache", 60, "license", r"apache license"),
    ("gpl", 60, "license", r"general public license"),
]

#: label | priority | keywords | pattern
SIGNATURES = r"""
0bsd | 95 | spdx | spdx license identifier 0bsd
afl-2.1 | 95 | spdx | spdx license identifier afl 2 1
afl-3.0 | 95 | spdx | spdx license identifier afl 3 0
agpl-3.0 | 95 | spdx | spdx license identifier agpl 3 0(?: only| or later)?
apache-1.1 | 95 | spdx | spdx license identifier apache 1 1
apache-2.0 | 95 | spdx | spdx license identifier apache 2 0
artistic-2.0 | 95 | spdx | spdx license identifier artistic 2 0
bsd-2-clause | 95 | spdx | spdx license identifier bsd 2 clause
bsd-3-clause | 95 | spdx | spdx license identifier bsd 3 clause
bsd-4-clause | 95 | spdx | spdx license identifier bsd 4 clause
bsl-1.0 | 95 | spdx | spdx license identifier bsl 1 0
busl-1.1 | 95 | spdx | spdx license identifier busl 1 1
cc-by-3.0 | 95 | spdx | spdx license identifier cc by 3 0
cc-by-4.0 | 95 | spdx | spdx license identifier cc by 4 0
cc-by-nc-4.0 | 95 | spdx | spdx license identifier cc by nc 4 0
cc-by-nc-nd-4.0 | 95 | spdx | spdx license identifier cc by nc nd 4 0
cc-by-nc-sa-4.0 | 95 | spdx | spdx license identifier cc by nc sa 4 0
cc-by-nd-4.0 | 95 | spdx | spdx license identifier cc by nd 4 0
cc-by-sa-3.0 | 95 | spdx | spdx license identifier cc by sa 3 0
cc-by-sa-4.0 | 95 | spdx | spdx license identifier cc by sa 4 0
cc0-1.0 | 95 | spdx | spdx license identifier cc0 1 0
cddl-1.0 | 95 | spdx | spdx license identifier cddl 1 0
cddl-1.1 | 95 | spdx | spdx license identifier cddl 1 1
epl-1.0 | 95 | spdx | spdx license identifier epl 1 0
epl-2.0 | 95 | spdx | spdx license identifier epl 2 0
eupl-1.1 | 95 | spdx | spdx license identifier eupl 1 1
eupl-1.2 | 95 | spdx | spdx license identifier eupl 1 2
gfdl-1.3 | 95 | spdx | spdx license identifier gfdl 1 3(?: only| or later)?
gpl-2.0 | 95 | spdx | spdx license identifier gpl 2 0(?: only| or later)?
gpl-3.0 | 95 | spdx | spdx license identifier gpl 3 0(?: only| or later)?
isc | 95 | spdx | spdx license identifier isc
lgpl-2.0 | 95 | spdx | spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2.1 | 95 | spdx | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-3.0 | 95 | spdx | spdx license identifier lgpl 3 0(?: only| or later)?
mit | 95 | spdx | spdx license identifier mit
mit-0 | 95 | spdx | spdx license identifier mit 0
mpl-1.1 | 95 | spdx | spdx license identifier mpl 1 1
mpl-2.0 | 95 | spdx | spdx license identifier mpl 2 0
ms-pl | 95 | spdx | spdx license identifier ms pl
ncsa | 95 | spdx | spdx license identifier ncsa
ofl-1.1 | 95 | spdx | spdx license identifier ofl 1 1
osl-3.0 | 95 | spdx | spdx license identifier osl 3 0
postgresql | 95 | spdx | spdx license identifier postgresql
psf-2.0 | 95 | spdx | spdx license identifier (?:psf|python) 2 0
unlicense | 95 | spdx | spdx license identifier unlicense
wtfpl | 95 | spdx | spdx license identifier wtfpl
x11 | 95 | spdx | spdx license identifier x11
zlib | 95 | spdx | spdx license identifier zlib
apache-1.0 | 85 | apache | apache (?:software )?license,? version 1 0
apache-1.1 | 85 | apache | apache (?:software )?license,? version 1 1
apache-2.0 | 85 | apache | apache (?:software )?license (?:version |v ?)?2(?: 0)?
agpl-1.0 | 85 | affero | affero general public license (?:as published by affero )?(?:version |v ?)1
agpl-3.0 | 85 | affero | (?:gnu )?affero general public license (?:version |v ?)?3(?: 0)?
gpl-1.0 | 85 | general | gnu general public license (?:version |v ?)1(?: 0)?
gpl-2.0 | 85 | general | gnu general public license (?:as published by the free software foundation )?(?:version |v ?)2(?: 0)?
gpl-3.0 | 85 | general | gnu general public license (?:as published by the free software foundation )?(?:version |v ?)3(?: 0)?
lgpl-2.0 | 85 | library | gnu library general public license (?:version |v ?)2(?: 0)?
lgpl-2.1 | 85 | lesser | gnu lesser general public license (?:as published by the free software foundation )?(?:version |v ?)2 1
lgpl-3.0 | 85 | lesser | gnu lesser general public license (?:as published by the free software foundation )?(?:version |v ?)3(?: 0)?
gfdl-1.1 | 85 | documentation | gnu free documentation license (?:version |v ?)1 1
gfdl-1.2 | 85 | documentation | gnu free documentation license (?:version |v ?)1 2
gfdl-1.3 | 85 | documentation | gnu free documentation license (?:version |v ?)1 3
mpl-1.0 | 85 | mozilla | mozilla public license (?:version |v ?)1 0
mpl-1.1 | 85 | mozilla | mozilla public license (?:version |v ?)1 1
mpl-2.0 | 85 | mozilla | mozilla public license (?:version |v ?)?2 0
epl-1.0 | 85 | eclipse | eclipse public license (?:version |v ?)?1 0
epl-2.0 | 85 | eclipse | eclipse public license (?:version |v ?)?2 0
edl-1.0 | 85 | eclipse | eclipse distribution license (?:version |v ?)?1 0
cddl-1.0 | 85 | distribution | common development and distribution license (?:cddl )?(?:version |v ?)?1 0
cddl-1.1 | 85 | distribution | common development and distribution license (?:cddl )?(?:version |v ?)?1 1
cpl-1.0 | 85 | common | common public license (?:version |v ?)?1 0
ipl-1.0 | 85 | ibm | ibm public license (?:version |v ?)?1 0
artistic-1.0 | 85 | artistic | artistic license (?:version |v ?)?1 0
artistic-2.0 | 85 | artistic | artistic license (?:version |v ?)?2 0
afl-2.1 | 85 | academic | academic free license (?:version |v ?)?2 1
afl-3.0 | 85 | academic | academic free license (?:version |v ?)?3 0
osl-1.0 | 85 | open | open software license (?:version |v ?)?1 0
osl-2.1 | 85 | open | open software license (?:version |v ?)?2 1
osl-3.0 | 85 | open | open software license (?:version |v ?)?3 0
bsl-1.0 | 85 | boost | boost software license (?:version |v ?)?1 0
busl-1.1 | 85 | business | business source license (?:version |v ?)?1 1
sspl-1.0 | 85 | server | server side public license (?:version |v ?)?1
elastic-2.0 | 85 | elastic | elastic license (?:version |v ?)?2(?: 0)?
eupl-1.1 | 85 | union | european union public licen[cs]e (?:version |v ?)?1 1
eupl-1.2 | 85 | union | european union public licen[cs]e (?:version |v ?)?1 2
ofl-1.1 | 85 | font | sil open font license (?:version |v ?)?1 1
ecl-2.0 | 85 | educational | educational community license (?:version |v ?)?2 0
lppl-1.3 | 85 | latex | latex project public license (?:version |v ?)?1 3[ac]?
php-3.0 | 85 | php | php license (?:version |v ?)?3 0
php-3.01 | 85 | php | php license (?:version |v ?)?3 01
zpl-2.1 | 85 | zope | zope public license (?:version |v ?)?2 1
psf-2.0 | 85 | python | python software foundation license (?:version |v ?)?2
cecill-2.1 | 85 | cecill | cecill (?:free software )?license (?:version |v ?)?2 1
cpal-1.0 | 85 | attribution | common public attribution license (?:version |v ?)?1 0
apsl-2.0 | 85 | apple | apple public source license (?:version |v ?)?2 0
rpl-1.5 | 85 | reciprocal | reciprocal public license (?:version |v ?)?1 5
cc-by-1.0 | 85 | attribution | creative commons attribution 1 0
cc-by-2.0 | 85 | attribution | creative commons attribution 2 0
cc-by-2.5 | 85 | attribution | creative commons attribution 2 5
cc-by-3.0 | 85 | attribution | creative commons attribution 3 0
cc-by-4.0 | 85 | attribution | creative commons attribution 4 0
cc-by-nc-3.0 | 85 | attribution | creative commons attribution non ?commercial 3 0
cc-by-nc-4.0 | 85 | attribution | creative commons attribution non ?commercial 4 0
cc-by-nc-nd-4.0 | 85 | attribution | creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0
cc-by-nc-sa-3.0 | 85 | attribution | creative commons attribution non ?commercial share ?alike 3 0
cc-by-nc-sa-4.0 | 85 | attribution | creative commons attribution non ?commercial share ?alike 4 0
cc-by-nd-4.0 | 85 | attribution | creative commons attribution no ?deriv(?:ative)?s 4 0
cc-by-sa-3.0 | 85 | attribution | creative commons attribution share ?alike 3 0
cc-by-sa-4.0 | 85 | attribution | creative commons attribution share ?alike 4 0
cc-by-2.0 | 80 | cc | cc by 2 0
cc-by-3.0 | 80 | cc | cc by 3 0
cc-by-4.0 | 80 | cc | cc by 4 0
cc-by-nc-2.0 | 80 | cc | cc by nc 2 0
cc-by-nc-3.0 | 80 | cc | cc by nc 3 0
cc-by-nc-4.0 | 80 | cc | cc by nc 4 0
cc-by-nc-nd-3.0 | 80 | cc | cc by nc nd 3 0
cc-by-nc-nd-4.0 | 80 | cc | cc by nc nd 4 0
cc-by-nc-sa-3.0 | 80 | cc | cc by nc sa 3 0
cc-by-nc-sa-4.0 | 80 | cc | cc by nc sa 4 0
cc-by-nd-3.0 | 80 | cc | cc by nd 3 0
cc-by-nd-4.0 | 80 | cc | cc by nd 4 0
cc-by-sa-2.0 | 80 | cc | cc by sa 2 0
cc-by-sa-3.0 | 80 | cc | cc by sa 3 0
cc-by-sa-4.0 | 80 | cc | cc by sa 4 0
cc0-1.0 | 85 | cc0 | cc0 1 0(?: universal)?
cc0-1.0 | 80 | creative | creative commons (?:zero|cc0)
odbl-1.0 | 85 | database | open (?:data commons open )?database license (?:version |v ?)?1 0
odc-by-1.0 | 85 | data | open data commons attribution license (?:version |v ?)?1 0
pddl-1.0 | 85 | dedication | public domain dedication and license (?:version |v ?)?1 0
apache-1.1 | 75 | apache | www apache org licenses license 1 1
apache-2.0 | 75 | apache | apache org licenses license 2 0
apache-2.0 | 75 | opensource | opensource org licenses apache 2 0
agpl-3.0 | 75 | gnu | gnu org licenses agpl(?: 3 0)?
gpl-2.0 | 75 | gnu | gnu org licenses (?:old licenses )?gpl 2 0
gpl-3.0 | 75 | gnu | gnu org licenses gpl(?: 3 0)?
lgpl-2.1 | 75 | gnu | gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3.0 | 75 | gnu | gnu org licenses lgpl(?: 3 0)?
gfdl | 75 | gnu | gnu org licenses fdl(?: 1 [123])?
mit | 75 | opensource | opensource org licenses mit(?: license)?
bsd-2-clause | 75 | opensource | opensource org licenses bsd 2 clause
bsd-3-clause | 75 | opensource | opensource org licenses bsd 3 clause
isc | 75 | opensource | opensource org licenses isc
mpl-1.1 | 75 | mozilla | mozilla org mpl mpl 1 1
mpl-2.0 | 75 | mozilla | mozilla org (?:en us )?mpl 2 0
epl-1.0 | 75 | eclipse | eclipse org legal epl v ?10
epl-2.0 | 75 | eclipse | eclipse org legal epl (?:v ?20|2 0)
bsl-1.0 | 75 | boost | boost org license 1 0
unlicense | 75 | unlicense | unlicense org
wtfpl | 75 | wtfpl | wtfpl net
ofl-1.1 | 75 | ofl | scripts sil org ofl
cc0-1.0 | 75 | creativecommons | creativecommons org publicdomain zero 1 0
cc-pdm | 75 | creativecommons | creativecommons org publicdomain mark 1 0
cc-by | 75 | creativecommons | creativecommons org licenses by [1-4] [05]
cc-by-sa | 75 | creativecommons | creativecommons org licenses by sa [1-4] [05]
cc-by-nd | 75 | creativecommons | creativecommons org licenses by nd [1-4] [05]
cc-by-nc | 75 | creativecommons | creativecommons org licenses by nc [1-4] [05]
cc-by-nc-sa | 75 | creativecommons | creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc-nd | 75 | creativecommons | creativecommons org licenses by nc nd [1-4] [05]
mit | 70 | permission | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 70 | copyright | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | 68 | sublicense | rights to use copy modify merge publish distribute sublicense and or sell copies of the software
mit | 66 | warranty | the software is provided as is without warranty of any kind express or implied
isc | 70 | permission | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | 66 | disclaims | the software is provided as is and the author disclaims all warranties
hpnd | 70 | permission | permission to use copy modify and distribute this software and its documentation for any purpose (?:and without fee )?is hereby granted
postgresql | 70 | permission | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement
bsd | 70 | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd-2-clause | 62 | redistributions | redistributions in binary form must reproduce the above copyright notice
bsd | 60 | redistributions | redistributions of source code must retain the above copyright notice
bsd-3-clause | 72 | endorse | neither the names? of (?s:.){1,80}? nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | 74 | advertising | all advertising materials mentioning features or use of this software must display
bsd-3-clause-clear | 72 | patent | no express or implied licenses to any party s patent rights are granted by this license
apache-2.0 | 70 | compliance | you may not use this file except in compliance with the license
apache-2.0 | 66 | governing | see the license for the specific language governing permissions and limitations under the license
apache-2.0 | 68 | perpetual | grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
gpl-2.0+ | 72 | general | it under the terms of the gnu general public license as published by the free software foundation either version 2
gpl-3.0+ | 72 | general | it under the terms of the gnu general public license as published by the free software foundation either version 3
lgpl-2.1+ | 72 | general | it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1
lgpl-3.0+ | 72 | general | it under the terms of the gnu lesser general public license as published by the free software foundation either version 3
agpl-3.0+ | 72 | general | it under the terms of the gnu affero general public license as published by the free software foundation either version 3
gpl | 62 | merchantability | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license
lgpl | 64 | merchantability | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu lesser general public license
gpl | 64 | received | you should have received a copy of the gnu general public license
lgpl | 66 | received | you should have received a copy of the gnu lesser general public license
agpl | 66 | received | you should have received a copy of the gnu affero general public license
mpl-2.0 | 72 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | 72 | mozilla | the contents of this file are subject to the mozilla public license version 1 1
epl | 70 | accompanying | the accompanying materials are made available under the terms of the eclipse public license
cddl | 70 | distribution | the contents of this file are subject to the terms of the common development and distribution license
bsl-1.0 | 70 | permission | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
zlib | 70 | misrepresented | the origin of this software must not be misrepresented
zlib | 66 | altered | altered source versions must be plainly marked as such
unlicense | 70 | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | 70 | want | do what the f[a-z*]+ you want to(?: public license)?
wtfpl | 70 | want | you just do what the f[a-z]+ you want to
cc0-1.0 | 70 | waived | (?:has )?waived all copyright and related or neighboring rights
public-domain | 60 | domain | (?:released|placed|dedicated|is) (?:in|into|to|in to) the public domain
ofl-1.1 | 70 | font | the fonts? and derivatives however cannot be released under any other type of license
json | 72 | evil | the software shall be used for good not evil
beerware | 70 | beer | you can buy me a beer in return
openssl | 70 | openssl | this product includes software developed by the openssl project
curl | 70 | permission | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted
ncsa | 70 | documentation | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files (?s:.){1,8}deal with the software
ms-pl | 70 | microsoft | microsoft public license
ms-rl | 70 | microsoft | microsoft reciprocal license
commons-clause | 72 | commons | commons clause (?:license )?condition
busl-1.1 | 66 | production | use of the licensed work in production
proprietary | 60 | rights | all rights reserved
proprietary | 66 | confidential | proprietary and confidential
proprietary | 66 | unauthorized | unauthorized (?:copying|use|reproduction|distribution) of this (?:file|software|document)
bsd-2-clause | 50 | bsd | (?:simplified|2 clause|two clause) bsd(?: license)?
bsd-2-clause | 50 | bsd | bsd 2 clause(?: license)?
bsd-3-clause | 50 | bsd | (?:new|modified|revised|3 clause|three clause) bsd(?: license)?
bsd-3-clause | 50 | bsd | bsd 3 clause(?: license)?
bsd-4-clause | 50 | bsd | (?:original|4 clause|four clause) bsd(?: license)?
bsd | 45 | bsd | bsd (?:style )?license
0bsd | 50 | bsd | (?:zero clause bsd|bsd zero clause)(?: license)?
mit-0 | 50 | mit | mit no attribution(?: license)?
mit | 50 | mit | (?:the )?mit (?:x11 )?licen[cs]e
x11 | 50 | x11 | x11 license
apache | 45 | apache | apache (?:software )?licen[cs]e
apache-2.0 | 50 | apache | apache ?2 license
gpl | 45 | general | (?:gnu )?general public licen[cs]e
lgpl | 50 | lesser | (?:gnu )?lesser general public licen[cs]e
lgpl | 50 | library | (?:gnu )?library general public licen[cs]e
agpl | 50 | affero | (?:gnu )?affero general public licen[cs]e
gfdl | 50 | documentation | (?:gnu )?free documentation licen[cs]e
gpl-2.0 | 50 | gpl | gpl ?v ?2
gpl-3.0 | 50 | gpl | gpl ?v ?3
lgpl-2.1 | 50 | lgpl | lgpl ?v ?2 1
lgpl-3.0 | 50 | lgpl | lgpl ?v ?3
agpl-3.0 | 50 | agpl | agpl ?v ?3
mpl | 45 | mozilla | mozilla public licen[cs]e
epl | 45 | eclipse | eclipse public licen[cs]e
cddl | 45 | distribution | common development and distribution licen[cs]e
isc | 45 | isc | isc licen[cs]e
zlib | 45 | zlib | zlib(?: libpng)? licen[cs]e
artistic | 45 | artistic | (?:perl )?artistic licen[cs]e
bsl | 45 | boost | boost software licen[cs]e
psf | 45 | python | python (?:software foundation )?licen[cs]e
php | 45 | php | php licen[cs]e
ruby | 45 | ruby | ruby licen[cs]e
vim | 45 | vim | vim licen[cs]e
w3c | 45 | w3c | w3c software (?:notice and )?licen[cs]e
ncsa | 45 | ncsa | university of illinois ncsa open source licen[cs]e
ofl | 45 | font | open font licen[cs]e
wtfpl | 45 | wtfpl | wtfpl
unlicense | 45 | unlicense | the unlicense
cc | 40 | creative | creative commons(?: licen[cs]e)?
cc-by-nc | 45 | cc,creative | (?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial)
cc-by-sa | 45 | alike | creative commons attribution share ?alike
eupl | 45 | eupl | eupl
sspl | 45 | sspl | sspl
odbl | 45 | odbl | odbl
copyright | 30 | copyright | copyright (?:c )?(?:19|20)[0-9][0-9]
license-reference | 30 | licensed,released,distributed,available | (?:licensed|released|distributed|available) under the(?: terms of the)?
"""
