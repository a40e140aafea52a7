"""Signature rules for licence texts, most specific first.

One rule a line: label, the keyword without which it cannot match, and a regular expression on
lower-cased words joined by single spaces. The place in the list is the rule's priority.
"""

_TEXT = r"""
mit | permission | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal
mit | permission | permission is hereby granted free of charge to any person obtaining a copy of (this|the) (software|work|font)
mit | permission | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit-0 | deal in the software | deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so( the software is provided as is)
mit | warrant | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
x11 | consortium | except as contained in this notice the name of the x consortium shall not be used
isc | permission | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that
0bsd | permission | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
hpnd | permission | permission to use copy modify and distribute this software and its documentation for any purpose
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display
bsd-3-clause | endorse | neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote products
bsd-3-clause | endorse | may not be used to endorse or promote products derived from this software without specific prior written permission
bsd-2-clause | redistribut | redistributions of source code must retain the above copyright notice this list of conditions
bsd-2-clause | redistribut | redistributions in binary form must reproduce the above copyright notice
bsd | redistribut | redistribution and use in source and binary forms with or without modification are permitted
apache-2.0 | apache | licensed under the apache license version 2 0 the license
apache-2.0 | apache | (licensed|released|distributed|available) under (the )?(terms of the )?apache (software )?license (version |v )?2( 0)?
apache-2.0 | apache | www apache org licenses license 2 0
apache-2.0 | apache | apache org licenses license 2 0( txt| html)?
apache-2.0 | apache | apache license version 2 0( january 2004)?
apache-2.0 | apache | apache (software )?license v?2( 0)?
apache-2.0 | apache | apache 2 0 licen[sc]e[d]?
apache-2.0 | apache | apache2 0? ?licen[sc]e
apache-2.0 | spdx | spdx license identifier apache 2 0
apache-2.0 | unless required | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2.0 | compliance | you may not use this file except in compliance with the license
apache-1.1 | apache | apache (software )?license (version )?1 1
apache-1.1 | apache | this product includes software developed by the apache (software foundation|group)
apache-1.0 | apache | apache (software )?license (version )?1 0
apache | apache | (licensed|released|distributed|available) under (the )?apache (software )?license
apache | apache | apache (software |public )?license
apache | apache | apache licen[sc]ed
agpl-3.0-or-later | affero | gnu affero general public license .{0,120}?version 3 .{0,60}?(or at your option )?any later version
agpl-3.0 | affero | (gnu )?affero general public license (as published by the free software foundation )?(either )?version 3
agpl-3.0 | agpl | (gnu )?agpl ?v?3( 0)?( only| or later)?
agpl-1.0 | affero | affero general public license (version |v )?1
agpl | affero | (gnu )?affero general public license
agpl | agpl | (under|licensed) (the )?(terms of the )?(gnu )?agpl
lgpl-3.0-or-later | lesser | gnu lesser general public license .{0,120}?version 3 .{0,60}?(or at your option )?any later version
lgpl-3.0 | lesser | (gnu )?lesser general public license (as published by the free software foundation )?(either )?(version |v )3
lgpl-2.1-or-later | lesser | gnu lesser general public license .{0,120}?version 2 1 .{0,60}?(or at your option )?any later version
lgpl-2.1 | lesser | (gnu )?lesser general public license (as published by the free software foundation )?(either )?(version |v )2 1
lgpl-2.0 | library | (gnu )?library general public license (version |v )2
lgpl | library | gnu library general public license
lgpl | lesser | (gnu )?lesser general public license
lgpl-3.0 | lgpl | (gnu )?lgpl ?(version )?v?3( 0)?( only| or later)?
lgpl-2.1 | lgpl | (gnu )?lgpl ?(version )?v?2 1( only| or later)?
lgpl | lgpl | (under|licensed) (the )?(terms of the )?(gnu )?lgpl
gpl-3.0-or-later | general | gnu general public license .{0,120}?version 3 .{0,60}?(or at your option )?any later version
gpl-2.0-or-later | general | gnu general public license .{0,120}?version 2 .{0,60}?(or at your option )?any later version
gpl-3.0 | general | (gnu )?general public license (as published by the free software foundation )?(either )?(version |v )3
gpl-2.0 | general | (gnu )?general public license (as published by the free software foundation )?(either )?(version |v )2
gpl-1.0 | general | (gnu )?general public license (as published by the free software foundation )?(either )?(version |v )1
gpl-classpath | classpath | (with the )?classpath exception
gpl-linking | linking | as a special exception .{0,160}? linking
gpl | general | gnu general public license
gpl | general | general public license
gpl | redistribut | you can redistribute it and or modify it under the terms of the gnu
gpl | useful | distributed in the hope that it will be useful but without any warranty
gpl-3.0-only | gpl | gpl 3 0 only
gpl-3.0-or-later | gpl | gpl 3 0 or later
gpl-2.0-only | gpl | gpl 2 0 only
gpl-2.0-or-later | gpl | gpl 2 0 or later
gpl-3.0 | gpl | (gnu )?gpl ?(version )?v?3( 0)?
gpl-2.0 | gpl | (gnu )?gpl ?(version )?v?2( 0)?
gpl | gpl | (under|licensed) (the )?(terms of the )?(gnu )?gpl
gpl | gpl | gnu gpl
gfdl-1.3 | documentation | (gnu )?free documentation license (version )?1 3
gfdl-1.2 | documentation | (gnu )?free documentation license (version )?1 2
gfdl-1.1 | documentation | (gnu )?free documentation license (version )?1 1
gfdl | documentation | (gnu )?free documentation license
gfdl | gfdl | (gnu )?gfdl
mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | mozilla | mozilla public license (version |v )?2( 0)?
mpl-1.1 | mozilla | mozilla public license (version |v )?1 1
mpl-1.0 | mozilla | mozilla public license (version |v )?1 0
mpl-2.0 | mozilla | mozilla org mpl 2 0
mpl | mozilla | mozilla public license
epl-2.0 | eclipse | eclipse public license (version |v )?2( 0)?
epl-1.0 | eclipse | eclipse public license (version |v )?1( 0)?
epl | eclipse | eclipse public license
edl-1.0 | eclipse | eclipse distribution license (version |v )?1? ?0?
cddl-1.1 | cddl | cddl (version )?1 1
cddl-1.0 | cddl | cddl (version )?1 0
cddl-1.1 | distribution | common development and distribution license (version )?1 1
cddl-1.0 | distribution | common development and distribution license (version )?1 0
cddl | distribution | common development and distribution license
cpl-1.0 | common | common public license (version )?(1 0)?
cpal-1.0 | attribution | common public attribution license (version )?(1 0)?
ipl-1.0 | ibm | ibm public license (version )?(1 0)?
apsl-2.0 | apple | apple public source license (version )?(2 0)?
npl-1.1 | netscape | netscape public license (version )?(1 [01])?
sissl | sun | sun industry standards source license
spl-1.0 | sun | sun public license (version )?(1 0)?
ms-pl | microsoft | microsoft public license( ms pl)?
ms-rl | microsoft | microsoft reciprocal license( ms rl)?
ms-lpl | microsoft | microsoft limited public license
osl-3.0 | open | open software license (version |v )?3( 0)?
osl-2.1 | open | open software license (version |v )?2 [01]
osl-1.1 | open | open software license (version |v )?1 [01]
afl-3.0 | academic | academic free license (version |v )?3( 0)?
afl-2.1 | academic | academic free license (version |v )?2 [01]
afl | academic | academic free license
ecl-2.0 | educational | educational community license (version )?(2 0)?
artistic-2.0 | artistic | artistic license (version )?2( 0)?
artistic-1.0 | artistic | artistic license (version )?1( 0)?
artistic | artistic | (the )?artistic license
artistic | perl | same terms as perl( itself)?
ruby | ruby | ruby (s )?license
python-2.0 | python | python software foundation license( version 2)?
python-2.0 | psf license | psf license agreement
python-2.0 | python | python license( version)? 2 0
php-3.01 | php | php license (version )?3 0?1
php-3.0 | php | php license
zend-2.0 | zend | zend (engine )?license
zlib | altered | altered source versions must be plainly marked as such
zlib | zlib | (the )?zlib (libpng )?license
libpng | libpng | libpng license
zlib | misrepresent | the origin of this software must not be misrepresented
bsl-1.0 | boost | boost software license (version )?(1 0)?
bsl-1.0 | boost | boost org license 1 0
busl-1.1 | business | business source license (version )?(1 1)?
sspl-1.0 | server | server side public license( version 1)?
elastic-2.0 | elastic | elastic license (version |v )?(2 0)?
polyform-noncommercial | polyform | polyform noncommercial license
polyform-strict | polyform | polyform strict license
polyform-smallbusiness | polyform | polyform small business license
parity | parity | (the )?parity public license
prosperity | prosperity | (the )?prosperity public license
hippocratic | hippocratic | hippocratic license
commons-clause | clause | commons clause( license condition)?
unlicense | unencumbered | this is free and unencumbered software released into the public domain
unlicense | unlicense | (the )?unlicense( org)?
wtfpl | fuck | do what the fuck you want to public license
wtfpl | wtfpl | wtfpl
beerware | beer | (the )?beer ?ware license
cc0-1.0 | cc0 | cc0( 1 0)?( universal)?
cc0-1.0 | creative commons | creative commons (zero|public domain dedication)
cc0-1.0 | waive | waive[ds]? all (of )?(his|her|their|its) rights to the work
pdm-1.0 | domain | public domain mark( 1 0)?
pddl-1.0 | domain | public domain dedication and license
public-domain | domain | (is|are|placed|released|dedicated) (in|into|to) the public domain
cc-by-nc-nd-4.0 | cc by | cc by nc nd 4 0
cc-by-nc-nd-3.0 | cc by | cc by nc nd 3 0
cc-by-nc-nd-2.5 | cc by | cc by nc nd 2 5
cc-by-nc-nd-2.0 | cc by | cc by nc nd 2 0
cc-by-nc-nd | cc by | cc by nc nd
cc-by-nc-sa-4.0 | cc by | cc by nc sa 4 0
cc-by-nc-sa-3.0 | cc by | cc by nc sa 3 0
cc-by-nc-sa-2.5 | cc by | cc by nc sa 2 5
cc-by-nc-sa-2.0 | cc by | cc by nc sa 2 0
cc-by-nc-sa | cc by | cc by nc sa
cc-by-nc-4.0 | cc by | cc by nc 4 0
cc-by-nc-3.0 | cc by | cc by nc 3 0
cc-by-nc-2.5 | cc by | cc by nc 2 5
cc-by-nc-2.0 | cc by | cc by nc 2 0
cc-by-nc | cc by | cc by nc
cc-by-nd-4.0 | cc by | cc by nd 4 0
cc-by-nd-3.0 | cc by | cc by nd 3 0
cc-by-nd-2.0 | cc by | cc by nd 2 [05]
cc-by-nd | cc by | cc by nd
cc-by-sa-4.0 | cc by | cc by sa 4 0
cc-by-sa-3.0 | cc by | cc by sa 3 0
cc-by-sa-2.5 | cc by | cc by sa 2 5
cc-by-sa-2.0 | cc by | cc by sa 2 0
cc-by-sa | cc by | cc by sa
cc-by-4.0 | cc by | cc by 4 0
cc-by-3.0 | cc by | cc by 3 0
cc-by-2.5 | cc by | cc by 2 5
cc-by-2.0 | cc by | cc by 2 0
cc-by-1.0 | cc by | cc by 1 0
cc-by | cc by | licensed under cc by
cc-by-nc-nd | commons | creative commons attribution non ?commercial no ?deriv(ative)?s?( works)?( [1-4] [05])?( international| unported| generic)?
cc-by-nc-sa | commons | creative commons attribution non ?commercial share ?alike( [1-4] [05])?( international| unported| generic)?
cc-by-nc | commons | creative commons attribution non ?commercial( [1-4] [05])?( international| unported| generic)?
cc-by-nd | commons | creative commons attribution no ?deriv(ative)?s?( works)?( [1-4] [05])?( international| unported| generic)?
cc-by-sa | commons | creative commons attribution share ?alike( [1-4] [05])?( international| unported| generic)?
cc-by | commons | creative commons attribution( [1-4] [05])?( international| unported| generic)?
cc-by-nc-nd | creativecommons | creativecommons org licenses by nc nd( [1-4] [05])?
cc-by-nc-sa | creativecommons | creativecommons org licenses by nc sa( [1-4] [05])?
cc-by-nc | creativecommons | creativecommons org licenses by nc( [1-4] [05])?
cc-by-nd | creativecommons | creativecommons org licenses by nd( [1-4] [05])?
cc-by-sa | creativecommons | creativecommons org licenses by sa( [1-4] [05])?
cc-by | creativecommons | creativecommons org licenses by( [1-4] [05])?
cc0-1.0 | creativecommons | creativecommons org publicdomain zero( 1 0)?
cc | commons | creative commons (licen[sc]e|legal code)
odbl-1.0 | database | open (data commons )?open database license( v1 0)?
odbl-1.0 | database | open database license
odc-by-1.0 | commons | open data commons attribution license( v1 0)?
ogl-uk-3.0 | government | open government licen[sc]e( v?3( 0)?)?
etalab-2.0 | open licence | (etalab )?open licence( 2 0)?
cdla-permissive | cdla | cdla permissive( 1 0| 2 0)?
cdla-sharing | cdla | cdla sharing( 1 0)?
cdla | agreement | community data license agreement
ofl-1.1 | font | sil open font license (version )?(1 1)?
ofl-1.1 | font | open font license
bitstream-vera | bitstream | bitstream vera (fonts )?copyright
ubuntu-font | font | ubuntu font licen[sc]e
lppl-1.3c | latex | latex project public license (version )?(1 3[abc]?)?
eupl-1.2 | european | european union public licen[sc]e (version |v )?(1 2)?
eupl | eupl | eupl( v?1 [0-2])?
cecill-2.1 | cecill | cecill (version )?2 1
cecill-b | cecill | cecill b
cecill-c | cecill | cecill c
cecill | cecill | cecill( licen[sc]e)?
qpl-1.0 | public | q public license (version )?(1 0)?
sleepycat | sleepycat | sleepycat license
postgresql | postgresql | postgresql licen[sc]e
openssl | openssl | openssl license
openssl | openssl | this product includes software developed by the openssl project
ssleay | ssleay | ssleay license
curl | curl | curl license
ijg | jpeg | independent jpeg group s? ?(software|license)
ftl | freetype | freetype (project )?license
imagemagick | imagemagick | imagemagick license
vim | vim | vim license
tcl | tcl | tcl tk license
ncsa | illinois | university of illinois ncsa open source license
ntp | ntp | ntp license
json | evil | the software shall be used for good not evil
upl-1.0 | universal | universal permissive license (version |v )?(1 0)?
blueoak-1.0.0 | oak | blue oak model license( 1 0 0)?
mulan-psl-2.0 | mulan | mulan (permissive software license|psl)( v?2)?
w3c | w3c | w3c software (notice and )?license
unicode | unicode | unicode (inc )?license agreement
icu | icu | icu license
naist | nara institute | nara institute of science and technology
intel | intel | intel open source license
nokia | nokia | nokia open source license
rpl-1.5 | reciprocal | reciprocal public license (version )?(1 5)?
ncl | nasa | nasa open source agreement
watcom | watcom | sybase open watcom public license
llama | llama | llama [234]? ?community license( agreement)?
openrail | rail | (creativeml |bigscience |bigcode )?open ?rail( [ms]+)?( licen[sc]e)?
bsd-3-clause | bsd | (new|revised|modified|3 clause|three clause) bsd licen[sc]e
bsd-3-clause | bsd | bsd 3 clause( licen[sc]e)?
bsd-2-clause | bsd | (simplified|freebsd|2 clause|two clause) bsd licen[sc]e
bsd-2-clause | bsd | bsd 2 clause( licen[sc]e)?
bsd-4-clause | bsd | bsd 4 clause( licen[sc]e)?
bsd | bsd | bsd( style| type)? licen[sc]e
mit | mit licen | (released|licensed|distributed|available) under (the )?(terms of the )?mit licen[sc]e
mit-modern | license | mit modern variant license
mit | license | spdx license identifier mit
mit | license | opensource org licenses mit( license)?( php)?
mit | mit licen | mit licen[sc]e
mit | expat licen | expat licen[sc]e
isc | isc licen | isc licen[sc]e
x11 | x11 licen | x11 licen[sc]e
proprietary | confidential | (proprietary and confidential|confidential and proprietary)
proprietary | unauthori | unauthori[sz]ed (copying|use|reproduction|distribution) (of this (file|software|document) )?.{0,40}?(is )?strictly prohibited
proprietary | rights | all rights reserved
commercial | commercial | commercial licen[sc]e( agreement)?
eula | licen | end user licen[sc]e agreement
spdx | spdx | spdx license identifier
"""

RULES: list[tuple[str, str, str]] = [
    tuple(part.strip() for part in line.split(" | ")) for line in _TEXT.strip().splitlines()
]
