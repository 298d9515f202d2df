"""License detection by ordered signature rules over normalised words.

Texts are reduced to words (ASCII letters lower-cased, runs of other ASCII signs as borders) joined by single spaces.
Keywords gate the rules: one pass over a text finds which keywords stand in it, and only their rules are tried on it. A
rule's keywords are read off its expression: every match holds one of them. Rules are ordered by priority. A detection
is dropped when its words lie within those of one accepted before it, so that "gnu lesser general public license" isn't
also a general one. Base phrases are counted apart from that and always stay. All steps take time in proportion to a
text's length and detections.

Cases: a null text counts as empty and has 0 words; texts without words or phrases have 0 places, null first and last
words and empty labels; null ids stay null; repeated rows give repeated rows; an empty table gives an empty result;
columns beside id and text are ignored, whatever their names; texts of any length are scanned whole.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from functools import cache
from itertools import accumulate, groupby
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quire.llm import common
from quire.llm import kernels as K

RESULT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
DETECTIONS = "doc_id long, rule string, label string, first_word long, last_word long, priority int"

BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: One license a line: label | SPDX words | name | page. Words are as normalised; names and pages are expressions.
FAMILIES = r"""
agpl-1.0 | agpl 1 0 | affero general public license(?: version| v)? ?1(?: 0)? | www affero org oagpl
agpl-3.0 | agpl 3 0 | gnu affero general public license(?:(?: version| v)? ?3(?: 0)?)? | www gnu org licenses agpl(?: 3 0)?
gpl-1.0 | gpl 1 0 | gnu general public license,? (?:version|v) ?1(?: 0)? | www gnu org licenses old licenses gpl 1 0
gpl-2.0 | gpl 2 0 | gnu general public license(?: as published by the free software foundation either)? (?:version|v) ?2(?: 0)? | www gnu org licenses old licenses gpl 2 0
gpl-3.0 | gpl 3 0 | gnu general public license(?: as published by the free software foundation either)? (?:version|v) ?3(?: 0)? | www gnu org licenses gpl 3 0
lgpl-2.0 | lgpl 2 0 | gnu library general public license(?: (?:version|v) ?2(?: 0)?)? | www gnu org licenses old licenses lgpl 2 0
lgpl-2.1 | lgpl 2 1 | gnu lesser general public license (?:version|v) ?2 1 | www gnu org licenses old licenses lgpl 2 1
lgpl-3.0 | lgpl 3 0 | gnu lesser general public license (?:version|v) ?3(?: 0)? | www gnu org licenses lgpl(?: 3 0)?
gfdl-1.2 | gfdl 1 2 | gnu free documentation license(?: version| v)? ?1 2 | www gnu org licenses old licenses fdl 1 2
gfdl-1.3 | gfdl 1 3 | gnu free documentation license(?: version| v)? ?1 3 | www gnu org licenses fdl(?: 1 3)?
apache-1.0 | apache 1 0 | apache (?:software )?license (?:version |v ?)?1 0 | www apache org licenses license 1 0
apache-1.1 | apache 1 1 | apache (?:software )?license (?:version |v ?)?1 1 | www apache org licenses license 1 1
apache-2.0 | apache 2 0 | apache (?:software )?license (?:version |v ?)?2(?: 0)? | www apache org licenses license 2 0
mit | mit | (?:the )?mit (?:x11 )?license | opensource org licenses mit(?: license php)?
mit-0 | mit 0 | mit no attribution(?: license)? | github com aws mit 0
x11 | x11 | x11 license | www xfree86 org 3 3 6 copyright2 html
isc | isc | isc license | opensource org licenses isc
bsd-1 | bsd 1 clause | (?:1|one) clause bsd license | svnweb freebsd org base head include ifaddrs
bsd-2 | bsd 2 clause | (?:simplified|freebsd|2 clause|two clause) bsd license | opensource org licenses bsd 2 clause
bsd-3 | bsd 3 clause | (?:new|modified|revised|3 clause|three clause) bsd license | opensource org licenses bsd 3 clause
bsd-4 | bsd 4 clause | (?:original|old|4 clause|four clause) bsd license | directory fsf org wiki license bsd 4clause
0bsd | 0bsd | (?:zero clause bsd|bsd zero clause) license | landley net toybox license html
bsl-1.0 | bsl 1 0 | boost software license(?: version| v)?(?: 1 0)? | www boost org license 1 0 txt
zlib | zlib | zlib license | www zlib net zlib license html
libpng | libpng | libpng license | www libpng org pub png src libpng license txt
mpl-1.0 | mpl 1 0 | mozilla public license (?:version |v ?)?1 0 | www mozilla org mpl mpl 1 0 html
mpl-1.1 | mpl 1 1 | mozilla public license (?:version |v ?)?1 1 | www mozilla org mpl mpl 1 1 html
mpl-2.0 | mpl 2 0 | mozilla public license(?: version| v)?(?: ?2 0)? | (?:www )?mozilla org mpl 2 0
epl-1.0 | epl 1 0 | eclipse public license (?:version |v ?)?1 0 | www eclipse org legal epl v10 html
epl-2.0 | epl 2 0 | eclipse public license(?: version| v)?(?: ?2 0)? | www eclipse org legal epl 2 0
cddl-1.0 | cddl 1 0 | common development and distribution license(?: version)?(?: 1 0)? | opensource org licenses cddl(?: 1 0| 1 php)?
cddl-1.1 | cddl 1 1 | common development and distribution license(?: version)? 1 1 | glassfish java net public cddl gpl 1 1 html
cpl-1.0 | cpl 1 0 | common public license(?: version)?(?: 1 0)? | opensource org licenses cpl1 0
ipl-1.0 | ipl 1 0 | ibm public license(?: version)?(?: 1 0)? | opensource org licenses ipl 1 0
eupl-1.1 | eupl 1 1 | european union public licen[cs]e (?:version |v ?)?1 1 | joinup ec europa eu software page eupl licence eupl
eupl-1.2 | eupl 1 2 | european union public licen[cs]e(?: version| v)?(?: ?1 2)? | joinup ec europa eu collection eupl
artistic-1.0 | artistic 1 0 | artistic license(?: version)? 1 0 | opensource org licenses artistic license 1 0
artistic-2.0 | artistic 2 0 | artistic license(?: version)?(?: 2 0)? | www perlfoundation org artistic license 2 0
python-2.0 | python 2 0 | python software foundation license(?: version)?(?: 2)? | docs python org license html
php-3.01 | php 3 01 | php license(?: version)?(?: 3 01)? | www php net license 3 01 txt
ruby | ruby | ruby license | www ruby lang org en license txt
perl | perl 5 | same terms as perl(?: itself)? | dev perl org licenses
openssl | openssl | openssl license | www openssl org source license html
ssleay | ssleay | ssleay license | www openssl org source license txt
curl | curl | curl license | curl se docs copyright html
unlicense | unlicense | (?:the )?unlicense(?: license)? | unlicense org
wtfpl | wtfpl | do what the fuck you want to public license | www wtfpl net
cc0-1.0 | cc0 1 0 | (?:cc0 1 0(?: universal)?|creative commons zero) | creativecommons org publicdomain zero 1 0
pddl-1.0 | pddl 1 0 | public domain dedication and license | opendatacommons org licenses pddl
odbl-1.0 | odbl 1 0 | open (?:data commons open )?database license | opendatacommons org licenses odbl
odc-by-1.0 | odc by 1 0 | open data commons attribution license | opendatacommons org licenses by
cc-by-1.0 | cc by 1 0 | creative commons attribution 1 0(?: generic)? | creativecommons org licenses by 1 0
cc-by-2.0 | cc by 2 0 | creative commons attribution 2 0(?: generic)? | creativecommons org licenses by 2 0
cc-by-2.5 | cc by 2 5 | creative commons attribution 2 5(?: generic)? | creativecommons org licenses by 2 5
cc-by-3.0 | cc by 3 0 | creative commons attribution 3 0(?: unported)? | creativecommons org licenses by 3 0
cc-by-4.0 | cc by 4 0 | creative commons attribution 4 0(?: international)? | creativecommons org licenses by 4 0
cc-by-sa-2.0 | cc by sa 2 0 | creative commons attribution share ?alike 2 0 | creativecommons org licenses by sa 2 0
cc-by-sa-2.5 | cc by sa 2 5 | creative commons attribution share ?alike 2 5 | creativecommons org licenses by sa 2 5
cc-by-sa-3.0 | cc by sa 3 0 | creative commons attribution share ?alike 3 0 | creativecommons org licenses by sa 3 0
cc-by-sa-4.0 | cc by sa 4 0 | creative commons attribution share ?alike 4 0 | creativecommons org licenses by sa 4 0
cc-by-nc-2.0 | cc by nc 2 0 | creative commons attribution non ?commercial 2 0 | creativecommons org licenses by nc 2 0
cc-by-nc-3.0 | cc by nc 3 0 | creative commons attribution non ?commercial 3 0 | creativecommons org licenses by nc 3 0
cc-by-nc-4.0 | cc by nc 4 0 | creative commons attribution non ?commercial 4 0 | creativecommons org licenses by nc 4 0
cc-by-nd-3.0 | cc by nd 3 0 | creative commons attribution no ?deriv(?:ative)?s 3 0 | creativecommons org licenses by nd 3 0
cc-by-nd-4.0 | cc by nd 4 0 | creative commons attribution no ?deriv(?:ative)?s 4 0 | creativecommons org licenses by nd 4 0
cc-by-nc-sa-3.0 | cc by nc sa 3 0 | creative commons attribution non ?commercial share ?alike 3 0 | creativecommons org licenses by nc sa 3 0
cc-by-nc-sa-4.0 | cc by nc sa 4 0 | creative commons attribution non ?commercial share ?alike 4 0 | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-3.0 | cc by nc nd 3 0 | creative commons attribution non ?commercial no ?deriv(?:ative)?s 3 0 | creativecommons org licenses by nc nd 3 0
cc-by-nc-nd-4.0 | cc by nc nd 4 0 | creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0 | creativecommons org licenses by nc nd 4 0
ofl-1.1 | ofl 1 1 | sil open font license(?: version)?(?: 1 1)? | scripts sil org ofl
ms-pl | ms pl | microsoft public license | opensource org licenses ms pl
ms-rl | ms rl | microsoft reciprocal license | opensource org licenses ms rl
afl-3.0 | afl 3 0 | academic free license(?: version)?(?: 3 0)? | opensource org licenses afl 3 0
osl-3.0 | osl 3 0 | open software license(?: version)?(?: 3 0)? | opensource org licenses osl 3 0
qpl-1.0 | qpl 1 0 | q public license(?: version)?(?: 1 0)? | opensource org licenses qpl 1 0
ncsa | ncsa | university of illinois (?:ncsa )?open source license | opensource org licenses ncsa
postgresql | postgresql | postgresql license | www postgresql org about licence
unicode | unicode dfs 2016 | unicode license agreement | www unicode org copyright html
vim | vim | vim license | vimdoc sourceforge net htmldoc uganda html
w3c | w3c | w3c software (?:notice and )?license | www w3 org consortium legal 2002 copyright software 20021231
zpl-2.1 | zpl 2 1 | zope public license(?: version)?(?: 2 1)? | old zope org resources zpl
elastic-2.0 | elastic 2 0 | elastic license(?: version)?(?: 2 0)? | www elastic co licensing elastic license
sspl-1.0 | sspl 1 0 | server side public license(?: version)?(?: 1)? | www mongodb com licensing server side public license
busl-1.1 | busl 1 1 | business source license(?: version)?(?: 1 1)? | mariadb com bsl11
"""
#: Sentences of license texts and headers of files: label | expression.
CLAUSES = r"""
mit | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | (?:the above copyright notice and this|this) permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions
mit | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
mit | in no event shall the (?:authors?|copyright holders?)(?: or (?:authors?|copyright holders?))? be liable for any claim damages or other liability
mit | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?mit(?: license)?
mit | (?:see|read) (?:the )?(?:file )?(?:license|mit license)(?: txt| md)? for (?:the )?(?:full )?(?:mit )?(?:license text|terms of the mit license)
mit-modern | permission is hereby granted without written agreement and without license or royalty fees
mit-feh | the above copyright notice and this permission notice shall be included in all copies of the software and its documentation and acknowledgment shall be given
x11 | except as contained in this notice the names? of (?:[a-z0-9]+ ){1,8}shall not be used in advertising or otherwise to promote the sale
x11 | x window system is a trademark of (?:x consortium inc|the open group)
hpnd | permission to use copy modify and distribute this software and its documentation for any purpose(?: and without fee)? is hereby granted
hpnd | (?:the author|[a-z]+) makes no representations about the suitability of this software for any purpose
isc | permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted
isc | the software is provided as is and the (?:author|isc) disclaims all warranties with regard to this software
isc | copyright(?: c)?(?: [0-9]{4})+(?: by)? internet (?:systems|software) consortium
isc | (?:licensed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?isc license
bsd | redistribution and use in source and binary forms with or without modification are permitted
bsd | redistributions of source code must retain the above copyright notice
bsd | redistributions in binary form must reproduce the above copyright notice
bsd | this software is provided by the (?:copyright holders and contributors|regents and contributors|authors?(?: and contributors)?) as is
bsd | (?:licensed|released|distributed|available|governed) (?:under|by) (?:a|the) bsd(?: style)? license
bsd | use of this source code is governed by a bsd(?: style)? license that can be found in the license file
bsd-3 | neither the names? of (?:[a-z0-9]+ ){1,16}nor the names of (?:its|their|the) contributors may be used to endorse or promote products
bsd-3 | the names? of the (?:authors?|university|company) may not be used to endorse or promote products derived from this software
bsd-3 | copyright(?: c)?(?: [0-9]{4})+ the regents of the university of california
bsd-4 | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-2 | the views and conclusions contained in the software and documentation are those of the authors and should not be interpreted
bsd-clear | no express or implied licenses to any party s patent rights are granted by this license
0bsd | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
ncsa | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software
ncsa | neither the names of (?:[a-z0-9]+ ){1,16}nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission
gpl | this program is free software you can redistribute it and or modify it
gpl | (?:this|the) (?:file|library|program|software|package|script) is (?:part of gnu [a-z]+|covered by the gnu general public license)
gpl | you should have received a copy of the gnu general public license along with
gpl | (?:licensed|released|distributed|available|covered) under (?:the )?(?:terms of (?:the )?)?(?:gnu )?(?:gpl|general public license)
gpl | this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability
gpl | everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed
gpl | these requirements apply to the modified work as a whole if identifiable sections of that work are not derived from the program
gpl | (?:free software foundation inc|write to the free software foundation) (?:51 franklin|59 temple|675 mass)
gpl-1.0 | either version 1 (?:of the license )?or (?:at your option |if you prefer )?any later version
gpl-2.0 | (?:either )?version 2 (?:of the license )?or (?:at your option )?any later version
gpl-2.0 | under the terms of (?:the )?(?:gnu general public license )?version 2(?: only| of the license| of the gnu general public license)
gpl-2.0 | gpl ?v ?2(?: 0)?(?: only| or later)?
gpl-3.0 | (?:either )?version 3 (?:of the license )?or (?:at your option )?any later version
gpl-3.0 | under the terms of (?:the )?(?:gnu general public license )?version 3(?: only| of the license| of the gnu general public license)
gpl-3.0 | gpl ?v ?3(?: 0)?(?: only| or later)?
gpl-3.0 | additional permission under gnu gpl version 3 section 7
gpl-3.0-gcc | gcc runtime library exception(?: version 3 1)?
gpl-2.0-classpath | linking this library statically or dynamically with other modules is making a combined work based on this library
gpl-2.0-classpath | (?:subject to|with) the classpath exception
gpl-bison | as a special exception you may create a larger work that contains part or all of the bison parser skeleton
gpl-autoconf | as a special exception (?:to the gnu general public license )?if you distribute this file as part of a program that contains a configuration script generated by autoconf
gpl-linux | this copyright does not cover user programs that use kernel services by normal system calls
lgpl | this library is free software you can redistribute it and or modify it
lgpl | you should have received a copy of the gnu (?:lesser|library) general public license along with
lgpl | (?:licensed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?(?:gnu )?(?:lgpl|(?:lesser|library) general public license)
lgpl-2.0 | lgpl ?v ?2(?: 0)?(?: only| or later)?
lgpl-2.1 | lgpl ?v ?2 1(?: only| or later)?
lgpl-2.1 | either version 2 1 (?:of the license )?or (?:at your option )?any later version
lgpl-3.0 | lgpl ?v ?3(?: 0)?(?: only| or later)?
lgpl-wx | wxwindows library licen[cs]e
agpl | you should have received a copy of the gnu affero general public license along with
agpl-3.0 | agpl ?v ?3(?: 0)?(?: only| or later)?
agpl-3.0 | if you modify the program your modified version must prominently offer all users interacting with it remotely through a computer network
gfdl | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl | with no invariant sections(?: with)? no front cover texts and(?: with)? no back cover texts
apache | licensed under the apache license
apache | licensed to the apache software foundation(?: asf)? under one or more contributor license agreements
apache-1.1 | this product includes software developed by the apache software foundation
apache-2.0 | you may not use this file except in compliance with the license you may obtain a copy of the license at
apache-2.0 | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2.0 | the asf licenses this file to you under the apache license version 2 0
apache-2.0 | apache ?(?:v ?2|2 0)
apache-2.0-llvm | apache license v2 0 with llvm exceptions
mpl | the contents of this file are subject to the (?:mozilla|netscape) public license
mpl-1.1 | alternatively the contents of this file may be used under the terms of (?:either )?(?:the )?gnu (?:general|lesser)
mpl-1.1 | mpl 1 1 gpl 2 0 lgpl 2 1
mpl-2.0 | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | if a copy of the mpl was not distributed with this file you can obtain one at
mpl-2.0 | this source code form is incompatible with secondary licenses as defined by the mozilla public license
npl-1.1 | netscape public license(?: version)?(?: 1 [01])?
epl | this program and the accompanying materials are made available under the terms of the eclipse public license
epl-1.0 | all rights reserved this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
epl-2.0 | this source code may also be made available under the following secondary licenses when the conditions for such availability set forth in the eclipse public license
edl-1.0 | eclipse distribution license(?: v(?:ersion)? ?1 0)?
cddl | the contents of this file are subject to the terms of (?:the|either the) (?:common development and distribution license|gnu general public license version 2 only)
cddl | when distributing (?:covered code|the software) include this cddl header notice in each file
cddl-gpl-2.0 | dual license consisting of the cddl v1 (?:0|1) and gpl v2
cpl-1.0 | this program and the accompanying materials are made available under the terms of the common public license
cc | this work is licensed under a creative commons(?: [a-z0-9]+){0,6} license
cc | (?:content|text|photos?|images?|documentation|articles?) (?:is|are) (?:available|licensed|released) under (?:a |the )?creative commons
cc | to view a copy of this license visit https? creativecommons org licenses
cc | some rights reserved
cc-by | you must give appropriate credit provide a link to the license and indicate if changes were made
cc-by-nc | you may not use the material for commercial purposes
cc-by-sa | if you remix transform or build upon the material you must distribute your contributions under the same license as the original
cc-by-nd | if you remix transform or build upon the material you may not distribute the modified material
cc-by-sa-4.0 | user contributions (?:are )?licensed under cc by sa
cc-by-2.0 | cc by(?: v)? ?2 0(?: generic)?
cc-by-3.0 | cc by(?: v)? ?3 0(?: unported)?
cc-by-4.0 | cc by(?: v)? ?4 0(?: international)?
cc-by-sa-2.0 | cc by sa(?: v)? ?2 0(?: generic)?
cc-by-sa-2.5 | cc by sa(?: v)? ?2 5(?: generic)?
cc-by-sa-3.0 | cc by sa(?: v)? ?3 0(?: unported)?
cc-by-sa-4.0 | cc by sa(?: v)? ?4 0(?: international)?
cc-by-nc-3.0 | cc by nc(?: v)? ?3 0(?: unported)?
cc-by-nc-4.0 | cc by nc(?: v)? ?4 0(?: international)?
cc-by-nd-3.0 | cc by nd(?: v)? ?3 0(?: unported)?
cc-by-nd-4.0 | cc by nd(?: v)? ?4 0(?: international)?
cc-by-nc-sa-3.0 | cc by nc sa(?: v)? ?3 0(?: unported)?
cc-by-nc-sa-4.0 | cc by nc sa(?: v)? ?4 0(?: international)?
cc-by-nc-nd-3.0 | cc by nc nd(?: v)? ?3 0(?: unported)?
cc-by-nc-nd-4.0 | cc by nc nd(?: v)? ?4 0(?: international)?
cc0-1.0 | to the extent possible under law (?:[a-z0-9]+ ){1,10}(?:has|have) waived all copyright and related or neighbou?ring rights
cc0-1.0 | the person who associated a work with this deed has dedicated the work to the public domain
public-domain | (?:dedicated to|placed in|released into|in) the public domain
public-domain | public domain mark(?: 1 0)?
public-domain | (?:no|without) copyright (?:is )?(?:claimed|asserted)
public-domain | this (?:file|code|work|program|software|document) (?:is|has been) (?:hereby )?(?:placed|put|released) (?:in|into) the public domain
public-domain-us | not subject to copyright protection (?:in|within) the united states
public-domain-us | work of (?:the|an officer or employee of the) (?:united states|u s) government
pddl-1.0 | the rightsholder waives (?:all )?rights in the database under the public domain dedication and license
odbl-1.0 | this (?:[a-z0-9]+ ){1,6}is made available under the open database license
odbl-1.0 | openstreetmap contributors
odc-by-1.0 | is made available under the open data commons attribution license
ogl-uk-3.0 | contains public sector information licensed under the open government licence(?: v3 0)?
ogl-uk | open government licen[cs]e(?: v ?[0-9](?: 0)?)?
etalab-2.0 | licence ouverte(?: v(?:ersion)? ?2 0)?
dl-de-by-2.0 | datenlizenz deutschland (?:namensnennung|zero)(?: version)?(?: 2 0)?
cdla | community data license agreement (?:permissive|sharing)(?: version)?(?: [12] 0)?
proprietary | all rights reserved
proprietary | (?:this|the) (?:document|file|software|material|information)(?: is| contains)?(?: [a-z]+){0,4} confidential (?:and|or) proprietary
proprietary | unauthori[sz]ed (?:copying|reproduction|distribution|use)(?: or (?:copying|reproduction|distribution|use))? of this (?:file|program|software|document|material)
proprietary | no part of this (?:publication|book|document|work|material|site) may be reproduced
proprietary | may not be (?:copied|reproduced|published|broadcast|rewritten|redistributed)(?: or (?:copied|redistributed))? without (?:the )?(?:express )?(?:prior )?(?:written )?permission
proprietary | (?:for|only for) internal use only
proprietary | (?:end user|software) licen[cs]e agreement
proprietary | by (?:installing|downloading|using|copying) (?:or (?:installing|downloading|using|copying) )?(?:the|this) software you agree to (?:be bound by )?the terms
proprietary | this material may not be published broadcast rewritten or redistributed
proprietary-nc | for (?:personal|private)(?: and| or)? non ?commercial use only
proprietary-trial | (?:evaluation|trial) (?:version|licen[cs]e)(?: only)?(?: expires| is limited)
zlib | this software is provided as is without any express or implied warranty
zlib | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib | this notice may not be removed or altered from any source distribution
libpng | the png reference library is supplied as is
libtiff | copyright(?: c)?(?: [0-9]{4})+ (?:sam leffler|silicon graphics inc)
ijg | this software is based in part on the work of the independent jpeg group
bzip2 | copyright(?: c)?(?: [0-9]{4})+ julian (?:r )?seward
boost | permission is hereby granted free of charge to any person or organization obtaining a copy
bsl-1.0 | distributed under the boost software license
bsl-1.0 | see accompanying file license 1 0 txt or copy at
unlicense | this is free and unencumbered software released into the public domain
unlicense | anyone is free to copy modify publish use compile sell or distribute this software
unlicense | for more information please refer to https? unlicense org
wtfpl | you just do what the fuck you want to
wtfpl | everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed
beerware | (?:the )?beer ?ware license
beerware | as long as you retain this notice you can do whatever you want with this stuff
json | the software shall be used for good not evil
postgresql | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
postgresql | portions copyright(?: c)?(?: [0-9]{4})+ (?:the )?postgresql global development group
python-2.0 | psf is making python available to licensee on an as is basis
python-2.0 | copyright(?: c)?(?: [0-9]{4})+ python software foundation
python-cnri | cnri open source license agreement
php-3.01 | this product includes php(?: software)? freely available from
php-3.01 | products derived from this software may not be called php
ruby | you can redistribute it and or modify it under either the terms of the (?:gpl version 2|gpl|2 clause bsdl)
perl | you (?:can|may) redistribute it and or modify it under the same terms as perl(?: itself)?
perl | this (?:library|module|package|program) is free software you (?:can|may) (?:use modify and )?redistribute it under the same terms as perl
artistic | (?:licensed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?artistic license
artistic-2.0 | this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed
openssl | this product includes software developed by the openssl project
openssl | the names openssl toolkit and openssl project must not be used to endorse
ssleay | this product includes cryptographic software written by eric young
curl | copyright(?: c)?(?: [0-9]{4})+ daniel stenberg
ofl-1.1 | this font software is licensed under the sil open font license
ofl-1.1 | with reserved font name
ofl-1.1 | the font software may be sold as part of a larger software package but no copy of one or more of the font software typefaces may be sold by itself
ubuntu-font-1.0 | ubuntu font licen[cs]e(?: version)?(?: 1 0)?
bitstream-vera | bitstream vera is a trademark of bitstream inc
lppl | (?:latex|the latex) project public license(?: (?:version )?1 [0-3](?: ?[abc])?)?
lppl | this work may be distributed and or modified under the conditions of the latex project public license
qpl-1.0 | distributed under the (?:terms of the )?q public license
ms-pl | this license governs use of the accompanying software if you use the software you accept this license
ms-eula | microsoft software license terms
ms-eula | microsoft limited public license
apple-apsl | apple public source license(?: version)?(?: (?:1 [012]|2 0))?
apple-apsl | this file contains original code and or modifications of original code as defined in and that are subject to the apple public source license
intel | intel (?:open source|simplified software) license
ibm-ipl | this program and the accompanying materials are made available under the terms of the ibm public license
nasa-1.3 | nasa open source agreement(?: version)?(?: 1 3)?
cecill | cecill (?:free software )?licen[cs]e(?: agreement)?(?: version)?(?: [0-9])?(?: [0-9])?
cecill | (?:licence|license) cecill
eupl | licensed under the eupl
eupl | european union public licen[cs]e
mulan-2.0 | mulan permissive software license v(?:ersion )?2
anti-996 | anti 996 license(?: version 1 0)?
hippocratic | hippocratic license(?: (?:version )?[0-9] [0-9])?
elastic-2.0 | you may not provide the software to third parties as a hosted or managed service
sspl-1.0 | if you make the functionality of the program or a modified version available to third parties as a service
busl-1.1 | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
commons-clause | commons clause(?: license condition)?(?: v(?:ersion)? ?1 0)?
polyform | polyform (?:noncommercial|small business|shield|perimeter|strict|free trial) license(?: 1 0 [01])?
openrail | (?:creativeml |bigscience )?(?:openrail|open rail)(?: m| s)?(?: license)?
openrail | you agree not to use the model or derivatives of the model
llama | llama [0-9](?: [0-9])? community license agreement
gemma | gemma terms of use
dual | (?:dual|multi) ?licen[cs]ed under
see-file | see (?:the )?(?:file |files )?(?:license|copying|copyright|notice)(?: txt| md| rst)? (?:file )?for (?:details|more information|copying|licen[cs]e|the licen[cs]e|licensing)
see-file | (?:license|licence|copying)(?: txt| md| rst)? (?:file )?(?:in|at) the (?:root|top)(?: level)?(?: directory)?
gpl | copyright(?: c)?(?: [0-9]{4})+ free software foundation(?: inc)?
mit | copyright(?: c)?(?: [0-9]{4})+(?: by)?(?: the)? massachusetts institute of technology
apache | copyright(?: c)?(?: [0-9]{4})+ the apache software foundation
mpl | copyright(?: c)?(?: [0-9]{4})+(?: the)? mozilla (?:foundation|corporation)
epl | copyright(?: c)?(?: [0-9]{4})+(?: the)? eclipse foundation(?: inc| and others)?
zlib | copyright(?: c)?(?: [0-9]{4})+(?: by)? (?:jean loup gailly|mark adler)
bsl-1.0 | copyright(?: c)?(?: [0-9]{4})+ (?:beman dawes|david abrahams)
x11 | copyright(?: c)?(?: [0-9]{4})+(?: the)? (?:x consortium|open group)
w3c | copyright(?: c)?(?: [0-9]{4})+ (?:w3c|world wide web consortium)
unicode | copyright(?: c)?(?: [0-9]{4})+ unicode inc(?: all rights reserved)?
mit | (?:license|licence|copying) mit(?: txt| md)?
apache-2.0 | (?:license|licence) apache(?: 2 0)?(?: txt| md)?
bsd | (?:license|licence) bsd(?: txt| md)?
gpl | (?:copying|license) (?:gpl|gplv[23])(?: txt| md)?
lgpl | (?:copying|license) (?:lib|lesser|lgpl)(?: txt| md)?
mit | licen[cs]es? (?:name|type) (?:the )?mit(?: license)?
apache-2.0 | licen[cs]es? (?:name |type )?apache 2 0
bsd-2 | licen[cs]es? (?:name |type )?bsd 2 clause
bsd-3 | licen[cs]es? (?:name |type )?bsd 3 clause
isc | licen[cs]es? (?:name |type )isc
gpl-2.0 | licen[cs]es? (?:name |type )?gpl 2 0(?: only| or later)?
gpl-3.0 | licen[cs]es? (?:name |type )?gpl 3 0(?: only| or later)?
lgpl-3.0 | licen[cs]es? (?:name |type )?lgpl 3 0(?: only| or later)?
agpl-3.0 | licen[cs]es? (?:name |type )?agpl 3 0(?: only| or later)?
mpl-2.0 | licen[cs]es? (?:name |type )?mpl 2 0
cc0-1.0 | licen[cs]es? (?:name |type )?cc0 1 0
unlicense | licen[cs]es? (?:name |type )?unlicense
mit | img shields io badge license mit (?:blue|green|yellow|brightgreen)(?: svg)?
debian-apache-2.0 | usr share common licenses apache 2 0
debian-artistic | usr share common licenses artistic
debian-bsd | usr share common licenses bsd
debian-gfdl | usr share common licenses gfdl(?: 1 [23])?
debian-gpl | usr share common licenses gpl(?: [123])?
debian-lgpl | usr share common licenses lgpl(?: 2 1| 2| 3)?
debian-mpl | usr share common licenses mpl(?: 1 1| 2 0)?
apache | license osi approved apache software license
bsd | license osi approved bsd license
gpl | license osi approved gnu general public license(?: v[23])?
isc | license osi approved isc license(?: iscl)?
lgpl | license osi approved gnu lesser general public license(?: v[23])?
mit | license osi approved mit license
mpl-2.0 | license osi approved mozilla public license 2 0
python-2.0 | license osi approved python software foundation license
"""
#: Names without a version, after those with one: label | expression.
GENERAL = r"""
agpl | (?:gnu )?affero general public licen[cs]e
lgpl | (?:gnu )?(?:lesser|library) general public licen[cs]e
gfdl | gnu free documentation licen[cs]e
gpl | (?:gnu )?general public licen[cs]e
apache | apache (?:software )?licen[cs]e
mpl | mozilla public licen[cs]e
bsd | bsd licen[cs]e
artistic | artistic licen[cs]e
cc | creative commons licen[cs]e
cc-by | cc by
cc-by-sa | cc by sa
cc-by-nc | cc by nc
cc-by-nd | cc by nd
cc-by-nc-sa | cc by nc sa
cc-by-nc-nd | cc by nc nd
mit | mit licen[cs]e
"""


class Rule(NamedTuple):
    name: str
    label: str
    #: Every match holds one of these.
    keywords: tuple[str, ...]
    pattern: re.Pattern
    priority: int


def _held(parsed) -> tuple[str, ...]:
    """Texts of which every match of a parsed expression holds one: of those known, the set with the longest least text."""
    candidates: list[tuple[str, ...]] = []
    run = ""

    def ended() -> None:
        nonlocal run
        if run:
            candidates.append((run,))
        run = ""

    for op, value in parsed:
        kind = str(op)
        if kind == "LITERAL":
            run += chr(value)
            continue
        ended()
        if kind == "SUBPATTERN":
            candidates.append(_held(value[3]))
        elif kind == "BRANCH":
            parts = [_held(branch) for branch in value[1]]
            if all(parts):
                candidates.append(tuple(sorted({x for part in parts for x in part})))
        elif kind == "MAX_REPEAT" and value[0] > 0:
            candidates.append(_held(value[2]))
    ended()
    return max(candidates, key=lambda c: min(map(len, c), default=0), default=())


def keywords(expression: str) -> tuple[str, ...]:
    found = _held(re._parser.parse(expression))
    if not found:
        raise ValueError(f"no keyword in {expression}")
    return found


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, first those of highest priority: identifiers, pages, clauses, names with version, names."""
    found = []

    def add(kind: str, label: str, expression: str, priority: int) -> None:
        # The blank before a match begins it, so that matches are looked for by a literal.
        pattern = re.compile(b" " + expression.encode() + rb"(?= )")
        found.append(Rule(f"{kind}:{label}:{len(found)}", label, keywords(expression), pattern, priority))

    for line in FAMILIES.strip().splitlines():
        label, spdx, name, page = (x.strip() for x in line.split(" | "))
        add("spdx", label, f"spdx license identifier {spdx}(?: only| or later)?", 100)
        add("page", label, f"https? (?:www )?{page.removeprefix('www ')}", 90)
        add("name", label, name, 70)
    for line in CLAUSES.strip().splitlines():
        label, expression = (x.strip() for x in line.split(" | "))
        add("clause", label, expression, 80)
    for line in GENERAL.strip().splitlines():
        label, expression = (x.strip() for x in line.split(" | "))
        add("general", label, expression, 50 + len(expression) // 8)
    return tuple(sorted(found, key=lambda r: (-r.priority, r.name)))


@cache
def _gates() -> ahocorasick.Automaton:
    """All keywords at once, each with the rules that it opens."""
    opened: dict[str, list[int]] = {}
    for k, r in enumerate(rules()):
        for word in r.keywords:
            opened.setdefault(word, []).append(k)
    out = ahocorasick.Automaton()
    for word, ks in opened.items():
        out.add_word(word, tuple(ks))
    out.make_automaton()
    return out


#: Letters lower-cased; other ASCII signs but digits become spaces; all bytes of other characters stay.
_NORMAL = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def normalised(text: bytes) -> tuple[bytes, int]:
    """Words with single spaces between, before and after them; their number."""
    found = text.translate(_NORMAL).split()
    return b" " + b" ".join(found) + b" ", len(found)


def places(words: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which the phrase's words stand."""
    out, at, counted, n = [], words.find(b" " + phrase + b" "), 0, 0
    while at >= 0:
        n += words.count(b" ", counted, at)
        counted = at
        out.append(n)
        at = words.find(b" " + phrase + b" ", at + 1)
    return out


def outermost(found: list[tuple[Rule, int, int]]) -> list[tuple[Rule, int, int]]:
    """Detections that lie within none of higher priority and none before them of their own, by a sweep per priority."""
    found = sorted(found, key=lambda x: (-x[0].priority, x[1], -x[2], x[0].name))
    accepted: list[tuple[Rule, int, int]] = []
    spans: list[tuple[int, int]] = []
    for _, level in groupby(found, key=lambda x: x[0].priority):
        # By start, the furthest end of all accepted spans up to there.
        starts, reach = [a for a, _ in spans], list(accumulate((b for _, b in spans), max))
        furthest, fresh = -1, []
        for x in level:
            _, a, b = x
            i = bisect.bisect_right(starts, a) - 1
            if b > furthest and (i < 0 or reach[i] < b):
                furthest = b
                accepted.append(x)
                fresh.append((a, b))
        spans = sorted(spans + fresh)
    return accepted


def detections(words: bytes) -> list[tuple[Rule, int, int]]:
    """Accepted detections (rule, first word, last word), first those of highest priority."""
    opened: set[int] = set()
    for _, ks in _gates().iter(words.decode("latin-1")):
        opened.update(ks)
    found = [(r, m.start() + 1, m.end()) for r in (rules()[k] for k in sorted(opened)) for m in r.pattern.finditer(words)]
    if not found:
        return []
    blanks = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    found = outermost(found)
    first, last = (np.searchsorted(blanks, [x[k] for x in found]) - 1 for k in (1, 2))
    return [(x[0], a, b) for x, a, b in zip(found, first.tolist(), last.tolist(), strict=True)]


def _texts(b: pa.RecordBatch) -> Iterator[tuple[int | None, bytes, int]]:
    buf, at = K.buffer_of(b.column("text"))
    raw, at = buf.tobytes(), at.tolist()
    for i, start, end in zip(b.column("id").to_pylist(), at[:-1], at[1:], strict=True):
        yield i, *normalised(raw[start:end])


def license_detections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per accepted detection."""
    common.bounded_batches(common.session(docs))
    schema = common.struct(DETECTIONS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches):
            rows = [{"doc_id": i, "rule": r.name, "label": r.label, "first_word": a, "last_word": e, "priority": r.priority} for i, words, _ in _texts(b) for r, a, e in detections(words)]
            yield pa.RecordBatch.from_pylist(rows, schema=common.arrow_schema(schema))

    return common.texts_of(docs, id_col, text_col).mapInArrow(common.tidied(run), schema)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: number of words, places of base phrases, base labels, all labels and a score.

    score: 1 - the product of (1 - priority / 100) over accepted detections, 0 where there is none.
    """
    common.bounded_batches(common.session(docs))
    schema = common.struct(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = [(p.encode(), label) for p, label in BASE]
        for b in common.slices(batches):
            rows = []
            for i, words, n in _texts(b):
                at = [(k, label) for phrase, label in base for k in places(words, phrase)]
                own = sorted({label for _, label in at})
                found = detections(words)
                labels = sorted({*own, *(r.label for r, _, _ in found)})
                doubt = 1.0
                for r, _, _ in found:
                    doubt *= 1 - r.priority / 100
                where = [k for k, _ in at]
                rows.append((i, n, len(at), min(where, default=None), max(where, default=None), ",".join(own), ",".join(labels), round(1 - doubt, 9)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(common.arrow_schema(schema))], schema=common.arrow_schema(schema))

    return common.texts_of(docs, id_col, text_col).mapInArrow(common.tidied(run), schema)
