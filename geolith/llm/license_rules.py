"""Signature rules for licences: regular expressions over lower-case words.

A rule reads the document's words, lower-cased and joined by single spaces, so that a pattern needs no care
for punctuation or line breaks: "Apache License, Version 2.0" reads "apache license version 2 0". Every rule
has keywords, taken from its pattern, of which one stands in every match, a priority (larger wins) and a score.
Phrases and names are written out licence by licence; grants, tags and headers follow from each licence's names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: Licence label, SPDX tag as words, pattern of its names.
LICENCES: list[tuple[str, str, str]] = [
    ("mit", "mit", r"mit(?: x11)?|x11|expat"),
    ("mit-0", "mit 0", r"mit no attribution|mit 0"),
    ("apache", "apache", r"apache(?: software)?"),
    ("apache-1.0", "apache 1 0", r"apache(?: software)?(?: license)? (?:version |v)?1 0"),
    ("apache-1.1", "apache 1 1", r"apache(?: software)?(?: license)? (?:version |v)?1 1"),
    ("apache-2.0", "apache 2 0", r"apache(?: software)?(?: license)? (?:version |v)?2(?: 0)?|asl 2 0"),
    ("gpl", "gpl", r"gnu gpl|gpl"),
    ("gpl-1.0", "gpl 1 0", r"(?:gnu )?gpl ?(?:version |v)?1(?: 0)?|gnu general public license (?:version |v)1"),
    ("gpl-2.0", "gpl 2 0", r"gpl ?(?:version |v)?2(?: 0)?|gnu general public license (?:version |v)2"),
    ("gpl-3.0", "gpl 3 0", r"gpl ?(?:version |v)?3(?: 0)?|gnu general public license (?:version |v)3"),
    ("lgpl", "lgpl", r"lgpl|gnu (?:lesser|library) general public license|(?:lesser|library) gpl"),
    ("lgpl-2.0", "lgpl 2 0", r"lgpl ?(?:version |v)?2(?: 0)?|library general public license (?:version |v)2(?: 0)?"),
    ("lgpl-2.1", "lgpl 2 1", r"lgpl ?(?:version |v)?2 1|lesser general public license (?:version |v)2 1"),
    ("lgpl-3.0", "lgpl 3 0", r"lgpl ?(?:version |v)?3(?: 0)?|lesser general public license (?:version |v)3(?: 0)?"),
    ("agpl-1.0", "agpl 1 0", r"agpl ?(?:version |v)?1(?: 0)?|affero general public license (?:version |v)1"),
    ("agpl-3.0", "agpl 3 0", r"agpl ?(?:version |v)?3(?: 0)?|(?:gnu )?affero general public license(?: (?:version |v)3(?: 0)?)?"),
    ("gfdl-1.1", "gfdl 1 1", r"gfdl ?(?:version |v)?1 1|gnu free documentation license (?:version |v)1 1"),
    ("gfdl-1.2", "gfdl 1 2", r"gfdl ?(?:version |v)?1 2|gnu free documentation license (?:version |v)1 2"),
    ("gfdl-1.3", "gfdl 1 3", r"gfdl(?: ?(?:version |v)?1 3)?|gnu free documentation license(?: (?:version |v)1 3)?"),
    ("bsd", "bsd", r"bsd(?: style| type)?"),
    ("bsd-0-clause", "0bsd", r"0bsd|bsd (?:zero|0) clause|zero clause bsd"),
    ("bsd-2-clause", "bsd 2 clause", r"bsd (?:two|2) clause|(?:two|2) clause bsd|simplified bsd|freebsd"),
    ("bsd-3-clause", "bsd 3 clause", r"bsd (?:three|3) clause|(?:three|3) clause bsd|(?:new|modified|revised) bsd"),
    ("bsd-4-clause", "bsd 4 clause", r"bsd (?:four|4) clause|(?:four|4) clause bsd|(?:original|old) bsd"),
    ("isc", "isc", r"isc|internet systems consortium"),
    ("mpl-1.0", "mpl 1 0", r"mpl (?:version |v)?1 0|mozilla public license (?:version |v)?1 0"),
    ("mpl-1.1", "mpl 1 1", r"mpl (?:version |v)?1 1|mozilla public license (?:version |v)?1 1"),
    ("mpl-2.0", "mpl 2 0", r"mpl (?:version |v)?2(?: 0)?|mozilla public license(?: (?:version |v)?2(?: 0)?)?"),
    ("epl-1.0", "epl 1 0", r"epl (?:version |v)?1 0|eclipse public license (?:version |v)?1 0"),
    ("epl-2.0", "epl 2 0", r"epl (?:version |v)?2 0|eclipse public license(?: (?:version |v)?2 0)?"),
    ("edl-1.0", "edl 1 0", r"eclipse distribution license"),
    ("cddl-1.0", "cddl 1 0", r"cddl(?: (?:version |v)?1 0)?|common development and distribution license"),
    ("cddl-1.1", "cddl 1 1", r"cddl (?:version |v)?1 1|common development and distribution license (?:version |v)?1 1"),
    ("cpl-1.0", "cpl 1 0", r"common public license|cpl (?:version |v)?1 0"),
    ("ibmpl-1.0", "ipl 1 0", r"ibm public license"),
    ("artistic-1.0", "artistic 1 0", r"artistic license(?: 1 0)?|perl artistic"),
    ("artistic-2.0", "artistic 2 0", r"artistic license (?:version |v)?2(?: 0)?"),
    ("afl-3.0", "afl 3 0", r"academic free license"),
    ("osl-3.0", "osl 3 0", r"open software license"),
    ("apsl-2.0", "apsl 2 0", r"apple public source license"),
    ("aladdin", "aladdin", r"aladdin free public license"),
    ("boost-1.0", "bsl 1 0", r"boost software license"),
    ("busl-1.1", "busl 1 1", r"business source license"),
    ("sspl-1.0", "sspl 1 0", r"server side public license"),
    ("elastic-2.0", "elastic 2 0", r"elastic license"),
    ("commons-clause", "commons clause", r"commons clause"),
    ("cc0-1.0", "cc0 1 0", r"cc0(?: 1 0)?|creative commons zero"),
    ("cc-by", "cc by", r"cc by|creative commons attribution"),
    ("cc-by-2.0", "cc by 2 0", r"cc by 2 0|creative commons attribution 2 0"),
    ("cc-by-3.0", "cc by 3 0", r"cc by 3 0|creative commons attribution 3 0"),
    ("cc-by-4.0", "cc by 4 0", r"cc by 4 0|creative commons attribution 4 0"),
    ("cc-by-sa", "cc by sa", r"cc by sa|creative commons attribution share ?alike"),
    ("cc-by-sa-3.0", "cc by sa 3 0", r"cc by sa 3 0|creative commons attribution share ?alike 3 0"),
    ("cc-by-sa-4.0", "cc by sa 4 0", r"cc by sa 4 0|creative commons attribution share ?alike 4 0"),
    ("cc-by-nc", "cc by nc", r"cc by nc|creative commons attribution non ?commercial"),
    ("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa|creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nd", "cc by nd", r"cc by nd|creative commons attribution no ?deriv(?:ative)?s?"),
    ("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?"),
    ("odbl-1.0", "odbl 1 0", r"odbl|open database license"),
    ("odc-by-1.0", "odc by 1 0", r"odc by|open data commons attribution license"),
    ("pddl-1.0", "pddl 1 0", r"pddl|public domain dedication and license"),
    ("unlicense", "unlicense", r"the unlicense|unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl|do what the f\S* you want to public license"),
    ("zlib", "zlib", r"zlib(?: libpng)?|libpng"),
    ("curl", "curl", r"curl license"),
    ("openssl", "openssl", r"openssl license|openssl"),
    ("ssleay", "ssleay", r"ssleay"),
    ("php-3.0", "php 3 0", r"php license (?:version |v)?3 0"),
    ("php-3.01", "php 3 01", r"php license(?: (?:version |v)?3 01)?"),
    ("python-2.0", "python 2 0", r"python software foundation license|psf license"),
    ("ruby", "ruby", r"ruby license"),
    ("postgresql", "postgresql", r"postgresql license"),
    ("ncsa", "ncsa", r"university of illinois ncsa(?: open source)?|ncsa open source"),
    ("hpnd", "hpnd", r"historical permission notice and disclaimer"),
    ("w3c", "w3c", r"w3c software(?: notice and)? license"),
    ("ms-pl", "ms pl", r"microsoft public license|ms pl"),
    ("ms-rl", "ms rl", r"microsoft reciprocal license|ms rl"),
    ("ofl-1.1", "ofl 1 1", r"sil open font license|ofl 1 1|open font license"),
    ("lppl-1.3c", "lppl 1 3c", r"latex project public license|lppl"),
    ("vim", "vim", r"vim license"),
    ("ecl-2.0", "ecl 2 0", r"educational community license"),
    ("eupl-1.1", "eupl 1 1", r"eupl (?:version |v)?1 1|european union public licen[cs]e (?:version |v)?1 1"),
    ("eupl-1.2", "eupl 1 2", r"eupl(?: (?:version |v)?1 2)?|european union public licen[cs]e(?: (?:version |v)?1 2)?"),
    ("cecill-2.1", "cecill 2 1", r"cecill"),
    ("mulan-2.0", "mulanpsl 2 0", r"mulan permissive software license|mulanpsl"),
    ("upl-1.0", "upl 1 0", r"universal permissive license"),
    ("sleepycat", "sleepycat", r"sleepycat license"),
    ("sissl", "sissl", r"sun industry standards source license"),
    ("qpl-1.0", "qpl 1 0", r"q public license|qpl"),
    ("rpl-1.5", "rpl 1 5", r"reciprocal public license"),
    ("spl-1.0", "spl 1 0", r"sun public license"),
    ("watcom-1.0", "watcom 1 0", r"sybase open watcom public license"),
    ("zpl-2.1", "zpl 2 1", r"zope public license"),
    ("naist-2003", "naist 2003", r"naist license"),
    ("unicode", "unicode dfs 2016", r"unicode license(?: agreement)?"),
    ("beerware", "beerware", r"beer ?ware license|beerware"),
    ("json", "json", r"json license"),
    ("blueoak-1.0.0", "blueoak 1 0 0", r"blue oak model license"),
    ("parity-7.0.0", "parity 7 0 0", r"parity public license"),
    ("polyform-nc-1.0.0", "polyform noncommercial 1 0 0", r"polyform noncommercial license"),
    ("openrail", "openrail", r"open ?rail(?: m)?(?: license)?"),
    ("llama", "llama", r"llama \d(?: \d)? community license"),
]

#: Phrases from licence texts and notices, licence by licence: label, score, patterns.
PHRASES: list[tuple[str, float, tuple[str, ...]]] = [
    ("mit", 0.99, (
        r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies",
    )),
    ("mit", 0.9, (
        r"the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software",
        r"mit license", r"(?:the )?mit licen[cs]e mit", r"same (?:license|terms) as mit", r"mit x11 licen[cs]e", r"x11 licen[cs]e", r"expat licen[cs]e",
    )),
    ("mit", 0.6, (r"in no event shall the authors or copyright holders be liable for any claim damages or other liability", r"the software is provided as is without warranty of any kind express or implied")),
    ("mit-0", 0.95, (r"mit no attribution", r"to permit persons to whom the software is furnished to do so the software is provided as is")),
    ("apache", 0.9, (r"apache license", r"apache software license", r"apache software foundation", r"asf licenses this file to you")),
    ("apache-1.0", 0.9, (r"this product includes software developed by the apache group for use in the apache http server project",)),
    ("apache-1.1", 0.9, (r"this product includes software developed by the apache software foundation", r"products derived from this software may not be called apache nor may apache appear in their name")),
    ("apache-2.0", 0.99, (
        r"apache org licenses license 2 0", r"licensed under the apache license version 2 0 the license", r"terms and conditions for use reproduction and distribution 1 definitions",
        r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|except as stated in this section patent) license",
        r"you must cause any modified files to carry prominent notices stating that you changed the files", r"apache ?2(?: 0)? licen[cs]ed?",
    )),
    ("apache-2.0", 0.9, (
        r"you may not use this file except in compliance with the license", r"you may obtain a copy of the license at http s? ?www apache org", r"see the license for the specific language governing permissions and limitations under the license",
        r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
        r"if the work includes a notice text file as part of its distribution",
    )),
    ("bsd", 0.95, (
        r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation",
    )),
    ("bsd", 0.8, (r"bsd licen[cs]ed?", r"bsd style licen[cs]e", r"the regents of the university of california all rights reserved", r"use of this source code is governed by a bsd style license")),
    ("bsd-0-clause", 0.9, (r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided", r"zero clause bsd")),
    ("bsd-2-clause", 0.9, (r"the views and conclusions contained in the software and documentation are those of the authors", r"bsd 2 clause licen[cs]e", r"simplified bsd licen[cs]e", r"freebsd licen[cs]e")),
    ("bsd-3-clause", 0.95, (
        r"neither the name of (?:the )?(?:\S+ ){1,8}?nor the names of (?:its|his|their) contributors may be used to endorse or promote", r"the names? of (?:the|its) (?:author|contributors) may not be used to endorse or promote products derived",
        r"bsd 3 clause licen[cs]e", r"(?:new|modified|revised) bsd licen[cs]e",
    )),
    ("bsd-4-clause", 0.95, (r"all advertising materials mentioning features or use of this software must display the following acknowledgement", r"(?:original|old) bsd licen[cs]e")),
    ("bsd-patent", 0.9, (r"each copyright holder and contributor hereby grants to those receiving rights under this license a perpetual worldwide", r"bsd plus patent licen[cs]e")),
    ("isc", 0.95, (r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", r"isc licen[cs]ed?", r"internet systems consortium inc isc")),
    ("isc", 0.6, (r"in no event shall the author be liable for any special direct indirect or consequential damages",)),
    ("gpl", 0.9, (r"general public license", r"gnu gpl", r"free software foundation inc (?:51|59|675)", r"you should have received a copy of the gnu general public license")),
    ("gpl", 0.99, (
        r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed",
        r"this program is distributed in the hope that it will be useful but without any warranty", r"the licenses for most software are designed to take away your freedom to share and change it",
    )),
    ("gpl-2.0", 0.9, (
        r"either version 2 of the license or (?:at your option )?any later version", r"gnu general public license version 2 june 1991", r"you must cause the work to be licensed as a whole at no charge to all third parties under the terms of this license",
        r"under the terms of the gnu general public license version 2", r"gplv2(?: or later)?", r"activities other than copying distribution and modification are not covered by this license",
    )),
    ("gpl-3.0", 0.9, (
        r"either version 3 of the license or (?:at your option )?any later version", r"gnu general public license version 3 29 june 2007", r"gplv3(?: or later)?", r"protecting users legal rights from anti circumvention law",
        r"to propagate a work means to do anything with it that without permission", r"the corresponding source for a work in source code form is that same work", r"under the terms of the gnu general public license version 3",
    )),
    ("gpl-with-exception", 0.85, (
        r"as a special exception you may create a larger work that contains part or all of the", r"gcc runtime library exception", r"classpath exception", r"linking this library statically or dynamically with other modules is making a combined work",
        r"as a special exception if you link this (?:library|unit) with other files", r"autoconf configure script exception", r"bison exception", r"font embedding exception",
    )),
    ("lgpl", 0.95, (
        r"gnu lesser general public license", r"gnu library general public license", r"lesser gpl", r"library gpl", r"this library is free software you can redistribute it and or modify it under the terms of the gnu",
        r"this library is distributed in the hope that it will be useful", r"a program that contains no derivative of any portion of the library but is designed to work with the library",
    )),
    ("lgpl-2.1", 0.9, (r"either version 2 1 of the license or (?:at your option )?any later version", r"gnu lesser general public license version 2 1 february 1999", r"lgplv2 1(?: or later)?")),
    ("lgpl-3.0", 0.9, (r"this version of the gnu lesser general public license incorporates the terms and conditions of version 3", r"lgplv3(?: or later)?", r"gnu lesser general public license version 3 29 june 2007")),
    ("agpl-3.0", 0.95, (
        r"gnu affero general public license", r"agplv3(?: or later)?", r"your modified version must prominently offer all users interacting with it remotely through a computer network", r"remote network interaction use with the gnu general public license",
        r"affero gpl",
    )),
    ("gfdl", 0.9, (
        r"gnu free documentation license", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license",
        r"with no invariant sections no front cover texts and no back cover texts", r"a transparent copy of the document means a machine readable copy",
    )),
    ("mpl-1.1", 0.95, (r"the contents of this file are subject to the mozilla public license version 1 1", r"mpl 1 1 gpl 2 0 lgpl 2 1", r"software distributed under the license is distributed on an as is basis without warranty of any kind either express or implied see the license for the specific language governing rights and limitations")),
    ("mpl-2.0", 0.99, (r"this source code form is subject to the terms of the mozilla public license v 2 0", r"if a copy of the mpl was not distributed with this file", r"mozilla org mpl 2 0", r"this source code form is incompatible with secondary licenses")),
    ("npl-1.1", 0.95, (r"netscape public license", r"the contents of this file are subject to the netscape public license")),
    ("epl-1.0", 0.99, (r"this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", r"eclipse org legal epl v10", r"the accompanying program is provided under the terms of this eclipse public license agreement")),
    ("epl-2.0", 0.99, (r"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0", r"eclipse org legal epl 2 0", r"epl v20")),
    ("edl-1.0", 0.95, (r"eclipse distribution license v ?1 0", r"eclipse org org documents edl v10")),
    ("cddl-1.0", 0.95, (r"the contents of this file are subject to the terms of the common development and distribution license", r"common development and distribution license cddl", r"when distributing covered code include this cddl header")),
    ("cpl-1.0", 0.9, (r"the accompanying program is provided under the terms of this common public license", r"common public license version 1 0")),
    ("ibmpl-1.0", 0.9, (r"the accompanying program is provided under the terms of this ibm public license", r"ibm public license version 1 0")),
    ("artistic-1.0", 0.9, (r"the intent of this document is to state the conditions under which a package may be copied", r"you may make and give away verbatim copies of the source form of the standard version of this package")),
    ("artistic-2.0", 0.9, (r"this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed", r"artistic license 2 0", r"the perl foundation everyone is permitted to copy")),
    ("perl", 0.9, (r"same terms as perl itself", r"under the same terms as (?:the )?perl ?5?", r"perl artistic licen[cs]e")),
    ("afl-3.0", 0.95, (r"licensed under the academic free license version 3 0", r"academic free license afl")),
    ("osl-3.0", 0.95, (r"licensed under the open software license version 3 0", r"open software license osl")),
    ("boost-1.0", 0.99, (r"distributed under the boost software license version 1 0", r"boost org license 1 0 txt", r"to any person or organization obtaining a copy of the software and accompanying documentation covered by this license")),
    ("busl-1.1", 0.95, (r"business source license 1 1", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use", r"change date means", r"additional use grant")),
    ("sspl-1.0", 0.95, (r"server side public license version 1", r"if you make the functionality of the program or a modified version available to third parties as a service", r"mongodb com licensing server side public license")),
    ("elastic-2.0", 0.95, (r"elastic license 2 0", r"you may not provide the software to third parties as a hosted or managed service", r"you may not move change disable or circumvent the license key functionality")),
    ("commons-clause", 0.95, (r"commons clause license condition", r"the license does not grant to you the right to sell the software", r"sell means practicing any or all of the rights granted to you under the license to provide to third parties")),
    ("confluent", 0.95, (r"confluent community license", r"excluded purpose means making available any software as a service")),
    ("unlicense", 0.99, (r"this is free and unencumbered software released into the public domain", r"anyone is free to copy modify publish use compile sell or distribute this software", r"unlicense org", r"we make this dedication for the benefit of the public at large")),
    ("cc0-1.0", 0.99, (
        r"creativecommons org publicdomain zero 1 0", r"cc0 1 0 universal", r"creative commons zero", r"the person who associated a work with this deed has dedicated the work to the public domain",
        r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives", r"to the extent possible under law (?:\S+ ){1,8}?(?:has|have) waived all copyright",
    )),
    ("cc-by", 0.9, (r"creative commons attribution", r"you must give appropriate credit provide a link to the license and indicate if changes were made", r"cc by licen[cs]e", r"this work is licensed under a creative commons attribution")),
    ("cc-by-sa", 0.95, (r"creative commons attribution share ?alike", r"if you remix transform or build upon the material you must distribute your contributions under the same license", r"cc by sa", r"share alike licen[cs]e")),
    ("cc-by-nc", 0.95, (r"creative commons attribution non ?commercial", r"you may not use the material for commercial purposes", r"cc by nc")),
    ("cc-by-nd", 0.95, (r"creative commons attribution no ?deriv(?:ative)?s?", r"if you remix transform or build upon the material you may not distribute the modified material", r"cc by nd")),
    ("cc-by-nc-sa", 0.97, (r"creative commons attribution non ?commercial share ?alike", r"cc by nc sa")),
    ("cc-by-nc-nd", 0.97, (r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?", r"cc by nc nd")),
    ("creative-commons", 0.8, (r"creative commons (?:public )?licen[cs]e", r"some rights reserved", r"creative commons is not a law firm and does not provide legal services")),
    ("odbl-1.0", 0.95, (r"open database license", r"opendatacommons org licenses odbl", r"this database is made available under the open database license", r"openstreetmap contributors", r"any rights in individual contents of the database are licensed under the database contents license")),
    ("odc-by-1.0", 0.95, (r"open data commons attribution license", r"opendatacommons org licenses by")),
    ("pddl-1.0", 0.95, (r"public domain dedication and license", r"opendatacommons org licenses pddl")),
    ("cdla-permissive", 0.95, (r"community data license agreement permissive", r"cdla permissive")),
    ("cdla-sharing", 0.95, (r"community data license agreement sharing", r"cdla sharing")),
    ("ogl-uk", 0.95, (r"open government licen[cs]e", r"contains public sector information licensed under the open government licence")),
    ("etalab", 0.9, (r"licence ouverte", r"etalab open licen[cs]e")),
    ("dl-de-by", 0.9, (r"datenlizenz deutschland (?:namensnennung|zero)", r"dl de by 2 0")),
    ("zlib", 0.9, (
        r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software",
        r"altered source versions must be plainly marked as such", r"this notice may not be removed or altered from any source distribution", r"zlib licen[cs]e",
    )),
    ("libpng", 0.9, (r"libpng versions \d \d \d", r"png reference library licen[cs]e", r"the png reference library is supplied as is")),
    ("libtiff", 0.9, (r"the names of sam leffler and silicon graphics may not be used in any advertising",)),
    ("ijg", 0.9, (r"this software is based in part on the work of the independent jpeg group", r"independent jpeg group")),
    ("curl", 0.9, (r"curl licen[cs]e", r"copyright and permission notice copyright c (?:\S+ ){1,6}?daniel stenberg")),
    ("openssl", 0.95, (r"this product includes software developed by the openssl project", r"openssl toolkit", r"openssl licen[cs]e", r"the names openssl toolkit and openssl project must not be used to endorse")),
    ("ssleay", 0.95, (r"this product includes cryptographic software written by eric young", r"ssleay licen[cs]e", r"original ssleay license")),
    ("php-3.01", 0.95, (r"this product includes php software freely available from", r"php licen[cs]e version 3 01", r"subject to version 3 01 of the php license", r"the name php must not be used to endorse or promote products")),
    ("php-3.0", 0.95, (r"subject to version 3 0 of the php license", r"subject to version 3 00 of the php license")),
    ("python-2.0", 0.95, (r"python software foundation license", r"psf license agreement", r"psf hereby grants licensee a nonexclusive royalty free world wide license", r"beopen com license agreement", r"cnri license agreement")),
    ("ruby", 0.9, (r"ruby licen[cs]e", r"distributed under the same terms as ruby", r"ruby is copyrighted free software by yukihiro matsumoto", r"you may redistribute the software in source form provided that you do at least one of the following")),
    ("postgresql", 0.95, (r"postgresql licen[cs]e", r"postgresql database management system", r"in no event shall the university of california be liable to any party")),
    ("ncsa", 0.95, (r"university of illinois ncsa open source license", r"university of illinois at urbana champaign", r"to deal with the software without restriction")),
    ("llvm-exception", 0.95, (r"llvm exceptions to the apache 2 0 license", r"apache license v2 0 with llvm exceptions", r"apache 2 0 with llvm exception")),
    ("hpnd", 0.9, (r"historical permission notice and disclaimer", r"permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?(?:with or )?without fee is hereby granted")),
    ("ntp", 0.9, (r"permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted provided that the above copyright notice appears in all copies",)),
    ("w3c", 0.95, (r"w3c software (?:notice and )?(?:document )?licen[cs]e", r"w3c org consortium legal", r"this work and any related items are being provided by the copyright holders under the following license")),
    ("ms-pl", 0.95, (r"microsoft public licen[cs]e", r"ms pl", r"this license governs use of the accompanying software if you use the software you accept this license")),
    ("ms-rl", 0.95, (r"microsoft reciprocal licen[cs]e", r"ms rl")),
    ("ms-limited", 0.8, (r"microsoft limited (?:public|permissive) licen[cs]e", r"microsoft software license terms", r"microsoft shared source")),
    ("ofl-1.1", 0.95, (r"sil open font license", r"the font software may be sold as part of a larger software package", r"scripts sil org ofl", r"this font software is licensed under the sil open font license", r"with reserved font name")),
    ("ubuntu-font", 0.95, (r"ubuntu font licen[cs]e",)),
    ("bitstream-vera", 0.95, (r"bitstream vera is a trademark of bitstream inc", r"the font software may be modified altered or added to")),
    ("lppl-1.3c", 0.95, (r"latex project public license", r"this work may be distributed and or modified under the conditions of the latex project public license", r"this work has the lppl maintenance status")),
    ("knuth", 0.9, (r"knuth licen[cs]e", r"tex is a trademark of the american mathematical society")),
    ("vim", 0.9, (r"vim licen[cs]e", r"vim is charityware you can use and copy it as much as you like")),
    ("ecl-2.0", 0.95, (r"educational community license", r"licensed under the educational community license version 2 0")),
    ("eupl-1.1", 0.95, (r"licensed under the eupl version 1 1", r"european union public licence v ?1 1")),
    ("eupl-1.2", 0.95, (r"licensed under the eupl version 1 2", r"european union public licence v ?1 2", r"licensed under the eupl")),
    ("cecill-2.1", 0.95, (r"cecill licen[cs]e", r"cecill free software license agreement", r"governed by the cecill(?: b| c)? license under french law", r"cecill info licences")),
    ("mulan-2.0", 0.95, (r"mulan psl v2", r"mulan permissive software license", r"license coscl org cn mulanpsl2")),
    ("upl-1.0", 0.95, (r"universal permissive license", r"oss oracle com licenses upl")),
    ("oracle-bcl", 0.9, (r"oracle binary code license agreement", r"sun microsystems inc binary code license agreement", r"oracle technology network license agreement")),
    ("sleepycat", 0.95, (r"sleepycat licen[cs]e", r"redistributions in any form must be accompanied by information on how to obtain complete source code for the db software")),
    ("qpl-1.0", 0.95, (r"q public licen[cs]e", r"qt is a product of trolltech", r"this file may be distributed and or modified under the terms of the q public license")),
    ("rpl-1.5", 0.95, (r"reciprocal public licen[cs]e",)),
    ("apsl-2.0", 0.95, (r"apple public source license", r"this file contains original code and or modifications of original code as defined in and that are subject to the apple public source license", r"opensource apple com apsl")),
    ("sissl", 0.95, (r"sun industry standards source license",)),
    ("zpl-2.1", 0.95, (r"zope public license", r"subject to the provisions of the zope public license version 2 1")),
    ("cnri-jython", 0.9, (r"jython software license", r"jpython was created in late 1997 by jim hugunin")),
    ("tcl", 0.9, (r"tcl tk licen[cs]e", r"the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose")),
    ("unicode", 0.95, (r"unicode inc license agreement data files and software", r"unicode licen[cs]e(?: agreement)?", r"unicode org copyright html", r"unicode data files and any associated documentation")),
    ("icu", 0.9, (r"icu licen[cs]e icu 1 8 1 and later", r"international components for unicode")),
    ("wtfpl", 0.95, (r"everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed", r"you just do what the f\S* you want to", r"do what the f\S* you want to public licen[cs]e")),
    ("beerware", 0.95, (r"you can buy me a beer in return", r"the beer ?ware licen[cs]e", r"as long as you retain this notice you can do whatever you want with this stuff")),
    ("json", 0.95, (r"the software shall be used for good not evil", r"json licen[cs]e")),
    ("fair", 0.9, (r"usage of the works is permitted provided that this instrument is retained with the works", r"fair licen[cs]e")),
    ("wxwindows", 0.95, (r"wxwindows library licen[cs]e", r"wxwidgets licen[cs]e")),
    ("fltk", 0.95, (r"fltk license exception", r"fltk licen[cs]e")),
    ("blueoak-1.0.0", 0.95, (r"blue oak model license", r"blueoakcouncil org license 1 0 0")),
    ("parity-7.0.0", 0.95, (r"parity public license",)),
    ("prosperity", 0.95, (r"prosperity public license", r"thirty day trial period license")),
    ("polyform-nc-1.0.0", 0.95, (r"polyform noncommercial license", r"polyformproject org licenses", r"polyform (?:small business|strict|shield|perimeter|internal use) license")),
    ("hippocratic", 0.95, (r"hippocratic license", r"firstdonoharm dev")),
    ("anti-996", 0.95, (r"anti 996 license",)),
    ("openrail", 0.9, (r"bigscience open ?rail m", r"creativeml open ?rail m", r"responsible ai licen[cs]e", r"open ?rail licen[cs]e", r"use based restrictions as referenced in paragraph 5")),
    ("llama", 0.95, (r"llama \d(?: \d)? community licen[cs]e(?: agreement)?", r"if more than 700 million monthly active users", r"meta llama \d is licensed under", r"built with (?:meta )?llama")),
    ("gemma", 0.95, (r"gemma terms of use", r"gemma prohibited use policy")),
    ("naist-2003", 0.9, (r"nara institute of science and technology",)),
    ("public-domain", 0.8, (
        r"(?:released|dedicated|placed) (?:in)?to the public domain", r"(?:this|the) (?:work|file|software|code) is in the public domain", r"no copyright is claimed", r"not subject to copyright protection (?:and is|in the united states)",
        r"author disclaims copyright to this source code", r"work of the (?:u s|us|united states) government", r"creativecommons org publicdomain mark 1 0", r"may you do good and not evil",
    )),
    ("public-domain", 0.5, (r"public domain",)),
    ("proprietary", 0.8, (
        r"proprietary and confidential", r"unauthorized copying of this (?:file|software|document)", r"(?:confidential and|trade secret and) proprietary", r"trade secrets? of", r"for internal use only", r"may not be (?:reproduced|copied|distributed) without (?:the )?(?:prior )?(?:express )?(?:written )?permission",
        r"no part of this (?:publication|work|document|book) may be reproduced", r"nvidia corporation and its licensors retain all intellectual property", r"strictly prohibited without (?:the )?prior written", r"dissemination of this information or reproduction of this material is strictly forbidden",
    )),
    ("proprietary", 0.4, (r"all rights reserved", r"alle rechte vorbehalten", r"tous droits r\S+serv\S+s", r"todos los derechos reservados")),
    ("commercial", 0.7, (r"(?:end user|commercial) license agreement", r"commercial licen[cs]e", r"software license agreement", r"this software is licensed not sold", r"evaluation licen[cs]e", r"subject to the terms of your subscription")),
    ("non-commercial", 0.7, (r"(?:for )?non commercial use only", r"free for non commercial use", r"for (?:academic|research|educational) (?:use|purposes) only", r"not for commercial use", r"personal use only")),
    ("dual", 0.7, (r"dual licensed under", r"(?:licensed|available) under either of", r"at your option (?:this|the) (?:file|software) may be distributed under")),
    ("contributor-agreement", 0.6, (r"contributor license agreement", r"developer certificate of origin", r"signed off by")),
    ("copyright-notice", 0.3, (r"copyright (?:c )?(?:19|20)\d\d", r"c (?:19|20)\d\d (?:\S+ ){1,6}?all rights reserved")),
]

#: Creative Commons link paths and their labels.
CC_LINKS = {"by": "cc-by", "by sa": "cc-by-sa", "by nc": "cc-by-nc", "by nc sa": "cc-by-nc-sa", "by nd": "cc-by-nd", "by nc nd": "cc-by-nc-nd"}


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    pattern: str
    keywords: tuple[str, ...]
    priority: int
    score: float


def named(names: str) -> str:
    """Pattern of the names with the word licence after them, which those that have it in them can do without."""
    whole = [way for name in re.findall(r"(?:\([^()]*(?:\([^()]*\)[^()]*)*\)\??|[^|()])+", names) for way in ((name.replace("(?: license)?", " license"), name.replace("(?: license)?", "")) if "(?: license)?" in name else (name,))]
    own, bare = [n for n in whole if "licen" in n], [n for n in whole if "licen" not in n]
    tail = " (?:public )?licen[cs]ed?"
    return "|".join([rf"(?:{'|'.join(own)})(?:{tail})?"] * bool(own) + [rf"(?:{'|'.join(bare)}){tail}"] * bool(bare))


#: Sets of keywords no larger than this are worked out by writing options and branches out.
MOST = 32


def keywords(pattern: str) -> tuple[str, ...]:
    """Strings of which every match of the pattern has one: those of the set whose shortest is longest.

    Stretches of letters are written out through branches and options while there are few ways; what is open ends a stretch.
    """
    found = _inside(re._parser.parse(pattern))[1]
    return tuple(sorted(k for k in found if not any(other in k for other in found if other != k)))


def most_words(pattern: str) -> int:
    """The most words that a match can have."""
    names = re._parser

    def spaces(tree) -> int:
        n = 0
        for op, arg in tree:
            if op is names.LITERAL:
                n += arg == 32
            elif op is names.SUBPATTERN:
                n += spaces(arg[-1])
            elif op is names.BRANCH:
                n += max(map(spaces, arg[1]))
            elif op in (names.MAX_REPEAT, names.MIN_REPEAT) and (own := spaces(arg[2])):
                n += int(arg[1]) * own
        return n

    return spaces(names.parse(pattern)) + 1


def _better(a: frozenset[str], b: frozenset[str]) -> frozenset[str]:
    weight = lambda s: min(map(len, s), default=0)
    return max(a, b, key=weight)


def _inside(tree) -> tuple[frozenset[str] | None, frozenset[str]]:
    """All that the tree can match, if that is few strings, and the best set of strings of which each match has one."""
    names, run, best, exact = re._parser, frozenset([""]), frozenset(), True
    for op, arg in tree:
        ways, held = None, frozenset()
        if op is names.LITERAL:
            ways = frozenset([chr(arg)])
        elif op is names.IN and all(kind is names.LITERAL for kind, _ in arg):
            ways = frozenset(chr(v) for _, v in arg)
        elif op is names.SUBPATTERN:
            ways, held = _inside(arg[-1])
        elif op is names.BRANCH:
            each = [_inside(x) for x in arg[1]]
            if all(w is not None for w, _ in each):
                ways = frozenset().union(*(w for w, _ in each))
            held = frozenset().union(*(h for _, h in each)) if all(h and "" not in h for _, h in each) else frozenset()
        elif op in (names.MAX_REPEAT, names.MIN_REPEAT):
            low, high, inner = arg
            own, within = _inside(inner)
            if high == 1 and own is not None:
                ways = own | {""}
            held = within if low else frozenset()
        if ways is not None and len(run) * len(ways) <= MOST:
            run = frozenset(a + b for a in run for b in ways)
            continue
        best = _better(_better(best, run), held)
        exact = False
        run = ways if ways is not None and len(ways) <= MOST else frozenset([""])
    return (run if exact else None), _better(best, run)


def rules() -> list[Rule]:
    """All rules, in order; of detections of equal priority and length the earlier rule's stays."""
    found: list[Rule] = []

    def add(kind: str, label: str, pattern: str, priority: int, score: float) -> None:
        found.append(Rule(f"{kind}:{label}:{len(found)}", label, pattern, keywords(pattern), priority, score))

    for label, score, patterns in PHRASES:
        for pattern in patterns:
            add("phrase", label, pattern, 60, score)
    labels = [label for label, *_ in LICENCES]
    for label, tag, names in LICENCES:
        wide = 5 * any(other.startswith(f"{label}-") for other in labels)  # a family yields to its members
        add("tag", label, rf"spdx license identifier (?:\S+ )??{tag}(?: only| or later)?", 100 - wide, 1.0)
        add("grant", label, rf"(?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:{names})(?: license)?(?: version \d(?: \d)?)?", 90 - wide, 0.95)
        add("header", label, rf"licen[cs]e (?:is )?(?:the )?(?:{names})", 70 - wide, 0.8)
        add("name", label, named(names), 50 - wide, 0.7)
    for path, label in CC_LINKS.items():
        add("link", label, rf"creativecommons org licenses {path} \d \d", 95, 0.99)
        for version in ("2 0", "2 5", "3 0", "4 0"):
            add("link", f"{label}-{version.replace(' ', '.')}", rf"creativecommons org licenses {path} {version}", 96, 0.99)
    for label, path in (("mit", "mit"), ("isc", "isc"), ("bsd-2-clause", "bsd 2 clause"), ("bsd-3-clause", "bsd 3 clause"), ("mpl-2.0", "mpl 2 0"), ("apache-2.0", "apache 2 0")):
        add("link", label, rf"opensource org licenses? {path}", 95, 0.99)
    for label, path in (("gpl-2.0", "gpl 2 0"), ("gpl-3.0", "gpl 3 0"), ("lgpl-2.1", "lgpl 2 1"), ("lgpl-3.0", "lgpl 3 0"), ("agpl-3.0", "agpl 3 0"), ("gfdl-1.3", "fdl 1 3"), ("gpl", "gpl"), ("lgpl", "lgpl")):
        add("link", label, rf"gnu org (?:old )?licenses (?:old licenses )?{path}", 95, 0.99)
    return found
