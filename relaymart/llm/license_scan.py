"""License scans by ordered signature rules, in DataFrame expressions only.

A document is looked at closely if it has one of the ``STEMS``, which every
match of a rule or base phrase has; then its
lower-cased words, one blank apart, are matched against the rules whose
keywords are among them (every match of a rule has one). A detection is a rule's word interval. Of detections
in one interval the first by priority, then order, stays; one contained in
another is suppressed by it; of two that overlap in part the one of better
priority stays. Three base phrases are counted in any case, and their labels
are never suppressed.

All work is per row, without a shuffle, and linear in a text's words and matches: a
text of any length is read once a rule that may match.

Defined results: a null or empty text has no words, null word positions, empty
labels and score 0; repeated documents each have their row.
"""

from __future__ import annotations

import json
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base phrases and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
BASE_SCORE = 0.95

#: Licences by name: label, pattern of the name in words, keywords (one is needed).
NAMES: tuple[tuple[str, str, str], ...] = (
    ("mit", "mit(?: x11)?", "mit"),
    ("mit-0", "mit (?:0|no attribution)", "mit"),
    ("x11", "x11|x consortium", "x11 consortium"),
    ("isc", "isc|internet systems consortium", "isc consortium"),
    ("0bsd", "0bsd|(?:zero|0) clause bsd|bsd (?:zero|0) clause", "0bsd bsd"),
    ("bsd-2", "bsd 2 clause|(?:2|two) clause bsd|simplified bsd|freebsd", "bsd freebsd"),
    ("bsd-3", "bsd 3 clause|(?:3|three) clause bsd|(?:new|revised|modified) bsd", "bsd"),
    ("bsd-4", "bsd 4 clause|(?:4|four) clause bsd|original bsd", "bsd"),
    ("bsd", "bsd(?: style)?", "bsd"),
    ("apache-1.1", "apache(?: software)?(?: license)?(?: version)? 1 1", "apache"),
    ("apache-2", "apache(?: software)?(?: licen[cs]e)?(?: version| v)? ?(?:v2|2)(?: 0)?|asl 2 0", "apache apache2 apachev2 asl"),
    ("apache", "apache(?: software)?", "apache"),
    ("gpl-1", "(?:gnu )?gpl ?(?:v1|1)(?: 0)?|gnu general public license(?: version| v)? ?1(?: 0)?", "gpl gnu gpl1 gplv1"),
    ("gpl-2", "(?:gnu )?gpl ?(?:v2|2)(?: 0)?(?: only| or later)?|gplv2|gnu general public license(?: version| v)? ?2(?: 0)?", "gpl gnu gpl2 gplv2"),
    ("gpl-3", "(?:gnu )?gpl ?(?:v3|3)(?: 0)?(?: only| or later)?|gplv3|gnu general public license(?: version| v)? ?3(?: 0)?", "gpl gnu gpl3 gplv3"),
    ("gpl", "(?:gnu )?gpl|gnu general public", "gpl gnu"),
    ("lgpl-2", "lgpl ?(?:v2|2)(?: 0)?(?: only| or later)?|gnu library general public license(?: version)? 2(?: 0)?", "lgpl lgpl2 lgplv2 gnu"),
    ("lgpl-2.1", "lgpl ?(?:v2|2) 1(?: only| or later)?|lgplv2 1|gnu lesser general public license(?: version)? 2 1", "lgpl lgpl2 lgplv2 gnu"),
    ("lgpl-3", "lgpl ?(?:v3|3)(?: 0)?(?: only| or later)?|lgplv3|gnu lesser general public license(?: version)? 3(?: 0)?", "lgpl lgpl3 lgplv3 gnu"),
    ("lgpl", "(?:gnu )?lgpl|gnu lesser general public", "lgpl gnu"),
    ("agpl-3", "agpl ?(?:v3|3)(?: 0)?(?: only| or later)?|agplv3|gnu affero general public license(?: version)? 3(?: 0)?", "agpl agpl3 agplv3 affero"),
    ("agpl", "(?:gnu )?agpl|gnu affero general public|affero general public", "agpl affero"),
    ("gfdl", "gfdl(?: 1 [123])?|gnu free documentation", "gfdl documentation"),
    ("mpl-1.1", "mpl 1 1|mozilla public license(?: version| v)? 1 1", "mpl mozilla"),
    ("mpl-2", "mpl 2(?: 0)?|mozilla public license(?: version| v)? 2(?: 0)?", "mpl mozilla"),
    ("mpl", "mpl|mozilla public", "mpl mozilla"),
    ("epl-1", "epl 1(?: 0)?|eclipse public license(?: version| v)? 1(?: 0)?", "epl eclipse"),
    ("epl-2", "epl 2(?: 0)?|eclipse public license(?: version| v)? 2(?: 0)?", "epl eclipse"),
    ("edl-1", "edl 1 0|eclipse distribution", "edl eclipse"),
    ("cddl-1.0", "cddl(?: 1 0)?|common development and distribution", "cddl distribution"),
    ("cddl-1.1", "cddl 1 1|common development and distribution license(?: version)? 1 1", "cddl distribution"),
    ("cpl-1.0", "cpl 1 0|common public", "cpl common"),
    ("eupl-1.1", "eupl 1 1|european union public license(?: version| v)? 1 1", "eupl european"),
    ("eupl-1.2", "eupl(?: 1 2)?|european union public", "eupl european"),
    ("osl-3", "osl 3 0|open software license(?: version| v)? 3 0", "osl software"),
    ("afl-3", "afl 3 0|academic free license(?: version| v)? 3 0", "afl academic"),
    ("artistic-1", "artistic 1 0|(?:original )?artistic license 1 0", "artistic"),
    ("artistic-2", "artistic(?: license)? 2(?: 0)?", "artistic"),
    ("zlib", "zlib(?: libpng)?", "zlib"),
    ("libpng", "libpng(?: 2 0)?", "libpng"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl|do what the fuck you want to public", "wtfpl fuck"),
    ("cc0", "cc0(?: 1 0)?(?: universal)?|creative commons zero", "cc0 commons"),
    ("cc-by", "cc by(?: [1234] [05])?|creative commons attribution(?: [1234] [05])?(?: international| unported)?", "cc commons"),
    ("cc-by-sa", "cc by sa(?: [1234] [05])?|creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported)?", "cc commons"),
    ("cc-by-nc", "cc by nc(?: [1234] [05])?|creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported)?", "cc commons"),
    ("cc-by-nd", "cc by nd(?: [1234] [05])?|creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1234] [05])?", "cc commons"),
    ("cc-by-nc-sa", "cc by nc sa(?: [1234] [05])?|creative commons attribution non ?commercial share ?alike(?: [1234] [05])?", "cc commons"),
    ("cc-by-nc-nd", "cc by nc nd(?: [1234] [05])?|creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1234] [05])?", "cc commons"),
    ("odbl", "odbl(?: 1 0)?|open database", "odbl database"),
    ("odc-by", "odc by(?: 1 0)?|open data commons attribution", "odc commons"),
    ("pddl", "pddl(?: 1 0)?|open data commons public domain dedication", "pddl commons"),
    ("ofl-1.1", "ofl(?: 1 1)?|sil open font", "ofl sil"),
    ("boost", "bsl 1 0|boost software", "bsl boost"),
    ("busl-1.1", "busl(?: 1 1)?|business source", "busl business"),
    ("postgresql", "postgresql", "postgresql"),
    ("python-2", "psf(?: 2 0)?|python software foundation", "psf python"),
    ("php-3", "php(?: license)?(?: version)? 3(?: 0[01]?)?", "php"),
    ("ruby", "ruby", "ruby"),
    ("openssl", "openssl|dual openssl ssleay", "openssl"),
    ("elastic-2", "elastic(?: license)? 2 0|elv2", "elastic elv2"),
    ("sspl-1", "sspl(?: v?1(?: 0)?)?|server side public", "sspl server"),
    ("ms-pl", "ms pl|microsoft public", "ms microsoft"),
    ("ms-rl", "ms rl|microsoft reciprocal", "ms microsoft"),
    ("apsl-2", "apsl(?: 2 0)?|apple public source", "apsl apple"),
    ("ncsa", "ncsa|university of illinois open source", "ncsa illinois"),
    ("icu", "icu|unicode", "icu unicode"),
    ("curl", "curl", "curl"),
    ("vim", "vim", "vim"),
    ("qpl", "qpl(?: 1 0)?|q public", "qpl q"),
    ("w3c", "w3c(?: software)?", "w3c"),
    ("zpl", "zpl(?: 2 [01])?|zope public", "zpl zope"),
    ("ecl-2", "ecl 2 0|educational community", "ecl educational"),
    ("upl-1", "upl(?: 1 0)?|universal permissive", "upl permissive"),
    ("blueoak-1", "blueoak(?: 1 0 0)?|blue oak model", "blueoak oak"),
    ("mulan-2", "mulanpsl 2 0|mulan permissive software", "mulanpsl mulan"),
    ("hpnd", "hpnd|historical permission notice and disclaimer", "hpnd historical"),
    ("json", "json", "json"),
    ("beerware", "beerware|beer ware", "beerware beer"),
    ("polyform-nc", "polyform noncommercial(?: 1 0 0)?", "polyform"),
    ("openrail", "(?:bigscience |creativeml )?open ?rail(?: m)?", "openrail rail"),
)

#: Ways to name a licence: priority, weight, pattern around the name.
NOTICES: tuple[tuple[int, float, str], ...] = (
    (1, 0.99, "spdx license identifier (?:{name})"),
    (2, 0.95, "(?:licensed|licenced|released|distributed|published|provided|available|covered|redistributed) under (?:the )?"
              "(?:terms (?:and conditions )?of )?(?:the )?(?:{name})(?: (?:open source |software |public |free )?licen[cs]e)?"
              "(?: (?:version|v) [0-9]+(?: [0-9]+)?)?"),
    (3, 0.85, "(?:the )?(?:{name}) (?:open source |software |public |free )?licen[cs]e(?: (?:version|v) [0-9]+(?: [0-9]+)?)?"),
    (4, 0.75, "licen[cs]e(?: is| type| name| under)?(?: the)? (?:{name})"),
)

#: Wording of licence texts and of rights: label, priority, weight, pattern, keywords.
TEXTS: tuple[tuple[str, int, float, str, str], ...] = (
    ("mit", 2, 0.95, "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby"),
    ("isc", 2, 0.95, "permission to use copy modify and or distribute this software for any purpose", "permission"),
    ("bsd", 2, 0.9, "redistribution and use in source and binary forms with or without modification", "redistribution"),
    ("gpl", 2, 0.9, "this program is free software you can redistribute it and or modify it", "redistribute"),
    ("gpl", 3, 0.8, "you should have received a copy of the gnu general public license", "gnu"),
    ("lgpl", 3, 0.8, "you should have received a copy of the gnu lesser general public license", "lesser"),
    ("agpl", 3, 0.8, "you should have received a copy of the gnu affero general public license", "affero"),
    ("mpl-2", 2, 0.95, "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla"),
    ("apache-2", 2, 0.95, "you may not use this file except in compliance with the license", "compliance"),
    ("boost", 2, 0.95, "distributed under the boost software license version 1 0", "boost"),
    ("unlicense", 2, 0.95, "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("zlib", 2, 0.9, "this software is provided as is without any express or implied warranty", "implied"),
    ("public-domain", 3, 0.85, "(?:released|dedicated|placed) (?:in|into|to) the public domain", "domain"),
    ("public-domain", 4, 0.7, "in the public domain", "domain"),
    ("mit", 3, 0.85, "the above copyright notice and this permission notice shall be included in all copies", "permission"),
    ("mit-0", 3, 0.85, "to deal in the software without restriction including without limitation the rights to use copy modify", "rights"),
    ("mit-advertising", 3, 0.85, "to promote the sale use or other dealings in this software without prior written permission", "permission"),
    ("icu", 3, 0.85, "the above copyright notices? and this permission notice appear in all copies of the software", "permission"),
    ("hpnd", 3, 0.85, "permission to use copy modify (?:and )?distribute and sell this software and its documentation", "permission"),
    ("x11", 3, 0.85, "the name of the x consortium shall not be used without prior written permission", "consortium"),
    ("postgresql", 3, 0.85, "permission to use copy modify and distribute this software and its documentation for any purpose without fee", "permission"),
    ("bsd-2", 3, 0.8, "redistributions of source code must retain the above copyright notice", "redistributions"),
    ("bsd-2", 3, 0.8, "redistributions in binary form must reproduce the above copyright notice", "redistributions"),
    ("bsd-3", 3, 0.85, "endorse or promote products derived from this software without specific prior written permission", "endorse"),
    ("bsd-4", 3, 0.85, "redistributions must acknowledge the use of this software in all advertising materials", "redistributions"),
    ("bsd-3-clear", 2, 0.9, "no express or implied licenses to any party s patent rights are granted by this license", "patent"),
    ("bsd-1", 3, 0.7, "redistribution and use in source form with or without modification", "redistribution"),
    ("ncsa", 3, 0.85, "permission is hereby granted to deal with the software without restriction", "deal"),
    ("afl-3", 2, 0.9, "licensed under the academic free license version 3 0", "academic"),
    ("apache-1", 3, 0.85, "redistributions of any form whatsoever must retain the following acknowledg(?:e)?ment", "acknowledgment acknowledgement"),
    ("apache-1.1", 3, 0.85, "nor may apache appear in their name without prior written permission of the apache software foundation", "apache"),
    ("apache-2", 3, 0.85, "unless required by applicable law or agreed to in writing software distributed under the license", "applicable"),
    ("apache-2", 3, 0.85, "see the license for the specific language governing permissions and limitations", "governing"),
    ("apache-2", 3, 0.85, "licensed to the apache software foundation asf under one or more contributor license agreements", "apache"),
    ("apache-2", 3, 0.8, "grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) license", "perpetual"),
    ("gpl-2", 2, 0.9, "gnu general public license as published by the free software foundation (?:either )?version 2", "gnu"),
    ("gpl-3", 2, 0.9, "gnu general public license as published by the free software foundation (?:either )?version 3", "gnu"),
    ("lgpl-2.1", 2, 0.9, "gnu lesser general public license as published by the free software foundation (?:either )?version 2 1", "lesser"),
    ("lgpl-3", 2, 0.9, "gnu lesser general public license as published by the free software foundation (?:either )?version 3", "lesser"),
    ("lgpl-2", 2, 0.9, "gnu library general public license as published by the free software foundation (?:either )?version 2", "library"),
    ("agpl-3", 2, 0.9, "gnu affero general public license as published by the free software foundation (?:either )?version 3", "affero"),
    ("gpl", 3, 0.8, "the gnu general public license is a free copyleft license", "copyleft"),
    ("gpl", 3, 0.8, "the licenses for most software are designed to take away your freedom to share and change it", "freedom"),
    ("agpl", 3, 0.8, "the gnu affero general public license is designed specifically to ensure cooperation with the community", "cooperation"),
    ("gpl-classpath", 2, 0.9, "linking this library gives you permission to link this library with independent modules", "linking"),
    ("gpl-classpath", 3, 0.85, "as a special exception the copyright holders of this library give you permission to link", "exception"),
    ("gpl-gcc-exception", 2, 0.9, "gcc runtime library exception to the license", "gcc"),
    ("gpl-autoconf-exception", 3, 0.8, "a configure script generated by autoconf you may redistribute it", "autoconf"),
    ("gpl-font-exception", 3, 0.8, "this font does not by itself cause the resulting document to be covered by the gnu general public license", "font"),
    ("openssl-exception", 2, 0.85, "permission to link the code of (?:portions of )?this program with the openssl library", "openssl"),
    ("gfdl", 3, 0.85, "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation", "documentation"),
    ("verbatim", 3, 0.7, "everyone is permitted to copy and distribute verbatim copies of this license document", "verbatim"),
    ("mpl-1.1", 2, 0.9, "the contents of this file are subject to the mozilla public license version 1 1", "mozilla"),
    ("mpl-1.0", 2, 0.9, "the contents of this file are subject to the mozilla public license version 1 0", "mozilla"),
    ("mpl-2", 3, 0.85, "the mpl was not distributed with this file so see the license", "mpl"),
    ("npl-1.1", 2, 0.9, "subject to the netscape public license(?: version 1 [01])?", "netscape"),
    ("cddl-1.0", 2, 0.9, "the contents of this file are subject to the terms of the common development and distribution license", "development"),
    ("cddl-1.0", 3, 0.85, "you can obtain a copy of the license at usr src opensolaris license", "opensolaris"),
    ("cpal-1.0", 2, 0.9, "(?:subject to|under) the common public attribution license(?: version 1 0)?", "attribution"),
    ("epl-1", 2, 0.9, "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", "eclipse"),
    ("epl-2", 2, 0.9, "this program and the accompanying materials are made available under the terms of the eclipse public license (?:v 2 0|2 0)", "eclipse"),
    ("edl-1", 2, 0.9, "made available under the terms of the eclipse distribution license v ?1 0", "eclipse"),
    ("ipl-1.0", 2, 0.9, "ibm public license(?: version 1 0)?", "ibm"),
    ("eupl-1.2", 2, 0.9, "licensed under the eupl(?: version)? 1 2", "eupl"),
    ("eupl", 3, 0.85, "you may not use this work except in compliance with the licence", "work"),
    ("cecill-2", 2, 0.9, "governed by the cecill license under french law", "cecill"),
    ("cecill", 3, 0.8, "cecill(?: [abc])? free software license agreement", "cecill"),
    ("osl-3", 2, 0.9, "licensed under the open software license version 3 0", "open"),
    ("rpl-1.5", 2, 0.9, "reciprocal public license(?: version)?(?: 1 [15])?", "reciprocal"),
    ("ms-pl", 3, 0.85, "this license governs use of the accompanying software if you use the software you accept this license", "accompanying"),
    ("apsl-2", 2, 0.9, "subject to the apple public source license version 2 0", "apple"),
    ("sissl", 2, 0.9, "sun industry standards source license(?: version 1 [12])?", "industry"),
    ("spl-1.0", 2, 0.9, "sun public license(?: version 1 0)?", "sun"),
    ("php-3", 3, 0.85, "this source file is subject to version 3 0[01]? of the php license", "php"),
    ("python-2", 3, 0.85, "this license agreement is between the python software foundation psf and the individual or organization", "psf"),
    ("python-cnri", 2, 0.9, "cnri (?:open source )?license agreement", "cnri"),
    ("perl", 2, 0.9, "you can redistribute it and or modify it under the same terms as perl itself", "perl"),
    ("artistic-1", 3, 0.85, "under the terms of either the gnu general public license or the artistic license", "artistic"),
    ("ruby", 3, 0.85, "you may modify your copy of the software under the ruby license", "ruby"),
    ("tcl", 3, 0.85, "the authors hereby grant permission to use copy modify distribute and license this software and its documentation", "authors"),
    ("zlib", 3, 0.85, "permission is granted to anyone to use this software for any purpose including commercial applications", "commercial"),
    ("libpng", 3, 0.85, "the libpng license and its disclaimer", "libpng"),
    ("bzip2", 2, 0.85, "bzip2 license|the bzip2 and libbzip2 license", "bzip2"),
    ("info-zip", 2, 0.9, "info zip license", "info"),
    ("curl", 3, 0.8, "curl and libcurl are licensed under a license", "curl"),
    ("openssl", 3, 0.85, "redistributions of any form whatsoever must retain the openssl project acknowledgment", "openssl"),
    ("ssleay", 2, 0.9, "ssleay license", "ssleay"),
    ("ijg", 2, 0.85, "independent jpeg group s? ?(?:software )?license", "jpeg"),
    ("freetype", 2, 0.9, "freetype project license", "freetype"),
    ("ofl-1.1", 3, 0.85, "this font software is licensed under the sil open font license", "sil"),
    ("bitstream-vera", 3, 0.85, "obtaining a copy of the fonts accompanying this license", "fonts"),
    ("ubuntu-font", 2, 0.9, "ubuntu font licen[cs]e", "ubuntu"),
    ("unicode", 3, 0.85, "permission is hereby granted to any person obtaining a copy of the unicode data files", "unicode"),
    ("w3c", 3, 0.85, "by obtaining and or copying this work you the licensee agree", "obtaining"),
    ("ogc", 2, 0.8, "open geospatial consortium license", "geospatial"),
    ("ogl-uk-3", 2, 0.9, "open government licen[cs]e(?: v ?3 0)?", "government"),
    ("etalab-2", 2, 0.9, "(?:licence ouverte|open licence)(?: version)?(?: 2 0)?(?: etalab)?", "ouverte open"),
    ("dl-de-by-2", 2, 0.9, "data licen[cs]e germany attribution(?: version)?(?: 2 0)?", "germany"),
    ("cc0", 3, 0.85, "dedicated the work to the public domain by waiving all", "waiving"),
    ("cc-by", 3, 0.85, "this work is licensed under a creative commons attribution (?:[1-4] [05] )?(?:international |generic |unported )?license", "commons"),
    ("cc-by-sa", 3, 0.85, "this work is licensed under a creative commons attribution sharealike (?:[1-4] [05] )?(?:international |generic |unported )?license", "commons"),
    ("cc-by-nc", 3, 0.85, "this work is licensed under a creative commons attribution noncommercial (?:[1-4] [05] )?(?:international |generic |unported )?license", "commons"),
    ("cc-sampling", 2, 0.8, "creative commons sampling (?:plus )?(?:1 0 )?license", "sampling"),
    ("odbl", 3, 0.85, "this database is made available under the open database license", "database"),
    ("dbcl", 2, 0.9, "database contents license", "contents"),
    ("cdla-permissive", 2, 0.9, "community data license agreement permissive", "community"),
    ("cdla-sharing", 2, 0.9, "community data license agreement sharing", "community"),
    ("llama", 2, 0.9, "llama (?:[234](?: [12])? )?community license(?: agreement)?", "llama"),
    ("openrail", 3, 0.8, "responsible ai licen[cs]e", "responsible"),
    ("gemma", 2, 0.85, "gemma license", "gemma"),
    ("busl-1.1", 3, 0.85, "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use", "licensor"),
    ("sspl-1", 3, 0.85, "server side public license version 1", "server"),
    ("elastic-2", 3, 0.85, "the elastic license forbids a hosted or managed service", "hosted"),
    ("commons-clause", 2, 0.9, "commons clause license condition(?: v1 0)?", "clause"),
    ("polyform-nc", 3, 0.85, "polyform noncommercial license", "polyform"),
    ("polyform-sb", 2, 0.9, "polyform small business license", "polyform"),
    ("confluent", 2, 0.9, "confluent community license(?: agreement)?", "confluent"),
    ("redis", 2, 0.9, "redis source available license", "redis"),
    ("timescale", 2, 0.9, "timescale license(?: agreement)?", "timescale"),
    ("json", 3, 0.85, "permission is granted and the software shall be used for good not evil", "evil"),
    ("wtfpl", 3, 0.85, "do what the fuck you want to public licen[cs]e", "fuck"),
    ("beerware", 3, 0.85, "the beer ?ware license", "beer beerware"),
    ("fair", 2, 0.8, "usage of the works is permitted provided that this license is retained", "usage"),
    ("all-rights-reserved", 4, 0.65, "may be reproduced without the prior (?:written )?permission of the (?:publisher|author|copyright holder)", "reproduced"),
    ("proprietary", 3, 0.7, "end user licen[cs]e agreement", "end"),
    ("proprietary", 3, 0.7, "proprietary rights notice|proprietary licen[cs]e", "proprietary"),
    ("trial", 4, 0.6, "(?:evaluation|trial) licen[cs]e", "evaluation trial"),
    ("all-rights-reserved", 5, 0.6, "all rights reserved", "reserved"),
)

#: A text without any of these has no detection.
STEMS = ("licen", "spdx", "rights", "hereby", "permission", "redistribut", "domain", "compliance", "unencumbered",
         "implied")

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Stems of two words, apart by any separators as in the text.
_CC_BY = rf"cc{_SEPARATORS}by"
_UNDER = rf"(?:released|distributed|published|provided|available|covered){_SEPARATORS}under"


def rules() -> list[dict]:
    """All rules in order: every name in every notice, then the texts."""
    out = [
        {"label": label, "priority": priority, "weight": weight, "keywords": keywords.split(),
         "pattern": pattern.format(name=name)}
        for label, name, keywords in NAMES for priority, weight, pattern in NOTICES
    ]
    out += [{"label": label, "priority": priority, "weight": weight, "keywords": keywords.split(), "pattern": pattern}
            for label, priority, weight, pattern, keywords in TEXTS]
    return [rule | {"id": i} for i, rule in enumerate(out)]


_RULE_TYPE = "array<struct<label:string,priority:int,weight:double,keywords:array<string>,pattern:string,id:int>>"


#: Signs that stand in no word: the begin and the end of a match.
_BEGIN, _END = "\x01", "\x02"


def _places(line: Column, pattern: Column) -> Column:
    """Word intervals [start, end) of a pattern's matches in a line of words.

    Matches start at a blank, as words do. Their first and last words are marked
    in the line, whose words are then counted off: linear in the line, however many
    matches it has. (?s) lets a match cross U+0085, U+2028 and U+2029, which stand
    inside words.
    """
    whole = F.concat(F.lit("(?s) ((?:"), pattern, F.lit("))(?= )"))
    words = F.split(F.regexp_replace(line, whole, F.lit(f" {_BEGIN}$1{_END}")), " ")  # the first is empty
    begins = F.array_compact(F.transform(words, lambda w, i: F.when(w.startswith(_BEGIN), i - 1)))
    ends = F.array_compact(F.transform(words, lambda w, i: F.when(w.endswith(_END), i)))
    found = F.transform(F.arrays_zip(begins.alias("start"), ends.alias("end")), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end")))
    return F.when(F.regexp_like(line, whole), found).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


#: Detections that one inner aggregate goes through: each of its steps copies what it has gathered.
_BATCH = 256
_DETECTION = "struct<start:int,before:int,priority:int,id:int,label:string,weight:double>"


def _suppressed(detections: Column, state: Column) -> Column:
    """``state`` (kept, last, reach) after some more detections in order."""

    def add(s: Column, d: Column) -> Column:
        end, last_end = -d["before"], -s["last"]["before"]
        contained = end <= s["reach"]
        apart = s["last"].isNull() | (d["start"] >= last_end)
        better = apart | (d["priority"] < s["last"]["priority"])
        kept = F.when(apart & s["last"].isNotNull(), F.concat(s["kept"], F.array(s["last"]))).otherwise(s["kept"])
        return F.when(contained | ~better, s).otherwise(F.struct(
            kept.alias("kept"), d.alias("last"), F.greatest(s["reach"], end).alias("reach")))

    return F.aggregate(detections, state, add)


def _kept(detections: Column) -> Column:
    """Suppression: detections come by start, longest first, then by priority and
    order, so whatever contains one has come before it.

    Those that overlap, also by others between them, are gone through together.
    Where such a cluster begins, as many detections have ended as have begun before,
    which the sorted ends tell without a running maximum. So the work is linear in
    detections that stand apart; a chain of overlapping ones is cut into batches."""
    order = F.array_sort(detections)
    ends = F.array_sort(F.transform(order, lambda d: -d["before"]))
    state = f"struct<kept:array<{_DETECTION}>,last:{_DETECTION},reach:int>"
    first = F.from_json(F.lit('{"kept": [], "reach": 0}'), state)

    def of_cluster(cluster: Column) -> Column:
        n = F.ceil(F.size(cluster) / _BATCH).cast("int")

        def add(s: Column, k: Column) -> Column:
            zero = F.struct(F.filter(s["kept"], lambda x: F.lit(False)).alias("kept"), s["last"].alias("last"),
                            s["reach"].alias("reach"))
            more = _suppressed(F.slice(cluster, k * _BATCH + 1, F.lit(_BATCH)), zero)
            return F.transform(F.array(more), lambda m: F.struct(
                F.concat(s["kept"], m["kept"]).alias("kept"), m["last"].alias("last"), m["reach"].alias("reach")))[0]

        return F.aggregate(F.sequence(F.lit(0), n - 1), first, add, lambda s: F.concat(s["kept"], F.array(s["last"])))

    both = F.transform(F.array(F.struct(order.alias("order"), ends.alias("ends"))), lambda b: F.transform(
        F.array(F.struct(b["order"].alias("order"), F.filter(
            F.sequence(F.lit(0), F.size(b["order"]) - 1),
            lambda i: (i == 0) | (F.get(b["ends"], i - 1) <= F.get(b["order"], i)["start"])).alias("begins"))),
        lambda c: F.flatten(F.transform(c["begins"], lambda at, k: of_cluster(F.slice(
            c["order"], at + 1, F.coalesce(F.get(c["begins"], k + 1), F.size(c["order"])) - at)))))[0])[0]
    return both


def scan(docs: DataFrame) -> DataFrame:
    """Add license_words (count), license_base (label, start, end of base
    phrases) and license_detections (start, before = -end, priority, id, label,
    weight; suppressed ones left out) to each document."""
    low = F.lower("text")
    gate = low.contains(STEMS[0])
    for stem in STEMS[1:]:
        gate = gate | low.contains(stem)
    gate = gate | (low.contains("cc") & low.rlike(_CC_BY)) | (low.contains("under") & low.rlike(_UNDER))
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    line = F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, _SEPARATORS, " ")), F.lit(" "))
    docs = docs.withColumn("license_words", F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long"))
    docs = docs.withColumn("license_line", F.when(gate, line))

    base = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(phrase).alias("phrase")) for phrase, label in BASE])
    of_phrase = lambda p: F.transform(_places(F.col("license_line"), p["phrase"]), lambda m: F.struct(
        p["label"].alias("label"), m["start"].alias("start"), m["end"].alias("end")))
    none = F.array().cast("array<struct<label:string,start:int,end:int>>")
    docs = docs.withColumn("license_base", F.when(
        F.col("license_line").isNotNull(), F.flatten(F.transform(base, of_phrase))).otherwise(none))

    table = rules()
    every = F.from_json(F.lit(json.dumps(table)), _RULE_TYPE)
    keywords = sorted({k for rule in table for k in rule["keywords"]})
    present = F.array_intersect(F.split("license_line", " "), F.array(*map(F.lit, keywords)))
    docs = docs.withColumn("license_keywords", present)
    ready = F.filter(every, lambda r: F.arrays_overlap(r["keywords"], F.col("license_keywords")))
    of_rule = lambda r: F.transform(_places(F.col("license_line"), r["pattern"]), lambda m: F.struct(
        m["start"].alias("start"), (-m["end"]).alias("before"), r["priority"].alias("priority"), r["id"].alias("id"),
        r["label"].alias("label"), r["weight"].alias("weight")))
    nothing = F.array().cast(f"array<{_DETECTION}>")
    docs = docs.withColumn("license_found", F.when(
        F.size("license_keywords") > 0, F.flatten(F.transform(ready, of_rule))).otherwise(nothing))
    docs = docs.withColumn("license_detections", F.when(
        F.size("license_found") > 0, _kept(F.col("license_found"))).otherwise(nothing))
    return docs.drop("license_line", "license_keywords", "license_found")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts and word positions of base phrases, labels
    without and with the rules', and the best weight as score."""
    found = scan(docs.select("doc_id", "text"))
    base_labels = F.array_sort(F.array_distinct(F.transform("license_base", lambda b: b["label"])))
    starts = F.transform("license_base", lambda b: b["start"].cast("long"))
    labels = F.array_sort(F.array_union(base_labels, F.transform("license_detections", lambda d: d["label"])))
    weights = F.array_max(F.transform("license_detections", lambda d: d["weight"]))
    return found.select(
        "doc_id", F.col("license_words").alias("n_words"), F.size("license_base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce(weights, F.lit(0.0)),
                   F.when(F.size("license_base") > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0))).alias("score"))
