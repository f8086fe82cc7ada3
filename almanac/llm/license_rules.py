r"""Signature rules of license scans: label, keyword and regular expression, by hand, in classes of one priority each.

Expressions are matched without regard to case. A space stands for one to four blanks or line ends, `` ?`` for none to four.
The keyword is a word, in lower case, that every match holds. Rules of names and texts come with the version they name;
within a class the longer of two detections that contain each other stays.
"""

from __future__ import annotations

SPDX, LINK, TEXT, NAME, MARK = 90, 80, 70, 60, 40

_V = r",? (?:version |v\.? ?)?"
_O = r"(?:\.0)?"
_L = r"licen[cs]e"

NAMES = (
    ("mit", "mit", rf"mit {_L}"),
    ("mit", "expat", rf"expat {_L}"),
    ("mit-0", "attribution", rf"mit no attribution(?: {_L})?"),
    ("mit", "mit", r"mit[ -]licen[cs]ed"),
    ("x11", "x11", rf"x11 {_L}"),
    ("isc", "isc", rf"isc {_L}"),
    ("isc", "internet", rf"internet systems consortium {_L}"),
    ("zlib", "zlib", rf"zlib(?:/libpng)? {_L}"),
    ("libpng", "libpng", rf"libpng {_L}"),
    ("apache-1.0", "apache", rf"apache (?:software )?{_L}{_V}1\.0"),
    ("apache-1.1", "apache", rf"apache (?:software )?{_L}{_V}1\.1"),
    ("apache-2.0", "apache", rf"apache (?:software )?{_L}{_V}2{_O}"),
    ("apache-2.0", "apache", r"apache[ -]2(?:\.0)? licen[cs]ed?"),
    ("apache-2.0", "asl", r"\basl ?2\.0"),
    ("apache", "apache", rf"apache (?:software )?{_L}"),
    ("apache-2.0-with-llvm", "llvm", rf"apache {_L}{_V}2(?:\.0)? with llvm exceptions?"),
    ("bsd-1-clause", "bsd", rf"bsd[ -]1-clause(?: {_L})?"),
    ("bsd-2-clause", "bsd", rf"(?:2|two)-clause bsd(?: {_L})?"),
    ("bsd-2-clause", "bsd", rf"bsd[ -](?:2|two)-clause(?: {_L})?"),
    ("bsd-2-clause", "bsd", rf"simplified bsd {_L}"),
    ("bsd-2-clause", "freebsd", rf"freebsd {_L}"),
    ("bsd-3-clause", "bsd", rf"(?:3|three)-clause bsd(?: {_L})?"),
    ("bsd-3-clause", "bsd", rf"bsd[ -](?:3|three)-clause(?: {_L})?"),
    ("bsd-3-clause", "bsd", rf"(?:new|revised|modified) bsd {_L}"),
    ("bsd-3-clause-clear", "bsd", rf"clear bsd {_L}"),
    ("bsd-4-clause", "bsd", rf"(?:4|four)-clause bsd(?: {_L})?"),
    ("bsd-4-clause", "bsd", rf"(?:original|old) bsd {_L}"),
    ("0bsd", "bsd", rf"zero-clause bsd(?: {_L})?"),
    ("0bsd", "0bsd", r"\b0bsd\b"),
    ("bsd", "bsd", rf"\bbsd(?:-style)? {_L}"),
    ("gpl-1.0", "public", rf"(?:gnu )?general public {_L}{_V}1{_O}"),
    ("gpl-2.0", "public", rf"(?:gnu )?general public {_L}{_V}2{_O}"),
    ("gpl-3.0", "public", rf"(?:gnu )?general public {_L}{_V}3{_O}"),
    ("gpl", "public", rf"(?:gnu )?general public {_L}"),
    ("gpl", "gpl", r"\bgnu gpl\b"),
    ("gpl-2.0", "gpl", rf"\b(?:gnu )?gpl(?: version|,? ?v\.?|-)? ?2{_O}"),
    ("gpl-3.0", "gpl", rf"\b(?:gnu )?gpl(?: version|,? ?v\.?|-)? ?3{_O}"),
    ("gpl-2.0-classpath", "classpath", r"gpl(?: ?v?2)? with (?:the )?classpath exception"),
    ("lgpl-2.0", "library", rf"(?:gnu )?library general public {_L}(?:{_V}2{_O})?"),
    ("lgpl-2.1", "lesser", rf"(?:gnu )?lesser general public {_L}{_V}2\.1"),
    ("lgpl-3.0", "lesser", rf"(?:gnu )?lesser general public {_L}{_V}3{_O}"),
    ("lgpl", "lesser", rf"(?:gnu )?lesser general public {_L}"),
    ("lgpl-2.1", "lgpl", r"\blgpl(?: version|,? ?v\.?|-)? ?2\.1"),
    ("lgpl-3.0", "lgpl", rf"\blgpl(?: version|,? ?v\.?|-)? ?3{_O}"),
    ("agpl-3.0", "affero", rf"(?:gnu )?affero general public {_L}{_V}3{_O}"),
    ("agpl", "affero", rf"(?:gnu )?affero general public {_L}"),
    ("agpl-3.0", "agpl", rf"\bagpl(?: version|,? ?v\.?|-)? ?3{_O}"),
    ("gfdl-1.2", "documentation", rf"(?:gnu )?free documentation {_L}{_V}1\.2"),
    ("gfdl-1.3", "documentation", rf"(?:gnu )?free documentation {_L}{_V}1\.3"),
    ("gfdl", "documentation", rf"(?:gnu )?free documentation {_L}"),
    ("fsfap", "permissive", rf"(?:gnu )?all-permissive {_L}"),
    ("mpl-1.0", "mozilla", rf"mozilla public {_L}{_V}1\.0"),
    ("mpl-1.1", "mozilla", rf"mozilla public {_L}{_V}1\.1"),
    ("mpl-2.0", "mozilla", rf"mozilla public {_L}{_V}2{_O}"),
    ("mpl", "mozilla", rf"mozilla public {_L}"),
    ("mpl-2.0", "mpl", rf"\bmpl(?: version|,? ?v\.?|-)? ?2{_O}"),
    ("epl-1.0", "eclipse", rf"eclipse public {_L}(?: -)?{_V}1{_O}"),
    ("epl-2.0", "eclipse", rf"eclipse public {_L}(?: -)?{_V}2{_O}"),
    ("epl", "eclipse", rf"eclipse public {_L}"),
    ("bsd-3-clause-edl", "eclipse", rf"eclipse distribution {_L}(?:{_V}1\.0)?"),
    ("cddl-1.0", "development", rf"common development and distribution {_L}(?:{_V}1\.0)?"),
    ("cddl-1.1", "development", rf"common development and distribution {_L}{_V}1\.1"),
    ("cpl-1.0", "common", rf"common public {_L}(?:{_V}1\.0)?"),
    ("cpal-1.0", "common", rf"common public attribution {_L}(?:{_V}1\.0)?"),
    ("ipl-1.0", "ibm", rf"ibm public {_L}(?:{_V}1\.0)?"),
    ("eupl-1.1", "european", rf"european union public {_L}{_V}1\.1"),
    ("eupl-1.2", "european", rf"european union public {_L}{_V}1\.2"),
    ("eupl", "european", rf"european union public {_L}"),
    ("artistic-1.0", "artistic", rf"artistic {_L}{_V}1{_O}"),
    ("artistic-2.0", "artistic", rf"artistic {_L}{_V}2{_O}"),
    ("artistic", "artistic", rf"artistic {_L}"),
    ("perl", "perl", r"same terms as perl(?: itself)?"),
    ("bsl-1.0", "boost", rf"boost software {_L}(?:{_V}1\.0)?"),
    ("busl-1.1", "business", rf"business source {_L}(?:{_V}1\.1)?"),
    ("sspl-1.0", "server", rf"server side public {_L}(?:{_V}1)?"),
    ("elastic-2.0", "elastic", rf"elastic {_L}(?:{_V}2(?:\.0)?)?"),
    ("fair-source", "fair", rf"fair source {_L}"),
    ("functional-source", "functional", rf"functional source {_L}"),
    ("polyform", "polyform", rf"polyform [a-z]{{3,16}}(?: [a-z]{{3,16}})? {_L}"),
    ("unlicense", "unlicense", r"\b(?:the )?unlicense\b"),
    ("wtfpl", "wtfpl", r"\bwtfpl\b"),
    ("beerware", "beer", rf"beer-?ware {_L}"),
    ("ofl-1.1", "font", rf"(?:sil )?open font {_L}(?:{_V}1\.1)?"),
    ("psf-2.0", "python", rf"python software foundation {_L}(?:{_V}2)?"),
    ("cnri-python", "cnri", rf"cnri(?: open source)? {_L}"),
    ("postgresql", "postgresql", rf"postgresql {_L}"),
    ("openssl", "openssl", rf"openssl {_L}"),
    ("ms-pl", "microsoft", rf"microsoft public {_L}"),
    ("ms-rl", "microsoft", rf"microsoft reciprocal {_L}"),
    ("odbl-1.0", "database", rf"open (?:data commons open )?database {_L}(?:{_V}1\.0)?"),
    ("odc-by-1.0", "commons", rf"open data commons attribution {_L}(?:{_V}1\.0)?"),
    ("pddl-1.0", "dedication", rf"public domain dedication and {_L}"),
    ("cdla-permissive", "community", rf"community data {_L} agreement ?[-–] ?permissive"),
    ("cdla-sharing", "community", rf"community data {_L} agreement ?[-–] ?sharing"),
    ("ogl-uk", "government", rf"open government {_L}(?:{_V}[123]\.0)?"),
    ("afl-3.0", "academic", rf"academic free {_L}(?:{_V}3\.0)?"),
    ("ecl-2.0", "educational", rf"educational community {_L}(?:{_V}2\.0)?"),
    ("ncsa", "ncsa", rf"ncsa (?:open source )?{_L}"),
    ("vim", "vim", rf"\bvim {_L}"),
    ("ruby", "ruby", rf"\bruby {_L}"),
    ("php-3.01", "php", rf"\bphp {_L}(?:{_V}3\.01)?"),
    ("osl-3.0", "open", rf"open software {_L}(?:{_V}3\.0)?"),
    ("apsl-2.0", "apple", rf"apple public source {_L}(?:{_V}2\.0)?"),
    ("qpl-1.0", "public", rf"\bq public {_L}(?:{_V}1\.0)?"),
    ("lppl-1.3c", "latex", rf"latex project public {_L}(?:{_V}1\.3c?)?"),
    ("w3c", "w3c", rf"w3c software (?:notice and )?(?:and document )?{_L}"),
    ("hpnd", "historical", r"historical permission notice and disclaimer"),
    ("upl-1.0", "universal", rf"universal permissive {_L}(?:{_V}1\.0)?"),
    ("mulan-psl-2.0", "mulan", rf"mulan permissive software {_L}(?:{_V}2)?"),
    ("cecill", "cecill", r"\bcecill(?:-[bc])?(?: free software)?(?: licen[cs]e)?"),
    ("blueoak-1.0.0", "oak", rf"blue oak model {_L}(?: 1\.0\.0)?"),
    ("openrail", "rail", rf"(?:open|bigscience|creativeml open)?rail(?:-[ms]|\+\+-m)? {_L}"),
    ("nasa-1.3", "nasa", rf"nasa open source agreement(?:{_V}1\.3)?"),
)

TEXTS = (
    ("mit", "hereby", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "merge", r"to use, copy, modify, merge, publish, distribute, sublicen[cs]e, and/or sell copies of the software"),
    ("mit", "noninfringement", r"merchantability, fitness for a particular purpose and noninfringement"),
    ("x11", "advertising", r"except as contained in this notice, the names? of [^.;]{1,80} shall not be used in advertising"),
    ("isc", "fee", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "provided", r"provided that the above copyright notice and this permission notice appear in all copies"),
    ("0bsd", "disclaims", r"the author disclaims all warranties with regard to this software"),
    ("hpnd", "permission", r"permission to use, copy, modify,? and distribute this software and its documentation for any purpose"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
    ("zlib", "plainly", r"altered source versions must be plainly marked as such"),
    ("zlib", "arising", r"in no event will the authors be held liable for any damages arising from the use of this software"),
    ("apache-2.0", "apache", r"licen[cs]ed under the apache licen[cs]e, version 2\.0 \(the [\"“]licen[cs]e[\"”]\)"),
    ("apache-2.0", "compliance", r"you may not use this file except in compliance with the licen[cs]e"),
    ("apache-2.0", "governing", r"see the licen[cs]e for the specific language governing permissions and limitations under the licen[cs]e"),
    ("apache-2.0", "contributor", r"licen[cs]ed to the apache software foundation \(asf\) under one or more contributor licen[cs]e agreements"),
    ("apache-2.0", "irrevocable", r"perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable (?:copyright|\(except as stated in this section\) patent) licen[cs]e"),
    ("apache-1.1", "apache", r"this product includes software developed by the apache software foundation"),
    ("bsd", "redistribut", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "redistribut", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistribut", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse", r"neither the names? of [^.;]{1,120} may be used to endorse or promote products derived from this software"),
    ("bsd-3-clause", "endorse", r"the name of the author may not be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display"),
    ("bsd-3-clause-clear", "patent", r"no express or implied licen[cs]es to any party's patent rights are granted by this licen[cs]e"),
    ("bsd-2-clause-views", "official", r"should not be interpreted as representing official policies"),
    ("gpl", "redistribut", r"this program is free software[;:,] you can redistribute it and/or modify it under the terms of the gnu general public licen[cs]e"),
    ("gpl", "warranty", r"this program is distributed in the hope that it will be useful, but without any warranty"),
    ("gpl", "verbatim", r"everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document"),
    ("gpl-2.0-or-later", "option", r"either version 2 of the licen[cs]e, or \(at your option\) any later version"),
    ("gpl-3.0-or-later", "option", r"either version 3 of the licen[cs]e, or \(at your option\) any later version"),
    ("gpl-2.0", "freedom", r"the licen[cs]es for most software are designed to take away your freedom to share and change it"),
    ("gpl-3.0", "copyleft", r"the gnu general public licen[cs]e is a free, copyleft licen[cs]e for software and other kinds of works"),
    ("lgpl", "library", r"this library is free software[;:,] you can redistribute it and/or modify it"),
    ("lgpl-2.1-or-later", "option", r"either version 2\.1 of the licen[cs]e, or \(at your option\) any later version"),
    ("lgpl-2.1", "library", r"this library is distributed in the hope that it will be useful"),
    ("agpl-3.0", "network", r"interacting with it remotely through a computer network"),
    ("agpl-3.0", "affero", r"under the terms of the gnu affero general public licen[cs]e as published by the free software foundation"),
    ("gfdl", "invariant", r"with no invariant sections, (?:with )?no front-cover texts,? and (?:with )?no back-cover texts"),
    ("fsfap", "medium", r"copying and distribution of this file, with or without modification, are permitted in any medium without royalty"),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public licen[cs]e, v\. 2\.0"),
    ("mpl-2.0", "mpl", r"if a copy of the mpl was not distributed with this file, you can obtain one at"),
    ("mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public licen[cs]e version 1\.1"),
    ("epl-2.0", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e 2\.0"),
    ("epl-1.0", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v1\.0"),
    ("cddl-1.0", "development", r"the contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
    ("artistic-2.0", "artistic", r"you may (?:use|redistribute) (?:it|this) under the terms of the artistic licen[cs]e"),
    ("bsl-1.0", "machine", r"solely in the form of machine-executable object code generated by a source language processor"),
    ("boost-notice", "boost", r"distributed under the boost software licen[cs]e, version 1\.0"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "compile", r"anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    ("wtfpl", "fuck", r"do what the fuck you want to(?: public licen[cs]e)?"),
    ("beerware", "beer", r"you can buy me a beer in return"),
    ("cc0-1.0", "waived", r"has waived all copyright and related or neighboring rights to this work"),
    ("cc0-1.0", "dedicate", r"dedicated? (?:all )?copyright and related and neighboring rights to this software to the public domain"),
    ("ofl-1.1", "font", r"this font software is licen[cs]ed under the sil open font licen[cs]e"),
    ("psf-2.0", "psf", r"psf hereby grants licensee a nonexclusive, royalty-free, world-wide licen[cs]e"),
    ("openssl", "openssl", r"this product includes software developed by the openssl project"),
    ("postgresql", "california", r"in no event shall the university of california be liable to any party"),
    ("ncsa", "deal", r"to deal with the software without restriction, including without limitation the rights"),
    ("vim", "vim", r"vim is charityware"),
    ("json", "evil", r"the software shall be used for good, not evil"),
    ("elastic-2.0", "hosted", r"you may not provide the software to third parties as a hosted or managed service"),
    ("busl-1.1", "production", r"the licensor hereby grants you the right to copy, modify, create derivative works, redistribute, and make non-production use"),
    ("commons-clause", "commons", r"commons clause (?:licen[cs]e )?condition"),
    ("commons-clause", "sell", r"the licen[cs]e does not include, the right to sell the software"),
    ("llama-community", "llama", r"(?:meta )?llama [0-9.]{1,4} community licen[cs]e"),
    ("openrail", "restrictions", r"use-based restrictions as referenced in paragraph"),
    ("crown-copyright", "crown", r"© ?crown copyright"),
    ("ogl-uk", "sector", r"contains public sector information licen[cs]ed under the open government licen[cs]e"),
    ("us-government-work", "government", r"work of the u(?:nited |\.)s(?:tates|\.) government"),
)

LINKS = (
    ("apache-2.0", "apache.org", r"apache\.org/licen[cs]es/licen[cs]e-2\.0"),
    ("apache-1.1", "apache.org", r"apache\.org/licen[cs]es/licen[cs]e-1\.1"),
    ("mit", "opensource.org", r"opensource\.org/licen[cs]es?/mit(?:-licen[cs]e)?"),
    ("bsd-2-clause", "opensource.org", r"opensource\.org/licen[cs]es?/bsd-2-clause"),
    ("bsd-3-clause", "opensource.org", r"opensource\.org/licen[cs]es?/bsd-3-clause"),
    ("isc", "opensource.org", r"opensource\.org/licen[cs]es?/isc"),
    ("gpl-2.0", "gnu.org", r"gnu\.org/licen[cs]es/(?:old-licen[cs]es/)?gpl-2\.0"),
    ("gpl-3.0", "gnu.org", r"gnu\.org/licen[cs]es/gpl-3\.0"),
    ("gpl", "gnu.org", r"gnu\.org/(?:licen[cs]es|copyleft)/gpl\.(?:html|txt)"),
    ("gpl", "gnu.org", r"along with this program\. if not, see <?https?://www\.gnu\.org/licen[cs]es/?>?"),
    ("lgpl-2.1", "gnu.org", r"gnu\.org/licen[cs]es/(?:old-licen[cs]es/)?lgpl-2\.1"),
    ("lgpl-3.0", "gnu.org", r"gnu\.org/licen[cs]es/lgpl-3\.0"),
    ("agpl-3.0", "gnu.org", r"gnu\.org/licen[cs]es/agpl-3\.0"),
    ("gfdl-1.3", "gnu.org", r"gnu\.org/licen[cs]es/fdl-1\.3"),
    ("mpl-2.0", "mozilla.org", r"mozilla\.org/mpl/2\.0"),
    ("mpl-1.1", "mozilla.org", r"mozilla\.org/mpl/(?:mpl-)?1\.1"),
    ("epl-1.0", "eclipse.org", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", "eclipse.org", r"eclipse\.org/legal/epl-(?:v20|2\.0)"),
    ("bsl-1.0", "boost.org", r"boost\.org/licen[cs]e_1_0\.txt"),
    ("unlicense", "unlicense.org", r"unlicense\.org"),
    ("wtfpl", "wtfpl.net", r"wtfpl\.net"),
    ("ofl-1.1", "sil.org", r"scripts\.sil\.org/ofl"),
    ("odbl-1.0", "opendatacommons", r"opendatacommons\.org/licen[cs]es/odbl"),
    ("pddl-1.0", "opendatacommons", r"opendatacommons\.org/licen[cs]es/pddl"),
    ("odc-by-1.0", "opendatacommons", r"opendatacommons\.org/licen[cs]es/by"),
    ("ogl-uk", "nationalarchives", r"nationalarchives\.gov\.uk/doc/open-government-licen[cs]e"),
    ("eupl", "europa.eu", r"joinup\.ec\.europa\.eu/[a-z/-]{0,40}eupl"),
    ("cc0-1.0", "creativecommons.org", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("public-domain", "creativecommons.org", r"creativecommons\.org/publicdomain/mark/1\.0"),
)

MARKS = (
    ("cc0-1.0", "cc0", r"\bcc0(?: 1\.0)?(?: universal)?"),
    ("public-domain", "domain", r"(?:released|placed|dedicated|put|is) (?:in|into|to) the public domain"),
    ("public-domain", "domain", r"public domain mark(?: 1\.0)?"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    ("proprietary", "proprietary", r"confidential and proprietary"),
    ("proprietary", "proprietary", r"proprietary (?:software|licen[cs]e|information)"),
    ("no-redistribution", "redistribut", r"(?:redistribution|redistributing)[^.\n]{0,40} (?:is )?(?:strictly )?(?:prohibited|forbidden|not permitted)"),
    ("no-redistribution", "permission", r"may not be (?:reproduced|republished|redistributed|copied)[^.\n]{0,60} without (?:the )?(?:prior |express )?(?:written )?permission"),
    ("no-redistribution", "prohibited", r"unauthori[sz]ed (?:copying|use|reproduction|distribution)[^.\n]{0,60} (?:is )?(?:strictly )?prohibited"),
    ("non-commercial", "commercial", r"(?:for )?(?:personal(?:,| and) )?non-?commercial (?:use|purposes) only"),
    ("non-commercial", "commercial", r"not for commercial use"),
    ("no-derivatives", "derivative", r"no derivative works (?:are )?(?:allowed|permitted)"),
    ("evaluation", "evaluation", r"for evaluation (?:purposes )?only"),
    ("internal", "internal", r"for internal use only"),
    ("eula", "user", rf"end[ -]user {_L} agreement"),
    ("terms-of-service", "terms", r"subject to (?:our|the) terms of (?:service|use)"),
    ("permission", "permission", r"(?:used|reprinted|reproduced) (?:with|by) (?:kind )?permission"),
    ("opt-out", "mining", r"(?:text and data|data) mining (?:is |are )?(?:prohibited|reserved|not permitted)"),
    ("opt-out", "train", r"may not be used (?:for|to) (?:the )?train(?:ing)?(?: of)? (?:ai|artificial intelligence|machine learning|language) "),
    ("open-access", "access", r"open access (?:article|journal) (?:distributed|published)? ?under"),
    ("attribution", "credit", r"(?:please )?(?:give|provide) (?:appropriate )?credit to the (?:author|creator)s?"),
    ("trademark", "trademark", r"(?:registered )?trademarks? of [^.\n]{2,60}"),
    ("copyright", "copyright", r"copyright (?:\(c\) |© ?)?(?:19|20)[0-9]{2}(?:\s?[-–]\s?(?:19|20)[0-9]{2})?"),
    ("copyright", "©", r"© ?(?:copyright )?(?:19|20)[0-9]{2}"),
    ("copyright", "(c)", r"\(c\) (?:copyright )?(?:19|20)[0-9]{2}"),
    ("reserved", "rights", r"(?:all|some) rights reserved"),
    ("reserved", "reserved", r"no rights reserved"),
)

#: Kinds of Creative Commons licenses and their long names; short names, long names and links are made for each.
CC = (("by-nc-nd", r"attribution-? ?non-?commercial-? ?no-?deriv(?:ative)?s"), ("by-nc-sa", r"attribution-? ?non-?commercial-? ?share-?alike"), ("by-nc", r"attribution-? ?non-?commercial"), ("by-nd", r"attribution-? ?no-?deriv(?:ative)?s"), ("by-sa", r"attribution-? ?share-?alike"), ("by", r"attribution"))
VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


def rules() -> list[tuple[str, str, str, int]]:
    """Label, keyword, pattern and priority of every rule, highest priority first."""
    out = [(label, key, pattern, rank) for rank, table in ((NAME, NAMES), (TEXT, TEXTS), (LINK, LINKS), (MARK, MARKS)) for label, key, pattern in table]
    known = sorted({label for label, _, _ in NAMES if any(c.isdigit() for c in label)} | {"mit", "isc", "zlib", "unlicense", "ncsa", "postgresql"})
    out += [(label, "spdx", rf"spdx-{_L}-identifier: ?\(?{label.replace('.', chr(92) + '.')}(?:-only|-or-later|\+)?", SPDX) for label in known]
    for kind, long in CC:
        short = kind.replace("-", "[ -]")
        out.append((f"cc-{kind}", "cc", rf"\bcc[ -]{short}\b", NAME))
        out.append((f"cc-{kind}", "creative", rf"creative commons {long}(?: international| unported)?", NAME))
        for v in VERSIONS:
            dotted = v.replace(".", r"\.")
            out.append((f"cc-{kind}-{v}", "cc", rf"\bcc[ -]{short}[ -]{dotted}", NAME))
            out.append((f"cc-{kind}-{v}", "creative", rf"creative commons {long}(?: international| unported)? {dotted}", NAME))
        out.append((f"cc-{kind}", "creativecommons.org", rf"creativecommons\.org/licen[cs]es/{kind}/[1-4]\.[05]", LINK))
    blanks = [(label, key, pattern.replace("[ -]", "(?: |-)").replace(" ?", r"\s{0,4}").replace(" ", r"\s{1,4}"), rank) for label, key, pattern, rank in out]
    return sorted(blanks, key=lambda r: (-r[3], r[0], r[2]))
