"""Signature rules of the licence scan.

A rule: gate (a lower-case literal that any match contains, once lower-cased
and with one blank for each run of white space), priority (1 is
the strongest), label, confidence and regex (ASCII case-insensitive; never
matches the empty string).  ``NAMES`` has a hand-written regex for each
licence's name; ``SENTENCES`` has signature sentences.  ``rules()`` orders
them: tags and sentences, then grants that name a licence, then bare names.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    gate: str
    priority: int
    label: str
    confidence: float
    regex: str


#: a version's lead, as in "License, Version 2.0" or "v2"
V = r",?\s*(?:v(?:ersion)?\.?\s*)?"

#: label: (gate, SPDX identifiers, regex of the name)
NAMES: dict[str, tuple[str, str, str]] = {
    "apache-2.0": ("apache", r"Apache-2\.0", rf"Apache\s+(?:Software\s+)?Licen[cs]e{V}2(?:\.0)?\b"),
    "apache-1.1": ("apache", r"Apache-1\.1", rf"Apache\s+(?:Software\s+)?Licen[cs]e{V}1\.1\b"),
    "apache-1.0": ("apache", r"Apache-1\.0", rf"Apache\s+(?:Software\s+)?Licen[cs]e{V}1\.0\b"),
    "mit": ("mit", r"MIT", r"\bMIT[\s/-]+(?:Expat[\s-]+)?Licen[cs]e\b"),
    "mit-0": ("mit", r"MIT-0", r"\bMIT\s+No\s+Attribution\b"),
    "x11": ("x11", r"X11", r"\bX11\s+Licen[cs]e\b"),
    "expat": ("expat", r"Expat", r"\bExpat\s+Licen[cs]e\b"),
    "isc": ("isc", r"ISC", r"\bISC\s+Licen[cs]e\b"),
    "0bsd": ("bsd", r"0BSD", r"\b(?:Zero[\s-]+Clause\s+BSD|BSD\s+Zero[\s-]+Clause)\b"),
    "bsd-2-clause": ("bsd", r"BSD-2-Clause(?:-FreeBSD|-Views)?", r"\b(?:2|two)[\s-]+clause\s+(?:Free)?BSD\b|\b(?:simplified|Free)[\s-]*BSD\s+Licen[cs]e\b|\bBSD\s+2[\s-]+clause\b"),
    "bsd-3-clause": ("bsd", r"BSD-3-Clause(?:-Clear)?", r"\b(?:3|three)[\s-]+clause\s+BSD\b|\b(?:new|revised|modified)[\s-]+BSD\s+Licen[cs]e\b|\bBSD\s+3[\s-]+clause\b"),
    "bsd-4-clause": ("bsd", r"BSD-4-Clause(?:-UC)?", r"\b(?:4|four)[\s-]+clause\s+BSD\b|\boriginal\s+BSD\s+Licen[cs]e\b|\bBSD\s+4[\s-]+clause\b"),
    "bsd": ("bsd", r"BSD", r"\bBSD(?:[\s-]+style)?[\s-]+Licen[cs]e\b"),
    "gpl-1.0": ("general public licen", r"GPL-1\.0(?:-only|-or-later|\+)?", rf"(?<!Lesser\s)(?<!Library\s)(?<!Affero\s)General\s+Public\s+Licen[cs]e{V}1\b"),
    "gpl-2.0": ("general public licen", r"GPL-2\.0(?:-only|-or-later|\+)?", rf"(?<!Lesser\s)(?<!Library\s)(?<!Affero\s)General\s+Public\s+Licen[cs]e{V}2(?:\.0)?\b(?!\.\d)"),
    "gpl-3.0": ("general public licen", r"GPL-3\.0(?:-only|-or-later|\+)?", rf"(?<!Lesser\s)(?<!Library\s)(?<!Affero\s)General\s+Public\s+Licen[cs]e{V}3(?:\.0)?\b"),
    "lgpl-2.0": ("library general public", r"LGPL-2\.0(?:-only|-or-later|\+)?", rf"Library\s+General\s+Public\s+Licen[cs]e{V}2(?:\.0)?\b(?!\.\d)"),
    "lgpl-2.1": ("lesser general public", r"LGPL-2\.1(?:-only|-or-later|\+)?", rf"Lesser\s+General\s+Public\s+Licen[cs]e{V}2\.1\b"),
    "lgpl-3.0": ("lesser general public", r"LGPL-3\.0(?:-only|-or-later|\+)?", rf"Lesser\s+General\s+Public\s+Licen[cs]e{V}3(?:\.0)?\b"),
    "lgpl": ("lesser general public", r"LGPL", r"\bLesser\s+General\s+Public\s+Licen[cs]e\b"),
    "agpl-3.0": ("affero", r"AGPL-3\.0(?:-only|-or-later|\+)?", rf"Affero\s+General\s+Public\s+Licen[cs]e{V}3(?:\.0)?\b"),
    "agpl": ("affero", r"AGPL", r"\bAffero\s+General\s+Public\s+Licen[cs]e\b"),
    "gfdl": ("free documentation", r"GFDL-1\.[123](?:-only|-or-later)?", r"\bGNU\s+Free\s+Documentation\s+Licen[cs]e\b"),
    "mpl-1.1": ("mozilla", r"MPL-1\.1", rf"Mozilla\s+Public\s+Licen[cs]e{V}1\.1\b"),
    "mpl-2.0": ("mozilla", r"MPL-2\.0(?:-no-copyleft-exception)?", rf"Mozilla\s+Public\s+Licen[cs]e{V}2(?:\.0)?\b"),
    "mpl": ("mozilla", r"MPL", r"\bMozilla\s+Public\s+Licen[cs]e\b"),
    "epl-1.0": ("eclipse", r"EPL-1\.0", rf"Eclipse\s+Public\s+Licen[cs]e{V}1(?:\.0)?\b"),
    "epl-2.0": ("eclipse", r"EPL-2\.0", rf"Eclipse\s+Public\s+Licen[cs]e{V}2(?:\.0)?\b"),
    "edl-1.0": ("eclipse", r"EDL-1\.0", r"\bEclipse\s+Distribution\s+Licen[cs]e\b"),
    "cddl-1.0": ("common development", r"CDDL-1\.[01]", r"\bCommon\s+Development\s+and\s+Distribution\s+Licen[cs]e\b"),
    "cpl-1.0": ("common public", r"CPL-1\.0", r"\bCommon\s+Public\s+Licen[cs]e\b"),
    "cpal-1.0": ("common public attribution", r"CPAL-1\.0", r"\bCommon\s+Public\s+Attribution\s+Licen[cs]e\b"),
    "ipl-1.0": ("ibm public", r"IPL-1\.0", r"\bIBM\s+Public\s+Licen[cs]e\b"),
    "eupl-1.1": ("european union public", r"EUPL-1\.1", rf"European\s+Union\s+Public\s+Licen[cs]e{V}1\.1\b"),
    "eupl-1.2": ("european union public", r"EUPL-1\.2", rf"European\s+Union\s+Public\s+Licen[cs]e{V}1\.2\b"),
    "cecill-2.1": ("cecill", r"CECILL-2\.[01]", rf"\bCeCILL(?:\s+Licen[cs]e)?{V}2(?:\.[01])?\b"),
    "cecill-b": ("cecill", r"CECILL-B", r"\bCeCILL-B\b"),
    "artistic-1.0": ("artistic", r"Artistic-1\.0(?:-Perl|-cl8)?", rf"Artistic\s+Licen[cs]e{V}1(?:\.0)?\b"),
    "artistic-2.0": ("artistic", r"Artistic-2\.0", rf"Artistic\s+Licen[cs]e{V}2(?:\.0)?\b"),
    "bsl-1.0": ("boost", r"BSL-1\.0", r"\bBoost\s+Software\s+Licen[cs]e\b"),
    "busl-1.1": ("business source", r"BUSL-1\.1", r"\bBusiness\s+Source\s+Licen[cs]e\b"),
    "sspl-1.0": ("server side public", r"SSPL-1\.0", r"\bServer\s+Side\s+Public\s+Licen[cs]e\b"),
    "elastic-2.0": ("elastic", r"Elastic-2\.0", rf"\bElastic\s+Licen[cs]e{V}2(?:\.0)?\b"),
    "zlib": ("zlib", r"Zlib", r"\bzlib(?:/libpng)?\s+Licen[cs]e\b"),
    "libpng": ("png", r"libpng-2\.0", r"\bPNG\s+Reference\s+Library\s+Licen[cs]e\b|\blibpng\s+Licen[cs]e\b"),
    "openssl": ("openssl", r"OpenSSL", r"\bOpenSSL\s+Licen[cs]e\b"),
    "curl": ("curl", r"curl", r"\bcurl\s+Licen[cs]e\b"),
    "php-3.01": ("php", r"PHP-3\.01?", r"\bPHP\s+Licen[cs]e\b"),
    "python-2.0": ("licen", r"(?:PSF|Python)-2\.0", r"\b(?:PSF|Python(?:\s+Software\s+Foundation)?)\s+Licen[cs]e\b"),
    "ruby": ("ruby", r"Ruby", r"\bRuby\s+Licen[cs]e\b"),
    "postgresql": ("postgresql", r"PostgreSQL", r"\bPostgreSQL\s+Licen[cs]e\b"),
    "ncsa": ("ncsa", r"NCSA", r"\b(?:University\s+of\s+Illinois/)?NCSA\s+(?:Open\s+Source\s+)?Licen[cs]e\b"),
    "unlicense": ("unlicense", r"Unlicense", r"\bThe\s+Unlicense\b"),
    "wtfpl": ("wtfpl", r"WTFPL", r"\bWTFPL\b"),
    "cc0-1.0": ("cc0", r"CC0-1\.0", r"\bCC0(?:[\s-]+1\.0)?\b"),
    "cc-by-4.0": ("cc", r"CC-BY-4\.0", r"\bCC[\s-]+BY[\s-]+4\.0\b"),
    "cc-by-3.0": ("cc", r"CC-BY-3\.0", r"\bCC[\s-]+BY[\s-]+3\.0\b"),
    "cc-by-2.0": ("cc", r"CC-BY-2\.[05]", r"\bCC[\s-]+BY[\s-]+2\.[05]\b"),
    "cc-by-sa-4.0": ("cc", r"CC-BY-SA-4\.0", r"\bCC[\s-]+BY-SA[\s-]+4\.0\b"),
    "cc-by-sa-3.0": ("cc", r"CC-BY-SA-3\.0", r"\bCC[\s-]+BY-SA[\s-]+3\.0\b"),
    "cc-by-nc-4.0": ("cc", r"CC-BY-NC-4\.0", r"\bCC[\s-]+BY-NC[\s-]+4\.0\b"),
    "cc-by-nc-3.0": ("cc", r"CC-BY-NC-3\.0", r"\bCC[\s-]+BY-NC[\s-]+3\.0\b"),
    "cc-by-nd-4.0": ("cc", r"CC-BY-ND-4\.0", r"\bCC[\s-]+BY-ND[\s-]+4\.0\b"),
    "cc-by-nc-sa-4.0": ("cc", r"CC-BY-NC-SA-4\.0", r"\bCC[\s-]+BY-NC-SA[\s-]+4\.0\b"),
    "cc-by-nc-nd-4.0": ("cc", r"CC-BY-NC-ND-4\.0", r"\bCC[\s-]+BY-NC-ND[\s-]+4\.0\b"),
    "odbl-1.0": ("open database", r"ODbL-1\.0", r"\bOpen\s+(?:Data\s+Commons\s+Open\s+)?Database\s+Licen[cs]e\b"),
    "odc-by-1.0": ("open data commons", r"ODC-By-1\.0", r"\bOpen\s+Data\s+Commons\s+Attribution\s+Licen[cs]e\b"),
    "pddl-1.0": ("public domain dedication", r"PDDL-1\.0", r"\bPublic\s+Domain\s+Dedication\s+and\s+Licen[cs]e\b"),
    "ofl-1.1": ("open font", r"OFL-1\.[01](?:-RFN|-no-RFN)?", r"\bSIL\s+Open\s+Font\s+Licen[cs]e\b"),
    "ms-pl": ("microsoft public", r"MS-PL", r"\bMicrosoft\s+Public\s+Licen[cs]e\b"),
    "ms-rl": ("microsoft reciprocal", r"MS-RL", r"\bMicrosoft\s+Reciprocal\s+Licen[cs]e\b"),
    "osl-3.0": ("open software", r"OSL-3\.0", r"\bOpen\s+Software\s+Licen[cs]e\b"),
    "afl-3.0": ("academic free", r"AFL-[23]\.[01]", r"\bAcademic\s+Free\s+Licen[cs]e\b"),
    "upl-1.0": ("universal permissive", r"UPL-1\.0", r"\bUniversal\s+Permissive\s+Licen[cs]e\b"),
    "qpl-1.0": ("q public", r"QPL-1\.0", r"\bQ\s+Public\s+Licen[cs]e\b"),
    "sleepycat": ("sleepycat", r"Sleepycat", r"\bSleepycat\s+Licen[cs]e\b"),
    "vim": ("vim", r"Vim", r"\bVim\s+Licen[cs]e\b"),
    "w3c": ("w3c", r"W3C(?:-\d+)?", r"\bW3C\s+Software\s+(?:Notice\s+and\s+)?Licen[cs]e\b"),
    "mulanpsl-2.0": ("mulan", r"MulanPSL-2\.0", r"\bMulan\s+P(?:ermissive\s+)?S(?:oftware\s+)?L(?:icen[cs]e)?\b"),
    "openrail": ("rail", r"(?:Big)?(?:Science-)?Open-?RAIL(?:\+\+)?(?:-M)?", r"\b(?:Creative\s+ML\s+)?OpenRAIL(?:\+\+)?(?:-[MDS])?\b"),
}

#: (gate, priority, label, confidence, regex)
SENTENCES = (
    ("permission is hereby granted", 1, "mit", 0.95, r"Permission\s+is\s+hereby\s+granted,\s+free\s+of\s+charge,\s+to\s+any\s+person\s+obtaining\s+a\s+copy"),
    ("above copyright notice", 2, "mit", 0.7, r"The\s+above\s+copyright\s+notice\s+and\s+this\s+permission\s+notice\s+shall\s+be\s+included"),
    ("permission to use", 1, "isc", 0.9, r"Permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software\s+for\s+any\s+purpose\s+with\s+or\s+without\s+fee"),
    ("redistribution and use", 1, "bsd", 0.9, r"Redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms,\s+with\s+or\s+without\s+modification"),
    ("endorse or promote", 1, "bsd-3-clause", 0.9, r"Neither\s+the\s+names?\s+of\s+[^.]{1,160}?\s+may\s+be\s+used\s+to\s+endorse\s+or\s+promote"),
    ("advertising materials", 1, "bsd-4-clause", 0.9, r"All\s+advertising\s+materials\s+mentioning\s+features\s+or\s+use\s+of\s+this\s+software"),
    ("apache.org/licenses", 1, "apache-2.0", 0.95, r"https?://(?:www\.)?apache\.org/licenses/LICENSE-2\.0"),
    ("apache.org/licenses", 2, "apache", 0.8, r"https?://(?:www\.)?apache\.org/licenses/?"),
    ("in compliance with the licen", 2, "apache-2.0", 0.7, r"you\s+may\s+not\s+use\s+this\s+file\s+except\s+in\s+compliance\s+with\s+the\s+Licen[cs]e"),
    ("free software", 1, "gpl", 0.85, r"This\s+program\s+is\s+free\s+software[;:,]\s+you\s+can\s+redistribute\s+it"),
    ("either version", 1, "gpl-2.0", 0.85, r"either\s+version\s+2\s+of\s+the\s+Licen[cs]e,\s+or\s+\(at\s+your\s+option\)\s+any\s+later"),
    ("either version", 1, "gpl-3.0", 0.85, r"either\s+version\s+3\s+of\s+the\s+Licen[cs]e,\s+or\s+\(at\s+your\s+option\)\s+any\s+later"),
    ("gnu.org/licenses", 2, "gpl", 0.8, r"https?://(?:www\.)?gnu\.org/licenses/(?:gpl[^\s<>\"]*)?"),
    ("gnu.org/licenses", 1, "lgpl", 0.9, r"https?://(?:www\.)?gnu\.org/licenses/lgpl[^\s<>\"]*"),
    ("gnu.org/licenses", 1, "agpl", 0.9, r"https?://(?:www\.)?gnu\.org/licenses/agpl[^\s<>\"]*"),
    ("gnu gpl", 3, "gpl", 0.7, r"\bGNU\s+GPL(?:v?[23](?:\.0)?)?\b"),
    ("gplv2", 2, "gpl-2.0", 0.85, r"\bGPLv2(?:\.0)?\+?"),
    ("gplv3", 2, "gpl-3.0", 0.85, r"\bGPLv3(?:\.0)?\+?"),
    ("mozilla.org/", 1, "mpl", 0.9, r"https?://(?:www\.)?mozilla\.org/(?:[a-z-]+/)?MPL/(?:[12]\.[01])?"),
    ("eclipse.org/legal", 1, "epl-2.0", 0.85, r"https?://(?:www\.)?eclipse\.org/legal/epl-(?:2\.0|v20)"),
    ("opensource.org/licenses", 1, "mit", 0.9, r"https?://(?:www\.)?opensource\.org/licenses/MIT\b"),
    ("opensource.org/licenses", 2, "open-source", 0.6, r"https?://(?:www\.)?opensource\.org/licenses/[\w.-]+"),
    ("creativecommons.org", 1, "cc-by", 0.9, r"https?://creativecommons\.org/licenses/by/\d\.\d"),
    ("creativecommons.org", 1, "cc-by-sa", 0.9, r"https?://creativecommons\.org/licenses/by-sa/\d\.\d"),
    ("creativecommons.org", 1, "cc-by-nc", 0.9, r"https?://creativecommons\.org/licenses/by-nc(?:-sa|-nd)?/\d\.\d"),
    ("creativecommons.org", 1, "cc-by-nd", 0.9, r"https?://creativecommons\.org/licenses/by-nd/\d\.\d"),
    ("creativecommons.org", 1, "cc0-1.0", 0.9, r"https?://creativecommons\.org/publicdomain/zero/1\.0"),
    ("creativecommons.org", 2, "cc-publicdomain", 0.8, r"https?://creativecommons\.org/publicdomain/mark/1\.0"),
    ("creative commons", 1, "cc-by-nc", 0.85, r"Creative\s+Commons\s+Attribution[\s-]+Non-?Commercial"),
    ("creative commons", 1, "cc-by-sa", 0.85, r"Creative\s+Commons\s+Attribution[\s-]+Share-?\s*Alike"),
    ("creative commons", 2, "cc-by", 0.75, r"Creative\s+Commons\s+Attribution"),
    ("creative commons", 3, "cc", 0.6, r"Creative\s+Commons"),
    ("public domain", 1, "unlicense", 0.9, r"free\s+and\s+unencumbered\s+software\s+released\s+into\s+the\s+public\s+domain"),
    ("public domain", 2, "public-domain", 0.7, r"(?:released|dedicated|placed|donated)\s+(?:in)?to\s+the\s+public\s+domain"),
    ("public domain", 3, "public-domain", 0.4, r"\bin\s+the\s+public\s+domain\b"),
    ("all rights reserved", 2, "proprietary", 0.6, r"\bAll\s+rights\s+reserved\b"),
    ("may be reproduced", 2, "proprietary", 0.7, r"No\s+part\s+of\s+this\s+(?:publication|work|document)\s+may\s+be\s+reproduced"),
    ("confidential", 2, "proprietary", 0.6, r"(?:proprietary\s+and\s+confidential|confidential\s+and\s+proprietary)"),
    ("without warranty", 3, "warranty-disclaimer", 0.3, r"\bWITHOUT\s+WARRANTY\s+OF\s+ANY\s+KIND\b"),
    ("without any warranty", 3, "warranty-disclaimer", 0.3, r"\bWITHOUT\s+ANY\s+WARRANTY\b"),
    ("provided", 2, "zlib", 0.8, r"This\s+software\s+is\s+provided\s+'as-is',\s+without\s+any\s+express\s+or\s+implied"),
    ("do what the", 1, "wtfpl", 0.95, r"Do\s+What\s+The\s+F\S+\s+You\s+Want\s+To\s+Public\s+Licen[cs]e"),
    ("copyright", 3, "copyright", 0.3, r"\bCopyright\s+(?:\(c\)|©|&copy;)?\s*(?:19|20)\d\d\b"),
    ("spdx-license-identifier", 2, "spdx", 0.6, r"SPDX-License-Identifier:\s*[\w.+-]+"),
    ("licensed under", 3, "license-grant", 0.4, r"\blicensed\s+under\b"),
    ("general public licen", 3, "gpl", 0.7, r"\bGeneral\s+Public\s+Licen[cs]e\b"),
    ("apache licen", 3, "apache", 0.7, r"\bApache\s+Licen[cs]e\b"),
)

GRANT = r"\b(?:licen[cs]ed|released|distributed|available|provided|published|shared|covered|governed|redistribute(?:d)?\s+it)\s+(?:under|by|according\s+to)\s+(?:(?:the|a)\s+)?(?:terms\s+(?:and\s+conditions\s+)?of\s+)?(?:the\s+)?(?:GNU\s+)?"


def rules() -> list[Rule]:
    """All rules by priority."""
    found = [Rule(g, p, label, c, f"(?i){regex}") for g, p, label, c, regex in SENTENCES]
    for label, (gate, identifiers, name) in NAMES.items():
        found.append(Rule("spdx-license-identifier", 1, label, 0.99, rf"(?i)SPDX-License-Identifier:\s*\(?(?:{identifiers})(?![\w.+-])"))
        found.append(Rule(gate, 2, label, 0.9, rf"(?i){GRANT}(?:{name})"))
        found.append(Rule(gate, 3, label, 0.6, rf"(?i)(?:{name})"))
    return sorted(found, key=lambda r: r.priority)
