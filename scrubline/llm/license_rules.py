"""Signature rules for licence statements.

Each line: priority, label, keyword, pattern.  Rules are read over a text's
lower-case words joined by one blank, so ``version 2.0`` reads ``version 2 0``;
a pattern starts and ends at word bounds.  Only texts that hold the keyword are
searched, so every match of a pattern must hold it at the start of a word: a rule
with alternatives that share no keyword is several lines.  Priorities: 5 a full statement or identifier, 4 a named licence with
its version, 3 a named licence, 2 a typical clause, 1 a hint.
"""

RULES_TEXT = r"""
5 apache-2.0|apache license|licensed under the apache license version 2 0
5 apache-2.0|apache org|https? www apache org licenses license 2 0(?: txt| html)?
5 apache-2.0|spdx|spdx license identifier apache 2 0
4 apache-2.0|apache|apache (?:software )?licen[cs]e (?:version |v )?2(?: 0)?
4 apache-2.0|apache|apache v?2(?: 0)? licen[cs]ed?
4 apache-1.1|apache|apache (?:software )?licen[cs]e (?:version |v )?1 1
4 apache-1.0|apache|apache (?:software )?licen[cs]e (?:version |v )?1 0
3 apache|apache|apache (?:software )?licen[cs]e
2 apache|apache software foundation|apache software foundation asf under one or more contributor license agreements
2 apache|limitations under the|see the license for the specific language governing permissions and limitations under the license
2 apache|as is basis|distributed on an as is basis without warranties or conditions of any kind
5 mit|mit license|released under the mit license
5 mit|mit license|(?:is )?licensed under the (?:terms of the )?mit license
5 mit|spdx|spdx license identifier mit
5 mit|permission is hereby|permission is hereby granted free of charge to any person obtaining a copy of this software
4 mit|opensource org|https? (?:www )?opensource org licenses mit(?: license)?(?: php)?
4 mit|mit licen|(?:the )?mit licen[cs]e(?: expat)?
4 mit|expat|expat licen[cs]e
3 mit|mit licensed|mit licensed
3 mit-0|mit 0|mit 0(?: licen[cs]e)?
3 mit-0|mit no attribution|mit no attribution(?: license)?
2 mit|substantial portions|the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
2 mit|software is provided|the software is provided as is without warranty of any kind express or implied
3 x11|x11|x11 licen[cs]e
5 gpl-3.0|general public license|licensed under the gnu general public license version 3
5 gpl-3.0-or-later|spdx|spdx license identifier gpl 3 0 or later
5 gpl-3.0-only|spdx|spdx license identifier gpl 3 0(?: only)?
5 gpl-2.0-or-later|spdx|spdx license identifier gpl 2 0 or later
5 gpl-2.0-only|spdx|spdx license identifier gpl 2 0(?: only)?
5 gpl-2.0-or-later|either version|either version 2 of the license or at your option any later version
5 gpl-3.0-or-later|either version|either version 3 of the license or at your option any later version
4 gpl-3.0|general public license|gnu general public license (?:as published by the free software foundation )?(?:version |v )?3(?: 0)?
4 gpl-2.0|general public license|gnu general public license (?:as published by the free software foundation )?(?:version |v )?2(?: 0)?
4 gpl-1.0|general public license|gnu general public license (?:version |v )?1(?: 0)?
4 gpl-3.0|gpl|(?:gnu )?gpl (?:version )?v?3(?: 0)?
4 gpl-2.0|gpl|(?:gnu )?gpl (?:version )?v?2(?: 0)?
4 gpl-3.0|gplv3|gplv3
4 gpl-2.0|gplv2|gplv2
4 gpl-3.0|gnu org|https? www gnu org licenses gpl 3 0(?: en)?(?: html| txt)?
4 gpl-2.0|gnu org|https? www gnu org licenses (?:old licenses )?gpl 2 0(?: en)?(?: html| txt)?
3 gpl-family|gnu|gnu general public licen[cs]e
3 gpl-family|gnu|gnu gpl
3 gpl-family|gpl|gpl licen[cs]ed?
3 gpl-family|gnu org|https? www gnu org licenses gpl(?: html)?
2 gpl-family|free software|this (?:program|library|file) is free software you can redistribute it and or modify it
2 gpl-family|merchantability|without even the implied warranty of merchantability or fitness for a particular purpose
2 gpl-family|free software foundation|as published by the free software foundation
2 gpl-family|copy of the gnu|you should have received a copy of the gnu (?:lesser |affero |library )?general public license
5 lgpl-3.0|spdx|spdx license identifier lgpl 3 0(?: only| or later)?
5 lgpl-2.1|spdx|spdx license identifier lgpl 2 1(?: only| or later)?
5 lgpl-2.0|spdx|spdx license identifier lgpl 2 0(?: only| or later)?
4 lgpl-3.0|lesser|gnu lesser general public license (?:version |v )?3(?: 0)?
4 lgpl-2.1|lesser|gnu lesser general public license (?:version |v )?2 1
4 lgpl-2.0|library general|gnu library general public license (?:version |v )?2(?: 0)?
4 lgpl-3.0|lgpl|lgpl (?:version )?v?3(?: 0)?
4 lgpl-2.1|lgpl|lgpl (?:version )?v?2 1
4 lgpl-3.0|lgplv3|lgplv3
3 lgpl|lesser|(?:gnu )?lesser general public licen[cs]e
3 lgpl|library general|(?:gnu )?library general public licen[cs]e
3 lgpl|lgpl|lgpl(?: licen[cs]ed?)?
5 agpl-3.0|spdx|spdx license identifier agpl 3 0(?: only| or later)?
4 agpl-3.0|affero|gnu affero general public license (?:version |v )?3(?: 0)?
4 agpl-3.0|agpl|agpl (?:version )?v?3(?: 0)?
4 agpl-3.0|agplv3|agplv3
3 agpl|affero|(?:gnu )?affero general public licen[cs]e
3 agpl|agpl|agpl(?: licen[cs]ed?)?
4 gfdl-1.3|free documentation|gnu free documentation license (?:version |v )?1 3
4 gfdl-1.2|free documentation|gnu free documentation license (?:version |v )?1 2
4 gfdl-1.1|free documentation|gnu free documentation license (?:version |v )?1 1
3 gfdl|free documentation|(?:gnu )?free documentation licen[cs]e
3 gfdl|gfdl|gfdl
2 gfdl|invariant sections|with no invariant sections(?: no front cover texts and no back cover texts)?
5 cc-by-nc-4.0|cc by nc|licensed under cc by nc 4 0
5 cc-by-4.0|cc by|licensed under cc by 4 0
5 cc-by-sa-4.0|cc by sa|licensed under cc by sa 4 0
5 cc-by-4.0|spdx|spdx license identifier cc by 4 0
5 cc-by-sa-4.0|spdx|spdx license identifier cc by sa 4 0
5 cc0-1.0|spdx|spdx license identifier cc0 1 0
4 cc-by-nc-nd-4.0|cc by nc nd|cc by nc nd 4 0
4 cc-by-nc-nd-3.0|cc by nc nd|cc by nc nd 3 0
4 cc-by-nc-nd-2.5|cc by nc nd|cc by nc nd 2 5
4 cc-by-nc-sa-4.0|cc by nc sa|cc by nc sa 4 0
4 cc-by-nc-sa-3.0|cc by nc sa|cc by nc sa 3 0
4 cc-by-nc-sa-2.5|cc by nc sa|cc by nc sa 2 5
4 cc-by-nc-sa-2.0|cc by nc sa|cc by nc sa 2 0
4 cc-by-nc-4.0|cc by nc|cc by nc 4 0
4 cc-by-nc-3.0|cc by nc|cc by nc 3 0
4 cc-by-nc-2.5|cc by nc|cc by nc 2 5
4 cc-by-nc-2.0|cc by nc|cc by nc 2 0
4 cc-by-nd-4.0|cc by nd|cc by nd 4 0
4 cc-by-nd-3.0|cc by nd|cc by nd 3 0
4 cc-by-sa-4.0|cc by sa|cc by sa 4 0
4 cc-by-sa-3.0|cc by sa|cc by sa 3 0
4 cc-by-sa-2.5|cc by sa|cc by sa 2 5
4 cc-by-sa-2.0|cc by sa|cc by sa 2 0
4 cc-by-4.0|cc by|cc by 4 0
4 cc-by-3.0|cc by|cc by 3 0
4 cc-by-2.5|cc by|cc by 2 5
4 cc-by-2.0|cc by|cc by 2 0
3 cc-by-nc-nd|cc by nc nd|cc by nc nd
3 cc-by-nc-sa|cc by nc sa|cc by nc sa
3 cc-by-nc|cc by nc|cc by nc
3 cc-by-nd|cc by nd|cc by nd
3 cc-by-sa|cc by sa|cc by sa
4 cc0-1.0|cc0|cc0(?: 1 0(?: universal)?)
3 cc0-1.0|cc0|cc0
3 cc0-1.0|creative commons zero|creative commons zero
4 cc-by-nc-nd|creative commons|creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: works)?(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
4 cc-by-nc-sa|creative commons|creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
4 cc-by-nc|creative commons|creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
4 cc-by-sa|creative commons|creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
4 cc-by-nd|creative commons|creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
3 cc-by|creative commons|creative commons attribution(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
2 cc|creative commons|creative commons licen[cs]e
1 cc|creative commons|creative commons
4 cc-by-nc-nd|creativecommons|https? creativecommons org licenses by nc nd(?: [1-4] [05])?
4 cc-by-nc-sa|creativecommons|https? creativecommons org licenses by nc sa(?: [1-4] [05])?
4 cc-by-nc|creativecommons|https? creativecommons org licenses by nc(?: [1-4] [05])?
4 cc-by-sa|creativecommons|https? creativecommons org licenses by sa(?: [1-4] [05])?
4 cc-by-nd|creativecommons|https? creativecommons org licenses by nd(?: [1-4] [05])?
3 cc-by|creativecommons|https? creativecommons org licenses by(?: [1-4] [05])?
4 cc0-1.0|creativecommons|https? creativecommons org publicdomain zero(?: 1 0)?
4 pdm|creativecommons|https? creativecommons org publicdomain mark(?: 1 0)?
5 bsd-3-clause|spdx|spdx license identifier bsd 3 clause
5 bsd-2-clause|spdx|spdx license identifier bsd 2 clause
4 bsd-4-clause|clause|(?:bsd 4 clause|4 clause bsd|four clause bsd)(?: licen[cs]e)?
4 bsd-3-clause|clause|(?:bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[cs]e)?
4 bsd-2-clause|clause|(?:bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[cs]e)?
4 0bsd|0bsd|0bsd
4 0bsd|zero clause|(?:bsd zero clause|zero clause bsd)(?: licen[cs]e)?
4 bsd-new|bsd|(?:new|modified|revised) bsd licen[cs]e
4 bsd-simplified|simplified|simplified (?:bsd )?licen[cs]e
4 bsd-simplified|freebsd|freebsd (?:bsd )?licen[cs]e
3 bsd|bsd|bsd (?:style )?licen[cs]ed?
3 bsd|bsd|licensed under (?:the )?bsd
2 bsd|redistribution and use|redistribution and use in source and binary forms with or without modification are permitted
2 bsd|binary form must|redistributions in binary form must reproduce the above copyright notice
2 bsd|source code must|redistributions of source code must retain the above copyright notice
2 bsd-3-clause|endorse or promote|may be used to endorse or promote products derived from this software
2 bsd-4-clause|advertising materials|all advertising materials mentioning features or use of this software
4 isc|isc|(?:the )?isc licen[cs]e
4 isc|spdx|spdx license identifier isc
2 isc|permission to use copy|permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
5 mpl-2.0|mozilla|subject to the terms of the mozilla public license v(?:ersion)? ?2 0
5 mpl-2.0|spdx|spdx license identifier mpl 2 0
4 mpl-2.0|mozilla|mozilla public license (?:version |v )?2(?: 0)?
4 mpl-1.1|mozilla|mozilla public license (?:version |v )?1 1
4 mpl-1.0|mozilla|mozilla public license (?:version |v )?1 0
4 mpl-2.0|mpl|mpl (?:version )?v?2(?: 0)?
3 mpl|mozilla|mozilla public licen[cs]e
3 mpl|mpl|mpl licen[cs]ed?
4 epl-2.0|eclipse|eclipse public license (?:version |v )?2(?: 0)?
4 epl-1.0|eclipse|eclipse public license (?:version |v )?1(?: 0)?
3 epl|eclipse|eclipse public licen[cs]e
4 edl-1.0|eclipse|eclipse distribution license(?: version| v)? 1 0
4 cddl-1.1|cddl|cddl (?:version )?v?1 1
4 cddl-1.0|cddl|cddl (?:version )?v?1 0
3 cddl|common development|common development and distribution licen[cs]e
3 cddl|cddl|cddl
4 cpl-1.0|common public|common public license (?:version |v )?1 0
3 cpl|common public|common public licen[cs]e
3 ipl-1.0|ibm public|ibm public licen[cs]e(?: (?:version |v )?1 0)?
4 eupl-1.2|eupl|eupl (?:version )?v?1 2
4 eupl-1.1|eupl|eupl (?:version )?v?1 1
4 eupl|european union|european union public licen[cs]e
3 eupl|eupl|eupl
4 artistic-2.0|artistic|artistic license (?:version |v )?2(?: 0)?
4 artistic-1.0|artistic|artistic license (?:version |v )?1(?: 0)?
3 artistic|artistic|artistic licen[cs]e
3 artistic|same terms as perl|under the same terms as perl(?: itself)?
3 unlicense|unlicense|(?:the )?unlicense
3 unlicense|unlicense org|https? unlicense org
2 unlicense|public domain|free and unencumbered software released into the public domain
3 wtfpl|wtfpl|wtfpl
3 wtfpl|what the fuck|do what the fuck you want to(?: public license)?
4 bsl-1.0|boost|boost software license(?: version| v)? 1 0
3 bsl-1.0|boost|boost software licen[cs]e
3 zlib|zlib|zlib (?:libpng )?licen[cs]e
3 libpng|libpng|libpng licen[cs]e
3 openssl|openssl|openssl licen[cs]e
3 ssleay|ssleay|ssleay licen[cs]e
3 curl|curl|curl licen[cs]e
3 python-2.0|python software|python software foundation licen[cs]e(?: version 2)?
3 psf-2.0|psf|psf licen[cs]e(?: agreement)?(?: version 2)?
3 php-3.01|php|php licen[cs]e(?: version)? 3 01
3 php-3.0|php|php licen[cs]e
3 ruby|ruby|ruby licen[cs]e
3 postgresql|postgresql|postgresql licen[cs]e
3 unicode|unicode|unicode (?:data files and software )?licen[cs]e(?: agreement)?
3 icu|icu|icu licen[cs]e
3 w3c|w3c|w3c software (?:notice and )?licen[cs]e
3 ofl-1.1|open font|(?:sil )?open font licen[cs]e(?: version)?(?: 1 1)?
3 ofl-1.1|ofl|ofl 1 1
3 odbl-1.0|open database|open database licen[cs]e(?: odbl)?(?: v?1 0)?
3 odbl-1.0|odbl|odbl(?: v?1 0)?
3 odc-by-1.0|open data commons|open data commons attribution licen[cs]e
3 pddl-1.0|public domain dedication|public domain dedication and licen[cs]e
3 cdla-permissive|community data license|community data license agreement permissive
3 cdla-sharing|community data license|community data license agreement sharing
3 ogl-uk-3.0|open government|open government licen[cs]e(?: v(?:ersion)? ?3(?: 0)?)?
3 etalab-2.0|licence ouverte|licence ouverte(?: open licen[cs]e)?(?: 2 0)?
3 ms-pl|microsoft public|microsoft public licen[cs]e
3 ms-rl|microsoft reciprocal|microsoft reciprocal licen[cs]e
3 ms-pl|ms pl|ms pl
3 ncsa|ncsa|(?:university of illinois )?ncsa open source licen[cs]e
3 upl-1.0|universal permissive|universal permissive licen[cs]e(?: v(?:ersion)? 1 0)?
3 afl-3.0|academic free|academic free licen[cs]e(?: v(?:ersion)?)?(?: 3 0)?
3 osl-3.0|open software|open software licen[cs]e(?: v(?:ersion)?)?(?: 3 0)?
3 cecill-2.1|cecill|cecill(?: licen[cs]e)?(?: version)?(?: 2 [01])?
3 cecill-b|cecill b|cecill b
3 cecill-c|cecill c|cecill c
3 lppl-1.3c|latex project|latex project public licen[cs]e(?: version)?(?: 1 3c?)?
3 qpl-1.0|q public|q public licen[cs]e(?: version 1 0)?
3 sleepycat|sleepycat|sleepycat licen[cs]e
3 vim|vim|vim licen[cs]e
3 beerware|beer ware|beer ware licen[cs]e
3 jsr|software shall be used|the software shall be used for good not evil
3 sspl-1.0|server side|server side public licen[cs]e(?: version 1)?
3 elastic-2.0|elastic|elastic licen[cs]e(?: v(?:ersion)? ?)?(?:2(?: 0)?)?
3 busl-1.1|business source|business source licen[cs]e(?: 1 1)?
3 commons-clause|commons clause|commons clause(?: licen[cs]e condition)?
3 polyform|polyform|polyform (?:noncommercial|small business|shield|strict) licen[cs]e(?: 1 0 0)?
3 llama|llama|llama [23](?: [0-9])? community licen[cs]e(?: agreement)?
3 openrail|openrail|(?:creativeml |bigscience )?openrail(?: [ms])?(?: licen[cs]e)?
3 openrail|open rail|(?:creativeml |bigscience )?open rail(?: [ms])?(?: licen[cs]e)?
3 rail|responsible ai|responsible ai licen[cs]e
3 proprietary|proprietary|proprietary and confidential
2 proprietary|proprietary|proprietary (?:software )?licen[cs]e
2 proprietary|contains confidential|contains confidential (?:information|and trade secrets)
2 proprietary|contains proprietary|contains proprietary (?:information|and trade secrets)
2 proprietary|reproduc|no part of this (?:publication|book|document|work) may be reproduced
2 proprietary|unauthorized|unauthorized (?:copying|reproduction|use) (?:of this file )?(?:is )?(?:strictly )?prohibited
2 proprietary|unauthorised|unauthorised (?:copying|reproduction|use) (?:of this file )?(?:is )?(?:strictly )?prohibited
2 proprietary|end user|end user licen[cs]e agreement
2 proprietary|eula|eula
2 proprietary|evaluation|for evaluation purposes only
2 proprietary|personal use|for personal use only
2 non-commercial|commercial use|non commercial use only
2 non-commercial|noncommercial use|noncommercial use only
2 non-commercial|commercial purposes|(?:not )?for (?:non )?commercial purposes(?: only)?
2 non-commercial|noncommercial purposes|(?:not )?for noncommercial purposes(?: only)?
2 non-commercial|commercial use|commercial use (?:is )?(?:prohibited|not permitted|not allowed)
2 research-only|research purposes|for research purposes only
2 no-ai-training|may not be used|may not be used (?:to train|for training)(?: of)?(?: machine learning| ai| language)? models?
2 no-ai-training|text and data mining|text and data mining (?:is )?(?:reserved|prohibited)
3 public-domain|public domain|(?:is |are )?(?:released|dedicated|placed) (?:in|in ?to) the public domain
2 public-domain|public domain|(?:this work is )?in the public domain
1 public-domain|public domain|public domain
3 us-government|government|work of the (?:u s|united states) (?:federal )?government
3 crown-copyright|crown|crown copyright
2 copyright|copyright|copyright c (?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?
2 copyright|copyright|copyright (?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?
2 copyright|copyright|copyrighted (?:material|work|content)
2 copyright|droits|tous droits reserves
2 copyright|réservés|tous droits réservés
2 copyright|vorbehalten|alle rechte vorbehalten
2 copyright|reservados|(?:todos los|todos os) (?:derechos|direitos) reservados
2 copyright|riservati|tutti i diritti riservati
1 copyright|copyright|copyright
3 dual|dual licensed|dual licensed(?: under)?
2 license-file|see license|see license(?: file| txt| md)?(?: in the project root)? for (?:details|license information|more information)
2 license-file|see the license|see the license(?: file| txt| md)?(?: in the project root)? for (?:details|license information|more information)
2 license-file|see licence|see licence(?: file| txt| md)?(?: in the project root)? for (?:details|license information|more information)
2 license-file|see the licence|see the licence(?: file| txt| md)?(?: in the project root)? for (?:details|license information|more information)
2 license-file|license file|(?:full )?license (?:text )?can be found in the license file
2 license-reference|spdx|spdx license identifier [a-z0-9]+
1 license-reference|license|licensed under
1 license-reference|licence|licenced under
1 license-reference|released under|released under the(?: terms of the)?
1 license-reference|license|terms of (?:the|this) license
1 disclaimer|warrant|without warrant(?:y|ies)(?: of any kind)?
1 disclaimer|in no event|in no event shall the (?:authors?|copyright holders?)
"""

#: (label, phrase): always reported, whatever the rules above say.
BASE = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]

#: How sure a detection of a priority is.
CONFIDENCE = {5: 0.98, 4: 0.9, 3: 0.75, 2: 0.5, 1: 0.25}


def rules() -> list[tuple[int, str, str, str, bool]]:
    """(priority, label, keyword, pattern, base) in order."""
    out = [(5, label, phrase, phrase, True) for label, phrase in BASE]
    for line in RULES_TEXT.strip().splitlines():
        head, keyword, pattern = line.split("|", 2)
        priority, label = head.split(" ", 1)
        out.append((int(priority), label, keyword, pattern, False))
    return out
