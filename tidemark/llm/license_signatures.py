"""Signatures of licences and rights statements, written over words: lower case, joined by one space.

A line is a rank, a label and an expression; lines of one rank go by their order. Ranks: 1 notices and identifiers, 2 names with
a version, 3 names, 4 hints. ``BASE`` are the phrases whose every place is reported, whatever covers it.
"""

BASE = """
3 cc-by: cc by
3 gpl: general public license
4 reserved: all rights reserved
"""

SIGNATURES = """
1 apache-2.0: spdx license identifier apache 2 0
1 mit: spdx license identifier mit
1 mit-0: spdx license identifier mit 0
1 bsd-2-clause: spdx license identifier bsd 2 clause
1 bsd-3-clause: spdx license identifier bsd 3 clause
1 0bsd: spdx license identifier 0bsd
1 isc: spdx license identifier isc
1 zlib: spdx license identifier zlib
1 unlicense: spdx license identifier unlicense
1 cc0-1.0: spdx license identifier cc0 1 0
1 cc-by-4.0: spdx license identifier cc by 4 0
1 cc-by-sa-4.0: spdx license identifier cc by sa 4 0
1 gpl-2.0-only: spdx license identifier gpl 2 0(?: only)?
1 gpl-2.0-or-later: spdx license identifier gpl 2 0 or later
1 gpl-3.0-only: spdx license identifier gpl 3 0(?: only)?
1 gpl-3.0-or-later: spdx license identifier gpl 3 0 or later
1 lgpl-2.1-only: spdx license identifier lgpl 2 1(?: only)?
1 lgpl-2.1-or-later: spdx license identifier lgpl 2 1 or later
1 lgpl-3.0-only: spdx license identifier lgpl 3 0(?: only)?
1 lgpl-3.0-or-later: spdx license identifier lgpl 3 0 or later
1 agpl-3.0-only: spdx license identifier agpl 3 0(?: only)?
1 agpl-3.0-or-later: spdx license identifier agpl 3 0 or later
1 mpl-1.1: spdx license identifier mpl 1 1
1 mpl-2.0: spdx license identifier mpl 2 0
1 epl-1.0: spdx license identifier epl 1 0
1 epl-2.0: spdx license identifier epl 2 0
1 eupl-1.2: spdx license identifier eupl 1 2
1 bsl-1.0: spdx license identifier bsl 1 0
1 ofl-1.1: spdx license identifier ofl 1 1
1 artistic-2.0: spdx license identifier artistic 2 0
1 wtfpl: spdx license identifier wtfpl
1 cddl-1.0: spdx license identifier cddl 1 0
1 ms-pl: spdx license identifier ms pl
1 postgresql: spdx license identifier postgresql
1 python-2.0: spdx license identifier python 2 0
1 odbl-1.0: spdx license identifier odbl 1 0
1 spdx-other: spdx license identifier \\S+
1 mit: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
1 mit: the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
1 mit-warranty: the software is provided as is without warranty of any kind express or implied
1 mit-0: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files (?:\\S+ ){0,40}to do so the software is provided
1 x11: except as contained in this notice the name of (?:\\S+ ){1,8}shall not be used in advertising
1 isc: permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
1 0bsd: permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software
1 hpnd: permission to use copy modify and distribute this software and its documentation for any purpose
1 bsd: redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
1 bsd-2-clause: redistributions in binary form must reproduce the above copyright notice
1 bsd-3-clause: neither the names? of (?:\\S+ ){1,12}nor the names of (?:\\S+ ){1,6}may be used to endorse or promote products
1 bsd-4-clause: all advertising materials mentioning features or use of this software must display the following
1 apache-2.0: licensed under the apache license version 2 0
1 apache-2.0: you may not use this file except in compliance with the license
1 apache-2.0: unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
1 apache-2.0: you may obtain a copy of the license at(?: https?)? www apache org licenses license 2 0
1 apache-1.1: this product includes software developed by the apache software foundation
1 gpl-2.0-or-later: under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
1 gpl-3.0-or-later: under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
1 gpl-2.0-only: under the terms of the gnu general public license version 2 as published by
1 gpl-3.0-only: under the terms of the gnu general public license version 3 as published by
1 gpl: you should have received a copy of the gnu general public license along with
1 lgpl-2.1-or-later: gnu lesser general public license as published by the free software foundation either version 2 1 of the license or
1 lgpl-3.0-or-later: gnu lesser general public license as published by the free software foundation either version 3 of the license or
1 lgpl-2.0-or-later: gnu library general public license as published by the free software foundation either version 2 of the license or
1 lgpl: you should have received a copy of the gnu lesser general public license along with
1 agpl-3.0-or-later: gnu affero general public license as published by the free software foundation either version 3 of the license or
1 agpl: you should have received a copy of the gnu affero general public license along with
1 gfdl: permission is granted to copy distribute and(?: or)? modify this document under the terms of the gnu free documentation license
1 fsf-all-permissive: copying and distribution of this file with or without modification are permitted in any medium without royalty
1 mpl-1.1: the contents of this file are subject to the mozilla public license version 1 1
1 mpl-2.0: this source code form is subject to the terms of the mozilla public license v 2 0
1 mpl-2.0: this source code form is incompatible with secondary licenses
1 epl-1.0: made available under the terms of the eclipse public license v1 0
1 epl-2.0: made available under the terms of the eclipse public license(?: v)? ?2 0
1 cddl-1.0: the contents of this file are subject to the terms of the common development and distribution license
1 eupl: licensed under the eupl
1 zlib: this software is provided as is without any express or implied warranty in no event will the authors be held liable
1 zlib: altered source versions must be plainly marked as such
1 unlicense: this is free and unencumbered software released into the public domain
1 wtfpl: everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed
1 bsl-1.0: distributed under the boost software license version 1 0
1 ofl-1.1: this font software is licensed under the sil open font license version 1 1
1 artistic: you may copy and distribute verbatim copies of the source form of the standard version of this package
1 psf: psf hereby grants licensee a nonexclusive royalty free world wide license
1 openssl: this product includes software developed by the openssl project for use in the openssl toolkit
1 curl: permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
1 cc0-1.0: to the extent possible under law (?:\\S+ ){1,12}(?:has|have) waived all copyright and related or neighboring rights
1 cc-by: this work is licensed under a creative commons attribution(?: \\d)?(?: \\d)?(?: international)? license
1 cc-by-sa: this work is licensed under a creative commons attribution share ?alike(?: \\d)?(?: \\d)?(?: international)? license
1 cc-by-nc: this work is licensed under a creative commons attribution non ?commercial(?: \\d)?(?: \\d)?(?: international)? license
1 cc-by-nc-sa: this work is licensed under a creative commons attribution non ?commercial share ?alike(?: \\d)?(?: \\d)?(?: international)? license
1 cc-by-nc-nd: this work is licensed under a creative commons attribution non ?commercial no ?deriv(?:s|atives)(?: \\d)?(?: \\d)?(?: international)? license
1 cc-by-nd: this work is licensed under a creative commons attribution no ?deriv(?:s|atives)(?: \\d)?(?: \\d)?(?: international)? license
1 odbl-1.0: this (?:\\S+ ){1,6}is made available under the open database license
1 proprietary: this (?:software|document|file|material) (?:\\S+ ){0,8}(?:is|contains) (?:the )?confidential and proprietary
1 proprietary: no part of this (?:publication|book|document|work) may be reproduced
1 proprietary: may not be copied reproduced (?:\\S+ ){0,10}without (?:the )?(?:express |prior |written ){1,3}(?:permission|consent)
1 eula: by installing (?:\\S+ ){1,8}you agree to be bound by the terms of this agreement
1 gutenberg: this ebook is for the use of anyone anywhere (?:\\S+ ){0,12}at no cost and with almost no restrictions whatsoever
1 us-government: this (?:\\S+ ){1,4}was prepared by (?:\\S+ ){1,8}of the united states government
2 apache-1.0: apache (?:software )?license(?: version)? 1 0
2 apache-1.1: apache (?:software )?license(?: version)? 1 1
2 apache-2.0: apache (?:software )?license(?: version| v)? 2(?: 0)?
2 apache-2.0: apache 2(?: 0)? licensed?
2 mit-0: mit no attribution
2 bsd-1-clause: bsd 1 clause
2 bsd-2-clause: (?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd)(?: license)?
2 bsd-3-clause: (?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)(?: license)?
2 bsd-4-clause: (?:original bsd|bsd 4 clause|4 clause bsd)(?: license)?
2 0bsd: (?:zero clause bsd|bsd zero clause|0 clause bsd)
2 gpl-1.0: gnu general public license(?: version| v) 1
2 gpl-2.0-or-later: gnu general public license(?: version| v)? 2(?: 0)? or(?: any)? later
2 gpl-2.0: gnu general public license(?: version| v)? 2(?: 0)?
2 gpl-3.0-or-later: gnu general public license(?: version| v)? 3(?: 0)? or(?: any)? later
2 gpl-3.0: gnu general public license(?: version| v)? 3(?: 0)?
2 gpl-2.0: (?:gnu )?gpl ?v?2(?: 0)?
2 gpl-3.0: (?:gnu )?gpl ?v?3(?: 0)?
2 lgpl-2.0: gnu library general public license(?: version| v)? 2(?: 0)?
2 lgpl-2.1: gnu lesser general public license(?: version| v)? 2 1
2 lgpl-3.0: gnu lesser general public license(?: version| v)? 3(?: 0)?
2 lgpl-2.1: (?:gnu )?lgpl ?v?2 1
2 lgpl-3.0: (?:gnu )?lgpl ?v?3(?: 0)?
2 agpl-3.0: gnu affero general public license(?: version| v)? 3(?: 0)?
2 agpl-3.0: (?:gnu )?agpl ?v?3(?: 0)?
2 gfdl-1.1: gnu free documentation license(?: version| v)? 1 1
2 gfdl-1.2: gnu free documentation license(?: version| v)? 1 2
2 gfdl-1.3: gnu free documentation license(?: version| v)? 1 3
2 mpl-1.0: mozilla public license(?: version| v)? 1 0
2 mpl-1.1: mozilla public license(?: version| v)? 1 1
2 mpl-2.0: mozilla public license(?: version| v)? 2 0
2 mpl-2.0: mpl ?v?2(?: 0)?
2 epl-1.0: eclipse public license(?: version| v)? ?v?1 0
2 epl-2.0: eclipse public license(?: version| v)? ?v?2 0
2 edl-1.0: eclipse distribution license(?: version| v)? ?v?1 0
2 cddl-1.0: common development and distribution license(?: version| v)? 1 0
2 cddl-1.1: common development and distribution license(?: version| v)? 1 1
2 cpl-1.0: common public license(?: version| v)? 1 0
2 ipl-1.0: ibm public license(?: version| v)? 1 0
2 eupl-1.1: european union public licence(?: version| v)? ?v?1 1
2 eupl-1.2: european union public licence(?: version| v)? ?v?1 2
2 artistic-1.0: artistic license(?: version| v)? 1 0
2 artistic-2.0: artistic license(?: version| v)? 2 0
2 afl-2.1: academic free license(?: version| v)? 2 1
2 afl-3.0: academic free license(?: version| v)? 3 0
2 osl-3.0: open software license(?: version| v)? 3 0
2 bsl-1.0: boost software license(?: version| v)? 1 0
2 busl-1.1: business source license(?: version| v)? 1 1
2 ofl-1.0: open font license(?: version| v)? 1 0
2 ofl-1.1: (?:sil )?open font license(?: version| v)? 1 1
2 ms-pl: microsoft public license
2 ms-rl: microsoft reciprocal license
2 sspl-1.0: server side public license(?: version| v)? 1
2 elastic-2.0: elastic license(?: version| v)? 2(?: 0)?
2 upl-1.0: universal permissive license(?: version| v)? ?v?1 0
2 ecl-2.0: educational community license(?: version| v)? 2 0
2 lppl-1.3c: latex project public license(?: version| v)? 1 3c?
2 zpl-2.1: zope public license(?: version| v)? 2 1
2 php-3.01: php license(?: version| v)? 3 0?1
2 python-2.0: python software foundation license(?: version| v)? 2
2 unicode-dfs: unicode license agreement
2 cecill-2.1: cecill(?: version| v)? 2 1
2 cecill-b: cecill b
2 cecill-c: cecill c
2 mulan-psl-2.0: mulan (?:psl|permissive software license)(?: version| v)? ?v?2
2 w3c: w3c software (?:notice and|and document) license
2 nasa-1.3: nasa open source agreement(?: version| v)? 1 3
2 qpl-1.0: q public license(?: version| v)? 1 0
2 spl-1.0: sun public license(?: version| v)? 1 0
2 apsl-2.0: apple public source license(?: version| v)? 2 0
2 cpal-1.0: common public attribution license(?: version| v)? 1 0
2 rpl-1.5: reciprocal public license(?: version| v)? 1 5
2 odbl-1.0: open database license(?: version| v)? ?v?1 0
2 odc-by-1.0: open data commons attribution license
2 pddl-1.0: public domain dedication and license
2 ogl-3.0: open government licence(?: version| v)? ?v?3 0
2 ogl-2.0: open government licence(?: version| v)? ?v?2 0
2 dl-de-by-2.0: data ?lizenz deutschland namensnennung(?: version)? 2 0
2 etalab-2.0: licence ouverte(?: version| v)? 2 0
2 cdla-permissive: community data license agreement permissive
2 cdla-sharing: community data license agreement sharing
2 openrail: open ?rail(?: ?m| ?\\+\\+)?(?: license)?
2 bloom-rail-1.0: bigscience (?:bloom )?rail license(?: version| v)? ?v?1 0
2 llama: llama \\d(?: \\d)? community license(?: agreement)?
2 gemma: gemma terms of use
2 cc0-1.0: cc0(?: 1 0)?(?: universal)?
2 cc-by-nc-nd: cc by nc nd(?: \\d \\d)?
2 cc-by-nc-sa: cc by nc sa(?: \\d \\d)?
2 cc-by-nc: cc by nc(?: \\d \\d)?
2 cc-by-nd: cc by nd(?: \\d \\d)?
2 cc-by-sa: cc by sa(?: \\d \\d)?
2 cc-by-2.0: cc by 2 0
2 cc-by-3.0: cc by 3 0
2 cc-by-4.0: cc by 4 0
2 cc-by-nc-nd: creative commons attribution non ?commercial no ?deriv(?:s|atives)
2 cc-by-nc-sa: creative commons attribution non ?commercial share ?alike
2 cc-by-nc: creative commons attribution non ?commercial
2 cc-by-nd: creative commons attribution no ?deriv(?:s|atives)
2 cc-by-sa: creative commons attribution share ?alike
2 cc-by: creative commons (?:attribution|by)(?: \\d \\d)?
2 cc-by-sa-de: creative commons namensnennung weitergabe unter gleichen bedingungen
2 cc-by-nc-de: creative commons namensnennung nicht kommerziell
2 cc-by-de: creative commons namensnennung
2 cc-by-fr: creative commons (?:paternité|attribution) (?:\\S+ ){0,4}france
2 cc-by-es: creative commons (?:reconocimiento|atribución)(?: \\d \\d)?
3 apache: apache (?:software )?license
3 mit: (?:released|licensed|distributed|available|provided|published)(?: \\S+){0,3} under the(?: terms of the)? mit license
3 mit: mit licensed?
3 mit: expat license
3 bsd: bsd(?: style)? licensed?
3 isc: isc licensed?
3 zlib: zlib(?: libpng)? license
3 unlicense: the unlicense
3 wtfpl: (?:wtfpl|do what the fuck you want to public license)
3 beerware: (?:the )?beer ?ware license
3 gpl: (?:gnu )?gpl(?: licensed?)?
3 lgpl: gnu (?:lesser|library) general public license
3 lgpl: (?:gnu )?lgpl(?: licensed?)?
3 agpl: (?:gnu )?affero general public license
3 agpl: (?:gnu )?agpl(?: licensed?)?
3 gfdl: gnu free documentation license
3 mpl: mozilla public license
3 epl: eclipse public license
3 cddl: common development and distribution license
3 artistic: artistic license
3 bsl: boost software license
3 busl: business source license
3 ofl: open font license
3 sspl: server side public license
3 elastic: elastic license
3 commons-clause: commons clause(?: license)?(?: condition)?
3 polyform: polyform (?:noncommercial|small business|shield|strict|perimeter)(?: license)?
3 psf: python software foundation license
3 ruby: ruby license
3 perl: same terms as perl(?: itself)?
3 openssl: openssl license
3 ijg: independent jpeg group
3 icu: icu license
3 ncsa: university of illinois ncsa open source license
3 odbl: open database license
3 ogl: open government licen[cs]e
3 creative-commons: creative commons(?: license| lizenz| licence)?
3 rail: responsible ai licen[cs]es?
3 eula: end user licen[cs]e agreement
3 public-domain: (?:in|into) the public domain
3 public-domain: public domain (?:dedication|mark|work)
3 public-domain: gemeinfrei
3 public-domain: domaine public
3 public-domain: dominio público
3 fair-use: fair (?:use|dealing) (?:under|pursuant|notice|of copyrighted)
3 gpl: licence publique générale gnu
3 gpl: gnu allgemeine öffentliche lizenz
3 gpl: licencia pública general de gnu
4 copyright: copyright (?:c )?(?:19|20)\\d\\d
4 copyright: copyright (?:by|held by|owned by)
4 copyright: c (?:19|20)\\d\\d(?: \\S+){1,4} inc
4 copyright: © (?:19|20)\\d\\d
4 reserved: rights reserved
4 reserved: alle rechte vorbehalten
4 reserved: tous droits réservés
4 reserved: todos los derechos reservados
4 reserved: tutti i diritti riservati
4 no-warranty: without any warranty
4 no-warranty: without warranties or conditions of any kind
4 no-warranty: merchantability or fitness for a particular purpose
4 trademark: (?:registered )?trademarks? of
4 non-commercial: for non ?commercial (?:use|purposes) only
4 non-commercial: not for commercial (?:use|purposes)
4 non-commercial: nur für (?:den )?(?:nicht ?kommerziellen|privaten) gebrauch
4 no-derivatives: no derivative works
4 attribution: attribution (?:is )?required
4 attribution: reprinted (?:with|by) permission
4 attribution: used (?:with|by) permission
4 royalty-free: royalty free
4 open-source: open source licen[cs]ed?
4 proprietary: proprietary licen[cs]e
4 proprietary: unauthorized (?:copying|use|reproduction|distribution)
4 proprietary: do not (?:copy|distribute|redistribute|reproduce)
4 dual: dual licensed
4 license-text: see (?:the )?(?:accompanying )?licen[cs]e(?: file| txt| md)? for (?:more )?(?:details|information|terms)
4 license-text: licensed under(?: the| a)?(?: terms of)?
"""
