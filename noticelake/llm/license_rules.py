"""Hand-written signatures of licenses, in order of preference within a kind.

A line is ``kind label | keyword | pattern``. Patterns and keywords are written for
normalised text: lower-case words of letters and digits, single spaces between, so
``CC BY-NC 4.0`` reads ``cc by nc 4 0``. A pattern matches whole words. A rule is
tried only on texts that hold its keyword.

Kinds, best first: S an SPDX tag, T words of the license text itself, N a notice that
grants it, U its address, A its name, G a general remark.
"""

# Kinds with their priority (0 is best) and how sure a detection is.
KINDS = {"S": (0, 1.0), "T": (1, 0.95), "N": (2, 0.9), "U": (3, 0.85), "A": (4, 0.7), "G": (5, 0.3)}

# A text without any of these, and without the word "cc", is not scanned.
ROOTS = ("licen", "copyright", "copyleft", "gpl", "bsd", "spdx", "commons", "public domain", "permission", "redistribut", "reserved", "warrant", "wtfpl", "opensource", "zlib", "mozilla", "apache", "eclipse")

_RULES = r"""
S gpl-2.0-or-later | spdx | spdx license identifier l?gpl 2 0 or later
S gpl-2.0 | spdx | spdx license identifier gpl 2 0(?: only)?
S gpl-3.0-or-later | spdx | spdx license identifier gpl 3 0 or later
S gpl-3.0 | spdx | spdx license identifier gpl 3 0(?: only)?
S lgpl-2.1-or-later | spdx | spdx license identifier lgpl 2 1 or later
S lgpl-2.1 | spdx | spdx license identifier lgpl 2 1(?: only)?
S lgpl-3.0-or-later | spdx | spdx license identifier lgpl 3 0 or later
S lgpl-3.0 | spdx | spdx license identifier lgpl 3 0(?: only)?
S agpl-3.0-or-later | spdx | spdx license identifier agpl 3 0 or later
S agpl-3.0 | spdx | spdx license identifier agpl 3 0(?: only)?
S apache-2.0-with-llvm | spdx | spdx license identifier apache 2 0 with llvm exception
S apache-2.0 | spdx | spdx license identifier apache 2 0
S mit-0 | spdx | spdx license identifier mit 0
S mit | spdx | spdx license identifier mit
S bsd-2-clause | spdx | spdx license identifier bsd 2 clause
S bsd-3-clause | spdx | spdx license identifier bsd 3 clause
S 0bsd | spdx | spdx license identifier 0bsd
S isc | spdx | spdx license identifier isc
S mpl-2.0 | spdx | spdx license identifier mpl 2 0
S epl-2.0 | spdx | spdx license identifier epl 2 0
S epl-1.0 | spdx | spdx license identifier epl 1 0
S cddl-1.0 | spdx | spdx license identifier cddl 1 0
S eupl-1.2 | spdx | spdx license identifier eupl 1 2
S cc0-1.0 | spdx | spdx license identifier cc0 1 0
S cc-by-4.0 | spdx | spdx license identifier cc by 4 0
S cc-by-sa-4.0 | spdx | spdx license identifier cc by sa 4 0
S cc-by-nc-4.0 | spdx | spdx license identifier cc by nc 4 0
S unlicense | spdx | spdx license identifier unlicense
S bsl-1.0 | spdx | spdx license identifier bsl 1 0
S zlib | spdx | spdx license identifier zlib
S wtfpl | spdx | spdx license identifier wtfpl
S spdx-other | spdx | spdx license identifier [a-z0-9]+(?: [0-9]){0,2}

T mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
T mit | the software is provided as is without warranty | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind
T mit | this permission notice shall be included | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
T x11 | permission is hereby granted | except as contained in this notice the name of [a-z0-9 ]{2,80} shall not be used in advertising or otherwise to promote the sale
T hpnd | permission to use copy modify | permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted
T isc | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
T 0bsd | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
T bsd-4-clause | redistribution and use | all advertising materials mentioning features or use of this software must display the following acknowledgement
T bsd-3-clause | redistribut | neither the names? of [a-z0-9 ]{2,80} nor the names of (?:its|their) contributors may be used to endorse or promote products
T bsd-2-clause | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
T bsd | redistribut | redistributions in binary form must reproduce the above copyright notice this list of conditions
T bsd | redistribut | redistributions of source code must retain the above copyright notice this list of conditions
T bsd-3-clause-clear | patent licen | no express or implied licenses to any party s patent rights are granted by this license
T apache-2.0 | apache license | apache license version 2 0 january 2004 https? www apache org licenses
T apache-2.0 | copyright license | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
T apache-2.0 | under the license | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
T apache-1.1 | apache | the end user documentation included with the redistribution if any must include the following acknowledge?ment
T gpl-3.0 | gnu general public license | gnu general public license version 3 29 june 2007
T gpl-2.0 | gnu general public license | gnu general public license version 2 june 1991
T gpl-1.0 | gnu general public license | gnu general public license version 1 february 1989
T lgpl-3.0 | lesser general public license | gnu lesser general public license version 3 29 june 2007
T lgpl-2.1 | lesser general public license | gnu lesser general public license version 2 1 february 1999
T lgpl-2.0 | library general public license | gnu library general public license version 2 june 1991
T agpl-3.0 | affero general public license | gnu affero general public license version 3 19 november 2007
T gfdl-1.3 | free documentation license | gnu free documentation license version 1 3 3 november 2008
T gfdl-1.2 | free documentation license | gnu free documentation license version 1 2 november 2002
T gpl | public license | the licenses for most software (?:and other practical works )?are designed to take away your freedom to share and change
T gpl-3.0-exception | gpl | as a special exception [a-z0-9 ]{0,60}gpl version 3
T gpl-classpath | permission | as a special exception the copyright holders of this library give you permission to link this library with independent modules
T mpl-2.0 | mozilla public license | mozilla public license version 2 0 1 definitions
T mpl-2.0 | copyright licen | source code form is subject to the terms of the mozilla public license
T epl-1.0 | public license | the accompanying program is provided under the terms of this eclipse public license
T cddl-1.0 | distribution license | common development and distribution license cddl version 1 0
T cpl-1.0 | common public license | the accompanying program is provided under the terms of this common public license
T artistic-2.0 | verbatim copies of this license | everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed
T unlicense | public domain | this is free and unencumbered software released into the public domain
T unlicense | public domain | anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary
T zlib | warrant | this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages
T zlib | permission is granted | permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely
T bsl-1.0 | permission is hereby granted | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
T wtfpl | public license | do what the fuck you want to public license
T wtfpl | wtfpl | you just do what the fuck you want to
T beerware | beer ware license | the beer ware license
T json | good not evil | the software shall be used for good not evil
T openssl | redistribut | this product includes software developed by the openssl project for use in the openssl toolkit
T php-3.01 | redistribut | this product includes php software freely available from
T python-2.0 | python software foundation license | python software foundation license version 2
T ofl-1.1 | open font license | sil open font license version 1 1 26 february 2007
T ncsa | permission is hereby granted | to deal with the software without restriction including without limitation the rights to use
T cc0-1.0 | commons | creative commons legal code cc0 1 0 universal
T cc-by-4.0 | commons | creative commons attribution 4 0 international public license
T cc-by-sa-4.0 | commons | creative commons attribution sharealike 4 0 international public license
T cc-by-nc-4.0 | commons | creative commons attribution noncommercial 4 0 international public license
T cc-by-nc-sa-4.0 | commons | creative commons attribution noncommercial sharealike 4 0 international public license
T cc-by-nd-4.0 | commons | creative commons attribution noderivatives 4 0 international public license
T cc-by-nc-nd-4.0 | commons | creative commons attribution noncommercial noderivatives 4 0 international public license
T cc-by-3.0 | commons | the work as defined below is provided under the terms of this creative commons public license
T ms-pl | public license | microsoft public license ms pl this license governs use of the accompanying software
T ms-rl | reciprocal license | microsoft reciprocal license ms rl this license governs use of the accompanying software
T eupl-1.2 | european union public licence | european union public licence v 1 2
T eupl-1.1 | european union public licence | european union public licence v 1 1
T odbl-1.0 | open data commons | open data commons open database license
T elastic-2.0 | managed service | you may not provide the software to third parties as a hosted or managed service
T busl-1.1 | licensor hereby grants | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use
T sspl-1.0 | server side public license | server side public license version 1 october 16 2018
T openrail | responsible ai | responsible ai licen[cs]e

N gpl-3.0-or-later | general public license | (?:gnu )?general public license as published by the free software foundation either version 3 of the license or at your option any later version
N gpl-2.0-or-later | general public license | (?:gnu )?general public license as published by the free software foundation either version 2 of the license or at your option any later version
N lgpl-2.1-or-later | lesser general public license | (?:gnu )?lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
N lgpl-3.0-or-later | lesser general public license | (?:gnu )?lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
N agpl-3.0-or-later | affero general public license | (?:gnu )?affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
N gpl-3.0-or-later | gpl | (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?(?:gnu )?gpl ?v?3(?: 0)? (?:or later|or any later version|or newer)
N gpl-2.0-or-later | gpl | (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?(?:gnu )?gpl ?v?2(?: 0)? (?:or later|or any later version|or newer)
N gpl-3.0 | general public license | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?gnu general public license (?:gpl )?(?:version |v ?)3(?: 0)?
N gpl-2.0 | general public license | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?gnu general public license (?:gpl )?(?:version |v ?)2(?: 0)?
N lgpl-3.0 | lesser general public license | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?gnu lesser general public license (?:lgpl )?(?:version |v ?)3(?: 0)?
N lgpl-2.1 | lesser general public license | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?gnu lesser general public license (?:lgpl )?(?:version |v ?)2 1
N agpl-3.0 | affero general public license | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?gnu affero general public license (?:agpl )?(?:version |v ?)3(?: 0)?
N gpl | general public license | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?(?:gnu )?general public license
N gpl-3.0 | gpl | (?:licensed|released|distributed|available|published) under (?:the )?(?:gnu )?gpl ?v?3(?: 0)?
N gpl-2.0 | gpl | (?:licensed|released|distributed|available|published) under (?:the )?(?:gnu )?gpl ?v?2(?: 0)?
N gpl | gpl | (?:licensed|released|distributed|available|published) under (?:the )?(?:gnu )?gpl
N lgpl | lgpl | (?:licensed|released|distributed|available|published) under (?:the )?(?:gnu )?lgpl
N agpl | agpl | (?:licensed|released|distributed|available|published) under (?:the )?(?:gnu )?agpl
N mit | mit license | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?mit license
N mit | mit licence | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?mit licence
N mit |  mit | (?:licensed under|license is|licence is) (?:the )?mit
N mit | mit licensed | mit licensed
N apache-2.0 | apache | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?apache licen[cs]e (?:version |v ?)?2(?: 0)?
N apache-1.1 | apache | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?apache (?:software )?licen[cs]e (?:version |v ?)?1 1
N apache | apache | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?apache (?:software )?licen[cs]e
N apache-2.0 | apache | (?:licensed|released|distributed|available|published) under (?:the )?apache 2(?: 0)?
N bsd-3-clause | bsd | (?:licensed|released|distributed|available|published) under (?:the |a )?(?:3 clause|three clause|new|revised|modified) bsd(?: licen[cs]e)?
N bsd-2-clause | bsd | (?:licensed|released|distributed|available|published) under (?:the |a )?(?:2 clause|two clause|simplified|freebsd) bsd(?: licen[cs]e)?
N bsd-3-clause | bsd | (?:licensed|released|distributed|available|published) under (?:the |a )?bsd 3 clause(?: licen[cs]e)?
N bsd-2-clause | bsd | (?:licensed|released|distributed|available|published) under (?:the |a )?bsd 2 clause(?: licen[cs]e)?
N bsd | bsd | (?:licensed|released|distributed|available|published) under (?:the |a )?bsd(?: style)?(?: licen[cs]e)?
N bsd | this source code is governed | use of this source code is governed by a bsd style license that can be found in the license file
N mit | this source code is governed | use of this source code is governed by an mit style license that can be found in the license file
N mpl-2.0 | mozilla | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?mozilla public license (?:version |v ?)?2(?: 0)?
N mpl-1.1 | mozilla | the contents of this file are subject to the mozilla public license version 1 1
N mpl | mozilla | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?mozilla public license
N epl-2.0 | public license | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?eclipse public license (?:version |v ?)?2(?: 0)?
N epl-1.0 | public license | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?eclipse public license (?:version |v ?)?1(?: 0)?
N cddl-1.0 | development and distribution license | the contents of this file are subject to the terms of (?:either the [a-z0-9 ]{0,60}or )?the common development and distribution license
N isc | isc licen | (?:licensed|released|distributed|available|published) under (?:the )?isc licen[cs]e
N unlicense | unlicense | (?:licensed|released|distributed|available|published) under (?:the )?unlicense
N wtfpl | wtfpl | (?:licensed|released|distributed|available|published) under (?:the )?wtfpl
N zlib | zlib | (?:licensed|released|distributed|available|published) under (?:the )?zlib licen[cs]e
N bsl-1.0 | boost software license | distributed under the boost software license version 1 0
N artistic | artistic licen | (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?artistic licen[cs]e
N perl | terms as perl | (?:is free software you can redistribute it and or modify it )?under the same terms as perl itself
N cc-by-nc-nd-4.0 | cc by nc nd | (?:licensed|released|distributed|available|published) under (?:a |the )?cc by nc nd 4 0
N cc-by-nc-sa-4.0 | cc by nc sa | (?:licensed|released|distributed|available|published) under (?:a |the )?cc by nc sa 4 0
N cc-by-nc-4.0 | cc by nc | (?:licensed|released|distributed|available|published) under (?:a |the )?cc by nc 4 0
N cc-by-nd-4.0 | cc by nd | (?:licensed|released|distributed|available|published) under (?:a |the )?cc by nd 4 0
N cc-by-sa-4.0 | cc by sa | (?:licensed|released|distributed|available|published) under (?:a |the )?cc by sa 4 0
N cc-by-4.0 | cc by | (?:licensed|released|distributed|available|published) under (?:a |the )?cc by 4 0
N cc-by-nc-nd-3.0 | cc by nc nd | (?:licensed|released|distributed|available|published) under (?:a |the )?cc by nc nd 3 0
N cc-by-nc-sa-3.0 | cc by nc sa | (?:licensed|released|distributed|available|published) under (?:a |the )?cc by nc sa 3 0
N cc-by-nc-3.0 | cc by nc | (?:licensed|released|distributed|available|published) under (?:a |the )?cc by nc 3 0
N cc-by-sa-3.0 | cc by sa | (?:licensed|released|distributed|available|published) under (?:a |the )?cc by sa 3 0
N cc-by-3.0 | cc by | (?:licensed|released|distributed|available|published) under (?:a |the )?cc by 3 0
N cc-by-nc-sa | commons | (?:licensed|released|distributed|available|published) under (?:a |the )?creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
N cc-by-nc-nd | commons | (?:licensed|released|distributed|available|published) under (?:a |the )?creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
N cc-by-nc | commons | (?:licensed|released|distributed|available|published) under (?:a |the )?creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
N cc-by-sa | commons | (?:licensed|released|distributed|available|published) under (?:a |the )?creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
N cc-by-nd | commons | (?:licensed|released|distributed|available|published) under (?:a |the )?creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
N cc-by | commons | (?:licensed|released|distributed|available|published) under (?:a |the )?creative commons attribution(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
N cc | commons | (?:licensed|released|distributed|available|published) under (?:a |the )?creative commons licen[cs]e
N cc0-1.0 | commons | to the extent possible under law [a-z0-9 ]{2,80} waived all copyright and related or neighboring rights
N public-domain | public domain | (?:released|dedicated|placed|put) (?:in|in ?to|to) the public domain
N public-domain | public domain | (?:this|the) (?:work|file|code|software|text|document|book|image) is in the public domain
N proprietary | reserved | copyright(?: c)?(?: [0-9]{4}){0,2} [a-z0-9 ]{2,60} all rights reserved
N proprietary | permission | no part of this (?:publication|work|book|document) may be reproduced
N proprietary | permission | may not be (?:copied|reproduced|distributed|republished)(?: [a-z]+){0,6} without (?:the )?(?:prior |express |written ){0,3}permission
N proprietary | this software is | this software is (?:licensed not sold|proprietary and confidential)
N ogl-uk-3.0 | open government | (?:licensed|available|published|contains public sector information licensed) under the open government licen[cs]e(?: v3 0| v2 0| v1 0)?
N odbl-1.0 | database licen | (?:licensed|made available|available) under the open (?:data commons open )?database licen[cs]e
N gfdl | free documentation license | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
N dual-mit-apache | apache | (?:dual )?licensed under (?:either )?(?:of )?(?:the )?mit (?:license )?(?:or|and) apache(?: license)?(?: version)?(?: 2 0)?
N dual-mit-apache | apache | licensed under (?:either )?(?:of )?(?:the )?apache (?:license )?(?:version )?(?:2 0 )?(?:or|and) mit
N dual-mit-gpl | gpl | dual licensed under the mit (?:and|or) gpl(?: licenses)?
N busl-1.1 | business source license | (?:licensed|released|available) under the business source license(?: 1 1)?
N elastic-2.0 | elastic license | (?:licensed|released|available) under the elastic license(?: 2 0| v2)?
N sspl-1.0 | server side public license | (?:licensed|released|available) under the server side public license
N ofl-1.1 | open font license | (?:this font software is )?licensed under the sil open font license version 1 1
N eupl-1.2 | eupl | licensed under the eupl(?: version)? 1 2
N llama | community license | (?:licensed|available) under the llama [0-9](?: [0-9])? community license
N same-as | under the same terms | licensed under the same terms as [a-z0-9]+

U mit | opensource org | opensource org licenses? mit(?: license)?
U apache-2.0 | opensource org | opensource org licenses? apache 2 0
U bsd-3-clause | opensource org | opensource org licenses? bsd 3 clause
U bsd-2-clause | opensource org | opensource org licenses? bsd 2 clause
U bsd | opensource org | opensource org licenses? bsd license
U gpl-3.0 | opensource org | opensource org licenses? gpl 3 0
U gpl-2.0 | opensource org | opensource org licenses? gpl 2 0
U lgpl-3.0 | opensource org | opensource org licenses? lgpl 3 0
U mpl-2.0 | opensource org | opensource org licenses? mpl 2 0
U isc | opensource org | opensource org licenses? isc(?: license)?
U artistic-2.0 | opensource org | opensource org licenses? artistic license 2 0
U osl-3.0 | opensource org | opensource org licenses? osl 3 0
U afl-3.0 | opensource org | opensource org licenses? afl 3 0
U zlib | opensource org | opensource org licenses? zlib(?: license)?
U ms-pl | opensource org | opensource org licenses? ms pl
U apache-2.0 | apache | apache org licenses license 2 0(?: txt| html)?
U apache-1.1 | apache | apache org licenses license 1 1
U gpl-3.0 | gnu org | gnu org licenses gpl 3 0(?: txt| html| en html)?
U gpl-2.0 | gnu org | gnu org licenses (?:old licenses )?gpl 2 0(?: txt| html| en html)?
U gpl | gnu org | gnu org licenses(?: gpl(?: html| txt)?)?
U lgpl-3.0 | gnu org | gnu org licenses lgpl 3 0(?: txt| html)?
U lgpl-2.1 | gnu org | gnu org licenses (?:old licenses )?lgpl 2 1(?: txt| html)?
U agpl-3.0 | gnu org | gnu org licenses agpl 3 0(?: txt| html)?
U gfdl-1.3 | gnu org | gnu org licenses fdl 1 3(?: txt| html)?
U gpl | copyleft | gnu org copyleft gpl html
U mpl-2.0 | mozilla | mozilla org (?:en us )?mpl 2 0
U mpl-1.1 | mozilla | mozilla org mpl mpl 1 1(?: html)?
U epl-2.0 | eclipse org legal | eclipse org legal epl (?:2 0|v20)(?: html)?
U epl-1.0 | eclipse org legal | eclipse org legal epl v10(?: html)?
U cc-by-4.0 | commons | creativecommons org licenses by 4 0
U cc-by-sa-4.0 | commons | creativecommons org licenses by sa 4 0
U cc-by-nc-4.0 | commons | creativecommons org licenses by nc 4 0
U cc-by-nd-4.0 | commons | creativecommons org licenses by nd 4 0
U cc-by-nc-sa-4.0 | commons | creativecommons org licenses by nc sa 4 0
U cc-by-nc-nd-4.0 | commons | creativecommons org licenses by nc nd 4 0
U cc-by-3.0 | commons | creativecommons org licenses by 3 0
U cc-by-sa-3.0 | commons | creativecommons org licenses by sa 3 0
U cc-by-nc-3.0 | commons | creativecommons org licenses by nc 3 0
U cc-by-nd-3.0 | commons | creativecommons org licenses by nd 3 0
U cc-by-nc-sa-3.0 | commons | creativecommons org licenses by nc sa 3 0
U cc-by-nc-nd-3.0 | commons | creativecommons org licenses by nc nd 3 0
U cc-by-2.0 | commons | creativecommons org licenses by 2 [05]
U cc-by-sa-2.0 | commons | creativecommons org licenses by sa 2 [05]
U cc0-1.0 | commons | creativecommons org publicdomain zero 1 0
U public-domain | commons | creativecommons org publicdomain mark 1 0
U unlicense | unlicense | unlicense org
U bsl-1.0 | boost org | boost org license 1 0 txt
U wtfpl | wtfpl | (?:www )?wtfpl net
U ogl-uk-3.0 | nationalarchives | nationalarchives gov uk doc open government licence version 3
U odbl-1.0 | commons | opendatacommons org licenses odbl(?: 1 0)?
U ofl-1.1 | scripts sil org | scripts sil org ofl
U busl-1.1 | mariadb com | mariadb com bsl11

A gpl-3.0 | general public license | gnu general public license (?:gpl )?(?:version |v ?)3(?: 0)?
A gpl-2.0 | general public license | gnu general public license (?:gpl )?(?:version |v ?)2(?: 0)?
A lgpl-3.0 | lesser general public license | gnu lesser general public license (?:lgpl )?(?:version |v ?)3(?: 0)?
A lgpl-2.1 | lesser general public license | gnu lesser general public license (?:lgpl )?(?:version |v ?)2 1
A lgpl-2.0 | library general public license | gnu library general public license(?: (?:version |v ?)2(?: 0)?)?
A agpl-3.0 | affero general public license | gnu affero general public license (?:agpl )?(?:version |v ?)3(?: 0)?
A gpl | general public license | (?:gnu )?general public license
A lgpl | lesser general public license | (?:gnu )?lesser general public license
A agpl | affero general public license | (?:gnu )?affero general public license
A gfdl | free documentation license | gnu free documentation license(?: version 1 [1-3])?
A gpl-3.0-or-later | gpl | gpl ?v?3(?: 0)? or later
A gpl-2.0-or-later | gpl | gpl ?v?2(?: 0)? or later
A gpl-3.0 | gpl | (?:gnu )?gpl ?v?3(?: 0)?(?: only)?
A gpl-2.0 | gpl | (?:gnu )?gpl ?v?2(?: 0)?(?: only)?
A lgpl-3.0 | lgpl | (?:gnu )?lgpl ?v?3(?: 0)?
A lgpl-2.1 | lgpl | (?:gnu )?lgpl ?v?2 1
A agpl-3.0 | agpl | (?:gnu )?agpl ?v?3(?: 0)?
A gpl | gpl | (?:gnu gpl|gpl licen[cs]ed?)
A lgpl | lgpl | (?:gnu lgpl|lgpl licen[cs]ed?)
A apache-2.0 | apache | apache (?:software )?licen[cs]e (?:version |v ?)?2(?: 0)?
A apache-2.0 | apache | apache 2(?: 0)? licen[cs]e
A apache-1.1 | apache | apache (?:software )?licen[cs]e (?:version |v ?)?1 1
A apache-1.0 | apache | apache (?:software )?licen[cs]e (?:version |v ?)?1 0
A apache | apache | apache (?:software )?licen[cs]e
A mit | mit licen | (?:the )?mit licen[cs]e(?: mit)?
A mit-0 | mit no attribution | mit no attribution(?: license)?
A x11 | x11 licen | x11 licen[cs]e
A expat | expat licen | expat licen[cs]e
A bsd-4-clause | bsd | (?:4 clause bsd|bsd 4 clause|original bsd|old bsd)(?: licen[cs]e)?
A bsd-3-clause | bsd | (?:3 clause bsd|bsd 3 clause|new bsd|revised bsd|modified bsd)(?: licen[cs]e)?
A bsd-2-clause | bsd | (?:2 clause bsd|bsd 2 clause|simplified bsd|freebsd)(?: licen[cs]e)
A 0bsd | bsd | (?:zero clause bsd|0bsd)(?: licen[cs]e)?
A bsd | bsd licen | bsd (?:style )?licen[cs]e
A isc | isc licen | isc licen[cs]e
A mpl-2.0 | mozilla public licen | mozilla public licen[cs]e (?:version |v ?)?2(?: 0)?
A mpl-1.1 | mozilla public licen | mozilla public licen[cs]e (?:version |v ?)?1 1
A mpl | mozilla public licen | mozilla public licen[cs]e
A epl-2.0 | public license | eclipse public license (?:version |v ?)?2(?: 0)?
A epl-1.0 | public license | eclipse public license (?:version |v ?)?1(?: 0)?
A epl | public license | eclipse public license
A edl-1.0 | distribution license | eclipse distribution license(?: v 1 0)?
A cddl-1.0 | distribution license | common development and distribution license(?: (?:version )?1 0)?
A cpl-1.0 | public license | common public license(?: (?:version )?1 0)?
A ipl-1.0 | public license | ibm public license(?: (?:version )?1 0)?
A apsl-2.0 | source license | apple public source license(?: (?:version )?2 0)?
A npl | public license | netscape public license
A qpl-1.0 | public license | q public license(?: (?:version )?1 0)?
A lppl-1.3c | public license | latex project public license(?: (?:version )?1 3c?)?
A osl-3.0 | software license | open software license(?: (?:version |v )?3 0)?
A afl-3.0 | free license | academic free license(?: (?:version |v )?3 0)?
A artistic-2.0 | artistic licen | artistic licen[cs]e (?:version )?2 0
A artistic-1.0 | artistic licen | artistic licen[cs]e(?: (?:version )?1 0)?
A bsl-1.0 | boost software license | boost software license(?: (?:version )?1 0)?
A zlib | zlib | zlib (?:libpng )?licen[cs]e
A libpng | libpng licen | libpng licen[cs]e
A openssl | openssl licen | openssl licen[cs]e
A php-3.01 | php licen | php licen[cs]e(?: (?:version )?3 01?)?
A python-2.0 | psf licen | psf licen[cs]e
A python-2.0 | software foundation licen | python software foundation licen[cs]e
A ruby | ruby | ruby s? ?licen[cs]e
A vim | vim licen | vim licen[cs]e
A w3c | w3c software | w3c software (?:notice and )?licen[cs]e
A ncsa | ncsa open source | (?:university of illinois )?ncsa open source licen[cs]e
A unlicense | unlicense | (?:the )?unlicense
A wtfpl | wtfpl | wtfpl
A beerware | beerware | beerware licen[cs]e
A ms-pl | public license | microsoft public license
A ms-rl | reciprocal license | microsoft reciprocal license
A eupl | european union public | european union public licen[cs]e
A cecill | cecill | cecill (?:b |c )?licen[cs]e
A ofl-1.1 | open font license | (?:sil )?open font license(?: (?:version )?1 1)?
A ogl-uk | open government | open government licen[cs]e
A odbl-1.0 | open database | open database licen[cs]e
A odc-by-1.0 | open data commons | open data commons attribution licen[cs]e
A pddl-1.0 | public domain dedication | public domain dedication and licen[cs]e
A cdla | community data | community data licen[cs]e agreement(?: permissive| sharing)?
A busl-1.1 | business source | business source licen[cs]e
A elastic-2.0 | elastic licen | elastic licen[cs]e
A sspl-1.0 | server side public | server side public licen[cs]e
A openrail | openrail | (?:creative ml |bigscience )?openrail(?: m)? licen[cs]e
A llama | llama | llama [0-9](?: [0-9])? community licen[cs]e
A cc0-1.0 | cc0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)?
A cc-by-nc-nd-4.0 | cc by nc nd | cc by nc nd 4 0
A cc-by-nc-sa-4.0 | cc by nc sa | cc by nc sa 4 0
A cc-by-nc-4.0 | cc by nc | cc by nc 4 0
A cc-by-nd-4.0 | cc by nd | cc by nd 4 0
A cc-by-sa-4.0 | cc by sa | cc by sa 4 0
A cc-by-4.0 | cc by | cc by 4 0
A cc-by-nc-nd-3.0 | cc by nc nd | cc by nc nd 3 0
A cc-by-nc-sa-3.0 | cc by nc sa | cc by nc sa 3 0
A cc-by-nc-3.0 | cc by nc | cc by nc 3 0
A cc-by-nd-3.0 | cc by nd | cc by nd 3 0
A cc-by-sa-3.0 | cc by sa | cc by sa 3 0
A cc-by-3.0 | cc by | cc by 3 0
A cc-by-2.0 | cc by | cc by 2 [05]
A cc-by-nc-nd | cc by nc nd | cc by nc nd
A cc-by-nc-sa | cc by nc sa | cc by nc sa
A cc-by-nc | cc by nc | cc by nc
A cc-by-nd | cc by nd | cc by nd
A cc-by-sa | cc by sa | cc by sa
A cc-by | cc by | cc by
A cc-by-nc-sa | commons | creative commons attribution non ?commercial share ?alike
A cc-by-nc-nd | commons | creative commons attribution non ?commercial no ?deriv(?:ative)?s?
A cc-by-nc | commons | creative commons attribution non ?commercial
A cc-by-sa | commons | creative commons attribution share ?alike
A cc-by-nd | commons | creative commons attribution no ?deriv(?:ative)?s?
A cc-by | commons | creative commons attribution
A cc | commons | creative commons licen[cs]e

G public-domain | public domain | public domain
G proprietary | reserved | all rights reserved
G copyright | copyright | copyright(?: c)? [0-9]{4}(?: [0-9]{4})?(?: by)?
G copyleft | copyleft | copyleft licen[cs]e
G open-source | open source licen | open source licen[cs]e
G permissive | permissive | permissive(?:ly)? (?:software )?licen[cs]ed?
G free-software | free software licen | free software licen[cs]e
G commercial | commercial licen | commercial licen[cs]e
G eula | end user licen | end user licen[cs]e agreement
G licensed | licensed | licensed under
G license-file | see  | see (?:the )?(?:file )?licen[cs]e(?: file)?(?: for details)?
"""


def _parsed(lines: str) -> list[dict]:
    out = []
    for line in lines.strip().splitlines():
        if line.strip():
            head, keyword, pattern = line.split(" | ", 2)
            kind, label = head.split(" ", 1)
            priority, sure = KINDS[kind]
            out.append({"at": len(out), "priority": priority, "sure": sure, "label": label, "keyword": keyword, "pattern": pattern.strip()})
    return out


#: Each rule: its place, priority, certainty, label, keyword and pattern.
RULES = _parsed(_RULES)
