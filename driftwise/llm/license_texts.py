"""Wordings of public licenses and of the notices that name them.

(license, wording). Names and years of holders are left out. Licenses of several pages stand here
with their opening passage and their file header, not with all their sections.
"""

_COMMON = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Distributed under the MIT License."),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution."""),
    ("BSD", "Released under the BSD License."),
    ("BSD", "Licensed under the BSD License."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for
more details."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL", "licensed under the GNU Lesser General Public License"),
    ("AGPL", "licensed under the GNU Affero General Public License"),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
for any purpose, commercial or non-commercial, and by any means."""),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)

_FSF = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
_SHARE = "The licenses for most software are designed to take away your freedom to share and change it."
_SHARE_3 = """The licenses for most software and other practical works are designed to take away your freedom to share and
change the works."""
_BSD = _COMMON[5][1].rstrip(".")
_BSD_ENDORSE = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _gnu_header(kind: str, version: str, thing: str = "program") -> str:
    return f"""This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}
Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option)
any later version. This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for more
details."""


_MORE = (
    ("BSD-2-Clause", f"{_BSD}. {_BSD_AS_IS}"),
    ("BSD-3-Clause", f"{_BSD}. {_BSD_ENDORSE} {_BSD_AS_IS}"),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but
is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software. 3. This notice may not be removed or altered from any source distribution."""),
    ("BSL-1.0", """Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge, to
any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the
"Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works
of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works
of the Software, unless such copies or derivative works are solely in the form of machine-executable object code
generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND
NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR
OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("BSL-1.0", """Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy
at http://www.boost.org/LICENSE_1_0.txt)"""),
    ("EPL-2.0", """THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE ("AGREEMENT"). ANY USE,
REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT."""),
    ("EPL-2.0", """This program and the accompanying materials are made available under the terms of the Eclipse Public
License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"""),
    ("EPL-1.0", """All rights reserved. This program and the accompanying materials are made available under the terms of the
Eclipse Public License v1.0 which accompanies this distribution, and is available at
http://www.eclipse.org/legal/epl-v10.html"""),
    ("Apache-2.0", """TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. "License" shall mean the
terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.
"Licensor" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License. "Legal
Entity" shall mean the union of the acting entity and all other entities that control, are controlled by, or are under
common control with that entity."""),
    ("GPL-2.0", f"""GNU GENERAL PUBLIC LICENSE Version 2, June 1991 {_FSF} Preamble {_SHARE} By contrast, the GNU General Public
License is intended to guarantee your freedom to share and change free software--to make sure the software is free for all
its users."""),
    ("GPL-3.0", f"""GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 {_FSF} Preamble The GNU General Public License is a free,
copyleft license for software and other kinds of works. {_SHARE_3} By contrast, the GNU General Public License is intended
to guarantee your freedom to share and change all versions of a program--to make sure it remains free software for all its
users."""),
    ("AGPL-3.0", f"""GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 {_FSF} Preamble The GNU Affero General Public
License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation
with the community in the case of network server software. {_SHARE_3} By contrast, our General Public Licenses are intended
to guarantee your freedom to share and change all versions of a program--to make sure it remains free software for all its
users."""),
    ("LGPL-2.1", f"""GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 {_FSF} This is the first released version of
the Lesser GPL. It also counts as the successor of the GNU Library Public License, version 2, hence the version number 2.1.
Preamble {_SHARE} By contrast, the GNU General Public Licenses are intended to guarantee your freedom to share and change
free software--to make sure the software is free for all its users."""),
    ("LGPL-3.0", f"""GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 {_FSF} This version of the GNU Lesser General
Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the
additional permissions listed below."""),
    ("MPL-2.0", """Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity
that creates, contributes to the creation of, or owns Covered Software. 1.2. "Contributor Version" means the combination of
the Contributions of others (if any) used by a Contributor and that particular Contributor's Contribution. 1.3.
"Contribution" means Covered Software of a particular Contributor."""),
    ("GPL-2.0", _gnu_header("General", "2")),
    ("LGPL", _gnu_header("Lesser General", "3")),
    ("LGPL-2.0", _gnu_header("Library General", "2")),
    ("LGPL-2.1", _gnu_header("Lesser General", "2.1", "library")),
    ("AGPL", _gnu_header("Affero General", "3")),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
)
_CC = (
    ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
    ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
)
_CREATIVE = tuple(
    text
    for version, ending in (("4.0", "International"), ("3.0", "Unported"))
    for short, long in _CC
    for text in (
        (f"CC-{short}-{version}", f"This work is licensed under a Creative Commons {long.replace('Derivatives', 'Derivs') if ending == 'Unported' else long} {version} {ending} License."),
        (f"CC-{short}-{version}", f"Licensed under CC {short} {version}."),
    )
    if text not in _COMMON
)
_AS_IS = """ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING
FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_HISTORICAL = """Permission to use, copy, modify, and distribute this software and its documentation for any purpose and without fee is
hereby granted, provided that the above copyright notice appear in all copies and that both that copyright notice and this
permission notice appear in supporting documentation, and that the name of the author not be used in advertising or publicity
pertaining to distribution of the software without specific, written prior permission."""
_PERMISSIVE = (
    ("0BSD", f"""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS {_AS_IS}"""),
    ("HPND", f"""{_HISTORICAL} The author makes no representations about the suitability of this software for any purpose. It is
provided "as is" without express or implied warranty."""),
    ("HPND", f"{_HISTORICAL} THE AUTHOR DISCLAIMS {_AS_IS}"),
    ("CC0-1.0", """The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights
(defined below) upon the creator and subsequent owner(s) (each and all, an "owner") of an original work of authorship and/or a
database (each, a "Work"). Certain owners wish to permanently relinquish those rights to a Work for the purpose of contributing
to a commons of creative, cultural and scientific works ("Commons") that the public can reliably and without fear of later claims
of infringement build upon, modify, incorporate in other works, reuse and redistribute as freely as possible in any form
whatsoever and for any purposes, including without limitation commercial purposes."""),
)
LICENSE_TEXTS = _COMMON + _MORE + _CREATIVE + _PERMISSIVE

#: A word of a wording, and words that make it another license.
VARIANT_WORDS = (
    ("gnu", "affero lesser"),
    ("cc", "sa nc nd"),
    ("creative", "sharealike noncommercial noderivatives noderivs"),
)
