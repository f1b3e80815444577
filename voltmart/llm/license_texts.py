"""Licence texts and licence notices, by SPDX identifier.

The texts are those of the public SPDX list, without copyright lines, and the long ones in license_files, as
distributions ship them. More can be given to the operator as a table.
"""

from importlib.resources import files

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"""

_MIT_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_MIT = f"""{_MIT_GRANT}, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.

{_MIT_DISCLAIMER}"""

_MIT_0 = f"""{_MIT_GRANT}.

{_MIT_DISCLAIMER}"""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted"""

_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD
TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER
RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_ISC = f"""{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all
copies.

{_ISC_DISCLAIMER}"""

_0BSD = f"""{_ISC_GRANT}.

{_ISC_DISCLAIMER}"""

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS
OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS
FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
THE POSSIBILITY OF SUCH DAMAGE."""

_BSD_2 = f"""{_BSD_HEAD}

{_BSD_TAIL}"""

_BSD_3 = f"""{_BSD_HEAD}

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.

{_BSD_TAIL}"""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will
the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications,
and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software.

3. This notice may not be removed or altered from any source distribution."""

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is
distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and limitations under the License."""

TEXTS = [
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT", "The MIT License\n\n" + _MIT),
    ("MIT-0", _MIT_0),
    ("MIT-0", "MIT No Attribution\n\n" + _MIT_0),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("0BSD", _0BSD),
    ("0BSD", "BSD Zero Clause License\n\n" + _0BSD),
    ("BSD-2-Clause", _BSD_2),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_2),
    ("BSD-3-Clause", _BSD_3),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_3),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n\n" + _ZLIB),
    ("Apache-2.0", _APACHE_HEADER),
]

# Whole texts by file. A text alone does not say "or later"; "only" is what it is without such words.
FILES = [
    ("Apache-2.0", "Apache-2.0"), ("Artistic-1.0-Perl", "Artistic"), ("BSD-3-Clause", "BSD"),
    ("CC0-1.0", "CC0-1.0"), ("GFDL-1.2-only", "GFDL-1.2"), ("GFDL-1.3-only", "GFDL-1.3"),
    ("GPL-1.0-only", "GPL-1"), ("GPL-2.0-only", "GPL-2"), ("GPL-3.0-only", "GPL-3"),
    ("LGPL-2.0-only", "LGPL-2"), ("LGPL-2.1-only", "LGPL-2.1"), ("LGPL-3.0-only", "LGPL-3"),
    ("MPL-1.1", "MPL-1.1"), ("MPL-2.0", "MPL-2.0"),
]
_END = "END OF TERMS AND CONDITIONS"  # what follows tells how to apply the licence and is often left out

for _name, _file in FILES:
    _text = (files("voltmart.llm") / "license_files" / f"{_file}.txt").read_text("utf-8")
    TEXTS.append((_name, _text))
    if _END in _text:
        TEXTS += [(_name, _text[: _text.index(_END)]), (_name, _text[: _text.index(_END)] + _END)]

# One-line notices; each is the whole text of a line.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This work is licensed under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-only", "Licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
]

IDENTIFIERS = [
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0",
    "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later",
    "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-3.0-only", "MIT", "MIT-0", "MPL-2.0",
    "Unlicense", "Zlib",
]

# Spellings that count as equal: left ones become right ones, as whole words, after punctuation went.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("licencing", "licensing"),
    ("sub license", "sublicense"), ("sub licence", "sublicense"), ("sublicence", "sublicense"),
    ("non infringement", "noninfringement"), ("acknowledgement", "acknowledgment"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"),
    ("organisation", "organization"), ("favour", "favor"), ("fulfil", "fulfill"), ("judgement", "judgment"),
    ("merchantibility", "merchantability"), ("per cent", "percent"), ("whilst", "while"),
    ("https", "http"), ("and or", "or"),
]
