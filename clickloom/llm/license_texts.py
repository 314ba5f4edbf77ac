"""Licence notices and texts, by SPDX identifier. The wording of the licences.

The full texts are the files of ``license_bodies``; notices of one line are made from the names of
the licences.
"""

from importlib import resources

_MIT_GRANT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear
in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD
TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL
THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

_BSD_START = """
Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: Redistributions of source code must retain the
above copyright notice, this list of conditions and the following disclaimer. Redistributions in
binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_NAMES = """
Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission."""

_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER
IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_APACHE = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

_GPL = """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version {version} of the
License, or (at your option) any later version. This program is distributed in the hope that it
will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""

_ZLIB = """
This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software. Permission is granted
to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions: The origin of this software must
not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is
not required. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software. This notice may not be removed or altered from any
source distribution."""

_UNLICENSE = """
This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as
a compiled binary, for any purpose, commercial or non-commercial, and by any means."""

_MPL = """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""

# What notices of one line call a licence.
_NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "MIT": ("MIT License",),
    "ISC": ("ISC License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License"),
    "GPL-1.0-or-later": ("GNU General Public License",),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1",
                 "GNU Lesser General Public License v2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3",
                 "GNU Lesser General Public License v3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3",
                 "GNU Affero General Public License v3.0"),
    "GFDL-1.3": ("GNU Free Documentation License, version 1.3",),
    "MPL-1.1": ("Mozilla Public License, version 1.1", "Mozilla Public License 1.1"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0"),
    "EPL-2.0": ("Eclipse Public License, version 2.0", "Eclipse Public License 2.0"),
    "Zlib": ("zlib License",),
    "CC0-1.0": ("CC0 1.0 Universal", "CC0 1.0"),
}
_OPENINGS = ("licensed under", "released under", "distributed under", "available under",
             "published under", "dedicated to the public domain under")
_ARTICLES = ("", "a", "the")
# Creative Commons licences by their elements; all combinations that exist.
_ELEMENTS = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
_COMBINED = ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")
_VERSIONS = ("3.0", "4.0")

_NOTICES: list[tuple[str, str]] = [
    ("Apache-2.0", _APACHE),
    ("MIT", _MIT_GRANT),
    ("ISC", _ISC),
    ("BSD-2-Clause", _BSD_START + _BSD_END),
    ("BSD-3-Clause", _BSD_START + _BSD_NAMES + _BSD_END),
    ("GPL-2.0", _GPL.format(version=2)),
    ("GPL-3.0", _GPL.format(version=3)),
    ("MPL-2.0", _MPL),
    ("Zlib", _ZLIB),
    ("Unlicense", _UNLICENSE),
]


def _creative_commons() -> dict[str, tuple[str, ...]]:
    names = {}
    for elements in _COMBINED:
        words = "-".join(_ELEMENTS[e] for e in elements.split("-"))
        for version in _VERSIONS:
            kind = "International" if version == "4.0" else "Unported"
            names[f"CC-{elements}-{version}"] = (
                f"CC {elements} {version}", f"Creative Commons {words} {version} {kind} License")
    return names


def templates() -> list[tuple[str, str]]:
    """Name and text: full licences, the notices of file headers, and notices of one line."""
    bodies = sorted((resources.files("clickloom.llm") / "license_bodies").iterdir(),
                    key=lambda f: f.name)
    full = [(f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in bodies
            if f.name.endswith(".txt")]
    lines = [(spdx, f"{opening} {article} {name}")
             for spdx, names in {**_NAMES, **_creative_commons()}.items() for name in names
             for opening in _OPENINGS for article in _ARTICLES]
    return full + _NOTICES + lines
