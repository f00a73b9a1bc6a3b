"""Public license notices (fixed values) and the words that tell them from their relatives.

``-line`` is a one-line mention, ``-part`` the opening that often stands
alone; the other names are whole notices, without the copyright line.
"""

from __future__ import annotations

TEMPLATES: dict[str, str] = {
    "All-rights-reserved-line": "All rights reserved.",
    "MIT-line": "Released under the MIT License.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
}
#: Phrases of a template that must stand in the text without a gap, or it is another license.
REQUIRED: dict[str, tuple[str, ...]] = {"MIT-line": ("MIT License",), "GPL-3.0-line": ("GNU General Public License, version 3",)}


def _add(name: str, text: str, *required: str) -> None:
    TEMPLATES[name] = text
    if required:
        REQUIRED[name] = required


# --- lines

for _name, _words in {
    "Apache-1.0": "Apache License, Version 1.0",
    "Apache-1.1": "Apache License, Version 1.1",
    "Apache-2.0": "Apache License, Version 2.0",
    "BSD": "BSD License",
    "BSD-2-Clause": "BSD 2-Clause License",
    "BSD-3-Clause": "BSD 3-Clause License",
    "BSL-1.0": "Boost Software License, Version 1.0",
    "CDDL-1.0": "Common Development and Distribution License, Version 1.0",
    "EPL-1.0": "Eclipse Public License, Version 1.0",
    "EPL-2.0": "Eclipse Public License, Version 2.0",
    "EUPL-1.2": "European Union Public Licence, Version 1.2",
    "ISC": "ISC License",
    "MPL-1.1": "Mozilla Public License, Version 1.1",
    "MPL-2.0": "Mozilla Public License, Version 2.0",
    "Zlib": "zlib License",
}.items():
    _add(f"{_name}-line", f"Licensed under the {_words}.", _words)
for _name, _words in {
    "GPL-1.0": "GNU General Public License, version 1",
    "GPL-2.0": "GNU General Public License, version 2",
    "LGPL-2.0": "GNU Library General Public License, version 2",
    "LGPL-2.1": "GNU Lesser General Public License, version 2.1",
    "LGPL-3.0": "GNU Lesser General Public License, version 3",
    "AGPL-3.0": "GNU Affero General Public License, version 3",
    "GFDL-1.2": "GNU Free Documentation License, version 1.2",
    "GFDL-1.3": "GNU Free Documentation License, version 1.3",
}.items():
    _add(f"{_name}-line", f"This work is licensed under the {_words}.", _words)
for _short, _long in {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}.items():
    for _v, _where in {"2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}.items():
        _add(f"CC-{_short}-{_v}-line", f"Licensed under CC {_short} {_v}.", f"CC {_short} {_v}")
        _words = f"Creative Commons {_long} {_v}"
        _add(f"CC-{_short}-{_v}", f"This work is licensed under a {_words} {_where} License.", _words)
_add("CC0-1.0-line", "Released under CC0 1.0 Universal.", "CC0 1.0")

# --- notices of the GNU licenses

for _kind, _versions in {"": ("1", "2", "3"), "Library ": ("2",), "Lesser ": ("2.1", "3"), "Affero ": ("3",)}.items():
    for _v in _versions:
        _license = f"GNU {_kind}General Public License"
        _it = "library" if _kind in ("Library ", "Lesser ") and _v != "3" else "program"
        _name = {"": "GPL", "Affero ": "AGPL"}.get(_kind, "LGPL") + "-" + (_v if "." in _v else f"{_v}.0")
        _start = f"This {_it} is free software: you can redistribute it and/or modify it under the terms of the {_license} "
        _rest = (
            f" This {_it} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
            f"warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {_license} for more details. You should have "
            f"received a copy of the {_license} along with this {_it}. If not, see <https://www.gnu.org/licenses/>."
        )
        _later = f"{_start}as published by the Free Software Foundation, either version {_v} of the License, or (at your option) any later version."
        _only = f"{_start}version {_v} as published by the Free Software Foundation."
        for _end, _text, _version in (("or-later", _later, f"either version {_v} of the License"), ("only", _only, f"{_license} version {_v} as published")):
            _add(f"{_name}-{_end}", _text + _rest, _license, _version)
            _add(f"{_name}-{_end}-part", _text, _license, _version)

# --- other notices

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so"
)
_MIT_IF = (
    ", subject to the following conditions: The above copyright "
    "notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
_MIT_AS_IS = (
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_add("MIT", _MIT + _MIT_IF + _MIT_AS_IS, "subject to the following conditions")
_add("MIT-part", _MIT + _MIT_IF, "subject to the following conditions")
_add("MIT-0", f"{_MIT}.{_MIT_AS_IS}")

_APACHE = "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
_add(
    "Apache-2.0",
    f"Licensed under the Apache License, Version 2.0 (the \"License\"); {_APACHE} http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
    "specific language governing permissions and limitations under the License.",
    "Apache License, Version 2.0",
)

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: "
)
_BSD_SOURCE = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
)
_BSD_BINARY = (
    " Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_ADVERTS = (
    " All advertising materials mentioning features or use of this software must display the following acknowledgement: "
    "This product includes software developed by the organization."
)
_BSD_NAMES = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_BSD_AS_IS = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_add("BSD-2-Clause", _BSD + _BSD_SOURCE + _BSD_BINARY + _BSD_AS_IS)
_add("BSD-3-Clause", _BSD + _BSD_SOURCE + _BSD_BINARY + _BSD_NAMES + _BSD_AS_IS, "to endorse or promote products")
_add("BSD-4-Clause", _BSD + _BSD_SOURCE + _BSD_BINARY + _BSD_ADVERTS + _BSD_NAMES + _BSD_AS_IS, "All advertising materials", "to endorse or promote products")
_add("BSD-part", _BSD + _BSD_SOURCE)  # of any of them

_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_AS_IS = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_add("ISC", f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies.{_ISC_AS_IS}", "provided that")
_add("0BSD", f"{_ISC}.{_ISC_AS_IS}")
_add(
    "MPL-2.0",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Mozilla Public License, v. 2.0",
)
_add(
    "MPL-1.1",
    f"The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); {_APACHE} "
    "http://www.mozilla.org/MPL/ Software distributed under the License is distributed on an \"AS IS\" basis, WITHOUT WARRANTY "
    "OF ANY KIND, either express or implied. See the License for the specific language governing rights and limitations "
    "under the License.",
    "Mozilla Public License Version 1.1",
)
_add(
    "EPL-2.0",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
    "is available at https://www.eclipse.org/legal/epl-2.0/",
    "Eclipse Public License 2.0",
)
_add(
    "BSL-1.0",
    "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
    "http://www.boost.org/LICENSE_1_0.txt)",
    "Boost Software License, Version 1.0",
)
_add(
    "Unlicense",
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
    "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
    "commercial or non-commercial, and by any means.",
)
_add(
    "Zlib",
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
    "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
    "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
    "restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original "
    "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but "
    "is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
    "original software. This notice may not be removed or altered from any source distribution.",
)
_add(
    "CC0-1.0",
    "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
)
