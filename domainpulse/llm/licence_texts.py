"""Licence notices and texts that the scan looks for.

Fixed values: wording of well-known public licences and of the usual lines that name them.
"""

from importlib.resources import files

#: Short lines that name a licence; found when enough words stand in order, close together, and all words marked by a star.
NOTICES = {
    "MIT": ["Released under the *MIT License", "Licensed under the *MIT License", "*SPDX-License-Identifier: *MIT"],
    "Apache-2.0": [
        "Licensed under the *Apache License, Version *2.0", "*SPDX-License-Identifier: *Apache-2.0",
        "Released under the *Apache License *2.0"],
    "MPL-2.0": [
        "subject to the terms of the *Mozilla *Public License, v. *2.0", "Licensed under the *Mozilla *Public License *2.0",
        "Released under the *Mozilla *Public License Version *2.0", "*SPDX-License-Identifier: *MPL-2.0"],
    "BSD-2-Clause": [
        "Released under the *BSD *2-Clause License", "Licensed under the *BSD *2-Clause License",
        "*SPDX-License-Identifier: *BSD-2-Clause"],
    "BSD-3-Clause": [
        "Released under the *BSD *3-Clause License", "Licensed under the *BSD *3-Clause License",
        "*SPDX-License-Identifier: *BSD-3-Clause"],
    "ISC": ["Released under the *ISC License", "Licensed under the *ISC License", "*SPDX-License-Identifier: *ISC"],
    "Unlicense": ["Released under the *Unlicense", "*SPDX-License-Identifier: *Unlicense"],
    "CC0-1.0": ["Released under *CC0 *1.0 Universal", "*SPDX-License-Identifier: *CC0-1.0"],
}
for _name, _words, _versions in (
        ("GPL", "*GNU *General *Public License", ("2.0", "3.0")),
        ("LGPL", "*GNU *Lesser *General *Public License", ("2.1", "3.0")),
        ("AGPL", "*GNU *Affero *General *Public License", ("3.0",))):
    for _v in _versions:
        _short = _v.removesuffix(".0")
        NOTICES[f"{_name}-{_v}"] = [
            f"{_how} the {_words}{_version} *{_n}" for _how in ("Licensed under", "Released under")
            for _version, _n in ((", version", _short), ("", f"v{_short}"), ("", f"v{_v}"), (", version", _v))] + [
            f"*SPDX-License-Identifier: *{_name}-{_v}{_x}" for _x in ("", "-only", "-or-later")] + [
            f"{_how} the *{_name}{_n}" for _how in ("Licensed under", "Released under")
            for _n in (f"v{_short}", f"-{_v}", f" *v{_short}", f" version *{_short}")]
NOTICES["GPL-3.0"].append("This work is licensed under the *GNU *General *Public License, version *3")
for _kind, _long in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
                     ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                     ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    NOTICES[f"CC-{_kind}-4.0"] = [
        f"Licensed under *CC *{_kind} *4.0", f"Released under *CC *{_kind} *4.0", f"Licensed under *CC-{_kind}-4.0",
        f"licensed under a *Creative *Commons *{_long} *4.0 International License",
        f"*SPDX-License-Identifier: *CC-{_kind}-4.0"]

#: Words that name another licence when they stand inside a finding and not in its template.
OTHERS = {"lesser", "affero", "library", "sharealike", "noncommercial", "noderivatives", "noderivs"}

#: Longer texts; found when enough of their words align, and all words marked by a star.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies
        or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
        CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
        OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form
        must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution. 3. *Neither the name of the copyright
        holder nor the names of its contributors may be used to *endorse or *promote products derived from this
        software without specific prior written permission.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version *3 of the License, or (at
        your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See
        the GNU General Public License for more details. You should have received a copy of the GNU General Public
        License along with this program. If not, see""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means.""",
}

_HEADER = TEXTS["GPL-3.0"].replace("*3 of", "{} of")
_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
    WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
    ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
    SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
    LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
    CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
    SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_2 = TEXTS["BSD-3-Clause"].partition("3. *Neither")[0]
#: As package data, which is also found where the package is imported from an archive.
_BODIES = {f.name.removesuffix(".txt"): f.read_text(encoding="utf-8") for f in sorted(
    (files("domainpulse.llm") / "licences").iterdir(), key=lambda f: f.name) if f.name.endswith(".txt")}
#: Section 13, in which the AGPL's terms differ from the GPL's.
_REMOTE = """13. Remote Network Interaction; Use with the GNU General Public License. Notwithstanding any other provision of
    this License, if you modify the Program, your modified version must prominently offer all users *interacting with it
    *remotely through a computer network (if your version supports such interaction) an opportunity to receive the
    Corresponding Source of your version by providing access to the Corresponding Source from a network server at no charge,
    through some standard or customary means of facilitating copying of software. """


def _affero() -> str:
    head, _, rest = _BODIES["GPL-3.0"].partition("  13. Use with the GNU Affero")
    return (head + _REMOTE + "  14. Revised" + rest.partition("  14. Revised")[2]).replace(
        "GNU General Public License", "GNU Affero General Public License")


#: Further texts and headers of a licence.  Headers of one family differ in a few words, which are marked.
MORE_TEXTS = {
    "GPL-2.0": [_HEADER.format("*2")],
    "LGPL-2.1": [_HEADER.format("*2.1").replace("General Public", "*Lesser General Public")],
    "LGPL-3.0": [_HEADER.format("*3").replace("General Public", "*Lesser General Public")],
    "AGPL-3.0": [_HEADER.format("*3").replace("General Public", "*Affero General Public"), _affero()],
    "BSD-2-Clause": [_BSD_2, _BSD_2 + _DISCLAIMER],
    "BSD-3-Clause": [TEXTS["BSD-3-Clause"] + _DISCLAIMER],
    "ISC": [TEXTS["ISC"] + """ THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
        SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
        ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
        PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
        THE USE OR PERFORMANCE OF THIS SOFTWARE."""],
    "Unlicense": [TEXTS["Unlicense"] + """ In jurisdictions that recognize copyright laws, the author or authors of this
        software dedicate any and all copyright interest in the software to the public domain. We make this dedication for
        the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be
        an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""],
    "CC-BY-4.0": ["""This work is licensed under the Creative Commons *Attribution *4.0 International License. To view a copy of
        this license, visit http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative Commons, PO Box 1866,
        Mountain View, CA 94042, USA."""],
}
for _k, _t in _BODIES.items():
    MORE_TEXTS.setdefault(_k, []).append(_t)
