"""Complete licence texts, as wrapped in files and in one line a paragraph, in comments, and with list numbers."""

from __future__ import annotations

import edge
import pytest
from tardy.llm import licenses

MIT = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD2 = """Copyright (c) 2020, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
NAMES = """3. Neither the name of Some Body, Inc. nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.

"""
BSD3 = BSD2.replace("THIS SOFTWARE IS PROVIDED", NAMES + "THIS SOFTWARE IS PROVIDED")
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
GPL2 = GPL3.replace("software:", "software;").replace("Foundation, either version 3", "Foundation; either version 2")
LGPL21 = GPL2.replace("This program", "This library").replace("GNU General", "GNU Lesser General").replace("version 2 of", "version 2.1 of")
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
CC = """This work is licensed under a Creative Commons
Attribution-NonCommercial-ShareAlike 4.0 International License.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
WANT = {"MIT/text:1": MIT, "BSD-2-Clause/text:1": BSD2, "BSD-3-Clause/text:1": BSD3, "ISC/text:1": ISC, "GPL-3.0-or-later/notice:1": GPL3,
        "GPL-2.0-or-later/notice:1": GPL2, "LGPL-2.1-or-later/notice:1": LGPL21, "MPL-2.0/notice:1": MPL, "CC-BY-NC-SA-4.0/reference:1": CC,
        "Apache-2.0/notice:1": APACHE}


def unwrapped(text: str) -> str:
    return "\n\n".join(" ".join(p.split()) for p in text.split("\n\n"))


@pytest.mark.parametrize("form", ["wrapped", "unwrapped", "commented", "crlf", "amid"])
def test_complete_texts(spark, form):
    change = {"wrapped": str, "unwrapped": unwrapped, "commented": lambda t: "/*\n" + "".join(f" * {x}\n" for x in t.split("\n")) + " */\nint x;",
              "crlf": lambda t: t.replace("\n", "\r\n"), "amid": lambda t: f"Some words\n{t}Other words that go on. And on\n"}[form]
    rows = [(i, change(t), "s") for i, t in enumerate(WANT.values())]
    got = licenses.license_digest(edge.documents(spark, rows)).select("doc_id", "n_unmatched", "licenses").collect()
    assert sorted(tuple(r) for r in got) == [(i, 0, want) for i, want in enumerate(WANT)]


def test_parts_of_sentences_do_not_count(spark):
    rows = [(1, "It is not released under the MIT License.", "s"), (2, "Permission is hereby granted, free of charge, to some.", "s"),
            (3, MIT + MIT + "1. Released under the MIT License.", "s"), (4, "Released under the MIT License\nOther words", "s")]
    got = licenses.license_digest(edge.documents(spark, rows)).select("doc_id", "n_known", "licenses").collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, ""), (2, 0, ""), (3, 9, "MIT/text:2,MIT/reference:1"), (4, 1, "MIT/reference:1")]


def test_sql_and_result_agree_on_pieces(spark):
    """The SQL's sentences and rules are as they were: those of one piece."""
    assert licenses.RULES[0] == ("Apache-2.0", "notice", "ABCDEF") and len(licenses.SENTENCES) == 24 and len(licenses.RULES) == 14
    text = "\n".join(s + "." for s in licenses.SENTENCES)
    old = licenses.scan_licenses(edge.documents(spark, [(1, text, "s")]), licenses.SENTENCES, licenses.RULES).collect()
    assert [(r["n_sentences"], r["n_known"]) for r in old] == [(24, 24)]


@pytest.mark.parametrize("words", [15, 350])
def test_long_names_of_holders(spark, words):
    """Open places take names far longer than any; the opened sentences a program's name of 30 words."""
    name = " ".join(f"holder{i}" for i in range(words))
    bsd = BSD3.replace("the copyright holder nor", f"{name} nor").replace("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", name).replace("THE COPYRIGHT HOLDER OR", f"{name} OR")
    assert bsd.count(name) >= 2
    gnu = GPL3.replace("This program", "Our " + " ".join(f"tool{i}" for i in range(28)) + " program")
    got = licenses.license_digest(edge.documents(spark, [(0, bsd, "s"), (1, gnu, "s")])).select("doc_id", "licenses").collect()
    assert sorted(tuple(r) for r in got) == [(0, "BSD-3-Clause/text:1"), (1, "GPL-3.0-or-later/notice:1")]
