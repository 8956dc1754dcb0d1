"""License scans against a plain search and all blocks."""

from __future__ import annotations

import re
from math import ceil

import pytest

from launchtide.llm.licenses import PHRASES, TEMPLATES, scan_licenses

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def plain(text, threshold=0.8, block=96):
    own = words(text)
    places, base = [], set()
    for phrase, label in PHRASES.items():
        wanted = phrase.encode().split()
        here = [k for k in range(len(own) - len(wanted) + 1) if own[k : k + len(wanted)] == wanted]
        places += here
        base |= {label} if here else set()
    labels, best = set(base), 1.0 if places else 0.0
    for label, template in TEMPLATES:
        tokens = set(words(template))
        for at in range(0, len(own), block // 2):
            shared = len(tokens & set(own[at : at + block]))
            if shared >= ceil(threshold * len(tokens) - 1e-9):
                labels.add(label)
                best = max(best, shared / len(tokens))
    return (len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), pytest.approx(best))


def test_equals_a_plain_scan(spark, edge_docs, edge_rows, no_docs):
    texts = [text for _, text, *_ in edge_rows]
    texts += [t for _, t in TEMPLATES]
    texts += ["x " * 150 + t + " y" * 150 for _, t in TEMPLATES]
    texts += [" ".join(t.split()[2:]) for _, t in TEMPLATES]
    texts += ["x " * (k * 13) + " ".join(t.split()[::-1]) for k, (_, t) in enumerate(TEMPLATES)]
    texts += ["Released under the MIT License. Under  the-mit\nlicense!", "CC BY-NC 4.0 cc by nc", "under the mit", "license"]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id bigint, text string, labels string").repartition(3)
    found = {row.doc_id: tuple(row)[1:] for row in scan_licenses(docs).collect()}
    assert found == {k: plain(text) for k, text in enumerate(texts)}
    assert any(row[5] for row in found.values())
    assert scan_licenses(edge_docs).count() == len(edge_rows)
    assert scan_licenses(no_docs).count() == 0


# License texts as they are published, without their opening sentences.
BODIES = {
    "mit": "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial "
    'portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE.",
    "bsd": "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    '\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY.",
    "isc": "provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS "
    'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
    "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
    "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
    "SOFTWARE.",
    "unlicense": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
    "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\nIn "
    "jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
    "interest in the software to the public domain. We make this dedication for the benefit of the public at large and to "
    "the detriment of our heirs and successors.",
    "zlib": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
    "to alter it and redistribute it freely, subject to the following restrictions:\n1. The origin of this software must "
    "not be misrepresented; you must not claim that you wrote the original software. If you use this software in a "
    "product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source "
    "versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This "
    "notice may not be removed or altered from any source distribution.",
    "apache-2": "Unless required by applicable law or agreed to in writing, software\n# distributed under the License is "
    'distributed on an "AS IS" BASIS,\n# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\n# See '
    "the License for the specific language governing permissions and\n# limitations under the License.",
}


def test_bodies_without_their_openings_have_their_own_label_only(spark):
    """Each body, wherever it begins in a text and with some of its words lost or changed."""
    rows, wanted = [], []
    for label, body in BODIES.items():
        for before in (0, 13, 31, 47, 200):
            own = body.split()
            for at in range(5, len(own), 29):
                own[at] = "changed"
            rows.append((len(rows), " ".join(["filler"] * before + own + ["more"] * before)))
            wanted.append(label)
    found = scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert {row.doc_id: (row.base_labels, row.labels) for row in found} == {k: ("", label) for k, label in enumerate(wanted)}
    assert all(0.8 <= row.score <= 1 for row in found)


def test_templates_fit_blocks():
    assert all(len(words(template)) <= 80 for _, template in TEMPLATES)
