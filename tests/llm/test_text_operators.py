"""Personal data, main text, WARC archives, licences and fingerprints."""

import base64
import hashlib
import io
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ROWS
from tidemark.llm import imatch, licences, personal_data, warc, wrappers
from tidemark.llm.common import shared_folder


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for k, pattern in ((2, r"[0-9]([\x20-]?[0-9])+"), (3, r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            if (12 <= len(d) <= 19 and luhn(d)) if k == 2 else 9 <= len(d) <= 15:
                out.append((m.start(), k, m.end()))
    return sorted(out)


CASES = [
    "a.b@c.d @x.y a@@b.c a@b a@b.c@d.e x+y%z@ex-a.co.uk, é@b.cc",
    "1.2.3.4 256.1.1.1 0001.2.3.4 1.2.3 1.2.3.4.5.6.7.8 00000255.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 4 1 1 1  1",
    "+1 (555) 123-4567 +12 +1234567890123456 ++49 30 1234567 +49.30.1234567 4111111111111111",
    "Kartenzahlung 5500005555555559, Tel. +49 170 1234567; mail: q@w.ee 🙂 z@y.xx",
]


def test_base_spans_are_the_patterns():
    for text in CASES:
        assert personal_data.base_spans(text) == base_spans(text)


def test_personal_data_of_odd_rows(spark, odd, none):
    df = spark.createDataFrame([r[:2] for r in ROWS] + list(enumerate(CASES, 50)), "doc_id bigint, text string")
    got = personal_data.find(df).collect()
    assert len(got) == len(ROWS) + len(CASES)
    for r in got:
        if r.doc_id and r.doc_id >= 50:
            spans = [f"{personal_data.BASE[k]}:{a}:{b}" for a, k, b in base_spans(CASES[r.doc_id - 50])]
            assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
            assert set(spans) <= set(r.spans.split(","))
            assert r.n_email + r.n_ip + r.n_card + r.n_phone == len(spans)
    assert personal_data.find(none).count() == 0 and personal_data.find(odd).count() == len(ROWS)


def test_votes_decide_on_further_spans(spark):
    secret = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    rows = [(i, f'say token = "{hashlib.sha1(str(i).encode()).hexdigest()}" and call a{i}@b.com') for i in range(60)]
    rows += [(100, f"token = {secret}"), (101, "plain words and nothing else 12345"), (102, "write to bob [at] site [dot] org")]
    got = {r.doc_id: r for r in personal_data.find(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[100].spans == f"secret:8:{8 + len(secret)}" and got[101].spans == ""
    assert got[102].spans.startswith("address:9:")


def test_em_finds_the_reliable_labeler():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    good = np.where(rng.random(4000) < 0.95, truth, ~truth)
    mid = np.where(rng.random(4000) < 0.8, truth, ~truth)
    weak = np.where(rng.random(4000) < 0.6, truth, ~truth)
    patterns, counts = np.unique(np.column_stack([good, mid, weak]) * 2 - 1, axis=0, return_counts=True)
    accuracy, _ = personal_data.reliabilities(patterns, counts.astype(float))
    assert accuracy[0] > accuracy[1] > accuracy[2]


def test_what_is_named_otherwise_is_rejected(spark):
    """Planted spans of both sorts: precision and recall of each kind."""
    sha = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(80)]
    rows = [(i, f'token = "{sha[i]}"', True) for i in range(40)] + [(i, f"see commit {sha[i]} of it", False) for i in range(40, 80)]
    rows += [(i, f"my tel 030 {1834000 + 617 * i} at home", True) for i in range(100, 130)]
    rows += [(i, f"your order 030 {1834000 + 617 * i} was sent", False) for i in range(130, 160)]
    got = {r.doc_id: r.spans for r in personal_data.find(spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")).collect()}
    for kind, ids in (("secret", range(80)), ("local_phone", range(100, 160))):
        found = {i for i in ids if kind in got[i]}
        true = {i for i, _, good in rows if good and i in ids}
        assert found == true


def brute_spans(name, text):
    return [m.span() for m in personal_data._WIDE[name].finditer(text)]


def test_written_addresses_are_the_pattern():
    cases = ["bob [at] site [dot] org", "a(at)b.c(at)d.e", "x [at] y z(at)w.de", "bob  [at] a.b", "[at] a.b c.d(at) e (dot) f, é(at)g.h", "a b(at)c(at)d.e"]
    for text in cases:
        assert list(personal_data._written_addresses(text)) == brute_spans("address", text)


@pytest.mark.parametrize("text", ["7" * 10**6, "a" * 10**6 + " (at) b.", "1." * 500_000, "+1" + "(" * 10**6, "a@" * 500_000, "x" * 10**6 + "@", "A1" * 500_000])
def test_long_runs_take_linear_time(text):
    began = time.process_time()
    personal_data.wide_spans(text, personal_data.base_spans(text))
    assert time.process_time() - began < 10


def page(body, tail="</body></html>"):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{body}{tail}"


def test_main_text(spark):
    rows = [
        (1, "http://a.x/1", page("<nav>menu</nav><article><h1>T &amp; U</h1><p><b>one\n two<br><p>a&lt;b &eacute;<!-- c --></article><footer>f</footer>")),
        (2, None, None),
        (3, "http://a.x/3", ""),
        (4, "::", page("<div class='ad'>buy</div><main><p>x<span>y</span> z</p><aside>no</aside><form>q<p>w</p></form><script>'</p>'</script></main>")),
        (5, "http://b.x/", "<article><p>cut &am"),
        (5, "http://b.x/", "<article><p>cut &am"),
        (None, "http://b.x/", page("<div id=comments><p>hi</p></div><p>body text</p><section class='sidebar'>s</section>")),
    ]
    got = Counter(tuple(r) for r in wrappers.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect())
    text = {1: "T & U\none two\na<b é", 2: "", 3: "", 4: "xy z", 5: "cut &am", None: "body text"}
    assert got == Counter((i, u, text[i], len(text[i])) for i, u, _ in rows)
    assert wrappers.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_constant_nodes_are_template(spark):
    body = "<div><p>Same slogan on all pages of this host</p><p>story {0} {0} words that differ on page {0}</p><p>end {0}</p></div>"
    rows = [(i, "https://h.x/", page(body.format(f"n{i}"))) for i in range(12)]
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: f"story n{i} n{i} words that differ on page n{i}\nend n{i}" for i in range(12)}
    copies = [(i, "https://h.x/", page(body.format("n"))) for i in range(12)]
    got = wrappers.extract(spark.createDataFrame(copies, "page_id bigint, url string, html string")).collect()
    assert all(r.text.startswith("Same slogan") for r in got)


def test_text_without_a_partner_stays(spark):
    body = "<div><p>By <{0}>{1}</{0}></p><p>story of page {1} and more words on {1}</p></div>"
    rows = [(i, "https://h.x/", page(body.format("i" if i else "b", f"n{i}"))) for i in range(12)]
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: f"By n{i}\nstory of page n{i} and more words on n{i}" for i in range(12)}


def test_deep_and_wide_pages(monkeypatch):
    deep = wrappers.parse("<div>" * 5000 + "<p>end</p>")
    other = wrappers.number(wrappers.parse("<div>" * 4000 + "<b>x</b><p>end</p>"))
    assert wrappers.page_blocks(deep, other)[-1]["text"] == "end"
    wide = [wrappers.parse("".join(f"<p>{'<b>x</b>' * (i * k % 7)}<i>{i}</i></p>" for i in range(1000))) for k in (1, 3)]
    for w in wide:
        wrappers.number(w)
    began = time.process_time()
    whole = wrappers.align(*wide)
    assert time.process_time() - began < 5
    monkeypatch.setattr(wrappers, "TABLE_CELLS", 500)
    assert len(wrappers.align(*wide)) == len(whole)


def test_tree_matching_is_maximal():
    def brute(x, y):
        if x.tag != y.tag:
            return 0
        m = [[0] * (len(y.kids) + 1) for _ in range(len(x.kids) + 1)]
        for i, a in enumerate(x.kids):
            for j, b in enumerate(y.kids):
                m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + brute(a, b))
        return m[-1][-1] + 1

    pages = [
        "<div><p>a</p><p><b>x</b></p><ul><li>1<li>2</ul></div>", "<div><ul><li>1</ul><p>a</p><p>c</p></div><div></div>",
        "<div><p><b>x</b></p><p>a</p><ul><li>1<li><i>2</i></ul><p>z</p></div>", "<section><p>q</p></section>",
    ]
    trees = [wrappers.parse(p) for p in pages]
    for t in trees:
        wrappers.number(t)
    for a in trees:
        for b in trees:
            assert len(wrappers.align(a, b)) == brute(a, b)


def test_warc_round_trip(spark):
    rows = [(1, "http://a/ \n", "x"), (2, None, "x"), (3, "u", None), (4, "u", ""), (5, "é", "é" * 90_000), (6, "u", "y"), (6, "u", "y"), (None, "u", "x")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, target bigint")
    got = Counter(tuple(r) for r in warc.round_trip(df).collect())
    last = defaultdict(int)
    for i, _, h in rows:
        last[h or ""] = max(last[h or ""], i or 0)
    want = Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        target = last[h or ""] if i != last[h or ""] else None
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want[i, len(data), digest, "response" if target is None else "revisit", target] += 1
    assert got == want
    assert warc.round_trip(df.limit(0)).count() == 0


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    parts = [warc.record(i, f"http://x/{i}", f"<p>page {i} {'z' * 50 * i}</p>".encode()) for i in range(8)]
    parts = [warc.member(p) if packed else p for p in parts]
    clean = b"".join(parts)
    assert [r["page_id"] for _, _, r in warc.salvage(io.BytesIO(clean), len(clean))] == list(range(8))
    hurt = bytearray(parts[2])
    hurt[len(hurt) // 2 if packed else -20] ^= 0x55  # headers of plain archives have no checksum
    bad = parts[0] + b"garbage\x1f\x8b\x08WARC/1.1\r\n" + parts[1] + bytes(hurt) + parts[3] + parts[4][: len(parts[4]) // 2] + parts[5] + b"".join(parts[6:])[:-9]
    found = list(warc.salvage(io.BytesIO(bad), len(bad)))
    assert [r["page_id"] for _, _, r in found if isinstance(r, dict)] == [0, 1, 3, 5, 6]
    assert sum(n for _, n, _ in found) == len(bad) and sum(isinstance(r, str) for _, _, r in found) == 4


def foreign(kind, block, *more, content="application/http; msgtype=response"):
    """A record as crawlers write it: no fields of this writer, digests only among ``more``."""
    lines = ["WARC/1.0", f"warc-type: {kind}", "WARC-Record-ID: <urn:uuid:1>", "WARC-Date:2020-02-02T00:00:00Z", *more]
    return "\r\n".join([*lines, f"Content-Type: {content}", f"content-length:{len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("packed", [True, False])
def test_archives_of_other_writers_are_read(packed):
    http, body = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n", b"<p>body</p>"
    sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4\r\n<p>b\r\n7\r\nody</p>\r\n0\r\n\r\n"
    parts = [
        foreign("warcinfo", b"software: x\r\n", "WARC-Filename: a.warc", content="application/warc-fields"),
        foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "WARC-Concurrent-To: <urn:uuid:2>", "WARC-Concurrent-To: <urn:uuid:3>"),
        foreign("response", http + body), foreign("response", http + body, f"WARC-Payload-Digest: sha1:{sha}"),
        foreign("response", http + body, f"WARC-Block-Digest: sha256:{hashlib.sha256(http + body).hexdigest()}"),
        foreign("response", chunked, f"WARC-Payload-Digest: sha1:{sha}"),
        foreign("metadata", b"a: b\r\n", content="application/warc-fields"), foreign("resource", body, content="text/html"),
        foreign("revisit", http, f"WARC-Payload-Digest: sha1:{sha}"),
    ]
    bad = foreign("response", http + body, f"WARC-Payload-Digest: sha1:{sha[::-1]}")
    data = b"".join(warc.member(p) if packed else p for p in [*parts, bad, parts[0]])
    found = [r for _, _, r in warc.salvage(io.BytesIO(data), len(data))]
    kinds = ["warcinfo", "request", "response", "response", "response", "response", "metadata", "resource", "revisit"]
    assert [r["type"] for r in found if isinstance(r, dict)] == [*kinds, "warcinfo"] and isinstance(found[9], str) and len(found) == 11
    assert [(r["bytes"], r["digest"]) for r in found[2:5]] == [(len(body), sha)] * 3 and found[7]["payload"] == body


def test_damaged_archive_on_shared_storage(spark):
    df = spark.createDataFrame([(i, "u", f"page {i}") for i in range(20)], "page_id bigint, url string, html string").coalesce(1)
    manifest = warc.write(df, shared_folder(spark, "w"))
    path = manifest.first().path.removeprefix("file://").removeprefix("file:")
    with open(path, "r+b") as f:
        f.seek(30)
        f.write(b"\0\0\0\0")
    got = warc.read(manifest).collect()
    assert sum(r.gap is None for r in got) == 19 and sum(r.gap is not None for r in got) == 1


def dice(a, b):
    grams = lambda t: (lambda w: set(zip(w, w[1:], strict=False)) or {(x, "") for x in w})(re.findall(r"[a-z0-9]+", t.lower()))
    x, y = grams(a), grams(b)
    return 2 * len(x & y) / (len(x) + len(y))


def test_licences(spark, odd, none):
    mit = licences.TEMPLATES[2][1]
    lines = ["Released under the MIT License.", "Released under a MIT License", "Licensed under the Apache License, Version 2.0.", "no licence at all", mit]
    rows = [(i, f"first words\n{t}\nlast words") for i, t in enumerate(lines)]
    rows += [(10, mit.replace("Software", "Program", 1)), (11, "Some text. Licensed under CC BY-NC 4.0. More text."), (12, mit)]
    got = {r.doc_id: r for r in licences.licences(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i].licences for i in (0, 2, 3, 4, 10, 11, 12)] == ["MIT", "Apache-2.0", "", "MIT", "MIT", "CC-BY-NC-4.0", "MIT"]
    assert got[12].best_dice == 1.0 and got[3].best_dice is None
    for i, text in enumerate(lines[:4]):
        best = max(dice(text, t) for _, t in licences.TEMPLATES)
        assert (got[i].best_dice or 0) == pytest.approx(best if best >= licences.LEAST_DICE else 0)
    assert licences.licences(odd).where("doc_id = 9").first().licences == "MIT"
    assert licences.licences(odd).count() == len(ROWS) and licences.licences(none).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def test_licences_inside_longer_documents(spark):
    story = " ".join(f"one word{i} of a story{i % 50} goes on" for i in range(400))
    texts = {
        "MIT": [MIT, " ".join(MIT.split()), MIT.replace("\n", "\n// ")],
        "Apache-2.0": [APACHE, APACHE.replace("\n", "\n * ")],
    }
    rows, want = [], {}
    for name, forms in texts.items():
        for t in forms:
            for doc in (f"{story}\n\n{t}\n\n{story}", f"{story} {t} {story}", f"{t}\n\n{story}", f"{story}\n\n{t}"):
                want[len(rows)] = name
                rows.append((len(rows), doc))
    rows.append((len(rows), f"{story}\n\n{MIT}\n\n{story}\n\n{APACHE}\n\n{story}\n\n{MIT}"))
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, name in want.items():
        best = max(got[i].matches, key=lambda m: (m.dice, m.n_words))
        assert {m.licence for m in got[i].matches} == {name} and best.dice == pytest.approx(1.0) and best.unit in ("window", "paragraph", "line")
        assert best.n_words == len(re.findall("[a-z0-9]+", (MIT if name == "MIT" else APACHE).lower()))
    assert [m.licence for m in got[len(want)].matches if m.n_words > 50] == ["MIT", "Apache-2.0", "MIT"]


DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT OWNER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""
CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

  * Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

  * Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
    disclaimer in the documentation and/or other materials provided with the distribution.
"""
THIRD = """
  * Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
    derived from this software without specific prior written permission.
"""


def test_whole_licence_texts_are_found(spark):
    story = " ".join(f"one word{i} of a story{i % 50} goes on" for i in range(400))
    texts = [("BSD-2-Clause", f"{CONDITIONS}\n{DISCLAIMER}"), ("BSD-3-Clause", f"{CONDITIONS}{THIRD}\n{DISCLAIMER}")]
    texts += [(n, licences.whole_text(n)) for n in licences.TEXTS] + [(n, licences.whole_text(f"{n}.notice")) for n in licences.NOTICES]
    texts += [("LGPL-2.1", licences.whole_text("LGPL-2.1.notice").replace("version 2.1 of", "version 2 of"))]
    rows = [(2 * i + k, doc) for i, (_, t) in enumerate(texts) for k, doc in enumerate((t, f"{story}\n\n{t}\n\n{story}"))]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, (name, t) in enumerate(texts):
        for k in (0, 1):
            best = max(got[2 * i + k].matches, key=lambda m: m.n_words)
            assert best.licence == name and best.n_words > 0.9 * len(re.findall("[a-z0-9]+", t.lower())), (name, k)


def test_licence_passages_are_the_nearest_runs():
    rng = np.random.default_rng(5)
    for _ in range(150):
        pairs = rng.integers(0, rng.integers(6, 40), rng.integers(1, 60))
        own = set(range(int(rng.integers(2, 12))))
        hit, (before, after) = np.isin(pairs, list(own)), licences._neighbours(pairs)
        got = licences.passages(hit, before, after, len(own), 0.7)
        runs = [set(pairs[i:j].tolist()) for i in range(len(pairs)) for j in range(i + 1, len(pairs) + 1)]
        best = max(2 * len(r & own) / (len(r) + len(own)) for r in runs)
        assert (got[0][0] if got else 0) == pytest.approx(best if best >= 0.7 else 0)
        for d, i, j in got:
            r = set(pairs[i:j].tolist())
            assert d == pytest.approx(2 * len(r & own) / (len(r) + len(own)))


def test_size_bounds_prune_nothing_that_matches():
    for n in range(1, 60):
        low, high = licences.size_bounds(n, 0.85)
        for m in range(1, 90):
            if 2 * min(n, m) / (n + m) >= 0.85:
                assert low - 1e-9 <= m <= high + 1e-9


def test_fingerprints(spark, none):
    rows = [(i * 11 % 101, " ".join(f"w{(i * 37 + j * j) % 60}" for j in range(20 + i))) for i in range(60)]
    rows += [(500, "same text " * 40), (501, "same text " * 40), (502, ""), (503, None), (504, "🙂é" * 5)]
    got = {r.doc_id: r for r in imatch.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    text = {i: t or "" for i, t in rows}
    order = sorted(text)
    for i, j in zip(order, order[1:] + order[:1], strict=True):
        k = len(text[i]) // 4
        edited = text[i][: len(text[i]) - k] + text[j][:k]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(text[i])
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        if edited == text[i]:
            assert got[i].near_edited == 1.0
    assert got[500].fingerprint == got[501].fingerprint and got[500].near_next == 1.0
    assert imatch.fingerprints(none).count() == 0


def test_texts_without_lexicon_terms_are_told_apart(spark):
    common = " ".join(f"all{i}" for i in range(30))
    rows = [(i, common) for i in range(40)]  # in most documents: not in the lexicon
    rows += [(100 + i, f"all{i} all{i + 1} " * 200) for i in range(20)] + [(200, "all1 all0 " * 300), (201, "all0 all1")]
    rows += [(300 + i, f"few{i // 2} few{i // 2 + 1} " * 400) for i in range(20)]  # long, of two lexicon terms
    got = {r.doc_id: r for r in imatch.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    prints = defaultdict(set)
    for i, text in rows:
        prints[got[i].fingerprint].add(frozenset(text.split()))
    assert all(len(sets) == 1 for sets in prints.values())
    assert len(prints) == len({frozenset(t.split()) for _, t in rows})
    assert got[100].near_next == 0.0 and got[200].near_next == 1.0 and got[0].near_next == 1.0
    assert got[300].near_next == 1.0 and 0 < got[301].near_next < 1


def test_terms_thin_out_by_scale(spark):
    df = spark.range(-500, 500).select(F.xxhash64("id").alias("t"))
    for r in df.select("t", imatch.subset(F.col("t")).alias("s"), imatch.last_scale(F.col("t")).alias("last")).collect():
        for at in range(6):
            place = (r.t >> 7) % (imatch.SUBSETS << at)
            assert (r.last >= at) == (place < imatch.SUBSETS) and (place >= imatch.SUBSETS or place == r.s)


def test_fingerprints_of_odd_rows(spark, odd):
    got = imatch.fingerprints(odd).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in ROWS)
    assert len({r.fingerprint for r in got if r.doc_id in (6, 7)}) == 1
    one = odd.where("doc_id = 9")
    assert imatch.fingerprints(one).first().n_chars == len(ROWS[-1][1])
