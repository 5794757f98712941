import random
import re

from regionflow.llm import licenses as li


def plain_words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def slow(text):
    w = plain_words(text)
    out = set()
    for i, (_, body) in enumerate(li.TEMPLATES):
        t = plain_words(body)
        want = {" ".join(t[k : k + 5]) for k in range(len(t) - 4)}
        if not want:
            continue
        size, step = li.window(li.size_class(len(want)))
        for start in range(0, max(len(w), 1), step):
            part = w[start : start + size + 4]
            have = {" ".join(part[k : k + 5]) for k in range(len(part) - 4)}
            if len(want & have) / len(want) >= li.CONTAINMENT:
                out.add(i)
    return out


def test_settings():
    for c in (4, 8, 16, 64, 128):
        s = li.least_similarity(c)
        bands, rows = li.band_settings(s)
        assert (1 - s**rows) ** bands <= li.MISS and bands * rows <= 64
        size, step = li.window(c)
        assert size - c >= step - 1  # an occurrence lies whole in some window


def test_scan_equals_brute_force(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdeé1") for _ in range(rng.randint(1, 6)))
    texts = [None, "", "too few words", "x " * 30_000 + li.TEMPLATES[1][1]]
    for i, (_, body) in enumerate(li.TEMPLATES):
        around = lambda: " ".join(word() for _ in range(rng.randint(0, 40)))
        texts.append(f"{around()} {body.upper()} {around()}")
        changed = body.split()
        for _ in range(max(1, len(changed) // 40)):
            changed[rng.randrange(len(changed))] = word()
        texts.append(f"{around()}\n{' '.join(changed)} -- {around()}")
        texts.append(" ".join(body.split()[: len(body.split()) // 2]))
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(None, texts[4], "y"), (5, texts[5], "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, h string")
    got = li.find_licenses(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert {m.template for m in r.matches} == slow(texts[4] if r.k_id is None else texts[r.k_id]), r
    assert li.find_licenses(df.limit(0)).count() == 0


def test_rivals_that_share_their_text(spark):
    body = dict(li.TEMPLATES[:18])  # the last, that is the long, one of each name
    warranty = body["GPL-3.0"][body["GPL-3.0"].index("This program is distributed") :]
    filler = "other words " * 400
    texts = {
        "BSD-2-Clause": f"{body['BSD-2-Clause']} THIS SOFTWARE IS PROVIDED AS IS",
        "BSD-3-Clause": f"{body['BSD-3-Clause'].replace('copyright holder nor', 'Example Organization nor')} THIS SOFTWARE IS PROVIDED AS IS",
        "GPL-3.0": body["GPL-3.0"],
        "GPL-2.0": f"{body['GPL-2.0']} {warranty}",
        "BSD-2-Clause,BSD-3-Clause": f"{body['BSD-3-Clause']} {filler} {body['BSD-2-Clause']}",
        "GPL-2.0,GPL-3.0": f"{body['GPL-2.0']} {warranty} {filler} {body['GPL-3.0']}",
        "CC-BY-4.0,GPL-3.0": f"{li.TEMPLATES[5][1]}. {body['CC-BY-4.0']}.",
        "Apache-2.0,MIT": f"{li.TEMPLATES[0][1]} {li.TEMPLATES[2][1]}",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    got = {r.k_id: ",".join(sorted({m.spdx for m in r.matches if not m.outdone})) for r in li.find_licenses(df).collect()}
    assert got == {k: k for k in texts}


def names_of(spark, texts, **how):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.k_id: sorted({m.spdx for m in r.matches if not m.outdone}) for r in li.find_licenses(df, **how).collect()}
    return [got[i] for i in range(len(texts))]


def test_names_of_one_family_are_told_apart(spark):
    notice = li.NOTICE + " This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} General Public License for more details."
    texts = [
        notice.format(work="program", name="", version="3"), notice.format(work="program", name="Affero", version="3"),
        notice.format(work="library", name="Lesser", version="3"), notice.format(work="library", name="Lesser", version="2.1"),
        dict(li.TEMPLATES)["BSD-2-Clause"] + " THIS SOFTWARE IS PROVIDED AS IS", "Licensed under CC BY 4.0", "Licensed under the MIT license.", "Licensed under CC BY-SA 4.0",
    ]
    assert names_of(spark, texts) == [["GPL-3.0"], ["AGPL-3.0"], ["LGPL-3.0"], ["LGPL-2.1"], ["BSD-2-Clause"], ["CC-BY-4.0"], ["MIT"], ["CC-BY-SA-4.0"]]


def test_templates_of_a_folder(spark, tmp_path):
    rng = random.Random(2)
    bodies = {n: " ".join(f"{n}{rng.randrange(900)}" for _ in range(1500)) for n in ("alpha", "beta")}
    for n, t in bodies.items():
        (tmp_path / f"{n}.txt").write_text(t)
    templates = li.read_templates(spark, str(tmp_path))
    assert templates == sorted(bodies.items())
    texts = [f"before {bodies['alpha']} after", " ".join(bodies["beta"].split()[100:]), bodies["beta"][:3000], "none of them at all here"]
    assert names_of(spark, texts, templates=templates) == [["alpha"], ["beta"], [], []]
