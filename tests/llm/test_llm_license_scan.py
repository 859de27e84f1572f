"""License scans against a longest-common-subsequence reference."""

import random
import re
import time
from fractions import Fraction

import pytest

from quire.llm import license_scan as L


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_alignment_is_increasing_and_never_beats_lcs():
    rng = random.Random(1)
    for _ in range(300):
        a = rng.choices("abcdefgh", k=rng.randint(0, 14))
        b = rng.choices("abcdefgh", k=rng.randint(0, 14))
        pairs = L.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) <= lcs(a, b)


def test_alignment_is_a_full_lcs_when_words_are_unique():
    rng = random.Random(2)
    for _ in range(200):
        a, b = (rng.sample(range(12), k=rng.randint(0, 12)) for _ in range(2))
        a, b = [str(x) for x in a], [str(x) for x in b]
        # equal ends first, then the longest increasing chain of the rest
        assert len(L.align(a, b)) >= lcs(a, b) - 2
        chain = L.increasing([(i, b.index(w)) for i, w in enumerate(a) if w in b])
        assert len(chain) == lcs(a, b)


def edited(rng, words, edits, keep):
    """Random edits of words that do not decide which license it is."""
    words = list(words)
    for _ in range(edits):
        k = rng.choice([k for k in range(1, len(words) - 1) if words[k] not in keep])
        words[k:k + 1] = rng.choice([[], ["zzz"], [words[k], "yyy"]])
    return words


def test_every_template_is_found_anywhere_and_repeatedly():
    rng, scanner = random.Random(3), L.Scanner(L.TEMPLATES)
    for name, template in L.TEMPLATES.items():
        seq = L.words(template)
        text = ["foo"] * 9 + seq + ["bar"] * 4 + seq + ["baz"]
        hits = [m for m in scanner.scan(" ".join(text)) if m[0] == name]
        assert [(c, a, b) for _, c, a, b in hits] == [(1.0, 9, 9 + len(seq)), (1.0, 13 + len(seq), 13 + 2 * len(seq))]
        if len(seq) > 40:
            noisy = edited(rng, seq, len(seq) // 12, {"apache", "2.0", "gnu", "3"})
            hits = [m for m in scanner.scan("head " + " ".join(noisy) + " tail") if m[0] == name]
            assert len(hits) == 1 and hits[0][1] >= 0.8


def agrees(seq, window, pairs):
    """The rule on deciding words, spelled out for the templates here."""
    aligned, inside = {seq[j] for _, j in pairs}, set(window[:pairs[-1][0] + 1]) - set(seq)
    deciding = "apache mit bsd gnu cc creative".split()
    if len(seq) <= 20:
        deciding += "general public affero lesser library by nc sa nd commons attribution".split()
    version = re.compile(r"\d\d?(\.\d+)*$")
    if any((w in deciding or version.match(w)) and w not in aligned for w in seq):
        return False
    bad = ["affero", "lesser", "library"] if "gnu" in seq else []
    if "cc" in seq or "creative" in seq:
        bad += "nc sa nd non commercial noncommercial share alike sharealike noderivatives noderivs derivatives".split()
    return not inside & set(bad) and not (any(map(version.match, seq)) and any(map(version.match, inside)))


def unfiltered(words, seq, coverage):
    """Places by aligning at every word, without the prefilter."""
    out, done, width = [], 0, int(len(seq) * L.SPREAD) + 1
    for start in range(len(words)):
        window = words[start:start + width]
        pairs = L.align(window, seq) if start >= done else []
        if pairs and pairs[0][0] == 0 and len(pairs) >= Fraction(str(coverage)) * len(seq) and agrees(seq, window, pairs):
            done = start + pairs[-1][0] + 1
            out.append((len(pairs) / len(seq), start, done))
    return out


def test_the_allowed_number_of_words_may_miss():
    rng = random.Random(4)
    own = {f"{n} words": " ".join(f"w{i}x" for i in range(n)) for n in (1, 5, 10, 15, 20)}
    for coverage in (0.6, 0.7, 0.8, 0.9, 1.0):
        templates = {**L.TEMPLATES, **own}
        scanner, found = L.Scanner(templates, coverage), 0
        for name, template in templates.items():
            seq = L.words(template)
            free = int((1 - Fraction(str(coverage))) * len(seq))
            for missing in {free, free + 1} - {len(seq)}:
                out = set(rng.sample(range(len(seq)), missing))
                text = ["foo"] * 3 + [w for i, w in enumerate(seq) if i not in out] + ["bar"] * 4
                got = [m[1:] for m in scanner.scan(" ".join(text)) if m[0] == name]
                assert got == unfiltered(text, seq, coverage)
                if name in own:
                    assert len(got) == (missing == free)
                found += len(got)
        assert found > len(own)


def test_short_notice_without_a_word():
    assert L.Scanner(L.TEMPLATES).scan("Released under MIT License.") == [("MIT notice", 0.8, 0, 4)]


@pytest.mark.parametrize("text,want", [
    ("Licensed under CC BY-SA 4.0", []),
    ("Licensed under CC BY-NC-SA 4.0", []),
    ("Licensed under CC BY-NC-ND 4.0.", []),
    ("Licensed under CC BY 4.0", []),
    ("Licensed under CC BY-NC 3.0", []),
    ("Licensed under the CC BY-NC 4.0", ["CC-BY-NC-4.0 notice"]),
    ("This work is licensed under the GNU General Public License, version 2.", []),
    ("This work is licensed under the GNU General Public License, version 2 or 3.", []),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", []),
    ("This work is licensed under the GNU Affero General Public License, version 3.", []),
    ("This work is licensed under GNU General Public License version 3", ["GPL-3.0 notice"]),
    ("This work is licensed under the GNU General Public License (2007), version 3", ["GPL-3.0 notice"]),
    ("Licensed under the Apache License, Version 1.1.", []),
    ("Licensed under the Apache License, Version 1.1 or 2.0.", []),
    ("Licensed under Apache License, Version 2.0", ["Apache-2.0 notice"]),
    ("Licensed under the MIT or the Apache License, Version 2.0", ["Apache-2.0 notice"]),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", []),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", []),
    ("This work is licensed under a Creative Commons Attribution Non-Commercial 4.0 International License.", []),
    ("This work is licensed under a Creative Commons Attribution 3.0 Unported License.", []),
    ("This work is licensed under the Creative Commons Attribution 4.0 License.", ["CC-BY-4.0 notice"]),
    ("Released under the BSD License.", []),
    ("Released under the ISC License.", []),
    ("Released under the MIT License", ["MIT notice"]),
])
def test_deciding_words(text, want):
    assert [m[0] for m in L.Scanner(L.TEMPLATES).scan(text)] == want


def test_versions_of_long_templates():
    scanner = L.Scanner(L.TEMPLATES)
    for name, old, new in (("GPL header", "version 3", "version 2"), ("Apache-2.0 header", "2.0", "1.1")):
        assert [m[0] for m in scanner.scan(L.TEMPLATES[name])] == [name]
        assert scanner.scan(L.TEMPLATES[name].replace(old, new)) == []
    assert scanner.scan(L.TEMPLATES["GPL header"].replace("GNU\n        General", "GNU Lesser General")) == []


def test_the_template_with_the_most_words_wins():
    header = L.TEMPLATES["Apache-2.0 header"]
    text = header + " and " + L.TEMPLATES["Apache-2.0 notice"]
    assert [m[0] for m in L.Scanner(L.TEMPLATES).scan(text)] == ["Apache-2.0 header", "Apache-2.0 notice"]
    one = L.Scanner({"b": "x y z", "a": "x y z", "c": "x y z u v"})
    assert [m[:2] for m in one.scan("x y z u")] == [("c", 0.8)] and one.scan("x y z")[0][0] == "a"


def test_longest_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a, b = (rng.choices("abcdef", k=rng.randint(0, 15)) for _ in range(2))
        places = {}
        for j in range(len(b) - 1, -1, -1):
            places.setdefault(b[j], []).append(j)
        assert L.longest_common(a, places) == lcs(a, b)


def test_words_in_the_wrong_order_take_linear_time():
    scanner = L.Scanner(L.TEMPLATES)
    backwards = " ".join(L.words(L.TEMPLATES["MIT"])[::-1])
    text = " ".join([backwards] * (300_000 // len(backwards)))
    start = time.process_time()
    assert scanner.scan(text) == []
    assert time.process_time() - start < 1.0


def test_clean_text_has_no_match():
    scanner = L.Scanner(L.TEMPLATES)
    assert scanner.scan("the general public is licensed to drive under version control of the work " * 50) == []
    assert scanner.scan(None) == scanner.scan("") == scanner.scan("...") == []


def test_rows(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [(1, "a\n" + notice, 1), (1, "a\n" + notice, 1), (2, None, None), (3, "", 2), (None, "x " * 200_000 + notice, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Matches int")
    got = L.scan(df)
    assert got.columns == ["doc_id", "text", "matches"]
    found = [(r.doc_id, [(m.license, m.first) for m in r.matches]) for r in got.collect()]
    assert found == [(1, [("Apache-2.0 notice", 1)])] * 2 + [(2, []), (3, []), (None, [("Apache-2.0 notice", 200_000)])]
    assert L.scan(df.limit(0)).collect() == []


def test_data_lines_are_all_found(spark):
    import os
    path = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("driver tables absent")
    names = ("Apache-2.0 notice", "MIT notice", "GPL-3.0 notice", "CC-BY-NC-4.0 notice")
    df = spark.read.parquet(path)
    found = 0
    for r in L.scan(df.select("doc_id", "text")).collect():
        for n in names:
            want = r.text.count(L.TEMPLATES[n])
            assert sum(m.license == n for m in r.matches) == want
            found += want
    assert found
