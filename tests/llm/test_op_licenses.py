import random

from corpus_cases import documents, odd_texts

from skyloom.llm import licenses
from skyloom.llm.license_texts import TEMPLATES
from skyloom.llm.queries import QUERIES

MIT = TEMPLATES["MIT"]


def scan(text):
    found = licenses.Scanner(TEMPLATES, 0.85).scan(text)
    return [(name, text[a:b]) for name, _, a, b in found]


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for word in a:
        last = 0
        for j, other in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if word == other else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_against_the_longest_common_subsequence():
    rng = random.Random(0)
    template = licenses.words_of(MIT)
    for _ in range(40):
        copy = [w if rng.random() > 0.1 else "other" for w in template]
        copy = [w for w in copy if rng.random() > 0.03]
        pairs = licenses.align(template, copy)
        assert all(template[i] == copy[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) >= 0.97 * longest_common(template, copy)


def test_increasing_is_longest():
    rng = random.Random(1)
    for _ in range(100):
        places = rng.sample(range(40), 12)
        chain = licenses.increasing(list(enumerate(places)))
        best = [1] * 12
        for i in range(12):
            best[i] += max((best[j] for j in range(i) if places[j] < places[i]), default=0)
        assert len(chain) == max(best)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(chain, chain[1:]))


def test_whole_edited_and_repeated_texts():
    assert [n for n, _ in scan("x " * 300 + MIT + " y " * 500 + MIT.upper())] == ["MIT", "MIT"]
    rng = random.Random(2)
    edited = " ".join(w if rng.random() > 0.08 else "foo" for w in MIT.split())
    assert [n for n, _ in scan("some words " * 50 + edited)] == ["MIT"]
    half = " ".join(MIT.split()[:80])
    assert scan(half) == []


def test_the_closest_template_wins():
    assert scan("Licensed under CC BY-NC 4.0.") == [("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0")]
    assert scan("İ ß all RIGHTS reserved. ß") == [("all-rights-reserved", "all RIGHTS reserved")]
    gpl = "This work is licensed under the GNU General Public License, version 2."
    assert [n for n, _ in scan(gpl)] == ["GPL-2.0-notice"]
    assert scan("licensed under the terms of the house") == []


def test_odd_texts(spark):
    rows = odd_texts() + [(20, "All rights reserved."), (20, "All rights reserved."), (None, MIT)]
    df = licenses.license_passages(documents(spark, rows))
    found = sorted((r["doc_id"] or 0, r["license_id"], r["coverage"]) for r in df.collect())
    assert found == [(0, "MIT", 1.0), *[(20, "all-rights-reserved", 1.0)] * 2]
    assert licenses.license_passages(documents(spark, [])).count() == 0
    assert licenses.license_passages(documents(spark, rows), {}).count() == 0


def test_query_finds_all_planted_lines(spark):
    sf_dir = "/root/testdata/sf0.01"
    lines = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0-notice",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-notice",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0-notice",
        "Released under the MIT License.": "MIT-notice",
        "All rights reserved.": "all-rights-reserved",
    }
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    wanted = sorted(
        (r["doc_id"], name) for r in docs for line, name in lines.items()
        for _ in range(r["text"].count(line))
    )
    found = QUERIES["op8_license_scan"](spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["license_id"]) for r in found) == wanted


def test_long_templates_of_few_words():
    rng = random.Random(4)
    template = [f"w{rng.randrange(70)}" for _ in range(700)]
    edited = [w if rng.random() > 0.05 else "other" for w in template]
    pairs = licenses.align(template, edited)
    assert len(pairs) == longest_common(template, edited)
    scanner = licenses.Scanner({"long": " ".join(template)}, 0.85)
    text = "before it " * 30 + " ".join(edited) + " and after" * 30
    assert [(n, c >= 0.9) for n, c, _, _ in scanner.scan(text)] == [("long", True)]


def test_a_gap_of_equal_words_is_aligned_in_full():
    pairs = licenses.align(["a", "b"] * 60 + ["c"] * 90, ["b", "a", "a"] * 50 + ["d"] + ["c"] * 80)
    assert len(pairs) >= longest_common(["a", "b"] * 60 + ["c"] * 90, ["b", "a", "a"] * 50 + ["d"] + ["c"] * 80)


def test_copies_that_follow_at_once_and_miss_their_front():
    rest = " ".join(MIT.split()[5:])
    assert [n for n, _ in scan(f"{MIT} {rest}")] == ["MIT", "MIT"]
    assert [n for n, _ in scan(f"{MIT} {rest} {rest} {MIT}")] == ["MIT"] * 4


def test_planted_copies_against_a_plain_search():
    """Disjoint copies with edits: found where the longest common subsequence covers the template."""
    rng = random.Random(6)
    template = licenses.words_of(MIT)
    scanner = licenses.Scanner({"MIT": MIT}, 0.85)
    for _ in range(30):
        copies, text, at = [], [], []
        for _ in range(rng.randrange(1, 4)):
            text += [f"own{rng.randrange(999)}" for _ in range(rng.randrange(200, 300))]
            share = rng.choice([0.0, 0.05, 0.12, 0.3])
            copy = [w if rng.random() >= share else "edited" for w in template]
            copies.append(longest_common(template, copy) / len(template))
            at.append(len(text))
            text += copy
        found = scanner.scan(" ".join(text))
        sure = [c for c in copies if c >= 0.88]
        able = [c for c in copies if c >= 0.85]
        assert len(sure) <= len(found) <= len(able)
