import re

import pytest
from cases import ODD, docs, words
from daybook.llm import licenses as C

MIT = C.TEMPLATES[0].text


def slow_base(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    starts, labels = [], set()
    for t in C.PHRASES:
        p = t.text.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                starts.append(i)
                labels.add(t.label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


TEXTS = [
    "Released under the MIT License. MIT License, again: mit-license!", "GNU General Public License GNU GENERAL PUBLIC LICENSE", "cc by cc by-nc CC BY",
    "Apache\nLicense", "apache é license", "mit", "MIT LICENSE", "gnu general public gnu general public license",
    "\u212aelvin apache licen\u017fe", " ".join(["cc", "by"] * 500),
]


def test_base_against_plain_loops(spark):
    rows = ODD + [(50 + i, t, "en", "a", 1) for i, t in enumerate(TEXTS)]
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in C.scan(docs(spark, rows, clash=("row", "n_words", "p", "label"))).collect())
    assert got == sorted((r[0] or 0, *slow_base(r[1])) for r in rows)


def test_templates_in_part_and_with_changes(spark):
    w = MIT.split()
    texts = {1: MIT, 2: " ".join(w[:14] + ["really", "truly"] + w[14:]), 3: " ".join(w[3:-3]), 4: " ".join(w[:6]), 5: words(50, 5) + " " + MIT.upper() + " " + words(50, 6),
             6: " ".join(reversed(w)), 7: words(300, 7), 8: "licensed under CC BY-NC 4.0"}
    got = {r["doc_id"]: r for r in C.scan(docs(spark, [(i, t, "en", "a", 1) for i, t in texts.items()])).collect()}
    assert [i for i in sorted(got) if "mit" in got[i]["labels"].split(",")] == [1, 2, 3, 5]
    assert got[1]["score"] == pytest.approx(1) and got[1]["base_labels"] == "" and 0.1 < got[4]["score"] < C.COVER
    assert got[8]["labels"] == "cc-by,cc-by-nc" and got[7]["labels"] == "" and got[7]["score"] == 0


def test_spans_tell_where(spark):
    text = words(20, 3) + " " + MIT
    rows = C.spans(C.votes(docs(spark, [(1, text, "en", "a", 1)]))).where("template >= 0 AND cover >= 0.6").collect()
    assert [(r["first"], r["last"], r["label"]) for r in rows] == [(20, 20 + len(MIT.split()) - 1, "mit")]


def test_too_short_and_too_long_templates():
    for text in ("one", " ".join(f"w{i}" for i in range(200))):
        with pytest.raises(ValueError):
            C.gram_rows((C.Template("x", text),))


def test_empty_table(spark):
    assert C.scan(docs(spark, [])).count() == 0
