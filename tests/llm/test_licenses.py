import random

import pytest

from tidemark.llm import licenses as lc


def full_alignment(template, words):
    """Local alignment over the whole table; matched words of the best."""
    best = (0, 0)
    before = [(0, 0)] * (len(words) + 1)
    for t in template:
        row = [(0, 0)]
        for j, w in enumerate(words):
            s, m = before[j]
            cell = (s + 1, m + 1) if t == w else (s - 1, m)
            for s, m in (before[j + 1], row[j]):
                cell = max(cell, (s - 1, m))
            row.append(cell if cell[0] > 0 else (0, 0))
        best = max(best, max(row))
        before = row
    return best[1]


def share_run(a, b, n):
    runs = {tuple(a[i : i + n]) for i in range(len(a) - n + 1)}
    return any(tuple(b[i : i + n]) in runs for i in range(len(b) - n + 1))


def edited(text, rng, rate):
    out = []
    for w in text.split():
        r = rng.random()
        if r < rate / 3:
            continue
        out.append("qqqq" if r < 2 * rate / 3 else w)
        if r > 1 - rate / 3:
            out.append("zzzz")
    return " ".join(out)


@pytest.mark.parametrize("rate", [0.0, 0.04, 0.1])
def test_findings_equal_full_alignment(rate):
    rng, index = random.Random(int(rate * 100)), lc.Templates(lc.TEMPLATES)
    for name, template in lc.TEMPLATES.items():
        noise = [" ".join("".join(rng.choice("aeiourst") for _ in range(5)) for _ in range(80)) for _ in range(2)]
        text = noise[0] + ". " + edited(template, rng, rate) + " " + noise[1]
        words = lc.words_of(text)[0]
        own = lc.words_of(template)[0]
        matched = full_alignment(own, words)
        found = [f for f in index.find(text, 0.8) if f[0] == name]
        telling = index.telling[index.names.index(name)] <= set(words)
        if matched >= 0.8 * len(own) and telling and share_run(own, words, lc.GRAM + lc.WINDOW - 1):
            assert len(found) == 1 and found[0][2] == matched, name
            if rate == 0:
                assert lc.words_of(text[found[0][3] : found[0][4]])[0] == own
        elif matched < 0.8 * len(own) or not telling:
            assert not found


def test_each_template_is_only_itself():
    index = lc.Templates(lc.TEMPLATES)
    for name, template in lc.TEMPLATES.items():
        assert [(f[0], f[1]) for f in index.find(f"Some words before. {template} Some words after.", 0.8)] == [(name, 1.0)]


def test_lines_of_one_family_are_told_apart():
    index = lc.Templates(lc.TEMPLATES)
    names = lambda text: [f[0] for f in index.find(text, 0.8)]
    line = next(t for n, t in lc.TEMPLATES.items() if n.startswith("cc-by-nc"))
    assert [n.startswith("cc-by-nc") for n in names(f"{line} {line}")] == [True, True]
    gpl = next(t for n, t in lc.TEMPLATES.items() if n == "gpl-3.0-line")
    assert names(gpl) == ["gpl-3.0-line"] and names(gpl.replace("3", "2")) == []
    mit = lc.TEMPLATES["mit-line"]
    assert names(mit.replace("MIT", "BSD")) == []


def test_every_occurrence_is_found_and_clean_text_is_not():
    index = lc.Templates({"mit-line": lc.TEMPLATES["mit-line"]})
    text = "Zebra crossing. " + "Released under the MIT License. " * 3 + "end " + "released UNDER the mit license"
    assert [f[1] for f in index.find(text, 0.8)] == [1.0] * 4
    assert index.find("The permission of the license office was released yesterday under the old bridge.", 0.8) == []


def test_odd_rows(spark, odd_docs, no_docs):
    assert lc.scan_licenses(odd_docs).count() == 0 and lc.scan_licenses(no_docs).count() == 0
    docs = spark.createDataFrame([(1, "x " * 50_000 + "Released under the MIT License."), (None, "Released under the MIT License."), (1, "x " * 50_000 + "Released under the MIT License.")], "doc_id long, text string")
    rows = lc.scan_licenses(docs).collect()
    assert sorted((r.doc_id or 0, r.template, r.span_start) for r in rows) == [(0, "mit-line", 0), (1, "mit-line", 100_000), (1, "mit-line", 100_000)]
    assert lc.scan_licenses(docs, templates={}).count() == 0
