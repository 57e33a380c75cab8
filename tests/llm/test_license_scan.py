import itertools
import random
import re
import re._parser
import string

from relaymart.llm import license_scan as ls
from tests_llm_rows import MESSY, doc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(text):
    """The report's columns, rule by rule."""
    ws = WORD.findall((text or "").translate(LOWER))
    base = [(label, k) for phrase, label in ls.BASE for k in range(len(ws))
            if ws[k:k + len(phrase.split())] == phrase.split()]
    line, found = f" {' '.join(ws)} ", []
    for rule in ls.rules():
        if set(rule["keywords"]) & set(ws):
            for m in re.finditer(f" (?:{rule['pattern']})(?= )", line):
                start = line[:m.start()].count(" ")
                found.append((start, -start - m.group().count(" "), rule["priority"], rule["id"], rule["label"], rule["weight"]))
    kept, reach = [], 0
    for d in sorted(found):
        if -d[1] <= reach:
            continue
        if kept and d[0] < -kept[-1][1]:
            if d[2] >= kept[-1][2]:
                continue
            kept.pop()
        kept.append(d)
        reach = max(reach, -d[1])
    places = [k for _, k in base]
    base_labels = {label for label, _ in base}
    return (len(ws), len(base), min(places, default=None), max(places, default=None), ",".join(sorted(base_labels)),
            ",".join(sorted(base_labels | {d[4] for d in kept})),
            max([0.0, *(d[5] for d in kept), *([ls.BASE_SCORE] if base else [])]))


def test_against_brute_force(corpus):
    rng = random.Random(1)
    pieces = ["Licensed under the MIT License.", "Apache License, Version 2.0", "CC BY-NC 4.0", "CC-BY-NC-SA 4.0 license",
              "under the", "MIT license", "GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0-only",
              "All rights reserved.", "released under the BSD 3-Clause License", "in the public domain", "é word 12",
              "This work is licensed under the Apache License, Version 2.0.", "Creative Commons Attribution 4.0 license",
              "PERMISSION IS HEREBY GRANTED, free of charge, to any person obtaining a copy of this software"]
    rows = [doc(1000 + i, rng.choice([" ", "\n", ", "]).join(rng.choices(pieces, k=rng.randint(0, 7)))) for i in range(150)]
    rows += MESSY + [doc(900, "licensed under the mit license " * 300)]
    docs = corpus([r for r in rows if r[0] is not None]).selectExpr("*", "1 as license_line", "'x' as labels")
    texts = {r[0]: r[1] for r in rows}
    for r in ls.report(docs).collect():
        assert tuple(r)[1:] == brute(texts[r.doc_id]), texts[r.doc_id]


def test_hundreds_of_rules():
    rules = ls.rules()
    assert len(rules) > 300
    for rule in rules:
        re.compile(rule["pattern"])


def test_written_rules_find_their_wording(corpus):
    """Each text rule finds its own wording, in capitals and with other signs between."""
    rows, labels = [], []
    for label, _, _, pattern, _ in ls.TEXTS:
        text = re.sub(r"\.\{0,\d+\}", "as said ", pattern)
        while (m := re.search(r"\((?:\?:)?([^()|]*)(?:\|[^()]*)?\)\??", text)):
            text = text[:m.start()] + m[1] + text[m.end():]
        text = re.sub(r"\[(.)[^\]]*\]", r"\1", text.split("|")[0]).replace(" ?", " ").replace("e?", "e").replace("s?", "s").replace("v ?", "v")
        rows.append(doc(len(rows), "Here: " + text.upper().replace(" ", ",  ", 2) + "."))
        labels.append(label)
    assert len(rows) > 110
    for r in ls.report(corpus(rows)).collect():
        assert tuple(r)[1:] == brute(rows[r.doc_id][1])
        assert r.labels, (labels[r.doc_id], rows[r.doc_id][1])


def test_time_is_linear_in_matches(corpus):
    import time

    took = {}
    for n in (16_000, 32_000, 64_000, 64_000):
        docs = corpus([doc(1, "under the mit license x " * n)])
        start = time.perf_counter()
        (row,) = ls.report(docs).collect()
        took[n] = time.perf_counter() - start
        assert (row.n_base, row.first_word, row.last_word) == (n, 0, 5 * (n - 1)) and row.labels == "mit"
    assert took[64_000] < 3 * took[32_000] + 1
    (kept,) = ls.scan(docs).selectExpr("size(license_detections) as n", "license_detections[63999].start as last").collect()
    assert (kept.n, kept.last) == (64_000, 5 * 63_999 + 1)


def test_no_python_in_the_plan(corpus):
    plan = ls.report(corpus(MESSY))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_null_ids_and_empty_tables(corpus):
    assert ls.report(corpus(MESSY)).count() == len(MESSY)
    assert ls.report(corpus([])).count() == 0


def test_line_ends_inside_words(corpus):
    text = " intro one{0}two under the MIT license{0} then, licensed under the{0} Apache License 2.0 {0} all rights reserved cc by{0} nc cc-by-nc"
    rows = [doc(i, text.format(c)) for i, c in enumerate("\u0085\u2028\u2029x")]
    for r in ls.report(corpus(rows)).collect():
        assert tuple(r)[1:] == brute(rows[r.doc_id][1])
        assert "all-rights-reserved" in r.labels and "cc-by-nc" in r.base_labels


def forms(pattern):
    """All texts that a pattern without + or * matches."""
    out = [""]
    for op, of in pattern if not isinstance(pattern, str) else re._parser.parse(pattern):
        kind = str(op)
        if kind == "LITERAL":
            some = [chr(of)]
        elif kind == "IN":
            some = [chr(c) for k, v in of for c in ([v] if str(k) == "LITERAL" else range(v[0], v[1] + 1))]
        elif kind == "MAX_REPEAT":
            some = ["".join(x) for k in range(of[0], of[1] + 1) for x in itertools.product(forms(of[2]), repeat=k)]
        else:
            some = forms(of[3]) if kind == "SUBPATTERN" else [x for branch in of[1] for x in forms(branch)]
        out = [a + b for a in out for b in some]
    return out


def test_every_form_has_a_keyword():
    for _, name, keywords in ls.NAMES:
        assert not [f for f in forms(name) if not set(f.split()) & set(keywords.split())]
    for *_, pattern, keywords in ls.TEXTS:
        assert not [f for f in forms(pattern) if not set(f.split()) & set(keywords.split())]


def brute_ungated(text, rules=tuple((rule, re.compile(f" (?:{rule['pattern']})(?= )")) for rule in ls.rules())):
    """Detections of all rules, run on every text."""
    line, found = f" {' '.join(WORD.findall((text or '').translate(LOWER)))} ", set()
    for rule, pattern in rules:
        for m in pattern.finditer(line):
            start = line[:m.start()].count(" ")
            found.add((start, -start - m.group().count(" "), rule["priority"], rule["id"]))
    kept, reach = [], 0
    for d in sorted(found):
        if -d[1] <= reach or kept and d[0] < -kept[-1][1] and d[2] >= kept[-1][2]:
            continue
        if kept and d[0] < -kept[-1][1]:
            kept.pop()
        kept.append(d)
        reach = max(reach, -d[1])
    return kept


def test_scan_equals_all_rules_without_a_gate(corpus):
    rng = random.Random(2)
    names = [rng.choice(forms(name)) for _, name, _ in ls.NAMES for _ in range(2)]
    names += ["apache2", "apachev2", "gpl1", "gpl2", "gpl3", "lgplv2", "lgpl2", "lgpl2 1", "lgpl3", "agpl3"]
    verbs = ["released", "Distributed", "published", "provided", "AVAILABLE", "covered", "redistributed"]
    texts = [rng.choice(pattern).format(name, v=rng.choice(verbs), s=rng.choice([" ", "\n", "  ", ",\t", " - "]))
             for name in names for pattern in (["{v}{s}under{s}the {0}", "{v}{s}under {0}"],
                                               ["licensed{s}under {0}", "the {0}{s}licence", "SPDX-License-Identifier:{s}{0}"])]
    texts += [rng.choice([" ", "\n"]).join(f.split()) for *_, pattern, _ in ls.TEXTS for f in forms(pattern)[:8]]
    found = ls.scan(corpus([doc(i, t) for i, t in enumerate(texts)])).collect()
    assert len(found) == len(texts)
    for r in found:
        assert [tuple(x)[:4] for x in r.license_detections] == brute_ungated(r.text), r.text
    assert all(r.license_detections for r in found if "under" in r.text)
