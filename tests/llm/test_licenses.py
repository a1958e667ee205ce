import itertools
import re
from re import _constants as op
from re import _parser

import pytest

from dqspark.llm.license_rules import GRANT, MENTION, RULES, TAG, Rule
from dqspark.llm.licenses import any_of, op5_license_rules, scan
from tests.llm.tables import make_docs


def slow_words(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def slow(text, rules):
    whole, found = f" {' '.join(slow_words(text))} ", []
    for number, rule in enumerate(rules):
        if any(not k or f" {k} " in whole for k in rule.keywords):
            for m in re.finditer(f" ({rule.regex})(?= )", whole):
                first = whole[: m.start() + 1].count(" ") - 1
                found.append((first, first + m[1].count(" "), rule.priority, number, rule.label))
    out = []
    for x in found:
        over = [y for y in found if y is not x and y[0] <= x[0] and y[1] >= x[1]]
        longer = lambda y: y[1] - y[0] > x[1] - x[0] or (y[:2] == x[:2] and y[3] < x[3])
        if not any(y[2] > x[2] or (y[2] == x[2] and longer(y)) for y in over):
            out.append((x[0], x[1], x[4], x[3]))
    return sorted(out)


TEXTS = [
    "SPDX-License-Identifier: GPL-2.0-or-later",
    "Licensed under the Apache License, Version 2.0 (the License); see the Apache License.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0. And cc by, cc by cc-by. CC BY",
    "Permission is hereby granted, free of charge, to any person obtaining a copy. MIT License. Expat license",
    "Copyright (c) 2019 2020 Someone. All rights reserved. All copyrights are held by us",
    "GNU General Public License v2.0 or any later version; GNU Lesser General Public License version 2.1",
    "new BSD license, 3-clause BSD, BSD 2 Clause License and FreeBSD",
    "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "released into the public domain. unlicense. Llama 3 Community License Agreement",
    "Ünder the 漢字 license, MIT", "mit license " * 200, "licensed " * 50, None, "", " .,; ", "no keyword at all",
]


def test_like_all_rules_on_all_texts(spark):
    docs = make_docs(spark, [(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (None, TEXTS[1])])
    for rules in (RULES, RULES[::-1]):
        rows = scan(docs, rules=rules).collect()
        assert len(rows) == len(TEXTS) + 2
        for r in rows:
            text = TEXTS[1] if r.id is None else TEXTS[r.id]
            assert [(d["first"], d["last"], d["label"], d["number"]) for d in r.detections] == slow(text, rules)
            assert r.n_words == len(slow_words(text))


@pytest.mark.parametrize("text", [t for t in TEXTS if t])
def test_keywords_miss_no_match(text):
    always = [r._replace(keywords=("",)) for r in RULES]
    whole = [(a, b, label, n) for a, b, label, n in slow(text, always)]
    assert slow(text, RULES) == whole


def samples(parsed):
    """Texts that match a parsed pattern: each branch, optional part and listed letter, in all combinations."""
    return ["".join(parts) for parts in itertools.product(*[some(kind, value) for kind, value in parsed])]


def some(kind, value):
    if kind is op.LITERAL:
        return [chr(value)]
    if kind is op.NOT_LITERAL:
        return ["x"]
    if kind is op.IN:
        return ["x"] if value[0][0] is op.NEGATE else [chr(c) for k, v in value for c in ([v] if k is op.LITERAL else v[:1])]
    if kind is op.BRANCH:
        return [t for branch in value[1] for t in samples(branch)]
    if kind is op.SUBPATTERN:
        return samples(value[-1])
    assert kind in (op.MAX_REPEAT, op.MIN_REPEAT), kind
    least, most, inner = value
    return [t * n for t in samples(inner) for n in {least, min(most, least + 1)}]


def test_keywords_miss_no_alternative_of_any_rule():
    for rule in RULES:
        for text in set(samples(_parser.parse(rule.regex))):
            whole = f" {text} "
            assert re.search(f" ({rule.regex})(?= )", whole), (rule, text)
            assert any(f" {k} " in whole for k in rule.keywords), (rule, text)


def test_name_of_wtfpl(spark):
    name = "Do What The Fuck You Want To Public License"
    for text, number in ((name, MENTION), (f"Released under the terms of the {name}.", GRANT)):
        row = scan(make_docs(spark, [(1, text)])).first()
        assert [(d["label"], RULES[d["number"]].priority) for d in row.detections] == [("wtfpl", number)]


def test_suppression():
    rules = (
        Rule("low", MENTION, 0.5, ("a",), "a b c d"), Rule("high", GRANT, 0.5, ("b",), "b c"),
        Rule("top", TAG, 0.5, ("x",), "x a b c d y"), Rule("same", MENTION, 0.5, ("a",), "a b c d"),
    )
    assert [x[2] for x in slow("a b c d", rules)] == ["low", "high"]
    assert [x[2] for x in slow("x a b c d y", rules)] == ["top"]


@pytest.mark.parametrize(
    "text,labels",
    [
        ("SPDX License Identifier MIT", {"mit"}),
        ("available under the terms of the Mozilla Public License, v. 2.0", {"mpl-2.0"}),
        ("GNU Affero General Public License version 3", {"agpl-3.0"}),
        ("dedicated to the public domain", {"public-domain"}),
        ("the quick brown fox", set()),
    ],
)
def test_labels(spark, text, labels):
    row = scan(make_docs(spark, [(1, text)])).first()
    assert {d["label"] for d in row.detections} == labels


def test_there_are_hundreds_of_rules_and_all_compile():
    assert len(RULES) > 250 and len(set(RULES)) == len(RULES)
    for rule in RULES:
        re.compile(rule.regex)
        assert rule.keywords and all(re.fullmatch(r"[a-z0-9 ]+", k) for k in rule.keywords)


def test_trie_matches_the_same():
    words = ["gpl", "gp", "apache", "apple", "bsd", "b"]
    pattern = re.compile(any_of(words))
    for text in ("xgp", "appl", "apple", "apach", "apache", "ab", ""):
        assert bool(pattern.search(text)) == any(w in text for w in words)


def slow_base(text):
    words, places, labels = slow_words(text), [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        found = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_query_on_texts(spark, tmp_path, awkward):
    texts = TEXTS + ["cc by cc by", "all rights reserved all rights reserved x", "general public license cc by"]
    make_docs(spark, list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    for r in op5_license_rules(spark, str(tmp_path)).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == slow_base(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))
        assert (r.score > 0) == bool(r.labels)


def test_awkward_rows_and_no_python(awkward, nothing):
    found = scan(awkward)
    assert found.count() == awkward.count() and scan(nothing).count() == 0
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
