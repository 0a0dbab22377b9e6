import random
import re
from re import _parser

import pytest

from tidemark.llm import license_scan, queries
from tidemark.llm.license_scan import RULES, Rule, Scanner, required_words

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))


def brute_force(text, rules=RULES):
    """All rules at every word, and every pair of detections."""
    ws = words(text)
    line, starts = b"", []
    for w in ws:
        starts.append(len(line))
        line += w.encode() + b" "
    found = []
    for number, rule in enumerate(rules):
        i = 0
        expression = re.compile(rule.expression.encode() + b"(?= )")
        while i < len(ws):
            if m := expression.match(line, starts[i]):
                n = m[0].count(b" ") + 1
                found.append((rule.rank, -n, i, number, i + n - 1))
                i += n
            else:
                i += 1
    kept = [d for d in found if not any(e < d and e[2] <= d[2] and d[4] <= e[4] for e in found)]
    base = [(i, label) for phrase, label in PHRASES.items() for i in range(len(ws)) if ws[i : i + len(phrase.split())] == phrase.split()]
    labels = sorted({label for _, label in base} | {rules[d[3]].label for d in kept})
    at = [i for i, _ in base]
    return (
        len(ws), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in base})), ",".join(labels),
        max((license_scan.CONFIDENCE[d[0]] for d in kept), default=0.0),
    )


def sample(tree, draw):
    """A text that an expression matches."""
    out = ""
    for kind, value in tree:
        name = str(kind)
        if name == "LITERAL":
            out += chr(value)
        elif name == "MAX_REPEAT":
            low, high, inner = value
            for _ in range(draw.randint(low, min(high, low + 3))):
                out += sample(inner, draw)
        elif name == "SUBPATTERN":
            out += sample(value[3], draw)
        elif name == "BRANCH":
            out += sample(draw.choice(value[1]), draw)
        elif name == "IN":
            kind, value = value[0]
            out += chr(value) if str(kind) == "LITERAL" else "7" if "DIGIT" in str(value) else "w"
        else:
            raise AssertionError(name)
    return out


def samples(draw):
    return [(rule, sample(_parser.parse(rule.expression), draw)) for rule in RULES]


def test_there_are_hundreds_of_rules_and_all_have_keywords():
    assert len(RULES) > 250 and len(set(RULES)) == len(RULES)
    assert [r.label for r in RULES if r.base] == ["cc-by", "gpl", "reserved"]
    weak = [r.expression for r in RULES if not r.keywords]
    assert len(weak) < 30, weak


def test_keywords_are_in_every_match_and_every_rule_can_match():
    draw, scanner = random.Random(3), Scanner(RULES)
    for _ in range(20):
        for rule, text in samples(draw):
            cut = [w.encode() for w in text.split(" ")]
            assert rule.keywords <= set(cut), (rule, text)
            if all(c.isalnum() or c in " ©" for c in text):
                assert any(scanner.rules[i] == rule for i, _, _ in scanner.detections(cut)), (rule, text)


def test_required_words():
    assert required_words("mit licensed?") == {b"mit"}
    assert required_words("a (?:b c|d) e (?:f )?g") == {b"a", b"e"}
    assert required_words("(?:a|b) c") == {b"c"} and required_words("a b|c d") == frozenset()


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(11)
    made = [t for _, t in samples(draw)]
    mixed = [" and, ".join(draw.sample(made, 6)).replace(" ", draw.choice([" ", "-", "\n"])) for _ in range(150)]
    fixed = [
        None, "", " ", "CC BY", "cc-by-nc-sa 4.0, CC BY CC BY", "All rights reserved. ALL RIGHTS RESERVED", "All rights. reserved Ärights reserved",
        "GNU General Public License, version 3 or any later", "GNU Lesser General Public License version 2.1 (LGPL 2.1)", "mit licens", "© 2020 Ü",
        "general public licenses", "the SPDX-License-Identifier: MIT-0", "under the MIT License. " * 40, "x " * 2000 + "cc by", "cc " * 1000,
    ]
    return fixed + mixed


def test_against_all_rules_at_all_places(odd, tmp_path, spark, texts):
    odd(texts, ids=[None, *range(1, len(texts) - 1), 1]).withColumnRenamed("n_words", "labels").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_license_scan(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert sorted(map(repr, (r[1:] for r in rows_of(got)))) == sorted(map(repr, map(brute_force, texts)))


def test_suppression_by_rank_length_and_place():
    rules = [Rule(1, "a", "x y"), Rule(2, "b", "x y z"), Rule(2, "c", "y z"), Rule(2, "d", "z"), Rule(2, "e", "y z"), Rule(3, "f", "w x y z v")]
    n, found = Scanner(rules).scan(b"w X y z v y z")
    assert n == 7
    got = sorted((d["label"], d["first"], d["kept"]) for d in found)
    assert got == [("a", 1, True), ("b", 1, True), ("c", 2, False), ("c", 5, True), ("d", 3, False), ("d", 6, False), ("e", 2, False), ("e", 5, False), ("f", 0, True)]


def test_empty_table(odd):
    assert license_scan.scan(odd([])).count() == 0


def test_the_query_on_all_documents(spark, sf, documents):
    got = {r[0]: r[1:] for r in rows_of(queries.op12_license_scan(spark, sf))}
    scanner = Scanner(RULES)
    labelled = 0
    for key, text in documents:
        short = bool(scanner.candidates([w.encode() for w in words(text)]) != scanner.always)
        if short or key % 10 == 0:
            assert got[key] == brute_force(text)
            labelled += bool(got[key][5])
    assert labelled and len(got) == len(documents)
