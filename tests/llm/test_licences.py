import re

import pytest
from cases import SF, odd_texts, same_bag

from eventlake.llm import licences
from eventlake.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def base(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    places, labels = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        parts = phrase.split()
        own = [i for i in range(len(words)) if words[i:i + len(parts)] == parts]
        places += own
        labels |= {label} if own else set()
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


TRICKY = ["cc by cc by-cc_BY ccby cc  by", "General Public License general public license", "all rights all rights reserved.", "xcc by",
          "ALL\nRIGHTS... RESERVED all rights reservedé", "é all rights reserved é cc by", "cc by"]


def test_query_against_brute_force(spark, given_docs):
    rows = QUERIES["op10_licence_labels"](spark, SF).collect()
    same_bag([tuple(r)[:6] for r in rows], [(d["doc_id"], *base(d["text"])) for d in given_docs])
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in rows)


def test_odd_texts(spark, odd_docs, no_docs):
    rows = licences.scan_licences(odd_docs).collect()
    same_bag([(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in rows],
             [(i, *base(t)) for i, t in odd_texts()])
    assert licences.scan_licences(no_docs).count() == 0


@pytest.mark.parametrize("text", TRICKY)
def test_places(text):
    assert licences.scan(text)[:5] == base(text)


@pytest.mark.parametrize("expression,postfix", [
    ("mit", ["mit"]), ("mit or apache-2.0 and isc", ["mit", "apache-2.0", "isc", "and", "or"]),
    ("(mit or apache-2.0) and isc", ["mit", "apache-2.0", "or", "isc", "and"]),
    ("gpl-2.0 with classpath-exception-2.0 or mit", ["gpl-2.0", "classpath-exception-2.0", "with", "mit", "or"]),
    ("mit some more words", ["mit"]), ("mit or", ["mit"]), ("(mit", None), ("or mit", None), ("", None), ("mit ) x", ["mit"]),
    ("((mit))", ["mit"]), ("a and b or c and d", ["a", "b", "and", "c", "d", "and", "or"]),
])
def test_parser(expression, postfix):
    assert licences.parse(expression) == postfix


def test_expressions_are_evaluated():
    tag = "// SPDX-License-Identifier: "
    assert licences.scan(tag + "MIT OR GPL-3.0-only")[5:] == ("gpl,mit", 0.9)
    assert licences.scan(tag + "MIT AND GPL-3.0-only")[5:] == ("gpl,mit", 0.4)
    assert licences.scan(tag + "GPL-2.0 WITH Classpath-exception-2.0")[5:] == ("gpl", 0.5)
    assert licences.scan(tag + "(MIT OR Apache-2.0) AND CC-BY-NC-4.0\nall rights reserved")[5:] == ("apache,cc-by,cc-by-nc,mit,reserved", 0.0)
    assert licences.scan("nothing to see")[5:] == ("", licences.SILENT_SCORE)


@pytest.mark.parametrize("opened,closed", [("", ""), ("(", ")"), ("(" * 500, ")" * 500)])
def test_long_expressions_are_read_to_their_end(opened, closed):
    tag = "# SPDX-License-Identifier: "
    many = " AND ".join(["MIT", "Apache-2.0", "BSD-3-Clause"] * 300)
    assert licences.scan(f"{tag}{opened}{many} AND GPL-3.0-only{closed}\n")[5:] == ("apache,bsd,gpl,mit", 0.4)
    for spaces in range(12):  # no identifier is cut in its middle
        assert licences.scan(f"{tag}{opened}{' ' * spaces}{many}{closed}")[5:] == ("apache,bsd,mit", 0.9)


def test_very_long_expression_takes_linear_time():
    import time

    began = time.process_time()
    assert licences.scan("spdx-license-identifier: " + "mit or " * 200_000 + "isc")[5:] == ("isc,mit", 0.9)
    assert time.process_time() - began < 20


@pytest.mark.parametrize("text,labels,score", [
    ("/* SPDX-License-Identifier: (GPL-2.0 OR\n * MIT)\n */", "gpl,mit", 0.9), ("SPDX - License - Identifier: MIT", "mit", 0.9),
    ("# SPDX-License-Identifier: (MIT AND\n#   (Apache-2.0 OR\n#   GPL-3.0-only))", "apache,gpl,mit", 0.9),
    ("SPDX-License-Identifier: MIT or later work by us", "mit", 0.9), ("SPDX-License-Identifier: MIT\nand more", "mit", 0.9),
    ("SPDX-License-Identifier: MIT or Apache-2.0.", "apache,mit", 0.9), ("SPDX-License-Identifier: MIT Or foo", "mit", 0.9),
    ("SPDX-License-Identifier: LicenseRef-Own OR MIT", "mit,other", 0.9), ("License: Apache-2.0", "apache", 0.9),
    ('{"license": "MIT", "x": 1}', "mit", 0.9), ("licence = 'BSD-3-Clause'", "bsd", 0.9), ("license: [MIT]", "mit", 0.9),
    ("License: see below or MIT", "", 0.5), ("the license of MIT", "", 0.5), ("MIT licence", "mit", 0.9), ("GPLv3 only", "gpl", 0.4),
    ("General Public Licence", "gpl", 0.4), ("SPDX-License-Identifier:\nMIT", "", 0.5), ("SPDX-License-Identifier: MIT AND (", "mit", 0.9),
    ("É License-Identifier: x SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 é", "gpl", 0.5),
])
def test_expressions_behind_tags(text, labels, score):
    assert licences.scan(text)[5:] == (labels, score)


def test_very_many_tags_and_brackets_take_linear_time():
    import time

    for text in ("SPDX-License-Identifier: (" * 20_000, "license: (mit or " * 30_000, "SPDX-License-Identifier: " + "(" * 200_000 + "MIT"):
        started = time.process_time()
        licences.scan(text)
        assert time.process_time() - started < 10
