import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from support import HAVE_TABLES, SF, clashing, documents, rows

from marquee.llm import licenses
from marquee.llm.queries import QUERIES

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def base(text):
    w, at, labels = words(text), [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        here = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        at += here
        labels |= {label} if here else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), labels


def method(text):
    """The labels and the score of the templates: all diagonals, every word of each."""
    w, labels, best = words(text), set(), 0.0
    for label, template in licenses.TEMPLATES:
        t = words(template)
        grams = {}
        for i in range(len(t) - 2):
            grams.setdefault(tuple(t[i : i + 3]), []).append(i)
        votes = {}
        for i in range(len(w) - 2):
            for p in grams.get(tuple(w[i : i + 3]), []):
                votes.setdefault(i - p, set()).add(p)
        slack, spans = max(licenses.SLACK, int(licenses.SLACK_SHARE * len(t))), []
        for s in sorted(votes):
            if spans and s - spans[-1][-1] <= slack:
                spans[-1].append(s)
            else:
                spans.append([s])
        for span in spans:
            if sum(len(votes[s]) for s in span) < licenses.VOTED * (len(t) - 2):
                continue
            share = len({j for s in span for j in range(len(t)) if 0 <= j + s < len(w) and w[j + s] == t[j]}) / len(t)
            first = max(span[0], 0)
            telling = set(licenses.TELLING)
            if telling & set(w[first : span[-1] + len(t)]) != telling & set(t):
                continue
            if share >= licenses.VERIFIED:
                labels.add(label)
                best = max(best, share)
    return labels, best


def by_hand(docs):
    out = []
    for i, text in docs:
        n, places, low, high, labels = base(text)
        more, score = method(text)
        every = labels | more
        out.append((i, n, places, low, high, ",".join(sorted(labels)), ",".join(sorted(every - {licenses.RESERVED} if len(every) > 1 else every)), round(score, 9)))
    return sorted(out, key=str)


def rounded(df):
    return sorted(((*r[:-1], round(r[-1], 9)) for r in rows(df)), key=str)


MIT = licenses.TEMPLATES[2][1]
DOCS = [
    (1, "Released under the MIT License."), (2, "LICENSED UNDER THE APACHE-LICENSE, VERSION 2.0!"), (3, MIT),
    (4, MIT.replace("free of charge", "entirely free of charge").replace("copy of", "copy, of")), (5, MIT[: len(MIT) // 2]),
    (6, "Nothing here. mit, license; mit license mit license"), (7, None), (8, ""), (None, "All rights reserved"), (9, "all rights\nreserved " * 50),
    (10, "ünder the Mit Licensé"), (11, "word " * 30_000 + "Licensed under CC BY-NC 4.0"), (1, "Released under the MIT License."),
    (12, "Licensed under the Apache License; Licensed under the GNU General Public License"), (13, f"{MIT} {MIT} The mit license"),
]


def test_against_brute_force(spark):
    assert rounded(licenses.scan(documents(spark, DOCS))) == by_hand(DOCS)
    assert rounded(licenses.scan(clashing(spark, DOCS))) == by_hand(DOCS)


def test_labels_of_some(spark):
    got = {r.doc_id: r for r in licenses.scan(documents(spark, DOCS)).collect() if r.doc_id}
    assert got[1].labels == "mit" and got[1].score == 1 and got[3].labels == "mit" and got[4].labels == "mit"
    assert got[5].labels == "" and got[9].labels == "proprietary" and got[11].labels == "cc-by-nc"


def test_whole_texts_and_edits(spark):
    """Each paragraph is found, also with five words put in or three left out in the middle."""
    docs, want = [], {}
    for n, (label, template) in enumerate(licenses.TEMPLATES):
        t = template.split()
        if len(t) < 25:
            continue
        half = len(t) // 2
        for m, text in enumerate((
            " ".join(t), " ".join([*t[:half], "and", "its", "several", "affiliated", "companies", *t[half:]]),
            " ".join([*t[:half], *t[half + 3:]]), "All rights reserved. " + " ".join(t),
        )):
            docs.append((10 * n + m, f"Before it. {text}. After it."))
            want[10 * n + m] = label
    got = {r.doc_id: r.labels for r in licenses.scan(documents(spark, docs)).collect()}
    assert got == want and len(set(want.values())) >= 5
    assert rounded(licenses.scan(documents(spark, docs))) == by_hand(docs)


def test_empty_table(spark):
    assert licenses.scan(documents(spark, [])).collect() == []


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(
    ["Licensed under", " the MIT", " License", " and", ", Apache", " License, Version", " 2.0", "\n", " all rights", " reserved"]),
    max_size=12).map("".join), min_size=1, max_size=6))
def test_small_alphabet(spark, texts):
    docs = list(enumerate(texts))
    assert rounded(licenses.scan(documents(spark, docs))) == by_hand(docs)


@pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")
def test_registered_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert rounded(QUERIES["op4_license_scan"](spark, SF)) == by_hand(docs)
