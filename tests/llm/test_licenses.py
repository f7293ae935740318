import random
import re

import pytest
from helpers import CLASHING, EDGES, doc_frame, prose

from loadloom.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _places(inner, outer):
    return [i for i in range(len(outer) - len(inner) + 1) if outer[i : i + len(inner)] == inner]


def brute(texts, templates=licenses.TEMPLATES, phrases=licenses.PHRASES):
    """Everything from the words of each text, without an index."""
    every = [_words(t) for t in texts]
    vocab = {w for t in templates for w in _words(t.text)}
    count = {w: sum(w in set(ws) for ws in every) for w in vocab}
    out = []
    for ws in every:
        base = sorted((p, label) for phrase, label in phrases.items() for p in _places(_words(phrase), ws))
        labels, best = {label for _, label in base}, 0.0
        for t in templates:
            ts = _words(t.text)
            rare = sorted(set(ts), key=lambda w: (count[w], w))[: licenses.n_rare(t)]
            votes = {}
            for part in rare:
                for at in _places([part], ts):
                    for p in _places([part], ws):
                        votes.setdefault(p - at, set()).add(("word", part))
            for key in t.keys:
                for at in _places(_words(key), ts):
                    for p in _places(_words(key), ws):
                        votes.setdefault(p - at, set()).add(("key", key))
            for shift in (0, licenses.BAND // 2):
                bands = {}
                for p, found in votes.items():
                    bands.setdefault((p + shift) // licenses.BAND, set()).update(found)
                for found in bands.values():
                    n = sum(kind == "word" for kind, _ in found)
                    best = max(best, n / len(rare))
                    if n * 100 >= len(rare) * licenses.VOTES and len(found) - n == len(t.keys):
                        labels.add(t.label)
        starts = [p for p, _ in base]
        out.append((len(ws), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), 1.0 if base else best))
    return out


def _cases():
    rng = random.Random(4)
    notice = {t.label: t.text for t in licenses.TEMPLATES}
    rows = list(EDGES)
    for label, text in notice.items():
        rows.append((100 + len(rows), f"{prose(rng, 40)} {text}. {prose(rng, 40)}"))
        rows.append((100 + len(rows), text.upper()))
        ws = text.split(" ")
        rows.append((100 + len(rows), " ".join(w if rng.random() > 0.15 else "edited" for w in ws)))
        rows.append((100 + len(rows), " ".join(rng.sample(ws, len(ws)))))
    rows += [(500, "CC BY, cc--by; Cc\tBy ccby"), (501, "All rights\nreserved. all rights reserved"), (502, "licence K İ CC É BY"), (503, "K" * 3 + " cc by"), (None, "GENERAL Public license")]
    rows += [(600, " ".join(["cc by"] * 5000)), (601, "mit " * 3000 + "license"), (602, "word " * 20_000 + "All Rights Reserved")]
    return rows


def test_equals_brute_force_over_edges_edits_and_long_texts(spark):
    rows = _cases()
    got = licenses.scan_licenses(doc_frame(spark, rows)).collect()
    want = [(i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows]), strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_notices_are_found_whole_edited_and_in_capitals_but_not_shuffled(spark):
    rows = _cases()
    got = {}
    for r in licenses.scan_licenses(doc_frame(spark, rows, clash=False)).collect():
        got.setdefault(r["doc_id"], r)
    for i, text in rows:
        for t in licenses.TEMPLATES:
            if i is not None and i >= 100 and t.text in (text or ""):
                assert t.label in got[i]["labels"].split(",")


def test_own_templates_beyond_ascii_and_none(spark):
    rows = [(1, "Frei unter der Lizenz ÄPFEL und Birnen"), (2, "äpfel und birnen"), (3, "nichts")]
    own = (licenses.Template("obst", "unter der Lizenz Äpfel und Birnen", ("äpfel und birnen",)),)
    got = {r["doc_id"]: (r["labels"], r["base_labels"]) for r in licenses.scan_licenses(doc_frame(spark, rows), own, {"frei unter": "frei"}).collect()}
    assert got[1] == ("frei,obst", "frei") and got[3] == ("", "")
    none = licenses.scan_licenses(doc_frame(spark, rows), (), {"und": "u"}).collect()
    assert sorted((r["doc_id"], r["labels"], r["n_base"]) for r in none) == [(1, "u", 1), (2, "u", 1), (3, "", 0)]


def test_empty_table_and_no_python(spark):
    docs = doc_frame(spark, [])
    assert licenses.scan_licenses(docs).count() == 0
    plan = licenses.scan_licenses(doc_frame(spark, EDGES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("copies", [300])
def test_repeated_rows_each_have_a_row(spark, copies):
    rows = [(9, "All rights reserved")] * copies + [(8, None)]
    got = licenses.scan_licenses(doc_frame(spark, rows)).groupBy("doc_id", "labels").count().collect()
    assert sorted(map(tuple, got)) == [(8, "", 1), (9, "reserved", copies)]
    assert "score" in CLASHING
