import random
import re

import pyarrow as pa
from helpers import EDGES, doc_frame, prose

from loadloom.llm import sentence_spans as ss
from loadloom.llm import textarrays as ta


def _pieces(text):
    """(first byte, end of words) of each sentence piece, and the words in order, from the text by regular expression."""
    data = (text or "").encode()
    found = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    first = []
    for i, (a, b) in enumerate(found):
        if i:
            word, gap = data[found[i - 1][0] : found[i - 1][1]], data[found[i - 1][1] : a]
            tail = re.search(rb"[^0-9A-Za-z\x80-\xff]*$", word).group()[-4:]
        if not i or b"\n" in gap or any(c in tail for c in b".!?"):
            first.append(i)
    ((*_, raw, at),) = ta.pieces(pa.array([text or ""], pa.string()), 1 << 30)
    hashes, starts = ta.words(raw, at).hashes.tolist(), []
    for a, b in zip(first, [*first[1:], len(found)]):
        for i in range(a, b):
            near = [hashes[j] for j in (i - 2, i - 1, i + 1, i + 2) if a <= j < b]
            if i == a or b - a > ss.LONG and hashes[i] < min(near):
                starts.append(i)
    return data, found, starts


def _brute(rows):
    """What remains of each document, by listing all runs of all documents."""
    runs = {}
    keyed = sorted({(d, t) for d, t in rows if t}, key=lambda r: (r[0] is None, r[0] or 0))
    parsed = {}
    for doc in keyed:
        data, found, starts = parsed[doc] = _pieces(doc[1])
        bounds = starts + [len(found)]
        spans = set()
        for s in range(len(starts)):
            e = next((e for e in range(s + ss.MIN_SENTENCES, len(bounds)) if bounds[e] - bounds[s] >= ss.MIN_WORDS), None)
            if e:
                spans.add((s, e))
            b = next((b for b in range(s + 1 - ss.MIN_SENTENCES, -1, -1) if bounds[s + 1] - bounds[b] >= ss.MIN_WORDS), None)
            if b is not None:
                spans.add((b, s + 1))
        for s, e in sorted(spans):
            text = tuple(data[a:b].lower() for a, b in found[bounds[s] : bounds[e]])
            at = found[bounds[s]][0], found[bounds[e]][0] if bounds[e] < len(found) else len(data)
            runs.setdefault(text, []).append((doc, at))
    gone = {}
    for places in runs.values():
        for doc, at in places[1:]:
            gone.setdefault(doc, []).append(at)
    out = []
    for d, t in rows:
        data = (t or "").encode()
        keep = bytearray(b"\1" * len(data))
        for a, b in gone.get((d, t), ()):
            keep[a:b] = b"\0" * (b - a)
        out.append((d, None if t is None else bytes(c for c, k in zip(data, keep) if k).decode()))
    return sorted(out, key=repr)


def _got(df):
    return sorted(((r["doc_id"], r["text"]) for r in ss.remove_repeats(df).collect()), key=repr)


def test_equals_brute_force(spark):
    rng = random.Random(13)
    passages = [prose(rng, n) for n in (20, 55, 70)] + [" ".join(f"q{i}" for i in range(60))]
    rows = [*EDGES, (None, passages[1]), (None, passages[1] + " and more words here.")]
    for i in range(80):
        parts = [prose(rng, rng.choice((3, 30, 90))) for _ in range(3)]
        if i % 3 == 0:
            parts.insert(rng.randrange(4), rng.choice(passages).upper() if i % 2 else rng.choice(passages))
        rows.append((100 + i, rng.choice(("\n", " ", "\n\n")).join(parts)))
    rows += [(300, rows[40][1]), (301, rows[40][1]), (301, rows[40][1]), (302, passages[2] + "\n" + passages[2])]
    rng.shuffle(rows)
    assert _got(doc_frame(spark, rows).repartition(4)) == _brute(rows)


def test_passages_go_from_all_but_the_first(spark):
    rng = random.Random(14)
    long = " ".join(f"q{i}" for i in range(60)) + "."
    rows = [(i, prose(rng, 40) + "\n" + long + "\n" + prose(rng, 40)) for i in range(6)]
    got = {r["doc_id"]: r for r in ss.remove_repeats(doc_frame(spark, rows)).collect()}
    assert got[0]["text"] == rows[0][1] and got[0]["n_removed"] == 0
    assert all("q30" not in got[i]["text"] and got[i]["n_removed"] == len(long) + 1 for i in range(1, 6))


def test_a_passage_without_full_stops_is_found_inside_other_words(spark):
    rng = random.Random(15)
    passage = " ".join(f"q{i}" for i in range(60))
    bare = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows = [(i, bare(rng.randrange(20, 60)) + " " + passage + " " + bare(30)) for i in range(8)]
    rows += [(100 + i, bare(120)) for i in range(8)]
    got = {r["doc_id"]: r for r in ss.remove_repeats(doc_frame(spark, rows)).collect()}
    assert got[0]["n_removed"] == 0 and all(got[i]["n_removed"] == 0 for i in range(100, 108))
    assert all("q30" not in got[i]["text"].split() and got[i]["n_removed"] > 0.7 * len(passage) for i in range(1, 8))


def test_passages_of_short_sentences_are_found_inside_other_sentences(spark):
    rng = random.Random(16)
    bare = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows, copies = [], {}
    for n in (50, 52, 60):
        for size in (5, 8, 11, 13, 16):
            for host in (0, 1, 3, 6):
                for _ in range(5):
                    words = [f"p{rng.randrange(10**6)}" for _ in range(n)]
                    passage = [w + "." if i % size == size - 1 and i < n - 1 else w for i, w in enumerate(words)]
                    for copy in range(2):
                        ends = bare(30)[: host + copy], bare(30)[: host + 1 + copy]
                        doc = [*bare(40), "end.", *ends[0], *passage, *ends[1], "stop.", *bare(40)]
                        copies[len(rows)] = (copy, words)
                        rows.append((len(rows), " ".join(doc)))
    got = {r["doc_id"]: r["text"].replace(".", "").split() for r in ss.remove_repeats(doc_frame(spark, rows)).collect()}
    left = {d: len(set(words) & set(got[d])) / len(set(words)) for d, (_, words) in copies.items()}
    assert all(left[d] == 1 for d, (copy, _) in copies.items() if copy == 0)
    again = [left[d] for d, (copy, _) in copies.items() if copy == 1]
    assert sum(x < 1 for x in again) >= 0.99 * len(again) and sum(again) < 0.3 * len(again)


def test_empty_table(spark):
    assert _got(doc_frame(spark, [])) == []


def test_one_text_of_many_documents_is_dealt_over_tasks():
    """What is found in copies of one text goes to buckets by document."""
    import numpy as np
    import pyarrow as pa

    text = " ".join(f"One sentence number {i} of the same text." for i in range(20))
    n = 300
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([77] * n, pa.int64()), pa.array([text] * n)], names=["a", "b", "c"])
    (spread,) = ss._spread(1)(iter([batch]))
    again = ss._repeated(64)(pa.Table.from_batches([spread]))
    sizes = [len(x.as_py()) // 8 for x in again.column("hashes")]
    assert again.num_rows > 50 and max(sizes) < 0.1 * sum(sizes)
    assert np.unique(again.column("bucket").to_numpy()).size == again.num_rows
