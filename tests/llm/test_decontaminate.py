import random

from helpers import EDGES, doc_frame, prose

from loadloom.llm import decontaminate as dc


def _distance(item, window):
    row = list(range(len(item) + 1))
    for i, w in enumerate(window, 1):
        new = [i]
        for j, v in enumerate(item, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (v != w)))
        row = new
    return row[-1]


def _tokens(text):
    import re

    return re.findall(r"[0-9a-zà-ÿ]+", (text or "").lower())


def _items(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id bigint, text string, doc_id string")


def test_edited_passages_are_found_and_verified(spark):
    rng = random.Random(5)
    items = [(k, prose(rng, n, 400)) for k, n in enumerate((3, 5, 6, 9, 14, 20, 33, 34, 45, 60))]
    rows, planted = [], set()
    for d in range(300):
        k, text = rng.choice(items)
        n = len(text.split())
        host = prose(rng, rng.choice((0, 5, 80)), 400).split()
        ws = text.split()
        limit = dc.edits(n, 20)
        for _ in range(rng.randint(0, limit)):
            at = rng.randrange(len(ws))
            what = rng.randrange(3)
            if what == 0:
                ws[at] = f"new{rng.randrange(10**6)}"
            elif what == 1:
                ws.insert(at, f"new{rng.randrange(10**6)}")
            elif len(ws) > 1:
                del ws[at]
        cut = rng.randrange(len(host) + 1)
        rows.append((d, " ".join(host[:cut] + ws + host[cut:]).upper()))
        planted.add((d, k))
    clean = [(1000 + d, prose(rng, 150, 400)) for d in range(60)]
    found = dc.contaminations(doc_frame(spark, rows + clean), _items(spark, items)).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert len(planted & got) >= 0.97 * len(planted)
    texts, words = dict(rows + clean), {k: _tokens(t) for k, t in items}
    for r in found:
        window = _tokens(texts[r["doc_id"]])[r["first_word"] : r["end_word"]]
        assert _distance(words[r["item_id"]], window) == r["n_edits"] <= dc.edits(len(words[r["item_id"]]), 20)
    assert not {d for d, _ in got if d >= 1000}
    kept = {r["doc_id"] for r in dc.drop_contaminated(doc_frame(spark, rows + clean), _items(spark, items)).collect()}
    assert kept == {d for d, _ in rows + clean} - {d for d, _ in got}


def test_edited_copies_of_long_items_are_found(spark):
    rng = random.Random(7)
    items = [(k, prose(rng, n)) for k, n in enumerate((200, 400, 1000))]
    rows, planted = [], set()
    for d in range(60):
        k, text = items[d % 3]
        ws = text.split()
        limit, part = dc.edits(len(ws), 20), len(ws) // 3 if d % 2 else len(ws)  # edits all over, or in the first third
        for _ in range(limit):
            at, what = rng.randrange(part), rng.randrange(3)
            ws[at : at + (what < 2)] = [f"new{rng.randrange(10**6)}"] if what else []
        host = prose(rng, 80).split()
        rows.append((d, " ".join(host[:40] + ws + host[40:])))
        planted.add((d, k))
    clean = [(1000 + d, prose(rng, 1500)) for d in range(20)]
    found = dc.contaminations(doc_frame(spark, rows + clean), _items(spark, items)).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert len(planted & got) >= 0.98 * len(planted) and got <= planted
    for r in found[:6]:
        window = _tokens(dict(rows)[r["doc_id"]])[r["first_word"] : r["end_word"]]
        assert _distance(_tokens(items[r["item_id"]][1]), window) == r["n_edits"]


def test_the_best_window_is_the_same_with_and_without_keys():
    rng = random.Random(8)
    words = dc._item_words([prose(rng, n, 60) for n in (20, 21, 24)])
    keyed = dc.Index.build([1, 2, 3], words, 20, 0.98, 11)
    exact = dc.Index.build([1, 2, 3], words, 20, 1.01, 11)
    assert all(c.held is not None for c in exact.classes)
    text = " ".join(dc_text for _ in range(40) for dc_text in (prose(rng, 7, 60), prose(random.Random(8), 20, 60)))
    ((*_, data, at),) = dc.ta.pieces(dc.pa.array([text, "", text[100:]]))
    some, every = (x.search(dc.item_words(data, at)) for x in (keyed, exact))
    assert {x[:2] for x in every} == {(0, 1), (2, 1)} and some == every


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rng = random.Random(6)
    items = [(k, prose(rng, 20)) for k in range(8)]
    rows = [(k, prose(rng, 10) + " " + t) for k, t in items]
    whole = sorted(dc.contaminations(doc_frame(spark, rows), _items(spark, items)).collect())
    monkeypatch.setattr(dc, "BLOCK_WORDS", 30)
    assert sorted(dc.contaminations(doc_frame(spark, rows), _items(spark, items)).collect()) == whole and len(whole) == 8


def test_edges(spark):
    items = _items(spark, [(None, "a b c d e f"), (1, None), (2, ""), (3, "one two"), (4, "one two three four"), (4, "one two three four")])
    found = dc.contaminations(doc_frame(spark, [*EDGES, (None, "say ONE, two; three four!")]), items).collect()
    assert [(r["doc_id"], r["item_id"], r["n_edits"], r["first_word"], r["end_word"]) for r in found] == [(None, 4, 0, 1, 5)]
    assert dc.contaminations(doc_frame(spark, []), items).count() == 0
    assert dc.contaminations(doc_frame(spark, EDGES), _items(spark, [])).count() == 0
    assert dc.drop_contaminated(doc_frame(spark, EDGES), _items(spark, [])).count() == len(EDGES)
