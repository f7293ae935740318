import random

from pyspark.sql import functions as F
from helpers import EDGES, doc_frame, prose

from loadloom.llm import secrets


def _corpus():
    rng = random.Random(10)
    hexed = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    upper = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(n))
    rows, true = [], {}
    for i in range(400):
        a, b = prose(rng, 8), prose(rng, 8)
        kind = i % 5
        value = (hexed(40), "AKIA" + upper(16), str(rng.randrange(10**15, 10**16)), hexed(40), f"image_sample_file_{i}")[kind]
        lead = ('token = "', "key ", "", "commit ", "")[kind]
        rows.append((i, f"{a} {lead}{value}{'\"' if kind == 0 else ''} {b}"))
        true[i] = (value, kind < 2)
    return rows, true


def test_forest_keeps_secrets_and_drops_lookalikes(spark):
    rows, true = _corpus()
    docs = doc_frame(spark, rows)
    found = secrets.scan(docs)
    got = {r["doc_id"]: r for r in found.collect()}
    texts = dict(rows)
    for i, (value, secret) in true.items():
        if any(c.isdigit() for c in value):
            r = got[i]
            assert texts[i][r["start"] : r["start"] + r["n_chars"]] == value
            assert r["is_secret"] == secret, (value, r)
    out = {r["doc_id"]: r["text"] for r in secrets.redacted(docs, found).collect()}
    for i, (value, secret) in true.items():
        assert out[i] == (texts[i].replace(value, secrets.REPLACEMENT) if secret else texts[i])
    assert secrets.redacted(docs, found).columns == docs.columns


def test_edges(spark):
    rows = [*EDGES, (9, "AKIA" + "Q2" * 8), (9, "AKIA" + "Q2" * 8), (None, 'password="a1b2c3d4e5f6a7b8" AKIA' + "Z3" * 8 + " end")]
    docs = doc_frame(spark, rows)
    found = secrets.scan(docs)
    got = sorted((r["doc_id"] or 0, r["ordinal"], r["start"], r["n_chars"], r["is_secret"]) for r in found.collect())
    assert got == [(0, 0, 10, 16, True), (0, 1, 28, 20, True), (9, 0, 0, 20, True)]
    out = sorted(map(repr, ((r["doc_id"], r["text"]) for r in secrets.redacted(docs, found).collect())))
    cut = secrets.REPLACEMENT
    want = [*EDGES, (9, cut), (9, cut), (None, f'password="{cut}" {cut} end')]
    assert out == sorted(map(repr, want))
    none = doc_frame(spark, [])
    assert secrets.scan(none).count() == 0 and secrets.redacted(none, found).count() == 0


def test_candidates_without_a_digit(spark):
    rows = [(1, "a key AKIA" + "Q" * 16 + " here"), (2, 'password = "abcdefabcdefabcdef" x'), (3, "password=abcdefabcdefabcdef"),
            (4, "someordinarylongword and AKIA" + "Q" * 17), (5, "note: someordinarylongword")]
    docs = doc_frame(spark, rows)
    found = secrets.scan(docs)
    assert sorted((r["doc_id"], r["start"], r["n_chars"], r["is_secret"]) for r in found.collect()) == [(1, 6, 20, True), (2, 12, 18, True), (3, 9, 18, True)]
    assert {r["doc_id"]: r["text"] for r in secrets.redacted(docs, found).collect()}[3] == "password=" + secrets.REPLACEMENT


def test_short_punctuated_and_colon_assigned_secrets(spark):
    values = {
        10_001: ('password = "{}"', "hunter2x9"), 10_002: ('password="{}"', "P4ss.w0rd!2024x"), 10_003: ('{{"secret": "{}"}}', "abcdefabcdefabcdef"),
        10_004: ("db:\n  password: {}\n", "x9.K@2#f"), 10_005: ("password={}&user=joe", "a$b%c7!e&f"), 10_006: ("api_key: '{}', other", "q7w8e9"),
        10_007: ("the token: {}.", "s3cr3t-v4lue"), 10_008: ("aws_key = {};", "x.AKIA" + "Q3" * 8),
    }
    rows, _ = _corpus()
    docs = doc_frame(spark, rows + [(d, "say " + form.format(v) + " end") for d, (form, v) in values.items()])
    got = {r["doc_id"]: r["text"] for r in secrets.redacted(docs, secrets.scan(docs)).collect()}
    for d, (form, _) in values.items():
        assert got[d] == "say " + form.format(secrets.REPLACEMENT) + " end"


def test_any_assigned_value_is_a_candidate(spark):
    rows = [(1, 'x = "p.q@r!s#t"'), (2, '{"k": "a%b&c.d"}'), (3, "k=ab.cd!ef"), (4, "k: ab.c7!ef"), (5, 'see "https://h.example/?token=abcdef0123456789"'),
            (6, 'secret: "horse battery"'), (7, "password: swordfish, and"), (8, "at 10:30 he said: nothing more"),
            (9, "password=" + "x." * 100_000 + "y"), (10, 'token="' + "x.4" * 100_000 + '"'), (11, "a:" * 50_000), (12, "k=" + "." * 100_000)]
    texts = dict(rows)
    found = secrets.candidates(doc_frame(spark, rows)).collect()
    assert all(texts[r["doc_id"]][r["start"] :].startswith(r["found"]) for r in found)
    assert sorted((r["doc_id"], r["found"]) for r in found) == [
        (1, "p.q@r!s#t"), (2, "a%b&c.d"), (3, "ab.cd!ef"), (4, "ab.c7!ef"), (5, "abcdef0123456789"), (6, "horse battery"), (7, "swordfish"),
        (9, "x." * 100_000 + "y"), (10, "x.4" * 100_000),
    ]


def test_long_quoted_values_with_blanks_and_clashing_columns(spark):
    rows, _ = _corpus()
    phrase = " ".join(f"word{i}x9" for i in range(400))
    docs = doc_frame(spark, [*rows, (20_001, f'password = "{phrase}"'), (20_002, 'password = "no end ' + "x9 " * 300)])
    for c in ("__id", "__key", "secret_id", "secret_key", "secret_ordinals", "ordinals", "d"):
        docs = docs.withColumn(c, F.lit("kept"))
    found = secrets.candidates(docs).where("doc_id = 20001").collect()
    assert [r["found"] for r in found] == [phrase]
    marked = secrets.scan(docs).withColumn("is_secret", F.col("doc_id") == 20_001)
    got = secrets.redacted(docs, marked)
    assert got.columns == docs.columns and got.count() == docs.count()
    row = got.where("doc_id = 20001").first()
    assert row["text"] == f'password = "{secrets.REPLACEMENT}"' and row["secret_id"] == row["__id"] == "kept"


def test_training_rows_are_bounded_by_their_hash_without_a_window(spark):
    rows = spark.range(40_000).selectExpr(
        "cast(id % 2 as double) AS label", "cast(id as string) AS found", "'b' AS before", "'a' AS after",
        *[f"rand({i}) AS {c}" for i, c in enumerate(secrets.FEATURES)],
    )
    order = F.xxhash64("found", "before", F.lit(5))
    one = rows.where("label = 0")
    got = secrets._bounded(one, 20_000, 300, order)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Filter" in plan
    want = one.orderBy(order, "found").limit(300)
    assert sorted(r["found"] for r in got.collect()) == sorted(r["found"] for r in want.collect())
    model = secrets.fit_forest(rows, max_rows=200, trees=2, depth=2)
    assert model.stages[-1].getNumTrees == 2


def test_main_path_has_no_python(spark):
    rows, _ = _corpus()
    plan = secrets.scan(doc_frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
