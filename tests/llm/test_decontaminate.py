import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tarn.llm import decontaminate as dc


def distance(item, text):
    """Least edit distance of item to any part of text, row by row."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("ab ", min_size=1, max_size=12), st.text("ab ", max_size=30))
def test_myers(item, text):
    assert dc.myers(dc.masks(item), len(item), text)[0] == distance(item, text)


def test_split_is_whole():
    for budget in range(6):
        parts = dc.split("abcdefghijk", budget)
        assert len(parts) == budget + 1 and "".join(p for _, p in parts) == "abcdefghijk"


def brute(docs, items):
    out = set()
    for i, text in docs:
        for k, item in items:
            want = dc.plain(item)
            if not want or text is None:
                continue
            budget = int(dc.RATE * len(want)) if want.count(" ") + 1 >= dc.MIN_WORDS else 0
            if not budget:
                if f" {want} " in f" {dc.plain(text)} ":
                    out.add((i, k, 0))
            elif (d := distance(want, dc.plain(text))) <= budget:
                out.add((i, k, d))
    return out


def test_edited_passages_are_found_and_nothing_else(spark, documents, clashing):
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 8)))
    items = [(k, " ".join(word() for _ in range(12))) for k in range(8)] + [(90, "too few words"), (91, None), (92, "")]
    docs = []
    for i in range(60):
        k, item = items[rng.randrange(8)]
        chars = list(item)
        for _ in range(rng.randrange(12)):
            p = rng.randrange(len(chars))
            rng.choice([lambda p=p: chars.pop(p), lambda p=p: chars.insert(p, rng.choice("abc")), lambda p=p: chars.__setitem__(p, rng.choice("xyz "))])()
        docs.append((i, " ".join(word() for _ in range(rng.randrange(9))) + "\n" + "".join(c.upper() if c.isascii() else c for c in chars) + ",, " + " ".join(word() for _ in range(5))))
    docs += [(100, None), (101, ""), (102, items[0][1] + " " + "z " * 50_000 + items[1][1]), (103, items[2][1].replace(" ", " ## "))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    df = clashing(documents(docs))
    got = {(r.doc_id, r.item_id, r.edits) for r in dc.matches(df, benchmark).collect()}
    want = brute([d for d in docs if d[0] != 102], items) | {(102, 0, 0), (102, 1, 0)}
    assert got == want and len({e for *_, e in want}) > 3
    assert {(r.doc_id, r.item_id, r.edits) for r in dc.matches(df, benchmark, group_bytes=200).collect()} == want
    kept = dc.clean(df, benchmark)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {i for i, *_ in want}


def test_short_items_are_found_unchanged_between_word_borders(spark, documents):
    items = [(1, "what is love"), (2, "cat"), (3, "?!"), (4, "a b c d e")]
    docs = [(1, "so what is love now"), (2, "concatenate"), (3, "the CAT, sat"), (4, "what is lover"), (5, "What is; love"), (6, "xa b c d e"), (7, "z a b c d e")]
    got = {(r.doc_id, r.item_id, r.edits) for r in dc.matches(documents(docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute(docs, items) == {(1, 1, 0), (5, 1, 0), (3, 2, 0), (7, 4, 0)}


def test_edits_in_whole_texts_of_a_table(spark, sf_dir):
    """Passages of the benchmark with edits, put into texts of the table; every pair is held against the plain distance."""
    rng = random.Random(6)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 900").orderBy("doc_id").limit(25).collect()]
    docs = []
    for i, text in rows:
        chars = list(dc.plain(rng.choice(items)[1]))
        for _ in range(int(len(chars) * rng.choice((0, 0.05, 0.09, 0.1, 0.11, 0.2)))):
            chars[rng.randrange(len(chars))] = rng.choice(("", "q", "xy"))
        docs.append((i, f"{text} {''.join(chars)} {text[:50]}"))
    some = items[:12]
    got = {(r.doc_id, r.item_id, r.edits) for r in dc.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(some, "item_id long, text string")).collect()}
    assert got == brute(docs, some)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    df = documents([(1, "a b c d e f")])
    assert dc.matches(df, none).collect() == [] and dc.clean(df, none).count() == 1
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert dc.matches(df.limit(0), some).collect() == []
    assert dc.matches(documents([(1, "a b c d e f")] * 3), some).count() == 3


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    texts = [(r.item_id, dc.plain(r.text)) for r in items.collect()]
    exact = {(r.doc_id, k) for r in docs.collect() for k, t in texts if t in dc.plain(r.text)}
    got = dc.matches(docs, items).collect()
    assert exact == {(r.doc_id, r.item_id) for r in got if r.edits == 0}
