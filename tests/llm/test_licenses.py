import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tarn.llm import licenses as lic

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def brute(text):
    w = words(text or "")
    places = [(i, label) for p, label in lic.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    found, best = {label for _, label in places}, 0.0
    for block in [*(text or "").split("\n"), *re.split(r"\n[ \t\r]*\n", text or "")]:
        have = set(words(block))
        for (label, _), t in zip(lic.TEMPLATES, lic.TEMPLATE_WORDS, strict=True):
            share = len(have & set(t)) / len(t)
            if share >= lic.CONTAINMENT - 1e-12:
                found.add(label)
                best = max(best, share)
    at = [i for i, _ in places]
    base = ",".join(sorted({x for _, x in places}))
    return (len(w), len(at), min(at, default=None), max(at, default=None), base, ",".join(sorted(found)), 1.0 if at else best)


def run(df):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in lic.scan(df).collect()), key=repr)


def want(docs):
    return sorted(((i is None, i or 0, *brute(t)[:-1], round(brute(t)[-1], 9)) for i, t in docs), key=repr)


def test_edges(documents, clashing):
    mit = lic.TEMPLATES[1][1]
    docs = [
        (1, None), (2, ""), (3, " .,\n "), (4, "MIT License"), (5, "the MIT\nLicense, CC-BY cc by CC BY"), (6, "summit license mit licenses"), (7, "KKGNU General\u0085Public License"), (8, "apache licence Apache_License"),
        (9, "x y " * 40_000 + "Apache License " + "z " * 10), (10, mit), (11, mit.replace(" ", "\n")), (12, mit.replace("granted", "\n\n granted")), (13, "under the " + mit.upper()), (14, "released the MIT under"),
        (15, "Released under some License MIT"), (16, " mit license "), (17, "mit  license" * 3), (18, "é mit license\r\n\r\napache license"), (None, "cc by"),
    ]
    assert run(clashing(documents(docs))) == want(docs)
    assert run(documents([(5, "mit license"), (5, "mit license"), (5, "other")])) == want([(5, "mit license"), (5, "mit license"), (5, "other")])
    assert run(documents(docs).limit(0)) == []


def test_whole_table(spark, sf_dir, oracle):
    oracle.same(lic.scan(spark.read.parquet(f"{sf_dir}/documents.parquet")), lic.ORACLE)


def test_every_template_holds_itself(documents):
    docs = [(i, f"before\n{t}\nafter") for i, (_, t) in enumerate(lic.TEMPLATES)]
    rows = {r.doc_id: r for r in lic.scan(documents(docs)).collect()}
    for i, (label, _) in enumerate(lic.TEMPLATES):
        assert label in rows[i].labels.split(",") and rows[i].score == 1


def test_no_python_in_the_plan(spark, documents):
    df = lic.scan(documents([(1, "mit license")]))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.sampled_from([w for t in lic.TEMPLATE_WORDS for w in t]), st.integers(0, 5)))
def test_prefixes_cannot_miss(counts):
    order, prefixes = lic.template_index(counts)
    for k, words_of in enumerate(lic.TEMPLATE_WORDS):
        mine = [x for x in prefixes if x[1] == k]
        _, _, _, _, of, need = mine[0]
        assert {order[r - 1] for r in of} == set(words_of) and [x[0] for x in mine] == of[: len(mine)]
        # any `need` words of a template hold one of its prefix
        assert len(of) - len(mine) < need
