"""Wu-Manber search against a plain look-up of every window."""

import hashlib
import re

from terravane.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(corpus, items):
    windows = {}
    for i, t in items:
        w = words(t)
        m = min(10, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[k : k + m]), set()).add(str(i))
    out = {}
    for i, t in corpus:
        w, hit, found = words(t), set(), set()
        for m in {len(x) for x in windows}:
            for k in range(len(w) - m + 1):
                if x := windows.get(tuple(w[k : k + m])):
                    found |= x
                    hit.update(range(k, k + m))
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def cases(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    return [*items, (900, "w3 W4 w5"), (901, "Éf7"), (902, None), (903, " - "), (904, " ".join(f"w{i}" for i in range(5, 31))), (5000, " ".join(f"w{i}" for i in range(20, 40)))]


def test_one_and_many_blocks(spark, documents, corpus):
    items = cases(spark)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = expected(corpus, items)
    for size in (1 << 25, 2_000):
        got = D.digest(D.occurrences(documents, bench, block_bytes=size)).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got} == want
        kept = D.drop_contaminated(documents, bench, block_bytes=size)
        assert kept.columns == documents.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, x in want.items() if not x[1])


def test_empty(spark, documents, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.occurrences(empty, none).count() == 0
    assert D.occurrences(documents, none).where("n_hit > 0").count() == 0


def test_rows_and_shares_do_not_depend_on_blocks(spark):
    a, b = " ".join(f"a{i}" for i in range(12)), " ".join(f"b{i}" for i in range(12))
    bench = spark.createDataFrame([(1, a), (2, b), *((k, f"none{k} of these") for k in range(3, 40))], "item_id long, text string")
    # Repeated rows, rows without ids, and passages that different blocks find: 24 of 30 and 12 of 40 words.
    rows = [(1, f"{a} {b} x y z u v w"), (1, f"{a} {b} x y z u v w"), (None, a), (None, a), (2, a + " x" * 28), (3, "clean"), (3, "clean"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = [sorted(D.digest(D.occurrences(docs, bench, block_bytes=n)).collect(), key=str) for n in (1 << 25, 100)]
    assert found[0] == found[1] and len(found[0]) == len(rows)
    for most, want in ((0.5, [2, 3, 3, 4]), (0.8, [1, 1, 2, 3, 3, 4]), (0.2, [3, 3, 4])):
        for n in (1 << 25, 100):
            kept = D.drop_contaminated(docs, bench, most=most, block_bytes=n)
            assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == want


def test_items_without_an_id_hit_and_name_nothing(spark):
    """In the query's entry, in the stage's and in SQL, in one pass and in several."""
    import duckdb
    import pandas as pd

    from terravane.llm.oracles import SQL

    thirty = " ".join(f"t{i}" for i in range(30))
    items = [(None, thirty), (None, thirty), (7, "only these three"), *((k, f"none{k} of these") for k in range(10, 30))]
    rows = [(1, thirty), (2, "say only these three words"), (3, f"{thirty} only these three"), (4, "clean"), (5, None)]
    bench, docs = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.register("d", pd.DataFrame(rows, columns=["doc_id", "text"]))
    con.register("b", pd.DataFrame({"item_id": pd.array([i for i, _ in items], "Int64"), "text": [t for _, t in items]}))
    con.execute("CREATE VIEW documents AS SELECT * FROM d")
    con.execute("CREATE VIEW benchmark AS SELECT * FROM b")
    q = con.sql(f"SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM ({SQL['op6_decontaminate']}) ORDER BY doc_id").fetchall()
    assert [r[2:4] for r in q] == [(30, 0), (3, 1), (33, 1), (0, 0), (0, 0)]
    for n in (1 << 25, 60):
        assert [tuple(r) for r in D.digest(D.occurrences(docs, bench, block_bytes=n)).orderBy("doc_id").collect()] == q
        assert sorted(r["doc_id"] for r in D.drop_contaminated(docs, bench, block_bytes=n).collect()) == [4, 5]


def test_long_items_are_cut_without_losing_a_window(spark, documents, corpus):
    long = " ".join(f"L{i}" for i in range(500))
    items = [(1, long), (2, "short one"), (3, None)]
    cut = D._items(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text", 10, long_item=40).collect()
    pieces = [r["text"].split() for r in cut if r["item"] == "1"]
    assert len(pieces) > 10 and max(map(len, pieces)) <= 49
    windows = {tuple(p[i : i + 10]) for p in pieces for i in range(len(p) - 9)}
    assert windows == {tuple(f"l{j}" for j in range(i, i + 10)) for i in range(491)}
    assert sorted(r["text"] for r in cut if r["item"] != "1") == ["", "short one"]
