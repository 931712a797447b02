"""Fill-in-the-middle: the rope against slices of lists, the query against its SQL."""

import hashlib
import os
import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from takepick.llm import queries
from takepick.llm.rope import fill_in_middle, join, restore, rope, split, transform, written

SF = "/root/testdata/sf0.001"
TEXT = st.text(st.sampled_from("abYZ é\n<>PSM本\U0001f600"), max_size=60)


def units(text):
    return re.findall("[A-Za-z]+|[^A-Za-z]", text)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(1, 7), st.data())
def test_split_and_join_equal_slices(text, size, data):
    tree, whole = rope(text, size), units(text)
    assert (tree.units, tree.chars, written(tree)) == (len(whole), len(text), text)
    at = data.draw(st.integers(0, len(whole)))
    left, right = split(tree, at, True)
    assert (written(left), written(right)) == ("".join(whole[:at]), "".join(whole[at:]))
    assert (left.units, right.units) == (at, len(whole) - at)
    more = data.draw(st.integers(0, right.units))  # what was split can be split again
    middle, rest = split(right, more, True)
    assert written(join(join(left, middle), rest)) == text
    at = data.draw(st.integers(0, len(text)))
    left, right = split(tree, at, False)
    assert (written(left), written(right), left.chars) == (text[:at], text[at:], at)


def plain_version(text, doc_id):
    w, d = units(text), hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(w) + 1), h[1] % (len(w) + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return text, "plain"
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    return (f"<S>{s}<P>{p}<M>{m}", "spm") if h[3] % 100 < 20 else (f"<P>{p}<S>{s}<M>{m}", "psm")


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(-5, 10**12))
def test_transform_and_inverse(text, doc_id):
    output, form, *_ = transform(text, doc_id)
    assert (output, form) == plain_version(text, doc_id)
    assert restore(output, form) == text


def test_a_long_text_and_a_long_unit():
    for text in ("ab c. " * 200_000, "x" * 300_000, "é" * 50_000 + "a" * 50_000):
        output, form, n, *_ = transform(text, 4)
        assert (output, form) == plain_version(text, 4) and n == len(units(text)) and restore(output, form) == text


def test_odd_rows(spark):
    rows = [(1, "a b", 5), (1, "a b", 5), (None, "c d e", 6), (2, None, 7), (3, "", 8), (4, "a <M> b", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form int")
    out = fill_in_middle(docs).orderBy("form").collect()
    assert [r.form for r in out] == [5, 5, 6, 7, 8, 9] and out[0] == out[1]  # a column of that name stays
    assert [r.restored for r in out] == ["a b", "a b", "c d e", "", "", "a <M> b"]
    assert [r["_form"] for r in out][3:] == ["plain"] * 3 and all(r.prefix_chars is None for r in out[3:])
    assert out[2].output == plain_version("c d e", "")[0]
    assert fill_in_middle(docs.limit(0)).count() == 0


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    for name in ("op12_clusters", "op13_fill_in_middle"):
        df = queries.queries()[name](spark, SF)
        want = con.sql(queries.oracle_sql()[name])
        assert sorted(map(tuple, df.collect()), key=repr) == sorted((want.select(*df.columns)).fetchall(), key=repr)
