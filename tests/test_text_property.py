"""F1/F2 against Python's own re + html on generated strings (batched into one Spark job)."""

import html
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from featurelane.functions.text import html_unescape, multivalue_clean

TOKENS = ["a", "B", "7", "_", ".", "|", " ", "-", "(", ")", "&amp;", "&lt;", "&quot;", "&copy;", "&amp",
          "é", "周杰倫", "\t", "  ", "||", "ß", "½", "&#39;", "&#x4E2D;", "&#20013;", "/", "!"]


def py_clean(s):
    s = html.unescape("" if s is None else s)
    s = re.sub(r"[^.\w|]+", " ", s)
    s = re.sub(r"^[\s|]+|[\s|]+$", "", s)
    return sorted(re.split(r"\s*\|+\s*", s))


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.sampled_from(TOKENS), max_size=12).map("".join), min_size=50, max_size=120))
def test_multivalue_clean_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r["i"]: (r["m"], r["u"]) for r in df.select("i", multivalue_clean("s").alias("m"),
                                                       html_unescape("s").alias("u")).collect()}
    for i, t in enumerate(texts):
        assert got[i][1] == html.unescape(t), t
        assert got[i][0] == py_clean(t), t


def test_all_names_and_numbers_of_html5(spark):
    """All 2,231 names, with and without a rest behind them, and the numbers that HTML5 takes for others or drops."""
    from html.entities import html5

    texts = [f"caf&{n}x &{n}" for n in html5] + ["caf&eacute; &alpha; &frac12; &pound;5", "&notanentity; &notit; &ampx; &NotEqualTilde; &; &x; &zz"]
    numbers = [*range(0, 0x180), 0xD7FF, 0xD800, 0xDFFF, 0xFDCF, 0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0xFFFF, 0x1FFFE, 0x1F600, 0x10FFFD, 0x10FFFF, 0x110000, 10**30]
    texts += [f"a&#{n};b&#x{n:x}c;&#X{n:X};" for n in numbers] + ["&#00150; &#x0080 &#150"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    got = {r["i"]: r["u"] for r in df.select("i", html_unescape("s").alias("u")).collect()}
    assert len(html5) == 2231
    for i, t in enumerate(texts):
        assert got[i] == html.unescape(t), t


def test_sql_twin_decodes_as_the_standard_library():
    """The DuckDB twin of the unescaping, built from the standard library's tables, on every name and the special numbers."""
    import html
    from html.entities import html5

    import duckdb

    from featurelane.plans.oracle import _unescape
    texts = [f"a&{n}b" for n in html5] + [f"&{n.rstrip(';')}x;" for n in list(html5)[::40]]
    texts += [f"&#{n};" for n in (0, 9, 11, 38, 128, 150, 159, 255, 55296, 64976, 65534, 1114111, 1114112, 99999999999999999999)]
    texts += ["&#x80;z", "&#X41", "&#xD800;", "&#xFFFFFFFFFFFFFFFFFF;", "&", "&&amp;amp;", "&notit;", "&nosuch;", "plain"]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k INTEGER, x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(texts)))
    got = [r[0] for r in con.execute(f"SELECT {_unescape('x')} FROM t ORDER BY k").fetchall()]
    wrong = [(t, g, html.unescape(t)) for t, g in zip(texts, got) if g != html.unescape(t)]
    assert not wrong, wrong[:5]
