import random

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from tidemark.llm import warc


def pages(n=400):
    rng = random.Random(4)
    hot = "<p>" + "same page " * 150 + "</p>"
    rows = []
    for i in range(n):
        html = rng.choice([hot, "short", "<b>é\r\n\r\nWARC/1.1\r\n</b>" * 60, f"<i>{i}</i>" * 200])
        url = rng.choice(["http://www.hot.example/", f"https://a{i % 7}.example:8443/P?q={i % 3}", "HTTP://hot.example/x y"])
        rows.append((i, url, html))
    return rows


def test_archives_equal_sql(spark):
    rows = pages()
    out = warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)).toPandas()
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url", "html"]))
    want = con.sql(warc.ORACLE_SQL).df().sort_values("page_id", ignore_index=True)
    got = out[list(want.columns)].sort_values("page_id", ignore_index=True)
    for c in want:
        assert (want[c].fillna(-1).tolist()) == (got[c].fillna(-1).tolist()), c


def test_history_is_globally_ordered(spark):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string").repartition(6)
    folder = warc.new_table_path(spark, "warc-test")
    warc.write_archives(df, folder)
    captures = warc.read_captures(spark, folder)
    merged = warc.merge_index(captures, range_rows=60).orderBy("part", "place").collect()
    keys = [(r.url_key, r.captured, r.page_id) for r in merged]
    assert keys == sorted(keys) and len(keys) == 400 and len({r.part for r in merged}) > 3
    assert sorted(r.page_id for r in merged) == list(range(400))


def test_loser_tree():
    rng = random.Random(5)
    for k in range(0, 9):
        runs = [sorted(rng.randint(0, 20) for _ in range(rng.randint(0, 12))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("https://WWW.Example.org:443/A/b?x=1") == "org,example)/a/b?x=1"
    assert warc.url_key("http://example.org:8080") == "org,example:8080)/"
    assert warc.url_key(None) == "" and warc.url_key("http://[broken") == "http://[broken"


def test_odd_rows(spark):
    big = "z" * 2000
    rows = [(None, None, None), (1, None, ""), (2, "no url at all", big), (3, "http://a/\r\nb c", big), (3, "http://a/", big), (None, "http://a/", big), (9, "http://a/", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "run": F.lit("x"), "n": F.lit(2)})
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive_pages(df).collect()), key=str)
    want = [(None, 0, "response", None), (1, 0, "response", None), (2, 2000, "revisit", 3), (3, 2000, "response", None), (3, 2000, "response", None), (None, 2000, "response", None), (9, 0, "response", None)]
    assert got == sorted(want, key=str)
    assert warc.archive_pages(df.limit(0)).count() == 0
