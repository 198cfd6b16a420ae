"""Decontamination, quality rules, url filters and substring dedup: SQL on the small tables, and edge cases."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from matchlytics.llm import queries
from matchlytics.llm.decontaminate import decontaminate
from matchlytics.llm.phrases import later_windows, remove_later_passages
from matchlytics.llm.quality_rules import quality_rules
from matchlytics.llm.suffix_dedup import remove_repeated_strings
from matchlytics.llm.url_filter import filter_urls
from tests.llm.conftest import SMALL
from tools.compare import database, rows_of


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    found = database(SMALL).execute(queries.ORACLES[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in found.description], found.fetchall())


def test_native_queries_run_no_python(spark):
    for name in ("op7_quality_rules", "op10_url_filters"):
        plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "InArrow", "InPandas"))


@pytest.mark.parametrize("shard_chars", [4 << 20, 1])
def test_decontamination_edge_cases(spark, docs_of, shard_chars):
    items = spark.createDataFrame(
        [(1, "One two THREE four five six seven eight nine ten eleven"), (2, "short item"), (3, None), (4, " ,. "), (None, "no id here"), (2, "short item")], "item_id long, text string"
    )
    text = "Intro: one, two three four five six seven eight nine ten! eleven; then a Short-item and a shortitem."
    rows = [(1, text), (2, None), (3, ""), (4, "no id. here"), (5, "x " * 60_000 + "SHORT item"), (5, "x"), (6, "é short item é")]
    got = decontaminate(docs_of(rows), items, shard_chars=shard_chars).collect()
    by_text = {r.text: r for r in got}
    assert len(got) == 7 and {r.ids for r in got} == {"extra"}
    assert by_text[text].n_hit == 13 and by_text[text]["items"] == ["1", "2"]
    assert [text[s.start : s.end] for s in by_text[text].spans] == ["one, two three four five six seven eight nine ten! eleven", "Short-item"]
    assert by_text[text].cleaned == "Intro: ; then a  and a shortitem."
    assert (by_text[None].n_words, by_text[None].cleaned) == (0, None) and by_text[""].n_words == 0
    assert by_text["no id. here"].n_hit == 3 and by_text["no id. here"]["items"] == []
    assert by_text["é short item é"].cleaned == "é  é" and by_text[rows[4][1]].n_hit == 2
    assert decontaminate(docs_of([]), items).collect() == []
    assert [r.n_words for r in decontaminate(docs_of([(1, "a b")]), items.limit(0)).collect()] == [2]


def test_quality_rules_edge_cases(spark, docs_of):
    clean = lambda k: " ".join(f"w{k}x{j}" for j in range(12))
    letters = lambda k: "".join(chr(97 + int(c)) for c in str(k))
    rows = [(k, f"Shared line {k}\nown {letters(k)} " + clean(letters(k)), "h") for k in range(40)]
    rows += [(100 + k, "a whole copied text of more than ten words that stays as it is", "h") for k in range(30)]
    rows += [(200, "shared line 7\n" * 30 + "own ends here", "h"), (201, None, None), (202, "", "h"), (203, "a b c d e f g h i j " * 300, None), (204, clean("q"), "h"), (204, clean("q"), "h")]
    got = quality_rules(docs_of(rows)).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and {r.ids for r in got} == {"extra"}
    assert by_id[0].cleaned == rows[0][1] and by_id[0].n_lines_removed == 0  # the first document keeps the line
    assert all(by_id[k].cleaned == rows[k][1].split("\n")[1] and by_id[k].kept for k in range(1, 40))
    assert all(by_id[100 + k].kept for k in range(30))
    assert by_id[200].n_dup_lines == 29 and not by_id[200].kept
    assert by_id[201].base_failed and by_id[202].base_failed and by_id[201].cleaned is None
    assert by_id[203].n_repeat_words == 3000 and not by_id[203].kept and by_id[204].kept
    assert quality_rules(docs_of([])).collect() == []


def _hosts() -> list[tuple]:
    """A host of 7,100 documents, of which 205 hold a long line and 205 a short one, and a small host with a line in half."""
    name = lambda k: "".join(chr(97 + int(c)) for c in str(k))
    own = lambda k: " ".join(f"{name(k)}x{chr(97 + j)}" for j in range(12))
    held = lambda k: "Subscribe to our free weekly newsletter\n" if k < 205 else "Read more\n" if k < 410 else ""
    return [(k, held(k) + own(k), "big") for k in range(7100)] + [(8000 + k, ("All rights reserved\n" if k % 2 else "") + own(8000 + k), "small") for k in range(100)]


def test_long_lines_of_many_documents_go_on_a_large_host(spark, docs_of):
    got = {r.doc_id: r for r in quality_rules(docs_of(_hosts())).collect()}
    gone = {i for i, r in got.items() if r.n_lines_removed}
    assert gone == {*range(1, 205), *range(8003, 8100, 2)}
    assert all("\n" not in got[i].cleaned and got[i].kept for i in gone)


def test_quality_rules_equal_sql_where_lines_are_above_the_limit(spark, docs_of, tmp_path):
    """On the host of 7,100 only the absolute limit is passed, on one of 1,000 the share."""
    small = [r for r in _hosts() if r[2] == "small"]
    docs_of([r for r in _hosts() if r[2] != "small"] + small + [(r[0] + 10_000, r[1], "other") for r in _hosts()[:1000]], 1).write.parquet(f"{tmp_path}/raw")
    (tmp_path / "documents.parquet").write_bytes(next((tmp_path / "raw").glob("*.parquet")).read_bytes())
    df = queries.QUERIES["op7_quality_rules"](spark, str(tmp_path))
    found = database(str(tmp_path)).execute(queries.ORACLES["op7_quality_rules"])
    rows = df.collect()
    assert sum(r.n_lines_removed for r in rows) == 49 + 204 + 204 + 204
    assert rows_of(df.columns, rows) == rows_of([d[0] for d in found.description], found.fetchall())


def test_repeated_rows_are_one_document_of_their_host(spark, docs_of):
    own = lambda k: " ".join(f"w{chr(97 + k // 26)}{chr(97 + k % 26)}{chr(97 + j)}" for j in range(12))
    rows = [(k, ("Follow us on the social networks\n" if k < 25 else "") + own(k), "one") for k in range(500)]
    for times in (1, 4):
        got = quality_rules(docs_of(rows * times)).collect()
        assert len(got) == 500 * times
        assert sorted(r.doc_id for r in got if r.n_lines_removed) == sorted([*range(1, 25)] * times)


def test_operators_keep_columns_named_as_their_inner_ones(spark, docs_of):
    names = ["_keys", "_id", "_copy", "_found", "_tag", "_own_id", "id", "tag", "ranges", "key"]
    passage = " ".join(f"word{j}" for j in range(60))
    docs = docs_of([(k, f"own{k} {passage}") for k in range(3)])
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n), F.col("doc_id")))
    for operator in (quality_rules, remove_later_passages, remove_repeated_strings):
        rows = operator(docs).collect()
        assert len(rows) == 3 and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names), operator


def test_rows_of_one_id_or_none_get_only_their_own_passages(spark, docs_of):
    """A third of the rows without id, each joined with what was found in its own text alone."""
    passage = " ".join(f"word{j}" for j in range(60))
    rows = [(None, f"own{k} {passage}" if k % 2 else " ".join(f"x{k}y{j}" for j in range(60))) for k in range(60)] + [(k, f"{passage} end{k}") for k in range(20)]
    strings = {r.text: r.cleaned for r in remove_repeated_strings(docs_of(rows)).collect()}
    later = remove_later_passages(docs_of(rows)).collect()
    assert len(strings) == len({t for _, t in rows}) and len(later) == len(rows)
    assert all((passage in t) == (strings[t] != t) for _, t in rows)
    assert all(r.kept == r.text for r in later if passage not in r.text)
    assert all(passage not in r.kept for r in later if r.doc_id is not None)


def test_later_windows_equal_comparing_all(spark):
    rng = random.Random(3)
    order = lambda r, k: (r["id"] is not None, r["id"] or 0, r["first"] + k)
    for _ in range(150):
        length, letters, rows = rng.choice([2, 3, 5, 20]), rng.choice([1, 2, 4, 50]), []
        pool = [[rng.randrange(letters) for _ in range(length * 3)] for _ in range(3)]
        for _ in range(rng.randint(1, 30)):
            n, base = rng.randint(1, 16), rng.choice(pool)
            line = (base[rng.randrange(len(base)) :] + [rng.randrange(letters) for _ in range(n + length)])[: n + length - 1]
            rows.append({"data": " ".join(map(str, line)).encode(), "count": n, "id": rng.choice([None, 1, 2, 7, -5]), "first": rng.randrange(6)})
        windows = [[tuple(r["data"].split()[k : k + length]) for k in range(r["count"])] for r in rows]
        least: dict[tuple, tuple] = {}
        for r, own in zip(rows, windows):
            for k, w in enumerate(own):
                least[w] = min(least.get(w, order(r, k)), order(r, k))
        want = [[order(r, k) > least[w] for k, w in enumerate(own)] for r, own in zip(rows, windows)]
        assert [x.tolist() for x in later_windows(rows, length)] == want


def test_more_automata_than_a_worker_keeps(spark, docs_of):
    items = [(str(k), " ".join(f"i{k}w{j}" for j in range(12))) for k in range(30)]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    docs = docs_of([(k, f"before {items[k % 30][1]} after, {items[(k + 7) % 30][1]}" if k % 3 else "clean words") for k in range(40)] + [(99, None)])
    one, many = (sorted(map(str, decontaminate(docs, benchmark, shard_chars=size).collect())) for size in (4 << 20, 200))
    assert one == many and sum("Row(start" in r for r in one) == 26


def test_url_filter_edge_cases(spark):
    rules = queries.URL_RULES
    urls = ["http://A.B.NET/x", "https://example.net/en/1", "https://www.example.net/en", "ftp://example.com/de/x?y", "x.org/fr/", None, "", "http://", "http://foo.org/fr/?a=b&c=d#e", "http://notexample.com/de/", "http://h.io?q", "http://example.net?x://y.org/fr/"]
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)] + [(1, urls[1], "x")], "page_id long, url string, suffix string")
    got = {r.page_id: r for r in filter_urls(pages, rules).collect()}
    assert (got[0].host, got[0].path, got[0].rule, got[0].verdict, got[0].suffix) == ("a.b.net", "/x", "net/", "block", "x")
    assert (got[1].rule, got[1].verdict) == ("example.net/en/", "allow") and got[2].rule == "net/" and got[3].rule == "example.com/de/"
    assert all((got[k].host, got[k].path, got[k].rule) == ("", "", None) for k in (4, 5, 6, 7))
    assert (got[8].rule, got[8].path) == ("org/fr/", "/fr/") and got[9].rule is None and (got[10].host, got[10].path) == ("h.io", "")
    assert (got[11].host, got[11].rule) == ("example.net", None)
    assert {r.verdict for r in got.values()} <= {"allow", "block"}
    only = filter_urls(pages.where("page_id = 10"), rules).collect()
    assert [r.verdict for r in only] == ["allow"] and filter_urls(pages.limit(0), rules).collect() == []


@pytest.mark.parametrize("crowd", [4096, 1])
def test_later_passages_edge_cases(spark, docs_of, crowd):
    rng = random.Random(6)
    text = lambda n: " ".join(rng.choice("abcdefgh") + str(rng.randrange(4)) for _ in range(n))
    passage, whole = text(25), text(40)
    rows = [(1, None), (2, ""), (3, text(19)), (9, f"{text(5)} {passage}\n{text(4)}"), (4, f"{passage} {text(30)} {passage}"), (6, whole), (5, whole), (7, "z " * 300), (8, (again := text(50))), (8, again), (None, text(8) + " " + passage)]
    rows += [(20 + k, f"{text(6)} {passage} {text(6)}") for k in range(8)]
    got = remove_later_passages(docs_of(rows), crowd=crowd).collect()
    assert len(got) == len(rows) and {r.ids for r in got} == {"extra"}
    first: dict[tuple, tuple] = {}
    order = lambda i: (i is not None, i or 0)
    for i, t in rows:
        w = (t or "").split()
        for k in range(len(w) - 19):
            g = tuple(w[k : k + 20])
            first[g] = min(first.get(g, ((True, 10**9), 0)), (order(i), k))
    for r in got:
        w = (r.text or "").split()
        gone = {p for k in range(len(w) - 19) if first[tuple(w[k : k + 20])] != (order(r.doc_id), k) for p in range(k, k + 20)}
        assert r.kept == " ".join(x for p, x in enumerate(w) if p not in gone) and r.n_words == len(w)
        assert sum(s.b - s.a for s in r.spans) == len(gone)
    assert remove_later_passages(docs_of([])).collect() == []
