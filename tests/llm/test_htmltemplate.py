"""Templates of op9: slots, valid classes against a plain version, broken and deep pages."""

import time

from closetops.llm import htmltemplate

WORDS = "amber basin cedar delta ember fjord grove heron inlet jetty knoll larch maple north ocean pines quarry ridge".split()


def prose(i, n=40):
    return " ".join(WORDS[(i * 7 + j * (i + 3)) % len(WORDS)] + str(i) for j in range(n))


def texts(spark, pages):
    rows = [(i, url, page) for i, (url, page) in enumerate(pages)]
    got = htmltemplate.op9(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(got, key=lambda r: r.page_id)]


def test_slots_of_an_unmarked_layout(spark):
    """A rail that rotates among three values, a line that differs in its number, and two slots of the article."""
    page = ('<html><body><div class="top">Our site</div><div class="rail">{rail}</div><div class="c"><div class="meta">Posted {i} times</div>'
            '<div class="lead"><p>{a}</p></div><div class="box">{rail}</div><div class="rest"><p>{b}</p></div></div></body></html>')
    rails = ["Read this week", "Write to us soon", "Our shop is open"]
    pages = [("http://r/x", page.format(rail=rails[i % 3], i=i, a=prose(i), b=prose(i + 50))) for i in range(12)]
    assert texts(spark, pages) == [f"{prose(i)}\n{prose(i + 50)}" for i in range(12)]


def test_repeats_in_articles_and_copies_of_pages_stay(spark):
    page = "<html><body><div>Menu</div><article><h1>Day {0}</h1><p>Always the same words</p><p>{1}</p></article></body></html>"
    plain = "<html><body><div class='a'>Site</div><div class='b'><p>{0}</p></div></body></html>"
    pages = [("http://a/x", page.format(i, prose(i))) for i in range(8)] + [("http://b/x", plain.format(prose(i // 10))) for i in range(20)]
    assert texts(spark, pages) == [f"Day {i}\nAlways the same words\n{prose(i)}" for i in range(8)] + [prose(i // 10) for i in range(20)]


def test_placed():
    def t(token, vector, first, last=None):
        return {"token": token, "vector": vector, "first": first, "last": first if last is None else last}

    def at(*tokens):
        return {x["token"]: (x["rank"], x["around"]) for x in htmltemplate.placed(list(tokens))}
    nested = at(t("a", "1", 0), t("b", "1", 5), t("x", "2", 2), t("y", "2", 3))
    assert [r for r, _ in nested.values()] == [0, 1, 0, 1] and nested["a"][1] == 0 and nested["x"][1] == nested["y"][1]
    assert nested["x"] != at(t("a", "1", 0), t("b", "1", 1), t("c", "1", 5), t("x", "2", 2), t("y", "2", 3))["x"]
    crossed = at(t("a", "1", 0), t("x", "2", 2), t("b", "1", 3), t("y", "2", 5))
    assert crossed["x"][1] is None and crossed["a"][1] == 0
    repeated = at(t("a", "1", 0, 4), t("b", "1", 1, 3))  # a b b a
    assert repeated["a"][0] == repeated["b"][0] == -1


def test_template_against_a_plain_version(spark):
    """The template of one host, tokens in and out of order, against classes from whole occurrence vectors."""
    def page(i):
        middle = "<i-a></i-a><i-b></i-b>" if i % 2 else "<i-b></i-b><i-a></i-a>"
        extra = "<h-a></h-a><h-b></h-b>" if i % 4 else ""
        rows = "<ul>" + "<li><u-x></u-x></li>" * (i % 3 + 1) + "</ul>"
        return f"<html><body><div>{middle}</div>{extra}<section>{rows}</section><p>{prose(i)}</p></body></html>"
    pages = [page(i) for i in range(8)]
    found = [htmltemplate.read(p) for p in pages]
    tokens = [{t["token"]: t for t in htmltemplate._tokens(f) if t["token"]} for f in found]
    vectors = {t: tuple(x[t]["n"] if t in x else 0 for x in tokens) for x in tokens for t in x}
    classes = {}
    for t, v in vectors.items():
        if sum(n > 0 for n in v) >= 4:
            classes.setdefault(v, set()).add(t)
    classes = {v: c for v, c in classes.items() if len(c) >= 2}
    want = {}
    for v, c in classes.items():
        orders = []
        for x in tokens:
            if c <= x.keys():
                first, last = ([t for t in sorted(c, key=lambda t: x[t][k])] for k in ("first", "last"))
                orders.append([a if a == b else None for a, b in zip(first, last)])
        same = {o[0] for o in zip(*orders) if len(set(o)) == 1} - {None}
        if len(same) >= 2:
            want[v] = same
    rows = spark.createDataFrame([(0, "http://h/", p) for p in pages], "page_id long, url string, html string")
    ddl = "array<struct<token:string,n:long,chars:long,free:long,first:int,last:int>>"
    seen = (htmltemplate._parsed(rows, "url", "html", "tokens", ddl, htmltemplate._tokens)
            .selectExpr("host", "xxhash64(html) AS page", "explode(p.tokens) AS t").select("host", "page", "t.*"))
    got = {r.token for r in htmltemplate._template(seen, ["host"])[2].collect()}
    assert got == set().union(*want.values())
    names = {t.rpartition("/")[2] for t in got}
    assert {"html", "body", "section", "h-a", "h-b"} <= names and not {"i-a", "i-b"} & names


def test_broken_and_deep_pages_take_linear_time():
    began = time.time()
    for page in ("<a b='\">" * 130_000, "<div>" * 200_000 + "x" + "</p>" * 50_000, "<p " + "a" * 1_000_000 + ">x</p>",
                 "<p><b>" * 80_000 + "</i>" * 80_000, "<!--" * 250_000, "<script>" * 100_000, "<li>" * 200_000, "&amp" * 250_000):
        found = htmltemplate.read(page)
        htmltemplate._structure(found), htmltemplate._tokens(found)
    assert time.time() - began < 60


def test_defined_results(spark):
    schema = "page_id long, url string, html string, host string, p int, token string, slot string"
    row = ("<p>one</p>", None, None, None, None)
    pages = spark.createDataFrame([(1, None, *row), (1, None, *row), (None, "http://h/", None, "h", 1, "t", "s"), (2, "x", "", None, 0, "", "")], schema)
    got = sorted((r.page_id or 0, r.text) for r in htmltemplate.op9(pages).collect())
    assert got == [(0, ""), (1, "one"), (1, "one"), (2, "")]
    assert htmltemplate.op9(pages.limit(0)).count() == 0
