import html as _html
import random

import duckdb
import pytest

import corpus_pipeline
from quillstat.llm import main_text, page_trees, toxic_crf
from quillstat.llm.catalog import oracle_sql, queries

SCHEMA = "page_id long, url string, html string, text string, host int"


def page(rng, k, host, paragraphs):
    title = f"Title {k} &amp; more"
    body = "".join(f"<p>{_html.escape(p)}</p>" if rng.random() < 0.7 else f"<p>{_html.escape(p)}" for p in paragraphs)
    lists = "<ul><li>first point</li><li>second point</li></ul>" if k % 2 else ""
    extra = '<div class="cookie-notice">We use cookies.</div>' if k % 3 == 0 else ""
    return (f"<!DOCTYPE html><html><head><title>{title}</title><script>if (a<b) p('</p>')</script><style>p{{}}</style></head><body>"
            f"<header><a href='/'>{host}</a></header><nav><ul><li><a href='/a'>A</a><li><a href='/b'>B</a></ul></nav>{extra}"
            f"<article><h1>{title}</h1><div class='x1'>Published by our team</div>{body}{lists}<form><input name=q><button>Go</button></form>"
            f"<section class='comments'><article class='comment'><p>nice {k}</p></article></section></article>"
            f"<aside class=\"sidebar\"><p>Read more</p></aside><div class='ad-slot'>Buy</div><footer>&copy; {host}</footer></body></html>"
            ), [_html.unescape(title), *[" ".join(p.split()) for p in paragraphs], *(["first point", "second point"] if lists else [])]


def test_wrappers_and_articles(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for k in range(60):
        host = "www.one.org" if k % 3 else "two.org"
        text, parts = page(rng, k, host, [f"Paragraph {j} of\n page {k} <x> & é" for j in range(rng.randint(2, 5))])
        rows.append((k, f"https://{host}/p/{k}", text, "t", 1))
        want[k] = "\n".join(parts)
    odd = [(100, None, None, "t", 1), (101, "not a url", "", "t", 1), (102, "http://x.org/", "<p>cut <b>off", "t", 1), (103, "http://x.org/", "just text &lt; here", "t", 1),
           (104, "http://x.org/", "<div><p>a</div><p>b" + "<i>" * 3000, "t", 1), (0, *rows[0][1:]), (None, "http://y.org", "<article>z</article>", "t", 1),
           (105, "http://x.org/", "<p>" + "long " * 30000, "t", 1)]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    got = main_text.extract_main_text(df.repartition(6))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(rows) + len(odd) and all(r[3] == len(r[2]) for r in got)
    texts = {r[0]: r[2] for r in got}
    for k, text in want.items():
        assert texts[k] == text
    assert (texts[100], texts[101], texts[102], texts[103], texts[None]) == ("", "", "cut off", "just text < here", "z")
    assert texts[104] == "a\nb" and texts[105] == ("long " * 30000).strip()
    wrapper = [page_trees.from_json(r.wrapper) for r in main_text.host_wrappers(df).collect() if r.host == "www.one.org"][0]
    shape = page_trees.expression(wrapper)
    assert "(<ul> (<li> 'first point' </> <li>" not in shape and "(<ul> (<li> #PCDATA </>)+ </>)?" in shape and ")+" in shape and "#PCDATA" in shape and "'Published by our team'" in shape
    assert main_text.extract_main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_host_texts_are_dropped_only_with_evidence():
    pages = [f"<article><h1>News {k}</h1><div class='x9'><p>Subscribe today</p></div><p>Body {k}</p></article>" for k in range(8)]
    whole = None
    for p in pages:
        own = page_trees.as_wrapper(page_trees.page_tree(p), page_trees.page_mark(p))
        whole = own if whole is None else page_trees.merge(whole, own)
    assert main_text.main_text(pages[3], whole) == "News 3\nBody 3"
    few = page_trees.as_wrapper(page_trees.page_tree(pages[0]), page_trees.page_mark(pages[0]))
    assert main_text.main_text(pages[0], few) == "News 0\nSubscribe today\nBody 0"


def read_host(pages):
    whole = None
    for p in pages:
        own = page_trees.as_wrapper(page_trees.page_tree(p), page_trees.page_mark(p))
        whole = own if whole is None else page_trees.merge(whole, own)
    return [main_text.main_text(p, whole) for p in pages]


def test_pages_are_read_along_the_wrapper_in_order():
    figure = "<figure><img src=x></figure>"
    got = read_host([f"<article><p>Constant line</p>{figure}<p>Body {k}</p><p>More {k}</p></article>" for k in range(8)])
    assert got == [f"Body {k}\nMore {k}" for k in range(8)]
    got = read_host([f"<article><p>Body {k}</p>{figure}<p>Constant line</p></article>" for k in range(8)])
    assert got == [f"Body {k}" for k in range(8)]
    got = read_host([f"<article><h2>Stories</h2><p>One {k}</p>{figure if k % 2 else ''}<h2>Part {k}</h2><p>Two {k}</p></article>" for k in range(12)])
    assert all(f"One {k}" in t and f"Part {k}" in t and f"Two {k}" in t for k, t in enumerate(got))


def test_names_do_not_drop_the_article_or_its_parts():
    inner = ("<h2 id='related-work'>Related work {0}</h2><section id='search-results'><p>Results {0}</p></section>"
             "<p class='share-price'>Price {0}</p><h2 id='legal-history'>History {0}</h2><h2 id='discussion'>Discussion {0}</h2>"
             "<p class='notice'>Note {0}</p><div class='ad-slot-12'>Buy {0}</div><div class='sidebar'>Side {0}</div>")
    want = "Title {0}\nRelated work {0}\nResults {0}\nPrice {0}\nHistory {0}\nDiscussion {0}\nNote {0}"
    for outer in ("has-sidebar", "content-with-sidebar", "sidebar", "legal"):
        got = read_host([f"<nav>Menu</nav><div class='{outer}'><article><h1>Title {k}</h1>{inner.format(k)}</article></div><div class='site-footer'>End {k}</div>"
                         for k in range(8)])
        assert got == [want.format(k) for k in range(8)]
    assert read_host(["<form><article><p>Body</p></article></form>"]) == ["Body"]
    assert read_host(["<aside><article>Teaser</article></aside><article><p>Body</p></article>"]) == ["Body"]


def test_all_content_elements_of_a_page_are_kept():
    part = "<div class='story-body'><p>{}</p></div>"
    assert read_host([f"{part.format('part 1')}<figure></figure><p>between</p>{part.format('the longer part 2')}<footer>End</footer>"]) == ["part 1\nthe longer part 2"]
    assert read_host(["<main><p>one</p></main><p>between</p><main><div class='content'><p>two</p></div><p>three</p></main>"]) == ["one\ntwo\nthree"]
    assert read_host(["<div class='main-image'>Image</div><div class='content'><div class='text'>one</div>two</div>"]) == ["Image\none\ntwo"]


def test_alignment_finds_groups_and_options():
    one = page_trees.as_wrapper(page_trees.page_tree("<dl><dt>a<dd>b<dt>c<dd>d</dl><p>x</p>"), 1)
    two = page_trees.as_wrapper(page_trees.page_tree("<dl><dt>a<dd>b</dl>"), 2)
    for whole in (page_trees.merge(one, two), page_trees.merge(two, one)):
        assert page_trees.expression(whole) == "<dl> (( <dt> #PCDATA </> <dd> #PCDATA </> ))+ </> (<p> 'x' </>)?"


def test_pipeline_keeps_clean_rows_and_their_columns(spark, tmp_path):
    rng = random.Random(11)
    words = [f"tok{k}" for k in range(3000)]
    item = "which of these rivers flows through the old town before it meets the sea near the northern harbour"
    rows, labels = [], []
    for i in range(240):
        text = [rng.choice(words) for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            text.insert(rng.randrange(60), rng.choice(["idiot", "loser"]))
        rows.append((i, " ".join(text), "en", "src0", 1))
        labels.append((i, 1, int(bad)))
    clean = [r for r in rows if r[0] % 4]
    rows += [(1000, clean[0][1] + " ", "en", "s", 1), (1001, clean[0][1], "en", "s", 1)]
    near = clean[1][1].split()
    near[30] = "changed"
    rows += [(1002, " ".join(near), "en", "s", 1), (1003, clean[2][1] + ". " + item, "en", "s", 1), (1004, None, None, None, None), (1005, "", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "piece_codec"]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    model = toxic_crf.train_toxicity(docs, spark.read.parquet(str(tmp_path / "labels.parquet")), ~toxic_crf.held_out_rows())
    harmless = {r[0] for r in rows} - {r.doc_id for r in toxic_crf.toxic_spans(docs, model).collect() if r.score >= 0.3}
    assert harmless >= {r[0] for r in clean} and not harmless & {r[0] for r in rows if r[0] < 240 and r[0] % 4 == 0}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == sorted({r[0] for r in clean} | {1000, 1004} - {1000})
    assert all(r.round_trip for r in got)
    stage = corpus_pipeline.STAGES[1][1](spark, docs, str(tmp_path))
    assert stage.columns == docs.columns


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_queries_match_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    cursor = con.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    want = sorted(map(str, cursor.fetchall()))
    df = queries()[name](spark, folder)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(str(tuple(r)) for r in df.select(*columns).collect()) == want


def test_markup_of_any_depth_is_read():
    for tag in ("div", "ul", "section", "blockquote"):
        pages = [f"<html><body><article><p>first</p>{f'<{tag}>' * 3000}<p>{w}</p>{f'</{tag}>' * 3000}<p>last</p></article></body></html>"
                 for w in ("one", "two")]
        one, two = (page_trees.as_wrapper(page_trees.page_tree(p), k) for k, p in enumerate(pages))
        wrapper = page_trees.merge(one, two)
        kept = page_trees.to_json(wrapper)
        assert page_trees.to_json(page_trees.from_json(kept)) == kept
        assert page_trees.expression(wrapper).count("#PCDATA") == 1
        for known in (None, wrapper):
            assert main_text.main_text(pages[0], known) == "first\none\nlast"
